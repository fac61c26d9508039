"""Connected components, and links that come later."""

import random

from eventloom.llm import components as module
from eventloom.llm.components import components, merged


def brute(links):
    label = {}
    for a, b in links:
        if a != b:
            label.setdefault(a, a), label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


def table(spark, links):
    return spark.createDataFrame(links, "x long, y long")


def test_later_links_join_what_was_found(spark):
    rng = random.Random(5)
    sparse = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)]
    path = [(i + 1, i) for i in range(1000, 1040)]
    later = [(rng.randrange(320), rng.randrange(320)) for _ in range(60)] + [(1040, 7), (2000, 2001), (3000, 3000)]
    found = components(table(spark, sparse + path))
    assert dict(map(tuple, found.collect())) == brute(sparse + path)
    assert dict(map(tuple, merged(found, table(spark, later)).collect())) == brute(sparse + path + later)
    assert dict(map(tuple, merged(found, table(spark, [])).collect())) == brute(sparse + path)


def test_later_links_do_not_search_the_earlier_ones_again(spark, monkeypatch):
    searched = []
    monkeypatch.setattr(module, "components", lambda links: searched.append(links.count()) or components(links))
    star = [(0, i) for i in range(1, 200)]
    found = components(table(spark, star + [(500, 501)]))
    inside = [(i, j) for i in range(1, 40) for j in range(i)]
    assert dict(map(tuple, merged(found, table(spark, inside + [(501, 3), (500, 9)])).collect()))[501] == 0
    assert searched == [1]  # one pair of components, whatever the links within them

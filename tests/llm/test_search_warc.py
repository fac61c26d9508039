import base64
import hashlib
import math
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm.common import prepare, table
from eventloom.llm.topk_search import search_block, segment_statistics, top_k
from eventloom.llm.warc import END, archive_pages, compress_record, plan_records, read_archives, record_text, salvage, write_archives
from eventloom.session import scratch_path

from .helpers import SF, rows_of


def brute_top(rows, is_query, k):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if not is_query(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in ok if j != i and len(c) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def got(df):
    return sorted(tuple(r.values()) for r in rows_of(df))


@pytest.mark.parametrize("query_block,candidate_block", [(2048, 8192), (7, 40)])
def test_top_k_with_ties_nulls_and_odd_vectors(spark, query_block, candidate_block):
    prepare(spark)
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(9)]) for i in range(150)]
    rows += [(200 + i, list(rows[7][1])) for i in range(60)]  # copies: ties
    rows += [(300, None), (301, []), (302, [1.0, None] + [0.0] * 7), (303, [float("nan")] * 9), (304, [float("inf")] + [0.0] * 8), (None, [1.0] * 9), (305, [1.0, 2.0]), (320, [3.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash")).withColumn("q", F.lit(1)).repartition(3)
    rounded = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want = brute_top(rounded, lambda i: i % 20 == 0, 20)
    assert got(top_k(df, F.col("id") % 20 == 0, query_block=query_block, candidate_block=candidate_block)) == want
    assert got(top_k(df.limit(0), F.col("id") % 20 == 0)) == []


def test_top_k_given_table(spark):
    prepare(spark)
    df = table(spark, SF, "embeddings")
    data = [(r["vec_id"], list(r["embedding"])) for r in df.collect()]
    assert got(top_k(df, F.col("id") % 20 == 0, candidate_block=100)) == brute_top(data, lambda i: i % 20 == 0, 20)


def test_bounds_are_never_below_the_score_and_blocks_agree():
    rng = np.random.default_rng(0)
    centre = rng.integers(-200, 200, (8, 32))
    c = (centre[rng.integers(0, 8, 900)] + rng.integers(-6, 7, (900, 32))).astype(np.int64)
    q = c[:50]
    exact = q @ c.T
    for s in (1, 4, 16, 40):
        assert (segment_statistics(q.astype(float), s) @ segment_statistics(c.astype(float), s).T >= exact - 1e-6).all()
    query, score, ids = search_block(np.arange(50), q, np.arange(900), c, 5)
    for i in range(50):
        want = sorted((-exact[i, j], j) for j in range(900) if j != i)[:5]
        assert sorted(zip((-score[query == i]).tolist(), ids[query == i].tolist())) == want


def pages_df(spark, rows):
    prepare(spark)
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash")).repartition(3)


def want_pages(rows):
    group = {}
    for i, _, h in rows:
        group.setdefault(h or "", []).append(i)
    for i, _, h in rows:
        raw, top = (h or "").encode(), max(group[h or ""])
        yield i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if i == top else "revisit", None if i == top else top


ROWS = [(1, "http://a/ b\n", "<p>é</p>"), (5, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (9, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" + "x" * 50), (10, "u", "line\r\n\r\n\r\nend\r\n\r\n"), (11, "u", "y" * 100000)]


def test_round_trip(spark):
    rows = ROWS + [(100 + i, f"h{i}", "same page") for i in range(40)]
    df = archive_pages(pages_df(spark, rows))
    assert sorted((tuple(r.values())[:5] for r in rows_of(df)), key=str) == sorted(want_pages(rows), key=str)
    assert rows_of(archive_pages(pages_df(spark, rows).limit(0))) == []


def test_least_size_and_payload_round_trip(spark):
    df = pages_df(spark, ROWS)
    rows = rows_of(archive_pages(df, least=1))
    assert {r["page_id"]: r["record_type"] for r in rows if r["page_id"] in (1, 3, 4, 5)} == {1: "revisit", 3: "response", 4: "response", 5: "response"}
    path = scratch_path(spark, "warc-test")
    write_archives(plan_records(df), path)
    read = {r["record_id"]: r["payload"] for r in rows_of(read_archives(spark, path, with_payload=True)) if r["record_type"] == "response"}
    for i, _, h in ROWS[1:]:
        assert read.get(str(i), b"") == (h or "").encode()


def records(spark):
    return [r["value"].encode() + END for r in record_text(plan_records(pages_df(spark, ROWS))).collect()]


@pytest.mark.parametrize("pack", [lambda r: r, compress_record])
def test_salvage_recovers_all_whole_records(spark, pack):
    parts = [pack(r) for r in records(spark)]
    whole = b"".join(parts)
    items = list(salvage(whole))
    assert len(items) == len(parts) and all(i.reason is None for i in items)
    ids = [i.headers["warc-record-id"] for i in items]
    rng = random.Random(1)
    for victim in range(len(parts)):
        for damage in ("flip", "cut", "junk"):
            bad = bytearray(parts[victim])
            if damage == "flip":
                bad[len(bad) * 2 // 3] ^= 0xFF
            elif damage == "cut":
                del bad[len(bad) // 2 :]
            else:
                bad[:0] = bytes(rng.randrange(256) for _ in range(33)) + b"\n"
            data = b"".join([*parts[:victim], bytes(bad), *parts[victim + 1 :]])
            items = list(salvage(data))
            assert sum(i.length for i in items) == len(data) and [i.offset for i in items] == np.cumsum([0, *(i.length for i in items[:-1])]).tolist()
            found = [i.headers["warc-record-id"] for i in items if i.reason is None]
            kept = ids if damage == "junk" else ids[:victim] + ids[victim + 1 :]
            flawless = damage == "flip" and pack is not compress_record and not any(i.reason for i in items)  # a header without a check
            assert len(found) == len(ids) if flawless else found == kept
            if damage != "flip" or pack is compress_record:
                assert any(i.reason for i in items)


def test_text_of_a_failed_record_is_no_record():
    """A payload that holds records of its own: damage to it, to its length and a cut file."""
    inner = b"".join(make(i, f"inner {i}".encode()) for i in (7, 8))
    payload = b"<html>" + inner + b"</html>"
    first, second = make(1, payload, digest="sha1:" + "A" * 32), make(2, b"second")
    items = list(salvage(first + second))
    assert [(i.reason, i.headers.get("warc-record-id")) for i in items] == [("block digest differs", None), (None, "<urn:page:2>")]
    assert [i.reason for i in salvage(first)] == ["block digest differs"]
    longer = first.replace(f"Content-Length: {len(payload)}".encode(), f"Content-Length: {len(payload) + 5}".encode())
    items = list(salvage(longer + second))
    assert [i.headers["warc-record-id"] for i in items if i.reason is None and not i.inside] == ["<urn:page:2>"]
    assert {i.headers["warc-record-id"] for i in items if i.inside} == {"<urn:page:7>", "<urn:page:8>"}


def make(number, payload, digest=None):
    digest = digest or "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{number}>\r\nWARC-Block-Digest: {digest}\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload + END


def test_false_starts_cost_linear_time():
    took = []
    for n in (4000, 16000):
        data = b"WARC/1.1\r\nWARC/1.0 x\x1f\x8b\x08 " * n + make(1, b"end")
        start = time.perf_counter()
        items = list(salvage(data))
        took.append(time.perf_counter() - start)
        assert [i.reason is None for i in items] == [False, True]
    assert took[1] < 10 * took[0] + 0.5


def test_a_gap_in_written_archives_raises(spark, monkeypatch):
    prepare(spark)
    from eventloom.llm import warc

    original = warc.read_archives

    def damaged(spark, path):
        copy = scratch_path(spark, "damaged")
        files = spark.read.format("binaryFile").load(path).select("content").collect()
        whole = b"".join(bytes(f.content) for f in files)
        os.makedirs(copy)
        with open(os.path.join(copy, "one.warc"), "wb") as out:
            out.write(whole.replace(b"Content-Length", b"Content-Lenght", 1))
        return original(spark, copy)

    monkeypatch.setattr(warc, "read_archives", damaged)
    with pytest.raises(Exception, match="quarantined bytes"):
        archive_pages(pages_df(spark, ROWS)).collect()


def test_top_k_of_wide_vectors_and_repeated_ids(spark):
    """Finite components of any size take part; each row of a repeated id is a query of its own."""
    prepare(spark)
    rng = random.Random(9)
    rows = [(i, [float(np.float32(rng.gauss(0, 1) * 10.0 ** rng.choice((0, 0, 8, 9, 18, 30, 38)))) if i % 4 == 0 else float(np.float32(rng.gauss(0, 1))) for _ in range(5)]) for i in range(120)]
    rows += [(400, [1e38, 0.0, 0.0, 0.0, 0.0]), (400, [1.0, 2.0, 3.0, 4.0, 5.0]), (400, [1.0, 2.0, 3.0, 4.0, 5.0]), (401, [1e18] * 5)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    most = 2**63 - 1
    ints = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    want = []
    for i, q in ints:
        if i % 20 == 0:
            scored = sorted((-max(-most, min(most, sum(a * b for a, b in zip(q, c)))), j) for j, c in ints if j != i)
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:20])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    for blocks in ((2048, 8192), (5, 30)):
        assert got(top_k(df, F.col("id") % 20 == 0, query_block=blocks[0], candidate_block=blocks[1])) == sorted(want)


def test_salvage_of_nothing_and_noise():
    assert list(salvage(b"")) == []
    (gap,) = salvage(b"no archive at all WARC/1.1\r\n\x1f\x8b\x08")
    assert gap.reason and gap.length == 31

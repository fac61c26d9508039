import math
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import queries
from eventloom.llm.common import prepare, table
from eventloom.llm.hard_negatives import hard_negatives, hilbert_key, intervals
from tests.llm.helpers import SF, rows_of

SCHEMA = "vec_id long, embedding array<float>, label int"
MOST = 2**63 - 1
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows):
    """Python integers, all pairs; ``rows`` hold 32-bit floats as Python floats."""
    points = []
    for vec_id, v, label in rows:
        if vec_id is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        points.append((vec_id, [math.floor(256 * x) for x in v], label))
    out = []
    anchors = {(i, tuple(v), lab) for i, v, lab in points if i % 100 == 0}
    for vec_id, v, label in anchors:
        scored = []
        for other, w, lab in points:
            if other != vec_id and len(w) == len(v):
                scored.append((max(-MOST, min(MOST, sum(a * b for a, b in zip(v, w)))), other, lab))
        own = sorted((-s, o) for s, o, lab in scored if lab == label)[:5]
        for neg_p, positive in own:
            p = -neg_p
            fit = sorted((-s, o) for s, o, lab in scored if lab != label and 30 * p <= 100 * s <= 90 * p)[:10]
            out += [(vec_id, positive, r + 1, o, p, -neg_s) for r, (neg_s, o) in enumerate(fit)]
    return sorted(out)


def made(n, dim, seed, wide=False):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        v = [float(np.float32(c + rng.gauss(0, 0.4))) for c in centre]
        rows.append((i * 10 if i % 3 else i * 100, v, rng.randrange(10)))
    rows += [(None, rows[0][1], 1), (7000000, None, 1), (7000100, [], 2), (7000200, rows[1][1], None), (7000300, [None] * dim, 3)]
    rows += [(7000400, [float("nan")] * dim, 3), (7000500, [float("inf")] * dim, 3), (7000600, [1.0], 3), (7000601, [0.5], 3), (7000602, [0.4], 4), (7000700, [0.0] * dim, 5)]
    rows += [(8000000 + i, rows[4][1], rows[4][2]) for i in range(30)] + [(9000000 + i, [x * 0.5 for x in rows[4][1]], 9 - rows[4][2]) for i in range(30)]
    rows += [rows[0], (rows[0][0], rows[5][1], rows[5][2]), rows[8], rows[8]]
    if wide:
        rows += [(9100000 + 10 * i, [float(np.float32(rng.gauss(0, 1) * 10.0**e)) for _ in range(dim)], i % 3) for i, e in enumerate([5, 8, 9, 17, 18, 30, 37] * 6)]
    return rows


def result(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in rows_of(df))


def mine(spark, rows, parts=4, extra=False, **options):
    prepare(spark)
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    if extra:
        for name in ("id", "score", "block", "rank", "anchor", "window", "key", "low"):
            df = df.withColumn(name, F.lit("clash"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(df, F.col("id") % 100 == 0, label, **options)


@pytest.mark.parametrize("n,dim,block,wide", [(300, 6, 16, False), (120, 3, 8, True), (40, 70, 512, False)])
def test_equals_brute_force(spark, n, dim, block, wide):
    rows = made(n, dim, n, wide)
    assert result(mine(spark, rows, extra=True, block=block)) == brute(rows)


def test_given_vectors_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{os.path.join(SF, 'embeddings.parquet')}')")
    cursor = con.execute(queries.ORACLES["op11_hard_negatives"])
    names = [d[0] for d in cursor.description]
    want = sorted(tuple(dict(zip(names, r))[c] for c in COLUMNS) for r in cursor.fetchall())
    assert result(queries.op11_hard_negatives(spark, SF)) == want and want
    given = [(r.vec_id, r.embedding, r.label) for r in table(spark, SF, "embeddings").collect()]
    assert brute(given) == want


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0], 1)], [(0, [1.0, 2.0], 1), (100, [2.0, 1.0], 2)]])
def test_nothing_to_mine(spark, rows):
    got = mine(spark, rows)
    assert got.columns == list(COLUMNS) and got.count() == 0


def test_curve_visits_neighbouring_cells():
    side = np.arange(8)
    points = np.stack(np.meshgrid(side, side, side, indexing="ij"), axis=-1).reshape(-1, 3)
    key = hilbert_key(points, 3)
    assert sorted(key.tolist()) == list(range(512))
    path = points[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_intervals_hold_all_products():
    rng = np.random.default_rng(2)
    a, rows = rng.integers(-300, 300, (20, 9)).astype(float), rng.integers(-300, 300, (50, 9)).astype(float)
    least, most = intervals(a, rows.min(axis=0)[None], rows.max(axis=0)[None])
    got = a @ rows.T
    assert (got >= least).all() and (got <= most).all()

"""Hard negatives against brute force; scores against numpy."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from quire.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, row string, side int, v int"


def test_scores_are_inner_products():
    r = np.random.default_rng(1)
    for n, a, dim, top in ((700, 5, 64, 300), (3, 2, 13, 1), (10, 3, 8, 1 << 33), (1, 1, 1, 0)):
        x, y = r.integers(-top, top + 1, (n, dim)), r.integers(-top, top + 1, (a, dim))
        x, y = (np.clip(z, -(1 << 24), 1 << 33) for z in (x, y))
        assert (negatives.scores(negatives.planes(x), negatives.tables(y)) == x @ y.T).all()


def brute(rows, step=100, positives=5, top=10):
    ok = []
    for i, v, label in rows:
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v):
            ok.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * np.float64(np.float32(x))) for x in v]))
    out = []
    for i, label, v in sorted(x for x in ok if x[0] % step == 0):
        got = sorted((-sum(a * b for a, b in zip(v, w)), j, k) for j, k, w in ok if j != i)
        for s, p, _ in [x for x in got if x[2] == label][:positives]:
            near = [(-t, j) for t, j, k in got if k != label and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(i, p, n, j, -s, t) for n, (t, j) in enumerate(near[:top], 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, "r", 1, 2) for r in rows], SCHEMA)


def mined(df, **more):
    rows = negatives.labelled(df)
    got = negatives.mine(rows, rows.where(F.col("vec_id") % 100 == 0), **more)
    assert dict(got.dtypes)["rank"] == "int"
    return sorted(tuple(r) for r in got.collect())


def sample(n, hot=0.4):
    r = random.Random(4)
    base = [r.gauss(0, 1) for _ in range(9)]
    out = []
    for i in range(n):
        v = [b + r.gauss(0, 0.6) for b in base] if r.random() < 0.7 else base
        out.append((i, v, 3 if r.random() < hot else r.randint(0, 9)))
    return out


def test_against_brute_force(spark):
    rows = sample(420)
    rows += [(1000, None, 1), (1001, [None] * 9, 1), (1002, [math.inf] * 9, 2), (1003, [math.nan] * 9, 2), (1004, rows[0][1], None),
             (None, rows[0][1], 2), (1100, [], 4), (1101, [0.5, 1.0], 4), rows[5], rows[5], rows[6]]
    df = table(spark, rows)
    assert mined(df) == brute(rows)
    assert mined(df, block=50, chunk=2) == brute(rows)


def test_no_rows_and_no_partners(spark):
    assert mined(table(spark, [])) == []
    assert mined(table(spark, [(100, [1.0], 1)])) == []
    assert mined(table(spark, [(100, [1.0], 1), (101, [-1.0], 1), (102, [0.5], 2)])) == []
    assert mined(table(spark, [(100, [1.0], 1), (101, [1.0], 1), (102, [0.5], 2)])) == [(100, 101, 1, 102, 65536, 32768)]

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from metframe.llm import negatives

ANCHOR = "vec_id % 10 = 0"


def plain(rows, positives=5, size=10):
    """The same by comparing each anchor with every row."""
    rows = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows]
    out = []
    for anchor in (r for r in rows if r[0] % 10 == 0):
        score = lambda r: sum(a * b for a, b in zip(anchor[2], r[2]))
        near = sorted((-score(r), r[0]) for r in rows if r[1] == anchor[1] and r is not anchor)[:positives]
        others = sorted((-score(r), r[0]) for r in rows if r[1] != anchor[1])
        for s, p in near:
            window = [(n, i) for n, i in others if -30 * s <= -100 * n <= -90 * s][:size]
            out += [(anchor[0], p, k + 1, i, -s, -n) for k, (n, i) in enumerate(window)]
    return sorted(out)


def of(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    return sorted(tuple(r) for r in negatives.mined(df, F.expr(ANCHOR), **kw).collect())


def made(seed, n, width, labels, ties=False):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width))
    label = rng.integers(0, labels, n)
    values = 0.2 * centres[label] + 0.1 * rng.normal(size=(n, width))
    values = (np.round(values * 8) / 8 if ties else values).astype(np.float32)
    return [(int(i), int(label[i]), [float(x) for x in values[i]]) for i in range(n)]


@pytest.mark.parametrize("seed,n,width,labels,ties,block,chunk", [
    (1, 300, 24, 3, False, 70, 1 << 14), (2, 400, 5, 4, True, 1 << 16, 7), (3, 200, 1, 2, True, 50, 5), (4, 500, 40, 60, False, 90, 20),
])
def test_rows_are_those_of_all_pairs(spark, seed, n, width, labels, ties, block, chunk):
    rows = made(seed, n, width, labels, ties)
    assert of(spark, rows, block=block, chunk=chunk) == plain(rows)


@pytest.mark.parametrize("low", [-math.inf, -50.0, 0.0, 400.0, 9000.0])
def test_index_returns_every_pair_at_the_threshold(low):
    rng = np.random.default_rng(3)
    rows, anchors = (np.floor(np.exp(-np.arange(30) / 6) * rng.normal(size=(n, 30)) * 90) for n in (900, 11))
    thresholds = low + np.arange(11.0) * 100
    scores = anchors @ rows.T
    a, r, s = negatives.Index(rows).reaching(anchors, thresholds)
    want = {(i, j) for i, j in zip(*np.nonzero(scores >= thresholds[:, None]))}
    assert set(zip(a.tolist(), r.tolist())) == want and (s == scores[a, r]).all()


def test_odd_rows(spark):
    rows = made(7, 60, 6, 3, True)
    odd = [
        (None, 1, [0.5] * 6), (100, None, [0.5] * 6), (110, 1, None), (120, 1, [0.5, None]), (130, 1, [math.nan]), (140, 2, [math.inf]),
        rows[0], rows[0], (200, 1, []), (210, 2, [0.25]), (220, 0, [0.5] * 9),
    ]
    assert of(spark, rows + odd) == plain(rows + odd[-3:])
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<float>, key int, windows string")
    assert sorted(tuple(r) for r in negatives.mined(df, F.expr(ANCHOR)).collect()) == plain(rows)
    assert negatives.mined(df.where("false"), F.expr(ANCHOR)).count() == 0
    assert of(spark, [r for r in rows if r[0] == 10]) == []


def test_large_components_are_exact(spark):
    rows = [(i, i % 2, [float(np.float32(2**19 + 99 * i)), float(i), 1.0]) for i in range(40)]
    assert of(spark, rows) == plain(rows)
    huge = [(i, i % 2, [1e30 * (i + 1)]) for i in range(12)]
    assert {r[4:] for r in of(spark, huge)} == set()  # all scores are the largest long, so no negative is in its window


def test_a_hot_label_and_copies(spark):
    random.seed(1)
    rows = [(i, 0 if i % 3 else random.randrange(5), [0.5, 0.25 * (i % 2), 0.125]) for i in range(300)]
    assert of(spark, rows, block=40) == plain(rows)

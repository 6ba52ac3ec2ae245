"""Hard negatives against brute force in Python integers."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.llm import hard_negatives

EXTRA = "vec_id long, embedding array<double>, label int, id string, dim int, block string, anchor int"


def frame(spark, rows):
    """Columns whose names clash with those that the operator uses."""
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], EXTRA).repartition(4)


def brute(rows, every, positives=5, negatives=3, least=50, most=95):
    one = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        one[i] = min(one.get(i, (label, v)), (label, v))
    whole = {i: (label, [math.floor(256 * Fraction(x)) for x in v]) for i, (label, v) in one.items()}
    clip = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
    for a, (label, v) in whole.items():
        if a % every:
            continue
        scores = sorted((-clip(sum(x * y for x, y in zip(v, w))), i, other) for i, (other, w) in whole.items() if i != a and len(w) == len(v))
        for s, p, _ in [x for x in scores if x[2] == label][:positives]:
            fit = [(n, i) for n, i, other in scores if other != label and least * -s <= 100 * -n <= most * -s][:negatives]
            for rank, (n, i) in enumerate(fit, 1):
                yield a, p, rank, i, -s, -n


def rows_of(seed, n=260, dim=6):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.4) for _ in range(dim)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)], rng.randint(0, 4)) for i in range(n)]
    rows += [(1000 + i, rows[3][1], i % 3) for i in range(n // 2)]  # a third of all rows are copies of one vector
    rows += [(None, [0.1] * dim, 1), (-20, [0.3] * dim, 0), (500, None, 1), (501, [0.1] * dim, None), (502, [None] + [0.1] * (dim - 1), 1), (503, [math.nan] * dim, 1), (504, [math.inf] * dim, 0),
             (700, [], 1), (701, [], 1), (702, [], 2), (800, [0.5, 0.25], 1), (801, [0.5, 0.5], 1), (802, [0.5, 0.3], 2), (520, [0.0] * dim, 3)]
    return rows + [rows[0], (rows[1][0], [9.0] * dim, 4), (rows[20][0], rows[20][1], 4)]


@pytest.mark.parametrize(("seed", "cells", "least_rows"), [(1, 1 << 20, 4096), (2, 150, 1), (3, 1 << 20, 20)])
def test_equals_brute_force(spark, seed, cells, least_rows):
    rows = rows_of(seed)
    got = hard_negatives.mine(frame(spark, rows), F.col("id") % 20 == 0, block_cells=cells, chunk_cells=cells, least_block_rows=least_rows).collect()
    assert sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got) == sorted(brute(rows, 20))


def test_large_components_stay_exact(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice([1, -1]) * rng.random() * 10 ** rng.choice([0, 4, 7]) for _ in range(4)], i % 3) for i in range(60)]
    rows += [(100 + i, [3e200 * (i + 1), -1.7e308, 0.004, 5.0], i % 2) for i in range(6)]
    got = hard_negatives.mine(frame(spark, rows), F.col("id") % 10 == 0).collect()
    assert sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got) == sorted(brute(rows, 10))


def test_reading_stops_before_the_end():
    rng = np.random.default_rng(1)
    rows = np.floor(256 * rng.normal(0, 0.01, (5000, 8)))
    rows[17] = rows[40] = 300
    lists = hard_negatives.Lists(rows)
    anchor, ids, labels = np.full(8, 256.0), np.arange(5000), np.zeros(5000, np.int64)
    seen = [len(new) for new, _, _ in lists.walk(anchor)]
    assert sum(seen) == 5000 and len(seen) > 2
    read = 0

    class Counted(hard_negatives.Lists):
        def walk(self, a):
            nonlocal read
            for step in super().walk(a):
                read += len(step[0])
                yield step

    found, scores = hard_negatives.top_positives(Counted(rows), ids, labels, anchor, -1, 0, 2)
    assert found.tolist() == [17, 40] and scores.tolist() == [8 * 300 * 256] * 2 and read < 500


def test_no_rows_and_no_anchors(spark):
    assert hard_negatives.mine(frame(spark, []), F.col("id") % 50 == 0).count() == 0
    assert hard_negatives.mine(frame(spark, rows_of(4)[:30]), F.col("id") == -1).count() == 0

"""Hard negatives against plain loops; bounds; edges; groups, blocks and clusters that do not change results."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import negatives


def brute(rows, is_anchor, positives, k, low, high):
    """Loops over rows (id, vector, label)."""
    def usable(v, label):
        return label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)

    rows = list(dict.fromkeys((i, tuple(v), l) for i, v, l in rows if usable(v, l)))
    whole = [[math.floor(256 * x) for x in v] for _, v, _ in rows]
    out = []
    for a, (i, _, label) in enumerate(rows):
        if i is None or not is_anchor(i):
            continue
        scored = [
            (-max(-(1 << 56), min(1 << 56, sum(map(int.__mul__, whole[a], whole[b])))), rows[b][0] is None, rows[b][0] or 0, rows[b][2])
            for b in range(len(rows)) if b != a
        ]
        scored.sort(key=lambda x: x[:3])
        for p, p_null, p_id, _ in [x for x in scored if x[3] == label][:positives]:
            hard = [x for x in scored if x[3] != label and low * -p <= 100 * -x[0] <= high * -p][:k]
            for rank, (n, n_null, n_id, _) in enumerate(hard, 1):
                out.append((i, None if p_null else p_id, rank, None if n_null else n_id, -p, -n))
    return sorted(out, key=repr)


def mined(spark, rows, **limits):
    full = [(i, v, l, "x", 1, 2, "y", 0, 3) for i, v, l in rows]
    kind = "vec_id long, embedding array<double>, label int, id string, row int, block int, group string, cluster int, rank int"
    found = negatives.hard_negatives(spark.createDataFrame(full, kind), F.col("id") % 5 == 0, F.col("label"), **limits)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def vectors(seed, n=160, width=6):
    dice = random.Random(seed)
    centres = [[dice.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    rows = [(i, [c + dice.gauss(0, 0.4) for c in dice.choice(centres)], dice.randint(0, 3)) for i in range(n)]
    same = [0.5] * width
    return rows + [(n + i, same, i % 3) for i in range(60)]  # a third of all rows are one vector


@pytest.mark.parametrize("seed, limits", [
    (1, {}), (2, {"block_rows": 30, "group_rows": 7, "cluster_rows": 4}), (3, {"block_rows": 50, "group_rows": 3, "cluster_rows": 50}),
    (4, {"positives": 2, "negatives": 3, "low": 10, "high": 100}),
])
def test_against_loops(spark, seed, limits):
    rows = vectors(seed)
    use = {"positives": 5, "negatives": 10, "low": 30, "high": 90} | {k: v for k, v in limits.items() if not k.endswith("rows")}
    want = brute(rows, lambda i: i % 5 == 0, use["positives"], use["negatives"], use["low"], use["high"])
    assert want
    assert mined(spark, rows, **limits) == want


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(5, 40) + [
        (None, [0.5] * 6, 1), (None, [0.5] * 6, 2), (5, [0.5] * 6, 1), (5, [0.5] * 6, 1), (5, [0.4] * 6, 1), (1000, None, 1),
        (1005, [0.1], None), (1010, [None, 1.0], 1), (1015, [nan], 1), (1020, [inf, 1.0], 1), (1025, [], 2), (1030, [2.0], 2),
        (1035, [0.0] * 6, 1), (1040, [1e150] * 6, 1), (1045, [-3e7] * 6, 2), (2**60, [0.3] * 6, 2), (2**60 + 5, [0.3] * 6, 3),
    ]
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0, 5, 10, 30, 90)
    assert mined(spark, rows, block_rows=16, group_rows=4, cluster_rows=2) == brute(rows, lambda i: i % 5 == 0, 5, 10, 30, 90)
    assert mined(spark, []) == []


def test_bounds_hold_and_end_walks_early():
    dice = np.random.default_rng(0)
    members = np.floor(256 * (np.eye(8)[0] + 0.05 * dice.normal(size=(20, 8))))
    candidates = np.floor(256 * dice.normal(size=(3000, 8)))
    centre = negatives.fit_centres(members, 1)[0]
    order, bound = negatives.shared_list(members, candidates, centre)
    scores = members @ candidates[order].T / np.linalg.norm(members, axis=1)[:, None]
    assert (scores <= bound + 1e-9 * abs(bound)).all() and (np.diff(bound) <= 0).all()
    seen = itertools.count()
    done = lambda active, ahead: np.full(len(active), next(seen) == 1)
    steps = []
    negatives._walk(members, candidates, centre, lambda active, rows, found: steps.append(len(rows)), done)
    assert steps == [negatives.SLICE] * 2
    best = negatives._Best(1, 5, np.arange(3000))
    best.add(np.zeros(3000, int), (members[:1] @ candidates.T)[0].astype(int), np.arange(3000))
    assert (bound * np.linalg.norm(members[0]) < best.worst[0]).mean() > 0.5  # most of the list need not be walked

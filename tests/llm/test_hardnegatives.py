"""Mined negatives against brute force; the tree keeps what counts; edge rows."""

import math
import random

import cases
import numpy as np
import pytest
from passbook.llm import hardnegatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, every):
    taken = []
    for number, vector, label in rows:
        if None in (number, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if number % 7 == 0 else label
        taken.append((number, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    taken = list(dict.fromkeys(taken))
    out = []
    for anchor, own, a in taken:
        if anchor % every:
            continue
        ranked = sorted((-sum(x * y for x, y in zip(a, v)), n, label) for n, label, v in taken if n != anchor)
        for p, positive, _ in [r for r in ranked if r[2] == own][:5]:
            near = [r for r in ranked if r[2] != own and -30 * p <= -100 * r[0] <= -90 * p]
            out += [(anchor, positive, k, n, -p, -s) for k, (s, n, _) in enumerate(near[:10], 1)]
    return sorted(out, key=repr)


def vectors(seed, n, width=6, spread=0.3):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    rows = []
    for i in range(n):
        centre = rnd.choice(centres)
        rows.append((i, [round(x + rnd.gauss(0, spread), 3) for x in centre], rnd.randrange(3)))
    return rows


@pytest.mark.parametrize("seed, ways, chunk", [(0, 4, 20), (1, 3, 1000), (2, 8, 7)])
def test_equals_brute_force(spark, seed, ways, chunk):
    rows = vectors(seed, 400)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = hn.hard_negatives(frame, every=20, sample_rows=60, ways=ways, chunk=chunk)
    assert cases.bag(found, *COLUMNS) == brute(rows, 20) and found.count() > 100


def test_the_tree_eliminates_leaves(spark):
    """Clustered rows: most leaves of most anchors are never visited, and nothing is missed (see above)."""
    rows = vectors(5, 600, width=4, spread=0.02)
    found = hn.index(hn.prepared(spark.createDataFrame(rows, SCHEMA)), sample_rows=100, ways=5)
    tree = found.tree
    table = np.array([[math.floor(256 * x) for x in v] for _, v, _ in rows], dtype=float)
    leaf = tree.leaf_of(hn.extended(table, tree.longest))
    visited = 0
    for a in table[::30]:
        far = hn.distances(hn.extended(table, tree.longest), np.append(a, 0.0)[None, :])[:, 0]
        ring = (float(np.sort(far)[0]), float(np.sort(far)[20]))
        reached = set(tree.reached(np.append(a, 0.0), [ring]))
        assert set(leaf[(far >= ring[0]) & (far <= ring[1])]) <= reached
        visited += len(reached)
    assert visited < 0.6 * tree.leaves * len(table[::30])


def test_edge_rows(spark):
    same = [0.5, 0.25, -0.125]
    rows = [(i, same, i % 3) for i in range(0, 90)] + [(i, same, 1) for i in (100, 100, 100, 200)]
    rows += [(None, same, 1), (300, None, 1), (400, same, None), (500, [1.0, None, 2.0], 1), (600, [float("nan"), 0.0, 0.0], 1)]
    rows += [(700, [float("inf"), 0.0, 0.0], 1), (800, [], 2), (801, [1.5], 2), (802, [0.0, 0.0, 0.0], 1), (900, [3.0, 2.0, 1.0, 4.0], 9)]
    rows += [(100, [0.75, 0.25, 0.5], 2), (1000, [-1.0, -1.0, -1.0], 1)]
    frame = spark.createDataFrame([(*r, "x", 1.5) for r in rows], f"{SCHEMA}, leaf string, score double")
    assert cases.bag(hn.hard_negatives(frame, sample_rows=10, ways=3, chunk=8), *COLUMNS) == brute(rows, 100)
    assert hn.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(i, [float(2**21 + i), 3.0 * i, 1.0], i % 2) for i in range(0, 60)]
    found = hn.hard_negatives(spark.createDataFrame(rows, SCHEMA), every=10, sample_rows=20, ways=3)
    assert cases.bag(found, *COLUMNS) == brute(rows, 10)

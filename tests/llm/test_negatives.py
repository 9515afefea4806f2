"""Hard negatives against brute force, with the tree ruling leaves out."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tastemap.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, positives=5, wanted=3, low=50, high=95, every=10):
    usable = []
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None or any(
                x is None or not math.isfinite(x) or not math.isfinite(256 * x) for x in vector):
            continue
        usable.append((vec_id, label, [math.floor(256 * x) for x in vector]))
    found = []
    for a, (anchor, label, vector) in enumerate(usable):
        if anchor % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(vector, other)), i, same == label)
                        for b, (i, same, other) in enumerate(usable) if a != b)
        for score, positive, _ in [s for s in scored if s[2]][:positives]:
            inside = [s for s in scored if not s[2] and low * -score <= 100 * -s[0] <= high * -score]
            found += [(anchor, positive, rank, i, -score, -s)
                      for rank, (s, i, _) in enumerate(inside[:wanted], 1)]
    return sorted(found)


def mined(df, **options):
    return sorted(map(tuple, negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, **options)
                      .collect()))


@pytest.fixture(scope="module")
def clusters():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 6))
    rows = [(i, int(rng.integers(0, 4)), (centres[i % 12] + 0.1 * rng.normal(size=6)).tolist())
            for i in range(700)]
    # Equal vectors, also of several labels, and one third of all rows alike.
    rows += [(1000 + i, i % 3, rows[0][2]) for i in range(120)]
    return rows + [(2000 + i, i % 2, rows[5][2]) for i in range(300)]


@pytest.mark.parametrize("leaf, block", [(32, 8192), (4, 50), (2, 1)])
def test_as_by_brute_force(spark, monkeypatch, clusters, leaf, block):
    monkeypatch.setattr(negatives, "LEAF", leaf)
    monkeypatch.setattr(negatives, "BLOCK", block)
    rows = clusters if block > 1 else clusters[:150]
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_other_parameters(spark, clusters):
    rows = clusters[:400]
    found = mined(spark.createDataFrame(rows, SCHEMA), positives=2, negatives=1, low=20, high=60)
    assert found == brute(rows, 2, 1, 20, 60)


def test_the_tree_rules_leaves_out(clusters):
    """Most leaves fall away, and none that holds a row of a window."""
    whole = np.floor(256 * np.array([r[2] for r in clusters]))
    length = int((whole * whole).sum(axis=1).max())
    longer = negatives._longer(whole, length)
    tree = negatives.build(np.unique(longer, axis=0), 6, length)
    leaf = negatives._descend(tree, longer, None)

    def seen(at, products, side):
        away = np.sqrt(np.maximum(0, 2 * (length - products)))
        node = tree.nodes[at]
        for j in np.unique(side):
            node.least[:, j] = away[side == j].min(axis=0)
            node.most[:, j] = away[side == j].max(axis=0)

    negatives._descend(tree, longer, seen)
    tree.labels = [(0, 3, -1)] * tree.leaves
    some = whole[:60]
    scores = some @ whole.T
    low = np.sort(scores, axis=1)[:, -20].astype(int)
    batch = pa.record_batch([pa.array([negatives._pack(v) for v in some]), pa.array([6] * 60),
                             pa.array([9] * 60), pa.array([[x] for x in low]),
                             pa.array([[negatives.ANY]] * 60)],
                            ["vector", "dim", "label", "low", "high"])
    left = negatives._not_ruled_out(tree, batch, same=False)
    assert np.mean([len(x) for x in left]) < 0.5 * tree.leaves
    for row in range(60):
        assert set(leaf[scores[row] >= low[row]]) <= set(left[row])


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (2, 2, [0.9, 0.4]),
            (3, 2, [0.5, None]), (4, None, [0.5, 0.5]), (5, 2, None), (None, 2, [0.9, 0.4]),
            (6, 2, [nan, 0.5]), (7, 2, [inf, 0.5]), (8, 2, []), (9, 2, [0.6]), (10, 2, [-1.0, -0.5]),
            (10, 1, [0.7, 0.1]), (11, -3, [0.0, 0.0]), (12, 2, [1e307, 0.1])]
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {n: F.lit(None).cast("int") for n in ("node", "id", "block", "anchor", "leaf", "`a b.c`")})
    assert mined(df) == brute(rows)
    assert mined(df.limit(0)) == []
    with pytest.raises(ValueError, match="2.50"):
        mined(spark.createDataFrame([(0, 1, [1e9])], SCHEMA))

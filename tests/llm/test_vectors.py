"""Near-duplicate vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastemap.llm import vectors

SCHEMA = "vec_id long, embedding array<double>, label string"


def brute(rows, threshold):
    """Links and component of each row by comparing all with all."""
    valid = []
    for i, (_, vector, label) in enumerate(rows):
        if label is not None and vector and None not in vector:
            x = np.array(vector, float)
            if np.isfinite(x).all() and x.any():
                x = x / np.abs(x).max()
                valid.append((i, x / np.linalg.norm(x), label))
    head, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    for a in range(len(valid)):
        for b in range(a):
            (i, x, one), (j, y, two) = valid[a], valid[b]
            if one == two and len(x) == len(y) and float(x @ y) >= threshold:
                links[i] += 1
                links[j] += 1
                head[max(find(i), find(j))] = min(find(i), find(j))
    smallest = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            smallest[find(i)] = min(row[0], smallest.get(find(i), row[0]))
    return sorted((str(row[0]), links[i], str(smallest.get(find(i)))) for i, row in enumerate(rows))


def found(spark, rows, threshold=0.98):
    got = vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA), threshold).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    return sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got)


@pytest.mark.parametrize("threshold", [0.98, 0.8, -0.5])
def test_clusters_copies_and_labels(spark, threshold):
    random = np.random.default_rng(1)
    centers = random.normal(size=(12, 16))
    rows = []
    for i in range(160):
        x = centers[i % 12] + random.normal(size=16) * (0.02, 0.1, 0.5)[i % 3]
        rows.append((1000 - i, x.tolist(), "ab"[i % 2]))
    rows += [(2000 + i, rows[3][1], rows[3][2]) for i in range(9)]
    assert found(spark, rows, threshold) == brute(rows, threshold)


def test_many_small_tiles(spark, monkeypatch, many_slices):
    monkeypatch.setattr(vectors, "TILE_BYTES", 8 * 8 * 5)
    random = np.random.default_rng(2)
    rows = [(i, (random.normal(size=8) * np.r_[5, 3, np.ones(6) * 0.1]).tolist(), "x")
            for i in range(120)]
    assert found(spark, rows) == brute(rows, 0.98)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], "a"), (2, [2.0, 0.0], "a"), (3, [1.0, 0.0], None), (4, None, "a"),
            (5, [0.0, 0.0], "a"), (6, [1.0, nan], "a"), (7, [inf, 0.0], "a"), (8, [], "a"),
            (9, [1.0, None], "a"), (10, [1.0, 0.0], "b"), (None, [1.0, 1e-9], "a"),
            (None, None, None), (2, [2.0, 0.0], "a"), (11, [1.0, 0.0, 0.0], "a"),
            (12, [1e-200, 0.0], "a"), (13, [1e200, 0.0], "a"), (14, [-0.0, 0.0], "a")]
    assert found(spark, rows) == brute(rows, 0.98)


def test_no_vectors_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vectors.near_duplicates(empty).count() == 0
    rows = spark.createDataFrame([(1, [1.0], "a"), (2, [1.0], "a")], SCHEMA)
    more = rows.withColumns({n: F.lit(1) for n in ("node", "digest", "n", "tile", "links")})
    assert [r.n_links for r in vectors.near_duplicates(more).collect()] == [1, 1]


def test_early_stops_lose_no_pair():
    random = np.random.default_rng(5)
    x = random.normal(size=(200, 40)) * np.linspace(3, 0.2, 40)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j = vectors.near_pairs(x, x, 0.7)
    expected = np.argwhere(x @ x.T >= 0.7)
    assert set(map(tuple, expected)) <= set(zip(i.tolist(), j.tolist()))


def test_query_against_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    data = [(r.vec_id, [float(v) for v in r.embedding], str(r.label)) for r in rows.collect()]
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id))
                 for r in vectors.near_duplicates(rows).collect())
    assert got == brute(data, 0.98)

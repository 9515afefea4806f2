"""Near-duplicate vectors by PCA-ordered tiles.

Unit vectors are turned to their principal axes, which changes no product.
Products add up from the leading axes on; what the other axes can still add is
bounded by the norms of the rest, and a pair is given up when its cosine cannot
reach the threshold. Tiles are runs of vectors sorted by their place on the leading
axes, and tiles too far apart there are never brought together.
"""

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.llm.shared import components, join_groups, ship_code
from tastemap.sources.durable import durable

# Bytes of vectors in a tile, rows of a block compared at once, leading axes of a tile's box.
TILE_BYTES = 4 << 20
BLOCK = 1024
BOX = 3
# Sums are exact to about this; closer calls are decided by the given vectors.
SLACK = 1e-9

PREPARED = "vec_id long, label string, digest binary, vector array<double>"
TILED = "label string, tile long, node long, n long, vector array<double>, " + ", ".join(
    f"y{i} double" for i in range(BOX))


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every vector.

    Two vectors are linked if their labels are equal and not null and their
    cosine in double precision is at least ``threshold``. Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing, nor do
    vectors of different lengths. ``n_links`` counts other rows, copies included;
    ``component_id`` is the smallest id reachable, ``kept`` whether that is the
    row's own. Repeated rows are vectors of their own, a null id is never the
    smallest unless alone; no vectors give no rows.
    """
    ship_code(vectors.sparkSession)
    rows = durable(vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector")).mapInArrow(_prepare, PREPARED))
    # Equal vectors are compared once. Their number is all that is kept of a group of copies.
    different = (rows.where("digest IS NOT NULL").groupBy("digest")
                 .agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"),
                      F.first("label").alias("label"), F.first("vector").alias("vector")))
    different = durable(different.withColumn("node", F.monotonically_increasing_id()))
    found = durable(_links(different, threshold))
    degrees = found.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = components(found.where("head IS NOT NULL").select(
        F.col("node").alias("a"), F.col("head").alias("b")))
    classes = (different.select("digest", "node", "n", "least")
               .join(degrees, "node", "left").join(grouped, "node", "left")
               .select("digest", "least", F.coalesce("component", "node").alias("component"),
                       (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = classes.join(least, "component").select("digest", "n_links", "component_id")
    judged = rows.select("vec_id", "digest").join(classes, "digest", "left")
    own = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return judged.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"))


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of label and vector for those that can be linked; the others have none."""
    for batch in batches:
        digests, vectors = [], []
        for label, vector in zip(batch.column("label").to_pylist(), batch.column("vector")):
            values = vector.values
            digest = None
            if label is not None and values is not None and len(values) and not values.null_count:
                x = values.to_numpy(zero_copy_only=False) + 0.0
                if np.isfinite(x).all() and x.any():
                    digest = blake2b(x.tobytes() + label.encode(), digest_size=16).digest()
            digests.append(digest)
            vectors.append(None if digest is None else x)
        yield pa.record_batch(
            [batch.column("vec_id"), batch.column("label"), pa.array(digests, pa.binary()),
             pa.array(vectors, pa.list_(pa.float64()))], ["vec_id", "label", "digest", "vector"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows to norm 1; scaled first, so that no square is too large or too small."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(different: DataFrame, size: int) -> np.ndarray:
    """Axes of the unit vectors of ``size`` components, the one of most variance first.

    Each task adds up its products; the driver gets ``size`` squared sums.
    """
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((size + 1, size + 1)), 0
        for batch in batches:
            x = _unit(_matrix(batch.column("vector")))
            x = np.c_[x, np.ones(len(x))]
            total += x.T @ x
            n += len(x)
        if n:
            yield pa.record_batch([pa.array(np.arange(total.size)), pa.array(total.ravel())],
                                  ["place", "value"])

    sums = (different.where(F.size("vector") == size).select("vector")
            .mapInArrow(products, "place long, value double")
            .groupBy("place").agg(F.sum("value")).collect())
    total = np.zeros((size + 1) ** 2)
    for place, value in sums:
        total[place] = value
    total = total.reshape(size + 1, size + 1)
    mean = total[-1, :-1] / max(1.0, total[-1, -1])
    covariance = total[:-1, :-1] / max(1.0, total[-1, -1]) - np.outer(mean, mean)
    return np.linalg.eigh(covariance)[1][:, ::-1]


def _links(different: DataFrame, threshold: float) -> DataFrame:
    """``node, links, head``: for each tile a node was compared with, the rows linked
    to it there, and a node of the same component."""
    sizes = [r[0] for r in different.select(F.size("vector")).distinct().collect()]
    schema = "node long, links long, head long"
    found = different.sparkSession.createDataFrame([], schema)
    for size in sizes:
        found = found.unionByName(_links_of(different.where(F.size("vector") == size), size,
                                            threshold))
    return found


def _links_of(different: DataFrame, size: int, threshold: float) -> DataFrame:
    axes = principal_axes(different, size)
    # Unit vectors of that cosine are no farther apart than this, on all axes together.
    reach = max(0.0, 2 - 2 * threshold) ** 0.5 + SLACK
    rows = max(1, TILE_BYTES // (8 * size))
    tiles = durable(_tiles(different, axes, reach, rows))
    pairs = _tile_pairs(tiles, reach)
    members = (pairs.join(tiles.select("tile", "node", "n", "vector"), "tile")
               .repartition("tile_a", "tile_b")
               .sortWithinPartitions("tile_a", "tile_b", "tile"))
    return members.mapInArrow(lambda batches: _compare(batches, axes, threshold),
                              "node long, links long, head long")


def _tiles(different: DataFrame, axes: np.ndarray, reach: float, rows: int) -> DataFrame:
    """Vectors of one label sorted by cells of the leading axes, cut into tiles."""
    leading = axes[:, :BOX]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _unit(_matrix(batch.column("vector"))) @ leading
            y = np.c_[y, np.zeros((len(y), BOX - y.shape[1]))]
            yield pa.record_batch([*batch.columns, *map(pa.array, y.T.copy())],
                                  [*batch.schema.names, *(f"y{i}" for i in range(BOX))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, label, used = (TaskContext.get().partitionId() << 32) - 1, None, 0
        for batch in batches:
            names = []
            for here in batch.column("label").to_pylist():
                if here != label or used == rows:
                    tile, label, used = tile + 1, here, 0
                used += 1
                names.append(tile)
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns["tile"] = pa.array(names, pa.int64())
            order = [f.split()[0] for f in TILED.split(", ")]
            yield pa.record_batch([columns[n] for n in order], order)

    placed = durable(different.select("label", "node", "n", "vector").mapInArrow(
        place, TILED.replace("tile long, ", "")))
    width = max(reach, 0.01)
    keys = ["label", *(F.floor(F.col(f"y{i}") / width) for i in range(BOX)), "y0", "node"]
    return placed.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(cut, TILED)


def _tile_pairs(tiles: DataFrame, reach: float) -> DataFrame:
    """``tile_a, tile_b, tile``: pairs of tiles of one label whose boxes are within reach."""
    boxes = durable(tiles.groupBy("label", "tile").agg(
        *(f(f"y{i}").alias(f"{name}{i}") for i in range(BOX)
          for name, f in (("low", F.min), ("high", F.max)))))
    width = max(reach, 0.01)
    cell = {name: F.floor(F.col(f"{name}0") / width) for name in ("low", "high")}
    side = {end: boxes.withColumnRenamed("label", f"label_{end}").withColumn(
        f"cell_{end}", F.explode(F.sequence(cell["low"] - more, cell["high"] + more)))
        .withColumnsRenamed({c: f"{c}_{end}" for c in boxes.columns if c != "label"})
        for end, more in (("a", 0), ("b", 1))}
    gaps = [F.greatest(F.col(f"low{i}_b") - F.col(f"high{i}_a"),
                       F.col(f"low{i}_a") - F.col(f"high{i}_b"), F.lit(0.0)) for i in range(BOX)]
    near = sum((g * g for g in gaps), F.lit(0.0)) <= reach * reach
    pairs = (side["a"].join(side["b"], (F.col("label_a") == F.col("label_b"))
                            & (F.col("cell_a") == F.col("cell_b")))
             .where((F.col("tile_a") <= F.col("tile_b")) & near)
             .select("tile_a", "tile_b").distinct())
    return pairs.select("tile_a", "tile_b", F.explode(F.array_distinct(
        F.array("tile_a", "tile_b"))).alias("tile"))


def _compare(batches: Iterator[pa.RecordBatch], axes: np.ndarray,
             threshold: float) -> Iterator[pa.RecordBatch]:
    """Links between the two tiles of each pair; the rows of a pair come together."""
    waiting: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        a, b = (batch.column(n).to_numpy() for n in ("tile_a", "tile_b"))
        starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        for first, stop in zip(starts, [*starts[1:], len(a)]):
            if waiting and key != (a[first], b[first]):
                yield _compare_pair(waiting, axes, threshold)
                waiting = []
            key = (a[first], b[first])
            waiting.append(batch.slice(first, stop - first))
    if waiting:
        yield _compare_pair(waiting, axes, threshold)


def _compare_pair(parts: list[pa.RecordBatch], axes: np.ndarray,
                  threshold: float) -> pa.RecordBatch:
    rows = pa.Table.from_batches(parts).combine_chunks()
    given = _matrix(rows.column("vector").chunk(0))
    turned = _unit(given) @ axes
    n, node = rows.column("n").to_numpy(), rows.column("node").to_numpy()
    tile = rows.column("tile").to_numpy()
    one = np.flatnonzero(tile == rows.column("tile_a")[0].as_py())
    two = np.flatnonzero(tile == rows.column("tile_b")[0].as_py())
    same = len(one) == len(tile)
    links, head = np.zeros(len(tile), np.int64), np.arange(len(tile))
    for at in range(0, len(one), BLOCK):
        for to in range(at if same else 0, len(two), BLOCK):
            i, j = near_pairs(turned[one[at:at + BLOCK]], turned[two[to:to + BLOCK]], threshold)
            i, j = one[at + i], two[to + j]
            if same:
                i, j = i[i < j], j[i < j]
            i, j = _sure(given, turned, i, j, threshold)
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            join_groups(head, i, j)
    found = np.flatnonzero(links)
    heads = np.where(head[found] == found, -1, node[head[found]])
    return pa.record_batch([pa.array(node[found]), pa.array(links[found]),
                            pa.array(heads, mask=heads < 0)], ["node", "links", "head"])


def near_pairs(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of unit vectors, axes of most variance first, that may reach ``threshold``.

    Products of a few leading axes come first; a pair stays while its sum and the
    norms of the axes to come can reach the threshold.
    """
    size = x.shape[1]
    least = threshold - SLACK
    done = min(8, size)
    total = x[:, :done] @ y[:, :done].T
    rest = (_norms(x, done)[:, None] * _norms(y, done)[None, :])
    i, j = np.nonzero(total + rest >= least)
    total = total[i, j]
    while done < size and len(i):
        step = slice(done, min(2 * done, size))
        parts = [np.einsum("ij,ij->i", x[i[k:k + (1 << 16)], step], y[j[k:k + (1 << 16)], step])
                 for k in range(0, len(i), 1 << 16)]
        total = total + np.concatenate(parts)
        done = step.stop
        stays = total + _norms(x, done)[i] * _norms(y, done)[j] >= least
        i, j, total = i[stays], j[stays], total[stays]
    return i, j


def _norms(x: np.ndarray, first: int) -> np.ndarray:
    return np.sqrt((x[:, first:] ** 2).sum(axis=1))


def _sure(given: np.ndarray, turned: np.ndarray, i: np.ndarray, j: np.ndarray,
          threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that reach the threshold; those close to it by the vectors as given."""
    cosine = np.concatenate([np.einsum("ij,ij->i", turned[i[k:k + 65536]], turned[j[k:k + 65536]])
                             for k in range(0, len(i), 65536)] or [np.empty(0)])
    close = np.flatnonzero(np.abs(cosine - threshold) < SLACK)
    for k in close:
        x, y = given[i[k]], given[j[k]]
        x, y = x / np.abs(x).max(), y / np.abs(y).max()
        cosine[k] = (x @ y) / (np.linalg.norm(x) * np.linalg.norm(y))
    near = cosine >= threshold
    return i[near], j[near]

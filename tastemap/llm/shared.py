"""Helpers that several operators of this subpackage share."""

import tempfile
import zipfile
from collections.abc import Callable, Hashable, Iterator
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType
from xxhash import xxh3_128_digest

from tastemap.sources.durable import durable
from tastemap.sources.tables import read_table

# Rows that must be numbered are dealt into this many cells.
CELLS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once a session."""
    context = spark.sparkContext
    if getattr(context, "_tastemap_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    bundle = Path(tempfile.mkdtemp(prefix="tastemap-code-")) / "tastemap_code.zip"
    with zipfile.ZipFile(bundle, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(bundle))
    context._tastemap_shipped = True


# What a Python worker keeps from task to task for the operator at work.
_kept: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """``make()``, called once a worker and then kept until :func:`let_go`."""
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def let_go() -> None:
    """Drop what the worker keeps for an operator before this one, and Arrow's spare memory.

    Workers outlive the stage they were started for; tasks that hold much call this first.
    """
    _kept.clear()
    pa.default_memory_pool().release_unused()


def row_key(row_id: int | None, text: bytes | None) -> bytes:
    """A row's identity wherever it is read; only rows with equal id and text share it."""
    mark = b"-" if text is None else b"+"
    return xxh3_128_digest(repr(row_id).encode() + mark + (text or b""))


def with_row_key(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[str]]:
    """``df`` under column names that clash with nothing, with its :func:`row_key` as ``_doc``."""
    ship_code(df.sparkSession)
    names = [f"_c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*names)
    schema = StructType([*plain.schema.fields, StructField("_doc", BinaryType())])
    row_id, text = (F.col(names[df.columns.index(c)]) for c in (id_col, text_col))
    wide = plain.withColumns({"_id": row_id.cast("long"), "_bytes": text.cast("binary")})

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            found = list(map(row_key, batch.column("_id").to_pylist(),
                             batch.column("_bytes").to_pylist()))
            yield pa.record_batch([*(batch.column(n) for n in names), pa.array(found, pa.binary())],
                                  schema.names)

    return wide.mapInArrow(key, schema), names


def rows_that_stay(docs: DataFrame, stays: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose :func:`row_key` is in ``_doc`` of ``stays``, each key once."""
    rows, names = with_row_key(docs, id_col, text_col)
    kept = rows.join(stays, "_doc")
    # A repeated row has its key in common with the one that stays.
    first = F.row_number().over(Window.partitionBy("_doc").orderBy("_doc"))
    return kept.withColumn("_copy", first).where("_copy = 1").select(*names).toDF(*docs.columns)


def cell() -> "F.Column":
    """An even deal of rows into cells, whatever their values. Write it out before using it twice."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(CELLS)).cast("int")


def number_rows(df: DataFrame, keys: list[str], order: list, name: str) -> DataFrame:
    """``df`` with ``name`` = 0, 1, 2... within each value of ``keys``.

    ``df`` must be a written table with a column ``cell`` as given by :func:`cell`.
    Counts per key and cell give each cell its first number; only rows of one key
    and one cell are sorted together, so a key with a third of all rows is dealt
    over all cells. Rows with equal ``order`` are numbered in any order.
    """
    counts = df.groupBy(*keys, "cell").agg(F.count(F.lit(1)).alias("_n"))
    before = (Window.partitionBy(*keys).orderBy("cell")
              .rowsBetween(Window.unboundedPreceding, -1))
    firsts = counts.select(*keys, "cell", F.coalesce(F.sum("_n").over(before), F.lit(0))
                           .alias("_first"))
    inside = Window.partitionBy(*keys, "cell").orderBy(*order)
    return (df.withColumn("_inside", F.row_number().over(inside) - 1)
            .join(firsts, [*keys, "cell"])
            .withColumn(name, (F.col("_first") + F.col("_inside")).cast("bigint"))
            .drop("_first", "_inside"))


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of the undirected ``edges`` ``(a, b)``.

    The component is the smallest node reachable. Large-star and small-star steps
    take turns until no edge changes; each step is an aggregation with map-side
    combine and a join, and its edges are written out, so neither a hub nor a
    lost executor stops it. Nodes are 64-bit integers; loops and repeated edges
    do no harm; no edges give no rows.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = durable(edges.where("u != v").distinct())
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state[0] == 0 or state == seen:
            break
        seen = state
        edges = durable(_small_star(_large_star(edges)))
    roots = edges.select("v").distinct().select(F.col("v").alias("node"),
                                                F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Written out: a join of two plain shuffles can split the rows of a hub.
    least = durable(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = durable(edges.groupBy("u").agg(F.min("v").alias("m")))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"),
                                                         F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def join_groups(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union-find on an array: join the groups of ``a`` and ``b``.

    A group's label is the first place in it.
    """
    while len(a):
        one, two = label[a], label[b]
        apart = one != two
        if not apart.any():
            return
        np.minimum.at(label, np.maximum(one, two)[apart], np.minimum(one, two)[apart])
        while not np.array_equal(higher := label[label], label):
            label[:] = higher

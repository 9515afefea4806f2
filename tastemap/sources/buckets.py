"""Tables stored in sorted buckets of a key, known by their path alone.

Spark keeps a table's buckets in its catalog, which ends with the session. Here a note
beside the files has them, so any session can open the table and join or aggregate by
the key without moving a row.
"""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tastemap.sources.tables import check_target

NOTE = "_buckets.json"


def write_buckets(df: DataFrame, path: str, key: str, buckets: int, sources=()) -> None:
    """Write ``df`` to a new folder in so many ``buckets`` of ``key``, one file each, sorted."""
    spark = df.sparkSession
    check_target(spark, path, sources)
    note, store = _note(spark, path)
    if store.exists(note.getParent()):
        raise FileExistsError(f"{path} is there; add rows with append_buckets")
    name = _name()
    # Rows are dealt out as the buckets will be, so that each task writes one of them.
    try:
        (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
         .option("path", path).saveAsTable(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    out = store.create(note, True)
    try:
        out.write(bytearray(json.dumps({"key": key, "buckets": buckets,
                                        "schema": df.schema.jsonValue()}).encode()))
    finally:
        out.close()


def append_buckets(df: DataFrame, path: str) -> None:
    """Add rows of the same columns, a further file per bucket."""
    spark = df.sparkSession
    held = bucket_note(spark, path)
    columns = StructType.fromJson(held["schema"]).names
    if sorted(columns) != sorted(df.columns):
        raise ValueError(f"columns are {columns}, not {df.columns}")
    name = _register(spark, path, held)
    try:
        df.select(*columns).repartition(held["buckets"], held["key"]).write.insertInto(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is now, with its buckets known to the planner."""
    name = _register(spark, path, bucket_note(spark, path))
    df = spark.table(name)
    # The DataFrame holds files and buckets itself; the name was only needed to get there.
    spark.sql(f"DROP TABLE {name}")
    return df


def bucket_note(spark: SparkSession, path: str) -> dict:
    """Key, number of buckets and schema."""
    note, store = _note(spark, path)
    if not store.exists(note):
        raise FileNotFoundError(f"{path} has no buckets")
    return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(store.open(note), "UTF-8"))


def _note(spark: SparkSession, path: str):
    note = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{NOTE}")
    return note, note.getFileSystem(spark._jsc.hadoopConfiguration())


def _name() -> str:
    return f"tastemap_buckets_{uuid.uuid4().hex}"


def _register(spark: SparkSession, path: str, held: dict) -> str:
    name = _name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                        for f in StructType.fromJson(held["schema"]).fields)
    key = f"`{held['key']}`"
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) "
              f"SORTED BY ({key}) INTO {held['buckets']} BUCKETS LOCATION '{place}'")
    return name

"""Table scans and overwrite sinks for any Spark data source."""

import os

from pyspark.sql import DataFrame, SparkSession

# Options by which data sources name the table to write.
TARGET_OPTIONS = ("path", "uri", "connection.uri", "collection", "table", "dbtable")


def read_table(spark: SparkSession, target: str, fmt: str = "parquet", schema=None,
               target_option: str = "path", **options) -> DataFrame:
    """Scan ``target``. Give ``schema`` for text formats, so that no pass infers it.

    A connector that names its table by another option takes ``target_option``,
    such as ``"uri"`` for a document store.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if target_option == "path":
        return reader.load(target)
    return reader.option(target_option, target).load()


def spread(scan: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal out the rows of a scan over so many ``partitions``; None leaves it as it is.

    For work that costs much more per row than moving the row, on a table of
    few or unsplittable files.
    """
    return scan if partitions is None else scan.repartition(partitions)


def check_target(spark: SparkSession, target: str, sources=()) -> None:
    """Refuse a ``target`` path that is, holds or lies in one of the ``sources``.

    Paths are resolved first: by the session's file systems, ``.`` and ``..``
    and, on local disks, symbolic links.
    """
    at = _resolved(spark, target)
    for source in sources:
        other = _resolved(spark, source)
        if at[0] == other[0] and (at[1] + "/").startswith(other[1] + "/") \
                or at[0] == other[0] and (other[1] + "/").startswith(at[1] + "/"):
            raise ValueError(f"{target} would overwrite {source}, a source of this job")


def _resolved(spark: SparkSession, path: str) -> tuple[str, str]:
    """Store and plain path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    qualified = store.makeQualified(place)
    if store.exists(qualified):
        qualified = store.resolvePath(qualified)
    uri = qualified.toUri()
    plain = uri.getPath()
    if uri.getScheme() == "file":
        plain = os.path.realpath(plain)
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}", plain.rstrip("/")


def write_table(df: DataFrame, target: str, fmt: str = "parquet", mode: str = "overwrite",
                target_option: str = "path", sources=(), **options) -> None:
    """Replace ``target`` by ``df``.

    There is exactly one target: a second one among the options is refused, and
    so is a target that is, holds or lies in one of the ``sources`` of the job.
    """
    rivals = [o for o in TARGET_OPTIONS if o in options and o != target_option]
    if rivals:
        raise ValueError(f"two targets: {target_option} and {', '.join(rivals)}")
    if target_option == "path":
        check_target(df.sparkSession, target, sources)
    elif target in sources:
        raise ValueError(f"{target} would overwrite a source of this job")
    writer = df.write.format(fmt).mode(mode).options(**options)
    if target_option == "path":
        writer.save(target)
    else:
        writer.option(target_option, target).save()

"""Exports for the map page."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.operators.ranking import take_rows
from tastemap.sources.tables import check_target


def first_points(df: DataFrame, key: str, n: int = 1000) -> DataFrame:
    """The ``n`` rows of lowest ``key``, which identifies a row; still distributed."""
    return take_rows(df, key, n)


def point_lines(df: DataFrame, key: str, n: int = 1000) -> DataFrame:
    """The first ``n`` rows as JSON objects in the order of ``key``, NULL members included."""
    rows = first_points(df, key, n).repartitionByRange(key).sortWithinPartitions(key)
    columns = [key] + [c for c in df.columns if c != key]
    return rows.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))


def export_points(df: DataFrame, path: str, key: str, n: int = 1000, sources=()) -> None:
    """Write the first ``n`` rows to the folder ``path``, one JSON object a line."""
    check_target(df.sparkSession, path, sources)
    point_lines(df, key, n).write.mode("overwrite").text(path)


def export_page(df: DataFrame, file: str, key: str, n: int = 1000, sources=()) -> None:
    """Write the first ``n`` rows to one ``file`` as a JSON array, for a page to import.

    The rows pass through the driver one partition after the other; how many a
    page is given is the caller's choice.
    """
    spark = SparkSession.active()
    check_target(spark, file, sources)
    place = spark._jvm.org.apache.hadoop.fs.Path(file)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    try:
        before = "["
        for row in point_lines(df, key, n).toLocalIterator():
            out.write(bytearray(f"{before}\n{row.value}".encode()))
            before = ","
        out.write(bytearray(b"[]" if before == "[" else b"\n]"))
    finally:
        out.close()

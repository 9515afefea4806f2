import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tastemap.sources.durable import durable, intermediates, shared_folder
from tastemap.sources.export import export_page, export_points
from tastemap.sources.schemas import BUSINESS, REVIEW, check_columns
from tastemap.sources.tables import check_target, read_table, spread, write_table


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_write_then_read(spark, tmp_path, fmt):
    df = spark.createDataFrame([("r1", "b1", "fine", 4.0), ("r2", "b2", "poor", 1.5)], REVIEW)
    target = str(tmp_path / "reviews")
    for _ in range(2):
        write_table(df, target, fmt)
    got = read_table(spark, target, fmt, REVIEW)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


def test_target_option(spark, tmp_path):
    df = spark.range(3)
    df.write.parquet(str(tmp_path / "t"))
    got = read_table(spark, str(tmp_path / "t"), "parquet", df.schema, target_option="path")
    assert got.count() == 3


def test_one_target_that_is_no_source(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="two targets"):
        write_table(df, "store://host/db.a", "parquet", target_option="uri", collection="b")
    for source in ("file:/data/a/", "/data/a", "/data/./b/../a", "/data/a/part", "/data"):
        with pytest.raises(ValueError, match="source"):
            write_table(df, "/data/a", sources=[source])


def test_targets_are_resolved(spark, tmp_path):
    (tmp_path / "table").mkdir()
    (tmp_path / "link").symlink_to(tmp_path / "table")
    for target, source in [(f"{tmp_path}/link", f"{tmp_path}/table"),
                           (f"{tmp_path}/table", f"file:{tmp_path}/link"),
                           (f"{tmp_path}/link/inner", f"{tmp_path}/table"),
                           (f"{tmp_path}/x/../table", f"{tmp_path}/table/")]:
        with pytest.raises(ValueError, match="source"):
            check_target(spark, target, [source])
    check_target(spark, f"{tmp_path}/table2", [f"{tmp_path}/table"])
    check_target(spark, f"{tmp_path}/new", [])


def test_intermediates_go_with_their_job(spark):
    from pathlib import Path
    folder = Path(shared_folder(spark))
    before = set(folder.iterdir())
    with intermediates(spark):
        kept = durable(spark.range(10))
        with intermediates(spark):
            durable(spark.range(5))
        assert kept.count() == 10 and len(set(folder.iterdir()) - before) == 1
    assert set(folder.iterdir()) == before


def test_check_columns(spark):
    df = spark.createDataFrame([("b", "NV", 4)], "business_id string, state string, stars int")
    assert check_columns(df, BUSINESS, ("business_id", "state", "stars")) is df
    with pytest.raises(ValueError, match="name is missing"):
        check_columns(df, BUSINESS)
    text = df.withColumn("stars", F.lit("four"))
    with pytest.raises(ValueError, match="stars is string, not a number"):
        check_columns(text, BUSINESS, ("stars",))


def test_durable_stays_as_it_was(spark):
    once = durable(spark.range(100).withColumn("r", F.rand()))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, once.collect()))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_cluster_must_name_its_shared_folder():
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(cluster)


def test_spread_is_up_to_the_caller(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    scan = read_table(spark, str(tmp_path / "one"))
    assert spread(scan) is scan
    assert spread(scan, 8).rdd.getNumPartitions() == 8 and spread(scan, 8).count() == 100


def test_exports(spark, tmp_path):
    rows = spark.createDataFrame([(3, None, {"a": 1}), (1, "x", None), (2, "é", {})],
                                 "id long, name string, more map<string,int>")
    export_points(rows.repartition(3), str(tmp_path / "lines"), "id", 2)
    lines = [line for p in sorted((tmp_path / "lines").glob("part-*"))
             for line in p.read_text().splitlines()]
    assert [json.loads(line) for line in lines] == [
        {"id": 1, "name": "x", "more": None}, {"id": 2, "name": "é", "more": {}}]
    for n, expected in ((5, [1, 2, 3]), (0, [])):
        export_page(rows, str(tmp_path / "page.json"), "id", n)
        page = json.loads((tmp_path / "page.json").read_text())
        assert [p["id"] for p in page] == expected and all(len(p) == 3 for p in page)
    with pytest.raises(ValueError, match="source"):
        export_page(rows, str(tmp_path / "lines" / "x.json"), "id", 1, [str(tmp_path / "lines")])

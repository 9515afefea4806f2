"""The document connector: round trips, commits and aborts, filters that skip parts."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tastemap.sources import docstore
from tastemap.sources.docstore import clean, commits, live_parts, register

SCHEMA = "id long, name string, stars double, open boolean, tags array<string>, at struct<x: int>"


@pytest.fixture(scope="module")
def fmt(spark):
    return register(spark)


@pytest.fixture(scope="module")
def rows(spark):
    made = [(i, None if i % 9 == 0 else f"näme \"{i}\"\n" * (i % 3 + 1), i / 4 if i % 5 else None,
             i % 2 == 0, [str(i)] * (i % 4), (i,)) for i in range(200)]
    return spark.createDataFrame(made, SCHEMA).repartitionByRange(8, "id")


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def read(spark, path, **options):
    return spark.read.format(docstore.NAME).options(**options).load(str(path))


@pytest.fixture
def store(fmt, rows, tmp_path):
    rows.write.format(fmt).mode("append").save(f"{tmp_path}/s")
    return f"{tmp_path}/s"


def test_round_trip(spark, store, rows):
    found = read(spark, store)
    assert found.dtypes == rows.dtypes and same(found, rows)
    assert found.rdd.getNumPartitions() == len(live_parts(store)) == 8


@pytest.mark.parametrize("size", [1, 50, 333, 4000])
def test_ranges_of_a_part_have_each_line_once(spark, store, rows, size):
    assert same(read(spark, store, range=size), rows)


def test_a_failed_task_leaves_no_row(spark, store, rows):
    bad = rows.withColumn("id", F.when(F.col("id") == 150, F.raise_error(F.lit("midway")))
                          .otherwise(F.col("id")).cast("long"))
    before = {p.name for p in Path(store, "parts").iterdir()}
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="midway"):
            bad.write.format(docstore.NAME).mode(mode).save(store)
        assert same(read(spark, store), rows) and len(commits(store)) == 1
    # Tasks that had ended were told to take theirs back; what killed ones left can go.
    clean(store, grace=-60)
    assert {p.name for p in Path(store, "parts").iterdir()} == before


def test_what_a_crash_leaves_is_not_read(spark, store, rows):
    Path(store, "parts", "lost.jsonl").write_text('{"id": 1}\n')
    Path(store, "commits", ".draft").write_text("{")
    assert same(read(spark, store), rows)
    assert clean(store) == [] and clean(store, grace=-60) == ["lost.jsonl"]


def test_append_replace_and_earlier_versions(spark, store, rows):
    rows.where("id < 3").write.format(docstore.NAME).mode("append").save(store)
    assert read(spark, store).count() == 203
    rows.where("id < 5").write.format(docstore.NAME).mode("overwrite").save(store)
    assert read(spark, store).count() == 5
    assert [read(spark, store, version=v).count() for v in (1, 2, 3)] == [200, 203, 5]


@pytest.mark.parametrize("condition", [
    "id = 17", "id > 150", "id <= 10 AND stars >= 1.5", "name IS NULL", "name IS NOT NULL AND id < 30",
    "id IN (3, 190)", "name = 'näme \"4\"\n'", "open = true AND id < 40", "stars IS NULL",
    "upper(name) LIKE '%1%'", "id <=> 5", "at.x = 5", "id = 17 OR stars = 2.0", "stars < 0",
])
def test_filters(spark, store, rows, condition):
    assert same(read(spark, store).where(condition), rows.where(condition))


def test_filters_skip_parts(spark, store, plan):
    one = read(spark, store).where("id = 17")
    assert one.rdd.getNumPartitions() == 1
    reader = docstore.Reader(store, read(spark, store).schema, None, docstore.RANGE)
    assert list(reader.pushFilters([docstore.ds.LessThan(("id",), 0)])) == []
    assert reader.partitions() == []
    assert read(spark, store).where("id < 0").count() == 0
    assert "Filter (id" not in plan(one)


def test_other_schema_and_no_rows(spark, store, fmt, rows, tmp_path):
    some = spark.read.format(fmt).schema("id long, missing string").load(store)
    assert some.where("missing IS NULL").count() == 200
    rows.limit(0).write.format(fmt).mode("append").save(f"{tmp_path}/none")
    assert read(spark, f"{tmp_path}/none").count() == 0
    with pytest.raises(Exception, match="no commit"):
        read(spark, f"{tmp_path}/nothing").count()


def test_commits_are_claimed_once(store):
    place, root = docstore._place(store)
    assert not docstore._claim(place, f"{root}/commits", 1, b"{}")
    assert docstore._claim(place, f"{root}/commits", 2, b'{"parts": [], "replaces": false}')
    assert not list(Path(store, "commits").glob(".*"))


def test_long_strings_in_statistics(spark, fmt, tmp_path):
    names = ["z" * 100, "z" * 64 + "a", "a"]
    spark.createDataFrame([(n,) for n in names], "name string").coalesce(1).write.format(fmt).mode(
        "append").save(f"{tmp_path}/s")
    for name in names:
        assert read(spark, f"{tmp_path}/s").where(F.col("name") == name).count() == 1

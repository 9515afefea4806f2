"""Stored buckets, and the score join that moves no row."""

import pytest
from pyspark.sql import functions as F

from tastemap.operators.joins import join_entity_score, join_stored_scores, partial_scores
from tastemap.sources.buckets import append_buckets, bucket_note, read_buckets, write_buckets

VALUE = "score"


def reviews(spark, first, last):
    """A third of all reviews are of entity 3; some have no entity, some no score."""
    row = F.col("id")
    key = F.when(row % 3 == 0, 3).when(row % 50 == 1, None).otherwise(row % 40).cast("bigint")
    return spark.range(first, last, 1, 5).select(
        key.alias("of"), F.when(row % 7 != 2, row % 5).cast("int").alias(VALUE))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    entities = spark.range(0, 60).select(F.col("id").alias("entity"), F.concat(
        F.lit("name "), "id").alias("name"))
    write_buckets(partial_scores(reviews(spark, 0, 700), "of", VALUE), f"{root}/scores", "of", 8)
    append_buckets(partial_scores(reviews(spark, 700, 2000), "of", VALUE), f"{root}/scores")
    write_buckets(entities, f"{root}/entities", "entity", 8)
    write_buckets(entities, f"{root}/fewer", "entity", 4)
    return root


def rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                  for r in df.select(sorted(df.columns)).collect())


def stored(spark, store, entities="entities"):
    return join_stored_scores(read_buckets(spark, f"{store}/scores"),
                              read_buckets(spark, f"{store}/{entities}"), "of", VALUE,
                              entity_key="entity")


def test_no_row_moves(spark, plan, store):
    joined = stored(spark, store)
    joined.collect()
    text = plan(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert "Bucketed: true" in text and "Bucketed: false" not in text


def test_same_rows_as_the_plain_join(spark, store):
    direct = join_entity_score(reviews(spark, 0, 2000), read_buckets(spark, f"{store}/entities"),
                               "of", VALUE, entity_key="entity")
    found = stored(spark, store)
    assert found.dtypes == direct.dtypes
    assert rows(found) == rows(direct) and len(rows(found)) == 40


def test_numbers_of_buckets_that_differ(spark, plan, store):
    """The smaller side is dealt out anew; the scores stay where they are."""
    joined = stored(spark, store, "fewer")
    assert rows(joined) == rows(stored(spark, store))
    assert "hashpartitioning(entity" in plan(joined) and "hashpartitioning(of" not in plan(joined)


def test_a_hot_entity_is_a_row_a_batch(spark, store):
    assert read_buckets(spark, f"{store}/scores").where("of = 3").count() == 2


def test_one_sorted_file_per_bucket_and_batch(spark, store):
    files = [f for f in (store / "scores").glob("*.parquet")]
    assert len(files) == 16
    for file in files:
        keys = [r["of"] for r in spark.read.parquet(str(file)).collect()]
        assert keys == sorted(keys)


def test_the_note_opens_the_table_in_another_session(spark, store):
    other = spark.newSession()
    assert bucket_note(other, f"{store}/fewer")["buckets"] == 4
    assert read_buckets(other, f"{store}/fewer").count() == 60
    assert not [t for t in other.catalog.listTables() if t.name.startswith("tastemap_buckets")]


def test_what_is_refused(spark, store, tmp_path):
    with pytest.raises(FileExistsError):
        write_buckets(spark.range(3), f"{store}/fewer", "id", 2)
    with pytest.raises(ValueError, match="columns"):
        append_buckets(spark.range(3), f"{store}/fewer")
    with pytest.raises(FileNotFoundError):
        read_buckets(spark, str(tmp_path))


def test_no_rows(spark, tmp_path):
    empty = spark.range(0).select(F.col("id").alias("of"), F.lit(1).alias(VALUE))
    write_buckets(partial_scores(empty, "of", VALUE), f"{tmp_path}/none", "of", 2)
    write_buckets(spark.range(3), f"{tmp_path}/some", "id", 2)
    joined = join_stored_scores(read_buckets(spark, f"{tmp_path}/none"),
                                read_buckets(spark, f"{tmp_path}/some"), "of", VALUE,
                                entity_key="id")
    assert joined.count() == 0

"""Versioned targets: failures, crashes, concurrent writers and readers."""

import json
import threading
from pathlib import Path

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.sql import functions as F

from tastemap.operators.sentiment import load_model, save_model
from tastemap.sources import versions as v
from tastemap.sources.tables import read_table


def values(df):
    return sorted(r[0] for r in df.collect())


def failing(spark):
    """Partitions that are written, and one that fails."""
    bad = F.when(F.col("id") == 77, F.raise_error(F.lit("midway"))).otherwise(F.col("id"))
    return spark.range(0, 80, 1, 8).select(bad.cast("long").alias("id"))


def test_versions_follow_each_other(spark, tmp_path):
    target = f"{tmp_path}/t"
    assert not v.is_versioned(spark, target) and v.resolve(spark, target) == target
    with pytest.raises(FileNotFoundError):
        v.read_version(spark, target)
    first = v.publish(spark.range(3), target)
    old = v.read_version(spark, target)
    second = v.publish(spark.range(5), target)
    assert (first.number, second.number) == (1, 2) and second.size > 0
    # A reader keeps the version that it has opened.
    assert values(old) == [0, 1, 2] and values(v.read_version(spark, target)) == [0, 1, 2, 3, 4]
    assert values(v.read_version(spark, target, 1)) == [0, 1, 2]
    assert values(read_table(spark, v.resolve(spark, target))) == [0, 1, 2, 3, 4]


def test_a_table_may_replace_itself(spark, tmp_path):
    target = f"{tmp_path}/t"
    v.publish(spark.range(3), target)
    v.publish(v.read_version(spark, target).select(F.col("id") * 10), target)
    assert values(v.read_version(spark, target)) == [0, 10, 20]


def test_a_job_that_fails_midway_changes_nothing(spark, tmp_path):
    target = f"{tmp_path}/t"
    v.publish(spark.range(4), target)
    with pytest.raises(Exception, match="midway"):
        v.publish(failing(spark), target)
    assert values(v.read_version(spark, target)) == [0, 1, 2, 3]
    assert len(list(Path(target, "data").iterdir())) == 1
    # Plain overwriting loses the table in the same case.
    spark.range(4).write.parquet(f"{tmp_path}/plain")
    with pytest.raises(Exception, match="midway"):
        failing(spark).write.mode("overwrite").parquet(f"{tmp_path}/plain")
    assert not list(Path(f"{tmp_path}/plain").glob("*.parquet"))


def test_what_a_crashed_job_left_is_not_read(spark, tmp_path):
    target = f"{tmp_path}/t"
    v.publish(spark.range(4), target)
    # Ended between writing and publishing, and in the midst of the pointer.
    spark.range(9).write.parquet(f"{target}/data/half")
    Path(target, "pointers", ".00000002-draft").write_text("{")
    assert values(v.read_version(spark, target)) == [0, 1, 2, 3]
    assert v.vacuum(spark, target) == []
    assert v.vacuum(spark, target, grace=-60) == [f"{target}/data/half"]
    assert v.publish(spark.range(2), target).number == 2


def test_writers_at_the_same_time(spark, tmp_path):
    target = f"{tmp_path}/t"
    v.publish(spark.range(0, 100, 1, 4).withColumn("of", F.lit(-1)), target)
    numbers, seen, stop = [], [], threading.Event()

    def write(i):
        numbers.append(v.publish(spark.range(0, 100, 1, 4).withColumn("of", F.lit(i)), target).number)

    def read():
        while not stop.is_set():
            rows = v.read_version(spark, target).groupBy("of").count().collect()
            seen.append([r["count"] for r in rows])

    reader = threading.Thread(target=read)
    writers = [threading.Thread(target=write, args=(i,)) for i in range(5)]
    for t in (reader, *writers):
        t.start()
    for t in writers:
        t.join()
    stop.set()
    reader.join()
    assert sorted(numbers) == [2, 3, 4, 5, 6]
    # Every reading is of one whole version.
    assert seen and all(counts == [100] for counts in seen)


def test_a_pointer_is_claimed_once(spark, tmp_path):
    target = f"{tmp_path}/t"
    v.publish(spark.range(1), target)
    assert not v._claim(spark, target, 1, "{}")
    assert json.loads(Path(target, "pointers", "00000001").read_text())["format"] == "parquet"
    with pytest.raises(v.Conflict):
        v.publish(spark.range(1), target, after=0)
    assert v.publish(spark.range(1), target, after=1).number == 2
    assert len(list(Path(target, "data").iterdir())) == 2


def test_old_versions_go(spark, tmp_path):
    target = f"{tmp_path}/t"
    for n in range(1, 5):
        v.publish(spark.range(n), target, keep=2)
    assert [x.number for x in v.versions(spark, target)] == [3, 4]
    assert len(list(Path(target, "data").iterdir())) == 2
    assert v.publish(spark.range(9), target).number == 5
    with pytest.raises(ValueError):
        v.vacuum(spark, target, keep=0)


def test_other_formats_and_sources(spark, tmp_path):
    target = f"{tmp_path}/t"
    v.publish(spark.range(3), target, "json")
    assert values(v.read_version(spark, target, schema="id long")) == [0, 1, 2]
    with pytest.raises(ValueError, match="source"):
        v.publish(spark.range(3), target, sources=[str(tmp_path)])


def test_models(spark, tmp_path):
    target = f"{tmp_path}/m"
    stages = [Tokenizer(inputCol="text", outputCol="words"), HashingTF(inputCol="words", outputCol="f")]
    save_model(PipelineModel(stages), target, versioned=True)
    assert len(load_model(target).stages) == 2
    save_model(PipelineModel(stages[:1]), target, versioned=True)
    assert len(load_model(target).stages) == 1

    class Broken:
        def save(self, path):
            Path(path).mkdir(parents=True)
            raise OSError("midway")

    with pytest.raises(OSError, match="midway"):
        v.publish_model(Broken(), target)
    assert len(load_model(target).stages) == 1 and len(v.versions(spark, target)) == 2

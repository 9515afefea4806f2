"""The jobs from the command line, one feeding the next."""

import json
import os
from pathlib import Path

import pytest

from tastemap.__main__ import run
from tastemap.sources.schemas import BUSINESS, REVIEW
from tastemap.sources.versions import versions

GOOD, BAD = "Great tasty lovely food", "Awful cold dirty table"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(
        [(f"r{i}", f"b{i % 4}", GOOD if i % 3 else BAD, 5.0 if i % 3 else 1.0)
         for i in range(120)] + [("s0", "b0", None, 5.0), ("s1", "b1", GOOD, None)],
        REVIEW).write.parquet(f"{root}/reviews")
    spark.createDataFrame(
        [(f"b{i}", f"Place {i}", "1 Main St", "Reno", "NV" if i < 3 else "CA", "89501",
          "Restaurants, Thai" if i % 2 else "Restaurants, Greek", float(i), 39.5, -119.8)
         for i in range(5)], BUSINESS).write.parquet(f"{root}/business")
    return root


def rows(spark, path):
    return {tuple(r) for r in spark.read.parquet(str(path)).collect()}


def objects(path):
    return [json.loads(line) for p in sorted(Path(path).glob("part-*"))
            for line in p.read_text().splitlines()]


def test_ratings(spark, folder):
    run(spark, ["rating-by-state", f"--business={folder}/business", f"--out={folder}/by_state"])
    assert rows(spark, folder / "by_state") == {("NV", 1.0), ("CA", 3.5)}
    run(spark, ["rating-by-state", f"--business={folder}/business", f"--out={folder}/half",
                "--fraction=3/5", "--exact"])
    assert rows(spark, folder / "half") == {("NV", 1.0)}
    run(spark, ["rating-by-cuisine", f"--business={folder}/business", f"--out={folder}/cuisine"])
    assert rows(spark, folder / "cuisine") == {("Thai", 2.0), ("Greek", 2.0)}
    run(spark, ["rating-by-cuisine", f"--business={folder}/business", f"--out={folder}/cuisine",
                "--stats", "avg", "min", "max", "median"])
    assert rows(spark, folder / "cuisine") == {
        ("Thai", 2.0, 1.0, 3.0, 2.0), ("Greek", 2.0, 0.0, 4.0, 2.0)}


def test_result_is_shown(spark, folder, capsys):
    run(spark, ["rating-by-state", f"--business={folder}/business", f"--out={folder}/shown",
                "--format=parquet", "--show"])
    printed = capsys.readouterr().out
    assert "avg: double" in printed and "3.5" in printed


def test_count_features_on_the_first_rows(spark, folder, capsys):
    run(spark, ["train", f"--reviews={folder}/reviews", f"--model={folder}/counts",
                "--features=count", "--rows=90", "--vocabulary-size=3", "--max-iter=5",
                "--reg-param=0.1", "--seed=7", "--partitions=3", "--fit-partitions=1"])
    printed = capsys.readouterr().out
    assert "terms: 8, left out of the vocabulary: 5" in printed
    assert "majority_f1" in printed and "'no_text': 0, 'no_label': 0" in printed


def test_json_tables(spark, folder):
    spark.read.parquet(f"{folder}/business").write.json(f"{folder}/json_business")
    run(spark, ["rating-by-state", f"--business={folder}/json_business",
                f"--out={folder}/json_state", "--format=json"])
    got = spark.read.json(f"{folder}/json_state").select("state", "avg").collect()
    assert {tuple(r) for r in got} == {("NV", 1.0), ("CA", 3.5)}


def test_sentiment_chain(spark, folder, capsys):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("durable-*/*"))
    run(spark, ["train", f"--reviews={folder}/reviews", f"--model={folder}/model",
                "--num-features=64"])
    assert "'no_text': 1, 'no_label': 1" in capsys.readouterr().out
    run(spark, ["score", f"--reviews={folder}/reviews", f"--model={folder}/model",
                f"--out={folder}/scored"])
    run(spark, ["business-sentiment", f"--sentiment={folder}/scored",
                f"--business={folder}/business", f"--out={folder}/joined"])
    scored = spark.read.parquet(f"{folder}/scored")
    assert scored.count() == 122 and scored.where("predicted_sentiment IS NULL").count() == 1
    joined = {r.business_id: r for r in spark.read.parquet(f"{folder}/joined").collect()}
    assert set(joined) == {"b0", "b1", "b2", "b3"}
    assert joined["b1"].predicted_sentiment_n == 31
    assert abs(joined["b1"].predicted_sentiment - 21 / 31) < 1e-9
    assert all(abs(joined[b].predicted_sentiment - 2 / 3) < 1e-9 for b in ("b0", "b2", "b3"))
    for extra in ([], ["--weighted"]):
        run(spark, ["sentiment-by-state", f"--joined={folder}/joined", f"--out={folder}/s", *extra])
        nevada = (20 + 21 + 20) / 91 if extra else (2 / 3 + 21 / 31 + 2 / 3) / 3
        assert {(s, round(v, 9)) for s, v in rows(spark, folder / "s")} == {
            ("NV", round(nevada, 9)), ("CA", round(2 / 3, 9))}
        run(spark, ["sentiment-by-cuisine", f"--joined={folder}/joined", f"--out={folder}/c", *extra])
        assert {r[0] for r in rows(spark, folder / "c")} == {"Thai", "Greek"}
    run(spark, ["export-points", f"--joined={folder}/joined", f"--out={folder}/map.json",
                "--rows=3", "--category=Thai", "--single-file"])
    assert [p["name"] for p in json.loads(Path(folder / "map.json").read_text())] == [
        "Place 1", "Place 3"]
    run(spark, ["export-points", f"--joined={folder}/joined", f"--out={folder}/few",
                "--price-column=stars", "--price-range", "1", "2.5", "--price=2.0",
                "--colour-by=predicted_sentiment", "--colour-best=1"])
    assert [(p["name"], round(p["hue"])) for p in objects(folder / "few")] == [("Place 2", 80)]
    run(spark, ["export-points", f"--joined={folder}/joined", f"--out={folder}/by_state",
                "--colour-by=state", "--colour-kind=category", "--colour-category=CA",
                "--colour-category=NV"])
    assert [p["hue"] for p in objects(folder / "by_state")] == [120, 120, 120, 0]
    run(spark, ["export-points", f"--joined={folder}/joined", f"--out={folder}/raw", "--raw"])
    assert [(p["business_id"], p["longitude"], p["city"]) for p in objects(folder / "raw")] == [
        (f"b{i}", -119.8, "Reno") for i in range(4)]
    # What a job writes in between goes with it.
    assert set(shared.glob("durable-*/*")) == before


@pytest.mark.parametrize("command", [
    ["export-points", "--joined={0}/t", "--out={0}/t"],
    ["export-points", "--joined={0}/t", "--out={0}/t/page.json", "--single-file"],
    ["train", "--reviews={0}/t", "--model={0}/t"],
    ["sentiment-by-state", "--joined={0}/t", "--out={1}/t"],
    ["sentiment-by-state", "--joined={1}/t", "--out=./{1}/t"],
    ["sentiment-by-state", "--joined={0}/t", "--out={0}"],
    ["sentiment-by-state", "--joined={0}/t", "--out=file:{0}/x/../t"],
    ["sentiment-by-state", "--joined={0}/link", "--out={0}/t"],
    ["rating-by-state", "--business={0}/t", "--out={0}/link"],
    ["score", "--reviews={0}/r", "--model={0}/t", "--out={0}/t/out"],
])
def test_no_command_overwrites_what_it_reads(spark, tmp_path, command):
    spark.range(5).write.parquet(f"{tmp_path}/t")
    (tmp_path / "link").symlink_to(tmp_path / "t")
    with pytest.raises(ValueError, match="source"):
        run(spark, [part.format(tmp_path, os.path.relpath(tmp_path)) for part in command])
    assert spark.read.parquet(f"{tmp_path}/t").count() == 5


def test_unfit_table_is_refused(spark, folder):
    with pytest.raises(ValueError, match="state is missing"):
        run(spark, ["rating-by-state", f"--business={folder}/reviews", f"--out={folder}/x"])


def test_versioned_targets(spark, folder, tmp_path):
    """Jobs write versions, later jobs read the newest one; a plain run adds one more."""
    def job(name, *rest):
        run(spark, [name, *rest, "--versioned"])

    job("train", f"--reviews={folder}/reviews", f"--model={tmp_path}/model", "--num-features=64")
    job("score", f"--reviews={folder}/reviews", f"--model={tmp_path}/model",
        f"--out={tmp_path}/scored")
    job("business-sentiment", f"--sentiment={tmp_path}/scored", f"--business={folder}/business",
        f"--out={tmp_path}/joined")
    for extra in ([], ["--keep=1", "--show"]):
        run(spark, ["sentiment-by-state", f"--joined={tmp_path}/joined", f"--out={tmp_path}/states",
                    "--versioned", *extra])
    run(spark, ["sentiment-by-state", f"--joined={tmp_path}/joined", f"--out={tmp_path}/states"])
    found = versions(spark, f"{tmp_path}/states")
    assert [v.number for v in found] == [2, 3]
    assert {s for s, _ in rows(spark, found[-1].path)} == {"NV", "CA"}
    with pytest.raises(ValueError, match="path"):
        run(spark, ["sentiment-by-state", "--joined=a", "--out=b", "--versioned",
                    "--target-option=uri"])

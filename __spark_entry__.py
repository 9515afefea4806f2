"""Queries over the given tables, and the same in SQL.

The tables hold no reviews, so stand-ins take their places: customers and parts
are the businesses, orders and lines their rated reviews, documents the texts.
"""

from __future__ import annotations

import importlib
import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# This file may be loaded by path, from anywhere.
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tastemap.functions.categories import first_category
from tastemap.functions.ratings import binarize_rating
from tastemap.functions.text import clean_text
from tastemap.operators.filters import filter_categories, filter_points
from tastemap.operators.joins import join_stored_scores, partial_scores
from tastemap.operators.points import map_points as points_of
from tastemap.operators.pyramid import cell_pyramid, write_pyramid
from tastemap.operators.sampling import split_by_hash, take_exact_fractions, take_fraction
from tastemap.operators.selection import take_selected_fractions
from tastemap.operators.sentiment import (common_terms, idf_weights, load_model, prepare_reviews,
                                          save_model, token_stages)
from tastemap.operators.sketches import (merged_quantiles, quantile_sketches, rank_error,
                                         rank_misses)
from tastemap.operators.stats import stats_by, weighted_f1
from tastemap.plans import jobs
from tastemap.sources import docstore
from tastemap.sources.buckets import append_buckets, read_buckets, write_buckets
from tastemap.sources.clustered import write_clustered
from tastemap.sources.documents import choose_types, document_fields, read_documents, typed
from tastemap.sources.durable import durable, scratch_path
from tastemap.sources.export import export_points
from tastemap.sources.tables import read_table, spread
from tastemap.sources.versions import current, publish, read_version

# The training-data operators come with their subpackage, and leave with it.
try:
    llm = importlib.import_module("tastemap.llm.queries")
except ModuleNotFoundError as missing:
    if missing.name not in ("tastemap.llm", "tastemap.llm.queries", "corpus_pipeline"):
        raise
    llm = None

# Stand-ins for the required word and the cuisines. "ol" is only ever part of a word.
REQUIRED = "PROMO"
WANTED = ("red", "blue", "hot", "ol", "ring")
# Categories to colour by, one of those in the table left out.
SEGMENTS = ("MACHINERY", "AUTOMOBILE", "FURNITURE", "BUILDING")
# Size of a vocabulary that cuts, and of the one to train on.
TOP_TERMS = 1000
TRAIN_TERMS = 2000
# Widths of hashed counts; the wide one folds into the narrow one.
NARROW, WIDE = 16, 4096
# The test tables are one file each: least partitions for work on their texts.
TEXT_PARTITIONS = 8
# Deepest level of the map's cells.
ZOOM = 7
# Spreads keys over 32 bits.
MULTIPLIER = 2654435761
# Buckets of the stored scores and their entities; bytes of a row group of clustered points.
BUCKETS, CLUSTER_BYTES = 8, 64_000


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet")


def _rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    # Adding 0.0 turns a negative zero into a plain one.
    return df.withColumns({c: F.round(c, places) + F.lit(0.0) for c in columns})


# Stand-in tables

def _order_sentiment(spark, sf):
    """Orders as scored reviews: the priority digit is the rating, its label the score."""
    stars = F.substring("o_orderpriority", 1, 1).cast("int")
    return (_table(spark, sf, "orders").withColumn("stars", stars)
            .select("o_orderkey", "o_custkey", "stars",
                    binarize_rating("stars").alias("predicted_sentiment")))


def _customer_sentiment(spark, sf):
    return jobs.business_sentiment(_order_sentiment(spark, sf), _table(spark, sf, "customer"),
                                   "o_custkey", business_key="c_custkey")


def _parts(spark, sf):
    """Parts as businesses whose categories are their type and the words of their name."""
    words = F.concat("p_type", F.lit(", "), F.replace("p_name", F.lit(" "), F.lit(", ")))
    return _table(spark, sf, "part").withColumn("categories", words)


def _part_sentiment(spark, sf):
    lines = (_table(spark, sf, "lineitem").withColumn("stars", F.col("l_quantity") / 10)
             .select("l_partkey", binarize_rating("stars").alias("predicted_sentiment")))
    return jobs.business_sentiment(lines, _parts(spark, sf), "l_partkey", business_key="p_partkey")


def _located(spark, sf):
    """Scored customers with a place on the globe and past its poles."""
    key = F.col("c_custkey")
    return (_customer_sentiment(spark, sf)
            .join(_table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .withColumns({"longitude": (key % 360 - 180).cast("double"),
                          "latitude": key % 182 - F.lit(90.5),
                          "segment": F.nullif("c_mktsegment", F.lit("BUILDING"))}))


def _points(spark, sf):
    points = points_of(_located(spark, sf), name="c_name",
                       address=("c_name", "segment", "n_name", "c_custkey"),
                       rating="c_acctbal", keep=("c_custkey",),
                       colour_by="predicted_sentiment", colour_best=1.0)
    return _rounded(points, 2, "x", "y", "rating", "hue").withColumn(
        "sentiment", F.round("sentiment", 6))


def _documents(spark, sf):
    scan = _table(spark, sf, "documents")
    # As many as the scan has splits, so that a larger table has more tasks, not larger ones.
    return spread(scan, max(TEXT_PARTITIONS, scan.rdd.getNumPartitions()))


def _texts(spark, sf):
    return prepare_reviews(_documents(spark, sf), keep=("doc_id",), rating=None, need_label=False)


def _labelled(spark, sf):
    """Documents with a rating that their text can tell: 5 for English, 0 for other languages."""
    return _documents(spark, sf).withColumn("stars", (F.col("lang") == "en").cast("int") * 5)


# Queries

def avg_by_region_key(spark, sf):
    customers = _table(spark, sf, "customer").join(
        _table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return _rounded(jobs.rating_by_state(customers, "n_name", "c_acctbal"), 4, "avg")


def stats_by_flag(spark, sf):
    stats = ("avg", "min", "max", "median", "stddev", "count")
    lines = stats_by(_table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", stats)
    return _rounded(lines, 4, "avg", "median", "stddev")


def stats_by_category(spark, sf):
    parts = jobs.rating_by_cuisine(_parts(spark, sf), "categories", "p_retailprice",
                                   jobs.CUISINE_STATS, required=REQUIRED, wanted=WANTED)
    return _rounded(parts, 4, "avg", "median", "stddev")


def category_labels(spark, sf):
    kept = filter_categories(_parts(spark, sf), "categories", REQUIRED, WANTED)
    return kept.select("p_partkey", "categories",
                       first_category("categories", WANTED).alias("label"))


def rating_label(spark, sf):
    return _order_sentiment(spark, sf).select(
        "o_orderkey", "stars", F.col("predicted_sentiment").alias("label"))


def entity_score(spark, sf):
    return _rounded(_customer_sentiment(spark, sf), 6, "predicted_sentiment")


def mean_of_means(spark, sf):
    means = jobs.sentiment_by_state(_customer_sentiment(spark, sf), "c_mktsegment")
    return _rounded(means, 6, "avg")


def weighted_mean(spark, sf):
    means = jobs.sentiment_by_state(_customer_sentiment(spark, sf), "c_mktsegment", weighted=True)
    return _rounded(means, 6, "avg")


def sentiment_by_category(spark, sf):
    means = jobs.sentiment_by_cuisine(_part_sentiment(spark, sf), required=REQUIRED, wanted=WANTED)
    return _rounded(means, 6, "avg")


def weighted_sentiment_by_category(spark, sf):
    means = jobs.sentiment_by_cuisine(_part_sentiment(spark, sf), weighted=True,
                                      required=REQUIRED, wanted=WANTED)
    return _rounded(means, 6, "avg")


def clean_text_runs(spark, sf):
    return _documents(spark, sf).select("doc_id", clean_text("text").alias("cleaned"))


def clean_text_simple(spark, sf):
    return _documents(spark, sf).select(
        "doc_id", clean_text("text", collapse=False).alias("cleaned"))


def token_counts(spark, sf):
    tokens = PipelineModel(token_stages()).transform(_texts(spark, sf))
    return tokens.select("doc_id", F.size("words").cast("bigint").alias("n_words"),
                         F.size("terms").cast("bigint").alias("n_terms"))


def hashed_counts(spark, sf):
    """Hashed counts of two widths: their sums, whether the wide ones fold into the narrow
    ones, and how many different ones a text's copies have."""
    hashing = [HashingTF(inputCol="terms", outputCol=f"in_{w}", numFeatures=w)
               for w in (NARROW, WIDE)]
    counted = PipelineModel([*token_stages(), *hashing]).transform(_texts(spark, sf))
    narrow, wide = F.unwrap_udt(f"in_{NARROW}"), F.unwrap_udt(f"in_{WIDE}")
    counts = counted.select("doc_id", F.xxhash64("text").alias("of_text"), narrow.alias("narrow"),
                            wide.alias("wide"))

    def total(values):
        return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)

    # Both vectors are sparse, and stay so.
    pairs = F.arrays_zip(F.col("wide.indices").alias("i"), F.col("wide.values").alias("n"))
    folded = F.transform(F.sequence(F.lit(0), F.lit(NARROW - 1)), lambda at: total(F.transform(
        F.filter(pairs, lambda p: p["i"] % NARROW == at), lambda p: p["n"])))
    direct = F.transform(F.sequence(F.lit(0), F.lit(NARROW - 1)), lambda at: F.coalesce(
        F.try_element_at("narrow.values", F.nullif(F.array_position("narrow.indices", at), F.lit(0))
                         .cast("int")), F.lit(0.0)))
    found = durable(counts.select(
        "doc_id", "of_text", F.hash("wide.indices", "wide.values").alias("vector"),
        total("narrow.values").cast("bigint").alias("n_terms"),
        total("wide.values").cast("bigint").alias("n_terms_wide"), (folded == direct).alias("folds"),
        (F.coalesce(F.array_min("wide.values"), F.lit(0.0)) >= 0).alias("non_negative")))
    copies = found.groupBy("of_text").agg(F.countDistinct("vector").alias("vectors_of_text"))
    return found.join(copies, "of_text").drop("of_text", "vector")


def vocabulary(spark, sf):
    terms = PipelineModel(token_stages()).transform(_texts(spark, sf))
    return common_terms(terms, TOP_TERMS)


def idf_of_terms(spark, sf):
    texts = _texts(spark, sf)
    tokens = PipelineModel(token_stages()).transform(texts)
    return _rounded(idf_weights(tokens, texts.count()), 6, "idf")


def fractions_by_status(spark, sf):
    orders = _table(spark, sf, "orders")
    sweep = [stats_by(take_fraction(orders, "o_orderkey", j, 4, hashed=False), "o_orderstatus",
                      "o_totalprice", ("avg", "count")).withColumn("quarters", F.lit(j))
             for j in (1, 2, 3, 4)]
    return _rounded(reduce(DataFrame.unionByName, sweep), 4, "avg")


def exact_fractions_by_status(spark, sf):
    cuts = take_exact_fractions(_table(spark, sf, "orders"), "o_orderkey",
                                [(j, 3) for j in (1, 2, 3)])
    sweep = [stats_by(cut, "o_orderstatus", "o_totalprice",
                      ("avg", "count")).withColumn("thirds", F.lit(j))
             for j, cut in enumerate(cuts, 1)]
    return _rounded(reduce(DataFrame.unionByName, sweep), 4, "avg")


def selected_fractions_by_status(spark, sf):
    """Exact quarters of the orders by a hash that SQL can tell too."""
    orders = _table(spark, sf, "orders")
    hashed = F.col("o_orderkey") * F.lit(MULTIPLIER) % F.lit(1 << 32)
    quarters = take_selected_fractions(orders, "o_orderkey", [(j, 4) for j in (1, 2, 3, 4)],
                                       hashed, bits=32)
    sweep = [stats_by(part, "o_orderstatus", "o_totalprice",
                      ("avg", "count")).withColumn("quarters", F.lit(j))
             for j, part in enumerate(quarters, 1)]
    return _rounded(reduce(DataFrame.unionByName, sweep), 4, "avg")


def split_sides(spark, sf):
    sides = split_by_hash(_table(spark, sf, "documents"), "doc_id", hashed=False)
    train, test = (side.groupBy("lang").agg(F.count("*").alias("n"),
                                            F.sum("n_chars").alias("n_chars")) for side in sides)
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test")))


def label_f1(spark, sf):
    return _rounded(weighted_f1(_table(spark, sf, "labels"), "toxic", "quality"), 6,
                    "f1", "majority_f1")


def map_points(spark, sf):
    return _points(spark, sf)


def map_points_by_price(spark, sf):
    """Points coloured by a price point of one to five dollar signs, of which four count."""
    priced = _located(spark, sf).withColumn("price", F.repeat(
        F.lit("$"), (F.col("c_custkey") % 5 + 1).cast("int")))
    points = points_of(priced, name="c_name", address=("c_name",), rating="c_acctbal",
                       keep=("c_custkey", "price"), colour_by="price", colour_kind="price",
                       colour_best=4)
    return points.select("c_custkey", "price", "hue")


def map_points_by_category(spark, sf):
    points = points_of(_located(spark, sf), name="c_name", address=("c_name",),
                       rating="c_acctbal", keep=("c_custkey", "c_mktsegment"),
                       colour_by="c_mktsegment", colour_kind="category",
                       colour_categories=SEGMENTS)
    return _rounded(points.select("c_custkey", "c_mktsegment", "hue"), 6, "hue")


def map_export(spark, sf):
    """The first points as written for the page and read again, some without a sentiment."""
    points = _points(spark, sf).withColumn(
        "sentiment", F.when(F.col("c_custkey") % 7 != 0, F.col("sentiment")))
    path = scratch_path(spark, "map")
    export_points(points, path, "c_custkey", 1000)
    lines = read_table(spark, path, "text")
    # Members that are NULL are written out, so each line has them all.
    members = F.size(F.json_object_keys("value")).alias("members")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema.fields)
    return lines.select(F.from_json("value", schema).alias("p"), members).select("p.*", "members")


def map_pyramid(spark, sf):
    """Cells of all points at all zoom levels, as written for the page and read again."""
    path = scratch_path(spark, "pyramid")
    write_pyramid(cell_pyramid(_points(spark, sf), ZOOM), path)
    # Sums, since a mean may end halfway between two roundings.
    sums = {f"{v}_sum": F.round(F.col(v) * F.col("n"), places) + F.lit(0.0)
            for v, places in (("rating", 2), ("sentiment", 6))}
    return read_table(spark, path).withColumns(sums).drop("rating", "sentiment")


def filter_points_by_range(spark, sf):
    customers = filter_points(_table(spark, sf, "customer"), price_range=(0, 5000),
                              postal_code=7, category="BUILD", price_col="c_acctbal",
                              postal_code_col="c_nationkey", categories_col="c_mktsegment")
    return customers.select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")


def filter_points_by_price(spark, sf):
    parts = filter_points(_parts(spark, sf), prices=(1, 2, 3, 4), category="ring",
                          price_col="p_size")
    return parts.select("p_partkey", "p_size", "categories")


def train_and_score(spark, sf):
    """Train, save, load, score every document; by source, is the mean near the label's?"""
    path = scratch_path(spark, "model")
    labelled = _labelled(spark, sf)
    trained = jobs.train(labelled, key="doc_id", num_features=WIDE)
    save_model(trained.model, path)
    scored = jobs.score(load_model(path), labelled, key="doc_id", entity="source")
    label, predicted = F.avg("rating_sentiment"), F.avg("predicted_sentiment")
    return scored.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating_sentiment").alias("n_good"),
        (F.abs(label - predicted) < 0.1).alias("near"))


def score_rows(spark, sf):
    """Every document is scored, every seventh without its text; what comes out of them."""
    labelled = _labelled(spark, sf)
    model = jobs.train(labelled, key="doc_id", num_features=64, max_iter=5).model
    holed = labelled.withColumn("text", F.when(F.col("doc_id") % 7 != 0, F.col("text")))
    scored = jobs.score(model, holed, key="doc_id", entity="source")
    return scored.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count("predicted_sentiment").alias("n_scored"),
        F.count_if(F.col("predicted_sentiment").isin(0, 1)).alias("n_binary"),
        F.count_if((F.col("doc_id") % 7 == 0) & F.col("predicted_sentiment").isNull())
        .alias("n_without_text"))


def _quality(trained):
    """Beside guessing, which is known, whether the model does better by far."""
    return _rounded(trained.quality, 6, "majority_f1").select(
        "majority_f1", (F.col("f1") > F.col("majority_f1") + 0.3).alias("learnt"))


def sentiment_quality(spark, sf):
    return _quality(jobs.train(_labelled(spark, sf), key="doc_id", hashed=False,
                               num_features=WIDE))


def count_features_svm(spark, sf):
    return _quality(jobs.train_count_features(
        _labelled(spark, sf), key="doc_id", hashed=False, vocabulary_size=TRAIN_TERMS))


def versioned_overwrite(spark, sf):
    """Totals by status: the version that a failed overwrite leaves, and the next one."""
    path = scratch_path(spark, "versions")
    orders = _table(spark, sf, "orders")

    def totals(rows):
        return _rounded(stats_by(rows, "o_orderstatus", "o_totalprice", ("avg", "count")), 4, "avg")

    def newest():
        return read_version(spark, path).withColumn("version", F.lit(current(spark, path).number))

    publish(totals(orders.where("o_orderkey % 2 = 0")), path)
    spoilt = F.when(F.col("o_orderkey") % 97 == 3, F.raise_error(F.lit("spoilt order")))
    try:
        publish(totals(orders.withColumn("o_totalprice", F.coalesce(spoilt.cast("double"),
                                                                    "o_totalprice"))), path)
    except PySparkException:
        pass
    left = newest()
    publish(totals(orders), path)
    return left.unionByName(newest())


def stored_entity_score(spark, sf):
    """Customers with their mean sentiment, from scores stored in buckets by two batches."""
    scores, customers = scratch_path(spark, "scores"), scratch_path(spark, "customers")
    orders = _order_sentiment(spark, sf)
    batches = [partial_scores(orders.where(F.col("o_orderkey") % 2 == side), "o_custkey",
                              "predicted_sentiment") for side in (0, 1)]
    write_buckets(batches[0], scores, "o_custkey", BUCKETS)
    append_buckets(batches[1], scores)
    write_buckets(_table(spark, sf, "customer"), customers, "c_custkey", BUCKETS)
    joined = join_stored_scores(read_buckets(spark, scores), read_buckets(spark, customers),
                                "o_custkey", "predicted_sentiment", entity_key="c_custkey")
    return _rounded(joined, 6, "predicted_sentiment")


def _turns_as_json(spark, sf):
    """Turns of conversations as JSON documents; every seventh conversation writes the turn as
    text, every fifth has tags."""
    message = F.struct(F.col("text").alias("body"), F.length("text").alias("chars"))
    tags = F.when(F.col("conv_id") % 5 == 0, F.array("role", F.lit("fifth")))

    def document(turn):
        return F.to_json(F.struct("conv_id", turn.alias("turn"), "role", message.alias("message"),
                                  tags.alias("tags")))

    turn = F.col("turn")
    lines = F.when(F.col("conv_id") % 7 == 0, document(F.concat(F.lit("no. "), turn))) \
        .otherwise(document(turn))
    path = scratch_path(spark, "documents")
    _table(spark, sf, "conversations").select(lines.alias("value")).write.text(path)
    return read_documents(spark, path)


def json_fields(spark, sf):
    """How many values of which type every field of the documents has."""
    return document_fields(_turns_as_json(spark, sf))


def json_typed(spark, sf):
    """By role and type of the turn, documents read by types chosen from all of their values."""
    documents = _turns_as_json(spark, sf)
    chosen = choose_types(documents, {"turn": "$.turn", "role": "$.role", "body": "$.message.body",
                                      "chars": "$.message.chars", "tag": "$.tags[0]"})
    rows = typed(documents, chosen)
    return rows.groupBy("role", F.col("turn").startswith("no. ").alias("as_text")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"),
        F.sum(F.length("body")).cast("bigint").alias("chars_of_body"), F.count("tag").alias("tagged"),
        F.lit(chosen["turn"].type).alias("turn_type"))


def document_store(spark, sf):
    """Customers from a document store, written by two commits and a third that failed."""
    path, fmt = scratch_path(spark, "store"), docstore.register(spark)
    customers = _table(spark, sf, "customer").withColumn(
        "c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    for side in (0, 1):
        customers.where(F.col("c_custkey") % 2 == side).write.format(fmt).mode("append").save(path)
    spoilt = F.when(F.col("c_custkey") % 97 == 3, F.raise_error(F.lit("spoilt customer")))
    try:
        (customers.withColumn("c_name", F.coalesce(spoilt.cast("string"), "c_name"))
         .write.format(fmt).mode("append").save(path))
    except PySparkException:
        pass
    stored = spark.read.format(fmt).load(path)
    return filter_points(stored, price_range=(0, 5000), price_col="c_acctbal").where(
        "c_mktsegment IS NOT NULL")


def clustered_points(spark, sf):
    """Customers of a nation and a range of balances, from a table clustered by both."""
    path = scratch_path(spark, "clustered")
    write_clustered(_table(spark, sf, "customer"), path, ["c_nationkey", "c_acctbal"],
                    bloom=["c_nationkey"], row_group=CLUSTER_BYTES)
    return filter_points(read_table(spark, path), price_range=(0, 5000), postal_code=7,
                         price_col="c_acctbal", postal_code_col="c_nationkey")


def sketched_medians(spark, sf):
    """Prices by flag from sketches stored in four parts: all of them, then two.

    Beside the exact ends, whether the median's rank is within the sketch's error."""
    lines = _table(spark, sf, "lineitem").withColumn("part", F.col("l_orderkey") % 4)
    sketches = durable(quantile_sketches(lines, ["l_returnflag"], "l_extendedprice", ["part"]))
    answers = []
    for name, wanted in (("all", F.lit(True)), ("odd", F.col("part") % 2 == 1)):
        found = durable(merged_quantiles(sketches.where(wanted), ["l_returnflag"],
                                         {"least": 0, "median": 0.5, "most": 1}))
        misses = rank_misses(lines.where(wanted), ["l_returnflag"], "l_extendedprice", found,
                             "median")
        answers.append(found.join(misses, "l_returnflag").select(
            "l_returnflag", F.lit(name).alias("parts"), "n", "least", "most",
            (F.col("miss") <= 2 * rank_error()).alias("near")))
    return answers[0].unionByName(answers[1])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query name -> callable of session and folder of tables."""
    return {
        "avg_by_region_key": avg_by_region_key,
        "stats_by_flag": stats_by_flag,
        "stats_by_category": stats_by_category,
        "category_labels": category_labels,
        "rating_label": rating_label,
        "entity_score": entity_score,
        "mean_of_means": mean_of_means,
        "weighted_mean": weighted_mean,
        "sentiment_by_category": sentiment_by_category,
        "weighted_sentiment_by_category": weighted_sentiment_by_category,
        "clean_text": clean_text_runs,
        "clean_text_simple": clean_text_simple,
        "token_counts": token_counts,
        "hashed_counts": hashed_counts,
        "vocabulary": vocabulary,
        "idf_weights": idf_of_terms,
        "take_fraction": fractions_by_status,
        "take_exact_fraction": exact_fractions_by_status,
        "take_selected_fraction": selected_fractions_by_status,
        "split_by_hash": split_sides,
        "weighted_f1": label_f1,
        "map_points": map_points,
        "map_points_by_price": map_points_by_price,
        "map_points_by_category": map_points_by_category,
        "map_export": map_export,
        "map_pyramid": map_pyramid,
        "filter_points_by_range": filter_points_by_range,
        "filter_points_by_price": filter_points_by_price,
        "train_and_score": train_and_score,
        "score_rows": score_rows,
        "sentiment_quality": sentiment_quality,
        "count_features_svm": count_features_svm,
        "versioned_overwrite": versioned_overwrite,
        "stored_entity_score": stored_entity_score,
        "json_fields": json_fields,
        "json_typed": json_typed,
        "document_store": document_store,
        "clustered_points": clustered_points,
        "sketched_medians": sketched_medians,
        **(llm.queries() if llm else {}),
    }


def entry(spark: SparkSession) -> DataFrame:
    """Mean sentiment by region over per-business means."""
    return mean_of_means(spark, "/root/testdata/sf0.001")


# The same in SQL

# The default English stop words. Those with an apostrophe are left
# out, since cleaning takes the apostrophe out of the text.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now cannot could ought would
""".split()

PUNCTUATION_OR_DIGIT = r"!-/:-@\[-`{-~0-9"
SPACES = (r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
          r"\x{202f}\x{205f}\x{3000}")


def _words(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


CLEANED = (f"regexp_replace(regexp_replace(text, '[{PUNCTUATION_OR_DIGIT}{SPACES}]', ' ', 'g'), "
           f"'[{SPACES}]{{2,}}', ' ', 'g')")

TOKENS = f"""
  cleaned AS (SELECT doc_id, {CLEANED} AS t FROM documents),
  tokens AS (
    SELECT doc_id,
           CASE WHEN t = '' THEN [''] WHEN rtrim(t, ' ') = '' THEN []::VARCHAR[]
                ELSE string_split(lower(rtrim(t, ' ')), ' ') END AS words
    FROM cleaned),
  kept AS (SELECT *, list_filter(words, lambda w: w NOT IN {_words(STOP_WORDS)}) AS terms
           FROM tokens)"""

ORDER_SENTIMENT = """
  reviews AS (SELECT o_orderkey, o_custkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS stars,
                     CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) >= 4
                          THEN 1 ELSE 0 END AS label
              FROM orders)"""

CUSTOMER_SENTIMENT = ORDER_SENTIMENT + """,
  scores AS (SELECT o_custkey, avg(label) AS predicted_sentiment,
                    CAST(sum(label) AS DOUBLE) AS predicted_sentiment_sum,
                    count(label) AS predicted_sentiment_n
             FROM reviews GROUP BY o_custkey),
  joined AS (SELECT customer.*, predicted_sentiment, predicted_sentiment_sum,
                    predicted_sentiment_n
             FROM customer JOIN scores ON o_custkey = c_custkey)"""

PARTS = f"""
  parts AS (SELECT *, p_type || ', ' || replace(p_name, ' ', ', ') AS categories FROM part),
  labelled AS (
    SELECT *, coalesce(list_filter(string_split(categories, ', '),
                                   lambda c: c IN {_words(WANTED)})[1], 'Other') AS label
    FROM parts
    WHERE contains(categories, '{REQUIRED}')
      AND ({' OR '.join(f"contains(categories, '{w}')" for w in WANTED)}))"""

PART_SENTIMENT = PARTS + """,
  scores AS (SELECT l_partkey, avg(s) AS mean, sum(s) AS total, count(s) AS n
             FROM (SELECT l_partkey, CASE WHEN l_quantity / 10 >= 4 THEN 1 ELSE 0 END AS s
                   FROM lineitem)
             GROUP BY l_partkey),
  joined AS (SELECT label, mean, total, n FROM labelled JOIN scores ON l_partkey = p_partkey)"""

POINTS = CUSTOMER_SENTIMENT + """,
  located AS (SELECT *, CAST(c_custkey % 360 - 180 AS DOUBLE) AS lon,
                     c_custkey % 182 - CAST(90.5 AS DOUBLE) AS lat
              FROM joined JOIN nation ON c_nationkey = n_nationkey),
  points AS (
    SELECT c_custkey,
           round(radians(lon) * 6378137, 2) + 0.0 AS x,
           round(CASE WHEN abs(lat) > 90 THEN NULL
                      WHEN lat > 85.0511287798066 THEN pi() * 6378137
                      WHEN lat < -85.0511287798066 THEN -pi() * 6378137
                      ELSE 6378137 * ln(tan(pi() / 4 + radians(lat) / 2)) END, 2) + 0.0 AS y,
           c_name AS name,
           c_name || ', ' || CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END
             || ', ' || n_name || ', ' || c_custkey AS addr,
           round(c_acctbal, 2) AS rating,
           round(predicted_sentiment, 6) AS sentiment,
           round(predicted_sentiment * 120, 2) AS hue
    FROM located)"""


# Half the side of the map, in SQL.
HALF = "(pi() * 6378137)"


def oracle_sql() -> dict[str, str]:
    """Query name -> the same in SQL; of a trained model, what must hold for it."""
    segments = ", ".join(f"'{c}'" for c in SEGMENTS)
    return {
        "avg_by_region_key": """
            SELECT n_name, round(avg(c_acctbal), 4) AS avg
            FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
        "stats_by_flag": """
            SELECT l_returnflag, round(avg(l_extendedprice), 4) AS avg,
                   min(l_extendedprice) AS min, max(l_extendedprice) AS max,
                   round(median(l_extendedprice), 4) AS median,
                   round(stddev_samp(l_extendedprice), 4) AS stddev,
                   count(l_extendedprice) AS count
            FROM lineitem GROUP BY l_returnflag""",
        "stats_by_category": f"""
            WITH {PARTS}
            SELECT label AS categories, round(avg(p_retailprice), 4) AS avg,
                   min(p_retailprice) AS min, max(p_retailprice) AS max,
                   round(median(p_retailprice), 4) AS median,
                   round(stddev_samp(p_retailprice), 4) AS stddev
            FROM labelled GROUP BY label""",
        "category_labels": f"WITH {PARTS} SELECT p_partkey, categories, label FROM labelled",
        "rating_label": f"WITH {ORDER_SENTIMENT} SELECT o_orderkey, stars, label FROM reviews",
        "entity_score": f"""
            WITH {CUSTOMER_SENTIMENT}
            SELECT * REPLACE (round(predicted_sentiment, 6) AS predicted_sentiment)
            FROM joined""",
        "mean_of_means": f"""
            WITH {CUSTOMER_SENTIMENT}
            SELECT c_mktsegment, round(avg(predicted_sentiment), 6) AS avg
            FROM joined GROUP BY c_mktsegment""",
        "weighted_mean": f"""
            WITH {ORDER_SENTIMENT}
            SELECT c_mktsegment, round(avg(label), 6) AS avg
            FROM reviews JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
        "sentiment_by_category": f"""
            WITH {PART_SENTIMENT}
            SELECT label AS categories, round(avg(mean), 6) AS avg FROM joined GROUP BY label""",
        "weighted_sentiment_by_category": f"""
            WITH {PART_SENTIMENT}
            SELECT label AS categories, round(sum(total) / sum(n), 6) AS avg
            FROM joined GROUP BY label""",
        "clean_text": f"SELECT doc_id, {CLEANED} AS cleaned FROM documents",
        "clean_text_simple": rf"""
            SELECT doc_id,
                   regexp_replace(text, '[{PUNCTUATION_OR_DIGIT}\r\t\n]', ' ', 'g') AS cleaned
            FROM documents""",
        "token_counts": f"""
            WITH {TOKENS}
            SELECT doc_id, len(words) AS n_words, len(terms) AS n_terms FROM kept""",
        "hashed_counts": f"""
            WITH {TOKENS}
            SELECT doc_id, len(terms) AS n_terms, len(terms) AS n_terms_wide, true AS folds,
                   true AS non_negative, CAST(1 AS BIGINT) AS vectors_of_text FROM kept""",
        "vocabulary": f"""
            WITH {TOKENS}
            SELECT term, count(*) AS n FROM (SELECT unnest(terms) AS term FROM kept)
            GROUP BY term ORDER BY n DESC, term LIMIT {TOP_TERMS}""",
        "idf_weights": f"""
            WITH {TOKENS},
              words AS (SELECT doc_id, unnest(terms) AS term FROM kept),
              spread AS (SELECT term, count(DISTINCT doc_id) AS docs FROM words GROUP BY term)
            SELECT term, round(ln(((SELECT count(*) FROM documents) + 1) / (docs + 1)), 6) AS idf
            FROM spread""",
        "take_fraction": " UNION ALL ".join(f"""
            SELECT o_orderstatus, round(avg(o_totalprice), 4) AS avg,
                   count(o_totalprice) AS count, {j} AS quarters
            FROM orders WHERE o_orderkey % 4 < {j} GROUP BY o_orderstatus""" for j in (1, 2, 3, 4)),
        "take_exact_fraction": """
            WITH placed AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS place,
                                   count(*) OVER () AS total FROM orders)
            SELECT o_orderstatus, round(avg(o_totalprice), 4) AS avg,
                   count(o_totalprice) AS count, thirds
            FROM placed JOIN (SELECT unnest([1, 2, 3]) AS thirds) AS sweep
              ON place <= total * thirds // 3
            GROUP BY o_orderstatus, thirds""",
        "take_selected_fraction": f"""
            WITH placed AS (SELECT *, row_number() OVER (
                                ORDER BY o_orderkey * {MULTIPLIER} % 4294967296, o_orderkey) AS place,
                                   count(*) OVER () AS total FROM orders)
            SELECT o_orderstatus, round(avg(o_totalprice), 4) AS avg,
                   count(o_totalprice) AS count, quarters
            FROM placed JOIN (SELECT unnest([1, 2, 3, 4]) AS quarters) AS sweep
              ON place <= total * quarters // 4
            GROUP BY o_orderstatus, quarters""",
        "split_by_hash": """
            SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars,
                   CASE WHEN doc_id % 5 < 4 THEN 'train' ELSE 'test' END AS side
            FROM documents GROUP BY ALL""",
        "weighted_f1": """
            WITH classes AS (SELECT DISTINCT quality AS class FROM labels
                             UNION SELECT DISTINCT toxic FROM labels),
              counted AS (SELECT class, count(*) FILTER (quality = class) AS support,
                                 count(*) FILTER (toxic = class) AS predicted,
                                 count(*) FILTER (quality = class AND toxic = class) AS hits
                          FROM labels CROSS JOIN classes GROUP BY class)
            SELECT round(sum(support * 2 * hits / (support + predicted)) / sum(support), 6) AS f1,
                   round(max(support) / sum(support)
                         * 2 * max(support) / (max(support) + sum(support)), 6) AS majority_f1
            FROM counted""",
        "map_points": f"WITH {POINTS} SELECT * FROM points",
        "map_points_by_price": f"""
            WITH {POINTS}
            SELECT c_custkey, repeat('$', CAST(c_custkey % 5 + 1 AS BIGINT)) AS price,
                   CASE WHEN c_custkey % 5 < 4 THEN (c_custkey % 5 + 1) * CAST(30 AS DOUBLE)
                        END AS hue
            FROM points""",
        "map_points_by_category": f"""
            WITH {POINTS}
            SELECT c_custkey, c_mktsegment,
                   round(CASE WHEN list_contains([{segments}], c_mktsegment)
                              THEN (list_position([{segments}], c_mktsegment) - 1)
                                   * CAST({120 / (len(SEGMENTS) - 1)} AS DOUBLE) END, 6) AS hue
            FROM located""",
        "map_export": f"""
            WITH {POINTS}
            SELECT * REPLACE (CASE WHEN c_custkey % 7 <> 0 THEN sentiment END AS sentiment),
                   8 AS members
            FROM points ORDER BY c_custkey LIMIT 1000""",
        "map_pyramid": f"""
            WITH {POINTS},
              grid AS (
                SELECT *, CAST(least(greatest(floor((x + {HALF}) / (2 * {HALF}) * {1 << ZOOM}), 0),
                                     {(1 << ZOOM) - 1}) AS BIGINT) AS c,
                       CAST(least(greatest(floor(({HALF} - y) / (2 * {HALF}) * {1 << ZOOM}), 0),
                                  {(1 << ZOOM) - 1}) AS BIGINT) AS r
                FROM points WHERE y IS NOT NULL),
              levels AS (SELECT rating, sentiment, zoom, c >> ({ZOOM} - zoom) AS c,
                                r >> ({ZOOM} - zoom) AS r
                         FROM grid CROSS JOIN (SELECT unnest(range({ZOOM + 1})) AS zoom) AS z)
            SELECT CAST(zoom AS INTEGER) AS zoom,
                   CAST({" + ".join(f"(((c >> {b}) & 1) << {2 * b + 1}) + (((r >> {b}) & 1) << {2 * b})"
                                    for b in range(ZOOM))} AS BIGINT) AS cell,
                   CAST(c AS INTEGER) AS "column", CAST(r AS INTEGER) AS "row", count(*) AS n,
                   round(sum(rating), 2) + 0.0 AS rating_sum,
                   round(sum(sentiment), 6) + 0.0 AS sentiment_sum
            FROM levels GROUP BY zoom, c, r""",
        "filter_points_by_range": """
            SELECT c_custkey, c_acctbal, c_nationkey, c_mktsegment FROM customer
            WHERE c_acctbal BETWEEN 0 AND 5000 AND c_nationkey = 7
              AND contains(c_mktsegment, 'BUILD')""",
        "filter_points_by_price": f"""
            WITH {PARTS}
            SELECT p_partkey, p_size, categories FROM parts
            WHERE p_size IN (1, 2, 3, 4) AND contains(categories, 'ring')""",
        "train_and_score": """
            SELECT source, count(*) AS n, count(*) FILTER (lang = 'en') AS n_good, true AS near
            FROM documents GROUP BY source""",
        "score_rows": """
            SELECT source, count(*) AS n, count(*) FILTER (doc_id % 7 <> 0) AS n_scored,
                   count(*) FILTER (doc_id % 7 <> 0) AS n_binary,
                   count(*) FILTER (doc_id % 7 = 0) AS n_without_text
            FROM documents GROUP BY source""",
        **{name: """
            WITH counted AS (SELECT count(*) AS n FROM documents WHERE doc_id % 5 = 4
                             GROUP BY lang = 'en')
            SELECT round(max(n) / sum(n) * 2 * max(n) / (max(n) + sum(n)), 6) AS majority_f1,
                   true AS learnt
            FROM counted""" for name in ("sentiment_quality", "count_features_svm")},
        "versioned_overwrite": " UNION ALL ".join(f"""
            SELECT o_orderstatus, round(avg(o_totalprice), 4) AS avg,
                   count(o_totalprice) AS count, {version} AS version
            FROM orders WHERE o_orderkey % 2 = 0 OR {version} = 2
            GROUP BY o_orderstatus""" for version in (1, 2)),
        "stored_entity_score": f"""
            WITH {CUSTOMER_SENTIMENT}
            SELECT * REPLACE (round(predicted_sentiment, 6) AS predicted_sentiment)
            FROM joined""",
        "json_fields": """
            WITH counted AS (
              SELECT unnest([
                {'field': '$', 'type': 'OBJECT', 'n': count(*)},
                {'field': '$.conv_id', 'type': 'BIGINT', 'n': count(conv_id)},
                {'field': '$.turn', 'type': 'STRING', 'n': count(turn) FILTER (conv_id % 7 = 0)},
                {'field': '$.turn', 'type': 'BIGINT',
                 'n': count(turn) FILTER (conv_id IS NULL OR conv_id % 7 <> 0)},
                {'field': '$.role', 'type': 'STRING', 'n': count(role)},
                {'field': '$.message', 'type': 'OBJECT', 'n': count(*)},
                {'field': '$.message.body', 'type': 'STRING', 'n': count(text)},
                {'field': '$.message.chars', 'type': 'BIGINT', 'n': count(text)},
                {'field': '$.tags', 'type': 'ARRAY', 'n': count(*) FILTER (conv_id % 5 = 0)},
                {'field': '$.tags[*]', 'type': 'STRING',
                 'n': count(*) FILTER (conv_id % 5 = 0)
                      + count(role) FILTER (conv_id % 5 = 0)},
                {'field': '$.tags[*]', 'type': 'VOID',
                 'n': count(*) FILTER (conv_id % 5 = 0 AND role IS NULL)}]) AS c
              FROM conversations)
            SELECT c.field AS field, c.type AS type, c.n AS n FROM counted WHERE c.n > 0""",
        "json_typed": """
            SELECT role, conv_id % 7 = 0 AS as_text, count(*) AS n,
                   CAST(sum(length(text)) AS BIGINT) AS chars,
                   CAST(sum(length(text)) AS BIGINT) AS chars_of_body,
                   count(role) FILTER (conv_id % 5 = 0) AS tagged, 'string' AS turn_type
            FROM conversations GROUP BY ALL""",
        "document_store": """
            SELECT * FROM customer
            WHERE c_acctbal BETWEEN 0 AND 5000 AND c_mktsegment <> 'BUILDING'""",
        "clustered_points": """
            SELECT * FROM customer WHERE c_acctbal BETWEEN 0 AND 5000 AND c_nationkey = 7""",
        "sketched_medians": " UNION ALL ".join(f"""
            SELECT l_returnflag, '{name}' AS parts, count(l_extendedprice) AS n,
                   min(l_extendedprice) AS least, max(l_extendedprice) AS most, true AS near
            FROM lineitem WHERE {wanted} GROUP BY l_returnflag"""
                                         for name, wanted in (("all", "true"),
                                                              ("odd", "l_orderkey % 2 = 1"))),
        **(llm.oracle_sql() if llm else {}),
    }

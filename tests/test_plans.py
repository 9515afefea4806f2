"""Plans: filters at the scan, no Python, no gathering into one partition, text handled once."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tastemap.functions.categories import first_category
from tastemap.operators.filters import filter_categories
from tastemap.operators.sampling import take_fraction
from tastemap.operators.sentiment import common_terms, prepare_reviews, token_stages
from tastemap.operators.stats import stats_by, weighted_f1
from tastemap.plans import jobs

SF = "/root/testdata/sf0.001"
# Final one-row results gather; nothing else does.
GATHERING = {"weighted_f1", "sentiment_quality", "count_features_svm"}
OWN = sorted(n for n in entry_points.queries() if not (n.startswith("op") or n == "pipeline"))
TRAINED = ("train_and_score", "sentiment_quality", "count_features_svm")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def executed_plans(spark, run):
    """The final plans of all queries that ``run`` executes, as adaptive execution left them."""
    store = spark._jsparkSession.sharedState().statusStore()

    def listed():
        spark._jsc.sc().listenerBus().waitUntilEmpty()
        rows = store.executionsList()
        return {rows.apply(i).executionId(): rows.apply(i) for i in range(rows.size())}

    # By id, since a session forgets its oldest executions.
    before = max(listed(), default=-1)
    run()
    return [row.physicalPlanDescription() for at, row in sorted(listed().items()) if at > before]


@pytest.mark.parametrize("name", TRAINED)
def test_no_text_is_shuffled_to_train_or_score(spark, no_broadcast, name):
    plans = executed_plans(spark, lambda: entry_points.queries()[name](spark, SF).collect())
    assert len(plans) > 3
    shuffles = [line for text in plans for line in text.split("\n")
                if "Arguments: " in line and "hashpartitioning" in line
                or "Arguments: " in line and "rangepartitioning" in line]
    assert shuffles
    assert not any("text#" in line for line in shuffles)


@pytest.mark.parametrize("name", OWN)
def test_no_python_and_no_gathering(spark, plan, no_broadcast, name):
    df = entry_points.queries()[name](spark, SF)
    df.collect()
    text = plan(df)
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert node not in text
    assert name in GATHERING or "SinglePartition" not in text


def test_category_filter_reaches_the_scan(spark, plan, tmp_path):
    path = str(tmp_path / "business")
    spark.createDataFrame([("b", "Restaurants, Thai", 4.0, "x")],
                          "business_id string, categories string, stars double, name string"
                          ).write.parquet(path)
    business = spark.read.parquet(path)
    text = plan(stats_by(filter_categories(business)
                         .withColumn("categories", first_category("categories")),
                         "categories", "stars"))
    assert "StringContains(categories,Restaurant)" in text
    assert "ReadSchema: struct<categories:string,stars:double>" in text


def test_fraction_does_not_move_rows(spark, plan):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert "Exchange" not in plan(take_fraction(orders, "o_orderkey", 1, 4))
    text = plan(jobs.rating_by_state(take_fraction(orders, "o_orderkey", 1, 4),
                                     "o_orderstatus", "o_totalprice"))
    assert text.count("Exchange") == 1 and "partial_avg" in text


def test_statistics_take_one_shuffle(spark, plan):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    text = plan(stats_by(lines, "l_returnflag", "l_tax", ("avg", "min", "max", "stddev")))
    assert text.count("Exchange") == 1


def test_median_reads_its_source_once(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    stats = ("avg", "min", "max", "median", "stddev", "count")
    plans = executed_plans(spark, lambda: stats_by(lines, "l_returnflag", "l_tax", stats).collect())
    scans = [text for text in plans if "lineitem.parquet" in text]
    # Range bounds are sampled inside the one query that reads the table.
    assert len(scans) == 1


@pytest.mark.parametrize("name", ["entity_score", "mean_of_means", "map_points"])
def test_scores_are_joined_plainly(spark, plan, no_broadcast, name):
    df = entry_points.queries()[name](spark, SF)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("orders.parquet") == 1 and final.count("customer.parquet") == 1


def test_text_is_cleaned_once(spark, plan):
    documents = spark.read.parquet(f"{SF}/documents.parquet").withColumn("stars", F.lit(5.0))
    prepared = prepare_reviews(documents, keep=("doc_id",))
    assert "IsNotNull(text)" in plan(prepared)
    counted = PipelineModel(token_stages()).transform(prepared).select(
        F.explode_outer("terms").alias("term")).where("term IS NOT NULL").groupBy("term").count()
    assert plan(counted).count("regexp_replace") == 1
    model = jobs.train(documents.withColumn("stars", F.col("doc_id") % 2 * 5), key="doc_id",
                       max_iter=2).model
    graded = plan(weighted_f1(model.transform(prepared)))
    assert graded.count("regexp_replace") == 1


def test_grading_reads_no_text(spark, plan):
    documents = spark.read.parquet(f"{SF}/documents.parquet").withColumn(
        "stars", F.col("doc_id") % 2 * 5)
    quality = plan(jobs.train(documents, key="doc_id", max_iter=2).quality)
    assert "regexp_replace" not in quality and "documents.parquet" not in quality


def test_counting_unusable_rows_keeps_the_scan_narrow(spark, plan):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    prepared = prepare_reviews(documents, keep=("doc_id",), rating="n_chars",
                               observation=Observation())
    assert "ReadSchema: struct<doc_id:bigint,text:string,n_chars:bigint>" in plan(prepared)


def test_common_terms_rest_on_written_counts(spark, plan):
    tokens = spark.createDataFrame([(["b", "a"],)], "terms array<string>")
    assert "Scan parquet" in plan(common_terms(tokens, 1))


def test_stored_scores_are_joined_where_they_are(spark, plan):
    df = entry_points.queries()["stored_entity_score"](spark, SF)
    df.collect()
    assert "Exchange" not in plan(df) and "SortMergeJoin" in plan(df)


def test_no_vector_is_shuffled_to_check_hashed_counts(spark, no_broadcast):
    plans = executed_plans(spark, lambda: entry_points.queries()["hashed_counts"](spark, SF).collect())
    shuffles = [text[text.index("Exchange"):] for text in plans if "Exchange" in text]
    assert shuffles and not any("values#" in t or "in_4096#" in t for t in shuffles)
    assert sum("text:string" in t for t in plans) == 1


def test_a_larger_table_of_texts_has_more_tasks(spark, tmp_path):
    rows = spark.range(30).selectExpr("id AS doc_id", "cast(id AS string) AS text", "'en' AS lang")
    found = {}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4000)  # each file is a split
    try:
        for files in (1, 30):
            rows.repartition(files).write.parquet(f"{tmp_path}/{files}/documents.parquet")
            labelled = entry_points._labelled(spark, f"{tmp_path}/{files}")
            found[files] = labelled.rdd.getNumPartitions(), labelled.count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[1] == (entry_points.TEXT_PARTITIONS, 30)
    assert found[30][0] > 2 * entry_points.TEXT_PARTITIONS and found[30][1] == 30

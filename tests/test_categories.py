import random

from tastemap.functions.categories import CUISINES, first_category
from tastemap.operators.filters import filter_categories
from tastemap.plans.jobs import CUISINE_STATS, rating_by_cuisine

ROWS = [("a", "Restaurants, Thai, Chinese", 4.0),
        ("b", "American (New), Restaurants", 3.0),
        ("c", "Restaurants, Pizza", 5.0),
        ("d", None, 5.0),
        ("e", "Chinese, Restaurants, Thai", 2.0),
        ("f", "Cajun/Creole, Restaurant Supplies", 1.0)]
WANTED = ("Thai", "Chinese", "American", "Cajun")


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id string, categories string, stars double")


def test_substring_filter_and_exact_label(spark):
    kept = filter_categories(table(spark), wanted=WANTED)
    labels = kept.select("id", first_category("categories", WANTED).alias("label")).collect()
    assert {tuple(r) for r in labels} == {
        ("a", "Thai"), ("b", "Other"), ("e", "Chinese"), ("f", "Other")}


def test_filter_is_case_sensitive_and_needs_a_word(spark):
    rows = [("x", "restaurants, thai", 1.0), ("y", "Restaurants, Thai", 1.0)]
    assert [r.id for r in filter_categories(table(spark, rows)).collect()] == ["y"]
    assert filter_categories(table(spark), wanted=()).count() == 0


def test_separator_is_comma_and_blank(spark):
    texts = ["Thai", "Thai,Greek", "x,  Thai", ", Thai", "", ",, Greek", "Thai , Greek"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    got = [r.label for r in df.select("i", first_category("c").alias("label")).sort("i").collect()]

    def by_hand(text):
        return next((t for t in text.split(", ") if t in CUISINES), "Other")

    assert got == [by_hand(t) for t in texts]


def test_random_lists(spark):
    rng = random.Random(11)
    pieces = ["Thai", "Greek", "Cajun/Creole", "Cajun", ", ", ", ", ", ", ",", " ", "x", "\n", "a+b"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(9))) for _ in range(3000)]
    wanted = ("Thai", "Cajun", "a+b", "x")
    df = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    got = df.select("i", first_category("c", wanted).alias("label")).sort("i").collect()
    for row, text in zip(got, texts):
        assert row.label == next((t for t in text.split(", ") if t in wanted), "Other"), text


def test_all_statistics_in_one_table(spark):
    rows = [(str(i), "Restaurants, Greek", float(s)) for i, s in enumerate((1, 2, 2, 5))]
    rows.append(("z", "Korean, Restaurants", 3.0))
    stats = rating_by_cuisine(table(spark, rows), stats=CUISINE_STATS)
    got = {r.categories: r.asDict() for r in stats.collect()}
    greek = got["Greek"]
    assert (greek["avg"], greek["min"], greek["max"], greek["median"]) == (2.5, 1.0, 5.0, 2.0)
    assert abs(greek["stddev"] - 3 ** 0.5) < 1e-12
    assert got["Korean"]["median"] == 3.0 and got["Korean"]["stddev"] is None

"""The questions asked of reviews and businesses, each a DataFrame from DataFrames.

Writing the result is the caller's. Column names are parameters with the
review schema as default, so that any rated and located table will do.
"""

from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation

from tastemap.functions.categories import CUISINES, RESTAURANT, first_category
from tastemap.operators.filters import filter_categories
from tastemap.operators.joins import join_entity_score
from tastemap.operators.sampling import split_by_hash
from tastemap.operators.sentiment import (count_stages, fit_classifier, prepare_reviews,
                                          score_reviews, term_counts)
from tastemap.operators.stats import stats_by, weighted_f1, weighted_mean_by

SENTIMENT = "predicted_sentiment"
CUISINE_STATS = ("avg", "min", "max", "median", "stddev")


def rating_by_state(business: DataFrame, state: str = "state", rating: str = "stars",
                    stats=("avg",)) -> DataFrame:
    """Rating statistics by state, the mean alone unless asked for more."""
    return stats_by(business, state, rating, stats)


def rating_by_cuisine(business: DataFrame, categories: str = "categories",
                      rating: str = "stars", stats=("avg",), required: str = RESTAURANT,
                      wanted=CUISINES) -> DataFrame:
    """Rating statistics of restaurants of the wanted cuisines, the mean alone unless
    asked for more."""
    kept = filter_categories(business, categories, required, wanted)
    return stats_by(kept.withColumn(categories, first_category(categories, wanted)),
                    categories, rating, stats)


def business_sentiment(review_sentiment: DataFrame, business: DataFrame,
                       key: str = "business_id", sentiment: str = SENTIMENT,
                       business_key: str | None = None) -> DataFrame:
    """Businesses with their mean sentiment, its sum and its number of reviews."""
    return join_entity_score(review_sentiment, business, key, sentiment, entity_key=business_key)


def sentiment_by_state(joined: DataFrame, state: str = "state", sentiment: str = SENTIMENT,
                       weighted: bool = False) -> DataFrame:
    """Mean over businesses, or over their reviews when ``weighted``."""
    if weighted:
        return weighted_mean_by(joined, state, f"{sentiment}_sum", f"{sentiment}_n", "avg")
    return stats_by(joined, state, sentiment)


def sentiment_by_cuisine(joined: DataFrame, categories: str = "categories",
                         sentiment: str = SENTIMENT, weighted: bool = False,
                         required: str = RESTAURANT, wanted=CUISINES) -> DataFrame:
    """Mean over restaurants of the wanted cuisines, or over their reviews when ``weighted``."""
    kept = filter_categories(joined, categories, required, wanted)
    labelled = kept.withColumn(categories, first_category(categories, wanted))
    return sentiment_by_state(labelled, categories, sentiment, weighted)


class Trained(NamedTuple):
    model: PipelineModel
    quality: DataFrame


def train(reviews: DataFrame, *, key: str = "review_id", text: str = "text",
          rating: str = "stars", threshold: float = 4, seed: int = 50, hashed: bool = True,
          features: str = "tfidf", max_iter: int = 50, reg_param: float = 0.3,
          aggregation_depth: int = 2, partitions: int | None = None,
          observation: Observation | None = None, **options) -> Trained:
    """Fit on four fifths of the reviews and grade on the rest.

    The test side plays no part in vocabulary and document frequencies.
    ``quality`` holds the weighted F1 of the model and of always guessing the
    commoner class. An ``observation`` counts the reviews left out. The side of a
    review is by a hash of its ``key``, or by an integer key itself without ``hashed``.
    """
    prepared = prepare_reviews(reviews, keep=(key,), text=text, rating=rating,
                               threshold=threshold, observation=observation)
    sides = {"seed": seed, "hashed": hashed}
    counts = count_stages(split_by_hash(prepared, key, **sides)[0], features, **options)
    # Both sides are counted in one reading of the text.
    fit_side, test_side = split_by_hash(term_counts(counts, prepared, (key,)), key, **sides)
    classifier = fit_classifier(fit_side, max_iter=max_iter, reg_param=reg_param,
                                aggregation_depth=aggregation_depth, partitions=partitions)
    return Trained(PipelineModel([*counts.stages, *classifier.stages]),
                   weighted_f1(classifier.transform(test_side)))


def train_count_features(reviews: DataFrame, **options) -> Trained:
    """The variant on plain term counts and uncollapsed blanks."""
    return train(reviews, **{"seed": 100, "collapse": False, "features": "count", **options})


def score(model: PipelineModel, reviews: DataFrame, *, key: str = "review_id",
          entity: str = "business_id", **columns) -> DataFrame:
    """Every review, with the label of its rating and the predicted one.

    Without a ``rating`` column the first is NULL, without text the second.
    """
    return score_reviews(model, reviews, keep=(key, entity), **columns)

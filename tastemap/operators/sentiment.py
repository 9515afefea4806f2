"""Sentiment classifier: cleaning, features, linear SVM, scoring."""

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import (IDF, CountVectorizerModel, HashingTF, SQLTransformer,
                                StopWordsRemover, Tokenizer)
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tastemap.functions.ratings import binarize_rating
from tastemap.functions.text import BLANK, BLANK_RUN
from tastemap.operators.ranking import take_rows
from tastemap.sources.durable import durable
from tastemap.sources.tables import check_target
from tastemap.sources.versions import is_versioned, publish_model, resolve

# Terms of a vocabulary unless the caller says otherwise.
VOCABULARY_SIZE = 1 << 18


def prepare_reviews(reviews: DataFrame, *, keep=("review_id",), text: str = "text",
                    rating: str | None = "stars", threshold: float = 4,
                    need_label: bool = True, observation: Observation | None = None) -> DataFrame:
    """Columns ``keep``, ``text`` and binary ``label``, without unusable rows.

    A row without text, or without rating where a label is needed, is unusable for
    training. An ``observation`` counts them (``no_text``, ``no_label``) along the way.
    """
    stars = F.lit(None).cast("double") if rating is None else F.col(rating)
    if observation is not None:
        # Nothing is pruned or pushed through the counting, so prune here.
        read = [*keep, text] if rating is None else [*keep, text, rating]
        reviews = reviews.select(*dict.fromkeys(read)).observe(
            observation, F.count_if(F.col(text).isNull()).alias("no_text"),
            F.count_if(stars.isNull()).alias("no_label"))
    # Tested on the raw columns, so that the test reaches the scan; after cleaning
    # it would be pushed down together with the cleaning, which then runs twice.
    usable = F.col(text).isNotNull()
    if need_label:
        usable &= stars.isNotNull()
    return (reviews.where(usable)
            .select(*keep, F.col(text).alias("text"),
                    binarize_rating(stars, threshold).alias("label")))


def token_stages(language: str = "english", collapse: bool = True) -> list:
    """Cleaned ``text`` in ``clean``, its tokens in ``words``, without stop words in ``terms``.

    Cleaning is a stage, so that a saved model cleans as it was trained.
    """
    blank = BLANK_RUN if collapse else BLANK
    return [
        SQLTransformer(
            statement=f"SELECT *, regexp_replace(text, r'{blank}', ' ') AS clean FROM __THIS__"),
        Tokenizer(inputCol="clean", outputCol="words"),
        StopWordsRemover(inputCol="words", outputCol="terms",
                         stopWords=StopWordsRemover.loadDefaultStopWords(language)),
    ]


def common_terms(tokens: DataFrame, size: int, on_terms=None) -> DataFrame:
    """The ``size`` commonest ``terms`` and their counts, ties by term."""
    # Unlike explode, explode_outer puts no size test, and so no second round of
    # tokenising, in front of itself.
    counts = durable(tokens.select(F.explode_outer("terms").alias("term"))
                     .where(F.col("term").isNotNull())
                     .groupBy("term").agg(F.count(F.lit(1)).alias("n"))
                     .withColumn("rarity", -F.col("n")))
    total = counts.count()
    if on_terms is not None:
        on_terms(total, max(0, total - size))
    if total > size:
        counts = take_rows(counts, ["rarity", "term"], size, unique=True)
    return counts.select("term", "n")


def count_stages(prepared: DataFrame, features: str = "tfidf", num_features: int = 20,
                 vocabulary_size: int = VOCABULARY_SIZE, language: str = "english",
                 collapse: bool = True, on_terms=None) -> PipelineModel:
    """Text to term counts: hashed for ``"tfidf"``, by vocabulary for ``"count"``.

    A vocabulary holds the ``vocabulary_size`` commonest terms, commonest first;
    ``on_terms`` is told how many terms there are and how many are left out.
    """
    stages = token_stages(language, collapse)
    if features == "tfidf":
        stages.append(HashingTF(inputCol="terms", outputCol="counts", numFeatures=num_features))
    elif features == "count":
        chosen = common_terms(PipelineModel(stages).transform(prepared), vocabulary_size, on_terms)
        # The model is a list of ``vocabulary_size`` words at most, so the driver holds it.
        words = [r.term for r in chosen.orderBy(F.desc("n"), "term").collect()]
        stages.append(CountVectorizerModel.from_vocabulary(
            words, inputCol="terms", outputCol="features"))
    else:
        raise ValueError(f"features must be tfidf or count, not {features}")
    return PipelineModel(stages)


def idf_weights(tokens: DataFrame, rows: int) -> DataFrame:
    """``term, idf`` for every term of ``rows`` tokenised texts, ``ln((rows + 1) / (texts + 1))``."""
    terms = tokens.select(F.explode_outer(F.array_distinct("terms")).alias("term"))
    return (terms.where(F.col("term").isNotNull()).groupBy("term")
            .agg(F.ln(F.lit(rows + 1) / (F.count(F.lit(1)) + 1)).alias("idf")))


def term_counts(counts: PipelineModel, prepared: DataFrame, keep=()) -> DataFrame:
    """``keep``, label and term counts of each review, written out.

    They are small beside the text. Document frequencies, the many rounds of
    the SVM and its grading all start from them, even after a lost executor.
    """
    column = counts.stages[-1].getOutputCol()
    return durable(counts.transform(prepared).select(*keep, "label", column))


def fit_classifier(table: DataFrame, *, max_iter: int = 50, reg_param: float = 0.3,
                   aggregation_depth: int = 2, partitions: int | None = None) -> PipelineModel:
    """Linear SVM on ``features``, preceded by the IDF of ``counts`` where there are any.

    Every round is a job over the partitions of ``table``, or over so many
    ``partitions`` if the caller knows that fewer will do.
    """
    if partitions is not None:
        table = table.coalesce(partitions)
    stages = []
    if "counts" in table.columns:
        idf = IDF(inputCol="counts", outputCol="features").fit(table)
        stages.append(idf)
        table = idf.transform(table)
    # The SVM keeps its own blocks of rows in memory or on disk between rounds.
    svm = LinearSVC(featuresCol="features", labelCol="label", maxIter=max_iter,
                    regParam=reg_param, aggregationDepth=aggregation_depth)
    # The copy is without the training summary, which would send the session,
    # and the training data's plan, to every scoring task.
    return PipelineModel([*stages, svm.fit(table).copy()])


def save_model(model: PipelineModel, path: str, sources=(), versioned: bool = False,
               keep: int | None = None) -> None:
    """Replace the model at ``path``, which holds none of the ``sources`` of the job.

    ``versioned`` keeps the old one until the new one is whole; a path that has versions
    always gets one more, and ``keep`` removes all but so many.
    """
    spark = SparkSession.active()
    if versioned or is_versioned(spark, path):
        publish_model(model, path, sources=sources, keep=keep)
        return
    check_target(spark, path, sources)
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """The model at ``path``, of versions the newest."""
    return PipelineModel.load(resolve(SparkSession.active(), path))


def score_reviews(model: PipelineModel, reviews: DataFrame, *, keep=("review_id", "business_id"),
                  text: str = "text", rating: str | None = "stars",
                  threshold: float = 4) -> DataFrame:
    """``keep``, the label from the rating and the predicted one, a row for every review.

    The prediction of a review without text is NULL.
    """
    stars = F.lit(None).cast("double") if rating is None else F.col(rating)
    rows = reviews.select(*keep, F.col(text).isNotNull().alias("_has_text"),
                          F.coalesce(F.col(text), F.lit("")).alias("text"),
                          binarize_rating(stars, threshold).alias("label"))
    return model.transform(rows).select(
        *keep, F.col("label").alias("rating_sentiment"),
        F.when(F.col("_has_text"), F.col("prediction")).alias("predicted_sentiment"))

"""Scores joined to the entities they describe."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Entity rows of one key that one task may take when keys repeat.
HOT_ROWS = 1_000_000


def join_entity_score(reviews: DataFrame, entities: DataFrame, key: str, value: str,
                      *, entity_key: str | None = None, repeated: bool = False,
                      hot_rows: int = HOT_ROWS) -> DataFrame:
    """Mean of ``value`` per ``key``, joined to every column of ``entities``.

    An inner join: entities without a review and reviews of unknown entities
    drop out. ``<value>_sum`` and ``<value>_n`` let a later step weight by
    review. The many side is aggregated first, so a much-reviewed entity
    shuffles no more rows than any other. Entities are taken to have a key each;
    say ``repeated`` if one key may have very many rows there.
    """
    entity_key = entity_key or key
    scores = (reviews.where(F.col(key).isNotNull())
              .groupBy(F.col(key).alias(entity_key))
              .agg(F.avg(value).alias(value),
                   F.sum(value).cast("double").alias(f"{value}_sum"),
                   F.count(value).alias(f"{value}_n")))
    if repeated:
        return join_unique(scores, entities, entity_key, hot_rows)
    return scores.join(entities, entity_key)


def join_unique(unique: DataFrame, many: DataFrame, key: str,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of a side with one row per ``key`` to a side that repeats keys.

    A key with more than ``hot_rows`` rows is cut into slices of about that
    size by the input partition its rows come from, and its one row on the
    other side is repeated per slice. At most rows / ``hot_rows`` keys can be
    hot. That costs a further reading of ``many``, so it is for callers who
    know that keys repeat. Whether the hot keys are sent out is left to Spark's
    size check.
    """
    hot = (many.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
           .where(F.col("_rows") > hot_rows)
           .select(key, F.expr(f"(_rows - 1) div {hot_rows} + 1").alias("_slices")))
    slices = F.coalesce(F.col("_slices"), F.lit(1))
    left = (unique.join(hot, key, "left")
            .withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1)))
            .drop("_slices"))
    right = (many.withColumn("_from", F.spark_partition_id().cast("bigint"))
             .join(hot, key, "left").withColumn("_slice", F.pmod("_from", slices))
             .drop("_slices", "_from"))
    return left.join(right, [key, "_slice"]).drop("_slice")


def partial_scores(reviews: DataFrame, key: str, value: str) -> DataFrame:
    """Sum and number of ``value`` per ``key``: what a batch of reviews adds to the score store.

    A much-reviewed entity is one row here, so no bucket of the store is larger for it.
    """
    return (reviews.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.sum(value).cast("double").alias(f"{value}_sum"),
                 F.count(value).alias(f"{value}_n")))


def join_stored_scores(partials: DataFrame, entities: DataFrame, key: str, value: str,
                       *, entity_key: str | None = None) -> DataFrame:
    """:func:`join_entity_score` from stored :func:`partial_scores` of all batches.

    With both sides in buckets of their keys neither the aggregation nor the join moves
    a row; otherwise the planner moves what it must and the rows are the same.
    """
    entity_key = entity_key or key
    total, n = F.sum(f"{value}_sum"), F.sum(f"{value}_n")
    scores = partials.groupBy(key).agg(F.try_divide(total, n).alias(value),
                                       total.alias(f"{value}_sum"), n.alias(f"{value}_n"))
    # A broadcast would send out the smaller side, buckets or not.
    joined = scores.withColumnRenamed(key, entity_key) if key != entity_key else scores
    return joined.hint("merge").join(entities, entity_key)

"""Columns that the review jobs expect, and the check made at the edge of a job."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

REVIEW = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("stars", T.DoubleType()),
])

BUSINESS = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("postal_code", T.StringType()),
    T.StructField("categories", T.StringType()),
    T.StructField("stars", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

REVIEW_SENTIMENT = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("rating_sentiment", T.IntegerType()),
    T.StructField("predicted_sentiment", T.DoubleType()),
])

JOINED_SENTIMENT = T.StructType([
    *BUSINESS.fields,
    T.StructField("predicted_sentiment", T.DoubleType()),
    T.StructField("predicted_sentiment_sum", T.DoubleType()),
    T.StructField("predicted_sentiment_n", T.LongType()),
])


def check_columns(df: DataFrame, expected: T.StructType, only=None) -> DataFrame:
    """Return ``df`` if it has the expected columns, else raise naming every fault.

    Any numeric type passes for a numeric column. ``only`` limits the check to
    the columns a job really reads.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    faults = []
    for field in expected.fields:
        if only is not None and field.name not in only:
            continue
        found = actual.get(field.name)
        if found is None:
            faults.append(f"{field.name} is missing")
        elif isinstance(field.dataType, T.NumericType):
            if not isinstance(found, T.NumericType):
                faults.append(f"{field.name} is {found.simpleString()}, not a number")
        elif found != field.dataType:
            faults.append(f"{field.name} is {found.simpleString()}, "
                          f"not {field.dataType.simpleString()}")
    if faults:
        raise ValueError("unfit table: " + "; ".join(faults))
    return df

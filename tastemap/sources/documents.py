"""JSON documents without a schema: VARIANT columns, and types found by counting them all.

A document store hands over fields whose types differ from document to document. Guessing
a schema from a sample drops what does not fit; here every value of every document is
counted by its type, and what a chosen type cannot hold is counted too.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT = "document"
NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``document``, a VARIANT for each line of JSON, and ``malformed``, a line that is none.

    Blank lines are left out.
    """
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    document = F.try_parse_json("value")
    return lines.select(document.alias(DOCUMENT),
                        F.when(document.isNull(), F.col("value")).alias("malformed"))


def type_of(value: Column | str) -> Column:
    """Type of a VARIANT value without its parts: OBJECT, ARRAY, STRING, BIGINT, DECIMAL, VOID..."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z_ ]+", 0)


def inferred_schema(documents: DataFrame, column: str = DOCUMENT) -> str:
    """The one type that holds all documents, VARIANT wherever they differ too much."""
    return documents.agg(F.schema_of_variant_agg(column)).first()[0]


def document_fields(documents: DataFrame, depth: int = 3, column: str = DOCUMENT) -> DataFrame:
    """``field, type, n``: how many values of which type every field has, ``depth`` levels down.

    Fields are paths such as ``$.message.tags[*]``; ``$`` is the document itself. A null
    document has no fields. All levels come from one reading: each level is exploded in
    turn, and a value is counted at the first of its parts.
    """
    rows = documents.where(F.col(column).isNotNull()).select(F.col(column).alias("v0"),
                                                             F.lit("$").alias("f0"))
    first = F.lit(True)
    counted = []
    for level in range(1, depth + 1):
        above, path = f"v{level - 1}", f"f{level - 1}"
        # A value without parts stays, as a row without a position.
        parts = rows.sparkSession.tvf.variant_explode_outer(F.col(above).outer())
        rows = rows.lateralJoin(parts.withColumnsRenamed(
            {"pos": f"p{level}", "key": f"k{level}", "value": f"v{level}"}))
        rows = rows.withColumn(f"f{level}", F.concat(path, _step(f"k{level}"))).drop(f"k{level}")
    for level in range(depth, -1, -1):
        here = first if level == 0 else F.col(f"p{level}").isNotNull()
        once = first
        for below in range(level + 1, depth + 1):
            once = once & (F.coalesce(f"p{below}", F.lit(0)) == 0)
        counted.append(F.when(here & once, F.struct(F.col(f"f{level}").alias("field"),
                                                    type_of(f"v{level}").alias("type"))))
    return (rows.select(F.explode(F.array(*counted)).alias("c")).where("c IS NOT NULL")
            .groupBy("c.field", "c.type").agg(F.count(F.lit(1)).alias("n")))


def _step(key: str) -> Column:
    """A part's step in the path: a plain name, a quoted one, or any element of an array."""
    plain = F.col(key).rlike("^[A-Za-z_][A-Za-z0-9_]*$")
    quoted = F.concat(F.lit("['"), F.regexp_replace(key, r"(['\\])", r"\\$1"), F.lit("']"))
    return F.when(F.col(key).isNull(), "[*]").when(plain, F.concat(F.lit("."), key)).otherwise(quoted)


class Chosen(NamedTuple):
    """A field, the type that it is read as, and how its values take it."""

    path: str
    type: str
    values: int
    unfit: int


def common_type(types: set[str]) -> str:
    """The type that values of several types are read as; without any value a string."""
    types = types - {"VOID", ""}
    if types & {"OBJECT", "ARRAY"}:
        return "variant"
    if len(types) > 1 and types <= set(NUMBERS):
        return "double"
    if len(types) != 1:
        return "string"
    return {"DECIMAL": "double"}.get(*types, *types).lower()


def choose_types(documents: DataFrame, fields: dict[str, str], column: str = DOCUMENT,
                 **wanted: str) -> dict[str, Chosen]:
    """A type for each of ``fields`` (name to path) from all of its values.

    Two readings, and a row to the driver each: the types that occur, then the values that
    are not null and those among them that the type cannot hold. Types in ``wanted`` are
    taken as given, so that their misfits can be counted before rows are read by them.
    """
    values = {name: F.variant_get(column, path, "variant") for name, path in fields.items()}
    types = dict(wanted)
    open_fields = [n for n in fields if n not in wanted]
    if open_fields:
        found = documents.agg(*(F.collect_set(type_of(values[n])).alias(n) for n in open_fields))
        found = found.first()
        types |= {n: common_type(set(found[n])) for n in open_fields}
    counts = documents.agg(*(c for n in fields for c in (
        F.count_if(_filled(values[n])).alias(f"{n} filled"),
        F.count_if(_filled(values[n]) & F.try_variant_get(column, fields[n], types[n]).isNull())
        .alias(f"{n} unfit")))).first()
    return {n: Chosen(fields[n], types[n], counts[f"{n} filled"], counts[f"{n} unfit"])
            for n in fields}


def _filled(value: Column) -> Column:
    return value.isNotNull() & ~F.is_variant_null(value)


def typed(documents: DataFrame, chosen: dict[str, Chosen], keep=(),
          column: str = DOCUMENT) -> DataFrame:
    """Columns of the chosen types; NULL where the field is missing, null, or does not fit."""
    return documents.select(*keep, *(F.try_variant_get(column, c.path, c.type).alias(name)
                                     for name, c in chosen.items()))

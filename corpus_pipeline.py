"""The corpus pipeline: from raw documents to packed token sequences.

Each stage works on all that its predecessor kept, written as Parquet and read
again. All but the last return the columns of the documents.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.llm import lines, mixing, outliers, packing, simhash
from tastemap.llm.shared import table
from tastemap.sources.durable import durable

TOKENIZER = "word_bpe_49k.json"
MAX_TOKENS, END_ID = 4096, 1


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return outliers.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one line of each class of fuzzy duplicates; emptied ones go.

    A null text stays null; ``n_chars``, where there is such a column, follows the text.
    """
    kept = lines.keep_first_lines(docs)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of SimHash fingerprints, four-word shingles, four bits."""
    return simhash.keep_one(docs, max_bits=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens have the target shares of sources, languages and topics."""
    return mixing.sample(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences."""
    pieces = packing.cut_documents(docs, public_tokenizers.path(TOKENIZER), END_ID, MAX_TOKENS)
    return packing.pack_pieces(pieces, MAX_TOKENS)


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mixing", mix),
    ("packing", pack),
]

# Estimates, hashes and tokens are beyond SQL; a test compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs

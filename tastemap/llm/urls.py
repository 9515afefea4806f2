"""URL rules found through a blocked Bloom filter and an exact hash join.

A listed URL is a host and the start of a path; it fits its host and all
subdomains. The filter holds the listed URLs; of each page's possible ones, those
that the filter passes go to the join with the list, which removes the false ones.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tastemap.llm.shared import ship_code

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A block is eight words of 64 bits, one bit of each per key. The filter has some
# bits a key but never more bytes than this; a longer list only passes more false hits.
WORDS = 8
BITS_PER_KEY = 24
MOST_BYTES = 32 << 20
# Odd multipliers that pick the bit in each word.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
               0x27D4EB2F165667C5, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def url_host(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: str | Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow",
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    ``rules`` has ``host``, ``path`` and ``verdict`` (``allow`` or ``block``). A
    rule fits its host and all subdomains if the url's path starts with the
    rule's; of those that fit the longest gives the verdict, by host and path
    together, then by host. Where none fits ``rule`` is null and the verdict is
    ``default``. Of rules with the same host and path the blocking one counts;
    rules with a null, and an empty host, fit nothing. A null url has an empty
    host and path. Repeated rows and null ids are judged each for themselves, other
    columns are not read, no pages give no rows.
    """
    ship_code(pages.sparkSession)
    rules = (rules.select(F.translate("host", UPPER, LOWER).alias("_rule_host"),
                          F.col("path").alias("_rule_path"), "verdict")
             .where("_rule_host <> '' AND _rule_path IS NOT NULL AND verdict IS NOT NULL")
             .groupBy("_rule_host", "_rule_path").agg(F.max("verdict").alias("_verdict")))
    url = F.coalesce(F.col(url_col), F.lit(""))
    urls = pages.select(F.col(id_col).alias("page_id"), url_host(url).alias("host"),
                        url_path(url).alias("path"),
                        F.monotonically_increasing_id().alias("_row"))
    possible = _passed(urls, rules)
    exact = (possible.select("page_id", "host", "path", "_row", F.explode_outer("_keys").alias("k"))
             .join(rules, (F.col("k.host") == F.col("_rule_host"))
                   & (F.col("k.path") == F.col("_rule_path")), "left"))
    rule = F.concat("_rule_host", "_rule_path")
    best = F.max_by(F.struct(rule.alias("rule"), F.col("_verdict").alias("verdict")),
                    F.when(rule.isNotNull(), F.struct(F.length(rule), F.length("_rule_host"))))
    judged = exact.groupBy("_row").agg(F.first("page_id").alias("page_id"),
                                       F.first("host").alias("host"),
                                       F.first("path").alias("path"), best.alias("best"))
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                         F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def _passed(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` with ``_keys``: the hosts and path starts that may be listed."""
    # A listed URL is found among as many last labels and first characters as it has.
    shape = F.struct(F.size(F.split("_rule_host", r"\.")).alias("labels"),
                     F.length("_rule_path").alias("length"))
    shapes = [tuple(r[0]) for r in rules.select(shape).distinct().collect()]
    if not shapes:
        return urls.withColumn("_keys", F.lit(None).cast("array<struct<host:string,path:string>>"))
    each = F.array(*(F.struct(F.lit(a).alias("labels"), F.lit(b).alias("length"))
                     for a, b in sorted(shapes)))
    urls = urls.withColumns({"_shapes": each, "_labels": F.size(F.split("host", r"\."))})
    keys = F.expr("""transform(
        filter(_shapes, s -> s.labels <= _labels AND s.length <= length(path)),
        s -> struct(substring_index(host, '.', -s.labels) AS host,
                    substring(path, 1, s.length) AS path))""")
    hashes = F.transform("_keys", lambda k: F.xxhash64(k["host"], k["path"]))
    urls = (urls.withColumn("_keys", keys).withColumn("_hashes", hashes)
            .select("page_id", "host", "path", "_row", "_keys", "_hashes"))
    bloom = urls.sparkSession.sparkContext.broadcast(build_filter(rules.select(
        F.xxhash64("_rule_host", "_rule_path").alias("key"))))
    schema = StructType(urls.schema.fields[:-1])

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, hashes = batch.column("_keys"), batch.column("_hashes")
            hit = may_contain(bloom.value, hashes.flatten().to_numpy(zero_copy_only=False))
            ends = np.r_[0, np.cumsum(hit)][hashes.offsets.to_numpy() - hashes.offsets[0].as_py()]
            left = keys.flatten().filter(pa.array(hit))
            kept = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), left, type=keys.type)
            yield pa.record_batch([*batch.columns[:-2], kept], schema.names)

    return urls.mapInArrow(passed, schema)


def build_filter(keys: DataFrame) -> np.ndarray:
    """The filter of the 64-bit integers ``key``: blocks of ``WORDS`` words.

    Bits are gathered block by block on the executors; the driver gets one row
    per block in use, at most ``MOST_BYTES``.
    """
    wanted = keys.count() * BITS_PER_KEY // (64 * WORDS) + 1
    blocks = min(wanted, MOST_BYTES // (8 * WORDS))
    bits = keys.mapInArrow(lambda batches: _key_bits(batches, blocks), "block long, " + ", ".join(
        f"w{i} long" for i in range(WORDS)))
    found = np.zeros((blocks, WORDS), np.uint64)
    rows = bits.groupBy("block").agg(*(F.bit_or(f"w{i}") for i in range(WORDS))).collect()
    for block, *words in rows:
        found[block] = np.array(words, np.int64).view(np.uint64)
    return found


def _key_bits(batches: Iterator[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        block, masks = _places(batch.column("key").to_numpy(), blocks)
        yield pa.record_batch([pa.array(block), *(pa.array(m.view(np.int64)) for m in masks.T.copy())],
                              ["block", *(f"w{i}" for i in range(WORDS))])


def _places(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each key, and its bit in each of the block's words."""
    keys = keys.astype(np.int64).view(np.uint64)
    block = ((keys >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
    low = keys & np.uint64(0xFFFFFFFF)
    bit = (low[:, None] * np.array(MULTIPLIERS, np.uint64)) >> np.uint64(58)
    return block, np.uint64(1) << bit


def may_contain(bloom: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter; never false for one that is."""
    block, masks = _places(keys, len(bloom))
    return ((bloom[block] & masks) == masks).all(axis=1)

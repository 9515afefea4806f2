"""One query per operator over the given tables; each applies its operator to whole tables."""

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.llm import (divergence, lines, mixing, negatives, outliers, packing, repeats, seekable,
                          simhash, slots, toxicity, urls, vectors)
from tastemap.llm.shared import table
from tastemap.sources.durable import durable

TOKENIZER = "word_bpe_49k.json"

# The URL rules, as host, path and verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_seekable_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    files = seekable.write_tokens(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path(TOKENIZER), end_id=2)
    return seekable.read_tokens(files)


def op2_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of near equal bytes."""
    placed = slots.shard_documents(table(spark, sf_dir, "documents"), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op3_pca_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate class of every vector."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op4_bloom_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on the url of every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge_urls(table(spark, sf_dir, "pages"), rules)


def op5_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, and the numbers of those that duplicate others."""
    found = lines.duplicate_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed")


def op6_gray_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), max_bits=4)


def op7_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a third of the ids is held out of training."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    machine = toxicity.train(toxicity.training_rows(docs, labels.where(~held_out)))
    scored = toxicity.score(docs, machine)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_raked_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic, probability and draw of every document, raked to tempered shares."""
    rows, _, chances = mixing.mixture(table(spark, sf_dir, "documents"))
    return mixing.judge(rows, chances).select(
        F.col("_c0").alias("doc_id"), F.col("_topic").alias("topic"),
        F.col("_tokens").alias("n_tokens"), "probability", "kept")


def op9_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    statistics = durable(outliers.with_statistics(docs, keep=["doc_id", "lang", "source"]))
    judged = outliers.judge(statistics, outliers.fit(statistics))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "distance")


def op10_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut and packed into sequences of 4096 tokens."""
    pieces = packing.cut_documents(table(spark, sf_dir, "documents"),
                                   public_tokenizers.path(TOKENIZER), end_id=1, max_tokens=4096)
    return packing.pack_pieces(pieces, 4096)


def op11_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without the 100-byte strings that start earlier."""
    found = repeats.without_repeats(table(spark, sf_dir, "documents"), length=100)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op12_gnat_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, some labels changed on purpose."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.hard_negatives(rows, anchor=F.col("vec_id") % 50 == 0)


def op13_term_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the terms of each source differ from those of its language's others."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query name -> callable of session and folder of tables."""
    return {
        "op1_seekable_tokens": op1_seekable_tokens,
        "op2_virtual_slots": op2_virtual_slots,
        "op3_pca_tiles": op3_pca_tiles,
        "op4_bloom_urls": op4_bloom_urls,
        "op5_fuzzy_lines": op5_fuzzy_lines,
        "op6_gray_simhash": op6_gray_simhash,
        "op7_string_kernel": op7_string_kernel,
        "op8_raked_mixture": op8_raked_mixture,
        "op9_robust_outliers": op9_robust_outliers,
        "op10_pattern_packing": op10_pattern_packing,
        "op11_run_length_index": op11_run_length_index,
        "op12_gnat_negatives": op12_gnat_negatives,
        "op13_term_divergence": op13_term_divergence,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    """Query name -> the same in SQL, where SQL can express it."""
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return {
        "op4_bloom_urls": f"""
            WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {rules}),
              rests AS (SELECT page_id, CASE WHEN contains(url, '://')
                               THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
                        FROM pages),
              parts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rests),
              urls AS (SELECT page_id, translate(raw, '{urls.UPPER}', '{urls.LOWER}') AS host,
                              regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
                       FROM parts),
              fits AS (SELECT page_id, rule_host || rule_path AS rule, rule_verdict,
                              row_number() OVER (PARTITION BY page_id ORDER BY
                                  length(rule_host || rule_path) DESC, length(rule_host) DESC) AS n
                       FROM urls JOIN rules
                         ON (host = rule_host OR ends_with(host, '.' || rule_host))
                        AND starts_with(path, rule_path))
            SELECT urls.page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
            FROM urls LEFT JOIN fits ON urls.page_id = fits.page_id AND n = 1""",
        "op12_gnat_negatives": """
            WITH usable AS (
                SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                       list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
                FROM embeddings
                WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
              scored AS (
                SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
                       CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
                FROM usable AS a JOIN usable AS b ON a.vec_id <> b.vec_id
                WHERE a.vec_id % 50 = 0),
              positives AS (
                SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored
                WHERE same
                QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
            SELECT anchor_id, positive_id,
                   CAST(row_number() OVER (PARTITION BY anchor_id, positive_id
                                           ORDER BY score DESC, other) AS INTEGER) AS rank,
                   other AS negative_id, positive_score, score AS negative_score
            FROM positives JOIN scored USING (anchor_id)
            WHERE NOT same AND 50 * positive_score <= 100 * score
              AND 100 * score <= 95 * positive_score
            QUALIFY rank <= 3""",
        "op13_term_divergence": rf"""
            WITH docs AS (
                SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang,
                       coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
              words AS (
                SELECT doc, lang, source, translate(unnest(regexp_extract_all(
                           text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                           '{urls.UPPER}', '{urls.LOWER}') AS term FROM docs),
              uses AS (SELECT doc, lang, source, term, count(*) AS n FROM words GROUP BY ALL),
              kept AS (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n_lang FROM uses
                       GROUP BY lang, term HAVING count(*) >= {divergence.LEAST_DOCS}),
              counts AS (SELECT lang, source, term, CAST(sum(n) AS HUGEINT) AS n
                         FROM uses JOIN kept USING (lang, term) GROUP BY ALL),
              sources AS (SELECT DISTINCT lang, source FROM docs),
              langs AS (SELECT lang, count(*) AS v, sum(n_lang) AS total_lang FROM kept
                        GROUP BY lang),
              totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
              shares AS (
                SELECT lang, source, term, coalesce(n, 0) AS n,
                       1 + ({divergence.WHOLE}::HUGEINT * (coalesce(n, 0) + 5))
                           // CAST(coalesce(total, 0) + 5 * v AS HUGEINT) AS p,
                       1 + ({divergence.WHOLE}::HUGEINT * (n_lang + 5))
                           // CAST(total_lang + 5 * v AS HUGEINT) AS q
                FROM sources JOIN kept USING (lang) JOIN langs USING (lang)
                LEFT JOIN totals USING (lang, source) LEFT JOIN counts USING (lang, source, term)),
              parts AS (
                SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                       CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
                FROM sources AS a JOIN sources AS b ON a.lang = b.lang AND a.source <> b.source
                LEFT JOIN shares AS x ON x.lang = a.lang AND x.source = a.source
                LEFT JOIN shares AS y ON y.lang = b.lang AND y.source = b.source
                                     AND y.term = x.term
                GROUP BY ALL
                UNION ALL
                SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM shares
                WHERE n > 0 AND p > q)
            SELECT lang, source, part, item, value,
                   CAST(row_number() OVER (PARTITION BY lang, source, part
                                           ORDER BY value DESC, item) AS INTEGER) AS rank
            FROM parts QUALIFY part = 'pair' OR rank <= {divergence.TOP}""",
    }

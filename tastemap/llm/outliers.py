"""Quality rules by robust multivariate outliers.

Word and line statistics of each text are transformed to a vector; the vectors of
a language and source get a minimum-covariance-determinant estimate, and a text
far from it by Mahalanobis distance is rejected. The estimate covers all rows:
its concentration steps are aggregations over groups, without a sample.
"""

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from tastemap.llm.shared import let_go, ship_code
from tastemap.sources.durable import durable

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
FEATURES = ("length", "word_length", "symbols", "dup_lines", "repeats")
# Least spread of each feature: none is taken to vary less among good texts.
FLOORS = (0.5, 0.1, 0.4, 0.1, 0.1)
# Share of the rows of a group that the estimate is concentrated on, and its steps.
CORE = 0.5
STEPS = 4
# Rows a group needs for an estimate of its own; smaller ones take that of their language,
# small languages that of all rows.
LEAST_ROWS = 100
# Chance at which a good text of normal features would be rejected.
TAIL = 1e-7
# Parts that a level's sums are formed in.
PARTS = 64
# Bins of a feature, and of the logarithm of a distance, to the unit.
BINS = 128


def text_statistics(text: bytes | None) -> tuple[int, ...]:
    """The ``STATISTICS`` of a UTF-8 text; words stand between ASCII blanks, null has none."""
    text = text or b""
    words = text.split()
    if not words:
        return (0, 0, 0, 0, 0, 0) if not text else (0, 0, *_symbols_only(text), 0, 0, 0)
    seen, lines, same = set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            same += line in seen
            seen.add(line)
    chars = len(b"".join(words).decode())
    return len(words), chars, *_symbols_only(text), same, _repeated(words), lines


def _symbols_only(text: bytes) -> tuple[int]:
    return (sum(map(text.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))),)


def _repeated(words: list[bytes]) -> int:
    """Words in some three-word window that the text holds twice or more."""
    if len(words) < 4:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    # Two words make a pair's number, the pair and the third word the window's.
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, window, counts = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True,
                                  return_counts=True)
    twice = counts[window] > 1
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[shift:len(words) - 2 + shift] |= twice
    return int(inside.sum())


def with_statistics(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None,
                    prefix: str = "") -> DataFrame:
    """Columns ``keep`` (all if not given) of every row, and the ``STATISTICS`` of its whole text."""
    ship_code(docs.sparkSession)
    kept = docs.columns if keep is None else keep
    schema = StructType([docs.schema[c] for c in kept])
    for name in STATISTICS:
        schema = schema.add(f"{prefix}{name}", LongType())
    source = docs.select(*kept, F.col(text_col).cast("binary").alias("_text_bytes"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            rows = [text_statistics(t) for t in batch.column(len(kept)).to_pylist()]
            table = np.array(rows, np.int64).reshape(-1, len(STATISTICS))
            yield pa.record_batch([*batch.columns[:-1], *map(pa.array, table.T.copy())],
                                  schema.names)

    return source.mapInArrow(compute, schema)


def base_failed(prefix: str = "") -> F.Column:
    """Under 50 words, or over half of them in repeated windows."""
    n, repeats = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 50) | (100 * repeats > 50 * n)


def features(prefix: str = "") -> list[F.Column]:
    """The ``FEATURES`` by the statistics: logarithms of sizes and rates, shares as they are."""
    n, chars, symbols, same, repeats, lines = (F.col(f"{prefix}{c}").cast("double")
                                               for c in STATISTICS)
    words = F.greatest(n, F.lit(1.0))
    return [F.ln(words), F.ln(F.greatest(chars, F.lit(1.0)) / words),
            F.ln(symbols / F.greatest(chars, F.lit(1.0)) + 0.005),
            same / F.greatest(lines, F.lit(1.0)), repeats / words]


def _keys(lang_col: str, source_col: str) -> dict[str, F.Column]:
    """A row's groups, finest first; null is a value like others."""
    lang = F.coalesce(F.concat(F.lit("="), F.col(lang_col).cast("string")), F.lit("-"))
    source = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("-"))
    return {"_fine": F.concat(lang, F.lit("\x00"), source), "_middle": lang, "_all": F.lit("")}


def fit(statistics: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Estimates ``_fine, center, precision`` for each language and source.

    ``statistics`` is a written table with the ``STATISTICS``, language and source.
    Rows that fail the base rules take no part. Each level's estimate starts from
    medians and quartiles; a concentration step keeps the ``CORE`` share of a
    group's rows nearest to its estimate and takes their mean and covariance.
    """
    ship_code(statistics.sparkSession)
    names = [f"x{i}" for i in range(len(FEATURES))]
    rows = (statistics.where(~base_failed())
            .select(*(x.alias(n) for n, x in zip(names, features())),
                    *(key.alias(name) for name, key in _keys(lang_col, source_col).items())))
    sizes = rows.groupBy("_fine", "_middle", "_all").agg(F.count(F.lit(1)).alias("n"))
    middle = Window.partitionBy("_middle")
    # Every group has one level: its own, its language or all.
    level = (F.when(F.col("n") >= LEAST_ROWS, F.col("_fine"))
             .when(F.sum("n").over(middle) >= LEAST_ROWS, F.col("_middle")).otherwise(F.lit("")))
    levels = durable(sizes.select("_fine", "_middle", "_all", level.alias("_own")))
    # A coarse level is fitted to all its rows, whether or not their group uses it.
    used = durable(levels.select(F.col("_own").alias("_level")).distinct())
    rows = durable(rows.withColumn("_level", F.explode(F.array("_fine", "_middle", "_all")))
                   .select("_level", *names).join(used, "_level"))
    estimate = durable(_start(rows, names))
    for _ in range(STEPS):
        estimate = durable(_concentrate(rows, estimate, names))
    return (levels.select("_fine", F.col("_own").alias("_level"))
            .join(estimate, "_level").select("_fine", "center", "precision"))


def _start(rows: DataFrame, names: list[str]) -> DataFrame:
    """Median, and a diagonal precision by quartiles, of each level."""
    long = rows.select("_level", F.posexplode(F.array(*names)).alias("f", "x"))
    counts = long.groupBy("_level", "f", F.floor(F.col("x") * BINS).alias("b")).count()
    order = Window.partitionBy("_level", "f").orderBy("b")
    whole = Window.partitionBy("_level", "f")
    share = F.sum("count").over(order) / F.sum("count").over(whole)
    middle = (F.col("b") + 0.5) / BINS
    at = {q: F.min(F.when(F.col("share") >= q, middle)) for q in (0.25, 0.5, 0.75)}
    found = (counts.withColumn("share", share).groupBy("_level", "f")
             .agg(at[0.5].alias("median"), ((at[0.75] - at[0.25]) / 1.349).alias("spread")))
    floor = F.get(F.array(*map(F.lit, FLOORS)), F.col("f"))
    weight = 1 / (F.pow("spread", F.lit(2)) + F.pow(floor, F.lit(2)))
    found = found.groupBy("_level").agg(F.array_sort(F.collect_list(
        F.struct("f", "median", weight.alias("weight")))).alias("s"))
    size = len(names)
    diagonal = [F.when(F.lit(i == j), F.get(F.col("s.weight"), F.lit(i))).otherwise(0.0)
                for i in range(size) for j in range(size)]
    return found.select("_level", F.col("s.median").alias("center"),
                        F.array(*diagonal).alias("precision"))


def distance(names: list, center: str = "center", precision: str = "precision") -> F.Column:
    """Squared Mahalanobis distance of a row's features from its estimate."""
    size = len(names)
    off = [F.col(x) - F.get(center, F.lit(i)) for i, x in enumerate(names)]
    return sum((off[i] * off[j] * F.get(precision, F.lit(i * size + j)) * (1 + (i != j))
                for i in range(size) for j in range(i, size)), F.lit(0.0))


def _concentrate(rows: DataFrame, estimate: DataFrame, names: list[str]) -> DataFrame:
    """Estimates by the nearest rows of each level."""
    # Distances are cut into bins, so that the cut of a level is a sum over few counts.
    place = F.floor(F.ln(distance(names) + 1e-9) * BINS)
    counts = rows.join(estimate, "_level").groupBy("_level", place.alias("_bin")).count()
    order = Window.partitionBy("_level").orderBy("_bin")
    share = F.sum("count").over(order) / F.sum("count").over(Window.partitionBy("_level"))
    cuts = (counts.withColumn("share", share).groupBy("_level")
            .agg(F.min(F.when(F.col("share") >= CORE, F.col("_bin"))).alias("_cut")))
    # Written out, so that its size is known: a join with more levels than can be sent out
    # splits a large level, and its sums are formed in parts.
    cuts = durable(estimate.join(cuts, "_level"))
    core = (rows.join(cuts, "_level").where(place <= F.col("_cut"))
            .withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(PARTS))))
    size = len(names)
    off = [F.col(x) - F.get("center", F.lit(i)) for i, x in enumerate(names)]
    products = {f"s{i}": o for i, o in enumerate(off)} | {
        f"p{i}_{j}": off[i] * off[j] for i in range(size) for j in range(i, size)}
    parts = core.groupBy("_level", "_part").agg(
        F.count(F.lit(1)).alias("n"), F.first("center").alias("center"),
        *(F.sum(p).alias(name) for name, p in products.items()))
    sums = parts.groupBy("_level").agg(
        F.sum("n").alias("n"), F.first("center").alias("center"),
        F.array(*(F.sum(f"s{i}") for i in range(size))).alias("first"),
        F.array(*(F.sum(p) for p in products if p.startswith("p"))).alias("second"))
    schema = "_level string, center array<double>, precision array<double>"
    return sums.mapInArrow(_moments, schema)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Center and precision of each level from its sums."""
    size = len(FEATURES)
    upper = np.triu_indices(size)
    # What the covariance of the core of normal rows must be multiplied by.
    factor = CORE / chi2_share(chi2_at(CORE, size), size + 2)
    for batch in batches:
        centers, precisions = [], []
        for row in batch.to_pylist():
            mean = np.array(row["first"]) / row["n"]
            square = np.zeros((size, size))
            square[upper] = np.array(row["second"]) / row["n"]
            square = square + square.T - np.diag(np.diag(square))
            covariance = factor * (square - np.outer(mean, mean)) + np.diag(np.square(FLOORS))
            centers.append((np.array(row["center"]) + mean).tolist())
            precisions.append(np.linalg.inv(covariance).ravel().tolist())
        yield pa.record_batch([batch.column("_level"), pa.array(centers, pa.list_(pa.float64())),
                               pa.array(precisions, pa.list_(pa.float64()))],
                              ["_level", "center", "precision"])


def chi2_share(x: float, freedom: int) -> float:
    """Chance that a chi-squared variable is below ``x``, for odd or even ``freedom``."""
    if freedom % 2:
        share = 2 * NormalDist().cdf(x ** 0.5) - 1
        term, k = (2 * x / np.pi) ** 0.5 * np.exp(-x / 2), 1
    else:
        share, term, k = 1 - np.exp(-x / 2), x / 2 * np.exp(-x / 2), 2
    while k < freedom:
        share -= term
        k += 2
        term *= x / k
    return float(share)


def chi2_at(share: float, freedom: int) -> float:
    """The value below which a chi-squared variable is with chance ``share``."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_share(middle, freedom) < share else (low, middle)
    return high


def judge(statistics: DataFrame, estimates: DataFrame, lang_col: str = "lang",
          source_col: str = "source", prefix: str = "") -> DataFrame:
    """``statistics`` with ``base_failed``, ``distance`` and ``kept``.

    Kept is what passes the base rules and lies within the distance of all but a
    ``TAIL`` of normal vectors. A row without an estimate (no row of the fit) only
    has the base rules.
    """
    names = [f"_x{i}" for i in range(len(FEATURES))]
    key = _keys(lang_col, source_col)["_fine"]
    rows = statistics.withColumns({"_fine": key} | dict(zip(names, features(prefix))))
    limit = chi2_at(1 - TAIL, len(FEATURES))
    judged = (rows.join(estimates, "_fine", "left")
              .withColumn(f"{prefix}base_failed", base_failed(prefix))
              .withColumn(f"{prefix}distance", distance(names)))
    near = F.coalesce(F.col(f"{prefix}distance") <= limit, F.lit(True))
    return (judged.withColumn(f"{prefix}kept", ~F.col(f"{prefix}base_failed") & near)
            .drop("_fine", "center", "precision", *names))


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
              source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns.

    Nulls count as a language and source of their own, a null text fails; repeated
    rows are judged each for themselves; other columns, ``kept`` or ``n_words``
    among them, pass untouched. The statistics are computed where the texts are
    read, once for the fit and once for the verdict, so that no text is shuffled.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]
    text, lang, source = (names[docs.columns.index(c)] for c in (text_col, lang_col, source_col))
    plain = docs.toDF(*names)
    fitted = fit(durable(with_statistics(plain, text, [lang, source])), lang, source)
    judged = judge(with_statistics(plain, text, prefix="_q_"), durable(fitted), lang, source, "_q_")
    return judged.where("_q_kept").select(*names).toDF(*docs.columns)

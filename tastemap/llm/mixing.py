"""Mixing to target weights: raking to source, language and topic, then a calibrated sample.

Iterative proportional fitting runs on the tokens of each cell of source, language
and topic, on the driver or, for many cells, on a written table. Documents are kept
by the probability of their cell.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from tastemap.llm.shared import let_go, ship_code
from tastemap.sources.durable import durable, intermediates, remove, scratch_path
from tastemap.sources.tables import read_table, write_table

# Topics, word buckets they are found in, and rounds of k-means over all documents.
TOPICS, BUCKETS, TOPIC_ROUNDS = 8, 512, 20
# Features are summed as whole numbers of so many units, so that their order does not matter.
MEAN_UNIT, APART_UNIT = 1 << 30, 32767
# Cells up to which raking runs on the driver; more of them are raked as a table, to the same end.
CELLS = 50_000
# Values of a column up to which a table's factors are sent to all tasks.
VALUES = 200
# A value's target is its share of tokens to this power, which lifts small ones.
POWER = 0.7
# Share of all tokens to keep.
KEEP = 0.5
ROUNDS, TOLERANCE = 500, 1e-9
DIMENSIONS = ("source", "lang", "topic")


def word_buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed words, a row per text, and the words of each text.

    Words stand between ASCII blanks, A-Z in lower case.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    code = np.frombuffer(b" ".join([*texts, b""]).lower(), np.uint8)
    blank = (code == 32) | (code >= 9) & (code <= 13)
    text = np.repeat(np.arange(len(texts)), sizes)
    starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    if not len(starts):
        return np.zeros((len(texts), BUCKETS)), np.zeros(len(texts), np.int64)
    # Each letter's place in its word; blanks before the first word do not matter.
    begin = np.zeros(len(code), np.int64)
    begin[starts] = starts
    place = np.arange(len(code)) - np.maximum.accumulate(begin)
    # A word's number: its letters times powers of an odd number by their place.
    powers = np.cumprod(np.r_[np.uint64(1), np.full(63, 0x9E3779B97F4A7C15, np.uint64)])
    letters = np.where(blank, 0, code).astype(np.uint64) * powers[place & 63]
    number = np.add.reduceat(letters, starts)
    number ^= number >> np.uint64(32)
    bucket = ((number * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)).astype(np.int64) % BUCKETS
    counts = np.bincount(text[starts] * BUCKETS + bucket, minlength=len(texts) * BUCKETS)
    return (counts.reshape(len(texts), BUCKETS).astype(float),
            np.bincount(text[starts], minlength=len(texts)))


class Topics:
    """Clusters of word use within languages: what sets a text apart from its language.

    These are of texts in memory; :func:`train_topics` finds those of a table.
    """

    def __init__(self, texts: list[bytes], langs: list[str], seed: int = 0):
        x = self._features(word_buckets(texts)[0])
        self.means = {lang: x[[i for i, v in enumerate(langs) if v == lang]].mean(axis=0)
                      for lang in sorted(set(langs))}
        self.mean = x.mean(axis=0) if len(x) else np.zeros(BUCKETS)
        x = self._apart(x, langs)
        random = np.random.default_rng(seed)
        self.centers = x[random.permutation(len(x))[:TOPICS]]
        for _ in range(20 if len(x) else 0):
            nearest = np.argmax(x @ self.centers.T, axis=1)
            for topic in range(len(self.centers)):
                members = x[nearest == topic]
                if len(members):
                    center = members.sum(axis=0)
                    self.centers[topic] = center / max(np.linalg.norm(center), 1e-12)

    @staticmethod
    def _features(counts: np.ndarray) -> np.ndarray:
        x = np.sqrt(counts)
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def _apart(self, x: np.ndarray, langs: list[str]) -> np.ndarray:
        means = [self.means.get(lang, self.mean) for lang in langs]
        x = x - (np.array(means) if means else x)
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def of(self, counts: np.ndarray, langs: list[str]) -> np.ndarray:
        if not len(self.centers):
            return np.zeros(len(counts), np.int32)
        nearest = np.argmax(self._apart(self._features(counts), langs) @ self.centers.T, axis=1)
        return nearest.astype(np.int32)


def _value(column: str) -> F.Column:
    """A value as text; null is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))


class TrainedTopics(NamedTuple):
    """``centers``, a row per topic, and ``means``: a table of ``_lang, mean`` in double bytes."""

    centers: np.ndarray
    means: DataFrame


def train_topics(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> TrainedTopics:
    """Topics of all documents: language means, then k-means of what sets texts apart.

    Sums are taken in the tasks; the driver holds the centers and their sums only.
    The first centers are the texts of the least hashes.
    """
    ship_code(docs.sparkSession)
    plain = docs.select(_value(lang_col).alias("_lang"), F.col(text_col).cast("binary").alias("_text"),
                        F.xxhash64(text_col, F.lit("topics")).alias("_draw"))
    sums = _added(plain.select("_lang", "_text").mapInArrow(
        _language_sums, "_lang string, sums array<bigint>"), "_lang")
    by_place = F.array_sort(F.collect_list(F.struct("place", "total")))
    means = durable(sums.groupBy("_lang").agg(by_place.getField("total").alias("sums"))
                    .mapInArrow(_means, "_lang string, mean binary"))
    apart = durable(plain.join(means, "_lang").select("_draw", "_text", "mean").mapInArrow(
        _apart_rows, "_draw bigint, apart binary"))
    # Copies share a draw.
    draws = [r[0] for r in apart.select("_draw").distinct().orderBy("_draw").limit(TOPICS).collect()]
    first = apart.where(F.col("_draw").isin(draws)).groupBy("_draw").agg(
        F.min("apart").alias("apart")).orderBy("_draw").collect() if draws else []
    centers = _unpacked([r["apart"] for r in first])
    for _ in range(TOPIC_ROUNDS if len(centers) else 0):
        before = centers.copy()
        total = np.zeros_like(centers)
        members = apart.select("apart").mapInArrow(
            lambda batches, centers=before: _topic_sums(batches, centers),
            "topic int, sums array<bigint>")
        for topic, place, value in _added(members, "topic").collect():
            total[topic, place] = value
        size = np.linalg.norm(total, axis=1)
        centers[size > 0] = total[size > 0] / size[size > 0, None]
        if (centers == before).all():
            break
    return TrainedTopics(centers, means)


def _added(rows: DataFrame, key: str) -> DataFrame:
    """``key, place, total``: the arrays ``sums`` of each key added up."""
    return (rows.select(key, F.posexplode("sums").alias("place", "value"))
            .groupBy(key, "place").agg(F.sum("value").alias("total")))


def _language_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language the sums of the features, and the number of texts behind them."""
    def given(sums: dict) -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(sums), pa.string()),
                                pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))],
                               ["_lang", "sums"])

    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            x = Topics._features(word_buckets([t or b"" for t in some.column("_text").to_pylist()])[0])
            units = np.c_[np.rint(x * MEAN_UNIT), np.ones(len(x))].astype(np.int64)
            langs = np.array(some.column("_lang").to_pylist(), object)
            for lang in set(langs):
                sums[lang] = sums.get(lang, 0) + units[langs == lang].sum(axis=0)
        if len(sums) > 1024:
            yield given(sums)
            sums = {}
    yield given(sums)


def _means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = np.array(batch.column("sums").to_pylist(), float).reshape(-1, BUCKETS + 1)
        means = sums[:, :-1] / (MEAN_UNIT * sums[:, -1:])
        yield pa.record_batch([batch.column("_lang"),
                               pa.array([m.tobytes() for m in means], pa.binary())],
                              ["_lang", "mean"])


def _apart_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What sets each text apart from its language, in two bytes a bucket."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            x = Topics._features(word_buckets([t or b"" for t in some.column("_text").to_pylist()])[0])
            x -= np.frombuffer(b"".join(some.column("mean").to_pylist())).reshape(-1, BUCKETS)
            x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
            units = np.rint(x * APART_UNIT).astype("<i2")
            yield pa.record_batch([some.column("_draw"),
                                   pa.array([u.tobytes() for u in units], pa.binary())],
                                  ["_draw", "apart"])


def _unpacked(apart: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(apart), "<i2").reshape(-1, BUCKETS) / APART_UNIT


def _topic_sums(batches: Iterator[pa.RecordBatch], centers: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per topic the sums of the members' features."""
    sums = np.zeros((len(centers), BUCKETS), np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            rows = batch.slice(at, 2048).column("apart").to_pylist()
            units = np.frombuffer(b"".join(rows), "<i2").reshape(-1, BUCKETS).astype(float)
            nearest = np.argmax(units @ centers.T, axis=1)
            member = (nearest == np.arange(len(centers))[:, None]).astype(float)
            sums += (member @ units).astype(np.int64)
    yield pa.record_batch([pa.array(range(len(centers)), pa.int32()),
                           pa.array(sums.tolist(), pa.list_(pa.int64()))], ["topic", "sums"])


def with_topics(docs: DataFrame, topics: TrainedTopics, keep: list[str] | None = None,
                id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Columns ``keep`` (all if not given), and ``_source, _lang, _draw, _tokens, _topic``.

    ``topics`` are those of the same documents, so that each language has its mean.
    """
    ship_code(docs.sparkSession)
    centers = topics.centers
    kept = docs.columns if keep is None else keep
    plain = docs.select(
        *(F.col(c).alias(f"_c{i}") for i, c in enumerate(kept)),
        _value(source_col).alias("_source"), _value(lang_col).alias("_lang"),
        # An even draw from 0 to 1 that is the row's own wherever it is read.
        ((F.pmod(F.xxhash64(id_col, text_col, F.lit("sample")), F.lit(1 << 52)) + 0.5)
         / (1 << 52)).alias("_draw"), F.col(text_col).cast("binary").alias("_text"))
    schema = StructType(plain.schema.fields[:-1])
    schema = schema.add("_tokens", LongType()).add("_topic", IntegerType())

    def at_centers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            means = np.frombuffer(b"".join(batch.column("mean").to_pylist())).reshape(-1, BUCKETS)
            yield pa.record_batch([batch.column("_lang"), pa.array(
                [row.tobytes() for row in means @ centers.T], pa.binary())], ["_lang", "_offset"])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                counts, words = word_buckets([t or b"" for t in some.column("_text").to_pylist()])
                # A text less its language's mean has the topic of the largest product; its
                # length changes no order.
                offset = np.frombuffer(b"".join(some.column("_offset").to_pylist()))
                products = Topics._features(counts) @ centers.T
                found = (np.argmax(products - offset.reshape(products.shape), axis=1)
                         if len(centers) else np.zeros(len(words))).astype(np.int32)
                yield pa.record_batch([*some.columns[:-2], pa.array(words), pa.array(found)],
                                      schema.names)

    offsets = topics.means.mapInArrow(at_centers, "_lang string, _offset binary")
    return (plain.join(durable(offsets), "_lang").select(*plain.columns, "_offset")
            .mapInArrow(compute, schema))


def rake(tokens: np.ndarray, places: list[np.ndarray], targets: list[np.ndarray],
         keep: float = KEEP) -> np.ndarray:
    """Probability of each cell so that the kept tokens have the target shares.

    Iterative proportional fitting: the cells of each value of each column in turn
    are scaled to its target. A probability is 1 at most; the other cells make up
    for one that is held there, as far as they can.
    """
    total = keep * tokens.sum()
    chance = np.full(len(tokens), keep)
    if not total:
        return chance
    for _ in range(ROUNDS):
        worst = 0.0
        for place, target in zip(places, targets):
            now = np.bincount(place, chance * tokens, len(target))
            scale = np.divide(target * total, now, out=np.ones(len(target)), where=now > 0)
            worst = max(worst, float(np.abs(target * total - now).max()) / total)
            chance = np.minimum(1.0, chance * scale[place])
        if worst < TOLERANCE:
            break
    return chance


def tempered(shares: np.ndarray, power: float = POWER) -> np.ndarray:
    """Target shares: the present ones to a power."""
    lifted = np.power(shares, power, where=shares > 0, out=np.zeros(len(shares)))
    return lifted / max(lifted.sum(), 1e-300)


def probabilities(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None,
                  keep: float = KEEP) -> DataFrame:
    """``_source, _lang, _topic, probability`` of each cell of documents with their tokens.

    ``cells`` has the three columns and ``tokens``. ``targets`` may give shares by
    value (as :func:`_value` writes it) of ``source``, ``lang`` or ``topic``; values
    it leaves out, and columns it does not name, get their tempered share. Every
    value is raked for itself; a target for a value that no cell has is an error.
    More than ``CELLS`` cells stay a table.
    """
    targets = targets or {}
    _refuse_unknown(cells, targets)
    if cells.count() > CELLS:
        return _rake_table(cells, targets, keep)
    names = [f"_{name}" for name in DIMENSIONS]
    rows = sorted(map(tuple, cells.select(*names, "tokens").collect()), key=lambda r: r[:3])
    tokens = np.array([r[3] or 0 for r in rows], float)
    places, goals = [], []
    for i, name in enumerate(DIMENSIONS):
        values = sorted({r[i] for r in rows})
        at = {v: k for k, v in enumerate(values)}
        place = np.array([at[r[i]] for r in rows], np.int64)
        share = np.bincount(place, tokens, len(values)) / max(tokens.sum(), 1.0)
        goal = tempered(share)
        given = targets.get(name, {})
        fixed = np.array([v in given for v in values], bool)
        if fixed.any():
            goal[fixed] = [given[v] for v in values if v in given]
            free = goal[~fixed].sum()
            if free:
                goal[~fixed] *= max(0.0, 1 - goal[fixed].sum()) / free
            goal /= goal.sum()
        places.append(place)
        goals.append(goal)
    chance = rake(tokens, places, goals, keep)
    schema = ", ".join(f"{n} {cells.schema[n].dataType.simpleString()}" for n in names)
    return cells.sparkSession.createDataFrame(
        [(*r[:3], float(c)) for r, c in zip(rows, chance)], schema + ", probability double")


def _refuse_unknown(cells: DataFrame, targets: dict[str, dict[str, float]]) -> None:
    for name, given in targets.items():
        if name not in DIMENSIONS:
            raise ValueError(f"targets for {name!r}, which is none of {DIMENSIONS}")
        there = {r[0] for r in cells.select(f"_{name}").where(
            F.col(f"_{name}").isin(list(given))).distinct().collect()} if given else set()
        if set(given) - there:
            raise ValueError(f"targets for {name} without rows: {sorted(set(given) - there)}")


def _goals(cells: DataFrame, name: str, given: dict) -> DataFrame:
    """Target share ``goal`` of each value of a column, as in :func:`probabilities`."""
    column = f"_{name}"
    sums = durable(cells.groupBy(column).agg(F.sum("tokens").cast("double").alias("n")))
    whole = max(sums.agg(F.sum("n")).first()[0] or 0.0, 1.0)
    lifted = sums.withColumn("goal", F.when(F.col("n") > 0, F.pow(F.col("n") / whole, F.lit(POWER)))
                             .otherwise(0.0))
    fixed = F.col(column).isin(list(given)) if given else F.lit(False)
    total, free = (lifted.agg(F.sum(F.col("goal")), F.sum(F.when(~fixed, F.col("goal")))).first())
    if not given:
        return durable(lifted.select(column, (F.col("goal") / max(total, 1e-300)).alias("goal")))
    kind = cells.schema[column].dataType.simpleString()
    wanted = cells.sparkSession.createDataFrame(
        [(v, float(share)) for v, share in given.items()], f"{column} {kind}, given double")
    rest = max(0.0, 1 - sum(given.values())) / free if free else 1.0
    mixed = lifted.join(wanted, column, "left").select(
        column, F.coalesce("given", F.col("goal") * rest).alias("goal"))
    mixed = durable(mixed)
    total = mixed.agg(F.sum("goal")).first()[0]
    return mixed.withColumn("goal", F.col("goal") / total)


def _rake_table(cells: DataFrame, targets: dict[str, dict[str, float]], keep: float) -> DataFrame:
    """:func:`rake` on a table: sums by value, joined back to the cells.

    A column of at most ``VALUES`` values has its factors sent to all tasks, so that
    a value with most cells is no task's own.
    """
    spark = cells.sparkSession
    names = [f"_{name}" for name in DIMENSIONS]
    goals = {n: _goals(cells, n[1:], targets.get(n[1:], {})) for n in names}
    few = {n for n in names if goals[n].count() <= VALUES}
    state = cells.select(*names, F.coalesce("tokens", F.lit(0)).cast("double").alias("tokens"),
                         F.lit(float(keep)).alias("probability"))
    path = scratch_path(spark, "raked")
    write_table(state, path)
    now, schema = read_table(spark, path, schema=state.schema), state.schema
    total = keep * (now.agg(F.sum("tokens")).first()[0] or 0.0)
    for _ in range(ROUNDS if total else 0):
        worst, after = 0.0, scratch_path(spark, "raked")
        with intermediates(spark):
            for name in names:
                sums = now.groupBy(name).agg(F.sum(F.col("probability") * F.col("tokens")).alias("n"))
                want = F.col("goal") * total
                step = durable(sums.join(goals[name], name).select(
                    name, F.when(F.col("n") > 0, want / F.col("n")).otherwise(1.0).alias("scale"),
                    F.abs(want - F.col("n")).alias("off")))
                worst = max(worst, step.agg(F.max("off")).first()[0] / total)
                scale = step.select(name, "scale")
                now = (now.join(F.broadcast(scale) if name in few else scale, name)
                       .withColumn("probability", F.least(F.lit(1.0), F.col("probability")
                                                          * F.col("scale")))
                       .select(*schema.names))
            write_table(now, after)
        remove(spark, path)
        path = after
        now = read_table(spark, path, schema=schema)
        if worst < TOLERANCE:
            break
    return now.select(*names, "probability")


def mixture(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None,
            keep: float = KEEP, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str = "lang", source_col: str = "source"
            ) -> tuple[DataFrame, TrainedTopics, DataFrame]:
    """What :func:`with_topics` says of every document, the topics, and the probabilities.

    Tokens are words. Nulls are a source, language or text (without tokens) of their
    own; an empty table has no cells.
    """
    topics = train_topics(docs, text_col, lang_col)
    rows = durable(with_topics(docs, topics, [id_col], id_col, text_col, lang_col, source_col))
    cells = durable(rows.groupBy(*(f"_{d}" for d in DIMENSIONS))
                    .agg(F.sum("_tokens").alias("tokens")))
    return rows, topics, durable(probabilities(cells, targets, keep))


def judge(rows: DataFrame, chances: DataFrame) -> DataFrame:
    """``rows`` with ``probability`` and ``kept``: whether the row's draw is below it."""
    return (rows.join(chances, [f"_{d}" for d in DIMENSIONS])
            .withColumn("kept", F.col("_draw") < F.col("probability")))


def sample(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None,
           keep: float = KEEP) -> DataFrame:
    """The documents kept, with their own columns.

    A row's draw depends on its id and text alone, so equal rows stay or go together.
    Texts are not shuffled: topics are found again where they are read.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    columns = [names[docs.columns.index(c)] for c in ("doc_id", "text", "lang", "source")]
    plain = docs.toDF(*names)
    _, topics, chances = mixture(plain, targets, keep, *columns)
    kept = judge(with_topics(plain, topics, None, *columns), chances).where("kept")
    return kept.select(*(f"_c{i}" for i in range(len(names)))).toDF(*docs.columns)

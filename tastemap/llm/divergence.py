"""Source divergence audit: which words set a source apart, and from which other sources.

Words are counted by one ``bytes.translate`` that lowers letters and blanks
separators, ``bytes.split`` and a ``Counter`` per document. Only counts above zero
are kept and aggregated; a term that a source never uses has one fixed share there,
so sums over all terms need the sparse rows alone.
"""

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemap.llm.shared import ship_code
from tastemap.sources.durable import durable

# A term is kept in a language if so many of its documents have it.
LEAST_DOCS = 30
# Added to every count; shares are in parts of this whole.
EXTRA, WHOLE = 5, 1_000_000_000
TOP = 50
# Letters stay, A-Z in lower case; all other ASCII bytes separate. Bytes past ASCII are
# parts of terms.
TABLE = bytes(b + 32 if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
              else b if b > 127 or chr(b).isalpha() else 32 for b in range(256))
# Entries that a task holds before it hands them on.
ENTRIES = 150_000
# Sources compared in one matrix, parts that the terms of a language are dealt into, and
# numbers held at once.
TILE, PARTS, CELLS = 64, 64, 1 << 21


def count_terms(text: bytes | None) -> Counter:
    """How often a UTF-8 text has each term."""
    return Counter((text or b"").translate(TABLE).split())


def _counts(batches: Iterator[pa.RecordBatch], entries: int) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by language and source, summed in the task."""
    uses, docs, held = defaultdict(Counter), defaultdict(Counter), 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            for lang, source, text in zip(*(some.column(c).to_pylist()
                                            for c in ("lang", "source", "text"))):
                found = count_terms(text)
                before = len(uses[lang, source])
                uses[lang, source].update(found)
                docs[lang, source].update(found.keys())
                held += len(uses[lang, source]) - before
                if held >= entries:
                    yield from _rows(uses, docs)
                    uses, docs, held = defaultdict(Counter), defaultdict(Counter), 0
    yield from _rows(uses, docs)


def _rows(uses: dict, docs: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), found in uses.items():
        if found:
            n = len(found)
            yield pa.record_batch(
                [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()),
                 pa.array(list(found), pa.binary()).cast(pa.string()),
                 pa.array(list(found.values()), pa.int64()),
                 pa.array([docs[lang, source][t] for t in found], pa.int64())],
                ["lang", "source", "term", "n", "docs"])


def _share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(WHOLE * (n + EXTRA) / (total + EXTRA * terms))`` in whole numbers."""
    above = (n + EXTRA).cast("decimal(28,0)") * F.lit(WHOLE)
    below = (total + EXTRA * terms).cast("decimal(38,0)")
    # Integer division of decimals is exact; only the SQL form has it.
    return F.call_function("div", above.cast("decimal(38,0)"), below) + 1


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source differs in its language.

    Terms are runs of letters A-Z and characters past ASCII. A language keeps the V
    terms that at least ``least_docs`` of its rows have. A term's share in a source is
    ``_share`` of its occurrences there, N being those of all kept terms. Part ``pair``
    has every other source of the language with the sum of the absolute differences of
    shares over all kept terms (0 without any); part ``term`` the kept terms that occur
    in the source with a larger share than in the language, by the difference, the
    first ``top`` of them. Ranks are by value, then item in the order of UTF-8.

    Null texts, languages and sources are empty ones; repeated rows count as rows;
    an empty table gives no rows. A source alone in its language has no pairs.
    """
    ship_code(docs.sparkSession)
    columns = {"lang": lang_col, "source": source_col, "text": text_col}
    plain = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
                          for name, c in columns.items()))
    entries = ENTRIES
    counted = (plain.select("lang", "source", F.col("text").cast("binary").alias("text"))
               .mapInArrow(lambda batches: _counts(batches, entries),
                           "lang string, source string, term string, n long, docs long"))
    uses = durable(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"),
                                                                 F.sum("docs").alias("docs")))
    kept = (uses.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang"))
            .where(F.col("docs") >= least_docs).drop("docs"))
    rows = durable(uses.drop("docs").join(kept, ["lang", "term"]))
    groups = durable(_groups(plain, rows, kept))
    shares = rows.join(groups, ["lang", "source"])
    p, q = (_share(F.col(n), F.col(total), F.col("terms"))
            for n, total in (("n", "total"), ("n_lang", "total_lang")))
    shares = durable(shares.select("lang", "source", "term", "number", p.alias("p"), q.alias("q")))
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"),
                                         F.col("term").alias("item"), (F.col("p") - F.col("q"))
                                         .alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(order).alias("rank")
    return (_pairs(groups, shares).select("*", ranked)
            .unionByName(terms.select("*", ranked).where(F.col("rank") <= top)))


def _groups(plain: DataFrame, rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Every language and source that occurs, with its totals, its number in the language,
    and the share there of a term that it never uses."""
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"),
                                     F.sum("n_lang").alias("total_lang"))
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    found = (plain.select("lang", "source").distinct().withColumn("number", number)
             .join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
             .fillna(0, ["total", "terms", "total_lang"]))
    none = F.when(F.col("terms") > 0, _share(F.lit(0), F.col("total"), F.greatest("terms", F.lit(1))))
    return found.withColumn("none", F.coalesce(none, F.lit(0)))


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """The summed difference of every two sources of a language, in both orders.

    A term neither uses adds the difference of their fixed shares, so what the others
    add beyond that is summed from the sparse rows.
    """
    width, cells = TILE, CELLS
    tile = F.expr(f"number div {width}")
    tiles = groups.groupBy("lang").agg(F.max(tile).alias("last"))
    part = F.pmod(F.xxhash64("term"), F.lit(PARTS)).cast("int")
    # A group's fixed share goes to all parts, ahead of the terms.
    every = groups.select("lang", F.lit(None).cast("string").alias("term"), "number",
                          F.col("none").alias("p"),
                          F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("dealt"))
    dealt = shares.select("lang", "term", "number", "p", part.alias("dealt")).unionByName(every)
    placed = (dealt.join(tiles, "lang").withColumn("tile", tile)
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), "last")))
              .select("lang", F.least("tile", "other").alias("one"),
                      F.greatest("tile", "other").alias("two"), "dealt", "term", "number", "p"))
    key = ["lang", "one", "two", "dealt"]
    placed = placed.repartition(*key).sortWithinPartitions(*key, F.asc_nulls_first("term"))
    beyond = (placed.mapInArrow(lambda batches: _differences(batches, width, cells),
                                "lang string, a int, b int, beyond long")
              .groupBy("lang", "a", "b").agg(F.sum("beyond").alias("beyond")))
    left = groups.select("lang", "source", "number", "none", "terms")
    right = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("other"),
                          F.col("none").alias("other_none"))
    pairs = left.join(right, "lang").where("number <> other").withColumns(
        {"a": F.least("number", "other"), "b": F.greatest("number", "other")})
    fixed = F.col("terms") * F.abs(F.col("none") - F.col("other_none"))
    return pairs.join(beyond, ["lang", "a", "b"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item",
        (fixed + F.coalesce("beyond", F.lit(0))).alias("value"))


def _differences(batches: Iterator[pa.RecordBatch], tile: int,
                 cells: int) -> Iterator[pa.RecordBatch]:
    """Sums of differences beyond those of the fixed shares, from rows in order."""
    group = None
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "one", "two", "dealt"))))
        terms, numbers, shares = (batch.column(c).to_pylist() for c in ("term", "number", "p"))
        for key, term, number, share in zip(keys, terms, numbers, shares):
            if group is None or group.key != key:
                if group is not None:
                    yield from group.sums()
                group = _Tiles(key, tile, cells)
            group.add(term, number, share)
    if group is not None:
        yield from group.sums()


class _Tiles:
    """Two tiles of sources, and the terms of one part of a language."""

    def __init__(self, key, tile: int, cells: int):
        self.key, self.tile, self.cells = key, tile, cells
        self.fixed: dict[int, int] = {}
        self.term, self.at, self.rows = None, -1, None
        self.beyond = None

    def add(self, term, number, share) -> None:
        if term is None:
            self.fixed[number] = share
            return
        if self.rows is None:
            self._open()
        if term != self.term:
            self.term, self.at = term, self.at + 1
            if self.at == len(self.rows):
                self._sum()
        self.rows[self.at, self.place[number]] = share

    def _open(self) -> None:
        numbers = sorted(self.fixed)
        self.place = {number: i for i, number in enumerate(numbers)}
        self.base = np.array([self.fixed[n] for n in numbers], np.int64)
        one, two = ([n for n in numbers if n // self.tile == tile] for tile in self.key[1:3])
        self.one, self.two = np.array(one), np.array(two)
        self.columns = [np.array([self.place[n] for n in side]) for side in (one, two)]
        self.beyond = np.zeros((len(one), len(two)), np.int64)
        self.rows = np.tile(self.base, (max(1, self.cells // self.beyond.size), 1))

    def _sum(self) -> None:
        one, two = (self.rows[:self.at, columns] for columns in self.columns)
        self.beyond += np.abs(one[:, :, None] - two[:, None, :]).sum(axis=0)
        base = [self.base[columns] for columns in self.columns]
        self.beyond -= self.at * np.abs(base[0][:, None] - base[1])
        self.rows[:] = self.base
        self.at = 0

    def sums(self) -> Iterator[pa.RecordBatch]:
        if self.rows is None:
            return
        self.at += 1
        self._sum()
        a, b = (x.ravel() for x in np.meshgrid(self.one, self.two, indexing="ij"))
        some = a < b
        yield pa.record_batch(
            [pa.array([self.key[0]] * int(some.sum()), pa.string()), pa.array(a[some], pa.int32()),
             pa.array(b[some], pa.int32()), pa.array(self.beyond.ravel()[some], pa.int64())],
            ["lang", "a", "b", "beyond"])

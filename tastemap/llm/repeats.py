"""Removal of repeated byte strings by a run-length index over the repetitive parts of a corpus.

Strings of ``LENGTH`` bytes can be equal only where they share their least k-mer, so the
surroundings of k-mers that repeat are brought together by k-mer, equal ones once.
Tasks build a run-compressed Burrows-Wheeler transform of what they get, with the
suffix array sampled at the ends of runs, stream the same texts through it from right to
left, and mark where the matching statistics reach the length and an earlier text has
the same string.
"""

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tastemap.llm.shared import ship_code
from tastemap.sources.durable import durable

# Bytes of a repeated string.
LENGTH = 100
# Bytes of a k-mer; a string's least one tells where it is compared.
KMER = 32
# Bytes scanned at once, contexts that a task compares before it hands them on, and bytes
# after which a task builds an index.
SCAN, HELD, CHUNK = 1 << 19, 200_000, 3 << 16
# Surroundings of one k-mer that one index takes; the strings of a k-mer with more are
# dealt out by longer parts that they share.
HOT = 4096
# A context of a k-mer that cannot be told from others by itself is split into so many.
SPLIT = 3

DOC = "oid long, mark long"
CONTEXT = f"h long, c long, {DOC}, at int, shape int"
MET = f"span boolean, h long, {DOC}, at int, start int, until int"
MEMBER = f"key long, c long, {DOC}, first int, last int, at int, start int, bytes binary"
MEMBER_NAMES = [f.split()[0] for f in MEMBER.split(", ")]


def _hashes(data: np.ndarray) -> np.ndarray:
    """A number above 0 for each k-mer of the bytes, by doubling."""
    value, base, width = data.astype(np.uint64) + np.uint64(1), np.uint64(0x9E3779B97F4A7C15), 1
    with np.errstate(over="ignore"):
        while width < KMER:
            value = value[:-width] * base + value[width:]
            base, width = base * base, 2 * width
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(32)
    return value | np.uint64(1)


def _sliding(values: np.ndarray, width: int, take) -> np.ndarray:
    """``take`` (minimum or maximum) of each run of ``width`` values."""
    size, found = 1, values
    while 2 * size <= width:
        found = take(found[:-size], found[size:])
        size *= 2
    rest = width - size
    return take(found[:len(found) - rest], found[rest:]) if rest else found


def least_kmers(texts: list[bytes], length: int = LENGTH) -> list[tuple[np.ndarray, ...]]:
    """Of each text the k-mers that are least in a string of ``length``: their places and
    hashes, and where the first and the last string begin in which they are.

    Of equal least ones all count, so equal strings have theirs at equal places.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    starts = np.r_[0, ends[:-1]]
    if len(data) < length:
        return [(np.empty(0, np.int64), np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 2)
                for _ in texts]
    hashes, width = _hashes(data), length - KMER + 1
    least = _sliding(hashes, width, np.minimum)
    # Strings that would reach into the next text are left out.
    inside = np.zeros(len(data) + 1, np.int32)
    long = ends - starts >= length
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    least[np.cumsum(inside)[:len(least)] == 0] = 0
    edge = np.zeros(width - 1, np.uint64)
    least = np.r_[edge, least, edge]
    places = np.flatnonzero(_sliding(least, width, np.maximum) == hashes)
    found = hashes[places]
    first, last = np.empty_like(places), np.empty_like(places)
    for at in range(0, len(places), 8192):
        some = slice(at, at + 8192)
        mine = np.lib.stride_tricks.sliding_window_view(least, width)[places[some]] \
            == found[some, None]
        first[some] = places[some] - width + 1 + mine.argmax(axis=1)
        last[some] = places[some] - mine[:, ::-1].argmax(axis=1)
    cuts = np.r_[np.searchsorted(places, starts), len(places)]
    return [(places[a:b] - start, found[a:b], first[a:b] - start, last[a:b] - start)
            for a, b, start in zip(cuts, cuts[1:], starts)]


def _contexts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Each least k-mer with the strings around it, as ``CONTEXT``.

    Of equal contexts in the same text, or among those held together, the first stays; the
    others are repeats for sure and become spans, with a null ``c``. So a passage of a third
    of all rows leaves a few rows a task.
    """
    held, size = [], 0
    for batch in batches:
        at = 0
        sizes = pc.binary_length(batch.column("text")).to_numpy()
        while at < batch.num_rows:
            n = max(1, int(np.searchsorted(np.cumsum(sizes[at:at + 4096]), SCAN)))
            some = batch.slice(at, n)
            at += n
            texts = some.column("text").to_pylist()
            for oid, mark, text, (places, hashes, first, last) in zip(
                    some.column("oid").to_pylist(), some.column("mark").to_pylist(), texts,
                    least_kmers(texts, length)):
                if not len(places):
                    continue
                until = last + length
                c = np.fromiter((xxh64_intdigest(text[a:b], p - a) for p, a, b in zip(
                    places.tolist(), first.tolist(), until.tolist())), np.uint64, len(places))
                held.append((oid, mark, hashes, c, places, first, until))
                size += len(places)
            if size >= HELD:
                yield from _fewer(held)
                held, size = [], 0
    yield from _fewer(held)


def _fewer(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    n = [len(x[2]) for x in held]
    doc = np.repeat(np.arange(len(held)), n)
    oids, marks = (np.array([x[i] for x in held], np.int64) for i in (0, 1))
    h, c = (np.concatenate([x[i] for x in held]).view(np.int64) for i in (2, 3))
    at, start, until = (np.concatenate([x[i] for x in held]) for i in (4, 5, 6))
    order = np.lexsort((at, doc, oids[doc], c, h))
    h, c, at, start, until, doc = (x[order] for x in (h, c, at, start, until, doc))
    new = np.r_[True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])]
    again = np.r_[False, ~new[1:] & (doc[1:] == doc[:-1])]
    later = again | (oids[doc] > oids[doc[new]][np.cumsum(new) - 1])
    # Repeats of one document as maximal runs.
    turn = np.lexsort((start[later], doc[later]))
    d, a, b = (x[later][turn] for x in (doc, start, until))
    reach = np.maximum.accumulate(b + (d << 40)) if len(d) else b
    cut = np.flatnonzero(np.r_[True, a[1:] + (d[1:] << 40) > reach[:-1]]) if len(d) else a
    spans = d[cut], a[cut], reach[np.r_[cut[1:], len(d)] - 1] - (d[cut] << 40) if len(d) else b
    none = len(cut)
    doc, at, start, until, h, c = (x[~later] for x in (doc, at, start, until, h, c))
    owner = np.r_[doc, spans[0]]
    yield pa.record_batch(
        [pa.array(np.r_[h, marks[spans[0]]]), pa.array(np.r_[c, np.zeros(none, np.int64)],
                                                       mask=np.arange(len(owner)) >= len(doc)),
         pa.array(oids[owner]), pa.array(marks[owner]),
         pa.array(np.r_[at, spans[1]].astype(np.int32)),
         pa.array(np.r_[(at - start) << 16 | (until - at), spans[2]].astype(np.int32))],
        ["h", "c", "oid", "mark", "at", "shape"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans, and contexts to be compared, from contexts in the order of k-mer, context, id.

    All but the first document of a context repeat it. The first one is compared if the
    k-mer has other contexts; until one comes it waits.
    """
    fields = ("h", "c", "oid", "mark", "at", "shape")
    h = c = oid = None
    several, waiting = False, []
    for batch in batches:
        if not batch.num_rows:
            continue
        known = batch.column("c").is_valid().to_numpy(False)
        rows = {f: batch.column(f).fill_null(0).to_numpy() for f in fields}
        yield _met_rows({f: v[~known] for f, v in rows.items()}, span=True, plain=True)
        rows = {f: v[known] for f, v in rows.items()}
        if not len(rows["h"]):
            continue
        new_h = np.r_[rows["h"][0] != h, rows["h"][1:] != rows["h"][:-1]]
        new_c = new_h | np.r_[rows["c"][0] != c, rows["c"][1:] != rows["c"][:-1]]
        run, heads = np.cumsum(new_c), np.r_[oid or 0, rows["oid"][new_c]]
        later = rows["oid"] > heads[run]
        group = np.cumsum(new_h)
        contexts = np.bincount(group[new_c], minlength=group[-1] + 1)
        if not new_h[0]:
            contexts[0] += 2 if several else 1
        first = ~later & (contexts[group] > 1)
        if contexts[0] > 1 and not new_h[0]:
            for some in waiting:
                yield _met_rows(some, span=False)
            waiting = []
        elif new_h[0]:
            waiting = []
        yield _met_rows({f: v[later] for f, v in rows.items()}, span=True)
        yield _met_rows({f: v[first] for f, v in rows.items()}, span=False)
        several = contexts[group[-1]] > 1
        if several or group[-1] > 0:
            waiting = []
        if not several:
            last = (group == group[-1]) & ~later
            waiting.append({f: v[last] for f, v in rows.items()})
        h, c, oid = rows["h"][-1], rows["c"][-1], int(heads[run[-1]])


def _met_rows(rows: dict, span: bool, plain: bool = False) -> pa.RecordBatch:
    at, shape = rows["at"], rows["shape"]
    start, until = (at, shape) if plain else (at - (shape >> 16), at + (shape & 0xFFFF))
    return pa.record_batch(
        [pa.array(np.full(len(at), span)), *(pa.array(rows[f]) for f in ("h", "oid", "mark", "at")),
         pa.array(start.astype(np.int32)), pa.array(until.astype(np.int32))],
        ["span", "h", "oid", "mark", "at", "start", "until"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of spans that overlap or touch."""
    found: list[tuple[int, int]] = []
    for start, until in sorted(spans):
        if found and start <= found[-1][1]:
            if until > found[-1][1]:
                found[-1] = found[-1][0], until
        else:
            found.append((start, until))
    return found


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``oid, mark, spans`` of each document with bytes that repeat earlier ones.

    ``oid`` is the id (null: the greatest there is), ``mark`` the hash of the text; ``spans``
    lists starts and ends. The documents are compared as in :func:`without_repeats`.
    """
    ship_code(docs.sparkSession)
    texts = _texts(docs, id_col, text_col)
    contexts = texts.mapInArrow(lambda batches: _contexts(batches, length), CONTEXT)
    met = durable(contexts.repartition("h").sortWithinPartitions("h", "c", "oid")
                  .mapInArrow(_met, MET))
    spans = [met.where("span")]
    apart = met.where("NOT span")
    sizes = apart.groupBy(F.col("h").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    hot = durable(sizes.where(F.col("n") > HOT).select("key"))
    members = _members(texts, apart, length)
    while not hot.isEmpty():
        members = durable(members)
        spans.append(_compared(members.join(hot, "key", "left_anti"), length))
        members, repeats = _split(members.join(hot, "key", "left_semi"), length)
        spans.append(repeats)
        sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        hot = durable(sizes.where(F.col("n") > HOT).select("key"))
    spans.append(_compared(members, length))
    every = spans[0].select("oid", "mark", "start", "until")
    for more in spans[1:]:
        every = every.unionByName(more.select("oid", "mark", "start", "until"))
    return every.groupBy("oid", "mark").agg(
        F.collect_list(F.struct("start", "until")).alias("spans"))


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every document.

    Of the UTF-8 bytes of a text each one goes that a string of ``length`` bytes covers
    which also starts earlier: in a document of smaller id (null last), or in the same
    document before. Strings never cross documents, and are judged on the input. ``kept``
    has the bytes that stay, joined; ``n_spans`` counts the maximal runs of removed ones.

    Null texts are empty. Rows with equal id and text are one document, so each has the
    same result; rows with equal ids and other texts do not count as earlier than each
    other. An empty table gives no rows.
    """
    texts = _texts(docs, id_col, text_col, F.col(f"`{id_col}`").alias("doc_id"))
    # Written out: a join of two plain shuffles can split what is large.
    spans = durable(repeated_spans(docs, length, id_col, text_col))
    joined = texts.join(spans, ["oid", "mark"], "left").select("doc_id", "text", "spans")
    kind = texts.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(_cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, "
                                   "kept_sha256 string, kept binary")


def _texts(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    oid = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit((1 << 63) - 1))
    return docs.select(*more, oid.alias("oid"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            some = batch.slice(at, 512)
            rows = []
            for text, spans in zip(some.column("text").to_pylist(), some.column("spans").to_pylist()):
                gone = merged([(s["start"], s["until"]) for s in spans or ()])
                edges = [0, *(x for span in gone for x in span), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((len(text), len(text) - len(kept), len(gone), sha256(kept).hexdigest(),
                             kept))
            types = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            yield pa.record_batch([some.column("doc_id"), *(
                pa.array(list(c), t) for c, t in zip(zip(*rows), types))], names)


# Contexts that share a k-mer

def _members(texts: DataFrame, apart: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted contexts, by k-mer."""
    wanted = apart.groupBy("oid", "mark").agg(
        F.collect_list(F.struct("h", "start", "at", "until")).alias("wanted"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                some = batch.slice(first, 256)
                lists = some.column("wanted")
                of, flat = pc.list_parent_indices(lists), pc.list_flatten(lists)
                h, at, start, until = (flat.field(n) for n in ("h", "at", "start", "until"))
                text = some.column("text").to_pylist()
                parts = [text[i][a:b] for i, a, b in zip(of.to_pylist(), start.to_pylist(),
                                                         until.to_pylist())]
                zero = np.zeros(len(parts), np.int32)
                yield pa.record_batch(
                    [h, pa.array(zero.astype(np.int64)), some.column("oid").take(of),
                     some.column("mark").take(of), pa.array(zero), pa.array(zero + (length - KMER)),
                     at, start, pa.array(parts, pa.binary())], MEMBER_NAMES)

    return texts.join(durable(wanted), ["oid", "mark"]).mapInArrow(fetch, MEMBER)


def _member_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 4 + [pa.int32()] * 4 + [pa.binary()]
    columns = zip(*rows) if rows else [[] for _ in types]
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types)], MEMBER_NAMES)


def _split(members: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Members of a hot k-mer by what parts of their strings share, and spans of equal ones.

    The strings of a member start ``first`` to ``last`` bytes before its k-mer. Those of a
    part of that range have more bytes in common than the k-mer, by which they are dealt out;
    at a single place all of the string, so that equal ones are one and none is left over.
    """
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, _, oid, mark, first, last, at, start, data in zip(
                    *(batch.column(c).to_pylist() for c in batch.schema.names)):
                step, place = -(-(last - first + 1) // SPLIT), at - start
                for low in range(first, last + 1, step):
                    high = min(low + step - 1, last)
                    # Strings that lie inside the text; all have the core of the whole range.
                    left, right = min(high, place), max(low, place + length - len(data))
                    if right > left:
                        continue
                    core = data[place - low:place - high + length]
                    part = data[place - left:place - right + length]
                    rows.append((xxh64_intdigest(core, low << 8 | high) - (1 << 63),
                                 xxh64_intdigest(part, left) - (1 << 63), oid, mark, low, high, at,
                                 at - left, part))
            yield _member_rows(rows)

    dealt = durable(members.mapInArrow(parts, MEMBER))
    again = F.rank().over(Window.partitionBy("key", "c", "oid", "mark").orderBy("start")) > 1
    least = dealt.groupBy("key", "c").agg(F.min("oid").alias("first_oid"))
    many = (dealt.groupBy("key").agg(F.min("c").alias("one"), F.max("c").alias("other"))
            .select("key", (F.col("one") != F.col("other")).alias("differ")))
    placed = durable(dealt.withColumn("again", again).join(least, ["key", "c"]).join(many, "key"))
    later = F.col("again") | (F.col("oid") > F.col("first_oid"))
    spans = placed.where(later).select("oid", "mark", "start",
                                       (F.col("start") + F.length("bytes")).alias("until"))
    return durable(placed.where(~later & F.col("differ")).select(dealt.columns)), spans


def _compared(members: DataFrame, length: int) -> DataFrame:
    """Spans of the members' strings that an earlier one has, by an index of those that meet."""
    in_order = (members.select("key", "oid", "mark", "start", "bytes").repartition("key")
                .sortWithinPartitions("key"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
                if row[0] != last and size >= CHUNK:
                    yield from _spans(rows, length)
                    rows, size = [], 0
                last = row[0]
                size += len(row[4])
                rows.append(row)
        yield from _spans(rows, length)

    return in_order.mapInArrow(compare, f"{DOC}, start int, until int")


def _spans(rows: list[tuple], length: int) -> Iterator[pa.RecordBatch]:
    """Spans of the strings of contexts that come after an equal one."""
    if not rows:
        return
    _, oid, mark, start, texts = zip(*rows)
    index = RunIndex(texts)
    text, place, row = index.stream(texts, length)
    group = index.group(row, length)
    some = group >= 0
    text, place, group = text[some], place[some], group[some]
    if not len(text):
        return
    oids = np.array(oid, np.int64)[text]
    docs = np.unique(np.array(list(zip(oid, mark)), "i8,i8"), return_inverse=True)[1][text]
    places = np.array(start, np.int64)[text] + place
    first = np.full(group.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, group, oids)
    _, inside = np.unique(group.astype(np.int64) * (docs.max() + 1) + docs, return_inverse=True)
    before = np.full(inside.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(before, inside, places)
    later = (oids > first[group]) | (places > before[inside])
    found: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for i, p in zip(text[later].tolist(), places[later].tolist()):
        found.setdefault((oid[i], mark[i]), []).append((p, p + length))
    out = [(*doc, *span) for doc, spans in found.items() for span in merged(spans)]
    if out:
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*out), types)],
                              ["oid", "mark", "start", "until"])


# The index

class RunIndex:
    """Run-compressed Burrows-Wheeler transform of some texts, each with an end of its own.

    Kept of the suffix array are its values at both ends of each run, and of the lengths
    of common prefixes, between two runs of a byte, where the least one stands: there a
    match that cannot go on changes from the run above to the one below.
    """

    END = 256

    def __init__(self, texts: list[bytes]):
        n_texts = len(texts)
        sizes = np.fromiter(map(len, texts), np.int64, n_texts)
        ends = self.ends = np.cumsum(sizes + 1) - 1
        self.data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        self.n = len(self.data)
        at_end = self.stops()
        order, common = self._sorted(self.data, ends)
        before = self.data[order - 1].astype(np.int16)
        before[at_end[order - 1]] = self.END
        # Runs, and samples at their ends.
        self.start = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        last = np.r_[self.start[1:], self.n] - 1
        self.byte = before[self.start].astype(np.int64)
        self.at_start, self.at_last, self.last = order[self.start], order[last], last
        size = last - self.start + 1
        # Runs of each byte in turn; how often it stands before each.
        self.runs = len(self.start)
        self.by_byte = np.sort(self.byte * self.runs + np.arange(self.runs))
        run = self.by_byte % self.runs
        total = np.cumsum(size[run]) - size[run]
        counts = np.bincount(self.byte, weights=size, minlength=257).astype(np.int64)
        firsts = np.cumsum(counts) - counts
        self.before = np.empty(self.runs, np.int64)
        self.before[run] = total - firsts[self.byte[run]]
        # Suffixes that start with an end come first.
        self.first = n_texts + np.cumsum(counts[:256]) - counts[:256]
        self.turn = self._turns(run, common)
        # Rows of suffixes that begin alike, for those that ask by length.
        self.common = common

    @staticmethod
    def _sorted(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix array, and the length that each suffix has in common with the one before.

        By doubling: suffixes alike so far are sorted by what follows. Those that end alike
        are in the order of their texts.
        """
        n, depth = len(data), 7
        text = np.repeat(np.arange(len(ends)), np.diff(np.r_[-1, ends]))
        left = ends[text] - np.arange(n)
        key, padded = np.zeros(n, np.int64), np.r_[data.astype(np.int64) + 1, np.zeros(depth, np.int64)]
        padded[ends] = 0
        for step in range(depth):
            key = key << 9 | np.where(left >= step, padded[step:n + step], 0)
        order = np.argsort(key)
        ordered = key[order]
        head = np.r_[True, ordered[1:] != ordered[:-1]]
        slots = np.arange(n)
        levels, rank = [], np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(head, slots, 0))
        while True:
            alone = head & np.r_[head[1:], True]
            slots = slots[~alone]
            if not len(slots):
                break
            # What ends before that depth is like nothing else.
            levels.append((depth, np.where(left < depth, -1 - np.arange(n), rank).astype(np.int32)))
            some = order[slots]
            after = np.minimum(some + depth, n - 1)
            follows = np.where(left[some] < depth, text[some], rank[after])
            key = rank[some] << 32 | follows
            turn = np.argsort(key)
            ordered = key[turn]
            order[slots] = some[turn]
            head = np.r_[True, ordered[1:] != ordered[:-1]]
            rank[order[slots]] = slots[np.maximum.accumulate(np.where(head, np.arange(len(slots)), 0))]
            depth *= 2
        one, two = order[:-1], order[1:]
        common = np.zeros(n - 1, np.int64)
        for depth, rank in reversed(levels):
            common += depth * (rank[one + common] == rank[two + common])
        alike = np.where(left == 0, -1 - np.arange(n), data)
        more = np.arange(n - 1)
        while len(more):
            more = more[alike[one[more] + common[more]] == alike[two[more] + common[more]]]
            common[more] += 1
        return order, np.r_[0, common]

    def _turns(self, run: np.ndarray, common: np.ndarray) -> np.ndarray:
        """For each run but a byte's first, where the least common prefix since the last is."""
        turn = np.zeros(self.runs, np.int64)
        least = common << 32 | np.arange(self.n)
        byte = self.byte[run]
        for b in np.unique(byte[byte < self.END]):
            mine = run[byte == b]
            if len(mine) > 1:
                edges = np.column_stack([self.last[mine[:-1]] + 1, self.start[mine[1:]] + 1]).ravel()
                edges = edges[:-1] if edges[-1] == self.n else edges
                turn[mine[1:]] = np.minimum.reduceat(least, edges)[::2] & 0xFFFFFFFF
        return turn

    def stream(self, texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, place and row of each place whose longest match has ``length`` bytes or more.

        All texts go through in step, from right to left: a match is carried on inside its
        run, or goes over to the nearest run of the byte that keeps more of it. Then, from
        left to right, the lengths are read off the data at the places found.
        """
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        longest = np.argsort(-sizes, kind="stable")
        sizes = sizes[longest]
        width = int(sizes[0])
        bytes_of = np.zeros((len(texts), width), np.uint8)
        for i, which in enumerate(longest):
            bytes_of[i, :sizes[i]] = np.frombuffer(texts[which], np.uint8)
        at = np.full((len(texts), width), self.n, np.int64)
        rows = np.zeros((len(texts), width), np.int64)
        row = np.full(len(texts), self.n - 1)
        here = np.full(len(texts), self.at_last[-1])
        for step in range(width):
            n = int(np.searchsorted(-sizes, -step, "left"))  # texts longer than the step
            i = sizes[:n] - 1 - step
            byte = bytes_of[np.arange(n), i].astype(np.int64)
            q, p = row[:n], here[:n]
            run = np.searchsorted(self.start, q, "right") - 1
            other = np.flatnonzero(self.byte[run] != byte)
            known = np.ones(n, bool)
            if len(other):
                b, r = byte[other], run[other]
                place = np.searchsorted(self.by_byte, b * self.runs + r)
                below = self.by_byte[np.minimum(place, self.runs - 1)]
                above = self.by_byte[np.maximum(place - 1, 0)]
                has_below = (place < self.runs) & (below // self.runs == b)
                has_above = (place > 0) & (above // self.runs == b)
                below, above = below % self.runs, above % self.runs
                up = has_above & (~has_below | (q[other] < self.turn[below]))
                r = np.where(up, above, below)
                run[other] = r
                q[other] = np.where(up, self.last[r], self.start[r])
                p[other] = np.where(up, self.at_last[r], self.at_start[r])
                known[other] = has_below | has_above
            q[:] = np.where(known, self.first[byte] + self.before[run] + q - self.start[run],
                            self.n - 1)
            p[:] = np.where(known, p - 1, self.at_last[-1])
            at[np.arange(n)[known], i[known]] = p[known]
            rows[np.arange(n), i] = q
        enough = self._lengths(bytes_of, sizes, at) >= length
        text, place = np.nonzero(enough)
        return longest[text], place, rows[text, place]

    def _lengths(self, bytes_of: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How far each place agrees with the data where its match was found."""
        found = np.zeros(at.shape, np.int64)
        ends = np.r_[self.data, np.uint8(0)]
        stop = np.r_[self.stops(), True]
        matched = np.zeros(len(sizes), np.int64)
        for i in range(at.shape[1]):
            matched = np.maximum(0, matched - 1)
            # A place after a jump may have more than its neighbour left it, never less.
            open_rows = np.flatnonzero((sizes > i) & (at[:, i] < self.n))
            while len(open_rows):
                there = at[open_rows, i] + matched[open_rows]
                ahead = i + matched[open_rows]
                same = (ahead < sizes[open_rows]) & (there < self.n)
                there, ahead = np.minimum(there, self.n), np.minimum(ahead, at.shape[1] - 1)
                same &= ~stop[there] & (ends[there] == bytes_of[open_rows, ahead])
                open_rows = open_rows[same]
                matched[open_rows] += 1
            found[:, i] = matched
        return found

    def stops(self) -> np.ndarray:
        """Which places of the data end a text."""
        found = np.zeros(self.n, bool)
        found[self.ends] = True
        return found

    def group(self, rows: np.ndarray, length: int) -> np.ndarray:
        """Number of the suffixes that share ``length`` bytes with a row's; -1 for it alone."""
        head = self.common < length
        starts = np.flatnonzero(head)
        sizes = np.diff(np.r_[starts, self.n])
        which = np.searchsorted(starts, rows, "right") - 1
        return np.where(sizes[which] > 1, which, -1)

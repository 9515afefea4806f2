"""Fuzzy line deduplication: MinHash bands, exact Jaccard verification, union-find.

Equal lines are one line from the start, so a line that a third of all documents
share costs one row per task and occurrence, and is compared once.
"""

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_intdigest

from tastemap.llm.shared import components, let_go, row_key, ship_code, with_row_key
from tastemap.llm.urls import build_filter, may_contain
from tastemap.sources.durable import durable

# Characters in a shingle. Long lines of one language share most shorter ones by chance.
SHINGLE = 8
# Bands of so many hashes, a byte of each kept: a pair of similarity 0.8 shares a band with
# chance 0.9998.
BANDS, ROWS = 16, 4
THRESHOLD = 0.8
# Lines of a bucket compared in one go; a larger bucket is cut into tiles of this many.
TILE = 1024
# Rows of buckets looked at in one go, and shingles held meanwhile; neither changes a link.
GROUP_ROWS, HELD = 4096, 1 << 19
# Parts of the buckets for each partition of a shuffle, and keys that a task deals out at once.
PARTS, DEALT = 4, 1 << 19
# Two clashing hashes of a pair move it by less than this many common shingles about the threshold.
DOUBT = 8
# Groups of fewer rows are compared pair by pair, larger ones a line with all others at once.
FEW = 24
# Characters hashed at once.
CHUNK = 1 << 16

# The blanks of ASCII within a line, as one.
BLANKS = bytes.maketrans(b"\t\r\v\f", b"    ")

LINE_SCHEMA = "doc_id long, doc binary, line int, digest binary, signature binary, n_lines int"


def normal_lines(text: bytes | None) -> list[bytes]:
    """The lines of a UTF-8 text as they are compared: A-Z in lower case, blanks single.

    Blank lines are empty here; they are never duplicates.
    """
    # Whole texts are rewritten: lines are too many to be split into words one by one.
    text = (text or b"").lower().translate(BLANKS)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text.replace(b" \n", b"\n").replace(b"\n ", b"\n").strip(b" ").split(b"\n")


def shingles(line: str) -> set[str]:
    """Character shingles of a line; a shorter line is its own."""
    return {line[i:i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


def signatures(lines: list[str]) -> np.ndarray:
    """MinHash signature of each line: a byte of each of its hashes."""
    found = np.empty((len(lines), BANDS * ROWS), np.uint8)
    first, size = 0, 0
    for i, line in enumerate(lines):
        size += len(line)
        if size >= CHUNK or i + 1 == len(lines):
            found[first:i + 1] = _signatures(lines[first:i + 1])
            first, size = i + 1, 0
    return found


# Odd 32-bit numbers, the same everywhere.
MULTIPLIERS = np.random.default_rng(8).integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * 2 + 1


def _signatures(lines: list[str]) -> np.ndarray:
    codes, sizes = _codes(lines)
    hashes = (codes >> np.uint64(32)).astype(np.uint32)
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    found = np.empty((len(MULTIPLIERS), len(lines)), np.uint32)
    product = np.empty_like(hashes)
    for factor, least in zip(MULTIPLIERS, found):
        np.minimum.reduceat(np.multiply(hashes, factor, out=product), starts, out=least)
    # The low byte of the least hash is as good as any.
    return found.astype(np.uint8).T


def _codes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every shingle of the lines, repeats included, and how many each line has."""
    padded = [line.ljust(SHINGLE, "\0") for line in lines]
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4")
    # A shingle's polynomial by doubling: of one, two, four, then eight characters.
    value, base, width = codes.astype(np.uint64), np.uint64(0x9E3779B97F4A7C15), 1
    with np.errstate(over="ignore"):
        while width < SHINGLE:
            value = value[:-width] * base + value[width:]
            base, width = base * base, 2 * width
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
    # Shingles that would reach into the next line are left out.
    ends = np.cumsum(sizes)
    inside = np.ones(len(value), bool)
    for step in range(1, SHINGLE):
        inside[ends[:-1] - step] = False
    return value[inside], sizes - SHINGLE + 1


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per line that is not blank, and one without a line per document."""
    let_go()
    names = ["doc_id", "doc", "line", "digest", "signature", "n_lines"]
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            ids, texts = (some.column(c) for c in ("doc_id", "text"))
            texts = texts.to_pylist()
            docs = pa.array(list(map(row_key, ids.to_pylist(), texts)), pa.binary())
            lines, numbers, sizes = [], [], []
            for text in texts:
                own = normal_lines(text)
                there = [i for i, line in enumerate(own) if line]
                numbers += there
                lines += own if len(there) == len(own) else [own[i] for i in there]
                sizes.append(len(there))
            digests = list(map(xxh3_128_digest, lines))
            # Each distinct line of these documents has its signature at its first place only.
            first = dict(zip(reversed(digests), range(len(digests) - 1, -1, -1)))
            places = sorted(first.values())
            signed = [None] * len(digests)
            for i, row in zip(places, signatures([lines[i].decode() for i in places])):
                signed[i] = row.tobytes()
            doc = pa.array(np.repeat(np.arange(len(texts)), sizes))
            n, every = pa.nulls(len(digests), pa.int32()), len(texts)
            yield pa.record_batch([ids.take(doc), docs.take(doc), pa.array(numbers, pa.int32()),
                                   pa.array(digests, pa.binary()), pa.array(signed, pa.binary()),
                                   n], names)
            yield pa.record_batch([ids, docs, pa.nulls(every, pa.int32()),
                                   pa.nulls(every, pa.binary()), pa.nulls(every, pa.binary()),
                                   pa.array(sizes, pa.int32())], names)


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, copy, doc_id, n_lines, removed`` for every document.

    Lines end at ``\\n``. Two lines are linked if the Jaccard similarity of their
    character shingles is at least ``THRESHOLD``, letters A-Z compared in lower case
    and runs of blanks as one. Of each component one line stays, the one of the
    smallest document id (null last), then the first in its text; ``removed`` has
    the numbers of the others, in order. Of equal rows (``copy`` 1, 2, ...) only the
    first keeps lines. Blank lines stay. Null and empty texts have no lines; an
    empty table gives no rows.

    Lines that share a band are compared inside the task that holds their bucket; only
    the links that connect it come out, so no pairs are written.
    """
    ship_code(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("binary").alias("text"))
    rows = durable(texts.mapInArrow(_lines, LINE_SCHEMA))
    places = rows.where("digest IS NOT NULL")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc", "line")
    different = places.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("first"),
        F.max("signature").alias("signature"))
    different = durable(different.withColumn("node", F.monotonically_increasing_id()))
    members, shared = _members_of_buckets(different)
    grouped = components(_links(texts, members, shared))
    # A line that stands once and shares no bucket stays: it goes through no join.
    repeated = different.where("n > 1").select("digest", "n", "first", "node").unionByName(
        shared.where("n = 1").select("digest", "n", "first", "node"))
    nodes = durable(repeated.join(grouped, "node", "left")
                    .withColumn("component", F.coalesce("component", "node")).drop("node"))
    stays = nodes.groupBy("component").agg(F.min("first").alias("stays"))
    nodes = durable(nodes.join(stays, "component").drop("component"))
    # Only lines that stand several times are looked for among all places.
    several = nodes.where("n > 1").select("digest", F.col("stays.doc").alias("stays_doc"),
                                          F.col("stays.line").alias("stays_line"))
    key = F.xxhash64("digest")
    gone = (places.select("doc", "line", "digest")
            .where(_possible(key, several.select(key.alias("key")))).join(several, "digest")
            .where("doc <> stays_doc OR line <> stays_line").select("doc", "line")
            .unionByName(nodes.where("n = 1").select("first.doc", "first.line", "stays")
                         .where("doc <> stays.doc OR line <> stays.line").drop("stays"))
            .groupBy("doc").agg(F.array_sort(F.collect_set("line")).alias("removed")))
    copies = durable(rows.where("n_lines IS NOT NULL").select(
        "doc", "doc_id", "n_lines",
        F.row_number().over(Window.partitionBy("doc").orderBy("doc_id")).alias("copy")))
    twice = durable(copies.where("copy = 2").select("doc"))
    every = (places.select("doc", "line").join(twice, "doc")
             .groupBy("doc").agg(F.array_sort(F.collect_set("line")).alias("every")))
    found = copies.join(gone, "doc", "left").join(every, "doc", "left")
    removed = F.when(F.col("copy") > 1, F.col("every")).otherwise(F.col("removed"))
    return found.select("doc", "copy", "doc_id", "n_lines", F.coalesce(
        removed, F.array().cast("array<int>")).alias("removed"))


def _members_of_buckets(different: DataFrame,
                        tile: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``key, tile, node`` of buckets with two lines or more, and those lines."""
    tile = tile or TILE
    parts = PARTS * int(different.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Sixteen rows a line would be most of the work: a task writes those of a part as one row.
    dealt = different.select("node", "signature").mapInArrow(
        lambda batches: _dealt(_band_keys(batches), parts), "part int, keys binary, nodes binary")
    together = dealt.repartition("part").sortWithinPartitions("part")
    # Which lines make a tile does not matter.
    members = durable(together.mapInArrow(
        lambda batches: _shared_buckets(_in_order(batches), tile),
        "key long, tile int, node long"))
    nodes = durable(members.select("node").distinct())
    # Most lines share no bucket; a blocked Bloom filter passes over nearly all of them
    # before the join moves any row. Nothing but its keys goes through Python.
    key = F.xxhash64("node")
    some = different.where(_possible(key, nodes.select(key.alias("key"))))
    return members, durable(some.join(nodes, "node"))


def _links(texts: DataFrame, members: DataFrame, shared: DataFrame,
           sets: Callable = shingles) -> DataFrame:
    """Verified edges ``(a, b)`` that connect the lines that links connect.

    ``sets`` gives the shingles of a line. A pair is compared in the first bucket it
    shares. Signatures tell which members have such a pair in a bucket; only for
    those does the text of a line move.
    """
    # Each tile of a large bucket meets itself and every other one.
    large = members.where("tile > 0").groupBy("key").agg(F.max("tile").alias("last"))
    placed = members.join(large, "key", "left").withColumn("other", F.explode(
        F.sequence(F.lit(0), F.coalesce("last", F.lit(0)))))
    group = ["key", "one", "two"]
    placed = placed.select("key", F.least("tile", "other").alias("one"),
                           F.greatest("tile", "other").alias("two"), "tile", "node")

    def together(rows: DataFrame) -> DataFrame:
        return rows.repartition(*group).sortWithinPartitions(*group)

    signed = together(placed.join(shared.select("node", "signature"), "node"))
    meeting = durable(signed.mapInArrow(
        _meeting, "key long, one int, two int, tile int, node long, signature binary"))
    lines = _texts_of(texts, shared.select("node", "first.doc", F.col("first.line").alias("number"))
                      .join(meeting.select("node").distinct(), "node", "left_semi"))
    return together(meeting.join(lines, "node")).mapInArrow(
        lambda batches: _bucket_links(batches, sets), "a long, b long").distinct()


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets of each line: the number of a band and the line's bytes there."""
    for batch in batches:
        nodes = batch.column("node").to_numpy()
        raw = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u4")
        bands = len(raw) // max(1, len(nodes))
        keys = raw.reshape(len(nodes), bands).astype(np.int64) | np.arange(bands) << 32
        yield pa.record_batch([pa.array(keys.ravel()), pa.array(np.repeat(nodes, bands))],
                              ["key", "node"])


def _dealt(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """``part, keys, nodes``: keys with their nodes, dealt into parts by a hash of the key."""
    some, n = [], 0
    for batch in batches:
        some.append(batch)
        n += batch.num_rows
        if n >= DEALT:
            yield _deal(some, parts)
            some, n = [], 0
    if n:
        yield _deal(some, parts)


def _deal(batches: list[pa.RecordBatch], parts: int) -> pa.RecordBatch:
    keys, nodes = (np.concatenate([b.column(c).to_numpy() for b in batches])
                   for c in ("key", "node"))
    part = (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(parts)
    order = np.argsort(part)
    part = part[order].astype(np.int32)
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    offsets = pa.py_buffer((np.r_[starts, len(part)] * 8).astype(np.int32))
    packed = [pa.Array.from_buffers(pa.binary(), len(starts),
                                    [None, offsets, pa.py_buffer(values[order])])
              for values in (keys, nodes)]
    return pa.record_batch([pa.array(part[starts]), *packed], ["part", "keys", "nodes"])


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ``key, node`` of each part in the order of keys, from rows in the order of parts."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for _, same in groupby(rows, itemgetter(0)):
        _, keys, nodes = zip(*same)
        keys, nodes = (np.frombuffer(b"".join(v), np.int64) for v in (keys, nodes))
        order = np.argsort(keys)
        yield pa.record_batch([pa.array(keys[order]), pa.array(nodes[order])], ["key", "node"])


def _shared_buckets(batches: Iterator[pa.RecordBatch],
                    tile: int | None = None) -> Iterator[pa.RecordBatch]:
    """Members of buckets of two or more, in tiles, from rows in the order of buckets."""
    tile = tile or TILE
    key, size, alone = None, 0, None
    for batch in batches:
        keys, nodes = batch.column("key").to_numpy(), batch.column("node").to_numpy()
        if not len(keys):
            continue
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        place = np.arange(len(keys)) - np.repeat(starts, sizes)
        shared = np.repeat(sizes > 1, sizes)
        if keys[0] == key:  # the bucket began in the last batch
            place[:sizes[0]] += size
            shared[:sizes[0]] = True
            sizes[0] += size
            if alone is not None:
                yield _members([key], [0], [alone])
        key, size = keys[-1], int(sizes[-1])
        alone = nodes[-1] if size == 1 else None
        yield _members(keys[shared], place[shared] // tile, nodes[shared])


def _members(keys, tiles, nodes) -> pa.RecordBatch:
    return pa.record_batch([pa.array(keys, pa.int64()), pa.array(tiles, pa.int32()),
                            pa.array(nodes, pa.int64())], ["key", "tile", "node"])


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows in the order of ``key, one, two`` as some whole groups at a time, with each row's end
    of group."""
    left = None
    for batch in batches:
        for at in range(0, batch.num_rows, GROUP_ROWS):
            some = batch.slice(at, GROUP_ROWS)
            if left is not None and left.num_rows:
                some = pa.Table.from_batches([left, some]).combine_chunks().to_batches()[0]
            ends = _ends(some)
            last = int(np.searchsorted(ends, len(ends)))
            if last:
                yield some.slice(0, last), ends[:last]
            left = some.slice(last)
    if left is not None and left.num_rows:
        yield left, _ends(left)


def _ends(rows: pa.RecordBatch) -> np.ndarray:
    """For each row, where its group ends."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for name in ("key", "one", "two"):
        values = rows.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.r_[starts, rows.num_rows])
    return np.repeat(starts + sizes, sizes)


def _first_meetings(rows: pa.RecordBatch, ends: np.ndarray,
                    live: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a ``live`` row and a later one of its group that share no earlier band, those some
    places apart at a time.

    In a group of two tiles, only pairs across them count.
    """
    signature = np.frombuffer(b"".join(rows.column("signature").to_pylist()), "<u4")
    bands = signature.reshape(rows.num_rows, len(signature) // max(1, rows.num_rows))
    band = rows.column("key").to_numpy() >> 32
    across = rows.column("one").to_numpy() != rows.column("two").to_numpy()
    tile = rows.column("tile").to_numpy()
    apart = 0
    while len(live):
        apart += 1
        live = live[live + apart < ends[live]]
        i, j = live, live + apart
        found = (bands[i] == bands[j]).argmax(axis=1) == band[i]
        found &= ~across[i] | (tile[i] != tile[j])
        yield i[found], j[found]


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that have a pair to be compared in their group."""
    names = ["key", "one", "two", "tile", "node", "signature"]
    for rows, ends in _whole_groups(batches):
        meets = np.zeros(rows.num_rows, bool)
        for i, j in _first_meetings(rows, ends, np.arange(rows.num_rows)):
            meets[i] = meets[j] = True
        yield rows.select(names).filter(pa.array(meets))


def _bucket_links(batches: Iterator[pa.RecordBatch],
                  sets: Callable) -> Iterator[pa.RecordBatch]:
    """Verified links that are needed to connect each bucket, or pair of tiles.

    A pair is compared unless links connect it already or the sizes of its sets
    forbid the similarity.
    """
    for rows, ends in _whole_groups(batches):
        found = _connected(rows, ends, sets)
        if found:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])


def _connected(rows: pa.RecordBatch, ends: np.ndarray, sets: Callable) -> list[tuple[int, int]]:
    """Links between rows of whole groups, by numbers for shingles; what clashing hashes could turn
    is decided by ``sets``.

    About ``HELD`` shingles are held at once: some groups, or two blocks of a larger one.
    """
    lines, nodes = rows.column("line"), rows.column("node").to_numpy()
    sizes = np.maximum(pc.utf8_length(lines).to_numpy(), SHINGLE) - SHINGLE + 1
    before = np.r_[0, np.cumsum(sizes)]
    tie = _Ties(rows, ends, sets)
    few = ends - tie.starts < FEW
    pairs = [np.concatenate(c) for c in zip(*_first_meetings(rows, ends, np.flatnonzero(few)))]
    if pairs:
        order = np.lexsort(pairs[::-1])
        tie.pairs(pairs[0][order].tolist(), pairs[1][order].tolist())
    for first, last in _runs(before, 0, np.unique(ends).tolist(), HELD):
        if before[last] - before[first] <= HELD:
            places = first + np.flatnonzero(~few[first:last])
            if len(places):
                tie.among(places, np.arange(1, len(places) + 1),
                          np.searchsorted(places, ends[places]))
            continue
        if few[first]:
            continue
        blocks = list(_runs(before, first, range(first + 1, last + 1), HELD // 2))
        for n, (start, stop) in enumerate(blocks):
            own = np.arange(start, stop)
            tie.among(own, own + 1 - start, np.full(len(own), len(own)))
            for other in blocks[n + 1:]:
                places = np.r_[own, np.arange(*other)]
                tie.among(places, np.full(len(own), len(own)), np.full(len(own), len(places)))
    # Group by group, however many of them came at once.
    links = sorted(tie.links, key=lambda link: tie.starts[link[0]])
    return [(int(nodes[i]), int(nodes[j])) for i, j in links]


def _runs(before: np.ndarray, first: int, ends: Iterable[int],
          most: int) -> Iterator[tuple[int, int]]:
    """Runs from ``first`` on that stop at some of the ``ends``: of at most so many shingles, or
    from one end to the next."""
    last = first
    for end in ends:
        if last > first and before[end] - before[first] > most:
            yield first, last
            first = last
        last = end
    if last > first:
        yield first, last


class _Ties:
    """Links between rows of groups, and by ``head`` what they connect."""

    def __init__(self, rows: pa.RecordBatch, ends: np.ndarray, sets: Callable):
        self.lines, self.sets, self.links = rows.column("line"), sets, []
        self.head, self.ends = np.arange(rows.num_rows), ends
        self.starts = np.searchsorted(ends, ends)
        signature = np.frombuffer(b"".join(rows.column("signature").to_pylist()), "<u4")
        self.bands = signature.reshape(rows.num_rows, len(signature) // max(1, rows.num_rows))
        self.band = rows.column("key").to_numpy() >> 32
        self.across = rows.column("one").to_numpy() != rows.column("two").to_numpy()
        self.tile = rows.column("tile").to_numpy()
        self.held, self.known = 0, {}

    def pairs(self, first: list[int], second: list[int]) -> None:
        """Link the rows of each pair in turn, those of one group after the other."""
        for i, j in zip(first, second):
            if self.head[i] == self.head[j]:
                continue
            one, two = self._numbers(i), self._numbers(j)
            doubt = 0
            if one is None or two is None:
                one, two, doubt = self._hashes(i), self._hashes(j), DOUBT
            small, large = sorted((len(one), len(two)))
            if small < THRESHOLD * large - doubt:
                continue
            both = np.concatenate((one, two))
            both.sort(kind="stable")  # merges the two
            common = np.count_nonzero(both[1:] == both[:-1])
            over = common - THRESHOLD * (small + large - common)
            if over >= -doubt:
                self._link(i, [j], [over < doubt])

    def _numbers(self, i: int) -> np.ndarray | None:
        """A row's shingles as numbers that never clash, if its characters are bytes."""
        return self._once((i, 0), _packed)

    def _hashes(self, i: int) -> np.ndarray:
        return self._once((i, 1), lambda line: np.unique(_codes([line])[0]))

    def _once(self, key: tuple[int, int], make: Callable) -> np.ndarray | None:
        if key not in self.known:
            if self.held > HELD:
                self.held, self.known = 0, {}
            found = self.known[key] = make(self.lines[key[0]].as_py())
            self.held += 0 if found is None else len(found)
        return self.known[key]

    def among(self, places: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        """Link the first of the ``places``, each with those between its ``first`` and ``last``."""
        ids, at = _distinct([self.lines[i].as_py() for i in places.tolist()])
        sizes = np.diff(at)
        mark = np.zeros(ids.max(initial=0) + 1, bool)
        for k in np.flatnonzero(first < last).tolist():
            i, others = places[k], np.arange(first[k], last[k])
            others = others[self._to_compare(i, places[others])]
            small, large = np.minimum(sizes[k], sizes[others]), np.maximum(sizes[k], sizes[others])
            others = others[small >= THRESHOLD * large]
            if not len(others):
                continue
            own = ids[at[k]:at[k + 1]]
            mark[own] = True
            if 8 * len(others) > last[k] - first[k]:
                hits = np.flatnonzero(mark[ids[at[first[k]]:at[last[k]]]])
                found = np.diff(np.searchsorted(hits, at[first[k]:last[k] + 1] - at[first[k]]))
                common = found[others - first[k]]
            else:
                common = np.array([np.count_nonzero(mark[ids[at[n]:at[n + 1]]])
                                   for n in others.tolist()])
            mark[own] = False
            over = common - THRESHOLD * (sizes[k] + sizes[others] - common)
            near = over > -DOUBT
            self._link(i, places[others[near]].tolist(), (over[near] < DOUBT).tolist())

    def _to_compare(self, i: int, j: np.ndarray) -> np.ndarray:
        """Which of ``j`` meet ``i`` here first, across tiles if there are two, and no link connects."""
        found = self.head[j] != self.head[i]
        found &= (self.bands[j] == self.bands[i]).argmax(axis=1) == self.band[i]
        return found & (self.tile[j] != self.tile[i]) if self.across[i] else found

    def _link(self, i: int, near: list[int], doubtful: list[bool]) -> None:
        own = None
        group = self.head[self.starts[i]:self.ends[i]]
        for j, doubt in zip(near, doubtful):
            if self.head[i] == self.head[j]:
                continue
            if doubt:
                own = own or self.sets(self.lines[i].as_py())
                other = self.sets(self.lines[j].as_py())
                common = len(own & other)
                if common < THRESHOLD * (len(own) + len(other) - common):
                    continue
            self.links.append((i, j))
            group[group == self.head[j]] = self.head[i]


def _packed(line: str) -> np.ndarray | None:
    """The different shingles of a line of Latin-1, whose characters make a 64-bit number; else none.

    A line shorter than a shingle has none: its characters do not say its length.
    """
    try:
        text = line.encode("latin-1")
    except UnicodeEncodeError:
        return None
    if len(text) < SHINGLE:
        return None
    found = np.sort(np.ndarray(len(text) - SHINGLE + 1, "<u8", text, strides=(1,)))
    new = np.empty(len(found), bool)
    new[0] = True
    np.not_equal(found[1:], found[:-1], out=new[1:])
    return found[new]


def _distinct(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers for the different shingles of each line in turn, and where each line's begin."""
    codes, sizes = _codes(lines)
    # The high bits of a hash and its place sort as one number.
    bits = np.uint64(len(codes).bit_length())
    in_order = np.sort((codes >> bits << bits) | np.arange(len(codes), dtype=np.uint64))
    place = (in_order & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    in_order >>= bits
    number = np.empty(len(codes), np.int64)
    number[place] = np.cumsum(np.r_[False, in_order[1:] != in_order[:-1]])
    width = len(codes) + 1
    number += np.repeat(np.arange(len(lines)) * width, sizes)
    number.sort()
    number = number[np.r_[True, number[1:] != number[:-1]]]
    at = np.searchsorted(number, np.arange(len(lines) + 1) * width)
    return number - np.repeat(np.arange(len(lines)) * width, np.diff(at)), at


def _texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, line``: the text of the wanted lines, from a second reading.

    A blocked Bloom filter of the lines' first places passes over nearly all others
    before their texts are split.
    """
    key = F.xxhash64("doc").bitwiseXOR(F.col("number").cast("long"))
    bloom = texts.sparkSession.sparkContext.broadcast(build_filter(wanted.select(key.alias("key"))))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                own = some.column("text").to_pylist()
                docs = list(map(row_key, some.column("doc_id").to_pylist(), own))
                own = [text or b"" for text in own]
                sizes = [text.count(b"\n") + 1 for text in own]
                doc = np.repeat(np.arange(len(own)), sizes)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                keys = np.array([xxh64_intdigest(d, 42) for d in docs], np.uint64).view(np.int64)
                hit = np.flatnonzero(may_contain(bloom.value, keys[doc] ^ number))
                doc, number, lines = doc[hit], number[hit], []
                for i, numbers in groupby(zip(doc.tolist(), number.tolist()), itemgetter(0)):
                    there = own[i].split(b"\n")
                    lines += [normal_lines(there[n])[0] for _, n in numbers]
                yield pa.record_batch([pa.array([docs[i] for i in doc.tolist()], pa.binary()),
                                       pa.array(number, pa.int32()), pa.array(lines, pa.binary())],
                                      ["doc", "number", "line"])

    found = texts.mapInArrow(pick, "doc binary, number int, line binary")
    # A row that stands twice gives its lines twice.
    return (found.join(wanted, ["doc", "number"]).groupBy("node")
            .agg(F.first("line").cast("string").alias("line")))


def _possible(column: Column, keys: DataFrame) -> Column:
    """Whether a 64-bit integer may be among the ``key`` of a table, by a blocked Bloom filter."""
    bloom = keys.sparkSession.sparkContext.broadcast(build_filter(keys))

    @F.arrow_udf("boolean")
    def possible(some: pa.Array) -> pa.Array:
        return pa.array(may_contain(bloom.value, some.to_numpy()))

    return possible(column)


def keep_first_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without their duplicate lines; documents with no line left go.

    A document that had no lines before, null texts included, stays as it is. All
    other columns pass untouched, whatever their names.
    """
    rows, names = with_row_key(docs, id_col, text_col)
    text = names[docs.columns.index(text_col)]
    removed = (duplicate_lines(docs, id_col, text_col)
               .where(F.size("removed") > 0).select("doc", "copy", "removed", "n_lines"))
    rows = rows.withColumn("_copy", F.row_number().over(
        Window.partitionBy("_doc").orderBy("_doc")))
    joined = rows.join(removed, (F.col("_doc") == F.col("doc"))
                       & (F.col("_copy") == F.col("copy")), "left")
    left = joined.where("removed IS NULL OR size(removed) < n_lines")
    schema = rows.select(*names).schema
    place = names.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value, gone in zip(batch.column(text).to_pylist(),
                                   batch.column("removed").to_pylist()):
                if gone:
                    numbers = set(gone)
                    value = "\n".join(line for i, line in enumerate(value.split("\n"))
                                      if i not in numbers)
                texts.append(value)
            columns = [batch.column(n) for n in names]
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.record_batch(columns, names)

    return left.select(*names, "removed").mapInArrow(cut, schema).toDF(*docs.columns)

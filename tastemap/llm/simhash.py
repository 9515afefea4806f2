"""SimHash fingerprints and near duplicates by a hierarchical index in Gray order.

Two fingerprints that differ in few bits agree in whole blocks of bits. For each
choice of blocks the fingerprints, those blocks first, are sorted by Gray rank:
fingerprints that share the blocks are neighbours and form a top node. Within it
runs of neighbours form nodes that keep the bits all members share; the
differences of two nodes' shared bits bound those of any two members from below,
so whole groups are passed over, and with the bits not shared from above, so whole
groups are linked at once.
"""

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tastemap.llm.shared import (components, join_groups, let_go, row_key, rows_that_stay,
                                  ship_code)
from tastemap.sources.durable import durable

SEED = 42
# Fingerprints compared at once; a larger top node is cut into tiles of this many.
TILE = 4096
# Children of an index node, and pairs of nodes looked at together.
FANOUT = 16
PAIRS = 1 << 20
# Runs up to this long are compared place by place, without nodes.
SHORT = 48


def fingerprint(text: bytes | None, words_per_shingle: int = 4) -> int:
    """SimHash of a UTF-8 text's word shingles, repeats included, as an unsigned integer.

    Words stand between ASCII blanks, A-Z in lower case. A text with fewer words
    than a shingle is one shingle; one without words, or null, has fingerprint 0.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[min(words_per_shingle, len(words)) - 1:].tolist()
    first = [0, *(ends[:len(last) - 1] + 1).tolist()]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(first), 1 << 16):
        shingles = [joined[a:b] for a, b in zip(first[at:at + (1 << 16)], last[at:at + (1 << 16)])]
        hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), "<u8", len(shingles))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(first), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, doc, bits``: the row's key, and the fingerprint of its whole text as a signed
    64-bit integer."""
    ship_code(docs.sparkSession)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                some = batch.slice(first, 512)
                texts = some.column("text").to_pylist()
                keys = list(map(row_key, some.column("doc_id").to_pylist(), texts))
                bits = np.array([fingerprint(t) for t in texts], np.uint64)
                yield pa.record_batch([some.column("doc_id"), pa.array(keys, pa.binary()),
                                       pa.array(bits.view(np.int64))], ["doc_id", "doc", "bits"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("binary").alias("text")).mapInArrow(
        compute, "doc_id long, doc binary, bits long")


def near_duplicates(docs: DataFrame, max_bits: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document.

    Documents are linked if their fingerprints differ in at most ``max_bits`` of
    64 bits; ``component_id`` is the smallest id reachable. Every link counts
    (none is left to chance), equal fingerprints are compared once. Null texts
    have fingerprint 0; a null id is never the smallest unless it is alone;
    repeated rows are rows of the result; no documents give no rows.
    """
    found = durable(fingerprints(docs, id_col, text_col))
    classes = _classes(found, max_bits).select("bits", F.col("stays.doc_id").alias("component_id"))
    return found.join(classes, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, max_bits: int = 4, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row of each class of near duplicates: the one of the smallest id, null last.

    Columns and nulls are as in ``docs``; of rows with equal id and text one stays.
    """
    found = fingerprints(docs, id_col, text_col)
    stays = _classes(durable(found), max_bits).select(F.col("stays.doc").alias("_doc")).distinct()
    return rows_that_stay(docs, stays, id_col, text_col)


def _classes(found: DataFrame, max_bits: int) -> DataFrame:
    """``bits, stays``: of each fingerprint the first row of its class."""
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc")
    different = durable(found.groupBy("bits").agg(F.min(row).alias("least")))
    grouped = components(links(different.select("bits"), max_bits))
    classes = (different.join(grouped, different["bits"] == grouped["node"], "left")
               .select("bits", "least", F.coalesce("component", "bits").alias("component")))
    stays = classes.groupBy("component").agg(F.min("least").alias("stays"))
    return classes.select("bits", "component").join(stays, "component")


def block_edges(blocks: int) -> list[tuple[int, int]]:
    """Lowest bit and width of each of so many blocks of 64 bits."""
    widths = [64 // blocks + (b < 64 % blocks) for b in range(blocks)]
    return [(sum(widths[:b]), widths[b]) for b in range(blocks)]


def links(different: DataFrame, max_bits: int) -> DataFrame:
    """Edges ``(a, b)`` that connect what links of at most ``max_bits`` bits connect.

    ``different`` has distinct 64-bit integers in ``bits``. With two blocks more
    than ``max_bits``, two linked fingerprints agree in two blocks at least.
    """
    ship_code(different.sparkSession)
    keyed = different.select("bits").mapInArrow(
        lambda batches: _orders(batches, block_edges(max_bits + 2)),
        "node long, rank long, bits long")
    # Written out, since the range bounds are sampled in a run of their own.
    in_order = (durable(keyed).repartitionByRange("node", "rank")
                .sortWithinPartitions("node", "rank"))
    schema = "node long, tile long, a long, b long"
    found = durable(in_order.mapInArrow(lambda batches: _index(batches, max_bits), schema))
    inside = found.where("tile IS NULL").select("a", "b")
    tiles = found.where("tile IS NOT NULL").select("node", "tile", F.col("a").alias("bits"))
    return inside.unionByName(_between_tiles(tiles, max_bits)).distinct()


def _orders(batches: Iterator[pa.RecordBatch], edges: list) -> Iterator[pa.RecordBatch]:
    """Each fingerprint once per choice of blocks: its top node, and its Gray rank there."""
    top_bits = 2 * max(width for _, width in edges)
    for batch in batches:
        bits = batch.column("bits").to_numpy().view(np.uint64)
        blocks = [((bits >> np.uint64(low)) & np.uint64((1 << width) - 1), width)
                  for low, width in edges]
        for number, chosen in enumerate(combinations(range(len(edges)), 2)):
            others = [b for b in range(len(edges)) if b not in chosen]
            value = np.zeros_like(bits)
            for place, (block, width) in enumerate(blocks[b] for b in (*chosen, *others)):
                value = (value << np.uint64(width)) | block
                if place == 1:
                    node = value | np.uint64(number << top_bits)
            yield pa.record_batch([pa.array(node.view(np.int64)),
                                   pa.array(_gray_rank(value).view(np.int64)),
                                   batch.column("bits")], ["node", "rank", "bits"])


def _between_tiles(tiles: DataFrame, max_bits: int) -> DataFrame:
    """Edges between different tiles of one top node.

    Tiles whose shared bits differ too much are passed over before any row moves.
    """
    summary = tiles.groupBy("node", "tile").agg(
        F.bit_and("bits").alias("ones"), F.bit_or("bits").alias("any"))
    summary = durable(summary.select(
        "node", "tile", "ones", F.col("ones").bitwiseXOR(F.col("any")).alias("free")))
    left = summary.select("node", *(F.col(c).alias(f"{c}_a") for c in ("tile", "ones", "free")))
    right = summary.select("node", *(F.col(c).alias(f"{c}_b") for c in ("tile", "ones", "free")))
    shared = F.bitwise_not(F.col("free_a").bitwiseOR(F.col("free_b")))
    apart = F.bit_count(F.col("ones_a").bitwiseXOR(F.col("ones_b")).bitwiseAND(shared))
    pairs = left.join(right, "node").where(F.col("tile_a") < F.col("tile_b")).where(
        apart <= max_bits)
    pairs = pairs.select(F.explode(F.array(
        F.struct("tile_a", "tile_b", F.col("tile_a").alias("tile")),
        F.struct("tile_a", "tile_b", F.col("tile_b").alias("tile")))).alias("p")).select("p.*")
    members = (pairs.join(tiles.select("tile", "bits"), "tile")
               .repartition("tile_a", "tile_b").sortWithinPartitions("tile_a", "tile_b", "tile"))
    return members.mapInArrow(lambda batches: _compare_tiles(batches, max_bits), "a long, b long")


def _index(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Edges inside the runs of a sorted partition, and the members of runs that go on elsewhere.

    The first and last run of a partition may go on in its neighbours, and a run
    may be longer than a tile: those are also given out tile by tile, to be
    compared with their other tiles.
    """
    tile = TaskContext.get().partitionId() << 32
    node, bits = np.empty(0, np.int64), np.empty(0, np.uint64)
    split: set[int] = set()  # nodes with other tiles: the first one, and one cut in the last batch
    stream, last = iter(batches), False
    while not last:
        batch = next(stream, None)
        last = batch is None
        if not last:
            node = np.concatenate([node, batch.column("node").to_numpy()])
            bits = np.concatenate([bits, batch.column("bits").to_numpy().view(np.uint64)])
        if not len(node) or not last and len(node) < TILE:
            continue
        split = split or {int(node[0])}
        starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        ends = np.r_[starts[1:], len(node)]
        if not last:  # the last run may go on in the next batch
            ends[-1] -= (ends[-1] - starts[-1]) % TILE
        sizes = ends - starts
        alone = (sizes <= TILE) & ~np.isin(node[starts], list(split))
        alone[-1] = False
        label = np.arange(len(node))
        short = alone & (sizes <= SHORT)
        _link_short(bits, label, np.where(short, sizes, 0), starts, max_bits)
        for run in np.flatnonzero(alone & ~short):
            _link_groups(bits, label, np.arange(starts[run], ends[run]), None, max_bits)
        for run in np.flatnonzero(~alone):
            for first in range(int(starts[run]), int(ends[run]), TILE):
                rows = np.arange(first, min(first + TILE, int(ends[run])))
                _link_groups(bits, label, rows, None, max_bits)
                none = pa.nulls(len(rows), pa.int64())
                yield pa.record_batch(
                    [pa.array(node[rows]), pa.array(np.full(len(rows), tile)),
                     pa.array(bits[rows].view(np.int64)), none], ["node", "tile", "a", "b"])
                tile += 1
        a, b = _edges(bits, label)
        none = pa.nulls(len(a), pa.int64())
        yield pa.record_batch([none, none, a, b], ["node", "tile", "a", "b"])
        split = {min(split), int(node[-1])} if sizes[-1] else split
        done = int(ends[-1])
        node, bits = node[done:], bits[done:]


def _compare_tiles(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Edges between the two tiles of each pair; the rows of a pair come together."""
    names = ("tile_a", "tile_b", "tile", "bits")
    kept = {name: np.empty(0, np.int64) for name in names}
    stream, last = iter(batches), False
    while not last:
        batch = next(stream, None)
        last = batch is None
        if not last:
            kept = {n: np.concatenate([kept[n], batch.column(n).to_numpy()]) for n in names}
        if not len(kept["bits"]):
            continue
        new = (kept["tile_a"][1:] != kept["tile_a"][:-1]) | (kept["tile_b"][1:]
                                                             != kept["tile_b"][:-1])
        starts = np.flatnonzero(np.r_[True, new])
        ends = np.r_[starts[1:], len(kept["bits"])]
        whole = len(starts) - (not last)  # the last pair may go on in the next batch
        for first, stop in zip(starts[:whole], ends[:whole]):
            bits = kept["bits"][first:stop].view(np.uint64)
            order = np.argsort(_gray_rank(bits))
            left = kept["tile"][first:stop][order] == kept["tile_a"][first]
            bits, label = bits[order], np.arange(len(bits))
            _link_groups(bits, label, np.flatnonzero(left), np.flatnonzero(~left), max_bits)
            yield pa.record_batch(list(_edges(bits, label)), ["a", "b"])
        done = int(ends[whole - 1]) if whole else 0
        kept = {n: column[done:] for n, column in kept.items()}


def _gray_rank(bits: np.ndarray) -> np.ndarray:
    for step in (1, 2, 4, 8, 16, 32):
        bits = bits ^ (bits >> np.uint64(step))
    return bits


def _edges(bits: np.ndarray, label: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Each member and the head it is linked to."""
    moved = np.flatnonzero(label != np.arange(len(label)))
    signed = bits.view(np.int64)
    return pa.array(signed[moved]), pa.array(signed[label[moved]])


def _link_short(bits: np.ndarray, label: np.ndarray, sizes: np.ndarray, starts: np.ndarray,
                max_bits: int) -> None:
    """Link inside short runs: each member with the next, the one after next and so on."""
    runs = sizes > 1
    ends = np.repeat((starts + sizes)[runs], sizes[runs])
    place = np.arange(len(ends)) - np.repeat(np.cumsum(sizes[runs]) - sizes[runs], sizes[runs])
    place += np.repeat(starts[runs], sizes[runs])
    for step in range(1, int(sizes.max(initial=0))):
        there = place + step < ends
        place, ends = place[there], ends[there]
        near = np.bitwise_count(bits[place] ^ bits[place + step]) <= max_bits
        if near.any():
            join_groups(label, place[near], place[near] + step)


def _levels(bits: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ones that all members of a node share and ones of any member; leaves first."""
    levels = [(bits, bits)]
    while len(levels[-1][0]) > FANOUT:
        every, some = levels[-1]
        heads = np.arange(0, len(every), FANOUT)
        levels.append((np.bitwise_and.reduceat(every, heads),
                       np.bitwise_or.reduceat(some, heads)))
    return levels


def _link_groups(bits: np.ndarray, label: np.ndarray, left: np.ndarray, right: np.ndarray | None,
                 max_bits: int) -> None:
    """Link inside ``left``, or between ``left`` and ``right``, both in Gray order.

    Pairs of nodes go down the two indexes together: a pair whose shared bits
    differ too much is dropped with all its members, one whose members cannot
    differ too much is linked as a whole.
    """
    if not len(left) or right is not None and not len(right):
        return
    one = _levels(bits[left])
    two = one if right is None else _levels(bits[right])
    while len(two) < len(one):
        two.append(two[-1] if len(two[-1][0]) == 1 else _top(two[-1]))
    while len(one) < len(two):
        one.append(one[-1] if len(one[-1][0]) == 1 else _top(one[-1]))
    other = left if right is None else right
    level = len(one) - 1
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(one[level][0])),
                                           np.arange(len(two[level][0])), indexing="ij"))
    if right is None:
        i, j = i[i <= j], j[i <= j]
    waiting = [(level, i, j)]
    while waiting:
        level, i, j = waiting.pop()
        (every_a, some_a), (every_b, some_b) = one[level], two[level]
        free = (every_a[i] ^ some_a[i]) | (every_b[j] ^ some_b[j])
        apart = np.bitwise_count((every_a[i] ^ every_b[j]) & ~free)
        near = apart <= max_bits
        i, j, free, apart = i[near], j[near], free[near], apart[near]
        whole = apart + np.bitwise_count(free) <= max_bits
        if level == 0:
            join_groups(label, left[i], other[j])
            continue
        reach = FANOUT ** level
        for a, b in zip(i[whole], j[whole]):
            members = np.r_[left[a * reach:(a + 1) * reach], other[b * reach:(b + 1) * reach]]
            join_groups(label, members, np.full(len(members), members[0]))
        i, j = i[~whole], j[~whole]
        chunk = PAIRS // FANOUT ** 2
        for at in range(0, len(i), chunk):
            waiting.append((level - 1, *_children(i[at:at + chunk], j[at:at + chunk],
                                                  len(one[level - 1][0]), len(two[level - 1][0]),
                                                  right is None)))


def _top(level: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One node over all nodes of a level."""
    return (np.bitwise_and.reduce(level[0], keepdims=True),
            np.bitwise_or.reduce(level[1], keepdims=True))


def _children(i: np.ndarray, j: np.ndarray, n_left: int, n_right: int,
              same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of children of each pair of nodes; inside one index each pair once."""
    step = np.arange(FANOUT)
    a = (i[:, None] * FANOUT + step)[:, :, None]
    b = (j[:, None] * FANOUT + step)[:, None, :]
    a, b = np.broadcast_arrays(a, b)
    there = (a < n_left) & (b < n_right)
    if same:
        there &= a <= b
    return a[there], b[there]

"""Packing token pieces into sequences: patterns by non-negative least squares, then best fit.

All planning happens on the histogram of lengths, whose size is set by the sequence
length and not by the corpus.
"""

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.llm.shared import cell, let_go, number_rows, ship_code
from tastemap.llm.tokens import encoder
from tastemap.sources.durable import durable

# Lengths are rounded up to a multiple of this when patterns are enumerated,
# and a pattern has at most so many documents.
GRAIN = 64
PATTERN_DOCUMENTS = 3

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int, max_tokens: int,
                  id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = False) -> DataFrame:
    """Token pieces of at most ``max_tokens``: one per document, more for a longer one only.

    A document is its ids and then ``end_id``; a null or empty text is ``end_id``
    alone. A row is ``doc_id``, ``piece`` from 0, ``start`` (ids of the document
    before it), ``length``, ``ids_crc32`` and, if asked for, ``ids`` as bytes of
    little-endian unsigned 32-bit integers. Rows with equal or null ids are
    documents of their own.
    """
    ship_code(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("binary").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, end = encoder(tokenizer).encode, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                some = batch.slice(first, 256)
                columns = [[] for _ in range(6)]
                for doc, ids in zip(some.column("doc_id").to_pylist(),
                                    encode_texts(some.column("text").to_pylist())):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * max_tokens)):
                        part = ids[at:at + 4 * max_tokens]
                        values = (doc, piece, at // 4, len(part) // 4, crc32(part), part)
                        for column, value in zip(columns, values):
                            column.append(value)
                arrays = [pa.array(c, t) for c, t in zip(columns, (
                    pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.record_batch(arrays[:5 + with_ids], names[:5 + with_ids])

    return texts.mapInArrow(cut, PIECE_SCHEMA + (", ids binary" if with_ids else ""))


def pack_pieces(pieces: DataFrame, max_tokens: int) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, in few sequences of ``max_tokens``.

    ``pieces`` has a column ``length`` of 1 to ``max_tokens``; other columns are
    kept. The pieces of each length are numbered, and the plan says which numbers
    of a length go to which sequences, so placing a piece is a look-up. Lengths
    outside the range are an error. No pieces give no rows.
    """
    ship_code(pieces.sparkSession)
    pieces = durable(pieces.withColumn("cell", cell()))
    counts = np.zeros(max_tokens + 1, dtype=np.int64)
    for length, n in pieces.groupBy("length").count().collect():
        if length is None or not 1 <= length <= max_tokens:
            raise ValueError(f"a piece of length {length}; 1 to {max_tokens} can be packed")
        counts[length] = n
    # At most a few slots per length and pattern, whatever the number of pieces.
    slots = pieces.sparkSession.sparkContext.broadcast(plan_slots(plan_sequences(counts)))
    numbered = number_rows(pieces, ["length"], [F.col(c) for c in pieces.columns
                                                if c in ("doc_id", "piece")] or ["cell"], "rank")
    schema = numbered.drop("cell", "rank").schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        lengths, ranks, sequences, offsets = slots.value
        keys = (lengths << 44) + ranks
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (batch.column("length").to_numpy() << 44) + rank, "right") - 1
            kept = batch.select([f.name for f in schema.fields[:-2]])
            yield pa.record_batch(
                [*kept.columns, pa.array(sequences[at] + rank - ranks[at]), pa.array(offsets[at])],
                [f.name for f in schema.fields])

    return numbered.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence in order, from pieces packed with their ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return packed.groupBy("sequence_id").agg(
        F.unhex(F.array_join(F.transform(parts, lambda p: p["ids"]), "")).alias("ids"))


def plan_sequences(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Kinds of sequences, as the lengths in it, and how many of each.

    ``counts[length]`` pieces are all placed. Patterns of a few rounded lengths
    that fill a sequence get the counts that fit the histogram best; the counts
    are rounded, and what remains goes by decreasing length into the fullest
    sequence with room, those of the patterns included.
    """
    size = len(counts) - 1
    left = np.array(counts, dtype=np.int64)
    kinds = []
    if left[size]:
        kinds.append(((size,), int(left[size])))
        left[size] = 0
    kinds += _pattern_kinds(left, size)
    return _best_fit(left, kinds, size)


def plan_slots(kinds: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """Length, first rank, first sequence and offset of each run of pieces, sorted."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, n in kinds:
        offset = 0
        for length in lengths:
            first = used.get(length, 0)
            rows.append((length, first, sequence, offset))
            used[length] = first + n
            offset += length
        sequence += n
    found = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return tuple(found.T.copy())


def _pattern_kinds(left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Kinds of sequences by patterns; takes their pieces out of ``left``."""
    grain = max(GRAIN, -(-size // 64))
    bins = size // grain
    if bins < 2:
        return []
    stock: list[list[int]] = [[] for _ in range(bins + 1)]  # lengths of each bin, long ones first
    for length in range(1, bins * grain + 1):
        if left[length]:
            stock[-(-length // grain)].insert(0, length)
    histogram = np.array([sum(int(left[x]) for x in lengths) for lengths in stock])
    present = [b for b in range(1, bins + 1) if histogram[b]]
    patterns = [p for p in _patterns(present, bins) if len(p) > 1]
    if not patterns:
        return []
    matrix = np.zeros((bins + 1, len(patterns)))
    for column, pattern in enumerate(patterns):
        for b in pattern:
            matrix[b, column] += 1
    repeats = nnls(matrix[present], histogram[present].astype(float))
    kinds = []
    for column in np.argsort(-repeats, kind="stable"):
        n = int(round(repeats[column]))
        while n > 0 and (lengths := _take(patterns[column], stock, left, size)):
            run = min([n, *(int(left[x]) // lengths.count(x) for x in lengths)])
            for x in set(lengths):
                left[x] -= run * lengths.count(x)
            kinds.append((lengths, run))
            n -= run
    return kinds


def _take(pattern: tuple[int, ...], stock: list[list[int]], left: np.ndarray,
          size: int) -> tuple[int, ...] | None:
    """Exact lengths for a pattern of bins, none if a bin has run out.

    All but the shortest are the longest left in their bins; the shortest is the
    longest that still has room, so that rounding wastes little.
    """
    lengths: list[int] = []
    for b in pattern[:-1]:
        while stock[b] and not left[stock[b][0]]:
            stock[b].pop(0)
        choice = next((x for x in stock[b] if left[x] > lengths.count(x)), None)
        if choice is None:
            return None
        lengths.append(choice)
    room = size - sum(lengths)
    last = next((x for x in range(room, 0, -1) if left[x] > lengths.count(x)), None)
    return None if last is None else tuple(sorted((*lengths, last), reverse=True))


def _patterns(present: list[int], bins: int) -> list[tuple[int, ...]]:
    """Sets of up to a few of the ``present`` bins that fill a sequence exactly."""
    there, found = set(present), []

    def extend(pattern, most, room):
        if room == 0:
            found.append(pattern)
        elif len(pattern) + 1 == PATTERN_DOCUMENTS:
            if room <= most and room in there:
                found.append((*pattern, room))
        else:
            for b in present:
                if b <= min(most, room):
                    extend((*pattern, b), b, room - b)

    extend((), bins, bins)
    return found


def nnls(matrix: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Least squares under non-negative coefficients, by active sets."""
    gram, goal = matrix.T @ matrix, matrix.T @ target
    x, active = np.zeros(matrix.shape[1]), []
    ridge = 1e-9 * float(np.trace(gram)) / max(1, len(gram))
    tolerance = 1e-6 * max(1.0, float(np.abs(goal).max(initial=0)))
    for _ in range(3 * matrix.shape[0]):
        slope = goal - gram @ x
        slope[active] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= tolerance:
            break
        active.append(best)
        while active:
            square = gram[np.ix_(active, active)] + ridge * np.eye(len(active))
            trial = np.linalg.solve(square, goal[active])
            if trial.min() > 0:
                x[:] = 0
                x[active] = trial
                break
            now = x[active]
            low = trial <= 0
            step = np.min(now[low] / (now[low] - trial[low] + 1e-300))
            now = now + step * (trial - now)
            x[:] = 0
            kept = [i for i, (v, t) in enumerate(zip(now, trial)) if v > 1e-12 or t > 0]
            x[[active[i] for i in kept]] = np.maximum(now[kept], 0)
            if len(kept) == len(active):
                kept = [i for i in kept if trial[i] > 0]
            active = [active[i] for i in kept]
    return x


def _best_fit(left: np.ndarray, kinds: list[tuple[tuple[int, ...], int]],
              size: int) -> list[tuple[tuple[int, ...], int]]:
    """Place what is left, longest first, each piece where it leaves the least room."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for lengths, n in kinds:
        room.setdefault(size - sum(lengths), []).append((lengths, n))
    for length in range(size, 0, -1):
        n = int(left[length])
        while n:
            fit = next((r for r in range(length, size) if room.get(r)), None)
            if fit is None:
                each = min(size // length, n)
                lengths, run = (length,) * each, n // each
                n -= run * each
                room.setdefault(size - each * length, []).append((lengths, run))
                continue
            lengths, there = room[fit].pop()
            each = min(fit // length, n)
            run = min(there, n // each)
            if there > run:
                room[fit].append((lengths, there - run))
            room.setdefault(fit - each * length, []).append((lengths + (length,) * each, run))
            n -= run * each
    return [kind for same in room.values() for kind in same]

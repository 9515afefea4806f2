"""Hard-negative mining by a GNAT-style multiway tree with exact leaves.

Every vector gets one more component that brings all to the same length, so that an
inner product with an anchor is a distance and a window of scores a ring around the
anchor. Each node of the tree has up to ``FANOUT`` split points; a vector goes to the
nearest. A node keeps, for each split point and each sibling's subtree, the least and
the greatest distance between them; a subtree whose range misses a ring, as seen from
any split point, is passed over. The tree is fitted on a bounded sample, its ranges are
of all rows, and what it cannot rule out is compared in whole numbers.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemap.llm.shared import ship_code
from tastemap.sources.durable import durable

# Rows and bytes of the sample that the tree is fitted on.
SAMPLE_ROWS, SAMPLE_BYTES = 8192, 64 << 20
# Split points of a node, and sampled rows that are not split further.
FANOUT, LEAF = 16, 32
# Rows of a block, the unit that anchors are sent to: several leaves, or a part of one.
BLOCK = 8192
# Anchors routed or compared at once.
CHUNK = 128
# Scores must stay below this to be exact in double precision, with room for a factor of 100.
MOST = 1 << 50
# Distances are compared with this much slack, as a share of the common length.
SLACK = 1e-6
ANY = 1 << 60

ROW = "id long, label long, anchor boolean, dim int, vector binary, norm long, top double"
FOUND = "node long, id long, window int, other long, score long"


@dataclass
class Node:
    """Split points, lengthened; the child of each, a node's or (negative) a leaf's number."""

    points: np.ndarray
    children: list[int]
    least: np.ndarray = field(default=None)
    most: np.ndarray = field(default=None)


@dataclass
class Tree:
    """Nodes, the root first (none if all is one leaf), and what the leaves hold."""

    dim: int
    length: int
    nodes: list[Node]
    leaves: int
    blocks: list[tuple[int, int]] = field(default_factory=list)
    labels: list[tuple[int, int, int]] = field(default_factory=list)


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers in the narrowest form that holds them."""
    top = np.abs(values).max(initial=0)
    return values.astype("<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<f8").tobytes()


def _unpack(packed: list[bytes], dims: list[int], dim: int) -> np.ndarray:
    """Vectors as doubles, shorter ones filled with zeros."""
    found = np.zeros((len(packed), dim))
    forms: dict[tuple[int, int], list[int]] = {}
    for i, (raw, n) in enumerate(zip(packed, dims)):
        forms.setdefault((n, len(raw)), []).append(i)
    for (n, size), at in forms.items():
        if n:
            kind = {2: "<i2", 4: "<i4", 8: "<f8"}[size // n]
            found[at, :n] = np.frombuffer(b"".join(packed[i] for i in at), kind).reshape(-1, n)
    return found


def _rows(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """Rows that take part, their components scaled and rounded down."""
    for batch in batches:
        ids, labels = batch.column("id"), batch.column("label")
        vectors = batch.column("vector")
        known = zip(ids.to_pylist(), labels.to_pylist(), batch.column("anchor").to_pylist(),
                    vectors.is_valid().to_pylist())
        starts = vectors.offsets.to_numpy()
        with np.errstate(over="ignore", invalid="ignore"):
            # A null component reads as one that is no number.
            values = np.floor(scale * vectors.values.to_numpy(zero_copy_only=False))
        kept = [[] for _ in range(7)]
        for i, (row_id, label, anchor, valid) in enumerate(known):
            row = values[starts[i]:starts[i + 1]]
            if row_id is None or label is None or not valid or not np.isfinite(row).all():
                continue
            norm = row @ row
            for column, value in zip(kept, (row_id, label, anchor, len(row), _pack(row),
                                            int(min(norm, MOST)), np.abs(row).max(initial=0))):
                column.append(value)
        types = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.int64(),
                 pa.float64())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(kept, types)],
                              ["id", "label", "anchor", "dim", "vector", "norm", "top"])


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95, scale: float = 256, id_col: str = "vec_id",
                   label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components are ``floor(scale * x)``; a row's score is its inner product with the
    anchor. The anchors are the rows for which ``anchor`` is true. The positives of an anchor
    are the first ``positives`` other rows of its label, higher scores first, then smaller
    ids; for each, the first ``negatives`` rows of another label follow whose score is from
    ``low`` to ``high`` percent of the positive's. Exact: no row is left out by the tree
    that could be one of them.

    Rows with a null id, label or vector, or a component that is null or, scaled, not
    finite, take no part. Shorter vectors count as filled with zeros. Repeated rows are
    rows of their own, and each other's positives. Scores of 2^50 or more are refused
    with an error. A negative positive score has no window; an empty table gives no rows.
    """
    spark = rows.sparkSession
    ship_code(spark)
    plain = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                        F.col(f"`{label_col}`").cast("long").alias("label"),
                        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
                        F.coalesce(anchor, F.lit(False)).alias("anchor"))
    usable = plain.mapInArrow(lambda batches: _rows(batches, scale), ROW)
    usable = durable(usable.withColumn("node", F.monotonically_increasing_id()))
    sizes = usable.agg(F.max("dim").alias("dim"), F.max("norm").alias("norm"),
                       F.max("top").alias("top")).first()
    dim, length = sizes.dim or 0, sizes.norm or 0
    if dim * (sizes.top or 0) ** 2 >= MOST:
        raise ValueError("scores of 2^50 or more cannot be compared exactly")
    tree, placed = _index(usable, dim, length)
    shared = spark.sparkContext.broadcast(tree)

    asked = placed.where("anchor").select(
        "node", "id", "label", "dim", "vector", "leaf",
        F.array(F.lit(-ANY).cast("long")).alias("low"),
        F.array(F.lit(ANY).cast("long")).alias("high"))
    best = durable(_search(asked, placed, shared, positives, same=True))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "other"))
    # In whole numbers; below zero the window is empty.
    rings = durable(best.where("score >= 0").withColumn("place", place - 1).withColumns({
        "low": F.expr(f"({low} * score + 99) div 100"),
        "high": F.expr(f"({high} * score) div 100")}).where("low <= high"))
    windows = rings.withColumn("window", F.row_number().over(
        Window.partitionBy("node").orderBy("place")) - 1)
    windows = durable(windows.select("node", "window", F.col("other").alias("positive_id"),
                                     F.col("score").alias("positive_score"), "low", "high"))
    arrays = windows.groupBy("node").agg(F.array_sort(F.collect_list(
        F.struct("window", "low", "high"))).alias("w"))
    asked = (asked.drop("low", "high").join(arrays, "node")
             .select("node", "id", "label", "dim", "vector", "leaf", F.col("w.low").alias("low"),
                     F.col("w.high").alias("high")))
    found = _search(durable(asked), placed, shared, negatives, same=False)
    order = Window.partitionBy("node", "window").orderBy(F.desc("score"), "other")
    return (found.withColumn("rank", F.row_number().over(order))
            .join(windows.drop("low", "high"), ["node", "window"])
            .select(F.col("id").alias("anchor_id"), "positive_id", "rank",
                    F.col("other").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


# The tree

def _longer(vectors: np.ndarray, length: int) -> np.ndarray:
    """Vectors with the component that gives each the squared ``length``."""
    rest = np.sqrt(np.maximum(0, length - (vectors * vectors).sum(axis=1)))
    return np.column_stack([vectors, rest])


def _index(usable: DataFrame, dim: int, length: int) -> tuple[Tree, DataFrame]:
    """The tree with the ranges of all rows, and the rows with their leaf and block."""
    most = min(SAMPLE_ROWS, max(FANOUT, SAMPLE_BYTES // (8 * dim + 8)))
    sample = (usable.select("dim", "vector").orderBy(F.xxhash64("node")).limit(most).collect())
    vectors = _unpack([bytes(r.vector) for r in sample], [r.dim for r in sample], dim)
    tree = build(_longer(np.unique(vectors, axis=0), length), dim, length)
    context = usable.sparkSession.sparkContext
    bare = context.broadcast(tree)
    fields = "node long, id long, label long, dim int, vector binary, anchor boolean, leaf int"
    rows = durable(usable.select("node", "id", "label", "dim", "vector", "anchor")
                   .mapInArrow(lambda batches: _leaves(batches, bare), fields))
    ranges = (rows.select("dim", "vector")
              .mapInArrow(lambda batches: _ranges(batches, bare),
                          "at int, i int, j int, least double, most double")
              .groupBy("at", "i", "j").agg(F.min("least").alias("least"), F.max("most").alias("most")))
    for r in ranges.collect():
        tree.nodes[r.at].least[r.i, r.j], tree.nodes[r.at].most[r.i, r.j] = r.least, r.most
    bit = F.expr("shiftleft(1L, CAST(pmod(label, 64) AS INT))")
    held = {r.leaf: r for r in rows.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"), F.min("label").alias("first"), F.max("label").alias("last"),
        F.bit_or(bit).alias("mask")).collect()}
    block, size = -1, BLOCK
    for leaf in range(tree.leaves):
        r = held.get(leaf)
        n = r.n if r else 0
        # Small leaves share a block with their neighbours, a large one has several.
        if size + n > BLOCK:
            block, size = block + 1, 0
        parts = max(1, -(-n // BLOCK))
        tree.blocks.append((block, parts))
        tree.labels.append((r.first, r.last, r.mask) if r else (1, 0, 0))
        block, size = block + parts - 1, size + n
    # One row a leaf; the tree's sample bounds their number.
    layout = F.broadcast(usable.sparkSession.createDataFrame(
        [(leaf, *at) for leaf, at in enumerate(tree.blocks)], "leaf int, first int, parts int"))
    block = F.col("first") + F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    return tree, rows.join(layout, "leaf").withColumn("block", block).drop("first", "parts")


def build(sample: np.ndarray, dim: int, length: int) -> Tree:
    """A tree over distinct sampled vectors, lengthened; its ranges are still empty."""
    tree = Tree(dim, length, [], 0)
    _split(tree, sample[np.random.default_rng(50).permutation(len(sample))])
    tree.leaves = max(1, tree.leaves)
    return tree


def _split(tree: Tree, sample: np.ndarray) -> int:
    """Number of a new node, or ``-1 - number`` of a new leaf."""
    if len(sample) <= LEAF:
        tree.leaves += 1
        return -tree.leaves
    # Greedy: each next split point is the candidate farthest from those chosen.
    candidates = sample[:3 * FANOUT]
    closest, chosen = np.full(len(candidates), np.inf), [0]
    while len(chosen) < FANOUT:
        away = candidates - candidates[chosen[-1]]
        closest = np.minimum(closest, (away * away).sum(axis=1))
        chosen.append(int(closest.argmax()))
    points = candidates[chosen]
    number = len(tree.nodes)
    tree.nodes.append(Node(points, []))
    side = (sample @ points.T).argmax(axis=1)
    for j in range(FANOUT):
        part = sample[side == j]
        if len(part) == len(sample):  # not to be told apart by these points
            tree.leaves += 1
            tree.nodes[number].children.append(-tree.leaves)
        else:
            tree.nodes[number].children.append(_split(tree, part))
    tree.nodes[number].least = np.full((FANOUT, FANOUT), np.inf)
    tree.nodes[number].most = np.full((FANOUT, FANOUT), -np.inf)
    return number


def _descend(tree: Tree, vectors: np.ndarray, seen=None) -> np.ndarray:
    """The leaf of each lengthened vector; ``seen`` is told each node's products and sides."""
    leaf = np.zeros(len(vectors), np.int32)
    open_nodes = [(0, np.arange(len(vectors)))] if tree.nodes and len(vectors) else []
    while open_nodes:
        at, rows = open_nodes.pop()
        products = vectors[rows] @ tree.nodes[at].points.T
        side = products.argmax(axis=1)
        if seen:
            seen(at, products, side)
        for j in np.unique(side):
            child = tree.nodes[at].children[j]
            if child < 0:
                leaf[rows[side == j]] = -1 - child
            else:
                open_nodes.append((child, rows[side == j]))
    return leaf


def _lengthened(batch: pa.RecordBatch, tree: Tree) -> np.ndarray:
    return _longer(_unpack(batch.column("vector").to_pylist(), batch.column("dim").to_pylist(),
                           tree.dim), tree.length)


def _leaves(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    tree = shared.value
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            some = batch.slice(at, 4096)
            yield some.append_column("leaf", pa.array(_descend(tree, _lengthened(some, tree))))


def _ranges(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    """Least and greatest distance of each split point to the rows of each sibling."""
    tree = shared.value
    least = np.full((len(tree.nodes), FANOUT, FANOUT), np.inf)
    most = -least

    def seen(at, products, side):
        away = np.sqrt(np.maximum(0, 2 * (tree.length - products)))
        for j in np.unique(side):
            part = away[side == j]
            least[at, :, j] = np.minimum(least[at, :, j], part.min(axis=0))
            most[at, :, j] = np.maximum(most[at, :, j], part.max(axis=0))

    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            _descend(tree, _lengthened(batch.slice(at, 4096), tree), seen)
    at, i, j = np.nonzero(np.isfinite(least))
    yield pa.record_batch([pa.array(x, pa.int32()) for x in (at, i, j)]
                          + [pa.array(least[at, i, j]), pa.array(most[at, i, j])],
                          ["at", "i", "j", "least", "most"])


# The search

def _search(asked: DataFrame, placed: DataFrame, shared: Broadcast, k: int,
            same: bool) -> DataFrame:
    """The first ``k`` rows of each anchor's windows, as ``FOUND``.

    The anchor's own leaf comes first; what it yields narrows the windows from below for
    the search of all other leaves.
    """
    home = durable(_first(_scan(asked, placed, shared, k, same, home=True), k))
    full = home.groupBy("node", "window").agg(F.count(F.lit(1)).alias("n"),
                                              F.min("score").alias("score")).where(F.col("n") >= k)
    bounds = full.groupBy("node").agg(
        F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("bounds"))
    narrowed = asked.join(bounds, "node", "left").withColumn("low", F.transform(
        "low", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("bounds", i), x))))
    others = _scan(narrowed.drop("bounds"), placed, shared, k, same, home=False)
    return _first(home.unionByName(others), k)


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("node", "window").orderBy(F.desc("score"), "other")
    return (found.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k)
            .drop("_place"))


def _scan(asked: DataFrame, placed: DataFrame, shared: Broadcast, k: int, same: bool,
          home: bool) -> DataFrame:
    """Best rows of each block that an anchor is sent to."""
    fields = ("block int, kind int, leaf int, leaves array<int>, node long, id long, label long, "
              "dim int, vector binary, low array<long>, high array<long>")
    visits = asked.mapInArrow(lambda batches: _visits(batches, shared, same, home), fields)
    none = F.lit(None)
    rows = placed.select("block", F.lit(0).alias("kind"), "leaf", none.cast("array<int>").alias("leaves"),
                         "node", "id", "label", "dim", "vector", none.cast("array<long>").alias("low"),
                         none.cast("array<long>").alias("high"))
    met = (rows.unionByName(visits).repartition("block").sortWithinPartitions("block", "kind"))
    dim = shared.value.dim
    return met.mapInArrow(lambda batches: _compare(batches, dim, k, same), FOUND)


def _visits(batches: Iterator[pa.RecordBatch], shared: Broadcast, same: bool,
            home: bool) -> Iterator[pa.RecordBatch]:
    """A row for each anchor and block that it is sent to, with the leaves not ruled out."""
    tree = shared.value
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            some = batch.slice(at, CHUNK)
            own = some.column("leaf").to_pylist()
            if home:
                wanted = [[leaf] for leaf in own]
            else:
                wanted = [[x for x in leaves if x != leaf] for leaves, leaf in
                          zip(_not_ruled_out(tree, some, same), own)]
            rows, blocks, leaves = [], [], []
            for row, mine in enumerate(wanted):
                sent: dict[int, list[int]] = {}
                for leaf in mine:
                    first, parts = tree.blocks[leaf]
                    for block in range(first, first + parts):
                        sent.setdefault(block, []).append(leaf)
                rows += [row] * len(sent)
                blocks += sent
                leaves += sent.values()
            out = some.take(pa.array(rows, pa.int64()))
            n = len(rows)
            yield pa.record_batch(
                [pa.array(blocks, pa.int32()), pa.array([1] * n, pa.int32()),
                 pa.nulls(n, pa.int32()), pa.array(leaves, pa.list_(pa.int32())),
                 *(out.column(c) for c in ("node", "id", "label", "dim", "vector", "low", "high"))],
                ["block", "kind", "leaf", "leaves", "node", "id", "label", "dim", "vector", "low",
                 "high"])


def _windows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of each anchor's windows; those it has less than others are empty."""
    low, high = (batch.column(c).to_pylist() for c in ("low", "high"))
    width = max(map(len, low), default=0)
    return (np.array([x + [ANY] * (width - len(x)) for x in low], np.int64).reshape(-1, width),
            np.array([x + [-ANY] * (width - len(x)) for x in high], np.int64).reshape(-1, width))


def _not_ruled_out(tree: Tree, batch: pa.RecordBatch, same: bool) -> list[list[int]]:
    """Leaves that may hold a row in one of an anchor's windows."""
    vectors = _unpack(batch.column("vector").to_pylist(), batch.column("dim").to_pylist(), tree.dim)
    low, high = _windows(batch)
    norm = (vectors * vectors).sum(axis=1)[:, None]
    # The window of scores as a ring; the anchor itself is not lengthened.
    near, far = (np.sqrt(np.maximum(0, norm + tree.length - 2.0 * x)) for x in (high, low))
    slack = SLACK * np.sqrt(max(1, tree.length))
    found: list[list[int]] = [[] for _ in range(batch.num_rows)]
    labels = batch.column("label").to_pylist()
    open_nodes = [(0 if tree.nodes else -1, np.arange(batch.num_rows), low <= high)]
    while open_nodes:
        at, rows, alive = open_nodes.pop()
        if at < 0:
            first, last, mask = tree.labels[-1 - at]
            for row in rows.tolist():
                label = labels[row]
                holds = first <= label <= last and mask >> label % 64 & 1
                if holds if same else not first == last == label and first <= last:
                    found[row].append(-1 - at)
            continue
        node = tree.nodes[at]
        away = np.sqrt(np.maximum(0, norm[rows] + tree.length
                                  - 2 * (vectors[rows] @ node.points[:, :-1].T)))[:, None, :]
        r1, r2 = near[rows][:, :, None], far[rows][:, :, None]
        reach = np.maximum(away - r2, r1 - away) - slack
        beyond = away + r2 + slack
        for j, child in enumerate(node.children):
            meets = alive & ((node.most[:, j] >= reach) & (node.least[:, j] <= beyond)).all(axis=2)
            some = meets.any(axis=1)
            if some.any():
                open_nodes.append((child, rows[some], meets[some]))
    return found


def _compare(batches: Iterator[pa.RecordBatch], dim: int, k: int,
             same: bool) -> Iterator[pa.RecordBatch]:
    """Anchors against the block that came before them, leaf by leaf."""
    number, parts, block = None, [], None
    for batch in batches:
        blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
        edges = np.flatnonzero(np.r_[True, (blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])])
        for first, last in zip(edges, np.r_[edges[1:], len(blocks)]):
            some = batch.slice(first, last - first)
            if blocks[first] != number:
                number, parts, block = blocks[first], [], None
            if kinds[first] == 0:
                parts.append(some.select(["leaf", "node", "id", "label", "dim", "vector"]))
                continue
            if block is None:
                block, parts = _Block(pa.Table.from_batches(parts), dim) if parts else None, []
            if block is not None:
                for at in range(0, some.num_rows, CHUNK):
                    yield from block.best(some.slice(at, CHUNK), k, same)


class _Block:
    """Rows of a block by leaf."""

    def __init__(self, table: pa.Table, dim: int):
        self.dim = dim
        leaf = table.column("leaf").to_numpy()
        order = np.argsort(leaf, kind="stable")
        leaf = leaf[order]
        self.node, self.id, self.label = (table.column(c).to_numpy()[order]
                                          for c in ("node", "id", "label"))
        self.vectors = _unpack(table.column("vector").to_pylist(),
                               table.column("dim").to_pylist(), dim)[order]
        starts = np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1]])
        self.leaves = {int(leaf[a]): slice(a, b) for a, b in zip(starts, np.r_[starts[1:], len(leaf)])}

    def best(self, anchors: pa.RecordBatch, k: int, same: bool) -> Iterator[pa.RecordBatch]:
        low, high = _windows(anchors)
        node, ids, label = (anchors.column(c).to_numpy() for c in ("node", "id", "label"))
        vectors = _unpack(anchors.column("vector").to_pylist(), anchors.column("dim").to_pylist(),
                          self.dim)
        visitors: dict[int, list[int]] = {}
        for row, leaves in enumerate(anchors.column("leaves").to_pylist()):
            for leaf in leaves:
                visitors.setdefault(leaf, []).append(row)
        found = []
        for leaf, rows in visitors.items():
            if (part := self.leaves.get(leaf)) is None:
                continue
            rows = np.array(rows)
            scores = (vectors[rows] @ self.vectors[part].T).astype(np.int64)
            fits = (self.label[part] == label[rows, None]) == same
            if same:
                fits &= self.node[part] != node[rows, None]
            for window in range(low.shape[1]):
                inside = fits & (scores >= low[rows, window, None]) & (scores <= high[rows, window, None])
                if not inside.any():
                    continue
                masked = np.where(inside, scores, -ANY)
                if masked.shape[1] > k:
                    # Ties with the last one are told apart by id below.
                    inside &= masked >= np.partition(masked, -k, axis=1)[:, -k, None]
                i, j = np.nonzero(inside)
                found.append((rows[i], np.full(len(i), window), self.id[part][j], scores[i, j]))
        if not found:
            return
        row, window, other, score = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((other, -score, window, row))
        row, window, other, score = (x[order] for x in (row, window, other, score))
        starts = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (window[1:] != window[:-1])])
        place = np.arange(len(row)) - np.repeat(starts, np.diff(np.r_[starts, len(row)]))
        first = place < k
        row = row[first]
        yield pa.record_batch([pa.array(node[row]), pa.array(ids[row]),
                               pa.array(window[first], pa.int32()), pa.array(other[first]),
                               pa.array(score[first])], ["node", "id", "window", "other", "score"])

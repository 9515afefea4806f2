"""Fingerprints and the Gray-order index."""

import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from tastemap.llm import simhash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, max_bits):
    """The place of the first value reachable from each, by comparing all."""
    head = list(range(len(values)))

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= max_bits:
                head[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("text", [
    None, "", "  \n", "one", "A b", "a B c", "a b c d", "a b c d e", "Éa É É É É", "x\x1cy z w v",
    "w " * 70_000, "ab " * 3 + "cd " * 5, "日本 語\x0bt u v"])
def test_fingerprint(text):
    assert simhash.fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


def noisy(count, seed, spread):
    """Clusters of 64-bit values whose members differ in a few bits."""
    random.seed(seed)
    found = set()
    while len(found) < count:
        center = random.getrandbits(64)
        for _ in range(random.choice([1, 1, 3, 40])):
            value = center
            for _ in range(random.randint(0, spread)):
                value ^= 1 << random.randrange(64)
            found.add(value)
    return sorted(found)[:count]


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("seed,spread", [(1, 4), (2, 5), (3, 3)])
def test_links_connect_what_brute_force_connects(spark, many_slices, seed, spread):
    values = noisy(400, seed, spread)
    rows = spark.createDataFrame([(signed(v),) for v in values], "bits long")
    edges = [(r.a, r.b) for r in simhash.links(rows, 4).collect()]
    place = {signed(v): i for i, v in enumerate(values)}
    for a, b in edges:
        assert a != b and {a, b} <= place.keys()
    head = list(range(len(values)))
    for a, b in edges:
        one, two = place[a], place[b]
        while head[one] != one:
            one = head[one]
        while head[two] != two:
            two = head[two]
        head[max(one, two)] = min(one, two)

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    assert [find(i) for i in range(len(values))] == groups(values, 4)


@pytest.mark.parametrize("tile,short", [(8, 4), (16, 0), (32, 48)])
def test_runs_cut_into_tiles(monkeypatch, tile, short):
    """The index of one sorted partition, and the pairs of its tiles, without a session."""
    import pyarrow as pa
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "SHORT", short)
    monkeypatch.setattr(simhash, "FANOUT", 4)
    monkeypatch.setattr(simhash.TaskContext, "get", staticmethod(
        lambda: type("Task", (), {"partitionId": staticmethod(lambda: 3)})))
    values = noisy(150, 7, 4)
    batch = pa.record_batch([pa.array([signed(v) for v in values], pa.int64())], ["bits"])
    keyed = pa.Table.from_batches(simhash._orders(iter([batch]), simhash.block_edges(6)))
    keyed = keyed.sort_by([("node", "ascending"), ("rank", "ascending")])
    found = pa.Table.from_batches(simhash._index(iter(keyed.to_batches(max_chunksize=11)), 4))
    edges, tiles = [], {}
    for row in found.to_pylist():
        if row["tile"] is None:
            edges.append((row["a"], row["b"]))
        else:
            tiles.setdefault((row["node"], row["tile"]), []).append(row["a"])
    assert all(len(members) <= tile for members in tiles.values())
    by_node = {}
    for (node, name), members in sorted(tiles.items()):
        for other, theirs in by_node.get(node, []):
            pair = [(other, name, other, b) for b in theirs] + [(other, name, name, b)
                                                               for b in members]
            table = pa.table(list(zip(*pair)), ["tile_a", "tile_b", "tile", "bits"])
            for got in simhash._compare_tiles(iter(table.to_batches(max_chunksize=5)), 4):
                edges += [(r["a"], r["b"]) for r in got.to_pylist()]
        by_node.setdefault(node, []).append((name, members))
    head = list(range(len(values)))

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    place = {signed(v): i for i, v in enumerate(values)}
    for a, b in edges:
        head[max(find(place[a]), find(place[b]))] = min(find(place[a]), find(place[b]))
    assert [find(i) for i in range(len(values))] == groups(values, 4)


def expected_classes(rows):
    values = [plain_fingerprint(r.text) for r in rows]
    heads = groups(values, 4)
    least = {}
    for head, row in zip(heads, rows):
        if row.doc_id is not None:
            least[head] = min(row.doc_id, least.get(head, row.doc_id))
    found = sorted((str(r.doc_id), f"{v:016x}", str(least.get(h)))
                   for r, v, h in zip(rows, values, heads))
    return found, sorted(str(least.get(h)) for h in set(heads))


def test_documents_against_brute_force(documents):
    got = simhash.near_duplicates(documents).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) \
        == expected_classes(documents.collect())[0]


def test_awkward_rows(awkward, no_rows):
    got = simhash.near_duplicates(awkward).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) \
        == expected_classes(awkward.collect())[0]
    assert simhash.near_duplicates(no_rows).count() == 0
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    _, classes = expected_classes(awkward.collect())
    assert sorted(str(r.doc_id) for r in kept.collect()) == classes
    assert simhash.keep_one(no_rows).count() == 0


def test_gray_rank_orders_neighbours_one_bit_apart():
    bits = np.arange(256, dtype=np.uint64)
    order = bits[np.argsort(simhash._gray_rank(bits))]
    assert (np.bitwise_count(order[1:] ^ order[:-1]) == 1).all()

"""Virtual slots, their map and its rebalancing."""

import random
from zlib import crc32

import pytest

from tastemap.llm import slots


def loads(slot_map, sizes):
    found = [0] * slot_map.shards
    for shard, size in zip(slot_map.of_slot, sizes):
        found[shard] += size
    return found


@pytest.mark.parametrize("seed", range(5))
def test_rebalancing_evens_out_bytes(seed):
    random.seed(seed)
    sizes = [int(random.lognormvariate(6, 1)) for _ in range(512)]
    before = slots.first_map(8, 512)
    after = slots.rebalance(before, sizes)
    assert (before.version, after.version) == (0, 1)
    assert max(loads(after, sizes)) - min(loads(after, sizes)) <= 0.001 * sum(sizes)
    # Only slots of shards that were too full have moved.
    share = sum(sizes) / 8
    moved = sum(s for a, b, s in zip(before.of_slot, after.of_slot, sizes) if a != b)
    assert moved <= 2 * sum(max(0, x - share) for x in loads(before, sizes)) + 2 * max(sizes)


def test_a_new_shard_is_filled_and_an_old_one_emptied():
    sizes = [10] * 64
    grown = slots.rebalance(slots.first_map(4, 64), sizes, 5)
    assert max(loads(grown, sizes)) - min(loads(grown, sizes)) <= 10
    moved = [b for a, b in zip(slots.first_map(4, 64).of_slot, grown.of_slot) if a != b]
    assert set(moved) == {4}
    shrunk = slots.rebalance(grown, sizes, 3)
    assert set(shrunk.of_slot) == {0, 1, 2}


def test_empty_slots_and_one_heavy_one():
    sizes = [0] * 63 + [100]
    after = slots.rebalance(slots.first_map(8, 64), sizes)
    assert sorted(loads(after, sizes))[-2:] == [0, 100]


def test_map_versions_are_kept(spark, tmp_path):
    folder = f"{tmp_path}/map"
    first = slots.first_map(8, 64)
    second = slots.rebalance(first, list(range(64)))
    for version in (first, second):
        slots.save_map(spark, version, folder)
    assert slots.load_map(spark, folder) == second
    assert slots.load_map(spark, folder, 0) == first
    with pytest.raises(Exception, match="(?i)exists"):
        slots.save_map(spark, second, folder)


def check(placed, rows, shards):
    expected = sorted((r.doc_id is not None, r.doc_id or 0, len((r.text or "").encode()) + 1,
                       crc32((r.text or "").encode())) for r in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32)
                  for r in placed) == expected
    for shard in range(shards):
        places = sorted(r.slot for r in placed if r.shard == shard)
        assert places == list(range(len(places)))
    return [sum(r["size"] for r in placed if r.shard == s) for s in range(shards)]


def test_documents_in_shards(documents):
    placed = slots.shard_documents(documents, 8).collect()
    found = check(placed, documents.collect(), 8)
    assert max(found) - min(found) <= 0.01 * sum(found)
    again = slots.shard_documents(documents, 8).collect()
    assert {(r.doc_id, r.shard) for r in placed} == {(r.doc_id, r.shard) for r in again}


def test_awkward_rows(awkward, no_rows):
    check(slots.shard_documents(awkward, 3).collect(), awkward.collect(), 3)
    assert slots.shard_documents(no_rows, 3).count() == 0


def test_a_text_of_most_rows_is_spread(spark):
    rows = [(i, "the same text") for i in range(900)] + [(i, f"other {i}") for i in range(900, 1200)]
    placed = slots.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"),
                                   8).collect()
    sizes = [sum(r["size"] for r in placed if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 0.02 * sum(sizes)

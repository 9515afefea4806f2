"""Fuzzy line deduplication."""

import random
import sys

import numpy as np
import pyarrow as pa
import pytest

from tastemap.llm import lines


def expected_removed(rows):
    """Numbers of the lines that go, row by row, by comparing all lines with all."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0,
                                                    lines.row_key(rows[i][0], None if rows[i][1] is None
                                                                  else rows[i][1].encode())))
    kept, removed = [], [[] for _ in rows]
    texts = {}
    for i in order:
        for number, line in enumerate(lines.normal_lines((rows[i][1] or "").encode())):
            if line:
                texts.setdefault(line.decode(), []).append((i, number))
    names = list(texts)
    sets = [lines.shingles(t) for t in names]
    head = list(range(len(names)))

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    for a in range(len(names)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
                head[max(find(a), find(b))] = min(find(a), find(b))
    seen = set()
    for i in order:
        for number, line in enumerate(lines.normal_lines((rows[i][1] or "").encode())):
            if line:
                component = find(names.index(line.decode()))
                if component in seen:
                    removed[i].append(number)
                seen.add(component)
    return removed


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = lines.duplicate_lines(docs).collect()
    assert sorted((str(r.doc_id), r.removed) for r in found) \
        == sorted((str(row[0]), gone) for row, gone in zip(rows, expected_removed(rows)))
    kept = sorted(((str(r.doc_id), str(r.text)) for r in lines.keep_first_lines(docs).collect()))
    expected = []
    for (doc_id, text), gone in zip(rows, expected_removed(rows)):
        there = [line for line in (text or "").split("\n")]
        words = sum(1 for line in there if line.encode().split())
        if not gone or len(gone) < words:
            left = [line for i, line in enumerate(there) if i not in gone]
            expected.append((str(doc_id), "\n".join(left) if text is not None else "None"))
    assert kept == sorted(expected)


def near_copy(line, random):
    place = random.randrange(len(line) - 6)
    return line[:place] + "zzz" + line[place + 3:]


@pytest.mark.parametrize("seed", range(2))
def test_near_copies_chains_and_common_lines(spark, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(400)]
    base = [" ".join(rng.choices(words, k=rng.randint(12, 60))) for _ in range(25)]
    rows = []
    for doc in range(60):
        chosen = [rng.choice(base) for _ in range(rng.randint(0, 4))]
        chosen = [near_copy(line, rng) if rng.random() < 0.5 else line for line in chosen]
        if rng.random() < 0.7:
            chosen.append("A line that very many documents share")
        rows.append((doc, "\n".join([*chosen, " ".join(rng.choices(words, k=20)), ""])))
    check(spark, rows)


def test_a_chain_is_one_component(spark):
    line = "abcdefghijklmnopqrstuvwxyz" * 4
    rng = random.Random(1)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=150)).strip()
    chain = [text]
    for step in range(6):
        at = 20 * (step + 1)
        chain.append(chain[-1][:at] + "#" + chain[-1][at + 1:])
    check(spark, [(i, t) for i, t in enumerate(chain)] + [(100, line)])


def test_awkward_rows(spark, awkward, no_rows):
    check(spark, [(r.doc_id, r.text) for r in awkward.collect()])
    kept = lines.keep_first_lines(awkward)
    assert kept.columns == awkward.columns and kept.count() > 0
    assert lines.duplicate_lines(no_rows).count() == 0
    assert lines.keep_first_lines(no_rows).count() == 0


def bucket_links(rows, sizes=(1, 3, 100)):
    """Links of the rows of buckets, however they are cut into batches."""
    names = ["key", "one", "two", "tile", "node", "signature", "line"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.string()]
    whole = pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)
    found = []
    for size in sizes:
        cut = [whole.slice(i, size) for i in range(0, len(rows), size)]
        met = list(lines._meeting(iter(cut)))
        met = [pa.record_batch([*b.columns, pa.array(
            [rows[n][6] for n in b.column("node").to_pylist()], pa.string())], names) for b in met]
        found.append([tuple(r.values()) for b in lines._bucket_links(iter(met), lines.shingles)
                      for r in b.to_pylist()])
    assert all(f == found[0] for f in found)
    return found[0]


def connected(texts, tiles=None, key=0):
    signature = lines.signatures(texts)
    signature[:, :lines.ROWS] = 7  # all share the first band
    rows = [(key, 0, 0 if tiles is None else 1, 0 if tiles is None else tiles[i], i,
             signature[i].tobytes(), t) for i, t in enumerate(texts)]
    return bucket_links(rows)


def test_all_pairs_of_a_bucket_are_decided():
    rng = random.Random(3)
    one, two = ("".join(rng.choices("abcdefgh ", k=120)) for _ in range(2))
    texts = [one, near_copy(two, rng), two, near_copy(one, rng)]
    assert set(connected(texts)) == {(0, 3), (1, 2)}
    # Pairs of two tiles only, and nothing in a bucket that is not the pair's first.
    assert set(connected(texts, [0, 0, 0, 1])) == {(0, 3)}
    assert connected(texts, key=3 << 32) == []
    assert connected(texts[:1]) == connected([]) == []
    assert len(connected([one] * 5 + [two])) == 4


def test_every_pair_that_shares_a_band_is_verified():
    rng = random.Random(4)
    one, other = ("".join(rng.choices("abcdefgh ", k=120)) for _ in range(2))
    signature = np.zeros((3, lines.BANDS * lines.ROWS), np.uint8)
    signature[:, lines.ROWS:] = np.arange(1, 4)[:, None]  # nothing but the first band is equal
    rows = [(0, 0, 0, 0, i, signature[i].tobytes(), t)
            for i, t in enumerate([one, near_copy(one, rng), other])]
    assert bucket_links(rows) == [(0, 1)]


def test_many_buckets_at_once(monkeypatch):
    monkeypatch.setattr(lines, "GROUP_ROWS", 5)
    monkeypatch.setattr(lines, "HELD", 50)
    rng = random.Random(6)
    base = ["".join(rng.choices("abcdefgh ", k=90)) for _ in range(12)]
    rows = []
    for key in range(12):  # bucket k holds k + 1 lines; those of even k are near copies of one
        for n in range(key + 1):
            text = near_copy(base[key], rng) if key % 2 == 0 else base[n]
            signature = lines.signatures([text])
            signature[:, :lines.ROWS] = 7
            rows.append((key, 0, 0, 0, len(rows), signature[0].tobytes(), text))
    links = bucket_links(rows, (1, 7, 100))
    head = {r[4]: r[4] for r in rows}
    for a, b in links:
        old, new = head[b], head[a]
        assert old != new and rows[a][0] == rows[b][0]
        head = {n: new if h == old else h for n, h in head.items()}
    sets = [lines.shingles(r[6]) for r in rows]
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] == rows[b][0] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                assert head[a] == head[b]
    assert len(links) > 20


def test_a_large_bucket_takes_no_sets_for_each_pair(monkeypatch):
    rng = random.Random(7)
    texts = ["".join(rng.choices("abcdefghijklmnop ", k=rng.randint(250, 300))) for _ in range(48)]
    texts += [near_copy(line, rng) for line in texts[::4]]
    signature = lines.signatures(texts)
    signature[:, :lines.ROWS] = 7
    columns = [pa.array([0] * 60, pa.int64()), *(pa.array([0] * 60, pa.int32()) for _ in range(3)),
               pa.array(range(60), pa.int64()),
               pa.array([row.tobytes() for row in signature], pa.binary()), pa.array(texts)]
    rows = pa.record_batch(columns, ["key", "one", "two", "tile", "node", "signature", "line"])
    for held in (100, 2000, 1 << 19):  # less than a line, less than the bucket, more than that
        monkeypatch.setattr(lines, "HELD", held)
        made = []
        found = list(lines._bucket_links(iter([rows]), lambda line: made.append(line)
                                         or lines.shingles(line)))
        assert sorted(tuple(r.values()) for b in found for r in b.to_pylist()) \
            == [(4 * n, 48 + n) for n in range(12)]
        assert len(made) <= 60


def test_sets_decide_what_clashing_hashes_could_turn(monkeypatch):
    clash = lines._codes

    def codes(texts):
        found, sizes = clash(texts)
        found[found % np.uint64(50) == 0] = 0  # a fiftieth of all shingles are one to the hash
        return found, sizes

    rng = random.Random(8)
    one = "".join(rng.choices("abcdefgh ", k=120))
    texts = [one] + [one[:k] + "".join(rng.choices("ijklmnop", k=120 - k)) for k in range(92, 116)]
    monkeypatch.setattr(lines, "_codes", codes)
    linked = {max(pair) for text in range(1, 25) for pair in connected([one, texts[text]])
              for pair in [(text, 0)]}
    sets = [lines.shingles(text) for text in texts]
    assert linked == {n for n in range(1, 25)
                      if len(sets[0] & sets[n]) >= 0.8 * len(sets[0] | sets[n])}
    assert 0 < len(linked) < 24


def linked_by_sets(texts):
    sets = [lines.shingles(text) for text in texts]
    head = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i + 1, len(texts)):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                head = [head[i] if h == head[j] else h for h in head]
    return [[n for n, h in enumerate(head) if h == own] for own in head]


def linked(texts, links):
    head = list(range(len(texts)))
    for i, j in links:
        assert head[i] != head[j]
        head = [head[i] if h == head[j] else h for h in head]
    return [[n for n, h in enumerate(head) if h == own] for own in head]


def test_a_few_lines_of_latin_1_take_no_sets():
    rng = random.Random(10)
    one = "".join(rng.choices("abcdefgh \xe9\xff", k=120))
    texts = [one] + [one[:k] + "".join(rng.choices("ijklmnop", k=120 - k)) for k in range(96, 114)]
    signature = lines.signatures(texts)
    signature[:, :lines.ROWS] = 7
    n = len(texts)
    columns = [pa.array([0] * n, pa.int64()), *(pa.array([0] * n, pa.int32()) for _ in range(3)),
               pa.array(range(n), pa.int64()),
               pa.array([row.tobytes() for row in signature], pa.binary()), pa.array(texts)]
    rows = pa.record_batch(columns, ["key", "one", "two", "tile", "node", "signature", "line"])
    made = []
    found = list(lines._bucket_links(iter([rows]), lambda line: made.append(line)
                                     or lines.shingles(line)))
    links = [tuple(r.values()) for b in found for r in b.to_pylist()]
    assert linked(texts, links) == linked_by_sets(texts)
    assert 0 < len(links) < n - 1
    assert not made


@pytest.mark.parametrize("held", [40, 1 << 19])
@pytest.mark.parametrize("few", [0, 3, 24])
def test_any_characters_are_decided_in_small_and_large_groups(monkeypatch, few, held):
    monkeypatch.setattr(lines, "FEW", few)
    monkeypatch.setattr(lines, "HELD", held)
    rng = random.Random(11)
    for letters in ("abcdefgh ", "\u0430\u0431\u0432\u0433\u0434\u0435 ", "ab\u2014\xe9\U0001f600 "):
        one, two = ("".join(rng.choices(letters, k=90)) for _ in range(2))
        texts = [one, two, near_copy(one, rng), one[:80] + "\u0416" * 10, near_copy(two, rng),
                 one + "\u2014", "abc", "abc\0", "abc" + "\0" * 5, "abc" + "\0" * 6, "\u0430" * 3]
        assert linked(texts, connected(texts)) == linked_by_sets(texts)


@pytest.mark.parametrize("letters", ["\u0430\u0431\u0432\u0433\u0434\u0435\u0436 ", "abcdefgh "])
@pytest.mark.parametrize("few", [0, 24])
def test_clashing_hashes_turn_nothing(monkeypatch, letters, few):
    clash = lines._codes

    def codes(texts):
        found, sizes = clash(texts)
        found[found % np.uint64(50) == 0] = 0
        return found, sizes

    rng = random.Random(12)
    one = "".join(rng.choices(letters, k=120))
    texts = [one] + [one[:k] + "".join(rng.choices("ijklmnop", k=120 - k)) for k in range(92, 116)]
    monkeypatch.setattr(lines, "FEW", few)
    monkeypatch.setattr(lines, "_codes", codes)
    for text in texts[1:]:
        assert linked([one, text], connected([one, text])) == linked_by_sets([one, text])


def test_texts_are_found_by_their_places(spark):
    rows = [(1, "One line\n\n  The  OTHER \tline \nlast"), (1, "One line"), (2, None), (3, ""),
            (4, "\u00c9t\u00e9 \u2014 a line\nsecond"), (None, "no id"), (4, "x")]
    rows += [rows[0], rows[4]]
    texts = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "CAST(text AS BINARY) AS text")
    places = [(0, 2, 10), (0, 0, 11), (4, 1, 12), (4, 0, 13), (5, 0, 14), (1, 0, 15)]
    wanted = spark.createDataFrame(
        [(node, bytearray(lines.row_key(rows[row][0], rows[row][1].encode())), number)
         for row, number, node in places], "node long, doc binary, number int")
    found = lines._texts_of(texts, wanted).collect()
    assert sorted((r.node, r.line) for r in found) == [
        (10, "the other line"), (11, "one line"), (12, "second"), (13, "\u00c9t\u00e9 \u2014 a line"),
        (14, "no id"), (15, "one line")]


def test_lines_that_stand_once_and_several_times_go(spark):
    rng = random.Random(13)
    base = ["".join(rng.choices("abcdefgh ", k=120)).strip() for _ in range(4)]
    once = [near_copy(line, rng) for line in base]
    rows = [(5, "\n".join(base)), (7, "\n".join([once[0], base[1], "own"])), (None, once[2]),
            (6, "\n".join([base[3], once[3], base[3]])), (2, once[1]), (5, "\n".join(base))]
    check(spark, rows)


def test_only_keys_of_lines_go_through_python_for_the_filter(spark):
    made = spark.createDataFrame([(n, bytes([n % 5] * 64), n) for n in range(40)],
                                 "node long, signature binary, more long")
    plan = made.where(lines._possible(lines.F.xxhash64("node"), made.where("node < 3").select(
        lines.F.xxhash64("node").alias("key"))))
    assert {0, 1, 2} <= {r.node for r in plan.collect()} and plan.count() < 12
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in text and "MapInArrow" not in text


def test_keys_are_dealt_and_ordered(monkeypatch):
    monkeypatch.setattr(lines, "DEALT", 30)
    rng = random.Random(9)
    pairs = [(rng.randrange(-40, 40) << 30, n) for n in range(200)]
    batches = [pa.record_batch([pa.array(c, pa.int64()) for c in zip(*pairs[i:i + 7])],
                               ["key", "node"]) for i in range(0, 200, 7)]
    dealt = [tuple(r.values()) for b in lines._dealt(iter(batches), 5) for r in b.to_pylist()]
    assert {row[0] for row in dealt} == set(range(5)) and len(dealt) < 50
    rows = pa.record_batch([pa.array(c, t) for c, t in zip(
        zip(*sorted(dealt)), (pa.int32(), pa.binary(), pa.binary()))], ["part", "keys", "nodes"])
    parts = [b.to_pylist() for size in (1, 4, 50) for b in lines._in_order(
        rows.slice(i, size) for i in range(0, len(dealt), size))]
    assert len(parts) == 15
    for n in range(0, 15, 5):
        got = [tuple(r.values()) for part in parts[n:n + 5] for r in part]
        assert sorted(got) == sorted(pairs)
    for part in parts:
        keys = [r["key"] for r in part]
        assert keys == sorted(keys)
    assert list(lines._dealt(iter([]), 5)) == list(lines._in_order(iter([]))) == []


def test_large_buckets_are_cut_into_tiles(monkeypatch):
    monkeypatch.setattr(lines, "TILE", 3)
    keys = [1, 2, 2, 3, 4, 4, 4, 4, 4, 4, 4, 5, 6, 6]
    batch = pa.record_batch([pa.array(keys, pa.int64()), pa.array(range(14), pa.int64())],
                            ["key", "node"])
    for rows in (1, 2, 5, 14):
        parts = [batch.slice(i, rows) for i in range(0, 14, rows)]
        got = [tuple(r.values()) for p in lines._shared_buckets(iter(parts)) for r in p.to_pylist()]
        assert got == [(2, 0, 1), (2, 0, 2), *((4, i // 3, 4 + i) for i in range(7)),
                       (6, 0, 12), (6, 0, 13)]


def test_signatures_estimate_similarity():
    rng = random.Random(5)
    line = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=2000))
    other = line[:1800] + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=200))
    one, two = lines.shingles(line), lines.shingles(other)
    similarity = len(one & two) / len(one | two)
    assert similarity > 0.8
    agree = np.mean([np.mean(np.equal(*lines.signatures([line[i:], other[i:]])))
                     for i in range(0, 400, 8)])
    assert abs(agree - similarity) < 0.1


def test_signatures_do_not_depend_on_neighbours():
    texts = ["a", "", "short", "x" * 5000, "日本語 é", "a longer line of text, plainly"]
    together = lines.signatures(texts)
    for text, signature in zip(texts, together):
        assert (lines.signatures([text])[0] == signature).all()


def test_normal_lines_join_words_by_one_blank():
    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choices("aB \t\r\x0b\x0c\x1c\x85é \n", k=rng.randrange(30))).encode()
        assert lines.normal_lines(text) == [b" ".join(line.split())
                                            for line in text.lower().split(b"\n")]


def test_normal_lines_take_no_step_per_line():
    text, calls = b"Some words \t of a  line\n" * 1000, []
    sys.setprofile(lambda frame, event, what: calls.append(what) if event == "c_call" else None)
    try:
        found = lines.normal_lines(text)
    finally:
        sys.setprofile(None)
    assert found == [b"some words of a line"] * 1000 + [b""]
    assert len(calls) < 50

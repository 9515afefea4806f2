"""Removal of repeated strings against brute force, and the index against plain search."""

from hashlib import sha256

import numpy as np
import pytest

from tastemap.llm import queries, repeats

NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def expected(rows, length):
    """What stays of each ``(doc_id, text)``, by a table of all strings."""
    rows = [(i, (text or "").encode()) for i, text in rows]
    order = [float("inf") if i is None else i for i, _ in rows]
    first = {}
    for at, (_, text) in zip(order, rows):
        for s in range(len(text) - length + 1):
            string = text[s:s + length]
            first[string] = min(at, first.get(string, at))
    found = []
    for at, (i, text) in zip(order, rows):
        gone, seen = bytearray(len(text)), set()
        for s in range(len(text) - length + 1):
            string = text[s:s + length]
            if at > first[string] or string in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(string)
        kept = bytes(b for b, g in zip(text, gone) if not g)
        runs = sum(g and not before for g, before in zip(gone, b"\0" + gone))
        found.append((i, len(text), len(text) - len(kept), runs, sha256(kept).hexdigest()))
    return sorted(found, key=str)


def result(df, **options):
    return sorted(map(tuple, repeats.without_repeats(df, **options).select(*NAMES).collect()), key=str)


@pytest.fixture(scope="module")
def made():
    """Texts that share passages, hot ones at other places, repeats inside a text, copies."""
    rng = np.random.default_rng(5)

    def prose(n):
        return " ".join("".join(rng.choice(list("abcdeé"), rng.integers(2, 9))) for _ in range(n))

    passages = [prose(40) for _ in range(4)]
    hot = prose(30)
    rows = []
    for i in range(90):
        parts = [prose(int(rng.integers(1, 40))) for _ in range(3)]
        if i % 3:
            parts.insert(int(rng.integers(0, 3)), hot)
        if i % 4 == 0:
            parts.append(passages[i % 3])
        if i % 10 == 0:
            parts += [passages[3], passages[3]]
        rows.append((i * 7 % 101, " ".join(parts)))
    rows += [(200 + i, rows[i][1]) for i in range(9)] + [(300, rows[3][1][5:-3]), (301, "ab" * 400),
                                                         (302, "x" * 999), (303, "x" * 130)]
    return rows


@pytest.mark.parametrize("hot, chunk", [(4096, 1 << 19), (2, 1 << 19), (6, 3000)])
def test_as_by_brute_force(spark, monkeypatch, made, hot, chunk):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    df = spark.createDataFrame(made, "doc_id long, text string").repartition(5)
    assert result(df) == expected(made, 100)


def test_other_lengths(spark, made):
    df = spark.createDataFrame(made, "doc_id long, text string")
    for length in (40, 333):
        assert result(df, length=length) == expected(made, length)


def test_awkward_rows(spark, awkward, no_rows):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    assert result(awkward) == expected(rows, 100)
    assert repeats.without_repeats(no_rows).count() == 0


def test_query_as_by_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = queries.queries()["op11_run_length_index"](spark, "/root/testdata/sf0.001")
    assert found.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"),
                            ("n_spans", "bigint"), ("kept_sha256", "string")]
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows, 100)


def test_matching_statistics():
    """Places found are those where a string of the length is in the indexed texts."""
    rng = np.random.default_rng(6)
    texts = ["".join(rng.choice(list("ab"), rng.integers(1, 60))).encode() for _ in range(40)]
    asked = texts[:3] + ["".join(rng.choice(list("abc"), 80)).encode() for _ in range(20)] + [b"c"]
    index = repeats.RunIndex(texts)
    for length in (1, 5, 9):
        found = index.stream(asked, length)
        expected = {(i, p) for i, text in enumerate(asked) for p in range(len(text) - length + 1)
                    if any(text[p:p + length] in t for t in texts)}
        assert set(zip(found[0].tolist(), found[1].tolist())) == expected
        group = dict(zip(zip(*map(np.ndarray.tolist, found[:2])),
                         index.group(found[2], length).tolist()))
        for (i, p), number in group.items():
            string = asked[i][p:p + length]
            uses = sum(t.startswith(string, s) for t in texts for s in range(len(t)))
            assert (number >= 0) == (uses > 1)
            assert len({n for (j, q), n in group.items() if asked[j][q:q + length] == string}) == 1


def test_runs_are_few_in_repetitive_texts():
    rng = np.random.default_rng(7)
    base = bytes(rng.integers(97, 123, 500, dtype=np.uint8))
    copies = [base[:i] + b"!" + base[i:] for i in range(0, 500, 10)]
    assert repeats.RunIndex(copies).runs < 0.1 * sum(map(len, copies))


def test_spans_are_merged():
    assert repeats.merged([(5, 9), (0, 2), (2, 3), (8, 12), (20, 21)]) == [(0, 3), (5, 12), (20, 21)]

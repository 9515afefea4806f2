"""Quality rules by robust distances."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastemap.llm import outliers
from tastemap.sources.durable import durable


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, lines, same = set(), 0, 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += 1
            same += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), same,
            len(inside), lines)


@pytest.mark.parametrize("text", [
    None, "", " \n ", "### | ", "a", "a b c", "a b c a b c", "x x x x", "a a a", "A a b\na b A\nA a b\n A a b",
    "é é\x0bé é é", "l\nl\n l\nl", "a b c d " * 9 + "e", "日本 語 日本 語 日本", "p\x1cq p\x1cq"])
def test_statistics(text):
    found = outliers.text_statistics(None if text is None else text.encode())
    assert found == plain_statistics(text)


def make(kind, rng, words=200):
    syllables = "an be co di en fu ga ho in ku la me".split()
    vocabulary = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(800)]
    text = rng.choices(vocabulary, k=words)
    if kind == "symbols":
        text = [w + "%$#" for w in text]
    if kind == "glued":
        text = ["".join(text[i:i + 12]) for i in range(0, words, 2)]
    return " ".join(text)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    rows = []
    for i in range(900):
        # A third of the rows of one source are bad, more than a plain mean would stand.
        kind = "symbols" if i % 9 == 0 else "glued" if i % 18 == 1 else "good"
        rows.append((i, make(kind, rng, int(rng.lognormvariate(5.3, 0.6)) + 60), "en",
                     "hot" if i % 3 else f"s{i % 2}", kind))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kind string")


def judged(docs):
    rows = durable(outliers.with_statistics(docs, keep=[c for c in docs.columns if c != "text"]))
    return outliers.judge(rows, outliers.fit(rows))


def test_bad_texts_go_and_good_ones_stay(corpus):
    got = judged(corpus).collect()
    assert len(got) == 900
    kept = Counter((r.kind, r.kept) for r in got if not r.base_failed)
    assert kept["good", False] == 0
    assert kept["symbols", True] == kept["glued", True] == 0


def plain_fit(rows):
    """The same estimate with plain arrays: x has the features of one group."""
    x = np.array(rows)
    size = x.shape[1]

    def at(values, share):
        bins, counts = np.unique(np.floor(values * outliers.BINS), return_counts=True)
        return (bins[np.argmax(np.cumsum(counts) / counts.sum() >= share)] + 0.5) / outliers.BINS

    center = np.array([at(x[:, i], 0.5) for i in range(size)])
    spread = np.array([(at(x[:, i], 0.75) - at(x[:, i], 0.25)) / 1.349 for i in range(size)])
    precision = np.diag(1 / (spread ** 2 + np.square(outliers.FLOORS)))
    factor = outliers.CORE / outliers.chi2_share(outliers.chi2_at(outliers.CORE, size), size + 2)
    for _ in range(outliers.STEPS):
        d = np.einsum("ij,jk,ik->i", x - center, precision, x - center)
        bins = np.floor(np.log(d + 1e-9) * outliers.BINS)
        values, counts = np.unique(bins, return_counts=True)
        cut = values[np.argmax(np.cumsum(counts) / counts.sum() >= outliers.CORE)]
        core = x[bins <= cut]
        covariance = factor * np.cov(core.T, bias=True) + np.diag(np.square(outliers.FLOORS))
        center, precision = core.mean(axis=0), np.linalg.inv(covariance)
    return center, precision


def test_distances_against_plain_arrays(corpus):
    rows = [r.asDict() for r in judged(corpus).select("*", *(
        f.alias(f"x{i}") for i, f in enumerate(outliers.features()))).collect()]
    names = [f"x{i}" for i in range(len(outliers.FEATURES))]
    for source in ("hot", "s0", "s1"):
        group = [r for r in rows if r["source"] == source]
        center, precision = plain_fit([[r[n] for n in names] for r in group if not r["base_failed"]])
        for r in group:
            off = np.array([r[n] for n in names]) - center
            assert np.isclose(off @ precision @ off, r["distance"], rtol=1e-6, atol=1e-6)


def test_small_groups_take_their_language(corpus):
    few = corpus.withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 40))
    got = judged(few).collect()
    assert all(r.distance is not None for r in got if not r.base_failed)
    assert {r.kept for r in got if r.kind == "good" and not r.base_failed} == {True}


def test_awkward_rows(awkward, no_rows):
    rows = durable(outliers.with_statistics(awkward, keep=["doc_id", "lang", "source"]))
    got = outliers.judge(rows, outliers.fit(rows)).collect()
    expected = sorted(str((r.doc_id, *plain_statistics(r.text)))
                      for r in awkward.select("doc_id", "text").collect())
    assert sorted(str((r.doc_id, *(r[n] for n in outliers.STATISTICS))) for r in got) == expected
    assert all(not r.kept for r in got if r.n_words < 50)
    assert outliers.keep_good(awkward).columns == awkward.columns
    assert outliers.keep_good(no_rows).count() == 0


def test_chi_squared():
    assert abs(outliers.chi2_at(0.95, 5) - 11.0705) < 1e-3
    assert abs(outliers.chi2_at(0.99, 4) - 13.2767) < 1e-3

"""Raking and sampling."""

import numpy as np
import pytest

from tastemap.llm import mixing


def test_raking_meets_all_targets():
    rng = np.random.default_rng(0)
    places = [a.ravel() for a in np.meshgrid(range(5), range(3), range(4), indexing="ij")]
    tokens = rng.lognormal(5, 1, 60)
    targets = [mixing.tempered(np.bincount(p, tokens) / tokens.sum(), 0.8) for p in places]
    chance = mixing.rake(tokens, places, targets, keep=0.3)
    for place, target in zip(places, targets):
        kept = np.bincount(place, chance * tokens)
        assert np.allclose(kept / kept.sum(), target, atol=1e-6)
    assert chance.max() <= 1 and np.isclose((chance * tokens).sum(), 0.3 * tokens.sum())


def test_a_cell_held_at_one_is_made_up_for():
    tokens = np.array([10.0, 10.0, 100.0, 100.0])
    places = [np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1])]
    targets = [np.array([0.1, 0.9]), np.array([0.5, 0.5])]
    chance = mixing.rake(tokens, places, targets, keep=0.9)
    assert (chance <= 1).all() and chance[2:].min() > 0.85


def test_nothing_to_rake():
    assert len(mixing.rake(np.zeros(0), [np.zeros(0, int)] * 2, [np.zeros(0)] * 2)) == 0
    assert (mixing.rake(np.zeros(3), [np.arange(3)], [np.ones(3) / 3]) == mixing.KEEP).all()


@pytest.mark.parametrize("texts", [["a b a", "", "  x\ty\n", "é é", " lead", "w" * 500]])
def test_words_are_counted_whole(texts):
    counts, words = mixing.word_buckets([t.encode() for t in texts])
    assert words.tolist() == [len(t.encode().split()) for t in texts]
    assert counts.sum(axis=1).tolist() == words.tolist()
    for i, text in enumerate(texts):
        alone, _ = mixing.word_buckets([text.encode()])
        assert (alone[0] == counts[i]).all()
    upper, _ = mixing.word_buckets([t.upper().encode() for t in texts[:1]])
    assert (upper[0] == counts[0]).all()
    assert mixing.word_buckets([])[0].shape == (0, mixing.BUCKETS)


def test_topics_tell_word_use_apart():
    rng = np.random.default_rng(1)
    groups = [[f"w{g}{i}" for i in range(30)] for g in range(3)]
    texts = [" ".join(rng.choice(groups[i % 3], 40)).encode() for i in range(120)]
    langs = ["en" if i % 2 else "de" for i in range(120)]
    topics = mixing.Topics(texts, langs)
    found = topics.of(mixing.word_buckets(texts)[0], langs)
    # No topic holds two groups of words.
    assert all(len({i % 3 for i in np.flatnonzero(found == t)}) <= 1 for t in set(found))


def marginals(rows, column, weight):
    total = {}
    for row in rows:
        total[row[column]] = total.get(row[column], 0) + row["n"] * weight(row)
    whole = sum(total.values())
    return {k: v / whole for k, v in total.items()}


def test_documents_are_calibrated(documents):
    rows, _, chances = mixing.mixture(documents)
    judged = [r.asDict() for r in mixing.judge(rows, chances)
              .withColumnsRenamed({"_tokens": "n", "_source": "source", "_lang": "lang",
                                   "_topic": "topic"}).collect()]
    assert len(judged) == documents.count()
    for column in mixing.DIMENSIONS:
        now = marginals(judged, column, lambda r: 1.0)
        goal = dict(zip(now, mixing.tempered(np.array(list(now.values())))))
        kept = marginals(judged, column, lambda r: r["probability"])
        assert all(abs(kept[v] - goal[v]) < 0.02 for v in goal)
    tokens = {r.doc_id: len((r.text or "").encode().split()) for r in documents.collect()}
    assert {r["_c0"]: r["n"] for r in judged} == tokens


def test_given_targets(documents):
    targets = {"lang": {"=en": 0.3, "=de": 0.4}}
    rows, _, chances = mixing.mixture(documents, targets, keep=0.2)
    judged = [r.asDict() for r in mixing.judge(rows, chances)
              .withColumnsRenamed({"_tokens": "n", "_lang": "lang"}).collect()]
    kept = marginals(judged, "lang", lambda r: r["probability"])
    assert abs(kept["=en"] - 0.3) < 0.03 and abs(kept["=de"] - 0.4) < 0.03


def test_rare_values_are_raked_as_one(spark, monkeypatch, documents):
    monkeypatch.setattr(mixing, "VALUES", 2)
    rows, _, chances = mixing.mixture(documents)
    assert mixing.judge(rows, chances).count() == documents.count()
    assert chances.select("_source").distinct().count() == 20


def test_the_sample_is_what_the_verdict_says(documents):
    rows, _, chances = mixing.mixture(documents)
    kept = {r["_c0"] for r in mixing.judge(rows, chances).where("kept").collect()}
    sampled = mixing.sample(documents)
    assert sampled.columns == documents.columns
    assert {r.doc_id for r in sampled.collect()} == kept
    assert 0 < len(kept) < documents.count()


def test_awkward_rows(awkward, no_rows):
    rows, _, chances = mixing.mixture(awkward)
    assert mixing.judge(rows, chances).count() == awkward.count()
    kept = mixing.sample(awkward, keep=1.0)
    assert kept.columns == awkward.columns and kept.count() <= awkward.count()
    assert mixing.sample(no_rows).count() == 0


def cells_of(spark, n_sources):
    rng = np.random.default_rng(4)
    rows = [(f"=s{s}", f"={'ab'[lang]}", topic, int(rng.integers(1, 10 if s else 10_000)))
            for s in range(n_sources) for lang in range(2) for topic in range(2)]
    return rows, spark.createDataFrame(rows, "_source string, _lang string, _topic int, tokens long")


def test_every_source_of_many_has_its_own_target(spark):
    rows, cells = cells_of(spark, 300)
    chance = {tuple(r[:3]): r[3] for r in mixing.probabilities(cells, keep=0.1).collect()}
    total, kept = np.zeros(300), np.zeros(300)
    for source, lang, topic, tokens in rows:
        total[int(source[2:])] += tokens
        kept[int(source[2:])] += tokens * chance[source, lang, topic]
    assert np.allclose(kept / kept.sum(), mixing.tempered(total / total.sum()), atol=1e-6)


@pytest.mark.parametrize("targets", [{}, {"source": {"=s7": 0.2}, "topic": {1: 0.6}}])
def test_a_table_is_raked_as_on_the_driver(spark, monkeypatch, targets):
    _, cells = cells_of(spark, 12)
    monkeypatch.setattr(mixing, "ROUNDS", 4)
    monkeypatch.setattr(mixing, "VALUES", 5)
    here = sorted(mixing.probabilities(cells, targets, keep=0.3).collect())
    monkeypatch.setattr(mixing, "CELLS", 0)
    there = sorted(mixing.probabilities(cells, targets, keep=0.3).collect())
    assert [r[:3] for r in here] == [r[:3] for r in there]
    assert np.allclose([r[3] for r in here], [r[3] for r in there], rtol=1e-9)


@pytest.mark.parametrize("targets", [{"lang": {"=xx": 0.3}}, {"source": {"s1": 0.1}}, {"tone": {}}])
def test_targets_that_match_nothing_are_refused(spark, targets):
    with pytest.raises(ValueError):
        mixing.probabilities(cells_of(spark, 3)[1], targets)


def test_topics_come_from_all_rows(spark):
    rng = np.random.default_rng(6)
    groups = [[f"w{g}{i}" for i in range(30)] for g in range(8)]
    texts = [" ".join(rng.choice(groups[i % 8], 30)) for i in range(3000)]
    langs = ["rare" if i in (10, 2900) else "en" if i % 2 else None for i in range(3000)]
    docs = spark.createDataFrame(list(zip(range(3000), texts, langs, ["s"] * 3000)),
                                 "doc_id long, text string, lang string, source string")
    topics = mixing.train_topics(docs)
    x = mixing.Topics._features(mixing.word_buckets([t.encode() for t in texts])[0])
    means = {r["_lang"]: np.frombuffer(r["mean"]) for r in topics.means.collect()}
    names = np.array(["-" if lang is None else f"={lang}" for lang in langs])
    assert set(means) == {"-", "=en", "=rare"}
    for lang, mean in means.items():
        assert np.allclose(mean, x[names == lang].mean(axis=0), atol=1e-8)
    # The same topics however the rows are dealt, and those that k-means in memory ends with.
    again = mixing.train_topics(docs.repartition(5, "text"))
    assert (again.centers == topics.centers).all()
    found = {r["_c0"]: r["_topic"] for r in mixing.with_topics(docs, topics, ["doc_id"]).collect()}
    apart = x - np.array([means[n] for n in names])
    apart /= np.linalg.norm(apart, axis=1, keepdims=True)
    nearest = np.argmax(apart @ topics.centers.T, axis=1)
    assert [found[i] for i in range(3000)] == nearest.tolist()
    for topic in set(nearest.tolist()):
        center = apart[nearest == topic].sum(axis=0)
        assert np.allclose(center / np.linalg.norm(center), topics.centers[topic], atol=1e-2)

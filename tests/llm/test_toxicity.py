"""The string-kernel machine."""

import random

import numpy as np
import pytest

from tastemap.llm import toxicity

INSULTS = ["idiot", "moron", "scumbag", "pathetic"]


def kernel(one, two):
    """The gapped triples two words share, by definition."""
    def triples(word):
        found = {}
        for i in range(len(word)):
            for a, b in toxicity.STEPS:
                if i + a + b < len(word):
                    key = word[i] + word[i + a] + word[i + a + b]
                    found[key] = found.get(key, 0) + toxicity.DECAY ** (a + b - 2)
        return found

    def norm(word):
        return sum(max(0, len(word) - a - b) * toxicity.DECAY ** (2 * (a + b - 2))
                   for a, b in toxicity.STEPS) ** 0.5

    first, second = triples(one), triples(two)
    return sum(v * second.get(k, 0) for k, v in first.items()) / (norm(one) * norm(two))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    syllables = "ba de ki lo mu na pe ri so tu va we".split()
    vocabulary = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(600)]
    rows = []
    for i in range(400):
        words = rng.choices(vocabulary, k=120)
        label = int(i % 4 == 0)
        if label:
            for _ in range(3):
                words[rng.randrange(120)] = rng.choice(INSULTS)
        text = " ".join(w + "." if n % 10 == 9 else w for n, w in enumerate(words))
        rows.append((text, label))
    return rows


@pytest.fixture(scope="module")
def machine(corpus):
    return toxicity.train(corpus[:300])


def test_the_folded_machine_is_a_kernel_machine():
    # A weight per triple stands for a sum of kernels with landmark words.
    words = toxicity.Words(["moron", "clown", "idiot"])
    counts = [(s, 1.0, 0.1, 3.0 + i) for i, s in enumerate(words.strings())]
    mapping, triples = toxicity._landmarks(counts)
    features = toxicity._features(words.strings(), mapping, triples)
    expected = [[kernel(a, b) for b in ("moron", "clown", "idiot")]
                for a in ("moron", "clown", "idiot")]
    assert np.allclose(features @ features.T, expected, atol=1e-5)


def test_held_out_texts(corpus, machine):
    scores = machine.scores([t for t, _ in corpus[300:]])
    labels = np.array([label for _, label in corpus[300:]])
    assert ((scores >= 0.7) == (labels == 1)).mean() > 0.97


def test_gaps_and_letters_put_in(machine):
    texts = ["ba de idiot", "ba de i d i o t", "ba de i.d.i.o.t", "ba de id-iot", "ba de IDIOT!",
             "ba de paathetic", "ba de moronn"]
    assert (machine.scores(texts) >= 0.7).all()
    assert (machine.scores(["ba de ki lo mu", "", "   ", "12 34"]) < 0.5).all()


def test_one_bad_word_counts_in_any_length(machine):
    assert machine.scores(["ba de ki. " * 5000 + "idiot"])[0] >= 0.7
    assert machine.scores(["ba de ki. " * 5000])[0] < 0.5


def test_texts_are_scored_alone(machine, corpus):
    texts = [t for t, _ in corpus[:20]] + ["", "x", "i d", "日本語"]
    together = machine.scores(texts)
    assert np.allclose(together, [machine.scores([t])[0] for t in texts])


def test_too_little_to_learn_from():
    for rows in ([], [("a text", 1)], [("a text", 0)], [("", 0), ("", 1)], [("same", 0), ("same", 1)],
                 [("ab", 0), ("cd", 1)]):
        scores = toxicity.train(rows).scores(["a text", "", "ab"])
        assert ((scores >= 0) & (scores <= 1)).all()


def test_awkward_rows(spark, awkward, no_rows, machine):
    scored = toxicity.score(awkward, machine).collect()
    expected = {(str(r.doc_id), round(float(machine.scores([r.text or ""])[0]), 9))
                for r in awkward.select("doc_id", "text").collect()}
    assert {(str(r.doc_id), round(r.score, 9)) for r in scored} == expected
    assert len(scored) == awkward.count()
    assert toxicity.score(no_rows, machine).count() == 0


def test_training_rows_are_bounded_and_clean(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)] + [(3, "a text"), (4, None)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (5, None), (6, 7)],
                                   "doc_id long, toxic int")
    rows = toxicity.training_rows(docs, labels, rows=10)
    assert len(rows) <= 20 and {label for _, label in rows} == {0, 1}
    assert rows == toxicity.training_rows(docs, labels, rows=10)

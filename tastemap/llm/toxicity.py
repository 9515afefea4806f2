"""Toxicity by a subsequence string kernel: a support vector machine on Nystroem landmarks.

Two words are alike by the letter triples they share in order, gaps allowed and
discounted, so an insult with letters put in or taken apart stays close to itself.
Landmark words stand for the kernel; the machine learns from labelled sentences
which words make them toxic. Its decision folds into one weight per letter triple,
so that scoring a text costs a look-up per triple.
"""

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.llm.shared import ship_code

# Labelled rows of each class, and sentences of each class, to train on at most.
TRAIN_ROWS = 2000
TRAIN_SENTENCES = 15_000
# Landmarks that tell the classes apart, and common words.
TELLING, COMMON = 192, 64
# A word counts as toxic if its share of toxic sentences is that many times its share
# of clean ones, and that many standard errors above it.
TIMES, ERRORS = 8, 4
# Clean words to begin with, and the worst ones added in each round.
CLEAN_WORDS, WORST_WORDS, ROUNDS, EPOCHS = 6000, 3000, 4, 10
# Distances between the letters of a triple, and what each letter passed over costs.
STEPS = [(a, b) for a in (1, 2, 3) for b in (1, 2, 3) if a + b <= 4]
DECAY = 0.6
SENTENCE_END = re.compile(r"[.!?\n]+")
SENTENCE_WORDS = 32
SCORE_SCHEMA = "doc_id long, score double"


@cache
def _letters() -> np.ndarray:
    """Code of each character: 1 to 26 for a-z, 27 to 63 for other letters, 0 blank, 255 no letter."""
    def code(c: str) -> int:
        if "a" <= c <= "z":
            return ord(c) - 96
        return 27 + ord(c) % 37 if c.isalpha() else 0 if c.isspace() else 255

    return np.array([code(chr(c)) for c in range(1 << 16)], np.uint8)


class Words:
    """The words of some texts: marks inside a word are left out, letters spelt apart joined."""

    def __init__(self, texts: list[str]):
        texts = [t.lower() for t in texts]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        chars = np.frombuffer(" ".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
        code = _letters()[np.minimum(chars, 0xFFFF)]
        code[chars > 0xFFFF] = 27
        end = np.zeros(len(code), bool)
        end[np.cumsum(sizes) - 1] = True
        text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        kept = code != 255
        code, end, text = code[kept], end[kept], text[kept]
        kept = ~self._spelt(code, end)
        self.code, text = code[kept], text[kept]
        blank = self.code == 0
        self.word = np.cumsum(blank, dtype=np.int32) - blank
        n = int(self.word[-1]) + 1 if len(self.word) else 0
        self.length = np.bincount(self.word[~blank], minlength=n)
        self.text = text[blank]

    @staticmethod
    def _spelt(code: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Blanks between two letters that stand alone."""
        at = np.flatnonzero(code == 0)
        length = np.diff(at, prepend=-1) - 1
        alone = np.r_[(length[:-1] == 1) & (length[1:] == 1) & ~end[at[:-1]], [False]][:len(at)]
        found = np.zeros(len(code), bool)
        found[at[alone]] = True
        return found

    def triples(self) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """Word, letter triple and weight for each pair of steps between letters."""
        code = self.code.astype(np.int32)
        for a, b in STEPS:
            span = a + b
            inside = np.flatnonzero((self.word[:-span] == self.word[span:]) & (self.code[:-span] > 0)
                                    & (self.code[span:] > 0))
            key = (code[inside] << 12) | (code[inside + a] << 6) | code[inside + span]
            yield self.word[inside], key, DECAY ** (span - 2)

    def norm(self) -> np.ndarray:
        """What a word's kernel values are divided by, by its length; 0 below three letters."""
        total = sum((DECAY ** (2 * (a + b - 2)) * np.maximum(0, self.length - a - b)
                     for a, b in STEPS), np.zeros(len(self.length)))
        return np.sqrt(total)

    def strings(self) -> list[bytes]:
        """Each word as its codes."""
        return self.code.tobytes().split(b"\0")[:-1]


class Machine:
    """A weight for each letter triple, a bias, and the curve from margins to scores."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, middle: float):
        self.weights, self.bias, self.slope, self.middle = weights, bias, slope, middle

    def word_margins(self, words: Words) -> np.ndarray:
        n = len(words.length)
        total = np.zeros(n)
        for word, key, weight in words.triples():
            total += weight * np.bincount(word, self.weights[key], n)
        norm = words.norm()
        return np.divide(total, norm, out=np.zeros(n), where=norm > 0) + self.bias

    def text_margins(self, texts: list[str]) -> np.ndarray:
        """The margin of each text's worst word; of a text without words, the bias."""
        words = Words(texts)
        margins = self.word_margins(words)
        worst = np.full(len(texts), self.bias)
        if len(margins):
            starts = np.flatnonzero(np.r_[True, words.text[1:] != words.text[:-1]])
            worst[words.text[starts]] = np.maximum.reduceat(margins, starts)
        return worst

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(-self.slope * (self.text_margins(texts) - self.middle),
                                       -50, 50)))


def sentences(text: str) -> list[str]:
    """Pieces between full stops and line ends, of so many words at most."""
    found = []
    for sentence in SENTENCE_END.split(text):
        words = sentence.split()
        found += [" ".join(words[i:i + SENTENCE_WORDS])
                  for i in range(0, len(words), SENTENCE_WORDS)]
    return found


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS,
                  id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic") -> list[tuple[str, int]]:
    """Text and label of ``rows`` labelled documents of each class at most, by a hash of the id.

    Labels other than 0 and 1, null ids and null texts take no part. Only the
    chosen ids go to the documents; an id with several texts gives the least.
    """
    labelled = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
                .where("_id IS NOT NULL").groupBy("_id").agg(F.max("_label").alias("_label")))
    chosen = None
    for value in (0, 1):
        some = (labelled.where(F.col("_label") == value)
                .orderBy(F.xxhash64("_id"), "_id").limit(rows))
        chosen = some if chosen is None else chosen.unionByName(some)
    # At most twice ``rows`` ids are sent out.
    found = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
             .where("_text IS NOT NULL").join(F.broadcast(chosen), "_id")
             .groupBy("_id", "_label").agg(F.min("_text").alias("_text")).orderBy("_id").collect())
    return [(r["_text"], int(r["_label"])) for r in found]


def train(rows: list[tuple[str, int]], seed: int = 0) -> Machine:
    """The machine for labelled texts; one that always says their share if there is one class only."""
    toxic = np.array([label for _, label in rows], bool)
    if toxic.all() or not toxic.any():
        share = (toxic.sum() + 1) / (len(toxic) + 2)
        return Machine(np.zeros(1 << 18), 0.0, 1.0, float(np.log(1 / share - 1)))
    random = np.random.default_rng(seed)
    # Copies and shared passages count once, and not as toxic if a clean text has them too.
    label_of: dict[str, int] = {}
    for text, label in rows:
        for sentence in sentences(text):
            label_of[sentence] = min(label, label_of.get(sentence, 1))
    pieces = sorted(label_of.items())
    marked = np.array([label for _, label in pieces], bool)
    if marked.all() or not marked.any():
        return Machine(np.zeros(1 << 18), 0.0, 1.0, 0.0)
    chosen = np.concatenate([random.permutation(np.flatnonzero(marked == c))[:TRAIN_SENTENCES]
                             for c in (True, False)])
    words = Words([pieces[i][0] for i in chosen])
    y = np.where(marked[chosen], 1, -1)
    counts = _counts(words, y)
    kernel, triples = _landmarks(counts)
    weights, bias = _learn(counts, kernel, triples, random)
    table = np.zeros(1 << 18)
    table[triples] = kernel @ weights
    machine = Machine(table, bias, 1.0, 0.0)
    machine.slope, machine.middle = _curve(machine.text_margins([t for t, _ in rows]), toxic)
    return machine


def _counts(words: Words, y: np.ndarray) -> list[tuple[bytes, float, float, float]]:
    """Of each word of three letters or more: its share of toxic and of clean sentences, and
    by how many standard errors the first is higher."""
    strings = words.strings()
    different = {s: i for i, s in enumerate(sorted({s for s in strings if len(s) > 2}))}
    number = np.fromiter((different.get(s, -1) for s in strings), np.int64, len(strings))
    # A word counts once a sentence.
    pairs = np.unique(words.text[number >= 0].astype(np.int64) * len(different)
                      + number[number >= 0])
    sentence, word = np.divmod(pairs, max(1, len(different)))
    toxic, clean = (np.bincount(word[y[sentence] == side], minlength=len(different))
                    for side in (1, -1))
    n1, n0 = int((y > 0).sum()), int((y < 0).sum())
    share = (toxic + clean) / (n1 + n0)
    error = np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12)
    a, b = toxic / n1, clean / n0
    errors = (a - b) / error
    b = np.where(toxic > 0, np.maximum(b, 0.5 / n0), b)
    return list(zip(different, a.tolist(), b.tolist(), errors.tolist()))


def _landmarks(counts: list) -> tuple[np.ndarray, np.ndarray]:
    """Landmarks: the words whose share differs most by class, and common ones.

    Returns the map from letter triples to the Nystroem features, and the triples.
    """
    every = sorted(counts, key=lambda c: (-abs(c[3]), c[0]))
    common = sorted(every[TELLING:], key=lambda c: (-c[1] - c[2], c[0]))[:COMMON]
    chosen = [c[0] for c in every[:TELLING] + common]
    place, key, weight = _sparse(chosen)
    triples = np.unique(key)
    dense = np.zeros((len(triples), len(chosen)))
    np.add.at(dense, (np.searchsorted(triples, key), place), weight)
    values, vectors = np.linalg.eigh(dense.T @ dense)
    kept = values > 1e-6 * values.max(initial=0)
    return dense @ (vectors[:, kept] / np.sqrt(values[kept])), triples


def _sparse(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, letter triple and normed weight for words given as codes."""
    words = object.__new__(Words)
    words.code = np.frombuffer(b"".join(s + b"\0" for s in strings), np.uint8)
    blank = words.code == 0
    words.word = np.cumsum(blank, dtype=np.int32) - blank
    words.length = np.fromiter(map(len, strings), np.int64, len(strings))
    norm = words.norm()
    parts = [(w, k, weight / norm[w]) for w, k, weight in words.triples()]
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))


def _features(strings: list[bytes], kernel: np.ndarray, triples: np.ndarray) -> np.ndarray:
    """Nystroem features of words."""
    place, key, weight = _sparse(strings)
    at = np.minimum(np.searchsorted(triples, key), len(triples) - 1)
    known = triples[at] == key
    place, at, weight = place[known], at[known], weight[known]
    order = np.argsort(place, kind="stable")
    place, at, weight = place[order], at[order], weight[order]
    features = np.zeros((len(strings), kernel.shape[1]), np.float32)
    for first in range(0, len(place), 1 << 16):
        part = slice(first, first + (1 << 16))
        rows, where = np.unique(place[part], return_index=True)
        features[rows] += np.add.reduceat(kernel[at[part]] * weight[part, None], where)
    return features


def _learn(counts: list, kernel: np.ndarray, triples: np.ndarray,
           random: np.random.Generator) -> tuple[np.ndarray, float]:
    """The machine that tells the words that make sentences toxic from clean sentences' words.

    Rounds add the clean words that the last one found worst.
    """
    bad = [s for s, a, b, errors in counts if a > TIMES * b and errors > ERRORS]
    if not bad:  # too few sentences for that: the words that stand out most
        bad = [c[0] for c in sorted(counts, key=lambda c: (-c[3], c[0]))[:10] if c[3] > 0]
    good = [s for s, a, b, _ in counts if a <= 2 * b]
    if not bad or not good:
        return np.zeros(kernel.shape[1]), 0.0
    toxic, clean = _features(bad, kernel, triples), _features(good, kernel, triples)
    used = set(random.permutation(len(good))[:CLEAN_WORDS].tolist())
    for _ in range(ROUNDS):
        some = clean[sorted(used)]
        repeat = min(20, max(1, len(some) // (2 * len(toxic))))
        x = np.concatenate([np.repeat(toxic, repeat, axis=0), some])
        target = np.r_[np.ones(repeat * len(toxic)), -np.ones(len(some))]
        weights, bias = linear_svm(x, target, random)
        used |= set(np.argsort(-(clean @ weights))[:WORST_WORDS].tolist())
    return weights, bias


def linear_svm(x: np.ndarray, y: np.ndarray, random: np.random.Generator,
               cost: float = 1.0) -> tuple[np.ndarray, float]:
    """Support vector machine with squared hinge loss, by dual coordinate descent."""
    x = np.c_[x, np.ones(len(x), x.dtype)]
    size = np.einsum("ij,ij->i", x, x) + 1 / (2 * cost)
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    for _ in range(EPOCHS):
        for i in random.permutation(len(x)):
            slope = y[i] * (x[i] @ w) - 1 + alpha[i] / (2 * cost)
            new = max(0.0, alpha[i] - slope / size[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w[:-1], float(w[-1])


def _curve(margins: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the logistic curve from margins to the chance of label 1.

    Newton steps on smoothed targets, classes weighted alike.
    """
    n1, n0 = toxic.sum(), (~toxic).sum()
    goal = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(toxic, 0.5 / n1, 0.5 / n0)
    x = np.c_[margins, np.ones(len(margins))]
    beta = np.zeros(2)
    for _ in range(60):
        chance = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        bend = weight * np.maximum(chance * (1 - chance), 1e-9)
        step = np.linalg.solve((x * bend[:, None]).T @ x + 1e-6 * np.eye(2),
                               x.T @ (weight * (goal - chance)) - 1e-6 * beta)
        beta += np.clip(step, -1, 1)
    slope = max(float(beta[0]), 1e-3)
    return slope, -float(beta[1]) / slope


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id, score`` from 0 to 1 of every whole text, higher where label 1 is likelier.

    A null text is scored like an empty one: as no worse than words unlike any
    insult. Repeated rows and null ids are scored each for themselves; no other
    column is read.
    """
    ship_code(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 128):
                some = batch.slice(first, 128)
                texts = [t or "" for t in some.column("text").to_pylist()]
                yield pa.record_batch([some.column("doc_id"), pa.array(sent.value.scores(texts))],
                                      ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(
        compute, SCORE_SCHEMA)

"""Toxicity by multiple-instance learning: a document is a bag of sentences, of which only the document's label is known.

A sentence's score is a logistic function of its distinct words, and a word's weight the sum of those of the word and its
beginnings. No weight is negative: words can only offend, so a long clean sentence doesn't hide an offence. A document's score is
the noisy-or of its sentences, 1 - prod(1 - p). The weights are fitted to document labels by the likelihood's gradient through the
noisy-or, a toxic document counting as TOXIC_WEIGHT clean ones; afterwards the same weights locate the sentences that offend. What is given as a
score is a power of the probability that puts CUT at one half.

The fit takes a bounded sample of labelled rows (FIT_ROWS, by a hash of doc_id) in one task; the model that it gives is as large
as the sample's words allow. Scoring sees every whole text, in tasks that need nothing else.

Null and empty texts have no sentence and get the score of a bag with one empty sentence. Where a doc_id has labels that differ, it is toxic.
Equal scores come of equal words: ties stay ties. Very long texts are whole: they only have more sentences. An empty table gives an empty table.
Labels without a document, null labels and held-out rows don't count. With no labelled row, or one class only, every score is
the class's share (0 without rows). Repeated rows get equal scores; columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TwoGenerations, held_out, map_rows, whole_text

#: Labelled rows that a fit takes at most.
FIT_ROWS = 5000
#: The longest beginning of a word that is a feature.
LONGEST_START = 8
#: Words whose weights a task keeps.
CACHE = 300_000
#: Documents of the sample that a feature must be in.
MIN_DOCS = 3
EPOCHS = 150
RATE = 0.3
#: A weight stays 0 unless its pull on the mean log-likelihood passes this, or PENALTY_DOCS documents' share if that is more.
PENALTY = 5e-5
PENALTY_DOCS = 0.1
#: What a toxic document of the sample counts; the probability from which on a document is toxic.
TOXIC_WEIGHT = 4.0
CUT = 0.4
#: Weights nearer to zero than this are left out of the model.
LEAST = 0.02

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    """A word's features: itself, marked by a closing $, and its beginnings."""
    return [word + "$", *(word[:k] for k in range(3, min(len(word), LONGEST_START) + 1))]


@dataclass
class Model:
    bias: float = -20.0
    weights: dict[str, float] = field(default_factory=dict)
    #: Set where the sample has no two classes.
    constant: float | None = None

    def __post_init__(self) -> None:
        self.cache = TwoGenerations(CACHE)

    def word(self, word: str) -> float:
        found = self.cache.get(word)
        if found is None:
            get = self.weights.get
            found = math.fsum(get(f, 0.0) for f in features(word))
            self.cache.put(word, found)
        return found

    @staticmethod
    def calibrated(p: float) -> float:
        return min(1.0, max(0.0, p)) ** (math.log(0.5) / math.log(CUT))

    def located(self, text: str, threshold: float = 0.5) -> list[tuple[int, int, float]]:
        """start, end (characters) and score of the sentences whose own score reaches the threshold."""
        found = ((m.start(), m.end(), self.calibrated(self.sentence(m.group().lower()))) for m in _SENTENCE.finditer(text))
        return [x for x in found if x[2] >= threshold]

    def sentence(self, text: str) -> float:
        """The probability that a lower-cased sentence offends."""
        z = self.bias + math.fsum(map(self.word, set(_WORD.findall(text))))
        return 1.0 / (1.0 + math.exp(-z)) if z > -700 else 0.0

    def document(self, text: str) -> float:
        if self.constant is not None:
            return self.constant
        log_clean = 0.0
        for sentence in _SENTENCE.findall(text.lower()) or [""]:
            z = self.bias
            get = self.cache.new.get
            for word in set(_WORD.findall(sentence)):
                weight = get(word)
                if weight is None:
                    weight = self.word(word)
                    get = self.cache.new.get
                z += weight
            log_clean -= z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z)) if z > -700 else 0.0
        return -math.expm1(log_clean)


def noisy_or_gradient(z: np.ndarray, doc: np.ndarray, y: np.ndarray, toxic_weight: float = TOXIC_WEIGHT) -> tuple[float, np.ndarray]:
    """The documents' weighted log-likelihood under the noisy-or of their sentences, and its gradient by the sentences' log-odds z.

    doc: the document of each sentence; y: the documents' labels.
    """
    p = 1 / (1 + np.exp(-z))
    log_clean = np.bincount(doc, -np.logaddexp(0, z), len(y))
    clean = np.exp(log_clean)
    toxic = np.maximum(1 - clean, 1e-9)
    push = np.where(y[doc] > 0, toxic_weight * p * (clean / toxic)[doc], -p)
    return float(np.where(y > 0, toxic_weight * np.log(toxic), log_clean).sum()), push


def fit(texts: list[str], labels: list[int]) -> Model:
    """The weights that maximise the documents' likelihood, by Adam over all of them at once."""
    y = np.array(labels, np.float64)
    if not len(y) or y.min() == y.max():
        return Model(constant=float(y.mean()) if len(y) else 0.0)
    bags = [[set(_WORD.findall(s)) for s in _SENTENCE.findall(t.lower())] or [set()] for t in texts]
    counts: Counter[str] = Counter()
    for bag in bags:
        counts.update({f for word in set().union(*bag) for f in features(word)})
    vocabulary = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n >= MIN_DOCS))}
    # sentences are bags of words and words are bags of features: two sparse matrices in place of their product
    words = {w: i for i, w in enumerate(sorted(set().union(*(sentence for bag in bags for sentence in bag))))}
    pairs = np.array([(i, vocabulary[f]) for w, i in words.items() for f in features(w) if f in vocabulary], np.int64).reshape(-1, 2)
    word_row, column = pairs[:, 0], pairs[:, 1]
    sentences = [sentence for bag in bags for sentence in bag]
    s = len(sentences)
    row = np.repeat(np.arange(s), [len(x) for x in sentences])
    word = np.fromiter((words[w] for x in sentences for w in x), np.int64, len(row))
    doc = np.repeat(np.arange(len(bags)), [len(bag) for bag in bags])
    size = len(vocabulary)
    w = np.zeros(size + 1)
    w[size] = math.log(max(y.mean(), 1e-6) / (s / len(y)))
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    gradient = np.zeros(size + 1)
    penalty = max(PENALTY, PENALTY_DOCS / len(y))
    for step in range(1, EPOCHS + 1):
        of_word = np.bincount(word_row, w[column], len(words))
        z = np.clip(w[size] + np.bincount(row, of_word[word], s), -30, 30)
        _, push = noisy_or_gradient(z, doc, y)
        gradient[:size] = np.bincount(column, np.bincount(word, push[row], len(words))[word_row], size) / len(y)
        gradient[size] = push.sum() / len(y)
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        scale = RATE * (1 - step / (EPOCHS + 1)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        w += scale * mean / (1 - 0.9**step)
        # the proximal step of the penalty and the bound at 0, in Adam's metric; not for the bias
        w[:size] = np.maximum(w[:size] - scale[:size] * penalty, 0)
    return Model(float(w[size]), {f: float(w[i]) for f, i in vocabulary.items() if abs(w[i]) >= LEAST})


def training_rows(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, text and toxic of at most fit_rows labelled documents that aren't held out."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))  # an id that rows repeat counts once, with its least text


def fit_model(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fits in one task over the bounded sample; the model comes to the driver."""
    import pickle

    def run(batches):
        rows = sorted({(r["doc_id"], r["text"]): r["toxic"] for b in batches for r in b.to_pylist()}.items())
        model = fit([text for (_, text), _ in rows], [toxic for _, toxic in rows])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((model.bias, model.weights, model.constant))], pa.binary())], ["model"])

    found = training_rows(docs, labels, fit_rows).repartition(1).mapInArrow(run, "model binary").collect()
    bias, weights, constant = pickle.loads(found[0]["model"]) if found else (-20.0, {}, 0.0)
    return Model(bias, weights, constant)


SCORED = "doc_id long, held_out boolean, score double, predicted int, n_offending int, worst_start long, worst_end long, worst_score double"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; of those that are predicted toxic the sentences that offend by themselves: how many,
    and place (characters) and score of the worst, the first at ties. Null where there is none: a document may be toxic by several weak ones."""

    def make():
        def one(row):
            p = model.document(row["text"]) if model.constant is not None else model.calibrated(model.document(row["text"]))
            toxic = p >= 0.5
            found = model.located(row["text"]) if toxic and model.constant is None else []
            start, end, worst = max(found, key=lambda x: (x[2], -x[0]), default=(None, None, None))
            return [(row["doc_id"], row["held_out"], p, int(toxic), len(found), start, end, worst)]

        return one

    return map_rows(docs.select("doc_id", held_out().alias("held_out"), whole_text().alias("text")), make, SCORED)


def locate(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The sentences whose own score reaches the threshold: doc_id, start, end (characters), sentence, score."""

    def make():
        def one(row):
            return [(row["doc_id"], start, end, row["text"][start:end], p) for start, end, p in model.located(row["text"], threshold)]

        return one

    return map_rows(docs.select("doc_id", whole_text().alias("text")), make, "doc_id long, start long, end long, sentence string, score double")

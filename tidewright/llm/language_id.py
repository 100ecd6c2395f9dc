"""Language identification by a bidirectional gated recurrent network over bytes.

A text's bytes (UTF-8, A-Z lower-cased), all of them, are read in both directions; each byte's two states give probabilities of the languages,
which label that position. A document pools its positions: the sum of their log-probabilities, scaled by POOL as neighbours
depend on one another, goes through a softmax. The network is trained in numpy by backpropagation through time, on windows of a
bounded sample of labelled documents, each language with equal weight.

The network's memory is CONTEXT bytes: a text is read in stretches of STRETCH bytes, each with the CONTEXT bytes before and after it, over
which the states build up. Stretches are evaluated in batches of one fixed shape, and sums are taken in float64 by document, so that
equal texts get equal results to the last bit, whatever stands beside them.

A null text, and one without a letter, is und with score 0. Rows without lang aren't learnt from. With no labelled row, or an empty table to learn
from, everything is und; an empty table to predict gives an empty table. With one language it is that one. Equal scores: the first language
in order. Long texts are whole: they only give more stretches. Repeated rows get equal rows; columns beside doc_id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _arrow_schema, held_out, likely, map_rows, release, whole_text

#: Labelled documents that a fit takes at most of each language, and of all languages about (no language gets a share under LEAST_DOCS).
FIT_DOCS = 400
FIT_ALL = 40_000
LEAST_DOCS = 10
HIDDEN = 8
STEPS = 300
#: Windows of a training step and their bytes.
BATCH = 128
WINDOW = 96
RATE = 0.02
STRETCH = 224
CONTEXT = 16
#: Stretches of a batch; every batch has this shape.
LOT = 512
#: Documents' bytes and rows that a task predicts at a time.
CHUNK_BYTES = 2 << 20
CHUNK_ROWS = 512
POOL = 1 / 16
UND = "und"
#: Stands where a text has no byte; it leaves the state as it is.
_NONE = 256


def _table(p: np.ndarray) -> np.ndarray:
    """Projections of the 256 bytes (3H, 256) and, in a further column, of no byte: its update gate is 0 exactly."""
    n = len(p) // 3
    none = np.zeros((len(p), 1), p.dtype)
    none[:n] = -200
    return np.concatenate((p, none), 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def states(p: list[np.ndarray], u: np.ndarray, x: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (T, 2, H, B) of bytes x (T, B), forward and backward in time; gates in order: update, reset, candidate.

    p: the projections of each direction; u: the recurrent weights (2, 3H, H). The second direction's states stand at the places of their bytes.
    """
    steps, batch = x.shape
    n = u.shape[2]
    h = np.zeros((2, n, batch), u.dtype)
    out = np.empty((steps, 2, n, batch), u.dtype)
    fed = np.empty((2, 3 * n, batch), u.dtype)
    for t in range(steps):
        np.take(p[0], x[t], axis=1, out=fed[0], mode="clip")
        np.take(p[1], x[steps - 1 - t], axis=1, out=fed[1], mode="clip")
        a = np.matmul(u, h)
        inner = a[:, 2 * n :].copy() if keep is not None else None
        gates = a[:, : 2 * n]
        gates += fed[:, : 2 * n]
        _sigmoid(gates)
        c = a[:, 2 * n :]
        c *= gates[:, n:]
        c += fed[:, 2 * n :]
        np.tanh(c, out=c)
        new = c - h
        new *= gates[:, :n]
        new += h
        if keep is not None:
            keep.append((h, gates[:, :n], gates[:, n:], inner, c))
        h = new
        out[t, 0] = h[0]
        out[steps - 1 - t, 1] = h[1]
    return out


def through_time(u: np.ndarray, x: np.ndarray, kept: list, d_out: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Gradients of u and of both directions' projections, from those of the states, backwards through time."""
    steps, batch = x.shape
    n = u.shape[2]
    d_u, d_h = np.zeros_like(u), np.zeros((2, n, batch), u.dtype)
    d_p = [np.zeros((_NONE + 1, 3 * n), u.dtype) for _ in range(2)]
    d_fed = np.empty((steps, 2, 3 * n, batch), u.dtype)
    for t in range(steps - 1, -1, -1):
        h, z, r, inner, c = kept[t]
        d = d_h + np.stack((d_out[t, 0], d_out[steps - 1 - t, 1]))
        d_c = d * z * (1 - c * c)
        d_z = d * (c - h) * z * (1 - z)
        d_r = d_c * inner * r * (1 - r)
        d_fed[t] = np.concatenate((d_z, d_r, d_c), 1)
        d_a = np.concatenate((d_z, d_r, d_c * r), 1)
        d_u += d_a @ h.transpose(0, 2, 1)
        d_h = d * (1 - z) + u.transpose(0, 2, 1) @ d_a
    for way, fed in ((0, x), (1, x[::-1])):
        order = np.argsort(fed, axis=None, kind="stable")
        found, starts = np.unique(fed.ravel()[order], return_index=True)
        d_p[way][found] = np.add.reduceat(d_fed[:, way].transpose(0, 2, 1).reshape(-1, 3 * n)[order], starts, axis=0)
    return d_u, [g[:_NONE].T for g in d_p]


@dataclass
class Model:
    languages: list[str]
    params: dict[str, np.ndarray]

    def positions(self, x: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities (T, languages, B) of the positions of x (T, B), and the states."""
        p = self.params
        s = states([_table(p["pf"]), _table(p["pb"])], p["u"], x, keep)
        flat = s.reshape(len(s), -1, s.shape[3])
        logits = np.matmul(p["v"], flat)
        logits += p["c"][:, None]
        logits -= logits.max(1, keepdims=True)
        logits -= np.log(np.exp(logits).sum(1, keepdims=True))
        return logits, s

    def gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-probability of labels y (B) over all positions that have a byte."""
        p, kept = self.params, []
        d, s = self.positions(x, kept)
        np.exp(d, out=d)
        d[:, y, np.arange(len(y))] -= 1
        there = x != _NONE
        d *= (there / there.sum()).astype(d.dtype)[:, None, :]
        flat = s.reshape(len(s), -1, s.shape[3])
        d_s = np.matmul(p["v"].T, d).reshape(s.shape)
        d_u, (d_f, d_b) = through_time(p["u"], x, kept, d_s)
        return {"v": np.tensordot(d, flat, ((0, 2), (0, 2))), "c": d.sum((0, 2)), "u": d_u, "pf": d_f, "pb": d_b}


def letters_of(text: str) -> bytes:
    return text.encode().lower()


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def padded(pieces: list[bytes], width: int) -> np.ndarray:
    """Bytes by place and piece (width, n); _NONE beyond a piece's end."""
    flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(len(pieces), width).astype(np.intp)
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    flat[np.arange(width) >= lengths[:, None]] = _NONE
    return np.ascontiguousarray(flat.T)


def untrained(languages: list[str], rng: np.random.Generator, hidden: int = HIDDEN) -> Model:
    k = len(languages)
    normal = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
    near = 1 / np.sqrt(hidden)
    return Model(languages, {"pf": normal(0.4, 3 * hidden, 256), "pb": normal(0.4, 3 * hidden, 256), "u": normal(near, 2, 3 * hidden, hidden), "v": normal(near, k, 2 * hidden), "c": np.zeros(k, np.float32)})


def fit(samples: list[tuple[bytes, str]], seed: int = 7, steps: int = STEPS) -> Model:
    """Trains on (bytes, language) pairs by backpropagation through time, with Adam. A step takes windows of as many languages as it can."""
    languages = sorted({lang for _, lang in samples})
    rng = np.random.default_rng(seed)
    if len(languages) < 2:
        return Model(languages, {})
    by_language: dict[str, list[bytes]] = {lang: [] for lang in languages}
    for data, lang in samples:
        by_language[lang].append(data)
    model = untrained(languages, rng)
    p = model.params
    first, second = ({name: np.zeros_like(a) for name, a in p.items()} for _ in range(2))
    k = len(languages)
    for step in range(1, steps + 1):
        y = np.repeat(np.arange(k), BATCH // k) if k <= BATCH else rng.choice(k, BATCH, replace=False)
        pieces = []
        for j in y:
            texts = by_language[languages[j]]
            data = texts[rng.integers(len(texts))]
            start = int(rng.integers(max(1, len(data) - WINDOW + 1)))
            pieces.append(data[start : start + WINDOW])
        g = model.gradient(padded(pieces, WINDOW), y)
        rate = RATE * (1 - step / (steps + 1)) + 1e-4
        for name, a in p.items():
            first[name] += 0.1 * (g[name] - first[name])
            second[name] += 0.01 * (g[name] ** 2 - second[name])
            a -= (rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)).astype(a.dtype)
    return model


def training_rows(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """doc_id, text and lang of at most fit_docs labelled documents of each language, none held out, the first by a hash of doc_id.

    Languages aren't limited: their counts are a table, with which ids (not texts) are cut at about the bound's share of each
    language before those that are left are ranked. With many languages each gets fewer, FIT_ALL among them, but LEAST_DOCS at least.
    Of rows that repeat an id and a language the least text counts.
    """
    rows = docs.select("doc_id", whole_text().alias("text"), "lang").where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out() & F.col("text").rlike(r"\p{L}"))
    ids = rows.select("doc_id", "lang")
    counts = ids.groupBy("lang").agg(F.count("*").alias("n"))
    languages = counts.count()
    bound = min(fit_docs, max(LEAST_DOCS, FIT_ALL // max(1, languages)))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    some = ids.distinct().join(counts, "lang").where(place <= (1 << 30) * F.least(F.lit(1.0), F.lit(2.0 * bound) / F.col("n") + F.lit(40.0) / F.col("n")))
    w = Window.partitionBy("lang").orderBy(place, "doc_id")
    chosen = some.withColumn("k", F.row_number().over(w)).where(F.col("k") <= bound).select("doc_id", "lang")
    found = likely(rows, chosen, "doc_id").join(chosen, ["doc_id", "lang"], "left_semi")
    return found.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("doc_id", "text", "lang")


def fit_model(docs: DataFrame, fit_docs: int = FIT_DOCS, steps: int = STEPS) -> Model:
    """Fits in one task over the bounded sample; the network, some ten thousand numbers and as many more as languages ask, comes to the driver."""
    import pickle

    def run(batches):
        rows = sorted((r["lang"], r["doc_id"], r["text"]) for b in batches for r in b.to_pylist())
        model = fit([(letters_of(text), lang) for lang, _, text in rows], steps=steps)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((model.languages, model.params))], pa.binary())], ["model"])

    found = training_rows(docs, fit_docs).repartition(1).mapInArrow(run, "model binary").collect()
    languages, params = pickle.loads(found[0]["model"]) if found else ([], {})
    return Model(languages, params)


class Pooler:
    """Predicts documents: every byte gets a label, and a document the pool of its positions."""

    def __init__(self, model: Model) -> None:
        self.model = model

    def lots(self, texts: list[bytes]):
        """Log-probabilities (STRETCH, languages, n) and bytes (STRETCH, n) of the texts' stretches in order, in batches of LOT."""
        width = STRETCH + 2 * CONTEXT
        front = b"\0" * CONTEXT
        pieces, firsts = [], []
        for data in texts:
            for at in range(0, len(data), STRETCH):
                firsts.append(at == 0)
                pieces.append((front + data[: STRETCH + CONTEXT]) if at == 0 else data[at - CONTEXT : at + STRETCH + CONTEXT])
        for start in range(0, len(pieces), LOT):
            part = pieces[start : start + LOT]
            n = len(part)
            x = padded(part + [b""] * (LOT - n), width)
            x[:CONTEXT, :n][:, firsts[start : start + LOT]] = _NONE
            logp, _ = self.model.positions(x)
            yield logp[CONTEXT : CONTEXT + STRETCH, :, :n], x[CONTEXT : CONTEXT + STRETCH, :n]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, int, float]]:
        """Language, score, labelled positions and the share of them with that language's label."""
        languages = self.model.languages
        if not languages:
            return [(UND, 0.0, 0, 0.0)] * len(texts)
        read = [letters_of(t) if has_letter(t) else b"" for t in texts]
        if len(languages) == 1:
            return [(languages[0], 1.0, len(data), 1.0) if data else (UND, 0.0, 0, 0.0) for data in read]
        sums, labels = [], []
        for logp, x in self.lots(read):
            there = x != _NONE
            sums.append((logp * there[:, None, :]).sum(0, dtype=np.float64).T)
            best = logp.argmax(1)
            labels.append(np.stack([((best == k) & there).sum(0) for k in range(len(languages))], 1) if len(languages) <= 64 else np.apply_along_axis(np.bincount, 0, np.where(there, best, len(languages)), None, len(languages) + 1).T[:, :-1])
        counts = [-(-len(data) // STRETCH) for data in read]
        ends = np.cumsum(counts)
        out = []
        whole, seen = (np.concatenate(part) if part else None for part in (sums, labels))
        for data, n, end in zip(read, counts, ends, strict=True):
            if not n:
                out.append((UND, 0.0, 0, 0.0))
                continue
            total = np.zeros(len(languages))
            for row in whole[end - n : end]:
                total += row
            best = int(total.argmax())
            p = np.exp(POOL * (total - total[best]))
            out.append((languages[best], float(1 / p.sum()), len(data), float(seen[end - n : end, best].sum() / len(data))))
        return out


def chunks(batch: pa.RecordBatch, at: int):
    """Slices of a batch of bounded rows and bytes, with the texts of column at."""
    for first in range(0, batch.num_rows, CHUNK_ROWS):
        part = batch.slice(first, CHUNK_ROWS)
        texts = part.column(at).to_pylist()
        start, held = 0, 0
        for i, text in enumerate(texts):
            held += len(text or "")
            if held >= CHUNK_BYTES or i + 1 == len(texts):
                yield part.slice(start, i + 1 - start), texts[start : i + 1]
                start, held = i + 1, 0


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_positions (bytes that got a label) and label_share (of lang_pred among them) of every document."""
    schema = "doc_id long, held_out boolean, lang_pred string, score double, n_positions long, label_share double"
    arrow = _arrow_schema(docs.sparkSession, schema)

    def run(batches):
        pooler = Pooler(model)
        for batch in batches:
            for part, texts in chunks(batch, 2):
                lang, score, n, share = zip(*pooler.predict(texts), strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(n, pa.int64()), pa.array(share, pa.float64())], schema=arrow)

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, schema)


def label_positions(docs: DataFrame, model: Model) -> DataFrame:
    """Per stretch of STRETCH bytes its place in the text's bytes and the language of each of its bytes: doc_id, start, labels."""

    def make():
        pooler = Pooler(model)

        def one(row):
            data = letters_of(row["text"])
            if len(model.languages) < 2:
                return [(row["doc_id"], at, (model.languages or [UND]) * len(data[at : at + STRETCH])) for at in range(0, len(data), STRETCH)]
            out, at = [], 0
            for logp, x in pooler.lots([data]):
                best, there = logp.argmax(1), x != _NONE
                for i in range(best.shape[1]):
                    out.append((row["doc_id"], at, [model.languages[k] for k in best[there[:, i], i]]))
                    at += STRETCH
            return out

        return one

    return map_rows(docs.select("doc_id", whole_text().alias("text")), make, "doc_id long, start long, labels array<string>")


#: Probability that the pipeline asks of the predicted language.
LEAST_SCORE = 0.5


def keep_identified(docs: DataFrame, model: Model | None = None, least_score: float = LEAST_SCORE) -> DataFrame:
    """The documents, with all their columns, whose language is identified; und (null texts, texts without a letter) and doubtful ones go.

    The network is trained on the documents themselves unless one is given; where none has a language, all are und and go. Rows that
    repeat stay or go alike; an empty table gives an empty table.
    """
    model = model or fit_model(docs)
    source = docs.schema
    names = [f"`{c}`" for c in docs.columns]
    at = docs.columns.index("text")

    def run(batches):
        pooler = Pooler(model)
        for batch in batches:
            for part, texts in chunks(batch, at):
                yield part.filter(pa.array([found[0] != UND and found[1] >= least_score for found in pooler.predict(texts)], pa.bool_()))
        release()

    return docs.select(*names).mapInArrow(run, source)

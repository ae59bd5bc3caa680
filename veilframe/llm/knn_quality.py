"""Quality by nearest-neighbour voting over latent-semantic vectors.

Terms are hashed words, word shapes and repeated words; document frequencies come from all documents. A truncated
singular value decomposition is fitted on a bounded sample of labelled rows, whose vectors are broadcast; every
document is compared with all of them in blocks, and its nearest neighbours vote by similarity.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import utf8

WORDS, SHAPES = 1 << 15, 1 << 12
TERMS = WORDS + SHAPES + 1  # hashed words, hashed word shapes, and a word that repeats the one before it
WORD_WEIGHT, REPEAT_IDF = 0.5, 2.0
DIMENSIONS = 48
PER_CLASS = 2000  # labelled rows of each label that the model is fitted on
NEIGHBOURS = 25
CACHE = 400_000
_SHAPE = bytes(ord("a") if 97 <= b <= 122 or b >= 128 else ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57 else b for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)
_REPEAT = TERMS - 1
_known: dict[bytes, int] = {}
_PART = 400_000


def _terms(word: bytes) -> int:
    """Two term numbers in one: of the lower-cased word and of its shape."""
    return (zlib.crc32(word.lower()) % WORDS) * TERMS + WORDS + zlib.crc32(_RUN.sub(rb"\1", word.translate(_SHAPE))) % SHAPES


def counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of whole texts, sorted by row and term."""
    parts, rows, flat, owner = [], [], [], []

    def flush():
        if flat:
            both = np.array(flat, np.int64)
            row = np.repeat(owner, rows)
            again = np.flatnonzero((both[1:] == both[:-1]) & (row[1:] == row[:-1])) + 1
            key = np.concatenate([row * TERMS + both // TERMS, row * TERMS + both % TERMS, row[again] * TERMS + _REPEAT])
            parts.append(np.unique(key, return_counts=True))
            for x in (rows, flat, owner):
                x.clear()

    for n, text in enumerate(texts):
        words = text.split()
        if len(_known) > CACHE:
            _known.clear()
        for w in words:
            if w not in _known:
                _known[w] = _terms(w)
        flat += [_known[w] for w in words]
        rows.append(len(words))
        owner.append(n)
        if len(flat) > _PART:
            flush()
    flush()
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    key, n = (np.concatenate(x) for x in zip(*parts))
    return key // TERMS, key % TERMS, n


def document_frequency(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """(documents per term, documents), over all documents; each task sends one row per term at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(TERMS + 1, np.int64), 0
        for batch in batches:
            df[:TERMS] += np.bincount(counts(batch.column("text").to_pylist())[1], minlength=TERMS)
            df[TERMS] += batch.num_rows
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "n"])
    rows = docs.select(utf8(text_col).alias("text")).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(TERMS + 1, np.int64)
    for r in rows:
        df[r.term] = r.n
    return df[:TERMS], int(df[TERMS])


def decompose(rows: list[tuple[np.ndarray, np.ndarray]], dimensions: int, sweeps: int = 3) -> np.ndarray:
    """The leading right singular vectors of sparse rows (terms, weights), by randomised subspace iteration."""
    rng = np.random.default_rng(11)
    basis = rng.normal(size=(TERMS, min(dimensions + 16, len(rows)))).astype(np.float32)
    for _ in range(sweeps):
        left = np.linalg.qr(np.stack([w @ basis[t] for t, w in rows]))[0]
        basis = np.zeros_like(basis)
        for (t, w), q in zip(rows, left):
            basis[t] += w[:, None] * q
        basis = np.linalg.qr(basis)[0].astype(np.float32)
    u, s, v = np.linalg.svd(np.stack([w @ basis[t] for t, w in rows]), full_matrices=False)
    return (basis @ v.T)[:, :dimensions].astype(np.float32)


def _weights(row: np.ndarray, term: np.ndarray, n: np.ndarray, idf: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Term weights, and where each row starts: words damped and of one length per text, shapes and repeats by their share of it."""
    word = term < WORDS
    total = np.maximum(np.bincount(row[word], n[word], size), 1)
    w = np.where(word, (1 + np.log(n)) * idf[term], np.sqrt(n / total[row]) * idf[term])
    norm = np.sqrt(np.bincount(row[word], w[word] ** 2, size))
    w[word] *= WORD_WEIGHT / np.maximum(norm, 1e-9)[row[word]]
    return w.astype(np.float32), np.searchsorted(row, np.arange(size + 1))


def _project(texts: list[bytes], idf: np.ndarray, axes: np.ndarray) -> np.ndarray:
    row, term, n = counts(texts)
    w, at = _weights(row, term, n, idf, len(texts))
    out = np.zeros((len(texts), axes.shape[1]), np.float32)
    for i in np.flatnonzero(at[1:] > at[:-1]):
        a, b = at[i], at[i + 1]
        out[i] = w[a:b] @ axes[term[a:b]]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


class Model:
    """Inverse document frequencies, axes, and the labelled vectors with their labels and class weights; of bounded size."""

    def __init__(self, idf, axes, vectors, labels, weights, prior, neighbours):
        self.idf, self.axes, self.vectors, self.labels = idf, axes, vectors, labels
        self.weights, self.prior, self.neighbours = weights, prior, neighbours

    def score(self, texts: list[bytes], block: int = 512) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        k = min(self.neighbours, len(self.labels))
        for lo in range(0, len(texts) if k else 0, block):
            x = _project(texts[lo:lo + block], self.idf, self.axes)
            near = x @ self.vectors.T
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            vote = np.maximum(np.take_along_axis(near, best, 1), 0) ** 4 * self.weights[best]
            total = vote.sum(axis=1)
            some = total > 1e-9
            out[lo:lo + block][some] = ((vote * self.labels[best]).sum(axis=1)[some] / total[some])
        return np.clip(out, 0.0, 1.0)


def held_out(id_col: str) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 2 modulo 4. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        per_class: int = PER_CLASS, dimensions: int = DIMENSIONS, neighbours: int = NEIGHBOURS) -> Model:
    """A model from at most `per_class` rows of each label 0 and 1 (in order of an id hash) that are not held out.

    Document frequencies cover all of docs. Of an id that repeats with several texts one, by their hash, is learned from. Null ids, null labels and other values than 0 and 1 teach nothing; an id that
    has both labels counts as 0; without any label every score is 0.5.
    """
    df, n = document_frequency(docs, text_col)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32)
    idf[_REPEAT] = max(idf[_REPEAT], REPEAT_IDF)
    known = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).filter("_id IS NOT NULL AND _y IN (0, 1)")
             .filter(~held_out("_id")).groupBy("_id").agg(F.min("_y").alias("_y")))
    sizes = {r._y: r.n for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picks = [known.filter(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for y in (0, 1)]
    sample = F.broadcast(picks[0].union(picks[1]))  # at most 2 x per_class rows of an id and a label

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, term, c = counts(batch.column("text").to_pylist())
            w, at = _weights(row, term, c, idf, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_y"), pa.array([term[a:b] for a, b in zip(at, at[1:])], pa.list_(pa.int32())),
                 pa.array([w[a:b] for a, b in zip(at, at[1:])], pa.list_(pa.float32()))], names=["y", "terms", "weights"])
    texts = docs.select(F.col(id_col).alias("_id"), utf8(text_col).alias("text")).join(sample, "_id").groupBy("_id").agg(
        F.min("_y").alias("_y"), F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))  # one text of an id that repeats
    rows = texts.select("_y", "text").mapInArrow(run, "y int, terms array<int>, weights array<float>").toArrow()
    y = rows.column("y").to_numpy()
    if not len(y):
        return Model(idf, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), y, y, 0.5, neighbours)
    sparse = [(t.values.to_numpy(), w.values.to_numpy()) for t, w in zip(rows.column("terms"), rows.column("weights"))]
    order = sorted(range(len(y)), key=lambda i: (int(y[i]), sparse[i][0].tobytes(), sparse[i][1].tobytes()))  # however the rows came
    sparse, y = [sparse[i] for i in order], y[order].astype(np.float64)
    axes = decompose(sparse, min(dimensions, len(sparse)))
    vectors = np.stack([w @ axes[t] for t, w in sparse])
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    share = {v: sizes.get(v, 0) / max(1, (y == v).sum()) for v in (0, 1)}  # the sample takes the rarer label in full
    weights = np.where(y == 1, share[1], share[0])
    return Model(idf, axes, vectors, y, weights / weights.max(), sizes.get(1, 0) / sum(sizes.values()), neighbours)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """(id, held_out, score double, predicted int), one row per row of docs.

    Texts without words, or like no labelled row, get the share of label 1 among the labels.
    """
    rows = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text"))
    schema = rows.select("id", F.lit(0.0).alias("score")).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: TERMS x DIMENSIONS and 2 x PER_CLASS x DIMENSIONS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(shared.value.score(batch.column("text").to_pylist()))], names=["id", "score"])
    return rows.mapInArrow(run, schema).select("id", held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

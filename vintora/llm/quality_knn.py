"""Quality classifier by nearest-neighbour voting over latent-semantic vectors.

Fitting uses a bounded sample of labelled rows, ``per_class`` per label, drawn by a hash of the id. Their texts are
counted into a fixed number of terms: pairs of neighbouring character classes, weighted by inverse document frequency, and grades
of statistics of the words and lines, a term for each side of each grade. The whole matrix of documents by terms is reduced by a
truncated singular value decomposition; nothing but its latent coordinates is compared. Model and labelled vectors have a fixed size, so
they are broadcast. Every document is reduced the same way, compared with all labelled vectors by exact cosine in
blocks, and its nearest neighbours vote with their similarity.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintora.llm.common import ship

CLASSES = 64
PAIRS = CLASSES * CLASSES
LEVELS = np.array([0.02, 0.05, 0.1, 0.2, 0.3, 0.45, 0.6, 0.8, 0.95])
STATS = 9
GRADES = STATS * len(LEVELS)
GRADE_WEIGHT = 2.0  #: length of a document's grade terms against that of its pairs
SPARE = 32  #: directions iterated beside those that are kept
NOISE = 1e-3  #: singular values below this share of the largest are none
BLOCK = 512  #: documents compared at once


def _class_table() -> np.ndarray:
    """Class of each UTF-8 byte: letters one by one, capitals together, digits together, signs one by one."""
    table = np.zeros(256, dtype=np.int16)
    for b in range(256):
        c = chr(b)
        if "a" <= c <= "z":
            table[b] = 1 + b - 97
        elif "A" <= c <= "Z":
            table[b] = 27
        elif "0" <= c <= "9":
            table[b] = 28
        elif c in " \t\r\x0b\f":
            table[b] = 29
        elif c == "\n":
            table[b] = 30
        elif 33 <= b < 127:
            table[b] = 31 + (b - 33) % 24
        elif b >= 128:
            table[b] = 55 + b % 9
    return table


TABLE = _class_table()


def text_terms(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Counts of class pairs, and grades of the statistics as 0/1 steps; both of fixed size, empty texts included."""
    data = text.encode()
    raw = np.frombuffer(data, dtype=np.uint8)
    kind = TABLE[raw]
    pairs = np.bincount(kind[:-1] * CLASSES + kind[1:], minlength=PAIRS) if len(raw) > 1 else np.zeros(PAIRS, np.int64)
    words = data.split()
    n, size = max(len(words), 1), max(len(raw), 1)
    singles = np.bincount(kind, minlength=CLASSES) if len(raw) else np.zeros(CLASSES, np.int64)
    lines = [x for x in data.split(b"\n") if x]
    twice = sum(a == b for a, b in zip(words, words[1:]))
    stats = np.array(
        [
            min(len(words), 1000) / 1000,
            twice / n,
            len(set(words)) / n,
            singles[27] / size,
            singles[28] / size * 5,
            singles[31:55].sum() / size * 2,
            len(set(lines)) / max(len(lines), 1),
            min(len(lines) / n * 10, 1),
            min(size / n / 20, 1),
        ]
    )
    return pairs, (stats[:, None] > LEVELS[None, :]).ravel().astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Fitted reduction and labelled vectors; its size depends on the parameters alone."""

    idf: np.ndarray
    mean: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int


def _weigh(pairs: np.ndarray, grades: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of the term matrix: weighted pairs at length one, then both sides of each grade at twice that length."""
    x = np.log1p(pairs).astype(np.float32) * idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    return np.hstack([x, np.hstack([grades, 1 - grades]) * np.float32(GRADE_WEIGHT / np.sqrt(GRADES))])


def _latent(x: np.ndarray, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Coordinates of the rows in the latent space, around the sample's mean, scaled to length one."""
    z = ((x - mean) @ basis).astype(np.float32)
    return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)


def fit(pairs: np.ndarray, grades: np.ndarray, labels: np.ndarray, dims: int, neighbours: int) -> Model:
    """Inverse document frequencies, truncated SVD by subspace iteration with a fixed start, labelled vectors."""
    idf = np.log((1 + len(pairs)) / (1 + (pairs > 0).sum(axis=0))).astype(np.float32) + 1
    x = _weigh(pairs, grades, idf)
    mean = x.mean(axis=0)
    centred = x - mean
    rank = max(1, min(dims + SPARE, *x.shape))
    q = np.linalg.qr(centred.T @ np.random.default_rng(7).standard_normal((len(x), rank)).astype(np.float32))[0]
    for _ in range(4):
        q = np.linalg.qr(centred.T @ (centred @ q))[0]
    _, sizes, turn = np.linalg.svd(centred @ q, full_matrices=False)
    basis = (q @ turn.T[:, sizes > NOISE * sizes[0]][:, :dims]).astype(np.float32)
    return Model(idf, mean, basis, _latent(x, mean, basis), labels.astype(np.float32), min(neighbours, len(labels)))


def vote(model: Model, pairs: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """Score of each document: share of label 1 among its nearest labelled vectors, by similarity."""
    cosine = _latent(_weigh(pairs, grades, model.idf), model.mean, model.basis) @ model.vectors.T
    k = model.neighbours
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k] if k < cosine.shape[1] else np.tile(np.arange(k), (len(cosine), 1))
    weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-6).astype(np.float64) ** 4
    return (weight * model.labels[near]).sum(axis=1) / weight.sum(axis=1)


def held_out(doc_id) -> Column:
    """Rows never learnt from: checksum of the id as text divisible by five; null ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1536, dims: int = 64, neighbours: int = 15) -> Model | None:
    """Model from at most ``per_class`` labelled rows of each quality; None without labelled rows.

    Null labels are left out; an id labelled more than once counts with its smallest label.
    """
    ship(docs.sparkSession)
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    drawn = [
        known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for q in (0, 1)
    ]
    sample = drawn[0].union(drawn[1]).select(F.col("doc_id").alias("_l_id"), F.col("quality").cast("int").alias("_quality"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_terms(t.as_py() or "") for t in batch.column(0)]
            packed = [zlib.compress(np.append(p, g).astype("<i4").tobytes(), 1) for p, g in rows]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column(1), batch.column(2)], ["terms", "quality", "doc_id"])

    # one text for each drawn label: repeated rows of an id would outweigh the bound
    texts = (
        docs.join(F.broadcast(sample), docs["doc_id"] == F.col("_l_id"))
        .groupBy("_l_id", "_quality")
        .agg(F.min("text").alias("_t"))
        .select("_t", "_quality", "_l_id")
    )
    rows = texts.mapInArrow(count, "terms binary, quality int, doc_id long").orderBy("doc_id").collect()  # 2 * per_class rows at most
    if not rows:
        return None
    matrix = np.stack([np.frombuffer(zlib.decompress(r["terms"]), dtype="<i4") for r in rows])
    return fit(matrix[:, :PAIRS], matrix[:, PAIRS:].astype(np.float32), np.array([r["quality"] for r in rows]), dims, neighbours)


def _scores(model: Model | None, texts: pa.Array) -> np.ndarray:
    scores = np.ones(len(texts))
    for a in range(0, len(texts) if model else 0, BLOCK):
        terms = [text_terms(t.as_py() or "") for t in texts.slice(a, BLOCK)]
        scores[a : a + len(terms)] = vote(model, np.stack([p for p, _ in terms]), np.stack([g for _, g in terms]))
    return scores


def score_documents(docs: DataFrame, model: Model | None, cut: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``, plus the row's text hash ``_text``.

    Null and empty texts are scored by their (empty) statistics. Without a model every score is 1.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _scores(shared.value, batch.column(3))
            out = [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= cut).astype(np.int32)), batch.column(2)]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "held_out", "score", "predicted", "_text"])

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.xxhash64("text").alias("_text"), "text"
    )
    return source.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int, _text long")


def classify(docs: DataFrame, labels: DataFrame, per_class: int = 1536, cut: float = 0.3) -> DataFrame:
    """Fit on the labelled rows that are not held out and score every row of ``docs``."""
    return score_documents(docs, train(docs, labels, per_class), cut)


def keep_documents(docs: DataFrame, labels: DataFrame, per_class: int = 1536, cut: float = 0.3) -> DataFrame:
    """The rows of ``docs`` predicted as good, with all their columns; rows are dropped where they are scored."""
    model = train(docs, labels, per_class)
    spark = docs.sparkSession
    ship(spark)
    shared, text = spark.sparkContext.broadcast(model), docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(shared.value, batch.column(text)) >= cut))

    return docs.mapInArrow(keep, docs.schema)

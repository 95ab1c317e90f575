"""Ranked lexical search by dual-tree traversal.

Items and documents are sparse vectors of terms, a score is their inner product: an item's term counts times the terms'
weights, and a document's saturated term frequencies. Both sides form trees by repeated halving, whose nodes hold the
maximum of every coordinate below them. A pair of nodes is bounded by the product of their maxima; where that is less than
the weakest k-th score among the node's items, all its documents are passed over for all its items, exactly.

1. Texts are split once; what a document shares with the items' vocabulary, and the counts of all terms, go to storage.
2. Each task streams its documents in blocks, builds a tree of each and descends it together with the items' tree.
3. The best of every task are merged by windowed selection.

Items are dealt into blocks of a bounded number of terms; a block's vocabulary and tree are all that is broadcast.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintora.llm.common import ship
from vintora.llm.topk import TopK
from vintora.sources.workspace import materialise

BLOCK_TERMS = 200_000  #: terms of an item block, about
DOC_BLOCK = 1024  #: documents of a tree
BLOCK_CELLS = 8_000_000  #: documents times terms of a tree
DOC_LEVELS, ITEM_LEVELS = (128, 16), (32, 4)  #: rows of a node below the root, by level
BUCKETS = 64
TOP = 1_000_000_000


def _separators() -> bytes:
    """A-Z lower-cased, every other ASCII byte but letters and digits a blank."""
    return bytes(
        b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
    )


TABLE = _separators()


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other characters beyond ASCII; none for null."""
    return text.translate(TABLE).split() if text else []


def _halved(rows: np.ndarray, leaf: int) -> np.ndarray:
    """Order in which neighbours are alike: the rows are split between two far ones, and so on down to ``leaf``."""
    if len(rows) <= leaf:
        return np.arange(len(rows))
    first = rows[np.argmin(rows @ rows.mean(axis=0))]
    second = rows[np.argmin(rows @ first)]
    order = np.argsort(rows @ (first - second), kind="stable")
    middle = leaf * (-(-len(rows) // leaf) // 2 or 1)
    parts = order[:middle], order[middle:]
    return np.concatenate([p[_halved(rows[p], leaf)] for p in parts])


def _projected(row: np.ndarray, term: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Rows of length one over a few buckets of terms."""
    out = np.bincount(row * BUCKETS + term % BUCKETS, weights=value, minlength=n * BUCKETS).reshape(n, BUCKETS)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def _maxima(rows: np.ndarray, width: int) -> np.ndarray:
    """Coordinate maxima of each ``width`` neighbouring rows."""
    return np.maximum.reduceat(rows, np.arange(0, len(rows), width), axis=0)


@dataclass(frozen=True)
class Items:
    """A block of items: names, vocabulary and weighted counts; its size is bounded by the block's terms."""

    names: list
    vocabulary: dict[bytes, int]
    row: np.ndarray
    term: np.ndarray
    count: np.ndarray


class _ItemTree:
    """Items in tree order with their weighted coordinates and the maxima of each level, root first."""

    def __init__(self, items: Items, weights: np.ndarray):
        n, value = len(items.names), items.count * weights[items.term]
        self.order = _halved(_projected(items.row, items.term, value.astype(float), n), ITEM_LEVELS[-1])
        place = np.empty(n, dtype=np.int64)
        place[self.order] = np.arange(n)
        row = place[items.row]
        order = np.lexsort((items.term, row))
        self.n, self.row, self.term, self.value = n, row[order], items.term[order], value[order]
        sums = np.bincount(self.row, weights=self.value, minlength=n)
        self.kind = np.float64 if sums.max(initial=0) * 1e6 < 2.0**53 else np.int64

    def dense(self, columns: np.ndarray) -> np.ndarray:
        """Coordinates of all items in the given ascending terms."""
        at = np.minimum(np.searchsorted(columns, self.term), len(columns) - 1)
        here = columns[at] == self.term
        out = np.zeros((self.n, len(columns)), dtype=np.float32)
        out[self.row[here], at[here]] = np.nextafter(self.value[here].astype(np.float32), np.float32(np.inf))
        return out

    def exact(self, first: int, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions among ``columns`` of the terms of a leaf's items, and their coordinates."""
        a, b = np.searchsorted(self.row, [first, min(first + ITEM_LEVELS[-1], self.n)])
        present = np.intersect1d(self.term[a:b], columns)
        at = np.minimum(np.searchsorted(present, self.term[a:b]), max(len(present) - 1, 0))
        out = np.zeros((min(ITEM_LEVELS[-1], self.n - first), len(present)), dtype=self.kind)
        if len(present):
            here = present[at] == self.term[a:b]
            out[self.row[a:b][here] - first, at[here]] = self.value[a:b][here]
        return np.searchsorted(columns, present), out


def _search_block(tree: _ItemTree, best: TopK, docs: np.ndarray, row: np.ndarray, term: np.ndarray, impact: np.ndarray) -> int:
    """Meet a block of documents with all items; returns how many pairs of leaves were scored."""
    columns, at = np.unique(term, return_inverse=True)
    order = _halved(_projected(row, term, impact.astype(float), len(docs)), DOC_LEVELS[-1])
    place = np.empty(len(docs), dtype=np.int64)
    place[order] = np.arange(len(docs))
    dense = np.zeros((len(docs), len(columns)), dtype=np.float32)  # impacts stay below 2**24
    dense[place[row], at] = impact
    docs = docs[order]
    coordinates = tree.dense(columns)
    slack = np.float32(1 + (len(columns) + 8) * 2.0**-23)
    doc_leaves = _maxima(dense, DOC_LEVELS[-1])
    item_leaves = _maxima(coordinates, ITEM_LEVELS[-1])
    weakest = np.minimum.reduceat(best.least, np.arange(0, tree.n, ITEM_LEVELS[-1])).astype(np.float64)

    def open_pairs(items: np.ndarray, documents: np.ndarray, least: np.ndarray) -> np.ndarray:
        bound = (items @ documents.T) * slack
        return (bound > 0) & (bound >= least[:, None] * (1 - 2.0**-22))

    di, ii = DOC_LEVELS[0] // DOC_LEVELS[1], ITEM_LEVELS[0] // ITEM_LEVELS[1]
    upper_docs, upper_items = _maxima(doc_leaves, di), _maxima(item_leaves, ii)
    upper_least = np.minimum.reduceat(weakest, np.arange(0, len(weakest), ii))
    if not open_pairs(upper_items.max(axis=0)[None], upper_docs.max(axis=0)[None], upper_least.min()[None])[0, 0]:
        return 0
    opened = open_pairs(upper_items, upper_docs, upper_least)
    leaf_open = np.repeat(np.repeat(opened, ii, axis=0)[: len(item_leaves)], di, axis=1)[:, : len(doc_leaves)]
    some_items, some_docs = np.flatnonzero(leaf_open.any(axis=1)), np.flatnonzero(leaf_open.any(axis=0))
    grid = np.ix_(some_items, some_docs)
    leaf_open[grid] &= open_pairs(item_leaves[some_items], doc_leaves[some_docs], weakest[some_items])
    scored = 0
    for leaf in np.flatnonzero(leaf_open.any(axis=1)):
        first = leaf * ITEM_LEVELS[-1]
        positions, weights = tree.exact(first, columns)
        nodes = np.flatnonzero(leaf_open[leaf])
        rows = (nodes[:, None] * DOC_LEVELS[-1] + np.arange(DOC_LEVELS[-1])).ravel()
        rows = rows[rows < len(docs)]
        score = (dense[np.ix_(rows, positions)].astype(tree.kind) @ weights.T).astype(np.int64)
        r, i = np.nonzero((score > 0) & (score >= best.least[first : first + weights.shape[0]]))
        best.add(i + first, score[r, i], docs[rows[r]])
        scored += len(nodes)
    return scored


STORED_DDL = "doc_id long, n long, terms binary, counts binary, texts long"


def _stored(docs: DataFrame, items) -> DataFrame:
    """One row per document with a term of the vocabulary, and one per task with the counts of all its documents.

    The latter has the number of documents per term, all terms ``n``, and documents with a term ``texts``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = items.value.vocabulary
        holding = np.zeros(len(number), dtype=np.int64)
        all_terms = texts = 0
        names = ["doc_id", "n", "terms", "counts", "texts"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
        rows: list[tuple] = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms_of(text.as_py())
                all_terms, texts = all_terms + len(words), texts + bool(words)
                known = np.fromiter((k for k in map(number.get, words) if k is not None), dtype=np.int32)
                if not len(known):
                    continue
                terms, counts = np.unique(known, return_counts=True)
                holding[terms] += 1
                if doc_id is not None:
                    rows.append((doc_id, len(words), terms.tobytes(), counts.astype(np.int32).tobytes(), None))
                if len(rows) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows = []
        held = np.flatnonzero(holding)
        rows.append((None, all_terms, held.astype(np.int32).tobytes(), holding[held].tobytes(), texts))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return materialise(source.mapInArrow(run, STORED_DDL), "lexical-rows")


def _holding(totals: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary, added up from the tasks' counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                columns = [np.frombuffer(held, np.int32).astype(np.int64), np.frombuffer(counts, np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["term", "n"])

    rows = totals.select("terms", "counts").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(terms, dtype=np.int64)
    for r in rows.collect():  # one row per term of the block's bounded vocabulary
        out[r["term"]] = r["n"]
    return out


def _impacts(counts: np.ndarray, n: np.ndarray, texts: int, all_terms: int) -> np.ndarray:
    """Saturated frequencies of terms in documents of ``n`` terms, in millionths."""
    share = np.array([25 * x * texts // all_terms for x in n.tolist()], dtype=np.int64)
    tf = counts.astype(np.int64)
    return TOP * tf // (1000 * tf + 12 * (100 - 25 + share))


def _search(stored: DataFrame, shared, k: int) -> DataFrame:
    """Best ``k`` documents of each item among those of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, texts, all_terms = shared.value
        tree = _ItemTree(items, weights)
        best = TopK(tree.n, k, distinct=False)
        for batch in batches:
            docs, lengths = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            terms = [np.frombuffer(t, np.int32) for t in batch.column(2).to_pylist()]
            counts = [np.frombuffer(t, np.int32) for t in batch.column(3).to_pylist()]
            a = 0
            while a < len(docs):
                b, entries = a, 0
                while b < len(docs) and b - a < DOC_BLOCK:
                    entries += len(terms[b])
                    b += 1
                    if (b - a) * min(entries, len(items.vocabulary)) > BLOCK_CELLS:
                        break
                sizes = [len(t) for t in terms[a:b]]
                row, flat = np.repeat(np.arange(b - a), sizes), np.concatenate(terms[a:b]).astype(np.int64)
                impact = _impacts(np.concatenate(counts[a:b]), np.repeat(lengths[a:b], sizes), texts, all_terms)
                _search_block(tree, best, docs[a:b], row, flat, impact)
                a = b
        item, ids, scores = best.found()
        if len(item):
            columns = [tree.order[item].astype(np.int64), ids, scores]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["item", "doc_id", "score"])

    rows = stored.where(F.col("texts").isNull()).select("doc_id", "n", "terms", "counts")
    return rows.mapInArrow(run, "item long, doc_id long, score long")


def _item_terms(items: DataFrame) -> DataFrame:
    """``_key, item_id, term, n`` of every item; items equal in id and text are one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, item_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                counts = Counter(terms_of(text))
                columns = [[key] * len(counts), [item_id] * len(counts), list(counts), list(counts.values())]
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["_key", "item_id", "term", "n"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")).distinct()
    return rows.select(F.xxhash64("item_id", "text").alias("_key"), "*").mapInArrow(run, "_key long, item_id long, term binary, n long")


def _blocks(items: DataFrame) -> Iterator[Items]:
    terms = materialise(_item_terms(items), "item-terms")
    blocks = -(-terms.count() // BLOCK_TERMS)
    for b in range(blocks):
        part = terms.where(F.pmod(F.xxhash64("_key"), F.lit(blocks)) == b).orderBy("_key", "term").collect()  # a block's terms
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in part}))}
        number: dict[tuple, int] = {}
        row = [number.setdefault((r["_key"], r["item_id"]), len(number)) for r in part]
        if part:
            yield Items(
                [name for _, name in number],
                vocabulary,
                np.array(row, dtype=np.int64),
                np.array([vocabulary[bytes(r["term"])] for r in part], dtype=np.int64),
                np.array([r["n"] for r in part], dtype=np.int64),
            )


def term_weights(texts: int, holding: np.ndarray) -> np.ndarray:
    """Rare terms weigh more: thousandths of a natural logarithm, rounded down."""
    return np.floor(1000 * np.log((2 * texts + 2) / (2 * holding + 1))).astype(np.int64)


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best of ``docs`` for every row of ``items``, whole texts on both sides.

    Scores above 0 only; equal scores by ascending ``doc_id``. Null texts hold no term. Repeated rows of ``docs`` are documents
    of their own; rows without an id count in the statistics and are not ranked. Items equal in id and text are one,
    items with the same id and other texts are ranked apart. Without terms on either side the result is empty.
    """
    spark = docs.sparkSession
    ship(spark)
    parts = []
    for block in _blocks(items):
        stored = _stored(docs, spark.sparkContext.broadcast(block))
        totals = stored.where(F.col("texts").isNotNull())
        texts, all_terms = totals.agg(F.sum("texts"), F.sum("n")).first()
        if not all_terms:
            continue
        weights = term_weights(texts, _holding(totals, len(block.vocabulary)))
        found = _search(stored, spark.sparkContext.broadcast((block, weights, texts, all_terms)), k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"))
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(block.names)), "_item long, item_id long")
        parts.append(best.join(F.broadcast(names), F.col("item") == F.col("_item")).select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, parts)

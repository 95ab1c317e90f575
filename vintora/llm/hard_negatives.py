"""Hard-negative mining by exact integer inner products in a residue number system.

Components are integers. Anchors and rows are multiplied modulo several small primes in single precision, where every
partial sum is exact, and Chinese remaindering gives the signed scores back. The number of primes follows from the
largest norm, so no score is ever rounded.

Anchors form groups and rows form parts; a group meets a part in one task, which holds the group and streams the part.
A first product finds each anchor's positives, a second one its negatives in the windows that the positives' scores set.
Only the best few leave a task; windowed selection merges them. The work is that of all anchors against all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintora.llm.common import ship
from vintora.llm.topk import TopK
from vintora.sources.workspace import materialise

PRIMES = (251, 241, 239, 233, 229, 227, 223, 211, 199)
DEPTH = 128  #: components of one partial product: below 2**21 in size, where reducing by rounding is exact
GROUP_ANCHORS = 16_384
PART_ROWS = 262_144  #: rows of a part, about, on large tables; smaller ones are dealt over all cores
TILE = 512, 2048  #: anchors and rows multiplied at once
MAX_NORM = 2.0**62


def primes_for(bound: int) -> tuple[int, ...]:
    """Primes whose product tells apart all integers from ``-bound`` to ``bound``."""
    product, n = 1, 0
    while product <= 2 * bound:
        product *= PRIMES[n]
        n += 1
    return PRIMES[: max(n, 1)]


def residues(vectors: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    """Signed residues of integer rows, one matrix for each prime."""
    return [((vectors + p // 2) % p - p // 2).astype(np.float32) for p in primes]


def _reduce(x: np.ndarray, p: int) -> np.ndarray:
    """Signed residues of integers below 2**21 in size, in place."""
    x -= np.rint(x * np.float32(1 / p)) * np.float32(p)
    return x


def products(left: list[np.ndarray], right: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """Exact inner products of all left and right rows from their residues."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        width = left[k].shape[1]
        total = np.zeros((len(left[k]), len(right[k])), dtype=np.float32)
        for a in range(0, width, DEPTH):
            total += _reduce(left[k][:, a : a + DEPTH] @ right[k][:, a : a + DEPTH].T, p)
            if a:
                total = _reduce(total, p)
        for q, digit in zip(primes, digits):  # mixed-radix digits, each a signed residue
            total -= digit
            total = _reduce(_reduce(total, p) * np.float32(pow(q, -1, p)), p)
        digits.append(total)
    out = digits[-1].astype(np.int64)
    for p, digit in zip(primes[-2::-1], digits[-2::-1]):
        out *= p
        out += digit.astype(np.int64)
    return out


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, label, q`` of the rows that take part: ``q`` has ``floor(scale * x)`` for every component.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part.
    """
    value = lambda x: x.cast("double")
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(value(x)) & (F.abs(value(x)) < float("inf")))
    taking = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
    return taking.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(value(x) * scale)).alias("q"),
    )


def _by_length(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and matrix of the rows of each length."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, flat[starts[at][:, None] + np.arange(n)]


class _Group:
    """Anchors of one group and length, with what has been found for them."""

    def __init__(self, keys, ids, labels, vectors, windows, primes, k):
        self.keys, self.ids, self.labels = keys, ids, labels
        self.residues, self.windows = residues(vectors, primes), windows
        self.best = TopK(len(keys) * (1 if windows is None else windows.shape[1]), k, distinct=True)

    def meet(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, primes: tuple[int, ...]) -> None:
        right = residues(vectors, primes)
        for a in range(0, len(self.ids), TILE[0]):
            part = slice(a, a + TILE[0])
            score = products([r[part] for r in self.residues], right, primes)
            same, other = self.labels[part][:, None] == labels, self.ids[part][:, None] != ids
            if self.windows is None:
                row, column = np.nonzero(same & other & (score >= self.best.least[part][:, None]))
                self.best.add(row + a, score[row, column], ids[column])
                continue
            slots = self.windows.shape[1]
            for slot in range(slots):
                low, high = self.windows[part, slot].T
                low = np.maximum(low, self.best.least[slot::slots][part])
                row, column = np.nonzero(~same & other & (score >= low[:, None]) & (score <= high[:, None]))
                self.best.add((row + a) * slots + slot, score[row, column], ids[column])


FOUND_DDL = "anchor_key long, anchor_id long, slot int, vec_id long, score long"


def _products(primes: tuple[int, ...], k: int) -> Callable:
    """Best ``k`` rows of each anchor, or of each window of an anchor, within a part."""

    def flush(groups: dict[int, _Group]) -> Iterator[pa.RecordBatch]:
        for group in groups.values():
            row, ids, scores = group.best.found()
            slots = 1 if group.windows is None else group.windows.shape[1]
            columns = [group.keys[row // slots], group.ids[row // slots], (row % slots).astype(np.int32), ids, scores]
            if len(row):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in FOUND_DDL.split(", ")])

    def gathered(held: list[pa.RecordBatch]) -> dict[int, _Group]:
        groups = {}
        table = pa.Table.from_batches(held).combine_chunks().to_batches()
        for batch in table:
            keys, ids, labels = (batch.column(n).to_numpy() for n in ("anchor_key", "vec_id", "label"))
            bounds = batch.column("windows").to_pylist()
            slots = max((len(b) // 2 for b in bounds if b is not None), default=0)
            windows = None
            if slots:
                windows = np.array([b + [1, 0] * (slots - len(b) // 2) for b in bounds], dtype=np.int64).reshape(-1, slots, 2)
            for at, vectors in _by_length(batch.column("q")):
                chosen = None if windows is None else windows[at]
                groups[vectors.shape[1]] = _Group(keys[at], ids[at], labels[at], vectors, chosen, primes, k)
        return groups

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, groups, held = None, {}, []
        for batch in batches:
            marks = np.stack([batch.column(n).to_numpy().astype(np.int64) for n in ("grp", "part", "is_row")], axis=1)
            cuts = np.flatnonzero(np.any(marks[1:] != marks[:-1], axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(marks)]):
                here, is_row = tuple(marks[a][:2]), marks[a][2]
                if here != place:
                    yield from flush(groups)
                    place, groups, held = here, {}, []
                if not is_row:
                    held.append(batch.slice(a, b - a))
                    continue
                if held:
                    groups, held = gathered(held), []
                for c in range(a, b, TILE[1]):
                    rows = batch.slice(c, min(TILE[1], b - c))
                    ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
                    for at, vectors in _by_length(rows.column("q")):
                        if vectors.shape[1] in groups:
                            groups[vectors.shape[1]].meet(ids[at], labels[at], vectors, primes)
        yield from flush(groups)

    return run


def _met(rows: DataFrame, anchors: DataFrame, sizes: tuple[int, int], primes: tuple[int, ...], k: int) -> DataFrame:
    """Candidates of all anchors (``anchor_key, vec_id, label, q, windows``), ``k`` at most for each part and window."""
    groups, parts = sizes
    numbered = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    vector = F.col("q").cast("array<int>").alias("q")
    left = anchors.select(
        F.pmod("anchor_key", F.lit(groups)).cast("int").alias("grp"), numbered(parts).alias("part"), F.lit(0).alias("is_row"),
        "anchor_key", "vec_id", "label", vector, "windows",
    )
    dealt = F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("int")  # not by id, which may repeat
    right = rows.select(
        numbered(groups).alias("grp"), dealt.alias("part"), F.lit(1).alias("is_row"),
        F.lit(None).cast("long").alias("anchor_key"), "vec_id", "label", vector, F.lit(None).cast("array<long>").alias("windows"),
    )
    both = left.unionByName(right).repartition("grp", "part").sortWithinPartitions("grp", "part", "is_row")
    return both.mapInArrow(_products(primes, k), FOUND_DDL)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """``found`` with ``rank`` up to ``k`` within an anchor's slot; candidates of different parts are merged."""
    order = Window.partitionBy("anchor_key", "slot").orderBy(F.desc("score"), F.asc("vec_id"))
    single = found.repartition("anchor_key", "slot").distinct()
    return single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``, for the rows of ``vectors``.

    ``vectors`` has ``vec_id``, ``embedding`` and ``label``. A row's score is its inner product with the anchor, both as
    ``integer_vectors``. An anchor's positives are its best rows of the same label, its negatives those of other labels
    with ``low * positive <= 100 * negative <= high * positive``; ties go to the smaller id. Rows with
    the anchor's own id are neither; rows that repeat an id with the same score count once. Vectors of other lengths than the anchor's are no candidates. An anchor without
    a positive or a negative gives no row, an empty table an empty result. Norms whose square reaches 2**62 fail the job, because
    scores would not fit.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = materialise(integer_vectors(vectors, scale), "integer-vectors")
    norm = F.aggregate("q", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    total, chosen, largest = rows.agg(F.count(F.lit(1)), F.count_if(is_anchor), F.max(norm)).first()
    if (largest or 0.0) >= MAX_NORM:
        raise ArithmeticError(f"squared norm {largest:.3g}: scores do not fit 64 bits")
    primes = primes_for(int(largest or 0) + 1)
    cores = 2 * spark.sparkContext.defaultParallelism
    parts = max(-(-total // PART_ROWS), min(cores, -(-total // TILE[1])), 1)
    sizes = max(-(-chosen // GROUP_ANCHORS), 1), parts
    key = F.xxhash64("vec_id", "label", "q")
    anchors = materialise(rows.where(is_anchor).withColumn("anchor_key", key).dropDuplicates(["anchor_key", "vec_id"]), "anchors")
    none = F.lit(None).cast("array<long>")
    best = _ranked(_met(rows, anchors.withColumn("windows", none), sizes, primes, positives), positives)
    best = materialise(best.drop("slot"), "positives")
    rest = F.pmod(F.col("score"), F.lit(100))  # score = 100 * whole + rest, so that no product overflows
    whole = F.expr("(score - pmod(score, 100L)) div 100L")
    window = F.struct(
        F.col("rank"),
        (low * whole - F.floor(-low * rest / 100)).cast("long").alias("least"),
        (high * whole + F.floor(high * rest / 100)).cast("long").alias("most"),
    )
    listed = best.groupBy(F.col("anchor_key").alias("_key")).agg(F.array_sort(F.collect_list(window)).alias("_windows"))
    bounds = F.flatten(F.transform("_windows", lambda w: F.array(w["least"], w["most"])))
    windowed = anchors.join(listed, F.col("anchor_key") == F.col("_key")).withColumn("windows", bounds).drop("_key", "_windows")
    mined = _ranked(_met(rows, windowed, sizes, primes, negatives), negatives)
    of = best.select(
        F.col("anchor_key").alias("_key"), (F.col("rank") - 1).alias("_slot"),
        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    return mined.join(of, (F.col("anchor_key") == F.col("_key")) & (F.col("slot") == F.col("_slot"))).select(
        *["anchor_id", "positive_id", "rank"],
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )

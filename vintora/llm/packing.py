"""Best-fit packing planned on the histogram of lengths.

Texts are encoded once and cut into pieces. Only the count of pieces per length reaches the planner: best-fit
decreasing runs over counts, so its work depends on the sequence length alone. Each planned run of slots
holds a range of ranks; a piece finds its slot by its rank among the pieces of its length.

Ranks need no shuffle of rows: a task numbers the pieces of each length as it writes them, and per task
and length one offset is added later. The hottest length is therefore never gathered anywhere.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintora.llm import bpe
from vintora.llm.common import ship
from vintora.operators.inline_tables import inline_table
from vintora.sources.workspace import materialise

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("task", pa.int32()),
        ("task_rank", pa.int64()),
    ]
)
OUT_TOKENS = 2_000_000  #: tokens of an output batch, about


def encode_pieces(docs: DataFrame, max_tokens: int = 1024, end_id: int = 2, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: ids as little-endian unsigned 32-bit integers, written once to shared storage.

    A text's ids are followed by ``end_id``. Only longer ones are cut, from the end, so that every piece but
    the first is full. Null text counts as empty. Every row of ``docs`` is a document of its own,
    repeated ids included.
    """
    path = tokenizer or bpe.tokenizer_path()
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = bpe.load(path), TaskContext.get().partitionId()
        ranks = np.zeros(max_tokens + 1, dtype=np.int64)
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = np.array([*encoder.encode(text.as_py() or ""), end_id], dtype="<u4")
                first = (len(ids) - 1) % max_tokens + 1
                cuts = [0, *range(first, len(ids) + 1, max_tokens)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc_id.as_py(), piece, a, b - a, ids[a:b].tobytes(), task, int(ranks[b - a])))
                    ranks[b - a] += 1
                held += len(ids)
                if held >= OUT_TOKENS:
                    yield flush()
                    rows, held = [], 0
        if rows:
            yield flush()

    schema = "doc_id long, piece int, start long, length long, ids binary, task int, task_rank long"
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return materialise(source.mapInArrow(run, schema), "pieces")


def plan_slots(counts: Mapping[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, rank_from, rank_to, per_bin, first_sequence, offset).

    Bins that hold the same tokens are one run of sequence numbers, so a run is split at most twice per length
    and the plan's size is bounded by ``capacity``.
    """
    runs: dict[int, list[tuple[int, int]]] = {}
    room: list[int] = []
    slots: list[tuple[int, int, int, int, int, int]] = []
    opened = 0

    def put(space: int, first: int, n: int) -> None:
        if n and space:
            if space not in runs:
                runs[space] = []
                insort(room, space)
            runs[space].append((first, n))

    for length in sorted((k for k, v in counts.items() if v), reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(room, length)
            if at == len(room):
                per = capacity // length
                space, first, n = capacity, opened, -(-left // per)
                opened += n
            else:
                space = room[at]
                first, n = runs[space].pop()
                if not runs[space]:
                    del runs[space]
                    room.pop(at)
                per = space // length
            full = min(n, left // per)
            if full:
                used = full
                slots.append((length, rank, rank + full * per, per, first, capacity - space))
                put(space - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            else:
                used = 1
                slots.append((length, rank, rank + left, left, first, capacity - space))
                put(space - left * length, first, 1)
                rank, left = rank + left, 0
            if space < capacity or left == 0:
                put(space, first + used, n - used)
            else:  # the last bin of those just opened takes what is left
                slots.append((length, rank, rank + left, left, first + used, 0))
                put(space - left * length, first + used, 1)
                left = 0
    return slots


def place_pieces(pieces: DataFrame, max_tokens: int = 1024) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; no row is dropped or doubled.

    The histogram has ``max_tokens`` rows at most and so has a bounded plan, the only thing broadcast. Other
    columns travel along, so drop ``ids`` first where only places are wanted. An empty input gives an empty result.
    """
    spark = pieces.sparkSession
    per_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = plan_slots(counts, max_tokens) or [(0, 0, 0, 1, 0, 0)]
    plan = inline_table(spark, "slot_length, rank_from, rank_to, per_bin, first_sequence, slot_offset", slots)
    ranked = pieces.join(offsets, ["task", "length"]).withColumn("rank", F.col("base") + F.col("task_rank"))
    at = F.col("rank") - F.col("rank_from")
    inside = (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    return ranked.join(F.broadcast(plan), (F.col("length") == F.col("slot_length")) & inside).select(
        *[c for c in pieces.columns if c not in ("task", "task_rank")],
        (F.col("first_sequence") + F.floor(at / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("slot_offset") + (at % F.col("per_bin")) * F.col("length")).cast("long").alias("offset"),
    )


def sequences(placed: DataFrame) -> DataFrame:
    """Packed training rows from placed pieces with ``ids``: ``sequence_id`` and its ids in order, at most a full sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.array_join(F.transform(parts, lambda p: F.hex(p["ids"])), "")
    return placed.groupBy("sequence_id").agg(F.unhex(joined).alias("ids"))


def pack(docs: DataFrame, max_tokens: int = 1024, end_id: int = 2, tokenizer: str | None = None) -> DataFrame:
    """Pieces of all documents with their checksum and place, one row per piece."""
    pieces = encode_pieces(docs, max_tokens, end_id, tokenizer)
    checked = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place_pieces(checked, max_tokens).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )

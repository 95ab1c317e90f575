"""Vector bin packing of training examples under limits on tokens, segments and loss-bearing tokens.

A sequence is filled by the dot-product heuristic: of the kinds of examples (tokens, loss-bearing tokens) that still fit,
the one is placed whose demand has the largest weighted product with the room that is left in all three dimensions.
Weights are the total demands in sequences, so the scarce dimension rules. What no whole example fits any more is filled
with a piece of one that is too long anyway, else of the longest left.

Every task packs what it reads, in groups of a bounded number of tokens, so nothing is shuffled or gathered; all that
grows with the input is the number of groups. A group leaves one sequence that is not full. Where sequences of a power of
two need no padding, it is cut into such, one for each bit of its length.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.llm import word_bpe
from vintora.llm.common import ship

GROUP_TOKENS = 4_000_000  #: tokens of a group, about; a longer example is a group of its own
GROUP_EXAMPLES = 100_000
OUT_TOKENS = 1_000_000  #: tokens of an output batch, about
OUT_ROWS = 20_000


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold. ``unpadded_powers``: sequences of a power of two are not padded to ``tokens``."""

    tokens: int = 4096
    segments: int = 1024
    loss: int = 4096
    cut_to_fill: bool = True
    unpadded_powers: bool = True

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("every limit must allow one token")


Piece = tuple[int, int, int, int, int]  #: example, start, length, sequence, offset


class _Pool:
    """Examples left, by kind; those over a limit apart, to be cut."""

    def __init__(self, sizes: np.ndarray, loss_from: np.ndarray, limits: Limits):
        self.limits, self.loss_from, self.ends = limits, loss_from, sizes
        self.left: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        self.long: list[tuple[int, int]] = []
        for i in range(len(sizes) - 1, -1, -1):
            self.add(i, 0)
        self.long.reverse()
        self.kinds = np.array(sorted(self.left), dtype=np.int64).reshape(-1, 2)
        self.counts = np.array([len(self.left[k]) for k in map(tuple, self.kinds.tolist())], dtype=np.int64)

    def loss(self, i: int, start: int, end: int) -> int:
        return max(0, end - max(start, int(self.loss_from[i])))

    def add(self, i: int, start: int) -> None:
        end = int(self.ends[i])
        kind = (end - start, self.loss(i, start, end))
        if kind[0] > self.limits.tokens or kind[1] > self.limits.loss:
            self.long.append((i, start))
        else:
            self.left[kind].append((i, start))

    def put_back(self, i: int, start: int) -> None:
        """The rest of an example that was cut."""
        if start >= self.ends[i]:
            return
        before = len(self.long)
        self.add(i, start)
        if len(self.long) > before:
            return
        kind = (int(self.ends[i]) - start, self.loss(i, start, int(self.ends[i])))
        at = int(np.searchsorted(self.kinds[:, 0], kind[0]))
        while at < len(self.kinds) and self.kinds[at, 0] == kind[0] and self.kinds[at, 1] < kind[1]:
            at += 1
        if at == len(self.kinds) or tuple(self.kinds[at].tolist()) != kind:
            self.kinds = np.insert(self.kinds, at, kind, axis=0)
            self.counts = np.insert(self.counts, at, 0)
        self.counts[at] += 1

    def take(self, at: int, n: int) -> list[tuple[int, int]]:
        stack = self.left[tuple(self.kinds[at].tolist())]
        taken = stack[len(stack) - n :][::-1]
        del stack[len(stack) - n :]
        self.counts[at] -= n
        return taken

    def compact(self) -> None:
        if len(self.counts) and 2 * np.count_nonzero(self.counts) < len(self.counts):
            kept = self.counts > 0
            self.kinds, self.counts = self.kinds[kept], self.counts[kept]

    def longest(self) -> tuple[int, int] | None:
        """An example to cut: one over a limit, else the longest."""
        if self.long:
            return self.long.pop()
        at = np.flatnonzero(self.counts)
        return self.take(int(at[-1]), 1)[0] if len(at) else None


def plan_sequences(sizes: np.ndarray, loss_from: np.ndarray, limits: Limits) -> list[Piece]:
    """Pieces (example, start, length, sequence, offset) that cover every example once; sequences are numbered from 0.

    Example ``i`` has ``sizes[i]`` tokens, those from ``loss_from[i]`` on bear loss. Examples over a limit are cut;
    others only to fill a sequence, if the limits allow that.
    """
    pool = _Pool(sizes, loss_from, limits)
    full = np.array([limits.tokens, limits.segments, limits.loss], dtype=np.float64)
    demand = np.array([sizes.sum(), len(sizes), np.maximum(sizes - loss_from, 0).sum()], dtype=np.float64)
    weight = demand / full
    weight /= max(weight.max(), 1e-12)
    out: list[Piece] = []
    sequence = 0
    while True:
        pool.compact()
        room = np.array([limits.tokens, limits.segments, limits.loss], dtype=np.int64)
        held: list[tuple[int, int, int]] = []
        while room[0] > 0 and room[1] > 0:
            width = int(np.searchsorted(pool.kinds[:, 0], room[0], side="right"))
            fits = (pool.counts[:width] > 0) & (pool.kinds[:width, 1] <= room[2])
            if fits.any():
                pull = weight * room / full
                score = pool.kinds[:width, 0] * (pull[0] / full[0]) + pool.kinds[:width, 1] * (pull[2] / full[2]) + pull[1] / full[1]
                at = int(np.argmax(np.where(fits, score, -1.0)))
                tokens, loss = pool.kinds[at].tolist()
                # half of the copies that fit, so that the choice is made anew as the room shrinks
                copies = min(room[1], room[0] // tokens, room[2] // loss if loss else room[1])
                for i, start in pool.take(at, max(1, min(int(pool.counts[at]), int(copies) // 2))):
                    held.append((i, start, tokens))
                    room -= (tokens, 1, loss)
                continue
            if not (pool.long or limits.cut_to_fill):
                break
            chosen = pool.longest()
            if chosen is None:
                break
            i, start = chosen
            free = max(0, int(loss_from[i]) - start)  # tokens without loss come first
            length = int(min(room[0], sizes[i] - start, free + room[2]))
            if length <= 0:
                pool.put_back(i, start)
                break
            pool.put_back(i, start + length)
            held.append((i, start, length))
            room -= (length, 1, pool.loss(i, start, start + length))
        if not held:
            return out
        total = sum(length for _, _, length in held)
        parts = [total]
        if limits.unpadded_powers and limits.cut_to_fill and total < limits.tokens:
            parts = [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
        offset = 0
        for i, start, length in held:
            while length:
                here = min(length, parts[0] - offset)
                out.append((i, start, here, sequence, offset))
                start, length, offset = start + here, length - here, offset + here
                if offset == parts[0]:
                    parts.pop(0)
                    sequence, offset = sequence + 1, 0


def encode_examples(examples: DataFrame, end_id: int = 2, tokenizer: str | None = None) -> DataFrame:
    """``example_id, ids, loss_from`` of every row of ``example_id, prompt, text``.

    ``ids``: those of the prompt and of the text, little-endian unsigned 32-bit integers, then ``end_id``. Loss starts after
    the prompt, and never at the first token, which nothing predicts. Null prompts and texts are empty; repeated rows stay.
    """
    path = tokenizer or word_bpe.tokenizer_path()
    ship(examples.sparkSession)
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_bpe.load(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                prompts = [encoder.encode(p) if p else b"" for p in part.column(1).to_pylist()]
                ids = [p + (encoder.encode(t) if t else b"") + end for p, t in zip(prompts, part.column(2).to_pylist())]
                loss = [max(1, len(p) // 4) for p in prompts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array(loss, pa.int64())], ["example_id", "ids", "loss_from"]
                )

    source = examples.select(F.col("example_id").cast("long").alias("example_id"), "prompt", "text")
    return source.mapInArrow(run, "example_id long, ids binary, loss_from long")


PACKED = pa.schema(
    [
        ("example_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("example_tokens", pa.int64()),
        ("loss_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
PACKED_DDL = "example_id long, start long, length long, ids binary, example_tokens long, loss_tokens long, sequence_id long, offset long"


def pack_examples(encoded: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Pieces of ``encoded`` (``example_id, ids, loss_from``) with their ids and their place, one row per piece.

    Every id of every row lies in exactly one piece, and pieces lie gapless in their sequence. Rows without ids
    give no piece, a null ``loss_from`` is 0, an empty input gives an empty result. Sequence numbers hold the task, so they are unique
    and a task that is run again gives the same.
    """
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 36
        names: list = []
        ids: list[bytes] = []
        loss: list[int] = []
        held = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal first
            sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            starts = np.array(loss, dtype=np.int64)
            rows: list[tuple] = []
            tokens = 0
            last = -1
            for i, start, length, sequence, offset in plan_sequences(sizes, starts, limits):
                bearing = max(0, start + length - max(start, loss[i]))
                last = max(last, sequence)
                data = ids[i][4 * start : 4 * (start + length)]
                rows.append((names[i], start, length, data, int(sizes[i]), bearing, first + sequence, offset))
                tokens += length
                if tokens >= OUT_TOKENS or len(rows) >= OUT_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PACKED)], schema=PACKED)
                    rows, tokens = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PACKED)], schema=PACKED)
            first += last + 1

        for batch in batches:
            for name, data, start in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if not data:
                    continue
                names.append(name)
                ids.append(data)
                loss.append(start or 0)
                held += len(data) // 4
                if held >= GROUP_TOKENS or len(ids) >= GROUP_EXAMPLES:
                    yield from packed()
                    names, ids, loss, held = [], [], [], 0
        if ids:
            yield from packed()

    return encoded.select("example_id", "ids", "loss_from").mapInArrow(run, PACKED_DDL)


def document_examples(docs: DataFrame) -> DataFrame:
    """Documents as examples without a prompt."""
    return docs.select(F.col("doc_id").alias("example_id"), F.lit(None).cast("string").alias("prompt"), "text")


def conversation_examples(turns: DataFrame, role: str = "assistant") -> DataFrame:
    """Turns of ``role`` as examples, prompted by the turn before; ``example_id`` is the conversation.

    A join on conversation and turn, so that a conversation of any length spreads over tasks. A turn without one
    before has no prompt; of several with the same number, the smallest text is the prompt.
    """
    before = turns.groupBy(F.col("conv_id").alias("_conv"), (F.col("turn") + 1).alias("_turn")).agg(F.min("text").alias("prompt"))
    own = turns.where(F.col("role") == role).select("conv_id", "turn", "text")
    same = (F.col("conv_id") == F.col("_conv")) & (F.col("turn") == F.col("_turn"))
    return own.join(before, same, "left").select(F.col("conv_id").alias("example_id"), "prompt", "text")


def pack_documents(docs: DataFrame, limits: Limits = Limits(), end_id: int = 2, tokenizer: str | None = None) -> DataFrame:
    """Pieces of all documents with their checksum and place."""
    packed = pack_examples(encode_examples(document_examples(docs), end_id, tokenizer), limits)
    return packed.select(
        F.col("example_id").alias("doc_id"),
        *["start", "length"],
        F.crc32("ids").alias("ids_crc32"),
        F.col("example_tokens").alias("doc_tokens"),
        *["sequence_id", "offset", "loss_tokens"],
    )

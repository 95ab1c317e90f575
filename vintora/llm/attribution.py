"""Token counts per section: whole documents are encoded once, token spans are joined to section spans.

A token's character span follows from the byte lengths of the ids before it, so sections get the counts they have
in the whole text, not those of sections encoded alone. Tokens that cross a section's end are allocated by one
of three rules:

* ``start``: all to the section of the token's first byte,
* ``majority``: all to the section with most of its bytes, the earlier one on a tie,
* ``share``: to each section by its share of the token's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.llm import bpe
from vintora.llm.common import ship

RULES = ("start", "majority", "share")
OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("section", pa.int32()),
        ("char_start", pa.int64()),
        ("char_end", pa.int64()),
        ("n_tokens", pa.float64()),
        ("n_crossing", pa.int64()),
    ]
)
OUT_ROWS = 50_000  #: rows of an output batch, about


def line_starts(raw: np.ndarray) -> np.ndarray:
    """Byte offsets at which the lines begin; a line ends after its newline."""
    after = np.flatnonzero(raw == 10) + 1
    return np.concatenate(([0], after[after < len(raw)])).astype(np.int64)


def allocate(starts: np.ndarray, ends: np.ndarray, sections: np.ndarray, total: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section and tokens that cross out of each section; spans and sections in bytes, both sorted."""
    n = len(sections)
    first = np.searchsorted(sections, starts, "right") - 1
    last = np.searchsorted(sections, ends - 1, "right") - 1
    cross = np.flatnonzero(first != last)
    plain = first == last
    counts = np.bincount(first[plain], minlength=n).astype(np.float64)
    crossing = np.zeros(n, dtype=np.int64)
    edges = np.append(sections, total)
    for t in cross:  # a token is a few bytes, so it meets a few sections
        a, b = int(first[t]), int(last[t])
        bounds = np.clip(edges[a : b + 2], starts[t], ends[t])
        parts = np.diff(bounds)
        if rule == "start":
            counts[a] += 1
        elif rule == "majority":
            counts[a + int(np.argmax(parts))] += 1
        else:
            counts[a : b + 1] += parts / parts.sum()
        crossing[a:b] += 1
    return counts, crossing


def attribute_tokens(docs: DataFrame, rule: str = "start", tokenizer: str | None = None, spans: str | None = None) -> DataFrame:
    """Rows ``doc_id, section, char_start, char_end, n_tokens, n_crossing`` for every section of every document.

    Sections are the lines of ``text``, or the ascending start characters in the array column ``spans`` (the first
    start counts as 0, starts beyond the text are empty sections, nulls are left out). Every row of ``docs`` is a document of its own.
    Null or empty text has one empty section. A document's ``n_tokens`` add up to its whole count under every rule.
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule!r} is none of {RULES}")
    path = tokenizer or bpe.tokenizer_path()
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.load(path)
        parts: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(np.concatenate([p[i] for p in parts]), OUT.field(i).type) for i in range(1, 6)]
            ids = pa.array([p[0] for p in parts], pa.int64()).take(pa.array(np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])))
            return pa.RecordBatch.from_arrays([ids, *arrays], schema=OUT)

        for batch in batches:
            for doc_id, text, given in zip(*(batch.column(i) for i in range(3))):
                data = (text.as_py() or "").encode()
                raw = np.frombuffer(data, dtype=np.uint8)
                ids = np.array(encoder.encode(data.decode()), dtype=np.int64)
                ends = np.cumsum(encoder.sizes[ids]) if len(ids) else np.zeros(0, np.int64)
                begins = ends - encoder.sizes[ids] if len(ids) else ends
                heads = (raw & 0xC0) != 0x80
                chars = np.append(np.cumsum(heads), heads.sum())  # characters up to and with a byte
                if given.is_valid:
                    at = np.append(np.flatnonzero(heads), len(raw))
                    wanted = np.maximum.accumulate(np.array([0, *given.as_py()[1:]], dtype=np.int64))
                    sections = at[np.minimum(wanted, len(at) - 1)]
                else:
                    sections = line_starts(raw)
                counts, crossing = allocate(begins, ends, sections, len(raw), rule)
                begin_chars = np.where(sections < len(raw), chars[np.minimum(sections, len(raw))] - 1, heads.sum())
                end_chars = np.append(begin_chars[1:], heads.sum())
                n = len(sections)
                parts.append((doc_id.as_py(), np.arange(n, dtype=np.int32), begin_chars, end_chars, counts, crossing))
                held += n
                if held >= OUT_ROWS:
                    yield flush()
                    parts, held = [], 0
        if parts:
            yield flush()

    given = F.array_compact(F.col(spans).cast("array<long>")) if spans else F.lit(None).cast("array<long>")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), given.alias("spans"))
    schema = "doc_id long, section int, char_start long, char_end long, n_tokens double, n_crossing long"
    return source.mapInArrow(run, schema)

"""N-gram Jaccard join as a blocked sparse matrix product of documents by word n-grams.

Rows of the matrix are distinct n-gram sets, columns are n-gram hashes. It is cut into tiles of a row block and a column
range, and goes through these steps:

1. Row blocks are hashed and their tiles are dealt by column range. A column that only one set holds can add to no
   overlap and is dropped there; the rest goes back to its row with the logarithm of its frequency.
2. A row whose remaining columns are fewer than the bound that its size sets, is dropped: it has no partner.
3. Of each other row the rarest columns, as many as the bound allows to miss, are its probes. Rows that link share a
   probe, so rows joined by shared probes form families, and only pairs within a family are multiplied.
4. A family is multiplied tile by tile; overlap counts are exact and pairs below their bound are discarded. Only
   a star of each component leaves a tile, so no group ever emits its pairs. A family larger than a tile is split:
   every tile alone first, then two members of each component found, then only those outside the family's largest
   component against all others. These visitors are dealt by block, and a tile and a block meet in one task of their
   own, which holds only the rows that share a probe with the other side.

Columns that many sets of a block hold are summed up first; at most ``MAX_HEAVY`` of them, by their share of all entries,
skip the dealing by column and travel with their rows. Sets and n-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.llm.common import ship, unused
from vintora.llm.components import connected_components
from vintora.sources.workspace import materialise

BLOCK_ENTRIES = 3_000_000  #: entries of a row block
RANGE_ENTRIES = 2_000_000  #: entries of a column range, about
TILE_ENTRIES = 400_000  #: entries of a family's tile, about
TILE_ROWS = 512
HEAVY_IN_BLOCK = 64  #: sets of one block that make a column a candidate for the heavy ones
MAX_HEAVY = 1_000_000
WORDS_HELD = 300_000
STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


class _Words(dict):
    """Hash of each word, kept while the table is small."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_HELD:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


WORDS = _Words()


def ngram_set(text: str | None, n: int) -> np.ndarray:
    """Distinct n-gram hashes, ascending; a text of fewer words has its whole sequence as one; none without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    ids = np.fromiter(map(WORDS.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(n, len(ids))
    mixed = np.full(len(ids) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        mixed = (mixed ^ ids[k : k + len(mixed)]) * STEP[k % len(STEP)]
        mixed ^= mixed >> np.uint64(29)
    mixed *= STEP[1]
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def set_key(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _ranges(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(48)) * np.uint64(parts)) >> np.uint64(16)


def _pack(hashes: np.ndarray) -> tuple[int, bytes]:
    """Ascending hashes as bytes per gap and the gaps."""
    gaps = np.diff(hashes, prepend=np.uint64(0))
    wide = 6 if len(gaps) < 2 or gaps[1:].max() < 1 << 48 else 8
    first = gaps[:1].tobytes()
    return wide, first + gaps[1:].view(np.uint8).reshape(-1, 8)[:, :wide].tobytes()


def _unpack(wide: int, data: bytes) -> np.ndarray:
    first, rest = np.frombuffer(data[:8], dtype=np.uint64), np.frombuffer(data, dtype=np.uint8, offset=8)
    gaps = np.zeros((len(rest) // wide, 8), dtype=np.uint8)
    gaps[:, :wide] = rest.reshape(-1, wide)
    return np.cumsum(np.concatenate([first, gaps.view(np.uint64).ravel()]), dtype=np.uint64)


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Consecutive rows with equal ``names``, as lists by column."""
    key, held = None, None
    for batch in batches:
        columns = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
        for i, k in enumerate(zip(*(columns[n] for n in names))):
            if k != key:
                if held is not None:
                    yield key, held
                key, held = k, {n: [] for n in columns}
            for n, values in columns.items():
                held[n].append(values[i])
    if held is not None:
        yield key, held


def _dealt(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)


def _blocks(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[list[int], list[np.ndarray], list[tuple]]]:
    """Row blocks: keys and sets that are new in the block, and (doc_id, size, key, text_key) of all its rows."""
    keys, sets, rows, seen, held = [], [], [], set(), 0
    for batch in batches:
        for doc_id, text, text_key in zip(batch.column(0), batch.column(1), batch.column(2)):
            hashes = ngram_set(text.as_py(), n)
            key = set_key(hashes) if len(hashes) else None
            rows.append((doc_id.as_py(), len(hashes), key, text_key.as_py()))
            if key is not None and key not in seen:
                seen.add(key)
                keys.append(key)
                sets.append(hashes)
                held += len(hashes)
            if held >= BLOCK_ENTRIES or len(rows) >= 60_000:
                yield keys, sets, rows
                keys, sets, rows, seen, held = [], [], [], set(), 0
    if rows:
        yield keys, sets, rows


def _documents(n: int) -> Callable:
    """Rows of all documents, and the columns that are frequent within a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets, rows in _blocks(batches, n):
            frequent, count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            if sets:
                hashes, counts = np.unique(np.concatenate(sets), return_counts=True)
                frequent, count = hashes[counts >= HEAVY_IN_BLOCK], counts[counts >= HEAVY_IN_BLOCK]
            docs, sizes, keys, texts = zip(*rows)
            none = [None] * len(rows)
            empty = [None] * len(frequent)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*docs, *empty], pa.int64()),
                    pa.array([*sizes, *empty], pa.int64()),
                    pa.array([*keys, *empty], pa.int64()),
                    pa.array([*texts, *empty], pa.int64()),
                    pa.array([*none, *frequent.view(np.int64).tolist()], pa.int64()),
                    pa.array([*none, *count.tolist()], pa.int64()),
                ],
                ["doc_id", "n_shingles", "set_key", "text_key", "column", "n_sets"],
            )

    return run


TILES = pa.schema([("part", pa.int64()), ("wide", pa.int32()), ("hashes", pa.binary()), ("rows", pa.binary()), ("keys", pa.binary()), ("sizes", pa.binary())])
TILES_DDL = "part long, wide int, hashes binary, rows binary, keys binary, sizes binary"


def _tiles(n: int, parts: int, heavy) -> Callable:
    """Tiles of every row block by column range; those of heavy columns take parts of their own."""

    def cut(hashes: np.ndarray, rows: np.ndarray, keys: np.ndarray, sizes: np.ndarray, part: int) -> tuple:
        present, local = np.unique(rows, return_inverse=True)
        wide, packed = _pack(hashes)
        return part, wide, packed, local.astype(np.uint16).tobytes(), keys[present].tobytes(), sizes[present].astype(np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, task = heavy.value, TaskContext.get().partitionId()
        for block, (keys, sets, _) in enumerate(_blocks(batches, n)):
            if not sets:
                continue
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            hashes, rows = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
            order = np.argsort(hashes, kind="stable")
            hashes, rows, keys = hashes[order], rows[order], np.array(keys, dtype=np.int64)
            out = []
            if len(common):
                at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
                is_common = common[at] == hashes
                if is_common.any():
                    out.append(cut(hashes[is_common], rows[is_common], keys, sizes, parts + (task * 31 + block) % parts))
                hashes, rows = hashes[~is_common], rows[~is_common]
            of = _ranges(hashes, parts)
            edges = np.searchsorted(of, np.arange(parts + 1, dtype=np.uint64))
            for p, (a, b) in enumerate(zip(edges, edges[1:])):
                if b > a:
                    out.append(cut(hashes[a:b], rows[a:b], keys, sizes, p))
            for i in range(0, len(out), 64):
                columns = list(zip(*out[i : i + 64]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, TILES)], schema=TILES)

    return run


def _distinct(hashes: np.ndarray, keys: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((keys, hashes))
    hashes, keys, sizes = hashes[order], keys[order], sizes[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (keys[1:] != keys[:-1]))[: len(hashes)]
    return hashes[new], keys[new], sizes[new]


BACK = pa.schema([("part", pa.int64()), ("keys", pa.binary()), ("sizes", pa.binary()), ("runs", pa.binary()), ("hashes", pa.binary()), ("levels", pa.binary())])
BACK_DDL = "part long, keys binary, sizes binary, runs binary, hashes binary, levels binary"


def _columns(parts: int, back: int) -> Callable:
    """Columns that two sets or more hold, returned to their rows with the logarithm of their frequency."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part,), held in _groups(batches, ["part"]):
            hashes = np.concatenate([_unpack(w, h) for w, h in zip(held["wide"], held["hashes"])])
            local = [np.frombuffer(r, np.uint16) for r in held["rows"]]
            keys = np.concatenate([np.frombuffer(k, np.int64)[r] for k, r in zip(held["keys"], local)])
            sizes = np.concatenate([np.frombuffer(s, np.uint32)[r] for s, r in zip(held["sizes"], local)])
            levels = None
            if part < parts:
                order = np.argsort(hashes, kind="stable")
                hashes, keys, sizes = hashes[order], keys[order], sizes[order]
                same = hashes[1:] == hashes[:-1]
                shared = np.append(same, False) | np.append(False, same)
                hashes, keys, sizes = _distinct(hashes[shared], keys[shared], sizes[shared])
                _, where, counts = np.unique(hashes, return_inverse=True, return_counts=True)
                frequency = counts[where]
                shared = frequency > 1
                hashes, keys, sizes = hashes[shared], keys[shared], sizes[shared]
                levels = np.log2(frequency[shared]).astype(np.uint8)
            else:
                hashes, keys, sizes = _distinct(hashes, keys, sizes)
                levels = np.full(len(hashes), 255, dtype=np.uint8)
            if not len(hashes):
                continue
            order = np.lexsort((hashes, keys.view(np.uint64)))
            hashes, keys, sizes, levels = hashes[order], keys[order], sizes[order], levels[order]
            of = _ranges(keys.view(np.uint64), back)
            edges = np.searchsorted(of, np.arange(back + 1, dtype=np.uint64))
            out = []
            for p, (a, b) in enumerate(zip(edges, edges[1:])):
                if b > a:
                    starts = np.flatnonzero(np.append(True, keys[a + 1 : b] != keys[a : b - 1]))
                    runs = np.diff(np.append(starts, b - a)).astype(np.uint32)
                    out.append((p, keys[a:b][starts].tobytes(), sizes[a:b][starts].tobytes(), runs.tobytes(), hashes[a:b].tobytes(), levels[a:b].tobytes()))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, BACK)], schema=BACK)

    return run


def _candidates(percent: int) -> Callable:
    """Rows that keep enough columns for a partner: their columns and their probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _groups(batches, ["part"]):
            runs = np.concatenate([np.frombuffer(r, np.uint32) for r in held["runs"]])
            keys = np.repeat(np.concatenate([np.frombuffer(k, np.int64) for k in held["keys"]]), runs)
            sizes = np.repeat(np.concatenate([np.frombuffer(s, np.uint32) for s in held["sizes"]]).astype(np.int64), runs)
            hashes = np.concatenate([np.frombuffer(h, np.uint64) for h in held["hashes"]])
            levels = np.concatenate([np.frombuffer(v, np.uint8) for v in held["levels"]])
            order = np.lexsort((hashes, levels, keys))
            keys, sizes, hashes, levels = keys[order], sizes[order], hashes[order], levels[order]
            new = np.append(True, (hashes[1:] != hashes[:-1]) | (keys[1:] != keys[:-1]))
            keys, sizes, hashes = keys[new], sizes[new], hashes[new]
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            ends = np.append(starts[1:], len(keys))
            needed = (percent * sizes[starts] + 99) // 100
            probes = (ends - starts) - needed + 1
            out = [
                (int(keys[a]), int(sizes[a]), np.sort(hashes[a:b]).tobytes(), hashes[a : a + p].view(np.int64))
                for a, b, p in zip(starts, ends, probes)
                if p > 0
            ]
            for i in range(0, len(out), 500):
                key, size, columns, probe = zip(*out[i : i + 500])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.int64()), pa.array(size, pa.int64()), pa.array(columns, pa.binary()), pa.array(probe, pa.list_(pa.int64()))],
                    ["set_key", "size", "columns", "probes"],
                )

    return run


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Exact counts of shared columns of every left and right set, accumulated over blocks of columns."""
    total = np.zeros((len(left), len(right)))
    if not left or not right:
        return total
    a, b = np.unique(np.concatenate(left)), np.concatenate(right)
    shared = np.intersect1d(a, b)
    if not len(shared):
        return total

    def entries(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        flat, rows = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(shared, flat), len(shared) - 1)
        kept = shared[at] == flat
        order = np.argsort(at[kept], kind="stable")
        return at[kept][order], rows[kept][order]

    (ca, ra), (cb, rb) = entries(left), entries(right)
    for start in range(0, len(shared), 4096):
        stop = min(start + 4096, len(shared))
        parts = []
        for c, r, n in ((ca, ra, len(left)), (cb, rb, len(right))):
            i, j = np.searchsorted(c, [start, stop])
            dense = np.zeros((n, stop - start), dtype=np.float32)
            dense[r[i:j], c[i:j] - start] = 1
            parts.append(dense)
        total += parts[0] @ parts[1].T
    return total


class _Forest:
    """Components of a tile, by their smallest key."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        while self.parent.setdefault(x, x) != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        for i, j in zip(*np.nonzero(linked)):
            a, b = self.root(int(left[i])), self.root(int(right[j]))
            self.parent[max(a, b)] = min(a, b)

    def edges(self) -> list[tuple[int, int]]:
        return [(x, r) for x in list(self.parent) if (r := self.root(x)) != x]


def _multiply(percent: int) -> Callable:
    """Each linked row of a tile with its component's smallest key; visitors meet the tile's own rows, own rows meet each other unless there are visitors."""

    def links(forest: _Forest, k1, n1, l1, s1, k2, n2, l2, s2) -> None:
        both = overlaps(s1, s2)
        good = 100 * both >= percent * (np.add.outer(n1, n2) - both)
        forest.join(good & (l1[:, None] != l2[None, :]), k1, k2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _groups(batches, ["family", "tile", "block"]):
            keys, sizes, label = (np.array(held[n], dtype=np.int64) for n in ("set_key", "size", "label"))
            sets = [np.frombuffer(c, np.uint64) for c in held["columns"]]
            visits = np.array(held["visits"], dtype=bool)
            own, guests = np.flatnonzero(~visits), np.flatnonzero(visits)
            pick = lambda at: (keys[at], sizes[at], label[at], [sets[i] for i in at])
            forest = _Forest()
            for a in range(0, len(own), TILE_ROWS):
                if len(guests):
                    for b in range(0, len(guests), TILE_ROWS):
                        links(forest, *pick(own[a : a + TILE_ROWS]), *pick(guests[b : b + TILE_ROWS]))
                else:
                    for b in range(a, len(own), TILE_ROWS):
                        links(forest, *pick(own[a : a + TILE_ROWS]), *pick(own[b : b + TILE_ROWS]))
            if edges := forest.edges():
                u, v = zip(*edges)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return run


def _tile_links(rows: DataFrame, percent: int) -> DataFrame:
    chosen = rows.select("family", "tile", "block", "set_key", "size", "label", "visits", "columns")
    return _dealt(chosen, "family", "tile", "block").mapInArrow(_multiply(percent), "u long, v long")


def _labelled(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows whose label is replaced by the smallest key that a tile found for it.

    Labels only spare pairs that are known to be connected, so those of separate tiles need not agree.
    """
    found = heads.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_head"))
    others = [c for c in rows.columns if c != "label"]
    return rows.join(found, F.col("label") == F.col("_u"), "left").select(*others, F.coalesce("_head", "label").alias("label"))


def _pieces(rows: DataFrame, name: str, times: int = 1) -> DataFrame:
    """``_of`` and the number of pieces its family's ``rows`` take, each of ``times`` tiles' rows and entries at most, about."""
    entries = F.ceil(F.sum(F.length("columns") / 8) / (times * TILE_ENTRIES))
    pieces = F.greatest(entries, F.ceil(F.count("*") / (times * TILE_ROWS)), F.lit(1)).cast("int")
    return rows.groupBy(F.col("family").alias("_of")).agg(pieces.alias(name))


def _visits(found: DataFrame, apart: DataFrame, probes: DataFrame) -> DataFrame:
    """Rows of every meeting of a tile of ``found`` and a block of visitors ``apart``: hosts and visitors.

    Linked rows share a probe, so a row goes only to the tiles or blocks that hold one of its probes. Both sides of a
    meeting are bounded by ``TILE_ROWS`` and ``TILE_ENTRIES``, about.
    """
    blocks = _pieces(apart, "_blocks")
    block = F.pmod(F.xxhash64("set_key", F.lit(1)), F.col("_blocks")).cast("int")
    visitors = apart.join(blocks, F.col("family") == F.col("_of")).select(*found.drop("block", "tile").columns, block.alias("block"))
    visitors = materialise(visitors, "visitors")

    def probed(rows: DataFrame, part: str) -> DataFrame:
        return rows.select(F.col("set_key").alias("_key"), part).join(probes, F.col("_key") == F.col("_probed")).select("_key", "probe", part)

    def met(rows: DataFrame, others: DataFrame, own: str, other: str) -> DataFrame:
        parts = probed(others, other).select(F.col("probe").alias("_p"), other).distinct()
        return probed(rows, own).join(parts, F.col("probe") == F.col("_p")).select("_key", other).distinct()

    hosts = found.drop("block").join(met(found, visitors, "tile", "block"), F.col("set_key") == F.col("_key")).drop("_key")
    guests = visitors.join(met(visitors, found, "block", "tile"), F.col("set_key") == F.col("_key")).drop("_key")
    return hosts.unionByName(guests.withColumn("visits", F.lit(True)).select(*hosts.columns))


def family_links(candidates: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between set keys with the same components as all links."""
    probes = candidates.select("set_key", F.explode("probes").alias("probe"))
    firsts = probes.groupBy("probe").agg(F.min("set_key").alias("first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    shared = probes.join(firsts, "probe").where(F.col("set_key") != F.col("first")).select("set_key", "first").distinct()
    families = connected_components(shared, "set_key", "first").select(F.col("node").alias("_node"), F.col("component").alias("family"))
    members = candidates.drop("probes").join(families, F.col("set_key") == F.col("_node")).drop("_node")
    entries = F.length("columns") / 8
    weights = families.join(candidates.select("set_key", entries.alias("_e")), F.col("_node") == F.col("set_key")).groupBy(
        F.col("family").alias("_family")
    ).agg(F.greatest(F.ceil(F.sum("_e") / TILE_ENTRIES), F.ceil(F.count("*") / TILE_ROWS)).cast("int").alias("tiles"))
    tiled = members.join(weights, F.col("family") == F.col("_family")).drop("_family")
    rows = tiled.select(
        "*",
        F.pmod(F.xxhash64("set_key"), F.col("tiles")).cast("int").alias("tile"),
        F.lit(0).alias("block"),
        F.col("set_key").alias("label"),
        F.lit(False).alias("visits"),
    )
    rows = materialise(rows, "families")
    alone = materialise(_tile_links(rows, percent), "links")
    split = rows.where("tiles > 1")
    if split.isEmpty():
        return alone
    found = materialise(_labelled(split, alone), "families")
    ends = (
        found.groupBy("family", "tile", "label")
        .agg(F.min("set_key").alias("_a"), F.max("set_key").alias("_b"), F.count("*").alias("_n"))
        .where("_n > 1")
        .select(F.explode(F.array_distinct(F.array("_a", "_b"))).alias("_end"))
    )
    sent = found.join(ends, F.col("set_key") == F.col("_end")).drop("_end")
    sent = sent.join(_pieces(sent, "_width", 8), F.col("family") == F.col("_of")).drop("_of")
    sent = sent.withColumn("tile", F.pmod(F.xxhash64("set_key"), F.col("_width")).cast("int"))
    between = materialise(_tile_links(sent, percent), "links")
    found = materialise(_labelled(found, between), "families")  # a label is its component's smallest key, which was sent
    sizes = found.groupBy(F.col("family").alias("_family"), "label").agg(F.count("*").alias("_n"))
    largest = sizes.groupBy("_family").agg(F.max_by("label", F.struct("_n", "label")).alias("_largest"))
    apart = found.join(largest, F.col("family") == F.col("_family")).where(F.col("label") != F.col("_largest"))
    known = probes.withColumnRenamed("set_key", "_probed")
    rest = materialise(_tile_links(_visits(found, apart.drop("_family", "_largest"), known), percent), "links")
    return alone.union(between).union(rest)


def _component_rows(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, text_key, label, component_id`` of every row; ``label`` tells components apart, null without a set."""
    spark = docs.sparkSession
    ship(spark)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("text_key"))
    kinds = "doc_id long, n_shingles long, set_key long, text_key long, column long, n_sets long"
    table = materialise(source.mapInArrow(_documents(n), kinds), "ngram-rows")
    rows = table.where("n_shingles IS NOT NULL").drop("column", "n_sets")
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    least = max(HEAVY_IN_BLOCK, total // MAX_HEAVY)
    columns = table.where("column IS NOT NULL").groupBy("column").agg(F.sum("n_sets").alias("n")).where(F.col("n") >= least)
    # a heavy column holds a millionth of all entries at least, so there are MAX_HEAVY of them at most
    heavy = np.sort(np.array([r[0] for r in columns.select("column").collect()], dtype=np.int64).view(np.uint64))
    parts = max(1, total // RANGE_ENTRIES)
    tiles = source.mapInArrow(_tiles(n, parts, spark.sparkContext.broadcast(heavy)), TILES_DDL)
    returned = _dealt(tiles, "part").mapInArrow(_columns(parts, parts), BACK_DDL)
    found_ddl = "set_key long, size long, columns binary, probes array<long>"
    candidates = materialise(_dealt(returned, "part").mapInArrow(_candidates(percent), found_ddl), "candidates")
    links = family_links(candidates, percent)
    keys = rows.where("set_key IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("first_id"))
    found = connected_components(links, "u", "v").select(F.col("node").alias("_node"), "component")
    joined = keys.join(found, F.col("set_key") == F.col("_node"), "left")
    least_id = (
        joined.where("component IS NOT NULL").groupBy(F.col("component").alias("_of")).agg(F.min("first_id").alias("_least"))
    )
    named = joined.join(least_id, F.col("component") == F.col("_of"), "left").select(
        F.col("set_key").alias("_key"),
        F.coalesce("component", "set_key").alias("label"),
        F.coalesce("_least", "first_id").alias("_component_id"),
    )
    return rows.join(named, F.col("set_key") == F.col("_key"), "left").select(
        *["doc_id", "n_shingles", "text_key", "label"],
        F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("_component_id")).alias("component_id"),
    )


def jaccard_components(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Two rows link when ``100 * shared >= percent * united`` of their distinct n-gram sets; words are split at ASCII white
    space, A-Z lower-cased. Null, empty and blank texts have no set, link with nothing and are their own component. Equal
    sets are one row of the matrix, so copies and repeated rows share a component. ``component_id`` is the smallest
    id reachable; null ids are never the smallest unless there is no other.
    """
    return _component_rows(docs, n, percent).select("doc_id", "n_shingles", "component_id")


def keep_representatives(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps one, with all their columns.

    Kept is the row with the smallest id of its component, and of those the smallest text hash; rows equal in both are
    one document, of which any one stays. Rows whose texts have no words all stay.
    """
    rows = materialise(_component_rows(docs, n, percent), "components")
    best = rows.where("label IS NOT NULL").groupBy("label").agg(F.min(F.struct("doc_id", "text_key")).alias("b"))
    kept = best.select(F.col("b.doc_id").alias("_id"), F.col("b.text_key").alias("_text"))
    blank = rows.where("label IS NULL").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text")).distinct()
    times = rows.groupBy("doc_id", "text_key").agg(F.count("*").alias("_n")).where("_n > 1")
    again = times.select(F.col("doc_id").alias("_again"), F.col("text_key").alias("_again_text"))
    same = kept["_id"].eqNullSafe(F.col("_again")) & (kept["_text"] == F.col("_again_text"))
    repeated = kept.join(again, same, "left_semi")
    single = kept.join(again, same, "left_anti").union(blank)

    def pick(keys: DataFrame) -> DataFrame:
        row, text = unused(docs.columns, "_id", "_text")
        here = docs["doc_id"].cast("long").eqNullSafe(F.col(row)) & (F.xxhash64(docs["text"]) == F.col(text))
        return docs.join(keys.select("_id", "_text").toDF(row, text), here, "left_semi")

    return pick(single).unionByName(pick(repeated).dropDuplicates(["doc_id", "text"]))

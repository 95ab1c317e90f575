"""Distinct sampled SentencePiece segmentations by Gumbel top-k without replacement, and decoding.

A text's lattice falls apart at white space, which no piece crosses, into units; the lattices of a batch's new units are built
together, level by level from their ends, and kept while the table is small. Pieces weigh by their rank,
``(rank + 2) ** -power``, so a segmentation has a probability, and summing backwards over the lattice gives every edge its
probability given the node.

The search is A-star over sets of segmentations that share a beginning, ordered by perturbed log mass. A set's best
segmentation is drawn edge by edge; what leaves it at each step is a new set whose perturbed value is a Gumbel variable
of its mass, truncated at its parent's. Popping the largest set k times gives k distinct segmentations with the law of
sampling without replacement. A batch's texts draw side by side, each from its own sets. All draws are hashes of row key,
sample, unit and step: repeated rows agree, retries too.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.llm.common import ship

SPACE = "▁"
UNITS = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
MAX_NODES = 3_000_000  #: nodes held before the table starts anew
KEPT_LENGTH = 40  #: characters of a unit worth keeping
BATCH_CHARS = 400_000
DEFAULT_MODEL = "piece_bpe_32k.model"
EDGE_KINDS = {"cum": np.float64, "logs": np.float64, "rests": np.float64, "target": np.int32, "ids": np.int32}
NODE_KINDS = {"first": np.int64, "degree": np.int32}


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def hashed(seed: np.ndarray, *parts) -> np.ndarray:
    """Seeds that depend on the given ones and on counters."""
    x = seed
    with np.errstate(over="ignore"):
        for p in parts:
            x = _mix(x * np.uint64(0x9E3779B97F4A7C15) + np.asarray(p).astype(np.uint64) + np.uint64(1))
    return x


def uniform(seed: np.ndarray, *parts) -> np.ndarray:
    """Numbers in (0, 1) that depend on the row seed and the given counters alone."""
    return ((hashed(seed, *parts) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Lattices:
    """Lattices of units in flat arrays.

    A node's edges adjoin, long pieces first: ``logs`` has their log probability given the node, ``rests`` that of all others,
    ``cum`` the running probability, which ends at one; ``target`` is -1 at a unit's end, ``ids`` below 0 stand for bytes.
    """

    def __init__(self, path: str, power: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        weight = {i: (2.0 - model.get_score(i)) ** -power for i in plain}
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}
        rare = (2.0 + n) ** -power
        total = sum(weight.values()) + rare * len(self.bytes)
        self.pieces = {model.id_to_piece(i): (i, w / total) for i, w in weight.items()}
        self.byte_weight = rare / total
        self.longest = max(map(len, self.pieces))
        self.log_weight = np.zeros(n)
        steps: dict[int, int] = {}  # beginnings of pieces: number of a shorter one and next code point, to number
        named = {}
        for piece, (i, w) in self.pieces.items():
            at = 0
            for c in piece:
                at = steps.setdefault(at << 21 | ord(c), len(steps) + 1)
            named[at] = i
            self.log_weight[i] = math.log(w)
        self.step_keys = np.array([*sorted(steps), np.iinfo(np.int64).max])
        self.step_to = np.array([steps[key] for key in self.step_keys[:-1].tolist()])
        self.piece_at = np.full(len(steps) + 1, -1)
        self.piece_at[list(named)] = list(named.values())
        surface = [model.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n)]
        for byte, i in self.bytes.items():
            surface[i] = bytes([byte])
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_length = np.array([len(x) for x in surface])
        self.surface_at = np.cumsum(self.surface_length) - self.surface_length
        self.fallback: dict[int, int] = {}  # code points outside the vocabulary, in the order of their rows below
        self.fallback_ids, self.fallback_length = np.zeros((0, 4), np.int64), np.zeros(0, np.int64)
        self.reset()

    def reset(self) -> None:
        self.units: dict[str, int] = {}
        self.nodes = self.edges = 0
        self._held = {name: np.zeros(1 << 16, kind) for name, kind in {**EDGE_KINDS, **NODE_KINDS}.items()}
        self._expose()

    def _expose(self) -> None:
        for name in EDGE_KINDS:
            setattr(self, name, self._held[name][: self.edges])
        for name in NODE_KINDS:
            setattr(self, name, self._held[name][: self.nodes])

    def _append(self, name: str, n: int, new: np.ndarray) -> None:
        if n + len(new) > len(self._held[name]):
            grown = np.zeros(2 * (n + len(new)), self._held[name].dtype)
            grown[:n] = self._held[name][:n]
            self._held[name] = grown
        self._held[name][n : n + len(new)] = new

    def starts(self, texts: list[list[str]]) -> list[np.ndarray]:
        """First nodes of the units of each text; the lattices of new ones are built."""
        new = [u for u in dict.fromkeys(chain.from_iterable(texts)) if u not in self.units]
        if new:
            self._build(new)
        found = [np.fromiter(map(self.units.__getitem__, t), np.int64, len(t)) for t in texts]
        for u in new:
            if len(u) > KEPT_LENGTH:
                del self.units[u]
        return found

    def _bytes_of(self, codes: np.ndarray) -> np.ndarray:
        """Rows of ``fallback_ids`` for code points."""
        for code in np.unique(codes).tolist():
            if code not in self.fallback:
                raw = [self.bytes[b] for b in chr(code).encode()]
                self.fallback[code] = len(self.fallback)
                self.fallback_ids = np.vstack([self.fallback_ids, [raw + [0] * (4 - len(raw))]])
                self.fallback_length = np.append(self.fallback_length, len(raw))
        return np.fromiter(map(self.fallback.__getitem__, codes.tolist()), np.int64, len(codes))

    def _pieces_in(self, codes: np.ndarray, left: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """By length from one on: where pieces begin, and which; all places read on together while a piece may still follow."""
        at, state, found = np.arange(len(codes)), np.zeros(len(codes), np.int64), []
        while len(at) or not found:
            key = state << 21 | codes[at + len(found)]
            place = np.searchsorted(self.step_keys, key)
            known = np.flatnonzero(self.step_keys[place] == key)
            at, state = at[known], self.step_to[place[known]]
            piece = self.piece_at[state]
            whole = np.flatnonzero(piece >= 0)
            found.append((at[whole], piece[whole]))
            more = np.flatnonzero(left[at] > len(found))
            at, state = at[more], state[more]
        return found

    def _build(self, units: list[str]) -> None:
        codes = np.frombuffer("".join(units).encode("utf-32-le"), "<u4").astype(np.int64)
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        size, begin = len(codes), np.cumsum(lengths) - lengths
        level = np.repeat(begin + lengths, lengths) - np.arange(size)  # characters to the unit's end
        found = self._pieces_in(codes, level)
        bare = np.ones(size, bool)
        bare[found[0][0]] = False
        lone = np.flatnonzero(bare)
        raw = self._bytes_of(codes[lone])

        degree = np.bincount(np.concatenate([lone, *(at for at, _ in found)]), minlength=size)
        node = np.argsort(level.astype(np.uint16) if level.max() < 1 << 16 else level, kind="stable")
        heads = np.cumsum(degree[node]) - degree[node]
        first = np.empty(size, np.int64)
        first[node] = heads
        start = np.repeat(node, degree[node])
        ids, length, weight = np.empty(len(start), np.int64), np.ones(len(start), np.int64), np.empty(len(start))
        free = first.copy()
        for chars in range(len(found), 0, -1):
            at, piece = found[chars - 1]
            edge = free[at]
            ids[edge], length[edge], weight[edge] = piece, chars, self.log_weight[piece]
            free[at] += 1
        ids[free[lone]], weight[free[lone]] = -1 - raw, self.fallback_length[raw] * math.log(self.byte_weight)

        ends = length == level[start]
        target = np.where(ends, size, start + length)
        many = degree[node]
        mass = np.zeros(size + 1)  # log of the weight of all ways to the unit's end
        low = 0
        for high in np.cumsum(np.bincount(level)).tolist():
            if high > low:
                part = slice(heads[low], heads[high - 1] + many[high - 1])
                value, cut = weight[part] + mass[target[part]], heads[low:high] - heads[low]
                most = np.maximum.reduceat(value, cut)
                mass[node[low:high]] = most + np.log(np.add.reduceat(np.exp(value - np.repeat(most, many[low:high])), cut))
                low = high
        logs = np.minimum(weight + mass[target] - mass[start], 0.0)
        cum = np.exp(logs)
        for rank in range(1, int(degree.max())):
            at = first[degree > rank] + rank
            cum[at] += cum[at - 1]
        cum[first + degree - 1] = 1.0
        with np.errstate(divide="ignore"):
            rests = np.log(-np.expm1(logs))
        for name, new in {"cum": cum, "logs": logs, "rests": rests, "target": np.where(ends, -1, self.nodes + target), "ids": ids}.items():
            self._append(name, self.edges, new)
        self._append("first", self.nodes, self.edges + first)
        self._append("degree", self.nodes, degree)
        self.units.update(zip(units, (self.nodes + begin).tolist()))
        self.nodes += size
        self.edges += len(start)
        self._expose()

    def draw(self, start: np.ndarray, forced: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges from each start node to its unit's end, one unit after the other, and their count per unit.

        A ``forced`` edge of 0 or more is a unit's first one; ``state`` holds the seed of each unit's draws.
        """
        at, who, rounds = start, np.arange(len(start)), []
        counts = np.zeros(len(start), np.int64)
        while len(at):
            u = uniform(state, len(rounds))
            edge = self.first[at]
            on = np.flatnonzero(self.cum[edge] <= u)
            while len(on):  # a node's last edge reaches one, so each draw ends within its node
                edge[on] += 1
                on = on[self.cum[edge[on]] <= u[on]]
            if not rounds:
                edge = np.where(forced >= 0, forced, edge)
            rounds.append((who, edge))
            counts[who] += 1
            at = self.target[edge]
            more = np.flatnonzero(at >= 0)
            at, who, state = at[more], who[more], state[more]
        begin = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int64)
        for k, (w, e) in enumerate(rounds):
            out[begin[w] + k] = e
        return out, counts

    def ids_of(self, edges: np.ndarray) -> np.ndarray:
        ids = self.ids[edges]
        raw = np.flatnonzero(ids < 0)
        if not len(raw):
            return ids.astype("<u4")
        rows = -1 - ids[raw]
        counts = np.ones(len(ids), np.int64)
        counts[raw] = self.fallback_length[rows]
        begin = (np.cumsum(counts) - counts)[raw]
        out = np.repeat(ids, counts).astype("<u4")
        for k in range(4):
            has = self.fallback_length[rows] > k
            out[begin[has] + k] = self.fallback_ids[rows[has], k]
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of ids; the space that encoding puts in front is taken off."""
        n = self.surface_length[ids]
        at = np.repeat(self.surface_at[ids] - (np.cumsum(n) - n), n)
        data = self.surface[at + np.arange(len(at))].tobytes()
        return data[1:] if data[:1] == b" " else data


@lru_cache(maxsize=2)
def load(path: str, power: float) -> Lattices:
    return Lattices(path, power)


def _log_exponential(u: np.ndarray) -> np.ndarray:
    return np.log(-np.log(u))


class _Path:
    """A segmentation found: its edges, where each unit's end, and the sets that leave it from step ``owned`` on.

    ``before`` is the log probability ahead of each own step; ``keys`` order the sets: a smaller key is a larger value.
    """

    def __init__(self, edges: np.ndarray, ends: np.ndarray, value: float, owned: int, barred: set[int], before: np.ndarray, log: float, keys: np.ndarray):
        self.edges, self.ends, self.value, self.owned, self.barred = edges, ends, value, owned, barred
        self.before, self.log, self.keys = before, log, keys
        self.rank()

    def rank(self) -> None:
        """The largest set's step and its value, truncated at the path's."""
        self.best = int(self.keys.argmin()) if len(self.keys) else 0
        key = self.keys[self.best] if len(self.keys) else np.inf
        self.next = -np.inf if key == np.inf else -float(np.logaddexp(-self.value, key))


def _branch(lattices: Lattices, starts: np.ndarray, seed: np.ndarray, path: _Path, sample: int) -> tuple[int, int, int, int, set[int]]:
    """The path's largest set, taken off it: (step, unit, its node, edge drawn there, edges it leaves out)."""
    at = path.owned + path.best
    taken = int(path.edges[at])
    barred = {taken} | (path.barred if at == path.owned else set())
    unit = int(np.searchsorted(path.ends, at, "right"))
    node = int(starts[unit] if at == (path.ends[unit - 1] if unit else 0) else lattices.target[path.edges[at - 1]])
    first = int(lattices.first[node])
    open_edges = [e for e in range(first, first + int(lattices.degree[node])) if e not in barred]
    weights = np.exp(lattices.logs[open_edges])
    point = float(uniform(seed, sample, 0xBEEF, at)[0]) * weights.sum()
    chosen = open_edges[min(int(np.searchsorted(np.cumsum(weights), point, "right")), len(open_edges) - 1)]
    return at, unit, node, chosen, barred


def sample_texts(lattices: Lattices, starts: list[np.ndarray], seeds: np.ndarray, k: int) -> list[tuple[list[_Path], float]]:
    """For each text up to ``k`` distinct segmentations by falling perturbed value, and the value of the next one, or minus infinity."""
    found: list[list[_Path]] = [[] for _ in starts]
    roots = -_log_exponential(uniform(seeds, 0, 1, 2))
    for sample in range(k):
        work = []  # text, path it leaves, step, first unit, first edge, edges left out, value
        begins, forced = [], []
        for d, units in enumerate(starts):
            if not sample:
                work.append((d, None, 0, 0, set(), float(roots[d])))
                begins.append(units)
                forced.append(np.full(len(units), -1))
                continue
            path = max(found[d], key=lambda p: p.next)
            if path.next == -np.inf:
                continue
            value = path.next
            at, unit, node, chosen, barred = _branch(lattices, units, seeds[d : d + 1], path, sample)
            work.append((d, path, at, unit, barred, value))
            begins.append(np.concatenate([[node], units[unit + 1 :]]))
            forced.append(np.full(len(begins[-1]), -1))
            forced[-1][0] = chosen
        if not work:
            break
        docs = np.array([w[0] for w in work])
        sizes = np.array([len(b) for b in begins])
        inner = lambda n: np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        number = inner(sizes) + np.repeat([w[3] for w in work], sizes)
        state = hashed(np.repeat(hashed(seeds[docs], sample), sizes), number)
        edges, counts = lattices.draw(np.concatenate(begins), np.concatenate(forced), state)
        ends = np.concatenate([[0], np.cumsum(counts)])
        stops = np.cumsum(sizes)
        lengths = np.diff(ends[stops], prepend=0)
        logs, rests = lattices.logs[edges], lattices.rests[edges]
        steps = inner(lengths) + np.repeat([w[2] for w in work], lengths)
        keys = _log_exponential(uniform(np.repeat(hashed(seeds[docs], sample, 0xF00D), lengths), steps)) - rests
        for (d, path, at, unit, barred, value), stop, size in zip(work, stops.tolist(), sizes.tolist()):
            low, high = int(ends[stop - size]), int(ends[stop])
            own, own_ends = edges[low:high], at + ends[stop - size + 1 : stop + 1] - low
            ahead = float(path.before[at - path.owned]) if path else 0.0
            total = np.cumsum(logs[low:high])
            before = ahead + total - logs[low:high]
            key = keys[low:high] - before
            if barred:
                rest = 1 - sum(math.exp(lattices.logs[e]) for e in {*barred, int(own[0])})
                u = float(uniform(seeds[d : d + 1], sample, 0xF00D, at)[0])
                key[0] = math.log(-math.log(u)) - before[0] - math.log(rest) if rest > 1e-12 else np.inf
            if path:
                path.keys[at - path.owned] = np.inf
                path.rank()
                own = np.concatenate([path.edges[:at], own])
                own_ends = np.concatenate([path.ends[:unit], own_ends])
            log = ahead + float(total[-1]) if high > low else 0.0
            found[d].append(_Path(own, own_ends, value, at, barred, before, log, key))
    return [(paths, max(p.next for p in paths)) for paths in found]


def sample_text(lattices: Lattices, starts: np.ndarray, seed: int, k: int) -> tuple[list[_Path], float]:
    """``sample_texts`` of one text."""
    return sample_texts(lattices, [starts], np.array([seed], np.uint64), k)[0]


def log_inclusion(log_p: float, threshold: float) -> float:
    """Log of the probability that a segmentation's perturbed value exceeds the threshold."""
    x = log_p - threshold
    if threshold == -np.inf or x > 3:
        return 0.0 if threshold == -np.inf else math.log1p(-math.exp(-math.exp(min(x, 6))))
    return x if x < -30 else math.log(-math.expm1(-math.exp(x)))


OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("sample", pa.int32()),
        ("n_pieces", pa.int64()),
        ("ids", pa.binary()),
        ("log_prob", pa.float64()),
        ("log_inclusion", pa.float64()),
        ("round_trip", pa.bool_()),
    ]
)
OUT_DDL = "doc_id long, sample int, n_pieces long, ids binary, log_prob double, log_inclusion double, round_trip boolean"


def sample_pieces(docs: DataFrame, k: int = 2, seed: int = 0, power: float = 1.0, model: str | None = None) -> DataFrame:
    """Up to ``k`` distinct segmentations of every row of ``docs``, by falling perturbed value.

    Rows ``doc_id, sample, n_pieces, ids`` (little-endian unsigned 32-bit), ``log_prob`` of the segmentation given the text,
    ``log_inclusion`` of being among the first ``k``, and whether decoding gave the text back. Texts with fewer than ``k``
    segmentations return all they have; null and empty texts have one, without pieces. Characters outside the vocabulary are
    their bytes. A text that contains the space sign itself decodes to spaces there.
    """
    ship(docs.sparkSession)
    path = model or public_tokenizers.path(DEFAULT_MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = load(path, power)

        def work(rows: list[tuple]) -> pa.RecordBatch:
            if lattices.nodes > MAX_NODES:
                lattices.reset()
            units = [UNITS.findall(SPACE + text.replace(" ", SPACE)) if text else [] for _, text, _ in rows]
            starts = lattices.starts(units)
            seeds = np.array([key & (2**64 - 1) for _, _, key in rows], np.uint64)
            out = []
            for (doc_id, text, _), (found, threshold) in zip(rows, sample_texts(lattices, starts, seeds, k)):
                plain = text.replace(SPACE, " ").encode()
                for i, p in enumerate(found):
                    ids = lattices.ids_of(p.edges)
                    out.append((doc_id, i, len(ids), ids.tobytes(), p.log, log_inclusion(p.log, threshold), lattices.decode(ids) == plain))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), OUT)], schema=OUT)

        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for doc_id, text, key in zip(*(batch.column(i) for i in range(3))):
                rows.append((doc_id.as_py(), text.as_py() or "", key.as_py()))
                held += len(rows[-1][1])
                if held >= BATCH_CHARS or len(rows) >= 2000:
                    yield work(rows)
                    rows, held = [], 0
        if rows:
            yield work(rows)

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), F.xxhash64("doc_id", "text", F.lit(seed)).alias("key")
    )
    return source.mapInArrow(run, OUT_DDL)


def decode_pieces(samples: DataFrame, model: str | None = None) -> DataFrame:
    """``samples`` ids back to text: ``doc_id, sample, text``."""
    ship(samples.sparkSession)
    path = model or public_tokenizers.path(DEFAULT_MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = load(path, 1.0)
        for batch in batches:
            texts = [lattices.decode(np.frombuffer(x.as_py(), "<u4")).decode("utf-8", "replace") for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "sample", "text"])

    return samples.select("doc_id", "sample", "ids").mapInArrow(run, "doc_id long, sample int, text string")

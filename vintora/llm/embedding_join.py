"""Exact near-duplicate vectors by dual traversal of cover trees.

Distinct vectors are scaled to length one, where cosine and Euclidean distance order pairs alike. A top level of centres, fitted
on a bounded sample, deals them into cells; a cell is cut into blocks of bounded size by the distance to its centre, and every
block carries a cover tree of nested levels with halving radii. Blocks that follow each other are stored together as a pack,
once, with the numbers of the input's own precision. Packs meet by reading these files again, one group of packs against another
in a task, so what is written grows with the rows and not with the pairs. Block pairs are dropped before their trees meet:
those of two cells by their centres' distance and both covering radii, those of one cell by their bands of distance. Node pairs
of two trees are dropped by the same bound, which loses no pair, those of the top level by products in single precision with room
for their rounding; node pairs that lie within the threshold as a whole are counted as a whole, with range sums. What is left is
compared in double precision. A task returns link counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from vintora.llm.common import ship
from vintora.llm.components import connected_components
from vintora.llm.ngram_join import _groups
from vintora.sources.workspace import materialise

RADII = (0.5, 0.25, 0.125)
SAMPLE = 2048  #: distinct vectors that the top level is fitted on, at most
CELLS = (16, 256)  #: centres of the top level: one for each full block, within these bounds
BLOCK_ROWS = 4096  #: about
BINS = 256  #: of the distance to a centre, a unit
SLACK = 1e-5  #: more than the rounding of a distance taken from a product of unit vectors
TIE = 1e-9  #: products this close to the threshold are summed again, pair by pair
CHUNK = 65_536  #: pairs compared at once
TILE = 256  #: top nodes multiplied with another tree's at once
HEADS = 64  #: rows that a cover is sought for at once
PACK_BYTES = 2**21  #: of the vectors of a pack, unless one block has more
PACK_ROWS = 512  #: or more, where rows are too few for all cores to have several packs
PACKS_A_TASK = 5  #: on either side, about; a task holds those of one side


@dataclass
class Tree:
    """Vectors of any length in tree order; per level the first row, centre row and covering radius of each node, of vectors scaled to
    length one, rows of a node adjoining."""

    keys: np.ndarray
    copies: np.ndarray
    vectors: np.ndarray
    starts: list[np.ndarray]
    centres: list[np.ndarray]
    radii: list[np.ndarray]

    @cached_property
    def units(self) -> np.ndarray:
        return _units(self.vectors)

    @cached_property
    def tops(self) -> np.ndarray:
        return _units(self.vectors[self.centres[0]]).astype(np.float32)

    @cached_property
    def ends(self) -> list[np.ndarray]:
        return [np.append(s[1:], len(self.keys)) for s in self.starts]

    @cached_property
    def below(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each level's nodes, their nodes of the level below, or their rows."""
        inner = [(np.searchsorted(self.starts[k + 1], self.starts[k]), np.searchsorted(self.starts[k + 1], self.ends[k])) for k in range(len(RADII) - 1)]
        return [*inner, (self.starts[-1], self.ends[-1])]


def _cover(vectors: np.ndarray, rows: np.ndarray, radius: float) -> list[np.ndarray]:
    """Greedy cover: groups of rows within ``radius`` of their first."""
    groups = []
    while len(rows):
        near = vectors[rows[:HEADS]] @ vectors[rows].T >= 1 - radius * radius / 2
        free = np.ones(len(rows), bool)
        for k in range(len(near)):
            if free[k]:
                near[k, k] = True
                groups.append(rows[near[k] & free])
                free &= ~near[k]
        rows = rows[free]
    return groups


def build_tree(keys: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> Tree:
    level = [np.arange(len(keys))]
    levels = []
    for radius in RADII:
        level = [child for rows in level for child in (_cover(vectors, rows, radius) if len(rows) > 1 else [rows])]
        levels.append(level)
    order = np.concatenate(level)
    place = np.argsort(order)
    vectors = vectors[order]
    starts, centres, radii = [], [], []
    for groups in levels:  # nested, so each level's groups adjoin in this order
        if starts and len(groups) == len(starts[-1]):  # nothing was split: the same arrays, which are stored once
            for of in (starts, centres, radii):
                of.append(of[-1])
            continue
        sizes = np.array([len(rows) for rows in groups])
        centre = place[np.array([rows[0] for rows in groups])]
        begin = np.cumsum(sizes) - sizes
        gap = vectors - vectors[np.repeat(centre, sizes)]
        starts.append(begin)
        centres.append(centre)
        radii.append(np.sqrt(np.maximum.reduceat((gap * gap).sum(axis=1), begin)))
    return Tree(keys[order], copies[order], vectors, starts, centres, radii)


def _expand(p: np.ndarray, q: np.ndarray, first: tuple, second: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of the ranges of p and q, in chunks."""
    (a0, a1), (b0, b1) = (x[p] for x in first), (x[q] for x in second)
    wide = b1 - b0
    sizes = (a1 - a0) * wide
    ends = np.cumsum(sizes)
    for c in range(0, int(ends[-1]) if len(ends) else 0, CHUNK):
        at = np.arange(c, min(c + CHUNK, int(ends[-1])))
        of = np.searchsorted(ends, at, "right")
        within = at - (ends[of] - sizes[of])
        yield a0[of] + within // wide[of], b0[of] + within % wide[of]


def _products(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of rows ``x[i]`` and ``y[j]``: as one matrix product where the pairs fill enough of it."""
    used = np.zeros(len(x), bool), np.zeros(len(y), bool)
    used[0][i], used[1][j] = True, True
    rows, columns = np.flatnonzero(used[0]), np.flatnonzero(used[1])
    if len(rows) * len(columns) <= 8 * len(i):
        return (x[rows] @ y[columns].T)[(np.cumsum(used[0]) - 1)[i], (np.cumsum(used[1]) - 1)[j]]
    step = max(1, 2**22 // x.shape[1])
    parts = [np.einsum("ij,ij->i", x[i[c : c + step]], y[j[c : c + step]]) for c in range(0, len(i), step)]
    return np.concatenate(parts) if parts else np.zeros(0)


def _joined(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels with both ends of every edge given the same, the smallest of their components'."""
    while True:
        apart = labels[u] != labels[v]
        u, v = u[apart], v[apart]
        if not len(u):
            return labels
        heads = labels[u], labels[v]
        np.minimum.at(labels, heads[0], heads[1])
        np.minimum.at(labels, heads[1], heads[0])
        while (labels[labels] != labels).any():
            labels = labels[labels]


class Links:
    """Link counts and labels of a block pair, gathered from pairs of rows and pairs of ranges of rows."""

    def __init__(self, one: Tree, two: Tree, same: bool) -> None:
        self.copies = one.copies if same else np.append(one.copies, two.copies)
        self.total = np.append(0, np.cumsum(self.copies))
        self.counts = np.zeros(len(self.copies))
        self.steps = np.zeros(len(self.copies) + 1)  # differences of what ranges add to their rows
        self.bound = np.zeros(len(self.copies) + 1)  # differences of how many ranges join a row to the one before it
        self.labels = np.arange(len(self.copies))

    def join(self, u: np.ndarray, v: np.ndarray) -> None:
        self.labels = _joined(self.labels, u, v)

    def rows(self, u: np.ndarray, v: np.ndarray) -> None:
        """Each row ``u`` links with its row ``v``."""
        self.counts += np.bincount(u, self.copies[v], len(self.counts)) + np.bincount(v, self.copies[u], len(self.counts))
        self.join(u, v)

    def ranges(self, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> None:
        """Every row of a range ``a`` links with every row of its range ``b``; of a range with itself, with every other."""
        own, size = a0 == b0, len(self.steps)
        for (lo, hi), (begin, end), of in (((a0, a1), (b0, b1), slice(None)), ((b0, b1), (a0, a1), ~own)):
            weight = (self.total[end] - self.total[begin])[of]
            self.steps += np.bincount(lo[of], weight, size) - np.bincount(hi[of], weight, size)
            wide = (hi - lo > 1)[of]
            self.bound += np.bincount(lo[of][wide] + 1, minlength=size) - np.bincount(hi[of][wide], minlength=size)
        if own.any():
            alone = np.bincount(a0[own], minlength=size) - np.bincount(a1[own], minlength=size)
            self.counts -= np.cumsum(alone)[:-1] * self.copies
        self.join(a0, b0)

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        inner = np.flatnonzero(np.cumsum(self.bound)[:-1] > 0)
        self.join(inner, inner - 1)
        return self.counts + np.cumsum(self.steps)[:-1], self.labels


def _tops(one: Tree, two: Tree, limit: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of top nodes that can hold rows within ``limit``, in chunks; few others, by the rounding of single precision.

    Their centres' product is 1 - (limit + r + s)^2 / 2 at least, with radii r and s; this bound is part of the product.
    """
    r, s = one.radii[0] + limit + SLACK, two.radii[0]
    left = np.column_stack([one.tops, r * r / 2 - 1, r, np.ones(len(r))]).astype(np.float32)
    right = np.column_stack([two.tops, np.ones(len(s)), s, s * s / 2]).astype(np.float32)
    most = 1 + np.abs(r * r / 2 - 1).max() + r.max() * s.max() + s.max() ** 2 / 2
    least = -most * (left.shape[1] + 2) * 2.0**-23
    for at in range(0, len(left), TILE):
        after = at if same else 0
        found = np.flatnonzero(left[at : at + TILE] @ right[after:].T >= least)
        for c in range(0, len(found), CHUNK):
            p, q = np.divmod(found[c : c + CHUNK], len(right) - after)
            ordered = p + at <= q + after if same else slice(None)
            yield p[ordered] + at, q[ordered] + after


def dual_links(one: Tree, two: Tree, cosine: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Link counts of both trees' rows (by copies), and label of each row, the rows of ``two`` numbered after those of ``one``.

    Node pairs are taken depth first in chunks, so memory does not grow with their number.
    """
    limit = math.sqrt(2 - 2 * cosine)
    links = Links(one, two, same)
    shift = 0 if same else len(one.keys)

    def descend(level: int, p: np.ndarray, q: np.ndarray) -> None:
        dots = _products(one.units, two.units, one.centres[level][p], two.centres[level][q])
        d = np.sqrt(np.maximum(2 - 2 * dots, 0))
        reach = one.radii[level][p] + two.radii[level][q]
        whole = d + reach <= limit - SLACK
        i, j = p[whole], q[whole]
        links.ranges(one.starts[level][i], one.ends[level][i], two.starts[level][j] + shift, two.ends[level][j] + shift)
        near = ~whole & (d <= limit + SLACK + reach)
        for i, j in _expand(p[near], q[near], one.below[level], two.below[level]):
            if level + 1 < len(RADII):
                ordered = i <= j if same else slice(None)
                descend(level + 1, i[ordered], j[ordered])
                continue
            dots = _products(one.units, two.units, i, j)
            close = np.abs(dots - cosine) < TIE
            dots[close] = np.einsum("ij,ij->i", one.units[i[close]], two.units[j[close]])
            good = dots >= cosine
            if same:
                good &= i < j
            links.rows(i[good], j[good] + shift)

    for p, q in _tops(one, two, limit, same):
        descend(0, p, q)
    counts, labels = links.result()
    return counts[: len(one.keys)], counts[shift:], labels


class Tally:
    """Link counts and labels of all packs that a task has met, so each of their rows is returned once."""

    def __init__(self) -> None:
        self.begins: dict[int, np.ndarray] = {}
        self.keys, self.counts, self.labels = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def begin(self, pack: int, blocks: list[dict]) -> np.ndarray:
        """Numbers of the first rows of a pack's blocks."""
        if pack not in self.begins:
            sizes = [len(b["tree"].keys) for b in blocks]
            size, more = len(self.keys), sum(sizes)
            self.begins[pack] = size + np.cumsum(sizes) - sizes
            self.keys = np.concatenate([self.keys, *(b["tree"].keys for b in blocks)])
            self.counts = np.append(self.counts, np.zeros(more))
            self.labels = np.append(self.labels, np.arange(size, size + more))
        return self.begins[pack]

    def add(self, found: list[tuple[int, int, tuple[np.ndarray, np.ndarray, np.ndarray], bool]]) -> None:
        """What ``dual_links`` says of block pairs whose first rows have these numbers."""
        edges = [np.zeros((2, 0), np.int64)]
        for first, second, (n1, n2, labels), same in found:
            self.counts[first : first + len(n1)] += n1
            if not same:
                self.counts[second : second + len(n2)] += n2
            rows = np.arange(first, first + len(n1)) if same else np.append(np.arange(first, first + len(n1)), np.arange(second, second + len(n2)))
            moved = np.flatnonzero(labels != np.arange(len(labels)))
            edges.append(np.stack([rows[moved], rows[labels[moved]]]))
        self.labels = _joined(self.labels, *np.concatenate(edges, axis=1))

    def batches(self) -> Iterator[pa.RecordBatch]:
        some = np.flatnonzero(self.counts > 0)
        for c in range(0, len(some), CHUNK):
            at = some[c : c + CHUNK]
            arrays = [pa.array(self.keys[at]), pa.array(self.counts[at].astype(np.int64)), pa.array(self.keys[self.labels[at]])]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "n", "head"])


def _holds_floats(vectors: DataFrame) -> bool:
    return getattr(vectors.schema["embedding"].dataType, "elementType", None) == FloatType()


def _valid(embedding: Column) -> Column:
    """Whether a vector has a direction: not null, finite in every component, not zero."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(embedding.isNotNull() & fine & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _lengths(matrix: np.ndarray) -> np.ndarray:
    """Lengths of rows. Summed column by column, so a row's does not depend on the rows beside it."""
    total = np.zeros(len(matrix))
    for column in matrix.T:
        total += column * column
    return np.sqrt(total)


def _units(values: np.ndarray) -> np.ndarray:
    values = values.astype(np.float64)
    values /= np.abs(values).max(axis=1, keepdims=True)
    return values / _lengths(values)[:, None]


def _place(units: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell of each row and its distance to the centre, always the same for the same vector.

    Products of integers are exact in any order; the nearest but for their rounding is as good a cell.
    """
    cell = (np.rint(units * 4096) @ np.rint(centres * 4096).T).argmax(axis=1)
    return cell, _lengths(units - centres[cell])


def _planted(value: pa.BinaryScalar) -> list[dict]:
    """Blocks of a stored pack."""
    return [{**block, "tree": Tree(**block["tree"])} for block in pickle.loads(value.as_buffer())]


def _within(one: list[dict], two: list[dict], gaps: np.ndarray, bound: float) -> np.ndarray:
    """Whether the blocks of two packs can hold rows within ``bound``, as in ``block_pairs``."""
    cell, least, most = (np.array([b[k] for b in one])[:, None] for k in ("cell", "least", "most"))
    other, nearest, furthest = (np.array([b[k] for b in two]) for k in ("cell", "least", "most"))
    apart = gaps[cell, other]
    return (apart - most - furthest <= bound) & (least - furthest - apart <= bound) & (nearest - most - apart <= bound)


def _centres(matrix: np.ndarray, cells: int) -> np.ndarray:
    """Farthest-first centres, so that each prefix of them is a level of the cover."""
    chosen, gap = [0], np.linalg.norm(matrix - matrix[0], axis=1)
    while len(chosen) < cells and gap.max() > RADII[-1]:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, np.linalg.norm(matrix - matrix[chosen[-1]], axis=1))
    return matrix[chosen]


def embedding_components(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Rows link when the cosine of their embeddings, in double precision, is ``cosine`` or more. Null vectors, zero vectors and
    those with null or non-finite components link with nothing, neither do vectors of different lengths. Equal vectors are
    compared once and counted as often as they occur; they are told apart by a 64-bit hash. Every row counts, repeated
    ids included; null ids are never the smallest unless there is no other.
    """
    spark = vectors.sparkSession
    ship(spark)
    kind = "float" if _holds_floats(vectors) else "double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    key = F.when(_valid(F.col("embedding")), F.xxhash64(F.col("embedding").cast("array<double>")))
    keyed = rows.select("vec_id", "embedding", key.alias("key"))
    distinct = materialise(
        keyed.where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id"), F.first(F.size("embedding")).alias("dims")),
        "vectors",
    )
    links = []
    for dims, n in distinct.groupBy("dims").count().orderBy("dims").collect():  # one tree per vector length
        alike = keyed.where("key IS NOT NULL").where(F.size("embedding") == dims).select("key", "embedding")
        links.append(_tree_links(alike, distinct.where(F.col("dims") == dims), dims, n, cosine))
    if not links:
        none = F.lit(0).cast("long")
        return rows.select("vec_id", none.alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = links[0]
    for more in links[1:]:
        found = found.union(more)
    counted = found.groupBy("key").agg(F.sum("n").alias("n"))
    parts = connected_components(found.where("head <> key"), "key", "head").select(F.col("node").alias("_node"), "component")
    labelled = distinct.select("key", "copies", "first_id").join(parts, F.col("key") == F.col("_node"), "left")
    least = labelled.where("component IS NOT NULL").groupBy(F.col("component").alias("_of")).agg(F.min("first_id").alias("_least"))
    named = (
        labelled.join(least, F.col("component") == F.col("_of"), "left")
        .join(counted.select(F.col("key").alias("_counted"), "n"), F.col("key") == F.col("_counted"), "left")
        .select(
            F.col("key").alias("_key"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).cast("long").alias("_links"),
            F.coalesce("_least", "first_id").alias("_component"),
        )
    )
    joined = keyed.select("vec_id", "key").join(named, F.col("key") == F.col("_key"), "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("_component"))
    return joined.select(
        "vec_id",
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def cell_cuts(dealt: DataFrame) -> DataFrame:
    """Bands of distances to a cell's centre, of about ``BLOCK_ROWS`` rows each, and in how many parts each is dealt.

    Bands are cut from a histogram of ``BINS`` bins a unit, so their table is bounded by bins and cells; a band that holds more
    rows than a block, as its bin does, is dealt by hash.
    """
    bins = dealt.groupBy(F.col("cell").alias("_cell"), F.floor(F.col("gap") * BINS).alias("_bin")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("_cell").orderBy("_bin")) - F.col("n")
    bands = bins.select("_cell", "_bin", "n", F.floor(before / BLOCK_ROWS).alias("band"))
    parts = F.ceil(F.sum("n").over(Window.partitionBy("_cell", "band")) / BLOCK_ROWS)
    return materialise(bands.select("_cell", "_bin", "band", parts.alias("parts")), "bands")


def cut_cells(dealt: DataFrame, cuts: DataFrame | None = None) -> DataFrame:
    """Rows with their block in the cell, ``salt``, by ``cuts``, or by the rows' own."""
    cuts = cell_cuts(dealt) if cuts is None else cuts
    salt = F.col("band") * 2**20 + F.pmod(F.xxhash64("key"), F.col("parts"))
    joined = dealt.join(F.broadcast(cuts), (F.col("cell") == F.col("_cell")) & (F.floor(F.col("gap") * BINS) == F.col("_bin")))
    others = [c for c in dealt.columns if c != "cell"]
    return joined.select(F.col("cell").cast("long").alias("cell"), salt.alias("salt"), *others)


def block_pairs(salted: DataFrame, centres: np.ndarray, limit: float) -> DataFrame:
    """(a, b): pairs of blocks, each with itself too, that can hold two rows within ``limit`` of each other."""
    blocks = salted.groupBy("cell", "salt").agg(F.min("gap").alias("least"), F.max("gap").alias("most"))
    blocks = materialise(blocks, "blocks")
    gaps = np.linalg.norm(centres[:, None] - centres[None], axis=2) if len(centres) else np.zeros((0, 0))
    between = [(a, b, float(gaps[a, b])) for a in range(len(gaps)) for b in range(a, len(gaps))]  # bounded by CELLS
    cells = salted.sparkSession.createDataFrame(between, "a_cell long, b_cell long, apart double")
    sides = [blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in ("a", "b")]
    bound = limit + SLACK
    possible = (
        (F.col("apart") - F.col("a_most") - F.col("b_most") <= bound)
        & (F.col("a_least") - F.col("b_most") - F.col("apart") <= bound)
        & (F.col("b_least") - F.col("a_most") - F.col("apart") <= bound)
        & ((F.col("a_cell") < F.col("b_cell")) | (F.col("a_salt") <= F.col("b_salt")))
    )
    pairs = sides[0].join(F.broadcast(cells), "a_cell").join(sides[1], "b_cell").where(possible)
    ends = [F.struct(F.col(f"{side}_cell").alias("cell"), F.col(f"{side}_salt").alias("salt")).alias(side) for side in ("a", "b")]
    return pairs.select(*ends)


def pack_pairs(pairs: DataFrame, packs: DataFrame) -> DataFrame:
    """(own, partners): the packs that a pack meets, as a set of bits; each pair of packs is one's or the other's, by turns."""
    for side in ("a", "b"):
        named = packs.select(F.struct("cell", "salt").alias(side), F.col("pack").alias(f"{side}_pack"))
        pairs = pairs.join(F.broadcast(named), side)
    turn = F.pmod(F.col("a_pack") + F.col("b_pack"), F.lit(2)) == 0
    sides = [F.when(turn, F.col(x)).otherwise(F.col(y)) for x, y in (("a_pack", "b_pack"), ("b_pack", "a_pack"))]
    met = pairs.select(sides[0].alias("own"), sides[1].alias("other"))
    bits = met.groupBy("own", F.expr("other DIV 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(other % 64 AS INT))")).alias("bits"))
    return bits.groupBy("own").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("partners"))


def _tree_links(vectors: DataFrame, distinct: DataFrame, dims: int, n: int, cosine: float) -> DataFrame:
    """(key, n, head): link counts of each vector and task, and another vector of its component there.

    ``vectors`` has ``key`` and ``embedding`` of all rows of a length, ``distinct`` the ``n`` keys.
    """
    last = distinct.select("key").orderBy("key").limit(SAMPLE).agg(F.max("key")).first()[0]
    sample = vectors.where(F.col("key") <= last).groupBy("key").agg(F.first("embedding").alias("embedding")).orderBy("key").collect()
    centres = _centres(_units(np.array([r["embedding"] for r in sample])), min(max(CELLS[0], n // BLOCK_ROWS), CELLS[1]))
    gaps = np.linalg.norm(centres[:, None] - centres[None], axis=2)
    limit = math.sqrt(2 - 2 * cosine)
    numbers = np.dtype(np.float32 if _holds_floats(vectors) else np.float64)

    def deal(whole: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys, first, copies = np.unique(batch.column(0).to_numpy(), return_index=True, return_counts=True)
                flat = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)[first]
                cell, gap = _place(_units(flat), centres)
                columns = {"cell": pa.array(cell.astype(np.int32)), "gap": pa.array(gap), "key": pa.array(keys)}
                if whole:
                    ends = np.arange(len(keys) + 1, dtype=np.int32) * (flat.shape[1] * flat.itemsize)
                    buffers = [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat))]
                    columns |= {"copies": pa.array(copies), "vector": pa.Array.from_buffers(pa.binary(), len(keys), buffers)}
                yield pa.RecordBatch.from_pydict(columns)

        schema = "cell int, gap double, key long" + ", copies long, vector binary" * whole
        return vectors.mapInArrow(run, schema)

    places = deal(False).groupBy("key").agg(F.first("cell").alias("cell"), F.first("gap").alias("gap"))
    places = materialise(places, "cells")
    cuts = cell_cuts(places)
    salted = cut_cells(places, cuts)
    sizes = salted.groupBy("cell", "salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("cell", "salt")) - F.col("n")  # a row for each block
    slots = vectors.sparkSession.sparkContext.defaultParallelism
    pack_rows = max(1, min(PACK_BYTES // (dims * numbers.itemsize), max(PACK_ROWS, n // (4 * slots))))
    packs = materialise(sizes.select("cell", "salt", F.floor(before / pack_rows).alias("pack")), "packs")
    n_packs = packs.select("pack").distinct().count()
    side = max(-(-n_packs // PACKS_A_TASK), min(n_packs, math.ceil(math.sqrt(8 * slots))))

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (pack,), held in _groups(batches, ["pack"]):
            values = np.frombuffer(b"".join(held["vector"]), numbers).reshape(len(held["key"]), -1)
            keys, copies = np.array(held["key"], dtype=np.int64), np.array(held["copies"], dtype=np.float64)
            block = np.array([held["cell"], held["salt"]])
            begins = np.flatnonzero(np.append(True, (block[:, 1:] != block[:, :-1]).any(axis=0)))
            blocks = []
            for a, b in zip(begins, np.append(begins[1:], len(keys))):
                units = _units(values[a:b])
                tree = build_tree(np.arange(b - a), copies[a:b], units)
                gap = _lengths(units - centres[block[0, a]])
                stored = {**vars(tree), "keys": keys[a:b][tree.keys], "vectors": values[a:b][tree.keys]}
                blocks.append({"cell": int(block[0, a]), "least": gap.min(), "most": gap.max(), "tree": stored})
            yield pa.RecordBatch.from_arrays([pa.array([pack], pa.int64()), pa.array([pickle.dumps(blocks, 5)], pa.binary())], ["pack", "trees"])

    order = ["pack", "cell", "salt", "key"]
    rows = cut_cells(deal(True), cuts).join(F.broadcast(packs), ["cell", "salt"]).repartition(min(n_packs, 4 * side), "pack")
    rows = rows.groupBy(*order).agg(F.sum("copies").alias("copies"), F.first("vector").alias("vector")).sortWithinPartitions(*order)
    trees = materialise(rows.mapInArrow(plant, "pack long, trees binary"), "trees")
    partners = materialise(pack_pairs(block_pairs(salted, centres, limit), packs), "pack-pairs")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, held, at, mine = Tally(), {}, None, []
        for batch in batches:
            for k, (own, other, meet) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("own", "other", "meet")))):
                if batch["trees"][k].is_valid:
                    at, mine = own, _planted(batch["trees"][k])
                if batch["theirs"][k].is_valid:
                    held[other] = _planted(batch["theirs"][k])
                if not meet:
                    continue
                if at != own:
                    raise RuntimeError(f"pack {own} was not sent")
                theirs = mine if other == own else held[other]
                first, second = tally.begin(own, mine), tally.begin(other, theirs)
                near = _within(mine, theirs, gaps, limit + SLACK)
                found = []
                for i, j in np.argwhere(np.triu(near) if other == own else near):
                    one, two = mine[i]["tree"], theirs[j]["tree"]
                    found.append((first[i], second[j], dual_links(one, two, cosine, one is two), one is two))
                tally.add(found)
                for block in theirs if other != own else ():
                    vars(block["tree"]).pop("units", None)  # twice as long as what is held
        yield from tally.batches()

    # A task reads the files of its packs again, nothing is shuffled. Its rows are pairs, all of a left pack's one after the other; a
    # left pack's trees come with the first right pack, a right pack's with the first left one. Other rows only name those that meet.
    nth = F.monotonically_increasing_id().bitwiseAND(2**33 - 1)
    left = trees.coalesce(side).join(F.broadcast(partners), F.col("pack") == F.col("own")).select("own", "trees", "partners", nth.alias("nth"))
    right = trees.coalesce(side).select(F.col("pack").alias("other"), F.col("trees").alias("theirs"), nth.alias("other_nth"))
    meet = F.expr("(coalesce(element_at(partners, other DIV 64), 0L) & shiftleft(1L, CAST(other % 64 AS INT))) <> 0")
    first = (F.col("nth") == 0) | (F.col("other_nth") == 0)
    sent = left.join(right.hint("shuffle_replicate_nl"), meet | first).select(
        "own",
        F.when(F.col("other_nth") == 0, F.col("trees")).alias("trees"),
        "other",
        F.when(F.col("nth") == 0, F.col("theirs")).alias("theirs"),
        meet.alias("meet"),
    )
    return materialise(sent.mapInArrow(compare, "key long, n long, head long"), "vector-links")

"""Hard-negative mining, vector packing and lexical search against brute force, on whole small tables and odd rows."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintora.llm import hard_negatives, lexical_search, topk, vector_packing, word_bpe
from vintora.llm.queries import QUERIES
from vintora.llm.vector_packing import Limits

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int, score string, rank int, q string"
DOCS = "doc_id long, text string, n long, rank string, texts string"


def rows_of(df, *columns) -> Counter:
    return Counter(tuple(r) for r in df.select(*columns).collect())


# --- top k ------------------------------------------------------------------


@pytest.mark.parametrize("distinct", [True, False])
def test_top_k_in_any_order(distinct):
    rng = random.Random(int(distinct))
    entries = [(rng.randrange(6), rng.randint(-3, 3), rng.randrange(9)) for _ in range(500)]
    best = topk.TopK(6, 4, distinct)
    for a in range(0, len(entries), 37):
        best.add(*(np.array(c, dtype=np.int64) for c in zip(*entries[a : a + 37])))
    for row in range(6):
        own = [(s, i) for r, s, i in entries if r == row]
        want = sorted(set(own) if distinct else own, key=lambda e: (-e[0], e[1]))[:4]
        assert list(zip(best.scores[row].tolist(), best.ids[row].tolist())) == want


# --- hard negatives ---------------------------------------------------------


@pytest.mark.parametrize("width, size", [(1, 2**30), (64, 300), (129, 2**24), (300, 120), (5, 0)])
def test_residue_products_are_exact(width, size):
    rng = np.random.default_rng(width)
    a, b = rng.integers(-size, size + 1, (9, width)), rng.integers(-size, size + 1, (11, width))
    a[0], b[0], b[1] = size, size, -size
    primes = hard_negatives.primes_for(size * size * width)
    got = hard_negatives.products(hard_negatives.residues(a, primes), hard_negatives.residues(b, primes), primes)
    assert (got.astype(object) == a.astype(object) @ b.astype(object).T).all()


def mined(rows, is_anchor, k_pos, k_neg, low, high) -> Counter:
    taking = {
        (i, label, tuple(math.floor(256 * x) for x in e))
        for i, e, label in rows
        if i is not None and label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    }
    out: Counter = Counter()
    for i, label, e in taking:
        if not is_anchor(i):
            continue
        scored = [(sum(x * y for x, y in zip(e, f)), j, other) for j, other, f in taking if j != i and len(f) == len(e)]
        order = lambda pairs: sorted(set(pairs), key=lambda p: (-p[0], p[1]))
        for ps, p in order([(s, j) for s, j, other in scored if other == label])[:k_pos]:
            fit = order([(s, j) for s, j, other in scored if other != label and low * ps <= 100 * s <= high * ps])
            out.update((i, p, rank, n, ps, ns) for rank, (ns, n) in enumerate(fit[:k_neg], 1))
    return out


MINED = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def test_hard_negatives_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    moved = [(i, e, (label + 1) % 10 if i % 7 == 0 else label) for i, e, label in rows]
    got = QUERIES["op11_hard_negatives"](spark, SF)
    assert rows_of(got, *MINED) == mined(moved, lambda i: i % 100 == 0, 5, 5, 80, 100)


def odd_vectors() -> list[tuple]:
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(6) / 3).tolist(), int(rng.integers(0, 3))) for i in range(80)]
    rows += rows[:20]  # repeated rows
    rows += [(5, [0.1] * 6, 2), (5, [0.2] * 6, 1), (0, [0.5] * 6, 0)]  # an id with several vectors
    rows += [(i, [0.25] * 6, i % 2) for i in range(100, 130)]  # ties
    rows += [(200, [0.5] * 3, 0), (201, [0.5] * 3, 1), (202, [], 0), (203, [], 1), (204, [0.0] * 6, 0)]
    rows += [(None, [0.5] * 6, 0), (210, None, 0), (211, [0.5] * 6, None), (212, [0.5, None] * 3, 0)]
    rows += [(213, [math.nan] * 6, 0), (214, [math.inf] * 6, 0), (215, [-2.0e6] * 6, 1), (10, [-2.0e6] * 6, 1)]
    return rows


@pytest.mark.parametrize("group", [16_384, 3])
def test_hard_negatives_odd_rows(spark, monkeypatch, group):
    monkeypatch.setattr(hard_negatives, "GROUP_ANCHORS", group)
    rows = odd_vectors()
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], VECTORS).repartition(5)
    got = hard_negatives.mine_hard_negatives(df, F.col("vec_id") % 5 == 0, 3, 4, 50, 90)
    want = mined(rows, lambda i: i % 5 == 0, 3, 4, 50, 90)
    assert rows_of(got, *MINED) == want and want
    assert hard_negatives.mine_hard_negatives(df.where("1 = 0"), F.lit(True)).count() == 0


def test_hard_negatives_scores_beyond_64_bits_fail(spark):
    df = spark.createDataFrame([(1, [1.0e8] * 6, 0, "x", 1, "y")], VECTORS)
    with pytest.raises(ArithmeticError):
        hard_negatives.mine_hard_negatives(df, F.lit(True))


# --- vector packing ---------------------------------------------------------

LONG = " ".join(f"w{i % 977}" for i in range(30_000))
ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b "), (4, "one two"), (4, "one two"), (None, "It's THE <|endoftext|> don't"),
    (6, LONG), (8, "ünï cödé ΣΑΣ ﬁ 中文 ½ x y é ...?!'s  ''s 😀😀 \x1c\x85z"), (9, "x" * 20_000), (10, "é" * 9_000),
]


def own_ids(text) -> bytes:
    encoder = word_bpe.load(word_bpe.tokenizer_path()).own
    return np.array(encoder.encode(text or "", add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_word_encoder_equals_the_tokenizer_file(spark):
    encoder, rng = word_bpe.load(word_bpe.tokenizer_path()), random.Random(5)
    signs = list("abcXYZ 'sdmtllreve019²½éÉñßſŉǅİıΣσς中 \t\n\x1c\x85-_.,!?…“”😀éªº") + ["<|endoftext|>", "'ll", "'s", " "]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    texts += [t for _, t in ODD if t] + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.text]
    for text in texts:
        assert encoder.encode(text) == own_ids(text), text[:60]


def test_word_encoder_keeps_few_chunks(monkeypatch):
    monkeypatch.setattr(word_bpe, "CHUNKS_HELD", 50)
    encoder = word_bpe.WordBpe(word_bpe.tokenizer_path())
    for text in (LONG[:9000], LONG[4000:20000], LONG[:9000]):
        assert encoder.encode(text) == own_ids(text)
    assert len(encoder._chunks) <= 50 and len(encoder._chunks.older) <= 50


def check_sequences(pieces, limits):
    """Pieces (start, length, sequence, offset, loss); returns the share of padding."""
    held = defaultdict(list)
    for p in pieces:
        held[p[2]].append(p)
    padded = 0
    for own in held.values():
        end = 0
        for _, length, _, offset, _ in sorted(own, key=lambda p: p[3]):
            assert offset == end and length > 0
            end += length
        assert end <= limits.tokens and len(own) <= limits.segments and sum(p[4] for p in own) <= limits.loss
        padded += end if limits.unpadded_powers and not end & (end - 1) else limits.tokens
    return 1 - sum(p[1] for p in pieces) / max(padded, 1)


def check_documents(rows, docs):
    want = Counter((i, own_ids(t) + (2).to_bytes(4, "little")) for i, t in docs)
    spans = defaultdict(list)
    for r in rows:
        spans[r.doc_id].append(r)
    for doc_id, pieces in spans.items():
        texts = [ids for (i, ids), n in want.items() if i == doc_id for _ in range(n)]
        left = Counter((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces)
        for ids in texts:  # repeated rows: each is covered by pieces of its own
            at = 0
            while at < len(ids) // 4:
                fit = [p for p in left if p[0] == at and p[3] == len(ids) // 4 and p[2] == zlib.crc32(ids[4 * at : 4 * (at + p[1])])]
                assert fit, (doc_id, at)
                left -= Counter([fit[0]])
                at += fit[0][1]
        assert not left
    assert set(spans) == {i for i, _ in want}
    return check_sequences([(r.start, r.length, r.sequence_id, r.offset, r.loss_tokens) for r in rows], Limits())


def test_vector_packing_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert check_documents(QUERIES["op12_vector_packing"](spark, SF).collect(), docs) == 0


def test_vector_packing_odd_rows(spark):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in ODD], DOCS).repartition(2)
    assert check_documents(vector_packing.pack_documents(df).collect(), ODD) == 0
    assert vector_packing.pack_documents(df.where("1 = 0")).count() == 0


def test_packed_ids_are_the_examples(spark):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in ODD if r[0] not in (None, 4)], DOCS)
    parts = defaultdict(list)
    for r in vector_packing.pack_examples(vector_packing.encode_examples(vector_packing.document_examples(df))).collect():
        parts[r.example_id].append((r.start, bytes(r.ids)))
    for i, text in ODD:
        if i not in (None, 4):
            assert b"".join(p for _, p in sorted(parts[i])) == own_ids(text) + (2).to_bytes(4, "little")


def test_conversations_keep_all_three_limits(spark):
    limits = Limits(tokens=256, segments=6, loss=100, cut_to_fill=False, unpadded_powers=False)
    turns = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    examples = vector_packing.conversation_examples(turns)
    encoded = vector_packing.encode_examples(examples)
    assert encoded.count() == turns.where("role = 'assistant'").count() > 0
    rows = vector_packing.pack_examples(encoded, limits).collect()
    check_sequences([(r.start, r.length, r.sequence_id, r.offset, r.loss_tokens) for r in rows], limits)
    sizes = Counter((r.example_id, len(r.ids) // 4, r.loss_from) for r in encoded.collect())
    whole = Counter((r.example_id, r.example_tokens) for r in rows if r.length == r.example_tokens)
    fitting = Counter((i, n) for (i, n, loss), k in sizes.items() if n <= 256 and n - loss <= 100 for _ in range(k))
    assert whole == fitting  # only examples over a limit are cut
    assert sum(r.length for r in rows) == sum(n * k for (_, n, _), k in sizes.items())


@pytest.mark.parametrize("seed", range(12))
def test_planner_covers_every_example(seed):
    rng = np.random.default_rng(seed)
    limits = Limits(*(int(x) for x in (rng.integers(1, 99), rng.integers(1, 9), rng.integers(1, 99))), bool(seed % 2), bool(seed % 3))
    sizes = rng.integers(1, [4, 60, 300][seed % 3], rng.integers(0, 200))
    loss_from = rng.integers(0, sizes + 1) if len(sizes) else sizes
    plan = vector_packing.plan_sequences(sizes, loss_from, limits)
    check_sequences([(s, n, q, o, max(0, s + n - max(s, int(loss_from[i])))) for i, s, n, q, o in plan], limits)
    spans = defaultdict(list)
    for i, s, n, _, _ in plan:
        spans[i].append((s, n))
    for i, size in enumerate(sizes.tolist()):
        end = 0
        for s, n in sorted(spans[i]):
            assert s == end
            end += n
        assert end == size


def test_limits_must_allow_a_token():
    with pytest.raises(ValueError):
        Limits(loss=0)


# --- lexical search ---------------------------------------------------------


def ranked(docs, items, k) -> Counter:
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    texts = [(i, Counter(words(t))) for i, t in docs]
    n, total = sum(bool(c) for _, c in texts), sum(sum(c.values()) for _, c in texts)
    holding: Counter = Counter(t for _, c in texts for t in c)
    out: Counter = Counter()
    for item, text in set(items):
        scored = []
        for i, c in texts:
            score = 0
            for t in words(text):
                if c[t]:
                    m = 75 + 25 * sum(c.values()) * n // total
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * holding[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0 and i is not None:
                scored.append((-score, i))
        out.update((item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1))
    return out


RANKED = ("item_id", "rank", "doc_id", "score")


def test_lexical_search_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert rows_of(QUERIES["op13_lexical_search"](spark, SF), *RANKED) == ranked(docs, items, 20)


@pytest.mark.parametrize("block_terms, doc_block, cells", [(200_000, 1024, 8_000_000), (40, 7, 300)])
def test_lexical_search_odd_rows(spark, monkeypatch, block_terms, doc_block, cells):
    for name, value in (("BLOCK_TERMS", block_terms), ("DOC_BLOCK", doc_block), ("BLOCK_CELLS", cells)):
        monkeypatch.setattr(lexical_search, name, value)
    rng = random.Random(2)
    word = lambda: rng.choice(["alpha", "Beta", "γάμμα", "x1", "ñandú", "Ñandú", "q"]) + rng.choice(["", str(rng.randint(0, 30))])
    docs = [(i, " ".join(word() for _ in range(rng.randint(1, 60)))) for i in range(150)]
    docs += docs[:9] + [(500 + i, "alpha-beta_q alpha") for i in range(40)] + [(None, "alpha beta"), (7, None), (8, ""), (9, "!? _\x00")]
    docs += [(900, " ".join(f"x{i % 40} filler{i}" for i in range(20_000)))]
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 12)))) for i in range(30)]
    items += [(0, "alpha"), (3, None), (4, ""), (31, "absent"), (32, "alpha " * 50), (33, "ALPHA beta"), (33, "ALPHA beta"), (None, "q")]
    d = spark.createDataFrame([(*r, 1, "x", "y") for r in docs], DOCS).repartition(4)
    i = spark.createDataFrame([(*r, "z", 5) for r in items], "item_id long, text string, doc_id string, score int")
    assert rows_of(lexical_search.search(d, i, 6), *RANKED) == ranked(docs, items, 6)
    assert lexical_search.search(d.where("1 = 0"), i).count() == 0
    assert lexical_search.search(d, i.where("1 = 0")).count() == 0


def test_node_pairs_are_pruned():
    """Two groups of documents with terms of their own: the bounds keep items out of the other group's leaves."""
    n = 512
    names = [b"a%d" % i for i in range(40)] + [b"b%d" % i for i in range(40)]
    row = np.repeat(np.arange(16), 5)
    term = (np.arange(80) % 5 * 7 + np.repeat(np.arange(16) // 8 * 40, 5)).astype(np.int64)
    items = lexical_search.Items(list(range(16)), {t: i for i, t in enumerate(names)}, row, term, np.ones(80, dtype=np.int64))
    tree = lexical_search._ItemTree(items, np.full(80, 500))
    rng = np.random.default_rng(1)
    doc_row = np.repeat(np.arange(n), 6)
    doc_term = (np.concatenate([rng.choice(40, 6, replace=False) for _ in range(n)]) + np.repeat(np.arange(n) % 2 * 40, 6)).astype(np.int64)
    best = topk.TopK(16, 5, False)
    scored = lexical_search._search_block(tree, best, np.arange(n), doc_row, doc_term, np.full(6 * n, 400_000))
    assert 0 < scored < 0.8 * (n // 16) * 4
    again = lexical_search._search_block(tree, best, np.arange(n) + n, doc_row, doc_term, np.full(6 * n, 1000))
    assert again == 0  # all scores stay below the weakest found

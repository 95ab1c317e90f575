"""Vectors, archives, urls, piece sampling, components and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import itertools
import math
import os
import threading
import time
from collections import Counter, defaultdict
from contextlib import contextmanager, suppress
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from tests.llm import brute
from vintora.llm import embedding_join, piece_sampling, url_filter, warc
from vintora.llm.components import connected_components
from vintora.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# --- components -------------------------------------------------------------


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 201)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200, 201: 200}


# --- vectors ----------------------------------------------------------------


def vector_rows() -> list[tuple]:
    rng = np.random.default_rng(5)
    base = rng.standard_normal((30, 6))
    near = np.concatenate([base[:8] + rng.standard_normal((8, 6)) * s for s in (0.0, 0.1, 0.2, 0.3)])
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, near, near[:5], 3 * base[:3]]))]
    odd = [None, [], [0.0] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] + [0.0] * 5, [1.0, 2.0], [2.0, 4.0]]
    rows += [(1000 + i, v) for i, v in enumerate(odd)]
    return rows + [(3, base[3].tolist()), (None, base[0].tolist())]


def expected_vectors(rows, least=0.9):
    ids = [r[0] for r in rows]
    links = brute.cosine_links([r[1] for r in rows], least)
    count = Counter(itertools.chain.from_iterable(links))
    of = brute.components(ids, links)
    return sorted(((i, count[k], c, i == c) for k, (i, c) in enumerate(zip(ids, of))), key=repr)


def test_vectors(spark, monkeypatch):
    columns = ["vec_id", "n_links", "component_id", "kept"]
    rows = vector_rows()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want = expected_vectors(rows)
    for block in (4096, 7):
        monkeypatch.setattr(embedding_join, "BLOCK_ROWS", block)
        got = sorted((tuple(r) for r in embedding_join.embedding_components(frame).select(*columns).collect()), key=repr)
        assert got == want
    assert embedding_join.embedding_components(frame.where("1 = 0")).count() == 0


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors_of_many_packs(spark, monkeypatch, kind):
    rows = [(i, v and [x if x is None else float(np.dtype(kind).type(x)) for x in v]) for i, v in vector_rows()]
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    monkeypatch.setattr(embedding_join, "BLOCK_ROWS", 3)
    monkeypatch.setattr(embedding_join, "PACK_BYTES", 2 * 6 * np.dtype(kind).itemsize)
    got = embedding_join.embedding_components(frame).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == expected_vectors(rows)


@contextmanager
def files_written(spark):
    """Sizes of the files that shuffles and tables have written, also of those that go meanwhile."""
    tops = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    tops.append(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    found, over = {}, threading.Event()

    def look():
        for f in (Path(d, name) for top in tops for d, _, names in os.walk(top) for name in names):
            with suppress(OSError):
                found[f] = max(found.get(f, 0), f.stat().st_size)

    def watch():
        while not over.wait(0.05):
            look()

    look()
    before, written = set(found), {}
    watcher = threading.Thread(target=watch)
    watcher.start()
    yield written
    over.set()
    watcher.join()
    look()
    written.update({f: size for f, size in found.items() if f not in before})


def test_vectors_disk_grows_with_rows_not_with_block_pairs(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((1500, 64)))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").cache()
    assert frame.count() == 1500
    monkeypatch.setattr(embedding_join, "BLOCK_ROWS", 25)
    with files_written(spark) as written:
        assert embedding_join.embedding_components(frame).where("n_links > 0").count() == 0
    assert 1500 * 64 * 4 < sum(written.values()) < 4 * 1500 * 64 * 4 + 3_000_000  # what small files have besides


def test_vectors_have_their_place_whatever_is_beside_them():
    rng = np.random.default_rng(7)
    x, centres = rng.standard_normal((300, 37)), embedding_join._units(rng.standard_normal((20, 37)))
    cell, gap = embedding_join._place(embedding_join._units(x), centres)
    for step in (1, 2, 7, 64):
        parts = [embedding_join._place(embedding_join._units(x[k : k + step]), centres) for k in range(0, 300, step)]
        assert (np.concatenate([p[0] for p in parts]) == cell).all() and (np.concatenate([p[1] for p in parts]) == gap).all()


@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("scale", [0.01, 0.05, 0.2])
def test_top_nodes_in_reach_are_all_found(scale, same, monkeypatch):
    monkeypatch.setattr(embedding_join, "TILE", 16)
    rng = np.random.default_rng(8)
    x = np.repeat(rng.standard_normal((60, 12)), 6, axis=0) + scale * rng.standard_normal((360, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    one, two = (embedding_join.build_tree(np.arange(len(v)), np.ones(len(v)), v) for v in (x[::2], x[1::2]))
    two = one if same else two
    limit = math.sqrt(0.2)
    tops = [t.vectors[t.centres[0]] for t in (one, two)]
    apart = np.linalg.norm(tops[0][:, None] - tops[1][None], axis=2)
    reach = apart <= limit + one.radii[0][:, None] + two.radii[0][None]
    got = [pair for p, q in embedding_join._tops(one, two, limit, same) for pair in zip(p.tolist(), q.tolist())]
    want = {(int(i), int(j)) for i, j in np.argwhere(np.triu(reach) if same else reach)}
    assert len(got) == len(set(got)) and want <= set(got) and len(got) < 1.2 * len(want) + 20


def test_vectors_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = sorted((tuple(r) for r in QUERIES["op6_embedding_near_dedup"](spark, SF).collect()), key=repr)
    assert got == expected_vectors(rows)


@pytest.mark.parametrize("scale", [0.01, 0.05, 0.2, 0.5])
def test_dual_traversal_counts(scale):
    rng = np.random.default_rng(2)
    x = np.repeat(rng.standard_normal((12, 8)), 12, axis=0) + scale * rng.standard_normal((144, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    copies, keys = rng.integers(1, 4, 144).astype(float), np.arange(144)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    tree = embedding_join.build_tree(keys, copies, x)
    counts, _, labels = embedding_join.dual_links(tree, tree, 0.9, True)
    assert (counts == (near @ copies)[tree.keys]).all()
    want = brute.roots(144, zip(*np.nonzero(near)))
    found = {int(k): int(tree.keys[label]) for k, label in zip(tree.keys, labels)}
    assert len({(want[k], want[found[k]]) for k in range(144) if want[k] != want[found[k]]}) == 0
    assert len(set(found.values())) == len(set(want))


@pytest.mark.parametrize("scale", [0.02, 0.1, 0.4])
def test_dual_traversal_of_two_trees(scale):
    rng = np.random.default_rng(4)
    x = np.repeat(rng.standard_normal((6, 8)), 30, axis=0) + scale * rng.standard_normal((180, 8))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True))[rng.permutation(180)]
    copies = rng.integers(1, 4, 180).astype(float)
    one, two = (embedding_join.build_tree(np.arange(180)[k], copies[k], x[k]) for k in (slice(0, 70), slice(70, 180)))
    left, right, labels = embedding_join.dual_links(one, two, 0.9, False)
    near = x[:70] @ x[70:].T >= 0.9
    assert (left == (near @ copies[70:])[one.keys]).all() and (right == (copies[:70] @ near)[two.keys - 70]).all()
    keys = np.append(one.keys, two.keys)
    want = brute.roots(180, ((i, 70 + j) for i, j in zip(*np.nonzero(near))))
    groups = {tuple(sorted(k for k in range(180) if want[k] == w)) for w in want}
    assert {tuple(sorted(keys[labels == label])) for label in set(labels)} == groups


@pytest.mark.parametrize("scale", [0.02, 0.04])
def test_a_full_block_of_close_vectors(scale):
    rng = np.random.default_rng(0)
    x = np.ones(64) / 8 + scale * rng.standard_normal((embedding_join.BLOCK_ROWS, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = embedding_join.build_tree(np.arange(len(x)), np.ones(len(x)), x)
    begun = time.process_time()
    counts, _, labels = embedding_join.dual_links(tree, tree, 0.9, True)
    assert time.process_time() - begun < 40  # some 2 s with one thread
    assert (counts == ((x @ x.T >= 0.9).sum(axis=1) - 1)[tree.keys]).all() and (labels == 0).all()


def test_blocks_out_of_reach_are_never_paired(spark, monkeypatch):
    monkeypatch.setattr(embedding_join, "BLOCK_ROWS", 50)
    centres = np.eye(2)
    gaps = [(0, k / 1000) for k in range(0, 1400, 4)] + [(1, k / 4000) for k in range(100)] + [(0, 0.5)] * 120
    rows = [(cell, gap, k, 1, b"") for k, (cell, gap) in enumerate(gaps)]
    cut = embedding_join.cut_cells(spark.createDataFrame(rows, "cell int, gap double, key long, copies long, unit binary")).cache()
    assert cut.count() == len(rows) and max(r["count"] for r in cut.groupBy("cell", "salt").count().collect()) < 150
    limit = math.sqrt(0.2)
    found = {(tuple(r.a), tuple(r.b)) for r in embedding_join.block_pairs(cut, centres, limit).collect()}
    held = defaultdict(list)
    for r in cut.collect():
        held[r.cell, r.salt].append(r.gap)
    apart = lambda a, b: 0 if a[0] == b[0] else math.sqrt(2)
    possible = {
        (a, b)
        for a in held
        for b in held
        if a <= b and any(apart(a, b) - g - h <= limit and abs(g - h) - apart(a, b) <= limit for g in held[a] for h in held[b])
    }
    assert possible <= found and len(found) < len(held) * (len(held) + 1) // 2


# --- archives ---------------------------------------------------------------


def pages(spark):
    rows = [
        (1, "http://a/", "x" * 5000),
        (2, "http://a/\r\nEvil: 1", "x" * 5000),
        (3, None, None),
        (4, "u", ""),
        (5, "v", "é\r\n\r\nWARC/1.1"),
        (None, "w", "é\r\n\r\nWARC/1.1"),
        (1, "z", "x" * 5000),
    ]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_archives_round_trip(spark):
    rows, frame = pages(spark)
    records = warc.archive_pages(frame)
    first: dict = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    want = []
    for i, _, html in rows:
        data, one = (html or "").encode(), first[html or ""]
        again = i != one
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((i, len(data), digest, "revisit" if again else "response", one if again else None))
    assert sorted(map(tuple, warc.page_report(records).collect()), key=repr) == sorted(want, key=repr)
    payloads = {bytes(r.payload) for r in records.where("record_type = 'response'").collect()}
    assert payloads == {(h or "").encode() for _, _, h in rows}
    assert all(r.record_type == "response" for r in warc.page_records(frame, min_bytes=10_000).collect())
    assert warc.archive_pages(frame.where("1 = 0")).count() == 0


def test_filters_reach_the_reader(spark):
    _, frame = pages(spark)
    chosen = warc.archive_pages(frame).where("record_type = 'revisit' and target_uri = 'u'")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "record_type#" in plan and "= revisit" not in plan
    assert [r.record_id for r in chosen.collect()] == ["urn:page:4"]
    reader = warc.WarcReader("x", 1, True, True)
    rest = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload_bytes",), 3)]))
    assert reader.tests == [("record_type", ["revisit"])] and len(rest) == 1


def test_members_without_stated_length_and_plain_records(tmp_path):
    one = warc.warc_record("response", "a", "u", None, b"body" * 1000, None, None)
    two = warc.warc_record("revisit", "b", "u", "a", None, "ABC", 4)
    import gzip

    for name, data in (("x.warc.gz", gzip.compress(one) + warc.gzip_member(two) + gzip.compress(one)), ("x.warc", one + two + one)):
        (tmp_path / name).write_bytes(data)
        reader = warc.WarcReader(str(tmp_path), 1 << 20, True, True)
        part = warc.Files([(str(tmp_path / name), len(data))])
        got = [r for b in reader.read(part) for r in b.to_pylist()]
        assert [(r["record_id"], r["payload"], r["payload_bytes"]) for r in got] == [("a", b"body" * 1000, 4000), ("b", None, 4), ("a", b"body" * 1000, 4000)]
        reader.tests = [("record_type", ["revisit"])]
        assert [r["record_id"] for b in reader.read(part) for r in b.to_pylist()] == ["b"]
    broken = one.replace(b"bodybody", b"BODYbody", 1)
    (tmp_path / "y.warc").write_bytes(broken)
    with pytest.raises(ValueError):
        list(reader.__class__(str(tmp_path), 1, True, True).read(warc.Files([(str(tmp_path / "y.warc"), len(broken))])))


# --- urls -------------------------------------------------------------------


def plain_rule(host: str, path: str) -> str | None:
    fits = []
    for _, rule in url_filter.RULES:
        domain, _, rest = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest):
            fits.append(rule)
    return max(fits, key=len, default=None)


def plain_parts(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Net", "http://x.net/", "http://x.example.net/en/1?q#f", "http://xexample.com/de/1"]
    urls += ["http://b.Example.COM/de/", "http://c.org/fr/9", "http://c.org?x=/fr/", "a://b://c/d", "http://é.org/fr/é", "http://h/1/2/3/4/5/6/7/8"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(0, "http://c.org/fr/9"), (None, "http://x.net/")]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (99, 1)], "page_id long, bad int")
    got = url_filter.judge_urls(frame, labels)
    verdicts = dict((r, v) for v, r in url_filter.RULES)
    want = []
    for i, u in rows:
        host, path = plain_parts(u)
        rule = plain_rule(host, path)
        want.append((i, host, path, rule, verdicts.get(rule, "allow")))
    assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert url_filter.judge_urls(frame.where("1 = 0"), labels).count() == 0


def test_bad_template_is_rejected(spark):
    rows = [(i, f"http://h.io/{'spam' if i % 2 else 'news'}/{i}") for i in range(400)]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "page_id long, bad int")
    got = {r.page_id: (r.verdict, r.template) for r in url_filter.judge_urls(frame, labels).collect()}
    assert all(got[i] == (("block", "/spam/*") if i % 2 else ("allow", "/news/*")) for i in range(400))


def test_bad_branches_at_any_depth_and_size(spark):
    rows, bad = [], {}

    def add(url: str, is_bad: int | None) -> None:
        rows.append((len(rows), url))
        bad[len(rows) - 1] = is_bad

    for i in range(400):  # below the fifth slash
        add(f"http://deep.io/a/b/c/d/e/{'spam' if i % 2 else 'news'}/{i}", i % 2)
    for k in range(60):  # a small bad branch beside 60 good ones
        for i in range(60):
            add(f"http://wide.io/{'bad' if k == 0 else 'good' + chr(97 + k % 26) + chr(97 + k // 26)}/{i}", int(k == 0))
    for k in range(40):  # 20 bad branches too small for the limit each, together enough
        for i in range(6):
            add(f"http://many.io/{chr(97 + k % 26) * (1 + k // 26)}/{i}", int(k < 20))
    for i in range(300):  # a wholly bad branch beside one that is bad in three of ten pages, among good ones
        add(f"http://mixed.io/{'xyz'[i % 3]}/{i}", int(i % 3 == 0 or (i % 3 == 1 and i % 10 < 3)))
    add("http://deep.io/a/b/c/d/e/spam/unlabelled", None)
    frame = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame(list(bad.items()), "page_id long, bad int")
    got = {r.page_id: r for r in url_filter.judge_urls(frame, labels).collect()}
    for i, url in rows:
        wrong = "mixed.io/y/" in url
        want = "allow" if wrong or bad[i] == 0 else "block"
        assert got[i].verdict == want, (url, got[i])
    shares = Counter((r.host, r.template, r.bad_share) for r in got.values())
    total, all_bad = sum(b is not None for b in bad.values()), sum(b or 0 for b in bad.values())
    hosts = {h: [bad[i] for i in bad if got[i].host == h and bad[i] is not None] for h, _, _ in shares}
    assert len({(h, t) for h, t, _ in shares}) == len(shares)
    for host, template, share in shares:
        own = [bad[i] for i in bad if (got[i].host, got[i].template) == (host, template) and bad[i] is not None]
        base = (sum(hosts[host]) + 20 * all_bad / total) / (len(hosts[host]) + 20)
        assert math.isclose(share, (sum(own) + 20 * base) / (len(own) + 20))


def test_single_labels_are_no_branch_of_their_own(spark):
    rows = [(i, f"http://slug.io/{''.join(chr(97 + int(c)) for c in str(i))}") for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in rows], "page_id long, bad int")
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), labels)
    assert {(r.template, r.verdict) for r in got.collect()} == {("/?", "allow")}


def test_urls_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()]
    got = sorted((tuple(r)[:4] for r in QUERIES["op3_url_filter"](spark, SF).collect()), key=repr)
    assert got == sorted(((i, *plain_parts(u), plain_rule(*plain_parts(u))) for i, u in rows), key=repr)


# --- piece sampling ---------------------------------------------------------


def every_segmentation(lattices, text: str) -> dict:
    def rest(i: int):
        if i == len(text):
            yield (), 0.0
            return
        single = False
        for j in range(i + 1, min(len(text), i + lattices.longest) + 1):
            hit = lattices.pieces.get(text[i:j])
            if hit:
                single = single or j == i + 1
                for ids, log in rest(j):
                    yield (hit[0], *ids), math.log(hit[1]) + log
        if not single:
            raw = [lattices.bytes[b] for b in text[i].encode()]
            for ids, log in rest(i + 1):
                yield (*raw, *ids), len(raw) * math.log(lattices.byte_weight) + log

    logs = dict(rest(0))
    total = sum(math.exp(x) for x in logs.values())
    return {k: math.exp(v) / total for k, v in logs.items()}


def test_samples_follow_the_law_without_replacement():
    lattices = piece_sampling.Lattices(public_tokenizers.path(piece_sampling.DEFAULT_MODEL), 1.0)
    text = "▁the\n"
    law = every_segmentation(lattices, text)
    starts = lattices.starts([piece_sampling.UNITS.findall(text)])[0]
    runs, pairs = 6000, Counter()
    for seed in range(runs):
        found, _ = piece_sampling.sample_text(lattices, starts, seed * 7919 + 13, 3)
        ids = [tuple(lattices.ids_of(p.edges).tolist()) for p in found]
        assert len(set(ids)) == 3
        assert all(p.log == pytest.approx(math.log(law[i])) for p, i in zip(found, ids))
        pairs[ids[0], ids[1]] += 1
    for a, b in itertools.permutations(law, 2):
        assert abs(pairs[a, b] / runs - law[a] * law[b] / (1 - law[a])) < 0.02
    found, threshold = piece_sampling.sample_text(lattices, starts, 5, 1000)
    assert len(found) == len(law) and threshold == -math.inf


def test_sampling_round_trip(spark):
    rows = [(1, None), (2, ""), (3, "Hello  world\n\té€😀 "), (3, "Hello  world\n\té€😀 "), (None, "a"), (5, "x" * 3000), (6, "ab " * 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    samples = piece_sampling.sample_pieces(docs, k=3)
    got = samples.collect()
    assert all(r.round_trip and r.log_prob <= 1e-9 and r.log_inclusion <= 0 for r in got)
    assert len({bytes(r.ids) for r in got if r.doc_id == 3}) == 3 and sum(r.doc_id == 3 for r in got) == 6
    assert sum(r.doc_id in (1, 2) for r in got) == 2
    texts = {(r.doc_id, r.text) for r in piece_sampling.decode_pieces(samples).collect()}
    assert texts == {(i, t or "") for i, t in rows}
    assert piece_sampling.sample_pieces(docs.where("1 = 0")).count() == 0


# --- pipeline ---------------------------------------------------------------


def test_pipeline(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    packed = corpus_pipeline.run(spark, sf).collect()
    stages = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        stages = stage(spark, stages, sf)
        assert stages.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in stages.select("doc_id", "text").collect()]
    assert {r.doc_id for r in packed} == {i for i, _ in rows}
    assert brute.jaccard_links([t for _, t in rows], 5, 80) == []
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = Counter(labels[i] for i, _ in rows if i in labels)
    assert kept[0] <= 0.05 * kept[1]

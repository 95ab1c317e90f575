"""Operators on documents against brute force, on whole small tables and on odd rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from vintora.llm import attribution, bpe, licenses, ngram_join, packing, quality_knn, quality_rules
from vintora.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
ODD = [
    (1, None, "a", "x", "y"),
    (2, "", "a", None, "y"),
    (3, " \t\n\x0b ", None, "x", None),
    (4, "one two", None, "x", "y"),
    (4, "one two", None, "x", "y"),
    (4, "ONE\ttwo", "b", "x", "y"),
    (None, "The Apache  License and the mit license, CC BY.\nline\n\nline", "b", "x", "y"),
    (6, LONG, "b", "x", "y"),
    (7, LONG.replace("w5 ", "q5 ", 1), "b", "x", "y"),
    (8, "ünï cödé <|endoftext|> ***\u00a0x", "b", "x", "y"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, brute.DOCS).repartition(3)


@pytest.fixture(scope="module")
def small(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return rows


def as_rows(df, *columns) -> list:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- packing ----------------------------------------------------------------


def check_packing(rows, docs):
    encoder = bpe.load(bpe.tokenizer_path())
    want = Counter()
    for doc_id, text in docs:
        ids = np.array([*encoder.encode(text or ""), 2], dtype="<u4")
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        want.update((doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    held: dict = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in held.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 1024
    return len(held)


def test_packing_whole_table(spark, small):
    rows = QUERIES["op2_best_fit_packing"](spark, SF).collect()
    n = check_packing(rows, small)
    assert n <= 1.02 * (sum(r.length for r in rows) / 1024) + 1


def test_packing_odd_rows(odd):
    check_packing(packing.pack(odd).collect(), [(r[0], r[1]) for r in ODD])


def test_packing_empty_table(odd):
    assert packing.pack(odd.where("1 = 0")).count() == 0


def test_packed_sequences_hold_the_ids(odd):
    placed = packing.place_pieces(packing.encode_pieces(odd))
    rows = placed.collect()
    for s in packing.sequences(placed).collect():
        parts = sorted((r.offset, bytes(r.ids)) for r in rows if r.sequence_id == s.sequence_id)
        assert bytes(s.ids) == b"".join(p for _, p in parts)


@pytest.mark.parametrize("seed", range(40))
def test_plan_equals_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 10, 64])
    counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 300)))
    bins: dict[int, list] = {}
    for length, low, high, per, first, offset in packing.plan_slots(counts, capacity):
        for k in range(low, high):
            bins.setdefault(first + (k - low) // per, []).append((offset + (k - low) % per * length, length))
    room: list[int] = []
    for length in sorted(counts.elements(), reverse=True):
        fits = [i for i, r in enumerate(room) if r >= length]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= length
        else:
            room.append(capacity - length)
    assert len(bins) == len(room)
    assert Counter(n for b in bins.values() for _, n in b) == counts


# --- token attribution ------------------------------------------------------


def test_encoder_equals_the_tokenizer_file(small):
    from tokenizers import Tokenizer

    path = bpe.tokenizer_path()
    slow = Tokenizer.from_file(path)
    for text in [t for _, t in small[:60]] + [r[1] for r in ODD if r[1] is not None]:
        assert bpe.load(path).encode(text) == slow.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("rule", attribution.RULES)
def test_attribution(odd, rule):
    encoder = bpe.load(bpe.tokenizer_path())
    rows = attribution.attribute_tokens(odd, rule).collect()
    total = sum(len(encoder.encode(r[1] or "")) for r in ODD)
    assert sum(r.n_tokens for r in rows) == pytest.approx(total)
    for r in (r for r in rows if r.doc_id == 8):
        assert (r.char_start, r.char_end) == (0, len(ODD[-1][1]))
    lines = [r for r in rows if r.doc_id is None]
    text = ODD[6][1]
    assert [text[r.char_start : r.char_end] for r in sorted(lines, key=lambda r: r.section)] == text.splitlines(keepends=True)


def test_attribution_spans_and_rule_check(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma", [0, 3, 11])], "doc_id long, text string, cuts array<long>")
    rows = attribution.attribute_tokens(docs, "share", spans="cuts").orderBy("section").collect()
    assert [(r.char_start, r.char_end) for r in rows] == [(0, 3), (3, 11), (11, 16)]
    assert sum(r.n_tokens for r in rows) == pytest.approx(len(bpe.load(bpe.tokenizer_path()).encode("alpha beta gamma")))
    with pytest.raises(ValueError):
        attribution.attribute_tokens(docs, "other")


# --- quality rules ----------------------------------------------------------


def test_rule_counts(spark, small, odd):
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = as_rows(QUERIES["op10_quality_rules"](spark, SF), "doc_id", *columns)
    assert got == sorted(((d, *brute.base_counts(t)) for d, t in small), key=repr)
    got = as_rows(quality_rules.report(quality_rules.judge_documents(odd)), "doc_id", *columns)
    assert got == sorted(((r[0], *brute.base_counts(r[1])) for r in ODD), key=repr)


def test_template_lines_deplete_documents(spark):
    own = lambda i: " ".join(f"own{i}w{k}" for k in range(12))
    template = " ".join(f"menu{k}" for k in range(40))
    rows = [(i, f"{template} \n{'' if i % 2 else own(i)}\n{i}", "h", None, None) for i in range(30)]
    rows += [(100 + i, own(0), "h", None, None) for i in range(50)]  # copies are one text
    docs = spark.createDataFrame(rows, brute.DOCS)
    kept = {r.doc_id: r.kept for r in quality_rules.judge_documents(docs, min_left=0.2).collect()}
    assert all(kept[i] == (i % 2 == 0) for i in range(30)) and all(kept[100 + i] for i in range(50))
    stay = quality_rules.keep_documents(docs)
    assert stay.columns == docs.columns
    assert {r.doc_id for r in stay.collect()} == {d for d, k in kept.items() if k}
    assert quality_rules.judge_documents(docs.where("1 = 0")).count() == 0


def letters(i: int) -> str:
    """Twelve words of text ``i``; digits would be alike in every text."""
    return " ".join(f"Own{chr(97 + i // 26)}{chr(97 + i % 26)}{chr(97 + k)}" for k in range(12))


def test_template_lines_are_removed_from_texts(spark):
    own = letters
    shared = lambda i: f"Menu {i % 10}\tHOME  news\r"
    rows = [(i, f"{shared(i)}\n{own(i)}\n\n Last {own(i + 40)}\n{shared(i + 1)}", "h", "p", "l") for i in range(30)]
    rows += [(100 + i, f"{shared(i)}\n{own(i)}", None, None, None) for i in range(30)]
    rows += [(200, f"{shared(0)}\n{own(200)}", "rare", None, None), (300, None, "h", None, None), (301, "few", "h", None, None)]
    docs = spark.createDataFrame(rows, brute.DOCS).repartition(3)
    cleaned = quality_rules.clean_documents(docs)
    assert cleaned.columns == docs.columns
    got = sorted((tuple(r) for r in cleaned.collect()), key=repr)
    want = [(i, f"{own(i)}\n\n Last {own(i + 40)}", "h", "p", "l") for i in range(30)]
    want += [(100 + i, own(i), None, None, None) for i in range(30)] + [rows[60]]
    assert got == sorted(want, key=repr)
    assert quality_rules.clean_documents(docs.where("1 = 0")).count() == 0


def test_template_lines_beyond_an_absolute_count(spark):
    """On a host of very many texts a line below the share is template all the same."""
    rows = [(i, f"{'Skip to content' if i < 30 else letters(i + 200)}\n{letters(i)}", "h", None, None) for i in range(90)]
    docs = spark.createDataFrame(rows, brute.DOCS)
    for max_texts, cut in ((30, False), (29, True)):
        cleaned = quality_rules.clean_documents(docs, max_share=0.5, max_texts=max_texts)
        assert sum("Skip" in r.text for r in cleaned.collect()) == (0 if cut else 30)


def test_pipeline_stage_hands_on_cleaned_texts(spark):
    own = letters
    rows = [(i, f"Skip to content\n{own(i)}", "h", None, None) for i in range(30)]
    stay = corpus_pipeline.line_rules(spark, spark.createDataFrame(rows, brute.DOCS), SF)
    assert sorted((r.doc_id, r.text) for r in stay.collect()) == [(i, own(i)) for i in range(30)]


# --- licenses ---------------------------------------------------------------


def test_license_counts(spark, small, odd):
    columns = ["n_words", "n_base", "first_word", "last_word", "base_labels"]
    got = as_rows(QUERIES["op8_license_scan"](spark, SF), "doc_id", *columns)
    assert got == sorted(((d, *brute.license_counts(t, licenses.BASE)) for d, t in small), key=repr)
    got = as_rows(licenses.scan_licenses(odd), "doc_id", *columns)
    assert got == sorted(((r[0], *brute.license_counts(r[1], licenses.BASE)) for r in ODD), key=repr)
    assert licenses.scan_licenses(odd.where("1 = 0")).count() == 0


def test_edited_notice_is_found_on_neighbouring_diagonals(spark):
    text = "x y this work is really licensed under the gnu general public license version 3 z"
    docs = spark.createDataFrame([(1, text), (2, "the gnu general public license"), (3, "version 3 of this work")], "doc_id long, text string")
    got = {r.doc_id: (r.base_labels, r.labels, r.score) for r in licenses.scan_licenses(docs).collect()}
    assert got[1][0] == "gpl" and "gpl-3.0" in got[1][1] and 0.7 <= got[1][2] <= 1
    assert got[2] == ("gpl", "gpl", 1.0) and got[3] == ("", "", 0.0)


# --- n-gram join ------------------------------------------------------------


def expected_components(rows, n, percent):
    ids, texts = [r[0] for r in rows], [r[1] for r in rows]
    found = brute.components(ids, jaccard_pairs(texts, n, percent))
    return sorted(((i, len(brute.shingles(t, n)), c) for i, t, c in zip(ids, texts, found)), key=repr)


def jaccard_pairs(texts, n, percent):
    return brute.jaccard_links(texts, n, percent)


def near_copies(n: int) -> list[tuple]:
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        for k in rng.sample(range(120), rng.randint(0, 5)):
            words[k] = f"e{i}x{k}"
        rows.append((i, " ".join(words), "s", None, None))
    return rows


def test_jaccard_whole_table_and_odd_rows(spark, small, odd):
    columns = ["doc_id", "n_shingles", "component_id"]
    assert as_rows(QUERIES["op4_ngram_jaccard_join"](spark, SF), *columns) == expected_components(small, 4, 85)
    assert as_rows(ngram_join.jaccard_components(odd), *columns) == expected_components(ODD, 4, 85)


def test_jaccard_split_family(spark, monkeypatch):
    for name, value in (("TILE_ROWS", 16), ("BLOCK_ENTRIES", 5000), ("RANGE_ENTRIES", 3000), ("HEAVY_IN_BLOCK", 8)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = near_copies(150)
    got = as_rows(ngram_join.jaccard_components(spark.createDataFrame(rows, brute.DOCS)), "doc_id", "n_shingles", "component_id")
    assert got == expected_components(rows, 4, 85)


def test_rows_of_a_chained_family_meet_in_bounded_groups(spark, monkeypatch):
    rng, largest = random.Random(7), []
    passages = [" ".join(f"p{i}w{k}" for k in range(20)) for i in range(60)]
    rows = [(i, " ".join(rng.sample(passages, 8)), "s", None, None) for i in range(500)]
    rows += [(500 + i, f"{rows[5 * i][1]} end", "s", None, None) for i in range(60)]
    links = ngram_join._tile_links

    def counted(pairs, percent):
        group = [c for c in ("family", "tile", "block") if c in pairs.columns]
        largest.append(pairs.groupBy(*group).count().agg(F.max("count")).first()[0] or 0)
        return links(pairs, percent)

    monkeypatch.setattr(ngram_join, "TILE_ROWS", 16)
    monkeypatch.setattr(ngram_join, "_tile_links", counted)
    got = as_rows(ngram_join.jaccard_components(spark.createDataFrame(rows, brute.DOCS)), "doc_id", "n_shingles", "component_id")
    assert got == expected_components(rows, 4, 85)
    assert len(largest) == 3 and max(largest) <= 12 * 16


def test_representatives(odd, spark):
    kept = ngram_join.keep_representatives(odd, n=5, percent=80)
    assert kept.columns == odd.columns
    assert as_rows(kept, "doc_id") == sorted([(1,), (2,), (3,), (4,), (None,), (6,), (8,)], key=repr)
    assert ngram_join.keep_representatives(odd.where("1 = 0")).count() == 0


# --- quality classifier -----------------------------------------------------


def test_classifier_separates_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op9_quality_classifier"](spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == q for p, q in judged) >= 0.95 * len(judged)
    assert all(p == 1 for p, q in judged if q == 1)


def test_votes_against_brute_force(small):
    texts = [(t or "") for _, t in small[:160]] + [""]
    terms = [quality_knn.text_terms(t) for t in texts]
    pairs, grades = np.stack([p for p, _ in terms]), np.stack([g for _, g in terms])
    labels = np.arange(60) % 2
    model = quality_knn.fit(pairs[:60], grades[:60], labels, dims=8, neighbours=5)

    def rows(k):  # the term matrix, in double precision
        idf = np.log(61 / (1 + (pairs[:60] > 0).sum(axis=0))) + 1
        x = np.log1p(pairs[k]) * idf
        x /= max(np.linalg.norm(x), 1e-12)
        return np.concatenate([x, *[quality_knn.GRADE_WEIGHT * g / np.sqrt(quality_knn.GRADES) for g in (grades[k], 1 - grades[k])]])

    matrix = np.stack([rows(k) for k in range(len(texts))])
    centred = matrix - matrix[:60].mean(axis=0)
    latent = centred @ np.linalg.svd(centred[:60], full_matrices=False)[2][:8].T
    unit = [v / max(np.linalg.norm(v), 1e-12) for v in latent]
    far = 0
    for k, score in enumerate(quality_knn.vote(model, pairs, grades)):
        near = sorted(((float(unit[k] @ unit[j]), j) for j in range(60)), reverse=True)[:5]
        weights = [max(c, 1e-6) ** 4 for c, _ in near]
        far += abs(score - sum(w * labels[j] for w, (_, j) in zip(weights, near)) / sum(weights)) > 0.03
    assert far <= len(texts) // 20  # the basis is iterated, so neighbours at nearly one distance may change places


def test_classifier_odd_rows(spark, odd):
    labels = spark.createDataFrame([(6, 1, 0), (4, 0, 0), (4, 0, 1), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality_knn.classify(odd, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 1 for r in quality_knn.classify(odd, labels.where("1 = 0")).collect())
    assert quality_knn.keep_documents(odd, labels).columns == odd.columns


# --- clashing names, repeated phrases, null spans ---------------------------


def test_helper_names_do_not_clash(spark):
    extra = ["_id", "_text", "_host", "_cut", "_good", "_good_text", "_good_host", "_key", "label"]
    kinds = "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in extra)
    lines = "menu entry a of the common page\nfooter text b with some other links"
    rows = [(i, f"{lines}\n" + " ".join(f"w{i}x{k}" for k in range(30)), "h", *extra) for i in range(30)]
    docs = spark.createDataFrame([*rows, (99, None, None, *extra)], kinds)
    assert ngram_join.keep_representatives(docs).columns == docs.columns
    assert ngram_join.keep_representatives(docs).count() == 31
    assert quality_rules.keep_documents(docs).columns == docs.columns
    cleaned = quality_rules.clean_documents(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == 30
    assert not any("menu" in r.text or "footer" in r.text for r in cleaned.collect()) and {r["_id"] for r in cleaned.collect()} == {"_id"}
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    kept = quality_knn.keep_documents(docs, labels)
    want = {r.doc_id for r in quality_knn.classify(docs, labels).where("predicted = 1").collect()}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want
    assert quality_knn.keep_documents(docs.where("1 = 0"), labels).count() == 0


def covers(words: list, template: list, max_shift: int) -> list[float]:
    """Covers of the spans of one template, restated on word pairs."""
    hits = [(at, pos) for at in range(len(template) - 1) for pos in range(len(words) - 1) if words[pos : pos + 2] == template[at : at + 2]]
    spans: list[list] = []
    for diagonal in sorted({pos - at for at, pos in hits}):
        if not spans or diagonal - spans[-1][-1] > max_shift:
            spans.append([])
        spans[-1].append(diagonal)
    out = []
    for span in spans:
        own, best = sorted(h for h in hits if h[1] - h[0] in span), 0
        for step in (1, -1):
            taken: list = []
            for at, pos in own[::step]:
                if not taken or ((at - taken[-1][0]) * step > 0 and 0 < (pos - taken[-1][1]) * step <= (at - taken[-1][0]) * step + max_shift):
                    taken.append((at, pos))
            best = max(best, len(taken))
        out.append(best / (len(template) - 1))
    return out


def test_license_labels_need_the_template_in_order(spark, small):
    texts = ["cc by " * 5, "licensed under " * 5, "0 4 nc by cc under licensed", "licensed under the cc by nc 4 0", "cc by licensed under cc by sa 4 0 cc by"]
    texts += [" ".join(reversed(n.split())) for n, _ in licenses.NOTICES] + [f"{n} {n}" for n, _ in licenses.NOTICES]
    rows = [*enumerate(texts), *((1000 + i, t) for i, t in small)]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = __import__("re").findall(licenses.WORD, lowered)
        n_base, base = brute.license_counts(text, licenses.BASE)[1], brute.license_counts(text, licenses.BASE)[4]
        good = [(label, c) for notice, label in licenses.NOTICES for c in covers(words, notice.split(), 3) if c >= 0.7]
        labels = sorted({*filter(None, base.split(",")), *(label for label, _ in good)})
        assert got[i] == (",".join(labels), pytest.approx(max([float(n_base > 0), *(c for _, c in good)]))), text
    assert got[0] == ("cc-by", 1.0) and got[1] == ("", 0.0) and got[2] == ("", 0.0)
    with pytest.raises(ValueError):
        licenses.scan_licenses(spark.createDataFrame(rows[:1], "doc_id long, text string"), base=[("mit", "mit")])


@pytest.mark.parametrize("rule", ["start", "majority", "share"])
def test_tokens_per_section_against_brute_force(spark, rule):
    encoder = bpe.load(bpe.tokenizer_path())
    texts = ["one two\nthree  \n\n four", "ünï\ncödé \u4e2d\u6587\n", "", None, "a\n" * 30]
    spans = [[0, None, 4, 9], [2, 3], [None], None, [0, 5, 1000]]
    docs = spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(zip(texts, spans))], "doc_id long, text string, s array<long>")
    for given in (None, "s"):
        got = {(r.doc_id, r.section): (r.char_start, r.n_tokens, r.n_crossing) for r in attribution.attribute_tokens(docs, rule, spans=given).collect()}
        want = {}
        for i, (text, own) in enumerate(zip(texts, spans)):
            data = (text or "").encode()
            if given and own is not None:
                chars = [0, *[x for x in own if x is not None][1:]]
                cuts = [len((text or "")[:c].encode()) for c in chars]
            else:
                cuts = [0, *[k + 1 for k, b in enumerate(data) if b == 10 and k + 1 < len(data)]]
            edges, counts, crossing, at = [*cuts, len(data)], [0.0] * len(cuts), [0] * len(cuts), 0
            section = lambda byte: max(k for k, c in enumerate(cuts) if c <= byte)
            for token in encoder.encode(text or ""):
                size = int(encoder.sizes[token])
                first, last = section(at), section(at + size - 1)
                parts = [sum(edges[k] <= b < edges[k + 1] for b in range(at, at + size)) for k in range(len(cuts))]
                if rule == "start" or first == last:
                    counts[first] += 1
                elif rule == "majority":
                    counts[parts.index(max(parts))] += 1
                else:
                    counts = [c + p / size for c, p in zip(counts, parts)]
                for k in range(first, last):
                    crossing[k] += 1
                at += size
            for k, c in enumerate(cuts):
                want[i, k] = (len(data[:c].decode()), pytest.approx(counts[k]), crossing[k])
        assert got == want
    assert attribution.attribute_tokens(docs.where("1 = 0"), rule).count() == 0


# --- the whole pipeline on odd and empty tables ------------------------------


def tables(spark, folder, docs, labels) -> str:
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_odd_rows_and_extra_columns(spark, tmp_path):
    # letters only: lines that differ in digits alone count as one template line
    letters = lambda i: chr(97 + i // 26) + chr(97 + i % 26)
    prose = lambda i: " ".join(f"w{letters(i)}x{letters(k)}" for k in range(40))
    rows = [(i, prose(i), "h", "id", "text", 1) for i in range(40)]
    rows += [rows[3], (50, prose(3), "h", "id", "text", 1), (51, prose(4) + " end", "h", "id", "text", 1)]
    rows += [(52, None, None, None, None, None), (53, "", "h", "id", "text", 1), (None, prose(60), None, "id", "text", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _id string, _text string, piece int")
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")
    sf = tables(spark, tmp_path, docs, labels)
    packed = corpus_pipeline.run(spark, sf).collect()
    # all labels are good, so nothing is rejected for quality; texts without words go, copies leave one row of their group
    assert Counter(r.doc_id for r in packed) == Counter([*range(40), None])


def test_pipeline_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], brute.DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, docs, labels)).count() == 0

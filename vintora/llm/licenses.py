"""License scan by diagonal voting.

All rolling word pairs of every text are hashed and joined to the word pairs of a fixed set of templates. A match votes for
its diagonal, the text position minus the template position: an intact passage puts all its votes on one
diagonal, an edited one on neighbouring ones. Neighbouring diagonals of a template are merged into a span, and
a span is reported when it covers enough of the template. Everything is DataFrame expressions; the template table is
a literal of fixed size and the only side that is broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintora.llm.common import ascii_lower
from vintora.operators.inline_tables import inline_table
from vintora.sources.workspace import materialise

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 2

#: Phrases whose every consecutive occurrence counts, with their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Longer notices, found with edits; their labels name the exact licence.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
)


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def license_words(text: Column) -> Column:
    """Maximal runs of letters, digits and characters beyond ASCII, A-Z lower-cased; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def grams(words: str) -> Column:
    """Hash of each pair of neighbouring words, in order."""
    pairs = F.transform(words, lambda _, i: F.xxhash64(F.slice(words, i + 1, F.lit(GRAM))))
    return F.slice(pairs, F.lit(1), F.greatest(F.size(words) - (GRAM - 1), F.lit(0)))


def template_grams(spark: SparkSession, base: Sequence[tuple[str, str]], notices: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows (_gram, template, at, first, second, size, is_base, label) of the templates, each at least two words long."""
    short = [p for p, _ in [*base, *notices] if len(re.findall(WORD, p)) < GRAM]
    if short:
        raise ValueError(f"phrases of fewer than {GRAM} words: {', '.join(short)}")
    rows = [(i, p, label, i < len(base)) for i, (p, label) in enumerate([*base, *notices])]
    table = inline_table(spark, "template, phrase, label, is_base", rows)
    worded = table.select("template", "label", "is_base", license_words(F.col("phrase")).alias("w"))
    return worded.select(
        "template", "label", "is_base", "w", F.size("w").alias("size"), F.posexplode(grams("w")).alias("at", "_gram")
    ).select("_gram", "template", "at", F.get("w", F.col("at")).alias("first"), F.get("w", F.col("at") + 1).alias("second"), "size", "is_base", "label")


def diagonal_votes(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """Votes per row content, template and diagonal; equal hashes are confirmed on the words themselves."""
    worded = docs.select(
        F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text"), license_words(F.col("text")).alias("_words")
    )
    rolled = worded.select("_id", "_text", "_words", F.posexplode(grams("_words")).alias("_pos", "_gram"))
    same = (F.get("_words", F.col("_pos")) == F.col("first")) & (F.get("_words", F.col("_pos") + 1) == F.col("second"))
    hits = rolled.join(F.broadcast(templates), "_gram").where(F.coalesce(same, F.lit(False)))  # joins by the hash alone
    distinct = hits.select(
        "_id", "_text", "template", "size", "is_base", "label", (F.col("_pos") - F.col("at")).alias("diagonal"), "at"
    ).distinct()
    keys = ["_id", "_text", "template", "size", "is_base", "label", "diagonal"]
    return distinct.groupBy(*keys).agg(
        F.count("*").alias("votes"), F.collect_list("at").alias("ats")  # positions of one template, at most its size
    )


def _in_order(hits: Column, max_shift: int, step: int) -> Column:
    """Template positions that the hits (at, pos) cover one after another in the text, read forwards (1) or backwards (-1).

    Each position takes the nearest place behind that of the position before, with ``max_shift`` words more than the template
    has between them at most.
    """
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("at"), F.lit(0).cast("bigint").alias("pos"))

    def follow(done: Column, hit: Column) -> Column:
        ahead, moved = (hit["at"] - done["at"]) * step, (hit["pos"] - done["pos"]) * step
        next_one = (done["n"] == 0) | ((ahead > 0) & (moved > 0) & (moved - ahead <= max_shift))
        taken = F.struct((done["n"] + 1).alias("n"), hit["at"].alias("at"), hit["pos"].alias("pos"))
        return F.when(next_one, taken).otherwise(done)

    return F.aggregate(F.sort_array(hits, asc=step > 0), start, follow)["n"]


def license_spans(votes: DataFrame, max_shift: int = 3, min_cover: float = 0.7) -> DataFrame:
    """Spans of merged neighbouring diagonals: start and end word, cover of the template, and whether it is verified.

    Diagonals of one template are neighbours when they differ by ``max_shift`` words at most. A span's cover is the share of
    the template's word pairs that stand in it in the template's order, each once however often it is repeated; it is
    verified from ``min_cover`` on.
    """
    one = Window.partitionBy("_id", "_text", "template").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(one) > max_shift, F.lit(True))
    numbered = votes.withColumn("_new", new.cast("int")).withColumn("_span", F.sum("_new").over(one))
    hit = F.transform("ats", lambda at: F.struct(at.alias("at"), (F.col("diagonal") + at).cast("bigint").alias("pos")))
    grouped = numbered.groupBy("_id", "_text", "template", "label", "_span").agg(
        F.first("size").alias("size"), F.flatten(F.collect_list(hit)).alias("hits")
    )
    places = F.transform("hits", lambda h: h["pos"])
    cover = F.greatest(*[_in_order(F.col("hits"), max_shift, step) for step in (1, -1)]) / (F.col("size") - (GRAM - 1))
    return grouped.select(
        *["_id", "_text", "template", "label"],
        F.array_min(places).alias("start_word"),
        (F.array_max(places) + GRAM).alias("end_word"),
        cover.alias("cover"),
    ).withColumn("verified", F.col("cover") >= min_cover)


def scan_licenses(
    docs: DataFrame,
    base: Sequence[tuple[str, str]] = BASE,
    notices: Sequence[tuple[str, str]] = NOTICES,
    max_shift: int = 3,
    min_cover: float = 0.7,
) -> DataFrame:
    """One row per row of ``docs``: words, places of the base phrases, labels and a score.

    ``n_base`` counts places where a base phrase stands in consecutive words, ``first_word`` and ``last_word`` are their
    smallest and largest start (null without one). ``labels`` adds the labels of verified spans, ``score`` is the best
    cover of a verified span or base phrase, 0 without one. Null text has no words. Rows that repeat an id with another text
    are judged by their own text; null ids are kept.
    """
    spark = docs.sparkSession
    votes = materialise(diagonal_votes(docs, template_grams(spark, base, notices)), "license-votes")
    whole = F.col("is_base") & (F.col("votes") == F.col("size") - (GRAM - 1))
    places = votes.where(whole).select(
        "_id", "_text", F.col("diagonal").alias("start"), F.lit(1).alias("is_place"), "label", F.lit(1.0).alias("cover")
    )
    spans = license_spans(votes.where(~F.col("is_base")), max_shift, min_cover).where("verified").select(
        "_id", "_text", F.lit(None).cast("int").alias("start"), F.lit(0).alias("is_place"), "label", "cover"
    )
    found = places.unionByName(spans).groupBy(F.col("_id").alias("_f_id"), F.col("_text").alias("_f_text")).agg(
        F.sum("is_place").cast("long").alias("n_base"),
        F.min("start").cast("long").alias("first_word"),
        F.max("start").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("is_place") == 1, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("cover").alias("score"),
    )
    rows = docs.select(
        F.col("doc_id"), F.xxhash64("text").alias("_text"), F.size(license_words(F.col("text"))).cast("long").alias("n_words")
    )
    same = rows["doc_id"].eqNullSafe(found["_f_id"]) & (rows["_text"] == found["_f_text"])
    return rows.join(found, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )

"""Document rules: word and repetition counts of each text, and lines that one host repeats across documents.

Everything is a DataFrame expression. Words and then windows of their hashes are hashed inside the row; only texts that hold a repeated
window sort theirs, so no window ever leaves its row. Lines are hashed and counted per host over distinct
texts, because exact copies are one document as far as templates go. A line in more than ``max_share`` of a
host's texts, and in more than ``min_texts`` of them, is template and is removed, and so is one in more than
``max_texts`` however many the host has; a text left with less than
``min_left`` of its words is rejected. ``judge_documents`` and ``keep_documents`` judge and leave texts as they are;
``clean_documents`` returns the kept rows with the template lines taken out of their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintora.llm.common import SPACES, ascii_lower, space_words, unused
from vintora.sources.workspace import materialise

SYMBOLS = "#*$%&|<>"
WINDOW = 5


def _repeat_positions(sorted_windows: str) -> Column:
    """Starts of the windows whose hash occurs twice or more, ascending, from (hash, start) in order."""
    at = lambda i: F.get(sorted_windows, i)["h"]
    marked = F.transform(
        sorted_windows,
        lambda x, j: F.struct(
            x["i"].alias("i"),
            (F.coalesce(at(j - 1) == x["h"], F.lit(False)) | F.coalesce(at(j + 1) == x["h"], F.lit(False))).alias("d"),
        ),
    )
    return F.sort_array(F.transform(F.filter(marked, lambda x: x["d"]), lambda x: x["i"]))


def text_counts(docs: DataFrame, host: str = "source") -> DataFrame:
    """``doc_id``, ``_host``, ``_text`` and the counts of every row's text; null text counts as empty."""
    none = F.array().cast("array<bigint>")
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        F.col("doc_id"),
        F.col(host).alias("_host"),
        F.xxhash64(F.col("text")).alias("_text"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("_lines"),
        F.transform(space_words(F.col("text")), lambda w: F.xxhash64(w)).alias("_words"),
    )
    windows = F.transform("_words", lambda w, i: F.xxhash64(w, *[F.get("_words", i + k) for k in range(1, WINDOW)]))
    hashed = base.select(
        *["doc_id", "_host", "_text", "word_chars", "n_symbols"],
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_words").cast("long").alias("n_words"),
        F.when(F.size("_words") < WINDOW, none)
        .otherwise(F.slice(windows, F.lit(1), F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0))))
        .alias("_windows"),
    )
    kept = ["doc_id", "_host", "_text", "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    ordered = hashed.select(
        *kept,
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("_sorted"),
    )
    placed = ordered.select(*kept, F.when(F.col("_sorted").isNotNull(), _repeat_positions("_sorted")).alias("_at"))
    step = F.transform("_at", lambda p, k: F.coalesce(F.least(F.lit(WINDOW), p - F.get("_at", k - 1)), F.lit(WINDOW)))
    covered = F.aggregate(step, F.lit(0), lambda total, x: total + x)
    return placed.select(*kept, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def _plain(text: Column) -> Column:
    return F.translate(ascii_lower(text), "123456789\t\x0b\f\r", "000000000    ")


def _normal(plain_line: Column) -> Column:
    return F.regexp_replace(F.btrim(plain_line), " +", " ")


def host_lines(docs: DataFrame, host: str = "source") -> DataFrame:
    """Distinct (``_host``, ``_text``, ``_line``) with the line's words and its number of occurrences in the text.

    A line is normalised to lower case, single spaces and zeros for digits.
    """
    plain = _plain(F.col("text"))
    lines = docs.where(F.col("text").isNotNull()).select(
        F.col(host).alias("_host"), F.xxhash64(F.col("text")).alias("_text"), F.explode(F.split(plain, "\n")).alias("_raw")
    )
    worded = lines.select("_host", "_text", _normal(F.col("_raw")).alias("_norm")).where(F.col("_norm") != "")
    words = F.length("_norm") - F.length(F.translate("_norm", " ", "")) + 1
    return worded.select("_host", "_text", F.xxhash64("_norm").alias("_line"), words.alias("_n")).groupBy(
        "_host", "_text", "_line"
    ).agg(F.max("_n").cast("long").alias("_n"))


def template_lines(lines: DataFrame, max_share: float, min_texts: int, max_texts: int) -> DataFrame:
    """(``_t_host``, ``_t_line``) of the lines above the limits; counts cover every text of the host."""
    per_line = (
        lines.groupBy(F.col("_host").alias("_t_host"), F.col("_line").alias("_t_line"))
        .agg(F.count("*").alias("_texts"))
        .where(F.col("_texts") > min(min_texts, max_texts))
    )
    texts = (
        lines.select(F.col("_host").alias("_of"), "_text").distinct().groupBy("_of").agg(F.count("*").alias("_all"))
    )
    frequent = per_line.join(texts, F.col("_t_host").eqNullSafe(F.col("_of")))
    limit = F.least(F.greatest(max_share * F.col("_all"), F.lit(float(min_texts))), F.lit(float(max_texts)))
    return frequent.where(F.col("_texts") > limit).select("_t_host", "_t_line")


def judge_documents(
    docs: DataFrame,
    host: str = "source",
    max_share: float = 0.01,
    min_texts: int = 20,
    max_texts: int = 1000,
    min_left: float = 0.2,
    min_words: int = 10,
    max_repeat: int = 20,
) -> DataFrame:
    """One row per row of ``docs``: the counts, ``base_failed``, ``left_words`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or over ``max_repeat`` per cent of them in repeated windows.
    ``kept`` is false for those and for texts whose distinct lines keep less than ``min_left`` of their words once
    template lines are removed. Null text has no words and fails. A null host is a host of its own. Rows with
    the same text and host get the same verdict; an empty table gives an empty result.
    """
    lines = materialise(host_lines(docs, host), "host-lines")
    return _judge(docs, host, lines, template_lines(lines, max_share, min_texts, max_texts), min_left, min_words, max_repeat)


def _is_template() -> Column:
    return F.col("_host").eqNullSafe(F.col("_t_host")) & (F.col("_line") == F.col("_t_line"))


def _judge(
    docs: DataFrame, host: str, lines: DataFrame, templates: DataFrame, min_left: float, min_words: int, max_repeat: int
) -> DataFrame:
    template = F.coalesce(F.col("_template"), F.lit(False))
    left = (
        lines.join(templates.withColumn("_template", F.lit(True)), _is_template(), "left")
        .groupBy(F.col("_host").alias("_of"), F.col("_text").alias("_left_text"))
        .agg(F.sum("_n").alias("_all_words"), F.sum(F.when(template, 0).otherwise(F.col("_n"))).alias("left_words"))
        .where(F.col("left_words") < F.col("_all_words"))
    )
    counts = text_counts(docs, host)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    depleted = F.coalesce(F.col("left_words") < min_left * F.col("_all_words"), F.lit(False))
    joined = counts.join(left, F.col("_host").eqNullSafe(F.col("_of")) & (F.col("_text") == F.col("_left_text")), "left")
    return joined.select(
        *["doc_id", "_host", "_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
        failed.alias("base_failed"),
        "left_words",
        (~failed & ~depleted).alias("kept"),
    )


def report(judged: DataFrame) -> DataFrame:
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def keep_documents(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    Verdicts are written first: a filter on them would otherwise be pushed into the window expressions and repeat them.
    """
    judged = materialise(judge_documents(docs, host, **limits).select("_host", "_text", "kept"), "verdicts")
    good_host, good_text = unused(docs.columns, "_good_host", "_good_text")
    good = judged.where("kept").select(F.col("_host").alias(good_host), F.col("_text").alias(good_text)).distinct()
    same = docs[host].eqNullSafe(F.col(good_host)) & (F.xxhash64(docs["text"]) == F.col(good_text))
    return docs.join(good, same, "left_semi")


def clean_documents(
    docs: DataFrame,
    host: str = "source",
    max_share: float = 0.01,
    min_texts: int = 20,
    max_texts: int = 1000,
    min_left: float = 0.2,
    min_words: int = 10,
    max_repeat: int = 20,
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns and without the template lines in ``text``.

    Other lines stay as they are, blank ones too; a text without a template line is returned unchanged. Each row meets
    only the template lines of its own text.
    """
    lines = materialise(host_lines(docs, host), "host-lines")
    templates = materialise(template_lines(lines, max_share, min_texts, max_texts), "template-lines")
    verdicts = _judge(docs, host, lines, templates, min_left, min_words, max_repeat)
    judged = materialise(verdicts.select("_host", "_text", "kept"), "verdicts")
    cut = (
        lines.join(templates, _is_template())
        .groupBy(F.col("_host").alias("_cut_host"), F.col("_text").alias("_cut_text"))
        .agg(F.collect_set("_line").alias("_cut"))
    )
    good = judged.where("kept").select("_host", "_text").distinct()
    known = good.join(cut, F.col("_host").eqNullSafe(F.col("_cut_host")) & (F.col("_text") == F.col("_cut_text")), "left")
    good_host, good_text, lost = unused(docs.columns, "_host", "_text", "_cut")
    known = known.select("_host", "_text", "_cut").toDF(good_host, good_text, lost)
    same = docs[host].eqNullSafe(F.col(good_host)) & (F.xxhash64(docs["text"]) == F.col(good_text))
    own = F.filter(
        F.split(F.col("text"), "\n"), lambda x: ~F.array_contains(F.col(lost), F.xxhash64(_normal(_plain(x))))
    )
    text = F.when(F.col(lost).isNull(), F.col("text")).otherwise(F.array_join(own, "\n")).alias("text")
    return docs.join(known, same).select(*[text if c == "text" else docs[f"`{c}`"] for c in docs.columns])

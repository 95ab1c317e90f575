"""URL filter: fixed host and path rules first, then a tree of path templates learnt from labelled pages.

Urls are cut into host, path and segments; digits inside a segment are already a wildcard. Distinct host and path
pairs are counted once, and only these counts go through the tree. Level by level, per host and branch,
segments are compared with their siblings by their labelled pages:

* a segment whose share of bad pages differs from that of its siblings together, itself left out, is set apart from them (likelihood
  ratio of two shares against one, above ``z * z``; where the siblings' shares do not spread more than chance has them, plus the
  correction for their number). What is set apart to one side is compared with its like again, until all segments of a group agree; the
  rest, segments without labels among it, is a group too;
* a group of several segments becomes one branch, ``?`` with a sign for each step apart (``?`` cannot occur in a path); a segment
  alone in its group keeps its name.

A branch goes on to the next level while its labels could still fall apart; what is left of a path below is ``*``. So no segment is left out
of its group for its depth or rarity. A template is rejected when its share of bad labelled pages, smoothed by its host's and the host's by the
whole table's, exceeds ``max_bad``. Everything is grouping and joining of counts; a host with a third of all pages is
summed up before it moves. The number of rounds grows with the longest beginning that paths with different labels share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintora.llm.common import ascii_lower
from vintora.sources.workspace import materialise

#: (verdict, host and path); fixed values of the production query.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host between ``://`` and the next ``/ ? #``, A-Z lower-cased; path from there to ``?`` or ``#``.

    Both are empty for null and for urls without ``://``.
    """
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(raw), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule whose host is ``host`` or a parent domain and whose path begins ``path``; else null."""
    fits = []
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        domain, slash, rest = rule.partition("/")
        suffix = (host == domain) | host.endswith("." + domain)
        fits.append(F.when(suffix & path.startswith(slash + rest), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def segments(path: Column) -> Column:
    """Segments of a path, digit runs as ``*``."""
    return F.split(F.regexp_replace(F.regexp_replace(path, "^/", ""), "[0-9]+", "*"), "/")


def _log_likelihood(bad: Column, labelled: Column) -> Column:
    """Logarithm of the likelihood of ``bad`` of ``labelled`` at their own share; 0 for none."""

    def term(k: Column) -> Column:
        return F.when(k > 0, k * F.ln(F.try_divide(k, labelled))).otherwise(F.lit(0.0))

    return term(bad) + term(labelled - bad)


def _side() -> Column:
    """1 or -1 where a segment's bad share lies above or below that of its group's others beyond chance; else 0."""
    others, others_bad = F.col("_all") - F.col("labelled"), F.col("_all_bad") - F.col("bad")
    apart = _log_likelihood(F.col("bad"), F.col("labelled")) + _log_likelihood(others_bad, others)
    ratio = 2 * (apart - _log_likelihood(F.col("_all_bad"), F.col("_all")))
    direction = F.signum(F.col("bad") * others - others_bad * F.col("labelled"))
    share = F.try_divide("_all_bad", "_all")
    noise = share * (1 - share)
    chance = 2 * F.col("_n") + (F.try_divide(F.lit(1.0), noise) - 6) * F.col("_inverse")  # variance of the spread without real differences
    spread = F.try_divide(F.col("_squares") - F.col("_all_bad") * share, noise)
    spreads = F.coalesce(spread > F.col("_n") + F.sqrt(F.col("_limit") * chance), F.lit(False))
    limit = F.col("_limit") + F.when(spreads, F.lit(0.0)).otherwise(2 * F.ln(F.greatest("_n", F.lit(1)).cast("double")))
    return F.when(ratio > limit, direction).otherwise(F.lit(0.0))


def _groups(children: DataFrame, z: float) -> DataFrame:
    """``children`` (_host, template, _seg, labelled, bad) with ``_group``: the sides on which a segment was set apart, in order."""
    grouped, keys = children.withColumn("_group", F.lit("")), ["_host", "template", "_group"]
    while True:
        sums = grouped.groupBy(*[F.col(k).alias(f"{k}_n") for k in keys]).agg(
            F.count_if(F.col("labelled") > 0).alias("_n"),
            F.sum("labelled").alias("_all"),
            F.sum("bad").alias("_all_bad"),
            F.sum(F.try_divide(F.col("bad") * F.col("bad"), F.col("labelled"))).alias("_squares"),
            F.sum(F.try_divide(F.lit(1.0), F.col("labelled"))).alias("_inverse"),
        )
        on = [F.col(k) == F.col(f"{k}_n") for k in keys]
        sided = grouped.join(sums, on).withColumn("_limit", F.lit(z * z)).withColumn("_side", _side())
        sign = F.when(F.col("_side") > 0, F.lit("+")).when(F.col("_side") < 0, F.lit("-")).otherwise(F.lit(""))
        grouped = materialise(sided.select(*children.columns, F.concat("_group", sign).alias("_group"), "_side"), "url-groups")
        done = grouped.where("_side <> 0").isEmpty()
        grouped = grouped.drop("_side")
        if done:
            return grouped


def path_templates(counts: DataFrame, z: float) -> DataFrame:
    """``counts`` (_host, _segments, pages, labelled, bad) with the template each path ends up in."""
    finished, level = [], 0
    going = counts.withColumn("template", F.lit(""))
    while not going.isEmpty():
        longer = F.size("_segments") > level
        branches = going.where(longer).groupBy(F.col("_host").alias("_b_host"), F.col("template").alias("_b_template"))
        sums = branches.agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
        divisible = sums.where(-2 * _log_likelihood(F.col("b"), F.col("n")) > z * z).select("_b_host", "_b_template", F.lit(True).alias("_on"))
        at = (F.col("_host") == F.col("_b_host")) & (F.col("template") == F.col("_b_template"))
        seg = F.when(longer & F.col("_on"), F.get("_segments", F.lit(level)))
        placed = going.join(divisible, at, "left").select(*going.columns, seg.alias("_seg"))
        placed = materialise(placed, "url-level")
        rest = F.when(longer, F.concat("template", F.lit("/*"))).otherwise(F.col("template"))
        finished.append(placed.where("_seg IS NULL").select(*counts.columns, rest.alias("template")))
        open_ = placed.where("_seg IS NOT NULL")
        if open_.isEmpty():
            break
        children = open_.groupBy("_host", "template", "_seg").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
        grouped = _groups(children, z)
        keys = ["_host", "template", "_group"]
        sizes = grouped.groupBy(*[F.col(k).alias(f"{k}_n") for k in keys]).agg(F.count("*").alias("_n"))
        name = F.when(F.col("_n") > 1, F.concat(F.lit("?"), "_group")).otherwise(F.col("_seg"))
        named = grouped.join(sizes, [F.col(k) == F.col(f"{k}_n") for k in keys])
        steps = named.select(*[F.col(k).alias(f"_s{k}") for k in ("_host", "template", "_seg")], name.alias("_step"))
        on = [F.col(k) == F.col(f"_s{k}") for k in ("_host", "template", "_seg")]
        going = materialise(open_.join(steps, on).select(*counts.columns, F.concat_ws("/", "template", "_step").alias("template")), "url-tree")
        level += 1
    tree = finished[0] if finished else going
    for part in finished[1:]:
        tree = tree.union(part)
    return tree


def template_verdicts(tree: DataFrame, prior: float, max_bad: float) -> DataFrame:
    """Smoothed share of bad pages per template, and whether it is rejected."""
    sums = [F.sum(c).alias(c) for c in ("labelled", "bad")]
    whole = tree.agg(F.sum("labelled").alias("_t_labelled"), F.sum("bad").alias("_t_bad")).first()
    base = float(whole["_t_bad"] or 0) / float(whole["_t_labelled"]) if whole["_t_labelled"] else 0.0
    hosts = tree.groupBy(F.col("_host").alias("_h")).agg(F.sum("labelled").alias("_h_labelled"), F.sum("bad").alias("_h_bad"))
    host_bad = (F.col("_h_bad") + prior * base) / (F.col("_h_labelled") + prior)
    smoothed = (F.col("bad") + prior * host_bad) / (F.col("labelled") + prior)
    per = tree.groupBy("_host", "template").agg(*sums).join(hosts, F.col("_host") == F.col("_h"))
    return per.select("_host", "template", "labelled", "bad", smoothed.alias("bad_share"), (smoothed > max_bad).alias("rejected"))


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    z: float = 2.58,
    prior: float = 20.0,
    max_bad: float = 0.5,
) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): host, path, rule, template, smoothed bad share and verdict.

    ``labels`` has (page_id, bad 0/1) for some pages; repeated labels of a page count as their mean, null labels as none.
    Urls without a host fall into the template of the empty host. Without labels nothing is rejected.
    """
    host, path = host_and_path(F.col("url"))
    cut = pages.select(F.col("page_id"), host.alias("host"), path.alias("path")).withColumn("_segments", segments(F.col("path")))
    known = labels.where(F.col("bad").isNotNull()).groupBy(F.col("page_id").alias("_l_id")).agg(F.avg("bad").alias("_bad"))
    counts = materialise(
        cut.join(known, cut["page_id"] == F.col("_l_id"), "left")
        .groupBy(F.col("host").alias("_host"), "_segments")
        .agg(F.count("*").alias("pages"), F.count("_bad").alias("labelled"), F.coalesce(F.sum("_bad"), F.lit(0.0)).alias("bad")),
        "url-counts",
    )
    tree = path_templates(counts, z)
    verdicts = template_verdicts(tree, prior, max_bad).select(
        F.col("_host").alias("_v_host"), F.col("template").alias("_v_template"), "bad_share", "rejected"
    )
    on = (F.col("_host") == F.col("_v_host")) & (F.col("template") == F.col("_v_template"))
    per_path = tree.join(verdicts, on).select("_host", F.col("_segments").alias("_p_segments"), "template", "bad_share", "rejected")
    back = (F.col("host") == F.col("_host")) & (F.col("_segments") == F.col("_p_segments"))
    rule = rule_of(F.col("host"), F.col("path"), rules)
    verdict_of_rule = F.coalesce(*[F.when(F.col("rule") == r, F.lit(v)) for v, r in rules], F.lit(None).cast("string"))
    return (
        cut.join(per_path, back)
        .select("page_id", "host", "path", rule.alias("rule"), "template", "bad_share", "rejected")
        .select(
            *["page_id", "host", "path", "rule"],
            F.coalesce(verdict_of_rule, F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"),
            "template",
            "bad_share",
        )
    )

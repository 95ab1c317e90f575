"""Records of delimited text whose quoted values hold line ends, read from byte ranges.

A file is read by lines from all its ranges. A line is a function of whether it begins inside a quoted value: what it
leaves behind when it begins outside, and when inside. Running compositions of these functions, first within a
range and then over the ranges of a file, tell for every line where it begins. Most lines are whole records and move no further;
only lines of longer records are put together, by range, and what crosses a range is joined at the end.

A quote opens a value only at its start and closes it only before a separator or the end of the line. A value that is never
closed, or longer than ``MAX_LINES`` lines, is no record: each of its lines counts as a malformed one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintora.sources.files import literal
from vintora.sources.workspace import materialise

MAX_LINES = 1000


def _leaves_open(line: Column, sep: str) -> tuple[Column, Column]:
    """Whether a line ends inside a quoted value: when it begins outside, and when inside."""
    mark = "".join(f"\\x{ord(c):02x}" for c in sep)
    body = r'[^"]*+(?:""[^"]*+)*+'
    field = rf'(?:"{body}"(?={mark}|$)|(?!")[^{mark}]*+)'
    opens = rf'(?:{field}{mark})*+"{body}$'
    quoted = line.contains('"')
    closes, reopens = line.rlike(rf'^{body}"(?={mark}|$)'), line.rlike(rf'^{body}"{mark}{opens}')
    return quoted & line.rlike(f"^{opens}"), ~quoted | ~closes | reopens


def files_with_line_ends(spark: SparkSession, files: list[str], sep: str) -> set[str]:
    """Those of the files in which a line ends inside a quoted value."""
    text = spark.read.text([literal(spark, f) for f in files])
    outside, _ = _leaves_open(F.col("value"), sep)
    found = text.where(outside).select(F.col("_metadata.file_path").alias("f")).distinct()
    return {r["f"] for r in found.collect()}  # names of files


def _composed(df: DataFrame, keys: list[str], order: list[str], starts: dict[str, bool]) -> DataFrame:
    """Adds for every name in ``starts`` the state after each row, when the first row of ``keys`` begins in that state.

    ``out`` and ``in`` are the states that a row leaves behind when it begins outside and inside. A row with equal ones
    sets the state, one with ``out`` and without ``in`` turns it round, any other leaves it.
    """
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sets = F.when(F.col("out") == F.col("in"), F.col("out"))
    turns = F.sum((F.col("out") & ~F.col("in")).cast("long")).over(so_far)
    df = df.withColumns({"_sets": sets, "_turns": turns})
    at_set = F.last(F.when(F.col("_sets").isNotNull(), F.col("_turns")), ignorenulls=True).over(so_far)
    df = df.withColumns({"_set": F.last("_sets", ignorenulls=True).over(so_far), "_at": at_set})
    turned = (F.col("_turns") - F.coalesce("_at", F.lit(0))) % 2 == 1
    states = {n: F.coalesce("_set", F.lit(s)) != turned for n, s in starts.items()}
    return df.withColumns(states).drop("_sets", "_turns", "_set", "_at")


def _placed_lines(spark: SparkSession, files: list[str], sep: str) -> DataFrame:
    """Lines with their record's number ``r`` in the range (0: begun before it), place ``k`` in the record, and state after."""
    text = spark.read.text([literal(spark, f) for f in files])
    out, inside = _leaves_open(F.col("value"), sep)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
        out.alias("out"),
        inside.alias("in"),
    )
    both = _composed(lines, ["file", "block"], ["at"], {"after_0": False, "after_1": True})
    order = Window.partitionBy("file", "block").orderBy("at")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    begins = {f"begins_{s}": ~F.lag(f"after_{s}", 1, bool(s)).over(order) for s in (0, 1)}
    both = both.withColumns({**begins, "n": F.row_number().over(order)})
    placed = {}
    for s in (0, 1):
        placed[f"r_{s}"] = F.sum(F.col(f"begins_{s}").cast("long")).over(so_far)
        first = F.max(F.when(F.col(f"begins_{s}"), F.col("n"))).over(so_far)
        placed[f"k_{s}"] = F.col("n") - F.coalesce(first, F.lit(1))
    both = materialise(both.withColumns(placed).drop("out", "in", "begins_0", "begins_1", "n"), "quoted-lines")
    ranges = both.groupBy(F.col("file").alias("_file"), F.col("block").alias("_block")).agg(
        F.max_by("after_0", "at").alias("out"), F.max_by("after_1", "at").alias("in")
    )
    along = Window.partitionBy("_file").orderBy("_block")
    states = _composed(ranges, ["_file"], ["_block"], {"after": False})
    states = states.select("_file", "_block", F.lag("after", 1, False).over(along).alias("inside"))
    here = (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block"))
    chosen = {n: F.when(F.col("inside"), F.col(f"{n}_1")).otherwise(F.col(f"{n}_0")).alias(n) for n in ("after", "r", "k")}
    return both.join(states, here).select("file", "block", "at", "value", *chosen.values())


def text_records(spark: SparkSession, files: list[str], sep: str) -> DataFrame:
    """``file, value, broken`` of every record but each file's first, which is its header; blank ones are left out.

    Line ends inside values become ``\\n``. Lines of unclosed or too long values come one by one with ``broken``.
    """
    lines = _placed_lines(spark, files, sep)
    single = (F.col("k") == 0) & (F.col("r") > 0) & ~F.col("after")
    whole = lines.where(single).select("file", "block", "r", "value", F.lit(False).alias("broken"))
    held = F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"])
    pieces = (
        lines.where(~single)
        .groupBy("file", "block", "r", F.floor(F.col("k") / MAX_LINES).alias("piece"))
        .agg(held.alias("lines"), F.max_by("after", "at").alias("open"))
    )
    of_record = Window.partitionBy("file", "block", "r")
    pieces = pieces.withColumns(
        {"long": F.max("piece").over(of_record) > 0, "open": F.max_by("open", "piece").over(of_record)}
    )
    pieces = materialise(pieces, "quoted-pieces")
    here = pieces.where("piece = 0 AND NOT long AND r > 0 AND NOT open")
    joined = F.array_join("lines", "\n").alias("value")
    inner = here.select("file", "block", "r", joined, F.lit(False).alias("broken"))
    rest = pieces.where("piece > 0").select("file", "block", "r", F.explode("lines").alias("value"), F.lit(True).alias("broken"))
    # what is left crosses a range or is too long: two first pieces of a range at most
    edges = pieces.where("piece = 0 AND (long OR r = 0 OR open)")
    along = Window.partitionBy("file").orderBy("block", "r")
    chained = edges.withColumn("chain", F.sum((F.col("r") > 0).cast("long")).over(along))
    of_chain = Window.partitionBy("file", "chain")
    judged = chained.withColumns(
        {
            "bad": F.bool_or("long").over(of_chain)
            | (F.sum(F.size("lines")).over(of_chain) > MAX_LINES)
            | F.max_by("open", F.struct("block", "r")).over(of_chain)
        }
    )
    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "r", "lines"))), lambda x: x["lines"])
    crossing = (
        judged.where("NOT bad")
        .groupBy("file", "chain")
        .agg(F.min(F.struct("block", "r")).alias("first"), F.array_join(F.flatten(parts), "\n").alias("value"))
        .select("file", "first.block", "first.r", "value", F.lit(False).alias("broken"))
    )
    lost = judged.where("bad").select("file", "block", "r", F.explode("lines").alias("value"), F.lit(True).alias("broken"))
    out = whole.unionByName(inner).unionByName(rest).unionByName(crossing).unionByName(lost)
    return out.where(~((F.col("block") == 0) & (F.col("r") == 1)) & (F.trim("value") != "")).select("file", "value", "broken")

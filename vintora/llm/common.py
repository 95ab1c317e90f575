"""Column helpers shared by the operators of this folder."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = " \t\n\x0b\f\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def space_words(text: Column) -> Column:
    """Words between ASCII white space; none for null, empty or blank text."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(text.isNull() | (bare == ""), F.array().cast("array<string>")).otherwise(
        F.split(bare, r"[\x20\x09-\x0D]+")
    )


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Identity of a row's content: repeated ids with other texts stay apart, true repeats agree."""
    return [F.col(doc_id).alias("_id"), F.xxhash64(F.col(text)).alias("_text")]


def unused(taken: Iterable[str], *names: str) -> list[str]:
    """``names``, each with underscores added until no column in ``taken`` is called so."""
    lower = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in lower:
            name += "_"
        out.append(name)
    return out


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers once per application, as an archive that Spark serves."""
    context = spark.sparkContext
    if getattr(context, "_vintora_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = f"{tempfile.mkdtemp(prefix='vintora-code-')}/vintora.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)
    context._vintora_shipped = True

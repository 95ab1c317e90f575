"""Staged text inputs and committed result tables."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from vintora.operators.quality import Header, installment_marks
from vintora.sources.files import data_files, file_states, names_in, read_small, remove, write_small
from vintora.sources.layouts import INSTALLMENTS
from vintora.sources.normalise import normalise_installments, require_columns
from vintora.sources.readers import MALFORMED, headers, read_text_lines
from vintora.sources.workspace import hadoop_path, together

SOURCE = "_arquivo"
STAGED = "_staged.json"
MANIFESTS = "_manifests"
BUNDLES_KEPT = 2


def source_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of the files of an input, none for a missing one."""
    files, target = hadoop_path(spark, path)
    found = files.globStatus(target) or []
    out = []
    for status in found:
        parts = files.listStatus(status.getPath()) if status.isDirectory() else [status]
        out += [(p.getPath().toString(), p.getLen(), p.getModificationTime()) for p in parts]
    return sorted(out)


def text_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the text inputs, which sizes the shuffles of a run; missing ones count nothing."""
    return sum(length for path in paths for _, length, _ in source_files(spark, path))


# --- staging ---------------------------------------------------------------


def mark_columns(marks: Column) -> list[Column]:
    """``_fora`` for malformed lines, and the failed checks of the others as bits of ``_falhas``.

    Text is parsed where these are written and nowhere else: the gate adds them up.
    """
    return [F.col(MALFORMED).isNotNull().alias("_fora"), marks.alias("_falhas")]


def _staged(spark: SparkSession, dst: str) -> dict | None:
    text = read_small(spark, f"{dst}/{STAGED}")
    return None if text is None else json.loads(text)


def stage_installments(spark: SparkSession, src: str, dst: str, sep: str = ";") -> DataFrame:
    """Convert the text instalments to typed ZSTD Parquet, file by file, and return the rows of well-formed lines.

    Every source file has a folder of its own. Only files that are new or whose length or time differ are
    parsed, all in one job; those that are gone are dropped. The state is one small file that is written last, so a failure
    leaves the earlier copy as it was. Rows stay in the partitions they were read in: no shuffle, and a contract that owns
    a large part of a file cannot fill one task.
    """
    return staged_installments(spark, src, dst, sep).where("NOT _fora").drop("_fora", "_falhas")


def staged_installments(spark: SparkSession, src: str, dst: str, sep: str = ";") -> DataFrame:
    """As ``stage_installments``, with all lines and their ``_fora`` and ``_falhas``."""
    dst = dst.rstrip("/")
    files = data_files(spark, src)
    states = {f: list(s) for f, s in file_states(spark, files).items()}
    marks = installment_marks()
    known = _staged(spark, dst) or {}
    same = known.get("sep") == sep and known.get("checks") == marks.names
    before = known.get("files", {}) if same else {}
    now = {f: before[f] for f in files if f in before and before[f]["state"] == states[f]}
    new = [f for f in files if f not in now]
    if new or set(before) != set(now) or not known:
        if new:
            now |= _parse_files(spark, new, states, dst, sep, marks)
        write_small(spark, f"{dst}/{STAGED}", json.dumps({"sep": sep, "checks": marks.names, "files": now}))
        used = {e["folder"].split("/")[0] for e in now.values() if e["folder"]}
        kept = {e["folder"] for e in now.values() if e["folder"]}
        for run in (n for n in names_in(spark, dst) if n.startswith("run-")):
            if run not in used:
                remove(spark, f"{dst}/{run}")
            else:
                for part in (f"{run}/{n}" for n in names_in(spark, f"{dst}/{run}") if n.startswith("arquivo=")):
                    if part not in kept:
                        remove(spark, f"{dst}/{part}")
    raw = spark.createDataFrame([], INSTALLMENTS.raw_schema.add(MALFORMED, "string"))
    empty = normalise_installments(raw, *mark_columns(marks.bits))
    folders = [f"{dst}/{e['folder']}" for e in now.values() if e["folder"]]
    return spark.read.schema(empty.schema).parquet(*folders) if folders else empty


def _parse_files(spark: SparkSession, new: list[str], states: dict, dst: str, sep: str, marks) -> dict[str, dict]:
    for names in set(headers(spark, new, sep).values()):
        if names:
            require_columns(Header(names), INSTALLMENTS)
    lines = read_text_lines(spark, new, sep, source=SOURCE)
    run = f"run-{uuid.uuid4().hex}"
    key = F.sha1(F.col(SOURCE)).alias("arquivo")
    typed = normalise_installments(lines, *mark_columns(marks.bits), key)
    typed.write.partitionBy("arquivo").option("compression", "zstd").parquet(f"{dst}/{run}")
    written = set(names_in(spark, f"{dst}/{run}"))
    out = {}
    for f in new:
        name = f"arquivo={hashlib.sha1(f.encode()).hexdigest()}"
        out[f] = {"state": states[f], "folder": f"{run}/{name}" if name in written else None}
    return out


# --- results ---------------------------------------------------------------

CSV = {"header": True, "sep": ";", "encoding": "UTF-8", "escape": '"'}


def write_result(df: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Write one result table over an earlier one; True when it has rows.

    An empty result replaces the old table too. The table is persisted, so the emptiness test and the write compute it once.
    """
    kept = df.persist()
    try:
        writer = kept.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.options(**CSV)
        writer.format(fmt).save(path)
        return not kept.isEmpty()
    finally:
        kept.unpersist()


def _commits(spark: SparkSession, folder: str) -> list[str]:
    """Manifests of a bundle folder, the latest last."""
    return [n for n in names_in(spark, f"{folder}/{MANIFESTS}") if n.endswith(".json") and not n.startswith(".")]


def export_bundle(results: Mapping[str, DataFrame], path: str, fmt: str = "parquet") -> dict[str, bool]:
    """Write every result table of a run and commit them together.

    Tables go to a folder of the run; a manifest with their formats and types, written last, makes them the bundle that
    ``read_bundle`` finds. A run that fails leaves the bundle before it whole and removes what it has written. The last
    ``BUNDLES_KEPT`` bundles stay, so a reader of the one before is not disturbed.
    """
    folder = path.rstrip("/")
    spark = next(iter(results.values())).sparkSession
    run = f"run-{uuid.uuid4().hex}"
    try:
        done = together({n: lambda n=n: write_result(results[n], f"{folder}/{run}/{n}", fmt) for n in results})
    except BaseException:
        remove(spark, f"{folder}/{run}")
        raise
    tables = {n: {"rows": done[n], "schema": json.loads(results[n].schema.json())} for n in results}
    earlier = _commits(spark, folder)
    number = int(earlier[-1].split("-")[0]) + 1 if earlier else 1
    name = f"{number:012d}-{run}.json"
    write_small(spark, f"{folder}/{MANIFESTS}/{name}", json.dumps({"run": run, "format": fmt, "tables": tables}))
    for old in earlier[: max(0, len(earlier) + 1 - BUNDLES_KEPT)]:
        remove(spark, f"{folder}/{MANIFESTS}/{old}")
        remove(spark, f"{folder}/{old.split('-', 1)[1].removesuffix('.json')}")
    return done


class NoBundle(FileNotFoundError):
    """A folder without a committed bundle."""


def read_bundle(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables of the latest committed bundle with the columns and types they were written with, text bundles too."""
    folder = path.rstrip("/")
    commits = _commits(spark, folder)
    if not commits:
        raise NoBundle(folder)
    manifest = json.loads(read_small(spark, f"{folder}/{MANIFESTS}/{commits[-1]}"))
    options = CSV if manifest["format"] == "csv" else {}

    def table(name: str, schema: dict) -> DataFrame:
        reader = spark.read.schema(StructType.fromJson(schema)).options(**options)
        return reader.format(manifest["format"]).load(f"{folder}/{manifest['run']}/{name}")

    return {n: table(n, t["schema"]) for n, t in manifest["tables"].items()}

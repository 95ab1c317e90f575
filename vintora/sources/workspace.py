"""Shared scratch folder for tables that cut lineage between jobs."""

from __future__ import annotations

import contextvars
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
RUN_FOLDER: contextvars.ContextVar[str | None] = contextvars.ContextVar("run_folder", default=None)


class NoSharedFolder(RuntimeError):
    """A cluster without ``spark.checkpoint.dir``: executors would write where others cannot read."""


def scratch_root(spark: SparkSession) -> str:
    """Folder the cluster names in ``spark.checkpoint.dir``; a local one only where all tasks run in one process."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise NoSharedFolder(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
    folder = tempfile.mkdtemp(prefix="vintora-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    root = RUN_FOLDER.get() or f"{scratch_root(spark).rstrip('/')}/vintora"
    return f"{root}/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of any URI Spark can open."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


@contextmanager
def run_scratch(spark: SparkSession, name: str = "run") -> Iterator[str]:
    """Intermediates written inside are removed at the end, also after a failure; results must be written by then."""
    folder = new_folder(spark, name)
    token = RUN_FOLDER.set(folder)
    try:
        yield folder
    finally:
        RUN_FOLDER.reset(token)
        files, target = hadoop_path(spark, folder)
        files.delete(target, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table to shared storage and read it back.

    A lost executor then costs a re-read, not a recomputation of the whole plan,
    and every later use scans the written columns it needs.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(jobs: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Submit independent Spark jobs from several driver threads and wait for all.

    Spark runs their stages side by side, so small jobs do not queue behind each other.
    """
    spark = SparkSession.active()
    with ThreadPoolExecutor(max_workers=8) as pool:
        futures = {
            name: pool.submit(contextvars.copy_context().run, inheritable_thread_target(spark)(job))
            for name, job in jobs.items()
        }
        return {name: f.result() for name, f in futures.items()}

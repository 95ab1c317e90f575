"""Files of any store that Spark can open: listing, first bytes, and small files that appear as a whole."""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from vintora.sources.workspace import hadoop_path

HEAD_BYTES = 1 << 20


def _jvm_path(spark: SparkSession, uri: str):
    """Hadoop path of an encoded URI, as Spark names its input files."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Encoded URIs of the files that Spark reads for ``path``: a file, a folder or a pattern; hidden ones are left out.

    They are written as the ``file_path`` of the rows that Spark reads.
    """
    plain = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(plain(_jvm_path(spark, f).toString()).toUri().toString() for f in spark.read.text(path).inputFiles())


def literal(spark: SparkSession, uri: str) -> str:
    """The path of an encoded URI for Spark's readers, with pattern characters taken as they are."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", _jvm_path(spark, uri).toString())


def file_states(spark: SparkSession, uris: list[str]) -> dict[str, tuple[int, int]]:
    """(length, modification time) of files."""

    def state(uri: str) -> tuple[int, int]:
        path = _jvm_path(spark, uri)
        status = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(path)
        return status.getLen(), status.getModificationTime()

    with ThreadPoolExecutor(max_workers=16) as pool:
        return dict(zip(uris, pool.map(state, uris)))


def read_head(spark: SparkSession, uri: str, limit: int = HEAD_BYTES) -> bytes:
    """First bytes of a file, decompressed by the codec that its name stands for."""
    path = _jvm_path(spark, uri)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        return bytes((stream if codec is None else codec.createInputStream(stream)).readNBytes(limit))
    finally:
        stream.close()


def read_small(spark: SparkSession, path: str) -> str | None:
    """A small text file, None where there is none."""
    files, target = hadoop_path(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that appears as a whole or not at all: written aside, then renamed over an earlier one."""
    folder, _, name = path.rstrip("/").rpartition("/")
    files, target = hadoop_path(spark, path)
    _, aside = hadoop_path(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = files.create(aside, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not files.rename(aside, target):
        files.delete(target, False)
        if not files.rename(aside, target):
            raise OSError(f"cannot write {path}")


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none where it does not exist."""
    files, target = hadoop_path(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    files, target = hadoop_path(spark, path)
    files.delete(target, True)

"""Small literal dimensions as local relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"{value!r}D"
    return repr(value)


def inline_table(spark: SparkSession, columns: str, rows: Sequence[Sequence]) -> DataFrame:
    """Literal rows with a known size, so joins against them can be broadcast safely."""
    names = [c.strip() for c in columns.split(",")]
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")

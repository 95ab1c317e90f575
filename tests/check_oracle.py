"""Run every registered query next to its oracle SQL: ``python tests/check_oracle.py [sf] [names...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def frame_rows(pdf):
    """Rows as sorted text with columns in name order."""
    pdf = pdf[sorted(pdf.columns)]
    columns = []
    for c in pdf.columns:
        columns.append(["NULL" if v is None or v is pd.NA or v != v else _show(v) for v in pdf[c].tolist()])
    return sorted(zip(*columns))


def _show(v) -> str:
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return repr(float(v))
    return str(v)


def compare(spark, con, fn, sql, sf_dir):
    """(equal, message) of one query against its oracle."""
    got_df, want_rel = fn(spark, sf_dir), con.sql(sql)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}
    got_types = {f.name: kinds.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in got_df.schema}
    want_types = dict(zip(want_rel.columns, [str(t) for t in want_rel.types]))
    got, want = frame_rows(got_df.toPandas()), frame_rows(want_rel.df())
    if sorted(got_types) != sorted(want_types):
        return False, f"columns {sorted(got_types)} / {sorted(want_types)}"
    note = ", ".join(f"{c}: {got_types[c]}/{want_types[c]}" for c in got_types if got_types[c] != want_types[c])
    if len(got) != len(want):
        return False, f"rows {len(got)} / {len(want)} {note}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return False, f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]} {note}"
    return True, f"{len(got)} rows {note}"


def main() -> int:
    import __spark_entry__ as e
    from tests.session import session

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:] or list(e.queries())
    spark, con = session(), connect(sf_dir)
    oracle, failed = e.oracle_sql(), 0
    for name in names:
        start = time.time()
        try:
            if name in oracle:
                ok, message = compare(spark, con, e.queries()[name], oracle[name], sf_dir)
            else:
                ok, message = True, f"{len(e.queries()[name](spark, sf_dir).toPandas())} rows, no oracle"
        except Exception as error:  # report and go on with the next query
            ok, message = False, str(error)[:600]
        failed += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.1f}s {message}", flush=True)
    print(f"{failed} failed of {len(names)}")
    return failed


if __name__ == "__main__":
    raise SystemExit(main())

"""Run registered queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


_SPARK_KIND = {"bigint": "int", "int": "int"}
_KIND = {"BIGINT": "int", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean"}


def _sorted_frame(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    for c in frame.columns:
        if frame[c].dtype == object:
            frame[c] = frame[c].map(lambda v: None if v is None or v is pd.NaT else str(v)[:10] if hasattr(v, "isoformat") else v)
    return frame.sort_values(list(frame.columns), kind="stable", na_position="last").reset_index(drop=True)


def _unequal(x: pd.Series, y: pd.Series) -> np.ndarray:
    """Rows that differ in value, in being missing, or in the sign of zero."""
    x_null, y_null = x.isna().to_numpy(), y.isna().to_numpy()
    both = ~x_null & ~y_null
    out = x_null != y_null
    a, b = x.to_numpy()[both], y.to_numpy()[both]
    different = a != b
    if x.dtype.kind == "f" and y.dtype.kind == "f":
        different |= np.signbit(a) != np.signbit(b)
    out[both] = different
    return out


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides agree exactly, otherwise what differs first."""
    rel = con.sql(sql)
    kinds = {n: _KIND.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}
    theirs = rel.to_arrow_table().to_pandas()
    ours = spark_df.toArrow().to_pandas()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for field in spark_df.schema.fields:
        kind = _SPARK_KIND.get(field.dataType.simpleString(), field.dataType.simpleString())
        if kind != kinds[field.name]:
            return f"type of {field.name}: {kind} != {kinds[field.name]}"
    a, b = _sorted_frame(ours), _sorted_frame(theirs)
    for c in a.columns:
        bad = _unequal(a[c], b[c])
        if bad.any():
            i = int(np.argmax(bad))
            return f"{bad.sum()} of {len(a)} rows differ in {c}: {a[c][i]!r} != {b[c][i]!r} at {a.iloc[i].to_dict()}"
    return None


def main(names: list[str], sf: str) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from seriesloom.plans import catalog
    from seriesloom.session import local_session

    spark = local_session(cores="8")
    sf_dir = f"/root/testdata/{sf}"
    con = connect(sf_dir)
    failed = 0
    checked_only = "--sql" in names
    names = [n for n in names if n != "--sql"]
    todo = [n for n in catalog.QUERIES if not names or any(n == x or (x.endswith("*") and n.startswith(x[:-1])) for x in names)]
    if checked_only:
        todo = [n for n in todo if n in catalog.SQL]
    for name in todo:
        t = time.time()
        try:
            df = catalog.QUERIES[name](spark, sf_dir)
            if name in catalog.SQL:
                msg = difference(df, con, catalog.SQL[name])
                print(f"{'ok  ' if msg is None else 'DIFF'} {name} {time.time() - t:.1f}s {msg or ''}", flush=True)
                failed += msg is not None
            else:
                n = df.count()
                print(f"rows {name} {n} {time.time() - t:.1f}s", flush=True)
                failed += n == 0
        except Exception as e:  # noqa: BLE001
            failed += 1
            print(f"FAIL {name} {type(e).__name__} {str(e)[:900]}", flush=True)
    print(f"{len(todo)} run, {failed} failed")
    return failed


if __name__ == "__main__":
    sf_arg = "sf0.001"
    args = sys.argv[1:]
    if args and args[0].startswith("sf"):
        sf_arg, args = args[0], args[1:]
    raise SystemExit(1 if main(args, sf_arg) else 0)

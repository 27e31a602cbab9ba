"""Compare registered queries with their SQL in DuckDB: ``python tests/check.py SF_DIR [name part ...]``."""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(path):
    con = duckdb.connect()
    for t in TABLES:
        file = f"{path}/{t}.parquet"
        if os.path.exists(file):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{file}'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind in "fiub":
            df[c] = df[c].astype(float).round(6) + 0.0
        elif df[c].dtype == object and len(df) and all(v is None or isinstance(v, (int, float)) or v is pd.NA for v in df[c]):
            df[c] = pd.to_numeric(df[c]).astype(float)
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def difference(spark_df, con, sql):
    """Empty text if both results agree."""
    got, want = spark_df.toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} against {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    a, b = canonical(got), canonical(want)
    bad_types = [c for c in a.columns if (got[c].dtype.kind in "iu") != (want[c].dtype.kind in "iu") and not got[c].isna().any() and len(got)]
    try:
        pd.testing.assert_frame_equal(a, b, check_dtype=False, rtol=0, atol=1e-9)
    except AssertionError as e:
        return str(e)[:600]
    return f"types differ: {[(c, str(got[c].dtype), str(want[c].dtype)) for c in bad_types]}" if bad_types else ""


if __name__ == "__main__":
    from basketry import build_session
    from basketry.plans import ORACLES, QUERIES

    path, parts = sys.argv[1], sys.argv[2:]
    spark, con = build_session("check", "8"), connect(path)
    failed = []
    for name, build in QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                note = difference(build(spark, path), con, ORACLES[name])
            else:
                note = "" if (n := build(spark, path).count()) > 0 else "no rows"
                print(f"      {n} rows", end=" ")
        except Exception as e:
            note = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{'ok  ' if not note else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
        if note:
            failed.append(name)
    print(len(failed), "failed", failed)

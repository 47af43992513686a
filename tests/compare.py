"""Run queries next to their SQL twins and compare all rows."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows by value, times at one resolution."""
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime64"):
            df[c] = df[c].astype("datetime64[us]")
        elif pd.api.types.is_integer_dtype(df[c].dtype):
            df[c] = df[c].astype("float64" if df[c].isna().any() else "int64")
    return df.sort_values(list(df.columns), ignore_index=True)


# Spark type names and what the SQL side must return for them.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def type_difference(dtypes: list[tuple[str, str]], con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    want = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    wrong = [(c, t, want.get(c)) for c, t in dtypes if TYPES.get(t) != want.get(c)]
    return f"types {wrong}" if wrong else None


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    try:
        pd.testing.assert_frame_equal(canonical(got), canonical(want), check_dtype=False, check_exact=True)
    except AssertionError as e:
        return str(e)[:500]
    return None


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, ".")
    from demandgrid import build_session
    from demandgrid.plans.oracle import ORACLE
    from demandgrid.plans.queries import QUERIES

    spark = build_session(master="local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="16g", spark__sql__execution__arrow__pyspark__enabled="true",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    bad = 0
    for name in names or QUERIES:
        t = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            got = df.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name}: FAILED {str(e)[:1500]}", flush=True)
            bad += 1
            continue
        t1 = time.time() - t
        if name not in ORACLE:
            print(f"{name}: rows only {len(got)} in {t1:.1f}s\n{got.head(6)}", flush=True)
            continue
        t = time.time()
        try:
            want = con.execute(ORACLE[name]).df()
            diff = difference(got, want) or type_difference(df.dtypes, con, ORACLE[name])
        except Exception as e:  # noqa: BLE001
            diff = f"SQL {str(e)[:600]}"
        bad += diff is not None
        print(f"{name}: {'ok' if diff is None else 'DIFF ' + diff} ({len(got)} rows, {t1:.1f}s, sql {time.time() - t:.1f}s)", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)

"""Compare registered queries with their SQL in DuckDB: schema, row count, values.

    python -m tests.oracle_compare [--sf DIR] [key ...]
"""

from __future__ import annotations

import argparse
import glob
import os
import time
import traceback

import duckdb

_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "float": "FLOAT", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(r[i] for i in order) for r in map(tuple, rows)) if not _has_null(rows) else sorted(
        (tuple(r[i] for i in order) for r in map(tuple, rows)), key=lambda t: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in t)
    )


def _has_null(rows) -> bool:
    return any(v is None for r in rows for v in r)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[str, int]:
    """('' or the first difference, row count)."""
    rel = con.execute(sql)
    duck_cols = [d[0] for d in rel.description]
    duck_rows = rel.fetchall()
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    spark_rows = df.collect()
    if sorted(df.columns) != sorted(duck_cols):
        return f"columns {sorted(df.columns)} vs {sorted(duck_cols)}", len(spark_rows)
    for f in df.schema.fields:
        want = _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
        if want != duck_types[f.name]:
            return f"type of {f.name}: {want} vs {duck_types[f.name]}", len(spark_rows)
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} vs {len(duck_rows)}", len(spark_rows)
    left, right = _rows(df.columns, spark_rows), _rows(duck_cols, duck_rows)
    for a, b in zip(left, right):
        if a != b:
            return f"{sorted(df.columns)}\n     spark {str(a)[:400]}\n     duck  {str(b)[:400]}", len(left)
    return "", len(left)


def main() -> None:
    import __spark_entry__ as entry
    from custodia.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("keys", nargs="*")
    args = parser.parse_args()
    spark, con = local_session(), connect(args.sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in args.keys or queries:
        begin = time.time()
        try:
            df = queries[key](spark, args.sf)
            if key in oracles:
                diff, n = compare(df, con, oracles[key])
                state = "ok" if not diff else "DIFF " + diff
                bad += bool(diff)
            else:
                n, state = df.count(), "rows only"
        except Exception as e:  # report and go on with the next key
            n, state = -1, "ERROR " + (traceback.format_exc()[-300:] if not hasattr(e, "getMessage") else "") + str(e)[:1500]
            bad += 1
        print(f"{key:32s} {n:8d} {time.time() - begin:6.2f}s {state}", flush=True)
    print(f"{bad} not ok")


if __name__ == "__main__":
    main()

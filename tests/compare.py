"""Run the registered queries beside their SQL and compare the full results.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import pathlib
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


# Spark type name -> DuckDB type name.
TYPES = {
    "string": "VARCHAR", "varchar(256)": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT",
    "smallint": "SMALLINT", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def difference(df, con, sql: str) -> str | None:
    """None when both give the same columns, types and bag of rows."""
    expected = con.sql(sql)
    spark_types = {name: TYPES[kind] for name, kind in df.dtypes}
    sql_types = dict(zip(expected.columns, map(str, expected.types)))
    if spark_types != sql_types:
        return f"types: {spark_types} != {sql_types}"
    names = sorted(df.columns)
    left = Counter(tuple(row[n] for n in names) for row in df.collect())
    order = ", ".join(f'"{n}"' for n in names)
    right = Counter(con.sql(f"SELECT {order} FROM ({sql})").fetchall())
    if left != right:
        return f"rows: {(left - right).most_common(2)} != {(right - left).most_common(2)}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from marquee.session import build_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            result = difference(query(spark, sf_dir), con, sqls[name]) if name in sqls else "no SQL"
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:40s} {time.time() - start:6.2f}s  {result or 'equal'}", flush=True)

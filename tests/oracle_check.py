"""Compare registered queries with their SQL: ``python tests/oracle_check.py SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def _rows(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object).where(lambda f: f.notna(), None)
    values = frame.map(lambda v: v if v is None else repr(float(v)) if isinstance(v, (int, float)) else str(v)[:10]
                       if hasattr(v, "isoformat") else str(v))
    return values.sort_values(list(values.columns), na_position="first").reset_index(drop=True)


def mismatch(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str | None:
    """What is different, or None."""
    result = queries()[name](spark, sf_dir)
    relation = con.sql(oracle_sql()[name])
    spark_types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in result.schema}
    sql_types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    if spark_types != sql_types:
        return f"schema: {spark_types} against {sql_types}"
    got, want = _rows(result.toPandas()), _rows(relation.df())
    if len(got) != len(want):
        return f"rows: {len(got)} against {len(want)}"
    different = (got.fillna("<null>") != want.fillna("<null>")).any(axis=1)
    if different.any():
        return f"{different.sum()} rows differ, first:\n{got[different].head(2)}\n{want[different].head(2)}"
    return None


def main() -> int:
    sf_dir, *names = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    failures = 0
    for name in names or queries():
        start = time.perf_counter()
        try:
            problem = mismatch(spark, con, sf_dir, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += problem is not None
        print(f"{name:26s} {time.perf_counter() - start:6.2f}s {problem or 'ok'}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(min(main(), 1))

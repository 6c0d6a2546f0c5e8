"""Run queries in Spark and DuckDB and compare: ``python -m checks.compare FOLDER [names...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

from checks.oracle import ORACLE
from checks.spark_queries import QUERIES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def _canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    df = df.astype(object).where(df.notna(), None)
    return df.sort_values(by=list(df.columns), key=lambda c: c.map(repr)).reset_index(drop=True)


def difference(ours: DataFrame, theirs: pd.DataFrame) -> str:
    """Empty when both hold the same columns and rows."""
    spark_types = {c: t for c, t in ours.dtypes}
    left, right = _canonical(ours.toPandas()), _canonical(theirs)
    if list(left.columns) != list(right.columns):
        return f"columns {list(left.columns)} / {list(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    if left.equals(right):
        return ""
    for c in left.columns:
        bad = left.index[~((left[c] == right[c]) | (left[c].isna() & right[c].isna()))]
        if len(bad):
            i = bad[0]
            return f"{c} ({spark_types[c]}): {len(bad)} differ, first {left[c][i]!r:.150} / {right[c][i]!r:.150}"
    return ""


def main(folder: str, names: list[str]) -> int:
    from marquee.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLE:
                spark_rows = df
                result = difference(spark_rows, db.execute(ORACLE[name]).df()) or "ok"
            else:
                result = f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            result = f"{type(error).__name__} {str(error)[:600]}"
        failed += not (result == "ok" or result.startswith("rows only"))
        print(f"{name:34s} {time.time() - start:6.2f}s {result}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))

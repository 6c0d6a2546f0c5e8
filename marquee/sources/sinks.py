"""Sinks: keyed append, replacement, CSV export, table creation, model storage."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.scalars import with_constants
from marquee.schemas import MOVIES, TABLES, Table
from marquee.session import cut_lineage
from marquee.sources.readers import read_table


REGISTER = "version string, params string"


class DuplicateKeyError(ValueError):
    """An append would have broken a primary key."""


def first_per_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key, the least by its other columns, so that a rerun picks the same one.

    An aggregate, so the copies of a key are reduced before the shuffle however many there are.
    """
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.dropDuplicates(list(key))
    kept = df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_row"))
    return kept.select(*key, "_row.*").select(*df.columns)


def new_rows(df: DataFrame, present: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``df``, one per key, whose key is not present yet. Null keys fail."""
    key = list(key)
    checked = df.withColumns({k: _not_null(k, df.schema[k].dataType) for k in key})
    return first_per_key(checked, key).join(present.select(*key), key, "left_anti").select(*df.columns)


def _not_null(name: str, dtype: T.DataType) -> Column:
    fail = F.raise_error(F.lit(f"null in key column {name}")).cast(dtype)
    return F.when(F.col(name).isNull(), fail).otherwise(F.col(name))


def conform(df: DataFrame, table: Table) -> DataFrame:
    """Columns in table order and type; absent ones are null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table.schema
        ]
    )


def append_keyed(df: DataFrame, table: Table, path: str, on_conflict: str = "fail") -> int:
    """Append under the table's primary key; returns the number of rows added.

    ``skip`` leaves out rows whose key is there already, so a rerun adds nothing; ``fail`` raises and
    writes nothing. Of a table kept by date only the dates of the new rows are read: a key belongs to
    one date. One writer per date.
    """
    if on_conflict not in ("fail", "skip"):
        raise ValueError("on_conflict must be 'fail' or 'skip'")
    incoming = cut_lineage(conform(df, table))
    fresh = incoming
    if table.key:
        present = read_table(df.sparkSession, table, path)
        if table.date:
            present = _same_dates(present, incoming, table.date)
        fresh = cut_lineage(new_rows(incoming, present, table.key))
    added = fresh.count()
    if on_conflict == "fail" and added < incoming.count():
        raise DuplicateKeyError(f"rows with a key already in {table.name}, or twice in the input")
    if added:
        _write(fresh, table, path, "append")
    return added


def _same_dates(present: DataFrame, incoming: DataFrame, date: str) -> DataFrame:
    """Only the partitions between the first and last date of the incoming rows."""
    first, last = incoming.agg(F.min(date), F.max(date)).first()
    return present.filter(F.col(date).between(F.lit(first), F.lit(last)))


def _write(df: DataFrame, table: Table, path: str, mode: str) -> None:
    if not table.date:
        df.write.mode(mode).parquet(path)
        return
    # gather each date in few files; adaptive execution splits a date that is large
    df.hint("rebalance", F.col(table.date)).write.mode(mode).partitionBy(table.date).parquet(path)


def append_metadata(
    df: DataFrame, path: str, search_date=None, title: str | None = None, on_conflict: str = "skip"
) -> int:
    """Append normalized metadata to the movies table, for a title and search date where they are given."""
    given = {"title": title, "search_date": search_date}
    return append_keyed(
        with_constants(df, **{k: v for k, v in given.items() if v is not None}), MOVIES, path, on_conflict
    )


def replace_table(df: DataFrame, table: Table, path: str) -> None:
    """Overwrite a table. The rows are written to the checkpoint folder first, as they may come from the
    table itself."""
    _write(cut_lineage(conform(df, table)), table, path, "overwrite")


def create_tables(spark: SparkSession, root: str, overwrite: bool = False) -> dict[str, str]:
    """Empty typed tables under ``root``; existing ones are an error unless ``overwrite``."""
    paths = {}
    for table in TABLES.values():
        paths[table.name] = f"{root}/{table.name}"
        empty = spark.createDataFrame([], table.schema)
        empty.write.mode("overwrite" if overwrite else "error").parquet(paths[table.name])
    return paths


# --- CSV ----------------------------------------------------------------------------------------


def plain_decimal(col: Column) -> Column:
    """A fractional number without an exponent: ``0.0001``, ``12345678.0``."""
    text = col.cast("string")
    sign = F.when(text.startswith("-"), "-").otherwise("")
    mantissa = F.regexp_extract(text, r"^-?([0-9]+)\.([0-9]+)E", 1)
    rest = F.regexp_replace(F.regexp_extract(text, r"^-?([0-9]+)\.([0-9]+)E", 2), "0+$", "")
    power = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int")
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), mantissa, rest)
    whole = F.concat(mantissa, F.rpad(F.substring(rest, F.lit(1), power), power, "0"))
    parts = F.substring(rest, power + 1, F.length(rest))
    large = F.concat(whole, F.lit("."), F.when(parts == "", "0").otherwise(parts))
    return F.when(power.isNull(), text).otherwise(F.concat(sign, F.when(power < 0, small).otherwise(large)))


def csv_lines(df: DataFrame) -> DataFrame:
    """One ``value`` per row: numbers bare and as plain decimals, all else quoted with quotes doubled, null as ``""``."""

    def field(f: T.StructField) -> Column:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            col = col.cast("int")
        if isinstance(f.dataType, T.TimestampType):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        text = plain_decimal(col) if isinstance(f.dataType, T.FractionalType) else col.cast("string")
        text = F.coalesce(text, F.lit(""))
        if isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            return F.when(col.isNull(), F.lit('""')).otherwise(text)
        return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))

    return df.select(F.concat_ws(",", *[field(f) for f in df.schema]).alias("value"))


def export_csv(df: DataFrame, path: str) -> None:
    """Write CSV part files that, joined in name order, are one file with a quoted header line."""
    header = ",".join('"' + c.replace('"', '""') + '"' for c in df.columns)
    first = df.sparkSession.createDataFrame([(header,)], "value string").coalesce(1)
    first.union(csv_lines(df)).write.mode("overwrite").text(path)


# --- Models -------------------------------------------------------------------------------------


def save_model(model: PipelineModel | None, path: str, version: str, params: dict | None = None) -> bool:
    """Store a fitted model under its own version, then note it in the register.

    A model that was not fitted (no new posts) is not stored, so the last one stays in use; a write that
    breaks off is never noted. Versions are compared as text, so dates fit.
    """
    if model is None:
        return False
    model.write().overwrite().save(f"{path}/models/{version}")
    spark = SparkSession.active()
    note = spark.createDataFrame([(version, json.dumps(params or {}))], REGISTER)
    note.coalesce(1).write.mode("append").parquet(f"{path}/register")
    return True


def load_model(spark: SparkSession, path: str, version: str | None = None) -> tuple[PipelineModel, dict]:
    """The model of a version (the latest by default) and its parameters; fails when there is none."""
    noted = spark.read.schema(REGISTER).parquet(f"{path}/register")
    if version is not None:
        noted = noted.filter(F.col("version") == version)
    latest = noted.orderBy(F.desc("version")).first()
    if latest is None:
        raise FileNotFoundError(f"no model in {path}")
    return PipelineModel.load(f"{path}/models/{latest['version']}"), json.loads(latest["params"])

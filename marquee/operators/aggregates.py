"""Aggregates: daily metrics per title, class counts, accuracy, water mark, term counts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.scalars import next_day
from marquee.schemas import CLASSES, PROBABILITIES
from marquee.session import reach_package, small_batches

COUNTED_TOKENS = 500_000  # tokens that a task counts at a time


def title_metrics(
    scored: DataFrame,
    by: Sequence[str] = ("title",),
    label: str = "pr_class",
    probabilities: Sequence[str] = PROBABILITIES,
) -> DataFrame:
    """Share of each predicted class and mean of each class probability, per title (and more keys).

    Plain averages, so each task sends one row per key to the shuffle however many posts a title has.
    """
    names = ("neg", "neu", "pos")
    shares = [
        F.avg(F.when(F.col(label) == c, 1.0).otherwise(0.0)).alias(f"pr_cls_{n}")
        for n, c in zip(names, CLASSES)
    ]
    means = [F.avg(p).alias(f"avg_pr_{n}") for n, p in zip(names, probabilities)]
    return scored.groupBy(*by).agg(*shares, *means)


def class_counts(df: DataFrame, by: Sequence[str] = (), label: str = "label") -> DataFrame:
    """Number of negative, neutral and positive rows."""
    counts = [
        F.count_if(F.col(label) == c).alias(n) for n, c in zip(("negative", "neutral", "positive"), CLASSES)
    ]
    return df.groupBy(*by).agg(*counts)


def accuracy(
    df: DataFrame, by: Sequence[str] = (), prediction: str = "prediction", label: str = "label"
) -> DataFrame:
    """Share of rows whose prediction equals the label."""
    hit = (F.col(prediction) == F.col(label)).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def high_water_mark(table: DataFrame, col: str, default) -> DataFrame:
    """One row, ``next_date``: the day after the latest date, or ``default`` when there are no rows."""
    last = next_day(F.max(col))
    return table.agg(F.coalesce(last, F.lit(default).cast("date")).alias("next_date"))


def distinct_titles(df: DataFrame, date, day: str = "tweet_date", title: str = "title") -> DataFrame:
    return df.filter(F.col(day) == F.lit(date).cast("date")).select(title).distinct()


def _counts(lists: pa.ListArray) -> pa.RecordBatch:
    flat = pc.dictionary_encode(lists.flatten(), null_encoding="encode")
    codes, terms = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(flat.dictionary)
    owner = np.repeat(np.arange(len(lists)), pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False))
    docs = np.unique(owner * terms + codes) % terms
    both = [pa.array(np.bincount(found, minlength=terms), pa.int64()) for found in (codes, docs)]
    return pa.RecordBatch.from_arrays([flat.dictionary, *both], ["term", "total", "docs"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of about ``COUNTED_TOKENS`` tokens at a time."""
    held, size = [], 0
    for batch in batches:
        held.append(batch.column(0))
        size += len(held[-1].flatten())
        if size >= COUNTED_TOKENS:
            yield _counts(pa.concat_arrays(held))
            held, size = [], 0
    if size:
        yield _counts(pa.concat_arrays(held))


def term_counts(docs: DataFrame, tokens: str = "tokens", by: Sequence[Column | str] = ()) -> DataFrame:
    """Per term: ``total`` occurrences and ``docs`` holding it.

    Texts are counted in arrays, many documents at a time, so what is aggregated and shuffled is a row for each term of
    those. With ``by``, or terms that are no strings, each document sends its tokens plus its distinct tokens, flagged, so both
    counts come from one map-side-combined aggregation; no row is keyed by document either way.
    """
    listed = docs.select((F.col(tokens) if isinstance(tokens, str) else tokens).alias("tokens"))
    if not by and listed.schema["tokens"].dataType.simpleString() == "array<string>":
        small_batches(reach_package(docs.sparkSession))
        counts = listed.mapInArrow(_counted, "term string, total bigint, docs bigint")
        return counts.groupBy("term").agg(F.sum("total").alias("total"), F.sum("docs").alias("docs"))

    def rows(array: Column | str, total: int, docs: int) -> Column:
        return F.transform(
            array,
            lambda t: F.struct(t.alias("term"), F.lit(total).alias("total"), F.lit(docs).alias("docs")),
        )

    uses, firsts = rows(tokens, 1, 0), rows(F.array_distinct(tokens), 0, 1)
    keys = [F.col(c) if isinstance(c, str) else c for c in by]
    return (
        docs.select(*keys, F.inline(F.concat(uses, firsts)))
        .groupBy(*by, "term")
        .agg(F.sum("total").alias("total"), F.sum("docs").alias("docs"))
    )

"""Row numbers, top-n per group and ordered limits that hold when one group is huge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import cut_lineage

# The first rows of each part of a group are picked before those of the group, in so many parts
PARTS = 64
MOST_IN_ONE_TASK = 1_000_000

_ID_BITS = 33  # monotonically_increasing_id() = partition << 33 | row within partition


def ranked(
    df: DataFrame,
    order: Sequence[Column | str],
    within: Sequence[str] = (),
    name: str = "position",
) -> DataFrame:
    """Exact 1-based row number by ``order``, overall or ``within`` groups, with no group in one task.

    A window would put each group (or everything) into one task. Here the rows are range-sorted, so a
    huge group spreads over many tasks; the sorted rows are written once; each task's first id per group
    and a running count over tasks then give the number. ``order`` must end in a unique column for the
    result to be fixed. Runs a job, as the sorted rows are checkpointed.
    """
    run, first, before = f"_{name}_run", f"_{name}_first", f"_{name}_before"
    ident = f"_{name}_id"
    rows = cut_lineage(
        df.orderBy(*within, *order).withColumn(ident, F.monotonically_increasing_id())
    ).withColumn(run, F.shiftright(ident, _ID_BITS))

    # one row per (task, group): at most tasks + groups of them
    runs = rows.groupBy(run, *within).agg(F.min(ident).alias(first), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*within).orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    groups = {c: f"_{name}_{c}" for c in [run, *within]}
    starts = runs.select(
        *[F.col(c).alias(g) for c, g in groups.items()],
        first,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(before),
    )
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(g)) for c, g in groups.items()])
    number = F.col(before) + F.col(ident) - F.col(first) + F.lit(1)
    return rows.join(starts, match).select(*df.columns, number.alias(name))


def top_n(
    df: DataFrame,
    within: Sequence[str],
    order: Sequence[Column | str],
    n: int,
    name: str | None = None,
) -> DataFrame:
    """First ``n`` rows of each group by ``order``; keeps the row number (int) when ``name`` is given.

    A group is cut into ``PARTS`` parts by a hash of its rows (but for map columns) and of the task they come from, so
    that equal rows part too and a task that runs again deals alike, and the first ``n`` of each part are picked before
    the first ``n`` of those, so a huge group is worked on by many tasks and one sees ``PARTS * n`` of its rows
    at most. When that is still many (``n`` of several thousand), rows are numbered by a distributed sort instead.
    """
    number, part = name or "_row_number", "_part"
    if n * PARTS <= MOST_IN_ONE_TASK:
        window = Window.orderBy(*order)
        hashable = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind]
        dealt = df.withColumn(part, F.pmod(F.xxhash64(F.spark_partition_id(), *hashable), F.lit(PARTS)))
        first = dealt.withColumn(number, F.row_number().over(window.partitionBy(*within, part))).filter(F.col(number) <= n)
        numbered = first.drop(part, number).withColumn(number, F.row_number().over(window.partitionBy(*within)))
    else:
        numbered = ranked(df, order, within, number).withColumn(number, F.col(number).cast("int"))
    kept = numbered.filter(F.col(number) <= n)
    return kept if name else kept.drop(number)


def top_n_per_day(
    chart: DataFrame, n: int = 10, day: str = "gross_date", gross: str = "daily_gross", title: str = "title"
) -> DataFrame:
    """The n best titles of each day by gross, numbered from 1 in ``rank``."""
    columns = [c for c in chart.columns if c != "rank"]
    return top_n(chart.select(*columns), [day], [F.desc(gross), F.asc(title)], n, "rank")


def recent_n_per_title(
    posts: DataFrame,
    n: int = 200,
    time: str = "tweet_datetime",
    within: Sequence[str] = ("title", "tweet_date"),
) -> DataFrame:
    """The newest n posts of each title and day; a tie in time goes to the larger id."""
    return top_n(posts, list(within), [F.desc(time), F.desc("tweet_id")], n)


def sample_per_title(
    posts: DataFrame, count: int | None = None, seed: int | None = None, title: str = "title"
) -> DataFrame:
    """``count`` posts of each title: the lowest ids, or a stable random pick when ``seed`` is given.

    ``count=None`` takes all posts and needs no shuffle.
    """
    if count is None:
        return posts
    order = [F.col("tweet_id").asc()]
    if seed is not None:
        order.insert(0, F.xxhash64("tweet_id", F.lit(seed)).asc())
    return top_n(posts, [title], order, count)


def queue_position(df: DataFrame, name: str = "pos") -> DataFrame:
    """0-based place in the annotation queue: titles in order, then ids."""
    return ranked(df, ["title", "tweet_id"], name=name).withColumn(name, F.col(name) - F.lit(1))


def latest(df: DataFrame, col: str) -> DataFrame:
    """The one row with the largest ``col``."""
    return df.orderBy(F.desc(col)).limit(1)


def limit_ordered(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """The first n rows by ``order``."""
    return df.orderBy(*order).limit(n)

"""The daily jobs: gather a day, compute its metrics, label and retrain, and all of it in turn."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date as Date
from datetime import timedelta
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.scalars import (
    clean_post,
    clean_title,
    is_mention,
    is_retweet,
    search_filter,
    year_of,
)
from marquee.operators.aggregates import class_counts, high_water_mark, title_metrics
from marquee.operators.joins import mention_join, metadata_lookup, unlabeled_posts
from marquee.operators.labeling import (
    THRESHOLD,
    annotation_queue,
    label_by_hand,
    labeled_rows,
    self_train,
    update_validation,
)
from marquee.operators.models import (
    GRID,
    compare_before_after,
    retrain,
    score,
    text_model,
    tokenizer_of,
    tune,
)
from marquee.operators.ranking import recent_n_per_title, sample_per_title
from marquee.schemas import BOXOFFICE, CLASSES, LABELED, METRICS, QUARANTINE, QUEUE, TABLES, TRAINING, TWEETS, VALIDATION
from marquee.session import cut_lineage
from marquee.sources.readers import (
    chart_rows,
    extract_chart,
    flatten_posts,
    normalize_metadata,
    quarantined,
    read_table,
)
from marquee.sources.sinks import (
    append_keyed,
    append_metadata,
    create_tables,
    load_model,
    replace_table,
    save_model,
)

# First day of collection, titles per day, posts per title, posts labelled per title.
FIRST_DATE = "2017-01-01"
TITLES_PER_DAY = 10
POSTS_PER_TITLE = 200
LABELS_PER_TITLE = 20


@dataclass(frozen=True)
class Store:
    """The tables and models under one folder."""

    spark: SparkSession
    root: str

    @cached_property
    def paths(self) -> dict[str, str]:
        return {name: f"{self.root}/{name}" for name in TABLES}

    @property
    def model_path(self) -> str:
        return f"{self.root}/model"

    def create(self, overwrite: bool = False) -> Store:
        create_tables(self.spark, self.root, overwrite)
        return self

    def read(self, table, columns=None) -> DataFrame:
        return read_table(self.spark, table, self.paths[table.name], columns)

    def append(self, df: DataFrame, table, on_conflict: str = "fail") -> int:
        return append_keyed(df, table, self.paths[table.name], on_conflict)

    def replace(self, df: DataFrame, table) -> None:
        replace_table(df, table, self.paths[table.name])


class NoChartError(RuntimeError):
    """There is no usable chart for the day."""


class OutdatedQueueError(ValueError):
    """Answers for a session that is not published."""


# --- Gathering ----------------------------------------------------------------------------------


def next_date(store: Store, first_date: str = FIRST_DATE) -> Date:
    """The day to gather: one after the last chart."""
    return high_water_mark(store.read(BOXOFFICE, ["gross_date"]), "gross_date", first_date).first()[0]


def daily_posts(
    chart: DataFrame, posts: DataFrame, day: Date, per_title: int = POSTS_PER_TITLE, last: Date | None = None
) -> DataFrame:
    """The newest posts of the day that mention each charted title, cleaned and flat; of all days up to ``last`` if given.

    ``posts`` are nested. They are picked by a time range the scan can use, then filtered and flattened; the mention
    join, by day, sees only what a search would return. ``chart`` says which days of the range have titles.
    """
    start, end = F.lit(day).cast("timestamp"), F.lit((last or day) + timedelta(1))
    today = posts.filter((F.col("created_at") >= start) & (F.col("created_at") < end.cast("timestamp")))
    flat = flatten_posts(
        today.withColumn("tweet_date", F.to_date("created_at")), "tweet_date", "lang", F.col("text").alias("raw")
    )
    found = search_filter(flat, day, end, text="raw").drop("lang")
    titles = chart.select(F.col("gross_date").alias("tweet_date"), "title")
    mentions = mention_join(titles, found, text="raw")
    newest = recent_n_per_title(mentions, per_title)
    return newest.select(
        "*",
        is_retweet("raw").alias("tweet_retweet"),
        is_mention("raw").alias("tweet_mention"),
        clean_post("raw", "title").alias("tweet_text"),
    ).drop("raw")


def daily_metadata(chart: DataFrame, metadata: DataFrame) -> DataFrame:
    """Metadata of the charted titles for the chart's year, else the year before.

    ``metadata`` holds (title, year, json); its titles are matched in their cleaned form.
    """
    found = normalize_metadata(metadata.withColumn("title", clean_title("title")))
    wanted = chart.select(
        F.col("title").alias("charted"),
        clean_title("title").alias("title"),
        F.col("gross_date").alias("search_date"),
        year_of("gross_date").alias("year"),
    )
    looked_up = metadata_lookup(wanted, found).filter(F.col("found_year").isNotNull())
    return looked_up.drop("title", "year", "found_year").withColumnRenamed("charted", "title")


def ingest_day(
    store: Store,
    pages: DataFrame,
    posts: DataFrame,
    metadata: DataFrame,
    first_date: str = FIRST_DATE,
    titles_per_day: int = TITLES_PER_DAY,
    posts_per_title: int = POSTS_PER_TITLE,
    skip_unreadable: bool = False,
) -> Date:
    """Gather the next day from staged pages (gross_date, html), posts and metadata; returns the day.

    Chart rows that can't be read are kept in the quarantine table and hold the day: it is not gathered until its page
    is mended, or ``skip_unreadable`` says to go on without them. Posts and metadata are appended before the
    chart. The chart is the water mark, so a run that breaks off is simply run again: rows that are there
    already are skipped.
    """
    day = next_date(store, first_date)
    page = pages.filter(F.col("gross_date") == F.lit(day))
    extracted = cut_lineage(extract_chart(page, titles_per_day))
    chart, unreadable = chart_rows(extracted), quarantined(extracted)
    known = store.read(QUARANTINE).filter(F.col("gross_date") == F.lit(day))
    fresh = cut_lineage(unreadable.select(*QUARANTINE.columns).exceptAll(known))
    lost = unreadable.count()
    if lost:
        if not fresh.isEmpty():
            store.append(fresh, QUARANTINE)
        if not skip_unreadable:
            raise NoChartError(f"{lost} chart rows of {day} can't be read; they are in the quarantine table")
    if chart.isEmpty():
        raise NoChartError(f"no usable chart for {day}")
    store.append(daily_posts(chart, posts, day, posts_per_title), TWEETS, "skip")
    append_metadata(daily_metadata(chart, metadata), store.paths["movies"])
    store.append(chart, BOXOFFICE)
    return day


def _unbroken(states: list, first: Date, skip_unreadable: bool) -> tuple[list[Date], Date | None]:
    """The days in turn from ``first`` that can be gathered, and the day whose page can't be."""
    by_day, days, day = {r["gross_date"]: r for r in states}, [], first
    while day in by_day:
        if not by_day[day]["usable"] or (by_day[day]["lost"] and not skip_unreadable):
            return days, day
        days.append(day)
        day += timedelta(1)
    return days, None


def ingest_days(
    store: Store,
    pages: DataFrame,
    posts: DataFrame,
    metadata: DataFrame,
    last: Date | None = None,
    first_date: str = FIRST_DATE,
    titles_per_day: int = TITLES_PER_DAY,
    posts_per_title: int = POSTS_PER_TITLE,
    skip_unreadable: bool = False,
) -> list[Date]:
    """Gather every day after the last chart, up to ``last`` or the end of the staged pages, in one plan; returns the days.

    Gives the rows that ``ingest_day`` gives day by day: the charts, posts and metadata of all days are made together,
    keyed by day, with one pass over the posts. Days are gathered in turn, so the first one without a usable chart, or
    held by unreadable rows, ends the range; the rows that hold it are kept in the quarantine table. With no day to
    gather it fails. One row a day, with two counts, reaches the driver. Posts and metadata are written before the charts,
    so a run that breaks off is simply run again.
    """
    first = next_date(store, first_date)
    staged = pages.filter(F.col("gross_date") >= F.lit(first))
    if last is not None:
        staged = staged.filter(F.col("gross_date") <= F.lit(last))
    extracted = cut_lineage(extract_chart(staged, titles_per_day))
    usable = F.col("problem").isNull()
    states = extracted.groupBy("gross_date").agg(F.count_if(usable).alias("usable"), F.count_if(~usable).alias("lost")).collect()
    days, held = _unbroken(states, first, skip_unreadable)
    seen = [*days, held] if held else days
    unreadable = quarantined(extracted).filter(F.col("gross_date").isin(seen))
    known = store.read(QUARANTINE).filter(F.col("gross_date") >= F.lit(first))
    fresh = cut_lineage(unreadable.select(*QUARANTINE.columns).exceptAll(known))
    if not fresh.isEmpty():
        store.append(fresh, QUARANTINE)
    if not days:
        raise NoChartError(f"no usable chart for {first}" + ("; what can't be read is in the quarantine table" if held else ""))
    chart = cut_lineage(chart_rows(extracted).filter(F.col("gross_date") <= F.lit(days[-1])))
    store.append(daily_posts(chart, posts, first, posts_per_title, days[-1]), TWEETS, "skip")
    append_metadata(daily_metadata(chart, metadata), store.paths["movies"])
    store.append(chart, BOXOFFICE)
    return days


# --- Metrics ------------------------------------------------------------------------------------


def pull_posts(store: Store, day, count: int | None = None) -> DataFrame:
    """Posts of a day, or of a list of days, that are not labelled; at most ``count`` of each title."""
    posts = store.read(TWEETS, ["title", "tweet_id", "tweet_text", "tweet_date"])
    days = [F.lit(d).cast("date") for d in (day if isinstance(day, list) else [day])]
    today = posts.filter(F.col("tweet_date").isin(days))
    free = unlabeled_posts(
        today, store.read(LABELED, ["tweet_id"]), store.read(VALIDATION, ["tweet_id"])
    )
    return sample_per_title(free, count).select("title", "tweet_id", "tweet_text", "tweet_date")


def metrics_rows(scored: DataFrame) -> DataFrame:
    """Metrics of every (title, day) of scored posts."""
    by_day = title_metrics(scored, ["title", "tweet_date"])
    return by_day.withColumnRenamed("tweet_date", "pred_date")


def daily_metrics(store: Store, model: PipelineModel, day) -> int:
    """Score the unlabelled posts of a day, or of a list of days at once, and append the metrics; returns the number of new rows."""
    return store.append(metrics_rows(score(model, pull_posts(store, day))), METRICS, "skip")


def missing_days(store: Store) -> list[Date]:
    """Charted days without metrics, oldest first: those whose run broke after gathering, and the newest."""
    charted = store.read(BOXOFFICE, ["gross_date"]).distinct()
    made = store.read(METRICS, ["pred_date"]).distinct()
    return [r[0] for r in charted.join(made, F.col("gross_date") == F.col("pred_date"), "left_anti").orderBy("gross_date").collect()]


# --- Labelling and training ---------------------------------------------------------------------


def init_validation(
    store: Store, day, annotations: DataFrame, count: int = LABELS_PER_TITLE, method: str = "init"
) -> None:
    """Start (``init``) or extend (``update``) the validation set from answers over a day's posts."""
    current = store.read(VALIDATION)
    rows = update_validation(current.limit(0), pull_posts(store, day, count), annotations, method)
    if method == "init":
        store.replace(rows, VALIDATION)
    else:
        store.append(rows, VALIDATION)


def init_model(store: Store, train: DataFrame, version: str, grid=GRID, folds: int = 5, **options):
    """Tune on the training rows, keep them for later refits, and store the model."""
    tuned = tune(train, grid=grid, folds=folds, **options)
    store.replace(train, TRAINING)
    save_model(tuned.model, store.model_path, version, tuned.params)
    return tuned


def publish_queue(store: Store, model: PipelineModel, day, count: int = LABELS_PER_TITLE, threshold: float = THRESHOLD) -> str:
    """Write the posts of a day that the model is unsure of, numbered, for annotators; returns the session.

    Answers (pos, attempt, answer) of the session go to ``update_model``. A session that is there is kept as it is.
    """
    session = str(day)
    scored = score(model, pull_posts(store, day, count))
    queue = annotation_queue(cut_lineage(scored), threshold).withColumn("session", F.lit(session))
    if store.read(QUEUE, ["session"]).filter(F.col("session") == session).isEmpty():
        store.append(queue, QUEUE)
    return session


def published(store: Store, session: str) -> DataFrame:
    """The queue of a session; fails when there is none."""
    queue = store.read(QUEUE).filter(F.col("session") == session).drop("session")
    if queue.isEmpty():
        raise OutdatedQueueError(f"no queue is published for session {session}")
    return queue


@dataclass(frozen=True)
class Update:
    """A refitted model, the validation accuracy before and after, and rows added by class for each method."""

    model: PipelineModel
    old_accuracy: float | None
    new_accuracy: float | None
    labeled: int
    counts: dict[str, dict[int, int]]


def update_model(
    store: Store,
    model: PipelineModel,
    params: dict,
    day,
    annotations: DataFrame | None = None,
    count: int = LABELS_PER_TITLE,
    threshold: float = THRESHOLD,
    session: str | None = None,
) -> Update | None:
    """Label some of the day's posts, refit, and compare on the validation set.

    ``annotations`` answer the queue published for ``session`` (the day's by default). The refitted model keeps the
    tokenizing stages of the one in use. None when the day has no unlabelled posts and there are no answers: the
    model in use stays.
    """
    scored = cut_lineage(score(model, pull_posts(store, day, count)))
    if scored.isEmpty() and annotations is None:
        return None
    parts = [self_train(scored, threshold)]
    if annotations is not None:
        parts.append(label_by_hand(published(store, session or str(day)), annotations))
    rows = cut_lineage(labeled_rows(*parts))
    counts = {r["method"]: dict(zip(CLASSES, r[1:], strict=True)) for r in class_counts(rows, ["method"]).collect()}
    labeled = store.append(rows, LABELED, "skip")
    refitted = retrain(text_model(tokenizer=tokenizer_of(model), **params), store.read(TRAINING), store.read(LABELED))
    validation = store.read(VALIDATION)
    scores = {
        r["model"]: r["accuracy"]
        for r in compare_before_after(score(model, validation), score(refitted, validation)).collect()
    }
    return Update(refitted, scores.get("old"), scores.get("new"), labeled, counts)


def daily_backend(
    store: Store,
    pages: DataFrame,
    posts: DataFrame,
    metadata: DataFrame,
    annotations: DataFrame | None = None,
    **options,
) -> Date:
    """One day: gather, metrics with the model in use, then label, refit and store.

    Metrics are made for every charted day that has none, so a day whose run broke off after gathering is made up.
    The queue of unsure posts is published before labelling; ``annotations`` answer the day's queue.
    """
    day = ingest_day(store, pages, posts, metadata, **options)
    _finish(store, day, annotations)
    return day


def _finish(store: Store, day: Date, annotations: DataFrame | None) -> None:
    """Metrics of all days that have none, in one plan; then the queue, labels and refit of ``day``."""
    model, params = load_model(store.spark, store.model_path)
    if missing := missing_days(store):
        daily_metrics(store, model, missing)
    publish_queue(store, model, day)
    update = update_model(store, model, params, day, annotations)
    save_model(update.model if update else None, store.model_path, str(day), params)


def backfill(
    store: Store,
    pages: DataFrame,
    posts: DataFrame,
    metadata: DataFrame,
    annotations: DataFrame | None = None,
    **options,
) -> list[Date]:
    """All days since the last chart: gathered in one plan (``ingest_days``), their metrics in another; returns the days.

    Metrics of all these days come from the model in use. The newest day is then labelled and the model refitted once; run
    ``daily_backend`` day by day where each day's model must be the one refitted on the day before.
    """
    days = ingest_days(store, pages, posts, metadata, **options)
    _finish(store, days[-1], annotations)
    return days

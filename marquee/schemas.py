"""Declared schemas, keys and date columns of the persistent tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def struct(spec: str) -> T.StructType:
    """``"a long, b string"`` as a StructType. Needs no session, so schemas can be module constants."""
    fields = (part.split() for part in spec.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


@dataclass(frozen=True)
class Table:
    """A table: its schema, its primary key and the date column it is partitioned by."""

    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    date: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.names


BOXOFFICE = Table(
    "boxoffice",
    struct(
        "gross_date date, rank int, title string, daily_gross long, todate_gross long, "
        "release_day int, theaters int"
    ),
    ("gross_date", "rank"),
    "gross_date",
)

MOVIES = Table(
    "movies",
    struct(
        "title string, search_date date, actors string, director string, genres string, plot string, "
        "mpaarating string, release string, runtime int, metascore int, imdbid string, imdbrating double, "
        "imdbvotes long, tomatoconsensus string, tomatometer int, tomatoreviews int"
    ),
    ("title", "search_date"),
    "search_date",
)

TWEETS = Table(
    "tweets",
    struct(
        "title string, author_id long, author_name string, author_friends long, author_followers long, "
        "author_favorites long, author_statuses long, author_verified boolean, tweet_id long, "
        "tweet_date date, tweet_datetime timestamp, tweet_favorites long, tweet_retweets long, "
        "tweet_retweet boolean, tweet_mention boolean, tweet_text string"
    ),
    ("title", "tweet_id"),
    "tweet_date",
)

VALIDATION = Table(
    "validation",
    struct("title string, tweet_id long, tweet_text string, label int"),
    ("title", "tweet_id"),
)

LABELED = Table(
    "labeled",
    struct(
        "title string, tweet_id long, tweet_text string, pr_neg double, pr_neu double, pr_pos double, "
        "label int, method string"
    ),
    ("title", "tweet_id"),
)

METRICS = Table(
    "metrics",
    struct(
        "title string, pred_date date, pr_cls_neg double, pr_cls_neu double, pr_cls_pos double, "
        "avg_pr_neg double, avg_pr_neu double, avg_pr_pos double"
    ),
    ("title", "pred_date"),
    "pred_date",
)

TRAINING = Table("training", struct("tweet_text string, label int"))

# What annotators see: the posts of one session, numbered. ``session`` names the day and model it was made with.
QUEUE = Table(
    "queue",
    struct(
        "session string, pos long, title string, tweet_id long, tweet_text string, "
        "pr_neg double, pr_neu double, pr_pos double, method string"
    ),
    ("session", "pos"),
)

# Chart rows that could not be read, by day; a day with such rows is not gathered.
QUARANTINE = Table(
    "quarantine",
    struct(
        "gross_date date, rank int, title string, daily_gross long, todate_gross long, "
        "release_day int, theaters int, problem string"
    ),
)

TABLES = {t.name: t for t in (BOXOFFICE, MOVIES, TWEETS, VALIDATION, LABELED, METRICS, TRAINING, QUEUE, QUARANTINE)}

AUTHOR = struct(
    "id long, name string, verified boolean, followers_count long, friends_count long, "
    "favourites_count long, statuses_count long"
)
POST = T.StructType(
    [
        T.StructField("author", AUTHOR),
        *struct(
            "id long, created_at timestamp, favorite_count long, retweet_count long, lang string, text string"
        ),
    ]
)

CLASSES = (-1, 0, 1)
PROBABILITIES = ("pr_neg", "pr_neu", "pr_pos")

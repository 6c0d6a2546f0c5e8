"""Joins: anti join on labelled ids, title mentions, metadata lookup, annotation answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.entities import let
from marquee.functions.scalars import clean_title
from marquee.functions.tokens import ngrams
from marquee.session import cut_lineage, fits_broadcast

MAX_TITLES_PER_DAY = 100  # looked for in every post; more are found by their words
SALT_ROWS = 1_000_000  # rows of one key that a task joins


def salted_join(
    large: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    part_rows: int = SALT_ROWS,
) -> DataFrame:
    """Shuffle join whose hot keys are split, each over as many tasks as its own rows need.

    The rows of ``large`` are counted by key (reduced before the shuffle); a key of more than ``part_rows`` rows
    gets a salt for each such part. There are at most rows / ``part_rows`` hot keys, so their table is
    small. Rows of ``large`` take one of their key's salts by their ``spread`` columns; rows of ``small`` are
    repeated for the salts of their own key only, so every pair still meets exactly once. The join is a merge: Spark would
    take the size of a side from before its rows are exploded, and might send a large one through the driver.
    """
    salt, salts = "_salt", "_salts"
    hot = large.groupBy(*keys).count().filter(F.col("count") > part_rows)
    hot = cut_lineage(hot.select(*keys, F.ceil(F.col("count") / part_rows).cast("int").alias(salts)))
    side = F.broadcast(hot) if fits_broadcast(hot) else hot
    parts = F.coalesce(salts, F.lit(1))
    left = large.join(side, list(keys), "left").withColumn(salt, F.pmod(F.xxhash64(*spread), parts).cast("int"))
    right = small.join(side, list(keys), "left").withColumn(salt, F.explode(F.sequence(F.lit(0), parts - 1)))
    return left.drop(salts).join(right.drop(salts).hint("merge"), [*keys, salt], how).drop(salt)


def distinct_ids(df: DataFrame, col: str = "tweet_id") -> DataFrame:
    return df.select(col).distinct()


def unlabeled_posts(posts: DataFrame, labeled: DataFrame, validation: DataFrame) -> DataFrame:
    """Posts whose id is in neither set. Only the id counts: a post labelled under one title is out
    under every title."""
    taken = labeled.select("tweet_id").unionByName(validation.select("tweet_id"))
    return posts.join(taken, "tweet_id", "left_anti")


def concat_titles(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Stack per-title results."""
    for df in more:
        first = first.unionByName(df)
    return first


def training_union(training: DataFrame, labeled: DataFrame) -> DataFrame:
    """Original and newly labelled rows, duplicates kept."""
    columns = ["tweet_text", "label"]
    return training.select(*columns).unionByName(labeled.select(*columns))


def words(col: Column | str) -> Column:
    """Lower-case words with one space around each, so that a phrase match is a substring match."""
    col = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(F.concat(F.lit(" "), F.lower(col), F.lit(" ")), r"[^\p{L}\p{N}_]+", " ")


def mention_join(
    titles: DataFrame,
    posts: DataFrame,
    *,
    post_key: str = "tweet_id",
    day: str = "tweet_date",
    text: str = "tweet_text",
    title: str = "title",
    max_per_day: int = MAX_TITLES_PER_DAY,
) -> DataFrame:
    """Each post with every title of its day that it holds as a phrase of whole words.

    ``titles`` has one row per (day, title); ``posts`` must have no title column. The cleaned title is
    searched. Posts that share an id, or have none, are each taken for themselves. A few titles a day, measured, are broadcast and looked for in each post, so posts are not
    shuffled and a hot title costs nothing extra. More are found by an equi-join: the runs of words of a
    post, of the lengths that titles have, against the titles. Only ids and hashes are shuffled, salted,
    and only real mentions (but for hash collisions, which a last check removes) come out, however many
    titles share a word. Both ways give the same rows.
    """
    phrases = cut_lineage(
        titles.select(F.col(day), F.col(title), F.coalesce(words(clean_title(title)), F.lit("")).alias("_phrase"))
        .filter(F.trim("_phrase") != "")
        .distinct()
    )
    most = phrases.groupBy(day).count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    if most <= max_per_day and fits_broadcast(phrases):
        return (
            posts.withColumn("_words", F.coalesce(words(text), F.lit("")))
            .join(F.broadcast(phrases), day)
            .filter(F.contains("_words", "_phrase"))
            .drop("_words", "_phrase")
        )
    pieces = F.split(F.trim("_phrase"), " ")
    lengths = sorted(r[0] for r in phrases.select(F.size(pieces)).distinct().collect())
    keyed = phrases.withColumn("_run", F.xxhash64(F.trim("_phrase")))
    runs = let(
        F.split(F.trim(F.coalesce(words(text), F.lit(""))), " "),
        lambda w: F.array_distinct(F.concat(*[ngrams(w, k, k) for k in lengths])),
    )
    post_runs = posts.select(post_key, day, F.explode(runs).alias("_words")).select(
        post_key, day, F.xxhash64("_words").alias("_run")
    )
    found = salted_join(post_runs, keyed, [day, "_run"], [post_key]).select(post_key, day, title, "_phrase").distinct()
    found = found.select(F.col(post_key).alias("_key"), F.col(day).alias("_day"), title, "_phrase")
    return (
        posts.join(found, F.col(post_key).eqNullSafe(F.col("_key")) & (F.col(day) == F.col("_day")))
        .filter(F.contains(F.coalesce(words(text), F.lit("")), F.col("_phrase")))
        .select(day, *[c for c in posts.columns if c != day], title)
    )


def metadata_lookup(
    titles: DataFrame, movies: DataFrame, *, title: str = "title", year: str = "year"
) -> DataFrame:
    """Metadata of each (title, year), else of the year before; ``found_year`` is null when neither is there.

    Each movie is offered to its own year and the next; the later one wins. One equi-join on
    (title, year), with the movie side already down to one row per key; a hot title is split by salt.
    """
    values = [c for c in movies.columns if c not in (title, year)]
    offered = (
        movies.withColumn("_for", F.explode(F.array(F.col(year), F.col(year) + F.lit(1))))
        .groupBy(F.col(title), F.col("_for").alias(year))
        .agg(F.max_by(F.struct(F.col(year).alias("found_year"), *values), F.col(year)).alias("_movie"))
    )
    return dictionary_join(titles, offered, [title, year], titles.columns).select(*titles.columns, "_movie.*")


def not_found(looked_up: DataFrame) -> DataFrame:
    """The titles a lookup has no metadata for."""
    return looked_up.filter(F.col("found_year").isNull())


def apply_annotations(queue: DataFrame, annotations: DataFrame, *, pos: str = "pos") -> DataFrame:
    """Label queue rows from answers (pos, attempt, answer).

    -1, 0 and 1 label; ``s`` skips; the first ``q`` ends the session; anything else is ignored and the
    next attempt counts. Answers are trimmed and lower-cased. Only labelled rows are returned.
    """
    typed = annotations.withColumn("answer", F.lower(F.trim("answer"))).filter(
        F.col("answer").isin("-1", "0", "1", "s", "q")
    )
    answers = typed.groupBy(pos).agg(F.min_by("answer", "attempt").alias("answer"))
    quit_at = answers.filter(F.col("answer") == "q").agg(F.min(pos)).scalar()
    labels = answers.filter(
        F.col("answer").isin("-1", "0", "1") & (F.col(pos) < F.coalesce(quit_at, F.col(pos) + F.lit(1)))
    ).select(pos, F.col("answer").cast("int").alias("label"))
    return queue.drop("label").join(labels, pos)


def dictionary_join(
    tokens: DataFrame, table: DataFrame, keys: Sequence[str], spread: Sequence[str]
) -> DataFrame:
    """Left join of token rows to a dictionary: broadcast when measured small, else salted."""
    if fits_broadcast(table):
        return tokens.join(F.broadcast(table), list(keys), "left")
    return salted_join(tokens, table, keys, spread, "left")


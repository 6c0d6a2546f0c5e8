"""Sources: labelled text files, chart pages, metadata JSON, nested posts, tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.entities import decode_entities
from marquee.functions.scalars import digits_to_int, na_to_null, rating_to_double, strip_space
from marquee.schemas import POST, TABLES, Table

# --- Delimited text -----------------------------------------------------------------------------


def _read_delimited(spark: SparkSession, path, **options) -> DataFrame:
    settings = {"sep": "\t", "header": True, "quote": '"', "escape": '"', **options}
    return spark.read.csv(path, **settings)


def read_labeled_text(spark: SparkSession, path, textcol: str, labelcol: str, **options) -> DataFrame:
    """``tweet_text, label`` from two named columns; a missing or odd label fails the read.

    A row is a line, so that one large file is read by many tasks; pass ``multiLine=True`` for files whose quoted
    fields span lines, which one task each must read.
    """
    raw = _read_delimited(spark, path, **options)
    label = F.col(labelcol).try_cast("int")
    message = F.concat(F.lit("no integer label: "), F.coalesce(labelcol, F.lit("null")))
    checked = F.when(label.isNull(), F.raise_error(message).cast("int")).otherwise(label)
    return raw.select(F.col(textcol).alias("tweet_text"), checked.alias("label"))


def read_positional_tsv(spark: SparkSession, path, encoding: str = "UTF-8", **options) -> DataFrame:
    """``text, label`` from the first two columns, both as text; the header is dropped."""
    raw = _read_delimited(spark, path, encoding=encoding, **options)
    return raw.select(*[F.col(f"`{c}`") for c in raw.columns[:2]]).toDF("text", "label")


def read_datasets(spark: SparkSession, files: Mapping[str, tuple[str, str]], **options) -> DataFrame:
    """Corpora ``{name: (path, encoding)}`` as one frame with a ``dataset`` column."""
    parts = [
        read_positional_tsv(spark, path, encoding, **options).select(F.lit(name).alias("dataset"), "text", "label")
        for name, (path, encoding) in files.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- Chart pages --------------------------------------------------------------------------------

# The chart table's attributes and the cells of a row (from 0).
CHART_TABLE = r'(?is)<table(?=[^>]*\bborder="?0)(?=[^>]*\bcellpadding="?5)(?=[^>]*\bcellspacing="?1)[^>]*>(.*)\z'
TABLE_TAGS = r"(?i)(?=</?table\b)"
CHART_CELLS = {"title": 2, "daily_gross": 4, "theaters": 7, "todate_gross": 9, "release_day": 10}
CHART_COUNT = 10


def element_pattern(tag: str) -> str:
    """The inside of each ``<tag>`` up to its end, or to the next one where the end is left out."""
    return rf"(?is)<{tag}\b[^>]*>(.*?)(?=</{tag}>|<{tag}\b|\z)"


def element_text(html: Column) -> Column:
    """Text of an HTML fragment: tags removed, entities decoded, stripped."""
    return strip_space(decode_entities(F.regexp_replace(html, r"(?s)<[^>]*>", "")))


def html_rows(
    pages: DataFrame,
    html: Column | str,
    row_tag: str = "tr",
    cell_tag: str = "td",
    skip: int = 1,
    limit: int | None = CHART_COUNT,
) -> DataFrame:
    """One row per table row of a page: page columns, 1-based ``rank``, ``cells`` as texts.

    The first ``skip`` rows are headers. A page is taken apart inside its own row, without a shuffle.
    """
    html = F.col(html) if isinstance(html, str) else html
    rows = F.regexp_extract_all(html, F.lit(element_pattern(row_tag)), F.lit(1))
    cells = F.regexp_extract_all(F.col("_row"), F.lit(element_pattern(cell_tag)), F.lit(1))
    rank = F.col("_at") - F.lit(skip - 1)
    numbered = pages.select(*pages.columns, F.posexplode(rows).alias("_at", "_row")).filter(rank >= 1)
    if limit is not None:
        numbered = numbered.filter(rank <= limit)
    return numbered.select(
        *pages.columns, rank.alias("rank"), F.transform(cells, element_text).alias("cells")
    )


def chart_table(html: Column | str) -> Column:
    """Inside of the chart table, up to its own end tag or the end of the page; null when a page has none.

    Tables inside its cells are left out, so they end neither the chart nor a row.
    """
    rest = F.regexp_extract(html, CHART_TABLE, 1)
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))

    def step(state: Column, piece: Column) -> Column:
        opens, ends = piece.rlike(r"(?i)^<table\b"), piece.rlike(r"(?i)^</table\b")
        depth = state["depth"] + F.when(opens, 1).when(ends, -1).otherwise(0)
        kept = F.when((depth == 0) & ends, F.regexp_replace(piece, r"^[^>]*>?", "")).when((depth == 0) & ~opens, piece)
        here = F.struct(depth.alias("depth"), F.concat(state["kept"], F.array(F.coalesce(kept, F.lit("")))).alias("kept"))
        return F.when(state["depth"] < 0, state).otherwise(here)

    inside = F.aggregate(F.split(rest, TABLE_TAGS), start, step)["kept"]
    return F.when(F.rlike(html, F.lit(CHART_TABLE)), F.array_join(inside, ""))


def extract_chart(
    pages: DataFrame, n: int = CHART_COUNT, html: str = "html", day: str = "gross_date"
) -> DataFrame:
    """Top-n chart rows of each day's page, with ``problem``: null, or why the row cannot be used.

    A page without a chart table, or whose chart has no row, gives one row without rank that says so.
    """
    table = pages.select(day, chart_table(html).alias("_table"))
    rows = html_rows(table.filter("_table IS NOT NULL"), "_table", limit=n).drop("_table")
    found = F.size(F.regexp_extract_all("_table", F.lit(element_pattern("tr")), F.lit(1)))
    lost = table.withColumn("problem", F.when(F.col("_table").isNull(), "no chart table").when(found < 2, "no chart rows"))
    lost = lost.filter(F.col("problem").isNotNull()).drop("_table")
    cell = {name: F.get("cells", F.lit(at)) for name, at in CHART_CELLS.items()}
    typed = rows.select(
        day,
        "rank",
        cell["title"].alias("title"),
        digits_to_int(cell["daily_gross"]).alias("daily_gross"),
        digits_to_int(cell["todate_gross"]).alias("todate_gross"),
        cell["release_day"].try_cast("int").alias("release_day"),
        digits_to_int(cell["theaters"]).try_cast("int").alias("theaters"),
        F.size("cells").alias("_cells"),
    )
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in CHART_CELLS]
    problem = F.when(F.col("_cells") <= max(CHART_CELLS.values()), F.lit("too few cells")).when(
        F.concat_ws(", ", *missing) != "", F.concat(F.lit("unreadable: "), F.concat_ws(", ", *missing))
    )
    return typed.withColumn("problem", problem).drop("_cells").unionByName(lost, allowMissingColumns=True)


def chart_rows(extracted: DataFrame) -> DataFrame:
    """Usable chart rows."""
    return extracted.filter(F.col("problem").isNull()).drop("problem")


def quarantined(extracted: DataFrame) -> DataFrame:
    """Rows that could not be read, with the reason."""
    return extracted.filter(F.col("problem").isNotNull())


# --- Metadata and posts -------------------------------------------------------------------------

# JSON key to movies column.
TEXT_KEYS = {
    "Actors": "actors",
    "Director": "director",
    "Genre": "genres",
    "Plot": "plot",
    "Rated": "mpaarating",
    "Released": "release",
    "imdbID": "imdbid",
    "tomatoConsensus": "tomatoconsensus",
}
INTEGER_KEYS = {
    "Runtime": "runtime",
    "Metascore": "metascore",
    "imdbVotes": "imdbvotes",
    "tomatoMeter": "tomatometer",
    "tomatoReviews": "tomatoreviews",
}
DECIMAL_KEYS = {"imdbRating": "imdbrating"}


def normalize_metadata(df: DataFrame, json_col: str = "json", compat: bool = False) -> DataFrame:
    """Metadata JSON to typed columns beside the other columns; replies with ``Error`` are dropped."""
    keys = [*TEXT_KEYS, *INTEGER_KEYS, *DECIMAL_KEYS, "Error"]
    schema = ", ".join(f"`{k}` string" for k in keys)
    rest = [c for c in df.columns if c != json_col]
    # filtered inside an array, so that the JSON is parsed once and not again for a filter
    kept = F.filter(F.array(F.from_json(json_col, schema)), lambda m: m["Error"].isNull())
    parsed = df.select(*rest, F.inline(kept).alias(*[f"_{k}" for k in keys]))
    types = {f.name: f.dataType for f in TABLES["movies"].schema}
    text = [na_to_null(f"_{k}").alias(c) for k, c in TEXT_KEYS.items()]
    whole = [digits_to_int(na_to_null(f"_{k}")).try_cast(types[c]).alias(c) for k, c in INTEGER_KEYS.items()]
    decimal = [rating_to_double(na_to_null(f"_{k}"), compat).alias(c) for k, c in DECIMAL_KEYS.items()]
    return parsed.select(*rest, *text, *whole, *decimal)


def read_posts(spark: SparkSession, path) -> DataFrame:
    """Nested posts from JSON lines, with the declared schema."""
    return spark.read.schema(POST).json(path)


def flatten_posts(df: DataFrame, *extra: str) -> DataFrame:
    """Nested post and author to flat columns; ``extra`` columns are carried along."""
    return df.select(
        *extra,
        F.col("author.id").alias("author_id"),
        F.col("author.name").alias("author_name"),
        F.col("author.verified").alias("author_verified"),
        F.col("author.followers_count").alias("author_followers"),
        F.col("author.friends_count").alias("author_friends"),
        F.col("author.favourites_count").alias("author_favorites"),
        F.col("author.statuses_count").alias("author_statuses"),
        F.col("id").alias("tweet_id"),
        F.col("created_at").alias("tweet_datetime"),
        F.col("favorite_count").alias("tweet_favorites"),
        F.col("retweet_count").alias("tweet_retweets"),
    )


# --- Tables -------------------------------------------------------------------------------------


def read_table(spark: SparkSession, table: Table, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A table with its declared schema, or some of its columns."""
    df = spark.read.schema(table.schema).parquet(path)
    return df.select(*(columns or table.columns))

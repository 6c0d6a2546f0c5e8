"""Scalar columns: title and post cleaning, number parsing, post predicates, dates, class picks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Character classes with the meaning that \w and \s have on Unicode text.
WORD = r"[\p{L}\p{N}_]"
SPACE_CHARS = r"\s\x0B\x1C-\x1F\x85\p{Z}"

RETWEET = rf"^RT @{WORD}+:"
HANDLE = rf"@{WORD}+"
HANDLE_WITH_RETWEET = rf"(?:RT )?@{WORD}+:?"
LINK = r"https?://"
LINK_HOST = rf"https?://(?:{WORD}|[.\-])+"
LINK_WHOLE = rf"https?://[^{SPACE_CHARS}]+"


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_space(col: Column | str) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(_col(col), rf"^[{SPACE_CHARS}]+|[{SPACE_CHARS}]+\z", "")


def clean_title(col: Column | str) -> Column:
    """Search form of a title: lower case, no ``@ # "``, no ``(2017 ...)``, nothing after a colon."""
    plain = F.regexp_replace(F.lower(strip_space(col)), r'[@#"]+', "")
    no_year = F.regexp_replace(plain, r"(?d)\(\p{Nd}{4}.*\)", "")
    return strip_space(F.regexp_replace(no_year, r"(?d):.+", ""))


def digits_to_int(col: Column | str) -> Column:
    """The digits of a text as a long; null when there is none (or too many)."""
    return F.regexp_replace(_col(col), r"[^0-9]", "").try_cast("bigint")


def na_to_null(col: Column | str) -> Column:
    return F.nullif(_col(col), F.lit("N/A"))


def rating_to_double(col: Column | str, compat: bool = False) -> Column:
    """A rating such as ``"7.5"``; ``compat=True`` drops the decimal point first and gives 75.0."""
    drop = r"[^0-9]" if compat else r"[^0-9.]"
    return F.regexp_replace(_col(col), drop, "").try_cast("double")


def is_retweet(col: Column | str) -> Column:
    return _col(col).rlike(RETWEET)


def is_mention(col: Column | str) -> Column:
    """Names somebody, and is not a retweet."""
    return _col(col).rlike(HANDLE) & ~is_retweet(col)


def has_link(col: Column | str) -> Column:
    return _col(col).rlike(LINK)


def remove_title(text: Column | str, title: Column | str) -> Column:
    """Delete the cleaned title from a post: any case, optional ``#`` in front, optional spaces inside."""
    quoted = F.regexp_replace(clean_title(title), r"([^\p{L}\p{N} ])", r"\\$1")
    pattern = F.concat(F.lit("(?iu)#?"), F.replace(quoted, F.lit(" "), F.lit(" ?")))
    return F.regexp_replace(_col(text), pattern, F.lit(""))


def clean_post(col: Column | str, title: Column | str | None = None) -> Column:
    """Delete newlines, quotes and handles (and the title, if given); squeeze spaces; strip."""
    text = F.translate(_col(col), "\n'\"", "")
    text = F.regexp_replace(text, HANDLE_WITH_RETWEET, "")
    if title is not None:
        text = remove_title(text, title)
    return strip_space(F.regexp_replace(text, r" {2,}", " "))


def strip_links(col: Column | str, whole: bool = False) -> Column:
    """Remove scheme and host of links; ``whole=True`` removes path and query too."""
    return F.regexp_replace(_col(col), LINK_WHOLE if whole else LINK_HOST, "")


def format_post_time(col: Column | str) -> Column:
    """A post's time as text, with real minutes."""
    return F.date_format(_col(col), "yyyy-MM-dd HH:mm:ss")


def next_day(col: Column | str) -> Column:
    return F.date_add(_col(col).cast("date"), 1)


def year_of(col: Column | str) -> Column:
    return F.year(_col(col).cast("date"))


def previous_year(col: Column | str) -> Column:
    return year_of(col) - F.lit(1)


def max_prob(*cols: Column | str) -> Column:
    return F.greatest(*[_col(c) for c in cols])


def argmax_label(neg: Column | str, neu: Column | str, pos: Column | str) -> Column:
    """Class -1, 0 or 1 of the largest probability; a tie goes to the lowest class."""
    neg, neu, pos = _col(neg), _col(neu), _col(pos)
    return (
        F.when((neg >= neu) & (neg >= pos), F.lit(-1)).when(neu >= pos, F.lit(0)).otherwise(F.lit(1))
    )


def with_constants(df: DataFrame, **values) -> DataFrame:
    """Add the same value to every row, one column per keyword."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def drop_unlabeled(df: DataFrame, label: str = "label") -> DataFrame:
    return df.filter(F.col(label).isNotNull())


def search_filter(
    df: DataFrame,
    since,
    until=None,
    *,
    text: str = "tweet_text",
    day: str = "tweet_date",
    lang: str | None = "en",
    links: bool = False,
    retweets: bool = False,
) -> DataFrame:
    """Posts a daily search returns: ``since <= day < until`` (one day by default), one language,
    without links and without retweets unless asked."""
    start = F.lit(since).cast("date")
    end = F.lit(until).cast("date") if until is not None else F.date_add(start, 1)
    tests = [F.col(day) >= start, F.col(day) < end]
    if lang:
        tests.append(F.col("lang") == lang)
    if not links:
        tests.append(~has_link(text))
    if not retweets:
        tests.append(~is_retweet(text))
    return df.filter(reduce(lambda a, b: a & b, tests))

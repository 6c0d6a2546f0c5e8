"""Views over the given tables, as SQL text for both engines. ``{name}`` stands for a table or view."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from marquee.operators.labeling import unsure
from marquee.operators.ranking import queue_position
from marquee.session import cut_lineage, spread_scan

LONG_TEXTS = ("documents", "pages")  # work per row is high, so few large splits would idle cores

VIEWS = {
    "tweets_fx": """
SELECT source AS title, doc_id AS tweet_id, lang,
 DATE '2017-01-01' + CAST(doc_id % 7 AS INT) AS tweet_date,
 CASE CAST(doc_id % 9 AS INT)
  WHEN 0 THEN concat('RT @user', CAST(doc_id AS STRING), ': ', text)
  WHEN 1 THEN concat('@user', CAST(doc_id AS STRING), ' ', text, ' #', source)
  WHEN 2 THEN concat(text, ' it was not good at all. :-) yes')
  WHEN 3 THEN concat(text, ' see https://t.example.com/a/b?x=1 &amp;amp; more')
  WHEN 4 THEN concat('i saw #', source, ' at 12:30 for $7.50, 1,234 people!!! ', text)
  WHEN 5 THEN concat('loved ', upper(source), '... ', text)
  WHEN 6 THEN concat('"', text, '" said Dr. O''Neil   <3')
  ELSE text END AS tweet_text
FROM {documents}""",
    "sentiment_fx": """
SELECT l.doc_id AS tweet_id, d.source AS title,
 CASE WHEN toxic = 1 THEN -1 WHEN quality = 1 THEN 1 ELSE 0 END AS label,
 CASE WHEN l.doc_id % 3 = 0 THEN 'validation' ELSE 'labeled' END AS part
FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id""",
    "scores_fx": """
SELECT title, tweet_id, tweet_date, CAST(a*a AS DOUBLE)/(a*a+b*b+c*c) AS pr_neg,
 CAST(b*b AS DOUBLE)/(a*a+b*b+c*c) AS pr_neu, CAST(c*c AS DOUBLE)/(a*a+b*b+c*c) AS pr_pos
FROM (SELECT title, tweet_id, tweet_date, (tweet_id*7+3)%11+1 AS a, (tweet_id*5+1)%13+1 AS b,
      (tweet_id*3+2)%17+1 AS c FROM {tweets_fx}) q""",
    "boxoffice_fx": """
SELECT gross_date, title, daily_gross, theaters,
 CAST(ROW_NUMBER() OVER (PARTITION BY gross_date ORDER BY daily_gross DESC, title) AS INT) AS rank
FROM (SELECT CAST(l_shipdate AS DATE) AS gross_date, p_brand AS title,
  CAST(ROUND(SUM(l_extendedprice*(1-l_discount))) AS BIGINT) AS daily_gross,
  CAST(COUNT(DISTINCT l_suppkey) AS INT) AS theaters
  FROM {lineitem} JOIN {part} ON l_partkey = p_partkey GROUP BY 1, 2) q""",
    "movie_json_fx": """
SELECT p_partkey, p_brand AS title, CAST(2016 + p_partkey % 2 AS INT) AS year,
 concat('{{"Title":"', p_brand, '","Runtime":"',
  CASE WHEN p_partkey % 10 = 0 THEN 'N/A' ELSE concat(CAST(p_size + 80 AS STRING), ' min') END,
  '","imdbVotes":"', CAST(p_partkey % 900 + 1 AS STRING), ',', lpad(CAST(p_partkey % 1000 AS STRING), 3, '0'),
  '","imdbRating":"', CAST(p_partkey % 10 AS STRING), '.', CAST(p_size % 10 AS STRING), '"}}') AS json
FROM {part}""",
    "movies_fx": """
SELECT title, year, MIN(p_partkey) AS p_partkey FROM {movie_json_fx}
WHERE title <> 'Brand#2' AND NOT (year = 2017 AND length(title) = 7) GROUP BY title, year""",
    # raw titles with all that cleaning removes
    "titles_fx": """
SELECT p_partkey,
 CASE CAST(p_partkey % 5 AS INT)
  WHEN 0 THEN concat('  ', p_name, ' (', CAST(1990 + p_size AS STRING), ' remake) ')
  WHEN 1 THEN concat('"', p_name, '": Part ', CAST(p_size AS STRING))
  WHEN 2 THEN concat('#', p_name, ' @ ', p_brand)
  WHEN 3 THEN concat(p_name, ' (new) :')
  ELSE concat(upper(p_name), ' (2017): ', p_type) END AS raw_title
FROM {part}""",
    # posts nobody has labelled, with stand-in scores
    "open_fx": """
SELECT s.* FROM {scores_fx} s WHERE NOT EXISTS
 (SELECT 1 FROM {sentiment_fx} l WHERE l.tweet_id = s.tweet_id)""",
    # the queue of unsure posts, and answers for its places: valid, invalid then valid, skip, one quit
    "queue_fx": """
SELECT title, tweet_id, tweet_date, pr_neg, pr_neu, pr_pos,
 CAST(ROW_NUMBER() OVER (ORDER BY title, tweet_id) - 1 AS BIGINT) AS pos
FROM {open_fx} WHERE greatest(pr_neg, pr_neu, pr_pos) < 0.9""",
    "answers_fx": """
SELECT pos, 0 AS attempt,
 CASE WHEN pos = quit_at THEN ' Q' WHEN pos % 7 = 1 THEN 'x' WHEN pos % 7 = 2 THEN 'S '
  WHEN pos % 7 = 3 THEN '0' WHEN pos % 7 = 4 THEN ' -1' ELSE '1' END AS answer
FROM {queue_fx} CROSS JOIN (SELECT CAST(floor(max(pos) * 0.8) AS BIGINT) AS quit_at FROM {queue_fx}) m
UNION ALL SELECT pos, 1 AS attempt, '1 ' AS answer FROM {queue_fx} WHERE pos % 7 = 1""",
    # predictions of two models for the labelled posts
    "predictions_fx": """
SELECT l.tweet_id, l.title, l.part, l.label,
 CASE WHEN pr_neg >= pr_neu AND pr_neg >= pr_pos THEN -1 WHEN pr_neu >= pr_pos THEN 0 ELSE 1 END AS old_class,
 CASE WHEN pr_pos >= pr_neu THEN 1 WHEN pr_neu >= pr_neg THEN 0 ELSE -1 END AS new_class
FROM {sentiment_fx} l JOIN {scores_fx} s ON l.tweet_id = s.tweet_id""",
}


def _needs(name: str) -> list[str]:
    return list(dict.fromkeys(f for _, f, _, _ in Formatter().parse(VIEWS[name]) if f))


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table or a view over the tables in ``folder``."""
    if name == "queue_fx":  # its window in SQL would put every post into one task
        queue = queue_position(unsure(view(spark, folder, "open_fx")))
        return cut_lineage(queue.select("title", "tweet_id", "tweet_date", "pr_neg", "pr_neu", "pr_pos", "pos"))
    if name not in VIEWS:
        table = spark.read.parquet(f"{folder}/{name}.parquet")
        return spread_scan(table) if name in LONG_TEXTS else table
    return spark.sql(VIEWS[name], **{n: view(spark, folder, n) for n in _needs(name)})


def _order(names: list[str]) -> list[str]:
    found: list[str] = []
    for name in names:
        if name in VIEWS and name not in found:
            found += [n for n in [*_order(_needs(name)), name] if n not in found]
    return found


def with_views(sql: str, *extra: str) -> str:
    """SQL with the views it names (as ``{name}``) in front; ``extra`` are more ``name AS (...)`` parts."""
    named = [f for _, f, _, _ in Formatter().parse(" ".join([*extra, sql])) if f]
    parts = [f"{n} AS ({_plain(VIEWS[n])})" for n in _order(named)] + [_plain(e) for e in extra]
    head = f"WITH {', '.join(parts)}\n" if parts else ""
    return head + _plain(sql)


def _plain(sql: str) -> str:
    names = {f: f for _, f, _, _ in Formatter().parse(sql) if f}
    return sql.format(**names)

"""Spark side of the checks: ``name -> query(spark, folder)``."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.views import view
from marquee.functions import scalars as S
from marquee.functions import tokens as T
from marquee.operators import aggregates as A
from marquee.operators import features as V
from marquee.operators import joins as J
from marquee.operators import labeling as L
from marquee.operators import models as M
from marquee.operators import ranking as R
from marquee.operators import tagging as G
from marquee.operators import text as X
from marquee.operators.solvers import balanced_penalties
from marquee.plans import jobs
from marquee.schemas import BOXOFFICE, CLASSES, LABELED, METRICS, MOVIES, QUEUE, TWEETS, VALIDATION, Table, struct
from marquee.session import cut_lineage, ensure_checkpoint_dir, small_batches
from marquee.sources import readers, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

DAY = "2017-01-03"
VOCABULARY = 20_000
FIXTURE_TOKEN = r"[\p{L}\p{N}_']+|[^\p{L}\p{N}_' \t\n\r\f]+"


def query(*views: str):
    """Register a function of the named tables or views."""

    def add(fn):
        QUERIES[fn.__name__] = lambda spark, folder: fn(*[view(spark, folder, v) for v in views])
        return fn

    return add


def text_of(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def long_of(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("bigint")


def six(col: Column | str) -> Column:
    return F.round(col, 6)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, integers to long, dates to text."""
    kinds = {"double": six, "int": long_of, "date": text_of}
    return df.select(*[kinds.get(t, F.col)(c).alias(c) for c, t in df.dtypes])


def tokens_of(tweets: DataFrame) -> DataFrame:
    return tweets.withColumn(
        "tokens", F.regexp_extract_all(F.lower("tweet_text"), F.lit(FIXTURE_TOKEN), F.lit(0))
    )


def joined(df: DataFrame, tokens: Column, sep: str = " ") -> DataFrame:
    return df.select("tweet_id", F.array_join(tokens, sep).alias("tokens"))


# --- Scalars ------------------------------------------------------------------------------------


@query("titles_fx")
def p1_clean_title(titles):
    return titles.select("p_partkey", S.clean_title("raw_title").alias("title"))


def _json(key: str) -> Column:
    return F.get_json_object("json", f"$.{key}")


@query("movie_json_fx")
def p2_digits_to_int(movies):
    return movies.select("p_partkey", S.digits_to_int(_json("imdbVotes")).alias("votes"), S.digits_to_int(_json("Runtime")).alias("runtime"))


@query("movie_json_fx")
def p3_na_to_null(movies):
    return movies.select("p_partkey", S.na_to_null(_json("Runtime")).alias("runtime"))


@query("movie_json_fx")
def p4_rating_to_double(movies):
    rating = _json("imdbRating")
    return movies.select(
        "p_partkey",
        S.rating_to_double(rating).alias("rating"),
        S.rating_to_double(rating, compat=True).alias("rating_without_point"),
    )


@query("tweets_fx")
def p5_is_retweet(tweets):
    return tweets.select("tweet_id", S.is_retweet("tweet_text").alias("retweet"))


@query("tweets_fx")
def p6_is_mention(tweets):
    return tweets.select("tweet_id", S.is_mention("tweet_text").alias("mention"))


@query("tweets_fx")
def p7_clean_post(tweets):
    return tweets.select("tweet_id", S.clean_post("tweet_text").alias("tweet_text"))


@query("tweets_fx")
def p8_remove_title(tweets):
    return tweets.select("tweet_id", S.remove_title("tweet_text", "title").alias("tweet_text"))


@query("events")
def p9_format_post_time(events):
    return events.select("event_id", S.format_post_time("ts").alias("posted"))


@query("tweets_fx")
def p10_search_filter(tweets):
    found = S.search_filter(tweets, DAY, "2017-01-06")
    return found.select("title", "tweet_id", text_of("tweet_date").alias("tweet_date"))


@query("tweets_fx")
def p11_strip_links(tweets):
    return tweets.select(
        "tweet_id", S.strip_links("tweet_text").alias("host_removed"), S.strip_links("tweet_text", whole=True).alias("link_removed")
    )


@query("boxoffice_fx")
def p12_next_day(chart):
    return chart.select("title", text_of("gross_date").alias("gross_date"), text_of(S.next_day("gross_date")).alias("next_date"))


@query("boxoffice_fx")
def p13_with_constants(chart):
    out = S.with_constants(chart, method="chart", pred_date="2017-01-01", weight=1.5)
    return out.select("title", text_of("gross_date").alias("gross_date"), "method", "pred_date", "weight")


@query("boxoffice_fx")
def p14_year_of(chart):
    return chart.select(
        "title",
        text_of("gross_date").alias("gross_date"),
        long_of(S.year_of("gross_date")).alias("year"),
        long_of(S.previous_year("gross_date")).alias("previous_year"),
    )


@query("tweets_fx", "sentiment_fx")
def p15_drop_unlabeled(tweets, sentiment):
    both = tweets.join(sentiment.select("tweet_id", "label"), "tweet_id", "left")
    return S.drop_unlabeled(both).select("tweet_id", long_of("label").alias("label"))


@query("scores_fx")
def p16_max_prob(scores):
    best = S.max_prob("pr_neg", "pr_neu", "pr_pos")
    return scores.select("tweet_id", six(best).alias("best"), (best >= 0.9).alias("sure"))


@query("scores_fx")
def p17_argmax_label(scores):
    return scores.select("tweet_id", long_of(S.argmax_label("pr_neg", "pr_neu", "pr_pos")).alias("label"))


# --- Joins --------------------------------------------------------------------------------------


def parts_of(sentiment: DataFrame) -> tuple[DataFrame, DataFrame]:
    return sentiment.filter("part = 'labeled'"), sentiment.filter("part = 'validation'")


@query("tweets_fx", "sentiment_fx")
def j1_unlabeled_posts(tweets, sentiment):
    free = J.unlabeled_posts(tweets, *parts_of(sentiment))
    return free.select("title", "tweet_id", text_of("tweet_date").alias("tweet_date"))


@query("tweets_fx")
def j2_mention_join(tweets):
    titles = tweets.select("tweet_date", "title").distinct()
    return J.mention_join(titles, tweets.drop("title")).select("title", "tweet_id")


@query("tweets_fx")
def j2_mention_join_many_titles(tweets):
    titles = tweets.select("tweet_date", "title").distinct()
    return J.mention_join(titles, tweets.drop("title"), max_per_day=0).select("title", "tweet_id")


@query("tweets_fx")
def j2_mention_join_repeated_ids(tweets):
    """Posts twice, a tenth of the copies without id, by both ways of the join."""
    titles = tweets.select("tweet_date", "title").distinct()
    posts = tweets.drop("title")
    ident = F.when(F.col("tweet_id") % 10 != 0, F.col("tweet_id"))
    twice = posts.unionByName(posts.withColumn("tweet_id", ident))
    ways = [J.mention_join(titles, twice, **options).withColumn("way", F.lit(way)) for way, options in (("few", {}), ("many", {"max_per_day": 0}))]
    return ways[0].unionByName(ways[1]).groupBy("way", "title", "tweet_id").agg(F.count(F.lit(1)).alias("n"))


@query("part", "movies_fx")
def j3_metadata_lookup(part, movies):
    titles = part.select(F.col("p_brand").alias("title")).distinct().withColumn("year", F.lit(2017))
    return J.metadata_lookup(titles, movies).select(
        "title", long_of("year").alias("year"), long_of("found_year").alias("found_year"), "p_partkey"
    )


@query("queue_fx", "answers_fx")
def j4_apply_annotations(queue, answers):
    return J.apply_annotations(queue, answers).select("pos", "title", "tweet_id", long_of("label").alias("label"))


def _lemma_table(tweets: DataFrame) -> DataFrame:
    words = tokens_of(tweets).select(F.explode(F.array_distinct("tokens")).alias("token")).distinct()
    plural = words.filter(F.col("token").rlike("^[a-z]{3,}s$"))
    table = plural.select(
        "token", F.lit("n").alias("wordclass"), F.expr("left(token, length(token) - 1)").alias("lemma")
    )
    return cut_lineage(table)  # a stored table in real use


def _tag_table(tweets: DataFrame) -> DataFrame:
    words = tokens_of(tweets).select(F.explode(F.array_distinct("tokens")).alias("token")).distinct()
    word = F.col("token")
    tag = F.when(word.endswith("ing"), "VBG").when(word.endswith("ly"), "RB").when(word.endswith("ble"), "JJ")
    return cut_lineage(words.select("token", tag.alias("tag")).filter("tag IS NOT NULL"))


@query("tweets_fx")
def j5_lemmatize(tweets):
    docs = tokens_of(tweets).select("tweet_id", "tokens")
    return joined(X.lemmatize(docs, ["tweet_id"], _lemma_table(tweets)), F.col("tokens"))


@query("tweets_fx")
def j5_lemmatize_endings(tweets):
    """Short plurals by table, other tokens by their endings, tagged by the table of tags."""
    docs = tokens_of(tweets).select("tweet_id", "tokens")
    distinct = tokens_of(tweets).select(F.explode(F.array_distinct("tokens")).alias("word")).distinct()
    word = F.col("word")
    classes = F.array_compact(F.array(F.when(~word.endswith("s"), F.lit("n")), F.when(~word.endswith("ing"), F.lit("v"))))
    words = distinct.select("word", F.explode(classes).alias("wordclass"))
    short = _lemma_table(tweets).filter(F.length("token") == 4)
    return joined(X.lemmatize(docs, ["tweet_id"], short, _tag_table(tweets), words=words), F.col("tokens"))


# --- Aggregates ---------------------------------------------------------------------------------


def _classed(scores: DataFrame) -> DataFrame:
    return scores.withColumn("pr_class", S.argmax_label("pr_neg", "pr_neu", "pr_pos"))


@query("scores_fx")
def a1_title_metrics(scores):
    return rounded(A.title_metrics(_classed(scores)))


@query("sentiment_fx")
def a2_class_counts(sentiment):
    return rounded(A.class_counts(sentiment, ["part"]))


@query("predictions_fx")
def a3_accuracy(predictions):
    return rounded(A.accuracy(predictions, ["title"], "old_class"))


@query("boxoffice_fx")
def a4_high_water_mark(chart):
    full = A.high_water_mark(chart, "gross_date", "2017-01-01").withColumn("rows", F.lit("all"))
    none = A.high_water_mark(chart.filter("gross_date IS NULL"), "gross_date", "2017-01-01").withColumn("rows", F.lit("none"))
    return full.unionByName(none).select("rows", text_of("next_date").alias("next_date"))


@query("tweets_fx")
def a5_distinct_titles(tweets):
    return A.distinct_titles(tweets, DAY)


@query("tweets_fx")
def a6_term_counts(tweets):
    return rounded(A.term_counts(tokens_of(tweets)))


# --- Ranking and set operations -----------------------------------------------------------------


@query("boxoffice_fx")
def w1_top_n_per_day(chart):
    top = R.top_n_per_day(chart, 10)
    return rounded(top.select("gross_date", "title", "daily_gross", "rank"))


@query("tweets_fx", "sentiment_fx")
def w2_sample_per_title(tweets, sentiment):
    free = J.unlabeled_posts(tweets, *parts_of(sentiment))
    return R.sample_per_title(free, 20).select("title", "tweet_id")


@query("tweets_fx")
def w3_recent_n_per_title(tweets):
    return R.recent_n_per_title(tweets, 3, time="tweet_date").select("title", "tweet_id", text_of("tweet_date").alias("tweet_date"))


@query("open_fx")
def w4_queue_position(posts):
    return R.queue_position(L.unsure(posts)).select("title", "tweet_id", "pos")


@query("boxoffice_fx")
def w5_latest(chart):
    return R.latest(chart.select("gross_date"), "gross_date").select(text_of("gross_date").alias("gross_date"))


@query("boxoffice_fx")
def w6_limit(chart):
    top = R.limit_ordered(chart, 25, [F.desc("daily_gross"), "title", "gross_date"])
    return rounded(top.select("title", "gross_date", "daily_gross"))


@query("tweets_fx")
def u1_concat_titles(tweets):
    langs = [tweets.filter(F.col("lang") == lang) for lang in ("en", "fr", "de", "es")]
    return J.concat_titles(*langs).select("title", "tweet_id", "lang")


@query("tweets_fx", "sentiment_fx")
def u2_training_union(tweets, sentiment):
    texts = sentiment.join(tweets.select("tweet_id", "tweet_text"), "tweet_id")
    labeled, validation = parts_of(texts)
    both = J.training_union(validation, labeled.unionByName(labeled))
    return both.groupBy(F.md5("tweet_text").alias("text_hash"), long_of("label").alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("sentiment_fx")
def u3_distinct_ids(sentiment):
    twice = sentiment.unionByName(sentiment)
    return J.distinct_ids(twice)


# --- Sources and sinks --------------------------------------------------------------------------


@query("pages")
def s4_extract_rows(pages):
    rows = readers.html_rows(pages.select("page_id", "html"), "html", "li", "a", skip=0, limit=None)
    return rows.select("page_id", long_of("rank").alias("rank"), F.get("cells", F.lit(0)).alias("cell"))


@query("pages")
def s4_extract_top_rows(pages):
    rows = readers.html_rows(pages.select("page_id", "html"), "html", "li", "a", skip=1, limit=3)
    return rows.select("page_id", long_of("rank").alias("rank"), F.get("cells", F.lit(0)).alias("cell"))


def _chart_pages(chart: DataFrame, release_day: Column) -> DataFrame:
    """Chart pages, one per day, written from chart rows."""
    cells = [F.lit(""), F.lit(""), F.col("title"), F.lit(""), F.concat(F.lit("$"), F.format_number("daily_gross", 0)), F.lit(""), F.lit("")]
    cells += [text_of("theaters"), F.lit(""), F.format_number("daily_gross", 0), release_day]
    row = F.concat(F.lit("<tr><td>"), F.concat_ws("</td><td>", *cells), F.lit("</td></tr>\n"))
    return (
        chart.withColumn("row", row)
        .groupBy("gross_date")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "row"))), lambda r: r["row"]), "").alias("rows"))
        .select(
            "gross_date",
            F.concat(
                F.lit('<table><tr><td>x</td></tr></table><TABLE border="0" cellpadding="5" cellspacing="1"><tr><td>Rank</td></tr>'),
                "rows",
                F.lit("</TABLE>"),
            ).alias("html"),
        )
    )


@query("boxoffice_fx")
def s4_extract_chart(chart):
    """Chart pages written from the chart, one per day, and read back."""
    pages = _chart_pages(chart, F.when(F.col("rank") == 2, "n/a").otherwise(text_of("rank")))
    return rounded(readers.extract_chart(pages))


@query("movie_json_fx")
def s5_normalize_metadata(movies):
    found = readers.normalize_metadata(movies)
    return rounded(found.select("p_partkey", "title", "year", "runtime", "imdbvotes", "imdbrating", "actors"))


def _nested_posts(tweets: DataFrame) -> DataFrame:
    """Posts in the nested form, with made-up author numbers and times."""
    i = F.col("tweet_id")
    return tweets.select(
        F.struct(
            (i * 3).alias("id"),
            F.concat(F.lit("user"), text_of(i)).alias("name"),
            (i % 2 == 0).alias("verified"),
            (i % 100).alias("followers_count"),
            (i % 90).alias("friends_count"),
            (i % 80).alias("favourites_count"),
            (i % 70).alias("statuses_count"),
        ).alias("author"),
        i.alias("id"),
        F.timestamp_seconds(F.unix_date("tweet_date").cast("bigint") * 86400 + i % 86400).alias("created_at"),
        (i % 60).alias("favorite_count"),
        (i % 50).alias("retweet_count"),
        "lang",
        F.col("tweet_text").alias("text"),
    )


@query("tweets_fx")
def s6_flatten_posts(tweets):
    flat = readers.flatten_posts(_nested_posts(tweets))
    return flat.withColumn("tweet_datetime", S.format_post_time("tweet_datetime"))


def s7_read_table(spark: SparkSession, folder: str) -> DataFrame:
    documents = Table("documents", struct("doc_id long, text string, lang string, source string, n_chars long"))
    return readers.read_table(spark, documents, f"{folder}/documents.parquet", ["doc_id", "source"])


QUERIES["s7_read_table"] = s7_read_table


@query("tweets_fx", "sentiment_fx")
def s8_append_keyed(tweets, sentiment):
    """The labelled posts are there; all posts arrive, twice."""
    present = tweets.join(sentiment.select("tweet_id"), "tweet_id", "left_semi").select(*tweets.columns)
    added = sinks.new_rows(tweets.unionByName(tweets), present, ["title", "tweet_id"])
    both = present.withColumn("added", F.lit(False)).unionByName(added.withColumn("added", F.lit(True)))
    return both.select("title", "tweet_id", "added")


@query("boxoffice_fx")
def s10_csv_lines(chart):
    doubles = [F.col("daily_gross").cast("double").alias("gross"), (F.col("theaters") / 10_000).alias("share")]
    return sinks.csv_lines(chart.select("gross_date", "rank", F.concat("title", F.lit(' "x"')).alias("title"), "daily_gross", *doubles))


def _folder(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/query-{uuid4().hex}"


def _one_line(tweets: DataFrame) -> DataFrame:
    return tweets.withColumn("tweet_text", F.translate("tweet_text", "\n\r\t", "   "))


def _write_tsv(df: DataFrame, path: str, encoding: str = "UTF-8") -> str:
    options = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "encoding": encoding, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(**options).csv(path)
    return path


def _hashed(df: DataFrame, text: str, *by: str) -> DataFrame:
    return df.groupBy(*by, F.md5(text).alias("text_hash"), text_of("label").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("tweets_fx", "sentiment_fx")
def s1_read_labeled_text(tweets, sentiment):
    """Labelled posts written as delimited text and read back."""
    rows = _one_line(tweets).join(sentiment.select("tweet_id", F.col("label").alias("sentiment")), "tweet_id")
    path = _write_tsv(rows.select("tweet_id", "tweet_text", "sentiment"), _folder(tweets.sparkSession))
    return _hashed(readers.read_labeled_text(tweets.sparkSession, path, "tweet_text", "sentiment"), "tweet_text")


@query("tweets_fx", "sentiment_fx")
def s2_read_positional_tsv(tweets, sentiment):
    rows = _one_line(tweets).join(sentiment.select("tweet_id", "label"), "tweet_id")
    path = _write_tsv(rows.select("tweet_text", "label", "tweet_id"), _folder(tweets.sparkSession))
    return _hashed(readers.read_positional_tsv(tweets.sparkSession, path), "text")


@query("tweets_fx", "sentiment_fx")
def s3_read_datasets(tweets, sentiment):
    """Two corpora in two encodings."""
    rows = _one_line(tweets).join(sentiment.select("tweet_id", "label"), "tweet_id")
    files = {}
    for lang, encoding in (("en", "UTF-8"), ("de", "ISO-8859-1")):
        path = _write_tsv(rows.filter(F.col("lang") == lang).select("tweet_text", "label"), _folder(tweets.sparkSession), encoding)
        files[lang] = (path, encoding)
    return _hashed(readers.read_datasets(tweets.sparkSession, files), "text", "dataset")


@query("scores_fx")
def s9_replace_table(scores):
    """Metrics replaced by themselves plus what is new, read back."""
    store = jobs.Store(scores.sparkSession, _folder(scores.sparkSession)).create()
    rows = jobs.metrics_rows(_classed(scores))
    store.replace(rows.filter("pred_date < date'2017-01-04'"), METRICS)
    store.replace(store.read(METRICS).unionByName(rows.filter("pred_date >= date'2017-01-04'").select(*METRICS.columns)), METRICS)
    return rounded(store.read(METRICS).select("title", "pred_date", "pr_cls_neg", "avg_pr_pos"))


@query("tweets_fx", "sentiment_fx")
def s11_create_tables(tweets, sentiment):
    """Created tables are empty and typed; rows appended to one are read back."""
    store = jobs.Store(tweets.sparkSession, _folder(tweets.sparkSession)).create()
    rows = sentiment.select("tweet_id", "title", "label").join(tweets.select("tweet_id", "tweet_text"), "tweet_id")
    before = store.read(VALIDATION).count()
    store.append(rows, VALIDATION)
    read = store.read(VALIDATION)
    return read.select("title", "tweet_id", F.md5("tweet_text").alias("text_hash"), long_of("label").alias("label"), F.lit(before).cast("bigint").alias("before"))


@query("movie_json_fx")
def s12_append_metadata(movies):
    """Metadata appended twice: the second time nothing is new."""
    store = jobs.Store(movies.sparkSession, _folder(movies.sparkSession)).create()
    first = movies.groupBy("title", "year").agg(F.min("json").alias("json"))
    for year in (2016, 2017, 2017):
        found = readers.normalize_metadata(first.filter(F.col("year") == year).select("title", "json"))
        sinks.append_metadata(found, store.paths["movies"], f"{year}-01-01")
    return rounded(store.read(MOVIES).select("title", "search_date", "runtime", "imdbvotes"))


# --- Tokens -------------------------------------------------------------------------------------


@query("tweets_fx")
def t1_casual_tokenize(tweets):
    return joined(tweets, T.casual_tokenize("tweet_text"))


@query("tweets_fx")
def t2_pos_to_wordnet(tweets):
    return _tag_table(tweets).select("token", "tag", T.pos_to_wordnet("tag").alias("wordclass"))


@query("tweets_fx")
def t3_pos_lookup(tweets):
    rows = X.token_rows(tokens_of(tweets), ["tweet_id"])
    tagged = X.pos_lookup(rows, _tag_table(tweets), ["tweet_id", "pos"])
    return tagged.groupBy("token", "tag").agg(F.count(F.lit(1)).alias("n"))


@query("tweets_fx")
def t3_context_tags(tweets):
    """Tags learned from every other post, whose tags hang on the token before, and put on all posts."""
    # dealt out as texts, so that their token rows are not shuffled again for the two windows
    rows = X.token_rows(tokens_of(tweets.filter("tweet_id % 2 = 0").repartition("tweet_id")), ["tweet_id"])
    before = F.coalesce(F.lag("token").over(Window.partitionBy("tweet_id").orderBy("pos")), F.lit("."))
    after_short = F.length(before) < 4
    tag = F.when(F.endswith("token", F.lit("ing")), F.when(after_short, "VBG").otherwise("NN"))
    tag = tag.when(F.endswith("token", F.lit("er")), F.when(after_short, "JJ").when(F.length(before) > 7, "RB").otherwise("NN"))
    tag = tag.when(F.endswith("token", F.lit("ly")), "RB").when(F.endswith("token", F.lit("ble")), "JJ")
    tag = tag.when(F.length("token") < 4, "DT").otherwise("NN")
    model = G.tag_model(rows.withColumn("tag", tag), ["tweet_id"])
    tagged = G.context_tags(tokens_of(tweets).select("tweet_id", "tokens"), model)
    return tagged.select("tweet_id", F.array_join("tags", " ").alias("tags"))


@query("tweets_fx")
def t4_mark_negation(tweets):
    return joined(tokens_of(tweets), T.mark_negation("tokens"))


@query("tweets_fx")
def t5_unmark_emoticons(tweets):
    return joined(tokens_of(tweets), T.unmark_emoticons(T.mark_negation("tokens")))


@query("tweets_fx")
def t6_filter_tokens(tweets):
    return joined(tokens_of(tweets), T.filter_tokens(T.unmark_emoticons(T.mark_negation("tokens"))))


@query("tweets_fx")
def t7_remove_stopwords(tweets):
    return joined(tokens_of(tweets), T.clean_tokens("tokens"))


@query("tweets_fx")
def t8_tokenize_post(tweets):
    return joined(X.tokenize_posts(tweets), F.col("tokens"))


@query("tweets_fx")
def t8_tokenize_post_with_lemmas(tweets):
    tokens = X.tokenize_posts(tweets, lexicon=_tag_table(tweets), lemmas=_lemma_table(tweets))
    return joined(tokens, F.col("tokens"))


@query("tweets_fx")
def t9_ngrams(tweets):
    return joined(tokens_of(tweets), T.ngrams("tokens", 1, 2), "|")


@query("tweets_fx")
def t10_vocabulary(tweets):
    docs = tokens_of(tweets)
    modes = [V.vocabulary(docs, VOCABULARY, binary).withColumn("is_binary", F.lit(binary)) for binary in (False, True)]
    return rounded(modes[0].unionByName(modes[1]))


def _term_weights(tweets: DataFrame, weight) -> DataFrame:
    """Per term: number of documents and sum of the weights ``weight`` gives to the count vectors."""
    docs = tokens_of(tweets)
    vocab = V.collect_vocabulary(V.vocabulary(docs, VOCABULARY))
    vectors, column = weight(V.term_vector(docs, [t for t, _ in vocab]), vocab)
    sums = V.vector_rows(vectors, [], column).groupBy("index").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("value").alias("weight")
    )
    terms = F.array(*[F.lit(t) for t, _ in vocab])
    return rounded(sums.select(F.get(terms, F.col("index")).alias("term"), "docs", "weight"))


@query("tweets_fx")
def t11_term_vector(tweets):
    return _term_weights(tweets, lambda vectors, vocab: (vectors, "counts"))


@query("tweets_fx")
def t12_l2_tf(tweets):
    return _term_weights(tweets, lambda vectors, vocab: (V.l2_tf(vectors), "features"))


@query("tweets_fx")
def t13_tfidf(tweets):
    def weight(vectors, vocab):
        return V.tfidf(vectors, V.smoothed_idf(vocab, tweets.count())), "features"

    return _term_weights(tweets, weight)


def _word_counts(tweets: DataFrame) -> DataFrame:
    words = A.term_counts(tokens_of(tweets)).filter(F.col("term").rlike("^[a-z0-9]+$"))
    return cut_lineage(words.select(F.col("term").alias("word"), F.col("total").alias("n")))


@query("tweets_fx")
def t14_segment_hashtags(tweets):
    docs = tweets.select("tweet_id", "tweet_text")
    pairs = cut_lineage(X.word_pairs(tokens_of(tweets)))
    return X.segment_hashtags(docs, _word_counts(tweets), pair_counts=pairs)


@query("tweets_fx")
def t15_unescape_html(tweets):
    return tweets.select("tweet_id", T.unescape_html("tweet_text").alias("tweet_text"))


@query("pages")
def t15_unescape_page(pages):
    return pages.select("page_id", T.unescape_html("html").alias("html"))


@query("tweets_fx")
def t16_squeeze_whitespace(tweets):
    return tweets.select("tweet_id", T.squeeze_whitespace("tweet_text").alias("tweet_text"))


@query("tweets_fx")
def t17_split_edge_punct(tweets):
    return tweets.select("tweet_id", T.split_edge_punct("tweet_text").alias("tweet_text"))


def _ends(tweets: DataFrame, tokens: Column, heads: dict[int, int], tails: dict[int, int]) -> DataFrame:
    """The first and last tokens of the posts whose beginning or end the fixture wrote, by ``tweet_id % 9``."""
    case = F.col("tweet_id") % 9

    def count(sizes: dict[int, int]) -> Column:
        return F.coalesce(*[F.when(case == k, F.lit(n)) for k, n in sizes.items()], F.lit(0))

    made = tweets.select("tweet_id", tokens.alias("tokens"))
    head = F.array_join(F.slice("tokens", F.lit(1), count(heads)), " ")
    tail = F.array_join(F.reverse(F.slice(F.reverse("tokens"), F.lit(1), count(tails))), " ")
    return made.select("tweet_id", head.alias("head"), tail.alias("tail"))


@query("tweets_fx")
def t18_fixture_spans(tweets):
    return _ends(tweets, T.protected_spans(T.squeeze_whitespace("tweet_text")), {4: 6}, {2: 2, 6: 3})


@query("tweets_fx")
def t19_fixture_tokens(tweets):
    return _ends(tweets, T.split_tokens(T.squeeze_whitespace("tweet_text")), {0: 3, 1: 1, 4: 11, 5: 3}, {1: 1, 2: 9})


@query("tweets_fx")
def t20_fixture_tokens(tweets):
    return _ends(tweets, T.tokenize_raw("tweet_text"), {0: 3, 1: 1, 4: 11, 5: 3}, {1: 1, 2: 9, 3: 4, 6: 4})


@query("tweets_fx")
def t18_protected_spans(tweets):
    return joined(tweets, T.protected_spans(T.squeeze_whitespace("tweet_text")))


@query("tweets_fx")
def t19_split_tokens(tweets):
    return joined(tweets, T.split_tokens(T.squeeze_whitespace("tweet_text")))


@query("tweets_fx")
def t20_tokenize_raw(tweets):
    return joined(tweets, T.tokenize_raw("tweet_text"))


@query("tweets_fx")
def t20_characters_kept(tweets):
    """Raw tokens hold every character that is not a space, in order."""
    return tweets.select("tweet_id", F.array_join(T.tokenize_raw("tweet_text"), "").alias("characters"))


@query("tweets_fx")
def t21_split_contraction(tweets):
    with_short_forms = F.transform("tokens", lambda t: F.when(F.length(t) == 3, F.concat(t, F.lit("n't"))).when(F.length(t) == 4, F.concat(t, F.lit("'ll"))).otherwise(t))
    return joined(tokens_of(tweets), T.split_contraction(with_short_forms))


@query("tweets_fx")
def f1_apply_tokenizer(tweets):
    """A user's tokenizer in Python, called on batches of texts."""

    small_batches(tweets.sparkSession)

    @F.pandas_udf("array<string>")
    def letters_only(texts: pd.Series) -> pd.Series:
        return texts.str.findall(r"[a-z]+")

    return joined(tweets, T.apply_tokenizer("tweet_text", letters_only))


@query("tweets_fx")
def f2_apply_tokenizer_keep_case(tweets):
    tokenizer = lambda text: F.regexp_extract_all(text, F.lit("[A-Za-z]+"), F.lit(0))
    return joined(tweets, T.apply_tokenizer("tweet_text", tokenizer, preprocessor=lambda c: F.replace(c, F.lit("#"), F.lit(" "))))


# --- Models -------------------------------------------------------------------------------------


def _training(tweets: DataFrame, sentiment: DataFrame) -> DataFrame:
    return sentiment.drop("title").join(tweets, "tweet_id")


@query("tweets_fx", "sentiment_fx")
def m2_text_model_score(tweets, sentiment):
    """M1, M2 and M5: fit on the labelled posts, score all."""
    model = M.fit_text_model(_training(tweets, sentiment))
    return M.score(model, tweets.select("title", "tweet_id", "tweet_text")).drop("tweet_text")


def _penalties(entries: DataFrame, residuals: DataFrame, weights: list) -> list[float]:
    """The L2 penalty each class's weights w balance: at the optimum, minus (sum of residual x) w over w w.

    A solver that ends at its step limit still balances along w, so this tells a wrong penalty, sign or target.
    """
    names = [f"r{k}" for k in range(len(weights))]
    sums = entries.join(residuals, "tweet_id").groupBy("index").agg(*[F.sum(F.col("value") * F.col(n)).alias(n) for n in names])
    rows = [(i, *map(float, w)) for i, w in enumerate(zip(*weights, strict=True))]
    schema = "index int, " + ", ".join(f"w{k} double" for k in range(len(weights)))
    both = sums.join(entries.sparkSession.createDataFrame(rows, schema), "index")
    return list(both.agg(*[-F.sum(F.col(n) * F.col(f"w{k}")) / F.sum(F.col(f"w{k}") ** 2) for k, n in enumerate(names)]).first())


@query("tweets_fx", "sentiment_fx")
def m1_softmax_optimum(tweets, sentiment):
    """The fitted weights of every class balance a penalty of 1 / C."""
    train = _training(tweets, sentiment)
    model = M.fit_text_model(train)
    scored = cut_lineage(model.transform(train).select("tweet_id", "label", "features", vector_to_array("probability").alias("p")))
    residuals = scored.select("tweet_id", *[(F.get("p", F.lit(k)) - (F.col("label") == c).cast("double")).alias(f"r{k}") for k, c in enumerate(CLASSES)])
    weights = model.stages[-1].coefficientMatrix.toArray().tolist()
    found = _penalties(V.vector_rows(scored, ["tweet_id"], "features"), residuals, weights)
    return tweets.sparkSession.createDataFrame([(c, abs(p - 1) < 0.1) for c, p in zip(CLASSES, found, strict=True)], "label long, penalty_is_one boolean")


@query("tweets_fx", "sentiment_fx")
def m12_ridge_optimum(tweets, sentiment):
    """The weights of every class balance the penalty of the normal equations, within a thousandth."""
    docs = tokens_of(tweets).join(sentiment.select("tweet_id", "label"), "tweet_id")
    vocab = V.collect_vocabulary(V.vocabulary(docs, VOCABULARY))
    weighted = V.tfidf(V.term_vector(docs, [t for t, _ in vocab]), V.smoothed_idf(vocab, docs.count()))
    train = cut_lineage(M.indexed(weighted.select("tweet_id", "label", "features")))
    models = M.ridge_classifier(train).models
    residuals = train
    for k, (m, c) in enumerate(zip(models, CLASSES, strict=True)):
        target = F.when(F.col("label") == c, 1.0).otherwise(-1.0)
        residuals = m.copy().setPredictionCol(f"p{k}").transform(residuals).withColumn(f"r{k}", F.col(f"p{k}") - target)
    residuals = residuals.select("tweet_id", *[f"r{k}" for k in range(len(models))])
    found = _penalties(V.vector_rows(train, ["tweet_id"], "features"), residuals, [m.coefficients.toArray().tolist() for m in models])
    return tweets.sparkSession.createDataFrame([(c, abs(p - 1) < 1e-3) for c, p in zip(CLASSES, found, strict=True)], "label long, penalty_is_one boolean")


@query("tweets_fx", "sentiment_fx")
def m10_hinge_optimum(tweets, sentiment):
    """Neither other lengths of a class's weights nor other intercepts lower its hinge loss plus penalty."""
    docs = tokens_of(tweets).join(sentiment.select("tweet_id", "label"), "tweet_id")
    vocab = V.collect_vocabulary(V.vocabulary(docs, VOCABULARY))
    weighted = V.tfidf(V.term_vector(docs, [t for t, _ in vocab]), V.smoothed_idf(vocab, docs.count()))
    train = cut_lineage(M.indexed(weighted.select("tweet_id", "label", "features")))
    scored, losses, steps = train, [], (-0.1, 0.0, 0.1)
    for k, (m, c) in enumerate(zip(M.hinge_classifier().fit(train).models, CLASSES, strict=True)):
        scored = m.copy().setRawPredictionCol(f"r{k}").setPredictionCol(f"p{k}").transform(scored)
        product, sign = vector_to_array(f"r{k}")[1] - m.intercept, F.when(F.col("label") == c, 1.0).otherwise(-1.0)
        norm = float(m.coefficients.dot(m.coefficients))

        def loss(scale, shift, level=m.intercept, product=product, sign=sign, norm=norm):
            return F.avg(F.greatest(F.lit(0.0), 1 - sign * (scale * product + level + shift))) + 0.5 * M.HINGE_PENALTY * scale**2 * norm

        losses += [loss(1 + s, 0.0).alias(f"scale{k}{i}") for i, s in enumerate(steps)] + [loss(1.0, s).alias(f"level{k}{i}") for i, s in enumerate(steps)]
    row = scored.agg(*losses).first()
    best = [tuple(row[f"{kind}{k}1"] <= min(row[f"{kind}{k}0"], row[f"{kind}{k}2"]) + 1e-9 for kind in ("scale", "level")) for k in range(len(CLASSES))]
    return tweets.sparkSession.createDataFrame([(c, *b) for c, b in zip(CLASSES, best, strict=True)], "label long, length_is_best boolean, intercept_is_best boolean")


@query("tweets_fx", "sentiment_fx")
def s13_save_and_load_model(tweets, sentiment):
    """A stored model scores every post as the fitted one does."""
    spark = tweets.sparkSession
    model, path = M.fit_text_model(_training(tweets, sentiment)), _folder(spark)
    sinks.save_model(model, path, "2017-01-01", {"C": 1.0})
    loaded, params = sinks.load_model(spark, path)
    texts = tweets.select("title", "tweet_id", "tweet_text")
    one, two = (M.score(m, texts).select("tweet_id", "pr_class", "pr_neg") for m in (model, loaded))
    both = one.join(two.toDF("tweet_id", "loaded_class", "loaded_neg"), "tweet_id")
    same = (F.col("pr_class") == F.col("loaded_class")) & (F.abs(F.col("pr_neg") - F.col("loaded_neg")) < 1e-12)
    return both.select("tweet_id", (same & F.lit(params == {"C": 1.0})).alias("same"))


@query("tweets_fx", "sentiment_fx")
def m5_score_is_consistent(tweets, sentiment):
    """Probabilities add up to one and the class is the most probable one."""
    scored = M.score(M.fit_text_model(_training(tweets, sentiment)), tweets)
    total = F.col("pr_neg") + F.col("pr_neu") + F.col("pr_pos")
    best = S.argmax_label("pr_neg", "pr_neu", "pr_pos")
    return scored.select("title", "tweet_id", six(total).alias("total"), (best == F.col("pr_class")).alias("is_best"))


@query("sentiment_fx")
def m3_stratified_folds(sentiment):
    return rounded(M.stratified_folds(sentiment, ["tweet_id"]).select("tweet_id", "label", "fold"))


@query("tweets_fx", "sentiment_fx")
def m3_tune(tweets, sentiment):
    """The whole grid by five folds: 180 fits, and the refit of the best parameters on all rows."""
    tuned = M.tune(_training(tweets, sentiment), ["tweet_id"])
    rows = [(r["C"], r["binary"], r["max_features"], r["max_n"], r["accuracy"]) for r in tuned.results]
    schema = "C double, is_binary boolean, max_features int, max_n int, accuracy double"
    return tweets.sparkSession.createDataFrame(rows, schema)


@query("tweets_fx", "sentiment_fx")
def m3_tune_optimum(tweets, sentiment):
    """Each of the grid's 180 fits, one a row, is at its own optimum: its weights balance its penalty within a hundredth."""
    tokens = M.PostTokenizer().transform(_training(tweets, sentiment)).select("tweet_id", "tokens", "label")
    folds = cut_lineage(M.stratified_folds(cut_lineage(tokens), ["tweet_id"]).select("fold", "tokens", "label"))
    out = []
    for max_n in M.GRID["max_n"]:
        counts = M._fold_counts(folds, M.FOLDS, max_n)
        grams = folds.withColumn("tokens", T.ngrams("tokens", 1, max_n))
        for binary in M.GRID["binary"]:
            fits = M.fit_folds(grams, counts, binary, M.GRID["max_features"], M.GRID["C"])
            penalties = balanced_penalties(fits.rows, fits.masks, fits.tasks, fits.weights, len(CLASSES))
            for task, size, penalty in zip(fits.tasks, fits.sizes, penalties, strict=True):
                out.append((task.C, binary, size, max_n, task.fold, abs(penalty - 1) < 0.01))
    schema = "C double, is_binary boolean, max_features int, max_n int, fold int, penalty_is_one boolean"
    return tweets.sparkSession.createDataFrame(out, schema)


@query("tweets_fx", "sentiment_fx")
def m4_retrain(tweets, sentiment):
    labeled, validation = parts_of(_training(tweets, sentiment))
    model = M.retrain(M.text_model(C=10.0, max_n=2), validation, labeled)
    return M.score(model, tweets.select("title", "tweet_id", "tweet_text")).drop("tweet_text")


@query("open_fx")
def m6_self_train(scores):
    out = L.self_train(scores).select("title", "tweet_id", "pr_neg", "pr_neu", "pr_pos", "label", "method")
    return rounded(out)


@query("open_fx")
def m7_annotation_queue(scores):
    return rounded(L.annotation_queue(scores).select("title", "tweet_id", "pos", "pr_neg", "pr_neu", "pr_pos", "method"))


@query("sentiment_fx", "tweets_fx", "queue_fx", "answers_fx")
def m8_update_validation(sentiment, tweets, queue, answers):
    texts = tweets.select("tweet_id", "tweet_text")
    current = parts_of(sentiment)[1].join(texts, "tweet_id")
    posts = queue.select("title", "tweet_id").join(texts, "tweet_id")
    out = L.update_validation(current, posts, answers, "update")
    return out.select("title", "tweet_id", long_of("label").alias("label"), F.md5("tweet_text").alias("text_hash"))


@query("sentiment_fx")
def m9_train_test_split(sentiment):
    split = M.train_test_split(sentiment, ["tweet_id"], bucket=F.col("tweet_id") * 31 + 42)
    return split.select("tweet_id", "is_test")


@query("sentiment_fx")
def m9_train_test_split_hashed(sentiment):
    return M.train_test_split(sentiment, ["tweet_id"]).select("tweet_id", "is_test")


@query("tweets_fx", "sentiment_fx")
def m11_naive_bayes_parameters(tweets, sentiment):
    rows = X.token_rows(tokens_of(tweets), ["tweet_id"])
    weights = rows.groupBy("tweet_id", F.col("token").alias("term")).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    labels = sentiment.select("tweet_id", "label")
    return rounded(M.naive_bayes_parameters(weights, labels, ["tweet_id"]))


@query("tweets_fx", "sentiment_fx")
def m13_compare_models(tweets, sentiment):
    """M10, M11, M12: test accuracy of the three classifiers."""
    corpus = _training(tweets, sentiment).select(
        F.col("tweet_id").alias("row_id"), F.col("tweet_text").alias("text"), text_of("label").alias("label")
    )
    return A.accuracy(M.compare_models(corpus, _word_counts(tweets)), ["model"])


@query("predictions_fx")
def m13_accuracy_by_model(predictions):
    both = predictions.select("part", F.lit("old").alias("model"), F.col("old_class").alias("prediction"), "label").unionByName(
        predictions.select("part", F.lit("new").alias("model"), F.col("new_class").alias("prediction"), "label")
    )
    return rounded(A.accuracy(both, ["part", "model"]))


@query("predictions_fx")
def m14_compare_before_after(predictions):
    old = predictions.withColumnRenamed("old_class", "pr_class")
    new = predictions.withColumnRenamed("new_class", "pr_class")
    return rounded(M.compare_before_after(old, new))


# --- Jobs ---------------------------------------------------------------------------------------


@query("tweets_fx")
def d1_daily_posts(tweets):
    """Posts of one day for its charted titles, from nested posts."""
    day = pd.Timestamp(DAY).date()
    chart = A.distinct_titles(tweets, DAY).withColumn("gross_date", F.lit(day))
    found = jobs.daily_posts(chart, _nested_posts(tweets), day, 5)
    return found.select("title", "tweet_id", "tweet_retweet", "tweet_mention", "tweet_text")


@query("tweets_fx")
def d4_ingest_days(tweets):
    """All days gathered in one plan, from chart pages and nested posts, into an empty store; its posts with their charts."""
    store = jobs.Store(tweets.sparkSession, _folder(tweets.sparkSession)).create()
    counted = tweets.groupBy(F.col("tweet_date").alias("gross_date"), "title").agg(F.count(F.lit(1)).alias("daily_gross"))
    chart = R.top_n_per_day(counted.withColumn("theaters", F.col("daily_gross") + 1), 20)
    nothing = tweets.sparkSession.createDataFrame([], "title string, year int, json string")
    jobs.ingest_days(store, _chart_pages(chart, F.lit("1")), _nested_posts(tweets), nothing)
    charted = store.read(BOXOFFICE, ["gross_date", "title", "rank", "daily_gross"])
    posts = store.read(TWEETS, ["title", "tweet_id", "tweet_date", "tweet_text"]).withColumnRenamed("tweet_date", "gross_date")
    return rounded(charted.join(posts, ["gross_date", "title"]).withColumn("tweet_text", F.md5("tweet_text")))


@query("scores_fx", "tweets_fx", "queue_fx", "answers_fx", "open_fx")
def d3_labeled_rows(scores, tweets, queue, answers, posts):
    """What a labelling run appends: sure posts by their class, and answers to a published queue."""
    store = jobs.Store(tweets.sparkSession, _folder(tweets.sparkSession)).create()
    texts = tweets.select("tweet_id", "tweet_text")
    published = queue.join(texts, "tweet_id").withColumns({"session": F.lit("s"), "method": F.lit("manual-annotation")})
    store.append(published, QUEUE)
    by_hand = L.label_by_hand(jobs.published(store, "s"), answers)
    sure = L.self_train(posts.join(texts, "tweet_id"))
    store.append(L.labeled_rows(sure, by_hand), LABELED, "skip")
    return rounded(store.read(LABELED).select("title", "tweet_id", "label", "method", "pr_neg"))


@query("boxoffice_fx", "scores_fx")
def d4_missing_days(chart, scores):
    """Charted days that have no metrics yet, which a daily run makes up."""
    spark = chart.sparkSession
    store = jobs.Store(spark, _folder(spark)).create()
    store.append(R.top_n_per_day(chart, 10), BOXOFFICE)
    day = F.date_add(F.lit(pd.Timestamp("1992-01-01").date()), (F.col("tweet_id") % 3000).cast("int"))
    store.append(jobs.metrics_rows(_classed(scores.withColumn("tweet_date", day))), METRICS, "skip")
    days = [(str(d),) for d in jobs.missing_days(store)]
    return spark.createDataFrame(days, "gross_date string")


@query("scores_fx", "sentiment_fx")
def d2_daily_metrics(scores, sentiment):
    free = J.unlabeled_posts(scores, *parts_of(sentiment))
    return rounded(jobs.metrics_rows(_classed(free)))

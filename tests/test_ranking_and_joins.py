"""Row numbers, top-n and joins against plain Python, with one group holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from marquee import session
from marquee.operators import joins as J
from marquee.operators import ranking as R
from marquee.operators import text as X


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(2)
    rows = [("hot" if i % 10 < 7 else f"t{i % 13}", i, rng.randint(0, 5)) for i in rng.sample(range(20_000), 3_000)]
    return rows, spark.createDataFrame(rows, "title string, tweet_id long, v int").repartition(7)


def test_ranked_overall(skewed):
    rows, df = skewed
    got = {r.tweet_id: r.position for r in R.ranked(df, ["title", "tweet_id"]).collect()}
    assert got == {r[1]: i for i, r in enumerate(sorted(rows), 1)}


def test_ranked_within_groups_and_descending(skewed):
    rows, df = skewed
    got = {r.tweet_id: r.position for r in R.ranked(df, [F.desc("v"), "tweet_id"], ["title"]).collect()}
    want, seen = {}, {}
    for title, i, v in sorted(rows, key=lambda r: (r[0], -r[2], r[1])):
        seen[title] = seen.get(title, 0) + 1
        want[i] = seen[title]
    assert got == want


def test_ranked_takes_null_groups_and_no_rows(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, i int")
    assert {r.i: r.position for r in R.ranked(df, ["i"], ["g"]).collect()} == {1: 1, 2: 2, 3: 1}
    assert R.ranked(df.limit(0), ["i"]).collect() == []


def test_top_n_is_the_same_both_ways(skewed, monkeypatch):
    _, df = skewed
    window = R.top_n(df, ["title"], ["v", "tweet_id"], 50, "n").collect()
    monkeypatch.setattr(R, "MOST_IN_ONE_TASK", 10)
    assert sorted(R.top_n(df, ["title"], ["v", "tweet_id"], 50, "n").collect()) == sorted(window)


def test_top_n_prunes_before_the_shuffle(skewed):
    _, df = skewed
    plan = R.top_n(df, ["title"], ["tweet_id"], 20)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_sample_with_seed_ignores_partitioning(skewed):
    _, df = skewed
    first = {r.tweet_id for r in R.sample_per_title(df, 20, seed=1).collect()}
    again = {r.tweet_id for r in R.sample_per_title(df.repartition(3), 20, seed=1).collect()}
    assert first == again != {r.tweet_id for r in R.sample_per_title(df, 20, seed=2).collect()}
    assert R.sample_per_title(df) is df


def test_salted_join_is_the_plain_join(spark, skewed):
    _, df = skewed
    table = spark.createDataFrame([("hot", 1), ("hot", 2), ("t3", 3), ("zz", 4)], "title string, w int")
    for how in ("inner", "left"):
        plain = df.join(table, ["title"], how).select("title", "tweet_id", "w").collect()
        salted = J.salted_join(df, table, ["title"], ["tweet_id"], how).select("title", "tweet_id", "w").collect()
        key = lambda r: (r.title, r.tweet_id, r.w or 0)
        assert sorted(salted, key=key) == sorted(plain, key=key)


def test_mentions_of_whole_words_both_ways(spark):
    titles = spark.createDataFrame(
        [("2017-01-01", "The Fog"), ("2017-01-01", "It"), ("2017-01-02", "Fog"), ("2017-01-01", "!!!"), ("2017-01-01", "Up: Again")],
        "tweet_date string, title string",
    )
    posts = spark.createDataFrame(
        [
            ("2017-01-01", 1, "saw THE  FOG! it's fine"),
            ("2017-01-01", 2, "the foggy day, with bits"),
            ("2017-01-02", 3, "the fog"),
            ("2017-01-01", 4, "#up, up"),
            ("2017-01-03", 5, "the fog it up"),
        ],
        "tweet_date string, tweet_id long, tweet_text string",
    )
    want = {(1, "The Fog"), (1, "It"), (3, "Fog"), (4, "Up: Again")}
    for bound in (50, 0):
        rows = J.mention_join(titles, posts, max_per_day=bound).collect()
        assert len(rows) == len(want) and {(r.tweet_id, r.title) for r in rows} == want


def test_large_dictionaries_are_salted(spark, monkeypatch):
    docs = spark.createDataFrame([(1, ["cats", "the", "dogs"]), (2, ["the"]), (3, [])], "id int, tokens array<string>")
    lemmas = spark.createDataFrame([("cats", "n", "cat"), ("dogs", "n", "dog")], "token string, wordclass string, lemma string")
    small = X.lemmatize(docs, ["id"], lemmas).orderBy("id").collect()
    monkeypatch.setattr(J, "fits_broadcast", lambda df: False)
    assert X.lemmatize(docs, ["id"], lemmas).orderBy("id").collect() == small
    assert [r.tokens for r in small] == [["cat", "the", "dog"], ["the"], []]


def test_lemmas_do_not_shuffle_tokens(spark):
    docs = spark.createDataFrame([(1, ["cats"])], "id int, tokens array<string>")
    lemmas = spark.createDataFrame([("cats", "n", "cat")], "token string, wordclass string, lemma string")

    def shuffles(df):
        plan = X.lemmatize(df, ["id"], lemmas)._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning")

    assert shuffles(docs) == 2  # the rows, for their tokens and for their other columns; tokens stay where they are
    assert shuffles(docs.withColumn("other", F.lit("x"))) == 2  # and the other columns, by key


def test_lemmas_keep_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, ["cats"], "x"), (2, [], "y"), (3, None, "z")], "id int, tokens array<string>, other string")
    lemmas = spark.createDataFrame([("cats", "n", "cat")], "token string, wordclass string, lemma string")
    rows = X.lemmatize(docs, ["id"], lemmas).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, ["cat"], "x"), (2, [], "y"), (3, None, "z")]


def test_anti_join_keeps_posts_when_an_id_is_null(spark):
    posts = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2)], "title string, tweet_id long")
    taken = spark.createDataFrame([(1,), (None,)], "tweet_id long")
    rows = J.unlabeled_posts(posts, taken, taken.limit(0)).collect()
    assert [(r.title, r.tweet_id) for r in rows] == [("a", 2)]


def test_annotations(spark):
    queue = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "pos long, name string")
    answers = spark.createDataFrame(
        [(0, 0, " -1"), (1, 0, "x"), (1, 1, "1 "), (2, 0, "S"), (3, 0, "0"), (4, 0, "Q"), (5, 0, "1")],
        "pos long, attempt int, answer string",
    )
    got = {r.pos: r.label for r in J.apply_annotations(queue, answers).collect()}
    assert got == {0: -1, 1: 1, 3: 0}
    no_quit = answers.filter("pos <> 4")
    assert {r.pos for r in J.apply_annotations(queue, no_quit).collect()} == {0, 1, 3, 5}


def test_metadata_falls_back_one_year(spark):
    titles = spark.createDataFrame([("a", 2017), ("b", 2017), ("c", 2017), ("a", 2018)], "title string, year int")
    movies = spark.createDataFrame([("a", 2017, "x"), ("a", 2016, "y"), ("b", 2016, "z"), ("c", 2015, "w")], "title string, year int, plot string")
    got = {(r.title, r.year): (r.found_year, r.plot) for r in J.metadata_lookup(titles, movies).collect()}
    assert got == {("a", 2017): (2017, "x"), ("b", 2017): (2016, "z"), ("c", 2017): (None, None), ("a", 2018): (2017, "x")}
    assert [r.title for r in J.not_found(J.metadata_lookup(titles, movies)).collect()] == ["c"]


def test_size_check(spark):
    df = spark.range(100)
    assert session.fits_broadcast(df, max_rows=100) and not session.fits_broadcast(df, max_rows=99)
    assert not session.fits_broadcast(df, max_bytes=500)


def test_top_n_of_equal_rows_and_map_columns(spark):
    rows = [("t", 1, {"a": 1})] * 500 + [("t", 0, {"b": 2}), ("u", 5, None)]
    df = spark.createDataFrame(rows, "title string, v int, m map<string,int>").repartition(6)
    got = sorted((r.title, r.n, r.v) for r in R.top_n(df, ["title"], ["v"], 3, "n").collect())
    assert got == [("t", 1, 0), ("t", 2, 1), ("t", 3, 1), ("u", 1, 5)]

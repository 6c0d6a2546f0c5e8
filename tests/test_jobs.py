"""The daily jobs on staged data, the metric stream, and reruns."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marquee.operators.aggregates import title_metrics
from marquee.operators.models import fit_text_model
from marquee.plans import jobs
from marquee.schemas import BOXOFFICE, LABELED, METRICS, MOVIES, POST, QUARANTINE, QUEUE, TRAINING, TWEETS, VALIDATION
from marquee.sources import sinks
from marquee.streaming.metrics import stream_metrics
from tests.test_sources_and_sinks import chart_page, chart_row

DAY = dt.date(2017, 1, 1)


def post(i, text, day=DAY, lang="en", hour=0):
    author = (i * 10, f"u{i}", False, 1, 2, 3, 4)
    return (author, i, dt.datetime(day.year, day.month, day.day, hour, 30), 0, 0, lang, text)


@pytest.fixture()
def store(spark, tmp_path):
    return jobs.Store(spark, str(tmp_path)).create()


@pytest.fixture(scope="module")
def staged(spark):
    pages = spark.createDataFrame(
        [
            (DAY, chart_page([chart_row("The Fog: Part 2", "$900"), chart_row("Up", "$500"), chart_row("Out", "$100")])),
            (DAY + dt.timedelta(1), chart_page([chart_row("Up", "$700"), ["broken"]])),
            (DAY + dt.timedelta(2), "<p>gone</p>"),
        ],
        "gross_date date, html string",
    )
    rows = [
        post(1, "I loved The Fog so much", hour=1),
        post(2, "the fog was bad, not good", hour=2),
        post(3, "RT @a: the fog", hour=3),
        post(4, "the fog http://x.co", hour=4),
        post(5, "le fog the fog", lang="fr"),
        post(6, "@bob #up and the fog's \"ok\"", hour=5),
        post(7, "up up", day=DAY + dt.timedelta(1)),
        post(8, "nothing at all"),
    ]
    metadata = spark.createDataFrame(
        [
            ("the fog", 2016, '{"Plot":"Mist","imdbRating":"6.5"}'),
            ("Up", 2017, '{"Plot":"N/A","Runtime":"96 min"}'),
            ("out", 2017, '{"Error":"Movie not found!"}'),
        ],
        "title string, year int, json string",
    )
    return pages, spark.createDataFrame(rows, POST), metadata


def test_a_day_is_gathered(store, staged):
    assert jobs.ingest_day(store, *staged, titles_per_day=2) == DAY
    chart = store.read(BOXOFFICE).orderBy("rank").collect()
    assert [(r["rank"], r.title, r.daily_gross) for r in chart] == [(1, "The Fog: Part 2", 900), (2, "Up", 500)]
    posts = {(r.title, r.tweet_id): r for r in store.read(TWEETS).collect()}
    assert set(posts) == {("The Fog: Part 2", 1), ("The Fog: Part 2", 2), ("The Fog: Part 2", 6), ("Up", 6)}
    assert posts["The Fog: Part 2", 1].tweet_text == "I loved so much"
    assert posts["Up", 6].tweet_text == "and the fogs ok"
    assert posts["Up", 6].tweet_mention and not posts["Up", 6].tweet_retweet
    assert posts["Up", 6].tweet_datetime == dt.datetime(2017, 1, 1, 5, 30)
    movies = {r.title: r for r in store.read(MOVIES).collect()}
    assert set(movies) == {"The Fog: Part 2", "Up"}
    assert (movies["The Fog: Part 2"].imdbrating, movies["Up"].runtime, movies["Up"].search_date) == (6.5, 96, DAY)

    for _ in range(2):  # an unreadable row holds the day, and is kept once
        with pytest.raises(jobs.NoChartError, match="quarantine"):
            jobs.ingest_day(store, *staged)
    held = store.read(QUARANTINE).collect()
    assert [(r["rank"], r.gross_date, r.problem) for r in held] == [(2, DAY + dt.timedelta(1), "too few cells")]
    assert jobs.next_date(store) == DAY + dt.timedelta(1)
    assert jobs.ingest_day(store, *staged, skip_unreadable=True) == DAY + dt.timedelta(1)
    assert store.read(BOXOFFICE).count() == 3 and store.read(TWEETS).count() == 5
    with pytest.raises(jobs.NoChartError):
        jobs.ingest_day(store, *staged)
    assert jobs.next_date(store) == DAY + dt.timedelta(2)


def test_a_broken_run_is_run_again(store, staged, monkeypatch):
    pages, posts, metadata = staged
    with pytest.raises(Exception):
        jobs.ingest_day(store, pages, posts, metadata.drop("json"))
    assert jobs.next_date(store) == DAY  # the chart is written last
    assert store.read(TWEETS).count() > 0
    assert jobs.ingest_day(store, pages, posts, metadata) == DAY
    assert store.read(TWEETS).groupBy("title", "tweet_id").count().filter("count > 1").count() == 0


def test_newest_posts_of_each_title(spark, staged):
    chart = spark.createDataFrame([(DAY, "The Fog")], "gross_date date, title string")
    rows = jobs.daily_posts(chart, staged[1], DAY, per_title=2).collect()
    assert sorted(r.tweet_id for r in rows) == [2, 6]


def several_days(staged):
    """Five days: three good ones, one with an unreadable row, one good again."""
    pages, posts, metadata = staged
    spark = pages.sparkSession
    charts = [
        [chart_row("The Fog: Part 2", "$900"), chart_row("Up", "$500")],
        [chart_row("Up", "$700")],
        [chart_row("Up", "$70"), chart_row("Out", "$50")],
        [chart_row("Out", "$60"), ["broken"]],
        [chart_row("Up", "$5")],
    ]
    pages = spark.createDataFrame([(DAY + dt.timedelta(k), chart_page(c)) for k, c in enumerate(charts)], pages.schema)
    more = [post(100 + k, text, day=DAY + dt.timedelta(k % 5), hour=k) for k, text in enumerate(["up we go", "out and up", "the fog is up", "out!", "Up, up", "nothing", "UP out", "up?", "out of it", "up"])]
    more += [post(200, "up at the border", day=DAY + dt.timedelta(9))]
    return pages, posts.unionByName(spark.createDataFrame(more, POST)), metadata


def contents(store):
    return {t.name: sorted(map(str, store.read(t).collect())) for t in (BOXOFFICE, TWEETS, MOVIES, QUARANTINE)}


@pytest.mark.parametrize("skip", [False, True])
def test_days_gathered_at_once_are_those_gathered_in_turn(spark, staged, tmp_path, skip):
    staged = several_days(staged)
    once, turn = (jobs.Store(spark, str(tmp_path / n)).create() for n in ("once", "turn"))
    in_turn = []
    while True:
        try:
            in_turn.append(jobs.ingest_day(turn, *staged, posts_per_title=2, skip_unreadable=skip))
        except jobs.NoChartError:
            break
    assert len(in_turn) == (5 if skip else 3)
    assert jobs.ingest_days(once, *staged, posts_per_title=2, skip_unreadable=skip) == in_turn
    assert contents(once) == contents(turn)
    before = contents(once)
    with pytest.raises(jobs.NoChartError):
        jobs.ingest_days(once, *staged, skip_unreadable=skip)
    assert contents(once) == before


def test_a_range_ends_where_it_is_told(store, staged):
    staged = several_days(staged)
    assert jobs.ingest_days(store, *staged, last=DAY + dt.timedelta(1)) == [DAY, DAY + dt.timedelta(1)]
    assert store.read(QUARANTINE).isEmpty()
    assert jobs.ingest_days(store, *staged) == [DAY + dt.timedelta(2)]
    with pytest.raises(jobs.NoChartError, match="quarantine"):
        jobs.ingest_days(store, *staged)
    pages = staged[0]
    with pytest.raises(jobs.NoChartError):
        jobs.ingest_days(store, pages.limit(0), *staged[1:])


def test_a_broken_range_is_run_again(store, staged):
    pages, posts, metadata = several_days(staged)
    with pytest.raises(Exception):
        jobs.ingest_days(store, pages, posts, metadata.drop("json"))
    assert jobs.next_date(store) == DAY and store.read(TWEETS).count() > 0
    assert len(jobs.ingest_days(store, pages, posts, metadata)) == 3
    assert store.read(TWEETS).groupBy("title", "tweet_id").count().filter("count > 1").count() == 0


WORDS = {-1: "awful boring", 0: "plain usual", 1: "great lovely"}


def labelled_texts(spark, n=60):
    rows = [(f"{WORDS[i % 3 - 1]} film number{i % 7}", i % 3 - 1) for i in range(n)]
    return spark.createDataFrame(rows, TRAINING.schema)


def fill_tweets(store, n=60):
    spark = store.spark
    rows = [("hot" if i % 3 else f"t{i % 4}", i, DAY, f"{WORDS[i % 3 - 1]} film today") for i in range(n)]
    df = spark.createDataFrame(rows, "title string, tweet_id long, tweet_date date, tweet_text string")
    store.append(df, TWEETS)


@pytest.fixture(scope="module")
def model(spark):
    return fit_text_model(labelled_texts(spark), C=10.0)


def test_metrics_of_a_day(store, model):
    fill_tweets(store)
    assert jobs.daily_metrics(store, model, DAY) == 5
    assert jobs.daily_metrics(store, model, DAY) == 0
    rows = {r.title: r for r in store.read(METRICS).collect()}
    assert rows["hot"].pred_date == DAY
    assert rows["hot"].pr_cls_neg + rows["hot"].pr_cls_neu + rows["hot"].pr_cls_pos == pytest.approx(1)
    assert jobs.daily_metrics(store, model, DAY + dt.timedelta(1)) == 0


def test_labelled_posts_are_left_out(store, model):
    fill_tweets(store, 12)
    rows = [("elsewhere", 1, "x", 1), ("hot", 2, "x", 0)]
    store.append(store.spark.createDataFrame(rows, VALIDATION.schema), VALIDATION)
    assert {r.tweet_id for r in jobs.pull_posts(store, DAY).collect()} == set(range(12)) - {1, 2}


def test_update(store, model):
    spark = store.spark
    store.replace(labelled_texts(spark), TRAINING)
    fill_tweets(store)
    answers = spark.createDataFrame([(i, 0, "1") for i in range(4)] + [(4, 0, "s"), (5, 0, "q")], "pos long, attempt int, answer string")
    jobs.init_validation(store, DAY, answers, count=3)
    assert store.read(VALIDATION).count() == 4
    with pytest.raises(jobs.OutdatedQueueError):
        jobs.update_model(store, model, {"C": 10.0}, DAY, answers, count=10, threshold=0.99)
    assert jobs.publish_queue(store, model, DAY, count=10, threshold=0.99) == str(DAY)
    seen = {r.pos: r.tweet_id for r in store.read(QUEUE).collect()}
    answers = answers.filter(F.col("pos").isin(list(seen)))
    update = jobs.update_model(store, model, {"C": 10.0}, DAY, answers, count=10, threshold=0.99)
    assert sum(sum(c.values()) for c in update.counts.values()) == update.labeled
    by_hand = {r.tweet_id for r in store.read(LABELED).collect() if r.method == "manual-annotation"}
    assert by_hand == {seen[p] for p in seen if p < 4}
    labeled = store.read(LABELED).collect()
    assert update.labeled == len(labeled) > 0
    assert 0 <= update.old_accuracy <= 1 and 0 <= update.new_accuracy <= 1
    for r in labeled:
        best = max(r.pr_neg, r.pr_neu, r.pr_pos)
        assert (best >= 0.99) == (r.method == "self-training")
    assert jobs.update_model(store, model, {"C": 10.0}, DAY + dt.timedelta(1)) is None
    with pytest.raises(ValueError):
        jobs.init_validation(store, DAY, answers, method="other")


def test_the_whole_day(store, staged):
    spark = store.spark
    grid = {"C": [1.0], "binary": [False], "max_features": [50], "max_n": [1]}
    tuned = jobs.init_model(store, labelled_texts(spark), "2016-12-31", grid, folds=2)
    assert tuned.accuracy > 0.9
    assert jobs.daily_backend(store, *staged) == DAY
    assert store.read(METRICS).filter(F.col("pred_date") == F.lit(DAY)).count() == 2
    _, params = sinks.load_model(spark, store.model_path)
    assert params == tuned.params


def test_metrics_of_several_days_at_once(spark, model, tmp_path):
    days = [DAY + dt.timedelta(k) for k in range(3)]
    posts = [("hot" if i % 3 else f"t{i % 4}", i, DAY + dt.timedelta(i % 4), f"{WORDS[i % 3 - 1]} film today") for i in range(40)]
    posts = spark.createDataFrame(posts, "title string, tweet_id long, tweet_date date, tweet_text string")
    rows = []
    for name in ("once", "turn"):
        store = jobs.Store(spark, str(tmp_path / name)).create()
        store.append(posts, TWEETS)
        added = [jobs.daily_metrics(store, model, d) for d in ([days] if name == "once" else days)]
        made = store.read(METRICS).collect()
        assert sum(added) == len(made) and {r.pred_date for r in made} == set(days)
        rows.append(sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in made))
    assert rows[0] == rows[1]


def test_backfill(store, staged):
    spark = store.spark
    grid = {"C": [1.0], "binary": [False], "max_features": [50], "max_n": [1]}
    tuned = jobs.init_model(store, labelled_texts(spark), "2016-12-31", grid, folds=2)
    days = jobs.backfill(store, *several_days(staged))
    assert days == [DAY + dt.timedelta(k) for k in range(3)]
    made = {r.pred_date for r in store.read(METRICS).collect()}
    assert made == {r.tweet_date for r in store.read(TWEETS).collect()}
    assert {r.session for r in store.read(QUEUE).collect()} <= {str(days[-1])}
    _, params = sinks.load_model(spark, store.model_path)
    assert params == tuned.params


def test_broken_days_are_made_up(store, staged, monkeypatch):
    spark = store.spark
    grid = {"C": [1.0], "binary": [False], "max_features": [50], "max_n": [1]}
    jobs.init_model(store, labelled_texts(spark), "2016-12-31", grid, folds=2)
    pages, posts, metadata = staged
    pages = pages.unionByName(pages.filter(F.col("gross_date") == F.lit(DAY)).withColumn("gross_date", F.lit(DAY + dt.timedelta(1))))
    pages = pages.filter(~((F.col("gross_date") == F.lit(DAY + dt.timedelta(1))) & F.contains("html", F.lit("broken"))))
    with monkeypatch.context() as m:
        m.setattr(jobs, "daily_metrics", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.daily_backend(store, pages, posts, metadata)
    assert jobs.missing_days(store) == [DAY]
    assert jobs.daily_backend(store, pages, posts, metadata) == DAY + dt.timedelta(1)
    made = {r.pred_date for r in store.read(METRICS).collect()}
    assert DAY in made


def test_refits_keep_the_tokenizer(store, tmp_path):
    from marquee.operators.models import PostTokenizer

    spark = store.spark
    lemmas = str(tmp_path / "lemmas")
    spark.createDataFrame([("films", "n", "film"), ("film", "n", "film")], "token string, wordclass string, lemma string").write.parquet(lemmas)
    tokenizer = PostTokenizer(lemmaPath=lemmas)
    train = labelled_texts(spark)
    store.replace(train, TRAINING)
    fill_tweets(store, 30)
    model = fit_text_model(train, C=10.0, tokenizer=tokenizer)
    sinks.save_model(model, store.model_path, "1", {"C": 10.0})
    loaded, params = sinks.load_model(spark, store.model_path)
    store.append(spark.createDataFrame([("v", 900 + i, f"{WORDS[i]} films", i) for i in (-1, 0, 1)], VALIDATION.schema), VALIDATION)
    update = jobs.update_model(store, loaded, params, DAY, count=10, threshold=0.5)
    assert update.model.stages[0].getOrDefault("lemmaPath") == lemmas
    assert "film" in update.model.stages[2].vocabulary and "films" not in update.model.stages[2].vocabulary


def test_stream_equals_batch(spark, tmp_path):
    rows = []
    for i in range(200):
        when = dt.datetime(2017, 1, 1 + i // 50, i % 24)
        rows.append(("hot" if i % 3 else f"t{i % 4}", i, when, i % 3 - 1, 0.2, 0.3, 0.5))
    schema = "title string, tweet_id long, tweet_datetime timestamp, pr_class int, pr_neg double, pr_neu double, pr_pos double"
    scored = spark.createDataFrame(rows, schema)
    source = str(tmp_path / "in")
    late = spark.createDataFrame([("end", 999, dt.datetime(2017, 1, 9), 0, 0.0, 1.0, 0.0)], schema)
    scored.union(scored.filter("tweet_id < 20")).repartition(3).write.parquet(source)
    late.write.mode("append").parquet(source)
    path = sinks.create_tables(spark, str(tmp_path / "db"))["metrics"]
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    for _ in range(2):  # the second run finds nothing new
        stream_metrics(stream, path, str(tmp_path / "state"), "5 days").awaitTermination(120)
    got = spark.read.schema(METRICS.schema).parquet(path).filter("title <> 'end'")
    batch = title_metrics(scored.withColumn("pred_date", F.to_date("tweet_datetime")), ["title", "pred_date"])
    columns = METRICS.columns
    closed = batch.filter("pred_date < date'2017-01-04'").select(columns)
    rounded = [F.round(c, 9).alias(c) if c.startswith(("pr_cls", "avg")) else F.col(c) for c in columns]
    assert sorted(got.filter("pred_date < date'2017-01-04'").select(rounded).collect()) == sorted(closed.select(rounded).collect())


def test_sure_and_unsure_posts_part_the_scored_ones(spark, data):
    from checks.views import view
    from marquee.operators.labeling import annotation_queue, self_train

    scored = view(spark, data, "scores_fx")
    sure = {(r.title, r.tweet_id) for r in self_train(scored).collect()}
    queue = annotation_queue(scored).collect()
    rest = {(r.title, r.tweet_id) for r in queue}
    assert not sure & rest and len(sure) + len(rest) == scored.count()
    assert sorted(r.pos for r in queue) == list(range(len(queue)))


@pytest.mark.parametrize("name", ["j2_mention_join_many_titles", "j5_lemmatize", "t10_vocabulary", "w4_queue_position", "a1_title_metrics"])
def test_partitions_do_not_matter(spark, data, name):
    from checks.spark_queries import QUERIES

    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(sorted(map(tuple, QUERIES[name](spark, data).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]

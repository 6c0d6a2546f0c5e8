"""Files in, tables and files out."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from marquee.operators.ranking import top_n_per_day
from marquee.schemas import BOXOFFICE, METRICS, POST, TABLES, TRAINING, VALIDATION
from marquee.sources import readers, sinks


def write(folder: Path, name: str, text: str, encoding: str = "utf-8") -> str:
    path = folder / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_labeled_text(spark, tmp_path):
    path = write(tmp_path, "a.tsv", 'id\ttext\tsentiment\n1\t"say ""hi""\nthere"\t-1\n2\tplain, text\t1\n3\té\t0\n')
    rows = readers.read_labeled_text(spark, path, "text", "sentiment", multiLine=True).collect()
    assert [(r.tweet_text, r.label) for r in rows] == [('say "hi"\nthere', -1), ("plain, text", 1), ("é", 0)]


@pytest.mark.parametrize("label", ["", "good"])
def test_a_missing_label_fails(spark, tmp_path, label):
    path = write(tmp_path, "a.tsv", f"text\tsentiment\nx\t1\ny\t{label}\n")
    with pytest.raises(Exception, match="no integer label"):
        readers.read_labeled_text(spark, path, "text", "sentiment").collect()


def test_datasets_in_two_encodings(spark, tmp_path):
    files = {
        "one": (write(tmp_path, "one.tsv", "body\tclass\tmore\ncafé\tpos\tx\n", "utf-8"), "UTF-8"),
        "two": (write(tmp_path, "two.tsv", "t\tl\ncafé\tneg\n", "iso-8859-1"), "ISO-8859-1"),
    }
    rows = readers.read_datasets(spark, files).orderBy("dataset").collect()
    assert [tuple(r) for r in rows] == [("one", "café", "pos"), ("two", "café", "neg")]


def chart_page(rows, head="<tr><td>Rank</td></tr>"):
    body = "".join("<tr>" + "".join(f"<td align=x>{c}</td>" for c in r) + "</tr>" for r in rows)
    return f'<table><tr><td>menu</td></tr></table>\n<TABLE cellspacing="1" border="0" cellpadding="5">{head}{body}</TABLE>'


def chart_row(title, gross, theaters="1,000", todate="$9", day="3"):
    return ["1", "", f" <b>{title}</b> ", "", gross, "", "", theaters, "", todate, day]


def test_chart(spark):
    good = chart_page([chart_row("A &amp; B", "$1,234"), chart_row("C", "$12"), chart_row("D", "$5")])
    bad = chart_page([chart_row("A", "-"), ["1", "2"], chart_row("E", "$7", day="x")])
    pages = spark.createDataFrame(
        [(dt.date(2017, 1, 1), good), (dt.date(2017, 1, 2), bad), (dt.date(2017, 1, 3), "<p>moved</p>")], "gross_date date, html string"
    )
    found = readers.extract_chart(pages, 2)
    rows = [tuple(r) for r in readers.chart_rows(found).collect()]
    assert rows == [
        (dt.date(2017, 1, 1), 1, "A & B", 1234, 9, 3, 1000),
        (dt.date(2017, 1, 1), 2, "C", 12, 9, 3, 1000),
    ]
    problems = {(r.gross_date.day, r.rank): r.problem for r in readers.quarantined(readers.extract_chart(pages)).collect()}
    assert problems == {(2, 1): "unreadable: daily_gross", (2, 2): "too few cells", (2, 3): "unreadable: release_day", (3, None): "no chart table"}


def test_chart_with_open_cells(spark):
    page = '<table border=0 cellpadding=5 cellspacing=1><tr><td>h<tr>' + "".join(f"<td>{c}" for c in chart_row("X", "$3")) + "</table>"
    pages = spark.createDataFrame([(dt.date(2017, 1, 1), page)], "gross_date date, html string")
    assert [(r.title, r.daily_gross) for r in readers.chart_rows(readers.extract_chart(pages)).collect()] == [("X", 3)]


def test_chart_pages_that_lose_nothing(spark):
    opening = '<table border=0 cellpadding=5 cellspacing=1><tr><td>h</td></tr>'
    rows = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in chart_row(t, "$3")) + "</tr>" for t in ("X", "Y"))
    nested = rows.replace("<b>X</b>", "<b>X</b><table><tr><td>inner<table><tr><td>z</table></td></tr></table>")
    pages = [opening + rows, opening + nested + "</table><table><tr><td>other</table>", opening + "</table>", "<table border=0><tr><td>x</table>", None]
    df = spark.createDataFrame([(dt.date(2017, 1, k + 1), p) for k, p in enumerate(pages)], "gross_date date, html string")
    found = readers.extract_chart(df)
    assert sorted((r.gross_date.day, r.title) for r in readers.chart_rows(found).collect()) == [(1, "X"), (1, "Y"), (2, "X"), (2, "Y")]
    assert sorted((r.gross_date.day, r.problem) for r in readers.quarantined(found).collect()) == [(3, "no chart rows"), (4, "no chart table"), (5, "no chart table")]


def test_doubles_are_plain_decimals(spark):
    values = [0.0001, 12345678.0, 0.5, -1.25e-7, 123456789.125, -3e20, 100.0, 0.0, None, 1.0, 1234567.75, 1e7]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in sinks.csv_lines(df).collect()]
    assert got == ["0.0001", "12345678.0", "0.5", "-0.000000125", "123456789.125", "-3" + "0" * 20 + ".0", "100.0", "0.0", '""', "1.0", "1234567.75", "10000000.0"]


def test_metadata(spark):
    rows = [
        (1, '{"Actors":"A, B","Runtime":"107 min","imdbVotes":"1,234","imdbRating":"7.5","Metascore":"N/A","Plot":"N/A"}'),
        (2, '{"Response":"False","Error":"Movie not found!"}'),
    ]
    df = spark.createDataFrame(rows, "id int, json string")
    got = readers.normalize_metadata(df).collect()
    assert len(got) == 1
    assert (got[0].actors, got[0].runtime, got[0].imdbvotes, got[0].imdbrating) == ("A, B", 107, 1234, 7.5)
    assert got[0].metascore is None and got[0].plot is None


def test_posts(spark, tmp_path):
    line = (
        '{"author":{"id":7,"name":"n","verified":true,"followers_count":1,"friends_count":2,"favourites_count":3,'
        '"statuses_count":4},"id":9,"created_at":"2017-01-01T10:59:00","favorite_count":5,"retweet_count":6,"text":"t"}\n'
    )
    posts = readers.read_posts(spark, write(tmp_path, "p.json", line))
    assert posts.schema == POST
    row = readers.flatten_posts(posts).first()
    assert (row.author_id, row.author_favorites, row.tweet_id, row.tweet_retweets) == (7, 3, 9, 6)
    assert row.tweet_datetime == dt.datetime(2017, 1, 1, 10, 59)


def test_create_tables(spark, tmp_path):
    paths = sinks.create_tables(spark, str(tmp_path / "db"))
    for name, table in TABLES.items():
        assert readers.read_table(spark, table, paths[name]).count() == 0
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.create_tables(spark, str(tmp_path / "db"))
    sinks.create_tables(spark, str(tmp_path / "db"), overwrite=True)


def metrics(spark, *rows):
    return spark.createDataFrame(rows, "title string, pred_date date, pr_cls_neg double")


def test_keyed_append(spark, tmp_path):
    path = sinks.create_tables(spark, str(tmp_path))["metrics"]
    one, two = dt.date(2017, 1, 1), dt.date(2017, 1, 2)
    assert sinks.append_keyed(metrics(spark, ("a", one, 0.1), ("b", one, 0.2)), METRICS, path) == 2
    again = metrics(spark, ("a", one, 0.9), ("a", two, 0.3), ("a", two, 0.3))
    with pytest.raises(sinks.DuplicateKeyError):
        sinks.append_keyed(again, METRICS, path)
    assert sinks.append_keyed(again, METRICS, path, "skip") == 1
    assert sinks.append_keyed(again, METRICS, path, "skip") == 0
    rows = readers.read_table(spark, METRICS, path, ["title", "pred_date", "pr_cls_neg"]).collect()
    assert sorted(map(tuple, rows)) == [("a", one, 0.1), ("a", two, 0.3), ("b", one, 0.2)]
    with pytest.raises(Exception, match="null in key"):
        sinks.append_keyed(metrics(spark, (None, one, 0.1)), METRICS, path, "skip")
    with pytest.raises(ValueError):
        sinks.append_keyed(again, METRICS, path, "replace")


def test_one_key_on_most_rows(spark, tmp_path):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("title"),
        (F.col("id") % 1).alias("tweet_id"),
        F.lit("x").alias("tweet_text"),
        F.lit(1).alias("label"),
    )
    path = sinks.create_tables(spark, str(tmp_path))["validation"]
    assert sinks.append_keyed(rows, VALIDATION, path, "skip") == rows.select("title").distinct().count()


def test_replace_from_itself(spark, tmp_path):
    path = sinks.create_tables(spark, str(tmp_path))["training"]
    sinks.replace_table(spark.createDataFrame([("a", 1), ("b", 0)], TRAINING.schema), TRAINING, path)
    kept = readers.read_table(spark, TRAINING, path).filter("label = 1")
    sinks.replace_table(kept, TRAINING, path)
    assert [tuple(r) for r in readers.read_table(spark, TRAINING, path).collect()] == [("a", 1)]


def test_csv(spark, tmp_path):
    rows = [("say \"hi\", you", 1, 1.5, True, dt.date(2017, 1, 1)), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "title string, n int, x double, b boolean, d date").repartition(1)
    sinks.export_csv(df, str(tmp_path / "out"))
    parts = sorted((tmp_path / "out").glob("part-*"))
    text = "".join(p.read_text() for p in parts)
    assert text == '"title","n","x","b","d"\n"say ""hi"", you",1,1.5,1,"2017-01-01"\n"","","","",""\n'


def test_models_by_version(spark, tmp_path):
    path = str(tmp_path)
    with pytest.raises(Exception):
        sinks.load_model(spark, path)
    for version in ("2017-01-01", "2017-01-02"):
        model = PipelineModel([SQLTransformer(statement=f"SELECT *, '{version}' AS v FROM __THIS__")])
        assert sinks.save_model(model, path, version, {"C": 1.0})
    assert not sinks.save_model(None, path, "2017-01-03")
    model, params = sinks.load_model(spark, path)
    assert model.transform(spark.range(1)).first().v == "2017-01-02" and params == {"C": 1.0}
    older, _ = sinks.load_model(spark, path, "2017-01-01")
    assert older.transform(spark.range(1)).first().v == "2017-01-01"


def test_top_n_per_day(spark):
    day = dt.date(2017, 1, 1)
    rows = [(day, "b", 5), (day, "a", 5), (day, "c", 9), (dt.date(2017, 1, 2), "z", 1)]
    chart = spark.createDataFrame(rows, "gross_date date, title string, daily_gross long")
    got = sorted((r.gross_date.day, r["rank"], r.title) for r in top_n_per_day(chart, 2).collect())
    assert got == [(1, 1, "c"), (1, 2, "a"), (2, 1, "z")]
    assert BOXOFFICE.key == ("gross_date", "rank")


def test_append_metadata(spark, tmp_path):
    path = sinks.create_tables(spark, str(tmp_path))["movies"]
    found = readers.normalize_metadata(spark.createDataFrame([('{"Actors":"A","imdbRating":"7.5"}',)], "json string"))
    assert sinks.append_metadata(found, path, dt.date(2017, 1, 1), "Up") == 1
    assert sinks.append_metadata(found, path, dt.date(2017, 1, 1), "Up") == 0
    row = readers.read_table(spark, TABLES["movies"], path).first()
    assert (row.title, row.search_date, row.actors, row.imdbrating, row.plot) == ("Up", dt.date(2017, 1, 1), "A", 7.5, None)

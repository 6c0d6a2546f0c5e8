"""Every query with SQL gives the SQL's rows; every other query gives rows."""

import pytest

import __spark_entry__ as entry_module
from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.spark_queries import QUERIES

SLOW = {"m2_text_model_score", "m3_tune", "m4_retrain", "m13_compare_models"}


@pytest.fixture(scope="module")
def db(data):
    return connect(data)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert QUERIES.items() <= entry_module.queries().items()
    assert ORACLE.items() <= entry_module.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, data, db, name):
    assert difference(QUERIES[name](spark, data), db.execute(ORACLE[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - SLOW))
def test_gives_rows(spark, data, name):
    assert len(QUERIES[name](spark, data).collect()) > 0


def test_flagship(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 20
    for r in rows:
        assert r.pr_cls_neg + r.pr_cls_neu + r.pr_cls_pos == pytest.approx(1)
        assert r.avg_pr_neg + r.avg_pr_neu + r.avg_pr_pos == pytest.approx(1)

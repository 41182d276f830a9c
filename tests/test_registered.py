"""Registered queries against their SQL on the smallest tables."""

import pytest
from check_oracles import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SMALL

ORACLES, QUERIES = oracle_sql(), queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() == 1000


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLES[name], SMALL) == ""


def test_training_queries_share_one_fit_with_default_boosting(spark, monkeypatch):
    from types import SimpleNamespace

    from steprisk.catalog import inputs
    from steprisk.catalog.queries import QUERIES

    calls = []

    def train(table, **given):
        calls.append(given)
        rows = spark.createDataFrame([(1, 0, 0.5, 1, 2, 3, 4)], "event_id long, isFraud int, score double, tn long, fp long, fn long, tp long")
        return SimpleNamespace(scored=rows, metrics=rows, params={"cutoff_step": 7})

    monkeypatch.setitem(inputs.TRAINERS, "train_behavioral", (train, lambda spark, folder: None))
    monkeypatch.setattr(inputs, "_trained", {}, raising=False)
    for name in ("train_behavioral", "fit_classifier"):
        assert QUERIES[name](spark, "/nowhere").count() == 1
    assert calls == [{}]

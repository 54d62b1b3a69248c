"""Every registered query against its SQL counterpart, on the smallest tables."""

import os

import pytest
from compare import connect, differences, normal

import __spark_entry__ as registry

FOLDER = "/root/testdata/sf0.001"
CORE = sorted(registry.queries().keys() - registry.LLM_QUERIES.keys())
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_a_counterpart():
    assert CORE == sorted(registry.oracle_sql().keys() - registry.LLM_SQL.keys())


@pytest.mark.parametrize("name", CORE)
def test_query(spark, duck, name):
    found = registry.queries()[name](spark, FOLDER)
    left = normal(found.columns, [tuple(row) for row in found.collect()])
    answer = duck.execute(registry.oracle_sql()[name])
    right = normal([column[0] for column in answer.description], answer.fetchall())
    assert differences(left, right) == ""


def test_entry(spark):
    assert registry.entry(spark).columns == ["city", "avg_price_m2"]


def test_session_settings_of_others_are_corrected(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Warsaw")
    try:
        registry.queries()["curated_listings"](spark, FOLDER)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

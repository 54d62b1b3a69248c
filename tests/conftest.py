import contextlib
import io
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dwellmart.fixed_values import RAW_SCHEMA
from dwellmart.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


LISTING = {
    "listing_id": "olx_1", "city": "warsaw", "district": "wola", "price": 500000.0,
    "price_per_m2": None, "area": 50.0, "rooms": 2, "floor": 3, "building_year": 1999,
    "url": None, "date_scraped": "2025-06-01 10:00:00",
}


@pytest.fixture(scope="session")
def raw(spark):
    """Raw frames from partial records; what is not given is taken from a sound listing."""

    def build(*records):
        rows = [tuple({**LISTING, **record}.values()) for record in records]
        text_time = RAW_SCHEMA.replace("TIMESTAMP", "STRING")
        frame = spark.createDataFrame(rows, text_time)
        return frame.withColumn("date_scraped", frame.date_scraped.cast("timestamp"))

    return build


@pytest.fixture(scope="session")
def macro_record():
    def build(**fields):
        empty = dict.fromkeys(["price", "area", "rooms", "floor", "building_year"])
        return {"listing_id": "gus_1", **empty, "price_per_m2": 9000.0, **fields}

    return build


def ids(frame, column="listing_id"):
    return sorted(row[column] for row in frame.select(column).collect())


def columns_of(frame, *columns):
    return [tuple(row) for row in frame.select(*columns).collect()]


def plan_of(frame, mode="formatted"):
    """The plan as explain prints it."""
    with contextlib.redirect_stdout(io.StringIO()) as text:
        frame.explain(mode)
    return text.getvalue()


@pytest.fixture(params=["broadcast", "shuffled"])
def join_strategy(request, monkeypatch, spark):
    """Runs a test with broadcast lookups, and again as if every dimension were too large."""
    if request.param == "broadcast":
        yield request.param
        return
    monkeypatch.setattr("dwellmart.operators.lookup.BROADCAST_MEMBERS", 0)
    monkeypatch.setattr("dwellmart.operators.lookup.HOT_KEYS", 8)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)

"""The daily update as a batch, as a stream, and run again."""

import os

import pytest

from stockloom.catalog.extracts import TABLES, VERSION, Extracts, price_columns
from stockloom.functions import columns as C
from stockloom.operators.upsert import last_write_wins
from stockloom.sources.store import append_batch, compact, latest
from stockloom.streaming import daily
from pyspark.sql import functions as F

KEY = ["symbol", "date"]


def got(df):
    return sorted(tuple(r) for r in df.select("symbol", "date", "open", "close", "volume").collect())


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """Line items in five files."""
    folder = str(tmp_path_factory.mktemp("lines"))
    Extracts(spark, "/root/testdata/sf0.001").table("lineitem").repartition(5).write.mode("overwrite").parquet(folder)
    return folder


def stream_of(spark, folder):
    raw = daily.price_stream(spark, folder, TABLES["lineitem"], "*.parquet", 1)
    return raw.select(*price_columns(F.col("l_extendedprice")))


def prepare(batch):
    return C.coerce_prices(batch, VERSION)


def test_stream_of_many_batches_equals_one_batch(spark, lines, tmp_path):
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    daily.stream_update(stream_of(spark, lines), log, checkpoint, prepare, version=VERSION)
    assert len([d for d in os.listdir(log) if d.startswith("batch_id=")]) == 5
    whole = last_write_wins(C.coerce_prices(Extracts(spark, "/root/testdata/sf0.001").prices, VERSION), KEY, VERSION)
    want = got(whole)
    assert got(latest(spark, log, KEY, VERSION)) == want
    # Nothing new waits on the stream, and a batch written again changes nothing.
    daily.stream_update(stream_of(spark, lines), log, checkpoint, prepare, version=VERSION)
    again = spark.read.parquet(os.path.join(log, "batch_id=2"))
    append_batch(spark.createDataFrame(again.collect(), again.schema), log, 2)
    assert got(latest(spark, log, KEY, VERSION)) == want
    fresh = str(tmp_path / "fresh")
    compact(spark, log, fresh, KEY, VERSION)
    assert got(latest(spark, fresh, KEY, VERSION)) == want


def test_without_a_version_the_later_batch_wins(spark, tmp_path):
    log = str(tmp_path)
    make = lambda v: spark.createDataFrame([("A", "2025-01-02", v)], "symbol string, date string, close double")
    append_batch(make(9.0), log, 0)
    append_batch(make(1.0), log, 1)
    assert latest(spark, log, KEY).first().close == 1.0


def test_daily_update_touches_its_day_only(spark):
    make = lambda *r: spark.createDataFrame(list(r), "symbol string, date date, close double")
    day = lambda s: __import__("datetime").date.fromisoformat(s)
    now = make(("A", day("2025-01-01"), 1.0), ("A", day("2025-01-02"), 2.0))
    extract = make(("A", day("2025-01-02"), 5.0), ("A", day("2025-01-03"), 7.0), ("B", day("2025-01-02"), 6.0), ("Z", day("2025-01-02"), 8.0))
    company = spark.createDataFrame([("A",), ("B",)], "symbol string")
    out = daily.daily_update(now, extract, company, "2025-01-02")
    assert sorted((r.symbol, r.date.day, r.close) for r in out.collect()) == [("A", 1, 1.0), ("A", 2, 5.0), ("B", 2, 6.0)]

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from stockloom.functions import columns as C

def rows(df):
    return [tuple(r) for r in df.collect()]


def test_provider_names_become_canonical_and_values_stay(spark):
    df = spark.sql("SELECT 7 AS seq, '1999-12-31' AS TIME, 3.5D AS low")
    out = C.canonical_prices(df, "MNO")
    assert out.columns == ["seq", "date", "low", "symbol"]
    assert tuple(out.first()) == (7, "1999-12-31", 3.5, "MNO")


@pytest.mark.parametrize("day,ticker", [("tradingDate", "Ticker"), ("Trading_Date", "ticker"), ("date", "symbol")])
def test_names_in_any_case(spark, day, ticker):
    df = spark.createDataFrame([("2025-01-01", "VCB", 1.0)], [day, ticker, "open"])
    out = C.canonical_prices(df, "XXX")
    assert sorted(out.columns) == ["date", "open", "symbol"]
    assert out.first().symbol == "VCB"


def test_two_day_columns_are_an_error(spark):
    df = spark.createDataFrame([("2025-01-01", "2025-01-01")], ["time", "tradingDate"])
    with pytest.raises(ValueError):
        C.canonical_prices(df, "VCB")


def test_missing_symbol_needs_one(spark):
    with pytest.raises(ValueError):
        C.with_symbol(spark.createDataFrame([(1,)], ["x"]), None)


def test_blank_defaults(spark):
    df = spark.createDataFrame(
        [("A", None, None), ("B", "", 0.0), ("C", "c", math.nan), ("D", " ", -1.0)], "symbol string, t string, n double"
    )
    out = df.select(C.text_or(df, "t", F.col("symbol")), C.number_or_zero(df, "n"), C.text_or(df, "absent"))
    got = rows(out)
    assert got[0] == ("A", 0.0, "") and got[1] == ("B", 0.0, "") and got[3] == (" ", -1.0, "")
    assert got[2][0] == "c" and math.isnan(got[2][1])


def test_numbers_from_text(spark):
    texts = ["1.5", " 1.5 ", "1e3", "-2", "abc", "", "1.5d", "3F", "5-LOW", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(C.number_of(F.col("t"))).collect()] == [
        1.5, 1.5, 1000.0, -2.0, None, None, None, None, None, None,
    ]


def test_day_of_date_timestamp_and_text(spark):
    df = spark.createDataFrame(
        [("2025-01-02",), ("2025-01-02T00:00:00",), ("2025-01-02 13:45:00",), ("soon",), (None,)], "t string"
    )
    day = dt.date(2025, 1, 2)
    assert [r[0] for r in df.select(C.day_of(F.col("t"))).collect()] == [day, day, day, None, None]
    stamp = spark.sql("SELECT timestamp_ntz '2025-01-02 23:59:59' AS t, date '2025-01-02' AS d")
    assert rows(stamp.select(C.day_of(F.col("t")), C.day_of(F.col("d")))) == [(day, day)]


def test_quarter_of_yearly_statement_is_zero(spark):
    df = spark.createDataFrame([("quarter", 3), ("year", 3), ("year", None)], "p string, q int")
    assert [r[0] for r in df.select(C.statement_quarter(F.col("p"), F.col("q"))).collect()] == [3, 0, 0]


def test_ranges_are_inclusive_and_open(spark):
    df = spark.sql("SELECT explode(sequence(date '2020-01-01', date '2023-12-31')) AS date")
    assert C.between_days(df, "2021-01-01", "2021-01-31").count() == 31
    assert C.between_days(df).count() == df.count()
    assert C.on_day(df, "2022-02-02").count() == 1
    assert C.lookback(df, "2023-12-31").count() == C.LOOKBACK_DAYS + 1
    assert C.lookback(df, "2023-12-31", start="2023-12-30").count() == 2


def test_decimals_become_doubles(spark):
    df = spark.sql("SELECT 1 AS i, CAST(2.50 AS DECIMAL(10,2)) AS d, CAST(NULL AS DECIMAL(5,1)) AS n")
    out = C.decimals_to_double(df)
    assert [t for _, t in out.dtypes] == ["int", "double", "double"] and rows(out) == [(1, 2.5, None)]

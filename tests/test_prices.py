import datetime as dt


from pressroom.operators import prices
from pressroom.plans.prices import store_prices
from pressroom.schemas import PRICE_BAR
from pressroom.sources.prices import read_bars, read_prices, ticker_series


def bars(spark, *rows):
    return spark.createDataFrame(
        [(t, dt.date(2024, 1, d), v, v, v, v, 1) for t, d, v in rows], PRICE_BAR
    )


def series(df):
    return {(r["ticker"], r["date"].day): r["close"] for r in df.collect()}


def test_refresh(spark):
    stored = bars(spark, ("A-USD", 1, 1.0), ("A-USD", 2, 1.0), ("B-USD", 5, 1.0))
    landed = bars(spark, *[(t, d, 2.0) for t in ("A-USD", "B-USD", "C-USD") for d in (2, 3, 4, 5)])
    now = "2024-01-05 12:00:00"
    added = {("A-USD", 3): 2.0, ("A-USD", 4): 2.0, ("A-USD", 5): 2.0}
    fresh = {("C-USD", d): 2.0 for d in (2, 3, 4, 5)}
    old = {("A-USD", 1): 1.0, ("A-USD", 2): 1.0}
    assert series(prices.refreshed_prices(stored, landed, now)) == {**old, **added, **fresh}
    full = series(prices.refreshed_prices(stored, landed, now, full_window=True))
    assert full == {**old, **added, **fresh, ("A-USD", 2): 2.0}
    stale = prices.stale_tickers(stored, landed, now)
    assert {r["ticker"] for r in stale.collect()} == {"A-USD", "C-USD"}


def test_window_bounds_new_tickers(spark):
    landed = bars(spark, ("C-USD", 1, 1.0), ("C-USD", 2, 1.0))
    stored = spark.createDataFrame([], PRICE_BAR)
    assert series(prices.new_bars(stored, landed, "2026-01-01")) == {("C-USD", 2): 1.0}


def test_store_and_read(spark, tmp_path):
    path = str(tmp_path / "prices")
    assert read_prices(spark, path).count() == 0
    store_prices(spark, path, bars(spark, ("A-USD", 1, 1.0), ("B-USD", 1, 1.0)), "2024-01-01 09:00:00")
    store_prices(spark, path, bars(spark, ("A-USD", 1, 9.0), ("A-USD", 2, 2.0)), "2024-01-02 09:00:00")
    assert series(read_prices(spark, path)) == {("A-USD", 1): 1.0, ("A-USD", 2): 2.0, ("B-USD", 1): 1.0}
    assert series(ticker_series(read_prices(spark, path), "B")) == {("B-USD", 1): 1.0}
    assert ticker_series(read_prices(spark, path), "NONE").count() == 0
    wide = prices.wide_prices(read_prices(spark, path), ["A-USD", "B-USD"])
    assert {"close_A-USD", "volume_B-USD"} <= set(wide.columns)
    row = wide.where("date = '2024-01-02'").first()
    assert row["close_A-USD"] == 2.0 and row["close_B-USD"] is None


def test_landed_bars(spark, tmp_path):
    bars(spark, ("BTC-USD", 1, 1.0), ("BTC-USD", 3, 1.0), ("X-USD", 1, 1.0)).write.option("header", True).csv(str(tmp_path / "b"))
    got = read_bars(spark, str(tmp_path / "b"), start="2024-01-01", end="2024-01-03", fmt="csv")
    assert series(got) == {("BTC-USD", 1): 1.0}

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.core import numeric, specs, timeutil
from marketloom.core.specs import SCALE

S = SCALE


def test_registry():
    assert len(specs.SPECS) == 12
    with pytest.raises(KeyError, match="trades"):
        specs.spec("nothing")
    with pytest.raises(ValueError, match="not an event table"):
        specs.event_spec("dim_symbol")
    assert specs.spec("trades").scaled == {"price": S, "qty": S}
    assert specs.spec("trades").names[:2] == ["exchange", "trading_date"]
    with pytest.raises(ValueError, match="duplicate"):
        specs.TableSpec("x", "event", (specs.spec("trades").columns[0],) * 2)
    with pytest.raises(ValueError, match="unknown columns"):
        specs.TableSpec("x", "event", specs.spec("trades").columns, ("none",))


def test_normalize_and_validate(spark):
    row = spark.createDataFrame(
        [("x", dt.date(2024, 1, 1), "s", 1, 2, 3, 4, "buy", 5, 6)],
        "exchange string, trading_date date, symbol string, symbol_id int, ts_event_us long, file_id long, file_seq long, side string, price long, qty long",
    )
    out = specs.normalize(row, "trades")
    assert out.columns == specs.spec("trades").names
    specs.validate_schema(out, "trades")
    with pytest.raises(ValueError, match="missing"):
        specs.normalize(row.drop("side"), "trades")
    with pytest.raises(ValueError, match="integers"):
        specs.normalize(row.withColumn("price", F.lit(1.5)), "trades")
    with pytest.raises(ValueError, match="unexpected"):
        specs.validate_schema(out.withColumn("more", F.lit(1)), "trades")


def test_decode_scaled(spark):
    rows = spark.createDataFrame([(1, 10**10), (5 * 10**8, 25 * 10**7), (125 * 10**7, 1), (123456789000, None)], "price long, qty long")
    out = numeric.decode_scaled(rows, "trades").collect()
    assert [r["price_decoded"] for r in out] == [1e-9, 0.5, 1.25, 123.456789]
    assert out[3]["qty_decoded"] is None and out[0]["qty"] == 10**10
    assert numeric.decode_scaled(rows, "trades", ["price"], in_place=True).first()["price"] == 1e-9
    for bad in (dict(columns=["side"]), dict(columns=["price"], suffix="")):
        with pytest.raises(ValueError):
            numeric.decode_scaled(rows, "trades", **bad)


def test_exact_notional(spark):
    rows = spark.createDataFrame([(10**18, 9 * 10**17), (-3 * S, 2 * S), (1, 1)], "p long, q long")
    got = [int(r[0]) for r in rows.select(numeric.notional(F.col("p"), F.col("q"))).collect()]
    assert got == [10**18 * 9 * 10**17 // S, 6 * S, 0]


def test_times():
    assert timeutil.micros("2024-01-01T00:00:00Z") == timeutil.micros(dt.date(2024, 1, 1)) == 1_704_067_200_000_000
    assert timeutil.micros("2024-01-01T08:00:00+08:00") == 1_704_067_200_000_000
    assert timeutil.micros(dt.datetime(2024, 1, 1, 0, 0, 0, 1)) == 1_704_067_200_000_001
    with pytest.raises(ValueError):
        timeutil.bounds(5, 5)
    with pytest.raises(ValueError, match="unknown exchange"):
        timeutil.zone("nowhere")
    a, b = timeutil.date_bounds(1_704_067_200_000_000 + 16 * 3_600_000_000, 1_704_067_200_000_000 + 17 * 3_600_000_000, "sse")
    assert a == b == dt.date(2024, 1, 2)


def test_trading_date(spark):
    ts = timeutil.micros("2024-09-29T16:30:00Z")
    rows = spark.createDataFrame([("szse", ts), ("binance-futures", ts), ("?", ts)], "e string, t long")
    got = [r[0] for r in rows.select(timeutil.trading_date(F.col("t"), F.col("e"))).collect()]
    assert got == [dt.date(2024, 9, 30), dt.date(2024, 9, 29), None]

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.core.specs import OPEN_END, normalize, spec
from marketloom.core.specs import SCALE as S
from marketloom.operators import dimension, validation
from marketloom.sources import cn, crypto, files, ingest, lake, manifest

SNAPSHOT = "exchange string, exchange_symbol string, canonical_symbol string, market_type string, base_asset string, quote_asset string, tick_size long, lot_size long, contract_size long"
DELISTED = "exchange string, exchange_symbol string, delisted_at_ts_us long"


def snapshot(spark, *rows):
    return spark.createDataFrame([(e, s, s.lower(), "perpetual", s[:3], "USDT", tick, None, None) for e, s, tick in rows], SNAPSHOT)


def state(dim):
    return sorted((r["exchange"], r["exchange_symbol"], r["valid_from_ts_us"], r["valid_until_ts_us"], r["is_current"], r["tick_size"]) for r in dim.collect())


def test_upsert(spark):
    first = dimension.bootstrap(snapshot(spark, ("b", "BTC", None), ("b", "ETH", 5), ("d", "SOL", 1)), 1000)
    assert state(first)[0] == ("b", "BTC", 1000, OPEN_END, True, None)
    after = dimension.upsert(first, snapshot(spark, ("b", "BTC", 100), ("b", "NEW", 1)), 2000)
    assert state(after) == sorted([
        ("b", "BTC", 1000, 2000, False, None), ("b", "BTC", 2000, OPEN_END, True, 100), ("b", "ETH", 1000, 2000, False, 5),
        ("b", "NEW", 2000, OPEN_END, True, 1), ("d", "SOL", 1000, OPEN_END, True, 1),
    ], key=lambda r: (r[0], r[1], r[2]))
    dimension.validate(after)
    assert state(dimension.upsert(after, snapshot(spark, ("b", "BTC", 100), ("b", "NEW", 1)), 3000)) == state(after)


def test_upsert_with_delistings(spark):
    first = dimension.bootstrap(snapshot(spark, ("b", "BTC", 1), ("b", "ETH", 1), ("b", "XRP", 1)), 1000)
    gone = spark.createDataFrame([("b", "BTC", 1500), ("b", "ETH", 1600)], DELISTED)
    after = state(dimension.upsert(first, snapshot(spark, ("b", "ETH", 1)), 2000, gone))
    assert after == [("b", "BTC", 1000, 1500, False, 1), ("b", "ETH", 1000, OPEN_END, True, 1), ("b", "XRP", 1000, OPEN_END, True, 1)]
    none = state(dimension.upsert(first, snapshot(spark, ("b", "BTC", 1)), 2000, gone.limit(0)))
    assert all(r[4] for r in none) and len(none) == 3


def test_validation_of_dimension(spark):
    good = dimension.bootstrap(snapshot(spark, ("b", "BTC", 1)), 1000)
    bad = good.unionByName(good.withColumn("valid_from_ts_us", F.lit(500).cast("long")))
    rules = {r["rule"] for r in dimension.violations(bad).collect()}
    assert rules == {"several_current", "overlap", "repeated_symbol_id"}
    with pytest.raises(ValueError, match="overlap"):
        dimension.validate(bad)


def test_listing(spark):
    raw = spark.createDataFrame(
        [("000001.SZ", "000001", "Bank", "SZSE", "主板", "L", "19910403", None), ("688001.SH", "688001", None, "sse ", "科创板", "P", "20190722", None), ("600001.SH", "600001", "Old", "SSE", "主板", "D", "19980122", "20091229"), ("X", "X", "X", "BSE", "m", "L", "20200101", None), ("Y", "Y", "Y", "SSE", "m", "U", "20200101", None)],
        "ts_code string, symbol string, name string, exchange string, market string, list_status string, list_date string, delist_date string",
    )
    got = {r["exchange_symbol"]: r for r in dimension.from_listing(raw, 7).collect()}
    assert set(got) == {"000001", "688001", "600001"}
    assert (got["688001"]["lot_size"], got["688001"]["base_asset"], got["000001"]["lot_size"]) == (200 * S, "688001", 100 * S)
    assert not got["600001"]["is_current"] and got["600001"]["valid_until_ts_us"] == 1262044800000000
    assert [tuple(r) for r in dimension.delistings(raw).collect()] == [("sse", "600001", 1262044800000000)]


def test_point_in_time_coverage(spark):
    dim = spark.createDataFrame([("x", "A", 11, 10, 20), ("x", "A", 22, 20, OPEN_END), ("x", "B", 1, 0, 30), ("x", "B", 2, 10, 40)], "exchange string, exchange_symbol string, symbol_id long, valid_from_ts_us long, valid_until_ts_us long")
    events = spark.createDataFrame([("x", "A", t) for t in (9, 10, 19, 20)] + [("x", "B", 15), ("x", "B", 35), ("y", "A", 15)], "exchange string, symbol string, ts_event_us long")
    got = {(r["exchange"], r["symbol"], r["ts_event_us"]): r for r in dimension.pit_coverage(events, dim).collect()}
    assert len(got) == 7
    assert [got[("x", "A", t)]["symbol_id"] for t in (9, 10, 19, 20)] == [None, 11, 11, 22]
    assert (got[("x", "B", 15)]["symbol_id"], got[("x", "B", 35)]["symbol_id"]) == (1, 2)
    assert got[("y", "A", 15)][validation.REASON] == dimension.MISSING
    assert dimension.pit_coverage(events, dim.limit(0)).where(F.col(validation.REASON).isNotNull()).count() == 7


def test_crypto_normalisers(spark):
    raw = spark.createDataFrame([(" Binance ", "BTCUSDT", None, 5, "BUY", 43210.123456789, 0.005)], "exchange string, symbol string, timestamp long, local_timestamp long, side string, price double, amount double")
    row = crypto.trades(raw).first()
    assert (row["exchange"], row["side"], row["price"], row["qty"], row["ts_event_us"], row["trade_id"], row["is_buyer_maker"]) == ("binance", "buy", 43210123456789, 5000000, 5, None, None)
    assert crypto.trades(raw.withColumn("local_timestamp", F.lit(None).cast("long"))).first()["parse_error"] == "missing timestamp"
    book = raw.withColumns({"side": F.lit("ASK"), "amount": F.lit(0.0), "update_id": F.lit(987), "is_snapshot": F.lit(False)})
    assert (crypto.book(book).first()["book_seq"], crypto.book(book).first()["side"]) == (987, "ask")
    with pytest.raises(ValueError, match="missing"):
        crypto.quotes(raw)


def test_cn_normalisers(spark):
    order = spark.createDataFrame([("10", "1", "2", "10.23", "100", "20240102093000123", "3")], "ApplSeqNum string, Side string, OrdType string, Price string, OrderQty string, TransactTime string, ChannelNo string")
    row = cn.orders(order, "szse", "1").first()
    assert (row["symbol"], row["side"], row["order_type"], row["event_kind"], row["price"], row["qty"], row["order_ref"]) == ("000001", "BUY", "LIMIT", "ADD", 10230000000, 100 * S, 10)
    assert row["ts_event_us"] == 1704159000123000
    assert cn.orders(order.withColumn("TransactTime", F.lit("2024")), "szse", "1").first()["parse_error"] == "bad timestamp"
    sse = spark.createDataFrame([("600000", "20240102093000000", "1", "1.0", "5", "B", "D", "2")], "SecurityID string, TransactTime string, OrderNo string, Price string, Balance string, OrderBSFlag string, OrdType string, ChannelNo string")
    assert cn.orders(sse, "sse", "600001").first()["parse_error"] == "Symbol mismatch"
    assert cn.orders(sse, "sse", "600000").first()["event_kind"] == "CANCEL"
    ten, two = str([1.5] * 10), str([1.5] * 2)
    snap = spark.createDataFrame([("1", "20240102093000000", ten, str([1] * 10), ten, str([2] * 10)), ("2", "20240102093000000", two, str([1] * 10), ten, str([2] * 10))], "MsgSeqNum string, QuotTime string, BidPrice string, BidOrderQty string, OfferPrice string, OfferOrderQty string")
    got = cn.snapshots(snap, "szse", "000001").orderBy("snapshot_seq").collect()
    assert got[0]["parse_error"] is None and got[0]["bid_price_levels"] == [15 * S // 10] * 10 and got[0]["ask_qty_levels"] == [2] * 10
    assert got[1]["parse_error"] == "expected 10 levels"
    tick = spark.createDataFrame([("1", "0", "0", "1", "1", "X", "20240102093000000", "1")], "ApplSeqNum string, BidApplSeqNum string, OfferApplSeqNum string, Price string, Qty string, ExecType string, TransactTime string, ChannelNo string")
    assert cn.ticks(tick, "szse", "1").first()["parse_error"] == "unsupported execution type"


def test_archive_names(spark):
    names = ["order_new_STK_SZ_20240102.7z", "L1_new_STK_SH_20240102.7z", "bad.7z"]
    got = files.parse_archive_names(spark.createDataFrame([(n,) for n in names], "name string")).collect()
    assert (got[0]["table"], got[0]["exchange"], got[0]["trading_date"], got[0]["error"]) == ("cn_order_events", "szse", dt.date(2024, 1, 2), None)
    assert [r["error"] for r in got[1:]] == ["unsupported stream", "invalid archive name"]


def csv(folder, name, *rows):
    path = folder / name
    path.write_text("exchange,symbol,timestamp,local_timestamp,id,side,price,amount\n" + "".join(",".join(map(str, r)) + "\n" for r in rows))
    return path


SCHEMA = "exchange string, symbol string, timestamp long, local_timestamp long, id string, side string, price double, amount double"


def test_ingest_end_to_end(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    ts = 1_704_067_200_000_000
    csv(raw, "a.csv", ("deribit", "BTC", ts, ts, 1, "buy", 2.5, 1), ("deribit", "BTC", ts + 1, ts, 2, "buy", -1, 1), ("deribit", "NONE", ts, ts, 3, "sell", 1, 1))
    csv(raw, "b.csv", ("deribit", "BTC", ts, ts, 1, "x", 2.5, 1))
    csv(raw, "c.csv", ("deribit", "BTC", "", "", 1, "buy", 2.5, 1), ("deribit", "BTC", ts, ts, 1, "buy", 2.5, 1))
    dim = dimension.bootstrap(snapshot(spark, ("deribit", "BTC", 1)), ts - 5)
    listed = files.list_files(spark, str(raw), "*.csv", hashes=True).select(F.lit("v").alias("vendor"), F.lit("trades").alias("data_type"), "bronze_path", F.col("sha256").alias("file_hash"))
    read = lambda paths: files.with_file_seq(files.read_csv_typed(spark, paths, SCHEMA))
    dry = ingest.ingest(spark, root, listed, read, "trades", dim, dry_run=True)
    assert {r["file_id"] for r in dry.select("file_id").collect()} == {0}
    out = {r["bronze_path"][-5:]: r for r in ingest.ingest(spark, root, listed, read, "trades", dim).collect()}
    assert (out["a.csv"]["status"], out["a.csv"]["rows_written"], out["a.csv"]["rows_quarantined"]) == ("success", 1, 2)
    assert out["a.csv"]["status_reason"] == "invalid_trade_side_or_values+missing_pit_symbol_coverage"
    assert out["b.csv"]["status"] == "quarantined" and out["c.csv"]["status"] == "failed"
    assert sorted(r["file_id"] for r in out.values()) == [1, 2, 3]
    again = ingest.ingest(spark, root, listed, read, "trades", dim)
    assert sorted(r["bronze_path"][-5:] for r in again.collect()) == ["b.csv", "c.csv"]
    events = lake.load_events(spark, root, "trades", "Deribit", "BTC", ts, ts + 10, include_lineage=True).collect()
    assert [(r["price"], r["file_id"], r["file_seq"]) for r in events] == [(25 * S // 10, out["a.csv"]["file_id"], 1)]
    log = lake.read_table(spark, root, "validation_log").collect()
    assert {r["rule_name"] for r in log} == {"invalid_trade_side_or_values", "missing_pit_symbol_coverage"}
    assert {r["file_seq"] for r in log if r["file_id"] == out["a.csv"]["file_id"]} == {2, 3}
    assert lake.load_events(spark, str(tmp_path / "none"), "trades", "deribit", "BTC", 0, 1).count() == 0


def ingest_setup(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    ts = 1_704_067_200_000_000
    csv(raw, "a.csv", ("deribit", "BTC", ts, ts, 1, "buy", 2.5, 1), ("deribit", "BTC", ts, ts, 2, "buy", -1, 1))
    csv(raw, "b.csv", ("deribit", "BTC", ts + 5, ts, 1, "sell", 3.5, 1))
    dim = dimension.bootstrap(snapshot(spark, ("deribit", "BTC", 1)), ts - 5)
    listed = files.list_files(spark, str(raw), "*.csv", hashes=True).select(F.lit("v").alias("vendor"), F.lit("trades").alias("data_type"), "bronze_path", F.col("sha256").alias("file_hash"))
    return root, dim, listed, lambda paths: files.with_file_seq(files.read_csv_typed(spark, paths, SCHEMA))


def test_ingest_after_a_crash_between_events_and_ledger(spark, tmp_path):
    root, dim, listed, read = ingest_setup(spark, tmp_path)

    def broken(rows, table):
        lake.append_events(rows, root, table)
        raise RuntimeError("power cut")

    for _ in range(2):
        with pytest.raises(RuntimeError, match="power cut"):
            ingest.ingest(spark, root, listed, read, "trades", dim, writer=broken)
        assert lake.read_table(spark, root, "trades").count() == 2
    state = manifest.latest(lake.read_table(spark, root, "ingest_manifest")).collect()
    assert {r["status"] for r in state} == {"pending"} and sorted(r["file_id"] for r in state) == [1, 2]
    waits = lake.compact_partitions(spark, root, "trades", [{"exchange": "deribit", "trading_date": "2024-01-01"}], min_small_files=1)
    assert waits.first()["skipped"] == "pending_ingest"
    out = ingest.ingest(spark, root, listed, read, "trades", dim).collect()
    assert sorted((r["file_id"], r["status"]) for r in out) == [(1, "success"), (2, "success")]
    rows = lake.read_table(spark, root, "trades").collect()
    assert sorted((r["file_id"], r["file_seq"]) for r in rows) == [(1, 1), (2, 1)]
    assert lake.read_table(spark, root, "validation_log").count() == 1
    assert ingest.ingest(spark, root, listed, read, "trades", dim).count() == 0
    assert not list((tmp_path / "lake" / "_staged").glob("*"))
    assert lake.read_table(spark, root, "trades").count() == 2


def test_a_broken_retry_takes_back_its_own_rows_alone(spark, tmp_path):
    root, dim, listed, read = ingest_setup(spark, tmp_path)
    late = dim.withColumn("valid_from_ts_us", F.col("valid_from_ts_us") + 8)  # covers b.csv alone
    first = {r["bronze_path"][-5:]: r["status"] for r in ingest.ingest(spark, root, listed, read, "trades", late).collect()}
    assert first == {"a.csv": "quarantined", "b.csv": "success"}

    def broken(rows, table):
        lake.append_events(rows, root, table)
        raise RuntimeError("power cut")

    with pytest.raises(RuntimeError):
        ingest.ingest(spark, root, listed, read, "trades", dim, writer=broken)  # a.csv, known and tried again
    with pytest.raises(RuntimeError):
        ingest.ingest(spark, root, listed, read, "trades", dim, writer=broken, force=True)  # and b.csv, which has succeeded
    assert {r["status"] for r in manifest.latest(lake.read_table(spark, root, "ingest_manifest")).collect()} == {"pending"}
    assert {r["status"] for r in ingest.ingest(spark, root, listed, read, "trades", dim).collect()} == {"success"}
    rows = lake.read_table(spark, root, "trades").collect()
    assert sorted((r["file_id"], r["file_seq"], r["price"] // S) for r in rows) == [(1, 1, 2), (2, 1, 3)]


def test_ingest_writer_hook_and_parsing_once(spark, tmp_path):
    root, dim, listed, read = ingest_setup(spark, tmp_path)
    taken, reads = [], spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    once = lambda paths: (lambda rows: rows.mapInArrow(counted, rows.schema))(read(paths))
    out = ingest.ingest(spark, root, listed, once, "trades", dim, writer=lambda rows, table: taken.append((table, rows.count())))
    assert taken == [("trades", 2)] and {r["status"] for r in out.collect()} == {"success"}
    assert lake.read_table(spark, root, "trades").count() == 0
    assert reads.value == 3  # each raw row was read and parsed once


def test_dimension_store_and_discovery(spark, tmp_path):
    root = str(tmp_path)
    assert lake.load_dim(spark, root).count() == 0
    lake.save_dim(dimension.bootstrap(snapshot(spark, ("b", "BTCUSDT", 1), ("b", "ETHUSDT", 2)), 5), root)
    lake.save_dim(dimension.bootstrap(snapshot(spark, ("b", "BTCUSDT", 9), ("b", "B%C", 2)), 5), root)
    dim = lake.load_dim(spark, root)
    assert dim.count() == 2
    found = lake.discover_symbols(dim, "B", "btc").collect()
    assert [r["exchange_symbol"] for r in found] == ["BTCUSDT"] and "tick_size" not in found[0]
    assert lake.discover_symbols(dim, "b", "%").count() == 1
    assert lake.discover_symbols(dim, "b", as_of=4).count() == 0
    with pytest.raises(ValueError):
        lake.discover_symbols(dim, "b", limit=0)
    assert lake.load_symbol_meta(dim, "b", [" BTCUSDT ", "BTCUSDT"], columns=["tick_size"]).collect()[0][0] == 9
    joined = dimension.join_symbol_meta(dim.select("exchange", "symbol_id", F.lit(6).cast("long").alias("ts_event_us")), dim, ["tick_size"])
    assert sorted(r["tick_size"] for r in joined.collect()) == [2, 9]
    with pytest.raises(ValueError):
        dimension.join_symbol_meta(dim, dim, ["tick_size"], ts="valid_from_ts_us")


def test_compaction(spark, tmp_path):
    root = str(tmp_path)
    for day, n in ((1, 5), (2, 3)):
        for i in range(n):
            row = spark.createDataFrame([("x", dt.date(2024, 1, day), "s", 1, i, 1, i, "buy", 1, 1)], "exchange string, trading_date date, symbol string, symbol_id long, ts_event_us long, file_id long, file_seq long, side string, price long, qty long")
            lake.append_events(normalize(row, "trades"), root, "trades")
    one = {"exchange": "x", "trading_date": "2024-01-01"}
    assert lake.compact_partitions(spark, root, "trades", [one], dry_run=True).first()["skipped"] == "dry_run"
    assert lake.compact_partitions(spark, root, "trades", [one]).first()["skipped"] == "below_min_small_files"
    done = lake.compact_partitions(spark, root, "trades", [one, one], min_small_files=2).collect()
    assert [(r["files_before"], r["files_after"], r["skipped"]) for r in done] == [(5, 1, None)]
    assert lake.read_table(spark, root, "trades").count() == 8
    with pytest.raises(ValueError):
        lake.compact_partitions(spark, root, "trades", [{"exchange": "x"}])


def test_compaction_reports_errors_and_mends_a_broken_swap(spark, tmp_path):
    root = str(tmp_path)
    schema = "exchange string, trading_date date, symbol string, symbol_id long, ts_event_us long, file_id long, file_seq long, side string, price long, qty long"
    for i in range(3):
        row = spark.createDataFrame([("x", dt.date(2024, 1, 1), "s", 1, i, 1, i, "buy", 1, 1)], schema)
        lake.append_events(normalize(row, "trades"), root, "trades")
    one, none = {"exchange": "x", "trading_date": "2024-01-01"}, {"exchange": "x", "trading_date": "2030-01-01"}
    report = {r["partition"][-10:]: r for r in lake.compact_partitions(spark, root, "trades", [one, none], min_small_files=2).collect()}
    assert report["2024-01-01"]["error"] is None and report["2024-01-01"]["files_after"] == 1
    assert "PATH_NOT_FOUND" in report["2030-01-01"]["error"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lake.compact_partitions(spark, root, "trades", [none], continue_on_error=False)
    folder = tmp_path / "trades" / "exchange=x" / "trading_date=2024-01-01"
    old = next(folder.glob("*.parquet"))
    (folder / "_new-late.parquet").write_bytes(old.read_bytes())
    lake.finish_swap(spark, str(folder))  # the old files were not listed yet: back
    assert [p.name for p in folder.glob("*.parquet")] == [old.name]
    (folder / "_new-late.parquet").write_bytes(old.read_bytes())
    (folder / "_swap").write_text(old.name)
    assert lake.read_table(spark, root, "trades").count() == 3
    lake.finish_swap(spark, str(folder))  # they were: forward
    assert sorted(p.name for p in folder.iterdir() if p.suffix == ".parquet" or p.name == "_swap") == ["late.parquet"]
    assert lake.read_table(spark, root, "trades").count() == 3


def test_readers_and_writers_of_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n007,\n1.50,é\n")
    rows = files.read_csv_strings(spark, str(tmp_path / "a.csv"))
    assert rows.dtypes[:2] == [("x", "string"), ("y", "string")]
    assert [(r["x"], r["y"]) for r in rows.collect()] == [("007", None), ("1.50", "é")] and rows.first()["bronze_path"].endswith("a.csv")
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "n long, s string")
    for kind in ("csv", "json", "parquet"):
        lake.write_output(frame, str(tmp_path / kind), kind, limit=1)
        back = spark.read.csv(str(tmp_path / kind), header=True) if kind == "csv" else getattr(spark.read, kind)(str(tmp_path / kind))
        assert back.count() == 1 and set(back.columns) == {"n", "s"}
    with pytest.raises(ValueError, match="format"):
        lake.write_output(frame, str(tmp_path / "z"), "xml")
    lake.write_features(frame, str(tmp_path / "features"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "features")).collect())) == [(1, "a"), (2, "b")]


def test_upsert_keeps_ids(spark):
    first = dimension.bootstrap(snapshot(spark, ("b", "BTC", 1), ("b", "ETH", 2), ("c", "X", 3)), 5).withColumn("symbol_id", F.when(F.col("exchange_symbol") == "BTC", 42).when(F.col("exchange_symbol") == "ETH", 43).otherwise(44).cast("long"))
    out = dimension.upsert(first, snapshot(spark, ("b", "BTC", 9), ("b", "NEW", 1)), 10)
    ids = {(r["exchange_symbol"], r["valid_from_ts_us"]): r["symbol_id"] for r in out.collect()}
    assert (ids["BTC", 5], ids["ETH", 5], ids["X", 5]) == (42, 43, 44)
    again = dimension.bootstrap(snapshot(spark, ("b", "BTC", 9), ("b", "NEW", 1)), 10)
    made = {r["exchange_symbol"]: r["symbol_id"] for r in again.collect()}
    assert (ids["BTC", 10], ids["NEW", 10]) == (made["BTC"], made["NEW"])
    more = dimension.refresh(out, again.where("exchange = 'none'"))
    assert {(r["exchange_symbol"], r["valid_from_ts_us"]): r["symbol_id"] for r in more.collect()} == ids


def test_manifest(spark):
    names = spec("ingest_manifest").names
    rows = [(1, "v", "t", "p1", "h", "failed", 0, 0, 0, None, None, 5, 6, None), (1, "v", "t", "p1", "h", "success", 1, 1, 0, None, None, 5, 7, None), (2, "v", "t", "p2", "h", "failed", 0, 0, 0, None, None, 5, 6, "x")]
    ledger = spark.createDataFrame(rows, spec("ingest_manifest").schema)
    assert ledger.columns == names and manifest.latest(ledger).count() == 2
    files_ = spark.createDataFrame([("v", "t", f"p{i}", "h") for i in (1, 2, 3, 4)], "vendor string, data_type string, bronze_path string, file_hash string")
    assert sorted(r["bronze_path"] for r in manifest.filter_pending(files_, ledger).collect()) == ["p2", "p3", "p4"]
    ids = {r["bronze_path"]: (r["file_id"], r["created_at_ts_us"]) for r in manifest.assign_ids(files_, ledger).collect()}
    assert ids == {"p1": (1, 5), "p2": (2, 5), "p3": (3, None), "p4": (4, None)}
    assert manifest.manifest_diff(files_, ledger, "v").count() == 2


def test_streams_equal_batches(spark, tmp_path):
    from marketloom.operators.bars import time_bars
    from marketloom.streaming import jobs

    rows = [("x", "s", m * 60_000_000 + 5 * k, 1, m * 10 + k, (m + k + 1) * S, S) for m in range(6) for k in range(3)]
    schema = "exchange string, symbol string, ts_event_us long, file_id long, file_seq long, price long, qty long"
    batch = spark.createDataFrame(rows, schema)
    batch.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    run = jobs.stream_time_bars(stream).writeStream.format("memory").queryName("bars").outputMode("append").trigger(availableNow=True).start()
    run.awaitTermination()
    got = {tuple(r) for r in spark.table("bars").collect()}
    closed = {tuple(r) for r in time_bars(batch).where("bar_start_us < 240000000").collect()}
    assert got and got <= {tuple(r) for r in time_bars(batch).collect()} and len(closed - got) <= 1


def test_stream_ingest(spark, tmp_path):
    from marketloom.streaming import jobs

    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    ts = 1_704_067_200_000_000
    csv(raw, "a.csv", ("deribit", "BTC", ts, ts, 1, "buy", 2.5, 1))
    dim = dimension.bootstrap(snapshot(spark, ("deribit", "BTC", 1)), ts - 5)
    for _ in range(2):
        jobs.stream_ingest(spark, str(raw), SCHEMA, root, "v", "trades", lambda: dim, str(tmp_path / "state")).awaitTermination()
    assert lake.read_table(spark, root, "trades").count() == 1
    csv(raw, "a.csv", ("deribit", "BTC", ts + 1, ts, 1, "buy", 3.5, 1))  # another content under the old path
    jobs.stream_ingest(spark, str(raw), SCHEMA, root, "v", "trades", lambda: dim, str(tmp_path / "anew")).awaitTermination()
    ledger = lake.read_table(spark, root, "ingest_manifest").where("status = 'success'")
    assert lake.read_table(spark, root, "trades").count() == 2 and ledger.select("file_hash").distinct().count() == 2


def test_events_are_written_by_symbol(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    rows = [("deribit", dt.date(2024, 1, 1), f"S{i % 16:02}", i % 16, i, None, 1, i, None, "buy", None, S, S) for i in range(4000)]
    df = spark.createDataFrame(rows, spec("trades").schema).repartition(5)
    lake.append_events(df, str(tmp_path), "trades")
    spans = []
    for path in glob.glob(f"{tmp_path}/trades/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index("symbol")
        spans += [(g.column(at).statistics.min, g.column(at).statistics.max) for g in map(meta.row_group, range(meta.num_row_groups))]
    assert sum(a <= "S05" <= b for a, b in spans) <= 2 or len(spans) == 1
    found = lake.load_events(spark, str(tmp_path), "trades", "deribit", "S05", dt.datetime(1970, 1, 1), dt.datetime(2030, 1, 1)).count()
    assert lake.read_table(spark, str(tmp_path), "trades").count() == 4000 and found in (0, 250)


def gz(folder, name, *rows, cut=None):
    import gzip

    plain = csv(folder, name, *rows)
    data = gzip.compress(plain.read_bytes())
    plain.unlink()
    path = folder / f"{name}.gz"
    path.write_bytes(data if cut is None else data[:cut])
    return path


def identities(spark, raw, pattern="*"):
    listed = files.list_files(spark, str(raw), pattern, hashes=True)
    return listed.select(F.lit("v").alias("vendor"), F.lit("trades").alias("data_type"), "bronze_path", F.col("sha256").alias("file_hash"))


def test_one_bad_file_fails_alone(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    ts = 1_704_067_200_000_000
    rows = [("deribit", "BTC", ts + i, ts, i, "buy", 2.5, 1) for i in range(3_000)]
    gz(raw, "good.csv", *rows[:2])
    gz(raw, "cut.csv", *rows, cut=2_000)
    (raw / "noise.csv.gz").write_bytes(b"\x1f\x8b\x08\x00" + bytes(range(200)))
    csv(raw, "plain.csv", *rows[2:5])
    dim = dimension.bootstrap(snapshot(spark, ("deribit", "BTC", 1)), ts - 5)
    read = lambda paths: files.with_file_seq(files.read_csv_typed(spark, paths, SCHEMA))
    out = {r["bronze_path"].rsplit("/", 1)[1]: r for r in ingest.ingest(spark, root, identities(spark, raw), read, "trades", dim).collect()}
    assert (out["good.csv.gz"]["status"], out["good.csv.gz"]["rows_written"]) == ("success", 2)
    assert (out["plain.csv"]["status"], out["plain.csv"]["rows_written"]) == ("success", 3)
    for name in ("cut.csv.gz", "noise.csv.gz"):
        assert out[name]["status"] == "failed" and out[name]["status_reason"].startswith("pipeline_error: ")
        assert out[name]["rows_written"] == 0
    assert lake.read_table(spark, root, "trades").count() == 5
    # A later run takes the failed ones alone; mended, they succeed.
    (raw / "noise.csv.gz").unlink()
    gz(raw, "cut.csv", *rows[:7])
    again = ingest.ingest(spark, root, identities(spark, raw), read, "trades", dim).collect()
    assert [(r["status"], r["rows_written"]) for r in again] == [("success", 7)]


def test_a_file_that_breaks_the_parser_fails_alone(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    ts = 1_704_067_200_000_000
    for i in range(6):
        csv(raw, f"f{i}.csv", ("deribit", "BTC", ts + i, ts, "boom" if i == 3 else i, "buy", 2.5, 1))
    dim = dimension.bootstrap(snapshot(spark, ("deribit", "BTC", 1)), ts - 5)
    read = lambda paths: files.with_file_seq(files.read_csv_typed(spark, paths, SCHEMA))

    def parser(df):
        broken = F.when(F.col("id") == "boom", F.raise_error(F.lit("no such id"))).otherwise(F.col("id"))
        return ingest.PARSERS["trades"](df.withColumn("id", broken.cast("string")))

    out = {r["bronze_path"][-6:]: r for r in ingest.ingest(spark, root, identities(spark, raw), read, "trades", dim, parser=parser).collect()}
    assert {k for k, r in out.items() if r["status"] == "success"} == {f"f{i}.csv" for i in (0, 1, 2, 4, 5)}
    assert out["f3.csv"]["status"] == "failed" and "no such id" in out["f3.csv"]["status_reason"]
    # A price that is no integer is every file's fault.
    floats = lambda df: ingest.PARSERS["trades"](df).withColumn("price", F.col("price") / 1e9)
    lake2 = str(tmp_path / "lake2")
    out = ingest.ingest(spark, lake2, identities(spark, raw, "f0.csv"), read, "trades", dim, parser=floats).collect()
    assert out[0]["status"] == "failed" and out[0]["status_reason"].startswith("pipeline_error: ") and "must be integers" in out[0]["status_reason"]
    assert lake.read_table(spark, lake2, "trades").count() == 0


def test_many_broken_files_are_an_error(spark, tmp_path, monkeypatch):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    for i in range(4):
        csv(raw, f"f{i}.csv", ("deribit", "BTC", 1, 1, i, "buy", 2.5, 1))
    monkeypatch.setattr(ingest, "MOST_BROKEN", 2)
    dim = dimension.bootstrap(snapshot(spark, ("deribit", "BTC", 1)), 0)

    def read(paths):
        raise RuntimeError("the reader itself is broken")

    with pytest.raises(RuntimeError, match="itself is broken"):
        ingest.ingest(spark, root, identities(spark, raw), read, "trades", dim)


def test_hashes_hold_one_block(spark, tmp_path, monkeypatch):
    import hashlib
    import random

    rng = random.Random(1)
    data = {f"f{i}": rng.randbytes(rng.choice([1, 999, 1000, 1001, 20_000])) for i in range(12)} | {"na me%41": b"x"}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    got = [r["sha256"] for r in files.list_files(spark, str(tmp_path), hashes=True).collect()]
    assert sorted(got) == sorted(hashlib.sha256(x).hexdigest() for x in data.values())
    asked = []

    class Stream:
        def __init__(self, content):
            self.left = content

        def __enter__(self):
            return self

        def __exit__(self, *_):
            pass

        def read(self, n):
            asked.append(n)
            out, self.left = self.left[:n], self.left[n:]
            return out

    monkeypatch.setattr(files, "BLOCK", 1000)
    assert files.digest("x", lambda _: Stream(data["f3"] * 3)) == hashlib.sha256(data["f3"] * 3).hexdigest()
    assert set(asked) == {1000}

"""Operators on small runs whose results are known."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import schemas
from tidemark.functions import scalars as S
from tidemark.operators import book, curation, gates, health, instruments, normalizers, quotes, verdicts

T0 = dt.datetime(2026, 4, 6)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def trade(run, ord_, id_, price=100.0, size=0.5, skew=0.1, **more):
    return dict(run_id=run, ord=ord_, source="binance", product="BTCUSDT", channel="trades", event_type="trade", exchange_time=at(ord_), received_at=at(ord_ + skew), side="buy", price=price, size=size, order_id=None, trade_id=None if id_ is None else str(id_), sequence=id_, raw_type="trade", metadata=None) | more


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


@pytest.fixture(scope="module")
def trade_schema(spark):
    return StructType.fromDDL("run_id string, ord bigint, " + schemas.EVENT)


@pytest.fixture(scope="module")
def depth_schema(spark):
    return StructType.fromDDL("run_id string, ord bigint, update_id bigint, " + schemas.DEPTH)


def by_run(df):
    return {r.run_id: r for r in df.collect()}


def test_trades_verdicts(spark, trade_schema):
    rows = [trade("ok", 0, 1), trade("ok", 1, 2), trade("ok", 2, 2), trade("gap", 0, 1), trade("gap", 1, 100), trade("back", 0, 5), trade("back", 1, 4), trade("price", 0, 1, price=float("nan")), trade("size", 0, 1, size=0.0), trade("skew", 0, 1, skew=61), trade("none", 0, None)]
    got = by_run(verdicts.trades(frame(spark, rows, trade_schema), ["run_id"], ["ord"]))
    assert {k: r.findings for k, r in got.items()} == {"ok": [], "gap": ["trade_id_gaps"], "back": ["non_monotonic_trade_ids"], "price": ["invalid_prices"], "size": ["invalid_sizes"], "skew": ["excessive_clock_skew"], "none": ["missing_trade_ids"]}
    assert got["ok"].replayable and got["ok"].duplicate_trade_id_count == 1 and got["gap"].trade_id_gap_total_missing == 98
    stream = by_run(verdicts.trades_stream(frame(spark, rows, trade_schema), ["run_id"], ["ord"]))
    assert stream["back"].replayable and stream["back"].gap_detection == "none_native" and not stream["size"].replayable
    assert by_run(verdicts.funding(frame(spark, rows, trade_schema), ["run_id"], ["ord"]))["size"].replayable


def depth(run, ord_, first, final, bids=(), asks=(), event="depthUpdate", update_id=None, **more):
    pairs = lambda x: [(float(p), float(s)) for p, s in x]
    return dict(run_id=run, ord=ord_, update_id=update_id, source="binance", product="BTCUSDT", channel="depth", event_type=event, event_time=at(ord_), received_at=at(ord_), first_update_id=first, final_update_id=final, bids=pairs(bids), asks=pairs(asks)) | more


def test_depth_verdicts_and_books(spark, depth_schema):
    rows = [
        depth("a", 0, 1, 2, [(100, 1)], [(101, 2)]), depth("a", 1, 3, 4, [(100, 0), (99, 3)], [(101, 1.5), (102, 1)]),
        depth("b", 0, 100, 100, [(1, 1)]), depth("b", 1, 101, 102),
        depth("c", 0, 10, 12, [(100, 1)], [(101, 1)]), depth("c", 1, 14, 14), depth("c", 2, 13, 12, [(102, 1)]),
        depth("d", 0, 110, 115), depth("d", 1, 116, 120),
    ]
    u = book.sub_books(frame(spark, rows, depth_schema), ["run_id"], ["ord"])
    anchors = spark.createDataFrame([("a", 0), ("b", 100), ("d", 100)], "run_id string, snapshot_last_update_id bigint")
    states = book.fold(u, ["run_id"], "ord")
    got = by_run(verdicts.depth(u, ["run_id"], ["ord"], anchors, book.crossed_counts(states, ["run_id"])))
    assert got["a"].replayable and got["b"].replayable and got["b"].event_count == 1
    assert (got["c"].gap_count, got["c"].invalid_range_count, got["c"].crossed_book_count) == (1, 1, 1)
    assert got["c"].findings == ["gaps_detected", "invalid_update_ranges", "crossed_book_states"]
    assert (got["d"].snapshot_gap_count, got["d"].gap_count, got["d"].reordered_count) == (1, 0, 0)
    top = by_run(book.top_levels(book.final_levels(u, ["run_id"], ["ord"]), ["run_id"]))["a"]
    assert (top.best_bid, top.best_ask, top.spread) == (99, 101, 2) and [tuple(x) for x in top.top_asks] == [(101, 1.5), (102, 1)]


def test_stream_depth_modes(spark, depth_schema):
    snap = lambda run, i, **k: depth(run, 0, k.pop("first", None), i, event="snapshot", update_id=i)
    rows = [snap("ok", 1), depth("ok", 1, 1, 2, update_id=2), snap("gap", 1), depth("gap", 1, 7, 9, update_id=9), snap("back", 5), depth("back", 1, 5, 4, update_id=4), depth("bare", 0, 1, 1, update_id=1), snap("none", 1), depth("none", 1, 1, None)]
    df = frame(spark, rows, depth_schema)
    for ids in ("dense", "chain"):
        got = by_run(verdicts.depth_stream(df, ["run_id"], ["ord"], ids))
        assert {k: r.findings for k, r in got.items()} == {"ok": [], "gap": ["update_id_gaps"], "back": ["non_monotonic_update_id"], "bare": ["no_snapshot_anchor"], "none": ["missing_update_id"]}
    assert by_run(verdicts.depth_stream(df, ["run_id"], ["ord"]))["gap"].replayable


def test_chain_of_ids(spark, depth_schema):
    rows = [depth("ok", 0, -1, 100, event="snapshot"), depth("ok", 1, 100, 157), depth("ok", 2, 157, 203)]
    got = by_run(verdicts.depth_stream(frame(spark, rows, depth_schema), ["run_id"], ["ord"], "chain"))["ok"]
    assert got.replayable and (got.first_update_id, got.last_update_id, got.mode) == (100, 203, "stream_snapshot_chain")


def test_bounded_book_evicts(spark, depth_schema):
    rows = [depth("r", 0, 0, 1, [(100, 1), (99, 1)], [(101, 1), (102, 1)], event="snapshot"), depth("r", 1, 1, 2, [], [(100.5, 1)]), depth("r", 2, 2, 3, [], [(100.5, 0)])]
    u = book.sub_books(frame(spark, rows, depth_schema), ["run_id"], ["ord"])
    last = {r.ord: [x.price for x in r.top_asks] for r in book.fold(u, ["run_id"], "ord", depth=2).collect()}
    assert last == {0: [101, 102], 1: [100.5, 101], 2: [101]}
    free = {r.ord: [x.price for x in r.top_asks] for r in book.fold(u, ["run_id"], "ord").collect()}
    assert free[2] == [101, 102]


def test_book_folds_equal_final_levels(spark, depth_schema):
    rng = random.Random(1)
    rows = []
    for run in range(12):
        for i in range(25):
            levels = lambda: [(rng.randrange(5), rng.choice([0, 1, 2.5])) for _ in range(rng.randrange(4))]
            rows.append(depth(str(run), i, i, i, dict(levels()).items(), dict(levels()).items(), event="snapshot" if rng.random() < 0.15 else "delta"))
    u = book.sub_books(frame(spark, rows, depth_schema), ["run_id"], ["ord"])
    last = {r.run_id: r for r in book.fold(u, ["run_id"], "ord", top=99).where("ord = 24").collect()}
    final = {}
    for r in book.final_levels(u, ["run_id"], ["ord"]).collect():
        final.setdefault(r.run_id, {"bid": {}, "ask": {}})[r.side][r.price] = r.size
    for run, r in last.items():
        want = final.get(run, {"bid": {}, "ask": {}})
        assert {x.price: x.size for x in r.top_bids} == want["bid"] and {x.price: x.size for x in r.top_asks} == want["ask"]


def test_book_checksum_is_crc_of_plain_digits(spark):
    import zlib

    levels = lambda start, step: [(round(start + step * i, 1), round(0.05 + 0.011 * i, 8)) for i in range(12)]
    bids, asks = levels(45283.5, -0.3), levels(45285.2, 0.4)
    digits = lambda x, n: f"{x:.{n}f}".replace(".", "").lstrip("0") or "0"
    want = zlib.crc32("".join(digits(p, 1) + digits(s, 8) for side in (asks, bids) for p, s in side[:10]).encode())
    df = spark.createDataFrame([(bids, asks)], f"bids {schemas.LEVELS}, asks {schemas.LEVELS}")
    assert df.select(book.book_crc(F.col("bids"), F.col("asks"), 1, 8)).first()[0] == want


def test_gate_cursor(spark, trade_schema):
    meta = lambda again: (None, None, None, again, None, None, None)
    seqs = [("m", [(10, 0), (9, 0), (9, 0), (11, 0)]), ("r", [(100, 0), (99, 1), (100, 1), (101, 1), (102, 1), (103, 0)]), ("s", [(50, 1)])]
    rows = [trade(run, i, seq, metadata=meta(bool(again))) for run, xs in seqs for i, (seq, again) in enumerate(xs)]
    out = gates.event_gate(frame(spark, rows, trade_schema), ["run_id"], ["ord"])
    got = {(r.run_id, r.ord): r.accepted for r in out.collect()}
    assert [got["m", i] for i in range(4)] == [True, False, False, True]
    assert [got["r", i] for i in range(6)] == [True, False, False, True, True, True] and not got["s", 0]
    counts = {r.reason: r.rejects for r in gates.reject_histogram(out).collect()}
    assert counts == {"non_monotonic_sequence": 2, "subscribe_replay": 3}


def test_cursor_equals_sequential_restatement(spark):
    rng = random.Random(7)
    rows = [(run, i, rng.choice([None, *range(8)]), rng.random() < 0.3) for run in range(60) for i in range(20)]
    df = spark.createDataFrame(rows, "run bigint, ord bigint, sequence bigint, subscribe_replay boolean")
    got = {(r.run, r.ord): r.sequence_reason for r in gates.sequence_cursor(df, ["run"], ["ord"]).collect()}
    for run in range(60):
        cursor = None
        for _, i, seq, again in [x for x in rows if x[0] == run]:
            want = None
            if again and not (seq is not None and cursor is not None and seq > cursor):
                want = "subscribe_replay"
            elif seq is not None and cursor is not None and seq < cursor:
                want = "non_monotonic_sequence"
            elif seq is not None and (cursor is None or seq > cursor):
                cursor = seq
            assert got[run, i] == want


def frames(spark, source, *payloads):
    return spark.createDataFrame([(source, T0, json.dumps(p) if isinstance(p, dict) else p, i) for i, p in enumerate(payloads)], "source string, received_at timestamp, payload string, ord bigint")


def test_trade_normalizers(spark):
    b = normalizers.binance_trades(frames(spark, "binance", {"e": "aggTrade", "E": 1000, "T": 1001, "s": "BTCUSDT", "a": 7, "p": "1.5", "q": "2", "m": True}, {"data": {"e": "trade", "s": "ETHUSDT", "t": "x", "p": "", "q": "-", "m": "true"}})).orderBy("ord").collect()
    assert (b[0].sequence, b[0].side, b[0].metadata.instrument_id, b[0].metadata.canonical_symbol) == (7, "sell", "spot:binance:BTCUSDT", "BTC/USDT")
    assert b[0].exchange_time == dt.datetime(1970, 1, 1, 0, 0, 1, 1000) and not b[0].metadata.parse_errors
    assert b[1].metadata.parse_errors == ["invalid_trade_id", "invalid_buyer_is_maker", "invalid_size"] and b[1].price is None
    c = normalizers.coinbase_trades(frames(spark, "coinbase", {"type": "last_match", "trade_id": 5, "product_id": "BTC-USD", "price": "10", "size": "1", "side": "buy", "time": "2026-04-06T00:00:00Z", "sequence": 99})).first()
    assert (c.side, c.sequence, c.metadata.subscribe_replay, c.metadata.buyer_is_maker, c.metadata.canonical_symbol) == ("sell", 5, True, True, "BTC/USD")
    y = normalizers.bybit_trades(frames(spark, "bybit", {"topic": "publicTrade.BTCUSDT", "data": [{"T": 1, "s": "BTCUSDT", "S": "Buy", "v": "1", "p": "2", "i": "u-1", "seq": 3}, {"S": "No"}]}), "perp").orderBy("pos").collect()
    assert (y[0].side, y[0].trade_id, y[0].sequence, y[0].metadata.canonical_symbol, y[0].metadata.extra["bybit_cross_sequence"]) == ("buy", "u-1", None, "BTC/USDT-PERP", "3")
    assert y[1].product == "UNKNOWN" and y[1].metadata.parse_errors == ["invalid_side"]
    k = normalizers.kraken_trades(frames(spark, "kraken", {"channel": "trade", "type": "snapshot", "data": [{"symbol": "XBT/USD", "side": "sell", "price": 1.0, "qty": 2, "ord_type": "limit", "trade_id": 9, "timestamp": "2026-04-06T00:00:01Z"}]})).first()
    assert (k.sequence, k.side, k.metadata.subscribe_replay, k.metadata.canonical_symbol) == (9, "sell", True, "BTC/USD")
    m = normalizers.mexc_trades(frames(spark, "mexc", {"channel": "c", "symbol": "BTCUSDT", "publicAggreDeals": {"deals": [{"price": "1", "quantity": "2", "tradeType": 2, "time": "5"}, {"price": "1", "quantity": "2", "tradeType": 7}, {"price": "1", "quantity": "2"}]}})).orderBy("pos").collect()
    assert [r.side for r in m] == ["sell", None, None] and [r.metadata.parse_errors for r in m] == [[], ["invalid_side"], []]
    o = normalizers.okx_trades(frames(spark, "okx", {"arg": {}, "data": [{"instId": "BTC-USDT-SWAP", "tradeId": "4", "px": "1", "sz": "2", "side": "buy", "ts": "1000"}]}), "perp").first()
    assert (o.side, o.sequence, o.trade_id, o.metadata.instrument_id) == ("buy", None, "4", "perp:okx:BTCUSDT")
    f = normalizers.binance_funding(frames(spark, "binance-futures", {"symbol": "BTCUSDT", "markPrice": "10.5", "indexPrice": "10", "time": 1000})).first()
    assert (f.price, f.channel, f.metadata.extra["index_price"], f.metadata.canonical_symbol) == (10.5, "funding", "10.0", "BTC/USDT-PERP")


def test_depth_normalizers(spark):
    pairs = lambda levels: [tuple(x) for x in levels]
    b = normalizers.binance_depth(frames(spark, "binance", {"e": "depthUpdate", "E": 5, "s": "BTCUSDT", "U": 1, "u": 2, "b": [["1", "2"], ["x", "1"]], "a": "no"})).first()
    assert (b.first_update_id, b.final_update_id, pairs(b.bids), b.asks) == (1, 2, [(1, 2)], []) and b.metadata.parse_errors == ["invalid_bids", "invalid_asks"]
    c = normalizers.coinbase_depth(frames(spark, "coinbase", {"type": "snapshot", "product_id": "BTC-USD", "bids": [["1", "1"]], "asks": [["2", "0"]]}, {"type": "l2update", "product_id": "BTC-USD", "time": "2026-04-06T00:00:00Z", "changes": [["buy", "1", "0"], ["sell", "3", "1"], ["odd", "1", "1"]]})).orderBy("ord").collect()
    assert c[0].event_type == "snapshot" and pairs(c[0].asks) == [(2, 0)] and not c[0].metadata.parse_errors
    assert pairs(c[1].bids) == [(1, 0)] and pairs(c[1].asks) == [(3, 1)] and c[1].metadata.parse_errors == ["invalid_changes"]
    y = normalizers.bybit_depth(frames(spark, "bybit", {"type": "delta", "ts": 9, "cts": 8, "data": {"s": "BTCUSDT", "b": [["1", "2"]], "a": [], "u": 4}})).first()
    assert y.metadata.bybit_update_id == 4 and y.event_time == dt.datetime(1970, 1, 1, 0, 0, 0, 8000) and y.instrument.instrument_id == "spot:bybit:BTCUSDT"
    k = normalizers.kraken_depth(frames(spark, "kraken", {"channel": "book", "type": "update", "data": [{"symbol": "BTC/USD", "bids": [{"price": 1, "qty": 0}], "asks": [{"price": 2}], "checksum": 77}]})).first()
    assert pairs(k.bids) == [(1, 0)] and k.metadata.kraken_checksum == 77 and k.metadata.parse_errors == ["invalid_asks"]
    m = normalizers.mexc_depth(frames(spark, "mexc", {"symbol": "BTCUSDT", "channel": "c", "sendTime": "7", "publicLimitDepths": {"bids": [{"price": "1", "quantity": "2"}], "asks": [], "version": "3"}}, {"symbol": "BTCUSDT", "channel": "c"})).orderBy("ord").collect()
    assert m[0].event_type == "snapshot" and m[0].metadata.mexc_version == 3 and m[1].metadata.parse_errors == ["missing_publicLimitDepths"]
    o = normalizers.okx_depth(frames(spark, "okx", {"arg": {"instId": "BTC-USDT"}, "action": "snapshot", "data": [{"bids": [["1", "2", "0", "4"]], "asks": [], "ts": "5", "checksum": 1, "seqId": 9, "prevSeqId": -1}]})).first()
    assert (o.event_type, o.first_update_id, o.final_update_id, pairs(o.bids)) == ("snapshot", -1, 9, [(1, 2)])


def test_generic_text_and_frames(spark):
    g = normalizers.generic_events(frames(spark, "mock", {"product_id": "P", "channel": "full", "type": "open", "time": 1.5, "price": "x", "size": "", "remaining_size": 3, "sequence": 4, "other": "kept"})).first()
    assert (g.product, g.size, g.sequence, g.metadata.parse_errors, g.metadata.extra) == ("P", 3, 4, ["invalid_price"], {"other": "kept"}) and g.exchange_time.microsecond == 500000
    t = normalizers.text_items(frames(spark, "rss", {"feed": "f", "source_id": "1", "content_hash": "h", "raw_item": "r", "row_type": "new", "source_ts_raw": "Mon, 06 Apr 2026 00:00:00 GMT"}, {"feed": "f", "row_type": "odd", "source_ts_raw": "soon"})).orderBy("ord").collect()
    assert t[0].source_ts == T0 and t[1].metadata.source_ts_unparseable and t[1].event_type == "unknown"
    assert t[1].metadata.parse_errors == ["missing_source_id", "missing_content_hash", "missing_raw_item"]
    kinds = lambda style, *p: [r[0] for r in frames(spark, "x", *p).orderBy("ord").select(gates.frame_kind(F.col("payload"), style)).collect()]
    assert kinds("binance", {"result": None, "id": 1}, {"e": "trade"}, "[1]") == ["ack", "data", "other"]
    assert kinds("bybit", {"op": "subscribe", "success": True}, {"topic": "t"}, {"op": "pong"}) == ["ack", "data", "other"]
    assert kinds("kraken", {"channel": "trade", "data": []}, {"channel": "heartbeat"}) == ["data", "other"]
    assert gates.data_frames(frames(spark, "okx", {"event": "subscribe", "arg": {}}, {"arg": {}, "data": []}), "okx").count() == 1


def test_instruments(spark):
    rows = [("btcusdt", "binance"), ("BTC-PERPETUAL", "deribit"), ("SOL-PERPETUAL", "deribit"), ("ETHUSDC_PERP", "x"), ("XBT/USD", "kraken"), ("NOPE", "x"), ("BTCUSDT", "binance_futures"), ("", "x")]
    df = spark.createDataFrame(rows, "symbol string, venue string")
    got = lambda kind: {r.symbol: r.instrument and (r.instrument.instrument_id, r.instrument.canonical_symbol) for r in instruments.resolve(df, kind).collect()}
    spot, perp, any_ = got("spot"), got("perp"), got(None)
    assert spot["btcusdt"] == ("spot:binance:BTCUSDT", "BTC/USDT") and spot["XBT/USD"] == ("spot:kraken:XBTUSD", "BTC/USD") and spot["NOPE"] is None
    assert perp["BTC-PERPETUAL"] == ("perp:deribit:BTC-PERPETUAL", "BTC/USD-PERP") and perp["SOL-PERPETUAL"] == ("perp:deribit:SOL-PERPETUAL", "SOL/USD-PERP")
    assert perp["ETHUSDC_PERP"] == ("perp:x:ETHUSDC_PERP", "ETH/USDC-PERP") and any_["BTCUSDT"][0] == "perp:binance-futures:BTCUSDT" and any_[""] is None
    s = instruments.dimension_summary(instruments.asset_aliases(spark), instruments.instrument_aliases(spark)).first()
    assert (s.asset_count, s.asset_alias_count, s.instrument_alias_count, s.venues) == (10, 22, 4, ["binance-futures", "deribit"])
    assert [r[0] for r in spark.createDataFrame([("asset:eth",), ("x",)], "a string").select(instruments.legacy_asset_id(F.col("a"))).collect()] == ["crypto:ETH", "x"]


def test_scalars(spark):
    one = lambda c, **v: spark.createDataFrame([tuple(v.values())], ", ".join(f"{k} string" for k in v)).select(c).first()[0]
    price = lambda token, dollars=None: one(S.cents_price(F.col("t"), F.col("d")), t=token, d=dollars)
    assert [price("1"), price("45"), price("100"), price("0.45"), price("7", "0.3")] == [0.01, 0.45, 1.0, 0.45, 0.3]
    assert one(S.partition_value(F.col("a")), a="BTC/USDT x") == "BTC-USDT_x" and one(S.partition_value(F.col("a")), a="") == "unknown"
    lane = one(S.lane_parts(F.col("a")), a="bybit_perp_depth_ethusdt")
    assert (lane.venue, lane.dataset, lane.instrument) == ("bybit_perp", "depth", "ethusdt") and one(S.lane_parts(F.col("a")), a="odd") is None
    assert one(S.run_day(F.col("a")), a="20260406_101500") == dt.date(2026, 4, 6) and one(S.run_day(F.col("a")), a="2026xx") is None
    assert one(S.source_timestamp(F.col("a")), a="Mon, 06 Apr 2026 02:00:00 +0200") == T0 and one(S.source_timestamp(F.col("a")), a="2026-04-06T00:00:00Z") == T0
    assert one(S.path_value(F.col("a"), "event_date"), a="/x/event_date=2026-04-06/f.parquet") == "2026-04-06"
    assert one(S.frequency_seconds(F.col("a")), a="Hourly") == 3600 and one(S.truthy(F.col("a")), a=" YES ") is True


def test_text_verdicts(spark):
    schema = StructType.fromDDL("run_id string, ord bigint, " + schemas.TEXT)
    item = lambda run, i, lag=30.0, unread=False, id_="k", **m: dict(run_id=run, ord=i, source="rss", event_type="new", source_id=f"{id_}{i}", ingestion_ts=at(i), received_at=at(i), source_ts=None if lag is None else at(i - lag), content_hash="h", raw_item="r", metadata=(None, unread, None, None, [])) | m
    rows = [item("ok", 0), item("ok", 1, event_type="edit"), item("late", 0, 57600.0), item("odd", 0, -400.0), item("odd", 1, None), item("odd", 2, None, True), item("dup", 0), item("dup", 1, source_id="k0"), item("env", 0, content_hash=None), item("back", 0), item("back", 1, ingestion_ts=at(-9))]
    runs = spark.createDataFrame([("ok",), ("empty",), ("late",), ("odd",), ("dup",), ("env",), ("back",)], "run_id string")
    got = by_run(verdicts.text(frame(spark, rows, schema), ["run_id"], ["ord"], runs))
    assert got["ok"].replayable and (got["ok"].new_count, got["ok"].edit_count, got["ok"].max_source_lag_seconds) == (1, 1, 30.0)
    assert got["late"].replayable and got["late"].findings == ["stale_source_ts"]
    assert got["odd"].findings == ["missing_source_ts", "unparseable_source_ts", "future_source_ts"] and got["dup"].findings == ["duplicate_envelope_keys"]
    assert not got["env"].replayable and not got["back"].replayable and got["empty"].findings == ["no_events"]


def test_curation(spark):
    runs = spark.createDataFrame([("m", None, True), ("q", True, True), ("u", False, True), ("d", True, True), ("e", True, False), ("p", True, True), ("qu", False, True)], "run_path string, replayable boolean, has_events boolean")
    index = lambda *x: spark.createDataFrame([(i,) for i in x], "run_path string")
    got = {r.run_path: r.action for r in curation.promotion_actions(runs, index("q", "qu"), index("d")).collect()}
    assert got == {"m": "missing_replay", "q": "quarantined", "u": "unreplayable", "d": "already_promoted", "e": "missing_events", "p": "promote", "qu": "quarantined"}
    got = {r.run_path: r.action for r in curation.quarantine_actions(runs, index("qu")).collect()}
    assert got["m"] == "missing_replay" and got["u"] == "quarantine" and got["qu"] == "already_quarantined" and got["p"] == "replayable"


def test_append_once(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "run_path string, x int")
    data, index = str(tmp_path / "data"), str(tmp_path / "index")
    curation.append_once(rows, data, index)
    curation.append_once(rows.union(spark.createDataFrame([("c", 4)], rows.schema)), data, index)
    seen = curation.visible(spark.read.parquet(data), spark.read.parquet(index))
    assert sorted(map(tuple, seen.collect())) == [("a", 1), ("a", 2), ("b", 3), ("c", 4)]


def test_manifest_and_retention(spark):
    days = curation.day_views(
        spark.createDataFrame([("l", "d1", 1, 10), ("l", "d2", 1, 5), ("l", "d4", 1, 1)], "lane string, day string, promoted_runs bigint, promoted_rows bigint"),
        spark.createDataFrame([("l", "d1", 0, 0, "sequence"), ("l", "d2", 1, 0, "checksum"), ("l", "d3", 0, 1, None)], "lane string, day string, unreplayable_runs bigint, missing_summaries bigint, gap_detection string"),
        ["lane", "day"], F.lit("d4"))
    got = {r.day: (r.readiness, r.notes) for r in days.collect()}
    assert got["d1"] == ("ready", []) and got["d2"][0] == "ready_with_quarantine" and got["d3"] == ("missing", ["missing_replay_summaries", "no_promoted_runs"]) and got["d4"][0] == "building"
    lane = curation.lane_views(days).first()
    assert (lane.gap_detection, lane.latest_ready_day, lane.curated_rows) == ("checksum", "d2", 16)
    runs = spark.createDataFrame([(f"{x}{i}", x, at(-86400 * 30 + i)) for x in "ab" for i in range(4)], "run_path string, lane string, started_at timestamp")
    policy = spark.createDataFrame([("a", 1, 7, "indexed"), ("b", 2, 7, "age_only")], "lane string, lane_rank int, min_age_days int, gate string")
    index = spark.createDataFrame([("a0",), ("a1",)], "run_path string")
    plan = curation.offload_plan(runs, index, index.limit(0), policy, F.lit(T0), 3)
    state = {r.run_path: r.state for r in plan.collect()}
    assert [state[f"a{i}"] for i in range(4)] == ["move", "move", "stuck", "stuck"] and [state[f"b{i}"] for i in range(4)] == ["move", "wait", "wait", "wait"]
    stuck = curation.stuck_by_lane(plan, n=1).first()
    assert (stuck.lane, stuck.stuck, stuck.examples) == ("a", 2, ["a2"])


def test_quotes_and_texts(spark):
    rows = [("A", "1", 0), ("A", "1", 1), ("B", "9", 2), ("A", "2", 3), ("B", "9", 4)]
    q = spark.createDataFrame([(s, i, at(t)) for s, i, t in rows], "symbol string, quote_id string, sampled_at timestamp")
    states = quotes.quote_states(q, ["sampled_at"], stale_seconds=0.5)
    s = quotes.quote_summary(states, ["sampled_at"]).first()
    assert (s.quote_count, s.side_symbol_count, s.first_observed_quote_count, s.quote_update_count, s.repeated_quote_count, s.stale_quote_count) == (5, 2, 2, 1, 2, 2)
    item = {"ticker": "T", "status": "active", "yes_bid": 45, "yes_ask": 50, "no_ask": 0, "close_time": "2026-04-06T01:00:00Z"}
    m = quotes.market_candidates(spark.createDataFrame([(json.dumps(item), T0)], "item string, sampled_at timestamp"), F.lit(T0))
    assert m.first().seconds_to_close == 3600 and quotes.open_markets(m).count() == 1
    row = quotes.quote_rows(m).collect()
    assert len(row) == 1 and (row[0].symbol, row[0].ask, row[0].payout_ratio) == ("T:YES", 0.5, 1.0)
    polls = spark.createDataFrame([("f", "1", "x", 0), ("f", "1", "x", 1), ("f", "1", "y", 2), ("f", "1", "x", 3), ("f", None, "z", 4)], "feed string, source_id string, content_hash string, poll bigint")
    got = {r.poll: (r.row_type, r.content_hash) for r in quotes.new_or_edit(polls, ["feed", "source_id"], ["poll"]).collect()}
    assert got == {0: ("new", "x"), 2: ("edit", "y"), 3: ("edit", "x"), 4: ("new", None)}


def test_health(spark):
    runs = spark.createDataFrame([("l", f"r{i}", 100, 10, 90, True, at(0)) for i in range(3)] + [("m", "r0", 0, 30, 10, False, at(-9999))], "lane string, run_id string, raw_events bigint, clean_events bigint, quarantined_events bigint, replayable boolean, scored_at timestamp")
    got = {r.lane: r for r in health.lane_quality(runs, F.lit(T0)).collect()}
    assert got["l"].findings == ["low_clean_ratio"] and got["m"].findings == ["latest_run_unreplayable", "verdict_too_old"] and got["m"].clean_ratio == 0.75
    r = health.quarantine_ratio(runs.withColumn("subscribe_replay", F.lit(0)), ["lane"]).collect()
    assert {x.lane: x.flagged for x in r} == {"l": True, "m": True}


def test_as_of_and_bridge(spark):
    left = spark.createDataFrame([("k", 1, "a"), ("k", 5, "b"), ("k", 0, "c")], "k string, t bigint, x string")
    right = spark.createDataFrame([("k", 1, 10), ("k", 4, 40)], "k string, t bigint, v bigint")
    assert {r.x: r.v for r in book.as_of(left, right, ["k"], "t", ["v"]).collect()} == {"a": 10, "b": 40, "c": None}
    buffered = spark.createDataFrame([("a", 0, 90, 99), ("a", 1, 100, 105), ("b", 0, 120, 130), ("c", 0, 1, 2)], "run_id string, ord bigint, first_update_id bigint, final_update_id bigint")
    anchors = spark.createDataFrame([("a", 100), ("b", 100), ("c", 100)], "run_id string, snapshot_last_update_id bigint")
    assert {k: (r.kept, r.bridges) for k, r in by_run(book.bridges(buffered, anchors, ["run_id"], ["ord"])).items()} == {"a": (1, True), "b": (1, False), "c": (0, None)}


def test_snapshot_and_polled_frames(spark):
    snaps = spark.createDataFrame([("r", "binance", "BTCUSDT", T0, (7, [["1", "2"], ["x", "1"]], [["3", "4"]]))], "run_id string, " + schemas.SNAPSHOT)
    row = normalizers.snapshot_rows(snaps).first()
    assert (row.ord, row.event_type, row.first_update_id, row.final_update_id, row.event_time) == (0, "snapshot", 7, 7, None)
    assert [tuple(x) for x in row.bids] == [(1, 2)] and [tuple(x) for x in row.asks] == [(3, 4)]
    trades = frames(spark, "binance-futures", {"a": 5, "p": "1", "q": "2", "T": 1000, "m": False}).withColumn("symbol", F.lit("BTCUSDT"))
    got = normalizers.binance_trades(normalizers.remap_rest(trades, "trades"), "perp").first()
    assert (got.sequence, got.event_type, got.metadata.canonical_symbol) == (5, "aggTrade", "BTC/USDT-PERP")
    page = frames(spark, "binance-futures", {"lastUpdateId": 9, "T": 1000, "bids": [["1", "2"]], "asks": []}).withColumn("symbol", F.lit("BTCUSDT"))
    got = normalizers.binance_depth(normalizers.remap_rest(page, "depth"), "perp").first()
    assert (got.first_update_id, got.final_update_id, got.event_time) == (None, 9, dt.datetime(1970, 1, 1, 0, 0, 1)) and [tuple(x) for x in got.bids] == [(1, 2)]


def test_checksum_runs(spark, depth_schema):
    rows = [depth("good", 0, None, None, [(100, 1)], [(101, 2)], event="snapshot"), depth("good", 1, None, None, [(99, 3)]), depth("bad", 0, None, None, [(100, 1)], [(101, 2)], event="snapshot"), depth("bare", 0, None, None, [(100, 1)], event="snapshot")]
    u = book.sub_books(frame(spark, rows, depth_schema), ["run_id"], ["ord"])
    states = book.fold(u, ["run_id"], "ord", depth=verdicts.CHECKSUM_DEPTH)
    own = book.book_crc(F.col("top_bids"), F.col("top_asks"), *verdicts.CHECKSUM_DECIMALS["BTC/USD"])
    said = states.withColumn("said", F.when(F.col("run_id") == "good", own).when(F.col("run_id") == "bad", own + 1))
    got = by_run(verdicts.depth_stream(u, ["run_id"], ["ord"], checksums=book.checksum_counts(said, ["run_id"], "said", 1, 8)))
    assert {k: (r.replayable, r.findings, r.gap_detection) for k, r in got.items()} == {"good": (True, [], "checksum"), "bad": (False, ["checksum_mismatch"], "checksum"), "bare": (False, ["missing_checksum"], "checksum")}


def test_stream_modes_and_full_books(spark, depth_schema):
    rows = [depth("k", 0, 1, 1, source="kraken", product="BTC/USD"), depth("k", 1, 1, 1, source="kraken", product="ETH/USD"), depth("e", 0, 1, 1, source="kraken", product="ETH/USD"), depth("y", 0, 1, 1, source="bybit_perp"), depth("o", 0, 1, 1, source="okx"), depth("m", 0, 1, 1, [(5, 1), (6, 0)], [(7, 1)], source="mexc")]
    df = frame(spark, rows, depth_schema)
    assert {k: r.stream_mode for k, r in by_run(verdicts.stream_mode(df, ["run_id"], ["ord"])).items()} == {"k": "checksum", "e": "structural", "y": "dense", "o": "chain", "m": "structural"}
    best = by_run(book.snapshot_states(df))["m"]
    assert (best.best_bid, best.best_ask) == (5, 7)


def test_api_rows_and_items(spark):
    r = quotes.api_errors(spark.createDataFrame([(True, 200), (False, 429), (None, 500)], "success boolean, http_status int")).collect()
    assert [(x.event_type, x.rate_limited) for x in r] == [("api_error", True), ("api_error", False)]
    import hashlib

    items = spark.createDataFrame([("rss", "1", "t", None, "s", None, None), ("posts", "2", "t", None, None, "body", None), ("comments", None, None, None, None, None, "b")], "kind string, source_id string, title string, link string, summary string, selftext string, body string")
    got = [x.content_hash for x in quotes.item_payloads(items).collect()]
    sha = lambda *f: hashlib.sha256(json.dumps(f, separators=(",", ":")).encode()).hexdigest()
    assert got == [sha("t", "", "s"), sha("t", "body"), None]
    assert gates.text_gate(normalizers.text_items(frames(spark, "rss", {"row_type": "x"}))).first().reasons == ["missing_source_id", "missing_content_hash", "missing_raw_item", "unknown_event_type"]


def test_reports_over_time(spark):
    log = spark.createDataFrame([("a", "f", "ok", 600, 900, at(-9000)), ("b", "f", "failed", 600, 900, at(-60)), ("b", "f", "failed", 600, 900, at(-30)), ("a", "g", "failed", 1, 1, at(-10))], "job string, family string, status string, interval_seconds int, segment_seconds int, finished_at timestamp")
    # the latest row of job a finished 10 s ago and promises one every second
    assert {r.job: r.stale for r in health.job_freshness(log, F.lit(T0)).collect()} == {"a": True, "b": False}
    assert [(r.family, r.failures) for r in health.recent_failures(log, F.lit(T0)).collect()] == [("f", 2)]
    files = spark.createDataFrame([("d", "s", "x.parquet", at(1)), ("d", "s", "y.parquet", at(5)), ("d", "s", "z.txt", at(9))], "dataset string, source string, file string, modified timestamp")
    assert health.partition_freshness(files, ["dataset", "source"]).first().latest == at(5)
    counts = spark.createDataFrame([("l", 1, 5), ("l", 2, 12), ("l", 3, 12)], "lane string, reported_at int, stuck int")
    assert [r.alert for r in curation.growth_alert(counts, 10).orderBy("reported_at").collect()] == [False, True, False]
    src = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "file string, bytes bigint")
    dst = spark.createDataFrame([("a", 1), ("b", 5), ("z", 1)], "file string, bytes bigint")
    assert {r.file: r.problem for r in curation.copy_differences(src, dst).collect()} == {"b": "size", "c": "missing", "z": "extra"}
    assert curation.empty_parquet(spark.createDataFrame([("a.parquet", 0), ("b.parquet", 1), ("c.txt", 0)], "file string, bytes bigint")).count() == 1


def test_content_hash_equals_plain_json(spark):
    """Control characters, quotes and backslashes, also a backslash before what looks like an escape."""
    import hashlib
    import json

    from tidemark.functions import scalars

    texts = ["plain", "".join(map(chr, range(32))), "\x1b\x1b[0m \x0b", '"\\u001B" \\\x1f \\\\u000E', "é日本", "\x7f"]
    rows = spark.createDataFrame([(t, None) for t in texts], "a string, b string").select("a", scalars.content_hash(F.col("a"), F.col("b")).alias("h")).collect()
    for r in rows:
        assert r.h == hashlib.sha256(json.dumps([r.a, ""], separators=(",", ":"), ensure_ascii=False).encode()).hexdigest(), r.a


def test_runs_without_events(spark, trade_schema, depth_schema):
    """A run that has no events at all is scored, and not replayable."""
    runs = spark.createDataFrame([("empty",)], "run string")
    trades = spark.createDataFrame([], trade_schema).withColumn("run", F.lit("x")).withColumn("n", F.lit(1))
    updates = spark.createDataFrame([], depth_schema).withColumn("run", F.lit("x")).withColumn("n", F.lit(1)).withColumn("update_id", F.lit(1))
    anchors = spark.createDataFrame([("empty", 5)], "run string, snapshot_last_update_id bigint")
    made = {
        "trades": verdicts.trades(trades, ["run"], ["n"], runs=runs), "timed": verdicts.trades_stream(trades, ["run"], ["n"], runs=runs), "funding": verdicts.funding(trades, ["run"], ["n"], runs=runs),
        "depth": verdicts.depth(updates, ["run"], ["n"], anchors, runs=runs), "stream": verdicts.depth_stream(updates, ["run"], ["n"], "dense", runs=runs), "plain": verdicts.depth_stream(updates, ["run"], ["n"], runs=runs),
    }
    for name, out in made.items():
        row = out.collect()[0]
        assert (row.run, row.event_count, row.replayable) == ("empty", 0, False), name
        assert row.findings == (["no_events", "no_snapshot_anchor"] if name in ("stream", "plain") else ["no_events"]), name


def test_a_claimed_time_is_a_number(spark):
    """A JSON number is a claim in epoch seconds; text that looks like one is not."""
    rows = [(1, '{"created_utc": 1700000000.5}'), (2, '{"created_utc": "1700000000"}'), (3, '{"created_utc": null, "source_ts_raw": "soon"}'), (4, "torn")]
    frames = spark.createDataFrame(rows, "k int, payload string").withColumns({"source": F.lit("s"), "received_at": F.lit("2026-01-01").cast("timestamp")})
    got = {r.k: (r.source_ts and r.source_ts.replace(tzinfo=None), r.metadata.source_ts_unparseable) for r in normalizers.text_items(frames).collect()}
    assert got == {1: (dt.datetime(2023, 11, 14, 22, 13, 20, 500000), False), 2: (None, False), 3: (None, True), 4: (None, False)}


def test_instruments_by_constants_equal_those_by_joins(spark):
    symbols = ["BTCUSDT", "btc-perpetual", "ETH_PERP", "SOL-USDT", "ABC-PERPETUAL", "XRP/USDTPERP", "DOGEUSD", "BTC/USD", " xbtusd ", "USDTUSD", "", "ETHBTC", "BITCOINUSD", "USD COINUSDT", "EURUSD", "BTCUSDTETH"]
    df = spark.createDataFrame([(s, v) for s in symbols for v in ("Binance_Futures", "deribit", " OKX ", "binance-futures")], "symbol string, source string")
    for kind in ("spot", "perp", None):
        got = {(r.symbol, r.source): r.instrument for r in instruments.with_instrument(df, kind).collect()}
        assert got == {(r.symbol, r.venue): r.instrument for r in instruments.resolve(df.withColumnRenamed("source", "venue"), kind).collect()}
        assert None in got.values() and len(set(map(str, got.values()))) > 20

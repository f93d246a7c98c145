"""Queries of the venue normalizers: events as the JSON frames that each venue sends, read back by its normalizer.

Every event k makes a frame; prices are its value in whole cents, sizes are quarters. Fixed shares of the frames lack a field, hold one
that cannot be read, or name an instrument that is not known.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gates, normalizers
from .inputs import table

_C = F.col


def _k() -> Column:
    return _C("k")


def _id() -> Column:
    return _k().cast("string")


def _one_of(*values: str, by: Column | None = None) -> Column:
    """One of the values, by the user or another number."""
    return F.get(F.array(*map(F.lit, values)), ((_C("user_id") if by is None else by) % len(values)).cast("int"))


def _when(cond: Column, value: Column) -> Column:
    """Absent (JSON has no such key) unless the condition holds."""
    return F.when(cond, value)


def _fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, times, and px (cents as text; unreadable for every tenth) and sz (quarters as text)."""
    e = table(spark, sf_dir, "events")
    cents = F.floor(_C("value") * 100).cast("bigint")
    text = F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    k = _C("event_id")
    ms = F.unix_millis(_C("ts").cast("timestamp"))
    return e.select(k.alias("k"), "user_id", ms.alias("ms"), text.alias("good"), F.when(k % 10 == 0, "n/a").otherwise(text).alias("px"), ((k % 9 + 1) / 4).cast("string").alias("sz"), F.date_format(_C("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"))


def _frames(df: DataFrame, source: str, body: Column) -> DataFrame:
    return df.select(F.lit(source).alias("source"), F.timestamp_millis("ms").alias("received_at"), body.alias("payload"), "k")


def _wrapped(body: Column) -> Column:
    """Every second frame stands in a `data` envelope."""
    return F.when(_k() % 2 == 0, F.to_json(F.struct(F.lit("s").alias("stream"), body.alias("data")))).otherwise(F.to_json(body))


def _trade_row(df: DataFrame, *more: Column) -> DataFrame:
    m = lambda c: _C(f"metadata.{c}").alias(c)
    return df.select("k", *more, "product", "event_type", F.unix_millis("exchange_time").alias("at"), "side", "price", "size", "trade_id", "sequence", m("instrument_id"), m("buyer_is_maker"), m("subscribe_replay"), F.array_join("metadata.parse_errors", ",").alias("errors"))


def binance_trade_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades and aggregated trades, in and out of an envelope."""
    body = F.struct(_when(_k() % 7 != 0, F.lit("aggTrade")).alias("e"), _C("ms").alias("E"), _when(_k() % 5 != 0, _C("ms") - 3).alias("T"), _one_of("BTCUSDT", "ETHUSDC", "FOOBAR").alias("s"), _when(_k() % 4 != 0, _k()).alias("t"), (_k() + 1).alias("a"), _C("px").alias("p"), _C("sz").alias("q"), _when(_k() % 3 != 2, _k() % 3 == 0).alias("m"))
    return _trade_row(normalizers.binance_trades(_frames(_fields(spark, sf_dir), "binance", _wrapped(body))))


def binance_funding_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.struct(_one_of("BTCUSDT", "ETHUSDC", "FOOBAR").alias("symbol"), _C("ms").alias("time"), _C("px").alias("markPrice"), _C("good").alias("indexPrice"), F.when(_k() % 8 == 0, "x").otherwise("0.5").alias("lastFundingRate"), (_C("ms") + 1000).alias("nextFundingTime"))
    out = normalizers.binance_funding(_frames(_fields(spark, sf_dir), "binance-futures", _wrapped(body)))
    x = lambda c: _C("metadata.extra")[c].alias(c)
    return out.select("k", "product", "channel", F.unix_millis("exchange_time").alias("at"), "price", _C("metadata.instrument_id").alias("instrument_id"), _C("metadata.canonical_symbol").alias("canonical_symbol"), x("index_price").cast("double").alias("index_price"), x("funding_rate").cast("double").alias("funding_rate"), x("next_funding_time").cast("bigint").alias("next_funding_time"), F.array_join("metadata.parse_errors", ",").alias("errors"))


def coinbase_trade_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side named is the resting order's."""
    body = F.struct(_one_of("match", "last_match", by=_k()).alias("type"), F.when(_k() % 6 == 0, "none").otherwise(_id()).alias("trade_id"), _one_of("BTC-USD", "ETH-USDC", "FOO-BAR").alias("product_id"), _C("px").alias("price"), _C("sz").alias("size"), _when(_k() % 4 != 3, _one_of("buy", "sell", "odd", by=_k())).alias("side"), F.when(_k() % 11 == 0, "late").otherwise(_C("iso")).alias("time"), _id().alias("sequence"))
    return _trade_row(normalizers.coinbase_trades(_frames(_fields(spark, sf_dir), "coinbase", _wrapped(body))))


def _batch(item: Callable[[Column], Column], name: str = "data") -> Column:
    """One to three items a frame, numbered j."""
    return F.transform(F.sequence(F.lit(0), (_k() % 3).cast("int")), item).alias(name)


def bybit_trade_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = lambda j: F.struct((_C("ms") + j).cast("string").alias("T"), _one_of("BTCUSDT", "ETHUSDC", "FOOBAR").alias("s"), _one_of("Buy", "Sell", "None", by=_k() + j).alias("S"), _C("sz").alias("v"), _C("px").alias("p"), F.concat_ws("-", _id(), j.cast("string")).alias("i"))
    body = F.to_json(F.struct(F.lit("publicTrade").alias("topic"), _batch(item)))
    return _trade_row(normalizers.bybit_trades(_frames(_fields(spark, sf_dir), "bybit", body)), _C("pos").cast("bigint").alias("pos"))


def kraken_trade_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of a snapshot frame are replays."""
    item = lambda j: F.struct(_one_of("BTC/USD", "ETH/USDC", "FOO/BAR").alias("symbol"), _one_of("buy", "sell", "x", by=_k() + j).alias("side"), _C("px").try_cast("double").alias("price"), _C("sz").cast("double").alias("qty"), (_k() * 10 + j).alias("trade_id"), F.when(_k() % 11 == 0, "late").otherwise(_C("iso")).alias("timestamp"))
    body = F.to_json(F.struct(F.lit("trade").alias("channel"), _one_of("update", "snapshot", by=_k()).alias("type"), _batch(item)))
    return _trade_row(normalizers.kraken_trades(_frames(_fields(spark, sf_dir), "kraken", body)), _C("pos").cast("bigint").alias("pos"))


def mexc_trade_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type 1 buys, 2 sells, 0 is unknown; no ids."""
    item = lambda j: F.struct(_C("px").alias("price"), _C("sz").alias("quantity"), ((_k() + j) % 4).alias("tradeType"), (_C("ms") + j).alias("time"))
    body = F.to_json(F.struct(F.lit("deals").alias("channel"), _one_of("BTCUSDT", "ETHUSDC", "FOOBAR").alias("symbol"), F.struct(_batch(item, "deals")).alias("publicAggreDeals")))
    return _trade_row(normalizers.mexc_trades(_frames(_fields(spark, sf_dir), "mexc", body)), _C("pos").cast("bigint").alias("pos"))


def okx_perp_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Swaps: the instrument is a perpetual, the id no sequence."""
    item = lambda j: F.struct(_one_of("BTC-USDT-SWAP", "ETH-USDC-SWAP", "FOO-BAR-SWAP").alias("instId"), F.concat_ws("-", _id(), j.cast("string")).alias("tradeId"), _C("px").alias("px"), _C("sz").alias("sz"), _one_of("buy", "sell", by=_k() + j).alias("side"), (_C("ms") + j).cast("string").alias("ts"))
    return _trade_row(normalizers.okx_trades(_frames(_fields(spark, sf_dir), "okx", F.to_json(F.struct(_batch(item)))), "perp"), _C("pos").cast("bigint").alias("pos"))


def _pairs(*levels: tuple[Column, Column], keys: tuple[str, str] | None = None) -> Column:
    return F.array(*(F.struct(p.alias(keys[0]), s.alias(keys[1])) if keys else F.array(p, s) for p, s in levels))


def _sides(keys: tuple[str, str] | None = None) -> tuple[Column, Column]:
    """Two bids, of which every tenth frame's first cannot be read; one ask, of size 0 for every seventh."""
    return _pairs((_C("px"), _C("sz")), (F.lit("1.25"), F.lit("2")), keys=keys), _pairs((_C("good"), F.when(_k() % 7 == 0, "0").otherwise(_C("sz"))), keys=keys)


def _depth_row(df: DataFrame, *more: Column) -> DataFrame:
    side = lambda c: [F.size(c).cast("bigint").alias(f"n_{c}"), F.get(c, 0)["price"].alias(f"{c}_price"), F.get(c, 0)["size"].alias(f"{c}_size")]
    return df.select("k", "product", "event_type", F.unix_millis("event_time").alias("at"), "first_update_id", "final_update_id", *side("bids"), *side("asks"), _C("instrument.instrument_id").alias("instrument_id"), F.array_join("metadata.parse_errors", ",").alias("errors"), *more)


def binance_depth_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    bids, asks = _sides()
    body = F.struct(F.lit("depthUpdate").alias("e"), _C("ms").alias("E"), _one_of("BTCUSDT", "ETHUSDC", "FOOBAR").alias("s"), _when(_k() % 5 != 0, _k()).alias("U"), (_k() + 2).alias("u"), bids.alias("b"), asks.alias("a"))
    return _depth_row(normalizers.binance_depth(_frames(_fields(spark, sf_dir), "binance", _wrapped(body))))


def coinbase_depth_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots hold both sides, differences name the side of each change; every tenth change cannot be read."""
    bids, asks = _sides()
    changes = F.array(F.array(F.lit("buy"), _C("px"), _C("sz")), F.array(F.lit("sell"), _C("good"), F.lit("0")))
    snap = _k() % 4 == 0
    body = F.struct(F.when(snap, "snapshot").otherwise("l2update").alias("type"), _one_of("BTC-USD", "ETH-USDC", "FOO-BAR").alias("product_id"), _when(~snap, _C("iso")).alias("time"), _when(snap, bids).alias("bids"), _when(snap, asks).alias("asks"), _when(~snap, changes).alias("changes"))
    return _depth_row(normalizers.coinbase_depth(_frames(_fields(spark, sf_dir), "coinbase", _wrapped(body))))


def bybit_depth_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    bids, asks = _sides()
    body = F.struct(_one_of("snapshot", "delta", by=_k()).alias("type"), _C("ms").alias("ts"), _when(_k() % 5 != 0, _C("ms") - 1).alias("cts"), F.struct(_one_of("BTCUSDT", "ETHUSDC", "FOOBAR").alias("s"), bids.alias("b"), asks.alias("a"), F.when(_k() % 9 == 0, "x").otherwise(_id()).alias("u"), (_k() * 2).alias("seq")).alias("data"))
    m = _C("metadata")
    return _depth_row(normalizers.bybit_depth(_frames(_fields(spark, sf_dir), "bybit", F.to_json(body)), "perp"), m["bybit_update_id"].alias("update_id"), m["bybit_cross_sequence"].alias("cross_sequence"))


def kraken_depth_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    bids, asks = _sides(("price", "qty"))
    item = F.struct(_one_of("BTC/USD", "ETH/USDC", "FOO/BAR").alias("symbol"), bids.alias("bids"), asks.alias("asks"), _when(_k() % 6 != 0, _k() + 7).alias("checksum"), _C("iso").alias("timestamp"))
    body = F.to_json(F.struct(F.lit("book").alias("channel"), _one_of("snapshot", "update", by=_k()).alias("type"), F.array(item).alias("data")))
    return _depth_row(normalizers.kraken_depth(_frames(_fields(spark, sf_dir), "kraken", body)), _C("metadata.kraken_checksum").alias("checksum"))


def mexc_depth_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full books; every eighth frame has no body."""
    bids, asks = _sides(("price", "quantity"))
    book = F.struct(bids.alias("bids"), asks.alias("asks"), _id().alias("version"))
    body = F.to_json(F.struct(_one_of("BTCUSDT", "ETHUSDC", "FOOBAR").alias("symbol"), F.lit("book").alias("channel"), _when(_k() % 5 != 0, _C("ms")).alias("sendTime"), (_C("ms") - 5).alias("createTime"), _when(_k() % 8 != 0, book).alias("publicLimitDepths")))
    return _depth_row(normalizers.mexc_depth(_frames(_fields(spark, sf_dir), "mexc", body)), _C("metadata.mexc_version").alias("version"))


def okx_depth_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels have four fields, of which two count; linked ids."""
    four = lambda levels: F.transform(levels, lambda x: F.concat(x, F.array(F.lit("0"), F.lit("1"))))
    bids, asks = _sides()
    item = F.struct(four(bids).alias("bids"), four(asks).alias("asks"), _C("ms").cast("string").alias("ts"), (_k() + 9).alias("checksum"), _k().alias("seqId"), (_k() - 1).alias("prevSeqId"))
    body = F.to_json(F.struct(F.struct(F.lit("books").alias("channel"), _one_of("BTC-USDT", "ETH-USDC", "FOO-BAR").alias("instId")).alias("arg"), _one_of("snapshot", "update", by=_k()).alias("action"), F.array(item).alias("data")))
    m = _C("metadata")
    return _depth_row(normalizers.okx_depth(_frames(_fields(spark, sf_dir), "okx", body)), m["okx_seq_id"].alias("seq_id"), m["okx_prev_seq_id"].alias("prev_seq_id"), m["okx_checksum"].alias("checksum"))


def polled_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polled pages take the shape of stream frames, and go through the same normalizers."""
    own = _fields(spark, sf_dir).withColumn("symbol", _one_of("BTCUSDT", "ETHUSDC", "FOOBAR"))
    part = lambda body: own.select(F.lit("binance-futures").alias("source"), F.timestamp_millis("ms").alias("received_at"), F.to_json(body).alias("payload"), "k", "symbol")
    trades = part(F.struct(_k().alias("a"), _C("px").alias("p"), _C("sz").alias("q"), _C("ms").alias("T"), (_k() % 2 == 0).cast("string").alias("m")))
    bids, asks = _sides()
    books = part(F.struct(_k().alias("lastUpdateId"), _when(_k() % 2 == 0, _C("ms")).alias("E"), (_C("ms") - 2).alias("T"), bids.alias("bids"), asks.alias("asks")))
    a = normalizers.binance_trades(normalizers.remap_rest(trades, "trades"), "perp").select("k", F.lit("trades").alias("kind"), "product", "event_type", F.unix_millis("exchange_time").alias("at"), "price", _C("sequence").alias("id"), F.lit(None).cast("bigint").alias("first_id"), _C("metadata.instrument_id").alias("instrument_id"))
    b = normalizers.binance_depth(normalizers.remap_rest(books, "depth"), "perp").select("k", F.lit("depth").alias("kind"), "product", "event_type", F.unix_millis("event_time").alias("at"), F.get("asks", 0)["price"].alias("price"), _C("final_update_id").alias("id"), _C("first_update_id").alias("first_id"), _C("instrument.instrument_id").alias("instrument_id"))
    return a.unionByName(b)


def snapshot_ahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's anchor book as the row ahead of the user's updates: two first rows of each run."""
    e = _fields(spark, sf_dir)
    first = e.groupBy("user_id").agg(F.min("k").alias("k0"), F.min_by("good", "k").alias("good"))
    book = lambda *pairs: F.array(*(F.array(p, s) for p, s in pairs))
    snaps = first.select("user_id", F.lit("binance").alias("source"), F.lit("P").alias("product"), F.struct(_C("k0").alias("lastUpdateId"), book((_C("good"), F.lit("2")), (F.lit("x"), F.lit("1"))).alias("bids"), book((F.lit("9999"), F.lit("1.5"))).alias("asks")).alias("snapshot"))
    rows = normalizers.snapshot_rows(snaps)
    own = e.select("user_id", (_k() + 1).alias("ord"), F.lit("depthUpdate").alias("event_type"), _k().alias("first_update_id"), _k().alias("final_update_id"))
    both = rows.select("user_id", "ord", "event_type", "first_update_id", "final_update_id", F.size("bids").cast("bigint").alias("n_bids"), F.get("bids", 0)["price"].alias("bid"), F.get("asks", 0)["size"].alias("ask_size")).unionByName(own, allowMissingColumns=True)
    from pyspark.sql import Window

    return both.withColumn("n", F.row_number().over(Window.partitionBy("user_id").orderBy("ord"))).where("n <= 2").drop("n")


_STYLES = ("binance", "coinbase", "bybit", "kraken", "mexc", "okx")


def frame_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data, acknowledgement, error and other frames in six venues' styles, and which of them the data filter keeps."""
    e = _fields(spark, sf_dir).withColumn("style", _one_of(*_STYLES)).withColumn("c", _k() % 4)
    lit = F.lit
    js = lambda *cols: F.to_json(F.struct(*cols))
    data = {"binance": js(lit("trade").alias("e")), "coinbase": js(lit("match").alias("type")), "bybit": js(lit("t").alias("topic")), "kraken": js(lit("trade").alias("channel"), F.array(lit(1)).alias("data")), "mexc": js(lit("c").alias("channel"), F.struct(lit(1).alias("deals")).alias("publicAggreDeals")), "okx": js(F.struct(lit("b").alias("channel")).alias("arg"), F.array(lit(1)).alias("data"))}
    ack = {"binance": lit('{"result":null,"id":1}'), "coinbase": js(lit("subscriptions").alias("type")), "bybit": js(lit("subscribe").alias("op"), lit(True).alias("success")), "kraken": js(lit("subscribe").alias("method"), lit(True).alias("success")), "mexc": js(lit(0).alias("code"), lit("ok").alias("msg")), "okx": js(lit("subscribe").alias("event"))}
    error = {"binance": js(F.struct(lit(2).alias("code")).alias("error")), "coinbase": js(lit("error").alias("type")), "bybit": js(lit("subscribe").alias("op"), lit(False).alias("success")), "kraken": js(lit("subscribe").alias("method"), lit(False).alias("success")), "mexc": js(lit(5).alias("code")), "okx": js(lit("error").alias("event"))}
    out = None
    for s in _STYLES:
        own = e.where(_C("style") == s).withColumn("payload", F.when(_C("c") == 0, data[s]).when(_C("c") == 1, ack[s]).when(_C("c") == 2, error[s]).otherwise("[1]"))
        kept = gates.data_frames(own, s).select("k", lit(True).alias("kept"))
        part = own.withColumn("kind", gates.frame_kind(_C("payload"), s)).join(kept, "k", "left").groupBy("style", "kind").agg(F.count("*").alias("frames"), F.count("kept").alias("kept"))
        out = part if out is None else out.unionByName(part)
    return out


def text_poll_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as polled items, the text the raw item: envelopes, claims and the envelope gate."""
    d = table(spark, sf_dir, "documents")
    k = _C("doc_id")
    body = F.to_json(F.struct(_when(k % 3 != 0, _C("source")).alias("feed"), _when(k % 3 == 0, F.lit("sub")).alias("subreddit"), _when(k % 8 != 0, k.cast("string")).alias("source_id"), _when(k % 9 != 0, F.sha2("text", 256)).alias("content_hash"), _when(k % 10 != 0, _C("text")).alias("raw_item"), F.get(F.array(*map(F.lit, ("new", "edit", "odd"))), (k % 3).cast("int")).alias("row_type"), _when(k % 4 == 0, 1_700_000_000 + k).alias("created_utc"), _when(k % 4 == 1, F.lit("Mon, 06 Apr 2026 10:00:00 GMT")).alias("source_ts_raw")))
    odd = F.when(k % 4 == 2, F.regexp_replace(body, r"\}$", ',"created_utc":"1700000000"}')).when(k % 4 == 3, F.regexp_replace(body, r"\}$", ',"source_ts_raw":"soon"}')).otherwise(body)
    frames = d.select(k.alias("k"), F.lit("texts").alias("source"), F.timestamp_seconds(1_700_000_000 + k).alias("received_at"), odd.alias("payload"))
    out = gates.text_gate(normalizers.text_items(frames))
    return out.select("k", "product", "event_type", "source_id", "content_hash", F.sha2("raw_item", 256).alias("raw_sha256"), F.unix_seconds("source_ts").alias("claimed"), _C("metadata.source_ts_unparseable").alias("unparseable"), F.array_join("reasons", ",").alias("reasons"), "accepted")


QUERIES = {f.__name__: f for f in (binance_trade_frames, binance_funding_frames, coinbase_trade_frames, bybit_trade_frames, kraken_trade_frames, mexc_trade_frames, okx_perp_frames, binance_depth_frames, coinbase_depth_frames, bybit_depth_frames, kraken_depth_frames, mexc_depth_frames, okx_depth_frames, polled_frames, snapshot_ahead, frame_kinds, text_poll_gate)}

_BASE = """with x as (select event_id as k, user_id, epoch_us(ts) // 1000 as ms, epoch_ms(date_trunc('second', ts)) as s_ms, cast(floor(value * 100) as bigint) / 100.0 as good, case when event_id % 10 <> 0 then cast(floor(value * 100) as bigint) / 100.0 end as px, (event_id % 9 + 1) / 4.0 as sz, event_id % 10 = 0 as bad, user_id % 3 as u from events)"""
_PLAIN, _DASH, _SLASH = "(['BTCUSDT','ETHUSDC','FOOBAR'])[u + 1]", "(['BTC-USD','ETH-USDC','FOO-BAR'])[u + 1]", "(['BTC/USD','ETH/USDC','FOO/BAR'])[u + 1]"


def _instrument(prefix: str, names: str) -> str:
    return f"case when u < 2 then '{prefix}:' || ({names})[u + 1] end"


_SIDE = "case (k + pos) % {n} when {buy} then 'buy' when {sell} then 'sell' end"
_BATCHED = _BASE + ", b as (select *, unnest(range(k % 3 + 1)) as pos from x)"
_ERR = lambda *pairs: "concat_ws(',', " + ", ".join(f"case when {c} then '{n}' end" for c, n in pairs) + ")"
_BAD_PRICE = ("bad", "invalid_price")


def _trade_sql(base: str, source: str, product: str, kind: str, at: str, side: str, trade_id: str, sequence: str, instrument: str, maker: str, replay: str, errors: str, pos: str = "", price: str = "px") -> str:
    return f"{base} select k, {pos} {product} as product, {kind} as event_type, {at} as at, {side} as side, {price} as price, sz as size, {trade_id} as trade_id, {sequence} as sequence, {instrument} as instrument_id, {maker} as buyer_is_maker, {replay} as subscribe_replay, {errors} as errors from {source}"


_NONE, _NULL_ID, _FALSE = "cast(null as varchar)", "cast(null as bigint)", "cast(null as boolean)"


def _depth_sql(product: str, kind: str, at: str, first: str, final: str, instrument: str, errors: str = "case when bad then 'invalid_bids' else '' end", more: str = "", there: str = "true") -> str:
    return f"""{_BASE} select k, {product} as product, {kind} as event_type, {at} as at, {first} as first_update_id, {final} as final_update_id,
 case when not ({there}) then 0 when bad then 1 else 2 end as n_bids, case when {there} then coalesce(px, 1.25) end as bids_price, case when not ({there}) then null when bad then 2.0 else sz end as bids_size,
 case when {there} then 1 else 0 end as n_asks, case when {there} then good end as asks_price, case when not ({there}) then null when k % 7 = 0 then 0.0 else sz end as asks_size, {instrument} as instrument_id, {errors} as errors {more} from x"""


ORACLES = {
    "binance_trade_frames": _trade_sql(_BASE, "x", _PLAIN, "case when k % 7 <> 0 then 'aggTrade' else 'trade' end", "case when k % 5 <> 0 then ms - 3 else ms end", "case k % 3 when 0 then 'sell' when 1 then 'buy' end", "cast(case when k % 4 <> 0 then k else k + 1 end as varchar)", "case when k % 4 <> 0 then k else k + 1 end", _instrument("spot:binance", "['BTCUSDT','ETHUSDC']"), "case k % 3 when 0 then true when 1 then false end", _FALSE, _ERR(_BAD_PRICE)),
    "binance_funding_frames": f"""{_BASE} select k, {_PLAIN} as product, 'funding' as channel, ms as at, px as price, {_instrument("perp:binance-futures", "['BTCUSDT','ETHUSDC']")} as instrument_id, (['BTC/USDT-PERP','ETH/USDC-PERP'])[u + 1] as canonical_symbol,
 good as index_price, case when k % 8 <> 0 then 0.5 end as funding_rate, ms + 1000 as next_funding_time, {_ERR(("bad", "invalid_mark_price"), ("k % 8 = 0", "invalid_funding_rate"))} as errors from x""",
    "coinbase_trade_frames": _trade_sql(_BASE, "x", _DASH, "case when k % 2 = 0 then 'match' else 'last_match' end", "case when k % 11 <> 0 then s_ms end", "case when k % 4 <> 3 then case k % 3 when 0 then 'sell' when 1 then 'buy' end end", "case when k % 6 <> 0 then cast(k as varchar) end", "case when k % 6 <> 0 then k end", _instrument("spot:coinbase", "['BTCUSD','ETHUSDC']"), "case when k % 4 <> 3 then case k % 3 when 0 then true when 1 then false end end", "case when k % 2 = 1 then true end", _ERR(("k % 11 = 0", "invalid_event_time"), ("k % 6 = 0", "invalid_trade_id"), _BAD_PRICE)),
    "bybit_trade_frames": _trade_sql(_BATCHED, "b", _PLAIN, "'trade'", "ms + pos", _SIDE.format(n=3, buy=0, sell=1), "k || '-' || pos", _NULL_ID, _instrument("spot:bybit", "['BTCUSDT','ETHUSDC']"), "case (k + pos) % 3 when 0 then false when 1 then true end", _FALSE, _ERR(("(k + pos) % 3 = 2", "invalid_side"), _BAD_PRICE), "pos,"),
    "kraken_trade_frames": _trade_sql(_BATCHED, "b", _SLASH, "'trade'", "case when k % 11 <> 0 then s_ms end", _SIDE.format(n=3, buy=0, sell=1), "cast(k * 10 + pos as varchar)", "k * 10 + pos", _instrument("spot:kraken", "['BTCUSD','ETHUSDC']"), "case (k + pos) % 3 when 0 then false when 1 then true end", "case when k % 2 = 1 then true end", _ERR(("k % 11 = 0", "invalid_event_time"), ("(k + pos) % 3 = 2", "invalid_side")), "pos,"),
    "mexc_trade_frames": _trade_sql(_BATCHED, "b", _PLAIN, "'trade'", "ms + pos", _SIDE.format(n=4, buy=1, sell=2), _NONE, _NULL_ID, _instrument("spot:mexc", "['BTCUSDT','ETHUSDC']"), "case (k + pos) % 4 when 1 then false when 2 then true end", _FALSE, _ERR(("(k + pos) % 4 = 3", "invalid_side"), _BAD_PRICE), "pos,"),
    "okx_perp_frames": _trade_sql(_BATCHED, "b", "(['BTC-USDT-SWAP','ETH-USDC-SWAP','FOO-BAR-SWAP'])[u + 1]", "'trade'", "ms + pos", _SIDE.format(n=2, buy=0, sell=1), "k || '-' || pos", _NULL_ID, _instrument("perp:okx", "['BTCUSDT','ETHUSDC']"), "(k + pos) % 2 = 1", _FALSE, _ERR(_BAD_PRICE), "pos,"),
    "binance_depth_frames": _depth_sql(_PLAIN, "'depthUpdate'", "ms", "case when k % 5 <> 0 then k end", "k + 2", _instrument("spot:binance", "['BTCUSDT','ETHUSDC']")),
    "coinbase_depth_frames": f"""{_BASE} select k, {_DASH} as product, case when k % 4 = 0 then 'snapshot' else 'l2update' end as event_type, case when k % 4 <> 0 then s_ms end as at, {_NULL_ID} as first_update_id, {_NULL_ID} as final_update_id,
 case when k % 4 = 0 then case when bad then 1 else 2 end when bad then 0 else 1 end as n_bids, case when k % 4 = 0 then coalesce(px, 1.25) else px end as bids_price, case when k % 4 = 0 and bad then 2.0 when bad then null else sz end as bids_size,
 1 as n_asks, good as asks_price, case when k % 4 <> 0 or k % 7 = 0 then 0.0 else sz end as asks_size, {_instrument("spot:coinbase", "['BTCUSD','ETHUSDC']")} as instrument_id, case when bad and k % 4 = 0 then 'invalid_bids' when bad then 'invalid_changes' else '' end as errors from x""",
    "bybit_depth_frames": _depth_sql(_PLAIN, "case when k % 2 = 0 then 'snapshot' else 'delta' end", "case when k % 5 <> 0 then ms - 1 else ms end", _NULL_ID, _NULL_ID, _instrument("perp:bybit", "['BTCUSDT','ETHUSDC']"), _ERR(("bad", "invalid_bids"), ("k % 9 = 0", "invalid_update_id")), ", case when k % 9 <> 0 then k end as update_id, k * 2 as cross_sequence"),
    "kraken_depth_frames": _depth_sql(_SLASH, "case when k % 2 = 0 then 'snapshot' else 'update' end", "s_ms", _NULL_ID, _NULL_ID, _instrument("spot:kraken", "['BTCUSD','ETHUSDC']"), more=", case when k % 6 <> 0 then k + 7 end as checksum"),
    "mexc_depth_frames": _depth_sql(_PLAIN, "'snapshot'", "case when k % 5 <> 0 then ms else ms - 5 end", _NULL_ID, _NULL_ID, _instrument("spot:mexc", "['BTCUSDT','ETHUSDC']"), "case when k % 8 = 0 then 'missing_publicLimitDepths' when bad then 'invalid_bids' else '' end", ", case when k % 8 <> 0 then k end as version", "k % 8 <> 0"),
    "okx_depth_frames": _depth_sql("(['BTC-USDT','ETH-USDC','FOO-BAR'])[u + 1]", "case when k % 2 = 0 then 'snapshot' else 'delta' end", "ms", "k - 1", "k", _instrument("spot:okx", "['BTCUSDT','ETHUSDC']"), more=", k as seq_id, k - 1 as prev_seq_id, k + 9 as checksum"),
    "polled_frames": f"""{_BASE} select k, 'trades' as kind, {_PLAIN} as product, 'aggTrade' as event_type, ms as at, px as price, k as id, {_NULL_ID} as first_id, {_instrument("perp:binance-futures", "['BTCUSDT','ETHUSDC']")} as instrument_id from x
union all select k, 'depth', {_PLAIN}, 'depthSnapshot', case when k % 2 = 0 then ms else ms - 2 end, good, k, {_NULL_ID}, {_instrument("perp:binance-futures", "['BTCUSDT','ETHUSDC']")} from x""",
    "snapshot_ahead": f"""{_BASE}, f as (select user_id, min(k) as k0, arg_min(good, k) as good from x group by user_id)
select user_id, 0 as ord, 'snapshot' as event_type, k0 as first_update_id, k0 as final_update_id, 1 as n_bids, good as bid, 1.5 as ask_size from f union all select user_id, k0 + 1, 'depthUpdate', k0, k0, null, null, null from f""",
    "frame_kinds": "with x as (select (['binance','coinbase','bybit','kraken','mexc','okx'])[user_id % 6 + 1] as style, (['data','ack','error','other'])[event_id % 4 + 1] as kind from events) select style, kind, count(*) as frames, count(*) filter (kind = 'data') as kept from x group by all",
    "text_poll_gate": """select doc_id as k, case when doc_id % 3 <> 0 then source else 'sub' end as product, case doc_id % 3 when 0 then 'new' when 1 then 'edit' else 'unknown' end as event_type, case when doc_id % 8 <> 0 then cast(doc_id as varchar) end as source_id, case when doc_id % 9 <> 0 then sha256(text) end as content_hash,
 case when doc_id % 10 <> 0 then sha256(text) end as raw_sha256, case when doc_id % 4 = 0 then 1700000000 + doc_id when doc_id % 4 = 1 then 1775469600 end as claimed, doc_id % 4 = 3 as unparseable,
 concat_ws(',', case when doc_id % 8 = 0 then 'missing_source_id' end, case when doc_id % 9 = 0 then 'missing_content_hash' end, case when doc_id % 10 = 0 then 'missing_raw_item' end, case when doc_id % 3 = 2 then 'unknown_event_type' end) as reasons,
 doc_id % 8 <> 0 and doc_id % 9 <> 0 and doc_id % 10 <> 0 and doc_id % 3 <> 2 as accepted from documents""",
}

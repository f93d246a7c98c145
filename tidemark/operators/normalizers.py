"""Normalizers: venue frames (source, received_at, payload: JSON text, and any columns to carry) to events.

A payload is read once by a fixed schema whose leaves are text, so a value's own spelling reaches the tolerant parsers;
unreadable fields are null and leave `invalid_<field>` in metadata.parse_errors. Frames that batch several events are
exploded, with `pos` for their order in the frame. Instruments come from the fixed dimension, as constants: no join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .instruments import with_instrument

_C = F.col


def _read(frames: DataFrame, schema: str, batch: str | None = None, unwrap: bool = False) -> DataFrame:
    """Adds `p` (the payload, or its `data` where it is wrapped) and, for batched frames, `i` (item) and `pos`."""
    body = _C("payload")
    if unwrap:
        inner = F.get_json_object("payload", "$.data")
        body = F.when(inner.startswith("{"), inner).otherwise(body)
    df = frames.withColumn("p", F.from_json(body, schema))
    if batch:
        df = df.select(*frames.columns, "p", F.posexplode(batch).alias("pos", "i"))
    return df


def _text(c: Column, default: str) -> Column:
    return F.when(S.blank(c), default).otherwise(c)


def _finish(df: DataFrame, carried: list[str], columns: dict[str, Column]) -> DataFrame:
    keep = [c for c in carried if c not in ("payload", *columns)] + (["pos"] if "pos" in df.columns else [])
    return df.select(*keep, *(v.alias(k) for k, v in columns.items()))


def _meta(errors: Column, flag: Column | None = None, replay: Column | None = None, time: Column | None = None, **extra: Column) -> Column:
    empty = F.lit(None).cast("string")
    pairs = [x for k, v in extra.items() for x in (F.lit(k), v.cast("string"))]
    bag = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()) if pairs else F.create_map().cast("map<string,string>")
    return F.struct(F.coalesce(_C("instrument.instrument_id"), empty).alias("instrument_id"), _C("instrument.canonical_symbol").alias("canonical_symbol"), (flag if flag is not None else F.lit(None).cast("boolean")).alias("buyer_is_maker"), (replay if replay is not None else F.lit(None).cast("boolean")).alias("subscribe_replay"), (time if time is not None else F.lit(None).cast("timestamp")).alias("event_time"), errors.alias("parse_errors"), bag.alias("extra"))


def _event(df: DataFrame, carried: list[str], kind: str, product: Column, symbol: Callable[[Column], Column], columns: Callable[[], dict[str, Column]], channel: str = "trades") -> DataFrame:
    df = with_instrument(df.withColumn("product", product).withColumn("symbol", symbol(_C("product"))), kind)
    null = {c: F.lit(None).cast(t) for c, t in (("side", "string"), ("price", "double"), ("size", "double"), ("order_id", "string"), ("trade_id", "string"), ("sequence", "bigint"))}
    base = {"source": _C("source"), "product": _C("product"), "channel": F.lit(channel), "event_type": F.lit("trade"), "exchange_time": F.lit(None).cast("timestamp"), "received_at": _C("received_at"), **null, "raw_type": F.lit("trade")}
    return _finish(df, carried, {**base, **columns()})


def _batch_trades(frames: DataFrame, schema: str, batch: str, kind: str, product: Column, symbol: Callable, time: Callable, side: Column, raw_side: Column, price: Column, size: Column, ids: Callable[[S.Fields], tuple[Column, Column]], replay: Column | None = None, extra: Callable[[S.Fields], dict[str, Column]] | None = None) -> DataFrame:
    df = _read(frames, schema, batch)

    def columns() -> dict[str, Column]:
        f = S.Fields()
        when = time(f)
        own = f.mapped(raw_side, side, "side")
        cost, amount = f.number(price, "price"), f.number(size, "size")
        trade_id, sequence = ids(f)
        more = extra(f) if extra else {}
        return {"exchange_time": when, "side": own, "price": cost, "size": amount, "trade_id": trade_id, "sequence": sequence, "metadata": _meta(f.errors(), own == "sell", replay, **more)}

    return _event(df, frames.columns, kind, product, symbol, columns)


def binance_trades(frames: DataFrame, kind: str = "spot") -> DataFrame:
    # names that differ in case alone are told apart before parsing
    ranged = frames.withColumn("payload", F.regexp_replace(F.regexp_replace("payload", r'"T"\s*:', '"traded":'), r'"E"\s*:', '"when":'))
    df = _read(ranged, "e string, when string, traded string, s string, t string, a string, p string, q string, m boolean", unwrap=True)
    raw = F.coalesce(F.get_json_object("payload", "$.data.m"), F.get_json_object("payload", "$.m"))

    def columns() -> dict[str, Column]:
        f = S.Fields()
        trade, event = f.epoch_ms(_C("p.traded")), f.epoch_ms(_C("p.when"))
        id_ = f.integer(F.coalesce("p.t", "p.a"), "trade_id")
        flag = f.boolean(raw, _C("p.m"), "buyer_is_maker")
        kind_ = _text(_C("p.e"), "trade")
        cost, size = f.number(_C("p.p"), "price"), f.number(_C("p.q"), "size")
        return {"event_type": kind_, "raw_type": kind_, "exchange_time": F.coalesce(trade, event), "side": S.side_of_maker_flag(flag), "price": cost, "size": size, "trade_id": id_.cast("string"), "sequence": id_, "metadata": _meta(f.errors(), flag, time=event)}

    return _event(df, frames.columns, kind, _text(_C("p.s"), "UNKNOWN"), lambda c: c, columns)


def binance_funding(frames: DataFrame) -> DataFrame:
    names = ("indexPrice", "lastFundingRate", "interestRate", "estimatedSettlePrice")
    df = _read(frames, "symbol string, time string, markPrice string, nextFundingTime string, " + ", ".join(f"{n} string" for n in names), unwrap=True)

    def columns() -> dict[str, Column]:
        f = S.Fields()
        when, mark = f.epoch_ms(_C("p.time")), f.number(_C("p.markPrice"), "mark_price")
        more = {k: f.number(_C(f"p.{n}"), k) for n, k in zip(names, ("index_price", "funding_rate", "interest_rate", "estimated_settle_price"), strict=True)}
        next_time = f.integer(_C("p.nextFundingTime"), "next_funding_time")
        return {"event_type": F.lit("funding"), "raw_type": F.lit("premiumIndex"), "exchange_time": when, "price": mark, "metadata": _meta(f.errors(), mark_price=mark, next_funding_time=next_time, **more)}

    return _event(df, frames.columns, "perp", _text(_C("p.symbol"), "UNKNOWN"), lambda c: c, columns, "funding")


def coinbase_trades(frames: DataFrame) -> DataFrame:
    """The side is the resting order's, so it is flipped; the trade id is the sequence."""
    df = _read(frames, "type string, trade_id string, product_id string, price string, size string, side string, time string, sequence string", unwrap=True)

    def columns() -> dict[str, Column]:
        f = S.Fields()
        when, id_ = f.iso(_C("p.time")), f.integer(_C("p.trade_id"), "trade_id")
        cost, size = f.number(_C("p.price"), "price"), f.number(_C("p.size"), "size")
        kind_, maker = _text(_C("p.type"), "match"), _C("p.side")
        return {"event_type": kind_, "raw_type": kind_, "exchange_time": when, "side": S.flipped_side(maker), "price": cost, "size": size, "trade_id": id_.cast("string"), "sequence": id_, "metadata": _meta(f.errors(), F.when(maker == "buy", True).when(maker == "sell", False), F.when(kind_ == "last_match", True), coinbase_sequence=_C("p.sequence"))}

    return _event(df, frames.columns, "spot", _text(_C("p.product_id"), "UNKNOWN"), S.plain_symbol, columns)


def bybit_trades(frames: DataFrame, kind: str = "spot") -> DataFrame:
    """The id is no counter, so there is no sequence."""
    df_schema = "data array<struct<T:string,s:string,taker:string,v:string,p:string,i:string,seq:string>>"
    renamed = frames.withColumn("payload", F.regexp_replace("payload", r'"S"\s*:', '"taker":'))
    id_ = F.when(~S.blank(_C("i.i")), _C("i.i"))
    return _batch_trades(renamed, df_schema, "p.data", kind, _text(_C("i.s"), "UNKNOWN"), S.plain_symbol, lambda f: f.epoch_ms(_C("i.T")), S.taker_side(_C("i.taker"), "Buy", "Sell"), _C("i.taker"), _C("i.p"), _C("i.v"), lambda f: (id_, F.lit(None).cast("bigint")), extra=lambda f: {"bybit_cross_sequence": f.integer(_C("i.seq"), "cross_sequence")})


def kraken_trades(frames: DataFrame) -> DataFrame:
    """The id is dense; trades of a snapshot frame are replays."""

    def ids(f: S.Fields) -> tuple[Column, Column]:
        own = f.integer(_C("i.trade_id"), "trade_id")
        return own.cast("string"), own

    schema = "type string, data array<struct<symbol:string,side:string,price:string,qty:string,ord_type:string,trade_id:string,timestamp:string>>"
    ord_type = F.when(_C("i.ord_type").isin("limit", "market"), _C("i.ord_type"))
    return _batch_trades(frames, schema, "p.data", "spot", _text(_C("i.symbol"), "UNKNOWN"), S.plain_symbol, lambda f: f.iso(_C("i.timestamp")), F.when(_C("i.side").isin("buy", "sell"), _C("i.side")), _C("i.side"), _C("i.price"), _C("i.qty"), ids, F.when(_C("p.type") == "snapshot", True), lambda f: {"ord_type": ord_type})


def mexc_trades(frames: DataFrame) -> DataFrame:
    """No ids; type 1 buys, 2 sells, 0 or none is unknown."""
    schema = "symbol string, channel string, publicAggreDeals struct<deals:array<struct<price:string,quantity:string,tradeType:string,time:string>>>, _mexc_decode struct<frame_sha256:string>"
    raw = F.when(_C("i.tradeType") != "0", _C("i.tradeType"))
    none = (F.lit(None).cast("string"), F.lit(None).cast("bigint"))
    return _batch_trades(frames, schema, "p.publicAggreDeals.deals", "spot", _text(_C("p.symbol"), "UNKNOWN"), S.plain_symbol, lambda f: f.epoch_ms(_C("i.time")), S.taker_side(raw, "1", "2"), raw, _C("i.price"), _C("i.quantity"), lambda f: none, extra=lambda f: {"mexc_channel": _C("p.channel"), "mexc_frame_sha256": _C("p._mexc_decode.frame_sha256")})


def okx_trades(frames: DataFrame, kind: str = "spot") -> DataFrame:
    """The venue may conflate fills, so its id is no sequence."""
    schema = "data array<struct<instId:string,tradeId:string,px:string,sz:string,side:string,ts:string>>"
    id_ = F.when(~S.blank(_C("i.tradeId")), _C("i.tradeId"))
    return _batch_trades(frames, schema, "p.data", kind, _text(_C("i.instId"), "UNKNOWN"), S.swap_symbol, lambda f: f.epoch_ms(_C("i.ts")), F.when(_C("i.side").isin("buy", "sell"), _C("i.side")), _C("i.side"), _C("i.px"), _C("i.sz"), lambda f: (id_, F.lit(None).cast("bigint")), extra=lambda f: {"okx_trade_id": id_})


_PAIRS = "array<array<string>>"
_OBJECTS = {"qty": "array<struct<price:string,qty:string>>", "quantity": "array<struct<price:string,quantity:string>>"}


def _depth(df: DataFrame, carried: list[str], kind: str, product: Column, symbol: Callable, columns: Callable[[], dict[str, Column]]) -> DataFrame:
    df = with_instrument(df.withColumn("product", product).withColumn("symbol", symbol(_C("product"))), kind)
    base = {"source": _C("source"), "product": _C("product"), "channel": F.lit("depth"), "event_type": F.lit("delta"), "event_time": F.lit(None).cast("timestamp"), "received_at": _C("received_at"), "first_update_id": F.lit(None).cast("bigint"), "final_update_id": F.lit(None).cast("bigint"), "instrument": _C("instrument")}
    return _finish(df, carried, {**base, **columns()})


def _depth_meta(errors: Column, extra: dict[str, Column] | None = None, **ids: Column) -> Column:
    names = ("bybit_update_id", "bybit_cross_sequence", "kraken_checksum", "okx_seq_id", "okx_prev_seq_id", "okx_checksum", "mexc_version")
    pairs = [x for k, v in (extra or {}).items() for x in (F.lit(k), v.cast("string"))]
    bag = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()) if pairs else F.create_map().cast("map<string,string>")
    return F.struct(*(ids.get(n, F.lit(None).cast("bigint")).alias(n) for n in names), errors.alias("parse_errors"), bag.alias("extra"))


def _raw(path: str, item: str | None = None) -> Column:
    """A field's own text, for telling absent from malformed."""
    return F.get_json_object("payload", path)


def binance_depth(frames: DataFrame, kind: str = "spot") -> DataFrame:
    # names that differ in case alone are told apart before parsing
    ranged = frames.withColumn("payload", F.regexp_replace(F.regexp_replace("payload", r'"U"\s*:', '"first":'), r'"E"\s*:', '"when":'))
    df = _read(ranged, f"e string, when string, s string, first string, u string, b {_PAIRS}, a {_PAIRS}", unwrap=True)
    either = lambda k: F.coalesce(_raw(f"$.data.{k}"), _raw(f"$.{k}"))

    def columns() -> dict[str, Column]:
        f = S.Fields()
        when, first, final = f.epoch_ms(_C("p.when")), f.integer(_C("p.first"), "first_update_id"), f.integer(_C("p.u"), "final_update_id")
        bids, asks = f.levels(either("b"), _C("p.b"), "bids"), f.levels(either("a"), _C("p.a"), "asks")
        return {"event_type": _text(_C("p.e"), "depthUpdate"), "event_time": when, "first_update_id": first, "final_update_id": final, "bids": bids, "asks": asks, "metadata": _depth_meta(f.errors())}

    return _depth(df, frames.columns, kind, _text(_C("p.s"), "UNKNOWN"), lambda c: c, columns)


def split_changes(changes: Column, side: str) -> Column:
    """Levels of one side of [[side, price, size], ...]."""
    own = F.filter(changes, lambda x: F.get(x, 0) == side)
    read = F.transform(own, lambda x: F.struct(F.get(x, 1).try_cast("double").alias("price"), F.get(x, 2).try_cast("double").alias("size")))
    return F.coalesce(F.filter(read, lambda x: x["price"].isNotNull() & x["size"].isNotNull()), F.array().cast("array<struct<price:double,size:double>>"))


def coinbase_depth(frames: DataFrame) -> DataFrame:
    """The snapshot comes in the stream; differences name their side; no ids."""
    df = _read(frames, f"type string, product_id string, time string, bids {_PAIRS}, asks {_PAIRS}, changes {_PAIRS}", unwrap=True)
    either = lambda k: F.coalesce(_raw(f"$.data.{k}"), _raw(f"$.{k}"))

    def columns() -> dict[str, Column]:
        f, snap = S.Fields(), F.coalesce(_C("p.type") == "snapshot", F.lit(False))
        when = f.iso(_C("p.time"))
        full = {k: f.levels(F.when(snap, either(k)), F.when(snap, _C(f"p.{k}")), k) for k in ("bids", "asks")}
        changes = F.when(~snap, _C("p.changes"))
        part = {k: split_changes(changes, s) for k, s in (("bids", "buy"), ("asks", "sell"))}
        lost = F.when(~snap & ~S.blank(either("changes")) & changes.isNull(), 1).otherwise(F.coalesce(F.size(changes) - F.size(part["bids"]) - F.size(part["asks"]), F.lit(0)))
        lost = F.when(snap | changes.isNull() & S.blank(either("changes")), 0).otherwise(lost)
        f.found.append(F.array_repeat(F.lit("invalid_changes"), lost))
        return {"event_type": F.when(snap, "snapshot").otherwise("l2update"), "event_time": when, **{k: F.when(snap, full[k]).otherwise(part[k]) for k in ("bids", "asks")}, "metadata": _depth_meta(f.errors())}

    return _depth(df, frames.columns, "spot", _text(_C("p.product_id"), "UNKNOWN"), S.plain_symbol, columns)


def bybit_depth(frames: DataFrame, kind: str = "spot") -> DataFrame:
    df = _read(frames, f"type string, ts string, cts string, data struct<s:string,b:{_PAIRS},a:{_PAIRS},u:string,seq:string>")

    def columns() -> dict[str, Column]:
        f = S.Fields()
        when = f.epoch_ms(F.coalesce("p.cts", "p.ts"))
        bids, asks = f.levels(_raw("$.data.b"), _C("p.data.b"), "bids"), f.levels(_raw("$.data.a"), _C("p.data.a"), "asks")
        ids = {"bybit_update_id": f.integer(_C("p.data.u"), "update_id"), "bybit_cross_sequence": f.integer(_C("p.data.seq"), "cross_sequence")}
        return {"event_type": F.when(_C("p.type") == "snapshot", "snapshot").otherwise("delta"), "event_time": when, "bids": bids, "asks": asks, "metadata": _depth_meta(f.errors(), **ids)}

    return _depth(df, frames.columns, kind, _text(_C("p.data.s"), "UNKNOWN"), S.plain_symbol, columns)


def kraken_depth(frames: DataFrame) -> DataFrame:
    levels = _OBJECTS["qty"]
    df = _read(frames, f"type string, data array<struct<symbol:string,bids:{levels},asks:{levels},checksum:string,timestamp:string>>", "p.data")

    def columns() -> dict[str, Column]:
        f = S.Fields()
        when = f.iso(_C("i.timestamp"))
        bids, asks = (f.levels(F.lit(None).cast("string"), _C(f"i.{k}"), k, "price", "qty") for k in ("bids", "asks"))
        sum_ = f.integer(_C("i.checksum"), "checksum")
        return {"event_type": F.when(_C("p.type") == "snapshot", "snapshot").otherwise("update"), "event_time": when, "bids": bids, "asks": asks, "metadata": _depth_meta(f.errors(), kraken_checksum=sum_)}

    return _depth(df, frames.columns, "spot", _text(_C("i.symbol"), "UNKNOWN"), S.plain_symbol, columns)


def mexc_depth(frames: DataFrame) -> DataFrame:
    """Every frame is a full book; one without a body is an error, never an empty book."""
    levels = _OBJECTS["quantity"]
    df = _read(frames, f"symbol string, channel string, sendTime string, createTime string, publicLimitDepths struct<bids:{levels},asks:{levels},version:string>, _mexc_decode struct<frame_sha256:string>")

    def columns() -> dict[str, Column]:
        f = S.Fields()
        f.found.append(F.when(_C("p.publicLimitDepths").isNull(), F.array(F.lit("missing_publicLimitDepths"))).otherwise(S.no_errors()))
        when = f.epoch_ms(F.coalesce("p.sendTime", "p.createTime"))
        bids, asks = (f.levels(_raw(f"$.publicLimitDepths.{k}"), _C(f"p.publicLimitDepths.{k}"), k, "price", "quantity") for k in ("bids", "asks"))
        version = f.integer(_C("p.publicLimitDepths.version"), "version")
        return {"event_type": F.lit("snapshot"), "event_time": when, "bids": bids, "asks": asks, "metadata": _depth_meta(f.errors(), {"mexc_channel": _C("p.channel"), "mexc_frame_sha256": _C("p._mexc_decode.frame_sha256")}, mexc_version=version)}

    return _depth(df, frames.columns, "spot", _text(_C("p.symbol"), "UNKNOWN"), S.plain_symbol, columns)


def okx_depth(frames: DataFrame, kind: str = "spot") -> DataFrame:
    """Linked ids: the previous one is the first, the own one the final; levels keep their first two fields."""
    df = _read(frames, f"arg struct<instId:string>, action string, data array<struct<bids:{_PAIRS},asks:{_PAIRS},ts:string,checksum:string,seqId:string,prevSeqId:string>>").withColumn("i", F.get(_C("p.data"), 0))

    def columns() -> dict[str, Column]:
        f = S.Fields()
        when = f.epoch_ms(_C("i.ts"))
        bids, asks = f.levels(_raw("$.data[0].bids"), _C("i.bids"), "bids"), f.levels(_raw("$.data[0].asks"), _C("i.asks"), "asks")
        own, prev, sum_ = f.integer(_C("i.seqId"), "seq_id"), f.integer(_C("i.prevSeqId"), "prev_seq_id"), f.integer(_C("i.checksum"), "checksum")
        return {"event_type": F.when(_C("p.action") == "snapshot", "snapshot").otherwise("delta"), "event_time": when, "first_update_id": prev, "final_update_id": own, "bids": bids, "asks": asks, "metadata": _depth_meta(f.errors(), okx_seq_id=own, okx_prev_seq_id=prev, okx_checksum=sum_)}

    return _depth(df, frames.columns, kind, _text(_C("p.arg.instId"), "UNKNOWN"), S.swap_symbol, columns)


_KNOWN = ("product_id", "symbol", "channel", "type", "time", "side", "price", "size", "remaining_size", "order_id", "trade_id", "sequence")


def generic_events(frames: DataFrame) -> DataFrame:
    """Loosely shaped payloads; a numeric time is epoch seconds; keys that are not known go to metadata."""
    df = frames.withColumn("p", F.from_json("payload", "map<string,string>"))
    at = lambda k: _C("p")[k]
    f = S.Fields()
    seconds = at("time").try_cast("double")
    when = f.mapped(at("time"), F.coalesce(F.timestamp_micros((seconds * 1e6).cast("bigint")), S.iso_timestamp(at("time"))), "time")
    cost = f.number(at("price"), "price")
    size = f.number(F.when(S.blank(at("size")), at("remaining_size")).otherwise(at("size")), "size")
    own = lambda k: F.when(~S.blank(at(k)), at(k))
    sequence = f.integer(at("sequence"), "sequence")
    rest = F.map_filter("p", lambda k, _: ~k.isin(*_KNOWN))
    null = lambda t: F.lit(None).cast(t)
    meta = F.struct(null("string").alias("instrument_id"), null("string").alias("canonical_symbol"), null("boolean").alias("buyer_is_maker"), F.when(at("subscribe_replay") == "true", True).alias("subscribe_replay"), null("timestamp").alias("event_time"), f.errors().alias("parse_errors"), rest.alias("extra"))
    return _finish(df, frames.columns, {"source": _C("source"), "product": F.coalesce(own("product_id"), own("symbol"), F.lit("UNKNOWN")), "channel": F.coalesce(own("channel"), F.lit("unknown")), "event_type": F.coalesce(own("type"), F.lit("unknown")), "exchange_time": when, "received_at": _C("received_at"), "side": own("side"), "price": cost, "size": size, "order_id": own("order_id"), "trade_id": own("trade_id"), "sequence": sequence, "raw_type": own("type"), "metadata": meta})


def text_items(frames: DataFrame) -> DataFrame:
    """Text polls to envelopes; a claimed time that cannot be read is marked, not an error."""
    schema = "feed string, subreddit string, source_id string, content_hash string, raw_item string, row_type string, created_utc string, source_ts_raw string, listing string, poll string"
    df = frames.withColumn("p", F.from_json("payload", schema))
    own = lambda k: F.when(~S.blank(_C(f"p.{k}")), _C(f"p.{k}"))
    missing = F.array_compact(F.array(F.when(own("source_id").isNull(), F.lit("missing_source_id")), F.when(own("content_hash").isNull(), F.lit("missing_content_hash")), F.when(_C("p.raw_item").isNull(), F.lit("missing_raw_item"))))
    # a JSON number only: text that looks like one is no claim
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json("payload"), "$.created_utc", "variant"))
    created = F.when(kind.rlike("^(BIGINT|DOUBLE|DECIMAL)"), _C("p.created_utc").try_cast("double"))
    claim = F.when(created.isNotNull(), F.timestamp_micros((created * 1e6).cast("bigint"))).otherwise(S.source_timestamp(own("source_ts_raw")))
    raw_claim = F.when(created.isNull(), own("source_ts_raw"))
    meta = F.struct(raw_claim.alias("source_ts_raw"), (raw_claim.isNotNull() & claim.isNull()).alias("source_ts_unparseable"), own("listing").alias("listing"), F.coalesce("p.poll", F.lit("{}")).alias("poll"), missing.alias("parse_errors"))
    return _finish(df, frames.columns, {"source": _C("source"), "product": F.coalesce(own("feed"), own("subreddit"), F.lit("unknown")), "channel": F.lit("text"), "event_type": F.when(_C("p.row_type").isin("new", "edit"), _C("p.row_type")).otherwise("unknown"), "source_id": own("source_id"), "source_ts": claim, "ingestion_ts": _C("received_at"), "received_at": _C("received_at"), "content_hash": own("content_hash"), "raw_item": _C("p.raw_item"), "metadata": meta})


def snapshot_rows(snapshots: DataFrame) -> DataFrame:
    """Anchor side-tables (source, product, received_at, snapshot) as depth rows that stand before a run's deltas (ord 0)."""
    pairs = lambda c: F.filter(F.transform(_C(c), lambda x: F.struct(F.get(x, 0).try_cast("double").alias("price"), F.get(x, 1).try_cast("double").alias("size"))), lambda x: x["price"].isNotNull() & x["size"].isNotNull())
    last = _C("snapshot.lastUpdateId")
    return snapshots.withColumns({"ord": F.lit(0).cast("bigint"), "channel": F.lit("depth"), "event_type": F.lit("snapshot"), "event_time": F.lit(None).cast("timestamp"), "first_update_id": last, "final_update_id": last, "bids": pairs("snapshot.bids"), "asks": pairs("snapshot.asks")}).drop("snapshot")


def remap_rest(frames: DataFrame, kind: str) -> DataFrame:
    """Polled pages in the shape of stream frames. kind: trades (adds s and e) or depth (renames; no first id)."""
    get = lambda k: F.get_json_object("payload", f"$.{k}")
    if kind == "trades":
        body = F.map_concat(F.from_json("payload", "map<string,string>"), F.create_map(F.lit("s"), _C("symbol"), F.lit("e"), F.lit("aggTrade")))
        return frames.withColumn("payload", F.to_json(body))
    body = F.concat(F.lit('{"s":"'), _C("symbol"), F.lit('","e":"depthSnapshot"'), *(F.when(v.isNotNull(), F.concat(F.lit(f',"{k}":'), v)).otherwise("") for k, v in (("E", F.coalesce(get("E"), get("T"))), ("u", get("lastUpdateId")), ("b", get("bids")), ("a", get("asks")))), F.lit("}"))
    return frames.withColumn("payload", body)

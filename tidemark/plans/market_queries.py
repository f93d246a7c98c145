"""Queries of gates, verdicts, books, instruments and normalizers over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import book, gates, instruments, normalizers, verdicts
from .inputs import CROSSED, DEPTH, TRADES, depth, table, trades, windows

_C = F.col
_RUN = ["user_id", "day"]


def _joined(df: DataFrame) -> DataFrame:
    return df.withColumn("findings", F.array_join("findings", ","))


def trades_verdict_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = verdicts.trades(trades(spark, sf_dir), _RUN, ["ord"])
    return _joined(out).select(*_RUN, "event_count", "first_trade_id", "last_trade_id", "trade_id_gap_count", "trade_id_gap_total_missing", "invalid_price_count", "invalid_size_count", "excessive_clock_skew_count", F.col("max_clock_skew_ms").cast("bigint").alias("max_clock_skew_ms"), "findings", "replayable")


def trades_verdict_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's runs of a day without one type: real gaps; every 17th id is sent again, every 31st comes late."""
    e = trades(spark, sf_dir).where("event_type <> 'view'")
    again = e.where("ord % 17 = 0").withColumn("n", F.lit(1))
    late = e.withColumn("n", F.lit(0)).withColumn("place", F.when(_C("ord") % 31 == 0, _C("ord") + 3).otherwise(_C("ord")))
    rows = late.unionByName(again.withColumn("place", _C("ord")))
    out = verdicts.trades(rows, _RUN, ["place", "ord", "n"])
    return out.select(*_RUN, "event_count", "non_monotonic_count", "duplicate_trade_id_count", "trade_id_gap_count", "trade_id_gap_total_missing", "replayable")


def none_native_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival order is a permutation inside the day, so times run backwards against their maximum."""
    e = trades(spark, sf_dir).withColumn("place", (_C("ord") * 7919) % 1009)
    return _joined(verdicts.trades_stream(e, _RUN, ["place", "ord"])).select(*_RUN, "event_count", "non_monotonic_count", "invalid_price_count", "invalid_size_count", "findings", "replayable")


def funding_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = trades(spark, sf_dir).where("channel = 'funding'").withColumnRenamed("product", "symbol")
    out = verdicts.funding(e, ["symbol", "day"], ["ord"])
    return _joined(out).select(_C("symbol").alias("product"), "day", "event_count", "invalid_price_count", "excessive_clock_skew_count", "findings", "replayable")


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.event_gate(trades(spark, sf_dir), ["user_id", "day", "product", "channel"], ["received_at", "ord"])


def gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gated(spark, sf_dir).select(_C("ord").alias("event_id"), F.array_join("reasons", ",").alias("reasons"), "accepted")


def gate_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.reject_histogram(_gated(spark, sf_dir))


def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.run_counters(_gated(spark, sf_dir), ["day"])


def gate_sequence_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = trades(spark, sf_dir).select(*_RUN, "ord", "sequence", _C("metadata.subscribe_replay").alias("subscribe_replay")).withColumn("place", (_C("ord") * 31) % 257)
    return gates.sequence_cursor(e, _RUN, ["place", "ord"]).select(_C("ord").alias("event_id"), F.coalesce("sequence_reason", F.lit("")).alias("reason"))


def range_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = windows(spark, sf_dir).withColumn("metadata", F.struct(F.when(_C("ord") % 13 == 0, F.array(F.lit("invalid_bids"))).otherwise(F.array().cast("array<string>")).alias("parse_errors")))
    return gates.range_gate(w).select("ord", F.array_join("reasons", ",").alias("reasons"), "accepted")


def depth_anchor_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = windows(spark, sf_dir)
    anchors = w.select("run").distinct().select("run", (_C("run") * 40 + 100).alias("snapshot_last_update_id"))
    out = verdicts.depth(w, ["run"], ["ord"], anchors)
    return _joined(out).select("run", "event_count", "gap_count", "snapshot_gap_count", "reordered_count", "invalid_range_count", "last_update_id", "findings", "replayable")


def snapshot_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = windows(spark, sf_dir)
    anchors = w.select("run").distinct().select("run", (_C("run") * 400 + 100).alias("snapshot_last_update_id"))
    return book.bridges(w, anchors, ["run"], ["ord"]).select("run", _C("kept").cast("bigint").alias("kept"), "bridges")


def _stream_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = trades(spark, sf_dir)
    prior = F.lag("ord").over(Window.partitionBy(*_RUN).orderBy("ord"))
    return e.select(*_RUN, "ord", F.when(_C("event_type") == "signup", "snapshot").otherwise("delta").alias("event_type"), _C("exchange_time").alias("event_time"), F.when(_C("ord") % 101 != 0, _C("ord")).alias("update_id"), F.when(_C("ord") % 7 == 0, _C("ord") - 1).otherwise(prior).alias("first_update_id"), _C("ord").alias("final_update_id"))


def _stream_columns(df: DataFrame) -> DataFrame:
    return _joined(df).select(*_RUN, "event_count", "snapshot_count", "starts_with_snapshot", "missing_update_id_count", "gap_count", "reordered_count", "findings", "replayable")


def dense_id_subbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_columns(verdicts.depth_stream(_stream_updates(spark, sf_dir), _RUN, ["ord"], "dense"))


def chain_subbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_columns(verdicts.depth_stream(_stream_updates(spark, sf_dir), _RUN, ["ord"], "chain"))


def final_book_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = book.sub_books(depth(spark, sf_dir), ["run"], ["ord"])
    return book.final_levels(u, ["run"], ["ord"])


def final_book_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = book.top_levels(final_book_levels(spark, sf_dir), ["run"], 3)
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat(x["price"].cast("bigint").cast("string"), F.lit("x"), x["size"].cast("bigint").cast("string"))), ",")
    return top.select("run", "best_bid", "best_ask", "spread", "bid_levels", "ask_levels", text("top_bids").alias("top_bids"), text("top_asks").alias("top_asks"))


def crossed_book_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = book.sub_books(depth(spark, sf_dir), ["run"], ["ord"])
    return book.crossed_counts(book.best_prices(u, ["run"], "ord"), ["run"])


def book_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checksum after every event of books bounded to ten levels a side."""
    u = book.sub_books(depth(spark, sf_dir), ["run"], ["ord"])
    return book.checksums(u, ["run"], "ord", 1, 8, depth=10).select("run", "ord", "crc")


def instrument_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols made of parts: base and quote by key, venues by supplier."""
    bases, ends = F.array(*map(F.lit, ("btc", "ETH", "XBT", "sol", "ABC", "DOGE"))), F.array(*map(F.lit, ("USDT", "/usd", "USDC", "BTC", "EUR")))
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.get(bases, (_C("p_partkey") % 6).cast("int")), F.get(ends, (_C("p_partkey") % 5).cast("int"))).alias("symbol"), F.lit(" Venue ").alias("venue"))
    refs = instruments.resolve(p, "spot")
    return p.join(refs, ["symbol", "venue"]).select("p_partkey", "symbol", _C("instrument.instrument_id").alias("instrument_id"), _C("instrument.canonical_symbol").alias("canonical_symbol"))


def raw_frame_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as loosely shaped JSON frames, read back by the generic normalizer."""
    e = table(spark, sf_dir, "events")
    body = F.to_json(F.struct(_C("event_type").alias("type"), _C("event_id").cast("string").alias("sequence"), F.when(_C("event_id") % 10 == 0, "n/a").otherwise(F.round("value", 4).cast("string")).alias("price"), _C("user_id").alias("symbol"), F.get_json_object("props", "$.k").alias("k")))
    out = normalizers.generic_events(e.select(F.lit("mock").alias("source"), _C("ts").cast("timestamp").alias("received_at"), body.alias("payload")))
    return out.select("sequence", "product", "event_type", F.round("price", 4).alias("price"), F.array_join("metadata.parse_errors", ",").alias("errors"), _C("metadata.extra")["k"].alias("k"))


def batch_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's lines as one frame of trades, read by the batched normalizer and fanned out."""
    li = table(spark, sf_dir, "lineitem")
    item = F.struct(F.lit("BTC-USDT").alias("instId"), F.concat_ws("-", _C("l_orderkey").cast("string"), _C("l_linenumber").cast("string")).alias("tradeId"), _C("l_extendedprice").cast("string").alias("px"), _C("l_quantity").cast("string").alias("sz"), F.when(_C("l_returnflag") == "R", "sell").when(_C("l_returnflag") == "A", "buy").otherwise("x").alias("side"))
    frames = li.groupBy("l_orderkey").agg(F.to_json(F.struct(F.collect_list(item).alias("data"))).alias("payload")).select(F.lit("okx").alias("source"), F.lit(None).cast("timestamp").alias("received_at"), "payload", "l_orderkey")
    out = normalizers.okx_trades(frames)
    return out.groupBy("l_orderkey").agg(F.count("*").alias("trades"), F.round(F.sum("price"), 2).alias("price"), F.round(F.sum("size"), 2).alias("size"), F.count_if(_C("side") == "sell").alias("sells"), F.count_if(F.size("metadata.parse_errors") > 0).alias("errors"))


def side_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    flag = F.when(_C("event_id") % 5 == 0, None).otherwise(_C("event_id") % 2 == 0)
    maker = F.when(_C("event_id") % 3 == 0, "buy").when(_C("event_id") % 3 == 1, "sell").otherwise("none")
    return e.select("event_id", S.side_of_maker_flag(flag).alias("from_flag"), S.flipped_side(maker).alias("from_maker"), S.taker_side((_C("event_id") % 4).cast("string"), "1", "2").alias("from_type"))


def level_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's lines as [[side, price, size], ...] changes, split by side."""
    li = table(spark, sf_dir, "lineitem")
    change = F.array(F.when(_C("l_linestatus") == "O", "buy").otherwise("sell"), _C("l_partkey").cast("string"), F.when(_C("l_linenumber") == 7, "bad").otherwise(_C("l_quantity").cast("string")))
    o = li.groupBy("l_orderkey").agg(F.collect_list(change).alias("changes"))
    total = lambda side: F.aggregate(normalizers.split_changes(_C("changes"), side), F.lit(0.0), lambda a, x: a + x["size"])
    return o.select("l_orderkey", F.size(normalizers.split_changes(_C("changes"), "buy")).cast("bigint").alias("bids"), F.size(normalizers.split_changes(_C("changes"), "sell")).cast("bigint").alias("asks"), total("buy").alias("bid_size"), total("sell").alias("ask_size"))


def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each click with the user's last purchase at or before it."""
    e = table(spark, sf_dir, "events")
    buys = e.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("value").alias("last_value"))
    clicks = e.where("event_type = 'click'").select("user_id", "ts", "event_id")
    return book.as_of(clicks, buys, ["user_id"], "ts", ["last_value"]).select("event_id", "last_value")


QUERIES = {f.__name__: f for f in (trades_verdict_by_run, trades_verdict_dense, none_native_verdict, funding_verdict, gate_reasons, gate_histogram, run_counters, gate_sequence_cursor, range_gate, depth_anchor_verdict, snapshot_bridge, dense_id_subbooks, chain_subbooks, final_book_levels, final_book_topn, crossed_book_count, book_checksum, instrument_resolution, raw_frame_normalize, batch_fanout, side_mapping, level_split, asof_join)}


def _named(*pairs: tuple[str, str]) -> str:
    return "concat_ws(',', " + ", ".join(f"case when {c} then '{n}' end" for c, n in pairs) + ")"


_GATE = f"""with {TRADES},
s as (select *, count(*) filter (not again) over w > 0 as seen from e window w as (partition by user_id, day, product, channel order by received_at, ord rows between unbounded preceding and 1 preceding)),
c as (select *, max(case when not again or seen then sequence end) over (partition by user_id, day, product, channel order by received_at, ord rows between unbounded preceding and 1 preceding) as cur from s),
g as (select *, {_named(("bad", "invalid_price"), ("side = 'odd'", "invalid_side"), ("channel = 'trades' and not (price > 0)", "invalid_trade_price"), ("channel = 'trades' and not (size > 0)", "invalid_trade_size"), ("channel <> 'trades' and price <= 0", "non_positive_price"), ("channel <> 'trades' and size < 0", "negative_size"), ("delay > 60 or delay < -5", "stale_or_clock_skew"), ("again and not coalesce(sequence > cur, false)", "subscribe_replay"), ("not again and sequence < cur", "non_monotonic_sequence"))} as reasons from c)"""

_STREAM = f"""with {TRADES},
u as (select user_id, day, ord, event_type = 'signup' as snap, exchange_time as t, case when ord % 101 <> 0 then ord end as update_id,
 case when ord % 7 = 0 then ord - 1 else lag(ord) over (partition by user_id, day order by ord) end as first_id, ord as final_id from e),"""


def _stream_sql(uid: str, gap: str, back: str) -> str:
    return _STREAM + f"""
v as (select *, {uid} as uid, last_value({uid} ignore nulls) over (partition by user_id, day order by ord rows between unbounded preceding and 1 preceding) as prev from u),
a as (select user_id, day, count(*) as event_count, count(*) filter (snap) as snapshot_count, arg_min(snap, ord) as starts_with_snapshot, count(*) filter (uid is null) as missing_update_id_count,
 count(*) filter (not snap and uid is not null and prev is not null and {gap}) as gap_count, count(*) filter (not snap and uid is not null and prev is not null and {back}) as reordered_count from v group by all)
select *, {_named(("snapshot_count = 0", "no_snapshot_anchor"), ("snapshot_count > 0 and not starts_with_snapshot", "run_does_not_start_with_snapshot"), ("missing_update_id_count > 0", "missing_update_id"), ("gap_count > 0", "update_id_gaps"), ("reordered_count > 0", "non_monotonic_update_id"))} as findings,
 snapshot_count > 0 and starts_with_snapshot and missing_update_id_count + gap_count + reordered_count = 0 as replayable from a"""


_WINDOWS = "w as (select o_custkey as run, o_orderkey as ord, o_orderkey * 2 + case when o_orderkey % 97 = 0 then 5 else 0 end as lo, o_orderkey * 2 + case when o_orderkey % 89 = 0 then -3 else 1 end as hi from orders)"

_FINAL = f"""with {DEPTH},
keep as (select run, max(book) as book from bk group by run),
own as (select lv.*, bk.snap from lv join bk using (run, ord) join keep using (run, book) where not snap or size > 0),
fin as (select run, side, price, arg_max(size, ord) as size from own group by all)"""

ORACLES = {
    "trades_verdict_by_run": f"""with {TRADES},
v as (select *, sequence - lag(sequence) over (partition by user_id, day order by ord) as step from e),
a as (select user_id, day, count(*) as event_count, min(ord) as first_trade_id, max(ord) as last_trade_id, count(*) filter (step > 1) as trade_id_gap_count, cast(coalesce(sum(step - 1) filter (step > 1), 0) as bigint) as trade_id_gap_total_missing,
 count(*) filter (not (price > 0)) as invalid_price_count, count(*) filter (not (size > 0)) as invalid_size_count, count(*) filter (abs(delay) > 60) as excessive_clock_skew_count, cast(max(abs(delay)) * 1000 as bigint) as max_clock_skew_ms from v group by all)
select *, {_named(("trade_id_gap_count > 0", "trade_id_gaps"), ("invalid_price_count > 0", "invalid_prices"), ("invalid_size_count > 0", "invalid_sizes"), ("excessive_clock_skew_count > 0", "excessive_clock_skew"))} as findings,
 trade_id_gap_count + invalid_price_count + invalid_size_count + excessive_clock_skew_count = 0 as replayable from a""",
    "trades_verdict_dense": f"""with {TRADES},
x as (select *, 0 as n, case when ord % 31 = 0 then ord + 3 else ord end as place from e where event_type <> 'view' union all select *, 1 as n, ord as place from e where event_type <> 'view' and ord % 17 = 0),
v as (select *, sequence - lag(sequence) over (partition by user_id, day order by place, ord, n) as step from x),
a as (select user_id, day, count(*) as event_count, count(*) filter (step < 0) as non_monotonic_count, count(*) filter (step = 0) as duplicate_trade_id_count, count(*) filter (step > 1) as trade_id_gap_count, cast(coalesce(sum(step - 1) filter (step > 1), 0) as bigint) as trade_id_gap_total_missing,
 count(*) filter (not (price > 0) or not (size > 0) or abs(delay) > 60) as poor from v group by user_id, day)
select user_id, day, event_count, non_monotonic_count, duplicate_trade_id_count, trade_id_gap_count, trade_id_gap_total_missing, non_monotonic_count + trade_id_gap_count + poor = 0 as replayable from a""",
    "none_native_verdict": f"""with {TRADES},
v as (select *, exchange_time < max(exchange_time) over (partition by user_id, day order by (ord * 7919) % 1009, ord rows between unbounded preceding and 1 preceding) as early from e),
a as (select user_id, day, count(*) as event_count, count(*) filter (early) as non_monotonic_count, count(*) filter (not (price > 0)) as invalid_price_count, count(*) filter (not (size > 0)) as invalid_size_count, count(*) filter (abs(delay) > 60) as skewed from v group by user_id, day)
select user_id, day, event_count, non_monotonic_count, invalid_price_count, invalid_size_count, {_named(("non_monotonic_count > 0", "non_monotonic_event_time"), ("invalid_price_count > 0", "invalid_prices"), ("invalid_size_count > 0", "invalid_sizes"), ("skewed > 0", "excessive_clock_skew"))} as findings,
 non_monotonic_count + invalid_price_count + invalid_size_count + skewed = 0 as replayable from a""",
    "funding_verdict": f"""with {TRADES},
a as (select product, day, count(*) as event_count, count(*) filter (not (price > 0)) as invalid_price_count, count(*) filter (abs(delay) > 60) as excessive_clock_skew_count from e where channel = 'funding' group by all)
select *, {_named(("invalid_price_count > 0", "invalid_mark_price"), ("excessive_clock_skew_count > 0", "excessive_clock_skew"))} as findings, invalid_price_count + excessive_clock_skew_count = 0 as replayable from a""",
    "gate_reasons": _GATE + " select ord as event_id, reasons, reasons = '' as accepted from g",
    "gate_histogram": _GATE + ", x as (select unnest(string_split(reasons, ',')) as reason from g where reasons <> '') select reason, count(*) as rejects from x group by reason",
    "run_counters": _GATE + " select day, count(*) as raw_events, count(*) filter (reasons = '') as clean_events, count(*) filter (reasons <> '') as quarantined_events from g group by day",
    "gate_sequence_cursor": f"""with {TRADES},
p as (select *, (ord * 31) % 257 as place from e),
s as (select *, count(*) filter (not again) over (partition by user_id, day order by place, ord rows between unbounded preceding and 1 preceding) > 0 as seen from p),
c as (select *, max(case when not again or seen then sequence end) over (partition by user_id, day order by place, ord rows between unbounded preceding and 1 preceding) as cur from s)
select ord as event_id, case when again and not coalesce(sequence > cur, false) then 'subscribe_replay' when not again and sequence < cur then 'non_monotonic_sequence' else '' end as reason from c""",
    "range_gate": f"with {_WINDOWS} select ord, {_named(('ord % 13 = 0', 'invalid_bids'), ('hi < lo', 'invalid_update_range'))} as reasons, ord % 13 <> 0 and hi >= lo as accepted from w",
    "depth_anchor_verdict": f"""with {_WINDOWS},
x as (select *, run * 40 + 100 as a, lo <= hi as valid, lo <= hi and hi > run * 40 + 100 as past from w),
y as (select *, count(*) filter (past) over (partition by run order by ord rows between unbounded preceding and 1 preceding) as n from x),
z as (select *, valid and n = 0 and not past as skipped, valid and (n > 0 or past) as live, past and n = 0 as anch from y),
v as (select *, max(case when live then hi end) over (partition by run order by ord rows between unbounded preceding and 1 preceding) as prev from z),
g as (select run, count(*) filter (not skipped) as event_count, count(*) filter (live and not anch and hi > prev and lo > prev + 1) as gap_count, count(*) filter (anch and lo > a + 1) as snapshot_gap_count,
 count(*) filter (live and not anch and hi <= prev) as reordered_count, count(*) filter (not valid) as invalid_range_count, max(case when live then hi end) as last_update_id from v group by run)
select *, {_named(("gap_count > 0", "gaps_detected"), ("snapshot_gap_count > 0", "snapshot_anchor_gap"), ("reordered_count > 0", "reordered_or_duplicate_updates"), ("invalid_range_count > 0", "invalid_update_ranges"), ("event_count = 0", "no_events"))} as findings,
 event_count > 0 and gap_count + snapshot_gap_count + reordered_count + invalid_range_count = 0 as replayable from g""",
    "snapshot_bridge": f"with {_WINDOWS}, r as (select distinct run from w), k as (select run, count(*) as kept, arg_min(lo, ord) as f from w where hi > run * 400 + 100 group by run) select r.run, coalesce(kept, 0) as kept, f <= r.run * 400 + 101 as bridges from r left join k using (run)",
    "dense_id_subbooks": _stream_sql("update_id", "uid - prev > 1", "uid <= prev"),
    "chain_subbooks": _stream_sql("final_id", "uid >= prev and first_id is distinct from prev", "uid < prev"),
    "final_book_levels": _FINAL + " select * from fin where size <> 0",
    "final_book_topn": _FINAL + """,
t as (select *, row_number() over (partition by run, side order by case side when 'bid' then -price else price end) as n, cast(cast(price as bigint) as varchar) || 'x' || cast(cast(size as bigint) as varchar) as p from fin where size <> 0)
select run, max(price) filter (side = 'bid') as best_bid, min(price) filter (side = 'ask') as best_ask, min(price) filter (side = 'ask') - max(price) filter (side = 'bid') as spread, count(*) filter (side = 'bid') as bid_levels, count(*) filter (side = 'ask') as ask_levels,
 coalesce(string_agg(p, ',' order by n) filter (side = 'bid' and n <= 3), '') as top_bids, coalesce(string_agg(p, ',' order by n) filter (side = 'ask' and n <= 3), '') as top_asks from t group by run""",
    "crossed_book_count": CROSSED,
    # each book is carried from frame to frame; the checksum's table comes from its polynomial
    "book_checksum": f"""with recursive {DEPTH},
own as (select run, ord, list({{'p': price, 's': size}}) filter (side = 'bid') as b, list({{'p': price, 's': size}}) filter (side = 'ask') as a from lv group by run, ord),
g as materialized (select run, ord, snap, coalesce(b, []) as b, coalesce(a, []) as a, row_number() over (partition by run order by ord) as n from frame join own using (run, ord)),
step(run, n, ord, bids, asks) as (
 select run, n, ord, list_sort(list_filter(b, lambda x: x.s > 0), 'DESC')[1:10], list_sort(list_filter(a, lambda x: x.s > 0))[1:10] from g where n = 1 union all
 select g.run, g.n, g.ord, list_sort(list_concat(case when g.snap then [] else list_filter(s.bids, lambda x: not list_contains(list_transform(g.b, lambda y: y.p), x.p)) end, list_filter(g.b, lambda x: x.s > 0)), 'DESC')[1:10],
  list_sort(list_concat(case when g.snap then [] else list_filter(s.asks, lambda x: not list_contains(list_transform(g.a, lambda y: y.p), x.p)) end, list_filter(g.a, lambda x: x.s > 0)))[1:10] from step s join g on g.run = s.run and g.n = s.n + 1),
tab as (select list(c order by i) as t from (select i, list_reduce([cast(i as ubigint), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c & 1 = 1 then xor(c >> 1, cast(3988292384 as ubigint)) else c >> 1 end) as c from range(256) r(i))),
txt as (select run, ord, list_aggregate(list_transform(list_concat(asks, bids), lambda x: coalesce(nullif(ltrim(replace(printf('%.1f', x.p), '.', ''), '0'), ''), '0') || coalesce(nullif(ltrim(replace(printf('%.8f', x.s), '.', ''), '0'), ''), '0')), 'string_agg', '') as d from step)
select run, ord, cast(xor(list_reduce(list_concat([cast(4294967295 as ubigint)], list_transform(list_filter(string_split(coalesce(d, ''), ''), lambda x: x <> ''), lambda x: cast(ascii(x) as ubigint))), lambda c, b: xor(c >> 8, t[cast(xor(c & 255, b) as bigint) + 1])), cast(4294967295 as ubigint)) as bigint) as crc from txt, tab""",
    "instrument_resolution": """with p as (select p_partkey, (['btc','ETH','XBT','sol','ABC','DOGE'])[p_partkey % 6 + 1] as b, (['USDT','/usd','USDC','BTC','EUR'])[p_partkey % 5 + 1] as q from part),
s as (select *, case upper(b) when 'XBT' then 'BTC' when 'ABC' then null else upper(b) end as base, case when q = 'EUR' then null else upper(replace(q, '/', '')) end as quote from p)
select p_partkey, b || q as symbol, case when base is not null and quote is not null then 'spot:venue:' || upper(b) || quote end as instrument_id, case when base is not null and quote is not null then base || '/' || quote end as canonical_symbol from s""",
    "raw_frame_normalize": """select event_id as sequence, cast(user_id as varchar) as product, event_type, case when event_id % 10 <> 0 then round(value, 4) end as price, case when event_id % 10 = 0 then 'invalid_price' else '' end as errors, props ->> '$.k' as k from events""",
    "batch_fanout": """select l_orderkey, count(*) as trades, round(sum(l_extendedprice), 2) as price, round(sum(l_quantity), 2) as size, count(*) filter (l_returnflag = 'R') as sells, count(*) filter (l_returnflag not in ('R', 'A')) as errors from lineitem group by l_orderkey""",
    "side_mapping": """select event_id, case when event_id % 5 = 0 then null when event_id % 2 = 0 then 'sell' else 'buy' end as from_flag, case event_id % 3 when 0 then 'sell' when 1 then 'buy' end as from_maker, case event_id % 4 when 1 then 'buy' when 2 then 'sell' end as from_type from events""",
    "level_split": """select l_orderkey, count(*) filter (l_linestatus = 'O' and l_linenumber <> 7) as bids, count(*) filter (l_linestatus <> 'O' and l_linenumber <> 7) as asks, coalesce(sum(l_quantity) filter (l_linestatus = 'O' and l_linenumber <> 7), 0) as bid_size, coalesce(sum(l_quantity) filter (l_linestatus <> 'O' and l_linenumber <> 7), 0) as ask_size from lineitem group by l_orderkey""",
    "asof_join": """with b as (select user_id, ts, max(value) as last_value from events where event_type = 'purchase' group by all) select c.event_id, b.last_value from (select * from events where event_type = 'click') c asof left join b on c.user_id = b.user_id and c.ts >= b.ts""",
}

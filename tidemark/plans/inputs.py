"""The given tables in the shapes that the operators take: events as trades, orders as runs, line items as books."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import shared_folder

_C = F.col
__all__ = ["shared_folder"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as prints: runs of a user and day, received up to 80 s after and 10 s before they happened."""
    e = table(spark, sf_dir, "events")
    ts = _C("ts").cast("timestamp")
    seen = F.timestamp_micros(F.unix_micros(ts) + (_C("event_id") % 90 - 10) * 1_000_000)
    return e.select(
        _C("user_id"), F.to_date(ts).alias("day"), _C("event_id").alias("ord"), F.lit("venue").alias("source"), F.concat(F.lit("P"), (_C("user_id") % 3).cast("string")).alias("product"),
        F.when(_C("event_type") == "error", "funding").otherwise("trades").alias("channel"), _C("event_type"), ts.alias("exchange_time"), seen.alias("received_at"),
        F.when(_C("event_id") % 11 == 0, "odd").when(_C("event_id") % 2 == 0, "buy").otherwise("sell").alias("side"),
        F.when(_C("event_id") % 53 == 0, -_C("value")).otherwise(_C("value")).alias("price"), F.when(_C("event_id") % 37 == 0, 0.0).otherwise(_C("value") / 2).alias("size"),
        _C("event_id").cast("string").alias("trade_id"), _C("event_id").alias("sequence"), _C("value"),
        F.struct(F.when(_C("event_type") == "signup", True).alias("subscribe_replay"), F.when(_C("event_id") % 29 == 0, F.array(F.lit("invalid_price"))).otherwise(F.array().cast("array<string>")).alias("parse_errors")).alias("metadata"),
    )


#: The same in SQL.
TRADES = """e as (select user_id, cast(ts as date) as day, event_id as ord, 'P' || (user_id % 3) as product, case when event_type = 'error' then 'funding' else 'trades' end as channel, event_type,
 ts as exchange_time, ts + to_seconds(cast(event_id % 90 - 10 as bigint)) as received_at, case when event_id % 11 = 0 then 'odd' when event_id % 2 = 0 then 'buy' else 'sell' end as side,
 case when event_id % 53 = 0 then -value else value end as price, case when event_id % 37 = 0 then 0.0 else value / 2 end as size, event_id as sequence, value, event_type = 'signup' as again, event_id % 29 = 0 as bad, event_id % 90 - 10 as delay from events)"""


def depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as levels of update frames, an order's lines a frame; a supplier's book is a run.

    Every 40th order is a snapshot; returned lines have size 0. A frame's price stands once a side: its largest size.
    """
    li = table(spark, sf_dir, "lineitem").repartition("l_suppkey")  # once for levels, frames and the runs' windows
    level = li.groupBy(_C("l_suppkey").alias("run"), _C("l_orderkey").alias("ord"), F.when(_C("l_linestatus") == "O", "bid").otherwise("ask").alias("side"), (_C("l_partkey") % 50).cast("double").alias("price")).agg(F.max(F.when(_C("l_returnflag") == "R", 0.0).otherwise(_C("l_quantity"))).alias("size"))
    pair = F.struct("price", "size")
    side = lambda s: F.array_sort(F.collect_list(F.when(_C("side") == s, pair)))
    return level.groupBy("run", "ord").agg(side("bid").alias("bids"), side("ask").alias("asks")).withColumn("event_type", F.when(_C("ord") % 40 == 0, "snapshot").otherwise("delta"))


DEPTH = """lv as (select l_suppkey as run, l_orderkey as ord, case when l_linestatus = 'O' then 'bid' else 'ask' end as side, cast(l_partkey % 50 as double) as price, max(case when l_returnflag = 'R' then 0.0 else l_quantity end) as size
 from lineitem group by all),
frame as (select distinct run, ord, ord % 40 = 0 as snap from lv),
bk as (select *, sum(case when snap then 1 else 0 end) over (partition by run order by ord) as book from frame)"""


#: Events after which the best bid is not below the best ask: a level lives from its write to the next one of its price in its sub-book.
CROSSED = f"""with {DEPTH},
w as (select lv.*, book, snap, lead(ord) over (partition by run, book, side, price order by ord) as nxt from lv join bk using (run, ord)),
alive as (select f.run, f.ord, w.side, w.price from bk f join w on w.run = f.run and w.book = f.book and w.ord <= f.ord and (w.nxt is null or f.ord < w.nxt) where w.size > 0 or (w.size < 0 and not w.snap)),
best as (select run, ord, max(price) filter (side = 'bid') as bid, min(price) filter (side = 'ask') as ask from alive group by run, ord)
select run, count(*) filter (bid >= ask) as crossed_book_count from bk left join best using (run, ord) group by run"""


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as update windows, a customer's a run: a window goes from its key to one beyond; some run backwards or leave gaps."""
    o = table(spark, sf_dir, "orders")
    k = _C("o_orderkey")
    return o.select(_C("o_custkey").alias("run"), k.alias("ord"), (k * 2 + F.when(k % 97 == 0, 5).otherwise(0)).alias("first_update_id"), (k * 2 + F.when(k % 89 == 0, -3).otherwise(1)).alias("final_update_id"))


def order_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as runs: lane by priority, day of the order, verdict by status (P: none)."""
    o = table(spark, sf_dir, "orders")
    at = _C("o_orderdate").cast("timestamp")
    return o.select(_C("o_orderkey").alias("run_path"), F.regexp_replace(_C("o_orderpriority"), "^.-", "").alias("lane"), F.to_date(at).alias("day"), at.alias("started_at"), F.when(_C("o_orderstatus") == "F", True).when(_C("o_orderstatus") == "O", False).alias("replayable"), (_C("o_orderkey") % 10 != 3).alias("has_events"), _C("o_custkey"), _C("o_totalprice"))


RUNS = """r as (select o_orderkey as run_path, regexp_replace(o_orderpriority, '^.-', '') as lane, cast(o_orderdate as date) as day, o_orderdate as started_at, case o_orderstatus when 'F' then true when 'O' then false end as replayable, o_orderkey % 10 <> 3 as has_events, o_custkey, o_totalprice from orders)"""

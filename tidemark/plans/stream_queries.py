"""Queries of the streaming operators: the given events as a stream of frames, gated in micro-batches, read back as a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import book, gates
from ..sources.sinks import split
from ..sources.tables import discard, written
from ..streaming import jobs
from .inputs import CROSSED, TRADES, depth, shared_folder, table, trades
from .market_queries import _GATE, _named

_C = F.col


def _event_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """events as a file stream of four files: two days' worth of hash groups each."""
    e = table(spark, sf_dir, "events").select("event_id", _C("ts").cast("timestamp").alias("received_at"), "user_id", "event_type", "value")
    e.repartition(4, _C("event_id") % 4).write.parquet(f"{folder}/in")
    return spark.readStream.schema(spark.read.parquet(f"{folder}/in").schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")


def streamed_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row-wise gate over the stream; accepted and rejected rows are written apart, once a batch, and read together."""
    folder = shared_folder(spark)
    events = jobs.with_run(_event_stream(spark, sf_dir, folder), "1 day")
    gate = lambda df: gates.verdict(df, (_C("value") > 90, "too_high"), (_C("event_type") == "error", "error"))
    jobs.gate_stream(events, gate, f"{folder}/clean", f"{folder}/quarantine", f"{folder}/checkpoint", f"{folder}/done").awaitTermination()
    clean = spark.read.parquet(f"{folder}/clean").withColumn("reasons", F.lit(""))
    held = spark.read.parquet(f"{folder}/quarantine").withColumn("reasons", F.array_join("reasons", ","))
    return clean.unionByName(held).groupBy("run_id", "reasons").agg(F.count("*").alias("events"))


def streamed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling counts under a watermark, in complete mode at the end of the stream."""
    folder = shared_folder(spark)
    events = _event_stream(spark, sf_dir, folder).withWatermark("received_at", "40 days")
    counts = events.groupBy(F.window("received_at", "6 hours"), "event_type").agg(F.count("*").alias("events"), F.round(F.max("value"), 4).alias("top"))

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.select(F.lit(batch_id).alias("batch"), F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "events", "top").write.mode("append").parquet(f"{folder}/out")

    counts.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    return out.groupBy("start", "event_type").agg(F.max_by("events", "batch").alias("events"), F.max_by("top", "batch").alias("top"))


def streamed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly-once reading of a stream that delivers every third event twice."""
    folder = shared_folder(spark)
    e = table(spark, sf_dir, "events").select("event_id", _C("ts").cast("timestamp").alias("received_at"), "event_type")
    e.unionByName(e.where("event_id % 3 = 0")).repartition(4).write.parquet(f"{folder}/in")
    s = spark.readStream.schema(spark.read.parquet(f"{folder}/in").schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
    once = s.withWatermark("received_at", "40 days").dropDuplicatesWithinWatermark(["event_id"])
    once.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").groupBy("event_type").agg(F.count("*").alias("events"))


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def _rocks(spark: SparkSession) -> Iterator[None]:
    """Operators with states and timers need this store; the session gets its own back."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def _in_two(spark: SparkSession, rows: DataFrame, early: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What `work` makes of a stream that gets the early rows first, stops, and goes on from its checkpoint with the rest."""
    folder = shared_folder(spark)
    with _rocks(spark):
        for part in (early, f"not ({early})"):
            rows.where(part).write.mode("append").parquet(f"{folder}/in")
            stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
            work(stream).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def streamed_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's sequence rule with its cursor in state, over a stream that is stopped half way."""
    e = trades(spark, sf_dir).select((F.col("user_id") % 50).alias("stream"), "ord", "sequence", _C("metadata.subscribe_replay").alias("subscribe_replay"), ((_C("ord") * 31) % 257 + F.when(_C("day") < "2024-01-15", 0).otherwise(1000)).alias("place"))
    out = _in_two(spark, e, "place < 1000", lambda s: jobs.stateful_cursor(s, ["stream"], ["place", "ord"], ["ord"]))
    return out.select(_C("ord").alias("event_id"), F.coalesce("sequence_reason", F.lit("")).alias("reason"))


def streamed_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New and edited turns of conversations, by the hash of their whole text, over a stream that is stopped half way."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.sha2("text", 256).alias("content_hash"))
    return _in_two(spark, c, "turn < 3", lambda s: jobs.stateful_new_or_edit(s, ["conv_id"], ["turn"], ["conv_id", "turn"], None)).select("conv_id", "turn", "row_type")


def streamed_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crossed states of books that live in state, over a stream that is stopped half way."""
    d = written(depth(spark, sf_dir))  # once for the median and both parts
    half = d.agg(F.percentile_approx("ord", 0.5).alias("n")).first().n  # one number
    out = _in_two(spark, d, f"ord < {half}", lambda s: jobs.stateful_book(s, "run", "ord"))
    discard(d)
    return book.crossed_counts(out, ["key"]).select(_C("key").cast("bigint").alias("run"), "crossed_book_count")


def streamed_silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silences that end: told by the next frame, or before it by a timer on event time."""
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 50).alias("stream"), _C("ts").cast("timestamp").alias("received_at"), "event_id")
    work = lambda s: jobs.silence_timer(s.withWatermark("received_at", "1 hour"), "stream", seconds=14_400)
    told = _in_two(spark, e, "received_at < '2024-01-15'", work)
    last = e.groupBy(_C("stream").cast("string").alias("key")).agg(F.max("received_at").alias("last"))
    ms = F.unix_millis("silent_since")
    return told.join(last, "key").where(ms < F.unix_millis("last")).groupBy("key").agg(F.countDistinct(ms).alias("silences"))


def streamed_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of JSON lines as a stream: late and early claims go to quarantine with their reason, and every batch leaves metrics."""
    folder = shared_folder(spark)
    e = trades(spark, sf_dir)
    frames = e.select(F.to_json(F.struct(F.lit("venue").alias("source"), "received_at", F.to_json(F.struct("ord", F.unix_micros("exchange_time").alias("at"))).alias("payload")), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("value"))
    frames.repartition(4).write.text(f"{folder}/in")
    read = lambda k: F.get_json_object("payload", f"$.{k}").cast("bigint")
    events = jobs.frame_stream(spark, f"{folder}/in", 2).select(read("ord").alias("ord"), "received_at", F.timestamp_micros(read("at")).alias("exchange_time"))
    gated = lambda batch: jobs.delay_gate(batch).withColumn("day", F.to_date("exchange_time"))

    def write(batch: DataFrame, n: int) -> None:
        own = gated(batch)
        split(own, f"{folder}/clean", f"{folder}/held", n)
        jobs.with_metrics(lambda *_: None, f"{folder}/metrics", ["day"])(own, n)

    events.writeStream.foreachBatch(jobs.once_per_batch(write, f"{folder}/done")).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    clean = spark.read.parquet(f"{folder}/clean").groupBy("day").agg(F.count("*").alias("clean"), F.sum("ord").alias("clean_ids"))
    held = spark.read.parquet(f"{folder}/held").groupBy("day").agg(F.count_if(F.array_join("reasons", ",") == "stale_or_clock_skew").alias("held"))
    metrics = spark.read.parquet(f"{folder}/metrics").groupBy("day").agg(F.sum("raw_events").alias("raw_events"), F.sum("quarantined_events").alias("quarantined_events"))
    return metrics.join(clean, "day", "left").join(held, "day", "left").fillna(0, ["clean", "held"])


def streamed_run_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole gate and trade verdicts of accepted prints, chained in one stream that is stopped half way: a run's verdict comes when its day is over."""
    folder = shared_folder(spark)
    e = trades(spark, sf_dir).withColumn("lane", _C("user_id") % 10)
    flush = e.limit(1).withColumns({c: (F.lit("2030-01-01").cast("timestamp")).alias(c) for c in ("received_at", "exchange_time")}).withColumns({"lane": F.lit(-1).cast("bigint"), "day": F.lit("2030-01-01").cast("date"), "event_type": F.lit("click"), "channel": F.lit("trades")})
    keys, order = ["lane", "day"], ["received_at", "ord"]

    def work(s: DataFrame) -> DataFrame:
        gated = jobs.event_gate_stream(s.withWatermark("received_at", "2 days"), [*keys, "product", "channel"], order)
        return jobs.run_verdicts(gated.where("accepted and channel = 'trades'"), keys, order, F.date_add("day", 2).cast("timestamp"))

    with _rocks(spark):
        for part in (e.where("received_at < '2024-01-15'"), e.where("not (received_at < '2024-01-15')"), flush):
            part.write.mode("append").parquet(f"{folder}/in")
            stream = spark.readStream.schema(e.schema).parquet(f"{folder}/in")
            work(stream).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{folder}/out").where("lane >= 0")
    return out.select("lane", "day", "event_count", "first_trade_id", "last_trade_id", "non_monotonic_count", "trade_id_gap_count", "trade_id_gap_total_missing", "invalid_price_count", F.array_join("findings", ",").alias("findings"), "replayable")


QUERIES = {f.__name__: f for f in (streamed_gate, streamed_windows, streamed_dedup, streamed_cursor, streamed_edits, streamed_book, streamed_silence, streamed_late, streamed_run_verdicts)}

ORACLES = {
    "streamed_gate": "select strftime(date_trunc('day', ts), '%Y%m%d') || '_000000' as run_id, concat_ws(',', case when value > 90 then 'too_high' end, case when event_type = 'error' then 'error' end) as reasons, count(*) as events from events group by all",
    "streamed_windows": "select strftime(time_bucket(interval '6 hours', ts, timestamp '2000-01-01'), '%Y-%m-%d %H:%M') as start, event_type, count(*) as events, round(max(value), 4) as top from events group by all",
    "streamed_dedup": "select event_type, count(*) as events from events group by event_type",
    "streamed_cursor": f"""with {TRADES},
p as (select *, user_id % 50 as stream, (ord * 31) % 257 + case when day < date '2024-01-15' then 0 else 1000 end as place from e),
s as (select *, count(*) filter (not again) over (partition by stream order by place, ord rows between unbounded preceding and 1 preceding) > 0 as seen from p),
c as (select *, max(case when not again or seen then sequence end) over (partition by stream order by place, ord rows between unbounded preceding and 1 preceding) as cur from s)
select ord as event_id, case when again and not coalesce(sequence > cur, false) then 'subscribe_replay' when not again and sequence < cur then 'non_monotonic_sequence' else '' end as reason from c""",
    "streamed_run_verdicts": _GATE.replace("partition by user_id, day,", "partition by user_id % 10, day,") + f""",
t as (select *, user_id % 10 as lane, sequence - lag(sequence) over (partition by user_id % 10, day order by received_at, ord) as step from g where reasons = '' and channel = 'trades'),
a as (select lane, day, count(*) as event_count, arg_min(sequence, (received_at, ord)) as first_trade_id, arg_max(sequence, (received_at, ord)) as last_trade_id, count(*) filter (step < 0) as non_monotonic_count, count(*) filter (step > 1) as trade_id_gap_count,
 cast(coalesce(sum(step - 1) filter (step > 1), 0) as bigint) as trade_id_gap_total_missing, count(*) filter (not (price > 0)) as invalid_price_count, count(*) filter (abs(delay) > 60) as far from t group by all)
select * exclude (far), {_named(("non_monotonic_count > 0", "non_monotonic_trade_ids"), ("trade_id_gap_count > 0", "trade_id_gaps"), ("invalid_price_count > 0", "invalid_prices"), ("far > 0", "excessive_clock_skew"))} as findings, non_monotonic_count + trade_id_gap_count + invalid_price_count + far = 0 as replayable from a""",
    "streamed_edits": "with p as (select *, lag(text) over (partition by conv_id order by turn) as q from conversations) select conv_id, turn, case when q is null then 'new' else 'edit' end as row_type from p where q is null or q <> text",
    "streamed_book": CROSSED,
    "streamed_silence": "with g as (select user_id % 50 as k, ts, lead(ts) over (partition by user_id % 50 order by ts, event_id) as nxt from events) select cast(k as varchar) as key, count(distinct epoch_us(ts) // 1000) as silences from g where epoch_us(nxt) // 1000 - epoch_us(ts) // 1000 > 14400000 group by 1",
    "streamed_late": f"""with {TRADES} select day, count(*) as raw_events, count(*) filter (delay > 60 or delay < -5) as quarantined_events, count(*) filter (delay <= 60 and delay >= -5) as clean, cast(sum(ord) filter (delay <= 60 and delay >= -5) as bigint) as clean_ids, count(*) filter (delay > 60 or delay < -5) as held from e group by day""",
}

"""Queries of curation, manifests, quotes, texts, health, retention and layout over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import curation, gates, health, quotes, verdicts
from ..sources import scans, sinks
from ..sources.tables import written
from .inputs import RUNS, TRADES, order_runs, shared_folder, table, trades

_C = F.col


def _quarantined(runs: DataFrame) -> DataFrame:
    return runs.where("o_custkey % 7 = 0").select("run_path")


def _promoted(runs: DataFrame) -> DataFrame:
    return runs.where("o_custkey % 5 = 0").select("run_path")


def promotion_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = order_runs(spark, sf_dir)
    return curation.promotion_actions(runs, _quarantined(runs), _promoted(runs)).select("run_path", "action")


def quarantine_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = order_runs(spark, sf_dir)
    return curation.quarantine_actions(runs, _quarantined(runs)).select("run_path", "action")


def promoted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = order_runs(spark, sf_dir)
    actions = curation.promotion_actions(runs, _quarantined(runs), _promoted(runs))
    rows = curation.promoted_rows(table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "run_path"), actions, F.lit("2026-01-01").cast("date"), "tag")
    return rows.groupBy("source_run_path", "promotion_tag").agg(F.count("*").alias("rows"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as lines of a promotion index."""
    li = table(spark, sf_dir, "lineitem")
    return li.select((_C("l_orderkey") % 5000).alias("run_path"), _C("l_shipdate").cast("timestamp").alias("promoted_at"), (_C("l_orderkey") * 1000 + _C("l_linenumber") * 100 + _C("l_quantity").cast("bigint")).alias("ord"), _C("l_partkey").alias("promoted_rows"), F.when(_C("l_linenumber") == 7, "torn").alias("corrupt"))


def promotion_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _index(spark, sf_dir).where("corrupt is null").groupBy("run_path", "promoted_at", "ord").agg(F.max("promoted_rows").alias("promoted_rows"))
    return curation.latest_index(i).select("run_path", F.date_format("promoted_at", "yyyy-MM-dd").alias("promoted_at"), "promoted_rows")


def promotion_index_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a run, without one (null, empty) and torn ones."""
    line = _C("l_linenumber")
    li = table(spark, sf_dir, "lineitem").select(F.when(line == 5, None).when(line == 6, "").otherwise((_C("l_orderkey") % 5000).cast("string")).alias("run_path"), F.when(line == 7, "torn").alias("corrupt"))
    return curation.index_stats(li)


def promotion_rollup_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollups by day, of the index lines up to 1996 first, then of the days again that later lines came in for."""
    li = table(spark, sf_dir, "lineitem").where("l_linenumber <> 7")
    index = li.select((_C("l_orderkey") % 5000).alias("run_path"), F.to_date(F.timestamp_seconds((_C("l_orderkey") % 5000 % 60) * 86_400)).alias("day"), _C("l_shipdate").cast("timestamp").alias("promoted_at"), (_C("l_orderkey") * 1000 + _C("l_linenumber") * 100 + _C("l_quantity").cast("bigint")).alias("ord"), _C("l_partkey").alias("promoted_rows"))
    index = index.groupBy("run_path", "day", "promoted_at", "ord").agg(F.max("promoted_rows").alias("promoted_rows"))
    early, path = _C("promoted_at") < F.lit("1997-01-01").cast("timestamp"), shared_folder(spark)
    curation.refresh_days(index.where(early), index.where(early), path)
    curation.refresh_days(index, index.where(~early), path)
    return spark.read.parquet(path).select("day", "promoted_runs", "promoted_rows", F.date_format("latest_promotion", "yyyy-MM-dd").alias("latest_promotion"))


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lane days: promoted from orders in full, verdicts from orders of even customers only."""
    runs = order_runs(spark, sf_dir)
    index = runs.where("replayable").select("lane", "day", F.floor("o_totalprice").cast("bigint").alias("promoted_rows"), _C("started_at").alias("promoted_at"))
    seen = runs.where("o_custkey % 2 = 0").withColumns({"gap_count": _C("o_custkey") % 3, "snapshot_gap_count": F.lit(0), "crossed_book_count": _C("o_custkey") % 4, "gap_detection": F.when(_C("run_path") % 4 == 0, "checksum").when(_C("run_path") % 4 == 1, "sequence").when((_C("run_path") % 4 == 2) & (_C("lane") == "LOW"), "none_native")})
    keys = ["lane", "day"]
    return curation.day_views(curation.promotion_rollup(index, keys), curation.replay_rollup(seen, keys, "run_path"), keys, F.lit("1995-06-17").cast("date"))


def readiness_by_lane_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _days(spark, sf_dir).select("lane", "day", "promoted_runs", "promoted_rows", "summaries", "missing_summaries", "replayable_runs", "unreplayable_runs", "gap_runs", "crossed_runs", "gap_detection", "readiness", F.array_join("notes", ",").alias("notes"))


def worst_class_latch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.lane_views(_days(spark, sf_dir))


def lane_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lanes = worst_class_latch(spark, sf_dir).withColumns({"venue": F.substring("lane", 1, 1), "dataset": F.lit("trades")})
    out = curation.lane_summary(lanes)
    return out.withColumns({c: F.array_join(c, ",") for c in ("venues", "datasets")})


def day_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.day_summary(_days(spark, sf_dir))


def runs_to_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = order_runs(spark, sf_dir)
    known = runs.where("o_custkey % 3 = 0")
    return verdicts.runs_to_score(runs, known, ["run_path"], F.lit("1998-01-01").cast("timestamp"), min_age_seconds=0).groupBy("action").agg(F.count("*").alias("runs"))


def book_sync_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = order_runs(spark, sf_dir).withColumns({"gap_count": _C("o_custkey") % 3, "crossed_book_count": _C("o_custkey") % 4})
    return verdicts.sync_health(v, "lane", "run_path", limit=50)


def finding_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = verdicts.trades(trades(spark, sf_dir), ["user_id", "day"], ["ord"]).withColumn("lane", _C("user_id") % 4)
    return verdicts.finding_histogram(v)


def scoring_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as runs, those of every third customer scored; of the next 40 open ones a lane, those without a status fail."""
    runs = order_runs(spark, sf_dir).withColumnRenamed("run_path", "run_id")
    found = F.array_compact(F.array(F.when(_C("o_custkey") % 4 == 1, F.lit("gap")), F.when(_C("o_custkey") % 5 == 2, F.lit("crossed"))))
    given = runs.where("replayable is not null").select("lane", "run_id", "replayable", found.alias("findings"))
    work = verdicts.scoring_worklist(runs, runs.where("o_custkey % 3 = 0"), F.lit("1998-01-01").cast("timestamp"), 40, 1500 * 86_400)
    out = verdicts.scoring_report(work, given)
    return out.withColumn("findings", F.coalesce(F.array_join(F.transform("findings", lambda x: F.concat_ws(":", x["finding"], x["runs"])), ","), F.lit("")))


def quarantine_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs quarantined in two batches, the first delivered twice, a third without its marker, then compacted: what readers see."""
    runs, root = order_runs(spark, sf_dir), shared_folder(spark)
    actions = curation.quarantine_actions(runs, _quarantined(runs))
    given = runs.select("run_path", "replayable", F.array_compact(F.array(F.lit("unreplayable"), F.when(_C("o_custkey") % 4 == 1, F.lit("gap")))).alias("findings"))
    lines = table(spark, sf_dir, "lineitem").select(_C("l_orderkey").alias("run_path"), "l_linenumber", "l_partkey")
    bundle = lambda part: curation.quarantine_bundle(actions.where(part), given, lines, F.lit("2026-01-01").cast("timestamp"), ["l_linenumber", "l_partkey"])
    for batch, part in (("1", "run_path % 3 = 0"), ("1", "run_path % 3 = 0"), ("2", "run_path % 3 = 1")):
        curation.commit(bundle(part), root, batch)
    for name, rows in bundle("run_path % 3 = 2").items():
        rows.write.parquet(f"{root}/{name}/batch=3")
    curation.compact_batches(spark, root, ["verdict", "samples", "index"], "compact-1")
    index, samples = (curation.committed(spark, root, n) for n in ("index", "samples"))
    out = index.join(samples.select("run_path", F.size("samples").alias("samples")), "run_path", "left")
    return out.select("run_path", F.array_join("findings", ",").alias("findings"), F.coalesce("samples", F.lit(0)).alias("samples"), "batch")


def promotion_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs promoted in two batches, the first of which comes twice: rows and the index lines that make them count, behind one marker."""
    runs, root = order_runs(spark, sf_dir), shared_folder(spark)
    actions = curation.promotion_actions(runs, _quarantined(runs), _promoted(runs))
    rows = written(curation.promoted_rows(table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "run_path"), actions, F.lit("2026-01-01").cast("date"), "tag"))  # joined once for all batches
    for batch, part in (("1", "run_path % 2 = 0"), ("1", "run_path % 2 = 0"), ("2", "run_path % 2 = 1")):
        own = rows.where(part)
        curation.commit({"rows": own, "index": own.groupBy("run_path").agg(F.count("*").alias("promoted_rows"))}, root, batch)
    data, index = (curation.committed(spark, root, n) for n in ("rows", "index"))
    kept = data.groupBy("run_path", "batch").agg(F.round(F.sum("l_quantity"), 2).alias("quantity"))
    return index.join(kept, ["run_path", "batch"])


def quarantine_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = order_runs(spark, sf_dir)
    return curation.quarantine_report(curation.quarantine_actions(runs, _quarantined(runs))).withColumn("findings", F.array_join("findings", ","))


def offload_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lane on disk is not configured, one configured lane has no runs."""
    runs = order_runs(spark, sf_dir)
    policy = _policy(spark, sf_dir).drop("max_age_days").where("lane <> 'MEDIUM'")
    policy = policy.unionByName(table(spark, sf_dir, "region").where("r_regionkey = 0").select(F.lit("ARCHIVE").alias("lane"), F.lit(9).alias("lane_rank"), F.lit(900).alias("min_age_days"), F.lit("indexed").alias("gate")))
    plan = curation.offload_plan(runs, _promoted(runs), _quarantined(runs), policy, F.lit("1998-08-02").cast("timestamp"), 1500)
    return curation.offload_report(plan, policy, runs).withColumn("findings", F.array_join("findings", ","))


def zero_byte_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    listing = o.select(F.concat(F.lit("part-"), _C("o_orderkey").cast("string"), F.when(_C("o_orderkey") % 5 == 0, ".json").otherwise(".parquet")).alias("file"), F.when(_C("o_custkey") % 9 == 0, 0).otherwise(_C("o_custkey")).cast("bigint").alias("bytes"))
    return curation.empty_parquet(listing)


def recent_high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as runs of a lane and day; a lane's stream is one of three symbols, and its current run is the latest day."""
    e = table(spark, sf_dir, "events").select((_C("user_id") % 7).alias("lane"), F.to_date("ts").alias("run_id"), F.concat(F.lit("P"), (_C("user_id") % 5).cast("string")).alias("symbol"), F.when(_C("event_id") % 4 != 0, _C("event_id")).alias("sequence"))
    listing = e.select("lane", "run_id", _C("run_id").cast("timestamp").alias("started_at")).distinct()
    now = F.lit("2024-01-30 23:59:59").cast("timestamp")
    streams = e.groupBy("lane").agg(F.max("run_id").alias("current_run")).select("lane", F.concat(F.lit("P"), (_C("lane") % 5).cast("string")).alias("symbol"), "current_run")
    return gates.recent_high_water(listing, e, streams, now, 20 * 86_400, 10)


def run_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    out = curation.sample_rows(e, ["user_id"], ["event_id"], 5)
    return out.select("user_id", F.array_join(F.transform("samples", lambda x: F.concat(x["event_id"].cast("string"), x["event_type"])), ",").alias("samples"))


def curated_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return curation.curated_once(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_quantity"])


def promoted_per_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = order_runs(spark, sf_dir).select("run_path", "lane", _C("run_path").alias("run_id"))
    return curation.promoted_per_run(scans.recent_runs(runs, 100), _index(spark, sf_dir)).select("run_path", "lane", "promoted_rows")


def _quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as quotes of users' symbols: the id is the value's bucket."""
    e = table(spark, sf_dir, "events")
    return e.select(_C("event_id"), F.when(_C("event_id") % 71 != 0, F.concat(F.lit("S"), _C("user_id").cast("string"))).alias("symbol"), F.sha2(F.floor(_C("value") / 40).cast("string"), 256).alias("quote_id"), _C("ts").cast("timestamp").alias("sampled_at"))


def quote_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quotes.quote_states(_quotes(spark, sf_dir).where("symbol is not null"), ["sampled_at", "event_id"], stale_seconds=36_000)
    return q.select("event_id", "quote_first_observed", "quote_changed", "quote_repeated", F.round("quote_age_ms").cast("bigint").alias("quote_age_ms"), "quote_stale")


def quote_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = quotes.quote_states(_quotes(spark, sf_dir), ["sampled_at", "event_id"], stale_seconds=36_000)
    return quotes.quote_summary(states, ["sampled_at", "event_id"])


def quote_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quotes.quote_states(_quotes(spark, sf_dir).where("symbol is not null"), ["sampled_at", "event_id"], stale_seconds=36_000)
    return quotes.quote_counters(q.withColumn("day", F.to_date("sampled_at")), ["day"])


def _markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """parts as market objects: bids and asks in cents or dollars, some without an ask."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a small file is one task's, and much is made of each of its rows
    p = table(spark, sf_dir, "part").select("p_partkey").repartition(parts, "p_partkey")
    k = _C("p_partkey")
    item = F.to_json(F.struct(F.concat(F.lit("t"), k.cast("string")).alias("ticker"), F.concat(F.lit("s"), (k % 20).cast("string")).alias("series_ticker"), F.when(k % 4 == 0, "closed").otherwise("active").alias("status"), (k % 50 + 1).alias("yes_bid"), F.when(k % 9 != 0, k % 50 + 2).alias("yes_ask"), F.format_string("%.2f", (k % 80) / 100).alias("no_ask_dollars"), (k % 7).alias("yes_ask_size")))
    return quotes.market_candidates(p.select("p_partkey", item.alias("item")), F.lit("2026-01-01").cast("timestamp"))


def market_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = quotes.open_markets(_markets(spark, sf_dir)).withColumn("sampled_at", F.lit("2026-01-01").cast("timestamp"))
    return quotes.quote_rows(m).select("symbol", "bid", "ask", F.round("payout_ratio", 6).alias("payout_ratio"), "quote_id")


def market_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series of 20 groups of parts; a title names the asset, the label is one of four."""
    k = _C("k")
    labels = F.array(*map(F.lit, ("hourly", "daily", "weekly", "fifteen_min")))
    series = table(spark, sf_dir, "part").select((_C("p_partkey") % 20).alias("k")).distinct().select(F.to_json(F.struct(F.concat(F.lit("s"), k.cast("string")).alias("ticker"), F.when(k % 3 == 0, "Bitcoin btc price").otherwise("other").alias("title"), F.get(labels, (k % 4).cast("int")).alias("frequency"))).alias("item"))
    out = quotes.discovery(quotes.series_candidates(series, ["BTC", "ETH"]), _markets(spark, sf_dir), ["hourly", "daily", "weekly"])
    return out.select("ticker", "frequency_seconds", "open_markets", "empty_best_asks", F.array_join("findings", ",").alias("findings"))


def text_content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", S.content_hash(_C("lang"), _C("text"), F.when(_C("doc_id") % 3 == 0, None).otherwise(_C("source"))).alias("content_hash"))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as text items: a source is a lane, 500 ids a run of each; equal texts have equal keys."""
    d = table(spark, sf_dir, "documents")
    t = lambda s: F.timestamp_seconds(s)
    seen = t(1_700_000_000 + _C("doc_id") * 60 - F.when(_C("doc_id") % 113 == 0, 600).otherwise(0))
    return d.select(_C("source").alias("lane"), F.floor(_C("doc_id") / 500).alias("run"), _C("doc_id").alias("ord"), _C("lang").alias("source"), F.when(_C("doc_id") % 4 == 0, "edit").otherwise("new").alias("event_type"), F.when(_C("doc_id") % 59 != 0, F.sha2(F.coalesce("text", F.lit("")), 256)).alias("source_id"), seen.alias("ingestion_ts"), seen.alias("received_at"), F.when(_C("doc_id") % 10 != 0, t(1_700_000_000 + _C("doc_id") * 60 - (_C("doc_id") % 5000) + 400)).alias("source_ts"), F.lit("h").alias("content_hash"), F.struct((_C("doc_id") % 20 == 0).alias("source_ts_unparseable")).alias("metadata"))


def text_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = verdicts.text(_items(spark, sf_dir), ["lane", "run"], ["ord"])
    return v.select("lane", "run", "event_count", "new_count", "edit_count", "non_monotonic_ingestion_count", "missing_envelope_count", "duplicate_key_count", "missing_source_ts_count", "unparseable_source_ts_count", "stale_source_ts_count", "future_source_ts_count", _C("max_source_lag_seconds").cast("bigint").alias("max_source_lag_seconds"), F.array_join("findings", ",").alias("findings"), "replayable")


def text_read_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _items(spark, sf_dir).where("source_id is not null")
    return quotes.read_once(i, tie=["ord"]).select("ord", "source")


def text_new_edit(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").withColumn("content_hash", S.content_hash(_C("text")))
    return quotes.new_or_edit(c, ["conv_id"], ["turn"]).select("conv_id", "turn", "row_type")


def seen_state_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("source", (_C("doc_id") % 400).alias("item"), "doc_id", S.content_hash(_C("text")).alias("content_hash"))
    return quotes.seen_state(d, "source", "item", "doc_id", cap=10).select("source", "item", "doc_id", "content_hash", _C("recency").cast("bigint").alias("recency"))


def seen_state_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of even documents, as far as its rows stand in clean (two thirds do), goes on with odd ones; ten items a source at each time."""
    d = table(spark, sf_dir, "documents").select("source", (_C("doc_id") % 400).alias("item"), "doc_id", S.content_hash(_C("text")).alias("content_hash"))
    start = quotes.seen_state(d.where("doc_id % 2 = 0"), "source", "item", "doc_id", cap=10)
    start = quotes.proven_state(start, d.where("doc_id % 2 = 0 and doc_id % 3 <> 0"), "source", "item")
    out = quotes.seen_state(d.where("doc_id % 2 = 1"), "source", "item", "doc_id", cap=10, start=start)
    return out.select("source", "item", "doc_id", "content_hash", _C("recency").cast("bigint").alias("recency"))


def _run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    c = lambda x: F.count_if(_C("event_type") == x)
    return e.groupBy((_C("user_id") % 7).alias("lane"), F.to_date("ts").alias("run_id")).agg(F.count("*").alias("raw_events"), c("click").alias("clean_events"), (c("error") + c("signup")).alias("quarantined_events"), c("signup").alias("subscribe_replay"))


def clean_ratio_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _run_metrics(spark, sf_dir).withColumns({"replayable": F.dayofmonth("run_id") % 2 == 0, "scored_at": _C("run_id").cast("timestamp")})
    out = health.lane_quality(runs, F.lit("2024-01-30 12:00:00").cast("timestamp"), max_age_seconds=36_000)
    return out.select("lane", "runs", "raw_events", "clean_events", "quarantined_events", "latest_replayable", F.round("clean_ratio", 6).alias("clean_ratio"), "low_streak", F.array_join("findings", ",").alias("findings"))


def quarantine_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.quarantine_ratio(_run_metrics(spark, sf_dir), ["lane"]).withColumn("ratio", F.round("ratio", 6))


def _job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select((_C("user_id") % 40).alias("job"), (_C("user_id") % 5).alias("family"), _C("ts").cast("timestamp").alias("finished_at"), F.when(_C("event_type") == "error", "failed").otherwise("ok").alias("status"), (_C("user_id") % 3 * 600 + 300).alias("interval_seconds"), F.lit(900).alias("segment_seconds"), "event_id")


def job_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _job_log(spark, sf_dir)
    out = health.job_freshness(log, F.lit("2024-01-30 00:00:00").cast("timestamp"))
    return out.select("job", F.floor("age_seconds").cast("bigint").alias("age_seconds"), "stale")


def recent_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit("2024-01-30 00:00:00").cast("timestamp")
    return health.recent_failures(_job_log(spark, sf_dir).where(_C("finished_at") <= now), now, seconds=86_400).select("family", "failures")


def silence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("at", _C("ts").cast("timestamp"))
    return health.silences(e, ["user_id"], "at", 43_200, ["event_id"]).select("user_id", "event_id", F.floor("silence_seconds").cast("bigint").alias("silence_seconds"))


def _policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    lanes = order_runs(spark, sf_dir).select("lane").distinct()
    return lanes.select("lane", F.length("lane").alias("lane_rank"), F.when(_C("lane") == "LOW", 400).otherwise(900).alias("min_age_days"), F.when(_C("lane") == "URGENT", "age_only").otherwise("indexed").alias("gate"), F.when(_C("lane") == "LOW", 500).alias("max_age_days"))


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = order_runs(spark, sf_dir)
    return curation.offload_plan(runs, _promoted(runs), _quarantined(runs), _policy(spark, sf_dir).drop("max_age_days"), F.lit("1998-08-02").cast("timestamp"), 1500)


def retention_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).groupBy("lane", "state").agg(F.count("*").alias("runs"), F.min("run_path").alias("first_run"))


def stuck_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.stuck_by_lane(_plan(spark, sf_dir)).select("lane", "stuck", F.array_join("examples", ",").alias("examples"))


def retention_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = order_runs(spark, sf_dir).withColumn("bytes", F.floor("o_totalprice").cast("bigint"))
    out = curation.retention_candidates(runs, _policy(spark, sf_dir).select("lane", "max_age_days"), F.lit("1998-08-02").cast("timestamp"), 700)
    return out.groupBy("lane").agg(F.count("*").alias("runs"), F.sum("bytes").alias("bytes"))


def lane_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_disk = table(spark, sf_dir, "customer").select(F.concat(F.lit("lane"), (_C("c_custkey") % 30).cast("string")).alias("lane"))
    configured = table(spark, sf_dir, "nation").select(F.concat(F.lit("lane"), (_C("n_nationkey") * 2).cast("string")).alias("lane"))
    return curation.lane_differences(on_disk, configured)


def copy_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(_C("o_orderkey").alias("file"), _C("o_custkey").alias("bytes"))
    copy = o.where("file % 11 <> 0").select("file", F.when(_C("file") % 13 == 0, _C("bytes") + 1).otherwise(_C("bytes")).alias("bytes")).union(o.where("file % 17 = 0").select(-_C("file") - 1, "bytes"))
    return curation.copy_differences(o, copy).select("file", "problem")


def growth_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    counts = e.groupBy((_C("user_id") % 6).alias("lane"), F.to_date("ts").alias("reported_at")).agg(F.count_if(_C("event_type") == "error").alias("stuck"))
    return curation.growth_alert(counts, 10)


def partition_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", _C("p_name").alias("product"), F.concat(F.lit("src/"), (_C("p_partkey") % 3).cast("string")).alias("source"), F.timestamp_seconds(_C("p_partkey") * 86_400).alias("received_at"), F.lit(None).cast("timestamp").alias("event_time"))
    return sinks.with_partitions(p).select("p_partkey", "schema_version", "source", "instrument", "event_date")


def resume_high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("sequence", _C("event_id"))
    top = gates.high_water(e, ["user_id"])
    last = e.groupBy("user_id").agg(F.max("ts").cast("timestamp").alias("updated_at"))
    k = _C("user_id") % 5
    streams = top.join(last, "user_id").select("user_id", F.lit("BTCUSDT").alias("symbol"), F.when(k == 0, None).when(k == 1, "other").otherwise("btcusdt").alias("cursor_symbol"), F.when(k > 1, _C("high_water") - 5).alias("last_id"), F.when(k != 0, _C("updated_at")).alias("updated_at"), F.when(k == 3, _C("high_water")).alias("floor"))
    out = gates.resume_rule(streams, F.lit("2024-01-30 23:59:59").cast("timestamp"), 43_200)
    return out.select("user_id", "next_id", "reset")


def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages as feeds: an RSS item whose description is the page's HTML, or an Atom entry for every third page, with prefixed tags for every ninth."""
    k = _C("page_id")
    text = lambda c: F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    p = table(spark, sf_dir, "pages").select("page_id", text(F.replace(_C("url"), F.lit('"'), F.lit(""))).alias("url"), text(F.regexp_replace("html", r"[\x00-\x20\x7F-\x9F\x{FFFE}\x{FFFF}]+", " ")).alias("html"))
    rss = F.concat(F.lit('<?xml version="1.0"?><rss><channel><item><title>t &amp; '), k.cast("string"), F.lit("</title><link>"), "url", F.lit("</link><description>"), "html", F.lit("</description></item></channel></rss>"))
    tag = lambda name: F.concat(F.when(k % 9 == 0, "a:").otherwise(""), F.lit(name))
    near = lambda name, *inner: F.concat(F.lit("<"), tag(name), F.lit(">"), *inner, F.lit("</"), tag(name), F.lit(">"))
    entry = near("entry", near("id", F.lit("e"), k.cast("string")), near("title", F.lit("<![CDATA[a < b]]>")), F.lit("<"), tag("link"), F.lit(' href="'), _C("url"), F.lit('"/>'), near("summary", _C("html")), near("updated", F.lit("2026")))
    atom = F.concat(F.lit("<"), tag("feed"), F.when(k % 9 == 0, F.lit(' xmlns:a="http://www.w3.org/2005/Atom">')).otherwise(' xmlns="http://www.w3.org/2005/Atom">'), entry, F.lit("</"), tag("feed"), F.lit(">"))
    bodies = p.select("page_id", F.when(k % 3 == 0, atom).otherwise(rss).alias("body"))
    out = scans.feed_items(bodies)
    return out.select("page_id", "dialect", "source_id", "title", "link", F.sha2(F.coalesce("summary", F.lit("")), 256).alias("summary_sha256"), "source_ts_raw")


def listing_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's lines as a listing body, exploded again; odd entries are no objects."""
    li = table(spark, sf_dir, "lineitem")
    child = F.when(_C("l_linenumber") == 6, F.struct(F.lit(None).cast("struct<part:bigint>").alias("data"))).otherwise(F.struct(F.struct(_C("l_partkey").alias("part")).alias("data")))
    bodies = li.groupBy("l_orderkey").agg(F.to_json(F.struct(F.struct(F.collect_list(child).alias("children")).alias("data"))).alias("body"))
    out = scans.listing_children(bodies)
    return out.groupBy("l_orderkey").agg(F.count("*").alias("items"), F.sum(F.get_json_object("item", "$.part").cast("bigint")).alias("parts"))


def page_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' orders as API pages, the first five objects of each in page order."""
    o = table(spark, sf_dir, "orders")
    pages = o.groupBy("o_custkey", (_C("o_orderkey") % 4).alias("page")).agg(F.to_json(F.struct(F.struct(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: F.struct(k.alias("k"))).alias("markets")).alias("payload"))).alias("body"))
    return scans.api_rows(pages, "payload.markets", ["o_custkey"], 5).select("o_custkey", F.get_json_object("item", "$.k").cast("bigint").alias("k"))


def lane_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _C("s_suppkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("v"), (k % 5).cast("string"), F.when(k % 2 == 0, "_perp").otherwise(""), F.when(k % 7 == 0, "_odd").otherwise("_depth"), F.when(k % 3 == 0, "_btc_usd").otherwise("")).alias("lane"))
    return s.withColumn("p", S.lane_parts(_C("lane"))).select("s_suppkey", "p.venue", "p.dataset", "p.instrument")


QUERIES = {f.__name__: f for f in (promotion_actions, quarantine_actions, promoted_rows, promotion_index_dedup, promotion_index_stats, readiness_by_lane_day, worst_class_latch, lane_summary, day_summary, runs_to_score, book_sync_health, finding_histogram, run_samples, curated_once, promoted_per_run, quote_states, quote_transitions, quote_counters, market_quotes, market_discovery, text_content_hash, text_verdict, text_read_once, text_new_edit, seen_state_cap, seen_state_resumed, clean_ratio_streak, quarantine_ratio, job_freshness, recent_failures, silence_gaps, retention_plan, stuck_accounting, retention_candidates, lane_differences, copy_differences, growth_alert, partition_layout, resume_high_water, feed_items, listing_children, page_cap, lane_names, promotion_rollup_days, scoring_report, quarantine_commit, promotion_commit, quarantine_report, offload_report, zero_byte_files, recent_high_water)}


def _named(*pairs: tuple[str, str]) -> str:
    return "concat_ws(',', " + ", ".join(f"case when {c} then '{n}' end" for c, n in pairs) + ")"


_ACTION = "case when replayable is null then 'missing_replay' when o_custkey % 7 = 0 then 'quarantined' when not replayable then 'unreplayable' when o_custkey % 5 = 0 then 'already_promoted' when not has_events then 'missing_events' else 'promote' end"
_INDEX = "i as (select l_orderkey % 5000 as run_path, l_shipdate as promoted_at, l_orderkey * 1000 + l_linenumber * 100 + cast(l_quantity as bigint) as ord, l_partkey as promoted_rows, l_linenumber = 7 as torn from lineitem)"
_DAYS = f"""with {RUNS},
p as (select lane, day, count(*) as promoted_runs, sum(cast(floor(o_totalprice) as bigint)) as promoted_rows from r where replayable group by all),
v as (select *, case when run_path % 4 = 0 then 'checksum' when run_path % 4 = 1 then 'sequence' when run_path % 4 = 2 and lane = 'LOW' then 'none_native' end as gd from r where o_custkey % 2 = 0),
s as (select lane, day, count(replayable) as summaries, count(*) filter (replayable is null) as missing_summaries, count(*) filter (replayable) as replayable_runs, count(*) filter (not replayable) as unreplayable_runs,
 count(*) filter (o_custkey % 3 > 0) as gap_runs, count(*) filter (o_custkey % 4 > 0) as crossed_runs, arg_max(gd, run_path) filter (gd is not null) as gap_detection from v group by all),
j as (select lane, day, coalesce(promoted_runs, 0) as promoted_runs, cast(coalesce(promoted_rows, 0) as bigint) as promoted_rows, coalesce(summaries, 0) as summaries, coalesce(missing_summaries, 0) as missing_summaries, coalesce(replayable_runs, 0) as replayable_runs,
 coalesce(unreplayable_runs, 0) as unreplayable_runs, coalesce(gap_runs, 0) as gap_runs, coalesce(crossed_runs, 0) as crossed_runs, gap_detection from p full join s using (lane, day)),
d as (select *, case when day = date '1995-06-17' then 'building' when promoted_runs > 0 and unreplayable_runs + missing_summaries > 0 then 'ready_with_quarantine' when promoted_runs > 0 then 'ready' else 'missing' end as readiness,
 {_named(("unreplayable_runs > 0", "raw_has_unreplayable_runs"), ("missing_summaries > 0", "missing_replay_summaries"), ("promoted_runs = 0", "no_promoted_runs"))} as notes from j),
l as (select lane, count(*) filter (readiness = 'ready') as ready_days, count(*) filter (readiness = 'ready_with_quarantine') as ready_with_quarantine_days, count(*) filter (readiness = 'building') as building_days, count(*) filter (readiness = 'missing') as missing_days,
 cast(sum(promoted_rows) as bigint) as curated_rows, cast(sum(promoted_runs) as bigint) as promoted_runs, max(day) filter (starts_with(readiness, 'ready')) as latest_ready_day,
 coalesce((['none_native', 'checksum', 'sequence'])[min(case gap_detection when 'none_native' then 1 when 'checksum' then 2 when 'sequence' then 3 end)], 'unknown') as gap_detection from d group by lane)"""
_QUOTE = """with q0 as (select event_id, case when event_id % 71 <> 0 then 'S' || user_id end as symbol, cast(floor(value / 40) as bigint) as b, ts from events),
q1 as (select *, lag(b) over w as p from q0 window w as (partition by symbol order by ts, event_id)),
q2 as (select *, p is null as first_, p is not null and p <> b as changed, coalesce(p = b, false) as repeated from q1),
q as (select *, cast(date_diff('microsecond', last_value(case when not repeated then ts end ignore nulls) over (partition by symbol order by ts, event_id rows between unbounded preceding and current row), ts) / 1000 as double) as age from q2)"""
_MARKET = """m as (select p_partkey as k, 't' || p_partkey as ticker, 's' || (p_partkey % 20) as series, p_partkey % 4 <> 0 as is_open, (p_partkey % 50 + 1) / 100 as yes_bid, case when p_partkey % 9 <> 0 then (p_partkey % 50 + 2) / 100 end as yes_ask, (p_partkey % 80) / 100 as no_ask, p_partkey % 7 as size from part)"""
_METRICS = "m as (select user_id % 7 as lane, cast(ts as date) as run_id, count(*) as raw_events, count(*) filter (event_type = 'click') as clean_events, count(*) filter (event_type in ('error', 'signup')) as quarantined_events, count(*) filter (event_type = 'signup') as subscribe_replay from events group by all)"
_PLAN = f"""with {RUNS},
o as (select *, case when lane = 'LOW' then 400 else 900 end as least, lane = 'URGENT' or o_custkey % 5 = 0 or o_custkey % 7 = 0 as ok from r),
g as (select * from o where date_diff('second', started_at, timestamp '1998-08-02') > least * 86400),
n as (select lane, count(*) as n from g where ok group by lane),
a as (select x.lane, coalesce((select sum(n) from n y where (length(y.lane), y.lane) < (length(x.lane), x.lane)), 0) as ahead from n x),
p as (select *, row_number() over (partition by lane, ok order by started_at, run_path) as place from g),
t as (select p.*, case when not ok then 'stuck' when ahead + place <= 1500 then 'move' else 'wait' end as state from p left join a using (lane))"""

ORACLES = {
    "promotion_actions": f"with {RUNS} select run_path, {_ACTION} as action from r",
    "quarantine_actions": f"with {RUNS} select run_path, case when replayable is null then 'missing_replay' when replayable then 'replayable' when o_custkey % 7 = 0 then 'already_quarantined' else 'quarantine' end as action from r",
    "promoted_rows": f"with {RUNS} select run_path as source_run_path, 'tag' as promotion_tag, count(*) as rows, round(sum(l_quantity), 2) as quantity from r join lineitem on l_orderkey = run_path where {_ACTION} = 'promote' group by run_path",
    "promotion_index_dedup": f"with {_INDEX}, u as (select run_path, promoted_at, ord, max(promoted_rows) as promoted_rows from i where not torn group by all) select run_path, strftime(max(promoted_at), '%Y-%m-%d') as promoted_at, arg_max(promoted_rows, (promoted_at, ord)) as promoted_rows from u group by run_path",
    "promotion_index_stats": """with i as (select case l_linenumber when 5 then null when 6 then '' else cast(l_orderkey % 5000 as varchar) end as run_path, l_linenumber = 7 as torn from lineitem),
n as (select run_path, count(*) as n from i where not torn and coalesce(run_path, '') <> '' group by run_path)
select cast(sum(n) as bigint) as raw_entries, count(*) as runs, cast(sum(n - 1) as bigint) as duplicate_entries, count(*) filter (n > 1) as duplicate_runs, (select count(*) from i where torn) as corrupt_entries from n""",
    "promotion_rollup_days": f"""with {_INDEX}, u as (select run_path, promoted_at, ord, max(promoted_rows) as promoted_rows from i where not torn group by all),
l as (select run_path, max(promoted_at) as latest, arg_max(promoted_rows, (promoted_at, ord)) as n from u group by run_path)
select cast(date '1970-01-01' + cast(run_path % 60 as integer) as date) as day, count(*) as promoted_runs, cast(sum(n) as bigint) as promoted_rows, strftime(max(latest), '%Y-%m-%d') as latest_promotion from l group by 1""",
    "scoring_report": f"""with {RUNS},
young as (select * from r where has_events and date_diff('second', started_at, timestamp '1998-01-01') <= 1500 * 86400),
walk as (select *, o_custkey % 3 = 0 as scored, count(*) filter (o_custkey % 3 <> 0) over (partition by lane order by run_path desc rows between unbounded preceding and current row) as met from young),
done as (select *, not scored as todo from walk where (not scored and met <= 40) or (scored and met < 40)),
f as (select lane, finding, count(*) as n from (select lane, unnest(case when replayable is null then ['replay_error'] when not replayable then list_concat(['gap'][:case when o_custkey % 4 = 1 then 1 else 0 end], ['crossed'][:case when o_custkey % 5 = 2 then 1 else 0 end]) else [] end) as finding from done where todo) group by all)
select lane, count(*) filter (todo and replayable is not null) as scanned, count(*) filter (todo and replayable) as replayable, count(*) filter (todo and not replayable) as not_replayable, count(*) filter (not todo) as skipped_already_scored,
 coalesce((select string_agg(finding || ':' || n, ',' order by finding) from f where f.lane = done.lane), '') as findings from done group by lane""",
    "quarantine_commit": f"""with {RUNS}, q as (select * from r where not replayable and o_custkey % 7 <> 0 and run_path % 3 <> 2), n as (select l_orderkey as run_path, least(count(*), 5) as n from lineitem group by 1)
select run_path, case when o_custkey % 4 = 1 then 'unreplayable,gap' else 'unreplayable' end as findings, cast(coalesce(n, 0) as integer) as samples, 'compact-1' as batch from q left join n using (run_path)""",
    "promotion_commit": f"with {RUNS} select run_path, cast(run_path % 2 + 1 as varchar) as batch, count(*) as promoted_rows, round(sum(l_quantity), 2) as quantity from r join lineitem on l_orderkey = run_path where {_ACTION} = 'promote' group by run_path",
    "quarantine_report": f"with {RUNS} select count(*) as scanned_runs, count(*) filter (not replayable and o_custkey % 7 <> 0) as quarantined_runs, count(*) filter (not coalesce(not replayable and o_custkey % 7 <> 0, false)) as skipped_runs, case when quarantined_runs = 0 then 'no_quarantine_changes' else '' end as findings, case when quarantined_runs = 0 then 'warn' else 'ok' end as status from r",
    "offload_report": f"""with {RUNS},
o as (select *, case when lane = 'LOW' then 400 else 900 end as least, lane = 'URGENT' or o_custkey % 5 = 0 or o_custkey % 7 = 0 as ok from r where lane <> 'MEDIUM'),
g as (select *, sum(case when ok then 1 else 0 end) over (order by length(lane), lane, started_at, run_path rows between unbounded preceding and current row) as place from o where date_diff('second', started_at, timestamp '1998-08-02') > least * 86400),
c as (select lane, count(*) as s, count(*) filter (ok and place <= 1500) as e, count(*) filter (ok and place > 1500) as w, count(*) filter (not ok) as k from g group by rollup (lane)),
p as (select distinct lane, case when lane = 'LOW' then 400 else 900 end as min_age_days from r where lane <> 'MEDIUM' union all select 'ARCHIVE', 900)
select p.lane, min_age_days, coalesce(s, 0) as scanned_runs, coalesce(e, 0) as eligible_runs, coalesce(w, 0) as waiting_runs, coalesce(k, 0) as stuck_runs, cast(null as varchar) as findings, cast(null as varchar) as status from p left join c on c.lane = p.lane
union all select null, null, s, e, w, k, concat_ws(',', 'unconfigured_lane:MEDIUM', 'missing_lane_dir:ARCHIVE', case when k > 0 then 'stuck_unaccounted_runs:' || k end, case when e = 0 then 'no_offload_candidates' end), 'warn' from c where lane is null""",
    "zero_byte_files": "select 'part-' || o_orderkey || '.parquet' as file, cast(0 as bigint) as bytes from orders where o_orderkey % 5 <> 0 and (o_custkey % 9 = 0 or o_custkey = 0)",
    "recent_high_water": """with e as (select user_id % 7 as lane, cast(ts as date) as run_id, 'P' || (user_id % 5) as symbol, case when event_id % 4 <> 0 then event_id end as sequence from events),
cur as (select lane, max(run_id) as current_run, 'P' || (lane % 5) as symbol from e group by lane),
l as (select distinct e.lane, run_id from e join cur using (lane) where run_id <> current_run and date_diff('second', cast(run_id as timestamp), timestamp '2024-01-30 23:59:59') <= 20 * 86400),
y as (select *, row_number() over (partition by lane order by run_id desc) as n from l),
t as (select e.lane, e.symbol, e.run_id, max(sequence) as hw from e join y using (lane, run_id) join cur on cur.lane = e.lane and cur.symbol = e.symbol where n <= 10 and sequence is not null group by all)
select lane, symbol, arg_max(hw, run_id) as high_water, max(run_id) as run_id from t group by lane, symbol""",
    "readiness_by_lane_day": _DAYS + " select * from d",
    "worst_class_latch": _DAYS + " select * from l",
    "lane_summary": _DAYS + " select count(*) as lanes, string_agg(distinct lane[1], ',' order by lane[1]) as venues, 'trades' as datasets, cast(sum(ready_days) as bigint) as ready_days, cast(sum(ready_with_quarantine_days) as bigint) as ready_with_quarantine_days, cast(sum(building_days) as bigint) as building_days, cast(sum(missing_days) as bigint) as missing_days, cast(sum(curated_rows) as bigint) as curated_rows, cast(sum(promoted_runs) as bigint) as promoted_runs from l",
    "day_summary": _DAYS + " select readiness, count(*) as days, cast(sum(promoted_rows) as bigint) as promoted_rows from d group by readiness",
    "runs_to_score": f"with {RUNS} select case when started_at > timestamp '1998-01-01' then 'too_recent' when not has_events then 'missing_events' when o_custkey % 3 = 0 then 'existing' else 'score' end as action, count(*) as runs from r group by 1",
    "book_sync_health": f"""with {RUNS}, n as (select *, row_number() over (partition by lane order by run_path desc) as n from r),
a as (select lane, count(*) as runs, count(*) filter (replayable) as replayable_runs, count(*) filter (replayable is null) as missing_runs, count(*) filter (o_custkey % 3 > 0) as gap_runs, count(*) filter (o_custkey % 4 > 0) as crossed_runs from n where n <= 50 group by lane)
select *, case when gap_runs > 0 or replayable_runs + missing_runs < runs then 'error' when missing_runs > 0 or crossed_runs > 0 then 'warn' else 'ok' end as status from a""",
    "finding_histogram": f"""with {TRADES}, v as (select *, sequence - lag(sequence) over (partition by user_id, day order by ord) as step from e),
a as (select user_id, day, bool_or(step > 1) as g, bool_or(not (price > 0)) as p, bool_or(not (size > 0)) as s, bool_or(abs(delay) > 60) as k from v group by all),
f as (select user_id % 4 as lane, unnest([case when g then 'trade_id_gaps' end, case when p then 'invalid_prices' end, case when s then 'invalid_sizes' end, case when k then 'excessive_clock_skew' end]) as finding from a)
select lane, finding, count(*) as runs from f where finding is not null group by all""",
    "run_samples": "with n as (select *, row_number() over (partition by user_id order by event_id) as n from events) select user_id, string_agg(event_id || event_type, ',' order by n) as samples from n where n <= 5 group by user_id",
    "curated_once": "with n as (select l_orderkey, l_linenumber, l_partkey, l_quantity, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_quantity) as n from lineitem) select l_orderkey, l_linenumber, l_partkey, l_quantity from n where n = 1",
    "promoted_per_run": f"with {RUNS}, {_INDEX}, n as (select *, row_number() over (partition by lane order by run_path desc) as n from r), s as (select run_path, cast(sum(promoted_rows) as bigint) as promoted_rows from i group by all) select run_path, lane, coalesce(promoted_rows, 0) as promoted_rows from n left join s using (run_path) where n <= 100",
    "quote_states": _QUOTE + " select event_id, first_ as quote_first_observed, changed as quote_changed, repeated as quote_repeated, cast(round(age) as bigint) as quote_age_ms, age > 36000000 as quote_stale from q where symbol is not null",
    "quote_transitions": _QUOTE + " select count(*) as quote_count, count(distinct symbol) as side_symbol_count, count(*) filter (symbol is not null and changed) as quote_update_count, count(*) filter (symbol is not null and first_) as first_observed_quote_count, count(*) filter (repeated) as repeated_quote_count, count(*) filter (age > 36000000) as stale_quote_count from q",
    "quote_counters": _QUOTE + " select cast(ts as date) as day, count(*) as quotes, count(*) filter (changed) as updates, count(*) filter (repeated) as repeats, count(*) filter (age > 36000000) as stale, count(distinct symbol) as symbols from q where symbol is not null group by 1",
    "market_quotes": f"""with {_MARKET}, s as (select upper(ticker) || ':YES' as symbol, yes_bid as bid, yes_ask as ask, printf('%.10f', cast(size as double)) as z from m where is_open and yes_ask > 0 union all select upper(ticker) || ':NO', null, no_ask, '' from m where is_open and no_ask > 0)
select symbol, cast(bid as double) as bid, cast(ask as double) as ask, round((1 - ask) / ask, 6) as payout_ratio, sha256(symbol || '|' || coalesce(printf('%.10f', cast(bid as double)), '') || '|' || printf('%.10f', cast(ask as double)) || '|' || z || '|') as quote_id from s""",
    "market_discovery": f"""with {_MARKET}, s as (select distinct p_partkey % 20 as k from part), c as (select series, count(*) as n, count(*) filter (yes_ask is null and not (no_ask > 0)) as e from m where is_open group by series)
select 's' || k as ticker, ([3600, 86400, 604800, 900])[k % 4 + 1] as frequency_seconds, coalesce(n, 0) as open_markets, coalesce(e, 0) as empty_best_asks, {_named(("coalesce(n, 0) = 0", "no_open_markets"), ("e > 0", "empty_best_ask"))} as findings from s left join c on series = 's' || k where k % 3 = 0 and k % 4 <> 3""",
    "text_content_hash": """select doc_id, sha256(cast(to_json([coalesce(lang, ''), coalesce(text, ''), case when doc_id % 3 = 0 then '' else coalesce(source, '') end]) as varchar)) as content_hash from documents""",
    "text_verdict": f"""with i as (select source as lane, doc_id // 500 as run, doc_id as ord, lang as source, doc_id % 4 = 0 as edit, case when doc_id % 59 <> 0 then sha256(coalesce(text, '')) end as sid, 1700000000 + doc_id * 60 - case when doc_id % 113 = 0 then 600 else 0 end as seen, case when doc_id % 10 <> 0 then 1700000000 + doc_id * 60 - doc_id % 5000 + 400 end as claim, doc_id % 20 = 0 as unread from documents),
w as (select *, seen < max(seen) over (partition by lane, run order by ord rows between unbounded preceding and 1 preceding) as early, sid is not null and row_number() over (partition by lane, run, source, sid order by ord) > 1 as again, seen - claim as lag from i),
a as (select lane, run, count(*) as event_count, count(*) filter (not edit) as new_count, count(*) filter (edit) as edit_count, count(*) filter (early) as non_monotonic_ingestion_count, count(*) filter (sid is null) as missing_envelope_count, count(*) filter (again) as duplicate_key_count,
 count(*) filter (claim is null and not unread) as missing_source_ts_count, count(*) filter (claim is null and unread) as unparseable_source_ts_count, count(*) filter (lag > 3600) as stale_source_ts_count, count(*) filter (lag < -300) as future_source_ts_count, cast(max(lag) as bigint) as max_source_lag_seconds from w group by lane, run)
select *, {_named(("missing_envelope_count > 0", "missing_envelope_fields"), ("non_monotonic_ingestion_count > 0", "non_monotonic_ingestion_ts"), ("duplicate_key_count > 0", "duplicate_envelope_keys"), ("missing_source_ts_count > 0", "missing_source_ts"), ("unparseable_source_ts_count > 0", "unparseable_source_ts"), ("stale_source_ts_count > 0", "stale_source_ts"), ("future_source_ts_count > 0", "future_source_ts"))} as findings, missing_envelope_count + non_monotonic_ingestion_count = 0 as replayable from a""",
    "text_read_once": """with i as (select doc_id as ord, lang as source, coalesce(text, '') as t, 1700000000 + doc_id * 60 - case when doc_id % 113 = 0 then 600 else 0 end as seen from documents where doc_id % 59 <> 0), n as (select *, row_number() over (partition by source, t order by seen desc, ord) as n from i) select ord, source from n where n = 1""",
    "text_new_edit": "with p as (select *, coalesce(text, '') as t, lag(coalesce(text, '')) over (partition by conv_id order by turn) as q from conversations) select conv_id, turn, case when q is null then 'new' else 'edit' end as row_type from p where q is null or q <> t",
    "seen_state_resumed": """with d as (select source, doc_id % 400 as item, doc_id, sha256(cast(to_json([coalesce(text, '')]) as varchar)) as h from documents),
b as (select source, item, arg_max(h, doc_id) as h, max(doc_id) as doc_id from d where doc_id % 2 = 0 group by all),
n as (select *, row_number() over (partition by source order by doc_id desc, item) as recency from b),
s as (select n.* from n where recency <= 10 and exists (from d where d.source = n.source and d.item = n.item and d.h = n.h and d.doc_id % 2 = 0 and d.doc_id % 3 <> 0)),
a as (select source, item, arg_max(h, doc_id) as h, max(doc_id) as doc_id from d where doc_id % 2 = 1 group by all),
u as (select source, item, h, doc_id, 1 as later from a union all select source, item, h, doc_id, 0 from s where not exists (from a where a.source = s.source and a.item = s.item)),
r as (select *, row_number() over (partition by source order by later desc, doc_id desc, item) as recency from u)
select source, item, doc_id, h as content_hash, recency from r where recency <= 10""",
    "seen_state_cap": "with l as (select source, doc_id % 400 as item, max(doc_id) as doc_id, sha256(cast(to_json([arg_max(coalesce(text, ''), doc_id)]) as varchar)) as content_hash from documents group by all), n as (select *, row_number() over (partition by source order by doc_id desc, item) as recency from l) select * from n where recency <= 10",
    "clean_ratio_streak": f"""with {_METRICS}, n as (select *, row_number() over (partition by lane order by run_id desc) as n, clean_events / raw_events as ratio, day(run_id) % 2 = 0 as ok from m),
a as (select lane, count(*) as runs, cast(sum(raw_events) as bigint) as raw_events, cast(sum(clean_events) as bigint) as clean_events, cast(sum(quarantined_events) as bigint) as quarantined_events, arg_max(ok, run_id) as latest_replayable, max(run_id) as last, max(ratio) filter (n <= 3) as hi, count(*) filter (n <= 3) as k from n where n <= 20 group by lane)
select lane, runs, raw_events, clean_events, quarantined_events, latest_replayable, round(clean_events / raw_events, 6) as clean_ratio, k = 3 and hi < 0.25 as low_streak, {_named(("not latest_replayable", "latest_run_unreplayable"), ("date_diff('second', cast(last as timestamp), timestamp '2024-01-30 12:00:00') > 36000", "verdict_too_old"), ("k = 3 and hi < 0.25", "low_clean_ratio"))} as findings from a""",
    "quarantine_ratio": f"with {_METRICS}, a as (select lane, cast(sum(raw_events) as bigint) as raw_events, cast(sum(clean_events) as bigint) as clean_events, cast(sum(quarantined_events) as bigint) as quarantined_events, cast(sum(subscribe_replay) as bigint) as subscribe_replay from m group by lane) select *, round((quarantined_events - subscribe_replay) / raw_events, 6) as ratio, (quarantined_events - subscribe_replay) / raw_events > 0.2 as flagged from a",
    "job_freshness": "with a as (select user_id % 40 as job, max(ts) as t, arg_max(user_id % 3 * 600 + 300, ts) as i from events group by 1) select job, cast(floor(date_diff('microsecond', t, timestamp '2024-01-30 00:00:00') / 1e6) as bigint) as age_seconds, date_diff('microsecond', t, timestamp '2024-01-30 00:00:00') / 1e6 > greatest(i, 900) * 2.5 as stale from a",
    "recent_failures": "select user_id % 5 as family, count(*) as failures from events where event_type = 'error' and ts <= timestamp '2024-01-30 00:00:00' and date_diff('microsecond', ts, timestamp '2024-01-30 00:00:00') <= 86400000000 group by 1 having count(*) >= 2",
    "silence_gaps": "with g as (select user_id, event_id, date_diff('microsecond', lag(ts) over (partition by user_id order by ts, event_id), ts) / 1e6 as s from events) select user_id, event_id, cast(floor(s) as bigint) as silence_seconds from g where s > 43200",
    "retention_plan": _PLAN + " select lane, state, count(*) as runs, min(run_path) as first_run from t group by all",
    "stuck_accounting": _PLAN + ", k as (select lane, cast(run_path as varchar) as p, row_number() over (partition by lane order by run_path) as n from t where state = 'stuck') select lane, count(*) as stuck, string_agg(p, ',' order by cast(p as bigint)) filter (n <= 5) as examples from k group by lane",
    "retention_candidates": f"with {RUNS} select lane, count(*) as runs, cast(sum(cast(floor(o_totalprice) as bigint)) as bigint) as bytes from r where date_diff('second', started_at, timestamp '1998-08-02') >= case when lane = 'LOW' then 500 else 700 end * 86400 group by lane",
    "lane_differences": "with d as (select distinct 'lane' || (c_custkey % 30) as lane from customer), c as (select distinct 'lane' || (n_nationkey * 2) as lane from nation) select lane, 'unconfigured_lane' as problem from d where lane not in (select lane from c) union all select lane, 'missing_lane' from c where lane not in (select lane from d)",
    "copy_differences": "select o_orderkey as file, case when o_orderkey % 11 = 0 then 'missing' else 'size' end as problem from orders where o_orderkey % 11 = 0 or o_orderkey % 13 = 0 union all select -o_orderkey - 1, 'extra' from orders where o_orderkey % 17 = 0",
    "growth_alert": "with c as (select user_id % 6 as lane, cast(ts as date) as reported_at, count(*) filter (event_type = 'error') as stuck from events group by all), p as (select *, lag(stuck) over (partition by lane order by reported_at) as prior from c) select *, stuck > 10 and (prior is null or stuck > prior) as alert from p",
    "partition_layout": "select p_partkey, 'v2' as schema_version, 'src-' || (p_partkey % 3) as source, regexp_replace(replace(trim(p_name), '/', '-'), '[^A-Za-z0-9_.-]', '_', 'g') as instrument, cast(to_timestamp(p_partkey * 86400) as date) as event_date from part",
    "resume_high_water": """with t as (select user_id, max(event_id) as hw, max(ts) as u, user_id % 5 as k from events group by user_id), x as (select *, case when k = 0 then null when k = 1 then 'cursor_reset_symbol_mismatch' when date_diff('microsecond', u, timestamp '2024-01-30 23:59:59') / 1e6 > 43200 then 'cursor_reset_stale_gap' end as reset from t)
select user_id, case when k > 1 and reset is null then case when k = 3 then hw + 1 else hw - 4 end end as next_id, reset from x""",
    "feed_items": r"""with p as (select page_id, replace(coalesce(url, ''), '"', '') as u, trim(regexp_replace(coalesce(html, ''), '[\x00-\x20\x7F-\x{9F}\x{FFFE}\x{FFFF}]+', ' ', 'g'), ' ') as h from pages)
select page_id, case when page_id % 3 = 0 then 'atom' else 'rss' end as dialect, case when page_id % 3 = 0 then 'e' || page_id else u end as source_id, case when page_id % 3 = 0 then 'a < b' else 't & ' || page_id end as title, u as link, sha256(h) as summary_sha256, case when page_id % 3 = 0 then '2026' end as source_ts_raw from p""",
    "listing_children": "select l_orderkey, count(*) as items, cast(sum(l_partkey) as bigint) as parts from lineitem where l_linenumber <> 6 group by l_orderkey",
    "page_cap": "with n as (select o_custkey, o_orderkey as k, row_number() over (partition by o_custkey order by o_orderkey % 4, o_orderkey) as n from orders) select o_custkey, k from n where n <= 5",
    "lane_names": "select s_suppkey, case when s_suppkey % 7 <> 0 then 'v' || (s_suppkey % 5) || case when s_suppkey % 2 = 0 then '_perp' else '' end end as venue, case when s_suppkey % 7 <> 0 then 'depth' end as dataset, case when s_suppkey % 7 <> 0 and s_suppkey % 3 = 0 then 'btc_usd' end as instrument from supplier",
}

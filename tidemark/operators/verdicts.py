"""Verdicts: one row per run, from window-annotated events. Counters are conditional counts, findings keep a fixed order.

keys: the run (such as lane and run_id); order: the columns that put its events in order. All windows of a verdict
share one partitioning and order, so a run is exchanged and sorted once, and the aggregate reuses that exchange.
With `runs` (all run keys) runs without events get a row too: counts of 0, the finding `no_events`, not replayable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import finite_positive, skew_ms
from .gates import before, up_to
from .segments import first_rows

_C = F.col
MAX_SKEW_MS = 60_000


def _findings(*pairs: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in pairs)))


def _first(c: str, order: list[str]) -> Column:
    return F.min_by(c, F.when(_C(c).isNotNull(), F.struct(*order)))


def _ends(c: str, order: list[str], name: str) -> list[Column]:
    return [F.min_by(c, F.struct(*order)).alias(f"first_{name}"), F.max_by(c, F.struct(*order)).alias(f"last_{name}")]


def _common(df: DataFrame, order: list[str]) -> list[Column]:
    return [_first(c, order).alias(c) for c in ("source", "product") if c in df.columns]


def _every_run(out: DataFrame, keys: list[str], runs: DataFrame | None) -> DataFrame:
    counts = [c for c in out.columns if c.endswith("_count") or c.startswith("applied_") or c == "trade_id_gap_total_missing"]
    return out if runs is None else runs.select(*keys).distinct().join(out, keys, "left").fillna(0, counts)


def trades(events: DataFrame, keys: list[str], order: list[str], max_skew_ms: float = MAX_SKEW_MS, runs: DataFrame | None = None) -> DataFrame:
    """Runs with a dense trade id: gaps, order, duplicates (tolerated), prices, sizes, clock skew."""
    w = before(keys, order)
    e = with_trade_id(events)
    e = e.withColumn("step", _C("id") - F.last("id", ignorenulls=True).over(w))
    out = e.groupBy(*keys).agg(
        *_common(e, order),
        F.count("*").alias("event_count"),
        _first("id", order).alias("first_trade_id"),
        F.max_by("id", F.when(_C("id").isNotNull(), F.struct(*order))).alias("last_trade_id"),
        *_ends("exchange_time", order, "event_time"),
        F.count_if(_C("step") < 0).alias("non_monotonic_count"),
        F.count_if(_C("step") == 0).alias("duplicate_trade_id_count"),
        F.count_if(_C("step") > 1).alias("trade_id_gap_count"),
        F.coalesce(F.sum(F.when(_C("step") > 1, _C("step") - 1)), F.lit(0)).alias("trade_id_gap_total_missing"),
        F.count_if(_C("id").isNull()).alias("missing_trade_id_count"),
        F.count_if(~finite_positive(_C("price"))).alias("invalid_price_count"),
        F.count_if(~finite_positive(_C("size"))).alias("invalid_size_count"),
        F.count_if(_C("skew") > max_skew_ms).alias("excessive_clock_skew_count"),
        F.max("skew").alias("max_clock_skew_ms"),
    )
    return judged_trades(_every_run(out, keys, runs))


def with_trade_id(events: DataFrame) -> DataFrame:
    """Adds the dense id and the clock skew of a print."""
    return events.withColumns({"id": F.coalesce("sequence", _C("trade_id").try_cast("bigint")), "skew": F.abs(skew_ms(_C("received_at"), _C("exchange_time")))})


def judged_trades(out: DataFrame) -> DataFrame:
    """Findings and verdict of runs whose counters are there, from windows or from a stream's state."""
    bad = _findings((_C("event_count") == 0, "no_events"), (_C("non_monotonic_count") > 0, "non_monotonic_trade_ids"), (_C("trade_id_gap_count") > 0, "trade_id_gaps"), (_C("invalid_price_count") > 0, "invalid_prices"), (_C("invalid_size_count") > 0, "invalid_sizes"), (_C("excessive_clock_skew_count") > 0, "excessive_clock_skew"), (_C("missing_trade_id_count") > 0, "missing_trade_ids"))
    return out.withColumns({"mode": F.lit("trade_stream"), "gap_detection": F.lit("sequence"), "findings": bad}).withColumn("replayable", F.size("findings") == 0)


def _timed(events: DataFrame, keys: list[str], order: list[str], mode: str, price: str, sized: bool, max_skew_ms: float, runs: DataFrame | None) -> DataFrame:
    w = before(keys, order)
    e = events.withColumns({"early": _C("exchange_time") < F.max("exchange_time").over(w), "skew": F.abs(skew_ms(_C("received_at"), _C("exchange_time")))})
    sizes = F.count_if(~finite_positive(_C("size"))) if sized else F.lit(0).cast("bigint")
    out = e.groupBy(*keys).agg(
        *_common(e, order),
        F.count("*").alias("event_count"),
        *_ends("exchange_time", order, "event_time"),
        F.count_if("early").alias("non_monotonic_count"),
        F.count_if(~finite_positive(_C("price"))).alias("invalid_price_count"),
        sizes.alias("invalid_size_count"),
        F.count_if(_C("skew") > max_skew_ms).alias("excessive_clock_skew_count"),
        F.max("skew").alias("max_clock_skew_ms"),
    )
    out = _every_run(out, keys, runs)
    bad = _findings((_C("event_count") == 0, "no_events"), (_C("non_monotonic_count") > 0, "non_monotonic_event_time"), (_C("invalid_price_count") > 0, price), (_C("invalid_size_count") > 0, "invalid_sizes"), (_C("excessive_clock_skew_count") > 0, "excessive_clock_skew"))
    return out.withColumns({"mode": F.lit(mode), "gap_detection": F.lit("none_native"), "findings": bad}).withColumn("replayable", F.size("findings") == 0)


def trades_stream(events: DataFrame, keys: list[str], order: list[str], max_skew_ms: float = MAX_SKEW_MS, runs: DataFrame | None = None) -> DataFrame:
    """Runs without ids: time against the running maximum, prices, sizes, skew."""
    return _timed(events, keys, order, "trade_stream_none_native", "invalid_prices", True, max_skew_ms, runs)


def funding(events: DataFrame, keys: list[str], order: list[str], max_skew_ms: float = MAX_SKEW_MS, runs: DataFrame | None = None) -> DataFrame:
    """Funding runs: as those without ids, and sizes do not matter."""
    return _timed(events, keys, order, "funding_none_native", "invalid_mark_price", False, max_skew_ms, runs)


def depth(updates: DataFrame, keys: list[str], order: list[str], anchors: DataFrame | None = None, crossed: DataFrame | None = None, runs: DataFrame | None = None) -> DataFrame:
    """Runs of update windows [first, final], with an optional anchor (keys, snapshot_last_update_id) a run.

    Valid windows up to the anchor are skipped; the first beyond it must reach back to it. From then on the cursor is the
    running maximum of final ids. crossed: (keys, crossed_book_count), see `book`.
    """
    w = before(keys, order)
    u = updates.join(anchors.select(*keys, "snapshot_last_update_id"), keys, "left") if anchors is not None else updates.withColumn("snapshot_last_update_id", F.lit(None).cast("bigint"))
    a, lo, hi = _C("snapshot_last_update_id"), _C("first_update_id"), _C("final_update_id")
    u = u.withColumn("valid", F.coalesce(lo <= hi, F.lit(False)))
    u = u.withColumn("past", _C("valid") & (a.isNull() | (hi > a)))
    u = u.withColumn("n_past", F.count(F.when(_C("past"), 1)).over(w))
    u = u.withColumns({"skipped": _C("valid") & (_C("n_past") == 0) & ~_C("past"), "live": _C("valid") & ((_C("n_past") > 0) | _C("past")), "anchors": _C("past") & (_C("n_past") == 0) & a.isNotNull()})
    u = u.withColumn("prev", F.max(F.when(_C("live"), hi)).over(w))
    follows = _C("live") & ~_C("anchors") & _C("prev").isNotNull()
    size = lambda c: F.sum(F.when(~_C("skipped"), F.coalesce(F.size(c), F.lit(0))).otherwise(0)).alias(f"applied_{c[:-1]}_updates")
    levels = [size(c) for c in ("bids", "asks") if c in u.columns]
    out = u.groupBy(*keys).agg(
        *_common(u, order),
        F.first("snapshot_last_update_id").alias("snapshot_last_update_id"),
        F.count_if(~_C("skipped")).alias("event_count"),
        F.count_if(follows & (hi > _C("prev")) & (lo > _C("prev") + 1)).alias("gap_count"),
        F.count_if(_C("anchors") & (lo > a + 1)).alias("snapshot_gap_count"),
        F.count_if(follows & (hi <= _C("prev"))).alias("reordered_count"),
        F.count_if(~_C("valid")).alias("invalid_range_count"),
        F.min_by("first_update_id", F.when(_C("live"), F.struct(*order))).alias("first_update_id"),
        F.max(F.when(_C("live"), hi)).alias("last_update_id"),
        *levels,
    )
    out = _every_run(out, keys, runs)
    out = out.join(crossed, keys, "left").fillna(0, ["crossed_book_count"]) if crossed is not None else out.withColumn("crossed_book_count", F.lit(0).cast("bigint"))
    gating = {"gaps_detected": "gap_count", "snapshot_anchor_gap": "snapshot_gap_count", "reordered_or_duplicate_updates": "reordered_count", "invalid_update_ranges": "invalid_range_count"}
    bad = _findings(*((_C(c) > 0, n) for n, c in gating.items()), (_C("crossed_book_count") > 0, "crossed_book_states"), (_C("event_count") == 0, "no_events"))
    clean = (_C("event_count") > 0) & (sum((_C(c) for c in gating.values()), F.lit(0)) == 0)
    return out.withColumns({"mode": F.lit("delta_only"), "gap_detection": F.lit("sequence"), "findings": bad, "replayable": clean})


def depth_stream(updates: DataFrame, keys: list[str], order: list[str], ids: str | None = None, update_id: str = "update_id", crossed: DataFrame | None = None, checksums: DataFrame | None = None, runs: DataFrame | None = None) -> DataFrame:
    """Runs whose snapshots come in the stream. ids: None, dense (`update_id` + 1) or chain (first id equals the id before).

    checksums: (keys, checksum_checked_count, checksum_mismatch_count, checksum_missing_count), see `book`.
    """
    w = before(keys, order)
    snap = _C("event_type") == "snapshot"
    own = {None: F.lit(None).cast("bigint"), "dense": _C(update_id) if ids == "dense" else F.lit(None), "chain": _C("final_update_id") if ids == "chain" else F.lit(None)}[ids]
    u = updates.withColumns({"is_snapshot": F.coalesce(snap, F.lit(False)), "uid": own, "early": _C("event_time") < F.max("event_time").over(w)})
    u = u.withColumn("prev", F.last("uid", ignorenulls=True).over(w))
    later = ~_C("is_snapshot") & _C("uid").isNotNull() & _C("prev").isNotNull()
    if ids == "chain":
        gap, back = later & (_C("uid") >= _C("prev")) & ~_C("first_update_id").eqNullSafe(_C("prev")), later & (_C("uid") < _C("prev"))
    else:
        gap, back = later & (_C("uid") - _C("prev") > 1), later & (_C("uid") <= _C("prev"))
    linked = ids is not None
    out = u.groupBy(*keys).agg(
        *_common(u, order),
        F.count("*").alias("event_count"),
        F.count_if("is_snapshot").alias("snapshot_count"),
        F.min_by("is_snapshot", F.struct(*order)).alias("starts_with_snapshot"),
        F.count_if("early").alias("non_monotonic_time_count"),
        (F.count_if(_C("uid").isNull()) if linked else F.lit(0).cast("bigint")).alias("missing_update_id_count"),
        F.count_if(gap).alias("gap_count"),
        F.count_if(back).alias("reordered_count"),
        _first("uid", order).alias("first_update_id"),
        F.max_by("uid", F.when(_C("uid").isNotNull(), F.struct(*order))).alias("last_update_id"),
    )
    out = _every_run(out, keys, runs).fillna(False, ["starts_with_snapshot"])
    out = out.join(crossed, keys, "left").fillna(0, ["crossed_book_count"]) if crossed is not None else out.withColumn("crossed_book_count", F.lit(0).cast("bigint"))
    sums = ("checksum_checked_count", "checksum_mismatch_count", "checksum_missing_count")
    out = out.join(checksums, keys, "left").fillna(0, list(sums)) if checksums is not None else out
    summed = checksums is not None
    pairs = [(_C("event_count") == 0, "no_events"), (_C("snapshot_count") == 0, "no_snapshot_anchor"), ((_C("snapshot_count") > 0) & ~_C("starts_with_snapshot"), "run_does_not_start_with_snapshot"), (_C("non_monotonic_time_count") > 0, "non_monotonic_event_time"), (_C("crossed_book_count") > 0, "crossed_book_states")]
    if linked:
        pairs += [(_C("missing_update_id_count") > 0, "missing_update_id"), (_C("gap_count") > 0, "update_id_gaps"), (_C("reordered_count") > 0, "non_monotonic_update_id")]
    clean = (_C("snapshot_count") > 0) & _C("starts_with_snapshot") & (_C("non_monotonic_time_count") == 0) & (_C("missing_update_id_count") + _C("gap_count") + _C("reordered_count") == 0)
    if summed:
        pairs += [(_C("checksum_missing_count") > 0, "missing_checksum"), (_C("checksum_mismatch_count") > 0, "checksum_mismatch")]
        clean = clean & (_C("checksum_checked_count") > 0) & (_C("checksum_missing_count") + _C("checksum_mismatch_count") == 0)
    mode = "stream_snapshot" + ("_checksum" if summed else {None: "", "dense": "_sequence", "chain": "_chain"}[ids])
    kind = "checksum" if summed else "sequence" if linked else "none_native"
    return out.withColumns({"mode": F.lit(mode), "gap_detection": F.lit(kind), "findings": _findings(*pairs), "replayable": clean})


# How a venue's depth stream is scored, and the decimals (price, size) of products with checksums.
STREAM_MODES = {"bybit": "dense", "okx": "chain", "kraken": "checksum"}
CHECKSUM_DECIMALS = {"BTC/USD": (1, 8)}
CHECKSUM_DEPTH = 10


def stream_mode(updates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Each run's mode: by venue and the product of its first event; checksums need known decimals."""
    first = updates.groupBy(*keys).agg(F.min_by("source", F.struct(*order)).alias("venue"), F.min_by("product", F.struct(*order)).alias("product"))
    modes = F.create_map(*(F.lit(x) for p in STREAM_MODES.items() for x in p))[F.regexp_replace("venue", "_perp$", "")]
    return first.withColumn("stream_mode", F.when((modes == "checksum") & ~_C("product").isin(*CHECKSUM_DECIMALS), "structural").otherwise(F.coalesce(modes, F.lit("structural"))))


def text(items: DataFrame, keys: list[str], order: list[str], runs: DataFrame | None = None, stale_seconds: float = 3600, future_seconds: float = 300) -> DataFrame:
    """Text runs; runs: all run keys, so that runs without items get a row too."""
    w = before(keys, order)
    at = F.coalesce("ingestion_ts", "received_at")
    i = items.withColumns({"at": at, "enveloped": ~F.coalesce(_C("source_id") == "", F.lit(True)) & ~F.coalesce(_C("content_hash") == "", F.lit(True)) & at.isNotNull()})
    again = before([*keys, "source", "source_id", "content_hash", "enveloped"], order)
    i = i.withColumns({"early": _C("at") < F.max("at").over(w), "repeat": _C("enveloped") & (F.count(F.lit(1)).over(again) > 0), "lag": skew_ms(_C("at"), _C("source_ts")) / 1000})
    unread = F.coalesce(_C("metadata.source_ts_unparseable"), F.lit(False))
    out = i.groupBy(*keys).agg(
        _first("source", order).alias("source"),
        F.count("*").alias("event_count"),
        F.count_if(_C("event_type") == "new").alias("new_count"),
        F.count_if(_C("event_type") == "edit").alias("edit_count"),
        *_ends("at", order, "ingestion_ts"),
        F.count_if("early").alias("non_monotonic_ingestion_count"),
        F.count_if(~_C("enveloped")).alias("missing_envelope_count"),
        F.count_if("repeat").alias("duplicate_key_count"),
        F.count_if(_C("source_ts").isNull() & ~unread).alias("missing_source_ts_count"),
        F.count_if(_C("source_ts").isNull() & unread).alias("unparseable_source_ts_count"),
        F.count_if(_C("lag") > stale_seconds).alias("stale_source_ts_count"),
        F.count_if(_C("lag") < -future_seconds).alias("future_source_ts_count"),
        F.max("lag").alias("max_source_lag_seconds"),
    )
    counters = [c for c in out.columns if c.endswith("_count")]
    out = (runs.select(*keys).distinct().join(out, keys, "left") if runs is not None else out).fillna(0, counters)
    bad = _findings((_C("event_count") == 0, "no_events"), (_C("missing_envelope_count") > 0, "missing_envelope_fields"), (_C("non_monotonic_ingestion_count") > 0, "non_monotonic_ingestion_ts"), (_C("duplicate_key_count") > 0, "duplicate_envelope_keys"), (_C("missing_source_ts_count") > 0, "missing_source_ts"), (_C("unparseable_source_ts_count") > 0, "unparseable_source_ts"), (_C("stale_source_ts_count") > 0, "stale_source_ts"), (_C("future_source_ts_count") > 0, "future_source_ts"))
    clean = (_C("event_count") > 0) & (_C("missing_envelope_count") == 0) & (_C("non_monotonic_ingestion_count") == 0)
    return out.withColumns({"mode": F.lit("text_poll"), "gap_detection": F.lit("none_native"), "findings": bad, "replayable": clean})


def sync_health(verdicts: DataFrame, lane: str = "lane", run: str = "run_id", limit: int = 20) -> DataFrame:
    """Per lane, over its newest runs: replayable, missing, gap and crossed runs, and ok, warn or error."""
    from pyspark.sql import Window

    recent = verdicts.withColumn("rank", F.row_number().over(Window.partitionBy(lane).orderBy(F.desc(run)))).where(_C("rank") <= limit)
    out = recent.groupBy(lane).agg(F.count("*").alias("runs"), F.count_if(_C("replayable")).alias("replayable_runs"), F.count_if(_C("replayable").isNull()).alias("missing_runs"), F.count_if(F.coalesce(_C("gap_count") > 0, F.lit(False))).alias("gap_runs"), F.count_if(F.coalesce(_C("crossed_book_count") > 0, F.lit(False))).alias("crossed_runs"))
    status = F.when((_C("gap_runs") > 0) | (_C("replayable_runs") + _C("missing_runs") < _C("runs")), "error").when((_C("missing_runs") > 0) | (_C("crossed_runs") > 0), "warn").otherwise("ok")
    return out.withColumn("status", status)


def runs_to_score(runs: DataFrame, verdicts: DataFrame, keys: list[str], newest: Column, overwrite: bool = False, min_age_seconds: float = 3600) -> DataFrame:
    """Each run's action: too_recent, missing_events, existing or score. runs: keys, started_at, has_events."""
    known = verdicts.select(*keys).distinct().withColumn("known", F.lit(True))
    age = (F.unix_micros(newest) - F.unix_micros("started_at")) / 1e6
    action = F.when(age < min_age_seconds, "too_recent").when(~_C("has_events"), "missing_events").when(_C("known") & ~F.lit(overwrite), "existing").otherwise("score")
    return runs.join(known, keys, "left").withColumn("action", action).drop("known")


def scoring_worklist(runs: DataFrame, scored: DataFrame, now: Column, limit: int, max_age_seconds: float, overwrite: bool = False, lane: str = "lane", run: str = "run_id") -> DataFrame:
    """The runs that a pass over each lane meets, newest first: lane, run, todo (to be scored; else already scored and skipped).

    The limit counts runs to score, after scored ones are left out: else newer scored runs would hide older open ones for ever. What lies
    beyond a lane's last chosen run is not met. runs: lane, run, started_at (null: any age), has_events.
    """
    age = (F.unix_micros(now) - F.unix_micros("started_at")) / 1e6
    young = runs.where(_C("has_events") & (_C("started_at").isNull() | (age <= max_age_seconds))).select(lane, run).distinct()
    known = scored.select(lane, run).distinct()
    open_ = young if overwrite else young.join(known, [lane, run], "left_anti")
    chosen = first_rows(open_, [lane], [F.desc(run)], limit).select(lane, run, F.lit(True).alias("todo"))
    if overwrite or limit <= 0:
        return chosen
    last = chosen.groupBy(lane).agg(F.count("*").alias("__n"), F.min(run).alias("__last"))
    met = young.join(known, [lane, run], "left_semi").join(last, lane, "left").where((F.coalesce(_C("__n"), F.lit(0)) < limit) | (_C(run) > _C("__last")))
    return chosen.unionByName(met.select(lane, run, F.lit(False).alias("todo")))


def scoring_report(worklist: DataFrame, verdicts: DataFrame, lane: str = "lane", run: str = "run_id") -> DataFrame:
    """Per lane: scored, replayable, not replayable and skipped runs, and how often each finding came up among runs not replayable.

    A run of the worklist without a verdict failed: a `replay_error` finding, and not scored.
    """
    todo = worklist.join(verdicts.select(lane, run, "replayable", "findings"), [lane, run], "left")
    poor = F.when(_C("todo") & _C("replayable").isNull(), F.array(F.lit("replay_error"))).when(_C("todo") & ~_C("replayable"), _C("findings"))
    counts = todo.groupBy(lane).agg(F.count_if(_C("todo") & _C("replayable").isNotNull()).alias("scanned"), F.count_if(_C("todo") & _C("replayable")).alias("replayable"), F.count_if(_C("todo") & ~_C("replayable")).alias("not_replayable"), F.count_if(~_C("todo")).alias("skipped_already_scored"))
    found = todo.select(lane, F.explode(poor).alias("finding")).groupBy(lane, "finding").agg(F.count("*").alias("runs"))
    found = found.groupBy(lane).agg(F.array_sort(F.collect_list(F.struct("finding", "runs"))).alias("findings"))  # findings are a fixed few
    return counts.join(found, lane, "left")


def finding_histogram(verdicts: DataFrame, lane: str = "lane") -> DataFrame:
    """Runs per lane and finding."""
    return verdicts.select(lane, F.explode("findings").alias("finding")).groupBy(lane, "finding").agg(F.count("*").alias("runs"))


__all__ = ["depth", "depth_stream", "finding_histogram", "funding", "runs_to_score", "scoring_report", "scoring_worklist", "stream_mode", "sync_health", "text", "trades", "trades_stream", "up_to"]

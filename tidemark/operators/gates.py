"""Gates: frame filters, row rules, the sequence cursor with subscribe replays, and the reject histogram.

A gate adds `reasons` (array, empty for clean rows) and `accepted`. Rows of a run are ordered by an explicit column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import finite_positive, no_errors, skew_ms
from .segments import first_rows

MAX_DELAY_MS, MAX_FUTURE_MS = 60_000, 5_000


def before(keys: list[str], order: list[str]) -> Window:
    """All rows of the run that stand before this one."""
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def up_to(keys: list[str], order: list[str]) -> Window:
    """All rows of the run up to this one."""
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _has(p: Column, key: str) -> Column:
    """The JSON object has this key (a null value counts)."""
    return F.array_contains(F.json_object_keys(p), key)


def frame_kind(payload: Column, style: str) -> Column:
    """data, ack, error or other, by a venue's style of frames (JSON text)."""
    get = lambda path: F.get_json_object(payload, f"$.{path}")
    yes = lambda c: F.coalesce(c, F.lit(False))
    subscribe = lambda key: get(key) == "subscribe"
    data, ack, error = {
        "binance": (~(get("result").isNull() & _has(payload, "id")) & (get("e").isNotNull() | _has(payload, "data")), get("result").isNull() & _has(payload, "id"), ((get("error") != "{}") & get("error").startswith("{")) | (get("code").isNotNull() & (get("code") != "0"))),
        "coinbase": (~yes(get("type").isin("subscriptions", "error")), get("type") == "subscriptions", get("type") == "error"),
        "bybit": (_has(payload, "topic"), subscribe("op") & (get("success") == "true"), subscribe("op") & (get("success") == "false")),
        "kraken": (get("channel").isin("trade", "book") & _has(payload, "data"), subscribe("method") & (get("success") == "true"), subscribe("method") & (get("success") == "false")),
        "mexc": (_has(payload, "channel") & (_has(payload, "publicAggreDeals") | _has(payload, "publicLimitDepths")), (get("code") == "0") & _has(payload, "msg"), get("code").isNotNull() & (get("code") != "0")),
        "okx": (_has(payload, "data") & _has(payload, "arg"), get("event") == "subscribe", get("event") == "error"),
    }[style]
    return F.when(F.json_object_keys(payload).isNull(), "other").when(yes(error), "error").when(yes(ack), "ack").when(yes(data), "data").otherwise("other")


def data_frames(frames: DataFrame, style: str, payload: str = "payload") -> DataFrame:
    """Frames that carry data; acknowledgements, errors, pongs and heartbeats go."""
    get = lambda path: F.get_json_object(F.col(payload), f"$.{path}")
    kind = frame_kind(F.col(payload), style)
    return frames.where((kind == "data") | ((kind == "error") & F.lit(style == "binance") & get("e").isNotNull()))


def verdict(df: DataFrame, *rules: tuple[Column, str], errors: Column | None = None) -> DataFrame:
    """Adds reasons (parse errors first, then the names of the rules that hold, in order) and accepted."""
    found = F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in rules)))
    found = F.concat(F.coalesce(errors, no_errors()), found) if errors is not None else found
    return df.withColumn("reasons", found).withColumn("accepted", F.size("reasons") == 0)


def sequence_cursor(df: DataFrame, keys: list[str], order: list[str], sequence: str = "sequence", replay: str = "subscribe_replay") -> DataFrame:
    """Adds `sequence_reason`: non_monotonic_sequence, subscribe_replay or null.

    The cursor is the highest sequence so far of rows that may set it: all but replayed rows before the first
    other one. A replayed row passes only above a cursor that exists; equal sequences of other rows pass.
    """
    seq, again = F.col(sequence), F.coalesce(F.col(replay), F.lit(False))
    w = before(keys, order)
    seen = F.count(F.when(~again & seq.isNotNull(), 1)).over(w) > 0
    marked = df.withColumns({"__seen": seen})
    cursor = F.max(F.when(~again | F.col("__seen"), seq)).over(w)
    reason = F.when(again & ~F.coalesce(seq > F.col("__cursor"), F.lit(False)), "subscribe_replay").when(~again & (seq < F.col("__cursor")), "non_monotonic_sequence")
    return marked.withColumn("__cursor", cursor).withColumn("sequence_reason", reason).drop("__seen", "__cursor")


def event_gate(events: DataFrame, keys: list[str], order: list[str], max_delay_ms: int = MAX_DELAY_MS, max_future_ms: int = MAX_FUTURE_MS) -> DataFrame:
    """The gate of trade, funding and generic events. keys: run and stream (source, product, channel)."""
    e = sequence_cursor(events.withColumn("subscribe_replay", F.col("metadata.subscribe_replay")), keys, order)
    return event_rules(e, max_delay_ms, max_future_ms)


def event_rules(e: DataFrame, max_delay_ms: int = MAX_DELAY_MS, max_future_ms: int = MAX_FUTURE_MS) -> DataFrame:
    """The event gate's verdict on rows that have the cursor's `sequence_reason` already, from a window or from a stream's state."""
    trades, price, size = F.col("channel") == "trades", F.col("price"), F.col("size")
    delay = skew_ms(F.col("received_at"), F.col("exchange_time"))
    return verdict(
        e,
        (F.col("side").isNotNull() & ~F.col("side").isin("buy", "sell"), "invalid_side"),
        (trades & ~finite_positive(price), "invalid_trade_price"),
        (trades & ~finite_positive(size), "invalid_trade_size"),
        (~trades & (price <= 0), "non_positive_price"),
        (~trades & (size < 0), "negative_size"),
        ((delay > max_delay_ms) | (delay < -max_future_ms), "stale_or_clock_skew"),
        (F.col("sequence_reason") == "subscribe_replay", "subscribe_replay"),
        (F.col("sequence_reason") == "non_monotonic_sequence", "non_monotonic_sequence"),
        (F.col("event_type") == "unknown", "unknown_event_type"),
        errors=F.col("metadata.parse_errors"),
    ).drop("sequence_reason", "subscribe_replay")


def range_gate(updates: DataFrame) -> DataFrame:
    """The gate of depth and funding rows: parse errors and update ranges that run backwards."""
    ids = [c in updates.columns for c in ("first_update_id", "final_update_id")]
    rules = [(F.col("final_update_id") < F.col("first_update_id"), "invalid_update_range")] if all(ids) else []
    return verdict(updates, *rules, errors=F.col("metadata.parse_errors")) if rules else verdict(updates, (F.lit(False), "none"), errors=F.col("metadata.parse_errors"))


def text_gate(items: DataFrame) -> DataFrame:
    """The gate of text items: envelope only; no rule looks at how old a claim is."""
    return verdict(items, (F.col("event_type") == "unknown", "unknown_event_type"), errors=F.col("metadata.parse_errors"))


def reject_histogram(gated: DataFrame) -> DataFrame:
    """Rows per reason; a row may have several."""
    return gated.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("rejects"))


def run_counters(gated: DataFrame, keys: list[str]) -> DataFrame:
    """raw_events, clean_events, quarantined_events of each run."""
    return gated.groupBy(*keys).agg(F.count("*").alias("raw_events"), F.count_if("accepted").alias("clean_events"), F.count_if(~F.col("accepted")).alias("quarantined_events"))


def high_water(events: DataFrame, keys: list[str], sequence: str = "sequence") -> DataFrame:
    """The highest sequence of each key."""
    return events.groupBy(*keys).agg(F.max(sequence).alias("high_water"))


def recent_high_water(listing: DataFrame, events: DataFrame, streams: DataFrame, now: Column, max_age_seconds: float, newest: int = 50, sequence: str = "sequence") -> DataFrame:
    """Where incremental loads stand on disk: lane, symbol, high_water, run_id of the newest young run with an id of the symbol.

    streams: lane, symbol, current_run (left out; may be null). listing: lane, run_id, started_at. Only the `newest` runs of at most that age
    count; empty ones don't end the search. The few runs that count choose by a join what is read of the events, so
    where those are partitioned by lane and run, nothing else is (dynamic partition pruning). A lane without an id has no row.
    """
    age = (F.unix_micros(now) - F.unix_micros("started_at")) / 1e6
    own = listing.join(streams.select("lane", "current_run").distinct(), "lane").where((F.col("current_run").isNull() | (F.col("run_id") != F.col("current_run"))) & (age <= max_age_seconds))
    young = first_rows(own.select("lane", "run_id").distinct(), ["lane"], [F.desc("run_id")], newest).select("lane", "run_id")
    wanted = young.join(streams.select("lane", "symbol"), "lane")
    top = events.where(F.col(sequence).isNotNull()).join(wanted, ["lane", "run_id", "symbol"]).groupBy("lane", "symbol", "run_id").agg(F.max(sequence).alias("high_water"))
    return top.groupBy("lane", "symbol").agg(F.max_by("high_water", "run_id").alias("high_water"), F.max("run_id").alias("run_id"))


def resume_rule(streams: DataFrame, now: Column, max_gap_seconds: float = 6 * 3600) -> DataFrame:
    """(symbol, cursor_symbol, last_id, updated_at, floor) -> next_id, reset: where an incremental load goes on.

    No cursor: from the newest page. One of another symbol, invalid or too old: the same, and the reason. A floor that was
    found on disk raises the id.
    """
    none = F.col("cursor_symbol").isNull() & F.col("last_id").isNull() & F.col("updated_at").isNull()
    old = (F.unix_micros(now) - F.unix_micros("updated_at")) / 1e6 > max_gap_seconds
    reset = F.when(none, None).when(F.upper(F.coalesce("cursor_symbol", F.lit(""))) != F.upper("symbol"), "cursor_reset_symbol_mismatch").when(F.col("last_id").isNull() | F.col("updated_at").isNull(), "cursor_reset_invalid").when(old, "cursor_reset_stale_gap")
    return streams.withColumn("reset", reset).withColumn("next_id", F.when(none | F.col("reset").isNotNull(), None).otherwise(F.greatest(F.col("last_id"), F.col("floor")) + 1))

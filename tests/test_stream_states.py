"""Streams whose states go on: the whole gate and run verdicts against their batch forms, capped states, batch metrics."""

import datetime as dt
import random
import time
from collections import OrderedDict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import gates, verdicts
from tidemark.streaming import jobs

from test_sources_streams import run_to_table, stream_of

T0 = dt.datetime(2026, 4, 6)
EVENT = "lane string, ord bigint, source string, product string, channel string, event_type string, exchange_time timestamp, received_at timestamp, side string, price double, size double, trade_id string, sequence bigint, metadata struct<subscribe_replay:boolean,parse_errors:array<string>>"


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(key)


def prints(n=240):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        at = T0 + dt.timedelta(seconds=20 * i)
        seq = rng.choice([i, i, i, i - 1, None])
        late = rng.choice([0, 0, 0, 0, 100, -20])
        rows.append((rng.choice("ab"), i, "v", "P", rng.choice(["trades"] * 9 + ["funding"]), rng.choice(["trade"] * 20 + ["unknown"]), at - dt.timedelta(seconds=late), at, rng.choice(["buy", "sell", "buy", "odd"]) if i % 7 == 0 else "buy", rng.choice([1.0] * 9 + [-1.0, None]), rng.choice([1.0] * 9 + [0.0]), rng.choice([str(i), "x"]), seq, (rng.random() < 0.1, ["e"] if rng.random() < 0.05 else [])))
    return rows


def test_gate_and_run_verdicts_of_a_stream_equal_the_batch_ones(spark, tmp_path, rocks):
    rows = prints()
    last = ("flush", 10**9, "v", "P", "trades", "trade", T0 + dt.timedelta(days=9), T0 + dt.timedelta(days=9), "buy", 1.0, 1.0, "1", 1, (False, []))
    window = F.window("received_at", "30 minutes")
    with_run = lambda df: df.withColumns({"run": F.date_format(window["start"], "HHmm"), "ends": window["end"]})
    keys, order = ["lane", "run"], ["received_at", "ord"]
    whole = with_run(spark.createDataFrame(rows, EVENT))
    gated = gates.event_gate(whole, [*keys, "source", "product", "channel"], order)
    stream = stream_of(spark, tmp_path, [rows[:70], rows[70:140], rows[140:], [last]], EVENT)
    live = jobs.event_gate_stream(with_run(stream.withWatermark("received_at", "1 hour")), [*keys, "source", "product", "channel"], order)
    first = run_to_table(live.select("ord", "reasons", "accepted"), spark, tmp_path, "gate_out").where("ord < 1000000")
    assert {(r.ord, tuple(r.reasons), r.accepted) for r in first.collect()} == {(r.ord, tuple(r.reasons), r.accepted) for r in gated.collect()}
    assert len({tuple(r.reasons) for r in gated.collect()}) > 6
    chained = jobs.run_verdicts(live.where("accepted and channel = 'trades'"), [*keys, "ends"], order, F.col("ends"))
    got = run_to_table(chained, spark, tmp_path / "chained", "verdict_out").where("lane <> 'flush'")
    want = verdicts.trades(gated.where("accepted and channel = 'trades'"), keys, order)
    names = [c for c in want.columns if c in got.columns]
    assert {"findings", "replayable", "trade_id_gap_count", "max_clock_skew_ms"} <= set(names)
    assert sorted(map(repr, got.select(*names).collect())) == sorted(map(repr, want.select(*(F.col(c).cast(got.schema[c].dataType) for c in names)).collect()))


def test_a_capped_state_starts_from_a_snapshot(spark, tmp_path, rocks):
    rng = random.Random(9)
    rows = [(rng.choice("fg"), rng.choice(["a", "b", "c", "d", "e", None]), i, rng.choice("xy")) for i in range(90)]
    start = spark.createDataFrame([("f", "a", "x", 1), ("f", "b", "y", 2), ("f", "c", "x", 3), ("f", "z", "x", 4)], "feed string, id string, content_hash string, recency int")
    stream = stream_of(spark, tmp_path, [rows[:20], rows[20:50], rows[50:]], "feed string, id string, poll bigint, content_hash string")
    out = run_to_table(jobs.capped_new_or_edit(stream, "feed", "id", ["poll"], ["feed", "poll"], cap=3, start=start), spark, tmp_path, "cap_out")
    held = {"f": OrderedDict([("c", "x"), ("b", "y"), ("a", "x")]), "g": OrderedDict()}
    want = set()
    for feed, item, poll, value in rows:
        if item is None:
            want.add((poll, "new"))
            continue
        last = held[feed].pop(item, None)
        if last != value:
            want.add((poll, "new" if last is None else "edit"))
        held[feed][item] = value
        if len(held[feed]) > 3:
            held[feed].popitem(last=False)
    assert {(r.poll, r.row_type) for r in out.collect()} == want


def test_observed_counts_become_rows(spark, tmp_path):
    listener = jobs.BatchMetrics("gate")
    spark.streams.addListener(listener)
    try:
        stream = stream_of(spark, tmp_path, [[(1,), (2,)], [(3,), (4,), (5,)]], "x bigint")
        gated = jobs.observed(gates.verdict(stream, (F.col("x") % 2 == 0, "even")), "gate")
        run_to_table(gated.select("x"), spark, tmp_path, "metrics_out")
        for _ in range(100):
            if len(listener.rows) == 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    rows = listener.table(spark).orderBy("batch").collect()
    assert [(r.rows, r.accepted, r.quarantined, r.partial) for r in rows] == [(2, 1, 1, True), (3, 2, 1, True)]
    assert listener.table(spark).select("query").distinct().count() == 1

"""Index rules, day rollups, batches of several tables, worklists, reports and the high water of recent runs."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import curation, gates, verdicts

T0 = datetime(2026, 4, 19)


def test_index_stats_count_entries_that_name_a_run(spark):
    rows = [("a", None), ("a", None), ("b", None), (None, None), ("", None), (None, "torn"), ("c", "torn")]
    got = curation.index_stats(spark.createDataFrame(rows, "run_path string, corrupt string")).first()
    assert got.asDict() == {"raw_entries": 3, "runs": 2, "duplicate_entries": 1, "duplicate_runs": 1, "corrupt_entries": 2}
    none = curation.index_stats(spark.createDataFrame([], "run_path string, corrupt string")).first()
    assert tuple(none) == (0, 0, 0, 0, 0)


def test_latest_line_of_a_run_stands_and_blank_runs_go(spark):
    rows = [("a", "02", 1, 10), ("a", "03", 2, 20), ("a", "03", 3, 30), ("b", None, 4, 1), ("b", None, 5, 2), ("", "09", 6, 9), (None, "09", 7, 9)]
    index = spark.createDataFrame(rows, "run_path string, promoted_at string, ord int, promoted_rows int")
    assert {(r.run_path, r.promoted_rows) for r in curation.latest_index(index).collect()} == {("a", 30), ("b", 2)}


def test_only_changed_days_are_written_again(spark, tmp_path):
    path = f"{tmp_path}/days"
    index = spark.createDataFrame([("a", "d1", "01", 1, 5), ("b", "d2", "01", 2, 7), ("a", "d1", "02", 3, 6)], "run_path string, day string, promoted_at string, ord int, promoted_rows int")
    curation.refresh_days(index.where("ord < 3"), index.where("ord < 3"), path)
    before = set(spark.read.parquet(path).inputFiles())
    curation.refresh_days(index, index.where("ord = 3"), path)
    curation.refresh_days(index, index.where("ord = 3"), path)
    frame = spark.read.parquet(path)
    assert {(r.day, r.promoted_runs, r.promoted_rows, r.latest_promotion) for r in frame.collect()} == {("d1", 1, 6, "02"), ("d2", 1, 7, "01")}
    assert {f for f in before if "day=d2" in f} == {f for f in frame.inputFiles() if "day=d2" in f}
    assert not {f for f in before if "day=d1" in f} & set(frame.inputFiles())


@pytest.mark.parametrize("lost_at", ["a", "b", "marker"])
def test_a_batch_counts_whole_or_not_at_all(spark, tmp_path, lost_at, monkeypatch):
    root = str(tmp_path)
    one = spark.createDataFrame([(1,)], "x int")
    curation.commit({"a": one, "b": one}, root, "1")
    two = {"a": one.select((F.col("x") + 1).alias("x")), "b": one.select((F.col("x") + 1).alias("x"))}
    broken = spark.createDataFrame([(1,)], "x int").select(F.expr("cast(assert_true(x > 5) as int)").alias("x"))
    if lost_at == "marker":
        for name, rows in two.items():
            rows.write.parquet(f"{root}/{name}/batch=2")
    else:
        with pytest.raises(Exception, match="is not true"):
            curation.commit({**two, lost_at: broken}, root, "2")
    read = lambda name: sorted(r.x for r in curation.committed(spark, root, name).collect())
    assert read("a") == read("b") == [1]
    for _ in range(2):  # delivered again, twice
        curation.commit(two, root, "2")
    assert read("a") == read("b") == [1, 2]
    curation.compact_batches(spark, root, ["a", "b"], "all")
    assert read("a") == read("b") == [1, 2] and {r.batch for r in curation.committed(spark, root, "a").collect()} == {"all"}
    curation.commit(two, root, "3")
    assert read("a") == [1, 2, 2]


def test_the_limit_of_a_worklist_counts_open_runs(spark):
    """Newer scored runs never hide an older open one."""
    age = lambda h: T0 - timedelta(hours=h)
    rows = [("l", f"r{9 - i}", age(i), True) for i in range(9)] + [("l", "r0", None, True), ("l", "x", age(500), True), ("l", "r95", age(0), False), ("m", "r1", age(1), True)]
    runs = spark.createDataFrame(rows, "lane string, run_id string, started_at timestamp, has_events boolean")
    scored = runs.where("run_id in ('r9', 'r8', 'r7', 'r4', 'r2')").select("lane", "run_id")
    work = {(r.lane, r.run_id): r.todo for r in verdicts.scoring_worklist(runs, scored, F.lit(T0), 3, 48 * 3600).collect()}
    assert work == {("l", "r9"): False, ("l", "r8"): False, ("l", "r7"): False, ("l", "r6"): True, ("l", "r5"): True, ("l", "r4"): False, ("l", "r3"): True, ("m", "r1"): True}
    every = {r.run_id for r in verdicts.scoring_worklist(runs, scored, F.lit(T0), 99, 48 * 3600).where("lane = 'l' and todo").collect()}
    assert every == {"r6", "r5", "r3", "r1", "r0"}
    assert verdicts.scoring_worklist(runs, scored, F.lit(T0), 2, 48 * 3600, overwrite=True).where("lane = 'l'").count() == 2
    assert verdicts.scoring_worklist(runs, scored, F.lit(T0), 0, 48 * 3600).count() == 0
    given = spark.createDataFrame([("l", "r6", True, []), ("l", "r5", False, ["gap", "crossed"])], "lane string, run_id string, replayable boolean, findings array<string>")
    report = {r.lane: r for r in verdicts.scoring_report(verdicts.scoring_worklist(runs, scored, F.lit(T0), 3, 48 * 3600), given).collect()}
    own = report["l"]
    assert (own.scanned, own.replayable, own.not_replayable, own.skipped_already_scored) == (2, 1, 1, 4)
    assert [tuple(x) for x in own.findings] == [("crossed", 1), ("gap", 1), ("replay_error", 1)] and report["m"].scanned == 0


def test_offload_report_says_what_is_stuck_missing_or_not_configured(spark):
    old = T0 - timedelta(days=30)
    runs = spark.createDataFrame([("a", f"a{i}", old) for i in range(4)] + [("b", "b0", old), ("b", "b1", T0), ("z", "z0", old)], "lane string, run_path string, started_at timestamp")
    policy = spark.createDataFrame([("b", 0, 14, "age_only"), ("a", 1, 14, "indexed"), ("gone", 2, 7, "indexed")], "lane string, lane_rank int, min_age_days int, gate string")
    index = runs.where("run_path in ('a0', 'a1', 'a2')").select("run_path")
    report = lambda known, budget: {r.lane: r for r in curation.offload_report(curation.offload_plan(runs, known, known.limit(0), policy, F.lit(T0), budget), policy, runs).collect()}
    got = report(index, 3)
    assert {k: (r.scanned_runs, r.eligible_runs, r.waiting_runs, r.stuck_runs) for k, r in got.items()} == {"a": (4, 2, 1, 1), "b": (1, 1, 0, 0), "gone": (0, 0, 0, 0), None: (5, 3, 1, 1)}
    assert got[None].findings == ["unconfigured_lane:z", "missing_lane_dir:gone", "stuck_unaccounted_runs:1"] and got[None].status == "warn"
    assert report(index, 0)[None].findings[-1] == "no_offload_candidates"
    fine = curation.offload_plan(runs.where("lane = 'b'"), index, index.limit(0), policy.where("lane = 'b'"), F.lit(T0), 3)
    row = curation.offload_report(fine, policy.where("lane = 'b'"), runs.where("lane = 'b'")).where("lane is null").first()
    assert (row.findings, row.status) == ([], "ok")
    nothing = curation.offload_report(fine.where("false"), policy.where("lane = 'b'"), runs.where("lane = 'b'")).where("lane is null").first()
    assert (nothing.findings, nothing.status) == (["no_offload_candidates"], "ok")


def test_high_water_of_recent_runs_reads_those_runs_alone(spark, tmp_path):
    at = lambda h: T0 - timedelta(hours=h)
    listing = spark.createDataFrame([("l", "r9", at(0)), ("l", "r8", at(1)), ("l", "r7", at(2)), ("l", "r6", at(3)), ("l", "r1", at(99)), ("m", "r7", at(2)), ("l", "odd", None)], "lane string, run_id string, started_at timestamp")
    rows = [("l", "r9", "BTC", 900), ("l", "r7", "BTC", None), ("l", "r7", "ETH", 77), ("l", "r6", "BTC", 60), ("l", "r6", "BTC", 61), ("l", "r1", "BTC", 10_000), ("m", "r7", "ETH", 5)]
    spark.createDataFrame(rows, "lane string, run_id string, symbol string, sequence bigint").write.partitionBy("lane", "run_id").parquet(f"{tmp_path}/e")
    events = spark.read.parquet(f"{tmp_path}/e")
    streams = spark.createDataFrame([("l", "BTC", "r9"), ("m", "BTC", None)], "lane string, symbol string, current_run string")
    found = gates.recent_high_water(listing, events, streams, F.lit(T0), 6 * 3600)
    assert [tuple(r) for r in found.select("lane", "symbol", "high_water", "run_id").collect()] == [("l", "BTC", 61, "r6")]
    assert gates.recent_high_water(listing, events, streams, F.lit(T0), 6 * 3600, newest=2).count() == 0, "only so many runs count"
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression" in plan

"""Curation: quarantine and promotion of runs, idempotent by run; readiness manifests; retention plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .segments import first_rows

_C = F.col


def _marked(runs: DataFrame, key: str, indices: dict[str, DataFrame]) -> DataFrame:
    """The runs, with a column an index that is true where the index has their key.

    Indices are looked up together: a task holds a row for each key of its share that any of them has, and runs stream past unsorted.
    """
    own = [index.select(key, *(F.lit(True if n == name else None).cast("boolean").alias(n) for n in indices)) for name, index in indices.items()]
    marks = reduce(DataFrame.union, own).where(_C(key).isNotNull()).groupBy(key).agg(*(F.max(n).alias(n) for n in indices))
    return runs.join(marks.hint("shuffle_hash"), key, "left")


def quarantine_actions(runs: DataFrame, quarantined: DataFrame, key: str = "run_path") -> DataFrame:
    """runs: key, replayable (null: no verdict) -> action: missing_replay, replayable, already_quarantined, quarantine."""
    own = _marked(runs, key, {"__q": quarantined})
    action = F.when(_C("replayable").isNull(), "missing_replay").when(_C("replayable"), "replayable").when(_C("__q"), "already_quarantined").otherwise("quarantine")
    return own.withColumn("action", action).drop("__q")


def promotion_actions(runs: DataFrame, quarantined: DataFrame, promoted: DataFrame, key: str = "run_path") -> DataFrame:
    """runs: key, replayable, has_events -> action, quarantine first of all that block: missing_replay, quarantined, unreplayable, already_promoted, missing_events, promote."""
    own = _marked(runs, key, {"__q": quarantined, "__p": promoted})
    action = F.when(_C("replayable").isNull(), "missing_replay").when(_C("__q"), "quarantined").when(~_C("replayable"), "unreplayable").when(_C("__p"), "already_promoted").when(~_C("has_events"), "missing_events").otherwise("promote")
    return own.withColumn("action", action).drop("__q", "__p")


def promoted_rows(events: DataFrame, actions: DataFrame, checked_at: Column, tag: str, key: str = "run_path") -> DataFrame:
    """Events of the runs to promote, with where they come from.

    A task holds its share of the runs, a row each; their events stream past and are not sorted.
    """
    own = actions.where("action = 'promote'").select(key, *(c for c in ("replay_summary_path",) if c in actions.columns))
    rows = events.join(own.hint("shuffle_hash"), key)
    return rows.withColumns({"source_run_path": _C(key), "promotion_checked_at": checked_at, "promotion_tag": F.lit(tag)})


def append_once(rows: DataFrame, data: str, index: str, key: str = "run_path") -> None:
    """Data first, then the index that makes it visible; runs that the index has are left out.

    A job that dies between the two leaves data that no reader sees: `visible` reads only runs of the index, by the
    batch that the index names.
    """
    import uuid

    spark = rows.sparkSession
    batch = uuid.uuid4().hex
    try:
        done = spark.read.parquet(index).select(key)
        rows = rows.join(done, key, "left_anti")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
    stamped = rows.withColumn("batch", F.lit(batch))
    stamped.write.mode("append").partitionBy("batch").parquet(data)
    kept = spark.read.parquet(data).where(_C("batch") == batch)
    kept.groupBy(key, "batch").agg(F.count("*").alias("promoted_rows")).write.mode("append").parquet(index)


def commit(tables: dict[str, DataFrame], root: str, batch: str, replaces: list[str] = ()) -> None:
    """Several tables as one batch: each replaces its folder of that batch, and one marker at the end makes all of them count.

    A job that dies before the marker leaves nothing that `committed` reads; the same batch delivered again stands once.
    replaces: batches that no longer count once this one does.
    """
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch}")
    spark = next(iter(tables.values())).sparkSession
    marker = spark.range(1).select(F.array(*map(F.lit, replaces)).cast("array<string>").alias("replaces"))
    marker.coalesce(1).write.mode("overwrite").parquet(f"{root}/_commits/batch={batch}")


def _counting(spark: SparkSession, root: str) -> DataFrame:
    marks = spark.read.schema("batch string, replaces array<string>").option("basePath", f"{root}/_commits").parquet(f"{root}/_commits")
    return marks.join(marks.select(F.explode("replaces").alias("batch")), "batch", "left_anti").select("batch")


def committed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table's rows of the batches whose marker stands and that none replaces; the batch column tells which."""
    data = spark.read.option("basePath", f"{root}/{name}").parquet(f"{root}/{name}")
    return data.withColumn("batch", _C("batch").cast("string")).join(_counting(spark, root), "batch", "left_semi")


def compact_batches(spark: SparkSession, root: str, names: list[str], batch: str) -> None:
    """All batches that count as one: their rows in few files, and one marker that puts it in their place."""
    old = [r.batch for r in _counting(spark, root).collect()]  # a name a batch
    commit({n: committed(spark, root, n).drop("batch").hint("rebalance") for n in names}, root, batch, old)


def quarantine_bundle(actions: DataFrame, verdicts: DataFrame, events: DataFrame, at: Column, order: list[str], key: str = "run_path", n: int = 5) -> dict[str, DataFrame]:
    """What `commit` writes for runs to quarantine: their verdicts, samples of their events, and the index lines that name them."""
    own = actions.where("action = 'quarantine'").select(key)
    bad = verdicts.join(own, key, "left_semi")
    return {"verdict": bad, "samples": sample_rows(events.join(own, key, "left_semi"), [key], order, n), "index": bad.select(key, "findings").withColumn("quarantined_at", at)}


def quarantine_report(actions: DataFrame) -> DataFrame:
    """One row: runs scanned, quarantined and skipped, findings and status (warn if nothing was quarantined)."""
    out = actions.agg(F.count("*").alias("scanned_runs"), F.count_if(_C("action") == "quarantine").alias("quarantined_runs"), F.count_if(_C("action") != "quarantine").alias("skipped_runs"))
    none = _C("quarantined_runs") == 0
    return out.withColumns({"findings": F.array_compact(F.array(F.when(none, F.lit("no_quarantine_changes")))), "status": F.when(none, "warn").otherwise("ok")})


def visible(data: DataFrame, index: DataFrame, key: str = "run_path") -> DataFrame:
    """Rows of runs and batches that the index has."""
    return data.join(index.select(key, "batch"), [key, "batch"], "left_semi").drop("batch")


def sample_rows(rows: DataFrame, keys: list[str], order: list[str], n: int = 5) -> DataFrame:
    """The first n rows of each run, in one array."""
    first = rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(_C("__n") <= n)
    body = [c for c in rows.columns if c not in keys]
    return first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("__n", F.struct(*body).alias("row")))), lambda x: x["row"]).alias("samples"))


def curated_once(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Known repeats of curated rows, kept once: the earliest in order."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def _named(key: str) -> Column:
    return _C(key).isNotNull() & (_C(key).cast("string") != "")


def latest_index(index: DataFrame, key: str = "run_path", at: str = "promoted_at", order: str = "ord") -> DataFrame:
    """One row a run: the greatest time (none is the least), the later line of equals. Lines without a run are none."""
    return index.where(_named(key)).groupBy(key).agg(F.max_by(F.struct(*(c for c in index.columns if c != key)), F.struct(at, order)).alias("r")).select(key, "r.*")


def index_stats(index: DataFrame, corrupt: str = "corrupt", key: str = "run_path") -> DataFrame:
    """Entries that name a run, runs, entries beyond each run's first, runs with such entries; torn lines, which are no entries."""
    per_run = index.groupBy(F.when(_C(corrupt).isNull() & _named(key), _C(key)).alias("run")).agg(F.count("*").alias("n"), F.count(corrupt).alias("torn"))
    runs = lambda c: F.coalesce(F.sum(F.when(_C("run").isNotNull(), c)), F.lit(0)).cast("bigint")
    return per_run.agg(runs(_C("n")).alias("raw_entries"), F.count("run").alias("runs"), runs(_C("n") - 1).alias("duplicate_entries"), runs((_C("n") > 1).cast("int")).alias("duplicate_runs"), F.coalesce(F.sum("torn"), F.lit(0)).cast("bigint").alias("corrupt_entries"))


def refresh_days(index: DataFrame, changed: DataFrame, path: str, day: str = "day", key: str = "run_path", **how: str) -> None:
    """Promotion rollups of the days that index lines came in for (`changed`: day), written over those days alone.

    A run has one day, so a day is whole with the lines of its own runs; the days' index lines are all that is read again.
    """
    own = index.join(changed.select(day).distinct(), day, "left_semi")
    rollup = promotion_rollup(latest_index(own, key, **how), [day])
    rollup.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def promotion_rollup(index: DataFrame, keys: list[str]) -> DataFrame:
    """Runs, rows and latest promotion per day or lane and day, of one line a run: see `latest_index`."""
    return index.groupBy(*keys).agg(F.count("*").alias("promoted_runs"), F.coalesce(F.sum("promoted_rows"), F.lit(0)).cast("bigint").alias("promoted_rows"), F.max("promoted_at").alias("latest_promotion"))


def replay_rollup(verdicts: DataFrame, keys: list[str], run: str = "run_id") -> DataFrame:
    """Verdict counts per day; the day's gap class is that of the last run which has one."""
    tagged = _C("gap_detection").isNotNull() & (_C("gap_detection") != "unknown")
    some = lambda c: F.count_if(F.coalesce(_C(c) > 0, F.lit(False)))
    return verdicts.groupBy(*keys).agg(F.count("replayable").alias("summaries"), F.count_if(_C("replayable").isNull()).alias("missing_summaries"), F.count_if("replayable").alias("replayable_runs"), F.count_if(~_C("replayable")).alias("unreplayable_runs"), some("gap_count").alias("gap_runs"), some("snapshot_gap_count").alias("snapshot_gap_runs"), some("crossed_book_count").alias("crossed_runs"), F.max_by("gap_detection", F.when(tagged, _C(run))).alias("gap_detection"))


def day_views(promoted: DataFrame, replayed: DataFrame, keys: list[str], current: Column, day: str = "day", files: DataFrame | None = None) -> DataFrame:
    """Every day that any side has, with readiness (building, ready, ready_with_quarantine, missing) and notes."""
    out = promoted.join(replayed, keys, "full")
    out = out.join(files, keys, "full") if files is not None else out
    out = out.fillna(0, [c for c in out.columns if c.endswith(("_runs", "_rows", "summaries", "files", "bytes"))])
    has = (_C("promoted_rows") > 0) | (_C("promoted_runs") > 0)
    poor = (_C("unreplayable_runs") > 0) | (_C("missing_summaries") > 0)
    ready = F.when(_C(day) == current, "building").when(has & poor, "ready_with_quarantine").when(has, "ready").otherwise("missing")
    notes = F.array_compact(F.array(F.when(_C("unreplayable_runs") > 0, F.lit("raw_has_unreplayable_runs")), F.when(_C("missing_summaries") > 0, F.lit("missing_replay_summaries")), F.when(_C("promoted_runs") == 0, F.lit("no_promoted_runs"))))
    return out.withColumns({"readiness": ready, "notes": notes})


# Gap classes, the worst first.
CLASSES = ("none_native", "checksum", "sequence")


def lane_views(days: DataFrame, lane: str = "lane", day: str = "day") -> DataFrame:
    """Per lane: days by readiness, totals, the latest ready day, and the worst gap class seen (none: unknown)."""
    rank = F.array_position(F.array(*map(F.lit, CLASSES)), _C("gap_detection"))
    worst = F.min(F.when(rank > 0, rank))
    of = lambda s: F.count_if(_C("readiness") == s).alias(f"{s}_days")
    out = days.groupBy(lane).agg(*map(of, ("ready", "ready_with_quarantine", "building", "missing")), F.sum("promoted_rows").alias("curated_rows"), F.sum("promoted_runs").alias("promoted_runs"), F.max(F.when(_C("readiness").startswith("ready"), _C(day))).alias("latest_ready_day"), worst.cast("int").alias("__w"))
    return out.withColumn("gap_detection", F.coalesce(F.get(F.array(*map(F.lit, CLASSES)), _C("__w") - 1), F.lit("unknown"))).drop("__w")


def ordered_lanes(lanes: DataFrame) -> DataFrame:
    """Lanes (a row each, so few) by venue, dataset and instrument, those without one first, with their place in that order."""
    order = ["venue", "dataset", F.coalesce("instrument", F.lit(""))]
    return lanes.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("bigint")).orderBy("place")


def lane_summary(lanes: DataFrame) -> DataFrame:
    """lanes: lane, venue, dataset and the columns of `lane_views` -> one row of totals."""
    total = lambda c: F.sum(c).cast("bigint").alias(c)
    return lanes.agg(F.count("*").alias("lanes"), F.array_sort(F.collect_set("venue")).alias("venues"), F.array_sort(F.collect_set("dataset")).alias("datasets"), *(total(c) for c in ("ready_days", "ready_with_quarantine_days", "building_days", "missing_days", "curated_rows", "promoted_runs")))


def day_summary(days: DataFrame) -> DataFrame:
    """Days by readiness."""
    return days.groupBy("readiness").agg(F.count("*").alias("days"), F.sum("promoted_rows").cast("bigint").alias("promoted_rows"))


def promoted_per_run(runs: DataFrame, index: DataFrame, key: str = "run_path") -> DataFrame:
    """Recent runs with the sum of rows that the index has for them."""
    return runs.join(index.groupBy(key).agg(F.sum("promoted_rows").alias("promoted_rows")), key, "left").fillna(0, ["promoted_rows"])


def retention_candidates(runs: DataFrame, policy: DataFrame, now: Column, default_days: int = 14) -> DataFrame:
    """Runs at or beyond their lane's age (lane, max_age_days), with bytes. runs: lane, run_id, started_at, bytes."""
    own = runs.join(policy, "lane", "left").withColumn("max_age_days", F.coalesce("max_age_days", F.lit(default_days)))
    age = (F.unix_micros(now) - F.unix_micros("started_at")) / 86_400_000_000
    return own.withColumn("age_days", age).where("age_days >= max_age_days")


def empty_parquet(listing: DataFrame) -> DataFrame:
    """Parquet files of no bytes."""
    return listing.where(_C("file").endswith(".parquet") & (_C("bytes") == 0))


def offload_plan(runs: DataFrame, promoted: DataFrame, quarantined: DataFrame, policy: DataFrame, now: Column, budget: int, key: str = "run_path") -> DataFrame:
    """Runs older than their lane's age -> state: move (within a budget over all lanes, in lane order, oldest first), wait, stuck.

    policy: lane, lane_rank, min_age_days, gate (indexed: only runs that an index has may move; age_only: all may).
    """
    known = promoted.select(key).union(quarantined.select(key)).distinct().withColumn("__known", F.lit(True))
    age = (F.unix_micros(now) - F.unix_micros("started_at")) / 86_400_000_000
    old = runs.join(policy, "lane").where(age > _C("min_age_days")).join(known, key, "left")
    old = old.withColumn("ok", (_C("gate") == "age_only") | _C("__known").isNotNull()).drop("__known")
    may = old.where("ok").groupBy("lane", "lane_rank").agg(F.count("*").alias("n"))
    # a lane's place in the budget: eligible runs of the lanes before it (a row a lane), then its own by age
    ahead = may.withColumn("ahead", F.coalesce(F.sum("n").over(Window.orderBy("lane_rank", "lane").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("lane", "ahead")
    # a run's place in its lane: those of earlier days, by their counts, and those before it on its own day
    own = old.withColumn("__day", F.to_date("started_at"))
    days = own.groupBy("lane", "ok", "__day").agg(F.count("*").alias("__c"))
    earlier = F.coalesce(F.sum("__c").over(Window.partitionBy("lane", "ok").orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    days = days.select("lane", "ok", "__day", earlier.alias("__earlier"))
    place = F.row_number().over(Window.partitionBy("lane", "ok", "__day").orderBy("started_at", key)) + _C("__earlier")
    out = own.join(days, ["lane", "ok", "__day"]).withColumn("place", place).drop("__day", "__earlier").join(ahead, "lane", "left")
    state = F.when(~_C("ok"), "stuck").when(_C("ahead") + _C("place") <= budget, "move").otherwise("wait")
    return out.withColumn("state", state).drop("ok", "place", "ahead")


def stuck_by_lane(plan: DataFrame, key: str = "run_path", n: int = 5) -> DataFrame:
    """Stuck runs per lane: the exact count, and the first few as examples, found in parts of a lane first."""
    own = plan.where("state = 'stuck'").select("lane", key)
    examples = first_rows(own, ["lane"], [key], n).groupBy("lane").agg(F.array_sort(F.collect_list(key)).alias("examples"))
    return own.groupBy("lane").agg(F.count("*").alias("stuck")).join(examples, "lane")


def offload_report(plan: DataFrame, policy: DataFrame, on_disk: DataFrame) -> DataFrame:
    """A row for every configured lane and one for all (lane null), in one pass over the plan: scanned, eligible, waiting and stuck runs.

    The row for all has the findings (lanes that are on disk only; configured lanes without a folder, in lane order; stuck
    runs; nothing to move) and the status: warn if there is a finding but the last.
    """
    of = lambda state: F.count_if(_C("state") == state)
    counts = plan.rollup("lane").agg(F.count("*").alias("scanned_runs"), of("move").alias("eligible_runs"), of("wait").alias("waiting_runs"), of("stuck").alias("stuck_runs"), F.grouping("lane").alias("total"))
    lanes = policy.select("lane", "min_age_days").join(counts.where("total = 0").drop("total"), "lane", "left")
    both = lane_differences(on_disk, policy.select("lane")).join(policy.select("lane", "lane_rank"), "lane", "left")
    name = F.when(_C("problem") == "missing_lane", "missing_lane_dir").otherwise(_C("problem"))
    sort = F.struct((_C("problem") == "missing_lane").alias("late"), "lane_rank", "lane", F.concat_ws(":", name, "lane").alias("finding"))
    odd = both.agg(F.transform(F.array_sort(F.collect_list(sort)), lambda x: x["finding"]).alias("odd"))  # lanes are few: configured ones and folders
    total = counts.where("total = 1").drop("total", "lane").withColumn("one", F.lit(1)).join(odd.withColumn("one", F.lit(1)), "one", "full").drop("one").fillna(0)
    found = F.concat(F.coalesce("odd", F.array().cast("array<string>")), F.array_compact(F.array(F.when(_C("stuck_runs") > 0, F.concat(F.lit("stuck_unaccounted_runs:"), "stuck_runs")), F.when(_C("eligible_runs") == 0, F.lit("no_offload_candidates")))))
    total = total.withColumn("findings", found).withColumn("status", F.when(F.exists("findings", lambda x: x != "no_offload_candidates"), "warn").otherwise("ok")).drop("odd")
    return lanes.unionByName(total, allowMissingColumns=True).fillna(0, ["scanned_runs", "eligible_runs", "waiting_runs", "stuck_runs"])


def lane_differences(on_disk: DataFrame, configured: DataFrame) -> DataFrame:
    """(lane, problem): lanes on disk but not configured, and the other way round."""
    a = on_disk.select("lane").distinct().join(configured, "lane", "left_anti").select("lane", F.lit("unconfigured_lane").alias("problem"))
    return a.union(configured.select("lane").distinct().join(on_disk, "lane", "left_anti").select("lane", F.lit("missing_lane").alias("problem")))


def growth_alert(counts: DataFrame, baseline: int, at: str = "reported_at") -> DataFrame:
    """Report history with an alert where the stuck count exceeds its baseline and the report before."""
    prior = F.lag("stuck").over(Window.partitionBy("lane").orderBy(at))
    return counts.withColumns({"prior": prior, "alert": (_C("stuck") > baseline) & (prior.isNull() | (_C("stuck") > prior))})


def copy_differences(source: DataFrame, copy: DataFrame, key: str = "file", size: str = "bytes") -> DataFrame:
    """Files that a copy lacks, has beyond the source, or has in another size."""
    both = source.select(key, _C(size).alias("source_bytes")).join(copy.select(key, _C(size).alias("copy_bytes")), key, "full")
    problem = F.when(_C("copy_bytes").isNull(), "missing").when(_C("source_bytes").isNull(), "extra").when(_C("source_bytes") != _C("copy_bytes"), "size")
    return both.withColumn("problem", problem).where("problem is not null")

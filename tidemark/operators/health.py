"""Health of lanes, jobs and partitions. "Now" is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_C = F.col
LOW_RATIO, QUARANTINE_RATIO = 0.25, 0.20


def clean_ratio() -> Column:
    """clean / raw, or clean / (clean + quarantined) where raw is not known."""
    raw = F.when(_C("raw_events") > 0, _C("raw_events")).otherwise(_C("clean_events") + _C("quarantined_events"))
    return F.when(raw > 0, _C("clean_events") / raw)


def lane_quality(runs: DataFrame, now: Column, lane: str = "lane", run: str = "run_id", recent: int = 20, streak: int = 3, max_age_seconds: float = 7200) -> DataFrame:
    """Per lane over recent runs: totals, ratio, latest verdict and its age, and a low streak of the newest runs.

    runs: raw_events, clean_events, quarantined_events, replayable, scored_at.
    """
    n = F.row_number().over(Window.partitionBy(lane).orderBy(F.desc(run)))
    own = runs.withColumns({"n": n, "ratio": clean_ratio()}).where(_C("n") <= recent)
    out = own.groupBy(lane).agg(F.count("*").alias("runs"), F.sum("raw_events").alias("raw_events"), F.sum("clean_events").alias("clean_events"), F.sum("quarantined_events").alias("quarantined_events"), F.max_by("replayable", F.when(_C("replayable").isNotNull(), _C(run))).alias("latest_replayable"), F.max("scored_at").alias("scored_at"), F.max(F.when(_C("n") <= streak, _C("ratio"))).alias("__hi"), F.count(F.when(_C("n") <= streak, _C("ratio"))).alias("__k"))
    age = (F.unix_micros(now) - F.unix_micros("scored_at")) / 1e6
    out = out.withColumns({"clean_ratio": clean_ratio(), "low_streak": (_C("__k") == streak) & (_C("__hi") < LOW_RATIO), "verdict_age_seconds": age})
    return out.withColumn("findings", F.array_compact(F.array(F.when(~F.coalesce("latest_replayable", F.lit(True)), F.lit("latest_run_unreplayable")), F.when(F.coalesce(age > max_age_seconds, F.lit(True)), F.lit("verdict_too_old")), F.when(_C("low_streak"), F.lit("low_clean_ratio"))))).drop("__hi", "__k")


def quarantine_ratio(runs: DataFrame, keys: list[str], limit: float = QUARANTINE_RATIO) -> DataFrame:
    """(quarantined - replayed at subscribe) / raw, or quarantined / (clean + quarantined) where raw is not known; flagged above the limit."""
    total = lambda c: F.sum(F.coalesce(c, F.lit(0)))
    out = runs.groupBy(*keys).agg(total("raw_events").alias("raw_events"), total("clean_events").alias("clean_events"), total("quarantined_events").alias("quarantined_events"), total("subscribe_replay").alias("subscribe_replay"))
    both = _C("clean_events") + _C("quarantined_events")
    ratio = F.when(_C("raw_events") > 0, (_C("quarantined_events") - _C("subscribe_replay")) / _C("raw_events")).when(both > 0, _C("quarantined_events") / both)
    return out.withColumn("ratio", ratio).withColumn("flagged", F.coalesce(_C("ratio") > limit, F.lit(False)))


def job_freshness(log: DataFrame, now: Column, job: str = "job", at: str = "finished_at", factor: float = 2.5) -> DataFrame:
    """Per job: latest row and whether it is older than max(interval, segment) * factor. log: status, interval_seconds, segment_seconds."""
    last = log.groupBy(job).agg(F.max(at).alias(at), *(F.max_by(c, at).alias(c) for c in ("status", "interval_seconds", "segment_seconds")))
    age = (F.unix_micros(now) - F.unix_micros(at)) / 1e6
    return last.withColumn("age_seconds", age).withColumn("stale", age > F.greatest("interval_seconds", "segment_seconds") * factor)


def recent_failures(log: DataFrame, now: Column, family: str = "family", at: str = "finished_at", seconds: float = 3600, least: int = 2) -> DataFrame:
    """Families with repeated failures in the last hour."""
    since = (F.unix_micros(now) - F.unix_micros(at)) / 1e6
    return log.where((_C("status") != "ok") & (since <= seconds)).groupBy(family).agg(F.count("*").alias("failures"), F.max(at).alias("latest")).where(_C("failures") >= least)


def partition_freshness(listing: DataFrame, keys: list[str]) -> DataFrame:
    """Latest change of Parquet files per dataset and source. listing: keys, file, modified."""
    return listing.where(_C("file").endswith(".parquet")).groupBy(*keys).agg(F.max("modified").alias("latest"))


def silences(frames: DataFrame, keys: list[str], at: str, seconds: float, order: list[str] | None = None) -> DataFrame:
    """Gaps between a key's frames beyond a timeout."""
    gap = (F.unix_micros(at) - F.unix_micros(F.lag(at).over(Window.partitionBy(*keys).orderBy(at, *(order or []))))) / 1e6
    return frames.withColumn("silence_seconds", gap).where(_C("silence_seconds") > seconds)

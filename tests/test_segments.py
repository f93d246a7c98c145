"""Segmented scans, chunked folds, rebalanced sinks and upserts: equal to the plain form, and no task holds a hot key."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import book, quotes, segments
from tidemark.sources import sinks


def rows_of(frame, *names):
    return sorted(map(repr, frame.select(*names).collect()))


def hot_rows(spark, n=4000):
    """Half of all rows are of one key, some of none; times repeat."""
    rng = random.Random(3)
    rows = [("hot" if i % 2 else rng.choice(["a", "b", None, "c"]), rng.randrange(n // 3), i, rng.choice([None, 1, 2, 3])) for i in range(n)]
    return spark.createDataFrame(rows, "k string, at int, ord int, v int")


def test_last_values_equal_a_window_and_cut_a_hot_key(spark):
    rows = hot_rows(spark)
    pieces = segments.cut(rows, ["k"], ["at", "ord"], pieces=16)
    sizes = {(r["k"], r[segments.PIECE]): r["count"] for r in pieces.groupBy("k", segments.PIECE).count().collect()}
    hot = [n for (k, _), n in sizes.items() if k == "hot"]
    assert len(hot) >= 6 and max(hot) <= 2 * 4000 // 16
    for current in (False, True):
        got = segments.last_values(pieces, ["k"], ["at", "ord"], {"prior": F.col("v"), "row": F.struct("ord")}, current=current)
        w = Window.partitionBy("k").orderBy("at", "ord").rowsBetween(Window.unboundedPreceding, 0 if current else -1)
        want = rows.withColumns({"prior": F.last("v", ignorenulls=True).over(w), "row": F.last(F.struct("ord")).over(w)})
        assert rows_of(got, "k", "ord", "prior", "row") == rows_of(want, "k", "ord", "prior", "row")
    plan = got._jdf.queryExecution().executedPlan().toString()
    whole = [line for line in plan.splitlines() if " Window [" in line and segments.PIECE not in line.split("specifiedwindowframe")[-1]]
    assert not whole, "no window over rows is partitioned by the key alone"


def test_as_of_equals_a_join(spark):
    rng = random.Random(4)
    left = spark.createDataFrame([("hot" if i % 2 else "b", rng.randrange(500), i) for i in range(800)], "k string, at int, id int")
    right = spark.createDataFrame([("hot" if i % 3 else "c", 3 * i, i) for i in range(300)], "k string, at int, v int")
    got = {r.id: r.v for r in book.as_of(left, right, ["k"], "at", ["v"]).collect()}
    known = right.collect()
    for r in left.collect():
        before = [(x.at, x.v) for x in known if x.k == r.k and x.at <= r.at]
        assert got[r.id] == (max(before)[1] if before else None)
    assert book.as_of(left.limit(0), right, ["k"], "at", ["v"]).count() == 0


def updates(spark, n=1500):
    """One run with a book of most events, a run of many short books, and levels of size 0, below 0 and repeated prices."""
    rng = random.Random(5)
    levels = lambda: [(float(rng.randrange(30)), float(rng.choice([0, 0, 1, 2, -1]))) for _ in range(rng.randrange(4))]
    rows = [("long" if i % 2 else "short", i, "snapshot" if i in (1, 21) or (i % 2 == 0 and i % 40 == 0) else "delta", levels(), levels()) for i in range(n)]
    level = "array<struct<price:double,size:double>>"
    frame = spark.createDataFrame(rows, f"run string, ord int, event_type string, bids {level}, asks {level}")
    return book.sub_books(frame, ["run"], ["ord"])


def test_chunked_fold_equals_the_serial_one(spark):
    own = updates(spark)
    pieces = book.with_starts(own, ["run"], ["ord"], pieces=12)
    of = pieces.where("run = 'long' and event_type <> 'start'").groupBy("book", segments.PIECE).count().collect()
    assert len(of) >= 5 and max(r["count"] for r in of) <= 2 * 1500 // 12
    for fold in (lambda u: book.fold(u, ["run"], "ord", top=3), lambda u: book.best_prices(u, ["run"], "ord")):
        chunked = fold(own)
        whole, book.with_starts = book.with_starts, lambda u, *_: u
        try:
            serial = fold(own)
        finally:
            book.with_starts = whole
        assert rows_of(chunked, *chunked.columns) == rows_of(serial, *serial.columns)
        assert chunked.count() == own.count()


def test_first_rows_equal_a_ranked_window(spark):
    rows = hot_rows(spark)
    want = rows.withColumn("place", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("at"), "ord"))).where("place <= 700")
    got = segments.first_rows(rows, ["k"], [F.desc("at"), "ord"], 700, parts=8)
    assert rows_of(got, "k", "ord", "place") == rows_of(want, "k", "ord", "place")


def test_seen_state_goes_on_from_a_start_and_keeps_its_cap(spark):
    items = spark.createDataFrame([("f", "a", "h2", 5), ("f", "b", "h1", 4), ("f", None, "x", 9), ("g", "a", "h9", 1)], "feed string, id string, content_hash string, at int")
    start = spark.createDataFrame([("f", "a", "h1", 90), ("f", "c", "h3", 80), ("f", "d", "h4", 70)], items.schema)
    got = {(r.feed, r.id): (r.content_hash, r.recency) for r in quotes.seen_state(items, "feed", "id", "at", cap=3, start=start).collect()}
    assert got == {("f", "a"): ("h2", 1), ("f", "b"): ("h1", 2), ("f", "c"): ("h3", 3), ("g", "a"): ("h9", 1)}
    clean = spark.createDataFrame([("f", "a", "h2"), ("f", "b", "other")], "feed string, id string, content_hash string")
    state = quotes.seen_state(items, "feed", "id", "at", start=start)
    assert {(r.feed, r.id) for r in quotes.proven_state(state, clean, "feed", "id").collect()} == {("f", "a")}


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(40_000).select(F.lit("binance").alias("source"), F.when(F.col("id") % 10 == 0, F.concat(F.lit("P"), F.col("id") % 7)).otherwise("HOT").alias("product"), F.lit("2026-01-01").cast("timestamp").alias("event_time"), F.sha2(F.col("id").cast("string"), 256).alias("body"))
    keep = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    spark.conf.set("spark.sql.shuffle.partitions", "199")
    try:
        sinks.append_dataset(rows, f"{tmp_path}/d")
    finally:
        for c, v in keep.items():
            spark.conf.set(c, v)
    files = [f.rsplit("instrument=", 1)[1].split("/")[0] for f in spark.read.parquet(f"{tmp_path}/d").inputFiles()]
    assert files.count("HOT") >= 4
    assert sorted(files.count(f"P{i}") for i in range(7))[:6] == [1] * 6, "a cold partition is one file, unless it is dealt to the hot one's place"
    sinks.append_dataset(rows.where("product = 'HOT'").coalesce(1), f"{tmp_path}/e", rows_per_file=10_000)
    assert len(spark.read.parquet(f"{tmp_path}/e").inputFiles()) >= 4
    plan = sinks.read_dataset(spark, f"{tmp_path}/d", "instrument = 'P3'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(instrument" in plan and "(instrument" in plan.split("PartitionFilters:")[1]


def test_upsert_replaces_by_key_and_leaves_other_days(spark, tmp_path):
    path = f"{tmp_path}/u"
    one = spark.createDataFrame([(1, "d1", "old"), (2, "d1", "old"), (3, "d2", "old")], "run int, day string, v string")
    sinks.upsert(one, path, ["run"], "day")
    before = {f for f in spark.read.parquet(path).inputFiles() if "day=d2" in f}
    for _ in range(2):
        sinks.upsert(spark.createDataFrame([(2, "d1", "new"), (4, "d1", "new")], one.schema), path, ["run"], "day")
    assert {(r.run, r.day, r.v) for r in spark.read.parquet(path).collect()} == {(1, "d1", "old"), (2, "d1", "new"), (3, "d2", "old"), (4, "d1", "new")}
    assert {f for f in spark.read.parquet(path).inputFiles() if "day=d2" in f} == before

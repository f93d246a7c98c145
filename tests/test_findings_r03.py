"""What the findings of round 3 named: the same results by less work."""

import json
import random
import zlib

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import book, quotes
from tidemark.streaming import jobs

from test_sources_streams import rocks, stream_of  # noqa: F401

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def random_updates(spark):
    rng = random.Random(11)
    side = lambda: [(rng.randrange(60) / 4, rng.choice([0.0, 0.5, 12.25, 3.0, -1.0])) for _ in range(rng.randrange(5))]
    rows = [(run, i, rng.choice(["delta"] * 9 + ["snapshot", None]), side(), None if rng.random() < 0.1 else side()) for run in ("a", "b", None) for i in range(300)]
    level = "array<struct<price:double,size:double>>"
    return book.sub_books(spark.createDataFrame(rows, f"run string, ord int, event_type string, bids {level}, asks {level}"), ["run"], ["ord"])


def test_checksums_equal_those_of_the_folded_books(spark):
    rows = random_updates(spark)
    for depth, top in ((10, 10), (3, 10), (None, 4)):
        u = rows if depth else rows.where("run is not null")  # pieces of unbounded books are joined by run
        states = book.fold(u, ["run"], "ord", depth=depth, top=top)
        want = states.select("run", "book", "ord", book.book_crc(F.col("top_bids"), F.col("top_asks"), 2, 8, top).alias("crc"))
        got = book.checksums(u, ["run"], "ord", 2, 8, depth=depth, top=top).drop("event_type")
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect()))
        assert got.schema["crc"].dataType == want.schema["crc"].dataType


def test_checksums_round_as_plain_formatting_does(spark):
    level = "array<struct<price:double,size:double>>"
    rows = spark.createDataFrame([("r", 0, "snapshot", [(0.0, 0.125)], [(-0.0, 2.5)])], f"run string, ord int, event_type string, bids {level}, asks {level}").withColumn("book", F.lit(1))
    digits = lambda x, n: f"{x:.{n}f}".replace(".", "").lstrip("0") or "0"
    want = zlib.crc32((digits(-0.0, 1) + digits(2.5, 2) + digits(0.0, 1) + digits(0.125, 2)).encode())
    assert book.checksums(rows, ["run"], "ord", 1, 2).first().crc == want


def test_checksum_verdict_formats_no_book_again(spark):
    from tidemark.plans.source_queries import checksum_verdict

    assert "format_string" not in plan(checksum_verdict(spark, SF))


def test_book_checksum_formats_no_book_again(spark):
    from tidemark.plans.market_queries import book_checksum

    assert "format_string" not in plan(book_checksum(spark, SF))


def test_market_objects_are_parsed_once_and_by_many_tasks(spark):
    from tidemark.plans.curation_queries import market_quotes

    df = market_quotes(spark, SF)
    assert "get_json_object" not in plan(df)
    assert df.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_market_fields_of_odd_objects(spark):
    items = [
        '{"ticker":"a","status":"OPEN","yes_bid":"0.5","yes_ask":50,"no_ask":1.5,"yes_ask_dollars":null,"no_bid_dollars":"0.25","volume":1e3,"liquidity":"NaN","fractional_trading_enabled":true}',
        '{"ticker":{"x":[1,"b"]},"status":null,"yes_ask":1,"event_ticker":3}',
        '{"ticker":"cut","yes_ask":5', "[1]", "", None, "{}",
    ]
    rows = spark.createDataFrame(list(enumerate(items)), "n int, item string")
    got = quotes.market_candidates(rows, F.lit("2026-01-01").cast("timestamp"))
    one, two, *others = sorted(got.collect())
    assert (one.ticker, one.status, one.yes_bid, one.yes_ask, one.no_ask, one.no_bid, one.volume, one.liquidity, one.fractional_trading_enabled) == ("a", "open", 0.5, 0.5, 0.015, 0.25, 1000.0, None, True)
    assert (two.ticker, two.status, two.yes_ask, two.event_ticker) == ('{"x":[1,"b"]}', None, 0.01, "3")
    assert [(r.n, r.ticker, r.yes_ask, r.findings) for r in others] == [(n, None, None, ["empty_best_ask"]) for n in range(2, 7)]


def test_promoted_rows_are_joined_once_for_all_batches(spark, monkeypatch):
    from tidemark.operators import curation
    from tidemark.plans.curation_queries import promotion_commit

    given, commit = [], curation.commit
    monkeypatch.setattr(curation, "commit", lambda tables, *more: (given.extend(map(plan, tables.values())), commit(tables, *more)))
    assert promotion_commit(spark, SF).count() > 0
    assert len(given) == 6 and not any("Join" in p for p in given)


def test_promoted_rows_do_not_sort_events(spark):
    from tidemark.plans.curation_queries import promoted_rows

    assert "strategy=shuffle_hash" in plan(promoted_rows(spark, SF))


def test_promotion_looks_all_indices_up_at_once_without_sorts(spark):
    from tidemark.plans.curation_queries import promoted_rows, promotion_actions

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as on tables that are too large for it
    try:
        for query, joins in ((promotion_actions, 1), (promoted_rows, 2)):
            nodes = query(spark, SF)._jdf.queryExecution().executedPlan().toString().split("\n")
            assert sum("ShuffledHashJoin" in n for n in nodes) == joins
            assert not any("SortMergeJoin" in n or "Sort [" in n for n in nodes)
    finally:
        spark.conf.set(key, before)


def test_actions_of_runs_that_indices_name_twice_or_not(spark):
    from tidemark.operators import curation

    rows = [("a", True, True), ("a", True, True), ("b", True, True), ("c", False, True), ("d", True, True), ("e", True, False), ("f", None, True), (None, True, True), ("g", True, True)]
    runs = spark.createDataFrame(rows, "run_path string, replayable boolean, has_events boolean")
    index = lambda *names: spark.createDataFrame([(n, 1) for n in names], "run_path string, more int")
    quarantined, promoted = index("b", "b", None, "c", "f"), index("d", None, "b", "d", "x", "e")
    got = [(r.run_path, r.action) for r in curation.promotion_actions(runs, quarantined, promoted).collect()]
    want = ["promote", "promote", "quarantined", "quarantined", "already_promoted", "already_promoted", "missing_replay", "promote", "promote"]
    assert sorted(map(repr, got)) == sorted(repr((r[0], action)) for r, action in zip(rows, want, strict=True))
    assert curation.promotion_actions(runs, quarantined, promoted).columns == [*runs.columns, "action"]
    got = [(r.run_path, r.action) for r in curation.quarantine_actions(runs, quarantined).collect()]
    want = ["replayable", "replayable", "replayable", "already_quarantined", "replayable", "replayable", "missing_replay", "replayable", "replayable"]
    assert sorted(map(repr, got)) == sorted(repr((r[0], action)) for r, action in zip(rows, want, strict=True))


def test_content_hash_of_controls_and_backslashes_without_patterns(spark):
    import hashlib
    import json

    from tidemark.functions import scalars as S

    rng = random.Random(2)
    parts = ["\\", "\\u001F", "u001F", "\\u000b", "\x01", "\x0b", "\x0e", "\x1f", "\x1a", "\n", '"', "a", "é", "/"]
    texts = [None, "", *("".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(400))]
    df = spark.createDataFrame([(x, y) for x, y in zip(texts, reversed(texts))], "a string, b string")
    out = df.select("a", "b", S.content_hash(F.col("a"), F.col("b")).alias("h"))
    assert "regexp" not in plan(out)
    for r in out.collect():
        want = json.dumps([r.a or "", r.b or ""], ensure_ascii=False, separators=(",", ":"))
        assert r.h == hashlib.sha256(want.encode()).hexdigest()


def test_a_streamed_book_costs_a_batch_one_write_of_state(spark, tmp_path, rocks):
    """Books of many levels over eight batches, some of which change little, empty a side, or have null sides, keys, prices and sizes."""
    rng = random.Random(6)
    level = lambda wide: [(rng.choice([None, *(float(p) for p in range(-wide, wide))]), rng.choice([0.0, 0.0, 1.5, 2.0, -1.0, None])) for _ in range(rng.randrange(wide))]
    side = lambda wide: None if rng.random() < 0.1 else level(wide)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice(["delta"] * 20 + ["snapshot", None]), side(wide), side(wide)) for i, wide in enumerate([60] * 60 + [4] * 300)]
    rows += [(run, 400, "snapshot", [], None) for run in ("a", "b", None)] + [("a", 401, "delta", [(1.0, 1.0)], [(0.5, 1.0)])]
    batches = [rows[:60], rows[60:110], rows[110:160], rows[160:200], rows[200:300], rows[300:360], rows[360:363], rows[363:]]
    for batch in batches:
        rng.shuffle(batch)
    stream = stream_of(spark, tmp_path, batches, f"run string, ord bigint, event_type string, bids {schemas.LEVELS}, asks {schemas.LEVELS}")
    query = jobs.stateful_book(stream, "run", "ord").writeStream.format("memory").queryName("packed_book").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    written = [p["stateOperators"][0]["numRowsUpdated"] for p in map(lambda p: json.loads(p.json), query.recentProgress) if p["numInputRows"]]
    assert len(written) == len(batches) and max(written) <= 3  # a row a book
    books, want = {}, set()
    for run, at, event, *sides in sorted(rows, key=lambda r: r[1]):
        own = books.setdefault(run, ({}, {}))
        for book_, levels in zip(own, sides, strict=True):
            if event == "snapshot":
                book_.clear()
            for price, size in levels or ():
                if price is not None and (size == 0 or (event == "snapshot" and not (size or 0) > 0)):
                    book_.pop(price, None)
                elif price is not None:
                    book_[price] = size
        want.add((str(run), at, max(own[0], default=None), min(own[1], default=None)))
    assert {tuple(r) for r in spark.table("packed_book").collect()} == want and len(want) == len(rows)

"""Scans, sinks and streaming operators on files."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources import scans, sinks
from tidemark.streaming import jobs

T0 = dt.datetime(2026, 4, 6)


def put(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(x + "\n" for x in lines))


def test_order_of_split_files(spark, tmp_path):
    put(tmp_path / "lane/20260406_000000/raw/messages.jsonl", *(json.dumps({"source": "s", "payload": str(i)}) for i in range(4000)), "", "  ")
    put(tmp_path / "lane/20260406_000000/raw/messages.1.jsonl", json.dumps({"source": "s", "payload": "first"}))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        rows = scans.run_rows(spark, str(tmp_path), "source string, payload string", recursive=True).orderBy("part", "ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows[0].payload == "first" and [r.payload for r in rows[1:]] == [str(i) for i in range(4000)]
    assert {(r.lane, r.run_id) for r in rows} == {("lane", "20260406_000000")}


def test_torn_lines(spark, tmp_path):
    put(tmp_path / "i.jsonl", '{"run_path":"a","promoted_rows":3}', '{"run_path":"b"', "[1]", '{"run_path":"c"}')
    got = {r.ord: (r.run_path, r.corrupt is not None) for r in scans.tolerant_rows(spark, str(tmp_path), schemas.VERDICT_INDEX).collect()}
    assert got == {1: ("a", False), 2: (None, True), 3: (None, True), 4: ("c", False)}
    put(tmp_path / "docs/a.json", '{"run_path":', '"x"}')
    put(tmp_path / "docs/b.json", '{"run_path": "to')
    docs = {r.file[-6:]: r.doc and r.doc.run_path for r in scans.documents(spark, str(tmp_path / "docs"), "run_path string").collect()}
    assert docs == {"a.json": "x", "b.json": None}


def test_latest_row_and_listing(spark, tmp_path):
    rows = spark.createDataFrame([("r", 1, "a"), ("r", 2, "b"), ("r", 3, None)], "run string, ord int, v string")
    assert scans.latest_row(rows, ["run"], "v", ["ord"]).first().v == "b"
    df = spark.createDataFrame([("x", T0, "BTC/USDT", ["a", None], {})], "source string, received_at timestamp, product string, tags array<string>, bag map<string,string>")
    sinks.append_dataset(df, str(tmp_path / "d"))
    sinks.append_dataset(df, str(tmp_path / "d"))
    sinks.append_dataset(df.drop("bag"), str(tmp_path / "old"), "v1")
    out = sinks.read_dataset(spark, str(tmp_path / "d"), "instrument = 'BTC-USDT' and event_date = '2026-04-06'", None)
    assert out.count() == 2 and out.first().tags == ["a"] and out.first().bag is None
    both = sinks.read_dataset(spark, str(tmp_path / "d"), None, str(tmp_path / "old"))
    assert sorted(r.schema_version for r in both.collect()) == ["v1", "v2", "v2"]
    files = scans.partition_files(scans.file_listing(spark, str(tmp_path / "d"))).first()
    assert str(files.event_date) == "2026-04-06" and files.files == 2 and files.bytes > 0
    sinks.write_manifest(df, str(tmp_path / "m"), "1")
    sinks.write_manifest(df, str(tmp_path / "m"), "2")
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.write_manifest(df, str(tmp_path / "m"), "2")


def test_feeds(spark):
    rss = '<?xml version="1.0"?><rss><channel><item><guid>g</guid><title><![CDATA[A & B]]></title><link>l</link><pubDate>d</pubDate></item><item><title>t</title><link>m</link></item></channel></rss>'
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>e</id><link href="h"/><summary>s</summary><published>p</published></entry></feed>'
    got = scans.feed_items(spark.createDataFrame([("r", rss), ("a", atom), ("n", "no xml")], "feed string, body string")).collect()
    assert {(r.feed, r.source_id, r.title, r.link, r.source_ts_raw) for r in got} == {("r", "g", "A & B", "l", "d"), ("r", "m", "t", "m", None), ("a", "e", None, "h", "p")}
    prefixed = '<a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:entry><a:id>e</a:id><a:title type="html">&lt;b&gt; &#233; &amp; &quot;</a:title><a:link>x</a:link></a:entry></a:feed>'
    rdf = '<rdf:RDF xmlns:rdf="r"><item><guid isPermaLink="false">g</guid><title>q</title></item></rdf:RDF>'
    got = scans.feed_items(spark.createDataFrame([("p", prefixed), ("d", rdf), ("torn", "<rss><channel><item><title>x</title>"), ("null", None)], "feed string, body string")).collect()
    assert {(r.feed, r.dialect, r.source_id, r.title) for r in got} == {("p", "atom", "e", '<b> é & "'), ("d", "rss", "g", "q")}


def stream_of(spark, folder, batches, schema):
    """One file a micro-batch, in order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(folder / f"in/b{i}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder / "in/*"))


def run_to_table(df, spark, folder, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(folder / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(key)


def test_stateful_cursor(spark, tmp_path, rocks):
    rng = random.Random(3)
    rows = [("s", i, rng.randrange(12), rng.random() < 0.25) for i in range(40)]
    schema = "stream string, ord bigint, sequence bigint, subscribe_replay boolean"
    s = stream_of(spark, tmp_path, [rows[:15], rows[15:30], rows[30:]], schema)
    out = run_to_table(jobs.stateful_cursor(s, ["stream"], ["ord"], ["ord"]), spark, tmp_path, "cursor_out")
    from tidemark.operators.gates import sequence_cursor

    want = {r.ord: r.sequence_reason for r in sequence_cursor(spark.createDataFrame(rows, schema), ["stream"], ["ord"]).collect()}
    assert {r.ord: r.sequence_reason for r in out.collect()} == want


def test_stateful_new_or_edit(spark, tmp_path, rocks):
    rows = [[("k", 0, "x"), ("k", 1, "x")], [("k", 2, "y"), ("m", 3, "x")], [("k", 4, "y"), ("k", 5, "x")]]
    s = stream_of(spark, tmp_path, rows, "item string, poll bigint, content_hash string")
    out = run_to_table(jobs.stateful_new_or_edit(s, ["item"], ["poll"], ["item", "poll"], None), spark, tmp_path, "edit_out")
    assert {(r.poll, r.row_type) for r in out.collect()} == {(0, "new"), (2, "edit"), (3, "new"), (5, "edit")}


def test_frames_and_batch_markers(spark, tmp_path):
    put(tmp_path / "in/a.jsonl", *(json.dumps({"source": "s", "received_at": "2026-04-06T00:00:00Z", "payload": f'{{"x":{i}}}'}) for i in range(5)), "not json")
    s = jobs.with_run(jobs.frame_stream(spark, str(tmp_path / "in")))
    assert run_to_table(s.select("run_id", "payload"), spark, tmp_path, "frames_out").where("run_id = '20260406_000000'").count() == 5
    seen = []
    work = jobs.once_per_batch(lambda df, i: seen.append(i), str(tmp_path / "done"))
    for i in (0, 0, 1):
        work(spark.range(1), i)
    assert seen == [0, 1]
    gated = spark.range(4).withColumns({"accepted": F.col("id") > 0, "reasons": F.array(F.lit("r"))})
    sinks.split(gated, str(tmp_path / "clean"), str(tmp_path / "held"))
    assert spark.read.parquet(str(tmp_path / "clean")).count() == 3 and spark.read.parquet(str(tmp_path / "held")).columns == ["id", "reasons"]


def test_a_batch_that_comes_again_replaces_itself(spark, tmp_path):
    """A crash between the two writes, and one between the writes and the marker: every row stands once."""
    gated = spark.range(6).withColumns({"accepted": F.col("id") > 1, "reasons": F.array(F.lit("r"))})
    paths = [str(tmp_path / x) for x in ("clean", "held", "done")]
    work = jobs.once_per_batch(lambda batch, n: sinks.split(batch, *paths[:2], n), paths[2])

    class Crash(Exception):
        pass

    def failing(clean, held, crash_at):
        def write(batch, n):
            if crash_at == "between":
                batch.where("accepted").drop("accepted", "reasons").write.mode("overwrite").parquet(f"{clean}/batch={n}")
            else:
                sinks.split(batch, clean, held, n)
            raise Crash

        return write

    for n, crash_at in enumerate(("between", "before the marker")):
        with pytest.raises(Crash):
            jobs.once_per_batch(failing(*paths[:2], crash_at), paths[2])(gated, n)
        work(gated, n)
        work(gated, n)
    for path, ids in zip(paths, ([2, 3, 4, 5], [0, 1]), strict=False):
        assert sorted(r.id for r in spark.read.parquet(path).collect()) == sorted(2 * ids)


def test_rows_without_a_time_and_nested_nulls(spark):
    df = spark.createDataFrame([("s", "P", None, [[("a", [None, "b"])], None], {"k": [None, "v"]}), ("s", "P", T0, None, {})], "source string, product string, received_at timestamp, deep array<array<struct<n:string,l:array<string>>>>, bag map<string,array<string>>")
    got = {str(r.event_date): r for r in sinks.compact(sinks.with_partitions(df, written="2026-05-01")).collect()}
    assert set(got) == {"2026-05-01", "2026-04-06"}
    assert [[tuple(x) for x in y] for y in got["2026-05-01"].deep] == [[("a", ["b"])]] and got["2026-05-01"].bag == {"k": ["v"]} and got["2026-04-06"].bag is None
    assert sinks.with_partitions(df).where("event_date is null").count() == 1


def test_silence_timer(spark, tmp_path, rocks):
    """Silences are told by the next frame or by the timer, once each; the timer ends the last one too."""
    at = lambda s: T0 + dt.timedelta(seconds=s)
    batches = [[("a", at(0)), ("a", at(5)), ("b", at(1))], [("a", at(100)), ("b", at(8))], [("c", at(1000))]]
    s = stream_of(spark, tmp_path, batches, "stream string, received_at timestamp")
    out = run_to_table(jobs.silence_timer(s.withWatermark("received_at", "1 second"), "stream", seconds=10), spark, tmp_path, "silence_out").collect()
    assert sorted((r.key, int((r.silent_since - T0).total_seconds())) for r in out) == [("a", 5), ("a", 100), ("b", 8)]


def test_stateful_book_equals_the_batch_one(spark, tmp_path, rocks):
    from tidemark.operators import book

    rng = random.Random(4)
    level = lambda: [(float(rng.randrange(90, 110)), float(rng.randrange(3))) for _ in range(rng.randrange(3))]
    rows = [(rng.choice("ab"), i, "snapshot" if rng.random() < 0.1 else "delta", level(), level()) for i in range(120)]
    schema = f"run string, ord bigint, event_type string, bids {schemas.LEVELS}, asks {schemas.LEVELS}"
    s = stream_of(spark, tmp_path, [rows[:40], rows[40:80], rows[80:]], schema)
    got = {(r.key, r.ord): (r.best_bid, r.best_ask) for r in run_to_table(jobs.stateful_book(s, "run", "ord"), spark, tmp_path, "book_out").collect()}
    batch = book.sub_books(spark.createDataFrame(rows, schema), ["run"], ["ord"])
    for states in (book.fold(batch, ["run"], "ord"), book.best_prices(batch, ["run"], ["ord"])):
        assert got == {(r.run, r.ord): (r.best_bid, r.best_ask) for r in states.collect()}


def test_metrics_rows_of_batches(spark, tmp_path):
    gated = spark.range(10).withColumns({"day": F.col("id") % 2, "accepted": F.col("id") > 3})
    work = jobs.with_metrics(lambda *_: None, str(tmp_path), ["day"])
    for n in (0, 1, 1):
        work(gated, n)
    assert {(r.batch, r.day, r.raw_events, r.quarantined_events) for r in spark.read.parquet(str(tmp_path)).collect()} == {(b, d, 5, 2) for b in (0, 1) for d in (0, 1)}

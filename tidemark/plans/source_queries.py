"""Queries of scans, sinks, scalars, instruments and the remaining verdicts: given tables written as files and read back, or read as they are."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import book, curation, health, instruments, quotes, verdicts
from ..sources import scans, sinks
from ..sources.tables import written
from .inputs import DEPTH, RUNS, TRADES, depth, order_runs, shared_folder, table, trades, windows

_C = F.col
_RUN_ID = "date_format(to_date(ts), 'yyyyMMdd_000000')"


def _lines(df: DataFrame, path: str, *folders: str) -> None:
    """One text file a folder, lines in the order of `ord`."""
    df.repartition(*folders).sortWithinPartitions(*folders, "ord").select(*folders, "value").write.partitionBy(*folders).text(path)


def run_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines of runs (lane and day), read back in order; blank lines stand between."""
    path = f"{shared_folder(spark)}/runs"
    e = table(spark, sf_dir, "events").withColumns({"lane": F.concat(F.lit("l"), (_C("user_id") % 4).cast("string")), "run_id": F.expr(_RUN_ID), "ord": _C("event_id")})
    body = F.to_json(F.struct("event_id", "event_type"))
    _lines(e.withColumn("value", F.when(_C("event_id") % 7 == 0, F.concat(F.lit("\n"), body)).otherwise(body)), path, "lane", "run_id")
    return scans.run_rows(spark, path, "event_id bigint, event_type string", recursive=True, pattern="*.txt").select("lane", "run_id", "ord", "event_id", "event_type")


def rotated_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lane's lines in two rotated parts and the active one, read back in one order."""
    path = shared_folder(spark)
    e = table(spark, sf_dir, "events").withColumns({"lane": F.concat(F.lit("l"), (_C("user_id") % 4).cast("string")), "run_id": F.lit("20240101_000000"), "ord": _C("event_id"), "value": F.to_json(F.struct("event_id"))})
    for name, when in (("messages.1.jsonl", "ts < '2024-01-11'"), ("messages.2.jsonl", "ts >= '2024-01-11' and ts < '2024-01-21'"), ("messages.jsonl", "ts >= '2024-01-21'")):
        _lines(e.where(when), f"{path}/{name}", "lane", "run_id")
    rows = scans.run_rows(spark, path, "event_id bigint", recursive=True, pattern="*.txt")
    return rows.select("lane", "event_id", F.row_number().over(Window.partitionBy("lane", "run_id").orderBy("part", "ord")).cast("bigint").alias("place"))


def index_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lines of an index, some torn, some no objects."""
    path = f"{shared_folder(spark)}/index"
    k = _C("o_orderkey")
    body = F.to_json(F.struct(k.cast("string").alias("run_path"), _C("o_custkey").alias("promoted_rows")))
    line = F.when(k % 13 == 0, F.expr("left(value, length(value) - 3)")).when(k % 17 == 0, F.concat(F.lit("["), k.cast("string"), F.lit("]"))).otherwise(_C("value"))
    table(spark, sf_dir, "orders").withColumn("value", body).select(line.alias("value")).write.text(path)
    rows = scans.tolerant_rows(spark, path, "run_path string, promoted_rows bigint", pattern="*.txt")
    return rows.groupBy("run_path", "promoted_rows", _C("corrupt").alias("line")).agg(F.count("*").alias("n"))


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days as whole JSON documents, a file each; those of odd days are torn."""
    path = f"{shared_folder(spark)}/docs"
    d = table(spark, sf_dir, "events").groupBy(F.expr(_RUN_ID).alias("day")).agg(F.count("*").alias("events"), F.max("event_id").alias("last"))
    body = F.to_json(F.struct("day", "events", "last"))
    d.select("day", F.when(_C("last") % 2 == 1, F.concat(F.lit("{"), body)).otherwise(body).alias("value")).repartition("day").write.partitionBy("day").text(path)
    docs = scans.documents(spark, f"{path}/*", "day string, events bigint, last bigint")
    return docs.select(S.path_value(_C("file"), "day").alias("file_day"), _C("doc.events").alias("events"), _C("doc.last").alias("last"), _C("doc").isNull().alias("missing"))


def latest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last valid metrics line of each user."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.when(_C("event_id") % 5 != 0, F.round("value", 4)).alias("raw"))
    return scans.latest_row(e, ["user_id"], "raw", ["event_id"])


def dataset_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended as a v2 and a v1 dataset, read back together under a filter on partitions."""
    path = shared_folder(spark)
    k = _C("event_id")
    tags = F.array(F.lit("a"), F.when(k % 2 == 0, "b"))
    bag = F.when(k % 3 == 0, F.create_map(F.lit("n"), F.array(F.lit("x"), F.lit(None).cast("string")))).otherwise(F.expr("cast(map() as map<string,array<string>>)"))
    e = table(spark, sf_dir, "events").select(k, F.concat(F.lit("src/"), (_C("user_id") % 2).cast("string")).alias("source"), F.get(F.array(*map(F.lit, ("BTC/USD", "a b"))), (_C("user_id") % 2).cast("int")).alias("product"), F.when(k % 50 != 0, _C("ts").cast("timestamp")).alias("received_at"), tags.alias("tags"), bag.alias("bag"))
    sinks.append_dataset(e.where("event_id % 4 <> 0"), f"{path}/v2", written="2025-01-01")
    sinks.append_dataset(e.where("event_id % 4 = 0"), f"{path}/v1", "v1", written="2025-01-01")
    out = sinks.read_dataset(spark, f"{path}/v2", "event_date >= '2024-01-10'", f"{path}/v1")
    return out.groupBy("schema_version", "source", "instrument", F.to_date("event_date").alias("event_date")).agg(F.count("*").alias("rows"), F.sum(F.size("tags")).alias("tags"), F.sum(F.coalesce(F.size(_C("bag")["n"]), F.lit(0))).alias("items"), F.count_if(_C("bag").isNull()).alias("empty_bags"))


def partition_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet files by day of a dataset, and whether each is fresh."""
    path = f"{shared_folder(spark)}/d"
    e = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("s"), (_C("user_id") % 3).cast("string")).alias("source"), F.lit("P").alias("product"), _C("ts").cast("timestamp").alias("received_at"))
    sinks.append_dataset(e, path)
    listing = scans.file_listing(spark, path)
    stats = scans.partition_files(listing).select(F.to_date("event_date").alias("event_date"), "files", (_C("bytes") > 0).alias("has_bytes"))
    fresh = health.partition_freshness(listing.withColumn("event_date", F.to_date(S.path_value(_C("file"), "event_date"))), ["event_date"])
    return stats.join(fresh.select("event_date", (F.unix_seconds("latest") > 1_700_000_000).alias("fresh")), "event_date")


def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two manifests: the latest one is the second, both stay as snapshots."""
    path = shared_folder(spark)
    days = table(spark, sf_dir, "events").groupBy(F.to_date("ts").cast("string").alias("day")).agg(F.count("*").alias("events"))
    sinks.write_manifest(days.where("day < '2024-01-16'"), path, "1")
    sinks.write_manifest(days, path, "2")
    read = lambda p: spark.read.schema("day string, events bigint, snapshot_ts int").option("basePath", f"{path}/{p}").json(f"{path}/{p}")
    return read("latest").select("day", "events", F.lit(0).alias("snapshot")).unionByName(read("snapshots").select("day", "events", _C("snapshot_ts").alias("snapshot")))


def api_error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.when(_C("event_type") != "view", _C("event_type") != "error").alias("success"), F.when(_C("event_id") % 3 == 0, 429).when(_C("event_id") % 3 == 1, 500).alias("http_status"))
    return quotes.api_errors(e).select("event_id", "event_type", "rate_limited")


def item_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as feed items, posts and comments: each kind hashes its own fields of whole texts."""
    d = table(spark, sf_dir, "documents")
    k = _C("doc_id")
    words = F.regexp_replace("text", r'[\x00-\x1F"\\/\x7F]', " ")  # signs that JSON writers escape in different ways
    items = d.select("doc_id", F.get(F.array(*map(F.lit, ("rss", "posts", "comments"))), (k % 3).cast("int")).alias("kind"), F.when(k % 11 != 0, k.cast("string")).alias("source_id"), F.when(k % 2 == 0, _C("lang")).alias("title"), _C("source").alias("link"), words.alias("summary"), words.alias("selftext"), words.alias("body"))
    return quotes.item_payloads(items).select("doc_id", "kind", "content_hash")


def scalar_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claimed times in four spellings, run names and partition paths of orders."""
    k, at = _C("o_orderkey"), _C("o_orderdate").cast("timestamp")
    mail, iso = F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(k % 5 == 0, F.concat(mail, F.lit(" GMT"))).when(k % 5 == 1, F.concat(mail, F.lit(" +0200"))).when(k % 5 == 2, F.concat(iso, F.lit("Z"))).when(k % 5 == 3, iso).otherwise("soon")
    run = F.concat(F.date_format(at, "yyyyMMdd"), F.when(k % 3 == 0, "x").otherwise("_120000"))
    path = F.concat(F.lit("/d/source=s"), (k % 4).cast("string"), F.when(k % 2 == 0, F.concat(F.lit("/event_date="), F.date_format(at, "yyyy-MM-dd"))).otherwise(""), F.lit("/f.parquet"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"), F.when(k % 7 == 0, "no run").otherwise(run).alias("run"), path.alias("path"), F.unix_millis(at).cast("string").alias("ms"))
    return o.select("o_orderkey", F.unix_seconds(S.source_timestamp(_C("text"))).alias("claimed"), S.run_day(_C("run")).alias("run_day"), F.unix_seconds(S.run_started(_C("run"))).alias("started"), S.path_value(_C("path"), "source").alias("source"), S.path_value(_C("path"), "event_date").alias("event_date"), F.unix_seconds(S.Fields().epoch_ms(_C("ms"))).alias("epoch"))


def scalar_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truthy words, finite numbers and legacy ids of parts."""
    k = _C("p_partkey")
    pick = lambda *v: F.get(F.array(*map(F.lit, v)), (k % len(v)).cast("int"))
    p = table(spark, sf_dir, "part").select("p_partkey", pick("true", " YES ", "1", "0", "False", "no", "maybe").alias("word"), pick("1.5", "nan", "inf", "-2", "x").alias("number"), pick("asset:btc", "asset:usdt", "crypto:ETH", "asset:abc").alias("old"))
    return p.select("p_partkey", S.truthy(_C("word")).alias("truth"), S.finite(_C("number").try_cast("double")).alias("number"), instruments.legacy_asset_id(_C("old")).alias("asset_id"), S.partition_value(_C("word")).alias("folder"))


_SYMBOLS = ("BTCUSDT", "btc-perpetual", "ETH_PERP", "SOL-USDT", "ABC-PERPETUAL", "XRP/USDTPERP", "DOGEUSD")
_VENUES = ("Binance_Futures", "deribit", "okx")


def perp_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols and venues by part: explicit entries, the perpetual rule of one venue, stripped symbols; and the untyped search."""
    k = _C("p_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", F.get(F.array(*map(F.lit, _SYMBOLS)), (k % 7).cast("int")).alias("symbol"), F.get(F.array(*map(F.lit, _VENUES)), (k % 3).cast("int")).alias("venue"))
    perp = instruments.resolve(p, "perp").select("symbol", "venue", _C("instrument.instrument_id").alias("perp_id"), _C("instrument.canonical_symbol").alias("perp_symbol"))
    free = instruments.resolve(p).select("symbol", "venue", _C("instrument.instrument_id").alias("any_id"))
    return p.join(perp, ["symbol", "venue"]).join(free, ["symbol", "venue"]).select("p_partkey", "perp_id", "perp_symbol", "any_id")


def dimension_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets and aliases of the dimension that parts name."""
    k = _C("p_partkey")
    named = table(spark, sf_dir, "part").select(F.get(F.array(*map(F.lit, ("BTC", "XBT", "ETHER", "SOL", "NONE"))), (k % 5).cast("int")).alias("alias")).distinct()
    aliases = instruments.asset_aliases(spark).join(named, "alias", "left_semi")
    out = instruments.dimension_summary(aliases, instruments.instrument_aliases(spark, venue="deribit"))
    return out.withColumn("venues", F.array_join("venues", ","))


def structural_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams without ids: only snapshots and times count; every 97th event claims an hour before."""
    e = trades(spark, sf_dir)
    early = F.timestamp_micros(F.unix_micros("exchange_time") - F.when(_C("ord") % 97 == 0, 3_600_000_000).otherwise(0))
    u = e.select("user_id", "day", "ord", F.when(_C("event_type") == "signup", "snapshot").otherwise("delta").alias("event_type"), early.alias("event_time"))
    out = verdicts.depth_stream(u, ["user_id", "day"], ["ord"])
    return out.select("user_id", "day", "event_count", "snapshot_count", "non_monotonic_time_count", "mode", "gap_detection", F.array_join("findings", ",").alias("findings"), "replayable")


def checksum_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded books whose frames carry the right checksum, or a wrong one (every ninth), or none (every 14th)."""
    u = book.sub_books(depth(spark, sf_dir), ["run"], ["ord"])
    states = written(book.checksums(u, ["run"], "ord", 1, 8, depth=10))  # read by the sums and by the stream's verdict
    given = states.withColumn("expected", F.when(_C("ord") % 14 != 0, _C("crc") + F.when(_C("ord") % 9 == 0, 1).otherwise(0)))
    sums = book.checksum_counts(given, ["run"], "expected", 1, 8)
    rows = states.select("run", "ord", "event_type", F.lit(None).cast("timestamp").alias("event_time"))
    out = verdicts.depth_stream(rows, ["run"], ["ord"], checksums=sums)
    return out.select("run", "mode", "gap_detection", "checksum_checked_count", "checksum_mismatch_count", "checksum_missing_count", F.array_join("findings", ",").alias("findings"), "replayable")


def stream_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each customer's run is scored, by the venue and product of its first order."""
    k = _C("o_orderkey")
    o = table(spark, sf_dir, "orders").select(_C("o_custkey").alias("run"), k.alias("ord"), F.get(F.array(*map(F.lit, ("bybit", "okx_perp", "kraken", "binance"))), (k % 4).cast("int")).alias("source"), F.when(k % 3 == 0, "BTC/USD").otherwise("XYZ/USD").alias("product"))
    return verdicts.stream_mode(o, ["run"], ["ord"])


def empty_run_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of two runs a customer: one with all its events and windows, and one without any."""
    e = trades(spark, sf_dir).withColumn("user_id", _C("user_id") * 2)
    runs = table(spark, sf_dir, "customer").select(F.explode(F.array(_C("c_custkey") * 2, _C("c_custkey") * 2 + 1)).alias("user_id"))
    u = e.select("user_id", "ord", F.when(_C("event_type") == "signup", "snapshot").otherwise("delta").alias("event_type"), _C("exchange_time").alias("event_time"))
    w = windows(spark, sf_dir).withColumn("run", _C("run") * 2)
    of_books = runs.withColumnRenamed("user_id", "run")
    anchors = of_books.select("run", F.lit(0).cast("bigint").alias("snapshot_last_update_id"))
    keys, order = ["user_id"], ["ord"]
    made = {
        "trades": verdicts.trades(e, keys, order, runs=runs),
        "trades_stream": verdicts.trades_stream(e, keys, order, runs=runs),
        "funding": verdicts.funding(e.where("channel = 'funding'"), keys, order, runs=runs),
        "depth_stream": verdicts.depth_stream(u, keys, order, runs=runs),
        "depth": verdicts.depth(w, ["run"], order, anchors, runs=of_books).withColumnRenamed("run", "user_id"),
    }
    rows = [v.select(F.lit(k).alias("kind"), "user_id", "event_count", F.array_contains("findings", "no_events").alias("no_events"), "replayable") for k, v in made.items()]
    return reduce(DataFrame.unionByName, rows)


def ordered_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lanes of suppliers in their order, numbered; lanes without an instrument come first."""
    k = _C("s_suppkey")
    lane = F.concat(F.lit("v"), (k % 5).cast("string"), F.when(k % 2 == 0, "_trades").otherwise("_depth"), F.when(k % 3 == 0, F.concat(F.lit("_btc"), (k % 4).cast("string"))).otherwise(""))
    lanes = table(spark, sf_dir, "supplier").select(lane.alias("lane")).distinct().withColumn("p", S.lane_parts(_C("lane"))).select("lane", "p.*")
    return curation.ordered_lanes(lanes).select("lane", "place")


def shortest_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent label among the series of each size of part."""
    k = _C("p_partkey")
    label = F.get(F.array(*map(F.lit, ("daily", "weekly", "hourly", "monthly", "annual"))), (k % 11 % 5).cast("int"))
    p = table(spark, sf_dir, "part").select((k % 37).alias("group"), label.alias("frequency")).where("frequency <> 'hourly' or group % 3 = 0")
    return quotes.shortest_frequency(p.withColumn("frequency_seconds", S.frequency_seconds(_C("frequency"))), ["group"])


def run_day_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs per lane and the day that their name states."""
    r = order_runs(spark, sf_dir).withColumn("name", F.date_format("started_at", "yyyyMMdd_HHmmss"))
    return r.groupBy("lane", S.run_day(_C("name")).alias("day")).agg(F.count("*").alias("runs"))


QUERIES = {f.__name__: f for f in (run_scan, rotated_parts, index_scan, json_documents, latest_metrics, dataset_roundtrip, partition_stats, manifest_files, api_error_rows, item_hashes, scalar_times, scalar_values, perp_resolution, dimension_counts, structural_verdict, checksum_verdict, stream_modes, empty_run_verdicts, ordered_lanes, shortest_frequency, run_day_units)}

_EVENT_DAY = "strftime(cast(ts as date), '%Y%m%d') || '_000000'"

ORACLES = {
    "run_scan": f"select 'l' || (user_id % 4) as lane, {_EVENT_DAY} as run_id, row_number() over (partition by user_id % 4, cast(ts as date) order by event_id) as ord, event_id, event_type from events",
    "rotated_parts": "select 'l' || (user_id % 4) as lane, event_id, row_number() over (partition by user_id % 4 order by event_id) as place from events",
    "index_scan": """with b as (select o_orderkey as k, o_custkey as c, '{"run_path":"' || o_orderkey || '","promoted_rows":' || o_custkey || '}' as body from orders)
select case when k % 13 <> 0 and k % 17 <> 0 then cast(k as varchar) end as run_path, case when k % 13 <> 0 and k % 17 <> 0 then c end as promoted_rows, case when k % 13 = 0 then left(body, length(body) - 3) when k % 17 = 0 then '[' || k || ']' end as line, count(*) as n from b group by all""",
    "json_documents": f"with d as (select {_EVENT_DAY} as file_day, count(*) as events, max(event_id) as last from events group by 1) select file_day, case when last % 2 = 0 then events end as events, case when last % 2 = 0 then last end as last, last % 2 = 1 as missing from d",
    "latest_metrics": "with n as (select user_id, event_id, event_type, round(value, 4) as raw, row_number() over (partition by user_id order by event_id desc) as n from events where event_id % 5 <> 0) select user_id, event_id, event_type, raw from n where n = 1",
    "dataset_roundtrip": """with x as (select event_id as k, case when event_id % 4 <> 0 then 'v2' else 'v1' end as schema_version, 'src-' || (user_id % 2) as source, case when event_id % 4 <> 0 then case when user_id % 2 = 0 then 'BTC-USD' else 'a_b' end end as instrument, case when event_id % 50 <> 0 then cast(ts as date) else date '2025-01-01' end as event_date from events)
select schema_version, source, instrument, event_date, count(*) as rows, cast(sum(case when k % 2 = 0 then 2 else 1 end) as bigint) as tags, count(*) filter (k % 3 = 0) as items, count(*) filter (k % 3 <> 0) as empty_bags from x where event_date >= date '2024-01-10' group by all""",
    "partition_stats": "select cast(ts as date) as event_date, count(distinct user_id % 3) as files, true as has_bytes, true as fresh from events group by 1",
    "manifest_files": "with d as (select cast(cast(ts as date) as varchar) as day, count(*) as events from events group by 1) select day, events, 0 as snapshot from d union all select day, events, 1 from d where day < '2024-01-16' union all select day, events, 2 from d",
    "api_error_rows": "select event_id, 'api_error' as event_type, event_id % 3 = 0 as rate_limited from events where event_type in ('view', 'error')",
    "item_hashes": r"""with d as (select doc_id, (['rss','posts','comments'])[doc_id % 3 + 1] as kind, case when doc_id % 2 = 0 then coalesce(lang, '') else '' end as title, coalesce(source, '') as link, coalesce(regexp_replace(text, '[\x00-\x1F"\\/\x7F]', ' ', 'g'), '') as t from documents)
select doc_id, kind, case when doc_id % 11 <> 0 then sha256(case kind when 'rss' then '["' || title || '","' || link || '","' || t || '"]' when 'posts' then '["' || title || '","' || t || '"]' else '["' || t || '"]' end) end as content_hash from d""",
    "scalar_times": """with x as (select o_orderkey as k, o_orderdate as t, cast(epoch(o_orderdate) as bigint) as s from orders)
select k as o_orderkey, case k % 5 when 1 then s - 7200 when 4 then null else s end as claimed, case when k % 7 <> 0 then cast(t as date) end as run_day, case when k % 7 <> 0 and k % 3 <> 0 then cast(epoch(date_trunc('day', t)) as bigint) + 43200 end as started,
 's' || (k % 4) as source, case when k % 2 = 0 then strftime(t, '%Y-%m-%d') end as event_date, s as epoch from x""",
    "scalar_values": """select p_partkey, case p_partkey % 7 when 0 then true when 1 then true when 2 then true when 3 then false when 4 then false when 5 then false end as truth, case p_partkey % 5 when 0 then 1.5 when 3 then -2.0 end as number,
 (['crypto:BTC','stablecoin:USDT','crypto:ETH','asset:abc'])[p_partkey % 4 + 1] as asset_id, (['true','YES','1','0','False','no','maybe'])[p_partkey % 7 + 1] as folder from part""",
    "perp_resolution": """with p as (select p_partkey, p_partkey % 7 as s, p_partkey % 3 as v, (['BTCUSDT','BTC-PERPETUAL','ETH_PERP','SOL-USDT','ABC-PERPETUAL','XRP/USDTPERP','DOGEUSD'])[p_partkey % 7 + 1] as sym, (['binance-futures','deribit','okx'])[p_partkey % 3 + 1] as venue from part),
r as (select *, case when s = 1 then case when v = 1 then 'BTC/USD-PERP' end when s = 0 then 'BTC/USDT-PERP' when s = 3 then 'SOL/USDT-PERP' when s = 5 then 'XRP/USDT-PERP' when s = 6 then 'DOGE/USD-PERP' end as perp_symbol from p)
select p_partkey, case when perp_symbol is not null then 'perp:' || venue || ':' || sym end as perp_id, perp_symbol,
 case when s = 0 and v = 0 or s = 1 and v = 1 then 'perp:' || venue || ':' || sym when s in (0, 6) then 'spot:' || venue || ':' || sym when perp_symbol is not null then 'perp:' || venue || ':' || sym end as any_id from r""",
    "dimension_counts": "select count(distinct p_partkey % 5) - 2 as asset_count, count(distinct p_partkey % 5) - 1 as asset_alias_count, 2 as instrument_alias_count, 'deribit' as venues from part",
    "structural_verdict": f"""with {TRADES}, u as (select user_id, day, ord, again as snap, exchange_time - case when ord % 97 = 0 then interval 1 hour else interval 0 hour end as t from e),
v as (select *, t < max(t) over (partition by user_id, day order by ord rows between unbounded preceding and 1 preceding) as early from u),
a as (select user_id, day, count(*) as event_count, count(*) filter (snap) as snapshot_count, arg_min(snap, ord) as opens, count(*) filter (early) as non_monotonic_time_count from v group by all)
select user_id, day, event_count, snapshot_count, non_monotonic_time_count, 'stream_snapshot' as mode, 'none_native' as gap_detection, concat_ws(',', case when snapshot_count = 0 then 'no_snapshot_anchor' end, case when snapshot_count > 0 and not opens then 'run_does_not_start_with_snapshot' end, case when non_monotonic_time_count > 0 then 'non_monotonic_event_time' end) as findings,
 snapshot_count > 0 and opens and non_monotonic_time_count = 0 as replayable from a""",
    "checksum_verdict": f"""with {DEPTH}, a as (select run, count(*) filter (ord % 14 <> 0) as checked, count(*) filter (ord % 14 <> 0 and ord % 9 = 0) as wrong, count(*) filter (ord % 14 = 0) as lacking, count(*) filter (snap) as snaps, arg_min(snap, ord) as opens from frame group by run)
select run, 'stream_snapshot_checksum' as mode, 'checksum' as gap_detection, checked as checksum_checked_count, wrong as checksum_mismatch_count, lacking as checksum_missing_count,
 concat_ws(',', case when snaps = 0 then 'no_snapshot_anchor' end, case when snaps > 0 and not opens then 'run_does_not_start_with_snapshot' end, case when lacking > 0 then 'missing_checksum' end, case when wrong > 0 then 'checksum_mismatch' end) as findings, snaps > 0 and opens and checked > 0 and wrong + lacking = 0 as replayable from a""",
    "stream_modes": """with f as (select o_custkey as run, min(o_orderkey) as k from orders group by 1)
select run, (['bybit','okx_perp','kraken','binance'])[k % 4 + 1] as venue, case when k % 3 = 0 then 'BTC/USD' else 'XYZ/USD' end as product, case k % 4 when 0 then 'dense' when 1 then 'chain' when 2 then case when k % 3 = 0 then 'checksum' else 'structural' end else 'structural' end as stream_mode from f""",
    "empty_run_verdicts": f"""with {TRADES}, d as (select * replace (user_id * 2 as user_id) from e), c as (select unnest([2 * c_custkey, 2 * c_custkey + 1]) as user_id from customer),
v as (select *, sequence - lag(sequence) over (partition by user_id order by ord) as step from d),
t as (select user_id, count(*) as n, bool_and(price > 0 and size > 0 and abs(delay) <= 60) as fine, bool_and(step is null or step = 1) as dense from v group by 1),
f as (select user_id, count(*) as n, bool_and(price > 0 and abs(delay) <= 60) as fine from d where channel = 'funding' group by 1),
s as (select user_id, count(*) as n, count(*) filter (again) as snaps, arg_min(again, ord) as opens from d group by 1),
w as (select o_custkey * 2 as run, o_orderkey as ord, o_orderkey * 2 + case when o_orderkey % 97 = 0 then 5 else 0 end as lo, o_orderkey * 2 + case when o_orderkey % 89 = 0 then -3 else 1 end as hi from orders),
w1 as (select *, lo <= hi as valid, lo <= hi and hi > 0 as past from w), w2 as (select *, count(*) filter (past) over (partition by run order by ord rows between unbounded preceding and 1 preceding) as k from w1),
w3 as (select *, valid and k = 0 and not past as skipped, valid and (k > 0 or past) as live, past and k = 0 as anch from w2), w4 as (select *, max(case when live then hi end) over (partition by run order by ord rows between unbounded preceding and 1 preceding) as prev from w3),
b as (select run, count(*) filter (not skipped) as n, count(*) filter (not valid or live and not anch and (hi <= prev or lo > prev + 1) or anch and lo > 1) as poor from w4 group by run)
select 'trades' as kind, user_id, coalesce(n, 0) as event_count, n is null as no_events, coalesce(fine and dense, false) as replayable from c left join t using (user_id)
union all select 'trades_stream', user_id, coalesce(n, 0), n is null, coalesce(fine, false) from c left join t using (user_id)
union all select 'funding', user_id, coalesce(n, 0), n is null, coalesce(fine, false) from c left join f using (user_id)
union all select 'depth_stream', user_id, coalesce(n, 0), n is null, coalesce(snaps > 0 and opens, false) from c left join s using (user_id)
union all select 'depth', user_id, coalesce(n, 0), coalesce(n, 0) = 0, coalesce(n > 0 and poor = 0, false) from c left join b on run = user_id""",
    "ordered_lanes": """with l as (select distinct 'v' || (s_suppkey % 5) as venue, case when s_suppkey % 2 = 0 then 'trades' else 'depth' end as dataset, case when s_suppkey % 3 = 0 then 'btc' || (s_suppkey % 4) else '' end as instrument from supplier)
select venue || '_' || dataset || case when instrument <> '' then '_' || instrument else '' end as lane, row_number() over (order by venue, dataset, instrument) as place from l""",
    "shortest_frequency": """with p as (select p_partkey % 37 as "group", (['daily','weekly','hourly','monthly','annual'])[p_partkey % 11 % 5 + 1] as frequency, ([86400, 604800, 3600, 2592000, 31536000])[p_partkey % 11 % 5 + 1] as s from part)
select "group", arg_min(frequency, s) as frequency from p where frequency <> 'hourly' or "group" % 3 = 0 group by 1""",
    "run_day_units": f"with {RUNS} select lane, day, count(*) as runs from r group by all",
}

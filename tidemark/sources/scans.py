"""Sources: ordered run scans, tolerant index scans, whole documents, feeds and API pages; file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_C = F.col


def ordered_lines(spark: SparkSession, path: str, recursive: bool = False, pattern: str = "*.jsonl") -> DataFrame:
    """(file, part, ord, value): the non-blank lines of each file, in file order.

    Order is fixed in the scan, by block and by row in the block, before any filter or shuffle. `part` is the number of
    a rotated file (`messages.N.jsonl`); the active file, without one, is the newest.
    """
    lines = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", pattern).text(path)
    lines = lines.select("value", _C("_metadata.file_path").alias("file"), _C("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("mid"))
    lines = lines.where(F.trim("value") != "")
    part = F.regexp_extract("file", r"\.(\d+)\.jsonl(?:/|$)", 1)  # of the file, or of the folder that Spark wrote as one
    lines = lines.withColumn("part", F.when(part == "", F.lit(2**62)).otherwise(part.try_cast("bigint")))
    return lines.select("file", "part", F.row_number().over(Window.partitionBy("file").orderBy("block", "mid")).cast("bigint").alias("ord"), "value")


def run_keys(df: DataFrame, file: str = "file") -> DataFrame:
    """Adds lane and run_id, the run folder's name and its parent's (`lane=` and `run_id=` before them are left out)."""
    return df.withColumns({"lane": F.regexp_extract(file, r"/(?:lane=)?([^/]+)/(?:run_id=)?\d{8}_\d{6}/", 1), "run_id": F.regexp_extract(file, r"/(?:run_id=)?(\d{8}_\d{6})/", 1)})


def run_rows(spark: SparkSession, path: str, schema: StructType | str, recursive: bool = False, pattern: str = "*.jsonl") -> DataFrame:
    """Rows of runs in order: lane, run_id, part, ord and the schema's columns. A malformed line fails the job."""
    own = run_keys(ordered_lines(spark, path, recursive, pattern))
    parsed = F.from_json("value", schema, {"mode": "FAILFAST"})
    return own.select("lane", "run_id", "part", "ord", parsed.alias("r")).select("lane", "run_id", "part", "ord", "r.*")


def tolerant_rows(spark: SparkSession, path: str, schema: StructType | str, pattern: str = "*.jsonl") -> DataFrame:
    """Rows of an index with `corrupt` (the line, where it is no object of this schema) and their order in the file."""
    own = ordered_lines(spark, path, pattern=pattern)
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = StructType(schema.fields).add("_corrupt", "string")
    read = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    bad = ~F.ltrim("value").startswith("{")
    rows = own.withColumn("r", read)
    return rows.select("file", "ord", F.when(bad, _C("value")).otherwise(_C("r._corrupt")).alias("corrupt"), *(F.when(~bad & _C("r._corrupt").isNull(), _C("r")[f.name]).alias(f.name) for f in schema.fields))


def documents(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """(file, doc): whole-file JSON objects; torn files and those that are no object are missing (null)."""
    whole = spark.read.text(path, wholetext=True).select(_C("_metadata.file_path").alias("file"), "value")
    ok = F.ltrim("value").startswith("{") & F.try_parse_json("value").isNotNull()
    return whole.select("file", F.when(ok, F.from_json("value", schema)).alias("doc"))


def latest_row(rows: DataFrame, keys: list[str], valid: str, order: list[str]) -> DataFrame:
    """The last row of each key whose `valid` column is not null."""
    own = rows.where(_C(valid).isNotNull())
    packed = own.groupBy(*keys).agg(F.max_by(F.struct(*own.columns), F.struct(*order)).alias("r"))
    return packed.select("r.*")


def recent_runs(runs: DataFrame, limit: int, lane: str = "lane", run: str = "run_id") -> DataFrame:
    """Each lane's newest runs by name."""
    return runs.withColumn("__n", F.row_number().over(Window.partitionBy(lane).orderBy(F.desc(run)))).where(_C("__n") <= limit).drop("__n")


def file_listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(file, bytes, modified) of all files below a path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select(_C("path").alias("file"), _C("length").alias("bytes"), _C("modificationTime").alias("modified"))


def partition_files(listing: DataFrame) -> DataFrame:
    """Parquet files and bytes per event_date folder."""
    from ..functions.scalars import path_value

    own = listing.where(_C("file").endswith(".parquet")).withColumn("event_date", path_value(_C("file"), "event_date"))
    return own.where("event_date is not null").groupBy("event_date").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


_TAGS = ("guid", "title", "description", "pubDate", "id", "summary", "content", "published", "updated")
_ITEM = f"array<struct<link:struct<_VALUE:string,_href:string>,{','.join(f'{t}:struct<_VALUE:string>' for t in _TAGS)}>>"


def feed_items(bodies: DataFrame, body: str = "body") -> DataFrame:
    """XML feed bodies (with `feed`) to items: RSS items; Atom entries of bodies that have no RSS item. Bodies that are no XML have none.

    Elements are known by their local names, whatever their prefix; entities and CDATA are read as XML has them.
    """
    own = bodies.withColumn("x", F.from_xml(body, f"channel struct<item:{_ITEM}>, item {_ITEM}, entry {_ITEM}", {"ignoreNamespace": "true"}))
    none = F.array().cast(_ITEM)
    rss = F.concat(F.coalesce("x.channel.item", none), F.coalesce("x.item", none))
    tagged = lambda items, dialect: F.transform(items, lambda i: F.struct(F.lit(dialect).alias("dialect"), i.alias("i")))
    own = own.withColumn("x", F.explode(F.when(F.size(rss) > 0, tagged(rss, "rss")).otherwise(tagged(F.coalesce("x.entry", none), "atom"))))
    text = lambda tag: F.nullif(F.trim(_C(f"x.i.{tag}._VALUE")), F.lit(""))
    href, is_rss = F.nullif(_C("x.i.link._href"), F.lit("")), _C("x.dialect") == "rss"
    link = F.when(is_rss, text("link")).otherwise(F.coalesce(href, text("link")))
    return own.select(*(c for c in bodies.columns if c != body), _C("x.dialect").alias("dialect"), F.coalesce(F.when(is_rss, text("guid")).otherwise(text("id")), link).alias("source_id"), text("title").alias("title"), link.alias("link"), F.when(is_rss, text("description")).otherwise(F.coalesce(text("summary"), text("content"))).alias("summary"), F.when(is_rss, text("pubDate")).otherwise(F.coalesce(text("published"), text("updated"))).alias("source_ts_raw"))


def listing_children(bodies: DataFrame, body: str = "body") -> DataFrame:
    """`data.children[].data` of listing bodies, as JSON text; entries that are no objects go."""
    kids = F.from_json(F.get_json_object(body, "$.data.children"), "array<string>")
    out = bodies.select(*(c for c in bodies.columns if c != body), F.posexplode(kids).alias("pos", "child"))
    return out.withColumn("item", F.get_json_object("child", "$.data")).where(_C("item").startswith("{")).drop("child")


def api_rows(pages: DataFrame, path: str, keys: list[str], cap: int | None = None, body: str = "body", order: str = "page") -> DataFrame:
    """Objects of `payload.<path>[]` pages, as JSON text; with a cap, the first so many of each key in page order."""
    own = F.from_json(F.get_json_object(body, f"$.{path}"), "array<string>")
    out = pages.select(*keys, order, F.posexplode_outer(own).alias("pos", "item")).where(_C("item").startswith("{"))
    if cap is None:
        return out
    return out.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(order, "pos"))).where(_C("__n") <= cap).drop("__n")

"""URL filters: a sort-merge range join of URLs with allow and block rules on hosts and path prefixes.

A rule (host, path) fits a URL if the URL's host is the rule's host or below it, and its path starts with the rule's.
Of several, the one of the longest host and path together wins, then block before allow. With the labels of a host
reversed and each closed by a dot (`www.example.org` -> `org.example.www.`), the hosts that a rule covers are one
interval of keys, and intervals of different rules are nested or apart. So URLs sorted by key meet the rules sorted by
key in one sweep that holds a stack of the rules whose interval is open; paths are compared on the stack alone.

Sampled splitters cut the order (key, path, id) of the URLs into even parts, so a host with a third of all rows is cut
too; a rule goes to every part that its interval meets, and rows are sorted inside their part only. Rules may be many:
neither they nor the URLs are broadcast. The sample and the splitters are bounded.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; path: from there up to `?`, `#` or the end.

Defined results: very long URLs are compared whole; null URLs and those without `://` have an empty host and path, fit no rule, and get the default verdict;
repeated URLs are judged one by one; equal rules count once; null rules are left out; empty tables give empty results
(no rules: the default verdict); extra columns pass through.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import fields, from_row, parallelism, shape

SAMPLE = 20_000


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    """Labels from the last to the first, each closed by a dot; none for an empty host."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) rows as a table of rules."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", row_id: str = "page_id", default: str = "allow") -> DataFrame:
    """The rows with host, path, rule (host and path of the winner, or null) and verdict; columns of these names are replaced."""
    spark = urls.sparkSession
    n = parallelism(spark)
    keep = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rows = urls.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), F.coalesce(F.col(row_id).cast("string"), F.lit("")).alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("key", reversed_host(F.col("host")))
    share = min(1.0, SAMPLE / max(1, urls.count()))
    some = rows if share == 1.0 else rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
    sample = sorted((r.key, r.path, r.id) for r in some.select("key", "path", "id").limit(4 * SAMPLE).collect())
    cuts = sorted({sample[len(sample) * i // n] for i in range(1, n)}) if sample else []
    shared = spark.sparkContext.broadcast(cuts)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row's part."""
        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bisect_right(shared.value, k) for k in keys], pa.int64()), *batch.columns[1:]], names=["row", "part", "key", "path", "id", "host"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each rule once for every part that its interval meets."""
        heads = [c[0] for c in shared.value]
        for batch in batches:
            out = []
            for key, host, path, verdict in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                for part in range(bisect_left(heads, key), bisect_right(heads, key + "\U0010ffff") + 1):
                    out.append((part, key, path, host, verdict))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.string()) for c in cols[1:])], names=["part", "key", "path", "host", "verdict"])

    kind = rows.schema["row"].dataType
    placed = rows.select("row", "key", "path", "id", "host").mapInArrow(parts, shape(("row", kind), *fields("part bigint, key string, path string, id string, host string")))
    own = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull()).select("host", "path", "verdict").distinct()
    own = own.withColumn("key", reversed_host(F.col("host"))).where("key <> ''").select("key", "host", "path", "verdict")
    dealt = own.mapInArrow(spread, "part bigint, key string, path string, host string, verdict string").withColumns({"row": F.lit(None).cast(kind), "id": F.lit("")})
    order = placed.withColumns({"verdict": F.lit(None).cast("string"), "url": F.lit(1)}).unionByName(dealt.withColumn("url", F.lit(0)))
    # rules sort before the URLs of the same key, shorter ones first
    dealt_out = order.repartition(n, "part").sortWithinPartitions("part", "key", "url", "path", "id")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []
        for batch in batches:
            at, rule, verdict = [], [], []
            for i, (p, key, path, host, said, is_url) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("part", "key", "path", "host", "verdict", "url")), strict=True)):
                if p != part:
                    part, stack = p, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if not is_url:
                    if stack and stack[-1][0] == key:
                        stack[-1][1].append((len(host + path), said == "block", host, path, said))
                    else:
                        stack.append((key, [(len(host + path), said == "block", host, path, said)]))
                    continue
                best = max((r for _, rules in stack for r in rules if path.startswith(r[3])), default=None)
                at.append(i)
                rule.append(best and best[2] + best[3])
                verdict.append(best[4] if best else default)
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([taken.column("row"), taken.column("host"), taken.column("path"), pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=["row", "host", "path", "rule", "verdict"])

    out = dealt_out.mapInArrow(sweep, shape(("row", kind), *fields("host string, path string, rule string, verdict string")))
    return out.select(*from_row(kind.names), "host", "path", "rule", "verdict")

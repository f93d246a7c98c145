"""Connected components of links, by union-find inside partitions and star contraction across them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import discard, written


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over a partition's links, in pieces of bounded size: each node that has one meets its root."""

    def flush(parent: dict) -> pa.RecordBatch:
        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        pairs = [(x, r) for x in list(parent) if (r := root(x)) != x]
        kind = pa.binary()
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], kind), pa.array([r for _, r in pairs], kind)], names=["u", "v"])

    parent: dict[bytes, bytes] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for x in (a, b):
                parent.setdefault(x, x)
            while parent[a] != a:
                parent[a] = parent[parent[a]]
                a = parent[a]
            while parent[b] != b:
                parent[b] = parent[parent[b]]
                b = parent[b]
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 500_000:
            yield flush(parent)
            parent = {}
    if parent:
        yield flush(parent)


def components(links: DataFrame) -> DataFrame:
    """links (u, v: binary) -> (node, root) for every node that has a link; root is its component's least node.

    Each round points every node's larger neighbours, then every node itself, at its least neighbour; minima are
    pre-aggregated, and the joins back are plain equi-joins that Spark splits where a node has very many links.
    """
    edges = written(links.where("u <> v").mapInArrow(_forest, "u binary, v binary").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x")).select(F.col("x.v").alias("u"), F.col("x.m").alias("v")).where("u <> v").distinct()
        new = written(small)
        stars = new.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() == 0
        roots_are_leaves = stars and new.select("v").distinct().join(new.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count() == 0
        discard(edges)
        edges = new
        if roots_are_leaves:
            break
    done = edges
    return done.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(done.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

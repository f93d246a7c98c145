"""Segmented scans: what a window would tell of the rows before, for keys of any number of rows.

A window puts all rows of a key into one task. Here rows are range-partitioned by key and order, so a key with many rows
lies in several *pieces*, each at most about a partition; rows of equal key and order stay together. The scan then has three steps:
a window inside each (piece, key), the last value of each piece and key (aggregated before the shuffle), and a scan over those few, a row
a piece, whose result is joined to the rows of the pieces behind it. Rows without a key form a key of their own, as in a window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import written

_C = F.col
PIECE = "__piece"
_FIRST = Window.unboundedPreceding


def cut(rows: DataFrame, keys: list[str], order: list[str], pieces: int | None = None) -> DataFrame:
    """The rows with their piece, as a table in the shared folder: where a row lies is decided once, whatever is computed again later."""
    pieces = pieces or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(rows.repartitionByRange(pieces, *keys, *order).withColumn(PIECE, F.spark_partition_id()))


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """right's columns joined on equal piece and key, null keys too; right's are named with `__of_`."""
    match = [left[PIECE] == right[f"__of_{PIECE}"], *(left[k].eqNullSafe(right[f"__of_{k}"]) for k in keys)]
    return left.join(right, reduce(lambda a, b: a & b, match), "left").drop(*(f"__of_{k}" for k in (PIECE, *keys)))


def ends_before(pieces: DataFrame, keys: list[str], order: list[str], values: dict[str, Column]) -> DataFrame:
    """(piece, keys, values) for each piece and key with a value in an earlier piece: the last non-null one."""
    latest = lambda v: F.max_by(v, F.when(v.isNotNull(), F.struct(*order)))
    ends = pieces.groupBy(PIECE, *keys).agg(*(latest(v).alias(n) for n, v in values.items()))
    earlier = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(_FIRST, -1)
    found = ends.select(_C(PIECE).alias(f"__of_{PIECE}"), *(_C(k).alias(f"__of_{k}") for k in keys), *(F.last(n, ignorenulls=True).over(earlier).alias(f"__carry_{n}") for n in values))
    return found.where(reduce(lambda a, b: a | b, (_C(f"__carry_{n}").isNotNull() for n in values)))


def last_values(pieces: DataFrame, keys: list[str], order: list[str], values: dict[str, Column], current: bool = False) -> DataFrame:
    """Adds to each row of `cut`'s pieces the last non-null value of each expression among the rows of its key before it (with itself, if `current`)."""
    w = Window.partitionBy(PIECE, *keys).orderBy(*order).rowsBetween(_FIRST, 0 if current else -1)
    inside = pieces.withColumns({n: F.last(v, ignorenulls=True).over(w) for n, v in values.items()})
    joined = _same(inside, ends_before(pieces, keys, order, values), keys)
    return joined.withColumns({n: F.coalesce(_C(n), _C(f"__carry_{n}")) for n in values}).drop(*(f"__carry_{n}" for n in values))


def first_rows(rows: DataFrame, keys: list[str], order: list[str | Column], n: int, parts: int = 64, name: str = "place") -> DataFrame:
    """The first n rows of each key, with their place: found in parts of a key first, so a hot key is no single task's.

    A row's part is the hash of all its columns. At most parts * n rows of a key meet in the end.
    """
    part = rows.withColumn("__part", F.pmod(F.xxhash64(*rows.columns), F.lit(parts)))
    few = part.withColumn(name, F.row_number().over(Window.partitionBy(*keys, "__part").orderBy(*order))).where(_C(name) <= n).drop("__part")
    return few.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(_C(name) <= n)

"""Sinks: partitioned datasets, the clean and quarantine split, manifests; pruned reads of both dataset layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..functions.scalars import partition_value
from . import tables

_C = F.col


def with_partitions(df: DataFrame, version: str = "v2", written: str | None = None) -> DataFrame:
    """Adds schema_version, source, event_date and (v2) instrument; a nested instrument becomes instrument_ref.

    event_date is the UTC day of the first of event_time, exchange_time and received_at that is there. Rows without any
    are kept under `written`, the day of writing, which is a parameter as there is no wall clock; without it in the null partition.
    """
    times = [_C(c) for c in ("event_time", "exchange_time", "received_at") if c in df.columns]
    out = df.withColumn("event_date", F.to_date(F.coalesce(*times, F.lit(written).cast("timestamp"))))
    if version == "v2":
        canonical = [_C("instrument.canonical_symbol")] if "instrument" in df.columns else [_C("metadata.canonical_symbol")] if "metadata" in df.columns and "canonical_symbol" in df.schema["metadata"].dataType.fieldNames() else []
        value = partition_value(F.coalesce(*canonical, _C("product")))
        out = out.withColumnRenamed("instrument", "instrument_ref") if "instrument" in df.columns else out
        out = out.withColumn("instrument", value)
    return out.withColumns({"schema_version": F.lit(version), "source": partition_value(_C("source"))})


def _compact(c: Column, kind: DataType) -> Column:
    if isinstance(kind, ArrayType):
        return F.transform(F.filter(c, lambda x: x.isNotNull()), lambda x: _compact(x, kind.elementType))
    if isinstance(kind, MapType):
        inner = F.transform_values(c, lambda _, v: _compact(v, kind.valueType)) if isinstance(kind.valueType, (ArrayType, MapType, StructType)) else c
        return F.when(F.size(c) > 0, inner)
    if isinstance(kind, StructType):
        return F.when(c.isNotNull(), F.struct(*(_compact(c[f.name], f.dataType).alias(f.name) for f in kind)))
    return c


def compact(df: DataFrame) -> DataFrame:
    """Arrays without null items, empty maps as null, at every depth."""
    cols = {f.name: _compact(_C(f"`{f.name}`"), f.dataType) for f in df.schema if isinstance(f.dataType, (ArrayType, MapType, StructType))}
    return df.withColumns(cols) if cols else df


def append_dataset(df: DataFrame, path: str, version: str = "v2", written: str | None = None, rows_per_file: int = 5_000_000) -> None:
    """Append to a partitioned dataset; a partition's rows meet, by an adaptive rebalance.

    Cold partitions share a task, so each has one file; a hot one is split over tasks at Spark's advisory partition size,
    and no file has more than `rows_per_file` rows.
    """
    folders = ["schema_version", "source", *(["instrument"] if version == "v2" else []), "event_date"]
    rows = compact(with_partitions(df, version, written)).hint("rebalance", *folders)
    rows.write.mode("append").option("maxRecordsPerFile", rows_per_file).partitionBy(*folders).parquet(path)


def upsert(rows: DataFrame, path: str, keys: list[str], partition: str) -> None:
    """Rows by key into a table partitioned by one column: partitions that the rows name are written anew, no other is touched.

    A row replaces the one of its key, so a second delivery changes nothing. Two writers of one partition must not run at once.
    """
    spark = rows.sparkSession
    new = tables.written(rows)
    touched = new.select(partition).distinct()
    merged = new
    try:
        old = spark.read.schema(new.schema).option("basePath", path).parquet(path)
        kept = old.join(touched, partition, "left_semi").join(new.select(*keys), keys, "left_anti")
        merged = new.unionByName(kept)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
    merged = tables.written(merged)  # a partition can't be read and replaced in one job
    merged.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    tables.discard(new, merged)


def read_dataset(spark: SparkSession, path: str, where: str | None = None, legacy: str | None = None) -> DataFrame:
    """A dataset with a filter on its partitions; a legacy (v1) folder is read along, its missing columns null."""
    own = spark.read.option("basePath", path).parquet(path)
    if legacy:
        own = own.unionByName(spark.read.option("basePath", legacy).parquet(legacy), allowMissingColumns=True)
    return own.where(where) if where else own


def split(gated: DataFrame, clean: str, quarantine: str, batch: int | None = None) -> None:
    """Accepted rows to clean, others with their reasons to quarantine; the gate is computed once.

    With a batch number each write replaces that batch's own folder (`batch=<n>`), so a batch that is written again, after
    a crash between the two writes or later, stands once in both. Without one rows are appended.
    """
    held = gated.persist()
    mode, folder = ("append", "") if batch is None else ("overwrite", f"/batch={batch}")
    try:
        held.where("accepted").drop("accepted", "reasons").write.mode(mode).parquet(clean + folder)
        held.where("not accepted").drop("accepted").write.mode(mode).parquet(quarantine + folder)
    finally:
        held.unpersist()


def write_manifest(df: DataFrame, path: str, stamp: str) -> None:
    """The latest manifest, overwritten, and an immutable one by its stamp."""
    df.write.mode("overwrite").json(f"{path}/latest")
    df.write.mode("errorifexists").json(f"{path}/snapshots/snapshot_ts={stamp}")

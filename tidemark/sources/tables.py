"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Names of the folders that this process made.
_made: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that all executors share; on a cluster that is `spark.checkpoint.dir`, never a machine's own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    name = f"tidemark-{uuid.uuid4().hex}"
    _made.add(name)
    return f"{(base or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/{name}"


def written(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, its lineage cut, safe when executors are lost."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the tables that `written` made for these frames. Nothing that is still to be computed may read them."""
    for frame in frames:
        hadoop = frame.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
            if folder.rsplit("/", 1)[-1] in _made:
                path = frame.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(hadoop).delete(path, True)

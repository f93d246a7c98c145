"""Helpers that several training-data operators share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: `bytes.split()` splits at exactly \x20 and \x09-\x0D, so it yields the words `[^\x20\x09-\x0D]+`.
LOWER_ASCII = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

#: Names of the folders that this process made.
_made: set[str] = set()


def encode(text: str | None) -> bytes:
    """UTF-8 bytes of a text; null gives none, lone surrogates become '?'."""
    return b"" if text is None else text.encode("utf-8", "replace")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the one that the cluster shares (`spark.checkpoint.dir`); the warehouse's where that is unset, on one machine only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = base or spark.conf.get("spark.sql.warehouse.dir")
    name = f"tidemark-{uuid.uuid4().hex}"
    _made.add(name)
    return f"{base.rstrip('/')}/{name}"


def written(df: DataFrame, **options: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, its lineage cut, safe when executors are lost. options: the writer's."""
    path = shared_dir(df.sparkSession)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the tables that `written` made for these frames. Nothing that is still to be computed may read them."""
    for frame in frames:
        hadoop = frame.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
            if folder.rsplit("/", 1)[-1] in _made:
                path = frame.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(hadoop).delete(path, True)


#: Options of `written` for rows of megabytes: pages and row groups end by size after any row. By default both hold 100 rows at least, and
#: writers, readers and codecs then hold all of a task's rows, in memory of the heap and beside it.
LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1", "parquet.block.size": str(4 << 20), "parquet.enable.dictionary": "false"}


@contextmanager
def by_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """What is written meanwhile goes to Python in batches of about so many bytes (one row at least) instead of 64 MB. Its shuffle
    files go when it is written, instead of when the driver happens to collect its garbage: nothing reads them again."""
    held = {"spark.sql.execution.arrow.maxBytesPerBatch": str(size), "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    before = {key: spark.conf.get(key, None) for key in held}
    try:
        for key, value in held.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


_KINDS = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "float": T.FloatType(), "boolean": T.BooleanType(), "string": T.StringType(), "binary": T.BinaryType()}


def shape(*fields: tuple[str, T.DataType | str]) -> T.StructType:
    """The type of rows with these fields (name; a type, or the name of a plain one or of an array of it), whatever characters names hold."""
    kind = lambda k: k if isinstance(k, T.DataType) else T.ArrayType(kind(k[6:-1])) if k.startswith("array<") else _KINDS[k]
    return T.StructType([T.StructField(name, kind(k)) for name, k in fields])


def packed(*columns: np.ndarray) -> bytes:
    """Columns of equal length as bytes, plane by plane, so that leading zeros stand together and compress."""
    return b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.dtype.itemsize).T.tobytes() for c in columns)


def unpacked(data: bytes, *kinds: type | np.dtype) -> list[np.ndarray]:
    widths = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(data) // sum(widths), 0, []
    for kind, width in zip(kinds, widths, strict=True):
        planes = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += n * width
    return out


def fields(text: str) -> list[tuple[str, str]]:
    """`a bigint, b array<string>` as fields for `shape`."""
    return [tuple(x.split(" ")) for x in text.split(", ")]


def in_row(docs: DataFrame, columns: list[str] | None = None) -> Column:
    """The columns as one struct `row`, so that their names clash with none of an operator's own."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns if columns is None or c in columns)).alias("row")


def from_row(names: list[str]) -> list[Column]:
    """The columns of `in_row` again."""
    return [F.col("row").getField(c).alias(c) for c in names]


def parallelism(spark: SparkSession) -> int:
    """Partitions for a shuffle of the size that the session is set for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Memory that a worker process has freed goes back to the machine; it would otherwise hold the most that any of its tasks ever needed."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches of a task in parts of few rows; when the task ends, memory that it freed is given back."""
    try:
        for batch in batches:
            for a in range(0, batch.num_rows, rows):
                yield batch.slice(a, rows)
    finally:
        give_back()

"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardscan.session import checkpoint_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back.

    Cuts the lineage and survives lost executors (the files are shared, not
    executor-local)."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def python_tasks(spark: SparkSession) -> None:
    """Make the package importable in Python workers."""
    ship_package(spark)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it until ``df`` has no column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def split_crc(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null ids count as empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def utf8_parts(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, is_null) of an Arrow string or binary array; nulls have no bytes."""
    large = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, off, data = arr.buffers()
    n = len(arr)
    offsets = np.frombuffer(off, dtype=np.int64 if large else np.int32,
                            count=arr.offset + n + 1)[arr.offset:].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    null = np.asarray(arr.is_null().to_numpy(zero_copy_only=False), dtype=bool)
    return raw, offsets, null


def texts(arr: pa.Array):
    """Each value as ``bytes`` (null: empty), one at a time."""
    raw, off, null = utf8_parts(arr)
    view = memoryview(raw)
    for i in range(len(arr)):
        yield b"" if null[i] else view[off[i]:off[i + 1]].tobytes()


def pieces(text, gap, size: int = 1 << 20):
    """``text`` (str or bytes) in order, in pieces of about ``size`` cut where ``gap`` matches, so that the
    words of a very long text are never all held as objects."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            m = gap.search(text, end)
            end = m.start() if m else len(text)
        yield text[at:end] if at or end < len(text) else text
        at = end

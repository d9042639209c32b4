"""Intermediate tables in the shared folder, and numbers packed for them."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recallspark.session import scratch_dir


def stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read again: cuts lineage, and Spark knows the size."""
    spark = df.sparkSession
    folder = f"{scratch_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def pack(values: np.ndarray, rising: bool = False) -> bytes:
    """Numbers as compressed bytes: all lowest bytes first, then the next; differences if they rise."""
    values = np.ascontiguousarray(values)
    if rising and len(values):
        values = np.concatenate((values[:1], values[1:] - values[:-1]))
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def unpack(data: bytes, dtype: type, rising: bool = False) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(dtype).itemsize
    if not n:
        return np.zeros(0, dtype)
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=n * size, codec="zstd"), np.uint8)
    values = np.ascontiguousarray(planes.reshape(size, n).T).view(dtype).ravel()
    return np.cumsum(values, dtype=dtype) if rising else values

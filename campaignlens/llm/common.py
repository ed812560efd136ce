"""Helpers shared by the corpus operators: tables, intermediate storage, worker files."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from campaignlens.sources.store import checkpoint_root

#: Words are runs of anything but ASCII white space, for Java regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


class Workspace:
    """A folder of intermediate tables in the shared folder of ``spark.checkpoint.dir``.

    Tables are written once and read back, so nothing upstream is computed again when an executor is
    lost. ``drop`` deletes the folder once the results that read it have been written elsewhere.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{checkpoint_root(spark)}/corpus-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def table(self, rows: DataFrame, name: str = "table") -> DataFrame:
        location = self.path(name)
        rows.write.option("compression", "zstd").parquet(location)
        return self.spark.read.schema(rows.schema).parquet(location)

    def drop(self) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def row_hash_bucket(n: int, seed: int) -> Column:
    """Uniform bucket of a row of a stored table, whatever its values: repeated rows spread too."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)), F.lit(n))


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether ``crc32(doc_id as text) mod folds`` is ``fold``; a missing id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def text_bytes(column) -> Iterator[bytes]:
    """UTF-8 bytes of the values of an Arrow string column; empty for null."""
    import pyarrow as pa

    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def _filesystem(location: str):
    """Local path, or else the Arrow file system and the path in it."""
    parts = urlparse(location)
    if parts.scheme in ("", "file"):
        return None, parts.path
    from pyarrow import fs

    return fs.FileSystem.from_uri(location)


def write_array(location: str, values: np.ndarray) -> None:
    """Store one array in the shared folder; a repeated attempt replaces equal content atomically."""
    system, path = _filesystem(location)
    data = np.ascontiguousarray(values)
    if system is not None:
        with system.open_output_stream(path) as out:
            out.write(memoryview(data).cast("B") if data.size else b"")
        return
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex[:8]}"
    data.tofile(part)
    os.replace(part, path)


def map_array(location: str, dtype) -> np.ndarray:
    """Memory-map an array of the shared folder; other stores than mounted ones are read into memory."""
    system, path = _filesystem(location)
    if system is not None:
        with system.open_input_file(path) as source:
            return np.frombuffer(source.read(), dtype=dtype)
    if not os.path.getsize(path):
        return np.empty(0, dtype=dtype)
    return np.memmap(path, dtype=dtype, mode="r")

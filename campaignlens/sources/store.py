"""Durable intermediate tables, fitted pipelines and artefact checks.

Intermediate results are written to the shared folder that the cluster names in
``spark.checkpoint.dir``, so they survive the loss of executors. Only a local session without
that setting (one machine, as in tests) gets a folder of its own, which goes when the process ends.
"""

from __future__ import annotations

import atexit
import hashlib
import json
import shutil
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

VERSION_FILE = "_VERSION"
_RUN = uuid.uuid4().hex[:12]


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for durable intermediates."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="campaignlens-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        context.setCheckpointDir(root)
    elif not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def _run_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/campaignlens-{spark.sparkContext.applicationId}-{_RUN}"


def durable(rows: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """The same rows, written once to the shared folder and read back.

    Later passes keep column pruning and real table sizes, and nothing upstream is recomputed when
    an executor is lost.
    """
    spark = rows.sparkSession
    location = f"{_run_folder(spark)}/{uuid.uuid4().hex[:16]}"
    writer = rows.write.partitionBy(*partition_by) if partition_by else rows.write
    writer.parquet(location)
    return spark.read.schema(rows.schema).parquet(location)


def durable_parts(parts: Sequence[Callable[[], DataFrame]], run: Callable[[Sequence[Callable[[], object]]], object]) -> DataFrame:
    """Many results of one schema as one table; each is written as soon as its own job ends.

    ``run`` executes the writing tasks, side by side if it likes.
    """
    spark = SparkSession.active()
    base = f"{_run_folder(spark)}/{uuid.uuid4().hex[:16]}"

    def write(number: int, part: Callable[[], DataFrame]) -> tuple[int, object]:
        rows = part()
        rows.write.parquet(f"{base}/{number}")
        return number, rows.schema

    done = run([lambda n=n, p=p: write(n, p) for n, p in enumerate(parts)])
    return spark.read.schema(done[0][1]).parquet(*[f"{base}/{n}" for n, _ in done])


def drop_intermediates(spark: SparkSession) -> None:
    """Delete all intermediates of this application, once its results are stored elsewhere."""
    path, system = _path(spark, _run_folder(spark))
    system.delete(path, True)
    _SESSION_TABLES.clear()


def _path(spark: SparkSession, location: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, location: str) -> bool:
    path, system = _path(spark, location)
    return system.exists(path)


def _read_text(spark: SparkSession, location: str) -> str | None:
    if not path_exists(spark, location):
        return None
    rows = spark.read.text(location).collect()  # a one-line marker file
    return rows[0][0] if rows else None


def materialize(
    spark: SparkSession, build: Callable[[], DataFrame], location: str, version: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Read a stored table if it was completely written for this version, else build, write and read it."""
    complete = path_exists(spark, f"{location}/_SUCCESS")
    if not (complete and _read_text(spark, f"{location}{VERSION_FILE}") == version):
        writer = build().write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(location)
        stamp = spark.createDataFrame([(version,)], "version string").coalesce(1)
        stamp.write.mode("overwrite").text(f"{location}{VERSION_FILE}")
    return spark.read.parquet(location)


_SESSION_TABLES: dict[tuple[str, str], str] = {}


def folder_version(spark: SparkSession, directory: str) -> str:
    """Digest of the names, sizes and times of the tables in a folder."""
    path, system = _path(spark, directory)
    found = []
    for status in system.listStatus(path):
        parts = system.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [f"{p.getPath().getName()}|{p.getLen()}|{p.getModificationTime()}" for p in parts]
    return hashlib.md5("\n".join(sorted(found)).encode()).hexdigest()[:16]


def session_table(spark: SparkSession, key: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = ()) -> DataFrame:
    """A table built once per application and reused by every later query that needs it.

    A key of the form ``name:folder`` is versioned by the folder's tables, so changed files are read anew.
    """
    app = spark.sparkContext.applicationId
    name, _, folder = key.partition(":")
    if folder:
        key = f"{name}:{folder}:{folder_version(spark, folder)}"
    location = _SESSION_TABLES.get((app, key))
    if location is None:
        name = hashlib.md5(key.encode()).hexdigest()[:16]
        location = f"{_run_folder(spark)}/{name}"
        writer = build().write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(location)
        _SESSION_TABLES[(app, key)] = location
    return spark.read.parquet(location)


def save_pipeline(model: PipelineModel, location: str) -> None:
    model.write().overwrite().save(location)


def load_pipeline(location: str) -> PipelineModel:
    return PipelineModel.load(location)


def require_artefacts(spark: SparkSession, locations: Sequence[str]) -> None:
    """Raise one error that names every missing artefact."""
    missing = [location for location in locations if not path_exists(spark, location)]
    if missing:
        raise FileNotFoundError("missing artefacts: " + ", ".join(missing))


def to_json_text(document: dict) -> str:
    return json.dumps(document, indent=2, sort_keys=False)

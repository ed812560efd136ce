from __future__ import annotations

import shutil
import tempfile

import pytest
from pyspark.sql import SparkSession


def build_session(cores: int = 8, shared: str | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("campaignlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="shared-")
    session = build_session(shared=shared)
    yield session
    session.stop()
    shutil.rmtree(shared, ignore_errors=True)

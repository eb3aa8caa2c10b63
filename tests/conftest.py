"""Shared Spark session for the test suite (local mode, small shuffle count)."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from sluice.session import _ENGINE_CONF, ensure_checkpoint_dir

    warehouse = tmp_path_factory.mktemp("warehouse")
    builder = (SparkSession.builder.master("local[*]").appName("sluice-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.warehouse.dir", str(warehouse)))
    for k, v in _ENGINE_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()

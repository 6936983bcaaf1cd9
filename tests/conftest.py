from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from acctflow.session import SCALE_CONF

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("acctflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Tests name their own checkpoint folder; a cluster names a shared one.
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="acctflow-test-ckpt-"))
    )
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="acctflow-out-")

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from blotterflow.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "blotterflow-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Values through a column function, in order."""

    def run(values, function, kind="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(enumerate(values)), f"n int, v {kind}")
        rows = df.select("n", function(F.col("v")).alias("out")).orderBy("n").collect()
        return [row.out for row in rows]

    return run

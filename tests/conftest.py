from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    own = tempfile.mkdtemp(prefix="spark-")
    conf = {
        "spark.master": "local[4]", "spark.driver.memory": "4g", "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.local.dir": own, "spark.checkpoint.dir": f"{own}/shared", "spark.sql.warehouse.dir": f"{own}/warehouse", "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    s = SparkSession.builder.config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()

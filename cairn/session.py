"""The session that the tests, the bench and the examples use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_spark(app: str = "cairn", master: str = "local[*]", **conf: str) -> SparkSession:
    """A UTC session with adaptive execution, in which checkpoints go when nothing refers to them any more; `conf` keys use `__` for dots."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    spark = SparkSession.builder.master(master).appName(app).config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

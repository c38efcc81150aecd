"""Session for tests, the bench and local runs; a cluster brings its own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyforge")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Source files of one row group are read by one task; a larger side would have to be probed there.
        .config("spark.sql.autoBroadcastJoinThreshold", "2MB")
        # Recording the call site of every expression doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )

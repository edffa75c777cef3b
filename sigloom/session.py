"""Session factory with the settings every plan in this package assumes."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(cpus: int | None = None, partitions: int | None = None) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the session given.

    UTC is fixed because timestamps are compared across engines; AQE re-plans
    shuffles at run time, so the partition count is only an upper bound.
    """
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName("sigloom")
        .config("spark.sql.shuffle.partitions", str(partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )

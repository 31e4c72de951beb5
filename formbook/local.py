"""Local session for tests, checks and the benchmark."""

import os

from pyspark.sql import SparkSession


def local_session(name: str, cores: str = os.environ.get("BENCH_CPUS", "8")) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(f"formbook-{name}")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark

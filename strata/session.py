"""SparkSession for local runs (tests, bench).

On a cluster, use the session the platform provides: the jobs in this package
read their settings from it and change none.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A ``local[cores]`` session with the web UI off and the recommended AQE settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("strata")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Let AQE swap a sort-merge join for a shuffled hash join once every
        # build-side partition is measured under this size: the large side is
        # then streamed instead of sorted. Recommended on clusters too (README).
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        # zstd shuffles ~1/3 fewer bytes than the default lz4 here (README).
        .config("spark.io.compression.codec", "zstd")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark

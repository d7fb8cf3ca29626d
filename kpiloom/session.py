"""Session settings the reports rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# A grouping on the key of the join before it would reuse the join's partitions, and one
# task would get all rows of a hot key.  With forceOptimizeSkewedJoin such a partition is
# split all the same, each part is combined, and only the combined rows are shuffled.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}
SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", **ADAPTIVE}


def make_adaptive(spark: SparkSession) -> SparkSession:
    """A running session with the adaptive settings switched on."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


def shuffle_settings(shuffled_bytes: int, cores: int, target_bytes: int = 200 * 2**20) -> dict[str, str]:
    """Shuffle partitions for the bytes the largest shuffle moves.

    Partitions of about ``target_bytes`` fit an executor's memory; adaptive
    execution joins small ones and splits skewed ones at run time.
    """
    return {"spark.sql.shuffle.partitions": str(max(2 * cores, -(-shuffled_bytes // target_bytes)))}


def build_session(name: str = "kpiloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with `SETTINGS`; cluster sizes are left to the submit command."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

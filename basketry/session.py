"""Session settings this package is tested with.

On a cluster, pass the session the cluster hands you; nothing here is required
for right results.  The settings only make the defaults explicit.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan at run time: coalesce small shuffle partitions, split skewed ones,
    # switch to a broadcast join once a side is measured to be small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the bench; `extra` keys use `__` for dots."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("basketry")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **{key.replace("__", "."): value for key, value in extra.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

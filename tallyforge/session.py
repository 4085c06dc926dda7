"""SparkSession construction and cluster-facing settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins from runtime sizes (so a
# side is broadcast only when its measured size is under the threshold),
# coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "tallyforge",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """Return a session with the library defaults.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:   # only effective when this call starts the JVM (local runs)
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()

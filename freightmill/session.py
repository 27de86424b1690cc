"""Session settings the jobs are written for.

Nothing in the library needs these to be right; they only decide how fast a plan
runs. A cluster that already sets one of them keeps its own value, except for the time
zone: results are stated in UTC, so UTC is always set.
"""

from __future__ import annotations

from pyspark import SparkConf
from pyspark.sql import SparkSession

TIME_ZONE = "spark.sql.session.timeZone"
RUNTIME_DEFAULTS = {
    TIME_ZONE: "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # Lets AQE drop the two sorts of a big equi-join once it has seen that every
    # build-side partition is small enough to hash.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(
    app_name: str = "freightmill",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    ``shuffle_partitions`` should be about (bytes shuffled by the widest stage) /
    64 MB; AQE merges the surplus, it cannot split what was never there except
    for skewed joins and rebalanced writes.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    running = SparkSession.getActiveSession()
    preset = dict(SparkConf().getAll()) | (dict(running.conf.getAll) if running else {})
    settings = {k: v for k, v in RUNTIME_DEFAULTS.items() if k == TIME_ZONE or k not in preset}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

"""Session settings the operators are planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE re-plans joins from measured shuffle sizes, merges small shuffle partitions and splits
# skewed ones; the joins in ``operators`` keep the plan shape it can split (sort-merge join
# straight on two shuffles).
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Call-site capture costs several milliseconds for every Column operation.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "gridledger",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    """Get or create a session. Leave ``master`` unset under ``spark-submit``.

    ``shuffle_partitions`` is an upper bound, since AQE merges small partitions: on a cluster
    choose about (shuffled bytes / 128 MB).
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()

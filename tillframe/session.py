"""Session settings for local runs and clusters."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(name: str = "tillframe", master: str | None = None,
                shuffle_partitions: int | None = None,
                options: dict[str, str] | None = None) -> SparkSession:
    """Build or fetch a session.

    Memory, cores and the master of a cluster belong to the launcher, so they are
    set here only when the caller names them.
    """
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128MB")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (options or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

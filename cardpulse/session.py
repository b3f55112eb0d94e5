"""A session for feature jobs. Operators need none of this; any session whose time zone is UTC will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def create_session(
    app: str = "cardpulse",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    checkpoint_root: str | None = None,
    **conf: str,
) -> SparkSession:
    """``shuffle_partitions`` also sets the number of tasks that expand panes into windows: choose it for the size of
    the windows' output, about one per 100 MB. ``checkpoint_root`` is the default place of streaming checkpoints.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A hot key is split even where that takes another shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # Call-site capture costs a round trip to the JVM per column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if checkpoint_root:
        settings["spark.sql.streaming.checkpointLocation"] = checkpoint_root
    for name, value in {**settings, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()

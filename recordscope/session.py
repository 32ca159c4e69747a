"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", app: str = "recordscope", **conf: str) -> SparkSession:
    """A session with the settings every operator is written for: AQE with skew joins, ANSI arithmetic, UTC.

    Memory and the number of shuffle partitions are the deployer's; AQE merges small partitions up to a byte target and splits
    skewed ones, so the number may be set high.
    """
    builder = SparkSession.builder.master(master).appName(app)
    base = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in (base | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

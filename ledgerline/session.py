"""Sessions with the settings that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What results or plans rely on, wherever a session runs.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def session(app: str = "ledgerline", **settings: str) -> SparkSession:
    """A session of the cluster that spark-submit names, or the one that is running."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(app: str = "ledgerline", cores: int = 2, **settings: str) -> SparkSession:
    """A session on this machine, without the web page, with as many shuffle partitions as twice its cores."""
    own = {"spark.master": f"local[{cores}]", "spark.sql.shuffle.partitions": str(2 * cores), "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    return session(app, **{**own, **settings})

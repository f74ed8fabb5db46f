"""Session construction and shared-storage locations.

Library code never invents machine-local paths: intermediate stages go to the
folder the cluster names in ``spark.checkpoint.dir``; only when that is unset
(local runs) does it fall back to a folder under the warehouse directory.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "creditlake",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate stages.

    ``spark.checkpoint.dir`` as the cluster sets it; when unset (local runs),
    a folder under the warehouse directory. Nothing is set on the session.
    """
    try:  # classic sessions: the application's own subfolder of spark.checkpoint.dir
        current = spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        current = None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.conf.get("spark.master", "local")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    return warehouse.rstrip("/") + "/_checkpoints"

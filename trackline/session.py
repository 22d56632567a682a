"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every trackline job relies on: UTC wall clock (timestamps are
# compared across engines), AQE for runtime broadcast / skew handling.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "trackline",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = "16g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, conf[k])
    return spark


_CHOSEN_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession, default: str | None = None) -> str:
    """Shared folder for lineage cuts and materialised layers.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system
    path).  Only when the session has none (local tests) do we pick one,
    from ``default`` or a fresh scratch folder, and keep it for the rest of
    the application.
    """
    app = spark.sparkContext.applicationId
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or _CHOSEN_ROOTS.get(app)
    if not path:
        path = default or tempfile.mkdtemp(prefix="trackline-ckpt-")
        _CHOSEN_ROOTS[app] = path
    spark.sparkContext.setCheckpointDir(os.path.join(path, "rdd"))
    return path

"""Session helpers: a tuned local session for tests/bench and the shared
work folder used for materialised intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job here relies on. UTC is part of the data model: all
# event times are UTC and DATE(event_ts) must not depend on the host zone.
# Broadcasts: never from the optimizer's static size estimate (which can be
# far off after filters); only AQE's decision from the *measured* size of a
# finished shuffle stage, below 64 MB.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "parcelflow", extra: dict | None = None) -> SparkSession:
    """A session for tests and the bench. On a cluster, use the cluster's
    session and call :func:`configure` on it instead."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the models need to an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


@contextmanager
def session_conf(spark: SparkSession, settings: dict):
    """Session settings (None: left as it is) that hold inside the block only."""
    before = {k: spark.conf.get(k, None) for k, v in settings.items() if v is not None}
    try:
        for k in before:
            spark.conf.set(k, str(settings[k]))
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset and the session runs in one local JVM, a private
    temporary folder is created and registered as the checkpoint dir.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        cp = spark.sparkContext.getCheckpointDir()
        if cp:
            d = cp
    if not d and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir is not set: on a cluster it must name a folder all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="parcelflow-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared folder for one run's tables."""
    base = shared_dir(spark)
    if "://" not in base and not base.startswith("/"):
        base = os.path.abspath(base)
    return f"{base}/parcelflow/{name}-{uuid.uuid4().hex[:12]}"

"""SparkSession conventions.

Timestamps are instants in UTC (the raw ``event_timestamp`` is epoch
microseconds), so the session time zone is pinned to UTC. ANSI mode is left
at Spark 4's default (on): every division in the marts goes through
``try_divide``. Adaptive execution is on with skew-join splitting, which the
joins of ``operators.skew`` rely on.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "stepwise",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session builder. On a cluster, pass ``master=None`` and
    let spark-submit supply master and sizing."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and materialised layers.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a
    shared folder there). Only when it is unset in local mode, as in tests,
    a fresh scratch folder is created and registered; on a cluster an unset
    setting is an error, never a machine-local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            # A machine-local folder is not shared by executors: refuse.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or S3)")
        d = tempfile.mkdtemp(prefix="stepwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_dir(spark: SparkSession, tag: str) -> str:
    """A new folder (not yet made) below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/stepwise-{tag}-{uuid.uuid4().hex[:12]}"

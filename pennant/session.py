"""Session helpers.

``get_session`` is for tests, benchmarks and scripts; library functions never
create sessions.  ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the
running session (the cluster's shared folder) and sets a scratch folder only
when it is unset, as in local tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
}


def get_session(master: str | None = None, app: str = "pennant", conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**LOCAL_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder from the session.  Only a local master may go without one: it gets a scratch folder;
    on a cluster other machines could not read that, so there an unset folder is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="pennant-ckpt-", dir=os.environ.get("PENNANT_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def materialize(df, how: str | None = "checkpoint"):
    """Cut lineage at a branching point.

    ``checkpoint``: reliable checkpoint into the session's ``spark.checkpoint.dir``
    (shared storage on a cluster, survives executor loss); ``cache``: in-memory
    persist (lost blocks are recomputed from lineage); ``None``: keep the lineage.
    """
    if how == "checkpoint":
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "cache":
        return df.persist()
    return df

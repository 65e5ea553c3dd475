"""Session helpers.

The library never creates its own scratch space on a cluster: lineage is
cut with ``DataFrame.checkpoint()`` into the folder the cluster names in
``spark.checkpoint.dir``.  Only when that is unset *and* Spark runs in
local mode (tests, a laptop) is a fresh local folder used.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "pagetables",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # pages are wide rows: keep Arrow batches small
        "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
        # walk rounds checkpoint every round: drop the files once unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, making sure the context uses it.

    Reads ``spark.checkpoint.dir`` from the session.  If unset, a local
    folder is made only for local masters; on a cluster this raises, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; iterative plans need a "
                "shared checkpoint folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="pagetables-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df):
    """Reliable checkpoint (written to the shared checkpoint folder)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    import uuid
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def sized(df):
    """``df`` written to the shared folder and read back: its size in bytes is then
    known to the optimizer, which broadcasts it only under its own threshold.

    For the small side of a join whose other side carries html: without a
    known size Spark would shuffle the html before it can tell."""
    path = scratch_path(df.sparkSession, "sized")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

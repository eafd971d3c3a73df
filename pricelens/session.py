"""Session helpers: building a local session for tests and finding the shared
checkpoint folder that lineage cuts are written to.

On a cluster the session is given; the only thing read from it is
``spark.checkpoint.dir`` (a folder every executor can reach).  A private
folder is only chosen when the session runs in local mode and nothing is set.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def local_session(cores: int | str = "*", app: str = "pricelens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**_LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring the context with it.

    Order: the context's own dir, then ``spark.checkpoint.dir``; a private temp
    folder only for local sessions (tests).  On a cluster with nothing set this
    raises instead of silently using a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="pricelens-ckpt-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared checkpoint folder).

    Used where a plan is iterated (boosting stages, fitted state reused by many
    folds) so that a lost executor recomputes from the written table, not from
    the whole lineage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete folders of ours that nothing reads any more, and let Spark drop the shuffles of
    finished jobs: it does so when the driver's JVM collects what refers to them."""
    sc = spark.sparkContext
    for p in paths:
        path = sc._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    sc._jvm.System.gc()


# Small metadata (stage state, manifests) goes through Spark's own writers so
# any path the cluster can reach works (``file:``, ``hdfs:``, object stores);
# Python's ``open`` would only see the driver's local disk.

def write_json(spark: SparkSession, path: str, obj, default=None) -> None:
    import json
    text = json.dumps(obj, default=default)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str):
    import json
    return json.loads(spark.read.text(path).first()["value"])


def path_exists(spark: SparkSession, path: str) -> bool:
    from pyspark.errors import AnalysisException
    try:
        spark.read.format("binaryFile").load(path).limit(1).count()
        return True
    except AnalysisException:
        return False

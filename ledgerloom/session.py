"""Session settings the library is written for, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Adaptive execution sizes the shuffles after the (small) aggregates and splits hot join
# partitions of whatever the caller joined to make the ledger.
SPARK_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Reports are built from many small expressions; noting the call site of each doubles the
    # time it takes to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in {**SPARK_CONF, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder of all scratch of this Spark application, below the shared folder the cluster names in
    ``spark.checkpoint.dir``, or else below its warehouse, which all executors share too."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/ledgerloom-{spark.conf.get('spark.app.id', 'scratch')}"


def scratch_folder(spark: SparkSession) -> str:
    """New folder below ``scratch_root``. It belongs to whoever asked for it; what nobody removed
    goes with ``remove_scratch``."""
    return f"{scratch_root(spark)}/{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder in whatever store it is; False if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remove_scratch(spark: SparkSession) -> bool:
    """Delete all scratch of this application. Frames that read it are lazy, so call this when what
    was made of them is written."""
    return remove_folder(spark, scratch_root(spark))

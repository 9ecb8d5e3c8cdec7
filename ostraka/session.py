"""Session helpers shared by the operators that cut lineage or store tables between steps."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONSTRAINTS = "spark.sql.constraintPropagation.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder of checkpoints and of stored steps: the one that the cluster names in ``spark.checkpoint.dir``.

    Only a local master may leave that setting out, as in tests; it gets a temporary folder that goes
    when the driver ends. Elsewhere a missing setting is an error: no machine-local folder is shared.
    """
    context = spark.sparkContext
    there = context._jsc.sc().getCheckpointDir()
    if there.isDefined():
        return there.get().rstrip("/")
    folder = context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ostraka-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """``df`` written once to the reliable checkpoint folder; later reads don't recompute it."""
    spark = df.sparkSession
    shared_folder(spark)
    # the constraints that a checkpoint inherits may name columns that it doesn't have; unions of it then fail
    before = spark.conf.get(CONSTRAINTS, "true")
    spark.conf.set(CONSTRAINTS, "false")
    try:
        return df.checkpoint(eager)
    finally:
        spark.conf.set(CONSTRAINTS, before)


def stored(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read from there: columns and rows can be pruned."""
    path = scratch(df.sparkSession, name)
    df.write.partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

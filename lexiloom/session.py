"""Session construction and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Session settings that hold at any scale.  Sizes (shuffle partitions, memory) stay with the cluster.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "lexiloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library defaults; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where none is named, a local folder is made and set if all tasks run on this machine; else that is an error.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lexiloom-"))
    return context.getCheckpointDir().rstrip("/")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="lexiloom-"), "lexiloom.zip")
    with zipfile.ZipFile(archive, "w") as bundle:
        for folder, _, files in os.walk(root):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    bundle.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for an intermediate table."""
    return f"{shared_dir(spark)}/scratch/{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table below the shared folder, for results that are read column by column or in parts."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt to tasks by a hash of ``keys``, for work that costs much a byte, such as model calls.

    Input files can be a few large row groups, and rebalancing counts bytes; both would leave most cores idle.
    """
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *keys)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of a table in whatever store holds it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage on reliable storage, so lost executors do not recompute what came before.

    Use it once after external calls or position numbering, before the result feeds several consumers.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None) -> bool:
    """Whether a table can be read at ``path``; with a schema no file is opened for that."""
    from pyspark.errors import AnalysisException

    try:
        reader = spark.read.format(fmt)
        (reader if schema is None else reader.schema(schema)).load(path)
    except AnalysisException:
        return False
    return True

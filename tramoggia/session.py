"""Session defaults, table access and the staging of intermediate tables."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings the semantics depend on; everything else is left to the cluster.
REQUIRED = {"spark.sql.session.timeZone": "UTC", "spark.sql.mapKeyDedupPolicy": "LAST_WIN"}


def build_session(name: str = "tramoggia", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and last-wins maps; `conf` overrides."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    defaults = REQUIRED | {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once a context, so that it need not be installed there."""
    context = spark.sparkContext
    if getattr(context, "_tramoggia_shipped", False):
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="tramoggia-package-")
    context.addPyFile(shutil.make_archive(f"{folder}/tramoggia", "zip", package.parent, package.name))
    context._tramoggia_shipped = True


def mapped(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """`df.mapInArrow` with this package sent along; for use with `df.transform`."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One parquet table of a data directory."""
    ship(spark)
    return spark.read.parquet(f"{directory}/{name}.parquet")


def staging_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Only where that setting is absent (local tests) a temporary folder of this machine is
    made, once a session, and set as the checkpoint folder.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    known = getattr(context, "_tramoggia_staging", None)
    if known is None or not os.path.isdir(known):
        known = tempfile.mkdtemp(prefix="tramoggia-")
        context._tramoggia_staging = known
    return f"file://{known}"


def _staged(spark: SparkSession) -> list[str]:
    context = spark.sparkContext
    if not hasattr(context, "_tramoggia_staged"):
        context._tramoggia_staged = []
    return context._tramoggia_staged


def release(spark: SparkSession) -> None:
    """Deletes the tables this session has staged; to be called when no result that reads them is needed any more."""
    paths = _staged(spark)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(conf).delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Writes `df` to the shared folder and reads it again, which cuts its lineage.

    A written table survives the loss of any executor; a table used twice is computed once.
    The tables stay until `release` is called, as results are read lazily.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/staged/{label}-{uuid.uuid4().hex}"
    _staged(spark).append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, least: int | None = None) -> DataFrame:
    """`df` in at least as many partitions as the cluster has cores.

    Only needed before costly Python work on a table of few files; a table that already has
    enough partitions isn't shuffled.
    """
    want = least or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


__all__ = ["REQUIRED", "build_session", "mapped", "release", "ship", "spread", "stage", "staging_root", "table"]

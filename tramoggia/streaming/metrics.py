"""The metrics log as a stream: appended entries, refreshed analyses, windowed counts of late entries."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tramoggia.session import staging_root


def log_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """New parquet files of a log as a stream; `path` may also be a single file."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4)
    if os.path.isfile(path):
        return reader.option("pathGlobFilter", os.path.basename(path)).parquet(os.path.dirname(path))
    return reader.parquet(path)


def append_log(stream: DataFrame, name: str) -> str:
    """Runs the stream over what is there and appends it to a table of the shared folder, exactly once; returns its path."""
    spark = stream.sparkSession
    root = f"{staging_root(spark)}/streams/{name}"
    query = stream.writeStream.format("parquet").option("path", f"{root}/log").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return f"{root}/log"


def refreshed(stream: DataFrame, log: str, analyse: Callable[[DataFrame], DataFrame], target: str, seconds: int = 3):
    """A running query that appends each batch to `log` and writes the analysis of the whole log to `target`.

    A batch that is repeated after a failure replaces its own part of the log.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{log}/batch={number}")
        analyse(spark.read.parquet(log).drop("batch")).write.mode("overwrite").parquet(target)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{log}-state").trigger(processingTime=f"{seconds} seconds").start()


def counts_by_window(stream: DataFrame, size: str = "1 day", lateness: str = "30 days") -> DataFrame:
    """(window, run_id, entries) by sending time; entries later than `lateness` are left out. Beyond the batch analyses."""
    timed = stream.withColumn("sent", F.to_timestamp("timestamp")).withWatermark("sent", lateness)
    return timed.groupBy(F.window("sent", size), "run_id").agg(F.count("*").alias("entries"))

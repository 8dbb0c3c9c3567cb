"""The state of a staged pipeline: steps, events appended to a log, and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = "id string, step_order int, kind string, title string, objective string, requires string"
EVENTS = "seq bigint, step_id string, status string, checkpoint_path string, message string, created_at string"


def state(steps: DataFrame, events: DataFrame) -> DataFrame:
    """Each step with its status by the last event, the first start, the last completion and checkpoint, and the number of events.

    Steps without events are pending; events of unknown steps count for nothing.
    """
    last = lambda c, when: F.max_by(F.when(when, F.col(c)), F.when(when, F.col("seq")))
    by = events.groupBy("step_id").agg(
        F.max_by("status", "seq").alias("status"), F.min_by(F.when(F.col("status") == "running", F.col("created_at")), F.when(F.col("status") == "running", F.col("seq"))).alias("started_at"),
        last("created_at", F.col("status") == "completed").alias("completed_at"), last("checkpoint_path", F.col("checkpoint_path").isNotNull()).alias("checkpoint_path"),
        F.max_by("created_at", "seq").alias("updated_at"), F.count("*").alias("events"),
    )
    joined = steps.join(by, steps["id"] == by["step_id"], "left").drop("step_id")
    return joined.withColumns({"status": F.coalesce("status", F.lit("pending")), "events": F.coalesce("events", F.lit(0))})


def readiness(current: DataFrame) -> DataFrame:
    """(id, ready, next): whether a step's predecessor is completed, and whether it may run by the forward-only rule."""
    before = current.select(F.col("id").alias("_id"), F.col("status").alias("before"))
    reached = current.agg(F.coalesce(F.max(F.when(F.col("status") == "completed", F.col("step_order"))), F.lit(-1)).alias("reached"))
    joined = current.join(before, F.col("requires") == F.col("_id"), "left").crossJoin(F.broadcast(reached))  # one row
    ready = F.col("requires").isNull() | (F.coalesce("before", F.lit("")) == "completed")
    return joined.select("id", ready.alias("ready"), F.col("step_order").between(F.col("reached"), F.col("reached") + 1).alias("next"))


def upserted(steps: DataFrame, configured: DataFrame) -> DataFrame:
    """Configured steps, and kept ones that the configuration doesn't name; the configuration's values win."""
    return configured.unionByName(steps.join(configured.select("id"), "id", "left_anti"))


def fingerprint(files: DataFrame, content: str = "content") -> DataFrame:
    """(fingerprint): the SHA-256 of the sorted SHA-256 of all contents, joined by line feeds."""
    return files.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.sha2(F.col(content), 256))), "\n"), 256).alias("fingerprint"))


def rebuild(forced: Column, present: Column, changed: Column, checkpoint: Column) -> Column:
    """Whether a dataset is built again: by force, if it isn't there, or if its sources changed before any checkpoint."""
    return forced | ~present | (changed & ~checkpoint)


def latest_checkpoint(checkpoints: DataFrame) -> DataFrame:
    """The complete, readable checkpoint of the highest step, the newest among equals; (path, step, modified, complete, readable)."""
    return checkpoints.where("complete and readable").orderBy(F.desc("step"), F.desc("modified"), "path").limit(1)


def expired(checkpoints: DataFrame, keep: int) -> DataFrame:
    """The checkpoints beyond the `keep` highest steps, a listing of some files."""
    top = checkpoints.orderBy(F.desc("step"), F.desc("modified")).limit(max(0, keep)).select("path")
    return checkpoints.join(top, "path", "left_anti")


def checkpoint_due(step: Column, saved: Column, minutes: Column, every_steps: int = 0, every_minutes: float = 0) -> Column:
    """Whether to save: a new step that is a multiple, or enough minutes since the last time."""
    by_step = (step % every_steps == 0) if every_steps else F.lit(False)
    by_time = (minutes >= every_minutes) if every_minutes else F.lit(False)
    return (step > saved) & (by_step | by_time)

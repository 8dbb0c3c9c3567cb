"""Writers: JSON lines by dataset, corpora, shards with manifests, small state documents."""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramoggia.operators.examples import SHARD_ROWS, manifest


def write_samples(df: DataFrame, path: str, dataset: str = "dataset") -> None:
    """JSON lines, in a folder for each dataset; the committer makes the write whole or nothing."""
    df.write.mode("overwrite").partitionBy(dataset).json(path)


def write_corpus(df: DataFrame, path: str, text: str = "rendered") -> int:
    """One line for each text, line feeds as blanks, without empty ones; the number of lines, and an error for none."""
    lines = df.select(F.translate(F.col(text), "\n", " ").alias("value")).where(F.trim("value") != "")
    lines.write.mode("overwrite").text(path)
    n = df.sparkSession.read.text(path).count()
    if not n:
        raise ValueError("the corpus is empty")
    return n


def write_shards(df: DataFrame, path: str, dataset: str = "source", rows: int = SHARD_ROWS) -> DataFrame:
    """Parquet files of at most `rows` rows, in a folder for each dataset; returns the manifest, and an error for no examples."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).partitionBy(dataset).parquet(path)
    made = manifest(df.sparkSession.read.parquet(path), dataset, "format", rows)
    if made.isEmpty():
        raise ValueError("there are no examples")
    return made


def write_document(payload: dict, path: str) -> None:
    """A small JSON document, replaced at once."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(f"{path}.part", "w", encoding="utf-8") as f:
        json.dump(payload, f, ensure_ascii=False, indent=2)
        f.flush()
        os.fsync(f.fileno())
    os.replace(f"{path}.part", path)


def patched(state: dict, patch: dict) -> dict:
    """A state document with the patch's top-level keys."""
    return {**state, **patch}


def missing(requested: DataFrame, existing: DataFrame, exempt: Sequence[str] = ("local_import",)) -> DataFrame:
    """The requested datasets that have no rows; exempt ones aren't missed."""
    full = existing.where("rows > 0").select("dataset")
    return requested.join(full, "dataset", "left_anti").where(~F.col("dataset").isin(*exempt))

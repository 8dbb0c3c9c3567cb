"""Mixing sources to target weights by subset-sum fitting of each source's budget.

Sizes are tokens of a public tokenizer. Documents of one source and length are interchangeable, so
the fit runs on the counts of exact lengths: whole passes over a source first, then a part of every
length in proportion, and for the small rest a bounded-knapsack dynamic program over the lengths
still left. Which documents of a length are taken is decided by a seeded hash, through ranks
that never gather a group. Only (source, length, count) rows go to the driver.
"""

from __future__ import annotations

from collections import Counter
from random import Random

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramoggia.llm.encoding import TOKENIZERS, VOCABULARY, token_counts
from tramoggia.operators.joins import BROADCAST_ROWS
from tramoggia.operators.ranking import BUCKET_ROWS, rank_in_groups, seeded
from tramoggia.session import stage, table

#: The rest of a budget that is fitted exactly is at least so many tokens wide, and twice the longest document.
EXACT = 1 << 16


def fill_exactly(counts: dict[int, int], budget: int) -> dict[int, int]:
    """Counts of lengths whose sum comes as near to `budget` from below as possible (bounded knapsack).

    A length's count is split into powers of two; of every sum the first step that reaches it is kept, from which
    the choice is read back.
    """
    lengths = sorted((k for k, v in counts.items() if 0 < k <= budget and v > 0), reverse=True)
    steps: list[tuple[int, int]] = []
    first = np.full(budget + 1, -1, np.int32)
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    for length in lengths:
        left, part = min(counts[length], budget // length), 1
        while left > 0 and not reached[budget]:
            n = min(part, left)
            new = np.flatnonzero(reached[: budget + 1 - n * length] & ~reached[n * length :]) + n * length
            if len(new):
                first[new] = len(steps)
                reached[new] = True
                steps.append((length, n))
            left -= n
            part *= 2
    total, out = int(np.flatnonzero(reached)[-1]), Counter()
    while total:
        length, n = steps[first[total]]
        out[length] += n
        total -= n * length
    return dict(out)


def fit(counts: dict[int, int], budget: int, seed: int = 17) -> dict[int, int]:
    """How many documents of each length to take once more, so that their tokens come to `budget` or just below.

    `budget` is less than all tokens. Every length first gives its share of documents, a fraction of a
    document by seeded chance, so that lengths are taken as they occur; lengths in seeded order then
    give back or add documents until the rest lies in the window that is fitted exactly. The window is twice the longest
    document at least, so the rest always gets there. If tokens are still missing of a budget no wider than the window, it is
    fitted as a whole.
    """
    size = sum(k * v for k, v in counts.items())
    if size <= 0 or budget <= 0:
        return {}
    chance = Random(f"{seed}:{budget}:{size}")
    lengths = sorted(k for k, v in counts.items() if k > 0 and v > 0)
    window = max(EXACT, 2 * lengths[-1])
    taken = {}
    for k in lengths:
        whole, part = divmod(counts[k] * budget, size)
        taken[k] = whole + (chance.random() < part / size)
    rest = budget - sum(k * v for k, v in taken.items())
    chance.shuffle(lengths)
    slack = min(window // 2, budget // 4)
    for k in lengths:
        if rest < slack and taken[k]:
            back = min(taken[k], -((rest - slack) // k))
            taken[k] -= back
            rest += back * k
        elif rest > window and k <= rest:
            more = min(counts[k] - taken[k], (rest - window) // k + 1, rest // k)
            taken[k] += more
            rest -= more * k
    for length, n in fill_exactly({k: counts[k] - taken[k] for k in taken}, rest).items():
        taken[length] += n
        rest -= n * length
    if rest and budget <= window:
        whole = fill_exactly(counts, budget)
        if budget - sum(k * v for k, v in whole.items()) < rest:
            taken = whole
    return {k: v for k, v in taken.items() if v > 0}


def plan(histogram: dict[str, dict[int, int]], targets: dict[str, tuple[float, int]]) -> list[dict]:
    """For every target source its budget, whole passes and the lengths of a partial pass.

    The mix is as large as the targets allow: the source that runs out first, at its cap of
    repeats, sets the total. Sources without tokens get nothing; the others keep their shares.
    """
    weights = sum(w for w, _ in targets.values())
    sizes = {s: sum(k * v for k, v in histogram.get(s, {}).items()) for s in targets}
    able = [s for s, (w, cap) in targets.items() if w > 0 and cap > 0 and sizes[s] > 0]
    total = min((sizes[s] * targets[s][1] * weights / targets[s][0] for s in able), default=0.0)
    present = sum(targets[s][0] for s in able)
    out = []
    for s, (w, cap) in sorted(targets.items()):
        row = {"source": s, "target_share": w / weights if weights else 0.0, "present_share": w / present if s in able else 0.0, "available": sizes[s], "max_repeats": cap, "budget": 0, "passes": 0, "partial": {}}
        if s in able:
            row["budget"] = min(int(total * w / weights + 1e-6), sizes[s] * cap)
            row["passes"] = row["budget"] // sizes[s]
            row["partial"] = fit(histogram[s], row["budget"] - row["passes"] * sizes[s]) if row["passes"] < cap else {}
        out.append(row)
    return out


def targets_of(df: DataFrame) -> dict[str, tuple[float, int]]:
    """Weights and caps by source; a source given twice adds its weights and keeps the least cap; null or
    negative weights count as 0, null caps as 1."""
    rows = df.groupBy("source").agg(F.sum(F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0))).alias("weight"), F.min(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0))).alias("cap"))
    return {r.source: (r.weight, r.cap) for r in rows.where("source is not null").collect()}  # a handful of configured sources


class Mix:
    """A mix: `used` (doc_id, source, n_tokens, repeats) and `report` by source."""

    def __init__(self, used: DataFrame, report: DataFrame):
        self.used, self.report = used, report


def mix(documents: DataFrame, targets: DataFrame, seed: int = 17, vocabulary: str = VOCABULARY, place: str = TOKENIZERS) -> Mix:
    """The documents (doc_id, source, text) of a mix with target weights, and how often each is used.

    Texts of no tokens (null, empty) and sources that aren't targets take no part. Repeated
    doc_ids are documents of their own. Empty tables give an empty mix and a report of zeros.
    """
    spark = documents.sparkSession
    aims = targets_of(targets)
    sized = stage(token_counts(documents.select("doc_id", "source", "text").where(F.col("source").isin(list(aims))), "doc_id", "source", vocabulary=vocabulary, place=place).where("n_tokens > 0"), "document-sizes")
    histogram: dict[str, dict[int, int]] = {}
    # Distinct lengths only: a corpus of n tokens has at most sqrt(2 n) of them, in practice some ten thousands a source.
    for r in sized.groupBy("source", "n_tokens").count().collect():
        histogram.setdefault(r.source, {})[r.n_tokens] = r["count"]
    rows = plan(histogram, aims)
    partial = [(r["source"], n, k) for r in rows for n, k in r["partial"].items()]
    passes = spark.createDataFrame([(r["source"], r["passes"]) for r in rows], "source string, passes int")
    extra = spark.createDataFrame(partial, "source string, n_tokens bigint, take bigint")
    large = [(s, k, n) for s, v in histogram.items() for k, n in v.items() if n > BUCKET_ROWS]
    sizes = spark.createDataFrame(large, "source string, n_tokens bigint, _size bigint")
    ranked = rank_in_groups(sized, ["source", "n_tokens"], [seeded(seed, "doc_id"), F.col("doc_id")], sizes=sizes)
    if len(partial) <= BROADCAST_ROWS:
        extra = F.broadcast(extra)
    joined = ranked.join(F.broadcast(passes), "source").join(extra, ["source", "n_tokens"], "left")  # passes: a row for each target
    repeats = F.col("passes") + F.when(F.col("rank") < F.coalesce("take", F.lit(0)), 1).otherwise(0)
    used = joined.select("doc_id", "source", "n_tokens", repeats.cast("int").alias("repeats")).where("repeats > 0")
    # The shares reported are those of the documents used.
    counted = used.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("documents"), F.max("repeats").alias("most_repeats"))
    aimed = spark.createDataFrame(
        [(r["source"], r["target_share"], r["present_share"], r["budget"], r["available"], r["max_repeats"]) for r in rows],
        "source string, target_share double, present_share double, budget bigint, available_tokens bigint, max_repeats int",
    )
    joined = aimed.join(counted, "source", "left").fillna(0, ["tokens", "documents", "most_repeats"])
    whole = F.sum("tokens").over(Window.partitionBy(F.lit(0)))  # a row for each target
    share = F.when(whole > 0, F.col("tokens") / whole).otherwise(0.0)
    mean = F.when(F.col("available_tokens") > 0, F.col("tokens") / F.col("available_tokens")).otherwise(0.0)
    return Mix(used, joined.select("source", "target_share", "present_share", share.alias("actual_share"), "tokens", "budget", "available_tokens", mean.alias("mean_repeats"), "max_repeats", "documents", "most_repeats"))


def _mix(spark: SparkSession, directory: str) -> Mix:
    return mix(table(spark, directory, "documents"), table(spark, directory, "mix_targets"))


def p8_mix(spark: SparkSession, directory: str) -> DataFrame:
    """The documents of the mix and how often each is used."""
    return _mix(spark, directory).used


def p8_report(spark: SparkSession, directory: str) -> DataFrame:
    """Target and actual shares of the mix, counted from the documents used."""
    return _mix(spark, directory).report

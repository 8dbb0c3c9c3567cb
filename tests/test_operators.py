"""Ranks, series and joins, against brute force and on hard cases."""

import random

import pytest
from pyspark.sql import functions as F

from tramoggia.operators import joins, ranking, series


@pytest.mark.parametrize("bucket_rows", [10**6, 7])
def test_rank_in_groups(spark, bucket_rows):
    df = spark.range(300).select((F.col("id") % 3).alias("g"), F.when(F.col("id") > 200, F.lit(None)).otherwise(F.col("id") % 50).alias("v"), "id")
    rows = ranking.rank_in_groups(df, ["g"], ["v", "id"], bucket_rows=bucket_rows).collect()
    for g in range(3):
        assert sorted(r["rank"] for r in rows if r.g == g) == list(range(100))
    ordered = ranking.ordered_rank(df, ["g"], "id", 16).collect()
    assert all(r["rank"] == r.id // 3 for r in ordered)


def test_trailing_mean_and_asof(spark, monkeypatch):
    monkeypatch.setattr(series, "BLOCK", 5)
    rng = random.Random(1)
    rows = [("a", k, rng.choice([None, float(k)])) for k in rng.sample(range(500), 80)] + [("b", 3, 1.0)]
    df = spark.createDataFrame(rows, "k string, step long, x double")
    got = {(r.k, r.step): r.x_smooth for r in series.trailing_mean(df, "k", "step", {"x": 4}).collect()}
    line = sorted(r for r in rows if r[0] == "a")
    for at, (_, step, _) in enumerate(line):
        frame = [x for _, _, x in line[max(0, at - 3) : at + 1] if x is not None]
        assert got["a", step] == (pytest.approx(sum(frame) / len(frame)) if frame else None)
    left = spark.createDataFrame([("a", k) for k in range(0, 500, 7)] + [("c", 1)], "k string, step long")
    right = spark.createDataFrame([(k, s, s) for k, s, _ in rows], "k string, step long, at long")
    steps = sorted(s for k, s, _ in rows if k == "a")
    found = {(r.k, r.step): r.at for r in series.asof_backward(left, right, "k", "step", ["at"], width=16).collect()}
    assert found.pop(("c", 1)) is None
    assert found == {("a", k): max((s for s in steps if s <= k), default=None) for k in range(0, 500, 7)}
    last = sorted(r.step for r in series.last_rows(df, "k", "step", 3).collect() if r.k == "a")
    assert last == steps[-3:]


@pytest.mark.parametrize("limit", [100, 1])
def test_lookup_salted_equals_broadcast(spark, limit):
    df = spark.createDataFrame([(k, "hot" if k % 2 else "cold") for k in range(40)] + [(99, None)], "id int, w string")
    small = spark.createDataFrame([("hot", 1), ("odd", 2)], "w string, v int")
    got = {r.id: r.v for r in joins.lookup(df, small, "w", limit=limit).collect()}
    assert got == {**{k: 1 if k % 2 else None for k in range(40)}, 99: None}
    assert joins.lookup(df, small, "w", "inner", limit).count() == 20

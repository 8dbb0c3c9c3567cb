"""Packing and similarity, against brute force and on hard cases."""

import inspect
import math
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tramoggia.llm import packing, similarity


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 6), min_size=1, max_size=8))
def test_completion_is_the_best_filling(counts):
    left, room = Counter(counts), 31
    sums = {0}
    for k, n in counts.items():
        sums = {s + k * j for s in sums for j in range(n + 1) if s + k * j <= room}
    fill = packing.completion(left, sorted(counts), room, 600)
    assert sum(fill) == max(sums) and not Counter(fill) - left


def test_completion_leaves_branches_that_cannot_win():
    # Many fillings of equal sums; the best, 2040, takes 40 items of 51.
    left = Counter({50 * k: 9 for k in range(1, 37)} | {51: 40})
    assert sum(packing.completion(left, sorted(left), 2047)) == 2040


def _fewest(items, capacity):
    """The least number of bins, by dynamic programming over sets of items."""
    best = [(99, 0)] * (1 << len(items))
    best[0] = (1, 0)
    for done in range(1 << len(items)):
        bins, used = best[done]
        for i, size in enumerate(items):
            if bins < 99 and not done >> i & 1:
                best[done | 1 << i] = min(best[done | 1 << i], (bins, used + size) if used + size <= capacity else (bins + 1, size))
    return best[-1][0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=9), st.integers(40, 60))
def test_bin_completion_is_the_best_packing(items, capacity):
    made = packing.bin_completion(Counter(items), capacity)
    packed = Counter()
    for times, fill in made.patterns:
        assert times > 0 and 0 < sum(fill) <= capacity
        for k in fill:
            packed[k] += times
    assert packed == Counter(items) and made.proved and made.bound <= made.bins == _fewest(items, capacity)


def test_bin_completion_backtracks():
    # Bin after bin in greedy order takes five.
    made = packing.bin_completion(Counter([26, 20, 18, 17, 13, 11, 23, 13, 22, 12, 22]), 50)
    assert made.bins == made.bound == 4 and made.proved
    assert packing.bin_completion({6: 1, 4: 1, 5: 2}, 10).bins == 2
    assert packing.bin_completion({}, 10).bins == 0
    with pytest.raises(ValueError):
        packing.bin_completion({11: 1}, 10)


def test_large_packings_state_their_gap():
    rng = random.Random(1)
    counts = Counter(rng.randint(600, 1400) for _ in range(20_000))
    made = packing.bin_completion(counts, 2048)
    number = sum(t for t, _ in packing.best_fit(counts, 2048))
    packed = Counter()
    for times, fill in made.patterns:
        assert sum(fill) <= 2048
        for k in fill:
            packed[k] += times
    assert packed == counts and made.bound <= made.bins <= number and made.proved == (made.bins == made.bound)


def test_pack_rows(spark):
    sizes = [("a", 5000), ("b", 2048), ("c", 0), ("d", None), ("e", 100), ("f", 1948), ("g", 3)]
    rows = packing.pack(spark.createDataFrame(sizes, "item string, size long").withColumn("bin", F.lit(1))).rows.collect()
    assert sorted((r.item, r.piece) for r in rows) == [("a", 0), ("a", 1), ("a", 2), ("b", 0), ("c", 0), ("d", 0), ("e", 0), ("f", 0), ("g", 0)]
    used = {}
    for r in rows:
        used[r.bin] = used.get(r.bin, 0) + r.length
    assert max(used.values()) <= 2048 and sum(used.values()) == 5000 + 2048 + 100 + 1948 + 3 and len(used) == 5
    assert packing.pack(spark.createDataFrame([], "item string, size long")).rows.count() == 0


def test_examples_count_unmasked_ids_once(spark):
    schema = "example_id long, shard string, input_ids array<long>, labels array<long>, attention_mask array<long>, size int"
    rows = [(1, "x", [1, 2, 3], [1], [1, 1, 0], 9), (1, "y", [1, 2, 3], [1], [1, 1, 0], 9), (2, "x", [4] * 3000, None, None, 9), (3, "x", None, None, [1], 9), (4, "x", [], [], [], 9), (None, "x", [7], None, [1], 9), (5, "x", [1, 2], None, [None, 0], 9)]
    df = spark.createDataFrame(rows, schema)
    assert {r.example_id: r.size for r in packing.examples(df).collect()} == {1: 2, 2: 3000, 3: 0, 4: 0, None: 1, 5: 1}
    made = packing.packed_examples(df).rows
    assert [r.example_id for r in made.where("pieces > 1").select("example_id").distinct().collect()] == [2]


def _brute(rows, threshold, n):
    sets = {i: set(zip(*[similarity._WORD.findall(t.lower())[k:] for k in range(n)])) for i, t in rows if t}
    sets = {i: s for i, s in sets.items() if s}
    return {(min(a, b), max(a, b)) for a, b in combinations(sets, 2) if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-12}


@pytest.fixture(scope="module")
def records():
    rng = random.Random(0)
    words = [f"w{k}" for k in range(2000)]
    base = [rng.choice(words) for _ in range(80)]
    rows = []
    for k in range(70):
        t = list(base)
        for _ in range(rng.randint(0, 8)):
            t[rng.randrange(80)] = rng.choice(words)
        rows.append((k, " ".join(t)))
    rows += [(1000 + k, " ".join(base)) for k in range(25)]
    rows += [(2000 + k, " ".join(rng.choice(words) for _ in range(60))) for k in range(60)]
    return [*rows, (5000, None), (5001, ""), (5002, " \n"), (5003, "uno due"), (5004, "x " * 5000), (5005, "x " * 6000)]


@pytest.mark.parametrize(("node", "levels"), [(300, 2), (8, 1)])
def test_similar_pairs_equal_brute_force(spark, records, monkeypatch, node, levels):
    monkeypatch.setattr(similarity, "NODE", node)
    monkeypatch.setattr(similarity, "LEVELS", levels)
    df = spark.createDataFrame(records, "rec_id long, text string").withColumn("class", F.lit("clash"))
    got = {tuple(r) for r in similarity.similar(df, 0.6, 3).pairs().collect()}
    assert got == _brute(records, 0.6, 3)


@pytest.mark.parametrize("threshold", [0.6, 0.8])
def test_similar_recall_counts_levels(threshold):
    recall = inspect.signature(similarity.similar).parameters["recall"].default
    choices = math.ceil(1 / threshold)
    trees = similarity.trees_for(threshold, choices, recall)
    assert recall >= 0.9999 and similarity.missed(threshold, choices, trees) <= 1 - recall < similarity.missed(threshold, choices, trees - 1)
    assert np.unique(similarity._places(trees, 11)).size == 2 * trees
    # Followed through all levels as if every node were large, for pairs that agree in each token with the threshold's probability.
    rng, rounds = np.random.default_rng(1), 20_000
    few = max(1, trees // 3)
    roots = np.array(similarity._roots(few, 11), np.int64).view(np.uint64)
    a = rng.integers(0, 256, (rounds, similarity.SIGNATURE)).astype(np.uint64)
    agree = rng.random(a.shape) < threshold
    b = np.where(agree, a, a + np.uint64(1))
    pair, places = np.repeat(np.arange(rounds), few), np.tile(similarity._places(few, 11), (rounds, 1))
    x, y = (similarity._named(np.tile(roots, rounds), t[pair], places) for t in (a, b))
    pair, node = pair[x == y], x[x == y].view(np.uint64)
    for _ in range(similarity.LEVELS):
        x, y = (similarity._chosen(node, t[pair], similarity._below(node, choices + 1)) for t in (a, b))
        pair, node = np.repeat(pair, choices + 1)[(x == y).ravel()], x[x == y].view(np.uint64)
    kept = np.zeros(rounds, bool)
    kept[pair] = True
    lost = 1 - (kept & (agree.sum(axis=1) >= similarity._close(threshold))).mean()
    assert lost <= similarity.missed(threshold, choices, few) * 1.1 + 1e-3


def test_similar_groups(spark, records):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in sorted(_brute(records, 0.6, 3)):
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    made = similarity.similar(spark.createDataFrame(records, "rec_id long, text string"), 0.6, 3)
    got = {r.rec_id: r.group_id for r in made.groups().collect()}
    assert set(got) == {r.rec_id for r in made.members.collect()} and all(g == root(k) for k, g in got.items())


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, 9), (9, 8), (8, 8), (None, 3)]
    got = {r.node: r.component for r in similarity.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, 7: 7, 8: 7, 9: 7}


def test_similar_classes(spark, records):
    made = {r.rec_id: r for r in similarity.similar(spark.createDataFrame(records, "rec_id long, text string"), 0.6, 3).classes().collect()}
    assert made[1003].copies == made[1024].copies >= 25 and made[1003].class_id == made[1024].class_id <= 1000
    assert made[2000].links == 0 and 5000 not in made and 5003 not in made
    assert made[5005].class_id == 5004


def test_similar_empty(spark):
    made = similarity.similar(spark.createDataFrame([], "rec_id long, text string"))
    assert made.pairs().count() == 0 and made.classes().count() == 0



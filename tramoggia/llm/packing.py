"""Filling containers of fixed capacity by bin completion on the histogram of lengths.

Items of one length are interchangeable, so the search runs on the counts of the lengths, of which
there are at most `capacity`: that alone goes to the driver, however many items there are. A first
descent completes bin after bin around the largest item left and repeats each filling as often as the
counts allow. Where it misses the lower bound, branch and bound goes on: depth first over the undominated
fillings of each bin, left as soon as the waste so far is more than a better packing may have. A small
instance is searched whole; of a large one the bins with waste, and as many full ones as make an
instance of bounded size, are packed anew. Best-fit-decreasing and the first descent are the incumbents. Bin
packing being NP-hard the search has a budget of nodes; a packing says whether it is proved to be the best,
and how far from the lower bound it is if not. The items are then dealt to the bins by their rank among the
items of their length.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramoggia.operators.ranking import BUCKET_ROWS, rank_in_groups, seeded
from tramoggia.session import stage, table

CAPACITY = 2048
#: Fillings looked at for one bin of the first descent before the best so far is taken.
NODES = 20_000
#: Steps of the branch and bound, over all bins, and the items of an instance that it searches.
SEARCH, SEARCH_ITEMS = 400_000, 300

Patterns = list[tuple[int, tuple[int, ...]]]


def best_fit(counts: dict[int, int], capacity: int) -> Patterns:
    """Best-fit-decreasing on counts: (times, lengths of one bin)."""
    left = Counter({k: v for k, v in counts.items() if v > 0})
    lengths = sorted(left)
    out = []
    while lengths:
        room, bin_, used = capacity, [], Counter()
        while (at := bisect_right(lengths, room)) > 0:
            while at > 0 and left[lengths[at - 1]] <= used[lengths[at - 1]]:
                at -= 1
            if at == 0:
                break
            item = lengths[at - 1]
            bin_.append(item)
            used[item] += 1
            room -= item
        times = min(left[k] // n for k, n in used.items())
        left.subtract({k: n * times for k, n in used.items()})
        lengths = [k for k in lengths if left[k] > 0]
        out.append((times, tuple(bin_)))
    return out


def completion(left: Counter, lengths: list[int], room: int, nodes: int = NODES) -> tuple[int, ...]:
    """The filling of `room` with the least waste, of few large items among equals.

    Depth-first over the lengths in descending order. A filling is dominated by one that has a
    larger item in place of some of its items, so larger items come first and a branch is left as
    soon as the largest sum that it still can reach doesn't beat the best. A full bin ends the search.
    """
    best: tuple[int, ...] = ()
    best_sum = 0
    budget = nodes
    # (room left, highest index + 1 that may be used, items); greedy fillings come first.
    stack: list[tuple[int, int, tuple[int, ...]]] = [(room, bisect_right(lengths, room), ())]
    # All items up to each length; and the states looked at: another filling of the same sum, from the same lengths on
    # and with as many of the last one left, is dominated by the first.
    reach = [0, *accumulate(k * left[k] for k in lengths)]
    seen: set[tuple[int, int, int]] = set()
    while stack and budget > 0:
        budget -= 1
        space, top, items = stack.pop()
        if room - space > best_sum:
            best, best_sum = items, room - space
            if space == 0:
                break
        top = min(top, bisect_right(lengths, space))
        if top == 0:
            continue
        item = lengths[top - 1]
        taken = items.count(item)
        if room - space + min(space, reach[top] - taken * item) <= best_sum or (space, top, taken) in seen:
            continue
        seen.add((space, top, taken))
        if top > 1:
            stack.append((space, top - 1, items))
        if taken < left[item]:
            stack.append((space - item, top, (*items, item)))
    return best


def first_descent(counts: dict[int, int], capacity: int, nodes: int = NODES) -> Patterns:
    """Bin after bin around the largest item left, each filling repeated as often as the counts allow."""
    left = Counter(counts)
    lengths = sorted(counts)
    out = []
    while lengths:
        largest = lengths[-1]
        left[largest] -= 1
        fill = (largest, *completion(left, lengths, capacity - largest, nodes))
        left[largest] += 1
        used = Counter(fill)
        times = min(left[k] // n for k, n in used.items())
        left.subtract({k: n * times for k, n in used.items()})
        lengths = [k for k in lengths if left[k] > 0]
        out.append((times, fill))
    return out


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """A lower bound of the number of bins: by size, and by the large items and the room they leave.

    For each k, items above capacity - k need bins of their own that take nothing of k or more, those above
    half the capacity one each, and what is left of the items from k on fills at best the rest of these.
    """
    lengths = sorted(counts)
    number = [0, *accumulate(counts[k] for k in lengths)]
    total = [0, *accumulate(k * counts[k] for k in lengths)]
    best = -(-total[-1] // capacity)
    half = bisect_right(lengths, capacity // 2)
    for k in [0, *lengths[:half]]:
        lo, hi = bisect_right(lengths, k - 1), max(half, bisect_right(lengths, capacity - k))
        own, halves = number[-1] - number[hi], number[hi] - number[half]
        rest = total[half] - total[lo] - (halves * capacity - (total[hi] - total[half]))
        best = max(best, own + halves + max(0, -(-rest // capacity)))
    return best


def fillings(left: Counter, lengths: list[int], room: int, waste: int, steps: list[int]) -> Iterator[tuple[int, ...]]:
    """The undominated fillings of `room` that leave at most `waste` of it, large items first; `steps` counts down.

    A filling is dominated if an item left out can take the place of some of its items of no larger sum and still
    fits: packing the smaller ones elsewhere is never worse.
    """
    reach = [0, *accumulate(k * left[k] for k in lengths)]
    stack: list[tuple[int, int, tuple[int, ...]]] = [(room, bisect_right(lengths, room), ())]
    while stack and steps[0] > 0:
        steps[0] -= 1
        space, top, items = stack.pop()
        top = min(top, bisect_right(lengths, space))
        taken = items.count(lengths[top - 1]) if top else 0
        if top == 0 or reach[top] == taken * lengths[top - 1]:
            if space <= waste and not _dominated(items, left, lengths, space):
                yield items
            continue
        item = lengths[top - 1]
        if space - min(space, reach[top] - taken * item) > waste:
            continue
        stack.append((space, top - 1, items))
        if taken < left[item]:
            stack.append((space - item, top, (*items, item)))


def _dominated(items: tuple[int, ...], left: Counter, lengths: list[int], space: int) -> bool:
    """Whether some items of a filling can give way to one larger item left out; also if another one simply fits in."""
    used, sums = Counter(items), 1
    for k in items:
        sums |= sums << k
    sums &= ~1
    for e in lengths:
        if left[e] <= used[e]:
            continue
        if e <= space:
            return True
        # Sums from e - space to e; e itself doesn't count if it is but the same item.
        window = (sums >> (e - space)) & ((1 << (space + 1)) - 1)
        if used[e]:
            other = 1
            for k in items:
                if k != e:
                    other |= other << k
            window = window & ~(1 << space) | (other >> e & 1) << space
        if window:
            return True
    return False


def branch_and_bound(counts: dict[int, int], capacity: int, best: Patterns, bound: int, search: int = SEARCH) -> tuple[Patterns, bool]:
    """A packing of fewer bins than `best`, if there is one, and whether the result is proved to be of the least number.

    Bin by bin, each around the largest item left; fillings of one bin are tried in turn, those of the next bins
    within. The waste allowed falls with every packing found. Without `search` steps left the best so far is taken.
    """
    left, total, most = Counter(counts), sum(k * v for k, v in counts.items()), sum(t for t, _ in best)
    steps, found, waste = [search], best, 0

    def open_bin() -> Iterator[tuple[int, ...]]:
        lengths = sorted(k for k, v in left.items() if v > 0)
        largest = lengths[-1]
        left[largest] -= 1
        rest = [k for k in lengths if left[k] > 0]
        allowed = (most - 1) * capacity - total - waste
        made = sorted(fillings(left, rest, capacity - largest, allowed, steps), key=lambda f: (-sum(f), len(f)))
        left[largest] += 1
        return iter([(largest, *f) for f in made])

    path: list[tuple[int, ...]] = []
    open_: list[Iterator[tuple[int, ...]]] = [open_bin()] if total else []
    while open_ and most > bound and steps[0] > 0:
        if len(path) == len(open_):
            last = path.pop()
            left.update(last)
            waste -= capacity - sum(last)
        fill = next(open_[-1], None)
        if fill is None:
            open_.pop()
            continue
        if (most - 1) * capacity - total - waste < capacity - sum(fill):
            # Too much waste for fewer bins; the bin's other fillings are no fuller.
            open_.pop()
            continue
        path.append(fill)
        left.subtract(fill)
        waste += capacity - sum(fill)
        if not any(v > 0 for v in left.values()):
            if len(path) < most:
                found, most = [(1, f) for f in path], len(path)
        elif len(path) + 1 < most:
            open_.append(open_bin())
    return found, most <= bound or not open_


class Packing(NamedTuple):
    """(times, lengths of one bin) for all items, their number of bins, a lower bound of it, and whether no packing has fewer."""

    patterns: Patterns
    bins: int
    bound: int
    proved: bool


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES, search: int = SEARCH, items: int = SEARCH_ITEMS) -> Packing:
    """A packing of all items; each length is from 1 to `capacity`. Never more bins than best-fit-decreasing."""
    counts = {int(k): int(v) for k, v in counts.items() if v > 0}
    if any(not 0 < k <= capacity for k in counts):
        raise ValueError("lengths must be from 1 to the capacity")
    number = lambda patterns: sum(t for t, _ in patterns)
    bound = least_bins(counts, capacity)
    best = best_fit(counts, capacity)
    if number(best) > bound:
        best = min(best, first_descent(counts, capacity, nodes), key=number)
    proved = number(best) <= bound
    if not proved and sum(counts.values()) <= items:
        best, proved = branch_and_bound(counts, capacity, best, bound, search)
    elif not proved:
        # The bins with the most waste, while their items are few enough, are packed anew.
        kept, parts, size = [], [], 0
        for times, fill in sorted(best, key=lambda p: sum(p[1])):
            again = max(0, min(times, (items - size) // len(fill)))
            size += again * len(fill)
            parts += [(again, fill)] * (again > 0)
            kept += [(times - again, fill)] * (times > again)
        some: Counter = Counter()
        for times, fill in parts:
            for k in fill:
                some[k] += times
        better, _ = branch_and_bound(some, capacity, parts, least_bins(some, capacity), search)
        best = kept + better
        proved = number(best) <= bound
    return Packing(best, number(best), bound, proved)


def example_length(ids: Column, mask: Column) -> Column:
    """The number of ids whose mask entry isn't 0; a null mask (or entry) masks nothing; null ids give 0."""
    zeros = F.size(F.filter(F.slice(mask, F.lit(1), F.greatest(F.size(ids), F.lit(1))), lambda x: x == 0))
    n = F.when(ids.isNull(), 0).otherwise(F.size(ids))
    return F.greatest(F.lit(0), n - F.when(mask.isNull() | (n == 0), 0).otherwise(zeros)).cast("bigint")


def segments(patterns: Patterns) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first bin, items of the length in a bin), by the patterns' order."""
    given: Counter = Counter()
    out, first = [], 0
    for times, fill in patterns:
        for length, n in Counter(fill).items():
            out.append((length, given[length], given[length] + times * n, first, n))
            given[length] += times * n
        first += times
    return out


class Packed(NamedTuple):
    """The result of `pack`: rows (item, piece, pieces, start, length, bin), and the packing they follow."""

    rows: DataFrame
    plan: Packing


def pack(items: DataFrame, capacity: int = CAPACITY, seed: int = 1) -> Packed:
    """`items` (item, size) in containers of `capacity`.

    Items larger than the capacity are cut into full pieces and a rest; no other is cut. Items of
    size 0 go to bin 0, which takes no room there. A null size counts as 0. Rows are taken as they
    are: an item in two rows is packed twice. An empty table gives no rows.
    """
    spark = items.sparkSession
    size = F.greatest(F.coalesce("size", F.lit(0)), F.lit(0)).cast("bigint")
    pieces = F.greatest(F.lit(1), F.ceil(size / F.lit(capacity))).cast("int")
    cut = items.select("item", size.alias("size"), pieces.alias("pieces")).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    start = F.col("piece").cast("bigint") * capacity
    cut = cut.select("item", "piece", "pieces", start.alias("start"), F.least(F.col("size") - start, F.lit(capacity).cast("bigint")).alias("length"))
    cut = stage(cut, "pieces")
    counts = {r.length: r["count"] for r in cut.groupBy("length").count().collect()}  # at most capacity + 1 rows
    plan = bin_completion({k: v for k, v in counts.items() if k > 0}, capacity)
    # A pattern is repeated until a length runs out, so there are a few patterns for each of at most `capacity` lengths.
    parts = spark.createDataFrame(segments(plan.patterns), "length bigint, lo bigint, hi bigint, first bigint, n bigint")
    parts = parts.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "first", "n"))).alias("parts"))
    sizes = spark.createDataFrame([(k, n) for k, n in counts.items() if n > BUCKET_ROWS], "length bigint, _size bigint")
    ranked = rank_in_groups(cut, ["length"], [seeded(seed, "item", "piece"), F.col("item"), F.col("piece")], sizes=sizes)
    joined = ranked.join(F.broadcast(parts), "length", "left")
    part = F.get(F.filter("parts", lambda p: (p["lo"] <= F.col("rank")) & (F.col("rank") < p["hi"])), F.lit(0))
    bin_ = F.coalesce(part["first"] + F.floor((F.col("rank") - part["lo"]) / part["n"]), F.lit(0)).cast("bigint")
    return Packed(joined.select("item", "piece", "pieces", "start", "length", bin_.alias("bin")), plan)


def examples(df: DataFrame) -> DataFrame:
    """(example_id, size): one row for each example of packed_shards; copies of an example are one.

    Rows without an id are examples of their own contents.
    """
    size = example_length(F.col("input_ids"), F.col("attention_mask"))
    own = F.when(F.col("example_id").isNull(), F.xxhash64("input_ids", "attention_mask"))
    return df.select("example_id", own.alias("own"), size.alias("size")).groupBy("example_id", "own").agg(F.max("size").alias("size")).drop("own")


def packed_examples(df: DataFrame, capacity: int = CAPACITY) -> Packed:
    """(example_id, piece, pieces, start, length, bin) for the examples of packed_shards."""
    packed = pack(examples(df).withColumnRenamed("example_id", "item"), capacity)
    return packed._replace(rows=packed.rows.withColumnRenamed("item", "example_id"))


def p5_found(spark: SparkSession, directory: str) -> DataFrame:
    """The examples that the packing has in more than one sequence."""
    rows = packed_examples(table(spark, directory, "packed_shards")).rows
    # An example cut fills bins of its own but for its rest, so only one that was cut is in several; two examples without an id aren't.
    by = rows.groupBy("example_id").agg(F.min("bin").alias("first"), F.max("bin").alias("last"), F.max("pieces").alias("pieces"))
    return by.where("first < last and pieces > 1").select("example_id")


def p5_bins(spark: SparkSession, directory: str) -> DataFrame:
    """Every example, or piece of one, with its training sequence."""
    return packed_examples(table(spark, directory, "packed_shards")).rows


def p5_fill(spark: SparkSession, directory: str) -> DataFrame:
    """How full the training sequences are: their number, ids, the fullest, unused space, the bins at least needed and the gap to them, and whether the packing is proved to be the best."""
    packed = packed_examples(table(spark, directory, "packed_shards"))
    bins = packed.rows.groupBy("bin").agg(F.sum("length").alias("used"))
    total = bins.agg(F.count("*").alias("bins"), F.sum("used").alias("ids"), F.max("used").alias("fullest"))
    unused = F.col("bins") * CAPACITY - F.col("ids")
    least = F.lit(packed.plan.bound).cast("bigint")
    return total.select("bins", "ids", "fullest", unused.alias("unused"), least.alias("least_bins"), (F.col("bins") - least).alias("gap"), F.lit(packed.plan.proved).alias("proved"))

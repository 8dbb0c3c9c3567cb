"""Near-duplicate records by chosen-path set similarity join.

Every text becomes the set of its shingles (runs of consecutive words). Texts with equal sets are
one class, and the classes' representatives are joined: in a tree, a node is a group of classes
that chose the same minwise tokens so far. The root of a tree takes two steps at once, by two coordinates
of the minwise signature that no other tree's root uses; a class goes to the node named by its tokens there. The
classes of a node that is still large choose further coordinates, by a hash of the node, and go to the child nodes
named by the tokens found there; two sets of similarity J share each choice with probability J, so with more choices
than 1/threshold a pair stays together in some path. Small nodes are compared exhaustively, first
by signature, then by the exact sets. Independent trees repeat this to the target recall. Nodes
that stay large to the last level hold truly similar records and are compared in blocks, so that
no group is ever gathered whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramoggia.operators.joins import lookup
from tramoggia.session import mapped, stage, table

#: Minwise tokens in a signature.
SIGNATURE = 64
#: Classes up to which a node is compared exhaustively.
NODE = 300
#: Levels below the root, which takes two steps at once.
LEVELS = 2
#: The signatures of a pair may fall short of the threshold by so many standard deviations.
SLACK = 4.5
_WORD = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Words to their 64-bit hashes, computed once; emptied before it grows large."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _Hashes()


def shingles(text: str | None, n: int) -> np.ndarray:
    """The sorted 64-bit hashes of the text's runs of n words (lower-case letters and digits)."""
    words = _WORD.findall(text.lower()) if text else []
    if len(words) < n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        out = h[: len(h) - n + 1].copy()
        for k in range(1, n):
            out = (out ^ (out >> np.uint64(29))) * _MIX + h[k : len(h) - n + 1 + k]
        out = (out ^ (out >> np.uint64(32))) * _MIX
    out ^= out >> np.uint64(29)
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def _multipliers(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 31, (count, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, (count, 1), dtype=np.uint32)


def signature(items: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set, 32 bits each; the items are well mixed hashes."""
    return ((items >> np.uint64(32)).astype(np.uint32)[None, :] * a + b).min(axis=1)


def sketches(df: DataFrame, n: int, seed: int, trees: int) -> DataFrame:
    """(rec_id, class, size, nodes, bits) of the texts with n words or more; equal sets have equal classes.

    `nodes` are the nodes below all trees' roots that the set chooses, by two whole minwise tokens;
    `bits` keeps 4 bits of each token, which is enough to compare and to branch further.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _multipliers(SIGNATURE, seed)
        roots, places = np.array(_roots(trees, seed), np.int64).view(np.uint64), _places(trees, seed)
        for batch in batches:
            ids, classes, sizes, found = [], [], [], []
            for rec_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                items = shingles(text, n)
                if len(items):
                    ids.append(rec_id)
                    with np.errstate(over="ignore"):
                        classes.append(int((np.bitwise_xor.reduce(items * _MIX) + items.sum()).view(np.int64)))
                    sizes.append(len(items))
                    found.append(signature(items, a, b))
            # All texts of a batch choose their nodes at once.
            tokens = np.stack(found) if found else np.zeros((0, SIGNATURE), np.uint32)
            rows = len(tokens)
            nodes = _named(np.tile(roots, rows), tokens, np.tile(places, (rows, 1)), np.repeat(np.arange(rows), trees))
            low = tokens.astype(np.uint8) & 15
            raw = (low[:, 0::2] | low[:, 1::2] << 4).tobytes()
            bits = [raw[k : k + SIGNATURE // 2] for k in range(0, len(raw), SIGNATURE // 2)]
            chosen = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * trees, pa.int32()), pa.array(nodes))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(classes, pa.int64()), pa.array(sizes, pa.int32()), chosen, pa.array(bits, pa.binary())], names=["rec_id", "class", "size", "nodes", "bits"])

    return df.select("rec_id", "text").transform(mapped, run, "rec_id bigint, class bigint, size int, nodes array<bigint>, bits binary")


def missed(threshold: float, choices: int, trees: int) -> float:
    """The probability, at most, that a pair at the threshold isn't found.

    Counted over the m coordinates of the signature where the pair agrees, as all trees draw from
    the same ones: too few for the comparison, or none of the trees whose two root coordinates agree
    leads to a common path through all LEVELS.
    """
    out = 0.0
    for m in range(SIGNATURE + 1):
        p = math.comb(SIGNATURE, m) * threshold**m * (1 - threshold) ** (SIGNATURE - m)
        if m >= _close(threshold):
            q, apart = m / SIGNATURE, 0.0
            for _ in range(LEVELS):
                apart = (1 - q + q * apart) ** (choices + 1)
            # Ways to lay m agreeing coordinates so that h trees have both of theirs, others one or none.
            ways, rest = 0.0, SIGNATURE - 2 * trees
            for h in range(min(trees, m // 2) + 1):
                for one in range(min(trees - h, m - 2 * h) + 1):
                    if m - 2 * h - one <= rest:
                        ways += math.comb(trees, h) * math.comb(trees - h, one) * 2**one * math.comb(rest, m - 2 * h - one) * apart**h
            p *= ways / math.comb(SIGNATURE, m)
        out += p
    return out


def trees_for(threshold: float, choices: int, recall: float) -> int:
    """The trees after which a pair at the threshold has shared a path through all levels with this probability."""
    for trees in range(1, SIGNATURE // 2 + 1):
        if missed(threshold, choices, trees) <= 1 - recall:
            return trees
    raise ValueError(f"{SIGNATURE} minwise tokens don't give recall {recall} at threshold {threshold}")


def _unpacked(raw: np.ndarray) -> np.ndarray:
    """The tokens' bits (rows × SIGNATURE) from two to a byte."""
    out = np.empty((len(raw), SIGNATURE), np.uint8)
    out[:, 0::2], out[:, 1::2] = raw & 15, raw >> 4
    return out


def _named(node: np.ndarray, tokens: np.ndarray, places: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """For each node's name the one that its row's tokens at its `places` lead to, one step after the other."""
    for k in range(places.shape[1]):
        node = _chosen(node, tokens, places[:, k : k + 1], rows)[:, 0].view(np.uint64)
    return node.view(np.int64)


def _chosen(node: np.ndarray, tokens: np.ndarray, places: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """The children each node's name leads to, by the tokens of its row (its own by default) at its `places` (names × choices)."""
    rows, out = np.arange(len(node)) if rows is None else rows, []
    with np.errstate(over="ignore"):
        for at in places.T:
            h = (node ^ (node >> np.uint64(31))) * _MIX + (at.astype(np.uint64) << np.uint64(32)) + tokens[rows, at]
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            out.append((h ^ (h >> np.uint64(27))).view(np.int64))
    return np.stack(out, axis=1)


def _below(node: np.ndarray, choices: int) -> np.ndarray:
    """The coordinates (rows × choices) that nodes below the root choose, by a hash of the node."""
    with np.errstate(over="ignore"):
        first = (node * _MIX) >> np.uint64(33)
    return ((first[:, None] + np.arange(choices, dtype=np.uint64) * np.uint64(SIGNATURE // choices)) % np.uint64(SIGNATURE)).astype(np.int64)


def _children(choices: int):
    """Rows (class, node, bits) to (class, node) of the chosen children; a node's name is a hash of its tree and path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bits = _unpacked(np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, SIGNATURE // 2)).astype(np.uint64)
                node = batch.column(1).to_numpy().view(np.uint64)
                out = _chosen(node, bits, _below(node, choices))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), choices)), pa.array(out.ravel())], names=["class", "node"])

    return run


def _roots(trees: int, seed: int) -> list[int]:
    rng = np.random.default_rng(seed + 1)
    return [int(x) for x in rng.integers(-(1 << 62), 1 << 62, trees)]


def _places(trees: int, seed: int) -> np.ndarray:
    """The roots' coordinates (trees × 2), each of them one tree's alone."""
    return np.random.default_rng(seed + 2).permutation(SIGNATURE)[: 2 * trees].reshape(trees, 2)


def _close(threshold: float):
    """The least number of equal minwise tokens of a pair that is compared exactly."""
    least = SIGNATURE * threshold - SLACK * math.sqrt(SIGNATURE * threshold * (1 - threshold))
    return max(1, math.floor(least))


def _members(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lists' offsets, and the classes, sizes and bits of all their members."""
    flat = column.flatten()
    bits = flat.field("bits")
    raw = np.frombuffer(bits.buffers()[2], np.uint8) if len(flat) else np.zeros(0, np.uint8)
    start = int(np.frombuffer(bits.buffers()[1], np.int32)[bits.offset]) if len(flat) else 0
    lengths = np.diff(column.offsets.to_numpy())
    return (
        np.concatenate(([0], np.cumsum(lengths))),
        flat.field("class").to_numpy(zero_copy_only=False),
        flat.field("size").to_numpy(zero_copy_only=False).astype(np.float64),
        _unpacked(raw[start : start + len(flat) * (SIGNATURE // 2)].reshape(-1, SIGNATURE // 2)),
    )


def _compare(threshold: float):
    """Rows (left, right), lists of classes with size and bits, to the pairs that may be close.

    A null right side means all pairs within the left.
    """
    least = _close(threshold)

    def close(a, b, ia: np.ndarray, ib: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ca, sa, ga = a
        cb, sb, gb = b
        ok = (np.minimum(sa[ia], sb[ib]) >= threshold * np.maximum(sa[ia], sb[ib])) & (ca[ia] != cb[ib])
        ia, ib = ia[ok], ib[ok]
        keep = [np.zeros(0, np.int64)]
        for k in range(0, len(ia), 100_000):
            keep.append(np.flatnonzero((ga[ia[k : k + 100_000]] == gb[ib[k : k + 100_000]]).sum(axis=1) >= least) + k)
        at = np.concatenate(keep)
        x, y = ca[ia[at]], cb[ib[at]]
        return np.minimum(x, y), np.maximum(x, y)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, *a = _members(batch.column(0))
            lo, hi = [], []
            crossed = np.flatnonzero(batch.column(1).is_valid().to_numpy(zero_copy_only=False))
            alone = np.setdiff1d(np.arange(batch.num_rows), crossed)
            sizes = np.diff(left)
            for n in np.unique(sizes[alone]):
                i, j = np.triu_indices(n, 1)
                starts = left[alone[sizes[alone] == n]]
                # All pairs of the groups of one size, some groups at a time.
                step = max(1, 1_000_000 // max(1, len(i)))
                for k in range(0, len(starts), step):
                    base = starts[k : k + step, None]
                    pair = close(a, a, (base + i).ravel(), (base + j).ravel())
                    lo.append(pair[0])
                    hi.append(pair[1])
            if len(crossed):
                right, *b = _members(batch.column(1))
                for k in crossed:
                    i, j = np.meshgrid(np.arange(left[k], left[k + 1]), np.arange(right[k], right[k + 1]), indexing="ij")
                    pair = close(a, b, i.ravel(), j.ravel())
                    lo.append(pair[0])
                    hi.append(pair[1])
            none = [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lo or none)), pa.array(np.concatenate(hi or none))], names=["class_a", "class_b"])

    return run


def candidates(classes: DataFrame, threshold: float, choices: int) -> DataFrame:
    """(class_a, class_b): distinct pairs of classes (class, size, nodes, bits) that may be close."""
    compare, member = _compare(threshold), F.struct("class", "size", "bits")
    narrow = classes.select("class", "size", "bits")
    rows = classes.select("class", F.explode("nodes").alias("node"))
    found = []
    for level in range(LEVELS + 1):
        counts = stage(rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), f"nodes-{level}")
        # Only classes that share a node with another are looked at further.
        shared = stage(rows.join(counts, "node"), f"paths-{level}")
        small = shared.where(F.col("n") <= NODE).select("node", "class").join(narrow, "class")
        groups = small.groupBy("node").agg(F.collect_list(member).alias("left")).select("left", F.lit(None).cast("array<struct<class:bigint,size:int,bits:binary>>").alias("right"))
        found.append(groups.transform(mapped, compare, "class_a bigint, class_b bigint"))
        large = shared.where(F.col("n") > NODE)
        if large.isEmpty():
            break
        # Below the root a pair must go on sharing choices, so one more is taken for the same recall.
        if level < LEVELS:
            rows = stage(large.join(narrow, "class").select("class", "node", "bits").transform(mapped, _children(choices + 1), "class bigint, node bigint"), f"children-{level}")
            continue
        # Blocks of a node: every pair of blocks is a group of two bounded lists.
        blocks = F.ceil(F.col("n") / NODE).cast("int")
        spread = large.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        paired = spread.withColumn("other", other).join(narrow, "class")
        paired = paired.groupBy("node", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).agg(
            F.collect_list(F.when(F.col("block") <= F.col("other"), member)).alias("left"),
            F.when(F.col("i") < F.col("j"), F.collect_list(F.when(F.col("block") > F.col("other"), member))).alias("right"),
        )
        found.append(paired.select("left", "right").transform(mapped, compare, "class_a bigint, class_b bigint"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionAll(more)
    return pairs.distinct()


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, n).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["class", "items"])

    return run


def _exact(threshold: float):
    """Rows (class_a, class_b, a, b) to those whose sets are alike enough, with shared and all items."""
    top, bottom = threshold.as_integer_ratio() if threshold in (0.5, 0.25, 0.75) else (round(threshold * 10_000), 10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, shared, total = [], [], []
            for k, (a, b) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                both = np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)])
                both.sort()
                same = int((both[1:] == both[:-1]).sum())
                if bottom * same >= top * (len(both) - same):
                    keep.append(k)
                    shared.append(same)
                    total.append(len(both) - same)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(shared, pa.int32()), pa.array(total, pa.int32())], names=["class_a", "class_b", "shared", "total"])

    return run


class Similar:
    """The result of a similarity join: classes of equal sets, their members, and the links between classes."""

    def __init__(self, members: DataFrame, links: DataFrame):
        #: (rec_id, class, first): every record with enough words; first is the least rec_id of its class.
        self.members = members
        #: (class_a, class_b, shared, total): classes alike at the threshold or more; class_a < class_b.
        self.links = links

    def pairs(self) -> DataFrame:
        """(rec_a, rec_b), rec_a < rec_b: all pairs of records alike, copies written out."""
        a = self.members.select(F.col("rec_id").alias("rec_a"), F.col("class").alias("class_a"))
        b = self.members.select(F.col("rec_id").alias("rec_b"), F.col("class").alias("class_b"))
        across = self.links.select("class_a", "class_b").join(a, "class_a").join(b, "class_b").select("rec_a", "rec_b")
        twice = self.members.groupBy("class").agg(F.count("*").alias("n")).where("n > 1").select("class")
        within = a.join(twice.withColumnRenamed("class", "class_a"), "class_a", "left_semi").join(b.withColumnRenamed("class_b", "class_a"), "class_a").where("rec_a < rec_b").select("rec_a", "rec_b")
        return across.select(F.least("rec_a", "rec_b").alias("rec_a"), F.greatest("rec_a", "rec_b").alias("rec_b")).unionAll(within)

    def classes(self) -> DataFrame:
        """(rec_id, class_id, copies, links): one row for each record; class_id is the least rec_id of equal sets."""
        size = self.members.groupBy("class").agg(F.count("*").alias("copies"))
        ends = self.links.select(F.explode(F.array("class_a", "class_b")).alias("class")).groupBy("class").agg(F.count("*").alias("links"))
        return self.members.join(size, "class").join(ends, "class", "left").select("rec_id", F.col("first").alias("class_id"), "copies", F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))

    def groups(self) -> DataFrame:
        """(rec_id, group_id): one row for each record; records linked directly or through others have one group, named by its least rec_id."""
        names = self.members.select("class", "first").distinct()
        a, b = (names.select(F.col("class").alias(f"class_{k}"), F.col("first").alias(k)) for k in "ab")
        edges = self.links.select("class_a", "class_b").join(a, "class_a").join(b, "class_b").select("a", "b")
        least = components(edges).withColumnRenamed("node", "first")
        return self.members.join(least, "first", "left").select("rec_id", F.coalesce("component", "first").alias("group_id"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes in edges (a, b): the least node that each is connected with.

    Large and small stars by turns: every node's neighbours above it, then it and its neighbours below it, are linked to
    the least one, until nothing changes, in about log² of the longest path rounds. Minima are
    aggregated map-side and hot nodes looked up salted; each round's edges are written. Null ends are left out.
    """
    links = stage(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = lookup(both.where("b > a"), stage(least, "least"), "a", "inner").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.where("a <> b").distinct(), "large-stars")
        below = stage(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        stars = lookup(large, below, "a", "inner").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(below.select("a", F.col("m").alias("b")))
        stars = stage(stars.distinct(), "small-stars")
        if stars.count() == links.count() and stars.exceptAll(links).isEmpty():
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        links = stars


def similar(df: DataFrame, threshold: float = 0.8, words: int = 5, recall: float = 0.9999, seed: int = 11) -> Similar:
    """The near-duplicates among records (rec_id, text); other columns are ignored.

    Sets of runs of `words` words are compared by intersection ÷ union. Null texts and those of
    fewer words are in no pair. Records with equal rec_ids must have equal texts. No limit on
    copies, partners or sizes of groups; pairs at the threshold are found with probability
    `recall` or more, the levels below the roots and the comparison by signature counted in, others
    with higher, and every pair is checked exactly.
    """
    records = df.select("rec_id", "text")
    choices = math.ceil(1 / threshold)
    base = stage(sketches(records, words, seed, trees_for(threshold, choices, recall)), "sketches")
    classes = stage(base.groupBy("class").agg(F.min("rec_id").alias("first"), F.first("size").alias("size"), F.first("nodes").alias("nodes"), F.first("bits").alias("bits")), "classes")
    pairs = stage(candidates(classes.select("class", "size", "nodes", "bits"), threshold, choices), "candidates")
    wanted = pairs.select(F.explode(F.array("class_a", "class_b")).alias("class")).distinct().join(classes.select("class", "first"), "class")
    texts = records.withColumnRenamed("rec_id", "first").join(wanted, "first").dropDuplicates(["class"]).select("class", "text")
    sets = stage(texts.transform(mapped, _sets(words), "class bigint, items binary"), "sets")
    both = pairs.join(sets.withColumnsRenamed({"class": "class_a", "items": "a"}), "class_a").join(sets.withColumnsRenamed({"class": "class_b", "items": "b"}), "class_b")
    links = both.select("class_a", "class_b", "a", "b").transform(mapped, _exact(threshold), "class_a bigint, class_b bigint, shared int, total int")
    members = base.select("rec_id", "class").join(classes.select("class", "first"), "class")
    return Similar(members, links)


def corpus(spark: SparkSession, directory: str) -> DataFrame:
    """The records of fineweb2_it and wikipedia_it together."""
    return table(spark, directory, "fineweb2_it").select("rec_id", "text").unionAll(table(spark, directory, "wikipedia_it").select("rec_id", "text"))


def p6_found(spark: SparkSession, directory: str) -> DataFrame:
    """All pairs of records of both tables alike at 0.6 or more in runs of three words."""
    return similar(corpus(spark, directory), 0.6, 3).pairs().distinct()


def p6_classes(spark: SparkSession, directory: str) -> DataFrame:
    """Every record of both tables with its class of equal texts and the number of classes near it (0.8, five words)."""
    return similar(corpus(spark, directory)).classes()


def p6_groups(spark: SparkSession, directory: str) -> DataFrame:
    """Every record of both tables with its group: records linked at 0.6 or more in runs of three words, directly or through others."""
    return similar(corpus(spark, directory), 0.6, 3).groups()

"""Reading level of documents from the surprisal of graded n-gram models.

Each level of the graded samples has an interpolated word trigram model. For every bound between
two levels, a token's lead is how much more surprising it is to the models up to the bound than to those
above it, and a document has the distribution of its tokens' leads: their mean and three points of it. A
combination of these that can only rise with each of them, fitted on graded documents, and isotonic regression on
the same map the distribution monotonically to the probability of lying above the bound.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramoggia.llm.answers import language_scores
from tramoggia.operators.joins import lookup
from tramoggia.session import mapped, table

LEVELS = 5
#: Weights of trigrams, bigrams, unigrams, and the uniform rest.
WEIGHTS = (0.45, 0.3, 0.2, 0.05)
#: Graded documents used for the regression, a bounded sample by hash of the id.
GRADED = 4_000
#: Parts of the samples that are left out in turn.
FOLDS = 5
#: Texts are scored together until they have so many characters.
CHARS_AT_ONCE = 2_000_000
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[.,;:!?]")
_ROLE = re.compile(r"<\|[a-z]+\|>")


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower() if "<|" not in text else _ROLE.sub(" ", text.lower()))


class Graded:
    """The models of all levels as three sorted tables, of n-grams seen at any level × levels."""

    def __init__(self, vocabulary: dict[str, int], tables: list[tuple[np.ndarray, np.ndarray]], rest: float):
        self.vocabulary, self.tables, self.rest = vocabulary, tables, rest

    @classmethod
    def fit(cls, samples: list[tuple[int, str]]) -> Graded:
        """From (level, text) rows; words seen once in all samples, names mostly, are unknown words."""
        texts = [(level, tokens(t)) for level, t in samples if t and level is not None and 1 <= level <= LEVELS]
        seen = Counter(w for _, t in texts for w in t)
        vocabulary = {w: k + 1 for k, w in enumerate(sorted(w for w, n in seen.items() if n > 1))}
        base = len(vocabulary) + 2
        counts: list[list[Counter]] = [[Counter() for _ in range(LEVELS)] for _ in range(3)]
        before: list[list[Counter]] = [[Counter() for _ in range(LEVELS)] for _ in range(3)]
        for level, words in texts:
            ids = cls._ids(words, vocabulary)
            start = base - 1  # stands before a text
            u = v = start
            for w in ids.tolist():
                for n, (history, key) in enumerate(((0, w), (v, v * base + w), (u * base + v, (u * base + v) * base + w))):
                    counts[n][level - 1][key] += 1
                    before[n][level - 1][history] += 1
                u, v = v, w
        tables = []
        for n in range(3):
            keys = np.array(sorted(set().union(*counts[n])), np.int64)
            values = np.zeros((len(keys) + 1, LEVELS), np.float32)
            for level in range(LEVELS):
                c, h = counts[n][level], before[n][level]
                total = {k: h[0 if n == 0 else k // base] for k in c}
                values[: len(keys), level] = [WEIGHTS[2 - n] * c[k] / total[k] if k in c else 0.0 for k in keys.tolist()]
            tables.append((keys, values))
        return cls(vocabulary, tables, WEIGHTS[3] / base)

    @staticmethod
    def _ids(words: list[str], vocabulary: dict[str, int]) -> np.ndarray:
        get = vocabulary.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def probabilities(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of the texts, and tokens × levels probabilities given the two tokens before."""
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        w = self._ids([x for t in texts for x in t], self.vocabulary)
        base = len(self.vocabulary) + 2
        v, u = np.empty_like(w), np.empty_like(w)
        v[1:], u[2:] = w[:-1], w[:-2]
        starts = offsets[:-1][np.diff(offsets) > 0]
        v[starts] = base - 1
        u[starts] = base - 1
        second = starts + 1
        u[second[np.isin(second, starts, invert=True) & (second < len(w))]] = base - 1
        out = np.full((len(w), LEVELS), self.rest, np.float32)
        for (keys, values), key in zip(self.tables, (w, v * base + w, (u * base + v) * base + w)):
            if len(keys):
                at = np.searchsorted(keys, key)
                at[at == len(keys)] = 0
                out += values[np.where(keys[at] == key, at, len(keys))]
        return offsets, out

    def measures(self, texts: list[list[str]]) -> np.ndarray:
        """texts × (for each of the bounds mean and 10, 50, 90 % points of the tokens' leads, then the same of the surprisal), in bits."""
        offsets, p = self.probabilities(texts)
        out = np.full((len(texts), 4 * LEVELS), np.nan)
        full = np.diff(offsets) > 0
        if not full.any():
            return out
        sums = np.cumsum(p, axis=1)
        total = sums[:, -1]
        bound = np.arange(1, LEVELS)
        low = sums[:, :-1] / bound
        high = (total[:, None] - sums[:, :-1]) / (LEVELS - bound)
        lead = np.log2(high) - np.log2(low)
        sizes = np.diff(offsets)[full]
        each = np.concatenate([lead, -np.log2(total / LEVELS)[:, None]], axis=1)
        made = np.empty((len(sizes), LEVELS, 4))
        made[:, :, 0] = np.add.reduceat(each, offsets[:-1][full], axis=0) / sizes[:, None]
        for row, k in enumerate(np.flatnonzero(full)):
            part = np.sort(each[offsets[k] : offsets[k + 1]], axis=0)
            made[row, :, 1:] = part[[len(part) // 10, len(part) // 2, len(part) * 9 // 10]].T
        out[full] = made.reshape(len(sizes), -1)
        return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing function of least squares, by pooling adjacent violators, as knots (place, value):
    the two ends of each pool, between which it is flat; it is straight from a pool to the next."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # value, weight, first, last
    for at, value in zip(x[order].tolist(), y[order].tolist()):
        pools.append([value, 1.0, at, at])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v, w, _, last = pools.pop()
            pools[-1][0] = (pools[-1][0] * pools[-1][1] + v * w) / (pools[-1][1] + w)
            pools[-1][1] += w
            pools[-1][3] = last
    return np.array([e for p in pools for e in p[2:]]), np.array([p[0] for p in pools for _ in range(2)])


def step(x: np.ndarray, knots: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The function of `isotonic` at x; the outer values beyond its ends, 0.5 without any knot."""
    places, values = knots
    return np.interp(x, places, values) if len(places) else np.full(len(x), 0.5)


def rising(x: np.ndarray, y: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Weights of the columns of x, none negative, whose sum fits y best (least squares by coordinate descent); the first column alone where none helps."""
    weights = np.zeros(x.shape[1])
    scale = x.std(axis=0) if len(x) else np.ones(x.shape[1])
    scale[scale == 0] = np.inf
    z, rest = (x - x.mean(axis=0)) / scale if len(x) else x, y - y.mean() if len(y) else y
    norms = (z * z).sum(axis=0)
    for _ in range(rounds):
        for k in np.flatnonzero(norms):
            new = max(0.0, weights[k] + z[:, k] @ rest / norms[k])
            rest = rest - (new - weights[k]) * z[:, k]
            weights[k] = new
    return weights / scale if weights.any() else np.eye(1, x.shape[1])[0]


_POINTS = ("", "_10", "_50", "_90")
_MEASURES = [f"above_{k}{p}" for k in range(1, LEVELS) for p in _POINTS] + ["mean_bits", "bits_10", "bits_50", "bits_90"]


def measured(df: DataFrame, model: Graded, *keep: str, text: str = "text") -> DataFrame:
    """The columns `keep`, the measures of each whole text (null for null, empty and blank ones) and whether
    its function words are Italian."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # the samples' n-grams: a fixed table of some 100 kB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graded = sent.value
        for batch in batches:
            rows, words, chars, parts, italian = batch.column(batch.num_columns - 1).to_pylist(), [], 0, [], []
            for t in rows:
                found = tokens(t) if t else []
                scores = language_scores(found)
                italian.append(bool(scores) and scores["it"] >= max(scores.values()))
                words.append(found)
                chars += len(t or "")
                if chars > CHARS_AT_ONCE:
                    parts.append(graded.measures(words))
                    words, chars = [], 0
            parts.append(graded.measures(words))
            values = np.concatenate(parts)
            columns = [pa.array(values[:, k], pa.float64(), mask=np.isnan(values[:, k])) for k in range(values.shape[1])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns, pa.array(italian, pa.bool_())], names=[*keep, *_MEASURES, "italian"])

    kinds = [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep] + [f"{m} double" for m in _MEASURES] + ["italian boolean"]
    return df.select(*[F.col(k) for k in keep], F.col(text)).transform(mapped, run, ", ".join(kinds))


def grades(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): the median of a document's distinct annotations; null levels count for nothing."""
    once = labels.where("level is not null and doc_id is not null").select("doc_id", "annotator", "level").distinct()
    return once.groupBy("doc_id").agg(F.median("level").alias("grade"))


class Scale:
    """Models and regressions: from texts to levels."""

    def __init__(self, model: Graded | None, weights: list[np.ndarray], steps: list[tuple[np.ndarray, np.ndarray]]):
        self.model, self.weights, self.steps = model, weights, steps

    def expected(self, leads: np.ndarray) -> np.ndarray:
        """The expected levels of texts × (bounds × points) leads."""
        each = leads.reshape(len(leads), LEVELS - 1, len(_POINTS))
        return 1 + sum(step(each[:, k] @ w, s) for k, (w, s) in enumerate(zip(self.weights, self.steps)))

    @classmethod
    def fit(cls, samples: DataFrame, documents: DataFrame, labels: DataFrame) -> Scale:
        """From graded samples (level, text) and graded documents; the samples alone where no document is graded."""
        rows = [(r.level, r.text) for r in samples.select("level", "text").orderBy("level", "text").collect()]  # a fixed reference table
        model = Graded.fit(rows)
        graded = grades(labels)
        n = graded.count()
        if n > GRADED:
            graded = graded.where(F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(1_000_000)) < int(1_000_000 * GRADED / n))
        texts = lookup(documents.select("doc_id", "text"), graded, "doc_id", "inner")
        found = measured(texts, model, "grade").where("above_1 is not null").collect()
        leads = _MEASURES[: len(_POINTS) * (LEVELS - 1)]
        x = np.array([[r[m] for m in leads] for r in found] or np.zeros((0, len(leads))))
        y = np.array([r.grade for r in found])
        # Samples are scored by models of the other samples, else they would seem easier than new texts of their level.
        for fold in range(FOLDS):
            held = [(g, t) for k, (g, t) in enumerate(rows) if k % FOLDS == fold and t]
            other = Graded.fit([row for k, row in enumerate(rows) if k % FOLDS != fold])
            if held:
                x = np.concatenate([x, other.measures([tokens(t) for _, t in held])[:, : len(leads)]])
                y = np.concatenate([y, [g for g, _ in held]])
        each = x.reshape(len(x), LEVELS - 1, len(_POINTS))
        # A grade on a bound counts as half above it.
        above = [np.where(y > k + 0.5, 1.0, np.where(y == k + 0.5, 0.5, 0.0)) for k in range(1, LEVELS)]
        weights = [rising(each[:, k], above[k]) for k in range(LEVELS - 1)]
        return cls(model, weights, [isotonic(each[:, k] @ weights[k], above[k]) for k in range(LEVELS - 1)])

    def levels(self, df: DataFrame, *keep: str, text: str = "text") -> DataFrame:
        """The columns `keep`, level (1 easiest … 5), difficulty (its expectation), the surprisal's distribution
        and whether the text is Italian; level and measures are null for texts without words."""
        scored = measured(df, self.model, *keep, text=text)
        scale, leads = Scale(None, self.weights, self.steps), _MEASURES[: len(_POINTS) * (LEVELS - 1)]

        @F.pandas_udf("double")
        def expected(*columns):
            import pandas as pd

            values = np.stack([np.asarray(v, float) for v in columns], axis=1)
            return pd.Series(np.where(np.isnan(values).any(axis=1), np.nan, scale.expected(np.nan_to_num(values))))

        raw = expected(*[F.col(m) for m in leads])
        difficulty = F.when(F.col("above_1").isNotNull(), raw)
        return scored.withColumn("difficulty", difficulty).withColumn("level", F.round("difficulty").cast("int"))


def scale_for(spark: SparkSession, directory: str) -> Scale:
    return Scale.fit(*[table(spark, directory, t) for t in ("reading_samples", "documents", "reading_labels")])


def p9_levels(spark: SparkSession, directory: str) -> DataFrame:
    """The reading level of every document."""
    return scale_for(spark, directory).levels(table(spark, directory, "documents"), "doc_id").select("doc_id", "level", "difficulty", "mean_bits", "bits_10", "bits_50", "bits_90", "italian")


def p9_found(spark: SparkSession, directory: str) -> DataFrame:
    """The Italian documents at level 5."""
    return p9_levels(spark, directory).where("level = 5 and italian").select("doc_id").distinct()

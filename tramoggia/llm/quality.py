"""Statistics of the text quality of each document, and the records that are no prose.

Prose is a body of which lines of prose, each counted once, make up more than a third, and that doesn't repeat
itself: neither its lines and paragraphs nor the n-grams that cover most of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramoggia.llm import furniture as fu
from tramoggia.llm.answers import FUNCTION_WORDS
from tramoggia.llm.boilerplate import taken_away, with_furniture
from tramoggia.session import mapped, table

COMMON = frozenset(w for words in FUNCTION_WORDS.values() for w in words.split())
#: A line is prose from this share of common words, and this many words.
COMMON_SHARE, PROSE_WORDS = 0.2, 5
#: A record whose main body has less than this share of prose is no prose.
PROSE_SHARE = 0.36
#: n-grams of words of these lengths are looked at for repetition.
NGRAMS = (2, 3, 4)
#: A text repeats itself if more than these shares of its characters are covered by its most frequent n-gram of each length ...
TOP_COVERAGE = (0.20, 0.18, 0.16)
#: ... or if more than this share of its lines, or of its paragraphs, repeats an earlier one.
DUPLICATES = 0.3

COLUMNS = {
    "n_chars": pa.int64(), "n_lines": pa.int64(), "n_words": pa.int64(), "mean_word_length": pa.float64(), "symbol_ratio": pa.float64(), "digit_ratio": pa.float64(),
    "punctuated_lines": pa.float64(), "common_words": pa.float64(), "duplicate_lines": pa.float64(), "duplicate_paragraphs": pa.float64(),
    "top_2gram": pa.float64(), "top_3gram": pa.float64(), "top_4gram": pa.float64(), "listed_lines": pa.float64(), "body_chars": pa.int64(), "prose_chars": pa.int64(), "prose_share": pa.float64(), "kind": pa.string(),
}
_WORD = re.compile(r"[^\W\d_]+")
_BLANK_LINES = re.compile(r"\n[^\S\n]*\n\s*")


class _Ids(dict):
    """Words to small numbers, emptied before it grows large (between documents only), and the words' lengths by number."""

    def __init__(self):
        super().__init__()
        self.sizes = np.zeros(1 << 16, np.int64)

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self) + 1
        if n >= len(self.sizes):
            self.sizes = np.concatenate([self.sizes, np.zeros(len(self.sizes), np.int64)])
        self.sizes[n] = len(word)
        return n


_IDS = _Ids()


def repeated_share(items: list[str]) -> float:
    """The share of items that repeat an earlier one."""
    return 1 - len(set(items)) / len(items) if items else 0.0


def top_ngrams(words: list[str]) -> list[float]:
    """For each n, the share of the words' characters that the most frequent n-gram covers (0 if none repeats)."""
    if len(words) < 3:
        return [0.0] * len(NGRAMS)
    if len(_IDS) > 1_000_000:
        _IDS.clear()
    ids = np.fromiter(map(_IDS.__getitem__, words), np.int64, len(words))
    sizes = _IDS.sizes[ids]
    total, out = max(1, int(sizes.sum())), []
    for n in NGRAMS:
        if len(ids) < n + 1:
            out.append(0.0)
            continue
        key = ids[: len(ids) - n + 1].copy()
        for k in range(1, n):
            key = key * 1_000_003 + ids[k : len(ids) - n + 1 + k]
        ordered = np.sort(key)
        edges = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1], [True])))
        counts = np.diff(edges)
        most = int(counts.argmax())
        if counts[most] < 2:
            out.append(0.0)
            continue
        at = int(np.flatnonzero(key == ordered[edges[most]])[0])
        out.append(min(1.0, float(counts[most]) * float(sizes[at : at + n].sum()) / total))
    return out


def common_in(words: list[str]) -> int:
    return sum(map(COMMON.__contains__, words))


def prose_line(plain: str, bits: int, words: list[str], common: int | None = None) -> bool:
    """Whether a line is running prose of any language: enough words, common ones among them, and a
    sentence's end or a paragraph's length; entries of numbered lists and tables aren't."""
    n = len(words)
    if n < PROSE_WORDS:
        return False
    if bits & fu.LISTED and not plain.startswith(("-", "–", "—")):
        return False
    if n < 15 and not fu.ends_sentence(plain) or n < 10 and 4 * plain.count(",") >= n:
        return False
    if (common_in(words) if common is None else common) < COMMON_SHARE * n:
        return False
    return fu.digits_in(plain) <= 0.15 * len(plain)


def statistics(text: str, gone: list[int] | None = None) -> tuple:
    """The values of COLUMNS for a text with anything but white space; `gone` as in `taken_away`."""
    lines, bits, plains, numbers = [], [], [], []
    for number, line in enumerate(text.split("\n"), 1):
        stripped = line.strip()
        if stripped:
            plain, mark = fu.marks(line)
            lines.append(stripped)
            bits.append(mark)
            plains.append(plain)
            numbers.append(number)
    words: list[str] = []
    seen: set[str] = set()
    body = prose = listed = ended = common = 0
    for line, plain, mark, away in zip(lines, plains, bits, taken_away(bits, plains, numbers, gone)):
        found = _WORD.findall(plain.lower())
        words += found
        known = common_in(found)
        common += known
        ended += line[-1] in ".!?…"
        listed += bool(mark & fu.LISTED)
        if not away and plain:
            body += len(plain)
            # Only its first time a line is prose.
            if plain not in seen and prose_line(plain, mark, found, known):
                prose += len(plain)
            seen.add(plain)
    n, size = len(words), len(text)
    letters = sum(map(len, words))
    digits = fu.digits_in(text)
    spaces = len(text) - len("".join(text.split()))
    symbols = max(0, size - letters - digits - spaces)
    paragraphs = [p for p in _BLANK_LINES.split(text.strip()) if p.strip()]
    duplicate, again, top = repeated_share(lines), repeated_share(paragraphs), top_ngrams(words)
    share = prose / body if body else 0.0
    listed_share = listed / len(lines)
    repeats = duplicate > DUPLICATES or again > DUPLICATES or any(t > most for t, most in zip(top, TOP_COVERAGE))
    if not body:
        kind = "no body"
    elif share >= PROSE_SHARE and not repeats:
        kind = "prose"
    elif common < 0.02 * n or n * 4 < size * 0.2:
        kind = "junk"
    elif listed_share >= 0.3 or digits > 0.08 * size or ended < 0.3 * len(lines):
        kind = "list or table"
    else:
        kind = "junk"
    return (
        size, len(lines), n, letters / n if n else 0.0, symbols / size, digits / size, ended / len(lines), common / n if n else 0.0,
        duplicate, again, *top, listed_share, body, prose, share, kind,
    )


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, gone = (batch.column(batch.num_columns - k).to_pylist() for k in (2, 1))
        rows = [statistics(t, g) if t and not t.isspace() else (None,) * len(COLUMNS) for t, g in zip(texts, gone)]
        columns = list(zip(*rows)) if rows else [()] * len(COLUMNS)
        arrays = [pa.array(c, kind) for c, kind in zip(columns, COLUMNS.values())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *arrays], names=[*batch.schema.names[:-2], *COLUMNS])


def quality(df: DataFrame, *keep: str, text: str = "text", gone: str | None = None) -> DataFrame:
    """The columns `keep` and the statistics of each row's whole text; null for null and blank texts.

    No row is dropped and nothing is shuffled; other columns are ignored, `keep` must not clash with
    the names of COLUMNS. Ratios are of characters or lines; `kind` is prose, list or table, junk,
    or no body, by the share of prose lines in what isn't page furniture and by repetition. `gone` names a column with
    the numbers of each text's furniture lines; where it is null (or not given) phrases alone tell them.
    """
    spark_type = {pa.int64(): "bigint", pa.float64(): "double", pa.string(): "string"}
    kinds = [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep] + [f"{c} {spark_type[k]}" for c, k in COLUMNS.items()]
    lines = F.col(gone) if gone else F.lit(None)
    return df.select(*[F.col(k) for k in keep], F.col(text), lines.cast("array<bigint>").alias("_gone")).transform(mapped, _run, ", ".join(kinds))


def records(spark: SparkSession, directory: str) -> DataFrame:
    """(source, rec_id, text, gone) of fineweb2_it, less its sites' furniture, and wikipedia_it, which has no sites."""
    web = with_furniture(table(spark, directory, "fineweb2_it").select("rec_id", "site", "text"))
    wiki = table(spark, directory, "wikipedia_it").withColumn("gone", F.lit(None).cast("array<bigint>"))
    parts = [df.select(F.lit(t).alias("source"), "rec_id", "text", "gone") for t, df in (("fineweb2_it", web), ("wikipedia_it", wiki))]
    return parts[0].unionAll(parts[1])


def p2_found(spark: SparkSession, directory: str) -> DataFrame:
    """The records with non-blank text that are lists, tables or junk, or have no main body."""
    return quality(records(spark, directory), "source", "rec_id", gone="gone").where("kind <> 'prose'").select("source", "rec_id").distinct()


def p2_statistics(spark: SparkSession, directory: str) -> DataFrame:
    """The statistics of every record of both tables."""
    return quality(records(spark, directory), "source", "rec_id", gone="gone")


__all__ = ["COLUMNS", "p2_found", "p2_statistics", "quality", "statistics"]

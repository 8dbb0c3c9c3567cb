"""Encoding and decoding of whole corpora with public tokenizers over Arrow batches."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramoggia.session import mapped, table

#: Where the public tokenizers lie; every operator takes another place as a parameter.
TOKENIZERS = os.environ.get("TRAMOGGIA_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k"
#: Texts given to the tokenizer at once end at about so many characters, which bounds a worker's memory.
CHARS_AT_ONCE = 1_000_000
# Fixed value: the split pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves; the others, in order, for the characters from 256.
    """
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def tokenizer_json(vocabulary: str = VOCABULARY, place: str = TOKENIZERS) -> str:
    """The definition of a tokenizer, read on the driver; it is of 2 MB at most and goes along with the tasks."""
    with open(os.path.join(place, f"{vocabulary}.json"), encoding="utf-8") as f:
        return f.read()


_LOADED: dict[int, object] = {}


def _load(definition: str):
    key = hash(definition)
    if key not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(definition)
        t.encode_special_tokens = True
        _LOADED[key] = t
    return _LOADED[key]


def _portions(texts: list[str | None]) -> Iterator[list[str]]:
    """The texts, null as empty, in portions of a bounded size (one text at least)."""
    portion, chars = [], 0
    for t in texts:
        t = t or ""
        if portion and chars + len(t) > CHARS_AT_ONCE:
            yield portion
            portion, chars = [], 0
        portion.append(t)
        chars += len(t)
    if portion:
        yield portion


def _lists(rows: Iterator[list[int]]) -> pa.Array:
    sizes, flat = [0], []
    for ids in rows:
        flat.append(np.asarray(ids, np.int32))
        sizes.append(sizes[-1] + len(ids))
    values = np.concatenate(flat) if flat else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values, pa.int32()))


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, place: str = TOKENIZERS) -> DataFrame:
    """(key, ids array<int>): each text's ids without special tokens; null and empty texts give an empty list.

    Strings of special tokens in a text are ordinary text. Rows are neither joined nor dropped,
    whatever their key; an empty table gives no rows. No shuffle.
    """
    definition = df.sparkSession.sparkContext.broadcast(tokenizer_json(vocabulary, place))
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _load(definition.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = (e.ids for portion in _portions(texts) for e in t.encode_batch_fast(portion, add_special_tokens=False))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(ids)], names=[key, "ids"])

    return df.select(F.col(key), F.col(text)).transform(mapped, run, f"`{key}` {kind.simpleString()}, ids array<int>")


def character_starts(text: str) -> np.ndarray:
    """For each byte of the text in UTF-8, and its end, the index of the character it belongs to."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    starts = (raw & 0xC0) != 0x80
    return np.concatenate([np.cumsum(starts) - 1, [len(text)]]).astype(np.int32)


def encode_spans(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, place: str = TOKENIZERS) -> DataFrame:
    """(key, ids, byte_start, byte_end, char_start, char_end arrays): ids with the places they come from.

    Bytes are those of the text in UTF-8, ends exclusive. A character split over several tokens
    belongs to each of them. Only for byte-level vocabularies, whose tokens are runs of bytes.
    """
    definition = df.sparkSession.sparkContext.broadcast(tokenizer_json(vocabulary, place))
    names = ["ids", "byte_start", "byte_end", "char_start", "char_end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _load(definition.value)
        width = np.array([len(t.id_to_token(k) or "") for k in range(t.get_vocab_size())], np.int32)
        for batch in batches:
            cols: list[list] = [[] for _ in names]
            for portion in _portions(batch.column(1).to_pylist()):
                for source, e in zip(portion, t.encode_batch_fast(portion, add_special_tokens=False)):
                    ids = np.asarray(e.ids, np.int32)
                    ends = np.cumsum(width[ids]).astype(np.int32)
                    begins = ends - width[ids]
                    chars = character_starts(source)
                    for col, value in zip(cols, (ids, begins, ends, chars[begins], chars[np.maximum(ends - 1, 0)] + 1)):
                        col.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(_lists(c) for c in cols)], names=[key, *names])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key), F.col(text)).transform(mapped, run, f"`{key}` {kind}, " + ", ".join(f"{n} array<int>" for n in names))


def decode(df: DataFrame, key: str = "doc_id", ids: str = "ids", vocabulary: str = VOCABULARY, place: str = TOKENIZERS) -> DataFrame:
    """(key, text): the text of each list of ids of a byte-level vocabulary.

    The bytes of all tokens are joined before they are read as UTF-8, so characters split over
    tokens come out whole; bytes that are no UTF-8 become U+FFFD. A null list gives null, an empty
    one the empty text; ids outside the vocabulary are an error.
    """
    definition = df.sparkSession.sparkContext.broadcast(tokenizer_json(vocabulary, place))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _load(definition.value)
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        special = {k: v.content for k, v in t.get_added_tokens_decoder().items()}
        raw = [special[k].encode() if k in special else bytes(byte_of[c] for c in t.id_to_token(k)) for k in range(t.get_vocab_size())]
        for batch in batches:
            texts = [None if row is None else b"".join([raw[k] for k in row]).decode("utf-8", "replace") for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key), F.col(ids)).transform(mapped, run, f"`{key}` {kind}, text string")


def rank_encoding(lines: bytes):
    """A tiktoken encoding of a vocabulary given as ranks."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, *keep: str, text: str = "text", vocabulary: str = VOCABULARY, place: str = TOKENIZERS) -> DataFrame:
    """The columns `keep` and n_tokens, the number of ids that `encode` gives; null and empty texts have 0.

    Counts come from the same vocabulary as ranks, whose library is about three times as fast.
    """
    with open(os.path.join(place, f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(ranks.value)
        e = _LOADED.setdefault(key, None) or rank_encoding(ranks.value)
        _LOADED[key] = e
        for batch in batches:
            n = [len(e.encode_ordinary(t)) if t else 0 for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64())], names=[*keep, "n_tokens"])

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep)
    return df.select(*[F.col(k) for k in keep], F.col(text)).transform(mapped, run, f"{kinds}, n_tokens bigint")


def p7_ids(spark: SparkSession, directory: str) -> DataFrame:
    """The ids of every document by byte_bpe_50k."""
    return encode(table(spark, directory, "documents"))


def p7_round_trip(spark: SparkSession, directory: str) -> DataFrame:
    """Documents whose decoded ids differ from their text; none, as null and empty texts decode to the empty text."""
    docs = table(spark, directory, "documents")
    back = decode(encode(docs)).withColumnRenamed("text", "decoded")
    same = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(back, "doc_id")
    return same.groupBy((F.col("text") == F.col("decoded")).alias("same")).agg(F.count("*").alias("documents"))

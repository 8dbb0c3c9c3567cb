"""Training examples from token ids: language-model blocks, supervised pairs, chat turns, batches, shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramoggia.functions import samples as sm
from tramoggia.functions.text import bound
from tramoggia.operators.filters import profile_key
from tramoggia.operators.ranking import rank_in_groups, seeded

# Special ids and the label that isn't learned.
BOS, EOS, PAD, IGNORE = 1, 2, 3, -100
MAX_LENGTH, SHARD_ROWS = 2048, 5000
# Source, mode, longest example, fewest tokens, which end of a prompt is kept, chat turns, format written.
TOKENIZING = (
    ("piqa_italian", "sft", 512, 12, "head", None, "choice_qa"),
    ("squad_it", "sft", 1536, 24, "tail", None, "qa"),
    ("evol_instruct_italian", "chat", MAX_LENGTH, 24, "tail", "all", "chat"),
    ("wikipedia_it", "lm", MAX_LENGTH, 64, None, None, "text"),
    ("wikipedia_it_wikimedia_direct", "lm", MAX_LENGTH, 64, None, None, "text"),
    ("fineweb2_it", "lm", MAX_LENGTH, 48, None, None, "text"),
    ("stackexchange_auto", "sft", 1536, 24, "tail", None, "qa"),
    ("local_import", "auto", MAX_LENGTH, 16, "tail", "last", None),
    ("*personality", "chat", 1024, 16, "tail", "all", "chat"),
)
_SPEC = "profile string, mode string, max_length int, min_tokens int, keep string, turns string, out_format string"


def with_token_profile(df: DataFrame) -> DataFrame:
    """`df` (source) with mode, max_length, min_tokens, keep, turns and out_format of its profile or the default."""
    profiles = F.broadcast(df.sparkSession.createDataFrame(list(TOKENIZING), _SPEC))  # nine rows
    joined = df.withColumn("profile", profile_key(F.col("source"))).join(profiles, "profile", "left").drop("profile")
    return joined.withColumns({"mode": F.coalesce("mode", F.lit("auto")), "max_length": F.coalesce("max_length", F.lit(MAX_LENGTH)), "min_tokens": F.coalesce("min_tokens", F.lit(16)), "keep": F.coalesce("keep", F.lit("tail")), "turns": F.coalesce("turns", F.lit("last"))})


def code_points(text: Column) -> Column:
    """A stand-in for a tokenizer whose result SQL can check: the code points, 10 added to keep special ids free."""
    chars = F.filter(F.split(F.coalesce(text, F.lit("")), ""), lambda c: c != "")
    return F.transform(chars, lambda c: (F.ascii(c) + 10).cast("bigint"))


def clamp(ids: Column, budget: Column, keep: Column) -> Column:
    """At most `budget` ids, from the head or the tail; none for a budget below 1."""
    n = F.greatest(budget, F.lit(0)).cast("int")
    tail = F.slice(ids, F.greatest(F.size(ids) - n + 1, F.lit(1)), n)
    return F.when(n == 0, F.array().cast("array<bigint>")).when(keep == "head", F.slice(ids, F.lit(1), n)).otherwise(tail)


def supervised(prompt: Column, completion: Column, longest: Column, keep: Column) -> Column:
    """struct(input_ids, labels): BOS, prompt, completion, EOS; only completion and EOS are learned.

    A completion that leaves no room drops the prompt and is cut itself.
    """
    none = F.array().cast("array<bigint>")
    begin, end = F.array(F.lit(BOS).cast("bigint")), F.array(F.lit(EOS).cast("bigint"))

    def fitted(sides: Column) -> Column:
        asked, given = sides["p"], sides["c"]
        question = F.when(F.size(given) > longest - 2, none).otherwise(clamp(asked, longest - 2 - F.size(given), keep))
        return F.struct(question.alias("q"), F.slice(given, F.lit(1), F.greatest(longest - 2, F.lit(1)).cast("int")).alias("a"))

    def joined(parts: Column) -> Column:
        hidden = F.array_repeat(F.lit(IGNORE).cast("bigint"), F.size(parts["q"]) + 1)
        return F.struct(F.concat(begin, parts["q"], parts["a"], end).alias("input_ids"), F.concat(hidden, parts["a"], end).alias("labels"))

    # Each side is encoded once, however often its ids are named.
    return bound(bound(F.struct(prompt.alias("p"), completion.alias("c")), fitted), joined)


def blocks(ids: Column, longest: Column, stride: Column | None = None) -> Column:
    """The array of a text's blocks, BOS and EOS included, cut every `stride` ids (every block, by default)."""
    framed = F.concat(F.array(F.lit(BOS).cast("bigint")), ids, F.array(F.lit(EOS).cast("bigint")))
    step = stride if stride is not None else longest
    # Encoded once, not once a block.
    return bound(framed, lambda all_: F.transform(F.sequence(F.lit(0), F.size(all_) - 1, step.cast("int")), lambda i: F.slice(all_, i + 1, longest.cast("int"))))


def lm_examples(df: DataFrame, ids: str = "ids", *keep: str) -> DataFrame:
    """(keep…, block, input_ids): blocks of texts of at least min_tokens; needs the columns of `with_token_profile`."""
    cut = df.select(*keep, "min_tokens", F.posexplode(blocks(F.col(ids), F.col("max_length"))).alias("block", "input_ids"))
    return cut.where(F.size("input_ids") >= F.col("min_tokens")).select(*keep, "block", "input_ids")


def chat_prefixes(df: DataFrame, *keep: str) -> DataFrame:
    """(keep…, turn, prompt, completion): one row for each assistant message with something before it; the last
    only, where the profile says so. Needs canonical `messages` and `turns`."""
    made = F.col("messages")
    each = df.where(F.size(made) >= 2).select(*keep, "messages", "turns", F.posexplode(made).alias("turn", "message"))
    each = each.where((F.col("message.role") == "assistant") & (F.col("turn") > 0))
    last = F.size(F.col("messages")) - F.array_position(F.reverse(F.transform("messages", lambda m: m["role"])), F.lit("assistant"))
    each = each.where((F.col("turns") == "all") | (F.col("turn") == last))
    prefix = sm.render_messages(F.slice("messages", F.lit(1), F.col("turn")))
    return each.select(*keep, "turn", prefix.alias("prompt"), sm.tagged("assistant", F.col("message.content")).alias("completion")).where("prompt <> ''")


def training_examples(df: DataFrame, encode=code_points) -> DataFrame:
    """Every training example of canonical samples (rid, source, format, messages, prompt, completion, text).

    Chat samples and chat sources give chat turns, structured ones and supervised sources a pair, the rest
    blocks. Columns: rid, part, input_ids, labels, attention_mask, loss_mode, source, format, tokenization.
    """
    base = with_token_profile(df.withColumns({"format": F.coalesce("format", F.lit("text")), "messages": sm.messages(F.col("messages"))}))
    chat = (F.col("format") == "chat") | (F.col("mode") == "chat")
    pairs = ~chat & (F.col("format").isin(*sm.STRUCTURED) | (F.col("mode") == "sft"))
    common = ("rid", "source", "format", "mode", "max_length", "min_tokens", "keep", "out_format")

    def finished(rows: DataFrame, auto: str, loss: str) -> DataFrame:
        how = F.when(F.col("mode") == "auto", F.lit(auto)).otherwise(F.col("mode"))
        mask = F.transform("input_ids", lambda x: F.lit(1).cast("bigint"))
        return rows.where(F.size("input_ids") >= F.col("min_tokens")).select("rid", "part", "input_ids", "labels", mask.alias("attention_mask"), F.lit(loss).alias("loss_mode"), "source", F.coalesce("out_format", "format").alias("format"), how.alias("tokenization"))

    def learned(rows: DataFrame) -> DataFrame:
        made = supervised(encode(F.col("prompt")), encode(F.concat(F.lit("\n"), F.col("completion"))), F.col("max_length"), F.col("keep"))
        return rows.where("completion <> ''").withColumn("ex", made).select("*", "ex.input_ids", "ex.labels")

    turns = learned(chat_prefixes(base.where(chat), *common).withColumnRenamed("turn", "part"))
    sides = sm.pair(F.col("format"), F.col("messages"), F.col("prompt"), F.col("completion"), F.col("text"))
    paired = learned(base.where(pairs).withColumn("sides", sides).select(*common, F.lit(0).alias("part"), "sides.prompt", "sides.completion"))
    plain = base.where(~chat & ~pairs).withColumn("cut", blocks(encode(sm.tx.whitespace(F.coalesce("text", F.lit("")))), F.col("max_length")))
    text = plain.select(*common, F.posexplode("cut").alias("part", "input_ids")).withColumn("labels", F.col("input_ids"))
    return finished(turns, "chat", "assistant_only").unionByName(finished(paired, "sft", "assistant_only")).unionByName(finished(text, "lm", "full_text"))


def truncated(df: DataFrame, longest: int = 1536, keep: str = "tail") -> DataFrame:
    """The three id columns cut to `longest`; missing labels are the ids, a missing mask is ones."""
    ids = F.coalesce("input_ids", F.array().cast("array<bigint>"))
    full = {"input_ids": ids, "labels": F.coalesce("labels", ids), "attention_mask": F.coalesce("attention_mask", F.transform(ids, lambda x: F.lit(1).cast("bigint")))}
    return df.withColumns({c: clamp(v, F.lit(longest), F.lit(keep)) for c, v in full.items()})


def batched(df: DataFrame, key: str, size: int, seed: int = 42, drop_last: bool = False) -> DataFrame:
    """`df` with batch (number) and slot, in a seeded order of `key` that doesn't depend on partitions."""
    ranked = rank_in_groups(df.withColumn("_all", F.lit(0)), ["_all"], [seeded(seed, key), F.col(key)], "_rank")
    out = ranked.withColumns({"batch": F.floor(F.col("_rank") / size), "slot": (F.col("_rank") % size).cast("int")}).drop("_all", "_rank")
    return out.where(F.col("batch") < df.count() // size) if drop_last else out


def padded(df: DataFrame) -> DataFrame:
    """Batched examples padded on the right to the longest of their batch, with its length and token count."""
    longest = df.groupBy("batch").agg(F.max(F.size("input_ids")).alias("batch_length"), F.sum(F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0)))).alias("batch_tokens"))
    joined = df.join(longest, "batch")
    fill = lambda c, v: F.concat(c, F.array_repeat(F.lit(v).cast("bigint"), F.greatest(F.col("batch_length") - F.size(c), F.lit(0))))
    return joined.withColumns({"input_ids": fill("input_ids", PAD), "labels": fill("labels", IGNORE), "attention_mask": fill("attention_mask", 0)})


def split(df: DataFrame, key: str, ratio: float = 0.02, seed: int = 42) -> DataFrame:
    """`df` with is_validation: exactly ceil(ratio · n) rows, by a seeded order of `key`."""
    rows = df.count()
    ranked = rank_in_groups(df.withColumn("_all", F.lit(0)), ["_all"], [seeded(seed, key), F.col(key)], "_rank")
    return ranked.withColumn("is_validation", F.col("_rank") < -(-rows * round(ratio * 10_000) // 10_000)).drop("_all", "_rank")


def sharded(df: DataFrame, dataset: str, order: list[str], rows: int = SHARD_ROWS) -> DataFrame:
    """`df` with shard (number in its dataset): at most `rows` rows each, by a fixed pseudo-random order."""
    ranked = rank_in_groups(df, [dataset], [seeded(0, *order), *[F.col(c) for c in order]], "_rank")
    return ranked.withColumn("shard_id", F.floor(F.col("_rank") / rows)).drop("_rank")


def manifest(df: DataFrame, dataset: str = "source", form: str = "format", rows: int = SHARD_ROWS) -> DataFrame:
    """(dataset, format, records, dataset_records, shards): counts of examples, and the shards they fill."""
    counts = df.groupBy(F.col(dataset).alias("dataset"), F.col(form).alias("format")).agg(F.count("*").alias("records"))
    totals = counts.groupBy("dataset").agg(F.sum("records").alias("dataset_records"))
    joined = counts.join(totals.withColumnRenamed("dataset", "_d"), F.col("dataset").eqNullSafe(F.col("_d"))).drop("_d")
    return joined.withColumn("shards", F.ceil(F.col("dataset_records") / rows))


def steps(spark: SparkSession, examples: int, batch: int, accumulation: int, epochs: int, most: int = 0) -> DataFrame:
    """(batches, steps): optimiser steps of a run, capped by `most` if that is positive."""
    batches = examples // batch
    total = -(-batches // accumulation) * epochs
    return spark.createDataFrame([(batches, min(total, most) if most > 0 else total)], "batches bigint, steps bigint")

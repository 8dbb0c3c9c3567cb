"""Queries of the corpus pipeline's own operators over whole tables, and the same in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramoggia.functions import samples as sm
from tramoggia.functions import text as tx
from tramoggia.operators import dedup, dialogue, examples, filters, metrics, stages
from tramoggia.session import spread, stage, table
from tramoggia.sources import files, sinks
from tramoggia.streaming import metrics as stream_metrics

# ---- text


def surface_normalize(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", tx.surface(F.col("text")).alias("clean"))


def url_strip(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", tx.without_urls(F.col("text")).alias("clean"))


def separator_strip(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "wikipedia_it").select("rec_id", tx.without_separators(F.col("text")).alias("clean"))


def strip_html(s: SparkSession, d: str) -> DataFrame:
    return spread(table(s, d, "fineweb2_it").select("rec_id", "text")).select("rec_id", tx.without_tags(F.col("text")).alias("clean"))


def web_clean(s: SparkSession, d: str) -> DataFrame:
    return spread(table(s, d, "fineweb2_it").select("rec_id", "text")).select("rec_id", tx.web(F.col("text")).alias("clean"))


def wiki_clean(s: SparkSession, d: str) -> DataFrame:
    return spread(table(s, d, "wikipedia_it").select("rec_id", "text")).select("rec_id", tx.wiki(F.col("text")).alias("clean"))


def dump_clean(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "wikipedia_it").select("rec_id", tx.dump(F.col("text")).alias("clean"))


def quality_ratios(s: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    made = {"symbols": tx.symbol_ratio(t), "letters": tx.alpha_ratio(t), "digits": tx.digit_ratio(t)}
    return table(s, d, "documents").select("doc_id", *[F.round(v, 6).alias(k) for k, v in made.items()], tx.sentence_count(t).alias("sentences"))


# ---- filters


def valid_text(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").select("doc_id", "source", "format", tx.surface(F.coalesce("text", F.lit(""))).alias("text"))
    return filters.with_profile(docs).where(filters.valid(F.col("text"))).select("doc_id")


def low_quality_flags(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").withColumn("format", F.coalesce("format", F.lit("text")))
    return docs.select("doc_id", filters.low_quality(F.coalesce("text", F.lit("")), F.coalesce("source", F.lit("")), F.col("format"), strict=True).alias("low_quality"))


def forum_subject(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").where("source = 'stackexchange_auto'")
    return docs.where(filters.passes_source(F.col("source"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.coalesce("text", F.lit("")))).select("doc_id")


def language_gate(s: SparkSession, d: str) -> DataFrame:
    """Whether a document's language passes: the stated one, and the detected one where the profile asks for it."""
    docs = filters.with_profile(table(s, d, "documents").select("doc_id", "source", "format", "lang", "text"))
    return docs.select("doc_id", filters.language_allowed(F.col("lang"), filters.detected_language(F.coalesce("text", F.lit("")))).alias("allowed"))


def clean_pipeline(s: SparkSession, d: str) -> DataFrame:
    """Cleaned, filtered, first copies only: how many samples of each source and format are left, and their characters."""
    local = table(s, d, "local_import").select("rec_id", "source", "language", "format", "text", "prompt", "completion").withColumn("messages", F.lit(None).cast("array<struct<role:string,content:string>>"))
    web = table(s, d, "fineweb2_it").select("rec_id", "source", "language", "format", "text").withColumns({"prompt": F.lit(None).cast("string"), "completion": F.lit(None).cast("string"), "messages": F.lit(None).cast("array<struct<role:string,content:string>>")})
    wiki = table(s, d, "wikipedia_it").select("rec_id", "source", "language", "format", "text").withColumns({"prompt": F.lit(None).cast("string"), "completion": F.lit(None).cast("string"), "messages": F.lit(None).cast("array<struct<role:string,content:string>>")})
    kept = filters.clean_samples(spread(web.unionByName(wiki).unionByName(local)))
    first = dedup.first_by_key(kept, dedup.text_key(F.col("rendered")), ["rec_id"])
    return first.groupBy("source", "format").agg(F.count("*").alias("samples"), F.sum(F.length("rendered")).alias("characters"))


# ---- duplicates and counts


def dedup_exact(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").select("doc_id", "text")
    return dedup.first_by_key(docs, dedup.text_key(F.col("text")), ["doc_id"]).select("doc_id")


def dedup_summary(s: SparkSession, d: str) -> DataFrame:
    return dedup.duplicates(table(s, d, "documents"), dedup.text_key(F.col("text")))


def source_counts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").rollup("source").agg(F.count("*").alias("records"), F.sum("n_chars").alias("characters"))


def format_counts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").groupBy("source", "format").agg(F.count("*").alias("records"))


def corpus_lines(s: SparkSession, d: str) -> DataFrame:
    """The tokenizer corpus: lines and characters of each source, line feeds as blanks, without empty lines."""
    lines = table(s, d, "documents").select("source", F.translate(tx.whitespace(F.col("text")), "\n", " ").alias("line")).where("line <> ''")
    return lines.groupBy("source").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("characters"))


# ---- samples


def _evol(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "evol_instruct_italian").select("id", "format", "prompt", "completion", "messages").dropDuplicates(["id"])


def chat_normalize(s: SparkSession, d: str) -> DataFrame:
    made = _evol(s, d).where("messages is not null").select("id", F.posexplode(sm.messages(F.col("messages"))).alias("pos", "m"))
    return made.select("id", F.col("pos").cast("bigint").alias("pos"), "m.role", "m.content")


def chat_render(s: SparkSession, d: str) -> DataFrame:
    return _evol(s, d).where("messages is not null").select("id", sm.render_messages(sm.messages(F.col("messages"))).alias("rendered"))


def prompt_completion(s: SparkSession, d: str) -> DataFrame:
    sides = sm.pair(F.col("format"), sm.messages(F.col("messages")), F.col("prompt"), F.col("completion"), F.lit(""))
    return _evol(s, d).where("format = 'instruction'").select("id", sides.alias("p")).select("id", "p.prompt", "p.completion")


def training_text(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "local_import").where("format = 'instruction'")
    return rows.select("rec_id", sm.training_text(F.col("format"), F.lit(None).cast("array<struct<role:string,content:string>>"), F.col("prompt"), F.col("completion"), F.col("text")).alias("rendered"))


def qa_adapter(s: SparkSession, d: str) -> DataFrame:
    return files.extractive(table(s, d, "squad_it").dropDuplicates(["id"])).select("id", "prompt", "completion")


def instruction_adapter(s: SparkSession, d: str) -> DataFrame:
    return files.instructions(_evol(s, d)).groupBy("format").agg(F.count("*").alias("samples"), F.sum(F.coalesce(F.size("messages"), F.lit(0))).alias("messages"))


# ---- examples


def chat_examples(s: SparkSession, d: str) -> DataFrame:
    rows = _evol(s, d).where("messages is not null").select("id", sm.messages(F.col("messages")).alias("messages"), F.lit("all").alias("turns"))
    return examples.chat_prefixes(rows, "id").select("id", F.col("turn").cast("bigint").alias("turn"), "prompt", "completion")


def lm_blocks(s: SparkSession, d: str) -> DataFrame:
    rows = examples.with_token_profile(table(s, d, "wikipedia_it").select("rec_id", F.lit("wikipedia_it").alias("source"), examples.code_points(F.col("text")).alias("ids")))
    made = examples.lm_examples(rows, "ids", "rec_id")
    total = F.aggregate("input_ids", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return made.select("rec_id", F.col("block").cast("bigint").alias("block"), F.size("input_ids").cast("bigint").alias("n"), total.alias("id_sum"))


def sft_labels(s: SparkSession, d: str) -> DataFrame:
    rows = files.extractive(table(s, d, "squad_it").dropDuplicates(["id"]))
    made = rows.select("id", examples.supervised(examples.code_points(F.col("prompt")), examples.code_points(F.concat(F.lit("\n"), F.col("completion"))), F.lit(512), F.lit("tail")).alias("e"))
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return made.select("id", F.size("e.input_ids").cast("bigint").alias("n"), total("e.input_ids").alias("id_sum"), total("e.labels").alias("label_sum"))


def training_examples(s: SparkSession, d: str) -> DataFrame:
    """The examples of all sources by code points: how many of each source, format, loss and tokenization, with their ids."""
    none = F.lit(None).cast("array<struct<role:string,content:string>>")
    empty = F.lit(None).cast("string")
    web = [table(s, d, t).select(F.col("rec_id").cast("string").alias("rid"), "source", "format", none.alias("messages"), empty.alias("prompt"), empty.alias("completion"), "text") for t in ("fineweb2_it", "wikipedia_it")]
    local = table(s, d, "local_import").select(F.col("rec_id").cast("string").alias("rid"), "source", "format", none.alias("messages"), "prompt", "completion", "text")
    evol = table(s, d, "evol_instruct_italian").dropDuplicates(["id"]).select(F.col("id").alias("rid"), "source", "format", "messages", "prompt", "completion", empty.alias("text"))
    squad = files.extractive(table(s, d, "squad_it").dropDuplicates(["id"])).select(F.col("id").alias("rid"), "source", "format", none.alias("messages"), "prompt", "completion", empty.alias("text"))
    made = examples.training_examples(spread(web[0].unionByName(web[1]).unionByName(local).unionByName(evol).unionByName(squad)))
    return made.groupBy("source", "format", "loss_mode", "tokenization").agg(F.count("*").alias("examples"), F.sum(F.size("input_ids")).alias("ids"))


def shard_manifest(s: SparkSession, d: str) -> DataFrame:
    return examples.manifest(table(s, d, "packed_shards"))


def reshard(s: SparkSession, d: str) -> DataFrame:
    made = examples.sharded(table(s, d, "packed_shards").select("source", "example_id", "shard"), "source", ["example_id", "shard"])
    return made.groupBy("source", F.col("shard_id").cast("bigint").alias("shard_id")).agg(F.count("*").alias("records"))


def truncate_sequences(s: SparkSession, d: str) -> DataFrame:
    made = examples.truncated(table(s, d, "packed_shards"))
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return made.select("example_id", "shard", F.size("input_ids").cast("bigint").alias("n"), total("input_ids").alias("id_sum"), total("labels").alias("label_sum"), total("attention_mask").alias("mask_sum"))


def collate_batches(s: SparkSession, d: str) -> DataFrame:
    """Batches of eight: rows, common length, and tokens without padding."""
    made = examples.padded(examples.batched(examples.truncated(table(s, d, "packed_shards")).select("example_id", "shard", "input_ids", "labels", "attention_mask"), "example_id", 8))
    return made.groupBy("batch").agg(F.count("*").alias("rows"), F.max(F.size("input_ids")).alias("longest"), F.min(F.size("labels")).alias("shortest"), F.max("batch_tokens").alias("tokens"))


def train_validation_split(s: SparkSession, d: str) -> DataFrame:
    return examples.split(table(s, d, "documents").select("doc_id"), "doc_id").groupBy("is_validation").agg(F.count("*").alias("documents"))


# ---- metrics


#: Rates, and means of few numbers with few decimals, lie between two roundings at six digits too often.
_MEANS = {"lr_start", "lr_end", "mean_loss", "avg_loss", "recent_avg", "previous_avg", "tokens_avg"}


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 9 if c in _MEANS else 6) for c, t in df.dtypes if t == "double"})


def _log(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "metrics_history")


def metric_pivot(s: SparkSession, d: str) -> DataFrame:
    return metrics.pivot(_log(s, d))


def moving_average(s: SparkSession, d: str) -> DataFrame:
    made = metrics.smoothed(metrics.pivot(_log(s, d)))
    return made.select("run_id", "step", F.round("train_loss_smooth", 9).alias("train_loss_smooth"), F.round("perplexity_smooth", 9).alias("perplexity_smooth"), F.round(F.col("learning_rate_smooth") * 1e6, 9).alias("rate_smooth"))


def trend_analysis(s: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.trends(_log(s, d)))


def period_analysis(s: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.periods(_log(s, d)))


def asof_eval_gap(s: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.gaps(metrics.pivot(_log(s, d))))


def eta_rate(s: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.eta(_log(s, d)))


def epoch_means(s: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.epochs(_log(s, d)))


def slow_steps(s: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.slow_steps(_log(s, d), 0.7))


def latest_entry(s: SparkSession, d: str) -> DataFrame:
    return metrics.latest(_log(s, d)).select("run_id", "step", "type", "timestamp", F.nanvl("loss", F.lit(None).cast("double")).alias("loss"))


def visible_range(s: SparkSession, d: str) -> DataFrame:
    made = metrics.visible(stage(metrics.pivot(_log(s, d)), "log-steps"), F.lit(90), F.lit(40))
    return made.select("run_id", "step", F.round("train_loss_smooth", 9).alias("train_loss_smooth"))


def period_mode(s: SparkSession, d: str) -> DataFrame:
    return metrics.period_domain(metrics.pivot(_log(s, d)), (180, 95), (50, 400))


def live_rates(s: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.rates(_log(s, d)))


def eval_average(s: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.evaluation(_log(s, d)))


def metric_stream(s: SparkSession, d: str) -> DataFrame:
    """The pivot over a log that a stream has appended."""
    path = f"{d}/metrics_history.parquet"
    log = stream_metrics.append_log(stream_metrics.log_stream(s, path, s.read.parquet(path).schema), uuid.uuid4().hex)
    return metrics.pivot(s.read.parquet(log))


# ---- dialogue and stages


def _lines(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return docs.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), "line")


def interval_merge(s: SparkSession, d: str) -> DataFrame:
    """Windows of two lines before and three after each line with a word, merged, in every document."""
    return dialogue.scenes(_lines(s, d), "doc_id", F.col("line").contains("ponte"), 2, 3).select("doc_id", F.col("scene").cast("bigint").alias("scene"), "start", "end")


def turn_machine(s: SparkSession, d: str) -> DataFrame:
    """Commands and replies among the lines of every document, as merged turns."""
    made = dialogue.turns(_lines(s, d), ["doc_id"], "line_no", F.col("line").contains("?"), F.col("line").contains("sistema"))
    return made.select("doc_id", F.col("turn").cast("bigint").alias("turn"), "role", "content")


_STEPS = [("prepare", 0, "prepare", "Preparation", "", None), ("language", 1, "train", "Language", "", "prepare"), ("knowledge", 2, "train", "Knowledge", "", "language"), ("dialogue", 3, "train", "Dialogue", "", "knowledge")]
_EVENTS = [
    (1, "prepare", "running", None, None, "2026-01-01T00:00:00"), (2, "prepare", "failed", None, "disk", "2026-01-01T01:00:00"), (3, "prepare", "running", None, None, "2026-01-02T00:00:00"),
    (4, "prepare", "completed", "ck/0", None, "2026-01-02T05:00:00"), (5, "language", "running", None, None, "2026-01-03T00:00:00"),
]


def stage_state(s: SparkSession, d: str) -> DataFrame:
    current = stages.state(s.createDataFrame(_STEPS, stages.STEPS), s.createDataFrame(_EVENTS, stages.EVENTS))
    return current.join(stages.readiness(current), "id").select("id", "status", "started_at", "completed_at", "checkpoint_path", "events", "ready", "next")


def missing_sources(s: SparkSession, d: str) -> DataFrame:
    wanted = table(s, d, "mix_targets").select(F.col("source").alias("dataset"))
    there = table(s, d, "documents").groupBy(F.col("source").alias("dataset")).agg(F.count("*").alias("rows"))
    return sinks.missing(wanted, there)


def fingerprint(s: SparkSession, d: str) -> DataFrame:
    return stages.fingerprint(table(s, d, "reading_samples"), "text")


def flagship(s: SparkSession, d: str) -> DataFrame:
    """Documents with a clean surface, valid by their profile, first copies only, by language."""
    docs = table(s, d, "documents").select("doc_id", "source", "format", "lang", tx.surface(F.coalesce("text", F.lit(""))).alias("text"))
    kept = filters.with_profile(docs).where(filters.valid(F.col("text"))).select("doc_id", "lang", "text")
    return dedup.first_by_key(kept, dedup.text_key(F.col("text")), ["doc_id"]).groupBy("lang").agg(F.count("*").alias("documents"), F.sum(F.length("text")).alias("characters"))


QUERIES = {
    f.__name__: f
    for f in (
        flagship, surface_normalize, url_strip, separator_strip, strip_html, web_clean, wiki_clean, dump_clean, quality_ratios, valid_text, low_quality_flags, forum_subject,
        language_gate, clean_pipeline, dedup_exact, dedup_summary, source_counts, format_counts, corpus_lines, chat_normalize, chat_render, prompt_completion, training_text,
        qa_adapter, instruction_adapter, chat_examples, lm_blocks, sft_labels, training_examples, shard_manifest, reshard, truncate_sequences, collate_batches,
        train_validation_split, metric_pivot, moving_average, trend_analysis, period_analysis, asof_eval_gap, eta_rate, epoch_means, slow_steps, latest_entry, visible_range, period_mode, live_rates, eval_average, metric_stream,
        interval_merge, turn_machine, stage_state, missing_sources, fingerprint,
    )
}

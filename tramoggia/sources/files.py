"""Readers of corpus files: lines of JSON, plain texts, XML dumps, parquet shards, logs; and their selection."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import urljoin

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramoggia.functions import samples as sm
from tramoggia.functions import text as tx
from tramoggia.operators.filters import COLLECTED, terms_pattern
from tramoggia.session import stage

LEAST_TEXT, LEAST_STRUCTURED = 200, 40
TRUE = ("1", "true", "yes", "on")
LOG = "type string, timestamp string, epoch bigint, global_step bigint, total_steps bigint, loss double, perplexity double, learning_rate double, tokens bigint, vram_allocated_gb double, vram_reserved_gb double, optimizer_step_seconds double, cpu_optimizer_active boolean, eval_batches bigint, duration_seconds double"


def setting(name: str, default, environment: Mapping[str, str] | None = None):
    """A setting from the environment in the type of its default; missing, empty and unreadable ones give the default."""
    raw = (os.environ if environment is None else environment).get(name, "").strip()
    if not raw:
        return default
    if isinstance(default, bool):
        return raw.lower() in TRUE
    try:
        return type(default)(raw) if isinstance(default, (int, float)) else raw
    except ValueError:
        return default


def included(names: str | None) -> tuple[str, ...]:
    """A list separated by semicolons; empty means all."""
    return tuple(n.strip() for n in (names or "").split(";") if n.strip())


def only(df: DataFrame, names: Sequence[str], column: str = "dataset") -> DataFrame:
    return df.where(F.col(column).isin(*names)) if names else df


def path_of(name: str, paths: Mapping[str, str], prefix: str, create: bool = False, environment: Mapping[str, str] | None = None) -> str:
    """A configured folder, or the environment's override PREFIX_NAME."""
    found = (os.environ if environment is None else environment).get(f"{prefix}_{name.upper()}") or paths[name]
    if create:
        os.makedirs(found, exist_ok=True)
    return found


def first_available(readers: Sequence[Callable[[], DataFrame]]) -> DataFrame | None:
    """The first source that opens, with its schema read; null if none does."""
    for reader in readers:
        try:
            df = reader()
            df.schema  # noqa: B018
            return df
        except (PySparkException, FileNotFoundError, KeyError):
            continue
    return None


def isolated(sources: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """The sources that open, by name; one that fails doesn't touch the others."""
    found = {name: first_available([reader]) for name, reader in sources.items()}
    return {name: df for name, df in found.items() if df is not None}


def json_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """(dataset, line): the lines of JSON files, splittable, with the file's name as dataset."""
    return spark.read.option("recursiveFileLookup", "true").text(list(paths)).select(tx.safe_name(F.col("_metadata.file_path")).alias("dataset"), F.col("value").alias("line"))


def local_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text): each .txt file as one text of at least LEAST_TEXT characters; invalid bytes are left out."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").option("wholetext", "true").text(folder)
    text = tx.strip(F.regexp_replace("value", "�", ""))
    return raw.select(F.col("_metadata.file_path").alias("path"), text.alias("text")).where(F.length("text") >= LEAST_TEXT)


def local_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Local .jsonl rows as samples with text filled in; lines that are no JSON, or too short, are left out."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").text(folder).withColumnRenamed("value", "line")
    samples = stage(sm.normalized(raw.where(tx.strip(F.col("line")) != ""), "line", "local_import", "it"), "local")
    return long_enough(stage(filled(samples.where("not bad")), "filled"))


def filled(samples: DataFrame) -> DataFrame:
    """Samples whose empty text is the rendering of their other fields."""
    rendered = sm.training_text(F.col("format"), F.col("messages"), F.col("prompt"), F.col("completion"), F.col("text"))
    return samples.withColumn("text", F.when(F.coalesce("text", F.lit("")) == "", rendered).otherwise(F.col("text")))


def long_enough(samples: DataFrame) -> DataFrame:
    least = F.when(F.col("format").isin(*sm.STRUCTURED), LEAST_STRUCTURED).otherwise(LEAST_TEXT)
    return samples.where(F.length("text") >= least)


def limited(df: DataFrame, limit: int | None, order: Sequence[str]) -> DataFrame:
    """The first `limit` rows in a stated order, before any filter; 0 or none means all."""
    return df.orderBy(*order).limit(limit) if limit else df


def dump_pages(spark: SparkSession, path: str, least: int = LEAST_TEXT) -> DataFrame:
    """(title, text): pages of an XML dump (also .bz2), title and cleaned text of the first revision, not the shortest."""
    schema = "title string, revision array<struct<text struct<_VALUE string, _bytes string>>>"
    raw = spark.read.format("xml").option("rowTag", "page").option("attributePrefix", "_").schema(schema).load(path)
    body = tx.dump(F.coalesce(F.get("revision", F.lit(0))["text"]["_VALUE"], F.lit("")))
    title = F.coalesce("title", F.lit(""))
    text = tx.strip(F.concat(title, F.lit("\n"), body))
    return raw.select(title.alias("title"), text.alias("text")).where(F.length("text") >= least)


def dump_links(page: DataFrame, base: str, pattern: str, fallback: str) -> list[str]:
    """The addresses of a listing page's links that match, sorted; the fallback alone if there are none."""
    hrefs = page.select(F.explode(F.regexp_extract_all("value", F.lit(r'href="([^"]+)"'), F.lit(1))).alias("href")).where(F.col("href").rlike(pattern)).distinct()
    return sorted(urljoin(base, r.href) for r in hrefs.collect()) or [fallback]  # one listing page


def run_log(spark: SparkSession, path: str) -> DataFrame:
    """The history entries of a run's log document, with their position; a missing or half-written log gives no rows."""
    entries = f"array<struct<{LOG.replace(' ', ':').replace(',:', ',')}>>"
    try:
        raw = spark.read.option("multiLine", "true").schema(f"history {entries}").json(path)
        return raw.select(F.posexplode("history").alias("position", "entry")).select("position", "entry.*")
    except PySparkException:
        return spark.createDataFrame([], f"position int, {LOG}")


def packed(spark: SparkSession, *paths: str) -> DataFrame:
    """The three id columns of packed shards."""
    return spark.read.parquet(*paths).select("input_ids", "labels", "attention_mask")


def plain(df: DataFrame, source: str, language: str = "it") -> DataFrame:
    """Rows (text) as text samples of a source."""
    return df.select(F.lit("text").alias("format"), F.lit(source).alias("source"), F.lit(language).alias("language"), "text")


def extractive(df: DataFrame) -> DataFrame:
    """Rows (id, context, question, answers) as question and answer samples; those without context, question or first answer drop out."""
    answer = F.coalesce(F.get("answers.text", F.lit(0)), F.lit(""))
    prompt = F.concat(F.lit(sm.QA_PROMPT), F.col("context"), F.lit("\n\nDomanda:\n"), F.col("question"))
    whole = df.where((F.coalesce("context", F.lit("")) != "") & (F.coalesce("question", F.lit("")) != "") & (answer != ""))
    return whole.select("id", F.lit("qa").alias("format"), F.lit("squad_it").alias("source"), F.lit("it").alias("language"), prompt.alias("prompt"), answer.alias("completion"))


def instructions(df: DataFrame) -> DataFrame:
    """Rows (id, prompt, completion, messages) as chat samples where messages are there, else as instructions; others drop out."""
    turns = sm.messages(F.col("messages"))
    chat = F.size(turns) > 0
    both = (F.coalesce("prompt", F.lit("")) != "") & (F.coalesce("completion", F.lit("")) != "")
    form = F.when(chat, "chat").when(both, "instruction")
    made = df.select("id", form.alias("format"), F.lit("evol_instruct_italian").alias("source"), F.lit("it").alias("language"), F.when(~chat, F.col("prompt")).alias("prompt"), F.when(~chat, F.col("completion")).alias("completion"), F.when(chat, turns).alias("messages"))
    return made.where("format is not null")


def multiple_choice(question: Column, choices: Column, gold: Column) -> Column:
    """struct(prompt, completion) of a lettered choice; null where the gold index is out of range. An unreadable index is 0."""
    at = F.coalesce(gold.try_cast("int"), F.lit(0))
    lettered = F.transform(choices, lambda c, i: F.concat(F.chr(i + 65), F.lit(") "), c))
    prompt = F.concat(F.lit(sm.CHOICE_PROMPT), question, F.lit("\n\nOpzioni:\n"), F.array_join(lettered, "\n"))
    return F.when((at >= 0) & (at < F.size(choices)), F.struct(prompt.alias("prompt"), F.get(lettered, at).alias("completion")))


def on_subject(text: Column) -> Column:
    """Whether a forum text has one of the collected terms."""
    return text.rlike(terms_pattern(COLLECTED))

"""Quality filters of the cleaning stage and the profiles they depend on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramoggia.functions import samples as sm
from tramoggia.functions import text as tx
from tramoggia.session import stage

# Source, least length, least share of letters, most digits, whether the language is detected.
CLEANING = (
    ("piqa_italian", 40, 0.35, 0.45, False),
    ("squad_it", 40, 0.35, 0.55, False),
    ("evol_instruct_italian", 40, 0.30, 0.55, False),
    ("wikipedia_it", 350, 0.55, 0.25, True),
    ("wikipedia_it_wikimedia_direct", 350, 0.55, 0.25, True),
    ("fineweb2_it", 260, 0.55, 0.25, True),
    ("stackexchange_auto", 80, 0.35, 0.45, False),
    ("local_import", 40, 0.30, 0.55, True),
    ("*personality", 40, 0.35, 0.45, False),
)
#: Of sources without a profile: text, structured.
DEFAULTS = ((400, 0.6, 0.2), (40, 0.4, 0.35))
# Terms of the forum filter, and of the forum's own affairs.
AUTOMOTIVE = (
    "abs", "airbag", "alternator", "automobile", "battery", "benzina", "brake", "brakes", "cambio", "car", "cars", "centralina", "clutch", "diesel", "dtc",
    "ecu", "engine", "freno", "freni", "fuel", "gearbox", "hybrid", "ignition", "manutenzione", "mechanic", "motore", "obd", "obd2", "oil", "petrol",
    "sensore", "sensor", "throttle", "torque", "transmission", "vehicle", "veicolo",
)
COLLECTED = (
    "engine", "car", "vehicle", "obd", "ecu", "sensor", "brake", "battery", "transmission", "diesel", "petrol", "hybrid", "electric", "torque", "throttle",
    "gearbox", "clutch", "motore", "automobile", "veicolo", "benzina", "freni", "batteria", "centralina", "cambio", "frizione", "sensore",
)
META_TERMS = ("private beta", "public beta", "stack exchange", "stackexchange", "area51", "reputation", "upvote", "downvote", "moderator")


def terms_pattern(terms: tuple[str, ...]) -> str:
    """Any of the terms, in any case, not inside a run of letters or digits."""
    return r"(?iu)(?<![a-z0-9])(?:" + "|".join(terms) + r")(?![a-z0-9])"


def profile_key(source: Column, personality: str | None = None) -> Column:
    """The profile's name for a source: its own, or that of the source named `personality`, the assistant's own dialogues."""
    plain = tx.strip(source)
    return F.when(plain == F.lit(personality), F.lit("*personality")).otherwise(plain)


def cleaning_profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CLEANING), "profile string, min_length int, min_alpha double, max_digit double, detect boolean")


def with_profile(df: DataFrame, personality: str | None = None) -> DataFrame:
    """`df` (source, format) with its profile's thresholds; nulls of unknown sources take the defaults, but for `detect`."""
    profiles = F.broadcast(cleaning_profiles(df.sparkSession))  # nine rows
    joined = df.withColumn("profile", profile_key(F.col("source"), personality)).join(profiles, "profile", "left").drop("profile")
    structured = F.coalesce(F.col("format"), F.lit("text")) != "text"
    by_form = lambda k: F.when(structured, F.lit(DEFAULTS[1][k])).otherwise(F.lit(DEFAULTS[0][k]))
    return joined.withColumns({c: F.coalesce(c, by_form(k)) for k, c in enumerate(("min_length", "min_alpha", "max_digit"))})


def valid(text: Column) -> Column:
    """Long enough, enough letters, not too many digits, by the thresholds of `with_profile`; bounds pass."""
    ok = (F.length(text) >= F.col("min_length")) & (tx.alpha_ratio(text) >= F.col("min_alpha")) & (tx.digit_ratio(text) <= F.col("max_digit"))
    return F.coalesce(ok, F.lit(False))


def low_quality(text: Column, source: Column, form: Column, strict: bool = False) -> Column:
    """Runs of symbols or of one word, many noisy symbols; for web texts page phrases, and if `strict` few sentences or mostly short lines."""
    limit = F.when(form != "text", 0.12).otherwise(0.04)
    lines = F.filter(F.split(text, "\n"), lambda line: tx.strip(line) != "")
    short = F.filter(lines, lambda line: F.length(tx.strip(line)) < 80)
    mostly_short = (F.size(lines) > 0) & (F.size(short) > 0.75 * F.size(lines))
    web = text.rlike(tx.words_pattern(tx.WEB_PHRASES))
    if strict:
        web = web | (form == "text") & ((tx.sentence_count(text) < 4) | mostly_short)
    runs = text.rlike(tx.SYMBOL_RUN) | text.rlike(tx.REPEATED_WORD)
    return F.coalesce(runs | (tx.symbol_ratio(F.regexp_replace(text, tx.ROLE_TOKEN, "")) > limit) | ((source == "fineweb2_it") & web), F.lit(False))


def passes_source(source: Column, prompt: Column, completion: Column, text: Column) -> Column:
    """What a source asks of its samples: the parts of a choice, both sides of a pair, the forum's subject."""
    asked, given = F.coalesce(prompt, F.lit("")), F.coalesce(completion, F.lit(""))
    return (
        F.when(source == "piqa_italian", asked.contains("Situazione:") & asked.contains("Opzioni:") & tx.strip(given).rlike(r"^[A-Z]\)"))
        .when(source == "squad_it", (asked != "") & (given != ""))
        .when(source == "stackexchange_auto", text.rlike(terms_pattern(AUTOMOTIVE)) & ~text.rlike(tx.words_pattern(META_TERMS)))
        .otherwise(F.lit(True))
    )


def language_allowed(language: Column, detected: Column, allowed: tuple[str, ...] = ("it",)) -> Column:
    """The language gate: a stated language must be allowed; where the profile asks for detection, or neither a
    language nor a profile is there, the detected one must be. `detect` comes from `with_profile`."""
    stated = F.lower(tx.strip(F.coalesce(language, F.lit(""))))
    trusted = (F.coalesce(F.col("detect"), F.lit(True)) == F.lit(False)) | ((stated != "") & F.col("detect").isNull())
    return F.when((stated != "") & ~stated.isin(*allowed), False).when(trusted, True).otherwise(F.coalesce(detected.isin(*allowed), F.lit(False)))


# Frequent function words by language, most of them in one of the languages only.
FUNCTION_WORDS = {
    "it": "il lo gli della delle degli nel nella che non con per una sono è più anche come questo dopo alla dal",
    "en": "the of and to in is was with for that this are by from not have which you it be",
    "fr": "le les des du et est dans une pour que qui pas sur avec au ce sont par plus il",
    "de": "der die das und ist nicht mit ein eine den dem von zu auf für sich als auch es im",
    "es": "el los las del y es en una por con que para se no su al como más pero este",
}


def detected_language(text: Column) -> Column:
    """The language whose function words make up most of a text's words; null where none of them occurs."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(1))
    listed = {lang: F.array(*[F.lit(w) for w in known.split()]) for lang, known in FUNCTION_WORDS.items()}

    def counted(found: Column) -> Column:
        of = lambda lang: F.size(F.filter(found, lambda w: F.array_contains(listed[lang], w)))
        return F.array_max(F.array(*[F.struct(of(lang).alias("n"), F.lit(lang).alias("lang")) for lang in FUNCTION_WORDS]))

    best = tx.bound(words, counted)
    return F.when(best["n"] > 0, best["lang"])


def clean_samples(
    df: DataFrame, detector: Callable[[Column], Column] = detected_language, allowed: tuple[str, ...] = ("it",), formats: tuple[str, ...] = (), strict: bool = False, personality: str | None = None
) -> DataFrame:
    """Samples (source, language, format, text, prompt, completion, messages …) cleaned, filtered and rendered.

    Adds `rendered`. The format filter comes first, being cheap and untouched by cleaning; each branch of
    cleaners is planned on its own rows, so that no row goes through another branch's patterns.
    `detector` (text → language) may be any expression, such as a classifier's UDF; by default function words tell. It is
    asked only where the gate needs it.
    Unknown columns are kept, null texts are empty.
    """
    if formats:
        df = df.where(F.col("format").isin(*formats))
    df = df.withColumn("format", F.coalesce("format", F.lit("text")))
    source, form = F.coalesce("source", F.lit("")), F.col("format")
    wiki = source.isin("wikipedia_it", "wikipedia_it_wikimedia_direct")
    paired = form.isin(*sm.PAIRED)
    branches = [
        (wiki, tx.wiki),
        (source == "stackexchange_auto", tx.forum),
        (~wiki & ~source.isin("fineweb2_it", "stackexchange_auto") & (form == "chat"), tx.chat),
        (~wiki & ~source.isin("fineweb2_it", "stackexchange_auto") & paired, tx.structured),
        (~wiki & (source != "stackexchange_auto") & ((source == "fineweb2_it") | ~form.isin("chat", *sm.PAIRED)), tx.web),
    ]
    whole = None
    for condition, clean in branches:
        part = df.where(condition).withColumns({c: clean(F.coalesce(c, F.lit(""))) for c in ("text", "prompt", "completion") if c in df.columns})
        if "messages" in df.columns:
            made = F.transform(sm.messages(tx.prepared(F.col("messages"))), lambda m: F.struct(m["role"].alias("role"), clean(m["content"], True).alias("content")))
            part = part.withColumn("messages", F.filter(made, lambda m: m["content"] != ""))
        whole = part if whole is None else whole.unionByName(part)
    turns = F.col("messages") if "messages" in df.columns else F.lit(None).cast("array<struct<role:string,content:string>>")
    sides = [F.col(c) if c in df.columns else F.lit(None).cast("string") for c in ("prompt", "completion", "text")]
    rendered = whole.withColumn("rendered", sm.training_text(F.col("format"), turns, *sides))
    # The cleaned corpus is written: else every filter would be pushed below the cleaners and repeat them.
    rendered = stage(rendered, "cleaned")
    text = F.col("rendered")
    kept = with_profile(rendered, personality).where(passes_source(F.coalesce("source", F.lit("")), *sides[:2], text) & ~low_quality(text, F.coalesce("source", F.lit("")), F.col("format"), strict) & valid(text))
    return kept.where(language_allowed(F.col("language"), detector(text), allowed)).drop("min_length", "min_alpha", "max_digit", "detect")

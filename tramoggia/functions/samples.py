"""The sample schema: roles, messages, rendering, and the adaptation of typed and open-schema rows."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tramoggia.functions import text as tx

# Names of roles, formats and key sets of the schema.
ROLE_NAMES = {"user": ("human", "user", "utente", "question", "prompt"), "assistant": ("gpt", "assistant", "assistente", "answer", "response"), "system": ("system", "sistema")}
STRUCTURED = ("qa", "choice_qa", "instruction", "chat")
PAIRED = ("qa", "choice_qa", "instruction")
QUESTION_KEYS = ("input_translation", "goal_translation", "question_translation", "input", "goal", "question", "prompt")
INSTRUCTION_KEYS, OUTPUT_KEYS = ("instruction", "prompt", "input", "question"), ("output", "response", "answer", "completion")
MESSAGE_KEYS = ("messages", "conversations", "conversation")
CHOICE_PROMPT = "Scegli l'opzione logicamente corretta e rispondi solo con la scelta migliore.\n\nSituazione:\n"
QA_PROMPT = "Leggi il contesto e rispondi in italiano in modo breve e preciso.\n\n<|context|>\n"


def role(name: Column) -> Column:
    """The canonical role; unknown names stay, missing and blank ones are the user's."""
    low = F.lower(tx.strip(F.coalesce(name, F.lit(""))))
    out = F.when(low == "", F.lit("user"))
    for canonical, names in ROLE_NAMES.items():
        out = out.when(low.isin(*names), F.lit(canonical))
    return out.otherwise(low)


def messages(raw: Column) -> Column:
    """Messages (array of role, content) with canonical roles and tidy contents, without empty ones; null gives none."""
    made = F.transform(raw, lambda m: F.struct(role(m["role"]).alias("role"), tx.whitespace(F.coalesce(m["content"], F.lit(""))).alias("content")))
    return F.filter(F.coalesce(made, F.array().cast("array<struct<role:string,content:string>>")), lambda m: m["content"] != "")


def tagged(name: str, content: Column) -> Column:
    return F.concat(F.lit(f"<|{name}|>\n"), content, F.lit("\n<|end|>"))


def render_messages(made: Column, with_answers: bool = True) -> Column:
    """Canonical messages as one text with role tokens; roles without a token speak as the user."""
    taken = made if with_answers else F.filter(made, lambda m: m["role"] != "assistant")
    token = lambda m: F.when(m["role"].isin("system", "assistant"), m["role"]).otherwise(F.lit("user"))
    return tx.strip(F.array_join(F.transform(taken, lambda m: F.concat(F.lit("<|"), token(m), F.lit("|>\n"), m["content"], F.lit("\n<|end|>"))), "\n"))


def pair(form: Column, made: Column, prompt: Column, completion: Column, text: Column) -> Column:
    """struct(prompt, completion): the two sides of a sample as they are rendered; text has only the first."""
    def side(raw: Column, name: str) -> Column:
        named = lambda t: F.when((t != "") & ~t.startswith(f"<|{name}|>"), tagged(name, t)).otherwise(t)
        return tx.strip(tx.bound(tx.whitespace(F.coalesce(raw, F.lit(""))), named))

    asked, given = side(prompt, "user"), side(completion, "assistant")
    last = F.get(made, F.size(made) - 1)
    answered = (F.size(made) > 0) & (last["role"] == "assistant")
    chat_prompt = F.when(answered, render_messages(F.slice(made, F.lit(1), F.greatest(F.size(made) - 1, F.lit(0))))).otherwise(render_messages(made))
    chat_completion = F.when(answered, tagged("assistant", last["content"])).otherwise(F.lit(""))
    paired = form.isin(*PAIRED)
    first = F.when(form == "chat", chat_prompt).when(paired, asked).otherwise(tx.whitespace(F.coalesce(text, F.lit(""))))
    second = F.when(form == "chat", chat_completion).when(paired, given).otherwise(F.lit(""))
    return F.struct(first.alias("prompt"), second.alias("completion"))


def training_text(form: Column, made: Column, prompt: Column, completion: Column, text: Column) -> Column:
    """The whole sample as one text."""
    sides = pair(form, made, prompt, completion, text)
    joined = tx.strip(F.array_join(F.filter(F.array(sides["prompt"], sides["completion"]), lambda p: p != ""), "\n"))
    return F.when(form == "chat", render_messages(made)).when(form.isin(*PAIRED), joined).otherwise(sides["prompt"])


def model_prompt(made: Column, classic: bool = False, last: int = 10) -> Column:
    """The prompt for the next answer: the last messages and an open assistant tag, or only the last user message."""
    if classic:
        mine = F.filter(made, lambda m: m["role"] == "user")
        return F.coalesce(F.get(mine, F.size(mine) - 1)["content"], F.lit(""))
    recent = F.slice(made, F.greatest(F.size(made) - last + 1, F.lit(1)), F.lit(last))
    return F.concat_ws("\n", F.when(F.size(made) > 0, render_messages(recent)), F.lit("<|assistant|>\n"))


def trimmed_completion(text: Column) -> Column:
    """A generated answer up to its first stop token, without the assistant tag and separators."""
    cut = F.split(F.regexp_replace(text, r"<\|assistant\|>", ""), r"<\|(?:end|user|system|context|answer)\|>", 2)[0]
    return tx.strip(tx.replace(tx.kept_lines(cut, lambda line: ~line.rlike(tx.SEPARATOR_LINE)), (tx.SYMBOL_RUN, " ")))


@F.pandas_udf(StringType())
def _strict(lines: pd.Series) -> pd.Series:
    """Lines that only a lenient reader takes, with numbers such as NaN as text and the last of equal keys; null where they are no JSON."""

    def one(line):
        try:
            return None if line is None else json.dumps(json.loads(line, parse_constant=lambda c: {"NaN": "nan", "Infinity": "inf", "-Infinity": "-inf"}[c]), ensure_ascii=False)
        except (ValueError, RecursionError):
            return None

    return lines.map(one)


def json_line(line: Column) -> Column:
    """The line as JSON that Spark parses: itself as a rule; one with NaN or repeated keys is written anew, outside the JVM."""
    good = F.try_parse_json(line).isNotNull()
    return F.when(good, line).otherwise(_strict(F.when(~good, line)))


def open_text(value: Column) -> Column:
    """A VARIANT as text: strings as they are, numbers spelled, lists joined by line feeds, objects by their text key."""

    def spelled(v: Column) -> Column:
        kind = F.schema_of_variant(v)
        flag = lambda x: F.when(F.schema_of_variant(x) == "BOOLEAN", F.initcap(F.try_variant_get(x, "$", "string")))
        item = lambda x: F.coalesce(flag(x), F.try_variant_get(x, "$", "string"), F.try_variant_get(x, "$.text", "string"), F.lit(""))
        listed = F.array_join(F.filter(F.transform(F.try_variant_get(v, "$", "array<variant>"), item), lambda t: t != ""), "\n")
        keyed = F.coalesce(*[F.try_variant_get(v, f"$.{k}", "string") for k in ("text", "content", "value", "answer", "output")], F.to_json(v))
        return F.when(v.isNull() | F.is_variant_null(v), F.lit("")).when(kind.startswith("ARRAY"), listed).when(kind.startswith("OBJECT"), keyed).when(kind == "BOOLEAN", F.initcap(F.try_variant_get(v, "$", "string"))).otherwise(F.try_variant_get(v, "$", "string"))

    return tx.bound(value, spelled)


def open_answer(value: Column) -> Column:
    """The first answer in a VARIANT: of a list the first element, of an object its text or answer."""

    def inner(first: Column) -> Column:
        return F.coalesce(*[F.try_variant_get(first, p, "variant") for p in ("$.text[0]", "$.text", "$.answer", "$.answers[0]", "$.output", "$.completion")], first)

    first = tx.bound(value, lambda v: F.when(F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$[0]", "variant")).otherwise(v))
    return open_text(tx.bound(first, inner))


def present(row: Column, *keys: str) -> Column:
    """The first of the keys with a value that is neither null nor blank, as a VARIANT."""

    def shown(v: Column) -> Column:
        blank = F.coalesce(tx.strip(F.try_variant_get(v, "$", "string")) == "", F.lit(False))
        return F.when(v.isNotNull() & ~(F.is_variant_null(v) | blank | F.to_json(v).isin("[]", "{}")), v)

    return F.coalesce(*[tx.bound(F.try_variant_get(row, f"$.{k}", "variant"), shown) for k in keys])


def open_messages(value: Column) -> Column:
    """Messages from a VARIANT list of objects (with aliases) or scalars, or a string with such a list in JSON."""
    parsed = F.when(F.schema_of_variant(value) == "STRING", F.try_parse_json(F.try_variant_get(value, "$", "string"))).otherwise(value)
    items = F.try_variant_get(parsed, "$", "array<variant>")
    get = lambda m, *ks: F.coalesce(*[F.try_variant_get(m, f"$.{k}", "string") for k in ks])
    raw = F.transform(items, lambda m: F.struct(get(m, "role", "from").alias("role"), F.coalesce(get(m, "content", "value", "text"), F.try_variant_get(m, "$", "string")).alias("content")))
    alone = F.array(F.struct(F.lit("user").alias("role"), F.try_variant_get(value, "$", "string").alias("content")))
    return messages(F.when(items.isNull() & (F.schema_of_variant(value) == "STRING"), alone).otherwise(raw))


def choices_of(row: Column) -> Column:
    """The choices of a multiple-choice row: a list, an object's list, or the two solutions."""
    given = present(row, "choices_translation", "choices")
    inner = F.coalesce(*[F.try_variant_get(given, p, "array<variant>") for p in ("$", "$.text", "$.choices", "$.labels")])
    two = F.array(F.try_variant_get(row, "$.sol1", "string"), F.try_variant_get(row, "$.sol2", "string"))
    named = F.transform(inner, lambda c: tx.whitespace(F.coalesce(*[F.try_variant_get(c, f"$.{k}", "string") for k in ("text", "content", "value", "label")], F.try_variant_get(c, "$", "string"))))
    out = F.when(F.size(named) > 0, named).otherwise(F.transform(two, tx.whitespace))
    return F.filter(out, lambda c: c.isNotNull() & (c != ""))


def choice_index(value: Column, choices: Column) -> Column:
    """The index an answer means: a number, a letter, a letter with a bracket, or the first choice with that text; else 0."""
    raw = tx.strip(F.coalesce(value, F.lit("")))
    low = F.lower(raw)
    found = F.array_position(F.transform(choices, lambda c: F.contains(F.lower(c), low)), F.lit(True)) - 1
    letter = F.ascii(F.upper(F.substring(raw, 1, 1))) - 65
    return (
        F.when(raw.rlike(r"^\p{Nd}+$"), raw.try_cast("int"))
        .when(raw.rlike(r"^\p{L}$") | raw.rlike(r"^[A-Za-z]\)"), letter)
        .when(value.isNull() | (raw == ""), F.lit(0))
        .otherwise(F.greatest(found, F.lit(0)))
        .cast("int")
    )


def normalized(df: DataFrame, column: str = "line", source: str | None = None, language: str | None = None, form: str = "text") -> DataFrame:
    """Open-schema JSON rows as samples: source, language, format, text, prompt, completion, messages, meta, bad.

    The adapter is chosen by source, then by the keys present, null ones included. Values of a row
    itself win over adapted ones. Columns of `df` must not begin with an underscore. `bad` marks lines that are no JSON; a row that isn't an object is a
    text. Rows are kept whatever they hold.
    """
    listed = F.col("_keys")
    base = df.withColumn("_line", json_line(F.col(column)))
    base = base.withColumns({"_row": F.try_parse_json("_line"), "_keys": F.coalesce(F.json_object_keys("_line"), F.array().cast("array<string>"))})
    r = F.col("_row")
    has = lambda *ks: F.arrays_overlap(listed, F.array(*[F.lit(k) for k in ks]))
    scalar = lambda k: F.try_variant_get(r, f"$.{k}", "string")
    given_source = F.when(F.coalesce(scalar("source"), F.lit("")) != "", scalar("source")).otherwise(F.lit(source))
    low = F.lower(tx.strip(F.coalesce(given_source, F.lit(""))))
    adapter = (
        F.when((low == "piqa_italian") | has("input_translation", "choices_translation", "gold_index", "sol1", "sol2"), "choice")
        .when((low == "squad_it") | (has("context") & has("question") & has("answers")), "extractive")
        .when(low == "stackexchange_auto", "forum")
        .when((low == "evol_instruct_italian") | has(*MESSAGE_KEYS, "instruction", "response"), "instruction")
        .otherwise("generic")
    )
    base = base.withColumns({"_source": given_source, "_adapter": adapter})
    # Each step names what the next one uses, so that no expression holds another many times.
    base = base.withColumns({"_turns": present(r, *MESSAGE_KEYS), "_options": choices_of(r)})
    texts = {
        "_gold": open_text(present(r, "gold_index", "label", "answer", "completion", "correct")), "_question": open_text(present(r, *QUESTION_KEYS)), "_context": open_text(present(r, "context", "passage")),
        "_asked": open_text(present(r, "question", "query", "prompt")), "_answer": open_answer(present(r, "answers", "answer", "completion", "output")),
        "_forum_q": open_text(present(r, "question", "title", "prompt")), "_forum_a": open_answer(present(r, "answers", "accepted_answer", "answer", "completion", "response")),
        "_instruction": open_text(present(r, *INSTRUCTION_KEYS)), "_output": open_text(present(r, *OUTPUT_KEYS)), "_extra": open_text(F.try_variant_get(r, "$.input", "variant")),
        "_plain_q": open_text(F.try_variant_get(r, "$.question", "variant")), "_plain_a": open_answer(present(r, "answer", "answers")),
    }
    base = base.withColumns(texts).withColumn("_gold", choice_index(F.col("_gold"), F.col("_options")))
    a, turns, options, gold, extra, instruction, output = (F.col(c) for c in ("_adapter", "_turns", "_options", "_gold", "_extra", "_instruction", "_output"))
    question, ctx, asked, answer, forum_q, forum_a = (F.col(c) for c in ("_question", "_context", "_asked", "_answer", "_forum_q", "_forum_a"))
    is_chat = (a.isin("instruction", "generic") & turns.isNotNull()) | has("messages", "conversations")
    lettered = F.transform(options, lambda c, i: F.concat(F.chr(i + 65), F.lit(") "), c))
    with_input = F.when(has("instruction") & (extra != "") & (extra != instruction), F.concat(tx.whitespace(instruction), F.lit("\n\nInput:\n"), tx.whitespace(extra))).otherwise(tx.whitespace(instruction))
    cases = {
        "_choice": (a == "choice") & (question != "") & (F.size(options) > 0) & (gold >= 0) & (gold < F.size(options)), "_extractive": (a == "extractive") & (ctx != "") & (asked != "") & (answer != ""),
        "_forum": (a == "forum") & (forum_q != "") & (forum_a != ""), "_qa": (a == "generic") & ~(has("prompt") & has("completion")) & (F.col("_plain_q") != "") & present(r, "answer", "answers").isNotNull(),
        "_pair": a.isin("instruction", "generic") & ~is_chat & (instruction != "") & (output != ""), "_chat": is_chat,
    }
    base = base.withColumns(cases)
    generic_qa, is_chat = F.col("_qa"), F.col("_chat")
    made_prompt = (
        F.when(F.col("_choice"), F.concat(F.lit(CHOICE_PROMPT), tx.whitespace(question), F.lit("\n\nOpzioni:\n"), F.array_join(lettered, "\n")))
        .when(F.col("_extractive"), F.concat(F.lit(QA_PROMPT), tx.whitespace(ctx), F.lit("\n\nDomanda:\n"), tx.whitespace(asked)))
        .when(F.col("_forum"), forum_q)
        .when(generic_qa, F.col("_plain_q"))
        .when(F.col("_pair"), with_input)
    )
    made_completion = F.when(F.col("_choice"), F.get(lettered, gold)).when(F.col("_extractive"), answer).when(F.col("_forum"), forum_a).when(generic_qa, F.col("_plain_a")).when(F.col("_pair"), output)
    base = base.withColumns({"_prompt": made_prompt, "_completion": made_completion})
    made_prompt, made_completion = F.col("_prompt"), F.col("_completion")
    own = lambda k, made: F.when(F.array_contains(listed, k), open_text(F.try_variant_get(r, f"$.{k}", "variant"))).otherwise(made)
    stated = F.lower(tx.strip(F.coalesce(scalar("format"), scalar("type"), F.when(generic_qa, F.lit("qa")).when(made_prompt.isNotNull(), F.lit("instruction")), F.lit(form))))
    shape = F.when(is_chat, F.lit("chat")).when(a == "choice", F.lit("choice_qa")).when(a.isin("extractive", "forum"), F.lit("qa")).otherwise(stated)
    tongue = F.coalesce(scalar("language"), F.lit(language), F.when(a == "forum", F.lit("en")).when(a.isin("choice", "extractive") | (low == "evol_instruct_italian"), F.lit("it")))
    known = {"choice": "piqa_italian", "extractive": "squad_it", "forum": "stackexchange_auto"}
    named = F.coalesce(F.col("_source"), *[F.when(a == k, F.lit(v)) for k, v in known.items()])
    whole = F.when(~F.schema_of_variant(r).startswith("OBJECT"), open_text(r))
    tasks = {"choice": "physical_reasoning", "extractive": "extractive_qa", "forum": "automotive_qa"}
    by_adapter = lambda values: F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[a]
    task = F.coalesce(F.when(a == "choice", F.try_variant_get(r, "$.metadata.category", "string")), scalar("task"), by_adapter(tasks))
    entries = F.create_map(F.lit("id"), F.when(a != "forum", scalar("id")), F.lit("task"), task, F.lit("schema_adapter"), by_adapter(known))
    meta = F.when(a.isin(*known), F.map_filter(entries, lambda k, v: v.isNotNull())).otherwise(F.create_map().cast("map<string,string>"))
    result = {
        "source": named, "language": tongue, "format": shape, "text": tx.whitespace(F.coalesce(own("text", F.lit(None)), whole)),
        "prompt": tx.whitespace(own("prompt", made_prompt)), "completion": tx.whitespace(own("completion", made_completion)),
        "messages": F.when(is_chat, open_messages(turns)), "meta": F.map_concat(meta, F.coalesce(F.try_variant_get(r, "$.meta", "map<string,string>"), F.create_map().cast("map<string,string>"))),
        "bad": r.isNull(),
    }
    made = base.withColumns(result)
    return made.drop(*[c for c in made.columns if c.startswith("_")])

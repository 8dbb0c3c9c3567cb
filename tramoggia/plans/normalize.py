"""Open-schema rows, made as JSON of the test tables, through the adapters; and the same in SQL from the columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramoggia.functions import samples as sm
from tramoggia.plans.reference_sql import _ROLE, _space, _strip
from tramoggia.session import table


def _json(*columns: Column | str, nulls: bool = False) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": str(not nulls).lower()})


def _made(df: DataFrame, *keep: str) -> DataFrame:
    """The samples of JSON rows (line), messages as lines of role and content."""
    turns = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")
    made = sm.normalized(df)
    return made.select(*keep, "source", "language", "format", "text", "prompt", "completion", turns.alias("turns"), F.col("meta")["task"].alias("task"), F.col("meta")["schema_adapter"].alias("adapter"))


def normalize_open(s: SparkSession, d: str) -> DataFrame:
    """Typed rows of three tables as JSON, those of squad_it with their nulls."""
    evol = table(s, d, "evol_instruct_italian").select(F.lit("evol").alias("part"), "id", _json("format", "source", "language", "prompt", "completion", "messages", "meta").alias("line"))
    local = table(s, d, "local_import").select(F.lit("local").alias("part"), F.col("rec_id").cast("string").alias("id"), _json("format", "source", "language", "text", "prompt", "completion", "meta").alias("line"))
    squad = table(s, d, "squad_it").select(F.lit("squad").alias("part"), "id", _json("id", "title", "context", "question", "answers", nulls=True).alias("line"))
    return _made(evol.unionAll(local).unionAll(squad), "part", "id")


def choice_adapter(s: SparkSession, d: str) -> DataFrame:
    """Multiple-choice rows in four shapes: two solutions, a list, an object with a list, a list of objects."""
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    source = F.lit("piqa_italian").alias("source")
    shapes = [
        _json("p_partkey", name.alias("goal_translation"), brand.alias("sol1"), kind.alias("sol2"), (F.col("p_size") % 3).alias("label")),
        _json("p_partkey", name.alias("question"), F.array(brand, kind, F.lit(" ")).alias("choices"), F.lit("b").alias("gold_index")),
        _json("p_partkey", source, name.alias("input"), F.struct(F.array(kind, brand).alias("text")).alias("choices_translation"), F.lower(brand).alias("answer")),
        _json("p_partkey", source, name.alias("goal"), F.array(F.struct(kind.alias("text"), F.lit(None).cast("string").alias("label")), F.struct(F.lit(None).cast("string").alias("text"), brand.alias("label"))).alias("choices"), F.lit("B) come sopra").alias("correct")),
    ]
    line = F.lit(None).cast("string")
    for k, shape in enumerate(shapes):
        line = F.when(F.col("p_partkey") % 4 == k, shape).otherwise(line)
    return _made(table(s, d, "part").select("p_partkey", line.alias("line")), "p_partkey").drop("text", "turns")


def generic_adapter(s: SparkSession, d: str) -> DataFrame:
    """squad_it's rows without labels: as question and answers, as a forum's, and as instruction, input and output."""
    squad = table(s, d, "squad_it")
    first = F.get("answers.text", F.lit(0))
    shapes = {
        "qa": _json("question", "answers"),
        "forum": _json(F.lit(" StackExchange_Auto ").alias("source"), F.col("question").alias("title"), F.array(F.struct(first.alias("text"))).alias("answers"), nulls=True),
        "instruction": _json(F.col("question").alias("instruction"), F.col("context").alias("input"), first.alias("output")),
    }
    parts = None
    for name, line in shapes.items():
        part = squad.select(F.lit(name).alias("shape"), "id", line.alias("line"))
        parts = part if parts is None else parts.unionAll(part)
    return _made(parts, "shape", "id").drop("text", "turns")


def open_messages(s: SparkSession, d: str) -> DataFrame:
    """Conversations as strings: of JSON with other names for role and content, or of a single prompt."""
    named = F.to_json(F.transform("messages", lambda m: F.struct(m["role"].alias("from"), m["content"].alias("value"))))
    line = _json(F.coalesce(named, "prompt").alias("conversations"), nulls=True)
    return _made(table(s, d, "evol_instruct_italian").select("id", line.alias("line")), "id").select("id", "format", "turns")


QUERIES = {"normalize_open": normalize_open, "choice_adapter": choice_adapter, "generic_adapter": generic_adapter, "open_messages": open_messages}

_NL = "chr(10)"
_QA_PROMPT = f"'Leggi il contesto e rispondi in italiano in modo breve e preciso.' || {_NL} || {_NL} || '<|context|>' || {_NL} || {_space('context')} || {_NL} || {_NL} || 'Domanda:' || {_NL} || {_space('question')}"
_TURN = f"""SELECT k, string_agg({_ROLE} || ': ' || content, {_NL} ORDER BY i) AS turns
  FROM (SELECT k, i, lower({_strip("coalesce(m.role, '')")}) AS r, {_space("coalesce(m.content, '')")} AS content
    FROM (SELECT k, unnest(messages) AS m, unnest(range(len(messages))) AS i FROM numbered)) WHERE content <> '' GROUP BY k"""
_ANSWER = "coalesce(answers.text[1], '')"

SQL = {
    "normalize_open": f"""
WITH numbered AS (SELECT row_number() OVER () AS k, * FROM evol_instruct_italian), t AS ({_TURN}),
e AS (SELECT 'evol' AS part, id, source, coalesce(language, 'it') AS language, CASE WHEN messages IS NOT NULL THEN 'chat' ELSE lower({_strip("coalesce(nullif(format, ''), CASE WHEN format IS NULL AND " + _strip("coalesce(prompt, '')") + " <> '' AND " + _strip("coalesce(completion, '')") + " <> '' THEN 'instruction' ELSE 'text' END)")}) END AS format,
  NULL::VARCHAR AS text, {_space("prompt")} AS prompt, {_space("completion")} AS completion, CASE WHEN messages IS NOT NULL THEN coalesce(turns, '') END AS turns, meta['task'] AS task, meta['schema_adapter'] AS adapter FROM numbered LEFT JOIN t USING (k)),
l AS (SELECT 'local' AS part, rec_id::VARCHAR AS id, source, language, lower({_strip("coalesce(nullif(format, ''), CASE WHEN format IS NULL AND " + _strip("coalesce(prompt, '')") + " <> '' AND " + _strip("coalesce(completion, '')") + " <> '' THEN 'instruction' ELSE 'text' END)")}) AS format,
  {_space("text")} AS text, {_space("prompt")} AS prompt, {_space("completion")} AS completion, NULL::VARCHAR AS turns, meta['task'] AS task, meta['schema_adapter'] AS adapter FROM local_import),
q AS (SELECT 'squad' AS part, id, 'squad_it' AS source, 'it' AS language, 'qa' AS format, NULL::VARCHAR AS text, CASE WHEN ok THEN {_QA_PROMPT} END AS prompt, CASE WHEN ok THEN {_space(_ANSWER)} END AS completion, NULL::VARCHAR AS turns, 'extractive_qa' AS task, 'squad_it' AS adapter
  FROM (SELECT *, {_strip("coalesce(context, '')")} <> '' AND {_strip("coalesce(question, '')")} <> '' AND {_ANSWER} <> '' AS ok FROM squad_it))
SELECT * FROM e UNION ALL SELECT * FROM l UNION ALL SELECT * FROM q""",
    "choice_adapter": f"""
SELECT p_partkey, 'piqa_italian' AS source, 'it' AS language, 'choice_qa' AS format, 'physical_reasoning' AS task, 'piqa_italian' AS adapter,
  CASE WHEN gold < 2 THEN 'Scegli l''opzione logicamente corretta e rispondi solo con la scelta migliore.' || {_NL} || {_NL} || 'Situazione:' || {_NL} || p_name || {_NL} || {_NL} || 'Opzioni:' || {_NL} || 'A) ' || c[1] || {_NL} || 'B) ' || c[2] END AS prompt,
  CASE gold WHEN 0 THEN 'A) ' || c[1] WHEN 1 THEN 'B) ' || c[2] END AS completion
FROM (SELECT *, CASE WHEN p_partkey % 4 < 2 THEN [p_brand, p_type] ELSE [p_type, p_brand] END AS c,
  CASE p_partkey % 4 WHEN 0 THEN p_size % 3 WHEN 2 THEN CASE WHEN contains(lower(p_type), lower(p_brand)) THEN 0 ELSE 1 END ELSE 1 END AS gold FROM part)""",
    "generic_adapter": f"""
WITH s AS (SELECT id, {_space("question")} AS q, {_space("context")} AS c, {_strip("coalesce(question, '')")} <> '' AS asked, answers IS NOT NULL AND (answers.text IS NOT NULL OR answers.answer_start IS NOT NULL) AS given, coalesce(answers.text[1], '') AS a FROM squad_it)
SELECT 'qa' AS shape, id, NULL::VARCHAR AS source, NULL::VARCHAR AS language, CASE WHEN asked AND given THEN 'qa' ELSE 'text' END AS format,
  CASE WHEN asked AND given THEN q END AS prompt, CASE WHEN asked AND given THEN {_space("a")} END AS completion, NULL::VARCHAR AS task, NULL::VARCHAR AS adapter FROM s
UNION ALL SELECT 'forum', id, ' StackExchange_Auto ', 'en', 'qa', CASE WHEN asked AND a <> '' THEN q END, CASE WHEN asked AND a <> '' THEN {_space("a")} END, 'automotive_qa', 'stackexchange_auto' FROM s
UNION ALL SELECT 'instruction', id, NULL, NULL, CASE WHEN asked AND {_strip("a")} <> '' THEN 'instruction' ELSE 'text' END,
  CASE WHEN asked AND {_strip("a")} <> '' THEN q || CASE WHEN coalesce(c, '') <> '' THEN {_NL} || {_NL} || 'Input:' || {_NL} || c ELSE '' END END, CASE WHEN asked AND {_strip("a")} <> '' THEN {_space("a")} END, NULL, NULL FROM s""",
    "open_messages": f"""
WITH numbered AS (SELECT row_number() OVER () AS k, id, CASE WHEN messages IS NULL AND prompt IS NOT NULL THEN [{{'role': 'user', 'content': prompt}}] ELSE messages END AS messages FROM evol_instruct_italian), t AS ({_TURN})
SELECT id, 'chat' AS format, coalesce(turns, '') AS turns FROM numbered LEFT JOIN t USING (k)""",
}

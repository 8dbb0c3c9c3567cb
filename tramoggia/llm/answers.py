"""Defects of prompt and response pairs: empty, refusing, copied, truncated, foreign-language answers.

Copies are found by compressing the answer with the prompt as a zstandard dictionary, and the prompt with
the answer: neither may tell much that the other doesn't. Refusals and
languages are found by dictionaries; breaks by a terminal-context model counted over all answers: how often
a word is followed by an end (of a sentence or line) rather than by another word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramoggia.operators.joins import lookup
from tramoggia.session import mapped, stage, table

# Answers that stand for none.
PLACEHOLDERS = frozenset((
    "null", "none", "nil", "nan", "n/a", "n.a.", "na", "n/d", "n.d.", "nd", "vuoto", "[vuoto]", "(vuoto)", "<vuoto>", "empty", "[empty]",
    "undefined", "nessuna risposta", "nessun valore", "senza risposta", "[]", "{}", "\"\"", "''", "todo", "tbd", "?", "k.a.", "s/d", "s.o.",
))
# Phrases of declining, as patterns on lower-case text.
REFUSALS = (
    r"non (?:ti |vi |le )?poss(?:o|iamo) (?:aiutar\w*|risponder\w*|fornir\w*|soddisfar\w*|assister\w*|esaudir\w*|accontentar\w*|accoglier\w*|trattar\w*|procedere|farlo|dare (?:una |alcuna )?(?:risposta|indicazion\w+))",
    r"non posso dire nulla", r"non poter(?:ti|vi|le)? (?:risponder\w*|aiutar\w*|soddisfar\w*)", r"non (?:sono|siamo) in grado di (?:fornir\w*|risponder\w*|aiutar\w*|soddisfar\w*|dare|assister\w*)",
    r"mi è impossibile (?:accontentar\w*|risponder\w*|aiutar\w*|fornir\w*|soddisfar\w*)", r"impossibile rispondere", r"non ho la possibilità di",
    r"preferisco non (?:esprimer\w*|risponder\w*|parlar\w*)", r"non mi sento di (?:dare|risponder\w*|fornir\w*)", r"esula dalle mie competenze",
    r"(?:è )?meglio che io non risponda", r"va oltre ciò che mi è permesso", r"contrario alle (?:regole|linee guida|norme)", r"(?:devo|debbo|preferisco) (?:rifiutar\w*|declinar\w*)",
    r"mi rifiuto di", r"non mi è (?:consentito|permesso|possibile) (?:trattar\w*|risponder\w*|fornir\w*|parlar\w*|aiutar\w*)", r"linee guida me lo vietano",
    r"il testo non (?:fornisce|contiene|offre)", r"non dispongo di (?:questa|queste|tale|tali|alcuna) informazion\w+", r"non ho (?:accesso a )?(?:informazioni|dati) (?:per|su questo|sufficienti)",
    r"i (?:can(?:no|')t|can not|am unable to|am not able to|won't) (?:help|answer|assist|provide|fulfil\w*|comply)", r"as an ai (?:language )?model, i (?:can|do|am)", r"je ne (?:peux|puis) pas (?:vous |t')?(?:aider|répondre|fournir)",
    r"ich kann (?:dir|ihnen|diese|darauf)\b.{0,40}\bnicht (?:helfen|beantworten|antworten)", r"no puedo (?:ayudar\w*|responder\w*|proporcionar\w*)",
)
# Common function words by language.
FUNCTION_WORDS = {
    "it": "sì no a ad il lo la l gli le un uno una di del dello della dell dei degli delle da dal dalla dall dai in nel nello nella nell nei negli nelle con su sul sullo sulla sull sui sugli sulle per tra fra e ed o ma anche che chi cui non come se si è sono era ha hanno ho al allo alla all ai agli alle questo questa quello quella più molto sua suo loro mi ti ci vi ne durante dopo prima senza circa anni secondo ogni quando dove perché quindi",
    "en": "the a an of and or but to in on at by for with from is are was were be been has have had not no it its this that these those which who when where because as than then there their his her he she they we you i about before after without during often usually most",
    "fr": "le la les l un une des de du d au aux et ou mais dans en sur sous par pour avec sans est sont était a ont ne pas plus que qui quoi dont où ce cet cette ces son sa ses leur il elle ils elles nous vous je selon pendant depuis avant après parce comme très à",
    "de": "der die das den dem des ein eine einen einem einer eines und oder aber in im am an auf aus bei mit nach von vom zu zum zur für über unter ohne gegen ist sind war waren hat haben nicht kein keine es sie er wir ihr ich dass weil wenn als wie auch nur noch sehr seit während vor",
    "es": "el la los las un una unos unas de del al y o pero en con por para sin sobre según es son era fue ha han no que quien como cuando donde porque su sus este esta estos estas ese esa más muy también se lo le les desde durante antes después hace cerca",
}
# Names of the languages by which a prompt asks for one.
LANGUAGE_NAMES = {
    "italian": "it", "italiano": "it", "italiana": "it", "inglese": "en", "english": "en", "francese": "fr", "french": "fr", "français": "fr", "tedesco": "de", "tedesca": "de", "german": "de", "deutsch": "de", "spagnolo": "es", "spagnola": "es", "spanish": "es", "español": "es",
}

#: White space as Python's strip knows it.
BLANKS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
_ASKED = re.compile(r"(?:\bin(?: lingua)?|\blingua|\binto|\bauf|\ben) (" + "|".join(LANGUAGE_NAMES) + r")\b", re.I)
_REFUSAL = re.compile("|".join(f"(?:{p})" for p in REFUSALS))
_WORD = re.compile(r"[^\W_]+")
_BLANK = re.compile(r"^[\s.\-–—_…·•*~=]*$")
_LIST = re.compile(r"^\s*(?:[-–—•*]|\d{1,3}[.)])(?:\s|$)")
_LAST = re.compile(r"([^\W_]+)\W*$")
_SENTENCE = re.compile(r"[.!?…]+(?=\s|$)")
_PARTS = re.compile(r"(?<=[.!?…:])\s+|\n")
_FRAME = 9
_PLAIN = zstandard.ZstdCompressor(level=3, write_content_size=False)
_SCORES: dict[str, dict[str, float]] = {}
for _lang, _words in FUNCTION_WORDS.items():
    for _w in _words.split():
        _SCORES.setdefault(_w, {})[_lang] = 1.0
for _by in _SCORES.values():
    for _lang in _by:
        _by[_lang] = 1.0 / len(_by)

#: A refusal is declared in one of the answer's first sentences.
REFUSAL_SENTENCES = 2
#: An answer is a copy if the compressed size of it and of the prompt, each given the other, is at most this share of that without.
COPY_SHARE = 0.65
#: Words of the shortest prompt that can be restated (a greeting returned is none).
COPY_WORDS = 3
#: A word of which less than this share is followed by an end doesn't end an answer.
TERMINAL_SHARE = 0.02


def language_scores(words: list[str]) -> dict[str, float]:
    """For each language, how much its function words make up of the words."""
    total: Counter = Counter()
    for w in words:
        for lang, s in _SCORES.get(w, {}).items():
            total[lang] += s
    return total


def asked_language(prompt: str) -> str:
    """The language that the prompt asks for: Italian unless it names another."""
    m = _ASKED.search(prompt)
    return LANGUAGE_NAMES[m[1].lower()] if m else "it"


def is_empty(answer: str | None) -> bool:
    return answer is None or bool(_BLANK.match(answer)) or answer.strip().lower() in PLACEHOLDERS


def is_refusal(answer: str) -> bool:
    """Whether the answer declines at its beginning, whatever follows; a refusal told of later is content."""
    opening = [p for p in _PARTS.split(answer.lower().replace("’", "'")) if _WORD.search(p)][:REFUSAL_SENTENCES]
    return bool(_REFUSAL.search(" ".join(opening)))


def is_foreign(answer: str, wanted: str) -> bool:
    """Whether the answer's function words are clearly those of a language other than the wanted one."""
    words = [w.lower() for w in _WORD.findall(re.sub(r"```.*?(?:```|$)", " ", answer, flags=re.S))]
    scores = language_scores(words)
    if not scores:
        return False
    best = max(scores, key=lambda k: (scores[k], k == wanted))
    return best != wanted and scores[best] >= 0.5 and scores[best] > 2 * scores[wanted]


def _compressed(data: bytes, given: bytes | None = None) -> int:
    """The compressed size, less the frame's own bytes."""
    if given is None:
        return max(1, len(_PLAIN.compress(data)) - _FRAME)
    d = zstandard.ZstdCompressionDict(given.rjust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return max(0, len(zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=False).compress(data)) - _FRAME)


def compressed_share(text: str, given: str) -> float:
    """The compressed size of a text's words with the other's as dictionary ÷ that without."""
    a, b = (" ".join(_WORD.findall(t.lower())).encode() for t in (text, given))
    return _compressed(a, b) / _compressed(a)


def is_copy(answer: str, prompt: str) -> bool:
    """Whether the answer restates the prompt and adds nothing: each tells nearly all of the other."""
    if len(_WORD.findall(prompt)) < COPY_WORDS or not _WORD.search(answer):
        return False
    return compressed_share(answer, prompt) <= COPY_SHARE and compressed_share(prompt, answer) <= COPY_SHARE


def last_context(answer: str) -> tuple[str, bool]:
    """How the answer ends: ("end" | "cut" | "word:…", sure).

    "end" and "cut" are certain by form; otherwise the last word has to be looked up in the model.
    """
    text = answer.rstrip()
    if text.count("```") % 2:
        return "cut", True
    if text.endswith("```"):
        return "end", True
    line = text.split("\n")[-1]
    words = _WORD.findall(line)
    if _LIST.match(line) and not _WORD.search(_LIST.sub("", line)):
        return "cut", True
    if text[-1] in ",;:(-–—'’&/" and len(words) > 1:
        return "cut", True
    if text[-1] in ".!?\"»”)]}" and not text.endswith("..."):
        return "end", True
    listed, dots = bool(_LIST.match(line)), text.endswith(("…", "..."))
    # A sentence that doesn't end, rather than a bare value: it follows on others, or has several function words.
    if not dots and not listed and (_SENTENCE.search(text) or sum(w.lower() in _SCORES for w in words) > 1):
        return "cut", True
    m = _LAST.search(line)
    if not m:
        return "end", True
    last = m[1]
    if last.isdigit():
        return ("cut" if dots else "end"), True
    # Names are unknown to the model; they are taken as whole but for the only word of a list item.
    if last[0].isupper() and not dots and (len(words) >= 4 or not listed):
        return "end", True
    return "word:" + last.lower(), False


def terminal_words(answers: DataFrame) -> DataFrame:
    """(word, ends, goes_on): how often a word is followed by an end, or by another word, in all answers.

    The last word of an answer counts only if punctuation follows it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: Counter = Counter()
        mids: Counter = Counter()
        flow = re.compile(r"[^\W_]+|[.!?;:,…)\]»”\"]|\n")

        def out() -> pa.RecordBatch:
            words = list({**ends, **mids})
            batch = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([ends[w] for w in words], pa.int64()), pa.array([mids[w] for w in words], pa.int64())], names=["word", "ends", "goes_on"])
            ends.clear()
            mids.clear()
            return batch

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not text:
                    continue
                found = flow.findall(text.lower())
                for w, after in zip(found, found[1:]):
                    if w[0].isalnum():
                        if after[0].isalnum():
                            mids[w] += 1
                        elif after not in ",:;":
                            ends[w] += 1
            if len(ends) + len(mids) > 200_000:
                yield out()
        yield out()

    return answers.transform(mapped, run, "word string, ends bigint, goes_on bigint").groupBy("word").agg(F.sum("ends").alias("ends"), F.sum("goes_on").alias("goes_on"))


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs to their defect where the form shows it, else to the last word that decides."""
    for batch in batches:
        defects, lasts = [], []
        for prompt, answer, context in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
            defect, last = None, None
            prompt = prompt or ""
            if is_empty(answer):
                defect = "empty"
            elif is_refusal(answer):
                defect = "refusal"
            elif is_copy(answer, prompt):
                defect = "copy"
            elif is_foreign(answer, asked_language(prompt)):
                defect = "language"
            elif context is not None:
                defect = "truncated" if cut_from(answer, context) else None
            else:
                form, sure = last_context(answer)
                if sure:
                    defect = "truncated" if form == "cut" else None
                else:
                    last = form[5:]
            defects.append(defect)
            lasts.append(last)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(defects, pa.string()), pa.array(lasts, pa.string())], names=["source", "pair_id", "defect", "word"])


def cut_from(answer: str, context: str) -> bool:
    """Whether the answer stands in the context only so that it ends inside a word of it."""
    a, c = answer.strip(), context
    if not a or not a[-1].isalnum():
        return False
    at = c.find(a)
    if at < 0:
        a, c = a.lower(), c.lower()
        at = c.find(a)
    seen = False
    while at >= 0:
        end = at + len(a)
        if end >= len(c) or not c[end].isalnum():
            return False
        seen = True
        at = c.find(a, at + 1)
    return seen


def defects(pairs: DataFrame) -> DataFrame:
    """(source, pair_id, defect) of the defective pairs (source, pair_id, prompt, answer, context).

    `context` is the text an extractive answer is taken from, else null. Each pair has one defect, the
    first of: empty, refusal, copy, language, truncated. Null prompts count as empty. Rows delivered
    twice give one row; an empty table gives none.
    """
    rows = pairs.select("source", "pair_id", "prompt", "answer", "context")
    judged = stage(rows.transform(mapped, _forms, "source string, pair_id string, defect string, word string"), "answer-forms")
    open_ = judged.where("word is not null").select("word").distinct()
    model = terminal_words(rows.where("context is null").select("answer"))
    total = F.coalesce(F.col("ends"), F.lit(0)) + F.coalesce(F.col("goes_on"), F.lit(0))
    never = stage(open_.join(model, "word", "left").where((F.coalesce("ends", F.lit(0)) == 0) | (F.col("ends") < TERMINAL_SHARE * total)).select("word", F.lit(True).alias("never")), "never-last")
    named = lookup(judged, never, "word")
    defect = F.coalesce("defect", F.when(F.col("never"), F.lit("truncated")))
    return named.select("source", "pair_id", defect.alias("defect")).where("defect is not null").distinct()


def pairs(spark: SparkSession, directory: str) -> DataFrame:
    """The pairs of evol_instruct_italian (format instruction) and squad_it as `defects` takes them."""
    evol = table(spark, directory, "evol_instruct_italian").where("format = 'instruction'")
    evol = evol.select(F.lit("evol_instruct_italian").alias("source"), F.col("id").alias("pair_id"), "prompt", F.col("completion").alias("answer"), F.lit(None).cast("string").alias("context"))
    squad = table(spark, directory, "squad_it")
    answer = F.get(F.filter("answers.text", lambda t: F.regexp_replace(t, BLANKS, "") != ""), F.lit(0))
    squad = squad.select(F.lit("squad_it").alias("source"), F.col("id").alias("pair_id"), F.col("question").alias("prompt"), answer.alias("answer"), F.coalesce("context", F.lit("")).alias("context"))
    return evol.unionAll(squad)


def p4_found(spark: SparkSession, directory: str) -> DataFrame:
    """The defective pairs of both tables with their defect."""
    return defects(pairs(spark, directory))

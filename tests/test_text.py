"""Text functions and filters on stated cases, and against plain Python on generated strings."""

import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tramoggia.functions import samples as sm
from tramoggia.functions import text as tx
from tramoggia.operators import dedup, filters


def apply(spark, function, *texts):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    return [r.out for r in rows.select("k", function(F.col("t")).alias("out")).orderBy("k").collect()]


@pytest.mark.parametrize(
    ("function", "text", "expected"),
    [
        (tx.surface, "a \tb\r\n\r\n\r\n\r\n c\x07", "a b\n\nc"),
        (tx.surface, "e\u0301", "é"),
        (tx.surface_flat, " a\n b ", "a b"),
        (tx.without_tags, "<p>x &amp; y</p><script>z</script><li>q</li>", "x & y\n\n- q"),
        (tx.without_separators, "x\n--------\ny", "x\ny"),
        (tx.without_separators, "a ========== b", "a b"),
        (tx.without_urls, "vedi https://x.it/a?b qui www.y.it", "vedi   qui  "),
        (tx.without_web_lines, "Home\nIl testo\nAccetta tutti", "Il testo"),
        (tx.structured, "ciao , mondo", "ciao, mondo"),
        (tx.dump, "'''Roma''' è [[città|una città]] {{x}} [[Italia]]", "Roma è una città Italia"),
        (tx.wiki, "Testo -- Mario 12\nmaggio 2020 firma\nfine", "Testo\nfine"),
        (tx.web, "<p>Caffe\u0301 &egrave; http://x.it\u0301 buono</p>\n========\nMenu", "Caffé è buono"),
        (tx.wiki, "Roma\nTesto [[A|b]] {{t|{x}|y}} qui .\n== Note ==\nzzz", "Roma\nTesto b qui."),
        (tx.without_lead_noise, "Alfa\n| x = 1 | y = 2 e altro residuo Alfa è una città.", "Alfa\nAlfa è una città."),
        (tx.subtitle_line, "- {\\i1}Ciao [rumore] <b>tu</b>\\Nqui", "Ciao tu qui"),
        (tx.without_tags, None, None),
        (tx.wiki, "", ""),
    ],
)
def test_cases(spark, function, text, expected):
    assert apply(spark, function, text) == [expected]


def test_long_runs_do_not_recurse(spark):
    texts = ["{{" + "a|" * 10_000 + "}}", "{{" + "{x}" * 3_000 + "}}", "*- " * 20_000, "parola " * 20_000]
    assert apply(spark, tx.wiki, *texts)[0] == ""
    assert apply(spark, lambda t: t.rlike(tx.SYMBOL_RUN), *texts) == [False, False, True, False]
    assert apply(spark, lambda t: t.rlike(tx.REPEATED_WORD), *texts)[3] is True


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=("Cs",), max_codepoint=0x3100), max_size=40), min_size=20, max_size=40))
def test_surface_equals_python(spark, texts):
    texts = [t.replace("\0", " ") for t in texts]

    def plain(t):
        t = unicodedata.normalize("NFC", t).replace("\r\n", "\n").replace("\r", "\n")
        t = re.sub("[\x01-\x08\x0b\x0c\x0e-\x1f\xa0]", " ", t)
        t = "\n".join(line.strip() for line in re.sub("[ \t]+", " ", t).split("\n"))
        return re.sub("\n{3,}", "\n\n", t).strip()

    assert apply(spark, tx.surface, *texts) == [plain(t) for t in texts]


def test_ratios(spark):
    assert apply(spark, tx.symbol_ratio, "", "ab**", None) == [1.0, 0.5, None]
    assert apply(spark, tx.alpha_ratio, "ab12", "") == [0.5, None]
    assert apply(spark, tx.digit_ratio, "ab1²") == [0.5]
    assert apply(spark, tx.sentence_count, "A. B! c.d") == [2]
    assert apply(spark, tx.safe_name, "C:\\x\\a b.jsonl") == ["a_b"]


def test_valid_at_the_bounds(spark):
    rows = [("x", "text", "a" * 240 + " " * 80 + "1" * 80), ("x", "text", "a" * 239 + " " * 81 + "1" * 80), ("squad_it", "qa", "a" * 14 + "1" * 22 + "." * 4), ("y_own", "chat", "a" * 39), ("y_own", "chat", "1" * 18 + "a" * 22), ("z_own", "chat", "1" * 18 + "a" * 22)]
    df = filters.with_profile(spark.createDataFrame(rows, "source string, format string, text string"), "y_own")
    assert [r.ok for r in df.select(filters.valid(F.col("text")).alias("ok")).collect()] == [True, False, True, False, True, False]


def test_low_quality(spark):
    rows = [("parola " * 6, "x"), ("parola " * 5 + "altra", "x"), ("leggi tutto", "fineweb2_it"), ("leggi tutto", "x"), ("a#" * 5 + "b" * 100, "x"), ("<|user|>\nciao\n<|end|>" + "b" * 100, "x"), (None, "x")]
    df = spark.createDataFrame(rows, "text string, source string")
    got = [r.ok for r in df.select(filters.low_quality(F.col("text"), F.col("source"), F.lit("text")).alias("ok")).collect()]
    assert got == [True, False, True, False, True, False, False]


@pytest.mark.parametrize(
    ("source", "language", "detected", "expected"),
    [("squad_it", "en", "it", False), ("squad_it", "it", "en", True), ("squad_it", None, "en", True), ("wikipedia_it", "it", "en", False), ("wikipedia_it", " IT ", "it", True), ("other", "it", "en", True), ("other", None, "it", True), ("other", "", "en", False), ("other", None, None, False)],
)
def test_language_gate(spark, source, language, detected, expected):
    df = filters.with_profile(spark.createDataFrame([(source, "text", language, detected)], "source string, format string, language string, d string"))
    assert df.select(filters.language_allowed(F.col("language"), F.col("d")).alias("ok")).first().ok is expected


def test_detected_language(spark):
    texts = ["Il cane è nel giardino con gli amici della casa.", "The dog is in the garden with the friends of the house.", "Le chien est dans le jardin avec les amis.", "Der Hund ist mit den Freunden im Garten und das ist gut.", "El perro está en el jardín con los amigos y una casa.", "123 !", ""]
    assert apply(spark, filters.detected_language, *texts) == ["it", "en", "fr", "de", "es", None, None]


def test_clean_samples_and_dedup(spark):
    schema = "rid long, source string, language string, format string, text string, prompt string, completion string, messages array<struct<role:string,content:string>>, extra int"
    long = "Una frase abbastanza lunga per passare il filtro della prova. " * 12
    rows = [
        (1, "wikipedia_it", "it", "text", long + "{{x}}", None, None, None, 7), (2, "wikipedia_it", "it", "text", long, None, None, None, 7), (3, "wikipedia_it", "en", "text", long, None, None, None, 7),
        (4, "evol_instruct_italian", "it", "chat", None, None, None, [("human", "Come si controlla il freno della macchina?"), ("gpt", "Si smonta la ruota &amp; si guarda il disco.")], 7),
        (7, "wikipedia_it", "it", "text", "The page is in English and it says that the label of the page is wrong for this text. " * 8, None, None, None, 7),
        (5, "squad_it", "it", "qa", None, "Una domanda abbastanza lunga?", "", None, 7), (6, None, None, None, None, None, None, None, 7),
    ]
    kept = filters.clean_samples(spark.createDataFrame(rows, schema))
    assert sorted(r.rid for r in kept.collect()) == [1, 2, 4] and "extra" in kept.columns
    chat = kept.where("rid = 4").first().rendered
    assert chat == "<|user|>\nCome si controlla il freno della macchina?\n<|end|>\n<|assistant|>\nSi smonta la ruota & si guarda il disco.\n<|end|>"
    first = dedup.first_by_key(kept, dedup.text_key(F.col("rendered")), ["rid"])
    assert sorted(r.rid for r in first.collect()) == [1, 4]


def test_render_pairs(spark):
    schema = "k int, f string, m array<struct<role:string,content:string>>, p string, c string, t string"
    rows = [(1, "chat", [("utente", " a "), ("x", "b")], None, None, None), (2, "chat", [("user", "a"), ("gpt", "b")], None, None, None), (3, "qa", None, "q", "", None), (4, "qa", None, "<|user|>\nq", "r", None), (5, "text", None, None, None, " t "), (6, "chat", None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    got = {r.k: (r.s.prompt, r.s.completion) for r in df.select("k", sm.pair(F.col("f"), sm.messages(F.col("m")), F.col("p"), F.col("c"), F.col("t")).alias("s")).collect()}
    assert got[1] == ("<|user|>\na\n<|end|>\n<|user|>\nb\n<|end|>", "")
    assert got[2] == ("<|user|>\na\n<|end|>", "<|assistant|>\nb\n<|end|>")
    assert got[3] == ("<|user|>\nq\n<|end|>", "") and got[4] == ("<|user|>\nq", "<|assistant|>\nr\n<|end|>") and got[5] == ("t", "") and got[6] == ("", "")


OPEN = [
    ('{"text": " ciao "}', "text", "ciao", None, None),
    ('{"format":"text","instruction":"a","output":"b"}', "text", None, "a", "b"),
    ('{"instruction":"a","input":"z","output":"b"}', "instruction", None, "a\n\nInput:\nz", "b"),
    ('{"source":"stackexchange_auto","question":"q","answers":[{"text":"r"},{"text":"s"}]}', "qa", None, "q", "r"),
    ('{"context":"c","question":"q","answers":{"text":["r","s"]}}', "qa", None, sm.QA_PROMPT + "c\n\nDomanda:\nq", "r"),
    ('{"goal":"g","sol1":"x","sol2":"y","label":1}', "choice_qa", None, sm.CHOICE_PROMPT + "g\n\nOpzioni:\nA) x\nB) y", "B) y"),
    ('{"messages":"[{\\"from\\":\\"human\\",\\"value\\":\\" hi \\"}]"}', "chat", None, None, None),
    ("[1, 2]", "text", "1\n2", None, None),
    ("{broken", "text", None, None, None),
    ("{}", "text", None, None, None),
    ('{"text": "a", "score": NaN}', "text", "a", None, None),
    ('{"text": "a", "text": "b"}', "text", "b", None, None),
    ('{"text": [NaN, true, null, "x"]}', "text", "nan\nTrue\nx", None, None),
]


@pytest.mark.parametrize(("line", "form", "text", "prompt", "completion"), OPEN)
def test_open_schema(spark, line, form, text, prompt, completion):
    r = sm.normalized(spark.createDataFrame([(line, 1)], "line string, other int")).first()
    assert r.format == form and r.bad == line.startswith("{broken") and r.other == 1
    assert (r.text or None, r.prompt, r.completion) == (text, prompt, completion)
    if form == "chat":
        assert [tuple(m) for m in r.messages] == [("user", "hi")]


@pytest.mark.parametrize(("value", "expected"), [("B", 1), ("b) x", 1), ("1", 1), ("1.0", 0), ("-1", 0), (None, 0), ("due", 1)])
def test_choice_index(spark, value, expected):
    df = spark.createDataFrame([(value, ["uno", "due"])], "v string, c array<string>")
    assert df.select(sm.choice_index(F.col("v"), F.col("c")).alias("i")).first().i == expected

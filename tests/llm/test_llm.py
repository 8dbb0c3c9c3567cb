"""The text operators: against brute force, exact round trips, held-out cases and hard inputs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tramoggia.llm import answers, boilerplate, encoding, furniture, language, mixing, quality, reading
from tramoggia.operators.joins import lookup
from tramoggia.session import mapped, stage, table

DATA = "/root/testdata/sf0.01"
HARD = [None, "", " \n\t ", "a", "x " * 30_000, "🙂 é́ 汉字\r\n\x00 <|end|>", "\n" * 500]


def hard(spark, **more):
    rows = [(k, t, None) for k, t in enumerate([*HARD, HARD[3], HARD[3]])]
    return spark.createDataFrame(rows, "doc_id long, text string, extra string").withColumns({k: F.lit(v) for k, v in more.items()})


# ---- page furniture


def _pages(spark, n=24):
    rng = random.Random(3)
    nouns = ["mulino", "ponte", "fiume", "museo", "porto", "treno", "libro", "campo", "motore", "vento"]
    rows = []
    for k in range(n):
        site = f"www.sito{k % 2}.example"
        body = [f"Titolo {rng.choice(nouns)} {k}"] + [" ".join(f"Il {rng.choice(nouns)} guarda {rng.choice(nouns)} numero {rng.randint(1, 10**6)} della {rng.choice(nouns)}." for _ in range(4)) for _ in range(5)]
        top, end = [f"Rubrica {site[7]} » Sezione speciale", "Bacheca dei lettori"], [f"Redazione di via Ortica {site[7]}", "Registrazione 77 presso la pretura"]
        rows.append((k, site, "\n".join([*top, *body, *end])))
    return spark.createDataFrame(rows, "rec_id long, site string, text string")


def test_template_lines(spark):
    got = {tuple(r) for r in boilerplate.furniture_lines(_pages(spark)).collect()}
    assert got == {(k, line) for k in range(24) for line in (1, 2, 9, 10)}


def test_template_sentences_with_changing_parts(spark):
    # A sentence of the site with the article's author in it, and a fixed one beside a changing one, in no phrase list.
    rng = random.Random(4)
    names, rows = "Anna Bruno Carla Dario Elena Fabio Gino Irma".split(), []
    nouns = "mulino ponte fiume museo porto treno libro campo motore vento".split()
    for k in range(40):
        body = [" ".join(f"Il {rng.choice(nouns)} guarda {rng.choice(nouns)} e poi {rng.choice(nouns)} con {rng.choice(nouns)} del {rng.choice(nouns)}." for _ in range(3)) for _ in range(4)]
        by = f"Questo pezzo della bottega è stato scritto da {rng.choice(names)} {rng.choice(names)} per i lettori del foglio." if k % 2 else "La redazione del foglio parla di molte cose."
        end = f"Il prossimo numero parla di {rng.choice(nouns)} e di {rng.choice(nouns)} come sempre. Chi scrive alla bottega riceve il foglio a casa ogni mese." if k % 2 else "La piazza del paese resta sempre vuota la sera."
        rows.append((k, f"www.sito{k % 4}.example", "\n".join([*body, by, end])))
    got = {tuple(r) for r in boilerplate.furniture_lines(spark.createDataFrame(rows, "rec_id long, site string, text string")).collect()}
    assert {(k, line) for k in range(1, 40, 2) for line in (5, 6)} <= got and not any(line < 5 for _, line in got)


def test_notice_between_paragraphs(spark):
    # A notice of one site between the paragraphs, in no phrase list.
    rng = random.Random(6)
    nouns = "mulino ponte fiume museo porto treno libro campo motore vento".split()
    rows = []
    for k in range(40):
        body = [" ".join(f"Il {rng.choice(nouns)} guarda {rng.choice(nouns)} e poi {rng.choice(nouns)} con {rng.choice(nouns)} del {rng.choice(nouns)}." for _ in range(3)) for _ in range(4)]
        if k % 4 == 0:
            body.insert(2, "Il foglio della bottega vive delle quote dei soci e di chi lo compra ogni mese.")
        rows.append((k, f"www.sito{k % 4}.example", "\n".join(body)))
    got = {tuple(r) for r in boilerplate.furniture_lines(spark.createDataFrame(rows, "rec_id long, site string, text string")).collect()}
    assert got == {(k, 3) for k in range(0, 40, 4)}


def test_template_join_equals_broadcast(spark):
    df = table(spark, DATA, "fineweb2_it").withColumn("tok", F.lit(1))
    a = boilerplate.furniture_lines(df)
    b = boilerplate.furniture_lines(df, broadcast_keys=0)
    assert a.count() == b.count() > 2000 and a.exceptAll(b).count() == 0


def test_furniture_hard_inputs(spark):
    assert boilerplate.furniture_lines(hard(spark, site=None).withColumnRenamed("doc_id", "rec_id")).count() == 0
    assert boilerplate.furniture_lines(spark.createDataFrame([], "rec_id long, site string, text string")).count() == 0


def test_tagged_pages():
    lines = ['<li><a href="/1">Da non perdere</a></li>', "<p>Un titolo</p>", "<p>Testo che resta.</p>", "<div>Altro del sito</div>", "Pubblicità"]
    bits = [furniture.marks(line)[1] for line in lines]
    assert boilerplate.removable(bits, [boilerplate.Line(0.0, 1.0)] * 5) == [True, False, False, True, True]


def _lines_of(spark, rows):
    return {tuple(r) for r in boilerplate.furniture_lines(spark.createDataFrame(rows, "rec_id long, site string, text string")).collect()}


def test_pages_delivered_again(spark):
    df = _pages(spark)
    once, twice = boilerplate.furniture_lines(df), boilerplate.furniture_lines(df.unionAll(df).unionAll(df.where("rec_id < 9")))
    assert once.count() == twice.count() == 96 and once.exceptAll(twice).count() == 0


def test_small_sites_use_the_pool(spark):
    # Sites of one to three pages with the footer that valid classes of larger sites have, and one of their own.
    rng = random.Random(8)
    nouns = "mulino ponte fiume museo porto treno libro campo motore vento".split()
    text = lambda: " ".join(f"Il {rng.choice(nouns)} guarda {rng.choice(nouns)} e poi {rng.choice(nouns)} con {rng.choice(nouns)} numero {rng.choice(nouns)}." for _ in range(4))
    rows, k = [], 0
    for site, n in [(f"grande{j}.test", 30) for j in range(6)] + [(f"piccolo{j}.test", 1 + j) for j in range(3)] + [(f"altro{j}.test", 30) for j in range(12)]:
        for page in range(n):
            end = "Bottega dei lettori, via delle Rose" if site[0] in "gp" and (page % 3 == 0 or n < 4) else "Fine della pagina qui"
            rows.append((k, site, "\n".join([text(), text(), end] if end[0] == "B" else [text(), text()])))
            k += 1
    want = {(k, 3) for k, _, t in rows if t.count("\n") == 2}
    assert any(rows[k][1].startswith("piccolo") for k, _ in want) and _lines_of(spark, rows) == want


def broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_tables_of_tokens_are_not_broadcast(spark):
    pages = stage(mapped(_pages(spark).select("rec_id", "site", "text"), boilerplate._tokenize, boilerplate._SCHEMA), "page-tokens")
    keys = boilerplate.template(pages)
    # However small their files, only the sites' sizes, whose rows are counted, are sent.
    assert broadcasts(keys) == 1
    assert keys.where("site is not null").count() > 0 and keys.where("site is null").count() > 0


def test_keys_beyond_the_limit_are_not_broadcast(spark):
    pages = stage(mapped(_pages(spark).select("rec_id", "site", "text"), boilerplate._tokenize, boilerplate._SCHEMA), "page-tokens")
    keys = stage(boilerplate.template(pages), "template-keys")
    own = keys.where("site is not null").withColumn("key", F.xxhash64("site", "tok")).drop("site", "tok")
    each = pages.select("site", F.explode("tok").alias("tok")).withColumn("key", F.xxhash64("site", "tok"))
    salted, plain = lookup(each, own, "key", limit=0), lookup(each, own, "key")
    assert broadcasts(salted) == 0 and broadcasts(plain) == 1
    assert salted.count() == each.count() and salted.where("kind is not null").count() == plain.where("kind is not null").count() > 0


def test_lists_of_furniture_are_not_broadcast(spark):
    pages = boilerplate.with_furniture(_pages(spark).select("rec_id", "site", "text"))
    assert broadcasts(pages) == 0
    assert pages.count() == _pages(spark).count() and pages.where("size(gone) > 0").count() > 0


def test_copies_of_an_article_are_no_template(spark):
    # An article on eight of a site's eighty pages, each copy with one sentence changed, and the site's own footer.
    rng = random.Random(9)
    nouns = "mulino ponte fiume museo porto treno libro campo motore vento scuola chiesa".split()
    sentence = lambda: f"Il {rng.choice(nouns)} guarda {rng.choice(nouns)} e poi {rng.choice(nouns)} con {rng.choice(nouns)} del {rng.choice(nouns)} di {rng.choice(nouns)}."
    article, rows = [sentence() for _ in range(10)], []
    for k in range(240):
        body = [sentence() for _ in range(10)]
        if k % 3 == 0 and k < 24:
            body = list(article)
            body[rng.randrange(10)] = sentence()
        lines = ["Il ponte vecchio del paese", " ".join(body[:5]), " ".join(body[5:])] if k % 3 == 0 and k < 24 else [" ".join(body[:5]), " ".join(body[5:])]
        rows.append((k, f"www.sito{k % 3}.example", "\n".join([*lines, *(["Bottega dei lettori, via delle Rose"] if k % 6 == 0 else [])])))
    got = _lines_of(spark, rows)
    assert got == {(k, t.count("\n") + 1) for k, _, t in rows if k % 6 == 0}


def test_classes_keep_their_order_and_nest():
    bits, tok = [0] * 6, [10, 20, 30, 40, 50, 60]
    own = [(boilerplate.TEMPLATE, 9, 1, 0.1), (0, 0, 0, 0.0), (boilerplate.TEMPLATE, 9, 1, 0.3), (boilerplate.TEMPLATE, 5, 2, 0.5), (0, 0, 0, 0.0), (boilerplate.TEMPLATE, 5, 2, 0.2)]
    lines, slots = boilerplate.taken_apart(bits, tok, list(range(6)), own, [(0, 0)] * 6)
    # The second class's last token stands before its first one in the template.
    assert [s.template for s in lines] == [1, 0, 1, 1, 0, 0] and slots == [(0, 2)]
    assert boilerplate.removable(bits, lines, slots) == [True, True, True, True, False, False]
    own[2], own[5] = own[5], (boilerplate.TEMPLATE, 9, 1, 0.9)
    own[2] = (boilerplate.TEMPLATE, 5, 2, 0.1)
    crossing = boilerplate.taken_apart(bits, tok, [0, 1, 2, 5, 4, 3], own, [(0, 0)] * 6)[1]
    assert crossing == [(0, 3)]


# ---- quality


def test_statistics():
    prose = "Il mulino è vicino al fiume e non si ferma mai.\nLa ruota gira con l'acqua che arriva dal monte.\n"
    s = dict(zip(quality.COLUMNS, quality.statistics(prose * 2)))
    assert s["kind"] != "prose" and s["n_lines"] == 4 and s["duplicate_lines"] == 0.5 and s["punctuated_lines"] == 1.0 and s["prose_share"] == 0.5 and s["top_2gram"] > 0
    assert dict(zip(quality.COLUMNS, quality.statistics(prose)))["kind"] == "prose"
    table_ = "\n".join(f"| Nome{k} | {k * 37} | {k * 11} |" for k in range(20))
    assert dict(zip(quality.COLUMNS, quality.statistics(table_)))["kind"] != "prose"
    assert dict(zip(quality.COLUMNS, quality.statistics("Home\nLogin")))["kind"] == "no body"


def test_repetition_is_no_prose():
    kind = lambda t: dict(zip(quality.COLUMNS, quality.statistics(t)))["kind"]
    sentence = "Il mulino è vicino al fiume e non si ferma mai quando la ruota gira con l'acqua che arriva dal monte."
    other = "La piazza del paese resta vuota la sera perché tutti sono a casa. Il treno per il mare parte prima delle nove."
    assert kind(f"{sentence}\n{other}") == "prose"
    assert kind("\n".join([sentence] * 400)) != "prose" and kind(" ".join([sentence] * 400)) != "prose" and kind("\n\n".join([sentence, other] * 3)) != "prose"


def test_top_ngrams_equal_brute_force():
    rng = random.Random(0)
    words = [rng.choice("aa bbb c dddd ee".split()) for _ in range(60)]
    for n, got in zip(quality.NGRAMS, quality.top_ngrams(words)):
        grams = [tuple(words[k : k + n]) for k in range(len(words) - n + 1)]
        most = max(map(grams.count, grams))
        shares = [min(1.0, most * sum(map(len, g)) / sum(map(len, words))) for g in grams if grams.count(g) == most]
        assert any(got == pytest.approx(s) for s in shares)


def test_quality_hard_inputs(spark):
    rows = quality.quality(hard(spark), "doc_id").collect()
    assert len(rows) == len(HARD) + 2 and [r.kind for r in rows[:3]] == [None] * 3 and rows[4].n_words == 30_000
    assert quality.quality(hard(spark).where("false"), "doc_id").count() == 0


def test_body_is_less_the_sites_template(spark, model):
    # A menu that no phrase list names, and the same pages without it.
    menu = "\n".join(["Bacheca dei lettori", "Rubriche del mattino", "Sezione speciale", "Mappa delle botteghe"] * 6)
    body = "Il mulino è vicino al fiume e non si ferma mai."
    assert dict(zip(quality.COLUMNS, quality.statistics(f"{menu}\n{body}")))["body_chars"] > len(body)
    rng = random.Random(2)
    words = "mulino fiume ponte museo porto treno libro campo motore vento".split()
    rows = [(k, f"www.sito{k % 4}.example", f"{menu if k % 4 == 0 else ''}\nIl {rng.choice(words)} {k} è vicino al {rng.choice(words)} e non si ferma mai.") for k in range(80)]
    pages = boilerplate.with_furniture(spark.createDataFrame(rows, "rec_id long, site string, text string"))
    made = {r.rec_id: r for r in quality.quality(pages, "rec_id", gone="gone").collect()}
    assert len(made) == 80
    for k, _, text in rows:
        assert made[k].kind == "prose" and made[k].body_chars == len(text.split("\n")[-1])
    assert language.segments(pages, model, "rec_id", gone="gone").where("words > 12").count() == 0


# ---- languages


@pytest.fixture(scope="module")
def model(spark):
    return language.model_for(spark, DATA)


def test_held_out_sentences(model):
    held = {
        "it": "Il governo ha deciso di aumentare le risorse per le scuole di montagna", "en": "The government has decided to increase the resources for mountain schools", "fr": "Le gouvernement a décidé d'augmenter les moyens des écoles de montagne",
        "de": "Die Regierung hat beschlossen, die Mittel für die Schulen in den Bergen zu erhöhen", "es": "El gobierno ha decidido aumentar los recursos para las escuelas de montaña",
    }
    words = [language._WORD.findall(s.lower()) for s in held.values()]
    scores = model.scores(words, language.Ngrams())
    assert [language.LANGUAGES[k] for k in scores.argmax(axis=1)] == list(held)


def test_folded_scores_equal_kernels():
    texts = [language._WORD.findall(s.lower()) for lang in language.LANGUAGES for s in language.sentences(language.SEEDS[lang])]
    offsets, ids = language.indicators(texts, language.Ngrams())
    known = language.Ngrams()
    for k, words in enumerate(texts[:10]):
        plain = set(itertools.chain.from_iterable(known.parts[known[w]].tolist() for w in words))
        assert sorted(plain) == ids[offsets[k] : offsets[k + 1]].tolist()


def test_work_on_words_and_lines_is_done_once(monkeypatch):
    # Words between blanks and marks are those of the pattern, line by line and sentence by sentence.
    text = "Il mulino (1929) dell'acqua è a 3 km: «Sì.» Poi, ½ l'ora!\nx_y 2²b n° ٣ İl\xa0ponte e\u0301 a\x00b — fine.\n\nΟΔΟΣ ΟΔΟΣ."
    wanted = [[w for s in language.sentences(line.lower()) if (w := language._WORD.findall(s))] for line in text.split("\n")]
    assert language.sentence_words(text) == wanted and sum(map(len, wanted)) > 6
    # Lines that are taken away aren't marked again; new words are hashed together, known ones never again.
    monkeypatch.setattr(furniture, "_marks", lambda _: 1 / 0)
    monkeypatch.setattr(furniture, "_KNOWN", {})
    assert [u.words for u in language.body_units("Menu\nIl treno parte.", False, [1])] == [["il", "treno", "parte"]]
    known, calls, hashed = language.Ngrams(), [], language._ngrams
    monkeypatch.setattr(language, "_ngrams", lambda words: calls.append(len(words)) or hashed(words))
    for _ in range(2):
        language.indicators([["il", "treno"], ["il", "mare"]], known)
    assert calls == [3]


def test_segments_of_a_mixed_text(spark, model):
    text = "Il treno parte alle nove dalla stazione vecchia. (The council owns the bridge near the old town.) Poi arriva al mare prima di sera.\nDie Stadt liegt am Fluss und ist sehr alt."
    rows = language.segments(spark.createDataFrame([(1, text)], "doc_id long, text string"), model, "doc_id").orderBy("segment").collect()
    assert [r.lang for r in rows] == ["it", "en", "it", "de"] and all(r.confidence > 0.5 for r in rows)


def test_all_lines_of_a_body_are_classified(spark, model, monkeypatch):
    items = "15 cose da sapere su Valmore\n1) La fortezza industriale di Salcello\n2) Il mercato del pesce sul porto vecchio\n- Il filtro (1929)"
    foreign = "Il treno parte alle nove dalla stazione vecchia e arriva al mare.\n• The council owns the old bridge near the town.\n1. Die Stadt liegt am Fluss und ist sehr alt."
    rows = [(1, "it", items, None), (2, "it", foreign, None), (3, "it", "Ciao", None), (4, "it", None, None)]
    df = spark.createDataFrame(rows, "rec_id long, label string, text string, gone array<bigint>").withColumn("source", F.lit("local_import"))
    made = language.segments(df, model, "rec_id").orderBy("rec_id", "segment").collect()
    assert [(r.rec_id, r.lang) for r in made] == [(1, "it"), (2, "it"), (2, "en"), (2, "de"), (3, "it")]
    assert made[0].words == 19 and made[0].lead == made[4].lead == 0 and all(r.lead > language.LEAD for r in made[1:4])
    monkeypatch.setattr(language, "labelled", lambda *_: df)
    monkeypatch.setattr(language, "model_for", lambda *_: model)
    assert {r.rec_id: r.lang for r in language.p3_documents(spark, "").collect()} == {1: "it", 2: "it", 3: "it", 4: None}
    assert {(r.rec_id, r.lang) for r in language.p3_found(spark, "").collect()} == {(2, "en"), (2, "de")}


def test_language_hard_inputs(spark, model):
    assert {r.doc_id for r in language.segments(hard(spark), model, "doc_id").collect()} == {3, 4, 5, 7, 8}


@pytest.mark.parametrize(("label", "lang"), [(" IT ", "it"), ("it-IT", "it"), ("Italiano", "it"), ("en_GB", "en"), ("DEU", "de"), ("español", "es"), ("und", None), ("", None), (None, None), ("n/d", None)])
def test_stated(spark, label, lang):
    assert spark.createDataFrame([(label,)], "l string").select(language.stated(F.col("l")).alias("s")).first().s == lang


# ---- answers


CASES = [
    ("Definisci il ponte.", None, "empty"), ("Definisci il ponte.", " … - ", "empty"), ("Definisci il ponte.", "N/A", "empty"), ("Definisci il ponte.", "[vuoto]", "empty"),
    ("Chi ha aperto il museo di Torre?", "Mi dispiace, ma non posso aiutarti con questa richiesta.", "refusal"), ("Scrivi una lettera.", "Mi dispiace ma non posso venire a cena.", None), ("Spiega il motore.", "Non posso che consigliarti di partire dalle basi.", None),
    ("Definisci il ponte in due frasi brevi.", "DEFINISCI IL PONTE IN DUE FRASI BREVI.", "copy"), ("Definisci il ponte in due frasi brevi.", "Domanda: definisci il ponte in due frasi brevi", "copy"),
    ("Definisci il ponte in due frasi brevi.", "Definisci il ponte in due frasi brevi.\nIl ponte unisce due sponde del fiume e regge il peso dei carri.", None),
    ("Definisci il ponte.", "The bridge joins the two banks of the river.", "language"), ("Traduci in inglese: il ponte è vecchio.", "The bridge is old and the river is wide.", None), ("Rispondi in tedesco: dove?", "Il ponte si trova vicino alla casa.", "language"),
    ("Definisci il ponte.", "Il ponte unisce le due sponde del fiume e regge il", "truncated"), ("Definisci il ponte.", "```python\ndef a():\n    return", "truncated"), ("Elenca i passi.", "Ecco:\n1. Monta il ponte\n2.", "truncated"),
    ("Definisci il ponte in due frasi brevi.", " ".join(["Definisci il ponte in due frasi brevi."] * 3), "copy"), ("Dimmi dove si trova.", "A Borgo Vilsarna.", None), ("Dimmi se è vero.", "No.", None),
    ("Chi ha aperto il museo di Torre?", "Mi dispiace.\nNon posso aiutarti con questa richiesta. Prova altrove. Ci sono altre fonti. Buona giornata. A presto.", "refusal"),
    ("Racconta.", "Il custode aprì la porta. La piazza era vuota. Poi disse: non posso aiutarti con questa richiesta. E se ne andò.", None),
    ("Elenca i passi.", "Ecco i passi:\n- Monta il ponte\n- Controlla il ponte", None), ("Quanti?", "738", None), ("Chi?", "Anna Verdi", None), ("È vero?", "Sì.", None), (None, "Una risposta intera.", None),
]


def test_answer_defects(spark):
    rows = [("t", str(k), p, a, None) for k, (p, a, _) in enumerate(CASES)]
    rows += [("s", "s1", "Chi?", "il mot", "Qui c'è il motore."), ("s", "s2", "Chi?", "il motore", "Qui c'è il motore."), ("s", "s1", "Chi?", "il mot", "Qui c'è il motore.")]
    df = spark.createDataFrame(rows, "source string, pair_id string, prompt string, answer string, context string").withColumn("word", F.lit("clash"))
    got = {(r.source, r.pair_id): r.defect for r in answers.defects(df).collect()}
    assert got == {**{("t", str(k)): d for k, (_, _, d) in enumerate(CASES) if d}, ("s", "s1"): "truncated"}
    assert answers.defects(df.where("false")).count() == 0


# ---- encoding


def test_round_trip_and_libraries(spark):
    df = hard(spark)
    rows = {r.doc_id: r.ids for r in encoding.encode(df).collect()}
    assert rows[0] == rows[1] == [] and len(rows) == len(HARD) + 2
    with open(f"{encoding.TOKENIZERS}/{encoding.VOCABULARY}.tiktoken", "rb") as f:
        other = encoding.rank_encoding(f.read())
    assert all(rows[k] == other.encode_ordinary(t or "") for k, t in enumerate(HARD))
    back = {r.doc_id: r.text for r in encoding.decode(encoding.encode(df)).collect()}
    assert all(back[k] == (t or "") for k, t in enumerate(HARD))
    assert {r.doc_id: r.n_tokens for r in encoding.token_counts(df, "doc_id").collect()} == {k: len(v) for k, v in rows.items()}


def test_spans_cover_the_bytes(spark):
    for r in encoding.encode_spans(hard(spark)).collect():
        text = (HARD[r.doc_id] if r.doc_id < len(HARD) else HARD[3]) or ""
        raw = text.encode()
        assert b"".join(raw[a:b] for a, b in zip(r.byte_start, r.byte_end)) == raw
        assert all(raw[a:b].decode("utf-8", "ignore") in text[c:d] for a, b, c, d in zip(r.byte_start, r.byte_end, r.char_start, r.char_end))


# ---- mixing


def test_fill_exactly_equals_brute_force():
    for seed in range(120):
        rng = random.Random(seed)
        counts, budget = {rng.randint(1, 12): rng.randint(1, 3) for _ in range(4)}, rng.randint(1, 40)
        sums = (sum(n * k for n, k in zip(take, counts)) for take in itertools.product(*[range(v + 1) for v in counts.values()]))
        taken = mixing.fill_exactly(counts, budget)
        assert all(taken[k] <= counts[k] for k in taken) and sum(k * v for k, v in taken.items()) == max(s for s in sums if s <= budget)


def test_budgets_of_long_documents_are_filled():
    total = lambda counts, budget: sum(k * v for k, v in mixing.fit(counts, budget).items())
    assert total({90_000: 3}, 100_000) == 90_000 and total({70_000: 10, 3: 2}, 150_000) == 140_006
    assert total({200_000: 50, 150_001: 50, 7: 3}, 9_000_000) > 8_850_000
    for seed in range(60):
        rng = random.Random(seed)
        counts = {rng.randint(1, 40) * 10_000 + rng.randint(0, 3): rng.randint(1, 3) for _ in range(4)}
        budget = rng.randint(1, sum(k * v for k, v in counts.items()) - 1)
        sums = (sum(n * k for n, k in zip(take, counts)) for take in itertools.product(*[range(v + 1) for v in counts.values()]))
        best = max(s for s in sums if s <= budget)
        got = mixing.fit(counts, budget)
        assert all(got[k] <= counts[k] for k in got) and (sum(k * v for k, v in got.items()) == best if budget <= 2 * max(counts) else True)


def test_mix_shares_and_caps(spark):
    rng = random.Random(5)
    rows = [(k, s, "parola " * rng.randint(1, 60)) for s, n in (("a", 300), ("b", 40), ("c", 200), ("other", 50)) for k in range(n)] + [(1, "a", None), (2, "a", "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    aims = spark.createDataFrame([("a", 2.0, 1), ("b", 1.0, 3), ("c", 1.0, 2), ("none", 1.0, 9)], "source string, weight double, max_repeats int")
    made = mixing.mix(docs, aims)
    used = made.used.collect()
    report = {r.source: r for r in made.report.collect()}
    assert {r.source for r in used} == {"a", "b", "c"} and max(r.repeats for r in used if r.source == "b") <= 3 and max(r.repeats for r in used if r.source == "a") == 1
    for s, want in (("a", 0.5), ("b", 0.25), ("c", 0.25)):
        assert report[s].actual_share == pytest.approx(want, abs=0.005) and report[s].target_share == pytest.approx(want * 0.8)
        assert sum(r.n_tokens * r.repeats for r in used if r.source == s) == report[s].tokens <= report[s].budget
    assert report["none"].tokens == 0 and mixing.mix(docs, aims).used.exceptAll(made.used).count() == 0
    assert mixing.mix(docs.where("false"), aims).used.count() == 0 and mixing.mix(docs, aims.where("false")).report.count() == 0


# ---- reading levels


def test_isotonic_is_monotone():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.random(200)
    steps = reading.isotonic(x, (x + rng.normal(0, 0.3, 200) > 0.5).astype(float))
    assert (np.diff(steps[1][::2]) > 0).all() and (np.diff(reading.step(np.linspace(0, 1, 50), steps)) >= 0).all()
    assert [v.tolist() for v in reading.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))] == [[1, 1, 2, 3, 4, 4], [0, 0, 0.5, 0.5, 1, 1]]


def test_probabilities_sum_to_one():
    model = reading.Graded.fit([(1, "il cane corre. il cane dorme."), (5, "il cane corre. la tesi permane.")])
    words = ["il", "cane", "corre"]
    total = sum(model.probabilities([[*words[:2], w]])[1][2] for w in [*model.vocabulary, "ignota"])
    assert (total <= 1.0 + 1e-5).all() and total[0] > 0.9 and total[4] > 0.9


def test_held_out_levels(spark):
    samples, docs, labels = (table(spark, DATA, t) for t in ("reading_samples", "documents", "reading_labels"))
    # Of samples alone, level 5 must already be told from the others.
    scale = reading.Scale.fit(samples.where("sample_id % 3 <> 0"), docs.where("false"), labels.where("false"))
    rows = scale.levels(samples.where("sample_id % 3 = 0"), "sample_id", "level").select("sample_id", F.col("difficulty")).collect()
    truth = {r.sample_id: r.level for r in samples.collect()}
    assert len(rows) > 30 and all((r.difficulty > 4.5) == (truth[r.sample_id] == 5) for r in rows)
    # Graded documents, half of them held out.
    scale = reading.Scale.fit(samples, docs, labels.where("doc_id % 2 = 0"))
    graded = docs.join(reading.grades(labels.where("doc_id % 2 = 1")), "doc_id").select("doc_id", "text", "grade")
    rows = scale.levels(graded, "doc_id", "grade").collect()
    assert len(rows) > 20 and sum(abs(r.difficulty - r.grade) <= 0.75 for r in rows) >= 0.85 * len(rows)


def test_levels_hard_inputs(spark):
    scale = reading.scale_for(spark, DATA)
    rows = {r.doc_id: r for r in scale.levels(hard(spark), "doc_id").collect()}
    assert len(rows) == len(HARD) + 2 and rows[0].level is None and rows[1].level is None and rows[3].level is not None

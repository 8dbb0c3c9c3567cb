"""Examples, dialogues, metrics, sources, sinks and stages on stated cases; the queries against their SQL on the small tables."""

import bz2
import json
import os
import uuid
import zipfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tramoggia.operators import dialogue, examples, metrics, stages
from tramoggia.plans import registry
from tramoggia.sources import files, sinks
from tramoggia.streaming import metrics as stream_metrics

DATA = "/root/testdata/sf0.001"


def test_supervised(spark):
    df = spark.createDataFrame([(list(range(10, 20)), [7, 8, 9], 8), ([1, 2], list(range(20)), 6), ([], [], 8)], "p array<long>, c array<long>, n int")
    rows = df.select(examples.supervised(F.col("p"), F.col("c"), F.col("n"), F.lit("tail")).alias("e")).collect()
    assert rows[0].e.input_ids == [1, 17, 18, 19, 7, 8, 9, 2] and rows[0].e.labels == [-100] * 4 + [7, 8, 9, 2]
    assert rows[1].e.input_ids == [1, 0, 1, 2, 3, 2] and rows[2].e.input_ids == [1, 2]


def test_blocks(spark):
    df = spark.createDataFrame([(1, list(range(2048)), 2048, 64), (2, [], 2048, 64)], "k int, ids array<long>, max_length int, min_tokens int")
    rows = examples.lm_examples(df, "ids", "k").collect()
    assert [(r.k, r.block, len(r.input_ids)) for r in rows] == [(1, 0, 2048)]


def test_router(spark):
    schema = "rid string, source string, format string, messages array<struct<role:string,content:string>>, prompt string, completion string, text string"
    turns = [("user", "u" * 30), ("assistant", "a" * 30), ("user", "v" * 30), ("assistant", "b" * 30)]
    rows = [
        ("all", "evol_instruct_italian", "chat", turns, None, None, None), ("last", "other", "chat", turns, None, None, None), ("lost", "evol_instruct_italian", "instruction", None, "p" * 40, "c" * 40, None),
        ("pair", "other", "qa", None, "p" * 40, "c" * 40, None), ("sft", "squad_it", "text", None, None, None, "t" * 90), ("lm", "fineweb2_it", "text", None, None, None, "t" * 90), ("short", "fineweb2_it", "text", None, None, None, "t"), ("null", None, None, None, None, None, None),
    ]
    made = examples.training_examples(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.rid, r.part, r.tokenization, r.format) for r in made) == [("all", 1, "chat", "chat"), ("all", 3, "chat", "chat"), ("last", 3, "chat", "chat"), ("lm", 0, "lm", "text"), ("pair", 0, "sft", "qa")]
    assert all(len(r.input_ids) == len(r.labels) == len(r.attention_mask) for r in made)


def test_batches(spark):
    schema = "k int, input_ids array<long>, labels array<long>, attention_mask array<long>"
    df = spark.createDataFrame([(1, [5, 6], None, None), (2, [1, 2, 3, 4], [1, 2, 3, 4], [1, 1, 1, 1]), (3, None, None, None)], schema)
    rows = {r.k: r for r in examples.padded(examples.batched(examples.truncated(df, 3), "k", 3)).collect()}
    assert rows[1].input_ids == [5, 6, 3] and rows[1].labels == [5, 6, -100] and rows[1].attention_mask == [1, 1, 0] and rows[2].input_ids == [2, 3, 4] and rows[3].labels == [-100] * 3
    assert rows[1].batch_tokens == 5 and examples.batched(df, "k", 2, drop_last=True).count() == 2
    assert examples.split(spark.range(50), "id").where("is_validation").count() == 1
    assert tuple(examples.steps(spark, 21, 2, 4, 3).first()) == (10, 9)


def test_windows_and_turns(spark):
    df = spark.createDataFrame([("f", 0, 5), ("f", 5, 8), ("f", 9, 10), ("g", 1, None), ("f", 1, 2)], "f string, start int, end int")
    assert sorted((r.start, r.end) for r in dialogue.merged_windows(df, "f").collect()) == [(0, 8), (9, 10)]
    lines = spark.createDataFrame([("f", k, t) for k, t in enumerate(["cmd a", "x", "y", "cmd b", "cmd c", "rep", "z"])], "f string, n int, line string")
    made = dialogue.turns(lines, ["f"], "n", F.col("line").startswith("cmd"), F.col("line") == "rep").orderBy("turn").collect()
    assert [(r.role, r.content) for r in made] == [("user", "cmd a"), ("assistant", "x"), ("user", "cmd b\ncmd c"), ("assistant", "rep")]


def test_subtitles(spark, tmp_path):
    text = "1\r\n00:00:01,000 --> 00:00:02,000\r\n<i>- Aldo, fammi</i>\r\nvedere [rumore]\r\n\r\n2\r\n00:00:03,000 --> 00:00:04,000\r\nEcco, signore è pronto\r\n\r\n\r\n3\r\n00:00:05,000 --> 00:00:06,000\r\nAltro\r\n"
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/uno.srt", text.encode("cp1252"))
        z.writestr("note.txt", "no")
    (tmp_path / "b.zip").write_bytes(b"broken")
    subtitles = dialogue.zipped_subtitles(spark, str(tmp_path))
    assert [r.line for r in dialogue.subtitle_lines(subtitles).orderBy("line_no").collect()] == ["Aldo, fammi vedere", "Ecco, signore è pronto", "Altro"]
    made = dialogue.interactions(subtitles, "Aldo").collect()
    assert [(r.scene, [tuple(m) for m in r.messages]) for r in made] == [(1, [("user", "Aldo, fammi vedere"), ("assistant", "Ecco, signore è pronto")])]
    seen = dialogue.reviewed(spark.createDataFrame([("# FILM: Uno\n[A]: ciao\nfuori\n----\n[B]: sì\n",)], "value string")).orderBy("scene", "line_no").collect()
    assert [(r.film, r.scene, r.speaker, r.content) for r in seen] == [("Uno", 0, "A", "ciao"), ("Uno", 0, "INFO", "fuori"), ("Uno", 1, "B", "sì")]
    assert dialogue.review_text(dialogue.interactions(subtitles, "Aldo")).first().value.startswith("# uno.srt | scene 1\nUSER: ")


def test_sources(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.txt").write_bytes(b"parola " * 40 + b"\xff")
    (tmp_path / "d" / "b.txt").write_text("corto")
    (tmp_path / "d" / "c.jsonl").write_text('{"prompt":"' + "p" * 30 + '","completion":"' + "c" * 30 + '"}\n{bad\n{"text":"x"}\n\n[]\n')
    texts = files.local_texts(spark, str(tmp_path / "d")).collect()
    assert [r.text for r in texts] == [("parola " * 40).strip()]
    samples = files.local_samples(spark, str(tmp_path / "d")).collect()
    assert [(r.format, r.source, r.language) for r in samples] == [("instruction", "local_import", "it")] and samples[0].text.startswith("<|user|>\nppp")
    page = "<mediawiki xmlns='http://x'><page><title>Roma</title><revision><text bytes='9'>" + "testo [[a|b]] " * 30 + "</text></revision></page><page><title>No</title><revision><text>x</text></revision></page></mediawiki>"
    (tmp_path / "dump.xml.bz2").write_bytes(bz2.compress(page.encode()))
    pages = files.dump_pages(spark, str(tmp_path / "dump.xml.bz2")).collect()
    assert [r.title for r in pages] == ["Roma"] and pages[0].text.startswith("Roma\ntesto b testo b")
    (tmp_path / "list.html").write_text('<a href="b-2.bz2">x</a><a href="b-1.bz2"><a href="c.txt">')
    listing = spark.read.text(str(tmp_path / "list.html"))
    assert files.dump_links(listing, "http://h/d/", r"\.bz2$", "f") == ["http://h/d/b-1.bz2", "http://h/d/b-2.bz2"] and files.dump_links(listing, "http://h/", "zip", "f") == ["f"]
    (tmp_path / "log.json").write_text(json.dumps({"history": [{"type": "train", "global_step": 2, "loss": 1.5}]}))
    assert [(r.position, r.type, r.loss) for r in files.run_log(spark, str(tmp_path / "log.json")).collect()] == [(0, "train", 1.5)]
    assert files.run_log(spark, str(tmp_path / "none.json")).count() == 0
    assert files.first_available([lambda: spark.read.parquet(str(tmp_path / "no")), lambda: listing]) is listing and set(files.isolated({"a": lambda: spark.read.parquet("/no"), "b": lambda: listing})) == {"b"}
    env = {"A": "7", "B": "Yes", "C": "", "D": "x"}
    assert [files.setting("A", 1, env), files.setting("B", False, env), files.setting("C", 3, env), files.setting("D", 4, env)] == [7, True, 3, 4] and files.included(" a; ;b") == ("a", "b")
    rows = spark.createDataFrame([("q", ["x", "y"], "1"), ("q", ["x", "y"], "5"), ("q", ["x"], "?"), ("q", ["x"], "-1")], "q string, c array<string>, g string")
    assert [r.m and r.m.completion for r in rows.select(files.multiple_choice(F.col("q"), F.col("c"), F.col("g")).alias("m")).collect()] == ["B) y", None, "A) x", None]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "text", "x\ny"), ("a", "text", " "), ("b", "qa", "z")], "source string, format string, rendered string")
    assert sinks.write_corpus(df, str(tmp_path / "c")) == 2
    with pytest.raises(ValueError):
        sinks.write_corpus(df.where("false"), str(tmp_path / "c"))
    made = {r.dataset: (r.records, r.shards) for r in sinks.write_shards(df, str(tmp_path / "s"), rows=1).collect()}
    assert made == {"a": (2, 2), "b": (1, 1)} and len([f for _, _, fs in os.walk(tmp_path / "s") for f in fs if f.endswith(".parquet")]) == 3
    sinks.write_samples(df.withColumnRenamed("source", "dataset"), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 3
    sinks.write_document(sinks.patched({"a": 1, "b": 2}, {"b": 3}), str(tmp_path / "x" / "s.json"))
    assert json.loads((tmp_path / "x" / "s.json").read_text()) == {"a": 1, "b": 3}


def test_metric_rules(spark):
    schema = spark.read.parquet(f"{DATA}/metrics_history.parquet").schema
    row = lambda step, kind, loss, at, stamp=None: {"run_id": "r", "type": kind, "global_step": step, "loss": loss, "received_at": at, "timestamp": stamp, "total_steps": 10}
    import datetime as dt

    t = lambda k: dt.datetime(2026, 1, 1, 0, 0, k)
    rows = [row(0, "train", 9.0, t(0)), row(1, "train", 5.0, t(1)), row(1, "train", 4.0, t(2)), row(2, "train", None, t(3)), row(3, "eval", 2.0, t(4)), row(4, "train", float("nan"), t(5))]
    history = spark.createDataFrame([{c: r.get(c) for c in schema.names} for r in rows], schema)
    got = {r.step: (r.train_loss, r.eval_loss) for r in metrics.pivot(history).collect()}
    assert got == {1: (4.0, None), 2: (0.0, None), 3: (None, 2.0), 4: (0.0, None)}
    gap = metrics.gaps(metrics.pivot(history)).first()
    assert (gap.step, gap.train_step, gap.eval_gap, gap.latest) == (3, 2, 2.0, True)
    trend = metrics.trends(history).first()
    assert trend.verdict == "raccolgo dati / rumoroso" and trend.best_step == 2
    assert metrics.periods(history, 3, 1).first().points == 2 and metrics.periods(history, 50, 60).count() == 0
    assert metrics.eta(history).first().eta_seconds is None and metrics.pivot(history.where("false")).count() == 0


def test_stream_equals_batch(spark, tmp_path):
    history = spark.read.parquet(f"{DATA}/metrics_history.parquet")
    history.repartition(3).write.parquet(str(tmp_path / "in"))
    log = stream_metrics.append_log(stream_metrics.log_stream(spark, str(tmp_path / "in"), history.schema), "test-" + uuid.uuid4().hex)
    a, b = metrics.pivot(spark.read.parquet(log)), metrics.pivot(history)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    query = stream_metrics.refreshed(stream_metrics.log_stream(spark, str(tmp_path / "in"), history.schema), str(tmp_path / "log"), metrics.pivot, str(tmp_path / "out"), 1)
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == b.count()


def test_stage_rules(spark):
    files_ = spark.createDataFrame([("b",), ("a",)], "content string")
    reverse = spark.createDataFrame([("a",), ("b",)], "content string")
    assert stages.fingerprint(files_).first() == stages.fingerprint(reverse).first()
    points = spark.createDataFrame([("p1", 1, 1, True, True), ("p3", 3, 3, False, True), ("p2", 2, 2, True, True)], "path string, step int, modified int, complete boolean, readable boolean")
    assert stages.latest_checkpoint(points).first().path == "p2" and [r.path for r in stages.expired(points, 2).collect()] == ["p1"]
    df = spark.createDataFrame([(10, 5, 0.0), (10, 10, 99.0), (11, 5, 31.0), (11, 5, 1.0)], "s int, l int, m double")
    assert [r.d for r in df.select(stages.checkpoint_due(F.col("s"), F.col("l"), F.col("m"), 5, 30).alias("d")).collect()] == [True, False, True, False]
    new = spark.createDataFrame([("a", 1)], "id string, v int")
    assert sorted(map(tuple, stages.upserted(spark.createDataFrame([("a", 0), ("b", 0)], "id string, v int"), new).collect())) == [("a", 1), ("b", 0)]


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    result = con.sql(registry.SQL[name])
    df = registry.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    assert columns == sorted(result.columns)
    plain = lambda v: round(v, 5) if isinstance(v, float) else v
    mine = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    place = [result.columns.index(c) for c in columns]
    assert mine == sorted((tuple(plain(r[k]) for k in place) for r in result.fetchall()), key=repr)

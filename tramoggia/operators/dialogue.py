"""Dialogues from timed text: lines, scenes around a name, turns, and the merging of windows.

The window functions here run within one file or document, which is a bounded unit; tables of any
number of files are spread by file.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator, Sequence
from io import BytesIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramoggia.functions import text as tx
from tramoggia.session import mapped

#: The order in which encodings are tried; the last accepts any bytes.
ENCODINGS = ("utf-8-sig", "utf-8", "cp1252", "latin-1")
SUBTITLES = (".srt", ".sub", ".ass")
TIMING = r"\d{1,2}:\d{2}:\d{2}[,.]\d{1,3}\s*-->\s*\d{1,2}:\d{2}:\d{2}[,.]\d{1,3}"
# Words that mark a command and a reply, beside the assistant's name.
COMMAND_CUES = ("ehi", "fammi", "metti", "mostrami", "prepara", "senti")
REPLY_CUES = (
    "analisi", "armatura", "calcolo", "caricamento", "completato", "diagnostica", "energia", "interfaccia", "online", "potenza", "protocollo",
    "reattore", "rilevo", "scansione", "signor stark", "signore", "sistema", "sto", "traiettoria",
)


def decoded(raw: bytes) -> str:
    """Bytes as text by the first encoding that fits."""
    for encoding in ENCODINGS:
        try:
            return raw.decode(encoding)
        except UnicodeDecodeError:
            continue
    return raw.decode("latin-1", "replace")


def zipped_subtitles(spark: SparkSession, path: str) -> DataFrame:
    """(archive, file, text): the subtitle files inside zip archives; broken archives give nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, str, str]] = []
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    with zipfile.ZipFile(BytesIO(content)) as z:
                        names = sorted(n for n in z.namelist() if n.lower().endswith(SUBTITLES))
                        rows += [(archive, re.split(r"[/\\]", n)[-1], decoded(z.read(n))) for n in names]
                except (zipfile.BadZipFile, NotImplementedError, RuntimeError):
                    continue
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], names=["archive", "file", "text"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").transform(mapped, run, "archive string, file string, text string")


def subtitle_lines(df: DataFrame, key: str = "file", text: str = "text") -> DataFrame:
    """(key, line_no, line): one line for each block of a subtitle file, without numbers, times and headers, numbered from 0."""
    plain = tx.strip(tx.replace(F.col(text), ("\r\n?", "\n")))
    blocks = df.select(key, F.posexplode(F.split(plain, rf"\n{tx.S}*\n+")).alias("_block", "_text"))
    kept = F.filter(F.transform(F.split("_text", "\n"), tx.strip), lambda x: (x != "") & ~x.rlike(r"^\p{Nd}+$") & ~x.rlike(TIMING) & ~x.startswith("[Script Info]") & ~x.startswith("[V4+ Styles]"))
    joined = tx.subtitle_line(F.array_join(F.transform(kept, lambda x: tx.replace(x, (r"^Dialogue:(?:[^,]*,){9}", ""))), " "))
    lines = blocks.select(key, "_block", joined.alias("line")).where("line <> ''")
    return lines.select(key, (F.row_number().over(Window.partitionBy(key).orderBy("_block")) - 1).alias("line_no"), "line")


def merged_windows(df: DataFrame, key: str, start: str = "start", end: str = "end") -> DataFrame:
    """(key, start, end): windows of one key that overlap or touch, as one; rows with a null bound are left out."""
    given = df.where(F.col(start).isNotNull() & F.col(end).isNotNull())
    order = Window.partitionBy(key).orderBy(start, end)
    reached = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = given.withColumn("_new", F.when(F.col(start) <= reached, 0).otherwise(1)).withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(key, "_island").agg(F.min(start).alias("start"), F.max(end).alias("end")).drop("_island")


def scenes(lines: DataFrame, key: str, hit: Column, before: int = 5, after: int = 12) -> DataFrame:
    """(key, scene, start, end): merged windows of lines around the lines where `hit` holds, numbered from 1."""
    sizes = lines.groupBy(key).agg((F.max("line_no") + 1).alias("_n"))
    around = lines.where(hit).join(sizes, key).select(key, F.greatest(F.lit(0), F.col("line_no") - before).alias("start"), F.least(F.col("_n"), F.col("line_no") + after + 1).alias("end"))
    return merged_windows(around, key).withColumn("scene", F.row_number().over(Window.partitionBy(key).orderBy("start"))).select(key, "scene", "start", "end")


def cued(line: Column, cues: Sequence[str]) -> Column:
    low = F.lower(line)
    out = F.lit(False)
    for cue in cues:
        out = out | low.contains(cue)
    return out


def turns(df: DataFrame, keys: Sequence[str], order: str, command: Column, reply: Column, text: str = "line") -> DataFrame:
    """(keys…, turn, role, content): user turns from commands, assistant turns from replies and from any line right
    after a command; other lines are dropped, and lines of one role in a row are one turn. Only groups with both roles stay."""
    inside = Window.partitionBy(*keys).orderBy(order)
    flagged = df.withColumns({"_cmd": F.coalesce(command, F.lit(False)), "_rep": F.coalesce(reply, F.lit(False))})
    awaited = F.coalesce(F.lag("_cmd").over(inside), F.lit(False))
    role = F.when(F.col("_cmd"), "user").when(F.col("_rep") | awaited, "assistant")
    spoken = flagged.withColumn("role", role).where(F.col("role").isNotNull() & (F.coalesce(text, F.lit("")) != ""))
    change = F.when(F.lag("role").over(inside) == F.col("role"), 0).otherwise(1)
    numbered = spoken.withColumn("_change", change).withColumn("turn", F.sum("_change").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    said = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))), lambda x: x["t"]), "\n")
    merged = numbered.groupBy(*keys, "turn", "role").agg(said.alias("content"))
    both = merged.groupBy(*keys).agg(F.count_distinct("role").alias("_roles")).where("_roles = 2").drop("_roles")
    return merged.join(both, list(keys), "left_semi").select(*keys, "turn", "role", "content")


def interactions(subtitles: DataFrame, name: str, commands: Sequence[str] = COMMAND_CUES, replies: Sequence[str] = REPLY_CUES) -> DataFrame:
    """(file, scene, messages): chat samples from subtitle files around the lines with the assistant's `name`."""
    spelled = r"(?iu)(?U)\b" + re.escape(name) + r"\b|" + r"\.?\s*".join(map(re.escape, name)) + r"\.?"
    lines = subtitle_lines(subtitles)
    hit = F.col("line").rlike(spelled)
    around = scenes(lines, "file", hit).withColumnRenamed("file", "_f")
    inside = lines.join(around, (F.col("file") == F.col("_f")) & (F.col("line_no") >= F.col("start")) & (F.col("line_no") < F.col("end"))).drop("_f")
    said = turns(inside, ["file", "scene"], "line_no", hit | cued(F.col("line"), commands), cued(F.col("line"), replies))
    packed = F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "content"))), lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return said.groupBy("file", "scene").agg(packed.alias("messages"))


def review_text(samples: DataFrame) -> DataFrame:
    """(file, scene, value): samples as text for reading, one block each."""
    body = F.array_join(F.transform("messages", lambda m: F.concat(F.upper(m["role"]), F.lit(": "), m["content"])), "\n")
    return samples.select("file", "scene", F.concat_ws("\n", F.concat(F.lit("# "), F.col("file"), F.lit(" | scene "), F.col("scene").cast("string")), body).alias("value"))


def reviewed(df: DataFrame, text: str = "value") -> DataFrame:
    """(film, scene, line_no, speaker, content): parsed dialogue texts with `# FILM: ` headers, scenes parted by lines of
    dashes or equals signs and `[SPEAKER]: text` lines; other lines are the speaker INFO's."""
    films = df.select(F.explode(F.slice(F.split(F.col(text), r"(?m)^# FILM: "), 2, 1 << 20)).alias("_film"))
    named = films.select(tx.strip(F.substring_index("_film", "\n", 1)).alias("film"), F.posexplode(F.split(F.expr("substring(_film, locate('\n', _film) + 1)"), r"(?m)^[-=]{3,}[ \t]*$")).alias("scene", "_scene"))
    lines = named.select("film", "scene", F.posexplode(F.split("_scene", "\n")).alias("line_no", "_line")).where(tx.strip(F.col("_line")) != "")
    speaker = F.regexp_extract("_line", r"^\s*\[([^\]]+)\]:", 1)
    return lines.select("film", "scene", "line_no", F.when(speaker == "", "INFO").otherwise(speaker).alias("speaker"), tx.strip(F.regexp_replace("_line", r"^\s*\[[^\]]+\]:", "")).alias("content"))

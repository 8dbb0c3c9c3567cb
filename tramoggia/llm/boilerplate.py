"""Main content of web pages by template deduction from equivalence classes of tokens.

A token is a piece of a line between separators or sentence ends, with digits, names and the site's
own name masked, hashed; it stands for a run of fixed words, whose number it carries. Over the pages of
one site every token has an occurrence vector, and tokens with equal vectors form an equivalence class.
Vectors are never built: their signature (number of pages and xor of the pages' hashes) is aggregated
map-side, so the pages of one site, however many, are never gathered in a task.

A class is valid if it is large (words) and frequent (pages), bound to its site rather than to the language
(its rate among the pages of other sites is far lower), and no article delivered several times.
The valid classes of a site are its template. On a page, a class's tokens must stand in the class's order, classes
must nest (crossing ones give way to the more frequent), and what the template leaves open are slots: a slot
without prose inside a class is the site's, titles behind a class that opens such a slot are its
links, the rest is the body. Tokens of sites with too few pages for classes of their own are looked up in the
pool: tokens that form valid classes wherever they are frequent, hold the page's end on many sites, or name
the site. Phrases break ties only: between tokens that recur on all sites alike, of titles and of links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramoggia.llm import furniture as fu
from tramoggia.operators.joins import lookup
from tramoggia.session import mapped, stage, table

#: A valid class has this many words (masks don't count) on this many pages, or fewer words on more pages.
CLASS_WORDS, CLASS_PAGES, SMALL_CLASS_PAGES = 3, 3, 5
#: It is bound to its site if its pages exceed what the other sites' rate lets expect by so many deviations, and so many times ...
BOUND_Z, BOUND_LIFT = 5.0, 2.5
#: ... more deviations if its words are few.
SMALL_CLASS_Z = 6.0
#: ... or if it is on this share of the site's pages.
EVERYWHERE = 0.6
#: A class of more words, or of so many sentences of paragraphs, is an article delivered several times.
ARTICLE_WORDS, ARTICLE_SENTENCES = 60, 3
#: A token is pooled if this share of its pages is on sites where its class is valid, and these are so many.
POOL_SHARE, POOL_SITES = 0.5, 3
#: ... or if, over all sites, it is on this share of the other pages of its sites, at such a ratio of odds to all pages ...
POOL_RATE, POOL_LIFT = 0.2, 3.0
#: ... or if it stands in the last part of its pages everywhere, by mean and deviation of its place.
LAST_PLACE, LAST_SPREAD = 0.82, 0.16
#: A page with so many sentences of paragraphs that other pages of its site have too, at least half of all, holds a delivered-again article ...
COPIED_SENTENCES = 6
#: ... and classes of its site on at most so many times the pages of such a sentence (the median) are the article's.
COPIES = 3
#: Keys up to this number (20 bytes each) are sent to all executors; more are joined by shuffle.
BROADCAST_KEYS = 500_000

# Kinds of keys: in a valid class of the site; pooled; a sentence on several pages of the site, in no valid class; recurring on any sites.
TEMPLATE, POOLED, REPEATED, RECURRING = 1, 2, 4, 8
# The lowest byte of a token: a sentence of a paragraph, names the site, its words.
_PARAGRAPH, _NAMED, _WORDS = 0x80, 0x40, 0x3F

_SCHEMA = "rec_id bigint, page bigint, site bigint, line_no array<int>, bits array<int>, tok array<bigint>, tok_line array<int>, tok_pos array<float>"
# Patterns begun by a character or a class of them skip fast what can't match.
_DIGITS = re.compile(r"\d\d*")
_NAME = re.compile(r" (?<=[\w,;'’§@] )[^\W\d_a-zß-öø-ÿ][\w'’]*")
_NAMES = re.compile(r"[§@](?: [§@])+")
# A label before the text of a line is a piece of its own.
_LABEL = re.compile(r"^(\[[^\[\]]+\]|[^\W\d][^\W\d ]*(?: [^\W\d ]+){0,3} ?>|→)\s+")
_HOST = re.compile(r"[a-z]{4,}")


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


class Host:
    """The words of a site's address, by which its own name is known."""

    def __init__(self, site: str | None):
        self.words = tuple(sorted(set(_HOST.findall((site or "").lower())) - {"http", "https", "test", "example", "invalid"}, key=len, reverse=True))
        self._pattern = re.compile("|".join(self.words), re.I)

    def named(self, text: str) -> bool:
        low = text.lower()
        for w in self.words:
            if w in low:
                return True
        return False

    def masked(self, text: str) -> str:
        return self._pattern.sub("§", text) if self.named(text) else text


def tokens_of(text: str, bits: int, host: Host) -> list[int]:
    """The tokens of a line without tags, one for each of its masked pieces; a paragraph's sentences are told from lines of the same words."""
    kind = _PARAGRAPH if bits & fu.PROSE and not bits & fu.CUE else 0
    if label := _LABEL.match(text):
        text = f"{label[1]} | {text[label.end() :]}"
    text = host.masked(text)
    if not text.isupper():
        text = _NAME.sub(" @", text)
    text = _DIGITS.sub("#", text)
    if "@ " in text or "§ " in text:
        text = _NAMES.sub(lambda m: "§" if "§" in m[0] else "@", text)
    text = text.lower().replace("’", "'")
    out = []
    for piece in fu.pieces(text):
        if len(piece) > 8 or "# #" in piece or piece == "→" or sum(map(str.isalpha, piece)) > 1:
            named = piece.count("§")
            words = piece.count(" ") + 1 - named - piece.count("@") - piece.count("#")
            out.append(_signed(xxhash.xxh64_intdigest(piece) & ~0xFF | kind | (_NAMED if named else 0) | min(max(words, 0), _WORDS)))
    return out


#: Tokens of short lines (with the host of those that name their site), of a Python worker, whose tasks share them.
_KNOWN: dict[object, list[int]] = {}


def _tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages to their lines' marks and tokens; a token's place on its page is -1 where it comes again."""
    hosts: dict[str, Host] = {}
    types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.float32())]
    names = ["rec_id", "page", "site", "line_no", "bits", "tok", "tok_line", "tok_pos"]
    for batch in batches:
        cols: list[list] = [[] for _ in names]
        for rec_id, site, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if site not in hosts:
                if len(hosts) > 10_000:
                    hosts.clear()
                hosts[site] = Host(site)
            host = hosts[site]
            numbers, bits, tok, tok_line = [], [], [], []
            for number, line in enumerate((text or "").split("\n"), 1):
                if not line.strip():
                    continue
                plain, mark = fu.marks(line)
                row = len(numbers)
                numbers.append(number)
                bits.append(mark)
                if len(plain) > 120:
                    got = tokens_of(plain, mark, host)
                else:
                    # Short lines recur; those that name the site are known by site.
                    key = (plain, host.words) if host.named(plain) else plain
                    got = _KNOWN.get(key)
                    if got is None:
                        if len(_KNOWN) > 200_000:
                            _KNOWN.clear()
                        got = _KNOWN[key] = tokens_of(plain, mark, host)
                tok.extend(got)
                tok_line.extend([row] * len(got))
            last, seen, tok_pos = max(1, len(numbers) - 1), set(), []
            for t, k in zip(tok, tok_line):
                tok_pos.append(-1.0 if t in seen else k / last)
                seen.add(t)
            page = xxhash.xxh64_intdigest(f"{rec_id} {site} {text}")
            for col, value in zip(cols, (rec_id, _signed(page), _signed(xxhash.xxh64_intdigest(site or "")), numbers, bits, tok, tok_line, tok_pos)):
                col.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def _sums() -> list[Column]:
    return [F.count("*").alias("hits"), F.sum("pos").alias("pos"), F.sum(F.col("pos") * F.col("pos")).alias("pos2")]


def template(pages: DataFrame) -> DataFrame:
    """(site, tok, kind, support, class, place): the keys by which pages are taken apart, from tokenized pages.

    A null site stands for all sites. The order of a class is that of its tokens' mean places. Tables with a row a
    token are merged, never broadcast: the planner takes them for as small as their compressed files.
    """
    total, distinct = pages.select(F.count("*"), F.count_distinct("page")).first()
    if distinct < total:
        # Pages delivered several times count once.
        pages = stage(pages.dropDuplicates(["page"]), "distinct-pages")
        total = distinct
    sizes = pages.groupBy("site").agg(F.count("*").alias("pages"))
    each = pages.select("site", "page", F.explode(F.arrays_zip("tok", "tok_pos")).alias("t")).select("site", "page", F.col("t.tok").alias("tok"), F.col("t.tok_pos").alias("pos")).where("pos >= 0")
    words, paragraph, named = F.col("tok").bitwiseAND(_WORDS), F.col("tok").bitwiseAND(_PARAGRAPH) != 0, F.col("tok").bitwiseAND(_NAMED) != 0
    # Tokens of several pages of a site; those of one page don't count for any class.
    in_site = stage(each.groupBy("site", "tok").agg(*_sums(), F.bit_xor("page").alias("vector")).where("hits > 1"), "site-tokens")
    overall = stage(each.groupBy("tok").agg(*_sums()).where("hits >= 3"), "all-tokens")
    rated = lookup(in_site.where("hits >= 3"), sizes, "site", "inner").join(overall.select("tok", F.col("hits").alias("all_hits")).hint("merge"), "tok")
    others = F.lit(float(total)) - F.col("pages")
    outside = F.when(others > 0, (F.col("all_hits") - F.col("hits")) / others).otherwise(F.lit(0.0))
    rated = rated.select("site", "tok", "hits", "vector", "pages", outside.alias("outside"), (F.col("pos") / F.col("hits")).alias("place"))
    classes = rated.groupBy("site", "vector", "hits").agg(
        F.sum(words).alias("words"), F.sum(paragraph.cast("int")).alias("sentences"), F.avg("outside").alias("outside"), F.first("pages").alias("pages")
    )
    article = (F.col("words") > ARTICLE_WORDS) | (F.col("sentences") >= ARTICLE_SENTENCES)
    expected = F.col("pages") * F.col("outside")
    bound = ((F.col("hits") - expected) / F.sqrt(expected + 0.25) >= F.when(F.col("words") >= CLASS_WORDS, BOUND_Z).otherwise(SMALL_CLASS_Z)) & (F.col("hits") >= BOUND_LIFT * expected)
    frequent = F.when(F.col("words") >= CLASS_WORDS, CLASS_PAGES).otherwise(SMALL_CLASS_PAGES)
    # Without other pages to compare with, only what is on most pages is bound.
    valid = (F.col("hits") >= frequent) & (F.when(F.col("pages") < total, bound).otherwise(F.lit(False)) | (F.col("hits") >= EVERYWHERE * F.col("pages")))
    kind = F.when(article & (F.col("hits") < EVERYWHERE * F.col("pages")), REPEATED).when(valid, TEMPLATE)
    classes = classes.select("site", "vector", "hits", kind.alias("kind"), F.xxhash64("vector", "hits").bitwiseAND(0x7FFFFFFF).cast("int").alias("class")).where("kind is not null")
    own = stage(rated.join(classes.hint("merge"), ["site", "vector", "hits"]).select("site", "tok", "kind", F.col("hits").alias("support"), "class", F.col("place").cast("float").alias("place")), "site-classes")
    # The pool: how the pages of a token lie over sites. A token's sites with one page aren't in in_site, but follow from the sums.
    apart = F.col("hits") * (F.col("hits") - 1) / F.greatest(F.col("pages") - 1, F.lit(1))
    spread = lookup(in_site, sizes, "site", "inner").groupBy("tok").agg(F.sum("hits").alias("gathered"), F.count("*").alias("sites"), F.sum(apart).alias("rate"))
    made = own.where(F.col("kind") == TEMPLATE).groupBy("tok").agg(F.sum("support").alias("valid"), F.count("*").alias("valid_sites"))
    rows = overall.join(spread.hint("merge"), "tok", "left").join(made.hint("merge"), "tok", "left").fillna(0, ["gathered", "sites", "rate", "valid", "valid_sites"])
    hits, mean, share = F.col("hits"), F.col("pos") / F.col("hits"), F.col("hits") / F.lit(float(max(1, total)))
    sites, rate = hits - F.col("gathered") + F.col("sites"), F.least(F.col("rate") / hits, F.lit(1.0))
    deviation = F.sqrt(F.greatest(F.lit(0.0), F.col("pos2") / hits - mean * mean))
    shared = (F.col("valid") >= POOL_SHARE * hits) & (F.col("valid_sites") >= POOL_SITES)
    lift = rate * (1.0 - share + 1e-9) / ((1.0 - rate + 1e-9) * share)
    alike = (rate >= POOL_RATE) & (lift >= POOL_LIFT) & (hits >= 4) & (sites >= POOL_SITES)
    last = (sites >= 5) & (hits >= 20) & (mean >= LAST_PLACE) & (deviation <= LAST_SPREAD)
    names = (sites >= 5) & (hits >= 10) & named
    pool = rows.select(
        F.lit(None).cast("bigint").alias("site"), "tok", F.when(shared | alike | last | names, POOLED).otherwise(RECURRING).alias("kind"), hits.alias("support"), F.lit(0).alias("class"), mean.cast("float").alias("place")
    )
    again = in_site.where(paragraph).join(own.hint("merge"), ["site", "tok"], "left_anti").select("site", "tok", F.lit(REPEATED).alias("kind"), F.col("hits").alias("support"), F.lit(0).alias("class"), F.lit(0.0).cast("float").alias("place"))
    return own.unionByName(again).unionByName(pool.where(~paragraph | (F.col("kind") == POOLED)))


class Line:
    """What the keys say about a line of a page: the shares of its tokens that are the template's, or recur anywhere."""

    __slots__ = ("template", "recurring")

    def __init__(self, template: float = 0.0, recurring: float = 0.0):
        self.template, self.recurring = template, recurring


def removable(bits: list[int], lines: list[Line], slots: Sequence[tuple[int, int]] = ()) -> list[bool]:
    """Which lines of one page are furniture: those of the template and its slots. `slots` are (first, last) lines of classes."""
    n = len(bits)
    # A phrase breaks the tie of what recurs on all sites alike, as both headings and some notices do.
    out = [s.template >= 0.5 or bool(b & (fu.CUE | fu.LINK)) and s.recurring >= 0.5 for s, b in zip(lines, bits)]
    if any(b & fu.BODY_TAG for b in bits) or sum(bool(b & fu.SITE_TAG) for b in bits) * 2 > n:
        return [bool(b & fu.SITE_TAG) or not b & fu.BODY_TAG and f for b, f in zip(bits, out)]
    prose = [bool(b & fu.PROSE) and not b & fu.TEASER and not f for b, f in zip(bits, out)]
    for first, last in slots:
        inside = range(first + 1, last)
        if not any(prose[k] for k in inside) and 2 * sum(not out[k] for k in inside) <= last - first + 1:
            for k in inside:
                out[k] = True
    text = [k for k in range(n) if prose[k]]
    seen = False
    k = 0
    while k < n:
        seen |= prose[k]
        if not (bits[k] & fu.BOX and out[k]):
            k += 1
            continue
        # The slot that a class of links opens.
        end = k + 1
        numbered = end < n and bits[end] >> fu.NUMBER_SHIFT == 1
        while end < n and not out[end] and not prose[end] and bits[end] & (fu.TITLE | fu.TEASER):
            if bits[end] & fu.LISTED and not bits[end] & fu.TEASER or numbered and bits[end] >> fu.NUMBER_SHIFT != end - k:
                break
            end += 1
        stop = end
        # Entries of a box look alike; a title of another look before the text is the article's.
        if not numbered and end - k > 2 and end < n and not out[end]:
            first, last = bits[k + 1] & fu.TEASER, bits[end - 1] & fu.TEASER
            if first and not last or end - k > 3 and not seen and not first:
                stop = end - 1
        for j in range(k + 1, stop):
            out[j] = True
        k = end
    if text:
        # Link titles without a heading stand after the last paragraph, next to furniture.
        k = text[-1] + 1
        while k < n:
            end = k
            while end < n and not out[end] and bits[end] & fu.HEADLINE:
                end += 1
            if end > k and (end == n or out[end]) and (out[k - 1] or k - 1 == text[-1]) and (end < n or out[k - 1]):
                for j in range(k, end):
                    out[j] = True
            k = end + 1
    return out


def taken_apart(bits: list[int], tok: list[int], tok_line: list[int], own: list[tuple[int, int, int, float]], pooled: list[tuple[int, int]]) -> tuple[list[Line], list[tuple[int, int]]]:
    """The lines of one page and the slots of its classes.

    `own` has (kind, support, class, place) of each token on its site (kind 0: none), `pooled` its kind and support in the pool.
    """
    n = len(bits)
    total, known, recurring = [0] * n, [0] * n, [0] * n
    sentences = sum(t & _PARAGRAPH != 0 for t in tok)
    repeated = sorted(support for t, (kind, support, _, _) in zip(tok, own) if kind and t & _PARAGRAPH)
    copies = COPIES * repeated[len(repeated) // 2] + 1 if len(repeated) >= COPIED_SENTENCES and 2 * len(repeated) >= sentences else 0
    spans: dict[int, list] = {}
    seen: set[int] = set()
    for t, line, (kind, support, name, place), (pool, pages) in zip(tok, tok_line, own, pooled):
        total[line] += 1
        mine = kind == TEMPLATE and support > copies
        if mine:
            span = spans.get(name)
            if span is None:
                spans[name] = [line, line, place, support]
            elif t not in seen:
                # Out of the class's order it isn't that class's token.
                mine = place >= span[2] - 1e-6
                if mine:
                    span[1], span[2] = line, place
        seen.add(t)
        if mine or pool == POOLED and pages > copies:
            known[line] += 1
        if mine or pool or kind:
            recurring[line] += 1
    slots: list[tuple[int, int]] = []
    for first, last, _, _ in sorted(spans.values(), key=lambda s: -s[3]):
        # Classes nest: one that crosses a more frequent one opens no slot.
        if last > first + 1 and not any(a < first < b < last or first < a < last < b for a, b in slots):
            slots.append((first, last))
    return [Line(k / t if t else 0.0, r / t if t else 0.0) for k, r, t in zip(known, recurring, total)], slots


_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(site: np.ndarray, tok: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = site.view(np.uint64) * _M1 ^ tok.view(np.uint64) * _M2
        return h ^ (h >> np.uint64(29))


class Keys:
    """The keys as sorted arrays, to look up many tokens at once."""

    def __init__(self, keys: pa.Table):
        site, tok, kind, support, name, place = (keys.column(c).combine_chunks() for c in ("site", "tok", "kind", "support", "class", "place"))
        mine = site.is_valid().to_numpy(zero_copy_only=False)
        tokens, kinds = tok.to_numpy(zero_copy_only=False), kind.to_numpy(zero_copy_only=False).astype(np.uint8)
        mixed = _mixed(site.fill_null(0).to_numpy(zero_copy_only=False)[mine], tokens[mine])
        order = np.argsort(mixed)
        self.own = mixed[order]
        values = [kinds, support.to_numpy(zero_copy_only=False), name.to_numpy(zero_copy_only=False), place.to_numpy(zero_copy_only=False)]
        # A last entry for tokens that aren't there.
        self.values = [np.append(v[mine][order], v.dtype.type(0)) for v in values]
        order = np.argsort(tokens[~mine])
        self.pool = tokens[~mine][order]
        self.pooled = [np.append(v[~mine][order], v.dtype.type(0)) for v in values[:2]]

    @staticmethod
    def _at(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(wanted), np.int64)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, at, len(keys))

    def find(self, site: np.ndarray, tok: np.ndarray) -> tuple[list[tuple], list[tuple]]:
        at, pool = self._at(self.own, _mixed(site, tok)), self._at(self.pool, tok)
        return list(zip(*(v[at].tolist() for v in self.values))), list(zip(*(v[pool].tolist() for v in self.pooled)))


def _decide(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = sent.value
        for batch in batches:
            tok = batch.column(4)
            off, flat = tok.offsets.to_numpy() - tok.offsets[0].as_py(), tok.flatten().to_numpy(zero_copy_only=False)
            site = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), np.diff(off))
            yield _lines(batch, off, *keys.find(site, flat))

    return run


def _decide_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tok = batch.column(4)
        off = tok.offsets.to_numpy() - tok.offsets[0].as_py()
        own, pooled = [(0, 0, 0, 0.0)] * int(off[-1]), [(0, 0)] * int(off[-1])
        for k, hits in enumerate(batch.column(6).to_pylist()):
            for h in hits or ():
                at = off[k] + h["k"]
                own[at] = (h["kind"] or 0, h["support"] or 0, h["class"] or 0, h["place"] or 0.0)
                pooled[at] = (h["pooled"] or 0, h["pages"] or 0)
        yield _lines(batch, off, own, pooled)


def _lines(batch: pa.RecordBatch, off: np.ndarray, own: list[tuple], pooled: list[tuple]) -> pa.RecordBatch:
    """The rows (rec_id, line_no) to remove; columns: rec_id, site, line_no, bits, tok, tok_line."""
    ids, numbers = [], []
    for k, (rec_id, no, bits, tok, line) in enumerate(zip(*(batch.column(j).to_pylist() for j in (0, 2, 3, 4, 5)))):
        if no:
            part = slice(off[k], off[k + 1])
            for number, gone in zip(no, removable(bits, *taken_apart(bits, tok, line, own[part], pooled[part]))):
                if gone:
                    ids.append(rec_id)
                    numbers.append(number)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int64())], names=["rec_id", "line_no"])


def furniture_lines(df: DataFrame, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """(rec_id, line_no) of the lines that the site adds to its pages.

    `df` needs rec_id, site and text; other columns are ignored. Lines lie between line feeds and
    count from 1; blank lines are never returned. Null, empty and blank texts have no lines; a null
    site counts as one site. Rows delivered again (same rec_id and text) count once, for the template and
    in the result (distinct rows). An empty table gives an empty result.
    """
    spark = df.sparkSession
    pages = stage(df.select("rec_id", "site", "text").transform(mapped, _tokenize, _SCHEMA), "page-tokens")
    keys = stage(template(pages), "template-keys")
    return remove_with(spark, pages, keys, broadcast_keys).distinct()


def remove_with(spark: SparkSession, pages: DataFrame, keys: DataFrame, broadcast_keys: int) -> DataFrame:
    """The removable lines of tokenized pages, given the template's keys."""
    rows = pages.select("rec_id", "site", "line_no", "bits", "tok", "tok_line")
    if keys.count() <= broadcast_keys:
        sent = spark.sparkContext.broadcast(Keys(keys.toArrow()))
        return rows.transform(mapped, _decide(sent), "rec_id bigint, line_no bigint")
    page = pages.select("rec_id", "page", "site", "line_no", "bits", "tok", "tok_line").dropDuplicates(["page"])
    each = page.select("page", "site", F.posexplode("tok").alias("k", "tok")).withColumn("key", F.xxhash64("site", "tok"))
    own = keys.where("site is not null").withColumn("key", F.xxhash64("site", "tok")).drop("site", "tok")
    pool = keys.where("site is null").select("tok", F.col("kind").alias("pooled"), F.col("support").alias("pages"))
    found = lookup(lookup(each, own, "key"), pool, "tok").where("kind is not null or pooled is not null")
    hit = found.groupBy("page").agg(F.collect_list(F.struct("k", "kind", "support", "class", "place", "pooled", "pages")).alias("hit"))
    joined = page.join(hit.hint("merge"), "page", "left").select("rec_id", "site", "line_no", "bits", "tok", "tok_line", "hit")
    return joined.transform(mapped, _decide_joined, "rec_id bigint, line_no bigint")


def with_furniture(df: DataFrame) -> DataFrame:
    """`df` with the column gone, array<bigint>: the numbers of each page's furniture lines, empty if it has none.

    `df` needs unique rec_ids, site and text. The lists are written once; the join keeps every row, and merges, as the
    lists are far larger than their compressed files.
    """
    lines = furniture_lines(df).groupBy("rec_id").agg(F.collect_set("line_no").alias("gone"))
    return df.join(stage(lines, "furniture").hint("merge"), "rec_id", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<bigint>")))


def taken_away(bits: list[int], plains: list[str], numbers: list[int], gone: list[int] | None) -> list[bool]:
    """Which lines of a text are furniture: those of `gone`, by number; without a site (None) those that their phrases tell."""
    if gone is not None:
        known = set(gone)
        return [k in known for k in numbers]
    return removable(bits, [Line(1.0) if fu.site_line(p, b) else Line() for p, b in zip(plains, bits)])


def p1_found(spark: SparkSession, directory: str) -> DataFrame:
    """The furniture lines of all pages of fineweb2_it."""
    return furniture_lines(table(spark, directory, "fineweb2_it"))

"""Text functions as column expressions; patterns keep to linear-time forms that Java can't recurse on.

White space is spelled out as Python's `\\s` and `strip` know it, `(?d)` keeps dots from stopping at
other line ends than a line feed, and `(?iu)` folds case beyond ASCII. Null texts give null.
"""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

#: White space, as a class and its complement.
S = r"[\t-\r\x1c-\x20\x85\xa0  -     　]"
NS = r"[^\t-\r\x1c-\x20\x85\xa0  -     　]"

# The phrases, file endings and symbols that the cleaning rules name.
WEB_PHRASES = (
    "accetta tutti", "archivio", "categorie", "commenti", "continua a leggere", "cookie", "copyright", "iscriviti", "lascia un commento",
    "leggi tutto", "newsletter", "posted by", "privacy policy", "pubblicato da", "registrati", "termini e condizioni", "tag:",
)
NAVIGATION_PHRASES = ("home", "menu", "login", "logout", "cerca", "search", "rss", "feed", "precedente", "successivo", "condividi", "facebook", "twitter", "instagram")
WEB_NOTICES = ("cookie", "privacy policy", "termini e condizioni", "accetta tutti", "newsletter", "javascript", "browser non supportato")
SERVICE_SECTIONS = ("Note", "Bibliografia", "Voci correlate", "Altri progetti", "Collegamenti esterni")
MEDIA = ("ogg", "oga", "mp3", "jpg", "jpeg", "png", "svg", "gif", "webm", "pdf")
NOISE_SYMBOLS = "*=_~#|{}[]<>"
ROLES = ("system", "user", "assistant", "context", "answer", "end")

URL = rf"https?://{NS}+|www\.{NS}+"
# A run is a symbol, a counted number of further ones, and then a class alone: no unbounded group, on which Java would recurse.
_SYMBOL = r"[*\-=~_#.]"
_REST = S.replace("[", r"[*\-=~_#.", 1)
SEPARATOR_LINE = rf"^{S}*+{_SYMBOL}(?:{S}*+{_SYMBOL}){{7}}{_REST}*+$"
SYMBOL_RUN = rf"{_SYMBOL}(?:{S}*+{_SYMBOL}){{9}}{_REST}*+"
REPEATED_WORD = rf"(?iu)(?U)\b([A-Za-zÀ-ÿ]{{3,}})(?:{S}+\1\b){{5}}"
ROLE_TOKEN = r"<\|(?:" + "|".join(ROLES) + r")\|>"
_MEDIA = "(?:" + "|".join(MEDIA) + ")"


def words_pattern(phrases: tuple[str, ...]) -> str:
    """A pattern for any of the phrases between word bounds, in any case."""
    return r"(?iu)(?U)\b(?:" + "|".join(p.replace(".", r"\.") for p in phrases) + r")\b"


def replace(text: Column, *steps: tuple[str, str]) -> Column:
    """The regular replacements one after the other."""
    for pattern, by in steps:
        text = F.regexp_replace(text, F.lit(pattern), F.lit(by))
    return text


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return replace(text, (rf"^{S}+|{S}+$", ""))


def bound(value: Column, function) -> Column:
    """`function` of a value that is computed once, however often the function names it."""
    return F.get(F.transform(F.array(value), function), F.lit(0))


def kept_lines(text: Column, keep) -> Column:
    """The lines for which `keep` (column to condition) holds."""
    return F.array_join(F.filter(F.split(text, "\n"), keep), "\n")


@F.pandas_udf(StringType())
def _compose(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


@F.pandas_udf(StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None or "&" not in t else html.unescape(t))


MESSAGES = ArrayType(StructType([StructField("role", StringType()), StructField("content", StringType())]))


@F.pandas_udf(MESSAGES)
def _prepare(rows: pd.Series) -> pd.Series:
    ready = lambda t: None if t is None else unicodedata.normalize("NFC", html.unescape(t))
    return rows.map(lambda row: None if row is None else [{"role": m["role"], "content": ready(m["content"])} for m in row])


def prepared(messages: Column) -> Column:
    """Messages with unescaped contents in NFC, for cleaning by `pure` functions: UDFs can't work inside arrays."""
    return _prepare(messages)


def nfc(text: Column, pure: bool = False) -> Column:
    """Unicode form NFC; Spark has no such function, so this one goes through Arrow, unless the text is said to be prepared."""
    return text if pure else _compose(text)


def unescape(text: Column, pure: bool = False) -> Column:
    """HTML entities as characters; the table of names is only found outside the JVM."""
    return text if pure else _unescape(text)


def _lines_stripped(text: Column) -> Column:
    return F.array_join(F.transform(F.split(text, "\n"), strip), "\n")


def whitespace(text: Column) -> Column:
    """Line feeds only, single blanks, stripped lines, at most one empty line in a row."""
    plain = replace(text, ("\r\n?", "\n"), ("[ \t]+", " "))
    return strip(replace(_lines_stripped(plain), ("\n{3,}", "\n\n")))


def tidy(text: Column) -> Column:
    """`surface` for text already in NFC."""
    return whitespace(replace(text, ("\r\n?", "\n"), (r"[\x00-\x08\x0b\x0c\x0e-\x1f\xa0]", " ")))


def surface(text: Column, pure: bool = False) -> Column:
    """NFC, control characters and hard blanks as blanks, then `whitespace`."""
    return tidy(nfc(text, pure))


def surface_flat(text: Column, pure: bool = False) -> Column:
    """`surface` on one line."""
    return strip(replace(nfc(text, pure), ("\r\n?", "\n"), (r"[\x00-\x08\x0b\x0c\x0e-\x1f\xa0]", " "), (rf"{S}+", " ")))


def chat(text: Column, pure: bool = False) -> Column:
    """The surface of chat texts; hard blanks stay."""
    return whitespace(replace(nfc(text, pure), ("\r\n?", "\n"), (r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ")))


def without_urls(text: Column) -> Column:
    return replace(text, (URL, " "))


def without_tags(text: Column, pure: bool = False) -> Column:
    """Unescaped text with breaks and bullets for block tags, other tags as blanks, and a tidy surface."""
    steps = (
        (r"(?is)<(script|style)[^>]*>.*?</\1>", " "), (rf"(?i)<br{S}*/?>", "\n"), (rf"(?i)</p{S}*>", "\n\n"), (rf"(?i)</li{S}*>", "\n"),
        (rf"(?i)<li{S}*>", "- "), (rf"(?i)</h[1-6]{S}*>", "\n\n"), ("<[^>]+>", " "),
    )
    return surface(replace(unescape(text, pure), *steps), pure)


def without_separators(text: Column, pure: bool = False) -> Column:
    """Without lines of separators, and runs of them as blanks."""
    kept = kept_lines(text, lambda line: ~line.rlike(SEPARATOR_LINE))
    return surface(replace(kept, (SYMBOL_RUN, " ")), pure)


def without_web_lines(text: Column, pure: bool = False) -> Column:
    """Without short lines that hold page phrases or navigation."""
    phrase = words_pattern((*WEB_PHRASES, *NAVIGATION_PHRASES))
    return surface(kept_lines(text, lambda line: (F.length(strip(line)) > 180) | ~line.rlike(phrase)), pure)


def web(text: Column, pure: bool = False) -> Column:
    """A web page without tags, addresses, separators, notices and short lines of page phrases.

    Composed once, after the tags are gone: later steps put only blanks and line feeds, which nothing composes with.
    """
    plain = without_separators(without_urls(without_tags(text, pure)), True)
    return without_web_lines(replace(plain, (words_pattern(WEB_NOTICES), " ")), True)


def forum(text: Column, pure: bool = False) -> Column:
    return without_tags(text, pure)


def structured(text: Column, pure: bool = False) -> Column:
    return replace(without_separators(text, pure), ("[ \t]+([,.;:!?])", "$1"))


def dump(text: Column) -> Column:
    """A wiki dump's text without markup, on one line."""
    steps = (
        (r"(?s)\{\{.*?\}\}", " "), (r"(?is)<ref[^>]*>.*?</ref>", " "), ("<[^>]+>", " "), (r"(?id)\[\[File:.*?\]\]", " "), (r"(?id)\[\[Immagine:.*?\]\]", " "),
        (r"\[\[[^|\]]+\|([^\]]+)\]\]", "$1"), (r"\[\[([^\]]+)\]\]", "$1"), ("'{2,}", ""), ("={2,}", " "), (rf"{S}+", " "),
    )
    return strip(replace(text, *steps))


def without_lead_noise(text: Column) -> Column:
    """An article without what stands between its title line and the title's next mention, if that looks like residue.

    The mention must lie from the 21st to the 1500th character and be a word of its own.
    """

    def trimmed(parts: Column) -> Column:
        title, body = parts["title"], parts["body"]
        around = F.concat(F.lit("(?<![a-z0-9à-ÿ])\\Q"), F.regexp_replace(F.lower(title), r"\\E", ""), F.lit("\\E(?![a-z0-9à-ÿ])"))
        return bound(F.struct(title.alias("title"), body.alias("body"), parts["text"].alias("text"), (F.regexp_instr(F.lower(body), around) - 1).alias("at")), decided)

    def decided(parts: Column) -> Column:
        return bound(F.struct(parts["title"].alias("title"), parts["body"].alias("body"), parts["text"].alias("text"), parts["at"].alias("at"), F.substring(parts["body"], F.lit(1), parts["at"]).alias("prefix")), cut)

    def cut(parts: Column) -> Column:
        title, body, at, prefix = parts["title"], parts["body"], parts["at"], parts["prefix"]
        dots = F.length(prefix) - F.length(F.translate(prefix, ".", ""))
        noisy = prefix.contains("|") | prefix.contains("}}") | prefix.contains("]]") | prefix.rlike(rf"(?i)\.{_MEDIA}\b") | prefix.rlike(rf"^{S}*\(") | ((at < 300) & (dots < 2))
        return F.when(F.coalesce((title != "") & (body != "") & (at > 20) & (at < 1500) & noisy, F.lit(False)), F.concat(title, F.lit("\n"), F.substring(body, at + 1, F.length(body)))).otherwise(parts["text"])

    def parted(text: Column) -> Column:
        at = F.locate("\n", text)
        body = F.when(at > 0, strip(F.substring(text, at + 1, F.length(text)))).otherwise(F.lit(""))
        return bound(F.struct(text.alias("text"), strip(F.substring_index(text, "\n", 1)).alias("title"), body.alias("body")), trimmed)

    return bound(text, parted)


def wiki(text: Column, pure: bool = False) -> Column:
    """An encyclopaedia article without service sections, signatures, templates, links' targets and file names."""
    plain = surface(text, pure)
    section = r"(?iu)(?:\n|^)(?:==+ *|)(?:" + "|".join(SERVICE_SECTIONS) + r")(?: *==+|\n|:)"
    head = F.split(plain, section, 2)[0]
    steps = (
        (rf"--[^\n]*?(?:\d{{1,2}}:\d{{2}}|\d{{1,2}}{S}+[a-zA-Z]+{S}+\d{{4}})[^\n]*", " "),
        (r"\{\{(?:[^{}]++|\{[^{}]*+\})*+\}\}", " "), (r"(?d)\{\{.*?\}\}", " "), (rf"{S}\|[A-Za-zÀ-ÿ0-9 _-]{{1,40}}{S}*=[^|{{}}]*", " "),
        (r"\[\[(?:[^\]|\n]*\|)?([^\]|\n]+)\]\]", "$1"), (r"(?d)\[\[.*?\]\]", " "), (r"\^{2,}", " "),
    )
    middle = without_separators(replace(head, *steps), True)  # composed at the end
    rest = (
        (r"(?d)<(?!\|).*?>", " "), (URL, " "), (rf"(?i)(?<!{NS}){NS}+\.{_MEDIA}\b", " "),
        (r"\b(?=[A-Za-z0-9]*\d)(?=[A-Za-z0-9]*[A-Za-z])[A-Za-z0-9]{8,}\b", " "), (r"\bCategoria:[^\n]+", " "),
        (rf"\{{\{{|\}}\}}|\[\[|\]\]|{S}\|[A-Za-zÀ-ÿ0-9 _-]{{1,40}}{S}*=", " "), (rf"{S}+([,.;:!?])", "$1"),
    )
    return surface(without_lead_noise(replace(middle, *rest)), pure)


def subtitle_line(text: Column) -> Column:
    """A subtitle's line without styling, notes in brackets and a leading dash."""
    steps = (
        (r"^Dialogue:(?:[^,]*,){9}", ""), (r"\\N", " "), ("<[^>]+>", ""), (r"\{[^}]+\}", " "), (r"\[[^\]]+\]", " "),
        (rf"^{S}*[-–]{S}*", ""), (rf"{S}+", " "),
    )
    return strip(replace(unescape(text), *steps))


def cleaned(text: Column, source: Column, form: Column) -> Column:
    """The cleaner that a record's source, or else its format, calls for."""
    return (
        F.when(source.isin("wikipedia_it", "wikipedia_it_wikimedia_direct"), wiki(text))
        .when(source == "fineweb2_it", web(text))
        .when(source == "stackexchange_auto", forum(text))
        .when(form == "chat", chat(text))
        .when(form.isin("qa", "choice_qa", "instruction"), structured(text))
        .otherwise(web(text))
    )


def sentence_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(rf"[.!?](?:{S}|$)")).cast("bigint")


def _share(text: Column, left_over: Column) -> Column:
    return (F.length(text) - F.length(left_over)) / F.length(text)


def symbol_ratio(text: Column) -> Column:
    """The share of noisy symbols; 1 for the empty text."""
    return F.when(text == "", 1.0).otherwise(_share(text, F.translate(text, NOISE_SYMBOLS, "")))


def alpha_ratio(text: Column) -> Column:
    return F.when(text != "", _share(text, F.regexp_replace(text, r"\p{L}+", "")))


def _digits() -> str:
    """A class of the decimal digits and of the further digits (superscripts, circled ones and the like) that Unicode gives a digit value."""
    further = [c for c in range(0x20000) if chr(c).isdigit() and unicodedata.category(chr(c)) != "Nd"]
    starts = [c for c in further if c - 1 not in further]
    return r"[\p{Nd}" + "".join(f"\\x{{{c:x}}}-\\x{{{next(e for e in range(c, 0x20000) if e + 1 not in further):x}}}" for c in starts) + "]+"


DIGITS = _digits()


def digit_ratio(text: Column) -> Column:
    return F.when(text != "", _share(text, F.regexp_replace(text, DIGITS, "")))


def safe_name(path: Column) -> Column:
    """A file's name without folder and ending, with only letters, digits, dots, dashes and underscores."""
    base = F.regexp_replace(F.substring_index(F.translate(path, "\\", "/"), "/", -1), r"\.[^.]*$", "")
    return F.regexp_replace(base, "[^A-Za-z0-9_.-]+", "_")

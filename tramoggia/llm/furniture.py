"""Marks of single lines of a web page: wrapping tags, prose, list items, and furniture phrases."""

from __future__ import annotations

import re

# Phrases by which sites label what they add around an article (Italian first, then
# the same in English, French, German, Spanish). Each must fill a line or one of its pieces.
PHRASES = (
    "pubblicità", "annuncio pubblicitario", "continua a leggere", "continua a leggere dopo l'annuncio",
    "continua dopo la pubblicità", "leggi tutto", "torna su", "torna all'inizio", "lascia un commento", "commenti",
    "accedi per rispondere", "devi effettuare il login per commentare", "mi piace", "commenta", "condividi",
    "condividi su", "tweet", "invia", "stampa questa pagina", "stampa", "salva tra i preferiti", "segnala un errore",
    "pagina seguente", "pagina precedente", "successivo", "precedente", "note legali", "accessibilità", "cookie",
    "informativa privacy", "termini e condizioni", "preferenze cookie", "privacy policy", "cookie policy",
    "tutti i diritti riservati", "versione mobile", "versione desktop", "accetta tutti", "accetta", "rifiuta",
    "personalizza", "maggiori informazioni", "scegli se accettare o rifiutare", "salta al contenuto", "menu", "home",
    "chi siamo", "contatti", "mappa del sito", "lavora con noi", "accedi", "registrati", "login", "il mio profilo",
    "carrello", "rss", "newsletter", "tutte le categorie", "seguici su",
    "advertisement", "read more", "skip to content", "back to top", "leave a comment", "share", "share this", "sign in",
    "log in", "sign up", "subscribe", "all rights reserved", "accept all", "reject", "terms of use", "contact us", "about us",
    "publicité", "lire la suite", "haut de page", "laisser un commentaire", "partager", "se connecter", "s'inscrire",
    "tous droits réservés", "tout accepter", "mentions légales", "plan du site",
    "anzeige", "werbung", "weiterlesen", "nach oben", "kommentar schreiben", "teilen", "anmelden", "alle rechte vorbehalten",
    "alle akzeptieren", "impressum", "datenschutz",
    "publicidad", "seguir leyendo", "volver arriba", "deja un comentario", "compartir", "iniciar sesión", "suscríbete",
    "todos los derechos reservados", "aceptar todo", "aviso legal", "mapa del sitio",
)
# Openings of whole furniture lines.
OPENINGS = (
    "condividi su", "condividi ", "tag:", "etichette:", "powered by ", "copyright ", "© ", "direttore responsabile",
    "sede legale", "p.iva", "partita iva", "iscriviti alla ", "resta aggiornato", "abbonati ", "vuoi altri contenuti",
    "ti è piaciuto l'articolo", "realizzato con cura da", "le informazioni pubblicate su", "i marchi citati",
    "questo sito utilizza", "questo sito usa", "usiamo i cookie", "usiamo strumenti di tracciamento",
    "per fornire le migliori esperienze", "la tua riservatezza è importante", "noi e i nostri partner",
    "puoi gestire le preferenze", "chiudendo questo riquadro", "proseguendo la lettura", "scegli se accettare",
    "scopri di più su", "guarda la galleria", "guarda il video", "guarda le foto", "offerta del giorno",
    "continua a leggere", "devi effettuare il login", "seguici su", "we use cookies", "this site uses cookies",
    "share on", "tags:", "follow us on", "nous utilisons des cookies", "suivez-nous", "wir verwenden cookies",
    "folgen sie uns", "utilizamos cookies", "síguenos",
)
# Parts by which a short legal line is known wherever they stand in it.
PARTS = (
    "è una testata registrata presso", "partecipa a programmi di affiliazione", "si serve di piccoli file salvati nel browser",
    "tutti i diritti riservati", "all rights reserved", "tous droits réservés", "alle rechte vorbehalten", "todos los derechos reservados",
)
# Openings of a single link set between paragraphs; the link's title follows.
LINKS = (
    "leggi anche", "per saperne di più", "approfondisci", "vedi anche", "guarda anche", "ti potrebbe interessare",
    "[foto e video]", "[foto]", "[video]", "→", "read also", "see also", "lire aussi", "lesen sie auch", "lee también",
)
# Headings of the boxes of link titles.
BOXES = (
    "articoli correlati", "da non perdere", "ultimi articoli", "ultime notizie", "i più letti", "più letti",
    "dallo stesso autore", "in evidenza", "potrebbe interessarti", "potrebbe interessarti anche", "correlati", "related articles",
    "most read", "you may also like", "articles similaires", "les plus lus", "ähnliche artikel", "meistgelesen",
    "artículos relacionados", "lo más leído",
)

TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)\b[^<>]*>")
BODY_TAGS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "td", "th", "tr", "pre", "article"}
SITE_TAGS = {"div", "a", "nav", "footer", "aside", "header", "button", "form", "span"}
PIECES = re.compile(r"\s*[|·»▸›\t]+\s*|\s{2,}|\s+[-–/]\s+|(?<=[.!?…:])\s+|\]\s*\[")
HEAD, TAIL = " \t\r\n\xa0*•·-–»▸›>|[(]", " \t\r\n\xa0|»▸›])[>"
ITEM = re.compile(r"^\s*(?:[-–—*•·]\s|\d{1,3}[.)]\s|\d{4}\s+[-–]\s|\|)")
NUMBERED = re.compile(r"^\s*(\d{1,2})\s+\S")
EXCERPT = re.compile(r"(?:…|\.\.\.|\[\s*(?:…|\.\.\.)\s*\]|leggi tutto|read more|continua)\s*$", re.I)
PAGER = re.compile(r"^\W*\d{1,3}(?:\s+\d{1,3}){1,8}\s*(?:…|\.\.\.)\s*\d{1,4}\b.{0,24}$")
COMMENTS = re.compile(r"^\W*\d+\s+(?:commenti|comments|commentaires|kommentare|comentarios)\b.{0,60}$", re.I)
# Behind a blank, so that it also finds a text's first letter; begun by a class of characters it skips fast.
_LOWER = re.compile(r"[\s'’(«“\"][^\W\d_A-ZÀ-Þ]")
# What `pieces` splits at apart from sentence ends, at most; and these ends, where blanks are the only white space.
_SPLITTERS = re.compile(r"[|·»▸›\]\0\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_STOPS = tuple((f"{mark} ", f"{mark}\0") for mark in ".!?…:")
_PHRASES, _BOXES = frozenset(PHRASES), frozenset(BOXES)

PROSE, CUE, BOX, TITLE, TEASER, BODY_TAG, SITE_TAG, LISTED, NUMBER, LINK, HEADLINE = (1 << k for k in range(11))
#: The number that begins a line is kept above the marks.
NUMBER_SHIFT = 16
_HEADLINE = re.compile(r"^(?:\d{1,2}\s+)?(?:\d{1,2}\s+)?[^\W\d][^\d]*$")


def bare(line: str) -> tuple[str, int]:
    """The line without tags, and BODY_TAG or SITE_TAG if tags wrap it."""
    if "<" not in line:
        return line.strip(), 0
    names = [m[2].lower() for m in TAG.finditer(line)]
    if not names:
        return line.strip(), 0
    tag = BODY_TAG if names[0] in BODY_TAGS else SITE_TAG if names[0] in SITE_TAGS or "a" in names else 0
    return TAG.sub(" ", line).strip(), tag


def trimmed(text: str) -> str:
    """The text without marks at its edges."""
    return text.lstrip(HEAD).rstrip(TAIL)


def pieces(text: str) -> list[str]:
    """The parts of a line between separators and sentence ends, without marks at their edges."""
    if "  " in text or " - " in text or " – " in text or " / " in text or _SPLITTERS.search(text):
        parts = PIECES.split(text)
    else:
        for stop, with_break in _STOPS:
            text = text.replace(stop, with_break)
        parts = text.split("\0")
    return [q for p in parts if p and (q := trimmed(p))]


def digits_in(text: str) -> int:
    return sum(map(text.count, "0123456789"))


def ends_sentence(text: str) -> bool:
    """Whether a text ends as a sentence does; a bracket must close behind a sentence's end."""
    return text[-1] in ".!?\"»”’;:…" or text[-1] == ")" and text[-2:-1] in (".", "!", "?")


def _has_part(low: str) -> bool:
    for part in PARTS:
        if part in low:
            return True
    return False


def is_prose(text: str) -> bool:
    """Whether a line without tags reads as a sentence or more: six words, most of them in lower
    case, few digits, and an end as a sentence has it (or sentences inside a long line)."""
    size = len(text)
    if size < 30 or not ends_sentence(text) and not (size > 120 and ". " in text) or text.count(" ") < 5 or ITEM.match(text):
        return False
    if digits_in(text) > 0.15 * size:
        return False
    return len(_LOWER.findall(f" {text}")) >= 0.55 * (text.count(" ") + 1)


def _marks(line: str) -> tuple[str, int]:
    text, bits = bare(line)
    if not text:
        return text, bits
    size = len(text)
    # What begins with a letter is neither numbered nor an item.
    lettered = text[0].isalpha()
    low = text[:200].lower() if size > 320 else text.lower()
    plain = trimmed(low) if size <= 320 else low.lstrip(HEAD)
    if size <= 320:
        head = plain.rstrip(": ")
        if head in _BOXES:
            bits |= BOX | CUE
        elif head in _PHRASES or not lettered and (PAGER.match(text) or COMMENTS.match(text)):
            bits |= CUE
        elif size < 160 and low.startswith(LINKS):
            bits |= LINK
        elif plain.startswith(OPENINGS) and not _own_sentence(plain, text) or _has_part(low):
            bits |= CUE
    elif plain.startswith(OPENINGS) and not _own_sentence(plain, text):
        bits |= CUE
    if is_prose(text):
        bits |= PROSE
    if not lettered and ITEM.match(text):
        bits |= LISTED
    words = text.count(" ") + 1
    if words <= 16 and text[-1] not in ".!?;,":
        bits |= TITLE
    # Only a bracket's mark can be longer than "leggi tutto".
    if size < 220 and EXCERPT.search(text, 0 if text[-1] == "]" else max(0, size - 11)):
        bits |= TEASER
    if not lettered and (m := NUMBERED.match(text)):
        bits |= NUMBER | int(m[1]) << NUMBER_SHIFT
    if words >= 3 and bits & TITLE and not bits & LISTED and _HEADLINE.match(text):
        bits |= HEADLINE
    return text, bits


_KNOWN: dict[str, tuple[str, int]] = {}


def marks(line: str) -> tuple[str, int]:
    """The line without tags, and its marks as bits; short lines, which recur, are remembered."""
    if len(line) > 120:
        return _marks(line)
    got = _KNOWN.get(line)
    if got is None:
        if len(_KNOWN) > 200_000:
            _KNOWN.clear()
        got = _KNOWN[line] = _marks(line)
    return got


def itemized(line: str) -> tuple[str, int]:
    """The line without tags, and LISTED if it is an item of a list: what is left of `marks` where only that matters."""
    text = bare(line)[0]
    return text, LISTED if not text[:1].isalpha() and ITEM.match(text) else 0


def _own_sentence(plain: str, text: str) -> bool:
    """Whether an opening that is also ordinary language begins a longer paragraph."""
    return plain.startswith(("condividi ", "copyright ", "abbonati ")) and len(text) > 160


def site_line(text: str, bits: int) -> bool:
    """Whether a single line alone, without knowledge of its site, is furniture by its phrases."""
    if bits & (CUE | LINK):
        return True
    if len(text) >= 200 or bits & PROSE and len(text) > 100:
        return False
    parts = pieces(text.lower())
    return len(parts) > 1 and 2 * sum(p.rstrip(".:") in _PHRASES for p in parts) >= len(parts)

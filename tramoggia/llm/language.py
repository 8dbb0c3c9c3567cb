"""Language of documents and of their segments by string kernels.

The kernel of two texts is the number of n-grams that both have (presence, lengths blended,
words padded with blanks), normalised by the sizes of their n-gram sets. It is approximated on
landmarks (Nyström): a text's features are K(text, landmarks) · W^(-1/2). One-versus-rest kernel
ridge regression on a bounded sample of labelled sentences gives a score for each language. As
kernel, projection and regression are linear in a text's n-gram indicator, they fold into one
matrix of n-grams × languages, and a batch is scored as one sparse matrix product.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramoggia.llm import furniture as fu
from tramoggia.llm.boilerplate import taken_away, with_furniture
from tramoggia.llm.quality import PROSE_SHARE, prose_line
from tramoggia.session import mapped, table

LANGUAGES = ("it", "en", "fr", "de", "es")
#: Lengths of the n-grams, the size of their hashed space, landmarks and the ridge.
NGRAMS, SPACE, LANDMARKS, RIDGE = (3, 4), 1 << 17, 400, 0.05
#: Labelled rows looked at for each language (a bounded sample by a hash of the id), and sentences taken of them.
SAMPLE_ROWS, SAMPLE_SENTENCES = 250, 700
#: Words of the shortest sentence that is judged by itself, and how far its language must lead the next one to count as another than the label's.
LEAST_WORDS, LEAD = 2, 0.5

# Names of the languages, codes first.
NAMES = {
    "it": "it ita italian italiano italiana italien italienisch italienne",
    "en": "en eng english inglese inglés ingles anglais englisch",
    "fr": "fr fra fre french francese français francais französisch franzosisch francés frances",
    "de": "de deu ger german tedesco tedesca deutsch allemand alemán aleman",
    "es": "es spa spanish spagnolo spagnola español espanol espagnol spanisch castellano castilian",
}
BY_NAME = {name: lang for lang, names in NAMES.items() for name in names.split()}

# Sentences written for this library, by which the labels of the sample are checked.
SEEDS = {
    "it": "La casa è vicino al fiume e il cane dorme davanti alla porta. Non sappiamo ancora quando arriverà il treno, ma lo aspettiamo con gli amici. Gli studenti hanno letto il libro che era sul tavolo della biblioteca. Durante la riunione si è parlato dei costi e delle nuove macchine. Questo paese fu costruito nel Medioevo e conserva le mura antiche. Secondo il meccanico, il motore consuma troppo perché il filtro è sporco. Quella sera pioveva e nessuno voleva uscire. Ogni giorno la nonna prepara il pane per tutta la famiglia.",
    "en": "The house is near the river and the dog sleeps in front of the door. We do not know yet when the train will arrive, but we are waiting for it with our friends. The students have read the book that was on the library table. During the meeting they talked about the costs and the new machines. This village was built in the Middle Ages and still has its old walls. According to the mechanic, the engine uses too much fuel because the filter is dirty. It was raining that evening and nobody wanted to go out. Every day their grandmother makes bread for the whole family.",
    "fr": "La maison est près de la rivière et le chien dort devant la porte. Nous ne savons pas encore quand le train arrivera, mais nous l'attendons avec nos amis. Les étudiants ont lu le livre qui était sur la table de la bibliothèque. Pendant la réunion, on a parlé des coûts et des nouvelles machines. Ce village a été construit au Moyen Âge et garde ses vieux murs. Selon le mécanicien, le moteur consomme trop parce que le filtre est sale. Il pleuvait ce soir-là et personne ne voulait sortir. Chaque jour, la grand-mère prépare du pain pour toute la famille.",
    "de": "Das Haus steht nahe am Fluss und der Hund schläft vor der Tür. Wir wissen noch nicht, wann der Zug ankommt, aber wir warten mit unseren Freunden auf ihn. Die Studenten haben das Buch gelesen, das auf dem Tisch der Bibliothek lag. In der Sitzung sprach man über die Kosten und die neuen Maschinen. Dieses Dorf wurde im Mittelalter gebaut und hat noch seine alten Mauern. Nach Angaben des Mechanikers verbraucht der Motor zu viel, weil der Filter schmutzig ist. An diesem Abend regnete es und niemand wollte hinausgehen. Jeden Tag backt die Großmutter Brot für die ganze Familie.",
    "es": "La casa está cerca del río y el perro duerme delante de la puerta. Todavía no sabemos cuándo llegará el tren, pero lo esperamos con los amigos. Los estudiantes han leído el libro que estaba sobre la mesa de la biblioteca. Durante la reunión se habló de los costes y de las máquinas nuevas. Este pueblo fue construido en la Edad Media y conserva sus viejas murallas. Según el mecánico, el motor consume demasiado porque el filtro está sucio. Aquella noche llovía y nadie quería salir. Cada día la abuela prepara el pan para toda la familia.",
}

_WORD = re.compile(r"[^\W\d_]+")
# By white space and closing quote (most lines have few of them), the ends of sentences.
_ENDS = {gap: {quote: tuple((f"{mark}{quote}{gap}", f"{mark}{quote}\0") for mark in marks) for quote, marks in (("", ".!?…"), ("»", ".!?"), ("”", "."), ("\"", ".!?"))} for gap in (" ", "\xa0")}
_BREAKS = (("(", "\0"), (")", "\0"), (" – ", "\0"), (" — ", "\0"))
# What most often stands next to words and is no part of them.
_MARKS = ",.'’;:\"!?«»“”…-–—/%•|·[]<>0123456789"


def _broken(text: str) -> str:
    """The text with \0 between sentences; what stands in brackets or between dashes counts as one of its own."""
    for gap, quotes in _ENDS.items():
        if gap in text:
            for quote, ends in quotes.items():
                if quote in text:
                    for mark, with_break in ends:
                        text = text.replace(mark, with_break)
    for mark, with_break in _BREAKS:
        text = text.replace(mark, with_break)
    return text


def sentences(line: str) -> list[str]:
    """The sentences of a line."""
    return [p for p in _broken(line).split("\0") if p]


def words_in(text: str) -> list[str]:
    """The words of a text, as _WORD finds them: what lies between blanks, if it is of letters alone, else the runs of letters in it."""
    words = text.split()
    if "".join(words).isalpha():
        return words
    return [w for word in words for w in ((word,) if word.isalpha() else _WORD.findall(word))]


def sentence_words(text: str) -> list[list[list[str]]]:
    """For each line of a text, the words, lower-case, of each of its sentences that has any."""
    text = _broken(text.lower())
    for mark in _MARKS:
        text = text.replace(mark, " ")
    return [[words for part in line.split("\0") if (words := words_in(part))] for line in text.split("\n")]


def _ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """How many distinct n-grams each word has, and their hashed ids, word after word."""
    padded = "".join([f" {w} " for w in words])
    code = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(code))
    keys = []
    for n in NGRAMS:
        whole = np.flatnonzero(left >= n)
        h = np.full(len(whole), n, np.uint32)
        for k in range(n):
            h = h * np.uint32(1_000_003) + code[whole + k]
        keys.append(word[whole] * SPACE + ((h ^ (h >> np.uint32(15))) * np.uint32(2_654_435_761) >> np.uint32(15)))
    found = np.unique(np.concatenate(keys))
    return np.bincount(found // SPACE, minlength=len(words)), (found % SPACE).astype(np.uint32)


class _Parts:
    """The n-grams of single words, by number."""

    def __init__(self, known: Ngrams):
        self._known = known

    def __getitem__(self, number: int) -> np.ndarray:
        starts, sizes, flat = self._known.table()
        return flat[starts[number] : starts[number] + sizes[number]]


class Ngrams(dict):
    """Words to their numbers, and for each number the hashed ids of the word's n-grams (distinct); remembered while they are few enough."""

    def __init__(self):
        super().__init__()
        self._new: list[str] = []
        self._sizes, self._flat = np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self._starts = self._sizes
        #: Another object whenever the words are numbered anew.
        self.version = object()

    def __missing__(self, word: str) -> int:
        out = self[word] = len(self)
        self._new.append(word)
        return out

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By number of the word: where its n-grams begin in the third array, and how many they are."""
        if self._new:
            # All new words at once.
            sizes, flat = _ngrams(self._new)
            self._sizes, self._flat, self._new = np.concatenate([self._sizes, sizes]), np.concatenate([self._flat, flat]), []
            self._starts = np.cumsum(self._sizes) - self._sizes
        return self._starts, self._sizes, self._flat

    @property
    def parts(self) -> _Parts:
        return _Parts(self)

    def clear(self) -> None:
        super().clear()
        self.__init__()


#: Those of a Python worker, whose tasks share them: texts have most words in common.
_KNOWN = Ngrams()


def word_ngrams(texts: list[list[str]], known: Ngrams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For texts as word lists: the numbers of their distinct words and how many each text has; then the n-grams of
    these, sorted, as text * SPACE + n-gram, and whether each but the first equals the one before."""
    if len(known) > 300_000:
        known.clear()
    sets = [set(words) for words in texts]
    counts = np.fromiter(map(len, sets), np.int64, len(sets))
    words = np.fromiter(map(known.__getitem__, itertools.chain.from_iterable(sets)), np.int64, int(counts.sum()))  # new ones are numbered here
    starts, sizes, flat = known.table()
    # Short keys as long as the texts are few enough for them.
    kind = np.uint32 if len(texts) < (1 << 32) // SPACE else np.int64
    each = sizes[words]
    ends = np.cumsum(each)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total, dtype=np.int32 if total < 1 << 31 else np.int64)
    at += np.repeat((starts[words] - ends + each).astype(at.dtype), each)
    keys = np.repeat(np.repeat(np.arange(len(texts), dtype=kind) * kind(SPACE), counts), each)
    keys += flat[at]
    keys.sort()
    return words, counts, keys, keys[1:] == keys[:-1]


def indicators(texts: list[list[str]], known: Ngrams) -> tuple[np.ndarray, np.ndarray]:
    """For texts as word lists, the distinct (text, n-gram) pairs: offsets and n-gram ids, in order of texts."""
    _, _, keys, again = word_ngrams(texts, known)
    keys = np.concatenate([keys[:1], keys[1:][~again]])
    return np.searchsorted(keys, np.arange(len(texts) + 1, dtype=np.int64) * SPACE), (keys % keys.dtype.type(SPACE)).astype(np.int32)


class Classifier:
    """Scores of the languages by folded Nyström kernel ridge regression."""

    def __init__(self, weights: np.ndarray):
        #: n-grams × languages
        self.weights = weights
        #: Sums of the weights of each word's n-grams, for the words of `_summed`.
        self._sums, self._summed = np.zeros((0, len(LANGUAGES))), None

    @classmethod
    def fit(cls, texts: list[list[str]], labels: list[int], seed: int = 5) -> Classifier:
        rng = np.random.default_rng(seed)
        offsets, ids = indicators(texts, Ngrams())
        sizes = np.maximum(np.diff(offsets), 1)
        chosen = np.sort(rng.permutation(len(texts))[:LANDMARKS])
        # Only n-grams of landmarks matter: `columns` has a row for each of them, and one of zeros for all others.
        own = [ids[offsets[c] : offsets[c + 1]] for c in chosen]
        active = np.unique(np.concatenate(own)) if own else np.zeros(0, np.int64)
        place = np.full(SPACE, len(active))
        place[active] = np.arange(len(active))
        columns = np.zeros((len(active) + 1, len(chosen)), np.float32)
        for c, mine in enumerate(own):
            columns[place[mine], c] = 1 / np.sqrt(max(1, len(mine)))
        k = np.zeros((len(texts), len(chosen)), np.float32)
        for t in range(len(texts)):
            k[t] = columns[place[ids[offsets[t] : offsets[t + 1]]]].sum(axis=0) / np.sqrt(sizes[t])
        w = k[chosen].astype(np.float64)
        values, vectors = np.linalg.eigh((w + w.T) / 2)
        keep = values > 1e-6 * values[-1]
        root = vectors[:, keep] / np.sqrt(values[keep])
        features = k @ root
        targets = np.where(np.asarray(labels)[:, None] == np.arange(len(LANGUAGES)), 1.0, -1.0)
        # Every language weighs the same, however many sentences it has.
        counts = np.bincount(labels, minlength=len(LANGUAGES))
        weight = (1.0 / np.maximum(counts, 1))[np.asarray(labels)][:, None]
        weight *= len(texts) / weight.sum()
        gram = features.T @ (features * weight) + RIDGE * len(texts) * np.eye(features.shape[1]) / 10
        ridge = np.linalg.solve(gram, features.T @ (targets * weight))
        weights = np.zeros((SPACE, len(LANGUAGES)), np.float32)
        weights[active] = (columns @ (root @ ridge))[:-1]
        return cls(weights)

    def scores(self, texts: list[list[str]], known: Ngrams) -> np.ndarray:
        """texts × languages; about 1 for the text's language and -1 for the others.

        Of a text's n-grams few are in two of its words, so the words' sums are added, and these n-grams taken off.
        """
        words, counts, keys, again = word_ngrams(texts, known)
        sums, sizes = self._word_sums(known), known.table()[1]
        own = np.zeros((len(texts), len(LANGUAGES)))
        n = np.zeros(len(texts), np.int64)
        full = np.flatnonzero(counts)
        if len(full):
            starts = (np.cumsum(counts) - counts)[full]
            own[full] = np.add.reduceat(sums[words], starts)
            n[full] = np.add.reduceat(sizes[words], starts)
        twice = keys[1:][again]
        text, ids = (twice // SPACE).astype(np.int64), twice % SPACE
        n -= np.bincount(text, minlength=len(texts))
        for k in range(len(LANGUAGES)):
            own[:, k] -= np.bincount(text, self.weights[ids, k], minlength=len(texts))
        return (own / np.sqrt(np.maximum(n, 1))[:, None]).astype(np.float32)

    def _word_sums(self, known: Ngrams) -> np.ndarray:
        starts, sizes, flat = known.table()
        if self._summed is not known.version:
            self._sums, self._summed = np.zeros((0, len(LANGUAGES))), known.version
        if (done := len(self._sums)) < len(sizes):
            added = np.zeros((len(sizes) - done, len(LANGUAGES)))
            full = np.flatnonzero(sizes[done:])
            if len(full):
                added[full] = np.add.reduceat(self.weights[flat[starts[done] :]].astype(np.float64), (starts[done:] - starts[done])[full])
            self._sums = np.concatenate([self._sums, added])
        return self._sums


def stated(label: Column) -> Column:
    """The language a label states, as a code of LANGUAGES; null if it states none of them."""
    plain = F.regexp_replace(F.lower(F.regexp_replace(label, r"^[\s\x{85}\x{a0}]+|[\s\x{85}\x{a0}]+$", "")), r"[-_ (].*$", "")
    names = F.create_map(*[F.lit(x) for pair in BY_NAME.items() for x in pair])
    return F.when(label.isNotNull(), F.try_element_at(names, plain))


class Unit(NamedTuple):
    """Words of a body that are judged together: a sentence, or the short, listed and unended lines between sentences."""

    words: list[str]
    #: Whether it is a whole sentence, and whether its line is prose.
    whole: bool
    prose: bool
    #: Words after it, too few to be judged.
    more: int = 0


def body_units(text: str, skip_unprosaic: bool, lines: list[int] | None = None) -> list[Unit]:
    """All words of a text's main body, lower-case, in units; one of fewer than LEAST_WORDS words goes with its neighbour.

    A body of fewer words is one unit; a text without body (all of it furniture) is judged as a whole, but holds no whole
    sentence. Empty if the text has no words, or its body isn't prose and that matters; `lines` are
    the furniture's as in `taken_away`.
    """
    if lines is None:
        marked = [fu.marks(line) for line in text.split("\n") if line.strip()]
        plains, bits = [plain for plain, _ in marked], [mark for _, mark in marked]
        left = [line for line, gone in zip(marked, taken_away(bits, plains, [], None)) if not gone]
    else:
        away = set(lines)
        left = [fu.itemized(line) for number, line in enumerate(text.split("\n"), 1) if number not in away]
    out: list[Unit] = []
    pending: list[str] = []
    body, prose = 0, 0
    left = [(plain, mark) for plain, mark in left if plain and not plain.startswith("<|")]
    for (plain, mark), found in zip(left, sentence_words("\n".join([plain for plain, _ in left]))):
        body += len(plain)
        every = found[0] if len(found) == 1 else [w for s in found for w in s]
        n = len(every)
        if prosaic := prose_line(plain, mark, every):
            prose += len(plain)
        if n < 15 and (n < LEAST_WORDS or not fu.ends_sentence(plain)):
            pending += every
            continue
        for words in found:
            if len(words) < LEAST_WORDS:
                pending += words
                continue
            if len(pending) >= LEAST_WORDS:
                out.append(Unit(pending, False, False))
                pending = []
            out.append(Unit(words, True, prosaic))
    if len(pending) >= LEAST_WORDS or pending and not out:
        out.append(Unit(pending, False, False))
    elif pending:
        out[-1] = out[-1]._replace(more=len(pending))
    if not out and (words := [w for line in text.split("\n") for w in _WORD.findall(fu.bare(line)[0].lower())]):
        out.append(Unit(words, False, False))
    return [] if skip_unprosaic and prose < PROSE_SHARE * body else out


def _sampled(df: DataFrame, counts: dict[str, int]) -> DataFrame:
    """The rows (lang, text, key) of a bounded sample: about SAMPLE_ROWS for each language, by hash of the key."""
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, SAMPLE_ROWS / max(1, n)))).otherwise(share)
    return df.where(F.pmod(F.xxhash64(F.lit(3), "key"), F.lit(1_000_000)) < share * 1_000_000)


def train(df: DataFrame) -> Classifier:
    """A classifier from rows (key, label, text, gone), of which a bounded sample goes to the driver.

    Labels may be wrong: a classifier of the seed sentences first judges the sampled sentences, and
    those that it clearly takes for another language than their label are left out. Languages
    without labels are learned from the seed sentences alone.
    """
    seeds = [(_WORD.findall(s.lower()), k) for k, lang in enumerate(LANGUAGES) for s in sentences(SEEDS[lang])]
    texts, labels = [t for t, _ in seeds], [k for _, k in seeds]
    first = Classifier.fit(texts, labels)
    rows = df.select("key", stated(F.col("label")).alias("lang"), "text", "gone").where("lang is not null and text is not null")
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row a language
    taken: dict[str, int] = {}
    known = Ngrams()
    for row in sorted(_sampled(rows, counts).collect(), key=lambda r: (r.lang, str(r.key))):
        if taken.get(row.lang, 0) >= SAMPLE_SENTENCES:
            continue
        words = [u.words for u in body_units(row.text, False, row.gone) if u.prose]
        at = LANGUAGES.index(row.lang)
        for w, s in zip(words, first.scores(words, known)):
            if taken.get(row.lang, 0) < SAMPLE_SENTENCES and s[at] >= s.max() - 0.05:
                taken[row.lang] = taken.get(row.lang, 0) + 1
                texts.append(w)
                labels.append(at)
    return Classifier.fit(texts, labels)


def _confidence(scores: np.ndarray) -> np.ndarray:
    e = np.exp(4 * (scores - scores.max(axis=1, keepdims=True)))
    return e.max(axis=1) / e.sum(axis=1)


#: Texts are scored together until they have so many characters, which bounds the memory of a batch.
CHARS_AT_ONCE = 2_000_000


def segments(df: DataFrame, model: Classifier, *keep: str, unprosaic: str | None = None, text: str = "text", gone: str | None = None) -> DataFrame:
    """(keep…, segment, lang, confidence, lead, words): runs of sentences of one language in each text's main body.

    `lead` is how far the segment's best whole sentence leads the language next to it, 0 if it has
    none: short, listed and unended lines are judged too, but together. `confidence` is the mean over its words. A
    text without body is one segment, judged as a whole. `unprosaic` names a boolean column; where
    it is true, a text whose body isn't prose has no segments. `gone` names a column with the numbers
    of each text's furniture lines; where it is null, phrases alone tell them. Null, empty and blank texts have none.
    """
    weights = df.sparkSession.sparkContext.broadcast(model.weights)  # SPACE × 5 numbers, 2.6 MB
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(weights.value)

        def judged(rows: list[int], batch: pa.RecordBatch, spans: list[tuple[int, int]], units: list[Unit]) -> pa.RecordBatch:
            words = [u.words for u in units]
            scores = classifier.scores(words, _KNOWN)
            order = np.sort(scores, axis=1)
            lead = (order[:, -1] - order[:, -2]) * np.array([u.whole for u in units], bool)
            best, sure, lead = scores.argmax(axis=1).tolist(), _confidence(scores).tolist() if len(scores) else [], lead.tolist()
            at, seg, lang, conf, led, count = [], [], [], [], [], []
            for row, (lo, hi) in zip(rows, spans):
                k = number = 0
                for k in range(lo, hi):
                    if k > lo and lang[-1] == LANGUAGES[best[k]]:
                        n_words = len(words[k]) + units[k].more
                        conf[-1] += (sure[k] - conf[-1]) * n_words / (count[-1] + n_words)
                        led[-1], count[-1] = max(led[-1], lead[k]), count[-1] + n_words
                        continue
                    number += 1
                    at.append(row)
                    seg.append(number)
                    lang.append(LANGUAGES[best[k]])
                    conf.append(sure[k])
                    led.append(lead[k])
                    count.append(len(words[k]) + units[k].more)
            columns = [batch.column(c).take(pa.array(at, pa.int64())) for c in range(n)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(seg, pa.int32()), pa.array(lang, pa.string()), pa.array(conf, pa.float64()), pa.array(led, pa.float64()), pa.array(count, pa.int32())], names=[*keep, "segment", "lang", "confidence", "lead", "words"])

        for batch in batches:
            texts, flags, gones = (batch.column(n + k).to_pylist() for k in range(3))
            rows, spans, units, chars = [], [], [], 0
            for row, (text_, flag, lines) in enumerate(zip(texts, flags, gones)):
                if text_ and not text_.isspace():
                    found = body_units(text_, bool(flag), lines)
                    if found:
                        rows.append(row)
                        spans.append((len(units), len(units) + len(found)))
                        units += found
                        chars += len(text_)
                if chars > CHARS_AT_ONCE:
                    yield judged(rows, batch, spans, units)
                    rows, spans, units, chars = [], [], [], 0
            yield judged(rows, batch, spans, units)

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep)
    flag = F.col(unprosaic) if unprosaic else F.lit(False)
    taken = df.select(*[F.col(k) for k in keep], F.col(text), flag.alias("_unprosaic"), (F.col(gone) if gone else F.lit(None)).cast("array<bigint>").alias("_gone"))
    return taken.transform(mapped, run, f"{kinds}, segment int, lang string, confidence double, lead double, words int")


def labelled(spark: SparkSession, directory: str) -> DataFrame:
    """(source, rec_id, label, text, gone) of fineweb2_it, less its sites' furniture, and local_import, which has no sites."""
    web = with_furniture(table(spark, directory, "fineweb2_it").select("rec_id", "site", "language", "text"))
    local = table(spark, directory, "local_import").withColumn("gone", F.lit(None).cast("array<bigint>"))
    parts = [df.select(F.lit(t).alias("source"), "rec_id", F.col("language").alias("label"), "text", "gone") for t, df in (("fineweb2_it", web), ("local_import", local))]
    return parts[0].unionAll(parts[1])


def model_for(spark: SparkSession, directory: str, rows: DataFrame | None = None) -> Classifier:
    return train((rows or labelled(spark, directory)).withColumnRenamed("rec_id", "key"))


def p3_found(spark: SparkSession, directory: str) -> DataFrame:
    """Each language of a whole sentence of a record's main body that the record's label doesn't state."""
    rows = labelled(spark, directory)
    judged = rows.withColumns({"claim": stated(F.col("label")), "strict": F.col("source") == "fineweb2_it"})
    parts = segments(judged, model_for(spark, directory, rows), "source", "rec_id", "claim", unprosaic="strict", gone="gone")
    return parts.where((F.col("claim").isNull() | (F.col("claim") != F.col("lang"))) & (F.col("lead") >= LEAD)).select("source", "rec_id", "lang").distinct()


def p3_segments(spark: SparkSession, directory: str) -> DataFrame:
    """The language segments of every record of both tables, with confidence."""
    rows = labelled(spark, directory)
    return segments(rows, model_for(spark, directory, rows), "source", "rec_id", gone="gone").drop("lead")


def p3_documents(spark: SparkSession, directory: str) -> DataFrame:
    """The main language of every record, by words, with its share and confidence (of its words' segments); nulls where the text has no words."""
    rows = labelled(spark, directory)
    by = segments(rows, model_for(spark, directory, rows), "source", "rec_id", gone="gone").groupBy("source", "rec_id", "lang").agg(F.sum("words").alias("words"), (F.sum(F.col("confidence") * F.col("words")) / F.sum("words")).alias("confidence"))
    best = by.groupBy("source", "rec_id").agg(F.max(F.struct("words", "lang", "confidence")).alias("b"), F.sum("words").alias("total"))
    told = best.select("source", "rec_id", F.col("b.lang").alias("lang"), (F.col("b.words") / F.col("total")).alias("share"), F.col("b.confidence").alias("confidence"))
    return rows.select("source", "rec_id").join(told, ["source", "rec_id"], "left")

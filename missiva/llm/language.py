"""Problem 6: the language of texts and of their segments.

Word-first backoff: a word known to the model counts with its log frequency in each language; a
word unseen falls back to character n-grams, from four characters down to one. The frequencies
are counted over the whole corpus. What a segment is counted under comes from its script and from
short lists of function words, not from the unreliable labels.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from missiva.llm.samples import most_frequent, most_frequent_by
from missiva.session import cut, drop

LANGS = ["en", "he", "ru", "ar", "fr", "de", "es", "pt"]
#: Words the model holds of each language, the most frequent first; the rest go by their character n-grams, which are
#: counted over all words and of which it holds so many.
VOCABULARY, GRAMS = 30_000, 200_000

# Function words that tell the languages in Latin script apart.
SEEDS = {
    "en": "the of and to in that is was for on with as are this be has not have by from or at which will we you your our",
    "fr": "le la les des et une est dans que qui pour sur avec pas nous vous du au ce cette sont mais ou ont été notre votre",
    "de": "der die das und ist nicht mit den von zu im ein eine auf für sich des dem wir sie ich uns noch bei wird werden bitte",
    "es": "el los las y del que en un una por con para no se su es lo como pero más fue sus este esta hay nos está",
    "pt": "o os as e do da dos das que em um uma por com para não se seu é ao mais na no foi como mas ou são está nossa",
}
# Codes of one language besides the two-letter one in use.
ALIASES = {"iw": "he", "heb": "he", "eng": "en", "rus": "ru", "ara": "ar", "arb": "ar", "fra": "fr", "fre": "fr", "deu": "de", "ger": "de", "spa": "es", "por": "pt"}

_SCRIPTS = [("he", re.compile("[א-ת]")), ("ru", re.compile("[Ѐ-ӿ]")), ("ar", re.compile("[ء-ي]")), ("latin", re.compile("[A-Za-zÀ-ɏ]"))]
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_SKIP = re.compile(r"\S+@\S+|https?://\S+|www\.\S+|\S*\d\S*")
_PREFIX = re.compile(r"^\s*(?:[>|]\s?)*")
# Names of header fields that may stand in a text; such a line is no part of a sentence.
_HEADER = re.compile(r"^\**(?:From|Sent|To|Cc|Bcc|Date|Subject|De|Envoyé|À|Objet|Von|Gesendet|An|Betreff|Datum|Para|Fecha|Asunto|Assunto|Enviado|Enviada|Data|От|Кому|Дата|Тема|Отправлено|מאת|נשלח|אל|נושא|من|إلى|الموضوع|التاريخ)\s?:\**(?:\s|$)")
#: A sentence ends with these, but not at an initial or a common abbreviation.
_END = re.compile(r"(?<![\s(][A-ZА-Я])(?<!\bSt)(?<!\bext)(?<!\bTel)(?<!\bDr)(?<!\bMr)(?<!\bno)(?<!\bNo)[.!?;؟…。][\"'»”)\]]*(?=\s|$)")
#: A statement that ends with the number or address it points to, without a full stop.
_POINTER = re.compile(r"[^\W\d_]: [^:]*(?:\d\S*|@\S+)$")
_SEED_OF: dict[str, list[int]] = {}
for _k, _l in enumerate(LANGS):
    for _w in SEEDS.get(_l, "").split():
        _SEED_OF.setdefault(_w, []).append(_k)


def canonical_label(label: str | None) -> str | None:
    """The two-letter code a label names, whatever its case, region or length; None for no language."""
    if not label:
        return None
    code = re.split(r"[-_]", label.strip().lower())[0]
    code = ALIASES.get(code, code)
    return code if code in LANGS or len(code) == 2 and code.isalpha() else None


def segments(text: str) -> list[tuple[int, int, str, bool]]:
    """``(start, end, words joined, whole)`` of the sentences and rests of a text.

    Lines with the same quote mark run on over wrapped lines until a blank one; a segment is a
    whole sentence where it ends with a full stop or its like.
    """
    out, para, at, mark = [], [], 0, None

    def close():
        nonlocal para
        if not para:
            return
        flat = " ".join(p for _, p in para)
        starts, pos = [], 0
        for offset, p in para:
            starts.append((pos, offset))
            pos += len(p) + 1

        def place(i):
            k = max(j for j, (s, _) in enumerate(starts) if s <= i)
            return starts[k][1] + i - starts[k][0]

        begin = 0
        for m in _END.finditer(flat):
            if flat[begin : m.end()].strip():
                out.append((place(begin), place(m.end() - 1) + 1, flat[begin : m.end()], True))
            begin = m.end() + 1
        if flat[begin:].strip():
            out.append((place(begin), place(len(flat) - 1) + 1, flat[begin:], False))
        para = []

    for line in text.split("\n"):
        prefix = _PREFIX.match(line).group()
        body = line[len(prefix) :].rstrip()
        if not body or prefix.strip() != mark:
            close()
        if body:
            header = _HEADER.match(body) is not None
            if header:
                close()
            para.append((at + len(prefix), body))
            if header:
                close()
        mark = prefix.strip()
        at += len(line) + 1
    close()
    return out


def seed_language(words: list[str], text: str) -> int | None:
    """The language of a segment by script or by function words; None where neither is clear."""
    counts = [(len(p.findall(text)), name) for name, p in _SCRIPTS]
    most, name = max(counts)
    if not most or most < 0.8 * sum(c for c, _ in counts):
        return None
    if name != "latin":
        return LANGS.index(name)
    hits = [0] * len(LANGS)
    for w in words:
        own = _SEED_OF.get(w)
        if own:
            for k in own:
                hits[k] += 1 / len(own)
    best = max(range(len(LANGS)), key=hits.__getitem__)
    second = max(h for k, h in enumerate(hits) if k != best)
    return best if hits[best] >= 2 and hits[best] >= 2 * second else None


def _spoken(text: str) -> list[str]:
    """The words of a segment that are no names: lower case, or in a script without case, or the first."""
    words = _WORD.findall(_SKIP.sub(" ", text))
    return [w.lower() for k, w in enumerate(words) if k == 0 or not w[0].isupper() or w.isupper()]


def _count(batches):
    import pyarrow as pa

    counts: dict[tuple[int, str], int] = {}
    for batch in batches:
        for text in batch.column("text").to_pylist():
            if not text:
                continue
            found = []
            for _, _, flat, _ in segments(text):
                words = _spoken(flat)
                if len(words) >= 2:
                    found.append((words, seed_language(words, flat)))
            sure = {k for _, k in found if k is not None}
            for words, k in found:
                # A segment that shows nothing itself goes by its text, where the rest is of one language in Latin script.
                if k is None and len(sure) == 1:
                    k = next(iter(sure)) if "a" <= min(words[0]) <= "ɏ" else None
                    if k is not None and LANGS[k] in ("he", "ru", "ar"):
                        k = None
                if k is not None:
                    for w in words:
                        counts[k, w] = counts.get((k, w), 0) + 1
        if len(counts) > 500_000:
            yield pa.RecordBatch.from_pydict({"lang": [k for k, _ in counts], "word": [w for _, w in counts], "n": list(counts.values())})
            counts = {}
    if counts:
        yield pa.RecordBatch.from_pydict({"lang": pa.array([k for k, _ in counts], pa.int32()), "word": [w for _, w in counts], "n": pa.array(list(counts.values()), pa.int64())})


class LanguageModel:
    """Log frequencies of words and of character n-grams in each language."""

    def __init__(self, counts: list[tuple[int, str, int]], gram_counts: list[tuple[int, str, float]], totals: list[int], spread: int, gram_totals: dict[tuple[int, int], float]):
        """counts: of words held; gram_counts: of n-grams held; totals, gram_totals: over all words by language, and by length and language; spread: distinct words in all."""
        size = len(LANGS)
        words: dict[str, list[int]] = {}
        grams: dict[str, list[float]] = {}
        for k, w, n in counts:
            words.setdefault(w, [0] * size)[k] += n
        for k, g, n in gram_counts:
            grams.setdefault(g, [0.0] * size)[k] += n
        self.words = {w: tuple(math.log((n + 0.05) / (1 + totals[k] + 0.05 * max(1, spread))) for k, n in enumerate(by)) for w, by in words.items()}
        self.counts = {w: tuple(by) for w, by in words.items()}
        self.grams = {g: tuple(math.log((n + 0.05) / (gram_totals.get((len(g), k), 0.0) + 501)) for k, n in enumerate(by)) for g, by in grams.items() if sum(by) > 1 or len(g) < 3}
        self.blank = tuple([0.0] * size)

    def word(self, w: str) -> tuple[tuple[float, ...], int]:
        """Scores of a word, and how they come about: 5 it is known, else the length of the n-grams, 0 where there are none."""
        known = self.words.get(w)
        if known is not None:
            return known, 5
        t = f" {w} "
        for m in (4, 3, 2, 1):
            got = [g for g in (self.grams.get(t[i : i + m]) for i in range(len(t) - m + 1)) if g is not None]
            if got and 2 * len(got) >= len(t) - m + 1:
                return tuple(sum(g[k] for g in got) / len(got) for k in range(len(LANGS))), m
        return self.blank, 0

    def judge(self, text: str) -> tuple[str | None, float, int]:
        """``(language, confidence, words that are its own)`` of a segment; None without words.

        Its own are known words no other language has twice as often, and unseen words whose longer n-grams speak for it most.
        """
        words = _spoken(text)
        if not words:
            return None, 0.0, 0
        size = len(LANGS)
        sums, seen = [0.0] * size, []
        for w in words:
            scores, known = self.word(w)
            for k in range(size):
                sums[k] += scores[k]
            if known > 2:
                seen.append((w, scores, known))
        best = max(range(size), key=sums.__getitem__)
        top = sums[best]
        rest = sum(math.exp(max(-60.0, s - top)) for s in sums)
        own = sum(1 for w, scores, known in seen if (2 * self.counts[w][best] >= max(self.counts[w]) if known == 5 else scores[best] == max(scores)))
        return LANGS[best], 1 / rest, own


def fit_languages(texts: DataFrame, vocabulary: int = VOCABULARY, most_grams: int = GRAMS) -> LanguageModel:
    """Count the words and character n-grams of every text of ``texts(text)``.

    The driver gets the ``vocabulary`` most frequent words of each language and the ``most_grams`` weightiest n-grams.
    """
    counts = cut(texts.select("text").mapInArrow(_count, "lang int, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    totals = {r.lang: r for r in counts.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()}
    spread = counts.select("word").distinct().count()
    # Types rather than tokens shape unseen words.
    spelt = counts.select("lang", F.concat(F.lit(" "), "word", F.lit(" ")).alias("t"), (1 + F.log(F.col("n").cast("double"))).alias("weight"))
    pieces = F.expr("flatten(transform(sequence(1, 4), m -> if(length(t) >= m, transform(sequence(1, length(t) - m + 1), i -> substr(t, i, m)), array())))")
    grams = cut(spelt.select("lang", "weight", F.explode(pieces).alias("gram")).groupBy("lang", "gram").agg(F.sum("weight").alias("weight")))
    sums = {(r.m, r.lang): r.weight for r in grams.groupBy("lang", F.length("gram").alias("m")).agg(F.sum("weight").alias("weight")).collect()}
    ranked = grams.withColumn("_rank", F.floor(F.log(F.col("weight") + 1) * 1000).cast("bigint"))  # classes of about equal weight
    gram_rows = [(r.lang, r.gram, r.weight) for r in most_frequent(ranked, "_rank", most_grams).collect()]
    kept = [(r.lang, r.word, r.n) for r in most_frequent_by(counts, "lang", "n", vocabulary).collect()]
    drop(counts)
    drop(grams)
    return LanguageModel(kept, gram_rows, [totals[k].n if k in totals else 0 for k in range(len(LANGS))], spread, sums)


class Judge:
    """Judges segments with a bounded cache; figures in a text make no difference to it."""

    _NUM = re.compile(r"\d+")

    def __init__(self, model: LanguageModel, cache: int = 100_000):
        self.model, self.size, self.cache = model, cache, {}

    def __call__(self, flat: str) -> tuple[str | None, float, int]:
        key = self._NUM.sub("0", flat)
        got = self.cache.get(key)
        if got is None:
            if len(self.cache) >= self.size:
                self.cache.clear()
            got = self.cache[key] = self.model.judge(flat)
        return got

    def sentences(self, text: str) -> set[str]:
        """The languages in which a text holds at least one whole sentence."""
        out = set()
        for _, _, flat, whole in segments(text):
            if whole or _POINTER.search(flat):
                lang, confidence, own = self(flat)
                if lang and confidence > 0.6 and own >= (3 if lang not in ("he", "ar", "ru") else 2):
                    out.add(lang)
        return out


def _texts(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("ingest_seq").cast("bigint").alias("ingest_seq"), F.col("body_text_clean").alias("text"), F.col("language").alias("label")).filter(F.col("text").rlike(r"(?U)\S"))


def _map(df: DataFrame, model: LanguageModel, each, schema: str) -> DataFrame:
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    sent = df.sparkSession.sparkContext.broadcast(model)
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        judge = Judge(sent.value)
        for batch in batches:
            rows = [x for r in zip(*(batch.column(c).to_pylist() for c in ("ingest_seq", "text", "label"))) for x in each(judge, *r)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], arrow.names)

    return df.mapInArrow(run, schema)


def mislabelled(messages: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """``(ingest_seq, lang)``: the languages of each message that is not wholly in the one its label names.

    One row for each language with at least one whole sentence. Null and blank texts, and texts
    without a sentence, are never cases; rows repeated are judged each for itself.
    """
    texts = _texts(messages)
    model = model or fit_languages(texts)

    def each(judge, seq, text, label):
        found = judge.sentences(text)
        return [] if found == {canonical_label(label)} else [(seq, lang) for lang in sorted(found)]

    return _map(texts, model, each, "ingest_seq bigint, lang string")


def text_segments(messages: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """``(ingest_seq, start_at, end_at, lang, confidence)``: stretches of one language within each text.

    Neighbouring segments of one language make one stretch with the mean confidence; segments
    without words of a language belong to the stretch before them.
    """
    texts = _texts(messages)
    model = model or fit_languages(texts)

    def each(judge, seq, text, label):
        runs: list[list] = []
        for start, end, flat, _ in segments(text):
            lang, confidence, own = judge(flat)
            if runs and (lang == runs[-1][2] or not own):
                runs[-1][1] = end
                if own:
                    runs[-1][3].append(confidence)
            elif own:
                runs.append([start, end, lang, [confidence]])
        return [(seq, s, e, lang, sum(c) / len(c)) for s, e, lang, c in runs]

    return _map(texts, model, each, "ingest_seq bigint, start_at int, end_at int, lang string, confidence double")


def text_language(messages: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """``(ingest_seq, language, confidence)`` of each text with words: the language of most of its characters."""
    texts = _texts(messages)
    model = model or fit_languages(texts)

    def each(judge, seq, text, label):
        mass: dict[str, float] = {}
        for _, _, flat, _ in segments(text):
            lang, confidence, own = judge(flat)
            if own:
                mass[lang] = mass.get(lang, 0.0) + len(flat) * confidence
        if not mass:
            return []
        best = max(sorted(mass), key=mass.__getitem__)
        return [(seq, best, mass[best] / sum(mass.values()))]

    return _map(texts, model, each, "ingest_seq bigint, language string, confidence double")

"""Problem 10: template residue, filler, error pages and script notices instead of content.

A linear classifier over hashed n-grams, length and title features judges each unit of a text
(a sentence or a line). Status lines and phrases give the first labels; what no rule knows is
unlabelled, not content. Two views carry the labels on to families that no rule knows: the words
of a unit, and where it stands (alone in a short text or amid much other text, and how often its
words stand so in the whole corpus). Units that both views are sure of join the labels for the
next round. A document is residue where its worst unit is.

Validation leaves out a third of the hosts together with a third of the phrase families, three
times over. Of the thresholds that do about best on them, the one is taken around which fewest
scores of unlabelled units lie.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from missiva.llm.samples import hash_sample
from missiva.session import cut, drop

#: Width of the hashed features of texts, and bins of the counts over the corpus.
WIDTH, BINS = 1 << 16, 1 << 18
#: Bounds of the fit, which is all they bound: documents drawn, and distinct units of each kind (known residue, unlabelled; of content three times as many).
SAMPLE_ROWS, FIT_UNITS = 20_000, 8_000
#: A unit stands alone with at most so many words of its document outside it, and no more than in it; amid content with at least so many outside.
ALONE_WORDS, AMONG_WORDS = 12, 30
FOLDS, ROUNDS, SURE = 3, 3, 2.0
#: Words are taken to have stood so often already, as all words stand; up to this band of the ratio they stand as content does.
PRIOR, COMMON = 5, 3

# Marks of unfilled places, as patterns.
PLACEHOLDERS = [
    ("curly2", r"\{\{[#/^>!]?\s*[\w.\s]{1,40}\}\}"),
    ("dollar", r"\$\{[\w.\s]{1,40}\}|\{\$[\w.]{1,40}\}|\$[A-Z][A-Z0-9_]{2,30}\$"),
    ("asp", r"<%=?\s*[\w.\s]{1,40}%>"),
    ("square2", r"\[\[\s*[\w\s.]{1,40}\]\]"),
    ("percent", r"%%[\w\s]{2,40}%%|%[A-Z][A-Z_]{2,30}%"),
    ("pipe", r"\*\|[\w:\s]{2,40}\|\*"),
    ("guillemet", r"«\s*[\w]+(?:[ _][\w]+){0,3}\s*»|<<\s*[\w\s]{2,30}>>"),
    ("hash", r"(?<![\w#])#[a-z]+_?[a-z_]{2,30}#(?![\w#])|@@\w{2,30}@@"),
    ("under", r"(?<!\w)__[A-Z][A-Z0-9_]{2,30}__(?!\w)|\bTBC_\w{2,30}_TBC\b|\bX{3,}[-_][A-Z_]{2,30}\b"),
    ("insert", r"[<\[(]\s*(?i:insert|enter|your|add|fill in|type)\s[\w\s]{2,40}[>\])]"),
    ("angle", r"<(?!/?(?:html|body|head|h[1-6]|p|br|div|span|a|b|i|u|li|ul|ol|td|tr|table|mailto|http)\b)[^\W\d][\w]*(?:[ _][\w]+){0,3}>|&lt;[\w\s]{2,40}&gt;"),
    ("blank", r"\[(?:date|name|amount|sum|תאריך|שם)\s*:?\s*_*\s*\]|\[[A-Z][a-z]+(?: [A-Z][a-z]+){0,2}\]"),
    ("single", r"(?<![\w$\[{(:\"%])\{[^\W\d]\w{1,30}\}(?!\w)|%\(\w{1,40}\)[sd]"),
    ("hebrew", r"\[[א-ת]+(?:[_ ][א-ת]+){0,3}\]"),
    ("index", r"(?<![\w$\[{(:\"])\{\d{1,2}\}(?!\w)"),
]
#: Every mark holds one of these; most units hold none.
_HINT = re.compile(r"[{}$%\[\]<>(*|«#@_]|&lt;|X{3}|TBC_")
_PLACES = re.compile("|".join(f"(?P<{n}>{p})" for n, p in PLACEHOLDERS))

# Phrases of pages and programs that stand in place of content, by family.
PHRASES = [
    ("status", r"^(?:<[^<>]{1,20}>|\W)*(?:error|http|status)?\W*[45]\d\d\W*(?:\||-|:)?\s*(?:error\b|forbidden|not found|bad gateway|bad request|unauthorized|service unavailable|gateway time-?out|internal server error|request rejected)"),
    ("status", r"^(?:<[^<>]{1,20}>|\W)*(?:internal server error|bad gateway|service (?:temporarily )?unavailable|gateway time-?out|page not found|access (?:is )?denied\.|forbidden)\W*(?:</?[^<>]{1,20}>\W*)*$"),
    ("status", r"^\W*http \d{3}\b"),
    ("status", r"^\W*error \d{3}: "),
    ("denied", r"\byou do(?: not|n't) have permission to (?:access|view)\b"),
    ("missing", r"\bthe requested (?:page|url|resource|document)\b.{0,60}\b(?:could not be|was not|cannot be) (?:located|found)\b"),
    ("missing", r"\bno longer available or the link has expired\b"),
    ("missing", r"\bsorry, we can'?t find that\b"),
    ("missing", r"\bla page demand[ée]e est introuvable\b|\bseite (?:wurde )?nicht gefunden\b|\bp[áa]gina no encontrada\b|\bp[áa]gina n[ãa]o encontrada\b"),
    ("missing", r"הדף המבוקש לא נמצא"),
    ("server", r"\bthe server (?:met|encountered) an (?:unexpected|internal)\b"),
    ("server", r"^\W*(?:the )?\w+ server did not answer\b"),
    ("trace", r"(?:^|\s)(?:java|javax|org|com)\.[\w.]*(?:exception|error)\b|^traceback \(most recent|^\s*at [\w.$]+\([\w.]+\.java:\d+\)|^\s*file \"[^\"]+\", line \d+"),
    ("trace", r"\bnull pointer at\b|\bis undefined\s*$|\bundefined is not (?:a function|an object)\b|\bsegmentation fault\b"),
    ("script", r"^(?:php )?(?:warning|notice|fatal error|parse error)\s*: .{0,80}(?:undefined|\bin /|on line \d)"),
    ("scripts", r"\b(?:please |must |need to )?(?:enable|activate|turn on) (?:java ?script|scripts|cookies)\b.{0,60}\b(?:view|run|continue|use|read|see|open|display)"),
    ("scripts", r"^javascript is (?:disabled|required|turned off)\b|^noscript\b|\bneeds scripts\b|\brequires? (?:java ?script|scripts)\b"),
    ("scripts", r"\bbrowser blockiert skripte\b|\bactive[zr] (?:le )?javascript\b|\bhabilite javascript\b|\bative o javascript\b|\bвключите javascript\b"),
    ("scripts", r"יש להפעיל javascript"),
    ("browser", r"\byour browser is (?:not supported|out of date|outdated)\b|\bchecking your browser before\b|\bcookies must be on\b"),
    ("latin", r"\blorem\b|\bdolor sit amet\b|(?:\b(?:ipsum|dolor|amet|consectetur|adipiscing|elit|tempor|fugiat|veniam|nostrud|magna|velit)\b\W+){3}"),
    ("sample", r"^\W*(?:this is a placeholder|sample text goes here|replace this paragraph|your text here|text goes here|dummy text|content goes here)"),
    ("again", r"\b(\w{1,12})(?:\W+\1\b){5,}|\bx{3,}(?:\s+x{2,}){3,}"),
    ("database", r"\b(?:database )?connection (?:failed|refused|timed out)\b|\btoo many clients\b"),
    ("keys", r"^\W*(?:asdf|qwerty|foo bar)\b"),
]
PHRASE_FAMILIES = list(dict.fromkeys(f for f, _ in PHRASES))
#: Each family of rules has a bit: the phrases first, then the marks of places.
_BIT = {f: 1 << k for k, f in enumerate([*PHRASE_FAMILIES, *(n for n, _ in PLACEHOLDERS)])}
_PHRASES = [(_BIT[f], re.compile("|".join(f"(?:{p})" for g, p in PHRASES if g == f), re.I | re.M)) for f in PHRASE_FAMILIES]

_SENTENCE = re.compile(r"(?<=[.!?。؟])(?<!\b[^\W\d_]\.)\s+(?![\d)])")
_WORD = re.compile(r"\w+|[^\w\s]")
_NUM = re.compile(r"\d+")


def units(text: str) -> list[str]:
    """The sentences of the lines of a text that hold a visible character."""
    out = []
    for line in text.split("\n"):
        line = line.strip()
        if line:
            out += [s for s in _SENTENCE.split(line) if s]
    return out


def families(unit: str) -> int:
    """The bits of the families of rules a unit shows."""
    got = 0
    for bit, p in _PHRASES:
        if p.search(unit):
            got |= bit
    if _HINT.search(unit):
        for m in _PLACES.finditer(unit):
            got |= _BIT[m.lastgroup]
    return got


def weak_label(unit: str) -> int | None:
    """1: residue by a status line, phrase or mark; None: no rule knows the unit."""
    return 1 if families(unit) else None


_BIN, _WIDE = BINS - 1, WIDTH - 1  # both are powers of two


def _hash(w: str) -> int:
    return zlib.crc32(w.encode("utf-8", "surrogatepass"))


class Words:
    """Hashes of words, and of their beginnings and ends, kept for a bounded number of words."""

    def __init__(self, most: int = 200_000):
        self.most, self.known = most, {}

    def __call__(self, w: str) -> tuple[int, tuple[int, ...]]:
        got = self.known.get(w)
        if got is None:
            if len(self.known) > self.most:
                self.known.clear()
            h = _hash(w)
            parts = (h, _hash("^" + w[:4]), _hash(w[-3:] + "$")) if len(w) > 3 else (h,)
            got = self.known[w] = (h, tuple(SHAPES + (x & _WIDE) for x in parts))
        return got


def fold(unit: str) -> str:
    """Figures make no difference to what a unit is."""
    return _NUM.sub("0", unit)


_OTHER = (0, 3, 8, ALONE_WORDS, AMONG_WORDS, 80)
_ODDS = (-1.0, -0.3, 0.3, 0.8, 1.3, 1.8, 2.4, 3.0, 3.6)


def _band(x: float, edges: tuple) -> int:
    """How many of the edges, in order, lie below x."""
    return bisect_left(edges, x)


# Ids of the features of shape and place; the hashed features of texts stand behind them.
_SHAPE = {n: k for k, n in enumerate([
    *(f"mark:{n}" for n, _ in PLACEHOLDERS), "mark", *(f"length:{k}" for k in range(9)), *(f"words:{k}" for k in range(9)), "title", "open", "again", "number first", "capitals", "path", "markup",
    *(f"other:{k}" for k in range(7)), *(f"odds:{k}" for k in range(10)), *(f"other:{a} odds:{b}" for a in range(7) for b in range(10)),
])}
SHAPES = len(_SHAPE)
_OTHER_AT, _ODDS_AT, _BOTH_AT, _TITLE = _SHAPE["other:0"], _SHAPE["odds:0"], _SHAPE["other:0 odds:0"], _SHAPE["title"]
_PATH = re.compile(r"/\w+/\w|\w\.\w+\(|\w\(\)|::|\w+\.\w+\.\w+")


class Unit:
    """What is known of a unit wherever it stands: number of words, ids for the counts, ids of features of text and of shape."""

    __slots__ = ("n", "bins", "text", "shape", "odds", "score")

    def __init__(self, unit: str, words: Words, featured: bool = True):
        names = {m.lastgroup for m in _PLACES.finditer(unit)} if _HINT.search(unit) else ()
        bare = _PLACES.sub(" PLACE ", unit) if names else unit
        found = _WORD.findall(bare.lower())
        self.n, self.odds, self.score = len(found), 0.0, 0.0
        get = words.known.get
        known = {w: get(w) or words(w) for w in found}
        h = [7, *[known[w][0] for w in found], 11]
        pairs = set(map(hash, zip(h, h[1:])))  # of pairs of numbers: the same in every process
        self.bins = [x & _BIN for x in {*h[1:-1], *pairs}]
        if not featured:
            return
        self.text = [x for k in known.values() for x in k[1]]
        self.text += [SHAPES + (x & _WIDE) for x in pairs]
        shape = [f"mark:{n}" for n in names]
        if names:
            shape.append("mark")
        shape += [f"length:{min(8, len(unit) // 20)}", f"words:{min(8, self.n // 4)}"]
        if unit[-1] not in ".!?;,:":
            shape.append("open")
        if self.n > 5 and len(set(found)) * 3 <= self.n:
            shape.append("again")
        if "0" in found[:2] and self.n <= 12:
            shape.append("number first")
        if unit.isupper():
            shape.append("capitals")
        if ("/" in unit or "(" in unit or "::" in unit or unit.count(".") > 1) and _PATH.search(unit):
            shape.append("path")
        if "<" in unit and ">" in unit:
            shape.append("markup")
        self.shape = [_SHAPE[s] for s in shape]


def _others(parsed: list[tuple[str, Unit]]) -> list[tuple[int, int]]:
    """For each unit the words of the document outside it and its repetitions, and how it stands: 0 alone, 2 amid content, 1 neither."""
    total, own = 0, {}
    for u, x in parsed:
        total += x.n
        own[u] = own.get(u, 0) + x.n
    return [(total - n, 0 if total - n <= min(ALONE_WORDS, n) else 2 if total - n >= AMONG_WORDS else 1) for n in (own[u] for u, _ in parsed)]


class Parser:
    """Units of texts, parsed once for a bounded number of short ones."""

    def __init__(self, featured: bool, then=None, most: int = 60_000):
        self.words, self.kept, self.featured, self.then, self.most = Words(), {}, featured, then, most

    def __call__(self, text: str) -> list[tuple[str, Unit]]:
        out = []
        for u in units(fold(text)):  # the same units as those of the text, folded: figures begin and end no sentence
            got = self.kept.get(u)
            if got is None:
                got = Unit(u, self.words, self.featured)
                if self.then:
                    self.then(got)
                if len(self.kept) > self.most:
                    self.kept.clear()
                if len(u) < 600:
                    self.kept[u] = got
            out.append((u, got))
        return out


def count_places(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """For each bin of words and pairs of words, how much more often than others it stands alone, as a log ratio.

    Counted over all documents; each task adds its counts up in arrays of a fixed size.
    """

    def run(batches):
        import pandas as pd

        parse, counts = Parser(False), np.zeros((2, BINS), dtype=np.int64)
        for pdf in batches:
            where: tuple[list, list, list] = ([], [], [])
            for text in pdf["text"]:
                parsed = parse(text)
                for (_, x), (_, stands) in zip(parsed, _others(parsed)):
                    where[stands].extend(x.bins)
            for k, w in enumerate((where[0], where[2])):
                counts[k] += np.bincount(np.array(w, dtype=np.int64), minlength=BINS)
        at = np.flatnonzero(counts.sum(0))
        yield pd.DataFrame({"bin": at, "alone": counts[0][at], "among": counts[1][at]})

    got = docs.select(F.col(f"`{text_col}`").alias("text")).filter(F.col("text").isNotNull()).mapInPandas(run, "bin bigint, alone bigint, among bigint").groupBy("bin").agg(F.sum("alone").alias("alone"), F.sum("among").alias("among")).toPandas()
    alone, among = np.zeros(BINS), np.zeros(BINS)
    alone[got["bin"]], among[got["bin"]] = got["alone"], got["among"]
    a, m = max(1.0, alone.sum()), max(1.0, among.sum())
    return (np.log((alone + PRIOR * a / (a + m)) / (among + PRIOR * m / (a + m))) - math.log(a / m)).astype(np.float32)


def _places(odds: np.ndarray):
    table = odds.tolist()

    def then(x: Unit) -> None:
        x.odds = _band(sum(map(table.__getitem__, x.bins)) / len(x.bins), _ODDS) if x.bins else 0

    return then


def labelled_units(docs: DataFrame, odds: np.ndarray, hidden: int) -> DataFrame:
    """The distinct units of documents ``(text, host)`` with their features, families of rules, and how they stand.

    ``stands``: 0 alone, 2 amid content or with words that mostly stand there, 1 neither. ``clean``: some document with the unit shows none of the rules (the families of all units of the documents, and-ed).
    ``documents``: in how many the unit is the first to show a rule.
    """
    sent = docs.sparkSession.sparkContext.broadcast(odds)

    def run(batches):
        import pandas as pd

        parse, rules = Parser(True, _places(sent.value)), {}

        def known(u: str) -> int:
            got = rules.get(u)
            if got is None:
                if len(rules) > 60_000:
                    rules.clear()
                got = rules[u] = families(u) & ~hidden
            return got

        for pdf in batches:
            out = []
            for text, host in zip(pdf["text"], pdf["host"]):
                fold_of, parsed = _hash(host) % FOLDS, parse(text)
                shown = [known(u) for u in units(text)]
                seen = all_shown = 0
                for s in shown:
                    all_shown |= s
                for k, ((u, x), (other, stands), s) in enumerate(zip(parsed, _others(parsed), shown)):
                    o = _band(other, _OTHER)
                    shape = [*x.shape, _OTHER_AT + o, _ODDS_AT + x.odds, _BOTH_AT + 10 * o + x.odds, *([_TITLE] if k == 0 else ())]
                    out.append((f"{u}\0{o}{k == 0}", fold_of, s, all_shown, 0 if stands == 0 and x.odds > COMMON else 2 if stands == 2 or x.odds <= COMMON else 1, int(s != 0 and not seen), shape, x.text))
                    seen |= s
            yield pd.DataFrame(out, columns=["unit", "fold", "families", "clean", "stands", "documents", "shape", "words"])

    raw = docs.select("text", "host").mapInPandas(run, "unit string, fold int, families bigint, clean bigint, stands int, documents int, shape array<int>, words array<int>")
    return raw.groupBy(F.xxhash64("unit").alias("unit"), "fold").agg(F.count("*").alias("n"), F.max("families").alias("families"), F.expr("bit_and(clean)").alias("clean"), F.first("stands").alias("stands"), F.sum("documents").alias("documents"), F.first("shape").alias("shape"), F.first("words").alias("words"))


class LinearModel:
    def __init__(self, weights: np.ndarray, bias: float, threshold: float, odds: np.ndarray, report: dict):
        self.weights, self.bias, self.threshold, self.odds, self.report = weights, bias, threshold, odds, report


def _train(at: np.ndarray, col: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float, start: tuple[np.ndarray, float] | None = None, rounds: int = 90) -> tuple[np.ndarray, float]:
    """L2-regularised logistic regression; classes weigh the same.

    Accelerated gradient steps, each weight's step from a bound of the curvature by the features a row shares.
    """
    w, b = (start[0].copy(), start[1]) if start else (np.zeros(SHAPES + WIDTH), 0.0)
    weight = np.where(y == 1, 0.5 * weight / max(1e-9, weight[y == 1].sum()), 0.5 * weight / max(1e-9, weight[y == 0].sum()))
    used, col = np.unique(col, return_inverse=True)
    bent = 0.25 * weight * (1 + np.bincount(at, minlength=len(y)))
    step, step_b = 1 / (np.bincount(col, bent[at], len(used)) + l2), 1 / bent.sum()
    by_row, by_col = np.argsort(at, kind="stable"), np.argsort(col, kind="stable")
    cols, row_from = col[by_row], np.searchsorted(at[by_row], np.arange(len(y)))
    rows, col_from = at[by_col], np.searchsorted(col[by_col], np.arange(len(used)))
    x, t = w[used], 1.0
    at_x, at_b = x, b
    for _ in range(rounds):
        err = (1 / (1 + np.exp(-np.clip(np.add.reduceat(at_x[cols], row_from) + at_b, -30, 30))) - y) * weight
        next_x, next_b = at_x - step * (np.add.reduceat(err[rows], col_from) + l2 * at_x), at_b - step_b * err.sum()
        t, t_old = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        at_x, at_b = next_x + (t_old - 1) / t * (next_x - x), next_b + (t_old - 1) / t * (next_b - b)
        x, b = next_x, next_b
    w[used] = x
    return w, float(b)


class Sample:
    """The drawn units as flat arrays."""

    def __init__(self, got):
        self.fold, self.families, self.clean, self.stands = (got[c].to_numpy() for c in ("fold", "families", "clean", "stands"))
        self.n = np.log2(1 + got["n"].to_numpy(dtype=np.float64))
        flat = lambda c: (np.repeat(np.arange(len(got)), [len(x) for x in got[c]]), np.concatenate([np.zeros(0, dtype=np.int64), *got[c]]).astype(np.int64))
        self.shape, self.words = flat("shape"), flat("words")

    def scores(self, w: np.ndarray, b: float) -> np.ndarray:
        k = len(self.n)
        return np.bincount(self.shape[0], w[self.shape[1]], k) + np.bincount(self.words[0], w[self.words[1]], k) + b

    def rows(self, keep: np.ndarray, y: np.ndarray, weight: np.ndarray):
        """The kept units twice: with all features, and with those of shape and place only, so that these carry weight where the words are new."""
        place = np.cumsum(keep) - 1
        (sa, sc), (wa, wc) = ((a[keep[a]], c[keep[a]]) for a, c in (self.shape, self.words))
        k = int(keep.sum())
        return np.concatenate([place[sa], place[wa], k + place[sa]]), np.concatenate([sc, wc, sc]), np.tile(y[keep], 2), np.tile(weight[keep], 2)


def _fit_fold(s: Sample, fold: int, l2: float) -> tuple[np.ndarray, float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Labels grow over the rounds. fold: the hosts left out, and with them the phrase families of that number; FOLDS leaves out none.

    Returns weights, bias, and of the hosts left out the scores of units of families left out, their families, and the scores of content and of what is neither.
    """
    hidden = sum(1 << k for k in range(len(PHRASE_FAMILIES)) if k % FOLDS == fold)
    train = s.fold != fold
    sure = (s.families & ~hidden) != 0
    content = ~sure & (s.stands == 2) & ((s.clean & ~hidden) == 0)
    open_ = ~sure & ~content
    y, weight, keep = sure.astype(float), s.n.copy(), train & (sure | content)
    model = None
    for turn in range(ROUNDS + 1):
        model = _train(*s.rows(keep, y, weight), l2, model)
        if turn < ROUNDS:
            got = s.scores(*model)
            joins = open_ & (s.stands == 0) & (got > SURE)
            leaves = open_ & (got < -SURE)
            y = (sure | joins).astype(float)
            weight = np.where(joins, 0.5 * s.n, s.n)
            keep = train & (sure | joins | leaves | content)
    out = s.fold == fold
    got = s.scores(*model)
    bad = out & (s.families != 0) & ~sure
    return *model, got[bad], s.families[bad], got[out & content & (s.clean == 0)], got[out & (s.families == 0) & open_]


def fit_residue(docs: DataFrame, text_col: str = "text", host_col: str = "sender_email", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS, l2: float = 3e-5, without: tuple[str, ...] = ()) -> LinearModel:
    """Fit on the units of about ``sample_rows`` documents, drawn by a hash of their key; counts cover all documents.

    Of the units at most about ``FIT_UNITS`` of each kind are taken, frequent ones first. Hosts are the domains of
    ``host_col``. without: families of rules that give no labels. The folds are fitted in tasks of their own.
    ``report`` has, by threshold, recall on the families and hosts left out and the share of content taken for residue.
    """
    spark = docs.sparkSession
    host = F.substring_index(F.coalesce(F.col(f"`{host_col}`"), F.lit("")), "@", -1)
    known = docs.filter(F.length(F.trim(F.col(f"`{text_col}`"))) > 0).select(F.col(f"`{text_col}`").alias("text"), host.alias("host"), F.col(f"`{key}`").alias("_key"))
    odds = count_places(docs, text_col)
    hidden = sum(_BIT[f] for f in without)
    found = cut(labelled_units(hash_sample(known, sample_rows, "_key").repartition(1 + sample_rows // 1000), odds, hidden))  # the draw ends in one partition
    kind = F.when(F.col("families") != 0, 0).when((F.col("stands") == 2) & (F.col("clean") == 0), 1).otherwise(2)
    totals = found.groupBy(kind.alias("kind")).agg(F.sum("n").alias("n"), F.sum("documents").alias("documents")).collect()
    sums, documents = {r["kind"]: r["n"] for r in totals}, sum(r["documents"] for r in totals)
    share = F.element_at(F.array(*(F.lit(min(1.0, FIT_UNITS * (3 if k == 1 else 1) / max(1, sums.get(k, 1)))) for k in (0, 1, 2))), kind + 1)
    got = found.filter(F.pmod(F.xxhash64(F.lit(5), "unit"), F.lit(1 << 30)) < share * F.col("n") * (1 << 30)).toPandas()
    drop(found)
    got = got.sort_values(["unit", "fold"], kind="stable")
    report = {"units": len(got), "held_out": 0}
    if not (got["families"] != 0).any():
        return LinearModel(np.zeros(SHAPES + WIDTH), -1.0, 0.0, odds, report)
    sent = spark.sparkContext.broadcast(Sample(got))

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for fold in pdf["id"]:
                w, b, bad, of, good, open_ = _fit_fold(sent.value, int(fold), l2)
                yield pd.DataFrame({"fold": [int(fold)], "w": [w.astype(np.float32).tobytes()], "b": [b], "bad": [bad.tolist()], "of": [of.tolist()], "good": [good.tolist()], "open": [open_.tolist()]})

    fits = spark.range(0, FOLDS + 1, 1, FOLDS + 1).mapInPandas(run, "fold int, w binary, b double, bad array<double>, of array<bigint>, good array<double>, open array<double>").collect()
    bad, of, good, open_ = (np.array([x for r in fits if r["fold"] < FOLDS for x in r[c]]) for c in ("bad", "of", "good", "open"))
    grid = [float(t) for t in np.arange(-2, 8.01, 0.25)]
    by, gain = {}, {}
    if len(bad) and len(good):
        kinds = [of == f for f in np.unique(of)]
        for t in grid:
            recall, wrong = float(np.mean([(bad[k] > t).mean() for k in kinds])), float((good > t).mean())
            by[t] = (recall, wrong)
            hit, false = recall * documents, wrong * sums.get(1, 0)
            gain[t] = round(2 * hit / max(1e-9, hit + false + documents), 2)
    # Of the thresholds that do about best, the one where fewest scores of unlabelled units lie around it.
    best = [t for t in grid if gain and gain[t] >= 0.98 * max(gain.values())] or [0.0]
    near = {t: int((np.abs(open_ - t) < 0.75).sum()) for t in best}
    best = [t for t in best if near[t] == min(near.values())]
    last = next(r for r in fits if r["fold"] == FOLDS)
    report |= {"held_out": len(bad), "held_out_content": len(good), "by_threshold": by}
    return LinearModel(np.frombuffer(last["w"], dtype=np.float32), last["b"], best[len(best) // 2], odds, report)


def score_documents(docs: DataFrame, model: LinearModel, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, is_residue)``: the worst unit's score. Null and blank texts score null and are no residue."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pandas as pd

        m = sent.value
        w, place = m.weights.tolist(), _places(m.odds)

        def then(x: Unit) -> None:
            place(x)
            x.score = m.bias + sum(map(w.__getitem__, x.shape)) + sum(map(w.__getitem__, x.text)) + w[_ODDS_AT + x.odds]

        parse = Parser(True, then)
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                parsed, worst = parse(text) if text else [], None
                for k, ((_, x), (other, _)) in enumerate(zip(parsed, _others(parsed))):
                    o = _band(other, _OTHER)
                    s = x.score + w[_OTHER_AT + o] + w[_BOTH_AT + 10 * o + x.odds] + (w[_TITLE] if k == 0 else 0.0)
                    worst = s if worst is None or s > worst else worst
                out.append(worst)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": pd.array(out, dtype="Float64"), "is_residue": [s is not None and s > m.threshold for s in out]})

    return docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInPandas(run, "doc_id bigint, score double, is_residue boolean")

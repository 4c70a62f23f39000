"""Problem 3: text garbled by a wrong decoding.

A smoothed character n-gram model is counted over all clean records. Each token with characters
beyond ASCII is put through every chain of steps "encode with the wrong codec, decode with the
right one"; the likeliest reading is compared with the token as it stands, and a field is damaged
where one chain gains more than a margin over its tokens. The margin is validated on all clean
records, each also damaged on purpose.
"""

from __future__ import annotations

import array
import codecs
import math
import re
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from missiva.session import cut

#: Bins of the hashed counts: the model has this size whatever the corpus has.
BINS = 1 << 20
#: Margins to choose from, in rising order.
MARGINS = (3.0, 4.0, 5.0, 6.0, 8.0, 12.0)

# Codecs text was wrongly read with, and single-byte codecs it was written in.
WRONG = ["cp1252", "latin-1", "cp1255", "cp1256", "cp1251", "mac_roman", "cp437", "cp850", "cp862", "cp866", "koi8-r", "iso8859-8", "iso8859-15"]
RIGHT = ["cp1255", "cp1251", "cp1256", "cp1252", "koi8-r", "cp862", "cp866", "mac_roman"]
#: Which single-byte pairs are tried: (wrongly read with, written in).
PAIRS = [(w, r) for w in ("cp1252", "latin-1", "cp1251", "cp1255", "cp437", "cp862", "mac_roman", "koi8-r", "cp866") for r in RIGHT if w != r]

REPLACEMENT = "�"


@lru_cache(None)
def _encoder(codec: str) -> dict[str, int]:
    """Character to byte; bytes the codec leaves undefined stand for their own code point, as lenient decoders have it."""
    out = {}
    for b in range(256):
        try:
            out.setdefault(bytes([b]).decode(codec), b)
        except UnicodeDecodeError:
            out.setdefault(chr(b), b)
    return out


@lru_cache(None)
def _charmap(codec: str) -> dict[int, int]:
    return {ord(c): b for c, b in _encoder(codec).items()}


@lru_cache(None)
def _decoder(codec: str) -> str:
    """The character of each byte; U+FFFE, which stops the decoder, where there is none."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            out.append("\ufffe")
    return "".join(out)


def _bytes(text: str, codec: str) -> bytes | None:
    try:
        return codecs.charmap_encode(text, "strict", _charmap(codec))[0]
    except UnicodeEncodeError:
        return None


def step(text: str, wrong: str, right: str) -> str | None:
    """The text as it reads when its bytes under ``wrong`` are decoded with ``right``; None where they cannot be."""
    raw = _bytes(text, wrong)
    return None if raw is None else _read(raw, right, text)


def _read(raw: bytes, right: str, text: str) -> str | None:
    if right == "utf-8":
        try:
            out = raw.decode("utf-8")
        except UnicodeDecodeError:
            return None
    else:
        try:
            out = codecs.charmap_decode(raw, "strict", _decoder(right))[0]
        except UnicodeDecodeError:
            return None
    return None if out == text else out


def readings(token: str, depth: int = 4) -> dict[tuple, str]:
    """Every chain that can be applied to the token, with what it gives."""
    found: dict[tuple, str] = {}
    seen, level = {token}, [((), token)]
    for d in range(depth):
        new = []
        for chain, text in level:
            raws = {w: raw for w in WRONG if (raw := _bytes(text, w)) is not None}  # those of PAIRS are among them
            for w, raw in raws.items():
                out = _read(raw, "utf-8", text)
                if out is not None and out not in seen:
                    seen.add(out)
                    new.append((chain + ((w, "utf-8"),), out))
            for w, r in PAIRS if d < 2 else ():
                out = _read(raws[w], r, text) if w in raws else None
                if out is not None and out not in seen:
                    seen.add(out)
                    found[chain + ((w, r),)] = out
        found.update(new)
        level = [x for x in new if not x[1].isascii()]
    return found


_SPACE, _DIGIT = re.compile(r"[\s\xa0]+"), re.compile(r"\d")


def _fold(text: str) -> str:
    return _DIGIT.sub("0", _SPACE.sub(" ", text.lower()))


def _bins(text: str) -> list[int]:
    """Hash bins of the trigrams, bigrams and single characters of a text (one after another for each character)."""
    t = "  " + _fold(text) + " "
    a, b, out = ord(t[0]), ord(t[1]), []
    for ch in t[2:]:
        c = ord(ch)
        out += ((a * 1_000_003 ^ b * 8_191 ^ c * 131) * 2_654_435_761 >> 7 & BINS - 1, (b * 1_000_033 ^ c * 257) * 2_246_822_519 >> 5 & BINS - 1 | 0, c * 2_654_435_761 >> 3 & BINS - 1)
        a, b = b, c
    return out


class NgramModel:
    """Interpolated trigram model over hashed counts: three arrays of ``BINS`` numbers."""

    def __init__(self, tri, bi, uni):
        self.tri, self.bi, self.uni = (array.array("f", np.asarray(x, dtype="float32").tobytes()) for x in (tri, bi, uni))
        self.total = max(1.0, float(sum(self.uni)))

    def logp(self, text: str) -> float:
        """Natural log likelihood of the text as a token between spaces."""
        tri, bi, uni, total = self.tri, self.bi, self.uni, self.total
        ids, s = _bins(text), 0.0
        before = total  # count of the two characters before, as a context
        before1 = total
        for k in range(0, len(ids), 3):
            t, b, u = tri[ids[k]], bi[ids[k + 1]], uni[ids[k + 2]]
            p = 0.7 * t / (before + 2.0) + 0.2 * b / (before1 + 2.0) + 0.0999 * u / total + 1e-7
            s += math.log(p)
            before, before1 = b, u
        return s


_HIGH = re.compile(r"[À-ÿ]{2,}")
# Pairs of characters that UTF-8 read with a single-byte codec leaves behind.
_BAD = re.compile(
    "[\ufffd\x80-\x9f]|[ÃÂÐÑØÙ×][\x80-¿‚„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ€]|[׳ֲ][^֐-׿\\s\x00-\x7f]|\\?\\?"
    "|â[\x80-¿‚„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ€]|ג[€‚„]|‚[Ä-Ç]|¬[^\\s\x00-\x7f]|√[^\\s\\d\x00-\x40]|[╫╪┘├╨╤][^\\s\x00-\x7f]|[РС][^а-яА-ЯёЁ\\s\x00-\x7f]|[طظ][^ء-ي\\s\x00-\x7f]|ֳ|Ѓ|Ђ|[а-я][А-Я]{2}"
)


def looks_clean(text: str) -> bool:
    """No sign of damage at first sight: such records train the model."""
    if _BAD.search(text):
        return False
    high = [w for w in (x.strip(".,;:!?()") for x in text.split()) if _HIGH.fullmatch(w)]  # words of accented letters only
    return len(high) < 2 and all(len(w) < 4 for w in high)


def _count(batches):
    import pandas as pd

    tri, bi, uni = (np.zeros(BINS, dtype=np.int64) for _ in range(3))
    cache: dict[str, list[int]] = {}
    for pdf in batches:
        counts: dict[str, int] = {}
        for text in pdf["text"]:
            if text and looks_clean(text):
                for token in text.split():
                    counts[token] = counts.get(token, 0) + 1
        for token, n in counts.items():
            ids = cache.get(token)
            if ids is None:
                ids = _bins(token)
                if len(cache) < 50_000:
                    cache[token] = ids
            for k in range(0, len(ids), 3):
                tri[ids[k]] += n
                bi[ids[k + 1]] += n
                uni[ids[k + 2]] += n
    for kind, a in enumerate((tri, bi, uni)):
        at = np.flatnonzero(a)
        if len(at):
            yield pd.DataFrame({"kind": np.full(len(at), kind, dtype=np.int32), "bin": at.astype(np.int32), "n": a[at]})


def fit_ngrams(texts: DataFrame) -> NgramModel:
    """Count over every clean record of ``texts(text)``; what reaches the driver is at most 3 x ``BINS`` counts."""
    got = texts.select("text").mapInPandas(_count, "kind int, bin int, n bigint").groupBy("kind", "bin").agg(F.sum("n").alias("n")).toPandas()
    arrays = []
    for kind in range(3):
        a = np.zeros(BINS, dtype=np.float32)
        part = got[got["kind"] == kind]
        a[part["bin"].to_numpy()] = part["n"].to_numpy()
        arrays.append(a)
    return NgramModel(*arrays)


_TOKEN = re.compile(r"[^ \n\r\t]+")
_LOST_WORD = re.compile(r"(?:(?<=\s)|^)[\"'(]*\?{2,}[.,;:!?)\"']*(?=\s|$)")
_LOST_LETTER = re.compile(r"(?<![\w/=&?.])[^\W\d_]+\?[^\W\d_]+(?![\w/=&])")


_ODD = re.compile("[\x00-\x1f\x7f-\xa0\xad]")
_LATIN, _OTHER = re.compile("[A-Za-zÀ-ɏ]"), re.compile("[Ͱ-῿]")


def _mixed(token: str) -> bool:
    """Letters of Latin and of another script in one token: no reading of a single-byte codec is that."""
    return bool(_LATIN.search(token) and _OTHER.search(token))


class Repairer:
    """Finds and undoes damage, field by field. Readings of tokens are kept in a bounded cache."""

    def __init__(self, model: NgramModel, margin: float = 8.0, per_char: float = 0.4, cache: int = 100_000):
        self.model, self.margin, self.per_char, self.size = model, margin, per_char, cache
        self.cache: dict[str, list] = {}

    def _gains(self, token: str) -> list[tuple[tuple, str, float]]:
        """(chain, reading, gain) of the token's likelier readings, best first."""
        got = self.cache.get(token)
        if got is None:
            base, got = self.model.logp(token), []
            for chain, text in readings(token).items():
                if chain[-1][1] != "utf-8" and (_mixed(text) or _ODD.search(text)):
                    continue
                # Steps have a price, so that of two equal readings the shorter chain wins. A token
                # of fewer characters is not likelier for that alone: compare at the same length.
                gain = self.model.logp(text) - base - 1.0 * len(chain)
                if gain > 0:
                    got.append((chain, text, gain))
            got.sort(key=lambda x: -x[2])
            if len(self.cache) >= self.size:
                self.cache.clear()
            self.cache[token] = got
        return got

    def scan(self, text: str | None):
        """``(damaged, restored text or None, gain, lost)``. Null and empty texts are not damaged."""
        if not text:
            return False, None, 0.0, False
        lost = REPLACEMENT in text or len(_LOST_WORD.findall(text)) >= 2 or len(_LOST_LETTER.findall(text)) >= 2 or bool(re.fullmatch(r"[\s?]*\?{3,}[\s?\w/#-]*", text) and text.count("?") > 3)
        if text.isascii():
            return lost, None, 0.0, lost
        spots, sums, sizes, proof = [], {}, {}, {}
        for m in _TOKEN.finditer(text):
            token = m.group()
            if token.isascii():
                continue
            gains = self._gains(token)
            if gains:
                spots.append((m.start(), m.end(), gains))
                wide = max(0.3, sum(c > "\x7f" for c in token) - 1)
                for chain, _, gain in gains:
                    sums[chain] = sums.get(chain, 0.0) + gain
                    sizes[chain] = sizes.get(chain, 0) + len(token)
                    # UTF-8 proves itself by its form; single-byte codecs need more than a stray sign or two.
                    proof[chain] = proof.get(chain, 0) + (9 if chain[-1][1] == "utf-8" else wide)
        chosen: dict[tuple, float] = {c: g for c, g in sums.items() if g > self.margin and g > self.per_char * sizes[c] and proof[c] >= 3}
        if not chosen:
            return lost, None, max(sums.values(), default=0.0), lost
        out, at = [], 0
        for start, end, gains in spots:
            # The chain that explains most of the field goes first.
            best = max((g for g in gains if g[0] in chosen), key=lambda g: chosen[g[0]], default=None)
            if best:
                out += [text[at:start], best[1]]
                at = end
        return True, "".join(out) + text[at:], max(chosen.values()), lost


def damage(text: str, wrong: str, right: str = "utf-8") -> str | None:
    """The text as it would read had its bytes under ``right`` been decoded with ``wrong``."""
    raw = _bytes(text, right) if right != "utf-8" else text.encode()
    if raw is None:
        return None
    back = {b: c for c, b in _encoder(wrong).items()}
    return "".join(back.get(b, chr(b)) for b in raw)


# Fixed values: (wrongly read with, written in), ways in which clean records are damaged.
_WAYS = [("cp1252", "utf-8"), ("latin-1", "utf-8"), ("cp1255", "utf-8"), ("cp1252", "cp1255"), ("latin-1", "cp1251"), ("mac_roman", "utf-8")]


def hurt(text: str) -> str | None:
    """The text with one line damaged, line and way chosen by its hash; None where that changes nothing."""
    k, lines = zlib.crc32(text.encode("utf-8", "surrogatepass")), text.split("\n")
    i, (w, r) = k // len(_WAYS) % len(lines), _WAYS[k % len(_WAYS)]
    lines[i] = damage(lines[i], w, r) or lines[i]
    out = "\n".join(lines)
    return None if out == text else out


def best_margin(counts: dict[tuple[bool, int], int]) -> tuple[float, dict]:
    """The margin with the best F1; ties go to the larger one. counts: texts by (damaged on purpose, number of ``MARGINS`` their gain exceeds)."""
    good, bad = (sum(n for (d, _), n in counts.items() if d == k) for k in (False, True))
    report, best = {}, (-1.0, 8.0)
    for i, m in enumerate(MARGINS):
        fp, tp = (sum(n for (d, above), n in counts.items() if d == k and above > i) for k in (False, True))
        f1 = 2 * tp / max(1, 2 * tp + fp + bad - tp)
        report[m] = {"recall": tp / max(1, bad), "false": fp / max(1, good), "f1": f1}
        best = max(best, (round(f1, 4), m))
    return best[1], report


def _judge(long: DataFrame, model: NgramModel) -> DataFrame:
    """What passes without a margin, ``(row_id, field, text)``, and the counts that ``best_margin`` reads, ``(hurt, above, n)`` for each task.

    Texts of ASCII only gain nothing under any margin and are not counted.
    """
    sent = long.sparkSession.sparkContext.broadcast(model)
    schema = "row_id bigint, field string, text string, hurt boolean, above int, n bigint"

    def run(batches):
        import pandas as pd

        tool, counts = Repairer(sent.value, margin=0.0), {}
        for pdf in batches:
            rows = []
            for row_id, field, text in zip(pdf["row_id"], pdf["field"], pdf["text"]):
                hit, _, gain, _ = tool.scan(text)
                if hit:
                    rows.append((row_id, field, text, None, None, None))
                if text and not text.isascii() and looks_clean(text):
                    bad = hurt(text)
                    for k, g in ((False, gain), (True, tool.scan(bad)[2])) if bad else ((False, gain),):
                        at = k, sum(g > m for m in MARGINS)
                        counts[at] = counts.get(at, 0) + 1
            if rows:
                yield pd.DataFrame(rows, columns=["row_id", "field", "text", "hurt", "above", "n"])
        if counts:
            yield pd.DataFrame([(None, None, None, k, above, n) for (k, above), n in counts.items()], columns=["row_id", "field", "text", "hurt", "above", "n"])

    return long.mapInPandas(run, schema)


def fields_long(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    return df.select(F.col(key).cast("bigint").alias("row_id"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("text")) for f in fields])).alias("_v")).select("row_id", "_v.*")


def find_garbled(df: DataFrame, key: str = "row_id", fields: tuple[str, ...] = ("subject", "body"), model: NgramModel | None = None, margin: float | None = None) -> DataFrame:
    """``(row_id, field, restored, lost)``: each damaged field.

    restored holds the text with every passage that could be read in its place (unreadable rests
    stay as they are); it is null where nothing could be had. lost: characters are gone for good.
    Null and empty fields are never cases, rows repeated are judged each for itself, and an empty
    table gives no rows. Whole texts are read; further columns are ignored. Where no margin is given,
    it is chosen on all clean records with characters beyond ASCII.
    """
    long = fields_long(df, key, list(fields))
    if model is None:
        model = fit_ngrams(long)
    if margin is None:
        # A larger margin finds a part of what none finds: only that is read again.
        judged = cut(_judge(long, model))
        margin, _ = best_margin({(r.hurt, r.above): r.n for r in judged.filter("n IS NOT NULL").groupBy("hurt", "above").agg(F.sum("n").alias("n")).collect()})
        long = judged.filter("n IS NULL").select("row_id", "field", "text")
    sent = df.sparkSession.sparkContext.broadcast((model, margin))

    def run(batches):
        import pandas as pd

        tool = Repairer(*sent.value)
        for pdf in batches:
            rows = []
            for row_id, field, text in zip(pdf["row_id"], pdf["field"], pdf["text"]):
                hit, fixed, _, lost = tool.scan(text)
                if hit:
                    rows.append((row_id, field, fixed, lost))
            yield pd.DataFrame(rows, columns=["row_id", "field", "restored", "lost"])

    return long.mapInPandas(run, "row_id bigint, field string, restored string, lost boolean")

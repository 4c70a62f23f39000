"""Scalar text functions as column expressions; all of them run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as str.strip() has it (WS), the same without line feed (WSL), reply prefixes.
WS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WSL = r"\t\x{0b}-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
PREFIXES = "re|fw|fwd|sv|aw|wg|תגובה|השב|הועבר|העברה"
FORWARD, REPLY = "fw|fwd|הועבר|העברה", "re|תגובה|השב"
CONTROL = r"[\x{00}-\x{08}\x{0b}-\x{1f}]"
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]
NO_TITLE = "ללא כותרת"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """body(value), with value computed once; the optimizer would copy a plain column into each of its uses."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column | str) -> Column:
    """Without white space of any kind at either end."""
    return F.btrim(col(c), F.lit(_WS_CHARS))


def normalize_whitespace(c: Column | str) -> Column:
    """LF line ends, single blanks within lines, no blanks around them, at most one blank line together; null stays null."""
    t = F.replace(F.replace(col(c), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    t = F.regexp_replace(t, r"[ \t]{2,}|\t", " ")
    lines = F.transform(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(_WS_CHARS.replace("\n", ""))))
    return strip(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"))


def normalize_subject(c: Column | str) -> Column:
    """Without stacked reply prefixes and ``[external]`` tags, in lower case; null gives ""."""
    t = F.regexp_replace(F.coalesce(col(c), F.lit("")), "[‏‎]", "")
    t = F.regexp_replace(t, rf"(?iu)\A[{WS}]*(?:(?:{PREFIXES})[{WS}]*[:：][{WS}]*)+", "")
    t = F.regexp_replace(t, r"(?iu)\[[^\]]*(?:external|חיצוני)[^\]]*\]", "")
    return F.lower(strip(F.regexp_replace(t, rf"[{WS}]+", " ")))


def normalize_email(c: Column | str) -> Column:
    """Trimmed, without angle brackets, in lower case; null where nothing is left."""
    return F.nullif(F.lower(F.regexp_replace(strip(c), r"\A[<>]+|[<>]+\z", "")), F.lit(""))


def folder_path(c: Column | str) -> Column:
    """A path with slashes between its parts, without empty ones and ".": as folders are stored."""
    parts = F.split(F.replace(col(c), F.lit("\\"), F.lit("/")), "/", -1)
    return F.array_join(F.filter(parts, lambda p: ~p.isin("", ".")), "/")


def folder_filter(c: Column | str) -> Column:
    """What a request for a folder is compared by: slashes, none at the ends, lower case."""
    return F.lower(F.btrim(F.replace(col(c), F.lit("\\"), F.lit("/")), F.lit("/")))


def reply_forward(c: Column | str) -> Column:
    t = strip(F.lower(col(c)))
    return F.when(t.rlike(rf"\A(?:{FORWARD})[{WS}]*[:：]"), "forward").when(t.rlike(rf"\A(?:{REPLY})[{WS}]*[:：]"), "reply")


def html_to_text(c: Column | str) -> Column:
    """Text of HTML: scripts, styles and heads go, each run of tags breaks the line."""
    t = F.regexp_replace(col(c), r"(?is)<(script|style|head)\b.*?</\1\s*>|<!--.*?-->|<meta\b[^>]*>", "")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>", "<br>\n<br>")
    t = F.regexp_replace(t, r"(?i)</(p|div|tr|li)\s*>", "\n</$1>")
    t = F.regexp_replace(t, r"(?:</?[A-Za-z!][^>]*>)+", "\n")
    for entity, char in ENTITIES:
        t = F.replace(t, F.lit(entity), F.lit(char))
    return normalize_whitespace(t)


def word_count(c: Column | str) -> Column:
    t = strip(c)
    return F.when(t == "", 0).otherwise(F.size(F.split(t, rf"[{WS}]+")))


def strip_control(c: Column | str) -> Column:
    return F.regexp_replace(col(c), CONTROL, "")


def search_text(c: Column | str) -> Column:
    """Lower case, with one blank in place of each run that holds no letter, digit, underscore or Hebrew mark; null gives ""."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), r"[^a-z\x{590}-\x{5ff}0-9_\pL\pN]+", " "))


def subject_snippet(c: Column | str, longest: int = 120) -> Column:
    return F.coalesce(F.nullif(F.substring(normalize_whitespace(normalize_subject(c)), 1, longest), F.lit("")), F.lit(NO_TITLE))


def embedding_text(subject: Column | str, body: Column | str, body_chars: int = 3500) -> Column:
    """The subject twice and the start of the body, as the vectoriser reads it."""
    return normalize_whitespace(F.concat(col(subject), F.lit("\n"), col(subject), F.lit("\n"), F.substring(col(body), 1, body_chars)))


def tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(col(c)), F.lit(r"([\x{590}-\x{5ff}A-Za-z0-9][\x{590}-\x{5ff}A-Za-z0-9_-]+)"), 1)


def has_keyword(text: Column, words: list[str]) -> Column:
    """Whether one of the words stands in the text with no word character next to it."""
    alternatives = "|".join(rf"\Q{w.lower()}\E" for w in words)
    return text.rlike(rf"(?iuU)(?<!\w)(?:{alternatives})(?!\w)")


def sanitize_filename(c: Column | str, fallback: str = "file", longest: int = 160) -> Column:
    """A name that file systems take: no reserved characters or device names, bounded, ending kept."""
    t = strip(F.coalesce(F.nullif(col(c), F.lit("")), F.lit(fallback)))
    t = F.regexp_replace(F.regexp_replace(t, r'[<>:"/\\|?*\x{00}-\x{1f}]', "_"), "_+", "_")
    t = F.regexp_replace(F.regexp_replace(t, rf"[{WS}]+", " "), r"\A[ .]+|[ .]+\z", "")
    t = F.when(t == "", fallback).otherwise(t)
    suffix = F.regexp_extract(t, r"\A.+(\.[^.]+)\z", 1)
    stem = F.substring(t, F.lit(1), F.length(t) - F.length(suffix))
    stem = F.when(F.upper(stem).rlike(r"\A(?:CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9])\z"), F.concat(stem, F.lit("_"))).otherwise(stem)
    return F.concat(F.substring(stem, F.lit(1), F.greatest(F.lit(1), F.lit(longest) - F.length(suffix))), suffix)


def truncate_body(c: Column | str, longest: int, marker: str) -> Column:
    t = col(c)
    return F.when(F.length(t) > longest, F.concat(F.regexp_replace(F.substring(t, 1, longest), rf"[{WS}]+\z", ""), F.lit(marker))).otherwise(t)


def split_header(c: Column | str) -> Column:
    return F.filter(F.transform(F.split(F.translate(col(c), ";", ","), ","), strip), lambda x: x != "")


def clean_header_id(c: Column | str) -> Column:
    return F.nullif(F.regexp_replace(strip(c), r"\A[<>]+|[<>]+\z", ""), F.lit(""))


def as_float(c: Column | str) -> Column:
    return strip(c).try_cast("double")


def occurrences(text: Column, mark: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))) / F.lit(len(mark))


def count_matching(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def text_quality(c: Column | str) -> Column:
    """How much a decoded text looks like text: printable, Hebrew and Latin count for it, damage against."""
    t = col(c)
    n = F.length(t)
    printable = n - count_matching(t, r"[\p{C}\p{Zl}\p{Zp}&&[^\r\n\t]]|[\p{Zs}&&[^ ]]")
    marks = sum((occurrences(t, m) for m in ("×", "Ã", "Â", "׳", "ֲ", "ג€", "ן¿½")), F.lit(0.0))
    control = count_matching(t, r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}\x{7f}-\x{9f}]")
    score = printable / n * 20 + count_matching(t, "[א-ת]") * 3 + count_matching(t, "[a-zA-Z]") * 0.25 - (occurrences(t, "�") + occurrences(t, "?")) * 50 - marks * 30 - control * 15
    return F.when(F.coalesce(n, F.lit(0)) == 0, F.lit(-1000000.0)).otherwise(score)


def json_part(c: Column) -> Column:
    """A scalar as Python's json has it; null is ``null``."""
    j = F.to_json(F.array(c))
    return F.when(c.isNull(), F.lit("null")).otherwise(F.substring(j, F.lit(2), F.length(j) - 2))


def json_list(c: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(c, json_part), ", "), F.lit("]"))


def stable_hash(*parts: Column) -> Column:
    """SHA-256 of the parts as a JSON list with ", " between them. Array columns must come through ``json_list``."""
    return F.sha2(F.concat(F.lit("["), F.concat_ws(", ", *parts), F.lit("]")), 256)


def iso_week(ts: Column | str) -> Column:
    t = col(ts)
    return F.when(t.isNotNull(), F.format_string("%d-W%02d", F.extract(F.lit("YEAROFWEEK"), t), F.weekofyear(t)))

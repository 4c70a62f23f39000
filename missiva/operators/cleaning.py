"""The rule-based cleaner of bodies: a pipeline over arrays of lines, without Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from missiva.functions.text import WS, let, normalize_whitespace, strip

# Lines that begin quoted history, lines that begin a signature, marks of quotation.
REPLY_LINES = (
    r"(?iu)\A(?:-{2,}[{WS}]*(?:Original Message|הודעה מקורית)[{WS}]*-{2,}\z|_{5,}[{WS}]*\z|From:[{WS}]+.+|Sent:[{WS}]+.+|To:[{WS}]+.+|Subject:[{WS}]+.+"
    r"|מאת:[{WS}]+.+|נשלח:[{WS}]+.+|אל:[{WS}]+.+|נושא:[{WS}]+.+|בתאריך[{WS}]+.+כתב/?ה?:[{WS}]*\z|On[{WS}]+.+wrote:[{WS}]*\z|Begin forwarded message:)"
).replace("{WS}", WS)
SIGNATURE_LINES = r"(?iu)\A(?:--|(?:best regards|kind regards|regards|thanks|thank you|sincerely|yours|cheers),?|(?:בברכה|תודה|תודה רבה|בכבוד רב|בברכת חברים|יום טוב|שבת שלום),?)\z"
QUOTED_LINE = rf"\A[{WS}]*[>|]"


def clean(body: Column | str) -> Column:
    """A struct ``text, mostly_quoted, notes``; null and empty bodies give "", false and ``empty_body``."""
    source = normalize_whitespace(F.coalesce(F.col(body) if isinstance(body, str) else body, F.lit("")))

    def build(src: Column) -> Column:
        return let(F.split(src, "\n", -1), lambda lines: let(facts(lines), lambda f: let(kept(lines, f), lambda rest: sign(src, f, rest))))

    def facts(lines: Column) -> Column:
        quoted = F.size(F.filter(lines, lambda x: x.rlike(QUOTED_LINE))) / F.size(lines) >= 0.6
        cut = F.array_position(F.transform(lines, lambda x, i: (i > 0) & strip(x).rlike(REPLY_LINES)), F.lit(True)).cast("int")
        return F.struct(quoted.alias("quoted"), cut.alias("cut"))

    def kept(lines: Column, f: Column) -> Column:
        head = F.when(f["cut"] > 0, F.slice(lines, F.lit(1), f["cut"] - 1)).otherwise(lines)
        return F.filter(head, lambda x: ~x.rlike(QUOTED_LINE))

    def sign(src: Column, f: Column, rest: Column) -> Column:
        # The signature is looked for in the last twelve lines only.
        skip = F.greatest(F.size(rest) - 12, F.lit(0))
        last = F.slice(rest, skip + 1, F.lit(12))
        place = F.array_max(F.filter(F.transform(last, lambda x, i: F.when(strip(x).rlike(SIGNATURE_LINES), i)), lambda i: i.isNotNull()))

        def cut_at(s: Column) -> Column:
            text = normalize_whitespace(F.array_join(F.when(s.isNull(), rest).otherwise(F.slice(rest, F.lit(1), s)), "\n"))
            return let(
                text,
                lambda t: F.struct(
                    t.alias("text"),
                    (f["quoted"] | (F.length(t) < F.greatest(F.lit(80.0), F.length(src) * 0.25))).alias("mostly_quoted"),
                    F.array_compact(F.array(F.when(f["cut"] > 0, "reply_history_removed"), F.when(s.isNotNull(), "signature_removed"))).alias("notes"),
                ),
            )

        return let(skip + place, cut_at)

    empty = F.struct(F.lit("").alias("text"), F.lit(False).alias("mostly_quoted"), F.array(F.lit("empty_body")).alias("notes"))
    return let(source, lambda src: F.when(src == "", empty).otherwise(build(src)))

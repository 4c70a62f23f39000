"""Problem 7: dates of many kinds, each to one UTC instant.

An ordered cascade of anchored patterns, all in JVM expressions: the first pattern that fits a
value decides how it is read, and is strict (a value with a 30th of February is no instant).
A date without a zone is local time of its source's zone, from a lookup table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from missiva.functions.text import let

# Names of months and days, zone names of RFC 822 and their offsets in minutes.
MONTHS_EN = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTHS_HE = ["ינואר", "פברואר", "מרץ", "אפריל", "מאי", "יוני", "יולי", "אוגוסט", "ספטמבר", "אוקטובר", "נובמבר", "דצמבר"]
DAYS_HE = ["ראשון", "שני", "שלישי", "רביעי", "חמישי", "שישי", "שבת"]
ZONES = {"UT": 0, "UTC": 0, "GMT": 0, "Z": 0, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420}

_MON = r"(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?"
_DAY = r"(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*\.?"
_HMS = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_OFF = r"(Z|UTC|GMT|[+-]\d{2}(?::?\d{2})?)"

#: kind, pattern, and the groups of: year, month, day, hour, minute, second, fraction, am/pm, zone. 0: absent.
CASCADE = [
    ("iso", rf"^(\d{{4}})-(\d{{2}})-(\d{{2}})[T ]{_HMS}(?: ?{_OFF})?(?:\[[A-Za-z_/+-]+\])?$", (1, 2, 3, 4, 5, 6, 7, 0, 8)),
    ("compact", r"^(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})(\d{2})(?:[.,](\d{1,9}))?(Z|[+-]\d{2}:?\d{2})?$", (1, 2, 3, 4, 5, 6, 7, 0, 8)),
    ("rfc", rf"^(?:{_DAY}, *)?(\d{{1,2}})[ -]{_MON}[ -](\d{{4}}|\d{{2}}) {_HMS}(?: *([+-]\d{{4}}|UTC?|GMT|Z|[ECMP][SD]T))?(?: *\([^()]*\))?$", (3, 2, 1, 4, 5, 6, 7, 0, 8)),
    ("ctime", rf"^{_DAY} +{_MON} +(\d{{1,2}}) {_HMS} (\d{{4}})$", (7, 1, 2, 3, 4, 5, 6, 0, 0)),
    ("long", rf"^(?:{_DAY},? +)?{_MON} +(\d{{1,2}}),? +(\d{{4}}),?(?: at)? {_HMS}(?: ?([AaPp]\.?[Mm]\.?))?$", (3, 1, 2, 4, 5, 6, 7, 8, 0)),
    ("dots", rf"^(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}}|\d{{2}}),? {_HMS}$", (3, 2, 1, 4, 5, 6, 7, 0, 0)),
    ("slash", rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}|\d{{2}}),? {_HMS}(?: ?([AaPp]\.?[Mm]\.?))?$", (3, 2, 1, 4, 5, 6, 7, 8, 0)),
    ("hebrew", rf"^(?:יום )?(?:(?:{'|'.join(DAYS_HE)}),? )?(\d{{1,2}}) ?(?:ב|ל)?({'|'.join(MONTHS_HE)}),? (\d{{4}}),?(?: בשעה)? {_HMS}$", (3, 2, 1, 4, 5, 6, 7, 0, 0)),
]
CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
#: Instants count as real from 1970 to 2100; epoch numbers outside are no dates.
LEAST_US, MOST_US = 0, 4_102_444_800_000_000
#: A FILETIME counts 100 ns from 1601.
FILETIME_ZERO_S = 11_644_473_600


def tidy(c: Column) -> Column:
    """Without marks of direction, odd spaces and what a Received header has before the date."""
    t = F.regexp_replace(c, "[‎‏‪-‮⁦-⁩﻿]", "")
    t = F.trim(F.regexp_replace(t, r"(?U)\s+", " "))
    return F.when(F.instr(t, ";") > 0, F.trim(F.substring_index(t, ";", -1))).otherwise(t)


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _zone_us(z: Column) -> Column:
    """Microseconds that a written zone is ahead of UTC; null where it is not one."""
    named = F.create_map(*[F.lit(x) for k, v in ZONES.items() for x in (k, v)])
    digits = F.regexp_replace(z, "[^0-9]", "")
    hours, minutes = _int(F.substring(digits, 1, 2)), F.coalesce(_int(F.nullif(F.substring(digits, 3, 2), F.lit(""))), F.lit(0))
    least = F.when((hours <= 14) & (minutes < 60), hours * 60 + minutes)
    number = F.when(z.startswith("-"), -least).otherwise(least)
    return F.when(z.rlike("^[+-]"), number).otherwise(F.try_element_at(named, F.upper(z))).cast("bigint") * 60_000_000


def _month(c: Column) -> Column:
    en = F.array_position(F.array(*map(F.lit, MONTHS_EN)), F.lower(F.substring(c, 1, 3)))
    he = F.array_position(F.array(*map(F.lit, MONTHS_HE)), c)
    return F.coalesce(_int(c), F.nullif(en, F.lit(0)).cast("int"), F.nullif(he, F.lit(0)).cast("int"))


def _local_to_utc(local: Column, tz: Column, ambiguous: str, skipped: str) -> Column:
    """UTC microseconds of local microseconds. Policies: ambiguous earlier|later|null, skipped before|after|null."""
    utc = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local), tz))
    back = lambda u: F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(u), tz))
    out = utc
    if ambiguous != "earlier":
        second = F.coalesce(*[F.when(back(utc + m * 60_000_000) == local, utc + m * 60_000_000) for m in (30, 60, 120)])
        out = F.when(second.isNull(), utc).otherwise(second) if ambiguous == "later" else F.when(second.isNull(), utc)
    if skipped != "before":
        gone = back(utc) != local
        out = F.when(gone, utc + local - back(utc) if skipped == "after" else F.lit(None)).otherwise(out)
    return out


def parts(text: Column, month_first: Column) -> Column:
    """What the first fitting pattern of the cascade reads, as an array; null where none fits.

    Its nine places: year, month, day, hour, minute, second, fraction, am/pm, zone ("" if absent).
    """
    got = F.lit(None).cast("string")
    for name, pattern, groups in reversed(CASCADE):
        said = lambda order: F.regexp_replace(text, pattern, "|".join(f"${g}" if g else "" for g in order))  # noqa: E731, B023
        read = said(groups)
        if name == "slash":
            read = F.when(month_first, said((groups[0], groups[2], groups[1], *groups[3:]))).otherwise(read)
        got = F.when(text.rlike(pattern), read).otherwise(got)
    return F.split(got, r"\|", -1)


def _seconds(text: Column) -> Column:
    """Epoch seconds, milliseconds, microseconds, seconds with a fraction, or a FILETIME, in microseconds."""
    whole = text.try_cast("bigint")
    point = F.substring_index(text, ".", 1).try_cast("bigint") * 1_000_000 + F.rpad(F.substring(F.substring_index(text, ".", -1), 1, 6), 6, "0").try_cast("bigint")
    us = (
        F.when(text.rlike(r"^\d{9,10}$"), whole * 1_000_000)
        .when(text.rlike(r"^\d{12,13}$"), whole * 1_000)
        .when(text.rlike(r"^\d{15,16}$"), whole)
        .when(text.rlike(r"^\d{17,18}$"), F.floor(whole / F.lit(10)).cast("bigint") - F.lit(FILETIME_ZERO_S * 1_000_000))
        .when(text.rlike(r"^\d{9,10}\.\d{1,9}$"), point)
    )
    # floor(whole / 10) of an 18-digit number would pass through a double: integer division instead.
    us = F.when(text.rlike(r"^\d{17,18}$"), F.call_function("div", whole, F.lit(10).cast("bigint")) - F.lit(FILETIME_ZERO_S * 1_000_000)).otherwise(us)
    return F.when((us >= LEAST_US) & (us < MOST_US), us)


def _local_us(got: Column) -> Column:
    """Microseconds of the local time read; null where there is no such day or time of day."""
    year, hour = _int(got[0]), _int(got[3])
    year = F.when(F.length(got[0]) == 2, F.when(year < 70, year + 2000).otherwise(year + 1900)).otherwise(year)
    pm = F.lower(F.substring(got[7], 1, 1))
    hour = F.when(pm == "", hour).when((hour < 1) | (hour > 12), F.lit(None)).otherwise(hour % 12 + F.when(pm == "p", 12).otherwise(0))
    minute, second = _int(got[4]), F.coalesce(_int(F.nullif(got[5], F.lit(""))), F.lit(0))
    day = F.try_make_timestamp(year, _month(got[1]), _int(got[2]), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)"), F.lit("UTC"))
    frac = F.coalesce(F.rpad(F.substring(got[6], 1, 6), 6, "0").try_cast("bigint"), F.lit(0))
    return F.when(
        (hour < 24) & (minute < 60) & (second < 60),
        F.unix_micros(day) + (hour.cast("bigint") * 3600 + minute * 60 + second) * 1_000_000 + F.when(got[6] == "", 0).otherwise(frac),
    )


def instant_us(c: Column, zone: Column, month_first: Column, ambiguous: str = "earlier", skipped: str = "before") -> Column:
    """Microseconds since 1970 UTC that a written date names, or null.

    zone: IANA zone of values that name none (null: UTC). month_first: order of dates of numbers
    with slashes (null: day first). Null, blank and senseless values give null, as do days, hours
    and offsets that do not exist. Offset -0000 is UTC. Local times that occur twice take the
    earlier instant, those the clock skips take the offset in force before the change, unless the
    policies say otherwise (ambiguous: earlier, later, null; skipped: before, after, null).
    """
    tz = F.coalesce(zone, F.lit("UTC"))

    def placed(got: Column) -> Column:
        def at(local: Column) -> Column:
            stated = F.nullif(got[8], F.lit(""))
            return F.when(stated.isNull(), _local_to_utc(local, tz, ambiguous, skipped)).otherwise(local - _zone_us(stated))

        return let(_local_us(got), at)

    mdy = F.coalesce(month_first, F.lit(False))
    return let(tidy(c), lambda t: F.when(t.rlike(r"^[\d.]+$") & _seconds(t).isNotNull(), _seconds(t)).otherwise(let(parts(t, mdy), placed)))


def add_instants(df: DataFrame, fields: list[str], zone: Column, month_first: Column, ambiguous: str = "earlier", skipped: str = "before", suffix: str = "_us") -> DataFrame:
    """Add ``<field>_us`` for each field, as ``instant_us`` gives it; other columns stay as they are."""
    return df.withColumns({f"{f}{suffix}": instant_us(F.col(f"`{f}`"), zone, month_first, ambiguous, skipped) for f in fields})


def with_source_zone(df: DataFrame, mailboxes: DataFrame, source_col: str = "source_pst") -> DataFrame:
    """Add ``_tz`` and ``_mdy`` from the table of sources (one row a source, a fixed small table).

    Sources that are not there get null: their zoneless dates count as UTC, day first.
    """
    zones = mailboxes.groupBy(F.col("source_pst").alias("_src")).agg(F.min("tz").alias("_tz"), (F.upper(F.min("date_order")) == "MDY").alias("_mdy"))
    return df.join(zones, F.col(f"`{source_col}`") == F.col("_src"), "left").drop("_src")


def stated_otherwise(raw: DataFrame, emails: DataFrame, mailboxes: DataFrame) -> DataFrame:
    """Problem 7's rows: each value of the three date fields that is an instant not in canonical form."""
    out = None
    for table_name, df, key, fields in (("raw_messages", raw, "raw_id", ["sent_at", "received_at"]), ("emails_raw", emails, "row_id", ["date"])):
        long = df.select(F.col(key).cast("bigint").alias("row_key"), F.col("source_pst").alias("_source"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("value")) for f in fields])).alias("_v"))
        long = long.select("row_key", "_source", "_v.*").filter(F.col("value").isNotNull() & ~F.col("value").rlike(CANONICAL))
        got = add_instants(with_source_zone(long, mailboxes, "_source"), ["value"], F.col("_tz"), F.col("_mdy"))
        part = got.filter("value_us IS NOT NULL").select(F.lit(table_name).alias("table_name"), "row_key", "field", F.col("value_us").alias("utc_us"))
        out = part if out is None else out.unionByName(part)
    return out

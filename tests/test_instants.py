import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from missiva.operators.instants import instant_us, stated_otherwise

UTC = dt.timezone.utc


def us(*a, tz=UTC):
    return int((dt.datetime(*a, tzinfo=tz).astimezone(UTC) - dt.datetime(1970, 1, 1, tzinfo=UTC)).total_seconds() * 1_000_000)


JER, NY = ZoneInfo("Asia/Jerusalem"), ZoneInfo("America/New_York")
CASES = [
    ("2024-07-13T12:27:41+03:00", us(2024, 7, 13, 9, 27, 41)), ("2022-01-29 16:57:46.751518+02:00", us(2022, 1, 29, 14, 57, 46) + 751518), ("2025-03-15T08:28:15.464+0200", us(2025, 3, 15, 6, 28, 15) + 464000),
    ("Mon, 23 Oct 2023 14:39:19 -0000", us(2023, 10, 23, 14, 39, 19)), ("Thu, 04 Jul 2024 05:06:52 PDT", us(2024, 7, 4, 12, 6, 52)), ("Tue, 14 Sep 2021 15:49:13 +0300 (IDT)", us(2021, 9, 14, 12, 49, 13)),
    ("5 Oct 25 09:33 +0300", us(2025, 10, 5, 6, 33)), ("by mx5.relay.example with ESMTPS; Thu, 06 Feb 2025 15:53:53 +0200", us(2025, 2, 6, 13, 53, 53)), ("1631803393", 1631803393000000), ("1697951494698", 1697951494698000),
    ("1691759110.622", 1691759110622000), ("133592205450326930", (133592205450326930 // 10) - 11644473600000000), ("20220528T143456Z", us(2022, 5, 28, 14, 34, 56)), ("2024-06-19 13:57:00", us(2024, 6, 19, 13, 57, tz=JER)),
    ("Mon Feb  3 10:14:19 2025", us(2025, 2, 3, 10, 14, 19, tz=JER)), ("‎12.4.2022\xa004:21", us(2022, 4, 12, 4, 21, tz=JER)), ("17/9/2025 15:29:05", us(2025, 9, 17, 15, 29, 5, tz=JER)), ("3/5/2021 12:10:00 AM", us(2021, 5, 3, 0, 10, tz=JER)),
    ("Thursday, August 31, 2023 6:49 PM", us(2023, 8, 31, 18, 49, tz=JER)), ("יום ראשון 31 באוקטובר 2021 12:27", us(2021, 10, 31, 12, 27, tz=JER)), ("2023-10-07T17:04:38+03:00[Asia/Jerusalem]", us(2023, 10, 7, 14, 4, 38)),
    ("2024-02-30 10:00:00", None), ("31/04/2022 09:15", None), ("Thu, 31 Feb 2023 10:00:00 +0200", None), ("0000-00-00 00:00:00", None), ("24/09", None), ("n/a", None), ("", None), (None, None), ("2024-01-01 25:00:00", None), ("2024-01-01T10:00:00+99:00", None), ("13/13/2024 10:00", None), ("13:00 PM", None), ("x" * 5000, None),
]


def test_formats(spark):
    df = spark.createDataFrame([(k, v) for k, (v, _) in enumerate(CASES)], "k int, v string")
    got = {r.k: r.u for r in df.select("k", instant_us(F.col("v"), F.lit("Asia/Jerusalem"), F.lit(False)).alias("u")).collect()}
    assert got == {k: w for k, (_, w) in enumerate(CASES)}


@pytest.mark.parametrize("value,policy,want", [
    ("2024-10-27 01:30:00", {}, us(2024, 10, 26, 22, 30)), ("2024-10-27 01:30:00", {"ambiguous": "later"}, us(2024, 10, 26, 23, 30)), ("2024-10-27 01:30:00", {"ambiguous": "null"}, None),
    ("2024-03-29 02:30:00", {}, us(2024, 3, 29, 0, 30)), ("2024-03-29 02:30:00", {"skipped": "after"}, us(2024, 3, 28, 23, 30)), ("2024-03-29 02:30:00", {"skipped": "null"}, None),
])
def test_changes_of_the_clock(spark, value, policy, want):
    assert spark.range(1).select(instant_us(F.lit(value), F.lit("Asia/Jerusalem"), F.lit(False), **policy).alias("u")).first().u == want


def test_session_zone_makes_no_difference(spark):
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        test_formats(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_tables(spark):
    raw = spark.createDataFrame([(1, "a", "3/4/2024 10:00", None), (2, "b", "3/4/2024 10:00", "2024-01-01T00:00:00Z"), (3, None, "2024-01-01 00:00", "-")], "raw_id long, source_pst string, sent_at string, received_at string")
    mails = spark.createDataFrame([], "row_id long, source_pst string, date string")
    boxes = spark.createDataFrame([("a", "Asia/Jerusalem", "DMY"), ("b", "America/New_York", "MDY")], "source_pst string, tz string, date_order string")
    got = {(r.row_key, r.field): r.utc_us for r in stated_otherwise(raw, mails, boxes).collect()}
    assert got == {(1, "sent_at"): us(2024, 4, 3, 10, 0, tz=JER), (2, "sent_at"): us(2024, 3, 4, 10, 0, tz=NY), (3, "sent_at"): us(2024, 1, 1)}

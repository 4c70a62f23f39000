"""Queries of the general data problems (4, 5 and 7) and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from missiva.operators import delivery, hierarchy, instants
from missiva.session import table


def p4_found(spark, d):
    return delivery.surplus_rows(table(spark, d, "messages"))


def p4_marked(spark, d):
    return delivery.mark_deliveries(table(spark, d, "messages")).select("ingest_seq", "record_id", "is_duplicate", "duplicate_of")


def p5_found(spark, d):
    rows = hierarchy.hierarchy(table(spark, d, "raw_messages"))
    return rows.filter("named").select(F.col("v").alias("raw_id"), F.col("root").alias("root_id"), "depth")


def p5_hierarchy(spark, d):
    rows = hierarchy.with_paths(hierarchy.hierarchy(table(spark, d, "raw_messages")))
    return rows.select(F.col("v").alias("raw_id"), F.col("p").alias("parent_id"), F.col("root").alias("root_id"), "depth", "path", F.col("first").alias("entry_at"), F.col("last").alias("exit_at"), "descendants")


def p5_descendants(spark, d):
    rows = hierarchy.hierarchy(table(spark, d, "raw_messages"))
    return hierarchy.descendant_pairs(rows)


def p7_found(spark, d):
    return instants.stated_otherwise(*(table(spark, d, t) for t in ("raw_messages", "emails_raw", "mailboxes")))


def p7_instants(spark, d):
    raw = instants.with_source_zone(table(spark, d, "raw_messages"), table(spark, d, "mailboxes"))
    return instants.add_instants(raw, ["sent_at", "received_at"], F.col("_tz"), F.col("_mdy")).select("raw_id", "sent_at_us", "received_at_us")


def queries():
    return {f.__name__: f for f in (p4_found, p4_marked, p5_found, p5_hierarchy, p5_descendants, p7_found, p7_instants)}


_ID = r"nullif(regexp_replace(lower({c}), '^[\s<>]+|[\s<>]+$', '', 'g'), '')"

_FIRST = f"""
WITH k AS (SELECT ingest_seq, record_id, {_ID.format(c='message_id')} AS id FROM messages),
f AS (SELECT id, min(ingest_seq) AS a FROM k WHERE id IS NOT NULL GROUP BY id)
"""

_LINKS = f"""
WITH RECURSIVE k AS (
  SELECT raw_id, {_ID.format(c='message_id')} AS id, {_ID.format(c='parent_record_message_id')} AS pid,
         length(trim(coalesce(parent_record_message_id, ''))) > 0 AS named
  FROM raw_messages),
o AS (SELECT id, min(raw_id) AS p FROM k WHERE id IS NOT NULL GROUP BY id),
l AS (SELECT k.raw_id AS v, o.p, k.named FROM k LEFT JOIN o ON k.pid = o.id),
up AS (
  SELECT v, p AS anc, 1 AS n FROM l WHERE p IS NOT NULL
  UNION ALL
  SELECT up.v, l.p, n + 1 FROM up JOIN l ON up.anc = l.v WHERE l.p IS NOT NULL AND up.n < 400),
ring AS (SELECT DISTINCT v FROM up WHERE v = anc),
low AS (SELECT ring.v, min(up.anc) AS root FROM ring JOIN up ON up.v = ring.v GROUP BY ring.v)
"""


def oracle_sql():
    return {
        "p4_found": _FIRST + "SELECT a AS ingest_seq_a, ingest_seq AS ingest_seq_b FROM k JOIN f USING (id) WHERE ingest_seq > a",
        "p4_marked": _FIRST
        + """SELECT k.ingest_seq, k.record_id, coalesce(k.ingest_seq > f.a, false) AS is_duplicate,
             CASE WHEN k.ingest_seq > f.a THEN r.record_id END AS duplicate_of
             FROM k LEFT JOIN f ON k.id = f.id LEFT JOIN k r ON r.ingest_seq = f.a""",
        "p5_descendants": _LINKS
        + """, cut AS (SELECT v, CASE WHEN v NOT IN (SELECT v FROM ring) THEN p END AS p FROM l),
             anc AS (SELECT v, p AS a FROM cut WHERE p IS NOT NULL UNION ALL SELECT anc.v, cut.p FROM anc JOIN cut ON anc.a = cut.v WHERE cut.p IS NOT NULL)
             SELECT a AS ancestor, v AS descendant FROM anc""",
        "p5_found": _LINKS
        + """, looped AS (
               SELECT v, root FROM low
               UNION
               SELECT up.v, low.root FROM up JOIN low ON up.anc = low.v),
             tops AS (SELECT v, max(n) AS depth, arg_max(anc, n) AS root FROM up WHERE v NOT IN (SELECT v FROM looped) GROUP BY v)
             SELECT l.v AS raw_id, coalesce(looped.root, tops.root, l.v) AS root_id,
                    CAST(CASE WHEN looped.v IS NOT NULL THEN -1 ELSE coalesce(tops.depth, 0) END AS INTEGER) AS depth
             FROM l LEFT JOIN looped ON looped.v = l.v LEFT JOIN tops ON tops.v = l.v WHERE l.named""",
    }

"""Queries over frames at the edge: projections, headers, views, limits; with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from missiva.functions import text as T
from missiva.operators import archive as A
from missiva.operators import projections
from missiva.operators.ordering import numbered
from missiva.plans.mail_sql import MAIL, TOPICS, flag_columns, jpart, language, q, rx, stable, strip, subject, ws as white, clean_from
from missiva.session import table


def _mail(spark, d):
    return A.mail_frame(table(spark, d, "messages"))


def limit_messages(spark, d):
    return table(spark, d, "messages").orderBy("ingest_seq").limit(100).select("ingest_seq", "message_id")


def load_clustered(spark, d):
    return _mail(spark, d).filter(F.lower("is_filtered") != "true").select("ingest_seq", "cluster_name", A.format_date("date_sort").alias("date"))


def topic_export(spark, d):
    return _mail(spark, d).filter((F.lower("is_filtered") != "true") & (T.strip("cluster_name") != "")).select("cluster_name", "ingest_seq", T.truncate_body("body", 12_000, "\n[truncated]").alias("text"))


def search_views(spark, d):
    """The newest mails of every topic at once; the rank's bound is applied before the shuffle too."""
    order = Window.partitionBy("cluster_name").orderBy(F.desc_nulls_last("date_sort"), "message_id", "ingest_seq")
    return _mail(spark, d).select("cluster_name", "ingest_seq", F.row_number().over(order).alias("rank")).filter("rank <= 30")


def top_people(spark, d):
    return A.top_values(_mail(spark, d).filter("from_email <> ''"), ["cluster_name"], "from_email", 8, "people")


def pack_order(spark, d):
    rows = _mail(spark, d).select("cluster_name", "ingest_seq", "date_sort", "message_id")
    return numbered(rows, "cluster_name", [F.asc_nulls_last("date_sort"), "message_id", "ingest_seq"], "place").select("cluster_name", "ingest_seq", "place")


def received_date(spark, d):
    return table(spark, d, "raw_messages").select("raw_id", F.when(F.contains("received_at", F.lit(";")), T.strip(F.substring_index("received_at", ";", -1))).alias("value"))


def headers_map(spark, d):
    """Header entries to a map; values of a repeated name are joined by a line feed."""
    pairs = F.concat(F.array(F.struct(F.lit("Subject").alias("key"), F.coalesce("subject_raw", F.lit("")).alias("value"))), F.coalesce(F.map_entries("internet_headers"), F.array().cast("array<struct<key:string,value:string>>")), F.array(F.struct(F.lit("Subject").alias("key"), F.lit("again").alias("value"))))
    names = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    joined = F.transform(names, lambda n: F.struct(n.alias("key"), F.array_join(F.transform(F.filter(pairs, lambda p: p["key"] == n), lambda p: p["value"]), "\n").alias("value")))
    return table(spark, d, "messages").select("ingest_seq", F.map_from_entries(joined).alias("m")).select("ingest_seq", F.col("m")["Subject"].alias("subject"), F.col("m")["Importance"].alias("importance"), F.size("m").alias("n"))


def to_json_cells(spark, d):
    return table(spark, d, "messages").select("ingest_seq", F.to_json("to_emails").alias("value"))


def cluster_filename(spark, d):
    names = _mail(spark, d).select("cluster_name").distinct()
    slug = T.sanitize_filename(F.regexp_replace("cluster_name", "[/ ]", "_"), "cluster", 80)
    names = names.withColumn("slug", slug).withColumn("n", F.row_number().over(Window.partitionBy(F.lower("slug")).orderBy("cluster_name")))  # one row a cluster
    return names.select("cluster_name", F.concat("slug", F.when(F.col("n") > 1, F.concat(F.lit("_"), F.col("n").cast("string"))).otherwise(""), F.lit(".txt")).alias("file"))


def raw_projection(spark, d):
    return projections.raw_rows(table(spark, d, "raw_messages"))


def message_projection(spark, d):
    rows = projections.message_records(table(spark, d, "raw_messages"), ["kedembenefit.example"], TOPICS)
    lists = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "array<string>"]
    return rows.drop("internet_headers").withColumns({c: F.array_join(c, ";") for c in lists})


def normalize_folder(spark, d):
    """The forms of a folder, from paths with backslashes, dots and empty parts."""
    path = F.concat(F.lit("\\.\\"), F.replace("source_folder", F.lit("/"), F.lit("\\\\")), F.lit("/"))
    return table(spark, d, "messages").select("ingest_seq", T.folder_path(path).alias("value"), T.folder_filter(F.concat(F.lit("/"), F.col("source_folder"), F.lit("\\"))).alias("wanted"))


def cluster_writeback(spark, d):
    """Labels of the candidates joined back onto all rows, "" for the others."""
    mail = _mail(spark, d).select("ingest_seq", "cluster_name", "is_filtered")
    labels = mail.filter("is_filtered <> 'True'").select("ingest_seq", F.upper("cluster_name").alias("label"))
    return mail.select("ingest_seq").join(labels, "ingest_seq", "left").select("ingest_seq", F.coalesce("label", F.lit("")).alias("label"))


def csv_roundtrip(spark, d):
    """A frame written as quoted CSV into the shared folder and read again as strings."""
    import uuid

    from missiva.session import shared_dir
    from missiva.sources.tables import read_csv, write_csv

    where = f"{shared_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    write_csv(_mail(spark, d).select("ingest_seq", "subject", "body", "from_email"), where)
    return read_csv(spark, where).select(F.col("ingest_seq").cast("bigint").alias("ingest_seq"), "subject", F.length("body").cast("bigint").alias("chars"), "from_email")


def tag_messages(spark, d):
    """The tagging operator with a client that answers by itself."""
    from missiva.operators.tagging import tag

    def client():
        return lambda prompt: '{"topic": "mail", "tags": ["a", " "], "confidence": "0.5"}' if "payment" in prompt.lower() else "not json"

    return tag(_mail(spark, d), client).select("ingest_seq", "llm_topic", "llm_tags", "llm_confidence")


_QUERIES = [limit_messages, load_clustered, topic_export, search_views, top_people, pack_order, received_date, headers_map, to_json_cells, cluster_filename, raw_projection, message_projection, normalize_folder, cluster_writeback, csv_roundtrip, tag_messages]


def queries():
    return {f.__name__: f for f in _QUERIES}


def oracle_sql():
    date = "coalesce(strftime(date_sort AT TIME ZONE 'UTC', '%d/%m/%Y'), '')"
    email = lambda c: f"nullif(lower({rx(strip(c), '^[<>]+|[<>]+$')}), '')"
    many = lambda c: f"array_to_string(list_filter(list_transform({c}, lambda r: {email('r.email')}), lambda x: x IS NOT NULL), ';')"
    found = lambda c: f"coalesce(array_to_string(list_filter(list_transform({c}, lambda r: r.email), lambda x: x <> ''), ';'), '')"
    same = lambda *cs: ", ".join(f"coalesce({c}, '') AS {n}" for c, n in cs)
    many_of = lambda c: f"coalesce(array_to_string({c}, ';'), '')"
    ws = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
    name = rx(rx(rx(rx("cluster_name", "[/ ]", "'_'"), r'[<>:"/\\|?*\x{00}-\x{1f}]', "'_'"), "_+", "'_'"), r"\A[ .]+|[ .]+\z")
    body = rx("coalesce(body_text_raw, '')", r"[\x{00}-\x{08}\x{0b}-\x{1f}]")
    reply = lambda kinds: f"regexp_matches({strip('lower(subject_raw)')}, {q(rf'^(?:{kinds})[{ws}]*[:：]')})"
    made = stable(*(jpart(c) for c in ("source_pst", "source_folder", "subject_raw", "sent_at", "b")))
    RAW = f"""WITH s AS (SELECT *, {white(body)} AS b FROM raw_messages)
      SELECT raw_id, coalesce(nullif(message_id, ''), substr({made}, 1, 24)) AS message_id, coalesce(nullif(conversation_id, ''), nullif(in_reply_to, ''), '') AS thread_id, nested_depth,
        {same(('parent_record_message_id', 'parent_record_message_id'), ('container_attachment_filename', 'container_attachment_filename'), ('subject_raw', 'subject'), ('sender_email', 'from_email'))}, b AS body,
        {found('to_recipients')} AS to_emails, {found('cc_recipients')} AS cc_emails, {found('bcc_recipients')} AS bcc_emails, coalesce(nullif(sent_at, ''), nullif(received_at, ''), '') AS date, source_folder AS folder_path,
        coalesce(len(attachment_payloads), 0) > 0 AS has_attachments, CAST(coalesce(len(attachment_payloads), 0) AS INT) AS attachment_count,
        coalesce(CAST(to_json(list_transform(attachment_payloads, lambda a: {{'filename': a.filename, 'content_type': a.content_type, 'size': octet_length(a.payload)}})) AS VARCHAR), '[]') AS attachment_metadata, {many_of('flags')} AS flags,
        CASE WHEN b = '' THEN 0 ELSE len(regexp_split_to_array(b, {q(f'[{ws}]+')})) END AS word_count, source_pst, 'eml' AS extractor, {many_of('extraction_errors')} AS extraction_errors FROM s"""
    kept = [c for c in projections.KEPT if c not in ("internet_headers", "reference_ids", "flags", "categories", "extraction_errors")]
    rec = stable(*(jpart(c) for c in ("source_pst", "source_folder", "message_id", "sent_at", "sender_email", "subject_normalized", "content_hash")))
    RECORDS = clean_from("raw_messages", "raw_id") + f""", j AS (SELECT raw_messages.*, {subject('subject_raw')} AS subject_normalized, cleaned.text AS body_text_clean, cleaned.mostly_quoted, cleaned.notes AS processing_notes FROM raw_messages JOIN cleaned USING (raw_id)),
      h AS (SELECT *, sha256(lower(subject_normalized || chr(10) || {strip("coalesce(nullif(body_text_clean, ''), body_text_raw, '')")})) AS content_hash, lower(subject_normalized || chr(10) || body_text_clean) AS low, coalesce(nullif(body_text_clean, ''), body_text_raw, '') AS shown, coalesce(sender_email, '') AS from_email FROM j),
      f AS (SELECT *, {flag_columns('low')} FROM h)
      SELECT raw_id, substr({rec}, 1, 24) AS record_id, {", ".join(kept)}, array_to_string(reference_ids, ';') AS reference_ids, array_to_string(flags, ';') AS flags, array_to_string(categories, ';') AS categories, array_to_string(extraction_errors, ';') AS extraction_errors,
        subject_normalized, {email('sender_email')} AS sender_email, coalesce({many('to_recipients')}, '') AS to_emails, coalesce({many('cc_recipients')}, '') AS cc_emails, coalesce({many('bcc_recipients')}, '') AS bcc_emails, body_text_clean, {language('shown')} AS language,
        coalesce(len(attachment_payloads), 0) > 0 AS has_attachments, CAST(coalesce(len(attachment_payloads), 0) AS INT) AS attachment_count, CASE WHEN {reply('fw|fwd|הועבר|העברה')} THEN 'forward' WHEN {reply('re|תגובה|השב')} THEN 'reply' END AS reply_forward_indicator,
        coalesce(nullif(in_reply_to, ''), reference_ids[-1]) AS parent_message_id, mostly_quoted, content_hash, intent AS possible_intent, topic AS possible_topic, complaint AS complaint_indicator, request AS request_indicator, urgent AS urgency_indicator, question AS has_question, sender_type AS likely_sender_type, processing_notes FROM
        (SELECT *, CASE WHEN complaint THEN 'complaint' WHEN urgent AND request THEN 'urgent_request' WHEN request THEN 'request' WHEN question THEN 'question' ELSE 'unknown' END AS intent FROM f)"""
    return {
        "limit_messages": "SELECT ingest_seq, message_id FROM messages ORDER BY ingest_seq LIMIT 100",
        "load_clustered": MAIL + f"SELECT ingest_seq, cluster_name, {date} AS date FROM mail WHERE lower(is_filtered) <> 'true'",
        "topic_export": MAIL + f"SELECT cluster_name, ingest_seq, CASE WHEN length(body) > 12000 THEN {rx('substr(body, 1, 12000)', f'[{ws}]+$')} || chr(10) || '[truncated]' ELSE body END AS text FROM mail WHERE lower(is_filtered) <> 'true' AND {strip('cluster_name')} <> ''",
        "search_views": MAIL + ", r AS (SELECT cluster_name, ingest_seq, CAST(row_number() OVER (PARTITION BY cluster_name ORDER BY date_sort DESC NULLS LAST, message_id, ingest_seq) AS INT) AS rank FROM mail) SELECT * FROM r WHERE rank <= 30",
        "top_people": MAIL + ", c AS (SELECT cluster_name, from_email, count(*) AS n FROM mail WHERE from_email <> '' GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY cluster_name ORDER BY n DESC, from_email) AS rn FROM c) SELECT cluster_name, string_agg(from_email, '; ' ORDER BY rn) AS people FROM r WHERE rn <= 8 GROUP BY 1",
        "pack_order": MAIL + "SELECT cluster_name, ingest_seq, CAST(row_number() OVER (PARTITION BY cluster_name ORDER BY date_sort NULLS LAST, message_id, ingest_seq) AS INT) AS place FROM mail",
        "received_date": f"SELECT raw_id, CASE WHEN contains(received_at, ';') THEN {strip('string_split(received_at, ' + q(';') + ')[-1]')} END AS value FROM raw_messages",
        "headers_map": "SELECT ingest_seq, coalesce(subject_raw, '') || chr(10) || 'again' AS subject, element_at(internet_headers, 'Importance')[1] AS importance, CAST(1 + coalesce(cardinality(internet_headers), 0) AS INT) AS n FROM messages",
        "to_json_cells": "SELECT ingest_seq, CAST(to_json(to_emails) AS VARCHAR) AS value FROM messages",
        "cluster_filename": MAIL + f", s AS (SELECT DISTINCT cluster_name, coalesce(nullif({name}, ''), 'cluster') AS slug FROM mail), n AS (SELECT *, row_number() OVER (PARTITION BY lower(slug) ORDER BY cluster_name) AS n FROM s) SELECT cluster_name, slug || CASE WHEN n > 1 THEN '_' || n ELSE '' END || '.txt' AS file FROM n",
        "raw_projection": RAW,
        "message_projection": RECORDS,
        "normalize_folder": "SELECT ingest_seq, array_to_string(list_filter(string_split(source_folder, '/'), lambda p: p NOT IN ('', '.')), '/') AS value, lower(trim(source_folder, '/')) AS wanted FROM messages",
        "cluster_writeback": MAIL + "SELECT ingest_seq, CASE WHEN is_filtered <> 'True' THEN upper(cluster_name) ELSE '' END AS label FROM mail",
        "csv_roundtrip": MAIL + "SELECT ingest_seq, subject, length(body) AS chars, from_email FROM mail",
        "tag_messages": MAIL + "SELECT ingest_seq, CASE WHEN contains(lower(subject || chr(10) || substr(coalesce(nullif(clean_body, ''), body), 1, 6000)), 'payment') THEN 'mail' ELSE 'unknown' END AS llm_topic, CASE WHEN contains(lower(subject || chr(10) || substr(coalesce(nullif(clean_body, ''), body), 1, 6000)), 'payment') THEN 'a' ELSE '' END AS llm_tags, CASE WHEN contains(lower(subject || chr(10) || substr(coalesce(nullif(clean_body, ''), body), 1, 6000)), 'payment') THEN 0.5 END AS llm_confidence FROM mail",
    }

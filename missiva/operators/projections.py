"""Raw messages as rows of the raw CSV frame and as records of the archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from missiva.functions import text as T
from missiva.operators import archive as A
from missiva.operators.cleaning import clean


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def _some(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(""))


def _list(c: Column) -> Column:
    return F.coalesce(F.array_join(c, ";"), F.lit(""))


def raw_rows(raw: DataFrame, extractor: str = "eml") -> DataFrame:
    """``raw_id`` and the 21 columns of the raw CSV frame. Null texts and lists give ""; dates stay as found."""
    body = T.normalize_whitespace(T.strip_control(F.coalesce(_some("body_text_raw"), T.html_to_text("body_html_raw"), F.lit(""))))
    rows = raw.withColumn("_body", body)
    made = F.substring(T.stable_hash(*[T.json_part(F.col(c)) for c in ("source_pst", "source_folder", "subject_raw", "sent_at", "_body")]), 1, 24)
    mails = lambda c: _list(F.filter(F.transform(c, lambda r: r["email"]), lambda x: x != ""))
    files = F.coalesce("attachment_payloads", F.array())
    told = F.transform(files, lambda a: F.struct(a["filename"].alias("filename"), a["content_type"].alias("content_type"), F.octet_length(a["payload"]).alias("size")))
    return rows.select(
        "raw_id", F.coalesce(_some("message_id"), made).alias("message_id"), F.coalesce(_some("conversation_id"), _some("in_reply_to"), F.lit("")).alias("thread_id"), _text("parent_record_message_id").alias("parent_record_message_id"), "nested_depth",
        _text("container_attachment_filename").alias("container_attachment_filename"), _text("subject_raw").alias("subject"), F.col("_body").alias("body"), _text("sender_email").alias("from_email"), mails("to_recipients").alias("to_emails"), mails("cc_recipients").alias("cc_emails"),
        mails("bcc_recipients").alias("bcc_emails"), F.coalesce(_some("sent_at"), _some("received_at"), F.lit("")).alias("date"), F.col("source_folder").alias("folder_path"), (F.size(files) > 0).alias("has_attachments"), F.size(files).alias("attachment_count"),
        F.to_json(told, {"ignoreNullFields": "false"}).alias("attachment_metadata"), _list(F.col("flags")).alias("flags"), T.word_count("_body").cast("bigint").alias("word_count"), "source_pst", F.lit(extractor).alias("extractor"), _list(F.col("extraction_errors")).alias("extraction_errors"),
    )


#: Columns a record takes over as they are.
KEPT = ["source_pst", "source_folder", "message_id", "conversation_id", "in_reply_to", "reference_ids", "subject_raw", "sender_name", "sent_at", "received_at", "body_text_raw", "body_html_raw", "importance", "flags", "categories", "internet_headers", "parent_record_message_id", "nested_depth", "container_attachment_filename", "extraction_errors"]


def message_records(raw: DataFrame, internal: list[str] = (), topics: dict[str, list[str]] | None = None) -> DataFrame:
    """``raw_id`` and the fields of a record that follow from one raw message: keys, cleaned text, flags, counts.

    Dates stay as found; what needs other messages (duplicates, threads) and the ids of saved attachments is added elsewhere.
    """
    rows = raw.withColumns({"subject_normalized": T.normalize_subject("subject_raw"), "_clean": clean(F.coalesce(_some("body_text_raw"), T.html_to_text("body_html_raw")))})
    clean_text = F.col("_clean.text")
    rows = rows.withColumn("content_hash", A.content_hash(F.col("subject_normalized"), F.coalesce(F.nullif(clean_text, F.lit("")), _text("body_text_raw"))))
    parts = [T.json_part(F.col(c)) for c in ("source_pst", "source_folder", "message_id", "sent_at", "sender_email", "subject_normalized", "content_hash")]
    mails = lambda c: F.coalesce(F.filter(F.transform(c, lambda r: T.normalize_email(r["email"])), lambda x: x.isNotNull()), F.array().cast("array<string>"))
    files = F.coalesce("attachment_payloads", F.array())
    rows = rows.withColumn("_flags", A.flags(F.col("subject_normalized"), clean_text, _text("sender_email"), internal, topics))
    return rows.select(
        "raw_id", F.substring(T.stable_hash(*parts), 1, 24).alias("record_id"), *KEPT, "subject_normalized", T.normalize_email("sender_email").alias("sender_email"),
        mails("to_recipients").alias("to_emails"), mails("cc_recipients").alias("cc_emails"), mails("bcc_recipients").alias("bcc_emails"), clean_text.alias("body_text_clean"),
        A.detect_language(F.coalesce(F.nullif(clean_text, F.lit("")), _text("body_text_raw"))).alias("language"), (F.size(files) > 0).alias("has_attachments"), F.size(files).alias("attachment_count"), T.reply_forward("subject_raw").alias("reply_forward_indicator"),
        F.coalesce(_some("in_reply_to"), F.try_element_at("reference_ids", F.lit(-1))).alias("parent_message_id"), F.col("_clean.mostly_quoted").alias("mostly_quoted"), "content_hash", F.col("_flags.intent").alias("possible_intent"), F.col("_flags.topic").alias("possible_topic"),
        F.col("_flags.complaint").alias("complaint_indicator"), F.col("_flags.request").alias("request_indicator"), F.col("_flags.urgent").alias("urgency_indicator"), F.col("_flags.question").alias("has_question"), F.col("_flags.sender_type").alias("likely_sender_type"), F.col("_clean.notes").alias("processing_notes"),
    )

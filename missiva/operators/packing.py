"""Topic packs: mails rendered, put in order and cut into parts bounded by number and size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from missiva.functions import text as T
from missiva.operators.archive import format_date, top_values
from missiva.operators.ordering import greedy_parts

# Bounds of a part, and the rendered form.
MAX_CHARS, MAX_EMAILS, MAX_BODY = 160_000, 80, 8_500
BODY_CUT, RULE = "\n[body truncated]", "-" * 60


def render_email(label: Column, max_body: int = MAX_BODY) -> Column:
    """A mail as a block of lines."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    body = T.truncate_body(F.coalesce("body_for_pack", F.lit("")), max_body, BODY_CUT)
    fields = [("Message ID", text("message_id")), ("Date", format_date("date_sort")), ("From", text("from_email")), ("To", text("to_emails")), ("CC", text("cc_emails")), ("BCC", text("bcc_emails")), ("Subject", text("subject")), ("Folder", text("folder_path")), ("Topic", text("knowledge_topic")), ("Subtopic", text("knowledge_subtopic")), ("Matched terms", text("knowledge_matched_terms"))]
    return F.concat_ws("\n", label, *[line(n, v) for n, v in fields], F.lit(""), F.lit("Body:"), F.when(body == "", "[empty body]").otherwise(body), F.lit(""), F.lit(RULE), F.lit(""))


def included() -> Column:
    """Not filtered, no system noise, with a topic."""
    return (F.lower(F.coalesce("is_filtered", F.lit("false"))) != "true") & ~F.coalesce("is_system_noise", F.lit(False)) & (T.strip(F.coalesce("knowledge_topic", F.lit(""))) != "")


def sized(mail: DataFrame, columns: list[str], max_body: int = MAX_BODY) -> DataFrame:
    """``columns`` and ``chars`` of the mails that are packed: what packing needs of them, without their texts."""
    return mail.filter(included()).select(*columns, F.length(render_email(F.lit("EMAIL"), max_body)).alias("chars"))


def place(rows: DataFrame, max_chars: int = MAX_CHARS, max_emails: int = MAX_EMAILS) -> DataFrame:
    """``(knowledge_topic, ingest_seq, part, place, chars)`` of sized mails."""
    rows = rows.select("knowledge_topic", "date_sort", "message_id", "ingest_seq", "chars")
    return greedy_parts(rows, "knowledge_topic", [F.asc_nulls_last("date_sort"), "message_id", "ingest_seq"], "chars", max_chars, max_emails).select("knowledge_topic", "ingest_seq", "part", "place", "chars")


def pack(mail: DataFrame, max_chars: int = MAX_CHARS, max_emails: int = MAX_EMAILS, max_body: int = MAX_BODY) -> DataFrame:
    """``(knowledge_topic, ingest_seq, part, place, chars)`` of the mails that are packed."""
    return place(sized(mail, ["knowledge_topic", "date_sort", "message_id", "ingest_seq"], max_body), max_chars, max_emails)


def manifest(mail: DataFrame, packed: DataFrame) -> DataFrame:
    """A row for each packed mail with its file and locator (19 columns and ``ingest_seq``); slugs of topics are told apart by a number."""
    slugs = packed.select("knowledge_topic").distinct().withColumn("slug", T.sanitize_filename(F.replace("knowledge_topic", F.lit(" "), F.lit("_")), "topic", 90))
    slugs = slugs.withColumn("n", F.row_number().over(Window.partitionBy(F.lower("slug")).orderBy("knowledge_topic"))).select("knowledge_topic", F.when(F.col("n") > 1, F.concat("slug", F.lit("_"), "n")).otherwise(F.col("slug")).alias("slug"))
    file = F.format_string("sources/%s__part_%03d.docx", "slug", "part")
    return packed.join(slugs, "knowledge_topic").join(mail.drop("knowledge_topic", "chars"), "ingest_seq").select(
        file.alias("source_file"), F.concat(file, F.format_string(" / EMAIL %04d", "place")).alias("source_locator"), "knowledge_topic", "knowledge_subtopic", "knowledge_score", "knowledge_mode", "knowledge_review_required", "message_id",
        format_date("date_sort").alias("date"), "from_email", "subject", "folder_path", "parent_record_message_id", "nested_depth", "container_attachment_filename", "cluster_name", "llm_topic", "llm_confidence", "knowledge_matched_terms", "ingest_seq",
    )


def pack_topics(mail: DataFrame, packed: DataFrame) -> DataFrame:
    rows = packed.select("ingest_seq", "part").join(mail, "ingest_seq")
    base = rows.groupBy("knowledge_topic").agg(F.count("*").alias("email_count"), F.max("part").alias("source_file_count"), format_date(F.min("date_sort")).alias("first_date"), format_date(F.max("date_sort")).alias("last_date"))
    people = top_values(rows.filter("from_email <> ''"), ["knowledge_topic"], "from_email", 8, "top_people")
    subs = top_values(rows, ["knowledge_topic"], "knowledge_subtopic", 5, "top_subtopics", F.concat("knowledge_subtopic", F.lit(" ("), F.col("n").cast("string"), F.lit(")")))
    return base.join(people, "knowledge_topic", "left").join(subs, "knowledge_topic", "left")


def part_headers(mail: DataFrame, packed: DataFrame) -> DataFrame:
    rows = packed.select("ingest_seq", "part").join(mail, "ingest_seq")
    base = rows.groupBy("knowledge_topic", "part").agg(F.count("*").alias("email_count"), format_date(F.min("date_sort")).alias("first_date"), format_date(F.max("date_sort")).alias("last_date"))
    total = packed.groupBy("knowledge_topic").agg(F.max("part").alias("total_parts"))
    return base.join(top_values(rows.filter("from_email <> ''"), ["knowledge_topic", "part"], "from_email", 8, "top_people"), ["knowledge_topic", "part"], "left").join(total, "knowledge_topic")


def review_queue(mail: DataFrame, least_score: float = 4.0, least_body: int = 180) -> DataFrame:
    """Mails to be looked at, with the reasons."""
    reasons = F.array_join(F.array_compact(F.array(
        F.when(F.col("knowledge_review_required"), "manual_review"), F.when(F.col("knowledge_score") < least_score, "low_score"),
        F.when(T.strip("subject") == "", "missing_subject"), F.when(F.length("body_for_pack") < least_body, "short_body"),
    )), "; ")
    return mail.withColumn("review_reason", reasons).filter("review_reason <> ''").select("ingest_seq", "review_reason", "knowledge_topic", "knowledge_score", "message_id", "from_email", "subject")

"""Frames of a mail archive: duplicates, threads, recipients, filters, flags, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from missiva.functions import text as T
from missiva.operators.ordering import numbered

# Words of the flags, noise and system patterns, domain terms, buckets of names.
COMPLAINT = ["complaint", "unhappy", "not acceptable", "dissatisfied", "disappointing", "בעיה", "תלונה", "לא תקין", "לא מרוצה", "מאוכזב", "מאוכזבת", "גרוע"]
REQUEST = ["please", "request", "can you", "could you", "kindly", "אשמח", "מבקש", "מבקשת", "נא", "אפשר", "לתשומת לבך", "טיפולך"]
URGENT = ["urgent", "asap", "immediately", "priority", "critical", "דחוף", "בהקדם", "מיידי", "מיידית", "בהקדם האפשרי", "קריטי"]
QUESTION = ["האם", "מדוע", "למה", "איך", "מתי"]
SENDER_TYPES = {"retiree": ["retiree", "retired", "גמלאי", "פנסיונר"], "family_member": ["daughter", "son", "spouse", "בת של", "בן של", "אשתו", "בעלה"], "former_employee": ["former employee", "ex employee", "עובד לשעבר", "עובדת לשעבר"]}
AUTO_REPLY = "automatic reply|out of office|auto reply|תשובה אוטומטית|מחוץ למשרד|היעדרות|אישור מסירה|delivery status notification"
NOISE_SENDER = "no-?reply|do-?not-?reply|newsletter|digest|mailing-list|roundrobin|system|bot|notifications?"
DOMAIN_TERMS = ["גמלה", "גמלאות", "פנסיה", "שאירים", "קצבה", "קרן", "זכאות", "תביעה", "ערעור", "חוזה", "רציפות", "מבוטח", "תגמולים", "שיפוי"]
MOJIBAKE = ["׳³", "ן¿½", "ג€", "×", "Ã"]
SYSTEM_WORDS = [
    "mailer-daemon", "postmaster", "noreply", "no-reply", "do-not-reply", "system", "bot", "notification", "notifications", "mrsysmail",
    "delivery status", "undeliverable", "failure notice", "automatic reply", "out of office", "sync issues", "returned to sender", "mail delivery failed", "mail could not be delivered", "message could not be delivered",
    "undelivered mail", "non-delivery", "delivery failure", "delivery to the following recipient failed", "returned mail", "יומן סינכרון", "מחוץ למשרד", "תשובה אוטומטית", "אישור מסירה", "הודעה לא נמסרה", "לא ניתן למסור", "חזר לשולח",
]
SEARCH_COLUMNS = ["message_id", "date", "knowledge_topic", "knowledge_subtopic", "cluster_name", "llm_topic", "llm_subtopic", "from_email", "to_emails", "subject", "folder_path", "clean_body"]


def with_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """The frame with every named column, "" where it has none."""
    return df.withColumns({c: F.lit("") for c in names if c not in df.columns})


def mail_frame(messages: DataFrame) -> DataFrame:
    """The notebook frame of a messages table: strings without nulls, ``date_sort`` a timestamp."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    many = lambda c: F.coalesce(F.array_join(c, ";"), F.lit(""))
    return messages.select(
        "ingest_seq", text("message_id").alias("message_id"), F.col("sent_at").alias("date_sort"), text("subject_raw").alias("subject"), text("subject_normalized").alias("subject_normalized"),
        text("body_text_raw").alias("body"), text("body_text_clean").alias("clean_body"), text("sender_email").alias("from_email"), many("to_emails").alias("to_emails"), many("cc_emails").alias("cc_emails"), many("bcc_emails").alias("bcc_emails"),
        text("source_folder").alias("folder_path"), text("source_folder").alias("cluster_name"), text("llm_topic").alias("llm_topic"), text("llm_subtopic").alias("llm_subtopic"), F.lit("").alias("knowledge_topic"), F.lit("").alias("knowledge_subtopic"),
        F.when(F.col("is_duplicate"), "True").otherwise("False").alias("is_filtered"),
        text("parent_record_message_id").alias("parent_record_message_id"), "nested_depth", text("container_attachment_filename").alias("container_attachment_filename"),
    )


# ---- keys, duplicates, threads


def iso_text(c: Column) -> Column:
    """An instant as Python's isoformat has it in UTC."""
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.unix_micros(c) % 1_000_000 != 0, F.date_format(c, ".SSSSSS")).otherwise(F.lit("")), F.lit("+00:00"))


def participants(*arrays: str) -> Column:
    return F.array_sort(F.filter(F.concat(F.array("sender_email"), *[F.coalesce(F.col(a), F.array().cast("array<string>")) for a in arrays]), lambda x: x.isNotNull() & (x != "")))


def with_archive_keys(messages: DataFrame) -> DataFrame:
    """Add dedup_key, native and synthetic thread keys and the sort date."""
    at = F.coalesce("sent_at", "received_at")
    who = T.json_list(participants("to_emails", "cc_emails"))
    subject = T.json_part(F.coalesce("subject_normalized", F.lit("")))
    meta = T.stable_hash(subject, who, T.json_part(F.date_format("sent_at", "yyyy-MM-dd")), T.json_part(F.col("content_hash")))
    key = lambda name, c: F.concat(F.lit(f"{name}:"), F.substring(T.stable_hash(T.json_part(c)), 1, 24))
    first = F.try_element_at("reference_ids", F.lit(1))
    some = lambda c: c.isNotNull() & (c != "")
    return messages.withColumns(
        {
            "dedup_key": F.when(some(F.col("message_id")), F.concat(F.lit("message-id:"), F.lower("message_id"))).otherwise(F.concat(F.lit("metadata:"), meta)),
            "native_key": F.when(some(F.col("conversation_id")), key("native", F.col("conversation_id"))).when(some(first), key("refs", first)).when(some(F.col("in_reply_to")), key("reply", F.col("in_reply_to"))),
            "synthetic_key": F.concat(F.lit("synthetic:"), F.substring(T.stable_hash(subject, who, T.json_part(T.iso_week(at))), 1, 24)),
            "order_date": F.coalesce(iso_text(at), F.lit("")),
        }
    )


def dedup_mark(messages: DataFrame) -> DataFrame:
    """Mark, never drop: of each key the first row by date and record id stays; the rest point to it.

    The first row comes from an aggregation (partial on the map side) and is joined back, so that a
    key of a third of all rows is no single task, as a window would make it.
    """
    rows = with_archive_keys(messages).select("ingest_seq", "record_id", "dedup_key", "order_date")
    first = rows.groupBy("dedup_key").agg(F.min(F.struct("order_date", "record_id", "ingest_seq")).alias("f"))
    joined = rows.join(first, "dedup_key")
    later = F.col("f.ingest_seq") != F.col("ingest_seq")
    return joined.select("ingest_seq", "record_id", later.alias("is_duplicate"), F.when(later, F.col("f.record_id")).alias("duplicate_of"))


def group_duplicates(messages: DataFrame) -> DataFrame:
    """``(ingest_seq, canonical, members)``: each row with the record id of its group and the group's size; a group is never gathered."""
    marked = dedup_mark(messages).select("ingest_seq", F.coalesce("duplicate_of", "record_id").alias("canonical"))
    sizes = marked.groupBy("canonical").agg(F.count("*").alias("members"))
    return marked.join(sizes.withColumnRenamed("canonical", "_c"), F.col("canonical").eqNullSafe(F.col("_c"))).select("ingest_seq", "canonical", "members")


def thread_keys(messages: DataFrame) -> DataFrame:
    return with_archive_keys(messages).select("ingest_seq", F.coalesce("native_key", "synthetic_key").alias("built_thread_key"), "synthetic_key")


def thread_position(messages: DataFrame) -> DataFrame:
    """Place of each message in its thread by date and record id; undated ones come first."""
    rows = with_archive_keys(messages).select("ingest_seq", "thread_key", "order_date", "record_id")
    return numbered(rows, "thread_key", ["order_date", "record_id", "ingest_seq"], "position").select("ingest_seq", "thread_key", "position")


def thread_summary(messages: DataFrame) -> DataFrame:
    rows = with_archive_keys(messages)
    at = F.coalesce("sent_at", "received_at")
    own = F.filter(F.concat(F.array("sender_email"), *[F.coalesce(F.col(a), F.array().cast("array<string>")) for a in ("to_emails", "cc_emails", "bcc_emails")]), lambda x: x.isNotNull() & (x != ""))
    return rows.groupBy("thread_key").agg(
        F.count("*").alias("message_count"), F.min(at).alias("first_message_at"), F.max(at).alias("last_message_at"),
        F.min_by(F.coalesce("subject_normalized", F.lit("")), F.struct("order_date", "record_id", "ingest_seq")).alias("subject_normalized"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(own)))), ";").alias("participants"),
        F.sum(F.coalesce(F.col("is_duplicate"), F.lit(False)).cast("bigint")).alias("duplicate_count"), F.bool_or("has_attachments").alias("has_attachments"),
        F.array_join(F.array_sort(F.collect_set("source_pst")), ";").alias("source_psts"),
    )


def recipients_bridge(messages: DataFrame) -> DataFrame:
    """One row for each recipient of each kind."""
    kinds = F.array(*[F.struct(F.lit(k).alias("recipient_type"), F.col(f"{k}_emails").alias("emails")) for k in ("to", "cc", "bcc")])
    return messages.select("ingest_seq", "record_id", F.explode(kinds).alias("k")).select("ingest_seq", "record_id", "k.recipient_type", F.explode("k.emails").alias("email"))


def message_attachments(messages: DataFrame, attachments: DataFrame) -> DataFrame:
    sums = attachments.groupBy("record_id").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.max("is_inline").alias("any_inline"))
    return messages.select("ingest_seq", "record_id").join(sums, "record_id", "left").select("ingest_seq", "record_id", F.coalesce("files", F.lit(0)).cast("bigint").alias("files"), "bytes", "any_inline")


def content_hash(subject: Column, body: Column) -> Column:
    return F.sha2(F.lower(F.concat(subject, F.lit("\n"), T.strip(body))), 256)


# ---- flags and filters


def flags(subject: Column, body: Column, sender: Column, internal: list[str] = (), topics: dict[str, list[str]] | None = None) -> Column:
    """The heuristic flags as a struct; keyword lists are tried in their order."""
    text = F.lower(F.concat(F.coalesce(subject, F.lit("")), F.lit("\n"), F.coalesce(body, F.lit(""))))
    complaint, request, urgent = (T.has_keyword(text, w) for w in (COMPLAINT, REQUEST, URGENT))
    question = text.contains("?") | text.contains("؟") | T.has_keyword(text, QUESTION)
    intent = F.when(complaint, "complaint").when(urgent & request, "urgent_request").when(request, "request").when(question, "question").otherwise("unknown")
    domain = F.when(F.instr(sender, "@") > 0, F.lower(F.substring(sender, F.instr(sender, "@") + 1, F.length(sender)))).otherwise("")
    kind, topic = F.lit("unknown"), F.lit("unknown")
    for name, words in reversed(list(SENDER_TYPES.items())):
        kind = F.when(T.has_keyword(text, words), name).otherwise(kind)
    if internal:
        kind = F.when(domain.isin([d.lower().lstrip("@") for d in internal]), "internal_staff").otherwise(kind)
    for name, words in reversed(list((topics or {}).items())):
        topic = F.when(T.has_keyword(text, words), name).otherwise(topic)
    return F.struct(complaint.alias("complaint"), request.alias("request"), urgent.alias("urgent"), question.alias("question"), intent.alias("intent"), kind.alias("sender_type"), topic.alias("topic"))


def encoding_corrupt(c: Column) -> Column:
    """Whether the first 4000 characters look wrongly decoded."""
    t = F.substring(c, 1, 4000)
    marks = sum((T.occurrences(t, m) for m in MOJIBAKE), F.lit(0.0))
    visible = F.greatest(F.length(F.regexp_replace(t, rf"[{T.WS}\p{{C}}\p{{Z}}]", "")), F.lit(1))
    return F.coalesce(t.contains("�") | (marks >= 10) | (marks / visible > 0.03), F.lit(False))


def has_domain_term(c: Column) -> Column:
    return T.let(c, lambda text: F.exists(F.array(*map(F.lit, DOMAIN_TERMS)), lambda t: F.contains(text, t)))


def filter_reason(subject: Column, body: Column, sender: Column, min_words: int = 5) -> Column:
    """The first reason that speaks against a message, or ""."""
    return (
        F.when(T.strip(body) == "", "empty_body").when(encoding_corrupt(body), "encoding_corrupt").when(F.lower(subject).rlike(AUTO_REPLY), "auto_reply").when(F.lower(sender).rlike(NOISE_SENDER), "noise_sender")
        .when((T.word_count(body) < min_words) & ~has_domain_term(F.concat(body, F.lit(" "), subject)), "too_short").otherwise("")
    )


def system_noise(subject: Column, body: Column, folder: Column, sender: Column) -> Column:
    """Whether the search texts (``search_text``) of a message hold a system word within their first part."""
    blob = F.concat_ws(" ", subject, F.substring(body, 1, 400), folder, sender)
    return T.let(blob, lambda b: F.exists(F.array(*map(F.lit, SYSTEM_WORDS)), lambda w: F.contains(b, w)))


def detect_language(c: Column) -> Column:
    """By script: Hebrew or Latin letters of the first 4000 characters; null where neither is more than five."""
    t = F.substring(c, 1, 4000)
    he, en = T.count_matching(t, "[א-ת]"), T.count_matching(t, "[a-zA-Z]")
    return F.when((he > en) & (he > 5), "he").when(en > 5, "en")


# ---- summaries


def format_date(c: Column | str) -> Column:
    return F.coalesce(F.date_format(c, "dd/MM/yyyy"), F.lit(""))


def preferred_topic(mail: DataFrame) -> DataFrame:
    """Add ``topic``: of knowledge, LLM and cluster topic the first that is filled anywhere in the frame."""
    cols = ["knowledge_topic", "llm_topic"]
    filled = mail.agg(*[F.coalesce(F.max(T.strip(c) != ""), F.lit(False)).alias(f"_{c}") for c in cols])
    one = F.broadcast(filled)  # a single row
    return mail.join(one, F.lit(True)).withColumn("topic", F.when(F.col("_knowledge_topic"), F.col("knowledge_topic")).when(F.col("_llm_topic"), F.col("llm_topic")).otherwise(F.col("cluster_name"))).drop("_knowledge_topic", "_llm_topic")


def row_topic() -> Column:
    return F.coalesce(*[F.nullif(T.strip(c), F.lit("")) for c in ("knowledge_topic", "llm_topic", "cluster_name")], F.lit(""))


def top_values(df: DataFrame, by: list[str], value: str, k: int, out: str, shown: Column | None = None) -> DataFrame:
    """The k most frequent values of each group, joined with "; "; ties in order of the value."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), value))
    best = counts.withColumn("r", rank).filter(F.col("r") <= k).withColumn("_shown", F.col(value) if shown is None else shown)
    return best.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "_shown"))), lambda x: x["_shown"]), "; ").alias(out))


def summarize(mail: DataFrame, by: str, value: str, k: int, name: str, out: str) -> DataFrame:
    """Count, first and last date and top values for each non-blank group."""
    rows = mail.filter(T.strip(by) != "")
    base = rows.groupBy(by).agg(F.count("*").alias("email_count"), format_date(F.min("date_sort")).alias("first_date"), format_date(F.max("date_sort")).alias("last_date"))
    return base.join(top_values(rows, [by], value, k, out), by).withColumnRenamed(by, name)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit("unknown")).alias("value")).agg(F.count("*").alias("n"))


def parse_llm_reply(c: Column) -> Column:
    """The reply of a tagger: topic ``unknown`` by default, blank tags dropped, confidence a number or null."""
    raw = F.from_json(c, "topic string, subtopic string, tags array<string>, confidence string, summary string")
    return F.struct(
        F.coalesce(F.nullif(T.strip(raw["topic"]), F.lit("")), F.lit("unknown")).alias("topic"), F.coalesce(raw["subtopic"], F.lit("")).alias("subtopic"),
        F.coalesce(F.filter(F.transform(raw["tags"], T.strip), lambda x: x != ""), F.array().cast("array<string>")).alias("tags"), T.as_float(raw["confidence"]).alias("confidence"), F.coalesce(raw["summary"], F.lit("")).alias("summary"),
    )


# ---- search


def contains_pattern(value: str) -> str:
    """A pattern for the terms of a request in their order; a blank request matches the empty text only."""
    terms = value.split()
    return "(?iu)" + ".*".join(rf"\Q{t}\E" for t in terms) if terms else "$^"


def search(mail: DataFrame, topic: str | None = None, person: str | None = None, query: str | None = None, limit: int | None = 50) -> DataFrame:
    """Filter by topic, person and text, score, and rank; ties go by date, then message id and order. With a limit the results are numbered in ``rank``."""
    mail = with_columns(mail, [*SEARCH_COLUMNS, "cc_emails", "bcc_emails", "body"])
    rows = preferred_topic(mail)
    if topic:
        p = contains_pattern(topic)
        rows = rows.filter(F.col("topic").rlike(p) | F.col("llm_subtopic").rlike(p) | F.col("knowledge_subtopic").rlike(p) | F.col("subject").rlike(p))
    people = F.concat_ws(" ", "from_email", "to_emails", "cc_emails", "bcc_emails")
    if person:
        rows = rows.filter(people.rlike(contains_pattern(person)))
    if query:
        rows = rows.filter(F.concat_ws(" ", "subject", "clean_body", "body").rlike(contains_pattern(query)))
    hit = lambda value, c, points: F.when(F.contains(F.lower(c), F.lit(value.lower())), points).otherwise(0) if value else F.lit(0)
    subtopic = F.coalesce(F.nullif("knowledge_subtopic", F.lit("")), F.col("llm_subtopic"))
    score = (
        hit(topic, F.col("topic"), 50) + hit(topic, F.col("subject"), 20) + hit(topic, subtopic, 25) + hit(person, F.col("from_email"), 40)
        + hit(person, F.concat_ws(" ", "to_emails", "cc_emails", "bcc_emails"), 15) + hit(query, F.col("subject"), 25) + hit(query, F.col("clean_body"), 10)
    )
    order = [F.desc("search_score"), F.desc_nulls_last("date_sort"), "message_id", "ingest_seq"]
    rows = rows.withColumn("search_score", score).orderBy(*order)
    if limit is None:
        return rows
    return rows.limit(limit).withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))).orderBy("rank")  # limit rows only

"""Queries over the mail archive and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from missiva.functions import text as T
from missiva.operators import archive as A
from missiva.operators import classify as C
from missiva.operators import learning as L
from missiva.operators import packing as P
from missiva.operators.cleaning import clean
from missiva.session import cut, table

TOPICS = {r.name: r.keywords for r in C.RULES}


def _messages(spark, d):
    return table(spark, d, "messages")


def _mail(spark, d):
    return A.mail_frame(_messages(spark, d))


def _classified(spark, d, mode="rules"):
    return C.classify(_mail(spark, d), mode)


# ---- scalar functions


def normalize_whitespace(spark, d):
    return _messages(spark, d).select("ingest_seq", T.normalize_whitespace("body_text_raw").alias("value"))


def normalize_subject(spark, d):
    return _messages(spark, d).select("ingest_seq", T.normalize_subject("subject_raw").alias("value"))


def normalize_email(spark, d):
    rows = table(spark, d, "raw_messages").select("raw_id", F.concat(F.lit(" <"), F.upper("sender_email"), F.lit("> ")).alias("e"))
    return rows.select("raw_id", T.normalize_email("e").alias("value"))


def reply_forward(spark, d):
    return _messages(spark, d).select("ingest_seq", T.reply_forward("subject_raw").alias("value"))


def html_to_text(spark, d):
    html = F.concat(F.lit("<html><head><title>t</title></head><body><div>Hello<br>"), F.coalesce("text", F.lit("")), F.lit("</div><style>p{}</style><p>End &amp; <b>out</b></p></body></html>"))
    return table(spark, d, "documents").select("doc_id", T.html_to_text(html).alias("value"))


def clean_body(spark, d):
    return _messages(spark, d).select("ingest_seq", clean("body_text_raw").alias("c")).select("ingest_seq", "c.text", "c.mostly_quoted", F.array_join("c.notes", ";").alias("notes"))


def word_count(spark, d):
    return table(spark, d, "documents").select("doc_id", T.word_count(F.coalesce("text", F.lit(""))).cast("bigint").alias("value"))


def strip_control(spark, d):
    return table(spark, d, "documents").select("doc_id", T.strip_control("text").alias("value"))


def normalize_search_text(spark, d):
    return _messages(spark, d).select("ingest_seq", T.search_text("body_text_raw").alias("value"))


def subject_snippet(spark, d):
    return _messages(spark, d).select("ingest_seq", T.subject_snippet("subject_raw").alias("value"))


def embedding_text(spark, d):
    return _mail(spark, d).select("ingest_seq", T.embedding_text("subject", "body").alias("value"))


def tokens(spark, d):
    return _mail(spark, d).select("ingest_seq", F.array_join(T.tokens("body"), " ").alias("value"))


def sanitize_filename(spark, d):
    return table(spark, d, "attachments").select("attachment_id", "record_id", T.sanitize_filename(F.concat(F.lit("a/b: "), F.col("original_filename"))).alias("value"))


def truncate_body(spark, d):
    return table(spark, d, "documents").select("doc_id", T.truncate_body("text", 500, "\n[truncated]").alias("value"))


def split_header(spark, d):
    return table(spark, d, "emails_raw").select("row_id", F.array_join(T.split_header("to_emails"), "|").alias("value"))


def clean_header_id(spark, d):
    return table(spark, d, "raw_messages").select("raw_id", T.clean_header_id("message_id").alias("value"))


def as_float(spark, d):
    return table(spark, d, "emails_raw").select("row_id", T.as_float("word_count").alias("value"), T.as_float("nested_depth").alias("depth"))


def text_quality(spark, d):
    return table(spark, d, "emails_raw").select("row_id", F.round(T.text_quality("body"), 6).alias("value"))


def content_hash(spark, d):
    return _mail(spark, d).select("ingest_seq", A.content_hash(F.col("subject_normalized"), F.col("clean_body")).alias("value"))


def record_id(spark, d):
    parts = [F.col("source_pst"), F.col("source_folder"), F.col("message_id"), F.replace(A.iso_text(F.col("sent_at")), F.lit("T"), F.lit(" ")), F.col("sender_email"), F.coalesce("subject_normalized", F.lit("")), F.col("content_hash")]
    return _messages(spark, d).select("ingest_seq", F.substring(T.stable_hash(*map(T.json_part, parts)), 1, 24).alias("value"))


def week_bucket(spark, d):
    return _messages(spark, d).select("ingest_seq", T.iso_week("sent_at").alias("value"))


def format_date(spark, d):
    return _messages(spark, d).select("ingest_seq", A.format_date("sent_at").alias("value"))


def participants_key(spark, d):
    return _messages(spark, d).select("ingest_seq", F.array_join(A.participants("to_emails", "cc_emails"), ";").alias("value"))


def recipient_emails(spark, d):
    got = F.filter(F.transform("to_recipients", lambda r: T.normalize_email(r["email"])), lambda x: x.isNotNull())
    return table(spark, d, "raw_messages").select("raw_id", F.array_join(got, ";").alias("value"))


def parent_message_id(spark, d):
    some = lambda c: F.nullif(c, F.lit(""))
    return _messages(spark, d).select("ingest_seq", F.coalesce(some(F.col("in_reply_to")), F.try_element_at("reference_ids", F.lit(-1))).alias("value"))


def first_header(spark, d):
    low = F.transform_keys("internet_headers", lambda k, v: F.lower(k))
    return _messages(spark, d).select("ingest_seq", F.coalesce(F.nullif(low["importance"], F.lit("")), F.nullif(low["x-priority"], F.lit(""))).alias("value"))


def folder_filter(spark, d):
    want = "inbox\\Claims/".replace("\\", "/").strip("/").lower()
    return _messages(spark, d).filter(F.contains(F.lower("source_folder"), F.lit(want))).select("ingest_seq", "source_folder")


def parse_llm_json(spark, d):
    reply = F.to_json(F.struct(F.col("source").alias("topic"), F.lit("s").alias("subtopic"), F.array(F.lit(" a "), F.lit(""), F.col("lang")).alias("tags"), F.col("n_chars").cast("string").alias("confidence")))
    got = table(spark, d, "documents").select("doc_id", A.parse_llm_reply(reply).alias("r"))
    return got.select("doc_id", "r.topic", "r.subtopic", F.array_join("r.tags", ";").alias("tags"), "r.confidence")


# ---- flags and filters


def keyword_flags(spark, d):
    f = A.flags(F.col("subject"), F.col("clean_body"), F.col("from_email"), ["kedembenefit.example"], TOPICS)
    return _mail(spark, d).select("ingest_seq", f.alias("f")).select("ingest_seq", "f.*")


def encoding_corrupt(spark, d):
    return table(spark, d, "emails_raw").select("row_id", A.encoding_corrupt(F.col("body")).alias("value"))


def contains_domain_term(spark, d):
    return _mail(spark, d).select("ingest_seq", A.has_domain_term(F.concat("body", F.lit(" "), "subject")).alias("value"))


def filter_reason(spark, d):
    return table(spark, d, "emails_raw").select("row_id", A.filter_reason(F.col("subject"), F.col("body"), F.col("from_email"), 30).alias("value"))


def filter_reason_counts(spark, d):
    return filter_reason(spark, d).groupBy("value").agg(F.count("*").alias("n"))


def system_noise_rules(spark, d):
    return _mail(spark, d).select("ingest_seq", T.let(C.search_texts(), C.is_noise).alias("value"))


def detect_language(spark, d):
    return table(spark, d, "documents").select("doc_id", A.detect_language(F.col("text")).alias("value"))


def domain_name(spark, d):
    return _mail(spark, d).select("ingest_seq", L.domain_name(F.concat("subject", F.lit(" "), "body"), TOPICS).alias("value"))


def legacy_topic(spark, d):
    text = F.lower(F.concat_ws("\n", "subject", "clean_body", "folder_path"))
    return _mail(spark, d).select("ingest_seq", C.hits_topic(TOPICS, F.lower("subject"), text, F.col("cluster_name")).alias("value"))


# ---- duplicates, threads, joins


def dedup_mark(spark, d):
    return A.dedup_mark(_messages(spark, d))


def group_duplicates(spark, d):
    return A.group_duplicates(_messages(spark, d))


def thread_keys(spark, d):
    return A.thread_keys(_messages(spark, d))


def thread_position(spark, d):
    return A.thread_position(_messages(spark, d))


def thread_summary(spark, d):
    return A.thread_summary(_messages(spark, d))


def recipients_bridge(spark, d):
    return A.recipients_bridge(_messages(spark, d))


def message_attachments(spark, d):
    return A.message_attachments(_messages(spark, d), table(spark, d, "attachments"))


def parent_child(spark, d):
    rows = table(spark, d, "raw_messages").select("raw_id", "message_id", "parent_record_message_id")
    own = rows.filter("message_id IS NOT NULL").groupBy(F.col("message_id").alias("parent_record_message_id")).agg(F.min("raw_id").alias("parent_raw_id"))
    return rows.filter("parent_record_message_id IS NOT NULL").join(own, "parent_record_message_id", "left").select("raw_id", "parent_raw_id", F.col("parent_raw_id").isNull().alias("orphan"))


def cluster_name_join(spark, d):
    names = table(spark, d, "mailboxes").select("source_pst", "tz")  # fixed: one row a source
    return _messages(spark, d).select("ingest_seq", "source_pst").join(F.broadcast(names), "source_pst", "left").select("ingest_seq", "source_pst", F.coalesce("tz", F.lit("")).alias("name"))


def mock_tag(spark, d):
    tags = table(spark, d, "mix_targets").select(F.col("source").alias("cluster"), F.concat(F.lit("tag-"), F.col("max_repeats").cast("string")).alias("tag"))  # fixed: one row a source
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("cluster"))
    return docs.join(F.broadcast(tags), "cluster", "left").select("doc_id", F.coalesce("tag", "cluster").alias("llm_topic"))


# ---- aggregates and summaries


def summarize_topics(spark, d):
    return A.summarize(A.preferred_topic(_mail(spark, d)), "topic", "from_email", 5, "topic", "top_people")


def summarize_people(spark, d):
    return A.summarize(A.preferred_topic(_mail(spark, d)), "from_email", "topic", 5, "person", "top_topics")


def value_counts(spark, d):
    return A.value_counts(_messages(spark, d), "language")


def processing_report(spark, d):
    return _messages(spark, d).agg(
        F.count("*").alias("messages"), F.count_if("is_duplicate").alias("duplicates"), F.count_distinct("thread_key").alias("threads"),
        F.count_if("has_attachments").alias("with_attachments"), F.count_if(F.coalesce("body_text_clean", F.lit("")) != "").alias("with_clean_body"),
    )


def extract_stats(spark, d):
    n = F.count("*")
    return table(spark, d, "emails_raw").agg(n.alias("emails"), F.count_distinct("folder_path").alias("folders"), F.round(F.count_if(T.strip("body") != "") / F.greatest(n, F.lit(1)) * 100, 6).alias("percent_with_body"), F.count_distinct("from_email").alias("senders"))


def top_senders(spark, d):
    return table(spark, d, "emails_raw").groupBy("from_email").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "from_email").limit(10)


def cluster_stats(spark, d):
    return _mail(spark, d).groupBy("cluster_name").agg(F.count("*").alias("emails"), F.count_if(F.col("is_filtered") == "True").alias("filtered"), F.count_distinct("from_email").alias("senders"))


def date_range(spark, d):
    return _mail(spark, d).groupBy("folder_path").agg(A.format_date(F.min("date_sort")).alias("first_date"), A.format_date(F.max("date_sort")).alias("last_date"))


def _embedded(spark, d):
    return _mail(spark, d).select("cluster_name", "ingest_seq", "subject", T.embedding_text("subject", "body").alias("text"))


def top_terms(spark, d):
    return L.top_terms(_embedded(spark, d), "cluster_name", "text")


def row_topic(spark, d):
    return _mail(spark, d).select("ingest_seq", A.row_topic().alias("topic"))


# ---- search


def search_topic(spark, d):
    return A.search(_mail(spark, d), topic="Inbox", limit=50).select("rank", "ingest_seq", "search_score")


def search_person(spark, d):
    return A.search(_mail(spark, d), person="dana.morvane", limit=None).select("ingest_seq", "search_score")


def search_query(spark, d):
    return A.search(_mail(spark, d), query="tax certificate", limit=None).select("ingest_seq", "search_score")


def search_ranked(spark, d):
    return A.search(_mail(spark, d), topic="claims", person="kedembenefit", query="salary slip", limit=20).select("rank", "ingest_seq", "search_score")


# ---- classification and packs


def rule_scores(spark, d):
    rows = _mail(spark, d).select("ingest_seq", F.explode(T.let(C.search_texts(), lambda x: C.rule_scores(x))).alias("r"))
    return rows.select("ingest_seq", F.col("r.name").alias("rule"), "r.score", F.array_join("r.matched", ";").alias("matched"), "r.subtopic")


def classify_rules(spark, d):
    return _classified(spark, d).select("ingest_seq", "knowledge_topic", "knowledge_score", "knowledge_review_required", "is_system_noise")


def classify_cluster(spark, d):
    return _classified(spark, d, "cluster").select("ingest_seq", "knowledge_topic", "knowledge_mode")


def classify_llm(spark, d):
    return _classified(spark, d, "llm").select("ingest_seq", "knowledge_topic", "knowledge_mode")


def classify_hybrid(spark, d):
    mail = _mail(spark, d).withColumns({"llm_topic": F.when(F.col("ingest_seq") % 3 == 0, "tagged").otherwise(""), "llm_confidence": (F.col("ingest_seq") % 10) / 10})
    return C.classify(mail, "hybrid").select("ingest_seq", "knowledge_topic", "knowledge_mode")


def pack_included(spark, d):
    return _classified(spark, d).filter(P.included()).select("ingest_seq")


def pack_excluded(spark, d):
    return _classified(spark, d).filter(~P.included()).select("ingest_seq")


_PACK_COLUMNS = [
    "ingest_seq", "message_id", "date_sort", "from_email", "subject", "folder_path", "cluster_name", "parent_record_message_id", "nested_depth", "container_attachment_filename", "llm_topic", "llm_confidence",
    "knowledge_topic", "knowledge_subtopic", "knowledge_score", "knowledge_mode", "knowledge_review_required", "knowledge_matched_terms",
]


def _packed(spark, d):
    """Keys, sizes and heads of the mails that are packed, without their texts, and the parts."""
    sized = cut(P.sized(_classified(spark, d), _PACK_COLUMNS))  # read several times below
    return sized, P.place(sized)


def render_email(spark, d):
    return _classified(spark, d).select("ingest_seq", P.render_email(F.lit("EMAIL")).alias("text"))


def greedy_pack(spark, d):
    return _packed(spark, d)[1]


def manifest(spark, d):
    return P.manifest(*_packed(spark, d))


def pack_topics(spark, d):
    return P.pack_topics(*_packed(spark, d))


def part_header(spark, d):
    return P.part_headers(*_packed(spark, d))


def pack_people(spark, d):
    rows = _classified(spark, d).filter(P.included())
    return A.summarize(rows, "from_email", "knowledge_topic", 6, "person", "top_topics").orderBy(F.desc("email_count"), "person").limit(60)


def pack_totals(spark, d):
    return _packed(spark, d)[1].agg(F.count("*").alias("emails"), F.count_distinct("knowledge_topic", "part").alias("files"))


def review_queue(spark, d):
    return P.review_queue(_classified(spark, d))


# ---- learning


def representatives(spark, d):
    return L.representatives(_embedded(spark, d), "cluster_name", "ingest_seq", "text", "subject").select("cluster_name", "ingest_seq", "rank")


def name_clusters(spark, d):
    mail = _mail(spark, d).select("cluster_name", F.concat_ws(" ", "subject_normalized", "clean_body").alias("text"))
    return L.name_clusters(mail, "cluster_name", "text", TOPICS)


def kmeans_assign(spark, d):
    from pyspark.ml.functions import array_to_vector

    rows = table(spark, d, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return L.kmeans(rows, 8).select("vec_id", "cluster_id")


def tfidf(spark, d):
    from pyspark.ml.functions import vector_to_array

    got = L.tfidf(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")
    return got.select("doc_id", F.round(F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x * x), 6).alias("norm2"))


def distinct_vectors(spark, d):
    return table(spark, d, "embeddings").agg(F.count_distinct(F.transform("embedding", lambda x: F.round(x.cast("double"), 8))).alias("vectors"))


def eml_messages(spark, d):
    """Mail files written out from rows of raw_messages and parsed again."""
    from missiva.sources.eml import parse_files

    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    source = F.concat(
        F.lit("From: "), text("sender_email"), F.lit("\nMessage-ID: <"), F.col("raw_id").cast("string"), F.lit("@files.example>\nSubject: file\nMIME-Version: 1.0\nContent-Type: text/plain; charset=utf-8\n\n"), text("body_text_raw"),
        F.lit('\n\nFrom "b@inner.example" Mon Apr 22 12:36:41 2024\nFrom: b@inner.example\nSubject: inner\nDate: Mon, 22 Apr 2024 12:36:41 +0300\n\nInner text.\n'),
    )
    files = table(spark, d, "raw_messages").select(F.concat(F.lit("/archive/Inbox/"), F.col("raw_id").cast("string"), F.lit(".eml")).alias("path"), F.encode(source, "UTF-8").alias("content"))
    return parse_files(files).select("message_id", "parent_record_message_id", "nested_depth", "sender_email", "subject_raw", "sent_at")


_QUERIES = [
    normalize_whitespace, normalize_subject, normalize_email, reply_forward, html_to_text, clean_body, word_count, strip_control, normalize_search_text, subject_snippet, embedding_text, tokens, sanitize_filename, truncate_body, split_header,
    clean_header_id, as_float, text_quality, content_hash, record_id, week_bucket, format_date, participants_key, recipient_emails, parent_message_id, first_header, folder_filter, parse_llm_json, keyword_flags, encoding_corrupt,
    contains_domain_term, filter_reason, filter_reason_counts, system_noise_rules, detect_language, domain_name, legacy_topic, dedup_mark, group_duplicates, thread_keys, thread_position, thread_summary, recipients_bridge,
    message_attachments, parent_child, cluster_name_join, mock_tag, summarize_topics, summarize_people, value_counts, processing_report, extract_stats, top_senders, cluster_stats, date_range, top_terms, row_topic, search_topic,
    search_person, search_query, search_ranked, rule_scores, classify_rules, classify_cluster, classify_llm, classify_hybrid, pack_included, pack_excluded, render_email, greedy_pack, manifest, pack_topics, part_header, pack_people, pack_totals, review_queue,
    representatives, name_clusters, kmeans_assign, tfidf, distinct_vectors, eml_messages,
]


def queries():
    return {f.__name__: f for f in _QUERIES}


def oracle_sql():
    from missiva.plans.mail_sql import statements

    return statements()

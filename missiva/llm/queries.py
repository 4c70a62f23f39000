"""Queries of the problems on text, and their SQL where SQL can say it."""

from __future__ import annotations

from missiva.llm import encoding, history, language, mixing, personal, residue, tokens
from missiva.session import table


def p1_found(spark, d):
    return history.lines_not_new(table(spark, d, "messages")).select("ingest_seq", "line_no")


def p1_clean(spark, d):
    return history.newly_written(table(spark, d, "messages"))


def p2_found(spark, d):
    return personal.personal_items(table(spark, d, "messages")).drop("end_at")


def p2_redacted(spark, d):
    return personal.redacted(table(spark, d, "messages"))


def p6_found(spark, d):
    return language.mislabelled(table(spark, d, "messages"))


def p6_segments(spark, d):
    return language.text_segments(table(spark, d, "messages"))


def p6_language(spark, d):
    return language.text_language(table(spark, d, "messages"))


def p3_found(spark, d):
    return encoding.find_garbled(table(spark, d, "emails_raw")).select("row_id", "field")


def p3_restored(spark, d):
    return encoding.find_garbled(table(spark, d, "emails_raw"))


def p8_ids(spark, d):
    return tokens.with_ids(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "ids")


def p9_mix(spark, d):
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_shares(spark, d):
    return mixing.shares(p9_mix(spark, d), table(spark, d, "mix_targets"))


def p10_found(spark, d):
    docs = table(spark, d, "documents")
    return residue.score_documents(docs, residue.fit_residue(docs)).filter("is_residue").select("doc_id")


def p10_kept(spark, d):
    docs = table(spark, d, "documents")
    scores = residue.score_documents(docs, residue.fit_residue(docs)).filter("is_residue").select("doc_id")
    return docs.join(scores, "doc_id", "left_anti")


def queries():
    return {f.__name__: f for f in (p1_found, p1_clean, p2_found, p2_redacted, p6_found, p6_segments, p6_language, p3_found, p3_restored, p8_ids, p9_mix, p9_shares, p10_found, p10_kept)}


def oracle_sql():
    return {}

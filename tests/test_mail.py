import random
import sqlite3

from pyspark.sql import functions as F

from missiva.functions import text as T
from missiva.operators import archive as A
from missiva.operators import classify as C
from missiva.operators import learning as L
from missiva.operators.cleaning import clean
from missiva.operators.ordering import greedy_parts, numbered
from missiva.sources import tables
from missiva.sources.eml import parse


def values(spark, f, items):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(items)], "k int, v string")
    return [r.x for r in df.select("k", f("v").alias("x")).orderBy("k").collect()]


def test_text_functions(spark):
    assert values(spark, T.normalize_whitespace, ["  a \t b\r\n\r\n\r\n c\xa0 ", "", None]) == ["a b\n\nc", "", None]
    assert values(spark, T.normalize_subject, ["Re: FW:  Budget  2024", "השב: re: שלום", "[EXTERNAL] Re: x", None]) == ["budget 2024", "שלום", "re: x", ""]
    assert values(spark, T.normalize_email, [" <Dana@X.Example> ", "", None]) == ["dana@x.example", None, None]
    assert values(spark, T.reply_forward, ["RE: a", "Fwd: a", "תגובה: a", "a", None]) == ["reply", "forward", "reply", None, None]
    twice = values(spark, lambda c: T.normalize_subject(T.normalize_subject(c)), ["Re: Fwd: a  b", "x"])
    assert twice == ["a b", "x"]
    assert values(spark, T.sanitize_filename, ["a/b?.pdf", "con.txt", "  ", None])[:2] == ["a_b_.pdf", "con_.txt"]


def test_cleaner(spark):
    bodies = ["The forms are enclosed.\nBest regards,\nDana", "נא לאשר קבלה.\nבברכה,\nדנה", "My answer is yes.\n-----Original Message-----\nFrom: x", "> one\n> two\nthree", None, ""]
    got = values(spark, lambda c: F.to_json(clean(c)), bodies)
    assert '"text":"The forms are enclosed."' in got[0] and "signature_removed" in got[0]
    assert '"text":"נא לאשר קבלה."' in got[1]
    assert '"text":"My answer is yes."' in got[2] and "reply_history_removed" in got[2]
    assert '"text":"three","mostly_quoted":true' in got[3]
    assert "empty_body" in got[4] and "empty_body" in got[5]


def test_greedy_parts_match_a_fold(spark):
    rng = random.Random(2)
    rows = [(k, "t" if k % 3 else "u", rng.choice([5, 50, 130, 700])) for k in range(200)]
    df = spark.createDataFrame(rows, "k int, g string, size int")
    got = {r.k: r.part for r in greedy_parts(df, "g", ["k"], "size", 400, 6).collect()}
    want = {}
    for g in "tu":
        part, n, total = 1, 0, 0
        for k, h, s in rows:
            if h == g:
                if n and (n >= 6 or total + s > 400):
                    part, n, total = part + 1, 0, 0
                n, total = n + 1, total + s
                want[k] = part
    assert got == want


def test_greedy_parts_across_slices(spark):
    """One group holds most rows and lies in several slices; null groups, null and oversized rows, equal orders of groups."""
    rng = random.Random(7)
    rows = [(k, "hot" if k % 5 else rng.choice(["a", None, "z"]), rng.choice([None, 0, 5, 50, 130, 700]), "clash") for k in range(900)]
    df = spark.createDataFrame(rows, "k int, g string, size int, _n string")
    want = {}
    for g in ("hot", "a", None, "z"):
        part, n, total = 0, 0, 0
        for k, h, s, _ in rows:
            if h == g:
                s = s or 0
                if not n or n >= 7 or total + s > 400:
                    part, n, total = part + 1, 0, 0
                n, total = n + 1, total + s
                want[k] = part, n
    for slices in (1, 3, 40, 200):
        got = {r.k: (r.part, r.place) for r in greedy_parts(df, "g", ["k"], "size", 400, 7, slices).collect()}
        assert got == want, slices
    assert greedy_parts(df.limit(0), "g", ["k"], "size", 400, 7).count() == 0


def test_places_of_hot_groups(spark):
    rows = [(k * 37 % 500, "hot" if k % 4 else None if k % 8 else "b") for k in range(500)]
    df = spark.createDataFrame(rows, "k int, g string")
    plain = {r.k: r.place for r in numbered(df, "g", [F.desc("k")], "place").collect()}
    assert {r.k: r.place for r in numbered(df, "g", [F.desc("k")], "place", hot_rows=50).collect()} == plain
    for g in ("hot", None, "b"):
        keys = sorted((k for k, h in rows if h == g), reverse=True)
        assert [plain[k] for k in keys] == list(range(1, len(keys) + 1))
    assert numbered(df.limit(0), "g", ["k"], "place").count() == 0


def test_names_of_groups_can_be_written(spark, tmp_path):
    df = spark.createDataFrame([("a", "pension pension"), ("b", "zebra zebra crossing"), ("c", None)], "cluster_name string, text string")
    L.name_clusters(df, "cluster_name", "text", {"money": ["pension"]}).write.parquet(str(tmp_path / "names"))
    got = {r.cluster_name: r.name for r in spark.read.parquet(str(tmp_path / "names")).collect()}
    assert got == {"a": "money", "b": "zebra", "c": "נושא_c"}


def test_shared_folder_must_be_named_on_a_cluster():
    import pytest

    from missiva.session import shared_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_search_and_rules(spark):
    mail = spark.createDataFrame([(1, "m1", "Early retirement", "", "a@x.example", "inbox"), (2, "m2", "hello", "undeliverable", "b@x.example", "inbox"), (3, "m3", "", "", "", "")], "ingest_seq long, message_id string, subject string, clean_body string, from_email string, folder_path string")
    mail = A.with_columns(mail, [*A.SEARCH_COLUMNS, "body", "cc_emails", "bcc_emails"]).withColumn("date_sort", F.lit(None).cast("timestamp"))
    got = {r.ingest_seq: r for r in C.classify(mail).collect()}
    assert got[1].knowledge_topic == "pension" and got[1].knowledge_subtopic == "early" and got[1].knowledge_score == 3 + 8.5
    assert got[2].is_system_noise and got[2].knowledge_score == 0
    assert got[3].knowledge_review_required
    found = A.search(mail, topic="retirement").collect()
    assert [(r.ingest_seq, r.search_score) for r in found] == [(1, 20)]
    assert A.search(mail.limit(0), person="a").count() == 0


def test_learning():
    assert L.cluster_range(100, 100) == [5, 6, 7, 8, 9, 10]
    assert L.cluster_range(1, 1) == [1]
    assert L.elbow([2, 3, 4, 5], [100, 50, 45, 44]) == 3


def test_mail_files():
    source = ("From: outer@x.example\nTo: in@x.example\nSubject: Package\nMessage-ID: <o@x>\nMIME-Version: 1.0\nContent-Type: text/plain; charset=\"utf-8\"\n\nSee below\n\n"
              'From "s@y.example" Mon Apr 22 12:36:41 2024\nFrom: Sender <s@y.example>\nSubject: =?UTF-8?B?15jXldek16EgMTA2?=\nMessage-ID: <i@y>\nDate: Mon, 22 Apr 2024 12:36:41 +0300\n\nנא לשלוח.\n').encode()  # fmt: skip
    outer, inner = parse(source, {"source_pst": "p", "source_folder": "f", "eml_path": "/f/a.eml"})
    assert outer["body_text_raw"] == "See below" and inner["subject_raw"] == "טופס 106" and inner["parent_record_message_id"] == "o@x" and inner["nested_depth"] == 1 and inner["message_id"] == "i@y" and inner["body_text_raw"] == "נא לשלוח."
    wrong = "From: a@x.example\nContent-Type: text/plain; charset=utf-8\nMIME-Version: 1.0\n\n".encode() + "שלום, נא לבדוק.".encode("cp1255")
    assert parse(wrong, {"source_pst": "p", "source_folder": "f", "eml_path": "a"})[0]["body_text_raw"] == "שלום, נא לבדוק."
    nested = b'From: a@x.example\nMessage-ID: <1@x>\nMIME-Version: 1.0\nContent-Type: multipart/mixed; boundary="B"\n\n--B\nContent-Type: text/plain\n\nhi\n--B\nContent-Type: message/rfc822\nContent-Disposition: attachment; filename="in.eml"\n\nFrom: b@x.example\nMessage-ID: <2@x>\nSubject: in\n\ninner\n--B--\n'
    rows = parse(nested, {"source_pst": "p", "source_folder": "f", "eml_path": "a"})
    assert [(r["message_id"], r["nested_depth"], r["parent_record_message_id"], r["container_attachment_filename"]) for r in rows] == [("1@x", 0, None, None), ("2@x", 1, "1@x", "in.eml")]
    assert parse(b"", {"source_pst": "p", "source_folder": "f", "eml_path": "a"})[0]["body_text_raw"] == ""


def test_edges(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb", True, ["x"], {"k": "v"}), (2, None, None, None, None)], "n int, s string, b boolean, l array<string>, m map<string,string>")
    file = tables.export_csv(df, str(tmp_path / "a.csv"))
    back = tables.read_csv(spark, file).orderBy("n").collect()
    assert [tuple(r) for r in back] == [("1", "a\nb", "True", '["x"]', '[{"key":"k","value":"v"}]' if "[" in back[0].m else '{"k":"v"}'), ("2", "", "", "", "")]
    tables.export_sqlite({"t": df}, str(tmp_path / "a.db"), {"t": ["n"]})
    with sqlite3.connect(tmp_path / "a.db") as db:
        assert db.execute("select count(*) from t").fetchone() == (2,)
    tables.write_jsonl(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    docs = spark.createDataFrame([("x/a.docx", "T", "HEAD\n- b\nline")], "file string, title string, text string")
    tables.write_documents(docs, str(tmp_path))
    assert (tmp_path / "x/a.docx").read_bytes()[:2] == b"PK"


def test_duplicates_partition_their_keys(spark):
    cols = "ingest_seq long, record_id string, message_id string, sent_at timestamp, received_at timestamp, subject_normalized string, content_hash string, sender_email string, to_emails array<string>, cc_emails array<string>, conversation_id string, reference_ids array<string>, in_reply_to string"
    rows = [(k, f"r{k % 7}", f"M{k % 4}" if k % 2 else None, None, None, "s", f"h{k % 3}", "a@x", ["b"], None, None, None, None) for k in range(40)]
    got = A.dedup_mark(spark.createDataFrame(rows, cols)).collect()
    assert len(got) == 40 and sum(not r.is_duplicate for r in got) == 2 + 3


def test_entry_without_text_package(monkeypatch):
    import importlib
    import importlib.util
    import sys

    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name.startswith("missiva.llm") else real(name, *a))
    sys.modules.pop("__spark_entry__", None)
    e = importlib.import_module("__spark_entry__")
    assert "p4_found" in e.queries() and "p1_found" not in e.queries()
    assert set(e.oracle_sql()) <= set(e.queries())
    sys.modules.pop("__spark_entry__", None)


def test_packing_queries_keep_whole_bodies_and_full_parts(spark, monkeypatch):
    from missiva.plans import mail_queries as Q

    classified = Q._classified
    plain = lambda s, d: classified(s, d).orderBy("ingest_seq").limit(40).withColumns({"body_for_pack": F.repeat(F.lit("x"), 3000), "knowledge_topic": F.lit("one"), "is_filtered": F.lit("False"), "is_system_noise": F.lit(False)})
    monkeypatch.setattr(Q, "_classified", plain)
    d = "/root/testdata/sf0.001"
    assert all("x" * 3000 in r.text for r in Q.render_email(spark, d).collect())
    parts = Q.greedy_pack(spark, d).collect()
    assert len(parts) == 40 and {r.part for r in parts} == {1}

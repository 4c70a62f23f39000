import random

import numpy as np
import pytest

from missiva.llm import encoding as E
from missiva.llm import language as G
from missiva.llm import mixing as M
from missiva.llm import personal as P
from missiva.llm import residue as R
from missiva.llm import tokens as K

HEBREW = ["הבנק מבקש לתקן את אישור המס לאחר המיזוג", "הוועדה איבדה את טופס המוטבים וזה מעכב את הקצבה", "נא לשלוח את המכתב בשבוע הבא אל הסניף הצפוני"]
ENGLISH = ["The branch translated the annual statement before the end of the month.", "We received the salary slip, but the café receipts are missing.", "There is a grace period of nine days, so nothing is lost."]
FRENCH = ["Nous avons reçu le dossier, mais la page manque à l'envoi.", "Le versement a été effectué hier après la réunion."]


# ---- wrong decoding


def test_chains_undo_damage():
    for wrong, right in (("cp1252", "utf-8"), ("latin-1", "utf-8"), ("cp1255", "utf-8"), ("cp1252", "cp1255"), ("mac_roman", "utf-8")):
        word = "אישור" if right in ("utf-8", "cp1255") else "é"
        bad = E.damage(word, wrong, right)
        assert word in E.readings(bad).values(), (wrong, right)
    twice = E.damage(E.damage("relevé", "cp1252"), "cp1252")
    assert "relevé" in E.readings(twice).values()


def test_margin_of_all_clean_records(spark):
    """The margin is counted over every clean record, and each is damaged the same way wherever it lies."""
    texts = [f"{t} {k}" for k in range(60) for t in (*HEBREW, *FRENCH)] * 12
    df = spark.createDataFrame([(k, None, t) for k, t in enumerate(texts)], "row_id long, subject string, body string")
    long = E.fields_long(df, "row_id", ["subject", "body"])
    model = E.fit_ngrams(long)
    clean, bad = sum(E.looks_clean(t) for t in texts), sum(E.hurt(t) is not None for t in texts if E.looks_clean(t))
    for parts in (1, 7):
        got = E._judge(long.repartition(parts), model).filter("n IS NOT NULL").groupBy("hurt").sum("n").collect()
        assert {r[0]: r[1] for r in got} == {False: clean, True: bad} and clean > 2000 and bad > 2000
    assert E.best_margin({(False, 0): 5, (False, 3): 5, (True, 4): 5, (True, 5): 5})[0] == 6.0
    assert E.best_margin({})[0] == 12.0


def test_find_garbled(spark):
    rng = random.Random(1)
    rows, want = [], set()
    for k in range(240):
        text = rng.choice(HEBREW + ENGLISH + FRENCH) + " " + rng.choice(HEBREW + ENGLISH + FRENCH)
        if k % 8 == 0:
            bad = E.damage(text, "cp1252")
            if bad != text:
                want.add((k, "body"))
                text = bad
        rows.append((k, "ok", text, "clash"))
    rows += [(900, None, None, "c"), (901, "", "", "c"), (902, "????? ??? ????", "Really?? Yes, really.", "c"), (903, "a\ufffdb", "The panel measures 3 × 4 m.", "c")]
    want |= {(902, "subject"), (903, "subject")}
    df = spark.createDataFrame(rows, "row_id long, subject string, body string, text string")
    got = {(r.row_id, r.field): r for r in E.find_garbled(df).collect()}
    assert set(got) == want
    originals = {r[0]: r[2] for r in rows}
    some = next(k for k, f in want if f == "body" and "×" in originals[k])
    assert any(h in got[some, "body"].restored for h in ("הבנק", "הוועדה", "נא לשלוח"))
    assert got[903, "subject"].lost
    assert E.find_garbled(df.limit(0)).count() == 0


# ---- residue


def test_weak_labels():
    for bad in ("Dear {{first_name}},", "404 Not Found", "Please enable JavaScript to view this page.", "Lorem ipsum dolor sit amet", "java.lang.NullPointerException", "Your balance is XXXX-POLICY_NO."):
        assert R.weak_label(bad) == 1, bad
    for good in ("The error 500 on Tuesday came from a full disk. It was cleared.", "We received form 161, but page 9 is missing.", "IT asks us to keep JavaScript switched on for the portal.", "The room is booked from 10:30 to 12:00."):
        assert R.weak_label(good) is None, good


def test_residue(spark):
    rng = random.Random(4)
    bad = ["Dear {{name}},\n\nYour request {{id}} was received.", "404 Not Found\n\nThe requested page could not be located on this server.", "Please enable JavaScript to view this page."]
    docs, want = [], set()
    for k in range(300):
        text = " ".join(rng.choice(ENGLISH) for _ in range(3))
        if k % 20 == 0:
            text = rng.choice(bad) if k % 40 else text + "\n\n" + rng.choice(bad)
            want.add(k)
        docs.append((k, text, f"a@h{k % 9}.example", 0.0))
    docs += [(900, None, None, 0.0), (901, "  \n", None, 0.0), (902, "long " * 30_000 + "end.", "a@h.example", 0.0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, sender_email string, score double")
    got = R.score_documents(df, R.fit_residue(df)).collect()
    assert len(got) == len(docs)
    found = {r.doc_id for r in got if r.is_residue} - {902}
    assert len(found & want) >= 0.95 * len(want) and len(found - want) <= 2
    assert {r.score for r in got if r.doc_id in (900, 901)} == {None}
    assert R.score_documents(df.limit(0), R.fit_residue(df)).count() == 0
    assert R.fit_residue(df.limit(0)).report["held_out"] == 0


def test_residue_of_families_no_rule_knows(spark):
    """Three families of rules give no labels; the documents that only they would show are found by where they stand."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    without = ("server", "scripts", "missing")
    model = R.fit_residue(docs, without=without)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect() if r.text}
    left_out = sum(R._BIT[f] for f in without)
    shown = {k: [R.families(u) for u in R.units(t)] for k, t in texts.items()}
    rule = {k for k, f in shown.items() if any(f)}
    only = {k for k in rule if not any(f & ~left_out for f in shown[k])}
    found = {r.doc_id for r in R.score_documents(docs, model).filter("is_residue").select("doc_id").collect()}
    assert len(only) > 40 and len(only & found) >= 0.9 * len(only)
    # At least a tenth of what is found shows no rule at all, and little of that can be content.
    assert 0.1 * len(found) <= len(found - rule) <= 0.25 * len(found)


# ---- tokens


@pytest.mark.parametrize("text", ["", "hello world", "  leading  spaces\n\n\ttabs", "שלום עולם", "naïve café 3 × 4", "<|endoftext|>", "a" * 3000, "\x00\x01 \u200f😀😀"])
def test_ids_equal_the_public_encoder(text):
    import tiktoken

    e = K.Encoder()
    ranks, pattern = K.vocabulary()
    ref = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    assert e.encode(text) == ref.encode_ordinary(text)
    assert e.decode(e.encode(text)) == text


def test_ids_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x y"), (3, "x y")], "doc_id long, text string")
    got = sorted((r.doc_id, r.ids) for r in K.with_ids(df).collect())
    assert got[0] == (1, []) and got[1] == (2, []) and got[2] == got[3]
    back = K.with_text(K.with_ids(df).select("doc_id", "ids")).collect()
    assert {r.text for r in back} == {"", "x y"}


# ---- mixing


def test_split_tree_keeps_counts():
    counts = np.array([10, 0, 37, 5])
    leaves = M.split_tree(counts, 7, np.random.default_rng(1))
    assert len(leaves) == 7 and (sum(leaves) == counts).all() and max(x.sum() for x in leaves) - min(x.sum() for x in leaves) <= 2


def test_mix(spark):
    rng = random.Random(2)
    docs = [(k, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(k) for _ in range(rng.randrange(3, 30))), "big" if k % 10 else "small") for k in range(400)]
    docs += [(900, None, "big"), (901, " ", "big"), (902, "other text", "elsewhere"), (903, "no source", None), (904, docs[0][1], "small")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    goal = spark.createDataFrame([("big", 0.6, 1), ("small", 0.4, 3), ("absent", 0.0, 2)], "source string, target_share double, max_repeats int")
    mixed = M.mix(df, goal, blocks=32, shards=5).cache()
    share = {r.source: r for r in M.shares(mixed, goal).collect()}
    assert abs(share["big"].actual_share - 0.6) < 0.01 and abs(share["small"].actual_share - 0.4) < 0.01
    assert share["absent"].tokens == 0
    texts = {k: t for k, t, _ in docs}
    seen = {}
    for r in mixed.collect():
        seen[r.source, texts[r.doc_id]] = seen.get((r.source, texts[r.doc_id]), 0) + 1
    assert max(n for (s, _), n in seen.items() if s == "big") == 1 and max(n for (s, _), n in seen.items() if s == "small") <= 3
    assert not {r.doc_id for r in mixed.collect()} & {900, 901, 902, 903, 904}
    assert M.mix(df, goal, blocks=32, shards=5).exceptAll(mixed).count() == 0  # the same seed gives the same mix
    assert M.mix(df.limit(0), goal, blocks=8, shards=2).count() == 0


# ---- languages


def test_labels():
    assert [G.canonical_label(x) for x in ("en-US", "HEB", "iw", " EN ", "und", "unknown", "", None, "nl")] == ["en", "he", "he", "en", None, None, None, None, "nl"]


def test_languages(spark):
    base = [(k, t, None) for k, t in enumerate((ENGLISH + FRENCH + [h + "." for h in HEBREW]) * 6)]
    rows = base + [
        (500, ENGLISH[0] + "\n\n" + HEBREW[0] + ".", "en"), (501, ENGLISH[0], "en-GB"), (502, FRENCH[0], "fr"), (503, HEBREW[0] + ".", "heb"), (504, HEBREW[1] + ".", "en"), (505, "> " + ENGLISH[0] + "\n> \nDana Morvane", "EN"), (506, None, "en"), (507, " ", None), (508, "12 34", "en"),
    ]
    df = spark.createDataFrame(rows, "ingest_seq long, body_text_clean string, language string")
    got = {(r.ingest_seq, r.lang) for r in G.mislabelled(df).collect() if r.ingest_seq >= 500}
    assert got == {(500, "en"), (500, "he"), (504, "he")}
    runs = [(r.start_at, r.end_at, r.lang) for r in G.text_segments(df).filter("ingest_seq = 500").orderBy("start_at").collect()]
    assert [x[2] for x in runs] == ["en", "he"] and runs[1][0] == len(ENGLISH[0]) + 2
    top = {r.ingest_seq: (r.language, r.confidence) for r in G.text_language(df).collect()}
    assert top[503][0] == "he" and top[503][1] > 0.9 and 506 not in top
    assert G.mislabelled(df.limit(0)).count() == 0


# ---- personal information


def test_check_digit():
    assert P.check_digit("683000806") and not P.check_digit("683000807")


def test_personal_items(spark):
    people = [("Dana Morvane", "dana.morvane"), ("Dana Orvelin", "dana.orvelin"), ("Mark Morvane", "mark.morvane"), ("Mark Orvelin", "mark.orvelin"), ("April Orvelin", "april.orvelin"), ("April Morvane", "april.morvane")]
    lines = [
        "Hi Dana,\n\nI will mark the file in April. My identity number is 683 000 806. Call me on 052-555-0140 or (212) 555-0135.", "Ticket 683000806 is open. Write to dana.morvane@x.example or mark [at] x [dot] example.",
        "The member is Mark Orvelin, ID 683000806, living at 50 Juniper Avenue, Apt 25B, Fairhollow 12187.", "Policy 6-5909-34452 was moved on 11/21/2024, amount 60,809.", "נא לשלוח אל רח' האורנים 56, דירה 15, נווה שקמה.\n\nApril,\n\nthanks",
    ]
    rows = [(k, lines[k % 5] + "\n\n" + "v" * k, "Retirement file of Dana Morvane" if k % 7 == 0 else None, *people[k % 6]) for k in range(300)] + [(900, None, None, None, None), (901, "", "", None, None)]
    df = spark.createDataFrame([(k, b, s, n, f"{e}@x.example" if e else None, "clash", 1) for k, b, s, n, e in rows], "ingest_seq long, body_text_raw string, subject_raw string, sender_name string, sender_email string, field string, start_at int")
    finder = P.fit_finder(df)
    got = {}
    for r in P.personal_items(df, finder).collect():
        got.setdefault((r.ingest_seq, r.field), set()).add((r.pii_type, r.start_at))
    b = lines
    assert got[5, "body_text_raw"] == {("name", 3), ("id_number", b[0].index("683")), ("phone", b[0].index("052")), ("phone", b[0].index("(212"))}
    assert got[6, "body_text_raw"] == {("email", b[1].index("dana.")), ("email", b[1].index("mark ["))}
    assert got[2, "body_text_raw"] == {("name", b[2].index("Mark")), ("id_number", b[2].index("683")), ("address", b[2].index("50 Jun"))}
    assert (3, "body_text_raw") not in got and (900, "body_text_raw") not in got
    assert got[4, "body_text_raw"] == {("address", b[4].index("רח'")), ("name", b[4].index("April"))}
    assert got[7, "subject_raw"] == {("name", 19)}
    red = {r.ingest_seq: r for r in P.redacted(df, finder).collect()}
    assert red[7].subject_redacted == "Retirement file of [NAME]" and red[900].body_text_redacted is None and red[901].body_text_redacted == ""
    assert red[1].body_text_redacted == "Ticket 683000806 is open. Write to [EMAIL] or [EMAIL].\n\nv"
    assert P.personal_items(df.limit(0), P.fit_finder(df.limit(0))).count() == 0


def test_names_of_one_sender_and_of_none(spark):
    schema = "ingest_seq long, body_text_raw string, subject_raw string, sender_name string, sender_email string"
    shared = [("Dana Morvane", "dana.morvane"), ("Dana Orblin", "dana.orblin"), ("Uri Morvane", "uri.morvane"), ("Uri Orblin", "uri.orblin")]
    rows = [(k, f"Dear {n.split()[0]},\n\nThe fund has the updates for {n}, as said by the pension fund.\n\nKedem Benefit Fund\n{n}", None, n, f"{m}@x.example") for k, (n, m) in enumerate(shared * 15)]
    rows += [(100 + k, f"Hello all,\n\nSomething else {k}.", None, n, e) for k, (n, e) in enumerate([("Zephyrine Quorvex", "z@x.example"), ("Anna van Telmark", "a@x.example"), ("Fund Updates", "fund.updates@x.example")])]
    text = "Dear Brunhilde,\n\nZephyrine Quorvex saw Anna van Telmark. Quorvex wrote of the Kedem Benefit Fund.\n\nDear Colleagues,\nthanks."
    df = spark.createDataFrame(rows + [(200, text, None, None, None)], schema)
    got = {text[r.start_at : r.end_at] for r in P.personal_items(df).filter("ingest_seq = 200").collect()}
    assert got == {"Brunhilde", "Zephyrine Quorvex", "Anna van Telmark", "Quorvex"}


def test_names_beyond_those_held(spark, monkeypatch):
    """Name words and whole names that do not fit into memory are known all the same."""
    schema = "ingest_seq long, body_text_raw string, subject_raw string, sender_name string, sender_email string"
    shared = [("Dana Morvane", "dana.morvane"), ("Dana Orblin", "dana.orblin"), ("Uri Morvane", "uri.morvane"), ("Uri Orblin", "uri.orblin")]
    rows = [(k, f"Dear {n.split()[0]},\n\nThe fund has the updates for {n}, as said by the pension fund.\n\nKedem Benefit Fund\n{n}", None, n, f"{m}@x.example") for k, (n, m) in enumerate(shared * 15)]
    rows += [(100 + k, f"Hello all,\n\nSomething else {k}.", None, n, e) for k, (n, e) in enumerate([("Zephyrine Quorvex", "z@x.example"), ("Anna van Telmark", "a@x.example"), ("Anna van Telmark Ostrell", "o@x.example"), ("Fund Updates", "fund.updates@x.example")])]
    text = "Zephyrine Quorvex saw Anna van Telmark and Anna van Telmark Ostrell. Quorvex wrote of the Kedem Benefit Fund to Ostrell."
    df = spark.createDataFrame(rows + [(200, text, None, None, None)], schema)
    everything = lambda names: [(c, P.features(text, c, names)) for c in P.candidates(text, names)]
    found = lambda: {(r.ingest_seq, r.field, r.pii_type, r.start_at, r.end_at) for r in P.personal_items(df).collect()}
    want, items = everything(P.fit_names(df)), found()
    assert {text[c[2] : c[3]] for c, _ in want} >= {"Zephyrine Quorvex", "Anna van Telmark", "Anna van Telmark Ostrell", "Quorvex", "Ostrell"}
    for held in (0, 1, 4):
        monkeypatch.setattr(P, "NAME_WORDS", held)
        assert everything(P.fit_names(df)) == want, held
    assert found() == items

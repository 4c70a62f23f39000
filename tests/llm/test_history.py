from missiva.llm import history as H

SCHEMA = "ingest_seq long, message_id string, thread_key string, body_text_raw string, sender_name string, sender_email string, sent_at timestamp, received_at timestamp, t string, label string"


def frame(spark, items):
    return spark.createDataFrame([(k, f"m{k}" if m is None else m, t, b, n, e, None, None, "clash", "clash") for k, m, t, b, n, e in items], SCHEMA)


def marks(body, name=None, address=None):
    return "".join("NHDS"[x] for x in H.label_lines(body, name, address))


def test_layouts():
    assert marks("New text.\n\nOn Mon, 3 Jun 2024 at 05:25, Ada F <a@x.example> wrote:\n> old\n> older") == "NNHHH"
    assert marks("On Tuesday, April 23, 2024 11:42, Dana M <\nd@x.example> wrote:\n> old\n\nAn answer.\n> more old") == "HHHNNH"
    assert marks("Am 28.12.2023 um 20:52 schrieb Sergei K:\n\nalter Text\n\nmehr davon")[:1] == "H"
    assert marks("Fine.\nBest regards,\nDana Morvane\nPayroll Lead\nTel. 052-555-0140\n\nThis e-mail and any files sent with it are private.\nThe company accepts no liability.") == "NSSSSNDD"
    assert marks("Yes.\n\n-----Original Message-----\nFrom: A <a@x.example>\nSent: Monday\nTo: B\nSubject: C\n\nold") == "NNHHHHHHH"
    assert marks("Subject: to approval, we pay.\n\nTo: do list for the team follows.") == "NNN"
    assert marks("Good morning,\n\nThanks\n\nThe bank has the form.") == "NNNNN"
    assert marks("Text here.\n\nSent from my phone") == "NNS"
    assert marks("הטופס אושר.\n\nבברכה,\nדנה מורביין\nחשבת שכר") == "NNSSS"
    assert marks("The letter went out.\n\nDana Morvane", "Dana Morvane", "dana.morvane@x.example") == "NNS"
    assert marks("| a table | of | cells |\nnext line of text") == "NN"


def test_automaton_finds_runs_over_other_wrapping():
    auto = H.Automaton()
    first = [f"w{k}" for k in range(60)]
    auto.add(first)
    auto.add(["x", "y"] + first[10:20])
    assert auto.runs(["new"] + first[5:50] + ["new"], 30) == [(1, 46)]
    assert auto.runs(first[5:20], 30) == []


def test_inherited_text_without_any_mark(spark):
    old = "\n".join(" ".join(f"word{j}" for j in range(k, k + 10)) for k in range(0, 60, 10))
    again = "Fresh answer of mine.\n\n" + " ".join(old.split()[:30]) + "\n" + " ".join(old.split()[30:])
    items = [(1, None, "t", old, None, None), (2, None, "t", again, None, None), (3, "m1", "t", old + "\r", None, None), (4, None, None, again, None, None)]
    got = {(r.ingest_seq, r.line_no) for r in H.lines_not_new(frame(spark, items)).collect()}
    assert got == {(2, 3), (2, 4)}  # a copy of the first message inherits nothing, a thread of its own neither


def test_odd_rows_and_hot_thread(spark, monkeypatch):
    items = [(k, None, "hot", f"line {k}\n> quoted", None, None) for k in range(60)] + [(100, None, "t", None, None, None), (101, None, "t", "", None, None), (102, None, "t", "x" * 100_000, None, None)]
    df = frame(spark, items)
    plain = {tuple(r) for r in H.lines_not_new(df).collect()}
    assert plain == {(k, 2, "history") for k in range(60)}
    monkeypatch.setattr(H, "THREAD_WINDOW", 4)
    assert {tuple(r) for r in H.lines_not_new(df).collect()} == plain
    assert H.lines_not_new(frame(spark, [])).count() == 0
    clean = {r.ingest_seq: (r.body_text_clean, r.mostly_quoted) for r in H.newly_written(df).collect()}
    assert clean[100] == (None, False) and clean[101] == ("", False) and clean[3] == ("line 3", False)


def test_endings_a_sender_repeats_go(spark):
    own = "the small desk by the river, open from nine!"
    items = [(k, None, f"t{k}", f"Answer {k} stands here.\nIt took {k} days.\n\n{own}", None, "a@x.example") for k in range(6)]
    items += [(10 + k, "m10", "copies", f"The answer.\n\nonce in {'one'} body, delivered often!", None, "c@x.example") for k in range(5)]  # copies of one body count once
    items += [(20, None, "t20", f"A text.\n\n{own}", None, "b@x.example"), (21, None, "t21", own, None, "a@x.example")]  # another sender's line, and a line that is all of the text
    assert {tuple(r) for r in H.lines_not_new(frame(spark, items)).collect()} == {(k, 4, "signature") for k in range(6)}
    assert {r.ingest_seq: r.body_text_clean for r in H.newly_written(frame(spark, items)).collect()}[2] == "Answer 2 stands here.\nIt took 2 days."


def test_long_threads_inherit_from_any_earlier_message(spark, monkeypatch):
    old = "\n".join(" ".join(f"word{j}" for j in range(k, k + 10)) for k in range(0, 60, 10))
    items = [(0, None, "t", old, None, None)] + [(k, None, "t", f"Message {k} says other things.", None, None) for k in range(1, 30)]
    items += [(30, None, "t", "Fresh answer of mine.\n\n" + old, None, None), (31, "m0", "t", old + "\nSeen.", None, None), (32, None, "t", old, None, None), (33, None, "t", "", None, None), (34, None, "u", old, None, None)]
    whole = {tuple(r) for r in H.lines_not_new(frame(spark, items)).collect()}
    assert whole == {(30, k, "history") for k in range(3, 9)}  # copies by text or id and other threads inherit nothing
    monkeypatch.setattr(H, "THREAD_WINDOW", 4)
    assert {tuple(r) for r in H.lines_not_new(frame(spark, items)).collect()} == whole

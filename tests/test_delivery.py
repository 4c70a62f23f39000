import random

from missiva.operators.delivery import DeliveryStore, mark_deliveries, possible_repeats, surplus_rows, _keyed

SCHEMA = "ingest_seq long, message_id string, received_at timestamp, record_id string, _id string, is_duplicate boolean, duplicate_of string"


def rows(spark, items):
    import datetime

    return spark.createDataFrame([(k, i, t and datetime.datetime(2024, t, 1), f"r{k}", "clash", None, "x") for k, i, t in items], SCHEMA)


def brute(items):
    first, out = {}, set()
    for k, i, _ in sorted(items, key=lambda r: (r[0] is None, r[0])):
        key = (i or "").strip().strip("<>").strip().lower()
        if k is None or not key:
            continue
        if key in first and first[key] != k:
            out.add((first[key], k))
        first.setdefault(key, k)
    return out


def test_pairs_match_brute_force_with_a_hot_key(spark):
    rng = random.Random(1)
    items = [(k, "<HOT@x>" if k % 3 == 0 else f" m{rng.randrange(60)}@X ", rng.randrange(1, 13)) for k in range(1, 301)]
    df = rows(spark, items)
    assert {tuple(r) for r in surplus_rows(df).collect()} == brute(items)
    assert {tuple(r) for r in surplus_rows(df, words=7).collect()} == brute(items)  # a crowded filter costs time, not rightness


def test_odd_rows(spark):
    items = [(1, None, 1), (2, "", None), (3, "<>", 2), (4, " < > ", 2), (5, "a", None), (6, "<A>", 5), (None, "a", 1), (7, "a\t", 9)]
    assert {tuple(r) for r in surplus_rows(rows(spark, items)).collect()} == {(5, 6), (5, 7)}
    assert surplus_rows(rows(spark, [])).count() == 0


def test_marking_keeps_every_row(spark):
    items = [(1, "a", 1), (2, "A", 2), (3, None, 3), (4, "b", 3)]
    got = {r.ingest_seq: (r.is_duplicate, r.duplicate_of) for r in mark_deliveries(rows(spark, items)).collect()}
    assert got == {1: (False, None), 2: (True, "r1"), 3: (False, None), 4: (False, None)}


def test_filters_screen_new_identifiers(spark):
    df = rows(spark, [(k, f"only{k}", 1 + k % 12) for k in range(1, 200)])
    assert possible_repeats(_keyed(df, "message_id", "ingest_seq", "received_at", 1 << 34)).count() == 0


def test_store_over_batches(spark, tmp_path):
    store = DeliveryStore(spark, str(tmp_path / "store"))
    one = [(1, "a", 1), (2, "b", 1), (3, "A", 2)]
    two = [(4, "<b>", 7), (5, "c", 7), (6, "c", 8), (7, "a", 1)]
    assert {tuple(r) for r in store.add(rows(spark, one)).collect()} == {(1, 3)}
    assert {tuple(r) for r in store.add(rows(spark, two)).collect()} == {(2, 4), (5, 6), (1, 7)}


def test_store_after_a_crash(spark, tmp_path, monkeypatch):
    """A batch whose mark was not set does not count, and can be added again."""
    store = DeliveryStore(spark, str(tmp_path / "store"))
    store.add(rows(spark, [(1, "a", 1)]))
    files = DeliveryStore._files

    def broken(self, where):
        if "/done/" in where:
            raise OSError("lost")
        return files(self, where)

    monkeypatch.setattr(DeliveryStore, "_files", broken)
    try:
        store.add(rows(spark, [(2, "b", 2), (3, "a", 2)]))
        raise AssertionError
    except OSError:
        pass
    monkeypatch.undo()
    assert len(store.batches()) == 1
    assert {tuple(r) for r in store.add(rows(spark, [(2, "b", 2), (3, "a", 2)])).collect()} == {(1, 3)}
    assert {tuple(r) for r in store.add(rows(spark, [(4, "B", 3)])).collect()} == {(2, 4)}


def test_unreadable_store_is_an_error(spark, tmp_path):
    import shutil

    import pytest

    store = DeliveryStore(spark, str(tmp_path / "store"))
    store.add(rows(spark, [(1, "a", 1)]))
    shutil.rmtree(tmp_path / "store" / "batches")
    with pytest.raises(Exception, match="(?i)path"):
        store.add(rows(spark, [(2, "a", 2)])).collect()

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodestrata.operators import control, merge, purge

NOW = datetime(2026, 3, 1)
OLD = NOW - timedelta(days=30)
TABLE = "data_id string, hash string, data string, media string, gm_item_id string, updated_at timestamp"
BATCH = "data_id string, hash string, data string, media string, gm_item_id string, seq long"


def reload_tables(spark):
    """120 rows of a month ago; 1-90 come again unchanged (1-5 had no media), 91-100 changed, 101 unchanged, 121-130 new."""
    current = spark.createDataFrame([(str(i), f"h{i}", "d", None if i <= 5 else "m", f"g{i}", OLD) for i in range(1, 121)], TABLE)
    again = [(str(i), f"h{i}" if i <= 90 or i == 101 else f"x{i}", "d2", "m", f"g{i}", i) for i in [*range(1, 102), *range(121, 131)]]
    return current, spark.createDataFrame(again, BATCH)


def test_reload(spark):
    current, batch = reload_tables(spark)
    merged = merge.apply_batch(current, batch, F.lit(NOW)).cache()
    assert merged.count() == 130
    assert dict(rows(merged.groupBy("outcome").count())) == {"processed": 20, "media_backfilled": 5, "skipped": 86, None: 19}
    started = F.lit(NOW - timedelta(minutes=1))
    seen = batch.select("data_id")
    by_list = purge.stale_by_list(merged, seen, started)
    assert by_list.count() == 19
    kept = merge.apply_batch(current, batch, F.lit(NOW), touch=False)
    assert purge.stale_by_time(kept, started).count() == 86 + 5 + 19
    assert rows(purge.seen_counts(seen.unionByName(seen), 111)) == [(111, 1.0)]
    # Touching leaves backfilled rows at their old time, and those are on the list.
    touched = purge.stale_by_time(merged, started)
    compared = purge.shadow_compare(touched, by_list).first()
    assert (compared.touch_stale, compared.seen_stale, compared.refreshed_not_seen, compared.seen_not_refreshed) == (24, 19, 0, 5)
    left, _ = purge.purge(merged, {}, "labels", by_list)
    assert left.count() == 111


def test_replay_changes_nothing_more(spark):
    current, batch = reload_tables(spark)
    once = merge.apply_batch(current, batch, F.lit(NOW)).drop("outcome")
    twice = merge.apply_batch(once, batch, F.lit(NOW)).drop("outcome")
    assert rows(once.drop("updated_at")) == rows(twice.drop("updated_at"))


def test_latest_wins(spark):
    batch = spark.createDataFrame([("1", "a", "x", None, None, 2), ("1", "b", "y", None, None, 1), ("2", "c", "z", None, None, 3)], BATCH)
    assert rows(merge.latest(batch).select("data_id", "hash")) == [("1", "a"), ("2", "c")]


def test_hash_of_the_content(spark):
    df = spark.createDataFrame([("x", None), ("x", "given")], "data string, hash string")
    assert [len(r[0]) for r in df.select(merge.content_hash()).collect()] == [64, 5]
    assert [r[0] for r in df.select(merge.content_hash(strict=True)).collect()] == ["", "given"]


def test_empty_tables(spark):
    current, batch = reload_tables(spark)
    nothing, no_rows = current.limit(0), batch.limit(0)
    assert merge.apply_batch(nothing, no_rows, F.lit(NOW)).count() == 0
    assert merge.apply_batch(current, no_rows, F.lit(NOW)).where("outcome is null").count() == 120
    assert rows(purge.counts(nothing, nothing)) == [(0, 0, 0.0)]


def test_replacement_scopes(spark):
    current = spark.createDataFrame([("1", "a", "discogs"), ("1", "b", "other"), ("2", "c", "discogs"), ("3", "d", "discogs")], "release_id string, company_id string, source string")
    new = spark.createDataFrame([("1", "n", "discogs")], current.schema)
    changed = spark.createDataFrame([("1",), ("2",)], "data_id string")
    assert rows(merge.replace_for_documents(current, new, changed, "release_id", "discogs")) == [("1", "b", "other"), ("1", "n", "discogs"), ("3", "d", "discogs")]
    assert rows(merge.replace_for_documents(current, new, changed, "release_id")) == [("1", "n", "discogs"), ("3", "d", "discogs")]


def test_first_spelling_stays(spark):
    current = spark.createDataFrame([("1", "Old")], "company_id string, name string")
    new = spark.createDataFrame([("1", "New", 1), ("2", "B", 2), ("2", "A", 1)], "company_id string, name string, seq int")
    assert rows(merge.insert_vertices(current, new, "company_id")) == [("1", "Old"), ("2", "A")]


def test_reconcile(spark):
    s = "person_name string, artist_id string"
    current, asserted = spark.createDataFrame([("a", "1"), ("b", "2")], s), spark.createDataFrame([("b", "2"), ("c", "3"), ("c", "3")], s)
    table, inserted, deleted = merge.reconcile(current, asserted, False)
    assert (rows(table), rows(inserted), rows(deleted)) == ([("b", "2"), ("c", "3")], [("c", "3")], [("a", "1")])
    table, inserted, deleted = merge.reconcile(current, asserted.limit(0), True)
    assert rows(table) == [("a", "1"), ("b", "2")] and not rows(inserted) and not rows(deleted)


def test_aliases_are_never_overwritten(spark):
    s = "provider string, entity_kind string, external_id string, native_id string"
    current = spark.createDataFrame([("barcode", "release", "1", "n1")], s)
    targets = spark.createDataFrame([("barcode", "release", "1", "n2", 1), ("barcode", "release", "2", "n3", 2), ("barcode", "release", "2", "n4", 3)], s + ", seq int")
    table, conflicts = merge.attach_aliases(current, targets)
    assert rows(table) == [("barcode", "release", "1", "n1"), ("barcode", "release", "2", "n3")]
    assert rows(conflicts) == [("barcode", "release", "1", "n1", "n2")]


def test_guards():
    started = NOW
    limits = purge.Limits()
    assert not purge.too_many(0, 0) and not purge.too_many(10, 0) and purge.too_many(10, 9) and not purge.too_many(100, 89)
    assert purge.skip_reason(None, 5) == "no_started_at" and purge.skip_reason(NOW, 0) == "resumed" and purge.skip_reason(NOW, 1) is None
    good = purge.SeenList(started - timedelta(hours=1), 96)
    assert purge.seen_guard(good, started, 100) is None
    assert purge.seen_guard(purge.SeenList(started - timedelta(hours=1), 90), started, 100) == "below_fraction"
    assert purge.seen_guard(good, started, None) == "no_producer_count"
    lost = purge.SeenList(started + timedelta(hours=1), 0)
    assert purge.seen_guard(lost, started, 100) == "list_not_intact" and purge.already_settled(lost, started)
    assert purge.restart(lost, started, NOW) is lost and purge.restart(good, started, NOW) == purge.SeenList(NOW, 0)
    assert purge.mode_for("seen", False) == "touch" and purge.mode_for("shadow", True) == "shadow"
    with pytest.raises(ValueError):
        purge.mode_for("other", False)
    assert limits.least_seen == 0.95


def test_veto_runs(spark):
    rows_ = [("a", "3", False, False), ("a", "2", True, True), ("a", "1", True, False), ("a", "0", True, True), ("b", "1", True, False), ("c", "2", False, True), ("c", "1", True, True)]
    df = spark.createDataFrame(rows_, "entity string, version string, signalled boolean, vetoed boolean")
    assert rows(control.veto_runs(df)) == [("a", 1), ("b", 0), ("c", 2)]


def test_single_record(spark):
    current = spark.createDataFrame([("1", "h", "d", None, "old", OLD), ("2", "h", "d", "m", "old", OLD)], TABLE)
    record = spark.createDataFrame([("1", "h", "new", "m", "id", 1), ("3", "x", "new", None, "id", 2)], BATCH)
    assert rows(merge.apply_record(current, record, F.lit(NOW))) == [("1", "h", "d", "m", "id", NOW, "processed"), ("2", "h", "d", "m", "old", OLD, None), ("3", "x", "new", None, "id", NOW, "processed")]

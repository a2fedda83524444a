from datetime import datetime, timedelta, timezone

import pytest

from lodestrata import __main__, config
from lodestrata.operators import derive
from lodestrata.sources import naming
from lodestrata.sources.tables import require
from lodestrata.streaming.health import Health

PLACES = {"CATALOG_SOURCE": "a", "CATALOG_STORE": "b", "CATALOG_CHECKPOINT": "c"}


def test_config():
    c = config.from_env(PLACES | {"SEEN_LIST_MODE": "seen", "PURGE_MAX_DELETE_FRACTION": "0.5"})
    assert c.limits.mode == "seen" and c.limits.most_deleted == 0.5 and c.files_per_trigger == 100
    for bad in ({"SEEN_LIST_MODE": "x"}, {"DERIVED_REFRESH_MODE": "x"}, {"BATCH_FILES": "0"}, {"SEEN_MIN_FRACTION": "2"}):
        with pytest.raises(ValueError):
            config.from_env(PLACES | bad)


def test_a_failed_start_exits_with_one(monkeypatch):
    for k in PLACES:
        monkeypatch.delenv(k, raising=False)
    assert __main__.main() == 1


def test_names():
    assert naming.stream("p", "c", "labels") == "p-c-labels"
    assert naming.dead_letters("p", "c", "labels") == "p-c-labels.dlq" and naming.dead_letter_exchange("p", "c", "labels") == "p-c-labels.dlx"
    with pytest.raises(ValueError):
        naming.stream("p", "c", "planets")


def test_schema_assertion(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "i long, s string, x double")
    assert require(df, "s string, i long").columns == ["s", "i"]
    with pytest.raises(ValueError):
        require(df, "i int")
    with pytest.raises(ValueError):
        require(df, "missing string")


def test_health():
    now = [datetime(2026, 1, 1, tzinfo=timezone.utc)]
    h = Health(lambda: now[0])
    assert h.report()["status"] == "starting"
    h.seen(5)
    assert h.report() == {"status": "healthy", "progress": "active", "batches": 1, "records": 5, "failed": None}
    now[0] += timedelta(minutes=30)
    assert h.report()["progress"] == "stalled" and h.report()["status"] == "healthy"
    assert h.report(unsettled_for=timedelta(minutes=30))["status"] == "unhealthy"
    assert h.report(refresh_failed=True)["status"] == "unhealthy"


def test_candidates(docs):
    d = docs({"id": "1", "members": [{"id": 1}]}, {"id": "2", "members": []}, {"id": "3", "groups": [1]}, {"id": "4", "members": "x"})
    assert sorted(r.data_id for r in derive.candidates("artists", d).collect()) == ["1", "3"]
    assert derive.candidates("labels", d).count() == 0

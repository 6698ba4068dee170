from datetime import datetime

import pytest

from ledgerloom.sources import log as logs
from ledgerloom.sources.catalog import Catalog
from ledgerloom.sources.files import children
from ledgerloom.sources.log import Log

SCHEMA = "id int, at timestamp_ntz"


def test_many_records_leave_few_files_and_none_is_lost(spark, tmp_path, monkeypatch):
    empty = spark.createDataFrame([], SCHEMA)
    log = Log(Catalog(spark, str(tmp_path / "folded")), "runs", str(tmp_path / "runs"), empty.schema, "at", every=6)
    assert log.rows().count() == 0

    def add(i):
        at = None if i == 3 else datetime(2025, 1 + i // 10, 1 + i % 10)
        log.append(spark.createDataFrame([(i, at)], SCHEMA))

    def ids():
        return sorted(r.id for r in log.rows().collect())

    for i in range(8):
        add(i)
    assert ids() == list(range(8)) and len(log._files()) == 2

    # a job stops after the fold is committed and before the files are gone
    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(logs, "delete", stop)
        for i in range(8, 11):
            add(i)
        with pytest.raises(RuntimeError):
            add(11)
        assert ids() == list(range(12))
        with pytest.raises(RuntimeError):
            add(12)
        assert ids() == list(range(13))
    for i in range(13, 25):
        add(i)
    assert ids() == list(range(25))
    assert len(log._files()) < 6 + 1
    assert set(log._state()["folders"]) >= {"_month=2025-01", "_month=2025-02", "_month=none"}
    assert len(children(spark, str(tmp_path / "folded/_manifests"))) <= 3
    table = log.catalog.read("runs")
    assert table.count() == table.select("id").distinct().count()

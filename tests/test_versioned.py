"""Versioned table: commits, pinned readers, conflicts, purge and vacuum."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from jobsift.operators import governance
from jobsift.session import scratch_path
from jobsift.sinks.versioned import CommitConflict, VersionedTable

T0 = dt.datetime(2026, 1, 1, 12)


def table(spark, n=60):
    rows = [(i, f"c{i % 7}", T0 + dt.timedelta(days=i % 10)) for i in range(n)] + [(1000, None, None)]
    store = VersionedTable(spark, scratch_path(spark, "vt"))
    assert store.versions() == [] and store.overwrite(spark.createDataFrame(rows, "id long, company string, collected_at timestamp_ntz")) == 1
    return store, rows


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_removal_rewrites_only_touched_partitions(spark):
    store, rows = table(spark)
    pinned = store.read(1)
    asked = spark.createDataFrame([("c3",), ("nobody",), (None,)], "company string")


    v = governance.takedown_commit(store, asked)
    want = sorted(r[0] for r in rows if r[1] != "c3")
    assert v == 2 and ids(store.read()) == want and ids(pinned) == sorted(r[0] for r in rows)
    before, after = store.manifest(1)["parts"], store.manifest(2)["parts"]
    touched = {r[2].strftime("%Y-%m-%d") for r in rows if r[1] == "c3"}
    assert {p for p in before if before[p] != after.get(p)} == touched and "none" in after
    assert governance.takedown_commit(store, spark.createDataFrame([("nobody",)], "company string")) == 2     # nothing to do, no version
    assert ids(store.read(since="2026-01-03", until="2026-01-04")) == sorted(r[0] for r in rows if r[2] and r[2].day in (3, 4) and r[1] != "c3")


def test_failed_commit_leaves_the_old_version(spark, monkeypatch):
    store, rows = table(spark)
    everyone = sorted(r[0] for r in rows)

    def breaks(*a):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_commit", breaks)
        with pytest.raises(OSError):
            store.remove(spark.createDataFrame([("c1",)], "company string"), ["company"])
    assert store.versions() == [1] and ids(store.read()) == everyone
    other = VersionedTable(spark, store.root)
    write = VersionedTable._write

    def slow(self, df, prefix):                             # the other writer commits while this one writes
        out = write(self, df, prefix)
        monkeypatch.setattr(VersionedTable, "_write", write)
        other.remove(spark.createDataFrame([("c2",)], "company string"), ["company"])
        return out
    monkeypatch.setattr(VersionedTable, "_write", slow)
    with pytest.raises(CommitConflict):
        store.remove(spark.createDataFrame([("c1",)], "company string"), ["company"])
    assert store.versions() == [1, 2] and ids(store.read()) == sorted(r[0] for r in rows if r[1] != "c2")
    assert not [f for f in os.listdir(f"{store.root.replace('file:', '')}/_versions") if f.startswith(".") and not f.endswith(".crc")]


def test_purge_append_and_vacuum(spark):
    store, rows = table(spark)
    assert governance.retention_purge(store, 5, "2026-01-10 12:00:00") == 2
    late = sorted(r[0] for r in rows if r[2] is None or r[2] >= dt.datetime(2026, 1, 5, 12))
    assert ids(store.read()) == late and set(store.manifest()["parts"]) == {"none", *(f"2026-01-{d:02d}" for d in range(5, 11))}
    old, new = store.manifest(1)["parts"], store.manifest(2)["parts"]
    assert all(old[p] == new[p] for p in new if p != "2026-01-05")
    assert store.purge("2026-01-05 12:00:00") in (2, 3)
    more = spark.createDataFrame([(2000, "new", dt.datetime(2026, 1, 7)), (2001, "new", dt.datetime(2026, 2, 1))], "id long, company string, collected_at timestamp_ntz")
    store.append(more)
    assert ids(store.read()) == sorted([*late, 2000, 2001])
    assert store.vacuum(keep=1) > 0 and store.versions() == store.versions()[-1:] and ids(store.read()) == sorted([*late, 2000, 2001])
    with pytest.raises(FileNotFoundError):
        store.read(1)


def test_empty_table(spark):
    store = VersionedTable(spark, scratch_path(spark, "vt"))
    with pytest.raises(FileNotFoundError):
        store.read()
    store.overwrite(spark.createDataFrame([], "id long, collected_at timestamp_ntz"))
    assert store.read().count() == 0 and store.read().columns == ["id", "collected_at"]
    assert store.read().select(F.max("id")).head()[0] is None

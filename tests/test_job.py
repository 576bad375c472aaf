"""The batch job from raw files, the exploration export, metric steps."""
import datetime as dt
import json
import os

import pytest


from jobsift.operators import profile
from jobsift.plans import job, metrics
from jobsift.session import scratch_path


def _write_lines(path, records):
    local = path.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/part-0.jsonl", "w") as f:
        for r in records:
            f.write((json.dumps(r) if r is not None else "{broken") + "\n")


def test_clean_job_from_raw_files(spark):
    root = scratch_path(spark, "job_test")
    api = [{"source": "api", "fetched_at": "2026-03-15T12:00:00Z",
            "data": {"title": "Data Scientist", "company": {"display_name": "TechCorp"},
                     "location": {"display_name": "Paris, France"}, "description": "Python et SQL",
                     "salary_min": 50000, "salary_max": 60000, "created": "2026-03-14T09:00:00Z",
                     "redirect_url": "https://x/1", "id": "1"}},
           None,
           {"source": "api", "fetched_at": "2026-03-15T12:00:00Z",
            "data": {"title": "data scientist ", "company": {"display_name": "techcorp"},
                     "location": {"display_name": "paris"}, "description": None,
                     "salary_min": None, "salary_max": None, "created": "bad", "redirect_url": "https://x/2", "id": "2"}}]
    _write_lines(f"{root}/api", api)
    schema = spark.createDataFrame([], "source string, fetched_at string, data struct<title string, "
                                       "company struct<display_name string>, location struct<display_name string>, "
                                       "description string, salary_min double, salary_max double, created string, "
                                       "redirect_url string, id string>").schema
    feeds = {"api": job.load_feed(spark, f"{root}/api", schema)}
    counts = {}
    table = job.run_clean_job(spark, feeds, f"{root}/out", as_of="2026-03-16 00:00:00", counts=counts)
    assert counts == {"api": 2, "union": 2, "dedup": 1}
    with pytest.raises(ValueError, match="empty"):
        job.run_clean_job(spark, {"api": feeds["api"].where("false")}, f"{root}/out")
    rows = table.collect()
    assert len(rows) == 1                      # same (company, title, city) after normalisation; malformed line skipped
    r = rows[0]
    assert (r["city"], r["salary_avg"], r["tech_stack"]) == ("Paris", 55000.0, "Python, SQL")
    assert r["collected_at"] == dt.datetime(2026, 3, 15, 12, 0)
    csv = spark.read.option("header", "true").csv(f"{root}/out/clean_csv")
    assert csv.count() == 1


def test_explore_rename_and_export(spark):
    df = spark.createDataFrame([("T", ("Acme",), 40000.0, 50000.0, "x" * 6000, "2026-01-01")],
                               "title string, company struct<display_name string>, salary_min double, salary_max double, "
                               "description string, created string")
    renamed = profile.explore_rename(df, profile.lexicon.EXPLORE_API_RENAME, source="api")
    assert renamed.columns == ["intitule_poste", "description", "entreprise", "salaire_min", "salaire_max",
                               "date_publication", "source"]
    assert len(profile.explore_export(renamed).first()["description"]) == 6000
    out = profile.explore_export(renamed, n=5000).first()
    assert len(out["description"]) == 5000 and out["entreprise"] == "Acme" and out["source"] == "api"


def test_step_start_is_zone_free(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 59, 59),)], "ts timestamp_ntz")
    got = df.select(metrics.step_start("ts", "hour").alias("h"), metrics.step_start("ts", "day").alias("d")).first()
    assert (got["h"], got["d"]) == (dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1))


def test_command_line_clean_and_report(spark, capsys):
    from jobsift.__main__ import main
    root = scratch_path(spark, "cli")
    _write_lines(f"{root}/api", [{"source": "api", "fetched_at": "2026-03-15T12:00:00Z",
                                  "data": {"title": "Data Scientist", "company": {"display_name": "TechCorp"},
                                           "location": {"display_name": "Lyon"}, "description": "Python, full remote",
                                           "salary_min": 50000, "salary_max": 60000, "created": "2026-03-14T09:00:00Z",
                                           "redirect_url": "https://x/1", "id": "1"}}])
    assert main(["clean", "--api", f"{root}/api", "--out", f"{root}/store", "--as-of", "2026-03-16 00:00:00"]) == 0
    assert main(["report", "--store", f"{root}/store/clean_parquet", "--page", "overview", "--out", f"{root}/reports"]) == 0
    assert spark.read.parquet(f"{root}/reports/kpis").count() == 1
    out = capsys.readouterr().out
    assert "cleaned rows: 1" in out and "== kpis" in out


def test_only_new_files_are_cleaned_and_merged(spark, monkeypatch):
    """Three landings, one of them failing half way: the store equals one run over all files; nothing is read twice."""
    import json
    import os

    from pyspark.sql import functions as F

    from jobsift.operators import clean
    from jobsift.plans import job
    from jobsift.schema import RAW_API
    from jobsift.session import scratch_path
    from jobsift.sinks.versioned import VersionedTable
    landing = scratch_path(spark, "landing").replace("file:", "")
    os.makedirs(landing)

    def land(name, rows):
        with open(f"{landing}/{name}.json", "w") as f:
            for title, company, day, contract in rows:
                f.write(json.dumps({"fetched_at": f"2026-03-{day:02d}T12:00:00Z", "data": {
                    "title": title, "company": {"display_name": company}, "location": {"display_name": "Paris"}, "contract_type": contract, "created": "2026-03-01T09:00:00Z"}}) + "\n")

    read = []

    def reader(paths):
        read.extend(os.path.basename(p) for p in paths)
        return job.load_feed(spark, paths, RAW_API)

    store = VersionedTable(spark, scratch_path(spark, "store"))
    feeds = {"api": (landing, reader)}
    assert job.clean_new_files(store, {"api": (landing, reader)}) == 0 and not read
    land("a", [("Data Engineer", "Acme", 1, None), ("Analyst", "Acme", 1, "permanent"), ("Chef", "Bistro", 2, None)])
    assert job.clean_new_files(store, feeds) == 1 and read == ["a.json"]
    assert job.clean_new_files(store, feeds) == 1 and read == ["a.json"]                     # nothing new: no version, nothing read
    land("b", [("data engineer ", "ACME", 3, "permanent"), ("New", "Start", 3, None)])       # more complete: moves to another day
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            job.clean_new_files(store, feeds)
    assert store.versions() == [1] and store.read().count() == 3
    before = store.manifest(1)["parts"]
    assert job.clean_new_files(store, feeds) == 2
    after = store.manifest(2)["parts"]
    assert before["2026-03-02"] == after["2026-03-02"] and before["2026-03-01"] != after["2026-03-01"]
    land("c", [("Analyst", "acme", 1, None)])                                                 # less complete: changes nothing
    assert job.clean_new_files(store, feeds) == 3
    whole = clean.dedup_keep_most_complete(clean.normalize(job.load_feed(spark, landing, RAW_API), "api"))
    assert sorted(map(str, store.read().collect())) == sorted(map(str, whole.collect())) and store.read().count() == 4
    assert store.note(job.LEDGER, job.LEDGER_SCHEMA).count() == 3
    assert job.cleaned_rows(store).where(F.col("title").contains("ngineer")).head()["contract_type"] == "CDI"


def test_a_merge_does_no_step_twice(spark, monkeypatch):
    """The first load is deduplicated once; where all partitions are rewritten, none is searched for keys."""
    from jobsift.schema import RAW_API
    from jobsift.sinks.versioned import VersionedTable
    landing, calls = scratch_path(spark, "twice"), []
    store = VersionedTable(spark, scratch_path(spark, "twice_store"), "published_at", "yyyy")
    dedup, read = job.dedup_keep_most_complete, store.read
    monkeypatch.setattr(job, "dedup_keep_most_complete", lambda df: (calls.append("dedup"), dedup(df))[1])
    monkeypatch.setattr(store, "read", lambda *a: (calls.append("read"), read(*a))[1])
    feeds = {"api": (landing, lambda paths: job.load_feed(spark, paths, RAW_API))}

    def land(kind, rows):
        _write_lines(f"{landing}/{kind}", [{"fetched_at": "2026-03-01T12:00:00Z", "data": {
            "title": t, "company": {"display_name": "Acme"}, "contract_type": c, "created": f"{y}-03-01T09:00:00Z"}} for t, c, y in rows])

    land("a", [("A", None, 2024), ("B", None, 2025), ("b", "permanent", 2025)])
    assert job.clean_new_files(store, feeds) == 1 and calls == ["dedup"]
    land("b", [("a ", "permanent", 2025), ("C", None, 2024)])
    assert job.clean_new_files(store, feeds) == 2 and calls == ["dedup"] * 3
    land("c", [("c", "permanent", 2026)])                                     # its key stands in a partition that the file has no date of
    assert job.clean_new_files(store, feeds) == 3 and calls == ["dedup"] * 4 + ["read", "dedup"]
    assert sorted((r["title"].strip().lower(), r["contract_type"], r["published_at"].year) for r in read().collect()) == [
        ("a", "CDI", 2025), ("b", "CDI", 2025), ("c", "CDI", 2026)]

"""The batch cleaning job: raw feeds on storage -> cleaned table (parquet store + CSV [+ JDBC]).

Re-expresses the reference's ``run()``: list/load the three feeds, normalise,
union, dedup, enrich, type, export. Loading is one Spark scan per feed (not one
request per file); exports are parallel writes, one file per partition.
"""
from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift import lexicon
from jobsift.operators.clean import (build_clean, cast_types, dedup_key_part, dedup_keep_most_complete, enrich, normalize, project_target,
                                     union_sources, unwrap_envelope)
from jobsift.sinks import writers
from jobsift.sinks.versioned import VersionedTable
from jobsift.session import materialize
from jobsift.sources import files

log = logging.getLogger("jobsift.job")


def load_feed(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, kind: str = "lines",
              csv_schema: T.StructType | None = None) -> DataFrame:
    """One raw feed: JSON lines (envelopes unwrapped) or a mixed folder of JSONL/JSON/CSV."""
    if kind == "lines":
        return unwrap_envelope(files.scan_jsonl(spark, path, schema).drop("_file"))
    return files.scan_mixed_dir(spark, path, schema, csv_schema=csv_schema)


def _step(df: DataFrame, name: str, seen: dict[str, Observation]) -> DataFrame:
    """``df``, counted by an Observation on the way through."""
    seen[name] = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    return df.observe(seen[name], F.count(F.lit(1)).alias("n"))


def run_clean_job(spark: SparkSession, feeds: dict[str, DataFrame], out_dir: str, as_of=None, skills=None,
                  jdbc_url: str | None = None, jdbc_table: str | None = None,
                  jdbc_properties: dict | None = None, counts: dict[str, int] | None = None) -> DataFrame:
    """Clean ``feeds`` ({'api'|'third'|'scraped': raw frame}) and write the result.

    The parquet store is the table of record and is returned (read back, so later
    steps do not recompute the cleaning). Each step's rows (every feed, after the
    union, after the dedup) are counted by Observations on the write itself, logged,
    and put into ``counts``. Feeds that are all empty raise before anything is
    overwritten. A JDBC failure is logged and leaves the files in place.
    """
    if not feeds:
        raise ValueError("no feed to clean")
    if jdbc_url and not jdbc_table:
        raise ValueError("name the JDBC table")
    if all(df.isEmpty() for df in feeds.values()):
        raise ValueError("all feeds are empty")
    seen: dict[str, Observation] = {}
    kw = {} if skills is None else {"skills": skills}
    watched = {kind: _step(df, kind, seen) for kind, df in feeds.items()}
    cleaned = build_clean(watched, as_of=as_of, on_step=lambda name, df: _step(df, name, seen), **kw)
    store = f"{out_dir.rstrip('/')}/clean_parquet"
    writers.write_parquet(cleaned, store)
    found = {name: int(o.get["n"]) for name, o in seen.items()}
    log.info("rows by step: %s", found)
    if counts is not None:
        counts.update(found)
    table = spark.read.parquet(store)
    writers.write_csv(table, f"{out_dir.rstrip('/')}/clean_csv")
    if jdbc_url:
        try:
            writers.write_jdbc_text(table, jdbc_url, jdbc_table, jdbc_properties)
        except Exception as exc:  # noqa: BLE001  (the files stay the source of truth)
            log.error("JDBC export failed, data kept in %s: %s", out_dir, exc)
    return table


LEDGER, LEDGER_SCHEMA = "files", "path string, length long, modificationTime timestamp"


def clean_new_files(store: VersionedTable, feeds: dict[str, tuple[str, Callable[[list[str]], DataFrame]]], as_of=None) -> int:
    """Clean the files that ``store`` has not seen yet and merge them in. Returns the store's latest version.

    ``feeds`` names each kind's folder and a reader of a list of files. The store holds normalised rows, one a (company,
    title, city) key, the most complete; the ledger of files is a note of its version, so rows and
    ledger are committed together: a failed run leaves both, and runs again. Only new files are read, and only partitions that hold a key
    of theirs, or will, are rewritten. The result is that of one run over all files, in any order. Files
    are told by path, length and time: a changed file is a new one, its old rows stay.
    """
    spark, known = store.spark, store.note(LEDGER, LEDGER_SCHEMA)
    frames, listed = [], None
    for kind, (path, read) in feeds.items():
        new = files.list_files(spark, path).select("path", "length", "modificationTime").join(known, ["path", "length", "modificationTime"], "left_anti")
        names = sorted(r["path"] for r in new.collect())                  # the driver lists these files anyway
        if names:
            frames.append(normalize(read(names), kind, as_of))
            listed = new if listed is None else listed.unionByName(new)
    if not frames:
        return (store.versions() or [0])[-1]
    keys = [dedup_key_part(k).alias(f"_{k}") for k in ("company", "title", "city")]
    fresh = materialize(dedup_keep_most_complete(union_sources(frames)), "new-postings")
    touched = store.parts_of(fresh)
    there = set(store.manifest()["parts"]) if store.versions() else set()
    if not touched >= there:                                              # else nothing more can be touched
        old = store.read().select(*keys, store.by).join(fresh.select(*keys).distinct(), [f"_{k}" for k in ("company", "title", "city")], "left_semi")
        touched |= store.parts_of(old)

    def merged(rows: DataFrame) -> DataFrame:
        new = fresh.select(*rows.columns)
        return dedup_keep_most_complete(rows.unionByName(new)) if touched & there else new        # alone, it is one row a key already

    return store.rewrite(touched, merged, fresh.schema.json(), {LEDGER: known.unionByName(listed)})


def cleaned_rows(store: VersionedTable, skills: Sequence[str] = lexicon.TECH_SKILLS, version: int | None = None) -> DataFrame:
    """The cleaned table of a store of normalised rows: skills added, typed, in the target columns."""
    return project_target(cast_types(enrich(store.read(version), skills)))

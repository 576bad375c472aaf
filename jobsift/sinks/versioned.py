"""A table of date partitions whose versions are committed by one rename.

Data folders are written once and never changed. A version is a small list
(partition -> folder) in ``_versions/<number>``; it is written aside and renamed to its
number, which fails if another writer was there first. Readers pin a
version: what is removed or rewritten later does not change under them. A removal
rewrites the partitions that it touches and takes the others over by name.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Partition of rows without a date.
NO_DATE = "none"
_PART = "_part"


class CommitConflict(RuntimeError):
    """Another writer has committed since the version that this change is based on."""


class VersionedTable:
    """Versions of the table under ``root``, a folder that driver and executors share.

    ``by`` is the date column, ``unit`` the pattern that names its partition (a day, or
    yyyy-MM for months). Partitions, unlike rows, are listed on the driver.
    """

    def __init__(self, spark: SparkSession, root: str, by: str = "collected_at", unit: str = "yyyy-MM-dd"):
        self.spark, self.root, self.by, self.unit = spark, root.rstrip("/"), by, unit
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # ---- versions

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("x").getFileSystem(self._conf)

    def versions(self) -> list[int]:
        """Numbers of the committed versions, oldest first."""
        folder = self._path("_versions")
        if not self._fs().exists(folder):
            return []
        names = (s.getPath().getName() for s in self._fs().listStatus(folder))
        return sorted(int(n) for n in names if n.isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """{"schema": .., "parts": {partition: folder}, "notes": {name: folder}} of a version (default: the latest)."""
        have = self.versions()
        if not have:
            raise FileNotFoundError(f"no version under {self.root}")
        number = have[-1] if version is None else version
        if number not in have:
            raise FileNotFoundError(f"version {number} is not under {self.root}")
        stream = self._fs().open(self._path(f"_versions/{number}"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, based_on: int, schema: str, parts: dict[str, str], notes: dict[str, str] | None = None) -> int:
        number, aside = based_on + 1, self._path(f"_versions/.{uuid.uuid4().hex}")
        out = self._fs().create(aside, False)
        try:
            out.write(bytearray(json.dumps({"schema": schema, "parts": parts, "notes": notes or {}}, sort_keys=True).encode()))
        finally:
            out.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self._conf)
        how = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = getattr(self._jvm.org.apache.hadoop.fs.Options.Rename, "NONE")       # never over an existing version
        try:
            files.rename(self._fs().makeQualified(aside), self._fs().makeQualified(self._path(f"_versions/{number}")), how)
        except Exception as e:
            self._fs().delete(aside, False)
            if number in self.versions():
                raise CommitConflict(f"version {number} was committed by another writer") from e
            raise
        return number

    # ---- rows

    def _part(self) -> Column:
        return F.coalesce(F.date_format(F.col(self.by).try_cast("timestamp_ntz"), self.unit), F.lit(NO_DATE))

    def _write(self, df: DataFrame, prefix: str) -> dict[str, str]:
        """``df``'s rows in new folders, one a partition."""
        folder = f"data/{prefix}-{uuid.uuid4().hex[:12]}"
        df.withColumn(_PART, self._part()).write.partitionBy(_PART).parquet(f"{self.root}/{folder}")
        names = (s.getPath().getName() for s in self._fs().listStatus(self._path(folder)))
        return {n.split("=", 1)[1]: f"{folder}/{n}" for n in names if n.startswith(_PART + "=")}

    def _read(self, schema: str, folders: Iterable[str]) -> DataFrame:
        kind, paths = T.StructType.fromJson(json.loads(schema)), [f"{self.root}/{f}" for f in folders]
        return self.spark.read.schema(kind).parquet(*paths) if paths else self.spark.createDataFrame([], kind)

    def read(self, version: int | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
        """The rows of a version (default: the latest), of the partitions named from ``since`` to ``until``; no other is listed."""
        m = self.manifest(version)
        keep = [f for p, f in sorted(m["parts"].items()) if (since is None or p >= since) and (until is None or p <= until)]
        return self._read(m["schema"], keep)

    def overwrite(self, df: DataFrame) -> int:
        """Commit ``df`` as the whole table. Returns the version's number."""
        base = (self.versions() or [0])[-1]
        return self._commit(base, df.schema.json(), self._write(df, "all"))

    def append(self, df: DataFrame) -> int:
        """Commit the rows of ``df`` besides those there are: only partitions that it has rows of are rewritten."""
        return self.rewrite(self.parts_of(df), lambda old: old.unionByName(df.select(*old.columns)), df.schema.json())

    def parts_of(self, df: DataFrame) -> set[str]:
        """The partitions that rows of ``df`` belong to."""
        return {r[0] for r in df.select(self._part()).distinct().collect()}              # partitions, not rows

    def rewrite(self, touched: set[str], change: Callable[[DataFrame], DataFrame], schema: str | None = None,
                notes: dict[str, DataFrame] | None = None) -> int:
        """Commit the table with ``change`` applied to the rows of the partitions ``touched``; the others are taken over.

        ``schema`` (JSON) is that of a table without a version yet. ``notes`` are small tables that belong
        to the new version, committed with it: they replace those of the same names, other notes stay.
        """
        have = self.versions()
        base = have[-1] if have else 0
        m = self.manifest(base) if have else {"schema": schema, "parts": {}, "notes": {}}
        rows = change(self._read(m["schema"], [f for p, f in sorted(m["parts"].items()) if p in touched]))
        parts = {p: f for p, f in m["parts"].items() if p not in touched} | self._write(rows, f"v{base + 1}")
        kept = dict(m["notes"])
        for name, note in (notes or {}).items():
            kept[name] = f"notes/{name}-{uuid.uuid4().hex[:12]}"
            note.write.parquet(f"{self.root}/{kept[name]}")
        return self._commit(base, m["schema"], parts, kept)

    def note(self, name: str, schema: str, version: int | None = None) -> DataFrame:
        """A note of a version (default: the latest); an empty frame of ``schema`` if there is none."""
        folder = self.manifest(version)["notes"].get(name) if self.versions() else None
        return self.spark.read.schema(schema).parquet(f"{self.root}/{folder}") if folder else self.spark.createDataFrame([], schema)

    def remove(self, requests: DataFrame, keys: list[str]) -> int:
        """Commit the table without the rows that match a request on ``keys`` (null keys match nothing).

        Only partitions that hold such rows are rewritten; they are found by reading the keys alone. Without
        any, nothing is committed. Returns the latest version's number.
        """
        asked = requests.select(*keys).dropDuplicates()
        touched = self.parts_of(self.read().select(*dict.fromkeys((*keys, self.by))).join(asked, keys, "left_semi"))
        if not touched:
            return self.versions()[-1]
        return self.rewrite(touched, lambda old: old.join(asked, keys, "left_anti").select(*old.columns))

    def purge(self, cutoff: str) -> int:
        """Commit the table without rows dated before ``cutoff`` (a timestamp's text); rows without a date stay.

        Partitions that end before it are dropped by name; only the one that holds the cutoff is rewritten.
        """
        at = F.lit(cutoff).cast("timestamp_ntz")
        edge = self.spark.range(1).select(F.date_format(at, self.unit)).head()[0]
        base = self.versions()[-1]
        m = self.manifest(base)
        parts = {p: f for p, f in m["parts"].items() if p == NO_DATE or p > edge}
        if edge in m["parts"]:
            parts |= self._write(self._read(m["schema"], [m["parts"][edge]]).where(F.col(self.by).cast("timestamp_ntz") >= at), f"v{base + 1}")
        if parts == m["parts"]:
            return base
        return self._commit(base, m["schema"], parts, m["notes"])

    def vacuum(self, keep: int = 2) -> int:
        """Delete versions but the latest ``keep``, and all data folders that no kept version names. Returns how many folders went.

        Readers of deleted versions fail from then on; run it when no writer is under way.
        """
        have = self.versions()
        named = set()
        for v in have[-keep:]:
            m = self.manifest(v)
            named |= {*m["parts"].values(), *m["notes"].values()}
        for v in have[:-keep]:
            self._fs().delete(self._path(f"_versions/{v}"), False)
        gone, data, notes = 0, self._path("data"), self._path("notes")
        for s in self._fs().listStatus(notes) if self._fs().exists(notes) else ():
            if f"notes/{s.getPath().getName()}" not in named:
                self._fs().delete(s.getPath(), True)
        if not self._fs().exists(data):
            return 0
        for s in self._fs().listStatus(data):
            name = f"data/{s.getPath().getName()}"
            parts = [f"{name}/{p.getPath().getName()}" for p in self._fs().listStatus(s.getPath()) if p.isDirectory()]
            unused = [p for p in parts if p not in named]
            for p in unused:
                gone += bool(self._fs().delete(self._path(p), True))
            if len(unused) == len(parts):
                self._fs().delete(self._path(name), True)
        return gone

"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint sums the bits of the XXH64 of every word shingle of the whole text.
Two fingerprints at most r bits apart have a common variant within r/2 (rounded
up) bits of both. So each different fingerprint emits all variants within that
half radius; fingerprints that meet on a variant are linked, verified by their bit distance.
"""
from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from jobsift.llm.common import bounded_batches, numbered, shuffle_partitions, stored, text_bytes
from jobsift.llm.components import connected_components

SHINGLE_WORDS, RADIUS, SEED = 3, 2, 42


def fingerprint(text: bytes, n: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit fingerprint: a bit is set if over half of the shingle hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < n:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(n))))
    count = max(1, len(words) - n + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, count)
    set_in = np.zeros(64, np.int64)
    for at in range(0, count, 65536):        # bounded memory for very long texts
        bits = np.unpackbits(hashes[at:at + 65536].view(np.uint8)).reshape(-1, 64)
        set_in += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(set_in * 2 > count).view(np.int64)[0])


def with_fingerprints(docs: DataFrame, keys: list[str], text_col: str = "text", n: int = SHINGLE_WORDS) -> DataFrame:
    """(keys, fp) of every row; a text without words, or null, has fingerprint zero."""
    narrow = bounded_batches(docs).select(*keys, text_bytes(text_col).alias("__bytes"))
    schema = StructType([docs.schema[k] for k in keys] + [StructField("fp", LongType())])

    def run(batches):
        for b in batches:
            fp = [fingerprint(t.as_py(), n) for t in b.column("__bytes")]
            yield pa.RecordBatch.from_arrays([b.column(k) for k in keys] + [pa.array(fp, pa.int64())], names=[*keys, "fp"])

    return narrow.mapInArrow(run, schema)


def masks(half: int) -> list[int]:
    """All 64-bit patterns of at most ``half`` set bits, as signed numbers."""
    out = []
    for k in range(half + 1):
        for bits in combinations(range(64), k):
            m = sum(1 << b for b in bits)
            out.append(m - (1 << 64) if m >> 63 else m)
    return out


def fingerprint_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v) links of the different fingerprints ``fp``, at most ``radius`` bits apart, that connect all such pairs.

    With an even radius any two fingerprints that meet on a variant are within
    the radius of each other, so a bucket is linked as a star on its smallest
    member: its links grow with its members, not with their square, and no
    connection between different fingerprints is lost. With an odd radius the
    colliding pairs are verified one by one. Only different fingerprints take
    part, so a bucket has at most as many members as there are variants.
    """
    if radius < 1:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).where("false")
    half = (radius + 1) // 2
    # Each row becomes many, so few small partitions will not do; and by another key than the grouping
    # below, or the planner would keep the partitions that it has merged.
    fps = fps.repartition(shuffle_partitions(fps.sparkSession), F.xxhash64("fp"))
    near = fps.select("fp", F.explode(F.array(*[F.lit(m) for m in masks(half)])).alias("flip"))
    near = near.select(F.expr("fp ^ flip").alias("variant"), "fp", "flip")
    if radius == 2:
        # A bucket's members differ from its variant in at most one bit each, so the
        # union of these bits, with a flag for the variant itself, is the whole bucket.
        bucket = (near.groupBy("variant")
                  .agg(F.bit_or("flip").alias("flips"), F.max(F.col("flip") == 0).alias("centre"), F.count("*").alias("n"))
                  .where("n > 1"))
        one_bit = F.array(*[F.lit(m) for m in masks(1) if m])
        members = F.transform(F.filter(one_bit, lambda m: F.col("flips").bitwiseAND(m) != 0),
                              lambda m: F.col("variant").bitwiseXOR(m))
        members = F.when(F.col("centre"), F.concat(members, F.array("variant"))).otherwise(members)
        star = bucket.select(F.array_sort(members).alias("m"))
        pairs = star.select(F.col("m")[0].alias("u"), F.explode(F.slice("m", 2, 64)).alias("v"))
    else:
        a, b = near.select("variant", F.col("fp").alias("u")), near.select("variant", F.col("fp").alias("v"))
        pairs = a.join(b, "variant").where("u < v").select("u", "v")
    return pairs.where(F.bit_count(F.expr("u ^ v")) <= radius).distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE_WORDS,
                   radius: int = RADIUS, keys: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: keys, ``fp`` (long), ``fingerprint`` (16 hex digits), ``component_id``, ``root``.

    component_id is the smallest id reachable over links, own id included; root
    is the smallest fingerprint reachable. Equal fingerprints are linked. A null
    or empty text has fingerprint zero. Null ids keep their rows and count as no
    id (component_id null if no member has one); repeated rows are rows of one
    component; an empty table gives no rows; other columns are not read.
    """
    keys = keys or [id_col]
    docs = docs.select(*dict.fromkeys([id_col, *keys, text_col]))
    marked = stored(with_fingerprints(docs, list(dict.fromkeys([id_col, *keys])), text_col, n), "fingerprints")
    fps = marked.groupBy("fp").agg(F.min(id_col).alias("least_id"))
    roots = connected_components(fingerprint_links(fps.select("fp"), radius))
    rooted = (fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "least_id", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = stored(rooted.join(least, "root").select("fp", "root", "component_id"), "labels")
    return (marked.join(labels, "fp")
            .select(*dict.fromkeys([id_col, *keys]), "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id", "root"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE_WORDS,
                       radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay when each near-duplicate group keeps one.

    The row with the smallest id stays (null ids last, then the first stored row).
    All columns come through unchanged, whatever their names. ``docs`` is read
    once: decisions and rows meet by a row number that is stored with the rows.
    """
    key = "__llm_row"
    rows = numbered(docs, key)
    marked = simhash_groups(rows, id_col, text_col, n, radius, keys=[key])
    first = marked.groupBy("root").agg(F.min(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col), F.col(key))).alias("s"))
    kept = stored(first.select(F.col(f"s.{key}").alias(key)), "kept")
    # A shuffle of both sides at every size: the kept rows grow with the table, so they are never broadcast.
    return rows.join(kept.hint("merge"), key, "left_semi").drop(key)

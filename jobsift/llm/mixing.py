"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected copies, target / source size.
The whole part is taken at once; the fractional parts are rounded dependently:
two documents trade words (probability times size) until one of them is taken
or not, so a source's expected words stay exactly as they are. Blocks of a
source do this side by side and leave a bounded rest; rests meet in a reduction
tree, whose root settles the last fractions from the largest document down.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsift.llm.common import WORD, numbered, shuffle_partitions, stored
from jobsift.operators.scan import prefix_scan

WEIGHTS, MOST_COPIES = (5, 2, 1), 3
#: Documents of a block, undecided documents that a block leaves, and blocks that meet in a tree node.
BLOCK_ROWS, LEFT_ROWS, FAN_IN = 4096, 256, 32
#: Source tables up to this many rows are broadcast (their size is counted first).
BROADCAST_SOURCES = 10_000


def word_count(text_col: str):
    return F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, cap: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, n, weight, target) from rows (source, size).

    Sources are ranked by code point, null last, without bringing them into one
    task: a range partitioning, its partition counts, and ranks inside each.
    Targets share the total by weight; those above ``cap`` times their source's
    size stop there and the excess goes to the others, until none is above.
    """
    spark = sized.sparkSession
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    order = F.col("source").asc_nulls_last()
    ranged = stored(totals.repartitionByRange(min(64, shuffle_partitions(spark)), order).withColumn("part", F.spark_partition_id()), "sources")
    before, starts = 0, []
    for r in ranged.groupBy("part").count().orderBy("part").collect():      # at most 64 rows
        starts.append((r["part"], before))
        before += r["count"]
    offsets = spark.createDataFrame(starts, "part int, start long")
    rank = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1 + F.col("start")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    s = ranged.join(F.broadcast(offsets), "part").withColumn("weight", weight).drop("part", "start")
    s = stored(s.withColumn("most", F.col("source_size") * float(cap)), "weights")
    total, w = s.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(1.0))).head()
    level, stopped = total / w, -1
    while True:
        above = F.col("weight") * level > F.col("most")
        n, gone, rest = s.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0.0)),
                              F.sum(F.when(~above, F.col("weight")))).head()
        if n == stopped or not rest:
            break
        stopped, level = n, (total - gone) / rest
    return s.withColumn("target", F.least("most", F.col("weight") * level)).drop("most")


def _draw(seed: int, *keys: np.ndarray) -> np.ndarray:
    """Uniform numbers from hashes (splitmix64), so that reruns agree."""
    x = np.full(len(keys[0]), seed, np.uint64)
    with np.errstate(over="ignore"):
        for k in keys:
            x = (x ^ k.view(np.uint64)) + np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def pivot_pairs(size: np.ndarray, p: np.ndarray, u: np.ndarray, left: int) -> np.ndarray:
    """Pair documents, sorted by falling size, until at most ``left`` fractions (and one rest) remain.

    The open document and the next one trade words until one of them is 0 or 1;
    the other stays open. The drawn direction keeps every expectation. Those left
    are evenly spaced by rank, so documents of all sizes meet at the next node.
    """
    kept = set(np.linspace(0, len(p) - 1, left).astype(int).tolist()) if len(p) > left else set(range(len(p)))
    p, size_, u_ = p.tolist(), size.tolist(), u.tolist()
    order = [i for i in range(len(p)) if i not in kept]
    a = order[0] if order else 0
    for b in order[1:]:
        sa, sb, pa, pb = size_[a], size_[b], p[a], p[b]
        up, down = min((1 - pa) * sa, pb * sb), min(pa * sa, (1 - pb) * sb)
        if u_[b] * (up + down) < down:                       # a gains what b gives
            if (1 - pa) * sa <= pb * sb:
                p[a], p[b], a = 1.0, pb - up / sb, b
            else:
                p[a], p[b] = pa + up / sa, 0.0
        elif pa * sa <= (1 - pb) * sb:
            p[a], p[b], a = 0.0, pb + down / sb, b
        else:
            p[a], p[b] = pa - down / sa, 1.0
    return np.clip(np.asarray(p, np.float64), 0.0, 1.0)


def settle(size: np.ndarray, p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Whole decisions for the last fractions, sorted by falling size.

    Each document trades words with all smaller ones taken together, as one
    partner; each of these gives or takes in proportion to its distance from a
    whole decision, so every expectation stays. Where that is not enough for
    either outcome, they give all they can: the words come first there and the
    probability second.
    """
    p, size = p.copy(), size.astype(np.float64)
    for i in range(len(p)):
        rest_p, rest_s = p[i + 1:], size[i + 1:]
        up, down = (1 - p[i]) * size[i], p[i] * size[i]
        bend = np.minimum(rest_p, 1 - rest_p)
        able = float(bend @ rest_s)
        if max(up, down) <= able:
            take = u[i] < p[i]
            rest_p += bend * ((-up if take else down) / able if able else 0.0)
        else:
            have, room = float(rest_p @ rest_s), float((1 - rest_p) @ rest_s)
            take = u[i] < p[i] if up <= have and down <= room else up - have < down - room
            if take:
                rest_p *= 1 - min(1.0, up / have) if have else 1.0
            else:
                rest_p += (1 - rest_p) * (min(1.0, down / room) if room else 0.0)
        np.clip(rest_p, 0.0, 1.0, out=rest_p)
        p[i] = float(take)
    return np.round(p)


def _node(seed: int, left: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "__h"], ascending=[False, True], kind="stable")
        size, p, h = (pdf[c].to_numpy() for c in ("size", "p", "__h"))
        u = _draw(seed, h, np.full(len(h), int(pdf["level"].iloc[0]), np.int64))
        done = settle(size, p, u) if bool(pdf["last"].iloc[0]) else pivot_pairs(size, p, u, left)
        return pdf.assign(p=done)
    return run


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
        cap: int = MOST_COPIES, seed: int = 7, block_rows: int = BLOCK_ROWS, left: int = LEFT_ROWS,
        fan_in: int = FAN_IN, keys: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: keys, source, size, source_size, target, copies, taken (copies x size).

    Null sources form one source, ranked last. A null text has size 0; documents
    of size 0 take no words and keep the whole part of their rate as copies. A
    source of size 0 has target 0. Repeated rows are documents of their own; null
    ids are allowed; an empty table gives no rows; other columns are not read.
    Reruns agree: all draws are hashes of id, size and level. Rows equal in id and size are numbered, by text
    and then by the other keys; the number goes into their hash, so they have draws of their own and
    spread over the blocks even where one row is a third of the table.
    """
    keys = list(dict.fromkeys([id_col, *(keys or [])]))
    sized = docs.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(source_col).cast("string").alias("source"),
                        word_count(text_col).alias("size"), F.xxhash64(text_col).alias("__t"), F.lit(1).cast("long").alias("__one"))
    sized = prefix_scan(sized.withColumn("__h0", F.xxhash64(F.lit(seed), "k0", "size")), "__h0",
                        ["__t", *(f"k{i}" for i in range(1, len(keys)))], sums=("__one",))
    no = F.col("_sum___one")
    sized = sized.withColumn("__h", F.when(no == 1, F.col("__h0")).otherwise(F.xxhash64("__h0", no))).drop("__t", "__one", "__h0", "_pos", "_sum___one")
    targets = stored(source_targets(sized, weights, cap), "targets")
    n_sources, largest = targets.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).head()
    t = targets.select(F.col("source").alias("s"), "source_size", "target", "n")
    t = F.broadcast(t) if n_sources <= BROADCAST_SOURCES else t
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (sized.join(t, F.col("source").eqNullSafe(F.col("s"))).drop("s")
            .withColumn("whole", F.floor(rate).cast("int")).withColumn("p", rate - F.floor(rate))
            .withColumn("blocks", F.ceil(F.col("n") / block_rows)).withColumn("block", F.pmod(F.xxhash64("__h"), "blocks")))
    out, level, blocks = [], 0, -(-largest // block_rows)
    while True:
        rows = rows.withColumn("level", F.lit(level)).withColumn("last", F.col("blocks") <= 1)
        undecided = F.col("p").between(1e-12, 1 - 1e-12) & (F.col("size") > 0)
        out.append(rows.where(~undecided).withColumn("p", F.when(F.col("size") > 0, F.round("p")).otherwise(0.0)))
        open_rows = rows.where(undecided)
        rows = stored(open_rows.groupBy("source", "block").applyInPandas(_node(seed, left), open_rows.schema), f"mix{level}")
        if blocks <= 1:
            out.append(rows)
            break
        blocks, level = -(-blocks // fan_in), level + 1
        rows = (rows.withColumn("block", F.floor(F.col("block") / fan_in)).withColumn("blocks", F.ceil(F.col("blocks") / fan_in)))
    every = out[0]
    for o in out[1:]:
        every = every.union(o.select(every.columns))
    copies = (F.col("whole") + F.col("p")).cast("int")
    return every.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], F.col("source").alias("mix_source"),
                        "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns unchanged.

    Documents without words stay as they are. ``docs`` is read once: copies and
    rows meet by a row number that is stored with the rows.
    """
    key = "__llm_row"
    rows = numbered(docs, key)
    taken = mix(rows, id_col, text_col, source_col, keys=[key], **options).select(
        key, F.when(F.col("size") > 0, F.col("copies")).otherwise(1).alias("__llm_copies")).where("__llm_copies > 0")
    many = rows.join(taken, key).withColumn("__llm_copy", F.explode(F.sequence(F.lit(1), F.col("__llm_copies"))))
    return many.select(*docs.columns)

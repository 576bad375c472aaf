"""Embedding whitening with a weighted multiplicity covariance.

Equal vectors are grouped first, and each different vector is fitted with weight
one, or with its number of copies. Vectors are whole numbers, so their sums are
exact and a vector is centred without cancellation: n * x - S is exact, and only
then divided by n. The covariance is a sum of one matrix a task (a weighted
product of centred rows), added up in a tree; its eigenvectors are found on
the driver, which holds matrices of dimension times dimension only. Each different
vector is whitened once; the rows take their result by a join.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from jobsift.llm.common import join_groups, matrix, stored

#: Components asked for; tasks whose matrices one task of the next level adds up.
COMPONENTS, FAN_IN = 16, 32
#: An eigenvalue at or below this share of the largest one is noise of the arithmetic, not a direction of the data.
LEAST_SHARE = 1e-12
#: Entries stay below this, so that n * x and its sums stay exact for up to 2^31 vectors.
MOST_ENTRY = 1 << 31


@dataclass
class Whitening:
    """n: sum of weights; sums: weighted sums per dimension (exact); values, vectors: components by falling eigenvalue;
    trace: of the covariance; identity_error: largest absolute entry of the whitened covariance minus the identity."""
    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0


def _sum_matrices(partials: DataFrame, spark: SparkSession, most: int = FAN_IN) -> list[bytes]:
    """Partial matrices (``no long, cells binary``: float64) added up in a tree; at most ``most`` reach the driver."""
    count = partials.count()

    def add(batches):
        total = None
        for b in batches:
            for raw in b.column("cells").to_pylist():
                cells = np.frombuffer(raw, np.float64)
                total = cells.copy() if total is None else total + cells
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["no", "cells"])

    while count > most:
        count = -(-count // most)
        partials = stored(partials.repartition(count, "no").mapInArrow(add, "no long, cells binary")
                          .withColumn("no", F.monotonically_increasing_id()), "white-sums")
    return [r["cells"] for r in partials.collect()]


def _exact_sums(distinct: DataFrame, dim: int) -> tuple[int, np.ndarray]:
    """(sum of weights, weighted sum of each dimension) as whole numbers of any size."""
    def part(batches):
        n, sums = 0, [0] * dim
        for b in batches:
            if b.num_rows:
                x, w = _whole(b.column("x"), dim), np.asarray(b.column("weight"), np.int64)
                # 2^31 entries times weights can pass 2^63: high and low halves are summed apart.
                for name, half, unit in (("high", x >> 16, 1 << 16), ("low", x & 0xFFFF, 1)):
                    sums = [s + unit * int(v) for s, v in zip(sums, (half * w[:, None]).sum(0))]
                n += int(w.sum())
        yield pa.RecordBatch.from_arrays([pa.array([str(n)]), pa.array([[str(s) for s in sums]], pa.list_(pa.string()))], names=["n", "sums"])

    parts = distinct.select("x", "weight").mapInArrow(part, "n string, sums array<string>")
    cells = parts.select(F.posexplode(F.concat(F.array("n"), F.col("sums"))).alias("i", "v"))
    total = {r["i"]: int(r["v"]) for r in cells.groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()}   # dim + 1 rows
    return total.get(0, 0), np.array([total.get(i + 1, 0) for i in range(dim)], object)


def _whole(column, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.int64).reshape(len(column), dim)


def centred_times_n(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S exactly: as int64 where that is enough, else as Python integers."""
    top = max((abs(int(v)) for v in sums), default=0) + n * int(np.abs(x).max(initial=0))
    if top < 2 ** 62:
        return n * x - sums.astype(np.int64)[None, :]
    return n * x.astype(object) - sums[None, :]


def deviations(scaled: np.ndarray) -> list[int]:
    """Sum of squares of each row, exactly."""
    top = int(abs(scaled).max()) if scaled.size else 0
    if scaled.dtype != object and top * top * scaled.shape[1] < 2 ** 62:
        return (scaled * scaled).sum(1).tolist()
    return [sum(int(v) * int(v) for v in r) for r in scaled]


def components_of(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns), falling; at most ``most``, none that is only rounding noise."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(values, kind="stable")[::-1][:most]
    values, vectors = values[order], vectors[:, order]
    some = values > LEAST_SHARE * max(values.max(initial=0.0), 0.0)
    # One sign for all rows and reruns: the largest entry of a component is positive.
    sign = np.where(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0) if vectors.size else 1.0
    return values[some], (vectors * sign)[:, some]


def whole_vectors(df: DataFrame, vec_col: str, scale: float, offset: int) -> DataFrame:
    """``df`` with ``x``, the vector as whole numbers floor(scale * c) + offset, without rows that cannot take part.

    Left out: null or empty vectors, vectors holding null or non-finite entries, and
    vectors whose length is not the most frequent one (ties: the longer).
    """
    if not isinstance(df.schema[vec_col].dataType, ArrayType):
        raise TypeError(f"{vec_col} must be an array of numbers")
    c = F.col(vec_col).cast("array<double>")
    rows = (df.where(c.isNotNull() & (F.size(c) > 0)).where(F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))))
            .withColumn("x", c))
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    rows = rows.where(F.size("x") == (sizes["d"] if sizes else 0))
    top = F.lit(float(MOST_ENTRY))

    def whole(v: Column) -> Column:
        y = F.floor(F.least(F.greatest(v * scale, -top), top)) + F.lit(offset)
        return F.when(F.abs(y) < F.lit(MOST_ENTRY), y).otherwise(F.raise_error(F.lit(f"entry beyond {MOST_ENTRY} once scaled")))
    return rows.withColumn("x", F.transform("x", whole))


def fit(distinct: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening:
    """Mean and components of different vectors (x array<long>, weight long), all of length ``dim``."""
    spark = distinct.sparkSession
    n, sums = _exact_sums(distinct, dim)

    def gram(batches):
        total = np.zeros((dim, dim))
        for b in batches:
            if b.num_rows:
                centred = np.asarray(centred_times_n(_whole(b.column("x"), dim), n, sums) / n, np.float64)
                total += (centred * np.asarray(b.column("weight"), np.float64)[:, None]).T @ centred
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["no", "cells"])

    parts = stored(distinct.select("x", "weight").mapInArrow(gram, "no long, cells binary").withColumn("no", F.monotonically_increasing_id()), "white-gram")
    covariance = sum((np.frombuffer(c, np.float64) for c in _sum_matrices(parts, spark)), np.zeros(dim * dim)).reshape(dim, dim) / n
    values, vectors = components_of(covariance, components)
    return Whitening(n, sums, values, vectors, float(np.trace(covariance)))


def whiten_distinct(distinct: DataFrame, model: Whitening) -> DataFrame:
    """(x, copies, deviation decimal(38,0), white array<double>) of each different vector; stored."""
    dim, n, sums = len(model.sums), model.n, model.sums
    project = model.vectors / np.sqrt(model.values)[None, :]

    def run(batches):
        for b in batches:
            scaled = centred_times_n(_whole(b.column("x"), dim), n, sums)
            white = np.asarray(scaled / n, np.float64) @ project
            yield pa.RecordBatch.from_arrays([b.column("x"), b.column("copies"), pa.array([str(v) for v in deviations(scaled)], pa.string()),
                                              pa.array(list(white), pa.list_(pa.float64()))], names=["x", "copies", "deviation", "white"])

    out = distinct.select("x", "copies").mapInArrow(run, "x array<long>, copies long, deviation string, white array<double>")
    return stored(out.withColumn("deviation", F.col("deviation").cast("decimal(38,0)")), "white-distinct")


def identity_error(whitened: DataFrame, weights: Column, count: int) -> float:
    """Largest absolute entry of the covariance of ``white`` (weighted, centred, divisor sum of weights) minus the identity."""
    spark = whitened.sparkSession
    rows = whitened.select("white", weights.cast("long").alias("weight"))

    def product(batches):
        total = np.zeros((count + 1, count + 1))           # the last row and column hold sums and the weights' sum
        for b in batches:
            if b.num_rows:
                m = np.column_stack([matrix(b.column("white")), np.ones(b.num_rows)])
                total += (m * np.asarray(b.column("weight"), np.float64)[:, None]).T @ m
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["no", "cells"])

    parts = stored(rows.mapInArrow(product, "no long, cells binary").withColumn("no", F.monotonically_increasing_id()), "white-identity")
    total = sum((np.frombuffer(c, np.float64) for c in _sum_matrices(parts, spark)), np.zeros((count + 1) ** 2)).reshape(count + 1, count + 1)
    # White values already have a mean of about zero, so nothing cancels here.
    mean = total[-1, :-1] / total[-1, -1]
    return float(np.abs(total[:-1, :-1] / total[-1, -1] - np.outer(mean, mean) - np.eye(count)).max(initial=0.0))


def whiten(df: DataFrame, id_col: str, vec_col: str, components: int = COMPONENTS, scale: float = 64.0, offset: int = 1_000_000,
           weights: str = "one") -> tuple[DataFrame, Whitening | None]:
    """((id, x, copies, deviation decimal(38,0), white array<double>) of each row that takes part, the fitted model).

    A vector's entries become floor(scale * c) + offset. ``weights``: "one" fits each
    different vector once, "count" as often as it occurs. The id may be null or
    repeat: every row has its result. Rows left out are named in ``whole_vectors``;
    entries beyond 2^31 once scaled raise an error. Components whose eigenvalue is zero up to rounding
    are left out, so vectors that are all the same have none (white is empty). A table without vectors gives no rows
    and no model.
    """
    if weights not in ("one", "count"):
        raise ValueError("weights: one or count")
    rows = stored(whole_vectors(df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")), "vec", scale, offset).select("id", "x"), "white-rows")
    distinct = stored(rows.groupBy("x").agg(F.count("*").alias("copies"))
                      .withColumn("weight", F.lit(1).cast("long") if weights == "one" else F.col("copies")), "white-groups")
    head = distinct.select(F.size("x").alias("d")).head()
    if head is None:
        return rows.select("id", "x", F.lit(0).cast("long").alias("copies"), F.lit(0).cast("decimal(38,0)").alias("deviation"),
                           F.array().cast("array<double>").alias("white")), None
    model = fit(distinct, head["d"], components)
    done = whiten_distinct(distinct, model)
    model.identity_error = identity_error(done, F.lit(1) if weights == "one" else F.col("copies"), len(model.values))
    return join_groups(rows, done, "x", "copies"), model


def whitened_components(df: DataFrame, id_col: str, vec_col: str, components: int = COMPONENTS) -> DataFrame:
    """``whiten`` as one row a vector and component: id, component, n, deviation, whitened, explained, identity_error.

    deviation is a long here, and an error is raised if it passes 2^63.
    """
    rows, model = whiten(df, id_col, vec_col, components)
    spark = df.sparkSession
    if model is None:
        id_type = df.schema[id_col].dataType.simpleString()
        return spark.createDataFrame([], f"`{id_col}` {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values]).cast("array<double>")
    each = rows.select(F.col("id").alias(id_col), F.col("deviation").cast("long").alias("deviation"), F.posexplode("white").alias("_pos", "whitened"))
    return each.select(id_col, (F.col("_pos") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                       F.element_at(explained, F.col("_pos") + 1).alias("explained"), F.lit(model.identity_error).alias("identity_error"))

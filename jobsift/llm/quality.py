"""Document quality by hierarchical empirical Bayes.

A logistic classifier on whole-text statistics gives each document's evidence.
Soft counts of it, grouped by host and by path, give posteriors of a beta-binomial
hierarchy: a path is shrunk toward its host and a host toward the global mean, by
strengths estimated from the spread between sites. A document's own evidence then
meets the prior of its site, with its own count left out.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.llm.common import bounded_batches, stored

#: Most labelled documents that the classifier is fitted on.
TRAIN_ROWS = 20_000
RIDGE, STEPS = 1.0, 25
#: Site tables up to this many rows are broadcast (their size is counted first).
BROADCAST_SITES = 10_000
LEAST_QUALITY = 0.5

_SYMBOLS = re.compile(r"[#$%&*|<>{}\[\]\\^~=_@+]")
_MARKS = re.compile(r"[!?]")
_PUNCTUATION = re.compile(r"[.,;:]")
FEATURES = ("log_words", "word_length", "upper", "digits", "symbols", "marks", "punctuation", "distinct_words", "distinct_lines",
            "repeated_next", "lone_symbols", "long_words", "empty")


def statistics(text: str | None) -> list[float]:
    """The features of one whole text; shares lie between 0 and 1 and enter as logarithms too small to matter at 0."""
    words = (text or "").split()
    if not words:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    n, chars = len(words), sum(map(len, words))
    lines = [x for x in text.split("\n") if x.strip()]
    letters = "".join(words)
    upper = sum(map(str.isupper, words)) / n
    lower = [w.lower() for w in words]

    def share(x):
        return float(np.log(x + 0.003) - np.log(0.003))

    return [float(np.log(n)), min(chars / n, 40.0) / 10, share(upper), share(sum(map(letters.count, "0123456789")) / chars),
            share(len(_SYMBOLS.findall(letters)) / chars), share(len(_MARKS.findall(letters)) / chars),
            share(len(_PUNCTUATION.findall(letters)) / chars), len(set(lower)) / n ** 0.8, len(set(lines)) / max(1, len(lines)),
            share(sum(map(str.__eq__, lower, lower[1:])) / n), share(sum(len(w) == 1 and not w.isalnum() for w in words) / n),
            share(sum(len(w) > 30 for w in words) / n), 0.0]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights on (1, x) by Newton steps with a ridge penalty, from standardised features back to the given ones."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    a = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w, penalty = np.zeros(a.shape[1]), np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w -= np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + penalty, a.T @ (p - y) + penalty @ w)
    return np.concatenate([[w[0] - (w[1:] * mean / scale).sum()], w[1:] / scale])


def _strength(of: DataFrame, mean: str, total: str, n: str, noise: float) -> float:
    """Prior strength of a beta-binomial level by moments: how much its sites' means differ beyond chance.

    ``noise`` is the variance of one document around the mean of its site. Few or equal sites give a strong prior.
    """
    r = of.where(F.col(n) > 0).agg(
        F.sum(F.col(n) * F.pow(F.col(total) / F.col(n) - F.col(mean), 2)).alias("between"), F.sum(n).alias("all"),
        F.count("*").alias("sites"), F.sum(F.pow(F.col(n), 2)).alias("squares"), F.avg(F.col(mean) * (1 - F.col(mean))).alias("spread")).head()
    if not r["sites"] or r["sites"] < 2 or not r["all"]:
        return 1000.0
    room = r["all"] - r["squares"] / r["all"]
    variance = (r["between"] - (r["sites"] - 1) * noise) / room if room > 0 else 0.0
    return 1000.0 if variance <= 0 else float(np.clip(r["spread"] / variance - 1, 1.0, 1000.0))


def _logit(c):
    p = F.least(F.greatest(c, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def classify(docs: DataFrame, labels: DataFrame, host, path, id_col: str = "doc_id", text_col: str = "text",
             label_id: str = "doc_id", label_col: str = "quality", least: float = LEAST_QUALITY, train_rows: int = TRAIN_ROWS,
             keys: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, keys, host, path, evidence (log odds), site_prior, quality (0 to 1), keep.

    ``host`` and ``path`` are columns of ``docs`` or expressions; nulls form a
    site of their own. All documents enter the sites' counts; the classifier is
    fitted on at most ``train_rows`` labelled ones (labels other than 0 and 1 are
    ignored; a document labelled twice counts twice). Without both labels there is
    no evidence and every document is kept. A null or empty text is a text without
    words. Null and repeated ids keep their rows; an empty table gives no rows.
    """
    keys = list(dict.fromkeys([id_col, *(keys or [])]))

    def measure(batches):
        for b in batches:
            x = [statistics(t) for t in b.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in b.schema.names if c != "__text"] + [pa.array(x, pa.list_(pa.float64()))],
                                             names=[c for c in b.schema.names if c != "__text"] + ["x"])

    narrow = bounded_batches(docs).select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], host.cast("string").alias("host"),
                         path.cast("string").alias("path"), F.col(text_col).cast("string").alias("__text"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema if f.name != "__text")
    rows = stored(narrow.mapInArrow(measure, f"{fields}, x array<double>"), "statistics")

    marked = (labels.select(F.col(label_id).alias("k0"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1) and k0 is not null")
              .orderBy(F.xxhash64("k0"), "k0", "y").limit(train_rows))
    sample = rows.join(F.broadcast(marked), "k0").select("x", "y", "k0").orderBy(F.xxhash64("k0"), "k0").limit(train_rows).collect()
    y = np.array([r["y"] for r in sample], float)
    if len(set(y)) < 2:
        weights, base = np.zeros(len(FEATURES) + 1), 0.0
    else:
        weights, base = fit_logistic(np.array([r["x"] for r in sample]), y), float(np.log(y.mean() / (1 - y.mean())))
    odds = F.aggregate(F.zip_with("x", F.array(*[F.lit(float(w)) for w in weights[1:]]), lambda a, b: a * b), F.lit(float(weights[0])), lambda a, b: a + b)
    rows = (rows.withColumn("odds", F.least(F.greatest(odds, F.lit(-30.0)), F.lit(30.0))).drop("x")
            .withColumn("p", 1 / (1 + F.exp(-F.col("odds")))))

    sites = stored(rows.groupBy("host", "path").agg(F.sum("p").alias("path_sum"), F.count("*").alias("path_n"), F.sum(F.pow("p", 2)).alias("path_squares")), "paths")
    hosts = sites.groupBy("host").agg(F.sum("path_sum").alias("host_sum"), F.sum("path_n").alias("host_n"))
    total, n, within, n_sites = sites.agg(F.coalesce(F.sum("path_sum"), F.lit(0.0)), F.coalesce(F.sum("path_n"), F.lit(0)),
                                          F.coalesce(F.sum(F.col("path_squares") - F.pow("path_sum", 2) / F.col("path_n")), F.lit(0.0)), F.count("*")).head()
    mean = total / n if n else 0.5
    noise = within / max(1, n - n_sites)
    k_host = _strength(hosts.withColumn("m", F.lit(mean)), "m", "host_sum", "host_n", noise)
    both = sites.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).drop("h")
    k_path = _strength(both.withColumn("m", F.col("host_sum") / F.col("host_n")), "m", "path_sum", "path_n", noise)
    site = both.select(F.col("host").alias("h"), F.col("path").alias("q"), "host_sum", "host_n", "path_sum", "path_n")
    site = F.broadcast(site) if n_sites <= BROADCAST_SITES else site
    joined = rows.join(site, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q"))).drop("h", "q")
    host_prior = (F.lit(k_host * mean) + F.col("host_sum") - F.col("p")) / (F.lit(k_host) + F.col("host_n") - 1)
    prior = (F.lit(k_path) * host_prior + F.col("path_sum") - F.col("p")) / (F.lit(k_path) + F.col("path_n") - 1)
    evidence = F.col("odds") - F.lit(base)
    quality = 1 / (1 + F.exp(-(evidence + _logit(F.col("site_prior")))))
    return (joined.withColumn("site_prior", prior)
            .select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "host", "path", evidence.alias("evidence"), "site_prior",
                    quality.alias("quality"))
            .withColumn("keep", F.col("quality") >= F.lit(least) if len(set(y)) == 2 else F.lit(True)))

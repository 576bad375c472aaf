"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes one space, and n-grams of
one to three code points are hashed. Inverse document frequencies come from all
learnable documents. The weights are trained by follow the regularised leader
(FTRL-proximal) with an elastic-net penalty, which leaves most of them zero,
then one temperature is fitted on a part kept out of training.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsift.llm.common import bounded_batches, stored

#: Hash buckets of n-grams.
BUCKETS = 1 << 14
#: Most training documents of a language, and of all (those of the least hashes of id and text), and most languages
#: that are learned (the most frequent); the classifier's bounds.
TRAIN_ROWS_PER_LANGUAGE, TRAIN_ROWS, MOST_LANGUAGES = 800, 8000, 400
EPOCHS, ALPHA, BETA, L1, L2 = 2, 0.5, 1.0, 0.02, 0.01
UNDETERMINED = "und"
#: Code points counted at a time.
SLICE = 1 << 20


@lru_cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _hash(*parts: np.ndarray) -> np.ndarray:
    """A bucket for each row of code points."""
    h = np.full(len(parts[0]), len(parts) * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
    for p in parts:
        h = (h ^ p) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64)


def ngram_counts(text: str | None):
    """(buckets, counts) of a text's n-grams, or None if it has no letter."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]                                       # the first of each run of others, as a space
    c = np.concatenate([[32], np.where(letter, points, 32)[keep], [32]]).astype(np.uint64)
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(c) - 1, SLICE):
        p = c[at:at + SLICE + 2]
        last = at + SLICE + 2 >= len(c)
        one, two = (p, p[:-1]) if last else (p[:-2], p[:-2])
        counts += np.bincount(_hash(one), minlength=BUCKETS)
        counts += np.bincount(_hash(two, p[1:1 + len(two)]), minlength=BUCKETS)
        counts += np.bincount(_hash(p[:-2], p[1:-1], p[2:]), minlength=BUCKETS)
        if last:
            break
    used = np.flatnonzero(counts)
    return used, counts[used]


def tf_idf(used: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[used]
    return x / max(float(np.sqrt(x @ x)), 1e-12)


def document_frequencies(texts: DataFrame, text_col: str) -> tuple[int, np.ndarray]:
    """(documents with letters, documents of each bucket), summed in a tree over the tasks' vectors."""
    def count(batches):
        n, df = 0, np.zeros(BUCKETS, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                found = ngram_counts(t)
                if found:
                    n += 1
                    df[found[0]] += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([df.tobytes()], pa.binary())], names=["n", "df"])

    def add(pdf):
        total = sum((np.frombuffer(x, np.int64) for x in pdf["df"]), np.zeros(BUCKETS, np.int64))
        return pdf.iloc[:1].assign(n=int(pdf["n"].sum()), df=[total.tobytes()])

    parts = stored(texts.select(text_col).mapInArrow(count, "n long, df binary")
                   .withColumn("task", F.spark_partition_id()), "frequencies")
    tasks = parts.agg(F.coalesce(F.max("task"), F.lit(-1))).head()[0] + 1
    while tasks > 32:
        parts = (parts.withColumn("task", F.floor(F.col("task") / 32).cast("int"))
                 .groupBy("task").applyInPandas(add, "n long, df binary, task int"))
        tasks = -(-tasks // 32)
    rows = parts.collect()                                        # at most 32 rows of one vector each
    return sum(r["n"] for r in rows), sum((np.frombuffer(r["df"], np.int64) for r in rows), np.zeros(BUCKETS, np.int64))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        found = ngram_counts(text) if self.languages else None
        if found is None:
            return UNDETERMINED, 0.0
        p = softmax(tf_idf(*found, self.idf) @ self.weights[found[0]] / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_ftrl(samples, languages: int, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1,
               l2: float = L2, seed: int = 5) -> np.ndarray:
    """FTRL-proximal over (buckets, values, language) samples: weights (buckets x languages)."""
    z, n = np.zeros((BUCKETS, languages)), np.zeros((BUCKETS, languages))

    def weights(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    for epoch in range(epochs):
        for i in np.random.default_rng(seed + epoch).permutation(len(samples)):
            used, x, y = samples[i]
            zi, ni = z[used], n[used]
            w = weights(zi, ni)
            error = softmax(x @ w)
            error[y] -= 1
            g = x[:, None] * error[None, :]
            grown = ni + g * g
            z[used] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / alpha * w
            n[used] = grown
    return weights(z, n)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    if not len(y):
        return 1.0

    def loss(t):
        return -np.log(softmax(logits / np.exp(t))[np.arange(len(y)), y] + 1e-300).mean()

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(50):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def learnable(docs: DataFrame, id_col: str, lang_col: str) -> DataFrame:
    return docs.where((F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) != 2) & F.col(lang_col).isNotNull())


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows_per_language: int = TRAIN_ROWS_PER_LANGUAGE, train_rows: int = TRAIN_ROWS, most_languages: int = MOST_LANGUAGES) -> Model:
    """A model from the documents whose crc32 of the id leaves 0, 1 or 3 modulo 4 and whose language is known.

    Frequencies are counted over all of them. The classifier is fitted on at most
    ``rows_per_language`` of each language and ``train_rows`` in all, of which a fifth only sets
    the temperature: the different (id, text) pairs with the least hashes, so copies of a row count once
    and none of these bounds can be passed. Languages beyond the ``most_languages`` most frequent ones
    are not learned. Without any such document the model knows no language.
    """
    learn = learnable(bounded_batches(docs), id_col, lang_col)
    most_languages = min(most_languages, train_rows)
    sizes = learn.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(most_languages).collect()
    languages = sorted(r[lang_col] for r in sizes)
    if not languages:
        return Model([], np.ones(BUCKETS), np.zeros((BUCKETS, 0)), 1.0)
    n, df = document_frequencies(learn, text_col)
    idf = np.log((1 + n) / (1 + df)) + 1
    most = min(rows_per_language, train_rows // len(languages))
    mark = F.xxhash64(F.lit(18), id_col, text_col)
    marks = stored(learn.select(F.col(lang_col).alias("l"), mark.alias("d")).where(F.col("l").isin(languages)).distinct(), "lang-marks")
    # Hashes are spread evenly, so about twice the wanted number lies below a share of their range; only those are ranked.
    different = {r["l"]: r["count"] for r in marks.groupBy("l").count().collect()}                     # one row a language
    share = F.element_at(F.create_map(*[F.lit(x) for k in languages for x in (k, 2.0 * most / different[k] + 1e-6)]), F.col("l"))
    low = marks.where(F.col("d").cast("double") / 2.0 ** 64 + 0.5 <= share)
    ranked = low.withColumn("rank", F.row_number().over(Window.partitionBy("l").orderBy("d"))).where(F.col("rank") <= most)
    limit = {r["l"]: r["d"] for r in ranked.groupBy("l").agg(F.max("d").alias("d")).collect()}        # one row a language
    bound = F.element_at(F.create_map(*[F.lit(x) for k in languages for x in (k, limit.get(k, -(1 << 63)))]), F.col(lang_col))
    texts = (learn.where(F.col(lang_col).isin(languages) & (mark <= bound)).groupBy(F.col(lang_col).alias("l"), mark.alias("d"))
             .agg(F.first(F.col(text_col).cast("string")).alias("t")))

    def features(batches):
        for b in batches:
            found = [ngram_counts(t) for t in b.column("t").to_pylist()]
            some = [i for i, f in enumerate(found) if f]
            yield pa.RecordBatch.from_arrays([
                pa.array([found[i][0].astype("<u2").tobytes() for i in some], pa.binary()),
                pa.array([tf_idf(*found[i], idf).astype("<f4").tobytes() for i in some], pa.binary()),
                b.column("l").take(pa.array(some, pa.int64())), b.column("d").take(pa.array(some, pa.int64()))], names=["used", "x", "l", "d"])

    drawn = texts.select("t", "l", "d").mapInArrow(features, "used binary, x binary, l string, d long").collect()     # at most train_rows
    number = {k: i for i, k in enumerate(languages)}
    samples = [(np.frombuffer(r["used"], "<u2").astype(np.int64), np.frombuffer(r["x"], "<f4").astype(np.float64), number[r["l"]], r["d"])
               for r in sorted(drawn, key=lambda r: (r["d"], r["l"]))]
    training = [s[:3] for s in samples if s[3] % 5] or [s[:3] for s in samples]
    weights = train_ftrl(training, len(languages))
    held = [s for s in samples if s[3] % 5 == 0]
    logits = np.array([x @ weights[u] for u, x, _, _ in held]).reshape(len(held), len(languages))
    return Model(languages, idf, weights, fit_temperature(logits, np.array([s[2] for s in held], int)))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keys: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, keys, held_out, lang_pred, score, from the text alone.

    A null text, or one without letters, is `und` with score 0, and so is every
    text if no language was learned. A null id is not held out. Repeated rows get
    equal answers; an empty table gives no rows; other columns are not read.
    """
    keys = list(dict.fromkeys([id_col, *(keys or [])]))
    shared = docs.sparkSession.sparkContext.broadcast(model)      # BUCKETS x languages numbers

    def run(batches):
        m = shared.value
        for b in batches:
            found = [m.predict(t) for t in b.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(f"k{i}") for i in range(len(keys))), pa.array([f[0] for f in found], pa.string()),
                                              pa.array([f[1] for f in found], pa.float64())], names=[*(f"k{i}" for i in range(len(keys))), "p", "s"])

    fields = ", ".join(f"k{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
    out = bounded_batches(docs).select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(text_col).cast("string").alias("__text")).mapInArrow(
        run, f"{fields}, p string, s double")
    held = F.coalesce(F.pmod(F.crc32(F.col("k0").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], held.alias("held_out"), F.col("p").alias("lang_pred"), F.col("s").alias("score"))


def keep_identified(docs: DataFrame, model: Model, least_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose language is determined with at least ``least_score``.

    A model without languages (none was known to learn from) rejects only texts
    without letters. ``rejected_by_language`` counts what goes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    hidden = "__llm_text"
    rows = bounded_batches(docs).withColumn(hidden, F.col(text_col).cast("string"))

    def run(batches):
        m = shared.value
        for b in batches:
            found = [m.predict(t) for t in b.column(hidden).to_pylist()]
            if m.languages:
                keep = pa.array([p != UNDETERMINED and s >= least_score for p, s in found], pa.bool_())
            else:
                keep = pa.array([ngram_counts(t) is not None for t in b.column(hidden).to_pylist()], pa.bool_())
            yield b.drop_columns([hidden]).filter(keep)

    return rows.mapInArrow(run, docs.schema)


def rejected_by_language(docs: DataFrame, model: Model, least_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(lang_pred, documents, rejected): what ``keep_identified`` drops of each predicted language, and of ``und``."""
    told = identify(docs, model, id_col, text_col)
    gone = F.col("score") < least_score
    return told.groupBy("lang_pred").agg(F.count("*").alias("documents"), F.sum(gone.cast("long")).alias("rejected"))

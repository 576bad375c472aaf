"""The queries of this subpackage: each applies one operator to its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobsift.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op2_simhash_dedup(spark, sf_dir):
    from jobsift.llm.simhash import simhash_groups
    return simhash_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@_query
def op4_binary_packing(spark, sf_dir):
    from jobsift.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"), with_ids=False)


@_query
def op3_source_mixing(spark, sf_dir):
    from jobsift.llm.mixing import mix
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


@_query
def op1_rp_forest(spark, sf_dir):
    from pyspark.sql import functions as F

    from jobsift.llm.ann import ann_search
    return ann_search(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 100 == 0)


@_query
def op9_mtree_topk(spark, sf_dir):
    from pyspark.sql import functions as F

    from jobsift.llm.mtree import topk_inner_product
    return topk_inner_product(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 50 == 0)


SQL["op9_mtree_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""


@_query
def op6_secret_automaton(spark, sf_dir):
    from jobsift.llm import secrets
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *secrets.digest(found))


@_query
def op7_cover_anchor_dedup(spark, sf_dir):
    from jobsift.llm.substring import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


@_query
def op5_ftrl_langid(spark, sf_dir):
    from jobsift.llm import langid
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


@_query
def op10_bayes_quality(spark, sf_dir):
    """The documents that stay; a document's host is its source, its path the language section there."""
    from pyspark.sql import functions as F

    from jobsift.llm.quality import classify
    scored = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))
    return scored.where("keep").select("doc_id", "host", "path", "evidence", "site_prior", "quality")


@_query
def op8_boosted_pii(spark, sf_dir):
    from jobsift.llm import pii
    return pii.find_personal_data(table(spark, sf_dir, "documents")).select("doc_id", *pii.digest())


@_query
def op11_conversation_repair(spark, sf_dir):
    from jobsift.llm.conversations import repair_report
    return repair_report(table(spark, sf_dir, "conversations"))


@_query
def op12_whitening(spark, sf_dir):
    from jobsift.llm.whitening import whitened_components
    return whitened_components(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


@_query
def op13_warc(spark, sf_dir):
    from jobsift.llm.warc import archived_pages
    return archived_pages(table(spark, sf_dir, "pages"))

"""Field extraction from a stored table of raw web pages (one row per page).

Pages are dealt out evenly over the shuffle partitions and parsed there, in Arrow
batches: a file of few row groups is read by as few tasks, and parsing takes far longer
than moving a page. No page is collected.
"""
from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.functions.htmltree import Page, hrefs

# FIXED VALUES: page markers of the job board's detail pages
COMPANY_LINK_FRAGMENT = "/organization/"
LISTING_LINK_FRAGMENT = "/fr/job/"
LOCATION_FALLBACK = r"\d{5}.*France"
CONTRACT_WORDS = ["CDI", "CDD", "Freelance", "Stage", "Alternance", "Intérim"]
CONTRACT_PARENTS = ("span", "div", "li", "p", "a")
SALARY_HINT = r"\d+\s*[kK€]"
MIN_BLOCK_CHARS, EXCLUDED_BLOCK = 30, "cookie"
REFERENCE_BLOCKS = 50

_ORIGIN = re.compile(r"[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*")
_LOCATION, _SALARY = re.compile(LOCATION_FALLBACK), re.compile(SALARY_HINT)
_CONTRACT = re.compile(rf"\b(?:{'|'.join(CONTRACT_WORDS)})\b", re.I)


def _per_page(pages: DataFrame, cols: dict[str, str], row, schema: str) -> DataFrame:
    """``row(html, url)`` of each page as columns beside the id."""
    narrow = pages.select(F.col(cols["id"]).alias("__id"), *([F.col(cols["url"]).alias("__url")] if "url" in cols else [F.lit(None).cast("string").alias("__url")]),
                          F.col(cols["html"]).cast("string").alias("__html"))
    names = [c.strip().split(" ")[0] for c in re.split(r",\s*(?![^<]*>)", schema)]

    def run(batches):
        for b in batches:
            found = [row(h, u or "") for h, u in zip(b.column("__html").to_pylist(), b.column("__url").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("__id"), *(pa.array([f[i] for f in found], _TYPES[t]) for i, t in enumerate(types))], names=["__id", *names])

    types = [c.strip().split(" ")[1] for c in re.split(r",\s*(?![^<]*>)", schema)]
    spark = pages.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    out = narrow.repartition(parts).mapInArrow(run, f"__id {pages.schema[cols['id']].dataType.simpleString()}, {schema}")
    return out.withColumnRenamed("__id", cols["id"])


_TYPES = {"string": pa.string(), "int": pa.int32(), "array<string>": pa.list_(pa.string())}


def _links(html: str | None, url: str, fragment: str) -> list[str]:
    origin = _ORIGIN.match(url)
    base = origin[0] if origin else ""
    return list(dict.fromkeys(h if h.startswith("http") else base + h for h in hrefs(html) if h and fragment in h))


def body_text(blocks: list[str], max_blocks: int | None) -> str:
    keep = [t for t in blocks if len(t) > MIN_BLOCK_CHARS and EXCLUDED_BLOCK not in t.lower()]
    return "\n".join(keep[:max_blocks])


def extract_links(pages: DataFrame, fragment: str = LISTING_LINK_FRAGMENT, html: str = "html", url: str = "url",
                  id_col: str = "page_id") -> DataFrame:
    """(page, position, link): hrefs containing ``fragment``, made absolute against the
    page's origin, first occurrence kept, in page order."""
    out = _per_page(pages, {"id": id_col, "url": url, "html": html}, lambda h, u: (_links(h, u, fragment),), "links array<string>")
    return out.select(id_col, F.posexplode("links").alias("position", "link"))


def extract_page_fields(pages: DataFrame, html: str = "html", url: str = "url", id_col: str = "page_id",
                        max_blocks: int | None = None) -> DataFrame:
    """title (first h1), company (organisation link), location (text around its icon,
    else the first 'NNNNN ... France' text), remote (text around its icon), contract
    (first text with a contract word directly in a span, div, li, p or a), salary
    (first salary-like text), url and description (body text). Missing fields are ''."""
    def fields(source: str | None, link: str):
        page = Page(source)
        heading, company = next(page.elements("h1"), None), page.links(COMPANY_LINK_FRAGMENT)
        return ("" if heading is None else page.text(heading), page.text(company[0][0]) if company else "",
                page.beside_image("location") or page.first_text_like(_LOCATION), page.beside_image("remote"),
                page.first_text_like(_CONTRACT, CONTRACT_PARENTS), page.first_text_like(_SALARY), body_text(page.blocks(), max_blocks), link)

    out = _per_page(pages, {"id": id_col, "url": url, "html": html}, fields,
                    "title string, company string, location string, remote string, contract_type string, salary string, description string, link string")
    return out.select(id_col, "title", "company", "location", "remote", "contract_type", "salary", F.col("link").alias(url), "description")


def extract_body_text(pages: DataFrame, html: str = "html", id_col: str = "page_id", max_blocks: int | None = None) -> DataFrame:
    """(page, description, n_long_blocks): the body text and how many blocks are long."""
    def body(source: str | None, _):
        blocks = Page(source).blocks()
        return body_text(blocks, max_blocks), sum(len(t) > MIN_BLOCK_CHARS for t in blocks)

    return _per_page(pages, {"id": id_col, "html": html}, body, "description string, n_long_blocks int")

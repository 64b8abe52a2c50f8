"""Fetched content as tables: sitemaps, release notes, changelogs, URL lists, HTML and PDF (S-6 to S-18).

Fetching stays outside the engine: the inputs are tables of responses. Everything but decompression and PDF text is
evaluated in the JVM."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import content_hash, main_text, page_title, strip
from ..functions.urls import normalize_url

PER_FILE = 300


@F.pandas_udf(T.StringType())
def _unpacked(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    def text(b) -> str:
        if b is None:
            return ""
        raw = bytes(b)
        try:
            return (gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw).decode("utf-8", "replace")
        except (OSError, EOFError):
            return ""

    for s in parts:
        yield s.map(text)


def decompress(content: Column) -> Column:
    """Text of bytes that may be gzip-compressed; '' if they cannot be read."""
    return _unpacked(content)


def _usable(xml: Column, root: str) -> Column:
    """The XML if it has the wanted root element, else null, so that anything else gives no rows."""
    return F.when(xml.rlike(rf"(?s)\A\s*(<\?xml.*?\?>)?\s*(<!--.*?-->\s*)*<([A-Za-z0-9]+:)?{root}[\s>]"), xml)


def sitemap_urls(files: DataFrame, xml: str = "xml", limit: int = PER_FILE) -> DataFrame:
    """S-6: (file columns, pos, loc, lastmod) of urlset files, at most `limit` entries a file in document order; locs
    are stripped, empty ones dropped; a file that is not a readable urlset gives no rows."""
    kept = [c for c in files.columns if c != xml]
    parsed = F.from_xml(_usable(F.col(xml), "urlset"), F.lit("url array<struct<loc:string,lastmod:string>>"), {"mode": "PERMISSIVE"})
    rows = files.select(*kept, F.posexplode(F.slice(parsed["url"], 1, limit)).alias("pos", "u"))
    return rows.select(*kept, "pos", strip(F.col("u.loc")).alias("loc"), F.nullif(strip(F.col("u.lastmod")), F.lit("")).alias("lastmod")).filter("loc <> ''")


def sitemap_children(files: DataFrame, xml: str = "xml") -> DataFrame:
    """S-7: (file columns, pos, child) of sitemap index files; other files give no rows."""
    kept = [c for c in files.columns if c != xml]
    parsed = F.from_xml(_usable(F.col(xml), "sitemapindex"), F.lit("sitemap array<struct<loc:string>>"), {"mode": "PERMISSIVE"})
    return files.select(*kept, F.posexplode(parsed["sitemap"]).alias("pos", "s")).select(*kept, "pos", strip(F.col("s.loc")).alias("child")).filter("child <> ''")


def walk_index(files: DataFrame, start_child: int = 0, limit: int = PER_FILE) -> DataFrame:
    """S-8: from (source_id, url, parent, xml), the pages of a source's child files, starting with child `start_child`
    and going round, cut after `limit` rows a source."""
    kids = sitemap_children(files.filter("parent IS NULL").select("source_id", "xml")).withColumn("n", F.count(F.lit(1)).over(W.partitionBy("source_id")))
    kids = kids.select("source_id", F.col("child").alias("url"), F.pmod(F.col("pos") - start_child, F.col("n")).alias("turn"))
    pages = sitemap_urls(files.select("source_id", "url", "xml")).join(kids, ["source_id", "url"])
    ranked = pages.withColumn("at", F.row_number().over(W.partitionBy("source_id").orderBy("turn", "pos")))
    return ranked.filter(F.col("at") <= limit).select("source_id", "at", "loc", "lastmod")


def seed_urls(registry: DataFrame) -> DataFrame:
    """S-11, F-26: (source_id, pos, url): seed_urls may be a JSON list or a comma-separated text; blank entries drop."""
    raw = strip(F.col("seed_urls"))
    listed = F.when(raw.startswith("["), F.from_json(raw, "array<string>"))
    urls = F.coalesce(listed, F.split(raw, ","))
    rows = registry.select("source_id", F.posexplode(urls).alias("pos", "u"))
    return rows.select("source_id", "pos", strip(F.col("u")).alias("url")).filter("url <> ''")


def url_list(registry: DataFrame, cap: int = 60) -> DataFrame:
    """S-11: the first `cap` distinct normalised seed URLs of each url_list source, in order; the denylist is not applied."""
    rows = seed_urls(registry.filter("adapter_type = 'url_list'")).withColumn("url", normalize_url(F.col("url")))
    first = rows.groupBy("source_id", "url").agg(F.min("pos").alias("pos"))
    return first.withColumn("at", F.row_number().over(W.partitionBy("source_id").orderBy("pos"))).filter(F.col("at") <= cap).select("source_id", "at", "url")


def latest_release(responses: DataFrame) -> DataFrame:
    """S-9: from (source_id, root_url, status, body), the page a release answer stands for: (source_id, url, marker,
    title, text). Anything but a readable 200 answer with a tag gives no row."""
    j = F.from_json("body", "tag_name string, name string, body string, html_url string")
    r = responses.filter("status = 200").select("source_id", "root_url", j.alias("j")).filter("j.tag_name <> ''")
    title = F.coalesce(F.nullif(F.col("j.name"), F.lit("")), F.col("j.tag_name"))
    return r.select(
        "source_id", F.coalesce(F.nullif(F.col("j.html_url"), F.lit("")), "root_url").alias("url"), F.col("j.tag_name").alias("marker"),
        title.alias("title"), F.concat(title, F.lit("\n\n"), F.coalesce("j.body", F.lit(""))).alias("text"),
    )


def changelog(responses: DataFrame) -> DataFrame:
    """S-10: from (source_id, root_url, status, body), the page as it stands, its URL not normalised."""
    return responses.filter("status = 200").select("source_id", F.col("root_url").alias("url"), page_title(F.col("body")).alias("title"), main_text(F.col("body")).alias("text"), content_hash(main_text(F.col("body"))).alias("content_hash"))


def adapter(adapter_type: Column) -> Column:
    """S-13: which adapter handles a source; unknown kinds and null are sitemaps."""
    return F.when(adapter_type.isin("sitemap", "url_list", "github_release", "changelog"), adapter_type).otherwise("sitemap")


def content_kind(content_type: Column, url: Column) -> Column:
    """S-18: 'pdf' by content type or path, else 'html'."""
    path = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"\A[^?#]*", 0))
    return F.when(F.lower(F.coalesce(content_type, F.lit(""))).contains("pdf") | path.endswith(".pdf"), "pdf").otherwise("html")


def response_text(responses: DataFrame, pdf_text: Column | None = None) -> DataFrame:
    """S-16 to S-18: adds title and text to (url, content_type, body). The text of a PDF is the given column (from
    `pdf_pages`, for instance) or '', its title the file name."""
    kind = content_kind(F.col("content_type"), F.col("url"))
    name = F.regexp_extract("url", r"([^/?#]*)(?:[?#].*)?\z", 1)
    return responses.withColumns({
        "title": F.when(kind == "pdf", name).otherwise(page_title(F.col("body"))),
        "text": F.when(kind == "pdf", F.coalesce(pdf_text, F.lit("")) if pdf_text is not None else F.lit("")).otherwise(main_text(F.col("body"))),
    })


def pdf_pages(pages: int = 40, chars: int = 60_000):
    """S-17: a pandas UDF from PDF bytes to the text of the first pages, or '' where no PDF reader is installed."""

    def read(b) -> str:
        try:
            import io

            from pypdf import PdfReader

            out, n = [], 0
            for page in PdfReader(io.BytesIO(bytes(b))).pages[:pages]:
                out.append(page.extract_text() or "")
                n += len(out[-1])
                if n > chars:
                    break
            return "\n".join(out)
        except Exception:  # noqa: BLE001 - an unreadable file has no text
            return ""

    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda b: read(b) if b is not None else "")

    return run


def targets(registry: DataFrame, walked: DataFrame, cap: int = 60) -> DataFrame:
    """S-13: what each enabled source's adapter looks at: (source_id, adapter, at, url). Sitemap sources give the pages of
    their walk (source_id, turn, loc, action) that are to be fetched, retries first; lists their seeds; releases and
    changelogs, and sources of unknown kinds without a walk, their root."""
    r = registry.filter("enabled").withColumn("adapter", adapter(F.col("adapter_type")))
    pages = walked.filter("action IN ('probe', 'retry')").join(r.filter("adapter = 'sitemap'").select("source_id", "adapter"), "source_id")
    pages = pages.withColumn("at", F.row_number().over(W.partitionBy("source_id").orderBy("turn", "loc"))).select("source_id", "adapter", "at", F.col("loc").alias("url"))
    listed = url_list(r, cap).select("source_id", F.lit("url_list").alias("adapter"), "at", "url")
    roots = r.filter(F.col("adapter").isin("github_release", "changelog") & F.col("root_url").isNotNull()).select("source_id", "adapter", F.lit(1).alias("at"), F.col("root_url").alias("url"))
    return pages.unionByName(listed).unionByName(roots)


def fill_text(changes: DataFrame, responses: DataFrame) -> DataFrame:
    """S-15: the text of changes that carry none, from responses (url, status, body) fetched on demand: the main text of a
    200 answer, else ''. Of several answers for a URL the smallest body counts."""
    got = responses.filter("url IS NOT NULL AND status = 200").groupBy("url").agg(F.min("body").alias("_body"))
    j = changes.join(got, "url", "left")
    return j.withColumn("text", F.when(F.coalesce("text", F.lit("")) != "", F.col("text")).otherwise(main_text(F.col("_body")))).drop("_body")

"""The document index: logical documents from files, a tree as path prefixes, pages, sitemaps and page texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarazu.functions.jsonx import omit_empty
from tarazu.functions.text import escape_html, escape_script_json, html_relpath, node_filename, summary
from tarazu.operators.ranking import pages

SITEMAP_URLS = 50_000


def documents_of_files(files: DataFrame, keys: list[str]) -> DataFrame:
    """keys, links, n_files: the files of a key as one document, PDFs first, then by name. files: keys, name."""
    other = F.when(F.lower("name").endswith(".pdf"), 0).otherwise(1)
    links = F.transform(F.sort_array(F.collect_set(F.struct(other.alias("o"), F.col("name")))), lambda x: x["name"])
    return files.groupBy(*keys).agg(links.alias("links")).withColumn("n_files", F.size("links"))


def prefixes(path: Column) -> Column:
    """a/b/c as [a, a/b, a/b/c]."""
    parts = F.split(path, "/")
    return F.transform(parts, lambda x, i: F.array_join(F.slice(parts, F.lit(1), i + 1), "/"))


def tree_counts(docs: DataFrame, path: str) -> DataFrame:
    """node, depth, n_docs: every node of the tree with the documents below it."""
    return docs.select(F.explode(prefixes(F.col(path))).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_docs")).withColumn("depth", F.size(F.split("node", "/")))


def page_files(docs: DataFrame, base_url: str) -> DataFrame:
    """path, content: an HTML page for each document (document_id, title, url, source)."""
    ld = F.to_json(F.struct(F.lit("https://schema.org").alias("@context"), F.lit("DigitalDocument").alias("@type"), F.col("title").alias("name"), F.col("url").alias("url")))
    content = F.concat(
        F.lit("<!doctype html><html><head><meta charset=\"utf-8\"><title>"), escape_html("title"), F.lit('</title><meta name="description" content="'), escape_html(summary("title")),
        F.lit(f'"><link rel="canonical" href="{base_url}/'), html_relpath("document_id"), F.lit('"><script type="application/ld+json">'), escape_script_json(ld),
        F.lit("</script></head><body><h1>"), escape_html("title"), F.lit('</h1><p><a href="'), escape_html("url"), F.lit('">'), escape_html("source"), F.lit("</a></p></body></html>"),
    )
    return docs.select(html_relpath("document_id").alias("path"), content.alias("content"))


def sitemap_files(docs: DataFrame, dataset: str, base_url: str, size: int = SITEMAP_URLS) -> DataFrame:
    """path, content: sitemaps of at most size URLs a dataset."""
    loc = F.concat(F.lit(f"  <url><loc>{base_url}/"), escape_html(html_relpath("document_id")), F.lit("</loc></url>"))
    paged = pages(docs.select(dataset, "document_id"), [dataset], ["document_id"], size)
    urls = paged.select(dataset, "page_no", "document_id", loc.alias("u")).groupBy(dataset, "page_no").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("document_id", "u"))), lambda x: x["u"]), "\n").alias("body"))
    head, tail = '<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n', "\n</urlset>\n"
    return urls.select(F.concat(F.lit("sitemap-"), F.col(dataset), F.lit("-"), F.col("page_no").cast("string"), F.lit(".xml")).alias("path"), F.concat(F.lit(head), F.col("body"), F.lit(tail)).alias("content"))


def publish_plan(local: DataFrame, remote: DataFrame, key: str, protected: list[str]) -> DataFrame:
    """key, action: upload what is local, delete what is only remote and under no protected prefix, keep the rest."""
    gone = remote.select(key).distinct().join(local.select(key), key, "left_anti")
    safe = F.lit(True)
    for p in protected:
        safe = safe & ~F.col(key).startswith(p)
    return local.select(key).distinct().withColumn("action", F.lit("upload")).unionByName(gone.withColumn("action", F.when(safe, "delete").otherwise("keep")))


def index_nodes(docs: DataFrame, path: str) -> DataFrame:
    """path, content: the index file of every inner node, with the names and counts of its children in order; next is always there, null without a further page."""
    counts = tree_counts(docs, path)
    parent = F.array_join(F.slice(F.split("node", "/"), F.lit(1), F.col("depth") - 1), "/")
    child = F.struct(F.element_at(F.split("node", "/"), -1).alias("name"), F.col("node").alias("path"), F.col("n_docs").alias("count"))
    nodes = counts.select(parent.alias("of"), child.alias("c")).groupBy("of").agg(F.sort_array(F.collect_list("c")).alias("children"))
    content = F.to_json(F.struct(F.col("of").alias("path"), F.col("children"), F.lit(None).cast("string").alias("next")), {"ignoreNullFields": "false"})
    return nodes.select(node_filename(F.col("of")).alias("path"), content.alias("content"))


def sitemap_index(sitemaps: DataFrame, base_url: str) -> DataFrame:
    """path, content: the one file that lists the sitemaps (path), in order of name."""
    loc = F.concat(F.lit(f"  <sitemap><loc>{base_url}/"), escape_html("path"), F.lit("</loc></sitemap>"))
    body = sitemaps.select("path", loc.alias("u")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("path", "u"))), lambda x: x["u"]), "\n").alias("b"))  # a line a 50,000 documents
    head, tail = '<?xml version="1.0" encoding="UTF-8"?>\n<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n', "\n</sitemapindex>\n"
    return body.select(F.lit("sitemap.xml").alias("path"), F.concat(F.lit(head), F.col("b"), F.lit(tail)).alias("content"))


def robots(base_url: str) -> str:
    return f"User-agent: *\nAllow: /\nSitemap: {base_url}/sitemap.xml\n"


def sidecar_files(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """path, content: metadata/<key>.json for each row, without its empty fields; rows without a key have none."""
    return rows.where(F.col(key).isNotNull()).select(F.concat(F.lit("metadata/"), F.col(key).cast("string"), F.lit(".json")).alias("path"), omit_empty(*columns).alias("content"))

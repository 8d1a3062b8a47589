"""JSON sidecars, link lists and maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarazu.functions.text import col

LINKS = T.ArrayType(T.StructType([T.StructField("link", T.StringType()), T.StructField("role", T.StringType())]))
SOURCES = T.ArrayType(T.StructType([T.StructField("document_id", T.StringType()), T.StructField("source_type", T.StringType()), T.StructField("links", LINKS)]))


def path_text(json: Column | str, path: str) -> Column:
    return F.get_json_object(col(json), path)


def filled_from(column: Column | str, json: Column | str, path: str) -> Column:
    """The column, or where it is null or blank what the sidecar says; a value is never overwritten."""
    return F.coalesce(F.nullif(F.trim(col(column)), F.lit("")), F.nullif(F.trim(path_text(json, path)), F.lit("")))


def as_map(json: Column | str) -> Column:
    return F.from_json(col(json), T.MapType(T.StringType(), T.StringType()))


def without_keys(json: Column | str, *keys: str) -> Column:
    """The object without some keys; '{}' stays for an object that had no others."""
    return F.to_json(F.map_filter(as_map(json), lambda k, v: ~k.isin(*keys)))


def merged(old: Column | str, new: Column | str) -> Column:
    """Shallow merge, the new value winning; null counts as empty, two nulls stay null."""
    a, b = as_map(F.coalesce(col(old), F.lit("{}"))), as_map(F.coalesce(col(new), F.lit("{}")))
    kept = F.map_filter(a, lambda k, v: ~F.map_contains_key(b, k))
    return F.when(col(old).isNull() & col(new).isNull(), None).otherwise(F.to_json(F.map_concat(kept, b)))


def pdf_first(links: Column) -> Column:
    """PDF links before others, both in their order."""
    is_pdf = lambda x: F.lower(x).endswith(".pdf")
    return F.concat(F.filter(links, is_pdf), F.filter(links, lambda x: ~is_pdf(x)))


def with_roles(links: Column) -> Column:
    """The first link is RAW, the others ALTERNATE."""
    return F.transform(links, lambda x, i: F.struct(x.alias("link"), F.when(i == 0, "RAW").otherwise("ALTERNATE").alias("role")))


def order_sources(court: Column | str, case_number: Column | str, urls: Column) -> Column:
    """The document record of a case's orders as JSON; null without links."""
    record = F.struct(F.concat_ws(":", F.lit("court-orders"), col(court), col(case_number)).alias("document_id"), F.lit("COURT_ORDER").alias("source_type"), with_roles(pdf_first(urls)).alias("links"))
    return F.when(F.size(urls) > 0, F.to_json(F.array(record)))


def primary_url(sources: Column) -> Column:
    """The RAW link of the first document, else its first link."""
    links = F.try_element_at(sources, F.lit(1))["links"]
    raw = F.filter(links, lambda x: x["role"] == "RAW")
    return F.coalesce(F.try_element_at(raw, F.lit(1))["link"], F.try_element_at(links, F.lit(1))["link"])


def omit_empty(*columns: str) -> Column:
    """A row as JSON without what is null, blank or an empty list."""
    return F.to_json(F.struct(*[_filled(c) for c in columns]))


def _filled(c: str) -> Column:
    return F.when(F.length(F.trim(F.col(c).cast("string"))) > 0, F.when(F.col(c).cast("string") != "[]", F.col(c))).alias(c)


def pretty(row: Column) -> Column:
    """A struct as indented JSON, letters of all scripts as they are."""
    return F.to_json(row, {"pretty": "true", "ignoreNullFields": "false"})


def order_urls(paths: Column, base: str) -> Column:
    """The addresses of stored files: blank paths out, base before each."""
    return F.transform(F.filter(paths, lambda p: p.isNotNull() & (F.trim(p) != "")), lambda p: F.concat(F.lit(base.rstrip("/") + "/"), F.ltrim(p, F.lit("/"))))


def keys_dropped_where(json: Column | str, when: Column, *keys: str) -> Column:
    """The object without some keys where the condition holds; others stay as they are."""
    return F.when(F.coalesce(when, F.lit(False)), without_keys(json, *keys)).otherwise(col(json))

"""Feeds, sitemaps, JSON feeds and bibliographic records as tables.

A document is one row of text; what it can't give is an error row of the same table, so one
pass yields both outputs and a predicate parts them.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urljoin
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates

ATOM, RDF, DC = "{http://www.w3.org/2005/Atom}", "{http://purl.org/rss/1.0/}", "{http://purl.org/dc/elements/1.1/}"
#: Elements that may hold an entry's parts, in order of preference. Fixed values.
TITLE = ("title", f"{ATOM}title", f"{RDF}title")
SUMMARY = ("description", "summary", f"{ATOM}summary", f"{ATOM}content", "{http://purl.org/rss/1.0/modules/content/}encoded", f"{RDF}description")
PUBLISHED = ("pubDate", "published", f"{ATOM}published", f"{DC}date")
UPDATED = ("updated", f"{ATOM}updated")
LINK = ("link", f"{RDF}link")
ENTRY = "doc_url string, place int, error string, title string, link string, summary string, published_raw string, updated_raw string"


def _first(entry: ElementTree.Element, names: tuple[str, ...]) -> str:
    """The text of the first named child that has any."""
    for n in names:
        child = entry.find(n)
        if child is not None and (text := "".join(child.itertext()).strip()):
            return text
    return ""


def entry_link(entry: ElementTree.Element) -> str:
    """A link's text, else an alternate link's target, else the entry's own identifier."""
    if text := _first(entry, LINK):
        return text
    for a in entry.findall(f"{ATOM}link"):
        if a.get("rel", "") in ("", "alternate") and a.get("href"):
            return a.get("href", "").strip()
    return _first(entry, ("guid",))


def read_feed(url: str, text: str | None, limit: int) -> list[tuple]:
    """Rows of ``ENTRY`` for one document."""
    try:
        root = ElementTree.fromstring(text or "")
    except ElementTree.ParseError:
        return [(url, None, "not_xml", None, None, None, None, None)]
    if root.tag.rpartition("}")[2].lower() not in ("rss", "feed", "rdf"):
        return [(url, None, "not_a_feed", None, None, None, None, None)]
    entries = root.findall(".//item") or root.findall(f".//{ATOM}entry") or root.findall(f".//{RDF}item")
    out = []
    for k, e in enumerate(entries, 1):
        title, link = _first(e, TITLE), entry_link(e)
        error = "beyond_limit" if k > limit else "no_title_or_link" if not title or not link else None
        out.append((url, k, error, title, urljoin(url, link) if link else "", _first(e, SUMMARY), _first(e, PUBLISHED), _first(e, UPDATED)))
    return out


def parse_feeds(df: DataFrame, url: str, text: str, limit: int = 500) -> DataFrame:
    """``ENTRY`` rows of feed documents (RSS, Atom, RDF); ``error`` is null for what was read, else not_xml, not_a_feed, beyond_limit or no_title_or_link."""
    names = [p.split()[0] for p in ENTRY.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [r for u, t in zip(b["u"], b["t"], strict=True) for r in read_feed(u, t, limit)]
            out = pd.DataFrame(rows, columns=names)
            out["place"] = out["place"].astype("Int32")
            yield out

    return df.select(F.col(url).alias("u"), F.col(text).alias("t")).mapInPandas(run, ENTRY)


def sitemap_locations(df: DataFrame, url: str, text: str) -> DataFrame:
    """doc_url, loc, is_index of a sitemap's or sitemap index's addresses; JVM only."""
    locs = F.expr(f"xpath({text}, '//*[local-name()=\"loc\"]/text()')")
    return df.select(F.col(url).alias("doc_url"), F.contains(text, F.lit("<sitemapindex")).alias("is_index"), F.explode(locs).alias("loc")).select("doc_url", F.trim("loc").alias("loc"), "is_index")


API = "items array<struct<url:string, title:string, summary:string, content_text:string, content_html:string, date_published:string, date_modified:string>>"


def parse_api(df: DataFrame, url: str, text: str) -> DataFrame:
    """doc_url, link, title, summary, published, modified of JSON feeds' items that have an address and a title; JVM only."""
    items = df.select(F.col(url).alias("doc_url"), F.explode(F.from_json(text, API)["items"]).alias("i")).where("coalesce(i.url, '') <> '' and coalesce(i.title, '') <> ''")
    some = lambda c: F.when(F.col(c) != "", F.col(c))
    return items.select("doc_url", F.col("i.url").alias("link"), F.col("i.title"), F.coalesce(some("i.summary"), some("i.content_text"), some("i.content_html"), F.lit("")).alias("summary"), dates.any_date("i.date_published").alias("published"), dates.any_date("i.date_modified").alias("modified"))


WORKS = "items array<struct<DOI:string, title:array<string>, `container-title`:array<string>, abstract:string, author:array<struct<given:string, family:string>>, published:struct<`date-parts`:array<array<int>>>, issued:struct<`date-parts`:array<array<int>>>>>"


def parse_works(df: DataFrame, text: str) -> DataFrame:
    """doi, title, journal, abstract, people, published of bibliographic records; the first valid of their dates, month and day 1 where missing. JVM only."""
    w = df.select(F.explode(F.from_json(text, WORKS)["items"]).alias("w"))
    part = lambda f: dates.from_parts(F.get(F.col(f"w.{f}.`date-parts`"), 0))
    return w.select(F.col("w.DOI").alias("doi"), F.get("w.title", 0).alias("title"), F.get(F.col("w.`container-title`"), 0).alias("journal"), F.col("w.abstract"), F.col("w.author").alias("people"), F.coalesce(part("published"), part("issued")).alias("published"))


def sniff(text: Column | str, content_type: Column | str | None = None) -> Column:
    """feed, sitemap, json, html or text, by the root of a document, else by its declared type."""
    t = F.ltrim(F.regexp_replace(F.col(text) if isinstance(text, str) else text, r"^\x{FEFF}?\s*(?:<\?xml[^>]*>|<!--[\s\S]*?-->|\s)*", ""))
    kind = F.when(t.rlike(r"^<(?:rss|feed|rdf:RDF)\b"), "feed").when(t.rlike(r"^<(?:urlset|sitemapindex)\b"), "sitemap").when(t.rlike(r"^[\[{]\s*[\"{\]}]"), "json").when(t.rlike(r"^(?i:<!doctype html|<html|<head|<body)"), "html")
    if content_type is not None:
        c = F.lower(F.col(content_type) if isinstance(content_type, str) else content_type)
        kind = kind.when(c.rlike("json"), "json").when(c.rlike("html"), "html").when(c.rlike("rss|atom|xml"), "feed")
    return kind.otherwise("text")


def model_json(c: Column | str) -> Column:
    """The first brace to the last of a reply, if that is JSON; else null."""
    found = F.regexp_extract(F.col(c) if isinstance(c, str) else c, r"\{[\s\S]*\}", 0)
    return F.when(F.try_parse_json(found).isNotNull() & (found != ""), found)



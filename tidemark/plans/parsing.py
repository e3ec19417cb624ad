"""Queries on sources and sinks: documents are made from the tables, parsed, and held against the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import dates, text
from tidemark.plans.base import blank
from tidemark.plans.common import Registry, sql_iso, sql_squeeze
from tidemark.runtime import shared_dir, table
from tidemark.sources import archive, feeds, pages

add = Registry()
QUERIES, SQL = add.queries, add.sql
#: Characters that XML can't hold.
BAD = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]"


def _xml(c: str) -> Column:
    return text.escape_html(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), BAD, ""))


def _documents(spark: SparkSession, sf_dir: str, entry: Column, head: str, tail: str) -> DataFrame:
    """One document a run, its entries in order; runs are of bounded size."""
    c = table(spark, sf_dir, "candidates").where("run_id is not null").select("run_id", F.struct("candidate_id", entry.alias("e")).alias("x"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["e"]), "")
    return c.groupBy("run_id").agg(F.concat(F.lit(head), body, F.lit(tail)).alias("text")).withColumn("url", F.concat(F.lit("https://feeds.example/"), "run_id"))


def _rss(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.concat(F.lit("<item><title>"), _xml("title"), F.lit("</title><link>"), _xml("url"), F.lit("</link><pubDate>"), _xml("published_date"), F.lit("</pubDate><description>"), _xml("summary_hint"), F.lit("</description></item>"))
    return _documents(spark, sf_dir, e, '<?xml version="1.0"?><rss version="2.0"><channel>', "</channel></rss>")


def _atom(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.concat(F.lit("<entry><title>"), _xml("title"), F.lit('</title><link rel="self" href="https://none.example/"/><link rel="alternate" href="'), _xml("url"), F.lit('"/><summary>'), _xml("summary_hint"), F.lit("</summary></entry>"))
    return _documents(spark, sf_dir, e, '<feed xmlns="http://www.w3.org/2005/Atom">', "</feed>")


_STRIPPED = r"regexp_replace(coalesce({x}, ''), '[\x00-\x08\x0B\x0C\x0E-\x1F\x{{FFFE}}\x{{FFFF}}]', '', 'g')"
_ENTRY = f"WITH e AS (SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY candidate_id) AS place, {sql_squeeze(_STRIPPED.format(x='title'))} AS title, {sql_squeeze(_STRIPPED.format(x='summary_hint'))} AS summary, {sql_squeeze(_STRIPPED.format(x='url'))} AS link FROM candidates WHERE run_id IS NOT NULL)"


def _entries(df: DataFrame) -> DataFrame:
    return df.select(F.regexp_extract("doc_url", r"(\d+)\z", 1).cast("long").alias("run_id"), F.col("place").cast("long"), text.squeeze("title").alias("title"), text.squeeze("summary").alias("summary"))


@add("s_feed", f"{_ENTRY} SELECT run_id, place, title, summary FROM e WHERE title <> '' AND link <> '' AND place <= 500")
def s_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entries(feeds.parse_feeds(_rss(spark, sf_dir), "url", "text").where("error is null"))


@add("s_rss", f"{_ENTRY} SELECT run_id, place, title, summary FROM e WHERE title <> '' AND link <> '' AND place <= 40")
def s_rss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first forty entries only."""
    return _entries(feeds.parse_feeds(_rss(spark, sf_dir), "url", "text", 40).where("error is null"))


@add("s_feed_errors", f"{_ENTRY} SELECT run_id, CASE WHEN place > 150 THEN 'beyond_limit' ELSE 'no_title_or_link' END AS error, count(*) AS n FROM e WHERE place > 150 OR title = '' OR link = '' GROUP BY 1, 2")
def s_feed_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side output: entries beyond the limit, or without title or link."""
    e = feeds.parse_feeds(_rss(spark, sf_dir), "url", "text", 150).where("error is not null")
    return e.groupBy(F.regexp_extract("doc_url", r"(\d+)\z", 1).cast("long").alias("run_id"), "error").agg(F.count(F.lit(1)).alias("n"))


@add("s_entry", f"{_ENTRY} SELECT run_id, place, title, summary FROM e WHERE title <> '' AND link <> ''")
def s_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Atom entries: the alternate link, not the entry's own; the summary element."""
    return _entries(feeds.parse_feeds(_atom(spark, sf_dir), "url", "text").where("error is null"))


@add("s_api", f"SELECT run_id, title, coalesce(nullif(summary_hint, ''), '') AS summary, {sql_iso('modified_date')} AS modified FROM candidates WHERE coalesce(url, '') <> '' AND coalesce(title, '') <> '' AND run_id IS NOT NULL")
def s_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "candidates").where("run_id is not null")
    iso = F.when(dates.iso_prefix("modified_date").isNotNull(), F.col("modified_date"))
    docs = c.groupBy("run_id").agg(F.to_json(F.struct(F.collect_list(F.struct("url", "title", F.col("summary_hint").alias("summary"), iso.alias("date_modified"))).alias("items"))).alias("text"))
    return feeds.parse_api(docs, "run_id", "text").select(F.col("doc_url").alias("run_id"), "title", "summary", "modified")


@add("s_sitemap", f"SELECT run_id, {sql_squeeze('provenance_url')} AS loc, count(*) AS n FROM candidates WHERE provenance_url IS NOT NULL AND run_id IS NOT NULL GROUP BY 1, 2")
def s_sitemap(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.when(F.col("provenance_url").isNotNull(), F.concat(F.lit("<url><loc>"), _xml("provenance_url"), F.lit("</loc></url>"))).otherwise("")
    docs = _documents(spark, sf_dir, e, '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">', "</urlset>")
    return feeds.sitemap_locations(docs, "run_id", "text").groupBy(F.col("doc_url").alias("run_id"), text.squeeze("loc").alias("loc")).agg(F.count(F.lit(1)).alias("n"))


def _page(spark: SparkSession, sf_dir: str) -> DataFrame:
    ld = F.to_json(F.struct(F.struct(F.lit("NewsArticle").alias("@type"), F.col("title").alias("headline"), dates.iso_prefix("published_date").cast("string").alias("datePublished")).alias("@graph")))
    ld = F.replace(ld, F.lit("</"), F.lit("<\\/"))
    html = F.concat(
        F.lit('<!doctype html><html><head><meta name="description" content="'), text.escape_html(blank("summary_hint")), F.lit('"><script type="application/ld+json">'), ld, F.lit("</script><title>Site</title></head><body><nav><a href='/menu'>Menu</a></nav><main><article><h1>"),
        text.escape_html(blank("title")), F.lit("</h1><p>"), text.escape_html(blank("summary_hint")), F.lit("</p><a href='/"), F.col("candidate_id").cast("string"), F.lit("'>more</a><br>end</article></main><footer>All rights</footer></body></html>"),
    )
    return table(spark, sf_dir, "candidates").select(F.concat(F.lit("https://pages.example/"), F.col("candidate_id").cast("string")).alias("url"), html.alias("html"))


@add("s_html", f"SELECT candidate_id, {sql_squeeze('coalesce(title, chr(32))')} AS title, {sql_squeeze('coalesce(title, chr(32)) || chr(32) || coalesce(summary_hint, chr(32)) || chr(32) || $$more end$$')} AS body, {sql_iso('published_date')} AS published FROM candidates")
def s_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages read back: headline and date of their structured data, and the article's text without menus and footers."""
    p = pages.parse_pages(_page(spark, sf_dir), "url", "html", 100_000)
    return p.select(F.regexp_extract("doc_url", r"(\d+)\z", 1).cast("long").alias("candidate_id"), text.squeeze("title").alias("title"), text.squeeze("body").alias("body"), dates.iso_prefix("published_raw").alias("published"))


@add("s_html_links", "SELECT 'https://pages.example/' || candidate_id AS parent, unnest(['https://pages.example/menu', 'https://pages.example/' || candidate_id]) AS url, unnest(['Menu', 'more']) AS label FROM candidates")
def s_html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.edges(pages.parse_pages(_page(spark, sf_dir), "url", "html")).select("parent", "url", "label")


@add("s_jsonld", "SELECT candidate_id, len(coalesce(evidence, [])) + 1 AS n_nodes FROM candidates")
def s_jsonld(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objects of a nested tree, counted."""
    tree = F.to_json(F.struct(F.lit("Article").alias("@type"), F.transform("evidence", lambda e: F.struct(e["url"].alias("url"), F.lit("Evidence").alias("@type"))).alias("evidence")))
    return table(spark, sf_dir, "candidates").select("candidate_id", pages.count_nodes(tree).alias("n_nodes"))


@add("s_sniff", r"""SELECT doc_id, CASE WHEN regexp_matches(t, '^<(?:rss|feed|rdf:RDF)\b') THEN 'feed' WHEN regexp_matches(t, '^<(?:urlset|sitemapindex)\b') THEN 'sitemap' WHEN regexp_matches(t, '^[\[{]\s*["{\]}]') THEN 'json' WHEN regexp_matches(t, '^(?i:<!doctype html|<html|<head|<body)') THEN 'html' ELSE 'text' END AS kind FROM (SELECT doc_id, regexp_replace(text, '^\x{FEFF}?\s*(?:<\?xml[^>]*>|<!--(?s:.*?)-->|\s)*', '') AS t FROM documents)""")
def s_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", feeds.sniff("text").alias("kind"))


_HY = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_''\-]*[\p{L}\p{N}_])?"


@add("f_ftgate", f"SELECT candidate_id, CASE WHEN coalesce(len(regexp_extract_all(full_text, '{_HY}')), 0) >= 50 THEN full_text ELSE summary_hint END AS body FROM candidates")
def f_ftgate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extracted text of fifty words or more, else the summary."""
    return table(spark, sf_dir, "candidates").select("candidate_id", F.when(F.coalesce(text.words_hyphenated("full_text"), F.lit(0)) >= 50, F.col("full_text")).otherwise(F.col("summary_hint")).alias("body"))


@add("s_fulltext", r"SELECT candidate_id, array_to_string(regexp_extract_all(full_text, '[^\t-\r \x{85}\p{Z}]+')[1:400], ' ') AS body FROM candidates WHERE full_text IS NOT NULL")
def s_fulltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "candidates").where("full_text is not null").select("candidate_id", text.first_words("full_text", 400).alias("body"))


@add("s_cache", "WITH k AS (SELECT sha256(url) AS k, max(fetched_at) AS kept FROM candidates WHERE url IS NOT NULL GROUP BY 1), n AS (SELECT max(fetched_at) AS now FROM candidates) SELECT summary_id, kept IS NOT NULL AND kept > now - INTERVAL 12 HOUR AS is_fresh FROM summary CROSS JOIN n LEFT JOIN k ON k = sha256(url)")
def s_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a page was fetched within twelve hours of the last fetch of all."""
    c = table(spark, sf_dir, "candidates")
    k = c.where("url is not null").groupBy(F.sha2("url", 256).alias("k")).agg(F.max("fetched_at").alias("kept"))
    now = F.lit(str(c.agg(F.max("fetched_at")).first()[0])).cast("timestamp_ntz")
    s = table(spark, sf_dir, "summary").select("summary_id", F.sha2("url", 256).alias("k"))
    return s.join(k, "k", "left").select("summary_id", F.coalesce(F.col("kept") > now - F.expr("interval 12 hours"), F.lit(False)).alias("is_fresh"))


@add("s_capture", "SELECT url, arg_max(candidate_id, (fetched_at, candidate_id)) AS candidate_id FROM candidates WHERE url IS NOT NULL AND fetched_at < TIMESTAMP '2024-12-01' GROUP BY 1")
def s_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's latest capture as of a day: captures are read, nothing is fetched."""
    c = table(spark, sf_dir, "candidates").where(F.col("url").isNotNull() & (F.col("fetched_at") < F.lit("2024-12-01").cast("timestamp_ntz")))
    return c.groupBy("url").agg(F.max_by("candidate_id", F.struct("fetched_at", "candidate_id")).alias("candidate_id"))


@add("s_works", "SELECT trim(doi) AS doi, title, journal, CASE WHEN publication_year BETWEEN 1 AND 9999 THEN make_date(publication_year, 1, 1) END AS published FROM readings WHERE coalesce(trim(doi), '') <> '' AND coalesce(title, '') <> '' AND coalesce(abstract_en, '') <> ''")
def s_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bibliographic records: DOI, title and abstract needed; the date from its parts."""
    r = table(spark, sf_dir, "readings")
    item = F.struct(F.trim("doi").alias("DOI"), F.array("title").alias("title"), F.array("journal").alias("container-title"), F.col("abstract_en").alias("abstract"), F.struct(F.array(F.array("publication_year")).alias("date-parts")).alias("published"))
    docs = r.select(F.to_json(F.struct(F.array(item).alias("items"))).alias("text"))
    w = feeds.parse_works(docs, "text").where("coalesce(doi, '') <> '' and coalesce(title, '') <> '' and coalesce(abstract, '') <> ''")
    return w.select("doi", "title", "journal", "published")


@add("d_work", "SELECT reading_id, CASE WHEN publication_year BETWEEN 1 AND 9999 THEN make_date(publication_year, 1, 1) END AS published FROM readings")
def d_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "readings").select("reading_id", dates.from_parts(F.array("publication_year")).alias("published"))


@add("s_sources", "SELECT name, strategy, len(allowed_domains) AS n_domains FROM sources")
def s_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry from its JSON form."""
    s = table(spark, sf_dir, "sources")
    doc = s.agg(F.to_json(F.struct(F.collect_list(F.struct("name", "strategy", "allowed_domains")).alias("sources"))).alias("text"))  # a registry is one document
    got = doc.select(F.explode(F.from_json("text", "sources array<struct<name:string, strategy:string, allowed_domains:array<string>>>")["sources"]).alias("s"))
    return got.select("s.name", "s.strategy", F.size("s.allowed_domains").cast("long").alias("n_domains"))


@add("s_biblio", "SELECT t AS tag, reading_id FROM (SELECT unnest(list_distinct(tags)) AS t, reading_id FROM readings) WHERE t IS NOT NULL")
def s_biblio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map of tags to readings, made and taken apart; entries go by tag, in parts of bounded size."""
    r = table(spark, sf_dir, "readings").select(F.explode(F.array_distinct("tags")).alias("tag"), "reading_id").where("tag is not null")
    docs = r.groupBy("tag", F.pmod("reading_id", F.lit(997)).alias("part")).agg(F.collect_list(F.struct("reading_id")).alias("l"))
    docs = docs.select(F.to_json(F.create_map("tag", "l")).alias("text"))
    got = docs.select(F.explode(F.from_json("text", "map<string, array<struct<reading_id:bigint>>>")).alias("tag", "l"))
    return got.select("tag", F.explode("l").alias("x")).select("tag", "x.reading_id")


@add("s_rebuild", "SELECT c.candidate_id, coalesce(nullif(c.full_text, ''), nullif(c.summary_hint, '')) AS body, CASE WHEN coalesce(c.full_text, '') <> '' THEN 'page' WHEN coalesce(c.summary_hint, '') <> '' THEN 'feed' END AS origin FROM candidates c WHERE fetched_at::DATE <= discovered_date")
def s_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page text, else feed text, of what was fetched by the day of the run."""
    c = table(spark, sf_dir, "candidates").where(F.to_date("fetched_at") <= F.col("discovered_date"))
    full, hint = text_of("full_text"), text_of("summary_hint")
    return c.select("candidate_id", F.coalesce(full, hint).alias("body"), F.when(full.isNotNull(), "page").when(hint.isNotNull(), "feed").alias("origin"))


def text_of(c: str) -> Column:
    return F.when(F.col(c) != "", F.col(c))


@add("s_searchimport", "SELECT DISTINCT url, 0 AS depth, 'search' AS method FROM summary WHERE method = 'search' AND url IS NOT NULL UNION ALL SELECT url, 0, 'registry' FROM sources WHERE url IS NOT NULL")
def s_searchimport(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imported search results as extra seeds, without their snippets."""
    s = table(spark, sf_dir, "summary").where("method = 'search' and url is not null").select("url").distinct().select("url", F.lit(0).alias("depth"), F.lit("search").alias("method"))
    return s.unionByName(table(spark, sf_dir, "sources").where("url is not null").select("url", F.lit(0).alias("depth"), F.lit("registry").alias("method")))


# --- sinks -----------------------------------------------------------------------------------

_SCHEMA = "item_id bigint, title_en string, source_org string, url string, core_argument_en string"


def _archived(spark: SparkSession, sf_dir: str, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"  # of this run alone
    archive.write_archive(table(spark, sf_dir, "digest_items").select("digest_date", "item_id", "title_en", "source_org", "url", "core_argument_en"), path)
    return path


@add("k_archive", "SELECT digest_date, item_id, title_en, source_org, url, core_argument_en FROM digest_items WHERE digest_date IS NOT NULL")
def k_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues written as JSON by day and read back whole."""
    return archive.read_archive(spark, _archived(spark, sf_dir, "archive"), _SCHEMA).select("digest_date", "item_id", "title_en", "source_org", "url", "core_argument_en")


@add("s_archive", "SELECT digest_date, item_id FROM digest_items WHERE digest_date IN (SELECT DISTINCT digest_date FROM digest_items WHERE digest_date IS NOT NULL ORDER BY 1 DESC LIMIT 5)")
def s_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of the five latest issues."""
    return archive.read_archive(spark, _archived(spark, sf_dir, "latest"), _SCHEMA, latest=5).select("digest_date", "item_id")


@add("s_history", "SELECT digest_date, item_id FROM digest_items WHERE digest_date IN (SELECT DISTINCT digest_date FROM digest_items WHERE digest_date < (SELECT max(digest_date) FROM digest_items) ORDER BY 1 DESC LIMIT 6)")
def s_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six issues before the latest."""
    d = table(spark, sf_dir, "digest_items").select("digest_date", "item_id").where("digest_date is not null")
    days = d.select("digest_date").distinct().orderBy(F.desc("digest_date")).limit(7).withColumn("n", F.row_number().over(Window.orderBy(F.desc("digest_date")))).where("n > 1")
    return d.join(F.broadcast(days.select("digest_date")), "digest_date", "left_semi")  # six rows


@add("k_index", "SELECT digest_date, count(*) AS n FROM digest_items WHERE digest_date IS NOT NULL GROUP BY 1")
def k_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index whose stale rows are replaced by day."""
    new = table(spark, sf_dir, "digest_items").where("digest_date is not null").groupBy("digest_date").agg(F.count(F.lit(1)).alias("n"))
    stale = new.select("digest_date", F.lit(-1).cast("long").alias("n"))
    return archive.merge_index(stale, new)


@add("k_report", "SELECT decision, method, count(*) AS n, count(DISTINCT run_id) AS n_runs FROM summary GROUP BY 1, 2")
def k_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "summary").groupBy("decision", "method").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("run_id").alias("n_runs"))


@add("k_searchidx", "SELECT concat_ws('-', strftime(digest_date, '%Y-%m-%d'), 'signal', item_id::VARCHAR) AS id, 'signal' AS kind, digest_date AS day, title_en AS title, source_org AS source, url, lower(concat_ws(' ', title_en, core_argument_en, why_now_en)) AS text, array_to_string(tags, ' ') AS topics FROM digest_items")
def k_searchidx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.search_rows(table(spark, sf_dir, "digest_items"), "signal", "item_id", ["title_en", "core_argument_en", "why_now_en"])


@add("k_md", "SELECT digest_date, count(*) AS n_items, '# ' || strftime(digest_date, '%Y-%m-%d') || chr(10) || chr(10) || string_agg('## [' || coalesce(title_en, '') || '](' || coalesce(url, '') || ')' || chr(10) || chr(10) || coalesce(core_argument_en, ''), chr(10) || chr(10) ORDER BY item_id) AS page FROM digest_items WHERE digest_date IS NOT NULL GROUP BY 1")
def k_md(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.markdown(table(spark, sf_dir, "digest_items").withColumn("place", F.col("item_id")), "title_en", "url", "core_argument_en")


@add("f_cand", "SELECT candidate_id, substr(coalesce(summary_hint, ''), 1, 2400) AS summary, coalesce(source_type, CASE WHEN reliability = 'primary' THEN 'international_org' ELSE 'think_tank' END) AS source_type FROM candidates")
def f_cand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "candidates").select("candidate_id", F.substring(blank("summary_hint"), 1, 2400).alias("summary"), F.coalesce("source_type", F.when(F.col("reliability") == "primary", "international_org").otherwise("think_tank")).alias("source_type"))


@add("f_items", "SELECT digest_date, 'news' AS kind, brief_id AS id, title_en FROM news_briefs UNION ALL SELECT digest_date, 'signal', item_id, title_en FROM digest_items")
def f_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "news_briefs").select("digest_date", F.lit("news").alias("kind"), F.col("brief_id").alias("id"), "title_en")
    return n.unionByName(table(spark, sf_dir, "digest_items").select("digest_date", F.lit("signal").alias("kind"), F.col("item_id").alias("id"), "title_en"))


@add("f_headline", "SELECT item_id, coalesce(nullif(title_en, ''), nullif(summary_en, ''), 'Digest — ' || strftime(digest_date, '%Y-%m-%d')) AS headline FROM digest_items")
def f_headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "digest_items").select("item_id", F.coalesce(text_of("title_en"), text_of("summary_en"), F.concat(F.lit("Digest — "), F.date_format("digest_date", "yyyy-MM-dd"))).alias("headline"))


@add("f_sigt", "SELECT digest_date, string_agg(substr(title_en, 1, 180), ' / ' ORDER BY item_id) AS titles FROM (SELECT *, row_number() OVER (PARTITION BY digest_date ORDER BY item_id) AS n FROM digest_items WHERE coalesce(title_en, '') <> '' AND digest_date IS NOT NULL) WHERE n <= 4 GROUP BY 1")
def f_sigt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four titles of an issue."""
    d = table(spark, sf_dir, "digest_items").where("coalesce(title_en, '') <> '' and digest_date is not null").select("digest_date", "item_id", F.substring("title_en", 1, 180).alias("t"))
    d = d.withColumn("n", F.row_number().over(Window.partitionBy("digest_date").orderBy("item_id"))).where("n <= 4")
    return d.groupBy("digest_date").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_id", "t"))), lambda x: x["t"]), " / ").alias("titles"))


@add("f_latest", "SELECT max(digest_date) AS latest FROM digest_items")
def f_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "digest_items").agg(F.max("digest_date").alias("latest"))


@add("f_coerce", "SELECT history_id, array_to_string(list_filter(coalesce(published_versions, []), lambda v: coalesce(trim(v), '') <> ''), ' ') AS versions FROM history")
def f_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "history").select("history_id", F.array_join(F.filter(F.coalesce("published_versions", F.array().cast("array<string>")), lambda v: F.coalesce(F.trim(v), F.lit("")) != ""), " ").alias("versions"))


@add("f_jsonscan", """SELECT candidate_id, '{"score":' || coalesce(semantic_score, -1) || '}' AS reply FROM candidates""")
def f_jsonscan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The object within a model's chatter."""
    said = F.concat(F.lit('Sure. {"score":'), F.coalesce("semantic_score", F.lit(-1)).cast("string"), F.lit("} That is all."))
    return table(spark, sf_dir, "candidates").select("candidate_id", feeds.model_json(said).alias("reply"))


@add("f_fallbacktxt", rf"SELECT candidate_id, CASE WHEN {sql_squeeze('coalesce(summary_hint, chr(32))')} <> '' THEN coalesce(source_org, '') || ': ' || CASE WHEN length({sql_squeeze('summary_hint')}) <= 100 THEN {sql_squeeze('summary_hint')} ELSE rtrim(substr({sql_squeeze('summary_hint')}, 1, 99)) || '…' END ELSE coalesce(source_org, '') || ': no summary.' END AS sentence FROM candidates")
def f_fallbacktxt(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = text.trim_sentence("summary_hint", 100)
    return table(spark, sf_dir, "candidates").select("candidate_id", F.when(F.coalesce(s, F.lit("")) != "", F.concat(blank("source_org"), F.lit(": "), s)).otherwise(F.concat(blank("source_org"), F.lit(": no summary."))).alias("sentence"))


@add("x_normissue", "SELECT item_id, coalesce(nullif(core_argument_en, ''), summary_en) AS argument, coalesce(nullif(why_now_en, ''), agenda_position_en) AS timing FROM digest_items")
def x_normissue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old and new fields of an item as one shape; a blank counts as missing."""
    return table(spark, sf_dir, "digest_items").select("item_id", F.coalesce(text_of("core_argument_en"), F.col("summary_en")).alias("argument"), F.coalesce(text_of("why_now_en"), F.col("agenda_position_en")).alias("timing"))


@add("x_query", "WITH w AS (SELECT run_id, candidate_id, unnest(regexp_extract_all(lower(title), '[a-z]{4,}')) AS term FROM candidates), n AS (SELECT run_id, term, count(*) AS n, min(candidate_id) AS seen FROM w GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY n DESC, seen, term) AS k FROM n) SELECT run_id, string_agg(term, ' ' ORDER BY k) AS query FROM r WHERE k <= 5 GROUP BY 1")
def x_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five commonest title terms of each run as a query."""
    w = table(spark, sf_dir, "candidates").select("run_id", "candidate_id", F.explode(F.regexp_extract_all(F.lower("title"), F.lit("[a-z]{4,}"), F.lit(0))).alias("term"))
    n = w.groupBy("run_id", "term").agg(F.count(F.lit(1)).alias("n"), F.min("candidate_id").alias("seen"))
    r = n.withColumn("k", F.row_number().over(Window.partitionBy("run_id").orderBy(F.desc("n"), "seen", "term"))).where("k <= 5")
    return r.groupBy("run_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "term"))), lambda x: x["term"]), " ").alias("query"))


@add("v_dir", "SELECT reading_id, len(list_filter(list_distinct(tags), lambda t: length(t) <= 30)) BETWEEN 3 AND 5 AS ok FROM readings WHERE tags IS NOT NULL")
def v_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three to five keywords, none too long."""
    return table(spark, sf_dir, "readings").where("tags is not null").select("reading_id", F.size(F.filter(F.array_distinct("tags"), lambda t: F.length(t) <= 30)).between(3, 5).alias("ok"))


@add("v_req", "SELECT item_id FROM digest_items WHERE coalesce(summary_en, '') = '' OR contains(summary_en, 'which may weaken')")
def v_req(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required texts that are empty or hold a banned phrase."""
    return table(spark, sf_dir, "digest_items").where((blank("summary_en") == "") | F.contains("summary_en", F.lit("which may weaken"))).select("item_id")

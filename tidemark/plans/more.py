"""Queries on the remaining functions, sinks and composed stages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import dates, text
from tidemark.operators import scorers, state
from tidemark.plans.base import blank
from tidemark.plans.common import Registry, sql_iso, sql_squeeze
from tidemark.runtime import shared_dir, table
from tidemark.sources import issue, pages

add = Registry()
QUERIES, SQL = add.queries, add.sql


@add("f_evname", r"SELECT candidate_id, coalesce(nullif(regexp_extract(substr(coalesce(title, '') || ' ' || coalesce(summary_hint, ''), 1, 1500), '\b[A-Z]{2,8}[-–]\d{1,3}\b'), ''), event_name, title) AS event_name FROM candidates")
def f_evname(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A session's code near the head of the text, else the event's or document's name."""
    code = F.regexp_extract(F.substring(F.concat_ws(" ", blank("title"), blank("summary_hint")), 1, 1500), r"\b[A-Z]{2,8}[-–]\d{1,3}\b", 0)
    return table(spark, sf_dir, "candidates").select("candidate_id", F.coalesce(F.when(code != "", code), F.col("event_name"), F.col("title")).alias("event_name"))


ALIASES = {"#ports": ["#trade-rules"], "#debt-relief": ["#river-finance", "#rural-credit"]}


@add("f_exptag", "WITH t AS (SELECT item_id, unnest(list_concat(coalesce(tags, []), list_concat(CASE WHEN list_contains(tags, '#ports') THEN ['#trade-rules'] ELSE [] END, CASE WHEN list_contains(tags, '#debt-relief') THEN ['#river-finance', '#rural-credit'] ELSE [] END))) AS t FROM digest_items) SELECT i.item_id, coalesce(string_agg(DISTINCT t, ' ' ORDER BY t), '') AS tags FROM digest_items i LEFT JOIN t ON t.item_id = i.item_id AND t.t IS NOT NULL GROUP BY 1")
def f_exptag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags with the aliases of those that have some."""
    none = F.array().cast("array<string>")
    held = F.create_map(*(x for k, v in ALIASES.items() for x in (F.lit(k), F.array(*(F.lit(a) for a in v)))))
    tags = F.coalesce("tags", none)
    wide = F.array_union(tags, F.flatten(F.filter(F.transform(tags, lambda t: held[t]), lambda a: a.isNotNull())))
    return table(spark, sf_dir, "digest_items").select("item_id", F.array_join(F.array_sort(F.array_distinct(F.filter(wide, lambda t: t.isNotNull()))), " ").alias("tags"))


GLOSSARY = {"#ports": "port charter", "#debt-relief": "debt pause", "#grid-access": "grid levy", "#forest-tenure": "forest concession", "#river-finance": "river compact"}
_CASE = "CASE t " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in GLOSSARY.items()) + " END"


@add("f_terms", f"WITH e AS (SELECT item_id, unnest(tags) AS t, generate_subscripts(tags, 1) AS k FROM digest_items), m AS (SELECT item_id, {_CASE} AS term, min(k) AS k FROM e GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY k) AS n FROM m WHERE term IS NOT NULL) SELECT i.item_id, coalesce(string_agg(term, ', ' ORDER BY k), '') AS terms FROM digest_items i LEFT JOIN r ON r.item_id = i.item_id AND n <= 2 GROUP BY 1")
def f_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two glossary terms of an item's tags."""
    return table(spark, sf_dir, "digest_items").select("item_id", F.array_join(F.slice(text.mapped(F.coalesce("tags", F.array().cast("array<string>")), GLOSSARY), 1, 2), ", ").alias("terms"))


@add("f_authors", "SELECT reading_id, array_to_string(list_filter(list_transform(string_split(authors, ','), lambda a: trim(a)), lambda a: a <> '')[1:2], ', ') || CASE WHEN len(list_filter(list_transform(string_split(authors, ','), lambda a: trim(a)), lambda a: a <> '')) > 2 THEN ', et al.' ELSE '' END AS people FROM readings WHERE authors IS NOT NULL")
def f_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, with "et al." beyond two."""
    people = F.transform(F.split("authors", ","), lambda a: F.struct(F.lit("").alias("given"), a.alias("family")))
    return table(spark, sf_dir, "readings").where("authors is not null").select("reading_id", text.authors(people, 2).alias("people"))


@add("f_upbrief", f"SELECT candidate_id, {sql_iso('event_date')} AS published, 'Scheduled for ' || strftime({sql_iso('event_date')}, '%Y-%m-%d') || '.' AS sentence FROM candidates WHERE development_stage = 'scheduled' AND {sql_iso('event_date')} > discovered_date")
def f_upbrief(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Briefs of what is scheduled, dated by the event."""
    c = table(spark, sf_dir, "candidates").where("development_stage = 'scheduled'").withColumn("event", dates.iso_prefix("event_date")).where("event > discovered_date")
    return c.select("candidate_id", F.col("event").alias("published"), F.concat(F.lit("Scheduled for "), F.col("event").cast("string"), F.lit(".")).alias("sentence"))


@add("f_drafterr", "SELECT 'research_signals' AS section, item_id AS identity, 'no_title' AS rule FROM digest_items WHERE coalesce(title_en, '') = '' UNION ALL SELECT 'recent_news', brief_id, 'no_sentence' FROM news_briefs WHERE coalesce(trim(one_sentence_en), '') = '' UNION ALL SELECT 'readings', reading_id, 'no_note' FROM readings WHERE coalesce(note_en, '') = ''")
def f_drafterr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations with their section and identity."""
    rule = lambda t, i, s, w, r: table(spark, sf_dir, t).where(w).select(F.lit(s).alias("section"), F.col(i).alias("identity"), F.lit(r).alias("rule"))
    a = rule("digest_items", "item_id", "research_signals", "coalesce(title_en, '') = ''", "no_title")
    return a.unionByName(rule("news_briefs", "brief_id", "recent_news", "coalesce(trim(one_sentence_en), '') = ''", "no_sentence")).unionByName(rule("readings", "reading_id", "readings", "coalesce(note_en, '') = ''", "no_note"))


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each record, its date in one of four places by the record's number."""
    h = table(spark, sf_dir, "history").where("published_date is not null").select("history_id", F.col("published_date").alias("d"))
    iso, k = F.col("d").cast("string"), F.pmod("history_id", F.lit(4))
    page = F.concat(F.lit("<html><head>"), F.when(k == 0, F.concat(F.lit('<meta property="article:published_time" content="'), iso, F.lit('T08:00:00Z">'))).otherwise(""), F.lit("</head><body><h1>T</h1><p>"),
                    F.when(k == 1, F.concat(F.lit("Publication date "), F.date_format("d", "d MMMM yyyy"))).when(k == 2, F.date_format("d", "yyyy年M月d日")).otherwise(""), F.lit("</p>"),
                    F.when(k == 3, F.concat(F.lit('<time itemprop="datePublished" datetime="'), iso, F.lit('">x</time>'))).otherwise(""), F.lit("</body></html>"))
    return h.select("history_id", F.concat(F.lit("https://p.example/press/"), F.col("history_id").cast("string")).alias("url"), page.alias("html"))


@add("d_pubhtml", "SELECT history_id, published_date AS published FROM history WHERE published_date IS NOT NULL")
def d_pubhtml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of pages by precedence: structured data and metadata, a labelled date, an ideographic date, a time element."""
    p = pages.parse_pages(_dated(spark, sf_dir), "url", "html")
    return p.select(F.regexp_extract("doc_url", r"(\d+)\z", 1).cast("long").alias("history_id"), dates.any_date("published_raw").alias("published"))


@add("d_eventrange", "SELECT history_id, published_date AS first_day, published_date + 2 AS last_day FROM history WHERE published_date IS NOT NULL")
def d_eventrange(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of an event from a range in its page, within a month or across two."""
    h = table(spark, sf_dir, "history").where("published_date is not null").select("history_id", F.col("published_date").alias("a"), F.date_add("published_date", 2).alias("b"))
    same = F.month("a") == F.month("b")
    span = F.when(same, F.concat(F.date_format("a", "d"), F.lit("-"), F.date_format("b", "d MMMM yyyy"))).otherwise(F.concat(F.date_format("a", "d MMM"), F.lit(". – "), F.date_format("b", "d MMM yyyy")))
    docs = h.select(F.concat(F.lit("https://p.example/event/"), F.col("history_id").cast("string")).alias("url"), F.concat(F.lit("<body><p>Held on "), span, F.lit("</p></body>")).alias("html"))
    p = pages.parse_pages(docs, "url", "html").select(F.regexp_extract("doc_url", r"(\d+)\z", 1).cast("long").alias("history_id"), dates.any_date("event_start_raw").alias("s"), dates.any_date("event_end_raw").alias("last_day"))
    # a range across the turn of a year names the last day's year only
    first = F.when(F.col("s") > F.col("last_day"), F.add_months("s", -12)).otherwise(F.col("s"))
    return p.select("history_id", first.alias("first_day"), "last_day")


@add("s_sent", "SELECT origin, count(*) AS n, count(DISTINCT url) AS n_urls FROM (SELECT 'news' AS origin, url FROM news_briefs WHERE coalesce(url, '') <> '' UNION ALL SELECT 'signal', url FROM digest_items WHERE coalesce(url, '') <> '') GROUP BY 1")
def s_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sent record as a table, blanks left out."""
    a = table(spark, sf_dir, "news_briefs").select(F.lit("news").alias("origin"), "url").unionByName(table(spark, sf_dir, "digest_items").select(F.lit("signal").alias("origin"), "url"))
    return a.where("coalesce(url, '') <> ''").groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("url").alias("n_urls"))


@add("k_sent", "SELECT history_id, array_to_string(list_append(list_filter(coalesce(published_versions, []), lambda v: v <> coalesce(fingerprint, '') AND v <> ''), fingerprint)[-3:], ' ') AS record FROM history WHERE fingerprint IS NOT NULL AND fingerprint <> '' AND NOT list_contains(coalesce(published_versions, []), fingerprint) AND len(list_distinct(coalesce(published_versions, []))) = len(coalesce(published_versions, []))")
def k_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rolling record with one more entry, the last three kept."""
    h = table(spark, sf_dir, "history").where("fingerprint <> ''")
    v = F.coalesce("published_versions", F.array().cast("array<string>"))
    h = h.where(~F.array_contains(v, F.col("fingerprint")) & (F.size(F.array_distinct(v)) == F.size(v)))
    return h.select("history_id", F.array_join(state.roll(v, F.array("fingerprint"), 3), " ").alias("record"))


@add("k_state", "SELECT url, max(last_seen) AS last_seen FROM history WHERE url IS NOT NULL GROUP BY 1")
def k_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State written as a whole and read again."""
    path = f"{shared_dir(spark)}/state-{uuid.uuid4().hex}"  # of this run alone
    table(spark, sf_dir, "history").where("url is not null").groupBy("url").agg(F.max("last_seen").alias("last_seen")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@add("k_html", "SELECT digest_date, count(*) AS n_items, '<h1>' || strftime(digest_date, '%B %-d, %Y') || '</h1>' || string_agg('<h2>' || replace(replace(replace(replace(replace(coalesce(title_en, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') || '</h2>', '' ORDER BY item_id) AS page FROM digest_items WHERE digest_date IS NOT NULL GROUP BY 1")
def k_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An issue as HTML."""
    d = table(spark, sf_dir, "digest_items").where("digest_date is not null").select("digest_date", F.struct("item_id", F.concat(F.lit("<h2>"), text.escape_html(blank("title_en")), F.lit("</h2>")).alias("h")).alias("x"))
    g = d.groupBy("digest_date").agg(F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list("x")).alias("l"))  # an issue is edited by hand, so small
    return g.select("digest_date", "n_items", F.concat(F.lit("<h1>"), dates.display("digest_date"), F.lit("</h1>"), F.array_join(F.transform("l", lambda x: x["h"]), "")).alias("page"))


@add("s_crossref", "SELECT reading_id FROM readings WHERE publication_year >= 2015 AND coalesce(abstract_en, '') <> '' ORDER BY discovery_score DESC NULLS LAST, reading_id LIMIT 50")
def s_crossref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works by year and abstract, the best fifty: filter, sort and limit reach the scan."""
    return table(spark, sf_dir, "readings").where("publication_year >= 2015 and abstract_en <> ''").orderBy(F.desc_nulls_last("discovery_score"), "reading_id").limit(50).select("reading_id")


@add("s_replay", "SELECT run_id, count(*) AS n FROM candidates WHERE fetched_at::DATE <= discovered_date GROUP BY 1")
def s_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a replay of each run may see: pages fetched by its day."""
    return table(spark, sf_dir, "candidates").where(F.to_date("fetched_at") <= F.col("discovered_date")).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))


@add("s_replay_get", f"""WITH r AS (SELECT run_id, max(discovered_date) AS day FROM candidates GROUP BY 1), p AS (SELECT url, run_id, min(candidate_id) AS candidate_id FROM candidates JOIN r USING (run_id) WHERE url IS NOT NULL AND fetched_at::DATE <= day GROUP BY 1, 2) SELECT s.summary_id, CASE WHEN p.url IS NULL THEN 'not_in_replay' ELSE 'ok' END AS status, {sql_squeeze("coalesce(c.title, '')")} AS title FROM summary s LEFT JOIN p ON p.url = s.url AND p.run_id = s.run_id LEFT JOIN candidates c ON c.candidate_id = p.candidate_id""")
def s_replay_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay's requests: each address of a run answered by the page that the run had by its day, built from the corpus and read back, or by a failure."""
    c = table(spark, sf_dir, "candidates").select("candidate_id", "run_id", "url", "title", "fetched_at", "discovered_date")
    day = c.groupBy("run_id").agg(F.max("discovered_date").alias("day"))
    held = c.where("url is not null").join(day, "run_id").where(F.to_date("fetched_at") <= F.col("day"))
    held = held.groupBy("url", "run_id").agg(F.min_by("title", "candidate_id").alias("title"), F.lit(True).alias("held"))
    asked = table(spark, sf_dir, "summary").select("summary_id", "url", "run_id").join(held, ["url", "run_id"], "left")
    page = F.when(F.col("held"), F.concat(F.lit("<html><head><title>Replay</title></head><body><article><h1>"), text.escape_html(blank("title")), F.lit("</h1></article></body></html>")))
    asked = asked.select(F.col("summary_id").cast("string").alias("doc"), page.alias("html"))
    read = pages.parse_pages(asked.where("html is not null"), "doc", "html").select(F.col("doc_url").alias("doc"), "title")
    out = asked.select("doc", F.col("html").isNotNull().alias("held")).join(read, "doc", "left")
    # a blank headline falls back to the page's name
    title = F.when(F.col("title") == "Replay", "").otherwise(text.squeeze(F.coalesce("title", F.lit(""))))
    return out.select(F.col("doc").cast("long").alias("summary_id"), F.when(F.col("held"), "ok").otherwise("not_in_replay").alias("status"), title.alias("title"))


_ISSUE_SQL = """WITH n AS (SELECT digest_date, count(*) AS n, bool_or(url IS NULL) AS u, bool_or(title_en IS NULL) AS t, bool_or(source_org IS NULL) AS s, bool_or(one_sentence_en IS NULL) AS o FROM news_briefs WHERE digest_date IS NOT NULL GROUP BY 1),
  g AS (SELECT digest_date, count(*) AS n, bool_or(url IS NULL) AS u, bool_or(title_en IS NULL) AS t, bool_or(source_org IS NULL) AS s, bool_or(core_argument_en IS NULL) AS c, bool_or(why_now_en IS NULL) AS w, bool_or(agenda_position_en IS NULL) AS a FROM digest_items WHERE digest_date IS NOT NULL GROUP BY 1)
  SELECT digest_date, array_to_string(list_filter([CASE WHEN n.n IS NULL THEN 'recent_news' END, CASE WHEN n.o THEN 'recent_news.one_sentence_en' END, CASE WHEN n.s THEN 'recent_news.source_org' END, CASE WHEN n.t THEN 'recent_news.title_en' END, CASE WHEN n.u THEN 'recent_news.url' END,
  CASE WHEN g.n IS NULL THEN 'research_signals' END, CASE WHEN g.a THEN 'research_signals.agenda_position_en' END, CASE WHEN g.c THEN 'research_signals.core_argument_en' END, CASE WHEN g.s THEN 'research_signals.source_org' END, CASE WHEN g.t THEN 'research_signals.title_en' END, CASE WHEN g.u THEN 'research_signals.url' END,
  CASE WHEN g.w THEN 'research_signals.why_now_en' END, CASE WHEN n.n > 8 THEN 'too many recent_news' END, CASE WHEN g.n > 5 THEN 'too many research_signals' END], lambda x: x IS NOT NULL), ' ') AS missing FROM n FULL JOIN g USING (digest_date)"""


@add("f_schema", _ISSUE_SQL)
def f_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the JSON of each day's issue lacks of the strict form."""
    lists = []
    for name, source, columns in (("recent_news", "news_briefs", ("url", "title_en", "source_org", "one_sentence_en")), ("research_signals", "digest_items", ("url", "title_en", "source_org", "core_argument_en", "why_now_en", "agenda_position_en"))):
        rows = table(spark, sf_dir, source).where("digest_date is not null")
        lists.append(rows.groupBy("digest_date").agg(F.collect_list(F.struct(*columns)).alias(name)))  # an issue is edited by hand, so small
    both = lists[0].join(lists[1], "digest_date", "full")
    doc = F.to_json(F.struct(F.lit("Issue").alias("issue_title_en"), F.array(F.struct(F.lit("u").alias("url"), F.lit("a").alias("angle_en"))).alias("title_support"), "recent_news", "research_signals", F.array(F.lit("u")).alias("editorial_context_urls")))
    return both.select("digest_date", F.array_join(issue.missing_fields(issue.parse_issue(doc)), " ").alias("missing"))


@add("v_payload", "WITH a AS (SELECT brief_id, digest_date, source_org, url FROM news_briefs b WHERE url IN (SELECT url FROM history) AND digest_date IS NOT NULL AND source_org IS NOT NULL), u AS (SELECT *, row_number() OVER (PARTITION BY digest_date, url ORDER BY brief_id) AS k FROM a), n AS (SELECT *, row_number() OVER (PARTITION BY digest_date, source_org ORDER BY brief_id) AS n FROM u WHERE k = 1) SELECT brief_id FROM n WHERE n <= 2")
def v_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Briefs of an issue that are accepted: known address, each once, two of a source, in order."""
    b = table(spark, sf_dir, "news_briefs").where("digest_date is not null and source_org is not null").select("brief_id", "digest_date", "source_org", "url")
    b = b.join(table(spark, sf_dir, "history").select("url"), "url", "left_semi")
    once = b.withColumn("k", F.row_number().over(Window.partitionBy("digest_date", "url").orderBy("brief_id"))).where("k = 1")
    return once.withColumn("n", F.row_number().over(Window.partitionBy("digest_date", "source_org").orderBy("brief_id"))).where("n <= 2").select("brief_id")


@add("v_read", "SELECT r.reading_id FROM readings r WHERE coalesce(doi, '') <> '' AND doi IN (SELECT doi FROM readings GROUP BY doi HAVING count(*) = 1) AND kind IS NOT NULL")
def v_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings whose DOI names them alone."""
    r = table(spark, sf_dir, "readings")
    one = r.where("doi <> ''").groupBy("doi").agg(F.count(F.lit(1)).alias("n")).where("n = 1")
    return r.where("kind is not null").join(one, "doi", "left_semi").select("reading_id")


WORDS = ("levy", "treaty", "budget", "tariff")


@add("x_sem", "SELECT candidate_id, least(2, " + " + ".join(f"contains(lower(coalesce(title, '')), '{w}')::INT" for w in WORDS) + ")::INT AS score FROM candidates")
def x_sem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pluggable per-row scorer with its offline default."""
    return scorers.scored_by(table(spark, sf_dir, "candidates"), "candidate_id", "title", scorers.by_words(WORDS)).select("candidate_id", "score")


@add("x_trans", f"SELECT candidate_id, {sql_squeeze('title')} AS title_out FROM candidates")
def x_trans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pluggable batch model of titles; the offline default only squeezes them."""
    out = scorers.in_batches(table(spark, sf_dir, "candidates"), "candidate_id", "title", lambda titles: titles)
    return out.select("candidate_id", text.squeeze("text_out").alias("title_out"))


@add("x_collectj", "WITH r AS (SELECT reading_id, journal, doi, coalesce(publication_year >= 2020, false) AS recent, row_number() OVER (PARTITION BY journal, coalesce(publication_year >= 2020, false) ORDER BY discovery_score DESC NULLS LAST, reading_id) AS n FROM readings WHERE journal IS NOT NULL), k AS (SELECT * FROM r WHERE n <= CASE WHEN recent THEN 3 ELSE 2 END), f AS (SELECT reading_id, row_number() OVER (PARTITION BY coalesce(doi, reading_id::VARCHAR) ORDER BY reading_id) AS f FROM k) SELECT reading_id FROM f WHERE f = 1")
def x_collectj(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each journal the best three recent and two older works, each work once."""
    r = table(spark, sf_dir, "readings").where("journal is not null").select("reading_id", "journal", "doi", "discovery_score", F.coalesce(F.col("publication_year") >= 2020, F.lit(False)).alias("recent"))
    n = F.row_number().over(Window.partitionBy("journal", "recent").orderBy(F.desc_nulls_last("discovery_score"), "reading_id"))
    k = r.withColumn("n", n).where(F.col("n") <= F.when(F.col("recent"), 3).otherwise(2))
    one = F.row_number().over(Window.partitionBy(F.coalesce("doi", F.col("reading_id").cast("string"))).orderBy("reading_id"))
    return k.withColumn("f", one).where("f = 1").select("reading_id")

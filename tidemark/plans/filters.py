"""Queries on filters, joins, aggregates and validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import text, urls
from tidemark.functions.dates import iso_prefix
from tidemark.functions.names import alias_table, name_key
from tidemark.operators import joins, verify
from tidemark.plans.base import SQL_C, blank, candidates
from tidemark.plans.common import Registry, sql_fingerprint, sql_iso
from tidemark.runtime import table

add = Registry()
QUERIES, SQL = add.queries, add.sql
_HOST = r"regexp_replace(regexp_replace(lower(regexp_extract({x}, '^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?', 2)), '^.*@', ''), ':\d*$', '')"
_KEYS = r"keys AS (SELECT regexp_replace(lower(s), '[^\p{L}\p{N}]+', '', 'g') AS k, min(source_id) AS source_id FROM (SELECT source_id, unnest(list_append(coalesce(aliases, []), name)) AS s FROM sources) GROUP BY 1)"
_BYKEY = r"keys.k = regexp_replace(lower(c.source_org), '[^\p{L}\p{N}]+', '', 'g')"


def _sources(spark: SparkSession, sf_dir: str, *carry: str) -> DataFrame:
    return alias_table(table(spark, sf_dir, "sources"), *carry)


# --- filters ---------------------------------------------------------------------------------


@add("p_domain", f"WITH {_KEYS} SELECT c.candidate_id FROM candidates c JOIN keys ON {_BYKEY} JOIN sources s ON s.source_id = keys.source_id WHERE len(list_filter(s.allowed_domains, lambda d: {_HOST.format(x='c.url')} = d OR ends_with({_HOST.format(x='c.url')}, '.' || d))) > 0")
def p_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates whose host is one of their source's domains, or below it."""
    c = table(spark, sf_dir, "candidates").select("candidate_id", "url", name_key("source_org").alias("name_key"))
    return c.join(_sources(spark, sf_dir, "allowed_domains"), "name_key").where(urls.within(urls.host("url"), F.col("allowed_domains"))).select("candidate_id")


_WHITE = ("harbourledgerinstitute.example", "tidewatercommons.example", "saltmarshreview.example")


@add("p_whitelist", f"WITH h AS (SELECT candidate_id, url, {_HOST.format(x='url')} AS h FROM candidates) SELECT candidate_id FROM h WHERE " + " OR ".join(f"h = '{d}' OR ends_with(h, '.{d}')" for d in _WHITE[:2]) + f" OR ((h = '{_WHITE[2]}' OR ends_with(h, '.{_WHITE[2]}')) AND contains(url, '/article.php'))")
def p_whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts whose full text may be fetched; one of them only on some paths."""
    h = urls.host("url")
    free, bound = (F.array(*(F.lit(d) for d in part)) for part in (_WHITE[:2], _WHITE[2:]))
    return table(spark, sf_dir, "candidates").where(urls.within(h, free) | (urls.within(h, bound) & F.contains("url", F.lit("/article.php")))).select("candidate_id")


@add("p_lookback", f"WITH {SQL_C} SELECT candidate_id FROM c WHERE published IS NULL OR published BETWEEN discovered_date - 7 AND discovered_date")
def p_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published in the seven days up to the run, or on an unknown day."""
    c = candidates(spark, sf_dir, "candidate_id", "published_date", "discovered_date")
    return c.where("published is null or published between date_sub(discovered_date, 7) and discovered_date").select("candidate_id")


@add("p_minwords", r"SELECT candidate_id FROM candidates WHERE coalesce(len(regexp_extract_all(summary_hint, '[\p{L}\p{N}_](?:[\p{L}\p{N}_''\-]*[\p{L}\p{N}_])?')), 0) >= CASE WHEN layer IN ('event', 'news') THEN 0 ELSE 15 END")
def p_minwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    least = F.when(F.col("layer").isin("event", "news"), 0).otherwise(15)
    return table(spark, sf_dir, "candidates").where(F.coalesce(text.words_hyphenated("summary_hint"), F.lit(0)) >= least).select("candidate_id")


_NOISE = ("monitor", "who pays", "what the", "means for", "policy", "q&a", "rural", "budget")


@add("p_noise2", "SELECT candidate_id FROM candidates WHERE " + " + ".join(rf"coalesce(regexp_matches(title, '(?i)\b{p}\b'), false)::INT" for p in _NOISE) + " < 2")
def p_noise2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that match fewer than two of a list of phrases."""
    n = reduce(Column.__add__, (F.coalesce(F.col("title").rlike(rf"(?i)\b{p}\b"), F.lit(False)).cast("int") for p in _NOISE))
    return table(spark, sf_dir, "candidates").where(n < 2).select("candidate_id")


@add("p_layer", "SELECT candidate_id, coalesce(layer IN ('event', 'news'), false) AS is_recent FROM candidates")
def p_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "candidates").select("candidate_id", F.coalesce(F.col("layer").isin("event", "news"), F.lit(False)).alias("is_recent"))


@add("p_sem", "WITH n AS (SELECT run_id, count(*) FILTER (WHERE semantic_score >= 2) AS n FROM candidates GROUP BY 1) SELECT candidate_id, (semantic_score >= 2) AS first_rank FROM candidates JOIN n USING (run_id) WHERE semantic_score >= 2 OR (n < 5 AND semantic_score >= 1)")
def p_sem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each run, scores of 2 and more; with fewer than five of them, scores of 1 after them."""
    c = table(spark, sf_dir, "candidates").select("candidate_id", "run_id", "semantic_score")
    n = c.groupBy("run_id").agg(F.count_if(F.col("semantic_score") >= 2).alias("n"))
    return c.join(n, "run_id").where("semantic_score >= 2 or (n < 5 and semantic_score >= 1)").select("candidate_id", (F.col("semantic_score") >= 2).alias("first_rank"))


_STATE = f"""{SQL_C}, m AS (SELECT *, {sql_iso('modified_date')} AS modified, {sql_iso('event_date')} AS event FROM c)"""
_TEMPORAL = """CASE WHEN coalesce(published > discovered_date, false) OR coalesce(modified > discovered_date, false) THEN 'future'
  WHEN published IS NULL AND NOT upcoming THEN 'undated' WHEN NOT upcoming AND published < discovered_date - 21 THEN 'too_old' ELSE 'in_scope' END"""
_UPCOMING = "coalesce(development_stage = 'scheduled' AND event > discovered_date AND event <= discovered_date + 14, false)"


def _temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = candidates(spark, sf_dir, "candidate_id", "published_date", "event_date", "modified_date", "discovered_date", "development_stage")
    c = c.withColumns({"modified": iso_prefix("modified_date"), "event": iso_prefix("event_date")})
    c = c.withColumn("upcoming", F.expr("coalesce(development_stage = 'scheduled' and event > discovered_date and event <= date_add(discovered_date, 14), false)"))
    verdict = (
        F.when(F.expr("coalesce(published > discovered_date, false) or coalesce(modified > discovered_date, false)"), "future")
        .when(F.expr("published is null and not upcoming"), "undated").when(F.expr("not upcoming and published < date_sub(discovered_date, 21)"), "too_old").otherwise("in_scope")
    )
    return c.withColumn("verdict", verdict)


@add("p_temporal", f"WITH {_STATE}, u AS (SELECT *, {_UPCOMING} AS upcoming FROM m) SELECT candidate_id, {_TEMPORAL} AS verdict FROM u")
def p_temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _temporal(spark, sf_dir).select("candidate_id", "verdict")


@add("t_upcoming", f"WITH {_STATE} SELECT candidate_id, event FROM m WHERE {_UPCOMING}")
def t_upcoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side output: what is scheduled for the next fourteen days."""
    return _temporal(spark, sf_dir).where("upcoming").select("candidate_id", "event")


@add("t_window", f"WITH {SQL_C} SELECT candidate_id FROM c WHERE published BETWEEN discovered_date - 21 AND discovered_date")
def t_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rolling window by publication, never by event: late reports count when they are published."""
    c = candidates(spark, sf_dir, "candidate_id", "published_date", "discovered_date")
    return c.where("published between date_sub(discovered_date, 21) and discovered_date").select("candidate_id")


@add("p_evid", "SELECT candidate_id, CASE WHEN coalesce(reliability NOT IN ('primary', 'established_secondary'), true) THEN 'unreviewed' WHEN coalesce(text_source, '') = 'metadata_only' AND coalesce(development_stage, '') <> 'scheduled' THEN 'metadata_only' WHEN coalesce(summary_hint, '') = '' AND coalesce(full_text, '') = '' THEN 'no_text' ELSE 'supported' END AS evidence FROM candidates")
def p_evid(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = (
        F.when(~F.coalesce(F.col("reliability").isin("primary", "established_secondary"), F.lit(False)), "unreviewed")
        .when((blank("text_source") == "metadata_only") & (blank("development_stage") != "scheduled"), "metadata_only").when((blank("summary_hint") == "") & (blank("full_text") == ""), "no_text").otherwise("supported")
    )
    return table(spark, sf_dir, "candidates").select("candidate_id", verdict.alias("evidence"))


@add("p_enriched", "SELECT reading_id FROM readings WHERE coalesce(doi, '') <> '' AND coalesce(title, '') <> '' AND coalesce(authors, '') <> '' AND len(regexp_extract_all(abstract_en, '[\\p{L}\\p{N}_]+')) >= 30")
def p_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = (blank("doi") != "") & (blank("title") != "") & (blank("authors") != "") & (text.words_plain("abstract_en") >= 30)
    return table(spark, sf_dir, "readings").where(ok).select("reading_id")


_CHALLENGE = "verify you are human|are you a robot|checking your browser|security check|enable (?:javascript|scripts|cookies)|turn on scripts|access denied|too many requests|session expired"


@add("p_challenge", f"SELECT brief_id FROM news_briefs WHERE regexp_matches(lower(one_sentence_en), '{_CHALLENGE}')")
def p_challenge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies that are a challenge page instead of content."""
    return table(spark, sf_dir, "news_briefs").where(F.lower("one_sentence_en").rlike(_CHALLENGE)).select("brief_id")


_CUE = "news|event|report|publication|press|policy|budget|levy|treaty"


@add("p_linkcue", f"SELECT candidate_id FROM candidates WHERE regexp_matches(coalesce(url, '') || ' ' || coalesce(title, ''), '(?i){_CUE}')")
def p_linkcue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "candidates").where(F.concat_ws(" ", blank("url"), blank("title")).rlike(f"(?i){_CUE}")).select("candidate_id")


@add("p_trace", "SELECT candidate_id FROM candidates WHERE contains(lower(concat_ws(chr(10), title, source_org, url, summary_hint, full_text, event_name)), 'transit pact')")
def p_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything a query string is found in, in any text field."""
    row = F.lower(F.concat_ws("\n", "title", "source_org", "url", "summary_hint", "full_text", "event_name"))
    return table(spark, sf_dir, "candidates").where(F.contains(row, F.lit("transit pact"))).select("candidate_id")


@add("l_search", "SELECT item_id FROM digest_items WHERE contains(lower(concat_ws(' ', title_en, source_org, core_argument_en, why_now_en, agenda_position_en, summary_en, array_to_string(tags, ' '))), 'coastal') AND list_contains(tags, '#ports')")
def l_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site search: a needle over all texts of an item, with a topic."""
    hay = F.lower(F.concat_ws(" ", "title_en", "source_org", "core_argument_en", "why_now_en", "agenda_position_en", "summary_en", F.array_join("tags", " ")))
    return table(spark, sf_dir, "digest_items").where((F.instr(hay, "coastal") > 0) & F.array_contains("tags", "#ports")).select("item_id")


# --- joins -----------------------------------------------------------------------------------


@add("j_src", f"WITH {_KEYS} SELECT c.candidate_id, s.name AS source_name FROM candidates c JOIN keys ON {_BYKEY} JOIN sources s ON s.source_id = keys.source_id")
def j_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "candidates").select("candidate_id", name_key("source_org").alias("name_key"))
    return c.join(_sources(spark, sf_dir), "name_key").select("candidate_id", "source_name")


@add("j_host", f"""WITH r AS (SELECT source_id, name, regexp_replace({_HOST.format(x='url')}, '^www\\.', '') AS h FROM sources), h AS (SELECT candidate_id, regexp_replace({_HOST.format(x='url')}, '^www\\.', '') AS h FROM candidates WHERE url IS NOT NULL),
 m AS (SELECT candidate_id, r.name, row_number() OVER (PARTITION BY candidate_id ORDER BY (h.h <> r.h)::INT, source_id) AS n FROM h JOIN r ON h.h = r.h OR ends_with(h.h, '.' || r.h)) SELECT h.candidate_id, coalesce(m.name, h.h) AS publisher, m.name IS NOT NULL AS reviewed FROM h LEFT JOIN m ON m.candidate_id = h.candidate_id AND m.n = 1""")
def j_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The publisher of an address: its host, else the nearest host above it, else unreviewed."""
    c = table(spark, sf_dir, "candidates").where("url is not null").select("candidate_id", "url")
    r = table(spark, sf_dir, "sources").select(F.col("source_id").alias("place"), "name", urls.host("url").alias("known"))
    return joins.publisher_of_host(c.withColumn("host", urls.host("url")), "candidate_id", "host", r).select("candidate_id", "publisher", "reviewed")


@add("j_page", "SELECT c.candidate_id, coalesce(nullif(c.full_text, ''), r.abstract_en) AS supported_text FROM candidates c LEFT JOIN (SELECT DISTINCT ON (doi) doi, abstract_en FROM readings WHERE doi IS NOT NULL ORDER BY doi, reading_id) r ON r.doi = c.doi")
def j_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence fetched elsewhere fills a text that is missing."""
    r = table(spark, sf_dir, "readings").where("doi is not null").groupBy("doi").agg(F.min_by("abstract_en", "reading_id").alias("abstract_en"))
    c = table(spark, sf_dir, "candidates").select("candidate_id", "doi", "full_text")
    return c.join(r, "doi", "left").select("candidate_id", F.coalesce(F.when(F.col("full_text") != "", F.col("full_text")), F.col("abstract_en")).alias("supported_text"))


@add("j_hist", "SELECT c.candidate_id, h.history_id, h.fingerprint = c.content_fingerprint AS unchanged FROM candidates c LEFT JOIN (SELECT url, min(history_id) AS history_id, arg_min(fingerprint, history_id) AS fingerprint FROM history GROUP BY 1) h ON h.url = c.url")
def j_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = table(spark, sf_dir, "history").where("url is not null").groupBy("url").agg(F.min("history_id").alias("history_id"), F.min_by("fingerprint", "history_id").alias("fingerprint"))
    c = table(spark, sf_dir, "candidates").select("candidate_id", "url", "content_fingerprint")
    return c.join(h, "url", "left").select("candidate_id", "history_id", (F.col("fingerprint") == F.col("content_fingerprint")).alias("unchanged"))


@add("j_prior", f"SELECT candidate_id FROM candidates c WHERE EXISTS (SELECT 1 FROM history h WHERE h.event_id = c.event_id AND h.stage = c.development_stage AND {sql_fingerprint('h.summary_hint')} = {sql_fingerprint('c.summary_hint')})")
def j_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates of an event already published with the same stage and summary."""
    c = table(spark, sf_dir, "candidates").select("candidate_id", "event_id", F.col("development_stage").alias("stage"), text.fingerprint("summary_hint").alias("fp"))
    h = table(spark, sf_dir, "history").select("event_id", "stage", text.fingerprint("summary_hint").alias("fp"))
    return c.join(h, ["event_id", "stage", "fp"], "left_semi").select("candidate_id")


@add("j_sent", "SELECT candidate_id FROM candidates c WHERE url IS NOT NULL AND NOT EXISTS (SELECT 1 FROM news_briefs b WHERE b.url = c.url AND c.layer IN ('event', 'news')) AND NOT EXISTS (SELECT 1 FROM digest_items d WHERE d.url = c.url AND coalesce(c.layer NOT IN ('event', 'news'), true))")
def j_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates not sent before; which record counts depends on the layer."""
    c = table(spark, sf_dir, "candidates").where("url is not null").select("candidate_id", "url", F.coalesce(F.col("layer").isin("event", "news"), F.lit(False)).alias("recent"))
    sent = table(spark, sf_dir, "news_briefs").select("url", F.lit(True).alias("recent")).unionByName(table(spark, sf_dir, "digest_items").select("url", F.lit(False).alias("recent")))
    return c.join(sent, ["url", "recent"], "left_anti").select("candidate_id")


@add("j_xexcl", "SELECT brief_id FROM news_briefs b WHERE NOT EXISTS (SELECT 1 FROM digest_items d WHERE lower(d.url) = lower(b.url))")
def j_xexcl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Briefs whose article is none of the items."""
    b, d = table(spark, sf_dir, "news_briefs").select("brief_id", F.lower("url").alias("k")), table(spark, sf_dir, "digest_items").select(F.lower("url").alias("k"))
    return b.join(d, "k", "left_anti").select("brief_id")


_DOI = r"regexp_replace(lower(regexp_replace({x}, '[\s\x{{A0}}]+', '', 'g')), '^(?:https?://(?:dx\.)?doi\.org/|doi:)|\.$', '', 'g')"


def _doi(c: str) -> Column:
    return F.regexp_replace(F.lower(F.regexp_replace(c, r"[\s\x{A0}]+", "")), r"^(?:https?://(?:dx\.)?doi\.org/|doi:)|\.\z", "")


@add("j_doi", f"WITH r AS (SELECT min(reading_id) AS reading_id, {_DOI.format(x='doi')} AS k FROM readings WHERE doi IS NOT NULL GROUP BY 2), h AS (SELECT min(history_id) AS history_id, {_DOI.format(x='doi')} AS k FROM history WHERE doi IS NOT NULL AND doi LIKE '%10.%/%' GROUP BY 2) SELECT coalesce(r.k, h.k) AS doi, reading_id, history_id FROM r FULL JOIN h ON r.k = h.k")
def j_doi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full merge of readings and history by DOI, whatever its spelling."""
    r = table(spark, sf_dir, "readings").where("doi is not null").groupBy(_doi("doi").alias("doi")).agg(F.min("reading_id").alias("reading_id"))
    h = table(spark, sf_dir, "history").where("doi is not null and doi like '%10.%/%'").groupBy(_doi("doi").alias("doi")).agg(F.min("history_id").alias("history_id"))
    return r.join(h, "doi", "full").select("doi", "reading_id", "history_id")


#: The works that readings are held against: their own facts, of which some are spelled otherwise and some are wrong.
_WORKS = f"""SELECT {_DOI.format(x='doi')} AS doi, upper(title) || '.' AS title, CASE WHEN reading_id % 11 = 3 THEN 'Other Annals' ELSE lower(journal) END AS journal,
  CASE WHEN reading_id % 13 = 5 THEN [] WHEN reading_id % 17 = 6 THEN ['Nobody'] ELSE list_transform(string_split(authors, ','), lambda x: regexp_replace(trim(x), ' [A-Z]\\.$', '')) END AS families,
  publication_year + (reading_id % 7 = 2)::INT AS year FROM readings WHERE doi IS NOT NULL AND reading_id % 19 <> 4"""
_KEY = r"regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_]+', '', 'g')"
_SAME = lambda n: f"coalesce({_KEY.format(x='c.' + n)} = {_KEY.format(x='w.' + n)} AND {_KEY.format(x='c.' + n)} <> '', false)"


@add("j_verify", f"""WITH w AS ({_WORKS}), c AS (SELECT reading_id, {_DOI.format(x='doi')} AS doi, title, journal, authors, publication_year AS year FROM readings), k AS (SELECT c.reading_id, CASE WHEN coalesce(c.doi, '') = '' THEN 0 WHEN w.doi IS NULL THEN 1 WHEN NOT {_SAME('title')} THEN 2
  WHEN NOT {_SAME('journal')} THEN 3 WHEN NOT coalesce(len(families) > 0 AND list_bool_and(list_transform(families, lambda x: coalesce({_KEY.format(x='x')}, '') <> '' AND contains(coalesce({_KEY.format(x='c.authors')}, ''), {_KEY.format(x='x')}))), false) THEN 4 WHEN NOT coalesce(c.year = w.year, false) THEN 5 ELSE 6 END AS place
  FROM c LEFT JOIN w ON w.doi = c.doi AND w.doi <> '') SELECT reading_id, max(place) = 6 AS verified, ['no_doi', 'unknown_doi', 'title', 'journal', 'authors', 'year', 'verified'][max(place) + 1] AS reason FROM k GROUP BY 1""")
def j_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings whose title, journal, every author and year a work of their DOI confirms; the others by the first fact that fails."""
    r = table(spark, sf_dir, "readings")
    i = F.col("reading_id")
    families = F.transform(F.split("authors", ","), lambda x: F.regexp_replace(F.trim(x), r" [A-Z]\.\z", ""))
    works = r.where(F.col("doi").isNotNull() & (i % 19 != 4)).select(
        _doi("doi").alias("doi"), F.concat(F.upper("title"), F.lit(".")).alias("title"), F.when(i % 11 == 3, "Other Annals").otherwise(F.lower("journal")).alias("journal"),
        F.when(i % 13 == 5, F.array().cast("array<string>")).when(i % 17 == 6, F.array(F.lit("Nobody"))).otherwise(families).alias("families"), (F.col("publication_year") + (i % 7 == 2).cast("int")).alias("year"),
    )
    cited = r.select(i.alias("id"), _doi("doi").alias("doi"), "title", "journal", "authors", F.col("publication_year").alias("year"))
    return verify.verify_citations(cited, works).withColumnRenamed("id", "reading_id")


@add("j_ref", "WITH k AS (SELECT lower(regexp_replace(url, '[?#](?s:.)*$', '')) AS k, min(url) AS url FROM history WHERE url IS NOT NULL GROUP BY 1 HAVING count(DISTINCT url) = 1) SELECT summary_id, coalesce(k.url, s.url) AS resolved FROM summary s LEFT JOIN k ON k.k = lower(regexp_replace(s.url, '[?#](?s:.)*$', ''))")
def j_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants of an address resolved to the known one, where only one is known."""
    key = F.lower(F.regexp_replace("url", r"[?#][\s\S]*\z", ""))
    k = table(spark, sf_dir, "history").where("url is not null").groupBy(key.alias("k")).agg(F.min("url").alias("known"), F.max("url").alias("last")).where("known = last")
    return table(spark, sf_dir, "summary").select("summary_id", "url", key.alias("k")).join(k, "k", "left").select("summary_id", F.coalesce("known", "url").alias("resolved"))


@add("j_read", "WITH a AS (SELECT lower(title) AS t, lower(coalesce(doi, '')) AS d, max(reading_id) AS approved FROM readings WHERE kind = 'classic' GROUP BY 1, 2 HAVING count(*) = 1) SELECT r.reading_id, a.approved FROM readings r LEFT JOIN a ON a.t = lower(r.title) AND a.d = lower(coalesce(r.doi, ''))")
def j_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reading's approved twin by title and DOI in any case, where there is exactly one."""
    k = [F.lower("title").alias("t"), F.lower(blank("doi")).alias("d")]
    a = table(spark, sf_dir, "readings").where("kind = 'classic'").groupBy(*k).agg(F.max("reading_id").alias("approved"), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")
    return table(spark, sf_dir, "readings").select("reading_id", *k).join(a, ["t", "d"], "left").select("reading_id", "approved")


@add("j_decide", "SELECT s.summary_id, CASE WHEN d.url IS NOT NULL THEN 'selected_for_publication' ELSE s.decision END AS decision FROM summary s LEFT JOIN (SELECT DISTINCT url FROM digest_items) d ON d.url = s.url")
def j_decide(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "digest_items").where("url is not null").select("url", F.lit(True).alias("chosen")).distinct()
    s = table(spark, sf_dir, "summary").select("summary_id", "url", "decision")
    return s.join(d, "url", "left").select("summary_id", F.when(F.col("chosen"), "selected_for_publication").otherwise(F.col("decision")).alias("decision"))


@add("j_case", "SELECT DISTINCT s.summary_id FROM summary s WHERE s.url IN (SELECT url FROM candidates)")
def j_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known cases that the runs found."""
    return table(spark, sf_dir, "summary").select("summary_id", "url").join(table(spark, sf_dir, "candidates").select("url"), "url", "left_semi").select("summary_id")


@add("j_self", """WITH t AS (SELECT candidate_id AS id, run_id, list_sort(regexp_extract_all(lower(title), '[a-z0-9]+')) AS toks FROM candidates WHERE len(regexp_extract_all(lower(title), '[a-z0-9]+')) > 0), same AS (SELECT run_id, toks, min(id) AS first FROM t GROUP BY 1, 2),
  v AS (SELECT id, run_id, tok, count(*) AS n FROM (SELECT first AS id, run_id, unnest(toks) AS tok FROM same) GROUP BY 1, 2, 3), q AS (SELECT id, sum(n * n) AS sq FROM v GROUP BY 1), d AS (SELECT x.id AS a, y.id AS b, sum(x.n * y.n) AS dot FROM v x JOIN v y ON x.run_id = y.run_id AND x.tok = y.tok AND x.id < y.id GROUP BY 1, 2)
  SELECT a, b, round(dot / sqrt(qa.sq * qb.sq), 6) AS cosine FROM d JOIN q qa ON qa.id = a JOIN q qb ON qb.id = b WHERE dot / sqrt(qa.sq * qb.sq) > 0.85 UNION ALL SELECT first, id, 1.0 FROM t JOIN same USING (run_id, toks) WHERE id > first""")
def j_self(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents of a run with near titles (cosine over 0.85), each pair once."""
    c = table(spark, sf_dir, "candidates").select("candidate_id", "run_id", "title")
    return joins.near_titles(c, "candidate_id", "title", ["run_id"], 0.85)


@add("p_approved", "SELECT b.brief_id FROM news_briefs b WHERE b.url IN (SELECT url FROM history) AND b.source_org IN (SELECT name FROM sources)")
def p_approved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Briefs whose address is accepted and whose source is known, each by itself."""
    b = table(spark, sf_dir, "news_briefs").select("brief_id", "url", "source_org")
    return b.join(table(spark, sf_dir, "history").select("url"), "url", "left_semi").join(table(spark, sf_dir, "sources").select(F.col("name").alias("source_org")), "source_org", "left_semi").select("brief_id")


@add("p_dateconf", f"SELECT c.candidate_id FROM candidates c JOIN (SELECT url, min(published_date) AS page FROM history GROUP BY 1) h ON h.url = c.url WHERE {sql_iso('c.published_date')} <> page")
def p_dateconf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates dated otherwise than the record of the same address."""
    h = table(spark, sf_dir, "history").where("url is not null").groupBy("url").agg(F.min("published_date").alias("page"))
    return candidates(spark, sf_dir, "candidate_id", "url", "published_date").join(h, "url").where("published <> page").select("candidate_id")


# --- aggregates ------------------------------------------------------------------------------


@add("a_dec", "SELECT decision, count(*) AS n FROM summary GROUP BY 1")
def a_dec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "summary").groupBy("decision").agg(F.count(F.lit(1)).alias("n"))


@add("a_pub", "SELECT run_id, count(DISTINCT source_org) AS n_publishers FROM candidates GROUP BY 1")
def a_pub(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "candidates").groupBy("run_id").agg(F.countDistinct("source_org").alias("n_publishers"))


@add("a_chars", "SELECT run_id, sum(length(coalesce(title, '')) + length(coalesce(summary_hint, '')) + length(coalesce(full_text, '')))::BIGINT AS n_chars FROM candidates GROUP BY 1")
def a_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = reduce(Column.__add__, (F.length(blank(c)) for c in ("title", "summary_hint", "full_text")))
    return table(spark, sf_dir, "candidates").groupBy("run_id").agg(F.sum(n).alias("n_chars"))


@add("a_src", f"WITH {_KEYS} SELECT s.name AS source_name, count(*) AS n FROM candidates c JOIN keys ON {_BYKEY} JOIN sources s ON s.source_id = keys.source_id GROUP BY 1 ORDER BY n DESC, source_name")
def a_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "candidates").select(name_key("source_org").alias("name_key")).groupBy("name_key").agg(F.count(F.lit(1)).alias("n"))
    return c.join(_sources(spark, sf_dir), "name_key").groupBy("source_name").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "source_name")


@add("a_stats", f"WITH {SQL_C} SELECT source_org, count(*) AS fetched, count(*) FILTER (WHERE coalesce(summary_hint, '') <> '') AS with_text, count(*) FILTER (WHERE coalesce(summary_hint, '') <> '' AND published BETWEEN discovered_date - 21 AND discovered_date) AS in_window, array_to_string(list_sort(list(DISTINCT text_source)), ' ') AS text_sources FROM c GROUP BY 1")
def a_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = candidates(spark, sf_dir, "source_org", "summary_hint", "published_date", "discovered_date", "text_source")
    has = blank("summary_hint") != ""
    return c.groupBy("source_org").agg(F.count(F.lit(1)).alias("fetched"), F.count_if(has).alias("with_text"), F.count_if(has & F.expr("published between date_sub(discovered_date, 21) and discovered_date")).alias("in_window"), F.array_join(F.array_sort(F.collect_set("text_source")), " ").alias("text_sources"))


@add("a_dup", "SELECT run_id, round((count(url) - count(DISTINCT url)) / nullif(count(url), 0), 6) AS duplicate_rate FROM candidates GROUP BY 1")
def a_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "candidates").groupBy("run_id").agg(F.count("url").alias("n"), F.countDistinct("url").alias("d")).select("run_id", F.round(F.try_divide(F.col("n") - F.col("d"), F.col("n")), 6).alias("duplicate_rate"))


@add("a_cmp", f"WITH {SQL_C} SELECT 'narrow' AS setup, count(*) AS n, count(DISTINCT source_org) AS publishers FROM c WHERE published IS NULL OR published BETWEEN discovered_date - 7 AND discovered_date UNION ALL SELECT 'wide', count(*), count(DISTINCT source_org) FROM c WHERE published BETWEEN discovered_date - 21 AND discovered_date")
def a_cmp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two set-ups on one input, in one pass."""
    c = candidates(spark, sf_dir, "source_org", "published_date", "discovered_date")
    narrow, wide = F.expr("published is null or published between date_sub(discovered_date, 7) and discovered_date"), F.expr("published between date_sub(discovered_date, 21) and discovered_date")
    tagged = c.select("source_org", F.explode(F.array_compact(F.array(F.when(narrow, "narrow"), F.when(wide, "wide")))).alias("setup"))
    return tagged.groupBy("setup").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("source_org").alias("publishers"))


@add("a_topic", "SELECT digest_date, tag, count(*) AS n, row_number() OVER (PARTITION BY digest_date ORDER BY count(*) DESC, tag) AS place FROM (SELECT digest_date, unnest(tags) AS tag FROM digest_items) WHERE tag IS NOT NULL GROUP BY 1, 2")
def a_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "digest_items").select("digest_date", F.explode("tags").alias("tag")).where("tag is not null").groupBy("digest_date", "tag").agg(F.count(F.lit(1)).alias("n"))
    return t.withColumn("place", F.row_number().over(Window.partitionBy("digest_date").orderBy(F.desc("n"), "tag")).cast("long"))


_STOP = "what,means,pays,with,from,support,that,over"


@add("a_terms", f"WITH w AS (SELECT candidate_id, unnest(regexp_extract_all(lower(title), '[a-z]{{4,}}')) AS term FROM candidates) SELECT term, count(*) AS n FROM w WHERE term NOT IN ({', '.join(repr(x) for x in _STOP.split(','))}) GROUP BY 1 ORDER BY n DESC, min(candidate_id), term LIMIT 14")
def a_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fourteen commonest title terms; of equals the one seen first."""
    w = table(spark, sf_dir, "candidates").select("candidate_id", F.explode(F.regexp_extract_all(F.lower("title"), F.lit("[a-z]{4,}"), F.lit(0))).alias("term")).where(~F.col("term").isin(*_STOP.split(",")))
    return w.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.min("candidate_id").alias("seen")).orderBy(F.desc("n"), "seen", "term").limit(14).select("term", "n")


@add("a_evid", "WITH e AS (SELECT candidate_id, event_id, unnest(evidence) AS e FROM candidates WHERE event_id IS NOT NULL) SELECT event_id, count(*) AS n_evidence, count(DISTINCT e.url) AS n_documents, arg_min(e.publisher, candidate_id) AS first_publisher FROM e GROUP BY 1")
def a_evid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence gathered over an event's reports."""
    e = table(spark, sf_dir, "candidates").where("event_id is not null").select("candidate_id", "event_id", F.explode("evidence").alias("e"))
    return e.groupBy("event_id").agg(F.count(F.lit(1)).alias("n_evidence"), F.countDistinct("e.url").alias("n_documents"), F.min_by("e.publisher", "candidate_id").alias("first_publisher"))


@add("a_cover", "SELECT d.digest_date, count(*) AS n_items, count(b.url) AS n_supported, count(b.url) >= 2 AND count(b.url) > count(*) / 2 AS covered FROM (SELECT DISTINCT digest_date, url FROM digest_items WHERE url IS NOT NULL AND digest_date IS NOT NULL) d LEFT JOIN (SELECT DISTINCT url FROM news_briefs) b ON b.url = d.url GROUP BY 1")
def a_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "digest_items").where("url is not null and digest_date is not null").select("digest_date", "url").distinct()
    b = table(spark, sf_dir, "news_briefs").select("url", F.lit(1).alias("hit")).distinct()
    a = d.join(b, "url", "left").groupBy("digest_date").agg(F.count(F.lit(1)).alias("n_items"), F.count("hit").alias("n_supported"))
    return a.withColumn("covered", (F.col("n_supported") >= 2) & (F.col("n_supported") > F.col("n_items") / 2))


@add("a_week", f"WITH {SQL_C}, w AS (SELECT DISTINCT date_trunc('week', discovered_date)::DATE + 6 AS week_end FROM c WHERE discovered_date IS NOT NULL) SELECT week_end, count(published) AS known, count(*) FILTER (WHERE published BETWEEN week_end - 21 AND week_end) AS in_window FROM w LEFT JOIN c ON published <= week_end GROUP BY 1")
def a_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As-of replay by week: what was known and what was in the window. One count a day, then running sums: no week sees all rows."""
    c = candidates(spark, sf_dir, "published_date", "discovered_date")
    per_day = c.where("published is not null").groupBy("published").agg(F.count(F.lit(1)).alias("n"))
    weeks = c.where("discovered_date is not null").select(F.date_add(F.date_trunc("week", "discovered_date").cast("date"), 6).alias("week_end")).distinct()
    # days and weeks are calendar-bounded
    hit = weeks.join(F.broadcast(per_day), F.col("published") <= F.col("week_end"), "left")
    return hit.groupBy("week_end").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("known"), F.coalesce(F.sum(F.when(F.expr("published >= date_sub(week_end, 21)"), F.col("n"))), F.lit(0)).alias("in_window"))


@add("a_items", "SELECT digest_date, (SELECT count(*) FROM digest_items d WHERE d.digest_date = a.digest_date) + (SELECT count(*) FROM news_briefs b WHERE b.digest_date = a.digest_date) AS n_items FROM (SELECT DISTINCT digest_date FROM digest_items WHERE digest_date IS NOT NULL UNION SELECT DISTINCT digest_date FROM news_briefs WHERE digest_date IS NOT NULL) a")
def a_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "digest_items").select("digest_date").unionAll(table(spark, sf_dir, "news_briefs").select("digest_date"))
    return both.where("digest_date is not null").groupBy("digest_date").agg(F.count(F.lit(1)).alias("n_items"))


# --- validation ------------------------------------------------------------------------------

_PLACEHOLDER = r"(?i)reports a relevant development|published a new item related to|lorem ipsum|\bTBD\b"


@add("v_text", rf"WITH v AS (SELECT item_id, unnest([{{'f': 'core_argument_en', 'v': core_argument_en}}, {{'f': 'why_now_en', 'v': why_now_en}}, {{'f': 'title_en', 'v': title_en}}]) AS x FROM digest_items), r AS (SELECT item_id, x.f AS field, CASE WHEN coalesce(trim(x.v), '') = '' THEN 'missing' WHEN regexp_matches(x.v, '{_PLACEHOLDER}') THEN 'placeholder' WHEN regexp_matches(rtrim(x.v), '(…|\.\.\.)$') THEN 'truncated' END AS rule FROM v) SELECT item_id, field, rule FROM r WHERE rule IS NOT NULL")
def v_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of required texts: one row for an item, field and rule."""
    fields = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("v")) for c in ("core_argument_en", "why_now_en", "title_en")))).alias("x")
    rule = F.when(F.coalesce(F.trim("x.v"), F.lit("")) == "", "missing").when(F.col("x.v").rlike(_PLACEHOLDER), "placeholder").when(F.rtrim("x.v").rlike(r"(…|\.\.\.)\z"), "truncated")
    return table(spark, sf_dir, "digest_items").select("item_id", fields).select("item_id", "x.field", rule.alias("rule")).where("rule is not null")


@add("v_says", r"SELECT item_id FROM digest_items WHERE regexp_matches(lower(title_en), '^(the )?' || regexp_replace(lower(source_org), '([^\p{L}\p{N} ])', '\\\1', 'g') || ' (says|reports|argues|frames)\b')")
def v_says(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headlines of the form "publisher says"."""
    head = F.regexp_replace(F.lower("title_en"), "^the ", "")
    starts = F.startswith(head, F.lower("source_org")) & F.substring(head, F.length("source_org") + 1, F.lit(99)).rlike(r"^ (says|reports|argues|frames)\b")
    return table(spark, sf_dir, "digest_items").where(starts).select("item_id")


@add("v_core", r"SELECT item_id FROM digest_items WHERE regexp_replace(lower(core_argument_en), '[^\p{L}\p{N}_]+', '', 'g') = regexp_replace(lower(title_en), '[^\p{L}\p{N}_]+', '', 'g') OR coalesce(core_argument_en, '') = ''")
def v_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "digest_items").where((text.comparison_key("core_argument_en") == text.comparison_key("title_en")) | (blank("core_argument_en") == "")).select("item_id")


@add("v_title", r"SELECT item_id, NOT (len(regexp_extract_all(title_en, '[^ ]+')) BETWEEN 6 AND 16) AS bad_length, NOT (regexp_matches(title_en, '\p{L}') AND NOT regexp_matches(regexp_replace(title_en, '\p{Latin}', '', 'g'), '\p{L}')) AS not_latin FROM digest_items WHERE title_en IS NOT NULL")
def v_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.regexp_count("title_en", F.lit("[^ ]+"))
    return table(spark, sf_dir, "digest_items").where("title_en is not null").select("item_id", (~n.between(6, 16)).alias("bad_length"), (~text.is_latin_title("title_en")).alias("not_latin"))


@add("v_method", r"SELECT reading_id FROM readings WHERE regexp_matches(abstract_en, '(?i)regression|interviews|randomi[sz]ed|voted|tested') AND regexp_matches(note_en, '(?i)does not (?:provide|specify|identify)|not specified|without a vote')")
def v_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes that deny what the abstract states."""
    r = table(spark, sf_dir, "readings")
    return r.where(F.col("abstract_en").rlike("(?i)regression|interviews|randomi[sz]ed|voted|tested") & F.col("note_en").rlike("(?i)does not (?:provide|specify|identify)|not specified|without a vote")).select("reading_id")


@add("v_pub", "SELECT d.digest_date, string_agg(DISTINCT rule, ' ' ORDER BY rule) AS rules FROM (SELECT digest_date, 'no_source' AS rule FROM digest_items WHERE source_org IS NULL UNION ALL SELECT digest_date, 'unknown_url' FROM digest_items i WHERE NOT EXISTS (SELECT 1 FROM history h WHERE h.url = i.url) UNION ALL SELECT digest_date, 'repeated_url' FROM digest_items WHERE url IS NOT NULL GROUP BY digest_date, url HAVING count(*) > 1) d WHERE digest_date IS NOT NULL GROUP BY 1")
def v_pub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules an issue breaks, gathered from its items."""
    d = table(spark, sf_dir, "digest_items").where("digest_date is not null").select("digest_date", "url", "source_org")
    a = d.where("source_org is null").select("digest_date", F.lit("no_source").alias("rule"))
    b = d.join(table(spark, sf_dir, "history").select("url"), "url", "left_anti").select("digest_date", F.lit("unknown_url").alias("rule"))
    c = d.where("url is not null").groupBy("digest_date", "url").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest_date", F.lit("repeated_url").alias("rule"))
    return a.union(b).union(c).groupBy("digest_date").agg(F.array_join(F.array_sort(F.collect_set("rule")), " ").alias("rules"))


@add("v_url", r"SELECT candidate_id FROM candidates WHERE url IS NOT NULL AND NOT regexp_matches(url, '^https?://[A-Za-z0-9.\-]+(:(80|443))?([/?#]|$)')")
def v_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses that aren't plain web addresses: scheme, host without credentials, usual port."""
    return table(spark, sf_dir, "candidates").where(F.col("url").isNotNull() & ~F.col("url").rlike(r"^https?://[A-Za-z0-9.\-]+(:(80|443))?([/?#]|\z)")).select("candidate_id")


STAGES = (("scheduled", "scheduled|upcoming|will be held|registration"), ("outcome", "voted to|agreed to|signed off|rejected|endorsed"), ("completed", "concluded|convened|took place"), ("subsequent_development", "revised|recalculated|broadened"))


@add("f_stage", "SELECT candidate_id, CASE " + " ".join(f"WHEN regexp_matches(lower(concat_ws(' ', title, summary_hint)), '{p}') THEN '{s}'" for s, p in STAGES) + " ELSE 'unknown' END AS stage FROM candidates")
def f_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stage a text claims, by the first rule that holds."""
    body = F.lower(F.concat_ws(" ", "title", "summary_hint"))
    stage = reduce(lambda w, r: w.when(body.rlike(r[1]), r[0]), STAGES[1:], F.when(body.rlike(STAGES[0][1]), STAGES[0][0])).otherwise("unknown")
    return table(spark, sf_dir, "candidates").select("candidate_id", stage.alias("stage"))


@add("f_layer", r"SELECT candidate_id, CASE WHEN regexp_matches(title, '(?i)\b(meeting|dialogue|session|negotiations?|workshop|summit)\b') THEN 'event' WHEN regexp_matches(title, '(?i)\b(analysis|research|study|findings|explained|monitor)\b') THEN 'research' ELSE layer END AS layer FROM candidates")
def f_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("title")
    layer = F.when(t.rlike(r"(?i)\b(meeting|dialogue|session|negotiations?|workshop|summit)\b"), "event").when(t.rlike(r"(?i)\b(analysis|research|study|findings|explained|monitor)\b"), "research").otherwise(F.col("layer"))
    return table(spark, sf_dir, "candidates").select("candidate_id", layer.alias("layer"))


@add("f_eventid", f"WITH e AS (SELECT candidate_id, coalesce(event_name, title) AS name, strftime(discovered_date, '%Y') AS y FROM candidates WHERE discovered_date IS NOT NULL) SELECT candidate_id, CASE WHEN regexp_matches(name, '\\b[A-Z]{{2,8}}[-– ]\\d{{1,3}}\\b') THEN lower(regexp_extract(name, '\\b([A-Z]{{2,8}})[-– ](\\d{{1,3}})\\b', 1)) || '-' || regexp_extract(name, '\\b([A-Z]{{2,8}})[-– ](\\d{{1,3}})\\b', 2) || ':' || y ELSE 'event:' || {sql_fingerprint('trim(regexp_replace(lower(coalesce(name, chr(0))), chr(91) || chr(94) || chr(92) || chr(112) || chr(123) || chr(76) || chr(125) || chr(92) || chr(112) || chr(123) || chr(78) || chr(125) || chr(95) || chr(93) || chr(43), chr(32), chr(103))) || chr(58) || y')} END AS event_key FROM e WHERE name IS NOT NULL")
def f_eventid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A session's code and year, else a fingerprint of the name's words and the year."""
    c = table(spark, sf_dir, "candidates").where("discovered_date is not null").select("candidate_id", F.coalesce("event_name", "title").alias("name"), F.date_format("discovered_date", "yyyy").alias("y")).where("name is not null")
    p = r"\b([A-Z]{2,8})[-– ](\d{1,3})\b"
    code = F.concat(F.lower(F.regexp_extract("name", p, 1)), F.lit("-"), F.regexp_extract("name", p, 2), F.lit(":"), F.col("y"))
    plain = F.concat(F.trim(F.regexp_replace(F.lower("name"), r"[^\p{L}\p{N}_]+", " ")), F.lit(":"), F.col("y"))
    return c.select("candidate_id", F.when(F.col("name").rlike(p), code).otherwise(F.concat(F.lit("event:"), text.fingerprint(plain))).alias("event_key"))



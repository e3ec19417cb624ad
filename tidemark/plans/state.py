"""Queries on state, crawls, de-duplication and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text, urls
from tidemark.functions.dates import iso_prefix
from tidemark.operators import crawl, dedup, events, joins, state, verdict
from tidemark.operators.position import with_position
from tidemark.operators.ranking import nth
from tidemark.plans.base import FITTED, blank, candidates
from tidemark.plans.common import Registry, sql_fingerprint, sql_iso
from tidemark.plans.filters import SQL as FILTERS
from tidemark.plans.filters import j_prior, p_evid, p_temporal
from tidemark.plans.ranking import score_of, sql_assess
from tidemark.runtime import cut_lineage, table

add = Registry()
QUERIES, SQL = add.queries, add.sql
TODAY = "2024-12-15"


def _today():  # noqa: ANN202
    return F.lit(TODAY).cast("date")


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = table(spark, sf_dir, "history").where("url is not null")
    one = h.groupBy(F.col("url").alias("key")).agg(F.max_by(F.struct("event_id", "fingerprint", "stage", F.col("published_date").alias("published"), "last_seen", F.coalesce("published_versions", F.array().cast("array<string>")).alias("versions")), "history_id").alias("h"))
    return one.select("key", "h.*")


def _seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = candidates(spark, sf_dir, "candidate_id", "url", "event_id", "content_fingerprint", "development_stage", "published_date", "modified_date")
    return c.where("url is not null").select(F.col("candidate_id").alias("place"), F.col("url").alias("key"), "event_id", F.col("content_fingerprint").alias("fingerprint"), F.col("development_stage").alias("stage"), "published", iso_prefix("modified_date").alias("modified"))


_H = "h AS (SELECT url AS key, arg_max(h, history_id) AS h FROM (SELECT url, history_id, {'event_id': event_id, 'fingerprint': fingerprint, 'stage': stage, 'published': published_date, 'last_seen': last_seen, 'versions': coalesce(published_versions, [])} AS h FROM history) WHERE url IS NOT NULL GROUP BY 1)"
_N = f"n AS (SELECT url AS key, arg_max(n, candidate_id) AS n FROM (SELECT url, candidate_id, {{'event_id': event_id, 'fingerprint': content_fingerprint, 'stage': development_stage, 'published': {sql_iso('published_date')}}} AS n FROM candidates) WHERE url IS NOT NULL GROUP BY 1)"


@add("t_remember", f"WITH {_H}, {_N}, m AS (SELECT coalesce(h.key, n.key) AS key, CASE WHEN n.key IS NOT NULL THEN n.n.event_id ELSE h.h.event_id END AS event_id, CASE WHEN n.key IS NOT NULL THEN n.n.fingerprint ELSE h.h.fingerprint END AS fingerprint, CASE WHEN n.key IS NOT NULL THEN n.n.stage ELSE h.h.stage END AS stage, CASE WHEN n.key IS NOT NULL THEN n.n.published ELSE h.h.published END AS published, CASE WHEN n.key IS NOT NULL THEN DATE '{TODAY}' ELSE h.h.last_seen END AS last_seen FROM h FULL JOIN n ON h.key = n.key) SELECT * FROM m WHERE last_seen >= DATE '{TODAY}' - 120")
def t_remember(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History after a run: seen rows merged in, what is too old left out."""
    return state.remember(_history(spark, sf_dir), _seen(spark, sf_dir), _today()).drop("versions")


@add("t_revision", f"WITH {_H} SELECT c.candidate_id AS place, coalesce(h.h.fingerprint <> c.content_fingerprint AND c.development_stage IN ('outcome', 'subsequent_development'), false) AS changed, CASE WHEN coalesce(h.h.fingerprint <> c.content_fingerprint AND c.development_stage IN ('outcome', 'subsequent_development'), false) AND {sql_iso('c.modified_date')} IS NOT NULL THEN {sql_iso('c.modified_date')} ELSE {sql_iso('c.published_date')} END AS date_key FROM candidates c LEFT JOIN h ON h.key = c.url WHERE c.url IS NOT NULL")
def t_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.revision(_seen(spark, sf_dir), _history(spark, sf_dir)).select("place", "changed", "date_key")


@add("t_dedupver", f"WITH {_H} SELECT c.candidate_id FROM candidates c JOIN h ON h.key = c.url WHERE list_contains(h.h.versions, c.content_fingerprint) OR h.h.fingerprint = c.content_fingerprint")
def t_dedupver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of an address that were published before."""
    h = _history(spark, sf_dir).select("key", "versions", F.col("fingerprint").alias("kept"))
    return _seen(spark, sf_dir).join(h, "key").where("array_contains(versions, fingerprint) or kept = fingerprint").select(F.col("place").alias("candidate_id"))


@add("t_finalize", f"WITH {_H}, p AS (SELECT url AS key, max(content_fingerprint) AS fp FROM candidates WHERE url IS NOT NULL AND semantic_score >= 7 AND content_fingerprint IS NOT NULL GROUP BY 1) SELECT h.key, array_to_string((CASE WHEN p.key IS NULL THEN h.h.versions WHEN list_contains(h.h.versions, p.fp) THEN h.h.versions ELSE list_append(h.h.versions, p.fp) END)[-10:], ' ') AS versions FROM h LEFT JOIN p ON p.key = h.key")
def t_finalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions after the best candidates were published."""
    c = table(spark, sf_dir, "candidates").where("url is not null and semantic_score >= 7 and content_fingerprint is not null")
    p = c.select(F.col("url").alias("key"), F.col("content_fingerprint").alias("fingerprint"), F.col("development_stage").alias("stage"))
    return state.finalize(_history(spark, sf_dir), p).select("key", F.array_join("versions", " ").alias("versions"))


@add("t_register", "WITH o AS (SELECT provenance_url AS key, candidate_id, discovery_method, reliability, url FROM candidates WHERE provenance_url IS NOT NULL) SELECT key, arg_min(discovery_method, candidate_id) AS method, arg_min(reliability, candidate_id) AS reliability, count(DISTINCT url) AS n_provenances, bool_or(coalesce(reliability = 'primary', false)) AS verified FROM (SELECT * FROM o) GROUP BY 1")
def t_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry of endpoints after all runs."""
    c = table(spark, sf_dir, "candidates").where("provenance_url is not null").select(F.col("provenance_url").alias("key"), F.col("candidate_id").alias("place"), F.col("discovery_method").alias("method"), "reliability", F.col("url").alias("provenance"), (blank("reliability") == "primary").alias("verified"))
    return state.register(c).select("key", "method", "reliability", F.size("provenances").cast("long").alias("n_provenances"), "verified")


@add("t_retainq", f"SELECT url FROM history WHERE last_seen >= DATE '{TODAY}' - 60 AND url IS NOT NULL UNION SELECT url FROM sources WHERE strategy = 'rss'")
def t_retainq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What re-enters the frontier: recent history and registered endpoints."""
    h = table(spark, sf_dir, "history").where(F.col("url").isNotNull() & (F.col("last_seen") >= F.date_sub(_today(), 60))).select("url")
    return h.unionByName(table(spark, sf_dir, "sources").where("strategy = 'rss'").select("url")).distinct()


_ROLL = "WITH e AS (SELECT digest_date, url, row_number() OVER (PARTITION BY url ORDER BY digest_date, id) AS n, id FROM (SELECT digest_date, url, item_id AS id FROM digest_items UNION ALL SELECT digest_date, url, brief_id FROM news_briefs) WHERE coalesce(url, '') <> '' AND digest_date IS NOT NULL)"


@add("t_roll", f"{_ROLL} SELECT url, digest_date FROM e WHERE n = 1 ORDER BY digest_date DESC, id DESC, url DESC LIMIT 500")
def t_roll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sent record: each address once, by its first issue, the last 500."""
    a = table(spark, sf_dir, "digest_items").select("digest_date", "url", F.col("item_id").alias("id")).unionByName(table(spark, sf_dir, "news_briefs").select("digest_date", "url", F.col("brief_id").alias("id")))
    a = a.where("coalesce(url, '') <> '' and digest_date is not null").groupBy("url").agg(F.min(F.struct("digest_date", "id")).alias("f"))
    return a.select("url", "f.*").orderBy(F.desc("digest_date"), F.desc("id"), F.desc("url")).limit(500).select("url", "digest_date")


@add("t_budget", "WITH h AS (SELECT candidate_id, provenance_url, row_number() OVER (PARTITION BY provenance_url ORDER BY candidate_id) AS n FROM candidates WHERE provenance_url IS NOT NULL) SELECT candidate_id FROM h WHERE n <= 30 ORDER BY candidate_id LIMIT 120")
def t_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests admitted: thirty to a host, a hundred and twenty in all."""
    c = table(spark, sf_dir, "candidates").where("provenance_url is not null").select("candidate_id", "provenance_url")
    return crawl.within_budget(c, [F.asc("candidate_id")], 120, "provenance_url", 30).select("candidate_id")


@add("t_reserve", "WITH h AS (SELECT candidate_id, provenance_url, row_number() OVER (PARTITION BY provenance_url ORDER BY candidate_id) AS n FROM candidates WHERE provenance_url IS NOT NULL) SELECT candidate_id FROM h WHERE n <= 20 ORDER BY candidate_id LIMIT 100")
def t_reserve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests admitted while twenty are kept back for evidence, ten of them from each host."""
    c = table(spark, sf_dir, "candidates").where("provenance_url is not null").select("candidate_id", "provenance_url")
    return crawl.within_budget(c, [F.asc("candidate_id")], 120, "provenance_url", 30, evidence=20).select("candidate_id")


@add("t_evbudget", "SELECT candidate_id FROM (SELECT candidate_id, row_number() OVER (PARTITION BY run_id ORDER BY coalesce(semantic_score, 0) DESC, candidate_id) AS n FROM candidates WHERE coalesce(full_text, '') = '' OR coalesce(published_date, '') = '') WHERE n <= 20")
def t_evbudget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each run, the first twenty that need retrieval, in order of significance."""
    c = table(spark, sf_dir, "candidates").where((blank("full_text") == "") | (blank("published_date") == "")).select("candidate_id", "run_id", F.coalesce("semantic_score", F.lit(0)).alias("s"))
    return c.withColumn("n", nth(["run_id"], [F.desc("s"), F.asc("candidate_id")])).where("n <= 20").select("candidate_id")


@add("t_searchtrig", "SELECT candidate_id, event_name FROM candidates WHERE development_stage <> 'unknown' AND event_name IS NOT NULL ORDER BY coalesce(semantic_score, 0) DESC, candidate_id LIMIT 4")
def t_searchtrig(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "candidates").where("development_stage <> 'unknown' and event_name is not null").select("candidate_id", "event_name", F.coalesce("semantic_score", F.lit(0)).alias("s"))
    return c.orderBy(F.desc("s"), "candidate_id").limit(4).select("candidate_id", "event_name")


@add("t_future", f"SELECT candidate_id FROM candidates WHERE {sql_iso('published_date')} > discovered_date OR {sql_iso('modified_date')} > discovered_date")
def t_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = candidates(spark, sf_dir, "candidate_id", "published_date", "modified_date", "discovered_date").withColumn("modified", iso_prefix("modified_date"))
    return c.where("published > discovered_date or modified > discovered_date").select("candidate_id")


@add("t_late", f"SELECT candidate_id, date_diff('day', {sql_iso('event_date')}, {sql_iso('published_date')}) AS days_after FROM candidates WHERE {sql_iso('published_date')} > {sql_iso('event_date')}")
def t_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports that came after their event, timed by publication."""
    c = candidates(spark, sf_dir, "candidate_id", "published_date", "event_date").withColumn("event", iso_prefix("event_date"))
    return c.where("published > event").select("candidate_id", F.date_diff("published", "event").cast("long").alias("days_after"))


_BFS = """WITH RECURSIVE l AS (SELECT parent, url, min(summary_id) AS place FROM summary WHERE parent IS NOT NULL AND url IS NOT NULL GROUP BY 1, 2), n AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY place, url) AS n FROM l),
 w(url, depth) AS (SELECT DISTINCT url, 0 FROM sources WHERE url IS NOT NULL UNION SELECT DISTINCT regexp_replace(url, 'feed$', ''), 0 FROM sources WHERE url IS NOT NULL UNION SELECT n.url, w.depth + 1 FROM w JOIN n ON n.parent = w.url WHERE n.n <= 25 AND w.depth < 2) SELECT url, min(depth) AS depth FROM w GROUP BY 1"""


@add("t_bfs", _BFS)
def t_bfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages reached from the registered sites within two links, twenty-five links of a page at most."""
    s = table(spark, sf_dir, "sources").where("url is not null")
    seeds = s.select("url").unionByName(s.select(F.regexp_replace("url", r"feed\z", "").alias("url")))
    links = table(spark, sf_dir, "summary").where("parent is not null and url is not null").groupBy("parent", "url").agg(F.min("summary_id").alias("place"))
    return crawl.walk(seeds, links)[0].select("url", "depth")


@add("t_asof", f"WITH r AS (SELECT run_id, max(discovered_date) AS d FROM candidates GROUP BY 1) SELECT run_id, d AS run_date, (SELECT count(*) FROM history h WHERE h.published_date <= d) AS known FROM r WHERE d IS NOT NULL")
def t_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of history each run could have known: counts of days, summed up to each run's day."""
    r = table(spark, sf_dir, "candidates").groupBy("run_id").agg(F.max("discovered_date").alias("run_date")).where("run_date is not null")
    per_day = table(spark, sf_dir, "history").where("published_date is not null").groupBy(F.col("published_date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    days = r.select("run_date").distinct().join(F.broadcast(per_day), F.col("day") <= F.col("run_date"), "left").groupBy("run_date").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("known"))  # as many rows as there are days
    return r.join(days, "run_date").select("run_id", "run_date", "known")


@add("t_redir", r"SELECT summary_id, regexp_replace(lower(regexp_extract(url, '^[^/]*//([^/?#]*)', 1)), '^www\.', '') <> regexp_replace(lower(regexp_extract(parent, '^[^/]*//([^/?#]*)', 1)), '^www\.', '') AS changes_host FROM summary WHERE url LIKE 'http%' AND parent LIKE 'http%'")
def t_redir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an address lies on another host than the page that led to it, whose standing it then doesn't inherit."""
    bare = lambda c: F.regexp_replace(F.lower(F.regexp_extract(c, "^[^/]*//([^/?#]*)", 1)), r"^www\.", "")
    return table(spark, sf_dir, "summary").where("url like 'http%' and parent like 'http%'").select("summary_id", (bare("url") != bare("parent")).alias("changes_host"))


@add("m_audit", f"SELECT candidate_id, {sql_fingerprint('coalesce(url, chr(32)) || chr(32) || coalesce(content_fingerprint, chr(32)) || chr(32) || candidate_id')} AS audit_id FROM candidates")
def m_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One audit id for each document by address, content and place of arrival."""
    s = lambda c: F.coalesce(c, F.lit(" "))
    return table(spark, sf_dir, "candidates").select("candidate_id", text.fingerprint(F.concat_ws(" ", s("url"), s("content_fingerprint"), F.col("candidate_id").cast("string"))).alias("audit_id"))


@add("m_decide", "SELECT decision, count(*) AS n FROM summary WHERE decision NOT IN ('selected', 'deduplication', 'low_substantive_relevance', 'insufficient_evidence', 'outside_temporal_scope', 'lower_editorial_priority') OR decision IS NULL GROUP BY 1")
def m_decide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions outside the enumeration."""
    ok = F.coalesce(F.col("decision").isin("selected", "deduplication", "low_substantive_relevance", "insufficient_evidence", "outside_temporal_scope", "lower_editorial_priority"), F.lit(False))
    return table(spark, sf_dir, "summary").where(~ok).groupBy("decision").agg(F.count(F.lit(1)).alias("n"))


@add("m_fail", "SELECT candidate_id AS id, 'missing_url' AS reason FROM candidates WHERE url IS NULL UNION ALL SELECT candidate_id, 'missing_title' FROM candidates WHERE title IS NULL UNION ALL SELECT summary_id, 'missing_parent' FROM summary WHERE parent IS NULL")
def m_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "candidates")
    gone = lambda df, i, col, r: df.where(F.col(col).isNull()).select(F.col(i).alias("id"), F.lit(r).alias("reason"))
    return gone(c, "candidate_id", "url", "missing_url").unionByName(gone(c, "candidate_id", "title", "missing_title")).unionByName(gone(table(spark, sf_dir, "summary"), "summary_id", "parent", "missing_parent"))


@add("o_greedy")
def o_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each run, candidates that neither repeat a kept one's address nor come near its title, in order of arrival."""
    c = table(spark, sf_dir, "candidates").select(F.col("candidate_id").alias("id"), "run_id", urls.bare_url("url").alias("k"), "title")
    near = joins.near_titles(c, "id", "title", ["run_id"], 0.85)
    toks = text.title_tokens("title")
    tokens = c.where(F.size(toks) > 0).select("id", "run_id", F.array_join(F.array_sort(toks), " ").alias("k"))
    by_title = tokens.join(tokens.groupBy("run_id", "k").agg(F.min("id").alias("first")), ["run_id", "k"]).select("id", F.concat(F.lit("t"), "first").alias("cls"))
    by_url = c.where("k is not null").select("id", F.concat_ws(" ", F.lit("u"), "run_id", "k").alias("cls"))
    # a near pair names the first rows of two titles, and so their classes
    links = near.select(F.concat(F.lit("t"), "a").alias("a"), F.concat(F.lit("t"), "b").alias("b"))
    members = by_title.unionByName(by_url).unionByName(c.select("id", F.lit(None).cast("string").alias("cls")))
    return dedup.greedy_keep(members, links).select(F.col("id").alias("candidate_id"))


def _event_id(name: Column, year: Column, url: Column) -> Column:
    """A session's code and year, else a fingerprint of the name, or the address, and the year."""
    p = r"(?U)\b([A-Z]{2,8})[-– ](\d{1,3})\b"
    code = F.concat(F.lower(F.regexp_extract(name, p, 1)), F.lit("-"), F.regexp_extract(name, p, 2), F.lit(":"), year)
    bare = F.regexp_replace(F.lower(name), r"^(?:concept note and |concept note |agenda (?:of|for) (?:the )?|summary (?:of|report on) )+", "")
    plain = F.trim(F.regexp_replace(bare, r"(?U)[^\w]+", " "))
    return F.when(name.rlike(p), code).otherwise(F.concat(F.lit("event:"), text.fingerprint(F.concat(F.when(plain != "", plain).otherwise(F.coalesce(url, F.lit(""))), F.lit(":"), year))))


def _eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates that are relevant, in scope, supported, not scheduled and not published before, as reports placed by assessment."""
    c = candidates(spark, sf_dir, "candidate_id", "url", "event_id", "event_name", "title", "published_date", "event_date", "modified_date", "development_stage", "content_fingerprint", "summary_hint", "full_text", "reliability")
    c = c.where(blank("development_stage") != "scheduled").withColumn("key", urls.canonical_url("url"))
    c = c.join(p_temporal(spark, sf_dir).where("verdict = 'in_scope'"), "candidate_id", "left_semi")
    c = c.join(p_evid(spark, sf_dir).where("evidence = 'supported'"), "candidate_id", "left_semi").join(j_prior(spark, sf_dir), "candidate_id", "left_anti")
    versions = table(spark, sf_dir, "history").select(urls.canonical_url("url").alias("key"), F.explode("published_versions").alias("content_fingerprint"))
    c = c.join(versions, ["key", "content_fingerprint"], "left_anti")
    # assessed last, as that reads whole texts
    c = cut_lineage(c.withColumn("a", score_of(FITTED))).where("a.substantive and a.score >= 4").withColumn("score", F.col("a.score"))
    # as on arrival: a document without an event is named by a session's code near its head, or its title
    body = F.concat_ws(" ", blank("title"), F.when(blank("full_text") != "", F.col("full_text")).otherwise(blank("summary_hint")))
    code = F.regexp_extract(F.substring(body, 1, 1500), r"(?U)\b[A-Z]{2,8}[-–]\d{1,3}\b", 0)
    own = F.when(blank("event_name") != "", F.col("event_name")).otherwise(blank("title"))
    name = F.when((blank("event_id") == "") & (own == blank("title")) & (code != ""), code).otherwise(own)
    year = F.coalesce(F.date_format(F.coalesce(iso_prefix("event_date"), F.col("published")), "yyyy"), F.lit(""))
    event_id = F.when(blank("event_id") != "", F.col("event_id")).otherwise(_event_id(name, year, F.col("key")))
    pool = c.select(
        F.col("candidate_id").alias("id"), "score", (blank("reliability") == "primary").alias("primary"), F.col("key").alias("url_key"), event_id.alias("event_id"), name.alias("name"), "published",
        iso_prefix("modified_date").alias("modified"), F.col("development_stage").alias("stage"), F.col("content_fingerprint").alias("fingerprint"), F.col("summary_hint").alias("summary"),
    )
    return with_position(pool, [F.desc("score"), F.desc("primary"), F.asc("id")], "place").drop("score", "primary")


#: Rules whose SQL differs between the two dialects.
SQL_RULES = {"outside_rolling_publication_window": "not upcoming and dated < run_date - {window}"}


def _sql_evaluate() -> str:
    rules = lambda k: " ".join(f"WHEN coalesce({SQL_RULES.get(r[1], r[2]).format(threshold=4, window=21)}, false) THEN '{r[k]}'" for r in verdict.RULES)
    return f"""WITH a AS ({sql_assess(FITTED)}), c AS (SELECT *, discovered_date AS run_date, {sql_iso('published_date')} AS published, {sql_iso('modified_date')} AS modified, {sql_iso('event_date')} AS event, development_stage AS stage,
      coalesce(full_text, '') <> '' AS has_full_text, coalesce(summary_hint, '') <> '' AS has_summary FROM candidates),
    h AS (SELECT url, arg_min(fingerprint, history_id) AS fingerprint, min(published_date) AS page_date FROM history WHERE url IS NOT NULL GROUP BY 1), v AS (SELECT DISTINCT url, unnest(published_versions) AS f FROM history),
    p AS ({FILTERS['j_prior']}), s AS (SELECT url FROM digest_items UNION SELECT url FROM news_briefs),
    x AS (SELECT c.*, a.substantive, a.score, h.page_date, p.candidate_id IS NOT NULL AS prior_event, s.url IS NOT NULL AS sent, v.url IS NOT NULL AS known_version,
      coalesce(h.url IS NOT NULL AND NOT coalesce(h.fingerprint = c.content_fingerprint, false) AND stage IN ('outcome', 'subsequent_development'), false) AS changed,
      coalesce(stage = 'scheduled' AND event > run_date AND event <= run_date + 14, false) AS upcoming
      FROM c JOIN a USING (candidate_id) LEFT JOIN h ON h.url = c.url LEFT JOIN v ON v.url = c.url AND v.f = c.content_fingerprint LEFT JOIN p ON p.candidate_id = c.candidate_id LEFT JOIN s ON s.url = c.url),
    y AS (SELECT *, CASE WHEN changed THEN coalesce(modified, published) ELSE published END AS dated FROM x)
    SELECT candidate_id, CASE {rules(0)} ELSE 'selected' END AS decision, CASE {rules(1)} ELSE 'eligible' END AS reason FROM y"""


@add("x_evaluate", _sql_evaluate())
def x_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate's decision and reason: relevance, dates, evidence, then what was published before."""
    c = candidates(spark, sf_dir, "candidate_id", "url", "title", "published_date", "event_date", "modified_date", "discovered_date", "development_stage", "content_fingerprint", "summary_hint", "full_text", "reliability", "text_source")
    c = c.withColumns({
        "a": score_of(FITTED), "modified": iso_prefix("modified_date"), "event": iso_prefix("event_date"), "has_full_text": blank("full_text") != "", "has_summary": blank("summary_hint") != "",
    }).select("candidate_id", "url", "content_fingerprint", "a.substantive", "a.score", F.col("discovered_date").alias("run_date"), "published", "modified", "event", F.col("development_stage").alias("stage"), "reliability", "text_source", "has_full_text", "has_summary")
    history = table(spark, sf_dir, "history").where("url is not null")
    pages = history.groupBy("url").agg(F.min_by("fingerprint", "history_id").alias("fingerprint"), F.min("published_date").alias("page_date"), F.lit(True).alias("has_page"))
    versions = history.select("url", F.explode("published_versions").alias("content_fingerprint")).distinct().withColumn("known_version", F.lit(True))
    sent = table(spark, sf_dir, "digest_items").select("url").union(table(spark, sf_dir, "news_briefs").select("url")).distinct().withColumn("sent", F.lit(True))
    prior = j_prior(spark, sf_dir).withColumn("prior_event", F.lit(True))
    full = c.join(pages, "url", "left").join(versions, ["url", "content_fingerprint"], "left").join(sent, "url", "left").join(prior, "candidate_id", "left")
    full = full.withColumn("same_content", F.coalesce(F.col("fingerprint") == F.col("content_fingerprint"), F.lit(False)))
    full = full.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("has_page", "known_version", "sent", "prior_event")})
    return verdict.decide(full).select("candidate_id", "decision", "reason")


@add("o_event")
def o_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of one event consolidated, of all eligible candidates, the best assessed first."""
    return events.consolidate(_eligible(spark, sf_dir))


@add("x_shortlist", "WITH r AS (SELECT reading_id, lower(coalesce(doi, url)) AS k, discovery_score FROM readings), f AS (SELECT k, min(reading_id) AS reading_id FROM r WHERE k IS NOT NULL GROUP BY 1) SELECT f.reading_id, row_number() OVER (ORDER BY r.discovery_score DESC NULLS LAST, f.reading_id) AS place FROM f JOIN r ON r.reading_id = f.reading_id WHERE f.k NOT IN (SELECT lower(doi) FROM history WHERE doi IS NOT NULL) QUALIFY place <= 12")
def x_shortlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings once each, not in history, the best twelve."""
    r = table(spark, sf_dir, "readings").select("reading_id", F.lower(F.coalesce("doi", "url")).alias("k"), "discovery_score").where("k is not null")
    one = r.withColumn("n", nth(["k"], [F.asc("reading_id")])).where("n = 1").join(table(spark, sf_dir, "history").select(F.lower("doi").alias("k")), "k", "left_anti")
    top = one.orderBy(F.desc_nulls_last("discovery_score"), "reading_id").limit(12)
    return with_position(top, [F.desc_nulls_last("discovery_score"), F.asc("reading_id")], "place").select("reading_id", F.col("place").cast("long"))


@add("x_fallback", f"WITH c AS (SELECT run_id, candidate_id, layer, row_number() OVER (PARTITION BY run_id, layer IN ('event', 'news') ORDER BY coalesce(semantic_score, 0) DESC, candidate_id) AS n FROM candidates WHERE layer IS NOT NULL) SELECT run_id, candidate_id, CASE WHEN layer IN ('event', 'news') THEN 'recent_news' ELSE 'research_signals' END AS section, n AS place FROM c WHERE n <= CASE WHEN layer IN ('event', 'news') THEN 8 ELSE 5 END")
def x_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An issue for each run without a model: the best eight of news and five of research."""
    recent = F.col("layer").isin("event", "news")
    c = table(spark, sf_dir, "candidates").where("layer is not null").select("run_id", "candidate_id", recent.alias("recent"), F.coalesce("semantic_score", F.lit(0)).alias("s"))
    c = c.withColumn("place", nth(["run_id", "recent"], [F.desc("s"), F.asc("candidate_id")]))
    return c.where(F.col("place") <= F.when(F.col("recent"), 8).otherwise(5)).select("run_id", "candidate_id", F.when(F.col("recent"), "recent_news").otherwise("research_signals").alias("section"), F.col("place").cast("long"))

"""Queries on scores, ranks, caps, top-k and sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators import ranking
from tidemark.operators.position import with_position
from tidemark.operators.scoring import DEFAULT, Lexicon, assessment, body_of
from tidemark.plans.base import FITTED, SQL_C, blank, candidates
from tidemark.plans.common import Registry
from tidemark.runtime import cut_lineage, table

add = Registry()
QUERIES, SQL = add.queries, add.sql
_HY = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_''\-]*[\p{L}\p{N}_])?"
_SCORE = f"(CASE source_type WHEN 'international_org' THEN 3 WHEN 'think_tank' THEN 2 ELSE 1 END + least(coalesce(len(regexp_extract_all(CASE WHEN coalesce(full_text, '') <> '' THEN full_text ELSE summary_hint END, '{_HY}')), 0), 300) // 25)::INT"
_S = f"WITH {SQL_C}, s AS (SELECT candidate_id, source_org, layer, published, {_SCORE} AS score FROM c)"
_ORDER = "score DESC, published DESC NULLS LAST, candidate_id"


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = candidates(spark, sf_dir, "candidate_id", "source_org", "source_type", "layer", "published_date", "full_text", "summary_hint")
    return c.select("candidate_id", "source_org", "layer", "published", ranking.candidate_score("source_type", "full_text", "summary_hint").alias("score"))




def _order() -> list:
    return [F.desc("score"), F.desc_nulls_last("published"), F.asc("candidate_id")]


@add("o_score", f"{_S} SELECT candidate_id, score, published FROM s")
def o_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("candidate_id", "score", "published")


@add("o_topk", f"{_S} SELECT candidate_id, score FROM s ORDER BY {_ORDER} LIMIT 30")
def o_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).orderBy(*_order()).limit(30).select("candidate_id", "score")


_RANKED = f"{_S}, r AS (SELECT *, row_number() OVER (PARTITION BY source_org ORDER BY {_ORDER}) AS n FROM s)"


@add("w_cap", f"{_RANKED} SELECT candidate_id, source_org, score FROM r WHERE n <= 2 ORDER BY {_ORDER} LIMIT 30")
def w_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: scored candidates, two to a source, the best thirty."""
    return ranking.cap_then_fill(_scored(spark, sf_dir), "source_org", _order(), 30, 2, fill=False).select("candidate_id", "source_org", "score")


@add("w_cap_fill", f"{_RANKED} SELECT candidate_id, source_org, score FROM r ORDER BY (n > 2)::INT, {_ORDER} LIMIT 400")
def w_cap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.cap_then_fill(_scored(spark, sf_dir), "source_org", _order(), 400, 2).select("candidate_id", "source_org", "score")


@add("w_capseq", "SELECT candidate_id, source_org FROM (SELECT candidate_id, source_org, row_number() OVER (PARTITION BY run_id, source_org ORDER BY candidate_id) AS n FROM candidates WHERE layer IN ('event', 'news') AND event_id IS NULL AND source_org IS NOT NULL) WHERE n <= 2")
def w_capseq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two accepted of a run and source in order of arrival."""
    c = table(spark, sf_dir, "candidates").where(F.col("layer").isin("event", "news") & F.col("event_id").isNull() & F.col("source_org").isNotNull()).select("candidate_id", "run_id", "source_org")
    return c.withColumn("n", ranking.nth(["run_id", "source_org"], [F.asc("candidate_id")])).where("n <= 2").select("candidate_id", "source_org")


@add("w_div", f"{_RANKED} SELECT candidate_id, row_number() OVER (ORDER BY score DESC, n, published DESC NULLS LAST, candidate_id) AS editorial_rank FROM r QUALIFY editorial_rank <= 60")
def w_div(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.diversity_pool(_scored(spark, sf_dir), "source_org", "score", "published", "candidate_id", 60).select("candidate_id", F.col("editorial_rank").cast("long"))


@add("w_rank", f"{_S} SELECT candidate_id, row_number() OVER (ORDER BY {_ORDER}) AS rank, row_number() OVER (ORDER BY {_ORDER}) <= 100 AS in_pool FROM s")
def w_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate's rank over the whole table, without one task for all."""
    return with_position(_scored(spark, sf_dir), _order(), "rank").select("candidate_id", F.col("rank").cast("long"), (F.col("rank") <= 100).alias("in_pool"))


@add("w_first", "SELECT history_id, title FROM (SELECT history_id, title, row_number() OVER (PARTITION BY event_id ORDER BY history_id) AS n FROM history WHERE coalesce(event_id, '') <> '') WHERE n = 1")
def w_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "history").select("history_id", "title", "event_id")
    return ranking.first_per_key(rows, "event_id", [F.asc("history_id")], keep_unknown=False).select("history_id", "title")


@add("w_first_kept", "SELECT candidate_id FROM (SELECT candidate_id, doi, row_number() OVER (PARTITION BY doi ORDER BY candidate_id) AS n FROM candidates) WHERE n = 1 OR coalesce(doi, '') = ''")
def w_first_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.first_per_key(table(spark, sf_dir, "candidates").select("candidate_id", "doi"), "doi", [F.asc("candidate_id")]).select("candidate_id")


@add("w_upc", "SELECT candidate_id, event_id FROM (SELECT candidate_id, event_id, semantic_score, discovered_date, row_number() OVER (PARTITION BY event_id ORDER BY coalesce(semantic_score, 0) DESC, discovered_date, candidate_id) AS n FROM candidates WHERE development_stage = 'scheduled' AND event_id IS NOT NULL) WHERE n = 1 ORDER BY coalesce(semantic_score, 0) DESC, discovered_date, candidate_id LIMIT 20")
def w_upc(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "candidates").where("development_stage = 'scheduled' and event_id is not null").select("candidate_id", "event_id", F.coalesce("semantic_score", F.lit(0)).alias("s"), "discovered_date")
    order = [F.desc("s"), F.asc("discovered_date"), F.asc("candidate_id")]
    return c.withColumn("n", ranking.nth(["event_id"], order)).where("n = 1").orderBy(*order).limit(20).select("candidate_id", "event_id")


@add("w_bal", "WITH k AS (SELECT reading_id, coalesce(kind, '') AS kind, row_number() OVER (ORDER BY discovery_score DESC NULLS LAST, reading_id) AS rank FROM readings), n AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY rank) AS n FROM k) SELECT reading_id, kind, rank FROM n ORDER BY (NOT (kind IN ('recent', 'classic') AND n <= 6))::INT, rank LIMIT 12")
def w_bal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six recent and six classic readings, filled up to twelve by rank."""
    r = table(spark, sf_dir, "readings").select("reading_id", F.coalesce("kind", F.lit("")).alias("kind"), "discovery_score")
    ranked = with_position(r, [F.desc_nulls_last("discovery_score"), F.asc("reading_id")], "rank")
    return ranking.balanced(ranked, "kind", "rank", 12, 6, ("recent", "classic")).select("reading_id", "kind", F.col("rank").cast("long"))


@add("w_nav", "WITH d AS (SELECT DISTINCT digest_date FROM digest_items WHERE digest_date IS NOT NULL) SELECT digest_date, lag(digest_date) OVER (ORDER BY digest_date DESC) AS newer, lead(digest_date) OVER (ORDER BY digest_date DESC) AS older FROM d")
def w_nav(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newer and the older issue of each; issues are one a day, so one window holds them."""
    d = table(spark, sf_dir, "digest_items").where("digest_date is not null").select("digest_date").distinct()
    w = Window.orderBy(F.desc("digest_date"))
    return d.select("digest_date", F.lag("digest_date").over(w).alias("newer"), F.lead("digest_date").over(w).alias("older"))


@add("w_lastn", "SELECT history_id, array_to_string(published_versions[-2:], ' ') AS latest FROM history")
def w_lastn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "history").select("history_id", F.array_join(ranking.last_n(F.col("published_versions"), 2), " ").alias("latest"))


def sql_assess(lex: Lexicon) -> str:
    q = lambda p: p.replace("'", "''").replace(r"(?!)", "$^")
    n = " + ".join(f"regexp_matches(body, '(?i){q(p)}')::INT" for p in lex.topics.values())
    return f"""WITH {SQL_C}, b AS (SELECT candidate_id, coalesce(title, '') AS title, coalesce(title, '') || ' ' || CASE WHEN coalesce(full_text, '') <> '' THEN full_text ELSE coalesce(summary_hint, '') END AS body,
      published IS NOT NULL AS dated, coalesce(reliability IN ('primary', 'established_secondary'), false) AND coalesce(summary_hint, '') <> '' AS evident FROM c),
    d AS (SELECT candidate_id, {n} AS n, regexp_matches(body, '(?i){q(lex.mechanism)}') AS m, regexp_matches(body, '(?i){q(lex.implication)}') AS i, regexp_matches(title, '(?i){q(lex.noise)}') AS z, dated, evident FROM b)
    SELECT candidate_id, n AS n_topics, (n > 0 AND m AND NOT z) AS substantive, CASE WHEN n > 0 AND m AND NOT z THEN 2 + i::INT + least(2, n) + dated::INT + evident::INT + i::INT ELSE 0 END AS score FROM d"""


def score_of(lex: Lexicon) -> Column:
    """n_topics, substantive and score from a candidate's columns."""
    return assessment(body_of("title", "full_text", "summary_hint"), blank("title"), F.col("published").isNotNull(), F.col("reliability").isin("primary", "established_secondary"), blank("summary_hint") != "", lex)


def _assess(spark: SparkSession, sf_dir: str, lex: Lexicon) -> DataFrame:
    c = candidates(spark, sf_dir, "candidate_id", "title", "full_text", "summary_hint", "published_date", "reliability")
    return c.select("candidate_id", score_of(lex).alias("a")).select("candidate_id", F.col("a.n_topics"), F.col("a.substantive"), F.col("a.score"))


@add("a_assess", sql_assess(FITTED))
def a_assess(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assess(spark, sf_dir, FITTED)


@add("a_assess_default", sql_assess(DEFAULT))
def a_assess_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assess(spark, sf_dir, DEFAULT)


@add("p_assess", sql_assess(FITTED).replace("    SELECT candidate_id, n AS n_topics", "    SELECT candidate_id, score FROM (SELECT candidate_id, n AS n_topics") + ") WHERE substantive AND score >= 4")
def p_assess(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assess(spark, sf_dir, FITTED).where("substantive and score >= 4").select("candidate_id", "score")


@add("o_assessed", "SELECT candidate_id, row_number() OVER (ORDER BY coalesce(semantic_score, 0) DESC, (coalesce(reliability, '') = 'primary')::INT DESC, candidate_id) AS place FROM candidates")
def o_assessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "candidates").select("candidate_id", F.coalesce("semantic_score", F.lit(0)).alias("s"), (blank("reliability") == "primary").cast("int").alias("p"))
    return with_position(c, [F.desc("s"), F.desc("p"), F.asc("candidate_id")], "place").select("candidate_id", F.col("place").cast("long"))


_CUES = "news|report|publication|press|insights|briefs"


@add("o_links", f"SELECT candidate_id, len(regexp_extract_all(lower(url), '{_CUES}')) AS n_cues FROM candidates WHERE regexp_matches(url, '(?i){_CUES}') ORDER BY n_cues DESC, candidate_id LIMIT 25")
def o_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "candidates").where(F.col("url").rlike(f"(?i){_CUES}")).select("candidate_id", F.regexp_count(F.lower("url"), F.lit(_CUES)).cast("long").alias("n_cues"))
    return c.orderBy(F.desc("n_cues"), "candidate_id").limit(25)


def _wanted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Runs (run_id, wanted) with the distinct tags of their candidates, and the different sets of tags among them (wanted, tag), a row for each tag."""
    c = table(spark, sf_dir, "candidates").where("tags is not null").select("run_id", F.explode_outer("tags").alias("t"))
    runs = cut_lineage(c.groupBy("run_id").agg(F.array_sort(F.collect_set("t")).alias("wanted")))  # a controlled vocabulary
    return runs, runs.select("wanted").distinct().select("wanted", F.explode("wanted").alias("tag"))


def _hits(readings: DataFrame, sets: DataFrame) -> DataFrame:
    """wanted, reading_id, relevance: how many tags a reading shares with a set, for those that share any."""
    tags = readings.select("reading_id", F.explode(F.array_distinct("tags")).alias("tag"))
    return tags.join(sets, "tag").groupBy("wanted", "reading_id").agg(F.count(F.lit(1)).alias("relevance"))


def _with_fill(hits: DataFrame, runs: DataFrame, fill: list, kind: str) -> DataFrame:
    """``hits`` and, for each set of tags, the readings ``fill`` that stand in where hits are too few."""
    rows = F.array(*(F.lit(x) for x in fill)).cast(f"array<{kind}>")
    others = runs.select("wanted").distinct().select("wanted", F.explode(rows).alias("reading_id"))
    return hits.unionByName(others.withColumn("relevance", F.lit(0).cast("long"))).groupBy("wanted", "reading_id").agg(F.max("relevance").alias("relevance"))


_T = "t AS (SELECT run_id, list_distinct(flatten(list(tags))) AS wanted FROM candidates WHERE tags IS NOT NULL GROUP BY 1)"


@add("o_acad", f"WITH {_T} SELECT run_id, reading_id, len(list_intersect(coalesce(tags, []), wanted)) AS relevance FROM readings, t QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY relevance DESC, discovery_score DESC NULLS LAST, reading_id) <= 40")
def o_acad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each run forty readings, by the tags they share with its candidates, then by score; ranked once for each different set of tags."""
    r = table(spark, sf_dir, "readings").select("reading_id", "tags", "discovery_score")
    runs, sets = _wanted(spark, sf_dir)
    # readings without a shared tag come in only after all that have one, so only the best forty of all may
    best = [x[0] for x in r.orderBy(F.desc_nulls_last("discovery_score"), "reading_id").limit(40).select("reading_id").collect()]
    scored = _with_fill(_hits(r, sets), runs, best, "long").join(r.select("reading_id", "discovery_score"), "reading_id")
    top = scored.withColumn("n", ranking.nth(["wanted"], [F.desc("relevance"), F.desc_nulls_last("discovery_score"), F.asc("reading_id")])).where("n <= 40")
    return runs.join(top, "wanted").select("run_id", "reading_id", "relevance")


@add("o_readsel", f"WITH {_T}, r AS (SELECT run_id, reading_id, lower(trim(coalesce(doi, url, title))) AS k, (len(list_intersect(coalesce(tags, []), wanted)) > 0) AS hit FROM readings, t), f AS (SELECT *, row_number() OVER (PARTITION BY run_id, k ORDER BY hit DESC, reading_id) AS n FROM r) SELECT run_id, reading_id, hit FROM f WHERE n = 1 QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY hit DESC, reading_id) <= 2")
def o_readsel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each run two different readings, those that share a tag with its candidates first."""
    r = table(spark, sf_dir, "readings").select("reading_id", "tags", F.lower(F.trim(F.coalesce("doi", "url", "title"))).alias("k"))
    runs, sets = _wanted(spark, sf_dir)
    # where fewer than two hits differ, one more than is missing of all different readings will do
    first = [x[0] for x in r.groupBy("k").agg(F.min("reading_id").alias("reading_id")).orderBy("reading_id").limit(3).select("reading_id").collect()]
    rows = _with_fill(_hits(r, sets), runs, first, "long").join(r.select("reading_id", "k"), "reading_id").withColumn("hit", F.col("relevance") > 0)
    one = rows.withColumn("n", ranking.nth(["wanted", "k"], [F.desc("hit"), F.asc("reading_id")])).where("n = 1")
    top = one.withColumn("n", ranking.nth(["wanted"], [F.desc("hit"), F.asc("reading_id")])).where("n <= 2")
    return runs.join(top, "wanted").select("run_id", "reading_id", "hit")


@add("o_fulltext", "SELECT candidate_id, row_number() OVER (PARTITION BY run_id ORDER BY (coalesce(full_text, '') <> '')::INT DESC, candidate_id) AS place FROM candidates")
def o_fulltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Within a run, candidates with a full text first, in order of arrival."""
    c = table(spark, sf_dir, "candidates").select("candidate_id", "run_id", (blank("full_text") != "").cast("int").alias("has"))
    return c.select("candidate_id", ranking.nth(["run_id"], [F.desc("has"), F.asc("candidate_id")], "place").cast("long").alias("place"))


@add("o_index", "SELECT digest_date, count(*) AS n_items FROM (SELECT digest_date FROM digest_items UNION ALL SELECT digest_date FROM news_briefs) WHERE digest_date IS NOT NULL GROUP BY 1 ORDER BY 1 DESC")
def o_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "digest_items").select("digest_date").unionAll(table(spark, sf_dir, "news_briefs").select("digest_date"))
    return both.where("digest_date is not null").groupBy("digest_date").agg(F.count(F.lit(1)).alias("n_items")).orderBy(F.desc("digest_date"))


@add("u_union", "SELECT 'digest_items' AS origin, item_id AS id, title_en, core_argument_en FROM digest_items UNION ALL SELECT 'news_briefs', brief_id, title_en, NULL FROM news_briefs")
def u_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "digest_items").select(F.lit("digest_items").alias("origin"), F.col("item_id").alias("id"), "title_en", "core_argument_en")
    b = table(spark, sf_dir, "news_briefs").select(F.lit("news_briefs").alias("origin"), F.col("brief_id").alias("id"), "title_en")
    return a.unionByName(b, allowMissingColumns=True)


_ORDERED = "(SELECT coalesce(string_agg(t, ' ' ORDER BY k), '') FROM (SELECT t, min(k) AS k FROM (SELECT unnest({x}) AS t, generate_subscripts({x}, 1) AS k) WHERE t <> '' GROUP BY t))"


@add("u_append", "SELECT candidate_id, " + _ORDERED.format(x="list_concat(coalesce(s.default_tags, []), coalesce(c.tags, []))") + " AS all_tags FROM candidates c JOIN sources s ON s.name = c.source_org")
def u_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source's own tags, then a candidate's that aren't there yet, in order."""
    c, s = table(spark, sf_dir, "candidates").select("candidate_id", "source_org", "tags"), table(spark, sf_dir, "sources").select(F.col("name").alias("source_org"), "default_tags")
    none = F.array().cast("array<string>")
    return c.join(s, "source_org").select("candidate_id", F.array_join(F.filter(F.array_distinct(F.concat(F.coalesce("default_tags", none), F.coalesce("tags", none))), lambda t: t != ""), " ").alias("all_tags"))


@add("u_distinct", "SELECT candidate_id, " + _ORDERED.format(x="coalesce(tags, [])") + " AS tags_once FROM candidates")
def u_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "candidates").select("candidate_id", F.array_join(F.filter(F.array_distinct(F.coalesce("tags", F.array().cast("array<string>"))), lambda t: t != ""), " ").alias("tags_once"))




@add("u_inter", "SELECT item_id, array_to_string(list_sort(list_intersect(coalesce(tags, []), coalesce(sdg_links, []))), ' ') AS both, list_has_all(coalesce(tags, []), coalesce(sdg_links, [])) AS all_in, array_to_string(list_sort(list_distinct(list_filter(coalesce(tags, []), lambda t: NOT list_contains(coalesce(sdg_links, []), t)))), ' ') AS only_tags FROM digest_items")
def u_inter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlap, containment and difference of two lists of a row."""
    none = F.array().cast("array<string>")
    a, b = F.coalesce("tags", none), F.coalesce("sdg_links", none)
    return table(spark, sf_dir, "digest_items").select("item_id", F.array_join(F.array_sort(F.array_intersect(a, b)), " ").alias("both"), (F.size(F.array_except(b, a)) == 0).alias("all_in"), F.array_join(F.array_sort(F.array_except(a, b)), " ").alias("only_tags"))


@add("u_diff", "SELECT DISTINCT url FROM digest_items WHERE url IS NOT NULL AND url NOT IN (SELECT url FROM news_briefs WHERE url IS NOT NULL)")
def u_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (table(spark, sf_dir, t).where("url is not null").select("url") for t in ("digest_items", "news_briefs"))
    return a.join(b, "url", "left_anti").distinct()


@add("u_subset", "SELECT d.digest_date, bool_and(b.url IS NOT NULL) AS all_cited FROM (SELECT DISTINCT digest_date, url FROM digest_items WHERE digest_date IS NOT NULL AND url IS NOT NULL) d LEFT JOIN (SELECT DISTINCT digest_date, url FROM news_briefs) b ON b.digest_date = d.digest_date AND b.url = d.url GROUP BY 1")
def u_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether all items of an issue are among its briefs."""
    d = table(spark, sf_dir, "digest_items").where("digest_date is not null and url is not null").select("digest_date", "url").distinct()
    b = table(spark, sf_dir, "news_briefs").select("digest_date", "url", F.lit(True).alias("cited")).distinct()
    return d.join(b, ["digest_date", "url"], "left").groupBy("digest_date").agg(F.bool_and(F.coalesce("cited", F.lit(False))).alias("all_cited"))


_WORDS = r"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}_]+')"


@add("w_ngram", f"WITH r AS (SELECT reading_id, {_WORDS.format(x='note_en')} AS n, {_WORDS.format(x='abstract_en')} AS s FROM readings) SELECT reading_id FROM r WHERE len(s) >= 20 AND len(n) > 0 AND len(list_filter(range(1, greatest(len(n) - 5, 1) + 1), lambda i: contains(' ' || array_to_string(s, ' ') || ' ', ' ' || array_to_string(n[i:i + 5], ' ') || ' '))) > 0")
def w_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings whose note repeats six words of the abstract in a row."""
    from tidemark.operators.overlap import copies_span

    return table(spark, sf_dir, "readings").select("reading_id", copies_span("note_en", "abstract_en", 6).alias("copied")).where("copied").select("reading_id")



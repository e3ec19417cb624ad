"""Queries on scalar functions: text, addresses, dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, text, urls
from tidemark.plans.common import NS, WS, Registry, sql_fingerprint, sql_iso, sql_mail, sql_squeeze, sql_strip
from tidemark.runtime import table

add = Registry()
QUERIES, SQL = add.queries, add.sql


def _sql_unescape(x: str) -> str:
    for a, b in text.ENTITIES:
        x = f"replace({x}, '{a}', '{b.replace(chr(39), chr(39) * 2)}')"
    return x


def _simple(name: str, source: str, ident: str, spark_column, sql_expression: str, out: str, where: str = "true") -> None:  # noqa: ANN001
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, source).select(ident, spark_column().alias(out))

    add(name, f"SELECT {ident}, {sql_expression} AS {out} FROM {source}")(run)


_TAGLESS = "regexp_replace({x}, '<[^>]+>', ' ', 'g')"
_simple("f_clean", "candidates", "candidate_id", lambda: text.clean_text("summary_hint"), sql_strip(_sql_unescape(f"regexp_replace({_TAGLESS.format(x='summary_hint')}, '{WS}+', ' ', 'g')")), "cleaned")
_LABEL = rf"^{WS}*(?i:abstract|summary){WS}*[:.\-]?{WS}+"
_ONLINE = rf"^[^\n]*?(?i:published online:){WS}*[^;]+;{WS}*(?i:doi:)\S+{WS}*"
_STRIP = "regexp_replace(regexp_replace(regexp_replace({x}, '" + _LABEL.replace("{", "{{").replace("}", "}}") + "', ''), '" + _ONLINE.replace("{", "{{").replace("}", "}}") + "', ''), '^" + WS.replace("{", "{{").replace("}", "}}") + "+|" + WS.replace("{", "{{").replace("}", "}}") + "+$', '', 'g')"
_simple("f_src", "readings", "reading_id", lambda: text.strip_labels("abstract_en"), _STRIP.format(x="abstract_en"), "stripped")
_simple("f_markup", "readings", "reading_id", lambda: text.clean_markup("abstract_en"), _STRIP.format(x=sql_squeeze(_sql_unescape(_TAGLESS.format(x="abstract_en")))), "cleaned")
_HYPHENATED = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_''\-]*[\p{L}\p{N}_])?"
_simple("f_wc1", "documents", "doc_id", lambda: text.words_hyphenated("text"), f"len(regexp_extract_all(text, '{_HYPHENATED}'))", "n_words")
_simple("f_wc2", "documents", "doc_id", lambda: text.words_plain("text"), r"len(regexp_extract_all(text, '[\p{L}\p{N}_]+'))", "n_words")
_simple("f_wc3", "documents", "doc_id", lambda: text.words_spaced("text"), f"len(regexp_extract_all(replace(text, '…', ' '), '{NS}+'))", "n_words")
_simple("f_firstw", "candidates", "candidate_id", lambda: text.first_words("full_text", 600), f"array_to_string(regexp_extract_all(full_text, '{NS}+')[1:600], ' ')", "first_words")
_simple("f_trims", "candidates", "candidate_id", lambda: text.trim_sentence("summary_hint", 140), f"CASE WHEN length({sql_squeeze('summary_hint')}) <= 140 THEN {sql_squeeze('summary_hint')} ELSE rtrim(substr({sql_squeeze('summary_hint')}, 1, 139)) || '…' END", "sentence")
_simple("f_clen", "documents", "doc_id", lambda: text.compact_length("text"), f"length(regexp_replace(text, '{WS}+', '', 'g'))", "n")
_simple("f_norm", "candidates", "candidate_id", lambda: text.comparison_key("title"), r"regexp_replace(lower(title), '[^\p{L}\p{N}_]+', '', 'g')", "title_key")
_simple("f_fp", "documents", "doc_id", lambda: text.fingerprint("text"), sql_fingerprint("text"), "fingerprint")
_simple("f_url1", "candidates", "candidate_id", lambda: urls.bare_url("url"), r"lower(regexp_replace(regexp_replace(url, '[?#](?s:.)*$', ''), '/+$', ''))", "url_key")
_simple("f_host", "candidates", "candidate_id", lambda: urls.host("url"), r"regexp_replace(regexp_replace(lower(regexp_extract(url, '^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?', 2)), '^.*@', ''), ':\d*$', '')", "host")
_simple("f_entitle", "candidates", "candidate_id", lambda: text.is_latin_title("title"), r"regexp_matches(title, '\p{L}') AND NOT regexp_matches(regexp_replace(title, '\p{Latin}', '', 'g'), '\p{L}')", "is_latin")
_simple("f_tok", "candidates", "candidate_id", lambda: F.array_join(F.array_sort(text.title_tokens("title")), " "), "array_to_string(list_sort(regexp_extract_all(lower(title), '[a-z0-9]+')), ' ')", "tokens")
_simple("f_esc", "candidates", "candidate_id", lambda: text.escape_html("title"), "replace(replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')", "escaped")
_simple("f_text", "candidates", "candidate_id", lambda: text.text_or_blank("semantic_reason"), f"coalesce({sql_strip('semantic_reason')}, '')", "reason")
_simple("f_doi", "candidates", "candidate_id", lambda: urls.doi_of("doi", "url"), rf"regexp_replace(lower(coalesce(nullif({sql_strip('doi')}, ''), {sql_strip('url')})), '^(?:https?://doi\.org/|doi:)', '')", "identifier")
_simple("d_iso", "candidates", "candidate_id", lambda: dates.iso_prefix("published_date"), sql_iso("published_date"), "published")
_simple("d_legacy", "candidates", "candidate_id", lambda: dates.date_or("published_date", "discovered_date"), f"coalesce({sql_mail('published_date')}, {sql_iso('published_date')}, discovered_date)", "published")
_simple("d_fmt", "history", "history_id", lambda: F.concat_ws(" / ", dates.display("published_date"), dates.display("published_date", True)), "strftime(published_date, '%B %-d, %Y') || ' / ' || strftime(published_date, '%b %-d, %Y')", "shown")
_simple("d_cmp", "candidates", "candidate_id", lambda: dates.later_than(dates.iso_prefix("published_date"), "discovered_date"), f"coalesce({sql_iso('published_date')} > discovered_date, false)", "is_future")
_simple("f_domain", "candidates", "candidate_id", lambda: F.when(F.upper(F.trim("semantic_domain")).isin(*"ABCDE"), F.upper(F.trim("semantic_domain"))).otherwise("mixed"), "CASE WHEN upper(trim(semantic_domain)) IN ('A','B','C','D','E') THEN upper(trim(semantic_domain)) ELSE 'mixed' END", "domain")

_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def _sql_query(tracking: str, blanks: bool) -> str:
    extra = "" if blanks else r" AND regexp_matches(f, '=(?s:.)')"
    return rf"array_to_string(list_sort(list_transform(list_filter(string_split(regexp_extract(url, '{_PARTS}', 4), '&'), lambda f: f <> '' AND NOT regexp_matches(lower(f), '^(?:utm_|(?:{tracking})(?:=|$))'){extra}), lambda f: CASE WHEN instr(f, '=') > 0 THEN f ELSE f || '=' END)), '&')"


_part = lambda n: f"regexp_extract(url, '{_PARTS}', {n})"
_PATH = f"regexp_replace({_part(3)}, '/+$', '')"
_simple("f_url2", "candidates", "candidate_id", lambda: urls.canonical_url("url"), f"CASE WHEN url IS NOT NULL THEN (CASE WHEN {_part(1)} <> '' THEN lower({_part(1)}) || ':' ELSE '' END) || (CASE WHEN {_part(2)} <> '' THEN '//' || lower({_part(2)}) ELSE '' END) || {_PATH} || (CASE WHEN {_sql_query('fbclid|gclid|trk', True)} <> '' THEN '?' || {_sql_query('fbclid|gclid|trk', True)} ELSE '' END) END", "url_key")
_simple("f_url3", "candidates", "candidate_id", lambda: urls.article_key("url"), rf"CASE WHEN url IS NOT NULL THEN regexp_replace(lower({_part(2)}), '^www\.', '') || {_PATH} || (CASE WHEN {_sql_query('fbclid|gclid', False)} <> '' THEN '?' || {_sql_query('fbclid|gclid', False)} ELSE '' END) END", "article_key")


@add("f_mkey", r"SELECT reading_id, regexp_replace(lower(strip_accents(title)), '[^\p{L}\p{N}]+', '', 'g') AS title_key FROM readings")
def f_mkey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "readings").select("reading_id", text.metadata_key("title").alias("title_key"))


@add("f_ratio")
def f_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of an item's argument its summary repeats."""
    return table(spark, sf_dir, "digest_items").select("item_id", F.round(text.sequence_ratio("core_argument_en", "summary_en"), 6).alias("ratio"))


@add("f_tags", "SELECT item_id, array_to_string(list_filter(list_distinct_ordered, lambda t: true)[1:3], ' ') AS kept FROM (SELECT item_id, list_reduce(list_prepend([]::VARCHAR[], list_transform(list_filter(list_transform(coalesce(list_concat(sdg_links, tags), []), lambda t: trim(t)), lambda t: t <> '' AND t <> '#ports'), lambda t: [t])), lambda a, b: CASE WHEN list_contains(a, b[1]) THEN a ELSE list_concat(a, b) END) AS list_distinct_ordered FROM digest_items)")
def f_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = F.array().cast("array<string>")
    kept = text.clean_tags(F.coalesce("tags", empty), F.coalesce("sdg_links", empty), ["#ports"])
    return table(spark, sf_dir, "digest_items").select("item_id", F.array_join(kept, " ").alias("kept"))


TOPICS = {"#水务治理": "Water", "#grid-access": "Energy", "#debt-relief": "Finance", "#rural-credit": "Finance", "#river-finance": "Finance", "#forest-tenure": "Land", "#heat-health": "Health", "#trade-rules": "Trade", "#数据规则": "Data", "#city-budgets": "Cities", "#school-meals": "Development", "#ports": "Trade"}
_CASE = "CASE t " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in TOPICS.items()) + " END"


@add("f_topics", f"WITH e AS (SELECT candidate_id, unnest(tags) AS t, generate_subscripts(tags, 1) AS k FROM candidates), m AS (SELECT candidate_id, {_CASE} AS topic, min(k) AS k FROM e GROUP BY 1, 2) SELECT c.candidate_id, coalesce(string_agg(topic, ', ' ORDER BY k), '') AS topics FROM candidates c LEFT JOIN m ON m.candidate_id = c.candidate_id AND topic IS NOT NULL GROUP BY 1")
def f_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    return table(spark, sf_dir, "candidates").select("candidate_id", F.array_join(text.mapped(tags, TOPICS), ", ").alias("topics"))


@add("f_payload", "SELECT candidate_id, coalesce(title, '') || chr(9) || coalesce(source_org, '') || chr(9) || coalesce(layer, '') || chr(9) || array_to_string(coalesce(tags, []), ' ') AS payload FROM candidates")
def f_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank = lambda c: F.coalesce(c, F.lit(""))
    tags = F.array_join(F.coalesce("tags", F.array().cast("array<string>")), " ")
    return table(spark, sf_dir, "candidates").select("candidate_id", F.concat_ws("\t", blank("title"), blank("source_org"), blank("layer"), tags).alias("payload"))


@add("f_itemid", "SELECT item_id, strftime(digest_date, '%Y-%m-%d') || '-signal-' || row_number() OVER (PARTITION BY digest_date ORDER BY item_id) AS public_id FROM digest_items WHERE digest_date IS NOT NULL")
def f_itemid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.window import Window

    k = F.row_number().over(Window.partitionBy("digest_date").orderBy("item_id"))
    return table(spark, sf_dir, "digest_items").where("digest_date is not null").select("item_id", F.concat_ws("-", F.date_format("digest_date", "yyyy-MM-dd"), F.lit("signal"), k.cast("string")).alias("public_id"))

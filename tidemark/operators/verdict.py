"""The decision on a document, with its reason, from what is known about it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Decisions and reasons in the order in which they are tried; each condition is SQL over the columns that :func:`decide` names. Fixed values.
RULES = (
    ("low_substantive_relevance", "not_substantive", "not coalesce(substantive, false)"),
    ("low_substantive_relevance", "below_threshold", "coalesce(score, 0) < {threshold}"),
    ("insufficient_evidence", "publication_date_conflict", "not has_full_text and page_date <> published"),
    ("outside_temporal_scope", "future_publication_or_version", "published > run_date or modified > run_date"),
    ("insufficient_evidence", "publication_date_missing", "dated is null and not upcoming"),
    ("outside_temporal_scope", "outside_rolling_publication_window", "not upcoming and dated < date_sub(run_date, {window})"),
    ("insufficient_evidence", "publisher_not_reviewed", "coalesce(reliability not in ('primary', 'established_secondary'), true)"),
    ("insufficient_evidence", "document_metadata_only", "text_source = 'metadata_only' and coalesce(stage, '') <> 'scheduled'"),
    ("insufficient_evidence", "no_supporting_text", "not has_full_text and not has_summary"),
    ("deduplication", "event_update_already_published", "prior_event"),
    ("deduplication", "version_already_published", "known_version"),
    ("deduplication", "sent_without_update", "sent and not changed"),
    ("lower_editorial_priority", "upcoming", "stage = 'scheduled' and upcoming"),
    ("insufficient_evidence", "announcement_only", "stage = 'scheduled'"),
)
SELECTED = ("selected", "eligible")


def decide(df: DataFrame, threshold: int = 4, window: int = 21, ahead: int = 14) -> DataFrame:
    """``df`` with ``decision`` and ``reason``: those of the first rule that holds.

    Columns used: substantive, score, run_date, published, modified, event, page_date (dates), stage,
    reliability, text_source, has_full_text, has_summary, has_page, same_content, prior_event,
    known_version, sent (booleans, not null). A new version counts by its own date if its content differs from
    the page known before and its stage is one of change; what is scheduled for the next ``ahead`` days is upcoming.
    """
    changed = F.expr("coalesce(has_page and not same_content and stage in ('outcome', 'subsequent_development'), false)")
    upcoming = F.expr(f"coalesce(stage = 'scheduled' and event > run_date and event <= date_add(run_date, {ahead}), false)")
    rows = df.withColumns({"changed": changed, "upcoming": upcoming}).withColumn("dated", F.expr("if(changed, coalesce(modified, published), published)"))
    of: dict[str, Column] = {}
    for k, name in enumerate(("decision", "reason")):
        case = F
        for rule in RULES:
            case = case.when(F.expr(f"coalesce({rule[2].format(threshold=threshold, window=window)}, false)"), F.lit(rule[k]))
        of[name] = case.otherwise(F.lit(SELECTED[k]))
    return rows.withColumns(of)

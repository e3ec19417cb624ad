"""Transparent relevance scores from pattern sets."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lexicon:
    """Patterns, found anywhere in a text whatever the case; ``noise`` only in titles, at word bounds."""

    topics: dict[str, str] = field(default_factory=dict)
    mechanism: str = "(?!)"
    implication: str = "(?!)"
    noise: str = "(?!)"


#: The default patterns of the domain. Fixed values.
DEFAULT = Lexicon(
    topics={
        "climate_policy": "climate|emission|adaptation|mitigation|energy transition|renewable|fossil fuel|carbon|温室|气候|减排",
        "development": "sustainable development|poverty|inequal|food security|health|education|water|biodiversity|ecosystem|conservation|resilien|发展|贫困|不平等",
        "political_economy": "trade|debt|tax|finance|investment|value chain|industrial|subsid|融资|债务|贸易",
        "governance": "governance|multilateral|international|institution|just transition|public policy|治理|多边|公正转型",
    },
    mechanism="polic|negotiat|dialogue|consultation|agreement|decision|reform|regulat|fund|budget|assessment|work programme|workshop|research|evidence|report|implementation|deadline|timeline|mechanism|政策|协商|协议|改革|研究|机制",
    implication="implement|mandat|institution|government|minister|parties|accountab|distribution|rights|financ|capacity|assessment|governance|规则|政府|实施|分配",
    noise=r"\b(?:match result|celebrity|album release|box office|coupon|sweepstakes|vacancy|job opening)\b",
)


def found(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike(f"(?i){pattern}"), F.lit(False))


def body_of(title: str, full_text: str, summary: str) -> Column:
    """Title and text, the summary standing in for a text that is null or blank."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return F.concat_ws(" ", blank(title), F.when(blank(full_text) != "", F.col(full_text)).otherwise(blank(summary)))


def assessment(text: Column, title: Column, has_date: Column, reviewed: Column, has_summary: Column, lexicon: Lexicon = DEFAULT) -> Column:
    """A struct: six dimensions, ``n_topics``, ``substantive`` and ``score`` (0 unless substantive, 8 at most)."""
    n = reduce(Column.__add__, (found(text, p).cast("int") for p in lexicon.topics.values()), F.lit(0))
    mechanism, implication, noise = found(text, lexicon.mechanism), found(text, lexicon.implication), found(title, lexicon.noise)
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    dims = {
        "substantive_significance": F.when((n > 0) & mechanism, 2).otherwise(0), "institutional_implications": yes(implication & (n > 0)), "scope_relevance": F.least(F.lit(2), n),
        "novelty_timeliness": yes(has_date), "evidence_strength": yes(reviewed & has_summary), "future_policy_implications": yes(mechanism & implication),
    }
    substantive = (n > 0) & mechanism & ~noise
    total = reduce(Column.__add__, dims.values())
    return F.struct(*(c.alias(k) for k, c in dims.items()), n.alias("n_topics"), substantive.alias("substantive"), F.when(substantive, total).otherwise(0).alias("score"))

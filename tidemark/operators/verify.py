"""Citations held against bibliographic records; what can't be confirmed isn't."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import comparison_key


def verify_citations(citations: DataFrame, works: DataFrame) -> DataFrame:
    """id, verified, reason (of the first fact that isn't confirmed) of citations (id, doi, title, journal, authors, year) against works (doi, title, journal, families array<string>, year).

    Keys of DOIs must be made alike before. Every family name of a work must be within the citation's authors, letter case and punctuation aside; a
    work without authors confirms none. A work that occurs several times confirms if one of its records does.
    """
    full = citations.alias("c").join(works.where("doi <> ''").withColumn("_known", F.lit(True)).alias("w"), F.col("c.doi") == F.col("w.doi"), "left")
    same = lambda n: F.coalesce((comparison_key(F.col(f"c.{n}")) == comparison_key(F.col(f"w.{n}"))) & (comparison_key(F.col(f"c.{n}")) != ""), F.lit(False))
    names = F.transform("w.families", lambda x: F.coalesce(comparison_key(x), F.lit("")))
    cited = F.coalesce(comparison_key(F.col("c.authors")), F.lit(""))
    named = F.coalesce((F.size(names) > 0) & F.forall(names, lambda x: (x != "") & F.contains(cited, x)), F.lit(False))
    checks = (("no_doi", F.coalesce(F.col("c.doi"), F.lit("")) == ""), ("unknown_doi", F.col("_known").isNull()), ("title", ~same("title")), ("journal", ~same("journal")), ("authors", ~named), ("year", ~F.coalesce(F.col("c.year") == F.col("w.year"), F.lit(False))))
    case = F
    for k, (_, failed) in enumerate(checks):
        case = case.when(failed, F.lit(k))
    best = full.select("c.id", case.otherwise(F.lit(len(checks))).alias("at")).groupBy("id").agg(F.max("at").alias("at"))
    reasons = F.array(*(F.lit(n) for n, _ in checks), F.lit("verified"))
    return best.select("id", (F.col("at") == len(checks)).alias("verified"), F.get(reasons, F.col("at")).alias("reason"))

"""Breadth-first walks over link tables, level by level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.runtime import cut_lineage


def walk(seeds: DataFrame, links: DataFrame, depth: int = 2, per_page: int = 25, budget: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(visited, overflow): pages (url, depth, parent) reached from ``seeds`` (url) over ``links`` (parent, url, place), each once,
    at the least depth, by its first parent; and the links (parent, url, reason) beyond ``per_page`` of a page or the ``budget`` of pages.

    Costs depth + 1 rounds of a join and an anti-join; links of unreached pages are never read again.
    """
    level = cut_lineage(seeds.select("url").where("url is not null").distinct().select("url", F.lit(0).alias("depth"), F.lit(None).cast("string").alias("parent")))
    visited, over = level, None
    for d in range(1, depth + 1):
        out = links.join(level.select(F.col("url").alias("parent")), "parent", "left_semi").where("url is not null")
        out = out.withColumn("_n", F.row_number().over(Window.partitionBy("parent").orderBy("place", "url")))
        beyond = out.where(F.col("_n") > per_page).select("parent", "url", F.lit("links_per_page").alias("reason"))
        over = beyond if over is None else over.unionByName(beyond)
        new = out.where(F.col("_n") <= per_page).join(visited.select("url"), "url", "left_anti")
        level = cut_lineage(new.groupBy("url").agg(F.min(F.struct("place", "parent")).alias("p")).select("url", F.lit(d).alias("depth"), F.col("p.parent").alias("parent")))
        visited = visited.unionByName(level)
    over = over if over is not None else visited.select("parent", "url", F.lit("").alias("reason")).limit(0)
    if budget is not None:
        kept = visited.orderBy("depth", "url").limit(budget)
        late = visited.join(kept.select("url"), "url", "left_anti").select("parent", "url", F.lit("budget").alias("reason"))
        return kept, over.unionByName(late)
    return visited, over


def within_budget(df: DataFrame, order: list, total: int, by: str, each: int, evidence: int = 0) -> DataFrame:
    """The rows that come in: the first ``each`` of every ``by`` in order, of those the first ``total``.

    For ``evidence`` requests to come as many are kept back, at most half of all, and up to ten of each ``by``.
    """
    reserve = min(evidence, total // 2)
    total, each = total - reserve, max(each - min(10, reserve), 0)
    n = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return df.withColumn("_n", n).where(F.col("_n") <= each).drop("_n").orderBy(*order).limit(total)

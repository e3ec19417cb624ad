"""Greedy de-duplication in order: a row stays if it repeats no row that stayed before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import cut_lineage


def greedy_keep(members: DataFrame, links: DataFrame) -> DataFrame:
    """The ids of ``members`` (id, cls) that stay: the lexicographically first maximal set of which no two repeat each other.

    Two ids repeat each other if they share a class or their classes are linked; ``links`` (a, b)
    holds classes, in either or both directions. As an id counts only if it stays, neither
    distinct rows nor connected components would do. In rounds, an undecided id that is the
    smallest of all it repeats stays, and what repeats it goes. Classes are only ever
    aggregated, so no pairs of their members are made and a class may hold any share of the rows.
    """
    left = cut_lineage(members.select("id", "cls").where("cls is not null").distinct())
    both = cut_lineage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    alone = members.groupBy("id").agg(F.count("cls").alias("n")).where("n = 0").select("id")
    kept = alone
    while not left.isEmpty():
        low = left.groupBy("cls").agg(F.min("id").alias("low"))
        across = both.join(low.withColumnRenamed("cls", "a"), "a").select(F.col("b").alias("cls"), "low")
        front = low.unionByName(across).groupBy("cls").agg(F.min("low").alias("front"))
        stay = left.join(front, "cls").groupBy("id").agg(F.min("front").alias("front")).where("front = id").select("id")
        stay = cut_lineage(stay)
        kept = kept.unionByName(stay)
        taken = left.join(stay, "id", "left_semi").select("cls").distinct()
        taken = taken.unionByName(both.join(taken.withColumnRenamed("cls", "a"), "a").select(F.col("b").alias("cls"))).distinct()
        gone = left.join(taken, "cls", "left_semi").select("id").distinct()
        left = cut_lineage(left.join(gone, "id", "left_anti"))
    return kept

"""Ordered selection: scores, caps per source, diversity, pools, balance, neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.text import words_hyphenated
from tidemark.operators.position import with_position

#: Points of a source's type; others have 1. Fixed values.
TYPE_POINTS = {"international_org": 3, "think_tank": 2, "journal": 1}


def candidate_score(source_type: str, full_text: str, summary: str) -> Column:
    """Points of the type, and one for each 25 words up to 300."""
    points = F.lit(1)
    for t, n in TYPE_POINTS.items():
        points = F.when(F.col(source_type) == t, n).otherwise(points)
    text = F.when(F.coalesce(full_text, F.lit("")) != "", F.col(full_text)).otherwise(F.col(summary))
    return (points + F.floor(F.least(F.coalesce(words_hyphenated(text), F.lit(0)), F.lit(300)) / 25)).cast("int")


def nth(by: list[str], order: list[Column], out: str = "nth") -> Column:
    return F.row_number().over(Window.partitionBy(*by).orderBy(*order)).alias(out)


def cap_then_fill(df: DataFrame, source: str, order: list[Column], most: int, per_source: int, fill: bool = True) -> DataFrame:
    """The best ``most`` rows with at most ``per_source`` of a source; where these are too few and ``fill``, the best others after them.

    No source gives more than ``most``, so the rank within a source is limited before its shuffle; the end is a top-k, not a sort.
    """
    ranked = df.withColumn("_n", nth([source], order)).where(F.col("_n") <= (most if fill else min(most, per_source)))
    if not fill:
        return ranked.orderBy(*order).limit(most).drop("_n")
    return ranked.orderBy((F.col("_n") > per_source).cast("int"), *order).limit(most).drop("_n")


def first_per_key(df: DataFrame, key: str, order: list[Column], keep_unknown: bool = True) -> DataFrame:
    """The first row of each key; rows of a null or blank key all stay, or all go."""
    known = df.where(F.coalesce(F.col(key), F.lit("")) != "")
    one = known.withColumn("_n", nth([key], order)).where("_n = 1").drop("_n")
    return one.unionByName(df.where(F.coalesce(F.col(key), F.lit("")) == "")) if keep_unknown else one


def diversity_pool(df: DataFrame, source: str, score: str, date: str, pos: str, pool: int) -> DataFrame:
    """The first ``pool`` rows, with ``editorial_rank``, where each pick takes the best score, of equals the source picked least so far, then the latest date.

    A row's turn among its source's equals is its rank there, so one window, limited to ``pool`` before its shuffle, and a top-k do it.
    """
    order = [F.desc(score), F.desc_nulls_last(date), F.asc(pos)]
    top = df.withColumn("_n", nth([source], order)).where(F.col("_n") <= pool).orderBy(F.desc(score), "_n", F.desc_nulls_last(date), pos).limit(pool)
    return with_position(top, [F.desc(score), F.asc("_n"), F.desc_nulls_last(date), F.asc(pos)], "editorial_rank").drop("_n")


def balanced(df: DataFrame, mode: str, rank: str, size: int, each: int, modes: tuple[str, str]) -> DataFrame:
    """``each`` of either mode, filled up to ``size`` by rank, in the order of rank."""
    turn = df.withColumn("_n", nth([mode], [F.asc(rank)])).where(F.col("_n") <= size)
    first = F.col(mode).isin(*modes) & (F.col("_n") <= each)
    return turn.orderBy((~first).cast("int"), rank).limit(size).drop("_n").orderBy(rank)


def last_n(array: Column, n: int) -> Column:
    return F.when(F.size(array) > n, F.slice(array, -n, n)).otherwise(array)

"""Joins that aren't plain equi-joins, made from equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import title_tokens


def publisher_of_host(df: DataFrame, ident: str, host: str, registry: DataFrame) -> DataFrame:
    """``df`` with ``publisher`` and ``reviewed``: the registry's name for the row's host, else for a
    host above it, the first in ``place`` of several; else the host itself, not reviewed.

    ``registry`` has place, name, known (a host). ``www.`` counts for neither. Each host is
    exploded into its suffixes, so an equi-join does it.
    """
    bare = lambda c: F.regexp_replace(c, r"^www\.", "")
    labels = F.split(F.col("_host"), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.struct((k - 1).alias("up"), F.array_join(F.slice(labels, k, F.size(labels)), ".").alias("known")))
    hosts = df.select(bare(F.col(host)).alias("_host")).distinct().select("_host", F.explode(suffixes).alias("s")).select("_host", "s.*")
    known = registry.select("place", "name", bare(F.col("known")).alias("known")).where("known <> ''")
    best = hosts.join(known, "known").groupBy("_host").agg(F.min_by("name", F.struct((F.col("up") > 0).cast("int"), F.col("place"))).alias("name"))
    full = df.withColumn("_host", bare(F.col(host))).join(best, "_host", "left")
    return full.withColumn("publisher", F.coalesce("name", "_host")).withColumn("reviewed", F.col("name").isNotNull()).drop("name", "_host")


def near_titles(df: DataFrame, ident: str, title: str, within: list[str], above: float) -> DataFrame:
    """a, b, cosine of pairs (a < b) of rows equal in ``within`` whose titles' token counts have a cosine over ``above``.

    Rows of equal tokens are one up to the end and pair with their first only. A title's tokens
    are ordered rarest first; two vectors this near share one of the first few, those that hold
    more than ``1 - above ** 2`` of the squared length, so only these are joined. Titles without
    tokens are near nothing.
    """
    t = df.select(F.col(ident).alias("id"), *within, F.array_sort(title_tokens(title)).alias("toks")).where("size(toks) > 0")
    same = t.groupBy(*within, "toks").agg(F.min("id").alias("first"))
    copies = t.join(same, [*within, "toks"]).where("id > first").select(F.col("first").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("cosine"))
    one = same.select(F.col("first").alias("id"), *within, F.explode("toks").alias("tok")).groupBy("id", *within, "tok").agg(F.count(F.lit(1)).alias("n"))
    df_ = one.groupBy("tok").agg(F.count(F.lit(1)).alias("df"))
    vec = one.join(df_, "tok").groupBy("id", *within).agg(F.array_sort(F.collect_list(F.struct("df", "tok", "n"))).alias("v"))
    total = F.aggregate("v", F.lit(0).cast("long"), lambda acc, x: acc + x["n"] * x["n"])
    vec = vec.withColumn("sq", total).withColumn("vec", F.map_from_entries(F.transform("v", lambda x: F.struct(x["tok"], x["n"]))))
    # a prefix whose rest is shorter than above * length can't be missed by both
    run = F.transform(F.sequence(F.lit(1), F.size("v")), lambda k: F.aggregate(F.slice("v", 1, k - 1), F.lit(0).cast("long"), lambda acc, x: acc + x["n"] * x["n"]))
    keys = F.filter(F.arrays_zip(F.col("v"), run.alias("before")), lambda z: z["before"] <= F.col("sq") * F.lit(1 - above**2))
    post = vec.select("id", *within, "sq", "vec", F.explode(F.transform(keys, lambda z: z["v"]["tok"])).alias("tok"))
    other = post.select(F.col("id").alias("id2"), *within, F.col("sq").alias("sq2"), F.col("vec").alias("vec2"), "tok")
    pairs = post.join(other, [*within, "tok"]).where("id < id2").dropDuplicates(["id", "id2"])
    dot = F.aggregate(F.map_entries("vec"), F.lit(0).cast("long"), lambda acc, e: acc + e["value"] * F.coalesce(F.try_element_at("vec2", e["key"]), F.lit(0)))
    near = pairs.select(F.col("id").alias("a"), F.col("id2").alias("b"), (dot / F.sqrt(F.col("sq") * F.col("sq2"))).alias("cosine")).where(F.col("cosine") > above)
    return copies.unionByName(near).select("a", "b", F.round("cosine", 6).alias("cosine"))

"""Resolving a publisher's spelling to one row of the sources table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def name_key(c: Column | str) -> Column:
    """Letters and digits of a name in lower case: case, spaces and punctuation aside; null for a blank name."""
    key = F.regexp_replace(F.lower(F.col(c) if isinstance(c, str) else c), r"[^\p{L}\p{N}]+", "")
    return F.when(key != "", key)


def alias_table(sources: DataFrame, *carry: str) -> DataFrame:
    """One row for each key of a source's name or alias; a key claimed twice goes to the smallest source_id.

    Columns: name_key, source_id, source_name and those in ``carry``.
    """
    spelled = sources.select("source_id", F.col("name").alias("source_name"), *carry, F.explode(F.array_union(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("spelling"))
    held = F.struct("source_id", "source_name", *carry)
    one = spelled.select(name_key("spelling").alias("name_key"), held.alias("held")).where(F.col("name_key").isNotNull())
    return one.groupBy("name_key").agg(F.min_by("held", "held.source_id").alias("held")).select("name_key", "held.*")

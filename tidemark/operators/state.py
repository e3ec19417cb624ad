"""State carried from run to run as keyed tables: history, registry, rolling records.

Every function gives the new state from the old and what a run saw; writing it is the caller's
(an overwrite of one partition or table, committed by Spark as a whole).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import last_n


def remember(history: DataFrame, seen: DataFrame, today: Column, keep_days: int = 120) -> DataFrame:
    """``history`` (key, event_id, fingerprint, stage, published, last_seen, versions) with a run's rows merged in.

    Of several rows of a key the last by ``place`` counts; versions and unseen keys live on;
    what was last seen more than ``keep_days`` ago goes.
    """
    fields = ["event_id", "fingerprint", "stage", "published"]
    new = seen.groupBy("key").agg(F.max_by(F.struct(*fields), "place").alias("n"))
    full = history.alias("h").join(new.alias("s"), "key", "full")
    hit = F.col("n").isNotNull()
    out = full.select("key", *(F.when(hit, F.col(f"n.{c}")).otherwise(F.col(f"h.{c}")).alias(c) for c in fields), F.when(hit, today).otherwise(F.col("h.last_seen")).alias("last_seen"), F.coalesce("h.versions", F.array().cast("array<string>")).alias("versions"))
    return out.where(F.col("last_seen") >= F.date_sub(today, keep_days))


def finalize(history: DataFrame, published: DataFrame, most: int = 10) -> DataFrame:
    """``history`` with the fingerprint of each published row (key, fingerprint, stage) added to its key's versions, the last ``most`` of them; doing it twice changes nothing."""
    p = published.groupBy("key").agg(F.max_by(F.struct("fingerprint", "stage"), "fingerprint").alias("p"))
    full = history.join(p, "key", "left")
    grown = last_n(F.array_distinct(F.concat("versions", F.array("p.fingerprint"))), most)
    return full.withColumn("versions", F.when(F.col("p").isNotNull(), grown).otherwise(F.col("versions"))).withColumn("published_stage", F.col("p.stage")).drop("p")


def revision(seen: DataFrame, history: DataFrame) -> DataFrame:
    """``seen`` (key, fingerprint, stage, published, modified) with ``changed`` and ``date_key``: content that differs from what is kept, with a stage that says so, is dated by its modification."""
    kept = history.select("key", F.col("fingerprint").alias("_kept"))
    full = seen.join(kept, "key", "left")
    changed = F.coalesce((F.col("_kept") != F.col("fingerprint")) & F.col("stage").isin("outcome", "subsequent_development"), F.lit(False))
    return full.withColumn("changed", changed).withColumn("date_key", F.when(changed & F.col("modified").isNotNull(), F.col("modified")).otherwise(F.col("published"))).drop("_kept")


def register(rows: DataFrame) -> DataFrame:
    """One row of a registry for each key: the first method and reliability by ``place``, all provenances once in order, verified if ever."""
    order = F.array_sort(F.collect_list(F.struct("place", "provenance")))
    return rows.groupBy("key").agg(
        F.min_by("method", "place").alias("method"), F.min_by("reliability", "place").alias("reliability"),
        F.array_distinct(F.filter(F.transform(order, lambda x: x["provenance"]), lambda x: x.isNotNull())).alias("provenances"), F.coalesce(F.bool_or("verified"), F.lit(False)).alias("verified"),
    )


def roll(record: Column, added: Column, most: int) -> Column:
    """``record`` with what isn't in it yet appended, blanks left out, the last ``most``."""
    none = F.array().cast("array<string>")
    return last_n(F.filter(F.array_distinct(F.concat(F.coalesce(record, none), F.coalesce(added, none))), lambda x: x != ""), most)

"""Queries on mixed timestamp formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import alias_table, name_key
from tidemark.functions.timestamps import with_utc
from tidemark.runtime import table

FIELDS = ["published_date", "event_date", "modified_date"]


def candidate_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """candidate_id, field_name, raw, utc_text of every date field that holds anything."""
    rows = table(spark, sf_dir, "candidates").select("candidate_id", "source_org", *FIELDS)
    alias = alias_table(table(spark, sf_dir, "sources"), "home_zone", "date_order")
    named = rows.withColumn("name_key", name_key("source_org")).join(alias, "name_key", "left")
    named = named.select("candidate_id", F.coalesce("home_zone", F.lit("UTC")).alias("zone"), F.coalesce(F.col("date_order") == "mdy", F.lit(False)).alias("month_first"), *FIELDS)
    return with_utc(named, FIELDS, "zone", "month_first").select("candidate_id", "field_name", "raw", "utc_text")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidate_instants(spark, sf_dir).where("utc_text is not null and raw <> utc_text").select("candidate_id", "field_name", "utc_text")


def p5_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that denote no full date, by field."""
    return candidate_instants(spark, sf_dir).where("utc_text is null").groupBy("field_name").agg(F.count(F.lit(1)).alias("values"), F.count("raw").alias("not_null"))


QUERIES = {"p5_found": p5_found, "p5_unknown": p5_unknown}
SQL: dict[str, str] = {}

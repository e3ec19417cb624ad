"""The candidate's view of the tables that many queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import iso_prefix
from tidemark.operators.scoring import Lexicon
from tidemark.plans.common import sql_iso
from tidemark.runtime import table

#: Words that the invented policy texts use, for the queries; the library's default patterns are ``scoring.DEFAULT``.
FITTED = Lexicon(
    topics={"environment": "carbon|methane|mangrove|peatland|biodiversity|nutrient", "development": "school meals|clinic|sanitation|gender|pension|housing", "economy": "levy|tax|debt|tariff|lending|trade", "governance": "treaty|charter|council|secretariat|compact"},
    mechanism="revised|voted|consultations|tested|rejected|deadline|terms of", implication="ministry|commission|tribunal|agency|bank", noise=r"\b(?:monitor|Q&A)\b",
)

SQL_C = f"c AS (SELECT *, {sql_iso('published_date')} AS published FROM candidates)"


def candidates(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The named columns of candidates, with ``published`` where ``published_date`` is read."""
    df = table(spark, sf_dir, "candidates").select(*columns)
    return df.withColumn("published", iso_prefix("published_date")) if "published_date" in columns else df


def blank(c: str):  # noqa: ANN201
    return F.coalesce(F.col(c), F.lit(""))

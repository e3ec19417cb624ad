"""Writing issues and reading them back: archives, indexes, search rows, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_archive(items: DataFrame, path: str, day: str = "digest_date") -> None:
    """One folder of JSON lines a day; days that are written again are replaced, others stay."""
    items.where(F.col(day).isNotNull()).repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false").partitionBy(day).json(path)


def read_archive(spark: SparkSession, path: str, schema: str, day: str = "digest_date", latest: int | None = None) -> DataFrame:
    """Archived items; of the ``latest`` days only, if given: other folders aren't read. Bad lines are left out."""
    df = spark.read.schema(f"{schema}, {day} date").option("mode", "DROPMALFORMED").json(path)
    if latest is None:
        return df
    days = df.select(day).distinct().orderBy(F.desc(day)).limit(latest)
    return df.join(F.broadcast(days), day, "left_semi")  # at most ``latest`` rows


def merge_index(index: DataFrame, new: DataFrame, day: str = "digest_date") -> DataFrame:
    """The index with the rows of ``new`` in place of those of the same days."""
    return index.join(new.select(day), day, "left_anti").unionByName(new)


def search_rows(items: DataFrame, kind: str, ident: str, texts: list[str]) -> DataFrame:
    """id, kind, day, title, source, url, text, topics: one row of the search index for each item."""
    text = F.lower(F.concat_ws(" ", *texts))
    return items.select(F.concat_ws("-", F.col("digest_date").cast("string"), F.lit(kind), F.col(ident).cast("string")).alias("id"), F.lit(kind).alias("kind"), F.col("digest_date").alias("day"), F.col("title_en").alias("title"), F.col("source_org").alias("source"), "url", text.alias("text"), F.array_join("tags", " ").alias("topics"))


def markdown(items: DataFrame, title: str, url: str, text: str) -> DataFrame:
    """digest_date, n_items, page: an issue as Markdown; an issue is edited by hand, so small."""
    line = F.concat(F.lit("## ["), F.coalesce(F.col(title), F.lit("")), F.lit("]("), F.coalesce(F.col(url), F.lit("")), F.lit(")\n\n"), F.coalesce(F.col(text), F.lit("")))
    rows = items.where("digest_date is not null").groupBy("digest_date").agg(F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list(F.struct("place", line.alias("line")))).alias("l"))
    return rows.select("digest_date", "n_items", F.concat(F.lit("# "), F.date_format("digest_date", "yyyy-MM-dd"), F.lit("\n\n"), F.array_join(F.transform("l", lambda x: x["line"]), "\n\n")).alias("page"))

"""Queries on streams; each runs over all events that are there, then ends."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.common import Registry
from tidemark.runtime import shared_dir, table
from tidemark.streaming import events

add = Registry()
QUERIES, SQL = add.queries, add.sql


def _out(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


@add("st_window", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def st_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts by type from the stream; nothing in the table is later than the watermark allows."""
    s = events.windowed(events.read_events(spark, f"{sf_dir}/events.parquet"), "1 hour", "40 days", "event_type")
    done = events.run_to_end(s, "complete", _out(spark), ["start", "event_type"])
    return done.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@add("st_revisions", "WITH e AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prior FROM events) SELECT user_id, count(*) AS n_seen, count(*) FILTER (WHERE prior <> event_type) AS n_changes, arg_max(event_type, (ts, event_id)) AS stage FROM e GROUP BY 1")
def st_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each key's state after the stream: how often seen and changed, and its last stage."""
    s = events.revisions(events.read_events(spark, f"{sf_dir}/events.parquet", 1_000_000))
    return events.run_to_end(s, "update", _out(spark), ["user_id"]).select("user_id", "n_seen", "n_changes", "stage")


@add("st_sessions", "WITH g AS (SELECT *, (ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE)::INT AS gap FROM events), s AS (SELECT *, sum(coalesce(gap, 0)) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k")
def st_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions with gaps under thirty minutes; the batch form."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return events.sessions(e, "30 minutes", "1 day", "user_id").select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


# --- the relational star, as a demonstration that plain SQL runs beside the operators ---------


@add("q1", "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY 1, 2")
def q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("date"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))


@add("q3", "SELECT o_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE c_mktsegment = 'BUILDING' GROUP BY 1 ORDER BY revenue DESC, o_orderkey LIMIT 10")
def q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(c, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderkey").agg(F.round(F.sum("r"), 2).alias("revenue")).orderBy(F.desc("revenue"), "o_orderkey").limit(10)


@add("f_cos", "WITH e AS (SELECT vec_id, label, embedding FROM embeddings) SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM e ORDER BY vec_id LIMIT 1)), 5) AS cosine FROM e")
def f_cos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of every vector with the first."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    query = F.array(*(F.lit(x) for x in e.agg(F.min_by("v", "vec_id")).first()[0] or [])).cast("array<double>")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return e.select("vec_id", F.round(dot(F.col("v"), query) / F.sqrt(dot(F.col("v"), F.col("v")) * dot(query, query)), 5).alias("cosine"))

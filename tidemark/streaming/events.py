"""Streams: event-time windows, sessions, and keyed state with eviction.

A batch form of each stands beside it in ``plans.streams``, and tests hold the two together.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 8) -> DataFrame:
    """A stream of event files; event time in ``ts`` as a timestamp. ``path`` is a folder or a single file, read as a pattern, as streams take no plain files."""
    schema = spark.read.parquet(path).schema
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{path[:-1]}[{path[-1]}]")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed(events: DataFrame, size: str, late: str, by: str) -> DataFrame:
    """Counts and sums by event-time window and key; rows later than ``late`` behind the latest are dropped by the watermark."""
    held = events.withWatermark("ts", late) if events.isStreaming else events
    return held.groupBy(F.window("ts", size).alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), by, "n", "total")


def sessions(events: DataFrame, gap: str, late: str, by: str) -> DataFrame:
    """Sessions of a key: events less than ``gap`` apart."""
    held = events.withWatermark("ts", late) if events.isStreaming else events
    return held.groupBy(F.session_window("ts", gap).alias("s"), by).agg(F.count(F.lit(1)).alias("n")).select(by, F.col("s.start").alias("start"), "n")


LATEST = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("n_seen", T.LongType()), T.StructField("n_changes", T.LongType()), T.StructField("stage", T.StringType()), T.StructField("last_seen", T.TimestampType())])
STATE = T.StructType([T.StructField("n_seen", T.LongType()), T.StructField("n_changes", T.LongType()), T.StructField("stage", T.StringType()), T.StructField("last_us", T.LongType())])


def revisions(events: DataFrame, keep_ms: int | None = None) -> DataFrame:
    """For each key how often it was seen, how often its stage changed in order of time, and what it is now.

    Rows of a micro-batch are taken in order of time; one later than what was seen already counts
    as seen but changes nothing. With ``keep_ms`` a key not seen for so long is forgotten.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        n, changes, stage, last = state.get if state.exists else (0, 0, None, -(1 << 62))
        rows = pd.concat(list(batches))
        rows["us"] = rows["ts"].astype("datetime64[us]").astype("int64")
        for r in rows.sort_values(["us", "event_id"]).itertuples():
            n += 1
            if r.us >= last:
                changes += stage is not None and r.event_type != stage
                stage, last = r.event_type, int(r.us)
        state.update((n, changes, stage, last))
        if keep_ms:
            state.setTimeoutDuration(keep_ms)
        yield pd.DataFrame({"user_id": [key[0]], "n_seen": [n], "n_changes": [changes], "stage": [stage], "last_seen": pd.to_datetime([last], unit="us")})

    timeout = GroupStateTimeout.ProcessingTimeTimeout if keep_ms else GroupStateTimeout.NoTimeout
    return events.groupBy("user_id").applyInPandasWithState(step, LATEST, STATE, "update", timeout)


def run_to_end(stream: DataFrame, mode: str, out: str, keys: list[str]) -> DataFrame:
    """The stream's result over all that is there now, as a table in ``out``: every micro-batch is written whole, the last row of a key counts."""

    def sink(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("_epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{out}/result/epoch={epoch}")

    query = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = stream.sparkSession.read.parquet(f"{out}/result").drop("epoch")
    names = [c for c in rows.columns if c not in (*keys, "_epoch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*names), "_epoch").alias("r")).select(*keys, "r.*")

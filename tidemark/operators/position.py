"""Numbering rows in a total order without bringing them to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.runtime import cut_lineage, fresh


def with_position(df: DataFrame, order: list[Column], out: str = "pos") -> DataFrame:
    """``df`` with each row's place, from 1, in ``order`` (which should be total).

    A range sort numbers rows within its partitions; partitions' sizes, one number each, give
    the offsets. An empty table stays empty.
    """
    m = fresh(df, "_m")
    ordered = cut_lineage(df.sort(*order)).withColumn(m, F.monotonically_increasing_id())
    part, place = F.shiftright(m, 33), F.col(m).bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row to a partition of the sort
    offsets = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).drop("_n")
    return ordered.join(F.broadcast(offsets), part == F.col("_part")).withColumn(out, place + F.col("_before") + 1).drop(m, "_part", "_before")

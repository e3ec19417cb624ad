"""What every operator needs from the session: tables, lineage cuts, checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, a Parquet file or folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share.

    Read from ``spark.checkpoint.dir``; only where that is unset a temporary folder is made and
    set, and only on a local master: on a cluster no machine's own folder would do.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    held = spark.sparkContext.getCheckpointDir()
    if not held:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        held = spark.sparkContext.getCheckpointDir()
    return held


_SHIPPED: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    fd, name = tempfile.mkstemp(prefix="tidemark-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    spark.sparkContext.addPyFile(name)
    _SHIPPED[app] = name


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as a checkpoint in the shared folder: it survives the loss of an executor and is computed once."""
    spark = df.sparkSession
    where = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(where)
    return df.checkpoint(eager=True)


def salted_join(left: DataFrame, right: DataFrame, on: list[str], weight: str, spread: Column, salts: int = 64, share: float = 0.001, how: str = "inner") -> DataFrame:
    """Join rows to one row per key where some keys may hold a third of all rows.

    ``right`` has one row per key, with the key's number of left rows in ``weight``. Keys
    holding more than ``share`` of all rows are hot: there are at most ``1 / share`` of them,
    whatever the size of the data, so that list may be broadcast. A hot key's rows are spread
    over ``salts`` partitions by ``spread`` and its right row is repeated for each.
    """
    salt, hot = (fresh(left, fresh(right, n)) for n in ("_salt", "_hot"))
    total = right.agg((F.sum(weight) * F.lit(share)).alias("_limit"))
    # one row, and at most 1 / share rows
    heavy = right.join(F.broadcast(total), F.col(weight) > F.greatest(F.col("_limit"), F.lit(100_000)), "left_semi").select(*on, F.lit(True).alias(hot))
    heavy = F.broadcast(heavy)
    salted = left.join(heavy, on, "left").withColumn(salt, F.when(F.col(hot), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(F.lit(0))).drop(hot)
    copies = right.join(heavy, on, "left").withColumn(salt, F.explode(F.when(F.col(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))).drop(hot)
    return salted.join(copies, [*on, salt], how).drop(salt)


def require(df: DataFrame, *columns: str) -> None:
    """Fail early, naming what is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}; there are {', '.join(df.columns)}")


def fresh(df: DataFrame, name: str) -> str:
    """A column name near ``name`` that ``df`` doesn't have."""
    lower = {c.lower() for c in df.columns}
    while name.lower() in lower:
        name += "_"
    return name


def bounded_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows, never more, chosen by a hash of ``key``: the same rows on every run. For fitting models only.

    Give it an unfiltered table: the rows are then counted from ``key`` alone, and other columns
    are read for the chosen rows' files in one scan.
    """
    total = df.select(key).count()
    if total <= bound:
        return df
    rate = int(bound / total * (1 << 62))
    return df.where(F.xxhash64(F.lit(7), F.col(key)).bitwiseAND(F.lit((1 << 62) - 1)) < F.lit(rate)).limit(bound)

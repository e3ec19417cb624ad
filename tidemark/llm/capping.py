"""Capping records per dominant contributor by radix selection.

The order of a contributor's records (score from high to low, null last, then smaller id)
is encoded as seventeen order-preserving bytes: a null flag, eight score bytes, eight id bytes.
Scores may be integers, fractions or decimals of up to 18 digits; ids are integers, others are refused.
Counts per contributor and byte value, summed before the shuffle, fix one digit of each
contributor's cutoff at a time; only records that share all digits fixed so far go on to the
next digit, and bytes in which no two records differ are skipped. At last every record is held
against its contributor's cutoff by comparison. No group is ever sorted or collected: what a
contributor costs is 256 counters a digit, and contributors of very many records are salted
wherever records meet their cutoffs.

A cap is a count, or with ``share_caps`` a share of the records that come in.

Defined results: records with a null contributor column or a null cap are never over the
limit; a cap of 0 or less puts all over; null and not-a-number scores come last; records equal in score and id
stand or fall together, so that never more than the cap remain; an empty table gives an empty
one; all other columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.functions.names import alias_table, name_key
from tidemark.runtime import cut_lineage, fresh, require, salted_join, table

WORDS = ("last", "hi", "lo")
#: Digits of the key: (word, shift), from the most to the least significant.
DIGITS = [("last", 0)] + [(w, s) for w in ("hi", "lo") for s in range(56, -1, -8)]
SIGN = -(1 << 63)
#: Records of a contributor from which its join is salted.
HOT = 100_000
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@F.pandas_udf(T.LongType())
def _double_bits(x: pd.Series) -> pd.Series:
    """Integers in the order of the numbers: the bits of a double, those of negative ones turned round."""
    bits = (x.to_numpy(np.float64) + 0.0).view(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ np.int64((1 << 63) - 1), bits))


def _keys(df: DataFrame, score: str, ident: str) -> tuple[Column, Column, Column]:
    """The words of the key; their unsigned order is rank order."""
    kind, of = df.schema[score].dataType, F.col(score)
    if not isinstance(df.schema[ident].dataType, _WHOLE):
        raise ValueError(f"{ident} must be a whole number, not {df.schema[ident].dataType.simpleString()}")
    none = of.isNull()
    # no score counts as 0 behind all others, so that it has few bytes of its own
    if isinstance(kind, _WHOLE):
        value = F.coalesce(of.cast("long"), F.lit(0).cast("long"))
    elif isinstance(kind, T.DecimalType) and kind.precision <= 18:
        value = F.coalesce((of * F.lit(10**kind.scale)).cast("long"), F.lit(0).cast("long"))
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        none = none | F.isnan(of)
        value = _double_bits(F.when(none, F.lit(0.0)).otherwise(of.cast("double")))
    else:
        raise ValueError(f"{score} must be a number of up to 64 bits, not {kind.simpleString()}")
    return F.when(none, 1).otherwise(0).cast("long"), F.bitwise_not(value.bitwiseXOR(F.lit(SIGN))), F.col(ident).cast("long").bitwiseXOR(F.lit(SIGN))


def _digit(word: str, shift: int) -> Column:
    return F.shiftrightunsigned(F.col(word), shift).bitwiseAND(F.lit(255)).cast("int")


def _unsigned(c: Column) -> Column:
    """Signed numbers in the order of unsigned words."""
    return c.bitwiseXOR(F.lit(SIGN))


def _meet(left: DataFrame, right: DataFrame, on: list[str], weight: str, most: int, spread: Column, how: str = "inner") -> DataFrame:
    """Each record with its contributor's row; salted where the largest contributor, of ``most`` records, is large enough for that to matter."""
    return left.join(right, on, how) if most <= HOT else salted_join(left, right, on, weight, spread, how=how)


def cutoffs(rows: DataFrame, group: list[str]) -> DataFrame | None:
    """group..., cut_last, cut_hi, cut_lo, size of each contributor that is over its cap: records at or after the cutoff are over.

    ``rows`` has group..., last, hi, lo, cap; size is the contributor's number of records.
    """
    span = rows.agg(*(f(w).alias(f"{n}_{w}") for w in WORDS for n, f in (("and", F.bit_and), ("or", F.bit_or)))).first()
    if span is None or span["and_hi"] is None:
        return None
    parts: list[DataFrame] = []
    live = [(w, s) for w, s in DIGITS if (span[f"and_{w}"] ^ span[f"or_{w}"]) >> s & 255] or [DIGITS[-1]]
    fixed = {w: sum((span[f"and_{w}"] >> s & 255) << s for v, s in DIGITS if v == w and (w, s) not in live) for w in WORDS}
    fixed = {w: x - (1 << 64) if x >= 1 << 63 else x for w, x in fixed.items()}
    cuts = [f"cut_{w}" for w in WORDS]
    room = F.greatest(F.col("cap").cast("long"), F.lit(0).cast("long"))
    left = rows.withColumns({f"cut_{w}": F.lit(fixed[w]).cast("long") for w in WORDS} | {"room": room, "size": F.lit(0).cast("long")})
    for at, (word, shift) in enumerate(live):
        count = left.groupBy(*group, *cuts, "room", "size", _digit(word, shift).alias("digit")).agg(F.count(F.lit(1)).alias("n"))
        # at most 256 rows to a contributor: the window is bounded by construction
        mine = Window.partitionBy(*group)
        count = count.withColumn("upto", F.sum("n").over(mine.orderBy("digit"))).withColumn("held", F.sum("n").over(mine))
        count = count.where((F.col("upto") > F.col("room")) & (F.col("upto") - F.col("n") <= F.col("room")))
        step = count.select(*group, *cuts, "digit", "held", F.greatest("size", "held").alias("size"), (F.col("room") - (F.col("upto") - F.col("n"))).alias("room"))
        step = cut_lineage(step.withColumn(f"cut_{word}", F.col(f"cut_{word}").bitwiseOR(F.shiftleft(F.col("digit").cast("long"), shift))))
        done = (F.col("room") == 0) | F.lit(at == len(live) - 1)
        parts.append(step.where(done).select(*group, *cuts, "size"))
        if at == len(live) - 1:
            break
        go = step.where(~done)
        most = go.agg(F.max("held")).first()[0]
        if most is None:
            break
        left = _meet(left.select(*group, *WORDS), go, group, "held", most, F.col("lo")).where(_digit(word, shift) == F.col("digit"))
        left = cut_lineage(left.select(*group, *WORDS, *cuts, "room", "size"))
    return reduce(DataFrame.unionByName, parts)


def share_caps(df: DataFrame, share: float, within: list[str], cap: str = "cap") -> DataFrame:
    """``df`` with a column ``cap``: ``share`` of the number of records that have the same values in ``within`` (of all, if there are no such columns), rounded down."""
    require(df, *within)
    if cap in df.columns:
        raise ValueError(f"there is a column {cap} already")
    total = df.groupBy(*within).agg(F.count(F.lit(1)).alias("_n"))
    of = (lambda n: F.floor(n * F.lit(share) + F.lit(1e-9)))
    if not within:
        return df.withColumn(cap, of(F.lit(total.first()["_n"])))
    names = {c: fresh(df, f"_w{i}") for i, c in enumerate(within)}
    total = total.select(*(F.col(c).alias(n) for c, n in names.items()), F.col("_n").alias(cap))
    n = fresh(df, "_n")
    mine = df.withColumns({g: F.col(c) for c, g in names.items()})
    return salted_join(mine, total.withColumnRenamed(cap, n), list(names.values()), n, F.xxhash64(*df.columns[:1]), how="left").withColumn(cap, of(F.col(n))).drop(n, *names.values())


def cap_records(df: DataFrame, contributor: list[str], score: str, ident: str, cap: str, flag: str = "over_limit") -> DataFrame:
    """``df`` with a boolean column ``flag``: true for records beyond their contributor's ``cap``."""
    require(df, *contributor, score, ident, cap)
    if flag in df.columns:
        raise ValueError(f"there is a column {flag} already")
    names = {c: fresh(df, f"_g{i}") for i, c in enumerate(contributor)}
    words = [fresh(df, f"_key_{w}") for w in WORDS]
    group = list(names.values())
    keyed = df.withColumns({g: F.col(c) for c, g in names.items()} | dict(zip(words, _keys(df, score, ident), strict=True)))
    mine = reduce(Column.__and__, (F.col(c).isNotNull() for c in [*contributor, cap]))
    cut = cutoffs(keyed.where(mine).select(*group, *(F.col(c).alias(w) for c, w in zip(words, WORDS, strict=True)), F.col(cap).alias("cap")), group)
    if cut is None:
        return df.withColumn(flag, F.lit(False))
    ends = [fresh(df, f"_cut_{w}") for w in WORDS]
    cut = cut.withColumnsRenamed(dict(zip([f"cut_{w}" for w in WORDS], ends, strict=True)) | {"size": fresh(df, "_size")})
    size = fresh(df, "_size")
    joined = _meet(keyed, cut, group, size, cut.agg(F.max(size)).first()[0] or 0, F.col(words[-1]), "left")
    key, end = (F.struct(*(_unsigned(F.col(c)) for c in cs)) for cs in (words, ends))
    over = F.col(ends[0]).isNotNull() & F.col(cap).isNotNull() & (key >= end)
    return joined.withColumn(flag, F.coalesce(over, F.lit(False))).select(*df.columns, flag)


def candidates_over_limit(candidates: DataFrame, sources: DataFrame) -> DataFrame:
    """Candidates beyond sources.max_per_run of their run and source, whatever the spelling of the source."""
    named = candidates.withColumn("name_key", name_key("source_org")).join(alias_table(sources, "max_per_run"), "name_key", "left")
    return cap_records(named, ["run_id", "source_id"], "semantic_score", "candidate_id", "max_per_run")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "candidates").select("candidate_id", "run_id", "source_org", "semantic_score")
    return candidates_over_limit(rows, table(spark, sf_dir, "sources")).where("over_limit").select("candidate_id")


def p1_kept_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and kept records of each source, over all runs."""
    rows = table(spark, sf_dir, "candidates").select("candidate_id", "run_id", "source_org", "semantic_score")
    capped = candidates_over_limit(rows, table(spark, sf_dir, "sources"))
    return capped.where("source_name is not null").groupBy("source_name").agg(F.count(F.lit(1)).alias("records"), F.sum(F.when(F.col("over_limit"), 0).otherwise(1)).alias("kept"))


_NAMED = r"""
WITH spelled AS (SELECT source_id, name, max_per_run, unnest(list_append(coalesce(aliases, []), name)) AS s FROM sources),
keys AS (SELECT regexp_replace(lower(s), '[^\p{L}\p{N}]+', '', 'g') AS k, min(source_id) AS source_id FROM spelled GROUP BY 1),
ranked AS (SELECT c.candidate_id, s.name AS source_name, s.max_per_run, row_number() OVER (PARTITION BY c.run_id, s.source_id ORDER BY c.semantic_score DESC NULLS LAST, c.candidate_id) AS rank
  FROM candidates c JOIN keys ON keys.k = regexp_replace(lower(c.source_org), '[^\p{L}\p{N}]+', '', 'g') JOIN sources s ON s.source_id = keys.source_id WHERE c.run_id IS NOT NULL)
"""

QUERIES = {"p1_found": p1_found, "p1_kept_share": p1_kept_share}
SQL = {
    "p1_found": _NAMED + "SELECT candidate_id FROM ranked WHERE rank > max_per_run",
    "p1_kept_share": _NAMED + "SELECT source_name, count(*) AS records, count(*) FILTER (WHERE rank <= max_per_run) AS kept FROM ranked GROUP BY 1",
}

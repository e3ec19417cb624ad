"""Duplicates hidden by formatting: white space, letter case, punctuation, order of fields.

The characters of a batch lie in one array. A lookup table skips or folds each of them, and
rolling polynomial hashes (sums of value times power, modulo 2**64, for three bases) run over
what is left, so no canonical string is ever made. The text before the first ``?`` hashes in
order; the fields after it, parted at ``&``, hash each by itself and are summed, so their order
doesn't count. Rows are grouped by 128 bits of hash, counted map-side first; then each copy is
verified against its group's first row by two pointers that skip what doesn't count. A row
that fails there (two addresses under one hash) is grouped again under its third hash, and one
that fails again (texts can be made that all three confuse) by its folded text itself.

What counts: letters and digits, in lower case. All else is skipped: white space, invisible
characters, punctuation, symbols. An empty field counts as none.

Defined results: null texts belong to no group; texts with no letter or digit at all are one
group; equal rows count one by one,
the smallest id being the first; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.runtime import cut_lineage, require, salted_join, table

BASES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
M1, M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
QUERY, FIELD = ord("?"), ord("&")


def fold(code: int) -> int:
    """The folded code of a character, 0 if it is skipped."""
    c = chr(code)
    if not c.isalnum():
        return 0
    low = c.lower()
    return ord(low) if len(low) == 1 else ord(next(x for x in low if x.isalnum()))


@lru_cache(1)
def ascii_table() -> np.ndarray:
    return np.array([fold(c) for c in range(128)], dtype=np.uint32)


def folded(codes: np.ndarray) -> np.ndarray:
    """``codes`` through the table; other than ASCII is looked up once for each distinct character."""
    out = ascii_table()[np.minimum(codes, 127)]
    far = codes > 127
    if far.any():
        which, back = np.unique(codes[far], return_inverse=True)
        out[far] = np.array([fold(int(c)) for c in which], dtype=np.uint32)[back]
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * M1
    x = (x ^ (x >> np.uint64(29))) * M2
    return x ^ (x >> np.uint64(32))


def hashes(texts: list[str], fields: bool = True) -> np.ndarray:
    """An array of shape (3, rows): the hashes of each text."""
    with np.errstate(over="ignore"):
        n = len(texts)
        lens = np.fromiter(map(len, texts), np.int64, n)
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat(np.arange(n), lens)
        first = np.concatenate([[0], np.cumsum(lens)])[:-1]
        value = folded(codes).astype(np.uint64)
        # parts: the text up to the first "?", then each field
        if fields:
            asked = np.concatenate([[0], np.cumsum(codes == QUERY)])
            inside = (asked[1:] - asked[np.repeat(first, lens)]) > 0
            cuts = inside & ((codes == FIELD) | ((codes == QUERY) & (asked[1:] - asked[np.repeat(first, lens)] == 1)))
        else:
            inside = cuts = np.zeros(len(codes), bool)
        start = np.zeros(len(codes), bool)
        start[first[lens > 0]] = True
        part = np.cumsum(start | cuts) - 1
        keep = value > 0
        part, value, row, inside = part[keep], value[keep], row[keep], inside[keep]
        out = np.zeros((3, n), np.uint64)
        if not len(part):
            return out
        heads = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        size = np.diff(np.concatenate([heads, [len(part)]]))
        place = np.arange(len(part)) - np.repeat(heads, size)
        of_row, as_field = row[heads], inside[heads]
        for k, base in enumerate(BASES):
            powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(size.max()), base)]).astype(np.uint64))
            sums = np.add.reduceat(value * powers[place], heads)
            mixed = _mix(sums + size.astype(np.uint64) * base)
            np.add.at(out[k], of_row, np.where(as_field, _mix(mixed + base), mixed))
        return out


def same_spelling(a: str, b: str, fields: bool = True) -> bool:
    """Two pointers over ``a`` and ``b``, skipping what doesn't count; fields are matched one to one in any order."""
    if a == b:
        return True
    (ha, _, fa), (hb, _, fb) = (a.partition("?"), b.partition("?")) if fields else ((a, "", ""), (b, "", ""))
    if not _walk(ha, hb):
        return False
    left = [x for x in fb.split("&") if not _walk(x, "")]
    for x in fa.split("&"):
        if _walk(x, ""):
            continue
        hit = next((i for i, y in enumerate(left) if _walk(x, y)), None)
        if hit is None:
            return False
        left.pop(hit)
    return not left


_fold = lru_cache(1 << 16)(fold)


def folded_text(text: str, fields: bool = True) -> str:
    """One string for all spellings of a text; what separates its parts is no letter or digit, so no two texts share it."""
    flat = lambda x: "".join(chr(f) for c in x if (f := _fold(ord(c))))
    head, _, asked = text.partition("?") if fields else (text, "", "")
    return "?".join([flat(head), *sorted(filter(None, map(flat, asked.split("&"))))])


def _walk(a: str, b: str) -> bool:
    i, j, n, m = 0, 0, len(a), len(b)
    while True:
        while i < n and not _fold(ord(a[i])):
            i += 1
        while j < m and not _fold(ord(b[j])):
            j += 1
        if i == n or j == m:
            return i == n and j == m
        if a[i] != b[j] and _fold(ord(a[i])) != _fold(ord(b[j])):
            return False
        i += 1
        j += 1


def with_spelling_hash(df: DataFrame, text: str, fields: bool = True) -> DataFrame:
    """``df`` of ident and text columns, and h1, h2, h3; rows with a null text are left out."""
    names = df.columns
    schema = T.StructType([*df.schema.fields, *(T.StructField(h, T.LongType(), False) for h in ("h1", "h2", "h3"))])
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = hashes(b.column(at).to_pylist(), fields).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(x) for x in h)], names=[*names, "h1", "h2", "h3"])

    return df.where(df[text].isNotNull()).mapInArrow(run, schema)


def _verified(fields: bool) -> Callable[..., Column]:
    @F.pandas_udf(T.BooleanType())
    def verified(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([same_spelling(x, y, fields) for x, y in zip(a, b, strict=True)], dtype=bool)

    return verified


def _folded_text(fields: bool) -> Callable[..., Column]:
    @F.pandas_udf(T.StringType())
    def one(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: folded_text(x, fields))

    return one


def _pairs(rows: DataFrame, keys: list[str], fields: bool) -> DataFrame:
    """id, text, h3, first_id, first_text, same of each row whose key an earlier row has."""
    first = rows.groupBy(*keys).agg(F.min_by(F.struct("id", "text"), "id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.where("n > 1").select(*keys, F.col("first.id").alias("first_id"), F.col("first.text").alias("first_text"), "n")
    joined = salted_join(rows, first, keys, "n", F.col("id")).where(F.col("id") > F.col("first_id"))
    return joined.select("id", "text", "h3", "first_id", "first_text", _verified(fields)("text", "first_text").alias("same"))


def hidden_copies(df: DataFrame, ident: str, text: str, fields: bool = True) -> DataFrame:
    """first_id, copy_id of each row that repeats an earlier one in another dress. Ids must be unique."""
    require(df, ident, text)
    rows = with_spelling_hash(df.select(df[ident].alias("id"), df[text].alias("text")), "text", fields)
    pairs = cut_lineage(_pairs(rows, ["h1", "h2"], fields))
    found = pairs.where("same").select("first_id", F.col("id").alias("copy_id"))
    failed = pairs.where("not same").select("id", "text", "first_id", "h3")
    if not failed.isEmpty():
        again = failed.select("id", "text", F.col("first_id").alias("h1"), "h3").withColumn("h2", F.lit(0))
        third = cut_lineage(_pairs(again, ["h1", "h3"], fields).join(failed.select("id", F.col("first_id").alias("h1")), "id"))
        found = found.unionByName(third.where("same").select("first_id", F.col("id").alias("copy_id")))
        last = third.where("not same").select("id", "text", "h1", "h3")
        if not last.isEmpty():
            exact = _pairs(last.withColumn("folded", _folded_text(fields)("text")), ["h1", "h3", "folded"], fields)
            found = found.unionByName(exact.where("same").select("first_id", F.col("id").alias("copy_id")))
    return found


def collapse(df: DataFrame, ident: str, text: str, fields: bool = True) -> DataFrame:
    """first_id, n_copies: one row for each different text, with the number of rows that have it."""
    copies = hidden_copies(df, ident, text, fields)
    extra = copies.groupBy(F.col("first_id").alias("_f")).agg(F.count(F.lit(1)).alias("_n"))
    rows = df.where(df[text].isNotNull()).select(df[ident].alias("first_id"))
    rows = rows.join(copies, rows["first_id"] == copies["copy_id"], "left_anti")
    return rows.join(extra, rows["first_id"] == extra["_f"], "left").select("first_id", (F.coalesce("_n", F.lit(0)) + 1).alias("n_copies"))


TABLES = {"candidates": "candidate_id", "summary": "summary_id"}


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [hidden_copies(table(spark, sf_dir, t).select(i, "url"), i, "url").select(F.lit(t).alias("record_table"), "first_id", "copy_id") for t, i in TABLES.items()]
    return reduce(DataFrame.unionByName, parts)


def p4_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each address, with its number of copies."""
    parts = [collapse(table(spark, sf_dir, t).select(i, "url"), i, "url").select(F.lit(t).alias("record_table"), "first_id", "n_copies") for t, i in TABLES.items()]
    return reduce(DataFrame.unionByName, parts)


def _sql(last: str) -> str:
    both = " UNION ALL ".join(f"SELECT '{t}' AS record_table, {i} AS id, url FROM {t} WHERE url IS NOT NULL" for t, i in TABLES.items())
    flat = lambda x: rf"regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}]+', '', 'g')"
    # in the query part only: text after the first question mark
    asked = "CASE WHEN instr(url, '?') > 0 THEN substr(url, instr(url, '?') + 1) ELSE '' END"
    fields = f"list_sort(list_filter(list_transform(string_split({asked}, '&'), lambda x: {flat('x')}), lambda x: x <> ''))"
    return f"WITH rows AS ({both}), keyed AS (SELECT record_table, id, {flat('split_part(url, chr(63), 1)')} AS head, {fields} AS fields FROM rows) {last}"


QUERIES = {"p4_found": p4_found, "p4_addresses": p4_addresses}
SQL = {
    "p4_found": _sql("SELECT record_table, first_id, id AS copy_id FROM (SELECT record_table, id, min(id) OVER (PARTITION BY record_table, head, fields) AS first_id FROM keyed) WHERE id > first_id"),
    "p4_addresses": _sql("SELECT record_table, min(id) AS first_id, count(*) AS n_copies FROM keyed GROUP BY record_table, head, fields"),
}

"""Deduplicating new batches against all history, without going through history's texts again.

Two ways lead from a new record to an accepted one:

* identity: the same address, DOI or fingerprint, spelling and prefixes aside, values that stand
  for "none" or for an empty text left out; an equi-join on normalised keys;
* content: title and summary as one text, in words. Equal texts meet by a hash of the whole.
  For the rest, content-defined chunking ends a chunk at
  every word whose hash falls under a bound, so an edit only changes the chunk it is in. Accepted
  records keep their chunks in a table of chunk to record that is written once and appended to.
  The longest chunks, up to ``1 - SPARE`` of the bytes, are indexed, chunks held by very many
  accepted records last; a batch's chunks meet that table. Of two texts that share a chunk only
  those go on that may have ``SAME`` of their words in common: their numbers of words tell, and 192
  bits of each text, one by the parity of the words that hash to it (the second "the" of a text
  being another word than the first), of which no more can differ than words do. So pairs that merely share a phrase, whose number grows as the square of the
  tables, are never written anywhere, and none is lost. The rest is compared word by word.

``Accepted`` holds history in the session; a ``Store`` keeps it in the shared folder, each table
parted into buckets of its join key. A batch then reads only the buckets that its keys, chunks
and pairs fall into, so the bytes of history it reads fall with the batch, and accepting a batch
appends to the tables without reading them.

Rows of the batch with equal text are one row up to the end. The list of very common chunks has
at most ``COMMON`` entries whatever the size of history, as each holds more than that share of
all chunks; besides it only the numbers of buckets are collected.

Defined results: null or blank keys identify nothing; a record without a word in its summary has no
content to share; a summary shorter than ``SHORT`` words only with an equal text; repeated rows of a batch each
match; a pair found both ways comes out once; empty tables give an empty one.
"""

from __future__ import annotations

import html
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.runtime import cut_lineage, require, shared_dir, table

#: Mean bytes of a chunk; share of a text's bytes not indexed; common chunks at most; share of a text's bytes, below which shared chunks don't tell.
MEAN, SPARE, COMMON, COVER = 28, 0.35, 4_000, 0.12
#: Least share of words in common, in order; fewest words of a summary; pairs looked at in one go.
SAME, SHORT, STEP = 0.85, 5, 1 << 18
#: Columns of 64 bits each that a text is told apart by.
BITS = ("b1", "b2", "b3")
_WORD = re.compile(r"[㐀-鿿豈-﫿぀-ヿ]|[^\W_]+")
_TAG = re.compile(r"<[^<>]*>")
#: Beginnings of the digests of an empty text, and values that stand for none. Fixed values.
EMPTY = ("e3b0c44298fc1c14", "d41d8cd98f00b204", "da39a3ee5e6b4b0d", "cf83e1357eefb8bd", "0000000000000000", "ffffffffffffffff")
NONE = r"^(?:unknown|none|null|na|nil|pending|tbd|tbc|todo|notavailable|notassigned|test|example|xxx+|0*)$"


def words(text: str | None) -> list[str]:
    """Words in lower case, ideographs one by one; markup, punctuation and spacing aside."""
    return _WORD.findall(html.unescape(_TAG.sub(" ", text)).lower()) if text else []


@lru_cache(1 << 16)
def _ends(word: str) -> tuple[bool, int]:
    size = len(word.encode()) + (0 if word >= "぀" else 1)
    return xxhash.xxh32_intdigest(word) < size * (1 << 32) // MEAN, size


def chunks(text: list[str]) -> list[tuple[int, int]]:
    """(hash, bytes) of each chunk."""
    out, at, size = [], 0, 0
    for k, w in enumerate(text):
        end, n = _ends(w)
        size += n
        if end or k == len(text) - 1:
            out.append((xxhash.xxh64_intdigest(" ".join(text[at : k + 1])) - (1 << 63), size))
            at, size = k + 1, 0
    return out


def indexed(found: list[tuple[int, int]], common: dict[int, int]) -> list[tuple[int, int]]:
    """The chunks that are indexed, in an order that is the same for all records."""
    total, held, out = sum(n for _, n in found), 0, []
    for h, n in sorted(set(found), key=lambda c: (common.get(c[0], 0), -c[1], c[0])):
        out.append((h, n))
        held += n
        if held > (1 - SPARE) * total:
            break
    return out


def probed(found: list[tuple[int, int]], common: dict[int, int]) -> list[tuple[int, int]]:
    """The indexed chunks but for the most common, which together have less than ``COVER`` of the bytes: what shares ``COVER`` still shares one of the rest."""
    left, out = COVER * sum(n for _, n in found), []
    for h, n in reversed(indexed(found, common)):  # the most common first
        if h in common and n < left:
            left -= n
        else:
            out.append((h, n))
    return out


_place = lru_cache(1 << 16)(xxhash.xxh32_intdigest)


def parity(text: list[str]) -> tuple[int, ...]:
    """As many bits as ``BITS`` hold; no more of them differ between two texts than words do, repetitions counted."""
    out, seen = 0, Counter()
    for w in text:
        n = seen[w]
        seen[w] = n + 1
        out ^= 1 << (((_place(w) + n * 0x9E3779B1 & 0xFFFFFFFF) * 64 * len(BITS)) >> 32)
    return tuple((out >> 64 * k & ((1 << 64) - 1)) - (1 << 63) for k in range(len(BITS)))


def _chunked(df: DataFrame, common: dict[int, int] | None) -> DataFrame:
    """id, t1, t2 (hash of the words), ``BITS`` (their parity), words, chunks, sizes of rows id, title, summary with a summary; all chunks, or those to look up, none of short summaries."""
    schema = T.StructType([df.schema["id"], *(T.StructField(n, T.LongType()) for n in ("t1", "t2", *BITS)), T.StructField("words", T.IntegerType()), T.StructField("chunks", T.ArrayType(T.LongType())), T.StructField("sizes", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, marks, found = [], [], []
            for k, (title, summary) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
                body = words(summary)
                if not body:
                    continue
                text = words(title) + body
                c = chunks(text) if len(body) >= SHORT else []
                keep.append(k)
                whole = xxhash.xxh128_intdigest(" ".join(text))
                marks.append(((whole >> 64) - (1 << 63), (whole & ((1 << 64) - 1)) - (1 << 63), *parity(text), len(text)))
                found.append(c if common is None else probed(c, common))
            columns = [b.column(0).take(pa.array(keep, pa.int64())), *(pa.array([m[i] for m in marks], pa.int64()) for i in range(2 + len(BITS))), pa.array([m[-1] for m in marks], pa.int32())]
            columns += [pa.array([[h for h, _ in c] for c in found], pa.list_(pa.int64())), pa.array([[n for _, n in c] for c in found], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return df.select("id", "title", "summary").mapInArrow(run, schema)


def _common(chunked: DataFrame) -> dict[int, int]:
    """Chunks held by so many records that each has more than 1 / COMMON of all chunks: fewer than COMMON."""
    count = chunked.select(F.explode("chunks").alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    total = chunked.agg(F.sum(F.size("chunks"))).first()[0] or 0
    return {r["hash"]: r["n"] for r in count.where(F.col("n") > max(total / COMMON, 5)).limit(COMMON).collect()}


def _tables(accepted: DataFrame, chunked: DataFrame, common: dict[int, int]) -> dict[str, DataFrame]:
    """The tables in which accepted records are looked up, by name; the first column or two of each are the key."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def pick(found: pd.Series, sizes: pd.Series) -> pd.Series:
        return pd.Series([[h for h, _ in indexed(list(zip(f.tolist(), n.tolist(), strict=True)), common)] for f, n in zip(found, sizes, strict=True)])

    posted = chunked.where(F.size("chunks") > 0).select("id", *BITS, "words", F.explode(pick("chunks", "sizes")).alias("hash"))
    return {
        "postings": posted.select("hash", F.col("id").alias("kept_id"), *BITS, "words"),
        "whole": chunked.select("t1", "t2", F.col("id").alias("kept_id")),
        "keys": identity_keys(accepted).select("kind", "key", F.col("id").alias("kept_id")),
        "texts": accepted.select(F.col("id").alias("kept_id"), F.col("title").alias("a_title"), F.col("summary").alias("a_summary")),
    }


#: The columns of the stored tables, and those that a table is looked up and parted by.
_SCHEMAS = {
    "postings": "hash long, kept_id {}, " + ", ".join(f"{b} long" for b in BITS) + ", words int, bucket int", "whole": "t1 long, t2 long, kept_id {}, bucket int", "keys": "kind string, key string, kept_id {}, bucket int",
    "texts": "kept_id {}, a_title string, a_summary string, bucket int",
}
_BY = {"postings": ("hash",), "whole": ("t1",), "keys": ("key",), "texts": ("kept_id",)}


class Accepted:
    """Accepted records (id, url, doi, fingerprint, title, summary) of one session, and the common chunks among theirs."""

    def __init__(self, accepted: DataFrame) -> None:
        chunked = cut_lineage(_chunked(accepted, None))
        self.common = _common(chunked)
        self._tables = _tables(accepted, chunked, self.common)

    def near(self, name: str, probes: DataFrame) -> DataFrame:
        """A table, or of a stored one what may meet ``probes``."""
        return self._tables[name]


class Store:
    """Accepted records in ``path`` of the shared folder, each table parted into ``buckets``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256) -> None:
        self.spark, self.path, self.buckets, self.read = spark, path, buckets, Counter()
        self.common: dict[int, int] = {}

    @classmethod
    def create(cls, path: str, accepted: DataFrame, buckets: int = 256) -> Store:
        """Writes the tables; the common chunks are counted once, and those that come later are indexed by the same list."""
        store = cls(accepted.sparkSession, path, buckets)
        chunked = cut_lineage(_chunked(accepted, None))
        store.common = _common(chunked)
        store.spark.createDataFrame([(h, n) for h, n in store.common.items()], "hash long, n long").coalesce(1).write.mode("error").parquet(f"{path}/common")
        accepted.select("id").limit(0).coalesce(1).write.mode("error").parquet(f"{path}/ids")
        store._write(_tables(accepted, chunked, store.common), "error")
        return store

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int = 256) -> Store:
        store = cls(spark, path, buckets)
        store.common = {r["hash"]: r["n"] for r in spark.read.parquet(f"{path}/common").toLocalIterator()}  # fewer than COMMON
        return store

    def _bucket(self, name: str) -> Column:
        return F.pmod(F.xxhash64(*_BY[name]), F.lit(self.buckets)).cast("int")

    def _write(self, tables: dict[str, DataFrame], mode: str) -> None:
        for name, df in tables.items():
            df.withColumn("bucket", self._bucket(name)).repartition("bucket").write.mode(mode).partitionBy("bucket").parquet(f"{self.path}/{name}")

    def append(self, accepted: DataFrame) -> None:
        """Adds newly accepted records; nothing written is read again."""
        self._write(_tables(accepted, cut_lineage(_chunked(accepted, None)), self.common), "append")

    def near(self, name: str, probes: DataFrame) -> DataFrame:
        """The rows of the buckets that the keys of ``probes`` fall into: at most ``buckets`` numbers are collected."""
        need = sorted(r[0] for r in probes.select(self._bucket(name).alias("b")).distinct().collect())
        self.read[name] += len(need)
        kind = self.spark.read.parquet(f"{self.path}/ids").schema["id"].dataType.simpleString()
        df = self.spark.read.schema(_SCHEMAS[name].format(kind)).parquet(f"{self.path}/{name}")
        return df.where(F.col("bucket").isin(need)).drop("bucket")


def same_text(a: list[str], b: list[str]) -> bool:
    """At least ``SAME`` of the words in common and in the same order."""
    if a == b:
        return True
    n = len(a) + len(b)
    if 2 * min(len(a), len(b)) < SAME * n or 2 * sum((Counter(a) & Counter(b)).values()) < SAME * n:
        return False
    return SequenceMatcher(None, a, b, autojunk=False).ratio() >= SAME


def meet(postings: DataFrame, probes: DataFrame) -> DataFrame:
    """kept_id, id of the rows with an equal hash that may be the same text, some repeatedly; both have hash, ``BITS``, words.

    Both sides lie in one table ordered by hash, the accepted first, so a task holds the accepted rows of one hash at most.
    """
    schema = T.StructType([postings.schema["kept_id"], probes.schema["id"]])
    sides = postings.select("hash", "kept_id", F.lit(None).cast(schema["id"].dataType).alias("id"), F.lit(False).alias("new"), *BITS, "words")
    sides = sides.unionByName(probes.select("hash", F.lit(None).cast(schema["kept_id"].dataType).alias("kept_id"), "id", F.lit(True).alias("new"), *BITS, "words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            old, new = (pa.Table.from_batches([b.filter(m)]) for m in (pc.invert(b.column("new")), b.column("new")))
            old = pa.concat_tables([held, old]).combine_chunks() if held is not None else old
            (oh, on, *ob), (nh, nn, *nb) = ([t.column(c).to_numpy() for c in ("hash", "words", *BITS)] for t in (old, new))
            first = np.searchsorted(oh, nh, "left")
            count = np.searchsorted(oh, nh, "right") - first
            end = np.cumsum(count)
            for at in range(0, int(end[-1]) if len(end) else 0, STEP):
                to = min(at + STEP, int(end[-1]))
                a, z = np.searchsorted(end, at, "right"), np.searchsorted(end, to, "left") + 1
                begun = np.maximum(end[a:z] - count[a:z], at)
                times = np.minimum(end[a:z], to) - begun
                n = np.repeat(np.arange(a, z), times)
                o = np.arange(at, to) - np.repeat(end[a:z] - count[a:z] - first[a:z], times)
                total = on[o] + nn[n]
                apart = sum(np.bitwise_count((x[o] ^ y[n]).view(np.uint64)) for x, y in zip(ob, nb, strict=True))
                ok = apart <= (1 - SAME) * total + 1e-6
                ok &= 2 * np.minimum(on[o], nn[n]) >= SAME * total - 1e-6
                if ok.any():
                    yield pa.RecordBatch.from_arrays([old.column("kept_id").take(pa.array(o[ok])).combine_chunks(), new.column("id").take(pa.array(n[ok])).combine_chunks()], names=["kept_id", "id"])
            last = b.column("hash")[b.num_rows - 1].as_py() if b.num_rows else None
            held = old.slice(int(np.searchsorted(oh, last, "left"))) if last is not None else held

    return sides.repartition("hash").sortWithinPartitions("hash", "new").mapInArrow(run, schema)


def content_pairs(batch: DataFrame, accepted: Accepted | Store) -> DataFrame:
    """kept_id, id: rows of ``batch`` (id, title, summary) whose text is that of an accepted record but for about one word in ten."""
    mine = cut_lineage(_chunked(batch, accepted.common))
    # rows of equal text are one up to the end: the first stands for all, chosen map-side first
    one = mine.where(F.size("chunks") > 0).groupBy("t1", "t2").agg(F.min_by(F.struct("id", "chunks", *BITS, "words"), "id").alias("r")).select("r.*")
    probes = one.select(F.explode("chunks").alias("hash"), "id", *BITS, "words")
    pairs = cut_lineage(meet(accepted.near("postings", probes), probes).distinct())

    @F.pandas_udf(T.BooleanType())
    def compare(t1: pd.Series, s1: pd.Series, t2: pd.Series, s2: pd.Series) -> pd.Series:
        return pd.Series([same_text(words(a) + words(b), words(c) + words(d)) for a, b, c, d in zip(t1, s1, t2, s2, strict=True)], dtype=bool)

    texts = batch.select("id", F.col("title").alias("b_title"), F.col("summary").alias("b_summary"))
    full = pairs.join(accepted.near("texts", pairs), "kept_id").join(texts, "id")
    sure = full.where(compare("a_title", "a_summary", "b_title", "b_summary")).select("kept_id", "id")
    hashes = mine.select("id", "t1", "t2")
    by_text = hashes.join(sure, "id").select("kept_id", "t1", "t2").unionByName(accepted.near("whole", hashes)).distinct()
    return by_text.join(hashes, ["t1", "t2"]).select("kept_id", "id")


_KEEP = r"[^\p{L}\p{N}]+"


def url_key(c: Column | str) -> Column:
    """Letters and digits of an address in lower case, fields sorted; without scheme, ``www.``, tracking fields and what follows ``#``."""
    bare = F.regexp_replace(F.lower(F.col(c) if isinstance(c, str) else c), r"[\s\p{Z}\p{Cf}\p{Cc}]+|#.*$", "")
    head = F.regexp_replace(F.substring_index(bare, "?", 1), r"^[^\p{L}\p{N}]*(?:https?(?![\p{L}\p{N}])[^\p{L}\p{N}]*)?(?:www[^\p{L}\p{N}]+)?", "")
    query = F.when(F.instr(bare, "?") > 0, F.substring(bare, F.instr(bare, "?") + 1, F.length(bare))).otherwise("")
    fields = F.filter(F.split(query, "&"), lambda x: ~x.rlike(r"^[^\p{L}\p{N}]*(?:utm[^\p{L}\p{N}]|fbclid|gclid)"))
    fields = F.array_sort(F.filter(F.transform(fields, lambda x: F.regexp_replace(x, _KEEP, "")), lambda x: x != ""))
    key = F.concat_ws("?", F.regexp_replace(head, _KEEP, ""), F.array_join(fields, "&"))
    return F.when(F.length(key) > 1, key)


def doi_key(c: Column | str) -> Column:
    """A DOI without prefix, spaces and punctuation; null for what is none."""
    low = F.regexp_replace(F.lower(F.col(c) if isinstance(c, str) else c), r"[\s\p{Z}\p{Cf}]+", "")
    doi = F.regexp_extract(low, r"(10\.\d{4,9}/.+)$", 1)
    registrant, suffix = F.regexp_extract(doi, r"^10\.(\d+)/", 1), F.regexp_replace(F.regexp_extract(doi, "^[^/]+/(.+)$", 1), _KEEP, "")
    key = F.concat_ws("/", registrant, suffix)
    return F.when((doi != "") & (suffix != "") & ~suffix.rlike(NONE) & ~registrant.rlike("^0+$"), key)


def fingerprint_key(c: Column | str) -> Column:
    """A fingerprint's hexadecimal digits; null for one of an empty text or no fingerprint at all."""
    low = F.regexp_replace(F.lower(F.col(c) if isinstance(c, str) else c), r"^[^\p{L}\p{N}]*(?:sha-?\d+|md5|fp|fingerprint)\s*[:=\-]\s*|[^\p{L}\p{N}]+", "")
    key = F.regexp_replace(low, r"^(?:sha\d{3}|md5)(?=[0-9a-f]{16})", "")
    return F.when(key.rlike("^[0-9a-f]{12,}$") & ~key.rlike("^(?:" + "|".join(EMPTY) + ")"), key)


def identity_keys(df: DataFrame) -> DataFrame:
    """id, kind, key of each address, DOI and fingerprint that identifies something."""
    keys = F.array(*(F.struct(F.lit(n).alias("kind"), k.alias("key")) for n, k in (("u", url_key("url")), ("d", doi_key("doi")), ("f", fingerprint_key("fingerprint")))))
    return df.select("id", F.explode(keys).alias("k")).select("id", "k.*").where("key is not null")


def identity_pairs(batch: DataFrame, accepted: Accepted | Store) -> DataFrame:
    """kept_id, id: rows that share an address, DOI or fingerprint. ``batch`` has id, url, doi, fingerprint. Keys of very many rows are split by the adaptive join."""
    mine = identity_keys(batch)
    return mine.join(accepted.near("keys", mine), ["kind", "key"]).select("kept_id", "id")


COLUMNS = ("id", "url", "doi", "fingerprint", "title", "summary")


def duplicates(batch: DataFrame, accepted: DataFrame | Accepted | Store) -> DataFrame:
    """kept_id, id: each row of ``batch`` with each accepted record it repeats. Both have id, url, doi, fingerprint, title, summary."""
    require(batch, *COLUMNS)
    if isinstance(accepted, DataFrame):
        require(accepted, *COLUMNS)
        accepted = Accepted(accepted)
    return identity_pairs(batch, accepted).unionByName(content_pairs(batch, accepted)).distinct()


def _candidates(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    return (rows or table(spark, sf_dir, "candidates")).selectExpr("candidate_id id", "url", "doi", "content_fingerprint fingerprint", "title", "summary_hint summary")


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "history").selectExpr("history_id id", "url", "doi", "fingerprint", "title", "summary_hint summary")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates(_candidates(spark, sf_dir), _history(spark, sf_dir)).select(F.col("kept_id").alias("history_id"), F.col("id").alias("candidate_id"))


def p6_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each run's number of candidates, and of those that history doesn't hold yet."""
    rows = table(spark, sf_dir, "candidates").select("candidate_id", "run_id")
    known = p6_found(spark, sf_dir).select("candidate_id").distinct().withColumn("known", F.lit(1))
    return rows.join(known, "candidate_id", "left").groupBy("run_id").agg(F.count(F.lit(1)).alias("n_candidates"), F.count_if(F.col("known").isNull()).alias("n_fresh"))


#: Batches that ``p6_batches`` makes of the runs.
BATCHES = 4


def p6_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs in ``BATCHES`` batches, each held against history and all that was accepted from the batches before.

    A candidate that repeats nothing accepted is accepted itself; ids of candidates and history don't overlap.
    """
    path = f"{shared_dir(spark).rstrip('/')}/history-{uuid.uuid4().hex}"
    store, out = Store.create(path, _history(spark, sf_dir), 64), []
    rows = table(spark, sf_dir, "candidates")
    for k in range(BATCHES):
        batch = _candidates(spark, sf_dir, rows.where(F.pmod(F.xxhash64("run_id"), F.lit(BATCHES)) == k) if k else rows.where((F.pmod(F.xxhash64("run_id"), F.lit(BATCHES)) == 0) | F.col("run_id").isNull()))
        known = cut_lineage(duplicates(batch, store).select("id").distinct())
        fresh = batch.join(known, "id", "left_anti")
        if k < BATCHES - 1:
            store.append(fresh)
        n = batch.count(), known.count()
        out.append((k, n[0], n[1], n[0] - n[1]))
    return spark.createDataFrame(out, "batch int, n_candidates long, n_known long, n_accepted long")


QUERIES = {"p6_found": p6_found, "p6_fresh": p6_fresh, "p6_batches": p6_batches}
SQL: dict[str, str] = {}

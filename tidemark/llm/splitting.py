"""Splitting oversized items at natural boundaries, with overlap, in tokens of a public tokenizer.

The tokenizer turns a text into ids and into a string of one letter a token, which says how
strong a boundary follows the token: ``P`` end of a paragraph, ``L`` of a line, ``S`` of a
sentence, ``C`` of a clause, ``W`` of a word, ``T`` of a character within a word, ``x`` none, as
the token ends inside a character. A regular expression of bounded quantifiers, its
alternatives ordered by strength, eats up to the limit again and again; the piece ends that it
gives and a look back of ``overlap`` tokens make the pieces, by SQL array functions.

A stronger boundary is only taken in the last ``slack`` part of a piece; a weaker one if
there is none. Each piece has at most ``limit`` tokens as ids; neighbours share exactly
``overlap`` tokens, fewer only where that many would begin inside a character.

Defined results: null and blank-free short texts give one piece (an empty or null text none);
a text without any boundary is cut between characters; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tokens import encode, encoding, token_sizes, vocabulary_path, with_token_count
from tidemark.runtime import require, table

LIMIT, OVERLAP = 1024, 64
#: The part of a piece at whose end each strength of boundary is looked for, strongest first.
SLACK = (("P", 0.5), ("[PL]", 0.5), ("[PLS]", 0.6), ("[PLSC]", 0.6), ("[PLSCW]", 1.0))
ENDS = ".!?。！？…"
CLAUSES = ",;:，；：、"
CLOSERS = "\"'”’»)]）」』"


def _of(codes: np.ndarray, chars: str) -> np.ndarray:
    return np.isin(codes, np.array([ord(c) for c in chars], dtype=codes.dtype))


SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strengths(text: str, token_bytes: np.ndarray) -> str:
    """One letter a token: how strong a boundary follows it.

    ``token_bytes``: the length of each token; together they are the text. White space belongs
    to the boundary before it: the letter at its first character counts as well as at its last.
    """
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    n = len(codes)
    space, line = _of(codes, SPACES), codes == 10
    ends, clauses = _of(codes, ENDS), _of(codes, CLAUSES)
    # what the last character says that is neither white space nor closing punctuation
    said = np.maximum.accumulate(np.where(~space & ~_of(codes, CLOSERS), np.arange(n), 0))
    held = np.where(ends[said], ord("S"), np.where(clauses[said], ord("C"), 0)).astype(np.uint8)
    shift = lambda x, by: np.concatenate([x[by:], np.ones(min(by, n), x.dtype)])[:n]  # noqa: E731  what follows; a text ends as a line does
    mark = np.full(n, ord("T"), np.uint8)
    mark = np.where((held > 0) & (codes > 0x2E80), held, mark)  # no space follows ideographic punctuation
    mark = np.where(space | shift(space, 1), np.where(held > 0, held, ord("W")), mark)
    before = np.concatenate([[False], line[:-1]]) if n else line
    mark = np.where(shift(line, 1) & ~space, np.where(shift(line, 2), ord("P"), ord("L")), mark)
    mark = np.where(line, np.where(before | shift(line, 1), ord("P"), ord("L")), mark)
    size = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    ended = np.cumsum(size)
    token_end = np.cumsum(token_bytes)
    at = np.searchsorted(ended, token_end)
    at = np.minimum(at, n - 1)
    out = np.where(ended[at] == token_end, mark[at], ord("x")).astype(np.uint8)
    return out.tobytes().decode("ascii")


def boundary_pattern(fresh_tokens: int) -> str:
    """Alternatives by strength, each up to ``fresh_tokens`` tokens; then characters; then anything."""
    parts = [f".{{{max(0, round(fresh_tokens * (1 - slack)) - 1)},{fresh_tokens - 1}}}{kind}" for kind, slack in SLACK]
    return "(?:" + "|".join([*parts, f".{{0,{fresh_tokens - 1}}}[^x]", f".{{1,{fresh_tokens}}}"]) + ")"


def _encoded(df: DataFrame, ident: str, text: str, limit: int, path: str) -> DataFrame:
    """ident, ids, marks of the texts of more than ``limit`` tokens, or of all for limit 0."""
    schema = T.StructType([df.schema[ident], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("marks", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = token_sizes(path)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                rows = [(k, t, ids) for k, t in enumerate(part.column(1).to_pylist()) if len(ids := encode(t, path)) > limit]
                if rows:
                    marks = [strengths(t, sizes[ids]) for _, t, ids in rows]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array([k for k, _, _ in rows])), pa.array([x for _, _, x in rows], pa.list_(pa.int32())), pa.array(marks)], names=[ident, "ids", "marks"])

    return df.select(ident, text).mapInArrow(run, schema)


def _decoded(df: DataFrame, path: str) -> DataFrame:
    schema = T.StructType([f for f in df.schema.fields if f.name != "ids"] + [T.StructField("n_tokens", T.IntegerType()), T.StructField("piece", T.StringType()), T.StructField("n_encoded", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path)
        for b in batches:
            ids = b.column("ids").to_pylist()
            rest = [c for n, c in zip(b.schema.names, b.columns, strict=True) if n != "ids"]
            texts = [enc.decode_bytes(x).decode("utf-8", "replace") for x in ids]
            yield pa.RecordBatch.from_arrays([*rest, pa.array([len(x) for x in ids], pa.int32()), pa.array(texts, pa.string()), pa.array([len(encode(t, path)) for t in texts], pa.int32())], names=[f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def piece_spans(df: DataFrame, ident: str, text: str, limit: int, overlap: int, oversized_only: bool, path: str) -> DataFrame:
    """ident, piece_no, from_token, ids of every piece."""
    coded = _encoded(df, ident, text, limit if oversized_only else 0, path)
    step = limit - overlap
    # the first piece has no overlap before it and may be as long as the limit
    head = F.regexp_extract("marks", "^" + boundary_pattern(limit), 0)
    rest = F.substring("marks", F.length(head) + 1, F.length("marks"))
    eaten = F.when(F.length("marks") <= limit, F.array("marks")).otherwise(F.concat(F.array(head), F.regexp_extract_all(rest, F.lit(boundary_pattern(step)), F.lit(0))))
    # ends of the pieces as running sums of the lengths eaten
    ends = F.aggregate("eaten", F.array().cast("array<int>"), lambda acc, m: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + F.length(m))))
    begins = F.transform("ends", lambda e, i: F.when(i == 0, F.lit(0)).otherwise(_whole(F.col("marks"), F.get("ends", i - 1), overlap)))
    out = coded.withColumn("eaten", eaten).withColumn("ends", ends).withColumn("begins", begins)
    out = out.select(ident, "ids", F.posexplode(F.arrays_zip(F.col("begins"), F.col("ends"))).alias("k", "span"))
    return out.select(ident, (F.col("k") + 1).alias("piece_no"), F.col("span.begins").alias("from_token"), F.slice("ids", F.col("span.begins") + 1, F.col("span.ends") - F.col("span.begins")).alias("ids"))


def split_items(df: DataFrame, ident: str = "doc_id", text: str = "text", limit: int = LIMIT, overlap: int = OVERLAP, oversized_only: bool = False, path: str | None = None) -> DataFrame:
    """ident, piece_no (from 1), from_token, n_tokens, piece, n_encoded of every item; no shuffle.

    ``n_tokens`` counts the item's own ids in the piece, ``n_encoded`` those of the piece encoded by itself, which may differ at its ends.
    ``from_token`` counts from 0; a piece after the first begins ``overlap`` tokens before the
    end of the one before it.
    """
    require(df, ident, text)
    if not 0 <= overlap < limit // 2:
        raise ValueError("overlap must be less than half of the limit")
    path = path or vocabulary_path()
    return _decoded(piece_spans(df, ident, text, limit, overlap, oversized_only, path), path)


def _whole(marks: Column, end: Column, overlap: int) -> Column:
    """The first token at or after end - overlap that doesn't begin inside a character."""
    start = F.greatest(end - F.lit(overlap), F.lit(0))
    # the token before the start must end a character; at most a few tokens are passed
    before = F.substring(marks, F.greatest(start, F.lit(1)), F.lit(4))
    skip = F.length(F.regexp_extract(before, "^x*", 0))
    return F.when(start == 0, start).otherwise(start + skip)


def oversized(df: DataFrame, ident: str = "doc_id", text: str = "text", limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """ident, n_tokens of the items of more than ``limit`` tokens."""
    return with_token_count(df.select(ident, text), text, keep=[ident], path=path).where(F.col("n_tokens") > limit)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the operator cuts: those with a second piece."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_spans(docs, "doc_id", "text", LIMIT, OVERLAP, True, vocabulary_path()).where("piece_no = 2").select("doc_id")


def p10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pieces of the documents over the limit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return split_items(docs, oversized_only=True)


QUERIES = {"p10_found": p10_found, "p10_pieces": p10_pieces}
SQL: dict[str, str] = {}

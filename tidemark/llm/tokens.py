"""Encoding a whole corpus with a public tokenizer.

A rank file on local disk is read once per Python worker. Texts reach it in Arrow batches.
A text longer than ``PIECE`` characters is cut before an ASCII space that follows a character
that isn't white space and precedes one that isn't: the tokenizer's pattern never matches
across such a place, so the ids of the pieces, one after the other, are the ids of the text.
Where a long text has no such place, it stays whole.

Defined results: null and empty texts both have an empty list; special tokens' strings are
ordinary text; ids decode byte by byte, so a cut inside a character loses nothing.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.runtime import fresh, require, table

TOKENIZER = "byte_bpe_50k"
#: Characters of a piece of a long text; ids don't depend on it.
PIECE = 8_000
#: Rows given to the tokenizer at a time.
STEP = 256
#: How the vocabulary splits text before merging. Fixed value of the public vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary_path(name: str = TOKENIZER, folder: str | None = None) -> str:
    """The rank file: in ``folder``, else in $PUBLIC_TOKENIZERS, else /opt/tokenizers."""
    return os.path.join(folder or os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers"), f"{name}.tiktoken")


@lru_cache(2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(2)
def token_sizes(path: str) -> np.ndarray:
    """The number of bytes of each id."""
    enc = encoding(path)
    return np.array([len(enc.decode_single_token_bytes(i)) for i in range(enc.n_vocab)], dtype=np.int64)


def safe_pieces(text: str, piece: int = PIECE) -> list[str]:
    """``text`` in pieces of about ``piece`` characters, cut where the pattern can't match across."""
    if len(text) <= piece:
        return [text]
    out, start = [], 0
    while len(text) - start > piece:
        cut = text.find(" ", start + piece)
        while cut != -1 and not (cut + 1 < len(text) and not text[cut - 1].isspace() and not text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if cut == -1:
            break
        out.append(text[start:cut])
        start = cut
    out.append(text[start:])
    return out


def encode(text: str | None, path: str) -> list[int]:
    if not text:
        return []
    enc = encoding(path)
    if len(text) <= PIECE:
        return enc.encode_ordinary(text)
    return [i for p in safe_pieces(text) for i in enc.encode_ordinary(p)]


def decode(ids: list[int], path: str) -> bytes:
    """The bytes of ``ids``; not necessarily whole characters."""
    return encoding(path).decode_bytes(ids)


def with_token_ids(df: DataFrame, text: str = "text", out: str = "ids", keep: list[str] | None = None, path: str | None = None) -> DataFrame:
    """``keep`` (all columns unless given) and the token ids of ``text`` in ``out``; no shuffle."""
    require(df, text, *(keep or []))
    keep = df.columns if keep is None else keep
    if out in keep:
        raise ValueError(f"there is a column {out} already")
    path = path or vocabulary_path()
    held = fresh(df.select(*keep), "_text")
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                b = batch.slice(at, STEP)
                ids = [encode(t, path) for t in b.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(ids, pa.list_(pa.int32()))], names=[*keep, out])

    return df.select(*keep, df[text].alias(held)).mapInArrow(run, schema)


def with_token_count(df: DataFrame, text: str = "text", out: str = "n_tokens", keep: list[str] | None = None, path: str | None = None) -> DataFrame:
    """``keep`` and the number of tokens of ``text``; the ids stay in the worker."""
    require(df, text, *(keep or []))
    keep = df.columns if keep is None else keep
    if out in keep:
        raise ValueError(f"there is a column {out} already")
    path = path or vocabulary_path()
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [len(encode(t, path)) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=[*keep, out])

    return df.select(*keep, df[text].alias(fresh(df.select(*keep), "_text"))).mapInArrow(run, schema)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_token_ids(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])


QUERIES = {"p8_ids": p8_ids}
SQL: dict[str, str] = {}

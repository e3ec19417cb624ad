"""Pluggable per-row and per-batch models, with offline defaults."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Scorer = Callable[[pd.DataFrame], pd.DataFrame]


def scored_by(df: DataFrame, ident: str, text: str, scorer: Scorer) -> DataFrame:
    """ident, score (0 to 2), reason of every row; ``scorer`` gets Arrow batches of id, text and gives id, score, reason of each row of it."""
    kind = df.schema[ident].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = scorer(b)
            if list(out["id"]) != list(b["id"]):
                raise ValueError("a scorer must answer every row, in order")
            yield out[["id", "score", "reason"]]

    return df.select(F.col(ident).alias("id"), F.col(text).alias("text")).mapInPandas(run, f"id {kind}, score int, reason string").withColumnRenamed("id", ident)


def by_words(words: tuple[str, ...]) -> Scorer:
    """The offline default: how many of ``words`` a text has, 2 at most."""

    def score(b: pd.DataFrame) -> pd.DataFrame:
        low = b["text"].fillna("").str.lower()
        n = sum((low.str.contains(w, regex=False).astype(int) for w in words), start=pd.Series(0, index=b.index))
        return pd.DataFrame({"id": b["id"], "score": n.clip(upper=2).astype("int32"), "reason": n.map(lambda k: f"{k} cues")})

    return score


def in_batches(df: DataFrame, ident: str, text: str, model: Callable[[list[str]], list[str]], size: int = 40) -> DataFrame:
    """ident, text_out: ``model`` gets at most ``size`` texts at a time and must give as many; null texts stay null."""
    kind = df.schema[ident].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            known = b[b["text"].notna()]
            out: dict = {}
            for at in range(0, len(known), size):
                part = known.iloc[at : at + size]
                said = model(part["text"].tolist())
                if len(said) != len(part):
                    raise ValueError("a model must answer every text")
                out.update(zip(part["id"], said, strict=True))
            yield pd.DataFrame({"id": b["id"], "text_out": [out.get(i) for i in b["id"]]})

    return df.select(F.col(ident).alias("id"), F.col(text).alias("text")).mapInPandas(run, f"id {kind}, text_out string").withColumnRenamed("id", ident)

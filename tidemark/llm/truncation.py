"""Texts cut off by field limits or in transfer.

Whatever was put after a text (markup, "continue reading" and the like, notices of the site) is
set aside first; hashed logistic regression then scores how the text itself closes: its last
characters and punctuation, open brackets and quotation marks, its last phrase with numbers
masked, the raw length against lengths that pile up in the corpus. Positives for training are
values of a bounded sample cut inside a sentence, with such notices put after some of them; negatives
are the sampled values as they are, whatever they end with. Some of these are cut, too: each is
judged by a model that hasn't seen it, and the next fit does without those taken for cut. Closing
remarks without a full stop are learnt from the values that have them, and from how often a last
phrase closes a value of the whole corpus; no remark is written down here. Every record of the
table is then scored.

Defined results: null and blank values are never cut; a value that ends with its sentence is
whole whatever follows; a value cut exactly at the end of a sentence counts as whole; where
there is nothing to learn from nothing is cut; an empty table gives an empty one. Ids need not be unique: every row is scored by itself.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import alias_table, name_key
from tidemark.runtime import bounded_sample, cut_lineage, require, table

#: Rows of a field that training may see, the longest of their values, and the size of the hashed weights.
SAMPLE, LONGEST, WIDTH = 5_000, 20_000, 1 << 15
#: Rounds of leaving out values taken for cut, parts of the sample in turn judged by the others' model, steps of a fit, its rate and shrinkage.
FITS, FOLDS, STEPS, RATE, SHRINK = 3, 2, 80, 0.5, 1e-2
#: Values that a piled-up length and a frequent phrase have at least, and the lengths that a pile is held against.
LEAST_PILED, LEAST_PHRASE, BESIDE = 8, 6, (-4, -3, -2, 2, 3, 4)
TERMINAL = ".!?。！？"
QUOTES = "\"'”’»」』“"
CLOSERS = QUOTES + ")]）"
#: What sites put after a text, whole or cut. Fixed values, with their translations.
AFTER = (
    r"\[more\]", r"(?<=[….])\s*more", r"continue reading", r"read more", r"read the full story", r"lire la suite", r"leer más", r"seguir leyendo", r"weiterlesen", r"阅读全文", r"→", r"»",
    r"share this\.?", r"the post appeared first on [^.]{1,80}\.?", r"published \d{1,2} \w{3,9} \d{4}\.?", r"[(\[]\s*\d+ min(?:utes?)? read\s*[)\]]", r"[(\[]\s*(?:…|\.{2,})\s*[)\]]", r"…", r"\.{2,}",
)
_AFTER = re.compile(rf"(?:{'|'.join(AFTER)})\s*$", re.I)
#: The most characters that what was put after a text takes, white space squeezed.
_FURTHEST = 160
_HALF_ENTITY = re.compile(r"&(?:#x?[0-9a-fA-F]{0,6}|[a-zA-Z]{0,7})$|\\(?:u[0-9a-fA-F]{0,4})?$")
_INVISIBLE = re.compile(r"[​‌‍﻿­]")
_STOP = re.compile(r"[.!?](?=[\"'”’»)\]]*\s)|[。！？]")
_MONTH = re.compile(r"\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\b")


def own_text(value: str) -> tuple[str, list[str]]:
    """The text without what was put after it, and what kinds of thing were."""
    text, seen = " ".join(_INVISIBLE.sub("", value).split()), []
    if text.endswith("�"):
        text, seen = text.rstrip("�"), ["torn byte"]
    while True:
        tail, tag = max(0, len(text) - _FURTHEST), text.rfind("<")
        closed = tag >= 0 and ">" in text[tag:]
        if closed and text.index(">", tag) == len(text) - 1:
            at = tag
            seen.append("tag")
        elif m := _AFTER.search(text, tail):
            at = m.start()
            seen.append(_MONTH.sub("month", re.sub(r"\d+|on .*", "#", m.group().strip().lower())))
        elif tag >= 0 and not closed and (text[tag + 1 : tag + 2].isalpha() or text[tag + 1 : tag + 2] in ("", "/", "!")):
            at = tag
            seen.append("half tag")
        elif m := _HALF_ENTITY.search(text, tail):
            at = m.start()
            seen.append("half entity")
        elif text and text[-1] in QUOTES and _AFTER.search(text.rstrip(QUOTES + " "), tail):
            text = text.rstrip(QUOTES + " ")
            continue
        else:
            return html.unescape(re.sub(r"<[^<>]*>", " ", text) if tag >= 0 else text).strip(), seen
        text = text[:at].rstrip()


def _before_closers(text: str) -> int:
    n = len(text)
    while n and (text[n - 1] in CLOSERS or text[n - 1] == " "):
        n -= 1
    return n


def last_phrase(own: str) -> str:
    """What follows the last sentence end, or the last sentence where the text ends with one; numbers and months masked."""
    body = own[: _before_closers(own)].rstrip(TERMINAL)
    at = max((m.end() for m in _STOP.finditer(body)), default=0)
    tail = body[at:].lstrip(CLOSERS + " \n\t").lower()
    return _MONTH.sub("month", re.sub(r"\d[\d,.]*", "#", re.sub(r"https?://\S+", "url", tail)))


def _phrase_hash(phrase: str) -> int:
    return zlib.crc32(phrase.encode())


def features(value: str, piled: frozenset[int], frequent: frozenset[int]) -> list[int]:
    own, after = own_text(value)
    at = _before_closers(own)
    last = own[at - 1] if at else ""
    kind = "none" if not last else "end" if last in TERMINAL else "letter" if last.isalpha() else "digit" if last.isdigit() else "sign"
    phrase = last_phrase(own)
    words = phrase.split()
    torn = bool({"torn byte", "half tag", "half entity"} & set(after))
    f = ["bias", f"kind {kind}", f"kind {kind} after {bool(after)}", f"at limit {len(value) in piled} {kind}", f"torn {torn}", f"torn {torn} {kind}", f"last {own[at - 1 : at]}", f"open {own.count('(') > own.count(')')} {kind}", f"closed {at < len(own)} {kind}"]
    f += [f"after {a} {kind}" for a in set(after)]
    if kind != "end" and words:
        often = _phrase_hash(phrase) in frequent
        f += [f"words {min(len(words), 12)}", f"frequent {often}", f"first {words[0]}", f"listed {words[0][-1] == ':'} {phrase.count(';') > 1}"]
        if often:
            f.append(f"phrase {phrase}")
    return [zlib.crc32(x.encode()) % WIDTH for x in f]


class Model:
    """Weights, lengths that pile up, and hashes of the phrases that close many texts."""

    def __init__(self, weights: np.ndarray, piled: frozenset[int], frequent: frozenset[int]) -> None:
        self.weights, self.piled, self.frequent = weights, piled, frequent

    def score(self, values: list[str | None]) -> list[float | None]:
        return [None if v is None or not v.strip() else float(1 / (1 + np.exp(-np.clip(self.weights[features(v, self.piled, self.frequent)].sum(), -30, 30)))) for v in values]


#: What may follow a text, cut or not, and what a cut tears. Fixed values.
ENDINGS = (" […]", " Published 3 May 2026.", " (4 min read)", " Share this.", "</p>", "<br/>", " [more]", " The post appeared first on Site.", "… Continue reading →", "”", "»")
TEARS = ("", "", "", " Published 3 May 2026.", "…", "...", " […]", " [...]", " (...)", "… Continue reading →", "...more", "…more", " [more]", "... Read more", "... Read the full story", "”", "</p>", "</", " (4 min read)", " Share this.", "…</p>", '<a href="htt', "&#82", "�", " The post appeared first on Site.")


def cut_artificially(value: str, rng: random.Random, limits: list[int]) -> str | None:
    """``value`` cut inside a sentence, with what sites put after a cut; None if it is too short."""
    own, _ = own_text(value)
    if len(own) < 40:
        return None
    at = rng.choice(limits) if limits and rng.random() < 0.4 else rng.randrange(20, len(own) - 5)
    if at >= len(own) - 5:
        at = rng.randrange(20, len(own) - 5)
    if rng.random() < 0.5 and " " in own[20:at]:
        at = own.rindex(" ", 20, at)
    text = own[:at].rstrip()
    if not text or text[_before_closers(text) - 1 :][:1] in TERMINAL or last_phrase(text) == "":
        return None
    return text + rng.choice(TEARS)


def _closing(value: str) -> int | None:
    """The hash of the masked last phrase of a value that doesn't end with its sentence."""
    own, _ = own_text(value)
    at = _before_closers(own)
    return _phrase_hash(last_phrase(own)) if at and own[at - 1] not in TERMINAL else None


def _piled(lengths: dict[int, int], least: float) -> frozenset[int]:
    return frozenset(n for n, k in lengths.items() if k >= least and k > 4 * np.mean([lengths.get(n + d, 0) for d in BESIDE]))


def corpus_statistics(rows: DataFrame) -> tuple[frozenset[int], frozenset[int]]:
    """The lengths that pile up and the hashes of frequent closing phrases of all values of ``_value``.

    At most 100,000 lengths, as each holds that share of all values, and 1,500 phrases for the same reason.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            values = [v for v in b["_value"] if v and v.strip()]
            out = [(n, None, k) for n, k in Counter(map(len, values)).items()]
            out += [(None, p, k) for p, k in Counter(p for p in map(_closing, values) if p is not None).items()]
            yield pd.DataFrame(out, columns=["size", "phrase", "n"]).astype({"size": "Int64", "phrase": "Int64"})

    counts = cut_lineage(rows.select("_value").mapInPandas(count, "size long, phrase long, n long").groupBy("size", "phrase").agg(F.sum("n").alias("n")))
    lengths = counts.where("size is not null").select("size", "n")
    total = lengths.agg(F.sum("n")).first()[0] or 0
    # beside the lengths next to it, which a limit may share
    beside = lengths.select(F.explode(F.array(*(F.col("size") + d for d in BESIDE))).alias("size"), F.col("n").alias("b")).groupBy("size").agg(F.sum("b").alias("b"))
    high = lengths.where(F.col("n") >= max(LEAST_PILED, total // 100_000)).join(beside, "size", "left")
    piled = high.where(F.col("n") > 4 * F.coalesce("b", F.lit(0)) / len(BESIDE)).select("size").collect()
    phrases = counts.where("phrase is not null").where(F.col("n") >= max(LEAST_PHRASE, total // 1500)).select("phrase").collect()
    return frozenset(r[0] for r in piled), frozenset(r[0] for r in phrases)


def _regress(rows: list[tuple[int, ...]], negative: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Weights of logistic regression on rows that stand for so many of each class, by steps scaled to each weight's past gradients; both classes count alike."""
    weights = np.zeros(WIDTH)
    chosen = np.flatnonzero(negative + positive)
    if not len(chosen):
        return weights
    which = np.repeat(np.arange(len(chosen)), [len(rows[k]) for k in chosen])
    feats, at = np.unique(np.fromiter((f for k in chosen for f in rows[k]), np.int64, len(which)), return_inverse=True)
    w, squares, total = np.zeros(len(feats)), np.full(len(feats), 1e-8), negative.sum() + positive.sum()
    low, high = negative[chosen] / max(1, negative.sum()) / 2, positive[chosen] / max(1, positive.sum()) / 2
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(which, w[at], len(chosen)), -30, 30)))
        g = np.bincount(at, (p * low - (1 - p) * high)[which], len(feats)) + SHRINK * w / total
        squares += g * g
        w -= RATE * g / np.sqrt(squares)
    weights[feats] = w
    return weights


def statistics_of(values: list[str]) -> tuple[frozenset[int], frozenset[int]]:
    """As ``corpus_statistics``, of a list."""
    phrases = Counter(p for p in map(_closing, values) if p is not None)
    return _piled(Counter(map(len, values)), LEAST_PILED), frozenset(p for p, n in phrases.items() if n >= max(LEAST_PHRASE, len(values) // 1500))


def fit(fields: list[list[str]], statistics: list[tuple[frozenset[int], frozenset[int]]] | None = None, seed: int = 11) -> list[Model]:
    """A model for each field, from their values as they are and cut; the weights are of all fields together, ``statistics`` those of each whole field, else of the values."""
    rng = random.Random(seed)
    fields = [[v for v in f if v and v.strip()] for f in fields]
    statistics = statistics or [statistics_of(f) for f in fields]
    frequent = frozenset().union(*(s[1] for s in statistics))
    rows: dict[tuple[int, ...], int] = {}
    row_of = lambda v, piled: rows.setdefault(tuple(features(v, piled, frequent)), len(rows))
    whole, follow, cut = [], [], []  # rows by number; -1 for none
    for values, (piled, _) in zip(fields, statistics, strict=True):
        for v in dict.fromkeys(values):
            whole.append(row_of(v, piled))
            # a value with something of a site's after it stays what it is
            follow.append(row_of(v + rng.choice(ENDINGS), piled) if rng.random() < 0.3 else -1)
            cut.append(row_of(c, piled) if (c := cut_artificially(v, rng, sorted(piled))) else -1)
    whole, follow, cut, listed = np.array(whole, int), np.array(follow, int), np.array(cut, int), list(rows)
    of = np.array([rng.randrange(FOLDS) for _ in whole])

    def weights(chosen: np.ndarray, kept: np.ndarray) -> np.ndarray:
        count = lambda *which: sum(np.bincount(x[x >= 0], minlength=len(listed)) for x in which)
        return _regress(listed, count(whole[chosen & kept], follow[chosen & kept]), count(cut[chosen]))

    kept = np.ones(len(whole), bool)
    for _ in range(FITS):
        now = kept.copy()
        for k in range(FOLDS):  # a value is judged by a model that hasn't seen it
            w = weights(of != k, kept)
            for i in np.flatnonzero(of == k):
                now[i] = w[list(listed[whole[i]])].sum() <= 0
        if (now == kept).all():
            break
        kept = now
    last = weights(np.ones(len(whole), bool), kept)
    return [Model(last, piled, frequent) for piled, _ in statistics]


def models_for(fields: list[tuple[DataFrame, str, str]], sample: int = SAMPLE) -> list[Model]:
    """A model for each field (table, id, text), from at most ``sample`` values of each and the statistics of all of them."""
    chosen, statistics = [], []
    for df, ident, text in fields:
        rows = df.select(F.col(ident).alias("_id"), F.col(text).alias("_value"))
        statistics.append(corpus_statistics(rows))
        some = bounded_sample(rows, "_id", sample).where((F.trim("_value") != "") & (F.length("_value") <= LONGEST))
        chosen.append([r[0] for r in some.select("_value").toLocalIterator()])
    return fit(chosen, statistics)


def cut_values(df: DataFrame, ident: str, text: str, carry: list[str] | None = None, threshold: float = 0.5, model: Model | None = None) -> DataFrame:
    """ident, carry..., score, is_cut of every row with text that isn't blank; by a model of this field if none is given."""
    require(df, ident, text, *(carry or []))
    rows = df.select(*dict.fromkeys([ident, *(carry or [])]), df[text].alias("_value"))
    model = model or models_for([(df, ident, text)])[0]
    held = rows.sparkSession.sparkContext.broadcast(model)  # bounded: the hashed weights, and the lengths and phrases as corpus_statistics bounds them

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(held.value.score(b.tolist()), dtype="float64")

    scored = rows.where(F.trim("_value") != "").withColumn("score", score("_value")).where("score is not null").drop("_value")
    return scored.withColumn("is_cut", F.col("score") > threshold)


FIELDS = (("candidates", "candidate_id", "summary_hint", "source_org"), ("readings", "reading_id", "abstract_en", "journal"), ("readings", "reading_id", "note_en", "journal"))


def _all(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = models_for([(table(spark, sf_dir, t), i, field) for t, i, field, _ in FIELDS])
    parts = []
    for (t, i, field, owner), model in zip(FIELDS, models, strict=True):
        scored = cut_values(table(spark, sf_dir, t).select(i, owner, field), i, field, [owner], model=model)
        parts.append(scored.select(F.lit(t).alias("record_table"), F.col(i).alias("record_id"), F.lit(field).alias("field_name"), F.col(owner).alias("owner"), "is_cut"))
    return reduce(DataFrame.unionByName, parts)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all(spark, sf_dir).where("is_cut").select("record_table", "record_id", "field_name")


def p7_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of cut values of each source (whatever its spelling) or journal, by field."""
    named = _all(spark, sf_dir).withColumn("name_key", name_key("owner")).join(alias_table(table(spark, sf_dir, "sources")), "name_key", "left")
    owner = F.when(F.col("record_table") == "candidates", F.coalesce("source_name", "owner")).otherwise(F.col("owner"))
    return named.groupBy("record_table", "field_name", owner.alias("owner")).agg(F.count(F.lit(1)).alias("n_values"), F.count_if("is_cut").alias("n_cut"), F.round(F.avg(F.col("is_cut").cast("int")), 6).alias("cut_share"))


QUERIES = {"p7_found": p7_found, "p7_rates": p7_rates}
SQL: dict[str, str] = {}

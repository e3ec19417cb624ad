"""Template residue, filler and error-page text in place of, or amid, real content.

A value is cut into passages: its sentences (dashes between spaces end one, too), windows of ``SPAN`` tokens within a longer sentence,
and runs of marks (unfilled template parts, slots in brackets, unknown figures). Positive-
unlabelled naive Bayes is fitted by expectation-maximization on trusted records of errors and
placeholders and a bounded sample of unlabelled values: trusted passages stay positive, an
unlabelled one belongs to each class as far as the model of the round before says, with the
share of positives as the prior, until the shares stand still. A passage's score is its log odds;
a record is residue if its worst passage is above a threshold, which is taken from trusted
records held out of a fit of their own. Nothing else decides.

The trusted records come from public lists (status codes of HTTP) and rules (template syntax
times names of variables) and from general wordings in several languages; words of ordinary
sentences that merely speak of such matters lose their weight by their company in the
unlabelled sample.

Defined results: null and blank values are never residue; a value is residue if any part is;
very long values are scored whole; an empty table gives an empty one. Rows count one by one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import reduce
from http import HTTPStatus
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.runtime import bounded_sample, require, table

#: Values that training may see of each field, hashed features, tokens of a window and its step.
SAMPLE, WIDTH, SPAN, STEP = 8_000, 1 << 17, 6, 2
#: Most rounds of expectation-maximization, change of the shares at which it ends, smoothing of the classes, bounds of one feature's log odds, least prior.
ROUNDS, STILL, MORE, LESS, LOWEST, HIGHEST, LEAST = 40, 1e-3, 0.05, 0.5, -2.0, 8.0, 0.02
#: One trusted record in so many is held out for the threshold; the share of them that may lie below it; the threshold's bounds (even odds, nine to one).
FOLD, MISSED, EVEN, SURE = 8, 0.02, 0.0, 2.2

#: Syntax of unfilled templates and names of variables; each is tried with each. Fixed values.
SYNTAX = (
    "{{{{ {0} }}}}", "{{{{{0}}}}}", "${{{0}}}", "#{{{0}}}", "%({0})s", "{{{0}}}", "<%= {0} %>", "<?php echo ${0}; ?>", "{{% block {0} %}}", "<<{0}>>", "@@{0}@@", "__{0}__", "%{0}%", "${0}$",
    "&lt;{0}&gt;", "<{0} goes here>", "*|{0}|*",
)
VARIABLES = ("title", "name", "date", "summary", "item.title", "user.name", "record.text", "first_name", "page.url", "value", "count", "content")
#: Requests to fill in, and what they ask for; each is tried with each. Fixed values.
REQUESTS = (
    "[Insert {0}]", "[Insert {0} here]", "[Add {0}]", "[Your {0}]", "[{0}]", "[{0} to come]", "[TODO: {0}]", "[TBC: {0}]", "[Enter {0}]", "[citation for {0} needed]", "[{0} TBC, fill in]", "Enter {0} here", "Insert {0} here", "Write {0} here", "Add a {0}",
    "Describe the {0} in one sentence", "your {0} here",
)
THINGS = ("Name", "Title", "Date", "Country", "Organisation", "Organization", "Company", "Amount", "Policy", "Author", "City", "Link", "Source", "Number", "Text", "Summary", "Event name", "Topic", "Place", "Product", "Currency")
#: Messages of servers, browsers and programs, and fillers, in general wordings. Fixed values.
MESSAGES = (
    "The page you requested was not found", "The page you are looking for does not exist or has moved", "This page does not exist", "Page not found", "File not found", "We can't find that page", "Oops, something went wrong",
    "An error occurred while processing your request", "An unexpected error has occurred, please try again later", "The server could not process your request", "The server is temporarily unavailable",
    "The resource you requested is not available", "The requested URL could not be retrieved", "The site is down for maintenance", "We'll be back soon", "Connection refused", "Connection timed out",
    "The connection has been reset by the server", "Could not connect to the database", "Database connection failed", "This site can't be reached", "Your request has been blocked", "Access to this page has been denied",
    "Access denied: you do not have permission to view this resource", "You are not authorized to view this page", "This content is not available in your country or region", "This content has been removed", "The document has been deleted",
    "Request ID", "Error code", "Reference number of the error", "Contact the site administrator", "Return to the home page", "Go back to the previous page", "Back to home",
    "Please enable JavaScript to continue", "Please turn on JavaScript in your browser and reload the page", "JavaScript is disabled in your browser", "This site requires JavaScript", "You need to enable JavaScript to run this app",
    "Your browser is not supported, please update your browser", "Please enable cookies", "Scripts are blocked or switched off", "Enable scripts to view this page", "This page needs scripts to be allowed in your browser", "Checking your browser before accessing", "Verify that you are a human", "Please prove you are not a robot", "Complete the captcha to continue",
    "Security check required", "Unusual traffic from your network", "Too many requests, slow down", "Rate limit exceeded", "Your session has expired, please sign in again", "Please log in to continue", "Sign in to view this content",
    "Loading", "Loading, please wait", "Please wait", "Just a moment", "One moment, please", "Redirecting",
    "Traceback (most recent call last):", "ValueError: invalid value", "KeyError: 'value'", "TypeError: undefined is not a function", "NullPointerException", "Fatal error: Uncaught Exception in index.php on line 12",
    "Warning: Undefined variable $title", "Notice: Undefined index: title", "Uncaught ReferenceError", "SQLSTATE[42000]: Syntax error", "SQL error: connection refused", "stack trace", "Segmentation fault", "Exception in thread main",
    "null", "NULL", "null null", "(null)", "none", "None", "NaN", "nan", "undefined", "undefined undefined", "[object Object]", "<no value>", "n/a", "N/A", "#REF!", "#N/A", "#VALUE!", "%s", "%d", "{0}",
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua", "Lorem ipsum", "lorem ipsum dolor",
    "TBD", "TBA", "TBC", "T.B.D.", "TK", "TK TK", "tktk", "TODO", "TODO: write this", "FIXME", "FIXME: check", "XXX", "xxxx", "XXXX XXXX", "test", "test test", "testing", "asdf", "asdf asdf", "qwerty", "blah blah", "foo bar",
    "dummy text", "sample text", "placeholder", "placeholder text", "Text goes here", "Your text here", "Insert text here", "Type here", "To be completed", "To be confirmed", "To be added", "To be written", "to be determined",
    "to follow", "Text to follow", "more to be added by the editor", "coming soon", "to come", "fill in later", "(fill in)", "write a summary here", "Write your summary here (max 100 words)", "Summarise the argument in two sentences", "Explain why this matters (at most 50 words)", "Write why it is relevant now",
    "rose by XX per cent", "in 20XX", "XX%", "X million in 20XX", "by XX to XX",
    "Seite nicht gefunden", "Die Seite wurde nicht gefunden", "Zugriff verweigert", "Bitte aktivieren Sie JavaScript in Ihrem Browser", "Ein Fehler ist aufgetreten, bitte versuchen Sie es später erneut", "Bitte warten, wird geladen",
    "Page introuvable", "La page demandée n'existe pas", "Accès refusé", "Veuillez activer JavaScript dans votre navigateur", "Une erreur est survenue, veuillez réessayer plus tard", "Chargement en cours",
    "Página no encontrada", "La página que busca no existe", "Acceso denegado", "Active JavaScript en su navegador", "Habilite JavaScript", "Se ha producido un error, inténtelo de nuevo más tarde", "Cargando",
    "页面不存在", "找不到页面", "访问被拒绝", "请启用 JavaScript", "发生错误，请稍后再试", "加载中", "Página não encontrada", "Acesso negado", "Pagina non trovata", "Accesso negato",
    "Texto de ejemplo", "Texte à compléter", "Text folgt", "à compléter", "por completar", "待补充",
)

#: Marks: syntax that is no word of a sentence, whatever stands in it. Fixed values.
MARKS = (
    ("braces", r"\{\{[^{}]*\}\}|\{\{|\}\}"), ("block", r"\{%[^%]*%\}"), ("percent block", r"<%[^%]*%>"), ("php", r"<\?(?:php|=)?[^?]*\?>"), ("dollar", r"\$\{[^{}]*\}|(?<![\w$])\$[a-z_]+\$(?![\w$])"), ("hash", r"#\{[^{}]*\}"),
    ("format", r"%\([a-z_.]+\)[sd]|(?<![\w%])%[sd](?!\w)|(?<![\w%])%[a-z][a-z_]+%(?!\w)"), ("index", r"\{(?:\d+|[a-z_][a-z_. ]+)\}"), ("angles", r"<<\s*[^<>]+\s*>>|&lt;&lt;.*?&gt;&gt;"), ("signs", r"@@\w+@@|(?<!\w)__\w+?__(?!\w)|\*\|\w+\|\*"),
    ("goes here", r"(?:<|&lt;)[^<>&]* goes here\s*(?:>|&gt;)"), ("no value", r"(?:<|&lt;)(?:no value|null|none|undefined)(?:>|&gt;)"), ("escaped", r"&lt;\s*[a-z][a-z_. ]*\s*&gt;"),
)
#: Every mark has one of these; most sentences have none, and needn't be searched.
_HINT = re.compile(r"[{}<&%$#@_*]")
_MARK = re.compile("|".join(f"(?P<f{i}>{p})" for i, (_, p) in enumerate(MARKS)), re.I)
_SLOT = re.compile(r"\[([^\[\]]+)\]")
_SENTENCE = re.compile(r"(?<=[.!?…。！？])[\"”’)\]]*\s+|(?<=[。！？])|\n+|(?<=>)\s*(?=\S)|\s[|–—-]\s+")
_TOKEN = re.compile(r"⟦[^⟧]*⟧|[㐀-鿿]|[^\W\d_]+(?:['’][^\W\d_]+)?|\d+x+(?!\w)|\d+|[^\w\s]", re.I)


def trusted() -> list[str]:
    """The trusted records."""
    out = [t for s in HTTPStatus if s >= 400 for t in (f"{s.value} {s.phrase}", f"Error {s.value}: {s.phrase}", f"HTTP {s.value}", s.phrase, s.description)]
    out += [p.format(v) for v in VARIABLES for p in SYNTAX]
    out += [p.format(x) for t in THINGS for p in REQUESTS for x in (t, t.lower())]
    return [t for t in dict.fromkeys([*out, *MESSAGES]) if t]


def tidy(value: str) -> str:
    return re.sub(r"[​‌‍﻿­]", "", re.sub(r"\s+", " ", value)).strip()


def sentences(value: str) -> list[str]:
    return [s for s in _SENTENCE.split(tidy(value)) if s.strip()]


def _word(t: str) -> str:
    """A token as a feature: lower case, numbers by their length, unknown figures as a mark (``XXX`` may be a Roman numeral, so it is none)."""
    if t.isdigit():
        return f"#{min(max(len(t), 2), 4)}"
    low = t.lower().replace("’", "'")
    if low == "xx" or low[0].isdigit():
        return "⟦x⟧" if low == "xx" else "⟦#x⟧"
    return low if low.strip("x") else "xxx" if len(low) > 1 else low


def _slot(m: re.Match) -> str:
    """What stands in brackets, as tokens of their own, after one for its shape."""
    words = _TOKEN.findall(m.group(1))
    shape = "".join("A" if w.isupper() and len(w) > 1 else "a" if w[0].isalpha() else "#" if w.isdigit() else "." for w in words[:4])
    return f" ⟦[{shape}⟧ " + "".join(f"⟦[{_word(w).strip('⟦⟧')}⟧ " for w in words)


def tokens(text: str) -> list[str]:
    """Words, single signs, and one token for each mark; those that begin with ``⟦`` are marks."""
    if "[" in text:
        text = _SLOT.sub(_slot, text)
    if _HINT.search(text):
        text = _MARK.sub(lambda m: f" ⟦{MARKS[int(m.lastgroup[1:])][0]}⟧ ", text)
    return [t if t[0] == "⟦" else _word(t) for t in _TOKEN.findall(text)]


def _starts(t: list[str]) -> list[str]:
    """How a sentence of these tokens begins, and its length."""
    return ([f"^ {t[0]}", f"^ {' '.join(t[:2])}"] if t else []) + [f"length {min(len(t), SPAN)}" if len(t) <= SPAN + 2 else "long"]


def _marked(t: list[str]) -> Iterator[tuple[int, int]]:
    """(first, end) of each run of marks."""
    at = 0
    while at < len(t):
        end = at
        while end < len(t) and t[end][0] == "⟦":
            end += 1
        if end > at:
            yield at, end
        at = end + 1


def _pairs(t: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(t, t[1:], strict=False)]


def passages(value: str, windows: bool = True) -> Iterator[list[str]]:
    """The features of each passage: its tokens and pairs of tokens, how a sentence begins; and marks by themselves."""
    for s in sentences(value):
        t = tokens(s)
        yield [*t, *_pairs(t), *_starts(t)]
        for first, end in _marked(t):
            yield [*t[first:end], *_pairs(t[first:end]), "marks"]
        if windows and len(t) > SPAN:
            for at in range(0, len(t) - SPAN + 1, STEP):
                part = t[at : at + SPAN]
                yield [*part, *_pairs(part), *(_starts(t)[:2] if at == 0 else ())]


def _hashed(features: list[str]) -> list[int]:
    return [zlib.crc32(x.encode()) % WIDTH for x in features]


class Model:
    """Log odds of hashed features, the prior's, and the threshold from which a record is residue."""

    def __init__(self, odds: np.ndarray, prior: float, threshold: float) -> None:
        self.odds, self.prior, self.threshold = odds, prior, threshold

    def scorer(self) -> Scorer:
        return Scorer(self)


def _expect(sure: list[list[int]], rest: list[list[int]], rounds: int) -> tuple[np.ndarray, float]:
    """Log odds of the features and of the prior, when the unlabelled passages' shares stand still."""
    rows, n = sure + rest, len(sure)
    which = np.repeat(np.arange(len(rows)), [len(p) for p in rows])
    feats = np.fromiter((f for p in rows for f in p), np.int64, len(which))
    kinds = max(1, len(np.unique(feats)))
    share = np.concatenate([np.ones(n), np.zeros(len(rest))])
    odds, prior = np.zeros(WIDTH), 0.0
    for k in range(rounds):
        pos, neg = np.bincount(feats, share[which], WIDTH), np.bincount(feats, (1 - share)[which], WIDTH)
        odds = np.clip(np.log((pos + MORE) / (pos.sum() + MORE * kinds)) - np.log((neg + LESS) / (neg.sum() + LESS * kinds)), LOWEST, HIGHEST)
        odds[pos + neg == 0] = 0
        if not rest:
            break
        mean = min(max(share[n:].mean(), LEAST), 0.5)
        prior = float(np.log(mean / (1 - mean)))
        new = 1 / (1 + np.exp(-np.clip(np.bincount(which, odds[feats], len(rows)) + prior, -30, 30)))
        new[:n] = 1
        moved, share = np.abs(new - share).sum(), new
        if k and moved < STILL * max(1.0, share[n:].sum()):
            break
    return odds, prior


def fit(values: list[str], rounds: int = ROUNDS) -> Model:
    """A model from the trusted records and unlabelled ``values``."""
    known = trusted()
    sure = [[_hashed(p) for p in passages(t, False)] for t in known]
    rest = [_hashed(p) for v in values for p in passages(v, False)]
    seen = [p for k, ps in enumerate(sure) if k % FOLD for p in ps]
    # the threshold: at most MISSED of the records that the model hasn't seen lie below it
    trial = Model(*_expect(seen, rest, rounds), 0.0).scorer()
    unseen = [trial.score(t) for k, t in enumerate(known) if k % FOLD == 0]
    threshold = float(np.clip(np.quantile(unseen, MISSED), EVEN, SURE))
    return Model(*_expect([p for ps in sure for p in ps], rest, rounds), threshold)


class Scorer:
    """Scores of values: sums over passages as differences of running sums, weights looked up once for each distinct feature."""

    def __init__(self, model: Model) -> None:
        self.odds, self.prior, self.threshold, self.memo = model.odds.tolist(), model.prior, model.threshold, {}

    def weight(self, feature: str) -> float:
        w = self.memo.get(feature)
        if w is None:
            if len(self.memo) > 1 << 18:
                self.memo.clear()
            w = self.memo[feature] = self.odds[zlib.crc32(feature.encode()) % WIDTH]
        return w

    def score(self, value: str) -> float:
        """That of the worst passage."""
        best, weight = -30.0, self.weight
        for s in sentences(value):
            t = tokens(s)
            one = list(accumulate(map(weight, t), initial=0.0))
            two = list(accumulate(map(weight, _pairs(t)), initial=0.0))
            starts = _starts(t)
            best = max(best, one[-1] + two[-1] + sum(map(weight, starts)))
            for first, end in _marked(t):
                best = max(best, one[end] - one[first] + two[end - 1] - two[first] + weight("marks"))
            if len(t) > SPAN:
                for at in range(0, len(t) - SPAN + 1, STEP):
                    x = one[at + SPAN] - one[at] + two[at + SPAN - 1] - two[at]
                    best = max(best, x if at else x + sum(map(weight, starts[:2])))
        return best + self.prior

    def is_residue(self, value: str) -> bool:
        return self.score(value) > self.threshold


def model_for(fields: list[tuple[DataFrame, str, str]], sample: int = SAMPLE) -> Model:
    """A model of all of the fields (table, id, text) together, from at most ``sample`` values of each."""
    values = []
    for df, ident, text in fields:
        rows = bounded_sample(df.select(F.col(ident).alias("_id"), F.col(text).alias("_value")), "_id", sample)
        values += [r[0] for r in rows.where(F.trim("_value") != "").select("_value").toLocalIterator()]
    return fit(values)


def residue_values(df: DataFrame, ident: str, text: str, model: Model | None = None) -> DataFrame:
    """ident, score, is_residue of every row whose text isn't blank; by a model of this field if none is given."""
    require(df, ident, text)
    rows = df.select(ident, df[text].alias("_value"))
    model = model or model_for([(df, ident, text)])
    held = rows.sparkSession.sparkContext.broadcast(model)  # fixed size: one number a hashed feature

    @F.pandas_udf("score double, is_residue boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = held.value.scorer()
        for b in batches:
            s = np.array([scorer.score(v) for v in b])
            yield pd.DataFrame({"score": s, "is_residue": s > scorer.threshold})

    return rows.where(F.trim("_value") != "").withColumn("_j", judge("_value")).select(ident, "_j.*")


FIELDS = (("digest_items", "item_id", "core_argument_en"), ("digest_items", "item_id", "why_now_en"), ("news_briefs", "brief_id", "one_sentence_en"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [(table(spark, sf_dir, t), i, field) for t, i, field in FIELDS]
    model, parts = model_for(fields), []
    for (t, i, field), (df, *_) in zip(FIELDS, fields, strict=True):
        found = residue_values(df.select(i, field), i, field, model).where("is_residue")
        parts.append(found.select(F.lit(t).alias("record_table"), F.col(i).alias("record_id"), F.lit(field).alias("field_name")))
    return reduce(DataFrame.unionByName, parts)


QUERIES = {"p3_found": p3_found}
SQL: dict[str, str] = {}

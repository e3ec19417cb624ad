"""Keeping the article of a page, leaving menus, notices, teasers and footers.

A page's text is a tree: the page, its sections (a heading of other pieces with the teasers
below it, or a run of lines between blanks), and lines. Each line gets the features of a node:
its own text, how many pages of the corpus repeat it, what its words and the line itself are
elsewhere, attribute tokens (single words that name site furniture), density of running text in
its section, depth, and statistics of the lines beside it. Gradient-boosted trees, fitted here
on a bounded sample of pages with counts taken over all pages, give each line a probability; decoding then chooses labels for
the whole tree at once, so that no teaser below a heading of other pieces, and no heading on a
page without running text, is kept against its section or page.

Pages come without labels. The training labels are taken from place and repetition: running
text that hardly any other page repeats is article; what lies outside the span of such text is
furniture; a line within the span is furniture if pages repeat it and often outside the span,
or if it is short and has an attribute token. What a word is worth is learnt from these labels.

The lines that many pages repeat are counted over all pages, letter case and digits aside; those kept
number at most ``MOST`` times the mean lines of a page, whatever the size of the corpus. Where these lines
stand and what labels the words have is counted over all pages, too; the words kept have more than
one in ``VOCABULARY`` of all counts each.

Defined results: null and blank pages have no lines; blank lines are never reported; a page
without an article gives all its lines; lines are cut at ``\\n`` only and counted from 1; very
long pages are read whole; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, repeat
from math import log, log1p
from struct import Struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.runtime import bounded_sample, cut_lineage, require, table

#: Rows that training may see (those without a page teach nothing); trees, their depth, bins of a feature, rate of learning.
SAMPLE, TREES, DEPTH, BINS, RATE = 6_000, 40, 4, 32, 0.25
#: A repeated line is on one of ``MOST`` pages at least, and these have ``LEAST`` different lines among their two longest.
MOST, LEAST = 20_000, 5
#: Words kept at most; counts that a task holds before it passes them on.
VOCABULARY, HELD = 200_000, 200_000
ENDS = ".!?。！？…"
CLOSE = "\"'”’»)]）」』"
EDGE = " \t\r\xa0\u200b\ufeff"

#: Attribute tokens: words that name kinds of site furniture, as in names of page elements, in several languages. One or two words each. Fixed values.
ATTRIBUTES = {
    "consent": "cookie|cookies|consent|gdpr|tracker|trackers|datenschutz|confidentialité|privacidad|privacy|隐私",
    "share": "share|tweet|facebook|whatsapp|print|partager|imprimer|compartir|imprimir|teilen|drucken|delen|分享|打印",
    "subscribe": "subscribe|newsletter|inbox|donate|signup|abonnez|inscrivez|suscríbase|suscribirse|abonnieren|abonneren|spenden|订阅",
    "legal": "copyright|©|rights reserved|droits réservés|derechos reservados|rechte vorbehalten|rechten voorbehouden|版权|imprint|impressum",
    "more": "related|recommended|trending|read more|read also|read next|see also|most read|more from|lire aussi|voir aussi|lea también|véase también|lesen sie|siehe auch|lees ook|meistgelesen|plus lus|más leído|相关|热门|→|»",
    "tags": "tags|topics|keywords|filed under|mots-clés|étiquettes|etiquetas|schlagwörter|trefwoorden|标签",
    "ad": "advertisement|advertising|sponsored|publicité|publicidad|anzeige|werbung|advertentie|广告",
    "top": "skip to|back to top|menu|search|login|log in|home|contact|accueil|inicio|startseite|suche|首页",
}
NAMES = list(ATTRIBUTES)
#: By word, or by two words in a row; signs are looked for by themselves.
_TOKENS = {w: 1 << k for k, words in enumerate(ATTRIBUTES.values()) for w in words.replace("-", " ").split("|") if w[0].isalpha()}
#: Words without which a line has no token; those of them that begin one of two words.
_STARTS = frozenset(w.partition(" ")[0] for w in _TOKENS)
_PAIRS = frozenset(w.partition(" ")[0] for w in _TOKENS if " " in w)
_SIGNS = [(w, 1 << k) for k, words in enumerate(ATTRIBUTES.values()) for w in words.split("|") if not w[0].isalpha()]
_ITEMS = re.compile(r"\s*[|·›\t]\s*|\s{3,}")
_CRUMB = re.compile(r"^[^.:]{2,40}(?:\s[/>»›]\s[^.:/>»›]{2,40}){1,4}$")
_BULLET = re.compile(r"^(?:[-*•–·▪→»>]\s+)+")
_DECOR = re.compile(r"(?:\s+—\s+\d{1,2} \w+ \d{4}|\s*\(\d+ min(?:utes?)? read\)|\s+\|\s+[\w’' -]{2,30}|\s{1,}\d+ \w{4,14}|\s{1,}\d+ 条评论)+$", re.I)
_FAR = re.compile(r"[぀-ヿ㐀-鿿가-힯]")
_WORD = re.compile(r"[^\W\d_]+")
_DIGITS = bytes.maketrans(b"0123456789", b"#" * 10)
#: Each sign of a one-byte encoding, those that no word has as blanks.
_BLANKED = bytes(k if _WORD.match(bytes([k]).decode("cp1252", "replace")) else 32 for k in range(256))
#: Features of a line that its text alone decides, and their columns.
_FIGURES, _COLUMNS = Struct("12f"), [7, 8, 10, 11, 12, 13, 15, 16, 17, 18, 19, 23]


@dataclass(slots=True)
class Line:
    """What is read off one line that isn't blank."""

    no: int
    text: str
    indent: int
    blank_before: bool
    key: int  # hash of the line, letter case and digits aside
    words: list[str]
    cues: int  # attribute tokens, bits by kind
    items: int
    prose: bool  # a sentence by its form
    bullet: bool
    decor: bool
    crumb: bool
    listed: bool  # short phrases parted by commas only
    far: bool  # ideographs or syllables
    figures: bytes  # features that the text alone decides
    share: float = 0.0  # of the pages that have the line
    sentence: bool = False  # running text: prose that pages don't repeat


def _prose(end: str, n: int, far: bool) -> bool:
    return (end in ENDS and end != "" and n >= (10 if far else 28)) or n >= (45 if far else 140)


def _words(low: str, raw: bytes) -> tuple[list[str], bool]:
    """Words of a line in small letters (``raw`` in UTF-8), or its pairs of signs if it has ideographs or syllables; whether it has."""
    if low.isascii():
        return raw.translate(_BLANKED).decode().split(), False
    try:
        return low.encode("cp1252").translate(_BLANKED).decode("cp1252").split(), False
    except UnicodeEncodeError:
        pass
    if _FAR.search(low):
        return [a + b for a, b in zip(low, low[1:], strict=False) if a.isalpha() and b.isalpha()], True
    return _WORD.findall(low), False


def _cues(low: str, words: list[str]) -> int:
    cues, found = 0, _STARTS.intersection(words)
    for w in found:
        cues |= _TOKENS.get(w, 0)
    if not found.isdisjoint(_PAIRS):
        for w in zip(words, words[1:], strict=False):
            cues |= _TOKENS.get(" ".join(w), 0) if w[0] in _PAIRS else 0
    for w, k in () if low.isascii() else _SIGNS:
        cues |= k if w in low else 0
    return cues


def read_line(text: str) -> tuple:
    """key, words, cues, items, prose, bullet, decor, crumb, listed, far, figures of a line's text."""
    low = text.lower()
    raw = low.encode(errors="surrogatepass")
    masked = raw.translate(_DIGITS)
    words, far = _words(low, raw)
    bare = _BULLET.sub("", text) if text[0] in "-*•–·▪→»>" else text
    items = sum(1 for i in _ITEMS.split(text) if i) if "|" in text or "·" in text or "›" in text or "\t" in text or "   " in text else 1
    end, last, commas = bare.rstrip(CLOSE)[-1:], text[-1], text.count(",")
    listed = end not in ENDS and 0 < commas < 6 and text in (low, text.upper()) and all(0 < len(w.split()) <= 3 for w in text.split(","))
    prose, bullet = _prose(end, len(bare), far), bare != text
    decor = (last.isalnum() or last in "_)’' -") and bool(_DECOR.search(text))
    crumb = ("/" in text or ">" in text or "»" in text or "›" in text) and bool(_CRUMB.match(text))
    ends = text.count(".") + text.count("!") + text.count("?") + (0 if text.isascii() else sum(map(text.count, "。！？…")))
    digits = masked.count(b"#") - raw.count(b"#")
    figures = _FIGURES.pack(log1p(len(text)), len(words), ends, bullet, text[0] in "“\"«„「", digits / len(text), items, prose, crumb, decor, listed, commas)
    key = xxhash.xxh64_intdigest(masked, 42)
    return key - (1 << 64) if key >= 1 << 63 else key, words, _cues(low, words), items, prose, bullet, decor, crumb, listed, far, figures


def _upper(text: str) -> float:
    return sum(map(str.isupper, text)) / len(text)


#: Furniture repeats, so what is read off short lines is kept.
_kept, _kept_upper = lru_cache(1 << 15)(read_line), lru_cache(1 << 15)(_upper)


def read_lines(page: str, shares: dict[int, float] | None = None) -> list[Line]:
    out, blank = [], True
    for no, raw in enumerate(page.split("\n"), 1):
        text = raw.strip(EDGE)
        if not text or text.isspace():
            blank = True
            continue
        x = Line(no, text, len(raw) - len(raw.lstrip()), blank, *(_kept if len(text) < 80 else read_line)(text))
        x.share = shares.get(x.key, 0.0) if shares else 0.0
        x.sentence = x.prose and not x.share
        out.append(x)
        blank = False
    return out


MORE, TOP = (1 << NAMES.index(n) for n in ("more", "top"))


def sections(lines: list[Line]) -> list[tuple[int, int, bool]]:
    """(first, end, headed) of each section: a heading of other pieces with the short lines below it up to running text or what pages repeat, or a run up to a blank."""
    out, at = [], 0
    heads = [x.cues & MORE and not x.sentence and len(x.words) <= 8 for x in lines]
    while at < len(lines):
        end = at + 1
        if heads[at]:
            while end < len(lines) and not lines[end].sentence and not lines[end].share and not lines[end].listed and not lines[end].cues & ~MORE:
                end += 1
            out.append((at, end, end > at + 1))
        else:
            while end < len(lines) and not lines[end].blank_before and not heads[end]:
                end += 1
            out.append((at, end, False))
        at = end
    return out


FEATURES = 42 + len(NAMES)
_NOTHING = (0.0,)


def node_features(read: list[list[Line]], parts: list[list[tuple[int, int, bool]]], model: Model) -> np.ndarray:
    """One row of features a line, of all pages in turn; ``parts`` are their sections."""
    lines = list(chain.from_iterable(read))
    n = len(lines)
    out = np.zeros((n, FEATURES), np.float32)
    if not n:
        return out
    count = np.array([len(x) for x in read if x])
    page = np.repeat(np.arange(len(count)), count)
    start, stop = (np.cumsum(count) - count)[page], np.cumsum(count)[page]
    at = np.arange(n)
    size = np.array([len(x.text) for x in lines], float)
    sent = np.array([x.sentence for x in lines], bool)
    past = np.concatenate([[0], np.cumsum(sent)])
    last = np.concatenate([[-1], np.maximum.accumulate(np.where(sent, at, -1))[:-1]])
    coming = np.concatenate([np.minimum.accumulate(np.where(sent, at, n)[::-1])[::-1][1:], [n]])
    share = np.array([x.share for x in lines], np.float32)
    # sections
    long = np.array([end - first for x in parts for first, end, _ in x])
    section, first = np.repeat(np.arange(len(long)), long), np.cumsum(long) - long
    mean = lambda x: np.add.reduceat(x, first) / long
    out[:, 0] = np.array([headed for x in parts for _, _, headed in x])[section]
    out[:, 1] = long[section]
    out[:, 2] = mean(size)[section]
    out[:, 3] = (np.add.reduceat(size * sent, first) / np.add.reduceat(size, first))[section]
    out[:, 4] = at - first[section]
    out[:, 5] = np.sqrt(mean((size - mean(size)[section]) ** 2))[section]
    out[:, 6] = mean((share > 0).astype(float))[section]
    # lines
    out[:, _COLUMNS] = np.frombuffer(b"".join([x.figures for x in lines]), np.float32).reshape(n, -1)
    out[:, 9] = sent
    out[:, 14] = [0.0 if x.sentence else (_kept_upper if len(x.text) < 80 else _upper)(x.text) for x in lines]
    out[:, 20], out[:, 21], out[:, 22] = [x.indent for x in lines], [x.blank_before for x in lines], [x.far for x in lines]
    words = [x.words or ("",) for x in lines]
    many = np.array([len(x) for x in words])
    odds = np.fromiter(map(model.words.get, chain.from_iterable(words), repeat(0.0)), float, many.sum())
    begin = np.cumsum(many) - many
    out[:, 24], out[:, 25], out[:, 26] = np.add.reduceat(odds, begin) / many, np.maximum.reduceat(odds, begin), np.minimum.reduceat(odds, begin)
    out[:, 27] = [log(x.share + 1e-6) for x in lines]
    known = [model.lines.get(x.key, (0, 0.5)) if x.share else (0, 0.5) for x in lines]
    out[:, 28], out[:, 29] = [k[1] for k in known], [k[0] for k in known]
    out[:, 42 : 42 + len(NAMES)] = np.array([x.cues for x in lines])[:, None] >> np.arange(len(NAMES)) & 1
    # places
    out[:, 30] = (at - start) / (stop - start)
    out[:, 31], out[:, 32] = past[:-1] - past[start], past[stop] - past[1:]
    out[:, 33], out[:, 34] = np.where(last >= start, np.minimum(at - last, 20), 20), np.where(coming < stop, np.minimum(coming - at, 20), 20)
    for k, of in ((35, np.log1p(size.astype(np.float32))), (37, out[:, 24].copy()), (39, share > 0)):
        out[1:, k], out[:-1, k + 1] = of[:-1], of[1:]
        out[at == start, k] = out[at == stop - 1, k + 1] = 0
    out[:, 41] = past[stop] - past[start]
    return out


def _told(x: Line) -> bool:
    """Short, with a token that names furniture."""
    return bool(x.cues & ~TOP) and len(x.words) <= 12


def span(lines: list[Line]) -> tuple[int, int]:
    """First and last line of running text, short lines with a token aside; (0, -1) without any."""
    at = [i for i, x in enumerate(lines) if x.sentence and not _told(x)]
    return (at[0], at[-1]) if at else (0, -1)


def label(lines: list[Line], outside: dict[int, tuple[int, float]] | None) -> np.ndarray:
    """1 furniture, 0 article, -1 unsure: the labels of a training page, by place and repetition. Without ``outside`` 2 for those that it decides."""
    y = np.full(len(lines), -1, np.int8)
    first, last = span(lines)
    for i, x in enumerate(lines):
        if first <= i <= last:
            told = _told(x)
            if outside is None and x.share and not x.sentence and not told:
                y[i] = 2
                continue
            apart = outside.get(x.key, (0, 0.0))[1] if outside and x.share else 0.0
            y[i] = (-1 if told else 0) if x.sentence else 1 if apart > 0.2 or told else 0
        elif i > last or x.share or i < first - 1:
            y[i] = 1
    for first, end, headed in sections(lines):
        if headed:
            y[first:end] = 1
    return y


class Trees:
    """Gradient-boosted trees on binned features, logistic loss."""

    def __init__(self, edges: list[np.ndarray], trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], base: float) -> None:
        self.edges, self.trees, self.base = edges, trees, base

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def logit(self, x: np.ndarray) -> np.ndarray:
        b, out, rows = self.binned(x), np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, leaf in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (b[rows, feature[at]] > cut[at])
            out += leaf[at - (2**DEPTH - 1)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Depth-wise growth on histograms of gradients; every tree is full, idle nodes send all rows left."""
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for k in range(x.shape[1])]
    model = Trees(edges, [], 0.0)
    if not len(x):
        return model
    b = model.binned(x).astype(np.int64)
    share = np.clip(y.mean(), 0.01, 0.99)
    model.base = float(np.log(share / (1 - share)))
    f = np.full(len(x), model.base)
    inner = 2**DEPTH - 1
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, cut, at = np.zeros(inner, np.int64), np.full(inner, 255, np.int64), np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-3)
            for k in range(x.shape[1]):
                if not len(edges[k]):
                    continue
                key = (at - first) * (BINS + 1) + b[:, k]
                gs = np.bincount(key, g, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                hs = np.bincount(key, h, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                gain[(hs < 2) | (ht - hs < 2)] = 0
                top = gain.argmax(1)
                better = gain[np.arange(width), top] > best
                best = np.where(better, gain[np.arange(width), top], best)
                feature[first : first + width][better] = k
                cut[first : first + width][better] = top[better]
            at = 2 * at + 1 + (b[np.arange(len(x)), feature[at]] > cut[at])
        leaf_of = at - inner
        leaf = RATE * np.bincount(leaf_of, g, inner + 1) / (np.bincount(leaf_of, h, inner + 1) + 1)
        f += leaf[leaf_of]
        model.trees.append((feature, cut, leaf))
    return model


@dataclass
class Model:
    """The trees, what words and repeated lines are elsewhere, and the shares of the pages that have the repeated lines."""

    shares: dict[int, float]
    words: dict[str, float]
    lines: dict[int, tuple[int, float]]
    trees: Trees | None = None


def decode_pages(read: list[list[Line]], parts: list[list[tuple[int, int, bool]]], logit: np.ndarray) -> np.ndarray:
    """True for furniture, of the lines of all pages in turn: of each page the labelling of the tree with the greatest likelihood among those without contradiction.

    A headed section is furniture as a whole, or its heading is article and the rest is free. A
    page is free, or has no article; it has one only with a line of running text in it.
    """
    z = np.clip(logit, -12, 12)
    out, at = z > 0, 0
    for lines, sects in zip(read, parts, strict=True):
        for first, end, headed in sects:
            if headed:
                s = slice(at + first, at + end)
                yes, no = -np.log1p(np.exp(-z[s])), -np.log1p(np.exp(z[s]))
                free = no[0] + np.maximum(yes[1:], no[1:]).sum()
                if yes.sum() >= free or out[s][0]:
                    out[s] = True
        kept = out[at : at + len(lines)].tolist()
        if not all(kept) and all(k or not x.sentence for k, x in zip(kept, lines, strict=True)):
            out[at : at + len(lines)] = True
        at += len(lines)
    return out


def decode(lines: list[Line], logit: np.ndarray) -> np.ndarray:
    """As ``decode_pages``, of one page."""
    return decode_pages([lines], [sections(lines)], logit)


def furniture_lines(pages: list[str], model: Model) -> list[list[int]]:
    """Numbers of the lines of each page that aren't the article's."""
    read = [read_lines(p, model.shares) for p in pages]
    parts = [sections(x) for x in read]
    bad = iter(decode_pages(read, parts, model.trees.logit(node_features(read, parts, model))).tolist())
    return [[x.no for x, b in zip(lines, bad, strict=False) if b] for lines in read]


class Tally:
    """Counts over pages: of repeated lines, how often they stand, outside the span, and where that decides their label; of words, how many lines of either label have them."""

    def __init__(self) -> None:
        self.lines: dict[int, list] = {}  # [n, outside the span, left to decide, their words]
        self.words: tuple[Counter, Counter] = Counter(), Counter()

    def add(self, lines: list[Line]) -> None:
        first, last = span(lines)
        words: tuple[list, list] = [], []
        for i, (x, v) in enumerate(zip(lines, label(lines, None).tolist(), strict=True)):
            if x.share:
                c = self.lines.setdefault(x.key, [0, 0, 0, None])
                c[0] += 1
                c[1] += not first <= i <= last
                if v == 2:
                    c[2] += 1
                    c[3] = c[3] or sorted(set(x.words))
            if 0 <= v <= 1:
                words[v].extend(set(x.words))
        for c, w in zip(self.words, words, strict=True):
            c.update(w)

    def __len__(self) -> int:
        return len(self.lines) + sum(map(len, self.words))


@dataclass
class Counts:
    """What a ``Tally`` of all pages says: the repeated lines, and the words' odds of being furniture."""

    lines: dict[int, tuple[int, float]]
    words: dict[str, float]


def _decided(lines: dict[int, tuple[int, float]], left: list[tuple[int, int, list[str]]]) -> tuple[Counter, Counter]:
    """The counts of the words of lines (key, times, words) whose label is that of the line's place elsewhere."""
    out = Counter(), Counter()
    for key, n, words in left:
        c = out[lines.get(key, (0, 0.0))[1] > 0.2]
        for w in words:
            c[w] += n
    return out


def _odds(n0: int, n1: int, total: tuple[int, int]) -> float:
    return max(-4.0, min(4.0, log((n1 + 0.5) / max(1, total[1])) - log((n0 + 0.5) / max(1, total[0]))))


def count_pages(read: list[list[Line]]) -> Counts:
    """As ``count_all``, of a list."""
    tally = Tally()
    for x in read:
        tally.add(x)
    lines = {k: (m, apart / m) for k, (m, apart, _, _) in tally.lines.items() if m > 2}
    n0, n1 = (c + d for c, d in zip(tally.words, _decided(lines, [(k, c[2], c[3]) for k, c in tally.lines.items() if c[2]]), strict=True))
    total = n0.total(), n1.total()
    return Counts(lines, {w: _odds(n0[w], n1[w], total) for w in n0 | n1 if n0[w] + n1[w] > max(2, sum(total) / VOCABULARY)})


def count_all(df: DataFrame, text: str, shares: dict[int, float]) -> Counts:
    """Lines and words counted over every page of ``df``."""
    spark = df.sparkSession
    held = spark.sparkContext.broadcast(shares)  # bounded: the repeated lines
    kind = "key long, word string, a long, b long, left long, words array<string>"

    def put(t: Tally) -> pa.RecordBatch:
        lines = list(t.lines.items())
        words = sorted(t.words[0].keys() | t.words[1].keys())
        none = [None] * len(words)
        return pa.RecordBatch.from_arrays([
            pa.array([k for k, _ in lines] + none, pa.int64()), pa.array([None] * len(lines) + words, pa.string()), pa.array([c[0] for _, c in lines] + [t.words[0][w] for w in words], pa.int64()),
            pa.array([c[1] for _, c in lines] + [t.words[1][w] for w in words], pa.int64()), pa.array([c[2] for _, c in lines] + none, pa.int64()), pa.array([c[3] for _, c in lines] + none, pa.list_(pa.string())),
        ], names=["key", "word", "a", "b", "left", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for b in batches:
            for page in b.column(0).to_pylist():
                tally.add(read_lines(page, held.value))
                if len(tally) > HELD:
                    yield put(tally)
                    tally = Tally()
        yield put(tally)

    found = df.where(F.col(text).isNotNull()).select(text).mapInArrow(run, kind)
    found = cut_lineage(found.groupBy("key", "word").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("left").alias("left"), F.max("words").alias("words")))
    rows = found.where("key is not null").select("key", "a", "b", "left", "words").toArrow().to_pylist()  # bounded: the repeated lines
    lines = {r["key"]: (r["a"], r["b"] / r["a"]) for r in rows if r["a"] > 2}
    more = _decided(lines, [(r["key"], r["left"], r["words"]) for r in rows if r["left"]])
    told = spark.createDataFrame(pa.table({"word": pa.array([w for c in more for w in c], pa.string()), "a": pa.array([*more[0].values(), *[0] * len(more[1])], pa.int64()), "b": pa.array([*[0] * len(more[0]), *more[1].values()], pa.int64())}))
    words = found.where("word is not null").select("word", "a", "b").unionByName(told).groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    total = tuple(x or 0 for x in words.agg(F.sum("a"), F.sum("b")).first())
    kept = words.where(F.col("a") + F.col("b") > max(2, sum(total) / VOCABULARY)).toArrow().to_pydict()  # fewer than VOCABULARY
    return Counts(lines, {w: _odds(a, b, total) for w, a, b in zip(kept["word"], kept["a"], kept["b"], strict=True)})


def fit(pages: list[str], shares: dict[int, float], counts: Counts | None = None) -> Model:
    """The trees of ``pages``; ``counts`` are those of all pages, by default of ``pages``."""
    read = [read_lines(p, shares) for p in pages]
    counts = counts or count_pages(read)
    model = Model(shares, counts.words, counts.lines)
    xs, ys = [np.zeros((0, FEATURES), np.float32)], [np.zeros(0)]
    for at in range(0, len(read), 512):
        part = read[at : at + 512]
        y = np.concatenate([label(lines, model.lines) for lines in part])
        xs.append(node_features(part, [sections(x) for x in part], model)[y >= 0])
        ys.append(y[y >= 0].astype(float))
    model.trees = fit_trees(np.concatenate(xs), np.concatenate(ys))
    return model


def shares_of(pages: list[str]) -> dict[int, float]:
    """As ``repeated_lines``, of a list."""
    n, of = Counter(), {}
    for p in pages:
        lines = read_lines(p)
        marks = sorted({(len(x.text), x.key) for x in lines})[-2:]
        for k in {x.key for x in lines}:
            n[k] += 1
            of.setdefault(k, set()).update(marks)
    return {k: m / len(pages) for k, m in n.items() if len(of[k]) >= LEAST and m >= len(pages) / MOST}


def repeated_lines(df: DataFrame, text: str) -> dict[int, float]:
    """The share of all pages that have a line, for lines on many; letter case and digits aside.

    A page that is copied repeats its article, too, so the two longest lines stand for the article: a line counts
    as repeated only beside different ones, told apart by 64 bits that each sets one of.
    """
    lines = F.array_distinct(F.transform(F.split(text, "\n"), lambda x: F.translate(F.lower(F.btrim(x, F.lit(EDGE))), "0123456789", "#" * 10)))
    longest = F.slice(F.sort_array(F.transform("lines", lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))), asc=False), 1, 2)
    bits = F.expr("aggregate(longest, 0L, (a, x) -> a | shiftleft(1L, cast(pmod(xxhash64(x.x), 64) as int)))")
    pages = df.where(F.col(text).isNotNull()).select(lines.alias("lines")).select("lines", longest.alias("longest")).select("lines", bits.alias("bits"))
    one = pages.select(F.explode(F.concat("lines", F.array(F.lit(None).cast("string")))).alias("line"), "bits")
    counts = one.groupBy(F.when(F.col("line").isNotNull(), F.xxhash64("line")).alias("key")).agg(F.count(F.lit(1)).alias("n"), F.bit_or("bits").alias("bits"))
    counts = cut_lineage(counts.where(f"key is null or bit_count(bits) >= {LEAST}").select("key", "n"))
    total = counts.where("key is null").agg(F.sum("n")).first()[0] or 0
    many = counts.where(F.col("key").isNotNull() & (F.col("n") >= total / MOST)).toArrow().to_pydict()
    return {k: n / total for k, n in zip(many["key"], many["n"], strict=True)}


def model_for(df: DataFrame, ident: str, text: str, sample: int = SAMPLE) -> Model:
    shares = repeated_lines(df, text)
    rows = bounded_sample(df.select(ident, text), ident, sample).select(text).where(F.trim(text) != "")
    return fit([r[0] for r in rows.toLocalIterator()], shares, count_all(df, text, shares))


def page_lines(df: DataFrame, ident: str, text: str, sample: int = SAMPLE) -> DataFrame:
    """ident, lines (array of the numbers of lines that aren't the article's); no shuffle."""
    require(df, ident, text)
    rows = df.select(ident, df[text].alias("_page"))
    held = rows.sparkSession.sparkContext.broadcast(model_for(rows, ident, "_page", sample))  # bounded: TREES trees, VOCABULARY words, the repeated lines
    schema = T.StructType([df.schema[ident], T.StructField("lines", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                found = furniture_lines(part.column(1).to_pylist(), held.value)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.int32()))], names=[ident, "lines"])

    return rows.where("_page is not null").mapInArrow(run, schema)


def main_text(df: DataFrame, ident: str, text: str, sample: int = SAMPLE) -> DataFrame:
    """ident and the article of each page in ``article``; null for a null page, empty where there is none."""
    require(df, ident, text)
    rows = df.select(ident, df[text].alias("_page"))
    held = rows.sparkSession.sparkContext.broadcast(model_for(rows, ident, "_page", sample))
    schema = T.StructType([df.schema[ident], T.StructField("article", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pages = b.column(1).to_pylist()
            bad = furniture_lines([p or "" for p in pages], held.value)
            kept = [None if p is None else re.sub(r"\n{3,}", "\n\n", "\n".join(x for k, x in enumerate(p.split("\n"), 1) if k not in drop)).strip() for p, drop in zip(pages, map(set, bad), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, pa.string())], names=[ident, "article"])

    return rows.mapInArrow(run, schema)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "candidates").select("candidate_id", "full_text")
    return page_lines(pages, "candidate_id", "full_text").select("candidate_id", F.explode("lines").alias("line_no")).select("candidate_id", F.col("line_no").cast("long"))


def p2_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of each page."""
    return main_text(table(spark, sf_dir, "candidates").select("candidate_id", "full_text").where("full_text is not null"), "candidate_id", "full_text")


QUERIES = {"p2_found": p2_found, "p2_articles": p2_articles}
SQL: dict[str, str] = {}

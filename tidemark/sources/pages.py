"""HTML pages as tables: metadata, dates, running text and links, by the standard library's tolerant parser."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements without an article's text, and those that hold it, by preference. Fixed values.
ASIDE = frozenset("script style nav header footer aside noscript svg".split())
MAIN = ("article", "main", "body")
PAGE = "doc_url string, title string, published_raw string, modified_raw string, event_start_raw string, event_end_raw string, summary string, body string, links array<struct<target:string, label:string>>, feeds array<string>, nofollow boolean"


def nodes(value: object) -> Iterator[dict]:
    """All objects of a JSON tree, outer ones first."""
    waiting = [value]
    while waiting:
        x = waiting.pop()
        if isinstance(x, dict):
            yield x
        if isinstance(x, (dict, list)):
            waiting += reversed(list(x.values()) if isinstance(x, dict) else x)


def count_nodes(c: Column) -> Column:
    """The number of objects in a JSON text, 0 for none; an Arrow UDF."""

    @F.pandas_udf("long")
    def count(batch: pd.Series) -> pd.Series:
        def one(v: str | None) -> int:
            try:
                return sum(1 for _ in nodes(json.loads(v or "")))
            except ValueError:
                return 0

        return batch.map(one).astype("int64")

    return count(c)


#: Kinds of structured data that a role may have, by a part of their type. Fixed values.
ROLES = {"report": ("Article", "Report", "Event"), "event": ("Event",)}
#: Where a field is read, best place first: an object of structured data in a role, a meta element, an element, or running text. Fixed values.
PLACES = {
    "title": ("report headline", "report name", "meta og:title", "element h1", "element h2", "element h5", "element title"),
    "published": ("report datePublished", "meta article:published_time", "meta datepublished", "text labelled", "text ideographs", "element time"),
    "modified": ("report dateModified", "meta article:modified_time"),
    "first day": ("event startDate", "meta startdate", "text first day"),
    "last day": ("event endDate", "meta enddate", "text last day"),
    "summary": ("report description", "meta description", "meta og:description", "text body"),
}


class Reader(HTMLParser):
    """One pass over a page; unclosed elements end with what holds them. What is found is put in ``found`` by its place."""

    def __init__(self, url: str) -> None:
        super().__init__(convert_charrefs=True)
        self.url, self.open = url, []
        self.found: dict[str, str] = {}
        self.text: dict[str, list[str]] = {k: [] for k in (*MAIN, "all", "visible")}
        self.links: list[tuple[str, str]] = []
        self.feeds: list[str] = []
        self.times: list[str] = []
        self._script = self._anchor = self._head = None

    def first(self, place: str, value: object) -> None:
        if value and place not in self.found:
            self.found[place] = str(value)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag not in VOID:
            self.open.append(tag)
        handler = getattr(self, f"_start_{tag}", None)
        if handler:
            handler(a)
        elif tag in ("h1", "h2", "h5", "title") and f"element {tag}" not in self.found:
            self._head = (tag, [])
        if a.get("datetime"):
            self.times.append(a["datetime"])

    def _start_meta(self, a: dict[str, str]) -> None:
        names = [a[k].lower() for k in ("property", "name", "itemprop") if a.get(k)]
        if names:
            self.found[f"meta {names[0]}"] = a.get("content", "")

    def _start_script(self, a: dict[str, str]) -> None:
        self._script = [] if a.get("type") == "application/ld+json" else None

    def _start_time(self, a: dict[str, str]) -> None:
        if a.get("itemprop") == "datePublished":
            self.first("element time", a.get("datetime"))

    def _reference(self, a: dict[str, str]) -> tuple[str, bool] | None:
        """The address that an element leads to and whether it is a feed's; none if it may not be followed."""
        if not a.get("href") or "nofollow" in a.get("rel", "").lower().split():
            return None
        target = urljoin(self.url, a["href"].strip())
        return (target, "rss" in a.get("type", "") or "atom" in a.get("type", "")) if urlsplit(target).scheme in ("http", "https") else None

    def _start_link(self, a: dict[str, str]) -> None:
        to = self._reference(a)
        if to and to[1]:
            self.feeds.append(to[0])

    def _start_a(self, a: dict[str, str]) -> None:
        self._start_link(a)
        to = self._reference(a)
        if to and not to[1]:
            self._anchor = (to[0], [])

    def _structured(self, text: str) -> None:
        try:
            objects = list(nodes(json.loads(text)))
        except ValueError:
            return
        for role, kinds in ROLES.items():
            if f"role {role}" in self.found:
                continue
            held = [o for o in objects if any(k in str(o.get("@type", "")) for k in kinds)]
            if held:
                self.found[f"role {role}"] = "held"
                for key, value in held[0].items():
                    self.first(f"{role} {key}", value)

    def handle_endtag(self, tag: str) -> None:
        if tag == "script" and self._script is not None:
            self._structured("".join(self._script))
            self._script = None
        if tag == "a" and self._anchor:
            self.links.append((self._anchor[0], _joined(["".join(self._anchor[1])])))
            self._anchor = None
        if self._head and tag == self._head[0]:
            self.first(f"element {tag}", _joined(["".join(self._head[1])]))
            self._head = None
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if self._script is not None:
            self._script.append(data)
            return
        if self._anchor:
            self._anchor[1].append(data)
        if self._head:
            self._head[1].append(data)
        if not {"script", "style"} & set(self.open):
            self.text["visible"].append(data)
        if ASIDE & set(self.open):
            return
        self.text["all"].append(data)
        for k in MAIN:
            if k in self.open:
                self.text[k].append(data)


def _joined(parts: list[str]) -> str:
    return " ".join(" ".join(parts).split())


def _day(word: str) -> bool:
    return word.isdecimal() and word.isascii() and 0 < len(word) <= 2


def _month(word: str) -> str:
    """A month's name, perhaps cut short with a full stop; blank for what is none."""
    bare = word.removesuffix(".")
    return bare if bare.isalpha() else ""


def labelled_date(words: list[str]) -> str:
    """The day, month and year after the words "publication date"."""
    low = [w.lower() for w in words]
    for at in range(len(words) - 4):
        day, month, year = words[at + 2 : at + 5]
        if low[at : at + 2] == ["publication", "date"] and _day(day) and _month(month) and year[:4].isdecimal() and len(year) >= 4:
            return f"{day} {month} {year[:4]}"
    return ""


def ideographic_date(text: str) -> str:
    """The first date of year, month and day before their ideographs."""
    for at, sign in enumerate(text):
        if sign != "年":
            continue
        month, _, rest = text[at + 1 :].partition("月")
        year, day = text[max(0, at - 4) : at], rest.partition("日")[0]
        if "日" in rest and len(year) == 4 and year.isdecimal() and _day(month) and _day(day):
            return f"{int(year):04}-{int(month):02}-{int(day):02}"
    return ""


def day_range(text: str) -> tuple[str, str]:
    """First and last day of the first range of days in one month, else of the first across two; blanks for none."""
    words = text.replace("–", "-").replace("-", " - ").split()
    across = ("", "")
    for at, w in enumerate(words):
        if w != "-" or at + 3 >= len(words) or not at:
            continue
        day, month, year = words[at + 1], _month(words[at + 2]), words[at + 3][:4]
        if not (_day(day) and month and year.isdecimal() and len(year) == 4 and year.startswith("20")):
            continue
        before = words[at - 1]
        if _day(before):
            return f"{before} {month} {year}", f"{day} {month} {year}"
        if not across[0] and at > 1 and _month(before) and _day(words[at - 2]):
            across = f"{words[at - 2]} {_month(before)} {year}", f"{day} {month} {year}"
    return across


def read_page(url: str, text: str | None, words: int = 600) -> tuple:
    """A row of ``PAGE``."""
    url = url or ""
    r = Reader(url)
    r.feed(text or "")
    r.close()
    visible = _joined(r.text["visible"])
    body = next((t for k in (*MAIN, "all") if (t := _joined(r.text[k]))), "")
    r.first("text body", body)
    r.first("text labelled", labelled_date(visible.split()))
    if "/press/" in url:
        r.first("text ideographs", ideographic_date(visible))
    if "/event/" in url and not any(r.found.get(p) for p in PLACES["first day"]):
        days = (r.times[0], r.times[-1]) if r.times else day_range(visible)
        # a day found in the text goes with the other one there
        for place, day in zip(("first day", "last day"), days, strict=True):
            r.found |= {p: "" for p in PLACES[place]} | {f"text {place}": day}
    value = {field: next((x for p in places if (x := r.found.get(p))), "") for field, places in PLACES.items()}
    closed = "nofollow" in r.found.get("meta robots", "").lower()
    links = [] if closed else [{"target": t, "label": x} for t, x in r.links]
    return (url, value["title"], value["published"], value["modified"], value["first day"], value["last day"], value["summary"], " ".join(body.split()[:words]), links, [] if closed else r.feeds, closed)


def parse_pages(df: DataFrame, url: str, text: str, words: int = 600) -> DataFrame:
    """A row of ``PAGE`` for each page; broken markup gives what could be read, an empty page blanks."""
    names = [p.split(" ")[0] for p in re.split(r", (?=\w+ )", PAGE)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([read_page(u, t, words) for u, t in zip(b["u"], b["t"], strict=True)], columns=names)

    return df.select(F.col(url).alias("u"), F.col(text).alias("t")).mapInPandas(run, PAGE)


def edges(pages: DataFrame) -> DataFrame:
    """parent, url, label, place of parsed pages' links."""
    return pages.select(F.col("doc_url").alias("parent"), F.posexplode("links").alias("place", "l")).select("parent", F.col("l.target").alias("url"), F.col("l.label").alias("label"), "place")

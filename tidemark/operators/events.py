"""Consolidating reports of one event in order of arrival.

A report is held against those kept before it: the same address and version, or the same event
with the same update, makes it a duplicate; the same event with another update hands it the
kept one's event id, which later reports then see. That is a single ordered pass over reports
that could meet at all, so rows are first brought together by connected components of the
three things a match needs one of (address, event id, a name as near as a match asks, of the same
year and digits), found in rounds of minimum labels, and each component is passed through on its
own, each report meeting only the kept ones that indexes by address, event and name name. Near names are found by an exact block: names whose ratio is 0.9 differ in at most a tenth of
their letters, so of one more segments than that, one recurs in the other name at a bounded shift.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import cut_lineage

SAME = 0.9


def components(pairs: DataFrame) -> DataFrame:
    """id, root of rows id, key: ids joined by equal keys share the smallest id among them.

    Labels spread through keys and are then followed to their own label, so that the number of
    rounds grows with the logarithm of a chain's length.
    """
    pairs = cut_lineage(pairs.where("key is not null").distinct())
    roots = cut_lineage(pairs.select("id", F.col("id").alias("root")).distinct())
    while True:
        by_key = pairs.join(roots, "id").groupBy("key").agg(F.min("root").alias("low"))
        low = pairs.join(by_key, "key").groupBy("id").agg(F.min("low").alias("low"))
        step = roots.join(low, "id").select("id", "root", F.least("root", "low").alias("near"))
        jump = roots.select(F.col("id").alias("near"), F.col("root").alias("far"))
        new = cut_lineage(step.join(jump, "near", "left").select("id", "root", F.least("near", F.coalesce("far", "near")).alias("new")))
        changed = new.where("new < root").limit(1).count()
        roots = new.select("id", F.col("new").alias("root"))
        if not changed:
            return roots


def _near(a: str, b: str) -> bool:
    if a == b:
        return True
    m = SequenceMatcher(None, a, b)
    return m.real_quick_ratio() >= SAME and m.quick_ratio() >= SAME and m.ratio() >= SAME


def _edits(short: int, long: int) -> int:
    """The most letters in which names of these lengths and a ratio of 0.9 differ; negative where no such names are."""
    most, gap = (short + long) // 10, long - short
    return most - (most - gap) % 2 if most >= gap else -1


@lru_cache(1 << 12)
def _segments(n: int) -> tuple[tuple[int, int], ...]:
    """Start and end of the segments of a name of ``n`` letters: one more than it differs in from any longer near one."""
    longer, most = n, 0
    while _edits(n, longer) >= 0:
        most, longer = max(most, _edits(n, longer)), longer + 1
    return tuple((k * n // (most + 1), (k + 1) * n // (most + 1)) for k in range(most + 1))


@lru_cache(1 << 12)
def _probes(n: int) -> tuple[tuple[int, int, int, int], ...]:
    """Length, segment, start and end of what a name of ``n`` letters may share with one as long or shorter.

    Take the first segment k, from 0, with at most k edits up to its end: it has none itself and
    exactly k before it, so it is shifted by k, k - 2, ..., -k, and the rest must make up the lengths.
    """
    out, short = [], n
    while short > 0 and (most := _edits(short, n)) >= 0:
        for k, (lo, hi) in enumerate(_segments(short)[: most + 1]):
            for shift in range(-k, k + 1, 2):
                if abs(n - short - shift) <= most - k and 0 <= lo + shift and hi + shift <= n:
                    out.append((short, k, lo + shift, hi + shift))
        short -= 1
    return tuple(out)


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols = ["id", "block", "own", "key"]
    for batch in batches:
        out: list[tuple] = []
        for at, block, name in zip(batch["id"], batch["block"], batch["name"], strict=True):
            out += [(at, block, True, f"{len(name)},{k},{name[lo:hi]}") for k, (lo, hi) in enumerate(_segments(len(name)))] if name else []
            for short, k, lo, hi in _probes(len(name)):
                out.append((at, block, False, f"{short},{k},{name[lo:hi]}"))
            if len(out) > 100_000:
                yield pd.DataFrame(out, columns=cols)
                out = []
        yield pd.DataFrame(out, columns=cols)


def _lower(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(name=batch["name"].str.lower())


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        # the ratio depends on the order of the two
        yield batch.loc[[_near(a, b) or _near(b, a) for a, b in zip(batch["name_a"], batch["name_b"], strict=True)], ["a", "b"]]


def near_names(names: DataFrame) -> DataFrame:
    """a, b of all pairs of names (id, block, name) of one block whose ratio is 0.9 in either order. Each name once a block."""
    kind = names.schema["id"].dataType.simpleString()
    names = cut_lineage(names.select("id", "block", "name").mapInPandas(_lower, f"id {kind}, block string, name string"))
    keys = names.mapInPandas(_keys, f"id {kind}, block string, own boolean, key string").select("id", "own", F.xxhash64("block", "key").alias("key"))
    keys = cut_lineage(keys)
    own, probes = keys.where("own").select(F.col("id").alias("a"), "key"), keys.where("not own").select(F.col("id").alias("b"), "key")
    pairs = own.join(probes, "key").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    side = lambda c: names.select(F.col("id").alias(c), F.col("block").alias(f"block_{c}"), F.col("name").alias(f"name_{c}"))
    # letters left out and put in are no fewer than edits with replacements
    close = F.expr("levenshtein(name_a, name_b, int((char_length(name_a) + char_length(name_b)) div 10)) >= 0")
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").where("block_a = block_b").where(close)
    return pairs.select("a", "b", "name_a", "name_b").mapInPandas(_verified, f"a {kind}, b {kind}")


class Pool:
    """The kept reports of one component, found by address, by event and by name, in order of arrival."""

    def __init__(self) -> None:
        self.kept: list[dict] = []
        self.at: dict[tuple[str, str], list[int]] = defaultdict(list)
        self.names: dict[str, dict[str, list[str]]] = defaultdict(dict)  # by block: a name and the names near it

    def near(self, block: str, name: str) -> list[str]:
        """The names of kept reports of the block that are near ``name``, itself among them."""
        held = self.names[block]
        if name not in held:
            held[name] = [x for x in held if _near(name, x)] + [name]
            for x in held[name][:-1]:
                held[x].append(name)
        return held[name]

    def places(self, report: dict) -> list[int]:
        """Where the reports are that share an address or a name with this one."""
        found = [self.at["url", report["url_key"]]] if report["url_key"] else []
        found += [self.at["name " + report["block"], x] for x in self.near(report["block"], report["name"].lower())]
        return [k for places in found for k in places]

    def keep(self, report: dict) -> None:
        place = len(self.kept)
        self.kept.append(report)
        for key in (("url", report["url_key"]), ("event", report["event_out"]), ("name " + report["block"], report["name"].lower())):
            if key[1] or key[0].startswith("name"):
                self.at[key].append(place)

    def settle(self, report: dict) -> int | None:
        """The id of the kept report that this one repeats; where there is none the event of the last one of its event is its own."""
        report["event_out"] = report["event_id"]
        by_name = set(self.places(report))
        agenda = [*by_name, *(self.at["event", report["event_out"]] if report["event_out"] else ())]
        heapify(agenda)
        done, named = -1, self.near(report["block"], report["name"].lower())
        while agenda:
            place = heappop(agenda)
            if place <= done:
                continue
            done, other = place, self.kept[place]
            versions = {v for v in (report["modified"], other["modified"]) if v}
            if report["url_key"] and report["url_key"] == other["url_key"] and len(versions) < 2:
                return other["id"]
            alike = other["block"] == report["block"] and other["name"].lower() in named
            if not alike and (not report["event_out"] or other["event_out"] != report["event_out"]):
                continue
            if all(report[c] == other[c] for c in ("stage", "published")) and (report["fingerprint"] == other["fingerprint"] or _near(report["summary"].lower(), other["summary"].lower())):
                return other["id"]
            if report["event_out"] != other["event_out"]:
                report["event_out"] = other["event_out"]
                for k in self.at["event", other["event_out"]]:
                    heappush(agenda, k)
        return None


def pass_through(reports: list[dict]) -> list[dict]:
    """The ordered pass over one component; adds ``event_out`` and ``duplicate_of``."""
    pool = Pool()
    for r in reports:
        r["block"] = r["published"][:4] + "|" + ",".join(re.findall(r"\d+", r["name"]))
        r["duplicate_of"] = pool.settle(r)
        if r["duplicate_of"] is None:
            pool.keep(r)
    return reports


def consolidate(df: DataFrame) -> DataFrame:
    """id, event_out, duplicate_of of reports (id, place, url_key, event_id, name, published, modified, stage, fingerprint, summary).

    Text columns may be null and then count as blank; a blank address or event id is unknown and
    equals none. A component, rows that near names, addresses and event ids tie together, must fit a task.
    """
    blank = [c for c in df.columns if c not in ("id", "place")]
    rows = df.select("id", "place", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in blank))
    digits = F.concat_ws("|", F.substring("published", 1, 4), F.array_join(F.regexp_extract_all("name", F.lit(r"\d+"), F.lit(0)), ","))
    rows = cut_lineage(rows.withColumn("block", digits))
    known = lambda p, c: F.when(F.col(c) != "", F.concat(F.lit(p), c))
    keys = F.explode(F.array(known("u", "url_key"), known("e", "event_id"), F.concat(F.lit("d"), F.to_json(F.struct("block", "name"))))).alias("key")
    # one row stands for all of a name
    near = near_names(rows.groupBy("block", "name").agg(F.min("id").alias("id")))
    tie = F.concat_ws(" ", F.lit("n"), "a", "b")
    ties = near.select(F.explode(F.array("a", "b")).alias("id"), tie.alias("key"))
    roots = components(rows.select("id", keys).unionByName(ties))
    kind = df.schema["id"].dataType.simpleString()

    def one(group: pd.DataFrame) -> pd.DataFrame:
        done = pass_through(group.sort_values("place").to_dict("records"))
        out = pd.DataFrame({"id": [r["id"] for r in done], "event_out": [r["event_out"] for r in done]})
        out["duplicate_of"] = pd.array([r["duplicate_of"] for r in done], dtype="Int64")
        return out

    return rows.drop("block").join(roots, "id").groupBy("root").applyInPandas(one, f"id {kind}, event_out string, duplicate_of {kind}")

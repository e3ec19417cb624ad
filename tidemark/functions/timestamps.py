"""Mixed timestamp formats and time zones, normalised to one UTC instant.

Each value becomes a mask of character classes (``9`` a digit, ``A`` a letter run that isn't a
known word, other signs themselves). A mask is mapped to a parser once, whatever the number of
values that have it: a list of fields by position. All values of a mask are then cut, checked
and converted as arrays; local times go through transition tables of their zones, taken from
the installed IANA data, whose version :func:`zone_version` names.

Defined results: null, blank, partial (month, quarter or year alone), impossible and unknown
values have no instant, whatever their length; a date without a time is midnight; a fraction of a second is dropped;
without a zone the row's home zone holds; a local time skipped by a clock change takes the
offset before the change, a repeated one is its first occurrence; zone letters are fixed
offsets; a bare number of eight digits is a date, of ten or more an epoch in seconds, from
twelve digits on in milliseconds.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of months and days, zone letters.
MONTHS = {m: i + 1 for i, m in enumerate(("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"))}
MONTHS |= {m[:3]: i for m, i in MONTHS.items()} | {"sept": 9}
DAYS = {d[:n] for d in ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday") for n in (3, 4, 5, 9)}
LETTERS = {"z": 0, "utc": 0, "gmt": 0, "ut": 0, "est": -300, "edt": -240, "cet": 60, "cest": 120}

#: Masks of longer values aren't kept, so that the caches stay small; they are read like others.
KEPT = 120
ZONE = re.compile(r"\[?[A-Za-z]+/[A-Za-z_+\-0-9]+(?:/[A-Za-z_]+)?\]?")
WORD = re.compile(r"[^\W\d_]+", re.UNICODE)
BLANK = re.compile(r"[\s\u200b\u200c\u200d\ufeff\u00ad]+", re.UNICODE)

_TIME = r"(?P<hour>9{1,2}):(?P<minute>99)(?::(?P<second>99)(?:[.,](?P<fraction>9+))?)?"
_ZONED = r"(?: ?(?:(?P<sign>[+\-])(?P<zh>99):?(?P<zm>99)|(?P<letters>Z+)|(?P<region>R+)))?"
_REST = rf"(?:(?:,? |t| aa )?{_TIME}(?: ?(?P<half>h+))?{_ZONED})?"
#: Parsers by the shape of the mask: numeric with the year first; named month; two numbers of unsure order.
SHAPES = [
    re.compile(rf"(?P<year>9999)(?P<s>[\-/.])(?P<month>9{{1,2}})(?P=s)(?P<day>9{{1,2}}){_REST}"),
    re.compile(rf"(?P<year>9999)年(?P<month>9{{1,2}})月(?P<day>9{{1,2}})日{_REST}"),
    re.compile(rf"(?P<a>9{{1,2}})(?P<s>[\-/.])(?P<b>9{{1,2}})(?P=s)(?P<year>9999){_REST}"),
    re.compile(rf"(?:d+\.?,? )?(?P<day>9{{1,2}})[ \-](?P<named>m+)\.?,?[ \-](?P<year>9999){_REST}"),
    re.compile(rf"(?:d+\.?,? )?(?P<named>m+)\.? (?P<day>9{{1,2}}),? (?P<year>9999){_REST}"),
    re.compile(r"(?P<year>9999)(?P<month>99)(?P<day>99)(?:t(?P<hour>99)(?P<minute>99)(?P<second>99)?(?P<letters>Z+)?)?"),
    re.compile(r"(?P<epoch>9{10,})(?:\.(?P<fraction>9+))?"),
]


def zone_version() -> str:
    """The version of the zone data in use."""
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        return "system"


@lru_cache(1024)
def transitions(zone: str) -> tuple[np.ndarray, np.ndarray] | None:
    """(boundaries, offsets) in seconds for local times: a local time before boundaries[i] and not before
    boundaries[i - 1] has offsets[i]. A boundary is the later local reading of its change, so that a
    skipped time keeps the offset before it and a repeated one is its first occurrence."""
    from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

    try:
        info = ZoneInfo(zone)
    except (ZoneInfoNotFoundError, ValueError, OSError):
        return None
    at = lambda s: int(info.utcoffset((datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=s)).astimezone(info)).total_seconds())
    step, first, last = 14 * 86400, -2208988800, 4102444800  # 1900 to 2100
    bounds, offsets, before = [], [at(first)], at(first)
    for s in range(first + step, last, step):
        now = at(s)
        if now != before:
            lo, hi = s - step, s
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if at(mid) == before else (lo, mid)
            bounds.append(hi + max(before, now))
            offsets.append(now)
            before = now
    return np.array(bounds, dtype=np.int64), np.array(offsets, dtype=np.int64)


def _class(word: str) -> str:
    low = word.lower()
    if word in ("年", "月", "日"):
        return word
    kind = "m" if low in MONTHS else "d" if low in DAYS else "h" if low in ("am", "pm") else "Z" if low in LETTERS else "t" if low == "t" else "a" if low == "at" else "A"
    return kind * len(word)


@lru_cache(1 << 14)
def _rough(shape: str, words: tuple[str, ...]) -> str:
    """The full mask of a shape, its words classed."""
    it = iter(words)
    return re.sub("A+", lambda m: _class(next(it)), shape)


_SHAPE = str.maketrans({c: "9" for c in "0123456789"})


def _region(value: str) -> re.Match | None:
    """The name of a region in a value, found from its slash, so that long runs of letters are passed once."""
    slash = value.find("/")
    while slash != -1:
        start = slash
        while start and value[start - 1].isascii() and value[start - 1].isalpha():
            start -= 1
        found = ZONE.match(value, start - 1 if start and value[start - 1] == "[" else start)
        if found:
            return found
        slash = value.find("/", slash + 1)
    return None


def _plain(value: str) -> str:
    words = tuple(WORD.findall(value))
    shaped = WORD.sub(lambda m: "A" * len(m.group()), value.translate(_SHAPE))
    # adjoining classes, as in 99T99 or 9:99PM, stand apart already; months keep their length
    return (_rough if len(value) <= KEPT else _rough.__wrapped__)(shaped, words)


def mask(value: str) -> str:
    """The character-class mask of one trimmed value; no date has a second region, so only the first is looked for."""
    at = _region(value)
    if at and not value[: at.start()].strip().isalpha():
        return _plain(value[: at.start()]) + "R" * len(at.group()) + _plain(value[at.end() :])
    return _plain(value)


@lru_cache(1 << 14)
def parser(shape: str) -> dict[str, tuple[int, int]] | None:
    """Where each field lies in values of this mask; None if the mask is no full date. Called once for each distinct mask."""
    for p in SHAPES:
        m = p.fullmatch(shape)
        if m:
            return {k: m.span(k) for k, v in m.groupdict().items() if v is not None}
    return None


def _days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Days since 1970-01-01 of the Gregorian calendar."""
    y = y - (m <= 2)
    era = y // 400
    yoe = y - era * 400
    doy = (153 * (m + np.where(m > 2, -3, 9)) + 2) // 5 + d - 1
    return era * 146097 + yoe * 365 + yoe // 4 - yoe // 100 + doy - 719468


def _valid(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> np.ndarray:
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    most = np.array([0, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])[np.clip(m, 0, 12)] + ((m == 2) & leap)
    return (y >= 1) & (m >= 1) & (m <= 12) & (d >= 1) & (d <= most)


def _convert(values: np.ndarray, where: dict[str, tuple[int, int]], zones: np.ndarray, month_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seconds since 1970 UTC, valid) of values that share a mask."""
    cut = lambda k: np.array([v[where[k][0] : where[k][1]] for v in values], dtype=object)
    num = lambda k, default=0: cut(k).astype(np.int64) if k in where else np.full(len(values), default, np.int64)
    if "epoch" in where:
        raw = cut("epoch")
        ok = np.array([len(x) <= 17 for x in raw])
        n = np.where(ok, raw, "0").astype(np.int64)
        sec = np.where(n >= 100_000_000_000, n // 1000, n)
        return sec, ok & (sec < 253402300800)
    y = num("year")
    if "a" in where:
        a, b = num("a"), num("b")
        m, d = np.where(month_first, a, b), np.where(month_first, b, a)
    else:
        m = np.array([MONTHS[x.lower()] for x in cut("named")], dtype=np.int64) if "named" in where else num("month")
        d = num("day")
    h, mi, s = num("hour"), num("minute"), num("second")
    ok = _valid(y, m, d) & (mi < 60) & (s < 60)
    if "half" in where:
        ok &= (h >= 1) & (h <= 12)
        h = h % 12 + 12 * np.array([x.lower() == "pm" for x in cut("half")], dtype=np.int64)
    ok &= h < 24
    local = _days(y, np.clip(m, 1, 12), d) * 86400 + h * 3600 + mi * 60 + s
    if "sign" in where:
        zh, zm = num("zh"), num("zm")
        ok &= (zh <= 18) & (zm < 60)
        return local - np.where(cut("sign") == "-", -1, 1) * (zh * 3600 + zm * 60), ok
    if "letters" in where:
        return local - np.array([LETTERS[x.lower()] for x in cut("letters")], dtype=np.int64) * 60, ok
    if "region" in where:
        zones = np.array([x.strip("[]") for x in cut("region")], dtype=object)
    out = local.copy()
    for z in set(zones):
        at = zones == z
        held = transitions(z)
        if held is None:
            ok &= ~at
        else:
            out[at] = local[at] - held[1][np.searchsorted(held[0], local[at], side="right")]
    return out, ok


def normalise(values: pd.Series, zones: pd.Series, month_first: pd.Series) -> pd.Series:
    """``YYYY-MM-DDTHH:MM:SSZ`` of each value, or None. Equal values of equal zone and order are converted once."""
    whole = pd.DataFrame({"v": values.where(values.notna(), "").to_numpy(object), "z": zones.where(zones.notna(), "UTC").to_numpy(object), "f": (month_first == True).to_numpy(bool)})  # noqa: E712
    code = whole.groupby(["v", "z", "f"], sort=False).ngroup().to_numpy()
    frame = whole.iloc[np.unique(code, return_index=True)[1]].reset_index(drop=True)
    frame["v"] = [BLANK.sub(" ", v).strip() for v in frame["v"]]
    frame["mask"] = [mask(v) if v else "" for v in frame["v"]]
    out = np.full(len(frame), None, dtype=object)
    for shape, at in frame.groupby("mask", sort=False).indices.items():
        where = (parser if len(shape) <= KEPT else parser.__wrapped__)(shape) if shape else None
        if where is None:
            continue
        part = frame.iloc[at]
        sec, ok = _convert(part["v"].to_numpy(object), where, part["z"].to_numpy(object), part["f"].to_numpy(bool))
        ok &= (sec >= -62135596800) & (sec < 253402300800)
        text = np.datetime_as_string(np.where(ok, sec, 0).astype("datetime64[s]"))
        out[at[ok]] = [t + "Z" for t in text[ok]]
    return pd.Series(out[code] if len(frame) else out, index=values.index)


def utc_text(value: Column | str, zone: Column | str, month_first: Column | str) -> Column:
    """The instant of ``value`` as ``YYYY-MM-DDTHH:MM:SSZ`` in UTC, null if it has none."""

    @F.pandas_udf("string")
    def convert(v: pd.Series, z: pd.Series, f: pd.Series) -> pd.Series:
        return normalise(v, z, f)

    return convert(value, zone, month_first)


def with_utc(df: DataFrame, columns: list[str], zone: str, month_first: str) -> DataFrame:
    """One row for each value of ``columns``: the other columns, field_name, raw, utc_text; one Python pass, no shuffle. The version of the zone data is in the column's metadata."""
    rest = [c for c in df.columns if c not in columns]
    fields = F.explode(F.array(*(F.struct(F.lit(c).alias("field_name"), F.col(c).alias("raw")) for c in columns))).alias("_f")
    return df.select(*rest, fields).select(*rest, "_f.*").withColumn("utc_text", utc_text("raw", zone, month_first)).withMetadata("utc_text", {"zone_data": zone_version()})



import random
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pandas as pd
import pytest

from tidemark.functions.timestamps import mask, normalise, parser, with_utc


def one(v, zone="UTC", month_first=False):
    return normalise(pd.Series([v], dtype=object), pd.Series([zone]), pd.Series([month_first]))[0]


CASES = [
    ("25/10/2024", "America/New_York", False, "2024-10-25T04:00:00Z"), ("10/25/2024 1:57 pm", "UTC", True, "2024-10-25T13:57:00Z"), ("2024-11-24 10:00:02 Australia/Sydney", "UTC", False, "2024-11-23T23:00:02Z"),
    ("2024年10月3日", "Asia/Tokyo", False, "2024-10-02T15:00:00Z"), ("1730596631", "Asia/Tokyo", False, "2024-11-03T01:17:11Z"), ("1731707099793", "UTC", False, "2024-11-15T21:44:59Z"), ("1734502008.923", "UTC", False, "2024-12-18T06:06:48Z"),
    ("Tue, 5 Nov 2024 04:54:54 +0530", "UTC", False, "2024-11-04T23:24:54Z"), ("November 7, 2024 12:08 AM EST", "UTC", False, "2024-11-07T05:08:00Z"), ("20241030T153933Z", "UTC", False, "2024-10-30T15:39:33Z"),
    (" 2024-10-05T00:06:20.505+05:45 ", "UTC", False, "2024-10-04T18:21:20Z"), ("2024-12-14T11:12:45[Asia/Tokyo]", "UTC", False, "2024-12-14T02:12:45Z"), ("20241206", "Europe/Berlin", False, "2024-12-05T23:00:00Z"),
    ("16-DEC-2024", "UTC", False, "2024-12-16T00:00:00Z"), ("26 Nov 2024 8:25AM", "UTC", False, "2024-11-26T08:25:00Z"), ("12:00", "UTC", False, None), ("31.11.2025", "UTC", False, None), ("2025-13-04T10:00:00Z", "UTC", False, None),
    ("March 2026", "UTC", False, None), ("2025", "UTC", False, None), ("0000-00-00", "UTC", False, None), ("", "UTC", False, None), (None, "UTC", False, None), ("2024-02-29", "UTC", False, "2024-02-29T00:00:00Z"), ("2023-02-29", "UTC", False, None),
]


@pytest.mark.parametrize(("value", "zone", "month_first", "expected"), CASES)
def test_cases(value, zone, month_first, expected):
    assert one(value, zone, month_first) == expected


def test_clock_changes():
    # skipped: the offset before the change; repeated: the first
    assert one("2024-03-10 02:30", "America/New_York") == "2024-03-10T07:30:00Z"
    assert one("2024-11-03 01:30", "America/New_York") == "2024-11-03T05:30:00Z"
    assert one("2024-03-31 01:30", "Europe/London") == "2024-03-31T01:30:00Z"
    assert one("2024-10-27 02:30", "Europe/Berlin") == "2024-10-27T00:30:00Z"


def test_local_times_as_the_standard_library_has_them():
    rng = random.Random(5)
    for zone in ("America/New_York", "Europe/London", "Australia/Sydney", "Asia/Kathmandu", "Africa/Nairobi", "America/Sao_Paulo"):
        info = ZoneInfo(zone)
        for _ in range(60):
            t = datetime(1990, 1, 1) + timedelta(minutes=rng.randrange(40 * 525_600))
            utc = (t.replace(tzinfo=info, fold=0)).astimezone(timezone.utc)
            assert one(t.strftime("%Y-%m-%d %H:%M"), zone) == utc.strftime("%Y-%m-%dT%H:%M:%SZ")


def test_one_parser_for_a_mask():
    assert mask("2024-01-02 03:04") == mask("1999-12-31 23:59")
    assert parser(mask("nothing here")) is None


def test_values_of_any_length():
    assert one(f"2024-03-05T10:00:00.{'1' * 110}Z") == "2024-03-05T10:00:00Z"
    assert one(" " * 500 + "5 March 2024" + " " * 500) == "2024-03-05T00:00:00Z"
    assert [one(v) for v in ("x" * 500_000, "a/" * 50_000, "9" * 5000, "2024-01-01 Europe/Paris Europe/Paris")] == [None] * 4


def test_equal_values_are_converted_once(monkeypatch):
    from tidemark.functions import timestamps

    seen, convert = [], timestamps._convert
    monkeypatch.setattr(timestamps, "_convert", lambda v, *a: seen.append(len(v)) or convert(v, *a))
    out = normalise(pd.Series(["2024-01-02", None, "2024-01-02", "2024-01-03"] * 50), pd.Series(["UTC", None, None, "UTC"] * 50), pd.Series([False, None, None, False] * 50))
    assert seen == [2] and out.tolist() == ["2024-01-02T00:00:00Z", None, "2024-01-02T00:00:00Z", "2024-01-03T00:00:00Z"] * 50


def test_table_with_nulls_ties_and_clashing_names(spark):
    rows = [(1, "2024-01-02", None, "UTC", False, "x"), (1, "2024-01-02", None, "UTC", False, "x"), (2, None, None, None, None, None), (3, "x" * 5000, "3 Jan 2024", "No/Zone", True, "y")]
    df = spark.createDataFrame(rows, "id long, a string, b string, zone string, mf boolean, v string")
    out = with_utc(df, ["a", "b"], "zone", "mf")
    got = sorted((r.id, r.field_name, r.utc_text or "") for r in out.collect())
    assert got == [(1, "a", "2024-01-02T00:00:00Z")] * 2 + [(1, "b", "")] * 2 + [(2, "a", ""), (2, "b", ""), (3, "a", ""), (3, "b", "")]
    assert with_utc(df.limit(0), ["a"], "zone", "mf").count() == 0

"""Addresses and identifiers as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import strip


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Fields that only track a reader, besides ``utm_``. Fixed values.
TRACKING = ("fbclid", "gclid", "trk")
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def part(c: Column | str, n: int) -> Column:
    """1 scheme, 2 authority, 3 path, 4 query of an address; blank where there is none."""
    return F.regexp_extract(_c(c), _PARTS, n)


def bare_url(c: Column | str) -> Column:
    """Without query, fragment and closing slashes, all in lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(_c(c), r"[?#][\s\S]*\z", ""), r"/+\z", ""))


def _query(c: Column, tracking: tuple[str, ...], blanks: bool) -> Column:
    keep = lambda f: (f != "") & ~F.lower(f).rlike("^(?:utm_|(?:" + "|".join(tracking) + ")(?:=|$))") & (F.lit(True) if blanks else f.rlike("=[\\s\\S]"))
    whole = F.transform(F.filter(F.split(part(c, 4), "&"), keep), lambda f: F.when(F.instr(f, "=") > 0, f).otherwise(F.concat(f, F.lit("="))))
    return F.array_join(F.array_sort(whole), "&")


def canonical_url(c: Column | str) -> Column:
    """Scheme and host in lower case, path as it is without closing slashes, fields sorted without trackers, no fragment. Percent signs stay as written."""
    c = _c(c)
    query = _query(c, TRACKING, True)
    host = F.lower(part(c, 2))
    return F.concat(
        F.when(part(c, 1) != "", F.concat(F.lower(part(c, 1)), F.lit(":"))).otherwise(""), F.when(host != "", F.concat(F.lit("//"), host)).otherwise(""),
        F.regexp_replace(part(c, 3), r"/+\z", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
    )


def article_key(c: Column | str) -> Column:
    """Host without ``www.``, path, fields with a value, sorted; without scheme, trackers and fragment."""
    c = _c(c)
    query = _query(c, ("fbclid", "gclid"), False)
    return F.concat(F.regexp_replace(F.lower(part(c, 2)), r"^www\.", ""), F.regexp_replace(part(c, 3), r"/+\z", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def host(c: Column | str) -> Column:
    """In lower case, without user and port."""
    return F.regexp_replace(F.regexp_replace(F.lower(part(c, 2)), "^.*@", ""), r":\d*\z", "")


def doi_of(doi: Column | str, url: Column | str) -> Column:
    """The DOI, or else the address, in lower case without one resolver or ``doi:`` prefix."""
    given = F.coalesce(F.when(strip(doi) != "", strip(doi)), strip(url))
    return F.regexp_replace(F.lower(given), r"^(?:https?://doi\.org/|doi:)", "")


def within(host_column: Column, domains: Column) -> Column:
    """The host is one of ``domains`` or below it."""
    return F.exists(domains, lambda d: (host_column == d) | F.endswith(host_column, F.concat(F.lit("."), d)))

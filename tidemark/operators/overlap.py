"""Verbatim overlap of two texts of a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def copies_span(note: str, source: str, span: int, least: int = 20) -> Column:
    """Whether any ``span`` words in a row of ``note`` (or all, if it has fewer) stand in ``source``, which must have ``least`` words."""
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    n, s = words(note), words(source)
    whole = F.concat(F.lit(" "), F.array_join(s, " "), F.lit(" "))
    starts = F.sequence(F.lit(1), F.greatest(F.size(n) - span + 1, F.lit(1)))
    hit = F.exists(starts, lambda i: F.contains(whole, F.concat(F.lit(" "), F.array_join(F.slice(n, i, span), " "), F.lit(" "))))
    return F.coalesce((F.size(s) >= least) & (F.size(n) > 0) & hit, F.lit(False))

"""Dates as received by feeds and pages, as columns of type date; an unknown date is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import strip


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_MAIL = r"^(?:[A-Za-z]{3},? )?(\d{1,2}) ([A-Za-z]{3}) (\d{4}) \d{1,2}:\d\d"


def iso_prefix(c: Column | str) -> Column:
    """A date in the first ten characters."""
    head = F.substring(strip(c), 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d\d-\d\d$"), F.try_to_date(head, "yyyy-MM-dd"))


def _named(text: Column, pattern: str, order: tuple[int, int, int]) -> Column:
    d, m, y = (F.regexp_extract(text, pattern, k) for k in order)
    made = F.concat_ws(" ", F.lpad(d, 2, "0"), F.initcap(F.substring(m, 1, 3)), y)
    return F.when(text.rlike(pattern), F.try_to_date(made, "dd MMM yyyy"))


def mail_date(c: Column | str) -> Column:
    """The day of a date as in mail headers, in its own zone."""
    return _named(strip(c), _MAIL, (1, 2, 3))


def any_date(c: Column | str) -> Column:
    """ISO prefix, mail date, or a day, named month and year in either order."""
    t = strip(c)
    return F.coalesce(
        iso_prefix(t), mail_date(t),
        _named(t, r"^(\d{1,2}) (January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\.? (\d{4})$", (1, 2, 3)),
        _named(t, r"^(January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec) (\d{1,2}), (\d{4})$", (2, 1, 3)),
    )


def date_or(c: Column | str, fallback: Column | str) -> Column:
    """Mail date or ISO prefix, else ``fallback``: never unknown."""
    return F.coalesce(mail_date(c), iso_prefix(c), _c(fallback))


def from_parts(parts: Column) -> Column:
    """The date of an array of year, month, day, the latter two 1 where missing."""
    at = lambda k: F.coalesce(F.get(parts, k), F.lit(1))
    ok = (F.get(parts, 0).between(1, 9999)) & at(1).between(1, 12)
    made = F.concat_ws("-", F.lpad(F.get(parts, 0).cast("string"), 4, "0"), F.lpad(at(1).cast("string"), 2, "0"), F.lpad(at(2).cast("string"), 2, "0"))
    return F.when(ok, F.try_to_date(made, "yyyy-MM-dd"))


def later_than(a: Column | str, b: Column | str) -> Column:
    """a > b, false where a is unknown."""
    return F.coalesce(_c(a) > _c(b), F.lit(False))


def display(c: Column | str, short: bool = False) -> Column:
    return F.date_format(_c(c), "MMM d, yyyy" if short else "MMMM d, yyyy")

"""The strict form of an issue, and reading one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _texts(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType(), False) for n in names]


def _list(name: str, fields: list[T.StructField]) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.StructType(fields), False), False)


#: What an issue must hold; all fields are required.
ISSUE = T.StructType([
    *_texts("issue_title_en"),
    _list("title_support", _texts("url", "angle_en")),
    _list("recent_news", _texts("url", "title_en", "source_org", "one_sentence_en")),
    _list("research_signals", _texts("url", "title_en", "source_org", "core_argument_en", "why_now_en", "agenda_position_en")),
    T.StructField("editorial_context_urls", T.ArrayType(T.StringType(), False), False),
])


def parse_issue(text: Column | str, strict: bool = False) -> Column:
    """An issue's JSON in the strict form. A text that isn't JSON of these types is null, or with ``strict`` fails the query."""
    return F.from_json(text, ISSUE, {"mode": "FAILFAST" if strict else "PERMISSIVE"})


def _lacks(of: Column, schema: T.StructType, name: str = "{}") -> Column:
    """The names of an object's fields that are null."""
    return F.flatten(F.array(*(F.when(of[f.name].isNull(), F.array(F.lit(name.format(f.name)))).otherwise(F.array().cast("array<string>")) for f in schema.fields)))


def _each(f: T.StructField) -> Callable[[Column], Column]:
    return lambda x: _lacks(x, f.dataType.elementType, f.name + ".{}")


def _missing(of: Column, schema: T.StructType) -> Column:
    """The names of the fields that are null, those of objects in lists with the list's."""
    found = [_lacks(of, schema)]
    for f in schema.fields:
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            found.append(F.coalesce(F.flatten(F.transform(of[f.name], _each(f))), F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(F.flatten(F.array(*found))))


def missing_fields(issue: Column, most_news: int = 8, most_signals: int = 5) -> Column:
    """What a parsed issue lacks: required fields, and ``too many`` of a list beyond its limit; all of it for none."""
    long = [F.when(F.size(issue[n]) > m, F.array(F.lit(f"too many {n}"))).otherwise(F.array().cast("array<string>")) for n, m in (("recent_news", most_news), ("research_signals", most_signals))]
    return F.when(issue.isNull(), F.array(F.lit("not an issue"))).otherwise(F.concat(_missing(issue, ISSUE), *long))

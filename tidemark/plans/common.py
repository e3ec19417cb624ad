"""Registering queries beside their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """QUERIES and SQL of one module."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            self.queries[name] = f
            if sql:
                self.sql[name] = sql
            return f

        return add


#: White space and everything else, as DuckDB's regular expressions have them.
WS = r"[\t-\r \x{85}\p{Z}]"
NS = r"[^\t-\r \x{85}\p{Z}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def sql_squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def sql_fingerprint(x: str) -> str:
    return f"substr(sha256({sql_squeeze(f'lower({x})')}), 1, 24)"


def sql_iso(x: str) -> str:
    return f"CASE WHEN regexp_matches(substr({sql_strip(x)}, 1, 10), '^\\d{{4}}-\\d\\d-\\d\\d$') THEN try_cast(substr({sql_strip(x)}, 1, 10) AS DATE) END"


def sql_mail(x: str) -> str:
    p = r"^(?:[A-Za-z]{3},? )?(\d{1,2}) ([A-Za-z]{3}) (\d{4}) \d{1,2}:\d\d"
    return f"try_strptime(regexp_extract({sql_strip(x)}, '{p}', 1) || ' ' || regexp_extract({sql_strip(x)}, '{p}', 2) || ' ' || regexp_extract({sql_strip(x)}, '{p}', 3), '%d %b %Y')::DATE"

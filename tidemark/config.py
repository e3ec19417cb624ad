"""The selection's settings, checked when they are made."""

from __future__ import annotations

from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    """Windows in days, limits in rows; unknown names and values out of range are refused."""

    rolling_days: int = 21
    upcoming_days: int = 14
    keep_days: int = 120
    relevance_threshold: int = 4
    pool: int = 60
    per_source: int = 2
    max_depth: int = 2
    links_per_page: int = 25
    requests: int = 120

    def __post_init__(self) -> None:
        for f in fields(self):
            v = getattr(self, f.name)
            if not isinstance(v, int) or isinstance(v, bool) or v < 0 or (f.name not in ("max_depth", "upcoming_days", "relevance_threshold") and v == 0):
                raise ValueError(f"{f.name} can't be {v!r}")

    @classmethod
    def of(cls, values: dict) -> Settings:
        unknown = set(values) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        return cls(**values)

"""Where the tables of a run live."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """Paths below ``base``; every one can be overridden by a full path.

    With ``by_event_day`` the refined positions are partitioned by the day of their event
    time, so that a run can refine newly landed days alone, and ``daily`` keeps each day's
    totals.  Each day is cut into ``parts`` by a hash of the key, and only the parts that new
    positions fall into are merged and written again.  ``pending`` holds what was landed but
    not refined, or refined but not served, by runs that stopped.
    """

    base: str
    landed_positions: str = "landing/positions"
    landed_register: str = "landing/register"
    positions: str = "refined/positions"
    register: str = "refined/register"
    daily: str = "served/line_daily"
    pending: str = "served/pending"
    activity: str = "served/line_activity"
    fmt: str = "parquet"
    by_event_day: bool = False
    parts: int = 1

    def path(self, table: str) -> str:
        place = getattr(self, table)
        absolute = place.startswith("/") or "://" in place
        return place if absolute else f"{self.base.rstrip('/')}/{place}"

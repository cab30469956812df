"""Date parsing and calendar features (FN-01..08, VAL-12).

All are native column expressions; nothing leaves the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import PERIOD_END, PERIOD_START, SEASON_BY_MONTH


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def parse_date(col: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """FN-01: lenient parse; unparseable or blank text becomes NULL (row kept)."""
    c = _c(col) if isinstance(col, str) else col
    return F.try_to_date(F.trim(c.cast("string")), fmt)


def parse_date_strict(col: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """FN-02: strict parse of a trimmed ISO date; raises on bad input under ANSI."""
    c = _c(col) if isinstance(col, str) else col
    return F.to_date(F.trim(c.cast("string")), fmt)


def calendar_columns(date_col: str, names=("Year", "Month", "DayOfMonth", "DayOfWeek", "IsWeekend")) -> list[Column]:
    """FN-03..05: year, month, day, weekday (Mon=0) and weekend flag (NULL date -> 0)."""
    if isinstance(date_col, str) and date_col.lower() in {n.lower() for n in names}:
        raise ValueError(f"a calendar column would clash with the date column {date_col!r} (names are case-insensitive)")
    d = _c(date_col)
    y, m, dd, dow, wk = names
    return [
        F.year(d).alias(y),
        F.month(d).alias(m),
        F.dayofmonth(d).alias(dd),
        F.weekday(d).alias(dow),
        F.coalesce((F.weekday(d) >= 5).cast("int"), F.lit(0)).alias(wk),
    ]


def season_expr(month: str | Column, mapping: dict[int, str] | None = None, default: str | None = None) -> Column:
    """FN-06: month -> season label via a literal map (a broadcast-free lookup)."""
    mapping = mapping or SEASON_BY_MONTH
    m = _c(month) if isinstance(month, str) else month
    lookup = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    out = F.try_element_at(lookup, m)
    return F.coalesce(out, F.lit(default)) if default is not None else out


def period_flag(date_col: str, start: str = PERIOD_START, end: str = PERIOD_END) -> Column:
    """FN-07: 1 when ``start <= date <= end`` (inclusive), else 0; NULL date -> 0."""
    d = _c(date_col)
    inside = d.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return F.coalesce(inside, F.lit(False)).cast("int")


def cyclical(col: str | Column, period: float) -> tuple[Column, Column]:
    """FN-08: (sin, cos) of ``2*pi*x/period``."""
    c = _c(col) if isinstance(col, str) else col
    ang = F.lit(2 * math.pi) * c / F.lit(float(period))
    return F.sin(ang), F.cos(ang)


def add_calendar(df: DataFrame, date_col: str, period: tuple[str, str] | None = (PERIOD_START, PERIOD_END),
                 season_map: dict[int, str] | None = None, period_name: str = "is_lockdown",
                 names=("Year", "Month", "DayOfMonth", "DayOfWeek", "IsWeekend"), season_name: str = "Season") -> DataFrame:
    """The preprocessing block: calendar parts, season and period flag, all computed in one
    ``select`` from the date column (so new names never shadow it)."""
    cols = calendar_columns(date_col, names)
    cols.append(season_expr(F.month(_c(date_col)), season_map).alias(season_name))
    if period is not None:
        cols.append(period_flag(date_col, *period).alias(period_name))
    return df.select("*", *cols)


def add_cyclical(df: DataFrame, month_col: str = "Month", dow_col: str = "DayOfWeek") -> DataFrame:
    """Month/12 and weekday/7 cyclical encodings."""
    ms, mc = cyclical(month_col, 12)
    ds, dc = cyclical(dow_col, 7)
    return df.withColumns({
        f"{month_col}_sin": ms, f"{month_col}_cos": mc, f"{dow_col}_sin": ds, f"{dow_col}_cos": dc,
    })

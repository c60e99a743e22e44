"""Column predicates shared by the reports.

All are plain Catalyst expressions: they stay inside whole-stage codegen, and
the comparisons on raw columns (period bounds, flags, IN lists) are pushed into
the Parquet scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Period:
    """Reporting period ``[start, end)`` to the second.

    The reference writes ``BETWEEN 00:00:00 AND 23:59:59`` on a DATE with one
    second resolution; the half-open form is the same set for second-resolution
    data and also keeps any sub-second timestamp of the last second.
    """

    start: dt.datetime
    end: dt.datetime

    @staticmethod
    def calendar_year(year: int) -> Period:
        return Period(dt.datetime(year, 1, 1), dt.datetime(year + 1, 1, 1))

    @staticmethod
    def calendar_years(first: int, last: int) -> Period:
        return Period(dt.datetime(first, 1, 1), dt.datetime(last + 1, 1, 1))


@dataclass(frozen=True)
class ReportingPeriods:
    """Several reports in one run: each row is labelled with the period that
    contains its timestamp.  Incident-level counts, situations, circumstances
    and ranks are then computed per label, exactly as separate single-period
    runs would, and the report carries ``REPORT_PERIOD``, for one period as for
    many.  Periods may overlap (months, half-years and the year): a row then
    belongs to each period that holds it.  An empty list and a repeated label
    raise ``ValueError``."""

    periods: tuple[tuple[str, Period], ...]
    labelled: bool = True

    def __post_init__(self) -> None:
        if not self.periods:
            raise ValueError("no reporting period is given")
        if len({name for name, _ in self.periods}) < len(self.periods):
            raise ValueError("reporting periods need different labels")

    @staticmethod
    def of(period: Period | ReportingPeriods) -> ReportingPeriods:
        if isinstance(period, ReportingPeriods):
            return period
        return ReportingPeriods(((period.start.strftime("%Y-%m-%d"), period),), labelled=False)

    @staticmethod
    def calendar_years(first: int, last: int) -> ReportingPeriods:
        return ReportingPeriods(tuple((str(y), Period.calendar_year(y)) for y in range(first, last + 1)))

    def covering(self) -> Period:
        return Period(min(p.start for _, p in self.periods), max(p.end for _, p in self.periods))

    def intervals(self) -> list[tuple[dt.datetime, list[str]]]:
        """The moments at which the set of holding periods changes, each with the labels from there on."""
        moments = sorted({t for _, p in self.periods for t in (p.start, p.end)})
        return [(t, [name for name, p in self.periods if p.start <= t < p.end]) for t in moments]


@dataclass(frozen=True)
class DistrictRange:
    lo: int = 1
    hi: int = 25


def _ts_literal(value: dt.datetime, dtype: T.DataType | None) -> Column:
    text = value.strftime("%Y-%m-%d %H:%M:%S")
    target = "timestamp" if isinstance(dtype, T.TimestampType) else "timestamp_ntz"
    # Cast from text, never from a Python datetime: the literal must not move
    # with the session or driver time zone.
    return F.lit(text).cast(target)


def in_period(col: Column, period: Period, dtype: T.DataType | None = None) -> Column:
    """G1: ``start <= col < end`` (closed period to the second, SURVEY T1)."""
    return (col >= _ts_literal(period.start, dtype)) & (col < _ts_literal(period.end, dtype))


def folder_columns(date: str) -> dict[str, Callable[[dt.datetime], int]]:
    """Partition columns that a layout may derive from a date column, with the folder of a moment: by year or by month (yyyymm)."""
    return {f"{date}_YEAR": lambda t: t.year, f"{date}_MONTH": lambda t: t.year * 100 + t.month}


def period_of(df: DataFrame, date: str, period: Period) -> Column:
    """``in_period`` on a column of ``df``, and on the partition columns derived
    from it that ``df`` has, so that the scan lists the period's folders only.

    The folders follow the date itself, never a stored YEAR, which may differ
    (T25).  A zoned timestamp may have been foldered under another session zone,
    so its period is two days wider there."""
    dtype = df.schema[date].dataType
    cond = in_period(F.col(date), period, dtype)
    slack = dt.timedelta(days=2 if isinstance(dtype, T.TimestampType) else 0)
    last = period.end - dt.timedelta(microseconds=1)
    for name, folder in folder_columns(date).items():
        if name in df.columns:
            cond = cond & F.col(name).between(folder(period.start - slack), folder(last + slack))
    return cond


def numeric_between(text: Column, lo: int, hi: int, strict: bool = False) -> Column:
    """Number held in a text column, inclusive range.

    Default: text that is not a number is not in range (``try_cast``).  With
    ``strict=True`` junk raises, as the source database's conversion does.
    """
    number = text.cast("decimal(38,10)") if strict else text.try_cast("decimal(38,10)")
    return number.between(F.lit(lo), F.lit(hi))


def prefix_in(col: Column, values: tuple[str, ...] | list[str]) -> Column:
    """First character in ``values`` (NULL text -> unknown -> row drops).

    Written as OR of ``startswith`` (same three-valued result as
    ``substr(col, 1, 1) IN (...)``), which Parquet accepts as a pushed filter."""
    return reduce(or_, [col.startswith(v) for v in values])


def prefix_not_in(col: Column, values: tuple[str, ...] | list[str]) -> Column:
    """First character not in ``values``; NULL stays unknown."""
    return ~prefix_in(col, values)


def like_any(cols: list[Column], patterns: list[str]) -> Column:
    """OR of ``col LIKE pattern`` over every column x pattern (case sensitive)."""
    return reduce(or_, [c.like(p) for c in cols for p in patterns])


def not_like_any(cols: list[Column], patterns: list[str]) -> Column:
    """G13 twin: OR of ``col NOT LIKE pattern`` -- true once any column is non-null
    and misses any one pattern (SURVEY T15)."""
    return reduce(or_, [~c.like(p) for c in cols for p in patterns])


def number_text(number: Column, width: int) -> Column:
    """A date part as zero-padded text.  Parts of a zone-free timestamp are
    taken from the value itself, so no session time zone moves them."""
    return F.lpad(number.cast("string"), width, "0")

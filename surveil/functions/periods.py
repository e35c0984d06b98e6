"""Calendar months, epidemiological weeks and influenza seasons.

Epidemiological weeks start on Sunday; week 1 is the first week with at least four days
in the year, so the year and week of a date are those of the Wednesday of its week.

Column functions work on data. ``ReportPeriod`` works on the one report date, which is
always an argument and never today's date.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveil.functions.nulls import ColumnOrName, as_col

SEASON_START_WEEK = 40


# ---- columns -------------------------------------------------------------------------

def _wednesday(d: ColumnOrName) -> Column:
    d = as_col(d)
    return F.date_add(d, F.lit(4) - F.dayofweek(d))


def mmwr_year(d: ColumnOrName) -> Column:
    return F.year(_wednesday(d))


def mmwr_week(d: ColumnOrName) -> Column:
    return F.ceil(F.dayofyear(_wednesday(d)) / 7).cast("int")


def mmwr_day(d: ColumnOrName) -> Column:
    return F.dayofweek(as_col(d))


def mmwr_to_date(year: ColumnOrName, week: ColumnOrName, day: ColumnOrName) -> Column:
    """Inverse of the three functions above. January 4 always lies in week 1."""
    jan4 = F.make_date(as_col(year), F.lit(1), F.lit(4))
    offset = (as_col(week) - 1) * 7 + as_col(day) - F.dayofweek(jan4)
    return F.date_add(jan4, offset.cast("int"))


def week_ending(d: ColumnOrName) -> Column:
    """Saturday of the week."""
    d = as_col(d)
    return F.date_add(d, F.lit(7) - F.dayofweek(d))


def season_year(d: ColumnOrName) -> Column:
    """Epidemiological year in which the influenza season of the date began."""
    return mmwr_year(d) - F.when(mmwr_week(d) >= SEASON_START_WEEK, 0).otherwise(1)


def previous_month_bounds(d: ColumnOrName) -> tuple[Column, Column]:
    """First and last day of the month before the date."""
    back = F.add_months(as_col(d), -1)
    return F.trunc(back, "MM"), F.last_day(back)


def lag_days(end: ColumnOrName, start: ColumnOrName) -> Column:
    return F.datediff(as_col(end), as_col(start))


def older_than(d: ColumnOrName, as_of: date, days: int) -> Column:
    """The date lies more than ``days`` days before the report date."""
    return as_col(d) < F.lit(as_of - timedelta(days=days))


def within(d: ColumnOrName, lo: date, hi: date) -> Column:
    """Inclusive date range. Plain literals, so the bounds reach the file scan."""
    return as_col(d).between(F.lit(lo), F.lit(hi))


def month_year_label(d: ColumnOrName) -> Column:
    """'March 2001'. Order by year and month, not by this text."""
    return F.date_format(as_col(d), "MMMM yyyy")


# ---- the report date -----------------------------------------------------------------

def epi_week(d: date) -> tuple[int, int, int]:
    """Epidemiological (year, week, day) of one date."""
    day = (d.weekday() + 1) % 7 + 1
    wed = d + timedelta(days=4 - day)
    return wed.year, (wed.timetuple().tm_yday - 1) // 7 + 1, day


def epi_date(year: int, week: int, day: int) -> date:
    jan4 = date(year, 1, 4)
    return jan4 + timedelta(days=(week - 1) * 7 + day - epi_week(jan4)[2])


@dataclass(frozen=True)
class Season:
    """One influenza season, both ends included."""

    label: str
    start: date
    end: date


@dataclass(frozen=True)
class ReportPeriod:
    as_of: date

    @property
    def previous_month(self) -> tuple[date, date]:
        end = self.as_of.replace(day=1) - timedelta(days=1)
        return end.replace(day=1), end

    @property
    def epi_week(self) -> tuple[int, int]:
        return epi_week(self.as_of)[:2]

    @property
    def previous_epi_week(self) -> tuple[int, int]:
        """(year, week) of the last completed week, on real dates: week 53 is honoured."""
        return epi_week(self.as_of - timedelta(days=7))[:2]

    @property
    def previous_week_end(self) -> date:
        return epi_date(*self.previous_epi_week, 7)

    @property
    def season_start_year(self) -> int:
        year, week = self.epi_week
        return year if week >= SEASON_START_WEEK else year - 1

    @property
    def season_start(self) -> date:
        return epi_date(self.season_start_year, SEASON_START_WEEK, 1)

    def season_windows(self, earlier: int = 5) -> list[Season]:
        """The earlier seasons, oldest first, then the current one up to last week."""
        first = self.season_start_year - earlier
        starts = [epi_date(first + i, SEASON_START_WEEK, 1) for i in range(earlier + 1)]
        ends = [s - timedelta(days=1) for s in starts[1:]] + [self.previous_week_end]
        return [
            Season(f"{s.year}-{(s.year + 1) % 100:02d}", s, e) for s, e in zip(starts, ends)
        ]

    def extract_month(self) -> tuple[int, int]:
        """(year, month) of the history extract: December before, while in week 1."""
        year, week = self.epi_week
        return (year - 1, 12) if week == 1 else (self.as_of.year, self.as_of.month)

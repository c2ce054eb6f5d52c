"""Date parsing, calendar parts and period labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_PI = 6.283185307179586


def parse_dmy(c: Column) -> Column:
    """'31.12.2024' -> date; null when it does not parse."""
    return F.try_to_timestamp(c, F.lit("dd.MM.yyyy")).cast("date")


def parse_parts(year: Column, month: Column, day: Column) -> Column:
    """Year, month, day integers -> date."""
    return F.make_date(year, month, day)


def parse_mon_yy(c: Column) -> Column:
    """'jan-17', any case -> first day of that month; years 69-99 belong to the 1900s."""
    parsed = F.try_to_timestamp(F.initcap(F.lower(c)), F.lit("MMM-yy")).cast("date")
    return F.when(F.year(parsed) > 2068, F.add_months(parsed, -1200)).otherwise(parsed)


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def month_key(d: Column) -> Column:
    """Date -> 'yyyy-MM'."""
    return F.date_format(d, "yyyy-MM")


def week_ending_sunday(d: Column) -> Column:
    """The Sunday on or after the date."""
    return F.date_add(F.date_trunc("week", d).cast("date"), 6)


def week_ending_monday(d: Column) -> Column:
    """The Monday on or after the date."""
    return F.date_add(F.date_trunc("week", F.date_sub(d, 1)).cast("date"), 7)


def week_from_tuesday(d: Column) -> Column:
    """The Tuesday on or before the date (start of a week that ends on Monday)."""
    return F.date_sub(week_ending_monday(d), 6)


def month_end(d: Column) -> Column:
    return F.last_day(d)


def parts(d: Column, base_year: int = 2022) -> dict[str, Column]:
    """Plain calendar parts; the weekday counts from Monday = 0."""
    return {
        "Month": F.month(d),
        "Quarter": F.quarter(d),
        "WeekOfYear": F.weekofyear(d),
        "DayOfWeek": F.weekday(d),
        "DayOfMonth": F.dayofmonth(d),
        "DayOfYear": F.dayofyear(d),
        "Year": F.year(d) - F.lit(base_year),
    }


def _wave(name: str, value: Column, period: float) -> dict[str, Column]:
    angle = F.lit(TWO_PI) * value / F.lit(float(period))
    return {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}


def cyclic(d: Column, year_length: float = 365.0) -> dict[str, Column]:
    """Sine and cosine of month, quarter, ISO week, weekday and day of year."""
    return {
        **_wave("Month", F.month(d), 12),
        **_wave("Quarter", F.quarter(d), 4),
        **_wave("Week", F.weekofyear(d), 52),
        **_wave("Day", F.weekday(d), 7),
        **_wave("DayOfYear", F.dayofyear(d), year_length),
    }


def flags(d: Column) -> dict[str, Column]:
    """Weekend and start/end of month, quarter and year as 0/1."""
    quarter_end = F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    year_end = F.last_day(F.add_months(F.trunc(d, "year"), 11))
    tests = {
        "IsWeekend": F.weekday(d) >= 5,
        "IsMonthStart": d == F.trunc(d, "month"),
        "IsMonthEnd": d == F.last_day(d),
        "IsQuarterStart": d == F.trunc(d, "quarter"),
        "IsQuarterEnd": d == quarter_end,
        "IsYearStart": d == F.trunc(d, "year"),
        "IsYearEnd": d == year_end,
    }
    return {name: test.cast("int") for name, test in tests.items()}


def month_flags(d: Column) -> dict[str, Column]:
    """The quarter and year flags of a first-of-month label, as monthly features use them."""
    wanted = ("IsQuarterStart", "IsQuarterEnd", "IsYearStart", "IsYearEnd")
    return {n: c for n, c in flags(d).items() if n in wanted}


def misc(d: Column) -> dict[str, Column]:
    """Week of the month and fraction of the year."""
    return {
        "WeekOfMonth": F.ceil(F.dayofmonth(d) / F.lit(7.0)).cast("int"),
        "YearFraction": F.dayofyear(d) / F.lit(365.25),
    }

"""Calendar expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.rules import yes_no


def date_key(day: Column) -> Column:
    """Date as a yyyymmdd integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def calendar_attributes(day: Column) -> dict[str, Column]:
    """Columns of the date dimension for one day.  Sunday is day 1 of the week."""
    month_end = day == F.last_day(day)
    return {
        "date_key": date_key(day),
        "business_date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": F.dayofweek(day),
        "day_name": F.date_format(day, "EEEE"),
        "week_of_year": F.weekofyear(day),
        "is_weekend": yes_no(F.dayofweek(day).isin(1, 7)),
        "is_month_end": yes_no(month_end),
        "is_quarter_end": yes_no(month_end & (F.month(day) % 3 == 0)),
        "is_year_end": yes_no(month_end & (F.month(day) == 12)),
        "fiscal_year": F.year(day),
        "fiscal_quarter": F.quarter(day),
    }


def reporting_calendar(bounds: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Snapshot days between `start` and `end` of each row of `bounds`: the start
    itself, then the first of every following month."""
    first, last = F.col(start), F.col(end)
    second = F.trunc(F.add_months(first, 1), "MM")
    later = F.when(second <= last, F.sequence(second, last, F.expr("interval 1 month")))
    days = F.concat(F.array(first), F.coalesce(later, F.array().cast("array<date>")))
    return bounds.filter(first <= last).select(F.explode(days).alias("business_date"))

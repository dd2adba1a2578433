"""Month arithmetic. Months are carried as DATEs of their first day; text forms are for display."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_year(day: Column, year: int) -> Column:
    """Half-open range rather than ``year(day) = n``: the range reaches the file scan and
    prunes files and partitions, the function call does not."""
    return (day >= F.lit(date(year, 1, 1))) & (day < F.lit(date(year + 1, 1, 1)))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_before(day: Column) -> Column:
    """First day of the month before the month of ``day``."""
    return F.trunc(F.add_months(day, -1), "MM")


def months_of(year: int) -> Column:
    """Array of the twelve month starts."""
    return F.sequence(
        F.lit(date(year, 1, 1)), F.lit(date(year, 12, 1)), F.expr("interval 1 month")
    )


def month_key(day: Column) -> Column:
    """Text such as '2001-08'."""
    return F.date_format(day, "yyyy-MM")


def month_from_key(key: Column) -> Column:
    """'2001-08' -> first day of that month."""
    return F.to_date(F.concat(key, F.lit("-01")))


def month_from_parts(key: Column) -> Column:
    """Like ``month_from_key`` for any text that starts with the year and ends with the month."""
    return F.make_date(F.left(key, F.lit(4)).cast("int"), F.right(key, F.lit(2)).cast("int"), F.lit(1))


def month_label(day: Column, labels: tuple[str, ...]) -> Column:
    """Configured short name of the month of ``day``; independent of any session language."""
    return F.element_at(F.array(*[F.lit(name) for name in labels]), F.month(day))


def day_text(day: Column) -> Column:
    return F.date_format(day, "dd/MM/yyyy")

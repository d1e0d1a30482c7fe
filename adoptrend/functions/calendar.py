"""Month labels (``YYYY-MM``) and the arithmetic on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def year_label(ts: Column) -> Column:
    return F.year(ts).cast("string")


def month_number(ts: Column) -> Column:
    """Month as one whole number, 202406 for June 2024: the folder key of a month-partitioned log."""
    return F.year(ts) * 100 + F.month(ts)


def month_ordinal(label: Column) -> Column:
    """Months since year 0, so that differences count calendar months."""
    return F.substring(label, 1, 4).cast("int") * 12 + F.substring(label, 6, 2).cast("int") - 1


def ordinal_label(ordinal: Column) -> Column:
    year = F.floor(ordinal / 12).cast("string")
    month = F.lpad((ordinal % 12 + 1).cast("string"), 2, "0")
    return F.concat(year, F.lit("-"), month)


def parse_month(text: Column) -> Column:
    """Month of an ISO timestamp text; NULL when it is missing or malformed."""
    return month_label(F.try_to_timestamp(text))

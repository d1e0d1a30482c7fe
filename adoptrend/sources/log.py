"""The raw event log, one folder per month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adoptrend.functions.calendar import month_number
from adoptrend.sources import sinks

MONTH = "month"


def write_events(events: DataFrame, path: str, ts: str) -> None:
    """Overwrite ``path`` with the events, a folder ``month=YYYYMM`` for each month of ``ts``.

    A month that holds much of the log is still written by several tasks.
    """
    sinks.write_partitioned(events.withColumn(MONTH, month_number(F.col(ts))), path, MONTH)


def load_events(spark: SparkSession, path: str, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """Events of the months ``lo`` to ``hi`` (``YYYYMM`` or ``YYYY-MM``), both included; None is open.

    Only the folders of those months are listed and read, whatever the rest of the log holds.
    Events without a time are in no month and only read when both ends are open.
    """
    events = spark.read.parquet(path)
    if lo is not None:
        events = events.where(F.col(MONTH) >= int(lo.replace("-", "")))
    if hi is not None:
        events = events.where(F.col(MONTH) <= int(hi.replace("-", "")))
    return events.drop(MONTH)

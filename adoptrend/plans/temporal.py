"""Joins by time: labels in force, and work at the same time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.operators import temporal
from adoptrend.plans.registry import query
from adoptrend.sources.inputs import Inputs

SHIPPED = """shipped AS (SELECT o_custkey, l_orderkey, l_linenumber, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
             history AS (SELECT o_custkey, o_orderdate, max(o_orderpriority) AS label FROM orders
                         WHERE o_orderstatus <> 'P' GROUP BY 1, 2)"""


@query(
    "asof_labels",
    f"""WITH {SHIPPED}, found AS (
          SELECT l_orderkey, l_linenumber, s.o_custkey, h.label, h.o_orderdate, l_shipdate
          FROM shipped s ASOF LEFT JOIN history h ON s.o_custkey = h.o_custkey AND s.l_shipdate >= h.o_orderdate)
        SELECT l_orderkey, l_linenumber, o_custkey,
               CASE WHEN l_shipdate <= o_orderdate + INTERVAL 60 DAY THEN label END AS label,
               CASE WHEN l_shipdate <= o_orderdate + INTERVAL 60 DAY THEN strftime(o_orderdate, '%Y-%m-%d') END AS label_since
        FROM found""",
)
def asof_labels(t: Inputs) -> DataFrame:
    """Every shipped line with the label its customer had then: that of the latest order of the last 60 days."""
    orders = t.table("orders")
    lines = t.table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp").alias("l_shipdate"))
    shipped = lines.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    history = orders.where("o_orderstatus <> 'P'").select(
        "o_custkey", F.col("o_orderdate").cast("timestamp").alias("since"), F.col("o_orderpriority").alias("label")
    )
    found = temporal.asof_join(
        shipped, history, ["o_custkey"], "l_shipdate", "since", ["label"], "label_since", within=F.expr("INTERVAL 60 DAYS")
    )
    return found.select(
        "l_orderkey", "l_linenumber", "o_custkey", "label", F.date_format("label_since", "yyyy-MM-dd").alias("label_since")
    )


@query(
    "overlapping_work",
    """WITH spans AS (
         SELECT o_custkey, lower(p_brand) AS owner, CAST(min(least(o_orderdate, l_shipdate)) AS DATE) - DATE '1970-01-01' AS first_day,
                CAST(max(greatest(o_orderdate, l_shipdate)) AS DATE) - DATE '1970-01-01' AS last_day
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
         GROUP BY 1, 2, o_orderkey)
       SELECT a.owner AS owner, b.owner AS other, count(*) AS n,
              CAST(sum(least(a.last_day, b.last_day) - greatest(a.first_day, b.first_day) + 1) AS BIGINT) AS days
       FROM spans a JOIN spans b ON a.o_custkey = b.o_custkey AND a.first_day <= b.last_day AND b.first_day <= a.last_day
        AND a.owner < b.owner GROUP BY 1, 2""",
)
def overlapping_work(t: Inputs) -> DataFrame:
    """Pairs of owners that one developer worked for at the same time, and on how many days."""
    day = lambda c: F.unix_date(F.col(c).cast("date")).cast("long")
    lines = t.table("lineitem").select("l_orderkey", "l_partkey", day("l_shipdate").alias("shipped"))
    orders = t.table("orders").select("o_orderkey", "o_custkey", day("o_orderdate").alias("ordered"))
    parts = t.table("part").select("p_partkey", F.lower("p_brand").alias("owner"))
    spans = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("o_custkey", "owner", "o_orderkey")
        .agg(F.min(F.least("ordered", "shipped")).alias("first_day"), F.max(F.greatest("ordered", "shipped")).alias("last_day"))
        .select("o_custkey", "owner", "first_day", "last_day")
    )
    period = ("first_day", "last_day")
    pairs = temporal.overlap_join(spans, spans, ["o_custkey"], period, period, width=16).where("l.owner < r.owner")
    shared = F.least("l.last_day", "r.last_day") - F.greatest("l.first_day", "r.first_day") + 1
    return pairs.groupBy(F.col("l.owner").alias("owner"), F.col("r.owner").alias("other")).agg(
        F.count("*").alias("n"), F.sum(shared).alias("days")
    )

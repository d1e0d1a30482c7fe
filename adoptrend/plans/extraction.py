"""Scans, ingest and mining."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.functions.calendar import month_label
from adoptrend.operators import clean, extract, migration
from adoptrend.plans.registry import query
from adoptrend.session import scratch_path
from adoptrend.sources import log, sinks
from adoptrend.sources.inputs import CUTOFF, EXCLUDE, MESSAGE_STEMS, MESSAGE_SWAPS, Inputs, with_views

LINE = ["l_orderkey", "l_partkey", "l_linenumber", "year_month"]
LINE_SQL = "l_orderkey, l_partkey, l_linenumber, strftime(l_shipdate, '%Y-%m') AS year_month"


def _line(df: DataFrame) -> DataFrame:
    return df.withColumn("year_month", month_label(F.col("l_shipdate"))).select(*LINE)


@query(
    "scan_event_range",
    f"SELECT {LINE_SQL} FROM lineitem WHERE strftime(l_shipdate, '%Y%m') BETWEEN '199706' AND '199805'",
)
def scan_event_range(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "log")
    log.write_events(t.table("lineitem"), path, "l_shipdate")
    return _line(log.load_events(t.spark, path, "199706", "199805"))


@query(
    "scan_event_range_statistics",
    f"SELECT {LINE_SQL} FROM lineitem WHERE strftime(l_shipdate, '%Y%m') BETWEEN '199706' AND '199805'",
)
def scan_event_range_statistics(t: Inputs) -> DataFrame:
    return _line(extract.scan_months(t.table("lineitem"), "l_shipdate", "199706", "199805"))


@query(
    "scan_calendar_sample",
    f"SELECT {LINE_SQL} FROM lineitem WHERE month(l_shipdate) IN (4, 8, 12) AND year(l_shipdate) BETWEEN 1996 AND 2001",
)
def scan_calendar_sample(t: Inputs) -> DataFrame:
    return _line(extract.sample_months(t.table("lineitem"), "l_shipdate", years=range(1996, 2002)))


@query(
    "scan_complete_months",
    f"SELECT {LINE_SQL} FROM lineitem WHERE l_shipdate < date_trunc('month', DATE '2000-09-17')",
)
def scan_complete_months(t: Inputs) -> DataFrame:
    return _line(extract.scan_complete_months(t.table("lineitem"), "l_shipdate", date(2000, 9, 17)))


@query(
    "scan_hash_sample",
    with_views(
        "developer_repos",
        body="SELECT * FROM developer_repos WHERE substr(sha256(repo_name), 1, 4) < '4000'",
    ),
)
def scan_hash_sample(t: Inputs) -> DataFrame:
    # the sample of the short key table decides, before anything of the log is joined or counted
    return t.developer_repos_of(extract.sample_hash(t.repos, "repo_name", 0.25))


@query(
    "flatten_nested",
    """SELECT repo_name, name, size FROM (
         SELECT 'part-' || p_partkey AS repo_name, word AS name, CAST(length(word) * (p_size - 1) AS BIGINT) AS size
         FROM (SELECT p_partkey, p_size, unnest(string_split(p_name, ' ')) AS word FROM part))
       WHERE name <> '' AND size > 0""",
)
def flatten_nested(t: Inputs) -> DataFrame:
    size = lambda w: (F.length(w) * (F.col("p_size") - 1)).cast("long")
    nested = t.table("part").select(
        F.concat(F.lit("part-"), F.col("p_partkey")).alias("repo_name"),
        F.transform(F.split("p_name", " "), lambda w: F.struct(w.alias("name"), size(w).alias("size"))).alias("language"),
    )
    return extract.flatten_nested(nested, "language", ["name", "size"])


@query(
    "ingest_labels",
    with_views(
        "languages_flat",
        body=f"""SELECT repo_name, lower(trim(language)) AS language, CAST(0 AS BIGINT) AS bytes, created_at
                 FROM languages_flat WHERE lower(trim(language)) NOT IN ({", ".join(f"'{x}'" for x in EXCLUDE)})""",
    ),
)
def ingest_labels(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "labels")
    sinks.write_table(extract.ingest_labels(t.languages_flat, EXCLUDE), path, rows_per_file=50_000)
    return sinks.read_table(t.spark, path)


@query(
    "ingest_audit",
    with_views(
        "languages_flat",
        body=f"""SELECT count(*) AS seen, count(*) FILTER (keep) AS kept, count(*) - count(*) FILTER (keep) AS skipped,
                        round(100.0 * count(*) FILTER (keep) / count(*), 6) AS kept_pct,
                        round(100.0 * (count(*) - count(*) FILTER (keep)) / count(*), 6) AS skipped_pct
                 FROM (SELECT coalesce(lower(trim(language)) NOT IN ({", ".join(f"'{x}'" for x in EXCLUDE)}), false) AS keep
                       FROM languages_flat)""",
    ),
)
def ingest_audit(t: Inputs) -> DataFrame:
    return extract.ingest_audit(t.languages_flat, EXCLUDE)


@query("clean_labels", with_views("labels", body="SELECT * FROM labels"))
def clean_labels(t: Inputs) -> DataFrame:
    return t.labels


@query("activity_clean", with_views("activity", body="SELECT * FROM activity"))
def activity_clean(t: Inputs) -> DataFrame:
    return t.activity


@query(
    "monthly_activity",
    """SELECT l_partkey, strftime(l_shipdate, '%Y-%m') AS year_month, count(*) AS commit_count
       FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2""",
)
def monthly_activity(t: Inputs) -> DataFrame:
    return extract.monthly_activity(t.table("lineitem"), "l_partkey", "l_shipdate", ("l_returnflag", "N"))


ACTORS = """SELECT lower(c_mktsegment) || '-' || c_custkey AS actor, lower(p_brand) || '/part-' || p_partkey AS repo_name,
                   CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS commit_count
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
                 JOIN part ON l_partkey = p_partkey
            WHERE NOT regexp_matches(lower(c_mktsegment) || '-' || c_custkey, 'household|build')
            GROUP BY 1, 2, 3"""


@query("actor_edges_no_bots", ACTORS)
def actor_edges_no_bots(t: Inputs) -> DataFrame:
    named = t.table("customer").select(
        "c_custkey", F.concat_ws("-", "c_mktsegment", "c_custkey").alias("actor_login")
    )
    pushed = t.pushes.join(named, F.col("o_custkey") == F.col("c_custkey"))
    return extract.actor_edges(pushed, "actor_login", "repo_name", "created_at", "household|build")


@query("json_unnest", with_views("messages", body="SELECT * FROM messages"))
def json_unnest(t: Inputs) -> DataFrame:
    return t.messages


@query(
    "json_scalar",
    """SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n
       FROM events GROUP BY 1, 2""",
)
def json_scalar(t: Inputs) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    return t.table("events").groupBy("event_type", k.alias("k")).agg(F.count("*").alias("n"))


def _pairs_sql() -> str:
    patterns = extract.pair_patterns(MESSAGE_STEMS, MESSAGE_SWAPS)
    get = lambda name: f"nullif(regexp_extract(lower(message), '{patterns[name]}', 1), '')"
    tidy = lambda text: f"nullif(rtrim({text}, '.-'), '')"
    told = "|".join([*MESSAGE_STEMS, *MESSAGE_SWAPS])
    return f"""SELECT from_tech, to_tech, year, count(*) AS migration_count FROM (
                 SELECT {tidy(f"coalesce({get('from_verb')}, {get('from_swap')})")} AS from_tech,
                        {tidy(f"coalesce({get('to_verb')}, {get('to_direct')})")} AS to_tech, lang AS year
                 FROM messages WHERE regexp_matches(lower(message), '{told}'))
               WHERE from_tech <> to_tech AND length(from_tech) BETWEEN 2 AND 30 AND length(to_tech) BETWEEN 2 AND 30
               GROUP BY 1, 2, 3 HAVING count(*) >= 2"""


@query("mine_pairs", with_views("messages", body=_pairs_sql()))
def mine_pairs(t: Inputs) -> DataFrame:
    return extract.mine_pairs(t.messages, "message", "lang", MESSAGE_STEMS, MESSAGE_SWAPS)


@query(
    "join_diagnostics",
    with_views(
        "labels",
        "activity",
        body="""SELECT (SELECT count(*) FROM (SELECT repo_name FROM labels EXCEPT SELECT repo_name FROM activity))
                         AS only_in_labels,
                       (SELECT count(*) FROM (SELECT repo_name FROM activity EXCEPT SELECT repo_name FROM labels))
                         AS only_in_activity,
                       (SELECT count(*) FROM (SELECT repo_name FROM activity INTERSECT SELECT repo_name FROM labels))
                         AS in_both""",
    ),
)
def join_diagnostics(t: Inputs) -> DataFrame:
    return clean.join_diagnostics(t.labels, t.activity)


@query("enriched_activity", with_views("enriched", body="SELECT * FROM enriched"))
def enriched_activity(t: Inputs) -> DataFrame:
    return t.enriched


@query("roundtrip_partitioned", with_views("enriched", body="SELECT * FROM enriched"))
def roundtrip_partitioned(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "enriched")
    sinks.write_partitioned(t.enriched, path, "language")
    return sinks.read_table(t.spark, path, t.enriched)


@query(
    "edges_allowlisted",
    with_views(
        "migration_signals",
        body="""SELECT * FROM migration_signals
                WHERE from_tech IN (SELECT lower(p_brand) FROM part GROUP BY 1 HAVING avg(p_size) > 25)
                  AND to_tech IN (SELECT lower(p_brand) FROM part GROUP BY 1 HAVING avg(p_size) > 25)
                  AND from_tech <> to_tech""",
    ),
)
def edges_allowlisted(t: Inputs) -> DataFrame:
    known = t.table("part").groupBy(F.lower("p_brand").alias("tech")).agg(F.avg("p_size").alias("s")).where("s > 25")
    return migration.allowlisted(t.migration_signals, allow=known).select("from_tech", "to_tech", "year", "migration_count")

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from adoptrend.functions.fixed import BOT_PATTERN, EXCLUDED_LABELS, TECHNOLOGIES
from adoptrend.operators import actors, clean, extract, migration

LABELS = [
    ("a/x", " Python ", 3, "2020-03-05T10:00:00Z"),
    ("a/x", "python", 2, "2020-03-05T10:00:00Z"),
    ("a/y", "go", 1, None),
    ("a/z", "rust", 1, "not a date"),
    ("a/m", "Markdown", 1, "2019-01-01"),
    ("a/e", "", 1, None),
    ("a/e", None, 1, None),
    ("a/q", "java", 1, "2019-01-01"),
]


@pytest.fixture
def labels(spark):
    return spark.createDataFrame(LABELS, "repo_name string, language string, bytes long, created_at string")


@pytest.fixture
def activity(spark):
    rows = [
        ("a/x", "2020-02", 5), ("a/x", "2020-03", 6), ("a/y", "2011-01", 1), ("a/z", "2012-01", 1),
        ("a/r", "2020-01", 1), ("a/y", None, 1), ("a/y", "2012-01", 0), ("a/y", "2025-07", 9), ("a/m", "2020-01", 2),
    ]
    return spark.createDataFrame(rows, "repo_name string, year_month string, commit_count long")


def test_labels_and_activity(labels, activity, rows):
    cleaned = clean.clean_labels(labels)
    assert {r.language for r in cleaned.collect()} == {"python", "go", "rust", "java"}
    enriched = clean.enrich(cleaned, clean.clean_activity(activity))
    assert rows(enriched) == [
        ("a/x", "python", 3, "2020-03", 6),
        ("a/y", "go", 1, "2011-01", 1),
        ("a/z", "rust", 1, "2012-01", 1),
    ]


def test_join_diagnostics(labels, activity):
    found = clean.join_diagnostics(clean.clean_labels(labels), clean.clean_activity(activity)).first()
    assert (found.only_in_labels, found.only_in_activity, found.in_both) == (1, 2, 3)


def test_ingest(labels, rows):
    audit = extract.ingest_audit(labels).first()
    assert (audit.seen, audit.kept, audit.skipped) == (8, 5, 3)
    kept = extract.ingest_labels(labels)
    assert kept.count() == 5 and {r.bytes for r in kept.collect()} == {0}


def test_fixed_lists():
    assert len(EXCLUDED_LABELS) == 18 and len(set(TECHNOLOGIES)) == 80


MESSAGES = [
    # message, passes the strict filters, strict (from, to), default (from, to)
    ("Migrating from Flask to FastAPI", False, ("flask", "fastapi"), ("flask", "fastapi")),
    ("Switch to jest from mocha", True, ("mocha", "jest"), ("mocha", "jest")),
    ("Replace webpack with vite", False, ("webpack", "vite"), ("webpack", "vite")),
    ("swap npm with yarn", False, ("npm", None), ("npm", "yarn")),
    ("Move from travis to circleci", False, ("travis", "circleci"), ("travis", "circleci")),
    ("rewrite from python to rust", True, ("python", "rust"), ("python", "rust")),
    ("Upgraded deps", False, (None, None), (None, None)),
    ("switch from go to go", False, ("go", "go"), ("go", "go")),
    ("Drop support. Moved to pnpm", True, (None, "pnpm"), (None, "pnpm")),
    ("Remove yarn from CI, switch to npm", True, ("ci", "npm"), ("ci", "npm")),
    ("migrate from c to rust", False, (None, "rust"), (None, "rust")),
    ("Replaced MySQL with PostgreSQL.", False, ("mysql", "postgresql."), ("mysql", "postgresql")),
]


def test_parse_pairs(spark):
    df = spark.createDataFrame([(i, m[0]) for i, m in enumerate(MESSAGES)], "i int, message string")
    found = {r.i: (r.from_tech, r.to_tech) for r in extract.parse_pairs(df, "message").collect()}
    for i, (text, _, _, expected) in enumerate(MESSAGES):
        assert found.get(i, (None, None)) == expected, text
    strict = {r.i: (r.from_tech, r.to_tech) for r in extract.parse_pairs(df, "message", strict=True).collect()}
    assert set(strict) == {i for i, m in enumerate(MESSAGES) if m[1]}
    for i, pair in strict.items():
        assert pair == MESSAGES[i][2], MESSAGES[i][0]


def test_mined_pairs_and_allowlist(spark, rows):
    df = spark.createDataFrame([(m[0], "2020") for m in MESSAGES], "message string, year string")
    pairs = extract.mine_pairs(df, "message", "year", min_count=1)
    assert ("go", "go") not in {(r.from_tech, r.to_tech) for r in pairs.collect()}
    known = {(r.from_tech, r.to_tech) for r in migration.allowlisted(pairs).collect()}
    assert ("ci", "npm") not in known and ("mysql", "postgresql") in known
    merged = migration.allowlisted(pairs, synonyms={"postgresql": "postgres"})
    assert ("mysql", "postgres") in {(r.from_tech, r.to_tech) for r in merged.collect()}
    as_table = spark.createDataFrame([(t,) for t in TECHNOLOGIES], "tech string")
    assert {(r.from_tech, r.to_tech) for r in migration.allowlisted(pairs, allow=as_table).collect()} == known


def test_boundaries_are_ascii(spark):
    df = spark.createDataFrame([("switch été from éric to rust",), ("switch éfrom java to rust",)], "m string")
    got = [(r.from_tech, r.to_tech) for r in extract.parse_pairs(df, "m").collect()]
    assert got == [(None, "rust"), ("java", "rust")]


def test_json_unnest(spark, rows):
    payload = json.dumps({"commits": [{"message": "a"}, {"message": "b\nc"}, {}]})
    df = spark.createDataFrame([(1, payload), (2, "{}"), (3, "broken")], "id int, payload string")
    assert rows(extract.json_unnest(df, "payload", "commits", "message")) == [(1, 0, "a"), (1, 1, "b\nc"), (1, 2, None)]


def test_scans(spark):
    stamps = [datetime(2020, 3, 31, 23, 59), datetime(2020, 4, 1), datetime(2020, 6, 30, 23), datetime(2020, 7, 1)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "i int, ts timestamp_ntz")
    assert [r.i for r in extract.scan_months(df, "ts", "202004", "202006").collect()] == [1, 2]
    assert [r.i for r in extract.scan_complete_months(df, "ts", date(2020, 6, 30)).collect()] == [0, 1]
    assert [r.i for r in extract.sample_months(df, "ts").collect()] == [1]
    assert [r.i for r in extract.sample_months(df, "ts", (4, 6), years=(2019, 2020)).collect()] == [1, 2]
    assert [r.i for r in extract.scan_months(df, "ts", None, "2020-03").collect()] == [0]
    assert extract.scan_months(df, "ts", "202012", "202012").count() == 0


def test_hash_sample_keeps_whole_keys(spark):
    df = spark.range(4000).select((F.col("id") % 500).alias("k"))
    part = extract.sample_hash(df, "k", 0.5)
    kept = part.groupBy("k").count().collect()
    assert {r["count"] for r in kept} == {8} and 180 < len(kept) < 320
    assert extract.sample_hash(df, "k", 1.0).count() == 4000
    assert extract.sample_hash(df, "k", 0.0).count() == 0
    many = spark.range(400_000)
    assert 1 <= extract.sample_hash(many, "id", 1e-5).count() <= 20
    assert extract.sample_hash(many, "id", 0.5).intersect(extract.sample_hash(many, "id", 0.6)).count() == extract.sample_hash(many, "id", 0.5).count()


def test_every_pattern_runs_once(spark):
    df = spark.createDataFrame([(m[0], "2020") for m in MESSAGES], "message string, year string")
    for strict in (False, True):
        plan = extract.mine_pairs(df, "message", "year", strict=strict)._jdf.queryExecution().optimizedPlan().toString()
        assert 1 <= plan.count("regexp_extract(") <= 4


def test_flatten(spark, rows):
    df = spark.createDataFrame(
        [("r", [("go", 3), ("", 2), (None, 2), ("c", 0)])], "repo string, language array<struct<name:string,bytes:long>>"
    )
    assert rows(extract.flatten_nested(df, "language", ["name", "bytes"])) == [("r", "go", 3)]


def test_actor_edges(spark, rows):
    data = [
        ("Ann", "o/a", datetime(2020, 1, 1)), ("ann", "o/a", datetime(2020, 5, 1)), ("ann", "o/a", datetime(2021, 5, 1)),
        ("dependabot[bot]", "o/a", datetime(2020, 1, 1)), ("Abbott", "o/a", datetime(2020, 1, 1)), (None, "o/a", datetime(2020, 1, 1)),
    ]
    df = spark.createDataFrame(data, "login string, repo string, ts timestamp_ntz")
    assert BOT_PATTERN.startswith("bot")
    assert rows(extract.actor_edges(df, "login", "repo", "ts")) == [("ann", "o/a", "2020", 2), ("ann", "o/a", "2021", 1)]


def test_pseudonyms(spark):
    data = [(" Ann ", "o/a", "2020", 1), ("ann", "o/b", "2020", 1), ("ann", "o/c", "2026", 1), ("", "o/c", "2020", 1)]
    df = spark.createDataFrame(data, "developer_email string, repo_name string, year string, commit_count long")
    edges = actors.clean_actor_edges(df)
    assert "developer_email" not in edges.columns
    found = edges.collect()
    assert len(found) == 2 and len({r.dev_id for r in found}) == 1 and len(found[0].dev_id) == 64
    assert all("ann" not in str(v).lower() for r in found for v in r)
    assert actors.clean_actor_edges(df, salt="s").first().dev_id != found[0].dev_id

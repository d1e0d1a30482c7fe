"""Exact duplicates by chunk recipes.

A text is cut where its own content says so. Every distinct chunk gets an identifier, and a text
becomes the ordered list of its identifiers, its recipe: texts are equal when their recipes are.
To verify an identifier, the SHA-256 of its chunk moves once for each partition that holds it; apart
from that only recipes move, however long the documents are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adoptrend.llm.base import whole
from adoptrend.session import cut

# A chunk ends with the first white space behind 128 characters that a word follows whose first four
# letters or digits are of the first half; about one word in thirty does. So chunks fall back into
# step soon after texts differ. Where no such place comes, it has 8,192 characters.
CHUNK = r"(?s).{128,8191}?\s(?=[A-Ma-m0-4]{4})|.{1,8192}"


def chunks(text: Column) -> Column:
    """The chunks of a text in order; their concatenation is the text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def _collided(pieces: DataFrame) -> DataFrame:
    """Codes that stand for more than one chunk, by the SHA-256 of every distinct chunk."""
    contents = pieces.groupBy("code", "digest").agg(F.count("*").alias("uses"))
    return contents.groupBy("code").agg(F.count("*").alias("contents")).where("contents > 1").select("code")


def recipes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", code=F.xxhash64) -> DataFrame:
    """``(row, doc_id, text_sha256, recipe)``, one row per document, written to the shared folder.

    ``recipe`` is an array of (code, version). The code is a hash of the chunk; where two chunks
    share a code, which the comparison of all distinct chunks finds, the version tells them apart.
    """
    body = whole(text)
    parts = docs.select(F.col(doc_id).alias("doc_id"), F.sha2(body, 256).alias("text_sha256"), chunks(body).alias("chunks"))
    listed = cut(
        parts.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "text_sha256",
            F.transform("chunks", lambda c: F.struct(code(c).alias("code"), F.lit(0).alias("version"))).alias("recipe"),
        )
    )
    pieces = parts.select(F.explode("chunks").alias("chunk")).select(
        code("chunk").alias("code"), F.unhex(F.sha2("chunk", 256)).alias("digest")
    )
    shared = cut(_collided(pieces))
    if shared.isEmpty():
        return listed
    found = parts.select("text_sha256", F.posexplode("chunks").alias("place", "chunk")).withColumn("code", code("chunk"))
    told_apart = (
        found.join(shared, "code", "left_semi")
        .groupBy("code", "chunk")
        .agg(F.count("*").alias("uses"))
        .selectExpr("code AS c", "chunk AS t", "row_number() OVER (PARTITION BY code ORDER BY chunk) AS version")
    )
    versions = (
        found.join(told_apart, F.col("code").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("t")))
        .groupBy("text_sha256")
        .agg(F.map_from_entries(F.collect_set(F.struct("place", "version"))).alias("versions"))
    )
    resolved = F.transform(
        "recipe",
        lambda x, i: F.struct(x["code"].alias("code"), F.coalesce(F.col("versions")[i], F.lit(0)).alias("version")),
    )
    return cut(
        listed.join(versions, "text_sha256", "left").select("row", "doc_id", "text_sha256", resolved.alias("recipe"))
    )


def duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", code=F.xxhash64) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per input row.

    Of equal texts the one with the largest id stays; an absent text equals the empty one. Of rows
    repeated with the same id one stays. An absent id is smaller than any other, so such a row stays
    only where no row of its group has an id; ``keep_id`` is absent then. No rows give no rows;
    other columns are not looked at.

    Groups are counted before anything is shuffled, and a group of any size meets its one result
    row in a join whose large partitions can be split.
    """
    listed = recipes(docs, text, doc_id, code)
    # written, so that the join below shuffles both sides itself and a large group's rows can be split
    groups = cut(
        listed.groupBy(F.col("recipe").alias("of"))
        .agg(
            F.count("*").alias("n"),
            F.max("doc_id").alias("top"),
            F.coalesce(F.max_by("row", "doc_id"), F.max("row")).alias("stays"),
        )
        .where("n > 1")
    )
    return listed.join(groups, F.col("recipe") == F.col("of"), "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("top")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("row") == F.col("stays"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that stay, with all their columns and whatever those are called."""
    groups = cut(
        duplicates(docs, text, doc_id)
        .groupBy(F.col("doc_id").alias("of"), F.col("text_sha256").alias("sha"))
        .agg(F.count("*").alias("n"), F.max("kept").alias("kept"))
        .where("n > 1 OR NOT kept")
    )
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    keyed = row.withColumn("id", F.col(f"doc.`{doc_id}`")).withColumn(
        "digest", F.sha2(F.coalesce(F.col(f"doc.`{text}`"), F.lit("")), 256)
    )
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("sha"))
    # the list of rows that go is the shorter one; the same plan at every size, as it grows with the documents
    kept = keyed.join(groups.hint("merge"), same, "left_anti").select("doc.*")
    repeated = groups.where("kept")
    if repeated.isEmpty():
        return kept
    # rows with one id and one text: any one of them
    one = keyed.join(repeated, same, "left_semi").groupBy("id", "digest").agg(F.first("doc").alias("doc"))
    return kept.unionAll(one.select("doc.*"))

"""Near duplicates: SimHash fingerprints, linked through a hierarchical index in Gray order.

Distinct fingerprints are sorted by their rank in the Gray code, which puts fingerprints that
differ in few bits side by side. Runs of them are leaves; a node keeps the bits that all
fingerprints below it share (a mask and their pattern), and runs of nodes are the nodes above.
Two nodes are compared by the shared bits in which they differ: that many differences every pair
below them has at least, so a pair of groups above the limit is dropped whole. The index is joined
with itself from the root down, level by level, as equi-joins on the parent.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adoptrend.llm.base import small_batches
from adoptrend.operators.graph.components import components
from adoptrend.operators.ordered import global_rank
from adoptrend.session import cut

SHINGLE = 3
SEED = 42
DISTANCE = 2
LEAF = 256
FAN = 16
BLOCK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of UTF-8 text, unsigned; 0 where there is no word.

    Words are runs of anything but ASCII white space, A-Z in lower case. A text with fewer words
    than a shingle is one shingle. A bit is set when over half of the shingles, repeats included,
    have it.
    """
    words = (text or b"").lower().split()  # both know ASCII only
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    total = len(words) - shingle + 1
    hashes = map(xxhash.xxh64_intdigest, map(b" ".join, zip(*[words[i:] for i in range(shingle)])), repeat(SEED))
    ones = np.zeros(64, np.int64)
    for start in range(0, total, BLOCK):
        block = np.fromiter(hashes, np.uint64, min(BLOCK, total - start))
        bits = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)``: the fingerprint of every row as a signed 64-bit number."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return docs.select(F.col(doc_id).alias("doc_id"), of(F.col(text).cast("binary")).alias("fp"))


def gray_rank(code: Column) -> Column:
    """Position of a codeword in the Gray code, as a signed number in the same order."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code.bitwiseXOR(F.lit(-(2**63)))


def _summary(nodes: DataFrame, values: str) -> DataFrame:
    """``(id, parent, mask, pattern)`` of nodes from the AND and the OR of what is below them."""
    mask = F.bitwise_not(F.col("every").bitwiseXOR(F.col("any")))
    return nodes.select("id", F.floor(F.col("id") / FAN).alias("parent"), mask.alias("mask"), "every", "any", *([values] if values else []))


class GrayIndex:
    """Leaves of ``LEAF`` fingerprints in Gray order, and the levels above them up to one root."""

    def __init__(self, distinct: DataFrame):
        ranked = distinct.select("fp", gray_rank(F.col("fp")).alias("rank"))
        placed = global_rank(ranked, ["rank"], "place")
        leaves = placed.groupBy(F.floor(F.col("place") / LEAF).alias("id")).agg(
            F.collect_list("fp").alias("fps"), F.bit_and("fp").alias("every"), F.bit_or("fp").alias("any")
        )
        self.leaves = cut(_summary(leaves, "fps"))
        self.levels = [self.leaves.select("id", "parent", "mask", "every", "any")]
        count = self.leaves.count()
        while count > FAN:
            above = self.levels[-1].groupBy(F.col("parent").alias("id")).agg(
                F.bit_and("every").alias("every"), F.bit_or("any").alias("any")
            )
            self.levels.append(cut(_summary(above, "")))
            count = -(-count // FAN)

    def pairs(self, distance: int) -> DataFrame:
        """``(a, b)``, a <= b: the pairs of leaves that may hold fingerprints within ``distance``."""
        pairs = self.leaves.sparkSession.createDataFrame([(0, 0)], "a long, b long")
        differing = F.bit_count(
            F.col("l.every").bitwiseXOR(F.col("r.every")).bitwiseAND(F.col("l.mask")).bitwiseAND(F.col("r.mask"))
        )
        for nodes in reversed(self.levels):
            below = (
                pairs.join(nodes.alias("l"), F.col("a") == F.col("l.parent"))
                .join(nodes.alias("r"), (F.col("b") == F.col("r.parent")) & (F.col("l.id") <= F.col("r.id")) & (differing <= distance))
                .select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))
            )
            pairs = cut(below)
        return pairs


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``(src, dst, w)``: links that connect what fingerprints within ``distance`` connect.

    All pairs in reach are compared; of them a task passes on those that join two of the groups it
    has seen, so a dense group of n fingerprints gives about n links and not n squared.
    """
    small_batches(distinct.sparkSession)
    index = GrayIndex(distinct)
    found = (
        index.pairs(distance)
        .join(index.leaves.select(F.col("id").alias("a"), F.col("fps").alias("left")), "a")
        .join(index.leaves.select(F.col("id").alias("b"), F.col("fps").alias("right")), "b")
        .select((F.col("a") == F.col("b")).alias("same"), "left", "right")
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group: dict[int, int] = {}

        def top(x: int) -> int:
            while (up := group.get(x, x)) != x:
                group[x] = x = group.get(up, up)
            return x

        for batch in batches:
            kept = []
            for same, left, right in zip(batch["same"], batch["left"], batch["right"], strict=True):
                a, b = np.asarray(left, np.int64), np.asarray(right, np.int64)
                # unsigned: numpy counts the bits of a signed number's absolute value
                near = np.bitwise_count(a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :]) <= distance
                if same:
                    near = np.triu(near, 1)
                for i, j in zip(*np.nonzero(near), strict=True):
                    x, y = int(a[i]), int(b[j])
                    if (p := top(x)) != (q := top(y)):
                        group[max(p, q)] = min(p, q)
                        kept.append((x, y, 1.0))
            yield pd.DataFrame(kept, columns=["src", "dst", "w"]).astype({"src": "int64", "dst": "int64", "w": "float64"})

    return found.mapInPandas(compare, "src long, dst long, w double")


def near_duplicates(
    docs: DataFrame, distance: int = DISTANCE, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE
) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per input row.

    ``component_id`` is the smallest id among the documents reachable over links of at most
    ``distance`` differing bits. Documents without words have fingerprint 0 and are linked like any
    others; copies share a fingerprint. An absent id counts only where a component has no other;
    no rows give no rows.
    """
    marked = cut(fingerprints(docs, text, doc_id, shingle))
    distinct = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    edges = cut(links(distinct, distance))
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    linked = components(cut(ends), edges)
    told = linked.join(distinct, F.col("id") == F.col("fp")).select("id", "component", "least")
    least = told.groupBy("component").agg(F.min("least").alias("component_id"))
    moved = cut(told.join(least, "component").select("id", F.col("component_id")))
    of = cut(
        distinct.join(moved, F.col("fp") == F.col("id"), "left").select(
            "fp", F.when(F.col("id").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id")
        )
    )
    return marked.join(of, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(
    docs: DataFrame, distance: int = DISTANCE, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE
) -> DataFrame:
    """The documents with the smallest id of their component, with all their columns.

    Rows that share an id stay or go together. Rows without id stay only where their component has no id.
    """
    stays = (
        near_duplicates(docs, distance, text, doc_id, shingle)
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias("of"))
        .distinct()
    )
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    return row.join(cut(stays), F.col(f"doc.`{doc_id}`").eqNullSafe(F.col("of")), "left_semi").select("doc.*")

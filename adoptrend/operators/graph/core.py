"""Edges prepared for repeated joins, and the rounds that run over them.

A graph is ``vertices(id)`` and ``edges(src, dst, w)``. A vertex may own any share of the edges:
its edges are split into parts, and what the vertex sends goes to every part.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from adoptrend.operators.ordered import global_rank
from adoptrend.operators.skew import HEAVY_ROWS, heavy_keys
from adoptrend.session import cut, discard


def numbered(vertices: DataFrame) -> DataFrame:
    """``(id, node)``: vertices with numbers in the order of their ids; long ids are their own numbers."""
    ids = vertices.select("id")
    if dict(ids.dtypes)["id"] == "bigint":
        return ids.withColumn("node", F.col("id"))
    return cut(global_rank(ids, ["id"], "node"))


def renumbered(edges: DataFrame, numbers: DataFrame) -> DataFrame:
    """Edges between the numbers of their ends; an edge with an end that is no vertex falls away."""
    src = numbers.select(F.col("id").alias("src"), F.col("node").alias("_s"))
    dst = numbers.select(F.col("id").alias("dst"), F.col("node").alias("_d"))
    return edges.join(src, "src").join(dst, "dst").select(
        F.col("_s").alias("src"), F.col("_d").alias("dst"), F.col("w").cast("double").alias("w")
    )


def named(scores: DataFrame, numbers: DataFrame, *columns: str) -> DataFrame:
    """Results by number back under the vertices' ids."""
    return numbers.join(scores.withColumnRenamed("id", "node"), "node").select("id", *columns)


def symmetric(edges: DataFrame) -> DataFrame:
    """Both directions of every undirected edge, from one pass over the edges."""
    return edges.select(
        F.inline(
            F.array(
                F.struct(F.col("src"), F.col("dst"), F.col("w")),
                F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("w")),
            )
        )
    )


def reverse(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")


class SplitEdges:
    """Directed edges laid out by source once, for all rounds that join to them.

    The layout is cached, so a round moves only what the vertices send; a lost executor's share
    is rebuilt from the written edges. A source with very many edges is split into parts.
    ``carry`` names further columns of the edges to keep.
    """

    def __init__(self, edges: DataFrame, least: int = HEAVY_ROWS, carry: tuple[str, ...] = ()):
        self.written, seen = settle(
            edges.select("src", "dst", F.col("w").cast("double").alias("w"), *carry), total=F.count(F.lit(1))
        )
        self.total = seen["total"]
        # HEAVY_SHARE rows at most, often none
        self.heavy = cut(heavy_keys(self.written, "src", self.total, least))
        self.keys = ["src", "part"]
        part = F.pmod(F.xxhash64("dst"), F.coalesce("_parts", F.lit(1))).cast("int")
        parted = self.written.join(F.broadcast(self.heavy), "src", "left").withColumn("part", part).drop("_parts")
        # as many parts as any other exchange has, so that the cached side of a join stays where it is
        n = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.edges = parted.repartition(n, *self.keys).persist(StorageLevel.MEMORY_AND_DISK)

    def send(self, state: DataFrame, *columns: str) -> DataFrame:
        """Join ``state(id, columns...)`` to the edges leaving each id; a column may not have the name of one of theirs."""
        if clash := set(columns) & set(self.edges.columns):
            raise ValueError(f"columns of the edges: {sorted(clash)}")
        sent = state.select(F.col("id").alias("src"), *columns)
        parts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
        sent = sent.join(F.broadcast(self.heavy), "src", "left").withColumn("part", F.explode(parts)).drop("_parts")
        return self.edges.join(sent, self.keys)

    def release(self) -> None:
        """The edges, the layout and the heavy sources go; only written results may be left to read."""
        self.edges.unpersist()
        discard(self.written, self.heavy)


def out_weights(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("out_w"), F.count("*").alias("degree"))


def settle(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
    """Materialise one round and read its scalars, in the same job."""
    seen = Observation()
    done = cut(df.observe(seen, *[c.alias(name) for name, c in measures.items()]))
    return done, seen.get


def endpoints(edges: DataFrame) -> DataFrame:
    """The vertices that have an edge."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def degree(vertices: DataFrame, both_ways: DataFrame) -> DataFrame:
    """Number of neighbours of every vertex, 0 for isolated ones."""
    counted = both_ways.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree"))
    return vertices.select("id").join(counted, "id", "left").fillna(0, subset=["degree"])

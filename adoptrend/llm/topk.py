"""Exact top-k inner products by MaxScore, over shards.

Every dimension of a vector is a term. A query's score of a vector is the sum of its terms'
contributions, and each contribution has a bound in a shard, from the shard's smallest and largest
component. Against the smallest possible score all contributions are at least 0, so the bounds add
up as in MaxScore: terms are sorted by bound, and those whose bounds together can't lift a vector
over the k-th best score so far are non-essential. The essential terms are summed for all vectors
of the shard; the others are probed only for vectors that can still compete.

Vectors are dealt to areas of a bounded size, one a task, which holds its area as shards. Queries are
sent to every area and stream past its shards in blocks, so no task holds them all and nothing goes
through the driver. What is sent grows with the queries times the areas; what is written is one small
list for each query and area, and lists are merged by query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adoptrend.llm.base import arrow_batches
from adoptrend.session import cut

SCALE = 256
TOP = 5
SHARD = 2048
BLOCK = 512
# components of an area, of one shard with what it is padded by, and of what is probed at once
AREA = 1 << 24
WIDEST = 1 << 22
# the others of a block are probed where no more than one in so many vectors can compete, else summed for all
PROBED = 16
# areas for each task slot where the vectors are few
SPREAD = 2
# integers below are exact as floats of 4 and 8 bytes
EXACT = {np.float32: 1 << 24, np.float64: 1 << 53}


def quantised(vector: str = "embedding") -> Column:
    """floor(256 * x) of every component as a long array; null where a component is null or not finite."""
    x = F.col(vector).cast("array<double>")
    usable = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(usable, F.transform(x, lambda v: F.floor(v * F.lit(float(SCALE))).cast("long")))


def _matrix(rows) -> np.ndarray:
    """Rows of any lengths; what a row lacks is 0."""
    width = max((len(r) for r in rows), default=0)
    if all(len(r) == width for r in rows):
        return np.array(list(rows), np.int64).reshape(len(rows), width)
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _exact(most: int) -> type:
    """The smallest type that holds whole numbers up to ``most`` exactly; matrices of floats are multiplied much faster."""
    return next((kind for kind, end in EXACT.items() if most < end), np.int64)


class Shard:
    """Vectors by term, with the bounds of every term."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        self.low, self.high = (m.astype(np.int64) for m in (vectors.min(axis=0, initial=0), vectors.max(axis=0, initial=0)))
        self.largest = max(-int(self.low.min(initial=0)), int(self.high.max(initial=0)))
        self.columns = np.ascontiguousarray(vectors.T, _exact(self.largest))

    def search(self, own: int, query: np.ndarray, k: int, least: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of vectors that can be among the k best, given that ``least`` is known to be reached k times."""
        known = np.array([least is not None])
        _, ids, scores, _ = self.reached(np.array([own]), query[None, :], k, np.array([least or 0]), known)
        best = np.lexsort((ids, -scores))[:k]
        return ids[best], scores[best]

    def reached(
        self, own: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray, known: np.ndarray, split: bool = True
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
        """``(at, ids, scores)``: vectors that can be among the k best of ``queries[at]``, and whether bounds ruled most of them out.

        Where ``known``, ``least`` has to be reached, elsewhere what the k best of this shard reach. With ``split``
        off all terms are essential: the result is the same.
        """
        width = min(queries.shape[1], len(self.columns))
        queries = queries[:, :width]
        ends = queries * self.low[:width], queries * self.high[:width]
        bottom, top = np.minimum(*ends), np.maximum(*ends)
        bound, need = top - bottom, least - bottom.sum(axis=1)
        # the others don't reach the k-th best score, with all of their terms together
        live = np.nonzero(~known | (bound.sum(axis=1) >= need))[0]
        own, queries, bound, top, need, least, known = (x[live] for x in (own, queries, bound, top, need, least, known))
        kind = _exact(width * self.largest * int(np.abs(queries).max(initial=0)))
        others = np.zeros(queries.shape, bool)
        if split:
            order = np.argsort(bound, axis=1, kind="stable")
            reach = np.cumsum(np.take_along_axis(bound, order, axis=1), axis=1)
            np.put_along_axis(others, order, (reach < need[:, None]) & known[:, None], axis=1)
        scores = self.sums(np.where(others, 0, queries), kind)
        floor = (least - np.where(others, top, 0).sum(axis=1)).astype(kind)
        if not known.all():
            floor[~known] = self._kth(own[~known], scores[~known], k)
        compete = scores >= floor[:, None]
        ruled_out = True
        if others.any():
            left = int(np.count_nonzero(compete))
            ruled_out = PROBED * left <= compete.size and left * width <= WIDEST
            if not ruled_out:
                scores += self.sums(np.where(others, queries, 0), kind)
                compete = scores >= np.where(known, least.astype(kind), floor)[:, None]
        at, of = np.nonzero(compete)
        found = scores[at, of].astype(np.int64)
        if others.any() and ruled_out:
            found += np.einsum("ij,ij->i", np.where(others, queries, 0)[at], self.columns[:width, of].T.astype(np.int64))
        kept = (self.ids[of] != own[at]) & (~known[at] | (found >= least[at]))
        return live[at[kept]], self.ids[of[kept]], found[kept], ruled_out

    def sums(self, queries: np.ndarray, kind: type) -> np.ndarray:
        """Scores of all vectors, exact in numbers of this kind."""
        return queries.astype(kind) @ self.columns[: queries.shape[1]].astype(kind, copy=False)

    def _kth(self, own: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """What the k best of each row of scores reach, the query's own vectors left out; the lowest number where there are fewer."""
        none = np.iinfo(np.int64).min if scores.dtype == np.int64 else -np.inf
        scores[self.ids[None, :] == own[:, None]] = none
        if len(self.ids) <= k:
            return np.full(len(own), none, scores.dtype)
        return np.partition(scores, len(self.ids) - k, axis=1)[:, -k]


class Best:
    """The k best so far of a block of queries."""

    def __init__(self, own: np.ndarray, queries: np.ndarray, k: int):
        self.own, self.queries, self.k = own, queries, k
        self.at, self.ids, self.scores = (np.zeros(0, np.int64) for _ in range(3))
        self.least, self.known, self.split = np.zeros(len(own), np.int64), np.zeros(len(own), bool), True

    def visit(self, shard: Shard) -> None:
        """Merge what ``shard`` has, whose ids are none of them smaller than those of shards before."""
        # of equal scores the smaller id stays, so more than the k-th best is needed
        at, ids, scores, ruled_out = shard.reached(self.own, self.queries, self.k, self.least + 1, self.known, self.split)
        # where bounds rule little out, terms apart only cost a second sum
        self.split &= ruled_out
        if not len(at):
            return
        at, ids, scores = (np.concatenate(x) for x in ((self.at, at), (self.ids, ids), (self.scores, scores)))
        order = np.lexsort((ids, -scores, at))
        at, ids, scores = at[order], ids[order], scores[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        last = place == self.k - 1
        self.least[at[last]], self.known[at[last]] = scores[last], True
        self.at, self.ids, self.scores = (x[place < self.k] for x in (at, ids, scores))

    def listed(self) -> pd.DataFrame:
        return pd.DataFrame({"query_id": self.own[self.at], "vec_id": self.ids, "score": self.scores})


def _searched(batches: Iterator[pd.DataFrame], k: int, shard: int) -> Iterator[pd.DataFrame]:
    """Rows ``(asks, vec_id, x)`` of one area in, its vectors by id before the queries; the best of each query there out."""
    shards: list[Shard] = []
    ids: list[int] = []
    rows: list[np.ndarray] = []
    widest = 0
    for batch in batches:
        asks = batch["asks"].to_numpy(bool)
        for i, x in zip(batch["vec_id"].to_numpy(np.int64)[~asks], batch["x"].to_numpy()[~asks], strict=True):
            if rows and (len(rows) == shard or (len(rows) + 1) * max(widest, len(x)) > WIDEST):
                shards.append(Shard(np.array(ids, np.int64), _matrix(rows)))
                ids, rows, widest = [], [], 0
            ids.append(i)
            rows.append(x)
            widest = max(widest, len(x))
        if not asks.any():
            continue
        if rows:
            shards.append(Shard(np.array(ids, np.int64), _matrix(rows)))
            ids, rows, widest = [], [], 0
        best = Best(batch["vec_id"].to_numpy(np.int64)[asks], _matrix(batch["x"].to_numpy()[asks]), k)
        for one in shards:
            best.visit(one)
        yield best.listed()


def _narrowest(low: int | None, high: int | None) -> str:
    """The shortest type for numbers from ``low`` to ``high``."""
    for kind, end in (("short", 1 << 15), ("int", 1 << 31)):
        if -end <= (low or 0) and (high or 0) < end:
            return kind
    return "long"


def top_scores(vectors: DataFrame, queries: DataFrame, k: int = TOP, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best of ``vectors`` for each row of ``queries``.

    Both are ``(vec_id, x)`` with x a long array; scores have to fit in a long. A vector with the
    query's id is not a candidate. Ties go to the smaller id. Rows without id or vector take no
    part; a candidate repeated is a candidate each time, a query repeated is asked once, with its
    smallest vector. Where vectors differ in length the missing components are 0. With fewer than k
    candidates all are listed; no rows give no rows.
    """
    there = F.col("vec_id").isNotNull() & F.col("x").isNotNull()
    asked = cut(queries.where(there).groupBy("vec_id").agg(F.min("x").alias("x")))
    held = cut(vectors.where(there).select("vec_id", "x"))
    ends = [F.min(F.array_min("x")).alias("low"), F.max(F.array_max("x")).alias("high")]
    seen = held.agg(F.count("*").alias("rows"), F.sum(F.size("x")).alias("components"), *ends).first()
    areas = max(
        -(-(seen.components or 0) // AREA),
        min(-(-seen.rows // shard), SPREAD * vectors.sparkSession.sparkContext.defaultParallelism),
        1,
    )
    least = asked.agg(*ends).first()
    kind = f"array<{_narrowest(min(seen.low or 0, least.low or 0), max(seen.high or 0, least.high or 0))}>"
    area = F.pmod(F.xxhash64("vec_id", "x"), F.lit(areas)).cast("int")
    dealt = held.select(area.alias("area"), F.lit(False).alias("asks"), "vec_id", F.col("x").cast(kind).alias("x"))
    # sent without a join: one side would look as short as the stated queries are before they go to every area, and be broadcast
    every = F.explode(F.sequence(F.lit(0), F.lit(areas - 1)))
    sent = asked.select(every.alias("area"), F.lit(True).alias("asks"), "vec_id", F.col("x").cast(kind).alias("x"))
    laid = dealt.unionByName(sent).repartitionById(areas, "area").sortWithinPartitions("asks", "vec_id")
    with arrow_batches(vectors.sparkSession, block):
        found = cut(
            laid.select("asks", "vec_id", "x").mapInPandas(
                lambda batches: _searched(batches, k, shard), "query_id long, vec_id long, score long"
            )
        )
    first = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def self_search(table: DataFrame, every: int, k: int = TOP, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """``top_scores`` of a table of float vectors, quantised, for its rows whose id is divisible by ``every``."""
    rows = table.select(F.col(vec_id).alias("vec_id"), quantised(vector).alias("x"))
    return top_scores(rows, rows.where(F.col("vec_id") % every == 0), k)

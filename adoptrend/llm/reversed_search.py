"""Ranked lexical search the other way round: the items wait in an index, the documents stream past.

The items' terms make an inverted index: for each term the items that hold it and its weight there.
The index is small and travels to every task; the corpus, which is large, is never indexed, sorted
or shuffled. A task counts the terms of one document after another, adds up the items' scores
over the index and keeps the best documents of each item in a heap of fixed size. The heaps of all
tasks are merged by item.

Items go in blocks, so that an index has a bound whatever their number: every block is one more
pass over the documents.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adoptrend.llm.base import arrow_batches
from adoptrend.operators.ordered import running_total
from adoptrend.session import cut, discard

TOP = 20
# bytes of item texts behind one index; an item alone may have more
BLOCK_BYTES = 4 << 20
# a long text is read in pieces of about so many bytes, so its words never stand in memory at once
PIECE = 1 << 20
# scores below are exact as doubles
EXACT = 1 << 53

# what is no part of a term: ASCII but for digits and letters, which lose their case
_TERM = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of UTF-8 text in their order, repeats included, in lists of a bounded part of the text each."""
    body = (text or b"").translate(_TERM)
    start = 0
    while len(body) - start > PIECE:
        end = body.find(b" ", start + PIECE)
        end = len(body) if end < 0 else end
        yield body[start:end].split()
        start = end
    yield body[start:].split()


def counted(text: bytes | None) -> Counter:
    count: Counter = Counter()
    for part in terms(text):
        count.update(part)
    return count


class Index:
    """Term to ``(item, times the item holds it)``, for one block of items."""

    def __init__(self, items: Iterable[tuple[int, bytes | None]]):
        self.items, postings = [], {}
        for place, (item, text) in enumerate(items):
            self.items.append(item)
            for term, times in counted(text).items():
                postings.setdefault(term, []).append((place, times))
        self.number = {term: i for i, term in enumerate(postings)}
        self.starts = np.zeros(len(postings) + 1, np.int64)
        np.cumsum([len(p) for p in postings.values()], out=self.starts[1:])
        flat = np.array([x for p in postings.values() for x in p], np.int64).reshape(-1, 2)
        self.places, self.times = flat[:, 0].copy(), flat[:, 1].copy()
        self.weights = self.times

    def weigh(self, weights: np.ndarray) -> None:
        """Every posting's weight: that of its term, once for each time the item holds it."""
        self.weights = np.repeat(weights, np.diff(self.starts)) * self.times
        # a document adds less than 1,000,000 for each unit of weight
        reach = np.bincount(self.places, self.weights, len(self.items)).max(initial=0) * 1e6
        self.exact = bool(reach < EXACT)

    def held(self, count: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the terms of a document that the index has, and how often they occur there."""
        number = self.number
        found = [(number[t], n) for t, n in count.items() if t in number]
        return tuple(np.array(found, np.int64).reshape(-1, 2).T)

    def scores(self, numbers: np.ndarray, gains: np.ndarray) -> np.ndarray:
        """The score of every item of the block for a document whose terms bring ``gains``."""
        lengths = self.starts[numbers + 1] - self.starts[numbers]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[numbers] - ends + lengths, lengths)
        added = self.weights[at] * np.repeat(gains, lengths)
        if self.exact:
            return np.bincount(self.places[at], added, len(self.items)).astype(np.int64)
        total = np.zeros(len(self.items), np.int64)
        np.add.at(total, self.places[at], added)
        return total


def gains(tf: np.ndarray, n: int, documents: int, length: int) -> np.ndarray:
    """What a term that occurs ``tf`` times in a document of ``n`` terms brings for each unit of its weight."""
    m = 75 + (25 * n * documents) // length
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Heaps:
    """The best documents of every item seen so far: higher scores first, then smaller ids, an absent id last."""

    def __init__(self, items: int, top: int):
        self.top, self.heaps = top, [[] for _ in range(items)]
        # the score to reach; an equal one may still win by its id
        self.least = np.ones(items, np.int64)

    def add(self, doc_id: int | None, scores: np.ndarray) -> None:
        for place in np.nonzero(scores >= self.least)[0]:
            entry = (int(scores[place]), doc_id is not None, -(doc_id or 0))
            heap = self.heaps[place]
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.top:
                self.least[place] = heap[0][0]

    def listed(self, items: list) -> pa.RecordBatch:
        rows = [(items[p], -d if there else None, s) for p, heap in enumerate(self.heaps) for s, there, d in heap]
        columns = [pa.array(x, pa.int64()) for x in (zip(*rows, strict=True) if rows else ((), (), ()))]
        return pa.RecordBatch.from_arrays(columns, ["item_id", "doc_id", "score"])


def _statistics(docs: DataFrame, index) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, terms of all of them, and for each term of the index the documents that hold it."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        total, length, df = 0, 0, np.zeros(len(known.number), np.int64)
        for batch in batches:
            for text in batch.column("text"):
                count = counted(text.as_py())
                total += bool(count)
                length += count.total()
                df[known.held(count)[0]] += 1
        there = np.nonzero(df)[0]
        yield pa.RecordBatch.from_pydict({"term": np.r_[-2, -1, there], "n": np.r_[total, length, df[there]]})

    # one row for each term of the index, whose size is bounded
    summed = docs.select("text").mapInArrow(told, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    seen = dict(map(tuple, summed.collect()))
    return seen.pop(-2, 0), seen.pop(-1, 0), seen


def _weights(spark, documents: int, df: dict[int, int], terms: int) -> np.ndarray:
    """floor(1000 * ln((2 N + 2) / (2 df + 1))) of every term, by the engine's own logarithm."""
    values = sorted({df.get(i, 0) for i in range(terms)})
    ratio = F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1).cast("double")
    weigh = spark.createDataFrame([(v,) for v in values], "df long").select("df", F.floor(1000 * F.log(ratio)).cast("long"))
    by_df = dict(map(tuple, weigh.collect()))
    return np.array([by_df[df.get(i, 0)] for i in range(terms)], np.int64)


def _best(docs: DataFrame, items: list[tuple[int, bytes | None]], top: int) -> DataFrame | None:
    """``(item_id, doc_id, score)``: the best of every task for every item of a block."""
    spark = docs.sparkSession
    index = Index(items)
    if not index.number:
        return None
    sent = spark.sparkContext.broadcast(index)
    documents, length, df = _statistics(docs, sent)
    sent.destroy()
    if not documents:
        return None
    index.weigh(_weights(spark, documents, df, len(index.number)))
    sent = spark.sparkContext.broadcast(index)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        heaps = Heaps(len(known.items), top)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                count = counted(text.as_py())
                numbers, tf = known.held(count)
                if len(numbers):
                    heaps.add(doc_id.as_py(), known.scores(numbers, gains(tf, count.total(), documents, length)))
        yield heaps.listed(known.items)

    found = cut(docs.mapInArrow(searched, "item_id long, doc_id long, score long"))
    sent.destroy()
    return found


def ranked(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` documents of each item with a score above 0.

    Terms are runs of ASCII letters and digits and of anything beyond ASCII, A-Z in lower case. All
    documents with a term count in the statistics. Equal scores go by ascending id, absent ids last;
    a repeated row is a document each time. An item without id takes no part, a repeated item is
    asked once, with its smallest text. Absent and empty texts have no term and are never found; no
    documents or no items give no rows. Ids are whole numbers.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    named = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    once = named.where("item_id IS NOT NULL").groupBy("item_id").agg(F.min("text").alias("text"))
    sized = once.withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1)
    blocks = cut(
        running_total(sized, ["item_id"], "bytes", "upto")
        .select("item_id", F.col("text").cast("binary").alias("text"), F.floor((F.col("upto") - F.col("bytes")) / block_bytes).alias("block"))
    )
    found = []
    with arrow_batches(spark):
        for (block,) in blocks.select("block").distinct().orderBy("block").toLocalIterator():
            held = [(r[0], r[1] and bytes(r[1])) for r in blocks.where(F.col("block") == block).select("item_id", "text").collect()]
            found.append(_best(docs=read, items=held, top=top))
    discard(blocks)
    merged = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for part in found:
        merged = merged if part is None else merged.unionByName(part)
    first = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (
        merged.withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= top)
        .select("item_id", "rank", "doc_id", "score")
    )

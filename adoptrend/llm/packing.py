"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Only lengths matter for a packing, and there are no more lengths than a sequence has tokens. The
lengths are counted on Spark; the packing is planned on those counts, at most ``capacity`` numbers
for an input of any size, and each step of the plan fills many sequences alike. Pieces then find
their sequence by their rank among the pieces of the same length, from one global order that is
range-partitioned, so a length that a third of the pieces have is spread like any other.

The plan is bin completion: a sequence is filled around the largest piece left, with the fillings
that no other filling dominates; branches whose waste can't beat the incumbent are pruned. The
first incumbent is best-fit decreasing.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adoptrend.llm.base import small_batches
from adoptrend.operators.ordered import global_rank
from adoptrend.session import cut

CAPACITY = 2048
VOCABULARY = "byte_bpe_50k"
SEPARATOR = 0

# Bounds on the planner's work, in expanded steps and in fillings looked at for each.
STEPS = 2500
FILLINGS = 400


class Encoder(dict):
    """Ids of text as little-endian unsigned 32-bit numbers.

    A single space between two other characters always starts a new pre-token, so a text is the
    run of its parts between such spaces, and a part has the same ids wherever it stands. Parts
    seen lately are kept, up to ``KEPT`` of them; long ones are not.
    """

    KEPT = 300_000
    LONG = 48
    END = "<|endoftext|>"
    UNSAFE = re.compile(r" \s|\s |\A\s|\s\Z")
    SAFE = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, vocabulary: str):
        super().__init__()
        self.exact = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.quick = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.end = self.as_bytes([self.exact.token_to_id(self.END)])

    @staticmethod
    def as_bytes(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def encode_part(self, part: str) -> bytes:
        # up to Latin Extended-B both libraries class all characters alike
        if part.isascii() or max(part) < "ɐ":
            return self.as_bytes(self.quick.encode_ordinary(part))
        return self.as_bytes(self.exact.encode(part, add_special_tokens=False).ids)

    def __missing__(self, part: str) -> bytes:
        ids = self.encode_part(" " + part)
        if len(part) <= self.LONG:
            if len(self) >= self.KEPT:
                self.clear()
            self[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        out = []
        for i, segment in enumerate(text.split(self.END)):
            if i:
                out.append(self.end)
            if segment:
                parts = self.SAFE.split(segment) if self.UNSAFE.search(segment) else segment.split(" ")
                out.append(self.encode_part(parts[0]))
                out.extend(map(self.__getitem__, parts[1:]))
        return b"".join(out)


@cache
def encoder(vocabulary: str) -> Encoder:
    """One for each worker."""
    return Encoder(vocabulary)


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: the documents' ids and the separator, cut to capacity.

    Only a document over ``capacity`` is cut, from its end, so its first piece may be shorter. An
    absent or empty text is the separator alone. ``ids`` are little-endian unsigned 32-bit numbers.
    """
    small_batches(docs.sparkSession)
    closing = np.array([SEPARATOR], "<u4").tobytes()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encode(text) + closing if isinstance(text, str) else closing
                total = len(ids) // 4
                start = 0
                for number in range(-(-total // capacity)):
                    stop = total - capacity * (-(-total // capacity) - 1 - number)
                    rows.append((doc_id, number, start, stop - start, ids[4 * start : 4 * stop]))
                    start = stop
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids"])

    # as text the id survives pandas, which has no absent integers
    cut_texts = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(
        cut_up, "doc_id string, piece int, start long, length long, ids binary"
    )
    return cut_texts.withColumn("doc_id", F.col("doc_id").cast(kind))


def lower_bound(counts: np.ndarray) -> int:
    """Martello and Toth's L2: sequences that any packing needs. ``counts[n]`` pieces have length n."""
    capacity = len(counts) - 1
    lengths = np.arange(capacity + 1)
    many, mass = np.cumsum(counts), np.cumsum(counts * lengths)
    best = 0
    for small in range(capacity // 2 + 1):
        big = many[-1] - many[capacity - small]
        middle = many[capacity - small] - many[capacity // 2]
        room = middle * capacity - (mass[capacity - small] - mass[capacity // 2])
        loose = mass[capacity // 2] - (mass[small - 1] if small else 0)
        best = max(best, int(big + middle + max(0, -(-(loose - room) // capacity))))
    return best


def best_fit(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing, on counts: ``(lengths, times)``, sequences filled alike."""
    capacity = len(counts) - 1
    groups: dict[int, list[list]] = {}  # by room left: [lengths, times]
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            room = next((r for r in range(length, capacity) if groups.get(r)), None)
            if room is None:
                lengths, times, room = (), left, capacity
            else:
                lengths, times = groups[room].pop()
            each = room // length
            full = min(times, left // each)
            if not full:  # the last few
                each, full = left, 1
            if room < capacity and times > full:
                groups[room].append([lengths, times - full])
            groups.setdefault(room - each * length, []).append([lengths + (length,) * each, full])
            left -= each * full
    return [(tuple(lengths), times) for group in groups.values() for lengths, times in group]


def dominated(filling: tuple[int, ...], room: int, counts: np.ndarray) -> bool:
    """Whether some of the filling can be swapped for one larger piece that is left out."""
    slack = room - sum(filling)
    if len(filling) > 6:
        return False
    for n in range(1, min(len(filling), 3) + 1):
        for part in set(combinations(filling, n)):
            low = sum(part) + (n == 1)
            spare = counts[low : sum(part) + slack + 1].copy()
            for x in filling:
                if 0 <= x - low < len(spare):
                    spare[x - low] -= 1
            if (spare > 0).any():
                return True
    return False


def fillings(counts: np.ndarray, room: int, most: int = FILLINGS) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room``, least waste first; at most ``most`` are looked at."""
    if room <= 0:
        return [()]
    if counts[room]:
        return [(room,)]  # an exact fit dominates all others
    there = np.nonzero(counts[1 : room + 1])[0] + 1
    if not len(there):
        return [()]
    found: list[tuple[int, ...]] = []
    seen = 0

    def extend(chosen: tuple[int, ...], left: int, below: int) -> None:
        """Add pieces shorter than ``below``, longer ones and more of one length first."""
        nonlocal seen
        fits = there[: np.searchsorted(there, min(left + 1, below))]
        for length in map(int, fits[::-1]):
            n = min(int(counts[length]), left // length)
            for copies in range(n, max(0, n - 3), -1):
                if seen >= most or (found and sum(found[-1]) == room):
                    return
                extend(chosen + (length,) * copies, left - length * copies, length)
        if not len(fits):
            seen += 1
            larger = there[np.searchsorted(there, below) : np.searchsorted(there, left, "right")]
            if not any(counts[x] > chosen.count(int(x)) for x in larger):
                found.append(chosen)

    extend((), room, room + 1)
    found.sort(key=lambda x: (room - sum(x), len(x), tuple(-y for y in x)))
    kept = [x for x in found[:12] if not dominated(x, room, counts)]
    return kept or found[:1] or [()]


def plan(counts: np.ndarray, steps: int = STEPS) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths, times)``: fillings and how many sequences get each, all pieces placed.

    Depth first over fillings of the largest piece left, least waste first. A branch ends when its
    waste leaves no room for fewer sequences than the incumbent has; the search ends at the lower
    bound (see ``proved``) or after ``steps`` steps. Equal counts give equal plans.

    Besides ``steps`` the search is bounded in these ways, none of which loses a piece: of a length a
    filling tries its most copies and the two numbers below; ``FILLINGS`` fillings of a room are
    looked at, and of them the twelve with the least waste are tested for dominance, by swaps of
    up to three pieces in fillings of up to six; a filling is repeated as often as the counts allow.
    """
    counts = counts.astype(np.int64)
    capacity = len(counts) - 1
    mass = int((counts * np.arange(capacity + 1)).sum())
    bound = lower_bound(counts)
    incumbent = best_fit(counts)
    fewest = sum(times for _, times in incumbent)
    if not mass or fewest == bound:
        return incumbent

    def options(left: np.ndarray) -> tuple[int, list[tuple[int, ...]]]:
        largest = int(np.nonzero(left)[0][-1])
        rest = left.copy()
        rest[largest] -= 1
        return largest, fillings(rest, capacity - largest)

    path: list[tuple[tuple[int, ...], int]] = []
    # each entry: counts before the step, its largest piece, the fillings not tried yet, waste so far
    stack = [(counts, *options(counts), 0)]
    taken = 0
    while stack and taken < steps:
        left, largest, choices, waste = stack[-1]
        del path[len(stack) - 1 :]
        if not choices:
            stack.pop()
            continue
        taken += 1
        lengths = (largest, *choices.pop(0))
        needs = {x: lengths.count(x) for x in lengths}
        times = min(int(left[x]) // n for x, n in needs.items())
        after = left.copy()
        for x, n in needs.items():
            after[x] -= n * times
        spent = waste + (capacity - sum(lengths)) * times
        if spent > (fewest - 1) * capacity - mass:
            continue
        path.append((lengths, times))
        if after.any():
            stack.append((after, *options(after), spent))
            continue
        incumbent, fewest = list(path), sum(n for _, n in path)
        if fewest == bound:
            break
    return incumbent


def proved(counts: np.ndarray, steps: list[tuple[tuple[int, ...], int]]) -> bool:
    """Whether a plan has the fewest sequences possible, by the lower bound; else a limit ended the search."""
    return sum(times for _, times in steps) == lower_bound(counts.astype(np.int64))


def places(steps: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """The plan by length and rank: where the pieces from rank ``rank`` of a length on go."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for lengths, times in steps:
        offset = 0
        for length in lengths:
            rows.append((length, used.get(length, 0), first, offset))
            used[length] = used.get(length, 0) + times
            offset += length
        first += times
    rows.sort()
    return dict(zip(("length", "rank", "first", "offset"), np.array(rows, np.int64).reshape(-1, 4).T, strict=True))


def pack(lengths: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Any table with a column ``length`` (1 to ``capacity``), plus ``sequence_id`` and ``offset``.

    ``order`` numbers the rows of one length; rows equal in it are placed in any order. Reads the
    table several times, so pass a written one. No rows give no rows.
    """
    seen = lengths.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most `capacity` rows
    counts = np.zeros(capacity + 1, np.int64)
    for row in seen:
        counts[row["length"]] = row["n"]
    table = places(plan(counts))
    before = np.cumsum(counts) - counts
    # length and rank as one sortable number; a rank has 48 bits
    starts = (table["length"] << 48) + table["rank"]
    ranked = global_rank(lengths, ["length", *order], "place")

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, place: pd.Series) -> pd.DataFrame:
        size = length.to_numpy(np.int64)
        rank = place.to_numpy(np.int64) - before[size]
        at = np.searchsorted(starts, (size << 48) + rank, "right") - 1
        return pd.DataFrame(
            {"sequence_id": table["first"][at] + rank - table["rank"][at], "offset": table["offset"][at]}
        )

    return ranked.withColumn("at", placed("length", "place")).select(*lengths.columns, "at.sequence_id", "at.offset")


def packed(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of every piece."""
    cut_up = pieces(docs, capacity, vocabulary).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(cut(cut_up), ["doc_id", "piece", "ids_crc32"], capacity)


def sequences(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(sequence_id, ids)``: the packed sequences themselves, ids as little-endian 32-bit numbers."""
    written = cut(pieces(docs, capacity, vocabulary))
    placed = pack(written, ["doc_id", "piece", "ids"], capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda out, part: F.concat(out, part["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"))

"""The trie of conversations: every distinct beginning, who shares it and what sharing it saves.

Conversations are sorted by their turns, then by id, and cut into ranges, so a popular beginning or a
group of copies is spread over as many ranges as it needs. A range is walked in shards. In a shard
each (position, turn) is indexed by the bitset of the conversations that have that turn there; walking
depth first, a node's bitset is intersected with the bitset of the turn that comes next, which gives
the child's members, their number by popcount, and those that end there.

Only the node of a beginning that the last conversation of one shard shares with the first of the
next lies in several shards. Members, children, leaves and savings are sums over shards, each
counted where its node is first (or last) seen, so such nodes are added up by the hash of their
beginning; all others leave their shard finished. Texts never travel: a turn is its SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adoptrend.llm.base import WORD, arrow_batches
from adoptrend.operators.ordered import CHUNK, ordered_chunks
from adoptrend.session import cut, discard

# a shard holds so many conversations, or so many turns, at most (a single conversation may have more)
SHARD = 4096
SHARD_TURNS = 1 << 16

NODE = (
    "key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved long, place long, shard long, ends array<long>"
)


def turn_tag(role: str = "role", text: str = "text") -> Column:
    """SHA-256 of a turn; its role is marked off by its length."""
    role, text = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def sequences(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, turns)``: the turns of each conversation in order, as an array of ``(tag, words)``.

    Turns go by number, absent first; equal numbers by role, then by the SHA-256 of role and text.
    Absent roles and texts are empty. Rows without conversation id take no part.
    """
    tagged = turns.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
            turn_tag(f"`{role}`", f"`{text}`").alias("tag"),
            F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD)).cast("long").alias("words"),
        ).alias("turn"),
    )
    listed = tagged.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["tag"].alias("tag"), t["words"].alias("words"))).alias("turns"))


def rebuilt(listed: DataFrame, every: int = 20, shared: int = 4) -> DataFrame:
    """``(conv_id, turns)``: conversation c begins with the first h turns of conversation c - c % ``every``.

    h is the CRC-32 of c in decimal, modulo ``shared``; c's own turns after its first h follow. Where the
    other conversation has fewer turns all of them are taken, where it is absent none.
    """
    first = listed.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, shared - 1).alias("_first")
    )
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(shared)).cast("int")
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    joined = listed.join(first, F.col("conv_id") - F.col("conv_id") % every == F.col("_base"), "left")
    return joined.select("conv_id", F.when(F.col("_first").isNull(), own).otherwise(F.concat(F.slice("_first", 1, h), own)).alias("turns"))


def common(one: list[bytes], other: list[bytes]) -> int:
    """Turns at which two conversations begin alike."""
    n = min(len(one), len(other))
    return next((i for i in range(n) if one[i] != other[i]), n)


def bits(members: int) -> Iterator[int]:
    while members:
        low = members & -members
        yield low.bit_length() - 1
        members ^= low


class Shard:
    """Sorted conversations ``(conv_id, tags, words)`` and the bitsets of those that have a turn at a position."""

    def __init__(self, rows: list[tuple[int, list[bytes], list[int]]], before: list[bytes] | None, after: list[bytes] | None):
        self.rows = rows
        # beginnings up to these depths also lie in the shard before or after
        self.before = -1 if before is None else common(before, rows[0][1])
        self.after = -1 if after is None else common(after, rows[-1][1])
        held: dict[tuple[int, bytes], bytearray] = {}
        ended: dict[int, bytearray] = {}
        size = (len(rows) + 7) // 8
        for at, (_, tags, _) in enumerate(rows):
            for position in (*enumerate(tags), None):
                index, key = (held, position) if position else (ended, len(tags))
                if (found := index.get(key)) is None:
                    found = index[key] = bytearray(size)
                found[at >> 3] |= 1 << (at & 7)
        self.held = {k: int.from_bytes(v, "little") for k, v in held.items()}
        self.ended = {k: int.from_bytes(v, "little") for k, v in ended.items()}
        self.keys = {}
        for end, depth in ((0, self.before), (-1, self.after)):
            key = hashlib.sha256()
            for d in range(depth + 1):
                if d:
                    key.update(rows[end][1][d - 1])
                self.keys[end, d] = key.digest()

    def nodes(self) -> list[dict]:
        """All nodes, children after their parents; sums are over this shard."""
        last = 1 << (len(self.rows) - 1)
        found: list[dict] = []
        stack = [((1 << len(self.rows)) - 1, 0, -1)]
        while stack:
            members, depth, parent = stack.pop()
            ends = members & self.ended.get(depth, 0)
            first = (members & -members).bit_length() - 1
            ids = [self.rows[i][0] for i in bits(ends)]
            seen_before = depth <= self.before and members & 1
            seen_after = depth <= self.after and members & last
            words = self.rows[first][2][depth - 1] if depth else 0
            n = members.bit_count()
            node = {
                "key": self.keys[0, depth] if seen_before else self.keys[-1, depth] if seen_after else None,
                "parent_key": found[parent]["key"] if depth else None,
                "conv_id": min(ids, default=None),
                "depth": depth,
                "n_convs": n,
                "n_children": 0,
                "n_leaves": int(ends == members and not seen_after),
                # (members - 1) * words, of which the 1 counts where the node is first seen
                "saved": n * words - (0 if seen_before else words),
                "ends": ids,
                "parent": parent,
            }
            if depth and not seen_before:
                found[parent]["n_children"] += 1
            found.append(node)
            rest = members ^ ends
            while rest:
                low = rest & -rest
                child = rest & self.held[depth, self.rows[low.bit_length() - 1][1][depth]]
                stack.append((child, depth + 1, len(found) - 1))
                rest ^= child
        for node in reversed(found):
            if (parent := node["parent"]) >= 0:
                above = found[parent]
                above["n_leaves"] += node["n_leaves"]
                above["saved"] += node["saved"]
                above["conv_id"] = node["conv_id"] if above["conv_id"] is None else min(above["conv_id"], node["conv_id"])
        for node in found:
            parent = node.pop("parent")
            node["parent_conv_id"] = found[parent]["conv_id"] if parent >= 0 else None
        return found


def _walked(batches: Iterator[pa.RecordBatch], most: int, most_turns: int) -> Iterator[pa.RecordBatch]:
    """Rows of a range in order, between the conversations before and after it; the nodes of its shards."""
    names = [part.split()[0] for part in NODE.split(", ")]
    kinds = [pa.list_(pa.int64()) if n == "ends" else pa.binary() if n.endswith("key") else pa.int64() for n in names]
    rows, turns, before, chunk, shard = [], 0, None, None, 0

    def walked(after: list[bytes] | None) -> Iterator[pa.RecordBatch]:
        nonlocal rows, turns, before, shard
        if rows:
            nodes = [node | {"place": chunk, "shard": shard} for node in Shard(rows, before, after).nodes()]
            for start in range(0, len(nodes), 4096):
                part = nodes[start : start + 4096]
                yield pa.RecordBatch.from_arrays([pa.array([n[c] for n in part], k) for c, k in zip(names, kinds, strict=True)], names)
            before, rows, turns, shard = rows[-1][1], [], 0, shard + 1

    for batch in batches:
        for row in batch.to_pylist():
            tags = [t["tag"] for t in row["turns"]]
            if row[CHUNK] != chunk:
                yield from walked(None)
                chunk, shard, before = row[CHUNK], 0, None
            if row["kind"] == 0:
                before = tags
                continue
            if row["kind"] == 2 or len(rows) == most or turns + len(tags) > most_turns:
                yield from walked(tags)
            if row["kind"] == 1:
                rows.append((row["conv_id"], tags, [t["words"] for t in row["turns"]]))
                turns += len(tags)
    yield from walked(None)


def prefix_trie(listed: DataFrame, shard: int = SHARD, shard_turns: int = SHARD_TURNS) -> tuple[DataFrame, DataFrame]:
    """Nodes and end lists of the trie of ``(conv_id, turns)``, as ``sequences`` gives them.

    Nodes are ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens)``. A
    node is named by its smallest member and its depth: its beginning is the first ``depth`` turns
    of that conversation. The root has depth 0 and no parent. ``n_leaves`` and ``saved_tokens`` are
    sums over the node's subtree, the latter of (members - 1) * words of the last turn.

    End lists are ``(conv_id, depth, place, shard, ends)``: ids of the conversations that end at a
    node, ascending in the order of place and shard; a list is bounded by a shard.

    A conversation without turns ends at the root. No conversations give no rows, an absent id takes no
    part, a repeated id is a member each time. A conversation's tags have to fit in a task.
    """
    there = listed.where("conv_id IS NOT NULL").select("conv_id", "turns")
    tagged = there.withColumn("tags", F.transform("turns", lambda t: t["tag"]))
    ranged = ordered_chunks(tagged, ["tags", "conv_id"])
    order = F.struct("tags", "conv_id")
    # one row per range: the window below sees no more than there are ranges
    edges = ranged.groupBy(CHUNK).agg(F.min(order)["tags"].alias("low"), F.max(order)["tags"].alias("high"))
    across = Window.orderBy(CHUNK)
    edges = edges.select(CHUNK, F.lag("high").over(across).alias("before"), F.lead("low").over(across).alias("after"))
    bare = lambda tags: F.transform(tags, lambda t: F.struct(t.alias("tag"), F.lit(0).cast("long").alias("words")))
    around = edges.select(
        CHUNK, F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("before").alias("tags")), F.struct(F.lit(2).alias("kind"), F.col("after").alias("tags")))).alias("edge")
    ).where("edge.tags IS NOT NULL")
    around = around.select(CHUNK, "edge.kind", F.lit(None).cast("long").alias("conv_id"), "edge.tags", bare(F.col("edge.tags")).alias("turns"))
    rows = ranged.select(CHUNK, F.lit(1).alias("kind"), "conv_id", "tags", "turns").unionByName(around)
    rows = rows.repartition(CHUNK).sortWithinPartitions(CHUNK, "kind", "tags", "conv_id").drop("tags")
    with arrow_batches(listed.sparkSession):
        walked = cut(rows.mapInArrow(lambda batches: _walked(batches, shard, shard_turns), NODE))
    discard(ranged)

    several = walked.where("key IS NOT NULL").groupBy("key")
    shared = cut(
        several.agg(
            F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        )
    )
    named = shared.select("key", F.col("conv_id").alias("named"))
    above = named.select(F.col("key").alias("parent_key"), F.col("named").alias("above"))
    counts = ["depth", "n_convs", "n_children", "n_leaves", "saved"]
    alone = walked.where("key IS NULL")
    below = alone.where("parent_key IS NOT NULL").select("conv_id", "parent_key", *counts)
    below = below.unionByName(shared.where("parent_key IS NOT NULL").select("conv_id", "parent_key", *counts))
    # finished in their shard, or the root
    apart = alone.where("parent_key IS NULL").select("conv_id", F.col("parent_conv_id").alias("above"), *counts)
    root = shared.where("parent_key IS NULL").select("conv_id", F.lit(None).cast("long").alias("above"), *counts)
    nodes = below.join(above, "parent_key").drop("parent_key").unionByName(apart).unionByName(root)
    nodes = nodes.select(
        "conv_id", "depth", F.col("above").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
    )
    ending = walked.where(F.size("ends") > 0).select("key", "conv_id", "depth", "place", "shard", "ends")
    across = ending.where("key IS NOT NULL").drop("conv_id").join(named, "key").withColumnRenamed("named", "conv_id")
    return nodes, ending.where("key IS NULL").drop("key").unionByName(across.drop("key"))


def ends_digest(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """``nodes`` with ``ends_sha256``: of the ids that end there, decimal and joined by commas."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        done: list[tuple[int, int, str]] = []

        def listed() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [(), (), ()]
            done.clear()
            kinds = (pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", "depth", "ends_sha256"])

        for batch in batches:
            for row in batch.to_pylist():
                node = (row["conv_id"], row["depth"])
                if node != at:
                    if at:
                        done.append((*at, digest.hexdigest()))
                    at, digest = node, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(",".join(map(str, row["ends"])).encode())
            yield listed()
        if at:
            done.append((*at, digest.hexdigest()))
        yield listed()

    rows = ends.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "place", "shard")
    with arrow_batches(nodes.sparkSession):
        found = cut(rows.mapInArrow(digested, "conv_id long, depth long, ends_sha256 string"))
    none = hashlib.sha256().hexdigest()
    return nodes.join(found, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none)))

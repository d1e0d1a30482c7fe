"""Personal data: patterns of form, and contextual patterns bootstrapped from what they find.

Four regular expressions give the base: emails, IP addresses, card and phone numbers. They are
seeds. The words around a seed make lexical patterns (two words before it; one before and one
after), and other tokens that look like an identifier of a kind occur in such patterns too. Pattern
and instance score each other on the graph of the two: a pattern by the trust in its instances, an
instance by its patterns. A pattern is believed when its share of trusted instances is high and
significantly over what the kind has in any context; it then marks the unseen identifiers in it.

All of it is DataFrame operations, and the work on a text grows with its length and its matches. A
text is read once; from then on only its matches move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adoptrend.llm.base import once, whole
from adoptrend.operators.temporal import overlap_join
from adoptrend.session import cut, discard

KINDS = ("email", "ip", "card", "phone")

# The four forms. Runs are possessive and start where the one before ends, so that a long run is
# read once; the matches are those of the plain expressions.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# a token that may be an identifier: a digit or an at sign in it
TOKEN = r"(?<![^\s])[^\s0-9@]*+[0-9@][^\s]*+"
# groups of digits joined by single spaces, signs and brackets: a number as people write it
GROUPS = r"(?<![0-9A-Za-z_@])\(?[0-9]++(?:(?:\)[\x20.-]?|[\x20.-]?\(|[\x20.-])[0-9]++)++"
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"

# characters of context on each side of a match, or of what lies within so many other matches; a word that
# doesn't end there is no context
CONTEXT = 96
REACH = 24
# matches whose lengths are added up in one go
BLOCK = 128
# trusted instances a pattern needs, its share of them, and the likelihood ratio against the kind's share anywhere
SUPPORT = 3
CONFIDENT = 0.8
EVIDENCE = 6.6
ROUNDS = 3

# what may stand between an identifier and the words around it
OPENING = "\"'(<[{"
CLOSING = "\"')>]},.;:!?"

MATCH = "array<struct<start:int,value:string,before:string,after:string>>"
NAMES = (*KINDS, "token", "group")


def searched(read: DataFrame) -> DataFrame:
    """``read(.., body)`` with all matches of each expression as a column of ``NAMES``; the body goes.

    Every column is an array of (start, value, before, after), leftmost and non-overlapping, offsets
    in code points. Starts are running sums of the lengths of matches and of what is between them,
    by blocks; what is around a match is put together from its neighbours, so no match reads the
    whole text again. Steps are computed once each, in the order in which they need each other.
    """
    body, none = F.col("body"), F.array().cast("array<string>")
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "token": TOKEN, "group": GROUPS}
    there = {
        "email": body.contains("@"), "ip": body.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), "card": body.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"),
        "phone": body.contains("+"), "token": body.rlike("[0-9@]"), "group": body.rlike("[0-9]"),
    }

    def step(df: DataFrame, gone: str, **columns) -> DataFrame:
        done = once(df, **{f"{name}_{n}": of(n) for name, of in columns.items() for n in NAMES})
        return done.drop(*[f"{name}_{n}" for name in gone.split() for n in NAMES])

    def col(name: str, n: str) -> Column:
        return F.col(f"{name}_{n}")

    # a text that fails a cheap test has no match
    read = step(
        read, "",
        values=lambda n: F.when(there[n], F.regexp_extract_all(body, F.lit(patterns[n]), F.lit(0))).otherwise(none),
        gaps=lambda n: F.when(there[n], F.split(body, patterns[n], -1)).otherwise(none),
    ).drop("body")
    read = step(
        read, "",
        lengths=lambda n: F.zip_with(col("gaps", n), col("values", n), lambda g, v: F.length(g) + F.length(v)),
        left=lambda n: F.zip_with(col("gaps", n), col("values", n), lambda g, v: F.right(F.concat(g, F.coalesce(v, F.lit(""))), F.lit(CONTEXT + 1))),
        right=lambda n: F.zip_with(col("gaps", n), col("values", n), lambda g, v: F.left(F.concat(g, F.coalesce(v, F.lit(""))), F.lit(CONTEXT + 1))),
    )

    def sums(lengths: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("sums"))
        return F.aggregate(
            lengths, start,
            lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["sums"], F.array(a["sum"] + x)).alias("sums")),
            lambda a: a["sums"],
        )

    def blocks(n: str) -> Column:
        firsts = F.sequence(F.lit(1), F.size(col("values", n)), F.lit(BLOCK))
        summed = F.transform(firsts, lambda first: sums(F.slice(col("lengths", n), first, F.least(F.lit(BLOCK), F.size(col("values", n)) - first + 1))))
        return F.when(F.size(col("values", n)) > 0, summed).otherwise(F.array().cast("array<array<int>>"))

    read = step(read, "lengths", blocks=blocks)
    read = step(read, "", upto=lambda n: sums(F.transform(col("blocks", n), lambda b: F.element_at(b, -1))))
    read = step(
        read, "blocks upto",
        ends=lambda n: F.flatten(
            F.transform(col("blocks", n), lambda b, i: F.transform(b, lambda x: x + F.coalesce(F.get(col("upto", n), i - 1), F.lit(0))))
        ),
    )

    def found(n: str) -> Column:
        def placed(v: Column, i: Column) -> Column:
            first = F.greatest(i - REACH, F.lit(0))
            before = F.concat(F.array_join(F.slice(col("left", n), first + 1, i - first), ""), F.get(col("gaps", n), i))
            after = F.array_join(F.slice(col("right", n), i + 2, REACH), "")
            return F.struct(
                (F.get(col("ends", n), i) - F.length(v)).alias("start"), v.alias("value"), *around(before, after)
            )

        return F.transform(col("values", n), placed)

    done = once(read, **{n: found(n) for n in NAMES})
    return done.drop(*[f"{name}_{n}" for name in ("values", "gaps", "left", "right", "ends") for n in NAMES])


def around(before: Column, after: Column) -> list[Column]:
    """Both sides of a match within ``CONTEXT``, in whole words, without brackets and stops next to the match."""
    before, after = F.right(before, F.lit(CONTEXT + 1)), F.left(after, F.lit(CONTEXT + 1))
    before = F.when(F.length(before) > CONTEXT, F.regexp_replace(before, r"^\S+", "")).otherwise(before)
    after = F.when(F.length(after) > CONTEXT, F.regexp_replace(after, r"\S+$", "")).otherwise(after)
    return [F.rtrim(before, F.lit(OPENING)).alias("before"), F.ltrim(after, F.lit(CLOSING)).alias("after")]


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def forms() -> Column:
    """The base from the matches of the four forms: array of (start, kind, end, value, before, after), by start, then kind."""
    right = (
        lambda v: F.lit(True),
        lambda v: v.rlike(rf"^(?:{BYTE}\.){{3}}{BYTE}$"),
        lambda v: F.length(digits(v)).between(12, 19) & F.call_function("luhn_check", digits(v)),
        lambda v: F.length(digits(v)).between(9, 15),
    )

    def kept(kind: int) -> Column:
        return F.transform(
            F.filter(F.col(KINDS[kind]), lambda m: right[kind](m["value"])),
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(kind).alias("kind"), (m["start"] + F.length(m["value"])).alias("end"),
                m["value"].alias("value"), m["before"].alias("before"), m["after"].alias("after"),
            ),
        )

    return F.array_sort(F.concat(*[kept(kind) for kind in range(len(KINDS))]))


def candidates() -> Column:
    """What looks like an identifier: array of (start, end, value, before, after, kinds, group).

    Tokens, and numbers written in groups; a token that is part of such a number is a candidate, too.
    """

    def placed(m: Column, start: Column, value: Column, kinds: list[Column], group: bool) -> Column:
        return F.struct(
            start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"), m["before"].alias("before"),
            m["after"].alias("after"), F.array_compact(F.array(*kinds)).alias("kinds"), F.lit(group).alias("group"),
        )

    def core(m: Column) -> Column:
        opened = F.ltrim(m["value"], F.lit(OPENING))
        value, n = F.rtrim(opened, F.lit(CLOSING)), F.length(digits(m["value"]))
        kinds = [
            F.when(value.rlike("^[^@]+@[^@]+$"), F.lit(0)),
            F.when(value.rlike("^[0-9a-fA-F]{1,4}(?:[.:][0-9a-fA-F]{0,4}){3,7}$"), F.lit(1)),
            F.when(value.rlike("^[0-9-]+$") & n.between(12, 19), F.lit(2)),
            F.when(value.rlike("^[0-9().-]+$") & n.between(7, 15), F.lit(3)),
        ]
        return placed(m, m["start"] + F.length(m["value"]) - F.length(opened), value, kinds, False)

    def grouped(m: Column) -> Column:
        alone = m["value"].startswith("(") & ~m["value"].contains(")")  # its other bracket is behind the number
        value, n = F.when(alone, F.substring(m["value"], 2, 1 << 30)).otherwise(m["value"]), F.length(digits(m["value"]))
        kinds = [F.when(value.rlike("^[0-9\\x20.-]+$") & n.between(12, 19), F.lit(2)), F.when(n.between(7, 15), F.lit(3))]
        return placed(m, m["start"] + alone.cast("int"), value, kinds, True)

    every = F.concat(F.transform("token", core), F.transform("group", grouped))
    return F.filter(every, lambda c: F.size(c["kinds"]) > 0)


def outside(read: DataFrame) -> DataFrame:
    """Candidates that don't overlap the base, a row each: (row, start, end, m); of a token and an equal group the token."""
    others = read.select("row", F.explode("others").alias("m")).groupBy("row", "m.start", "m.end").agg(F.min_by("m", "m.group").alias("m"))
    base = read.where(F.size("others") > 0).select("row", F.explode("base").alias("b")).select("row", "b.start", "b.end")
    both = others.withColumn("base", F.lit(False)).unionByName(base.withColumn("base", F.lit(True)), allowMissingColumns=True)
    # from the left the last end of a base span that starts no later, from the right the next start
    last = F.max(F.when(F.col("base"), F.col("end"))).over(Window.partitionBy("row").orderBy("start"))
    next_ = F.min(F.when(F.col("base"), F.col("start"))).over(Window.partitionBy("row").orderBy(F.col("start").desc()))
    told = both.withColumn("_last", last).withColumn("_next", next_)
    free = (F.coalesce("_last", F.lit(0)) <= F.col("start")) & (F.coalesce("_next", F.col("end")) >= F.col("end"))
    return told.where(~F.col("base") & free).select("row", "start", "end", "m")


def longest(spans: DataFrame) -> DataFrame:
    """Rows (row, start, end, ..) without those that overlap a longer one; of equally long ones the first stays."""
    placed = spans.select("row", "start", "end", (F.col("end") - 1).alias("last"))
    period = ("start", "last")
    pairs = overlap_join(placed, placed, ["row"], period, period, width=32)
    wider = (F.col("r.end") - F.col("r.start")) - (F.col("l.end") - F.col("l.start"))
    lost = pairs.where((wider > 0) | ((wider == 0) & (F.col("r.start") < F.col("l.start")))).select("l.row", "l.start", "l.end").distinct()
    return spans.join(lost, ["row", "start", "end"], "left_anti")


def contexts(before: Column, after: Column) -> Column:
    """The lexical patterns around a match: its two words before, and the words next to it."""

    def words(text: Column) -> Column:
        return F.filter(F.split(F.regexp_replace(F.lower(text), "[0-9]+", "0"), r"\s+"), lambda w: w != "")

    left, right = words(before), words(after)
    near, far, next_ = F.try_element_at(left, F.lit(-1)), F.try_element_at(left, F.lit(-2)), F.try_element_at(right, F.lit(1))
    return F.array_compact(F.array(F.concat(far, F.lit(" "), near, F.lit(" _")), F.concat(near, F.lit(" _ "), next_)))


def scanned(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(row, doc_id, base, others)``: everything later steps need of a text, written to the shared folder."""
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), whole(text).alias("body"))
    return cut(searched(read).select("row", "doc_id", forms().alias("base"), candidates().alias("others")))


def mentions(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Seeds and candidates, one row for each kind and pattern: (row, start, end, kind, value, pattern)."""
    seeds = read.select("row", F.explode("base").alias("m")).select("row", "m.*")
    others = outside(read).select("row", "m.*").withColumn("kind", F.explode("kinds"))

    def placed(found: DataFrame) -> DataFrame:
        return found.select(
            "row", "start", "end", "kind", F.lower("value").alias("value"), F.explode(contexts(F.col("before"), F.col("after"))).alias("pattern")
        )

    return placed(seeds), cut(placed(others))


def believed(seeds: DataFrame, others: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(kind, pattern, score)`` of the patterns to trust, from ``rounds`` rounds over the graph.

    A pattern needs ``SUPPORT`` instances of different values, so the copies of a document don't
    speak for it, and those that can't have them are dropped before the first round.
    """
    edges = (
        seeds.select("kind", "pattern", "value", F.lit(1).alias("seed"))
        .unionAll(others.select("kind", "pattern", "value", F.lit(0).alias("seed")))
        .groupBy("kind", "pattern", "value")
        .agg(F.max("seed").alias("seed"))
    )
    edges = cut(edges)
    values = edges.groupBy("kind", "value").agg(F.max("seed").alias("seed"))
    anywhere = cut(
        values.groupBy("kind").agg(((F.sum("seed") + F.lit(1.0)) / (F.count("*") + F.lit(2.0))).alias("usual"))
    )  # a row for each kind
    wide = edges.groupBy("kind", "pattern").agg(F.count("*").alias("n")).where(F.col("n") >= SUPPORT).select("kind", "pattern")
    graph = cut(edges.join(wide, ["kind", "pattern"], "left_semi").select("kind", "pattern", "value"))
    trust = cut(values.select("kind", "value", "seed", F.col("seed").cast("double").alias("trust")))

    def rated(trust: DataFrame) -> DataFrame:
        scores = graph.join(trust, ["kind", "value"]).groupBy("kind", "pattern").agg(
            F.count("*").alias("n"), F.sum("trust").alias("trusted")
        )
        return scores.where(F.col("trusted") >= SUPPORT).withColumn("score", F.col("trusted") / (F.col("n") + 1))

    for _ in range(rounds - 1):
        doubt = graph.join(rated(trust), ["kind", "pattern"]).groupBy("kind", "value").agg(
            F.sum(F.log(F.lit(1.0) - F.col("score"))).alias("doubt")
        )
        trust = cut(
            trust.join(doubt, ["kind", "value"], "left").select(
                "kind", "value", "seed",
                F.when(F.col("seed") == 1, 1.0).otherwise(F.lit(1.0) - F.exp(F.coalesce("doubt", F.lit(0.0)))).alias("trust"),
            )
        )
    share = F.least(F.greatest(F.col("trusted") / F.col("n"), F.lit(1e-9)), F.lit(1 - 1e-9))
    ratio = 2 * F.col("n") * (
        share * F.log(share / F.col("usual")) + (F.lit(1.0) - share) * F.log((F.lit(1.0) - share) / (F.lit(1.0) - F.col("usual")))
    )
    return (
        rated(trust)
        .join(F.broadcast(anywhere), "kind")
        .where((F.col("score") >= CONFIDENT) & (share > F.col("usual")) & (ratio >= EVIDENCE))
        .select("kind", "pattern", "score")
    )


def personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, base, spans)``, one row per input row; both are arrays of (start, kind, end).

    Offsets count code points, the end is exclusive, kinds are positions in ``KINDS``, and spans are
    in order of start, then kind. ``base`` has the spans of the four forms, ``spans`` those that
    believed patterns add, too. An absent text is empty and has none; rows repeated are judged each,
    but their instances count once; no rows give no rows.
    """
    read = scanned(docs, text, doc_id)
    seeds, others = mentions(read)
    trusted = cut(believed(seeds, others, rounds))
    best = cut(
        others.join(trusted, ["kind", "pattern"])
        .groupBy("row", "start", "end")
        .agg(F.max(F.struct("score", (-F.col("kind")).alias("kind"))).alias("best"))
    )
    added = longest(best).groupBy("row").agg(
        F.collect_list(F.struct("start", (-F.col("best.kind")).alias("kind"), "end")).alias("added")
    )
    added = cut(added)
    discard(others, trusted, best)
    base = F.transform("base", lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end")))
    every = F.when(F.col("added").isNull(), base).otherwise(F.array_sort(F.concat(base, F.col("added"))))
    return read.join(added, "row", "left").select("doc_id", base.alias("base"), every.alias("spans"))


def listed(spans: str) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def count_of(kind: str, spans: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")

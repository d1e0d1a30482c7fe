"""URL filter: rules first, then a tree of path templates for each host.

The tree is built from the distinct generalised paths of each host, all levels in one aggregation.
A segment with digits is generalised by its form at once. A branch point where most pages have a
segment of their own becomes a wildcard, and what is below is pooled and looked at again; of the
labelled branches beside each other, those whose share of bad pages is like the share of all of
them are merged.

Evidence is inherited. The tree goes on above the hosts, through their parent domains. What is
expected at a node is the mean of its labelled branches, each one vote however many pages and hosts have
it, smoothed towards the node above, and from ``EXPECTED`` at the top. The branches of a domain are
the first segments on all its hosts; a node with as many branches as the next one on the way is passed
over, so that none is heard twice. A template's purity is its labelled share of bad pages, smoothed
towards the node it hangs on. So a template without labels is judged by the nearest branches that
have some: it is rejected where several around it are bad, while one bad branch, on however many
hosts, isn't held against its neighbours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adoptrend.llm.base import once
from adoptrend.session import cut

# fixed values: the rules of the registered query, (verdict, host and path)
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# a branch point is variable from so many branches on, if they are over this share of its pages
BRANCHES = 8
OWN_SHARE = 0.5
# branches are alike within so many standard deviations of a binomial share
ALIKE = 2.0
# times that wildcards are looked for: those that pooling makes variable are found in the next pass
PASSES = 3
# the share of bad pages expected where nothing is known, the weight of what is inherited, and the purity that rejects
EXPECTED = 0.1
PRIOR = 2.0
REJECT = 0.5


def host(url: Column) -> Column:
    """What is between the first ``://`` and the path, query, fragment or end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null where none does."""
    found = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, start = rule[: rule.index("/")], rule[rule.index("/") :]
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        found.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    nothing = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*found, nothing)


def segments(path: Column) -> Column:
    """The segments of a path; those with digits by their form."""

    def form(s: Column) -> Column:
        hexadecimal = s.rlike("^[0-9a-fA-F-]{8,}$") & s.rlike("[0-9]")
        return F.when(hexadecimal, F.lit("#")).otherwise(F.regexp_replace(s, "[0-9]+", "0"))

    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), form)


def _beginnings(segs: Column) -> Column:
    """A digest for each beginning of a path, from the digest of the one before."""
    start = F.struct(F.lit("").alias("at"), F.array().cast("array<string>").alias("found"))

    def longer(seen: Column, seg: Column) -> Column:
        at = F.md5(F.concat(seen["at"], F.lit("/"), seg).cast("binary"))
        return F.struct(at.alias("at"), F.concat(seen["found"], F.array(at)).alias("found"))

    return F.aggregate(segs, start, longer, lambda seen: seen["found"])


def _places(paths: DataFrame) -> DataFrame:
    """A row for each segment of ``now``: what is above it, its position and itself."""
    marked = once(paths, _begun=_beginnings(F.col("now")))
    placed = marked.select("*", F.posexplode("now").alias("i", "seg"))
    return placed.withColumn("above", F.coalesce(F.get("_begun", F.col("i") - 1), F.lit(""))).drop("_begun")


def _branches(paths: DataFrame) -> DataFrame:
    """A row for each branch of the tree: (host, above, seg, n, labelled, bad)."""
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
    return _places(paths).groupBy("host", "above", "seg").agg(*sums)


def _renamed(paths: DataFrame, names: DataFrame, on: list[str]) -> DataFrame:
    """``paths`` with the segments that ``names(on..., name)`` has another name for."""
    told = (
        _places(paths)
        .join(names, on, "left")
        .groupBy("host", "segs")
        .agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("name", "seg").alias("name")))).alias("new"))
    )
    now = F.coalesce(F.transform("new", lambda x: x["name"]), F.col("now"))
    return paths.join(told, ["host", "segs"], "left").withColumn("now", now).drop("new")


def templates(paths: DataFrame) -> DataFrame:
    """``(host, segs, purity)`` of the distinct ``(host, segs)`` with ``n`` pages, ``labelled`` and ``bad`` ones.

    Rows grow with the segments of the paths; the digests of a path's beginnings, with its square.
    """
    paths = paths.withColumn("now", F.col("segs"))
    many = F.col("branches") >= BRANCHES
    for _ in range(PASSES):
        points = _branches(paths).groupBy("host", "above").agg(F.count("*").alias("branches"), F.sum("n").alias("pages"))
        variable = cut(
            points.where(many & (F.col("branches") > F.lit(OWN_SHARE) * F.col("pages"))).select(
                "host", "above", F.lit("*").alias("name")
            )
        )
        # a wildcard pools what is below it, which may be variable in turn
        if variable.isEmpty():
            break
        paths = cut(_renamed(paths, variable, ["host", "above"]))

    branches = cut(_branches(paths))
    labelled = branches.where(F.col("labelled") > 0)
    beside = labelled.groupBy("host", "above").agg((F.sum("bad") / F.sum("labelled")).alias("share"), F.count("*").alias("kinds"))
    apart = F.abs(F.col("bad") - F.col("labelled") * F.col("share"))
    spread = F.sqrt(F.col("labelled") * F.col("share") * (F.lit(1.0) - F.col("share")))
    alike = labelled.join(beside.where("kinds > 1"), ["host", "above"]).where(apart <= F.lit(ALIKE) * spread)
    paths = _renamed(paths, alike.select("host", "above", "seg", F.lit("+").alias("name")), ["host", "above", "seg"])

    paths = cut(paths)
    sums = [F.sum(c).cast("double").alias(c) for c in ("labelled", "bad")]
    rated = _inherited(cut(paths.groupBy("host", "now").agg(*sums)))
    return paths.join(rated, ["host", "now"]).select("host", "segs", "purity")


def _inherited(trees: DataFrame) -> DataFrame:
    """``(host, now, purity)`` from the templates ``(host, now, labelled, bad)``."""
    names = F.split("host", r"\.")
    domains = F.transform(names, lambda _, i: F.concat_ws(".", F.slice(names, F.size(names) - i, i + 1)))
    # the nodes a template hangs on: its domains, shortest first, and the beginnings of its path
    inner = F.transform(F.slice(F.col("_begun"), 1, F.greatest(F.size("now") - 1, F.lit(0))), lambda b: F.concat("host", F.lit("/"), b))
    marked = once(trees, _begun=_beginnings(F.col("now")))
    chained = marked.select("host", "now", "labelled", "bad", F.size(names).alias("d"), F.posexplode(F.concat(domains, inner)).alias("i", "node"))
    branch = F.coalesce(F.get("now", F.greatest(F.col("i") - F.col("d") + 1, F.lit(0))), F.lit("")).alias("branch")
    share = (F.sum("bad") / F.sum("labelled")).alias("share")
    votes = chained.where("labelled > 0").groupBy("node", branch).agg(share).groupBy("node").agg(F.sum("share").alias("sum"), F.count("*").alias("votes"))
    told = chained.join(cut(votes), "node").groupBy("host", "now").agg(F.array_sort(F.collect_list(F.struct("i", "sum", "votes"))).alias("chain"))
    heard = F.filter("chain", lambda x, i: x["votes"] != F.coalesce(F.get("chain", i + 1)["votes"], F.lit(0)))
    expected = F.aggregate(heard, F.lit(EXPECTED), lambda p, x: (x["sum"] + F.lit(PRIOR) * p) / (x["votes"] + F.lit(PRIOR)))
    from_above = F.coalesce(expected, F.lit(EXPECTED))
    purity = (F.col("bad") + F.lit(PRIOR) * from_above) / (F.col("labelled") + F.lit(PRIOR))
    return trees.join(told, ["host", "now"], "left").select("host", "now", purity.alias("purity"))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, label: Column | None = None, url: str = "url", page_id: str = "page_id") -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, one row per row of ``pages``.

    A rule that fits decides; else the purity of the page's template does. ``label`` is 1 for bad
    pages, 0 for good ones and null for unknown; by default the rules label the pages they fit. A
    url that is absent or has no ``://`` has an empty host and path, and is a template of its own.
    Rows repeated count as pages each; no rows give no rows.
    """
    parts = pages.select(
        F.col(page_id).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"),
        *([] if label is None else [label.cast("long").alias("label")]),
    )
    ruled = parts.withColumn("by", rule_of(F.col("host"), F.col("path"), rules)).withColumn("segs", segments(F.col("path")))
    if label is None:
        ruled = ruled.withColumn("label", (F.col("by.verdict") == "block").cast("long"))
    paths = ruled.groupBy("host", "segs").agg(
        F.count("*").alias("n"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad")
    )
    rated = templates(cut(paths))
    verdict = F.when(F.col("purity") > REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return ruled.join(rated, ["host", "segs"]).select(
        "page_id", "host", "path", F.col("by.rule").alias("rule"), F.coalesce("by.verdict", verdict).alias("verdict")
    )

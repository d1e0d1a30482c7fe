"""Tables behind the charts: rankings, distributions and profiles of actors and communities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adoptrend.functions.text import owner
from adoptrend.operators.ordered import exact_quantiles
from adoptrend.operators.sketches import quantiles_of

DEGREE_BANDS = ("0", "1-2", "3-8", "9+")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per column."""
    rows = []
    for c in columns:
        moments = df.agg(
            F.count(c).alias("n"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("sd"),
            F.min(c).cast("double").alias("lowest"),
            F.max(c).cast("double").alias("highest"),
        ).withColumn("column", F.lit(c))
        quartiles = exact_quantiles(df, c, (0.25, 0.5, 0.75)).withColumn("column", F.lit(c))
        rows.append(moments.join(quartiles, "column"))
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


QUARTILES = (0.25, 0.5, 0.75)


def describe_once(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles, one row per column, from one pass over the rows.

    Quartiles come from sketches: their rank is right within ``sketches.RANK_ERROR``. Absent values don't count.
    """
    measures = {"n": F.count, "mean": F.avg, "sd": F.stddev_samp, "lowest": F.min, "highest": F.max}
    moments = [f(c).cast("long" if m == "n" else "double").alias(f"{m}_{i}") for i, c in enumerate(columns) for m, f in measures.items()]
    told = [F.kll_sketch_agg_double(F.col(c).cast("double")).alias(f"sketch_{i}") for i, c in enumerate(columns)]
    row = df.agg(*moments, *told)
    listed = [
        F.struct(
            F.lit(c).alias("column"), *[F.col(f"{m}_{i}").alias(m) for m in measures], quantiles_of(f"sketch_{i}", QUARTILES).alias("q")
        )
        for i, c in enumerate(columns)
    ]
    described = row.select(F.inline(F.array(*listed)))
    return described.select("column", *measures, *[F.get("q", F.lit(i)).alias(f"q{round(p * 100)}") for i, p in enumerate(QUARTILES)])


def ranks_within(df: DataFrame, described: DataFrame, error: float) -> DataFrame:
    """``(column, n, lowest, highest, within)``: whether the quartiles of ``described`` have their ranks, but for ``error``."""
    found = {r["column"]: [r[f"q{round(p * 100)}"] for p in QUARTILES] for r in described.collect()}  # a row per column
    checks = []
    for i, (c, values) in enumerate(found.items()):
        right = F.lit(True)
        for p, q in zip(QUARTILES, values, strict=True):
            below, upto = (F.try_divide(F.count_if(x), F.count(c)) for x in (F.col(c) < F.lit(q), F.col(c) <= F.lit(q)))
            right = right & (below - error <= p) & (upto + error >= p)
        checks.append(F.struct(F.lit(c).alias("column"), F.coalesce(right, F.lit(True)).alias("within")).alias(f"c{i}"))
    told = df.agg(*checks).select(F.inline(F.array(*[f"c{i}" for i in range(len(checks))])))
    return described.select("column", "n", "lowest", "highest").join(told, "column")


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """Equal-width bins between the extremes; the last one is closed."""
    values = df.select(value.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    span = values.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi"))).scalar()
    spot = F.floor((F.col("_v") - F.col("_span.lo")) / (F.col("_span.hi") - F.col("_span.lo")) * bins)
    bin_no = F.when(F.col("_span.hi") > F.col("_span.lo"), F.least(spot, F.lit(bins - 1))).otherwise(0).cast("int")
    width = (F.col("_hi") - F.col("_lo")) / bins
    return (
        values.withColumn("_span", span)
        .groupBy(bin_no.alias("bin"))
        .agg(F.count("*").alias("n"), F.max("_span.lo").alias("_lo"), F.max("_span.hi").alias("_hi"))
        .select("bin", (F.col("_lo") + width * F.col("bin")).alias("from_value"), "n")
    )


def degree_distribution(degrees: DataFrame) -> DataFrame:
    return degrees.groupBy("degree").agg(F.count("*").alias("actors"))


def degree_summary(degrees: DataFrame) -> DataFrame:
    return degrees.agg(
        F.count("*").alias("actors"),
        F.avg("degree").alias("mean_degree"),
        F.max("degree").alias("max_degree"),
        F.count_if(F.col("degree") == 0).alias("isolated"),
    )


def corr_fit(df: DataFrame, x: Column, y: Column) -> DataFrame:
    """Correlation and least-squares line of ``y`` on ``x``."""
    pairs = df.select(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return pairs.agg(
        F.corr("x", "y").alias("r"),
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.count("*").alias("n"),
    )


def influence_table(ranks: DataFrame, degrees: DataFrame, stats: DataFrame, betweenness: DataFrame | None = None) -> DataFrame:
    """What is known about each actor; no neighbours or no activity count as 0."""
    out = ranks.join(degrees, "id", "left").join(
        stats.select(F.col("dev_id").alias("id"), "distinct_repos", "total_commits"), "id", "left"
    )
    if betweenness is not None:
        out = out.join(betweenness, "id", "left").fillna(0.0, subset=["betweenness"])
    return out.fillna(0, subset=["degree", "distinct_repos", "total_commits"]).withColumnRenamed("id", "dev_id")


def legacy_influence(table: DataFrame) -> DataFrame:
    """The influence table under the column names existing readers expect."""
    return table.select(
        "dev_id",
        "pagerank",
        F.col("betweenness").alias("hub_score"),
        F.col("betweenness").alias("auth_score"),
        F.col("degree").cast("int").alias("degree"),
        "total_commits",
    )


def short_id(column: str = "dev_id") -> Column:
    return F.substring(column, 1, 12)


def top_influencers(table: DataFrame, n: int = 200) -> DataFrame:
    """Actors of highest rank, ids shortened for display."""
    ranked = table.orderBy(F.desc("pagerank"), "dev_id").limit(n)
    return ranked.select(short_id().alias("dev_short"), *[c for c in table.columns if c != "dev_id"])


def influence_search(table: DataFrame, text: str, sort_by: str = "pagerank", n: int | None = None) -> DataFrame:
    """Actors whose id contains ``text``, sorted by a chosen column."""
    found = table.where(F.lower("dev_id").contains(text.lower())).orderBy(F.desc(sort_by), "dev_id")
    return found if n is None else found.limit(n)


def rank_within(table: DataFrame, segments: DataFrame, k: int, value: str = "pagerank") -> DataFrame:
    """The ``k`` highest actors of each segment.

    Each task keeps only its own ``k`` per segment before anything is exchanged.
    """
    order = Window.partitionBy("community_id").orderBy(F.desc(value), "dev_id")
    return (
        table.join(segments.select("dev_id", "community_id"), "dev_id")
        .withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= k)
    )


def community_orgs(members: DataFrame, facts: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` owners a community touches most, as one text."""
    counted = (
        facts.select("dev_id", owner(F.col("repo_name")).alias("org"))
        .groupBy("dev_id", "org")
        .agg(F.count("*").alias("_n"))
        .join(members.select("dev_id", "community_id"), "dev_id")
        .groupBy("community_id", "org")
        .agg(F.sum("_n").alias("cnt"))
    )
    order = Window.partitionBy("community_id").orderBy(F.desc("cnt"), "org")
    best = counted.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= k)
    names = F.transform(F.sort_array(F.collect_list(F.struct("_at", "org"))), lambda s: s["org"])
    return best.groupBy("community_id").agg(F.array_join(names, ", ").alias("top_orgs"))


def community_profile(members: DataFrame, orgs: DataFrame | None = None) -> DataFrame:
    """Size, influence and connectedness per community, with a display label."""
    profile = members.groupBy("community_id").agg(
        F.count("*").alias("size"),
        F.sum("pagerank").alias("total_pagerank"),
        F.avg("pagerank").alias("mean_pagerank"),
        F.max("pagerank").alias("max_pagerank"),
        F.avg("degree").alias("mean_degree"),
    )
    if orgs is None:
        return profile
    label = F.concat(F.lit("C"), F.col("community_id"), F.lit(" ("), F.coalesce("top_orgs", F.lit("?")), F.lit(")"))
    return profile.join(orgs, "community_id", "left").withColumn("label", label)


def leading_communities(profile: DataFrame, n: int, by: str = "size", least: int = 1) -> DataFrame:
    return profile.where(F.col("size") >= least).orderBy(F.desc(by), "community_id").limit(n)


def size_summary(members: DataFrame) -> DataFrame:
    """Number, largest, median and singleton communities."""
    sizes = members.groupBy("community_id").agg(F.count("*").alias("size"))
    extremes = sizes.agg(
        F.count("*").alias("communities"),
        F.max("size").alias("largest"),
        F.count_if(F.col("size") == 1).alias("singletons"),
        F.sum("size").alias("members"),
    )
    median = exact_quantiles(sizes, "size", (0.5,)).select(F.col("q50").alias("median_size"))
    return extremes.withColumn("median_size", median.scalar())


def degree_bands(members: DataFrame, n: int = 10) -> DataFrame:
    """Members of the most influential communities by degree band, 0 where a band is empty."""
    leading = (
        members.groupBy("community_id")
        .agg(F.sum("pagerank").alias("_total"))
        .orderBy(F.desc("_total"), "community_id")
        .limit(n)
        .select("community_id")
    )
    band = (
        F.when(F.col("degree") <= 0, DEGREE_BANDS[0])
        .when(F.col("degree") <= 2, DEGREE_BANDS[1])
        .when(F.col("degree") <= 8, DEGREE_BANDS[2])
        .otherwise(DEGREE_BANDS[3])
    )
    return (
        members.join(leading, "community_id", "left_semi")
        .withColumn("band", band)
        .groupBy("community_id")
        .pivot("band", list(DEGREE_BANDS))
        .count()
        .fillna(0)
        .select("community_id", *[F.col(f"`{b}`").alias(f"band_{i}") for i, b in enumerate(DEGREE_BANDS)])
    )


def bridge_actors(members: DataFrame, n: int = 50) -> DataFrame:
    """Actors with most neighbours."""
    return (
        members.orderBy(F.desc("degree"), "dev_id")
        .limit(n)
        .select(short_id().alias("dev_short"), "community_id", "pagerank", "degree")
    )


def bridging(members: DataFrame, both_ways: DataFrame) -> DataFrame:
    """Number of different communities among each actor's neighbours."""
    labels = members.select(F.col("dev_id").alias("id"), "community_id")
    touched = (
        both_ways.join(labels.withColumnRenamed("id", "src"), "src")
        .groupBy(F.col("dst").alias("dev_id"))
        .agg(F.countDistinct("community_id").alias("communities_touched"))
    )
    return members.select("dev_id").join(touched, "dev_id", "left").fillna(0, subset=["communities_touched"])


def community_flow(before: DataFrame, after: DataFrame) -> DataFrame:
    """Members shared by each community of one period and each of the next."""
    a = before.select("dev_id", F.col("community_id").alias("from_community"))
    b = after.select("dev_id", F.col("community_id").alias("to_community"))
    return a.join(b, "dev_id").groupBy("from_community", "to_community").agg(F.count("*").alias("members"))


def community_flows(labels: DataFrame) -> DataFrame:
    """The same from every year to the next, of ``labels(dev_id, year, community_id)`` with whole-number years."""
    a = labels.select("dev_id", "year", F.col("community_id").alias("from_community"))
    b = labels.select("dev_id", (F.col("year") - 1).alias("year"), F.col("community_id").alias("to_community"))
    return a.join(b, ["dev_id", "year"]).groupBy("year", "from_community", "to_community").agg(F.count("*").alias("members"))


def modal_label(facts: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """The label under which each actor was most active, ties to the last by name."""
    return (
        facts.join(labels.select("repo_name", label), "repo_name")
        .groupBy("dev_id", label)
        .agg(F.sum("commit_count").alias("_n"))
        .groupBy("dev_id")
        .agg(F.max_by(label, F.struct("_n", label)).alias(label))
    )


def alignment(left: DataFrame, right: DataFrame, by: str, a: str, b: str) -> DataFrame:
    """Cross-tabulation of two labellings, with the share of each cell in its row."""
    cells = left.select(by, a).join(right.select(by, b), by).groupBy(a, b).agg(F.count("*").alias("n"))
    totals = cells.groupBy(a).agg(F.sum("n").alias("_total"))
    return cells.join(totals, a).select(a, b, "n", (F.col("n") / F.col("_total")).alias("share"))


def sankey_links(edges: DataFrame, n: int = 20) -> DataFrame:
    """The heaviest edges with their ends numbered by name; ``n`` bounds every step after the first."""
    best = edges.orderBy(F.desc("migration_count"), "from_tech", "to_tech").limit(n)
    names = best.agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array("from_tech", "to_tech")))))
    ).scalar()
    place = lambda c: F.array_position("_names", F.col(c)).cast("int") - 1
    return best.withColumn("_names", names).select(
        "from_tech", "to_tech", place("from_tech").alias("source"), place("to_tech").alias("target"),
        F.col("migration_count").alias("value"),
    )


def serving_edges(edges: DataFrame) -> DataFrame:
    """Edges with whole-number years, as the dashboard reads them."""
    return edges.withColumns({c: F.col(c).cast("int") for c in ("first_year", "last_year")})


def serving_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes under the names the dashboard reads."""
    return nodes.withColumnsRenamed({"in_weight": "incoming", "out_weight": "outgoing"})


def summary_row(df: DataFrame, name: str, fact: Column) -> DataFrame:
    """Row count and one key fact of a table."""
    return df.agg(F.count("*").alias("n"), fact.cast("string").alias("key_fact")).select(
        F.lit(name).alias("deliverable"), F.col("n"), "key_fact"
    )


def dashboard_tables(
    monthly: DataFrame, clusters: DataFrame, forecasts: DataFrame, edges: DataFrame, nodes: DataFrame,
    influence: DataFrame, members: DataFrame, orgs: DataFrame,
) -> dict[str, DataFrame]:
    """The slim tables the dashboard reads, by name."""
    profile = community_profile(members, orgs)
    return {
        "d1_monthly": monthly.select("language", "year_month", "repo_count", "total_bytes", "commit_count"),
        "d1_clusters": clusters,
        "d2_forecasts": forecasts,
        "d3_edges": serving_edges(edges),
        "d3_nodes": serving_nodes(nodes),
        "d4_pagerank": top_influencers(influence, 200),
        "d5_communities": leading_communities(profile, 60, "size", 5).select(
            "community_id", "size", F.col("mean_pagerank").alias("avg_pagerank"), "max_pagerank",
            F.col("mean_degree").alias("avg_degree"), "top_orgs",
        ),
        "d5_bridge_devs": bridge_actors(members),
        "d5_totals": size_summary(members),
    }

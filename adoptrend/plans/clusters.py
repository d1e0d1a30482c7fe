"""Growth features and clusters of categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.functions.fixed import FEATURES
from adoptrend.operators import features as ft
from adoptrend.plans.registry import query
from adoptrend.plans.trending import GROWN, GROWTH, rounded
from adoptrend.session import cut
from adoptrend.sources.inputs import Inputs, with_views

FEATURE_VIEWS = {
    "grown": GROWN,
    "features": f"""SELECT language, coalesce(avg({GROWTH}), 0) AS avg_repo_growth,
                      coalesce(CASE WHEN avg(commit_count) > 0 THEN stddev_samp(commit_count) / avg(commit_count) ELSE 0 END, 0)
                        AS commit_volatility,
                      CASE WHEN min(repo_count) > 0 THEN max(repo_count) / CAST(min(repo_count) AS DOUBLE) ELSE 1 END
                        AS repo_range_ratio,
                      avg(repo_count) AS avg_repo_count, avg(commit_count) AS avg_commit_count
                    FROM grown GROUP BY 1""",
    "z": "SELECT language, "
    + ", ".join(f"coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 0) AS {c}" for c in FEATURES)
    + " FROM features",
}
ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in FEATURES)


def features(t: Inputs) -> DataFrame:
    """Written once: scaling and clustering read them again and again."""
    return cut(ft.growth_features(t.monthly_table))


@query("growth_features", with_views("monthly", extra=FEATURE_VIEWS, body=f"SELECT language, {ROUNDED} FROM features"))
def growth_features(t: Inputs) -> DataFrame:
    return rounded(ft.growth_features(t.monthly), *FEATURES)


@query("feature_zscores", with_views("monthly", extra=FEATURE_VIEWS, body=f"SELECT language, {ROUNDED} FROM z"))
def feature_zscores(t: Inputs) -> DataFrame:
    return rounded(ft.zscores(features(t)), *FEATURES)


@query(
    "feature_corr",
    with_views(
        "monthly",
        extra=FEATURE_VIEWS,
        body=" UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM features" for a in FEATURES for b in FEATURES
        ),
    ),
)
def feature_corr(t: Inputs) -> DataFrame:
    return rounded(ft.feature_corr(features(t)), "r")


# centres taken from the data: the mean of the categories of each type
CENTRES = f"""SELECT CAST(row_number() OVER (ORDER BY kind) - 1 AS INTEGER) AS cluster_id,
                     {", ".join(f"avg({c}) AS center_{c}" for c in FEATURES)}
              FROM (SELECT *, split_part(language, '-', 1) AS kind FROM z) GROUP BY kind"""
NEAREST = f"""SELECT language, arg_min(cluster_id, struct_pack(d := d, c := cluster_id)) AS cluster FROM
              (SELECT language, cluster_id, {" + ".join(f"(z.{c} - center_{c}) * (z.{c} - center_{c})" for c in FEATURES)} AS d
               FROM z, centres) GROUP BY 1"""
ASSIGNED = {**FEATURE_VIEWS, "centres": CENTRES, "assigned": NEAREST}
KINDS = ("economy", "large", "medium", "promo", "small", "standard")


def type_centres(z: DataFrame) -> DataFrame:
    kinds = [F.lit(k) for k in KINDS]
    kind = F.split_part("language", F.lit("-"), F.lit(1))
    return (
        z.groupBy(kind.alias("_kind"))
        .agg(*[F.avg(c).alias(f"center_{c}") for c in FEATURES])
        .withColumn("cluster_id", (F.array_position(F.array(*kinds), F.col("_kind")) - 1).cast("int"))
        .drop("_kind")
    )


def assigned(t: Inputs) -> DataFrame:
    z = ft.zscores(features(t))
    return ft.assign(z, type_centres(z))


@query("assign_fixed_centroids", with_views("monthly", extra=ASSIGNED, body="SELECT language, cluster FROM assigned"))
def assign_fixed_centroids(t: Inputs) -> DataFrame:
    return assigned(t).select("language", "cluster")


@query(
    "cluster_profiles",
    with_views(
        "monthly",
        extra={
            **ASSIGNED,
            "means": "SELECT cluster, " + ", ".join(f"avg(z.{c}) AS {c}" for c in FEATURES)
            + " FROM z JOIN assigned USING (language) GROUP BY 1",
        },
        body="SELECT cluster, "
        + ", ".join(
            f"""round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER () + CAST(1e-9 AS DOUBLE)), 6) AS {c}"""
            for c in FEATURES
        )
        + " FROM means",
    ),
)
def cluster_profiles(t: Inputs) -> DataFrame:
    return rounded(ft.cluster_profiles(assigned(t)), *FEATURES)


# Labels and signs are free to differ between implementations, so the SQL states what any right
# result has; the Spark side measures it.
@query(
    "clusters_check",
    with_views(
        "monthly",
        extra=FEATURE_VIEWS,
        body="""SELECT count(*) AS languages, 6 AS clusters, CAST(0 AS BIGINT) AS off_nearest, CAST(0 AS BIGINT) AS off_mean,
                       true AS silhouette_agrees FROM features""",
    ),
)
def clusters_check(t: Inputs) -> DataFrame:
    table = features(t)
    rows, centres, silhouette = ft.cluster(table, score=True)
    z = ft.zscores(table)
    rows, centres = cut(rows.select("language", "cluster")), cut(centres)
    nearest = ft.assign(z, centres).select("language", F.col("cluster").alias("_near"))
    off_nearest = rows.join(nearest, "language").where(F.col("cluster") != F.col("_near")).count()
    joined = cut(z.join(rows, "language"))
    means = joined.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in FEATURES])
    gap = sum((F.abs(F.col(c) - F.col(f"center_{c}")) for c in FEATURES), F.lit(0.0))
    off_mean = means.join(centres, F.col("cluster") == F.col("cluster_id")).where(gap > 1e-6).count()
    again = own_silhouette(joined)
    return rows.agg(
        F.count("*").alias("languages"),
        F.countDistinct("cluster").cast("int").alias("clusters"),
        F.lit(off_nearest).cast("long").alias("off_nearest"),
        F.lit(off_mean).cast("long").alias("off_mean"),
        F.lit(abs(again - silhouette) < 1e-6).alias("silhouette_agrees"),
    )


def own_silhouette(joined: DataFrame) -> float:
    """Mean silhouette by squared distances, from sums per cluster: an independent second opinion."""
    squares = sum((F.col(c) * F.col(c) for c in FEATURES), F.lit(0.0))
    per = joined.groupBy("cluster").agg(
        F.count("*").alias("n"), F.sum(squares).alias("q"), *[F.sum(c).alias(f"s_{c}") for c in FEATURES]
    )
    # a row for each cluster; the number of clusters is an argument
    sums = [r.asDict() for r in per.collect()]

    def mean_to(c: dict, others: int):
        dot = sum((F.col(f) * F.lit(c[f"s_{f}"]) for f in FEATURES), F.lit(0.0))
        return (squares * c["n"] + c["q"] - dot * 2) / (c["n"] - others)

    inside = F.coalesce(*[F.when((F.col("cluster") == c["cluster"]) & F.lit(c["n"] > 1), mean_to(c, 1 if c["n"] > 1 else 0)) for c in sums])
    outside = F.least(
        *[F.when(F.col("cluster") != c["cluster"], mean_to(c, 0)) for c in sums],
        F.lit(None).cast("double"),
    )
    value = F.coalesce((outside - inside) / F.greatest(inside, outside), F.lit(0.0))
    return joined.agg(F.avg(value)).first()[0]


@query(
    "pca_check",
    with_views(
        "monthly",
        extra=FEATURE_VIEWS,
        body="""SELECT count(*) AS languages, true AS uncorrelated, true AS ordered, true AS eigenvectors FROM features""",
    ),
)
def pca_check(t: Inputs) -> DataFrame:
    table = features(t)
    axes = cut(ft.zscores(table).join(ft.pca_2d(table), "language"))
    sums = axes.agg(
        F.covar_samp("pc1", "pc2").alias("c12"), F.var_samp("pc1").alias("v1"), F.var_samp("pc2").alias("v2"),
        *[F.covar_samp(c, p).alias(f"{p}_{c}") for c in FEATURES for p in ("pc1", "pc2")],
        *[F.covar_samp(a, b).alias(f"{a}|{b}") for a in FEATURES for b in FEATURES],
    ).first()
    # the covariances of a component with the features are its eigenvector, scaled by its variance
    residual = 0.0
    for p, v in (("pc1", sums["v1"]), ("pc2", sums["v2"])):
        axis = {c: sums[f"{p}_{c}"] / v for c in FEATURES}
        for a in FEATURES:
            residual = max(residual, abs(sum(sums[f"{a}|{b}"] * axis[b] for b in FEATURES) - v * axis[a]))
    trace = sum(sums[f"{c}|{c}"] for c in FEATURES)
    return axes.agg(F.count("*").alias("languages")).select(
        "languages",
        F.lit(abs(sums["c12"]) < 1e-6).alias("uncorrelated"),
        F.lit(sums["v1"] >= sums["v2"] and sums["v1"] + sums["v2"] <= trace + 1e-6).alias("ordered"),
        F.lit(residual < 1e-6).alias("eigenvectors"),
    )


@query("cluster_languages")
def cluster_languages(t: Inputs) -> DataFrame:
    return ft.cluster(features(t))[0]


@query("cluster_centers")
def cluster_centers(t: Inputs) -> DataFrame:
    return ft.cluster(features(t))[1]


@query("cluster_quality")
def cluster_quality(t: Inputs) -> DataFrame:
    rows, _, silhouette = ft.cluster(features(t), score=True)
    return rows.agg(F.countDistinct("cluster").alias("clusters"), F.lit(silhouette).alias("silhouette"))


@query("cluster_k_sweep")
def cluster_k_sweep(t: Inputs) -> DataFrame:
    return ft.k_sweep(features(t))


@query("cluster_members")
def cluster_members(t: Inputs) -> DataFrame:
    return ft.cluster_members(ft.cluster(features(t))[0])


@query("pca_2d")
def pca_2d(t: Inputs) -> DataFrame:
    return ft.pca_2d(features(t))

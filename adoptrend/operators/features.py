"""Growth features per category, and clustering on them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.functions.fixed import CLUSTERS, FEATURES, SEED
from adoptrend.operators.trends import mom_growth
from adoptrend.session import cut

MAX_ITER = 50


def growth_features(monthly: DataFrame) -> DataFrame:
    """Five numbers per category: mean growth, volatility, range, breadth, activity."""
    per = mom_growth(monthly).groupBy("language").agg(
        F.avg("growth").alias("_growth"),
        F.stddev_samp("commit_count").alias("_sd"),
        F.avg("commit_count").alias("avg_commit_count"),
        F.max("repo_count").alias("_max"),
        F.min("repo_count").alias("_min"),
        F.avg("repo_count").alias("avg_repo_count"),
    )
    return per.select(
        "language",
        F.coalesce("_growth", F.lit(0.0)).alias("avg_repo_growth"),
        F.coalesce(
            F.when(F.col("avg_commit_count") > 0, F.col("_sd") / F.col("avg_commit_count")).otherwise(0.0), F.lit(0.0)
        ).alias("commit_volatility"),
        F.when(F.col("_min") > 0, F.col("_max") / F.col("_min")).otherwise(1.0).alias("repo_range_ratio"),
        "avg_repo_count",
        "avg_commit_count",
    )


def zscores(features: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Each column less its mean, over its sample deviation; 0 for a constant column."""
    parts = []
    for c in columns:
        parts += [F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}")]
    stats = features.agg(F.struct(*parts)).scalar()
    out = features.withColumn("_stats", stats)
    for c in columns:
        spread = F.nullif(F.col(f"_stats.s_{c}"), F.lit(0.0))
        out = out.withColumn(c, F.coalesce((F.col(c) - F.col(f"_stats.m_{c}")) / spread, F.lit(0.0)))
    return out.drop("_stats")


# centres that may travel beside each row
MAX_CENTRES = 10_000


def _scaled(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Standardised vectors; written once, for the fits pass over them many times."""
    assembled = VectorAssembler(inputCols=list(columns), outputCol="raw", handleInvalid="skip").transform(features)
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    return cut(scaler.fit(assembled).transform(assembled).drop("raw"))


def _fit(scaled: DataFrame, k: int, seed: int, max_iter: int):
    model = KMeans(featuresCol="features", predictionCol="cluster", k=k, seed=seed, maxIter=max_iter).fit(scaled)
    return model, model.transform(scaled)


def _silhouette(clustered: DataFrame) -> float:
    return ClusteringEvaluator(featuresCol="features", predictionCol="cluster").evaluate(clustered)


def cluster(
    features: DataFrame,
    k: int = CLUSTERS,
    seed: int = SEED,
    max_iter: int = MAX_ITER,
    columns: Sequence[str] = FEATURES,
    score: bool = False,
) -> tuple[DataFrame, DataFrame, float | None]:
    """Clustered rows, centres in scaled space (k rows), and, where ``score`` asks for it, the silhouette."""
    scaled = _scaled(features, columns)
    model, clustered = _fit(scaled, k, seed, max_iter)
    centres = features.sparkSession.createDataFrame(
        [(i, *[float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
        "cluster_id int, " + ", ".join(f"center_{c} double" for c in columns),
    )
    return clustered.drop("features"), centres, _silhouette(clustered) if score else None


def k_sweep(features: DataFrame, ks: Sequence[int] = range(3, 9), seed: int = SEED, max_iter: int = MAX_ITER) -> DataFrame:
    """Silhouette for each number of clusters."""
    scaled = _scaled(features, FEATURES)
    rows = [(k, float(_silhouette(_fit(scaled, k, seed, max_iter)[1]))) for k in ks]
    return features.sparkSession.createDataFrame(rows, "k int, silhouette double")


def pca_2d(features: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Two principal components of the standardised features; their signs are arbitrary."""
    scaled = _scaled(features, columns)
    model = PCA(k=2, inputCol="features", outputCol="_pc").fit(scaled)
    axes = model.transform(scaled).withColumn("_pc", vector_to_array("_pc"))
    return axes.select("language", F.col("_pc")[0].alias("pc1"), F.col("_pc")[1].alias("pc2"))


def feature_corr(features: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Correlation of every pair of features, in one pass."""
    pairs = [(a, b) for a in columns for b in columns]
    row = features.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    return row.select(F.inline(F.array(*cells)))


def assign(features: DataFrame, centres: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Nearest centre of each row; more than ``MAX_CENTRES`` centres raise.

    The centres are as many as there are clusters; they travel as one array beside each row, so
    that no row is multiplied.
    """
    if centres.count() > MAX_CENTRES:
        raise ValueError(f"more than {MAX_CENTRES} centres")
    every = centres.agg(
        F.array_sort(F.collect_list(F.struct("cluster_id", F.array(*[F.col(f"center_{c}") for c in columns]).alias("at"))))
    ).scalar()

    def distance(centre):
        squares = [
            (F.col(c) - F.element_at(centre["at"], i + 1)) * (F.col(c) - F.element_at(centre["at"], i + 1))
            for i, c in enumerate(columns)
        ]
        return F.struct(reduce(lambda a, b: a + b, squares).alias("d"), centre["cluster_id"].alias("cluster"))

    return (
        features.withColumn("_centres", every)
        .withColumn("_near", F.array_min(F.transform("_centres", distance)))
        .withColumn("cluster", F.col("_near.cluster"))
        .drop("_centres", "_near")
    )


def cluster_profiles(clustered: DataFrame, label: str = "cluster", columns: Sequence[str] = FEATURES) -> DataFrame:
    """Mean of each feature per cluster, scaled to 0..1 over the clusters."""
    means = clustered.groupBy(label).agg(*[F.avg(c).alias(c) for c in columns])
    spans = means.agg(
        F.struct(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns])
    ).scalar()
    out = means.withColumn("_spans", spans)
    return out.select(
        label,
        *[
            ((F.col(c) - F.col(f"_spans.{c}.lo")) / (F.col(f"_spans.{c}.hi") - F.col(f"_spans.{c}.lo") + F.lit(1e-9))).alias(c)
            for c in columns
        ],
    )


def cluster_members(clustered: DataFrame) -> DataFrame:
    """Scatter view: breadth on a log scale, growth, volatility in percent."""
    return clustered.select(
        "cluster",
        "language",
        F.log10(F.greatest(F.lit(1.0), F.col("avg_repo_count"))).alias("log_size"),
        F.col("avg_repo_growth").alias("growth"),
        (F.col("commit_volatility") * 100).alias("volatility_pct"),
    )

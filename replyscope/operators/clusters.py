"""KMeans clusters and cluster statistics."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope import fixed_values as fixed


def cluster_kmeans(
    df: DataFrame, key: str, vector: str = "embedding", k: int = fixed.N_CLUSTERS, seed: int = fixed.RANDOM_SEED
) -> DataFrame:
    """(key, cluster): KMeans label of each vector."""
    features = df.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(features)
    return model.transform(features).select(key, "cluster")


def cluster_sizes(labels: DataFrame, cluster: str = "cluster") -> DataFrame:
    return labels.where(F.col(cluster) >= 0).groupBy(cluster).agg(F.count("*").alias("size"))


def cluster_stats(labels: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Cluster count, noise count and total in one row; one partial count per label is shuffled."""
    counts = labels.groupBy(cluster).agg(F.count("*").alias("_n"))
    member = F.col(cluster) >= 0
    return counts.agg(
        F.count(F.when(member, 1)).alias("n_clusters"),
        F.coalesce(F.sum(F.when(F.col(cluster) == -1, F.col("_n"))), F.lit(0)).alias("noise_count"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_points"),
    )

"""K-means sweeps over comment vectors and the measures to judge them."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldtide.functions import text as tx
from fieldtide.operators import kmeans
from fieldtide.operators.kmeans import Model
from fieldtide.operators.latent import bucket

CENTERS = 2000  # centroids in one value of a plan


def embed_text(df: DataFrame, text_col: str, dim: int = 256, out: str = "features") -> DataFrame:
    """Unit vectors of hashed words weighted by inverse frequency; texts without words get the zero vector.

    A bucket's weight is ln((texts + 1) / (texts with it + 1)), over all texts. The weights are ``dim`` numbers of the plan.
    Words become bucket numbers in native expressions, so Python sees four bytes per word.
    """
    buckets = F.transform(tx.tokens(F.lower(F.col(text_col))), lambda w: bucket(w, dim))
    used = df.select(F.explode(F.array_distinct(buckets)).alias("bucket"))
    found = {r["bucket"]: r["count"] for r in used.groupBy("bucket").count().collect()}
    total = df.count()
    weights = np.log((total + 1) / (np.array([found.get(i, 0) for i in range(dim)]) + 1))

    @F.pandas_udf("array<double>")
    def unit(listed: pd.Series) -> pd.Series:
        def one(at):
            if at is None or not len(at):
                return np.zeros(dim)
            weighted = np.bincount(at, minlength=dim) * weights
            length = np.sqrt(weighted @ weighted)
            return weighted / length if length > 0 else weighted

        return listed.map(one)

    return df.withColumn(out, array_to_vector(unit(buckets)))


def _array(df: DataFrame, vec: str) -> Column:
    if isinstance(df.schema[vec].dataType, VectorUDT):
        return vector_to_array(F.col(vec))
    return F.col(vec).cast("array<double>")


def _vector(df: DataFrame, vec: str) -> Column:
    if isinstance(df.schema[vec].dataType, VectorUDT):
        return F.col(vec)
    return array_to_vector(F.col(vec).cast("array<double>"))


def cluster_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("members"))


def _cluster_stats(df: DataFrame, label: str, vec: str) -> DataFrame:
    """Members, squared distances to the own mean, and the mean, per cluster.

    One pass of partial sums; the variances are merged in a stable way, so vectors far from
    the origin lose no digits, and nothing has to be joined or broadcast.
    """
    metrics = Summarizer.metrics("count", "mean", "variance").summary(F.col("_v")).alias("_s")
    stats = df.select(label, _vector(df, vec).alias("_v")).groupBy(label).agg(metrics)
    spread = F.aggregate(vector_to_array("_s.variance"), F.lit(0.0), lambda s, v: s + v)
    return stats.select(
        label, F.col("_s.count").alias("members"), (spread * (F.col("_s.count") - 1)).alias("sse"),
        vector_to_array("_s.mean").alias("centroid"),
    )


def cluster_means(df: DataFrame, label: str = "label", vec: str = "embedding") -> DataFrame:
    """Members and mean vector per cluster."""
    return _cluster_stats(df, label, vec).drop("sse")


def cluster_sse(df: DataFrame, label: str = "label", vec: str = "embedding") -> DataFrame:
    """Sum of squared distances to the own mean, per cluster."""
    return _cluster_stats(df, label, vec).drop("centroid")


def cluster_ch(df: DataFrame, label: str = "label", vec: str = "embedding") -> DataFrame:
    """Between-cluster over within-cluster variance, as one row (k, n, ch)."""
    stats = _cluster_stats(df, label, vec)
    # From here on there is one row per cluster and dimension.
    dims = stats.select("members", "sse", F.posexplode("centroid").alias("_dim", "_m"))
    m, members = F.col("_m"), F.col("members")
    # Differences to the overall mean first: no large numbers cancel, however far the vectors lie from the origin.
    line = Window.partitionBy("_dim")
    middle = F.sum(members * m).over(line) / F.sum(members).over(line)
    dims = dims.withColumn("_gap", m - middle)
    spread = F.sum(members * F.col("_gap") * F.col("_gap"))
    per_dim = dims.groupBy("_dim").agg(
        F.count(F.lit(1)).alias("k"), F.sum(members).alias("n"), F.sum("sse").alias("_within"), spread.alias("_between")
    )
    total = per_dim.agg(F.max("k").alias("k"), F.max("n").alias("n"), F.max("_within").alias("_w"), F.sum("_between").alias("_b"))
    ratio = (F.col("_b") / (F.col("k") - 1)) / (F.col("_w") / (F.col("n") - F.col("k")))
    return total.select("k", "n", ratio.alias("ch"))


def cluster_silhouette(
    df: DataFrame, metric: str = "squared_euclidean", label: str = "label", vec: str = "embedding",
    id_col: str = "vec_id", sample: int = 1000,
) -> DataFrame:
    """Mean silhouette as one row.

    ``squared_euclidean`` needs one pass, whatever the size. ``euclidean`` is ``silhouette_by_sample`` without its error:
    exact for clusters of up to ``sample`` members.
    """
    if metric == "squared_euclidean":
        rows = df.select(_vector(df, vec).alias("features"), F.col(label).cast("double").alias("prediction"))
        value = ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(rows)
        return df.sparkSession.createDataFrame([(float(value),)], "silhouette double")
    return silhouette_by_sample(df, label, vec, id_col, sample).select("silhouette")


def silhouette_by_sample(df: DataFrame, label: str = "label", vec: str = "embedding", id_col: str = "vec_id", sample: int = 1000) -> DataFrame:
    """(silhouette, error): mean Euclidean silhouette of all points against reference points.

    The reference points of a cluster are its first ``sample`` members in the order of a hash of the id; a point is never
    compared with itself. Every point is measured, so the work is points x reference points, and smaller clusters are
    exact. ``error`` is half the difference of the values that the two halves of the reference points give. The reference
    points travel with every task; they are found when this is called.
    """
    rows = df.select(F.xxhash64(id_col).alias("_id"), F.xxhash64(label).alias("_c"), _array(df, vec).alias("_x"))
    sizes = rows.groupBy("_c").agg(F.least(F.count(F.lit(1)), F.lit(sample)).alias("n")).agg(F.sum("n"), F.max(F.lit(1))).first()
    width = rows.select(F.size("_x")).first()
    if sizes[0] and sizes[0] * width[0] * 8 > kmeans.LARGEST_MODELS:
        raise ValueError(f"{sizes[0]} reference points of {width[0]} numbers: take a smaller sample per cluster")
    place = F.row_number().over(Window.partitionBy("_c").orderBy(F.xxhash64("_id"), "_id"))
    listed = rows.withColumn("_n", place).where(F.col("_n") <= sample).toPandas().sort_values(["_c", "_n"])
    if listed.empty:
        return df.sparkSession.createDataFrame([], "silhouette double, error double")
    sent = df.sparkSession.sparkContext.broadcast((
        listed["_id"].to_numpy(), listed["_c"].to_numpy(), (listed["_n"].to_numpy() % 2 == 1), np.stack(listed["_x"].to_numpy())))

    def measured(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, clusters, odd, points = sent.value
        names, start = np.unique(clusters, return_index=True)
        lengths = (points * points).sum(1)
        for batch in batches:
            for lo in range(0, len(batch), 1024):
                part = batch.iloc[lo:lo + 1024]
                x = np.stack(part["_x"].to_numpy())
                gaps = np.sqrt(np.maximum((x * x).sum(1)[:, None] + lengths[None, :] - 2 * x @ points.T, 0))
                self_at = part["_id"].to_numpy()[:, None] == ids[None, :]
                own = np.searchsorted(names, part["_c"].to_numpy())
                out = {}
                for name, used in (("s", np.ones(len(ids), bool)), ("s1", odd), ("s2", ~odd)):
                    weight = np.where(self_at, 0.0, used[None, :].astype(float))
                    with np.errstate(invalid="ignore", divide="ignore"):
                        mean = np.add.reduceat(gaps * weight, start, axis=1) / np.add.reduceat(weight, start, axis=1)
                        a = mean[np.arange(len(x)), own]
                        mean[np.arange(len(x)), own] = np.nan
                        b = np.where(np.isnan(mean).all(1), np.nan, np.nanmin(np.where(np.isnan(mean), np.inf, mean), axis=1))
                        out[name] = np.nan_to_num((b - a) / np.maximum(a, b), nan=0.0)
                yield pd.DataFrame(out)

    means = rows.mapInPandas(measured, "s double, s1 double, s2 double").agg(*[F.avg(c).alias(c) for c in ("s", "s1", "s2")])
    return means.select(F.col("s").alias("silhouette"), (F.abs(F.col("s1") - F.col("s2")) / 2).alias("error"))


def kmeans_sweep(
    df: DataFrame, ks: Sequence[int] = tuple(range(10, 20)), restarts: int = 10, max_iter: int = 300,
    tol: float = 1e-4, vec: str = "features", id_col: str = "vec_id",
) -> tuple[DataFrame, dict[int, Model]]:
    """Fit every k with several starts, keep the best start, and measure it: (k, sse, silhouette, ch) and the models.

    Every step of all models is one scan (``kmeans.fit_all``). The points that start a model follow from the MD5 of their
    ids, so results do not depend on partitions. Silhouettes are squared Euclidean; measures that are not defined are NULL.
    The models are fitted when this is called.
    """
    table, models = kmeans.sweep(df, _array(df, vec), id_col, ks, restarts, max_iter, tol)
    return df.sparkSession.createDataFrame(table, "k int, sse double, silhouette double, ch double"), models


def knee_point(points: DataFrame, x: str = "k", y: str = "sse", sensitivity: float = 1.0) -> DataFrame:
    """Elbow of a convex decreasing curve (Satopaa et al. 2011), as one row; NULL when there is none.

    ``points`` is a curve to look at: one row per tried setting.
    """
    line = Window.orderBy("_x")
    whole = Window.partitionBy()
    scale = lambda c: (c - F.min(c).over(whole)) / (F.max(c).over(whole) - F.min(c).over(whole))
    rows = points.select(F.col(x).alias("_x"), scale(F.col(x)).alias("_xn"), scale(F.col(y)).alias("_yn"))
    rows = rows.withColumn("_d", 1 - F.col("_yn") - F.col("_xn"))
    step = F.avg(F.col("_xn") - F.col("_before"))
    rows = rows.select("*", F.lag("_d", 1).over(line).alias("_p"), F.lead("_d", 1).over(line).alias("_q"),
                       F.lag("_xn").over(line).alias("_before"))
    rows = rows.withColumn("_step", step.over(whole))
    d, p, q = F.col("_d"), F.col("_p"), F.col("_q")
    is_max = (d >= F.coalesce(p, d)) & (d >= F.coalesce(q, d))
    is_min = (d <= F.coalesce(p, d)) & (d <= F.coalesce(q, d))
    event = F.when(is_min, F.lit(0.0)).when(is_max, d - sensitivity * F.col("_step"))
    rows = rows.select("*", event.alias("_event"), F.when(is_max, F.col("_x")).alias("_top"))
    upto = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select(
        "*", F.last("_event", ignorenulls=True).over(upto).alias("_limit"),
        F.last("_top", ignorenulls=True).over(upto).alias("_peak"),
    )
    hit = F.col("_peak").isNotNull() & (q < F.col("_limit"))
    return rows.agg(F.min_by("_peak", F.when(hit, F.col("_x"))).alias("knee"))


def centroid_distance(
    df: DataFrame, centroids: DataFrame, vec: str = "embedding", label: str = "label"
) -> DataFrame:
    """Nearest centroid and the Euclidean distance to it (``cluster_id``, ``center_dist``).

    The centroids go into the plan in blocks of ``CENTERS`` rows; each row finds its nearest by native expressions. Of
    equally near centroids the one with the smallest label is taken; without centroids both are NULL.
    """
    listed = centroids.select(F.col(label).alias("id"), F.col("centroid").cast("array<double>").alias("at"))
    blocks = max(1, math.ceil(listed.count() / CENTERS))
    part = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    models = [listed.where(part == b).agg(F.collect_list(F.struct("id", "at")).alias("model")).scalar() for b in range(blocks)]
    rows = df.withColumns({"_x": _array(df, vec), **{f"_model{b}": m for b, m in enumerate(models)}})

    def gap(c: Column) -> Column:
        square = F.zip_with("_x", c["at"], lambda a, b: (a - b) * (a - b))
        return F.struct(F.aggregate(square, F.lit(0.0), lambda s, v: s + v).alias("square"), c["id"].alias("id"))

    near = rows.withColumn("_near", F.array_min(F.array(*[F.array_min(F.transform(f"_model{b}", gap)) for b in range(blocks)])))
    return near.select(*df.columns, F.col("_near.id").cast("long").alias("cluster_id"), F.sqrt("_near.square").alias("center_dist"))


def centers_table(spark: SparkSession, model: Model) -> DataFrame:
    """(label, centroid): the centers of a fitted model, one row per cluster."""
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(model.centers)]
    return spark.createDataFrame(rows, "label int, centroid array<double>")


def assign_cluster_label(model: Model, df: DataFrame, vec: str = "features", out: str = "label") -> DataFrame:
    """Each row with the number of the nearest center; rows without a vector get NULL."""
    centers = model.centers

    @F.pandas_udf("long")
    def nearest(vectors: pd.Series) -> pd.Series:
        known = vectors.notna().to_numpy()
        labels = pd.Series(pd.array([pd.NA] * len(vectors), dtype="Int64"), index=vectors.index)
        if known.any():
            x = np.stack(vectors[known].to_list()).astype(np.float64)
            labels[known] = ((centers * centers).sum(1)[None, :] - 2.0 * (x @ centers.T)).argmin(1)
        return labels

    return df.withColumn(out, nearest(_array(df, vec)))


def nearest_members(
    df: DataFrame, n: int = 10, cluster: str = "cluster_id", dist: str = "center_dist", id_col: str = "vec_id"
) -> DataFrame:
    """The ``n`` members closest to their centroid; each task keeps ``n`` per cluster before the shuffle."""
    closest = Window.partitionBy(cluster).orderBy(dist, id_col)
    ranked = df.withColumn("member_no", F.row_number().over(closest).cast("long"))
    return ranked.where(F.col("member_no") <= n)

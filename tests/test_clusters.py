"""K-means for many models at once, text vectors and their axes, against plain numpy."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fieldtide.operators import clustering, features, kmeans
from fieldtide.operators import latent as latent_module
from fieldtide.operators.latent import latent_axes
from fieldtide.plans import clusters as cluster_plan
from fieldtide.plans.clusters import reason_clusters
from fieldtide.session import stored


def plain_lloyd(x, k, ids, start, tol=1e-4, most=300):
    order = sorted(range(len(x)), key=lambda i: (hashlib.md5(f"{start}:{ids[i]}".encode()).hexdigest(), list(x[i])))
    centers = x[order[:k]].copy()
    for _ in range(most):
        at = ((x[:, None, :] - centers[None]) ** 2).sum(2).argmin(1)
        moved = np.array([x[at == j].mean(0) if (at == j).any() else centers[j] for j in range(len(centers))])
        shift, centers = ((moved - centers) ** 2).sum(1).max(), moved
        if shift <= tol * tol:
            break
    gaps = ((x[:, None, :] - centers[None]) ** 2).sum(2)
    return centers, gaps.argmin(1), gaps.min(1).sum()


def plain_silhouette(x, at):
    gaps, out = ((x[:, None] - x[None]) ** 2).sum(2), []
    for i in range(len(x)):
        own = at == at[i]
        if own.sum() < 2:
            out.append(0.0)
            continue
        a = gaps[i, own].sum() / (own.sum() - 1)
        b = min(gaps[i, at == j].mean() for j in set(at) - {at[i]})
        out.append((b - a) / max(a, b))
    return np.mean(out)


@pytest.fixture(scope="module")
def points():
    return np.random.default_rng(3).normal(size=(300, 5))


@pytest.mark.parametrize("partitions", [1, 7])
def test_sweep_against_numpy(spark, points, partitions, monkeypatch):
    monkeypatch.setattr(kmeans, "BLOCK", 64)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)] + [(999, None)], "vec_id int, embedding array<double>")
    table, models = clustering.kmeans_sweep(df.repartition(partitions), [2, 5, 9], restarts=3, vec="embedding")
    for row in table.collect():
        fits = [plain_lloyd(points, row.k, range(300), s) for s in range(3)]
        centers, at, sse = min(fits, key=lambda f: round(f[2], 6))
        assert row.sse == pytest.approx(sse) and np.allclose(models[row.k].centers, centers)
        assert row.silhouette == pytest.approx(plain_silhouette(points, at))
        got = clustering.assign_cluster_label(models[row.k], df, "embedding").orderBy("vec_id").collect()
        assert [r.label for r in got] == [*at.tolist(), None]
        middle = points.mean(0)
        between = sum((at == j).sum() * ((points[at == j].mean(0) - middle) ** 2).sum() for j in set(at))
        assert row.ch == pytest.approx(between / (row.k - 1) / (sse / (300 - row.k)), rel=1e-6)


def test_sweep_of_few_and_equal_points(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(6)], "vec_id int, embedding array<double>")
    row = clustering.kmeans_sweep(df, [3], restarts=2, vec="embedding")[0].first()
    assert (row.k, row.sse, row.silhouette, row.ch) == (3, 0.0, None, None)
    assert clustering.kmeans_sweep(df.limit(2), [3], restarts=1, vec="embedding")[1][3].centers.shape == (2, 2)
    assert clustering.kmeans_sweep(df.where("false"), [3], vec="embedding")[0].count() == 0


TEXTS = ["storm damage to roof", "roof damage by storm", "call back later", "please call me back", "late crew", "crew came late today", "", None] * 5


def counted(buckets):
    rows = []
    for text in TEXTS:
        row = np.zeros(buckets)
        for word in (text or "").lower().split():
            row[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % buckets] += 1
        rows.append(row)
    a = np.array(rows)
    a *= np.log((len(a) + 1) / ((a > 0).sum(0) + 1))
    return a / np.maximum(np.sqrt((a * a).sum(1, keepdims=True)), 1e-300)


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").repartition(3)


def test_embedding_against_numpy(texts):
    rows = clustering.embed_text(texts, "text", 32).select("id", vector_to_array("features").alias("v")).orderBy("id").collect()
    assert np.allclose([r.v for r in rows], counted(32))


def test_axes_are_those_of_a_plain_decomposition(texts):
    a = counted(256)
    strengths = np.linalg.svd(a, compute_uv=False)
    got = latent_axes(texts, "text", 4, 256, steps=30)
    assert np.allclose(got.axes.T @ got.axes, np.eye(4), atol=1e-9)
    assert np.allclose(got.strengths, strengths[:4], rtol=1e-6)
    assert got.share == pytest.approx((strengths[:4] ** 2).sum() / (strengths ** 2).sum(), rel=1e-6)
    # Axes explain what they say: the projections keep that share of the squares.
    assert ((a @ got.axes) ** 2).sum() / (a ** 2).sum() == pytest.approx(got.share, rel=1e-9)
    rows = got.vectors(texts, "text").select("id", vector_to_array("features").alias("v")).orderBy("id").collect()
    want = a @ got.axes
    lengths = np.sqrt((want ** 2).sum(1, keepdims=True))
    assert np.allclose([r.v for r in rows], np.where(lengths > 1e-9, want / np.maximum(lengths, 1e-12), 0), atol=1e-6)
    all_axes = latent_axes(texts, "text", 64, 256, steps=5)
    assert all_axes.share == pytest.approx(1.0) and len(all_axes.strengths) == np.linalg.matrix_rank(a)
    assert latent_axes(texts.where("false"), "text", 4, 64).axes.shape == (64, 0)


@pytest.mark.parametrize("latent", [None, 4])
def test_reason_clusters_lists_nearest_texts(spark, texts, latent):
    rows = reason_clusters(texts.where("text <> ''"), "id", "text", ks=(2, 3, 4), restarts=3, dim=64, n=3, latent=latent).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.cluster_id, []).append(r)
    for members in groups.values():
        members.sort(key=lambda r: r.member_no)
        assert [m.member_no for m in members] == list(range(1, len(members) + 1)) and len(members) <= 3
        gaps = [m.center_dist for m in members]
        assert gaps == sorted(gaps) and not any(math.isnan(g) for g in gaps)


def test_one_hot_vectors_of_many_categories(spark):
    train = spark.range(40_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    rows = spark.range(60_000).select("id", F.when(F.col("id") != 7, F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"))
    coded = features.one_hot_vector(["k"]).fit(train).transform(rows)
    # No task holds the categories or a dense vector: the lookup is a join.
    plan = coded._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan
    vector = F.unwrap_udt("k_vec")
    got = {r.id: tuple(r)[1:] for r in coded.select("id", vector["indices"], vector["values"], vector["size"], "k_idx").collect()}
    order = {k: i for i, k in enumerate(sorted(f"k{i}" for i in range(40_000)))}
    assert len(got) == 60_000 and all(v[2] == 40_000 for v in got.values())
    for i, (indices, values, _, place) in got.items():
        known = i != 7 and i < 40_000
        assert (indices, values, place) == (([order[f"k{i}"]], [1.0], order[f"k{i}"]) if known else ([], [], 40_000))


def test_one_hot_vectors_without_categories(spark):
    train = spark.createDataFrame([(None,)], "k string")
    row = features.one_hot_vector(["k"]).fit(train).transform(spark.createDataFrame([("a",)], "k string")).first()
    assert row.k_vec.toArray().tolist() == []


def test_equal_points_are_one_weighted_point(spark, points):
    """Sums, silhouettes and members count every copy, but only different points are packed, evenly over the tasks."""
    copies = np.repeat(points[:200], 20, axis=0)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(copies)], "vec_id int, embedding array<double>")
    table, models = clustering.kmeans_sweep(df, [3, 4], restarts=2, vec="embedding")
    for row in table.collect():
        centers, at, sse = min((plain_lloyd(copies, row.k, range(len(copies)), s) for s in range(2)), key=lambda f: round(f[2], 6))
        assert row.sse == pytest.approx(sse) and np.allclose(models[row.k].centers, centers)
        assert models[row.k].members.sum() == len(copies) and row.silhouette == pytest.approx(clustering.cluster_silhouette(
            clustering.assign_cluster_label(models[row.k], df, "embedding"), vec="embedding").first()[0])
    assert kmeans.stored_blocks(df, "embedding").agg(F.sum("n")).first()[0] == 200
    many = spark.range(20_000).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v")).coalesce(1)
    sizes = [r.n for r in kmeans.stored_blocks(many, "v").groupBy(F.spark_partition_id()).agg(F.sum("n").alias("n")).collect()]
    assert sum(sizes) == 20_000 and len(sizes) >= 4 and max(sizes) < 6_000


def test_axes_take_few_entries_at_a_time(spark, texts, monkeypatch):
    """A task holds a bounded number of entries, whatever the number and length of the texts."""
    slices = list(latent_module._slices(np.cumsum([0, 5, 70_000, 3, 65_000, 600])))
    assert slices == [(0, 1), (1, 2), (2, 4), (4, 5)] and list(latent_module._slices(np.array([0]))) == []
    whole = latent_axes(texts, "text", 4, 256, steps=30)
    monkeypatch.setattr(latent_module, "ENTRIES", 8)
    parts = latent_axes(texts, "text", 4, 256, steps=30)
    assert np.allclose(whole.axes, parts.axes, atol=1e-6) and np.allclose(whole.strengths, parts.strengths)


def test_embedding_hashes_words_outside_python(texts):
    plan = clustering.embed_text(texts, "text", 32)._jdf.queryExecution().optimizedPlan().toString()
    udf = plan[plan.index("ArrowEvalPython"):].splitlines()[0]
    assert "md5" in udf  # what the function takes are bucket numbers


def test_comments_of_one_file_are_dealt_to_all_cores(spark, texts, monkeypatch):
    sizes = {}

    def seen(df, name):
        sizes[name] = df.rdd.getNumPartitions()
        return stored(df, name)

    monkeypatch.setattr(cluster_plan, "stored", seen)
    reason_clusters(texts.where("text <> ''").coalesce(1), "id", "text", ks=(2, 3), restarts=1, dim=16, n=1)
    assert sizes["clean-comments"] >= spark.sparkContext.defaultParallelism and "lemmatized-comments" in sizes

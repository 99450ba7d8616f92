"""Many k-means models in one scan per step.

Equal points become one with a weight, and the points are packed once into blocks of rows, dealt evenly to the cores. Each
step reads all blocks once for all models that still move: the distances to the centers of every model are one matrix
product, and so are the sums of the points of every center. A task hands on one row per model; Spark adds these up, so what
reaches the driver is the size of the models, whatever the data.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtide.session import stored

BLOCK = 2048  # points in a block
PART = 32 << 20  # bytes of the points that a task reads at most, where there are more tasks than cores
LARGEST_MODELS = 256 << 20  # bytes of all centers together; they travel with every task


@dataclass(frozen=True)
class Model:
    """Centers (one row each) and their members after the last step."""

    k: int
    start: int
    centers: np.ndarray
    members: np.ndarray
    sse: float
    steps: int


def weighted(points: DataFrame, vec: str) -> DataFrame:
    """(_x, _w): the different vectors and how many points have them; rows without a vector are left out."""
    return points.where(F.col(vec).isNotNull()).groupBy(F.col(vec).alias("_x")).agg(F.count(F.lit(1)).cast("double").alias("_w"))


def packed(points: DataFrame) -> DataFrame:
    """(n, block): blocks of up to ``BLOCK`` weighted vectors as the bytes of a matrix of doubles; the weight comes last."""

    def pack(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                rows = np.column_stack([np.stack(batch["_x"].iloc[at:at + BLOCK].to_list()).astype(np.float64), batch["_w"].iloc[at:at + BLOCK]])
                yield pd.DataFrame({"n": [len(rows)], "block": [rows.tobytes()]})

    return points.select("_x", "_w").mapInPandas(pack, "n long, block binary")


def stored_blocks(points: DataFrame, vec: str) -> DataFrame:
    """The packed points, stored, in as many even parts as there are cores or more."""
    rows = stored(weighted(points, vec), "kmeans-weighted")
    size = rows.agg(F.count(F.lit(1)), F.max(F.size("_x"))).first()
    cores = points.sparkSession.sparkContext.defaultParallelism
    parts = max(cores, math.ceil(size[0] * ((size[1] or 0) + 1) * 8 / PART))
    # Small inputs stay in few parts: a block is the least that is worth a task.
    parts = min(parts, max(1, math.ceil(size[0] / 256)))
    return stored(packed(rows.repartition(parts)), "kmeans-points")


def start_points(points: DataFrame, id_col: str, vec: str, restarts: int, most: int) -> dict[int, np.ndarray]:
    """The first ``most`` points of each start, in the order of the MD5 of ``start:id`` (equal ones by vector).

    Each start is a random order of the points that does not depend on how they are stored. A model of k centers takes
    the first k. Tasks keep ``most`` points per start before anything is moved.
    """
    rows = points.where(F.col(vec).isNotNull()).select(F.col(id_col).cast("string").alias("_id"), F.col(vec).alias("_x"))
    starts = F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))).alias("_start")
    keyed = rows.select("*", starts).withColumn("_order", F.md5(F.concat_ws(":", F.col("_start").cast("string"), F.coalesce("_id", F.lit("")))))
    first = keyed.withColumn("_n", F.row_number().over(Window.partitionBy("_start").orderBy("_order", "_x"))).where(F.col("_n") <= most)
    found: dict[int, list] = {s: [] for s in range(restarts)}
    for row in first.select("_start", "_n", "_x").orderBy("_start", "_n").toLocalIterator():
        found[row["_start"]].append(row["_x"])
    return {s: np.asarray(x, dtype=np.float64) for s, x in found.items()}


def _nearest(x: np.ndarray, centers: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first center, nearest center of the model per point) for each model; ties take the first."""
    part = 0.5 * (centers * centers).sum(1)[None, :] - x @ centers.T
    for lo, hi in zip(offsets[:-1], offsets[1:]):
        yield int(lo), part[:, lo:hi].argmin(1)


def _own(x: np.ndarray, centers: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(centers x points) 1 where the center is the nearest of its model, the first of several; and per model half the
    squared distances less half the squared lengths."""
    part = centers @ x.T
    np.subtract((0.5 * (centers * centers).sum(1))[:, None], part, out=part)
    near = np.empty(part.shape, dtype=bool)
    least = []
    for lo, hi in zip(offsets[:-1], offsets[1:]):
        least.append(part[lo:hi].min(0))
        np.equal(part[lo:hi], least[-1], out=near[lo:hi])
        if np.count_nonzero(near[lo:hi]) != len(x):
            first = near[lo:hi].argmax(0)
            near[lo:hi] = False
            near[lo + first, np.arange(len(x))] = True
    np.copyto(part, near)
    return part, least


def _summed(blocks: DataFrame, models: Sequence[np.ndarray], measured: bool = False) -> tuple[np.ndarray, ...]:
    """Sum of points and number per center, over the centers of all models; ``measured`` adds squared distances and
    squared lengths."""
    centers = np.vstack(models)
    if centers.nbytes > LARGEST_MODELS:
        raise ValueError(f"{centers.nbytes} bytes of centers; at most {LARGEST_MODELS}: fit fewer models at a time")
    offsets, width = np.cumsum([0, *map(len, models)]), centers.shape[1]
    wide = width + (3 if measured else 1)
    sent = blocks.sparkSession.sparkContext.broadcast((centers, offsets))

    def step(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at_all, cuts = sent.value
        total = np.zeros((len(at_all), wide))
        for batch in batches:
            for n, raw in zip(batch["n"], batch["block"]):
                rows = np.frombuffer(raw, dtype=np.float64).reshape(n, width + 1)
                x, weight = np.ascontiguousarray(rows[:, :width]), rows[:, width]
                own, least = _own(x, at_all, cuts)
                times = rows * weight[:, None]
                times[:, width] = weight
                total[:, :width + 1] += own @ times
                if measured:
                    lengths = (x * x).sum(1)
                    total[:, width + 2] += own @ (lengths * weight)
                    for lo, hi, gaps in zip(cuts[:-1], cuts[1:], least):
                        total[lo:hi, width + 1] += own[lo:hi] @ (np.maximum(2.0 * gaps + lengths, 0.0) * weight)
        if total[:, width].any():
            # One row per model: the rows of its centers, one after the other.
            yield pd.DataFrame({"model": np.arange(len(cuts) - 1), "total": [total[lo:hi].ravel() for lo, hi in zip(cuts[:-1], cuts[1:])]})

    partial = blocks.mapInPandas(step, "model long, total array<double>").withColumn("total", array_to_vector("total"))
    sums = partial.groupBy("model").agg(Summarizer.metrics("sum").summary(F.col("total")).alias("s"))
    out = np.zeros((len(centers), wide))
    for row in sums.select("model", vector_to_array("s.sum").alias("sum")).toPandas().itertuples():
        out[offsets[row.model]:offsets[row.model + 1]] = np.asarray(row.sum).reshape(-1, wide)
    sent.unpersist()
    return out[:, :width], *out[:, width:].T


def fit_all(blocks: DataFrame, starts: dict[int, np.ndarray], ks: Sequence[int], max_iter: int, tol: float) -> list[Model]:
    """Lloyd's steps for every k and start at once; a model rests when none of its centers moves by more than ``tol``.

    A center without points stays where it is. The sum of squares is taken to the final centers.
    """
    centers = {(k, s): x[:k].copy() for s, x in starts.items() for k in ks if len(x)}
    steps = dict.fromkeys(centers, 0)
    moving = sorted(centers)
    for _ in range(max_iter):
        if not moving:
            break
        sums, members = _summed(blocks, [centers[m] for m in moving])
        at, rest = 0, []
        for m in moving:
            size = len(centers[m])
            n = members[at:at + size, None]
            moved = np.where(n > 0, sums[at:at + size] / np.maximum(n, 1), centers[m])
            shift = ((moved - centers[m]) ** 2).sum(1).max()
            centers[m], steps[m], at = moved, steps[m] + 1, at + size
            if shift > tol * tol:
                rest.append(m)
        moving = rest
    order = sorted(centers)
    if not order:
        return []
    _, members, costs, _ = _summed(blocks, [centers[m] for m in order], measured=True)
    out, at = [], 0
    for k, s in order:
        size = len(centers[k, s])
        out.append(Model(k, s, centers[k, s], members[at:at + size], float(costs[at:at + size].sum()), steps[k, s]))
        at += size
    return out


def best_of(models: Sequence[Model]) -> dict[int, Model]:
    """The model of the smallest sum of squares per k; sums that agree in six digits count as equal, the first start wins."""
    best: dict[int, Model] = {}
    for m in sorted(models, key=lambda m: (m.k, round(m.sse, 6), m.start)):
        best.setdefault(m.k, m)
    return best


def silhouettes(blocks: DataFrame, models: Sequence[Model]) -> list[float | None]:
    """Mean squared Euclidean silhouette per model: two scans for all of them. None where all points are in one cluster.

    The mean distance of a point to a cluster follows from the cluster's sum, number and squared lengths.
    """
    fitted = [m.centers for m in models]
    sums, members, _, lengths = _summed(blocks, fitted, measured=True)
    offsets, width = np.cumsum([0, *map(len, fitted)]), sums.shape[1]
    sent = blocks.sparkSession.sparkContext.broadcast((np.vstack(fitted), offsets, sums, members, lengths))

    def measure(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at_all, cuts, total, size, squares = sent.value
        out = np.zeros(len(cuts) - 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = np.where(size > 0, squares / size, np.inf)
            for batch in batches:
                for n, raw in zip(batch["n"], batch["block"]):
                    rows = np.frombuffer(raw, dtype=np.float64).reshape(n, width + 1)
                    x, weight = np.ascontiguousarray(rows[:, :width]), rows[:, width]
                    gaps = (x * x).sum(1)[:, None] + mean[None, :] - 2.0 * (x @ np.where(size[:, None] > 0, total / size[:, None], 0.0).T)
                    for i, (lo, at) in enumerate(_nearest(x, at_all, cuts)):
                        part, own = gaps[:, lo:cuts[i + 1]].copy(), size[lo + at]
                        a = part[np.arange(n), at] * own / (own - 1)
                        part[np.arange(n), at] = np.inf
                        b = part.min(1)
                        value = np.where(own > 1, (b - a) / np.maximum(a, b), 0.0)
                        out[i] += np.where(np.isfinite(value), value, 0.0) @ weight
        yield pd.DataFrame({"model": np.arange(len(out)), "total": out})

    found = blocks.mapInPandas(measure, "model long, total double").groupBy("model").agg(F.sum("total").alias("total"))
    totals = {r["model"]: r["total"] for r in found.collect()}
    sent.unpersist()
    out = []
    for i, m in enumerate(models):
        used = members[offsets[i]:offsets[i + 1]]
        out.append(float(totals[i] / used.sum()) if (used > 0).sum() > 1 else None)
    return out


def variance_ratio(model: Model) -> float | None:
    """Between-cluster over within-cluster variance (Calinski and Harabasz)."""
    size = model.members
    n, used = size.sum(), int((size > 0).sum())
    if used < 2 or model.sse <= 0 or n <= used:
        return None
    middle = size @ model.centers / n
    between = float((size * ((model.centers - middle) ** 2).sum(1)).sum())
    return float((between / (used - 1)) / (model.sse / (n - used)))


def sweep(
    df: DataFrame, vec: Column, id_col: str, ks: Sequence[int], restarts: int, max_iter: int, tol: float,
) -> tuple[list[tuple[int, float, float | None, float | None]], dict[int, Model]]:
    """(k, sse, silhouette, ch) per k, and the best model of each k."""
    points = df.select(F.col(id_col).alias("_id"), vec.alias("_vec"))
    starts = start_points(points, "_id", "_vec", restarts, max(ks))
    blocks = stored_blocks(points, "_vec").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        best = best_of(fit_all(blocks, starts, list(ks), max_iter, tol))
        models = [best[k] for k in sorted(best)]
        shapes = silhouettes(blocks, models) if models else []
    finally:
        blocks.unpersist()
    return [(m.k, m.sse, s, variance_ratio(m)) for m, s in zip(models, shapes)], best

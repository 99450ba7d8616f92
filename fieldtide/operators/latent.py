"""Text vectors from the strongest axes of the weighted word counts (latent semantic analysis).

The matrix A has one row per text and one column per word bucket; it stays distributed, as one sparse row per text. Block
power iteration needs only A'AQ for a thin matrix Q: every task adds up its own rows' part and Spark adds these, one row
per bucket, so what the driver orthogonalises has the size of the axes, whatever the number of texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtide.functions import text as tx
from fieldtide.session import stored

ENTRIES = 1 << 16  # entries of A that a task multiplies at a time; a text has as many as buckets at most


def bucket(word: Column, buckets: int) -> Column:
    """The first 32 bits of the word's MD5, modulo ``buckets``."""
    return (F.conv(F.left(F.md5(word), F.lit(8)), 16, 10).cast("long") % buckets).cast("int")


@dataclass(frozen=True)
class Axes:
    """Orthonormal axes (buckets x rank), strongest first, with the weights of the buckets."""

    axes: np.ndarray
    strengths: np.ndarray  # singular values
    share: float  # share of the sum of squares of all texts that the axes keep
    weights: np.ndarray

    def vectors(self, df: DataFrame, text_col: str, out: str = "features") -> DataFrame:
        """The input with ``out``: the unit vector of each text on the axes; the zero vector where no axis sees a word."""
        axes, weights, count = self.axes, self.weights, len(self.weights)

        @F.pandas_udf("array<double>")
        def placed(found: pd.Series) -> pd.Series:
            def one(at):
                if at is None or not len(at):
                    return np.zeros(axes.shape[1])
                used, n = np.unique(at, return_counts=True)
                place = (n * weights[used]) @ axes[used]
                length = np.sqrt(place @ place)
                return place / length if length > 1e-12 else np.zeros(axes.shape[1])

            return found.map(one)

        words = F.transform(tx.tokens(F.lower(F.col(text_col))), lambda w: bucket(w, count))
        return df.withColumn(out, array_to_vector(placed(words)))


def _pack(weights: np.ndarray):
    def pack(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            columns, values = [], []
            for at in batch["found"]:
                used, n = np.unique(np.asarray(at, dtype=np.int32), return_counts=True)
                weighted = n * weights[used]
                length = np.sqrt(weighted @ weighted)
                if length > 0:
                    columns.append(used)
                    values.append(weighted / length)
            if columns:
                yield pd.DataFrame({"columns": columns, "found": values})

    return pack


def _slices(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, last + 1) of runs of texts with up to ``ENTRIES`` entries together, or of one text; ``ends`` starts with 0."""
    lo = 0
    while lo < len(ends) - 1:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + ENTRIES, "right")) - 1)
        yield lo, hi
        lo = hi


def _summed_rows(keys: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Rows of ``values`` added up per key."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    starts = np.flatnonzero(np.r_[True, np.diff(ordered) != 0])
    out = np.zeros((size, values.shape[1]))
    out[ordered[starts]] = np.add.reduceat(values[order], starts, axis=0)
    return out


def _gram_times(rows: DataFrame, q: np.ndarray) -> np.ndarray:
    """A'A q."""
    sent = rows.sparkSession.sparkContext.broadcast(q)

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = sent.value
        total = np.zeros_like(at)
        for batch in batches:
            columns, found = (batch.column(i) for i in (0, 1))
            ends = np.concatenate([[0], np.cumsum(columns.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            columns, found = (x.flatten().to_numpy(zero_copy_only=False) for x in (columns, found))
            for lo, hi in _slices(ends):
                c, v, starts = columns[ends[lo]:ends[hi]], found[ends[lo]:ends[hi]], ends[lo:hi] - ends[lo]
                y = np.add.reduceat(v[:, None] * at[c], starts, axis=0)
                total += _summed_rows(c, v[:, None] * np.repeat(y, np.diff(ends[lo:hi + 1]), axis=0), len(at))
        seen = np.flatnonzero(np.abs(total).sum(1))
        if len(seen):
            yield pa.RecordBatch.from_pandas(pd.DataFrame({"bucket": seen, "total": list(total[seen])}), preserve_index=False)

    partial = rows.mapInArrow(step, "bucket long, total array<double>").withColumn("total", array_to_vector("total"))
    sums = partial.groupBy("bucket").agg(Summarizer.metrics("sum").summary(F.col("total")).alias("s"))
    out = np.zeros_like(q)
    for row in sums.select("bucket", vector_to_array("s.sum").alias("s")).toLocalIterator():
        out[row["bucket"]] = row["s"]
    sent.unpersist()
    return out


def latent_axes(df: DataFrame, text_col: str, rank: int = 64, buckets: int = 4096, steps: int = 8) -> Axes:
    """The ``rank`` strongest axes of the texts' unit vectors of hashed words, weighted as in ``clustering.embed_text``.

    Truncated singular value decomposition by block power iteration, with twice as many axes as asked for on the way.
    Texts without words (null ones too) add nothing; more axes than there is variance are left out. A sign is fixed by
    the largest entry of its axis, so that runs agree. The axes are found when this is called, in ``steps`` + 2 scans.
    """
    words = df.select(F.transform(tx.tokens(F.lower(F.col(text_col))), lambda w: bucket(w, buckets)).alias("found"))
    words = stored(words, "latent-words")
    seen = words.select(F.explode(F.array_distinct("found")).alias("bucket")).groupBy("bucket").count().collect()
    used, total = np.zeros(buckets), words.count()
    for row in seen:
        used[row["bucket"]] = row["count"]
    weights = np.log((total + 1) / (used + 1))
    packed = words.where(F.size("found") > 0).mapInPandas(_pack(weights), "columns array<int>, found array<double>")
    rows = stored(packed, "latent-rows")
    texts = rows.count()
    wide = min(2 * rank, buckets, max(texts, 1))
    q, _ = np.linalg.qr(np.random.default_rng(0).standard_normal((buckets, wide)))
    for _ in range(steps):
        q, _ = np.linalg.qr(_gram_times(rows, q))
    small = q.T @ _gram_times(rows, q)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    keep = np.argsort(-values)[:rank]
    keep = keep[values[keep] > 1e-9]
    axes = q @ turn[:, keep]
    axes *= np.sign(axes[np.abs(axes).argmax(0), np.arange(len(keep))])[None, :] if len(keep) else 1.0
    # All rows have length one, so their squares sum to the number of texts with words.
    share = float(values[keep].sum() / texts) if texts else 0.0
    return Axes(axes, np.sqrt(values[keep]), share, weights)

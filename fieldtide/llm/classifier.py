"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAD = 256            # symbol before and after a text
WIDTH = 6            # bytes that a filter sees
FILTERS = 16
HIDDEN = 16
HALF = 256           # chunks are 2 * HALF bytes and start every HALF bytes
SAMPLE_ROWS = 1500   # bound on the labelled rows of each class that the network is fitted on
AT_ONCE = 512        # chunks whose responses are held at a time in training
EPOCHS = 14
BLOCK = 16384        # bytes convolved at once


@dataclass
class ByteCNN:
    """Filters over bytes, the largest response per chunk, then mean, most and least over chunks into one probability."""

    table: np.ndarray    # WIDTH x 257 x FILTERS
    bias: np.ndarray
    hidden: np.ndarray   # 3 * FILTERS x HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float

    def _pairs(self) -> list[np.ndarray]:
        """Neighbouring byte tables added up: one look-up serves two bytes."""
        if "_two" not in self.__dict__:
            t = self.table
            self._two = [np.ascontiguousarray((t[i][:, None] + t[i + 1][None]).reshape(-1, FILTERS)) for i in range(0, WIDTH, 2)]
        return self._two

    def pooled(self, text: str | None) -> np.ndarray:
        """Largest response of each filter in each overlapping chunk; the chunks cover the whole text."""
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        two, n = self._pairs(), len(raw) + WIDTH
        halves = []
        for at in range(0, n, BLOCK):
            stop = min(n, at + BLOCK)
            # Symbols at .. stop + WIDTH of the text with WIDTH pads on either side.
            part = np.full(stop - at + WIDTH, PAD, np.int32)
            a, b = max(at, WIDTH), min(stop + WIDTH, len(raw) + WIDTH)
            if a < b:
                part[a - at:b - at] = raw[a - WIDTH:b - WIDTH]
            both = part[:-1] * 257 + part[1:]
            size = stop - at
            response = two[0][both[:size]]
            for k in range(1, len(two)):
                response += two[k][both[2 * k:2 * k + size]]
            halves.append(np.maximum.reduceat(response, np.arange(0, size, HALF), axis=0))
        half = np.concatenate(halves)
        whole = np.maximum(half[:-1], half[1:]) if len(half) > 1 else half
        return np.maximum(whole + self.bias, 0)

    def score(self, text: str | None) -> float:
        h = self.pooled(text)
        x = np.concatenate([h.mean(0), h.max(0), h.min(0)])
        z = np.maximum(x @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def chunks_of(text: str | None) -> list[np.ndarray]:
    """Padded symbols of all chunks of a text."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8).astype(np.int16)
    padded = np.concatenate([np.full(WIDTH, PAD, np.int16), raw, np.full(WIDTH, PAD, np.int16)])
    n = len(raw) + WIDTH
    count = max(1, -(-n // HALF) - 1)
    out = []
    for s in np.arange(count) * HALF:
        part = padded[s:s + 2 * HALF + WIDTH]
        out.append(np.concatenate([part, np.full(2 * HALF + WIDTH - len(part), PAD, np.int16)]))
    return out


def fit(chunks: np.ndarray, doc: np.ndarray, label: np.ndarray, prior: float, seed: int = 5, epochs: int = EPOCHS, batch: int = 32) -> ByteCNN:
    """Train on documents given as chunks (rows of symbols), their document number, and a label per document.

    Adam on the logistic loss, gradients by hand: the largest response sends its gradient to the six symbols that made it.
    ``label`` should be balanced; ``prior`` is the true share of label 1 and moves the last bias.
    """
    draw = np.random.default_rng(seed)
    p = {
        "table": draw.normal(0, 0.25, (WIDTH, 257, FILTERS)).astype(np.float32), "bias": np.zeros(FILTERS, np.float32),
        "hidden": draw.normal(0, 0.2, (3 * FILTERS, HIDDEN)).astype(np.float32), "hidden_bias": np.zeros(HIDDEN, np.float32),
        "out": draw.normal(0, 0.3, HIDDEN).astype(np.float32), "out_bias": np.zeros(1, np.float32),
    }
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    starts = np.searchsorted(doc, np.arange(len(label)))
    ends = np.searchsorted(doc, np.arange(len(label)), side="right")
    step, span = 0, 2 * HALF
    for epoch in range(epochs):
        rate = 0.01 * 0.5 * (1 + np.cos(np.pi * epoch / epochs)) + 2e-4
        order = draw.permutation(len(label))
        for at in range(0, len(order), batch):
            docs = order[at:at + batch]
            rows = np.concatenate([np.arange(starts[d], ends[d]) for d in docs])
            cut = np.cumsum([0] + [ends[d] - starts[d] for d in docs])
            where, top = np.empty((len(rows), FILTERS), np.int64), np.empty((len(rows), FILTERS), np.float32)
            for lo in range(0, len(rows), AT_ONCE):
                x = chunks[rows[lo:lo + AT_ONCE]]
                response = p["table"][0][x[:, :span]]
                for j in range(1, WIDTH):
                    response += p["table"][j][x[:, j:j + span]]
                where[lo:lo + AT_ONCE] = response.argmax(1)              # rows x filters
                top[lo:lo + AT_ONCE] = np.take_along_axis(response, where[lo:lo + AT_ONCE][:, None], 1)[:, 0]
            h = np.maximum(top + p["bias"], 0)
            feats, tops, lows = [], [], []
            for a, b in zip(cut[:-1], cut[1:]):
                part = h[a:b]
                tops.append(a + part.argmax(0))
                lows.append(a + part.argmin(0))
                feats.append(np.concatenate([part.mean(0), part.max(0), part.min(0)]))
            f = np.stack(feats)
            a1 = f @ p["hidden"] + p["hidden_bias"]
            r1 = np.maximum(a1, 0)
            z = r1 @ p["out"] + p["out_bias"]
            dz = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[docs]) / len(docs)).astype(np.float32)
            g = {"out": r1.T @ dz, "out_bias": np.array([dz.sum()], np.float32)}
            da = (dz[:, None] * p["out"]) * (a1 > 0)
            g["hidden"], g["hidden_bias"] = f.T @ da, da.sum(0)
            df = da @ p["hidden"].T
            dh = np.repeat(df[:, :FILTERS] / np.diff(cut)[:, None], np.diff(cut), axis=0)
            cols = np.arange(FILTERS)
            for i in range(len(docs)):
                dh[tops[i], cols] += df[i, FILTERS:2 * FILTERS]
                dh[lows[i], cols] += df[i, 2 * FILTERS:]
            dh = dh * (h > 0)
            g["bias"] = dh.sum(0)
            g["table"] = np.zeros_like(p["table"])
            for j in range(WIDTH):
                cell = chunks[rows[:, None], where + j].astype(np.int64) * FILTERS + cols
                g["table"][j] = np.bincount(cell.ravel(), dh.ravel(), 257 * FILTERS).reshape(257, FILTERS)
            step += 1
            for k in p:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.99 * second[k] + 0.01 * g[k] ** 2
                p[k] = (p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    shift = np.log(prior / (1 - prior)) - np.log(label.mean() / (1 - label.mean()))
    return ByteCNN(p["table"], p["bias"], p["hidden"], p["hidden_bias"], p["out"], float(p["out_bias"][0] + shift))


def held_out(key: str = "doc_id") -> Column:
    """Rows that are never learnt from: a fifth, by the checksum of the key as text."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          rows: int = SAMPLE_ROWS, seed: int = 5) -> ByteCNN | None:
    """Fit on a bounded sample of the labelled rows that are not held out: at most ``rows`` of each label, the first by a
    hash of the key, with all chunks of their texts. Of texts that share a key one is taken, by hash. Rows whose labels
    contradict are left out. None without both labels."""
    known = labels.where(F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).alias("y"), F.max(label).alias("_max"))
    known = known.where((F.col("y") == F.col("_max")) & F.col(key).isNotNull() & ~held_out(key)).drop("_max")
    share = known.agg(F.avg(F.col("y").cast("double"))).first()[0]
    if share is None or share in (0.0, 1.0):
        return None
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64(key, F.lit(seed)), key).limit(rows) for y in (0, 1)]
    picked = picked[0].unionByName(picked[1])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "y": batch["y"], "parts": [np.concatenate(chunks_of(t)).tobytes() for t in batch["text"]]})

    # At most 2 * rows ids, so they may be broadcast.
    wanted = docs.join(F.broadcast(picked), key).select(F.col(key).alias("id"), "y", F.col(text).alias("text"))
    wanted = wanted.groupBy("id", "y").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    got = wanted.mapInPandas(cut, "id long, y int, parts binary").toPandas().sort_values("id", ignore_index=True)
    if got["y"].nunique() < 2:
        return None
    span = 2 * HALF + WIDTH
    parts = [np.frombuffer(p, np.int16).reshape(-1, span) for p in got["parts"]]
    doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return fit(np.concatenate(parts), doc, got["y"].to_numpy(np.float32), float(share), seed)


def scored(model: ByteCNN | None, text: Column) -> Column:
    """Score of whole texts; without a model every score is 0.5."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([model.score(t) for t in part], dtype="float64")

    return score(text)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.3, **sample: int) -> DataFrame:
    """Add ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 from ``threshold`` on) to every row.

    The text alone makes the score; null and empty texts are scored as text of padding only. Rows with equal texts
    have equal scores; an empty table gives no rows; columns named score or predicted are replaced.
    """
    model = train(docs, labels, key, text, **sample)
    rows = docs.drop(*[c for c in ("score", "predicted") if c in docs.columns and c not in (key, text)])
    out = rows.withColumn("score", scored(model, F.col(text)))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

"""Non-linear features of waveforms by seeded convolution kernels, and a descent
whose loss is known after every epoch.

``kernel_features``: each kernel of ``KERNEL`` weights runs over each phase of a
waveform (zeros beyond its ends); where the response is above the kernel's bias
the feature is 1, else 0.  The weights are whole numbers from -2 to 2 made from a
seed, the same for all phases; missing samples are 0.  The steps are what a linear
model on the samples cannot say: that a phase moved, and not by how much.

``descend``: logistic regression by whole-batch gradient steps.  Each epoch is one
pass over the written rows, in which every task sums its gradients and losses;
one number per weight comes to the driver, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from gridwave.constants import SELECTION_EPOCHS
from gridwave.operators.model import EPS

KERNELS, KERNEL, SEED = 4, 3, 7


def kernel_weights(kernels: int = KERNELS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(weights, biases): row k has ((seed + 3 k + 2 i + k i) mod 5) - 2, its bias is k mod 2."""
    k, i = np.arange(kernels)[:, None], np.arange(KERNEL)[None, :]
    return ((seed + 3 * k + 2 * i + k * i) % 5 - 2).astype(float), (np.arange(kernels) % 2).astype(float)


def responses(waves: np.ndarray, kernels: int, seed: int) -> np.ndarray:
    """(N, T, phases) -> (N, T * phases * kernels) steps of 0 and 1."""
    weights, bias = kernel_weights(kernels, seed)
    edge = KERNEL // 2
    padded = np.pad(waves, ((0, 0), (edge, KERNEL - 1 - edge), (0, 0)))
    windows = np.lib.stride_tricks.sliding_window_view(padded, KERNEL, axis=1)
    return (windows @ weights.T > bias).astype(float).reshape(len(waves), -1)


def kernel_features(signal: Column, kernels: int = KERNELS, seed: int = SEED) -> Column:
    """array<array<double>> (T x phases) -> array<double>, by time, then phase, then kernel.

    A null waveform gives null, one whose rows differ in length fails the query;
    an empty one gives an empty array.
    """
    @F.pandas_udf(ArrayType(DoubleType()))
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for waves in batches:
            out = pd.Series([None] * len(waves), dtype=object)
            arrays = {i: np.nan_to_num(np.array([list(r) for r in w], float)) for i, w in enumerate(waves) if w is not None}
            for shape in {a.shape for a in arrays.values()}:
                at = [i for i, a in arrays.items() if a.shape == shape]
                rows = responses(np.stack([arrays[i] for i in at]), kernels, seed) if len(shape) == 2 else [[]] * len(at)
                for i, r in zip(at, rows):
                    out[i] = np.asarray(r)
            yield out
    return made(signal)


def _sums(batches: Iterator[pa.RecordBatch], w: np.ndarray, b: float) -> Iterator[pa.RecordBatch]:
    """Of a task's rows: gradient, its bias, train and validation loss and counts, by place."""
    d = len(w)
    total = np.zeros(d + 5)
    for batch in batches:
        if not batch.num_rows:
            continue
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d)
        y = batch.column("y").to_numpy(zero_copy_only=False)
        train = batch.column("train").to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore"):
            p = 1 / (1 + np.exp(-(x @ w + b)))
        q = np.clip(p, EPS, 1 - EPS)
        loss = -(y * np.log(q) + (1 - y) * np.log(1 - q))
        off = np.where(train, p - y, 0.0)
        total += np.concatenate([x.T @ off, [off.sum(), loss[train].sum(), train.sum(), loss[~train].sum(),
                                             (~train).sum()]])
    yield pa.record_batch([pa.array(np.arange(d + 5)), pa.array(total)], names=["at", "s"])


def descend(rows: DataFrame, label: str, features: str, split: str = "split", epochs: int = SELECTION_EPOCHS,
            rate: float = 1.0, scale: float = 1.0) -> tuple[DataFrame, np.ndarray, float]:
    """(curve, weights, bias) after ``epochs`` steps from zero on the rows of split ``train``.

    The curve has (epoch, train_loss, val_loss) before each step, and after the
    last.  Every step starts from the one before.  ``scale`` multiplies the
    features.  Pass a written table: it is read once per epoch.  Rows without
    features are left out; losses of an empty split are null.
    """
    spark = rows.sparkSession
    data = rows.filter(F.col(features).isNotNull() & F.col(split).isin("train", "val")).select(
        F.transform(features, lambda v: v * F.lit(float(scale))).alias("x"), F.col(label).cast("double").alias("y"),
        (F.col(split) == "train").alias("train"))
    width = data.select(F.size("x")).first()
    w, b, curve = np.zeros(width[0] if width else 0), 0.0, []
    for epoch in range(epochs + 1):
        sums = data.mapInArrow(lambda it, w=w, b=b: _sums(it, w, b), "at long, s double") \
            .groupBy("at").agg(F.sum("s").alias("s")).collect()
        s = np.zeros(len(w) + 5)
        for r in sums:
            s[r["at"]] = r["s"]
        n, loss, n_train, val, n_val = len(w), *s[len(w) + 1:].tolist()
        curve.append((epoch, loss / n_train if n_train else None, val / n_val if n_val else None))
        if epoch < epochs and n_train:
            w, b = w - rate * s[:n] / n_train, b - rate * s[n] / n_train
    return spark.createDataFrame(curve, "epoch int, train_loss double, val_loss double"), w, b

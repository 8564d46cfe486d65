"""Kernel features against plain loops, the descent against plain numpy, and what the kernels are good for."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from gridwave.operators import kernels as KN
from gridwave.operators import model as MD
from gridwave.plans import catalog as CA
from gridwave.session import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def test_features_equal_plain_loops(spark):
    rng = np.random.default_rng(2)
    waves = [rng.normal(size=(t, p)).round(1).tolist() for t, p in ((6, 3), (6, 3), (1, 1), (9, 2))]
    waves[0][2][1] = None
    rows = [(k, w) for k, w in enumerate(waves)] + [(9, None), (10, [])]
    df = spark.createDataFrame(rows, "k int, w array<array<double>>")
    got = {r.k: r.f for r in df.select("k", KN.kernel_features(F.col("w"), 5, 11).alias("f")).collect()}
    weights, bias = KN.kernel_weights(5, 11)
    for k, w in enumerate(waves):
        want = []
        for t in range(len(w)):
            for p in range(len(w[0])):
                at = [(w[t + i][p] or 0.0) if 0 <= t + i < len(w) else 0.0 for i in (-1, 0, 1)]
                want += [float(sum(a * b for a, b in zip(at, weights[j])) > bias[j]) for j in range(5)]
        assert got[k] == want
    assert got[9] is None and got[10] == []
    assert set(np.unique(weights)) <= {-2, -1, 0, 1, 2}


def test_descent_equals_numpy(spark):
    rng = np.random.default_rng(4)
    x, names = rng.normal(size=(60, 3)), ["train", "val", "test"]
    y = (x[:, 0] + 0.3 * rng.normal(size=60) > 0).astype(int)
    rows = [([float(v) for v in x[i]], int(y[i]), names[i % 5 // 2]) for i in range(60)] + [(None, 1, "train")]
    df = spark.createDataFrame(rows, "features array<double>, y int, split string").repartition(7)
    curve, w, b = KN.descend(df, "y", "features", epochs=12, rate=0.7, scale=0.5)
    at = {s: [i for i in range(60) if names[i % 5 // 2] == s] for s in names}
    v, c, want = np.zeros(3), 0.0, []
    for epoch in range(13):
        p = 1 / (1 + np.exp(-(0.5 * x @ v + c)))
        loss = -(y * np.log(p) + (1 - y) * np.log(1 - p))
        want.append((epoch, loss[at["train"]].mean(), loss[at["val"]].mean()))
        if epoch < 12:
            off = (p - y)[at["train"]]
            v, c = v - 0.7 * (0.5 * x[at["train"]]).T @ off / len(off), c - 0.7 * off.mean()
    assert np.allclose([tuple(r) for r in curve.orderBy("epoch").collect()], want, atol=1e-10)
    assert np.allclose(w, v) and np.isclose(b, c)
    falling = [r[1] for r in want]
    assert falling == sorted(falling, reverse=True)


def test_descent_without_rows(spark):
    none = spark.createDataFrame([], "features array<double>, y int, split string")
    curve, w, b = KN.descend(none, "y", "features", epochs=2)
    assert [tuple(r) for r in curve.collect()] == [(k, None, None) for k in range(3)] and len(w) == 0 and b == 0


def test_kernels_lower_the_validation_loss(spark):
    split = CA._kernel_split(spark, SF_ORACLE)
    train, val = (split.filter(F.col("split") == s) for s in ("train", "val"))
    losses = []
    for width in (48, 240):
        rows = [df.withColumn("features", F.slice("features", 1, width)) for df in (train, val)]
        losses.append(MD.evaluation(MD.score(MD.fit(rows[0], "is_fault"), rows[1]), "is_fault").first()["loss"])
    assert losses[1] < 0.5 * losses[0]

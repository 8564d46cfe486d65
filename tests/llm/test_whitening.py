"""Whitening against a plain eigendecomposition, on plain and on hard rows."""

import math

import numpy as np
import pytest

from conftest import SF_SMALL
from gridwave.llm import spectra, whitening
from gridwave.session import ship_package

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def scatter(x):
    c = x - x.mean(0)
    return c.T @ c


RNG = np.random.default_rng(11)
MATRICES = {
    "plain": RNG.integers(-200, 200, (700, 24)) + 1_000_000,
    "repeated": np.repeat(RNG.integers(-5, 5, (10, 12)), 30, 0),
    "of low rank": RNG.integers(-200, 200, (400, 3)) @ RNG.integers(-2, 3, (3, 20)),
    "all alike": np.full((40, 5), 7),
    "bits": RNG.integers(0, 2, (300, 6)),
    "of many sizes": (RNG.standard_normal((500, 14)) * 10.0 ** np.arange(-2, 12)).astype(np.int64),
    "one row": np.arange(9).reshape(1, 9),
}


@pytest.mark.parametrize("kind", MATRICES)
@pytest.mark.parametrize("block", [1, 7, 1000])
def test_updates_equal_a_plain_decomposition(kind, block):
    x = MATRICES[kind]
    state = spectra.empty(x.shape[1])
    for k in range(0, len(x), block):
        state = spectra.absorb_block(state, x[k:k + block])
    half = [spectra.absorb_block(spectra.empty(x.shape[1]), p) for p in (x[:3], x[3:50], x[50:])]
    for n, mean, values, vectors in (state, spectra.combine(spectra.combine(half[0], half[1]), half[2])):
        m = scatter(x)
        size = max(1.0, np.abs(m).max())
        assert n == len(x) and np.allclose(mean, x.mean(0), rtol=1e-12)
        assert np.abs(values - np.linalg.eigvalsh(m)).max() < 1e-11 * size
        assert np.abs(vectors.T @ vectors - np.eye(len(mean))).max() < 1e-11
        assert np.abs((vectors * values) @ vectors.T - m).max() < 1e-11 * size


def test_roots_lie_between_their_poles():
    for k in (1, 2, 5, 40):
        d = np.sort(RNG.standard_normal(k) * 10.0 ** RNG.integers(-6, 6, k))
        w = RNG.random(k) * 10.0 ** RNG.integers(-20, 3, k)
        gaps = spectra.secular_roots(d, w)
        assert (np.diag(gaps) < 0).all() and (gaps[np.arange(k - 1), np.arange(1, k)] > 0).all()
        assert -gaps[-1, -1] <= w.sum() * (1 + 1e-12)


def plain(rows, components=16, scale=64, offset=1_000_000):
    """Rows that remain, and n, deviation, whitened, explained by numpy and whole numbers."""
    sizes = [len(v) for _, v in rows if whole(v)]
    dim = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    rows = [(i, [math.floor(scale * float(c)) + offset for c in v]) for i, v in rows if whole(v) and len(v) == dim]
    if not rows:
        return {}
    fit = sorted({tuple(x) for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, x in rows:
        c = np.array([(n * a - s) / n for a, s in zip(x, sums)])
        out.append((i, sum((n * a - s) ** 2 for a, s in zip(x, sums)), c @ vectors[:, :components]))
    return n, values, out


def whole(v):
    return bool(v) and all(c is not None and math.isfinite(c) for c in v)


def check(df, rows, components=16):
    n, values, want = plain(rows, components)
    got = {}
    for r in df.collect():
        got.setdefault(r.vec_id, []).append(r)
    top = min(components, len(values))
    floor = len(values) * 1e-14 * values[0]
    assert sum(map(len, got.values())) == len(want) * top
    signs = np.zeros(top)
    for i, dev, projected in want:
        mine = sorted(got[i], key=lambda r: r.component)
        times = len(mine) // top
        mine = mine[::times]
        assert [r.component for r in mine] == list(range(1, top + 1))
        assert all(r.n == n and r.deviation == (dev if dev < 2 ** 63 else None) for r in mine)
        for k, r in enumerate(mine):
            if values[k] <= floor:
                assert r.whitened is None and r.explained == 0
                continue
            assert abs(r.explained - values[k] / values.sum()) <= 1e-9 * r.explained
            assert r.identity_error <= 1e-8
            gap = min([abs(values[k] - values[j]) for j in range(len(values)) if j != k], default=values[0])
            if gap > 1e-6 * values[0]:
                w = projected[k] / np.sqrt(values[k])
                signs[k] = signs[k] or (np.sign(w * r.whitened) if abs(w) > 1e-3 else 0)
                assert abs(w * (signs[k] or 1) - r.whitened) < 1e-6 * max(1, abs(w)) or not signs[k]


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in df.collect()]
    out = whitening.whiten(df)
    assert out.columns == COLUMNS
    check(out, rows)


def test_whitened_fit_list_has_the_identity_as_covariance(spark):
    out = whitening.whiten(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))
    wide = out.groupBy("vec_id").pivot("component", list(range(1, 17))).agg({"whitened": "first"}).toPandas()
    w = wide.drop(columns="vec_id").to_numpy()
    _, first = np.unique(np.round(w, 9), axis=0, return_index=True)     # each distinct vector once
    assert np.abs(np.cov(w[first].T, bias=True) - np.eye(16)).max() < 1e-6
    assert out.select("identity_error").distinct().count() == 1


NAN, INF = float("nan"), float("inf")
HARD = [(1, [0.5, -1.25, 3.0]), (2, None), (3, []), (4, [1.0, None, 2.0]), (5, [NAN, 1.0, 2.0]), (6, [1.0, INF, 2.0]),
        (7, [0.1, 0.2, 0.3]), (8, [0.1, 0.2, 0.3]), (8, [0.1, 0.2, 0.3]), (9, [1.0, 2.0]), (10, [1.0, 2.0, 3.0, 4.0]),
        (11, [-7.0, 600.0, 0.0]), (12, [123456.0, -0.001, 1.0]), (13, [1e300, 1.0, 2.0]), (14, [0.0, -0.0, 1e-300])]


def test_hard_rows_and_names_that_clash(spark):
    df = spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in HARD],
                               "vec_id long, embedding array<double>, n int, body string, id double")
    check(whitening.whiten(df), [(i, v) for i, v in HARD if i != 13])
    check(whitening.whiten(df, components=2), [(i, v) for i, v in HARD if i != 13], 2)


def test_no_vectors(spark):
    for rows in ([], [(1, None), (2, [NAN]), (3, [])]):
        out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
        assert out.collect() == [] and out.columns == COLUMNS


def test_no_variance_and_directions_without_any(spark):
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id int, embedding array<float>"))
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one.collect()] == [(1, 0, None, 0.0, 0.0)] * 4
    rows = [(k, [float(k % 7), 5.0, float(k % 7) * 2]) for k in range(50)]
    check(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), rows)


def test_a_hot_vector_and_many_partitions(spark):
    rows = [(k, [0.25] * 20 if k % 3 == 0 else RNG.standard_normal(20).tolist()) for k in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        check(whitening.whiten(df), rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(1, [1e13]), (2, [-1e13]), (3, [0.0])]
    check(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), rows)


def test_packed_vectors_keep_their_values():
    u = np.array([[1, -2], [2 ** 15, 0], [-2 ** 15, 5], [2 ** 31 - 1, 1], [2 ** 31, 1], [-2 ** 40, 0], [32767, -32767]])
    packed = whitening._pack(u)
    got = np.concatenate(list(whitening._unpack(packed, 10)))
    assert (got == u + 10).all() and len(set(packed)) == len(u)

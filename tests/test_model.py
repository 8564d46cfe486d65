"""Classifier: metric aggregate vs brute force, plug-in scorer vs Spark ML,
registry round trip, odd-length waveforms score null."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridwave.operators import model as MD


def test_evaluation_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 300)
    p = np.clip(rng.random(300), 0, 1)
    p[0], p[1] = 0.0, 1.0   # exercise the clip
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, fault_score double")
    got = MD.evaluation(df, "y").first()
    pc = np.clip(p, MD.EPS, 1 - MD.EPS)
    loss = float(np.mean(-(y * np.log(pc) + (1 - y) * np.log(1 - pc))))
    pred = p >= 0.5
    tp, fp, fn = np.sum(pred & (y == 1)), np.sum(pred & (y == 0)), np.sum(~pred & (y == 1))
    assert math.isclose(got.loss, loss, rel_tol=1e-9)
    assert math.isclose(got.precision, tp / (tp + fp)) and math.isclose(got.recall, tp / (tp + fn))


def _toy(spark, n=200, dim=6):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, dim))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(int)
    rows = [(i, x[i].reshape(dim // 3, 3).tolist(), int(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, signal array<array<double>>, y int")
    return MD.waveform_features(df)


def test_fit_learns_and_plugin_scorer_agrees(spark):
    df = _toy(spark)
    model = MD.fit(df, "y", max_iter=50)
    scored = MD.score(model, df)
    m = MD.evaluation(scored, "y").first()
    assert m.precision > 0.9 and m.recall > 0.9
    udf = MD.external_scorer(MD.numpy_logistic(model), shape=(2, 3))
    both = scored.withColumn("plugin", udf(F.col("signal"))).collect()
    assert max(abs(r.fault_score - r.plugin) for r in both) < 1e-6


def test_plugin_scorer_odd_shape_scores_null(spark):
    df = spark.createDataFrame([(1, [[1.0, 2.0, 3.0]] * 4), (2, [[1.0, 2.0, 3.0]] * 3), (3, None)],
                               "id long, signal array<array<double>>")
    udf = MD.external_scorer(lambda: (lambda x: x.reshape(x.shape[0], -1).sum(axis=1)),
                             shape=(4, 3))
    out = {r.id: r.s for r in df.select("id", udf(F.col("signal")).alias("s")).collect()}
    assert out[1] == 24.0 and out[2] is None and out[3] is None


def test_registry_versions_and_production_load(spark, scratch):
    df = _toy(spark)
    m1 = MD.fit(df, "y", 5)
    m2 = MD.fit(df, "y", 20)
    MD.save_model(m1, scratch, "fd", {"loss": 1.0}, spark)
    MD.save_model(m2, scratch, "fd", {"loss": 0.5}, spark)
    reg = MD.model_versions(spark, scratch, "fd").orderBy("version").collect()
    assert [r.version for r in reg] == [1, 2]
    stages = {r.version: r.stage for r in MD.model_versions(spark, scratch, "fd").collect()}
    assert stages == {1: "Archived", 2: "Production"}
    loaded = MD.production_model(spark, scratch, "fd")
    a = MD.score(loaded, df).select("id", "fault_score").orderBy("id").collect()
    b = MD.score(m2, df).select("id", "fault_score").orderBy("id").collect()
    assert a == b


def test_score_null_features(spark):
    df = _toy(spark).withColumn("features", F.when(F.col("id") % 2 == 0, F.col("features")))
    model = MD.fit(_toy(spark), "y", 5)
    out = MD.score(model, df).collect()
    assert len(out) == 200
    assert all((r.fault_score is None) == (r.id % 2 == 1) for r in out)


def test_plugin_query_agrees_with_spark_ml(spark):
    from gridwave.plans import catalog as Q
    from conftest import SF_SMALL
    a = {(r.filename, r.frame): r.fault_score for r in Q.REGISTRY["score_waveforms"](spark, SF_SMALL).collect()}
    b = {(r.filename, r.frame): r.fault_score for r in Q.REGISTRY["score_plugin"](spark, SF_SMALL).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None and b[k] is None) or abs(a[k] - b[k]) <= 2e-6, k


def stages(spark, root):
    return {r.version: r.stage for r in MD.model_versions(spark, root, "fd").collect()}


def test_transitions_archive_the_version_before(spark, scratch):
    model = MD.fit(_toy(spark), "y", 1)
    for _ in range(3):
        MD.save_model(model, scratch, "fd", {"loss": 1.0}, spark, "Staging")
    assert stages(spark, scratch) == {1: "Staging", 2: "Staging", 3: "Staging"}
    MD.transition(spark, scratch, "fd", 2, "Production")
    MD.transition(spark, scratch, "fd", 3, "Production")
    assert stages(spark, scratch) == {1: "Staging", 2: "Archived", 3: "Production"}
    MD.transition(spark, scratch, "fd", 2, "Production")        # back again
    MD.transition(spark, scratch, "fd", 1, "Archived")
    assert stages(spark, scratch) == {1: "Archived", 2: "Production", 3: "Archived"}
    with pytest.raises(ValueError):
        MD.transition(spark, scratch, "fd", 9, "Production")
    with pytest.raises(ValueError):
        MD.transition(spark, scratch, "fd", 1, "Live")


def test_writers_at_once_keep_all_versions(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor
    model = MD.fit(_toy(spark), "y", 1)
    with ThreadPoolExecutor(4) as pool:
        paths = list(pool.map(lambda k: MD.save_model(model, scratch, "fd", {"k": k}, spark), range(4)))
    rows = MD.model_versions(spark, scratch, "fd").collect()
    assert sorted(r.version for r in rows) == [1, 2, 3, 4] and {r.path for r in rows} == set(paths)
    assert sorted(r.stage for r in rows) == ["Archived"] * 3 + ["Production"]


def test_tensor_scorer_scores_odd_shapes_null(spark):
    rows = [(1, [[1.0, 2.0], [3.0, None]]), (2, None), (3, [[1.0, 2.0]]), (4, [[1.0], [2.0]]), (5, [[0.0, 0.0], [0.0, 1.0]]),
            (6, [[1.0, 2.0], None])]
    df = spark.createDataFrame(rows, "k int, w array<array<double>>")
    score = MD.tensor_scorer(MD.broadcast_linear(spark, [1.0, 0.0, -1.0, 2.0]), (2, 2), batch=2)
    got = {r.k: r.s for r in df.select("k", score(df.w).alias("s")).collect()}
    assert {k for k, v in got.items() if v is None} == {2, 3, 4, 6}
    assert got[1] == pytest.approx(1 / (1 + np.exp(2))) and got[5] == pytest.approx(1 / (1 + np.exp(-2)))

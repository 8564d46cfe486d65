"""Waveform classifier on Spark ML: features, fit, selection, refit, evaluation,
persistence and scoring.

The reference trains a small CNN on the driver.  Here training stays on the
executors: a ``Pipeline(StandardScaler, LogisticRegression)`` over the
flattened T x 3 waveform.  Same interface (a fault probability per
waveform), not the same weights.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from gridwave import constants as C
from gridwave.session import path_exists, put_if_absent

EPS = 1e-7  # probability clip for the log loss


def flat_features(signal: Column) -> Column:
    """array<array<double>> (T x channels) -> array<double>; missing -> 0.0."""
    return F.transform(F.flatten(signal), lambda v: F.coalesce(v, F.lit(0.0)))


def waveform_features(frames: DataFrame, signal: str = "signal",
                      out: str = "features") -> DataFrame:
    return frames.withColumn(out, flat_features(F.col(signal)))


def classifier(max_iter: int = C.REFIT_EPOCHS, reg: float = 0.0) -> Pipeline:
    scaler = StandardScaler(inputCol="_vec", outputCol="_scaled", withMean=True, withStd=True)
    lr = LogisticRegression(featuresCol="_scaled", labelCol="label", maxIter=max_iter,
                            regParam=reg, probabilityCol="probability")
    return Pipeline(stages=[scaler, lr])


def _prepared(df: DataFrame, label: str, features: str = "features") -> DataFrame:
    return df.withColumn("_vec", array_to_vector(F.col(features))).withColumn(
        "label", F.col(label).cast("double"))


def fit(train: DataFrame, label: str, max_iter: int = C.REFIT_EPOCHS,
        features: str = "features") -> PipelineModel:
    return classifier(max_iter).fit(_prepared(train, label, features))


def score(model: PipelineModel, df: DataFrame, features: str = "features",
          out: str = "fault_score") -> DataFrame:
    """Adds the fault probability; rows without features score null.

    One pass over ``df``: a missing feature array is replaced by zeros of the
    model's width for the transform, and its score is nulled afterwards.
    """
    width = model.stages[0].mean.size
    zeros = F.array_repeat(F.lit(0.0), width)
    has = F.col(features).isNotNull()
    prepared = df.withColumn("_vec", array_to_vector(F.when(has, F.col(features)).otherwise(zeros)))
    scored = model.transform(prepared)
    return scored.select(*df.columns, F.when(has, vector_to_array(F.col("probability")).getItem(1))
                         .alias(out))


def evaluation(scored: DataFrame, label: str, prob: str = "fault_score",
               threshold: float = 0.5) -> DataFrame:
    """Binary cross-entropy, precision and recall in one aggregate."""
    y = F.col(label).cast("double")
    p = F.least(F.greatest(F.col(prob), F.lit(EPS)), F.lit(1 - EPS))
    pred = (F.col(prob) >= threshold).cast("double")
    agg = scored.filter(F.col(prob).isNotNull()).agg(
        F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("loss"),
        F.sum(pred * y).alias("tp"), F.sum(pred * (1 - y)).alias("fp"),
        F.sum((1 - pred) * y).alias("fn"), F.count(F.lit(1)).alias("n"))
    return agg.select(
        "loss",
        F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp")))
        .otherwise(F.lit(0.0)).alias("precision"),
        F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn")))
        .otherwise(F.lit(0.0)).alias("recall"),
        "n")


def select_budget(train: DataFrame, val: DataFrame, label: str,
                  budgets: Sequence[int] = (1, 2, 4, 8, 16, 32, C.SELECTION_EPOCHS)) -> DataFrame:
    """Fit once per iteration budget; report train and validation loss for each.

    The driver only loops over the handful of budgets; each fit and each
    evaluation is a distributed job.  Pass written tables: both are read once
    per budget and more.
    """
    spark = train.sparkSession
    rows = []
    for b in budgets:
        model = fit(train, label, b)
        tr = evaluation(score(model, train), label).first()
        va = evaluation(score(model, val), label).first()
        rows.append((int(b), float(tr["loss"]), float(va["loss"]),
                     float(va["precision"]), float(va["recall"])))
    return spark.createDataFrame(
        rows, "max_iter int, train_loss double, val_loss double, val_precision double, "
              "val_recall double")


# --------------------------------------------------------------------------- registry
# The log has a file for each entry, <root>/<name>/log/<number>.json, which is written
# under a hidden name and gets its own by a rename that fails where the number is taken:
# then the log is read again and the next number tried.
LOG_ENTRY = ("entry int, kind string, version int, path string, stage string, metrics string, "
             "test_loss double, test_precision double, test_recall double")
STAGES = ("None", "Staging", "Production", "Archived")


def _log_entries(spark: SparkSession, root: str, name: str) -> DataFrame:
    folder = f"{root}/{name}/log"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], LOG_ENTRY)
    return spark.read.schema(LOG_ENTRY).json(folder)


def _append(spark: SparkSession, root: str, name: str, make: Callable[[int], dict]) -> dict:
    """Append ``make(last version)`` to the log, after whatever others appended meanwhile."""
    while True:
        last, version = _log_entries(spark, root, name).agg(F.max("entry"), F.max("version")).first()
        entry = {"entry": (last or 0) + 1} | make(version or 0)
        folder = f"{root}/{name}/log"
        if put_if_absent(spark, f"{folder}/{entry['entry']:08}.json", (json.dumps(entry) + "\n").encode()):
            return entry


def save_model(model: PipelineModel, root: str, name: str, metrics: dict,
               spark: SparkSession, stage: str = "Production") -> str:
    """Save a model and log it as the next version; several writers each get their own.

    The folder is complete before the entry names it, and is never overwritten.
    """
    path = f"{root}/{name}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    numbers = {f"test_{k}": float(metrics[k]) for k in ("loss", "precision", "recall") if metrics.get(k) is not None}
    _append(spark, root, name, lambda last: {
        "kind": "version", "version": last + 1, "path": path, "stage": stage,
        "metrics": json.dumps(metrics, sort_keys=True), **numbers})
    return path


def transition(spark: SparkSession, root: str, name: str, version: int, stage: str) -> None:
    """Log that ``version`` is in ``stage`` from now on."""
    if stage not in STAGES:
        raise ValueError(f"no stage {stage!r}; there are {', '.join(STAGES)}")
    if not _log_entries(spark, root, name).filter((F.col("kind") == "version") & (F.col("version") == version)).count():
        raise ValueError(f"{name} has no version {version}")
    _append(spark, root, name, lambda last: {"kind": "stage", "version": version, "stage": stage})


def model_versions(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Every version with its stage: the one logged last, but a version that was
    moved to Production archives the one that was there before."""
    log = _log_entries(spark, root, name)
    now = log.groupBy("version").agg(F.max_by("stage", "entry").alias("stage"), F.max("entry").alias("since"))
    live = now.filter(F.col("stage") == "Production").agg(F.max("since")).first()[0]
    earlier = (F.col("stage") == "Production") & (F.col("since") < F.lit(live))
    stages = now.select("version", F.when(earlier, F.lit("Archived")).otherwise(F.col("stage")).alias("stage"))
    return log.filter(F.col("kind") == "version").drop("stage", "entry", "kind").join(stages, "version").select(
        F.lit(name).alias("name"), "version", "path", "stage", "metrics", "test_loss", "test_precision", "test_recall")


def production_model(spark: SparkSession, root: str, name: str) -> PipelineModel:
    live = model_versions(spark, root, name).filter(F.col("stage") == "Production")
    path = live.orderBy(F.col("version").desc()).first()["path"]
    return PipelineModel.load(path)


# --------------------------------------------------------------------------- plug-in scorer
def external_scorer(load: Callable[[], Callable[[np.ndarray], np.ndarray]],
                    shape: tuple[int, int] = (C.WAVEFORM_LENGTH, len(C.PHASE_CHANNELS))):
    """Scalar-iterator pandas UDF for a model that is not a Spark ML model.

    ``load`` runs once per Python worker (not per batch); the returned
    function maps a stacked (N, T, channels) array to N scores.  ``shape`` is
    the model's fixed input; other waveforms score null instead of failing
    the whole batch, whatever the batching.
    """
    @F.pandas_udf(DoubleType())
    def _score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load()
        for waveforms in batches:
            arrays = [None if w is None else np.vstack(w).astype(np.float64) for w in waveforms]
            ok = np.array([a is not None and a.shape == tuple(shape) for a in arrays], dtype=bool)
            out = np.full(len(arrays), np.nan)
            if ok.any():
                stacked = np.stack([np.nan_to_num(a) for a, k in zip(arrays, ok) if k])
                out[ok] = np.asarray(predict(stacked), dtype=np.float64).reshape(-1)
            # rejected shapes become nulls (a masked array), not NaN
            yield pd.Series(pd.arrays.FloatingArray(out, ~ok))
    return _score


def tensor_scorer(load: Callable[[], Callable[[np.ndarray], np.ndarray]],
                  shape: tuple[int, int] = (C.WAVEFORM_LENGTH, len(C.PHASE_CHANNELS)), batch: int = 1024) -> Callable:
    """``predict_batch_udf`` over waveforms of one shape: a function of the waveform column.

    Waveforms arrive as stacked tensors of ``batch`` rows; ``load`` runs once per
    Python worker.  Others than of that shape, and null ones, score null.
    """
    def make_predict():
        predict = load()
        return lambda flat: np.asarray(predict(flat), dtype=np.float64).reshape(-1)

    scorer = predict_batch_udf(make_predict, return_type=DoubleType(), batch_size=batch, input_tensor_shapes=[list(shape)])
    blank = F.array_repeat(F.lit(0.0), shape[0] * shape[1])

    def score_of(signal: Column) -> Column:
        fits = F.coalesce((F.size(signal) == shape[0]) & F.forall(signal, lambda r: F.coalesce(
            F.size(r) == shape[1], F.lit(False))), F.lit(False))
        return F.when(fits, scorer(F.when(fits, flat_features(signal)).otherwise(blank)))
    return score_of


def broadcast_linear(spark: SparkSession, weights: Sequence[float], intercept: float = 0.0) -> Callable:
    """Plain weights as a scorer whose model is sent to each executor once."""
    held = spark.sparkContext.broadcast(np.asarray(weights, dtype=np.float64))

    def load():
        coef = held.value
        return lambda x: 1.0 / (1.0 + np.exp(-(x.reshape(x.shape[0], -1) @ coef + intercept)))
    return load


def numpy_logistic(model: PipelineModel) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """The fitted pipeline as plain numpy (for the plug-in path and its tests)."""
    scaler, lr = model.stages[0], model.stages[1]
    mean = np.asarray(scaler.mean.toArray())
    std = np.asarray(scaler.std.toArray())
    coef = np.asarray(lr.coefficients.toArray())
    intercept = float(lr.intercept)

    def load():
        def predict(x: np.ndarray) -> np.ndarray:
            flat = x.reshape(x.shape[0], -1)
            z = np.where(std > 0, (flat - mean) / np.where(std > 0, std, 1.0), 0.0)
            return 1.0 / (1.0 + np.exp(-(z @ coef + intercept)))
        return predict
    return load


def numpy_linear(weights: Sequence[float], intercept: float = 0.0) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """Plain weights as a scorer: the logistic function of their dot product."""
    coef = np.asarray(weights, dtype=np.float64)

    def load():
        def predict(x: np.ndarray) -> np.ndarray:
            return 1.0 / (1.0 + np.exp(-(x.reshape(x.shape[0], -1) @ coef + intercept)))
        return predict
    return load

"""Training-set preparation: fixed-length frames, labels, seeded shuffle, split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwave import constants as C
from gridwave.operators.sequence import (DEFAULT_BUCKET_US, global_rank_by_hash, hash_order,
                                         ordered_index)

PHASES = list(C.PHASE_CHANNELS)


def frame_samples(samples: DataFrame, key: str, time_us: str, tiebreak: Sequence[str] = (),
                  frame_len: int = C.WAVEFORM_LENGTH, bucket_us: int = DEFAULT_BUCKET_US) -> DataFrame:
    """Tag each sample with its frame: (position - 1) div frame_len, per recording."""
    indexed = ordered_index(samples, [key], time_us, tiebreak, bucket_us=bucket_us, out="position")
    return indexed.withColumn("frame", F.floor((F.col("position") - 1) / F.lit(frame_len)))


def frame_waveforms(samples: DataFrame, key: str, time_us: str, tiebreak: Sequence[str] = (),
                    frame_len: int = C.WAVEFORM_LENGTH, channels: Sequence[str] = PHASES,
                    label_col: str | None = None, bucket_us: int = DEFAULT_BUCKET_US) -> DataFrame:
    """Non-overlapping frames of exactly ``frame_len`` samples; a short tail is dropped.

    Output: key, frame, signal (array<array<double>>, frame_len x channels) and,
    if ``label_col`` is given, the frame's label = label of its first sample.
    Groups are bounded by ``frame_len`` rows.
    """
    framed = frame_samples(samples, key, time_us, tiebreak, frame_len, bucket_us)
    row = F.struct(F.col("position"), F.array(*[F.col(c).cast("double") for c in channels]).alias("v"))
    aggs = [F.array_sort(F.collect_list(row)).alias("_rows"), F.count(F.lit(1)).alias("_n")]
    if label_col:
        aggs.append(F.min_by(F.col(label_col), F.col("position")).alias(label_col))
    grouped = framed.groupBy(key, "frame").agg(*aggs).filter(F.col("_n") == frame_len)
    out = [key, "frame", F.transform("_rows", lambda r: r["v"]).alias("signal")]
    if label_col:
        out.append(label_col)
    return grouped.select(*out)


def frame_labels(samples: DataFrame, key: str, time_us: str, label_col: str,
                 tiebreak: Sequence[str] = (), frame_len: int = C.WAVEFORM_LENGTH,
                 bucket_us: int = DEFAULT_BUCKET_US) -> DataFrame:
    """One label per complete frame: the label of the frame's first sample."""
    framed = frame_samples(samples, key, time_us, tiebreak, frame_len, bucket_us)
    return (framed.groupBy(key, "frame")
            .agg(F.min_by(F.col(label_col), F.col("position")).alias(label_col),
                 F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") == frame_len).drop("_n"))


def shuffle_order(frames: DataFrame, keys: Sequence[str], seed: int = C.SPLIT_SEED) -> DataFrame:
    """Seeded shuffle of whole waveforms: rank by md5(seed:key), key breaks ties.

    Stable under repartitioning and retries (unlike ``rand()``); the samples
    inside a waveform are untouched.
    """
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    ordered = frames.withColumn("_order", hash_order(seed, key))
    return global_rank_by_hash(ordered, "_order", list(keys), out="shuffle_rank").drop("_order")


def split_by_position(ranked: DataFrame, rank_col: str = "shuffle_rank",
                      total_col: str = "n_total",
                      train_fraction: float = C.TRAIN_FRACTION,
                      val_share: float = C.VAL_SHARE_OF_REST) -> DataFrame:
    """train = first int(n*0.7); val = next int((n-train)*0.5); test = the rest."""
    n = F.col(total_col)
    n_train = F.floor(n * F.lit(train_fraction))
    n_val = F.floor((n - n_train) * F.lit(val_share))
    r = F.col(rank_col)
    split = (F.when(r <= n_train, F.lit("train"))
             .when(r <= n_train + n_val, F.lit("val"))
             .otherwise(F.lit("test")))
    return ranked.withColumn("split", split)


def train_val_test_split(frames: DataFrame, keys: Sequence[str], seed: int = C.SPLIT_SEED,
                         train_fraction: float = C.TRAIN_FRACTION,
                         val_share: float = C.VAL_SHARE_OF_REST) -> DataFrame:
    return split_by_position(shuffle_order(frames, keys, seed),
                             train_fraction=train_fraction, val_share=val_share)


def split_sizes(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n_waveforms"))


def union_train_val(split: DataFrame) -> DataFrame:
    """Train and validation sets concatenated (the refit set).

    Written as one predicate on the split column rather than a union of two
    filters: same rows, but the split is computed once instead of twice.
    """
    return split.filter(F.col("split").isin("train", "val"))

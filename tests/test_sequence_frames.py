"""Skew-safe indexing, framing, shuffle and split: properties against brute force."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridwave import constants as C
from gridwave.operators import frames as FR
from gridwave.operators.sequence import global_rank_by_hash, hash_order, ordered_index


def test_ordered_index_matches_row_number_with_many_buckets(spark):
    # one hot key holds most rows; tiny buckets force many offset steps
    rows = [("hot", t, i) for i, t in enumerate(range(0, 5000, 3))]
    rows += [(f"k{j}", t, 10_000 + j * 100 + t) for j in range(20) for t in range(7)]
    df = spark.createDataFrame(rows, "key string, t long, id long")
    got = ordered_index(df, ["key"], "t", ["id"], bucket_us=50, out="rn")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("key").orderBy("t", "id")))
    assert sorted(got.collect()) == sorted(want.collect())


def test_ordered_index_ties_broken_by_tiebreak(spark):
    df = spark.createDataFrame([("a", 5, 3), ("a", 5, 1), ("a", 5, 2), ("a", 1, 9)],
                               "key string, t long, id long")
    got = {r.id: r.rn for r in ordered_index(df, ["key"], "t", ["id"], bucket_us=2).collect()}
    assert got == {9: 1, 1: 2, 2: 3, 3: 4}


def test_global_rank_is_dense_and_invariant_under_repartition(spark):
    df = spark.range(0, 3000).select(F.col("id").cast("string").alias("k"))
    ordered = df.withColumn("o", hash_order(42, F.col("k")))
    a = {r.k: r.rank for r in global_rank_by_hash(ordered, "o", ["k"]).collect()}
    b = {r.k: r.rank for r in global_rank_by_hash(ordered.repartition(7), "o", ["k"]).collect()}
    assert a == b
    assert sorted(a.values()) == list(range(1, 3001))
    expected = sorted(a, key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), k))
    assert [k for k, _ in sorted(a.items(), key=lambda kv: kv[1])] == expected


@settings(max_examples=25, deadline=None)
@given(st.integers(min_value=0, max_value=400))
def test_split_sizes_follow_reference_formula(n):
    train = int(n * 0.7)
    val = int((n - train) * 0.5)
    test = n - train - val
    # the same cut-offs as split_by_position, evaluated in plain Python
    ranks = range(1, n + 1)
    got = [("train" if r <= train else "val" if r <= train + val else "test") for r in ranks]
    assert got.count("train") == train and got.count("val") == val and got.count("test") == test


def test_split_sizes_on_spark(spark):
    for n in (0, 1, 7, 150, 151):
        df = spark.range(n).select(F.col("id").alias("k"))
        sizes = {r.split: r.n_waveforms for r in
                 FR.split_sizes(FR.train_val_test_split(df, ["k"])).collect()}
        train = int(n * C.TRAIN_FRACTION)
        val = int((n - train) * C.VAL_SHARE_OF_REST)
        assert sizes.get("train", 0) == train
        assert sizes.get("val", 0) == val
        assert sizes.get("test", 0) == n - train - val


def test_frames_drop_partial_tail_and_take_first_label(spark):
    rows = [("f", t, float(t), 0.0, 0.0, 1 if t == 0 else 0) for t in range(10)]
    df = spark.createDataFrame(rows, "filename string, t long, IA double, IB double, IC double, y int")
    fr = FR.frame_waveforms(df, "filename", "t", (), frame_len=4, label_col="y").orderBy("frame").collect()
    assert [r.frame for r in fr] == [0, 1]                      # 10 samples -> 2 full frames
    assert [r.y for r in fr] == [1, 0]
    assert [row[0] for row in fr[1].signal] == [4.0, 5.0, 6.0, 7.0]


def test_hot_recording_is_ranked_by_many_tasks(spark):
    """One recording holding most rows is spread over several tasks by its
    time buckets (a plain window would rank it in one task), and its ranks
    stay exact."""
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(0, 60_600).select(
            F.when(F.col("id") < 60_000, F.lit("hot"))
            .otherwise(F.concat(F.lit("k"), (F.col("id") % 30).cast("string"))).alias("key"),
            (F.col("id") * 7).alias("t"), F.col("id"))
        ranked = ordered_index(rows, ["key"], "t", ["id"], bucket_us=10_000)
        hot = ranked.filter(F.col("key") == "hot").select("rn", F.spark_partition_id().alias("p"))
        by_task = hot.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()
        assert len(by_task) > 1
        assert max(r.n for r in by_task) < 60_000
        agg = hot.agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first()
        assert tuple(agg) == (1, 60_000, 60_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_dense_bucket_is_ranked_by_several_tasks(spark):
    """One bucket of one key with far more rows than a task should sort."""
    n = 40_000
    df = spark.range(n).select(F.lit("hot").alias("k"), (F.col("id") * 7 % n).alias("t")) \
        .union(spark.range(100).select(F.lit("cold").alias("k"), F.col("id").alias("t")))
    ranked = ordered_index(df, ["k"], "t", bucket_us=1 << 30, rows_per_task=5_000)
    got = {(r.k, r.t): r.rn for r in ranked.collect()}
    assert got == {**{("hot", t): t + 1 for t in range(n)}, **{("cold", t): t + 1 for t in range(100)}}
    tasks = ranked.withColumn("p", F.spark_partition_id()).filter("k = 'hot'").groupBy("p").count().collect()
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < n

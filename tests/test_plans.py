"""Plan checks: built-ins stay in the JVM, filters reach the scan, no
whole-table single-partition steps where the data grows."""

from gridwave.plans import catalog as Q

from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_builtin_paths(spark):
    for name in ("decode_ascii", "flatten_long", "pivot_phases", "gather_waveform",
                 "frame_waveforms", "interval_join", "encode_recordings", "decode_ascii_lines"):
        p = plan(Q.REGISTRY[name](spark, SF_SMALL))
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas",
                     "FlatMapGroupsInPandas"):
            assert node not in p, (name, node)


def test_binary_decode_is_one_arrow_map(spark):
    p = plan(Q.REGISTRY["decode_binary"](spark, SF_SMALL))
    assert "PythonMapInArrow" in p or "MapInArrow" in p


def test_filters_and_projection_reach_parquet(spark):
    p = plan(Q.REGISTRY["interval_join"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in p


def test_global_rank_single_partition_step_sees_only_buckets(spark):
    """The only unpartitioned window in the split runs on the md5-bucket count
    table (at most 65,536 rows), never on the waveforms themselves."""
    from pyspark.sql import functions as F
    from gridwave.operators.sequence import global_rank_by_hash, hash_order
    n = 200_000
    df = spark.range(n).withColumn("o", hash_order(42, F.col("id")))
    ranked = global_rank_by_hash(df, "o", ["id"])
    unpartitioned = []
    stack = [ranked._jdf.queryExecution().sparkPlan()]
    while stack:
        node = stack.pop()
        kids = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Window" and node.partitionSpec().size() == 0:
            unpartitioned.append(kids[0].output().toString())
        stack.extend(kids)
    assert unpartitioned and all("_rank_n" in o for o in unpartitioned), unpartitioned
    agg = ranked.groupBy().agg(F.max("rank").alias("m"), F.countDistinct("rank").alias("d")).first()
    assert agg.m == n and agg.d == n


def test_interval_join_is_equi_on_key_and_bucket(spark):
    p = plan(Q.REGISTRY["interval_join"](spark, SF_SMALL))
    assert "_left_bucket" in p and "_right_bucket" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_ascii_branch_of_the_paired_table_has_no_python(spark):
    """Told apart by ``file_type``, ASCII pairs never meet a Python node."""
    from pyspark.sql import functions as F
    from gridwave.operators import decode as DE
    from gridwave.operators import encode as EN
    pairs = EN.encode_ascii(Q._captures(spark, SF_SMALL)).withColumn("file_type", F.substring_index("filename", "_", 1))
    node = DE.decode_recordings(pairs)._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Union":
        node = node.children().apply(0)
    text, other = node.children().apply(0).toString(), node.children().apply(1).toString()
    assert "ArrowEvalPython" not in text and "ArrowEvalPython" in other


def test_decoded_ascii_samples_never_meet_python(spark):
    """Kinds told apart by the header only: Python has the binary bodies, and one read gives both."""
    from gridwave.operators import decode as DE
    from gridwave.operators import encode as EN
    pairs = EN.encode_ascii(Q._captures(spark, SF_SMALL)).select("filename", "config_content", "dat_content")
    p = DE.decode_recordings(pairs)._jdf.queryExecution().executedPlan().toString()
    assert p.count("ArrowEvalPython") == 1 and "MapInArrow" not in p and "Union" not in p
    for name in ("decode_dialects", "convert_raw_text"):
        text = plan(Q.REGISTRY[name](spark, SF_SMALL))
        assert not any(node in text for node in ("MapInArrow", "ArrowEvalPython", "BatchEvalPython")), name

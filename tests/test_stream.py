"""Streaming: batch equals stream, join state is bounded, arrival tolerance is
inclusive, restarts do not duplicate, late rows are dropped."""

import os
import time

import pytest
from pyspark.sql import functions as F

import recording_fixtures as RF
from gridwave import constants as C
from gridwave.operators import decode as DE
from gridwave.operators import pairing as PR
from gridwave.sources import files as FS
from gridwave.streaming import pipeline as PL

from test_decode import write_pair


def _source(tmp, n=6):
    src = str(tmp / "src")
    for i in range(n):
        maker = (RF.ascii_3a, RF.binary_3a, RF.binary_status)[i % 3]
        write_pair(os.path.join(src, f"dev{i % 2}.d"), f"rec{i}", maker())
    return src


def test_batch_equals_stream_in_one_and_many_batches(spark, tmp_path):
    src = _source(tmp_path)
    batch = DE.decode_recordings(PR.pair_files(FS.scan_cfg(spark, src), FS.scan_dat(spark, src)))
    want = sorted((r[C.FILENAME], str(r[C.ANALOG]), str(r[C.STATUS])) for r in batch.collect())
    for max_files in (None, 1):
        run = PL.PipelineRun(spark, src, str(tmp_path / f"run{max_files}"),
                             max_files_per_trigger=max_files, register_tables=False)
        run.run(PL.ORDER[:4])
        got = sorted((r[C.FILENAME], str(r[C.ANALOG]), str(r[C.STATUS]))
                     for r in run.read(PL.RECORDINGS_SILVER).collect())
        assert got == want
        if max_files == 1:
            assert len(run.progress[PL.CONFIG_FILES_BRONZE]) >= 6


def test_restart_picks_up_only_new_files(spark, tmp_path):
    src = _source(tmp_path, n=2)
    run = PL.PipelineRun(spark, src, str(tmp_path / "run"), register_tables=False)
    run.run(PL.ORDER[:4])
    assert run.read(PL.RECORDINGS_SILVER).count() == 2
    run.run(PL.ORDER[:4])                       # nothing new: no duplicates
    assert run.read(PL.RECORDINGS_SILVER).count() == 2
    write_pair(os.path.join(src, "dev9.d"), "late_rec", RF.ascii_3a())
    run.run(PL.ORDER[:4])
    assert run.read(PL.RECORDINGS_SILVER).count() == 3


def test_pivot_and_flatten_agree_with_batch(spark, tmp_path):
    src = _source(tmp_path, n=3)
    run = PL.PipelineRun(spark, src, str(tmp_path / "run"), register_tables=False)
    run.run(list(PL.ORDER[:4]) + [PL.PIVOTED_CURRENT_SILVER, PL.FLATTENED_SILVER, PL.METADATA_SILVER])
    assert run.read(PL.PIVOTED_CURRENT_SILVER).count() == 3 * 4
    assert run.read(PL.FLATTENED_SILVER).count() == 3 * 4 * 3
    meta = run.read(PL.METADATA_SILVER).collect()
    assert len(meta) == 3 and {r.station_name for r in meta} == {"ST1"}


def test_one_gold_row_for_each_recording(spark, tmp_path):
    """Four samples a recording, frames of three: the short frame has no score, a run again adds nothing."""
    src = _source(tmp_path, n=3)
    run = PL.PipelineRun(spark, src, str(tmp_path / "run"), register_tables=False, frame_len=3)
    run.run(PL.ORDER[:4])
    for _ in range(2):
        rows = run.score_recordings("by_recording", lambda f: f.withColumn(
            "fault_score", F.when(F.col("length_ok"), F.col("frame") + F.lit(0.5)))).collect()
        assert sorted((r.frames, r.scored_frames, r.fault_score) for r in rows) == [(2, 1, 0.5)] * 3
    assert len({r[C.FILENAME] for r in rows}) == 3


def _touch(path, seconds):
    os.utime(path, (seconds, seconds))


@pytest.mark.parametrize("delay,paired", [(0, True), (300, True), (301, False)])
def test_arrival_tolerance_is_inclusive(spark, tmp_path, delay, paired):
    src = str(tmp_path / "src")
    write_pair(src, "m", RF.ascii_3a())
    base = int(time.time()) - 3600
    _touch(os.path.join(src, "m.cfg"), base)
    _touch(os.path.join(src, "m.dat"), base + delay)
    run = PL.PipelineRun(spark, src, str(tmp_path / "run"), register_tables=False)
    run.run(PL.ORDER[:3])
    n = run.read(PL.JOINED_FILES_BRONZE).count() if os.path.exists(
        run.path(PL.JOINED_FILES_BRONZE)) else 0
    assert n == (1 if paired else 0)


def test_join_state_is_evicted(spark, tmp_path):
    """Files arriving over a long span: with watermarks on the ingest clock and
    the range form the join keeps only recent rows in state."""
    src = str(tmp_path / "src")
    base = int(time.time()) - 10 * 86400
    for i in range(8):
        write_pair(src, f"r{i}", RF.ascii_3a())
        for ext in (".cfg", ".dat"):
            _touch(os.path.join(src, f"r{i}{ext}"), base + i * 3600)
    run = PL.PipelineRun(spark, src, str(tmp_path / "run"), max_files_per_trigger=2,
                         register_tables=False)
    run.run(PL.ORDER[:2])
    def one_file_per_batch(t):
        return (spark.readStream.schema(run.schemas[t]).option("maxFilesPerTrigger", "1")
                .parquet(run.path(t)).withColumn(PR.INGEST_TIME, F.col("modificationTime")))
    cfg = one_file_per_batch(PL.CONFIG_FILES_BRONZE)
    dat = one_file_per_batch(PL.DAT_FILES_BRONZE)
    joined = PR.interval_join_stream(cfg, dat, wait="30 minutes")
    q = (joined.writeStream.format("memory").queryName("jstate")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("jstate").count() == 8
    states = [op["numRowsTotal"] for p in q.recentProgress for op in p.get("stateOperators", [])]
    assert states and max(states) < 16          # never all 8 cfg + 8 dat rows at once


def test_keyed_pivot_is_append_legal(spark, tmp_path):
    src = _source(tmp_path, n=3)
    run = PL.PipelineRun(spark, src, str(tmp_path / "run"), register_tables=False)
    run.run(list(PL.ORDER[:4]) + [PL.FLATTENED_SILVER])
    piv = PL.keyed_pivot(run.read_stream(PL.FLATTENED_SILVER))
    q = (piv.writeStream.format("memory").queryName("kpiv").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None


def test_late_rows_are_dropped(spark):
    from gridwave.plans import catalog as Q
    from conftest import SF_SMALL
    out = Q.REGISTRY["stream_late"](spark, SF_SMALL)
    total = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    late = total.filter(F.date_format("ts", "yyyy-MM-dd") == "2024-01-15").count()
    assert late > 0
    assert out.count() == total.count() - late
    dropped = PL.dropped_by_watermark([p for p in Q.LATE_PROGRESS[SF_SMALL]])
    assert dropped == late


def test_keyed_pivot_then_gather_chain_is_append_legal(spark, tmp_path):
    src = _source(tmp_path, n=3)
    run = PL.PipelineRun(spark, src, str(tmp_path / "run"), register_tables=False)
    run.run(list(PL.ORDER[:4]) + [PL.FLATTENED_SILVER])
    chain = PL.keyed_gather(PL.keyed_pivot(run.read_stream(PL.FLATTENED_SILVER)))
    q = (chain.writeStream.format("memory").queryName("kgather").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck3")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    # whatever was emitted is complete per recording and time-ordered
    for r in spark.table("kgather").collect():
        assert r.sample_times == sorted(r.sample_times) and len(r.waveform) == len(r.sample_times)


def test_backfilled_pairs_are_kept_and_the_rest_is_listed(spark, tmp_path):
    """A second run brings a pair that is days old, and a file without partner."""
    src, now = str(tmp_path / "src"), int(time.time())
    write_pair(src, "new", RF.ascii_3a())
    run = PL.PipelineRun(spark, src, str(tmp_path / "run"), register_tables=False)
    run.run(PL.ORDER[:3])
    write_pair(src, "old", RF.ascii_3a())
    write_pair(src, "alone", RF.ascii_3a(), dat=False)
    for name in ("old.cfg", "old.dat", "alone.cfg"):
        _touch(os.path.join(src, name), now - 3 * 86400)
    run.run(PL.ORDER[:3])
    stems = [r[C.FILENAME].rsplit("/", 1)[-1] for r in run.read(PL.JOINED_FILES_BRONZE).collect()]
    assert sorted(stems) == ["new", "old"]
    assert [(r[C.FILENAME].rsplit("/", 1)[-1], r.missing) for r in run.unpaired().collect()] == [("alone", "dat")]


def test_pairs_ingested_far_apart_are_joined_once(spark, tmp_path):
    """Headers first, bodies a wait later, and the other way round; others come together."""
    src, now = str(tmp_path / "src"), int(time.time()) - 60
    write_pair(src, "a", RF.ascii_3a())
    write_pair(src, "b", RF.ascii_3a())
    write_pair(src, "both", RF.ascii_3a())
    write_pair(src, "far", RF.ascii_3a())
    for name in os.listdir(src):
        _touch(os.path.join(src, name), now)
    _touch(os.path.join(src, "far.dat"), now - 3600)
    later = {n: os.path.join(src, n) for n in ("a.dat", "b.cfg")}
    held = {n: (open(p, "rb").read(), os.remove(p))[0] for n, p in later.items()}
    run = PL.PipelineRun(spark, src, str(tmp_path / "run"), register_tables=False, wait="2 seconds")
    run.run(PL.ORDER[:4])
    assert {(r[C.FILENAME].rsplit("/", 1)[-1], r.missing) for r in run.unpaired().collect()} == {
        ("a", "dat"), ("b", "cfg"), ("far", "pair")}
    time.sleep(3)
    for n, p in later.items():
        with open(p, "wb") as f:
            f.write(held[n])
        _touch(p, now)
    for _ in range(2):
        run.run(PL.ORDER[:4])
        for table in (PL.JOINED_FILES_BRONZE, PL.RECORDINGS_SILVER):
            stems = [r[C.FILENAME].rsplit("/", 1)[-1] for r in run.read(table).select(C.FILENAME).collect()]
            assert sorted(stems) == ["a", "b", "both"]
    assert [r.missing for r in run.unpaired().collect()] == ["pair"]


def test_tables_of_others_are_left_alone(spark, tmp_path):
    spark.sql(f"CREATE TABLE foreign_recordings_silver (x INT) USING parquet LOCATION '{tmp_path}/foreign'")
    try:
        with pytest.raises(ValueError, match="not made by this pipeline"):
            PL.register_table(spark, PL.RECORDINGS_SILVER, str(tmp_path / "t"), "foreign_recordings_silver")
        assert spark.table("foreign_recordings_silver").columns == ["x"]
    finally:
        spark.sql("DROP TABLE foreign_recordings_silver")

"""Pairs through the index of arrivals: whenever the partner came, and at what cost."""

import os
import re
import uuid

import recording_fixtures as RF
from gridwave import constants as C
from gridwave.streaming import arrivals as AV
from gridwave.streaming import commits as CM
from gridwave.streaming import pipeline as PL

TABLES = [PL.CONFIG_FILES_BRONZE, PL.DAT_FILES_BRONZE, PL.JOINED_FILES_BRONZE]


def put(root, name, payload, at):
    """A file modified ``at`` seconds after a fixed time."""
    os.makedirs(root, exist_ok=True)
    path = os.path.join(root, name)
    with open(path, "wb") as f:
        f.write(payload if isinstance(payload, bytes) else payload.encode())
    os.utime(path, (1_700_000_000 + at,) * 2)


def names(run):
    return sorted(r[C.FILENAME].rsplit("/", 1)[1] for r in run.read(PL.JOINED_FILES_BRONZE).collect())


def partition_filters(df):
    """Which parts of its tables a plan reads."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    return [line for line in plan.splitlines() if line.startswith("PartitionFilters: [")]


def pipeline(spark, tmp_path):
    src = str(tmp_path / "in")
    os.makedirs(src)
    return src, PL.PipelineRun(spark, src, str(tmp_path / "run"), register_tables=False, part_format="yyyyMMddHHmmssSSS")


def test_three_runs_read_only_the_parts_they_pair(spark, tmp_path):
    """Headers of b come two runs before its body; the body of c before its header."""
    src, run = pipeline(spark, tmp_path)
    cfg, dat = RF.ascii_3a()
    for name, payload in (("a.cfg", cfg), ("a.dat", dat), ("b.cfg", cfg), ("c.dat", dat), ("far.cfg", cfg)):
        put(src, name, payload, 0)
    run.run(TABLES)
    assert names(run) == ["a"]
    # The edge of the tolerance pairs, a second more does not, however late they come.
    for name, payload, at in (("d.cfg", cfg, 0), ("d.dat", dat, 0), ("far.dat", dat, 301)):
        put(src, name, payload, at)
    run.run(TABLES)
    assert names(run) == ["a", "d"]
    put(src, "b.dat", dat, 300)
    put(src, "c.cfg", cfg, -300)
    run.run(TABLES)
    assert names(run) == ["a", "b", "c", "d"]
    assert sorted(tuple(r) for r in run.unpaired().collect()) == [
        (f"{k.rsplit('/', 1)[0]}/far", "pair") for k in [run.read(TABLES[0]).first()[C.FILENAME]]]
    run.run(TABLES)
    assert names(run) == ["a", "b", "c", "d"]
    # Each side's plan names the parts of the pairs of the last run, and reads no others.
    keys = spark.read.parquet(run.path("arrivals_pairs") + "/batch=2")
    both = AV.bodies(keys, run.read(PL.CONFIG_FILES_BRONZE), run.read(PL.DAT_FILES_BRONZE))
    filters = partition_filters(both)
    for table, name in ((PL.CONFIG_FILES_BRONZE, "cfg"), (PL.DAT_FILES_BRONZE, "dat")):
        parts = {r[0] for r in keys.select(f"{name}_part").distinct().collect()}
        every = {r[0] for r in run.read(table).select(AV.PART).distinct().collect()}
        assert len(parts) == 2 and len(every) == 3
        assert parts in [set(re.findall(r"\d{17}", f)) for f in filters]


def test_only_the_hours_of_new_files_are_read_from_the_index(spark, tmp_path):
    index = str(tmp_path / "index")
    rows = [(f"s{h}", "cfg", h * AV.HOUR_US, "p", h) for h in range(48)]
    made = spark.createDataFrame(rows, "stem string, side string, us bigint, ingest_part string, mod_hour bigint") \
        .selectExpr("stem", "side", "timestamp_micros(us) mod_time", "ingest_part", "mod_hour")
    CM.commit_batch(made, index, 0, ["mod_hour"])
    earlier = spark.read.schema(AV.INDEX_SCHEMA).parquet(index)
    found = AV.near(earlier, made.filter("mod_hour in (5, 30)"), "5 minutes")
    assert sorted(r.mod_hour for r in found.collect()) == [4, 5, 6, 29, 30, 31]
    assert [re.findall(r"\d+", f.split("IN", 1)[1]) for f in partition_filters(found)] == [["4", "5", "6", "29", "30", "31"]]
    assert AV.near(earlier, made.limit(0), "5 minutes").count() == 0


def test_files_of_one_stem_pair_with_each_other_and_nulls_with_nothing(spark):
    t = "timestamp'2024-01-01 00:59:00'"
    files = spark.sql(f"""SELECT * FROM VALUES ('a', {t}, '1'), ('a', {t} + INTERVAL 2 MINUTES, '2'), (null, {t}, '1'),
        ('b', null, '1'), ('a', {t} + INTERVAL 20 MINUTES, '3') AS f(filename, modificationTime, ingest_part)""")
    cfg, dat = AV.index_rows(files, "cfg"), AV.index_rows(files, "dat")
    assert cfg.count() == 3
    every = sorted((r.cfg_part, r.dat_part) for r in AV.new_pairs(cfg.union(dat), cfg.limit(0)).collect())
    assert every == [("1", "1"), ("1", "2"), ("2", "1"), ("2", "2"), ("3", "3")]
    late = sorted((r.cfg_part, r.dat_part) for r in AV.new_pairs(dat.filter("ingest_part = '2'"), cfg).collect())
    assert late == [("1", "2"), ("2", "2")]


def test_a_batch_run_again_leaves_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    CM.commit_batch(spark.range(3), path, 0)
    CM.commit_batch(spark.range(100, 105), path, 1)
    CM.commit_batch(spark.range(50), path, 1)       # the same batch after a failure
    os.makedirs(os.path.join(path, f"_run-2-{uuid.uuid4().hex}"))     # what a killed run leaves
    assert CM.batches(spark, path) == [0, 1]
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 100, 101, 102, 103, 104]

"""Batch scans list and read by tasks; what they give is what Spark's own reader gives."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import recording_fixtures as RF
from conftest import SF_SMALL
from gridwave import constants as C
from gridwave.functions.keys import pair_key
from gridwave.operators import decode as DE
from gridwave.operators import pairing as PR
from gridwave.plans import catalog as Q
from gridwave.sources import files as FS

from test_decode import write_pair

NAMES = {"a.cfg": b"x", "b/c.cfg": b"\xff\x00y", "b/empty.cfg": b"", "b/d e/f+g%20.cfg": b"1", "_metadata_x.cfg": b"m",
         "b/half.cfg._COPYING_": b"h", "b/_h.cfg": b"h", "z=1/y.dat": b"d"}


@pytest.fixture()
def root(tmp_path):
    for name, content in NAMES.items():
        path = tmp_path / "in" / name
        os.makedirs(path.parent, exist_ok=True)
        path.write_bytes(content)
    return str(tmp_path / "in")


def by_spark(spark, path, glob=None):
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def sorted_rows(df):
    return sorted(map(tuple, df.collect()))


def asks_file_index(df):
    """Whether a plan scans files through Spark's file index, which holds them all on the driver."""
    return "binaryfile" in df._jdf.queryExecution().executedPlan().toString().lower()


@pytest.mark.parametrize("glob", [None, "*", "*.cfg", "?.cfg", "{a,c}.cfg", "[ab].cfg"])
def test_the_inventory_is_listed_by_tasks(spark, root, glob):
    got = FS.file_inventory(spark, root, glob)
    want = by_spark(spark, root, glob).select("path", "length", "modificationTime")
    assert sorted_rows(got) == sorted_rows(want) and got.count() and got.schema == want.schema
    assert asks_file_index(got) == bool(set(glob or "") & set("[{"))


def test_roots_that_are_no_folder_are_sparks(spark, root):
    for path in (f"{root}/a.cfg", f"{root}/[ab]*"):
        got = FS.file_inventory(spark, path)
        assert sorted_rows(got) == sorted_rows(by_spark(spark, path).select(got.columns)) and got.count()
    for scan in (FS.file_inventory, FS.scan_cfg, FS.scan_dat):
        with pytest.raises(AnalysisException):
            scan(spark, f"{root}/missing")


@pytest.mark.parametrize("scan, glob, content", [(FS.scan_cfg, C.CFG_GLOB, C.CONFIG_CONTENT),
                                                 (FS.scan_dat, C.DAT_GLOB, C.DAT_CONTENT)])
def test_scans_read_by_tasks(spark, root, scan, glob, content):
    got = scan(spark, root)
    value = F.col("content").cast("string") if scan is FS.scan_cfg else F.col("content")
    want = by_spark(spark, root, glob).select(pair_key(F.col("path")), "modificationTime", value)
    assert not asks_file_index(got)
    assert sorted_rows(got) == sorted_rows(want) and got.count() and got.schema[content] == scan(spark, f"{root}/*").schema[content]


def test_pairs_are_never_broadcast(spark, tmp_path):
    """What a listing says of the size of files is no size of their content."""
    for k in range(3):
        write_pair(str(tmp_path), f"rec{k}", RF.ascii_3a())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        pairs = PR.pair_files(FS.scan_cfg(spark, str(tmp_path)), FS.scan_dat(spark, str(tmp_path)))
        decoded = DE.decode_recordings(pairs)
        assert decoded.count() == pairs.count() == 3
        for df in (pairs, decoded):
            df.collect()
            assert not asks_file_index(df)
            assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_file_queries_ask_no_file_index(spark):
    for name in ("file_inventory", "scan_cfg", "scan_dat", "pair_join", "decode_files", "decode_ascii_lines", "decode_binary_ranges"):
        assert not asks_file_index(Q.REGISTRY[name](spark, SF_SMALL)), name

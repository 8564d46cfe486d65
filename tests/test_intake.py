"""New files of a folder listed and read by tasks: each once, so many a micro-batch."""

import os

import pytest

import recording_fixtures as RF
from gridwave import constants as C
from gridwave.sources import files as FS
from gridwave.sources import listing as LS
from gridwave.sources import reading as RD
from gridwave.streaming import intake as IN
from gridwave.streaming import pipeline as PL

from test_decode import write_pair


def put(root, name, content=b"x", at=1_700_000_000):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content)
    os.utime(path, (at, at))


def test_content_is_that_of_the_file_source(spark, tmp_path):
    root = str(tmp_path / "in put")
    for k, content in enumerate((b"", b"\x00\xff" * 50, b"a", b"\n", "é".encode())):
        put(root, f"d{k % 2}.v1/r+{k} x.dat", content, 1_700_000_000.125 - k)
    want = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    got = RD.with_content(LS.file_inventory_wide(spark, root))
    assert got.columns == want.columns
    # Spark gives no row of an empty file.
    assert sorted(map(tuple, got.filter("length > 0").collect())) == sorted(map(tuple, want.collect())) and got.count() == 5


@pytest.mark.parametrize("max_files", [1, 2, 3, 7, 1000, None])
def test_parts_of_a_micro_batch_hold_no_more_than_its_bound(spark, tmp_path, max_files):
    size, parts = IN._part(max_files)
    assert size >= 1 and (parts is None) == (max_files is None)
    if max_files:
        assert max_files - size < size * parts <= max_files
    source, listing = str(tmp_path / "in"), str(tmp_path / "listing")
    for k in range(9):
        put(source, f"r{k}.cfg")
    IN.list_new(spark, source, "*.cfg", listing, max_files)
    files = [os.path.join(at, n) for at, _, names in os.walk(listing) for n in names if n.endswith(".parquet")]
    rows = [spark.read.parquet(f).count() for f in files]
    assert sum(rows) == 9 and max(rows) <= size


def test_a_listing_grows_by_new_files_only(spark, tmp_path):
    source, listing = str(tmp_path / "in"), str(tmp_path / "listing")

    def listed():
        rows = spark.read.schema(IN.LISTED).option("recursiveFileLookup", "true").parquet(listing).collect()
        return sorted(r.path.rsplit("/", 1)[1] for r in rows)

    os.makedirs(source)
    IN.list_new(spark, source, "*.cfg", listing)
    assert listed() == []
    for k in range(3):
        put(source, f"r{k}.cfg")
    put(source, "r0.dat")
    IN.list_new(spark, source, "*.cfg", listing, 2)
    assert listed() == ["r0.cfg", "r1.cfg", "r2.cfg"]
    before = sorted(os.listdir(listing))
    IN.list_new(spark, source, "*.cfg", listing, 2)
    assert sorted(os.listdir(listing)) == before
    put(source, "old.cfg", at=1_000_000_000)        # however old
    IN.list_new(spark, source, "*.cfg", listing)
    assert listed() == ["old.cfg", "r0.cfg", "r1.cfg", "r2.cfg"]


@pytest.mark.parametrize("by_tasks", [True, False])
def test_streams_read_each_file_once_whoever_lists(spark, tmp_path, monkeypatch, by_tasks):
    """The driver's file index is asked only where pyarrow does not know the store."""
    src = str(tmp_path / "src")
    for k in range(7):
        write_pair(src, f"rec{k}", RF.ascii_3a())
    put(src, "empty.cfg", b"")
    put(src, "empty.dat", b"")
    asked, plain = [], FS.stream_files
    monkeypatch.setattr(FS, "stream_files", lambda *a: asked.append(a) or plain(*a))
    if not by_tasks:
        monkeypatch.setattr(PL, "listed_by_tasks", lambda *a: False)
    run = PL.PipelineRun(spark, src, str(tmp_path / "run"), max_files_per_trigger=3, register_tables=False)
    run.run(PL.ORDER[:2])
    assert len(asked) == (0 if by_tasks else 2)
    for table, glob, payload in ((PL.CONFIG_FILES_BRONZE, C.CFG_GLOB, C.CONFIG_CONTENT),
                                 (PL.DAT_FILES_BRONZE, C.DAT_GLOB, C.DAT_CONTENT)):
        batch = FS.scan_cfg(spark, src) if glob == C.CFG_GLOB else FS.scan_dat(spark, src)
        cols = [C.FILENAME, "modificationTime", payload]
        assert sorted(map(tuple, run.read(table).select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))
        rows = [p["numInputRows"] for p in run.progress[table]]
        assert sum(rows) == 7 and max(rows) <= 3
    write_pair(src, "rec9", RF.ascii_3a())
    run.run(PL.ORDER[:2])
    assert run.read(PL.CONFIG_FILES_BRONZE).count() == run.read(PL.DAT_FILES_BRONZE).count() == 8


def test_an_unknown_store_is_left_to_spark(spark, monkeypatch):
    assert LS.listed_by_tasks(spark, "/tmp")
    monkeypatch.setattr(LS, "qualified", lambda s, root: "nostore://host/a")
    assert not LS.listed_by_tasks(spark, "/tmp")

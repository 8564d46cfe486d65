"""Listing by tasks, and streams that list only what comes after their mark."""

import os

import pytest
from pyspark.sql import functions as F

from gridwave.sources import files as FS
from gridwave.sources import listing as LS


def put(root, *names):
    for name in names:
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(name)


NAMES = ["a.cfg", "b/c.cfg", "b/c.dat", "b/d e/f+g.cfg", "b/d e/deep/er/x.cfg", "z=1/y.cfg", "b/.hidden.cfg",
         "_tmp/t.cfg", "_k=2/kept.cfg", ".dot/u.cfg", "b-1/h.cfg"]


@pytest.mark.parametrize("glob", ["*", "*.cfg"])
def test_tasks_list_what_sparks_file_index_lists(spark, tmp_path, glob):
    root = str(tmp_path / "in put")
    put(root, *NAMES)
    want = sorted(map(tuple, FS.file_inventory(spark, root, glob).collect()))
    got = LS.file_inventory_wide(spark, root, glob)
    assert sorted(map(tuple, got.collect())) == want and len(want) == len(NAMES) - 3 - (glob != "*")


def test_an_empty_or_missing_folder_has_no_files(spark, tmp_path):
    os.makedirs(tmp_path / "none" / "below")
    assert LS.file_inventory_wide(spark, str(tmp_path / "none")).count() == 0
    assert LS.file_inventory_wide(spark, str(tmp_path / "missing")).count() == 0


def local(root):
    return LS._opened(f"file://{root}")


def test_names_after_a_mark_in_order(tmp_path):
    root = str(tmp_path)
    put(root, *NAMES)
    fs, top = local(root)
    every = [n for n, _ in LS.names_after(fs, top, "")]
    assert every == sorted((n for n in NAMES if not n.startswith((".", "_t")) and "/." not in n), key=lambda n: n.split("/"))
    for k, mark in enumerate(every):
        assert [n for n, _ in LS.names_after(fs, top, mark)] == every[k + 1:]
    assert LS.last_name(fs, top) == every[-1] and LS.last_name(fs, top, "*.none") == ""
    assert [n for n, _ in LS.names_after(fs, top, "b/d")] == [n for n in every if n.split("/") > ["b", "d"]]


def test_only_folders_that_can_hold_new_names_are_listed(tmp_path, monkeypatch):
    root = str(tmp_path)
    put(root, *[f"2024-01-{d:02}/{h:02}/x{k}.cfg" for d in range(1, 31) for h in range(4) for k in range(3)])
    fs, top = local(root)
    listed, plain = [], LS._entries
    monkeypatch.setattr(LS, "_entries", lambda fs, folder: listed.append(folder) or plain(fs, folder))
    assert len(list(LS.names_after(fs, top, "2024-01-30/02/x1.cfg"))) == 4
    assert [f.removeprefix(top).strip("/") for f in listed] == ["", "2024-01-30", "2024-01-30/02", "2024-01-30/03"]
    listed.clear()
    assert LS.last_name(fs, top) == "2024-01-30/03/x2.cfg" and len(listed) == 3


def test_a_stream_reads_each_file_once_and_what_it_missed_is_listed(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        q = (LS.scan_marked(spark, root, "*.cfg").writeStream.format("parquet").trigger(availableNow=True)
             .option("checkpointLocation", str(tmp_path / "check")).start(out))
        q.awaitTermination()
        return sorted(r.content.decode() for r in spark.read.parquet(out).collect())

    first = [f"d1/{k:03}.cfg" for k in range(150)]
    put(root, *first, "d1/x.dat")
    assert run() == first
    assert run() == first
    put(root, "d2/a.cfg", "d1/000a.cfg")        # the second comes under a name before the mark
    assert run() == [*first, "d2/a.cfg"]
    seen = spark.read.parquet(out)
    inventory = LS.file_inventory_wide(spark, root, "*.cfg")
    assert [r.path.rsplit("/", 2)[1:] for r in LS.behind(inventory, seen).collect()] == [["d1", "000a.cfg"]]
    same = seen.join(inventory, ["path", "length", "modificationTime"])
    assert same.count() == seen.count() == seen.select(F.countDistinct("path")).first()[0]

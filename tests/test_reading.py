"""Listed files read by tasks: lines in ranges, raw text in folders."""

import os

from pyspark.sql import functions as F

from gridwave.schemas import RAW_TEXT
from gridwave.sources import files as FS
from gridwave.sources import listing as LS
from gridwave.sources import reading as RD


def test_ranges_give_every_line_once(tmp_path):
    path = str(tmp_path / "a b.dat")
    for text in (b"", b"\n", b"a", b"a\n", b"\n\nab\n", b"one\r\ntwo\r\n\r\nthree", b"x" * 40 + b"\ny\n" + b"z" * 25):
        with open(path, "wb") as f:
            f.write(text)
        for width in (1, 2, 3, 7, 100):
            for step in (1, 4, 64):
                got = b"".join(c for start in range(0, len(text), width) for c in RD.line_chunks(
                    RD.opener(), f"file:{path}", start, min(start + width, len(text)), len(text), step))
                assert got == text, (text, width, step)


def test_lines_are_those_of_the_text_source(spark, tmp_path):
    for name, text in (("a.dat", b"1,2\r\n3,4\r\n"), ("b+c d.dat", b"5\n\n6"), ("e.dat", b""), ("f.dat", b"7\r8\n")):
        (tmp_path / name).write_bytes(text)
    want = sorted(r.value for r in spark.read.text(str(tmp_path)).collect())
    files = LS.file_inventory_wide(spark, str(tmp_path))
    for width in (2, 1 << 20):
        assert sorted(r.line for r in RD.read_lines(files, width).collect()) == want


def test_raw_text_is_written_and_read_as_by_spark(spark, tmp_path):
    rows = spark.createDataFrame(
        [("error.d", "u1", 1.5, None, -2.0, None), ("error.d", "u1", 2e-9, 1.0, None, None), (None, "u2", None, None, None, None),
         ("a/b=c 100%.d", "", 3.0, 1e20, None, float("nan"))],
        "kind string, recording string, time double, IA double, IB double, IC double")
    mine, theirs = str(tmp_path / "mine"), str(tmp_path / "theirs")
    FS.write_text(rows, mine, ["kind", "recording"])
    rows.repartition("kind", "recording").write.partitionBy("kind", "recording").csv(theirs)
    assert sum(n.endswith(".csv") for _, _, names in os.walk(mine) for n in names) == 3

    def seen(df, root):
        folder = F.regexp_extract("path", rf"{root}/(.*)/[^/]+$", 1).alias("folder")
        return sorted(map(str, df.select("time", "IA", "IB", "IC", folder, "is_fault").collect()))

    plain = spark.read.schema(RAW_TEXT).option("recursiveFileLookup", "true").csv(theirs)
    path = FS.metadata_path()
    plain = plain.select("*", path.alias("path"), path.rlike("error").cast("int").alias("is_fault"))
    assert seen(FS.scan_raw_csv(spark, mine, "error"), mine) == seen(plain, theirs)
    assert seen(FS.scan_raw_csv(spark, theirs, "error"), theirs) == seen(plain, theirs)


"""Folder and name of a path, for every row of a long table."""

from pyspark.sql import functions as F

from gridwave import constants as C
from gridwave.plans import catalog as CT


def test_folder_and_name_are_cut_without_patterns(spark):
    paths = ["a", "/a", "x//a", "a/", "a/b", "file:/x y/é.v1/u1_0", "", "/", "//", None, "a/b\n", "x/a/\n", "a\n/b", "a/b/c/"]
    rows = spark.createDataFrame([(p,) for p in paths], f"{C.FILENAME} string")
    got = rows.select(*CT._folder_and_name())
    want = rows.select(F.regexp_extract(C.FILENAME, r"([^/]+)/[^/]+$", 1), F.regexp_extract(C.FILENAME, r"([^/]+)$", 1))
    assert list(map(tuple, got.collect())) == list(map(tuple, want.collect()))
    assert "regexp" not in got._jdf.queryExecution().optimizedPlan().toString().lower()

"""New files of a folder as a stream, through a listing that tasks make.

Spark's file source lists every file on the driver, goes through all their names
for each micro-batch, lists the files of the micro-batch again, and rewrites its
log of them every ten batches: with a file or two for each recording the cost of
a micro-batch grows with the folder.  Here a run lists the folder by tasks
(``sources.listing``) and adds what no earlier run has listed to a table, in part
files of some rows each.  A stream reads that table, so many part files a
micro-batch, and the listed files in tasks.  The driver sees part files.

The table grows by whole batches (``commits``): what a killed run had not listed,
or the stream had not read then, the next run lists and reads.  A file is known by
its path, however old it is.  Files of one listing are read in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridwave.sources.listing import file_inventory_wide
from gridwave.sources.reading import with_content
from gridwave.streaming.commits import batches, commit_batch

LISTED = "path string, modificationTime timestamp, length bigint"
PARTS = 4               # part files of a micro-batch, each read by a task
FILES_PER_PART = 250    # where a micro-batch is not bounded
FULL_PARTS = 8          # that a task writes for each one it leaves partly filled


def _part(max_files: int | None) -> tuple[int, int | None]:
    """(files in a part, parts in a micro-batch): together at most ``max_files``."""
    if not max_files:
        return FILES_PER_PART, None
    size = max(1, max_files // PARTS)
    return size, max_files // size


def list_new(spark: SparkSession, source: str, glob: str, listing: str, max_files: int | None = None) -> None:
    """Add the files of ``source`` that are not in the table ``listing`` yet."""
    done = batches(spark, listing)
    found = file_inventory_wide(spark, source, glob).select("path", "modificationTime", "length")
    if done:
        known = spark.read.schema(LISTED).option("recursiveFileLookup", "true").parquet(listing)
        found = found.join(known.select("path"), "path", "left_anti").select(found.columns)
    n = found.count()
    if done and not n:
        return
    size, _ = _part(max_files)
    tasks = max(1, min(n // (FULL_PARTS * size), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    commit_batch(found.repartition(tasks, "path"), listing, max(done, default=-1) + 1, max_rows=size)


def read_new(spark: SparkSession, listing: str, max_files: int | None = None) -> DataFrame:
    """The listed files with their content, as a stream of at most ``max_files`` a
    micro-batch.  Files without content have no row, as with Spark's own source."""
    rows = spark.readStream.schema(LISTED).option("recursiveFileLookup", "true")
    _, parts = _part(max_files)
    if parts:
        rows = rows.option("maxFilesPerTrigger", str(parts))
    return with_content(rows.parquet(listing).filter("length > 0"))

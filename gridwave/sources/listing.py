"""Folders listed by tasks, and files found by their names past a mark.

``file_inventory_wide`` lists a tree level by level: each task lists some
folders, and the folders found are the next level's rows.  The driver holds the
number of folders of a level and nothing else, where Spark's own file index
holds every file.

``MarkedFiles`` is a streaming source for folders whose names grow (by day or
hour, say).  Its offset is the name of the last file read, compared folder by
folder; a micro-batch descends only into folders that can hold later names.
Files that come late under an earlier name are not seen: ``behind`` lists them.

Both read through pyarrow's file systems.  Hidden names (those that begin with a
dot or an underscore) are left out, as Spark does.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterator
from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from gridwave import constants as C
from gridwave.functions.keys import pair_key
from gridwave.session import shared_dir, ship_package
from gridwave.sources.files import qualified, quoted

ENTRY = "path string, is_folder boolean, length bigint, modificationTime timestamp"
FILES_PER_TASK = 64
ENTRIES_PER_BATCH = 10_000


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _opened(root: str):
    """(file system, folder) of a qualified root."""
    import pyarrow.fs as pafs
    return pafs.FileSystem.from_uri(quoted(root))


def listed_by_tasks(spark: SparkSession, root: str) -> bool:
    """Whether pyarrow knows the store of ``root``; other stores are Spark's readers' alone."""
    try:
        _opened(qualified(spark, root))
    except (ValueError, NotImplementedError, OSError):
        return False
    return True


def lists_like_spark(spark: SparkSession, root: str, glob: str = "*") -> bool:
    """Whether a listing by tasks is what Spark's reader gives for ``root``: it is a
    folder of a store that pyarrow knows, and neither name is a pattern of other
    signs than ``*`` and ``?`` of the files' names."""
    import pyarrow.fs as pafs
    if set(root) & set("*?[]{}\\") or set(glob) & set("[]{}\\"):
        return False
    try:
        fs, top = _opened(qualified(spark, root))
        return fs.get_file_info(top).type == pafs.FileType.Directory
    except (ValueError, NotImplementedError, OSError):
        return False


def _entries(fs, folder: str) -> list:
    """What lies in a folder, in the order of names."""
    import pyarrow.fs as pafs
    found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return sorted((e for e in found if not _hidden(e.base_name)), key=lambda e: e.base_name)


def _modified(entry) -> datetime.datetime:
    """Modification time in whole milliseconds, as Spark's file sources give it."""
    ms = entry.mtime_ns // 1_000_000
    return datetime.datetime.fromtimestamp(ms // 1000, datetime.timezone.utc).replace(microsecond=ms % 1000 * 1000)


def file_inventory_wide(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Recursive listing by tasks: path, length, modificationTime, as ``file_inventory``."""
    import pyarrow as pa
    import pyarrow.fs as pafs
    ship_package(spark)
    base = qualified(spark, root)
    fs, top = _opened(base)
    # Spark spells local paths with one slash.
    prefix = "file:" if base.startswith("file://") else base[:len(base) - len(top)]

    def made(rows):
        return pa.record_batch([pa.array(c, t) for c, t in zip(
            zip(*rows), (pa.string(), pa.bool_(), pa.int64(), pa.timestamp("us", "UTC")))],
            names=["path", "is_folder", "length", "modificationTime"])

    def listed(batches):
        mine, _ = _opened(base)
        rows = []
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                for e in _entries(mine, folder):
                    is_folder = e.type == pafs.FileType.Directory
                    if is_folder or fnmatch(e.base_name, glob):
                        rows.append((e.path, is_folder, e.size or 0, _modified(e)))
                    # Many folders of a file each are few batches.
                    if len(rows) >= ENTRIES_PER_BATCH:
                        yield made(rows)
                        rows = []
        if rows:
            yield made(rows)

    out = f"{shared_dir(spark)}/inventory-{uuid.uuid4().hex}"
    folders, left, level = spark.createDataFrame([(top,)], "path string"), 1, 0
    while left:
        tasks = min(left, int(spark.conf.get("spark.sql.shuffle.partitions")))
        # Plain pages: a join is planned by the size of the files, which is then that of the rows.
        folders.repartition(tasks, "path").mapInArrow(listed, ENTRY).write.option("compression", "none") \
            .option("parquet.enable.dictionary", "false").parquet(f"{out}/level={level}")
        folders = spark.read.schema(ENTRY).parquet(f"{out}/level={level}").filter("is_folder").select("path")
        left, level = folders.count(), level + 1
    return spark.read.schema(ENTRY).parquet(out).filter("NOT is_folder").select(
        F.concat(F.lit(prefix), F.col("path")).alias("path"), "length", "modificationTime")


# --------------------------------------------------------------------------- names past a mark
def _key(name: str) -> tuple:
    return tuple(name.split("/")) if name else ()


def names_after(fs, top: str, mark: str, glob: str = "*") -> Iterator:
    """Files below ``top`` whose names come after ``mark``, in order."""
    import pyarrow.fs as pafs
    after = _key(mark)

    def walk(folder: str, at: tuple) -> Iterator:
        for e in _entries(fs, folder):
            key = (*at, e.base_name)
            if e.type == pafs.FileType.Directory:
                if key >= after[:len(key)]:         # else all below it comes before the mark
                    yield from walk(e.path, key)
            elif key > after and fnmatch(e.base_name, glob):
                yield "/".join(key), e

    return walk(top, ())


def last_name(fs, top: str, glob: str = "*") -> str:
    """Name of the last file, looked for from the end; empty where there is none."""
    import pyarrow.fs as pafs

    def walk(folder: str, at: tuple) -> str:
        for e in reversed(_entries(fs, folder)):
            if e.type == pafs.FileType.Directory:
                if found := walk(e.path, (*at, e.base_name)):
                    return found
            elif fnmatch(e.base_name, glob):
                return "/".join((*at, e.base_name))
        return ""

    return walk(top, ())


class Files(InputPartition):
    def __init__(self, files):
        self.files = files


class MarkedReader(DataSourceStreamReader):
    def __init__(self, root: str, glob: str):
        self.root, self.glob = root, glob

    def initialOffset(self) -> dict:
        return {"mark": ""}

    def latestOffset(self) -> dict:
        fs, top = _opened(self.root)
        return {"mark": last_name(fs, top, self.glob)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        fs, top = _opened(self.root)
        files = []
        for name, e in names_after(fs, top, start["mark"], self.glob):
            if _key(name) > _key(end["mark"]):
                break
            files.append((e.path, e.size, _modified(e)))
        return [Files(files[k:k + FILES_PER_TASK]) for k in range(0, len(files), FILES_PER_TASK)]

    def read(self, partition: Files) -> Iterator[tuple]:
        fs, top = _opened(self.root)
        prefix = "file:" if self.root.startswith("file://") else self.root[:len(self.root) - len(top)]
        for path, size, modified in partition.files:
            with fs.open_input_file(path) as f:
                yield prefix + path, modified, size, f.read()

    def commit(self, end: dict) -> None:
        pass


class MarkedFiles(DataSource):
    """Options: ``path`` (a qualified folder) and ``glob``."""

    @classmethod
    def name(cls) -> str:
        return "marked_files"

    def schema(self) -> str:
        return "path string, modificationTime timestamp, length bigint, content binary"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return MarkedReader(self.options["path"], self.options.get("glob", "*"))


def scan_marked(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """Stream of the files of ``root`` in the order of their names."""
    ship_package(spark)
    spark.dataSource.register(MarkedFiles)
    return spark.readStream.format("marked_files").option("glob", glob).load(qualified(spark, root))


def scan_cfg_marked(spark: SparkSession, root: str) -> DataFrame:
    """``*.cfg`` files by their names: (filename, modificationTime, config_content)."""
    return scan_marked(spark, root, C.CFG_GLOB).select(
        pair_key(F.col("path")).alias(C.FILENAME), "modificationTime",
        F.col("content").cast("string").alias(C.CONFIG_CONTENT))


def behind(inventory: DataFrame, seen: DataFrame) -> DataFrame:
    """Files of an inventory that a stream has not read (both with ``path``):
    after a run, those that came under a name before its mark."""
    return inventory.join(seen.select("path"), "path", "left_anti")

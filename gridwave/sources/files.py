"""File sources and sinks for recordings (batch and stream).

* cfg/dat pairs are read whole, a row per file, as the ``binaryFile`` source gives them;
* raw text recordings line by line with a fixed schema;
* batch scans list and read by tasks (``listing``, ``reading``): Spark's own file index
  would hold every file on the driver.  It is asked where pyarrow does not know the store,
  and for roots that are a file, a pattern or missing.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwave import constants as C
from gridwave.functions.keys import pair_key
from gridwave.schemas import BINARY_FILE, RAW_TEXT
from gridwave.session import shared_dir


def file_inventory(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Recursive listing: path, length, modificationTime (content is never read).

    Files without content are left out, as Spark's file sources do.
    """
    from gridwave.sources.listing import file_inventory_wide, lists_like_spark
    if lists_like_spark(spark, root, glob or "*"):
        scheme = _uri(spark, root).getScheme()
        path = F.regexp_replace("path", f"^{_PYARROW_SCHEME.get(scheme, scheme)}:", f"{scheme}:")
        return file_inventory_wide(spark, root, glob or "*").filter("length > 0").select(
            path.alias("path"), "length", "modificationTime")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "length", "modificationTime")


def _binary(spark: SparkSession, root: str, glob: str, stream: bool,
            max_files: int | None = None) -> DataFrame:
    from gridwave.sources.listing import lists_like_spark
    from gridwave.sources.reading import dealt_out, with_content
    if not stream and lists_like_spark(spark, root, glob):
        return with_content(dealt_out(file_inventory(spark, root, glob)))
    if stream:
        reader = spark.readStream.format("binaryFile").schema(BINARY_FILE)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", str(max_files))
    else:
        reader = spark.read.format("binaryFile")
    return (reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
            .load(root))


def stream_files(spark: SparkSession, root: str, glob: str, max_files: int | None = None) -> DataFrame:
    """New files as Spark's own file stream gives them, whatever the store."""
    return _binary(spark, root, glob, True, max_files)


def cfg_rows(files: DataFrame) -> DataFrame:
    """Header files (path, modificationTime, content) -> (filename, modificationTime, config_content string)."""
    return files.select(pair_key(F.col("path")).alias(C.FILENAME), "modificationTime",
                        F.col("content").cast("string").alias(C.CONFIG_CONTENT))


def dat_rows(files: DataFrame) -> DataFrame:
    """Body files (path, modificationTime, content) -> (filename, modificationTime, dat_content binary)."""
    return files.select(pair_key(F.col("path")).alias(C.FILENAME), "modificationTime",
                        F.col("content").alias(C.DAT_CONTENT))


def scan_cfg(spark: SparkSession, root: str, stream: bool = False,
             max_files: int | None = None) -> DataFrame:
    """``*.cfg`` files -> (filename, modificationTime, config_content string).

    In a batch that tasks read, headers are read once, into the shared folder: they
    are joined to bodies, mostly several times.  In plain pages, so that a join is
    planned by the size of the rows.
    """
    from gridwave.sources.listing import lists_like_spark
    rows = cfg_rows(_binary(spark, root, C.CFG_GLOB, stream, max_files))
    if stream or not lists_like_spark(spark, root, C.CFG_GLOB):
        return rows
    out = f"{shared_dir(spark)}/headers-{uuid.uuid4().hex}"
    rows.write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(out)
    return spark.read.schema(rows.schema).parquet(out)


def scan_dat(spark: SparkSession, root: str, stream: bool = False,
             max_files: int | None = None) -> DataFrame:
    """``*.dat`` files -> (filename, modificationTime, dat_content binary)."""
    return dat_rows(_binary(spark, root, C.DAT_GLOB, stream, max_files))


def metadata_path() -> Column:
    """``_metadata.file_path`` spelt like binaryFile's ``path``: not URL-encoded."""
    encoded = F.col("_metadata.file_path")
    # url_decode would read a plus sign, which paths do not encode, as a space.
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def scan_raw_csv(spark: SparkSession, root: str, pattern: str = C.FAULT_PATH_PATTERN) -> DataFrame:
    """Headerless ``time,IA,IB,IC`` text files, recursively, with path and label.

    Files are listed and read by tasks: there may be one for each recording.
    """
    lines = _listed_lines(spark, root, "*").filter(F.trim("line") != "")
    path = F.regexp_replace("path", "^file:/+", "file:///")
    return lines.select(F.from_csv("line", RAW_TEXT.simpleString()[len("struct<"):-1].replace(":", " "))
                        .alias("_row"), path.alias("path")).select(
        "_row.*", "path", F.col("path").rlike(pattern).cast("int").alias("is_fault"))


def _listed_lines(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(path, line) of the files below ``root``."""
    from gridwave.sources.listing import file_inventory_wide
    from gridwave.sources.reading import read_lines
    return read_lines(file_inventory_wide(spark, root, glob))


# --------------------------------------------------------------------------- writing
def quoted(uri: str) -> str:
    """A URI whose path is spelt plainly, with its spaces and the like escaped."""
    scheme, rest = uri.split("://", 1)
    return f"{scheme}://{quote(rest)}"


def _write_partition(rows: Iterable, root: str, days_old: int = 0) -> None:
    import pyarrow.fs as pafs
    fs, base = pafs.FileSystem.from_uri(quoted(root))
    made = set()
    for r in rows:
        for ext, payload in ((".cfg", r[C.CONFIG_CONTENT]), (".dat", r[C.DAT_CONTENT])):
            if payload is None:
                continue
            target = f"{base}/{r['_relpath']}{ext}"
            parent = target.rsplit("/", 1)[0]
            if parent not in made:
                fs.create_dir(parent, recursive=True)
                made.add(parent)
            # Whole-file overwrite: a retried task rewrites the same bytes.
            with fs.open_output_stream(target) as out:
                out.write(payload.encode() if ext == ".cfg" else bytes(payload))
            if days_old and fs.type_name == "local":
                at = os.stat(target)
                os.utime(target, ns=(at.st_atime_ns, at.st_mtime_ns - days_old * 86_400 * 10**9))


_PYARROW_SCHEME = {"s3a": "s3", "s3n": "s3"}


def _uri(spark: SparkSession, root: str):
    """``root`` as Spark's own file system spells it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toUri()


def qualified(spark: SparkSession, root: str) -> str:
    """``root`` with the scheme of the file system that Spark itself reads it from."""
    uri = _uri(spark, root)
    scheme = _PYARROW_SCHEME.get(uri.getScheme(), uri.getScheme())
    return f"{scheme}://{uri.getAuthority() or ''}{uri.getPath()}"


def write_pairs(pairs: DataFrame, root: str, folder: str = "", days_old: int = 0) -> None:
    """Write (filename, config_content, dat_content) rows as ``<root>/<folder>/<filename>.cfg|.dat``.

    A row without a header or body writes only the other.  Runs on the executors
    (one writer per partition); no file passes through the driver.  Retries are safe because every file is written whole.
    ``days_old`` dates the files so many days back, where the store is a plain file system.
    """
    prefix = f"{folder.strip('/')}/" if folder else ""
    staged = pairs.select(F.concat(F.lit(prefix), F.col(C.FILENAME)).alias("_relpath"),
                          C.CONFIG_CONTENT, C.DAT_CONTENT)
    target = qualified(pairs.sparkSession, root)
    staged.foreachPartition(lambda rows: _write_partition(rows, target, days_old))


def _write_text_partition(rows: Iterable, root: str) -> None:
    import pyarrow.fs as pafs
    fs, base = pafs.FileSystem.from_uri(quoted(root))
    at, out = None, None
    for r in rows:
        if r["_folder"] != at:
            if out is not None:
                out.close()
            at = r["_folder"]
            fs.create_dir(f"{base}/{at}", recursive=True)
            # Whole-file overwrite: a retried task rewrites the same rows.
            out = fs.open_output_stream(f"{base}/{at}/part-0.csv")
        out.write(r["_line"].encode() + b"\n")
    if out is not None:
        out.close()


# What Spark writes as %XX in the folder of a partition value.
_ESCAPED = r"([\x01-\x1f\x22#%'*/:=?\x5c\x7f{\[\]^])"


def write_text(rows: DataFrame, root: str, keys: list[str]) -> None:
    """Rows as headerless CSV, one file ``<key>=<value>/../part-0.csv`` for each value
    of ``keys``, in folders named as ``partitionBy`` names them.

    One task writes a folder, and writes its file as it goes: no row is held,
    and neither a commit of each file nor a listing of them passes the driver.
    """
    def part(key: str) -> Column:
        marked = F.regexp_replace(F.col(key).cast("string"), _ESCAPED, "\u0000$1\u0000")
        # The marked characters stand at the odd places.
        value = F.array_join(F.transform(F.split(marked, "\u0000"), lambda x, i: F.when(
            i % 2 == 1, F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(x)), 2, "0"))).otherwise(x)), "")
        return F.concat(F.lit(f"{key}="), F.coalesce(F.nullif(value, F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__")))

    target = qualified(rows.sparkSession, root)
    held = [c for c in rows.columns if c not in keys]
    rows.select(F.concat_ws("/", *map(part, keys)).alias("_folder"), F.to_csv(F.struct(*held)).alias("_line")) \
        .repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_folder") \
        .sortWithinPartitions("_folder") \
        .foreachPartition(lambda part_rows: _write_text_partition(part_rows, target))


def scan_dat_lines(spark: SparkSession, root: str) -> DataFrame:
    """ASCII ``*.dat`` bodies as lines: (filename, line).

    Large files are read in ranges by several tasks, so a single huge
    recording is read in parallel.  Point ``root`` at ASCII bodies only: a
    binary body has no line breaks and would arrive as one huge line.
    """
    return _listed_lines(spark, root, C.DAT_GLOB).select(pair_key(F.col("path")).alias(C.FILENAME), "line")


RANGE_BYTES = 64 << 20      # of a body that one task reads at a time


def read_ranges(rows: Iterable[dict]) -> Iterable[bytes]:
    """The bytes of each range (path, first_record, n_records, record_bytes)."""
    import pyarrow.fs as pafs
    opened: tuple = (None, None)
    for row in rows:
        if opened[0] != row["path"]:
            fs, inner = pafs.FileSystem.from_uri(quoted(row["path"]))
            opened = row["path"], fs.open_input_file(inner)
        yield opened[1].read_at(row["n_records"] * row["record_bytes"], row["first_record"] * row["record_bytes"])


def dat_ranges(spark: SparkSession, root: str, record_bytes: DataFrame,
               range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Bodies of fixed-length records in ranges of whole records, named and not read:
    (filename, path, record_bytes, first_record, n_records).

    ``record_bytes`` has (filename, record_bytes), known from the headers.  A
    body of any size is read by as many tasks as it has ranges; an incomplete
    record at the end is left out.  ``read_ranges`` reads them through
    pyarrow's file systems; ``scan_dat`` reads whole files of any store that
    Spark knows.
    """
    bodies = file_inventory(spark, root, C.DAT_GLOB).select(
        pair_key(F.col("path")).alias(C.FILENAME), "path", "length")
    records = F.floor(F.col("length") / F.col("record_bytes"))
    step = F.greatest(F.lit(1), F.floor(F.lit(range_bytes) / F.col("record_bytes")))
    n_ranges = F.ceil(F.col("_records") / F.col("_step"))
    numbers = F.when(F.col("_records") > 0, F.sequence(F.lit(0).cast("bigint"), n_ranges - 1))
    uri = F.regexp_replace(F.regexp_replace("path", "^file:/+", "file:///"), "^s3[an]:", "s3:")
    return bodies.join(record_bytes, C.FILENAME).select(
        C.FILENAME, uri.alias("path"), "record_bytes", records.alias("_records"), step.alias("_step")).select(
        "*", F.explode(numbers).alias("_k")).select(
        C.FILENAME, "path", "record_bytes", "_records", "_step", (F.col("_k") * F.col("_step")).alias("first_record"),
    ).select(
        C.FILENAME, "path", "record_bytes", "first_record",
        F.least(F.col("_step"), F.col("_records") - F.col("first_record")).alias("n_records"))

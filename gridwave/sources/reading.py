"""Listed files read by tasks: whole, or as lines in ranges of a large file.

Spark's own file index holds every file on the driver, and each of its listing
jobs sends them there.  Here the listing is a table (``sources.listing``), its
rows are dealt out to tasks, and each task opens the files of its rows through
pyarrow's file systems.  The driver sees counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwave.schemas import BINARY_FILE
from gridwave.session import shared_dir
from gridwave.sources.files import RANGE_BYTES, quoted

FILES_PER_TASK = 64         # ranges of files at the least, before another task is started
BATCH_BYTES = 8 << 20       # of content in one Arrow batch; a file is read whole by ``with_content``
BATCH_FILES = 256
LINE_BREAK = "\r\n|\n|\r"


def opener() -> Callable:
    """Opens files by the paths that Spark gives them, with one file system per store."""
    import pyarrow.fs as pafs
    known: dict = {}

    def opened(path: str):
        scheme, rest = path.split(":", 1)
        uri = f"file:///{rest.lstrip('/')}" if scheme == "file" else f"{scheme.replace('s3a', 's3').replace('s3n', 's3')}:{rest}"
        store = "/".join(uri.split("/", 3)[:3])
        if store not in known:
            fs, inner = pafs.FileSystem.from_uri(quoted(uri))
            known[store] = fs, len(uri) - len(inner)
        fs, cut = known[store]
        return fs.open_input_file(uri[cut:])

    return opened


def tasks_for(spark: SparkSession, n_files: int, n_bytes: int, task_bytes: int) -> int:
    """Tasks for so many files and bytes: many small files, or a few large ones, are spread."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(max(-(-n_files // FILES_PER_TASK), -(-n_bytes // task_bytes)), most))


def split_bytes(spark: SparkSession) -> int:
    """Of a file that one task reads: as Spark's own sources cut files, at the most ``RANGE_BYTES``."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes")
    return min(RANGE_BYTES, int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)))


def dealt_out(files: DataFrame) -> DataFrame:
    """Listed files spread over the tasks that read them; a folder's listing is one task's."""
    n, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    spark = files.sparkSession
    return files.repartition(tasks_for(spark, n, size, split_bytes(spark)), "path")


def with_content(files: DataFrame) -> DataFrame:
    """Rows (path, modificationTime, length), batch or stream, with the bytes of each file."""
    import pyarrow as pa

    def read(batches: Iterator) -> Iterator:
        open_file = opener()
        rows, held = [], 0

        def made():
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (
                pa.string(), pa.timestamp("us", "UTC"), pa.int64(), pa.binary()))], names=BINARY_FILE.names)

        for batch in batches:
            for path, modified, length in zip(*(batch.column(n).to_pylist() for n in BINARY_FILE.names[:3])):
                with open_file(path) as f:
                    content = f.read()
                if rows and (held + len(content) > BATCH_BYTES or len(rows) >= BATCH_FILES):
                    yield made()
                    rows, held = [], 0
                rows.append((path, modified, length, content))
                held += len(content)
        if rows:
            yield made()

    return files.select(*BINARY_FILE.names[:3]).mapInArrow(read, BINARY_FILE)


# --------------------------------------------------------------------------- lines
def line_chunks(open_file: Callable, path: str, start: int, end: int, length: int, step: int) -> Iterator[bytes]:
    """Whole lines of a file that begin in ``start`` .. ``end``, in chunks of about ``step`` bytes.

    A line belongs to the range that its first byte lies in.  Ranges meet at line
    feeds; a file without any is read whole by its first range.
    """
    with open_file(path) as f:
        at, rest = start, b""
        if start:
            # From the byte before: a line that begins at ``start`` is ours.
            at, found = start - 1, -1
            while found < 0 and at < length:
                data = f.read_at(min(step, length - at), at)
                found = data.find(b"\n")
                at += len(data) if found < 0 else found + 1
            if found < 0:
                return
        while at < end:
            # ``rest`` is the piece of a line before ``at``, and begins in the range.
            data = f.read_at(min(step, end - at), at)
            if not data:
                break
            at += len(data)
            cut = data.rfind(b"\n") + 1
            if cut:
                yield rest + data[:cut]
                rest = data[cut:]
            else:
                rest += data
        while rest and at < length:
            data = f.read_at(min(step, length - at), at)
            if not data:
                break
            cut = data.find(b"\n") + 1
            rest += data[:cut] if cut else data
            at += len(data)
            if cut:
                break
        if rest:
            yield rest


def read_lines(files: DataFrame, range_bytes: int | None = None) -> DataFrame:
    """Listed files as lines: (path, line).  Lines end at LF, CR LF or CR; a file of
    more than ``range_bytes`` is read by as many tasks as it has ranges.

    The lines are read once, into the shared folder: what asks for them several
    times opens no file again, and what decodes them has no Python in its plan.
    """
    import pyarrow as pa
    spark = files.sparkSession
    range_bytes = range_bytes or split_bytes(spark)
    ends = F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint"))
    ranges = files.filter("length > 0").select("path", "length", F.explode(ends).alias("start")).select(
        "path", "length", "start", F.least(F.col("start") + range_bytes, "length").alias("end"))

    def read(batches: Iterator) -> Iterator:
        open_file = opener()
        rows, held = [], 0

        def made():
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.binary()))],
                                   names=["path", "chunk"])

        for batch in batches:
            for row in batch.to_pylist():
                for chunk in line_chunks(open_file, row["path"], row["start"], row["end"], row["length"], BATCH_BYTES):
                    rows.append((row["path"], chunk))
                    held += len(chunk)
                    if held >= BATCH_BYTES or len(rows) >= BATCH_FILES:
                        yield made()
                        rows, held = [], 0
        if rows:
            yield made()

    n, size = ranges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0))).first()
    chunks = ranges.repartition(tasks_for(spark, n, size, range_bytes), "path", "start").mapInArrow(
        read, "path string, chunk binary")
    lines = chunks.select("path", F.explode(_lines(F.col("chunk").cast("string"))).alias("line"))
    out = f"{shared_dir(spark)}/lines-{uuid.uuid4().hex}"
    lines.write.parquet(out)
    return spark.read.schema(lines.schema).parquet(out)


def _lines(chunk: Column) -> Column:
    return F.split(F.regexp_replace(chunk, rf"(?:{LINE_BREAK})\z", ""), LINE_BREAK)

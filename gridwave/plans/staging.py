"""Recording files derived from the driver's tables, written once per input.

File-scan queries need files on disk.  They are produced by Spark jobs from
the given tables (captures of ``events`` encoded as cfg/dat pairs; raw text
recordings as CSV), written under the shared folder into a temporary name
and renamed when complete, so a half-written staging run is never read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gridwave import constants as C
from gridwave.operators import encode as EN
from gridwave.session import path_exists, publish, staging_path, table_stamp
from gridwave.sources import files as FS
from gridwave.sources import testdata as TD

ASCII_FOLDER = "ascii.v1"     # dotted folder names on purpose (pair key, R1)
BINARY_FOLDER = "binary.v1"


def staged(spark: SparkSession, kind: str, sf_dir: str, tables: tuple[str, ...], *more: str) -> str:
    """Folder of a staged input, named after the files it is made from: other
    files, lengths or times of the tables give another folder."""
    stamps = [table_stamp(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in tables]
    return staging_path(spark, kind, sf_dir, *stamps, *more)


def _captures(spark: SparkSession, sf_dir: str):
    return TD.captures(TD.table(spark, sf_dir, "events"), TD.table(spark, sf_dir, "customer"),
                       TD.table(spark, sf_dir, "nation"), TD.table(spark, sf_dir, "region"))


def recording_files(spark: SparkSession, sf_dir: str) -> str:
    """cfg/dat pairs of every capture: ASCII under ``ascii.v1/``, BINARY under ``binary.v1/``."""
    root = staged(spark, "recordings", sf_dir, ("events", "customer", "nation", "region"))
    if path_exists(spark, root):
        return root
    tmp = f"{root}.tmp-{uuid.uuid4().hex[:8]}"
    cap = _captures(spark, sf_dir)
    FS.write_pairs(EN.encode_ascii(cap), tmp, ASCII_FOLDER)
    FS.write_pairs(EN.encode_binary(cap), tmp, BINARY_FOLDER)
    return publish(spark, tmp, root)


def raw_text_files(spark: SparkSession, sf_dir: str) -> str:
    """Headerless ``time,IA,IB,IC`` CSV files, one folder per (event type, user).

    The event type is part of the folder name, so the path carries the label
    (``error`` marks faults) the way the reference's folders do.
    """
    root = staged(spark, "rawtext", sf_dir, ("events",))
    if path_exists(spark, root):
        return root
    tmp = f"{root}.tmp-{uuid.uuid4().hex[:8]}"
    ev = TD.table(spark, sf_dir, "events")
    ch = TD.channel_of_event(F.col("event_type"))
    rows = ev.select(
        F.concat(F.col("event_type"), F.lit(".d")).alias("kind"),
        TD.recording_of_user(F.col("user_id")).alias("recording"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("time"),
        *[F.when(ch == p, F.col("value")).alias(p) for p in C.PHASE_CHANNELS])
    FS.write_text(rows, tmp, ["kind", "recording"])
    return publish(spark, tmp, root)


LATE_DAY = "2024-01-15"   # the day whose file arrives after all later days


def events_by_day(spark: SparkSession, sf_dir: str, late_day: str = LATE_DAY) -> str:
    """``events`` as one Parquet folder per day, with file times set so that
    days arrive in date order except ``late_day``, which arrives last."""
    root = staged(spark, "eventdays", sf_dir, ("events",), late_day)
    if path_exists(spark, root):
        return root
    tmp = f"{root}.tmp-{uuid.uuid4().hex[:8]}"
    ev = TD.table(spark, sf_dir, "events")
    day = F.date_format(F.col("ts"), "yyyy-MM-dd")
    ev.withColumn("day", day).repartition("day").write.partitionBy("day").parquet(tmp)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(tmp)
    fs = base.getFileSystem(conf)
    listing = fs.listFiles(base, True)
    t0 = 1_700_000_000_000
    while listing.hasNext():
        st = listing.next()
        p = st.getPath()
        name = p.getName()
        if not name.endswith(".parquet"):
            continue
        d = p.getParent().getName().split("=", 1)[1]
        rank = 10_000 if d == late_day else int(d.replace("-", "")) % 10_000
        fs.setTimes(p, t0 + rank * 1000, -1)
    return publish(spark, tmp, root)


def deliveries(spark: SparkSession, sf_dir: str) -> list:
    """ASCII pairs in three deliveries to one folder: whole recordings with the
    headers of some and the bodies of others, then the bodies that lack, then the
    headers.  A file that is not delivered is null."""
    pairs = EN.encode_ascii(_captures(spark, sf_dir)).withColumn(
        "which", F.regexp_extract(C.FILENAME, r"^u(\d+)_", 1).cast("bigint") % 3)
    return [pairs.select(C.FILENAME, *[F.when(F.col("which").isin(*which), F.col(c)).alias(c) for c, which in (
        (C.CONFIG_CONTENT, headers), (C.DAT_CONTENT, contents))])
        for headers, contents in (((0, 1), (0, 2)), ((), (1,)), ((2,), ()))]


def backfill_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """ASCII pairs in two folders: recordings of even users dated today's run,
    those of odd users dated a day earlier (a backfill that arrives second)."""
    root = staged(spark, "backfill", sf_dir, ("events", "customer", "nation", "region"))
    folders = f"{root}/new", f"{root}/old"
    if path_exists(spark, root):
        return folders
    tmp = f"{root}.tmp-{uuid.uuid4().hex[:8]}"
    pairs = EN.encode_ascii(_captures(spark, sf_dir))
    odd = F.regexp_extract(C.FILENAME, r"^u(\d+)_", 1).cast("bigint") % 2 == 1
    FS.write_pairs(pairs.filter(~odd), tmp, "new")
    FS.write_pairs(pairs.filter(odd), tmp, "old", days_old=1)
    if not FS.qualified(spark, tmp).startswith("file:"):
        # Other stores are asked file by file; the tasks date plain files as they write them.
        jvm = spark.sparkContext._jvm
        base = jvm.org.apache.hadoop.fs.Path(f"{tmp}/old")
        fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        listing = fs.listFiles(base, True)
        while listing.hasNext():
            st = listing.next()
            fs.setTimes(st.getPath(), st.getModificationTime() - 86_400_000, -1)
    publish(spark, tmp, root)
    return folders

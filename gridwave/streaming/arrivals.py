"""Pairs of files whatever the time between their arrivals, through a small index.

The index has a row for each file: stem, side, modification time and the part of
the bronze table that holds its row.  It is laid out by the hour in which files
were modified.  Files pair if they were modified within a tolerance, so a new
file can only pair with files of its hour or the hours beside it: a run reads
those parts of the index, and then, for the pairs it has found, those parts of
the bronze tables.  How long ago the partner came does not matter, and no body
is ever kept in state or read in vain.

Several files with one stem all pair with each other within the tolerance.  A
file without a stem, or without a modification time, pairs with nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwave import constants as C
from gridwave.operators.pairing import interval_join, interval_us
from gridwave.streaming.commits import BATCH, commit_batch

PART = "ingest_part"
HOUR_US = 3_600_000_000
INDEX_SCHEMA = f"stem string, side string, mod_time timestamp, {PART} string, {BATCH} bigint, mod_hour bigint"


def index_rows(files: DataFrame, side: str) -> DataFrame:
    """Index rows of a bronze table (its bodies are not read)."""
    return files.select(F.col(C.FILENAME).alias("stem"), F.lit(side).alias("side"),
                        F.col("modificationTime").alias("mod_time"), PART,
                        F.floor(F.unix_micros("modificationTime") / F.lit(HOUR_US)).alias("mod_hour")) \
        .filter("stem IS NOT NULL AND mod_hour IS NOT NULL")


def _values(df: DataFrame, col: str) -> list:
    return [r[0] for r in df.select(col).distinct().collect()]


def near(index: DataFrame, new: DataFrame, tolerance: str) -> DataFrame:
    """The index rows of the hours that rows of ``new`` may pair with.

    The hours in which new files were modified come to the driver: they are few,
    however many the files.
    """
    reach = -(-interval_us(tolerance) // HOUR_US)
    hours = {h + d for h in _values(new, "mod_hour") for d in range(-reach, reach + 1)}
    return index.filter(F.col("mod_hour").isin(sorted(hours)))


def new_pairs(new: DataFrame, earlier: DataFrame, tolerance: str = C.PAIR_TOLERANCE) -> DataFrame:
    """Pairs with a file of ``new``: (stem, cfg_mod_time, dat_mod_time, cfg_part, dat_part)."""
    cols = ["stem", "side", "mod_time", PART]
    files = new.select(*cols, F.lit(True).alias("is_new")).union(earlier.select(*cols, F.lit(False).alias("is_new")))

    def side(name: str) -> DataFrame:
        return files.filter(F.col("side") == name).select(
            F.col("stem").alias(f"{name}_stem"), F.col("mod_time").alias(f"{name}_mod_time"),
            F.col(PART).alias(f"{name}_part"), F.col("is_new").alias(f"{name}_new"))

    found = interval_join(side("cfg"), side("dat"), "cfg_stem", "dat_stem", "cfg_mod_time", "dat_mod_time", tolerance)
    return found.filter("cfg_new OR dat_new").select(
        F.col("cfg_stem").alias("stem"), "cfg_mod_time", "dat_mod_time", "cfg_part", "dat_part").distinct()


def bodies(pairs: DataFrame, headers: DataFrame, contents: DataFrame) -> DataFrame:
    """The pairs with their header and body, from the parts of the bronze tables that hold them."""
    sides = []
    for name, table, payload in (("cfg", headers, C.CONFIG_CONTENT), ("dat", contents, C.DAT_CONTENT)):
        parts = sorted(_values(pairs, f"{name}_part"))
        sides.append(table.filter(F.col(PART).isin(parts)).select(
            F.col(C.FILENAME).alias("stem"), F.col("modificationTime").alias(f"{name}_mod_time"),
            F.col(PART).alias(f"{name}_part"), payload))
    cfg, dat = sides
    both = pairs.join(cfg, ["stem", "cfg_mod_time", "cfg_part"]).join(dat, ["stem", "dat_mod_time", "dat_part"])
    return both.select(F.col("stem").alias(C.FILENAME), C.CONFIG_CONTENT, C.DAT_CONTENT, "cfg_mod_time", "dat_mod_time")


def pair_batch(new: DataFrame, batch_id: int, index_path: str, pairs_path: str, headers: DataFrame,
               contents: DataFrame, tolerance: str, shape) -> None:
    """One micro-batch of index rows: add them to the index, write their pairs.

    Both writes are by batch id, and pairs are sought among the batches up to this
    one, so a repeated batch gives the same rows.
    """
    spark = new.sparkSession
    commit_batch(new, index_path, batch_id, ["mod_hour"])
    index = spark.read.schema(INDEX_SCHEMA).parquet(index_path)
    this = index.filter(F.col(BATCH) == batch_id)
    earlier = near(index.filter(F.col(BATCH) < batch_id), this, tolerance)
    keys_path = f"{index_path}_pairs"
    commit_batch(new_pairs(this, earlier, tolerance), keys_path, batch_id)
    keys = spark.read.parquet(f"{keys_path}/{BATCH}={batch_id}")
    commit_batch(shape(bodies(keys, headers, contents)), pairs_path, batch_id, ["file_type"])

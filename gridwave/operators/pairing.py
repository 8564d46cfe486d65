"""Bringing the two files of a recording together: by key, by time, by arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwave import constants as C
from gridwave.functions.times import within

INGEST_TIME = "ingest_time"
ARRIVAL_WAIT = "1 day"          # how long a file waits for its partner
ARRIVAL_LATENESS = "10 minutes"

_UNITS_US = {"second": 1_000_000, "seconds": 1_000_000, "minute": 60_000_000,
             "minutes": 60_000_000, "hour": 3_600_000_000, "hours": 3_600_000_000,
             "day": 86_400_000_000, "days": 86_400_000_000}


def interval_us(text: str) -> int:
    """'5 minutes' -> 300000000."""
    amount, unit = text.split()
    return int(float(amount) * _UNITS_US[unit.lower()])


def pair_files(headers: DataFrame, bodies: DataFrame, key: str = C.FILENAME) -> DataFrame:
    """Headers with the body of the same key; ``unpaired_files`` lists the rest.

    Both sides grow with the number of files, and no plan knows the size of files
    that tasks read: both are shuffled, none is sent to the driver for a broadcast.
    """
    return headers.hint("merge").join(bodies.select(key, C.DAT_CONTENT), key)


def unpaired_files(headers: DataFrame, bodies: DataFrame, key: str = C.FILENAME,
                   pairs: DataFrame | None = None) -> DataFrame:
    """(key, missing): keys of which only one file is there, and which it lacks.

    Given the ``pairs`` made so far, keys with both files but no pair are
    listed too: they lack a ``pair``.
    """
    seen = headers.select(key, F.lit("cfg").alias("side")).union(bodies.select(key, F.lit("dat").alias("side")))
    sides = seen.groupBy(key).agg(F.min("side").alias("first"), F.max("side").alias("last"))
    alone = F.col("first") == F.col("last")
    missing = F.when(~alone, F.lit("pair")).when(F.col("first") == "cfg", F.lit("dat")).otherwise(F.lit("cfg"))
    rest = sides.filter(alone) if pairs is None else sides.join(pairs.select(key), key, "left_anti")
    return rest.select(key, missing.alias("missing"))


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_time: str, right_time: str, tolerance: str = C.PAIR_TOLERANCE,
                  how: str = "inner") -> DataFrame:
    """Equal keys and |left_time - right_time| <= tolerance (inclusive).

    The time axis is cut into buckets one tolerance wide and the right side is
    copied to its own and both neighbouring buckets, so the join is an equi
    join on (key, bucket) plus the range check.  Only rows within one bucket
    of each other are ever compared: a key with millions of rows no longer
    compares all pairs, and each match is found exactly once (through the
    left row's bucket).  Works on batch and streaming inputs alike.

    Joins that return unmatched right rows are refused: the copies would each
    count as one.  Swap the sides instead.
    """
    if how not in ("inner", "left", "left_outer", "leftouter", "left_semi", "left_anti", "semi", "anti"):
        raise ValueError(f"interval_join keeps left rows only, not how={how!r}")
    width = interval_us(tolerance)
    lb, rb = "_left_bucket", "_right_bucket"
    lt = F.unix_micros(F.col(left_time).cast("timestamp"))
    rt = F.unix_micros(F.col(right_time).cast("timestamp"))
    left_b = left.withColumn(lb, F.floor(lt / F.lit(width)))
    right_b = right.withColumn(
        rb, F.explode(F.array(*[F.floor(rt / F.lit(width)) + F.lit(d) for d in (-1, 0, 1)])))
    cond = ((F.col(left_key) == F.col(right_key)) & (F.col(lb) == F.col(rb))
            & within(F.col(left_time), F.col(right_time), tolerance))
    return left_b.join(right_b, cond, how).drop(lb, rb)


def _side(files: DataFrame, name: str, payload: str, lateness: str) -> DataFrame:
    """One side of the stream join, its columns told apart by ``name``."""
    clock = f"{name}_arrived"
    return files.select(F.col(C.FILENAME).alias(f"{name}_stem"), F.col("modificationTime").alias(f"{name}_mod_time"),
                        F.col(INGEST_TIME).alias(clock), payload).withWatermark(clock, lateness)


def interval_join_stream(headers: DataFrame, bodies: DataFrame, tolerance: str = C.PAIR_TOLERANCE,
                         wait: str = ARRIVAL_WAIT, lateness: str = ARRIVAL_LATENESS) -> DataFrame:
    """Streaming pairs whose files were modified within ``tolerance``.

    Watermarks run on the time a file was ingested, which only moves forward:
    a backfill of old files, or a slow uploader's, is as welcome as new ones.
    Modification times are a plain predicate.  A file waits ``wait`` for its
    partner; the two-sided range on the ingest times lets Spark drop it from
    the state after that.  ``streaming.arrivals`` finds pairs any time apart.
    """
    left = _side(headers, "cfg", C.CONFIG_CONTENT, lateness)
    right = _side(bodies, "dat", C.DAT_CONTENT, lateness)

    pairs = left.join(right, (F.col("cfg_stem") == F.col("dat_stem"))
                      & within(F.col("cfg_mod_time"), F.col("dat_mod_time"), tolerance)
                      & within(F.col("cfg_arrived"), F.col("dat_arrived"), wait))
    return pairs.select(F.col("cfg_stem").alias(C.FILENAME), C.CONFIG_CONTENT, C.DAT_CONTENT,
                        "cfg_mod_time", "dat_mod_time")

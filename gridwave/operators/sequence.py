"""Positions of rows inside ordered groups, without one task per group.

A plain ``row_number().over(partitionBy(key).orderBy(t))`` sends a whole key to
one task; a recording holding a third of all samples would then be sorted by a
single core.  Here the key is cut into ordered buckets:

1. ``count`` per (key, bucket) -- a partial aggregate, so hot keys shrink
   map-side before the shuffle;
2. a running sum over that small bucket table gives each bucket's offset;
3. ``row_number`` runs inside (key, bucket) only, and the offset is added.

Buckets are ranges of the ordering column, so order is kept across buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Ordered buckets of the 128-bit md5 order used for global ranks: first 4 hex
# digits -> 65,536 buckets, uniformly filled because md5 is uniform.
HASH_PREFIX_HEX = 4

# Default time bucket for ordered_index: ~18 minutes of microseconds, about 10
# million samples of a 10 kHz recording per task.  Sparse inputs (a few rows
# per hour) should pass a wider bucket so the offset table stays small.
DEFAULT_BUCKET_US = 1 << 30


# Rows that one task sorts; a time bucket of more is cut into narrower ones.
ROWS_PER_TASK = 4_000_000
BYTES_PER_ROW = 16      # a key and a time at the least: for ruling dense buckets out


def _may_be_dense(df: DataFrame, rows_per_task: int) -> bool:
    """False where the whole input is estimated smaller than one task's rows."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes())) > rows_per_task * BYTES_PER_ROW


def _part_bounds(rows: DataFrame, keys: Sequence[str], bucket: str, order_us: str,
                 rows_per_task: int) -> DataFrame | None:
    """(keys, bucket, _seq_bounds): times that cut each dense bucket into parts of
    about equal counts; None where no bucket is dense."""
    counts = rows.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("_seq_n")) \
        .filter(F.col("_seq_n") > rows_per_task)
    most = counts.agg(F.max("_seq_n")).first()[0]
    if most is None:
        return None
    parts = -(-most // rows_per_task)
    cuts = [i / parts for i in range(1, parts)]
    return rows.join(counts.select(*keys, bucket), [*keys, bucket], "left_semi").groupBy(*keys, bucket) \
        .agg(F.percentile_approx(order_us, cuts, max(1000, 20 * parts)).alias("_seq_bounds"))


def ordered_index(df: DataFrame, keys: Sequence[str], order_us: str,
                  tiebreak: Sequence[str] = (), bucket_us: int = DEFAULT_BUCKET_US,
                  out: str = "rn", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add ``out`` = 1-based position of each row in its key, ordered by
    (``order_us``, *``tiebreak``).  ``order_us`` must be an integer column.

    Rows are ranked inside (key, bucket), a bucket being ``bucket_us`` wide
    (the default, about 18 minutes of microseconds, holds 10 million samples
    of a 10 kHz recording).  Buckets that are measured to hold more than
    ``rows_per_task`` rows are cut at their quantiles into as many parts as
    that takes, so a faster recorder is ranked by more tasks, not by a longer
    one.  Rows of one time stay together.
    """
    keys = list(keys)
    b, part = "_seq_bucket", "_seq_part"
    rows = df.withColumn(b, F.floor(F.col(order_us) / F.lit(bucket_us)))
    bounds = _part_bounds(rows, keys, b, order_us, rows_per_task) if _may_be_dense(df, rows_per_task) else None
    if bounds is None:
        rows = rows.withColumn(part, F.lit(0))
    else:
        time = F.col(order_us)
        below = F.size(F.filter("_seq_bounds", lambda x: x < time))
        rows = rows.join(bounds, [*keys, b], "left").withColumn(
            part, F.when(F.col("_seq_bounds").isNull(), F.lit(0)).otherwise(below)).drop("_seq_bounds")
    counts = rows.groupBy(*keys, b, part).agg(F.count(F.lit(1)).alias("_seq_n"))
    before = Window.partitionBy(*keys).orderBy(b, part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, b, part, F.coalesce(F.sum("_seq_n").over(before), F.lit(0))
                            .alias("_seq_offset"))
    within = Window.partitionBy(*keys, b, part).orderBy(order_us, *tiebreak)
    ranked = rows.withColumn("_seq_rn", F.row_number().over(within))
    return (ranked.join(offsets, [*keys, b, part], "inner")
            .withColumn(out, F.col("_seq_offset") + F.col("_seq_rn"))
            .drop(b, part, "_seq_offset", "_seq_rn"))


def hash_order(seed: int, key: Column) -> Column:
    """Seeded, stable pseudo-random order key (md5 hex of seed:key)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def global_rank_by_hash(df: DataFrame, order_hex: str, tiebreak: Sequence[str],
                        out: str = "rank", total: str = "n_total") -> DataFrame:
    """1-based rank of every row by an md5 hex column, plus the row total.

    The rank is exact and dense like a global ``row_number`` but never sends all
    rows to one task: rows are ranked inside md5-prefix buckets (uniform by
    construction) and bucket offsets come from a table of at most 65,536 rows,
    which is the only part broadcast.
    """
    b = "_rank_bucket"
    with_b = df.withColumn(b, F.conv(F.substring(F.col(order_hex), 1, HASH_PREFIX_HEX), 16, 10)
                           .cast("int"))
    counts = with_b.groupBy(b).agg(F.count(F.lit(1)).alias("_rank_n"))
    before = Window.orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # At most 16**HASH_PREFIX_HEX rows: a proven bound, so broadcasting is safe.
    offsets = counts.select(b, F.coalesce(F.sum("_rank_n").over(before), F.lit(0))
                            .alias("_rank_offset"),
                            F.sum("_rank_n").over(everything).alias(total))
    inside = Window.partitionBy(b).orderBy(order_hex, *tiebreak)
    ranked = with_b.withColumn("_rank_rn", F.row_number().over(inside))
    return (ranked.join(F.broadcast(offsets), b, "inner")
            .withColumn(out, F.col("_rank_offset") + F.col("_rank_rn"))
            .drop(b, "_rank_offset", "_rank_rn"))

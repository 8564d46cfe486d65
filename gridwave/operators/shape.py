"""Flatten, filter, pivot, gather: decoded recordings <-> long <-> phase tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwave import constants as C
from gridwave.functions.arrays import pick_channels
from gridwave.operators.sequence import DEFAULT_BUCKET_US, ordered_index

PHASES = list(C.PHASE_CHANNELS)


# ---------------------------------------------------------------------------
# decoded recording -> long samples
# ---------------------------------------------------------------------------
def flatten_long(decoded: DataFrame, time_col: str = C.MICROSECONDS,
                 keep: Sequence[str] = (C.FILENAME,)) -> DataFrame:
    """One row per (recording, time, analog channel): two explodes.

    Row i of ``analog`` pairs with time i; inside it, value j pairs with
    channel name j.  Recordings without analog channels produce no rows.
    ``sample_index`` / ``channel_index`` (0-based) keep the original positions
    so duplicates can be resolved deterministically later.
    """
    per_time = decoded.select(
        *keep, F.col(C.ANALOG_CHANNEL_NAMES),
        F.posexplode(F.arrays_zip(F.col(time_col).alias("t"), F.col(C.ANALOG).alias("row")))
        .alias("sample_index", "s"))
    return per_time.select(
        *keep, "sample_index", F.col("s.t").alias(time_col),
        F.posexplode(F.arrays_zip(F.col(C.ANALOG_CHANNEL_NAMES).alias("name"),
                                  F.col("s.row").alias("value")))
        .alias("channel_index", "c"),
    ).select(*keep, time_col, "sample_index", "channel_index",
             F.col("c.name").alias(C.ANALOG_CHANNEL_NAMES),
             F.col("c.value").alias(C.ANALOG))


def flatten_status(decoded: DataFrame, time_col: str = C.MICROSECONDS,
                   keep: Sequence[str] = (C.FILENAME,)) -> DataFrame:
    """Long form of analog *and* status channels, tagged by ``channel_type``.

    One pass: each sample's analog and status values are turned into one
    array of (channel_index, name, value, type) and exploded once, so the
    decoded input is read once.
    """
    names = F.coalesce(F.col(C.ANALOG_CHANNEL_NAMES), F.array().cast("array<string>"))
    snames = F.coalesce(F.col(C.STATUS_CHANNEL_NAMES), F.array().cast("array<string>"))
    n = F.greatest(F.size(F.coalesce(F.col(C.ANALOG), F.array())),
                   F.size(F.coalesce(F.col(C.STATUS), F.array())))
    per_time = decoded.select(
        *keep, names.alias("_names"), snames.alias("_snames"),
        F.posexplode(F.arrays_zip(F.slice(F.col(time_col), 1, n).alias("t"),
                                  F.col(C.ANALOG).alias("a"), F.col(C.STATUS).alias("s")))
        .alias("sample_index", "z"))

    def tagged(values, labels, kind):
        return F.transform(F.arrays_zip(labels.alias("name"), values.alias("value")),
                           lambda c, j: F.struct(j.alias("channel_index"), c["name"].alias("name"),
                                                 c["value"].alias("value"), F.lit(kind).alias("kind")))
    empty_d = F.array().cast("array<double>")
    analog = F.when(F.size(F.coalesce(F.col("z.a"), empty_d)) > 0,
                    tagged(F.col("z.a"), F.col("_names"), "analog"))
    status = F.when(F.size(F.coalesce(F.col("z.s"), empty_d)) > 0,
                    tagged(F.col("z.s"), F.col("_snames"), "status"))
    empty_s = F.array().cast(
        "array<struct<channel_index:int,name:string,value:double,kind:string>>")
    both = F.concat(F.coalesce(analog, empty_s), F.coalesce(status, empty_s))
    staged = per_time.select(*keep, "sample_index", F.col("z.t").alias(time_col),
                             both.alias("_channels"))
    return staged.select(*keep, "sample_index", time_col,
                         F.explode("_channels").alias("c")).select(
        *keep, time_col, "sample_index", F.col("c.channel_index").alias("channel_index"),
        F.col("c.name").alias(C.ANALOG_CHANNEL_NAMES), F.col("c.value").alias(C.ANALOG),
        F.col("c.kind").alias("channel_type"))


# ---------------------------------------------------------------------------
# long -> phase table
# ---------------------------------------------------------------------------
def filter_channels(long: DataFrame, channels: Sequence[str] = PHASES,
                    name_col: str = C.ANALOG_CHANNEL_NAMES) -> DataFrame:
    return long.filter(F.col(name_col).isin(list(channels)))


def pivot_phases(long: DataFrame, keys: Sequence[str], order: Sequence[str],
                 channels: Sequence[str] = PHASES,
                 name_col: str = C.ANALOG_CHANNEL_NAMES,
                 value_col: str = C.ANALOG) -> DataFrame:
    """One column per listed channel; duplicates resolve to the first by ``order``.

    Same result as ``groupBy(keys).pivot(name, channels).agg(min_by(...))``,
    but planned as one aggregate: with known values ``.pivot`` becomes two
    aggregates (by keys + name, then by keys), i.e. two shuffles of the long
    data.  The channel filter runs first, and ``min_by`` combines map-side,
    so a hot key shrinks before its single shuffle.
    """
    return pivot_conditional(long, keys, order, channels, name_col, value_col)


def pivot_discover(long: DataFrame, keys: Sequence[str], order: Sequence[str],
                   name_col: str = C.ANALOG_CHANNEL_NAMES,
                   value_col: str = C.ANALOG) -> DataFrame:
    """Pivot without a value list: Spark first runs a distinct job on names."""
    order_col = F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])
    return long.groupBy(*keys).pivot(name_col).agg(F.min_by(value_col, order_col))


def pivot_conditional(long: DataFrame, keys: Sequence[str], order: Sequence[str],
                      channels: Sequence[str] = PHASES,
                      name_col: str = C.ANALOG_CHANNEL_NAMES,
                      value_col: str = C.ANALOG) -> DataFrame:
    """Same result as :func:`pivot_phases` as plain conditional aggregates.

    One aggregate node, so it is legal in a streaming append query when the
    watermarked column is part of ``keys``.
    """
    order_col = F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])
    aggs = []
    for ch in channels:
        hit = F.col(name_col) == ch
        aggs.append(F.min_by(F.when(hit, F.col(value_col)), F.when(hit, order_col)).alias(ch))
    return filter_channels(long, channels, name_col).groupBy(*keys).agg(*aggs)


def phase_rows(decoded: DataFrame, time_col: str = C.MICROSECONDS,
               channels: Sequence[str] = PHASES,
               keep: Sequence[str] = (C.FILENAME,)) -> DataFrame:
    """Decoded recording -> phase table without a shuffle.

    Channels are picked inside each per-time vector (missing -> null,
    duplicate name -> first), then samples are exploded: a row-local pivot.
    """
    picked = decoded.select(
        *keep, F.posexplode(F.arrays_zip(
            F.col(time_col).alias("t"),
            pick_channels(F.col(C.ANALOG), F.col(C.ANALOG_CHANNEL_NAMES), channels).alias("v")))
        .alias("sample_index", "s"))
    return picked.select(*keep, "sample_index", F.col("s.t").alias(time_col),
                         *[F.col("s.v").getItem(i).alias(ch) for i, ch in enumerate(channels)])


def alias_channels(long: DataFrame, aliases: DataFrame,
                   name_col: str = C.ANALOG_CHANNEL_NAMES) -> DataFrame:
    """Standardise channel names through an alias table (``alias``, ``standard``).

    Unmatched names are kept.  The alias table is small reference data, but
    its size is not checked here, so the join is left to AQE (which
    broadcasts it only when its measured size is under the threshold).
    """
    a = aliases.select(F.col("alias").alias("_alias"), F.col("standard").alias("_standard"))
    return (long.join(a, F.col(name_col) == F.col("_alias"), "left")
            .withColumn(name_col, F.coalesce(F.col("_standard"), F.col(name_col)))
            .drop("_alias", "_standard"))


# ---------------------------------------------------------------------------
# phase table -> waveforms
# ---------------------------------------------------------------------------
def gather_waveform(phases: DataFrame, time_us: str = "time_us",
                    timestamp_col: str = C.TIMESTAMP, tiebreak: Sequence[str] = (),
                    frame_len: int = C.WAVEFORM_LENGTH,
                    channels: Sequence[str] = PHASES,
                    key: str = C.FILENAME, extra_first: Sequence[str] = (),
                    bucket_us: int = DEFAULT_BUCKET_US) -> DataFrame:
    """Ordered (time, phases) arrays per recording, in frames of ``frame_len``.

    A recording of exactly ``frame_len`` samples is one waveform; longer ones
    give several, the last possibly short (``n_samples < frame_len``).  No
    group ever exceeds ``frame_len`` rows, so no task holds a whole recording.
    ``extra_first`` columns are carried as their value at the first sample.
    """
    indexed = ordered_index(phases, [key], time_us, tiebreak, bucket_us=bucket_us, out="_rn")
    step = F.struct(F.col(time_us).alias("t"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(tiebreak)],
                    F.col(timestamp_col).alias(C.TIMESTAMP),
                    *[F.col(ch).alias(ch) for ch in channels])
    framed = indexed.withColumn("frame", F.floor((F.col("_rn") - 1) / F.lit(frame_len)))
    extra = [F.min_by(F.col(c), F.col("_rn")).alias(c) for c in extra_first]
    gathered = framed.groupBy(key, "frame").agg(
        F.array_sort(F.collect_list(step)).alias("_steps"),
        F.count(F.lit(1)).alias("n_samples"), *extra)
    timestep = F.transform("_steps", lambda s: F.struct(
        s[C.TIMESTAMP].alias(C.TIMESTAMP), *[s[ch].alias(ch) for ch in channels]))
    return gathered.select(key, "frame", "n_samples", *extra_first,
                           timestep.alias("timestep"),
                           (F.col("n_samples") == frame_len).alias("length_ok"))


def gather_recordings(rows: DataFrame, key: str, time_us: str, values: str, frame_len: int,
                      bucket_us: int = DEFAULT_BUCKET_US) -> DataFrame:
    """Rows (key, time, phase values) -> recordings ready for the writer.

    A key of more than ``frame_len`` rows gives several recordings, numbered;
    the station is the key, the device id is derived from the name.
    """
    from gridwave.functions.keys import device_id
    placed = ordered_index(rows, [key], time_us, [values], bucket_us=bucket_us, out="_n")
    cut = placed.withColumn("_part", F.floor((F.col("_n") - 1) / F.lit(frame_len)))
    step = F.struct(F.col("_n"), F.col(time_us).alias("t"), F.col(values).alias("v"))
    held = cut.groupBy(key, "_part").agg(F.array_sort(F.collect_list(step)).alias("_steps"))
    name = F.concat(F.col(key), F.lit("_"), F.col("_part").cast("string"))
    return held.select(
        name.alias(C.FILENAME), F.col("_steps.v").alias(C.ANALOG),
        F.array(*[F.lit(C.AMPS)] * len(PHASES)).alias(C.ANALOG_UNITS),
        F.array().cast("array<array<double>>").alias(C.STATUS),
        F.array(*map(F.lit, PHASES)).alias(C.ANALOG_CHANNEL_NAMES),
        F.array().cast("array<string>").alias(C.STATUS_CHANNEL_NAMES),
        F.lit(None).cast("double").alias(C.FREQUENCY), device_id(name).cast("string").alias(C.REC_DEV_ID),
        F.col(key).alias(C.STATION_NAME), F.col("_steps.t").alias(C.MICROSECONDS))


def waveform_matrix(gathered: DataFrame, channels: Sequence[str] = PHASES,
                    steps: str = "timestep") -> Column:
    """array<struct(timestamp, phases)> -> array<array<double>> (T x phases)."""
    return F.transform(F.col(steps), lambda row: F.array(*[row[ch] for ch in channels]))


# ---------------------------------------------------------------------------
# small recording-level helpers
# ---------------------------------------------------------------------------
def metadata_first(df: DataFrame, cols: Sequence[str] = C.METADATA_COLUMNS,
                   order: Sequence[str] = (), key: str = C.FILENAME) -> DataFrame:
    """First value of each metadata column per recording (pinned by ``order``)."""
    if not order:
        return df.groupBy(key).agg(*[F.first(c).alias(c) for c in cols])
    order_col = F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])
    return df.groupBy(key).agg(*[F.min_by(F.col(c), order_col).alias(c) for c in cols])


def enrich_metadata(samples: DataFrame, metadata: DataFrame, key: str = C.FILENAME) -> DataFrame:
    """Rejoin recording metadata onto samples (left join on the recording key).

    Metadata grows with the number of recordings, so no broadcast hint: AQE
    picks a broadcast at run time only if the measured side is small.
    """
    return samples.join(metadata, key, "left")


def distinct_recordings(df: DataFrame, key: str = C.FILENAME) -> DataFrame:
    return df.select(key).distinct()


def one_recording(phases: DataFrame, order: Sequence[str], key: str = C.FILENAME,
                  name: str | None = None) -> DataFrame:
    """All samples of one recording sorted by time (the smallest key if unnamed)."""
    if name is not None:
        chosen = phases.filter(F.col(key) == name)
    else:
        first = phases.select(key).distinct().orderBy(key).limit(1)
        chosen = phases.join(first, key, "left_semi")
    return chosen.orderBy(*order)

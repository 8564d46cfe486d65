"""Readers for the driver's parquet tables and the mapping onto recordings.

``events`` stands in for long samples (one row = one value of one channel at
one time).  The mapping is data-driven: it only renames and re-labels columns,
so every query built on it grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwave import constants as C

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def channel_of_event(event_type: Column) -> Column:
    """click/view/error -> IA/IB/IC; other event types keep their own name."""
    expr = F.when(F.lit(False), F.lit(None))
    for event, channel in C.EVENT_CHANNELS:
        expr = expr.when(event_type == event, F.lit(channel))
    return expr.otherwise(event_type)


def recording_of_user(user_id: Column) -> Column:
    return F.concat(F.lit("u"), user_id.cast("string"))


def long_samples(events: DataFrame) -> DataFrame:
    """(filename, timestamp, time_us, analog_channel_names, analog, event_id)."""
    return events.select(
        recording_of_user(F.col("user_id")).alias(C.FILENAME),
        F.col("ts").alias(C.TIMESTAMP),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("time_us"),
        channel_of_event(F.col("event_type")).alias(C.ANALOG_CHANNEL_NAMES),
        F.col("value").alias(C.ANALOG),
        F.col("event_id"),
    )


def event_paths(events: DataFrame) -> DataFrame:
    """A source path per event, laid out like a recorder's folder tree.

    ``/recordings/<event_type>.d/u<user>/<event_id>.cfg`` -- the directory carries a
    dot on purpose (the reference's first-dot key collapses such paths).
    """
    return events.select(
        "event_id", "user_id", "event_type",
        F.concat(F.lit("file:///recordings/"), F.col("event_type"), F.lit(".d/u"),
                 F.col("user_id").cast("string"), F.lit("/"),
                 F.col("event_id").cast("string"), F.lit(".cfg")).alias("path"),
    )


def source_path(user_id: Column, event_type: Column, event_id: Column) -> Column:
    return F.concat(F.lit("file:///recordings/"), event_type, F.lit(".d/u"),
                    user_id.cast("string"), F.lit("/"), event_id.cast("string"), F.lit(".cfg"))


def raw_samples(events: DataFrame) -> DataFrame:
    """The raw text-recording rows (time, IA, IB, IC) with a path-derived label.

    One row per event; the event's value sits in its phase column and the
    other phases are null.  ``is_fault`` marks samples whose source path
    matches ``error`` (the stand-in for the reference's ``external``).
    """
    ch = channel_of_event(F.col("event_type"))
    path = source_path(F.col("user_id"), F.col("event_type"), F.col("event_id"))
    return events.select(
        recording_of_user(F.col("user_id")).alias(C.FILENAME),
        F.col("ts").alias(C.TIMESTAMP),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("time_us"),
        F.col("event_id"),
        *[F.when(ch == p, F.col("value")).alias(p) for p in C.PHASE_CHANNELS],
        path.rlike("error").cast("int").alias("is_fault"),
    )


def customer_geography(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """(c_custkey, n_name, r_name): one row per customer."""
    return (customer.select("c_custkey", "c_nationkey")
            .join(nation.select("n_nationkey", "n_name", "n_regionkey"),
                  F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region.select("r_regionkey", "r_name"),
                  F.col("n_regionkey") == F.col("r_regionkey"))
            .select("c_custkey", "n_name", "r_name"))


def line_frequency(region_name: Column) -> Column:
    return F.when(region_name == "AMERICA", F.lit(60.0)).otherwise(F.lit(50.0))


def metadata_samples(events: DataFrame, customer: DataFrame, nation: DataFrame,
                     region: DataFrame) -> DataFrame:
    """Per-sample metadata: station = customer's nation, line frequency by
    region (60 Hz in AMERICA, else 50 Hz), device id from the event's props."""
    geo = customer_geography(customer, nation, region)
    return (events.select("user_id", "ts", "event_id", "props", "event_type", "value")
            .join(geo, F.col("user_id") == F.col("c_custkey"), "left")
            .select(
                recording_of_user(F.col("user_id")).alias(C.FILENAME),
                F.col("ts").alias(C.TIMESTAMP), "event_id",
                channel_of_event(F.col("event_type")).alias(C.ANALOG_CHANNEL_NAMES),
                F.col("value").alias(C.ANALOG),
                line_frequency(F.col("r_name")).alias(C.FREQUENCY),
                F.col("n_name").alias(C.STATION_NAME),
                F.get_json_object("props", "$.k").alias(C.REC_DEV_ID)))


CAPTURE_LENGTH = C.WAVEFORM_LENGTH
# events are sparse (tens per user per month): one ordering bucket per day
EVENT_BUCKET_US = 86_400_000_000


def captures(events: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame,
             capture_len: int = CAPTURE_LENGTH) -> DataFrame:
    """Decoded recordings built from events: one capture per user and run of
    ``capture_len`` consecutive events (a recorder writing fixed-size files).

    analog = [IA, IB, IC] per sample (the event's value in its own phase,
    null elsewhere); status = [purchase, signup] bits; metadata from the
    customer's nation/region; device id derived from the capture name.
    Every group is bounded by ``capture_len`` rows.
    """
    from gridwave.functions.keys import device_id
    from gridwave.operators.sequence import ordered_index

    geo = customer_geography(customer, nation, region)
    ch = channel_of_event(F.col("event_type"))
    rows = events.select(
        "user_id", "event_id", "event_type",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("time_us"),
        F.array(*[F.when(ch == p, F.col("value")) for p in C.PHASE_CHANNELS]).alias("a"),
        F.array(*[(F.col("event_type") == s).cast("double") for s in C.STATUS_EVENTS]).alias("s"),
    ).join(geo, F.col("user_id") == F.col("c_custkey"), "left").select(
        "user_id", "event_id", "time_us", "a", "s",
        line_frequency(F.col("r_name")).alias(C.FREQUENCY), F.col("n_name").alias(C.STATION_NAME))
    idx = ordered_index(rows, ["user_id"], "time_us", ["event_id"], bucket_us=EVENT_BUCKET_US,
                        out="pos")
    name = F.concat(recording_of_user(F.col("user_id")), F.lit("_"),
                    F.floor((F.col("pos") - 1) / F.lit(capture_len)).cast("string"))
    grouped = idx.withColumn(C.FILENAME, name).groupBy(C.FILENAME).agg(
        F.array_sort(F.collect_list(F.struct("pos", "time_us", "a", "s"))).alias("_steps"),
        F.min_by(C.FREQUENCY, "pos").alias(C.FREQUENCY),
        F.min_by(C.STATION_NAME, "pos").alias(C.STATION_NAME))
    return grouped.select(
        C.FILENAME,
        F.transform("_steps", lambda x: x["a"]).alias(C.ANALOG),
        F.array(*[F.lit(C.AMPS)] * len(C.PHASE_CHANNELS)).alias(C.ANALOG_UNITS),
        F.transform("_steps", lambda x: x["s"]).alias(C.STATUS),
        F.array(*[F.lit(p) for p in C.PHASE_CHANNELS]).alias(C.ANALOG_CHANNEL_NAMES),
        F.array(*[F.lit(s) for s in C.STATUS_EVENTS]).alias(C.STATUS_CHANNEL_NAMES),
        C.FREQUENCY,
        device_id(F.col(C.FILENAME)).cast("string").alias(C.REC_DEV_ID),
        C.STATION_NAME,
        F.transform("_steps", lambda x: x["time_us"]).alias(C.MICROSECONDS),
    )

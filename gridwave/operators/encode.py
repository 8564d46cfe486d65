"""Encode recordings as cfg/dat content (the distributed form of the writer).

Input: decoded-recording rows (``filename``, ``microseconds``, ``analog``,
``analog_channel_names``, ``analog_units``, ``status``, ``status_channel_names``,
``frequency``, ``station_name``, ``rec_dev_id``).  Output adds
``config_content`` (string) and ``dat_content`` (binary).

Nothing is lost silently:

* ASCII bodies hold the values themselves as decimal text (a = 1, b = 0), so
  decoding gives back the same doubles;
* integer bodies (BINARY: 16 bits, BINARY32: 32 bits) scale every channel of
  every recording by its own least and greatest value, so no value can leave
  the integer range and the error is at most a / 2 of the channel; a channel
  of one value is exact;
* FLOAT32 bodies hold 32-bit floats;
* times count microseconds from the earliest sample; the tick widens only
  where 32 bits cannot hold the recording's span.

A missing (null or NaN) value is an empty field, or the format's marker for
missing samples.  An infinite value in an integer body raises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from gridwave import constants as C
from gridwave.functions.times import cfg_timestamp_text, trigger_time

# Body type -> (greatest count written, marker of a missing sample, numpy type).
SAMPLE_TYPES = {
    "BINARY": (C.INT16_LARGEST, C.INT16_MISSING, "<i2"),
    "BINARY32": (C.INT32_LARGEST, C.INT32_MISSING, "<i4"),
    "FLOAT32": (None, None, "<f4"),
}


def _phase_of() -> Column:
    return F.create_map(*[x for ch, ph in zip(C.PHASE_CHANNELS, C.PHASE_LETTERS)
                          for x in (F.lit(ch), F.lit(ph))])


def _number_text(x: Column) -> Column:
    """Decimal text of a double that reads back as the same double; 1.0 as 1,
    and small numbers without an exponent, which some readers do not know."""
    whole = (x == F.floor(x)) & (F.abs(x) < 1e15)
    text = x.cast("string")
    digits = F.regexp_replace(F.regexp_replace(text, r"^-|E.*$|\.", ""), "0+$", "")
    zeros = F.regexp_extract(text, r"E-(\d+)$", 1).try_cast("int") - 1
    small = F.concat(F.when(x < 0, F.lit("-0.")).otherwise(F.lit("0.")), F.repeat(F.lit("0"), zeros), digits)
    return F.when(whole, x.cast("bigint").cast("string")).when(F.contains(text, F.lit("E-")), small).otherwise(text)


def _analog_line(name: Column, unit: Column, j: Column, scale: Column) -> Column:
    phase = F.coalesce(F.try_element_at(_phase_of(), name), F.lit(""))
    ccbm = F.when(name.isin(*C.PHASE_CHANNELS), F.lit(C.CURRENT_COMPONENT)).otherwise(F.lit(""))
    return F.concat_ws(",", (j + 1).cast("string"), name, phase, ccbm,
                       F.coalesce(unit, F.lit("")), _number_text(scale["a"]), _number_text(scale["b"]),
                       F.lit(str(C.WRITER_SKEW)), F.lit(str(C.WRITER_MIN)),
                       F.lit(str(C.WRITER_MAX)), F.lit(str(C.WRITER_PRIMARY)),
                       F.lit(str(C.WRITER_SECONDARY)), F.lit("P"))


def _start() -> Column:
    return F.array_min(C.MICROSECONDS)


def config_text(file_type: str, scales: Column, time_mult: Column) -> Column:
    names = F.col(C.ANALOG_CHANNEL_NAMES)
    units = F.coalesce(F.col(C.ANALOG_UNITS), F.array().cast("array<string>"))
    snames = F.coalesce(F.col(C.STATUS_CHANNEL_NAMES), F.array().cast("array<string>"))
    n_a, n_d = F.size(names), F.size(snames)
    start = F.timestamp_micros(_start())
    analog_lines = F.transform(names, lambda nm, j: _analog_line(nm, F.get(units, j), j, F.get(scales, j)))
    status_lines = F.transform(snames, lambda nm, k: F.concat_ws(
        ",", (k + 1).cast("string"), nm, F.lit(""), F.lit(""), F.lit("0")))
    lines = F.concat(
        F.array(F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in (C.STATION_NAME, C.REC_DEV_ID)], F.lit("1999")),
                F.concat_ws(",", (n_a + n_d).cast("string"), F.concat(n_a.cast("string"), F.lit("A")),
                            F.concat(n_d.cast("string"), F.lit("D")))),
        analog_lines, status_lines,
        F.array(F.coalesce(F.col(C.FREQUENCY).cast("string"), F.lit("")), F.lit("0"),
                F.concat(F.lit("0,"), F.size(F.col(C.MICROSECONDS)).cast("string")),
                cfg_timestamp_text(start), cfg_timestamp_text(trigger_time(start)),
                F.lit(file_type), time_mult.cast("string")))
    return F.concat(F.array_join(lines, "\n"), F.lit("\n"))


def _unit_scales() -> Column:
    """a = 1, b = 0 for every channel: values stand in the body as they are."""
    return F.transform(C.ANALOG_CHANNEL_NAMES,
                       lambda nm: F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b")))


def channel_scales(largest: int) -> Column:
    """Per channel a and b that map its values onto -largest .. largest."""
    def scale(nm: Column, j: Column) -> Column:
        values = F.transform(C.ANALOG, lambda r: F.nullif(F.get(r, j), F.lit(float("nan"))))
        low, high = F.array_min(values), F.array_max(values)
        bad = (F.abs(low) == float("inf")) | (F.abs(high) == float("inf"))
        # Halves first: the difference of two large doubles may not be finite.
        a = (high / 2 - low / 2) / F.lit(float(largest))
        return F.struct(
            F.when(bad, F.raise_error(F.lit("an infinite value does not fit an integer body")).cast("double"))
            .when(low < high, a).otherwise(F.lit(1.0)).alias("a"),
            F.coalesce(F.when(low < high, low / 2 + high / 2).otherwise(low), F.lit(0.0)).alias("b"))
    return F.transform(C.ANALOG_CHANNEL_NAMES, scale)


def time_tick(largest: int = C.UINT32_LARGEST) -> Column:
    """Microseconds that one count of the time field stands for; 1 if that fits."""
    span = F.array_max(C.MICROSECONDS) - _start()
    return F.greatest(F.lit(1), F.ceil(span / F.lit(float(largest)))).cast("bigint")


def ascii_body(rows: Column, micros: Column, status: Column, start: Column) -> Column:
    """``n,t,x1..xA,s1..sD`` per sample, newline-terminated; empty field = missing.

    Each line is one array of fields joined once, so any channel count
    (including none) gives exactly 2 + A + D fields.
    """
    def line(z, i):
        head = F.array((i + 1).cast("string"), (z["t"] - start).cast("string"))
        xs = F.transform(F.coalesce(z["x"], F.array().cast("array<double>")),
                         lambda x: F.when(x.isNull() | F.isnan(x), F.lit("")).otherwise(_number_text(x)))
        ss = F.transform(F.coalesce(z["s"], F.array().cast("array<double>")),
                         lambda v: v.cast("int").cast("string"))
        return F.array_join(F.concat(head, xs, ss), ",")
    lines = F.transform(F.arrays_zip(micros.alias("t"), rows.alias("x"), status.alias("s")), line)
    return F.concat(F.array_join(lines, "\n"), F.lit("\n")).cast("binary")


def _status() -> Column:
    return F.coalesce(F.col(C.STATUS), F.array().cast("array<array<double>>"))


def encode_ascii(recordings: DataFrame) -> DataFrame:
    prepared = recordings.select(
        C.FILENAME, config_text("ASCII", _unit_scales(), F.lit(1)).alias(C.CONFIG_CONTENT),
        F.col(C.ANALOG).alias("_x"), F.col(C.MICROSECONDS).alias("_t"), _status().alias("_s"),
        _start().alias("_start"))
    return prepared.select(
        C.FILENAME, C.CONFIG_CONTENT,
        ascii_body(F.col("_x"), F.col("_t"), F.col("_s"), F.col("_start")).alias(C.DAT_CONTENT))


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and where each row's begin (one more at the end)."""
    column = batch.column(name)
    return (column.flatten().to_numpy(zero_copy_only=False),
            np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]))


def _pack(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Fixed-length records from flat columns of finished counts."""
    for batch in batches:
        (x, at_x), (t, at_t), (s, at_s) = (_flat(batch, n) for n in ("_x", "_t", "_s"))
        out = []
        for i, (n_a, n_d) in enumerate(zip(batch.column("_na").to_pylist(), batch.column("_nd").to_pylist())):
            times = t[at_t[i]:at_t[i + 1]]
            n, n_words = len(times), (n_d + 15) // 16
            rec = np.zeros(n, np.dtype([("n", "<u4"), ("t", "<u4"), ("a", kind, (n_a,)), ("s", "<u2", (n_words,))]))
            rec["n"] = np.arange(1, n + 1)
            rec["t"] = times
            if n_a:
                rec["a"] = x[at_x[i]:at_x[i + 1]].reshape(n, n_a)
            if n_d:
                bits = np.zeros((n, 16 * n_words), np.uint16)
                bits[:, :n_d] = s[at_s[i]:at_s[i + 1]].reshape(n, n_d)
                rec["s"] = (bits.reshape(n, n_words, 16) << np.arange(16, dtype=np.uint16)).sum(2)
            out.append(rec.tobytes())
        yield pa.RecordBatch.from_pydict({
            C.FILENAME: batch.column(C.FILENAME),
            C.CONFIG_CONTENT: batch.column(C.CONFIG_CONTENT),
            C.DAT_CONTENT: pa.array(out, pa.binary())})


def encode_binary(recordings: DataFrame, sample_type: str = "BINARY") -> DataFrame:
    """Binary bodies; counts are computed with built-ins, numpy only lays out the bytes."""
    largest, missing, kind = SAMPLE_TYPES[sample_type]
    scales = _unit_scales() if largest is None else channel_scales(largest)
    staged = recordings.withColumn("_scales", scales).withColumn("_tick", time_tick()) \
        .withColumn("_start", _start())

    def count(v: Column, j: Column) -> Column:
        if largest is None:
            return F.coalesce(v, F.lit(float("nan"))).cast("float")
        k = F.get(F.col("_scales"), j)
        n = F.round((v - k["b"]) / k["a"]).cast("int")
        return F.when(v.isNull() | F.isnan(v), F.lit(missing)).otherwise(n)

    filled = F.transform(C.ANALOG, lambda r: F.transform(r, count))
    prepared = staged.select(
        C.FILENAME, config_text(sample_type, F.col("_scales"), F.col("_tick")).alias(C.CONFIG_CONTENT),
        F.flatten(filled).alias("_x"),
        F.transform(C.MICROSECONDS, lambda t: (
            (t - F.col("_start") - F.pmod(t - F.col("_start"), F.col("_tick"))) / F.col("_tick"))
            .cast("bigint")).alias("_t"),
        F.transform(F.flatten(_status()), lambda v: F.coalesce(v, F.lit(0.0)).cast("smallint")).alias("_s"),
        F.size(C.ANALOG_CHANNEL_NAMES).alias("_na"),
        F.size(F.coalesce(F.col(C.STATUS_CHANNEL_NAMES), F.array())).alias("_nd"))
    schema = StructType([prepared.schema[C.FILENAME], prepared.schema[C.CONFIG_CONTENT],
                         StructField(C.DAT_CONTENT, BinaryType())])
    return prepared.mapInArrow(lambda batches: _pack(batches, kind), schema)

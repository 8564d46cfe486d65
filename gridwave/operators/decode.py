"""Decode cfg/dat pairs into the decoded-recording contract.

* cfg header -> struct with built-in string functions (``split``/``slice``);
* ASCII dat  -> arrays with built-in higher-order functions (stays in the JVM);
* BINARY dat -> ``mapInArrow`` + ``numpy.frombuffer`` (one vectorised read per file).

Header layout read here: ``station,device[,year]`` / ``TT,nA,nD`` / nA analog
lines ``n,id,ph,ccbm,uu,a,b,skew,min,max[,primary,secondary,PS]`` / nD status
lines ``n,id,ph,ccbm,y`` / line frequency / number of rates / ``rate,endsamp``
lines / first sample time / trigger time / file type / time multiplier.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, LongType, StructField, StructType)

from gridwave import constants as C
from gridwave.functions.times import parse_cfg_timestamp
from gridwave.sources.files import read_ranges

CFG = "cfg"
LINE_BREAK = "\r\n|\n|\r"
END = r"[\s\x1A]+$"     # white space and the end-of-file byte of older writers


def _num(c: Column, t: str = "double") -> Column:
    return F.trim(c).try_cast(t)


def _field(c: Column, default, t: str = "double") -> Column:
    """A header field as a number: absent or blank gives the default, unreadable null."""
    return F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit(default).cast(t)).otherwise(_num(c, t))


def cfg_lines(text: Column) -> Column:
    """Header lines in their places: fields are found by line number, so blank
    optional lines stay; only what trails the last line goes, an end-of-file
    byte included."""
    return F.split(F.regexp_replace(text, END, ""), LINE_BREAK)


def _counts(lines: Column) -> tuple[Column, Column]:
    """Analog and status channels of the counts line; null where unreadable."""
    counts = F.split(F.try_element_at(lines, F.lit(2)), ",")

    def count(i: int, mark: str) -> Column:
        return _field(F.regexp_replace(F.try_element_at(counts, F.lit(i)), rf"(?i)^\s*(\d+)\s*{mark}\s*$", "$1"), 0, "int")

    total = _field(F.try_element_at(counts, F.lit(1)), 0, "int")    # only looked at, not used
    known = F.try_element_at(lines, F.lit(2)).isNotNull() & total.isNotNull()
    n_a, n_d = (F.when(known & (n >= 0), n) for n in (count(2, "A"), count(3, "D")))
    return n_a, n_d


def header_struct(lines: Column, n_a: Column, n_d: Column) -> Column:
    """Header lines (and channel counts) -> struct of fields and channel definitions.

    A field that is absent has its default, one that cannot be read is null.
    """
    known = n_a.isNotNull() & n_d.isNotNull()
    all_a, all_d = n_a, n_d
    n_a, n_d = (F.when(known, n).otherwise(F.lit(0)) for n in (n_a, n_d))

    def line(i: Column) -> Column:
        return F.try_element_at(lines, i.cast("int"))

    head = F.split(line(F.lit(1)), ",")
    analog = F.transform(F.slice(lines, F.lit(3), n_a), lambda l: _analog_line(F.split(l, ",")))
    status = F.transform(F.slice(lines, F.lit(3) + n_a, n_d), lambda l: _status_line(F.split(l, ",")))
    pos = F.lit(3) + n_a + n_d
    n_rates = _field(line(pos + 1), 0, "int")
    n_rate_lines = F.greatest(F.coalesce(n_rates, F.lit(0)), F.lit(1))
    rates = F.transform(F.slice(lines, pos + 2, n_rate_lines), lambda l: F.struct(
        _num(F.try_element_at(F.split(l, ","), F.lit(1))).alias("rate"),
        _num(F.try_element_at(F.split(l, ","), F.lit(2)), "bigint").alias("end_sample")))
    after = pos + 2 + n_rate_lines
    return F.struct(
        F.trim(F.try_element_at(head, F.lit(1))).alias(C.STATION_NAME),
        F.trim(F.try_element_at(head, F.lit(2))).alias(C.REC_DEV_ID),
        F.trim(F.try_element_at(head, F.lit(3))).alias("rev_year"),
        all_a.alias("n_analog"), all_d.alias("n_status"),
        analog.alias("analog_channels"), status.alias("status_channels"),
        _num(line(pos)).alias(C.FREQUENCY),
        n_rates.alias("n_rates"), rates.alias("rates"),
        parse_cfg_timestamp(line(after)).alias("start"),
        parse_cfg_timestamp(line(after + 1)).alias("trigger"),
        F.upper(F.trim(line(after + 2))).alias("file_type"),
        _field(line(after + 3), 1.0).alias("time_mult"),
        (F.coalesce(F.trim(line(pos)), F.lit("")) != "").alias("has_frequency"),
    )


def parse_cfg(text: Column) -> Column:
    """cfg text -> header struct, as one expression (for ad-hoc use)."""
    lines = cfg_lines(text)
    n_a, n_d = _counts(lines)
    return header_struct(lines, n_a, n_d)


def _analog_line(f: Column) -> Column:
    def at(i):
        return F.try_element_at(f, F.lit(i))
    return F.struct(
        F.trim(at(2)).alias("id"), F.trim(at(3)).alias("phase"), F.trim(at(4)).alias("ccbm"),
        F.trim(at(5)).alias("unit"),
        _field(at(6), 1.0).alias("a"), _field(at(7), 0.0).alias("b"),
        _num(at(8)).alias("skew"), _num(at(9)).alias("min"), _num(at(10)).alias("max"),
        _num(at(11)).alias("primary"), _num(at(12)).alias("secondary"), F.trim(at(13)).alias("ps"))


def _status_line(f: Column) -> Column:
    def at(i):
        return F.try_element_at(f, F.lit(i))
    return F.struct(F.trim(at(2)).alias("id"), F.trim(at(3)).alias("phase"),
                    F.trim(at(4)).alias("ccbm"), _num(at(5), "int").alias("normal"))


def with_header(pairs: DataFrame) -> DataFrame:
    """Adds the parsed header as ``cfg``.  The line array and the channel
    counts are computed once as columns, then referenced by every field."""
    staged = pairs.withColumn("_cfg_lines", cfg_lines(F.col(C.CONFIG_CONTENT)))
    n_a, n_d = _counts(F.col("_cfg_lines"))
    staged = staged.withColumn("_cfg_na", n_a).withColumn("_cfg_nd", n_d)
    return staged.withColumn(CFG, header_struct(F.col("_cfg_lines"), F.col("_cfg_na"),
                                                F.col("_cfg_nd"))
                             ).drop("_cfg_lines", "_cfg_na", "_cfg_nd")


def _blocking(cfg: Column) -> list[Column]:
    """What leaves a recording without samples, each null where it is in order."""
    known = ("ASCII", *_SAMPLE_TYPES)
    finite = lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))
    channels, rates = cfg["analog_channels"], cfg["rates"]
    bad = F.filter(channels, lambda c: ~(finite(c["a"]) & finite(c["b"])))
    # The last segment is open-ended, so its end sample is not needed.
    bad_rates = F.filter(F.transform(rates, lambda r, i: ~finite(r["rate"]) | (
        r["end_sample"].isNull() & (i < F.size(rates) - 1))), lambda x: x)
    return [
        F.when(cfg["n_analog"].isNull() | cfg["n_status"].isNull(), F.lit("unreadable channel counts")),
        F.when(F.coalesce(~cfg["file_type"].isin(*known), F.lit(True)),
               F.concat(F.lit("unknown file type: "), F.coalesce(cfg["file_type"], F.lit("none")))),
        F.when(cfg["start"].isNull(), F.lit("unreadable time of the first sample")),
        F.when(F.size(bad) > 0, F.concat(F.lit("unreadable factor or offset of channel "), F.coalesce(
            F.concat_ws(", ", F.transform(bad, lambda c: c["id"])), F.lit("")))),
        F.when(cfg["n_rates"].isNull() | (cfg["n_rates"] < 0) | ((cfg["n_rates"] > 0) & (
            (F.size(bad_rates) > 0) | (F.size(rates) < cfg["n_rates"]))), F.lit("unreadable sampling rates")),
        F.when(~finite(cfg["time_mult"]), F.lit("unreadable time multiplier")),
    ]


def header_problem(cfg: Column) -> Column:
    """Why a parsed header gives no samples (the first reason); null where it does."""
    return F.coalesce(*_blocking(cfg))


def header_problems(pairs: DataFrame, keep: Sequence[str] = (C.FILENAME,)) -> DataFrame:
    """(keep, problem) of everything in a header that cannot be read, a row for each.

    Where the counts of channels or the type are unreadable, so is what follows,
    and only the first reason is listed.  An unreadable line frequency is listed
    too; the recording keeps its samples, with a null frequency.
    """
    cfg = F.col(CFG)
    reasons = _blocking(cfg)
    light = F.when(cfg["has_frequency"] & cfg[C.FREQUENCY].isNull(), F.lit("unreadable line frequency"))
    first = F.coalesce(*reasons[:2])
    found = F.when(first.isNotNull(), F.array(first)).otherwise(F.array_compact(F.array(*reasons[2:], light)))
    # Not ``explode``, which filters empty lists out first: that would parse every header a second time.
    listed = with_header(pairs).select(*keep, found.alias("_found"))
    return listed.select(*keep, F.explode_outer("_found").alias("problem")).filter("problem IS NOT NULL")


def _only(parsed: DataFrame, wanted: Column, cols: Sequence[Column]) -> DataFrame:
    """``cols`` of the rows with ``wanted``.  A filter on it would be pushed below
    the parsed header and parse it once more for every field it looks at; one on
    what a generator gives is not."""
    rows = parsed.select(*cols, F.array(wanted).alias("_wanted"))
    return rows.withColumn("_is", F.explode_outer("_wanted")).filter("_is").drop("_wanted", "_is")


def rate_segments(cfg: Column) -> Column:
    """Sampling-rate segments of a header: array<struct(lo, hi, rate)>.

    Segment i holds samples lo < n <= hi (lo = previous end sample); the last
    segment is open-ended so a body longer than its header still gets times.
    """
    rates = cfg["rates"]
    last = F.size(rates) - 1
    return F.transform(rates, lambda r, i: F.struct(
        F.when(i == 0, F.lit(0)).otherwise(F.get(rates, i - 1)["end_sample"]).cast("double").alias("lo"),
        F.when(i == last, F.lit(float("inf"))).otherwise(r["end_sample"].cast("double")).alias("hi"),
        r["rate"].alias("rate")))


def rate_offset_seconds(segments: Column, n: Column) -> Column:
    """Seconds from the first sample to sample ``n``: each later sample adds
    1 / (rate of its segment)."""
    nd = n.cast("double")
    return F.aggregate(segments, F.lit(0.0), lambda acc, s: acc + F.greatest(
        F.lit(0.0), F.least(nd, s["hi"]) - F.greatest(s["lo"], F.lit(1.0))) / s["rate"])


def _uses_rates(cfg: Column) -> Column:
    """Rates drive the times when the header lists rates, all positive."""
    return (cfg["n_rates"] > 0) & F.forall(cfg["rates"], lambda r: r["rate"] > 0)


def _sample_micros(cfg: Column, n: Column, t: Column) -> Column:
    """Sample time in epoch us: from the sample rate when one is given,
    else from the time field times the multiplier."""
    start_us = F.unix_micros(cfg["start"])
    by_rate = start_us + F.round(rate_offset_seconds(rate_segments(cfg), n) * F.lit(1e6)).cast("bigint")
    by_time = start_us + F.round(t * cfg["time_mult"]).cast("bigint")
    return F.when(_uses_rates(cfg), by_rate).otherwise(by_time)


def _common_columns(cfg: Column) -> list[Column]:
    return [
        F.transform(cfg["analog_channels"], lambda c: c["unit"]).alias(C.ANALOG_UNITS),
        F.transform(cfg["analog_channels"], lambda c: c["id"]).alias(C.ANALOG_CHANNEL_NAMES),
        F.transform(cfg["status_channels"], lambda c: c["id"]).alias(C.STATUS_CHANNEL_NAMES),
        cfg[C.FREQUENCY].alias(C.FREQUENCY),
        cfg[C.REC_DEV_ID].alias(C.REC_DEV_ID),
        cfg[C.STATION_NAME].alias(C.STATION_NAME),
    ]


OUTPUT_ORDER = [C.ANALOG, C.ANALOG_UNITS, C.STATUS, C.ANALOG_CHANNEL_NAMES, C.STATUS_CHANNEL_NAMES,
                C.FREQUENCY, C.REC_DEV_ID, C.STATION_NAME, C.MICROSECONDS]
_ARRAYS = [C.ANALOG, C.STATUS, C.MICROSECONDS]


def _ascii_arrays(parsed: DataFrame, keep: Sequence[str]) -> tuple[DataFrame, Column, Column, Column]:
    """(frame with split fields, analog, status, microseconds) for ASCII bodies.

    Per-file scalars (a, b, counts, start, rate, multiplier) are hoisted into
    plain columns first, so the per-sample lambdas only read flat values.
    """
    cfg = F.col(CFG)
    body = F.filter(F.split(F.regexp_replace(F.col(C.DAT_CONTENT).cast("string"), END, ""), LINE_BREAK),
                    lambda l: F.trim(l) != "")
    # Split once into a column; the three projections below reuse it.
    staged = parsed.select(
        *keep, *[c for c in parsed.columns if c not in keep],
        F.transform(body, lambda l: F.split(l, ",")).alias("_fields"),
        F.transform(cfg["analog_channels"], lambda c: c["a"]).alias("_ka"),
        F.transform(cfg["analog_channels"], lambda c: c["b"]).alias("_kb"),
        cfg["n_analog"].alias("_kna"), cfg["n_status"].alias("_knd"),
        F.unix_micros(cfg["start"]).alias("_kstart"), rate_segments(cfg).alias("_ksegs"),
        _uses_rates(cfg).alias("_kbyrate"), cfg["time_mult"].alias("_kmult"),
        header_problem(cfg).isNull().alias("_kok"))
    fields, n_a, n_d = F.col("_fields"), F.col("_kna"), F.col("_knd")
    ka, kb = F.col("_ka"), F.col("_kb")
    analog = F.transform(fields, lambda f: F.transform(
        F.slice(f, 3, n_a), lambda x, j: _num(x) * F.get(ka, j) + F.get(kb, j)))
    status = F.transform(fields, lambda f: F.transform(F.slice(f, n_a + 3, n_d), lambda x: _num(x)))
    start, segs, kmult = F.col("_kstart"), F.col("_ksegs"), F.col("_kmult")
    micros = F.transform(fields, lambda f: F.when(
        F.col("_kbyrate"),
        start + F.round(rate_offset_seconds(segs, _num(F.get(f, 0))) * F.lit(1e6)).cast("bigint"))
        .otherwise(start + F.round(_num(F.get(f, 1)) * kmult).cast("bigint")))
    empty = F.array().cast("array<array<double>>")
    return (staged, F.when(n_a > 0, analog).otherwise(empty),
            F.when(n_d > 0, status).otherwise(empty), micros)


def decode_ascii(parsed: DataFrame, keep: Sequence[str] = (C.FILENAME,)) -> DataFrame:
    """ASCII bodies -> decoded recordings, entirely with built-in functions.

    Blank lines are dropped, empty fields decode to null, value = a * x + b.
    A recording without analog (status) channels gets an empty analog (status);
    one whose header cannot be read gets null samples.
    """
    staged, analog, status, micros = _ascii_arrays(parsed, keep)
    readable = F.col("_kok")
    return staged.select(
        *keep, F.when(readable, analog).alias(C.ANALOG), F.when(readable, status).alias(C.STATUS),
        F.when(readable, micros).alias(C.MICROSECONDS), *_common_columns(F.col(CFG)),
    ).select(*keep, *OUTPUT_ORDER)


# --------------------------------------------------------------------------- binary
_SAMPLE_TYPES = {"BINARY": ("<i2", -32768), "BINARY32": ("<i4", -2147483648),
                 "FLOAT32": ("<f4", None)}


def _decode_binary_rows(cols: dict, n_rows: int, want: list) -> tuple:
    """Decode the binary bodies of the rows flagged in ``want``.

    Returns (analog, status, microseconds) Arrow list arrays aligned with all
    ``n_rows`` rows; rows not decoded are null.
    """
    a_vals, a_off, a_rows = [], [0], [0]
    s_vals, s_off, s_rows = [], [0], [0]
    t_vals, t_rows = [], [0]
    for i in range(n_rows):
        if not want[i]:
            a_rows.append(a_rows[-1])
            s_rows.append(s_rows[-1])
            t_rows.append(t_rows[-1])
            continue
        content = cols[C.DAT_CONTENT][i] or b""
        n_a, n_d = int(cols["_na"][i] or 0), int(cols["_nd"][i] or 0)
        kind, missing = _SAMPLE_TYPES[cols["_ft"][i]]
        n_words = (n_d + 15) // 16
        dtype = np.dtype([("n", "<u4"), ("t", "<u4"), ("a", kind, (n_a,)),
                          ("s", "<u2", (n_words,))])
        count = len(content) // dtype.itemsize
        rec = np.frombuffer(content, dtype=dtype, count=count)
        raw = rec["a"].reshape(count, n_a)
        vals = raw.astype(np.float64)
        if missing is not None:
            vals[raw == missing] = np.nan
        a = np.asarray(cols["_a"][i] or [], dtype=np.float64)
        b = np.asarray(cols["_b"][i] or [], dtype=np.float64)
        vals = vals * a + b
        if n_a > 0:
            a_vals.append(vals.ravel())
            a_off.extend((a_off[-1] + n_a * np.arange(1, count + 1)).tolist())
            a_rows.append(a_rows[-1] + count)
        else:
            a_rows.append(a_rows[-1])
        if n_d > 0:
            words = rec["s"].reshape(count, n_words)
            bits = np.stack([(words[:, k // 16] >> (k % 16)) & 1 for k in range(n_d)], axis=1)
            s_vals.append(bits.astype(np.float64).ravel())
            s_off.extend((s_off[-1] + n_d * np.arange(1, count + 1)).tolist())
            s_rows.append(s_rows[-1] + count)
        else:
            s_rows.append(s_rows[-1])
        start_us, mult, segs = cols["_start_us"][i], cols["_mult"][i], cols["_segs"][i]
        if cols["_byrate"][i]:
            n = rec["n"].astype(np.float64)
            off = np.zeros(count)
            for seg in segs:
                off = off + np.maximum(0.0, np.minimum(n, seg["hi"]) - max(seg["lo"], 1.0)) / seg["rate"]
            us = start_us + np.round(off * 1e6)
        else:
            us = start_us + np.round(rec["t"].astype(np.float64) * mult)
        t_vals.append(us.astype(np.int64))
        t_rows.append(t_rows[-1] + count)

    mask = pa.array([not w for w in want], pa.bool_())

    def nested(vals, inner_off, outer_off):
        flat = pa.array(np.concatenate(vals) if vals else np.array([], dtype=np.float64),
                        type=pa.float64(), from_pandas=True)
        inner = pa.ListArray.from_arrays(pa.array(inner_off, pa.int32()), flat)
        return pa.ListArray.from_arrays(pa.array(outer_off, pa.int32()), inner, mask=mask)

    times = pa.ListArray.from_arrays(
        pa.array(t_rows, pa.int32()),
        pa.array(np.concatenate(t_vals) if t_vals else np.array([], np.int64), pa.int64()),
        mask=mask)
    return nested(a_vals, a_off, a_rows), nested(s_vals, s_off, s_rows), times


def _binary_batches(batches: Iterator[pa.RecordBatch], keep: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = batch.to_pydict()
        want = cols["_ok"]
        analog, status, times = _decode_binary_rows(cols, batch.num_rows, want)
        out = {k: batch.column(k) for k in keep}
        out[C.ANALOG], out[C.STATUS], out[C.MICROSECONDS] = analog, status, times
        out["_cfg_row"] = batch.column("_cfg_row")
        yield pa.RecordBatch.from_pydict(out)


_BINARY_ARRAYS = StructType([StructField(C.ANALOG, ArrayType(ArrayType(DoubleType()))),
                             StructField(C.STATUS, ArrayType(ArrayType(DoubleType()))),
                             StructField(C.MICROSECONDS, ArrayType(LongType()))])


@F.arrow_udf(_BINARY_ARRAYS)
def _binary_of(rows: pa.Array) -> pa.Array:
    """Bodies with what their decoding needs -> struct of arrays; null in, nulls out."""
    cols = {f.name: rows.field(f.name).to_pylist() for f in rows.type}
    return pa.StructArray.from_arrays(_decode_binary_rows(cols, len(rows), cols["_ok"]), names=_ARRAYS)


def decode_binary(parsed: DataFrame, keep: Sequence[str] = (C.FILENAME,)) -> DataFrame:
    """BINARY / BINARY32 / FLOAT32 bodies -> decoded recordings.

    One ``numpy.frombuffer`` per file with a structured dtype
    (uint32 n, uint32 t, samples, uint16 status words); 0x8000 (int16) or
    0x80000000 (int32) mark missing samples; status bits are unpacked
    little-endian, 16 per word.
    """
    cfg = F.col(CFG)
    prepared = parsed.select(
        *keep, F.col(C.DAT_CONTENT), *[c.alias(n) for n, c in _binary_inputs(cfg).items()],
        F.struct(*_common_columns(cfg)).alias("_cfg_row"))
    keep_fields = [f for f in prepared.schema.fields if f.name in keep]
    cfg_field = prepared.schema["_cfg_row"]
    nested = ArrayType(ArrayType(DoubleType()))
    schema = StructType([*keep_fields,
                         StructField(C.ANALOG, nested), StructField(C.STATUS, nested),
                         StructField(C.MICROSECONDS, ArrayType(LongType())), cfg_field])
    keep = list(keep)
    decoded = prepared.mapInArrow(lambda it: _binary_batches(it, keep), schema)
    return decoded.select(*keep, C.ANALOG, C.STATUS, C.MICROSECONDS, "_cfg_row.*").select(
        *keep, *OUTPUT_ORDER)


def _is_binary(cfg: Column) -> Column:
    return header_problem(cfg).isNull() & cfg["file_type"].isin(*_SAMPLE_TYPES)


def record_bytes(configs: DataFrame) -> DataFrame:
    """(filename, record_bytes) of every recording with a readable binary header."""
    cfg = F.col(CFG)
    width = F.create_map(*[x for k, (t, _) in _SAMPLE_TYPES.items()
                           for x in (F.lit(k), F.lit(np.dtype(t).itemsize))])
    size = 8 + cfg["n_analog"] * width[cfg["file_type"]] + 2 * F.ceil(cfg["n_status"] / F.lit(16))
    return _only(with_header(configs), _is_binary(cfg),
                 [F.col(C.FILENAME), size.cast("bigint").alias("record_bytes")])


def _range_batches(batches: Iterator[pa.RecordBatch], keep: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """One range at a time: its bytes are read, decoded and let go."""
    for batch in batches:
        rows = batch.to_pylist()
        for i, (row, content) in enumerate(zip(rows, read_ranges(rows))):
            cols = {k: [v] for k, v in row.items()} | {C.DAT_CONTENT: [content]}
            analog, status, times = _decode_binary_rows(cols, 1, [True])
            out = {k: batch.column(k).slice(i, 1) for k in (*keep, "_cfg_row")}
            out[C.ANALOG], out[C.STATUS], out[C.MICROSECONDS] = analog, status, times
            yield pa.RecordBatch.from_arrays([out[n] for n in (*keep, *_ARRAYS, "_cfg_row")],
                                             names=[*keep, *_ARRAYS, "_cfg_row"])


def decode_binary_ranges(ranges: DataFrame, configs: DataFrame) -> DataFrame:
    """Ranges of binary bodies (``sources.files.dat_ranges``), each read and decoded
    by one task: a row per range, told apart by ``first_record``.

    Headers join the list of ranges, which holds no bytes, and the ranges are
    dealt out; the bytes are read after the last shuffle.  Record numbers and
    times stand in the records, so a range needs nothing but its header.
    """
    cfg, keep = F.col(CFG), [C.FILENAME, "first_record"]
    headers = _only(with_header(configs), _is_binary(cfg), [
        F.col(C.FILENAME), *[c.alias(n) for n, c in _binary_inputs(cfg).items()], F.struct(*_common_columns(cfg)).alias("_cfg_row")])
    rows = ranges.join(headers, C.FILENAME)
    # Rows are a few bytes, what they stand for is not: deal them out by number.
    rows = rows.repartition(int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keep)
    nested = ArrayType(ArrayType(DoubleType()))
    schema = StructType([*[f for f in rows.schema.fields if f.name in keep],
                         StructField(C.ANALOG, nested), StructField(C.STATUS, nested),
                         StructField(C.MICROSECONDS, ArrayType(LongType())), rows.schema["_cfg_row"]])
    decoded = rows.mapInArrow(lambda it: _range_batches(it, keep), schema)
    return decoded.select(*keep, *_ARRAYS, "_cfg_row.*").select(*keep, *OUTPUT_ORDER)


def _binary_inputs(cfg: Column) -> dict[str, Column]:
    """By name, what the decoding of a binary body needs of its header."""
    return {"_ok": F.coalesce(_is_binary(cfg), F.lit(False)), "_na": cfg["n_analog"], "_nd": cfg["n_status"],
            "_ft": cfg["file_type"], "_a": F.transform(cfg["analog_channels"], lambda c: c["a"]),
            "_b": F.transform(cfg["analog_channels"], lambda c: c["b"]),
            "_start_us": F.unix_micros(cfg["start"]), "_mult": cfg["time_mult"],
            "_segs": rate_segments(cfg), "_byrate": _uses_rates(cfg)}


def decode_recordings(pairs: DataFrame, keep: Sequence[str] = (C.FILENAME,)) -> DataFrame:
    """Pairs of any body kind, decoded as their headers say.

    Where a ``file_type`` column tells the kinds apart beforehand (the paired
    table is partitioned by it), ASCII pairs are a branch of their own without
    any Python node, and each branch reads its own partitions only.
    """
    if "file_type" not in pairs.columns:
        return _decode_mixed(pairs, keep)
    is_text = F.col("file_type") == "ASCII"
    text = decode_ascii(with_header(pairs.filter(is_text)), keep)
    return text.unionByName(_decode_mixed(pairs.filter(~F.coalesce(is_text, F.lit(False))), keep))


def _decode_mixed(pairs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Both body kinds in one pass: the cfg decides, per pair, which decoder runs.

    A pair whose header cannot be read (``header_problems`` says why) keeps
    its row, with null samples.

    Every file is read once.  Python is handed binary bodies alone, nulls
    stand for the others; ASCII bodies are decoded by built-ins behind it.
    """
    staged = with_header(pairs)
    cfg = F.col(CFG)
    body = F.struct(C.DAT_CONTENT, *[c.alias(name) for name, c in _binary_inputs(cfg).items()])
    made = staged.withColumn("_bin", _binary_of(F.when(_is_binary(cfg), body)))
    staged, analog, status, micros = _ascii_arrays(made, keep)
    is_ascii = F.col("_kok") & (cfg["file_type"] == "ASCII")
    return staged.select(*keep, *[
        F.when(is_ascii, text).otherwise(F.col("_bin")[name]).alias(name)
        for name, text in zip(_ARRAYS, (analog, status, micros))], *_common_columns(cfg),
    ).select(*keep, *OUTPUT_ORDER)


# --------------------------------------------------------------------------- line-split ASCII
def line_headers(configs: DataFrame, channels: Sequence[str] = C.PHASE_CHANNELS) -> DataFrame:
    """Per ASCII recording, the few scalars a body line needs: positions,
    a and b of the wanted channels, start, rate and time multiplier."""
    parsed = with_header(configs)
    cfg = F.col(CFG)
    names = F.transform(cfg["analog_channels"], lambda c: c["id"])
    cols = [F.col(C.FILENAME), F.unix_micros(cfg["start"]).alias("_start"),
            rate_segments(cfg).alias("_segs"), _uses_rates(cfg).alias("_byrate"),
            cfg["time_mult"].alias("_mult")]
    for ch in channels:
        pos = F.array_position(names, F.lit(ch)).cast("int")          # 1-based, 0 = missing
        chan = F.try_element_at(cfg["analog_channels"], F.when(pos > 0, pos))
        cols += [F.when(pos > 0, pos + 2).alias(f"_f_{ch}"),       # field index in a line
                 chan["a"].alias(f"_a_{ch}"), chan["b"].alias(f"_b_{ch}")]
    return _only(parsed, header_problem(cfg).isNull() & (cfg["file_type"] == "ASCII"), cols)


def decode_ascii_lines(lines: DataFrame, headers: DataFrame,
                       channels: Sequence[str] = C.PHASE_CHANNELS) -> DataFrame:
    """Body lines + headers -> phase samples (filename, sample, time_us, phases).

    Every line is decoded on its own with plain expressions (no per-file
    arrays, no lambdas), so a recording of any size is spread over as many
    tasks as its file has splits.  Missing phase -> null; blank lines dropped.
    """
    text = F.regexp_replace(F.col("line"), END, "")
    body = lines.filter(F.trim(text) != "").select(C.FILENAME, F.split(text, ",").alias("_f"))
    j = body.join(headers, C.FILENAME, "inner")
    f = F.col("_f")
    n = _num(F.try_element_at(f, F.lit(1)), "bigint")
    t = _num(F.try_element_at(f, F.lit(2)))
    by_rate = F.col("_start") + F.round(rate_offset_seconds(F.col("_segs"), n)
                                        * F.lit(1e6)).cast("bigint")
    by_time = F.col("_start") + F.round(t * F.col("_mult")).cast("bigint")
    out = [F.col(C.FILENAME), n.alias("sample_number"),
           F.when(F.col("_byrate"), by_rate).otherwise(by_time).alias("time_us")]
    for ch in channels:
        x = _num(F.try_element_at(f, F.col(f"_f_{ch}")))
        out.append((F.col(f"_a_{ch}") * x + F.col(f"_b_{ch}")).alias(ch))
    return j.select(*out)

"""Golden-bytes decode tests on hand-made recording pairs (FIXTURES.md section 2)."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import recording_fixtures as RF
from gridwave import constants as C
from gridwave.functions.keys import first_dot_key, pair_key
from gridwave.functions.times import parse_cfg_timestamp
from gridwave.operators import decode as DE
from gridwave.operators import encode as EN
from gridwave.operators import pairing as PR
from gridwave.operators import shape as SH
from gridwave.sources import files as FS


def write_pair(folder, stem, pair, cfg=True, dat=True):
    os.makedirs(folder, exist_ok=True)
    cfg_text, dat_bytes = pair
    if cfg:
        with open(os.path.join(folder, stem + ".cfg"), "w", newline="") as f:
            f.write(cfg_text)
    if dat:
        with open(os.path.join(folder, stem + ".dat"), "wb") as f:
            f.write(dat_bytes)


def decode_folder(spark, root):
    pairs = PR.pair_files(FS.scan_cfg(spark, root), FS.scan_dat(spark, root))
    rows = DE.decode_recordings(pairs).collect()
    return {r[C.FILENAME].rsplit("/", 1)[-1]: r for r in rows}


def as_lists(rows):
    return [list(r) for r in rows]


@pytest.fixture(scope="module")
def decoded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("recs"))
    for name in ["ascii_3a", "ascii_crlf", "binary_3a", "binary_status", "no_analog",
                 "reordered", "missing_phase", "extra_channel", "duplicate_channel", "rate_based",
                 "multi_rate", "multi_rate_binary"]:
        write_pair(root, name, getattr(RF, name)())
    write_pair(root, "cfg_only", RF.ascii_3a(), dat=False)
    write_pair(root, "dat_only", RF.ascii_3a(), cfg=False)
    return decode_folder(spark, root)


def test_ascii_basic(decoded):
    r = decoded["ascii_3a"]
    assert as_lists(r[C.ANALOG]) == RF.expected_phases()
    assert r[C.ANALOG_CHANNEL_NAMES] == ["IA", "IB", "IC"]
    assert r[C.ANALOG_UNITS] == ["A", "A", "A"]          # R4: units are returned
    assert r[C.STATUS] == [] and r[C.STATUS_CHANNEL_NAMES] == []
    assert r[C.FREQUENCY] == 60.0 and r[C.STATION_NAME] == "ST1" and r[C.REC_DEV_ID] == "D7"
    assert r[C.MICROSECONDS] == [RF.EPOCH_2024_US + t for _, t, *_ in RF.SAMPLES]


def test_crlf_without_final_newline_equals_lf(decoded):
    a, b = decoded["ascii_3a"], decoded["ascii_crlf"]
    for c in DE.OUTPUT_ORDER:
        assert a[c] == b[c], c


def test_binary_signed_decode_equals_ascii(decoded):
    a, b = decoded["ascii_3a"], decoded["binary_3a"]
    assert as_lists(b[C.ANALOG]) == as_lists(a[C.ANALOG])
    assert b[C.MICROSECONDS] == a[C.MICROSECONDS]


def test_binary_status_bits(decoded):
    r = decoded["binary_status"]
    assert r[C.STATUS_CHANNEL_NAMES] == [f"S{k}" for k in range(1, 18)]   # R5
    for (n, *_), bits in zip(RF.SAMPLES, r[C.STATUS]):
        assert bits[:16] == [1.0 if k < n else 0.0 for k in range(16)]
        assert bits[16] == float(n % 2)


def test_no_analog_guard(decoded, spark):
    r = decoded["no_analog"]
    assert r[C.ANALOG] == [] and r[C.ANALOG_CHANNEL_NAMES] == []
    assert as_lists(r[C.STATUS]) == [[1.0], [0.0]]
    # explode drops a recording without analog channels from the long form
    df = spark.createDataFrame([r.asDict()], schema=decoded_schema(spark))
    assert SH.flatten_long(df).count() == 0


def decoded_schema(spark):
    from pyspark.sql.types import StringType, StructField, StructType
    from gridwave.schemas import DECODED_RECORDING
    return StructType([StructField(C.FILENAME, StringType())] + DECODED_RECORDING.fields)


def test_pick_by_name_reordered_missing_extra_duplicate(decoded, spark):
    expected = RF.expected_phases()
    rows = [decoded[k].asDict() for k in
            ("reordered", "missing_phase", "extra_channel", "duplicate_channel")]
    df = spark.createDataFrame(rows, schema=decoded_schema(spark))
    out = {r[C.FILENAME].rsplit("/", 1)[-1]: r for r in SH.phase_rows(df).collect()
           if r["sample_index"] == 0}
    assert [out["reordered"][p] for p in C.PHASE_CHANNELS] == expected[0]
    assert [out["missing_phase"][p] for p in C.PHASE_CHANNELS] == expected[0][:2] + [None]  # R11
    assert [out["extra_channel"][p] for p in C.PHASE_CHANNELS] == expected[0]               # F1
    assert [out["duplicate_channel"][p] for p in C.PHASE_CHANNELS] == expected[0]           # first wins


def test_rate_based_times(decoded):
    r = decoded["rate_based"]
    assert r[C.MICROSECONDS] == [RF.EPOCH_2024_US + 1000 * i for i in range(4)]


def test_multiple_sampling_rates(decoded, spark, tmp_path):
    """Each sample after the first adds 1/rate of its own segment: 0, 1, 3, 5 ms."""
    want = [RF.EPOCH_2024_US + us for us in (0, 1000, 3000, 5000)]
    assert decoded["multi_rate"][C.MICROSECONDS] == want
    assert decoded["multi_rate_binary"][C.MICROSECONDS] == want
    write_pair(str(tmp_path), "mr", RF.multi_rate())
    lines = FS.scan_dat_lines(spark, str(tmp_path))
    got = DE.decode_ascii_lines(lines, DE.line_headers(FS.scan_cfg(spark, str(tmp_path))))
    assert sorted(r.time_us for r in got.collect()) == want


def test_unpaired_files_drop_out(decoded):
    assert "cfg_only" not in decoded and "dat_only" not in decoded


def test_dotted_directory_keys(spark, tmp_path):
    """R1: the reference's first-dot key merges every file below a dotted folder."""
    folder = str(tmp_path / "a b.v1")
    for i in range(3):
        write_pair(folder, f"m{i}", RF.ascii_3a())
    files = FS.file_inventory(spark, str(tmp_path))
    keys = files.select(pair_key(F.col("path")).alias("k"), first_dot_key(F.col("path")).alias("f"))
    assert keys.select("k").distinct().count() == 3
    assert keys.select("f").distinct().count() == 1
    assert len(decode_folder(spark, str(tmp_path))) == 3


def channel_steps(rows, largest=C.INT16_LARGEST):
    """What one count of an integer body stands for, by channel."""
    columns = [[v for v in column if v is not None] for column in zip(*rows)]
    return [(max(c) - min(c)) / 2 / largest if c else 0.0 for c in columns]


def _written(spark, values, times, enc, **kw):
    """One single-channel recording, encoded and decoded again."""
    row = {C.FILENAME: "r", C.ANALOG: [[v] for v in values], C.ANALOG_UNITS: ["A"], C.STATUS: [],
           C.ANALOG_CHANNEL_NAMES: ["IA"], C.STATUS_CHANNEL_NAMES: [], C.FREQUENCY: None,
           C.REC_DEV_ID: None, C.STATION_NAME: None, C.MICROSECONDS: times}
    back = DE.decode_recordings(enc(spark.createDataFrame([row], decoded_schema(spark)), **kw)).first()
    return [v for v, in back[C.ANALOG]], back[C.MICROSECONDS]


T0 = RF.EPOCH_2024_US
FAST = [T0 + 100 * i for i in range(4)]


@pytest.mark.parametrize("enc,kw,largest", [
    (EN.encode_ascii, {}, None), (EN.encode_binary, {}, C.INT16_LARGEST),
    (EN.encode_binary, {"sample_type": "BINARY32"}, C.INT32_LARGEST),
    (EN.encode_binary, {"sample_type": "FLOAT32"}, 2 ** 22)])
@pytest.mark.parametrize("values", [
    [700.0, -2000.0, 2000.0, 0.004], [0.001, 0.002, -0.001, 0.0], [5.25, 5.25, None, 5.25],
    [None, None, None, None], [1e-9, 3e-9, 2e-9, 1e-9]])
def test_writer_loses_nothing(spark, enc, kw, largest, values):
    """No wrap, no fixed resolution, no collapsed times; 100 microsecond steps."""
    got, times = _written(spark, values, FAST, enc, **kw)
    known = [v for v in values if v is not None]
    step = (max(known) - min(known)) / 2 / largest if largest and known else 0.0
    if kw.get("sample_type") == "FLOAT32":
        step = max(map(abs, known), default=0.0) / largest
    for g, w in zip(got, values):
        assert (g is None) == (w is None) and (w is None or abs(g - w) <= step * 0.500001)
    assert times == FAST


def test_tick_widens_only_when_the_span_needs_it(spark):
    span = [T0, T0 + 1, T0 + 4_294_967_294]
    assert _written(spark, [1.0, 2.0, 3.0], span, EN.encode_binary)[1] == span
    wide = [T0, T0 + 10, T0 + 3 * 4_294_967_294]
    assert _written(spark, [1.0, 2.0, 3.0], wide, EN.encode_binary)[1] == [T0, T0 + 9, wide[2]]
    assert _written(spark, [1.0, 2.0, 3.0], wide, EN.encode_ascii)[1] == wide


def test_infinite_values_do_not_wrap(spark):
    with pytest.raises(Exception, match="infinite"):
        _written(spark, [1.0, float("inf")], FAST[:2], EN.encode_binary)
    assert _written(spark, [1.0, float("inf")], FAST[:2], EN.encode_binary, sample_type="FLOAT32")[0][1] == float("inf")


@pytest.mark.parametrize("text,want", [
    ("01/02/2024,03:04:05.123456", T0 + 31 * 86_400_000_000 + 11_045_123_456),
    ("1/2/2024,3:04:05.123456", T0 + 31 * 86_400_000_000 + 11_045_123_456),
    ("01/01/2024,00:00:00.000000000", T0), ("01/01/24,00:00:00", T0), ("01/01/2024,00:00:00.5", T0 + 500_000),
    ("01/01/2024,00:00:00.123456789", T0 + 123_456), ("01/01/99,00:00:00", T0 - 9131 * 86_400_000_000),
    ("32/01/2024,00:00:00", None), ("no time", None), ("", None)])
def test_header_times(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(
        F.unix_micros(parse_cfg_timestamp(F.col("t"))).alias("u")).first().u
    assert got == want


def test_blank_header_line_keeps_the_others_in_place(spark):
    cfg, dat = RF.ascii_3a()
    for text in (cfg.replace("\n60\n", "\n\n"), cfg.replace("\n60.0\n", "\n\n"), cfg + "\n\x1a"):
        df = spark.createDataFrame([("r", text, bytearray(dat))], "filename string, config_content string, dat_content binary")
        assert as_lists(DE.decode_recordings(df).first()[C.ANALOG]) == RF.expected_phases()


def test_end_of_file_byte_is_no_sample(spark, tmp_path):
    cfg, dat = RF.ascii_3a()
    write_pair(str(tmp_path), "m", (cfg, dat + b"\x1a"))
    assert as_lists(decode_folder(spark, str(tmp_path))["m"][C.ANALOG]) == RF.expected_phases()
    lines = DE.decode_ascii_lines(FS.scan_dat_lines(spark, str(tmp_path)),
                                  DE.line_headers(FS.scan_cfg(spark, str(tmp_path))))
    assert lines.count() == len(RF.expected_phases())


def test_unreadable_headers_are_reported_not_guessed(spark):
    cfg, dat = RF.ascii_3a()
    rows = [("good", cfg), ("type", cfg.replace("ASCII", "PACKED")), ("time", cfg.replace("01/01/2024", "99/99/2024"))]
    df = spark.createDataFrame([(n, c, bytearray(dat)) for n, c in rows],
                               "filename string, config_content string, dat_content binary")
    assert {r.filename: r.problem for r in DE.header_problems(df).collect()} == {
        "type": "unknown file type: PACKED", "time": "unreadable time of the first sample"}
    analog = {r.filename: r[C.ANALOG] for r in DE.decode_recordings(df).collect()}
    assert as_lists(analog["good"]) == RF.expected_phases() and analog["type"] is analog["time"] is None


def _fields(cfg, at, to):
    """The header with field ``at`` (line, field) replaced, or the line cut where ``to`` is None."""
    lines = cfg.split("\n")
    row = lines[at[0]].split(",")
    lines[at[0]] = ",".join(row[:at[1]] if to is None else [*row[:at[1]], to, *row[at[1] + 1:]])
    return "\n".join(lines)


@pytest.mark.parametrize("at,to,problem", [
    ((1, 0), "x", "unreadable channel counts"), ((1, 1), "yA", "unreadable channel counts"),
    ((1, 2), "zD", "unreadable channel counts"), ((1, 1), "-3A", "unreadable channel counts"),
    ((3, 5), "bad", "unreadable factor or offset of channel IB"),
    ((4, 6), "1,5;", None), ((4, 6), "1;5", "unreadable factor or offset of channel IC"),
    ((2, 5), "NaN", "unreadable factor or offset of channel IA"),
    ((2, 5), "", None), ((2, 5), None, None),
    ((6, 0), "two", "unreadable sampling rates"), ((11, 0), "zz", "unreadable time multiplier"),
    ((11, 0), "", None), ((5, 0), "fifty", "unreadable line frequency"), ((5, 0), "", None)])
@pytest.mark.parametrize("kind", ["ascii", "binary"])
def test_unreadable_fields_are_reported_and_absent_ones_have_defaults(spark, kind, at, to, problem):
    cfg, dat = RF.ascii_3a() if kind == "ascii" else RF.binary_3a()
    rows = [("ok", cfg, bytearray(dat)), ("x", _fields(cfg, at, to), bytearray(dat))]
    df = spark.createDataFrame(rows, "filename string, config_content string, dat_content binary")
    assert [tuple(r) for r in DE.header_problems(df).collect()] == ([("x", problem)] if problem else [])
    decoders = [DE.decode_recordings, lambda x: DE.decode_ascii(DE.with_header(x)) if kind == "ascii"
                else DE.decode_binary(DE.with_header(x))]
    for decode in decoders:
        got = {r.filename: r for r in decode(df).collect()}
        assert as_lists(got["ok"][C.ANALOG]) == RF.expected_phases()
        lost = problem and problem != "unreadable line frequency"
        assert (got["x"][C.ANALOG] is None) == (got["x"][C.MICROSECONDS] is None) == bool(lost)


@pytest.mark.parametrize("folder", ["a b", "a+b", "a%20b", "äö.d"])
def test_any_folder_name_pairs(spark, tmp_path, folder):
    root = str(tmp_path / folder)
    write_pair(root, "m", RF.ascii_3a())
    lines = DE.decode_ascii_lines(FS.scan_dat_lines(spark, str(tmp_path)),
                                  DE.line_headers(FS.scan_cfg(spark, str(tmp_path))))
    assert lines.count() == len(RF.expected_phases())


@pytest.mark.parametrize("how", ["right", "full", "outer"])
def test_interval_join_refuses_to_return_copies(spark, how):
    df = spark.sql("select 'a' k, timestamp'2024-01-01' t")
    with pytest.raises(ValueError):
        PR.interval_join(df, df.toDF("k2", "t2"), "k", "k2", "t", "t2", how=how)


def test_unpaired_files_say_what_they_lack(spark):
    cfg = spark.createDataFrame([("a", "x"), ("b", "x")], "filename string, config_content string")
    dat = spark.createDataFrame([("b", bytearray(b"x")), ("c", bytearray(b"x"))], "filename string, dat_content binary")
    assert sorted(map(tuple, PR.unpaired_files(cfg, dat).collect())) == [("a", "dat"), ("c", "cfg")]


def test_encode_decode_round_trip(spark, decoded):
    """decode(encode(x)) == x: ASCII exactly, int16 to half a step of the channel's scale."""
    src = [decoded[k].asDict() for k in ("ascii_3a", "binary_status", "missing_phase")]
    df = spark.createDataFrame(src, schema=decoded_schema(spark))
    for enc, scaled in ((EN.encode_ascii, False), (EN.encode_binary, True)):
        pairs = enc(df)
        back = {r[C.FILENAME]: r for r in DE.decode_recordings(pairs).collect()}
        for s in src:
            r = back[s[C.FILENAME]]
            assert r[C.ANALOG_CHANNEL_NAMES] == s[C.ANALOG_CHANNEL_NAMES]
            assert r[C.STATUS_CHANNEL_NAMES] == s[C.STATUS_CHANNEL_NAMES]
            step = channel_steps(s[C.ANALOG]) if scaled else [0.0] * len(s[C.ANALOG_CHANNEL_NAMES])
            for got, want in zip(r[C.ANALOG], s[C.ANALOG]):
                for g, w, e in zip(got, want, step):
                    assert (g is None and w is None) or abs(g - w) <= e * 0.500001
            assert as_lists(r[C.STATUS]) == as_lists(s[C.STATUS])


def test_cfg_header_fields(spark):
    cfg, _ = RF.binary_status()
    row = spark.createDataFrame([(cfg,)], "c string").select(DE.parse_cfg(F.col("c")).alias("h")).first().h
    assert row.n_analog == 3 and row.n_status == 17 and row.file_type == "BINARY"
    assert row.analog_channels[1].id == "IB" and row.analog_channels[1].a == 0.5
    assert str(row.trigger) .startswith("2024-01-01 00:00:00.02")


def test_line_split_decode_spreads_one_file_and_matches_whole_file(spark, tmp_path):
    """A single large ASCII body is read as several splits, and line-wise
    decoding gives the same phase rows as whole-file decoding."""
    n = 20_000
    rows = [(i + 1, i * 250, (i % 97) - 48, (i % 89) - 44, None if i % 50 == 0 else (i % 83) - 41)
            for i in range(n)]
    cfg = RF.cfg_text(RF.PHASES3).replace("0,4\n", f"0,{n}\n")
    write_pair(str(tmp_path), "big", (cfg, RF.ascii_dat(rows)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        lines = FS.scan_dat_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 1
        by_line = DE.decode_ascii_lines(lines, DE.line_headers(FS.scan_cfg(spark, str(tmp_path))))
        got = sorted((r.sample_number, r.time_us, r.IA, r.IB, r.IC) for r in by_line.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = decode_folder(spark, str(tmp_path))["big"]
    want = sorted((i + 1, us, *v) for i, (us, v) in
                  enumerate(zip(whole[C.MICROSECONDS], whole[C.ANALOG])))
    assert got == want and len(got) == n


def test_one_large_binary_body_is_decoded_by_several_tasks(spark, tmp_path):
    """Ranges of a body, in a folder with a space, equal the whole-file decode."""
    n, rng = 30_000, np.random.default_rng(1)
    row = {C.FILENAME: "big", C.ANALOG: rng.normal(size=(n, 3)).tolist(), C.ANALOG_UNITS: ["A"] * 3,
           C.STATUS: rng.integers(0, 2, (n, 17)).astype(float).tolist(), C.ANALOG_CHANNEL_NAMES: ["IA", "IB", "IC"],
           C.STATUS_CHANNEL_NAMES: [f"S{k}" for k in range(17)], C.FREQUENCY: 50.0, C.REC_DEV_ID: "1",
           C.STATION_NAME: "ST", C.MICROSECONDS: [T0 + 100 * i for i in range(n)]}
    pair = EN.encode_binary(spark.createDataFrame([row], decoded_schema(spark))).first()
    root = str(tmp_path / "a b")
    write_pair(root, "big", (pair[C.CONFIG_CONTENT], bytes(pair[C.DAT_CONTENT]) + b"part"))
    configs = FS.scan_cfg(spark, root)
    ranges = FS.dat_ranges(spark, root, DE.record_bytes(configs), range_bytes=50_000)
    decoded = DE.decode_binary_ranges(ranges, configs)
    assert decoded.withColumn("p", F.spark_partition_id()).select("p").distinct().count() > 1
    # The bytes are read and decoded behind the last shuffle: no exchange stands above the node that holds them.
    plan = decoded._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("MapInArrow")
    assert C.DAT_CONTENT not in below and "Repartition" in below
    assert "Repartition" not in above and "Join" not in above and "Aggregate" not in above
    parts = sorted(decoded.collect(), key=lambda r: r.first_record)
    whole = decode_folder(spark, root)["big"]
    assert len(parts) > 10
    for c in (C.ANALOG, C.STATUS, C.MICROSECONDS):
        assert [x for r in parts for x in r[c]] == whole[c], c
    assert len(whole[C.ANALOG]) == n

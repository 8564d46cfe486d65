"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables (mainly ``events`` as long samples, see
``gridwave.sources.testdata``) and runs one operator of the inventory over
the whole table.  Computed columns carry the same names as in
``gridwave.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwave import constants as C
from gridwave.functions import arrays as AR
from gridwave.functions import jsonfn as JS
from gridwave.functions import keys as K
from gridwave.functions import times as T
from gridwave.operators import decode as DE
from gridwave.operators import encode as EN
from gridwave.operators import frames as FR
from gridwave.operators import kernels as KN
from gridwave.operators import model as MD
from gridwave.operators import pairing as PR
from gridwave.operators import shape as SH
from gridwave.plans import staging as ST
from gridwave.schemas import DECODED_RECORDING
from gridwave.session import path_exists
from gridwave.sources import files as FS
from gridwave.sources import listing as LS
from gridwave.sources import testdata as TD
from gridwave.streaming import complete as CP
from gridwave.streaming import pipeline as PL

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
# streaming progress of the last stream_late run per input folder (for tests)
LATE_PROGRESS: dict = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _events(spark: SparkSession, d: str) -> DataFrame:
    return TD.table(spark, d, "events")


def _long(spark: SparkSession, d: str) -> DataFrame:
    return TD.long_samples(_events(spark, d))


def _phases(spark: SparkSession, d: str) -> DataFrame:
    """Pivoted phase table keyed by (filename, timestamp, time_us)."""
    return SH.pivot_phases(_long(spark, d), [C.FILENAME, C.TIMESTAMP, "time_us"], ["event_id"])


def _frame_labels(spark: SparkSession, d: str) -> DataFrame:
    return FR.frame_labels(TD.raw_samples(_events(spark, d)), C.FILENAME, "time_us", "is_fault",
                           ["event_id"], C.TEST_FRAME_LENGTH, bucket_us=TD.EVENT_BUCKET_US)


def _written(spark: SparkSession, d: str, df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once for this call, in the shared folder."""
    path = f"{ST.staging_path(spark, name, d)}/run-{uuid.uuid4().hex[:10]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _shuffled(spark: SparkSession, d: str) -> DataFrame:
    """Frame labels in seeded order.  The rank needs its input twice (counts and
    rows), so the labels, a few bytes a frame, are written first."""
    labels = _written(spark, d, _frame_labels(spark, d), "frame-labels")
    return FR.shuffle_order(labels, [C.FILENAME, "frame"])


# --------------------------------------------------------------------------- shape
@register("filter_channels")
def filter_channels(spark, d):
    return SH.filter_channels(_long(spark, d))


@register("pivot_phases")
def pivot_phases(spark, d):
    return SH.pivot_phases(_long(spark, d), [C.FILENAME, C.TIMESTAMP], ["event_id"])


@register("pivot_discover")
def pivot_discover(spark, d):
    return SH.pivot_discover(_long(spark, d), [C.FILENAME, C.TIMESTAMP], ["event_id"])


@register("gather_waveform")
def gather_waveform(spark, d):
    g = SH.gather_waveform(_phases(spark, d), "time_us", C.TIMESTAMP,
                           frame_len=C.WAVEFORM_LENGTH, bucket_us=TD.EVENT_BUCKET_US)
    return g.select(C.FILENAME, "frame", "n_samples", "length_ok",
                    F.transform("timestep", lambda x: F.unix_micros(x[C.TIMESTAMP].cast("timestamp")))
                    .alias("sample_times"), SH.waveform_matrix(g).alias("waveform"))


@register("metadata_first")
def metadata_first(spark, d):
    ms = TD.metadata_samples(_events(spark, d), TD.table(spark, d, "customer"),
                             TD.table(spark, d, "nation"), TD.table(spark, d, "region"))
    return SH.metadata_first(ms, order=[C.TIMESTAMP, "event_id"])


@register("enrich_metadata")
def enrich_metadata(spark, d):
    meta = metadata_first(spark, d)
    return SH.enrich_metadata(SH.filter_channels(_long(spark, d)), meta)


@register("distinct_recordings")
def distinct_recordings(spark, d):
    return SH.distinct_recordings(_long(spark, d))


@register("one_recording")
def one_recording(spark, d):
    return SH.one_recording(TD.raw_samples(_events(spark, d)), ["time_us", "event_id"])


# --------------------------------------------------------------------------- frames
@register("frame_waveforms")
def frame_waveforms(spark, d):
    return FR.frame_waveforms(TD.raw_samples(_events(spark, d)), C.FILENAME, "time_us",
                              ["event_id"], C.TEST_FRAME_LENGTH, label_col="is_fault",
                              bucket_us=TD.EVENT_BUCKET_US)


@register("frame_labels")
def frame_labels(spark, d):
    return _frame_labels(spark, d)


@register("shuffle_order")
def shuffle_order(spark, d):
    return _shuffled(spark, d).drop("n_total")


@register("train_val_test_split")
def train_val_test_split(spark, d):
    return FR.split_by_position(_shuffled(spark, d)).drop("n_total")


@register("split_sizes")
def split_sizes(spark, d):
    return FR.split_sizes(train_val_test_split(spark, d))


@register("union_train_val")
def union_train_val(spark, d):
    return FR.union_train_val(train_val_test_split(spark, d))


# --------------------------------------------------------------------------- joins / keys
def _typed_events(spark, d, event_type: str, prefix: str) -> DataFrame:
    return (_events(spark, d).filter(F.col("event_type") == event_type)
            .select(TD.recording_of_user(F.col("user_id")).alias(f"{prefix}_filename"),
                    F.col("ts").alias(f"{prefix}_mod_time"),
                    F.col("event_id").alias(f"{prefix}_event_id")))


@register("interval_join")
def interval_join(spark, d):
    cfg = _typed_events(spark, d, "click", "cfg")
    dat = _typed_events(spark, d, "view", "dat")
    j = PR.interval_join(cfg, dat, "cfg_filename", "dat_filename", "cfg_mod_time", "dat_mod_time")
    return j.select(F.col("cfg_filename").alias(C.FILENAME), "cfg_event_id", "dat_event_id",
                    "cfg_mod_time", "dat_mod_time")


@register("pair_key")
def pair_key(spark, d):
    p = TD.event_paths(_events(spark, d))
    return p.select("event_id", "path", K.pair_key(F.col("path")).alias("pair_key"),
                    K.base_name(F.col("path")).alias("base_name"),
                    K.first_dot_key(F.col("path")).alias("first_dot_key"))


@register("label_by_pattern")
def label_by_pattern(spark, d):
    p = TD.event_paths(_events(spark, d))
    return p.select("event_id", "path", K.label_by_pattern(F.col("path"), "error").alias("is_fault"))


@register("raw_time_micros")
def raw_time_micros(spark, d):
    seconds = (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("time")
    s = _events(spark, d).select("event_id", seconds)
    return s.select("event_id", "time", T.micros_truncated(F.col("time")).alias("time_us"))


@register("sample_times")
def sample_times(spark, d):
    """Start of each user's first event plus fractional seconds -> timestamps."""
    ev = _events(spark, d).select("event_id", "user_id", "ts")
    start = ev.groupBy("user_id").agg(F.min("ts").alias("start"))
    j = ev.join(start, "user_id")
    sec = (F.unix_micros(F.col("ts").cast("timestamp"))
           - F.unix_micros(F.col("start").cast("timestamp"))) / F.lit(1e6)
    us = T.sample_micros(F.unix_micros(F.col("start").cast("timestamp")), sec)
    return j.select("event_id", us.alias("time_us"),
                    F.timestamp_micros(us).cast("timestamp_ntz").alias("sample_time"))


@register("json_parse")
def json_parse(spark, d):
    schema = "k BIGINT, missing STRING"
    ev = _events(spark, d)
    parsed = F.from_json(F.col("props"), schema)
    return ev.select("event_id", parsed["k"].alias("k"), parsed["missing"].alias("missing"))


@register("json_render")
def json_render(spark, d):
    ev = _events(spark, d)
    return ev.select("event_id", F.to_json(F.struct(F.col("event_type"), F.col("user_id")))
                     .alias("json"))


# --------------------------------------------------------------------------- recordings


def _captures(spark, d) -> DataFrame:
    return TD.captures(_events(spark, d), TD.table(spark, d, "customer"),
                       TD.table(spark, d, "nation"), TD.table(spark, d, "region"))


def _rounded(decoded: DataFrame) -> DataFrame:
    return decoded.withColumn(C.ANALOG, AR.round_nested(F.col(C.ANALOG)))


@register("encode_recordings")
def encode_recordings(spark, d):
    """cfg text in full; the dat bytes as their md5 and length (exact, and
    free of binary-type differences between engines)."""
    enc = EN.encode_ascii(_captures(spark, d))
    return enc.select(C.FILENAME, K.short_id(F.col(C.FILENAME)).alias("file_id"),
                      C.CONFIG_CONTENT, F.md5(C.DAT_CONTENT).alias("dat_md5"),
                      F.length(C.DAT_CONTENT).alias("n_bytes"))


@register("encode_binary_recordings")
def encode_binary_recordings(spark, d):
    """int16 bodies, scaled per channel: the dat bytes as their md5 and length."""
    enc = EN.encode_binary(_captures(spark, d))
    return enc.select(C.FILENAME, F.md5(C.DAT_CONTENT).alias("dat_md5"), F.length(C.DAT_CONTENT).alias("n_bytes"))


@register("decode_ascii")
def decode_ascii(spark, d):
    pairs = EN.encode_ascii(_captures(spark, d))
    return _rounded(DE.decode_ascii(DE.with_header(pairs)))


@register("decode_binary")
def decode_binary(spark, d):
    pairs = EN.encode_binary(_captures(spark, d))
    return _rounded(DE.decode_binary(DE.with_header(pairs)))


@register("flatten_long")
def flatten_long(spark, d):
    return SH.flatten_long(_captures(spark, d))


@register("flatten_status")
def flatten_status(spark, d):
    return SH.flatten_status(_captures(spark, d))


@register("waveform_matrix")
def waveform_matrix(spark, d):
    """Row-local pick of IA/IB/IC by name; channel order is rotated per
    capture first so the pick must go by name, not position."""
    cap = _captures(spark, d)
    rot = (F.abs(F.hash(C.FILENAME)) % 3).cast("int")
    perm = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: (i + rot) % 3)
    rotated = cap.select(
        C.FILENAME, C.MICROSECONDS,
        F.transform(perm, lambda p: F.get(F.col(C.ANALOG_CHANNEL_NAMES), p)).alias(C.ANALOG_CHANNEL_NAMES),
        F.transform(C.ANALOG, lambda r: F.transform(perm, lambda p: F.get(r, p))).alias(C.ANALOG))
    return rotated.select(C.FILENAME,
                          AR.pick_channels(F.col(C.ANALOG), F.col(C.ANALOG_CHANNEL_NAMES))
                          .alias("waveform"))


@register("transpose_channels")
def transpose_channels(spark, d):
    cap = _captures(spark, d)
    return cap.select(C.FILENAME,
                      AR.channel_major_to_time_major(F.col(C.ANALOG)).alias("channel_major"))


@register("channel_attributes")
def channel_attributes(spark, d):
    parsed = DE.with_header(EN.encode_ascii(_captures(spark, d)))
    cfg = F.col(DE.CFG)
    return parsed.select(
        C.FILENAME,
        AR.channel_attribute(cfg["analog_channels"], "unit").alias("analog_units"),
        AR.channel_attribute(cfg["analog_channels"], "id").alias("analog_ids"),
        AR.channel_attribute(cfg["analog_channels"], "phase").alias("analog_phases"),
        AR.channel_attribute(cfg["status_channels"], "id").alias("status_ids"))


@register("channel_alias")
def channel_alias(spark, d):
    ev = _events(spark, d)
    raw = ev.select(TD.recording_of_user(F.col("user_id")).alias(C.FILENAME),
                    F.col("ts").alias(C.TIMESTAMP),
                    F.col("event_type").alias(C.ANALOG_CHANNEL_NAMES),
                    F.col("value").alias(C.ANALOG), "event_id")
    aliases = spark.createDataFrame(list(C.EVENT_CHANNELS), "alias string, standard string")
    return SH.alias_channels(raw, aliases)


# --------------------------------------------------------------------------- files


def _folder_and_name(key: str = C.FILENAME) -> list:
    """The last two segments of a path, empty where there is none.

    Cut at the slashes: a pattern is tried again from every character of the path,
    which long tables pay for each row.
    """
    path = F.col(key)
    name = F.substring_index(path, "/", -1)
    above = F.substring(path, F.lit(1), F.length(path) - F.length(name) - 1)
    return [F.when(path.isNotNull(), F.when(name == "", F.lit("")).otherwise(F.substring_index(above, "/", -1)))
            .alias("folder"), name.alias(C.FILENAME)]


@register("file_inventory")
def file_inventory(spark, d):
    inv = FS.file_inventory(spark, ST.recording_files(spark, d))
    return inv.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"),
                      F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "length")


@register("file_inventory_wide")
def file_inventory_wide(spark, d):
    """The same listing made by tasks, level by level."""
    inv = LS.file_inventory_wide(spark, ST.recording_files(spark, d))
    return inv.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"),
                      F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "length")


@register("scan_cfg")
def scan_cfg(spark, d):
    cfg = FS.scan_cfg(spark, ST.recording_files(spark, d))
    return cfg.select(*_folder_and_name(), C.CONFIG_CONTENT)


@register("scan_dat")
def scan_dat(spark, d):
    dat = FS.scan_dat(spark, ST.recording_files(spark, d))
    return dat.select(*_folder_and_name(), F.length(C.DAT_CONTENT).alias("n_bytes"))


@register("pair_join")
def pair_join(spark, d):
    root = ST.recording_files(spark, d)
    pairs = PR.pair_files(FS.scan_cfg(spark, root), FS.scan_dat(spark, root))
    return pairs.select(*_folder_and_name(), C.CONFIG_CONTENT,
                        F.length(C.DAT_CONTENT).alias("n_bytes"))


@register("decode_files")
def decode_files(spark, d):
    """Files -> pairs -> decoded recordings; the cfg picks ASCII or BINARY per pair."""
    root = ST.recording_files(spark, d)
    pairs = PR.pair_files(FS.scan_cfg(spark, root), FS.scan_dat(spark, root))
    decoded = _rounded(DE.decode_recordings(pairs))
    return decoded.select(*_folder_and_name(), *[c for c in decoded.columns if c != C.FILENAME])


@register("scan_raw_csv")
def scan_raw_csv(spark, d):
    raw = FS.scan_raw_csv(spark, ST.raw_text_files(spark, d), pattern="error")
    return raw.select(F.regexp_extract("path", r"recording=([^/]+)/", 1).alias("recording"),
                      "time", "IA", "IB", "IC", "is_fault")


# --------------------------------------------------------------------------- model

MODEL_NAME = "fault_detection"


def _features(spark, d) -> DataFrame:
    frames = FR.frame_waveforms(TD.raw_samples(_events(spark, d)), C.FILENAME, "time_us",
                                ["event_id"], C.TEST_FRAME_LENGTH, label_col="is_fault",
                                bucket_us=TD.EVENT_BUCKET_US)
    return MD.waveform_features(frames)


def _split_features(spark, d) -> DataFrame:
    """Features with their split, written once: a fit reads its rows many times.

    The rank runs over keys and labels; feature arrays only meet it in a join.
    """
    features = _written(spark, d, _features(spark, d), "features")
    keys = FR.train_val_test_split(features.select(C.FILENAME, "frame"), [C.FILENAME, "frame"])
    both = features.join(keys.select(C.FILENAME, "frame", "split"), [C.FILENAME, "frame"])
    return _written(spark, d, both, "split-features")


def _scored_out(scored: DataFrame) -> DataFrame:
    return scored.select(C.FILENAME, "frame", "is_fault", "split",
                         F.round("fault_score", 6).alias("fault_score"))


@register("waveform_features")
def waveform_features(spark, d):
    return _features(spark, d).select(C.FILENAME, "frame", "is_fault", "features")


@register("train_classifier")
def train_classifier(spark, d):
    split = _split_features(spark, d)
    model = MD.fit(split.filter(F.col("split") == "train"), "is_fault", C.REFIT_EPOCHS)
    return _scored_out(MD.score(model, split.filter(F.col("split") == "test")))


@register("kernel_features")
def kernel_features(spark, d):
    """Steps of seeded convolution kernels over the frames."""
    rows = _features(spark, d)
    return rows.select(C.FILENAME, "frame", "is_fault", KN.kernel_features(F.col("signal")).alias("features"))


def _kernel_split(spark, d) -> DataFrame:
    """Split features with the kernels' behind them, written once."""
    both = _split_features(spark, d).withColumn("features", F.concat("features", KN.kernel_features(F.col("signal"))))
    return _written(spark, d, both, "kernel-features")


@register("kernel_classifier")
def kernel_classifier(spark, d):
    """The classifier over samples and kernel features; its scores of the test rows."""
    split = _kernel_split(spark, d)
    model = MD.fit(split.filter(F.col("split") == "train"), "is_fault", C.REFIT_EPOCHS)
    return _scored_out(MD.score(model, split.filter(F.col("split") == "test")))


@register("loss_curve")
def loss_curve(spark, d):
    """Train and validation loss over 64 epochs of one descent from zero."""
    curve, _, _ = KN.descend(_split_features(spark, d), "is_fault", "features", epochs=C.SELECTION_EPOCHS, rate=2.0,
                             scale=0.01)
    return curve.select("epoch", *[F.round(c, 6).alias(c) for c in ("train_loss", "val_loss")])


@register("model_selection")
def model_selection(spark, d):
    split = _split_features(spark, d)
    return MD.select_budget(split.filter(F.col("split") == "train"),
                            split.filter(F.col("split") == "val"), "is_fault")


def _refit(spark, d):
    split = _split_features(spark, d)
    model = MD.fit(FR.union_train_val(split), "is_fault", C.REFIT_EPOCHS)
    return model, split.filter(F.col("split") == "test")


@register("refit_classifier")
def refit_classifier(spark, d):
    model, test = _refit(spark, d)
    return _scored_out(MD.score(model, test))


@register("eval_metrics")
def eval_metrics(spark, d):
    model, test = _refit(spark, d)
    return MD.evaluation(MD.score(model, test), "is_fault")


@register("model_metrics")
def model_metrics(spark, d):
    """Refit, evaluate on test, save as the Production version of a registry of
    its own, return that registry's versions without the run's folder."""
    root = f"{ST.staging_path(spark, 'registry', d)}/run-{uuid.uuid4().hex[:10]}"
    _train_and_save(spark, d, root)
    return MD.model_versions(spark, root, MODEL_NAME).drop("path")


def _train_and_save(spark, d, root: str) -> None:
    model, test = _refit(spark, d)
    m = MD.evaluation(MD.score(model, test), "is_fault").first().asDict()
    MD.save_model(model, root, MODEL_NAME, m, spark)


def production_model(spark, d):
    """The Production model for these events; trained where there is none yet."""
    root = ST.staged(spark, "models", d, ("events",))
    if not path_exists(spark, f"{root}/{MODEL_NAME}/log"):
        _train_and_save(spark, d, root)
    return MD.production_model(spark, root, MODEL_NAME)


@register("score_waveforms")
def score_waveforms(spark, d):
    """Gold scoring: gather each recording into waveforms, score with the
    Production model; a waveform of the wrong length scores null."""
    model = production_model(spark, d)
    g = SH.gather_waveform(TD.raw_samples(_events(spark, d)), "time_us", C.TIMESTAMP,
                           tiebreak=["event_id"], frame_len=C.TEST_FRAME_LENGTH,
                           bucket_us=TD.EVENT_BUCKET_US)
    feats = g.withColumn("features", F.when(F.col("length_ok"), MD.flat_features(
        SH.waveform_matrix(g))))
    scored = MD.score(model, feats)
    return scored.select(C.FILENAME, "frame", "n_samples", "length_ok",
                         F.round("fault_score", 6).alias("fault_score"))


# --------------------------------------------------------------------------- streaming


def _stream_run(spark, d, upto: str, model=None, frame_len: int = C.TEST_FRAME_LENGTH,
                max_files: int | None = 1000, pairing: str = "index") -> PL.PipelineRun:
    """A fresh pipeline instance over the staged files, run up to ``upto``."""
    root = f"{ST.staging_path(spark, 'stream', d)}/run-{uuid.uuid4().hex[:10]}"
    run = PL.PipelineRun(spark, ST.recording_files(spark, d), root, model=model,
                         frame_len=frame_len, max_files_per_trigger=max_files, pairing=pairing,
                         table_prefix=f"run_{uuid.uuid4().hex[:10]}_")
    order = list(PL.ORDER)
    wanted = order[: order.index(upto) + 1]
    if upto in (PL.METADATA_SILVER, PL.FLATTENED_SILVER, PL.PIVOTED_CURRENT_SILVER,
                PL.FAULT_DETECTION_GOLD):
        wanted = order[:4] + [upto]
    return run.run(wanted)


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


@register("stream_scan_cfg")
def stream_scan_cfg(spark, d):
    run = _stream_run(spark, d, PL.CONFIG_FILES_BRONZE)
    return run.read(PL.CONFIG_FILES_BRONZE).select(*_folder_and_name(), C.CONFIG_CONTENT)


@register("stream_scan_marked")
def stream_scan_marked(spark, d):
    """Headers of two days, a run after each: the second run lists the second day only."""
    root = f"{ST.staging_path(spark, 'stream', d)}/run-{uuid.uuid4().hex[:10]}"
    pairs = EN.encode_ascii(_captures(spark, d)).withColumn(C.DAT_CONTENT, F.lit(None).cast("binary"))
    odd = F.regexp_extract(C.FILENAME, r"^u(\d+)_", 1).cast("bigint") % 2 == 1
    for day, files in (("2024-01-01", pairs.filter(~odd)), ("2024-01-02", pairs.filter(odd))):
        FS.write_pairs(files, f"{root}/landing", day)
        q = (LS.scan_cfg_marked(spark, f"{root}/landing").writeStream.format("parquet").trigger(availableNow=True)
             .option("checkpointLocation", f"{root}/checkpoint").start(f"{root}/table"))
        q.awaitTermination()
    table = spark.read.schema(f"{C.FILENAME} string, {C.CONFIG_CONTENT} string").parquet(f"{root}/table")
    return table.select(*_folder_and_name(), C.CONFIG_CONTENT)


@register("stream_scan_dat")
def stream_scan_dat(spark, d):
    order = [PL.DAT_FILES_BRONZE]
    root = f"{ST.staging_path(spark, 'stream', d)}/run-{uuid.uuid4().hex[:10]}"
    run = PL.PipelineRun(spark, ST.recording_files(spark, d), root, max_files_per_trigger=1000,
                         register_tables=False)
    run.run(order)
    return run.read(PL.DAT_FILES_BRONZE).select(*_folder_and_name(),
                                                F.length(C.DAT_CONTENT).alias("n_bytes"))


@register("stream_interval_join")
def stream_interval_join(spark, d):
    run = _stream_run(spark, d, PL.JOINED_FILES_BRONZE, pairing="state")
    return run.read(PL.JOINED_FILES_BRONZE).select(
        *_folder_and_name(), C.CONFIG_CONTENT, F.length(C.DAT_CONTENT).alias("n_bytes"))


@register("stream_decode")
def stream_decode(spark, d):
    run = _stream_run(spark, d, PL.RECORDINGS_SILVER)
    rec = _rounded(run.read(PL.RECORDINGS_SILVER))
    return rec.select(*_folder_and_name(), *DE.OUTPUT_ORDER)


@register("stream_metadata")
def stream_metadata(spark, d):
    run = _stream_run(spark, d, PL.METADATA_SILVER)
    return run.read(PL.METADATA_SILVER).select(*_folder_and_name(), *C.METADATA_COLUMNS)


@register("stream_flatten")
def stream_flatten(spark, d):
    run = _stream_run(spark, d, PL.FLATTENED_SILVER)
    flat = _ntz(run.read(PL.FLATTENED_SILVER), C.TIMESTAMP)
    return flat.select(*_folder_and_name(), C.TIMESTAMP, "sample_index", "channel_index",
                       C.ANALOG_CHANNEL_NAMES, F.round(C.ANALOG, 6).alias(C.ANALOG))


@register("stream_pivot")
def stream_pivot(spark, d):
    run = _stream_run(spark, d, PL.PIVOTED_CURRENT_SILVER)
    piv = _ntz(run.read(PL.PIVOTED_CURRENT_SILVER), C.TIMESTAMP)
    return piv.select(*_folder_and_name(), C.TIMESTAMP,
                      *[F.round(p, 6).alias(p) for p in C.PHASE_CHANNELS])


def _run_extra(run: PL.PipelineRun, name: str, df: DataFrame) -> DataFrame:
    run.schemas[name] = df.schema
    q = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", run.checkpoint(name)).trigger(availableNow=True)
         .start(run.path(name)))
    q.awaitTermination()
    return run.read(name)


@register("stream_gather")
def stream_gather(spark, d):
    run = _stream_run(spark, d, PL.RECORDINGS_SILVER)
    wf = _run_extra(run, "waveforms_silver",
                    PL.waveforms(run.read_stream(PL.RECORDINGS_SILVER), C.TEST_FRAME_LENGTH))
    return wf.select(*_folder_and_name(), "frame", "n_samples", "length_ok",
                     AR.round_nested(F.col("timestep_array")).alias("waveform"))


@register("stream_score")
def stream_score(spark, d):
    run = _stream_run(spark, d, PL.FAULT_DETECTION_GOLD, model=production_model(spark, d))
    g = run.read(PL.FAULT_DETECTION_GOLD)
    return g.select(*_folder_and_name(), "frame", "length_ok",
                    F.round("fault_score", 6).alias("fault_score"))


@register("stream_pipeline")
def stream_pipeline(spark, d):
    """All eight tables, in order; one row per table with its row count."""
    run = _stream_run(spark, d, PL.FAULT_DETECTION_GOLD, model=production_model(spark, d))
    run.run([t for t in PL.ORDER if t not in run.progress])
    parts = [run.read(t).groupBy().agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(t).alias("table_name"), "n_rows") for t in PL.ORDER]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("stream_table_write")
def stream_table_write(spark, d):
    """All eight tables written by streams and registered with comment and quality."""
    run = _stream_run(spark, d, PL.FAULT_DETECTION_GOLD, model=production_model(spark, d))
    run.run([t for t in PL.ORDER if t not in run.progress])
    rows = []
    for t in run.progress:
        name = run.table_name(t)
        props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        comment = spark.catalog.getTable(name).description
        rows.append((t, comment, props.get("quality")))
    meta = spark.createDataFrame(rows, "table_name string, comment string, quality string")
    counts = [run.read(t).groupBy().agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(t).alias("table_name"), "n_rows") for t in run.progress]
    allc = counts[0]
    for c in counts[1:]:
        allc = allc.unionByName(c)
    return meta.join(allc, "table_name")


@register("stream_table_read")
def stream_table_read(spark, d):
    """A registered pipeline table read back as a stream (``readStream.table``)."""
    run = _stream_run(spark, d, PL.RECORDINGS_SILVER)
    s = spark.readStream.table(run.table_name(PL.RECORDINGS_SILVER)).select(
        C.FILENAME, F.size(C.MICROSECONDS).alias("n_samples"))
    out = _run_extra(run, "table_read", s)
    return out.select(*_folder_and_name(), "n_samples")


@register("stream_late")
def stream_late(spark, d):
    """Watermarked de-duplication over events arriving one day per micro-batch,
    with one day's file arriving last: that day's rows are behind the
    watermark and dropped (no side output), everything else passes once."""
    root = ST.events_by_day(spark, d)
    schema = TD.table(spark, d, "events").schema
    s = (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
         .option("maxFilesPerTrigger", "1").parquet(root)
         .withColumn("event_time", F.col("ts").cast("timestamp"))
         .withWatermark("event_time", "1 hour")
         .dropDuplicatesWithinWatermark(["event_id"]))
    out = f"{ST.staging_path(spark, 'late', d)}/run-{uuid.uuid4().hex[:10]}"
    q = (s.writeStream.format("parquet").option("checkpointLocation", out + "/_checkpoint")
         .trigger(availableNow=True).start(out + "/table"))
    q.awaitTermination()
    LATE_PROGRESS[d] = list(q.recentProgress)
    return spark.read.parquet(out + "/table").select("event_id", "user_id", "ts")


@register("decode_ascii_lines")
def decode_ascii_lines(spark, d):
    """ASCII bodies read as splittable text, decoded line by line to phase rows."""
    root = ST.recording_files(spark, d)
    headers = DE.line_headers(FS.scan_cfg(spark, f"{root}/{ST.ASCII_FOLDER}"))
    lines = FS.scan_dat_lines(spark, f"{root}/{ST.ASCII_FOLDER}")
    out = DE.decode_ascii_lines(lines, headers)
    return out.select(*_folder_and_name(), "sample_number",
                      F.timestamp_micros("time_us").cast("timestamp_ntz").alias(C.TIMESTAMP),
                      *[F.round(p, 6).alias(p) for p in C.PHASE_CHANNELS])


@register("score_plugin")
def score_plugin(spark, d):
    """D4: the waveforms of ``score_waveforms`` scored through the plug-in
    pandas UDF (the Production model exported to numpy, loaded once per
    worker); waveforms of the wrong shape score null."""
    model = production_model(spark, d)
    g = SH.gather_waveform(TD.raw_samples(_events(spark, d)), "time_us", C.TIMESTAMP,
                           tiebreak=["event_id"], frame_len=C.TEST_FRAME_LENGTH,
                           bucket_us=TD.EVENT_BUCKET_US)
    scorer = MD.external_scorer(MD.numpy_logistic(model),
                                shape=(C.TEST_FRAME_LENGTH, len(C.PHASE_CHANNELS)))
    return g.select(C.FILENAME, "frame", "n_samples", "length_ok",
                    F.round(scorer(SH.waveform_matrix(g)), 6).alias("fault_score"))


# --------------------------------------------------------------------------- header dialects
_TIME_LINE = r"(\d\d)/(\d\d)/(\d{4}),(\d\d:\d\d:\d\d)\.(\d{6})"


def dialect(text, body, which):
    """One spelling of header and body that the format allows, by number.

    0 as written; 1 nine-digit fractions; 2 blank frequency line; 3 two-digit
    year; 4 a body that ends in an end-of-file byte; 5 lines that end in CR LF.
    """
    header = (F.when(which == 1, F.regexp_replace(text, _TIME_LINE + "\n", "$1/$2/$3,$4.$5" + "000\n"))
              .when(which == 2, F.regexp_replace(text, r"\n(50|60)\.0\n", "\n\n"))
              .when(which == 3, F.regexp_replace(text, r"(\d\d)/(\d\d)/\d\d(\d\d),", "$1/$2/$3,"))
              .when(which == 5, F.replace(text, F.lit("\n"), F.lit("\r\n"))).otherwise(text))
    chars = body.cast("string")
    content = (F.when(which == 4, F.concat(chars, F.lit("\x1a")))
               .when(which == 5, F.replace(chars, F.lit("\n"), F.lit("\r\n"))).otherwise(chars))
    return header, content.cast("binary")


@register("decode_dialects")
def decode_dialects(spark, d):
    """Captures encoded as ASCII, respelt in six dialects, decoded: same samples."""
    pairs = EN.encode_ascii(_captures(spark, d))
    which = F.pmod(F.conv(F.substring(F.md5(C.FILENAME), 1, 8), 16, 10).cast("bigint"), F.lit(6))
    header, content = dialect(F.col(C.CONFIG_CONTENT), F.col(C.DAT_CONTENT), which)
    respelt = pairs.select(C.FILENAME, header.alias(C.CONFIG_CONTENT), content.alias(C.DAT_CONTENT))
    return _rounded(DE.decode_ascii(DE.with_header(respelt)))


@register("header_problems")
def header_problems(spark, d):
    """Of nine captures eight get a header with something unreadable in it; all are reported."""
    pairs = EN.encode_ascii(_captures(spark, d))
    which = F.pmod(F.conv(F.substring(F.md5(C.FILENAME), 1, 8), 16, 10).cast("bigint"), F.lit(9))
    text = F.col(C.CONFIG_CONTENT)
    broken = (F.when(which == 1, F.replace(text, F.lit("\nASCII\n"), F.lit("\nbinary64\n")))
              .when(which == 2, F.regexp_replace(text, r"\d\d/\d\d/\d{4},", "99/99/2024,"))
              .when(which == 3, F.regexp_replace(text, r"\n\d+,\d+A,\d+D\n", "\nx,yA,zD\n"))
              .when(which == 4, F.regexp_replace(text, r"\n(2,IB,[^,]*,[^,]*,[^,]*),[^,]*,", "\n$1,bad,"))
              .when(which == 5, F.regexp_replace(text, r"\nASCII\n[^\n]*", "\nASCII\nzz"))
              .when(which == 6, F.regexp_replace(text, r"\n(50|60)\.0\n[^\n]*\n", "\n$1.0\nmany\n"))
              .when(which == 7, F.regexp_replace(text, r"\n(50|60)\.0\n", "\nmains\n"))
              # Absent is no problem: the multiplier has a default.
              .when(which == 8, F.regexp_replace(text, r"\nASCII\n[^\n]*", "\nASCII\n")).otherwise(text))
    return DE.header_problems(pairs.select(C.FILENAME, broken.alias(C.CONFIG_CONTENT)))


# --------------------------------------------------------------------------- raw text to pairs
def raw_recordings(spark, d) -> DataFrame:
    """Raw text rows gathered to decoded recordings, one per run of samples.

    Order within a recording comes from the bounded index, so no task holds a
    recording of any length; the station is the recording's own stem.
    """
    raw = FS.scan_raw_csv(spark, ST.raw_text_files(spark, d), pattern="error")
    rows = raw.select(
        F.concat(F.regexp_extract("path", r"kind=([^/.]+)", 1), F.lit("_"),
                 F.regexp_extract("path", r"recording=([^/]+)/", 1)).alias("stem"),
        F.round(F.col("time") * F.lit(1e6)).cast("bigint").alias("time_us"),
        F.array(*C.PHASE_CHANNELS).alias("values"))
    return SH.gather_recordings(rows, "stem", "time_us", "values", C.WAVEFORM_LENGTH, TD.EVENT_BUCKET_US)


@register("convert_raw_text")
def convert_raw_text(spark, d):
    """Raw text files -> header and body pairs -> decoded again."""
    pairs = EN.encode_ascii(raw_recordings(spark, d))
    return _rounded(DE.decode_ascii(DE.with_header(pairs))).select(
        C.FILENAME, C.STATION_NAME, C.ANALOG_CHANNEL_NAMES, C.ANALOG, C.MICROSECONDS)


# --------------------------------------------------------------------------- JSON of a recording
@register("json_roundtrip")
def json_roundtrip(spark, d):
    """Decoded recordings rendered as JSON and parsed under the fixed schema."""
    cap = _captures(spark, d)
    text = JS.render_json(F.struct(*DE.OUTPUT_ORDER))
    back = cap.select(C.FILENAME, JS.parse_json(text, DECODED_RECORDING).alias("r"))
    return back.select(C.FILENAME, *[F.col(f"r.{c}").alias(c) for c in DE.OUTPUT_ORDER])


# --------------------------------------------------------------------------- backfill
@register("stream_join_backfill")
def stream_join_backfill(spark, d):
    """Pairs of two runs, the second over files dated a day before the first's."""
    new, old = ST.backfill_files(spark, d)
    root = f"{ST.staging_path(spark, 'stream', d)}/run-{uuid.uuid4().hex[:10]}"
    order = [PL.CONFIG_FILES_BRONZE, PL.DAT_FILES_BRONZE, PL.JOINED_FILES_BRONZE]
    run = PL.PipelineRun(spark, new, root, max_files_per_trigger=1000, register_tables=False)
    run.run(order)
    run.source = old
    run.run(order)
    return run.read(PL.JOINED_FILES_BRONZE).select(
        *_folder_and_name(), C.CONFIG_CONTENT, F.length(C.DAT_CONTENT).alias("n_bytes"))


@register("stream_pair_pending")
def stream_pair_pending(spark, d):
    """Three deliveries, a run each: headers whose bodies come later, and bodies
    whose headers come last, are paired by the run that completes them."""
    root = f"{ST.staging_path(spark, 'stream', d)}/run-{uuid.uuid4().hex[:10]}"
    run = PL.PipelineRun(spark, f"{root}/landing", root, register_tables=False, tolerance="1 hour",
                         part_format="yyyyMMddHHmmssSSS")
    for files in ST.deliveries(spark, d):
        FS.write_pairs(files, run.source)
        run.run([PL.CONFIG_FILES_BRONZE, PL.DAT_FILES_BRONZE, PL.JOINED_FILES_BRONZE])
    return run.read(PL.JOINED_FILES_BRONZE).select(
        F.regexp_extract(C.FILENAME, r"([^/]+)$", 1).alias(C.FILENAME), F.col("batch").alias("paired_in_run"),
        C.CONFIG_CONTENT, F.length(C.DAT_CONTENT).alias("n_bytes"))


# --------------------------------------------------------------------------- a fixed model
def fixed_weights(n: int) -> list[float]:
    """Documented weights of the scorer that SQL can restate: -0.02 .. 0.02, repeating."""
    return [(i % 5 - 2) / 100 for i in range(n)]


def _fixed_scores(spark, d) -> DataFrame:
    frames = FR.frame_waveforms(TD.raw_samples(_events(spark, d)), C.FILENAME, "time_us", ["event_id"],
                                C.TEST_FRAME_LENGTH, label_col="is_fault", bucket_us=TD.EVENT_BUCKET_US)
    shape = (C.TEST_FRAME_LENGTH, len(C.PHASE_CHANNELS))
    scorer = MD.external_scorer(MD.numpy_linear(fixed_weights(shape[0] * shape[1])), shape=shape)
    return frames.select(C.FILENAME, "frame", "is_fault", scorer(F.col("signal")).alias("fault_score"))


@register("score_fixed")
def score_fixed(spark, d):
    """The plug-in scorer with the fixed weights."""
    return _fixed_scores(spark, d).withColumn("fault_score", F.round("fault_score", 6))


@register("stream_gold_recordings")
def stream_gold_recordings(spark, d):
    """One gold row for each recording file: the highest fixed score of its frames."""
    run = _stream_run(spark, d, PL.RECORDINGS_SILVER)
    shape = (C.TEST_FRAME_LENGTH, len(C.PHASE_CHANNELS))
    score_of = MD.tensor_scorer(MD.broadcast_linear(spark, fixed_weights(shape[0] * shape[1])), shape)
    gold = run.score_recordings("gold_recordings", lambda frames: frames.withColumn(
        "fault_score", score_of(F.col("timestep_array"))))
    return gold.select(*_folder_and_name(), "frames", "scored_frames", F.round("fault_score", 6).alias("fault_score"))


@register("score_tensor")
def score_tensor(spark, d):
    """The same scores through ``predict_batch_udf`` and a broadcast model."""
    frames = FR.frame_waveforms(TD.raw_samples(_events(spark, d)), C.FILENAME, "time_us", ["event_id"],
                                C.TEST_FRAME_LENGTH, label_col="is_fault", bucket_us=TD.EVENT_BUCKET_US)
    shape = (C.TEST_FRAME_LENGTH, len(C.PHASE_CHANNELS))
    score_of = MD.tensor_scorer(MD.broadcast_linear(spark, fixed_weights(shape[0] * shape[1])), shape)
    return frames.select(C.FILENAME, "frame", "is_fault", F.round(score_of(F.col("signal")), 6).alias("fault_score"))


@register("model_transitions")
def model_transitions(spark, d):
    """Two versions, of which the second goes to Production after the first: one is archived."""
    root = f"{ST.staging_path(spark, 'registry', d)}/run-{uuid.uuid4().hex[:10]}"
    model, test = _refit(spark, d)
    n = test.count()
    for stage in ("Production", "Staging"):
        MD.save_model(model, root, MODEL_NAME, {"n": n}, spark, stage)
    MD.transition(spark, root, MODEL_NAME, 2, "Production")
    return MD.model_versions(spark, root, MODEL_NAME).select(
        "name", "version", "stage", F.get_json_object("metrics", "$.n").cast("bigint").alias("n_test"))


@register("eval_fixed")
def eval_fixed(spark, d):
    """Loss, precision and recall of the fixed scorer."""
    m = MD.evaluation(_fixed_scores(spark, d), "is_fault")
    return m.select(*[F.round(c, 6).alias(c) for c in ("loss", "precision", "recall")], "n")


@register("stream_ingest_clock")
def stream_ingest_clock(spark, d):
    """Every streamed recording carries the clock of its micro-batch."""
    run = _stream_run(spark, d, PL.RECORDINGS_SILVER)
    rec = run.read(PL.RECORDINGS_SILVER)
    return rec.select(*_folder_and_name(), F.col(C.PROCESSED_TIMESTAMP).isNotNull().alias("has_clock"))


# --------------------------------------------------------------------------- keyed streams
@register("stream_keyed_pivot")
def stream_keyed_pivot(spark, d):
    run = _stream_run(spark, d, PL.FLATTENED_SILVER)
    piv = _run_extra(run, "keyed_pivot", CP.pivot_when_complete(run.read_stream(PL.FLATTENED_SILVER)))
    return _ntz(piv, C.TIMESTAMP).select(*_folder_and_name(), C.TIMESTAMP,
                                         *[F.round(p, 6).alias(p) for p in C.PHASE_CHANNELS])


@register("stream_keyed_gather")
def stream_keyed_gather(spark, d):
    """Two tables, each a stream with a watermark of its own."""
    run = _stream_run(spark, d, PL.FLATTENED_SILVER)
    _run_extra(run, "keyed_pivot", CP.pivot_when_complete(run.read_stream(PL.FLATTENED_SILVER)))
    got = _run_extra(run, "keyed_gather", CP.gather_when_complete(run.read_stream("keyed_pivot")))
    return got.select(*_folder_and_name(), F.size("sample_times").alias("n_samples"),
                      AR.round_nested(F.col("waveform")).alias("waveform"))


# --------------------------------------------------------------------------- ranged BINARY bodies
@register("decode_binary_ranges")
def decode_binary_ranges(spark, d):
    """BINARY bodies read and decoded in ranges of a kilobyte, as phase rows."""
    root = f"{ST.recording_files(spark, d)}/{ST.BINARY_FOLDER}"
    configs = FS.scan_cfg(spark, root)
    ranges = FS.dat_ranges(spark, root, DE.record_bytes(configs), range_bytes=1024)
    decoded = DE.decode_binary_ranges(ranges, configs)
    rows = SH.phase_rows(decoded, C.MICROSECONDS, keep=(C.FILENAME, "first_record"))
    return rows.select(*_folder_and_name(), (F.col("first_record") + F.col("sample_index") + 1).alias("sample_number"),
                       F.timestamp_micros(C.MICROSECONDS).cast("timestamp_ntz").alias(C.TIMESTAMP),
                       *[F.round(p, 6).alias(p) for p in C.PHASE_CHANNELS])

"""The eight-table medallion pipeline on Structured Streaming.

    cfg files -> config_files_bronze --+
                                       +-> joined_files_bronze -> recordings_silver -+-> metadata_silver
    dat files -> dat_files_bronze -----+                                             +-> flattened_silver
                                                                                     +-> pivoted_current_silver
                                                                                     +-> fault_detection_gold

Each table is one streaming query with its own checkpoint, writing Parquet;
downstream queries read the upstream table as a stream.  ``run`` executes the
DAG in order with ``availableNow`` triggers (a bounded, restartable run: a
second run picks up only new files).

Choices against the reference's stream (see README):
* files are paired through a small index of their names and times (``arrivals``):
  old files pair as well as new ones, whenever the partner came, and a run reads
  the bodies it pairs and no others.  ``pairing="state"`` is the stream-stream
  join instead: watermarked on the times the files were ingested, with the
  modification times as a plain range predicate, so that its state is evicted;
  files ingested further apart than its wait stay unpaired and are listed;
* metadata, pivot and gold work row-locally on the decoded recording (one row
  per file), so a recording can never be split across micro-batches and no
  watermark holds results back; metadata de-duplicates re-delivered files
  within the watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridwave import constants as C
from gridwave.functions.arrays import pick_channels
from gridwave.functions.times import to_timestamps
from gridwave.operators import decode as DE
from gridwave.operators import model as MD
from gridwave.operators import shape as SH
from gridwave.operators.pairing import ARRIVAL_WAIT, INGEST_TIME, interval_join_stream, unpaired_files
from gridwave.session import bounded_listing
from gridwave.sources import files as FS
from gridwave.sources.listing import listed_by_tasks
from gridwave.streaming import arrivals as AV
from gridwave.streaming import intake as IN
from gridwave.streaming.commits import BATCH, commit_batch
from gridwave.streaming.complete import N_CHANNELS, N_SAMPLES

CONFIG_FILES_BRONZE = "config_files_bronze"
DAT_FILES_BRONZE = "dat_files_bronze"
JOINED_FILES_BRONZE = "joined_files_bronze"
RECORDINGS_SILVER = "recordings_silver"
METADATA_SILVER = "metadata_silver"
FLATTENED_SILVER = "flattened_silver"
PIVOTED_CURRENT_SILVER = "pivoted_current_silver"
FAULT_DETECTION_GOLD = "fault_detection_gold"

ORDER = (CONFIG_FILES_BRONZE, DAT_FILES_BRONZE, JOINED_FILES_BRONZE, RECORDINGS_SILVER,
         METADATA_SILVER, FLATTENED_SILVER, PIVOTED_CURRENT_SILVER, FAULT_DETECTION_GOLD)

# Dependency levels of the DAG: a table only reads tables of earlier levels.
LEVELS = ((CONFIG_FILES_BRONZE, DAT_FILES_BRONZE), (JOINED_FILES_BRONZE,), (RECORDINGS_SILVER,),
          (METADATA_SILVER, FLATTENED_SILVER, PIVOTED_CURRENT_SILVER, FAULT_DETECTION_GOLD))

COMMENTS = {
    CONFIG_FILES_BRONZE: ("One row per header file, with its text", "bronze"),
    DAT_FILES_BRONZE: ("One row per body file, with its bytes", "bronze"),
    JOINED_FILES_BRONZE: ("Header and body of each recording", "bronze"),
    RECORDINGS_SILVER: ("One row per recording, samples as arrays", "silver"),
    METADATA_SILVER: ("Station, device and line frequency by recording", "silver"),
    FLATTENED_SILVER: ("One row per sample and channel", "silver"),
    PIVOTED_CURRENT_SILVER: ("One row per sample, a column per phase", "silver"),
    FAULT_DETECTION_GOLD: ("Fault probability of each waveform", "gold"),
}


# Part of the bronze tables by the time a file was ingested.
PART_FORMAT = "yyyyMMddHH"


# --------------------------------------------------------------------------- stages
def _ingested(files: DataFrame, part_format: str) -> DataFrame:
    """With the clock of the micro-batch and the part of the table it falls in."""
    now = F.current_timestamp()
    return files.withColumn(INGEST_TIME, now).withColumn(AV.PART, F.date_format(now, part_format))


def bronze_cfg(files: DataFrame, part_format: str = PART_FORMAT) -> DataFrame:
    """Header files (path, modificationTime, content) as rows of the bronze table."""
    return _ingested(FS.cfg_rows(files), part_format)


def bronze_dat(files: DataFrame, part_format: str = PART_FORMAT) -> DataFrame:
    """Body files (path, modificationTime, content) as rows of the bronze table."""
    return _ingested(FS.dat_rows(files), part_format)


def with_file_type(pairs: DataFrame) -> DataFrame:
    """Tagged with the file type that the header names."""
    file_type = F.upper(F.trim(F.regexp_extract(F.col(C.CONFIG_CONTENT),
                                                r"(?im)^\s*(ASCII|BINARY32|BINARY|FLOAT32)\s*$", 1)))
    return pairs.withColumn("file_type", file_type)


def joined(cfg: DataFrame, dat: DataFrame, tolerance: str = C.PAIR_TOLERANCE, wait: str = ARRIVAL_WAIT) -> DataFrame:
    """Pairs within the arrival tolerance that were ingested at most ``wait`` apart."""
    return with_file_type(interval_join_stream(cfg, dat, tolerance, wait))


def recordings(pairs: DataFrame) -> DataFrame:
    """Decode (cfg decides ASCII/BINARY), add sample timestamps and the ingest clock."""
    cols = [C.FILENAME, C.CONFIG_CONTENT, C.DAT_CONTENT]
    if "file_type" in pairs.columns:
        cols.append("file_type")
    decoded = DE.decode_recordings(pairs.select(*cols))
    return (decoded.withColumn(C.TIMESTAMP, to_timestamps(F.col(C.MICROSECONDS)))
            .withColumn(C.PROCESSED_TIMESTAMP, F.current_timestamp()))


def metadata(recs: DataFrame, watermark: str = C.METADATA_WATERMARK) -> DataFrame:
    """First metadata per recording; a file delivered twice within the
    watermark is kept once."""
    return (recs.select(C.FILENAME, C.PROCESSED_TIMESTAMP, *C.METADATA_COLUMNS)
            .withWatermark(C.PROCESSED_TIMESTAMP, watermark)
            .dropDuplicatesWithinWatermark([C.FILENAME]))


def flattened(recs: DataFrame) -> DataFrame:
    """One row per sample and channel, which also says how many there are of each."""
    sized = recs.withColumns({N_SAMPLES: F.size(C.ANALOG), N_CHANNELS: F.size(C.ANALOG_CHANNEL_NAMES)})
    return SH.flatten_long(sized, C.TIMESTAMP, keep=(C.FILENAME, C.PROCESSED_TIMESTAMP, N_SAMPLES, N_CHANNELS))


def pivoted(recs: DataFrame, channels: Sequence[str] = C.PHASE_CHANNELS) -> DataFrame:
    """Row-local pivot (A8): one row per sample with IA, IB, IC (missing -> null)."""
    rows = SH.phase_rows(recs, C.TIMESTAMP, channels, keep=(C.FILENAME, C.PROCESSED_TIMESTAMP))
    return rows.select(C.FILENAME, C.TIMESTAMP, *channels, C.PROCESSED_TIMESTAMP)


def waveforms(recs: DataFrame, frame_len: int = C.WAVEFORM_LENGTH,
              channels: Sequence[str] = C.PHASE_CHANNELS) -> DataFrame:
    """Per recording: samples ordered by time, cut into frames of ``frame_len``.

    Works inside the recording's row (no shuffle, no state); the last frame
    may be short (``length_ok`` false).
    """
    steps = F.array_sort(F.arrays_zip(
        F.col(C.TIMESTAMP).alias("t"),
        pick_channels(F.col(C.ANALOG), F.col(C.ANALOG_CHANNEL_NAMES), channels).alias("v")))
    with_steps = recs.select(C.FILENAME, C.PROCESSED_TIMESTAMP, steps.alias("_steps"))
    n = F.size("_steps")
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(n / F.lit(frame_len)).cast("int") - 1, F.lit(-1)))
    framed = with_steps.select(
        C.FILENAME, C.PROCESSED_TIMESTAMP,
        F.posexplode(F.transform(starts, lambda k: F.slice("_steps", k * frame_len + 1, frame_len)))
        .alias("frame", "_frame"))
    return framed.select(
        C.FILENAME, C.PROCESSED_TIMESTAMP, F.col("frame").cast("bigint").alias("frame"),
        F.size("_frame").alias("n_samples"),
        (F.size("_frame") == frame_len).alias("length_ok"),
        F.transform("_frame", lambda s: s["v"]).alias("timestep_array"))


def gold(recs: DataFrame, model: PipelineModel, frame_len: int = C.WAVEFORM_LENGTH) -> DataFrame:
    wf = waveforms(recs, frame_len)
    feats = wf.withColumn("features", F.when(F.col("length_ok"),
                                             MD.flat_features(F.col("timestep_array"))))
    scored = MD.score(model, feats)
    return scored.select(C.FILENAME, C.PROCESSED_TIMESTAMP, "frame", "length_ok", "fault_score")


def recording_scores(scored: DataFrame) -> DataFrame:
    """Scored frames -> a row for each recording: the highest score of its frames.

    Frames that are too short have no score; a recording without any scored
    frame keeps its row, with a null score.
    """
    return scored.groupBy(C.FILENAME, C.PROCESSED_TIMESTAMP).agg(
        F.count(F.lit(1)).alias("frames"), F.count("fault_score").alias("scored_frames"),
        F.max("fault_score").alias("fault_score"))


# --------------------------------------------------------------------------- running
@dataclass
class PipelineRun:
    """Where one pipeline instance keeps its tables and checkpoints."""
    spark: SparkSession
    source: str
    root: str
    model: PipelineModel | None = None
    frame_len: int = C.WAVEFORM_LENGTH
    max_files_per_trigger: int | None = None
    register_tables: bool = True
    table_prefix: str = ""
    wait: str = ARRIVAL_WAIT            # of the stream-stream join
    pairing: str = "index"              # or "state", the stream-stream join
    tolerance: str = C.PAIR_TOLERANCE
    part_format: str = PART_FORMAT
    progress: dict = field(default_factory=dict)
    schemas: dict = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.root}/tables/{table}"

    def checkpoint(self, table: str) -> str:
        return f"{self.root}/checkpoints/{table}"

    def table_name(self, table: str) -> str:
        """Catalog name of a table; a prefix (or ``database.``) keeps pipelines apart."""
        return f"{self.table_prefix}{table}"

    def unpaired(self) -> DataFrame:
        """Ingested files that are in no pair: the partner has not come yet, or
        was modified too long before or after."""
        try:
            pairs = self.read(JOINED_FILES_BRONZE)
        except AnalysisException:       # not run yet: there are no pairs to speak of
            pairs = None
        return unpaired_files(self.read(CONFIG_FILES_BRONZE), self.read(DAT_FILES_BRONZE), pairs=pairs)

    def read_stream(self, table: str) -> DataFrame:
        """An upstream table as a stream (schema from the table itself)."""
        schema = self.schemas.get(table) or self.spark.read.parquet(self.path(table)).schema
        return self.spark.readStream.schema(schema).parquet(self.path(table))

    def read(self, table: str) -> DataFrame:
        """Batch view of a table; its schema is known even when it has no rows."""
        schema = self.schemas.get(table)
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.parquet(self.path(table))

    def new_files(self, table: str, glob: str) -> DataFrame:
        """The source's files as a stream, each once, through a listing that this run brings up to date."""
        if not listed_by_tasks(self.spark, self.source):
            return FS.stream_files(self.spark, self.source, glob, self.max_files_per_trigger)
        listing = self.path(f"_{table}_listing")
        IN.list_new(self.spark, self.source, glob, listing, self.max_files_per_trigger)
        return IN.read_new(self.spark, listing, self.max_files_per_trigger)

    def build(self, table: str) -> DataFrame:
        if table == CONFIG_FILES_BRONZE:
            return bronze_cfg(self.new_files(table, C.CFG_GLOB), self.part_format)
        if table == DAT_FILES_BRONZE:
            return bronze_dat(self.new_files(table, C.DAT_GLOB), self.part_format)
        if table == JOINED_FILES_BRONZE:
            return joined(self.read_stream(CONFIG_FILES_BRONZE), self.read_stream(DAT_FILES_BRONZE),
                          self.tolerance, self.wait)
        if table == RECORDINGS_SILVER:
            return recordings(self.read_stream(JOINED_FILES_BRONZE))
        if table == METADATA_SILVER:
            return metadata(self.read_stream(RECORDINGS_SILVER))
        if table == FLATTENED_SILVER:
            return flattened(self.read_stream(RECORDINGS_SILVER))
        if table == PIVOTED_CURRENT_SILVER:
            return pivoted(self.read_stream(RECORDINGS_SILVER))
        if table == FAULT_DETECTION_GOLD:
            if self.model is None:
                raise ValueError("gold needs a model")
            return gold(self.read_stream(RECORDINGS_SILVER), self.model, self.frame_len)
        raise KeyError(table)

    def start_pairing(self):
        """The paired table through the index of arrivals, batch by batch."""
        cfg, dat = self.read(CONFIG_FILES_BRONZE), self.read(DAT_FILES_BRONZE)
        files = AV.index_rows(self.read_stream(CONFIG_FILES_BRONZE), "cfg") \
            .union(AV.index_rows(self.read_stream(DAT_FILES_BRONZE), "dat"))
        self.schemas[JOINED_FILES_BRONZE] = T.StructType([
            *[T.StructField(n, t) for n, t in (
                (C.FILENAME, T.StringType()), (C.CONFIG_CONTENT, T.StringType()), (C.DAT_CONTENT, T.BinaryType()),
                ("cfg_mod_time", T.TimestampType()), ("dat_mod_time", T.TimestampType()), (AV.BATCH, T.LongType()),
                ("file_type", T.StringType()))]])

        def step(new: DataFrame, batch_id: int) -> None:
            AV.pair_batch(new, batch_id, self.path("arrivals"), self.path(JOINED_FILES_BRONZE), cfg, dat,
                          self.tolerance, with_file_type)

        return (files.writeStream.foreachBatch(step).option("checkpointLocation", self.checkpoint(JOINED_FILES_BRONZE))
                .trigger(availableNow=True).start())

    def score_recordings(self, name: str, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Gold by recording, as table ``name``: ``score`` adds ``fault_score`` to frames.

        A recording is one row of its micro-batch, so its frames are scored and
        put together inside the batch, without state or watermark.
        """
        recs = self.read_stream(RECORDINGS_SILVER)

        def step(new: DataFrame, batch_id: int) -> None:
            commit_batch(recording_scores(score(waveforms(new, self.frame_len))), self.path(name), batch_id)

        q = (recs.writeStream.foreachBatch(step).option("checkpointLocation", self.checkpoint(name))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        types = {f.name: f.dataType for f in recs.schema}
        self.schemas[name] = T.StructType([
            T.StructField(C.FILENAME, T.StringType()), T.StructField(C.PROCESSED_TIMESTAMP, types[C.PROCESSED_TIMESTAMP]),
            T.StructField("frames", T.LongType()), T.StructField("scored_frames", T.LongType()),
            T.StructField("fault_score", T.DoubleType()), T.StructField(BATCH, T.LongType())])
        return self.read(name)

    def start_table(self, table: str):
        if table == JOINED_FILES_BRONZE and self.pairing == "index":
            return self.start_pairing()
        df = self.build(table)
        self.schemas[table] = df.schema
        writer = (df.writeStream.format("parquet").outputMode("append")
                  .option("checkpointLocation", self.checkpoint(table))
                  .trigger(availableNow=True))
        if table == JOINED_FILES_BRONZE:
            writer = writer.partitionBy("file_type")
        if table in (CONFIG_FILES_BRONZE, DAT_FILES_BRONZE):
            writer = writer.partitionBy(AV.PART)
        return writer.start(self.path(table))

    def _finish(self, table: str, q) -> None:
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        self.progress[table] = [p for p in q.recentProgress]
        if self.register_tables:
            register_table(self.spark, table, self.path(table), self.table_name(table))

    def run_table(self, table: str) -> dict:
        self._finish(table, self.start_table(table))
        return {"table": table, "batches": len(self.progress[table])}

    def run(self, tables: Sequence[str] = ORDER) -> "PipelineRun":
        """Run the tables level by level; tables of one level (same inputs,
        no dependency between them) run as concurrent streaming queries."""
        wanted = [t for t in tables if not (t == FAULT_DETECTION_GOLD and self.model is None)]
        with bounded_listing(self.spark):
            for level in LEVELS:
                batch = [t for t in level if t in wanted]
                started = [(t, self.start_table(t)) for t in batch]
                for t, q in started:
                    self._finish(t, q)
        return self


MADE_BY = "gridwave.table"


def register_table(spark: SparkSession, table: str, path: str, name: str | None = None) -> None:
    """Catalog entry over the table's folder with its comment and quality tag.

    Replaces an entry that this function made; any other table of the same
    name is left alone and raises.
    """
    name = name or table
    comment, quality = COMMENTS[table]
    if spark.catalog.tableExists(name):
        made = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        if made.get(MADE_BY) != table:
            raise ValueError(f"table {name} exists and was not made by this pipeline")
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}' "
              f"COMMENT '{comment}' TBLPROPERTIES ('quality' = '{quality}', '{MADE_BY}' = '{table}')")


def dropped_by_watermark(progress: Sequence) -> int:
    """Rows dropped as late by stateful operators over a query's progress."""
    total = 0
    for p in progress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else []:
            total += int(op.get("numRowsDroppedByWatermark", 0))
    return total


def keyed_pivot(flat: DataFrame, watermark: str = C.PIVOT_WATERMARK,
                channels: Sequence[str] = C.PHASE_CHANNELS) -> DataFrame:
    """The keyed alternative to :func:`pivoted` for long input (A3).

    Append-legal because the watermarked column is part of the key; results of
    the newest micro-batch wait until a later batch moves the watermark.
    """
    return (flat.withWatermark(C.PROCESSED_TIMESTAMP, watermark)
            .transform(lambda d: SH.pivot_conditional(
                d, [C.FILENAME, C.TIMESTAMP, C.PROCESSED_TIMESTAMP],
                ["sample_index", "channel_index"], channels)))


def keyed_gather(pivoted_stream: DataFrame, watermark: str | None = C.GOLD_WATERMARK,
                 channels: Sequence[str] = C.PHASE_CHANNELS) -> DataFrame:
    """The keyed alternative to :func:`waveforms` for a long phase stream (T5).

    ``groupBy(filename, processed_timestamp)`` with the watermark on
    processed_timestamp is append-legal and chains after :func:`keyed_pivot`;
    a group is one file's samples of one micro-batch, so it is bounded by the
    file, and results wait for the watermark to pass.
    """
    sample = F.struct(F.col(C.TIMESTAMP).alias("at"), F.array(*channels).alias("values"))
    # A second watermark behind another aggregate would judge that aggregate's
    # results by the clock of its input and drop them as late.
    if watermark:
        pivoted_stream = pivoted_stream.withWatermark(C.PROCESSED_TIMESTAMP, watermark)
    samples = pivoted_stream.groupBy(C.FILENAME, C.PROCESSED_TIMESTAMP) \
        .agg(F.sort_array(F.collect_list(sample)).alias("_samples"))
    return samples.select(C.FILENAME, C.PROCESSED_TIMESTAMP, F.col("_samples.at").alias("sample_times"),
                          F.col("_samples.values").alias("waveform"))

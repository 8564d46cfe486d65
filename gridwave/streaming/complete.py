"""Keyed pivot and gather of long streams whose results do not wait for the clock.

Every sample row says how many samples and channels its recording has.  A group
is written as soon as its rows are all there, which is mostly the micro-batch
they come in; then nothing is kept.  A group that lacks rows stays in state until
the watermark has passed its rows by the delay, and is written as it is.  So the
last batch needs no later one, and no row that is not a sample.

The pivot's groups are runs of ``CHUNK`` samples, so that a recording of any
length is many groups; a gathered waveform is one row, and so is its group.

Groups are small and there are many, and a call of Python costs as much as
hundreds of rows: Spark keys the rows by ``BUCKETS`` hashes of the group, and a
call handles all groups of its bucket together, in plain arrays.  Each group of a
bucket has a time of its own at which it is written as it is.  State written under
single groups cannot be read by these streams: they begin with a new checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gridwave import constants as C
from gridwave.operators.pairing import interval_us

CHUNK = 1024            # samples of a recording in one group of the pivot
BUCKETS = 1 << 12       # most calls of Python in a micro-batch; fixed by the checkpoint
N_SAMPLES, N_CHANNELS = "n_samples", "n_channels"


def _packed(rows: pd.DataFrame) -> bytes:
    table, sink = pa.Table.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas()


def _once(rows: pd.DataFrame, unique: Sequence[str]) -> pd.DataFrame:
    """Rows that differ in the whole numbers ``unique``, of equal ones the first."""
    keys = [rows[c].to_numpy() for c in unique]
    order = np.lexsort(keys[::-1])          # stable: equal rows keep their order
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    return rows if new.all() else rows.iloc[np.sort(order[new])].reset_index(drop=True)


def _when_complete(rows: DataFrame, keys: Sequence[str], unique: Sequence[str], expected: Callable, made: Callable,
                   schema: str, delay: str) -> DataFrame:
    """Groups of ``rows`` by ``keys``, turned by ``made`` once ``expected`` rows
    that differ in ``unique`` are there, or the watermark has passed them.

    A row delivered twice counts once, the first.  ``expected`` is given the first
    row of each group, ``made`` the rows of some groups and the number of each row's.
    """
    wait_ms, keys = interval_us(delay) // 1000, list(keys)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        parts = [_unpacked(state.get[0])] if state.exists else []
        n_held = len(parts[0]) if parts else 0
        due = parts[0].pop("_due").to_numpy() if parts else np.empty(0, np.int64)
        if not state.hasTimedOut:
            parts.extend(b.drop(columns="_bucket") for b in batches)
        held = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]
        held["_group"] = held.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
        n = int(held["_group"].max()) + 1
        touched, limit = np.zeros(n, bool), np.zeros(n, np.int64)
        touched[held["_group"].to_numpy()[n_held:]] = True
        limit[held["_group"].to_numpy()[:n_held]] = due
        held = _once(held, ["_group", *unique])
        group, now = held["_group"].to_numpy(), state.getCurrentWatermarkMs()
        firsts = held.iloc[np.unique(group, return_index=True)[1]]
        last = held.groupby("_group")[C.PROCESSED_TIMESTAMP].max().to_numpy().astype("datetime64[ms]").astype(np.int64)
        limit = np.where(touched, np.maximum(last, now) + wait_ms + 1, limit)
        out = (np.bincount(group, minlength=n) >= np.asarray(expected(firsts), float)) | (limit < now)
        if not out.all():
            kept = held[~out[group]].drop(columns="_group")
            state.update((_packed(kept.assign(_due=limit[group[~out[group]]])),))
            state.setTimeoutTimestamp(max(int(limit[~out].min()), now + 1))
        elif state.exists:
            state.remove()
        if out.any():
            ready = held[out[group]].reset_index(drop=True)
            yield made(ready, ready.pop("_group").to_numpy())

    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    return rows.withColumn("_bucket", bucket).withWatermark(C.PROCESSED_TIMESTAMP, delay).groupBy("_bucket") \
        .applyInPandasWithState(step, schema, "rows binary", "append", GroupStateTimeout.EventTimeTimeout)


def pivot_when_complete(flat: DataFrame, watermark: str = C.PIVOT_WATERMARK,
                        channels: Sequence[str] = C.PHASE_CHANNELS) -> DataFrame:
    """Long samples (A3) -> one row per sample with a column per channel; a channel
    that a recording lacks is null, of one that it has twice the first counts."""
    names = list(channels)

    def made(rows: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
        order = np.lexsort((rows["channel_index"].to_numpy(), rows["sample_index"].to_numpy(), group))
        at, channel = rows["sample_index"].to_numpy()[order], rows[C.ANALOG_CHANNEL_NAMES].to_numpy()[order]
        value = rows[C.ANALOG].to_numpy(float)[order]
        new = np.ones(len(order), bool)
        new[1:] = (at[1:] != at[:-1]) | (group[order][1:] != group[order][:-1])
        first, place = np.flatnonzero(new), np.cumsum(new) - 1
        samples = at[first]
        wide, there = {}, np.zeros(len(samples), bool)
        for name in names:
            mine = np.flatnonzero(channel == name)
            # Of a channel that a sample has twice the first counts.
            sample, k = np.unique(place[mine], return_index=True)
            wide[name] = np.full(len(samples), np.nan)
            wide[name][sample] = value[mine[k]]
            there[sample] = True
        out = {c: rows[c].to_numpy()[order[first[there]]] for c in (C.FILENAME, C.TIMESTAMP, C.PROCESSED_TIMESTAMP, N_SAMPLES)}
        return pd.DataFrame({**out, **{n: wide[n][there] for n in names}, "sample_index": samples[there]})[columns]

    columns = [C.FILENAME, C.TIMESTAMP, *names, C.PROCESSED_TIMESTAMP, "sample_index", N_SAMPLES]
    schema = (f"{C.FILENAME} string, {C.TIMESTAMP} timestamp, {', '.join(f'{n} double' for n in names)}, "
              f"{C.PROCESSED_TIMESTAMP} timestamp, sample_index int, {N_SAMPLES} int")
    rows = flat.select(C.FILENAME, C.TIMESTAMP, C.PROCESSED_TIMESTAMP, "sample_index", "channel_index",
                       C.ANALOG_CHANNEL_NAMES, C.ANALOG, N_SAMPLES, N_CHANNELS,
                       F.floor(F.col("sample_index") / CHUNK).alias("_chunk"))

    def expected(first: pd.DataFrame) -> pd.Series:
        return np.minimum(CHUNK, first[N_SAMPLES] - first["_chunk"] * CHUNK) * first[N_CHANNELS]

    return _when_complete(rows, [C.FILENAME, C.PROCESSED_TIMESTAMP, "_chunk"], ["sample_index", "channel_index"],
                          expected, made, schema, watermark)


def gather_when_complete(pivoted: DataFrame, watermark: str = C.GOLD_WATERMARK,
                         channels: Sequence[str] = C.PHASE_CHANNELS) -> DataFrame:
    """Phase rows (T5) -> one row per recording: sample times in order, and the waveform."""
    names = list(channels)

    def made(rows: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
        # By time, then by the values, of which a missing one comes first.
        time, table = rows[C.TIMESTAMP].to_numpy(), rows[names].to_numpy(float)
        missing = np.isnan(table)
        keys = [k for j in reversed(range(len(names))) for k in (np.where(missing[:, j], 0, table[:, j]), ~missing[:, j])]
        order = np.lexsort((*keys, time.view("int64"), group))  # a missing time is the least whole number
        cells = table[order].astype(object)
        cells[missing[order]] = None
        values, times = cells.tolist(), rows[C.TIMESTAMP].iloc[order].tolist()
        start = np.unique(group[order], return_index=True)[1]
        spans = list(zip(start.tolist(), [*start[1:].tolist(), len(order)]))
        return pd.DataFrame({C.FILENAME: rows[C.FILENAME].to_numpy()[order[start]],
                             C.PROCESSED_TIMESTAMP: rows[C.PROCESSED_TIMESTAMP].to_numpy()[order[start]],
                             "sample_times": [times[a:b] for a, b in spans],
                             "waveform": [values[a:b] for a, b in spans]})

    schema = (f"{C.FILENAME} string, {C.PROCESSED_TIMESTAMP} timestamp, sample_times array<timestamp>, "
              "waveform array<array<double>>")
    rows = pivoted.select(C.FILENAME, C.TIMESTAMP, *names, C.PROCESSED_TIMESTAMP, "sample_index", N_SAMPLES)
    return _when_complete(rows, [C.FILENAME, C.PROCESSED_TIMESTAMP], ["sample_index"], lambda first: first[N_SAMPLES],
                          made, schema, watermark)

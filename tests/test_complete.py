"""Keyed pivot and gather: written when complete, kept while rows lack, flushed by the watermark."""

import datetime as dt

import pytest

from gridwave import constants as C
from gridwave.session import ship_package
from gridwave.streaming import complete as CP

T0 = dt.datetime(2024, 1, 1)
LONG = (f"{C.FILENAME} string, {C.PROCESSED_TIMESTAMP} timestamp, {C.TIMESTAMP} timestamp, sample_index int, "
        f"channel_index int, {C.ANALOG_CHANNEL_NAMES} string, {C.ANALOG} double, n_samples int, n_channels int")
CHANNELS = ["IC", "IA", "VA", "IA"]     # in another order, without IB, IA twice


def rows_of(name, n, clock=0):
    """All long rows of a recording of ``n`` samples, ingested ``clock`` seconds on."""
    return [(name, T0 + dt.timedelta(seconds=clock), T0 + dt.timedelta(milliseconds=k), k, c, ch, k + c / 10, n,
             len(CHANNELS)) for k in range(n) for c, ch in enumerate(CHANNELS)]


@pytest.fixture()
def feed(spark, tmp_path):
    ship_package(spark)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run(build, rows, schema=LONG):
        """A micro-batch of ``rows``; all that the query has written so far."""
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        df = build(spark.readStream.schema(schema).parquet(source))
        df.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")) \
            .trigger(availableNow=True).start(out).awaitTermination()
        return spark.read.schema(df.schema).parquet(out).collect()

    return run


def wide(rows):
    return sorted((r[C.FILENAME], r.sample_index, r.IA, r.IB, r.IC) for r in rows)


def expected(name, n):
    return [(name, k, k + 0.1, None, k + 0.0) for k in range(n)]


def test_pivot_writes_groups_as_they_get_complete(feed, monkeypatch):
    a, b, c = rows_of("a", 5), rows_of("b", 3), rows_of("c", 4)
    # The whole of b is written by the batch it comes in; nothing follows it.
    assert wide(feed(CP.pivot_when_complete, a[:7] + b)) == expected("b", 3)
    # A row that comes twice completes nothing.
    assert wide(feed(CP.pivot_when_complete, a[:7] + c[:-1])) == expected("b", 3)
    assert wide(feed(CP.pivot_when_complete, a[7:])) == expected("a", 5) + expected("b", 3)
    # c never gets its last row: recordings ingested later move the watermark past it.
    late = rows_of("d", 1, 3600)
    assert wide(feed(CP.pivot_when_complete, late)) == sorted(
        expected("a", 5) + expected("b", 3) + expected("c", 4) + expected("d", 1))


def test_a_long_recording_is_many_groups(feed, monkeypatch):
    n = CP.CHUNK + 10
    rows = rows_of("a", n)
    cut = CP.CHUNK * len(CHANNELS)
    assert wide(feed(CP.pivot_when_complete, rows[:cut + 5])) == expected("a", CP.CHUNK)
    assert wide(feed(CP.pivot_when_complete, rows[cut + 5:])) == expected("a", n)


def test_gather_writes_whole_waveforms(feed):
    schema = f"{C.FILENAME} string, {C.TIMESTAMP} timestamp, IA double, IB double, IC double, " \
        f"{C.PROCESSED_TIMESTAMP} timestamp, sample_index int, n_samples int"

    def phases(name, n, clock=0):
        at = T0 + dt.timedelta(seconds=clock)
        return [(name, T0 + dt.timedelta(milliseconds=n - k), float(k), None, 1.0, at, k, n) for k in range(n)]

    def found(rows):
        return {r[C.FILENAME]: ([t.microsecond // 1000 for t in r.sample_times], r.waveform) for r in rows}

    def whole(n):
        return list(range(1, n + 1)), [[float(k), None, 1.0] for k in range(n - 1, -1, -1)]

    assert found(feed(CP.gather_when_complete, phases("a", 4)[:3] + phases("b", 2), schema)) == {"b": whole(2)}
    assert found(feed(CP.gather_when_complete, phases("a", 4)[3:], schema)) == {"a": whole(4), "b": whole(2)}
    last = found(feed(CP.gather_when_complete, phases("c", 3)[:1] + phases("d", 1, 3600), schema))
    assert set(last) == {"a", "b", "c", "d"} and last["c"] == ([3], [[0.0, None, 1.0]])

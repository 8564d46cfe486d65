"""Keyed pivot and gather: many groups in one call of Python, each with its own end."""

import pytest
from pyspark.sql import functions as F

from gridwave import constants as C
from gridwave.session import ship_package
from gridwave.streaming import complete as CP

from test_complete import LONG, expected, rows_of


@pytest.fixture()
def feed(spark, tmp_path):
    ship_package(spark)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run(build, rows, schema):
        """A micro-batch of ``rows``; all that the query has written so far, and the rows of its state."""
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        df = build(spark.readStream.schema(schema).parquet(source))
        q = df.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")) \
            .trigger(availableNow=True).start(out)
        q.awaitTermination()
        return spark.read.schema(df.schema).parquet(out), q.lastProgress["stateOperators"][0]["numRowsTotal"]

    return run


@pytest.mark.parametrize("buckets", [1, 3])
def test_groups_of_a_bucket_are_written_each_in_its_time(feed, monkeypatch, buckets):
    monkeypatch.setattr(CP, "BUCKETS", buckets)
    names = [f"r{k:02}" for k in range(12)] + [None]
    size = {name: 2 + k % 3 for k, name in enumerate(names)}

    def seen(rows):
        got, held = feed(CP.pivot_when_complete, rows, LONG)
        # A name may be missing, which has no order.
        return sorted(map(repr, ((r[C.FILENAME], r.sample_index, r.IA, r.IB, r.IC) for r in got.collect()))), held

    def whole(chosen):
        return sorted(repr(r) for name in chosen for r in expected(name, size[name]))

    def all_but_last(name):
        rows = rows_of(name, size[name])
        return rows[:-1] + rows[:1]

    # Every second recording lacks its last row, and one of its rows comes twice.
    half, full = names[::2], names[1::2]
    got, held = seen([r for name in half for r in all_but_last(name)]
                     + [r for name in full for r in rows_of(name, size[name])])
    assert got == whole(full) and 0 < held <= buckets
    # Two of them get it, one waits on although rows of its bucket come and go.
    got, held = seen([rows_of(name, size[name])[-1] for name in ("r00", None)])
    assert got == whole([*full, "r00", None]) and 0 < held <= buckets
    # The watermark passes all of them: they are written as they are, and nothing is kept.
    size["late"] = 1
    got, held = seen(rows_of("late", 1, 3600))
    assert got == whole([*names, "late"]) and held == 0


def test_gathered_waveforms_of_a_bucket_stay_apart(feed, monkeypatch):
    monkeypatch.setattr(CP, "BUCKETS", 1)
    schema = f"{C.FILENAME} string, {C.TIMESTAMP} timestamp, IA double, IB double, IC double, " \
        f"{C.PROCESSED_TIMESTAMP} timestamp, sample_index int, n_samples int"

    def phases(name, n):
        at = [(r[2], r[1]) for r in rows_of(name, n)[::4]]
        return [(name, t, float(n), None, float(k), now, k, n) for k, (t, now) in enumerate(at)][::-1]

    rows = [r for n in range(1, 9) for r in phases(f"r{n}", n)]
    got, held = feed(CP.gather_when_complete, [r for r in rows if r[0] != "r5" or r[6]], schema)

    def found(df):
        return {r[C.FILENAME]: (r.waveform, [t.microsecond // 1000 for t in r.sample_times]) for r in df.collect()}

    want = {f"r{n}": ([[float(n), None, float(k)] for k in range(n)], list(range(n))) for n in range(1, 9)}
    assert found(got) == {k: v for k, v in want.items() if k != "r5"} and held == 1
    got, held = feed(CP.gather_when_complete, [r for r in rows if r[0] == "r5" and not r[6]], schema)
    assert found(got) == want and held == 0 and got.select(F.countDistinct(C.FILENAME)).first()[0] == 8

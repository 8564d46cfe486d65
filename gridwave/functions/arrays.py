"""Array helpers over decoded recordings (all built-in higher-order functions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridwave import constants as C


def pick_channels(rows: Column, names: Column,
                  wanted: Sequence[str] = C.PHASE_CHANNELS) -> Column:
    """Row-local pivot: for every per-time vector pick the named channels.

    ``rows`` is array<array<double>> (sample i, channel j); ``names`` labels j.
    A missing name gives null; a duplicated name gives its first position.
    """
    wanted_arr = F.array(*[F.lit(w) for w in wanted])
    positions = F.transform(wanted_arr, lambda w: F.array_position(names, w).cast("int") - 1)
    return F.transform(rows, lambda r: F.transform(positions, lambda p: F.get(r, p)))


def channel_major_to_time_major(channels: Column) -> Column:
    """[[c0 t0, c0 t1, ...], [c1 t0, ...]] -> [[c0 t0, c1 t0, ...], ...]."""
    n = F.size(F.element_at(channels, 1))
    return F.when(F.size(channels) > 0,
                  F.transform(F.sequence(F.lit(0), n - 1),
                              lambda i: F.transform(channels, lambda c: F.get(c, i)))
                  ).otherwise(F.array().cast("array<array<double>>"))


def channel_attribute(channels: Column, field: str) -> Column:
    """Project one attribute of every channel struct (units, ids, phases)."""
    return F.transform(channels, lambda c: c[field])


def round_nested(rows: Column, digits: int = 6) -> Column:
    return F.transform(rows, lambda r: F.transform(r, lambda v: F.round(v, digits)))

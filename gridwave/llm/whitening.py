"""Whitening of embeddings by an incremental eigendecomposition.

Entries become whole numbers x = floor(scale * c) + offset; the fit list is each
distinct x vector once.  Everything is centred before it is multiplied.

1. ``fixed_vectors``: x vectors as bytes, of the rows that have one;
2. ``fit``: the distinct vectors are written once.  Every partition reads its
   share block by block and keeps a spectrum, to which centred rank-one updates
   are applied (``spectra``); the partitions' spectra are combined in a tree,
   again by rank-one updates.  A last pass over all distinct vectors projects
   them on the vectors found and sums the projected covariance (Rayleigh-Ritz),
   whose eigenvectors turn them to double precision;
3. ``whiten``: every row is projected on the leading components.  The covariance
   of the fit list's whitened vectors is summed in a pass of its own for
   ``identity_error``.

What moves between tasks are spectra and matrices of dimension squared, at most
``FAN_IN`` to a task; the driver gets one of each.  A vector that fills a third of
all rows is one row after the map-side aggregation.

Rows whose vector is null, holds null or non-finite entries, or entries whose x
is beyond 2**52, are dropped; so are empty vectors and, where lengths differ,
vectors of any but the commonest length (of equally common ones the longest).
Rows may repeat: all are returned.  Components without variance (at most
rounding: the dimension times 2.2e-16 of the largest) are returned with a null
``whitened`` and ``explained`` 0.  A ``deviation`` beyond a long is null.  No
vectors give no rows.  Extra columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwave.llm import spectra
from gridwave.llm.common import type_of, written

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
BLOCK_ROWS = 2_048          # vectors in memory at a time
FAN_IN = 16                 # spectra or matrices that one task combines
BEYOND = 2.0 ** 52


@dataclass
class Whitening:
    """A fit: ``n`` distinct vectors with per-dimension ``sums``, eigenvalues
    (falling) and unit eigenvectors (columns) of their covariance."""
    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    offset: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean; the numerator n * x - sums is exact."""
        return (self.n * x - self.sums) / self.n

    def rank(self, components: int) -> int:
        """Components, of the first so many, that have variance."""
        floor = len(self.values) * spectra.EPS * self.values[0]
        return int((self.values[:components] > floor).sum())

    def project(self, x: np.ndarray, components: int) -> np.ndarray:
        k = self.rank(components)
        return self.centred(x) @ (self.vectors[:, :k] / np.sqrt(self.values[:k]))


# --- vectors as bytes -------------------------------------------------------------------

def _pack(u: np.ndarray) -> list[bytes]:
    """Whole numbers by row: a byte for the width that holds the row, then the row."""
    top = np.abs(u).max(1)
    out = [b""] * len(u)
    for width, most in ((2, 2 ** 15), (4, 2 ** 31), (8, 2 ** 63)):
        at = np.flatnonzero((top < most) & (top >= (0 if width == 2 else 2 ** (4 * width - 1))))
        made = u[at].astype(f"<i{width}")
        for k, i in enumerate(at.tolist()):
            out[i] = bytes([width]) + made[k].tobytes()
    return out


def _unpack(rows: list[bytes], offset: int) -> Iterator[np.ndarray]:
    """x vectors as blocks of rows of one width, in order."""
    at = 0
    while at < len(rows):
        to = at
        while to < len(rows) and to - at < BLOCK_ROWS and len(rows[to]) == len(rows[at]):
            to += 1
        raw = np.frombuffer(b"".join(rows[at:to]), np.uint8).reshape(to - at, -1)
        yield np.ascontiguousarray(raw[:, 1:]).view(f"<i{rows[at][0]}").astype(np.int64) + offset
        at = to


def fixed_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, dim, body): packed floor(scale * c) of every row that has a whole vector."""
    def run(batches):
        for batch in batches:
            lists = batch.column("v").cast(pa.list_(pa.float64()))
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            entries = lists.flatten()
            values = np.floor(entries.to_numpy(zero_copy_only=False) * float(scale))
            with np.errstate(invalid="ignore"):
                bad = ~(np.abs(values) < BEYOND)        # null and non-finite entries, too
            row = np.repeat(np.arange(len(sizes)), sizes)
            whole = (sizes > 0) & (np.bincount(row[bad], minlength=len(sizes)) == 0)
            out = [None] * len(sizes)
            ends = np.cumsum(sizes)
            for size in np.unique(sizes[whole]).tolist():
                at = np.flatnonzero(whole & (sizes == size))
                for lo in range(0, len(at), BLOCK_ROWS):
                    part = at[lo:lo + BLOCK_ROWS]
                    u = values[(ends[part] - size)[:, None] + np.arange(size)].astype(np.int64)
                    for i, b in zip(part.tolist(), _pack(u)):
                        out[i] = b
            keep = pa.array(np.flatnonzero(whole))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(keep), pa.array(sizes[whole], pa.int32()),
                                              pa.array(out, pa.binary()).take(keep)], names=["id", "dim", "body"])

    vectors = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return vectors.mapInArrow(run, f"id {type_of(df, id_col)}, dim int, body binary")


# --- sums over the fit list -------------------------------------------------------------

def _gather(df: DataFrame, schema: str, start: Callable, add: Callable, merge: Callable,
            row: Callable, unrow: Callable, offset: int):
    """Fold all vectors of ``df`` to one state: per partition, then ``FAN_IN`` states a task.

    ``row`` and ``unrow`` turn a state into the fields of ``schema`` and back.
    None where there are no vectors.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    schema = f"part long, {schema}"
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def table(part: int, state) -> dict:
        return [pa.array([v], f.type) for v, f in zip((part, *row(state)), arrow)]

    def fold(batches):
        state = None
        for batch in batches:
            for x in _unpack(sorted(batch.column("body").to_pylist(), key=len), offset):
                state = add(start(x.shape[1]) if state is None else state, x)
        if state is not None:
            yield pa.RecordBatch.from_arrays(table(0, state), schema=arrow)

    def meet(found: pa.Table) -> pa.Table:
        state = None
        for r in found.to_pylist():
            mine = unrow(r)
            state = mine if state is None else merge(state, mine)
        return pa.Table.from_arrays(table(found.column("part")[0].as_py(), state), schema=arrow)

    # The pass over the vectors is kept; the small levels above are made again if lost.
    states = written(df.select("body").mapInArrow(fold, schema).withColumn(
        "part", F.shiftright(F.monotonically_increasing_id(), 33)), "spectra")
    left = states.count()
    most = max(left, (states.agg(F.max("part")).first()[0] or 0) + 1)
    while left > 1:
        states = states.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("long")) \
            .groupBy("part").applyInArrow(meet, schema)
        most = -(-most // FAN_IN)
        left = min(left, most)
    found = states.collect()
    return unrow(found[0].asDict()) if found else None


def _flat(m: np.ndarray) -> list[float]:
    return np.ascontiguousarray(m).ravel().tolist()


def _square(values: list[float]) -> np.ndarray:
    side = int(round(len(values) ** 0.5))
    return np.array(values).reshape(side, side)


def fit(distinct: DataFrame, offset: int = OFFSET) -> Whitening | None:
    """The spectrum of distinct packed vectors (column ``body``); None without any."""
    def add(state, x):
        return state[0] + x.sum(0), spectra.absorb_block(state[1], x)

    def unrow(r):
        return np.array(r["sums"], np.int64), (r["n"], np.array(r["mean"]), np.array(r["vals"]), _square(r["vecs"]))

    found = _gather(distinct, "n long, sums array<long>, mean array<double>, vals array<double>, vecs array<double>",
                    lambda d: (np.zeros(d, np.int64), spectra.empty(d)), add,
                    lambda a, b: (a[0] + b[0], spectra.combine(a[1], b[1])),
                    lambda s: (s[1][0], s[0].tolist(), s[1][1].tolist(), s[1][2].tolist(), _flat(s[1][3])),
                    unrow, offset)
    if found is None:
        return None
    sums, (n, _, values, vectors) = found
    basis = np.linalg.qr(vectors[:, ::-1])[0]
    rough = Whitening(n, sums, values[::-1], basis, offset)

    def project(state, x):
        y = rough.centred(x) @ basis
        return state + y.T @ y

    ritz = _sum_matrix(distinct, len(sums), project, offset) / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    vectors = basis @ turn[:, ::-1]
    # One sign for all rows: the largest entry of a component is positive.
    vectors *= np.where(vectors[np.abs(vectors).argmax(0), np.arange(len(sums))] < 0, -1.0, 1.0)
    return Whitening(n, sums, np.maximum(values[::-1], 0.0), vectors, offset)


def _sum_matrix(distinct: DataFrame, side: int, add: Callable, offset: int) -> np.ndarray:
    return _gather(distinct, "m array<double>", lambda d: np.zeros((side, side)), add, lambda a, b: a + b,
                   lambda m: (_flat(m),), lambda r: _square(r["m"]), offset)


def identity_error(model: Whitening, distinct: DataFrame, components: int) -> float:
    """Largest entry, by amount, of the covariance of the whitened fit list less
    the identity; over the components that have variance, 0 if none has."""
    k = model.rank(components)
    if not k:
        return 0.0

    def add(state, x):      # the last row and column sum the whitened vectors
        y = np.column_stack([model.project(x, components), np.ones(len(x))])
        return state + y.T @ y

    m = _sum_matrix(distinct, k + 1, add, model.offset) / model.n
    return float(np.abs(m[:k, :k] - np.outer(m[:k, k], m[:k, k]) - np.eye(k)).max())


def deviations(model: Whitening, x: np.ndarray) -> pa.Array:
    """Exact sums of (n * x - sums)^2 by row; null beyond a long."""
    d = model.n * x - model.sums
    if float(np.abs(d).max(initial=0)) ** 2 * d.shape[1] < 2.0 ** 62:
        return pa.array((d * d).sum(1))
    sums = [sum(v * v for v in r) for r in d.tolist()]
    return pa.array([s if s < 2 ** 63 else None for s in sums], pa.int64())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Per row with a vector and component (from 1): id, ``component``, ``n``,
    ``deviation``, ``whitened``, ``explained`` and ``identity_error``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    schema = (f"id {type_of(df, id_col)}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    arrow = to_arrow_schema(_parse_datatype_string(schema))
    fixed = fixed_vectors(df, id_col, vector_col, scale)
    distinct = written(fixed.select("dim", "body").distinct(), "vectors")
    commonest = fixed.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = commonest["dim"] if commonest else 0
    distinct = distinct.filter(F.col("dim") == dim)
    model = fit(distinct, offset)
    if model is None:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    error = identity_error(model, distinct, components)
    top, rank = min(components, dim), model.rank(components)
    trace = float(model.values.sum())
    share = [float(v) / trace if k < rank else 0.0 for k, v in enumerate(model.values[:top])]

    def run(batches):
        for batch in batches:
            at = 0
            for x in _unpack(batch.column("body").to_pylist(), offset):
                n = len(x)
                ids = batch.column("id").slice(at, n)
                at += n
                made = np.full((n, top), np.nan)
                made[:, :rank] = model.project(x, components)
                again = pa.array(np.repeat(np.arange(n), top))
                yield pa.RecordBatch.from_arrays([
                    ids.take(again), pa.array(np.tile(np.arange(1, top + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * top, model.n)), deviations(model, x).take(again),
                    pa.array(made.ravel(), mask=np.isnan(made.ravel())), pa.array(np.tile(share, n)),
                    pa.array(np.full(n * top, error))], schema=arrow)

    rows = fixed.filter(F.col("dim") == dim).select("id", "body")
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)

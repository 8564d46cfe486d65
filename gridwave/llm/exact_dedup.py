"""Exact duplicates through a minimal perfect hash over the digests known already.

The digest of a text is the SHA-256 of its UTF-8 bytes, A-Z lower-cased.  Rows
marked as historical are the corpus so far; all others are a new delivery.

1. ``digest_table``: number, id and digest of every row, written once;
2. ``build_index``: the distinct historical digests, dealt to buckets by a hash.
   Each bucket gets a minimal perfect hash: n digests, n slots.  A slot holds
   the whole digest, the locator of its winner (id and row number) and the
   number of its rows;
3. ``look_up``: the distinct new digests meet the index of their bucket.  The
   hash names one slot, whose 32 bytes are compared: equal ones are repeats and
   join the slot's rows, all others are no members and form groups of their own;
4. ``exact_duplicates``: every row gets the winner and size of its group.

A perfect hash is levels of bit fields.  A digest that is alone on its bit at a
level has its slot there (the number of bits set before); the others go to the
next level, which draws new places for them.

Texts never leave the first step, only digests are shuffled.  A text that fills
a third of all rows is one digest after the map-side aggregation; its rows meet
their winner in a broadcast join of the groups that hold over a ``HOT_SHARE``-th
of all rows, of which there are fewer than ``HOT_SHARE``.

Null and empty texts are equal.  Of equal texts the row with the largest id
stays; a null id is less than any other, and of rows that repeat that id exactly
one stays (that of the largest row number).  An empty table gives no rows.
Extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from gridwave.llm.common import per_row, type_of, written

BUCKET_DIGESTS = 50_000     # digests whose perfect hash one task builds
BITS_PER_KEY = 2            # of a level's field
HOT_SHARE = 1_000
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


# --- the perfect hash of one bucket -----------------------------------------------------

def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Bit of each digest (four 64-bit words) in a level's field."""
    h = np.full(len(words), (0x9E3779B97F4A7C15 * (level + 1)) % 2 ** 64, np.uint64)
    for k in range(4):
        h = (h ^ words[:, k]) * M1
        h = (h ^ (h >> np.uint64(29))) * M2
    return ((h ^ (h >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


def _words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 4)


def perfect_hash(digests: list[bytes]) -> tuple[list[int], bytes]:
    """Sizes of the levels and their bits, for distinct digests of 32 bytes."""
    left, sizes, fields = _words(digests), [], []
    while len(left):
        size = max(8, BITS_PER_KEY * len(left))
        place = _places(left, len(sizes), size)
        alone = np.bincount(place, minlength=size) == 1
        sizes.append(size)
        fields.append(alone)
        left = left[~alone[place]]
    bits = np.concatenate(fields) if fields else np.empty(0, bool)
    return sizes, np.packbits(bits).tobytes()


def slots_of(digests: list[bytes], sizes: list[int], bits: bytes) -> np.ndarray:
    """The slot the hash names for each digest; -1 where no level has a bit."""
    words = _words(digests)
    field = np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(sizes)).astype(bool)
    before = np.cumsum(field) - field
    slots, left, at = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        place = at + _places(words[left], level, size)
        hit = field[place]
        slots[left[hit]] = before[place[hit]]
        left, at = left[~hit], at + size
    return slots


def members(digests: list[bytes], sizes: list[int], bits: bytes, held: list[bytes]) -> np.ndarray:
    """Slot of each digest whose bytes the slot holds, else -1."""
    slots = slots_of(digests, sizes, bits)
    return np.array([s if s >= 0 and held[s] == d else -1 for s, d in zip(slots.tolist(), digests)], np.int64)


# --- Spark jobs -------------------------------------------------------------------------

def digest_table(docs: DataFrame, id_col: str, text_col: str, historical: Column) -> DataFrame:
    """(row_no, id, digest, old) of every row, as a written table."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("digest"),
                       F.coalesce(historical, F.lit(False)).alias("old"))

    def digest(batch: pa.RecordBatch) -> dict:
        texts = batch.column("digest").to_pylist()
        # bytes.lower() lower-cases A-Z and nothing else.
        return {"digest": pa.array([hashlib.sha256((t or b"").lower()).digest() for t in texts], pa.binary())}

    made = per_row(rows, f"id {type_of(docs, id_col)}, digest binary, old boolean", digest, "digest")
    return written(made.select(F.monotonically_increasing_id().alias("row_no"), "id", "digest", "old"), "digests")


def _groups(rows: DataFrame) -> DataFrame:
    """One row a digest: locator of its winner (id, row_no) and its rows (n)."""
    return rows.groupBy("digest").agg(F.max(F.struct("id", "row_no")).alias("w"), F.count(F.lit(1)).alias("n")) \
        .select("digest", F.col("w.id").alias("id"), F.col("w.row_no").alias("row_no"), "n")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket")


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """Index rows, one a bucket, of historical rows (row_no, id, digest); written.

    ``levels`` and ``bits`` are the perfect hash; ``digests``, ``ids``,
    ``row_nos`` and ``sizes`` hold what the slots do, in their order.
    """
    id_type = type_of(history, "id")
    out = (f"bucket long, levels array<int>, bits binary, digests array<binary>, ids array<{id_type}>, "
           "row_nos array<long>, sizes array<long>")
    arrow = to_arrow_schema(_parse_datatype_string(out))

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        digests = table.column("digest").to_pylist()
        levels, bits = perfect_hash(digests)
        order = np.argsort(slots_of(digests, levels, bits))
        held = table.take(pa.array(order))
        return pa.table([pa.array(x, f.type) for x, f in zip(
            ([table.column("bucket")[0].as_py()], [levels], [bits],
             *([held.column(c).to_pylist()] for c in ("digest", "id", "row_no", "n"))), arrow)], schema=arrow)

    groups = _groups(history).select(_bucket(buckets), "digest", "id", "row_no", "n")
    return written(groups.groupBy("bucket").applyInArrow(build, out), "digest-index")


def look_up(index: DataFrame, new: DataFrame, buckets: int) -> DataFrame:
    """All groups (digest, id, row_no, n) of the indexed and the new rows together."""
    out = f"digest binary, id {type_of(new, 'id')}, row_no long, n long"
    arrow = to_arrow_schema(_parse_datatype_string(out))

    def probe(table: pa.Table, found: pa.Table) -> pa.Table:
        table = table.select(arrow.names).cast(arrow).combine_chunks()
        if not found.num_rows:
            return table
        slot = {c: found.column(c)[0].as_py() for c in found.column_names}
        at = members(table.column("digest").to_pylist(), slot["levels"], slot["bits"], slot["digests"])
        ids, nos, sizes = slot["ids"], slot["row_nos"], slot["sizes"]
        repeats = table.take(pa.array(np.flatnonzero(at >= 0)))
        for s, i, no, n in zip(at[at >= 0].tolist(), *(repeats.column(c).to_pylist() for c in ("id", "row_no", "n"))):
            sizes[s] += n
            # A null id is less than any other.
            if (i is not None, i if i is not None else 0, no) > \
                    (ids[s] is not None, ids[s] if ids[s] is not None else 0, nos[s]):
                ids[s], nos[s] = i, no
        old = pa.table([pa.array(x, f.type) for x, f in zip((slot["digests"], ids, nos, sizes), arrow)], schema=arrow)
        return pa.concat_tables([old, table.take(pa.array(np.flatnonzero(at < 0)))])

    looked = _groups(new).select(_bucket(buckets), "digest", "id", "row_no", "n")
    return looked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(probe, out)


def exact_duplicates(docs: DataFrame, historical: Column, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per row: id, ``keep_id`` (id of the row that stays), ``group_size``,
    ``kept`` and ``text_sha256`` (lowercase hex).

    ``historical`` says which rows make the index; the others are looked up in
    it.  The result does not depend on it (null counts as new).
    """
    spark = docs.sparkSession
    rows = digest_table(docs, id_col, text_col, historical)
    total = rows.count()
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_DIGESTS))
    index = build_index(rows.filter("old"), buckets)
    groups = look_up(index, rows.filter("NOT old"), buckets)
    many = written(groups.filter("n > 1").select("digest", F.col("id").alias("top_id"), F.col("row_no").alias("top"),
                                                 "n"), "digest-groups")
    # Fewer than HOT_SHARE groups can hold more than this.
    hot = F.broadcast(many.filter(F.col("n") > total // HOT_SHARE))
    rest = many.filter(F.col("n") <= total // HOT_SHARE)
    rows = rows.select("row_no", "id", "digest")
    joined = rows.join(hot, "digest").union(rows.join(hot, "digest", "left_anti").join(rest, "digest", "left"))
    return joined.select(
        F.col("id").alias(id_col),
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("top_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("row_no") == F.col("top"), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))

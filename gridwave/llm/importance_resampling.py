"""Resampling of documents by their importance for a target distribution.

Features of a text are all runs of 1 to ``max_n`` consecutive words, joined by
one space and hashed to buckets (CRC-32 of the UTF-8 bytes modulo ``buckets``).
A bucket's gain is the floor of 1000 * ln of the ratio of its smoothed shares
in the target and in all documents; a document's weight is the sum of the gains
of its features.  Its score adds Gumbel noise that hangs on its id alone, so the
highest scores are a draw without replacement in proportion to exp(weight/1000).

1. ``bucket_counts``: every task interns the n-grams of its record batches and
   sums their counts per bucket; a task sends one row for each bucket it has
   seen, whatever the number of its words;
2. ``gain_table``: one gain for each bucket (``buckets`` numbers, the only thing
   that is sent to the tasks);
3. ``weighted``: n-grams are interned again, and the gains of their slots are
   gathered by the slot id of every occurrence and summed per document;
4. ``resample``: ranks by one range shuffle.  Its key ends in the row's number,
   so ties do not pile up; a rank is the place in the partition plus the rows
   of the partitions before, so no task sees more than its partition.

Interning (``intern``) is an open-addressed table in NumPy.  The key of an
n-gram is its XXH64; a slot names the first occurrence that took it, and another
occurrence belongs to it only if key, length and all bytes are equal, else it
goes on to the next slot.  Per slot there are a bucket and a count.

Words are runs of a-z (A-Z lower-cased), 0-9 and all characters beyond ASCII.
Null and empty texts have no features and weight 0.  A null id gets the noise
of an empty id.  Rows that repeat an id are all ranked, in any order among equal
scores and ids.  A document of under ``min_words`` words is not drawn and does
not count for the share.  An empty table gives no rows; an empty target has
T = 0.  Extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwave.llm.common import per_row, steps, type_of, written

BUCKETS = 10_000
MAX_N = 1
MIN_WORDS = 20
DRAW_PERCENT = 10
SEED = 2024
OCCURRENCES = 1 << 19       # interned at a time

P1, P2, P3, P4, P5 = (np.uint64(x) for x in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
# Fixed: which bytes are in words, and what lower-casing A-Z makes of each byte.
LOWERED = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
IN_WORD = np.array([chr(c).isalnum() or c >= 128 for c in range(256)])


# --- words and n-grams of a batch of texts ----------------------------------------------

class Grams:
    """Occurrences of all n-grams of a batch: byte ranges in one buffer of
    lower-cased words, each followed by one space."""

    def __init__(self, texts: pa.Array, max_n: int):
        texts = texts.cast(pa.large_binary())
        cuts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] \
            if len(texts) else np.zeros(1, np.int64)
        held = texts.buffers()[2] if len(texts) else None
        raw = np.frombuffer(held, np.uint8)[cuts[0]:cuts[-1]] if held is not None else np.empty(0, np.uint8)
        self.n_docs = len(texts)
        low, inside = LOWERED[raw], IN_WORD[raw]
        first, last = inside.copy(), inside.copy()      # of a word's bytes
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        # Words end with their text.
        edges = np.unique(cuts[1:-1] - cuts[0])
        edges = edges[(edges > 0) & (edges < len(raw))]
        first[edges] = inside[edges]
        last[edges - 1] = inside[edges - 1]
        ends = np.flatnonzero(last) + 1
        size = ends - np.flatnonzero(first)
        self.words = np.bincount(np.searchsorted(cuts - cuts[0], ends - 1, "right") - 1, minlength=self.n_docs) \
            if self.n_docs else np.empty(0, np.int64)
        stop = np.cumsum(size + 1) - 1
        body = np.full(int(stop[-1]) + 1 if len(stop) else 0, 32, np.uint8)
        spaces = np.zeros(len(body), bool)
        spaces[stop] = True
        body[~spaces] = low[inside]
        self.body = np.concatenate([body, np.zeros(8, np.uint8)])
        # Reads 8 bytes at any place.
        self.lanes = np.ndarray(len(body) + 1, "<u8", self.body, strides=(1,))
        doc = np.repeat(np.arange(self.n_docs), self.words)
        starts, lengths, docs = [], [], []
        for n in range(1, max_n + 1):
            head = np.arange(len(size) - n + 1)
            head = head[doc[head] == doc[head + n - 1]] if n > 1 else head
            starts.append(stop[head] - size[head])
            lengths.append(stop[head + n - 1] - starts[-1])
            docs.append(doc[head])
        self.start, self.length, self.doc = (np.concatenate(x) if x else np.empty(0, np.int64)
                                             for x in (starts, lengths, docs))

    def __len__(self) -> int:
        return len(self.start)

    def text(self, k: int) -> bytes:
        return self.body[self.start[k]:self.start[k] + self.length[k]].tobytes()


def _rotl(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxh64(grams: Grams, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of byte ranges; those of 32 bytes and more by the library."""
    h = P5 + length.astype(np.uint64)
    short = np.flatnonzero(length < 32)
    for lane in range(3):
        at = short[length[short] >= 8 * lane + 8]
        if len(at):
            k = _rotl(grams.lanes[start[at] + 8 * lane] * P2, 31) * P1
            h[at] = _rotl(h[at] ^ k, 27) * P1 + P4
    done = length & ~7
    at = short[(length[short] & 4) > 0]
    if len(at):
        four = grams.lanes[start[at] + done[at]] & np.uint64(0xFFFFFFFF)
        h[at] = _rotl(h[at] ^ (four * P1), 23) * P2 + P3
    done = length & ~3
    for byte in range(3):
        at = short[(length[short] & 3) > byte]
        if len(at):
            one = grams.body[start[at] + done[at] + byte].astype(np.uint64)
            h[at] = _rotl(h[at] ^ (one * P5), 11) * P1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    h ^= h >> np.uint64(32)
    for k in np.flatnonzero(length >= 32).tolist():
        h[k] = xxhash.xxh64_intdigest(grams.body[start[k]:start[k] + length[k]].tobytes())
    return h


def _same_bytes(grams: Grams, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether occurrences a and b, of equal lengths, have equal bytes."""
    same = np.ones(len(a), bool)
    sa, sb, size = grams.start[a], grams.start[b], grams.length[a]
    lane, at = 0, np.flatnonzero(sa != sb)
    while len(at):
        left = np.minimum(size[at] - 8 * lane, 8)
        keep = np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - left) * 8).astype(np.uint64)
        same[at] &= ((grams.lanes[sa[at] + 8 * lane] ^ grams.lanes[sb[at] + 8 * lane]) & keep) == 0
        lane += 1
        at = at[same[at] & (size[at] > 8 * lane)]
    return same


def intern(grams: Grams, lo: int, hi: int, buckets: int,
           keys: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intern occurrences lo to hi: slot id of each, bucket and count of each slot.

    ``keys`` replaces their XXH64 (tests).  The table has at least twice as many
    places as occurrences, so an empty one is always found.
    """
    n = hi - lo
    if keys is None:
        keys = xxh64(grams, grams.start[lo:hi], grams.length[lo:hi])
    places = 1 << max(4, (2 * n - 1).bit_length())
    owner = np.full(places, -1, np.int64)       # occurrence (from lo) that took the place
    place = (keys & np.uint64(places - 1)).astype(np.int64)
    taken = np.empty(n, np.int64)               # place of each occurrence
    open_ = np.arange(n)
    while len(open_):
        at = place[open_]
        free = owner[at] < 0
        owner[at[free]] = open_[free]           # the last writer has it
        own = owner[at]
        equal = (keys[own] == keys[open_]) & (grams.length[lo + own] == grams.length[lo + open_])
        some = np.flatnonzero(equal)
        equal[some] = _same_bytes(grams, lo + own[some], lo + open_[some])
        taken[open_[equal]] = at[equal]
        open_ = open_[~equal]
        place[open_] = (place[open_] + 1) & (places - 1)
    used = np.flatnonzero(owner >= 0)
    slot_at = np.zeros(places, np.int64)
    slot_at[used] = np.arange(len(used))
    slots = slot_at[taken]
    bucket = np.fromiter((zlib.crc32(grams.text(lo + k)) % buckets for k in owner[used].tolist()), np.int64, len(used))
    return slots, bucket, np.bincount(slots, minlength=len(used))


def _parts(grams: Grams, buckets: int):
    for lo in range(0, len(grams), OCCURRENCES):
        hi = min(lo + OCCURRENCES, len(grams))
        yield lo, hi, *intern(grams, lo, hi, buckets)


def count_buckets(texts: pa.Array, max_n: int, buckets: int) -> np.ndarray:
    """Features of the texts per bucket."""
    total = np.zeros(buckets, np.int64)
    grams = Grams(texts, max_n)
    for _, _, _, bucket, count in _parts(grams, buckets):
        np.add.at(total, bucket, count)
    return total


def weigh(texts: pa.Array, max_n: int, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, features and weight of each text."""
    grams = Grams(texts, max_n)
    weight = np.zeros(grams.n_docs, np.int64)
    for lo, hi, slots, bucket, _ in _parts(grams, len(gains)):
        gained = gains[bucket][slots]
        doc = grams.doc[lo:hi]
        heads = np.flatnonzero(np.diff(doc, prepend=-1))
        np.add.at(weight, doc[heads], np.add.reduceat(gained, heads))
    return grams.words, np.bincount(grams.doc, minlength=grams.n_docs), weight


# --- Spark jobs -------------------------------------------------------------------------

def bucket_counts(df: DataFrame, text_col: str, name: str, max_n: int, buckets: int) -> DataFrame:
    """(bucket, ``name``): features of all texts, of the buckets that have any."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in steps(batches, "body"):
            total += count_buckets(batch.column("body"), max_n, buckets)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], names=["bucket", name])

    texts = df.select(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("body"))
    return texts.mapInArrow(run, f"bucket long, {name} long").groupBy("bucket").agg(F.sum(name).alias(name))


def gain_table(docs: DataFrame, target: DataFrame, text_col: str, target_col: str, max_n: int,
               buckets: int) -> np.ndarray:
    """Gain of every bucket; ``buckets`` rows at most come to the driver."""
    counts = np.zeros((2, buckets), np.int64)
    for k, (df, col) in enumerate([(docs, text_col), (target, target_col)]):
        for r in bucket_counts(df, col, "n", max_n, buckets).collect():
            counts[k, r.bucket] = r.n
    s, t = counts.astype(float)
    ratio = ((t + 1) * (s.sum() + buckets)) / ((s + 1) * (t.sum() + buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def noise(id_: Column, seed: int) -> Column:
    """Gumbel noise times 1000, floored, from the first 32 bits of a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296))).cast("long")


def weighted(docs: DataFrame, gains: np.ndarray, id_col: str, text_col: str, max_n: int) -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("body"))

    def work(batch: pa.RecordBatch) -> dict:
        return dict(zip(("n_words", "n_features", "weight"), weigh(batch.column("body"), max_n, gains)))

    return per_row(rows, f"id {type_of(docs, id_col)}, n_words long, n_features long, weight long", work, "body")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS, min_words: int = MIN_WORDS,
             percent: int = DRAW_PERCENT, seed: int = SEED) -> DataFrame:
    """Per row: id, ``n_features``, ``weight``, ``score`` and ``rank`` (1 is drawn
    first; null where the document is not drawn)."""
    spark = docs.sparkSession
    gains = gain_table(docs, target, text_col, target_col, max_n, buckets)
    scored = weighted(docs, gains, id_col, text_col, max_n)
    scored = written(scored.withColumn("score", F.col("weight") + noise(F.col("id"), seed))
                     .withColumn("row_no", F.monotonically_increasing_id()), "weights")
    able = scored.filter(F.col("n_words") >= min_words)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("score").desc(), F.col("id").asc(), F.col("row_no").asc()]
    # The number of a row holds its partition (upper 31 bits) and its place there.
    placed = written(able.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                     .withColumn("at", F.monotonically_increasing_id()), "ranked")
    sizes = {r.part: r["count"] for r in placed.groupBy(F.shiftright("at", 33).alias("part")).count().collect()}
    draws = percent * sum(sizes.values()) // 100
    before, rows = 0, []
    for part in sorted(sizes):
        rows.append((part, before))
        before += sizes[part]
    offsets = F.broadcast(spark.createDataFrame(rows, "part long, before long"))
    place = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    kept = ["id", "n_features", "weight", "score"]
    ranked = placed.join(offsets, F.shiftright("at", 33) == F.col("part")) \
        .select(*kept, F.when(place <= draws, place).alias("rank"))
    rest = scored.filter(F.col("n_words") < min_words).select(*kept, F.lit(None).cast("long").alias("rank"))
    return ranked.union(rest).withColumnRenamed("id", id_col)

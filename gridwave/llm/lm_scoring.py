"""Stupid-backoff scores of documents under the n-gram counts of all documents.

score(w | h) = c(h w) / c(h) where c(h w) > 0, else BACKOFF * score(w | h without
its first word); for a lone word c(w) / N (one that is not counted at all counts
as seen once).  A document's score is the sum of the logarithms over its words.
The table holds every n-gram of every document.  With ``leave_out`` a document is
scored under the counts of all others: its own are taken off every count and N.

The computation is three relational steps:

1. n-grams are exploded from blocks of documents (``BLOCK_BYTES`` of text, read
   one after another), pre-aggregated per block, and dealt to partitions by
   n-gram hash;
2. each partition sums its counts: its share of the count table, which joins
   the exploded rows on the n-gram and gives every block the counts of its own;
3. counts join the documents of their block, scores are summed per document.

Rows are packed: one row holds a block's n-grams in one partition, as the
differences of their sorted 64-bit hashes.  An n-gram, however frequent, is one
entry per block, and rows that repeat, however many, fill blocks like any others:
no partition is hot.  What is shuffled grows with the n-grams.  The number of
packed rows is that of blocks times parts, until each holds one n-gram.

Words are runs other than ASCII white space, A-Z lower-cased.  A null or empty
text has no words, score 0 and a null mean.  Repeated rows all count, and each
is scored.  An empty table gives no rows.  Extra columns, whatever their names,
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwave.llm.common import type_of

ORDER = 3
BACKOFF = 0.4
BLOCK_BYTES = 8_000_000     # of text whose n-grams a worker holds at once
PART_BYTES = 16_000_000     # of text whose n-grams one partition of the table counts
CACHED_WORDS = 250_000
SPREAD = np.uint64(0x9E3779B97F4A7C15)
LOW = 5                     # bytes of a hash that are stored as they are


class Hashes(dict):
    """64-bit hash by word; starts anew when it has grown to its bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_HASHES = Hashes()


def word_hashes(text: bytes | None) -> np.ndarray:
    words = text.lower().split() if text else []
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, sizes: np.ndarray, order: int) -> list[np.ndarray]:
    """By length: for each n-gram of the texts its hash, and place of its last word.

    Texts follow one another in ``words``; an n-gram lies in one text.
    """
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out, last, hashes = [], np.arange(len(words)), words
    for n in range(1, order + 1):
        if n > 1:
            keep = place[last] >= n - 1
            last = last[keep]
            # The hash of the n-gram without its last word stands one place before.
            shorter = np.zeros(len(words), np.uint64)
            shorter[out[-1][1]] = out[-1][0]
            hashes = shorter[last - 1] * SPREAD + words[last]
        mixed = hashes ^ (hashes >> np.uint64(29))
        mixed = (mixed + np.uint64(n)) * SPREAD
        out.append((mixed ^ (mixed >> np.uint64(32)), last))
    return out


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Partition of each hash; ascending in the hash."""
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys: their number, a byte for the step of the upper bits, the
    lower bytes; steps of 255 and more are apart, in order, in four bytes."""
    steps = np.diff(keys >> np.uint64(8 * LOW), prepend=np.uint64(0))
    return len(keys).to_bytes(4, "little") + np.minimum(steps, 255).astype(np.uint8).tobytes() \
        + keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :LOW].tobytes() + steps[steps >= 255].astype("<u4").tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    steps = np.frombuffer(data, np.uint8, n, 4).astype(np.uint64)
    steps[steps == 255] = np.frombuffer(data, "<u4", offset=4 + n + LOW * n)
    out = np.zeros((n, 8), np.uint8)
    out[:, :LOW] = np.frombuffer(data, np.uint8, LOW * n, 4 + n).reshape(-1, LOW)
    return out.view("<u8").ravel() | (np.cumsum(steps, dtype=np.uint64) << np.uint64(8 * LOW))


def pack_counts(counts: np.ndarray) -> tuple[bytes, bytes]:
    """A bit for each count over one; behind the bits, such counts in a byte each.
    Those of 255 and more are apart, in order, in eight."""
    more = counts > 1
    return (np.packbits(more).tobytes() + np.minimum(counts[more], 255).astype(np.uint8).tobytes(),
            counts[counts >= 255].astype("<i8").tobytes())


def unpack_counts(small: bytes, large: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(small, np.uint8)
    bits = -(-n // 8)
    more = np.unpackbits(raw[:bits], count=n).astype(bool)
    out = np.ones(n, np.int64)
    out[more] = raw[bits:]
    out[out == 255] = np.frombuffer(large, "<i8")
    return out


def pack_texts(texts: list[bytes]) -> tuple[bytes, bytes]:
    """Lengths and the compressed texts of a block."""
    return np.array([len(t) for t in texts], "<i8").tobytes(), zstandard.compress(b"".join(texts), 6)


def unpack_texts(lengths: bytes, body: bytes) -> list[bytes]:
    whole, ends = zstandard.decompress(body), np.cumsum(np.frombuffer(lengths, "<i8"))
    return [whole[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def _block_grams(texts, order: int):
    """Sizes of the texts, their n-grams by length, and all n-grams' hashes."""
    words = [word_hashes(t) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    grams = gram_hashes(np.concatenate(words) if words else np.empty(0, np.uint64), sizes, order)
    return sizes, grams, np.concatenate([h for h, _ in grams])


def block_scores(texts, counts: np.ndarray, total: int, order: int,
                 leave_out: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, log score and backed-off words of each text, from the counts of
    the block's distinct n-grams in ascending order of their hashes."""
    sizes, grams, every = _block_grams(texts, order)
    _, row = np.unique(every, return_inverse=True)
    n = int(sizes.sum())
    doc = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    seen, at = [], 0
    for hashes, last in grams:      # count of the n-gram that ends at each word
        mine = row[at:at + len(hashes)]
        c = np.zeros(n, np.int64)
        c[last] = counts[mine]
        if leave_out:
            _, own, times = np.unique(doc[last] * len(counts) + mine, return_inverse=True, return_counts=True)
            c[last] -= times[own]
        seen.append(c)
        at += len(hashes)
    rest = total - sizes[doc] if leave_out else total
    score = np.log(np.maximum(seen[0], 1) / np.maximum(rest, 1))
    used = np.zeros(n, np.int64)
    for k in range(1, order):
        hit = np.flatnonzero(seen[k] > 0)
        score[hit] = np.log(seen[k][hit] / seen[k - 1][hit - 1])
        used[hit] = k
    short = np.minimum(place, order - 1) - used
    score += short * np.log(BACKOFF)
    return sizes, np.bincount(doc, score, len(sizes)), np.bincount(doc, short > 0, len(sizes)).astype(np.int64)


def text_sizes(docs: DataFrame, text_col: str) -> tuple[int, int]:
    """Bytes and words of all texts."""
    def size(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            yield pa.record_batch([pa.array([sum(len(t or b"") for t in texts)]),
                                   pa.array([sum(len(t.split()) for t in texts if t)])], names=["bytes", "words"])

    sums = docs.select(F.col(text_col).cast("binary")).mapInArrow(size, "bytes long, words long") \
        .agg(F.sum("bytes"), F.sum("words")).first()
    return tuple(int(x or 0) for x in sums)


def text_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """(block, ids, lengths, body): documents in the order they are read."""
    id_type = type_of(docs, id_col)

    def pack(batches):
        ids, texts, held = [], [], 0

        def made():
            arrow = pa.array([ids], pa.list_(batch.schema.field("id").type))
            lengths, body = pack_texts(texts)
            return pa.record_batch([arrow, pa.array([lengths], pa.binary()), pa.array([body], pa.binary())],
                                   names=["ids", "lengths", "body"])

        for batch in batches:
            for i, t in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                ids.append(i)
                texts.append(t or b"")
                held += len(texts[-1])
                if held >= block_bytes:
                    yield made()
                    ids, texts, held = [], [], 0
        if ids:
            yield made()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(pack, f"ids array<{id_type}>, lengths binary, body binary") \
        .withColumn("block", F.monotonically_increasing_id())


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
                    leave_out: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: id, words, sum and mean of log scores, words scored with back-off."""
    spark = docs.sparkSession
    n_bytes, total = text_sizes(docs, text_col)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    deals, parts = (max(least, -(-n_bytes // size)) for size in (block_bytes, PART_BYTES))

    def explode(batches):
        for batch in batches:
            for block, lengths, body in zip(*(batch.column(c).to_pylist() for c in ("block", "lengths", "body"))):
                _, _, every = _block_grams(unpack_texts(lengths, body), order)
                keys, counts = np.unique(every, return_counts=True)
                where = part_of(keys, parts)
                cuts = np.searchsorted(where, np.arange(parts + 1, dtype=np.uint64))
                out = []
                for p in np.unique(where).astype(int):
                    part = slice(cuts[p], cuts[p + 1])
                    out.append((p, pack_keys(keys[part]), *pack_counts(counts[part])))
                cols = list(zip(*out)) or [()] * 4
                yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array([block] * len(out), pa.int64()),
                                       *(pa.array(c, pa.binary()) for c in cols[1:])],
                                      names=["part", "block", "keys", "small", "large"])

    def count(table: pa.Table) -> pa.Table:
        keys = [unpack_keys(x) for x in table.column("keys").to_pylist()]
        mine = [unpack_counts(a, b, len(k)) for a, b, k in zip(table.column("small").to_pylist(),
                                                               table.column("large").to_pylist(), keys)]
        distinct, row = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.zeros(len(distinct), np.int64)
        np.add.at(sums, row, np.concatenate(mine))
        sizes = [len(k) for k in keys]
        ends = np.cumsum(sizes)
        packed = [pack_counts(sums[r]) for r in np.split(row, ends[:-1])]
        return pa.table({"block": table.column("block"), "part": table.column("part"),
                         "small": pa.array([a for a, _ in packed], pa.binary()),
                         "large": pa.array([b for _, b in packed], pa.binary()),
                         "n": pa.array(sizes, pa.int64())})

    def score(table: pa.Table, counted: pa.Table) -> pa.Table:
        order_of = np.argsort(counted.column("part").to_numpy())
        small, large, n = (counted.column(c).to_pylist() for c in ("small", "large", "n"))
        counts = [unpack_counts(small[i], large[i], n[i]) for i in order_of]
        texts = unpack_texts(table.column("lengths")[0].as_py(), table.column("body")[0].as_py())
        words, logs, short = block_scores(texts, np.concatenate(counts) if counts else np.empty(0, np.int64),
                                          total, order, leave_out)
        return pa.table([table.column("ids").combine_chunks().flatten(), pa.array(words), pa.array(logs),
                         pa.array(short)], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    out = f"id {type_of(docs, id_col)}, n_words long, log_score double, n_backoff long"
    schema = to_arrow_schema(spark.createDataFrame([], out).schema)
    # As many partitions as blocks and parts, so that a task's share does not hang on a setting.
    blocks = text_blocks(docs, id_col, text_col, block_bytes).repartition(deals, "block")
    # The whole rows, though ids are not read: the one shuffle of blocks then serves both uses.
    requests = blocks.mapInArrow(explode, "part long, block long, keys binary, small binary, large binary") \
        .repartition(parts, "part")
    counts = requests.groupBy("part") \
        .applyInArrow(count, "block long, part long, small binary, large binary, n long").repartition(deals, "block")
    scored = blocks.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(score, out)
    return scored.select(F.col("id").alias(id_col), "n_words", F.round("log_score", 4).alias("log_score"),
                         F.round(F.try_divide("log_score", F.col("n_words")), 4).alias("mean_log_score"), "n_backoff")

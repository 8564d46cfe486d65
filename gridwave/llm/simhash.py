"""SimHash near-duplicates through a hierarchical index in Gray order.

A text's fingerprint has 64 bits, each set if it is set in over half of its
shingles' hashes.  Equal fingerprints form one class before anything else, so
copies cost one row.  Classes whose fingerprints differ in at most two bits are
linked, and documents get the least id they can reach over links.

Index.  Two fingerprints within two bits agree on one of three fixed parts of
the 64 bits, so the index is dealt out three times, by the value of each part.
Within such a group fingerprints are sorted by Gray rank, which puts those
with few differing bits side by side, and every ``FANOUT`` neighbours get a
node above them that holds the bits all of them share; nodes of nodes follow
up to one root.  The search compares whole groups with whole groups from the
root down.  Bits shared above are not looked at again: differences add up from
level to level, and a pair of nodes is given up as soon as they exceed the
limit.

Hot groups.  A group of more than ``GROUP_ROWS`` fingerprints is dealt out
again by thirds of its remaining bits, at most ``LEVELS`` times.  After that
19 bits are free, so a group has 2**19 members at most.  Inside a group, pairs
found are merged at once, and only one link per fingerprint leaves it.

Words are runs other than ASCII white space, with A-Z lower-cased.  A text of
fewer words than a shingle gives its whole word sequence as one; a null or
empty text, or one without words, has fingerprint zero, linked like any other.
Rows with a null id get the component of their fingerprint; it is null where
no row of the component has an id.  Repeated rows are fingerprinted each.  An
empty table gives no rows.  Extra columns, whatever their names and types, are
not read (``keep_one`` returns them as they are).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwave.llm.common import per_row, type_of, written
from gridwave.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
GROUP_ROWS = 4096
LEVELS = 3
FANOUT = 8
HASHES_AT_A_TIME = 200_000      # shingle hashes whose bits are counted together
PAIRS_AT_A_TIME = 500_000       # node pairs that are expanded together

ALL_BITS = (1 << 64) - 1


# --- fingerprints ---------------------------------------------------------------------

def shingle_hashes(text: bytes | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every shingle; ``lower`` and ``split`` on bytes know ASCII only."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(size)]))
    return np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], np.uint64)


def fingerprints(texts: list[bytes | None], size: int = SHINGLE_WORDS) -> np.ndarray:
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        hashes = shingle_hashes(text, size)
        counts = np.zeros(64, np.int64)
        for at in range(0, len(hashes), HASHES_AT_A_TIME):
            part = hashes[at:at + HASHES_AT_A_TIME].astype("<u8").view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
        bits = counts * 2 > len(hashes)
        out[i] = np.packbits(bits, bitorder="little").view("<u8")[0]
    return out


def _body(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def add_fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE_WORDS) -> DataFrame:
    """(id, hash of the text, fp) per row; fp is the 64 bits as a signed long."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), _body(text).alias("body"), text.cast("binary").alias("text"))
    return per_row(rows, f"id {type_of(docs, id_col)}, body long, fp long",
                   lambda b: {"fp": fingerprints(b.column("text").to_pylist(), size).view(np.int64)}, "text")


# --- dealing out by parts of the bits -------------------------------------------------

def signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def thirds(mask: int, parts: int) -> list[int]:
    """The bits of ``mask`` in ``parts`` runs of about equal size."""
    bits = [i for i in range(64) if mask >> i & 1]
    cuts = [round(k * len(bits) / parts) for k in range(parts + 1)]
    return [sum(1 << i for i in bits[a:b]) for a, b in zip(cuts, cuts[1:])]


def deeper(masks: list[int], parts: int) -> dict[int, list[int]]:
    """For each mask, the masks that add one part of the bits it leaves free."""
    return {m: [m | t for t in thirds(ALL_BITS & ~m, parts)] for m in masks}


def gray_rank(fp: Column) -> Column:
    """Place of the fingerprint in the reflected Gray code, in unsigned order."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(signed(1 << 63)))


def deal(classes: DataFrame, max_bits: int = MAX_BITS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Every fingerprint (``fp``) once for each group (mask, key) it is searched in."""
    parts = max_bits + 1
    longs = lambda ms: F.array(*[F.lit(signed(m)) for m in ms])
    masks = thirds(ALL_BITS, parts)
    rows = classes.select("fp", F.explode(longs(masks)).alias("mask"))
    out = None
    for level in range(1, LEVELS + 1):
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        if level == LEVELS:
            done, hot = rows, None
        else:
            hot = written(rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n"))
                          .filter(F.col("n") > group_rows).drop("n"), "hot-groups")
            if hot.isEmpty():
                done, hot = rows, None
            else:
                done = rows.join(hot, ["mask", "key"], "left_anti").select("fp", "mask", "key")
        out = done if out is None else out.unionByName(done)
        if hot is None:
            break
        below = deeper(masks, parts)
        nested = F.create_map(*[x for m, ms in below.items() for x in (F.lit(signed(m)), longs(ms))])
        rows = rows.join(hot, ["mask", "key"], "left_semi") \
            .select("fp", F.explode(nested[F.col("mask")]).alias("mask"))
        masks = [m for ms in below.values() for m in ms]
    return out


# --- the index of one group, and its search -------------------------------------------

def merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of ``parent`` that the pairs (a, b) connect; in place."""
    while True:
        ra, rb = parent[a], parent[b]
        open_ = ra != rb
        if not open_.any():
            return
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


class GrayIndex:
    """Levels of nodes over groups of fingerprints, each group in Gray order.

    Node k of a level has the AND and OR of its members; a bit is shared where
    both agree.  ``group`` numbers the group of each fingerprint, ascending.
    """

    def __init__(self, fps: np.ndarray, group: np.ndarray):
        self.levels = [(fps, fps)]
        self.firsts: list[np.ndarray] = []      # first child of each node, by level
        low, high = fps, fps
        while True:
            starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(group)]]))
            if len(starts) == len(group):
                break
            within = np.arange(len(group)) - np.repeat(starts, sizes)
            first = np.flatnonzero(within % FANOUT == 0)
            low, high = np.bitwise_and.reduceat(low, first), np.bitwise_or.reduceat(high, first)
            self.levels.append((low, high))
            self.firsts.append(np.concatenate([first, [len(group)]]))
            group = group[first]

    def _children(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of children, each unordered pair once, and the row of their parents' pair."""
        first = self.firsts[level - 1]
        wide_a, wide_b = first[a + 1] - first[a], first[b + 1] - first[b]
        n = wide_a * wide_b
        row = np.repeat(np.arange(len(a)), n)
        i = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        x, y = first[a][row] + i // wide_b[row], first[b][row] + i % wide_b[row]
        once = (a[row] != b[row]) | (x <= y)
        return x[once], y[once], row[once]

    def links(self, max_bits: int):
        """Yield pairs (i, j) of places within ``max_bits``, some at a time."""
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][0]))
        stack = [(top, roots, roots, np.zeros(len(roots), np.int64), np.zeros(len(roots), np.uint64))]
        while stack:
            level, a, b, differ, seen = stack.pop()
            if level == 0:
                yield a, b
                continue
            if len(a) > PAIRS_AT_A_TIME // (FANOUT * FANOUT):
                half = len(a) // 2
                for part in (slice(half, None), slice(0, half)):
                    stack.append((level, a[part], b[part], differ[part], seen[part]))
                continue
            x, y, row = self._children(level, a, b)
            low, high = self.levels[level - 1]
            shared = ~((low[x] ^ high[x]) | (low[y] ^ high[y]))
            new = shared & ~seen[row]           # bits that no node above has settled
            total = differ[row] + np.bitwise_count((low[x] ^ low[y]) & new)
            keep = total <= max_bits
            if level == 1:
                keep &= x != y
            stack.append((level - 1, x[keep], y[keep], total[keep], shared[keep]))


def group_links(fps: np.ndarray, group: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """One link for each fingerprint to the first one it reaches in its group."""
    parent = np.arange(len(fps))
    if len(fps):
        for a, b in GrayIndex(fps, group).links(max_bits):
            merge(parent, a, b)
    far = np.flatnonzero(parent != np.arange(len(fps)))
    return fps[far], fps[parent[far]]


def find_links(dealt: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(u, v) links that connect all fingerprints within ``max_bits`` of one another."""

    def whole_groups(batches):
        """Arrays of whole groups: the last group of a batch waits for the next."""
        held = np.empty((3, 0), np.int64)
        for batch in batches:
            new = np.stack([c.to_numpy() for c in batch.columns])
            held = np.concatenate([held, new], 1)
            if held.shape[1]:
                last = (held[0] == held[0, -1]) & (held[1] == held[1, -1])
                if not last.all():
                    cut = int(np.flatnonzero(last)[0])
                    yield held[:, :cut]
                    held = held[:, cut:]
        yield held

    def search(batches):
        for mask, key, fp in whole_groups(batches):
            new = np.ones(len(fp), bool)
            new[1:] = (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])
            group = np.cumsum(new)
            paired = np.bincount(group)[group] > 1
            u, v = group_links(fp[paired].view(np.uint64), group[paired], max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))],
                                             names=["u", "v"])

    placed = dealt.withColumn("rank", gray_rank(F.col("fp"))).repartition("mask", "key") \
        .sortWithinPartitions("mask", "key", "rank")
    return placed.select("mask", "key", "fp").mapInArrow(search, "u long, v long")


# --- documents ------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    group_rows: int = GROUP_ROWS) -> DataFrame:
    """Per row: id, fingerprint (16 hex digits) and component id."""
    prints, named = _grouped(docs, id_col, text_col, shingle_words, max_bits, group_rows)
    return prints.join(named, "fp", "left").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("least.id").alias("component_id"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, max_bits: int,
             group_rows: int) -> tuple[DataFrame, DataFrame]:
    """(id, text hash, fp) per row, and per fp its component's least row: by id,
    nulls last, then by text hash."""
    prints = written(add_fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    least = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "body")).alias("least")
    classes = written(prints.groupBy("fp").agg(least), "classes")
    links = find_links(deal(classes, max_bits, group_rows), max_bits)
    roots = components(links).withColumnRenamed("node", "fp")
    placed = classes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    named = placed.select("fp", "root").join(placed.groupBy("root").agg(F.min("least").alias("least")), "root")
    return prints, named.select("fp", "least")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
             group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row of each component: the least id, nulls last, then the least text hash.

    Rows alike in id and text stay once, the least by all columns (by their JSON
    where a map, which has no order, is among them).
    """
    prints, named = _grouped(docs, id_col, text_col, shingle_words, max_bits, group_rows)
    names = [f"_c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)        # so that no column has a name used here
    own_id, own_text = (F.col(names[docs.columns.index(c)]) for c in (id_col, text_col))
    first = named.select("least.id", "least.body").distinct()
    seen = prints.groupBy("id", "body").agg(F.count(F.lit(1)).alias("n"))
    both = lambda a, b: a["id"].eqNullSafe(b["id"]) & (a["body"] == b["body"])
    first = first.join(seen, both(first, seen)).select(
        first["id"].alias("_id"), first["body"].alias("_body"), F.col("n").alias("_n"))
    kept = rows.join(first, own_id.eqNullSafe(F.col("_id")) & (_body(own_text) == F.col("_body")))
    row = F.struct(*names)
    least = F.min_by(row, F.to_json(row)) if "map<" in docs.schema.simpleString() else F.min(row)
    once = kept.filter(F.col("_n") == 1).select(*names)
    again = kept.filter(F.col("_n") > 1).groupBy("_id", "_body").agg(least.alias("_row"))
    return once.unionByName(again.select(*[F.col("_row")[n].alias(n) for n in names])).toDF(*docs.columns)

"""Exact duplicates against grouping by text, on plain and on hard rows."""

import hashlib
import random
from collections import defaultdict

import pytest
from llm_cases import ROWS, empty_docs, hard_docs
from pyspark.sql import functions as F

from gridwave.llm import exact_dedup as ED
from gridwave.session import ship_package

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def plain(rows):
    """(id, keep_id, size, digest) per row, without ``kept``."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for i, t in rows:
        ids = groups[(t or "").translate(LOWER)]
        top = max((x for x in ids if x is not None), default=None)
        out.append((i, top, len(ids), hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest()))
    return sorted(out, key=repr)


def check(df, rows):
    got = df.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == plain(rows)
    stay = defaultdict(list)
    for r in got:
        if r.kept:
            stay[r.text_sha256].append(r)
    assert set(stay) == {r.text_sha256 for r in got}
    assert all(len(x) == 1 and x[0].doc_id == x[0].keep_id for x in stay.values())


@pytest.mark.parametrize("old", ["true", "false", "cast(null AS boolean)", "pmod(xxhash64(doc_id), 2) = 0"])
def test_hard_rows_whatever_is_historical(spark, old):
    check(ED.exact_duplicates(hard_docs(spark), F.expr(old)), [(r[0], r[1]) for r in ROWS])


def test_empty_table(spark):
    df = ED.exact_duplicates(empty_docs(spark), F.lit(True))
    assert df.collect() == [] and df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_hot_text_and_names_that_clash(spark):
    """A text of a third of all rows, which lies in the index and in the new delivery."""
    rng = random.Random(3)
    rows = [(k, "Same" if k % 3 == 0 else f"text {rng.randrange(2000)}" if k % 3 == 1 else f"Text {k}")
            for k in range(6000)]
    df = spark.createDataFrame([(i, t, "x", b"y", 1) for i, t in rows], "doc_id long, text string, digest string, bucket binary, n int")
    check(ED.exact_duplicates(df, F.col("doc_id") % 2 == 0), rows)


def test_ids_of_another_type(spark):
    df = spark.createDataFrame([("a", "one"), ("b", "ONE"), (None, "one"), ("c", "two")], "key string, body string")
    got = {r.key: (r.keep_id, r.group_size, r.kept)
           for r in ED.exact_duplicates(df, F.col("key") == "b", "key", "body").collect()}
    assert got == {"a": ("b", 3, False), "b": ("b", 3, True), None: ("b", 3, False), "c": ("c", 1, True)}


def test_perfect_hash_is_minimal_and_bytes_decide():
    for n in (0, 1, 2, 7, 1000, 20_000):
        held = [hashlib.sha256(b"%d" % k).digest() for k in range(n)]
        sizes, bits = ED.perfect_hash(held)
        slots = ED.slots_of(held, sizes, bits)
        assert sorted(slots.tolist()) == list(range(n))
        by_slot = [held[k] for k in slots.argsort()]
        assert ED.members(held, sizes, bits, by_slot).tolist() == slots.tolist()
        other = [hashlib.sha256(b"x%d" % k).digest() for k in range(1000)]
        assert (ED.members(other, sizes, bits, by_slot) == -1).all()
        # One bit off: the hash may well name a slot, the bytes tell.
        near = [bytes([d[0] ^ 1]) + d[1:] for d in held[:500]]
        assert (ED.members(near, sizes, bits, by_slot) == -1).all()


def test_index_slots_hold_whole_digests_and_locators(spark):
    df = spark.createDataFrame([(k, f"t{k % 50}") for k in range(200)], "doc_id long, text string")
    rows = ED.digest_table(df, "doc_id", "text", F.lit(True))
    held = {}
    for r in ED.build_index(rows, 4).collect():
        assert len(r.digests) == len(r.ids) == len(r.row_nos) == len(r.sizes) == \
            sum(bin(b).count("1") for b in r.bits)
        held |= {bytes(d): (i, n) for d, i, n in zip(r.digests, r.ids, r.sizes)}
    assert held == {hashlib.sha256(b"t%d" % k).digest(): (150 + k, 4) for k in range(50)}

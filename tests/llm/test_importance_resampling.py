"""Importance resampling against a plain version, on plain and on hard rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from llm_cases import ROWS, empty_docs, hard_docs

from gridwave.llm import importance_resampling as IR
from gridwave.session import ship_package

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def features(text, max_n):
    w = words_of(text)
    return [" ".join(w[k:k + n]) for n in range(1, max_n + 1) for k in range(len(w) - n + 1)]


def bucket_of(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def plain(rows, target, max_n=1, buckets=10_000, min_words=20, percent=10, seed=2024):
    """(id, n_features, weight, score) of every row, and the drawn ones in order."""
    s = Counter(bucket_of(f, buckets) for _, t in rows for f in features(t, max_n))
    t = Counter(bucket_of(f, buckets) for x in target for f in features(x, max_n))
    all_s, all_t = sum(s.values()), sum(t.values())
    out, able = [], []
    for i, text in rows:
        feats = features(text, max_n)
        weight = sum(math.floor(1000 * math.log(((t[b] + 1) * (all_s + buckets)) / ((s[b] + 1) * (all_t + buckets))))
                     for b in (bucket_of(f, buckets) for f in feats))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(feats), weight, score))
        if len(words_of(text)) >= min_words:
            able.append((-score, i is not None, i or 0))
    drawn = sorted(able)[:percent * len(able) // 100]
    return sorted(out, key=repr), [(i if has else None, -s) for s, has, i in drawn]


def check(df, rows, target, **how):
    got = df.collect()
    want, drawn = plain(rows, target, **how)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=repr) == want
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == drawn


TARGET = ["The quick brown fox", "epsilon zeta eta", None, "", "wörter UND noch 漢字"]


@pytest.mark.parametrize("how", [{}, {"max_n": 3, "buckets": 97, "min_words": 2, "percent": 50},
                                 {"percent": 100, "min_words": 0, "seed": 7}])
def test_hard_rows(spark, how):
    target = spark.createDataFrame([(t, 1) for t in TARGET], "text string, bucket int")
    check(IR.resample(hard_docs(spark), target, **how), [(r[0], r[1]) for r in ROWS], TARGET, **how)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "text string")
    df = IR.resample(empty_docs(spark), none)
    assert df.collect() == [] and df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    check(IR.resample(hard_docs(spark), none, min_words=1, percent=30), [(r[0], r[1]) for r in ROWS], [],
          min_words=1, percent=30)


def test_ties_and_a_hot_id(spark):
    """Texts and ids that repeat: the scores are equal, the smaller id comes first, ranks have no gaps."""
    rows = [(k % 50 if k % 3 else None, "one two three four five") for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([("two three",)], "text string")
    check(IR.resample(df, target, min_words=5, percent=40), rows, ["two three"], min_words=5, percent=40)


def random_texts(seed, n):
    rng = random.Random(seed)
    letters = ["a", "B", "7", "é", "漢", "\U0001f600", " ", " ", "-", "\n", "_", "Z", "\x7f", "\x00", "bc"]
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 120))) for _ in range(n)] + ["", "x" * 500]


@pytest.mark.parametrize("max_n", [1, 2, 4])
def test_grams_and_hashes_equal_the_library(max_n):
    texts = random_texts(max_n, 300)
    grams = IR.Grams(pa.array([t.encode() for t in texts], pa.binary()), max_n)
    assert grams.words.tolist() == [len(words_of(t)) for t in texts]
    got = sorted((int(d), grams.text(k).decode()) for k, d in enumerate(grams.doc))
    assert got == sorted((d, f) for d, t in enumerate(texts) for f in features(t, max_n))
    hashes = IR.xxh64(grams, grams.start, grams.length)
    assert hashes.tolist() == [xxhash.xxh64_intdigest(grams.text(k)) for k in range(len(grams))]


@pytest.mark.parametrize("mask", [2 ** 64 - 1, 7, 0])
def test_equal_keys_are_told_apart_by_their_bytes(mask):
    """With all keys in a few values, or in one, only the bytes tell n-grams apart."""
    grams = IR.Grams(pa.array([t.encode() for t in random_texts(9, 40)], pa.binary()), 2)
    keys = IR.xxh64(grams, grams.start, grams.length) & np.uint64(mask)
    slots, bucket, count = IR.intern(grams, 0, len(grams), 997, keys)
    by_slot = {}
    for k, s in enumerate(slots.tolist()):
        assert by_slot.setdefault(s, grams.text(k)) == grams.text(k)
    want = Counter(grams.text(k) for k in range(len(grams)))
    assert {by_slot[s]: n for s, n in enumerate(count.tolist())} == want
    assert all(zlib.crc32(t) % 997 == bucket[s] for s, t in by_slot.items())


def test_sliced_batches_and_parts(monkeypatch):
    texts = pa.array([t.encode() for t in random_texts(5, 60)], pa.binary())
    whole = IR.count_buckets(texts, 2, 101)
    monkeypatch.setattr(IR, "OCCURRENCES", 13)
    assert (IR.count_buckets(texts, 2, 101) == whole).all()
    assert (IR.count_buckets(texts.slice(0, 17), 2, 101) + IR.count_buckets(texts.slice(17), 2, 101) == whole).all()
    gains = np.arange(101) - 50
    words, feats, weight = IR.weigh(texts, 2, gains)
    for t, n, w in zip(texts.to_pylist(), feats, weight):
        f = features(t.decode(), 2)
        assert n == len(f) and w == sum(gains[bucket_of(x, 101)] for x in f)

"""Training-data operators against brute force, on plain and on hard rows."""

import hashlib
import functools
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations, zip_longest

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from llm_cases import LONG, PHRASE, ROWS, empty_docs, hard_docs
from sentencepiece import sentencepiece_model_pb2

from conftest import SF_SMALL
from gridwave.llm import (components, decontaminate, language_id, license_scan, lm_scoring, pii,
                          quality_rules, sentencepiece_codec, simhash, token_counts, url_filter)
from gridwave.session import ship_package

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def hard(spark, docs):
    return hard_docs(spark)


@pytest.fixture(scope="module")
def nothing(spark, docs):
    return empty_docs(spark)


def pairs(df):
    """(id, text) of every row, in a fixed order."""
    return [(r.doc_id, r.text) for r in df.collect()]


def key(row):
    return repr(tuple(row))


def same(df, rows):
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    assert got == sorted((tuple(r) for r in rows), key=repr)


# --- 1 decontamination ----------------------------------------------------------------

def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute_overlaps(docs, items, width=decontaminate.OVERLAP):
    """(doc, item) pairs with an aligned window of enough equal words."""
    out = set()
    for i, text in docs:
        w = words_of(text)
        for j, item in items:
            v = words_of(item)
            if len(v) < decontaminate.MIN_ITEM:
                continue
            size = min(width, len(v))
            need = int(np.ceil(decontaminate.SHARE * size))
            for start in range(1 - len(v), len(w)):
                eq = [w[start + k] == v[k] for k in range(max(0, -start), min(len(v), len(w) - start))]
                if any(sum(eq[a:a + size]) >= need for a in range(max(1, len(eq) - size + 1))):
                    out.add((i, j))
                    break
    return out


def test_decontamination_finds_what_brute_force_finds(spark, docs):
    rng = random.Random(4)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").limit(8).collect()]
    items += [(100, "only four words here"), (101, "six plain words make an item"), (102, None), (103, "")]
    vocabulary = [w for _, t in items for w in words_of(t)]
    made = []
    for i in range(60):
        words = list(rng.choice([words_of(t) for _, t in items[:8]]))
        for p in rng.sample(range(len(words)), rng.randint(0, len(words) // 3)):
            words[p] = "zz"
        made.append((i, " ".join(rng.choices(vocabulary, k=9) + words + rng.choices(vocabulary, k=9))))
    made += [(90, "say six plain words make an item now"), (91, "only four words here and no more"), (92, None)]
    table = spark.createDataFrame(made, "doc_id long, text string")
    bench = spark.createDataFrame(items + items[:2], "item_id long, text string")
    want = brute_overlaps(made, items)
    assert len(want) > 20 and (90, 101) in want
    for limit in (decontaminate.BROADCAST_SEEDS, 0):
        got = {(r.id, r.item) for r in decontaminate.overlaps(table, bench, broadcast_seeds=limit).collect()}
        assert got == want


def test_any_three_replacements_in_fifteen_words_are_seen(spark, docs):
    words = [f"w{i}" for i in range(15)]
    rows, n = [], 0
    for a in range(15):
        for b in range(a):
            for c in range(b):
                rows.append((n, " ".join("zz" if k in (a, b, c) else w for k, w in enumerate(words))))
                n += 1
    found = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"),
                                       spark.createDataFrame([(1, " ".join(words))], "item_id long, text string"))
    assert found.count() == n
    assert {r.n_matched for r in found.collect()} == {12}


def test_every_allowed_replacement_in_a_short_item_is_seen(spark):
    """All replacement sets for each length, alone and at a cut edge of the document."""
    items, rows = [], []
    for n in range(decontaminate.MIN_ITEM, 16):
        words = [f"w{n}x{i}" for i in range(n)]
        items.append((n, " ".join(words)))
        lost = n - int(np.ceil(decontaminate.SHARE * n))
        for gone in combinations(range(n), lost):
            made = ["zz" if k in gone else w for k, w in enumerate(words)]
            rows += [(n, " ".join(made)), (n, " ".join(made).removeprefix("zz ").removesuffix(" zz"))]
    table = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(rows)], "doc_id long, n long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (decontaminate.BROADCAST_SEEDS, 0):
        found = decontaminate.overlaps(table, bench, broadcast_seeds=limit)
        assert sorted((r.id, r.item) for r in found.select("id", "item").collect()) \
            == [(i, n) for i, (n, _) in enumerate(rows)]


def test_items_of_few_words_match_whole_or_are_listed(spark):
    bench = spark.createDataFrame([(1, "Paris"), (2, "forty two"), (3, "in the year 1984"), (4, "..."), (5, None),
                                   (6, "one two three four five six"), (1, "Paris")], "item_id long, text string")
    rows = [(1, "Paris, Paris!"), (2, "forty-two"), (3, "forty one two"), (4, "It was in the Year 1984."),
            (5, "in the old year 1984"), (6, "one two three 4 five six"), (7, "paristan"), (8, ""), (9, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.first_word, r.n_matched, r.share) for r in decontaminate.contaminated(table, bench).collect()}
    assert got == {(1, 1, 0, 1, 1.0), (2, 2, 0, 2, 1.0), (4, 3, 2, 4, 1.0), (6, 6, 0, 5, 5 / 6)}
    same(decontaminate.unsearched_items(bench), [(4, 0), (5, 0)])
    longer = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(table, bench, min_item=4).collect()}
    assert longer == {(4, 3), (6, 6)}
    same(decontaminate.unsearched_items(bench, min_item=4), [(1, 1), (2, 2), (4, 0), (5, 0)])
    kept = decontaminate.remove_contaminated(table, bench, min_item=5)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 7, 8, 9]


def test_decontamination_on_hard_rows(spark, hard, nothing):
    bench = spark.createDataFrame([(1, PHRASE), (2, None), (3, "a text without an id that nobody else has written")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.first_word) for r in decontaminate.contaminated(hard, bench).collect()}
    assert got == {(1, 1, 0), (10, 1, 0), (None, 3, 0)}
    kept = decontaminate.remove_contaminated(hard, bench)
    assert kept.columns == hard.columns and kept.count() == len(ROWS) - 4
    assert decontaminate.contaminated(nothing, bench).count() == 0
    assert decontaminate.remove_contaminated(hard, bench.limit(0)).count() == len(ROWS)


def test_decontamination_runs_without_python(spark, docs, capsys):
    decontaminate.contaminated(docs, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).explain()
    quality_rules.quality_report(docs).explain()
    assert not re.search("Python|Pandas|MapInArrow", capsys.readouterr().out)


# --- 2 personal data ------------------------------------------------------------------

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0
            if kind == 2 and not (14 <= len(digits) <= 19 and luhn):
                continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(3)
    parts = list("0123456789") * 2 + list("..@@+--  ()aZ_%é\n") + ["4111111111111111", "192.168.0.1", "a@b.co"]
    for _ in range(30_000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 30)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_base_spans_stay_linear():
    assert pii.base_spans("1" * 200_000 + "@" * 1000 + "a" * 300_000 + "+1" * 10_000 + "1.1." * 50_000)


@pytest.mark.parametrize("which", ["docs", "hard"])
def test_pii_query_columns(request, which):
    table = request.getfixturevalue(which)
    want = []
    for i, text in pairs(table):
        spans = plain_spans(text)
        shown = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        want.append((i, *[sum(k == x for _, k, _ in spans) for x in range(4)], hashlib.sha256(shown.encode()).hexdigest()))
    found = pii.find_pii(table)
    same(found.drop("spans"), want)
    for r in found.collect():
        text = dict(pairs(table))[r.doc_id] if r.doc_id is not None else ""
        base = {f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in plain_spans(text)}
        assert base <= set(r.spans.split(","))


def test_similar_tokens_take_the_label_of_a_base_span(docs):
    field = pii.learn_field(docs)
    text = "call +1 (974) 555-3436 now and later (974) 555-3436 or 974-555-3436, not 2024 nor 4.0"
    base, spans = pii.all_spans(field, [text])[0]
    assert base == [(5, 3, 22)]
    assert [text[a:b] for a, _, b in spans] == ["+1 (974) 555-3436", "(974) 555-3436", "974-555-3436"]
    assert pii.mask(text, spans) == "call [PHONE] now and later [PHONE] or [PHONE], not 2024 nor 4.0"
    assert pii.all_spans(field, ["not 2024 nor 4.0, part 12", None, ""]) == [([], [])] * 3


def test_message_passing_is_exact_on_a_tree():
    rng = np.random.default_rng(5)
    n = 5
    features = rng.integers(0, 2, (n, pii.N_FEATURES)).astype(float)
    features[:, (9, 13)], features[:, (1, 2, 16)] = 1, 0
    features[:, 9] = 1
    edges = np.array([[0, 1], [1, 2]])
    skip = np.array([[1, 3], [3, 4]])
    g = pii.Graph(np.zeros((n, 3), int), features, np.zeros(n, int), edges, skip)
    table = rng.normal(size=(5, 5))
    field = pii.Field(rng.normal(size=(pii.N_FEATURES, 5)), rng.normal(size=(5, 5)), table + table.T)
    node = features @ field.node + pii._form(features)
    want = np.zeros((n, 5))
    for labels in np.ndindex(*[5] * n):
        s = sum(node[i, y] for i, y in enumerate(labels))
        s += sum(field.chain[labels[a], labels[b]] for a, b in edges)
        s += sum(field.skip[labels[a], labels[b]] for a, b in skip)
        for i, y in enumerate(labels):
            want[i, y] += np.exp(s)
    got = pii.marginals(field, g, rounds=200)
    assert np.allclose(got, want / want.sum(1, keepdims=True), atol=1e-2)


def chain_of_mentions(n):
    """``n`` mentions of one number whose own features say nothing, the first in a base span."""
    features = np.zeros((n, pii.N_FEATURES))
    features[:, 5] = 1
    skip = np.stack([np.arange(n - 1), np.arange(1, n)], 1)
    g = pii.Graph(np.zeros((n, 3), int), features, np.array([4] + [0] * (n - 1)), np.empty((0, 2), int), skip)
    weights = np.zeros((pii.N_FEATURES, 5))
    weights[5, 0] = 0.2
    return pii.Field(weights, np.zeros((5, 5)), 8 * np.eye(5) - 4), g


def test_evidence_reaches_a_hundred_mentions():
    field, g = chain_of_mentions(100)
    node = g.features @ field.node + pii._form(g.features)
    node[0, 4] += pii.EVIDENCE
    left, right, pair = np.zeros((100, 5)), np.zeros((100, 5)), np.exp(field.skip)
    for i in range(1, 100):
        left[i] = np.log(np.exp(node[i - 1] + left[i - 1]) @ pair)
        left[i] -= left[i].max()
        right[99 - i] = np.log(pair @ np.exp(node[100 - i] + right[100 - i]))
        right[99 - i] -= right[99 - i].max()
    want = np.exp(node + left + right)
    want /= want.sum(1, keepdims=True)
    got, done = pii.passed_messages(field, g)
    assert done.all() and np.allclose(got, want, atol=1e-2)
    assert not pii.passed_messages(field, g, rounds=1)[1].any()


def test_long_texts_come_to_rest_whatever_is_beside_them(docs):
    field = pii.learn_field(docs)
    long = "call +1 (974) 555-3436 now" + " and (974) 555-3436 too" * 3000
    short = "call +1 (974) 555-3436 now and later (974) 555-3436"
    assert pii.converged(field, [long, short, None, ""]) == [True] * 4
    (_, a), (_, b) = pii.all_spans(field, [long, short])
    assert (a, b) == (pii.all_spans(field, [long])[0][1], pii.all_spans(field, [short])[0][1])
    assert len(a) == 3001 and len(b) == 2
    assert pii.unsettled(docs).count() == 0


def test_masking_keeps_rows_and_columns(hard, nothing):
    masked = pii.mask_pii(hard)
    assert masked.columns == hard.columns and masked.count() == len(ROWS)
    texts = [t for i, t in pairs(masked) if i == 7]
    assert texts == ["mail [EMAIL] or [PHONE] from [IP], card [CARD]. Later [PHONE] once more."] * 2 \
        or texts[0].startswith("mail [EMAIL] or [PHONE] from [IP], card [CARD].")
    assert pii.mask_pii(nothing).count() == 0 and pii.find_pii(nothing).count() == 0


# --- 3 token counts, 6 piece ids -------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


ALPHABET = list(" \n\r\tabcthe{}();éüß漢\U0001f600<s>\x00​.,12▁") + [
    "the", "  ", "    ", "\r\n", "</s>", " a", "ation", "ing", "er", "on", "an"]


def random_texts(n, rng=None):
    rng = rng or random.Random(1)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 14))) for _ in range(n)] + [
        "".join(rng.choices(ALPHABET, k=300)).replace(" ", "") for _ in range(20)]


def test_lengths_equal_the_library(library):
    with open(MODEL, "rb") as f:
        lengths = token_counts.Lengths(f.read(), {})
    for text in random_texts(5000):
        assert lengths.count(text) == len(library.encode(text)), text


@pytest.mark.parametrize("which", ["docs", "hard"])
def test_token_counts(request, which, library):
    table = request.getfixturevalue(which)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t in pairs(table)]
    same(token_counts.count_tokens(table, MODEL), want)
    same(token_counts.count_tokens(table, MODEL, n_frequent=3), want)


def test_token_counts_of_nothing(nothing):
    assert token_counts.count_tokens(nothing, MODEL).count() == 0


def test_frequent_pre_tokens_are_the_most_frequent(docs):
    seen = Counter(t for _, text in pairs(docs) for t in token_counts.pre_tokens(text))
    best = sorted(seen, key=lambda t: (-seen[t], t))[:50]
    assert token_counts.frequent_pre_tokens(docs, n_frequent=50, n_candidates=10**6) == best


def test_piece_ids_equal_the_library(library):
    with open(MODEL, "rb") as f:
        codec = sentencepiece_codec.Codec(sentencepiece_codec.Pieces(f.read()))
    texts = random_texts(5000) + [LONG, "x" * 50_000, "漢字" * 3000, "a" * 63, "b" * 64, "c" * 65]
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids.tolist() == library.encode(text), text[:80]
        assert codec.decode(ids.tolist()) == text.replace("▁", " ")


def test_long_words_leave_the_cache_in_order(library):
    with open(MODEL, "rb") as f:
        codec = sentencepiece_codec.Codec(sentencepiece_codec.Pieces(f.read()))
    for texts in (["one two " + "y" * 200], ["two three " + "z" * 90 + " one", "y" * 200], ["three four one"]):
        assert [x.tolist() for x in codec.encode(texts)] == library.encode(texts)
        assert max(map(len, codec.number)) <= sentencepiece_codec.LONG_WORD
    assert len(codec.ends) == len(codec.number) + 1


def test_search_by_score_equals_the_library_for_unigram_models():
    """The same vocabulary as a unigram model, with scores that floats hold exactly."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = sentencepiece_codec.UNIGRAM
    rng = random.Random(2)
    for piece in proto.pieces:
        if piece.type == 1:
            piece.score = -rng.randint(1, 4000) / 4 - 250 * (len(piece.piece) == 1)
    model = proto.SerializeToString()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    codec = sentencepiece_codec.Codec(sentencepiece_codec.Pieces(model))
    texts = random_texts(2000)
    differ = [t for t, ids in zip(texts, codec.encode(texts))
              if ids.tolist() != library.encode(t)]
    assert not differ


@pytest.mark.parametrize("which", ["docs", "hard"])
def test_encode_and_decode_tables(request, which, library):
    table = request.getfixturevalue(which)
    coded = sentencepiece_codec.encode_texts(table, MODEL, keep=("lang",))
    same(coded.select("doc_id", "ids", "n_ids", "round_trip"),
         [(i, ids := library.encode(t or ""), len(ids), True) for i, t in pairs(table)])
    same(sentencepiece_codec.decode_ids(coded, MODEL), [(i, t or "") for i, t in pairs(table)])


def test_encode_nothing(nothing):
    coded = sentencepiece_codec.encode_texts(nothing, MODEL)
    assert coded.count() == 0 and sentencepiece_codec.decode_ids(coded, MODEL).count() == 0


# --- 4 SimHash ------------------------------------------------------------------------

def plain_fingerprint(text, size=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, bits=2):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("which", ["docs", "hard"])
@pytest.mark.parametrize("group_rows", [simhash.GROUP_ROWS, 2])
def test_near_duplicates(request, which, group_rows):
    table = request.getfixturevalue(which)
    rows = pairs(table)
    fps = [plain_fingerprint(t) for _, t in rows]
    least = defaultdict(list)
    roots = plain_components(fps)
    for (i, _), root in zip(rows, roots):
        if i is not None:
            least[root].append(i)
    want = [(i, f"{fp:016x}", min(least[root], default=None)) for (i, _), fp, root in zip(rows, fps, roots)]
    same(simhash.near_duplicates(table, group_rows=group_rows), want)


def test_keep_one_of_each_group(hard, nothing):
    kept = simhash.keep_one(hard)
    assert kept.columns == hard.columns
    # 2, 3 and 4 have no words; 10 copies 1; 7 and the row without id are repeated.
    same(kept.select("doc_id"), [(i,) for i in (1, 2, 5, 6, 7, 8, 9, None, 11, 12)])
    assert simhash.keep_one(nothing).count() == 0 and simhash.near_duplicates(nothing).count() == 0


def test_gray_index_finds_every_pair():
    rng = np.random.default_rng(1)
    for trial in range(10):
        base = rng.integers(0, 2**63, 6, dtype=np.uint64)
        fps = []
        for _ in range(300):
            x = int(rng.choice(base))
            for _ in range(rng.integers(0, 6)):
                x ^= 1 << int(rng.integers(0, 64))
            fps.append(x)
        fps = np.unique(np.array(fps, np.uint64))
        gray = fps.copy()
        for s in (1, 2, 4, 8, 16, 32):
            gray ^= gray >> np.uint64(s)
        fps = fps[np.argsort(gray)]
        group = np.sort(rng.integers(0, 3, len(fps)))
        found = {(int(i), int(j)) for a, b in simhash.GrayIndex(fps, group).links(2) for i, j in zip(a, b)}
        want = {(i, j) for j in range(len(fps)) for i in range(j)
                if group[i] == group[j] and bin(int(fps[i] ^ fps[j])).count("1") <= 2}
        assert found == want


def test_masks_cover_every_pair_at_every_level():
    masks = simhash.thirds(simhash.ALL_BITS, 3)
    for _ in range(2):
        for m, below in simhash.deeper(masks, 3).items():
            assert len(below) == 3
            free = simhash.ALL_BITS & ~m
            rest = [b & ~m for b in below]
            assert rest[0] | rest[1] | rest[2] == free and rest[0] & rest[1] == rest[1] & rest[2] == 0
        masks = [x for xs in simhash.deeper(masks, 3).values() for x in xs]


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(7, 7), (None, 3)]
    got = dict(tuple(r) for r in components.components(spark.createDataFrame(links, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + k: 1000 for k in range(1, 300)}}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_keep_one_with_a_map_among_the_columns(spark, docs):
    table = spark.sql("""SELECT * FROM VALUES (1, 'a b c d', map('k', 2), 'x'), (1, 'a b c d', map('k', 1), 'y'),
        (2, 'A B C D', map('k', 0), 'z'), (3, 'quite another text', null, 'w') AS t(doc_id, text, fp, body)""")
    got = sorted((r.doc_id, r.fp, r.body) for r in simhash.keep_one(table).collect())
    assert got == [(1, {"k": 1}, "y"), (3, None, "w")]


# --- 5 language model ------------------------------------------------------------------

def plain_scores(rows, leave_out=False):
    texts = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) for _, t in rows]
    grams = lambda w: Counter(tuple(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))
    every = sum(map(grams, texts), Counter())
    out = []
    for (i, _), w in zip(rows, texts):
        own = grams(w) if leave_out else Counter()
        counts = lambda gram: every[gram] - own[gram]
        total = sum(map(len, texts)) - (len(w) if leave_out else 0)
        score, short = 0.0, 0
        for k in range(len(w)):
            for n in range(min(3, k + 1), 0, -1):
                gram = tuple(w[k - n + 1:k + 1])
                if n == 1 or counts(gram):
                    score += np.log(counts(gram) / counts(gram[:-1]) if n > 1 else max(counts(gram), 1) / max(total, 1))
                    score += np.log(lm_scoring.BACKOFF) * (min(3, k + 1) - n)
                    short += n < min(3, k + 1)
                    break
        out.append((i, len(w), score, short))
    return out


@pytest.mark.parametrize("which", ["docs", "hard"])
@pytest.mark.parametrize("block_bytes,leave_out", [(lm_scoring.BLOCK_BYTES, False), (5000, False), (5000, True)])
def test_scores(request, which, block_bytes, leave_out):
    table = request.getfixturevalue(which)
    found = lm_scoring.score_documents(table, block_bytes=block_bytes, leave_out=leave_out)
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    want = sorted(plain_scores(pairs(table), leave_out), key=repr)
    assert leave_out == any(w[3] for w in want)
    by = lambda r: (r[0] is None, r[0] or 0, r[1])
    for g, w in zip_longest(sorted(got, key=by), sorted(want, key=by)):
        assert (g[0], g[1], g[4]) == (w[0], w[1], w[3])
        assert g[2] == pytest.approx(w[2], abs=1e-3)
        assert g[3] == (pytest.approx(w[2] / w[1], abs=1e-3) if w[1] else None)


def test_hashes_of_n_grams_stay_apart_where_48_bits_do_not():
    """40 million different bigrams: some share 48 bits of their hash, none all 64."""
    left = np.arange(1, 6_400, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    words = np.empty((6_300, 2 * len(left)), np.uint64)
    words[:, 0::2] = left
    words[:, 1::2] = (np.arange(7_000, 13_300, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))[:, None]
    words = words.ravel()
    keys = lm_scoring.gram_hashes(words, np.full(len(words) // 2, 2), 2)[1][0]
    assert len(keys) == 6_300 * 6_399
    keys.sort()
    assert (keys[1:] != keys[:-1]).all()
    short = keys >> np.uint64(16)
    assert (short[1:] == short[:-1]).any()


def test_packed_keys_keep_their_values():
    rng = np.random.default_rng(5)
    for n in (1, 2, 300, 20_000):
        keys = np.unique(rng.integers(0, 2 ** 64, n, np.uint64))
        assert (lm_scoring.unpack_keys(lm_scoring.pack_keys(keys)) == keys).all()
    edge = np.array([0, 1, 2 ** 40 - 1, 2 ** 40, 255 * 2 ** 40, 2 ** 64 - 1], np.uint64)
    assert (lm_scoring.unpack_keys(lm_scoring.pack_keys(edge)) == edge).all()


def test_rows_that_repeat_fill_many_blocks(spark, docs):
    """A third of all rows alike in id and text: no block holds them all."""
    rows = [(None, "the same old line")] * 400 + [(k, f"line {k} of its own") for k in range(800)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    blocks = lm_scoring.text_blocks(table, "doc_id", "text", 200)
    assert blocks.agg(lm_scoring.F.max(lm_scoring.F.size("ids"))).first()[0] <= 20
    got = sorted((tuple(r) for r in lm_scoring.score_documents(table, block_bytes=200).collect()), key=repr)
    assert [(g[0], g[1], g[4]) for g in got] == sorted([(i, len(t.split()), 0) for i, t in rows], key=repr)
    same_line = plain_scores(rows)[0][2]
    assert all(g[2] == pytest.approx(same_line, abs=1e-3) for g in got if g[0] is None)


def test_scores_of_nothing(nothing):
    assert lm_scoring.score_documents(nothing).count() == 0


# --- 7 URL filters --------------------------------------------------------------------

def test_url_filter_as_of(spark, docs):
    entries = spark.createDataFrame([
        ("example.com", "2024-02-01", "add", "spam"), ("example.com", "2024-03-01", "remove", "spam"),
        ("example.com", "2024-04-01", "add", "adult"), ("bad.example.com", "2024-01-01", "add", "malware"),
        ("tie.org", "2024-01-01", "add", "spam"), ("tie.org", "2024-01-01", "remove", "spam"),
        (None, "2024-01-01", "add", "spam"), ("x.org", None, "add", "spam"), ("y.org", "2024-01-01", None, "spam"),
    ], "pattern string, day string, action string, category string").selectExpr(
        "pattern", "cast(day as date) day", "action", "category")
    captures = [
        (1, "http://example.com/a", "2024-01-31", ""), (2, "http://example.com/a", "2024-02-01", "spam"),
        (3, "https://www.EXAMPLE.com:8080/?q", "2024-02-29", "spam"), (4, "http://example.com", "2024-03-01", ""),
        (5, "http://u@bad.example.com./x", "2024-05-01", "adult,malware"), (6, "http://notexample.com", "2024-02-05", ""),
        (7, "http://tie.org", "2024-06-01", ""), (8, None, "2024-02-05", ""), (9, "no url", "2024-02-05", ""),
        (10, "http://example.com", None, ""), (None, "http://example.com", "2024-02-10", "spam"),
        (2, "http://example.com/a", "2024-02-01", "spam"), (11, "http://x.org", "2024-02-05", ""),
        (12, "http://y.org", "2024-02-05", ""), (13, "", "2024-02-05", "")]
    table = spark.createDataFrame([(i, u, d, "?", "?") for i, u, d, _ in captures],
                                  "page_id long, url string, day string, host string, blocked string") \
        .selectExpr("page_id", "url", "cast(day as date) seen", "host", "blocked")
    found = url_filter.evaluate(table, entries, "page_id", "url", "seen")
    same(found.select("page_id", "blocked", "categories"), [(i, c != "", c) for i, _, _, c in captures])
    assert url_filter.evaluate(table.limit(0), entries, "page_id", "url", "seen").count() == 0
    assert url_filter.evaluate(table, entries.limit(0), "page_id", "url", "seen").filter("blocked").count() == 0


def test_hosts_of_many_labels_are_blocked_by_every_domain_above(spark):
    host = "a." * 300 + "bad.com"
    captures = spark.createDataFrame([(1, f"http://{host}/x"), (2, "http://good.com/")], "id long, url string") \
        .withColumn("day", url_filter.F.lit("2024-05-01").cast("date"))
    for pattern in ("bad.com", "com", "a." * 200 + "bad.com", host):
        entries = spark.createDataFrame([(pattern, "add", "spam")], "pattern string, action string, category string") \
            .withColumn("day", url_filter.F.lit("2024-01-01").cast("date"))
        found = {r.id: r.blocked for r in url_filter.evaluate(captures, entries, "id", "url", "day").collect()}
        assert found == {1: True, 2: pattern == "com"}


# --- 8 languages ----------------------------------------------------------------------

def test_languages_of_held_out_documents(spark, docs):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs = {r.doc_id: r.lang for r in table.select("doc_id", "lang").collect()}
    rows = language_id.identify(table).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_do_not_see_the_label(spark, docs):
    blind = docs.withColumn("lang", language_id.F.when(~language_id.held_out("doc_id"), docs.lang))
    assert sorted(map(key, language_id.identify(blind).collect())) == sorted(map(key, language_id.identify(docs).collect()))


def test_marks_are_no_letters():
    assert language_id.words_of("²½ 12_³ Été a²") == ["été", "a²"]
    assert language_id.words_of(None) == language_id.words_of("") == []


def test_words_of_mixed_text_get_their_own_language():
    texts = {"en": "the cat and the dog with the house", "de": "der Hund und die Katze mit dem Haus"}
    runs = [(lang, language_id.words_of(t)) for lang, t in texts.items()] * 20
    model = language_id.fit(runs)
    words = language_id.Labeller(model).label_words("the cat and the dog und die Katze mit dem Haus")
    assert [lang for _, lang in words] == ["en"] * 5 + ["de"] * 6


def test_forward_backward_is_exact():
    rng = np.random.default_rng(3)
    model = language_id.Model(["a", "b", "c"], None, {}, rng.normal(size=3), rng.normal(size=(3, 3)))
    score = rng.normal(size=(6, 3))
    sizes = np.array([4, 2, 1])
    ids = np.array([0, 1, 2, 3, 4, 5, 0])
    gamma, text, _ = language_id.forward_backward(model, np.exp(score), ids, sizes)
    place = language_id.step_major(sizes)[2]
    for t, (begin, n) in enumerate(zip((0, 4, 6), sizes)):
        want = np.zeros((n, 3))
        for labels in np.ndindex(*[3] * n):
            s = model.start[labels[0]] + sum(score[ids[begin + i], y] for i, y in enumerate(labels))
            s += sum(model.trans[a, b] for a, b in zip(labels, labels[1:]))
            for i, y in enumerate(labels):
                want[i, y] += np.exp(s)
        want /= want.sum(1, keepdims=True)
        assert np.allclose(gamma[(text == t)][np.argsort(place[text == t])], want)


def test_languages_of_hard_rows(hard, nothing):
    found = language_id.identify(hard).collect()
    assert len(found) == len(ROWS)
    for r in found:
        if r.doc_id in (2, 3, 4, 11):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert language_id.identify(nothing).count() == 0
    unlabelled = hard.withColumn("lang", language_id.F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


# --- 9 quality rules ------------------------------------------------------------------

def plain_quality(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    starts = defaultdict(list)
    for i in range(len(w) - 7):
        starts[tuple(w[i:i + 8])].append(i)
    again = len({i + k for at in starts.values() if len(at) > 1 for i in at for k in range(8)})
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    chars, symbols, dup = sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines))
    failed = len(w) < 20 or 100 * again > 30 * len(w)
    kept = not failed and 100 * symbols <= 25 * len(w) and 100 * dup <= 30 * len(lines) \
        and 2 * len(w) <= chars <= 15 * len(w)
    return len(w), chars, symbols, dup, again, failed, kept


@pytest.mark.parametrize("which", ["docs", "hard"])
def test_quality_report(request, which):
    table = request.getfixturevalue(which)
    rows = pairs(table)
    same(quality_rules.quality_report(table), [(i, *plain_quality(t)) for i, t in rows])
    kept = quality_rules.keep_good(table)
    assert kept.columns == table.columns
    same(kept.select("doc_id"), [(i,) for i, t in rows if plain_quality(t)[-1]])


def test_verdicts_do_not_hang_on_the_order(docs, nothing):
    F = quality_rules.F
    text = F.coalesce(F.col("text"), F.lit(""))
    one, two = (docs.filter(quality_rules.cascade(text, o)).select("doc_id").collect()
                for o in (quality_rules.RULES, quality_rules.RULES[::-1]))
    assert sorted(one) == sorted(two)
    assert quality_rules.quality_report(nothing).count() == 0 and quality_rules.keep_good(nothing).count() == 0


def test_rules_run_by_rejections_per_cost(spark, docs, monkeypatch):
    made = {"few_words": (4.0, 0.4), "repeats": (1.0, 0.2), "symbols": (1.0, 0.0),
            "dup_lines": (1.0, 0.2), "word_length": (0.5, 0.3)}
    monkeypatch.setattr(quality_rules, "measure", lambda sample, rules: [
        quality_rules.Measured(r, *made[r.name]) for r in rules])
    order = quality_rules.rule_order(docs, "doc_id", "text")
    assert [r.name for r in order] == ["word_length", "dup_lines", "repeats", "few_words", "symbols"]


def test_the_order_of_rules_is_the_same_in_every_run(docs):
    orders = {tuple(r.name for r in quality_rules.rule_order(docs, "doc_id", "text")) for _ in range(10)}
    assert len(orders) == 1


def test_rules_count_what_those_before_them_leave(spark):
    """``symbols`` costs least; of what it leaves ``repeats`` rejects nothing, though of all texts it rejects two."""
    good = " ".join(f"word{i}" for i in range(30))
    bad = "#### aa bb cc dd ee ff gg hh " * 4
    table = spark.createDataFrame([(good,), (good + " x",), (bad,), (bad + " #",), ("few words",)], "_text string")
    found = quality_rules.measure(table, [r for r in quality_rules.RULES if r.name in ("symbols", "repeats", "few_words")])
    assert [m.rule.name for m in found] == ["few_words", "symbols", "repeats"]
    assert [round(5 * m.rejected) for m in found] == [1, 2, 0]
    assert quality_rules.asked_for(quality_rules.BASE_RULES[1]) == {"_h", "_win", "_order", "_starts", "n_repeat_words"}
    assert quality_rules.measure(table.limit(0), quality_rules.RULES)[0].rejected == 0


def test_rejected_texts_are_not_looked_at_again(spark, docs):
    """A rule that fails on what an earlier rule rejects never meets it."""
    F = quality_rules.F
    first = quality_rules.Rule("empty", lambda get: F.length(get("_text")) == 0)
    strict = quality_rules.Rule("strict", lambda get: F.when(F.length(get("_text")) == 0, F.raise_error(F.lit("looked")))
                                .otherwise(F.lit(False)).cast("boolean"))
    table = spark.createDataFrame([("",), ("a",)], "t string")
    assert table.filter(quality_rules.cascade(F.col("t"), [first, strict])).count() == 1
    with pytest.raises(Exception, match="looked"):
        table.filter(quality_rules.cascade(F.col("t"), [strict, first])).collect()


def test_every_label_is_learned_however_many(spark):
    """90 labels, the later ones rare; each has words of its own."""
    rng = random.Random(8)
    own = [["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(8)] for _ in range(90)]
    rows = [(f"l{k:02}", " ".join(rng.choices(own[k], k=30))) for k in range(90) for _ in range(20 if k < 70 else 8)]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    found = {r.doc_id: r.lang_pred for r in language_id.identify(table).collect()}
    right = [found[i] == lang for i, (lang, _) in enumerate(rows)]
    assert {found[i] for i in found} == {f"l{k:02}" for k in range(90)}
    assert sum(right) > 0.95 * len(rows)


# --- 10 licences ----------------------------------------------------------------------

def plain_base(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    at = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        at += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    starts = [i for i, _ in at]
    return (len(words), len(at), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in at})))


@pytest.mark.parametrize("which", ["docs", "hard"])
def test_license_base_columns(request, which):
    table = request.getfixturevalue(which)
    found = license_scan.scan_licenses(table)
    same(found.drop("labels", "score"), [(i, *plain_base(t)) for i, t in pairs(table)])
    for r in found.collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


@pytest.mark.parametrize("text,base,labels", [
    ("Licensed under CC BY-NC 4.0.", "", "cc-by-nc"),
    ("x y z Licensed under the APACHE LICENSE, version 2.0 and the MIT license", "apache,mit", "apache,mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are hereby allowed "
     "that the following conditions are met", "", "bsd"),
    ("terms of the Mozilla Public License, v. 2.0. This Source Code Form", "", ""),
    ("by nc cc licensed under", "", ""),
    ("KIT license mitK license", "", ""),
    ("general public license general public license", "gpl", "gpl"),
    ("", "", ""),
    (None, "", ""),
])
def test_license_labels(spark, docs, text, base, labels):
    idf = defaultdict(lambda: 1.0)
    scanner = license_scan.Scanner(license_scan.notices(), idf)
    found = scanner.scan(text.encode() if text is not None else None)
    assert (found[4], found[5]) == (base, labels)


def plain_in_order(notice, words, start):
    """Longest common subsequence by trying, for each place, to use or to pass over it."""
    @functools.cache
    def best(i, at):
        if i == len(notice):
            return 0
        found = best(i + 1, at)
        for p in range(max(0, at, start + i - license_scan.BAND), min(len(words), start + i + license_scan.BAND + 1)):
            if words[p] == notice[i]:
                found = max(found, 1 + best(i + 1, p + 1))
        return found
    return best(0, -10_000)


def every_start(scanner, words):
    """Labels of the notices that pass at some start, by trying all of them."""
    out, band = set(), license_scan.BAND
    for n in scanner.notices:
        for start in range(1 - len(n.words) - band, len(words) + band):
            if all(any(begin >= 0 and tuple(words[begin:begin + len(p)]) == p
                       for begin in range(start + at - band, start + at + band + 1)) for at, p in n.phrases):
                if plain_in_order(n.words, words, start) >= license_scan.MIN_SHARE * len(n.words):
                    out.add(n.label)
    return out


def test_license_labels_are_those_of_every_start():
    """Notices with changed words, under IDFs that favour the changed ones."""
    templates = license_scan.TEMPLATES + [
        ("free", "one two three four five six seven eight nine ten eleven twelve thirteen", []),
        ("same", "again and again and again and again and again", []), ("word", "copyleft", ["copyleft"])]
    found = [n for n in license_scan.notices(templates) if len(n.words) < 40]
    rng = random.Random(10)
    hits = 0
    for case in range(400):
        notice = rng.choice(found)
        words = list(notice.words)
        for at in rng.sample(range(len(words)), rng.randint(0, int(0.35 * len(words)))):
            words[at] = b"zz"
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randrange(len(words) + 1)
            words[at:at + 1] = rng.choice([[], [b"zz", *words[at:at + 1]]])
        if case % 5 == 0:
            words = words[rng.randint(0, 2):]
        held = set(words)
        words = [b"x"] * rng.randint(0, 2) + words + [b"x"] * rng.randint(0, 2)
        idf = defaultdict(lambda: 9.0, {w: 1.0 for w in held})
        scanner = license_scan.Scanner(found, idf)
        want = every_start(scanner, words)
        assert {label for label, _ in scanner.notices_at(words)} == want
        hits += bool(want)
    assert hits > 130


def test_one_word_put_in_or_left_out_is_still_labelled():
    """At every place outside the mandatory phrases, of every notice; the phrases must stay whole."""
    found = license_scan.notices()
    scanner = license_scan.Scanner(found, defaultdict(lambda: 1.0))
    for n in found:
        inside = {at + i for at, p in n.phrases for i in range(len(p))}
        for at in range(len(n.words)):
            if at not in inside:
                left = list(n.words[:at] + n.words[at + 1:])
                if len(left) >= license_scan.MIN_SHARE * len(n.words):
                    assert n.label in dict(scanner.notices_at([b"x", *left, b"x"])), (n.label, at)
            if not {at - 1, at} <= inside:
                more = [*n.words[:at], b"either", *n.words[at:]]
                assert dict(scanner.notices_at(more))[n.label] == 1.0, (n.label, at)


def test_license_variant_without_the_rarest_words(spark):
    text = ("Redistribution and use in source and binary forms, with or without modification, are allowed "
            "provided that the named terms are met")
    table = spark.createDataFrame([(i, text) for i in range(3)] + [(9, "and or are the that")], "doc_id long, text string")
    found = {r.doc_id: r.labels for r in license_scan.scan_licenses(table).collect()}
    assert found == {0: "bsd", 1: "bsd", 2: "bsd", 9: ""}


def test_licenses_of_nothing(nothing):
    assert license_scan.scan_licenses(nothing).count() == 0

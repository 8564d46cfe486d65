"""SentencePiece encoding and decoding by a batched numpy Viterbi search.

A text is cut into pre-tokens (a run of spaces with what follows it; no piece
reaches over such a border), and only the distinct pre-tokens of a batch are
searched.  Those of equal length advance together, character by character:
rolling hashes of all substrings that end at a place probe the sorted keys of
the pieces, a vectorised maximum keeps the best way to end there, and its piece
is the backpointer.

What is maximised depends on the model's kind, so that ids equal the library's:

* unigram: the sum of piece scores; of equal sums the earlier start wins.
* BPE: a piece scores 0 behind a piece it is compatible with, else minus
  infinity.  Two pieces are compatible if merging their joined text never
  merges across their border.  Exactly one way to end at each place has only
  compatible neighbours and pieces that merge back to themselves, and that is
  the merge result.

A character that is no piece itself is spelt in byte pieces.  Decoding joins
pieces and bytes and drops the space that encoding puts in front, so
``decode(encode(t)) == t`` for every text without U+2581, the mark of a space.

A null or empty text has no ids and decodes to the empty text.  Repeated rows
are encoded each.  An empty table gives no rows.  Of the extra columns only those
in ``keep`` are read; one named like a column made here cannot be among them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from gridwave.llm.common import per_row, type_of
from gridwave.llm.token_counts import SPACE, check_borders, pre_tokens

UNIGRAM, BPE = 1, 2             # model kinds, as model files number them (fixed values)
UNKNOWN_COST = 10.0             # below the lowest score, as the library has it (fixed value)
BASE = 1_000_003
WRAP = (1 << 64) - 1
SPREAD = 0x9E3779B97F4A7C15     # odd, so that spreading keys over the buckets keeps them distinct
BUCKET_BITS = 20
CACHED_WORDS = 500_000
LONG_WORD = 64                  # longer words are searched one by one and not kept
SEARCH_CELLS = 1_000_000        # words x characters searched together
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>$")


def hash_text(text: str) -> int:
    h = 0
    for c in text:
        h = (h * BASE + ord(c) + 1) & WRAP
    return h


class Pieces:
    """The vocabulary as arrays, sorted by spread hash key; row numbers name pieces."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        check_borders(sp)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        self.kind = proto.trainer_spec.model_type
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError(f"models of kind {self.kind} have no pieces to search")
        texts = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.raw = [p.replace(SPACE, " ").encode() for p in texts]
        self.byte_ids = np.zeros(256, np.int32)
        normal = []
        for i, text in enumerate(texts):
            if sp.is_byte(i):
                value = int(BYTE_PIECE.search(text)[1], 16)
                self.byte_ids[value] = i
                self.raw[i] = bytes([value])
            elif sp.is_control(i):
                self.raw[i] = b""
            elif not sp.is_unknown(i):
                normal.append(i)
        normal.sort(key=lambda i: hash_text(texts[i]) * SPREAD & WRAP)
        mine = [texts[i] for i in normal]
        self.ids = np.array(normal, np.int32)
        self.keys = np.array([hash_text(t) for t in mine], np.uint64)
        if len(np.unique(self.keys)) != len(mine):
            raise ValueError("two pieces share a hash key")
        self.scores = np.array([sp.get_score(i) for i in normal], np.float32)
        self.unknown = np.float32(self.scores.min() - np.float32(UNKNOWN_COST))
        self.sizes = np.array([len(t) for t in mine])
        self.longest = int(self.sizes.max())
        self.spelt = np.zeros((len(mine), self.longest), np.uint32)
        for row, text in zip(self.spelt, mine):
            row[:len(text)] = [ord(c) for c in text]
        self.power = np.array([pow(BASE, i, 1 << 64) for i in range(self.longest + 1)], np.uint64)
        bucket = self._bucket(self.keys)
        self.first = np.searchsorted(bucket, np.arange((1 << BUCKET_BITS) + 1)).astype(np.int32)
        self.deepest = int(np.diff(self.first).max())
        if self.kind == BPE:
            self._undo_merges(mine)

    def _undo_merges(self, mine: list[str]) -> None:
        """The two rows each piece was merged from last, and which pieces merge back."""
        row = {t: i for i, t in enumerate(mine)}
        score = self.scores.tolist()
        n = len(mine)
        self.left, self.right = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        self.whole = np.zeros(n, bool)
        for i, text in enumerate(mine):
            parts = list(text)
            while len(parts) > 1:
                pairs = [(-score[row[a + b]], at) for at, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in row]
                if not pairs:
                    break
                at = min(pairs)[1]
                last = parts[at:at + 2]
                parts[at:at + 2] = ["".join(last)]
            if len(parts) == 1:
                self.whole[i] = True
                if len(text) > 1:
                    self.left[i], self.right[i] = row[last[0]], row[last[1]]
        # When a piece comes about in the merging: characters are there at once.
        self.made = np.where(self.left >= 0, self.scores, np.inf)
        self.pairs = np.full(1 << BUCKET_BITS, -1, np.int64)
        self.pair_ok = np.zeros(1 << BUCKET_BITS, bool)

    @staticmethod
    def _bucket(hashes: np.ndarray) -> np.ndarray:
        return ((hashes * np.uint64(SPREAD)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash key, -1 where no piece has it."""
        bucket = self._bucket(hashes)
        at, end = self.first[bucket], self.first[bucket + 1]
        out = np.full(len(hashes), -1, np.int32)
        for _ in range(self.deepest):
            live = np.flatnonzero(at < end)
            if not len(live):
                break
            same = live[self.keys[at[live]] == hashes[live]]
            out[same] = at[same]
            at = at + 1
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``undo_all`` with a table of pairs met before, a newer one over an older."""
        pair = a.astype(np.int64) * len(self.keys) + b
        slot = ((pair.astype(np.uint64) * np.uint64(SPREAD)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        ok = self.pair_ok[slot]
        new = np.flatnonzero(self.pairs[slot] != pair)
        if len(new):
            ok[new] = self.undo_all(a[new], b[new])
            self.pairs[slot[new]] = pair[new]
            # Where pairs of one slot were written together, say what the one that stayed says.
            stays = new[self.pairs[slot[new]] == pair[new]]
            self.pair_ok[slot[stays]] = ok[stays]
        return ok

    def undo_all(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the joined text of rows a and b leaves their border.

        Goes back through the merges, the last one first.  At every stage the
        two parts at the border must have no merge of their own that would
        come before the merges that are already undone; of equal scores the
        merge further left comes first.
        """
        ok = np.ones(len(a), bool)
        a, b = a.copy(), b.copy()
        after_a, after_b = np.full(len(a), -np.inf), np.full(len(a), -np.inf)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            joint = self.sizes[x] + self.sizes[y]
            fits = joint <= self.longest
            merged = np.full(len(live), -1, np.int32)
            merged[fits] = self.find(self.keys[x[fits]] * self.power[self.sizes[y[fits]]] + self.keys[y[fits]])
            score = np.where(merged >= 0, self.scores[merged], -np.inf)
            bad = (merged >= 0) & (score > after_a[live]) & (score >= after_b[live])
            ok[live[bad]] = False
            made_x, made_y = self.made[x], self.made[y]
            undo_x = made_x < made_y
            undo_y = ~undo_x & (made_y < np.inf)
            i = live[undo_x]
            after_a[i], a[i] = made_x[undo_x], self.right[x[undo_x]]
            i = live[undo_y]
            after_b[i], b[i] = made_y[undo_y], self.left[y[undo_y]]
            live = live[~bad & (undo_x | undo_y)]
        return ok


class Codec:
    """Encodes and decodes lists of texts; keeps the ids of words it has met."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _hits(self, codes: np.ndarray, start: int, end: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words with a piece at [start, end), and its row."""
        rows = self.p.find(hashes)
        hit = np.flatnonzero(rows >= 0)
        rows = rows[hit]
        same = self.p.sizes[rows] == end - start        # keys are only hashes
        same[same] = (self.p.spelt[rows[same], :end - start] == codes[hit[same], start:end]).all(1)
        return hit[same], rows[same]

    def _prefix(self, codes: np.ndarray) -> np.ndarray:
        """Rolling hash of the first i characters, for every i."""
        out = np.zeros((codes.shape[1] + 1, len(codes)), np.uint64)
        base, one = np.uint64(BASE), np.uint64(1)
        for i in range(codes.shape[1]):
            out[i + 1] = out[i] * base + codes[:, i] + one
        return out

    def search(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of words of one length, searched together, and how many each has."""
        p, n, size = self.p, len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32) \
            .reshape(n, size).astype(np.uint64)
        prefix = self._prefix(codes)
        best = np.full((size + 1, n), -np.inf, np.float32)
        best[0] = 0
        piece = np.full((size + 1, n), -1, np.int32)        # row of the piece that ends here; -1: a character
        back = np.ones((size + 1, n), np.int32)
        for end in range(1, size + 1):
            alone = np.zeros(n, bool)
            for start in range(max(0, end - p.longest), end):
                hit, rows = self._hits(codes, start, end, prefix[end] - prefix[start] * p.power[end - start])
                if start == end - 1:
                    alone[hit] = True
                if p.kind == BPE:
                    good = p.whole[rows] & (best[start, hit] == 0) & (best[end, hit] != 0)
                    hit, rows = hit[good], rows[good]
                    before = piece[start, hit]
                    both = np.flatnonzero(before >= 0) if start else np.empty(0, np.int64)
                    good = np.ones(len(hit), bool)
                    good[both] = p.compatible(before[both], rows[both])
                    hit, rows = hit[good], rows[good]
                    score = np.zeros(len(hit), np.float32)
                else:
                    score = best[start, hit] + p.scores[rows]
                better = score > best[end, hit]
                hit, rows = hit[better], rows[better]
                best[end, hit], piece[end, hit], back[end, hit] = score[better], rows, end - start
            score = best[end - 1] + (np.float32(0) if p.kind == BPE else p.unknown)
            better = ~alone & (score > best[end])
            best[end, better], piece[end, better], back[end, better] = score[better], -1, 1
        return self._walk_back(words, size, piece, back)

    def search_long(self, word: str) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long word: its places probe together, then one pass joins them."""
        p, size = self.p, len(word)
        codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        starts, spans, rows = [], [], []
        for span in range(1, min(p.longest, size) + 1):
            window = np.lib.stride_tricks.sliding_window_view(codes, span)
            hashes = np.zeros(len(window), np.uint64)
            for i in range(span):
                hashes = hashes * np.uint64(BASE) + window[:, i] + np.uint64(1)
            hit, found = self._hits(window, 0, span, hashes)
            starts.append(hit)
            spans.append(np.full(len(hit), span))
            rows.append(found)
        start, span, row = map(np.concatenate, (starts, spans, rows))
        known = np.zeros(size, bool)
        known[start[span == 1]] = True
        if p.kind == BPE:
            keep = p.whole[row]
            start, span, row = start[keep], span[keep], row[keep]
        order = np.lexsort((start, start + span))
        start, end, row = start[order], (start + span)[order], row[order]
        places = end.searchsorted(np.arange(size + 2))
        best = np.full(size + 1, -np.inf, np.float32)
        best[0] = 0
        piece, back = np.full((size + 1, 1), -1, np.int32), np.ones((size + 1, 1), np.int32)
        agree: dict[tuple[int, int], bool] = {}
        for e in range(1, size + 1):
            for j in range(places[e], places[e + 1]):
                s, r = start[j], row[j]
                if best[s] == -np.inf:
                    continue
                if p.kind == BPE:
                    pair = (int(piece[s, 0]), int(r))
                    if s and pair[0] >= 0 and pair not in agree:
                        agree[pair] = bool(p.compatible(np.array(pair[:1]), np.array(pair[1:]))[0])
                    score = np.float32(0) if not s or pair[0] < 0 or agree[pair] else -np.inf
                else:
                    score = best[s] + p.scores[r]
                if score > best[e]:
                    best[e], piece[e], back[e] = score, r, e - s
            if not known[e - 1]:
                score = best[e - 1] + (np.float32(0) if p.kind == BPE else p.unknown)
                if score > best[e]:
                    best[e], piece[e], back[e] = score, -1, 1
        return self._walk_back([word], size, piece, back)

    def _walk_back(self, words: list[str], size: int, piece: np.ndarray,
                   back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Follow the backpointers of all words at once, from the end."""
        n = len(words)
        at = np.full(n, size)
        owner, place, row = [], [], []
        live = np.arange(n)
        while len(live):
            owner.append(live)
            place.append(at[live])
            row.append(piece[at[live], live])
            at[live] -= back[at[live], live]
            live = live[at[live] > 0]
        owner, place, row = map(np.concatenate, (owner, place, row))
        order = np.lexsort((place, owner))
        owner, place, row = owner[order], place[order], row[order]
        ids, sizes = self.p.ids[row], np.bincount(owner, minlength=n)
        strange = np.flatnonzero(row < 0)
        if len(strange):        # characters that are no piece are spelt in bytes
            spelt = [list(words[owner[i]][place[i] - 1].encode("utf-8", "replace")) for i in strange]
            wide = np.ones(len(ids), np.int64)
            wide[strange] = [len(x) for x in spelt]
            ids = np.repeat(ids, wide)
            ends = np.cumsum(wide)
            for i, x in zip(strange, spelt):
                ids[ends[i] - len(x):ends[i]] = self.p.byte_ids[x]
            sizes = np.bincount(np.repeat(owner, wide), minlength=n)
        return ids, sizes

    def _learn(self, words: set[str]) -> None:
        """Search the words that are not known yet, by length, the longest last."""
        by_size: dict[int, list[str]] = {}
        for w in words:
            if w not in self.number:
                by_size.setdefault(len(w), []).append(w)
        new: list[tuple[np.ndarray, np.ndarray]] = []
        for size, same in sorted(by_size.items()):
            self.number.update(zip(same, range(len(self.number), len(self.number) + len(same))))
            step = max(1, SEARCH_CELLS // size)
            if size > LONG_WORD:
                new += map(self.search_long, same)
            else:
                for i in range(0, len(same), step):
                    new.append(self.search(same[i:i + step]))
        if new:
            sizes = np.concatenate([s for _, s in new])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            self.flat = np.concatenate([self.flat, *[ids for ids, _ in new]])

    def encode_flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each text's ids end (0 first)."""
        if len(self.number) > CACHED_WORDS:
            self.forget()
        cut = [pre_tokens(t) if t else [] for t in texts]
        words = [w for ws in cut for w in ws]
        distinct = set(words)
        self._learn(distinct)
        number = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        begins, sizes = self.ends[number], self.ends[number + 1] - self.ends[number]
        done = np.cumsum(sizes)
        flat = self.flat[np.repeat(begins - (done - sizes), sizes) + np.arange(done[-1] if len(done) else 0)]
        ends = np.concatenate([[0], done])[np.concatenate([[0], np.cumsum([len(ws) for ws in cut])]).astype(int)]
        self._drop_long(distinct)
        return flat, ends

    def _drop_long(self, words: set[str]) -> None:
        """Long words, which have the last numbers, are not kept."""
        for w in words:
            if len(w) > LONG_WORD:
                del self.number[w]
        self.ends = self.ends[:len(self.number) + 1]
        self.flat = self.flat[:self.ends[-1]]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        flat, ends = self.encode_flat(texts)
        return np.split(flat, ends[1:-1]) if texts else []

    def decode(self, ids) -> str:
        text = b"".join(map(self.p.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def load_pieces(docs: DataFrame, model_path: str) -> Broadcast:
    """The vocabulary as arrays, built on the driver and broadcast (a few MB)."""
    with open(model_path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(Pieces(f.read()))


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 keep: Sequence[str] = ()) -> DataFrame:
    """Per row: id, the columns to ``keep``, piece ids, their number, and whether
    decoding gives the text back."""
    sent = load_pieces(docs, model_path)
    held: list[Codec] = []

    def work(batch: pa.RecordBatch) -> dict:
        if not held:
            held.append(Codec(sent.value))
        texts = batch.column("text").to_pylist()
        flat, ends = held[0].encode_flat(texts)
        listed = flat.tolist()
        return {"ids": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat, pa.int32())),
                "n_ids": np.diff(ends),
                "round_trip": [held[0].decode(listed[a:b]) == (t or "").replace(SPACE, " ")
                               for a, b, t in zip(ends, ends[1:], texts)]}

    rows = docs.select(id_col, *keep, F.col(text_col).alias("text"))
    kept = ", ".join(f"`{c}` {type_of(docs, c)}" for c in (id_col, *keep))
    return per_row(rows, f"{kept}, ids array<int>, n_ids long, round_trip boolean", work, "text")


def decode_ids(coded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and the text of its piece ids; null and empty lists give the empty text."""
    sent = load_pieces(coded, model_path)
    held: list[Codec] = []

    def run(batches):
        if not held:
            held.append(Codec(sent.value))
        for batch in batches:
            texts = [held[0].decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return coded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {type_of(coded, id_col)}, text string")

"""Licence scans with a positional index over the rarest words of notices.

The words of all notices form a small vocabulary.  How many texts hold each of
these words is counted over all texts (each task sends one row per word), which
gives the words' inverse document frequency.  A notice's anchors are the
highest-IDF words of its mandatory phrases; the index lists, for each anchor,
(notice, position).

A text looks up its own words in the index.  Every hit votes for one notice at
one start, text position less notice position, so postings are intersected by
relative position.  Votes of starts up to ``BAND`` apart count together, since a
word put in or left out moves what follows.  A start with enough different
anchors is verified: every mandatory phrase stands word for word within ``BAND``
words of its place, and of the notice's words a share of ``MIN_SHARE`` stands in
order there (longest common subsequence inside the band).  Texts without any
anchor end there.

No start that passes is missed: mandatory phrases are there, and so are their
words.  A notice without phrases may lose some words, so its anchors are as
many more.

The base labels come from phrases whose words stand consecutively.  A null or
empty text has no words, no label and score 0.  Repeated rows count each.  An
empty table gives no rows.  Extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwave.llm.common import per_row, steps, type_of
from gridwave.llm.license_templates import BASE_PHRASES, TEMPLATES

MIN_VOTES = 2           # different anchors that must agree on a start
MIN_SHARE = 0.7         # of a notice's words in order
BAND = 3                # words that a notice's words may stand off their places
# A word, once A-Z are lower-cased: bytes.lower() changes ASCII letters only.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


@dataclass(frozen=True)
class Notice:
    label: str
    words: tuple[bytes, ...]
    phrases: tuple[tuple[int, tuple[bytes, ...]], ...]      # (place, words)


def notices(templates=TEMPLATES) -> list[Notice]:
    out = []
    for label, text, phrases in templates:
        words = tuple(words_of(text.encode()))
        placed = []
        for phrase in phrases:
            wanted = tuple(words_of(phrase.encode()))
            at = next(i for i in range(len(words)) if words[i:i + len(wanted)] == wanted)
            placed.append((at, wanted))
        out.append(Notice(label, words, tuple(placed)))
    return out


def idf_of_words(docs: DataFrame, vocabulary: set[bytes], text_col: str = "text") -> dict[bytes, float]:
    """IDF of the vocabulary's words over all texts; the result has one entry a word."""

    def tally(batches):
        n, held = 0, Counter()
        for batch in steps(batches, "text"):
            for text in batch.column("text").to_pylist():
                n += 1
                held.update(vocabulary.intersection(words_of(text)))
        held[b""] = n
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.binary()),
                                          "n": pa.array(list(held.values()), pa.int64())})

    text = F.col(text_col).cast("binary").alias("text")
    rows = docs.select(text).mapInArrow(tally, "word binary, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).collect()
    seen = {bytes(r.word): r.n for r in rows}
    total = seen.get(b"", 0)
    return {w: math.log((1 + total) / (1 + seen.get(w, 0))) for w in vocabulary}


def has_phrases(notice: Notice, words: list[bytes], start: int) -> bool:
    """Each mandatory phrase stands somewhere within the band of its place."""
    return all(any(0 <= begin and tuple(words[begin:begin + len(phrase)]) == phrase
                   for begin in range(start + at - BAND, start + at + BAND + 1))
               for at, phrase in notice.phrases)


def words_in_order(notice: tuple[bytes, ...], words: list[bytes], start: int) -> int:
    """Longest common subsequence of the notice and the text, no word more than the band off its place."""
    width, n = 2 * BAND + 1, len(words)
    row = [0] * (width + 1)     # by place in the band; the last entry is that of a place beyond it
    for i, word in enumerate(notice):
        first, left = start + i - BAND, 0
        new = []
        for d in range(width):
            at = first + d
            here = row[d] + (0 <= at < n and words[at] == word)
            left = max(left, here, row[d + 1])      # or the text's word, or the notice's, is passed over
            new.append(left)
        row = new + [left]
    return row[-1]


class Scanner:
    """Index of the notices' anchors; ``scan`` judges one text's words."""

    def __init__(self, found: list[Notice], idf: dict[bytes, float], phrases=BASE_PHRASES):
        self.notices = found
        self.index: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.votes = []
        for k, notice in enumerate(found):
            fixed = sorted({at + i for at, p in notice.phrases for i in range(len(p))})
            places = fixed or range(len(notice.words))
            # How many of the words at these places a verified start may lack.
            lost = 0 if fixed else len(notice.words) - math.ceil(MIN_SHARE * len(notice.words))
            words = {notice.words[at] for at in places}
            anchors = sorted(words, key=lambda w: (-idf[w], w))[:MIN_VOTES + lost]
            self.votes.append(max(1, min(MIN_VOTES, len(anchors) - lost)))
            for at in places:
                if notice.words[at] in anchors:
                    self.index[notice.words[at]].append((k, at))
        self.index = dict(self.index)
        self.base = [(tuple(words_of(p.encode())), label) for p, label in phrases]
        # A text without any of these has neither an anchor nor a base phrase.
        self.gate = set(self.index) | {p[-1] for p, _ in self.base}

    def phrases_at(self, words: list[bytes]) -> list[tuple[int, str]]:
        """(start, label) of each place of a base phrase."""
        out = []
        for phrase, label in self.base:
            n, at = len(phrase), -1
            while True:
                try:
                    at = words.index(phrase[0], at + 1)
                except ValueError:
                    break
                if tuple(words[at:at + n]) == phrase:
                    out.append((at, label))
        return out

    def notices_at(self, words: list[bytes]) -> list[tuple[str, float]]:
        """(label, largest share of words in order) of each verified notice."""
        hits: dict[int, dict[int, set[bytes]]] = defaultdict(lambda: defaultdict(set))
        for at, word in enumerate(words):
            for k, place in self.index.get(word, ()):
                hits[k][at - place].add(word)
        out = []
        for k, votes in hits.items():
            notice, best = self.notices[k], 0.0
            near = {h + d for h in votes for d in range(-BAND, BAND + 1)}
            for start in sorted(near):
                anchors = set().union(*(votes.get(start + d, ()) for d in range(-BAND, BAND + 1)))
                if len(anchors) >= self.votes[k] and has_phrases(notice, words, start):
                    best = max(best, words_in_order(notice.words, words, start) / len(notice.words))
                    if best == 1.0:
                        break
            if best >= MIN_SHARE:
                out.append((notice.label, best))
        return out

    def scan(self, text: bytes | None) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score."""
        words = words_of(text)
        if self.gate.isdisjoint(words):
            return len(words), 0, None, None, "", "", 0.0
        base, more = self.phrases_at(words), self.notices_at(words)
        starts = [at for at, _ in base]
        base_labels = {label for _, label in base}
        score = 1.0 if base else max((share for _, share in more), default=0.0)
        return (len(words), len(base), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base_labels)), ",".join(sorted(base_labels | {x for x, _ in more})), score)


COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates=TEMPLATES) -> DataFrame:
    """Per row: id, words, base places and labels, all labels, score (0 to 1)."""
    found = notices(templates)
    idf = idf_of_words(docs, {w for n in found for w in n.words}, text_col)
    scanner = Scanner(found, idf)

    def work(batch: pa.RecordBatch) -> dict:
        rows = [scanner.scan(t) for t in batch.column("text").to_pylist()]
        return dict(zip(COLUMNS, map(list, zip(*rows))))

    rows = docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("text"))
    return per_row(rows, f"`{id_col}` {type_of(docs, id_col)}, n_words long, n_base long, first_word long, "
                         "last_word long, base_labels string, labels string, score double", work, "text")

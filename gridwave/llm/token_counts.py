"""Token counts by a map-side two-tier lookup of pre-token lengths.

A pre-token is a run of U+2581 (the vocabulary's space) with what follows it up
to the next one; line feeds stand alone.  No piece of the vocabulary reaches
over such a border (``check_borders`` proves it when the model is loaded), so
merges never do either, and a text's count is the sum over its pre-tokens.

First tier: lengths of the most frequent pre-tokens of all texts, a table of at
most ``n_frequent`` entries that is broadcast.  Second tier: what the table
lacks is encoded by the library in the worker and kept in a bounded cache.  No
pre-token is shuffled for the counting.  To find the frequent ones, each task
keeps a bounded tally of its own pre-tokens and hands on at most
``n_candidates`` of them; the table steers speed only, never a count.

A null or empty text has 0 bytes and 0 tokens.  Texts of any length are counted
whole.  Repeated rows are counted each.  An empty table gives no rows.  Extra
columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwave.llm.common import per_row, steps, type_of

SPACE = "▁"
PRE_TOKEN = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
N_FREQUENT = 32_768         # entries of the broadcast table
N_CANDIDATES = 4_096        # pre-tokens that one task proposes
TALLY_ENTRIES = 400_000     # distinct pre-tokens that a task tallies at a time
CACHE_ENTRIES = 400_000     # lengths that a worker keeps
CACHED_CHARS = 64           # longer pre-tokens are not kept


def check_borders(sp: sentencepiece.SentencePieceProcessor) -> None:
    """Raise unless no piece crosses a pre-token border."""
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if len(piece) > 1 and ("\n" in piece or SPACE in piece.lstrip(SPACE)):
            raise ValueError(f"piece {piece!r} reaches over a pre-token border")


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a non-empty text, with the space that the library puts in front."""
    return PRE_TOKEN.findall(SPACE + text.replace(" ", SPACE))


class Lengths(dict):
    """Lengths by pre-token: the frequent ones, then a bounded cache over the library."""

    def __init__(self, model: bytes, frequent: dict[str, int]):
        super().__init__(frequent)
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.frequent = frequent
        # The library puts a space in front of what it encodes.  Behind a line
        # feed that space is a pre-token of its own, with a count to take off.
        self.lead = len(self.sp.encode("\n")) - 1
        self.feed = len(self.sp.encode("a\n")) - len(self.sp.encode("a"))

    def length(self, token: str) -> int:
        if token == "\n":
            return self.feed
        if token == SPACE:
            return self.lead
        if token[0] == SPACE:
            return len(self.sp.encode(token[1:]))
        return len(self.sp.encode("\n" + token)) - self.lead - self.feed

    def __missing__(self, token: str) -> int:
        n = self.length(token)
        if len(token) <= CACHED_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
                self.update(self.frequent)
            self[token] = n
        return n

    def count(self, text: str | None) -> int:
        return sum(map(self.__getitem__, pre_tokens(text))) if text else 0


def frequent_pre_tokens(docs: DataFrame, text_col: str = "text", n_frequent: int = N_FREQUENT,
                        n_candidates: int = N_CANDIDATES) -> list[str]:
    """The most frequent pre-tokens over all texts; at most ``n_frequent``."""

    def tally(batches):
        seen: Counter[str] = Counter()
        for batch in steps(batches, "text"):
            for text in batch.column("text").to_pylist():
                if text:
                    seen.update(t for t in pre_tokens(text) if len(t) <= CACHED_CHARS)
                if len(seen) > TALLY_ENTRIES:
                    seen = Counter(dict(seen.most_common(TALLY_ENTRIES // 4)))
        top = seen.most_common(n_candidates)
        yield pa.RecordBatch.from_pydict({"token": pa.array([t for t, _ in top], pa.string()),
                                          "n": pa.array([n for _, n in top], pa.int64())})

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(tally, "token string, n long")
    best = found.groupBy("token").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "token").limit(n_frequent)
    return [r.token for r in best.collect()]


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096, n_frequent: int = N_FREQUENT) -> DataFrame:
    """Per row: id, UTF-8 bytes, tokens, and whether these are over ``limit``."""
    with open(model_path, "rb") as f:       # a vocabulary file of the driver, sent by broadcast
        model = f.read()
    check_borders(sentencepiece.SentencePieceProcessor(model_proto=model))
    local = Lengths(model, {})
    frequent = {t: local.length(t) for t in frequent_pre_tokens(docs, text_col, n_frequent)}
    sent: Broadcast = docs.sparkSession.sparkContext.broadcast((model, frequent))
    held: list[Lengths] = []

    def work(batch: pa.RecordBatch) -> dict:
        if not held:
            held.append(Lengths(*sent.value))
        return {"n_tokens": [held[0].count(t) for t in batch.column("text").to_pylist()]}

    text = F.col(text_col)
    rows = docs.select(F.col(id_col), F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
                       .alias("n_bytes"), text.alias("text"))
    counted = per_row(rows, f"`{id_col}` {type_of(docs, id_col)}, n_bytes long, n_tokens long", work, "text")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

"""Benchmark decontamination by spaced seeds, in DataFrame expressions only.

A mask is a pattern of word places that must agree; the places between may
hold any word.  Each mask hashes the agreeing words at every place of the
benchmark items and of the documents, and the hashes are joined.  A hit puts an
item on a diagonal of the document (where the item's first word would stand).
Hits on one diagonal count once, and the diagonal is verified word by word: it
is an overlap if some ``OVERLAP`` words in a row (or the whole item, if shorter)
have at least ``SHARE`` of them equal.  The three masks find every overlap of 15
words with any 3 of them replaced, wherever the replacements are.

Words are runs of letters and digits in lower case, so punctuation and line
breaks do not matter.  Items of 13 words and more need no other masks; shorter
ones have masks of their own for each length that occurs, of which any
replacement that ``SHARE`` allows leaves one whole.  It allows none in items of
1 to 4 words: they match where all their words stand in a row.  Whoever holds
so short an item for no evidence raises ``min_item``; ``unsearched_items`` lists
the items that then (or for want of any word) are not searched for.

The items' hashes are broadcast where they number ``BROADCAST_SEEDS`` at most;
beyond that they are joined by a shuffle of narrow rows, and only documents
with hits are joined back.

Null and empty texts, on either side, match nothing.  Repeated items count
once.  Rows that share id and text are one document; a null id is an id of its
own, told apart by its text.  Of several overlaps of a document with an item
the one with most equal words is reported, then the first.  An empty table, on
either side, has no overlaps.  Extra columns, whatever their names, are not read
(``remove_contaminated`` returns them as they are).
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every set of 3 places out of 15 leaves one of these whole at some shift.
MASKS = ("1111011", "11001000111", "11010110001")
OVERLAP = 15
SHARE = 0.8
MIN_ITEM = 1            # words of the shortest item that is searched for
SHORT_ITEM = 12         # longest item for which the masks do not see every replacement
SHORT_WEIGHT = 4        # least places of a short item's mask
BROADCAST_SEEDS = 1_000_000
NOT_WORD = r"[^\p{L}\p{N}]+"


def word_hashes(text: Column) -> Column:
    """Hash of every word, in order."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds_at(hashes: Column, at: Column, masks: list[str]) -> Column:
    """The masks' hashes at one place; null where a mask reaches over the end."""
    def one(k: int, mask: str) -> Column:
        places = [i for i, c in enumerate(mask) if c == "1"]
        words = [F.get(hashes, at + i) for i in places]
        return F.when(at + len(mask) <= F.size(hashes), F.xxhash64(F.lit(k), *words))
    return F.array(*[one(k, m) for k, m in enumerate(masks)])


def masks_of_length(n: int) -> list[str]:
    """Masks for an item of ``n`` words: its places are cut into groups, and each
    mask leaves out as many groups as words may be replaced."""
    lost = n - math.ceil(SHARE * n)
    groups = lost + 2
    while groups < n and n - lost * -(-n // groups) < SHORT_WEIGHT:
        groups += 1
    group = [i * groups // n for i in range(n)]
    return ["".join("0" if k in out else "1" for k in group).strip("0")
            for out in combinations(range(groups), lost)]


def short_masks(items: DataFrame, min_item: int) -> dict[str, list[int]]:
    """Masks for the lengths of short items that occur, with the lengths each is for."""
    sizes = items.select(F.size("words").alias("n")).filter(F.col("n").between(min_item, SHORT_ITEM)) \
        .distinct().collect()       # SHORT_ITEM rows at most
    out: dict[str, list[int]] = {}
    for r in sorted(sizes):
        for mask in masks_of_length(r.n):
            if r.n not in out.setdefault(mask, []):
                out[mask].append(r.n)
    return out


def seeds_of(items: DataFrame, masks: tuple[str, ...], short: dict[str, list[int]], min_item: int) -> DataFrame:
    """(seed, item, shift): the item's hashes; a short mask (behind the others) only for items of its lengths."""
    n = F.size("words")
    every = [*masks, *short]
    fits = F.array(*[F.lit(True) for _ in masks], *[n.isin(lengths) for lengths in short.values()])
    return (items.filter(n >= min_item)
            .select("item", "words", F.explode(F.sequence(F.lit(0), n - 1)).alias("shift"))
            .select("item", "shift", F.posexplode(seeds_at(F.col("words"), F.col("shift"), every)).alias("k", "seed"),
                    fits.alias("fits"))
            .filter(F.col("seed").isNotNull() & F.get("fits", F.col("k"))).select("seed", "item", "shift").distinct())


def _windows(docs: DataFrame, masks: list[str]) -> DataFrame:
    """One row per place and mask of each document, with the document's columns."""
    n = F.size("words")         # no filter on it: that would split every text a second time
    at = docs.withColumn("at", F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1))))
    return at.withColumn("seed", F.explode(seeds_at(F.col("words"), F.col("at"), masks))) \
        .filter(F.col("seed").isNotNull())


def _part(start: Column, size: Column) -> Column:
    """The document's words under an item of ``size`` words that begins at ``start``."""
    begin = F.greatest(start, F.lit(0))
    return F.slice("words", begin + 1, F.greatest(F.lit(0), F.least(start + size, F.size("words")) - begin))


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text",
             masks: tuple[str, ...] = MASKS, broadcast_seeds: int = BROADCAST_SEEDS,
             min_item: int = MIN_ITEM) -> DataFrame:
    """Verified overlaps: (id, body, item, start, matched, share, n_item_words).

    ``body`` is a hash of the text, which tells rows with one id apart.
    """
    items = benchmark.select(F.col(item_col).alias("item"), word_hashes(F.col(item_text_col)).alias("words")) \
        .distinct()
    short = short_masks(items, min_item)
    every = [*masks, *short]
    seeds = seeds_of(items, masks, short, min_item)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("body"),
                       word_hashes(F.col(text_col)).alias("words"))
    sized = seeds.join(items.select("item", F.size("words").alias("size")).distinct(), "item")
    start = F.col("at") - F.col("shift")
    if seeds.count() <= broadcast_seeds:
        # ``part`` is named twice so that it is cut out before the sort and not in
        # it: the sort then holds the words under the item, not the whole text's.
        hits = _windows(rows, every).join(F.broadcast(sized), "seed") \
            .select("id", "body", "item", start.alias("start"), "size", _part(start, F.col("size")).alias("part")) \
            .groupBy("id", "body", "item", "start", "size") \
            .agg(F.first("part").alias("part"), F.max(F.size("part")).alias("n")).drop("n")
    else:
        narrow = _windows(rows, every).select("id", "body", "at", "seed")
        found = narrow.join(sized, "seed").select("id", "body", "item", "size", start.alias("start")).distinct()
        back = rows.join(found.withColumnRenamed("id", "_id").withColumnRenamed("body", "_body"),
                         F.col("id").eqNullSafe(F.col("_id")) & (F.col("body") == F.col("_body")))
        hits = back.select("id", "body", "item", "start", "size", _part(F.col("start"), F.col("size")).alias("part")) \
            .distinct()
    return _verified(hits, items)


def _verified(hits: DataFrame, items: DataFrame) -> DataFrame:
    """The best overlap of each document and item that passes word by word."""
    both = hits.join(items.select("item", F.col("words").alias("item_words")), "item") \
        .filter(F.size("item_words") == F.col("size"))
    same = F.zip_with("part", F.slice("item_words", F.greatest(-F.col("start"), F.lit(0)) + 1, F.size("part")),
                      lambda a, b: (a == b).cast("int"))
    total = lambda x: F.aggregate(x, F.lit(0), lambda a, b: a + b)
    width = F.least(F.lit(OVERLAP), F.col("size"))
    sums = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("same") - width + 1)),
                       lambda i: total(F.slice("same", i, width)))
    judged = both.withColumn("same", same).withColumn("best", F.array_max(sums)) \
        .withColumn("matched", total(F.col("same"))) \
        .filter(F.col("best") >= F.ceil(SHARE * width))
    least = F.struct(F.col("matched"), (-F.col("start")).alias("back"))
    return judged.groupBy("id", "body", "item") \
        .agg(F.max(F.struct(least.alias("k"), "start", "matched", (F.col("best") / width).alias("share"),
                            F.col("size").alias("n_item_words"))).alias("b")) \
        .select("id", "body", "item", "b.start", "b.matched", "b.share", "b.n_item_words")


def unsearched_items(benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text",
                     min_item: int = MIN_ITEM) -> DataFrame:
    """(item, ``n_item_words``) of the items that have too few words to be searched for."""
    n_words = F.size(word_hashes(F.col(item_text_col))).cast("long")
    items = benchmark.select(F.col(item_col), n_words.alias("n_item_words"))
    return items.filter(F.col("n_item_words") < max(1, min_item)).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", min_item: int = MIN_ITEM) -> DataFrame:
    """One row per document and benchmark item that overlap."""
    return overlaps(docs, benchmark, id_col, text_col, item_col, item_text_col, min_item=min_item).select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), F.col("start").cast("long").alias("first_word"),
        F.col("matched").cast("long").alias("n_matched"), F.col("n_item_words").cast("long"), "share")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                        text_col: str = "text", item_col: str = "item_id",
                        item_text_col: str = "text", min_item: int = MIN_ITEM) -> DataFrame:
    """The rows of ``docs`` that overlap with no item."""
    found = overlaps(docs, benchmark, id_col, text_col, item_col, item_text_col, min_item=min_item) \
        .select(F.col("id").alias("_id"), F.col("body").alias("_body")).distinct()
    names = [f"_c{i}" for i in range(len(docs.columns))]
    own_id, own_text = (F.col(names[docs.columns.index(c)]) for c in (id_col, text_col))
    body = F.xxhash64(F.coalesce(own_text, F.lit("")))
    return docs.toDF(*names).join(found, own_id.eqNullSafe(F.col("_id")) & (body == F.col("_body")), "left_anti") \
        .toDF(*docs.columns)

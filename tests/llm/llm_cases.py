"""Rows that operators must not trip over."""

from pyspark.sql import types as T

# Columns beside those of ``documents``, named like what operators make.
CLASHES = ("id", "body", "words", "n_words", "fp", "kept", "n_tokens", "seed", "block", "ids", "spans", "score")

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in CLASHES]])

LONG = ("alpha beta gamma delta epsilon zeta eta theta iota kappa " * 12_000).strip()
PHRASE = "The quick brown fox jumps over the lazy dog while seven wise owls quietly watch from above the barn"

ROWS = [
    (1, PHRASE + ". And then some more words follow here, so that it is no fragment at all.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n\x0b\f\r ", "en", None),
    (5, LONG, "en", "a"),
    (6, "x" * 50_000, "en", "a"),
    (7, "mail joe.bloggs@example.com or +1 (974) 555-3436 from 10.20.30.40, card 4111 1111 1111 1111. "
        "Later (974) 555-3436 once more.", "en", "a"),
    (7, "mail joe.bloggs@example.com or +1 (974) 555-3436 from 10.20.30.40, card 4111 1111 1111 1111. "
        "Later (974) 555-3436 once more.", "en", "a"),
    (8, "Released under the MIT License. Und dann noch ein paar deutsche Wörter und Sätze.", "de", "b"),
    (9, "le chat est sur la table et le chien dort sous la chaise pendant que nous mangeons 漢字 \U0001f600", "fr", "b"),
    (None, "a text without an id that nobody else has written before today", "en", "b"),
    (None, "a text without an id that nobody else has written before today", "en", "b"),
    (10, PHRASE + ". And then some more words follow here, so that it is no fragment at all.", "en", "a"),
    (11, "12345 !!! 67890 ???", "en", "a"),
    (12, "one two", "en", "a"),
]


def hard_docs(spark):
    return spark.createDataFrame([(*r, len(r[1] or ""), *["?"] * len(CLASHES)) for r in ROWS], SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)

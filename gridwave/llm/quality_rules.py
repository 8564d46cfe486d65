"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Each rule says when a text is rejected.  What every rule costs and rejects is
estimated on a sample; rules then run in the order of rejections per cost, each
counted on what the rules before it leave.  A rule's cost is the work of the
features it asks for, counted for the sample's own texts (characters passed
over, elements of lambdas), so the order is the same in every run over the same
rows.  A text that one rule rejects is not looked at by the next: a later rule
and the features it needs are evaluated only where all before it pass.  The
verdict is the same in any order, so the sample only steers the cost.

A null text counts as empty.  An empty text has no words and is rejected by
``few_words``.  Repeated rows get the same verdict each.  An empty table gives no
rows.  Extra columns, whatever their names, are not read (``keep_good`` returns
them as they are).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwave.llm.common import hash_sample, split_words, written

WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_SYMBOL_PERCENT = 25
MAX_DUP_LINE_PERCENT = 30
MEAN_WORD_LENGTH = (2, 15)
SAMPLE_ROWS = 512


Get = Callable[[str], Column]


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _windows(get: Get) -> Column:
    """Hash of every window of words."""
    def of(h: Column) -> Column:
        n = F.size(h)
        return F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                                               lambda i: F.xxhash64(F.slice(h, i, WINDOW))))
    return bind(get("_h"), of)


def _window_order(get: Get) -> Column:
    """(hash, position) of all windows in hash order, only where a window repeats."""
    return bind(get("_win"), lambda win: F.when(
        F.size(F.array_distinct(win)) < F.size(win),
        F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))


def _repeat_starts(get: Get) -> Column:
    """Starts of windows whose words stand elsewhere in the text too, ascending."""
    def of(order: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(order, j)["h"] == x["h"], F.lit(False))
        starts = F.transform(order, lambda x, i: F.when(same(x, i - 1) | same(x, i + 1), x["p"]))
        return F.sort_array(F.array_compact(starts))
    return bind(get("_order"), of)


def _covered(get: Get) -> Column:
    """Words under the repeated windows: each start adds what the next does not cover."""
    def of(starts: Column) -> Column:
        adds = F.transform(starts, lambda p, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW))))
        return F.when(starts.isNull(), F.lit(0)).otherwise(
            F.aggregate(adds, F.lit(0), lambda a, x: a + x)).cast("long")
    return bind(get("_starts"), of)


def _worded_lines(get: Get) -> Column:
    return F.filter(F.split(get("_text"), "\n"), lambda x: F.translate(x, SPACES, "") != "")


# Features in the order in which they can be built, each from ``_text`` or from earlier ones.
FEATURES: dict[str, tuple[tuple[str, ...], Callable[[Get], Column]]] = {
    "_words": ((), lambda get: split_words(get("_text"))),
    "n_words": (("_words",), lambda get: F.size(get("_words")).cast("long")),
    "word_chars": ((), lambda get: F.length(F.translate(get("_text"), SPACES, "")).cast("long")),
    "n_symbols": ((), lambda get: (F.length(get("_text")) - F.length(F.translate(get("_text"), SYMBOLS, "")))
                  .cast("long")),
    "_lines": ((), _worded_lines),
    "n_dup_lines": (("_lines",), lambda get: bind(get("_lines"), lambda x: (
        F.size(x) - F.size(F.array_distinct(x))).cast("long"))),
    "_h": (("_words",), lambda get: F.transform(get("_words"), lambda w: F.xxhash64(w))),
    "_win": (("_h",), _windows),
    "_order": (("_win",), _window_order),
    "_starts": (("_order",), _repeat_starts),
    "n_repeat_words": (("_starts",), _covered),
}


# Work of one element in a lambda, which is interpreted, as that of so many characters in a built-in.
LAMBDA_WORK = 20

# What building a feature takes, beside the features it is built from, in characters passed over.
WORK: dict[str, Callable[[Column, Column], Column]] = {     # of (characters, words)
    "_text": lambda chars, words: chars,
    "_words": lambda chars, words: 2 * chars,
    "n_words": lambda chars, words: F.lit(1),
    "word_chars": lambda chars, words: 2 * chars,
    "n_symbols": lambda chars, words: 2 * chars,
    "_lines": lambda chars, words: 3 * chars,
    "n_dup_lines": lambda chars, words: chars,
    "_h": lambda chars, words: chars + LAMBDA_WORK * words,
    "_win": lambda chars, words: LAMBDA_WORK * (WINDOW + 1) * words,
    "_order": lambda chars, words: LAMBDA_WORK * words,
    "_starts": lambda chars, words: words,
    "n_repeat_words": lambda chars, words: words,
}


@dataclass(frozen=True)
class Rule:
    """Rejects where ``fails(get)`` holds; ``get`` gives a feature by name."""

    name: str
    fails: Callable[[Get], Column]


BASE_RULES = (
    Rule("few_words", lambda get: get("n_words") < MIN_WORDS),
    Rule("repeats", lambda get: 100 * get("n_repeat_words") > MAX_REPEAT_PERCENT * get("n_words")),
)
METHOD_RULES = (
    Rule("symbols", lambda get: 100 * get("n_symbols") > MAX_SYMBOL_PERCENT * get("n_words")),
    Rule("dup_lines", lambda get: bind(get("_lines"), lambda x: (
        100 * (F.size(x) - F.size(F.array_distinct(x))) > MAX_DUP_LINE_PERCENT * F.size(x)))),
    Rule("word_length", lambda get: ~get("word_chars").between(
        MEAN_WORD_LENGTH[0] * get("n_words"), MEAN_WORD_LENGTH[1] * get("n_words"))),
)
RULES = BASE_RULES + METHOD_RULES


def add_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add the named features, and those they are built from, as columns."""
    wanted: set[str] = set()

    def add(name):
        for below in FEATURES[name][0]:
            add(below)
        wanted.add(name)

    for name in names:
        add(name)
    for name, (_, build) in FEATURES.items():
        if name in wanted:
            df = df.withColumn(name, build(F.col))
    return df


def cascade(text: Column, order: Sequence[Rule]) -> Column:
    """No rule rejects the text.  One CASE: a rule and the features it needs are
    evaluated only where no earlier rule has rejected."""
    def with_words(words: Column) -> Column:
        have = {"_text": text, "_words": words, "n_words": F.size(words).cast("long")}

        def get(name: str) -> Column:
            return have[name] if name in have else FEATURES[name][1](get)

        kept = F.lit(True)
        for rule in reversed(order):
            kept = F.when(rule.fails(get), F.lit(False)).otherwise(kept)
        return kept

    return bind(split_words(text), with_words)


@dataclass(frozen=True)
class Measured:
    rule: Rule
    cost: float         # work for all rows of the sample
    rejected: float     # share of the sample's rows that it rejects, and no rule before it

    @property
    def per_cost(self) -> float:
        return self.rejected / self.cost


def built_from(feature: str) -> set[str]:
    """A feature and all those below it."""
    below = FEATURES[feature][0] if feature in FEATURES else ()
    return {feature}.union(*map(built_from, below))


def asked_for(rule: Rule) -> set[str]:
    """Features that a rule looks at, with those they are built from; words are split for every rule."""
    names: set[str] = set()

    def get(name: str) -> Column:
        names.update(built_from(name))
        return F.col(name)

    rule.fails(get)
    return names - {"_words", "n_words"}


def measure(sample: DataFrame, rules: Sequence[Rule]) -> list[Measured]:
    """Rules in the order in which each rejects most, per cost, of what those before it leave.

    One job counts the sample's rows by the set of rules that reject them.
    """
    text, words = F.col("_text"), F.size(split_words(F.col("_text")))
    by_name = {f"_{i}": rule for i, rule in enumerate(sorted(rules, key=lambda r: r.name))}
    flags = [F.coalesce(~cascade(text, [rule]), F.lit(False)).alias(name) for name, rule in by_name.items()]
    work = [sum((WORK[f](F.length(text), words) for f in sorted(asked_for(rule))), F.lit(1)).alias(f"_work{name}")
            for name, rule in by_name.items()]
    rows = sample.select(*flags, *work).groupBy(*by_name).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(f"_work{name}").alias(f"_work{name}") for name in by_name]).collect()
    total = max(1, sum(r["_n"] for r in rows))
    cost = {name: math.fsum(r[f"_work{name}"] for r in rows) or 1.0 for name in by_name}
    out: list[Measured] = []
    left = dict.fromkeys(by_name)
    while left:
        gain = {name: sum(r["_n"] for r in rows if r[name]) for name in left}
        best = max(left, key=lambda name: gain[name] / cost[name])      # the first of equals: by name
        out.append(Measured(by_name[best], cost[best], gain[best] / total))
        rows = [r for r in rows if not r[best]]
        del left[best]
    return out


def rule_order(docs: DataFrame, id_col: str, text_col: str, rules: Sequence[Rule] = RULES,
               sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejections per cost, highest first; ties by name.

    The sample (``sample_rows`` rows by a hash of the id, more or less) decides
    only the order, never a verdict.
    """
    texts = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    sample = written(hash_sample(texts, sample_rows).select("_text"), "quality-sample")
    measured = measure(sample, rules)
    return [m.rule for m in sorted(measured, key=lambda m: (-m.per_cost, m.rule.name))]


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs``, all their columns, that no rule rejects."""
    order = rule_order(docs, id_col, text_col, rules)
    return docs.filter(cascade(F.coalesce(F.col(text_col), F.lit("")), order))


BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the five base figures, ``base_failed`` and the verdict ``kept``.

    The report asks for every figure of every row, so the features are columns
    here; the method's own rules still run as a cascade behind the base rules.
    """
    order = [r for r in rule_order(docs, id_col, text_col) if r not in BASE_RULES]
    df = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    df = add_features(df, BASE_COLUMNS + ("_lines",))
    failed = BASE_RULES[0].fails(F.col) | BASE_RULES[1].fails(F.col)
    kept = F.lit(True)
    for rule in reversed(order):
        kept = F.when(rule.fails(F.col), F.lit(False)).otherwise(kept)
    return df.select(id_col, *BASE_COLUMNS, failed.alias("base_failed"),
                     F.when(failed, F.lit(False)).otherwise(kept).alias("kept"))

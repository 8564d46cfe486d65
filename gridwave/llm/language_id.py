"""Language identification by a linear-chain conditional random field over words.

Every run of letters is a word with a language of its own, so text that
switches languages is labelled word by word.  A word's score for a language is
the sum of the weights of its features: hashed byte trigrams, hashed affixes,
and a lexicon entry where the fit knows the word.  Learned transitions join
neighbouring words; the forward-backward algorithm gives each word's label
probabilities over the whole text, and a text's language is the one with the
largest share of them.

Fit: about ``FIT_DOCS`` documents of each language by a hash of the id, from
each ``FIT_RUNS`` runs of ``RUN_WORDS`` words spread over the whole text.  Runs of
different languages are strung together, so transitions are learned from text
that switches.  Every label that occurs is in the model: beyond ``FIT_LANGUAGES``
of them each has fewer documents and runs, one at least, so that words times
labels stay bounded.  These bounds hold for the fit only; every text is labelled
whole.

A null text or one without a letter gets ``und`` and score 0.  So do all texts
where there is nothing to learn from.  Ties go to the first language in
alphabetical order.  Repeated rows are labelled each.  An empty table gives no
rows.  Extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwave.llm.common import per_row, steps, type_of

WORD = re.compile(r"[^\W\d_]+")
HASH_BITS = 16
AFFIX_BYTES = (3, 4, 5)
FIT_DOCS = 150          # of each language
FIT_RUNS = 16           # runs taken from a document
RUN_WORDS = 12
STRING_RUNS = 8         # runs strung together in the fit
FIT_LANGUAGES = 64      # labels that have as many; of more each has fewer
FIT_CELLS = 8_000_000   # words times labels worked on at a time in the fit
LEXICON_COUNT = 3       # how often the fit must have seen a word to keep it
FIT_STEPS = 60
CACHED_WORDS = 200_000
STEP_BYTES = 2_000_000  # of text labelled at a time: its words hold several floats each
UNKNOWN = "und"


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case; the pattern lets marks such as ² pass, which
    are no letters, so words without any letter are dropped."""
    words = WORD.findall(text.lower()) if text else []
    if text and not text.isascii():
        words = [w for w in words if w.isalpha() or any(map(str.isalpha, w))]
    return words


def hashed_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, feature id) pairs: trigrams and affixes of UTF-8 bytes."""
    marked = [b"\x02" + w.encode("utf-8", "replace") + b"\x03" for w in words]
    sizes = np.array([len(m) for m in marked], np.int64)
    data = np.frombuffer(b"".join(marked) + b"\0" * 8, np.uint8).astype(np.uint64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    owner = np.repeat(np.arange(len(words)), sizes)

    def mix(code: np.ndarray, salt: int) -> np.ndarray:
        code = (code * np.uint64(8) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        return (code >> np.uint64(64 - HASH_BITS)).astype(np.int64)

    def code(starts: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(len(starts), np.uint64)
        for i in range(n):
            out = out * np.uint64(256) + data[starts + i]
        return out

    at = np.arange(int(ends[-1]) if len(ends) else 0)
    inside = at + 3 <= ends[owner]
    who, what = [owner[inside]], [mix(code(at[inside], 3), 0)]
    for k, n in enumerate(AFFIX_BYTES):
        long = np.flatnonzero(sizes >= n)
        who += [long, long]
        what += [mix(code(begins[long], n), 1 + 2 * k), mix(code(ends[long] - n, n), 2 + 2 * k)]
    return np.concatenate(who), np.concatenate(what)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray         # hashed features, then lexicon words, by language
    lexicon: dict[str, int]
    start: np.ndarray
    trans: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        who, what = self.features(words)
        return np.stack([np.bincount(who, self.weights[what, k], len(words))
                         for k in range(len(self.languages))], 1)

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        who, what = hashed_features(words)
        known = [(i, self.lexicon[w]) for i, w in enumerate(words) if w in self.lexicon]
        more = np.array(known, np.int64).reshape(-1, 2)
        return np.concatenate([who, more[:, 0]]), np.concatenate([what, more[:, 1] + (1 << HASH_BITS)])


def step_major(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of words by step, then by text; ``sizes`` is descending.

    Returns how many texts reach each step, and each word's text and place in
    the order by text.
    """
    active = np.searchsorted(-sizes, -np.arange(int(sizes[0])), side="left")   # longer than the step
    text = np.concatenate([np.arange(n) for n in active])
    step = np.repeat(np.arange(len(active)), active)
    return active, text, (np.cumsum(sizes) - sizes)[text] + step


def forward_backward(model: Model, potentials: np.ndarray, ids: np.ndarray,
                     sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word label probabilities of many texts at once, all advancing word by word.

    ``ids`` has the texts' word numbers one after another, longest text first;
    ``potentials`` exp(score) by word number.  Returns the probabilities in
    step-major order, each row's text, and the summed pair probabilities.
    """
    active, text, place = step_major(sizes)
    at = np.concatenate([[0], np.cumsum(active)])
    psi = potentials[ids[place]]
    trans, first = np.exp(model.trans), np.exp(model.start)
    alpha, beta = np.empty_like(psi), np.ones_like(psi)
    a = first * psi[:active[0]]
    for t, n in enumerate(active):
        if t:
            a = (a[:n] @ trans) * psi[at[t]:at[t + 1]]
        a = a / a.sum(1, keepdims=True)
        alpha[at[t]:at[t + 1]] = a
    pairs = np.zeros_like(trans)
    for t in range(len(active) - 2, -1, -1):
        n = active[t + 1]
        after = psi[at[t + 1]:at[t + 2]] * beta[at[t + 1]:at[t + 2]]
        b = after @ trans.T
        norm = b.sum(1, keepdims=True)
        here = alpha[at[t]:at[t] + n]
        whole = (here * b).sum(1, keepdims=True)
        pairs += trans * ((here / whole).T @ after)
        beta[at[t]:at[t] + n] = b / norm
    gamma = alpha * beta
    return gamma / gamma.sum(1, keepdims=True), text, pairs


def fit(runs: list[tuple[str, list[str]]], rounds: int = FIT_STEPS, rate: float = 0.3,
        l2: float = 1e-6) -> Model | None:
    """Maximum conditional likelihood by AdaGrad over strings of labelled runs."""
    languages = sorted({lang for lang, words in runs if words})
    if not languages:
        return None
    rng, k = np.random.default_rng(11), len(languages)
    number = {w: i for i, w in enumerate(sorted({w for _, words in runs for w in words}))}
    vocabulary = list(number)
    counts = np.zeros(len(vocabulary), np.int64)
    for _, words in runs:
        np.add.at(counts, [number[w] for w in words], 1)
    lexicon = {vocabulary[i]: j for j, i in enumerate(np.flatnonzero(counts >= LEXICON_COUNT))}
    model = Model(languages, np.zeros(((1 << HASH_BITS) + len(lexicon), k)), lexicon,
                  np.zeros(k), np.zeros((k, k)))
    order = rng.permutation(len(runs))
    strings = []
    for at in range(0, len(order), STRING_RUNS):
        mine = [runs[i] for i in order[at:at + STRING_RUNS] if runs[i][1]]
        # Half of the strings keep one language for two runs in a row.
        if (at // STRING_RUNS) % 2:
            mine.sort(key=lambda r: r[0])
        if mine:
            strings.append(mine)
    strings.sort(key=lambda s: -sum(len(w) for _, w in s))
    ids = np.array([number[w] for s in strings for _, words in s for w in words])
    labels = np.array([languages.index(lang) for s in strings for lang, words in s for _ in words])
    sizes = np.array([sum(len(w) for _, w in s) for s in strings])
    begins = np.cumsum(sizes) - sizes
    n = len(ids)
    real_pairs = np.zeros((k, k))
    inner = np.setdiff1d(np.arange(1, n), begins)
    np.add.at(real_pairs, (labels[inner - 1], labels[inner]), 1)
    real_start = np.bincount(labels[begins], minlength=k)
    who, what = model.features(vocabulary)
    truth = np.stack([np.bincount(ids, labels == j, len(vocabulary)) for j in range(k)], 1)
    squares = [np.full_like(x, 1e-8) for x in (model.weights, model.start, model.trans)]
    # Strings are worked on in groups, which bounds the words' probabilities held at once.
    group = (begins * k if k > FIT_LANGUAGES else np.zeros_like(begins)) // FIT_CELLS
    parts = [slice(p[0], p[-1] + 1) for p in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(group)) + 1)]
    for _ in range(rounds):
        score = np.stack([np.bincount(who, model.weights[what, j], len(vocabulary)) for j in range(k)], 1)
        score -= score.max(1, keepdims=True)
        score = np.exp(np.maximum(score, -60))
        off, starts, pairs = truth.astype(float), real_start.astype(float), real_pairs.copy()
        for part in parts:
            mine = ids[begins[part][0]:begins[part][-1] + sizes[part][-1]]
            gamma, _, seen = forward_backward(model, score, mine, sizes[part])
            place = step_major(sizes[part])[2]
            for j in range(k):
                off[:, j] -= np.bincount(mine[place], gamma[:, j], len(vocabulary))
            starts -= gamma[:len(sizes[part])].sum(0)
            pairs -= seen
        grads = (np.stack([np.bincount(what, off[who, j], len(model.weights)) for j in range(k)], 1)
                 - l2 * n * model.weights, starts, pairs)
        for w, g, s in zip((model.weights, model.start, model.trans), grads, squares):
            s += g * g
            w += rate * g / np.sqrt(s)
    return model


def crowd(n_labels: int) -> int:
    """How many times ``FIT_LANGUAGES`` the labels are, rounded up: a word's row is so much longer."""
    return max(1, -(-n_labels // FIT_LANGUAGES))


class Labeller:
    """Labels texts with a model; keeps the scores of words it has met, up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self.share = crowd(len(model.languages))
        self.forget()

    def forget(self):
        self.number: dict[str, int] = {}
        self.potentials = np.empty((0, len(self.model.languages)))

    def numbers(self, texts: list[list[str]]) -> None:
        new = list({w for words in texts for w in words if w not in self.number})
        if not new:
            return
        score = self.model.scores(new)
        score = np.exp(np.maximum(score - score.max(1, keepdims=True), -60))
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self.potentials = np.concatenate([self.potentials, score])

    def label(self, texts: list[str | None]) -> list[tuple[str, float]]:
        words = [words_of(t) for t in texts]
        if len(self.number) > CACHED_WORDS // self.share:
            self.forget()
        self.numbers(words)
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        rows = sorted((i for i, w in enumerate(words) if w), key=lambda i: -len(words[i]))
        if not rows:
            return out
        sizes = np.array([len(words[i]) for i in rows])
        get = self.number.__getitem__
        ids = np.concatenate([np.fromiter(map(get, words[i]), np.int64, len(words[i])) for i in rows])
        gamma, text, _ = forward_backward(self.model, self.potentials, ids, sizes)
        share = np.stack([np.bincount(text, gamma[:, j], len(rows))
                          for j in range(gamma.shape[1])], 1) / sizes[:, None]
        best = share.argmax(1)
        for r, i in enumerate(rows):
            out[i] = (self.model.languages[best[r]], float(min(1.0, share[r, best[r]])))
        return out

    def label_words(self, text: str) -> list[tuple[str, str]]:
        """(word, language) of every word of one text."""
        words = words_of(text)
        if not words:
            return []
        self.numbers([words])
        ids = np.array([self.number[w] for w in words])
        gamma, _, _ = forward_backward(self.model, self.potentials, ids, np.array([len(words)]))
        return [(w, self.model.languages[j]) for w, j in zip(words, gamma.argmax(1))]


def held_out(id_col: str) -> Column:
    """Documents kept from the fit; a null id is neither held out nor fitted on."""
    rest = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3))
    return F.coalesce(rest == 1, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          fit_docs: int = FIT_DOCS) -> Model | None:
    """Fit on a bounded sample of labelled documents that are not held out."""
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                        F.col(lang_col).cast("string").alias("lang")) \
        .filter(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out("id"))
    hashed = F.xxhash64("id", "text")
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").collect()
    if not sizes:
        return None
    n_runs = max(1, int(fit_docs * FIT_RUNS * min(1.0, FIT_LANGUAGES / len(sizes)) ** 2))    # of each language
    fit_docs, fit_runs = max(1, n_runs // FIT_RUNS), min(FIT_RUNS, n_runs)
    chosen = F.pmod(hashed, F.col("step")) == 0
    if len(sizes) > FIT_LANGUAGES:      # so few documents that a language might have none
        least = {r.lang: r.h for r in known.groupBy("lang").agg(F.min(hashed).alias("h")).collect()}
        chosen |= hashed == F.create_map(*[F.lit(x) for pair in least.items() for x in pair])[F.col("lang")]
    step = F.create_map(*[F.lit(x) for r in sizes for x in (r.lang, max(1, r.n // fit_docs))])
    sample = known.withColumn("step", step[F.col("lang")]).filter(chosen).select("lang", "text")

    def runs(batches):
        for batch in steps(batches, "text"):
            langs, found = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                spread = np.linspace(0, max(0, len(words) - RUN_WORDS), fit_runs).astype(int)
                free = -RUN_WORDS
                for at in spread:
                    if at >= free + RUN_WORDS and words:
                        langs.append(lang)
                        found.append([w[:64] for w in words[at:at + RUN_WORDS]])
                        free = at
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()),
                                              "words": pa.array(found, pa.list_(pa.string()))})

    rows = sample.mapInArrow(runs, "lang string, words array<string>").collect()
    return fit(sorted((r.lang, list(r.words)) for r in rows))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """Per row: id, whether it was held out, predicted language, score (0 to 1)."""
    model = learn(docs, id_col, text_col, lang_col)
    held: list[Labeller] = []

    def work(batch: pa.RecordBatch) -> dict:
        if not held:
            held.append(Labeller(model))
        found = held[0].label(batch.column("text").to_pylist())
        return {"lang_pred": [lang for lang, _ in found], "score": [p for _, p in found]}

    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    if model is None:
        return rows.drop("text").withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    return per_row(rows, f"`{id_col}` {type_of(docs, id_col)}, held_out boolean, lang_pred string, score double",
                   work, "text", STEP_BYTES // crowd(len(model.languages)))

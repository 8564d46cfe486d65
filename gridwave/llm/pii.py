"""Personal data: exact patterns plus a skip-chain conditional random field.

Base spans come from four patterns (``base_spans``).  On top of them a CRF
labels every candidate token, one that holds a digit or ``@``, as one of the
kinds or as none.  Candidates that follow one another directly are linked in a
chain; candidates that are repeated or similar anywhere in the document (same
text, same digits, same last seven digits, same mail name) are linked by skip
edges, each occurrence to the next, so links grow with the tokens and not with
their pairs.  Loopy belief propagation over both kinds of edges makes labels
agree across the whole text: messages are passed on
until each text's own stand still, however long its chains are.  Base spans
enter as evidence.  A token that comes
out as a kind adds a span; base spans always stay.

The weights are learned by pseudo-likelihood from the base labels of a bounded
sample: about ``FIT_ROWS`` rows by a hash of the id, without those of more than
``FIT_TOKENS`` candidates.  Inference covers every text whole.

A null or empty text has no spans.  Repeated rows are judged each.  An empty table gives no
rows.  Extra columns, whatever their names, are not read (``mask_pii`` returns
them as they are).
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwave.llm.common import hash_sample, per_row, steps, type_of

KINDS = ("email", "ip", "card", "phone")
FIT_ROWS = 20_000
FIT_TOKENS = 200
FIT_STEPS = 300
HIDDEN = 0.5            # share of tokens that hide their features in a step of the fit
ROUNDS = 500            # updates of a text's messages at most, on average over them; ``unsettled`` lists other texts
STILL = 1e-3            # change of a message that counts as none
MIN_PROBABILITY = 0.8   # of a label that adds a span
EVIDENCE = 6.0          # log odds in favour of a base label
TAIL_DIGITS = 7         # last digits by which phone numbers are compared

# --- base spans -----------------------------------------------------------------------

MAIL_NAME = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
MAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits begins: the look-behind changes
# no match and keeps long runs of digits linear.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
HINT = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _ip_ok(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return len(parts) == 4 and all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)


def _card_ok(text: str) -> bool:
    digits = NOT_DIGIT.sub("", text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def _emails(text: str) -> list[tuple[int, int]]:
    """Mail addresses, found from their ``@``: the name is the run before it."""
    out, done = [], 0
    for m in MAIL_HOST.finditer(text):
        name = text[done:m.start()]
        n = len(name) - len(name.rstrip(MAIL_NAME))
        if n:
            out.append((m.start() - n, m.end()))
            done = m.end()
        else:
            done = m.start()
    return out


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every base span in that order; ends are exclusive."""
    if not text or not HINT.search(text):
        return []
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if _ip_ok(m[0])]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if _card_ok(m[0])]
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
                if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out)


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# --- the random field -----------------------------------------------------------------

TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
EDGE_MARKS = ".,;:!?\"'"
DIGIT_BOUNDS = (1, 2, 4, 7, 10, 14, 20)
N_FEATURES = 19
N_LABELS = 1 + len(KINDS)       # 0: none


@dataclass
class Graph:
    """Candidate tokens of some texts and the edges between them."""

    spans: np.ndarray       # n x 3: text, start, end
    features: np.ndarray    # n x N_FEATURES
    labels: np.ndarray      # n: label by base spans
    chain: np.ndarray       # m x 2: token, next token
    skip: np.ndarray        # m x 2


def _features(token: str, before: str, digits: str) -> list[int]:
    n = len(digits)
    size = sum(n >= b for b in DIGIT_BOUNDS)
    out = [0] * N_FEATURES
    out[0] = 1
    out[1 + size] = 1                                   # 1..8
    out[9] = "@" in token
    out[10] = token.startswith("+")
    out[11] = token.startswith("(") and token.endswith(")")
    out[12] = "-" in token
    out[13] = token.count(".") == 3
    out[14] = _ip_ok(token) if token.count(".") == 3 and n == len(token) - 3 else 0
    out[15] = 14 <= n <= 19 and luhn(digits)
    out[16] = any(c.isalpha() for c in token)
    out[17] = before[:1] == "+"
    out[18] = before[:1] == "("
    return [int(x) for x in out]


def _keys(token: str, digits: str) -> list[tuple[str, str]]:
    """What makes two candidates similar; one key of each sort at most."""
    keys = [("text", token.lower())]
    if len(digits) >= TAIL_DIGITS:
        keys += [("digits", digits), ("tail", digits[-TAIL_DIGITS:])]
    if "@" in token:
        keys.append(("name", token.split("@")[0].lower()))
    return keys


def build_graph(texts: list[str | None], bases: list[list[tuple[int, int, int]]]) -> Graph:
    spans, features, labels, chain, skip = [], [], [], [], []
    for t, (text, base) in enumerate(zip(texts, bases)):
        if not text or not HINT.search(text):
            continue
        last: dict[tuple[str, str], int] = {}
        at, prev_end, before = 0, -9, ""
        for m in TOKEN.finditer(text):
            raw = m[0]
            if not HINT.search(raw):
                continue
            token = raw.strip(EDGE_MARKS)
            start = m.start() + len(raw) - len(raw.lstrip(EDGE_MARKS))
            end, i = start + len(token), len(spans)
            digits = NOT_DIGIT.sub("", token)
            near = start - prev_end <= 2
            if near:
                chain.append((i - 1, i))
            while at < len(base) and base[at][2] <= start:
                at += 1
            label = next((k + 1 for a, k, b in base[at:at + 4] if a < end and b > start), 0)
            features.append(_features(token, before if near else "", digits))
            for key in _keys(token, digits):
                if key in last and (not skip or skip[-1] != (last[key], i)):
                    skip.append((last[key], i))
                last[key] = i
            spans.append((t, start, end))
            labels.append(label)
            prev_end, before = end, token
    shape = lambda rows, n: np.array(rows, np.int64).reshape(-1, n)
    return Graph(shape(spans, 3), shape(features, N_FEATURES).astype(float), np.array(labels, np.int64),
                 shape(chain, 2), shape(skip, 2))


@dataclass
class Field:
    """Weights: token features by label, chain (left, right), skip (symmetric).

    Skip weights are shared by the kinds: both none, one none, same kind, two
    kinds.  What holds for repeated mail addresses then holds for phones too.
    """

    node: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def _given_neighbours(field: Field, g: Graph, features: np.ndarray) -> np.ndarray:
    """Log potentials of each token's labels when its neighbours have ``g.labels``."""
    out = features @ field.node + _form(g.features)
    y = g.labels
    if len(g.chain):
        a, b = g.chain.T
        np.add.at(out, b, field.chain[y[a]])
        np.add.at(out, a, field.chain.T[y[b]])
    if len(g.skip):
        a, b = g.skip.T
        np.add.at(out, b, field.skip[y[a]])
        np.add.at(out, a, field.skip[y[b]])
    return out


BARRED = -20.0          # log potential of a label that the token's form rules out
SHARED_SKIP = np.where(np.eye(N_LABELS, dtype=bool), 2, 3)
SHARED_SKIP[0, :] = SHARED_SKIP[:, 0] = 1
SHARED_SKIP[0, 0] = 0


def _form(features: np.ndarray) -> np.ndarray:
    """Rules out mail without @, addresses without three dots, numbers with letters."""
    out = np.zeros((len(features), N_LABELS))
    few = features[:, 1] + features[:, 2] > 0       # no digit, or one
    out[features[:, 9] == 0, 1] = BARRED
    out[features[:, 13] == 0, 2] = BARRED
    out[(features[:, 16] + features[:, 9] > 0) | few, 3] = BARRED
    out[(features[:, 16] + features[:, 9] > 0), 4] = BARRED
    return out


def with_mentions(g: Graph) -> Graph:
    """The graph with a second mention of every token that begins without ``+``.

    A mention carries the token's label, form and chain but nothing of what
    stands before it: from these pairs the skip weights are learned.
    """
    again = np.flatnonzero(g.features[:, 10] == 0)
    at = np.full(len(g.labels), -1)
    at[again] = len(g.labels) + np.arange(len(again))
    features = g.features[again].copy()
    features[:, 17:] = 0
    links = at[g.chain]
    return Graph(np.concatenate([g.spans, g.spans[again]]), np.concatenate([g.features, features]),
                 np.concatenate([g.labels, g.labels[again]]),
                 np.concatenate([g.chain, links[(links >= 0).all(1)]]),
                 np.concatenate([g.skip, np.stack([again, at[again]], 1)]))


def fit_field(g: Graph, rounds: int = FIT_STEPS, l2: float = 1e-4) -> Field:
    """Maximum pseudo-likelihood by Adam; all zero where there are no tokens.

    Every token is mentioned twice, and in every step half of the tokens hide their own features, so that the
    edges learn to carry a label to a token that does not show it itself.
    """
    g = with_mentions(g)
    field = Field(np.zeros((N_FEATURES, N_LABELS)), np.zeros((N_LABELS,) * 2), np.zeros((N_LABELS,) * 2))
    n, y = len(g.labels), g.labels
    if not n:
        return field
    truth, rng = np.eye(N_LABELS)[y], np.random.default_rng(7)
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in vars(field).items()}
    for step in range(1, rounds + 1):
        features = g.features.copy()
        features[rng.random(n) < HIDDEN, 1:] = 0
        logits = _given_neighbours(field, g, features)
        p = np.exp(logits - logits.max(1, keepdims=True))
        off = (truth - p / p.sum(1, keepdims=True)) / n
        grad = {"node": features.T @ off, "chain": np.zeros((N_LABELS,) * 2), "skip": np.zeros((N_LABELS,) * 2)}
        if len(g.chain):
            a, b = g.chain.T
            grad["chain"] = truth[a].T @ off[b] + off[a].T @ truth[b]
        if len(g.skip):
            a, b = g.skip.T
            each = truth[a].T @ off[b] + truth[b].T @ off[a]
            grad["skip"] = (np.bincount(SHARED_SKIP.ravel(), each.ravel())
                            / np.bincount(SHARED_SKIP.ravel()))[SHARED_SKIP]
        for name, d in grad.items():
            w, (m, v) = getattr(field, name), state[name]
            d = d - l2 * w
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            w += 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return field


def passed_messages(field: Field, g: Graph, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of every token by loopy sum-product message passing,
    and whether the messages of its text came to rest.

    Only messages whose sender has changed are worked out again, so a change
    that travels along a long chain costs its length and not its square.  A
    text's result does not hang on the texts beside it.
    """
    node = g.features @ field.node + _form(g.features)
    node[np.arange(len(node)), g.labels] += EVIDENCE * (g.labels > 0)
    pairs = np.concatenate([g.chain, g.chain[:, ::-1], g.skip, g.skip[:, ::-1]])
    m, s = len(g.chain), len(g.skip)
    back = np.concatenate([np.arange(m) + m, np.arange(m), 2 * m + s + np.arange(s), 2 * m + np.arange(s)])
    tables = np.stack([field.chain, field.chain.T, field.skip])
    kind = np.repeat([0, 1, 2], [m, m, 2 * s])
    send, take = pairs[:, 0], pairs[:, 1]
    text = g.spans[:, 0]
    owner, n_texts = text[take], int(text.max(initial=0)) + 1
    left = rounds * np.bincount(owner, minlength=n_texts)
    messages = np.zeros((len(pairs), N_LABELS))
    belief = node.copy()
    due = np.ones(len(pairs), bool)
    while True:
        now = np.flatnonzero(due)
        now = now[left[owner[now]] > 0]
        if not len(now):
            break
        left -= np.bincount(owner[now], minlength=n_texts)
        scores = (belief[send[now]] - messages[back[now]])[:, :, None] + tables[kind[now]]
        top = scores.max(1)
        new = top + np.log(np.exp(scores - top[:, None, :]).sum(1))
        change = new - new.max(1, keepdims=True) - messages[now]
        moved = np.abs(change).max(1) >= STILL
        due[now] = moved
        now, change = now[moved], 0.5 * change[moved]
        messages[now] += change
        np.add.at(belief, take[now], change)
        changed = np.zeros(len(node), bool)
        changed[take[now]] = True
        due |= changed[send]
    p = np.exp(belief - belief.max(1, keepdims=True))
    rest = np.bincount(owner[due], minlength=n_texts) == 0
    return p / p.sum(1, keepdims=True), rest[text]


def marginals(field: Field, g: Graph, rounds: int = ROUNDS) -> np.ndarray:
    return passed_messages(field, g, rounds)[0]


def converged(field: Field, texts: list[str | None]) -> list[bool]:
    """Whether the message passing of each text came to rest."""
    g = build_graph(texts, [base_spans(t) for t in texts])
    out = np.ones(len(texts), bool)
    if len(g.labels):
        out[g.spans[~passed_messages(field, g)[1], 0]] = False
    return out.tolist()


def unsettled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of the rows whose message passing ended at its bound of rounds: their added spans may be off."""
    field = learn_field(docs, id_col, text_col)

    def work(batch: pa.RecordBatch) -> dict:
        return {"converged": converged(field, batch.column("text").to_pylist())}

    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return per_row(rows, f"`{id_col}` {type_of(docs, id_col)}, converged boolean", work, "text") \
        .filter("NOT converged").select(id_col)


def all_spans(field: Field, texts: list[str | None]) -> list[tuple[list, list]]:
    """(base spans, base and added spans) of each text.

    An added span is a token, or several that follow one another, of one kind
    and clear of every base span.
    """
    bases = [base_spans(t) for t in texts]
    g = build_graph(texts, bases)
    added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(g.labels):
        p = marginals(field, g)
        best = p.argmax(1)
        new = (best > 0) & (p.max(1) >= MIN_PROBABILITY) & (g.labels == 0)
        for i in np.flatnonzero(new):
            t, start, end = (int(x) for x in g.spans[i])
            kind, mine = int(best[i]) - 1, added[t]
            if mine and mine[-1][1] == kind and start - mine[-1][2] <= 2 and new[i - 1]:
                mine[-1] = (mine[-1][0], kind, end)
            else:
                mine.append((start, kind, end))
    return [(b, sorted(b + a)) for b, a in zip(bases, added)]


def learn_field(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                fit_rows: int = FIT_ROWS) -> Field:
    """Fit the weights on a bounded sample; its tokens' features come to the driver."""

    def tokens(batches):
        for batch in steps(batches, "text"):
            for text in batch.column("text").to_pylist():
                g = build_graph([text], [base_spans(text)])
                if 0 < len(g.labels) <= FIT_TOKENS:
                    parts = (g.features.astype(np.int8), g.labels, g.chain, g.skip)
                    yield pa.RecordBatch.from_pydict({
                        n: pa.array([x.tobytes()], pa.binary()) for n, x in zip("abcd", parts)})

    texts = docs.select(id_col, F.col(text_col).alias("text"))
    rows = hash_sample(texts, fit_rows).select("text") \
        .mapInArrow(tokens, "a binary, b binary, c binary, d binary").collect()
    rows = sorted(tuple(map(bytes, r)) for r in rows)
    features, labels, chain, skip, n = [], [], [], [], 0
    for a, b, c, d in rows:
        features.append(np.frombuffer(a, np.int8).reshape(-1, N_FEATURES))
        labels.append(np.frombuffer(b, np.int64))
        chain.append(np.frombuffer(c, np.int64).reshape(-1, 2) + n)
        skip.append(np.frombuffer(d, np.int64).reshape(-1, 2) + n)
        n += len(labels[-1])
    if not n:
        return fit_field(build_graph([], []))
    return fit_field(Graph(np.zeros((n, 3), np.int64), np.concatenate(features).astype(float),
                           np.concatenate(labels), np.concatenate(chain), np.concatenate(skip)))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, number of base spans by kind, their SHA-256, all spans."""
    field = learn_field(docs, id_col, text_col)

    def work(batch: pa.RecordBatch) -> dict:
        found = all_spans(field, batch.column("text").to_pylist())
        out = {f"n_{kind}": [sum(s[1] == k for s in b) for b, _ in found] for k, kind in enumerate(KINDS)}
        out["base_sha256"] = [hashlib.sha256(render(b).encode()).hexdigest() for b, _ in found]
        out["spans"] = [render(s) for _, s in found]
        return out

    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return per_row(rows, f"`{id_col}` {type_of(docs, id_col)}, {counts}, base_sha256 string, spans string",
                   work, "text")


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind; spans that touch a masked
    stretch are masked with it, under the kind that begins first."""
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def mask_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span in ``text_col`` replaced by the name of its kind."""
    field = learn_field(docs, id_col, text_col)
    names = [f"_c{i}" for i in range(len(docs.columns))]
    at = names[docs.columns.index(text_col)]

    def work(batch: pa.RecordBatch) -> dict:
        texts = batch.column(at).to_pylist()
        return {at: [t if not s else mask(t, s) for t, (_, s) in zip(texts, all_spans(field, texts))]}

    schema = ", ".join(f"{n} {type_of(docs, c)}" for n, c in zip(names, docs.columns))
    return per_row(docs.toDF(*names), schema, work, at).toDF(*docs.columns)

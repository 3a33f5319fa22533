"""Personal data by patterns, and by a skip-chain conditional random field.

Patterns give the base spans. A two-label field then runs over the tokens that might
identify someone and over all tokens that repeat or resemble them, however far away:
neighbours share a potential, and so do consecutive tokens with the same key, and each
token with one in a base span that has its key. Keys that many documents of
the corpus hold are common words and identify nobody. Loopy message passing makes the labels consistent across the document, so that a user name
is found where it stands alone because its address was found elsewhere.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from queuelens.llm.frames import bounded, kept, strings
from queuelens.plans.joins import broadcast_if_small

KINDS = ("email", "ip", "card", "phone")
ADDED = "identifier"
# What the base spans look like.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

TOKEN = re.compile(r"\S+")
MARK = re.compile(r"[0-9@]")
EDGES = ".,;:!?\"'()[]{}<>"
LEADING = re.compile(r"[^\W\d_]{3,}")
FEATURES = 12
# Different keys that a task counts before it passes them on.
HELD_KEYS = 200_000
# Log odds of a token in a base span, of one whose pattern failed its check, and of a
# token that only shares a key.
IN_BASE, FAILED, SHARES = 6.0, -4.0, -1.5
# Common keys are in so many different texts of the corpus, and in this share of them.
COMMON_TEXTS, COMMON_SHARE = 5, 0.005
# Common whatever the corpus, which may be too small to tell.
ALWAYS_COMMON = frozenset(
    "and are but can for from had has have her his not our out she that the their them they this was "
    "were what when who will with you your aus das der die ein eine für ist mit nicht und von con del "
    "los las para por que una des est les pas pour qui sur une".split())
COUPLING = (0.1, 2.5)
# Potential between a token that only shares a key and one of a base span. As the label of that
# one is known, the link counts as evidence, however many tokens have the key.
NAMED = 2.5
ROUNDS, DAMPING, SETTLED = 30, 0.3, 1e-6
ACCEPTED = float(np.log(9))

Span = tuple[int, int]


def _emails(text: str) -> list[Span]:
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and LOCAL.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            found.append((start, last))
        at = text.find("@", max(at + 1, last))
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def base_spans(text: str) -> tuple[list[list[Span]], list[Span]]:
    """Per kind the spans found, and the spans of matches that failed their check."""
    found: list[list[Span]] = [[], [], [], []]
    failed: list[Span] = []
    if not MARK.search(text):
        return found, failed
    found[0] = _emails(text)
    for m in ADDRESS.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        fits = all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)
        (found[1] if fits else failed).append(m.span())
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19:
            (found[2] if _luhn(digits) else failed).append(m.span())
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            found[3].append(m.span())
    return found, failed


def _inside(tokens: list[Span], spans: list[Span]) -> np.ndarray:
    """Which tokens overlap one of the spans."""
    if not spans or not tokens:
        return np.zeros(len(tokens), bool)
    spans = sorted(spans)
    starts = np.array([s for s, _ in spans])
    reach = np.maximum.accumulate([e for _, e in spans])
    begin, end = np.array(tokens).T
    before = np.searchsorted(starts, end, "left") - 1
    return (before >= 0) & (reach[np.maximum(before, 0)] > begin)


def _key(word: str) -> str | None:
    """What alike tokens have in common: their first letters, or all their digits."""
    letters = LEADING.match(word)
    if letters:
        return letters[0].lower()
    digits = _digits(word)
    return digits if len(digits) >= 5 else None


def features(word: str) -> int:
    """Twelve yes-or-no features of a token as the bits of a number."""
    digits = sum("0" <= c <= "9" for c in word)
    letters = sum(c.isalpha() for c in word)
    tests = (
        "@" in word, digits * 2 > len(word), letters * 2 > len(word), len(word) > 8, len(word) > 20,
        word.count(".") == 3, "-" in word, word[:1] == "+", word.isupper(), "=" in word,
        letters > 0 and digits > 0, digits >= 13)
    return sum(1 << n for n, test in enumerate(tests) if test)


@dataclass
class Graph:
    """The tokens of a document that take part, with what is known of each."""

    spans: list[Span]
    codes: np.ndarray  # features, -1 for tokens that only share a key
    base: np.ndarray
    failed: np.ndarray
    chain: np.ndarray  # pairs of places
    skip: np.ndarray
    named: np.ndarray  # tokens that only share a key, which one in a base span has


class _KeyOf(dict):
    """The key of each token, looked for once."""

    def __missing__(self, token: str) -> str | None:
        key = self[token] = _key(token.strip(EDGES))
        return key


def graph_of(text: str, found: list[list[Span]], failed: list[Span],
             common: frozenset[str] = ALWAYS_COMMON) -> Graph | None:
    """Candidates (tokens with a digit or @), tokens that share their keys, and all links.

    Tokens that only share a ``common`` key are left out.
    """
    spans, words = [], []
    for m in TOKEN.finditer(text):
        word = m[0].strip(EDGES)
        if word:
            begin = m.start() + m[0].index(word)
            spans.append((begin, begin + len(word)))
            words.append(word)
    candidate = [bool(MARK.search(w)) for w in words]
    keys = [_key(w) for w in words]
    wanted = {k for k, c in zip(keys, candidate) if c and k} - common
    places = [i for i, c in enumerate(candidate) if c or keys[i] in wanted]
    if not places:
        return None
    by_key: dict[str, list[int]] = {}
    for n, i in enumerate(places):
        if keys[i]:
            by_key.setdefault(keys[i], []).append(n)
    chain = [(n, n + 1) for n, (i, j) in enumerate(zip(places, places[1:])) if j == i + 1]
    taken = [spans[i] for i in places]
    base = _inside(taken, [s for kind in found for s in kind])
    codes = np.array([features(words[i]) if candidate[i] else -1 for i in places])
    skip = [pair for group in by_key.values() for pair in zip(group, group[1:])]
    named = np.zeros(len(places), bool)
    for group in by_key.values():
        named[group] = base[group].any()
    return Graph(
        taken, codes, base, _inside(taken, failed), np.array(chain, np.int64).reshape(-1, 2),
        np.array(skip, np.int64).reshape(-1, 2), named & (codes < 0))


@dataclass
class Weights:
    """Weight per feature with the intercept last, the two shared potentials, common keys."""

    unary: np.ndarray
    chain: float
    skip: float
    common: frozenset[str] = ALWAYS_COMMON


def beliefs(unary: np.ndarray, edges: np.ndarray, coupling: np.ndarray) -> np.ndarray:
    """Log odds of every node after loopy belief propagation.

    Labels are +1 and -1; an edge adds ``coupling`` if its ends agree. All messages are
    passed at once, damped, until they settle.
    """
    if not len(edges):
        return unary
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    pull = np.tanh(np.concatenate([coupling, coupling]))
    message = np.zeros(len(source))
    for _ in range(ROUNDS):
        field = unary + np.bincount(target, message, len(unary))
        sent = 2 * np.arctanh(pull * np.tanh((field[source] - message[back]) / 2))
        step = (1 - DAMPING) * (sent - message)
        message += step
        if np.abs(step).max() < SETTLED:
            break
    return unary + np.bincount(target, message, len(unary))


def added_spans(text: str, found: list[list[Span]], failed: list[Span],
                weights: Weights) -> list[Span]:
    """Tokens outside the base spans that the field labels as identifying."""
    graph = graph_of(text, found, failed, weights.common) if MARK.search(text) else None
    if graph is None:
        return []
    bits = graph.codes[:, None] >> np.arange(FEATURES) & 1
    unary = bits @ weights.unary[:-1] + weights.unary[-1]
    unary = np.where(graph.codes < 0, SHARES, unary)
    unary = np.where(graph.failed, FAILED, unary)
    unary += np.where(graph.named, 2 * np.arctanh(np.tanh(NAMED) * np.tanh(IN_BASE / 2)), 0.0)
    unary = np.where(graph.base, IN_BASE, unary)
    edges = np.concatenate([graph.chain, graph.skip])
    coupling = np.repeat([weights.chain, weights.skip], [len(graph.chain), len(graph.skip)])
    likely = (beliefs(unary, edges, coupling) >= ACCEPTED) & ~graph.base & ~graph.failed
    return [graph.spans[i] for i in np.flatnonzero(likely)]


def common_keys(texts: DataFrame) -> frozenset[str]:
    """Keys that many of the different texts (column ``text``) hold; copies of a text count once.

    Only texts that have copies are told, by a hash; the texts themselves are not shuffled
    unless very many have some. A key is counted apart for every number of copies.
    """
    hashed = texts.select("text", F.unhex(F.md5("text")).alias("hash"))
    several = kept(hashed.groupBy("hash").agg(F.count("*").alias("copies")).where("copies > 1"), "repeated-texts")
    told = hashed.join(broadcast_if_small(several), "hash", "left").select(
        "text", F.coalesce("copies", F.lit(1)).alias("copies"))

    def list_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter[str]] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for copies, of_keys in counts.items():
                of_keys.pop(None, None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(of_keys), pa.string()), pa.array([copies] * len(of_keys), pa.int64()),
                     pa.array(list(of_keys.values()), pa.int64())], names=["key", "copies", "n"])
            counts.clear()

        for batch in bounded(batches):
            key_of = _KeyOf().__getitem__
            for whole, copies in zip(strings(batch).to_pylist(), batch.column("copies").to_pylist()):
                counts.setdefault(copies, Counter()).update(set(map(key_of, TOKEN.findall(whole))))
            if sum(map(len, counts.values())) > HELD_KEYS:
                yield from counted()
        yield from counted()

    surplus = several.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))).first()[0]
    least = max(COMMON_TEXTS, COMMON_SHARE * (texts.count() - surplus))
    rows = told.mapInArrow(list_keys, "key string, copies bigint, n bigint").groupBy("key", "copies").agg(
        F.sum("n").alias("n"))
    counted = rows.groupBy("key").agg(F.sum(F.expr("n div copies")).alias("n"))
    # Bounded by the keys of a text over the share, as each takes that share of the texts.
    return ALWAYS_COMMON.union(r.key for r in counted.where(F.col("n") >= least).select("key").collect())


def fit(docs: DataFrame, text: str = "text") -> Weights:
    """Weights from all documents; their base spans serve as labels.

    Tokens are counted by their feature code, and linked pairs by their two labels, so a
    few thousand counts reach the driver. Neither the patterns nor their checks are
    features. Without candidates nothing but the shared potentials can label a token.
    """
    texts = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    common = common_keys(texts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[str, int, int]] = Counter()
        for batch in bounded(batches):
            for whole in strings(batch).to_pylist():
                graph = graph_of(whole, *base_spans(whole), common) if MARK.search(whole) else None
                if graph is None:
                    continue
                label = graph.base.astype(int)
                own = graph.codes >= 0
                counts.update(zip(repeat("token"), graph.codes[own].tolist(), label[own].tolist()))
                for kind, pairs in (("chain", graph.chain), ("skip", graph.skip)):
                    pairs = pairs[own[pairs].all(axis=1)]
                    same = label[pairs[:, 0]] == label[pairs[:, 1]]
                    counts.update((kind, 0, int(s)) for s in same)
        kinds, codes, labels = zip(*counts) if counts else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.string()), pa.array(codes, pa.int64()), pa.array(labels, pa.int64()),
             pa.array(list(counts.values()), pa.int64())], names=["kind", "code", "label", "n"])

    counted = texts.mapInArrow(count, "kind string, code bigint, label bigint, n bigint").groupBy(
        "kind", "code").agg(F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("positive")).collect()
    agree = {r.kind: 0.5 * np.log((r.positive + 1) / (r.n - r.positive + 1))
             for r in counted if r.kind != "token"}
    tokens = sorted((r.code, r.n, r.positive) for r in counted if r.kind == "token")
    coupling = [float(np.clip(agree.get(k, 0.0), *COUPLING)) for k in ("chain", "skip")]
    return Weights(_logistic(tokens), *coupling, common)


def _logistic(tokens: list[tuple[int, int, int]], ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression on counted feature codes, by Newton's method."""
    weights = np.append(np.zeros(FEATURES), -4.0)
    if not tokens:
        return weights
    codes, n, positive = np.array(tokens, np.int64).T
    x = np.append(codes[:, None] >> np.arange(FEATURES) & 1, np.ones((len(codes), 1), int), axis=1)
    prior = weights.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (positive - n * p) - ridge * (weights - prior)
        bend = (x.T * (n * p * (1 - p))) @ x + ridge * np.eye(FEATURES + 1)
        weights = weights + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return weights


def spans_of(text: str, weights: Weights) -> list[tuple[str, int, int]]:
    """All spans: base kinds in their order, then added ones, each by start."""
    found, failed = base_spans(text)
    base = [(kind, a, b) for kind, spans in zip(KINDS, found) for a, b in spans]
    return base + [(ADDED, a, b) for a, b in added_spans(text, found, failed, weights)]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans): a row per row of ``docs``.

    Counts and the hash are of base spans; ``spans`` also has the added ones, of kind
    ``identifier``. Offsets count code points. Null text is empty. Extra columns are ignored.
    """
    weights = fit(docs, text)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            counts, hashes, texts = [], [], []
            for whole in strings(batch).to_pylist():
                spans = spans_of(whole, weights)
                base = [s for s in spans if s[0] != ADDED]
                counts.append([sum(s[0] == kind for s in base) for kind in KINDS])
                hashes.append(hashlib.sha256(joined(base).encode()).hexdigest())
                texts.append(joined(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in zip(*counts)),
                 pa.array(hashes), pa.array(texts)],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(compute, f"doc_id {kind}, " + ", ".join(
        f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string")


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with every span replaced by its kind; of overlapping ones the first counts."""
    parts, last = [], 0
    for kind, begin, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if begin >= last:
            parts += [text[last:begin], f"[{kind.upper()}]"]
        last = max(last, end)
    return "".join(parts) + text[last:]


def masked(docs: DataFrame, key: str = "doc_id", text: str = "text",
           length: str = "n_chars") -> DataFrame:
    """``docs`` with all spans masked in ``text``, and ``length`` (if there) counted anew.

    Texts without a span, and null ones, stay as they are.
    """
    weights = fit(docs, text)

    @F.arrow_udf("string")
    def compute(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            texts = (text.as_py() for text in part)
            yield pa.array([t if t is None else mask(t, spans_of(t, weights)) for t in texts], pa.string())

    changed = docs.withColumn(text, compute(F.col(text)))
    if length in docs.columns:
        changed = changed.withColumn(length, F.char_length(text).cast(docs.schema[length].dataType))
    return changed.select(docs.columns)

"""Toxicity by non-negative positive-unlabelled learning.

Classifiers learn from texts confirmed as toxic and from unlabelled texts, of which a
share (the class prior) is toxic as well. The risk of calling unlabelled texts clean is
corrected by the risk of calling toxic texts clean; where the difference would turn
negative, which only overfitting explains, the step goes the other way.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from queuelens.llm.frames import bounded, kept, strings
from queuelens.plans.joins import broadcast_if_small

FOLDS = 5
# About how many confirmed texts make a classifier of their own, and how many texts one learns
# from. All texts are dealt out by a hash, so more of them make more classifiers.
CONFIRMED = 3000
UNLABELLED = 100_000
# Ids of confirmed texts that may be sent to every executor.
SENT_IDS = 1_000_000
STEPS = 400
RATE = 0.05
# A feature is learnt from if it is in so many confirmed texts and this share of them, so many
# times as often there as in unlabelled ones, and so many standard errors above their share.
LEAST_TEXTS, LEAST_SHARE, LEAST_LIFT, LEAST_ERRORS = 3, 0.01, 2.5, 5.0
# Odd factors that order hashes in four ways.
MIXERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
# The score, before squashing, of every text if no toxic text is known.
NONE_KNOWN = -20.0
WORD = re.compile(r"[^\W\d_]+")
REMEMBERED = 200_000
# Words of a passage. A text is as toxic as its worst passage, so that signs too weak to tell
# anything do not add up over a long text, and a toxic part counts however long the rest is.
PASSAGE = 400


def features(word: str) -> list[int]:
    """Features of a lower-case word: itself and its first four and five letters.

    63 bits of a hash name each, so that no two of any corpus are taken for one another.
    """
    parts = {word, word[:4] + "*", word[:5] + "*"}
    return [xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass")) >> 1 for p in parts]


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def text_features(text: str | None) -> np.ndarray:
    """The distinct features of a text, sorted."""
    return np.unique(np.array([f for w in words_of(text) for f in features(w)], np.int64))


def smallest_hashes(text: str | None) -> list[int]:
    """The smallest hash of all runs of three words, in four orders; none for no words."""
    words = WORD.findall((text or "").lower())
    values = np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
                       for w in words], np.uint64)
    if len(values) > 2:
        values = values[:-2] * np.uint64(3) + values[1:-1] * np.uint64(5) + values[2:]
    return [int((values * np.uint64(m)).min()) >> 1 for m in MIXERS] if words else []


def different(hashes: list[list[int]]) -> list[int]:
    """Places of texts that are no near copy of an earlier one, from their smallest hashes.

    Copies share most runs of three words, and so one of the four smallest hashes.
    Without this, any word of a text that was copied often would seem to tell toxicity.
    """
    seen, places = set(), []
    for place, four in enumerate(hashes):
        mixed = list(enumerate(four))
        if seen.isdisjoint(mixed):
            places.append(place)
        seen.update(mixed)
    return places


def _often(n_texts: int) -> float:
    """In how many of ``n_texts`` confirmed texts a feature must be."""
    return max(LEAST_TEXTS, LEAST_SHARE * n_texts)


def _telling(found: np.ndarray, toxic: np.ndarray, others: np.ndarray, n_toxic: int, n_others: int) -> np.ndarray:
    """Of the features ``found``, which are clearly more frequent in confirmed than in unlabelled texts.

    ``toxic`` and ``others`` say in how many of them each feature is.
    """
    share = toxic / n_toxic
    usual = (others + 1) / (n_others + 1)
    errors = (share - usual) / np.sqrt(usual * np.maximum(1 - usual, 1e-9) / n_toxic)
    return found[(share >= LEAST_LIFT * usual) & (errors >= LEAST_ERRORS)]


def _places(found: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The places in ``found`` of the features that ``row`` holds as well; both are sorted."""
    return np.intersect1d(found, row, assume_unique=True, return_indices=True)[1]


def _unlearnt() -> pd.Series:
    return pd.Series([], np.array([], np.int64), float)


def train(rows: list[np.ndarray], confirmed: np.ndarray, prior: float) -> tuple[pd.Series, float]:
    """Weights by feature and intercept that minimise the non-negative risk estimate.

    ``rows`` are the features of each text. Weights stay at zero or above, as only signs
    of toxicity are learnt from; features without a weight are left out.
    """
    if confirmed.all() or not confirmed.any():
        return _unlearnt(), NONE_KNOWN
    n_toxic = int(confirmed.sum())
    found, toxic = np.unique(np.concatenate([rows[i] for i in np.flatnonzero(confirmed)]), return_counts=True)
    often = toxic >= _often(n_toxic)
    found, toxic = found[often], toxic[often]
    others = np.bincount(np.concatenate([_places(found, rows[i]) for i in np.flatnonzero(~confirmed)]),
                         minlength=len(found))
    telling = _telling(found, toxic, others, n_toxic, len(rows) - n_toxic)
    return minimised([_places(telling, row) for row in rows], np.ones(len(rows)), confirmed, telling, prior)


def minimised(rows: list[np.ndarray], texts: np.ndarray, confirmed: np.ndarray, telling: np.ndarray,
              prior: float) -> tuple[pd.Series, float]:
    """What ``train`` returns, for rows that hold places in ``telling`` and stand for ``texts`` texts each."""
    n = len(telling)
    weights, bias = np.zeros(n), -1.0
    first, second = np.zeros(n + 1), np.zeros(n + 1)
    flat, owner, share = [], [], []
    for side in (confirmed, ~confirmed):
        chosen = [rows[i] for i in np.flatnonzero(side)]
        flat.append(np.concatenate(chosen).astype(np.int64))
        owner.append(np.repeat(np.arange(len(chosen)), [len(row) for row in chosen]))
        share.append(texts[side] / texts[side].sum())

    for step in range(1, STEPS + 1):
        toxic, any_ = (
            1 / (1 + np.exp(-(np.bincount(o, weights[f], len(s)) + bias)))
            for f, o, s in zip(flat, owner, share))
        # Slopes of the risks (sigmoid loss) of calling toxic and unlabelled texts clean.
        slope_p = prior * toxic * (1 - toxic) * share[0]
        slope_u = any_ * (1 - any_) * share[1]
        if any_ @ share[1] - prior * (toxic @ share[0]) >= 0:
            slope_p = -2 * slope_p
        else:
            slope_u = -slope_u
        slope = np.bincount(np.append(*flat), np.append(slope_p[owner[0]], slope_u[owner[1]]),
                            n + 1)
        slope[n] = slope_p.sum() + slope_u.sum()
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        move = RATE * first / (1 - 0.9 ** step) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        weights = np.maximum(weights - move[:n], 0)
        bias -= move[n]
    return pd.Series(weights, telling)[weights > 0], bias


class _Learnt(dict):
    """The weighted features of each word; forgets all when it holds too many words."""

    def __init__(self, weights: pd.Series):
        super().__init__()
        self.weights = weights.to_dict()

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = tuple(f for f in features(word) if f in self.weights)
        return found


def strongest(words: list[str], learnt: _Learnt) -> float:
    """The largest weight of the distinct features in any ``PASSAGE`` consecutive words."""
    hits = [(place, found) for place, found in enumerate(map(learnt.__getitem__, words)) if found]
    best, first, held = 0.0, 0, Counter()
    for place, found in hits:
        while hits[first][0] <= place - PASSAGE:
            held.subtract(hits[first][1])
            first += 1
        new = any(held[f] <= 0 for f in found)
        held.update(found)
        if new:
            best = max(best, sum(learnt.weights[f] for f in sorted(held) if held[f] > 0))
    return best


def held_out(key: Column) -> Column:
    """Whether labels of the row are kept for measuring; false where there is no id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


class _Found(dict):
    """The places of each word's features among those that are looked for; forgets like ``_Learnt``."""

    def __init__(self, found: np.ndarray):
        super().__init__()
        self.place = {f: n for n, f in enumerate(found.tolist())}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = places = tuple(self.place[f] for f in features(word) if f in self.place)
        return places


def described(texts: DataFrame) -> DataFrame:
    """(key, confirmed, hashes, features) of every row of (key, confirmed, text).

    Only confirmed texts get features, as only those that are frequent there matter later.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            rows = list(zip(strings(batch).to_pylist(), batch.column("confirmed").to_pylist()))
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("confirmed"), pa.array([smallest_hashes(t) for t, _ in rows], kind),
                 pa.array([text_features(t) if c else [] for t, c in rows], kind)],
                names=["key", "confirmed", "hashes", "features"])

    return texts.select("key", "confirmed", "text").mapInArrow(
        describe, "key bigint, confirmed boolean, hashes array<bigint>, features array<bigint>")


def different_texts(rows: DataFrame) -> DataFrame:
    """The keys of (key, hashes) that ``different`` leaves if texts come in the order of their keys.

    A text stays that is the first with each of its four hashes; one without words always does.
    """
    runs = rows.select("key", F.posexplode("hashes").alias("place", "hash"))
    firsts = runs.groupBy("place", "hash").agg(F.min("key").alias("key")).groupBy("key").count()
    return firsts.where(F.col("count") == len(MIXERS)).select("key").union(
        rows.where("size(hashes) = 0").select("key").distinct())


def _placed(texts: DataFrame, found: np.ndarray) -> DataFrame:
    """(key, places): which of the features ``found`` each text holds, in order."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word = _Found(found)
        for batch in bounded(batches):
            places = [sorted({p for w in words_of(t) for p in of_word[w]}) for t in strings(batch).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(places, pa.list_(pa.int32()))], names=["key", "places"])

    return texts.select("key", "text").mapInArrow(place, "key bigint, places array<int>")


def _times(places: DataFrame, size: int) -> np.ndarray:
    """In how many rows each of ``size`` places is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(size, np.int64)
        for batch in batches:
            times += np.bincount(batch.column("places").flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(times[held])], names=["place", "n"])

    times = np.zeros(size, np.int64)
    for r in places.select("places").mapInArrow(count, "place bigint, n bigint").groupBy("place").agg(
            F.sum("n").alias("n")).collect():
        times[r.place] = r.n
    return times


def _reduced(rows: DataFrame, telling: np.ndarray, found: np.ndarray | None = None) -> DataFrame:
    """(key, places): the places in ``telling`` of what each row of (key, held) holds.

    ``held`` are features, or places in ``found`` if that is given.
    """

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("held")
            values, ends = held.flatten().to_numpy(), np.cumsum(np.append(0, pc.list_value_length(held).to_numpy()))
            values = values if found is None else found[values]
            tells = np.isin(values, telling)
            until = np.append(0, np.cumsum(tells))[ends]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.ListArray.from_arrays(
                    pa.array(until, pa.int32()), pa.array(np.searchsorted(telling, values[tells]), pa.int32()))],
                names=["key", "places"])

    return rows.select("key", "held").mapInArrow(reduce, "key bigint, places array<int>")


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "toxic") -> tuple[pd.Series, float]:
    """Mean weights and intercept of the classifiers; one task trains each.

    Features are counted in all texts. Each text is then dealt to a classifier as the places
    of the few features that tell something, and equal ones are counted. Where there are more
    classifiers than confirmed texts for them, several share theirs.

    Only labels outside the held-out fold are read. Of labels that repeat an id the
    largest counts, and ids without a document or null ids teach nothing. Near copies
    teach once; a text is known by 64 bits of a hash.
    """
    known = (
        labels.select(F.col(key).cast("bigint").alias("id"), F.col(label).alias("toxic"))
        .where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    )
    n_known, n_toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_toxic:
        return _unlearnt(), NONE_KNOWN
    prior = n_toxic / n_known
    toxic = broadcast_if_small(known.where("toxic = 1").select("id", F.lit(True).alias("marked")), SENT_IDS)
    texts = docs.select(
        F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    texts = texts.where(~held_out(F.col("id")) & F.col("id").isNotNull()).join(toxic, "id", "left").select(
        F.xxhash64("text").alias("key"), F.coalesce("marked", F.lit(False)).alias("confirmed"), "text")

    rows = kept(described(texts), "described-texts")
    confirmed = rows.where("confirmed").dropDuplicates(["key"])
    confirmed = kept(confirmed.join(different_texts(confirmed), "key", "left_semi"), "confirmed-texts")
    n_confirmed = confirmed.count()
    if not n_confirmed:
        return _unlearnt(), NONE_KNOWN
    # Bounded by the features of a text over the share.
    often = sorted(confirmed.select(F.explode("features").alias("feature")).groupBy("feature").agg(
        F.count("*").alias("n")).where(F.col("n") >= _often(n_confirmed)).collect())
    found, n_found = (np.array([r[i] for r in often], np.int64) for i in range(2))

    unlabelled = kept(_placed(texts, found).dropDuplicates(["key"]).join(
        different_texts(rows.select("key", "hashes")), "key", "left_semi"), "unlabelled-texts")
    n_texts = unlabelled.count()
    telling = _telling(found, n_found, _times(unlabelled, len(found)), n_confirmed, n_texts)

    groups = max(1, n_confirmed // CONFIRMED)
    models = max(groups, -(-n_texts // UNLABELLED))
    group, model = (F.pmod(F.xxhash64("key", F.lit(n)), F.lit(n)).cast("int") for n in (groups, models))
    shared = _reduced(confirmed.withColumnRenamed("features", "held"), telling).select(
        F.explode(F.sequence(group, F.lit(models - 1), F.lit(groups))).alias("model"),
        F.lit(True).alias("confirmed"), "places")
    own = _reduced(unlabelled.withColumnRenamed("places", "held"), telling, found).select(
        model.alias("model"), F.lit(False).alias("confirmed"), "places")

    def fit(part: pa.Table) -> pa.Table:
        table = part.combine_chunks()
        confirmed, places = table.column("confirmed").to_numpy(), table.column("places").to_pylist()
        # Rows arrive in any order; this one is always the same.
        order = sorted(range(len(places)), key=lambda i: (confirmed[i], places[i]))
        weights, bias = minimised([np.array(places[i], np.int64) for i in order],
                                  table.column("n").to_numpy()[order], confirmed[order], telling, prior)
        return pa.table({
            "features": pa.array([weights.index.tolist()], pa.list_(pa.int64())),
            "weights": pa.array([weights.tolist()], pa.list_(pa.float64())), "bias": [bias]})

    fitted = shared.union(own).groupBy("model", "confirmed", "places").agg(F.count("*").alias("n")).groupBy(
        "model").applyInArrow(fit, "features array<bigint>, weights array<double>, bias double").collect()
    every = pd.concat([pd.Series(r.weights, np.array(r.features, np.int64), float) for r in fitted])
    return every.groupby(level=0).sum() / len(fitted), float(np.mean(sorted(r.bias for r in fitted)))


def scored(docs: DataFrame, model: tuple[pd.Series, float], text: str = "text",
           score: str = "score") -> DataFrame:
    """``docs`` with a column from 0 to 1, higher where a text is likelier toxic.

    Every passage of the whole text is looked at, and the worst one gives the score; in it
    each feature counts once. A text without words, null too,
    has the score of the intercept. A column named like ``score`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def compute(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, bias = shared.value
        learnt = _Learnt(weights)
        for part in parts:
            sums = np.full(len(part), bias)
            for row, text in enumerate(part):
                sums[row] += strongest(WORD.findall((text.as_py() or "").lower()), learnt)
            yield pa.array(1 / (1 + np.exp(-np.clip(sums, -700, 700))))

    return docs.withColumn(score, compute(F.col(text)))


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
             label: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per row of ``docs``."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return scored(rows, learn(docs, labels, key, text, label)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))

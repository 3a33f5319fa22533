"""Quality rules and a hashed n-gram log-likelihood ratio, in DataFrame functions only.

A document's score is the mean log ratio of its words and word pairs under two
multinomials over hash buckets: texts trusted as good, and the whole raw corpus. Every
document is kept or not by a fixed threshold on that score.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from queuelens.llm.frames import kept

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
BUCKETS = 1 << 16
# Trusted texts that the target distribution is counted over, at most; picked by a hash of the id.
TRUSTED = 50_000
# The target starts from this many n-grams distributed like the raw corpus, so that n-grams
# which few trusted texts could hold do not count against a document.
# No score is below log(PRIOR / (T + PRIOR)) for T trusted n-grams: under about 42,400 of them
# none reaches THRESHOLD, and the ratio rejects nothing.
PRIOR = 4 * BUCKETS
THRESHOLD = -0.15
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text: what six ASCII white-space characters separate."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def _pairs(h: Column, apart: int) -> Column:
    """Hashes of each element with the one ``apart`` places later."""
    firsts = F.slice(h, F.lit(1), F.greatest(F.size(h) - apart, F.lit(0)))
    return F.transform(firsts, lambda x, i: F.xxhash64(x, F.get(h, i + apart)))


def _repeated(h: Column) -> Column:
    """How many words lie in a window of eight that occurs twice or more.

    ``h`` are word hashes; windows are compared by 64-bit hashes of theirs.
    """

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(
            places, start,
            lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"),
                                  p.alias("last")),
            lambda a: a["n"])

    def places(ordered: Column) -> Column:
        same = lambda e, k: F.coalesce(F.get(ordered, k)["h"] == e["h"], F.lit(False))
        return F.array_sort(F.array_compact(F.transform(
            ordered, lambda e, k: F.when(same(e, k - 1) | same(e, k + 1), e["i"]))))

    def count(whole: Column) -> Column:
        ordered = F.array_sort(F.transform(
            whole, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(whole)) == F.size(whole), F.lit(0).cast("bigint")
                      ).otherwise(let(let(ordered, places), covered))

    return let(h, lambda one: let(_pairs(one, 1), lambda two: let(
        _pairs(two, 2), lambda four: let(_pairs(four, 4), count))))


def _buckets(h: Column) -> Column:
    """The buckets of all words and word pairs."""
    return F.transform(F.concat(h, _pairs(h, 1)),
                       lambda x: x.bitwiseAND(F.lit(BUCKETS - 1).cast("bigint")).cast("int"))


def _hashed(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def log_ratios(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
               label: str = "quality") -> DataFrame:
    """One row: an array with the log ratio of target to raw corpus of every bucket.

    Raw counts cover all documents. The target is counted over the documents labelled 1,
    ``TRUSTED`` of them at most.
    """
    good = labels.where(F.col(label) == 1).select(F.col(key).cast("bigint").alias("id"))
    good = good.where("id IS NOT NULL").distinct()
    share = min(1.0, TRUSTED / max(1, good.count()))
    picked = good.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    trusted = picked.orderBy(F.xxhash64("id"), "id").limit(TRUSTED).withColumn("trusted", F.lit(1))
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    ngrams = rows.join(F.broadcast(trusted), "id", "left").select(
        F.coalesce("trusted", F.lit(0)).alias("trusted"),
        F.explode(let(_hashed(words(F.col("text"))), _buckets)).alias("bucket"))
    counts = kept(ngrams.groupBy("bucket").agg(
        F.count("*").alias("raw"), F.sum("trusted").alias("target")), "ngrams")
    totals = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"),
                        F.coalesce(F.sum("target"), F.lit(0)).alias("target")).first()

    share_of_raw = (F.coalesce("raw", F.lit(0)) + 1) / (totals["raw"] + BUCKETS)
    share = (F.coalesce("target", F.lit(0)) + PRIOR * share_of_raw) / (totals["target"] + PRIOR)
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    ratios = every.join(counts, "bucket", "left").select(
        "bucket", F.log(share / share_of_raw).alias("r"))
    return ratios.agg(F.array_sort(F.collect_list(F.struct("bucket", "r")))["r"].alias("ratios"))


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
            label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """Counts, base rules, score and verdict: one row per row of ``docs``.

    A null or empty text has no words, so it fails the base rules; its score is 0.
    Without a trusted document the target is the raw corpus, and all scores are 0. Extra
    columns of the input are ignored.
    """
    ratios = kept(log_ratios(docs, labels, key, text, label), "log-ratios").scalar()
    whole = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def facts(w: Column, h: Column, r: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("bigint"), lambda n, x: n + F.char_length(x)).alias("word_chars"),
            _repeated(h).alias("n_repeat_words"),
            F.aggregate(_buckets(h), F.lit(0.0), lambda s, b: s + F.get(r, b)).alias("ratio"))

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    with_ratios = rows.withColumn("ratios", ratios)
    counted = with_ratios.select(
        "doc_id",
        let(words(F.col("text")), lambda w: let(
            _hashed(w), lambda h: facts(w, h, F.col("ratios")))).alias("f"),
        F.regexp_count(whole, F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")).alias("n_dup_lines"))
    n = F.col("f.n_words")
    failed = (n < LEAST_WORDS) | (F.col("f.n_repeat_words") * 100 > n * MOST_REPEATED)
    scored = counted.select(
        "doc_id", "f.n_words", "f.word_chars", "n_symbols", "n_dup_lines", "f.n_repeat_words",
        failed.alias("base_failed"),
        # Words and pairs: 2n - 1 of them.
        (F.col("f.ratio") / F.greatest(2 * n - 1, F.lit(1))).alias("score"))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))

"""Quotation linking: what a message quotes, from which message, and in what reply order.

Lines that start with ``>`` marks are quoted, one level per mark. Quoted passages are
normalised, hashed and joined to the lines and paragraphs that earlier messages of the
conversation wrote themselves. A message replies to the one that most of its outermost
quoted text comes from. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from queuelens.llm.frames import kept
from queuelens.llm.quality import let
from queuelens.plans.joins import join_on_key
from queuelens.plans.ordered import ranked, running

MARKS = r"^((?:[ \t]*>)+)[ \t]?"
NEITHER_LETTER_NOR_DIGIT = r"[^\p{L}\p{N}]+"
# A line that ends like this right before a quotation only introduces it.
INTRODUCES = r"(^|[^\p{L}])(wrote|schrieb|écrit|escribió)\s*:\s*$"


def normalised(text: Column) -> Column:
    """Lower case, with one space between runs of letters and digits."""
    return F.trim(F.regexp_replace(F.lower(text), NEITHER_LETTER_NOR_DIGIT, " "))


def parsed_lines(text: Column) -> Column:
    """An array of (level, body): the number of ``>`` marks of each line and its text."""
    lines = F.split(F.coalesce(text, F.lit("")), "\r?\n")
    return F.transform(lines, lambda line: F.struct(
        F.regexp_count(F.regexp_extract(line, MARKS, 1), F.lit(">")).alias("level"),
        F.regexp_replace(line, MARKS, "").alias("body")))


def _introduces(lines: Column, line: Column, i: Column) -> Column:
    following = F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0
    return (line["level"] == 0) & following & line["body"].rlike(INTRODUCES)


def own_text(lines: Column) -> Column:
    """What the message itself says: lines without marks, without introductions."""
    own = F.transform(lines, lambda line, i: F.when(
        (line["level"] == 0) & ~_introduces(lines, line, i), line["body"]))
    return F.regexp_replace(F.array_join(F.array_compact(own), "\n"), r"^\s+|\s+$", "")


def passages(lines: Column) -> Column:
    """An array of (level, text, hash): every line, and every paragraph of several lines.

    A paragraph is a run of lines of one level without an empty one. Lines that only
    introduce a quotation, and those without a letter or digit, are left out.
    """
    plain = F.transform(lines, lambda line, i: F.struct(
        line["level"].alias("level"),
        F.when(_introduces(lines, line, i), F.lit("")).otherwise(normalised(line["body"])).alias("text")))

    def grouped(rows: Column) -> Column:
        starts = F.array_compact(F.transform(rows, lambda row, i: F.when(
            (row["text"] != "") & ((i == 0) | (F.get(rows, i - 1)["text"] == "")
                                   | (F.get(rows, i - 1)["level"] != row["level"])), i)))
        ends = F.array_compact(F.transform(rows, lambda row, i: F.when(
            (row["text"] != "") & (F.coalesce(F.get(rows, i + 1)["text"], F.lit("")).isin("")
                                   | (F.get(rows, i + 1)["level"] != row["level"])), i)))
        runs = F.arrays_zip(starts.alias("first"), ends.alias("last"))
        paragraphs = F.transform(F.filter(runs, lambda r: r["last"] > r["first"]), lambda r: F.struct(
            F.get(rows, r["first"])["level"].alias("level"),
            F.array_join(F.slice(rows, r["first"] + 1, r["last"] - r["first"] + 1)["text"], " ")
            .alias("text")))
        return F.concat(F.filter(rows, lambda row: row["text"] != ""), paragraphs)

    return F.transform(let(plain, grouped), lambda p: F.struct(
        p["level"].alias("level"), p["text"].alias("text"), F.xxhash64(p["text"]).alias("hash")))


def _roots(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn, depth) of every reply, by doubling the way up each round."""
    up = kept(replies.select("conv_id", "turn", F.col("parent_turn").alias("root_turn"),
                             F.lit(1).cast("bigint").alias("depth")), "roots")
    while True:
        above = up.select("conv_id", F.col("turn").alias("root_turn"),
                          F.col("root_turn").alias("__up"), F.col("depth").alias("__by"))
        further = join_on_key(up, above, ["conv_id", "root_turn"], "left")
        moved = kept(further.select(
            "conv_id", "turn", F.coalesce("__up", "root_turn").alias("root_turn"),
            (F.col("depth") + F.coalesce("__by", F.lit(0))).alias("depth"),
            F.col("__up").isNotNull().alias("moved")), "roots")
        up = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return up


def sources(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, hash, chars, source_turn): where each quoted passage comes from.

    The source is the latest earlier message of the conversation with that passage among
    its own; null if there is none. ``messages`` has conv_id, turn and the ``passages``, each
    (level, chars, hash). Own passages nobody quotes are left behind before they are shuffled
    again, and a conversation without a quotation takes no part.
    """
    found = messages.where(F.col("turn").isNotNull()).select(
        "conv_id", "turn", F.explode("passages").alias("p")).select(
        "conv_id", "turn", "p.level", "p.hash", "p.chars")
    quoted = kept(found.where("level > 0").distinct(), "quoted")
    wanted = quoted.select("conv_id", "hash").distinct()
    written = found.where("level = 0")
    answered = join_on_key(written, wanted, ["conv_id", "hash"], "left_semi").distinct()
    rows = quoted.union(answered)
    # Of one turn, quotations come first, so that they only see earlier messages.
    rows = rows.withColumn("writes", (F.col("level") == 0).cast("int"))
    latest = running(rows, ["conv_id", "hash"], ["turn", "writes", "level"],
                     {"source_turn": ("max", F.when(F.col("level") == 0, F.col("turn")))})
    return latest.where("level > 0").drop("writes")


def reply_order(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn",
                role: str = "role", text: str = "text") -> DataFrame:
    """Every message without its quotations, in reply order.

    Returns conv_id, turn, role, text (own text only), n_quoted and n_linked (distinct
    quoted lines and paragraphs, and those found in an earlier message), parent_turn (null
    if it replies to none), root_turn, depth and place (from 1 within the conversation:
    thread by thread, a message always after the one it replies to). The parent is the
    source of most characters quoted at the outermost linked level, the latest if tied.

    Messages that repeat a turn share parent, root and depth, and each keeps its row; null
    conversations are one conversation. Without a turn a message links to nothing and
    comes last. Null text is empty. Extra columns are ignored.
    """
    parsed = messages.select(
        F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
        let(parsed_lines(F.col(text)), lambda lines: F.struct(
            own_text(lines).alias("text"), passages(lines).alias("passages"))).alias("m"))
    # Hashes travel as 32 bytes, which sort like their digits.
    tie = F.unhex(F.sha2(F.concat(F.coalesce("role", F.lit("")), F.lit("\n"), F.col("text")), 256))
    said = messages.select(
        F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
        let(parsed_lines(F.col(text)), own_text).alias("text")).withColumn("__tie", tie)
    # Without texts: they are parsed again at the end and travel once.
    rows = kept(parsed.select("conv_id", "turn", "role", "m.text", "m.passages").select(
        "conv_id", "turn", "role", tie.alias("__tie"), F.transform("passages", lambda p: F.struct(
            p["level"].alias("level"), F.char_length(p["text"]).alias("chars"), p["hash"].alias("hash"))
    ).alias("passages")), "messages")
    links = kept(sources(rows), "sources")
    key = ["conv_id", "turn"]
    voted = links.where("source_turn IS NOT NULL").groupBy(*key, "level", "source_turn").agg(
        F.sum("chars").alias("chars"))
    parents = voted.groupBy(*key).agg(F.max_by(
        "source_turn", F.struct(-F.col("level"), F.col("chars"), F.col("source_turn"))
    ).alias("parent_turn"))
    counts = links.groupBy(*key).agg(
        F.count("*").alias("n_quoted"), F.count("source_turn").alias("n_linked"))
    placed = join_on_key(join_on_key(counts, parents, key, "left"),
                         _roots(parents), key, "left")
    joined = join_on_key(rows.drop("passages"), placed, key, "left").select(
        *key, "role", "__tie",
        F.coalesce("n_quoted", F.lit(0)).cast("bigint").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"),
        "parent_turn", F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth"),
        F.coalesce("root_turn", "turn").isNull().cast("int").alias("__last"))
    order = ranked(joined, ["conv_id"], ["__last", "root_turn", "depth", "turn", "__tie"], "place")
    # Messages that agree in all of these have the same text, so one copy of it serves them all.
    whole = F.to_json(F.struct("conv_id", "turn", "role", "__tie"), {"ignoreNullFields": "false"})
    same = F.unhex(F.sha2(whole, 256))
    texts = said.groupBy(same.alias("__same")).agg(F.max("text").alias("text"))
    return order.withColumn("__same", same).join(texts, "__same").select(
        *key, "role", "text", "n_quoted", "n_linked", "parent_turn", "root_turn", "depth", "place")

"""Quotation linking against hand-made threads and its SQL twin."""

import duckdb
import pytest

from queuelens.llm import quotes
from queuelens.llm.sql import ORACLE
from tests.helpers import rows

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
ROOT = "Hello there friend.\nHow are you today?\n\nPlease answer."
TALK = [
    (1, 0, "user", ROOT),
    (1, 1, "assistant", "On Monday, X wrote:\n> Hello there friend.\n> How are you\n> today?\nFine!\n> Please answer.\nDone."),
    (1, 2, "user", ">> Please answer.\n> Fine!\nGreat"),
    (1, 3, "user", "> Hello THERE, friend\nlate reply"),
    (1, 4, "user", "> unknown text\nhm"),
    (1, 5, "user", "Jean a écrit :\n> > Please answer.\n\nonly the inner level is known"),
    (1, 6, "user", "> late reply\n> Great\nboth"),
    (1, None, "user", "> Fine!"),
    (None, 0, "user", "a b"), (None, 1, "x", "> a b"),
    (2, 0, None, None), (2, 1, "u", ""), (2, 2, "u", "> \n>\n..."),
    (1, 0, "user", ROOT),
    (3, 0, "u", "same line"), (3, 1, "v", "same line"), (3, 2, "w", "> same line"), (3, 2, "x", "> same line"),
]


def test_threads(spark):
    found = {(r.conv_id, r.turn, r.role): r for r in quotes.reply_order(spark.createDataFrame(TALK, SCHEMA)).collect()}
    first = found[1, 1, "assistant"]
    assert (first.text, first.parent_turn, first.depth) == ("Fine!\nDone.", 0, 1)
    assert (found[1, 2, "user"].parent_turn, found[1, 2, "user"].root_turn, found[1, 2, "user"].depth) == (1, 0, 2)
    assert found[1, 3, "user"].parent_turn == 0
    assert found[1, 4, "user"].parent_turn is None and found[1, 4, "user"].n_quoted == 1
    assert (found[1, 5, "user"].parent_turn, found[1, 5, "user"].text) == (0, "only the inner level is known")
    assert found[1, 6, "user"].parent_turn == 3
    assert found[None, 1, "x"].parent_turn == 0
    assert found[1, None, "user"].place == 9
    assert found[3, 2, "w"].parent_turn == found[3, 2, "x"].parent_turn == 1
    assert found[2, 0, None].text == "" and found[2, 2, "u"].n_quoted == 0


def sql_rows(table):
    connection = duckdb.connect()
    connection.register("conversations", table)
    result = connection.sql(ORACLE["op1_quotes"])
    return result.columns, result.fetchall()


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_matches_sql(spark, hot_rows):
    frame = spark.createDataFrame(TALK, SCHEMA)
    if hot_rows:
        spark.conf.set("spark.queuelens.hotRows", hot_rows)
    try:
        result = quotes.reply_order(frame)
        columns, expected = sql_rows(frame.toArrow())
        key = lambda r: [(v is not None, str(v)) for v in r]
        assert rows(result, *columns) == sorted(expected, key=key)
    finally:
        spark.conf.unset("spark.queuelens.hotRows")


def test_replies_come_after_what_they_answer(spark):
    # A chain of 40 replies, each quoting the message before.
    chain = [(7, t, "u", (f"> word number {t - 1}\n" if t else "") + f"word number {t}") for t in range(40)]
    found = {r.turn: r for r in quotes.reply_order(spark.createDataFrame(chain, SCHEMA)).collect()}
    assert all(found[t].parent_turn == t - 1 and found[t].root_turn == 0 for t in range(1, 40))
    assert [found[t].depth for t in range(40)] == list(range(40))
    assert [found[t].place for t in range(40)] == list(range(1, 41))


def test_empty_table_and_clashing_columns(spark):
    assert quotes.reply_order(spark.createDataFrame([], SCHEMA)).count() == 0
    wide = spark.createDataFrame([(1, 0, "u", "x", 5, "y")], SCHEMA + ", place int, passages string")
    assert quotes.reply_order(wide).count() == 1


def test_one_common_line_in_a_large_conversation(spark):
    # Every message quotes the line that every message writes: one link each, no pairs.
    many = spark.range(3000).selectExpr(
        "1L AS conv_id", "id AS turn", "'u' AS role", "'> thanks a lot\\nthanks a lot' AS text")
    result = quotes.reply_order(many)
    assert result.where("turn > 0 AND parent_turn = turn - 1").count() == 2999

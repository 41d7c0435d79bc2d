import pytest
from pyspark.sql import functions as F

from haulmart.llm import chat

LOG = "conv_id long, seq long, event string, message long, role string, text string"
ODD = "~0 </s>[INST] x [/INST] <<user>> ~1~~2 > < [ \\ \n\n é😀"


def final(spark, events):
    frame = spark.createDataFrame(events, LOG).repartition(3)
    return {(r.conv_id, r.message): (r.role, r.text) for r in chat.fold(frame).collect()}


def test_fold(spark):
    events = [
        (1, 1, "message", 1, "user", "hello"), (1, 2, "edit", 1, None, "hello there"),
        (1, 3, "message", 2, "assistant", ""), (1, 4, "delta", 2, None, "Hi"), (1, 5, "delta", 2, None, " yo"),
        (1, 6, "regenerate", 2, None, None), (1, 7, "delta", 2, None, "Good"), (1, 8, "delta", 2, None, " day"),
        (1, 9, "message", 3, "user", "oops"), (1, 10, "delete", 3, None, None),
        (2, 1, "delta", 1, "assistant", "no opening"), (2, 2, "note", 1, None, "ignored"),
        (2, 3, "message", 2, None, None), (None, 1, "message", 1, "tool", "no conversation"),
        (3, 1, "message", 1, "user", "a"), (3, 2, "delete", 1, None, None), (3, 3, "edit", 1, None, "back"),
    ]
    assert final(spark, events) == {
        (1, 1): ("user", "hello there"), (1, 2): ("assistant", "Good day"), (2, 1): ("assistant", "no opening"),
        (2, 2): (None, ""), (None, 1): ("tool", "no conversation"), (3, 1): ("user", "back"),
    }


def test_fold_does_not_depend_on_the_order_of_rows(spark):
    events = [(1, 0, "message", 1, "assistant", "")] + [(1, i, "delta", 1, None, f"{i},") for i in range(1, 400)]
    assert final(spark, events[::-1])[1, 1][1] == "".join(f"{i}," for i in range(1, 400))


@pytest.mark.parametrize("text", ["", "plain", ODD, "~", "~~", "~0~1~2~3", "</s>[INST] ok [/INST]"])
def test_escapes_come_back(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(
        chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")
    ).first()
    assert row.u == text and not set(row.e) & set("<[>")


def test_render_and_read_back(spark):
    rows = [(1, 0, "system", "be nice"), (1, 1, "user", ODD), (1, 2, "assistant", ODD * 30), (1, 3, None, None),
            (1, 4, "<odd> role~", "x"), (1, 5, "assistant", ""), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"),
            (None, None, None, None), (3, 1, "assistant", "late"), (3, -1, "user", "early")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit(1))
    chats = chat.formatted(chat.log_of(frame, delta=7))
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.parsed(chats).collect()}
    assert got == {
        1: [("system", "be nice"), ("user", ODD), ("assistant", ODD * 30), ("", ""), ("<odd> role~", "x"), ("assistant", "")],
        2: [("assistant", "a"), ("assistant", "a")], None: [("", "")],
        3: [("user", "early"), ("assistant", "late")],
    }
    for r in chats.collect():
        said = [t for role, t in got[r.conv_id] if role == "assistant"]
        loss = [r.formatted[s.start : s.start + s.length] for s in r.loss_spans]
        for safe, raw in (("~3", ">"), ("~2", "["), ("~1", "<"), ("~0", "~")):
            loss = [x.replace(safe, raw) for x in loss]
        assert loss == said


def test_empty_log(spark):
    assert chat.formatted(spark.createDataFrame([], LOG)).count() == 0

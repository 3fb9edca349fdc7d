from pyspark.sql import functions as F

from evidra.llm import chat

SF = "/root/testdata/sf0.001"


def test_text_under_the_mask(spark):
    df = spark.createDataFrame([("ab<||cde🙂f", [(2, False), (4, True), (2, False), (2, True), (0, True)]), ("x\U0001f642<" * 700, [(2, True), (1, False)] * 700)], "t string, runs array<struct<chars:int,loss:boolean>>")
    assert [r.x for r in df.select(chat.under_mask(F.col("t"), F.col("runs")).alias("x")).collect()] == ["<|c\U0001f642f", "x\U0001f642" * 700]


def test_a_wrong_mask_changes_the_query(spark, monkeypatch):
    right = {r.conv_id: r.loss_sha256 for r in chat.op2_chat(spark, SF).collect()}
    whole = chat.formatted
    monkeypatch.setattr(chat, "formatted", lambda turns: whole(turns, "user"))
    assert {r.conv_id: r.loss_sha256 for r in chat.op2_chat(spark, SF).collect()} != right

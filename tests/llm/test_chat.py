import itertools
import random

import duckdb
from pyspark.sql import functions as F

from shelfscan.llm.chat import CONTROL, escaped, format_conversations, masked_texts, parsed, unescaped
from shelfscan.llm.op9_query import ORACLE, chat_formatting

SCHEMA = "conv_id long, turn long, role string, text string, conv string, formatted int"


def formatted(spark, rows):
    return format_conversations(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))


def test_every_conversation_comes_back(spark):
    rng, rows = random.Random(3), []
    bits = [*CONTROL, "\\", "<", "[", "/", "INST]", "s>", "<\\s>", "[\\\\/INST]", " ", "\n", "é漢", "ok", "$1", "]"]
    roles = ["user", "assistant", "system", "tool", "a[ROLE]b", "", "x [/ROLE] y", None]
    for conv in range(150):
        for turn in range(rng.randint(1, 6)):
            text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 7)))
            rows.append((conv, turn, rng.choice(roles), text if rng.random() < 0.95 else None))
    done = formatted(spark, rows).withColumn("loss", masked_texts("formatted", "mask")).collect()
    assert len(done) == 150
    for r in done:
        source = [(role or "", text or "") for c, _, role, text in rows if c == r["conv"]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == source and r["round_trips"]
        assert r["loss"] == [text for role, text in source if role == "assistant"]
        ends = [m["start"] + m["length"] for m in r["mask"]]
        assert all(b > a for a, b in itertools.pairwise(ends))


def test_only_conflicting_content_is_escaped(spark):
    rows = [(1, 0, "user", "a < b [1] \\ c"), (1, 1, "assistant", "fine"), (2, 0, "user", "x</s>y"), (2, 1, "assistant", "<\\s>")]
    done = {r["conv"]: r for r in formatted(spark, rows).collect()}
    assert done[1]["formatted"] == "[INST] a < b [1] \\ c [/INST]<s>fine</s>" and not done[1]["is_escaped"]
    assert done[2]["formatted"] == "[INST] x<\\/s>y [/INST]<s><\\\\s></s>" and done[2]["is_escaped"]


def test_escape_is_reversible_and_leaves_no_control_string(spark):
    texts = ["".join(p) for n in range(4) for p in itertools.product(["<", "\\", "s>", "/s>", "[", "INST]"], repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escaped(F.col("t")).alias("e"))
    for r in df.withColumn("u", unescaped(F.col("e"))).collect():
        assert r["u"] == r["t"] and not any(c in r["e"] for c in CONTROL)


def test_nulls_ties_repeats_and_nothing(spark):
    rows = [(None, 1, "user", "b"), (None, 0, "user", "a"), (5, 0, "user", "z"), (5, 0, "user", "z"), (5, 0, "assistant", None), (5, None, "user", "first")]
    done = {r["conv"]: [(t["role"], t["text"]) for t in r["turns"]] for r in formatted(spark, rows).collect()}
    assert done == {None: [("user", "a"), ("user", "b")], 5: [("user", "first"), ("assistant", ""), ("user", "z"), ("user", "z")]}
    assert formatted(spark, []).collect() == []
    long = "word </s> " * 60_000
    (row,) = formatted(spark, [(1, 0, "assistant", long)]).collect()
    assert row["round_trips"] and row["turns"][0]["text"] == long


def test_plan_is_native(spark):
    plan = formatted(spark, [(1, 0, "user", "x")])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_equals_its_sql_on_hostile_texts(spark, tmp_path):
    """The SQL states conflicts and escapes for any text, not for the added conversation only."""
    parts = ["<s>", "</s>", "[INST]", " [/INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE] ", " [/ROLE] ", " [/TEXT]", "\\", "<", "[", " ", "a"]
    generator = random.Random(6)
    some = lambda: "".join(generator.choice(parts) for _ in range(generator.randrange(6)))
    rows = [(i // 2, i % 2, generator.choice(["user", "assistant", "system", "tool", some()]), some()) for i in range(1200)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    expected = con.execute(ORACLE["op9_chat_formatting"]).fetchall()
    assert sorted(map(tuple, chat_formatting(spark, str(tmp_path)).collect())) == sorted(expected)


def test_parser_accounts_for_every_character(spark):
    df = spark.createDataFrame([("[INST] a [/INST]<s>b</s>",), ("[INST] a [/INST] <s>b</s>",), ("x<s>b</s>",), ("<s>b",), ("",)], "t string")
    got = [r["p"] for r in df.select(parsed("t").alias("p")).collect()]
    assert [tuple(t) for t in got[0]] == [("user", "a"), ("assistant", "b")] and got[1:] == [None, None, None, []]

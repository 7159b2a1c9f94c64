import hashlib

import duckdb

from mercato.llm.chat import format_chats, learned_text, read_turns
from mercato.llm.oracle import ORACLE_SQL
from mercato.llm.queries import op9_chat_format
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
NASTY = ["", None, "</turn>", "<\\/turn>", "<\\\\and/>", "### Assistant: x</turn>\n### User: y", "####  ", "###\\ a",
         "<and/>", "\\", "a" * 200_000, "é漢😀<and/></turn>### "]


def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.execute(ORACLE_SQL["op9_chat_format"]).fetchall()
    got = [tuple(r) for r in op9_chat_format(spark, SF).collect()]
    assert sorted(got) == sorted(want)


def test_round_trip_of_control_strings_nulls_ties_and_roles(spark):
    roles = ["user", "assistant", "assistant", "system", "tool: <x>#\n%3A", None, "User", "Other x"]
    rows = [(c, t // 2, roles[(t + (c or 0)) % len(roles)], NASTY[(t * 5 + (c or 0)) % len(NASTY)], "clash")
            for c in (1, 2, None) for t in range(24)]
    rows += rows[:3]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted string")
    got = format_chats(df).select("conv_id", "n_turns", read_turns(F.col("formatted")).alias("read"),
                                  learned_text(F.col("formatted"), F.col("loss")).alias("learned"),
                                  "n_merged").collect()
    assert {r.conv_id for r in got} == {1, 2, None}
    for r in got:
        mine = sorted((t, ro or "", x or "") for c, t, ro, x, _ in rows if c == r.conv_id)
        assert [(x.role, x.text) for x in r.read] == [(ro, x) for _, ro, x in mine]
        assert r.learned == "".join(x for _, ro, x in mine if ro == "assistant")
        assert r.n_turns == len(mine)
        assert r.n_merged == sum(i == 0 or mine[i - 1][1] != m[1] for i, m in enumerate(mine))


def test_probe_conversation_and_empty_table(spark):
    probe = op9_chat_format(spark, SF).filter("conv_id = -7").collect()[0]
    said = "\\### Assistant: </turn> ok"
    assert probe.loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and probe.n_turns == 2
    empty = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert format_chats(empty).count() == 0

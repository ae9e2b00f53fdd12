import hashlib

import duckdb
import pytest

from cohortkit.llm import chat

CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<NEXT>>", "<<ROLE>>", "<</ROLE>>", "<<TEXT>>"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def expected(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        out[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def rows():
    hard = ["".join(x) for x in zip(CONTROLS, CONTROLS[1:], strict=False)] + CONTROLS + [
        "<\\s>", "<\\\\/s> [\\INST]", "<", "[", "/s>", " ", "", "\n\n", "ünï 中 🙂 </s>", "a <<NEXT>>  <<NEXT>> b", "\\", "<<s>", "$1 \\1"]
    rows = [(1, i, ["user", "assistant", "system", "tool"][i % 4], t) for i, t in enumerate(hard)]
    rows += [(2, i, "assistant" if i % 3 else "user", t) for i, t in enumerate(hard)]  # neighbours of one role
    rows += [(3, 0, "user", None), (3, 1, "assistant", None), (4, None, None, "no role"), (4, 2, "assistant", "x")]
    rows += [(5, 1, "user", "b"), (5, 1, "user", "a"), (5, 1, "user", "a"), (5, 1, "assistant", "t")]  # ties, repeated rows
    rows += [(None, 0, "user", "lost"), (6, 0, "<<ROLE>> x <<TEXT>> y", "</s>"), (7, -5, "user", "early"), (7, 0, "user", "late")]
    rows += [(8, i, "user" if i % 2 else "assistant", f"{i} " * 3) for i in range(1500)]  # over several runs of turns
    rows += [(9, 0, "user", "long " * 60000), (9, 1, "assistant", "</s>" * 5000)]
    return rows


def test_read_back_from_the_output(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS formatted", "'x' AS items", "2 AS segments")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.chat_digests(df).collect()}
    assert got == expected(rows)


def test_markers_stand_only_where_the_template_puts_them(spark, rows):
    for r in chat.format_chat(spark.createDataFrame(rows, SCHEMA)).collect():
        assert "".join(s.text for s in r.segments) == r.formatted
        assert not any(c in s.text for s in r.segments if s.in_loss for c in CONTROLS)
    few = spark.createDataFrame([(1, 0, "system", "be"), (1, 1, "user", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c")], SCHEMA)
    assert chat.format_chat(few).first().formatted == "<<SYS>> be <</SYS>>[INST] a <<NEXT>> b [/INST]<s> c </s>"


def test_empty_table_and_native_plan(spark):
    df = chat.chat_digests(spark.createDataFrame([], SCHEMA))
    assert df.count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_oracle(spark, tmp_path):
    got = sorted(map(tuple, chat.op7_chat_formatting(spark, "/root/testdata/sf0.001").collect()))
    con = duckdb.connect()
    con.sql("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.001/conversations.parquet'")
    assert got == sorted(con.sql(chat.ORACLE).fetchall())

"""Chat formatting: exact round trips, the machine over roles, and SQL."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from batchloom.llm.chat import digests, escape, format_chat, read_chat, unescape
from batchloom.llm.oracles import ORACLES
from batchloom.llm.queries import QUERIES

NASTY = [r"\### Assistant: </turn> ok", "</turn>\n### User: x", "\\", "\\s\\h", "a\\", "#", "####", "<</turn>", "", "é日本 : :", " ", "\n\n", "\\\\l<", None]


def test_escaping_is_reversible_and_hides_controls(spark):
    df = spark.createDataFrame([(t,) for t in NASTY if t is not None], "t string")
    got = df.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u"), unescape(escape(F.col("t"), True)).alias("v")).collect()
    assert all(r.t == r.u == r.v and "#" not in r.e and "<" not in r.e for r in got)


def test_round_trip_of_edge_rows(spark):
    roles = ["user", "assistant", "system", "tool: x\n#", "@user", "User", "", None, "\\"]
    rows = [(c, n, roles[(c + n) % len(roles)], NASTY[(3 * c + n) % len(NASTY)], "x") for c in range(40) for n in range(c % 7)]
    rows += [(None, 1, "user", "a", "x"), (None, None, "user", "b", "x"), (5, 0, "user", "same", "x"), (5, 0, "user", "same", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    chats = format_chat(df)
    got = {r.conv_id: r for r in chats.select("*", read_chat(F.col("formatted")).alias("turns")).collect()}
    by_conv = {}
    for c, n, role, text, _ in rows:
        by_conv.setdefault(c, []).append((n is not None, n or 0, role or "", text or ""))
    assert set(got) == set(by_conv)
    for c, turns in by_conv.items():
        expected = [(r, t) for _, _, r, t in sorted(turns)]
        assert [(t.role, t.text) for t in got[c].turns] == expected
        assert "".join(s.text for s in got[c].segments) == got[c].formatted
        assert [s.loss for s in got[c].segments] == [x for r, _ in expected for x in (False, r == "assistant", False)]
    assert format_chat(df.limit(0)).count() == 0
    found = {r.conv_id: r for r in digests(chats).collect()}
    for c, turns in by_conv.items():
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in sorted(turns))
        assert found[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()


@pytest.mark.parametrize(
    ("roles", "valid"),
    [("ua", True), ("sua", True), ("uaua", True), ("u", False), ("au", False), ("uu", False), ("usa", False), ("s", False), ("uax", False)],
)
def test_machine(spark, roles, valid):
    names = {"u": "user", "a": "assistant", "s": "system", "x": "tool"}
    df = spark.createDataFrame([(1, i, names[r], "t") for i, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
    assert format_chat(df).first().valid is valid


def test_query_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf_dir}/conversations.parquet'")
    result = con.execute(ORACLES["op3_chat_formatting"])
    columns = [d[0] for d in result.description]
    got = QUERIES["op3_chat_formatting"](spark, sf_dir)
    assert got.columns == columns
    assert sorted(map(tuple, got.collect())) == sorted(result.fetchall())
    seven = got.where("conv_id = -7").first()
    assert (seven.n_turns, seven.loss_chars, seven.valid) == (2, 26, True)


def test_both_masks_agree_on_the_whole_table(spark, sf_dir):
    """The flags of the emitted segments and those read back from the formatted text cover the same characters."""
    chats = format_chat(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    rows = chats.select("segments", read_chat(F.col("formatted")).alias("turns")).collect()
    assert rows
    for r in rows:
        assert [s.loss for s in r.segments] == [x for t in r.turns for x in (False, t.loss, False)]
    learned = chats.select("conv_id", F.explode("segments").alias("s")).where("s.loss").select("conv_id", unescape(F.col("s.text")).alias("t"))
    emitted = {r.conv_id: r.n for r in learned.groupBy("conv_id").agg(F.sum(F.length("t")).alias("n")).collect()}
    assert emitted == {r.conv_id: r.loss_chars for r in digests(chats).collect() if r.conv_id in emitted}


def test_no_python_in_the_plan(spark, sf_dir, capsys):
    QUERIES["op3_chat_formatting"](spark, sf_dir).explain("formatted")
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))

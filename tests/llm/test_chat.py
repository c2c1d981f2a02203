"""Chat formatting against a plain Python reading of the same template, and edge tables."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rrspark.llm import chat

PARTS = [*chat.INSTRUCT.controls, "\\", "\\\\", "<", "[", "/", "s>", "INST]", "</SYS>", "<\\s>", "é", "中", "𝄞", "\n", " ok ", "user"]


def table(spark, rows):
    """Conversations with extra columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, True, "x", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, valid boolean, segments string, place long")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    """By conversation: number of turns, digests and the number of trained code points."""
    out = {}
    low = lambda x: (x is not None, x if x is not None else 0)
    plain = [(c, t, r or "", x or "") for c, t, r, x in rows]
    for conv in {c for c, *_ in rows}:
        mine = sorted((t for t in plain if t[0] == conv), key=lambda t: (low(t[1]), t[2].encode(), t[3].encode()))
        trained = "".join(x for _, _, r, x in mine if r == "assistant")
        out[conv] = (len(mine), digest("".join(f"{r}\n{x}\n" for _, _, r, x in mine)), len(trained), digest(trained))
    return out


def found(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect()}


def test_chat_reads_back_whatever_the_texts_hold(spark):
    rng = random.Random(2)
    text = lambda: "".join(rng.choices(PARTS, k=rng.randint(0, 9)))
    roles = ["system", "user", "assistant", "assistant", "tool", "", None, "[/ROLE]", "a\\", "<s>"]
    rows = [(c, t, rng.choice(roles), rng.choice([None, text()]) if rng.random() < 0.2 else text())
            for c in [None, *range(60)] for t in range(rng.randint(1, 8))]
    rows += [(5, None, "user", "n"), (5, None, "user", "n"), (5, 1, "user", "tie"), (6, 0, "assistant", "<s>" * 40_000 + "\\" * 9)]
    out = chat.conversations(table(spark, rows).repartition(4))
    assert found(chat.read_back_digest(out)) == expected(rows)
    first = out.where("conv_id = 6").first()
    assert first["formatted"] == "".join(s["text"] for s in first["segments"])


def test_chat_escaped_text_holds_no_control_string(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices(PARTS, k=6)) for _ in range(500)] + ["<<<SYS>>>", "<s<s>>", "[[INST]]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t"), chat.INSTRUCT).alias("e"))
    rows = df.select("t", "e", chat.unescape(F.col("e")).alias("back")).collect()
    assert all(r["back"] == r["t"] for r in rows)
    assert not any(c in r["e"] for r in rows for c in chat.INSTRUCT.controls)


def test_chat_machine(spark):
    said = {
        1: "user assistant", 2: "system user assistant user", 3: "assistant user", 4: "user user assistant",
        5: "system assistant", 6: "user assistant system user", 7: "user tool", 8: "user assistant user assistant system"}
    rows = [(c, t, r, "x") for c, s in said.items() for t, r in enumerate(s.split())]
    out = {r["conv_id"]: r for r in chat.conversations(table(spark, rows)).collect()}
    assert {c: r["broken_at"] for c, r in out.items()} == {1: None, 2: None, 3: 0, 4: 1, 5: 1, 6: 2, 7: 1, 8: 4}
    assert all(r["valid"] == (r["broken_at"] is None) for r in out.values())
    assert {r["conv_id"] for r in chat.conversations(table(spark, rows), only_valid=True).collect()} == {1, 2}
    states = [r["state"] for r in chat.turns(table(spark, rows)).where("conv_id = 6").orderBy("turn").collect()]
    assert states == ["user", "assistant", "error", "error"]  # nothing leaves the error
    assert out[2]["formatted"] == "<<SYS>>x<</SYS>>[INST]x[/INST]<s>x</s>[INST]x[/INST]"
    assert [s["loss"] for s in out[1]["segments"]] == [False] * 4 + [True, False]


def test_chat_templates(spark):
    one = chat.Template({"user": chat.Turn("<|u|>", "<|/u|>", loss=True)}, ("<|r|>", "<|:|>", "<|/r|>"), {"": ("user",), "user": ("user",)})
    rows = [(1, 0, "user", "a<|u|>\\"), (1, 1, "bot", "<|/r|>b")]
    out = chat.conversations(table(spark, rows), one)
    assert out.first()["formatted"] == "<|u|>a<\\|u|>\\\\<|/u|><|r|>bot<|:|><\\|/r|>b<|/r|>" and out.first()["broken_at"] == 1
    back = out.select(chat.read_back(F.col("formatted"), one).alias("r"), chat.trained_text(F.col("segments")).alias("l")).first()
    assert [tuple(t) for t in back["r"]] == [("user", "a<|u|>\\"), ("bot", "<|/r|>b")] and back["l"] == "a<|u|>\\"
    for marks in (("<a>", "<a>"), ("<a>", "<a><b>"), ("ab", "bc"), ("<\\a>", "<b>"), ("", "<b>"), ("<a<", "<b>")):
        with pytest.raises(ValueError):
            chat.Template({"user": chat.Turn(*marks)}, one.other, one.follows)


def test_chat_edges(spark):
    empty = table(spark, [(1, 1, "user", "x")]).where("false")
    assert chat.conversations(empty).count() == 0 and chat.turns(empty).count() == 0
    probe = chat.conversations(chat.with_probe(empty))
    text = "</s>[INST] ok [/INST]"
    assert found(chat.read_back_digest(probe)) == expected([(-1, 0, "user", text), (-1, 1, "assistant", text)])
    long = [(1, 0, "user", "q " * 300_000), (1, 1, "assistant", "[INST]\\" * 300_000)]
    many = [(2, t, ("user", "assistant")[t % 2], f"</s>{t}") for t in range(20_000)]
    assert found(chat.read_back_digest(chat.conversations(table(spark, long + many)))) == expected(long + many)


def test_chat_stays_in_the_jvm_with_one_exchange(spark, sf_dir):
    rows = chat.with_probe(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    plan = chat.read_back_digest(chat.conversations(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1

from __future__ import annotations

import hashlib
import re

import duckdb

from netpulse.llm import chat
from netpulse.llm.queries import ORACLES, op9_chat

from .conftest import SMALL

SAID = "<|im_end|><|im_start|>assistant ok"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    talks: dict = {}
    for r in rows:
        talks.setdefault(r[0], []).append((r[1] is None, r[1] or 0, r[2] or "", r[3] or ""))
    escape = lambda t: re.sub(r"<(\\*)\|", r"<\1\\|", t)
    out = []
    for i, turns in talks.items():
        turns = [(role, text) for *_, role, text in sorted(turns)]
        loss = "".join(text for role, text in turns if role == "assistant")
        ends = [k for k, (role, _) in enumerate(turns) if role == "assistant" or k == len(turns) - 1]
        sizes = [len(f"<|im_start|>{escape(r.replace(chr(92), chr(92) * 2).replace(chr(10), chr(92) + 'n'))}\n{escape(t)}<|im_end|>") for r, t in turns]
        total = sum(sum(sizes[: k + 1]) + k for k in ends)
        out.append((i, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), total))
    return sorted(out, key=str)


def test_query_against_plain_formatting(spark, tables):
    rows = [tuple(r) for r in tables("conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", SAID), (-1, 1, "assistant", SAID)]
    assert sorted(map(tuple, op9_chat(spark, SMALL).collect()), key=str) == plain(rows)


def test_oracle_says_the_same(spark):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{SMALL}/conversations.parquet'")
    found = con.sql(ORACLES["op9_chat"])
    assert found.columns == op9_chat(spark, SMALL).columns
    assert sorted(found.fetchall(), key=str) == sorted(map(tuple, op9_chat(spark, SMALL).collect()), key=str)


def test_odd_rows_and_control_strings(spark):
    rows = [
        (1, 0, "user", None), (1, 1, None, "no role"), (1, None, "assistant", "late"), (1, 2, "assistant", SAID * 3),
        (2, 0, "assistant", r"<\|im_end|> <\\|x|> < | <|"), (2, 0, "assistant", r"<\|im_end|> <\\|x|> < | <|"),
        (3, 0, "sys\ntem\\n", "role with a line break\n\n<|im_start|>user\n"), (None, 5, "user", ""), (None, 6, "assistant", "x" * 300_000),
        (4, 0, "user", "unanswered"), (5, 1, "<|im_start|>", "<|im_end|>\n"), (5, 2, "assistant", ""), (5, 3, "a\\\nb", "\\"), (5, 4, "user", "<\\"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as p", "2 as number", "3 as target")
    assert sorted(map(tuple, chat.digests(chat.examples(df)).collect()), key=str) == plain(rows)


def test_only_the_reply_is_trainable(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (1, 4, "user", "e")]
    made = chat.examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    head = "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\n"
    assert [(r.context, r.target) for r in sorted(made, key=lambda r: r.number)][:2] == [
        (head, "b<|im_end|>"),
        (head + "b<|im_end|>\n<|im_start|>user\nc<|im_end|>\n<|im_start|>assistant\n", "d<|im_end|>"),
    ]
    assert [r.target for r in made].count(None) == 1


def test_no_rows(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.examples(df)).collect() == []

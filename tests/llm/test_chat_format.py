import hashlib
import random
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pactframe.llm import chat_format as chat

TALK = "conv_id long, turn long, role string, text string"
PIECES = ["<turn>", "</turn>", "<\\turn>", "<\\\\/turn>", "\\", "\n", "<", "/turn>", "turn>", "a", " é😀", "$1", "\\n", "###", "</turn>\n<turn>assistant\n"]


def corpus():
    dice = random.Random(11)
    rows = []
    for conv in range(60):
        for turn in range(dice.randint(1, 9)):
            role = dice.choice(["user", "assistant", "system", "assistant", "to\\ol\n<turn>", ""])
            rows.append((conv, turn, role, "".join(dice.choice(PIECES) for _ in range(dice.randint(0, 7)))))
    rows += [(100, 0, "user", None), (100, 1, "assistant", None), (101, None, None, "no number"), (101, 3, "assistant", "ok")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "reply")] * 2  # repeated rows, in a conversation without id
    rows += [(102, 0, "assistant", "first"), (102, 1, "user", "last"), (103, 0, "user", "alone")]
    dice.shuffle(rows)
    return rows


def frame(spark, rows, extra=False):
    df = spark.createDataFrame(rows, TALK)
    if extra:
        for name in ("page", "at", "n", "chars", "turns", "whole", "long_id", "formatted"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def conversations(rows):
    """Turns of each conversation in order, nulls first."""
    low = lambda x: (x is not None, x if not isinstance(x, str) else x.encode())
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (low(r[1]), (r[2] or "").encode(), (r[3] or "").encode())):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def esc(text):
    return re.sub(r"<(\\*)(/?turn>)", r"<\\\1\2", text)


def write(role, text):
    return "<turn>" + esc(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n" + esc(text) + "</turn>\n"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def want_digest(turns):
    replies = [t for r, t in turns if r == "assistant"]
    ends = [k for k, (r, _) in enumerate(turns) if r == "assistant" or k == len(turns) - 1]
    chars = sum(len(write(*t)) for k in ends for t in turns[: k + 1])
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), sum(map(len, replies)), sha("".join(replies)), chars


def test_examples_against_a_plain_loop(spark):
    rows = corpus()
    got = chat.prefix_targets(frame(spark, rows, extra=True)).collect()
    want = set()
    for conv, turns in conversations(rows).items():
        for k, (role, text) in enumerate(turns):
            if role == "assistant" or k == len(turns) - 1:
                full = "".join(write(*t) for t in turns[: k + 1])
                chars = len(esc(text)) if role == "assistant" else None
                want.add((conv, 0, k, k == len(turns) - 1, full, None if chars is None else len(full) - 8 - chars, chars))
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_digests_read_back_what_was_there(spark):
    rows = corpus()
    got = {r.conv_id: tuple(r)[1:] for r in chat.digests(frame(spark, rows, extra=True)).collect()}
    assert got == {conv: want_digest(turns) for conv, turns in conversations(rows).items()}


@pytest.mark.parametrize(("max_turns", "max_chars"), [(3, 1000), (100, 9), (1, 1)])
def test_pages_of_long_conversations_lose_nothing(spark, max_turns, max_chars):
    rows = corpus() + [(7000, k, "user" if k % 2 else "assistant", "x" * (k % 13)) for k in range(300)]
    talk = frame(spark, rows)
    want = conversations(rows)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(talk, max_turns, max_chars).collect()}
    assert got == {conv: want_digest(turns)[:4] for conv, turns in want.items()}
    examples = chat.prefix_targets(talk, max_turns, max_chars).collect()
    assert sum(r.loss_chars is not None for r in examples) == sum(r == "assistant" for turns in want.values() for r, _ in turns)
    pages = {(r.conv_id, r.page): r.formatted for r in examples if r.whole}
    for conv, turns in want.items():
        own = sorted(p for c, p in pages if c == conv)
        assert "".join(pages[conv, p] for p in own) == "".join(write(*t) for t in turns)
        assert all(pages[conv, p].count("</turn>\n") <= max_turns for p in own)


@pytest.mark.parametrize(("max_turns", "max_chars"), [(3, 1000), (100, 9), (1, 1)])
def test_examples_of_long_conversations_hold_all_turns_before_them(spark, max_turns, max_chars):
    rows = corpus() + [(7000, k, "user" if k % 2 else "assistant", "x" * (k % 13)) for k in range(40)]
    talk, want = frame(spark, rows), conversations(rows)
    got = [tuple(r) for part in chat.whole_examples(talk, max_turns, max_chars) for r in part.collect()]
    made = {}
    for conv, turns in want.items():
        for k, (role, text) in enumerate(turns):
            if role == "assistant" or k == len(turns) - 1:
                chars = len(esc(text)) if role == "assistant" else None
                made[conv, k] = (k == len(turns) - 1, "".join(write(*t) for t in turns[: k + 1]), chars)
    assert len(got) == len(made) and {(c, at): (whole, text, chars) for c, _, at, whole, text, _, chars in got} == made
    assert all(text[start : start + chars] + "</turn>\n" == text[start:] for *_, text, start, chars in got if chars is not None)
    assert {r.conv_id: tuple(r)[1:] for r in chat.digests(talk, max_turns, max_chars).collect()} == {c: want_digest(t) for c, t in want.items()}


def test_a_conversation_beyond_one_task_is_expanded_whole(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", "x" * (k % 13)) for k in range(chat.MAX_TURNS + 44)]
    turns = conversations(rows)[1]
    assert [tuple(r)[1:] for r in chat.digests(frame(spark, rows)).collect()] == [want_digest(turns)]
    last = chat.prefix_targets(frame(spark, rows)).filter("whole").collect()
    assert [(r.at, r.formatted) for r in last] == [(len(turns) - 1, "".join(write(*t) for t in turns))]


def test_reading_inverts_writing(spark):
    rows = [(k, 0, "".join(a), "".join(b)) for k, (a, b) in enumerate((PIECES[i : i + 3], PIECES[j : j + 4]) for i in range(13) for j in range(12))]
    made = chat.prefix_targets(frame(spark, rows)).select("conv_id", F.inline(chat.read_turns(F.col("formatted"))))
    assert {tuple(r) for r in made.collect()} == {(c, r, t) for c, _, r, t in rows}


def test_against_sql_with_the_probe(spark):
    rows = [r for r in corpus() if r[0] is not None]
    with duckdb.connect() as db:
        db.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"turn": "Int64"}))
        want = {r[0]: r for r in db.execute(chat.CHAT_SQL).fetchall()}
    got = {r.conv_id: tuple(r) for r in chat.digests(chat.with_probe(frame(spark, rows))).collect()}
    assert got == want and got[-7][1] == 2


def test_only_jvm_functions_and_one_shuffle_of_texts(spark, sf):
    talk = spark.read.parquet(f"{sf}/conversations.parquet")
    plan = chat.digests(chat.with_probe(talk))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_empty(spark):
    assert chat.prefix_targets(frame(spark, [])).collect() == []
    assert chat.digests(frame(spark, [])).collect() == []

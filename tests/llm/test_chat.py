import hashlib
import random

import pytest

from tallyspan.llm import chat

PARTS = ["\\", "###", "####", "</turn>", " </turn>\n", "### user: ", ":", "\n", "a", "é", "", " ok", "\\###", "\\\\</turn>"]


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        said = "".join(t for _, r, t in turns if r == "assistant")
        formatted = [chat.head(r) + chat.escape(t) + chat.TAIL for _, r, t in turns]
        ends = [k for k, (_, r, _) in enumerate(turns) if r == "assistant"]
        if not ends or ends[-1] != len(turns) - 1:
            ends.append(len(turns) - 1)
        out[conv] = (
            len(turns),
            hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(),
            len(said),
            hashlib.sha256(said.encode()).hexdigest(),
            sum(len("".join(formatted[: k + 1])) for k in ends),
            len(ends),
        )
    return out


def rows_of(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 9)))
        role = rng.choice(["user", "assistant", "system", "we:ird\\", None])
        rows.append((rng.choice([None, *range(12), 2**60 + 1]), rng.choice([None, *range(50)]), role, rng.choice([text, text, None])))
    return rows + rows[:5]


SCHEMA = "conv_id bigint, turn int, role string, text string"


@pytest.mark.parametrize("block", [chat.BLOCK_CHARS, 60, 1])
def test_against_brute_force(spark, block):
    rows = rows_of()
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS example", "1 AS seq", "2 AS blocks")
    found = chat.read_back(chat.expand_examples(table, block_chars=block)).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == brute(rows)


def test_examples_hold_context_and_one_reply(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a ###"), (1, 2, "user", "r"), (1, 3, "assistant", "b")]
    first, second = chat.expand_examples(spark.createDataFrame(rows, SCHEMA)).orderBy("example").collect()
    assert first["text"] == "### user: q </turn>\n### assistant: a \\### </turn>\n"
    assert chat.unescape(first["text"][first["loss_start"] : first["loss_end"]]) == "a ###"
    assert second["text"].startswith(first["text"])
    assert second["text"][second["loss_start"] : second["loss_end"]] == "b"


def test_long_conversation_grows_in_proportion(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", "word " * 20) for i in range(600)]
    found = chat.expand_examples(spark.createDataFrame(rows, SCHEMA), block_chars=1000)
    assert found.selectExpr("sum(length(text)) n").first()["n"] < 12 * sum(len(r[3]) for r in rows)
    assert {r[0]: tuple(r)[1:] for r in chat.read_back(found).collect()} == brute(rows)


def test_empty_table(spark):
    assert chat.read_back(chat.expand_examples(spark.createDataFrame([], SCHEMA))).collect() == []

"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are its
context, and only its reply is trainable. A turn is written

    ### role: text </turn>

with a line end after it. Inside role and text a backslash goes before each
backslash, ``###`` and ``</turn>`` (and ``:`` in roles), so that no text can
end a turn or begin one, and reading takes one backslash away again.

Contexts repeat, so the examples of one conversation would grow with the square
of its length. Whenever the context since the last block reaches
``BLOCK_CHARS``, it is written once as a block, and later examples hold only
what follows the blocks and say how many blocks stand before them. An ordinary
conversation has no blocks, and its examples hold everything.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_CHARS = 32_768
EXAMPLES = (
    "conv_id BIGINT, seq BIGINT, example BIGINT, blocks BIGINT, context_chars BIGINT, "
    "text STRING, loss_start BIGINT, loss_end BIGINT"
)
_CONTROL = re.compile(r"(\\|###|</turn>)")
_ROLE_CONTROL = re.compile(r"(\\|###|</turn>|:)")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|[^\\])*?) </turn>\n", re.S)


def escape(text: str) -> str:
    """Put a backslash before every control string and every backslash."""
    return _CONTROL.sub(r"\\\1", text)


def unescape(text: str) -> str:
    """Undo :func:`escape`."""
    return _ESCAPED.sub(r"\1", text)


def head(role: str) -> str:
    """What stands before a turn's text."""
    return f"### {_ROLE_CONTROL.sub(r'\\\1', role)}: "


TAIL = " </turn>\n"


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    turns, at = [], 0
    while at < len(text):
        found = _TURN.match(text, at)
        if found is None:
            raise ValueError("not a sequence of formatted turns")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def _key(conv: str | None) -> int | None:
    return None if conv is None else int(conv)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    """Rows as a frame whose integers stay exact beside nulls."""
    columns = dict(zip(names, zip(*rows, strict=True), strict=True))
    nullable = ("conv_id", "example")
    return pd.DataFrame({n: pd.array(c, "Int64") if n in nullable else list(c) for n, c in columns.items()})


def expand_examples(
    conversations: DataFrame, target_role: str = "assistant", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Blocks and examples of all conversations, in the order of ``seq`` within each.

    A block has a null ``example``. An example's whole text is that of its
    conversation's first ``blocks`` blocks and then ``text``; ``context_chars``
    counts the blocks' code points, and ``loss_start:loss_end`` in ``text`` is
    the trainable reply (escaped). Turns after the last reply, or a
    conversation without one, give a last example with an empty loss span.

    Null role or text is empty. Turns with equal numbers go by role, then text;
    repeated rows are turns of their own; null turn numbers come first. Rows
    with a null conv_id form one conversation. Other columns are left out.
    A conversation streams through one task that holds one block of it.
    """
    turns = conversations.select(
        # as text, since pandas turns integers beside nulls into floats
        F.col("conv_id").cast("bigint").cast("string").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["conv_id", "seq", "example", "blocks", "context_chars", "text", "loss_start", "loss_end"]
        rows: list[tuple] = []
        size = 0
        conv, open_, seq, example, blocks, shared, pieces, held, dangling = None, False, 0, 0, 0, 0, [], 0, False

        def close():
            if open_ and dangling:
                rows.append((conv, seq, example, blocks, shared, "".join(pieces), held, held))

        def frame():
            return _frame(rows, names)

        for batch in batches:
            for key, role, text in zip(batch["conv_id"], batch["role"], batch["text"], strict=True):
                key = _key(key)
                if not open_ or key != conv:
                    close()
                    conv, open_, seq, example, blocks, shared, pieces, held = key, True, 0, 0, 0, 0, [], 0
                if held >= block_chars:
                    rows.append((conv, seq, None, blocks, shared, "".join(pieces), 0, 0))
                    size += held
                    seq, blocks, shared, pieces, held = seq + 1, blocks + 1, shared + held, [], 0
                before, inside = head(role), escape(text)
                pieces.append(before + inside + TAIL)
                start = held + len(before)
                held += len(pieces[-1])
                dangling = role != target_role
                if not dangling:
                    rows.append((conv, seq, example, blocks, shared, "".join(pieces), start, start + len(inside)))
                    seq, example, size = seq + 1, example + 1, size + held
                if size > 1 << 24:
                    yield frame()
                    rows, size = [], 0
        close()
        if rows:
            yield frame()

    return ordered.mapInPandas(task, EXAMPLES)


DIGESTS = (
    "conv_id BIGINT, n_turns BIGINT, turns_sha256 STRING, loss_chars BIGINT, loss_sha256 STRING, "
    "formatted_chars BIGINT, n_examples BIGINT"
)


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, what its formatted examples say: turns, trainable replies and their lengths.

    ``formatted_chars`` is the length of all examples written out in full,
    ``n_examples`` their number. Each conversation streams through one task.
    """
    keyed = examples.withColumn("conv_id", F.col("conv_id").cast("string"))
    ordered = keyed.repartition("conv_id").sortWithinPartitions("conv_id", "seq")

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in DIGESTS.split(", ")]
        done: list[tuple] = []
        conv, open_ = None, False
        turns = loss = None
        n_turns = n_loss = n_chars = n_examples = 0
        last = ""

        def feed(text):
            nonlocal n_turns
            for role, said in parse(text):
                n_turns += 1
                turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))

        def close():
            if open_:
                feed(last)
                done.append((conv, n_turns, turns.hexdigest(), n_loss, loss.hexdigest(), n_chars, n_examples))

        for batch in batches:
            fields = ("conv_id", "example", "context_chars", "text", "loss_start", "loss_end")
            for key, example, shared, text, a, b in zip(*(batch[c] for c in fields), strict=True):
                key = _key(key)
                if not open_ or key != conv:
                    close()
                    conv, open_, last = key, True, ""
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                    n_turns = n_loss = n_chars = n_examples = 0
                if pd.isna(example):
                    feed(text)
                    last = ""
                    continue
                last = text
                n_examples += 1
                n_chars += int(shared) + len(text)
                said = unescape(text[int(a) : int(b)])
                n_loss += len(said)
                loss.update(said.encode("utf-8", "surrogatepass"))
            if len(done) >= 10_000:
                yield _frame(done, names)
                done = []
        close()
        if done:
            yield _frame(done, names)

    return ordered.mapInPandas(task, DIGESTS)

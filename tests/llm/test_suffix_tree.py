"""Scores of the probabilistic suffix tree against a plain version."""

import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pytest

from tallyspan.llm import suffix_tree

SPACE = re.compile(r"[\x20\x09-\x0D]+")
NAMES = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def tokens_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in SPACE.split(low) if w] + [None]


def is_held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 10 == 0


def brute(rows, depth, least, prior, gain):
    trained = [tokens_of(text) for doc, text in rows if not is_held(doc)]
    c = Counter(w for words in trained for w in words)
    total, kinds = sum(c.values()), len(c)
    base = lambda w: (c[w] + 0.1) / (total + 0.1 * (kinds + 1))
    after: dict[tuple, Counter] = {}
    for words in trained:
        for i, w in enumerate(words):
            for k in range(1, min(depth, i) + 1):
                after.setdefault(tuple(words[i - k : i]), Counter())[w] += 1
    states, tested = {()}, {()}

    def p(context, w):
        if not context:
            return base(w)
        return (after[context][w] + prior * p(context[1:], w)) / (after[context].total() + prior)

    for k in range(1, depth + 1):
        for context, nexts in after.items():
            n = nexts.total()
            if len(context) != k or n < least or context[1:] not in states or context[:-1] not in tested:
                continue
            tested.add(context)
            better = 0
            for w, m in nexts.items():
                parent = -round(-64 * math.log2(p(context[1:], w))) / 64
                better += m * (math.log2((m - 1 + prior * 2**parent) / (n - 1 + prior)) - parent)
            if better > gain * n:
                states.add(context)
    out = []
    for doc, text in rows:
        words = tokens_of(text)
        score = 0
        for i, w in enumerate(words):
            state = ()
            for k in range(1, min(depth, i) + 1):
                if tuple(words[i - k : i]) not in states:
                    break
                state = tuple(words[i - k : i])
            score += math.log10(p(state, w))
        plain = sum(math.log10(base(w)) for w in words)
        out.append((doc, is_held(doc), len(words), sum(c[w] > 0 for w in words), total, plain, score))
    return out, states, p


def rounded(rows):
    return sorted(repr((*row[:5], *(round(x, 6) + 0.0 for x in row[5:]))) for row in rows)


def prose(n, seed=3):
    rng = random.Random(seed)
    follows = {w: rng.sample("a b c d e F g".split(), 2) for w in "a b c d e f g".split()}
    rows = []
    for i in range(n):
        words, w = [], rng.choice("abcdefg")
        for _ in range(rng.randint(0, 40)):
            words.append(w if rng.random() < 0.95 else f"x{rng.randint(0, 30)}")
            w = rng.choice(follows[w]).lower() if rng.random() < 0.8 else rng.choice("abcdefg")
        rows.append((i, " ".join(words) if i % 7 else "\n".join(words).upper()))
    return rows


SMALL = [
    {},
    {"block_bytes": 60, "bucket_tokens": 100, "split": 20},
    {"block_bytes": 1000, "bucket_tokens": 50, "split": 1},
]


@pytest.mark.parametrize("more", SMALL)
def test_against_brute_force(make_docs, odd_rows, more):
    rows = prose(200) + [(i, t) for i, t in odd_rows if t is None or len(t) < 10_000 or not more]
    model = {"depth": 3, "least": 4, "prior": 5.0, "gain": 0.05}
    expected, states, _ = brute(rows, **model)
    assert {len(s) for s in states} == {0, 1, 2, 3}
    found = suffix_tree.score_texts(make_docs(rows), **model, **more).select(NAMES).collect()
    assert rounded(found) == rounded(expected)


def test_next_words_sum_to_one():
    rows = prose(120)
    _, states, p = brute(rows, 2, 4, 5.0, 0.05)
    words = {w for doc, text in rows if not is_held(doc) for w in tokens_of(text)}
    assert {len(s) for s in states} == {0, 1, 2}
    for state in states:
        assert math.isclose(sum(p(state, w) for w in [*words, "never seen"]), 1)


def test_held_out_texts_are_more_likely_than_by_single_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = suffix_tree.score_texts(docs).where("held_out").selectExpr("sum(base_score) AS b", "sum(score) AS s").first()
    assert held["b"] < held["s"] < 0


def test_no_rows_and_nothing_to_learn_from(make_docs):
    assert suffix_tree.score_texts(make_docs([(1, "a")]).where("doc_id = 2")).collect() == []
    held = next(i for i in range(100) if is_held(i))
    rows = suffix_tree.score_texts(make_docs([(held, "a b")])).collect()
    assert [tuple(r) for r in rows] == [(held, True, 3, 0, 0, 0.0, 0.0)]


def test_rows_of_a_block_are_read_where_they_lie(spark):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [x for batch in batches for x in batch.column("block").to_pylist()]
        yield pa.RecordBatch.from_pylist([{"block": rows[0], "n": len(rows)}])

    table = suffix_tree._Table(spark, 4)
    rows = spark.range(100).selectExpr("id AS block", "-1 AS level", "0 AS part", "binary('x') AS payload")
    try:
        for _ in range(3):
            table.add(rows)
        found = table.by_block(count, "block bigint, n bigint")
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, found.collect())) == [(i, 3) for i in range(100)]
    finally:
        table.drop()

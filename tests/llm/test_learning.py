"""Classifiers by held-out accuracy, defined results for odd rows, and packing by exact reconstruction."""

import os
import random
import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from tallyspan.llm import packing, quality, toxicity

FOLDER = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")


@needs_tables
@pytest.mark.parametrize(
    ("score", "label", "least"), [(toxicity.score_toxicity, "toxic", 0.94), (quality.score_quality, "quality", 0.95)]
)
def test_held_out_accuracy(spark, score, label, least):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    found = score(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (found["predicted"] == found[label]).mean() >= least
    assert found["score"].between(0, 1).all()


@pytest.mark.parametrize(("score", "label"), [(toxicity.score_toxicity, "toxic"), (quality.score_quality, "quality")])
def test_odd_rows(spark, make_docs, odd_rows, score, label):
    docs = make_docs(odd_rows)
    schema = f"doc_id bigint, {label} int, y string, text string"
    none = spark.createDataFrame([], schema)
    assert [r["score"] for r in score(docs, none).collect()] == [0.5] * len(odd_rows)
    some = spark.createDataFrame([(4, 1, "", ""), (5, 0, "", ""), (5, 1, "", ""), (7, None, "", ""), (None, 1, "", "")], schema)
    found = score(docs, some).collect()
    assert len(found) == len(odd_rows)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if r["doc_id"] in (1, 2)}) == 1
    assert score(docs.where("doc_id = 99"), some).collect() == []


def test_labels_of_the_held_out_fold_change_nothing(spark, make_docs):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abcdefghij") * 3 for _ in range(30))) for i in range(120)]
    for score, label, folds, out in (
        (toxicity.score_toxicity, "toxic", 5, 0),
        (quality.score_quality, "quality", 4, 2),
    ):
        y = [(i, int("aaa" in t)) for i, t in rows]
        flipped = [(i, 1 - v if zlib.crc32(str(i).encode()) % folds == out else v) for i, v in y]
        found = [
            sorted(map(tuple, score(make_docs(rows), spark.createDataFrame(v, f"doc_id bigint, {label} int")).collect()))
            for v in (y, flipped)
        ]
        assert found[0] == found[1]


def test_kneser_ney_probabilities_sum_to_one(spark):
    rng = random.Random(2)
    texts = [("".join(rng.choice("abc ") for _ in range(80)), int(rng.random() < 0.5)) for _ in range(30)]
    counts = toxicity.count_grams(spark.createDataFrame(texts, "text string, y int"), 3)
    expected = {}
    for text, y in texts:
        for gram in toxicity.grams(toxicity.normal(text.encode()), 3).tolist():
            expected.setdefault(gram, [0, 0])[1 - y] += 1
    assert {r["gram"]: [r["toxic"], r["ordinary"]] for r in counts.collect()} == expected
    model = toxicity.fit_models(counts, 3)
    assert len(model["gram"]) == len(expected)
    assert np.isfinite(model["ratio"]).all() and np.isfinite(model["back"]).all()
    small = toxicity.fit_models(counts, 3, rows=10)
    assert len(small["gram"]) <= 10


def test_model_in_shares_is_the_whole_model(spark, make_docs):
    rng = random.Random(8)
    rows = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(30))) for i in range(120)]
    counts = toxicity.count_grams(spark.createDataFrame([(t, i % 2) for i, t in rows], "text string, y int"))
    whole, shares = toxicity.fit_models(counts), list(toxicity.model_shares(counts, rows=100))
    assert len(whole["gram"]) == counts.count() and len(shares) > 10
    assert all(len(share["gram"]) <= 100 for share in shares)
    for name in ("gram", "ratio", "context", "back"):
        assert np.concatenate([share[name] for share in shares]).tolist() == whole[name].tolist()
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, toxic int")
    found = [sorted(map(tuple, toxicity.score_toxicity(make_docs(rows), labels, **more).collect())) for more in ({}, {"share_rows": 100})]
    assert found[0] == found[1]


def test_rows_of_the_curve_fold_that_the_curve_does_not_need_are_counted(spark, make_docs):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % toxicity.FOLDS == toxicity.CURVE]
    rows = [(i, "awful words here" if k % 2 else "pleasant lines there") for k, i in enumerate(ids)]
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id bigint, toxic int")
    few, all_ = (toxicity.score_toxicity(make_docs(rows), labels, curve_rows=n).collect() for n in (4, len(ids)))
    assert all(r["ratio"] != 0 for r in few)
    assert all(r["ratio"] == 0 for r in all_)


def test_one_pass_learns_what_separates():
    state = quality._State()
    texts = [b"Fine words in a row.", b"BAD!! WORDS!!"] * 30
    for (places, values), y in zip(quality.features(texts), [1, 0] * 30, strict=True):
        state.learn(places, values, y)
    w = state.weights(slice(None))
    good, bad = (w[-1] + quality._KINDS * (w[p] @ v) for p, v in quality.features(texts[:2]))
    assert good > 0 > bad


def check_packing(found, rows, capacity=1024):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = sorted(tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for _, t in rows)
    by_seq, by_doc = {}, {}
    for r in found:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], ids.tolist()))
    pad = 0
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
        pad += 0 if at & (at - 1) == 0 else capacity - at
    texts = []
    for (_, n), pieces in by_doc.items():
        copies = sum(start == 0 for start, _ in pieces)
        pieces.sort()
        whole = [[] for _ in range(copies)]
        for k, (start, ids) in enumerate(pieces):
            assert len(whole[k % copies]) == start
            whole[k % copies] += ids
        assert all(len(w) == n for w in whole)
        texts += whole
    assert sorted(texts) == expected
    return pad


def test_packing_odd_rows(make_docs, odd_rows):
    rows = [*odd_rows, (20, "<|endoftext|> </s>"), (21, "á \U0001f600\r\n\r\n  x")]
    check_packing(packing.pack(make_docs(rows), keep_ids=True).collect(), rows)
    assert packing.pack(make_docs(rows).where("doc_id = 99")).collect() == []


@pytest.mark.parametrize("capacity", [64, 1024])
def test_packing_reconstructs_and_pads_little(make_docs, capacity):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["the", "and", "stone", "river"]) for _ in range(rng.randint(0, 90)))) for i in range(700)]
    found = packing.pack(make_docs(rows), keep_ids=True, capacity=capacity, buckets=5).collect()
    pad = check_packing(found, rows, capacity)
    assert pad <= 0.03 * sum(r["length"] for r in found)
    if capacity == 1024:
        again = packing.pack(make_docs(rows, 5)).drop("ids").collect()
        assert sum(r["length"] for r in again) == sum(r["length"] for r in found)


@needs_tables
def test_ids_are_those_of_the_tokenizers_library(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").limit(300).collect()]
    texts += ["a<|endoftext|>b", " <|endoftext|> <|endoftext", "<|endoftext|><|endoftext|>", "<|endoftext|>"]
    encode = packing.encoder(packing.load_vocabulary())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in texts:
        assert encode(text or "").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids

"""Near-duplicate documents, near-duplicate vectors and components against brute force."""

import random

import numpy as np
import pytest

from tallyspan.llm import components, embedding_dedup, minhash_dedup


def groups(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    nodes = [rng.randint(-(2**62), 2**62) for _ in range(300)]
    links = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(220)]
    links += list(zip(nodes[:60], nodes[1:60], strict=False)) + [(nodes[0], n) for n in nodes[200:260]]
    rows = [*links, (nodes[5], nodes[5]), (None, nodes[7]), links[0]]
    found = components.connected_components(spark.createDataFrame(rows, "a bigint, b bigint"))
    met = {n for a, b in links for n in (a, b) if a != b}
    assert dict(map(tuple, found.collect())) == {k: v for k, v in groups(met, links).items()}
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_forest():
    rng = np.random.default_rng(1)
    i, j = rng.integers(0, 200, (2, 130))
    label = components.forest(200, i, j)
    expected = groups(range(200), zip(i.tolist(), j.tolist(), strict=True))
    assert label.tolist() == [expected[n] for n in range(200)]


def shingles(text, size=5):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_docs(rows, percent):
    sets = [shingles(t) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    part = groups(range(len(rows)), links)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[part[k]] = min(doc, least.get(part[k], doc))
    out = []
    for k, (doc, _) in enumerate(rows):
        lowest = least.get(part[k]) if sets[k] else doc
        out.append((doc, len(sets[k]), lowest, doc == lowest))
    return sorted(out, key=repr)


def altered_texts(seed):
    """Bases, copies with a few words changed (so that many pairs are near the threshold), and strangers."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = []
    for copies in (40, 6, 2, 1, 1):
        base = [word() for _ in range(120)]
        texts.append(" ".join(base))
        for _ in range(copies):
            other = list(base)
            for _ in range(rng.randint(0, 3)):
                other[rng.randrange(len(other))] = word()
            texts.append(" ".join(other))
    texts += texts[:3]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("percent", "blocks"), [(85, None), (80, None), (90, None), (85, 3)])
def test_documents_against_brute_force(make_docs, odd_rows, monkeypatch, percent, blocks):
    if blocks:
        monkeypatch.setattr(minhash_dedup, "SET_BLOCK", blocks)
        monkeypatch.setattr(minhash_dedup, "BUCKET_BLOCK", blocks)
    rows = [(i + 100, t) for i, t in altered_texts(percent)] + odd_rows
    found = minhash_dedup.near_duplicates(make_docs(rows), percent)
    found = found.select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, found), key=repr) == brute_docs(rows, percent)


def test_buckets_over_small_batches(spark, make_docs):
    rows = altered_texts(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        found = minhash_dedup.near_duplicates(make_docs(rows)).drop("component", "row").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, found), key=repr) == brute_docs(rows, 85)


def test_signature_distance_guarantee():
    rng = np.random.default_rng(2)
    for percent in (80, 85, 95):
        chunks = minhash_dedup.chunks_for(percent)
        size, most = chunks * minhash_dedup.WIDTH, 2 * chunks - 1
        a = rng.integers(0, 256, (200, size)).astype(np.uint8)
        b = a.copy()
        for row in b:
            row[rng.choice(size, most, replace=False)] += 1
        keys = [minhash_dedup._slot_keys(x, chunks) for x in (a, b)]
        assert (keys[0] == keys[1]).any(1).all()


def test_one_document_of_each_group_stays(make_docs, odd_rows):
    rows = altered_texts(3) + [(0, "same id, other text of some words")] + odd_rows
    docs = make_docs(rows)
    kept = minhash_dedup.deduplicate(docs, 85)
    assert kept.columns == docs.columns
    expected = {c for _, n, c, _ in brute_docs(rows, 85) if n}
    found = kept.collect()
    assert {r["doc_id"] for r in found if shingles(r["text"])} == expected
    assert sum(not shingles(r["text"]) for r in found) == sum(not shingles(t) for _, t in rows)
    assert minhash_dedup.deduplicate(docs.where("doc_id = -1")).collect() == []


def brute_vectors(rows, threshold):
    def usable(v, label):
        return label is not None and bool(v) and None not in v and np.isfinite(v).all() and np.any(v)

    links, counts = [], [0] * len(rows)
    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows[:i]):
            if usable(v, a) and usable(w, b) and a == b and len(v) == len(w):
                x, y = np.float64(v), np.float64(w)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links.append((i, j))
                    counts[i] += 1
                    counts[j] += 1
    part = groups(range(len(rows)), links)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        least[part[k]] = min(i, least.get(part[k], i))
    return sorted((i, counts[k], least[part[k]], i == least[part[k]]) for k, (i, _, _) in enumerate(rows))


@pytest.mark.parametrize("block", [2048, 7])
def test_vectors_against_brute_force(spark, block):
    rng = np.random.default_rng(block)
    centers = rng.normal(size=(12, 10))
    rows = []
    for i in range(240):
        v = centers[i % 12] + rng.normal(size=10) * rng.choice([0.0, 0.1, 0.25])
        rows.append((i, (v * rng.choice([1, 3])).astype(np.float32).tolist(), int(rng.integers(0, 3)) if i % 20 else None))
    zero, nan = [0.0] * 10, [float("nan")] + [1.0] * 9
    odd = [None, [], zero, nan, [None] + [1.0] * 9, [float("inf")] + [0.0] * 9, [1.0, 0.0], [1.0, 0.01]]
    rows += [(300 + i, v, 1) for i, v in enumerate(odd)]
    rows += [rows[1], (400, rows[1][1], rows[1][2])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(4)
    found = embedding_dedup.near_duplicates(table.selectExpr("*", "1 AS cell", "2 AS rep"), block_rows=block)
    assert sorted(map(tuple, found.collect())) == brute_vectors(rows, 0.93)
    assert embedding_dedup.near_duplicates(table.where("vec_id < 0")).collect() == []


@pytest.mark.parametrize("percent, common, own", [(85, 34, 3), (80, 32, 4)])
def test_pairs_at_the_threshold_share_keys_within_the_reach(percent, common, own):
    rng = np.random.default_rng(percent)
    chunks = minhash_dedup.chunks_for(percent)
    lost = 0
    for _ in range(10):
        every = rng.integers(0, 2**63, (10_000, common + 2 * own)).astype(np.uint64)
        a = minhash_dedup._signatures(list(every[:, : common + own]), chunks * minhash_dedup.WIDTH)
        b = minhash_dedup._signatures(list(np.delete(every, range(common, common + own), 1)), chunks * minhash_dedup.WIDTH)
        meet = (minhash_dedup._slot_keys(a, chunks) == minhash_dedup._slot_keys(b, chunks)).any(1)
        lost += int((~meet | ((a != b).sum(1) > minhash_dedup.reach_for(percent, chunks))).sum())
    assert 100 * common == percent * (common + 2 * own)
    assert lost == 0  # of 100,000 pairs


def test_reach_is_the_binomial_tail():
    rng = np.random.default_rng(3)
    for percent in (80, 85, 95):
        chunks = minhash_dedup.chunks_for(percent)
        differ = rng.binomial(chunks * minhash_dedup.WIDTH, minhash_dedup._differs(percent), 1_000_000)
        assert differ.max() <= minhash_dedup.reach_for(percent, chunks)
    assert (minhash_dedup.chunks_for(100), minhash_dedup.reach_for(100, 1)) == (1, 0)

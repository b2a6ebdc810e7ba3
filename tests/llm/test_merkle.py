"""Merkle manifests against a plain version."""

import hashlib
import random
import zlib

import pytest

from tallyspan.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree_of(digests):
    """The root, and per leaf the list of (siblings before, siblings after) on the way up."""
    ways, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        runs = [digests[i : i + 16] for i in range(0, len(digests), 16)]
        for way, i in zip(ways, at, strict=True):
            run = runs[i // 16]
            way.append((run[: i % 16], run[i % 16 + 1 :]))
        at, digests = [i // 16 for i in at], [H(*run) for run in runs]
    return digests[0], ways


def brute(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((row[0], leaf_of(row), row))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        found = sorted(by_source[name], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[name] = (found, *tree_of([x[1] for x in found]))
    root, upper = tree_of([trees[name][1] for name in names])
    out = []
    for name, above in zip(names, upper, strict=True):
        found, subroot, ways = trees[name]
        for (doc, leaf, row), way in zip(found, ways, strict=True):
            way = way + above
            folded = leaf
            if doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0 and row[4] is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                folded = leaf_of((*row[:4], low))
            for before, after in way:
                folded = H(*before, folded, *after)
            proof = H(*(d for before, after in way for d in (*before, *after)))
            out.append((doc, leaf, subroot, root, proof, folded, folded == root))
    return sorted(map(repr, out))


def found(spark, rows, slices=4):
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string, n string, tree string, idx string"
    data = spark.sparkContext.parallelize([(*row, "x", "y", "z") for row in rows], slices)
    docs = spark.createDataFrame(data, schema)
    return sorted(map(repr, map(tuple, merkle.verified_manifest(docs).collect())))


def rows_of(sizes, seed=1):
    rng = random.Random(seed)
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "Abc Ü É", "lower only", "X" * rng.randint(1, 30)])
            rows.append((i, source, rng.choice(["en", None]), rng.choice([None, 3, -1]), text))
            i += 1
    rng.shuffle(rows)
    return rows


SIZES = [
    {"a": 1},
    {None: 1, "": 1},
    {"a": 16},
    {"a": 17, "b": 1, None: 2},
    {"hot": 700, "é": 33, "z": 1, "=": 16, "": 5, None: 40, "^": 3},
    {f"s{i}": 1 + i % 3 for i in range(40)} | {"big": 260},
]


@pytest.mark.parametrize("sizes", SIZES)
def test_against_brute_force(spark, sizes):
    rows = rows_of(sizes)
    expected = brute(rows)
    assert found(spark, rows) == expected
    verified = [x.endswith("True)") for x in expected]
    assert any(verified)


def test_odd_rows(spark, odd_rows):
    rows = [(doc, None, "en", 1, text) for doc, text in odd_rows] * 3 + [(None, "s", None, None, None)] * 20
    assert found(spark, rows) == brute(rows)


def test_no_rows(spark):
    assert found(spark, [], 1) == []


def test_recursion_settings_are_put_back(spark):
    setting = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(setting)
    found(spark, rows_of({"a": 20, "b": 2}))
    assert spark.conf.get(setting) == before

"""Repeated strings and repeated line runs against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from tallyspan.llm import line_dedup, suffix_dedup


def brute_strings(rows, length):
    texts = [(doc, (text or "").encode()) for doc, text in rows]
    count = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for doc, text in texts:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            if count[text[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(text) else 0
        out.append((doc, len(text), int(gone.sum()), spans, bytes(b for b, g in zip(text, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def strings(docs, length, **more):
    found = suffix_dedup.remove_repeats(docs, length, **more).collect()
    return sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in found), key=repr)


def mixed_rows(seed):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("ab é") for _ in range(rng.randint(0, 90))) for _ in range(25)]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))) for i in range(60)]
    return rows + [(70, "a" * 300), (71, "ab" * 200), (70, "a" * 300), (72, None), (73, ""), (None, "xyz" * 40), (74, "a" * 301)]


@pytest.mark.parametrize("collection", [4096, 2])
def test_strings_against_brute_force(make_docs, collection):
    rows = mixed_rows(1)
    assert strings(make_docs(rows), 20, gram=6, collection=collection) == brute_strings(rows, 20)


def test_strings_in_small_sections_and_batches(make_docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SECTION", 50)
    monkeypatch.setattr(suffix_dedup, "BATCH", 5)
    rows = mixed_rows(2)
    assert strings(make_docs(rows), 20, gram=6) == brute_strings(rows, 20)


def test_strings_of_odd_rows(make_docs, odd_rows):
    rows = [(i, t) for i, t in odd_rows if t is None or len(t) < 6000]
    assert strings(make_docs(rows), 200) == brute_strings(rows, 200)
    assert suffix_dedup.remove_repeats(make_docs(odd_rows), 200).count() == len(odd_rows)
    assert suffix_dedup.remove_repeats(make_docs(odd_rows).where("doc_id = 99"), 200).collect() == []


def test_column_construction_orders_suffixes():
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(40)]
    marks = suffix_dedup.repeated_windows(np.zeros(40, int), texts, np.full(40, 6), np.ones(40, int), 6, 6)
    for column in range(7):
        count = Counter(t[column : column + 6] for t in texts)
        assert marks[:, column].tolist() == [count[t[column : column + 6]] > 1 for t in texts]


def brute_lines(rows, least):
    firsts, later = {}, []
    docs = sorted({(d, t) for d, t in rows if t is not None}, key=lambda x: (x[0] is not None, x[0] or 0))
    for doc, text in docs:
        lines = text.split("\n")
        for size in range(1, len(lines) + 1):
            for i in range(len(lines) - size + 1):
                run = tuple(lines[i : i + size])
                if sum(len(x.split()) for x in run) >= least:
                    if run in firsts:
                        later.append((doc, text, i, size))
                    firsts.setdefault(run, (doc, i))
    out = []
    for doc, text in rows:
        lines = [] if text is None else text.split("\n")
        gone = {k for d, t, i, s in later if (d, t) == (doc, text) for k in range(i, i + s)}
        kept = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((doc, kept, len(lines), len(gone), sum(i - 1 not in gone for i in gone)))
    return sorted(out, key=repr)


def test_lines_against_brute_force(make_docs):
    rng = random.Random(6)
    lines = ["", "a", "b c", "d e f g", "h i j k l m", " a"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "\n".join(["a"] * 40)), (None, "h i j k l m\nq"), (72, "\n".join(["a"] * 40))]
    for least in (3, 5):
        found = line_dedup.remove_repeated_lines(make_docs(rows), least)
        found = found.select("doc_id", "text", "n_lines", "n_removed", "n_runs").collect()
        assert sorted(map(tuple, found), key=repr) == brute_lines(rows, least)


def every_run(rows, least):
    """(doc_id, lines left, n_removed, n_runs) by looking at runs of all lengths."""
    firsts, gone = {}, {}
    for doc, text in sorted(rows):
        lines = text.split("\n")
        gone[doc] = set()
        for i in range(len(lines)):
            for size in range(1, len(lines) - i + 1):
                run = tuple(lines[i : i + size])
                if sum(len(x.split()) for x in run) >= least and firsts.setdefault(run, (doc, i)) != (doc, i):
                    gone[doc].update(range(i, i + size))
    kept = {doc: "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[doc]) for doc, text in rows}
    return [(doc, kept[doc], len(out), sum(i - 1 not in out for i in out)) for doc, out in sorted(gone.items())]


def test_runs_of_all_lengths(make_docs):
    rng = random.Random(7)
    lines = ["", "a", "b c", "d e f g", "h i j k l m", " a", "n " * 12]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14)))) for i in range(60)]
    runs = (["a b c d", "e f g h", "i j k l"], [f"p{k} q" for k in range(7)], ["x", "y", "z " * 30], ["u " * 30, "v", ""])
    for k, run in enumerate(runs):
        rows += [(100 + 2 * k + j, "\n".join([f"before {k} {j}", *run, f"after {k} {j}"])) for j in (0, 1)]
    rows += [(200, "\n".join(["r s"] * 40))]
    for least in (1, 3, 10):
        found = line_dedup.remove_repeated_lines(make_docs(rows), least)
        found = found.select("doc_id", "text", "n_removed", "n_runs").collect()
        assert sorted(map(tuple, found)) == every_run(rows, least)


def test_lines_of_odd_rows(make_docs, odd_rows):
    found = line_dedup.remove_repeated_lines(make_docs(odd_rows))
    assert found.count() == len(odd_rows)
    assert found.columns[:3] == ["doc_id", "text", "row"]
    assert line_dedup.remove_repeated_lines(make_docs(odd_rows).where("doc_id = 99")).collect() == []

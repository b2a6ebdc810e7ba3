"""Fill-in-the-middle examples against a plain version, and texts restored from outputs."""

import hashlib
import re

import pytest

from tallyspan.llm import fill_in_middle


def brute(doc, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc, len(units), "plain", None, None, text
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return doc, len(units), "spm" if h[3] % 100 < 20 else "psm", len(p), len(m), out


def many_rows():
    texts = ["a", "Ab cd", "é< S>x", "<P", "P><", "x<S>y", "<M>", "ab" * 300, "日本語 text, 𝄞!\n\t", " ", "q\x00r"]
    return [(i, texts[i % len(texts)] * (1 + i % 3)) for i in range(300)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("piece_bytes", [5, fill_in_middle.PIECE_BYTES])
def test_against_brute_force(make_docs, odd_rows, piece_bytes):
    rows = many_rows() + odd_rows
    if piece_bytes == 5:
        rows = [(i, t) for i, t in rows if t is None or len(t) < 10_000]
    docs = make_docs(rows)
    expected = [brute(doc, text) for doc, text in rows]
    examples = fill_in_middle.fim_examples(docs, piece_bytes)
    assert sorted(map(repr, map(tuple, examples.collect()))) == sorted(map(repr, expected))
    found = fill_in_middle.fim_digests(fill_in_middle.fim_pieces(docs, piece_bytes)).collect()
    digests = [(*row[:5], digest(row[5]), digest(text or "")) for row, (_, text) in zip(expected, rows, strict=True)]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, digests))
    assert {row[2] for row in expected} == {"plain", "psm", "spm"}


def test_pieces_are_bounded_and_repeated_rows_have_keys_of_their_own(make_docs):
    pieces = fill_in_middle.fim_pieces(make_docs([(1, "ab" * 5000)] * 50 + [(None, "x y " * 500)] * 50), 100).collect()
    assert max(len(p["piece"]) for p in pieces) <= 103
    assert len({(bytes(p["document"]), p["task"], p["copy"]) for p in pieces}) == 100


def test_no_rows(make_docs):
    docs = make_docs([(1, "a")]).where("doc_id = 2")
    assert fill_in_middle.fim_digests(fill_in_middle.fim_pieces(docs)).collect() == []
    assert fill_in_middle.fim_examples(docs).collect() == []


def test_one_shuffle(make_docs):
    found = fill_in_middle.fim_digests(fill_in_middle.fim_pieces(make_docs([(1, "a")])))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1

"""License scans and benchmark decontamination against brute force."""

import random
import re

import pytest

from tallyspan.llm import decontaminate, license_scan
from tallyspan.llm.texts import plain_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def random_texts(n, vocabulary, seed, most=60):
    rng = random.Random(seed)
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_words(odd_rows):
    for _, text in odd_rows:
        assert [w.decode() for w in plain_words((text or "").encode())] == words_of(text)


VOCABULARY = ["gnu", "General", "public", "license", "apache", "CC", "by", "MIT", "the", "x-y", "é"]


def test_phrases_against_brute_force(spark, make_docs, odd_rows):
    rows = list(enumerate(random_texts(150, VOCABULARY, 1))) + odd_rows
    expected = []
    for doc, text in rows:
        words, places, labels = words_of(text), [], set()
        for phrase, label in license_scan.PHRASES.items():
            parts = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
            places += at
            labels |= {label} if at else set()
        base = ",".join(sorted(labels))
        expected.append((doc, len(words), len(places), min(places, default=None), max(places, default=None), base))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    found = license_scan.scan_licenses(make_docs(rows)).select(names).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_matching_statistics_against_brute_force():
    templates = [("a", "one two three four five six one two three seven"), ("b", "two three four nine one two three four five")]
    machine = license_scan.automaton(templates, {})
    texts = [t.split() for _, t in templates]
    inside = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    for text in random_texts(200, "one two three four five six nine zero".split(), 2, 30):
        words = text.split()
        longest = []
        for i in range(len(words)):
            size = i + 1
            while size and tuple(words[i + 1 - size : i + 1]) not in inside:
                size -= 1
            longest.append(size)
        expected = [
            (i + 1 - n, n)
            for i, n in enumerate(longest)
            if n >= license_scan.MIN_MATCH and (i + 1 == len(longest) or longest[i + 1] <= n)
        ]
        found = [(a, n) for a, n, _ in machine.scan([w.encode() for w in words])[1]]
        assert found == expected


def test_templates_are_recognised(make_docs):
    notice = license_scan.TEMPLATES[0][1]
    words = notice.split()
    altered = " ".join(w if i % 17 else "changed" for i, w in enumerate(words))
    half = " ".join(words[: len(words) // 4])
    found = license_scan.scan_licenses(make_docs([(1, f"begin {notice} end"), (2, altered), (3, half)]))
    rows = {r["doc_id"]: r for r in found.collect()}
    assert rows[1]["labels"] == "mit" and rows[1]["score"] == 1.0 and rows[1]["n_base"] == 0
    assert rows[1]["spans"][0]["start"] == 1
    assert rows[2]["labels"] == "mit"
    assert rows[3]["labels"] == "" and 0 < rows[3]["score"] < 0.5


def contamination(rows, items, size):
    windows = {}
    for item, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    out = []
    for doc, text in rows:
        words, hit, owners = words_of(text), set(), set()
        for length in {len(w) for w in windows}:
            for i in range(len(words) - length + 1):
                found = windows.get(tuple(words[i : i + length]))
                if found:
                    hit |= set(range(i, i + length))
                    owners |= found
        out.append((doc, len(words), len(hit), len(owners), sorted(owners)))
    return out


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_WORDS, 0])
def test_contamination_against_brute_force(spark, make_docs, odd_rows, limit):
    rows = list(enumerate(random_texts(60, ["a", "b", "C", "d", "e", "f"], 3))) + odd_rows
    texts = random_texts(12, ["a", "b", "c", "D", "e"], 4, 14)
    items = [*enumerate(texts), (99, None), (98, ""), (97, "one two"), (96, "a b"), (96, "a b"), (None, "f f f")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS window")
    found = decontaminate.find_contamination(make_docs(rows), benchmark, 4, limit)
    found = found.select("doc_id", "n_words", "n_hit", "n_items", "items").collect()
    expected = contamination(rows, items, 4)
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_WORDS, 0])
def test_empty_tables(spark, make_docs, limit):
    none = spark.createDataFrame([], "item_id bigint, text string")
    found = decontaminate.find_contamination(make_docs([(1, "a b")]), none, broadcast_words=limit).collect()
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in found] == [(2, 0, [])]
    empty = make_docs([(1, "a")]).where("doc_id > 1")
    assert decontaminate.find_contamination(empty, none, broadcast_words=limit).collect() == []
    assert license_scan.scan_licenses(empty).collect() == []


def test_removal(spark, make_docs):
    items = spark.createDataFrame([(1, "five words of the test")], "item_id bigint, text string")
    docs = make_docs([(1, "Here: FIVE words of, the test again"), (2, "Nothing here.")])
    assert [r["doc_id"] for r in decontaminate.decontaminate(docs, items).collect()] == [2]
    kept = decontaminate.decontaminate(docs, items, remove="spans").orderBy("doc_id")
    assert [r["text"] for r in kept.collect()] == ["here again", "Nothing here."]
    assert kept.columns == [c for c in docs.columns if c != "n_words"]

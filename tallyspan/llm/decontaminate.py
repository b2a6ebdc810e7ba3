"""Benchmark decontamination with a broadcast set of test windows.

A window is ``size`` consecutive words of a benchmark item; an item of fewer
words, but not none, is one window. Windows are kept under a 64-bit hash; a
document's words are scanned for places where all words are benchmark words,
each place's hash is looked up and each hit is verified word by word.

The set is broadcast while its windows' words are within ``BROADCAST_WORDS``.
Beyond that, hashes of document windows and of benchmark windows meet in a join.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tallyspan.llm.texts import byte_texts, free_names, plain_words, powers, slices

SIZE = 10
BROADCAST_WORDS = 2_000_000  # about 200 MB of Python objects at most, and far less as pickled
_Q = 0x2545F4914F6CDD1D

_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
FOUND = StructType(
    [StructField(n, LongType()) for n in ("n_words", "n_hit", "n_items")]
    + [StructField("items", ArrayType(StringType())), StructField("spans", ArrayType(_SPAN))]
)
_TYPES = [
    ("n_words", pa.int64()),
    ("n_hit", pa.int64()),
    ("n_items", pa.int64()),
    ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
]


def _windows(items, size: int) -> dict[tuple[bytes, ...], set[str]]:
    """Every window of the (item_id, text) pairs, with its items."""
    found: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in items:
        words = plain_words((text or "").encode())
        for i in range(max(1, len(words) - size + 1) if words else 0):
            found.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    return found


class _Scanner:
    """The windows by length and hash."""

    def __init__(self, windows: dict[tuple[bytes, ...], set[str]]):
        self.ids: dict[bytes, int] = {}
        self.by_length: dict[int, dict[int, list]] = {}
        for words, items in windows.items():
            ids = np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in words], np.uint64)
            table = self.by_length.setdefault(len(words), {})
            table.setdefault(int(self._roll(ids, len(ids))[0]), []).append((ids, items))

    @staticmethod
    def _roll(ids: np.ndarray, size: int) -> np.ndarray:
        scale, n = powers(_Q, size), len(ids) - size + 1
        out = np.zeros(n, np.uint64)
        for j in range(size):
            out += ids[j : j + n] * scale[j]
        return out

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """The merged word spans hit, and the items whose windows occur."""
        get, places, items = self.ids.get, [], set()
        ids = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
        gaps = np.concatenate(([0], np.cumsum(ids == 0)))
        for size, table in self.by_length.items():
            if len(ids) < size:
                continue
            whole = np.flatnonzero(gaps[size:] == gaps[:-size])
            if not len(whole):
                continue
            rolled = np.zeros(len(whole), np.uint64)
            for j, scale in enumerate(powers(_Q, size)):
                rolled += ids[whole + j] * scale
            for place, h in zip(whole.tolist(), rolled.tolist(), strict=True):
                for window, owners in table.get(h, ()):
                    if np.array_equal(ids[place : place + size], window):
                        places.append((place, place + size))
                        items |= owners
        return merge(places), items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlap; touching ones become one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = SIZE, broadcast_words: int = BROADCAST_WORDS
) -> DataFrame:
    """All rows and columns of ``docs``, and what of each text occurs in benchmark windows.

    ``n_words`` words, ``n_hit`` of them inside windows, ``items`` the sorted
    ids (as text) of the ``n_items`` items met, ``spans`` the merged word
    ranges hit; columns of these names are replaced. Every row gives a row,
    repeated rows too. Null and empty texts have no words and hit nothing, an
    empty benchmark hits nothing, items with a null id count as item ``None``.
    """
    docs = docs.drop(*FOUND.names).withColumn("text", F.col("text").cast("string"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    if _fits(items, size, broadcast_words):
        return _by_broadcast(docs, items, size)
    return _by_join(docs, items, size)


def _fits(items: DataFrame, size: int, limit: int) -> bool:
    """Whether the windows hold at most ``limit`` words; a text has at most half its bytes and one as words."""
    words = F.sum((F.octet_length("text") + 1) / 2 * size).alias("words")
    return (items.agg(words).first()["words"] or 0) <= limit


def _output(batch: pa.RecordBatch, found: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [[]] * len(_TYPES)
    arrays = [pa.array(list(values), kind) for values, (_, kind) in zip(columns, _TYPES, strict=True)]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *arrays], names=[*names, *FOUND.names])


def _schema(docs: DataFrame) -> StructType:
    return StructType([*docs.schema.fields, *FOUND.fields])


def _row(words: list, spans: list[tuple[int, int]], items) -> tuple:
    hit = sum(b - a for a, b in spans)
    return len(words), hit, len(items), sorted(items), [{"start": a, "end": b} for a, b in spans]


def _by_broadcast(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    pairs = [(r["item_id"], r["text"]) for r in items.toLocalIterator()]
    shared = docs.sparkSession.sparkContext.broadcast(_windows(pairs, size))
    names = docs.columns

    def task(batches):
        scanner = _Scanner(shared.value)
        for batch in slices(batches):
            found = []
            for text in byte_texts(batch):
                words = plain_words(text)
                found.append(_row(words, *scanner.scan(words)))
            yield _output(batch, found, names)

    return docs.mapInArrow(task, _schema(docs))


def _digest(words) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _by_join(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """The same by a join on 128-bit window digests; rows of equal texts share their places."""

    def item_task(batches):
        for batch in slices(batches):
            ids, digests, lengths = [], [], []
            for item, text in zip(batch.column("item_id").to_pylist(), byte_texts(batch), strict=True):
                for window in _windows([(item, text.decode())], size):
                    ids.append(str(item))
                    digests.append(_digest(window))
                    lengths.append(len(window))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(digests, pa.binary()), pa.array(lengths, pa.int64())],
                names=["item", "window", "length"],
            )

    windows = items.mapInArrow(item_task, "item STRING, window BINARY, length BIGINT").distinct()
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # 1 to size

    def text_task(batches):
        for batch in slices(batches):
            keys, places, digests = [], [], []
            for key, text in zip(batch.column("key").to_pylist(), byte_texts(batch), strict=True):
                words = plain_words(text)
                for length in lengths:
                    for i in range(len(words) - length + 1):
                        keys.append(key)
                        places.append(i)
                        digests.append(_digest(words[i : i + length]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(places, pa.int64()), pa.array(digests, pa.binary())],
                names=["key", "place", "window"],
            )

    names = docs.columns
    own_key, own_items, own_places = free_names(names, "_key", "_items", "_places")
    keyed = docs.withColumn(own_key, F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    scanned = keyed.select(F.col(own_key).alias("key"), "text").dropDuplicates(["key"])
    places = scanned.mapInArrow(text_task, "key BINARY, place BIGINT, window BINARY").join(windows, "window")
    found = places.groupBy(F.col("key").alias(own_key)).agg(
        F.collect_set("item").alias(own_items),
        F.collect_set(F.struct("place", "length")).alias(own_places),
    )
    joined = keyed.join(found, own_key, "left").select(*names, own_items, own_places)

    def finish(batches):
        for batch in slices(batches):
            out = []
            columns = (byte_texts(batch), batch.column(own_items).to_pylist(), batch.column(own_places).to_pylist())
            for text, owners, spots in zip(*columns, strict=True):
                spans = merge([(p["place"], p["place"] + p["length"]) for p in spots or ()])
                out.append(_row(plain_words(text), spans, owners or []))
            yield _output(batch, out, names)

    return joined.mapInArrow(finish, _schema(docs))


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, remove: str = "documents") -> DataFrame:
    """``docs`` without benchmark passages, all columns kept.

    ``remove="documents"`` leaves out every document with a hit,
    ``remove="spans"`` keeps it and joins its other words by single spaces,
    lower-cased as they are compared; texts without a hit stay as they are.
    """
    found = find_contamination(docs, benchmark, size)
    names = [n for n in found.columns if n not in FOUND.names]
    if remove == "documents":
        return found.where("n_hit = 0").select(names)
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")

    def task(batches):
        for batch in slices(batches):
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                if spans:
                    words, at, kept = plain_words(text.encode()), 0, []
                    for span in spans:
                        kept += words[at : span["start"]]
                        at = span["end"]
                    text = b" ".join(kept + words[at:]).decode()
                out.append(text)
            columns = [pa.array(out, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return found.select(*names, "spans").mapInArrow(task, found.select(names).schema)

"""Fill-in-the-middle examples, assembled from pieces by a secondary sort."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.texts import byte_texts, slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_MARK = re.compile(b"<[PSM]>")

# Bytes of text in one piece; a piece ends where a unit ends, unless a single unit is longer.
PIECE_BYTES = 1 << 16

_DOC = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint"
_KEY = "document binary, task int, copy bigint"
PIECES = f"{_KEY}, {_DOC}, place bigint, piece binary"
_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _arrow(schema: str) -> pa.Schema:
    """Arrow's form of a list of columns."""
    return pa.schema([(name, _TYPES[kind]) for name, kind in map(str.split, schema.split(", "))])


def _unit_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which bytes begin a unit ``[A-Za-z]+|[^A-Za-z]``; a text's first byte always does."""
    lower = data | 32
    letter = (lower >= 97) & (lower <= 122)
    starts = (data & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    starts[bounds[bounds < len(data)]] = True
    return starts


def _unit_at(starts: np.ndarray, k: int) -> int:
    """The byte where a text's unit ``k`` begins, or its length where it has no such unit."""
    for at in range(0, len(starts), PIECE_BYTES):
        here = starts[at : at + PIECE_BYTES]
        n = int(np.count_nonzero(here))
        if k < n:
            return at + int(np.flatnonzero(here)[k])
        k -= n
    return len(starts)


def _chunks(starts: np.ndarray, start: int, end: int, size: int) -> list[tuple[int, int]]:
    """Cut the bytes from ``start`` to ``end`` where units begin into runs of at most ``size`` bytes."""
    out = []
    while end - start > size:
        inside = np.flatnonzero(starts[start + 1 : start + size + 1])
        at = start + 1 + int(inside[-1]) if len(inside) else start + size
        out.append((start, at))
        start = at
    return [*out, (start, end)]


def _cut(doc_id, text: bytes, starts: np.ndarray, size: int) -> tuple[int, str, int, int, list[bytes]]:
    """Units, form, where prefix and middle end, and the output in pieces."""
    digest = hashlib.sha256(b"1:" + (b"" if doc_id is None else str(doc_id).encode())).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = int(np.count_nonzero(starts))
    a, b = (_unit_at(starts, k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))

    def pieces(mark: bytes, start: int, end: int) -> list[bytes]:
        first, *more = _chunks(starts, start, end, size)
        return [mark + text[slice(*first)], *(text[x:y] for x, y in more)]

    if not text or h3 % 100 >= 90 or _MARK.search(text):
        return n, "plain", a, b, pieces(b"", 0, len(text))
    prefix, suffix, middle = pieces(PREFIX, 0, a), pieces(SUFFIX, b, len(text)), pieces(MIDDLE, a, b)
    if h4 % 100 < 20:
        return n, "spm", a, b, suffix + prefix + middle
    return n, "psm", a, b, prefix + suffix + middle


def fim_pieces(docs: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The outputs of all documents in pieces: key (document, task, copy), doc columns, place, piece.

    A document of n units is cut after two unit counts that its id fixes, and
    goes into prefix, suffix and middle order with their marks. An empty or null
    text, one that holds a mark, and a tenth of the others stay plain. The key is
    a digest of id and text with a number for equal rows, so any rows may repeat,
    also under one id or under null, and none gathers in one task. Pieces hold at
    most ``piece_bytes`` bytes (and a mark), so no step holds a whole output.
    """

    def cut(batches):
        seen: Counter = Counter()
        task = TaskContext.get().partitionId()
        kinds = _arrow(PIECES)
        for batch in slices(batches):
            ids, texts = batch.column("doc_id").to_pylist(), byte_texts(batch)
            data = np.frombuffer(b"".join(texts), np.uint8)
            bounds = np.cumsum([0, *map(len, texts)])
            starts, heads = _unit_starts(data, bounds[:-1]), (data & 0xC0) != 0x80
            rows = []
            for doc_id, text, at in zip(ids, texts, bounds.tolist(), strict=False):
                n, form, a, b, pieces = _cut(doc_id, text, starts[at : at + len(text)], piece_bytes)
                chars = (int(np.count_nonzero(heads[at + x : at + y])) for x, y in ((0, a), (a, b)))
                key = hashlib.blake2b(f"{doc_id}:".encode() + text, digest_size=16).digest()
                row = (key, task, seen[key], doc_id, n, form, *((None, None) if form == "plain" else chars))
                seen[key] += 1
                rows += [(*row, place, piece) for place, piece in enumerate(pieces)]
            columns = [pa.array(c, field.type) for c, field in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(cut, PIECES)


def in_order(pieces: DataFrame) -> DataFrame:
    """Each document's pieces in one partition, in the order of the output (a secondary sort)."""
    key = ["document", "task", "copy"]
    return pieces.repartition(*key).sortWithinPartitions(*key, "place")


_ORIGIN = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}


def _documents(batches, columns: list[str]):
    """For each row of the batches, whether it begins another document, and its values of ``columns``."""
    now = None
    for batch in batches:
        keys = zip(*(batch.column(name).to_pylist() for name in ("document", "task", "copy")), strict=True)
        values = zip(*(batch.column(name).to_pylist() for name in columns), strict=True)
        rows = []
        for key, row in zip(keys, values, strict=True):
            rows.append((key != now, row))
            now = key
        yield batch, rows


def fim_digests(pieces: DataFrame) -> DataFrame:
    """One row per document: its columns and the digests of the output and of the text restored from it.

    Pieces stream in output order into one running digest per document. The
    marks read from them say where each belongs in the text; a second sort
    within the partition, without a shuffle, streams them in that order into
    the other digest. A task holds one batch of pieces.
    """

    names = [x.split()[0] for x in _DOC.split(", ")]

    def read(batches):
        digest, part = None, 0
        for batch, rows in _documents(batches, ["form", "place", "piece"]):
            origins, pieces, digests = [], [], []
            for new, (form, place, piece) in rows:
                if new:
                    digest, part = hashlib.sha256(), 0
                digest.update(piece)
                if form != "plain" and piece[:3] in _ORIGIN:
                    part, piece = _ORIGIN[piece[:3]], piece[3:]
                origins.append((part << 48) + place)
                pieces.append(piece)
                digests.append(digest.digest())
            more = [pa.array(origins, pa.int64()), pa.array(pieces, pa.binary()), pa.array(digests, pa.binary())]
            kept = [*batch.schema.names[:-1], "origin", "piece", "so_far"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *more], names=kept)

    def restore(batches):
        whole = _arrow(f"{_DOC}, output_sha256 string, restored_sha256 string")
        doc = digest = latest = None

        def ended():
            return (*doc, latest[1].hex(), digest.hexdigest())

        for _, rows in _documents(batches, [*names, "place", "piece", "so_far"]):
            done = []
            for new, (*row, place, piece, so_far) in rows:
                if new:
                    if doc:
                        done.append(ended())
                    doc, digest, latest = row, hashlib.sha256(), (place, so_far)
                digest.update(piece)
                latest = max(latest, (place, so_far))
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(whole.names, r, strict=True)) for r in done], schema=whole)
        if doc:
            yield pa.RecordBatch.from_pylist([dict(zip(whole.names, ended(), strict=True))], schema=whole)

    read_schema = f"{_KEY}, {_DOC}, place bigint, origin bigint, piece binary, so_far binary"
    streamed = in_order(pieces).mapInArrow(read, read_schema)
    resorted = streamed.sortWithinPartitions("document", "task", "copy", "origin")
    return resorted.mapInArrow(restore, f"{_DOC}, output_sha256 string, restored_sha256 string")


def fim_examples(docs: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row per document with its whole ``output``, for training; see :func:`fim_pieces`.

    Returns doc_id, n, form, prefix_chars, middle_chars and output; a null text
    is an empty one. Other columns of ``docs`` are not kept. An output is one
    value, as its text was.
    """

    names = [x.split()[0] for x in _DOC.split(", ")]

    def join(batches):
        whole = _arrow(f"{_DOC}, output string")
        doc, parts = None, []

        def ended():
            values = (*doc, b"".join(parts).decode())
            return pa.RecordBatch.from_pylist([dict(zip(whole.names, values, strict=True))], schema=whole)

        for _, rows in _documents(batches, [*names, "piece"]):
            for new, (*row, piece) in rows:
                if new:
                    if doc:
                        yield ended()
                    doc, parts = row, []
                parts.append(piece)
        if doc:
            yield ended()

    return in_order(fim_pieces(docs, piece_bytes)).mapInArrow(join, f"{_DOC}, output string")

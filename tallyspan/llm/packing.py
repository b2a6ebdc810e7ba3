"""Harmonic packing of token sequences.

A piece whose length is in (C/(j+1), C/j] belongs to class j, and a sequence of
capacity C takes exactly j pieces of one class. Documents may be cut, so their
pieces are cut to lengths that fill such sequences: whole sequences first, then
C/2, C/4, ... down to C/32 = 32 tokens as the rest allows, and a tail of at
most 31 tokens in one piece. Each class then holds pieces of one length, and a
sequence of class j wastes C mod length < 32 tokens, nothing in the classes of
C's divisors.

Only the last sequence of a class may be short of pieces. In a class of C's
divisors (powers of two) the pieces at hand are split into sequences of 1, 2,
4, ... pieces, whose lengths are powers of two and need no padding. Pieces of
other classes that fill no sequence, fewer than C in each of 26 classes, are
cut further into powers of two.

Workers number the pieces of a class bucket by bucket, independently; the
buckets' counts, summed up, give each bucket its first number. So no task and
no group holds a whole class.
"""

from __future__ import annotations

import json
import zlib
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyspan.functions.keys import SEED
from tallyspan.llm.texts import slices
from tallyspan.session import checkpointed

CAPACITY = 1024
TAIL = 32  # tails shorter than this stay whole
BUCKETS = 64
END = 0  # id that ends a document
VOCABULARY = "byte_bpe_50k.json"


def load_vocabulary(path: str | None = None) -> dict:
    """A byte-level vocabulary file of the tokenizers library: its content, special strings, and ranks of the others.

    Its strings write printable Latin-1 bytes as themselves and the other bytes,
    in order, as the characters from 256 on.
    """
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        text = file.read()
    content = json.loads(text)
    special = [token["content"] for token in content.get("added_tokens", [])]
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - plain))}
    words = content["model"]["vocab"].items()
    ranks = {bytes(byte_of[c] for c in word): n for word, n in words if word not in special}
    return {"content": text, "special": special, "ranks": ranks}


def encoder(vocabulary: dict):
    """A function from texts to the ids that the tokenizers library gives, as unsigned 32-bit integers.

    ``tiktoken`` gives the same ids several times as fast, but for texts that
    hold a special string; those go through the library itself.
    """
    fast = tiktoken.Encoding(
        "pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary["ranks"], special_tokens={}
    )
    whole: list[Tokenizer] = []

    def ids(text: str) -> array:
        if not any(token in text for token in vocabulary["special"]):
            return array("I", fast.encode_ordinary(text))
        if not whole:
            whole.append(Tokenizer.from_str(vocabulary["content"]))
        return array("I", whole[0].encode(text, add_special_tokens=False).ids)

    return ids


def cut(n: int, capacity: int = CAPACITY, tail: int = TAIL) -> list[int]:
    """The lengths of the pieces of ``n`` tokens, in order."""
    lengths = [capacity] * (n // capacity)
    left, part = n % capacity, capacity // 2
    while part >= tail:
        if left & part:
            lengths.append(part)
        part //= 2
    return lengths + ([left % tail] if left % tail else [])


PIECE = "doc_id {}, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, ids BINARY"


def _pieces(texts: DataFrame, path: str | None, keep_ids: bool, capacity: int) -> DataFrame:
    # plain values only, since workers unpickle them without this package
    shared = texts.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    tail = capacity // (CAPACITY // TAIL)

    def task(batches):
        vocabulary = shared.value
        if "built" not in vocabulary:  # once in each worker
            vocabulary["built"] = encoder(vocabulary)
        encode = vocabulary["built"]
        for batch in slices(batches):
            docs, rows = batch.column("doc_id"), []
            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = encode(text or "")
                ids.append(END)
                ids, start = np.frombuffer(ids, np.uint32).astype("<u4", copy=False), 0
                for length in cut(len(ids), capacity, tail):
                    own = ids[start : start + length].tobytes()
                    kept = own if keep_ids or length < tail else None
                    rows.append((row, start, length, zlib.crc32(own), len(ids), kept))
                    start += length
            at, *columns = zip(*rows, strict=True)
            kinds = [pa.int64()] * 4 + [pa.binary()]
            arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [docs.take(pa.array(at)), *arrays],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
            )

    return texts.mapInArrow(task, PIECE.format(texts.schema["doc_id"].dataType.simpleString()))


def _numbered(pieces: DataFrame, buckets: int) -> DataFrame:
    """Number the pieces of each length from 0 (column ``number``)."""
    bucket = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "start", "ids_crc32"), F.lit(buckets))
    pieces = checkpointed(pieces.withColumn("bucket", bucket))  # read twice, made once
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = pieces.groupBy("length", "bucket").count()
    first = first.select("length", "bucket", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = pieces.withColumn("rank", F.row_number().over(inside) - 1)
    joined = ranked.join(F.broadcast(first), ["length", "bucket"])  # a row per length up to C and bucket at most
    return joined.withColumn("number", F.col("first") + F.col("rank")).drop("bucket", "first", "rank")


def _lookup(values: dict[int, int], key):
    """Column of a small table, here one row per class."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[key]


def _totals(pieces: DataFrame) -> dict[int, int]:
    return {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # one row per class


def pack(
    docs: DataFrame,
    path: str | None = None,
    keep_ids: bool = False,
    capacity: int = CAPACITY,
    buckets: int = BUCKETS,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids) of every piece.

    ``capacity`` is a power of two from 64 on. ``path`` names the vocabulary
    file (on the driver, which sends it to the tasks); strings of its special
    tokens in a text get their ids, as in the library. Null and empty texts are the end id
    alone. Every row is a document of its own, also with a repeated or null
    doc_id. No documents give no pieces. Other columns are ignored.
    ``ids`` are little-endian unsigned 32-bit ids.
    """
    if capacity < 2 * TAIL or capacity & (capacity - 1):
        raise ValueError("capacity is a power of two, 64 at least")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    numbered = checkpointed(_numbered(_pieces(texts, path, keep_ids, capacity), buckets))
    totals = _totals(numbered)
    divides = {n: capacity % n == 0 for n in totals}

    # tails that fill no sequence of their class are cut into powers of two
    full = {n: t if divides[n] else t - t % (capacity // n) for n, t in totals.items()}
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "number", "ids"]
    stay, extra = numbered.select(names), None
    if full != totals:
        over = F.col("number") >= _lookup(full, F.col("length"))
        bits = [1 << b for b in range(capacity.bit_length()) if 1 << b < TAIL][::-1]
        part = F.explode(F.array(*[F.lit(b) for b in bits])).alias("part")
        loose = numbered.where(over).select("*", part).where(F.col("length").bitwiseAND(F.col("part")) != 0)
        # the larger parts of a tail come first
        before = F.col("length").bitwiseAND(F.bitwise_not(2 * F.col("part") - 1))
        ids = F.substring("ids", (4 * before + 1).cast("int"), (4 * F.col("part")).cast("int"))
        cutting = loose.select(
            "doc_id",
            (F.col("start") + before).cast("bigint").alias("start"),
            F.col("part").cast("bigint").alias("length"),
            F.crc32(ids).alias("ids_crc32"),
            "doc_tokens",
            ids.alias("ids"),
        )
        extra = checkpointed(_numbered(cutting, 1))  # fewer than C rows for each of the lengths below TAIL
        more = _totals(extra)
        shift = F.coalesce(_lookup(totals, F.col("length")), F.lit(0))
        extra = extra.withColumn("number", F.col("number") + shift).select(names)
        stay = numbered.where(~over).select(names)
        totals = {n: full.get(n, 0) + more.get(n, 0) for n in full.keys() | more.keys()}
    placed = stay if extra is None else stay.unionByName(extra)
    if not totals:
        return _finish(placed.withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")}), keep_ids)

    # sequences of each class: the full ones, then one for each bit of what is left
    fit = {n: capacity // n for n in totals}
    whole = {n: t // fit[n] for n, t in totals.items()}
    rest = {n: t % fit[n] for n, t in totals.items()}
    first, at = {}, 0
    for n in sorted(totals, reverse=True):
        first[n], at = at, at + whole[n] + rest[n].bit_count()
    length, number = F.col("length"), F.col("number")
    placed = placed.withColumns({"per": _lookup(fit, length), "whole": _lookup(whole, length), "rest": _lookup(rest, length)})
    # the left pieces' place among themselves is below 0 in full sequences; the highest bit in which it differs
    # from the count of left pieces is the bit whose sequence takes the piece
    placed = placed.withColumn("inside", number - F.col("whole") * F.col("per"))
    placed = placed.withColumn("k", F.length(F.bin(F.col("rest").bitwiseXOR(F.col("inside")))) - 1)
    lone = F.col("whole") + F.bit_count(F.expr("shiftright(rest, k + 1)"))
    sequence = _lookup(first, length) + F.when(F.col("inside") < 0, F.floor(number / F.col("per"))).otherwise(lone)
    position = F.when(F.col("inside") < 0, number % F.col("per")).otherwise(
        F.expr("inside & (shiftleft(1L, k) - 1)")
    )
    return _finish(
        placed.withColumns(
            {"sequence_id": sequence.cast("bigint"), "offset": (position * length).cast("bigint")}
        ),
        keep_ids,
    )


def _finish(placed: DataFrame, keep_ids: bool) -> DataFrame:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return placed.select(*names, *(["ids"] if keep_ids else []))

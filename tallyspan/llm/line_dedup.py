"""Deletion of repeated line runs, by prefix doubling over sequences of line ids.

A run of lines, of any length, with at least ``MIN_WORDS`` words is deleted
where an equal run begins earlier, in the order of doc_id and line; adjacent and
overlapping ones make up the maximal repeated runs.

Not all runs need a look. Take a line of a run that is to be deleted, and leave
off lines at the run's ends as long as it keeps the line and enough words. What
remains is the shortest run with enough words from its first line on, or the
shortest one up to its last line; it is repeated at the same place of the
earlier copy. So those two runs of each line, looked up over the whole
collection, cover all that longest common prefixes would give, to their ends.

Suffixes of the documents' line sequences are ranked by their first 1, 2, 4, 8,
... lines. A rank is a 128-bit hash of the two ranks of half the length, and a
run of any length goes by the ranks of two overlapping runs of the largest power
of two in it. Ranks are doubled where the lines are, for all documents in
parallel; only the runs to look up are brought together by rank.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tallyspan.llm.texts import byte_texts, free_names, mix, slices

MIN_WORDS = 10
_P = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _shortest(words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First lines and lengths of the runs with enough words that are shortest from their first or to their last line."""
    upto, n = np.concatenate(([0], np.cumsum(words))), len(words)
    # the first end with enough words after each line, and the last start with enough words before each end
    ends = np.maximum(np.searchsorted(upto, upto[:-1] + min_words), np.arange(1, n + 1))
    starts = np.minimum(np.searchsorted(upto, upto[1:] - min_words, "right") - 1, np.arange(n))
    left, right = np.flatnonzero(ends <= n), np.flatnonzero(starts >= 0)
    first = np.concatenate((left, starts[right]))
    return np.unique(np.column_stack((first, np.concatenate((ends[left], right + 1)) - first)), axis=0).T


def _runs(text: bytes, min_words: int):
    """(line, lines, rank, rank) arrays of the runs of one text that must be looked up."""
    lines = text.split(b"\n")
    words = np.fromiter((len(line.split()) for line in lines), np.int64, len(lines))
    first, length = _shortest(words, min_words)
    if not len(first):
        return
    digests = b"".join(hashlib.blake2b(line, digest_size=16).digest() for line in lines)
    ranks = np.frombuffer(digests, "<u8").reshape(-1, 2).copy()
    size, longest = 1, length.max()
    while True:
        now = (length >= size) & (length < 2 * size)
        at, n = first[now], length[now]
        yield at, n, _joined(ranks[at], ranks[at + n - size])
        if longest < 2 * size:
            return
        ranks = _joined(ranks[:-size], ranks[size:])
        size *= 2


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The ranks of two runs as one."""
    return np.column_stack([mix(a[:, k] * _P[k] + b[:, k]) for k in (0, 1)])


def _version() -> Column:
    """Tells texts of one doc_id apart."""
    return F.xxhash64(F.col("text"))


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, version, runs): the later copies in each document, as structs of first line and number of lines.

    ``version`` is the hash of the text. Rows of one doc_id and one text count
    once; texts of one doc_id go by their hash. A null doc_id comes first.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("version", _version())
    kind = texts.schema["doc_id"].dataType.simpleString()

    def task(batches):
        for batch in slices(batches):
            rows, parts = [], []
            for row, text in enumerate(byte_texts(batch)):
                for at, size, ranks in _runs(text, min_words):
                    if len(at):
                        rows.append(np.full(len(at), row))
                        parts.append((at, size, ranks[:, 0].view(np.int64), ranks[:, 1].view(np.int64)))
            if not rows:
                continue
            where = pa.array(np.concatenate(rows))
            line, lines, r1, r2 = (pa.array(np.concatenate(p)) for p in zip(*parts, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(where), batch.column("version").take(where), line, lines, r1, r2],
                names=["doc_id", "version", "line", "lines", "r1", "r2"],
            )

    schema = f"doc_id {kind}, version BIGINT, line BIGINT, lines BIGINT, r1 BIGINT, r2 BIGINT"
    runs = texts.mapInArrow(task, schema).withColumn("place", F.struct("doc_id", "version", "line"))
    rank = ["lines", "r1", "r2"]
    firsts = runs.groupBy(rank).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("copies"))
    later = runs.join(firsts.where("copies > 1").drop("copies"), rank).where(~F.col("place").eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "version").agg(F.collect_set(F.struct("line", "lines")).alias("runs"))


def remove_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of ``docs``, with what is left of each text, and what was taken.

    Adds ``n_lines``, ``n_removed`` (lines) and ``n_runs`` (maximal runs
    removed). The lines left are joined as they were; a text of which nothing
    is left is empty. Lines are split at line feeds and compared as they are;
    words are what white space separates. A null text stays null and has no
    lines; an empty one has one empty line. Columns of ``docs`` by the added
    names are replaced; all others stay, whatever their names.
    """
    found = repeated_lines(docs, min_words)
    docs = docs.drop("n_lines", "n_removed", "n_runs")
    key, doc, version, runs = free_names(docs.columns, "_text", "_doc", "_version", "_runs")
    found = found.withColumnsRenamed({"doc_id": doc, "version": version, "runs": runs})
    text = F.col("text").cast("string")
    keyed = docs.withColumn(key, F.xxhash64(text))
    # runs are there for few documents, and each (doc_id, version) has one row
    joined = keyed.join(
        found, (keyed[key] == found[version]) & keyed["doc_id"].eqNullSafe(found[doc]), "left"
    )
    plain = joined.drop(key, doc, version)
    names = docs.columns
    schema = StructType(
        [f for f in plain.select(names).schema if f.name != "text"]
        + [StructField("text", StringType())]
        + [StructField(n, LongType()) for n in ("n_lines", "n_removed", "n_runs")]
    )

    def task(batches):
        for batch in slices(batches):
            out = []
            for text, taken in zip(batch.column("text").to_pylist(), batch.column(runs).to_pylist(), strict=True):
                out.append(_without(text, taken))
            columns = [batch.column(f.name) for f in schema.fields[:-4]]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
            columns += [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return plain.withColumn("text", text).mapInArrow(task, schema).select(*names, "n_lines", "n_removed", "n_runs")


def _without(text: str | None, runs: list[dict] | None) -> tuple[str | None, int, int, int]:
    """The text without the runs, its lines, lines removed, and maximal runs removed."""
    if text is None:
        return None, 0, 0, 0
    lines = text.split("\n")
    if not runs:
        return text, len(lines), 0, 0
    steps = np.zeros(len(lines) + 1, np.int64)
    for run in runs:
        steps[run["line"]] += 1
        steps[run["line"] + run["lines"]] -= 1
    gone = np.cumsum(steps[:-1]) > 0
    starts = int((gone & ~np.concatenate(([False], gone[:-1]))).sum())
    kept = [line for line, out in zip(lines, gone.tolist(), strict=True) if not out]
    return "\n".join(kept), len(lines), int(gone.sum()), starts

"""Removal of repeated byte strings with a column-wise Burrows-Wheeler construction.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere
else is removed. The construction is the one for collections of many short
strings: each round puts one more symbol in front of every string's suffix,
sorts the new suffixes by that symbol and by their old order, and gets their
common prefixes from the old ones by range minima. Its rounds are as many as
the strings are long, so texts are first cut into short pieces, in a way that
loses no repeat and lines repeats up:

* A window of ``LENGTH`` bytes is anchored at its smallest hashed string of
  ``GRAM`` bytes (the leftmost of equals). Equal windows have equal anchors at
  equal places. A piece holds all windows of one anchor: at most ``REACH``
  bytes before it and ``LENGTH`` from it on.
* Only pieces whose anchor string occurs more than once go on, equal pieces as
  one with a count. Pieces that share an anchor string form a collection; they
  are aligned at the anchor, so equal windows begin in the same column, and a
  round's suffixes need comparing only with those of the same round. The
  transform and the common prefixes are therefore kept as one column per round,
  read and written in order; a task holds the columns of a bounded batch.

Collections of more than ``COLLECTION`` different pieces do not go to one task:
their windows are counted by a 128-bit hash, one row each.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.texts import BYTE_VALUES, byte_texts, mix, powers, slices
from tallyspan.session import checkpointed

LENGTH = 200
GRAM = 32
COLLECTION = 4096
BATCH = 8_192  # pieces in one batch of collections; a collection more at most
SECTION = 1 << 19  # bytes of text that anchors are found in at a time
_P = 0x5851F42D4C957F2D
_INVERSE = pow(_P, -1, 1 << 64)
_PLACE = np.uint64((1 << 24) - 1)
_OUTSIDE = 256  # symbol where a piece has none


def _sections(texts: list[bytes], length: int):
    """(bytes, doc of each part, where it starts in the bytes and in the doc, its bytes) with all windows once."""
    parts, size = [], 0
    for doc, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, SECTION):
            part = text[at : at + SECTION + length - 1]
            if parts and size + len(part) > SECTION + length:
                yield parts
                parts, size = [], 0
            parts.append((doc, at, part))
            size += len(part)
    if parts:
        yield parts


def pieces(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """The pieces of all texts: doc, start, owned (windows), before (bytes before the anchor), anchor and content hashes."""
    names = ("doc", "start", "owned", "before", "anchor", "content")
    found: dict[str, list] = {n: [] for n in names}
    span = length - gram + 1
    for parts in _sections(texts, length):
        joined = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
        n = len(joined)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUES[joined] * powers(_P, n), out=sums[1:])
        inverse = powers(_INVERSE, n)
        grams = mix((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
        # leftmost minima over all windows, from running minima of blocks in either direction
        value = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        blocks = -(-len(value) // span) * span
        padded = np.full(blocks, ~np.uint64(0))
        padded[: len(value)] = value
        padded = padded.reshape(-1, span)
        ahead = np.minimum.accumulate(padded, 1).reshape(-1)
        back = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].reshape(-1)
        windows = n - length + 1
        anchor = (np.minimum(back[:windows], ahead[span - 1 : span - 1 + windows]) & _PLACE).astype(np.int64)
        sizes = np.array([len(p) for _, _, p in parts])
        ends = np.cumsum(sizes)
        part = np.repeat(np.arange(len(parts)), sizes)[:windows]
        inside = np.arange(windows) + length <= ends[part]
        change = np.ones(windows, bool)
        change[1:] = (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]) | (inside[1:] != inside[:-1])
        starts = np.flatnonzero(change)
        owned = np.diff(np.append(starts, windows))
        starts, owned = starts[inside[starts]], owned[inside[starts]]
        at, until = anchor[starts], starts + owned + length - 1
        before = at - starts
        own = (sums[until] - sums[starts]) * inverse[starts]
        place = np.array([a for _, a, _ in parts]) - (ends - sizes)
        docs = np.array([d for d, _, _ in parts])
        found["doc"].append(docs[part[starts]])
        found["start"].append(starts + place[part[starts]])
        found["owned"].append(owned)
        found["before"].append(before)
        found["anchor"].append(grams[at])
        found["content"].append(mix(own ^ mix(before.astype(np.uint64) << np.uint64(20) | owned.astype(np.uint64))))
    out = {n: np.concatenate(v) if v else np.empty(0, np.int64) for n, v in found.items()}
    for n in ("anchor", "content"):
        out[n] = out[n].astype(np.uint64).view(np.int64)
    return out


def repeated_windows(
    collection: np.ndarray, texts: list[bytes], before: np.ndarray, counts: np.ndarray, length: int, reach: int
):
    """For each piece, which of its first ``reach + 1`` window starts are repeated.

    ``collection`` numbers each piece's collection, ascending. A piece that
    stands for several copies repeats itself.
    """
    n, width = len(texts), reach + length
    symbols = np.full((width, n), _OUTSIDE, np.uint16)  # a row is a column of the construction
    for k, text in enumerate(texts):
        at = reach - before[k]
        symbols[at : at + len(text), k] = np.frombuffer(text, np.uint8)
    last = reach - before + np.array([len(t) for t in texts]) - length  # column of a piece's last window
    order, prefix = np.arange(n), np.zeros(n + 1, np.int64)  # of the newest suffixes: their sequence, common prefixes
    base = collection.astype(np.int64) * (_OUTSIDE + 1)
    marks = np.zeros((n, reach + 1), bool)
    single = counts < 2
    for column in range(width - 1, -1, -1):
        # the transform of the last round: the symbol before each of its suffixes, in their order
        key = base[order] + symbols[column, order]
        step = np.argsort(key, kind="stable")
        order, key = order[step], key[step]
        equal = np.zeros(n + 1, bool)
        equal[1:n] = (key[1:] == key[:-1]) & (symbols[column, order[1:]] != _OUTSIDE)
        new = np.zeros(n + 1, np.int64)
        beside = equal.copy()
        beside[1:n] &= step[1:] == step[:-1] + 1
        at = np.flatnonzero(beside)
        new[at] = prefix[step[at]] + 1
        at = np.flatnonzero(equal & ~beside)
        if len(at):
            ranges = np.column_stack((step[at - 1] + 1, step[at] + 1)).reshape(-1)
            new[at] = np.minimum.reduceat(prefix, ranges)[::2] + 1
        prefix = np.minimum(new, length)
        if column <= reach:
            full = prefix >= length
            again = (full[:-1] | full[1:]) | ~single[order]
            again &= (column >= reach - before[order]) & (column <= last[order])
            hit = order[again]
            marks[hit, column - reach + before[hit]] = True
    return marks


def _cover(starts: np.ndarray, length: int) -> list[dict]:
    """The byte ranges that the windows at ascending starts cover."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    first = starts[np.concatenate(([0], cut))]
    last = starts[np.concatenate((cut - 1, [len(starts) - 1]))] + length
    return [{"a": a, "b": b} for a, b in zip(first.tolist(), last.tolist(), strict=True)]


_RANGES = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
_FOUND = "anchor BIGINT, content BIGINT, ranges ARRAY<STRUCT<a: BIGINT, b: BIGINT>>"


def _found(anchor, content, ranges) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor, pa.int64()), pa.array(content, pa.int64()), pa.array(ranges, _RANGES)],
        names=["anchor", "content", "ranges"],
    )


def _occurrences(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Pieces (anchor, content, row, start, owned) whose anchor string occurs more than once.

    An anchor string that a slice of texts holds twice is decided there; its
    pieces are dealt out evenly, and one row tells the other slices.
    """

    def cut(batches):
        for batch in slices(batches, limit=SECTION):
            found = pieces(byte_texts(batch), length, gram)
            rows = batch.column("row").to_numpy()[found["doc"]]
            unique, at, count = np.unique(found["anchor"], return_inverse=True, return_counts=True)
            sure = count[at] > 1
            deal = np.where(sure, mix((rows + found["start"]).view(np.uint64)).view(np.int64), found["anchor"])
            tell = unique[count > 1]
            none = np.zeros(len(tell), np.int64)
            columns = {
                "deal": (deal, tell),
                "state": (sure.astype(np.int64) * 2, none + 1),
                "anchor": (found["anchor"], tell),
                "content": (found["content"], none),
                "row": (rows, none),
                "start": (found["start"], none),
                "owned": (found["owned"], none),
            }
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in columns.values()], names=list(columns)
            )

    names = "anchor BIGINT, content BIGINT, row BIGINT, start BIGINT, owned BIGINT"
    dealt = texts.mapInArrow(cut, f"deal BIGINT, state BIGINT, {names}").repartition("deal")
    # rows of state 2 come after all others
    ordered = dealt.sortWithinPartitions(F.col("state") == 2, "anchor", "state").drop("deal")
    columns = ["state", "anchor", "content", "row", "start", "owned"]

    def repeated(batches):
        held = None  # the last row, and whether its anchor has come before
        for batch in batches:
            data = np.stack([batch.column(c).to_numpy() for c in columns], 1)
            if not len(data):
                continue
            known = False
            if held is not None:
                data, known = np.concatenate((held[0][None], data)), held[1]
            sure = data[:, 0] == 2
            same = (data[1:, 1] == data[:-1, 1]) & ~sure[1:] & ~sure[:-1]
            keep = sure.copy()
            keep[1:] |= same
            keep[:-1] |= same
            keep[0] |= known
            held = (data[-1], bool(keep[-1]))
            keep &= data[:, 0] != 1
            keep[-1] = False
            yield pa.RecordBatch.from_arrays([pa.array(data[keep, k]) for k in range(1, 6)], names=columns[1:])
        if held is not None and held[1] and held[0][0] != 1:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in held[0][1:].tolist()], names=columns[1:])

    return ordered.mapInArrow(repeated, names)


def _contents(texts: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """(anchor, content, count, before, bytes) of the wanted pieces, each from one text that has it."""
    lists = wanted.groupBy("row").agg(F.collect_list(F.struct("anchor", "content", "count", "big")).alias("wanted"))

    def read(batches):
        for batch in slices(batches, limit=SECTION):
            held = byte_texts(batch)
            found = pieces(held, length, gram)
            place: dict = {}
            for k, key in enumerate(zip(found["doc"].tolist(), found["anchor"].tolist(), found["content"].tolist(), strict=True)):
                place.setdefault(key, k)
            out = []
            for doc, rows in enumerate(batch.column("wanted").to_pylist()):
                for w in rows:
                    k = place.get((doc, w["anchor"], w["content"]))
                    if k is not None:
                        at = int(found["start"][k])
                        text = held[doc][at : at + int(found["owned"][k]) + length - 1]
                        out.append((w["anchor"], w["content"], w["count"], int(found["before"][k]), w["big"], text))
            kinds = [pa.int64()] * 4 + [pa.bool_(), pa.binary()]
            columns = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["anchor", "content", "count", "before", "big", "bytes"],
            )

    schema = "anchor BIGINT, content BIGINT, count BIGINT, before BIGINT, big BOOLEAN, bytes BINARY"
    return texts.join(lists, "row").select("text", "wanted").mapInArrow(read, schema)


def _by_columns(contents: DataFrame, length: int, gram: int) -> DataFrame:
    """The repeated ranges of all pieces, collection by collection."""
    reach = length - gram

    def construct(rows):
        anchors = np.array([r[0] for r in rows])
        _, collection = np.unique(anchors, return_inverse=True)
        before, counts = (np.array([r[k] for r in rows]) for k in (3, 2))
        marks = repeated_windows(collection, [r[4] for r in rows], before, counts, length, reach)
        return _found(
            anchors, [r[1] for r in rows], [_cover(np.flatnonzero(m), length) for m in marks]
        )

    def task(batches):
        rows: list[tuple] = []
        names = ("anchor", "content", "count", "before", "bytes")
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if len(rows) >= BATCH and row[0] != rows[-1][0]:
                    yield construct(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield construct(rows)

    ordered = contents.select("anchor", "content", "count", "before", "bytes").repartition("anchor")
    return ordered.sortWithinPartitions("anchor", "content").mapInArrow(task, _FOUND)


def _by_windows(contents: DataFrame, length: int) -> DataFrame:
    """The same for pieces of large collections: their windows counted by hash."""

    def split(batches):
        for batch in batches:
            names = ("anchor", "content", "count", "bytes")
            for anchor, content, count, text in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                starts = range(len(text) - length + 1)
                digests = [hashlib.blake2b(text[i : i + length], digest_size=16).digest() for i in starts]
                size = len(digests)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(size, anchor)),
                        pa.array(np.full(size, content)),
                        pa.array(np.full(size, count)),
                        pa.array(np.arange(size)),
                        pa.array(digests, pa.binary()),
                    ],
                    names=["anchor", "content", "count", "start", "window"],
                )

    windows = contents.mapInArrow(
        split, "anchor BIGINT, content BIGINT, count BIGINT, start BIGINT, window BINARY"
    )
    again = windows.groupBy("window").agg(F.sum("count").alias("copies")).where("copies > 1").select("window")
    ranges = windows.join(again, "window").groupBy("anchor", "content")
    return ranges.agg(F.collect_set(F.struct(F.col("start").alias("a"), (F.col("start") + length).alias("b"))).alias("ranges"))


def _removed(text: bytes, ranges: list[dict]) -> tuple[bytes, int, int]:
    """What is left of the bytes, how many go, and in how many maximal runs."""
    kept, at, gone, runs = [], 0, 0, 0
    for a, b in sorted((r["a"], r["b"]) for r in ranges):
        if b <= at:
            continue
        if a > at or not runs:
            runs += 1
            kept.append(text[at:a])
        gone += b - max(a, at)
        at = b
    return b"".join(kept) + text[at:], gone, runs


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, collection: int = COLLECTION) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary) of every row of ``docs``.

    Texts are UTF-8 bytes, null as empty; ``kept`` need not be valid UTF-8.
    Repeats count within a text and between texts, also those of repeated rows,
    and are judged on the input. Texts shorter than ``length`` stay whole.
    Other columns are ignored. ``gram`` is below ``length``.
    """
    if not 0 < gram < length < 1 << 19:
        raise ValueError("gram is at least 1 and below length, length below 524288")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("row", F.xxhash64("doc_id", "text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    occurrences = checkpointed(_occurrences(texts.select("row", "text"), length, gram))
    equal = occurrences.groupBy("anchor", "content").agg(
        F.count(F.lit(1)).alias("count"), F.min("row").alias("row"), F.max("owned").alias("owned")
    )
    kinds = equal.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"))
    equal = checkpointed(equal.join(kinds, "anchor"))
    # a collection of one string, with its copies, needs no sorting
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("a"), (F.col("owned") + length - 1).alias("b")))
    alone = equal.where("kinds = 1").select("anchor", "content", whole.alias("ranges"))
    wanted = equal.where("kinds > 1").withColumn("big", F.col("kinds") > collection)
    contents = checkpointed(_contents(texts, wanted, length, gram))
    found = (
        alone.unionByName(_by_columns(contents.where("NOT big"), length, gram))
        .unionByName(_by_windows(contents.where("big"), length))
        .where(F.size("ranges") > 0)
    )
    marked = occurrences.join(found, ["anchor", "content"]).select(
        "row", F.expr("transform(ranges, r -> struct(r.a + start AS a, r.b + start AS b))").alias("ranges")
    )
    marked = marked.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_list("ranges"))).alias("ranges"))

    def task(batches):
        for batch in slices(batches):
            out = []
            held = byte_texts(batch)
            for text, ranges in zip(held, batch.column("ranges").to_pylist(), strict=True):
                out.append(_removed(text, ranges or []))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t) for t in held], pa.int64()),
                    pa.array([o[1] for o in out], pa.int64()),
                    pa.array([o[2] for o in out], pa.int64()),
                    pa.array([o[0] for o in out], pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    joined = texts.join(marked, "row", "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(task, f"doc_id {kind}, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept BINARY")

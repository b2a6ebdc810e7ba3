"""Near-duplicate documents by a multi-index Hamming join of b-bit minhash signatures.

A document is its set of hashed word shingles. Its signature has one byte of
each of ``CHUNKS * WIDTH`` minimum hashes (b = 8), and the distance of two
signatures is the number of differing bytes. The signature is split into
``CHUNKS`` chunks of ``WIDTH`` bytes. Two signatures that differ in at most
``2 * CHUNKS - 1`` bytes differ in at most one byte of some chunk (pigeonhole),
so enumerating the one byte that may differ, every chunk has ``WIDTH`` keys,
and such a pair shares at least one key: none is lost. Most pairs further apart
share one too, and all pairs that share a key are decided on full sets up to a
larger distance, :func:`reach_for`. :func:`chunks_for` chooses the number of
chunks. Of pairs exactly at the similarity threshold, at most one in ``1 / LOSS``
shares no key, and at most one in ``1 / LOSS`` is further apart than the reach;
of more similar pairs fewer.

Documents with equal sets are taken together first. Then

1. members of buckets are compared with the lowest of their buckets' first members by signature,
2. buckets that still join different groups are compared whole, in tiles of
   two blocks; what comes back is a spanning forest, never pairs,
3. in each resulting group the full sets are compared with the set nearest to
   the group's most frequent bytes, and
4. those not linked to it are compared, in tiles again, with each other and
   with all the rest of their group.

So every pair that shares a key within the reach is decided on full sets or joined
already, and no step's rows grow with the square of a group.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.keys import SEED
from tallyspan.llm.components import connected_components, forest
from tallyspan.llm.texts import byte_texts, free_names, mix, seeded, shingle_sets, slices
from tallyspan.session import broadcast_if_small, checkpointed

SHINGLE = 5
WIDTH = 6
LOSS = 1e-9
FIRSTS = 4  # bucket firsts that a document is compared with at the start
BUCKET_BLOCK = 1024  # signatures in a block of a bucket
SET_BLOCK = 128  # full sets in a block of a group


def _differs(percent: int) -> float:
    """The probability that a byte of the signatures of two sets of that similarity differs."""
    return (1 - percent / 100) * 255 / 256


def chunks_for(percent: int) -> int:
    """The fewest chunks for which a pair of that similarity shares no key with a probability of LOSS at most."""
    q = _differs(percent)
    none = 1 - (1 - q) ** WIDTH - WIDTH * q * (1 - q) ** (WIDTH - 1)  # two bytes of a chunk differ, or more
    chunks = math.ceil(math.log(LOSS) / math.log(none)) if none > 0 else 1
    if chunks > 1000:
        raise ValueError("the similarity threshold is too low for one allowed error in each chunk")
    return max(1, chunks)


def reach_for(percent: int, chunks: int) -> int:
    """The distance that a pair of that similarity exceeds with a probability of LOSS at most, by the binomial tail."""
    q, size = _differs(percent), chunks * WIDTH
    tail, reach = 0.0, size
    while reach >= 0:
        tail += math.comb(size, reach) * q**reach * (1 - q) ** (size - reach)
        if tail > LOSS:
            return reach
        reach -= 1
    return 2 * chunks - 1


def _signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """One row of ``size`` bytes per set; sets are not empty."""
    out = np.empty((len(sets), size), np.uint8)
    if not len(sets):
        return out
    at = np.cumsum([0, *(len(s) for s in sets[:-1])])
    every = np.concatenate(sets)
    for k, value in enumerate(seeded(size, 1 << 40) | np.uint64(1)):
        # multiplying and taking the high bits after one fold is a hash of its own for each k
        h = every * value
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        low = np.minimum.reduceat(h, at)
        out[:, k] = (mix(low) >> np.uint64(56)).astype(np.uint8)
    return out


def _identity(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _blob(column) -> np.ndarray:
    """A column of equally long byte strings as a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1) if values else np.empty((0, 0), np.uint8)


def _slot_keys(signatures: np.ndarray, chunks: int) -> np.ndarray:
    """(rows, chunks * WIDTH) keys: each chunk without one of its bytes, mixed with the slot's number."""
    parts = signatures.reshape(len(signatures), chunks, WIDTH).astype(np.uint64)
    shifts = np.arange(WIDTH, dtype=np.uint64) * np.uint64(8)
    whole = (parts << shifts).sum(2, dtype=np.uint64)
    without = whole[:, :, None] - (parts << shifts)
    slots = np.arange(chunks * WIDTH, dtype=np.uint64).reshape(chunks, WIDTH)
    return mix(without ^ (slots << np.uint64(48))).reshape(len(signatures), -1)


def _members(classes: DataFrame, chunks: int) -> DataFrame:
    """(key, cls, first) of all rows of buckets with at least two members; ``first`` is the bucket's lowest cls."""

    def keys(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                found = _slot_keys(_blob(part.column("sig")), chunks)
                ids = np.repeat(part.column("cls").to_numpy(), found.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.reshape(-1).view(np.int64)), pa.array(ids)], names=["key", "cls"]
                )

    spread = classes.select("cls", "sig").mapInArrow(keys, "key BIGINT, cls BIGINT")
    ordered = spread.repartition("key").sortWithinPartitions("key", "cls")

    def buckets(batches):
        # what is held over: the last row, its bucket's first member, and whether that row is alone so far
        key = ids = None
        first_of = alone = None
        for batch in batches:
            k, c = batch.column("key").to_numpy(), batch.column("cls").to_numpy()
            if not len(k):
                continue
            if key is not None:
                k, c = np.concatenate(([key], k)), np.concatenate(([ids], c))
            start = np.concatenate(([True], k[1:] != k[:-1]))
            at = np.maximum.accumulate(np.where(start, np.arange(len(k)), 0))
            first = c[at]
            if key is not None:
                first[at == 0] = first_of
            keep = ~(start & np.concatenate((start[1:], [False])))
            if key is not None and not alone:
                keep[0] = True
            key, ids, first_of = k[-1], c[-1], first[-1]
            alone = bool(start[-1])
            keep[-1] = False
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]) for a in (k, c, first)], names=["key", "cls", "first"])
        if key is not None and not alone:
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(v)], pa.int64()) for v in (key, ids, first_of)], names=["key", "cls", "first"]
            )

    return ordered.mapInArrow(buckets, "key BIGINT, cls BIGINT, first BIGINT")


def _near_first(members: DataFrame, classes: DataFrame, limit: int) -> DataFrame:
    """Links (a, b) between members and the lowest firsts of their buckets, by signature."""
    firsts = F.array_sort(F.collect_set("first"))  # one for each of the signature's keys at most
    lowest = members.where("cls <> first").groupBy(F.col("cls").alias("a")).agg(firsts.alias("firsts"))
    pairs = lowest.select("a", F.explode(F.slice("firsts", 1, FIRSTS)).alias("b"))
    sigs = classes.select("cls", "sig")
    joined = pairs.join(sigs.withColumnsRenamed({"cls": "a", "sig": "x"}), "a")
    joined = joined.join(sigs.withColumnsRenamed({"cls": "b", "sig": "y"}), "b").select("a", "b", "x", "y")

    def near(batches):
        for batch in batches:
            differ = (_blob(batch.column("x")) != _blob(batch.column("y"))).sum(1)
            yield batch.select(["a", "b"]).filter(pa.array(differ <= limit))

    return joined.mapInArrow(near, "a BIGINT, b BIGINT")


def _blocked(rows: DataFrame, size: int, whole: bool = False) -> DataFrame:
    """Pairs of blocks of each group: its ``rare`` rows with all rows, not the others among themselves.

    ``rare_rows`` and ``other_rows`` count the group's rows of both kinds. Adds
    side (0, 1) and the tile (s1, s2); blocks of the others have negative
    numbers. With ``whole``, a group of ``size`` rows or fewer is one tile.
    """
    rows = rows.where("rare_rows > 0").select(
        "*",
        F.ceil(F.col("rare_rows") / size).alias("rares"),
        F.ceil(F.col("other_rows") / size).alias("others"),
        (F.lit(whole) & (F.col("rare_rows") + F.col("other_rows") <= size)).alias("alone"),
    )
    count = F.when(F.col("rare"), F.col("rares")).otherwise(F.col("others"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "cls"), count))

    def tile(s1, s2, side):
        return F.struct(s1.alias("s1"), s2.alias("s2"), side.alias("side"))

    b, zero = F.col("block"), F.lit(0).cast("bigint")
    among = F.transform(
        F.sequence(zero, F.col("rares") - 1),
        lambda s: tile(F.least(s, b), F.greatest(s, b), F.when(b <= s, 0).otherwise(1)),
    )
    with_others = F.when(
        F.col("others") > 0,
        F.transform(F.sequence(zero, F.col("others") - 1), lambda s: tile(b, -1 - s, F.lit(0))),
    ).otherwise(F.expr("CAST(array() AS ARRAY<STRUCT<s1: BIGINT, s2: BIGINT, side: INT>>)"))
    from_other = F.transform(F.sequence(zero, F.col("rares") - 1), lambda s: tile(s, -1 - b, F.lit(1)))
    tiles = F.when(F.col("rare"), F.concat(among, with_others)).otherwise(from_other)
    tiles = F.when(F.col("alone"), F.array(tile(zero, zero, F.lit(0)))).otherwise(tiles)
    return rows.withColumn("tile", F.explode(tiles)).drop(
        "block", "rares", "others", "rare", "alone", "rare_rows", "other_rows"
    ).select("*", "tile.*").drop("tile")


def _sides(table: pa.Table):
    side = table.column("side").to_numpy()
    left = np.flatnonzero(side == 0)
    same = table.column("s1")[0].as_py() == table.column("s2")[0].as_py()
    return left, (left if same else np.flatnonzero(side == 1)), same


def _mixed_buckets(members: DataFrame, classes: DataFrame, groups: DataFrame, limit: int) -> DataFrame:
    """Links (a, b) that join buckets of more than one group, by signature: a forest of each tile."""
    known = members.select("key", "cls").join(groups.withColumnsRenamed({"id": "cls", "component": "grp"}), "cls", "left")
    known = known.withColumn("grp", F.coalesce("grp", "cls"))
    counts = known.groupBy("key", "grp").agg(F.count(F.lit(1)).alias("n")).groupBy("key")
    counts = counts.agg(F.min(F.struct("grp", "n")).alias("low"), F.max("grp").alias("high"), F.sum("n").alias("total"))
    mixed = counts.where("low.grp < high").select(
        "key", F.col("low.grp").alias("low"), (F.col("total") - F.col("low.n")).alias("rare_rows"), F.col("low.n").alias("other_rows")
    )
    # a bucket's lowest group needs no comparison with itself
    rows = known.join(mixed, "key").withColumn("rare", F.col("grp") != F.col("low")).drop("low")
    tiled = _blocked(rows, BUCKET_BLOCK, whole=True).join(classes.select("cls", "sig"), "cls")

    def compare(table: pa.Table) -> pa.Table:
        left, right, same = _sides(table)
        sig, ids, grp = _blob(table.column("sig")), *(table.column(n).to_numpy() for n in ("cls", "grp"))
        _, start = np.unique(grp, return_inverse=True)
        places = [[np.empty(0, np.int64)], [np.empty(0, np.int64)]]
        for a in range(0, len(left), 128):
            u = left[a : a + 128]
            for z in range(a if same else 0, len(right), 128):
                v = right[z : z + 128]
                differ = (sig[u][:, None, :] != sig[v][None, :, :]).sum(2, dtype=np.int32)
                i, j = np.nonzero((differ <= limit) & (start[u][:, None] != start[v][None, :]))
                places[0].append(u[i])
                places[1].append(v[j])
        i, j = (np.concatenate(p) for p in places)
        low = forest(len(ids), i, j)
        met = np.flatnonzero(low != np.arange(len(ids)))
        return pa.table({"a": ids[met], "b": ids[low[met]]})

    return tiled.groupBy("key", "s1", "s2").applyInArrow(compare, "a BIGINT, b BIGINT")


def _centers(grouped: DataFrame) -> DataFrame:
    """(grp, center): the class whose signature is nearest to its group's most frequent bytes."""

    def split(batches):
        for batch in batches:
            sig = _blob(batch.column("sig"))
            n, size = sig.shape
            if n:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(batch.column("grp").to_numpy(), size)),
                        pa.array(np.tile(np.arange(size), n)),
                        pa.array(sig.reshape(-1).astype(np.int32)),
                    ],
                    names=["grp", "place", "byte"],
                )

    bytes_ = grouped.select("grp", "sig").mapInArrow(split, "grp BIGINT, place BIGINT, byte INT")
    often = bytes_.groupBy("grp", "place", "byte").count().groupBy("grp", "place")
    often = often.agg(F.max(F.struct("count", "byte"))["byte"].alias("byte"))
    often = often.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("place", "byte"))).alias("often"))

    def distance(batches):
        for batch in batches:
            sig = _blob(batch.column("sig"))
            if len(sig):
                often = np.array([[x["byte"] for x in row] for row in batch.column("often").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("grp"), batch.column("cls"), pa.array((sig != often).sum(1).astype(np.int64))],
                    names=["grp", "cls", "far"],
                )

    far = grouped.join(often, "grp").select("grp", "cls", "sig", "often")
    far = far.mapInArrow(distance, "grp BIGINT, cls BIGINT, far BIGINT")
    return far.groupBy("grp").agg(F.min(F.struct("far", "cls"))["cls"].alias("center"))


def _values(column) -> list[np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(at, at[1:], strict=False)]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two ascending sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    low, high = sorted((len(a), len(b)))
    if 100 * low < percent * high:
        return False
    common = _common(a, b)
    return 100 * common >= percent * (low + high - common)


def _verified(grouped: DataFrame, sets: DataFrame, percent: int, limit: int) -> DataFrame:
    """Links (a, b) confirmed on full sets that join everything that is linked within the groups."""
    centers = checkpointed(_centers(grouped))
    middle = centers.join(sets.drop("sig").withColumnRenamed("cls", "center"), "center").select("grp", "center", F.col("shingles").alias("own"))
    others = grouped.join(sets.drop("sig"), "cls").select("grp", "cls", "shingles")
    beside = others.join(middle, "grp").select("grp", "cls", "center", "shingles", "own")

    def near(batches):
        for batch in batches:
            pairs = zip(_values(batch.column("shingles")), _values(batch.column("own")), strict=True)
            linked = [_alike(a.view(np.uint64), b.view(np.uint64), percent) for a, b in pairs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("grp", "cls", "center")] + [pa.array(linked, pa.bool_())],
                names=["grp", "cls", "center", "linked"],
            )

    star = checkpointed(beside.mapInArrow(near, "grp BIGINT, cls BIGINT, center BIGINT, linked BOOLEAN"))
    kinds = star.groupBy("grp").agg(F.count_if(~F.col("linked")).alias("rare_rows"), F.count_if("linked").alias("other_rows"))
    rows = star.join(kinds.where("rare_rows > 0"), "grp").withColumn("rare", ~F.col("linked"))
    tiled = _blocked(rows.select("grp", "cls", "rare", "rare_rows", "other_rows"), SET_BLOCK)
    tiled = tiled.join(sets, "cls")

    def compare(table: pa.Table) -> pa.Table:
        left, right, same = _sides(table)
        sig, ids = _blob(table.column("sig")), table.column("cls").to_numpy()
        held = [s.view(np.uint64) for s in _values(table.column("shingles"))]
        label = np.arange(len(ids))
        for u in left.tolist():
            v = right[right > u] if same else right
            v = v[((sig[u] != sig[v]).sum(1) <= limit) & (label[v] != label[u])]
            for w in v[np.argsort((sig[u] != sig[v]).sum(1), kind="stable")].tolist():
                if label[w] != label[u] and _alike(held[u], held[w], percent):
                    low, high = sorted((label[u], label[w]))
                    label[label == high] = low
        met = np.flatnonzero(label != np.arange(len(ids)))
        return pa.table({"a": ids[met], "b": ids[label[met]]})

    found = tiled.groupBy("grp", "s1", "s2").applyInArrow(compare, "a BIGINT, b BIGINT")
    direct = star.where("linked AND cls <> center").select(F.col("cls").alias("a"), F.col("center").alias("b"))
    return direct.unionByName(found)


def near_duplicates(docs: DataFrame, percent: int = 85, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, and cls (null without words) of every row of ``docs``.

    Documents are linked if 100 times the size of their sets' intersection is
    at least ``percent`` times that of the union; ``component_id`` is the
    smallest doc_id that links reach, and ``kept`` marks the rows that have it.
    Fewer than ``shingle`` words are one shingle; null texts and texts without
    words have no shingle and no links. Rows of equal texts are always linked,
    also with equal or null ids; nulls count only where no other id is. Other
    columns are ignored.
    """
    chunks = chunks_for(percent)
    size, limit = chunks * WIDTH, max(2 * chunks - 1, reach_for(percent, chunks))
    source = docs.select(
        "doc_id",
        F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("doc_id"), F.col("text")).alias("row"),
    )
    kind = source.schema["doc_id"].dataType.simpleString()

    def describe(batches):
        for batch in slices(batches):
            sets = shingle_sets(byte_texts(batch), shingle)
            some = [s for s in sets if len(s)]
            found = iter(_signatures(some, size))
            sigs = [next(found).tobytes() if len(s) else None for s in sets]
            ids = [_identity(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.array(sigs, pa.binary()),
                ],
                names=["doc_id", "row", "n_shingles", "cls", "sig"],
            )

    rows = checkpointed(
        source.mapInArrow(describe, f"doc_id {kind}, row BIGINT, n_shingles BIGINT, cls BIGINT, sig BINARY")
    )
    classes = checkpointed(
        rows.where("cls IS NOT NULL")
        .groupBy("cls")
        .agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("row"), F.min("sig").alias("sig"))
    )
    members = checkpointed(_members(classes, chunks))
    links = checkpointed(_near_first(members, classes, limit))
    # what leads to the same class in two steps is in one group; buckets tell the rest
    lowest = links.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    further = lowest.select(F.col("id").alias("component"), F.col("component").alias("next"))
    groups = lowest.join(further, "component", "left").select("id", F.coalesce("next", "component").alias("component"))
    links = links.unionByName(_mixed_buckets(members, classes, groups, limit))
    groups = connected_components(links).withColumnsRenamed({"id": "cls", "component": "grp"})
    grouped = checkpointed(groups.join(classes, "cls").select("grp", "cls", "sig", "row"))

    # full sets of the classes in groups, from one document each
    wanted = grouped.select("cls", "row", "sig")
    texts = source.select("row", "text").join(broadcast_if_small(wanted, wanted.count(), 64 + size), "row")

    def full(batches):
        for batch in slices(batches):
            sets = shingle_sets(byte_texts(batch), shingle)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("cls"),
                    batch.column("sig"),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                names=["cls", "sig", "shingles"],
            )

    one_each = texts.dropDuplicates(["cls"]).select("cls", "sig", "text")
    sets = one_each.mapInArrow(full, "cls BIGINT, sig BINARY, shingles ARRAY<BIGINT>")
    parts = connected_components(_verified(grouped, checkpointed(sets), percent, limit))
    parts = classes.select("cls", "doc_id").join(parts.withColumnRenamed("id", "cls"), "cls", "left")
    parts = parts.withColumn("component", F.coalesce("component", "cls"))
    lowest = parts.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = parts.join(lowest, "component").select("cls", "component_id", "component")
    found = rows.select("doc_id", "row", "n_shingles", "cls").join(named, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "component",
        "row",
    )


def deduplicate(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one row of each group stays, as do rows without words.

    It is the row with the smallest id; of several such rows, one of them. All
    columns stay as they are.
    """
    found = near_duplicates(docs, percent).where("kept AND component IS NOT NULL").select("component", "row")
    [row] = free_names(docs.columns, "_row")
    one = found.groupBy("component").agg(F.min("row").alias(row)).select(row)
    keyed = docs.withColumn(row, F.xxhash64(F.col("doc_id"), F.col("text").cast("string")))
    stay = keyed.join(one, row, "left_semi").dropDuplicates([row])
    wordless = keyed.where(F.coalesce("text", F.lit("")).rlike(r"\A[\x20\x09-\x0D]*\z"))
    return stay.unionByName(wordless).drop(row)

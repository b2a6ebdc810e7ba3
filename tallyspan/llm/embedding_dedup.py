"""Near-duplicate embeddings by tiled comparison in the order of principal components.

Vectors are compared only within a label. Equal vectors are first taken
together. Unit vectors are turned into principal axes (fitted on a bounded
sample; the turn changes no cosine). Vectors with a cosine of at least t are at
most sqrt(2 - 2t) apart, so along the first axis they are in the same or in
neighbouring cells of that width; cells are dealt into blocks of bounded size,
and pairs of blocks are the tiles. In a tile the leading axes are multiplied
first; what the others can add is bounded by the product of suffix norms, and
pairs that cannot reach t are dropped before the next axes. Pairs that may
reach it are decided by their cosine on the given vectors in double precision.

A tile returns, per vector, its number of links and the smallest id it is
linked to inside the tile, never pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.keys import SEED
from tallyspan.llm.components import connected_components, forest
from tallyspan.session import checkpointed

THRESHOLD = 0.93
BLOCK_ROWS = 2048  # mean size of a block; a tile holds two
SAMPLE_ROWS = 10_000  # vectors that the axes are fitted on
SUB = 512  # rows on a side of one matrix product
STEPS = (8, 16, 32, 64, 128, 256, 512, 1024)
_SLACK = 1e-9


def _axes(vectors: DataFrame, rows: int) -> dict[int, np.ndarray]:
    """Principal axes of a sample, for each dimension in it; largest variance first."""
    sample = vectors.orderBy(F.xxhash64(F.lit(SEED), "id")).limit(rows).select("dim", "vector")
    by_dim: dict[int, list] = {}
    for row in sample.toLocalIterator():
        by_dim.setdefault(row["dim"], []).append(row["vector"])
    axes = {}
    for dim, found in by_dim.items():
        x = np.array(found, np.float64)
        x /= np.linalg.norm(x / np.abs(x).max(1, keepdims=True), axis=1, keepdims=True) * np.abs(x).max(1, keepdims=True)
        # second moments, not variances: they say how much of the products an axis holds
        axes[dim] = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    return axes


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(1, keepdims=True)
    x = x / scale
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _linked(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, threshold: float):
    """Places (i, j) of the pairs of rows with a cosine of at least ``threshold``."""
    dim = px.shape[1]
    ends = [s for s in STEPS if s < dim] + [dim]
    first = ends[0]
    sums = px[:, :first] @ py[:, :first].T
    rest = [np.linalg.norm(p[:, first:], axis=1) for p in (px, py)]
    i, j = np.nonzero(sums + np.outer(*rest) >= threshold - _SLACK)
    total = sums[i, j]
    for a, b in zip(ends, ends[1:], strict=False):
        total = total + np.einsum("ij,ij->i", px[i, a:b], py[j, a:b])
        left = np.linalg.norm(px[:, b:], axis=1)[i] * np.linalg.norm(py[:, b:], axis=1)[j]
        stay = total + left >= threshold - _SLACK
        i, j, total = i[stay], j[stay], total[stay]
    norms = np.sqrt(np.einsum("ij,ij->i", x, x)[i] * np.einsum("ij,ij->i", y, y)[j])
    exact = np.einsum("ij,ij->i", x[i], y[j])
    scaled = ~(np.isfinite(norms) & (norms > 1e-200))  # far from 1: on vectors scaled to 1
    cosine = np.divide(exact, norms, out=np.zeros(len(i)), where=~scaled)
    if scaled.any():
        cosine[scaled] = total[scaled]
    stay = cosine >= threshold
    return i[stay], j[stay]


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    block_rows: int = BLOCK_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors``.

    Rows with a null label, a null or empty vector, a zero vector, or a null or
    non-finite component link with nothing; vectors of different dimensions do
    not link. Equal vectors of a label link with each other, repeated rows
    count as vectors of their own, and a component is its smallest id. Other
    columns are ignored. ``threshold`` is above 0.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold is above 0 and at most 1")
    rows = vectors.select(
        F.col(id_column).cast("bigint").alias("vec_id"),
        F.col(label_column).alias("label"),
        F.col(vector_column).alias("vector"),
    )
    bad = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = (
        F.col("label").isNotNull()
        & (F.size("vector") > 0)
        & ~F.coalesce(bad, F.lit(True))
        & F.exists("vector", lambda v: v != 0)
    )
    valid = rows.where(usable)
    # all that follows needs of equal vectors is one of them and their number
    alike = valid.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    node = F.xxhash64("label", "vector", "rep")  # ids of rows may repeat
    distinct = checkpointed(alike.withColumn("id", node).withColumn("dim", F.size("vector")))
    context = vectors.sparkSession.sparkContext
    shared = context.broadcast(_axes(distinct, sample_rows))

    width = float(np.sqrt(2 - 2 * threshold)) * (1 + 1e-6) + 1e-6

    def place(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cells = np.zeros(len(dims), np.int64)
            for dim in np.unique(dims):
                axes = shared.value.get(int(dim))
                if axes is None:
                    continue
                at = np.flatnonzero(dims == dim)
                x = _unit(_matrix(batch.column("vector").take(pa.array(at)), int(dim)))
                cells[at] = np.floor(x @ axes[:, 0] / width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], names=[*batch.schema.names, "cell"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema)
    placed = distinct.mapInArrow(place, f"{fields}, cell BIGINT")

    # blocks of each cell and of the cells beside it
    cell = ["label", "dim", "cell"]
    blocks = placed.groupBy(cell).agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks"))
    blocks = checkpointed(blocks)
    near = blocks
    for name, step in (("before", 1), ("after", -1)):
        beside = blocks.select("label", "dim", (F.col("cell") + step).alias("cell"), F.col("blocks").alias(name))
        near = near.join(beside, cell, "left")
    near = near.fillna(0, ["before", "after"])
    own = F.pmod(F.xxhash64(F.lit(SEED), "id"), F.col("blocks"))
    dealt = placed.join(near, cell).withColumn("block", own)

    def tiles(count, c1, s1, c2, s2, side):
        each = lambda s: F.struct(
            c1.alias("c1"), s1(s).alias("s1"), c2.alias("c2"), s2(s).alias("s2"), side(s).alias("side")
        )
        return F.when(F.col(count) > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1), each))

    c, b = F.col("cell"), F.col("block")
    nothing = F.expr("CAST(array() AS ARRAY<STRUCT<c1: BIGINT, s1: BIGINT, c2: BIGINT, s2: BIGINT, side: INT>>)")
    every = [
        tiles(
            "blocks", c, lambda s: F.least(s, b), c, lambda s: F.greatest(s, b), lambda s: F.when(b <= s, 0).otherwise(1)
        ),
        tiles("before", c - 1, lambda s: s, c, lambda s: b, lambda s: F.lit(1)),
        tiles("after", c, lambda s: b, c + 1, lambda s: s, lambda s: F.lit(0)),
    ]
    all_tiles = F.concat(*[F.coalesce(t, nothing) for t in every])
    tiled = dealt.select("label", "dim", "id", "copies", "vector", F.explode(all_tiles).alias("tile"))
    tiled = tiled.select("label", "dim", "id", "copies", "vector", "tile.*")

    def compare(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        same = table.column("c1")[0].as_py() == table.column("c2")[0].as_py()
        same = same and table.column("s1")[0].as_py() == table.column("s2")[0].as_py()
        side = table.column("side").to_numpy()
        ids, copies = (table.column(n).to_numpy() for n in ("id", "copies"))
        x = _matrix(table.column("vector"), dim)
        axes = shared.value.get(dim)
        p = _unit(x) if axes is None else _unit(x) @ axes
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        counts, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for a in range(0, len(left), SUB):
            for z in range(a if same else 0, len(right), SUB):
                u, v = left[a : a + SUB], right[z : z + SUB]
                i, j = _linked(x[u], x[v], p[u], p[v], threshold)
                i, j = u[i], v[j]
                if same and a == z:
                    i, j = i[i < j], j[i < j]
                np.add.at(counts, i, copies[j])
                np.add.at(counts, j, copies[i])
                if len(i):
                    low = forest(len(ids), np.concatenate((np.arange(len(ids)), i)), np.concatenate((label, j)))
                    label = low
        met = np.flatnonzero(counts)
        return pa.table({"id": ids[met], "links": counts[met], "root": ids[label[met]]})

    group = ["label", "dim", "c1", "s1", "c2", "s2"]
    found = checkpointed(tiled.groupBy(group).applyInArrow(compare, "id BIGINT, links BIGINT, root BIGINT"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    nodes = (
        distinct.select("label", "vector", "id", "rep", "copies")
        .join(links, "id", "left")
        .join(parts, "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
    )
    lowest = nodes.groupBy("component").agg(F.min("rep").alias("component_id"))
    result = nodes.join(lowest, "component").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    linked = valid.join(result, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

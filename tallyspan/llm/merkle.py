"""A Merkle manifest of a data set: hash trees per source under one root, proofs and their check for every row.

H is lowercase hex SHA-256; a node's children are hashed as their hex text.
Trees are named by their source: "" for null, otherwise "=" and the source, so
that names sort as sources do; "^" is the tree over the sources' own roots.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspan.session import broadcast_if_small, checkpointed, discard, scratch_path, written

# Children of a node.
WIDTH = 16
TOP = "^"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DIGEST_CHARS = 64
# A node's key among all trees.
_OWN = ("own_tree", "own_level", "own_idx")

PROOFS = (
    "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)

_CLIMB = """
WITH RECURSIVE climb (unit_tree, unit, tree, level, idx, folded, siblings, subroot) AS (
    SELECT unit_tree, unit, tree, level, idx, folded, siblings, subroot FROM {start}
    UNION ALL
    SELECT /*+ SHUFFLE_MERGE(n) */ unit_tree, unit, n.parent_tree, n.parent_level, n.parent_idx,
        transform(folded, f -> unhex(sha2(lower(hex(concat(n.before, f, n.after))), 256))),
        concat(siblings, n.before, n.after),
        CASE WHEN n.tree <> n.parent_tree THEN n.digest ELSE subroot END
    FROM climb JOIN {nodes} n ON climb.tree = n.tree AND climb.level = n.level AND climb.idx = n.idx
)
SELECT unit_tree, unit, folded, siblings, coalesce(subroot, {root}) AS subroot FROM climb
WHERE tree = {tree} AND level = {level}
"""


def _field(value: Column) -> Column:
    """A value as its byte count, a colon and itself; null as a dash."""
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, changed): the hash of each row, and that of the row once tampered with, where it is.

    Tampering lower-cases the text's A-Z in rows whose id's crc32, as text, 5 divides.
    """
    names = ("doc_id", "source", "lang", "n_chars")
    head = F.concat(*(_field(F.col(name).cast("string")) for name in names))
    text = F.col("text").cast("string")
    leaf = lambda of: F.sha2(F.concat(head, _field(of)), 256)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        leaf(text).alias("leaf"),
        F.when(tampered, leaf(F.translate(text, _UPPER, _LOWER))).alias("changed"),
    )


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``idx``, their place in their ``tree`` by ``order``, and ``n``, the rows of the tree.

    A range sort deals any tree out over all partitions; each numbers its own
    rows, and the counts of (partition, tree) give the offsets. Equal rows are
    told apart by where they are read.
    """
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in rows.dtypes] + [("part", pa.int32()), ("nth", pa.int64())])

    def number(batches):
        part, tree, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            trees = batch.column("tree")
            codes = trees.dictionary_encode().indices.to_numpy()
            first = np.concatenate(([0], np.flatnonzero(np.diff(codes)) + 1))
            nth = np.arange(batch.num_rows) - np.repeat(first, np.diff([*first, batch.num_rows]))
            if trees[0].as_py() == tree:
                nth[: first[1] if len(first) > 1 else None] += count
            tree, count = trees[-1].as_py(), int(nth[-1]) + 1
            more = [pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(nth, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], schema=schema)

    by = ["tree", *order, "twin"]
    sorted_rows = rows.withColumn("twin", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    names = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    parts = checkpointed(sorted_rows.drop("twin").mapInArrow(number, f"{names}, part int, nth bigint"))
    sizes = parts.groupBy("part", "tree").agg(F.max("nth").alias("last"))
    whole, rows_of = Window.partitionBy("tree"), F.sum(F.col("last") + 1)
    before = rows_of.over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offset = F.coalesce(before, F.lit(0)).alias("offset")
    offsets = checkpointed(sizes.select("part", "tree", offset, rows_of.over(whole).alias("n")))
    joined = parts.join(broadcast_if_small(offsets, offsets.count(), 128), ["part", "tree"])
    return joined.withColumn("idx", F.col("offset") + F.col("nth")).drop("part", "nth", "offset")


def _runs(nodes: DataFrame, level: int, *kept: str) -> DataFrame:
    """Nodes in runs of siblings: tree, level, run, n, members (by idx, with ``kept``) and the parent's digest."""
    member = F.struct("idx", "digest", *kept)
    grouped = nodes.where("n > 1").groupBy("tree", "n", F.expr(f"idx div {WIDTH}").alias("run"))
    runs = grouped.agg(F.array_sort(F.collect_list(member)).alias("members"))
    kids = F.array_join(F.transform("members", lambda m: m["digest"]), "")
    return runs.select("tree", F.lit(level).alias("level"), "run", "n", "members", F.sha2(kids, 256).alias("digest"))


def _parents(runs: DataFrame) -> DataFrame:
    """The nodes one level up."""
    return runs.select(
        "tree",
        F.col("run").alias("idx"),
        F.ceil(F.col("n") / WIDTH).cast("bigint").alias("n"),
        "digest",
        F.col("tree").alias("own_tree"),
        (F.col("level") + 1).alias("own_level"),
        F.col("run").alias("own_idx"),
    )


def _built(spark: SparkSession, nodes: DataFrame, most: int, folder: str, kept=_OWN) -> list[DataFrame]:
    """Write a forest level by level, up to its largest tree's root; the runs of each level."""
    levels: list[DataFrame] = []
    while most > 1:
        path = f"{folder}/{len(levels)}"
        _runs(nodes, len(levels), *kept).write.parquet(path)
        levels.append(spark.read.parquet(path))
        nodes, most, kept = _parents(levels[-1]), -(-most // WIDTH), _OWN
    return levels


def _links(runs: DataFrame) -> DataFrame:
    """One row per node: its key, its digest, its siblings' digests (as bytes) before and after it, its parent's key."""
    digests = F.transform("members", lambda m: m["digest"])
    one = runs.select("*", F.array_join(digests, "").alias("kids"), F.posexplode("members").alias("place", "m"))
    return one.select(
        F.col("m.own_tree").alias("tree"),
        F.col("m.own_level").alias("level"),
        F.col("m.own_idx").alias("idx"),
        F.col("m.digest").alias("digest"),
        F.unhex(F.expr(f"substring(kids, 1, place * {_DIGEST_CHARS})")).alias("before"),
        F.unhex(F.expr(f"substring(kids, (place + 1) * {_DIGEST_CHARS} + 1)")).alias("after"),
        F.col("tree").alias("parent_tree"),
        (F.col("level") + 1).alias("parent_level"),
        F.col("run").alias("parent_idx"),
    )


def _climb(spark: SparkSession, start: DataFrame, nodes: DataFrame, root: str, tree: str, level: int) -> DataFrame:
    """All units' ways to the root, by a recursive query, written.

    Spark ends a recursion at a number of rows unless told otherwise; the
    setting is put back once the query has run.
    """
    setting = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        way = spark.sql(_CLIMB, start=start, nodes=nodes, root=root, tree=tree, level=level)
        return written(way, "climb")[0]
    finally:
        spark.conf.set(setting, before)


def verified_manifest(docs: DataFrame) -> DataFrame:
    """Per row its leaf, subroot, root and proof, and the root recomputed from the tampered row.

    ``docs`` has doc_id, source, lang, n_chars and text, each of which may be
    null; other columns are not hashed. Leaves of a source go by doc_id (null
    first) and, if ids are equal, by leaf; repeated rows are leaves of their own.
    ``proof_sha256`` is H of all siblings on the way up. An empty table gives
    none. Each level is written as rows that name their parents. A recursive
    query takes every leaf from its run to the root, one level a step. The
    leaves of a run travel as one row, since they share all siblings from there
    on, and as one hash if they have the same at that point. Nothing but the
    root and the largest tree's size reaches the driver.
    """
    spark = docs.sparkSession
    hashed, path = written(leaves(docs), "leaves")
    base = checkpointed(numbered(hashed.withColumnRenamed("leaf", "digest"), "doc_id", "digest"))
    discard(spark, path)
    most = base.agg(F.max("n")).first()[0]
    if most is None:
        return spark.createDataFrame([], PROOFS)
    folder = scratch_path(spark, "trees")
    levels = _built(spark, base, most, folder, ("doc_id", "changed"))

    alone = base.where("n = 1")
    roots = [alone.select("tree", "digest", F.lit(0).alias("level"))]
    roots += [r.where(f"n <= {WIDTH}").select("tree", "digest", (F.col("level") + 1).alias("level")) for r in levels]
    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.unionByName(more)
    subroots = subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("own_tree"), "digest", F.col("level").alias("own_level"))
    top = checkpointed(numbered(subroots, "own_tree").withColumn("own_idx", F.lit(0).cast("bigint")))
    sources = top.count()
    upper = _built(spark, top, sources, f"{folder}-top")
    if sources == 1:
        only = top.first()
        root, end, height = only["digest"], only["own_tree"], only["own_level"]
    else:
        root, end, height = upper[-1].first()["digest"], TOP, len(upper)

    linked = None
    for runs in [*levels[1:], *upper]:
        linked = _links(runs) if linked is None else linked.unionByName(_links(runs))
    single = alone.select(
        "tree", F.lit(0).alias("level"), F.lit(0).cast("bigint").alias("idx"),
        F.array(F.struct("idx", "digest", "doc_id", "changed")).alias("members"),
    )
    units = single
    if levels:
        whole = levels[0].select("tree", F.lit(1).alias("level"), F.col("run").alias("idx"), "members")
        units = whole.unionByName(single)
    kids = F.array_join(F.transform("members", lambda m: m["digest"]), "")
    fold = f"""transform(members, (m, i) -> CASE WHEN level = 0 THEN coalesce(m.changed, m.digest) ELSE
        sha2(concat(substring(kids, 1, i * {_DIGEST_CHARS}), coalesce(m.changed, m.digest),
            substring(kids, (i + 1) * {_DIGEST_CHARS} + 1)), 256) END)"""
    units = checkpointed(units.withColumn("kids", kids).withColumn("first", F.expr(fold)))
    start = units.select(
        F.col("tree").alias("unit_tree"), F.col("idx").alias("unit"), "tree", "level", "idx",
        F.transform(F.array_distinct("first"), F.unhex).alias("folded"), F.lit(b"").alias("siblings"), F.lit(None).cast("string").alias("subroot"),
    )
    if linked is None:
        climbed = start.select("unit_tree", "unit", "folded", "siblings", F.lit(root).alias("subroot"))
    else:
        climbed = _climb(spark, start, linked, root, end, height)
    named = units.select(F.col("tree").alias("unit_tree"), F.col("idx").alias("unit"), "members", "kids", "first")
    rows = climbed.join(named, ["unit_tree", "unit"]).select("*", F.posexplode("members").alias("place", "m"))
    siblings = F.concat(
        F.expr(f"substring(kids, 1, place * {_DIGEST_CHARS})"),
        F.expr(f"substring(kids, (place + 1) * {_DIGEST_CHARS} + 1)"),
        F.lower(F.hex("siblings")),
    )
    slot = F.expr("array_position(array_distinct(first), first[place])")
    folded = F.lower(F.hex(F.element_at("folded", slot.cast("int"))))
    return rows.select(
        F.col("m.doc_id").alias("doc_id"),
        F.col("m.digest").alias("leaf"),
        "subroot",
        F.lit(root).alias("root"),
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == root).alias("verified"),
    )

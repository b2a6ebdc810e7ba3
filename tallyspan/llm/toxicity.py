"""Toxicity by two Kneser-Ney language models over bytes, one per class.

Texts are lower-cased words joined by single spaces. The model of a class says
how likely a byte is after the ``ORDER - 1`` bytes before it: the class's own
discounted counts, and for the rest a backoff shared by both classes, built
from continuation counts (in how many different n-grams something occurs, in
either class). An expression that neither class knows therefore gets the same
probability from both.

The two log-likelihoods are compared by their difference, normalised by length:
over the whole text, and over the window of ``WINDOW`` bytes where it is
largest, as a long text may hold one toxic expression. A logistic curve through
these two numbers gives the score; it is fitted on labelled rows that the
counts did not see.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.labelled import fold, sample_rows, unique_labels, with_labels
from tallyspan.llm.texts import SLICE_BYTES, byte_texts, plain_words, slices
from tallyspan.session import broadcast_if_small, checkpointed, discard, written

ORDER = 5
WINDOW = 12
DISCOUNT = 0.75
FOLDS = 5
HELD_OUT = 0  # fold that is never learned from
CURVE = 4  # fold that the logistic curve is fitted on
CURVE_ROWS = 20_000  # most rows for the curve
SHARE_ROWS = 1 << 21  # most n-grams of the model that a task or the driver holds at once
SHARE_SLICES = 8  # slices of text that a task takes together when the model has several shares
_BYTE = np.uint64(8)
_MERGE_ROWS = 1 << 20


def normal(text: bytes) -> bytes:
    """The text that the models read."""
    return b" " + b" ".join(plain_words(text)) + b" "


def grams(text: bytes, order: int) -> np.ndarray:
    """The n-grams of a text as integers."""
    a = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = max(0, len(a) - order + 1)
    out = np.zeros(n, np.uint64)
    for j in range(order):
        out = (out << _BYTE) | a[j : j + n]
    return out


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    unique, at = np.unique(np.concatenate(keys), return_inverse=True)
    return unique, np.bincount(at, np.concatenate(counts), len(unique)).astype(np.int64)


def count_grams(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, toxic, ordinary): how often each n-gram occurs in all labelled texts of either class.

    Tasks add up what they read before the shuffle, holding ``_MERGE_ROWS`` n-grams or one slice of text.
    """

    def task(batches):
        held = [[[], []], [[], []]]

        def flush(y):
            keys, counts = _merged(*held[y]) if held[y][0] else (np.empty(0, np.uint64), np.empty(0, np.int64))
            held[y] = [[], []]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.astype(np.int64)),
                    pa.array(counts * (y == 1)),
                    pa.array(counts * (y == 0)),
                ],
                names=["gram", "toxic", "ordinary"],
            )

        for batch in slices(batches):
            labels = np.array(batch.column("y").to_pylist())
            found = [grams(normal(t), order) for t in byte_texts(batch)]
            for y in (0, 1):
                own = [g for g, label in zip(found, labels, strict=True) if label == y]
                if own:
                    keys, counts = np.unique(np.concatenate(own), return_counts=True)
                    held[y][0].append(keys)
                    held[y][1].append(counts)
                    if sum(map(len, held[y][0])) > _MERGE_ROWS:
                        keys, counts = _merged(*held[y])
                        held[y] = [[keys], [counts]]
                        if len(keys) > _MERGE_ROWS // 2:
                            yield flush(y)
        for y in (0, 1):
            yield flush(y)

    parts = labelled.select("text", "y").mapInArrow(task, "gram BIGINT, toxic BIGINT, ordinary BIGINT")
    return parts.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def weights(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, context, ratio, back) of every n-gram, with the n-grams of one context side by side in one partition.

    ``ratio`` is the n-gram's log-likelihood ratio and ``back`` that of backing
    off from its context. Counts of at most 256 rows meet in one group.
    """
    counts = checkpointed(counts)
    # the shared backoff: continuation counts, themselves smoothed by those of single bytes
    suffix = F.col("gram").bitwiseAND((1 << 8 * (order - 1)) - 1)
    lower = counts.groupBy(suffix.alias("suffix")).agg(F.count(F.lit(1)).alias("n"))
    last = F.col("suffix").bitwiseAND(255)
    single = np.full(256, 0.5)
    for row in lower.groupBy(last.alias("last")).agg(F.sum("n").alias("n")).collect():  # 256 rows at most
        single[row["last"]] += row["n"]
    single = F.get(F.lit((single / single.sum()).tolist()), last.cast("int"))
    middle = Window.partitionBy(F.shiftright("suffix", 8))
    whole, types = F.sum("n").over(middle), F.count(F.lit(1)).over(middle)
    below = (F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) + DISCOUNT * types * single) / whole
    lower = lower.select("suffix", below.alias("below"))

    known = counts.withColumn("suffix", suffix).join(lower, "suffix")
    known = known.withColumn("context", F.shiftright("gram", 8)).repartitionByRange("context")
    own = Window.partitionBy("context")

    def likelihood(name):
        sums, kinds = F.sum(name).over(own), F.sum((F.col(name) > 0).cast("long")).over(own)
        back = F.when(sums > 0, DISCOUNT * kinds / sums).otherwise(1.0)
        direct = F.greatest(F.col(name) - DISCOUNT, F.lit(0.0)) / F.greatest(sums, F.lit(1))
        return (direct + back * F.col("below")).alias(name), back.alias(f"{name}_back")

    fitted = known.select("gram", "context", *likelihood("toxic"), *likelihood("ordinary"))
    ratio, back = F.log(F.col("toxic") / F.col("ordinary")), F.log(F.col("toxic_back") / F.col("ordinary_back"))
    return fitted.select("gram", "context", ratio.alias("ratio"), back.alias("back"))


def _bounds(table: DataFrame, order: int, rows: int) -> list[int]:
    """First contexts of the shares: ranges of at most ``rows`` n-grams, or of one context."""

    def sizes(part, bits):
        found = part.groupBy(F.shiftright("context", bits).alias("at")).count().collect()  # 65,536 rows at most
        return [(r["at"] << bits, r["count"]) for r in found]

    bits = max(0, 8 * (order - 1) - 16)
    starts = []
    for at, n in sizes(table, bits):
        if n > rows and bits:
            starts += sizes(table.where(F.col("context").between(at, at + (1 << bits) - 1)), max(0, bits - 16))
        else:
            starts.append((at, n))
    out, held = [0], 0
    for at, n in sorted(starts):
        if held and held + n > rows:
            out.append(at)
            held = 0
        held += n
    return out


def model_shares(counts: DataFrame, order: int = ORDER, rows: int = SHARE_ROWS) -> Iterator[dict[str, np.ndarray]]:
    """The whole model, cut by context into shares of at most ``rows`` n-grams.

    A share has log-likelihood ratios of its n-grams, and of backing off from
    each of its contexts, as sorted arrays. The driver holds one share at a time.
    """
    spark = counts.sparkSession
    table, path = written(weights(counts, order), "model")
    bounds = _bounds(table, order, rows)
    for low, high in zip(bounds, [*bounds[1:], 1 << 8 * (order - 1)], strict=True):
        part = table.where((F.col("context") >= low) & (F.col("context") < high)).toPandas().sort_values("gram")
        gram, context = part["gram"].to_numpy(np.int64), part["context"].to_numpy(np.int64)
        first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(context) else context
        yield {
            "low": low,
            "high": high,
            "gram": gram,
            "ratio": part["ratio"].to_numpy(np.float64),
            "context": context[first],
            "back": part["back"].to_numpy(np.float64)[first],
        }
    discard(spark, path)


def fit_models(counts: DataFrame, order: int = ORDER, rows: int = SHARE_ROWS) -> dict[str, np.ndarray]:
    """The first share of the model; the whole one if it has at most ``rows`` n-grams."""
    shares = model_shares(counts, order, rows)
    first = next(shares)
    for _ in shares:  # the table is deleted after the last one
        pass
    return first


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys a sorted table has, and where (0 if not)."""
    if not len(table):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    known = table[at] == keys
    return known, np.where(known, at, 0)


def _take(values: np.ndarray, known: np.ndarray, at: np.ndarray, otherwise) -> np.ndarray:
    """What :func:`_found` found, and ``otherwise`` for the rest."""
    out = np.broadcast_to(np.asarray(otherwise, np.float64), known.shape).copy()
    out[known] = values[at[known]]
    return out


def _share(shared):
    """A share sent to the tasks, read anew, so that a worker does not keep all of them."""
    path = getattr(shared, "_path", None)
    return shared.value if path is None else shared.load_from_path(path)


def ratios(shares: list, texts: list[bytes], order: int = ORDER) -> list[np.ndarray]:
    """Per byte of each normal text, by how much the toxic log-likelihood is larger."""
    found = [grams(t, order).astype(np.int64) for t in texts]
    keys, at = np.unique(np.concatenate(found), return_inverse=True)
    out = np.zeros(len(keys))
    for shared in shares:
        model = shared.value if len(shares) == 1 else _share(shared)
        a, b = np.searchsorted(keys, [model["low"] << 8, model["high"] << 8])
        own = keys[a:b]
        back = _take(model["back"], *_found(model["context"], own >> 8), 0.0)
        out[a:b] = _take(model["ratio"], *_found(model["gram"], own), back)
    return np.split(out[at], np.cumsum([len(f) for f in found])[:-1])


def features(steps: np.ndarray) -> tuple[float, float]:
    """The length-normalised difference over the whole text, and over its most toxic window."""
    if not len(steps):
        return 0.0, 0.0
    sums = np.concatenate(([0.0], np.cumsum(steps)))
    window = sums[WINDOW:] - sums[:-WINDOW] if len(steps) > WINDOW else sums[-1:]
    return float(steps.mean()), float(window.max()) / WINDOW


def _design(values: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(values)), 20 * values[:, 0], 4 * values[:, 1]])


def fit_curve(values: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton's method; without rows all weights are 0 and every score is 0.5."""
    x, w = _design(values), np.zeros(3)
    if not len(y):
        return w
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(3), slope)
    return w


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    order: int = ORDER,
    curve_rows: int = CURVE_ROWS,
    share_rows: int = SHARE_ROWS,
) -> DataFrame:
    """doc_id, held_out, score, predicted, ratio and window_ratio of every row of ``docs``.

    Counts come from all labelled texts of folds other than ``HELD_OUT``, except
    the at most ``curve_rows`` of fold ``CURVE`` that the curve is fitted on. Null and empty texts score like a text without evidence. Every
    row gives a row, repeated ones too; a null doc_id is not held out. Without
    labels every score is 0.5. Other columns are ignored. The model has every
    n-gram that was counted; tasks look texts up in one share of it after another.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    known = unique_labels(labels, "toxic").withColumn("fold", fold("doc_id", FOLDS)).where(F.col("fold") != HELD_OUT)
    curve = checkpointed(sample_rows(known.where(F.col("fold") == CURVE).select("doc_id", "y"), curve_rows))
    learned = known.join(broadcast_if_small(curve.select("doc_id"), curve_rows), "doc_id", "left_anti")
    counts = count_grams(with_labels(texts, learned, learned.count()), order)
    send = texts.sparkSession.sparkContext.broadcast
    shares = [send(share) for share in model_shares(counts, order, share_rows)]
    limit = SLICE_BYTES * (1 if len(shares) == 1 else SHARE_SLICES)

    def measure(batches):
        for batch in slices(batches, limit=limit):
            values = ratios(shares, [normal(t) for t in byte_texts(batch)], order)
            values = np.array([features(steps) for steps in values])
            rest = [batch.column(c) for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(values[:, 0]), pa.array(values[:, 1])],
                names=[*(c for c in batch.schema.names if c != "text"), "ratio", "window_ratio"],
            )

    measured = with_labels(texts, curve, curve_rows).select("text", "y")
    points = measured.mapInArrow(measure, "y INT, ratio DOUBLE, window_ratio DOUBLE").toPandas()  # bounded by curve_rows
    weights = fit_curve(points[["ratio", "window_ratio"]].to_numpy(float), points["y"].to_numpy(float)).tolist()

    kind = texts.schema["doc_id"].dataType.simpleString()
    scored = texts.mapInArrow(measure, f"doc_id {kind}, ratio DOUBLE, window_ratio DOUBLE")
    odds = F.lit(weights[0]) + F.lit(20 * weights[1]) * F.col("ratio") + F.lit(4 * weights[2]) * F.col("window_ratio")
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), odds))))
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
        "ratio",
        "window_ratio",
    )

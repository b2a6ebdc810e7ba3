"""A quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Features are n-grams of whole words (1 and 2) and of word shapes (1 to 3),
hashed into ``DIMENSION`` places; a shape keeps punctuation and turns runs of
capitals, of digits and of other letters into one mark each, and a word that
repeats the one before has a shape of its own. Each kind's counts are divided
by their sum. A score is the sparse dot product with the weights.

Training is FTRL-proximal with per-coordinate rates. The sample is dealt out to
``SHARDS`` streams by a hash of the id; in each pass every stream goes on from
the mean state of all streams after the pass before. So results do not depend
on the cluster, and a task holds one state and one document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallyspan.functions.keys import SEED
from tallyspan.llm.labelled import fold, sample_rows, unique_labels, with_labels
from tallyspan.llm.texts import byte_texts, mix, slices, word_hashes
from tallyspan.session import checkpointed

BITS = 18
DIMENSION = 1 << BITS
TRAIN_ROWS = 16_000  # most labelled rows that are trained on
SHARDS = 8
PASSES = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
FOLDS = 4
HELD_OUT = 2  # fold that is never learned from
THRESHOLD = 0.7
_PLAIN = bytes(range(256))
# capitals, digits and other letters each to one mark; any other byte stays
_SHAPE = bytes(65 if 65 <= b <= 90 else 57 if 48 <= b <= 57 else 97 if 97 <= b <= 122 or b > 127 else b for b in range(256))
_KINDS = 5


def _shape(text: bytes) -> bytes:
    """The text with every run of one mark cut to a single one."""
    a = np.frombuffer(text.translate(_SHAPE), np.uint8)
    return a[np.concatenate(([True], a[1:] != a[:-1]))].tobytes() if len(a) else b""


def features(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text, the places of its n-grams and their values; a place may come more than once."""
    words, at = word_hashes(texts, _PLAIN)
    shapes, shape_at = word_hashes([_shape(t) for t in texts], _PLAIN)
    if len(shapes) != len(words):  # runs of white space shrink, words do not vanish
        raise AssertionError("words and their shapes must pair up")
    if len(words):
        again = np.concatenate(([False], words[1:] == words[:-1]))
        again[at[:-1][at[:-1] < len(words)]] = False
        shapes = np.where(again, shapes ^ np.uint64(0x9E37), shapes)
    out = []
    drop, prime = np.uint64(64 - BITS), np.uint64(0x9E3779B97F4A7C15)
    for i in range(len(texts)):
        w, s = words[at[i] : at[i + 1]], shapes[shape_at[i] : shape_at[i + 1]]
        pairs = s[:-1] * prime + s[1:]
        kinds = [w, w[:-1] * prime + w[1:], s, pairs, pairs[:-1] * prime + s[2:]]
        places = [(mix(k + np.uint64(n + 1)) >> drop).astype(np.int64) for n, k in enumerate(kinds) if len(k)]
        values = [np.full(len(k), 1.0 / len(k)) for k in kinds if len(k)]
        if places:
            out.append((np.concatenate(places), np.concatenate(values)))
        else:
            out.append((np.empty(0, np.int64), np.empty(0)))
    return out


class _State:
    """Sums of gradients (z) and of their squares (n); the last place is the intercept."""

    def __init__(self, z=None, n=None):
        self.z = np.zeros(DIMENSION + 1) if z is None else z
        self.n = np.zeros(DIMENSION + 1) if n is None else n

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, places: np.ndarray, values: np.ndarray, y: int) -> None:
        at, inverse = np.unique(np.append(places, DIMENSION), return_inverse=True)
        x = np.bincount(inverse, np.append(values * _KINDS, 1.0))
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def train(labelled: DataFrame, passes: int = PASSES) -> np.ndarray:
    """The weights learned from (doc_id, text, y); the intercept stands last."""
    context = labelled.sparkSession.sparkContext
    order = F.xxhash64(F.lit(SEED + 1), "doc_id")
    dealt = labelled.select("text", "y", order.alias("turn")).repartition(SHARDS, F.pmod("turn", F.lit(SHARDS)))
    dealt = checkpointed(dealt.sortWithinPartitions("turn", "text"))
    state = _State()
    for _ in range(passes):
        shared = context.broadcast((state.z.astype(np.float32), state.n.astype(np.float32)))

        def task(batches, shared=shared):
            own, rows = _State(*(a.astype(np.float64) for a in shared.value)), 0
            for batch in slices(batches):
                found = features(byte_texts(batch))
                for (places, values), y in zip(found, batch.column("y").to_pylist(), strict=True):
                    own.learn(places, values, y)
                    rows += 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a.astype(np.float32).tobytes()], pa.binary()) for a in (own.z, own.n)], names=["z", "n"]
                )

        ends = dealt.select("text", "y").mapInArrow(task, "z BINARY, n BINARY").collect()  # SHARDS states of 2 MB
        shared.unpersist()
        if not ends:
            break
        z, n = (np.mean([np.frombuffer(e[c], np.float32) for e in ends], 0, np.float64) for c in ("z", "n"))
        state = _State(z, n)
    return state.weights(slice(None))


def with_quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, passes: int = PASSES) -> DataFrame:
    """All rows and columns of ``docs`` with their ``score``; a column of that name is replaced.

    Trained on at most ``train_rows`` labelled rows outside fold ``HELD_OUT``,
    the first by a hash of their id. A null or empty text has no features and
    scores by the intercept. Every row gives a row, repeated ones too. Without
    labels every score is 0.5.
    """
    docs = docs.drop("score").withColumn("text", F.col("text").cast("string"))
    known = unique_labels(labels, "quality").where(fold("doc_id", FOLDS) != HELD_OUT)
    sample = sample_rows(known, train_rows)
    shared = docs.sparkSession.sparkContext.broadcast(train(with_labels(docs, sample, train_rows), passes))

    def task(batches):
        w = shared.value
        for batch in slices(batches):
            found = features(byte_texts(batch))
            odds = np.array([w[-1] + _KINDS * (w[places] @ values) for places, values in found])
            scores = pa.array(1 / (1 + np.exp(-np.clip(odds, -30, 30))))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, "score"])

    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])
    return docs.mapInArrow(task, schema)


def score_quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, passes: int = PASSES) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``, as in :func:`with_quality`.

    A null doc_id is not held out. Other columns are ignored.
    """
    return with_quality(docs.select("doc_id", "text"), labels, train_rows, passes).select(
        "doc_id",
        F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

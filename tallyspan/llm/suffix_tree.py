"""Language-model scores of texts from a probabilistic suffix tree over words.

The tree's states are contexts of up to ``depth`` words. A word's probability
comes from the longest state that the words before it end in: the state's
counts, smoothed with ``PRIOR`` occurrences spread as the next shorter state
has them, down to the counts of single words. A context of at least ``least``
occurrences below a state is a state itself if its next words diverge from that
state's: told without the occurrence in question, it has to predict its next
words better by more than ``GAIN`` bits each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.labelled import fold
from tallyspan.llm.texts import SPACED, byte_texts, mix, slices
from tallyspan.session import discard, scratch_path, written

DEPTH = 3
LEAST = 16
PRIOR = 100.0
GAIN = 0.05
ADDED = 0.1

# Text bytes of a block of documents, the unit that is counted and looked up at once.
BLOCK_BYTES = 6 << 20
# Tokens of the corpus for each bucket of words or contexts.
BUCKET_TOKENS = 1 << 20
# A context with more occurrences is dealt out over several buckets by its next words.
SPLIT = 1 << 22
# Blocks read by a task, and bytes of a row of a block: rows of megabytes would fill an executor's heap.
TOGETHER = 4
PART_BYTES = 1 << 18
# Bytes of rows that go to a task's Python side at once.
BATCH_BYTES = 8 << 20

# Parts of blocks have level -1; answers the level and the bucket they come from, their sums block -1.
ROWS = "block bigint, level int, part int, payload binary, total bigint, kinds bigint, most bigint"
MESSAGES = "bucket int, block bigint, payload binary"
_SPACES = b" \t\n\x0b\x0c\r"
_BLANK = bytes(32 if byte in _SPACES else 0 for byte in range(256))
FIELDS = ("row", "doc_id", "no_id", "held_out", "skip", "length", "tokens", "counts", "words")
SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def _packed(*arrays) -> bytes:
    """Arrays of whole numbers, each in as few bytes a number as its largest needs."""
    out = []
    for a in arrays:
        a = np.asarray(a)
        most = int(a.max()) if len(a) else 0
        size = next(s for s in (1, 2, 4, 8) if most < 1 << (8 * s))
        out += [size.to_bytes(1, "little"), len(a).to_bytes(8, "little"), a.astype(f"<u{size}").tobytes()]
    return b"".join(out)


def _unpacked(blob: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(blob):
        size, n = blob[at], int.from_bytes(blob[at + 1 : at + 9], "little")
        out.append(np.frombuffer(blob, f"<u{size}", n, at + 9).astype(np.int64))
        at += 9 + size * n
    return out


def _long_text(text: bytes, size: int, depth: int) -> Iterator[tuple[list[bytes], bytes, bool]]:
    """A text in parts of about ``size`` bytes that end between words: (words before, part, is last)."""
    start, before = 0, []
    while True:
        end = min(start + size, len(text))
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        part = text[start:end]
        yield before, part, end == len(text)
        if end == len(text):
            return
        before = [*before, *part.translate(SPACED).split()[-depth:]][-depth:]
        start = end


def _lines(words: pa.Array) -> bytes:
    """The words with line feeds between them."""
    whole = pa.LargeListArray.from_arrays(pa.array([0, len(words)], pa.int64()), words)
    return pc.binary_join(whole, pa.scalar(b"\n", words.type))[0].as_py()


def _block(number: int, entries: list[tuple]) -> Iterator[dict]:
    """The rows of a block of (row, doc_id, held_out, words before, text, is last).

    Tokens are numbers of the block's own words, of which 0 is the end of a
    text. Words before a part are tokens to look back on only.
    """
    texts = [b" ".join([*before, text]) for *_, before, text, _ in entries]
    joined = b" ".join(texts).translate(SPACED) + b" "
    space = np.frombuffer(b" " + joined.translate(_BLANK), np.uint8)
    edges = np.flatnonzero(space[1:] != space[:-1])  # a word's start and its end, in turn
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    letters = joined.translate(None, _SPACES)
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = found.dictionary_encode()
    bounds = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    last = np.array([e[5] for e in entries], bool)
    tokens = np.insert(coded.indices.to_numpy().astype(np.int64) + 1, bounds[1:][last], 0)
    length = np.diff(bounds) + last
    skip = np.array([len(e[3]) for e in entries])
    trained = np.repeat(np.array([not e[2] for e in entries], bool), length) & ~_looked_back(length, skip)
    lines = b"\n" + _lines(coded.dictionary)
    words = lines.split(b"\n")
    ids = np.array([e[1] or 0 for e in entries], np.int64).view(np.uint64)
    fields = {
        "row": [e[0] for e in entries],
        "doc_id": ids,
        "no_id": [e[1] is None for e in entries],
        "held_out": [e[2] for e in entries],
        "skip": skip,
        "length": length,
        "tokens": tokens,
        "counts": np.bincount(tokens[trained], minlength=len(words)),
        "words": np.frombuffer(lines, np.uint8),
    }
    blob = _packed(*(fields[name] for name in FIELDS))
    for part, at in enumerate(range(0, len(blob), PART_BYTES)):
        n = int((length - skip).sum()) if part == 0 else 0
        yield {"block": number, "level": -1, "part": part, "payload": blob[at : at + PART_BYTES], "total": n}


def _read_block(batches) -> dict:
    """A block's fields and ``answers`` by level and bucket, from its rows in any order."""
    parts, answers = {}, {}
    for batch in batches:
        names = ("block", "level", "part", "payload")
        for block, level, part, payload in zip(*(batch.column(name).to_pylist() for name in names), strict=True):
            if level < 0:
                parts[part] = payload
            else:
                answers.setdefault(level, {})[part] = payload
    fields = dict(zip(FIELDS, _unpacked(b"".join(parts[i] for i in range(len(parts)))), strict=True))
    words = fields["words"].astype(np.uint8).tobytes().split(b"\n")
    crc = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
    return fields | {"block": block, "answers": answers, "words": words, "crc": crc}


def _looked_back(length: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """Which tokens of a block only serve as words before a part."""
    starts = np.cumsum(length) - length
    nth = np.arange(int(length.sum())) - np.repeat(starts, length)
    return nth < np.repeat(skip, length)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in schema.split(", "))])


def _batches(rows, schema: str) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of a bounded number of payload bytes."""
    kinds, held, size = _arrow(schema), [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row.values() if isinstance(v, bytes)) + 100
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=kinds)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=kinds)


def _blocks(docs: DataFrame, block_bytes: int, depth: int) -> DataFrame:
    """The documents in blocks of about ``block_bytes`` bytes; a longer text is cut into blocks of its own."""

    def cut(batches):
        task, row, block = TaskContext.get().partitionId(), 0, 0

        def blocks():
            nonlocal row, block
            for batch in slices(batches, limit=block_bytes):
                entries = []
                for doc_id, held, text in zip(
                    batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), byte_texts(batch), strict=True
                ):
                    number = (task << 40) + row
                    row += 1
                    for before, part, last in _long_text(text, block_bytes, depth):
                        if entries and (before or not last):
                            yield from _block((task << 40) + block, entries)
                            entries, block = [], block + 1
                        entries.append((number, doc_id, held, before, part, last))
                if entries:
                    yield from _block((task << 40) + block, entries)
                    block += 1

        yield from _batches(blocks(), ROWS)

    held_out = F.coalesce(fold("doc_id", 10) == 0, F.lit(False)).alias("held_out")
    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out)
    return kept.mapInArrow(cut, ROWS)


class _Settings:
    """What the tasks have to know; plain values only."""

    def __init__(self, **values):
        self.__dict__.update(values)


def _requests(row: dict, given, level: int, only_split: bool = False) -> Iterator[dict]:
    """A block's messages of a level, one for each bucket that holds any of its words or pairs."""
    if level == 0:
        words = pa.array(row["words"], pa.large_binary())
        counts = row["counts"]
        where = row["crc"] % given.buckets
        for bucket, chosen in _by_bucket(where, _stable(where, given.buckets)):
            text = np.frombuffer(_lines(words.take(pa.array(chosen))), np.uint8)
            yield {"bucket": bucket, "block": row["block"], "payload": _packed(counts[chosen], text)}
        return
    state = _state(row, given, level - 1)
    pairs = _pairs(state, given)
    split = pairs["n"] > given.split
    trained = ~np.repeat(row["held_out"].astype(bool), row["length"]) & ~state["back"]
    count = np.bincount(pairs["back"][trained[pairs["tried"]]], minlength=len(split))
    code = np.minimum(np.round(-64 * np.log2(state["p"][pairs["at"]])), 65535)
    for bucket, chosen in _by_bucket(pairs["where"], pairs["order"]):
        if only_split:
            chosen = chosen[split[chosen]]
            if not len(chosen):
                continue
        context = pairs["context"][chosen]
        first = np.flatnonzero(np.diff(context, prepend=-1))
        sizes = np.diff([*first, len(chosen)])
        n, symbol = pairs["n"][chosen][first], pairs["symbol"][chosen]
        payload = _packed(context[first], sizes, n, symbol, count[chosen], code[chosen])
        yield {"bucket": bucket, "block": row["block"], "payload": payload}


def _unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, a place of each, and the number of the key at each place."""
    shift = len(keys).bit_length()
    if len(keys) and int(keys.max()) < 1 << (63 - shift):  # key and place fit one number, which sorts at once
        dealt = np.sort(keys << shift | np.arange(len(keys)))
        order = dealt & ((1 << shift) - 1)
        dealt >>= shift
    else:
        order = np.argsort(keys)
        dealt = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(dealt[1:], dealt[:-1], out=new[1:])
    back = np.empty(len(keys), np.int64)
    back[order] = np.cumsum(new) - 1
    return dealt[new], order[new], back


def _stable(where: np.ndarray, buckets: int) -> np.ndarray:
    """The stable order of bucket numbers, which NumPy finds by counting if they are short."""
    return np.argsort(where.astype(np.uint16) if buckets <= 1 << 16 else where, kind="stable")


def _by_bucket(where: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions) of everything, in the order of buckets."""
    dealt = where[order]
    edges = np.flatnonzero(np.diff(dealt, prepend=-1, append=-1))
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        yield int(dealt[start]), order[start:end]


def _pairs(state: dict, given) -> dict:
    """The different (context, next word) of the positions that have a context to try, with their buckets."""
    tried = np.flatnonzero(state["tried"])
    tokens = state["tokens"][tried]
    width = len(state["ids"])
    keys, first, back = _unique(state["code"][tried] * width + tokens)
    at = tried[first]
    context, n, symbol = state["context"][at], state["n"][at], state["ids"][tokens[first]]
    spread = np.zeros(1, np.uint64)
    if len(n) and n.max() > given.split:
        shares = -(-n // given.split)
        spread = np.where(shares > 1, 1 + symbol % np.maximum(shares, 1), 0).astype(np.uint64)
    where = (mix(context.astype(np.uint64) ^ mix(spread)) % np.uint64(given.buckets)).astype(np.int64)
    return {
        "tried": tried,
        "back": back,
        "context": context,
        "n": n,
        "symbol": symbol,
        "at": at,
        "where": where,
        "order": _stable(where, given.buckets),
    }


def _state(row: dict, given, level: int, depth: int | None = None) -> dict:
    """A block's tokens, probabilities and next contexts to try, once the answers up to ``level`` are in.

    Beyond a level ``depth`` no contexts are tried.
    """
    tokens, length, where = row["tokens"], row["length"], row["crc"] % given.buckets
    back = _looked_back(length, row["skip"])
    answers = row["answers"][0]
    ids, counts = np.zeros(len(where), np.int64), np.zeros(len(where), np.int64)
    for bucket, chosen in _by_bucket(where, _stable(where, given.buckets)):
        ids[chosen], counts[chosen] = _unpacked(answers[bucket])
    begins = np.zeros(len(tokens) + 1, bool)
    begins[np.cumsum(length) - length] = True
    begins = begins[:-1]
    base = (counts + ADDED) / (given.total + ADDED * (given.kinds + 1))
    before = np.concatenate(([0], tokens[:-1])) if len(tokens) else tokens
    state = {
        "tokens": tokens,
        "ids": ids,
        "back": back,
        "known": counts > 0,
        "base": base,
        "p": base[tokens],
        "code": before,
        "context": ids[before],
        "n": counts[before],
        "tried": ~begins & (counts[before] >= given.least),
    }
    for k in range(1, level + 1):
        pairs = _pairs(state, given)
        answers = row["answers"].get(k, {})
        total, name = np.zeros((2, len(pairs["n"])), np.int64)
        kept = np.zeros(len(total), bool)
        for bucket, chosen in _by_bucket(pairs["where"], pairs["order"]):
            bits, totals, names = _unpacked(answers[bucket])
            runs = np.cumsum(np.diff(pairs["context"][chosen], prepend=-1) != 0) - 1
            kept[chosen] = np.unpackbits(bits.astype(np.uint8)).view(bool)[runs]
            total[chosen] = totals
            name[chosen[totals >= given.least]] = names
        tried, back = pairs["tried"], pairs["back"]
        holds = kept[back]
        held, pair = tried[holds], back[holds]
        state["p"][held] = (total[pair] + given.prior * state["p"][held]) / (state["n"][held] + given.prior)
        if k == depth:
            break
        below = np.zeros(len(tokens) + 1, bool)
        below[held] = True
        below[:-1] &= ~begins
        use = below[tried + 1]
        follows, pair = tried[use] + 1, back[use]
        use = (total >= given.least)[pair]
        follows, pair = follows[use], pair[use]
        state["tried"] = np.zeros(len(tokens), bool)
        state["tried"][follows] = True
        for field, values in (("code", pair), ("context", name[pair]), ("n", total[pair])):
            state[field] = np.zeros(len(tokens), np.int64)
            state[field][follows] = values
    return state


def _answer_words(messages: list[tuple[int, bytes]], bucket: int, given) -> Iterator[dict]:
    """Ids and counts of a bucket's words, as asked by each block; and their sums."""
    asked = [_unpacked(payload) for _, payload in messages]
    lists = [text.astype(np.uint8).tobytes().split(b"\n") for _, text in asked]
    coded = pa.array([w for words in lists for w in words], pa.binary()).dictionary_encode().indices.to_numpy()
    totals = np.bincount(coded, np.concatenate([counts for counts, _ in asked])).astype(np.int64)
    at = 0
    for (block, _), words in zip(messages, lists, strict=True):
        own = coded[at : at + len(words)].astype(np.int64)
        at += len(words)
        yield {"part": bucket, "level": 0, "block": block, "payload": _packed(own * given.buckets + bucket, totals[own])}
    sums = {"total": int(totals.sum()), "kinds": int((totals > 0).sum()), "most": int(totals.max())}
    yield {"part": bucket, "level": 0, "block": -1, "payload": b"", **sums}


def _answer_pairs(messages: list, bucket: int, level: int, given, decided: dict | None) -> Iterator[dict]:
    """Which of a bucket's contexts are states, and counts and names of their pairs, as asked by each block.

    ``decided`` holds the contexts that several buckets share; None asks for
    this bucket's part of what decides about each context instead.
    """
    asked = [_unpacked(payload) for _, payload in messages]
    blocks = [(block, len(a[0]), len(a[3])) for (block, _), a in zip(messages, asked, strict=True)]
    run_context, run_size, run_n, symbol, count, bits = (np.concatenate(parts) for parts in zip(*asked, strict=True))
    del asked, messages
    contexts, first, run_code = _unique(run_context)
    n = run_n[first]
    width = int(symbol.max()) + 1
    if len(contexts) * width >= 1 << 63:  # then by their numbers in this bucket
        symbol = np.unique(symbol, return_inverse=True)[1]
        width = int(symbol.max()) + 1
    keys, first, back = _unique(np.repeat(run_code, run_size) * width + symbol)
    del symbol
    total = np.bincount(back, count, len(keys)).astype(np.int64)
    owner = keys // width
    seen = total > 0
    told, parent, of = total[seen], -bits[first[seen]] / 64, n[owner[seen]]
    without = (told - 1 + given.prior * np.exp2(parent)) / (of - 1 + given.prior)
    gain = np.bincount(owner[seen], told * (np.log2(without) - parent), len(contexts))
    if decided is None:
        for context, occurrences, value in zip(contexts.tolist(), n.tolist(), gain.tolist(), strict=True):
            yield {"context": context, "n": occurrences, "gain": value}
        return
    state = gain > given.gain * n
    for i in np.flatnonzero(n > given.split):
        state[i] = decided[int(contexts[i])]
    common = total >= given.least
    name = (np.cumsum(common) - 1) * given.buckets + bucket
    total = np.where(common | state[owner], total, 0)
    run, pair = 0, 0
    for block, sizes, entries in blocks:
        own, states = back[pair : pair + entries], state[run_code[run : run + sizes]]
        run, pair = run + sizes, pair + entries
        payload = _packed(np.packbits(states), total[own], name[own[common[own]]])
        yield {"part": bucket, "level": level, "block": block, "payload": payload}
    most = int(total[common].max()) if common.any() else 0
    yield {"part": bucket, "level": level, "block": -1, "payload": b"", "most": most}


def _buckets(batches) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """(bucket, messages by block) from messages that come bucket by bucket."""
    now, held = None, []
    for batch in batches:
        for bucket, block, payload in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if bucket != now and held:
                yield now, held
                held = []
            now = bucket
            held.append((block, payload))
    if held:
        yield now, held


@contextmanager
def _bounded_batches(spark, size: int):
    """Blocks are rows of megabytes; the session's own bound on Arrow batches is put back afterwards."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(min(size, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before))))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


class _Table:
    """A table of rows bucketed by block, so that a block's rows are read together without a shuffle."""

    def __init__(self, spark, shares: int):
        self.spark, self.shares = spark, shares
        self.path = scratch_path(spark, "exchange")
        self.name = "tallyspan_" + self.path.split("/")[-2].split("-")[-1]

    def add(self, rows: DataFrame) -> None:
        dealt = rows.repartition(self.shares, "block").write.bucketBy(self.shares, "block").mode("append")
        dealt.option("compression", "zstd").option("path", self.path).saveAsTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def by_block(self, task, schema: str) -> DataFrame:
        """What ``task`` makes of the record batches of each block."""
        return self.rows().where("block >= 0").select("block", "level", "part", "payload").groupBy("block").applyInArrow(task, schema)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        discard(self.spark, self.path)


def score_texts(
    docs: DataFrame, depth: int = DEPTH, least: int = LEAST, prior: float = PRIOR, gain: float = GAIN,
    block_bytes: int = BLOCK_BYTES, bucket_tokens: int = BUCKET_TOKENS, split: int = SPLIT,
) -> DataFrame:
    """Per row of ``docs`` its log10 probability by the tree and by single words; see the module.

    Learns from the rows whose id's crc32, as text, 10 does not divide (a null
    id is learned from). Words are lower-cased in A-Z and cut at white space; a
    text ends in an end token; a null text is an empty one. Equal rows and ids
    are scored each. Other columns are not used. An empty table gives none.

    Documents go into blocks, written once. A level of the tree is one exchange:
    blocks send their different pairs of context and next word with counts to
    the pairs' buckets; buckets add them up, test the contexts and send back what
    the blocks' positions need for scores and for the contexts of the next level.
    No task holds more than a block or a bucket, whose number grows with the
    corpus; frequent contexts are dealt out over buckets. The driver receives
    sums, and a row for each context with over ``split`` occurrences.
    """
    with _bounded_batches(docs.sparkSession, BATCH_BYTES):
        return _scored(docs, depth, least, prior, gain, block_bytes, bucket_tokens, split)


def _scored(docs: DataFrame, depth, least, prior, gain, block_bytes, bucket_tokens, split) -> DataFrame:
    spark = docs.sparkSession
    found, path = written(_blocks(docs, block_bytes, depth), "blocks")
    blocks, tokens = found.agg(F.count_if(F.col("part") == 0), F.sum("total")).first()
    table = _Table(spark, max(1, -(-blocks // TOGETHER)))
    table.add(found)
    discard(spark, path)
    buckets = max(1, -(-(tokens or 0) // bucket_tokens))
    given = {"buckets": buckets, "least": least, "prior": prior, "gain": gain, "split": split, "total": 0, "kinds": 0}

    def exchange(level: int, decided: dict | None, schema: str) -> DataFrame:
        settings = dict(given)

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked = _requests(_read_block(batches), _Settings(**settings), level, decided is None)
            yield from _batches(asked, MESSAGES)

        def answer(batches):
            now = _Settings(**settings)

            def rows():
                for bucket, messages in _buckets(batches):
                    if level == 0:
                        yield from _answer_words(messages, bucket, now)
                    else:
                        yield from _answer_pairs(messages, bucket, level, now, decided)

            yield from _batches(rows(), schema)

        sent = table.by_block(ask, MESSAGES)
        return sent.repartition(buckets, "bucket").sortWithinPartitions("bucket", "block").mapInArrow(answer, schema)

    most = 0
    for level in range(depth + 1):
        decided = {}
        if level and most > split:
            parts = exchange(level, None, "context bigint, n bigint, gain double").groupBy("context")
            for context, n, value in parts.agg(F.first("n"), F.sum("gain")).collect():
                decided[context] = value > gain * n
        table.add(exchange(level, decided, ROWS))
        told = table.rows().where(f"block < 0 AND level = {level}").agg(F.sum("total"), F.sum("kinds"), F.max("most")).first()
        if level == 0:
            given |= {"total": told[0] or 0, "kinds": told[1] or 0}
        most = told[2] or 0

    settings = dict(given)
    partial = f"row bigint, {SCORES.replace('train_tokens bigint, ', '')}"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = _read_block(batches)
        state = _state(row, _Settings(**settings), depth, depth)
        use, n = ~state["back"], len(row["length"])
        entry, tokens = np.repeat(np.arange(n), row["length"])[use], state["tokens"][use]
        columns = [
            pa.array(row["row"]),
            pa.array(row["doc_id"], mask=row["no_id"].astype(bool)),
            pa.array(row["held_out"].astype(bool)),
            pa.array(np.bincount(entry, minlength=n)),
            pa.array(np.bincount(entry, state["known"][tokens], n).astype(np.int64)),
            pa.array(np.bincount(entry, np.log10(state["base"])[tokens], n)),
            pa.array(np.bincount(entry, np.log10(state["p"][use]), n)),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=_arrow(partial))

    whole = table.by_block(score, partial).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("held_out").alias("held_out"),
        *(F.sum(name).alias(name) for name in ("n_tokens", "n_known", "base_score", "score")),
    )
    scored = whole.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(given["total"]).cast("bigint").alias("train_tokens"),
        "base_score", "score",
    )
    result = written(scored, "scores")[0]
    table.drop()
    return result

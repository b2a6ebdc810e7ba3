"""Texts inside Arrow tasks: bounded slices of batches, words, and word and shingle hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text bytes that one step of a vectorised task works on; a longer single text is a step of its own.
SLICE_BYTES = 1 << 20

# Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z: digits, a-z and all bytes above 127.
ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
# Words [^\x20\x09-\x0D]+ after lower-casing A-Z; bytes.split() cuts at these six bytes.
SPACED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def plain_words(text: bytes) -> list[bytes]:
    """The lower-cased words of ASCII letters and digits and of anything beyond ASCII."""
    return text.translate(ALNUM).split()


def free_names(taken: list[str], *names: str) -> list[str]:
    """The names, each with underscores at its end until no column has it in upper or lower case."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def slices(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows with at most ``limit`` bytes of text each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = size = 0
        for row, n in enumerate(lengths):
            if row > start and size + n > limit:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += n
        yield batch.slice(start)


def byte_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes, null as empty."""
    return [t if t is not None else b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


_P = 0x5851F42D4C957F2D  # odd, so that its powers can be divided out
_Q = 0x2545F4914F6CDD1D
_INVERSE = pow(_P, -1, 1 << 64)
BYTE_VALUES = seeded(256, 7)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


def word_hashes(texts: list[bytes], table: bytes = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, and each text's offset into them (one more at the end).

    A word's hash is a polynomial over its bytes, taken from one running sum over all texts.
    """
    joined = np.frombuffer(b" ".join(texts).translate(table) + b" ", np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    space = (joined == 32) | ((joined >= 9) & (joined <= 13))
    edge = np.diff(np.concatenate(([1], space.view(np.int8))))
    starts = np.flatnonzero(edge == -1)
    ends = np.flatnonzero(edge == 1)
    n = len(joined)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUES[joined] * powers(_P, n), out=sums[1:])
    inverse = powers(_INVERSE, n)
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, bounds)


def shingle_sets(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """Each text's distinct hashed shingles of ``size`` words, ascending.

    A text of fewer words, but at least one, has one shingle of all its words;
    a text without words has none. Words are those of ``SPACED``.
    """
    hashes, at = word_hashes(texts)
    scale = powers(_Q, size)
    n = max(0, len(hashes) - size + 1)
    rolled = np.zeros(n, np.uint64)
    for j in range(size):
        rolled += hashes[j : j + n] * scale[j]
    rolled = mix(rolled)
    out = []
    for i in range(len(texts)):
        a, b = at[i], at[i + 1]
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            short = (hashes[a:b] * scale[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out

"""Pair lines: a number, a space and a class name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.text import split_tokens

FAILFAST = "FAILFAST"
DROPMALFORMED = "DROPMALFORMED"


def check_mode(mode: str) -> str:
    if mode not in (FAILFAST, DROPMALFORMED):
        raise ValueError(f"mode is {FAILFAST} or {DROPMALFORMED}, not {mode!r}")
    return mode


def decode_pairs(lines: DataFrame, mode: str = FAILFAST, value: str = "value") -> DataFrame:
    """``(i BIGINT, gamma STRING)`` from lines; further tokens are ignored.

    A line without a number and a class raises an error when it is read, or is
    left out with ``mode="DROPMALFORMED"``. Neither depends on the session's
    ANSI setting.
    """
    check_mode(mode)
    tokens = split_tokens(value)
    i = F.get(tokens, F.lit(0)).try_cast("bigint")
    gamma = F.get(tokens, F.lit(1))
    if mode == DROPMALFORMED:
        decoded = lines.select(i.alias("i"), gamma.alias("gamma"))
        return decoded.filter(F.col("i").isNotNull() & F.col("gamma").isNotNull())
    bad = F.raise_error(F.concat(F.lit("not a pair line: "), F.col(value)))
    return lines.select(
        F.coalesce(i, bad.cast("bigint")).alias("i"),
        F.coalesce(gamma, bad.cast("string")).alias("gamma"),
    )


def encode_pairs(i: Column | str, gamma: Column | str) -> Column:
    """The line of a pair, the inverse of :func:`decode_pairs`."""
    i = F.col(i) if isinstance(i, str) else i
    return F.concat_ws(" ", i.cast("string"), gamma)

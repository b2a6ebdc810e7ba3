"""Splitting text into tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_tokens(text: Column | str, separator: str = " ") -> Column:
    """Split on one separator character, without the empty tokens at the end.

    Empty tokens at the start and in the middle stay; the empty text is one
    empty token, and a text of separators only has none. Other white space
    than the separator does not split. Any character can separate.
    """
    if len(separator) != 1:
        raise ValueError("a separator is one character")
    text = F.col(text) if isinstance(text, str) else text
    trimmed = F.rtrim(text, F.lit(separator))
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, f"\\Q{separator}\\E"))
    )

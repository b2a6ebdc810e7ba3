"""Key columns: partition keys, salts and the seeded random order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the seed of every seeded draw.
SEED = 1238364


def partition_key(key: Column | str, parts: int, signed: bool = False) -> Column:
    """Key modulo ``parts``: exactly ``parts`` groups, or the signed remainder."""
    key = F.col(key) if isinstance(key, str) else key
    return key % F.lit(parts) if signed else F.pmod(key, F.lit(parts))


def salt(key: Column | str, salts: int) -> Column:
    """A salt in [0, salts) that a retried task computes again unchanged."""
    return F.pmod(F.xxhash64(key), F.lit(salts))


def random_order(key: Column | str, seed: int = SEED) -> Column:
    """Seeded random sort key: the first 60 bits of md5("seed:key") as a BIGINT.

    Being a number it fits in fixed-width aggregate and Arrow buffers. Equal
    values are broken by the key itself wherever this order is used.
    """
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")

"""Surrogate ids by digest (U4).

md5 / sha1 / sha2 / xxhash64 / crc32 are Spark built-ins and stay inside
whole-stage codegen. md4 has no built-in: it runs as an Arrow-batched pandas
UDF over the numpy implementation in :mod:`.md4`. A digest is computed per
row where the row is, so attaching an id needs neither a distinct nor a
join, and skewed (repeated) keys cost nothing extra.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .columns import _c
from ..session import ship_package
from .md4 import md4_hex

DIGESTS = ("md4", "md5", "sha1", "sha224", "sha256", "sha384", "sha512", "xxhash64", "crc32")


@F.pandas_udf(StringType())
def md4_hex_udf(values: pd.Series) -> pd.Series:
    return pd.Series(md4_hex(values.tolist()), index=values.index, dtype=object)


def digest(col: str | Column, algo: str = "md5") -> Column:
    """Digest of a text (UTF-8 bytes) or binary column; null stays null."""
    c = _c(col)
    a = algo.lower()
    if a == "md5":
        return F.md5(c)
    if a == "sha1":
        return F.sha1(c)
    if a.startswith("sha") and a[3:] in ("224", "256", "384", "512"):
        return F.sha2(c, int(a[3:]))
    if a == "xxhash64":
        return F.xxhash64(c)
    if a == "crc32":
        return F.crc32(c)
    if a == "md4":
        ship_package()  # the UDF runs in the executors' Python workers
        return md4_hex_udf(c)
    raise ValueError(f"unknown digest {algo!r}; choose from {DIGESTS}")


def surrogate_id(col: str | Column, algo: str = "md4", default: str = "UNKNOWN_HASH") -> Column:
    """Digest used as a NOT NULL surrogate key: null or empty input -> ``default``."""
    c = _c(col)
    return F.when(c.isNull() | (c.cast("string") == F.lit("")), F.lit(default)).otherwise(
        digest(c, algo).cast("string")
    )

"""Deterministic per-row uniforms used for sampling and splitting.

``uniform(key, salt)`` is the first 52 bits of ``md5(salt|key)`` divided by
2^52, a value in [0, 1). It is a pure function of the row key, so a sample
or split is the same for any number of partitions, any executor loss and
any engine that has md5 (the DuckDB oracles use the same formula).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = 4503599627370496.0


def uniform(key: Column | str, salt: str, method: str = "md5") -> Column:
    """u(salt, key) in [0, 1); JVM-side, codegen friendly.

    ``md5`` (default) is reproducible by any SQL engine (the oracles use
    it). ``xxhash`` takes the low 52 bits of Spark's ``xxhash64(salt, key)``:
    several times cheaper per row on a full-table sample flag, but
    Spark-specific.
    """
    key = F.col(key) if isinstance(key, str) else key
    if method == "xxhash":
        low = F.pmod(F.xxhash64(F.lit(salt), key), F.lit(1 << 52))
        return low.cast("double") / F.lit(TWO_POW_52)
    if method != "md5":
        raise ValueError(f"unknown hash method {method!r}")
    digest = F.md5(F.concat_ws("|", F.lit(salt), key.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(TWO_POW_52)


def uniform_expr(key_sql: str, salt: str) -> str:
    """The same uniform as a Spark SQL expression string."""
    return (f"(cast(conv(substring(md5(concat_ws('|', '{salt}', cast({key_sql} AS STRING))), 1, 13), 16, 10)"
            f" AS DOUBLE) / {TWO_POW_52!r})")

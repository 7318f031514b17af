"""Key lookups that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds more than one HOT_SHARE-th of the rows: at most HOT_SHARE keys are.
HOT_SHARE = 64
#: Below so many rows one task holds even a key that has all of them.
HOT_ROWS = 2_000_000
SALTS = 32


def salted_join(rows: DataFrame, lookup: DataFrame, key: str, how: str = "left", count: int | None = None) -> DataFrame:
    """Join ``rows`` with ``lookup``, whose ``key`` is unique; hot keys of ``rows`` are spread.

    ``count`` is the number of ``rows`` where the caller knows it.  From ``HOT_ROWS`` rows on, the keys
    that hold more than a ``HOT_SHARE``-th of them (at most ``HOT_SHARE`` keys, so the list sent to
    the driver is bounded) are salted: their rows are spread over ``SALTS`` tasks and only their
    lookup rows are repeated.  A null key matches nothing and is never salted.
    """
    if count is None or count < HOT_ROWS:
        return rows.join(lookup, key, how)
    hot = [
        r[0]
        for r in rows.groupBy(key).count().filter((F.col("count") > count // HOT_SHARE) & F.col(key).isNotNull()).collect()
    ]
    if not hot:
        return rows.join(lookup, key, how)
    is_hot = F.col(key).isin(hot)
    left = rows.withColumn("_salt", F.when(is_hot, F.floor(F.rand(7) * SALTS).cast("int")).otherwise(F.lit(0)))
    salts = F.sequence(F.lit(0), F.when(is_hot, F.lit(SALTS - 1)).otherwise(F.lit(0)))
    right = lookup.withColumn("_salt", F.explode(salts))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def spread_join(left: DataFrame, right: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Inner join of two sides with repeated keys; keys that hold more than a ``HOT_SHARE``-th of ``right`` are spread over ``SALTS`` tasks.

    Rows of a hot key go to the task that the hash of their ``spread_by`` names, and its rows of ``left`` to all of them.  At most
    ``HOT_SHARE`` keys are hot, at any size.  Null keys match nothing.
    """
    counts = right.filter(F.col(key).isNotNull()).groupBy(key).count()
    hot = F.broadcast(counts.join(F.broadcast(counts.agg(F.sum("count").alias("_all"))), F.expr(f"count * {HOT_SHARE} > _all")).select(key, F.lit(True).alias("_hot")))
    salts = F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    a = left.join(hot, key, "left").withColumn("_salt", salts).drop("_hot")
    b = right.join(hot, key, "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))).drop("_hot")
    return a.join(b, [key, "_salt"]).drop("_salt")

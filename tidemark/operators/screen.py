"""A bounded bitmap that keeps rows without a partner out of a shuffle.

The bitmap has ``2 ** bits`` bits whatever the data: one row per 64-bit word,
at most ``2 ** (bits - 6)`` rows, so it may be broadcast at any size. More keys
only make it denser, and then more rows pass; none that has a partner is
dropped. An exact join follows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 26


def screened(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, *, bits: int = BITS) -> DataFrame:
    """The rows whose key may be among ``wanted_key`` of ``wanted``. Null keys are dropped."""
    slot = lambda k: F.pmod(F.xxhash64(k), F.lit(1 << bits))
    one = F.expr("shiftleft(1L, CAST(__slot % 64 AS INT))")
    words = wanted.where(wanted_key.isNotNull()).select(slot(wanted_key).alias("__slot")).groupBy(F.shiftright("__slot", 6).alias("__word")).agg(F.bit_or(one).alias("__bits"))
    asked = rows.where(key.isNotNull()).withColumn("__slot", slot(key)).withColumn("__word", F.shiftright("__slot", 6))
    return asked.join(F.broadcast(words), "__word").where(F.expr("(shiftrightunsigned(__bits, CAST(__slot % 64 AS INT)) & 1) = 1")).select(*rows.columns)

"""Global positions and deterministic shards without a single-task window."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.session import materialize


def positions(rows: DataFrame, order: list[str], *, weight: Column | None = None) -> DataFrame:
    """``rows`` with ``row`` (from 1) and ``before``, the weight of all rows that precede.

    Range-partitioned sort, a running sum inside each range, and offsets over
    one row a range. The sorted ranges are written first, so that a retried
    task cannot shift a boundary.
    """
    w = F.lit(1).cast("long") if weight is None else weight.cast("long")
    s = rows.withColumn("__w", w).repartitionByRange(*order).withColumn("__p", F.spark_partition_id())
    s = materialize(s, "ranges")
    per = s.groupBy("__p").agg(F.count("*").alias("__n"), F.sum("__w").alias("__s"))
    ahead = W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)  # one row a range
    base = per.select("__p", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__n0"), F.coalesce(F.sum("__s").over(ahead), F.lit(0)).alias("__s0"))
    own = W.partitionBy("__p").orderBy(*order)
    inside = F.coalesce(F.sum("__w").over(own.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    out = s.withColumn("__i", F.row_number().over(own)).withColumn("__b", inside).join(F.broadcast(base), "__p")
    return out.withColumn("row", F.col("__n0") + F.col("__i")).withColumn("before", F.col("__s0") + F.col("__b")).drop("__w", "__p", "__n0", "__s0", "__i", "__b")


def positional_zip(first: DataFrame, second: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """Rows of the same global position side by side: row, ``first``, ``second``, ``equal`` (null-safe).

    Where one input is longer the other side is null and ``equal`` false.
    """
    side = lambda df, name: positions(df, order).select("row", F.struct(*columns).alias(name))
    both = side(first, "first").join(side(second, "second"), "row", "full")
    return both.withColumn("equal", F.col("first").eqNullSafe(F.col("second")))


def ordered_merge(inputs: list[DataFrame], order: list[str]) -> DataFrame:
    """All rows of ``inputs`` with their global position ``row``; at a tie the earlier input's (``source``) come first."""
    tagged = [df.withColumn("source", F.lit(i)) for i, df in enumerate(inputs)]
    return positions(functools.reduce(DataFrame.unionByName, tagged), [*order, "source"]).drop("before")


def row_shards(rows: DataFrame, order: list[str], most: int) -> DataFrame:
    """``shard`` (from 1) of at most ``most`` rows, and ``line`` in the shard."""
    p = positions(rows, order)
    return p.withColumn("shard", F.floor((F.col("row") - 1) / most) + 1).withColumn("line", F.pmod(F.col("row") - 1, F.lit(most)) + 1).drop("row", "before")


def byte_shards(rows: DataFrame, order: list[str], size: Column, limit: int) -> DataFrame:
    """``shard`` (from 0) by the bytes that precede a row; a shard ends with the row that fills it."""
    return positions(rows, order, weight=size).withColumn("shard", F.floor(F.col("before") / limit)).drop("row", "before")

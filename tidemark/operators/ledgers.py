"""Count ledgers, activity thresholds, multisets and reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def count_ledger(rows: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias(name))


def roll_up(ledger: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Sum of a finer ledger by coarser keys."""
    return ledger.groupBy(*keys).agg(F.sum(name).alias(name))


def below_threshold(rows: DataFrame, keys: list[str], limit: int, *, per: list[str] | None = None) -> DataFrame:
    """Rows whose ``keys`` have fewer than ``limit`` rows (exclusive), whole history kept.

    With ``per`` the count is the sum over a finer ledger.
    """
    ledger = count_ledger(rows, [*keys, *(per or [])])
    kept = roll_up(ledger, keys) if per else ledger
    return rows.join(kept.where(F.col("n") < limit).select(*keys), keys, "left_semi")


def at_most_per_pair(rows: DataFrame, actor: str, market: str, limit: int, *, drop_actor: bool) -> DataFrame:
    """Rows of pairs with at most ``limit`` rows; ``drop_actor`` drops actors that exceed anywhere."""
    over = count_ledger(rows, [actor, market]).where(F.col("n") > limit)
    keys = [actor] if drop_actor else [actor, market]
    return rows.join(over.select(*keys).distinct(), keys, "left_anti")


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return count_ledger(rows, keys).where("n > 1")


def crossing_keys(rows: DataFrame, key: str, group: Column) -> DataFrame:
    """Keys that occur in more than one group; null groups do not count."""
    return rows.groupBy(key).agg(F.min(group).alias("lo"), F.max(group).alias("hi"), F.count_distinct(group).alias("n_groups")).where("lo <> hi").select(key, "n_groups")


def ledger_difference(declared: DataFrame, actual: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Full outer comparison of two ledgers: missing, extra and mismatched keys."""
    a, b = declared.withColumnRenamed(name, "n_declared"), actual.withColumnRenamed(name, "n_actual")
    both = a.join(b, keys, "full_outer")
    status = F.when(F.col("n_actual").isNull(), "missing").when(F.col("n_declared").isNull(), "extra").when(F.col("n_actual") != F.col("n_declared"), "mismatch")
    return both.withColumn("status", status).where("status IS NOT NULL")


def multiset_excess(part: DataFrame, whole: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``part`` that occur there more often than in ``whole``; nulls are equal."""
    counted = part.select(*columns, F.lit(1).alias("__p")).unionByName(whole.select(*columns, F.lit(-1).alias("__p")))
    sums = counted.groupBy(*columns).agg(F.count_if(F.col("__p") == 1).alias("n_part"), F.count_if(F.col("__p") == -1).alias("n_whole"))
    return sums.where("n_part > n_whole")


def multiset_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: how many rows either side has over the other."""
    cols = a.columns
    net = a.select(*cols, F.lit(1).alias("__s")).unionByName(b.select(*cols, F.lit(-1).alias("__s"))).groupBy(*cols).agg(F.sum("__s").alias("d"))
    return net.agg(F.coalesce(F.sum(F.greatest("d", F.lit(0))), F.lit(0)).alias("only_first"), F.coalesce(F.sum(F.greatest(-F.col("d"), F.lit(0))), F.lit(0)).alias("only_second"))


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows in exactly one of two tables, with the side."""
    return a.subtract(b).withColumn("side", F.lit("first")).unionByName(b.subtract(a).withColumn("side", F.lit("second")))


def null_safe_mismatches(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per column: rows whose value differs, a missing right row counting as null."""
    j = left.alias("a").join(right.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}"), "left")
    return j.agg(*[F.count_if(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))).alias(c) for c in columns]).unpivot([], columns, "column", "n_mismatch")


def replace_groups(base: DataFrame, fresh: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """``base`` without the groups that ``fresh`` brings, plus ``fresh`` under new ids."""
    top = base.agg(F.coalesce(F.max(row_id), F.lit(0))).scalar()
    kept = base.join(fresh.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(fresh.withColumn(row_id, F.col(row_id) + top))


def gates(checks: dict[str, DataFrame]) -> DataFrame:
    """(gate, passed): each check is a one-row, one-column boolean DataFrame."""
    return reduce(DataFrame.unionByName, [df.toDF("passed").select(F.lit(name).alias("gate"), "passed") for name, df in checks.items()])


def running_budget(rows: DataFrame, order: list[Column], cost: str, budget: int, *, by: list[str]) -> DataFrame:
    """Greedy selection per group: rows whose prior running cost is below the budget."""
    spent = F.coalesce(F.sum(cost).over(W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("spent", spent).where(F.col("spent") < budget)


def cents(c: str) -> Column:
    """Whole hundredths of a money or rate column, so that sums are exact."""
    return F.round(F.col(c) * 100).cast("long")

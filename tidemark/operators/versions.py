"""Attributes as known at event time: version numbers, then an equi-join.

``version_join`` gives every event the number of attribute changes of its
entity that hold from strictly before the event, counted over narrow timestamp
rows, and joins the wide attributes on (entity, number).

Scale: the counting window is partitioned by (entity, time block, salt). A hot
entity is cut by time, and a hot block by salt: its change rows (few) are
copied to each salt, its event rows are spread. What earlier blocks add is one
carry row per (entity, block, salt), found over at most one row per entity and
block. The attribute rows are likewise copied to the salts, so that one version
in force for a third of all events does not meet in one task.

Defined cases: events or changes with a null entity or time match nothing and
are dropped; repeated events each keep a row; repeated changes of the same
instant are resolved by ``precedence``; a change at the very instant of an
event is not yet in force; empty inputs give an empty result. Column names are
internal (prefix ``__``) until the end, so that extra columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def _salts(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def resolve_changes(changes: DataFrame, entity: Column, holds_from: Column, attributes: list[str], precedence: list[Column]) -> DataFrame:
    """One winner per (entity, instant): ``__e, __t, __a`` (struct of attributes)."""
    rows = changes.select(
        entity.alias("__e"), holds_from.alias("__t"), F.struct(*attributes).alias("__a"),
        F.struct(*[p.alias(f"p{i}") for i, p in enumerate(precedence)]).alias("__p"),
    ).where("__e IS NOT NULL AND __t IS NOT NULL")
    return rows.groupBy("__e", "__t").agg(F.min_by("__a", "__p").alias("__a"))


def version_join(
    events: DataFrame, event_id: str, event_entity: Column, event_time: Column,
    changes: DataFrame, change_entity: Column, holds_from: Column, attributes: list[str], precedence: list[Column],
    *, block_us: int = 6 * 3600 * 1_000_000, salts: int = 8,
) -> DataFrame:
    """Rows (event_id, *attributes, holds_from_us, version) of events with a version in force.

    ``precedence``: columns of ``changes``; among changes of one entity and
    instant the row smallest in them wins.
    """
    block = F.floor(F.col("__t") / block_us).cast("long")
    won = resolve_changes(changes, change_entity, holds_from, attributes, precedence).withColumn("__b", block)
    narrow = events.select(F.col(event_id).alias("__id"), event_entity.alias("__e"), event_time.alias("__t")).where(
        "__e IS NOT NULL AND __t IS NOT NULL"
    ).withColumn("__b", block)

    per_block = won.groupBy("__e", "__b").agg(F.count("*").alias("__n"))
    seen = narrow.groupBy("__e", "__b").agg(F.lit(0).cast("long").alias("__n"))
    before = F.sum("__n").over(W.partitionBy("__e").orderBy("__b").rowsBetween(W.unboundedPreceding, -1))
    carry = (
        per_block.unionByName(seen).groupBy("__e", "__b").agg(F.sum("__n").alias("__n"))
        .withColumn("__base", F.coalesce(before, F.lit(0).cast("long"))).select("__e", "__b", "__base")
    )

    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    low = F.lit(-(2**63)).cast("long")
    none = F.lit(None).cast(narrow.schema["__id"].dataType)
    line = narrow.select("__e", "__b", F.pmod(F.xxhash64("__id"), F.lit(salts)).cast("int").alias("__s"), "__t", F.lit(1).alias("__k"), zero.alias("__w"), "__id")
    line = line.unionByName(won.select("__e", "__b", _salts(salts).alias("__s"), "__t", F.lit(2).alias("__k"), one.alias("__w"), none.alias("__id")))
    line = line.unionByName(carry.select("__e", "__b", _salts(salts).alias("__s"), low.alias("__t"), F.lit(0).alias("__k"), F.col("__base").alias("__w"), none.alias("__id")))
    # events sort before changes of the same instant: strictly earlier changes only
    run = W.partitionBy("__e", "__b", "__s").orderBy("__t", "__k").rowsBetween(W.unboundedPreceding, 0)
    numbered = line.withColumn("__v", F.sum("__w").over(run)).where("__k = 1 AND __v > 0").select("__id", "__e", "__v", "__s")

    inside = F.row_number().over(W.partitionBy("__e", "__b").orderBy("__t"))
    wide = (
        won.withColumn("__i", inside).join(carry, ["__e", "__b"])
        .select("__e", (F.col("__base") + F.col("__i")).alias("__v"), "__t", "__a", _salts(salts).alias("__s"))
    )
    return numbered.join(wide, ["__e", "__v", "__s"]).select(
        F.col("__id").alias(event_id), *[F.col(f"__a.{a}").alias(a) for a in attributes],
        F.col("__t").alias("holds_from_us"), F.col("__v").alias("version"),
    )

"""Per-entity feature table from events: two-stage salted aggregation.

Stage one groups by (entity, type, salt), stage two merges the partial
statistics by (entity, type), and the last step lays out one row per entity
over the complete, sorted type list. The type list is a scalar subquery: its
size is that of the set of types (hundreds), never of the events.

Defined cases: an execution is one (actor, execution_id); of repeated rows the
smallest by (time, condition, side, shares, price) counts. Rows without an
execution id are told apart by their whole content. Rows without actor,
condition or known side belong to no event type and are left out; an actor that
has only rows without condition or known side still has a row. An execution
with an unusable amount (shares not a positive number, price not from 0 to 1)
still counts and dates the entity, and adds nothing to the totals. An entity
without executions of a type gets count 0, no last time and totals 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import amount, ident, outer_trim


def clean_executions(executions: DataFrame) -> DataFrame:
    """One row per execution: actor, type, time_us, shares, notional."""
    side = F.upper(outer_trim("side"))
    rows = executions.select(
        ident(F.col("actor")).alias("actor"),
        F.coalesce(F.concat(F.lit("i"), outer_trim("execution_id")), F.concat(F.lit("r"), F.to_json(F.struct("actor", "condition_id", "time_us", "side", "shares", "price")))).alias("execution"),
        F.struct(
            "time_us",
            F.regexp_replace(ident(F.col("condition_id")), "^0x", "").alias("condition"),
            F.when(side.isin("BUY", "SELL"), side).alias("side"),
            amount(F.col("shares"), 20, 8).alias("shares"),
            amount(F.col("price"), 13, 12).alias("price"),
        ).alias("x"),
    ).where("actor IS NOT NULL AND actor <> ''")
    one = rows.groupBy("actor", "execution").agg(F.min("x").alias("x"))
    good = (F.col("x.shares") > 0) & (F.col("x.price") >= 0) & (F.col("x.price") <= 1)
    return one.where("x.condition <> '' AND x.side IS NOT NULL").select(
        "actor", "execution", F.concat_ws("/", "x.condition", "x.side").alias("type"), F.col("x.time_us").alias("time_us"),
        F.when(good, F.col("x.shares")).alias("shares"),
        F.when(good, F.col("x.shares") * F.col("x.price")).alias("notional"),
    )


def listed_actors(executions: DataFrame) -> DataFrame:
    """Every actor of ``executions``, whatever its rows hold besides."""
    return executions.select(ident(F.col("actor")).alias("actor")).where("actor IS NOT NULL AND actor <> ''").distinct()


def typed_totals(events: DataFrame, entity: str, kind: str, spread: str, *, salts: int = 16) -> DataFrame:
    """Count, last time and totals per (entity, type), merged from salted partials."""
    part = events.groupBy(entity, kind, F.pmod(F.xxhash64(spread), F.lit(salts)).alias("__salt")).agg(
        F.count("*").alias("n"), F.max("time_us").alias("last_us"), F.sum("shares").alias("shares"), F.sum("notional").alias("notional"),
    )
    zero = lambda c, t: F.coalesce(F.sum(c), F.lit(0)).cast(t)
    return part.groupBy(entity, kind).agg(
        F.sum("n").alias("n"), F.max("last_us").alias("last_us"), zero("shares", "decimal(38,8)").alias("shares"), zero("notional", "decimal(38,20)").alias("notional"),
    )


def type_list(totals: DataFrame, kind: str) -> DataFrame:
    """One row, one column ``types``: the sorted complete list."""
    return totals.select(kind).distinct().agg(F.array_sort(F.collect_list(kind)).alias("types"))


def entity_features(totals: DataFrame, entity: str, kind: str, entities: DataFrame | None = None) -> DataFrame:
    """One row per entity: ``features``, an array over the complete type list.

    ``entities`` (distinct) also has those without totals.
    """
    types = type_list(totals, kind)
    place = types.select(F.posexplode("types").alias("__pos", kind))
    stat = F.struct("n", "last_us", "shares", "notional")
    own = totals.join(place, kind).groupBy(entity).agg(F.map_from_entries(F.collect_list(F.struct("__pos", stat.alias("s")))).alias("__own"))
    if entities is not None:
        own = entities.join(own, entity, "left")
    empty = F.struct(
        F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("last_us"),
        F.lit(0).cast("decimal(38,8)").alias("shares"), F.lit(0).cast("decimal(38,20)").alias("notional"),
    )
    sized = own.withColumn("n_types", types.select(F.size("types")).scalar())
    places = F.slice(F.sequence(F.lit(0), F.col("n_types")), 1, F.col("n_types"))  # none without types
    full = F.transform(places, lambda i: F.coalesce(F.try_element_at("__own", i), empty))
    return sized.select(entity, "n_types", full.alias("features"))

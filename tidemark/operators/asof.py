"""Strict-prior as-of joins, prior counts and look-ahead labels.

The rule everywhere: context of a probe at ``t`` is what happened strictly
before ``t``; labels look at ``[t, t + h)``. Rows of one instant never see each
other.

``asof_prior`` cuts every entity into time blocks. Inside a block one window
over the union of probes and events finds the latest earlier event; what lies
before the block comes from one carry row per (entity, block), computed over
block summaries. A hot entity is thereby spread over its blocks, and no window
partition holds more than a block's rows.

Frames over the full past (``prior_frame``) are for entities of bounded size;
frames of bounded length use ``with_halo``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

DAY_US = 86_400_000_000


def micros(c: str | Column) -> Column:
    """Microseconds of a timestamp column, with or without time zone (UTC)."""
    return F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


def asof_prior(
    probes: DataFrame, events: DataFrame, by: list[str], time: str, values: list[str],
    *, tie: list[str] | None = None, block_us: int = DAY_US, prefix: str = "prior_",
) -> DataFrame:
    """``probes`` with time and values of the latest event strictly before.

    Both sides have columns ``by`` and ``time`` (BIGINT microseconds). At one
    instant the event largest in ``tie`` (default: ``values``) is the latest.
    Probes with a null key or time keep null context.
    """
    tie = tie or values
    block = F.floor(F.col(time) / block_us).cast("long")
    names = [f"{prefix}{time}", *[f"{prefix}{v}" for v in values]]
    seen = events.dropna(subset=[*by, time]).groupBy(*by, time).agg(F.max(F.struct(*[F.col(t).alias(f"t{i}") for i, t in enumerate(tie)], *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])).alias("__x"))
    seen = seen.select(*by, block.alias("__b"), time, F.struct(F.col(time).alias("t"), *[F.col(f"__x.v{i}").alias(f"v{i}") for i in range(len(values))]).alias("__e"))
    asked = probes.dropna(subset=[*by, time]).withColumn("__b", block)

    last = seen.groupBy(*by, "__b").agg(F.max_by("__e", time).alias("__e"))
    blocks = last.unionByName(asked.select(*by, "__b").distinct(), allowMissingColumns=True).groupBy(*by, "__b").agg(F.first("__e", True).alias("__e"))
    carried = blocks.select(*by, "__b", F.last("__e", True).over(W.partitionBy(*by).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)).alias("__e")).dropna(subset=["__e"])

    # kind 0: carried in, 1: probe, 2: event; a probe comes before events of its instant
    line = asked.withColumn("__k", F.lit(1))
    line = line.unionByName(seen.withColumn("__k", F.lit(2)), allowMissingColumns=True)
    line = line.unionByName(carried.withColumn("__k", F.lit(0)).withColumn(time, F.col("__b") * block_us), allowMissingColumns=True)
    order = W.partitionBy(*by, "__b").orderBy(F.when(F.col("__k") == 0, F.lit(-(2**62))).otherwise(F.col(time)), "__k").rowsBetween(W.unboundedPreceding, 0)
    got = line.withColumn("__e", F.last("__e", True).over(order)).where("__k = 1")
    out = [F.col("__e.t").alias(names[0]), *[F.col(f"__e.v{i}").alias(n) for i, n in enumerate(names[1:])]]
    rest = probes.where(" OR ".join(f"`{c}` IS NULL" for c in [*by, time]))
    return got.select(*probes.columns, *out).unionByName(rest, allowMissingColumns=True)


def fresh(value: str, at: str, time: str, most_us: int) -> tuple[Column, Column]:
    """(value if at most ``most_us`` old, reason why there is none)."""
    age = F.col(time) - F.col(at)
    kept = F.when(age <= most_us, F.col(value))
    return kept, F.when(F.col(at).isNull(), "no_earlier_observation").when(age > most_us, "stale")


def prior_frame(by: list[str], time: str, back_us: int | None = None):
    """Strict-prior frame, or the look-back ``[t - back_us, t)``."""
    return W.partitionBy(*by).orderBy(time).rangeBetween(W.unboundedPreceding if back_us is None else -back_us, -1)


def next_frame(by: list[str], time: str, ahead_us: int):
    """Look-ahead ``[t, t + ahead_us)``."""
    return W.partitionBy(*by).orderBy(time).rangeBetween(0, ahead_us - 1)


def with_halo(rows: DataFrame, by: list[str], time: str, *, back_us: int = 0, ahead_us: int = 0, block_us: int = DAY_US) -> DataFrame:
    """Rows by time block, with copies where the frames of other blocks reach them.

    Window over ``[*by, "__b"]`` with a range frame inside ``[-back_us,
    ahead_us]``, then keep ``__own``: a hot entity's frames are computed block
    by block. Rows without key or time are left out.
    """
    t = F.col(time)
    at = lambda x: F.floor(x / F.lit(block_us)).cast("long")
    copies = F.explode(F.sequence(at(t - ahead_us), at(t + back_us)))
    return rows.dropna(subset=[*by, time]).withColumn("__b", copies).withColumn("__own", F.col("__b") == at(t))


def prior_totals(
    probes: DataFrame, events: DataFrame, by: list[str], time: str, measures: dict[str, Column],
    *, least: dict[str, Column] | None = None, last: dict[str, Column] | None = None, block_us: int = DAY_US,
) -> DataFrame:
    """Probes with sums (minima, latest values) of ``events`` strictly before each.

    Sums over nothing are 0, minima and latest values null. ``last`` skips
    nulls; of several at one instant the largest is the latest. Probes without
    key or time are left out. Same-instant events are merged first, so ties
    never see each other.
    """
    least, last = least or {}, last or {}
    block = F.floor(F.col(time) / block_us).cast("long")
    fold = lambda late: [F.sum(m).alias(m) for m in measures] + [F.min(m).alias(m) for m in least] + [late(m).alias(m) for m in last]
    latest = lambda m: F.max_by(m, F.when(F.col(m).isNotNull(), F.col(time)))
    ticks = events.dropna(subset=[*by, time]).select(*by, time, *[c.alias(m) for m, c in {**measures, **least, **last}.items()])
    ticks = ticks.groupBy(*by, time).agg(*fold(F.max)).withColumn("__b", block)
    asked = probes.dropna(subset=[*by, time]).withColumn("__b", block)
    some = lambda m: F.first(m, True)
    per = ticks.groupBy(*by, "__b").agg(*fold(latest)).unionByName(asked.select(*by, "__b").distinct(), allowMissingColumns=True).groupBy(*by, "__b").agg(*fold(some))
    before = W.partitionBy(*by).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    base = per.select(*by, "__b", *[F.sum(m).over(before).alias(m) for m in measures], *[F.min(m).over(before).alias(m) for m in least], *[F.last(m, True).over(before).alias(m) for m in last])
    line = asked.withColumn("__k", F.lit(1))
    line = line.unionByName(ticks.withColumn("__k", F.lit(2)), allowMissingColumns=True)
    line = line.unionByName(base.withColumn("__k", F.lit(0)).withColumn(time, F.lit(-(2**62)).cast("long")), allowMissingColumns=True)
    run = W.partitionBy(*by, "__b").orderBy(time, "__k").rowsBetween(W.unboundedPreceding, 0)
    out = line.withColumns({**{m: F.coalesce(F.sum(m).over(run), F.lit(0)) for m in measures}, **{m: F.min(m).over(run) for m in least}, **{m: F.last(m, True).over(run) for m in last}})
    return out.where("__k = 1").select(*probes.columns, *measures, *least, *last)


def prior_rank(probes: DataFrame, events: DataFrame, by: list[str], time: str, name: str, *, block_us: int = DAY_US) -> DataFrame:
    """Probes with key and time, and the number of events strictly before each."""
    return prior_totals(probes, events, by, time, {name: F.lit(1).cast("long")}, block_us=block_us)

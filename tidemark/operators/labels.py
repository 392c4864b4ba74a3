"""Event-time grids, coverage, occurrence labels and chronological splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.operators.asof import with_halo

# Why a label is censored.
NOT_COVERED = "incomplete_target_source_coverage"
UNKNOWN_ROLE = "unclassified_execution_role"


def fixed_grid(start: Column, end: Column, step_us: int) -> Column:
    """Half-open windows of ``step_us`` from ``start`` to before ``end``."""
    return F.explode(F.when(end > start, F.sequence(start, end - 1, F.lit(step_us))))


def active_grid(events: DataFrame, by: list[str], time: str, step_us: int, active_us: int) -> DataFrame:
    """Clock-grid queries strictly after an event and within ``active_us`` of it.

    Overlapping stretches merge by distinctness, with no explicit union of
    intervals. A burst adds its queries once: rows first collapse to one per
    grid slot.
    """
    slot = F.floor(F.col(time) / step_us)
    last = events.dropna(subset=[*by, time]).groupBy(*by, slot.alias("slot")).agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
    q = last.select(*by, F.explode(F.sequence((F.col("slot") + 1) * step_us, F.col("hi") + active_us, F.lit(step_us))).alias("query_us"))
    return q.distinct()


def merge_intervals(rows: DataFrame, by: list[str]) -> DataFrame:
    """Union of [start, end); touching intervals merge, empty ones are dropped."""
    order = W.partitionBy(*by).orderBy("start", "end")
    ahead = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    r = rows.where(F.col("start") < F.col("end")).withColumn("__new", F.when(ahead.isNull() | (F.col("start") > ahead), 1).otherwise(0))
    r = r.withColumn("__island", F.sum("__new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return r.groupBy(*by, "__island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("__island")


def covered(windows: DataFrame, merged: DataFrame, by: list[str]) -> DataFrame:
    """``windows`` (start, end) with whether one merged interval contains them.

    The only interval that can is the last that starts at or before the window.
    """
    line = windows.withColumn("__k", F.lit(1)).unionByName(merged.select(*by, "start", F.col("end").alias("__e")).withColumn("__k", F.lit(0)), allowMissingColumns=True)
    reach = F.last("__e", True).over(W.partitionBy(*by).orderBy("start", "__k").rowsBetween(W.unboundedPreceding, 0))
    return line.withColumn("covered", F.coalesce(reach >= F.col("end"), F.lit(False))).where("__k = 1").drop("__k", "__e")


def kickoff_split(fixtures: DataFrame, kickoff: str, parts: list[tuple[str, float]]) -> DataFrame:
    """Chronological split in which simultaneous kick-offs stay together.

    A batch goes to the part its first fixture falls in. Batches are the
    distinct kick-off instants, a calendar-sized set.
    """
    g = fixtures.groupBy(kickoff).agg(F.count("*").alias("__n"))
    run = W.orderBy(kickoff).rowsBetween(W.unboundedPreceding, -1)
    g = g.withColumn("__before", F.coalesce(F.sum("__n").over(run), F.lit(0))).withColumn("__all", F.sum("__n").over(W.partitionBy()))
    choice, edge = F.lit(parts[-1][0]), 1.0
    for (name, _), (_, after) in zip(reversed(parts[:-1]), reversed(parts[1:])):
        edge -= after
        choice = F.when(F.col("__before") < F.col("__all") * round(edge, 9), name).otherwise(choice)
    return fixtures.join(g.withColumn("split", choice).select(kickoff, "split"), kickoff)


def chronology(rows: DataFrame, split: str, time: str, order: list[str]) -> DataFrame:
    """Per split its first and last time, and whether it lies after the one before."""
    place = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(split))
    g = rows.where(F.col(split).isin(order)).groupBy(split).agg(F.min(time).alias("first_us"), F.max(time).alias("last_us"), F.count("*").alias("n")).withColumn("place", place)
    return g.withColumn("in_order", F.coalesce(F.lag("last_us").over(W.orderBy("place")) < F.col("first_us"), F.lit(True))).drop("place")  # a row a split


def purge_overlap(sequences: DataFrame, split: str, first: str, last: str, order: list[str]) -> DataFrame:
    """Sequences that start after every earlier split has ended."""
    place = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(split))
    ends = sequences.groupBy(split).agg(F.max(last).alias("__e")).withColumn("__p", place)
    ends = ends.withColumn("__b", F.max("__e").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1))).select(split, "__b")
    return sequences.join(F.broadcast(ends), split).where(F.col("__b").isNull() | (F.col(first) > F.col("__b"))).drop("__b")


def occurrence(windows: DataFrame, actions: DataFrame, coverage: DataFrame, by: list[str], *, horizon_us: int, kind: str = "taker", block_us: int = 86_400_000_000) -> DataFrame:
    """Label of each window [start, start + horizon): what was first done in it, or why that is unknown.

    ``windows``: window_id, ``by``, start, end; ``actions``: ``by``, action_id,
    t, role; ``coverage``: ``by``, start, end. Without one stretch of coverage
    over the whole window it is CENSORED, also if an action was seen; so it is
    with an action of unknown role, unless ``kind`` is ``all``. Repeated
    actions count once; several at the earliest instant are all named, in the
    order of their ids as text, and the order is marked ambiguous.
    """
    role = F.lit(True) if kind == "all" else F.col("role") == kind
    unknown = F.lit(False) if kind == "all" else F.col("role") == "unknown"
    once = actions.groupBy(*by, "t", "action_id").agg(F.max(role.cast("int")).alias("hit"), F.max(unknown.cast("int")).alias("bad"))
    ticks = once.groupBy(*by, "t").agg(F.sum("hit").alias("n"), F.sum("bad").alias("bad"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("hit") == 1, F.col("action_id").cast("string")))), ",").alias("ids"))
    asked = covered(windows, merge_intervals(coverage, by), by).select("window_id", *by, F.col("start").alias("t"), "covered", F.lit(1).alias("__k"))
    line = with_halo(asked.unionByName(ticks.withColumn("__k", F.lit(0)), allowMissingColumns=True), by, "t", ahead_us=horizon_us, block_us=block_us)
    frame = W.partitionBy(*by, "__b").orderBy("t").rangeBetween(0, horizon_us - 1)
    first = F.min(F.when(F.col("n") > 0, F.struct("t", "ids", "n"))).over(frame)
    out = line.withColumns({"__n": F.coalesce(F.sum("n").over(frame), F.lit(0)), "__bad": F.coalesce(F.sum("bad").over(frame), F.lit(0)), "__first": first}).where("__k = 1 AND __own")
    reason = F.when(~F.col("covered"), NOT_COVERED).when(F.col("__bad") > 0, UNKNOWN_ROLE)
    known = lambda c: F.when(reason.isNull(), c)
    return out.select(
        "window_id", F.when(reason.isNotNull(), "CENSORED").when(F.col("__n") > 0, "TRADE").otherwise("NO_OBSERVED_TRADE").alias("status"), reason.alias("censor_reason"), known(F.col("__n")).alias("action_count"),
        known(F.col("__first.ids")).alias("first_action_ids"), known(F.coalesce(F.col("__first.n") > 1, F.lit(False))).alias("ordering_ambiguous"), known(F.col("__first.t")).alias("first_us"),
    )

"""Average-cost inventory and volume-weighted prices."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


START = {"qty": 0.0, "cost": 0.0, "gain": 0.0, "ok": True, "flat": True, "b": 0.0, "v": 0.0, "s": 0.0, "w": 0.0}
STATES = "key string, time_us long, quantity double, cost double, realised double, reason string"


def _inventory(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Average-cost fold over instants sorted by (key, time): the state after each."""
    state, now = dict(START), None
    kinds = [pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.string()]
    for batch in batches:
        rows = []
        for key, t, b, v, s, w in zip(*(c.to_pylist() for c in batch.columns)):
            if key != now:
                state, now = dict(START), key
            state.update(b=b, v=v, s=s, w=w)
            _settle(state)
            ok, sure = state["ok"], state["ok"] and state["flat"]
            rows.append((key, t, state["qty"] if ok else None, state["cost"] if sure else None, state["gain"] if sure else None, "oversold" if not ok else None if sure else "mixed_tie"))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], ["key", "time_us", "quantity", "cost", "realised", "reason"])


def _settle(s: dict) -> None:
    if s["b"] and s["s"]:
        s["flat"] = False  # order inside the instant is unknown
    if s["b"]:
        s["qty"] += s["b"]
        s["cost"] += s["v"]
    if s["s"] > s["qty"] + 1e-9:
        s["ok"] = False
    elif s["s"]:
        part = s["cost"] * s["s"] / s["qty"]
        s["gain"] += s["w"] - part
        s["cost"] -= part
        s["qty"] -= s["s"]
    if s["ok"] and abs(s["qty"]) <= 1e-9:
        if not s["flat"]:
            s["gain"] = 0.0
        s["qty"] = s["cost"] = 0.0
        s["flat"] = True
    s["b"] = s["v"] = s["s"] = s["w"] = 0.0


def inventory_states(fills: DataFrame, key: Column) -> DataFrame:
    """Quantity, remaining cost and realised gain per key after each instant with a fill.

    ``fills``: time_us, side, shares, notional (DECIMAL). The fills of an
    instant are summed exactly in the JVM, so their order does not matter; the
    fold streams a sorted partition with a state of a few numbers and collects
    no group. An oversold key is unknown; an instant with both sides makes cost
    and gain unknown until the key is flat, from where the gain counts anew.
    """
    total = lambda c, side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col(c))), F.lit(0)).cast("decimal(38,10)").cast("double")
    ticks = fills.select(key.alias("key"), "time_us", "side", "shares", "notional").groupBy("key", "time_us").agg(total("shares", "BUY").alias("b"), total("notional", "BUY").alias("v"), total("shares", "SELL").alias("s"), total("notional", "SELL").alias("w"))
    return ticks.repartition("key").sortWithinPartitions("key", "time_us").mapInArrow(_inventory, STATES)


def average_cost_inventory(fills: DataFrame, key: Column) -> DataFrame:
    """The state of every key after all fills."""
    return inventory_states(fills, key).groupBy("key").agg(F.max_by(F.struct("quantity", "cost", "realised", "reason"), "time_us").alias("x")).select("key", "x.*")


def vwap(fills: DataFrame, by: list[str]) -> DataFrame:
    """Volume-weighted price per instant, 12 places, half to even: exact sums, long division by digits."""
    g = fills.groupBy(*by).agg(F.sum("notional").cast("decimal(38,20)").alias("v"), F.sum("shares").cast("decimal(38,8)").alias("s"))
    top, below = (F.replace(F.col(c).cast("string"), F.lit("."), F.lit("")).cast("decimal(38,0)") for c in ("v", "s"))
    g = g.withColumns({"top": top, "below": below}).withColumn("q", F.expr("CAST(floor((top - top % below) / below) AS DECIMAL(38,0))")).withColumn("r", F.expr("top % below"))
    up = F.expr("2 * r > below OR (2 * r = below AND q % 2 = 1)")
    return g.select(*by, ((F.col("q") + up.cast("int")).cast("double") / 1e12).alias("vwap"), F.col("s").cast("string").alias("shares"))

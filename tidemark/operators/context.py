"""Versioned context: availability gates, version selection, hash chains, news per scope."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def available_before(verified: Column, lower: Column, upper: Column, cutoff: Column) -> Column:
    """Verified, bounded above, not inverted, and known strictly before the cut-off."""
    return F.coalesce(verified & upper.isNotNull() & (F.coalesce(lower, upper) <= upper) & (upper < cutoff), F.lit(False))


def evidence_valid(evidence: Column, kinds: list[str], content: Column, upper: Column) -> Column:
    """Some element is of an allowed kind, links to http(s), has the content's hash, and was captured in time."""
    return F.exists(
        evidence,
        lambda e: e["kind"].isin(kinds) & e["sha"].rlike("^[0-9a-f]{64}$") & e["url"].rlike("^https?://[^/]+") & (e["sha"] == content) & (e["captured_us"] <= upper),
    )


def latest_versions(rows: DataFrame, item: str, rank: str, gate: Column) -> DataFrame:
    """Highest rank of each item among rows that pass the gate; the filter comes before the rank."""
    return rows.where(gate).withColumn("__r", F.row_number().over(W.partitionBy(item).orderBy(F.desc(rank)))).where("__r = 1").drop("__r")


def version_conflicts(rows: DataFrame, item: str, rank: str, content: list[str]) -> DataFrame:
    """(item, rank) held by more than one distinct content."""
    return rows.groupBy(item, rank).agg(F.count_distinct(F.xxhash64(*content)).alias("n_contents")).where("n_contents > 1")


def running_best(rows: DataFrame, scope: str, time: str, item: str, rank: str) -> DataFrame:
    """State after each distinct instant of a scope: items seen, and the sum of their best ranks.

    An item adds only by what it raises its own best rank, so a running sum
    over changes is the state and no map is carried.
    """
    best = F.max(rank).over(W.partitionBy(scope, item).orderBy(time).rangeBetween(W.unboundedPreceding, -1))
    now = F.max(rank).over(W.partitionBy(scope, item).orderBy(time).rangeBetween(W.unboundedPreceding, 0))
    first = F.row_number().over(W.partitionBy(scope, item, time).orderBy(rank))
    step = rows.select(scope, time, item, best.alias("b"), now.alias("n"), first.alias("f")).where("f = 1")
    tick = step.groupBy(scope, time).agg(F.count_if(F.col("b").isNull()).alias("new"), F.sum(F.col("n") - F.coalesce("b", F.lit(0))).alias("raised"))
    run = W.partitionBy(scope).orderBy(time)
    return tick.select(scope, time, F.sum("new").over(run).alias("n_items"), F.sum("raised").over(run).cast("long").alias("rank_sum"))


def hash_chain(rows: DataFrame, scope: str, order: list[str], payload: Column) -> DataFrame:
    """State k of each scope is sha256(state k-1 | event k): an ordered fold, one row a state."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from hashlib import sha256

        scope_now, state, k = object(), "", 0
        for pdf in batches:
            out = []
            for s, p in zip(pdf["scope"], pdf["payload"]):
                if s != scope_now:
                    scope_now, state, k = s, "", 0
                state, k = sha256(f"{state}|{p}".encode()).hexdigest(), k + 1
                out.append((s, k, state))
            yield pd.DataFrame(out, columns=["scope", "k", "state"])

    keys = [F.col(o).alias(f"o{i}") for i, o in enumerate(order)]
    r = rows.select(F.col(scope).alias("scope"), *keys, payload.alias("payload")).repartition("scope").sortWithinPartitions("scope", *[f"o{i}" for i in range(len(order))])
    return r.select("scope", "payload").mapInPandas(fold, "scope string, k long, state string")


def change_points(rows: DataFrame, item: str, time: str, value: str) -> DataFrame:
    """Instants at which an item's value changes, reversions included.

    Instants with conflicting values are quarantined, and the value after one
    is a change again.
    """
    g = rows.groupBy(item, time).agg(F.count_distinct(value).alias("c"), F.min(value).alias(value)).withColumn("conflict", F.col("c") > 1)
    by = W.partitionBy(item).orderBy(time)
    prior, bad = F.lag(value).over(by), F.lag("conflict").over(by)
    keep = ~F.col("conflict") & (prior.isNull() | bad | (prior != F.col(value)))
    return g.withColumn("kept", keep).select(item, time, value, "conflict", "kept").where("kept OR conflict").drop("kept")


def newest_per_scope(rows: DataFrame, scope: str, order: list[Column], most: int) -> DataFrame:
    return rows.withColumn("place", F.row_number().over(W.partitionBy(scope).orderBy(*order))).where(F.col("place") <= most)


def headline_key(c: Column) -> Column:
    """Lower case with collapsed white space."""
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def distinct_headlines(rows: DataFrame, scope: str, title: str, order: list[Column]) -> DataFrame:
    """First row per scope and headline key; empty headlines are dropped."""
    r = rows.withColumn("key", headline_key(F.col(title))).where("key <> ''")
    return r.withColumn("__r", F.row_number().over(W.partitionBy(scope, "key").orderBy(*order))).where("__r = 1").drop("__r")

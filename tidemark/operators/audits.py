"""Audits and exports that are re-derived by a second way: replay, rebuild, recount, strict parsing, bounded sequential choice.

Defined cases: audits return what is wrong as rows or counts and raise nothing;
null keys are findings of their own or left out, as each function says; empty
inputs give empty results and pass.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# The keys of an answer and of each of its trades.
ANSWER_KEYS, TRADE_KEYS = ("action", "trades"), ("outcome", "price", "shares", "side")
MOST_TRADES = 20


def order_free_digest(*columns: Column) -> Column:
    """Aggregate digest of rows in any order: the sum of 60-bit prefixes of MD5 as DECIMAL."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in columns])
    return F.sum(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)"))


def json_keys(text: Column) -> Column:
    """Distinct names of fields at any depth of a JSON text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r'"([^"\\]+)"\s*:'), F.lit(1)))


def parsed_answer(text: Column) -> Column:
    """Number of trades of a strict answer: 0 for no trade, null if anything is off.

    Exactly the keys expected, 1 to 20 trades, known side and outcome, shares in
    (0, 1e100], price in [0, 1].
    """
    keys = F.array_sort(F.json_object_keys(text))
    action = F.get_json_object(text, "$.action")
    trades = F.from_json(F.get_json_object(text, "$.trades"), "array<map<string,string>>")

    def good(t: Column) -> Column:
        shares, price = t["shares"].try_cast("double"), t["price"].try_cast("double")
        return (
            (F.array_sort(F.map_keys(t)) == F.array(*[F.lit(k) for k in TRADE_KEYS])) & t["side"].isin("BUY", "SELL") & t["outcome"].isin("Yes", "No")
            & F.coalesce((shares > 0) & (shares <= 1e100), F.lit(False)) & F.coalesce((price >= 0) & (price <= 1), F.lit(False))
        )

    strict = (keys == F.array(*[F.lit(k) for k in ANSWER_KEYS])) & (action == "TRADE") & F.size(trades).between(1, MOST_TRADES) & F.forall(trades, lambda t: F.coalesce(good(t), F.lit(False)))
    return F.when((keys == F.array(F.lit("action"))) & (action == "NO_TRADE"), 0).when(strict, F.size(trades))


def balanced_choice(candidates: DataFrame, bucket: str, rank: str, cost: str, budget: int) -> DataFrame:
    """Turns over the buckets: each takes its next candidate that still fits the budget; (bucket, rank, cost, place).

    The choice is sequential. It stays bounded: of equal cost c a bucket can
    give at most ``budget // c``, and those are its first, so other rows are
    dropped before the fold without changing the choice. What is left is at
    most ``budget * (1 + ln budget)`` rows a bucket, whatever the table holds.
    """
    order = W.partitionBy(bucket, cost).orderBy(rank)
    few = candidates.where((F.col(cost) > 0) & (F.col(cost) <= budget)).withColumn("__n", F.row_number().over(order)).where(F.col("__n") * F.col(cost) <= budget).select(F.col(bucket).cast("string").alias("bucket"), F.col(rank).cast("long").alias("rank"), F.col(cost).cast("long").alias("cost"))

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        queues = {b: list(zip(g["rank"], g["cost"]))[::-1] for b, g in pdf.sort_values(["bucket", "rank"]).groupby("bucket", sort=True)}
        used, out = 0, []
        while any(queues.values()) and used < budget:
            for b, queue in queues.items():
                while queue:
                    r, c = queue.pop()
                    if used + c <= budget:
                        used += c
                        out.append((b, r, c, len(out) + 1))
                        break
        return pd.DataFrame(out, columns=["bucket", "rank", "cost", "place"])

    return few.groupBy().applyInPandas(choose, "bucket string, rank long, cost long, place long")


def unreused_choice(groups: DataFrame, group: str, order: list[str], item: str, place: list[str]) -> DataFrame:
    """One item a group in the order of ``order``, its first in ``place`` that no earlier group has taken: (group, item).

    Bounded: with g groups only the first g distinct items of each can matter.
    """
    first = groups.groupBy(group, *order, item).agg(F.min(F.struct(*place)).alias("__p"))
    n = groups.select(group).distinct().agg(F.count("*")).scalar()
    few = first.withColumn("__r", F.row_number().over(W.partitionBy(group).orderBy("__p", item))).withColumn("__n", n).where("__r <= __n").select(F.col(group).cast("string").alias("group"), F.struct(*order).alias("o"), F.col(item).cast("string").alias("item"), F.col("__r").cast("long").alias("r"))
    few = few.withColumn("o", F.dense_rank().over(W.orderBy("o", "group")))  # the bounded rows only

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        taken, out = set(), []
        for _, g in pdf.sort_values(["o", "r"]).groupby("o", sort=True):
            for name, value in zip(g["group"], g["item"]):
                if value not in taken:
                    taken.add(value)
                    out.append((name, value))
                    break
        return pd.DataFrame(out, columns=["group", "item"])

    return few.groupBy().applyInPandas(choose, "group string, item string")


def protocol_errors(rows: DataFrame, actor: str, order: list[str]) -> DataFrame:
    """Findings of an alternating log (kind wait or act, start_us, end_us, n): (code, n).

    A wait precedes each act and ends when it happens; waits hold no actions,
    acts at least one; instants grow; the first wait has no start.
    """
    w = W.partitionBy(actor).orderBy(*order)
    seen = rows.select("kind", "start_us", "end_us", "n", F.lag("kind").over(w).alias("k"), F.lag("end_us").over(w).alias("e"), F.row_number().over(w).alias("i"))
    wait, act = F.col("kind") == "wait", F.col("kind") == "act"
    codes = {
        "bad_alternation": F.when(F.col("i") % 2 == 1, ~wait).otherwise(~act), "act_without_actions": act & (F.col("n") < 1), "wait_with_actions": wait & (F.col("n") != 0), "wait_ends_elsewhere": act & ~F.col("e").eqNullSafe(F.col("end_us")),
        "first_wait_has_start": (F.col("i") == 1) & F.col("start_us").isNotNull(), "wait_starts_elsewhere": wait & (F.col("i") > 1) & ~F.col("start_us").eqNullSafe(F.col("e")), "time_does_not_grow": wait & (F.col("end_us") <= F.col("start_us")),
    }
    one = seen.agg(*[F.count_if(c).alias(name) for name, c in codes.items()])
    return one.unpivot([], list(codes), "code", "n")


def both_ways(first: DataFrame, second: DataFrame) -> DataFrame:
    """(n, missing, extra) of a table against one derived in another way, as multisets."""
    return first.agg(F.count("*").alias("n")).crossJoin(first.exceptAll(second).agg(F.count("*").alias("missing"))).crossJoin(second.exceptAll(first).agg(F.count("*").alias("extra")))  # three single rows


def stop_after_old(pages: DataFrame, by: list[str], order: list[str], old: Column, run: int = 2) -> DataFrame:
    """Pages up to and with the ``run``-th consecutive all-old one."""
    w = W.partitionBy(*by).orderBy(*order)
    streak = F.sum(old.cast("int")).over(w.rowsBetween(-(run - 1), 0))
    full = pages.withColumn("__hit", (streak >= run).cast("int"))
    before = F.coalesce(F.sum("__hit").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return full.withColumn("__before", before).where("__before = 0").drop("__hit", "__before")

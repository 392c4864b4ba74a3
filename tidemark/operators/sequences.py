"""Sequential per-actor products: delta context, budgeted chunks, chat checks.

All stream a partition sorted by (actor, time) with state of bounded size; no
actor's rows are collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _sorted(rows: DataFrame, actor: str, order: list[str]) -> DataFrame:
    return rows.repartition(actor).sortWithinPartitions(actor, *order)


def budget_chunks(rows: DataFrame, actor: str, order: list[str], cost: str, budget: int) -> DataFrame:
    """``rows`` with ``chunk`` from 0: a row that would exceed the budget opens a new chunk.

    The cut is decided from what came before, so a row's own label never moves
    it. A row larger than the budget is a chunk of its own.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, used, chunk = object(), 0, 0
        for pdf in batches:
            out = []
            for a, c in zip(pdf[actor], pdf[cost]):
                if a != now:
                    now, used, chunk = a, 0, 0
                elif used + c > budget:
                    used, chunk = 0, chunk + 1
                used += c
                out.append(chunk)
            yield pdf.assign(chunk=pd.Series(out, index=pdf.index, dtype="int64"))

    s = _sorted(rows, actor, order)
    return s.mapInPandas(run, s.schema.simpleString().removeprefix("struct<").removesuffix(">") + ",chunk:bigint")


def delta_context(rows: DataFrame, actor: str, order: list[str], market: str, expiry_us: int, time: str) -> DataFrame:
    """Per row what changes in the actor's watch set: markets added now, and expired since.

    A market leaves when nothing was done in it for ``expiry_us``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, seen = object(), {}
        for pdf in batches:
            added, gone, size = [], [], []
            for a, m, t in zip(pdf[actor], pdf[market], pdf[time]):
                if a != now:
                    now, seen = a, {}
                old = [k for k, u in seen.items() if u < t - expiry_us]
                for k in old:
                    del seen[k]
                added.append(m not in seen)
                gone.append(len(old))
                seen[m] = t
                size.append(len(seen))
            yield pdf.assign(added=added, n_expired=gone, n_watched=size)

    s = _sorted(rows, actor, order)
    return s.mapInPandas(run, s.schema.simpleString().removeprefix("struct<").removesuffix(">") + ",added:boolean,n_expired:bigint,n_watched:bigint")


def chat_turns(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Turns (key, turn, role, content) of texts in ``role: content`` lines."""
    parts = F.filter(F.split(F.col(text), r"\n(?=(?:system|user|assistant): )"), lambda x: x.rlike("^(system|user|assistant): "))
    x = texts.select(key, F.posexplode(parts).alias("turn", "line"))
    return x.select(key, F.col("turn").cast("long").alias("turn"), F.split("line", ": ", 2)[0].alias("role"), F.regexp_replace("line", "^[a-z]+: ", "").alias("content"))

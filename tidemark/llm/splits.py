"""Splits that keep related records together.

``components`` finds connected components by random-mate contraction. Each
round every vertex tosses a coin; a vertex with tails and a neighbour with
heads is collapsed into the smallest such neighbour, and the edges are
renamed by joins. About a quarter of the vertices that still have an edge go in
a round, so rounds are logarithmic whatever the diameter. When no edge is left,
the collapses are unwound from the last to the first to label all vertices;
a component is then named by its smallest vertex. Every round is written to the
shared folder, so plans stay short and a lost executor costs a reread; edges of
a round are deleted once the next are written.

``assign_splits`` cuts the units (components and single records) by cumulative
weight within each stratum, heavy units first. The running sum is two-level:
over at most 64 * 256 buckets a stratum, then inside a bucket.

Defined cases: null keys join nothing; repeated edges and self-loops are
dropped; a table without edges gives no labels and every record is its own
unit; a unit of at least a third of a stratum falls to the split that its
weight's middle lies in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.session import discard, materialize

SPLITS = (("train", 0.8), ("validation", 0.1), ("test", 0.1))


def shared_key_edges(rows: DataFrame, vertex: str, key: str) -> DataFrame:
    """Edges (a, b): a star around the smallest vertex of each key, never all pairs."""
    pairs = rows.where(F.col(vertex).isNotNull() & F.col(key).isNotNull()).select(F.col(vertex).alias("b"), F.col(key).alias("k")).distinct()
    hubs = pairs.groupBy("k").agg(F.min("b").alias("a"), F.max("b").alias("z")).where("a < z").select("k", "a")
    return pairs.join(hubs, "k").where("a < b").select("a", "b").distinct()


def _coin(v: str, round_: int, seed: int) -> Column:
    return F.pmod(F.shiftright(F.xxhash64(F.col(v), F.lit(round_), F.lit(seed)), 17), F.lit(2))


def components(edges: DataFrame, *, seed: int = 7, max_rounds: int = 400) -> DataFrame:
    """Labels (v, root) of every vertex that has an edge; ``root`` is the smallest vertex of its component."""
    edge = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    vertices = materialize(edge.select(F.col("a").alias("v")).union(edge.select("b")).distinct(), "vertices")
    collapses: list[DataFrame] = []
    for number in range(max_rounds):
        if edge.isEmpty():
            break
        both = edge.union(edge.select("b", "a"))
        mates = both.where((_coin("a", number, seed) == 0) & (_coin("b", number, seed) == 1))
        into = materialize(mates.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("parent")), "collapse")
        collapses.append(into)
        new = edge
        for side in ("a", "b"):
            new = new.join(into.withColumnRenamed("v", side), side, "left").withColumn(side, F.coalesce("parent", side)).drop("parent")
        done, edge = edge, materialize(new.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        discard(done)
    else:
        raise RuntimeError("edges remain; raise max_rounds")
    label: DataFrame | None = None
    for number, into in enumerate(reversed(collapses)):
        own = into.select("v", F.col("parent").alias("root"))
        if label is not None:
            up = label.select(F.col("v").alias("parent"), F.col("root").alias("top"))
            own = into.join(up, "parent", "left").select("v", F.coalesce("top", "parent").alias("root")).unionByName(label)
        label = materialize(own, "labels") if number % 4 == 3 else own
    if label is None:
        return vertices.select("v", F.col("v").alias("root"))
    named = vertices.join(label, "v", "left").select("v", F.coalesce("root", "v").alias("top"))
    least = named.groupBy("top").agg(F.min("v").alias("root"))
    return named.join(least, "top").select("v", "root")


def membership(labels: DataFrame) -> DataFrame:
    """(v, root, size) of every vertex: its class and how many the class holds; no pairs."""
    return labels.join(labels.groupBy("root").agg(F.count("*").alias("size")), "root").select("v", "root", "size")


def linked_pairs(labels: DataFrame) -> DataFrame:
    """Every pair (a, b), a < b, of one component."""
    return labels.select(F.col("v").alias("a"), "root").join(labels.select(F.col("v").alias("b"), "root"), "root").where("a < b").select("a", "b")


def record_units(rows: DataFrame, row_id: str, vertex: str, key: str, *, seed: int = 7) -> DataFrame:
    """``rows`` with ``unit``: what must not be cut.

    Records with a vertex take its component's root. Records without take the
    unit of any vertex that shares their key, else the key, else themselves.
    """
    labels = components(shared_key_edges(rows, vertex, key), seed=seed)
    pairs = rows.where(F.col(vertex).isNotNull() & F.col(key).isNotNull())
    keyed = pairs.groupBy(F.col(key).alias("__k")).agg(F.min(vertex).alias("__kv"))
    lone = rows.where(F.col(vertex).isNull()).join(keyed, F.col(key) == F.col("__k"), "left").withColumn("__v", F.col("__kv")).drop("__k", "__kv")
    both = rows.where(F.col(vertex).isNotNull()).withColumn("__v", F.col(vertex)).unionByName(lone)
    named = both.join(labels.select(F.col("v").alias("__v"), F.col("root").alias("__root")), "__v", "left")
    unit = F.coalesce(F.concat(F.lit("v:"), F.coalesce("__root", "__v")), F.concat(F.lit("k:"), F.col(key)), F.concat(F.lit("r:"), F.col(row_id).cast("string")))
    return named.withColumn("unit", unit).drop("__v", "__root")


def assign_splits(units: DataFrame, *, parts: tuple[tuple[str, float], ...] = SPLITS, seed: int = 7) -> DataFrame:
    """``units`` (unit, stratum, weight) with ``split``."""
    size = F.lit(64) - F.length(F.bin(F.col("weight").cast("long")))  # exact at powers of two
    placed = units.withColumn("__h", F.sha2(F.concat_ws("|", F.lit(seed), "unit"), 256)).withColumn("__b", size * 256 + F.conv(F.substring("__h", 1, 2), 16, 10).cast("int"))
    sums = placed.groupBy("stratum", "__b").agg(F.sum("weight").alias("__w"))
    by = W.partitionBy("stratum")
    sums = sums.select(
        "stratum", "__b", F.coalesce(F.sum("__w").over(by.orderBy("__b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__base"), F.sum("__w").over(by).alias("__all")
    )
    inside = F.sum("weight").over(W.partitionBy("stratum", "__b").orderBy("__h", "unit").rowsBetween(W.unboundedPreceding, 0))
    middle = (F.col("__base") + F.col("__in") - F.col("weight") / 2) / F.col("__all")
    choice, edge = F.lit(parts[-1][0]), 1.0
    for (name, _), (_, after) in zip(reversed(parts[:-1]), reversed(parts[1:])):
        edge -= after
        choice = F.when(middle < round(edge, 9), name).otherwise(choice)
    return placed.withColumn("__in", inside).join(sums, ["stratum", "__b"]).select("unit", "stratum", "weight", choice.alias("split"))

"""Metrics of scored binary labels and paired comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SLOTS = 4096


def binary_metrics(by: list[str], rows: DataFrame, *, threshold: float = 0.5, floor: float = 1e-15) -> DataFrame:
    """Confusion counts, precision, recall, F1, log loss, Brier, prevalence of (label, p)."""
    hit, y, p = F.col("p") >= threshold, F.col("label") == 1, F.least(F.greatest("p", F.lit(floor)), F.lit(1 - floor))
    c = rows.groupBy(*by).agg(
        F.count_if(hit & y).alias("tp"), F.count_if(hit & ~y).alias("fp"), F.count_if(~hit & y).alias("fn"), F.count_if(~hit & ~y).alias("tn"),
        F.avg(-F.log(F.when(y, p).otherwise(1 - p))).alias("log_loss"), F.avg(F.pow(F.col("p") - F.col("label"), F.lit(2.0))).alias("brier"), F.avg(F.col("label").cast("double")).alias("prevalence"),
    )
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    ratio = lambda a, b: F.when(b > 0, a / b)
    return c.withColumns({
        "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn), "specificity": ratio(tn, tn + fp), "balanced_accuracy": (ratio(tp, tp + fn) + ratio(tn, tn + fp)) / 2,
    })


def score_curve(rows: DataFrame) -> DataFrame:
    """Per distinct score: own positives and negatives, and those scored higher.

    Scores lie in [0, 1]. Running sums are two-level over ``SLOTS`` score
    slots, so no window holds all scores.
    """
    g = rows.groupBy("p").agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")).withColumn("slot", F.floor(F.col("p") * SLOTS).cast("int"))
    per = g.groupBy("slot").agg(F.sum("pos").alias("sp"), F.sum("neg").alias("sn"))
    above = W.orderBy(F.desc("slot")).rowsBetween(W.unboundedPreceding, -1)  # at most SLOTS + 1 rows
    base = per.select("slot", F.coalesce(F.sum("sp").over(above), F.lit(0)).alias("bp"), F.coalesce(F.sum("sn").over(above), F.lit(0)).alias("bn"))
    inside = W.partitionBy("slot").orderBy(F.desc("p")).rowsBetween(W.unboundedPreceding, -1)
    over = lambda c: F.coalesce(F.sum(c).over(inside), F.lit(0))
    return g.withColumns({"ip": over("pos"), "in": over("neg")}).join(F.broadcast(base), "slot").select("p", "pos", "neg", (F.col("bp") + F.col("ip")).alias("pos_above"), (F.col("bn") + F.col("in")).alias("neg_above"))


def ranking_metrics(curve: DataFrame) -> DataFrame:
    """ROC-AUC with ties half, and average precision with tied scores together."""
    pos, neg = F.sum("pos"), F.sum("neg")
    n_hit, n_all = F.col("pos_above") + F.col("pos"), F.col("pos_above") + F.col("pos") + F.col("neg_above") + F.col("neg")
    lower = F.col("neg_total") - F.col("neg_above") - F.col("neg") / 2
    t = curve.agg(neg.alias("x")).scalar()
    return curve.withColumn("neg_total", t).agg((F.sum(F.col("pos") * lower) / (pos * neg)).alias("roc_auc"), (F.sum(F.col("pos") * n_hit / n_all) / pos).alias("average_precision"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """Score cut with the highest F1; equal F1 prefers the higher cut."""
    tp, fp = F.col("pos_above") + F.col("pos"), F.col("neg_above") + F.col("neg")
    f1 = F.round(2 * tp / (F.col("pos_total") + tp + fp), 12)
    t = curve.agg(F.sum("pos")).scalar()
    return curve.withColumn("pos_total", t).withColumn("f1", f1).agg(F.max_by(F.struct("p", "f1"), F.struct("f1", "p")).alias("s")).select(F.col("s.p").alias("threshold"), "s.f1")


def calibration(rows: DataFrame, bins: int) -> DataFrame:
    """Rows, mean score and mean label of every bin, empty bins included."""
    g = rows.groupBy(F.least(F.lit(bins - 1), F.floor(F.col("p") * bins)).cast("long").alias("bin")).agg(F.count("*").alias("n"), F.avg("p").alias("mean_p"), F.avg(F.col("label").cast("double")).alias("mean_label"))
    return rows.sparkSession.range(bins).withColumnRenamed("id", "bin").join(g, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), "mean_p", "mean_label")


# 2^32 times the cumulative Poisson(1) probabilities of 0, 1, 2, ...
POISSON = (1580030168, 3160060337, 3950075421, 4213413783, 4279248373, 4292415291, 4294609777, 4294923276, 4294962463, 4294966817)


def cluster_bootstrap(clusters: DataFrame, reps: int) -> DataFrame:
    """Replicate means of a paired delta over clusters (g, total, n), both BIGINT.

    Each cluster counts in each replicate with a Poisson(1) weight drawn from
    the MD5 of both, so no draw is joined and a cluster's rows stay where they
    are: replicates are summed in the map stage and only their sums shuffled.
    """
    u = F.conv(F.substring(F.md5(F.concat_ws("|", "rep", "g")), 1, 8), 16, 10).cast("long")
    weight = sum(((u >= t).cast("long") for t in POISSON), F.lit(0).cast("long"))
    drawn = clusters.withColumn("rep", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(reps - 1).cast("long")))).withColumn("w", weight)
    return drawn.groupBy("rep").agg(F.sum(F.col("w") * F.col("total")).alias("t"), F.sum(F.col("w") * F.col("n")).alias("n")).select("rep", F.when(F.col("n") > 0, F.col("t") / F.col("n")).alias("mean"))


def fitted_line(n: Column, sums: dict[str, Column]) -> tuple[Column, Column, Column]:
    """Least squares of y on v, h and 1 from exact sums (BIGINT): (one, v, h) coefficients, null where they are not unique."""
    big = {k: c.cast("decimal(38,0)") for k, c in sums.items()}
    m = n.cast("decimal(38,0)")
    vv, hh, vh = (m * big[a + b] - big[a] * big[b] for a, b in (("v", "v"), ("h", "h"), ("v", "h")))
    vy, hy = (m * big[a + "y"] - big[a] * big["y"] for a in ("v", "h"))
    d = lambda c: c.cast("double")
    below = d(vv) * d(hh) - d(vh) * d(vh)
    b = F.when(below != 0, (d(vy) * d(hh) - d(hy) * d(vh)) / below)
    c = F.when(below != 0, (d(hy) * d(vv) - d(vy) * d(vh)) / below)
    return (d(sums["y"]) - b * d(sums["v"]) - c * d(sums["h"])) / d(n), b, c


def hash_rank(rows: DataFrame, key: Column, name: str) -> DataFrame:
    """1, 2, ... in the order of ``md5(key)``, two-level over 256 hash slots."""
    r = rows.withColumn("__m", F.md5(key.cast("string"))).withColumn("__s", F.substring("__m", 1, 2))
    base = r.groupBy("__s").agg(F.count("*").alias("__n")).select("__s", F.coalesce(F.sum("__n").over(W.orderBy("__s").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    return r.join(F.broadcast(base), "__s").withColumn(name, F.col("__base") + F.row_number().over(W.partitionBy("__s").orderBy("__m"))).drop("__m", "__s", "__base")

"""Actor metrics, inventory and evaluation metrics on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.clean import amount, ident
from tidemark.operators import evaluate as E
from tidemark.operators import metrics as M
from tidemark.operators.asof import DAY_US, micros, prior_totals
from tidemark.operators.features import clean_executions
from tidemark.plans.dealt import _EXEC
from tidemark.session import table


def _fills(spark: SparkSession, root: str) -> DataFrame:
    """actor, condition, side, time_us, shares, notional (DECIMAL) of good executions."""
    part = F.split("type", "/")
    x = clean_executions(table(spark, root, "executions")).where("shares IS NOT NULL AND time_us IS NOT NULL")
    return x.select("actor", part[0].alias("condition"), part[1].alias("side"), "time_us", "shares", F.col("notional").cast("decimal(34,20)").alias("notional"))


def actor_behaviour_known(spark: SparkSession, root: str) -> DataFrame:
    """Two-time rule: an execution counts from the later of its own and its known time."""
    rows = table(spark, root, "executions").where("time_us IS NOT NULL AND known_us IS NOT NULL").select(ident(F.col("actor")).alias("actor"), "execution_id", "time_us", F.greatest("time_us", "known_us").alias("ready_us"), amount(F.col("shares"), 20, 8).alias("shares")).dropna(subset=["actor", "execution_id"])
    one = rows.groupBy("actor", "execution_id").agg(F.min(F.struct("time_us", "ready_us", "shares")).alias("s")).select("actor", "execution_id", "s.*")
    ready = one.select("actor", F.col("ready_us").alias("time_us"), F.coalesce("shares", F.lit(0)).alias("v"))
    got = prior_totals(one.select("actor", "execution_id", "time_us"), ready, ["actor"], "time_us", {"n_known": F.lit(1).cast("long"), "shares_known": F.col("v")})
    return got.select("actor", "execution_id", "n_known", F.col("shares_known").cast("decimal(38,8)").cast("string").alias("shares_known"))


def activity_summary(spark: SparkSession, root: str) -> DataFrame:
    """Counts, markets and mean notionals by side, exact decimals to 6 places half to even."""
    mean = lambda s: F.bround(F.avg(F.when(F.col("side") == s, F.col("notional"))), 6).cast("double")
    return _fills(spark, root).groupBy("actor").agg(F.count("*").alias("n"), F.countDistinct("condition").alias("n_markets"), mean("BUY").alias("mean_buy"), mean("SELL").alias("mean_sell"), F.min("time_us").alias("first_us"), F.max("time_us").alias("last_us"))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Average-cost inventory per actor and condition after all fills."""
    inv = M.average_cost_inventory(_fills(spark, root), F.concat_ws("/", "actor", "condition"))
    return inv.select("key", *[F.round(c, 6).alias(c) for c in ("quantity", "cost", "realised")], "reason")


def vwap_by_instant(spark: SparkSession, root: str) -> DataFrame:
    """Volume-weighted price per condition and instant, exact to 12 places half to even."""
    return M.vwap(_fills(spark, root), ["condition", "time_us"])


def payoff_fields(spark: SparkSession, root: str) -> DataFrame:
    """Payoff of every fill if the outcome is yes or no, and their totals per actor, exact."""
    f = _fills(spark, root)
    sign = F.when(F.col("side") == "BUY", F.lit(1)).otherwise(F.lit(-1))
    yes, no = (F.col("shares") - F.col("notional")) * sign, -F.col("notional") * sign
    text = lambda c: F.sum(c).cast("decimal(38,12)").cast("string")
    return f.groupBy("actor", "condition").agg(text(yes).alias("if_yes"), text(no).alias("if_no"), F.count("*").alias("n"), F.count_if(yes > 0).alias("n_gain_if_yes"), F.count_if(no > 0).alias("n_gain_if_no"))


def _scored(spark: SparkSession, root: str) -> DataFrame:
    """Deterministic scores in [0, 1] with ties, labels and groups from the events."""
    return table(spark, root, "events").select("event_id", F.col("user_id").alias("g"), (F.col("event_type") == "purchase").cast("int").alias("label"), (F.pmod(F.col("event_id") * 7919, F.lit(1009)) / F.lit(1008.0)).alias("p"))


def binary_report(spark: SparkSession, root: str) -> DataFrame:
    """Confusion and probability metrics over all rows."""
    m = E.binary_metrics([], _scored(spark, root))
    return m.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in m.dtypes])


def ranking_report(spark: SparkSession, root: str) -> DataFrame:
    """ROC-AUC with ties half and average precision."""
    m = E.ranking_metrics(E.score_curve(_scored(spark, root)))
    return m.select(F.round("roc_auc", 9).alias("roc_auc"), F.round("average_precision", 9).alias("average_precision"))


def calibration_bins(spark: SparkSession, root: str) -> DataFrame:
    """Fifteen calibration bins."""
    c = E.calibration(_scored(spark, root), 15)
    return c.select("bin", "n", F.round("mean_p", 9).alias("mean_p"), F.round("mean_label", 9).alias("mean_label"))


def calibration_error(spark: SparkSession, root: str) -> DataFrame:
    """Expected calibration error over ten bins."""
    c = E.calibration(_scored(spark, root), 10)
    return c.agg(F.round(F.sum(F.col("n") * F.abs(F.col("mean_p") - F.col("mean_label"))) / F.sum("n"), 9).alias("ece"), F.sum("n").alias("n"))


def grouped_report(spark: SparkSession, root: str) -> DataFrame:
    """Mean of per-group metrics, unknown ones ignored."""
    m = E.binary_metrics(["g"], _scored(spark, root), threshold=0.8)
    return m.agg(*[F.round(F.avg(c), 9).alias(f"macro_{c}") for c in ("precision", "recall", "f1", "balanced_accuracy", "brier")], F.count("*").alias("n_groups"))


def threshold_choice(spark: SparkSession, root: str) -> DataFrame:
    """F1-optimal cut, ties to the higher."""
    t = E.best_threshold(E.score_curve(_scored(spark, root)))
    return t.select(F.round("threshold", 9).alias("threshold"), F.round("f1", 9).alias("f1"))


def paired_bootstrap(spark: SparkSession, root: str) -> DataFrame:
    """Percentile interval of a paired delta over 2,000 Poisson draws of clusters (A23). Scores count in whole 5,040ths."""
    s = table(spark, root, "events").where("user_id IS NOT NULL").select(F.col("user_id").alias("g"), F.coalesce((F.col("event_type") == "purchase").cast("long"), F.lit(0)).alias("y"), (F.pmod(F.col("event_id") * 7919, F.lit(1009)) * 5).alias("p"))
    c = s.groupBy("g").agg(F.sum(F.abs(F.col("p") - F.col("y") * 5040) - F.abs(1008 - F.col("y") * 5040)).alias("total"), F.count("*").alias("n"))
    b = E.cluster_bootstrap(c, 2000)
    low, high = (F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY mean)") for q in (0.025, 0.975))
    return b.agg((low / 5040).alias("low"), (high / 5040).alias("high"), F.count("mean").alias("reps"))


def permutation_importance(spark: SparkSession, root: str) -> DataFrame:
    """Rise of the squared error of a fitted line when one feature, or both, are shuffled by a seeded hash, ranked (A29, TK10).

    The line is trained on all rows from exact sums; shuffled errors come from
    the sums of shuffled products, so no prediction is written.
    """
    x = table(spark, root, "events").where("value IS NOT NULL AND ts IS NOT NULL").select("event_id", F.coalesce((F.col("event_type") == "purchase").cast("long"), F.lit(0)).alias("y"), F.round(F.col("value") * 100).cast("long").alias("v"), F.pmod(F.floor(micros("ts") / 3_600_000_000), F.lit(24)).cast("long").alias("h"))
    a = E.hash_rank(x, F.concat(F.lit("a"), F.col("event_id")), "r")
    b = E.hash_rank(x.select("event_id", F.col("v").alias("v2"), F.col("h").alias("h2")), F.concat(F.lit("b"), F.col("event_id")), "r").drop("event_id")
    pairs = {"v": ("v",), "h": ("h",), "y": ("y",), "vv": ("v", "v"), "hh": ("h", "h"), "vh": ("v", "h"), "vy": ("v", "y"), "hy": ("h", "y"), "v2y": ("v2", "y"), "h2y": ("h2", "y"), "v2h": ("v2", "h"), "vh2": ("v", "h2"), "v2h2": ("v2", "h2")}
    s = a.join(b, "r").agg(F.count("*").alias("n"), *[F.sum(F.col(k[0]) * F.col(k[1]) if len(k) > 1 else F.col(k[0])).alias(name) for name, k in pairs.items()])
    c = {k: F.col(k) for k in pairs}
    one, bv, bh = E.fitted_line(F.col("n"), c)
    s = s.withColumns({"c0": one, "c1": bv, "c2": bh})
    d = lambda k: F.col(k).cast("double")

    def error(vy: str, hy: str, vh: str) -> F.Column:
        c0, c1, c2 = F.col("c0"), F.col("c1"), F.col("c2")
        cross = c0 * d("y") + c1 * d(vy) + c2 * d(hy)
        square = d("n") * c0 * c0 + c1 * c1 * d("vv") + c2 * c2 * d("hh") + 2 * c0 * c1 * d("v") + 2 * c0 * c2 * d("h") + 2 * c1 * c2 * d(vh)
        return (d("y") - 2 * cross + square) / d("n")

    base = error("vy", "hy", "vh")
    rise = [("value", error("v2y", "hy", "v2h") - base), ("hour", error("vy", "h2y", "vh2") - base), ("both", error("v2y", "h2y", "v2h2") - base)]
    out = s.select(F.explode(F.array(*[F.struct(F.lit(k).alias("feature"), F.round(r, 9).alias("importance")) for k, r in rise])).alias("x")).select("x.*")
    return out.withColumn("place", F.row_number().over(W.orderBy(F.desc("importance"), "feature")).cast("long"))  # three rows


def feature_coverage(spark: SparkSession, root: str) -> DataFrame:
    """Present, missing, least and largest of every column in one pass; constants marked."""
    l = table(spark, root, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    one = l.agg(*[F.struct(F.count(c).alias("present"), F.count_if(F.col(c).isNull()).alias("missing"), (F.min(c) + 0.0).alias("least"), (F.max(c) + 0.0).alias("most")).alias(c) for c in cols])
    u = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("s")) for c in cols])).alias("x"))
    return u.select("x.feature", "x.s.*").withColumn("usable", (F.col("present") > 0) & (F.col("least") < F.col("most")))


def merged_records(spark: SparkSession, root: str) -> DataFrame:
    """Repeated deliveries merged: first non-null field by row id, sources united (A16, SF20)."""
    t = table(spark, root, "trades").select(ident(F.col("observation_id")).alias("m"), "trade_row_id", "wallet", "price", "selection", F.col("source_page_id").cast("string").alias("page")).dropna(subset=["m"])
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("trade_row_id")))
    return t.groupBy("m").agg(first("wallet").alias("wallet"), first("price").alias("price"), first("selection").alias("selection"), F.array_join(F.array_sort(F.collect_set("page")), ",").alias("pages"), F.count("*").alias("n")).where("n > 1")


def size_quantiles(spark: SparkSession, root: str) -> DataFrame:
    """Nearest-rank quantiles and the upper median from a weighted histogram."""
    d = table(spark, root, "documents").where("text IS NOT NULL").select(F.lower(F.trim("lang")).alias("lang"), F.size(F.filter(F.split("text", " "), lambda w: w != "")).alias("words"))
    h = d.groupBy("lang", "words").agg(F.count("*").alias("w"))
    by = W.partitionBy("lang")
    c = h.withColumns({"c": F.sum("w").over(by.orderBy("words")), "n": F.sum("w").over(by)})
    q = lambda x: F.min(F.when(F.col("c") >= F.ceil(F.col("n") * x), F.col("words"))).cast("long")
    return c.groupBy("lang").agg(F.max("n").alias("n"), F.sum(F.col("w") * F.col("words")).cast("long").alias("total"), q(0.5).alias("p50"), q(0.95).alias("p95"), q(0.99).alias("p99"), F.min(F.when(F.col("c") > F.floor(F.col("n") / 2), F.col("words"))).cast("long").alias("upper_median"), F.max("words").cast("long").alias("most"))


def basket_match(spark: SparkSession, root: str) -> DataFrame:
    """Multisets of line quantities of paired orders: exact, size-only, and mean difference."""
    l = table(spark, root, "lineitem").select("l_orderkey", F.col("l_quantity").alias("q"))
    b = l.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("q")).alias("a"))
    nxt = b.select((F.col("l_orderkey") - 1).alias("l_orderkey"), F.col("a").alias("b"))
    j = b.join(nxt, "l_orderkey")
    diff = F.aggregate(F.zip_with("a", "b", lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x) / F.size("a")
    same = F.size("a") == F.size("b")
    return j.agg(F.count("*").alias("n_pairs"), F.count_if(same).alias("n_same_size"), F.count_if(F.col("a") == F.col("b")).alias("n_equal"), F.round(F.avg(F.when(same, diff)), 9).alias("mean_abs"))


def scenario_grid(spark: SparkSession, root: str) -> DataFrame:
    """Time and storage for lists of rates and sizes."""
    n = table(spark, root, "trades").agg(F.count("*").alias("n"), F.countDistinct("wallet").alias("w"))
    g = n.withColumn("rate", F.explode(F.array(*[F.lit(x) for x in (100, 1000, 10000)]))).withColumn("bytes", F.explode(F.array(*[F.lit(x) for x in (500, 767, 1000)])))
    return g.select("rate", "bytes", F.round(F.col("n") / F.col("rate"), 6).alias("seconds"), (F.col("n") * F.col("bytes")).alias("storage"), F.round(F.try_divide(F.col("n"), F.col("w")), 6).alias("per_wallet"))


def loss_series(spark: SparkSession, root: str) -> DataFrame:
    """Latest value of each step, without steps abandoned by a later resume.

    Error events are resume markers, view events log a step (hour of the
    month). A logged step is abandoned if a later marker resumes before it:
    one running minimum from the end of the log.
    """
    e = table(spark, root, "events").where("event_type IN ('view', 'error')").select("event_id", "user_id", "event_type", "value", F.pmod(F.floor(micros("ts") / 3_600_000_000), F.lit(168)).cast("long").alias("step"))
    later = W.partitionBy("user_id").orderBy(F.desc("event_id")).rangeBetween(W.unboundedPreceding, -1)
    resumed = F.min(F.when(F.col("event_type") == "error", F.col("step"))).over(later)
    kept = e.withColumn("resumed", resumed).where("event_type = 'view' AND (resumed IS NULL OR resumed >= step)")
    return kept.groupBy("user_id", "step").agg(F.max_by("value", "event_id").alias("value"))


QUERIES = {
    f.__name__: f
    for f in (
        actor_behaviour_known, activity_summary, inventory, vwap_by_instant, payoff_fields, binary_report, ranking_report, calibration_bins, calibration_error,
        grouped_report, threshold_choice, paired_bootstrap, permutation_importance, feature_coverage, merged_records, size_quantiles, basket_match, scenario_grid, loss_series,
    )
}

_WS = "' ' || chr(9) || chr(10) || chr(13)"


def _id(c: str) -> str:
    return f"lower(trim({c}, {_WS}))"


_X = _EXEC + """, x AS (SELECT actor, split_part(type, '/', 1) AS condition, split_part(type, '/', 2) AS side, time_us, shares, notional::decimal(34, 20) AS notional FROM good WHERE shares IS NOT NULL AND time_us IS NOT NULL)
"""


def _half_even(top: str, bottom: str) -> str:
    """Quotient of two whole numbers, rounded half to even."""
    return f"(({top}) // ({bottom}) + CASE WHEN 2 * (({top}) % ({bottom})) > ({bottom}) OR (2 * (({top}) % ({bottom})) = ({bottom}) AND (({top}) // ({bottom})) % 2 = 1) THEN 1 ELSE 0 END)"


def _units(c: str) -> str:
    return f"replace(({c})::varchar, '.', '')::hugeint"


_S = "s AS (SELECT event_id, user_id AS g, (event_type = 'purchase')::int AS label, ((event_id * 7919) % 1009) / 1008.0 AS p FROM events)"
_CURVE = f"WITH {_S}, k AS (SELECT p, sum(label)::double AS pos, sum(1 - label)::double AS neg FROM s GROUP BY p), v AS (SELECT *, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn FROM k)"


def _binary(by: str, cut: float) -> str:
    return f"""SELECT {by} count(*) FILTER (WHERE p >= {cut} AND label = 1) AS tp, count(*) FILTER (WHERE p >= {cut} AND label = 0) AS fp, count(*) FILTER (WHERE p < {cut} AND label = 1) AS fn, count(*) FILTER (WHERE p < {cut} AND label = 0) AS tn,
 avg(-ln(CASE WHEN label = 1 THEN greatest(least(p, 1 - 1e-15), 1e-15) ELSE 1 - greatest(least(p, 1 - 1e-15), 1e-15) END)) AS log_loss, avg((p - label) * (p - label)) AS brier, avg(label) AS prevalence FROM s {'GROUP BY ' + by.rstrip(', ') if by else ''}"""


_RATES = "tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall, 2 * tp / nullif(2 * tp + fp + fn, 0) AS f1, tn / nullif(tn + fp, 0) AS specificity, (tp / nullif(tp + fn, 0) + tn / nullif(tn + fp, 0)) / 2 AS balanced_accuracy"

ORACLE = {
    "actor_behaviour_known": f"""WITH r AS (SELECT {_id('actor')} AS actor, execution_id, time_us, greatest(time_us, known_us) AS ready, try_cast(trim(shares, {_WS}) AS decimal(20, 8)) AS v FROM executions WHERE time_us IS NOT NULL AND known_us IS NOT NULL AND actor IS NOT NULL AND execution_id IS NOT NULL),
o AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY actor, execution_id ORDER BY time_us, ready, v NULLS FIRST) = 1)
SELECT a.actor, a.execution_id, count(b.actor) AS n_known, coalesce(sum(b.v), 0)::decimal(38, 8)::varchar AS shares_known FROM o a LEFT JOIN o b ON a.actor = b.actor AND b.ready < a.time_us GROUP BY 1, 2""",
    "activity_summary": _X + f"""SELECT actor, count(*) AS n, count(DISTINCT condition) AS n_markets, {_half_even(_units("sum(notional) FILTER (WHERE side = 'BUY')"), "count(*) FILTER (WHERE side = 'BUY') * 100000000000000::hugeint")}::double / 1e6 AS mean_buy,
 {_half_even(_units("sum(notional) FILTER (WHERE side = 'SELL')"), "count(*) FILTER (WHERE side = 'SELL') * 100000000000000::hugeint")}::double / 1e6 AS mean_sell, min(time_us) AS first_us, max(time_us) AS last_us FROM x GROUP BY 1""",
    "inventory": _X.replace("\nWITH raw", "\nWITH RECURSIVE raw") + """, g AS (SELECT actor || '/' || condition AS key, time_us, coalesce(sum(shares) FILTER (WHERE side = 'BUY'), 0)::decimal(38, 10)::double AS b, coalesce(sum(notional) FILTER (WHERE side = 'BUY'), 0)::decimal(38, 10)::double AS v, coalesce(sum(shares) FILTER (WHERE side = 'SELL'), 0)::decimal(38, 10)::double AS s, coalesce(sum(notional) FILTER (WHERE side = 'SELL'), 0)::decimal(38, 10)::double AS w FROM x GROUP BY 1, 2),
n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY time_us) AS i, count(*) OVER (PARTITION BY key) AS m FROM g),
f(key, i, q, c, r, ok, flat) AS (SELECT DISTINCT key, 0::bigint, 0.0::double, 0.0::double, 0.0::double, true, true FROM n UNION ALL
 SELECT key, i, CASE WHEN z THEN 0 ELSE q1 END, CASE WHEN z THEN 0 ELSE c1 END, CASE WHEN z AND NOT fl THEN 0 ELSE r1 END, k1, fl OR z FROM (
  SELECT *, k1 AND abs(q1) <= 1e-9 AS z FROM (SELECT n.key, n.i, f.flat AND NOT (n.b > 0 AND n.s > 0) AS fl, f.ok AND n.s <= f.q + n.b + 1e-9 AS k1,
   f.q + n.b - CASE WHEN n.s <= f.q + n.b + 1e-9 THEN n.s ELSE 0 END AS q1, f.c + n.v - CASE WHEN n.s > 0 AND n.s <= f.q + n.b + 1e-9 THEN (f.c + n.v) * n.s / (f.q + n.b) ELSE 0 END AS c1,
   f.r + CASE WHEN n.s > 0 AND n.s <= f.q + n.b + 1e-9 THEN n.w - (f.c + n.v) * n.s / (f.q + n.b) ELSE 0 END AS r1 FROM f JOIN n ON n.key = f.key AND n.i = f.i + 1)))
SELECT f.key, round(CASE WHEN ok THEN q END, 6) AS quantity, round(CASE WHEN ok AND flat THEN c END, 6) AS cost, round(CASE WHEN ok AND flat THEN r END, 6) AS realised, CASE WHEN NOT ok THEN 'oversold' WHEN NOT flat THEN 'mixed_tie' END AS reason FROM f JOIN (SELECT key, max(m) AS m FROM n GROUP BY 1) e ON f.key = e.key AND f.i = e.m""",
    "vwap_by_instant": _X + f"SELECT condition, time_us, {_half_even(_units('sum(notional)::decimal(38, 20)'), _units('sum(shares)::decimal(38, 8)'))}::double / 1e12 AS vwap, sum(shares)::decimal(38, 8)::varchar AS shares FROM x GROUP BY 1, 2",
    "payoff_fields": _X + """SELECT actor, condition, sum(CASE WHEN side = 'BUY' THEN shares - notional ELSE notional - shares END)::decimal(38, 12)::varchar AS if_yes, sum(CASE WHEN side = 'BUY' THEN -notional ELSE notional END)::decimal(38, 12)::varchar AS if_no, count(*) AS n,
 count(*) FILTER (WHERE (side = 'BUY' AND shares > notional) OR (side = 'SELL' AND notional > shares)) AS n_gain_if_yes, count(*) FILTER (WHERE side = 'SELL' AND notional > 0) AS n_gain_if_no FROM x GROUP BY 1, 2""",
    "binary_report": f"WITH {_S}, m AS ({_binary('', 0.5)}) SELECT tp, fp, fn, tn, round(log_loss, 9) AS log_loss, round(brier, 9) AS brier, round(prevalence, 9) AS prevalence, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, round(specificity, 9) AS specificity, round(balanced_accuracy, 9) AS balanced_accuracy FROM (SELECT *, {_RATES} FROM m)",
    "ranking_report": _CURVE + " SELECT round(sum(pos * (nn - fp + neg / 2)) / (max(np) * max(nn)), 9) AS roc_auc, round(sum(pos * tp / (tp + fp)) / max(np), 9) AS average_precision FROM v",
    "calibration_bins": f"WITH {_S}, k AS (SELECT least(14, floor(p * 15)::bigint) AS bin, count(*) AS n, avg(p) AS a, avg(label) AS b FROM s GROUP BY 1) SELECT r.bin, coalesce(n, 0) AS n, round(a, 9) AS mean_p, round(b, 9) AS mean_label FROM (SELECT unnest(range(15)) AS bin) r LEFT JOIN k USING (bin)",
    "calibration_error": f"WITH {_S}, k AS (SELECT least(9, floor(p * 10)::bigint) AS bin, count(*) AS n, avg(p) AS a, avg(label) AS b FROM s GROUP BY 1) SELECT round(sum(n * abs(a - b)) / sum(n), 9) AS ece, sum(n)::bigint AS n FROM k",
    "grouped_report": f"WITH {_S}, m AS ({_binary('g, ', 0.8)}) SELECT round(avg(precision), 9) AS macro_precision, round(avg(recall), 9) AS macro_recall, round(avg(f1), 9) AS macro_f1, round(avg(balanced_accuracy), 9) AS macro_balanced_accuracy, round(avg(brier), 9) AS macro_brier, count(*) AS n_groups FROM (SELECT *, {_RATES} FROM m)",
    "threshold_choice": _CURVE + ", f AS (SELECT p, round(2 * tp / (np + tp + fp), 12) AS f1 FROM v) SELECT round(p, 9) AS threshold, round(f1, 9) AS f1 FROM f ORDER BY f.f1 DESC, p DESC LIMIT 1",
    "paired_bootstrap": f"""WITH s AS (SELECT user_id AS g, coalesce((event_type = 'purchase')::bigint, 0) AS y, (event_id * 7919) % 1009 * 5 AS p FROM events WHERE user_id IS NOT NULL), c AS (SELECT g, sum(abs(p - y * 5040) - abs(1008 - y * 5040))::bigint AS t, count(*) AS n FROM s GROUP BY 1),
d AS (SELECT rep, t, n, ('0x' || substr(md5(rep || '|' || g), 1, 8))::bigint AS u FROM c, (SELECT unnest(range(2000)) AS rep)), w AS (SELECT rep, t, n, {' + '.join(f"(u >= {x})::bigint" for x in E.POISSON)} AS w FROM d),
m AS (SELECT rep, CASE WHEN sum(w * n) > 0 THEN sum(w * t)::bigint / sum(w * n)::bigint END AS mean FROM w GROUP BY 1) SELECT quantile_disc(mean, 0.025) / 5040 AS low, quantile_disc(mean, 0.975) / 5040 AS high, count(mean) AS reps FROM m""",
    "permutation_importance": """WITH x AS (SELECT event_id, coalesce((event_type = 'purchase')::bigint, 0) AS y, round(value * 100)::bigint AS v, (epoch_us(ts) // 3600000000) % 24 AS h FROM events WHERE value IS NOT NULL AND ts IS NOT NULL),
a AS (SELECT *, row_number() OVER (ORDER BY md5('a' || event_id)) AS r FROM x), b AS (SELECT v AS v2, h AS h2, row_number() OVER (ORDER BY md5('b' || event_id)) AS r FROM x),
s AS (SELECT count(*)::hugeint AS n, sum(v)::hugeint AS v, sum(h)::hugeint AS h, sum(y)::hugeint AS y, sum(v * v)::hugeint AS vv, sum(h * h)::hugeint AS hh, sum(v * h)::hugeint AS vh, sum(v * y)::hugeint AS vy, sum(h * y)::hugeint AS hy, sum(v2 * y)::hugeint AS v2y, sum(h2 * y)::hugeint AS h2y, sum(v2 * h)::hugeint AS v2h, sum(v * h2)::hugeint AS vh2, sum(v2 * h2)::hugeint AS v2h2 FROM a JOIN b USING (r)),
d AS (SELECT *, (n * vv - v * v)::double AS dvv, (n * hh - h * h)::double AS dhh, (n * vh - v * h)::double AS dvh, (n * vy - v * y)::double AS dvy, (n * hy - h * y)::double AS dhy FROM s), c AS (SELECT *, (dvy * dhh - dhy * dvh) / (dvv * dhh - dvh * dvh) AS c1, (dhy * dvv - dvy * dvh) / (dvv * dhh - dvh * dvh) AS c2 FROM d),
k AS (SELECT *, (y::double - c1 * v::double - c2 * h::double) / n::double AS c0 FROM c), q AS (SELECT *, n * c0 * c0 + c1 * c1 * vv + c2 * c2 * hh + 2 * c0 * c1 * v + 2 * c0 * c2 * h AS sq FROM k),
e AS (SELECT (y - 2 * (c0 * y + c1 * vy + c2 * hy) + sq + 2 * c1 * c2 * vh) / n AS e0, (y - 2 * (c0 * y + c1 * v2y + c2 * hy) + sq + 2 * c1 * c2 * v2h) / n AS e1, (y - 2 * (c0 * y + c1 * vy + c2 * h2y) + sq + 2 * c1 * c2 * vh2) / n AS e2, (y - 2 * (c0 * y + c1 * v2y + c2 * h2y) + sq + 2 * c1 * c2 * v2h2) / n AS e3 FROM q),
r AS (SELECT 'value' AS feature, round(e1 - e0, 9) AS importance FROM e UNION ALL SELECT 'hour', round(e2 - e0, 9) FROM e UNION ALL SELECT 'both', round(e3 - e0, 9) FROM e) SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, feature) AS place FROM r""",
    "feature_coverage": " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS present, count(*) - count({c}) AS missing, min({c}) + 0.0 AS least, max({c}) + 0.0 AS most, min({c}) < max({c}) AS usable FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
    "merged_records": f"""SELECT {_id('observation_id')} AS m, arg_min(wallet, trade_row_id) FILTER (WHERE wallet IS NOT NULL) AS wallet, arg_min(price, trade_row_id) FILTER (WHERE price IS NOT NULL) AS price, arg_min(selection, trade_row_id) FILTER (WHERE selection IS NOT NULL) AS selection,
 coalesce(string_agg(DISTINCT source_page_id::varchar, ',' ORDER BY source_page_id::varchar), '') AS pages, count(*) AS n FROM trades WHERE observation_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "size_quantiles": """WITH d AS (SELECT lower(trim(lang)) AS lang, len(list_filter(string_split(text, ' '), lambda w: w <> '')) AS words FROM documents WHERE text IS NOT NULL)
SELECT lang, count(*) AS n, sum(words)::bigint AS total, quantile_disc(words, 0.5)::bigint AS p50, quantile_disc(words, 0.95)::bigint AS p95, quantile_disc(words, 0.99)::bigint AS p99, list_sort(list(words))[count(*) // 2 + 1]::bigint AS upper_median, max(words)::bigint AS most FROM d GROUP BY 1""",
    "basket_match": """WITH b AS (SELECT l_orderkey, list_sort(list(l_quantity)) AS a FROM lineitem GROUP BY 1), j AS (SELECT x.a, y.a AS b FROM b x JOIN b y ON y.l_orderkey = x.l_orderkey + 1)
SELECT count(*) AS n_pairs, count(*) FILTER (WHERE len(a) = len(b)) AS n_same_size, count(*) FILTER (WHERE a = b) AS n_equal, round(avg(list_sum(list_transform(list_zip(a, b), lambda z: abs(z[1] - z[2]))) / len(a)) FILTER (WHERE len(a) = len(b)), 9) AS mean_abs FROM j""",
    "scenario_grid": """WITH n AS (SELECT count(*) AS n, count(DISTINCT wallet) AS w FROM trades) SELECT rate, bytes, round(n / rate, 6) AS seconds, n * bytes AS storage, round(n / w, 6) AS per_wallet FROM n, (SELECT unnest([100, 1000, 10000]) AS rate), (SELECT unnest([500, 767, 1000]) AS bytes)""",
    "loss_series": """WITH e AS (SELECT event_id, user_id, event_type, value, (epoch_us(ts) // 3600000000) % 168 AS step FROM events)
SELECT user_id, step, arg_max(value, event_id) AS value FROM e s WHERE event_type = 'view' AND NOT EXISTS (SELECT 1 FROM e m WHERE m.event_type = 'error' AND m.user_id = s.user_id AND m.event_id > s.event_id AND m.step < s.step) GROUP BY 1, 2""",
}

"""As-of joins, prior counts, windows and labels on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.clean import epoch_us, ident, outer_trim, unit_price
from tidemark.operators.asof import DAY_US, asof_prior, fresh, micros, next_frame, prior_frame, prior_rank, prior_totals, with_halo
from tidemark.operators.ledgers import cents
from tidemark.session import table

SEC = 1_000_000


def events(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").select("event_id", "user_id", "event_type", "value", micros("ts").alias("t"))


def orders(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", micros("o_orderdate").alias("t"))


def prices(spark: SparkSession, root: str) -> DataFrame:
    """Usable points: token, t in microseconds, price."""
    return table(spark, root, "price_history").select("point_id", outer_trim(F.col("token_id")).alias("token"), epoch_us(F.col("t")).alias("t"), unit_price(F.col("p")).alias("price")).dropna(subset=["price"])


def asof_prior_purchase(spark: SparkSession, root: str) -> DataFrame:
    """Flagship: context of every purchase by time blocks; of several earlier events at one instant the largest id counts."""
    e = events(spark, root).select("event_id", "user_id", "event_type", "t")
    line = with_halo(e, ["user_id"], "t", back_us=3600 * SEC, ahead_us=300 * SEC)
    by = ["user_id", "__b"]
    flat = line.select(
        "event_id", "user_id", "event_type", "t", "__own", *[F.count("*").over(prior_frame(by, "t", s * SEC)).alias(f"n_{s}s") for s in (300, 900, 3600)],
        (F.count("*").over(next_frame(by, "t", 300 * SEC)) > 1).alias("active_next_300s"),
    )
    got = asof_prior(flat.where("__own AND event_type = 'purchase'").drop("__own", "event_type"), e, ["user_id"], "t", ["event_type", "event_id"], tie=["event_id"])
    return got.select("event_id", "user_id", F.col("prior_event_type").alias("prior_type"), "prior_event_id", (F.col("t") - F.col("prior_t")).alias("age_us"), "n_300s", "n_900s", "n_3600s", "active_next_300s")


def asof_join_events(spark: SparkSession, root: str) -> DataFrame:
    """Latest strictly earlier purchase of the user for every click."""
    e = events(spark, root)
    got = asof_prior(e.where("event_type = 'click'").select("event_id", "user_id", "t"), e.where("event_type = 'purchase'"), ["user_id"], "t", ["value", "event_id"], tie=["event_id"])
    return got.select("event_id", "user_id", "prior_t", "prior_value", "prior_event_id")


def _trade_probes(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "trades").select("trade_row_id", outer_trim(F.col("token_id")).alias("token"), F.col("query_us").alias("t"))


def asof_price_staleness(spark: SparkSession, root: str) -> DataFrame:
    """Price known before each trade if at most 300 s old, else the reason."""
    got = asof_prior(_trade_probes(spark, root), prices(spark, root), ["token"], "t", ["price"], block_us=7 * DAY_US)
    price, why = fresh("prior_price", "prior_t", "t", 300 * SEC)
    return got.select("trade_row_id", price.alias("price"), (F.col("t") - F.col("prior_t")).alias("age_us"), why.alias("reason"))


def price_change_lookback(spark: SparkSession, root: str) -> DataFrame:
    """Change of the known price over 300 and 900 s: two further as-ofs."""
    got = _trade_probes(spark, root).dropna()
    p = prices(spark, root)
    got = asof_prior(got, p, ["token"], "t", ["price"], prefix="now_", block_us=7 * DAY_US)
    for s in (300, 900):
        moved = got.withColumn("t0", F.col("t")).withColumn("t", F.col("t") - s * SEC)
        got = asof_prior(moved, p, ["token"], "t", ["price"], prefix=f"back{s}_", block_us=7 * DAY_US).withColumn("t", F.col("t0")).drop("t0")
    return got.select("trade_row_id", *[F.round(F.col("now_price") - F.col(f"back{s}_price"), 9).alias(f"change_{s}s") for s in (300, 900)])


def prior_counts_orders(spark: SparkSession, root: str) -> DataFrame:
    """Strict-prior and look-back aggregates where instants tie; the mean is of exact cents."""
    by, year, back = ["o_custkey"], 365 * DAY_US, 180 * DAY_US
    o = orders(spark, root).select("o_orderkey", "o_custkey", "o_totalprice", "t", cents("o_totalprice").alias("v"))
    whole = prior_totals(o.select("o_orderkey", "o_custkey", "t"), o, by, "t", {"n_prior": F.lit(1).cast("long"), "s": F.col("v")}, block_us=year)
    line = with_halo(o, by, "t", back_us=back, block_us=year)
    frame = prior_frame([*by, "__b"], "t", back)
    recent = line.select("o_orderkey", "__own", F.count("*").over(frame).alias("n_180d"), F.max("o_totalprice").over(frame).alias("max_180d")).where("__own").drop("__own")
    return whole.join(recent, "o_orderkey").select("o_orderkey", "n_prior", F.when(F.col("n_prior") > 0, F.col("s") / (F.col("n_prior") * 100)).alias("mean_prior"), "n_180d", "max_180d")


def label_next_window(spark: SparkSession, root: str) -> DataFrame:
    """Does the user act again in (t, t + h)? Itself is not counted."""
    e = with_halo(events(spark, root), ["user_id"], "t", ahead_us=21600 * SEC)
    frame = lambda h: next_frame(["user_id", "__b"], "t", h * SEC)
    return e.select("event_id", "__own", *[(F.count("*").over(frame(h)) > 1).cast("int").alias(f"label_{h}s") for h in (900, 3600, 21600)]).where("__own").drop("__own")


def published_before_kickoff(spark: SparkSession, root: str) -> DataFrame:
    """Interval count: news published in [kickoff - 90 d, kickoff + 6 h), by two ranks."""
    news = table(spark, root, "news").select(F.lit(0).alias("all"), F.col("published_us").alias("t"))
    fix = table(spark, root, "tournament_sft_v1").where("policy_version = 1 AND kickoff_at IS NOT NULL AND fixture_id IS NOT NULL").select("fixture_id", F.lit(0).alias("all"), micros("kickoff_at").alias("k"))
    hour = 3600 * SEC
    for name, shift in (("lo", -90 * 24 * hour), ("hi", 6 * hour)):
        fix = prior_rank(fix.withColumn("t", F.col("k") + shift), news, ["all"], "t", name)
    return fix.select("fixture_id", (F.col("hi") - F.col("lo")).alias("n_news"))


def prior_rows_other_transactions(spark: SparkSession, root: str) -> DataFrame:
    """A wallet's strictly earlier trades without those of the same transaction."""
    rows = table(spark, root, "trades").select("trade_row_id", ident(F.col("wallet")).alias("w"), ident(F.col("transaction_hash")).alias("x"), F.col("query_us").alias("t")).dropna(subset=["w", "t"])
    n = prior_rank(rows, rows, ["w"], "t", "n_prior", block_us=7 * DAY_US)
    own = prior_rank(rows.select("trade_row_id", "w", "x", "t"), rows, ["w", "x"], "t", "n_own", block_us=7 * DAY_US).select("trade_row_id", "n_own")
    return n.join(own, "trade_row_id", "left").select("trade_row_id", "n_prior", (F.col("n_prior") - F.coalesce("n_own", F.lit(0))).alias("n_prior_other"))


def gap_statistics(spark: SparkSession, root: str) -> DataFrame:
    """Gaps between a user's events: lag, mean and population deviation."""
    e = events(spark, root).withColumn("gap", (F.col("t") - F.lag("t").over(W.partitionBy("user_id").orderBy("t", "event_id"))) / SEC)
    return e.groupBy("user_id").agg(F.count("gap").alias("n_gaps"), F.round(F.avg("gap"), 4).alias("mean_gap_s"), F.round(F.stddev_pop("gap"), 4).alias("sd_gap_s"), F.round(F.min("gap"), 6).alias("least_gap_s"))


def trailing_price_volatility(spark: SparkSession, root: str) -> DataFrame:
    """Deviation of price steps that lie wholly inside [t - 3600 s, t), by time blocks (W11). Prices count in whole millionths."""
    p = prices(spark, root).groupBy("token", "t").agg(F.min_by("price", "point_id").alias("price")).withColumn("u", F.round(F.col("price") * 1_000_000).cast("long"))
    by = ["token", "__b"]
    line = with_halo(p, ["token"], "t", back_us=3600 * SEC).withColumn("d", F.col("u") - F.lag("u").over(W.partitionBy(*by).orderBy("t")))
    back = prior_frame(by, "t", 3600 * SEC)
    # the first point in the frame has its step from outside: left out
    first, has = F.first("d").over(back), F.count("*").over(back) > 0
    n, s, q = F.count("d").over(back), F.sum("d").over(back), F.sum(F.col("d") * F.col("d")).over(back)
    line = line.select("token", "t", "__own", F.when(first.isNotNull() & has, n - 1).otherwise(n).alias("m"), (s - F.coalesce(first, F.lit(0))).alias("s"), (q - F.coalesce(first * first, F.lit(0))).alias("q")).where("__own")
    return line.select("token", "t", F.when(F.col("m") >= 2, F.round(F.sqrt((F.col("m") * F.col("q") - F.col("s") * F.col("s")) / (F.col("m") * (F.col("m") - 1))) / 1e6, 9)).alias("sd_3600s"))


def seconds_since_kind(spark: SparkSession, root: str) -> DataFrame:
    """Seconds since the user's last event of each kind."""
    kinds = ("click", "error", "purchase", "signup", "view")
    e = events(spark, root).select("event_id", "user_id", "event_type", "t")
    got = prior_totals(e.select("event_id", "user_id", "t"), e, ["user_id"], "t", {}, least={f"last_{k}": F.when(F.col("event_type") == k, -F.col("t")) for k in kinds}, block_us=7 * DAY_US)
    return got.select("event_id", *[((F.col("t") + F.col(f"last_{k}")) / SEC).alias(f"since_{k}_s") for k in kinds])


def order_checks(spark: SparkSession, root: str) -> DataFrame:
    """Ordinals and adjacency checks per customer."""
    order = W.partitionBy("o_custkey").orderBy("t", "o_orderkey")
    rows = orders(spark, root).select("o_custkey", "o_orderkey", "t", F.row_number().over(order).alias("n"), F.lag("t").over(order).alias("b"))
    return rows.groupBy("o_custkey").agg(
        F.max("n").cast("long").alias("rows"), F.max(F.floor((F.col("n") - 1) / 8)).cast("long").alias("last_chunk"), F.count_if(F.col("b") == F.col("t")).alias("ties"), F.count_if(F.col("b") > F.col("t")).alias("out_of_order"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        asof_prior_purchase, asof_join_events, asof_price_staleness, price_change_lookback, prior_counts_orders, label_next_window, published_before_kickoff,
        prior_rows_other_transactions, gap_statistics, trailing_price_volatility, seconds_since_kind, order_checks,
    )
}

_E = "e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS t FROM events)"
_O = "o AS (SELECT *, epoch_us(o_orderdate) AS t FROM orders)"
_WS = "' ' || chr(9) || chr(10) || chr(13)"
PRICES = f"""h AS (SELECT point_id, trim(token_id, {_WS}) AS token, CASE WHEN t >= 100000000000000 THEN t WHEN t >= 100000000000 THEN t * 1000 ELSE t * 1000000 END AS t, try_cast(trim(p, {_WS}) AS double) AS price
           FROM price_history WHERE regexp_full_match(trim(p, {_WS}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') AND try_cast(trim(p, {_WS}) AS double) BETWEEN 0 AND 1 AND t IS NOT NULL AND token_id IS NOT NULL),
hh AS (SELECT token, t, max(price) AS price FROM h GROUP BY ALL)"""
_X = f"x AS (SELECT trade_row_id, trim(token_id, {_WS}) AS token, query_us AS t, price AS trade_price FROM trades)"

ORACLE = {
    "asof_prior_purchase": f"""WITH {_E}, i AS (SELECT user_id, t, arg_max(event_type, event_id) AS pk, max(event_id) AS pi FROM e GROUP BY 1, 2), w AS (SELECT *,
 count(*) OVER (PARTITION BY user_id ORDER BY t RANGE BETWEEN 300000000 PRECEDING AND 1 PRECEDING) AS n_300s, count(*) OVER (PARTITION BY user_id ORDER BY t RANGE BETWEEN 900000000 PRECEDING AND 1 PRECEDING) AS n_900s,
 count(*) OVER (PARTITION BY user_id ORDER BY t RANGE BETWEEN 3600000000 PRECEDING AND 1 PRECEDING) AS n_3600s, count(*) OVER (PARTITION BY user_id ORDER BY t RANGE BETWEEN CURRENT ROW AND 299999999 FOLLOWING) > 1 AS active_next_300s FROM e)
SELECT w.event_id, w.user_id, i.pk AS prior_type, i.pi AS prior_event_id, w.t - i.t AS age_us, n_300s, n_900s, n_3600s, active_next_300s FROM (SELECT * FROM w WHERE event_type = 'purchase' AND user_id IS NOT NULL) w ASOF LEFT JOIN i ON w.user_id = i.user_id AND w.t > i.t""",
    "asof_join_events": f"""WITH {_E}, c AS (SELECT * FROM e WHERE event_type = 'click'), p AS (SELECT * FROM e WHERE event_type = 'purchase')
SELECT c.event_id, c.user_id, p.t AS prior_t, p.value AS prior_value, p.event_id AS prior_event_id FROM c ASOF LEFT JOIN p ON c.user_id = p.user_id AND c.t > p.t""",
    "asof_price_staleness": f"""WITH {PRICES}, {_X}
SELECT trade_row_id, CASE WHEN x.t - hh.t <= 300000000 THEN price END AS price, x.t - hh.t AS age_us, CASE WHEN hh.t IS NULL THEN 'no_earlier_observation' WHEN x.t - hh.t > 300000000 THEN 'stale' END AS reason FROM x ASOF LEFT JOIN hh ON x.token = hh.token AND x.t > hh.t""",
    "price_change_lookback": f"""WITH {PRICES}, {_X}, y AS (SELECT * FROM x WHERE token IS NOT NULL AND t IS NOT NULL), a AS (SELECT y.*, hh.price FROM y ASOF LEFT JOIN hh ON y.token = hh.token AND y.t > hh.t),
b AS (SELECT a.*, hh.price AS p3 FROM a ASOF LEFT JOIN hh ON a.token = hh.token AND a.t - 300000000 > hh.t), c AS (SELECT b.*, hh.price AS p9 FROM b ASOF LEFT JOIN hh ON b.token = hh.token AND b.t - 900000000 > hh.t)
SELECT trade_row_id, round(price - p3, 9) AS change_300s, round(price - p9, 9) AS change_900s FROM c""",
    "prior_counts_orders": f"""WITH {_O} SELECT o_orderkey, count(*) OVER p AS n_prior, sum(round(o_totalprice * 100)::bigint) OVER p / nullif(count(*) OVER p * 100, 0) AS mean_prior, count(*) OVER b AS n_180d, max(o_totalprice) OVER b AS max_180d FROM o WHERE o_custkey IS NOT NULL AND t IS NOT NULL
WINDOW p AS (PARTITION BY o_custkey ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), b AS (PARTITION BY o_custkey ORDER BY t RANGE BETWEEN 15552000000000 PRECEDING AND 1 PRECEDING)""",
    "label_next_window": f"""WITH {_E} SELECT event_id, {', '.join(f"(count(*) OVER (PARTITION BY user_id ORDER BY t RANGE BETWEEN CURRENT ROW AND {h * SEC - 1} FOLLOWING) > 1)::int AS label_{h}s" for h in (900, 3600, 21600))} FROM e""",
    "published_before_kickoff": """SELECT f.fixture_id, count(n.news_id) AS n_news FROM tournament_sft_v1 f LEFT JOIN news n ON n.published_us >= epoch_us(kickoff_at) - 7776000000000 AND n.published_us < epoch_us(kickoff_at) + 21600000000
WHERE policy_version = 1 AND kickoff_at IS NOT NULL AND f.fixture_id IS NOT NULL GROUP BY 1""",
    "prior_rows_other_transactions": f"""WITH r AS (SELECT trade_row_id, lower(trim(wallet, {_WS})) AS w, lower(trim(transaction_hash, {_WS})) AS x, query_us AS t FROM trades WHERE wallet IS NOT NULL AND query_us IS NOT NULL)
SELECT trade_row_id, count(*) OVER (PARTITION BY w ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n_prior,
 count(*) OVER (PARTITION BY w ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - CASE WHEN x IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY w, x ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS n_prior_other FROM r""",
    "gap_statistics": f"""WITH {_E}, g AS (SELECT user_id, (t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id)) / 1e6 AS gap FROM e)
SELECT user_id, count(gap) AS n_gaps, round(avg(gap), 4) AS mean_gap_s, round(stddev_pop(gap), 4) AS sd_gap_s, round(min(gap), 6) AS least_gap_s FROM g GROUP BY 1""",
    "trailing_price_volatility": f"""WITH {PRICES}, p AS (SELECT token, t, round(arg_min(price, point_id) * 1000000)::bigint AS price FROM h GROUP BY ALL), s AS (SELECT *, price - lag(price) OVER (PARTITION BY token ORDER BY t) AS d, lag(t) OVER (PARTITION BY token ORDER BY t) AS tb FROM p),
j AS (SELECT a.token, a.t, count(b.d) AS m, sum(b.d)::bigint AS s1, sum(b.d * b.d)::bigint AS q1 FROM s a LEFT JOIN s b ON a.token = b.token AND b.t >= a.t - 3600000000 AND b.t < a.t AND b.tb >= a.t - 3600000000 GROUP BY ALL)
SELECT token, t, CASE WHEN m >= 2 THEN round(sqrt((m * q1 - s1 * s1) / (m * (m - 1))) / 1e6, 9) END AS sd_3600s FROM j""",
    "seconds_since_kind": f"""WITH {_E} SELECT event_id, {', '.join(f"(t - max(t) FILTER (WHERE event_type = '{k}') OVER p) / 1e6 AS since_{k}_s" for k in ('click', 'error', 'purchase', 'signup', 'view'))} FROM e WHERE user_id IS NOT NULL AND t IS NOT NULL
WINDOW p AS (PARTITION BY user_id ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "order_checks": f"""WITH {_O}, r AS (SELECT o_custkey, t, row_number() OVER w AS n, lag(t) OVER w AS b FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY t, o_orderkey))
SELECT o_custkey, max(n) AS "rows", max((n - 1) // 8) AS last_chunk, count(*) FILTER (WHERE b = t) AS ties, count(*) FILTER (WHERE b > t) AS out_of_order FROM r GROUP BY 1""",
}

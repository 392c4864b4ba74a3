"""The eighteen strictly prior metrics, inventory at query time and unrealised P&L on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.clean import amount, hex_ident, ident, outer_trim
from tidemark.operators import metrics as M
from tidemark.operators import prior as P
from tidemark.operators.asof import DAY_US, asof_prior, fresh, micros, prior_totals, with_halo
from tidemark.operators.ledgers import cents
from tidemark.plans.asof import PRICES, prices
from tidemark.session import table

DAYS_BACK = 180
# Why a holding has no value; the last two tell apart what is one case elsewhere.
UNMATCHED = "unmatched_sell"
NO_MARK = "missing_prior_price"
TIED_FILLS = "ambiguous_fill_order"
STALE_MARK = "stale_prior_price"


def _fills(spark: SparkSession, root: str) -> DataFrame:
    """Orders as fills, in cents."""
    o = table(spark, root, "orders")
    return o.select("o_orderkey", F.col("o_custkey").alias("actor"), micros("o_orderdate").alias("time_us"), F.when(F.col("o_orderstatus") == "F", "BUY").otherwise("SELL").alias("side"), cents("o_totalprice").alias("notional"))


_BEHAVIOUR = ("o_orderkey", "n_prior", "average_notional", "notional_cv", "buy_share", "per_day", "notional_reason", "cv_reason", "share_reason", "rate_reason")


def actor_behaviour(spark: SparkSession, root: str) -> DataFrame:
    """Mean notional in cents, variation, buy share and rate strictly before every order; instants tie (A5a-d, W6)."""
    f = _fills(spark, root)
    return P.behaviour_before(f.select("o_orderkey", "actor", "time_us"), f, block_us=365 * DAY_US).select(*_BEHAVIOUR)


def actor_behaviour_lookback(spark: SparkSession, root: str) -> DataFrame:
    """The same over the 180 days before every order (A5d, W7)."""
    f = _fills(spark, root)
    return P.behaviour_before(f.select("o_orderkey", "actor", "time_us"), f, back_us=DAYS_BACK * DAY_US).select(*_BEHAVIOUR)


def _closed(spark: SparkSession, root: str) -> DataFrame:
    """Lines as positions: opened with the order, closed with the shipment, known up to two days later; ten-thousandths."""
    l = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_discount")
    o = table(spark, root, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("actor"), micros("o_orderdate").alias("opened_us"))
    j = l.join(o, "l_orderkey").withColumn("closed_us", micros("l_shipdate"))
    return j.select("actor", "opened_us", "closed_us", (F.col("closed_us") + (F.col("l_linenumber") % 3) * DAY_US).alias("known_us"), (cents("l_extendedprice") * 100).alias("cost"), (cents("l_extendedprice") * (5 - cents("l_discount"))).alias("pnl"))


def position_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Nine figures and the loss streak of positions closed and known strictly before every order (A5e-n)."""
    probes = table(spark, root, "orders").select(F.col("o_orderkey").alias("probe"), F.col("o_custkey").alias("actor"), micros("o_orderdate").alias("time_us"))
    return P.positions_before(probes, _closed(spark, root), block_us=365 * DAY_US).drop("actor", "time_us")


def risk_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Volatility, Sharpe, Sortino and drawdown of daily returns known before every purchase, from eight periods on (A5o-r, A6).

    The return of a user's day is a thousandth of the mean value less 5 %, in
    millionths rounded down, and known six hours after the day.
    """
    e = table(spark, root, "events").select("event_id", F.col("user_id").alias("actor"), "event_type", micros("ts").alias("time_us"), F.round(F.col("value") * 1_000_000).cast("long").alias("v"))
    day = F.floor(F.col("time_us") / DAY_US)
    r = e.dropna(subset=["actor", "v"]).groupBy("actor", day.alias("d")).agg(F.sum("v").alias("v"), F.count("*").alias("n"))
    r = r.select("actor", (F.col("d") * DAY_US).alias("start_us"), ((F.col("d") + 1) * DAY_US).alias("end_us"), ((F.col("d") + 1) * DAY_US + DAY_US // 4).alias("known_us"), (F.expr("v div (1000 * n)") - 50_000).alias("ret"), (F.col("d") % 3 * 1000).alias("benchmark"), F.lit(10_000).cast("long").alias("target"))
    probes = e.where("event_type = 'purchase' AND actor IS NOT NULL").select(F.col("event_id").alias("probe"), "actor", "time_us")
    return P.risk_before(probes, r, least_periods=8, block_us=7 * DAY_US)


def _trades(spark: SparkSession, root: str) -> DataFrame:
    """Trades with canonical keys; shares and notional only where both amounts are usable."""
    t = table(spark, root, "trades")
    side, shares, price = F.upper(outer_trim("side")), amount(F.col("shares"), 20, 8), amount(F.col("price"), 13, 12)
    good = side.isin("BUY", "SELL") & (shares > 0) & (price >= 0) & (price <= 1)
    return t.select(
        "trade_row_id", ident(F.col("wallet")).alias("wallet"), hex_ident(F.col("condition_id")).alias("condition"), outer_trim("token_id").alias("token"), ident(F.col("token_outcome")).alias("outcome"),
        ident(F.col("fixture_id")).alias("fixture"), F.col("query_us").alias("t"), side.alias("side"), F.when(good, shares).alias("shares"), F.when(good, shares * price).cast("decimal(34,20)").alias("notional"),
    )


def _holdings(trades: DataFrame, marks: DataFrame, stale_us: int) -> DataFrame:
    """(trade_row_id, token, quantity, cost, mark, pnl, reason) of every token the wallet trades in the condition, strictly before each trade."""
    key = F.concat_ws("/", "wallet", "condition", "token")
    fills = trades.where("shares IS NOT NULL AND t IS NOT NULL AND wallet IS NOT NULL AND condition IS NOT NULL AND token IS NOT NULL").withColumn("time_us", F.col("t"))
    states = M.inventory_states(fills, key).select("key", F.col("time_us").alias("t"), "quantity", "cost", F.lit(1).alias("any"))
    held = fills.select("wallet", "condition", "token", key.alias("key")).distinct()
    rows = trades.where("t IS NOT NULL").select("trade_row_id", "wallet", "condition", "t").join(held, ["wallet", "condition"])
    got = asof_prior(rows, states, ["key"], "t", ["quantity", "cost", "any"], prefix="s_", block_us=7 * DAY_US)
    got = asof_prior(got, marks, ["token"], "t", ["price"], prefix="m_", block_us=7 * DAY_US)
    mark, late = fresh("m_price", "m_t", "t", stale_us)
    none, q, c = F.col("s_any").isNull(), F.col("s_quantity"), F.col("s_cost")
    reason = F.when(none, None).when(q.isNull(), UNMATCHED).when(q == 0, None).when(c.isNull(), TIED_FILLS).when(late == "no_earlier_observation", NO_MARK).when(late == "stale", STALE_MARK)
    flat = none | F.coalesce(q == 0, F.lit(False))
    return got.select("trade_row_id", "token", F.when(none, 0.0).otherwise(q).alias("quantity"), F.when(none, 0.0).otherwise(c).alias("cost"), mark.alias("mark"), F.when(flat, 0.0).when(reason.isNull(), q * mark - c).alias("pnl"), reason.alias("reason"))


def unrealised_pnl(spark: SparkSession, root: str) -> DataFrame:
    """Holdings marked at the price known before each trade, less their remaining cost; null with reasons where that is unknown."""
    trades = _trades(spark, root)
    h = _holdings(trades, prices(spark, root).groupBy("token", "t").agg(F.max("price").alias("price")), 300 * 1_000_000)
    g = h.groupBy("trade_row_id").agg(F.sum("pnl").alias("v"), F.count("reason").alias("n"), F.array_join(F.array_sort(F.collect_set("reason")), "+").alias("reasons"), F.count_if(F.col("quantity") > 0).alias("n_held"))
    out = trades.where("t IS NOT NULL AND wallet IS NOT NULL AND condition IS NOT NULL").select("trade_row_id").join(g, "trade_row_id", "left")
    return out.select("trade_row_id", F.when(F.coalesce("n", F.lit(0)) == 0, F.round(F.coalesce("v", F.lit(0.0)), 6)).alias("unrealised"), F.coalesce("n_held", F.lit(0)).alias("n_held"), F.coalesce("reasons", F.lit("")).alias("reasons"))


def decision_features(spark: SparkSession, root: str) -> DataFrame:
    """Causal row of every trade from what its wallet, market and fixture did strictly before, with the label of the next 300 s.

    Activity of the wallet in the condition, its last instant, look-back counts,
    inventory and marks by outcome, price changes, news of the fixture. Labels
    look at [t, t + 300 s) beyond the instant itself.
    """
    sec, day = 1_000_000, DAY_US
    trades = _trades(spark, root)
    probes = trades.where("t IS NOT NULL AND wallet IS NOT NULL AND condition IS NOT NULL").select("trade_row_id", "wallet", "condition", "fixture", "t")
    by = ["wallet", "condition"]
    fills = trades.where("shares IS NOT NULL AND t IS NOT NULL AND wallet IS NOT NULL AND condition IS NOT NULL")
    buy, yes, v = (F.col("side") == "BUY").cast("long"), F.coalesce((F.col("outcome") == "yes").cast("long"), F.lit(0)), F.col("notional").cast("decimal(38,10)")
    ticks = fills.groupBy(*by, "t").agg(F.count("*").alias("n"), F.sum(buy).alias("buys"), F.sum(yes).alias("yes"), F.sum(v).cast("decimal(38,10)").alias("v"), F.sum(F.when(F.col("side") == "SELL", v).otherwise(-v)).cast("decimal(38,10)").alias("cash"), F.max(v).alias("most"))
    sums = {"prior_execution_count": F.col("n"), "prior_execution_groups": F.lit(1).cast("long"), "__buys": F.col("buys"), "__yes": F.col("yes"), "__v": F.col("v"), "__cash": F.col("cash")}
    got = prior_totals(probes, ticks, by, "t", sums, least={"__first": F.col("t"), "__most": -F.col("most")}, block_us=7 * day)
    got = asof_prior(got, ticks, by, "t", ["n", "buys", "yes", "v"], tie=["n"], prefix="l_", block_us=7 * day)
    n = F.col("prior_execution_count")
    part = lambda a, b: F.when(b > 0, a / b)
    activity = got.select(
        "trade_row_id", "fixture", "t", "prior_execution_count", "prior_execution_groups", ((F.col("t") - F.col("__first")) / sec).alias("seconds_since_first_execution"), ((F.col("t") - F.col("l_t")) / sec).alias("seconds_since_last_execution"),
        F.col("__v").cast("string").alias("prior_total_notional"), (-F.col("__most")).cast("string").alias("prior_max_notional"), F.col("__cash").cast("string").alias("prior_net_cashflow"), part(F.col("__buys"), n).alias("prior_buy_fraction"), part(F.col("__yes"), n).alias("prior_yes_fraction"),
        F.col("l_n").alias("last_group_count"), part(F.col("l_buys"), F.col("l_n")).alias("last_group_buy_fraction"), part(F.col("l_yes"), F.col("l_n")).alias("last_group_yes_fraction"), F.col("l_v").cast("string").alias("last_group_notional"),
        F.when(F.col("prior_execution_groups") > 1, (F.col("l_t") - F.col("__first")) / ((F.col("prior_execution_groups") - 1) * sec)).alias("mean_gap_seconds"),
    )
    line = with_halo(ticks.select(*by, "t", "n").unionByName(probes.select("trade_row_id", *by, "t"), allowMissingColumns=True), by, "t", back_us=3600 * sec, ahead_us=300 * sec)
    own = [*by, "__b"]
    count = lambda lo, hi: F.coalesce(F.sum("n").over(W.partitionBy(*own).orderBy("t").rangeBetween(lo, hi)), F.lit(0))
    recent = line.withColumns({**{f"execution_count_{s}s": count(-s * sec, -1) for s in (300, 900, 3600)}, "label": (count(1, 300 * sec - 1) > 0).cast("int")}).where("__own AND trade_row_id IS NOT NULL").select("trade_row_id", *[f"execution_count_{s}s" for s in (300, 900, 3600)], "label")
    marks = prices(spark, root).groupBy("token", "t").agg(F.max("price").alias("price"))
    outcome = trades.where("token IS NOT NULL AND outcome IN ('yes', 'no')").groupBy("token").agg(F.min("outcome").alias("outcome"))
    held = _holdings(trades, marks, 300 * sec).join(outcome, "token", "left")
    of = lambda c, o: F.max(F.when(F.col("outcome") == o, F.col(c)))
    stock = held.groupBy("trade_row_id").agg(*[F.round(of(c, o), 6).alias(f"{o}_{c}") for o in ("yes", "no") for c in ("quantity", "cost", "pnl")], *[of("mark", o).alias(f"{o}_mark") for o in ("yes", "no")], F.count("reason").alias("pnl_missing"))
    links = table(spark, root, "fixture_news").select(ident(F.col("fixture_id")).alias("fixture"), F.col("eligible_us").alias("t"))
    dated = probes.where("fixture IS NOT NULL").select("trade_row_id", "fixture", "t")
    news = prior_totals(dated, links, ["fixture"], "t", {"news_count": F.lit(1).cast("long")}, least={"__last": -F.col("t")}, block_us=7 * day)
    news = news.select("trade_row_id", "news_count", ((F.col("t") + F.col("__last")) / sec).alias("seconds_since_latest_news"))
    out = activity.join(recent, "trade_row_id").join(stock, "trade_row_id", "left").join(news, "trade_row_id", "left")
    return out.drop("fixture", "t")


QUERIES = {f.__name__: f for f in (actor_behaviour, actor_behaviour_lookback, position_metrics, risk_metrics, unrealised_pnl, decision_features)}

_CENTS = "round({} * 100)::bigint"


def _behaviour(frame: str, since: str) -> str:
    return f"""WITH o AS (SELECT o_orderkey, o_custkey AS a, epoch_us(o_orderdate) AS t, o_orderstatus = 'F' AS buy, {_CENTS.format('o_totalprice')}::hugeint AS v FROM orders),
w AS (SELECT o_orderkey, t, count(*) OVER p AS n, coalesce(sum(v) OVER p, 0)::hugeint AS s, coalesce(sum(v * v) OVER p, 0)::hugeint AS q, coalesce(sum(CASE WHEN buy THEN v ELSE 0 END) OVER p, 0)::hugeint AS u, min(t) OVER p AS t0 FROM o WINDOW p AS (PARTITION BY a ORDER BY t RANGE BETWEEN {frame} PRECEDING AND 1 PRECEDING)),
x AS (SELECT *, {since} AS since FROM w)
SELECT o_orderkey, n AS n_prior, s::double / nullif(n, 0) AS average_notional, CASE WHEN n >= 2 AND s <> 0 THEN round(sqrt((n * q - s * s)::double / (n::double * n)) / (s::double / n), 9) END AS notional_cv, u::double / nullif(s::double, 0) AS buy_share, (n * 86400000000)::double / nullif(t - since, 0) AS per_day,
 CASE WHEN n = 0 THEN 'no_eligible_captured_executions' END AS notional_reason, CASE WHEN n = 0 THEN 'no_eligible_captured_executions' WHEN n = 1 THEN 'fewer_than_two_captured_executions' WHEN s = 0 THEN 'zero_mean_execution_notional' END AS cv_reason,
 CASE WHEN n = 0 THEN 'no_eligible_captured_executions' WHEN s = 0 THEN 'zero_total_execution_notional' END AS share_reason, CASE WHEN since IS NULL OR since >= t THEN 'no_positive_observation_window' END AS rate_reason FROM x"""


_WS = "' ' || chr(9) || chr(10) || chr(13)"
_TRADES = f"""tr AS (SELECT trade_row_id, lower(trim(wallet, {_WS})) AS wallet, CASE WHEN NOT regexp_full_match(regexp_replace(lower(trim(condition_id, {_WS})), '^0x', ''), '0*') THEN regexp_replace(lower(trim(condition_id, {_WS})), '^0x', '') END AS condition, trim(token_id, {_WS}) AS token,
 lower(trim(token_outcome, {_WS})) AS outcome, lower(trim(fixture_id, {_WS})) AS fixture, query_us AS t, upper(trim(side, {_WS})) AS side, try_cast(trim(shares, {_WS}) AS decimal(20, 8)) AS shares, try_cast(trim(price, {_WS}) AS decimal(13, 12)) AS price FROM trades),
fi AS (SELECT *, wallet || '/' || condition || '/' || token AS key, (shares * price)::decimal(34, 20) AS notional FROM tr WHERE side IN ('BUY', 'SELL') AND shares > 0 AND price BETWEEN 0 AND 1 AND t IS NOT NULL AND wallet IS NOT NULL AND condition IS NOT NULL),
gi AS (SELECT key, t, coalesce(sum(shares) FILTER (WHERE side = 'BUY'), 0)::decimal(38, 10)::double AS b, coalesce(sum(notional) FILTER (WHERE side = 'BUY'), 0)::decimal(38, 10)::double AS v, coalesce(sum(shares) FILTER (WHERE side = 'SELL'), 0)::decimal(38, 10)::double AS s, coalesce(sum(notional) FILTER (WHERE side = 'SELL'), 0)::decimal(38, 10)::double AS w FROM fi WHERE token IS NOT NULL GROUP BY 1, 2),
ni AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY t) AS i FROM gi),
st(key, i, t, q, c, ok, flat) AS (SELECT DISTINCT key, 0::bigint, 0::bigint, 0.0::double, 0.0::double, true, true FROM ni UNION ALL
 SELECT key, i, t, CASE WHEN z THEN 0 ELSE q1 END, CASE WHEN z THEN 0 ELSE c1 END, k1, fl OR z FROM (
  SELECT *, k1 AND abs(q1) <= 1e-9 AS z FROM (SELECT n.key, n.i, n.t, f.flat AND NOT (n.b > 0 AND n.s > 0) AS fl, f.ok AND n.s <= f.q + n.b + 1e-9 AS k1,
   f.q + n.b - CASE WHEN n.s <= f.q + n.b + 1e-9 THEN n.s ELSE 0 END AS q1, f.c + n.v - CASE WHEN n.s > 0 AND n.s <= f.q + n.b + 1e-9 THEN (f.c + n.v) * n.s / (f.q + n.b) ELSE 0 END AS c1 FROM st f JOIN ni n ON n.key = f.key AND n.i = f.i + 1))),
sf AS (SELECT key, t, CASE WHEN ok THEN q END AS q, CASE WHEN ok AND flat THEN c END AS c FROM st WHERE i > 0),
hd AS (SELECT DISTINCT wallet, condition, token, key FROM fi WHERE token IS NOT NULL), pr AS (SELECT tr.trade_row_id, tr.t, hd.token, hd.key FROM tr JOIN hd USING (wallet, condition) WHERE tr.t IS NOT NULL),
h1 AS (SELECT pr.*, sf.q, sf.c, sf.t AS st FROM pr ASOF LEFT JOIN sf ON pr.key = sf.key AND pr.t > sf.t), h2 AS (SELECT h1.*, hh.price, hh.t AS mt FROM h1 ASOF LEFT JOIN hh ON h1.token = hh.token AND h1.t > hh.t),
ho AS (SELECT trade_row_id, token, CASE WHEN st IS NULL THEN 0.0 ELSE q END AS quantity, CASE WHEN st IS NULL THEN 0.0 ELSE c END AS cost, CASE WHEN t - mt <= 300000000 THEN price END AS mark,
 CASE WHEN st IS NULL THEN NULL WHEN q IS NULL THEN 'unmatched_sell' WHEN q = 0 THEN NULL WHEN c IS NULL THEN 'ambiguous_fill_order' WHEN mt IS NULL THEN 'missing_prior_price' WHEN t - mt > 300000000 THEN 'stale_prior_price' END AS reason FROM h2),
hp AS (SELECT *, CASE WHEN quantity = 0 THEN 0.0 WHEN reason IS NULL THEN quantity * mark - cost END AS pnl FROM ho)"""

ORACLE = {
    "unrealised_pnl": f"""WITH RECURSIVE {PRICES}, {_TRADES}, g AS (SELECT trade_row_id, sum(pnl) AS v, count(reason) AS n, string_agg(DISTINCT reason, '+' ORDER BY reason) AS reasons, count(*) FILTER (WHERE quantity > 0) AS n_held FROM hp GROUP BY 1)
SELECT tr.trade_row_id, CASE WHEN coalesce(n, 0) = 0 THEN round(coalesce(v, 0), 6) END AS unrealised, coalesce(n_held, 0) AS n_held, coalesce(reasons, '') AS reasons FROM tr LEFT JOIN g USING (trade_row_id) WHERE tr.t IS NOT NULL AND wallet IS NOT NULL AND condition IS NOT NULL""",
    "decision_features": f"""WITH RECURSIVE {PRICES}, {_TRADES}, p AS (SELECT trade_row_id, wallet, condition, fixture, t FROM tr WHERE t IS NOT NULL AND wallet IS NOT NULL AND condition IS NOT NULL),
k AS (SELECT wallet, condition, t, count(*) AS n, count(*) FILTER (WHERE side = 'BUY') AS buys, count(*) FILTER (WHERE outcome = 'yes') AS yes, sum(notional::decimal(38, 10))::decimal(38, 10) AS v, sum(CASE WHEN side = 'SELL' THEN notional::decimal(38, 10) ELSE -notional::decimal(38, 10) END)::decimal(38, 10) AS cash, max(notional::decimal(38, 10)) AS most FROM fi GROUP BY 1, 2, 3),
r AS (SELECT *, sum(n) OVER o AS cn, count(*) OVER o AS cg, sum(buys) OVER o AS cb, sum(yes) OVER o AS cy, sum(v) OVER o AS cv, sum(cash) OVER o AS cc, max(most) OVER o AS cm, min(t) OVER o AS t0 FROM k WINDOW o AS (PARTITION BY wallet, condition ORDER BY t)),
a AS (SELECT p.*, r.* EXCLUDE (wallet, condition, t), r.t AS lt FROM p ASOF LEFT JOIN r ON p.wallet = r.wallet AND p.condition = r.condition AND p.t > r.t),
c AS (SELECT p.trade_row_id, coalesce(sum(n) FILTER (WHERE k.t >= p.t - 300000000 AND k.t < p.t), 0)::bigint AS c1, coalesce(sum(n) FILTER (WHERE k.t >= p.t - 900000000 AND k.t < p.t), 0)::bigint AS c2, coalesce(sum(n) FILTER (WHERE k.t >= p.t - 3600000000 AND k.t < p.t), 0)::bigint AS c3, (count(*) FILTER (WHERE k.t > p.t AND k.t < p.t + 300000000) > 0)::int AS label
  FROM p LEFT JOIN k ON k.wallet = p.wallet AND k.condition = p.condition GROUP BY 1),
oc AS (SELECT token, min(outcome) AS outcome FROM tr WHERE token IS NOT NULL AND outcome IN ('yes', 'no') GROUP BY 1),
s AS (SELECT trade_row_id, {', '.join(f"round(max({c}) FILTER (WHERE outcome = '{o}'), 6) AS {o}_{c}" for o in ('yes', 'no') for c in ('quantity', 'cost', 'pnl'))}, max(mark) FILTER (WHERE outcome = 'yes') AS yes_mark, max(mark) FILTER (WHERE outcome = 'no') AS no_mark, count(reason) AS pnl_missing FROM hp LEFT JOIN oc USING (token) GROUP BY 1),
f AS (SELECT lower(trim(fixture_id, {_WS})) AS fixture, eligible_us AS t FROM fixture_news WHERE eligible_us IS NOT NULL), w AS (SELECT p.trade_row_id, count(f.t) AS news_count, (p.t - max(f.t)) / 1e6 AS since FROM p LEFT JOIN f ON f.fixture = p.fixture AND f.t < p.t WHERE p.fixture IS NOT NULL GROUP BY p.trade_row_id, p.t)
SELECT a.trade_row_id, coalesce(cn, 0)::bigint AS prior_execution_count, coalesce(cg, 0) AS prior_execution_groups, (a.t - t0) / 1e6 AS seconds_since_first_execution, (a.t - lt) / 1e6 AS seconds_since_last_execution, coalesce(cv, 0)::decimal(38, 10)::varchar AS prior_total_notional, cm::varchar AS prior_max_notional, coalesce(cc, 0)::decimal(38, 10)::varchar AS prior_net_cashflow,
 cb / cn AS prior_buy_fraction, cy / cn AS prior_yes_fraction, n AS last_group_count, buys / n AS last_group_buy_fraction, yes / n AS last_group_yes_fraction, v::varchar AS last_group_notional, CASE WHEN cg > 1 THEN (lt - t0) / ((cg - 1) * 1000000) END AS mean_gap_seconds,
 c1 AS execution_count_300s, c2 AS execution_count_900s, c3 AS execution_count_3600s, label, s.* EXCLUDE (trade_row_id), news_count, since AS seconds_since_latest_news FROM a JOIN c USING (trade_row_id) LEFT JOIN s ON s.trade_row_id = a.trade_row_id LEFT JOIN w ON w.trade_row_id = a.trade_row_id""",
    "actor_behaviour": _behaviour("UNBOUNDED", "t0"),
    "actor_behaviour_lookback": _behaviour(str(DAYS_BACK * DAY_US), f"t - {DAYS_BACK * DAY_US}"),
    "position_metrics": f"""WITH c AS (SELECT o_custkey AS a, epoch_us(o_orderdate) AS opened, epoch_us(l_shipdate) AS closed, epoch_us(l_shipdate) + (l_linenumber % 3) * 86400000000 AS known, {_CENTS.format('l_extendedprice')} * 100 AS cost, {_CENTS.format('l_extendedprice')} * (5 - {_CENTS.format('l_discount')}) AS pnl FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
j AS (SELECT o_orderkey AS probe, c.* FROM orders LEFT JOIN c ON c.a = o_custkey AND greatest(closed, known) < epoch_us(o_orderdate)),
g AS (SELECT probe, closed, count(*) AS n, count(*) FILTER (WHERE pnl < 0) AS l FROM j WHERE a IS NOT NULL GROUP BY 1, 2), s AS (SELECT probe, max(closed) AS t, arg_max(l > 0, closed) AS mixed FROM g WHERE l < n GROUP BY 1),
k AS (SELECT g.probe, coalesce(any_value(mixed), false) AS mixed, coalesce(sum(l) FILTER (WHERE t IS NULL OR closed > t), 0)::bigint AS streak FROM g LEFT JOIN s USING (probe) GROUP BY 1),
m AS (SELECT probe, count(a) AS n, sum(pnl)::hugeint AS s, sum(floor(pnl * 1000000 / cost))::hugeint AS r, count(*) FILTER (WHERE pnl > 0) AS wn, coalesce(sum(pnl) FILTER (WHERE pnl > 0), 0)::hugeint AS w, count(*) FILTER (WHERE pnl < 0) AS ln, coalesce(sum(-pnl) FILTER (WHERE pnl < 0), 0)::hugeint AS l, sum(closed - opened)::hugeint AS h FROM j GROUP BY 1)
SELECT m.probe, n AS n_closed, s::double AS net_pnl, r::double / nullif(n * 1000000, 0) AS mean_roi, wn / nullif(n, 0) AS win_rate, w::double / nullif(wn, 0) AS average_win, l::double / nullif(ln, 0) AS average_loss, CASE WHEN wn > 0 THEN (w * ln)::double / nullif((l * wn)::double, 0) END AS payoff_ratio, w::double / nullif(l::double, 0) AS profit_factor,
 s::double / nullif(n, 0) AS expectancy, h::double / nullif(n * 1000000, 0) AS holding_s, CASE WHEN n = 0 THEN 'no_eligible_completed_positions' END AS position_reason, CASE WHEN n = 0 THEN 'no_eligible_completed_positions' WHEN wn = 0 THEN 'no_profitable_completed_positions' END AS win_reason,
 CASE WHEN n = 0 THEN 'no_eligible_completed_positions' WHEN ln = 0 THEN 'no_losing_completed_positions' END AS loss_reason, CASE WHEN n = 0 THEN 'no_eligible_completed_positions' WHEN wn = 0 OR ln = 0 THEN 'requires_both_profitable_and_losing_completed_positions' END AS payoff_reason,
 CASE WHEN NOT k.mixed THEN streak END AS loss_streak, CASE WHEN n = 0 THEN 'no_eligible_completed_positions' WHEN k.mixed THEN 'ambiguous_close_order' END AS streak_reason FROM m LEFT JOIN k USING (probe)""",
    "risk_metrics": """WITH e AS (SELECT event_id, user_id AS a, event_type, epoch_us(ts) AS t, round(value * 1000000)::bigint AS v FROM events WHERE user_id IS NOT NULL),
d AS (SELECT a, t // 86400000000 AS d, sum(v)::bigint // (1000 * count(*)) - 50000 AS r FROM e WHERE v IS NOT NULL GROUP BY 1, 2),
y AS (SELECT *, (d + 1) * 86400000000 + 21600000000 AS ready, product(1 + r / 1e6) OVER (PARTITION BY a ORDER BY d) AS w FROM d), z AS (SELECT *, greatest(1, max(w) OVER (PARTITION BY a ORDER BY d)) AS peak FROM y), k AS (SELECT *, greatest(0, max((peak - w) / peak) OVER (PARTITION BY a ORDER BY d)) AS down FROM z),
j AS (SELECT event_id AS probe, count(d) AS n, sum(r)::hugeint AS r, sum(r * r)::hugeint AS rr, sum(r - d % 3 * 1000)::hugeint AS x, sum((r - d % 3 * 1000) * (r - d % 3 * 1000))::hugeint AS xx, sum(r - 10000)::hugeint AS g, sum(least(r - 10000, 0) * least(r - 10000, 0))::hugeint AS gg, max(d) - min(d) + 1 = count(d) AS whole, max(down) AS down
  FROM e LEFT JOIN k ON k.a = e.a AND k.ready < e.t WHERE event_type = 'purchase' GROUP BY 1),
s AS (SELECT *, CASE WHEN n = 0 THEN 'no_eligible_capital_adjusted_return_periods' WHEN NOT whole THEN 'return_periods_are_not_contiguous' END AS series, sqrt((n * xx - x * x)::double / nullif(n::double * (n - 1), 0)) AS sdx FROM j),
f AS (SELECT *, coalesce(series, CASE WHEN n < 8 THEN 'insufficient_return_periods' END) AS few FROM s)
SELECT probe, n AS n_periods, CASE WHEN few IS NULL THEN round(sqrt((n * rr - r * r)::double / (n::double * (n - 1))) / 1e6, 9) END AS volatility, CASE WHEN few IS NULL AND sdx > 0 THEN round(x::double / n / sdx, 9) END AS sharpe, CASE WHEN few IS NULL AND gg > 0 THEN round(g::double / n / sqrt(gg::double / n), 9) END AS sortino,
 CASE WHEN series IS NULL THEN round(down, 9) END AS drawdown, few AS volatility_reason, coalesce(few, CASE WHEN sdx = 0 THEN 'zero_excess_return_volatility' END) AS sharpe_reason, coalesce(few, CASE WHEN gg = 0 THEN 'zero_target_downside_deviation' END) AS sortino_reason, series AS drawdown_reason FROM f""",
}

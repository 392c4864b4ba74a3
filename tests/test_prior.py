"""Metrics strictly before a query, labels, inventory states: brute force, golden values and boundaries."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.operators import labels as G
from tidemark.operators import metrics as M
from tidemark.operators import prior as P

from .conftest import rows

DAY = 86_400_000_000


def _behaviour(fills, t, back=None):
    own = [(u, s, v) for u, s, v in fills if u < t and (back is None or u >= t - back)]
    n, total = len(own), sum(v for _, _, v in own)
    since = t - back if back else min((u for u, _, _ in own), default=None)
    cv = statistics.pstdev([v for _, _, v in own]) / statistics.mean([v for _, _, v in own]) if n > 1 and total else None
    return (n, total / n if n else None, cv, sum(v for _, s, v in own if s == "BUY") / total if total else None, n * DAY / (t - since) if since is not None and since < t else None)


@pytest.mark.parametrize("back", [None, 40, 500])
def test_behaviour_against_brute_force(spark, back):
    r = random.Random(back or 1)
    fills = [(r.choice("aaab"), r.randrange(0, 1000), r.choice(["BUY", "SELL"]), r.choice([0, 5, 10**12 + r.randrange(9)])) for _ in range(200)] + [(None, 5, "BUY", 1), ("a", None, "BUY", 1)]
    probes = [(i, r.choice("abc"), r.randrange(0, 1000)) for i in range(80)]
    f = spark.createDataFrame(fills, "actor string, time_us long, side string, notional long")
    p = spark.createDataFrame(probes, "id long, actor string, time_us long")
    for block in (7, 10**9):
        for x in P.behaviour_before(p, f, back_us=back, block_us=block).collect():
            want = _behaviour([(u, s, v) for a, u, s, v in fills if a == x.actor and u is not None], x.time_us, back)
            got = (x.n_prior, x.average_notional, x.notional_cv, x.buy_share, x.per_day)
            assert all(g == w if w is None or isinstance(w, int) else g == pytest.approx(w, abs=2e-9, rel=1e-9) for g, w in zip(got, want)), (got, want)


def test_variation_of_large_close_amounts(spark):
    f = spark.createDataFrame([("a", 1, "BUY", 10**12), ("a", 2, "BUY", 10**12 + 2)], "actor string, time_us long, side string, notional long")
    got = P.behaviour_before(spark.createDataFrame([("a", 3)], "actor string, time_us long"), f).first()
    assert got.average_notional == 10**12 + 1 and got.notional_cv == 0.0 and got.cv_reason is None
    f = spark.createDataFrame([("a", 1, "BUY", 10**6), ("a", 2, "BUY", 10**6 + 4)], "actor string, time_us long, side string, notional long")
    assert P.behaviour_before(spark.createDataFrame([("a", 3)], "actor string, time_us long"), f).first().notional_cv == 2e-6


def _positions(spark, closed, probes):
    c = spark.createDataFrame([("a", *x) for x in closed], "actor string, opened_us long, closed_us long, known_us long, cost long, pnl long")
    p = spark.createDataFrame([(i, "a", t) for i, t in enumerate(probes)], "probe long, actor string, time_us long")
    return {x.probe: x for x in P.positions_before(p, c).collect()}


def test_positions_golden(spark):
    got = _positions(spark, [(0, 1, 1, 10, 4), (0, 2, 2, 10, -2), (0, 3, 3, 10, 0)], [0, 1, 2, 4])
    x = got[3]
    assert (x.n_closed, x.net_pnl, x.win_rate, x.average_win, x.average_loss, x.payoff_ratio, x.profit_factor, x.expectancy, x.holding_s, x.loss_streak) == (3, 2.0, 1 / 3, 4.0, 2.0, 2.0, 2.0, 2 / 3, 6 / 3_000_000, 0)
    assert got[0].net_pnl is None and got[0].position_reason == got[0].streak_reason == "no_eligible_completed_positions" and got[1].n_closed == 0
    assert got[2].n_closed == 1 and got[2].loss_reason == "no_losing_completed_positions" and got[2].payoff_reason is not None and got[2].profit_factor is None


def test_position_counts_from_when_it_is_known(spark):
    got = _positions(spark, [(1, 2, 5, 10, 999)], [5, 6])
    assert got[0].n_closed == 0 and got[1].net_pnl == 999


def test_streak_against_brute_force(spark):
    r = random.Random(4)
    closed = [(0, c := r.randrange(40), c + r.choice([0, 0, 3, 20]), 1, r.choice([-1, -1, -1, 1, 0])) for _ in range(60)]
    probes = list(range(0, 70))
    got = _positions(spark, closed, probes)
    for i, t in enumerate(probes):
        own = [(c, p) for _, c, k, _, p in closed if max(c, k) < t]
        streak, mixed = 0, False
        for at in sorted({c for c, _ in own}, reverse=True):
            group = [p < 0 for c, p in own if c == at]
            if all(group):
                streak += len(group)
                continue
            mixed = any(group)
            break
        want = (None, "no_eligible_completed_positions") if not own else (None, "ambiguous_close_order") if mixed else (streak, None)
        assert (got[i].loss_streak, got[i].streak_reason) == want, t


def _risk(spark, returns, t, **kw):
    r = spark.createDataFrame([("a", *x) for x in returns], "actor string, start_us long, end_us long, known_us long, ret long, benchmark long, target long")
    return P.risk_before(spark.createDataFrame([(1, "a", t)], "probe long, actor string, time_us long"), r, **kw).first()


def test_risk_golden(spark):
    x = _risk(spark, [(0, 1, 1, 100_000, 10_000, 30_000), (1, 2, 2, -50_000, 20_000, 30_000), (2, 3, 3, 20_000, 10_000, 30_000), (3, 4, 9, -900_000, 0, 0)], 9, least_periods=3)
    raw, excess, over = [0.1, -0.05, 0.02], [0.09, -0.07, 0.01], [0.07, -0.08, -0.01]
    assert x.n_periods == 3 and x.volatility == pytest.approx(statistics.stdev(raw), abs=1e-9) and x.drawdown == pytest.approx(0.05)
    assert x.sharpe == pytest.approx(statistics.mean(excess) / statistics.stdev(excess), abs=1e-9)
    assert x.sortino == pytest.approx(statistics.mean(over) / math.sqrt(sum(min(v, 0) ** 2 for v in over) / 3), abs=1e-9)


def test_risk_reasons(spark):
    few = _risk(spark, [(0, 1, 1, 100_000, 0, 0), (1, 2, 2, -50_000, 0, 0)], 5, least_periods=3)
    assert few.sharpe is None and few.sharpe_reason == "insufficient_return_periods" and few.drawdown == pytest.approx(0.05)
    gap = _risk(spark, [(0, 1, 1, 100_000, 0, 0), (2, 3, 3, -50_000, 0, 0)], 5, least_periods=2)
    assert gap.drawdown is None and gap.drawdown_reason == "return_periods_are_not_contiguous"
    uneven = _risk(spark, [(0, 1, 1, 1, 0, 0), (1, 3, 3, 1, 0, 0)], 5, least_periods=2)
    assert uneven.drawdown_reason == "return_periods_have_inconsistent_duration"
    flat = _risk(spark, [(0, 1, 1, 100_000, 0, 0), (1, 2, 2, 100_000, 0, 0)], 5, least_periods=2)
    assert flat.sharpe_reason == "zero_excess_return_volatility" and flat.sortino_reason == "zero_target_downside_deviation"
    order = _risk(spark, [(0, 1, 9, 100_000, 0, 0), (1, 2, 2, 100_000, 0, 0)], 5, least_periods=2)
    assert order.drawdown_reason == "return_periods_known_out_of_order"
    assert _risk(spark, [], 5).drawdown_reason == "no_eligible_capital_adjusted_return_periods"


def test_states_of_an_inventory(spark):
    f = spark.createDataFrame([("k", 1, "BUY", 10, 4.0), ("k", 2, "SELL", 4, 3.6), ("k", 3, "SELL", 6, 4.2), ("k", 4, "BUY", 3, 0.6), ("k", 5, "SELL", 9, 1.0)], "k string, time_us long, side string, shares int, notional double")
    got = [(x.time_us, x.quantity, x.cost, x.reason) for x in M.inventory_states(f, F.col("k")).orderBy("time_us").collect()]
    assert got == [(1, 10.0, 4.0, None), (2, 6.0, pytest.approx(2.4), None), (3, 0.0, 0.0, None), (4, 3.0, pytest.approx(0.6), None), (5, None, None, "oversold")]


def _label(spark, actions, cover=((0, 100),), kind="taker"):
    w = spark.createDataFrame([(1, "w", 10, 15)], "window_id long, k string, start long, end long")
    a = spark.createDataFrame([("w", *x) for x in actions], "k string, action_id string, t long, role string")
    c = spark.createDataFrame([("w", *x) for x in cover], "k string, start long, end long")
    x = G.occurrence(w, a, c, ["k"], horizon_us=5, kind=kind, block_us=7).first()
    return x.status, x.censor_reason, x.action_count, x.first_action_ids, x.ordering_ambiguous


def test_occurrence_is_half_open_and_censors_first(spark):
    assert _label(spark, [("10", 10, "taker"), ("15", 15, "taker"), ("9", 9, "taker")]) == ("TRADE", None, 1, "10", False)
    assert _label(spark, [("15", 15, "taker")]) == ("NO_OBSERVED_TRADE", None, 0, None, False)
    assert _label(spark, [("13", 13, "taker")], cover=((12, 15),))[:2] == ("CENSORED", "incomplete_target_source_coverage")
    assert _label(spark, [("13", 13, "taker")], cover=((0, 12), (12, 15)))[0] == "TRADE"


def test_occurrence_ties_roles_and_repeats(spark):
    assert _label(spark, [("b", 11, "taker"), ("a", 11, "taker"), ("a", 11, "taker"), ("c", 12, "taker")]) == ("TRADE", None, 3, "a,b", True)
    assert _label(spark, [("x", 11, "unknown")])[:2] == ("CENSORED", "unclassified_execution_role")
    assert _label(spark, [("x", 11, "unknown")], kind="all")[0] == "TRADE" and _label(spark, [("x", 11, "maker")])[0] == "NO_OBSERVED_TRADE"
    assert _label(spark, [])[0] == "NO_OBSERVED_TRADE"


def test_future_rows_change_nothing(spark):
    base = [("a", i, "BUY", i + 1) for i in range(20)]
    probes = spark.createDataFrame([(i, "a", i) for i in range(20)], "id long, actor string, time_us long")
    run = lambda f: rows(P.behaviour_before(probes, spark.createDataFrame(f, "actor string, time_us long, side string, notional long")))
    assert run(base) == run([*base, ("a", 19, "SELL", 10**9), ("a", 50, "BUY", 10**9)])

"""The eighteen actor metrics, each strictly before its query, with reasons.

A position or return period counts from the later of its end and the time it
became known, a fill from its own time. Amounts come in as whole numbers of a
small unit, so every sum is exact and does not depend on its order; ratios are
taken of the exact sums. What is not known is null and has a reason.

Sums come from ``prior_totals``, which cuts an actor into time blocks. The loss
streak and the drawdown depend on order; they are folds over rows sorted by
actor and time, with a state of a few numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.operators.asof import DAY_US, asof_prior, prior_frame, prior_totals, with_halo

BIG = "decimal(38,0)"
# Why a metric is unknown.
NO_FILLS = "no_eligible_captured_executions"
ONE_FILL = "fewer_than_two_captured_executions"
ZERO_MEAN = "zero_mean_execution_notional"
ZERO_TOTAL = "zero_total_execution_notional"
NO_WINDOW = "no_positive_observation_window"
NO_POSITIONS = "no_eligible_completed_positions"
NO_WINS = "no_profitable_completed_positions"
NO_LOSSES = "no_losing_completed_positions"
ONE_SIDED = "requires_both_profitable_and_losing_completed_positions"
TIED_CLOSES = "ambiguous_close_order"
NO_RETURNS = "no_eligible_capital_adjusted_return_periods"
UNEVEN = "return_periods_have_inconsistent_duration"
GAPS = "return_periods_are_not_contiguous"
FEW_RETURNS = "insufficient_return_periods"
FLAT_EXCESS = "zero_excess_return_volatility"
NO_DOWNSIDE = "zero_target_downside_deviation"
#: Own reason: the drawdown follows periods in the order in which they become known.
OUT_OF_ORDER = "return_periods_known_out_of_order"


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient of two whole numbers as DOUBLE, null for nothing below the line."""
    return F.when(bottom != 0, top.cast("double") / bottom.cast("double"))


def spread(n: Column, total: Column, squares: Column, *, sample: bool) -> Column:
    """Standard deviation from exact sums, or null for too few."""
    wide = n.cast(BIG) * squares - total * total
    below = n.cast("double") * (n - (1 if sample else 0)).cast("double")
    return F.when(n > (1 if sample else 0), F.sqrt(wide.cast("double") / below))


def behaviour_before(probes: DataFrame, fills: DataFrame, *, back_us: int | None = None, since: str = "time_us", block_us: int = DAY_US) -> DataFrame:
    """Probes (actor, time_us, ...) with four figures of what the actor did before, or in the look-back.

    ``fills``: actor, time_us, side, notional (BIGINT). ``per_day`` counts from
    the first fill (the least ``since``), or from the start of the look-back.
    """
    v = F.col("notional").cast(BIG)
    sums = {"__n": F.lit(1).cast("long"), "__s": v, "__q": v * v, "__u": F.when(F.col("side") == "BUY", v).otherwise(F.lit(0).cast(BIG))}
    if back_us is None:
        got = prior_totals(probes, fills, ["actor"], "time_us", sums, least={"__t": F.col(since)}, block_us=block_us)
    else:
        ticks = fills.dropna(subset=["actor", "time_us"]).groupBy("actor", "time_us").agg(*[F.sum(c).alias(m) for m, c in sums.items()])
        line = with_halo(probes.withColumn("__k", F.lit(1)).unionByName(ticks, allowMissingColumns=True), ["actor"], "time_us", back_us=back_us, block_us=max(block_us, back_us))
        frame = prior_frame(["actor", "__b"], "time_us", back_us)
        got = line.withColumns({m: F.coalesce(F.sum(m).over(frame), F.lit(0).cast("long" if m == "__n" else BIG)) for m in sums}).where("__k = 1 AND __own").drop("__k", "__own", "__b")
        got = got.withColumn("__t", F.col("time_us") - back_us)
    n, s = F.col("__n"), F.col("__s")
    return got.withColumns({
        "n_prior": n,
        "average_notional": _ratio(s, n),
        "notional_cv": F.when((n >= 2) & (s != 0), F.round(spread(n, s, F.col("__q"), sample=False) / (s.cast("double") / n.cast("double")), 9)),
        "buy_share": _ratio(F.col("__u"), s),
        "per_day": _ratio(n * DAY_US, F.col("time_us") - F.col("__t")),
        "notional_reason": F.when(n == 0, NO_FILLS),
        "cv_reason": F.when(n == 0, NO_FILLS).when(n == 1, ONE_FILL).when(s == 0, ZERO_MEAN),
        "share_reason": F.when(n == 0, NO_FILLS).when(s == 0, ZERO_TOTAL),
        "rate_reason": F.when(F.col("__t").isNull() | (F.col("__t") >= F.col("time_us")), NO_WINDOW),
    }).drop(*sums, "__t")


def positions_before(probes: DataFrame, closed: DataFrame, *, block_us: int = DAY_US) -> DataFrame:
    """Probes (probe, actor, time_us) with nine figures and the loss streak of positions closed and known before.

    ``closed``: actor, opened_us, closed_us, known_us, cost, pnl (BIGINT), all
    in one unit; the return on cost is taken to a millionth, rounded down.
    """
    pnl = F.col("pnl")
    when = lambda c, x: F.when(c, x).otherwise(F.lit(0).cast("long"))
    ready = closed.withColumn("time_us", F.greatest("closed_us", "known_us"))
    sums = {
        "__n": F.lit(1).cast("long"), "__s": pnl, "__r": F.floor((pnl * 1_000_000) / F.col("cost")).cast("long"), "__wn": F.when(F.col("pnl") > 0, 1).otherwise(0).cast("long"), "__w": when(F.col("pnl") > 0, pnl),
        "__ln": F.when(F.col("pnl") < 0, 1).otherwise(0).cast("long"), "__l": when(F.col("pnl") < 0, -pnl), "__h": (F.col("closed_us") - F.col("opened_us")).cast(BIG),
    }
    got = prior_totals(probes, ready, ["actor"], "time_us", sums, block_us=block_us)
    n, wn, ln = F.col("__n"), F.col("__wn"), F.col("__ln")
    none = F.when(n == 0, NO_POSITIONS)
    got = got.withColumns({
        "n_closed": n, "net_pnl": F.when(n > 0, F.col("__s").cast("double")), "mean_roi": _ratio(F.col("__r"), n * 1_000_000), "win_rate": _ratio(wn, n), "average_win": _ratio(F.col("__w"), wn), "average_loss": _ratio(F.col("__l"), ln),
        "payoff_ratio": F.when(wn > 0, _ratio(F.col("__w").cast(BIG) * ln, F.col("__l").cast(BIG) * wn)), "profit_factor": _ratio(F.col("__w"), F.col("__l")), "expectancy": _ratio(F.col("__s"), n), "holding_s": _ratio(F.col("__h"), n * 1_000_000),
        "position_reason": none, "win_reason": F.coalesce(none, F.when(wn == 0, NO_WINS)), "loss_reason": F.coalesce(none, F.when(ln == 0, NO_LOSSES)),
        "payoff_reason": F.coalesce(none, F.when((wn == 0) | (ln == 0), ONE_SIDED)),
    }).drop(*sums)
    return got.join(streaks_before(probes, ready), "probe")


def streaks_before(probes: DataFrame, ready: DataFrame) -> DataFrame:
    """(probe, loss_streak, streak_reason) of positions that count from ``time_us``, in the order of ``closed_us``."""
    line = probes.select("actor", "time_us", F.lit(0).alias("kind"), "probe", F.lit(0).cast("long").alias("at"), F.lit(False).alias("loss"))
    line = line.unionByName(ready.select("actor", "time_us", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("probe"), F.col("closed_us").alias("at"), (F.col("pnl") < 0).alias("loss"))).dropna(subset=["actor", "time_us"])
    return line.repartition("actor").sortWithinPartitions("actor", "time_us", "kind").mapInArrow(_streaks, "probe long, loss_streak long, streak_reason string")


def _streaks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """State: the last instant that is not all losses, whether it has one, and later losses by instant."""
    actor, seen, stop, mixed, later, total = None, False, None, False, {}, 0
    for batch in batches:
        out = []
        for a, kind, probe, at, loss in zip(*(batch.column(c).to_pylist() for c in ("actor", "kind", "probe", "at", "loss"))):
            if a != actor or not seen:
                actor, seen, stop, mixed, later, total, some = a, True, None, False, {}, 0, False
            if not kind:
                if not some:
                    out.append((probe, None, NO_POSITIONS))
                else:
                    out.append((probe, None, TIED_CLOSES) if mixed else (probe, total, None))
                continue
            some = True
            if stop is not None and at < stop:
                continue
            if loss:
                if at == stop:
                    mixed = True
                else:
                    later[at] = later.get(at, 0) + 1
                    total += 1
            elif at != stop:
                stop, mixed = at, later.pop(at, 0) > 0
                later = {k: v for k, v in later.items() if k > at}
                total = sum(later.values())
        kinds = [pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out) if out else [[]] * 3, kinds)], ["probe", "loss_streak", "streak_reason"])


def risk_before(probes: DataFrame, returns: DataFrame, *, least_periods: int = 30, block_us: int = DAY_US) -> DataFrame:
    """Probes (probe, actor, time_us) with volatility, Sharpe, Sortino and drawdown of periods ended and known before.

    ``returns``: actor, start_us, end_us, known_us, ret, benchmark, target
    (BIGINT, millionths), without overlaps. Periods of unequal length, with a
    gap, or known out of order give a reason. Nothing is annualised.
    """
    r, x, d = F.col("ret").cast(BIG), (F.col("ret") - F.col("benchmark")).cast(BIG), (F.col("ret") - F.col("target")).cast(BIG)
    low = F.least(d, F.lit(0).cast(BIG))
    size = F.col("end_us") - F.col("start_us")
    ready = returns.withColumn("time_us", F.greatest("end_us", "known_us"))
    sums = {"__n": F.lit(1).cast("long"), "__r": r, "__rr": r * r, "__x": x, "__xx": x * x, "__d": d, "__dd": low * low, "__len": size}
    least = {"__short": size, "__long": -size, "__first": F.col("start_us"), "__last": -F.col("end_us")}
    got = prior_totals(probes, ready, ["actor"], "time_us", sums, least=least, block_us=block_us)
    paths = drawdowns(returns)
    got = asof_prior(got, paths, ["actor"], "time_us", ["n_path", "drawdown"], prefix="__p_", block_us=max(block_us, 7 * DAY_US))
    n = F.col("__n")
    series = (
        F.when(n == 0, NO_RETURNS).when(F.col("__short") != -F.col("__long"), UNEVEN)
        .when(-F.col("__last") - F.col("__first") != F.col("__len"), GAPS).when(~F.col("__p_n_path").eqNullSafe(n), OUT_OF_ORDER)
    )
    few = F.coalesce(series, F.when(n < least_periods, FEW_RETURNS))
    sharpe_sd, down = spread(n, F.col("__x"), F.col("__xx"), sample=True), F.sqrt(F.col("__dd").cast("double") / n.cast("double"))
    flat_x, flat_d = F.coalesce(few, F.when(sharpe_sd == 0, FLAT_EXCESS)), F.coalesce(few, F.when(F.col("__dd") == 0, NO_DOWNSIDE))
    per = lambda c: c.cast("double") / n.cast("double")
    return got.select(
        "probe", n.alias("n_periods"), F.when(few.isNull(), F.round(spread(n, F.col("__r"), F.col("__rr"), sample=True) / 1e6, 9)).alias("volatility"), F.when(flat_x.isNull(), F.round(per(F.col("__x")) / sharpe_sd, 9)).alias("sharpe"),
        F.when(flat_d.isNull(), F.round(per(F.col("__d")) / down, 9)).alias("sortino"), F.when(series.isNull(), F.round("__p_drawdown", 9)).alias("drawdown"),
        few.alias("volatility_reason"), flat_x.alias("sharpe_reason"), flat_d.alias("sortino_reason"), series.alias("drawdown_reason"),
    )


def drawdowns(returns: DataFrame) -> DataFrame:
    """(actor, time_us, n_path, drawdown): largest fall of the first periods, from when all of them are known."""
    line = returns.select("actor", "start_us", "ret", F.greatest("end_us", "known_us").alias("ready"))
    folded = line.repartition("actor").sortWithinPartitions("actor", "start_us").mapInArrow(_drawdowns(line.schema["actor"].dataType.simpleString()), f"actor {line.schema['actor'].dataType.simpleString()}, time_us long, n_path long, drawdown double")
    return folded.groupBy("actor", "time_us").agg(F.max_by("drawdown", "n_path").alias("drawdown"), F.max("n_path").alias("n_path"))


def _drawdowns(kind: str):
    key = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        actor, started = None, False
        for batch in batches:
            out = []
            for a, ret, ready in zip(*(batch.column(c).to_pylist() for c in ("actor", "ret", "ready"))):
                if not started or a != actor:
                    actor, started, n, known, wealth, peak, down = a, True, 0, ready, 1.0, 1.0, 0.0
                n, known = n + 1, max(known, ready)
                wealth *= 1.0 + ret / 1e6
                peak = max(peak, wealth)
                down = max(down, (peak - wealth) / peak)
                out.append((a, known, n, down))
            kinds = [key, pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out) if out else [[]] * 4, kinds)], ["actor", "time_us", "n_path", "drawdown"])

    return run

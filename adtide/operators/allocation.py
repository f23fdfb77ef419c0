"""Fixed-budget allocation over channels, response curves and what-if budgets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import change_marker, exponential_saturation, safe_ratio
from .panel import panel_window

# Range of a channel's multiplier.
M_MIN, M_MAX = 0.3, 2.0
STEPS = 340
FINE_STEPS = 340
CURVE_POINTS = 120
#: Halvings of the price bracket, and Newton steps of a channel's answer to one price.
PRICE_STEPS = 60
ANSWER_STEPS = 12


def mean_revenue(m: Column) -> Column:
    """Revenue of a series at multiplier ``m`` with the posterior-mean parameters."""
    total = F.aggregate(
        "stock", F.lit(0.0), lambda acc, a: acc + exponential_saturation(m * a, F.col("sat_k"))
    )
    return F.col("revenue_mean") * F.col("beta") * total


def _fill(means: DataFrame, steps: int) -> DataFrame:
    """Take steps between ``lo`` and ``hi`` in order of revenue per EUR until the panel's budget is
    spent, the last one in part. Revenue is concave in m, so a channel's steps come in order."""
    width = (F.col("hi") - F.col("lo")) / steps
    at = lambda s: mean_revenue(F.col("lo") + s * width)
    cost = F.col("cost")
    # each grid point is evaluated once; a step's gain is the difference of its ends
    worth = means.select("*", F.transform(F.sequence(F.lit(0), F.lit(steps)), at).alias("_worth"))
    gain = F.zip_with(F.slice("_worth", 2, steps), F.slice("_worth", 1, steps), lambda end, start: end - start)
    gains = worth.select(
        "panel_id", "channel", "free", (width * F.col("spend_total")).alias("cost"), F.posexplode(gain).alias("step", "gain")
    )
    order = panel_window().orderBy((F.col("gain") / cost).desc(), "channel", "step")
    before = F.sum(cost).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - cost
    taken = gains.where(cost > 0).select(
        "panel_id",
        "channel",
        F.least(F.greatest((F.col("free") - before) / cost, F.lit(0.0)), F.lit(1.0)).alias("share"),
    )
    return taken.groupBy("panel_id", "channel").agg(F.sum("share").alias("filled"))


def _within(means: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Adds the bounds and the budget left after every channel got its lower bound."""
    left = F.sum("spend_total").over(panel_window()) - F.sum(lo * F.col("spend_total")).over(panel_window())
    return means.withColumn("lo", lo).withColumn("hi", hi).withColumn("free", left)


def budget_allocation(
    means: DataFrame, m_min: float = M_MIN, m_max: float = M_MAX, steps: int = STEPS,
    fine_steps: int = FINE_STEPS,
) -> DataFrame:
    """(panel_id, channel, spend_total, multiplier) of the best split of each panel's budget.

    Against the best plan between grid points, every channel of the first plan is off by less than
    one step of its own plus what one step of all other channels costs: at most ``step`` times the
    panel's budget in EUR. The second pass re-divides that reach on either side, which leaves an
    error of about ``2 * step / fine_steps`` of the budget. Windows hold channels x steps rows per
    panel. Channels without spend keep multiplier 1.
    """
    keys = ["panel_id", "channel"]
    step = (m_max - m_min) / steps
    coarse = _within(means, F.lit(m_min), F.lit(m_max))
    first = coarse.join(_fill(coarse, steps), keys, "left").withColumn(
        "m1", F.lit(m_min) + F.col("filled") * step
    )
    # a channel without spend has no steps and costs nothing at any bound
    m1 = F.coalesce(F.col("m1"), F.lit(1.0))
    reach = step * safe_ratio(F.sum("spend_total").over(panel_window()), F.col("spend_total"))
    fine = _within(
        first.drop("lo", "hi", "free", "filled").withColumn("reach", reach),
        F.greatest(m1 - F.col("reach"), F.lit(m_min)),
        F.least(m1 + F.col("reach"), F.lit(m_max)),
    )
    width = (F.col("hi") - F.col("lo")) / fine_steps
    return fine.join(_fill(fine, fine_steps), keys, "left").select(
        *keys,
        "spend_total",
        F.coalesce(F.col("lo") + F.col("filled") * width, F.lit(1.0)).alias("multiplier"),
    )


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _marginal(c: Column, m: Column) -> Column:
    """Log of a channel's revenue per further EUR at ``m``, and its slope; null where nothing is gained."""
    return F.aggregate(
        c["stock"],
        F.struct(F.lit(0.0).alias("first"), F.lit(0.0).alias("second")),
        lambda acc, a: F.struct(
            (acc["first"] + a * F.exp(-m * a / c["sat_k"])).alias("first"),
            (acc["second"] + a * a * F.exp(-m * a / c["sat_k"])).alias("second"),
        ),
        lambda acc: F.struct(
            # the logarithm of zero is null
            (F.log(c["scale"]) + F.log(acc["first"])).alias("log"),
            (safe_ratio(acc["second"], acc["first"]) / c["sat_k"]).alias("fall"),
        ),
    )


def _answer(c: Column, start: Column, price: Column, m_max: float) -> Column:
    """The multiplier at which a channel's marginal revenue falls to ``price``, from one below it.

    The log of a sum of exponentials is convex, so Newton's steps come from the left and never pass
    the root; a channel that gains nothing stays where it is.
    """
    # without a fall that a double can hold the answer is the upper bound
    step = lambda g: F.when(
        g["log"] > price, F.coalesce(F.try_divide(g["log"] - price, g["fall"]), F.lit(m_max))
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ANSWER_STEPS)),
        start,
        lambda m, _: F.least(m + F.coalesce(_let(_marginal(c, m), step), F.lit(0.0)), F.lit(m_max)),
    )


def optimal_allocation(means: DataFrame, m_min: float = M_MIN, m_max: float = M_MAX) -> DataFrame:
    """(panel_id, channel, spend_total, multiplier, marginal) of the best split of each panel's budget.

    Revenue is concave in every multiplier, so at the optimum all channels between their bounds earn
    the same for a further EUR. That price is bisected: each channel answers it with its multiplier,
    and a plan over the budget raises it. The plan lies between the answers at both ends of the last
    bracket and spends the budget exactly, also where channels are tied or gain nothing. ``marginal``
    is the revenue of a further EUR. A panel is one row of channels x weeks values; channels without
    spend keep multiplier 1 and have no marginal, and one with a null parameter gains nothing.
    """
    paid = means.where(F.col("spend_total") > 0).select(
        "panel_id",
        F.struct(
            "channel",
            "spend_total",
            "sat_k",
            "stock",
            (F.col("revenue_mean") * F.col("beta") / F.col("sat_k") / F.col("spend_total")).alias("scale"),
        ).alias("c"),
    )
    panels = paid.groupBy("panel_id").agg(F.sort_array(F.collect_list("c")).alias("cs"))
    cs = F.col("cs")
    total = F.aggregate(cs, F.lit(0.0), lambda acc, c: acc + c["spend_total"])

    def spent(plan: Column) -> Column:
        costs = F.zip_with(cs, plan, lambda c, m: c["spend_total"] * m)
        return F.aggregate(costs, F.lit(0.0), lambda acc, x: acc + x)

    def everywhere(m: float) -> Column:
        return F.transform(cs, lambda c: F.lit(m))

    def logs(m: float) -> Column:
        return F.transform(cs, lambda c: _marginal(c, F.lit(m))["log"])

    def halve(state: Column, _: Column) -> Column:
        def narrowed(tried: Column) -> Column:
            over = spent(tried["plan"]) >= F.col("budget")
            return F.struct(
                F.when(over, tried["price"]).otherwise(state["low"]).alias("low"),
                F.when(over, state["high"]).otherwise(tried["price"]).alias("high"),
                F.when(over, tried["plan"]).otherwise(state["most"]).alias("most"),
                F.when(over, state["least"]).otherwise(tried["plan"]).alias("least"),
            )

        price = (state["low"] + state["high"]) / 2
        # answers at the higher price lie to the left
        plan = F.zip_with(cs, state["least"], lambda c, m: _answer(c, m, price, m_max))
        return _let(F.struct(price.alias("price"), plan.alias("plan")), narrowed)

    bracket = F.aggregate(
        F.sequence(F.lit(1), F.lit(PRICE_STEPS)),
        F.struct(
            (F.coalesce(F.array_min(logs(m_max)), F.lit(0.0)) - 1).alias("low"),
            (F.coalesce(F.array_max(logs(m_min)), F.lit(0.0)) + 1).alias("high"),
            everywhere(m_max).alias("most"),
            everywhere(m_min).alias("least"),
        ),
        halve,
    )
    ends = panels.withColumn("budget", total).withColumn("b", bracket)
    least, most = spent(F.col("b.least")), spent(F.col("b.most"))
    share = F.coalesce(safe_ratio(F.col("budget") - least, most - least), F.lit(0.0))
    plan = F.zip_with("b.least", "b.most", lambda lo, hi: lo + F.col("share") * (hi - lo))
    rows = ends.withColumn("share", share).select(
        "panel_id", F.inline(F.arrays_zip(cs.alias("c"), plan.alias("m")))
    )
    best = rows.select(
        "panel_id",
        F.col("c.channel").alias("channel"),
        F.col("m").alias("_m"),
        F.coalesce(F.exp(_marginal(F.col("c"), F.col("m"))["log"]), F.lit(0.0)).alias("marginal"),
    )
    return means.join(best, ["panel_id", "channel"], "left").select(
        "panel_id", "channel", "spend_total", F.coalesce("_m", F.lit(1.0)).alias("multiplier"), "marginal"
    )


def allocation_table(allocation: DataFrame) -> DataFrame:
    """Current and recommended EUR and percent per channel, multiplier and direction."""
    now, rec = F.col("spend_total"), F.col("multiplier") * F.col("spend_total")
    total = F.sum("spend_total").over(panel_window())
    return allocation.select(
        "panel_id",
        "channel",
        now.alias("current_eur"),
        (safe_ratio(now, total) * 100).alias("current_pct"),
        rec.alias("recommended_eur"),
        (safe_ratio(rec, total) * 100).alias("recommended_pct"),
        "multiplier",
        change_marker(F.col("multiplier")).alias("direction"),
    )


def response_curve(means: DataFrame, m_max: float = M_MAX, points: int = CURVE_POINTS) -> DataFrame:
    """Revenue of every series on ``points`` multipliers from 0 to ``m_max``."""
    grid = means.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("step"))
    m = F.col("step") * m_max / (points - 1)
    return grid.select(
        "panel_id",
        "channel",
        "step",
        m.alias("m"),
        (m * F.col("spend_total")).alias("spend"),
        mean_revenue(m).alias("revenue"),
    )


def marked_points(means: DataFrame, allocation: DataFrame) -> DataFrame:
    """Each series at its current and at its recommended multiplier."""
    chosen = means.join(
        allocation.select("panel_id", "channel", "multiplier"), ["panel_id", "channel"]
    )
    points = F.array(
        F.struct(F.lit("current").alias("point"), F.lit(1.0).alias("m")),
        F.struct(F.lit("recommended").alias("point"), F.col("multiplier").alias("m")),
    )
    return chosen.select("*", F.inline(points)).select(
        "panel_id",
        "channel",
        "point",
        "m",
        (F.col("m") * F.col("spend_total")).alias("spend"),
        mean_revenue(F.col("m")).alias("revenue"),
    )


def scenario_budget(totals: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Per scenario and channel: EUR and percent of the selected budget, and the budget's drift
    from the current one."""
    on = [c for c in ("panel_id", "channel") if c in scenarios.columns]
    w = Window.partitionBy("panel_id", "scenario_id")
    rows = totals.join(scenarios, on).withColumn("selected_eur", F.col("m") * F.col("spend_total"))
    selected, current = F.sum("selected_eur").over(w), F.sum("spend_total").over(w)
    return rows.select(
        "panel_id",
        "scenario_id",
        "channel",
        "selected_eur",
        (safe_ratio(F.col("selected_eur"), selected) * 100).alias("selected_pct"),
        selected.alias("selected_total"),
        (selected - current).alias("drift_eur"),
        (safe_ratio(selected - current, current) * 100).alias("drift_pct"),
    )

"""Weekly media panels: dense calendars, scaling, shares, long/wide shapes.

A panel frame has the key (panel_id, channel, week), a week index ``t`` from 0, the calendar
length ``n_weeks`` and the measures spend, revenue and competitor. Its groups are bounded by the
calendar (weeks x channels), not by the raw data, so windows and arrays per panel stay small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import fourier_terms, safe_ratio

MEASURES = ("spend", "revenue", "competitor")


def series_window() -> WindowSpec:
    return Window.partitionBy("panel_id", "channel")


def panel_window() -> WindowSpec:
    return Window.partitionBy("panel_id")


def densify(cells: DataFrame) -> DataFrame:
    """Every channel of a panel gets every week between the panel's first and last, zero-filled.

    Cells of the same week are summed. Weeks start seven days apart: a cell on another weekday is an
    error, since moving it would change results without notice. Each series is gathered once and its gaps are filled in
    place, so the cells (a scan of the fact tables) are read once and joined to nothing.
    """
    cells = cells.groupBy("panel_id", "channel", "week").agg(*[F.sum(m).alias(m) for m in MEASURES])
    packed = cells.groupBy("panel_id", "channel").agg(
        F.sort_array(F.collect_list(F.struct("week", *MEASURES))).alias("points")
    )
    first = F.min(F.element_at("points", 1)["week"]).over(panel_window())
    last = F.max(F.element_at("points", -1)["week"]).over(panel_window())
    spanned = packed.select("*", first.alias("w0"), last.alias("w1")).withColumn(
        "n_weeks", _weeks_between(F.col("w0"), F.col("w1")) + 1
    )
    zero = F.struct(*[F.lit(0.0).alias(m) for m in MEASURES])

    def with_gap(p: Column, i: Column) -> Column:
        following = F.get("points", i + 1)["week"]
        until = F.coalesce(_weeks_between(F.col("w0"), following), F.col("n_weeks"))
        gap = until - _weeks_between(F.col("w0"), p["week"]) - 1
        return F.concat(
            F.array(F.struct(*[p[m].alias(m) for m in MEASURES])), F.array_repeat(zero, gap)
        )

    lead = _weeks_between(F.col("w0"), F.element_at("points", 1)["week"])
    filled = F.concat(F.array_repeat(zero, lead), F.flatten(F.transform("points", with_gap)))
    return spanned.select(
        "panel_id", "channel", "w0", "n_weeks", F.posexplode(filled).alias("t", "cell")
    ).select(
        "panel_id",
        "channel",
        F.date_add("w0", F.col("t") * 7).alias("week"),
        F.col("t").cast("bigint").alias("t"),
        F.col("n_weeks").cast("bigint").alias("n_weeks"),
        *[F.col(f"cell.{m}").alias(m) for m in MEASURES],
    )


def _weeks_between(start: Column, end: Column) -> Column:
    days = F.datediff(end, start)
    off = F.raise_error(F.concat(F.lit("cell is not a whole number of weeks after "), start.cast("string")))
    return F.when(days % 7 == 0, (days / 7).cast("int")).when(days.isNotNull(), off.cast("int"))


def weekly_totals(panel: DataFrame) -> DataFrame:
    """(panel_id, week, t, n_weeks, revenue, competitor, spend)."""
    return panel.groupBy("panel_id", "week", "t", "n_weeks").agg(
        *[F.sum(m).alias(m) for m in MEASURES]
    )


def widen(panel: DataFrame, channels: list[str], measure: str = "spend") -> DataFrame:
    """One column per listed channel."""
    keys = ["panel_id", "week", "t"]
    return (
        panel.groupBy(*keys)
        .pivot("channel", channels)
        .agg(F.sum(measure))
        .select(*keys, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in channels])
    )


def lengthen(wide: DataFrame, channels: list[str], measure: str = "spend") -> DataFrame:
    return wide.unpivot(["panel_id", "week", "t"], channels, "channel", measure)


def scale_by_mean(weekly: DataFrame, column: str = "revenue") -> DataFrame:
    """Adds ``scaled = column / mean`` within the panel."""
    return weekly.withColumn("scaled", safe_ratio(F.col(column), F.avg(column).over(panel_window())))


def scale_spend(panel: DataFrame) -> DataFrame:
    """Adds ``scaled = spend / max(spend, 1)`` within the series."""
    top = F.greatest(F.max("spend").over(series_window()), F.lit(1.0))
    return panel.withColumn("scaled", F.col("spend") / top)


def competitor_index(weekly: DataFrame) -> DataFrame:
    top = F.max("competitor").over(panel_window())
    return weekly.withColumn("competitor_index", safe_ratio(F.col("competitor"), top))


def trend_term() -> Column:
    return F.col("t") / F.col("n_weeks")


def calendar_terms(weekly: DataFrame) -> DataFrame:
    """Season, trend and competitor columns of a week."""
    return competitor_index(weekly).select(
        "panel_id",
        "week",
        "t",
        "revenue",
        *fourier_terms(F.col("t")),
        trend_term().alias("trend"),
        F.col("competitor_index").alias("competitor"),
    )


def budget_share(panel: DataFrame) -> DataFrame:
    """Total per channel and its percentage of the panel's total."""
    totals = panel.groupBy("panel_id", "channel").agg(F.sum("spend").alias("spend_total"))
    share = safe_ratio(F.col("spend_total"), F.sum("spend_total").over(panel_window())) * 100
    return totals.withColumn("share_pct", share)


def pack_series(panel: DataFrame) -> DataFrame:
    """One row per series: scaled spend as an array by t, plus the scaling constants."""
    packed = panel.groupBy("panel_id", "channel").agg(
        F.sort_array(F.collect_list(F.struct("t", "spend"))).alias("points"),
        F.sum("spend").alias("spend_total"),
        F.greatest(F.max("spend"), F.lit(1.0)).alias("spend_max"),
        F.sum("revenue").alias("revenue_part"),
        F.max("n_weeks").alias("n_weeks"),
    )
    mean = F.sum("revenue_part").over(panel_window()) / F.col("n_weeks")
    return packed.select(
        "panel_id",
        "channel",
        "n_weeks",
        F.transform("points", lambda p: p["spend"] / F.col("spend_max")).alias("xs"),
        "spend_total",
        "spend_max",
        mean.alias("revenue_mean"),
    )


def pack_weekly(panel: DataFrame) -> DataFrame:
    """One row per panel: the calendar terms of every week as an array by t."""
    terms = calendar_terms(weekly_totals(panel)).withColumn(
        "revenue_mean", F.avg("revenue").over(panel_window())
    )
    columns = ["t", "week", "season_0", "season_1", "season_2", "season_3", "trend", "competitor"]
    return terms.groupBy("panel_id").agg(
        F.sort_array(F.collect_list(F.struct(*columns))).alias("weeks"),
        F.first("revenue_mean").alias("revenue_mean"),
    )

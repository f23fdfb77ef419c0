"""The two end-to-end jobs: media model with budget allocation, and click model.

Each step is stored before the next reads it, so a lost executor or driver costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import md5_bucket
from ..operators import allocation, clicks, metrics, panel, posterior, regression
from ..sources import spread_rows, write_csv, write_parquet


def media_job(
    cells: DataFrame, params: DataFrame, channels: list[str], draws: DataFrame,
    draws_global: DataFrame, divergences: DataFrame, out: str,
) -> dict[str, DataFrame]:
    """From media cells and posterior draws to ROI, allocation and uplift tables under ``out``.

    ``draws`` has (panel_id, chain, draw, channel, decay, sat_k, beta), ``draws_global`` the shared
    parameters of each draw, ``divergences`` their number for each panel; any sampler may have made
    them. All panels are handled at once. Returns the stored tables by name; ``roi`` and
    ``allocation`` are also written as CSV.
    """
    def keep(name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        return write_parquet(df, f"{out}/{name}", partition_by)

    dense = keep("panel", panel.densify(cells))
    design = keep("design", regression.mmm_design(dense, params, channels))
    spend = [f"spend_{c}" for c in channels]
    tables = {
        "naive_fit": keep("naive_fit", regression.ols_fit(design, "panel_id", spend, "revenue")),
        "fit": keep(
            "fit",
            regression.ols_fit(design, "panel_id", [*channels, *regression.CONTROLS], "revenue"),
        ),
    }
    coefs = tables["fit"].select("panel_id", "term", "coef")
    contribs = keep(
        "contributions", regression.contributions(design, coefs, channels, ["panel_id", "term"])
    )
    tables["model_roi"] = keep("model_roi", regression.channel_roi(contribs))
    tables["contributions"] = contribs

    series = keep("series", panel.pack_series(dense))
    bucket = F.pmod(F.hash("panel_id"), F.lit(64))
    per_channel = keep("draws", draws.withColumn("bucket", bucket), ["bucket"]).drop("bucket")
    shared = keep("draws_global", draws_global.withColumn("bucket", bucket), ["bucket"]).drop("bucket")
    rhat = posterior.split_rhat(posterior.long_parameters(per_channel, shared))
    tables["convergence"] = keep("convergence", posterior.convergence_verdict(rhat, divergences))
    roi_draws = keep("roi_draws", posterior.roi_by_draw(per_channel, series))
    tables["roi"] = keep("roi", posterior.posterior_roi(roi_draws, series))

    means = keep("means", posterior.posterior_means(per_channel, series))
    best = keep("best", allocation.optimal_allocation(means))
    tables["allocation"] = keep("allocation", allocation.allocation_table(best))
    choice = F.array(
        F.struct(F.lit("current").alias("scenario_id"), F.lit(1.0).alias("m")),
        F.struct(F.lit("recommended").alias("scenario_id"), F.col("multiplier").alias("m")),
    )
    scenarios = best.select("panel_id", "channel", F.inline(choice))
    uplift = keep(
        "uplift_draws",
        posterior.uplift_by_draw(posterior.scenario_revenue(per_channel, series, scenarios)),
    )
    tables["uplift"] = keep("uplift", posterior.uplift_summary(uplift))
    write_csv(tables["roi"], f"{out}/roi_csv")
    write_csv(tables["allocation"], f"{out}/allocation_csv")
    return tables


def click_job(
    log: DataFrame, key: list[str], int_cols: list[str], cat_cols: list[str], out: str,
    label: str = "label",
) -> dict[str, DataFrame]:
    """From an ad log to a stored model, scored test rows, and the metric and ROC tables."""
    clean = clicks.clean_features(log, int_cols, cat_cols, label, keep=key)
    split = clicks.with_split(
        spread_rows(clean, key), md5_bucket(F.concat_ws("|", *key), 100)
    )
    features = clicks.feature_table(split, int_cols, cat_cols, [*key, label, "split"])
    stored = write_parquet(features, f"{out}/features", ["split"], gather=False)
    model = clicks.fit_click_model(stored.where(F.col("split") == "train"), label)
    clicks.save_model(model, f"{out}/model")
    scored = write_parquet(
        clicks.score_rows(model, stored, [*key, label, "split"]), f"{out}/scored"
    )
    test = scored.where(F.col("split") == "test")
    return {
        "scored": scored,
        "metrics": write_parquet(metrics.metric_report(scored, label), f"{out}/metrics"),
        "roc": write_parquet(
            metrics.roc_curve(metrics.confusion_by_score(test, label)), f"{out}/roc"
        ),
    }

"""Evaluation of probabilistic classifiers: ROC, AUC, precision-recall, log-loss, lift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clip, safe_ratio
from .ordered import running_totals

EPS = 1e-12


def confusion_by_score(
    df: DataFrame, label: str = "label", score: str = "score", splits: int | None = None
) -> DataFrame:
    """One row per distinct score, highest first in meaning: positives and negatives at the score,
    counted from the top (``tp``, ``fp``) and in total. Tied scores are one row."""
    marked = df.select(
        F.col(score).alias("score"),
        F.col(label).cast("bigint").alias("pos"),
        (1 - F.col(label)).cast("bigint").alias("neg"),
    )
    cum = running_totals(marked, [], "score", ["pos", "neg"], splits, descending=True)
    return cum.select(
        "score",
        "pos",
        "neg",
        F.col("pos_cum").alias("tp"),
        F.col("neg_cum").alias("fp"),
        F.col("pos_total").alias("positives"),
        F.col("neg_total").alias("negatives"),
    )


def roc_curve(confusion: DataFrame) -> DataFrame:
    """(score, tp, fp, tpr, fpr) with the point (0, 0), whose score is null."""
    points = confusion.select(
        "score",
        "tp",
        "fp",
        (F.col("tp") / F.greatest("positives", F.lit(1))).alias("tpr"),
        (F.col("fp") / F.greatest("negatives", F.lit(1))).alias("fpr"),
    )
    origin = confusion.sparkSession.sql(
        "SELECT CAST(NULL AS DOUBLE) AS score, 0L AS tp, 0L AS fp, 0D AS tpr, 0D AS fpr"
    )
    return points.unionByName(origin)


def auc_roc(confusion: DataFrame) -> DataFrame:
    """Exact area: share of (positive, negative) pairs ranked right, ties count one half."""
    return confusion.agg(_roc_area().alias("auc_roc"))


def _roc_area() -> Column:
    pairs = F.col("neg") * (F.col("tp") - F.col("pos") / 2)
    total = F.max("positives").cast("double") * F.max("negatives")
    return F.try_divide(F.sum(pairs), total)


def auc_pr(confusion: DataFrame) -> DataFrame:
    """Trapezoids over (recall, precision) from (0, first precision).

    The point before a score needs only that score's own row: tp - pos, fp - neg.
    """
    return confusion.agg(_pr_area().alias("auc_pr"))


def _pr_area() -> Column:
    tp, fp = F.col("tp"), F.col("fp")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    here = tp / (tp + fp)
    before = F.when(tp0 + fp0 == 0, here).otherwise(F.try_divide(tp0, tp0 + fp0))
    area = F.col("pos") * (here + before) / 2
    return F.try_divide(F.sum(area), F.max("positives"))


def log_loss_term(label: Column, p: Column, eps: float = EPS) -> Column:
    q = clip(p, eps, 1 - eps)
    return -(label * F.log(q) + (1 - label) * F.log(1 - q))


def log_loss(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return df.agg(F.avg(log_loss_term(F.col(label), F.col(score))).alias("log_loss"))


def baseline_log_loss(split: DataFrame, label: str = "label", part: str = "split") -> DataFrame:
    """Log-loss of always predicting the train rate, on the test rows: both rates in one pass."""
    rates = split.agg(
        F.avg(F.when(F.col(part) == "train", F.col(label))).alias("train_ctr"),
        F.avg(F.when(F.col(part) == "test", F.col(label))).alias("test_ctr"),
    )
    return rates.withColumn(
        "baseline_log_loss", log_loss_term(F.col("test_ctr"), F.col("train_ctr"))
    )


def lift_pct(model: Column, base: Column) -> Column:
    """By how many percent a loss fell against its baseline."""
    return safe_ratio(base - model, base) * 100


def metric_report(
    scored: DataFrame, label: str = "label", score: str = "score", part: str = "split"
) -> DataFrame:
    """(metric, model, baseline, lift_pct) on the test rows; of the others only labels are read. Both areas
    come from one pass over the ordered scores."""
    test = scored.where(F.col(part) == "test")
    confusion = confusion_by_score(test, label, score)
    areas = confusion.agg(F.struct(_roc_area().alias("auc_roc"), _pr_area().alias("auc_pr")).alias("areas"))
    scalars = (
        baseline_log_loss(scored, label, part)
        .withColumn("_areas", areas.scalar())
        .select("*", "_areas.*")
        .withColumn("log_loss", log_loss(test, label, score).scalar())
    )

    def row(name: str, model: str, base: Column, lift: Column) -> Column:
        return F.struct(
            F.lit(name).alias("metric"),
            F.col(model).alias("model"),
            base.alias("baseline"),
            lift.alias("lift_pct"),
        )

    gain = lambda m, b: safe_ratio(F.col(m) - b, b) * 100
    base = F.col("baseline_log_loss")
    rows = F.array(
        row("auc_roc", "auc_roc", F.lit(0.5), gain("auc_roc", F.lit(0.5))),
        row("auc_pr", "auc_pr", F.col("test_ctr"), gain("auc_pr", F.col("test_ctr"))),
        row("log_loss", "log_loss", base, lift_pct(F.col("log_loss"), base)),
    )
    return scalars.select(F.inline(rows))

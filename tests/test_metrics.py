import math

import numpy as np
import pytest

from adtide.operators import clicks, metrics


def scored(spark, labels, scores):
    rows = [(int(y), float(p)) for y, p in zip(labels, scores)]
    return spark.createDataFrame(rows, "label int, score double")


def value(df):
    return df.first()[0]


def test_roc_perfect_inverse_and_shape(spark):
    y = [0, 0, 0, 1, 1, 1]
    up, down = [0.1, 0.2, 0.3, 0.7, 0.8, 0.9], [0.9, 0.8, 0.7, 0.3, 0.2, 0.1]
    assert value(metrics.auc_roc(metrics.confusion_by_score(scored(spark, y, up)))) == 1
    assert value(metrics.auc_roc(metrics.confusion_by_score(scored(spark, y, down)))) == 0
    mixed = scored(spark, [0, 1, 1, 0, 1, 0, 1, 0], [0.1, 0.9, 0.4, 0.4, 0.8, 0.3, 0.2, 0.6])
    pts = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(metrics.confusion_by_score(mixed)).collect())
    assert pts[0] == (0, 0) and pts[-1] == (1, 1)
    assert all(a[1] <= b[1] for a, b in zip(pts, pts[1:]))
    assert len(pts) == 8  # seven distinct scores and the origin


def test_areas_against_brute_force_and_evaluator(spark):
    rng = np.random.default_rng(3)
    y = rng.random(800) < 0.3
    p = np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1)
    p[:300] = p[:300].round(1)  # ties
    df = scored(spark, y, p).repartition(5)
    conf = metrics.confusion_by_score(df, splits=8)
    pos, neg = p[y], p[~y]
    pairs = (pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2
    assert value(metrics.auc_roc(conf)) == pytest.approx(pairs / (len(pos) * len(neg)), rel=1e-12)
    assert value(metrics.auc_roc(conf)) == pytest.approx(clicks.binned_area(df, "areaUnderROC"), abs=2e-3)
    assert value(metrics.auc_pr(conf)) == pytest.approx(clicks.binned_area(df, "areaUnderPR"), abs=5e-3)


def test_one_class_labels(spark):
    conf = metrics.confusion_by_score(scored(spark, [1, 1], [0.2, 0.7]))
    assert value(metrics.auc_roc(conf)) is None
    rows = metrics.roc_curve(conf).collect()
    assert max(r["tpr"] for r in rows) == 1 and max(r["fpr"] for r in rows) == 0


def test_log_loss_clips(spark):
    df = scored(spark, [1, 0, 1], [1.0, 0.25, 0.0])
    want = -(math.log(1 - 1e-12) + math.log(0.75) + math.log(1e-12)) / 3
    assert value(metrics.log_loss(df)) == pytest.approx(want, rel=1e-9)


def test_report(spark):
    rows = [("train", 1, 0.5)] * 1 + [("train", 0, 0.5)] * 3 + [("test", 1, 0.8), ("test", 0, 0.3), ("test", 0, 0.1)]
    df = spark.createDataFrame(rows, "split string, label int, score double")
    got = {r["metric"]: r for r in metrics.metric_report(df).collect()}
    base = -(math.log(0.25) / 3 + 2 * math.log(0.75) / 3)
    loss = -(math.log(0.8) + math.log(0.7) + math.log(0.9)) / 3
    assert got["auc_roc"]["model"] == 1 and got["auc_roc"]["baseline"] == 0.5
    assert got["auc_pr"]["baseline"] == pytest.approx(1 / 3)
    assert got["log_loss"]["model"] == pytest.approx(loss)
    assert got["log_loss"]["lift_pct"] == pytest.approx((base - loss) / base * 100)

import numpy as np
import pandas as pd

from orrery.operators.evaluate import (classification_report, confusion_matrix, roc_auc,
                                       roc_points, select_best)


def _pairs_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))


def test_auc_matches_pair_counting_with_ties_and_buckets(spark):
    rng = np.random.RandomState(1)
    y = rng.randint(0, 3, 3000)
    s0 = np.round(rng.rand(3000) + 0.3 * (y == 0), 2)     # rounding creates ties
    s1 = np.round(rng.rand(3000), 1)
    pdf = pd.DataFrame({"label": y, "s0": s0, "s1": s1})
    df = spark.createDataFrame(pdf).repartition(6)
    for nb in (None, 5):
        auc = {r["class"]: r["auc"] for r in roc_auc(df, "label", {0: "s0", 1: "s1"}, n_buckets=nb, digits=12).collect()}
        assert abs(auc[0] - _pairs_auc((y == 0).astype(int), s0)) < 1e-9
        assert abs(auc[1] - _pairs_auc((y == 1).astype(int), s1)) < 1e-9
    pts = roc_points(df, "label", {1: "s1"}, n_buckets=4).toPandas()
    assert len(pts) == len(np.unique(s1))                  # ties collapse into one point
    top = pts.sort_values("threshold").iloc[0]
    assert top.tp == (y == 1).sum() and top.fp == (y != 1).sum()


def test_confusion_has_all_cells_and_report_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "label int, prediction int")
    cm = confusion_matrix(df, labels=[0, 1, 2, 3]).toPandas()
    assert len(cm) == 16 and cm.n.sum() == 4
    rep = {r["label"]: r for r in classification_report(df, labels=[0, 1, 2]).collect()}
    assert rep["2"]["precision"] == 0.0 and rep["2"]["recall"] == 0.0 and rep["2"]["f1_score"] == 0.0
    assert rep["accuracy"]["f1_score"] == 0.5 and rep["macro avg"]["support"] == 4


def test_select_best_prefers_default_on_tie(spark):
    m = spark.createDataFrame([("svm", 0.9), ("random_forest", 0.9)], "model string, accuracy double")
    assert select_best(m).first()["best_model"] == "random_forest"
    m2 = spark.createDataFrame([("svm", 0.91), ("random_forest", 0.9)], "model string, accuracy double")
    assert select_best(m2).first()["best_model"] == "svm"


def test_rows_outside_the_labels_are_counted(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (1, None), (0, 7), (None, 0)], "label int, prediction int")
    cm = {(r.true_label, r.pred_label): r.n for r in confusion_matrix(df, labels=[0, 1]).collect()}
    assert cm == {(0, 0): 1, (0, 1): 0, (1, 0): 0, (1, 1): 1, (1, None): 1, (0, None): 1, (None, 0): 1}
    rep = {r.label: r for r in classification_report(df, labels=[0, 1]).collect()}
    assert rep["accuracy"].f1_score == 0.4 and rep["accuracy"].support == 5
    assert rep["0"].support == rep["1"].support == 2 and rep["0"].recall == 0.5 and rep["0"].precision == 0.5

"""Evaluation tables: accuracy, confusion matrix, per-class report, class
prediction error, one-vs-rest ROC and AUC, and model choice.

All of them reduce the scored table to at most k x k (or distinct-score) rows
with map-side combined aggregates before any small-table logic runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orrery.operators.prefix import running_sums
from orrery.session import cut_lineage

MAX_CLASSES = 1_000  # the k x k cells are made in one task


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction",
             digits: int = 6) -> DataFrame:
    return df.agg(F.round(F.avg(F.when(F.col(label) == F.col(pred), 1.0).otherwise(0.0)),
                          digits).alias("accuracy"),
                  F.count("*").alias("n"))


def label_set(df: DataFrame, label: str, pred: str, max_classes: int = MAX_CLASSES) -> list:
    """Sorted union of true and predicted labels (sklearn ``unique_labels``);
    its size is bounded by ``max_classes`` and checked."""
    vals = (df.select(F.col(label).alias("v")).unionByName(df.select(F.col(pred).alias("v")))
              .where(F.col("v").isNotNull()).distinct().limit(max_classes + 1).collect())
    if len(vals) > max_classes:
        raise ValueError(f"more than {max_classes} labels")
    return sorted(r["v"] for r in vals)


def _grid(spark: SparkSession, labels: Sequence) -> DataFrame:
    each = F.array(*[F.lit(v) for v in labels])
    return (spark.range(1).select(F.explode(each).alias("true_label"))
                 .select("true_label", F.explode(each).alias("pred_label")))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction",
                     labels: Sequence | None = None) -> DataFrame:
    """(true_label, pred_label, n) for every k x k cell, zeros included. Rows
    whose label or prediction is NULL or none of ``labels`` are counted too:
    under NULL, in rows that exist only where there are such."""
    labels = list(labels) if labels is not None else label_set(df, label, pred)
    known = lambda c: F.when(F.col(c).isin(*labels), F.col(c))
    counts = (df.groupBy(known(label).alias("true_label"), known(pred).alias("pred_label"))
                .agg(F.count("*").alias("n")))
    inside = (_grid(df.sparkSession, labels).join(counts, ["true_label", "pred_label"], "left")
              .select("true_label", "pred_label", F.coalesce("n", F.lit(0)).cast("long").alias("n")))
    return inside.unionByName(counts.where("true_label IS NULL OR pred_label IS NULL")
                              .select("true_label", "pred_label", F.col("n").cast("long").alias("n")))


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction",
                          labels: Sequence | None = None, names: Sequence[str] | None = None,
                          digits: int = 6) -> DataFrame:
    """Per-class precision/recall/F1/support, then 'accuracy', 'macro avg',
    'weighted avg' rows (zero division -> 0, as sklearn's default warns and
    returns 0). A NULL prediction, or one that is no label, is a wrong one: it
    counts in its class's support and in the accuracy. So does a row whose own
    label is none of ``labels``, in the accuracy alone."""
    labels = list(labels) if labels is not None else label_set(df, label, pred)
    # k x k rows, written once: every statistic below reads the small table
    # instead of re-deriving it from the scored input
    cm = cut_lineage(confusion_matrix(df, label, pred, labels), "confusion")
    per_true = cm.groupBy(F.col("true_label").alias("lab")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("true_label") == F.col("pred_label"), F.col("n")).otherwise(0)).alias("tp"))
    per_pred = cm.groupBy(F.col("pred_label").alias("lab")).agg(F.sum("n").alias("predicted"))
    z = lambda num, den: F.when(den > 0, num / den).otherwise(F.lit(0.0))
    pc = (per_true.join(per_pred, "lab")
                  .withColumn("precision", z(F.col("tp"), F.col("predicted")))
                  .withColumn("recall", z(F.col("tp"), F.col("support")))
                  .withColumn("f1_score", z(2 * F.col("precision") * F.col("recall"),
                                            F.col("precision") + F.col("recall"))))
    if names is not None:
        name_of = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("lab").cast("int") + 1)
    else:
        name_of = F.col("lab").cast("string")
    r = lambda c: F.round(c, digits)
    rows = pc.select(name_of.alias("label"), r(F.col("precision")).alias("precision"),
                     r(F.col("recall")).alias("recall"), r(F.col("f1_score")).alias("f1_score"),
                     F.col("support").cast("long").alias("support"))
    tot = pc.agg(F.sum("support").alias("s"), F.sum("tp").alias("tp"), F.count("*").alias("k"),
                 F.sum("precision").alias("p"), F.sum("recall").alias("rc"), F.sum("f1_score").alias("f"),
                 F.sum(F.col("precision") * F.col("support")).alias("wp"),
                 F.sum(F.col("recall") * F.col("support")).alias("wr"),
                 F.sum(F.col("f1_score") * F.col("support")).alias("wf"))
    # rows without a known label are in no class
    all_rows = cm.where("true_label IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("none")).first()[0]
    tot = tot.withColumn("all_rows", F.col("s") + F.lit(all_rows))
    s = F.col("s")
    summary = tot.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), r(z(F.col("tp"), F.col("all_rows"))).alias("f1_score"),
                 F.col("all_rows").cast("long").alias("support")),
        F.struct(F.lit("macro avg").alias("label"), r(F.col("p") / F.col("k")).alias("precision"),
                 r(F.col("rc") / F.col("k")).alias("recall"), r(F.col("f") / F.col("k")).alias("f1_score"),
                 s.cast("long").alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), r(z(F.col("wp"), s)).alias("precision"),
                 r(z(F.col("wr"), s)).alias("recall"), r(z(F.col("wf"), s)).alias("f1_score"),
                 s.cast("long").alias("support")))).alias("x")).select("x.*")
    return rows.unionByName(summary)


def prediction_error(df: DataFrame, label: str = "label", pred: str = "prediction",
                     labels: Sequence | None = None, digits: int = 6) -> DataFrame:
    """For each predicted class, how many rows of each true class it got
    (the stacked-bar table), with the share inside the predicted class."""
    cm = confusion_matrix(df, label, pred, labels)
    w = Window.partitionBy("pred_label")
    return cm.select("pred_label", "true_label", "n",
                     F.round(F.try_divide(F.col("n"), F.sum("n").over(w)), digits).alias("share"))


def _score_counts(df: DataFrame, label: str, scores: Mapping) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("cls"), F.col(s).cast("double").alias("score"))
             for c, s in scores.items()]
    return (df.select(F.col(label).alias("_y"), F.explode(F.array(*pairs)).alias("p"))
              .select("_y", "p.*").where(F.col("score").isNotNull())
              .groupBy("cls", "score")
              .agg(F.sum(F.when(F.col("_y") == F.col("cls"), 1).otherwise(0)).cast("long").alias("pos"),
                   F.sum(F.when(F.col("_y") == F.col("cls"), 0).otherwise(1)).cast("long").alias("neg")))


def _roc_base(df, label, scores, n_buckets):
    # distinct scores, written once: totals and running sums read this table
    d = cut_lineage(_score_counts(df, label, scores), "scores")
    # class totals: one map-side combined aggregate, len(scores) rows -> broadcast
    tot = d.groupBy("cls").agg(F.sum("pos").alias("P"), F.sum("neg").alias("Nn"))
    d = running_sums(d, ["cls"], "score", ["pos", "neg"], n_buckets=n_buckets)
    return d.join(F.broadcast(tot), "cls")


def roc_points(df: DataFrame, label: str, scores: Mapping, n_buckets: int | None = None,
               digits: int = 6) -> DataFrame:
    """One point per (class, distinct score): predicting positive for
    score >= threshold gives (fp, tp). Tied scores collapse into one point.
    Every distinct threshold is kept (no dropping of collinear points)."""
    b = _roc_base(df, label, scores, n_buckets)
    tp = F.col("P") - F.col("below_pos")
    fp = F.col("Nn") - F.col("below_neg")
    return b.select(F.col("cls").alias("class"), F.col("score").alias("threshold"),
                    tp.alias("tp"), fp.alias("fp"),
                    F.round(F.try_divide(tp, F.col("P")), digits).alias("tpr"),
                    F.round(F.try_divide(fp, F.col("Nn")), digits).alias("fpr"))


def roc_auc(df: DataFrame, label: str, scores: Mapping, n_buckets: int | None = None,
            digits: int = 6) -> DataFrame:
    """Trapezoid area under each one-vs-rest curve. Per distinct score the
    trapezoid is neg * (2 * positives above + pos) / (2 P N), so the area is
    one more aggregate over the running sums (ties count one half)."""
    b = _roc_base(df, label, scores, n_buckets)
    above = F.col("P") - F.col("below_pos") - F.col("pos")
    return (b.groupBy("cls").agg(
                F.sum(F.col("neg").cast("decimal(38,0)") * (2 * above + F.col("pos"))).alias("num"),
                F.first("P").alias("P"), F.first("Nn").alias("Nn"))
             .select(F.col("cls").alias("class"),
                     F.round(F.try_divide(F.col("num").cast("double"),
                                          2.0 * F.col("P") * F.col("Nn")), digits).alias("auc")))


def select_best(metrics: DataFrame, model_col: str = "model", metric_col: str = "accuracy",
                default_model: str = "random_forest") -> DataFrame:
    """Highest metric wins; on a tie the default model is kept (a challenger
    must be strictly better)."""
    key = F.struct(F.col(metric_col), (F.col(model_col) == default_model).cast("int"))
    return metrics.agg(F.max_by(F.col(model_col), key).alias("best_model"),
                       F.max(F.col(metric_col)).alias(f"best_{metric_col}"))

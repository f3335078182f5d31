"""Registered queries over the given tables (callable(spark, sf_dir) -> DataFrame).

Each one exercises a library operator on the stand-in catalog derived from
``lineitem`` (or on ``embeddings`` for the neighbour operators), over the
whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.columns import DEFAULT_BANDS
from orrery.operators import clean as C
from orrery.operators import evaluate as E
from orrery.operators import features as FE
from orrery.operators import profile as P
from orrery.operators import sampling as S
from orrery.operators.incremental import color_columns, process_incremental
from orrery.operators.scale import standardize
from orrery.plans import prepare
from orrery.session import cut_lineage, stage_path
from orrery.sources import tables as T
from orrery.sources.observations import CLASS_LABELS, KEY, TARGET, observations, read_table

COLOR = ["u_g", "g_r", "r_i", "i_z"]
CONTRACT = ["u", "g", "r", "i", "z", "u_g", "g_r", "r_i", "i_z", "redshift", "plate",
            "specobjid", "mjd"]
FIXED_CLOCK = "2024-01-01 00:00:00"


# -- preparation ---------------------------------------------------------
def q_stratified_split(spark, sf):
    return prepare.split_observations(spark, sf).select(KEY, TARGET, "data_split")


def q_random_split(spark, sf):
    return S.random_split(observations(spark, sf).select(KEY), [KEY], 0.33, 42)


def q_cv_folds(spark, sf):
    return (S.hash_folds(prepare.cleaned_observations(spark, sf), 3, [KEY], 42)
            .groupBy("fold").agg(F.count("*").alias("n_rows")))


def q_missing_counts(spark, sf):
    return C.missing_counts(observations(spark, sf))


def q_clean_impute(spark, sf):
    return prepare.cleaned_observations(spark, sf)


def q_color_indices(spark, sf):
    return prepare.featured_observations(spark, sf).select(KEY, *COLOR)


def q_encode_map(spark, sf):
    return prepare.encoded_observations(spark, sf).select(KEY, TARGET)


def q_encode_auto(spark, sf):
    return FE.encode_auto(observations(spark, sf).select(KEY, TARGET), TARGET)


def q_encode_default(spark, sf):
    return FE.encode_default(observations(spark, sf).select(KEY, TARGET), TARGET)


def q_feature_select(spark, sf):
    return FE.feature_select(prepare.featured_observations(spark, sf))


def q_conform(spark, sf):
    return FE.conform(prepare.featured_observations(spark, sf), CONTRACT, on_missing="zero",
                      keep=[KEY])


def q_prepare_ingest(spark, sf):
    return FE.prepare_ingest(observations(spark, sf))


def q_validate_rows(spark, sf):
    from orrery.operators.validate import validate_rows
    raw = observations(spark, sf).select(
        KEY, *[F.col(c).cast("string").alias(c) for c in DEFAULT_BANDS], TARGET)
    contract = {**{b: "double" for b in DEFAULT_BANDS}, TARGET: "string"}
    return validate_rows(raw, contract, required=list(contract), allowed={TARGET: CLASS_LABELS},
                         keep=[KEY])


def q_standardize(spark, sf):
    df = prepare.split_observations(spark, sf).select(KEY, "data_split", *DEFAULT_BANDS, *COLOR)
    return standardize(df, DEFAULT_BANDS + COLOR, fit_on=F.col("data_split") == "TRAIN", digits=6)


# -- profiling -------------------------------------------------------------
def q_describe(spark, sf):
    return P.describe(prepare.cleaned_observations(spark, sf))


def q_class_distribution(spark, sf):
    return P.class_distribution(prepare.cleaned_observations(spark, sf), TARGET)


def q_correlation_matrix(spark, sf):
    return P.correlation_matrix(prepare.encoded_observations(spark, sf))


def q_target_correlation(spark, sf):
    return P.target_correlation(prepare.encoded_observations(spark, sf), TARGET)


def q_table_stats(spark, sf):
    return P.table_stats(prepare.split_observations(spark, sf))


def q_table_info(spark, sf):
    return P.table_info(read_table(spark, sf, "lineitem"))


# -- evaluation on a deterministic rule classifier -----------------------
def rule_a():
    return F.when((F.col("u") > 24) & (F.col("r") > 4), 0).when(F.col("g") > 45, 1).otherwise(2)


def rule_b():
    return F.when((F.col("u") > 25) & (F.col("r") > 5), 0).when(F.col("g") > 50, 1).otherwise(2)


SCORES = {0: "s0", 1: "s1", 2: "s2"}


def scored_test(spark, sf) -> DataFrame:
    """The TEST split scored by a fixed rule: a prediction and one score per
    class, so evaluation results are exactly reproducible by the oracle."""
    return (prepare.split_observations(spark, sf).where(F.col("data_split") == "TEST")
            .select(KEY, F.col(TARGET).alias("label"), rule_a().alias("prediction"),
                    rule_b().alias("prediction_b"),
                    ((F.col("u") + F.col("r")) / 60.0).alias("s0"),
                    (F.col("g") / 105.0).alias("s1"),
                    ((60 - F.col("u")) / 60.0).alias("s2")))


def q_accuracy(spark, sf):
    return E.accuracy(scored_test(spark, sf))


CODES = [0, 1, 2]


def q_confusion_matrix(spark, sf):
    return E.confusion_matrix(scored_test(spark, sf), labels=CODES)


def q_classification_report(spark, sf):
    return E.classification_report(scored_test(spark, sf), labels=CODES, names=CLASS_LABELS)


def q_prediction_error(spark, sf):
    return E.prediction_error(scored_test(spark, sf), labels=CODES)


def q_roc_points(spark, sf):
    return E.roc_points(scored_test(spark, sf), "label", SCORES)


def q_roc_auc(spark, sf):
    return E.roc_auc(scored_test(spark, sf), "label", SCORES)


def _rule_metrics(spark, sf) -> DataFrame:
    s = scored_test(spark, sf)
    acc = lambda p: F.avg(F.when(F.col("label") == F.col(p), 1.0).otherwise(0.0))
    return s.agg(acc("prediction").alias("random_forest"), acc("prediction_b").alias("svm")) \
            .select(F.explode(F.array(
                F.struct(F.lit("random_forest").alias("model"), F.col("random_forest").alias("accuracy")),
                F.struct(F.lit("svm").alias("model"), F.col("svm").alias("accuracy")))).alias("m")) \
            .select("m.*")


def q_select_best(spark, sf):
    return E.select_best(_rule_metrics(spark, sf)).select(
        "best_model", F.round("best_accuracy", 6).alias("best_accuracy"))


def q_metrics_history(spark, sf):
    from orrery.operators.metrics import best_runs, metrics_long
    s = scored_test(spark, sf)
    runs = metrics_long(s, {"rule_a": "prediction", "rule_b": "prediction_b"}, "label", CODES)
    return best_runs(runs)


# -- tables ----------------------------------------------------------------
def q_training_view(spark, sf):
    from orrery.operators.views import training_view
    return training_view(prepare.split_observations(spark, sf))


def q_feature_view(spark, sf):
    from orrery.operators.views import feature_view
    return feature_view(observations(spark, sf))


def q_sample_processed(spark, sf):
    return T.sample_processed(prepare.split_observations(spark, sf), limit=250,
                              cols=[KEY, "u", "g", "r", "i", "z", *COLOR, TARGET, "is_processed"])


def q_bulk_load(spark, sf):
    root = stage_path(spark, "tables")
    src = FE.prepare_ingest(observations(spark, sf)).select(KEY, TARGET, "is_processed")
    T.Tables(spark, root).load(src, "catalog_data", "replace")
    T.Tables(spark, root).load(src, "catalog_data", "append")  # as another job would
    try:
        T.Tables(spark, root).load(src, "catalog_data", "fail")
    except ValueError:
        return spark.table("catalog_data")
    raise RuntimeError("an existing table was written in mode fail")


def _ingested(spark, sf):
    import datetime as dt
    t = T.Tables(spark, stage_path(spark, "tables"))
    clock = dt.datetime.fromisoformat(FIXED_CLOCK)
    for _ in range(2):  # rerun: same table, not twice the rows
        t.ingest(observations(spark, sf), "catalog_data", FE.prepare_ingest, "INGEST_20240101_000000", clock)

    def broken(df):
        raise ValueError("no such column")

    try:
        t.ingest(observations(spark, sf), "catalog_data", broken, "INGEST_20240101_000000", clock)
    except ValueError:
        return t
    raise RuntimeError("a failed ingest did not raise")


def q_ingest_refresh(spark, sf):
    return _ingested(spark, sf).read("catalog_data")


def q_table_read(spark, sf):
    t = T.Tables(spark, stage_path(spark, "tables"))
    t.replace(observations(spark, sf), "catalog_data")
    return t.read("catalog_data").where(F.col("is_processed")).orderBy(KEY)


def q_table_read_all(spark, sf):
    t = T.Tables(spark, stage_path(spark, "tables"))
    t.replace(observations(spark, sf), "catalog_data")
    return t.read("catalog_data").orderBy(KEY)


def q_param_query(spark, sf):
    return T.param_query(
        spark, "SELECT class, count(*) AS n_rows, round(avg(g), 6) AS mean_g "
               "FROM {t} WHERE u > :min_u GROUP BY class",
        {"min_u": 25}, t=observations(spark, sf))


def q_split_sink(spark, sf):
    t = T.Tables(spark, stage_path(spark, "tables"))
    t.replace(prepare.split_observations(spark, sf), "catalog_split", partition_by=["data_split"])
    return t.read("catalog_split").groupBy("data_split", TARGET).agg(F.count("*").alias("n_rows"))


def q_run_log(spark, sf):
    """The log that two ingests and a failed one have left."""
    return _ingested(spark, sf).read("pipeline_runs")


def q_process_incremental(spark, sf):
    table, _ = process_incremental(observations(spark, sf), now=FIXED_CLOCK)
    return table.select(KEY, "is_processed", *color_columns(), "updated_at")


QUERIES = {
    "split_counts": prepare.split_counts,
    "stratified_split": q_stratified_split,
    "random_split": q_random_split,
    "cv_folds": q_cv_folds,
    "missing_counts": q_missing_counts,
    "clean_impute": q_clean_impute,
    "color_indices": q_color_indices,
    "encode_map": q_encode_map,
    "encode_auto": q_encode_auto,
    "encode_default": q_encode_default,
    "feature_select": q_feature_select,
    "conform": q_conform,
    "prepare_ingest": q_prepare_ingest,
    "validate_rows": q_validate_rows,
    "standardize": q_standardize,
    "describe": q_describe,
    "class_distribution": q_class_distribution,
    "correlation_matrix": q_correlation_matrix,
    "target_correlation": q_target_correlation,
    "table_stats": q_table_stats,
    "table_info": q_table_info,
    "accuracy": q_accuracy,
    "confusion_matrix": q_confusion_matrix,
    "classification_report": q_classification_report,
    "prediction_error": q_prediction_error,
    "roc_points": q_roc_points,
    "roc_auc": q_roc_auc,
    "select_best": q_select_best,
    "metrics_history": q_metrics_history,
    "training_view": q_training_view,
    "feature_view": q_feature_view,
    "sample_processed": q_sample_processed,
    "bulk_load": q_bulk_load,
    "ingest_refresh": q_ingest_refresh,
    "table_read": q_table_read,
    "table_read_all": q_table_read_all,
    "param_query": q_param_query,
    "split_sink": q_split_sink,
    "run_log": q_run_log,
    "process_incremental": q_process_incremental,
}


# -- neighbours -------------------------------------------------------------
def _embeddings(spark, sf):
    return read_table(spark, sf, "embeddings")


def q_knn_join(spark, sf):
    from orrery.operators.neighbors import knn_join
    return knn_join(_embeddings(spark, sf), 5, "vec_id", "embedding").select(
        "vec_id", "neighbor_id", "rank", F.round("distance", 6).alias("distance"))


def q_lof_scores(spark, sf):
    from orrery.operators.neighbors import lof_scores
    return lof_scores(_embeddings(spark, sf), 20, "vec_id", "embedding").select(
        "vec_id", F.round("lof_score", 6).alias("lof_score"))


def q_lof_filter(spark, sf):
    from orrery.operators.neighbors import lof_filter
    return lof_filter(_embeddings(spark, sf), 20, "vec_id", "embedding",
                      contamination=0.1).select("vec_id", "label")


def q_smote(spark, sf):
    from orrery.operators.smote import smote
    out = smote(_embeddings(spark, sf), "label", "vec_id", "embedding", k=5, seed=42)
    return out.select("vec_id", "label", F.transform("embedding", lambda x: F.round(x, 6)).alias("embedding"),
                      "is_synthetic", "source_id", "copy_no", "neighbor_id")


def q_smote_counts(spark, sf):
    from orrery.operators.smote import smote
    out = smote(_embeddings(spark, sf), "label", "vec_id", "embedding", k=5, seed=42)
    return out.groupBy("label").agg(F.count("*").alias("n_rows"),
                                    F.sum(F.col("is_synthetic").cast("int")).cast("long").alias("n_synthetic"))


QUERIES.update({
    "knn_join": q_knn_join,
    "lof_scores": q_lof_scores,
    "lof_filter": q_lof_filter,
    "smote": q_smote,
    "smote_counts": q_smote_counts,
})


# -- modelling (SQL states no whole fitted model: first splits and gradients, supports, stated coefficients) --------------
FEATURES = ["alpha", "delta", "u", "g", "r", "i", "z", "rerun_id", "redshift", "plate", "fiber_id",
            "u_g", "g_r", "r_i", "i_z"]


# The reference's forest: 100 trees without a depth limit, here on all TRAIN rows.
RF_TREES = 100


SPLIT_ROWS = 1 << 19  # rows that a task of the split table's shuffle gets, about


def split_tasks(spark, rows: int) -> int:
    """Tasks of a shuffle of ``rows`` rows: one a core, more where those would get over SPLIT_ROWS each."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // SPLIT_ROWS))


def labelled_split(spark, sf) -> DataFrame:
    """The split table, materialised once into the shared checkpoint folder
    (the reference's "save split sets" step): fitting and evaluation read it
    many times and must not recompute the split."""
    split = prepare.split_observations(spark, sf).withColumnRenamed(TARGET, "label")
    # rows of the catalog, from the file footers: no fewer than the split has
    tasks = split_tasks(spark, observations(spark, sf).count())
    return cut_lineage(split.repartition(tasks, KEY))


# the planted classes are learnable: a model that fits them is beyond these, in F1 of each class
F1_FLOORS = {"random_forest": 0.85, "svm": 0.85, "gbt": 0.85}


def _fit_report(model, test: DataFrame, name: str) -> DataFrame:
    """Support of each class in the TEST split, and whether the fitted model's
    F1 on it is beyond the stated floor."""
    pred = model.transform(test)
    rep = E.classification_report(pred, "label", "prediction", labels=CODES, names=CLASS_LABELS)
    return rep.where(F.col("label").isin(*CLASS_LABELS)).select(
        F.lit(name).alias("model"), "label", "support", (F.col("f1_score") >= F1_FLOORS[name]).alias("learned"))


def q_train_rf(spark, sf):
    from orrery.operators.forest import train_random_forest
    df = labelled_split(spark, sf)
    m = train_random_forest(df.where("data_split = 'TRAIN'"), FEATURES, num_trees=RF_TREES)
    return _fit_report(m, df.where("data_split = 'TEST'"), "random_forest")


def q_train_kernel_svm(spark, sf):
    from orrery.operators.kernel import train_kernel_svm
    df = labelled_split(spark, sf)
    m = train_kernel_svm(df.where("data_split = 'TRAIN'"), FEATURES)
    return _fit_report(m, df.where("data_split = 'TEST'"), "svm")


def q_train_gbt(spark, sf):
    """The reference's configuration: 100 rounds of depth 6 at rate 0.1."""
    from orrery.operators.boosting import train_gbt
    df = labelled_split(spark, sf)
    m = train_gbt(df.where("data_split = 'TRAIN'"), FEATURES, max_iter=100, max_depth=6, step=0.1)
    return _fit_report(m, df.where("data_split = 'TEST'"), "gbt")


def q_choose_model(spark, sf):
    """Both of the reference's models on TRAIN, and its choice on TEST: the SVM
    only where it is strictly more accurate."""
    from orrery.operators.forest import train_random_forest
    from orrery.operators.kernel import train_kernel_svm
    df = labelled_split(spark, sf)
    train, test = df.where("data_split = 'TRAIN'"), df.where("data_split = 'TEST'")
    models = {"svm": train_kernel_svm(train, FEATURES),
              "random_forest": train_random_forest(train, FEATURES, num_trees=RF_TREES)}
    rows = [(name, *E.accuracy(m.transform(test)).first()) for name, m in models.items()]
    metrics = spark.createDataFrame(rows, "model string, accuracy double, n long")
    best = E.select_best(metrics).first()
    return metrics.select("model", F.col("n").alias("n_test"), (F.col("accuracy") > 0.85).alias("learned"),
                          (F.col("model") == best.best_model).alias("chosen"))


def q_grid_search(spark, sf):
    """The reference's grids for both models over three folds of TRAIN, every
    setting to its end (an SVM to its minimum, or the 100 passes that
    ``train_kernel_svm`` takes at most): accuracy of every setting, step and fold."""
    from orrery.operators.tuning import tune_forest, tune_svm
    train = labelled_split(spark, sf).where("data_split = 'TRAIN'")
    return tune_forest(train, FEATURES, halving=False).unionByName(
        tune_svm(train, FEATURES, steps=(10, 20, 40, 100), halving=False))


# Limits of bins that SQL can state: whole numbers, in the units of the feature.
FIXED_EDGES = {"u": range(1, 50), "g": range(0, 106, 5), "r": range(10), "i": range(8), "z": range(1, 7),
               "alpha": range(0, 351, 10)}


def _fixed_bins(spark, sf):
    from orrery.operators.binned import binned
    train = labelled_split(spark, sf).where("data_split = 'TRAIN'")
    return binned(train, list(FIXED_EDGES), edges=[list(e) for e in FIXED_EDGES.values()])


def q_gbt_first_tree(spark, sf):
    """Two levels of the first tree of each class on fixed bins: where they
    split, and the nodes' values."""
    from orrery.operators.boosting import fit_boosted
    from orrery.operators.trees import describe
    m = fit_boosted(_fixed_bins(spark, sf), rounds=1, depth=2)
    rows = [(CLASS_LABELS[k], path, f, e, v[0]) for k, t in enumerate(m.trees)
            for path, f, e, v, _ in describe(t, m.features, m.edges, 2)]
    return spark.createDataFrame(rows, "class string, path string, feature string, edge double, value double").withColumn(
        "value", F.round("value", 5))


def q_tree_first_splits(spark, sf):
    """Two levels of a tree of all rows and features on fixed bins: where it
    splits, the nodes' rows and their shares of the first two classes."""
    from orrery.operators.forest import fit_forest
    from orrery.operators.trees import describe
    m = fit_forest(_fixed_bins(spark, sf), trees=1, tried=len(FIXED_EDGES), max_depth=2, bootstrap=False)
    rows = [(path, f, e, int(n), v[0], v[1]) for path, f, e, v, n in describe(m.trees[0], m.features, m.edges, 2)]
    return spark.createDataFrame(
        rows, "path string, feature string, edge double, n_rows long, share_0 double, share_1 double").withColumns(
        {c: F.round(c, 4) for c in ("share_0", "share_1")})


def q_svm_first_gradient(spark, sf):
    """Gradient of the mean squared hinge loss at zero, by class and feature,
    from the pass that all fits make."""
    from orrery.operators.kernel import Kernel, advance, packed, tasks
    data = packed(labelled_split(spark, sf).where("data_split = 'TRAIN'"), list(FIXED_EDGES))
    work = tasks(data, [(Kernel("linear", 0.0), 1.0, None)])
    advance(data, work, 1)
    rows = [(CLASS_LABELS[k], f, float(g)) for k, d in enumerate(work[0].descents) for f, g in zip(FIXED_EDGES, d.g)]
    return spark.createDataFrame(rows, "class string, feature string, gradient double").withColumn(
        "gradient", F.round("gradient", 3))


def q_score_batch(spark, sf):
    """Fit, save, load, and score the whole cleaned catalog with what was loaded."""
    from orrery.operators.forest import train_random_forest
    from orrery.operators.persist import load_model, save_model
    from orrery.operators.score import score
    df = labelled_split(spark, sf)
    m = train_random_forest(df.where("data_split = 'TRAIN'"), FEATURES, num_trees=RF_TREES)
    path = save_model(spark, m, stage_path(spark, "model"), FEATURES, CLASS_LABELS)
    model, features, names, _ = load_model(spark, path)
    return score(df, model, features, names, keep=[KEY], model_version="random_forest")


# A linear model with stated coefficients: mean, deviation and a weight a class for each feature, then intercepts.
STATED = {"u": (25.5, 14.4, (1.2, -0.3, -0.6)), "g": (38.2, 23.3, (-0.2, 1.5, -1.1)), "r": (5.0, 3.2, (1.4, -0.2, -0.5)),
          "i": (4.0, 2.6, (0.1, 0.2, -0.1)), "redshift": (0.002, 0.0018, (-0.1, 0.05, 0.2)),
          "u_g": (-12.7, 20.0, (0.3, -0.4, 0.1))}
STATED_INTERCEPTS = (-0.4, 0.2, 0.3)


def stated_model():
    import numpy as np
    from pyspark.ml import PipelineModel

    from orrery.operators.kernel import Kernel, KernelModel
    weights = [w for _, _, w in STATED.values()] + [STATED_INTERCEPTS]
    return PipelineModel([KernelModel(list(STATED), [(m, s) for m, s, _ in STATED.values()], Kernel("linear", 0.0),
                                      weights, np.r_[np.eye(3), np.zeros((1, 3))])])


def _stated_columns(scored: DataFrame) -> DataFrame:
    return scored.select(KEY, "predicted_class", F.round("prediction_probability", 6).alias("prediction_probability"),
                         *[F.round(F.col("class_probabilities")[c], 6).alias(f"p_{c.lower()}") for c in CLASS_LABELS],
                         "confidence", "model_version")


def q_score_stated(spark, sf):
    """The whole cleaned catalog scored by a saved and loaded model of stated coefficients."""
    from orrery.operators.persist import load_model, save_model
    from orrery.operators.score import score
    path = save_model(spark, stated_model(), stage_path(spark, "model"), list(STATED), CLASS_LABELS)
    model, features, names, _ = load_model(spark, path)
    return _stated_columns(score(prepare.cleaned_observations(spark, sf), model, features, names, keep=[KEY], model_version="stated"))


def q_score_stream(spark, sf):
    """The same rows arriving as files, scored as a stream into a table."""
    from orrery.streaming.scoring import score_stream
    base = stage_path(spark, "score-stream")
    rows = prepare.cleaned_observations(spark, sf)
    rows.repartition(spark.sparkContext.defaultParallelism, KEY).write.parquet(f"{base}/source")
    score_stream(spark, f"{base}/source", rows.schema, stated_model(), list(STATED), CLASS_LABELS, f"{base}/sink",
                 f"{base}/checkpoint", keep=[KEY], model_version="stated")
    return _stated_columns(spark.read.parquet(f"{base}/sink"))


def q_confidence_band(spark, sf):
    from orrery.functions.columns import confidence_band
    s = scored_test(spark, sf)
    return s.select(KEY, confidence_band(F.greatest("s0", "s1", "s2")).alias("confidence"))


QUERIES.update({
    "train_rf": q_train_rf,
    "train_kernel_svm": q_train_kernel_svm,
    "train_gbt": q_train_gbt,
    "choose_model": q_choose_model,
    "grid_search": q_grid_search,
    "gbt_first_tree": q_gbt_first_tree,
    "tree_first_splits": q_tree_first_splits,
    "svm_first_gradient": q_svm_first_gradient,
    "score_stated": q_score_stated,
    "score_stream": q_score_stream,
    "score_batch": q_score_batch,
    "confidence_band": q_confidence_band,
})


# -- streaming ----------------------------------------------------------------
def q_stream_incremental(spark, sf):
    """Unprocessed catalog rows arrive as files and are handled in several
    micro-batches; then a tenth of the keys is sent again with another u. The
    sink has the last row of every key, those without a class unprocessed."""
    from orrery.streaming.incremental import read_sink, run_incremental
    base = stage_path(spark, "stream")
    src = observations(spark, sf).where(~F.col("is_processed"))
    tasks = spark.sparkContext.defaultParallelism
    src.repartition(tasks, KEY).write.parquet(f"{base}/source")
    args = dict(spark=spark, source=f"{base}/source", schema=src.schema, sink=f"{base}/sink",
                checkpoint=f"{base}/checkpoint", now=FIXED_CLOCK, key=KEY, max_files=max(1, tasks // 2))
    run_incremental(**args)
    if run_incremental(**args) != 0:
        raise RuntimeError("second availableNow run re-processed rows")
    again = src.where(F.col("plate") % 10 == 0).withColumn("u", F.col("u") + 1)
    again.repartition(tasks, KEY).write.mode("append").parquet(f"{base}/source")
    run_incremental(**args)
    return read_sink(spark, f"{base}/sink", KEY).select(KEY, "is_processed", *color_columns(), "updated_at")


QUERIES["stream_incremental"] = q_stream_incremental


def q_scan_typed(spark, sf):
    """Catalog rows round-tripped through CSV and read back with an explicit
    schema (corrupt-record quarantine on)."""
    from orrery.sources.scan import read_csv_typed, write_csv
    path = stage_path(spark, "csv")
    src = observations(spark, sf)
    write_csv(src, path)
    good, bad = read_csv_typed(spark, path, src.schema)
    if bad.limit(1).collect():
        raise RuntimeError("rows failed to parse")
    return good


QUERIES["scan_typed"] = q_scan_typed


def q_table_history(spark, sf):
    """Processed catalog rows loaded, the others appended, all replaced by
    those with a class: every version, and its rows by class as it is read now."""
    t = T.Tables(spark, stage_path(spark, "tables"))
    src = observations(spark, sf).select(KEY, TARGET, "is_processed")
    t.load(src.where("is_processed"), "catalog_data")
    t.load(src.where("NOT is_processed"), "catalog_data")
    t.replace(src.where(F.col(TARGET).isNotNull()), "catalog_data")
    from functools import reduce
    rows = reduce(DataFrame.unionByName, [
        t.read("catalog_data", v).groupBy(TARGET).agg(F.count("*").alias("n_rows")).withColumn("version", F.lit(v).cast("long"))
        for v in t.versions("catalog_data")])
    return rows.join(t.history("catalog_data").select("version", "operation", "parts", F.col("rows").alias("version_rows")), "version")


QUERIES["table_history"] = q_table_history


def q_stored_profile(spark, sf):
    """Columns, rows, missing values and ranges of the stored catalog, from
    the statistics of its files."""
    t = T.Tables(spark, stage_path(spark, "tables"))
    t.load(C.nan_to_null(observations(spark, sf)), "catalog_data")
    return P.stored_profile(spark, t.paths("catalog_data"), nan=False)


QUERIES["stored_profile"] = q_stored_profile


def q_sketch_profile(spark, sf):
    """Statistics of the catalog stored in two parts from the parts' sketches,
    the second part's added to the first's, and whether they keep their bounds."""
    from orrery.operators.sketches import Sketches, statistics, within_bounds
    from orrery.sources.observations import NUMERIC_COLUMNS
    t = T.Tables(spark, stage_path(spark, "tables"))
    src = observations(spark, sf)
    sketches = Sketches(t, NUMERIC_COLUMNS)
    read = []
    for part in ("is_processed", "NOT is_processed"):
        t.load(src.where(part), "catalog_data")
        read.append(sketches.refresh("catalog_data"))
    stats = cut_lineage(statistics(sketches.of("catalog_data")), "sketch-profile")
    return (stats.join(within_bounds(t.read("catalog_data"), stats), "column_name")
            .select("column_name", "n_rows", "n_missing", "low", "high", "quantiles_hold", "distinct_holds",
                    F.lit(read[1]).alias("parts_read")))


QUERIES["sketch_profile"] = q_sketch_profile



# -- outlier removal on the catalog itself (the reference's use of LOF) -----
CATALOG_LOF_FEATURES = ["alpha", "delta", "u", "g", "r", "i", "z", "rerun_id", "redshift",
                        "plate", "fiber_id"]


def catalog_points(spark, sf) -> DataFrame:
    """Cleaned catalog rows as vectors of every numeric column except the
    target, unscaled (the reference fits LOF on the raw numeric columns)."""
    df = prepare.cleaned_observations(spark, sf)
    return df.select(KEY, TARGET, F.array(*[F.col(c).cast("double") for c in CATALOG_LOF_FEATURES])
                     .alias("vec"))


def q_lof_catalog(spark, sf):
    """Rows kept after LOF outlier removal (k=20, contamination 0.1). No SQL
    oracle: DuckDB would need all n^2 pairs; tests check the same function
    against a NumPy brute force on a small fixture."""
    from orrery.operators.neighbors import lof_filter
    return lof_filter(catalog_points(spark, sf), 20, KEY, "vec", contamination=0.1).select(KEY, TARGET)


QUERIES["lof_catalog"] = q_lof_catalog

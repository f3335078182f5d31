"""DuckDB statements that state each registered query independently of Spark.

They are written from the operator definitions (plain window functions,
GROUP BY and joins); where the Spark plan uses a scalable formulation
(bucketed cutoffs, bracketed quantiles, pruned neighbour search) the oracle
uses the direct one, so agreement checks the scalable plan."""

from __future__ import annotations

from orrery.plans.catalog import FIXED_EDGES, STATED, STATED_INTERCEPTS
from orrery.sources.observations import OBSERVATION_TYPES, OBSERVATIONS_SQL

OBS = f"observations AS ({OBSERVATIONS_SQL})"

CLEANED = OBS + """,
cleaned AS (
  SELECT * REPLACE (coalesce(g, (SELECT median(g) FROM observations)) AS g)
  FROM observations WHERE class IS NOT NULL)"""

FEATURED = CLEANED + """,
featured AS (SELECT *, u - g AS u_g, g - r AS g_r, r - i AS r_i, i - z AS i_z FROM cleaned)"""

ENCODED = FEATURED + """,
encoded AS (
  SELECT * REPLACE (CASE class WHEN 'GALAXY' THEN 0 WHEN 'STAR' THEN 1 WHEN 'QSO' THEN 2 END AS class)
  FROM featured)"""


def alloc_cte(src: str, target: str = "class", frac: str = "0.2") -> str:
    return f"""
alloc_counts AS (SELECT {target}, count(*) AS n FROM {src} GROUP BY {target}),
alloc_base AS (
  SELECT {target}, n, sum(n) OVER () AS total,
         CAST(ceil(sum(n) OVER () * CAST({frac} AS DOUBLE)) AS BIGINT) AS n_test
  FROM alloc_counts),
alloc_fl AS (
  SELECT *, (n_test * n) // total AS fl, (n_test * n) % total AS rem FROM alloc_base),
alloc AS (
  SELECT {target}, n,
         fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, {target})
                        <= n_test - sum(fl) OVER () THEN 1 ELSE 0 END AS quota
  FROM alloc_fl)"""


SPLIT = ENCODED + "," + alloc_cte("encoded") + """,
split AS (
  SELECT e.*, CASE WHEN row_number() OVER (PARTITION BY e.class
                         ORDER BY md5(e.obj_id || ':42'), e.obj_id) <= a.quota
              THEN 'TEST' ELSE 'TRAIN' END AS data_split
  FROM encoded e JOIN alloc a USING (class))"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


SQL: dict[str, str] = {}

SQL["split_counts"] = with_(SPLIT, """
SELECT class, data_split, count(*) AS n_rows FROM split GROUP BY class, data_split""")

# ---------------------------------------------------------------------------
from orrery.sources.observations import NUMERIC_COLUMNS, OBSERVATION_TYPES  # noqa: E402

DOUBLE_COLS = [c for c, t in OBSERVATION_TYPES.items() if t == "double"]
OBS_COLS = list(OBSERVATION_TYPES)
ENCODED_NUMERIC = NUMERIC_COLUMNS + ["class", "u_g", "g_r", "r_i", "i_z"]
BANDS = ["u", "g", "r", "i", "z"]
COLOR = ["u_g", "g_r", "r_i", "i_z"]
HEX13 = "CAST(('0x' || substr({h}, 1, 13)) AS BIGINT) / 4503599627370496.0"
HEX8 = "CAST(('0x' || substr({h}, 1, 8)) AS BIGINT)"

SQL["stratified_split"] = with_(SPLIT, "SELECT obj_id, class, data_split FROM split")

SQL["random_split"] = with_(OBS, f"""
SELECT obj_id, CASE WHEN {HEX13.format(h="md5(obj_id || ':42')")} < 0.33
                    THEN 'TEST' ELSE 'TRAIN' END AS data_split
FROM observations""")

SQL["cv_folds"] = with_(CLEANED, f"""
SELECT CAST({HEX8.format(h="md5(obj_id || ':42')")} % 3 AS INTEGER) AS fold, count(*) AS n_rows
FROM cleaned GROUP BY 1""")


def _missing_sql() -> str:
    parts = []
    for j, c in enumerate(OBS_COLS):
        cond = f"{c} IS NULL" + (f" OR isnan({c})" if c in DOUBLE_COLS else "")
        parts.append(f"SELECT '{c}' AS column_name, {j} AS ordinal, "
                     f"count(*) FILTER (WHERE {cond}) AS n_missing FROM observations")
    total = " + ".join(
        f"count(*) FILTER (WHERE {c} IS NULL" + (f" OR isnan({c}))" if c in DOUBLE_COLS else ")")
        for c in OBS_COLS)
    parts.append(f"SELECT '__total__', {len(OBS_COLS)}, CAST({total} AS BIGINT) FROM observations")
    return with_(OBS, "\nUNION ALL ".join(parts))


SQL["missing_counts"] = _missing_sql()
SQL["clean_impute"] = with_(CLEANED, "SELECT * FROM cleaned")
SQL["color_indices"] = with_(FEATURED, "SELECT obj_id, u_g, g_r, r_i, i_z FROM featured")
SQL["encode_map"] = with_(ENCODED, "SELECT obj_id, class FROM encoded")
SQL["encode_auto"] = with_(OBS, """
SELECT obj_id, CASE WHEN class IS NULL THEN NULL
                    ELSE CAST(dense_rank() OVER (ORDER BY class) - 1 AS INTEGER) END AS class
FROM observations""")
SQL["encode_default"] = with_(OBS, """
SELECT obj_id, CASE WHEN class = 'GALAXY' THEN 0 WHEN class = 'STAR' THEN 1 ELSE 2 END AS class
FROM observations""")
SQL["feature_select"] = with_(FEATURED,
                              "SELECT * EXCLUDE (obj_id, alpha, delta, rerun_id, fiber_id) FROM featured")
SQL["conform"] = with_(FEATURED, """
SELECT obj_id, u, g, r, i, z, u_g, g_r, r_i, i_z, redshift, CAST(plate AS DOUBLE) AS plate,
       CAST(0.0 AS DOUBLE) AS specobjid, CAST(0.0 AS DOUBLE) AS mjd
FROM featured""")
SQL["prepare_ingest"] = with_(OBS, """
SELECT * EXCLUDE (delta, is_processed), delta AS delta_coord, false AS is_processed,
       CAST(NULL AS VARCHAR) AS data_split
FROM observations""")


def _validate_sql() -> str:
    reasons = []
    for b in BANDS:
        reasons += [f"CASE WHEN {b} IS NULL THEN '{b}: missing' END",
                    f"CASE WHEN {b} IS NOT NULL AND TRY_CAST({b} AS DOUBLE) IS NULL "
                    f"THEN '{b}: not double' END"]
    reasons += ["CASE WHEN class IS NULL THEN 'class: missing' END",
                "CASE WHEN class IS NOT NULL AND class NOT IN ('GALAXY', 'STAR', 'QSO') "
                "THEN 'class: not allowed' END"]
    arr = "list_filter([" + ", ".join(reasons) + "], lambda x: x IS NOT NULL)"
    typed = ", ".join(f"TRY_CAST({b} AS DOUBLE) AS {b}" for b in BANDS)
    return with_(OBS + f""",
raw AS (SELECT obj_id, {", ".join(f"CAST({b} AS VARCHAR) AS {b}" for b in BANDS)}, class
        FROM observations),
chk AS (SELECT obj_id, {typed}, class, {arr} AS e FROM raw)""", """
SELECT obj_id, u, g, r, i, z, class, CAST(len(e) AS INTEGER) AS n_errors, len(e) = 0 AS is_valid,
       array_to_string(e, '; ') AS errors
FROM chk""")


SQL["validate_rows"] = _validate_sql()

_SC = BANDS + COLOR
SQL["standardize"] = with_(SPLIT + ",\nst AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SC) + " FROM split WHERE data_split = 'TRAIN')",
    "SELECT obj_id, data_split, " + ", ".join(
        f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1 ELSE s_{c} END, 6) AS {c}"
        for c in _SC) + " FROM split, st")


def _describe_sql() -> str:
    parts = []
    for c in NUMERIC_COLUMNS:
        v = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, count({v}) AS count, round(avg({v}), 6) AS mean, "
            f"round(stddev_samp({v}), 6) AS std, round(min({v}), 6) AS min, "
            f"round(quantile_cont({v}, 0.25), 6) AS q25, round(quantile_cont({v}, 0.5), 6) AS q50, "
            f"round(quantile_cont({v}, 0.75), 6) AS q75, round(max({v}), 6) AS max FROM cleaned")
    return with_(CLEANED, "\nUNION ALL ".join(parts))


SQL["describe"] = _describe_sql()
SQL["class_distribution"] = with_(CLEANED, """
SELECT class, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM cleaned GROUP BY class""")


def _corr_expr(a: str, b: str) -> str:
    return (f"round(covar_samp({a}, {b}) / NULLIF("
            f"stddev_samp(CASE WHEN {b} IS NOT NULL THEN {a} END) * "
            f"stddev_samp(CASE WHEN {a} IS NOT NULL THEN {b} END), 0), 6)")


def _corr_sql(cols, only_with: str | None = None) -> str:
    aggs, sel = [], []
    for ai, a in enumerate(cols):
        for bi in range(ai, len(cols)):
            b = cols[bi]
            name = f"c{ai}_{bi}"
            aggs.append(f"{_corr_expr(a, b)} AS {name}")
            pairs = [(a, b)] + ([(b, a)] if a != b else [])
            for x, y in pairs:
                if only_with is None:
                    sel.append(f"SELECT '{x}' AS col_a, '{y}' AS col_b, {name} AS corr FROM m")
                elif y == only_with and x != only_with:
                    sel.append(f"SELECT '{x}' AS column_name, {name} AS corr FROM m")
    return with_(ENCODED + ",\nm AS MATERIALIZED (SELECT " + ",\n  ".join(aggs) + " FROM encoded)",
                 "\nUNION ALL ".join(sel))


SQL["correlation_matrix"] = _corr_sql(ENCODED_NUMERIC)
SQL["target_correlation"] = _corr_sql(ENCODED_NUMERIC, only_with="class")
SQL["table_stats"] = with_(SPLIT, """
SELECT count(*) AS total_records,
       CAST(sum(CASE WHEN is_processed THEN 1 ELSE 0 END) AS BIGINT) AS processed_records,
       count(DISTINCT class) AS unique_classes, count(DISTINCT data_split) AS data_splits
FROM split""")
SQL["table_info"] = """
SELECT column_name, CAST(ordinal_position AS INTEGER) AS ordinal,
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
                      WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
                      WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'BOOLEAN' THEN 'boolean'
                      ELSE lower(data_type) END AS data_type,
       (SELECT count(*) FROM lineitem) AS n_rows
FROM information_schema.columns WHERE table_name = 'lineitem'"""

SCORED = SPLIT + """,
scored AS (
  SELECT obj_id, class AS label,
         CASE WHEN u > 24 AND r > 4 THEN 0 WHEN g > 45 THEN 1 ELSE 2 END AS prediction,
         CASE WHEN u > 25 AND r > 5 THEN 0 WHEN g > 50 THEN 1 ELSE 2 END AS prediction_b,
         (u + r) / 60.0 AS s0, g / 105.0 AS s1, (60 - u) / 60.0 AS s2
  FROM split WHERE data_split = 'TEST'),
labs AS (SELECT label AS v FROM scored UNION SELECT prediction FROM scored),
cm AS (
  SELECT t.v AS true_label, p.v AS pred_label,
         (SELECT count(*) FROM scored s WHERE s.label = t.v AND s.prediction = p.v) AS n
  FROM labs t, labs p)"""

SQL["accuracy"] = with_(SCORED, """
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       count(*) AS n FROM scored""")
SQL["confusion_matrix"] = with_(SCORED, "SELECT true_label, pred_label, n FROM cm")

REPORT = SCORED + """,
pc AS (
  SELECT t.lab, t.support, t.tp, p.predicted,
         CASE WHEN p.predicted > 0 THEN t.tp / p.predicted ELSE 0.0 END AS precision,
         CASE WHEN t.support > 0 THEN t.tp / t.support ELSE 0.0 END AS recall
  FROM (SELECT true_label AS lab, sum(n) AS support,
               sum(CASE WHEN true_label = pred_label THEN n ELSE 0 END) AS tp
        FROM cm GROUP BY 1) t
  JOIN (SELECT pred_label AS lab, sum(n) AS predicted FROM cm GROUP BY 1) p USING (lab)),
pcf AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                 ELSE 0.0 END AS f1 FROM pc)"""

SQL["classification_report"] = with_(REPORT, """
SELECT ['GALAXY', 'STAR', 'QSO'][lab + 1] AS label, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1_score, CAST(support AS BIGINT) AS support
FROM pcf
UNION ALL
SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pcf
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM pcf
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM pcf""")

SQL["prediction_error"] = with_(SCORED, """
SELECT pred_label, true_label, n,
       round(n / NULLIF(sum(n) OVER (PARTITION BY pred_label), 0), 6) AS share FROM cm""")

ROC = SCORED + """,
sl AS (
  SELECT 0 AS cls, s0 AS score, label FROM scored UNION ALL
  SELECT 1, s1, label FROM scored UNION ALL
  SELECT 2, s2, label FROM scored),
d AS (
  SELECT cls, score, CAST(sum(CASE WHEN label = cls THEN 1 ELSE 0 END) AS BIGINT) AS pos,
         CAST(sum(CASE WHEN label = cls THEN 0 ELSE 1 END) AS BIGINT) AS neg
  FROM sl WHERE score IS NOT NULL GROUP BY cls, score),
r AS (
  SELECT *, coalesce(sum(pos) OVER w, 0) AS below_pos, coalesce(sum(neg) OVER w, 0) AS below_neg,
         sum(pos) OVER (PARTITION BY cls) AS P, sum(neg) OVER (PARTITION BY cls) AS Nn
  FROM d WINDOW w AS (PARTITION BY cls ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""

SQL["roc_points"] = with_(ROC, """
SELECT cls AS class, score AS threshold, CAST(P - below_pos AS BIGINT) AS tp,
       CAST(Nn - below_neg AS BIGINT) AS fp,
       round((P - below_pos) / NULLIF(P, 0), 6) AS tpr, round((Nn - below_neg) / NULLIF(Nn, 0), 6) AS fpr
FROM r""")
SQL["roc_auc"] = with_(ROC, """
SELECT cls AS class,
       round(CAST(sum(neg * (2 * (P - below_pos - pos) + pos)) AS DOUBLE)
             / NULLIF(2.0 * any_value(P) * any_value(Nn), 0), 6) AS auc
FROM r GROUP BY cls""")

SQL["select_best"] = with_(SCORED + """,
acc AS (SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS a_rf,
               avg(CASE WHEN label = prediction_b THEN 1.0 ELSE 0.0 END) AS a_svm FROM scored)""", """
SELECT CASE WHEN a_svm > a_rf THEN 'svm' ELSE 'random_forest' END AS best_model,
       round(greatest(a_rf, a_svm), 6) AS best_accuracy FROM acc""")


def _metrics_sql() -> str:
    runs = {"rule_a": "prediction", "rule_b": "prediction_b"}
    parts = []
    for run, p in runs.items():
        parts.append(f"""
SELECT '{run}' AS run_id, lab, count(*) FILTER (WHERE label = lab) AS support,
       count(*) FILTER (WHERE {p} = lab) AS predicted,
       count(*) FILTER (WHERE label = lab AND {p} = lab) AS tp
FROM scored, (SELECT label AS lab FROM scored UNION SELECT {p} FROM scored) GROUP BY lab""")
    return with_(SCORED + ",\nper AS (" + " UNION ALL ".join(parts) + """),
prf AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS p,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rc FROM per),
f AS (SELECT *, CASE WHEN p + rc > 0 THEN 2 * p * rc / (p + rc) ELSE 0.0 END AS f1 FROM prf),
m AS (
  SELECT run_id, 'accuracy' AS metric, round(sum(tp) / sum(support), 6) AS value FROM f GROUP BY run_id
  UNION ALL SELECT run_id, 'f1_macro', round(avg(f1), 6) FROM f GROUP BY run_id
  UNION ALL SELECT run_id, 'test_samples', CAST(sum(support) AS DOUBLE) FROM f GROUP BY run_id),
b AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value DESC, run_id DESC) AS rn FROM m)""",
                 "SELECT metric, run_id AS best_run, value AS best_value FROM b WHERE rn = 1")


SQL["metrics_history"] = _metrics_sql()
SQL["training_view"] = with_(SPLIT, """
SELECT obj_id, alpha, delta, u, g, r, i, z, u_g, g_r, r_i, i_z, redshift, plate, fiber_id, class, data_split
FROM split WHERE is_processed""")
SQL["feature_view"] = with_(OBS, """
SELECT obj_id, u, g, r, i, z, u - g AS calculated_u_g, g - r AS calculated_g_r,
       r - i AS calculated_r_i, i - z AS calculated_i_z, redshift, class, is_processed
FROM observations WHERE NOT is_processed""")
SQL["sample_processed"] = with_(SPLIT, """
SELECT obj_id, u, g, r, i, z, u_g, g_r, r_i, i_z, class, is_processed
FROM split WHERE is_processed ORDER BY obj_id LIMIT 250""")
SQL["bulk_load"] = with_(OBS, """
SELECT obj_id, class, false AS is_processed FROM observations
UNION ALL
SELECT obj_id, class, false AS is_processed FROM observations""")
SQL["ingest_refresh"] = SQL["prepare_ingest"]
SQL["table_read"] = with_(OBS, "SELECT * FROM observations WHERE is_processed ORDER BY obj_id")
SQL["table_read_all"] = with_(OBS, "SELECT * FROM observations ORDER BY obj_id")
SQL["param_query"] = with_(OBS, """
SELECT class, count(*) AS n_rows, round(avg(g), 6) AS mean_g FROM observations WHERE u > 25 GROUP BY class""")
SQL["split_sink"] = with_(SPLIT, "SELECT data_split, class, count(*) AS n_rows FROM split GROUP BY ALL")
# the columns that an ingest leaves, in their order
INGESTED = [*("delta_coord" if c == "delta" else c for c in OBSERVATION_TYPES), "data_split"]
SQL["run_log"] = with_(OBS, """
SELECT 'INGEST_20240101_000000' AS run_id, 'INGESTION' AS run_type, 'COMPLETED' AS status,
       count(*) AS records_processed, TIMESTAMP '2024-01-01 00:00:00' AS start_time,
       TIMESTAMP '2024-01-01 00:00:00' AS end_time, CAST(NULL AS VARCHAR) AS error_message,
       CAST(json_object('processed_records', count(*), 'feature_columns', @COLUMNS@) AS VARCHAR) AS metadata
FROM observations, range(2) AS runs(run) GROUP BY run
UNION ALL
SELECT 'INGEST_20240101_000000_FAIL', 'INGESTION', 'FAILED', NULL, TIMESTAMP '2024-01-01 00:00:00',
       TIMESTAMP '2024-01-01 00:00:00', 'no such column', NULL""".replace("@COLUMNS@", repr(INGESTED)))
SQL["process_incremental"] = with_(OBS + """,
med AS (SELECT """ + ", ".join(f"median({b}) AS m_{b}" for b in BANDS) + """
        FROM observations WHERE NOT is_processed),
f AS (SELECT o.obj_id, o.is_processed, o.class, """ + ", ".join(
    f"coalesce(o.{b}, m_{b}) AS {b}" for b in BANDS) + """ FROM observations o, med)""", """
SELECT obj_id, is_processed OR class IS NOT NULL AS is_processed,
""" + ",\n".join(f"CASE WHEN NOT is_processed AND class IS NOT NULL THEN {a} - {b} END AS {a}_{b}_color"
                 for a, b in zip(BANDS[:-1], BANDS[1:])) + """,
CASE WHEN NOT is_processed AND class IS NOT NULL THEN TIMESTAMP '2024-01-01 00:00:00' END AS updated_at
FROM f""")

# -- neighbours (direct pair join: the oracle may be quadratic) --------------
PTS = "pts AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


def _nn_cte(k: int, within: str = "") -> str:
    return f"""
pairs AS (
  SELECT a.vec_id, b.vec_id AS neighbor_id, list_distance(a.v, b.v) AS distance
  FROM pts a JOIN pts b ON a.vec_id <> b.vec_id {within}),
nn AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id)
                                AS INTEGER) AS rank FROM pairs) WHERE rank <= {k})"""


SQL["knn_join"] = with_(PTS + "," + _nn_cte(5), """
SELECT vec_id, neighbor_id, rank, round(distance, 6) AS distance FROM nn""")

LOF = PTS + "," + _nn_cte(20) + """,
kd AS (SELECT vec_id AS o, max(distance) AS kd FROM nn GROUP BY 1),
lrd AS (SELECT nn.vec_id AS p, 1.0 / (avg(greatest(kd.kd, nn.distance)) + 1e-10) AS lrd
        FROM nn JOIN kd ON nn.neighbor_id = kd.o GROUP BY 1),
lof AS (SELECT nn.vec_id, -avg(l2.lrd) / any_value(l1.lrd) AS lof_score
        FROM nn JOIN lrd l2 ON nn.neighbor_id = l2.p JOIN lrd l1 ON nn.vec_id = l1.p GROUP BY nn.vec_id)"""

SQL["lof_scores"] = with_(LOF, "SELECT vec_id, round(lof_score, 6) AS lof_score FROM lof")
SQL["lof_filter"] = with_(LOF + """,
thr AS (SELECT quantile_cont(lof_score, 0.1) AS t FROM lof)""", """
SELECT e.vec_id, e.label FROM embeddings e JOIN lof USING (vec_id), thr WHERE lof.lof_score >= thr.t""")

SMOTE = PTS + "," + _nn_cte(5, "AND a.label = b.label") + """,
cnt AS (SELECT label, count(*) AS n FROM pts GROUP BY label),
q AS (SELECT label, n, (max(n) OVER () - n) // n AS base, (max(n) OVER () - n) % n AS extra,
             least(5, n - 1) AS kk FROM cnt),
rk AS (SELECT p.*, row_number() OVER (PARTITION BY label
                   ORDER BY md5(CAST(vec_id AS VARCHAR) || ':42'), vec_id) AS rn FROM pts p),
cp AS (SELECT rk.vec_id, rk.label, rk.v, q.kk,
              q.base + CASE WHEN rk.rn <= q.extra THEN 1 ELSE 0 END AS copies
       FROM rk JOIN q USING (label)),
syn AS (SELECT vec_id, label, v, kk, CAST(unnest(generate_series(0, copies - 1)) AS BIGINT) AS copy_no
        FROM cp WHERE copies > 0),
ch AS (SELECT *, CAST(1 + CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % kk AS INTEGER) AS nn_rank,
              CAST(('0x' || substr(h, 9, 13)) AS BIGINT) / 4503599627370496.0 AS u
       FROM (SELECT *, md5(CAST(vec_id AS VARCHAR) || ':' || CAST(copy_no AS VARCHAR) || ':42') AS h FROM syn)),
out AS (
  SELECT vec_id, label, v AS embedding, false AS is_synthetic, vec_id AS source_id,
         CAST(NULL AS BIGINT) AS copy_no, CAST(NULL AS BIGINT) AS neighbor_id FROM pts
  UNION ALL
  SELECT CAST(NULL AS BIGINT), ch.label,
         list_transform(list_zip(ch.v, b.v), lambda x: x[1] + ch.u * (x[2] - x[1])),
         true, ch.vec_id, ch.copy_no, nn.neighbor_id
  FROM ch JOIN nn ON nn.vec_id = ch.vec_id AND nn.rank = ch.nn_rank
          JOIN pts b ON b.vec_id = nn.neighbor_id)"""

SQL["smote"] = with_(SMOTE, """
SELECT vec_id, label, list_transform(embedding, lambda x: round(x, 6)) AS embedding, is_synthetic,
       source_id, copy_no, neighbor_id FROM out""")
SQL["smote_counts"] = with_(SMOTE, """
SELECT label, count(*) AS n_rows, CAST(sum(CAST(is_synthetic AS INTEGER)) AS BIGINT) AS n_synthetic
FROM out GROUP BY label""")

SQL["confidence_band"] = with_(SCORED, """
SELECT obj_id, CASE WHEN greatest(s0, s1, s2) > 0.8 THEN 'High'
                    WHEN greatest(s0, s1, s2) > 0.6 THEN 'Medium' ELSE 'Low' END AS confidence
FROM scored""")

SQL["stream_incremental"] = with_(OBS + """,
src AS (SELECT * FROM observations WHERE NOT is_processed),
med AS (SELECT """ + ", ".join(f"median({b}) AS m_{b}" for b in BANDS) + """ FROM src),
last AS (SELECT * REPLACE (u + CASE WHEN plate % 10 = 0 THEN 1 ELSE 0 END AS u) FROM src),
f AS (SELECT s.obj_id, s.class, """ + ", ".join(
    f"coalesce(s.{b}, m_{b}) AS {b}" for b in BANDS) + """ FROM last s, med)""", """
SELECT obj_id, class IS NOT NULL AS is_processed,
""" + ",\n".join(f"CASE WHEN class IS NOT NULL THEN {a} - {b} END AS {a}_{b}_color"
                 for a, b in zip(BANDS[:-1], BANDS[1:])) + """,
CASE WHEN class IS NOT NULL THEN TIMESTAMP '2024-01-01 00:00:00' END AS updated_at
FROM f""")

SQL["scan_typed"] = with_(OBS, "SELECT * FROM observations")

SQL["table_history"] = with_(OBS + """,
v AS (SELECT 0 AS version, 'create' AS operation, 1 AS parts, class FROM observations WHERE is_processed
      UNION ALL SELECT 1, 'append', 2, class FROM observations
      UNION ALL SELECT 2, 'replace', 1, class FROM observations WHERE class IS NOT NULL)""", """
SELECT version, operation, parts, class, n_rows, CAST(sum(n_rows) OVER (PARTITION BY version) AS BIGINT) AS version_rows
FROM (SELECT version, operation, parts, class, count(*) AS n_rows FROM v GROUP BY ALL)""")

# the appended part alone is read for its sketches; estimates keep their stated bounds
SQL["sketch_profile"] = with_(OBS, " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_missing, CAST(min({c}) AS DOUBLE) AS low,
    CAST(max({c}) AS DOUBLE) AS high, true AS quantiles_hold, true AS distinct_holds, 1 AS parts_read FROM observations"""
    for c in NUMERIC_COLUMNS))

# of a written table, from its files' statistics
SQL["stored_profile"] = with_(OBS, " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {j} AS ordinal, '{t}' AS data_type, count(*) AS n_rows, count(*) - count({c}) AS n_missing, "
    + (f"CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high" if t in ("double", "int") else
       "CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high") + " FROM observations"
    for j, (c, t) in enumerate(OBSERVATION_TYPES.items(), 1)))

# support of each class in the TEST split; the floor holds for each (a weak check beside the tests)
for _key, _model in (("train_rf", "random_forest"), ("train_kernel_svm", "svm"), ("train_gbt", "gbt")):
    SQL[_key] = with_(SPLIT, f"""
SELECT '{_model}' AS model, CASE class WHEN 0 THEN 'GALAXY' WHEN 1 THEN 'STAR' ELSE 'QSO' END AS label,
       count(*) AS support, true AS learned
FROM split WHERE data_split = 'TEST' GROUP BY class""")

SQL["choose_model"] = with_(SPLIT, """
SELECT model, count(*) AS n_test, true AS learned, model = 'random_forest' AS chosen
FROM split, (VALUES ('random_forest'), ('svm')) m(model) WHERE data_split = 'TEST' GROUP BY model""")

# trees on fixed bins: the best cut of each node from sums over rows, level by level
CLASS_NAME = "CASE {} WHEN 0 THEN 'GALAXY' WHEN 1 THEN 'STAR' ELSE 'QSO' END"
_VALUE = "CASE {f} " + " ".join(f"WHEN {f} THEN {c}" for f, c in enumerate(FIXED_EDGES)) + " END"
_EDGES = """,
edges(f, cut, edge) AS (VALUES """ + ", ".join(
    f"({f}, {cut}, {edge})" for f, es in enumerate(FIXED_EDGES.values()) for cut, edge in enumerate(es)) + """),
names(f, feature) AS (VALUES """ + ", ".join(f"({f}, '{c}')" for f, c in enumerate(FIXED_EDGES)) + ")"


def tree_levels(sums: str, total: str, gain: str, allowed: str, levels: int = 2) -> str:
    """CTEs n0, n1, ..: rows (k, path, y, features) at each depth, and s0, s1,
    ..: the best cut of each node that is split there. ``sums`` are of the rows
    up to a cut, ``total`` of the node."""
    out = _EDGES
    for d in range(levels):
        out += f""",
v{d} AS (SELECT k, path, f, {_VALUE.format(f='f')} AS v, y, count(*) AS n FROM n{d}, names GROUP BY ALL),
l{d} AS (SELECT k, path, v{d}.f, cut, edge, {sums} FROM v{d} JOIN edges ON edges.f = v{d}.f AND v <= edge GROUP BY ALL),
t{d} AS (SELECT k, path, {total} FROM n{d} GROUP BY ALL),
g{d} AS (SELECT *, {gain} AS gain FROM l{d} JOIN t{d} USING (k, path)),
s{d} AS (SELECT k, path, f, cut, edge FROM g{d} WHERE {allowed}
         QUALIFY row_number() OVER (PARTITION BY k, path ORDER BY gain DESC, f, cut) = 1),
n{d + 1} AS (SELECT n{d}.* REPLACE (path || CASE WHEN {_VALUE.format(f=f's{d}.f')} <= edge THEN 'l' ELSE 'r' END AS path)
         FROM n{d} JOIN s{d} USING (k, path))"""
    return out


_COLS = ", ".join(FIXED_EDGES)
SQL["gbt_first_tree"] = with_(SPLIT + f""",
n0 AS (SELECT k, '' AS path, class AS y, {_COLS} FROM split, (VALUES (0), (1), (2)) c(k) WHERE data_split = 'TRAIN')""" + tree_levels(
    "sum(n) AS nl, coalesce(sum(n) FILTER (y = k), 0) AS yl",
    "count(*) AS n, count(*) FILTER (y = k) AS yn",
    "(nl / 3.0 - yl) ** 2 / (nl * 4 / 9.0 + 1) + ((n - nl) / 3.0 - (yn - yl)) ** 2 / ((n - nl) * 4 / 9.0 + 1)"
    " - (n / 3.0 - yn) ** 2 / (n * 4 / 9.0 + 1)",
    "nl * 4 / 9.0 >= 1 AND (n - nl) * 4 / 9.0 >= 1 AND gain > 1e-6") + """,
t2 AS (SELECT k, path, count(*) AS n, count(*) FILTER (y = k) AS yn FROM n2 GROUP BY ALL),
nodes AS (SELECT * FROM t0 UNION ALL SELECT * FROM t1 UNION ALL SELECT * FROM t2),
cuts AS (SELECT * FROM s0 UNION ALL SELECT * FROM s1)""", f"""
SELECT {CLASS_NAME.format('k')} AS class, path, feature, CAST(edge AS DOUBLE) AS edge,
       round(-0.1 * (n / 3.0 - yn) / (n * 4 / 9.0 + 1), 5) AS value
FROM nodes LEFT JOIN cuts USING (k, path) LEFT JOIN names USING (f)""")

_SIDE = " + ".join("coalesce(y{c}l, 0) ** 2".format(c=c) for c in range(3))
_REST = " + ".join("(y{c} - coalesce(y{c}l, 0)) ** 2".format(c=c) for c in range(3))
SQL["tree_first_splits"] = with_(SPLIT + f""",
n0 AS (SELECT 0 AS k, '' AS path, class AS y, {_COLS} FROM split WHERE data_split = 'TRAIN')""" + tree_levels(
    "sum(n) AS nl, " + ", ".join(f"sum(n) FILTER (y = {c}) AS y{c}l" for c in range(3)),
    "count(*) AS n, " + ", ".join(f"count(*) FILTER (y = {c}) AS y{c}" for c in range(3)),
    f"CASE WHEN nl < n THEN ({_SIDE}) / nl + ({_REST}) / (n - nl) END",
    "nl < n AND greatest(y0, y1, y2) < n") + """,
t2 AS (SELECT k, path, count(*) AS n, """ + ", ".join(f"count(*) FILTER (y = {c}) AS y{c}" for c in range(3)) + """
       FROM n2 GROUP BY ALL),
nodes AS (SELECT * FROM t0 UNION ALL SELECT * FROM t1 UNION ALL SELECT * FROM t2),
cuts AS (SELECT * FROM s0 UNION ALL SELECT * FROM s1)""", """
SELECT path, feature, CAST(edge AS DOUBLE) AS edge, n AS n_rows, round(y0 / n, 4) AS share_0, round(y1 / n, 4) AS share_1
FROM nodes LEFT JOIN cuts USING (k, path) LEFT JOIN names USING (f)""")

SQL["svm_first_gradient"] = with_(SPLIT + """,
train AS (SELECT * FROM split WHERE data_split = 'TRAIN')""", " UNION ALL ".join(f"""
SELECT {CLASS_NAME.format('k')} AS class, '{c}' AS feature,
       round(avg(-2 * CASE WHEN class = k THEN 1 ELSE -1 END * ({c} - m) / s), 3) AS gradient
FROM train, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM train), (VALUES (0), (1), (2)) x(k) GROUP BY k"""
    for c in FIXED_EDGES))

_MARGIN = [" + ".join(f"({w[k]}) * ({c} - ({m})) / {s}" for c, (m, s, w) in STATED.items()) + f" + ({STATED_INTERCEPTS[k]})"
           for k in range(3)]
for _key in ("score_stated", "score_stream"):
    SQL[_key] = with_(FEATURED + f""",
e AS (SELECT obj_id, exp({_MARGIN[0]}) AS e0, exp({_MARGIN[1]}) AS e1, exp({_MARGIN[2]}) AS e2 FROM featured),
p AS (SELECT obj_id, e0 / (e0 + e1 + e2) AS p0, e1 / (e0 + e1 + e2) AS p1, e2 / (e0 + e1 + e2) AS p2 FROM e)""", """
SELECT obj_id, CASE greatest(p0, p1, p2) WHEN p0 THEN 'GALAXY' WHEN p1 THEN 'STAR' ELSE 'QSO' END AS predicted_class,
       round(greatest(p0, p1, p2), 6) AS prediction_probability,
       round(p0, 6) AS p_galaxy, round(p1, 6) AS p_star, round(p2, 6) AS p_qso,
       CASE WHEN greatest(p0, p1, p2) > 0.8 THEN 'High' WHEN greatest(p0, p1, p2) > 0.6 THEN 'Medium' ELSE 'Low' END
           AS confidence, 'stated' AS model_version
FROM p""")

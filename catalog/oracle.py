"""DuckDB text of every registered operator that SQL can express."""

from __future__ import annotations

from clickscore.contract import CALENDAR, SESSION
from clickscore.functions.decisions import ACTIONS

# --- derived tables -------------------------------------------------------------

SESSIONS = """
ev AS (
  SELECT user_id, CAST(ts AS DATE) AS day, ts, event_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
visit_days AS (
  SELECT user_id, day, count(*) AS n, arg_min(k, (ts, event_id)) AS k1,
    count(*) FILTER (event_type = 'signup') AS Administrative,
    round(coalesce(sum(value) FILTER (event_type = 'signup'), 0), 2) AS Administrative_Duration,
    count(*) FILTER (event_type = 'error') AS Informational,
    round(coalesce(sum(value) FILTER (event_type = 'error'), 0), 2) AS Informational_Duration,
    count(*) FILTER (event_type IN ('view', 'click')) AS ProductRelated,
    round(coalesce(sum(value) FILTER (event_type IN ('view', 'click')), 0), 2) AS ProductRelated_Duration,
    count(*) FILTER (event_type = 'purchase') AS purchases,
    round(coalesce(sum(value) FILTER (event_type = 'purchase'), 0), 2) AS paid
  FROM ev GROUP BY user_id, day
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) AS nth_day FROM visit_days
),
single AS (
  SELECT user_id, day,
    Administrative, Administrative_Duration, Informational, Informational_Duration,
    ProductRelated, ProductRelated_Duration,
    CASE WHEN n = 1 THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END AS BounceRates,
    round(0.2::DOUBLE / n, 4) AS ExitRates,
    -- half up in whole hundredths of a cent, so exact ties do not depend on the division
    ((CAST(round(paid * 100) AS BIGINT) * 200 + n) // (2 * n)) / 10000.0::DOUBLE AS PageValues,
    (k1 % 6) / 5.0::DOUBLE AS SpecialDay,
    ['Feb','Mar','May','June','Jul','Aug','Sep','Oct','Nov','Dec'][(k1 % 10) + 1] AS Month,
    CASE WHEN k1 % 50 = 0 THEN 'Other' WHEN nth_day <= 4 THEN 'New_Visitor'
         ELSE 'Returning_Visitor' END AS VisitorType,
    isodow(day) IN (6, 7) AS Weekend,
    CAST(k1 % 8 + 1 AS INTEGER) AS OperatingSystems,
    CAST(k1 % 13 + 1 AS INTEGER) AS Browser,
    CAST(user_id % 9 + 1 AS INTEGER) AS Region,
    CAST(k1 % 20 + 1 AS INTEGER) AS TrafficType,
    purchases >= 2 AS Revenue,
    (user_id * 100000 + (CAST(day AS DATE) - DATE '1970-01-01')) * 2 AS row_id
  FROM numbered
),
s AS (
  SELECT * EXCLUDE (user_id, day) FROM single
  UNION ALL
  SELECT * EXCLUDE (user_id, day) REPLACE (row_id + 1 AS row_id) FROM single WHERE user_id % 40 = 7
)"""

COLS = ", ".join(SESSION.columns)

# De-duplicated sessions with the derived features.
UNIQUE = f"""{SESSIONS},
u AS (SELECT {COLS}, min(row_id) AS row_id FROM s GROUP BY {COLS}),
e AS (
  SELECT *, TotalDuration / (TotalPages + 1e-6::DOUBLE) AS AvgDurationPerPage,
    ProductRelated / (TotalPages + 1e-6::DOUBLE) AS ProductPageRatio,
    ExitRates - BounceRates AS BounceExitDelta
  FROM (
    SELECT *, CAST(Administrative + Informational + ProductRelated AS DOUBLE) AS TotalPages,
      Administrative_Duration + Informational_Duration + ProductRelated_Duration AS TotalDuration
    FROM u
  )
)"""

PAIRS = """
p AS (
  SELECT event_id AS row_id, ts AS scored_at, least(value / 500.0::DOUBLE, 1.0) AS probability,
    CAST(event_type = 'purchase' AS INTEGER) AS label, value,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events
)"""

MODELS = PAIRS + """,
m AS (
  SELECT row_id, label, 'by_value' AS model, probability FROM p
  UNION ALL SELECT row_id, label, 'by_key', k / 100.0::DOUBLE FROM p
  UNION ALL SELECT row_id, label, 'inverted', 1.0::DOUBLE - probability FROM p
)"""

BIG_PAIRS = """
p AS (
  SELECT l_quantity / 51.0::DOUBLE AS probability, CAST(l_returnflag = 'R' AS INTEGER) AS label
  FROM lineitem
)"""


def cells(source: str, threshold: float, by: str = "") -> str:
    key, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"""SELECT {key}
      count(*) FILTER (probability < {threshold} AND label = 0) AS true_negative,
      count(*) FILTER (probability >= {threshold} AND label = 0) AS false_positive,
      count(*) FILTER (probability < {threshold} AND label = 1) AS false_negative,
      count(*) FILTER (probability >= {threshold} AND label = 1) AS true_positive
    FROM {source}{group}"""


METRIC = {
    "accuracy": "coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0)",
    "balanced_accuracy": "(tp / (tp + fn) + tn / (tn + fp)) / 2",
    "precision": "coalesce(tp / nullif(tp + fp, 0), 0)",
    "recall": "coalesce(tp / nullif(tp + fn, 0), 0)",
    "f1": "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)",
    "mcc": "coalesce((tp * tn - fp * fn) / nullif(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0)",
}


def as_double(by: str = "") -> str:
    key = f"{by}, " if by else ""
    return (
        f"SELECT {key}true_negative::DOUBLE AS tn, false_positive::DOUBLE AS fp, "
        "false_negative::DOUBLE AS fn, true_positive::DOUBLE AS tp FROM c"
    )


def ranked(source: str, by: str = "") -> str:
    key = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""
g AS (
  SELECT {key}probability, count(*)::DOUBLE AS n, sum(label)::DOUBLE AS pos
  FROM {source} GROUP BY {key}probability
),
r AS (
  SELECT *, sum(n) OVER w AS cn, sum(pos) OVER w AS cp FROM g
  WINDOW w AS ({part}ORDER BY probability DESC ROWS UNBOUNDED PRECEDING)
)"""


AUC = "sum((n - pos) * (cp - pos + pos / 2)) / (sum(pos) * sum(n - pos))"
AP = "sum(pos * cp / cn) / sum(pos)"
TRAPEZOID = (
    "sum(pos * (cp / cn + CASE WHEN cn - n > 0 THEN (cp - pos) / (cn - n) ELSE 1 END) / 2) / sum(pos)"
)
BRIER = "avg((probability - label) * (probability - label))"


def suite(prefix: str, source: str, threshold: float, by: str = "") -> str:
    key = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    join = f"USING ({by})" if by else "ON true"
    ask = lambda m: f"round({METRIC[m]}, 4) AS {m}"
    return f"""WITH {prefix}, {ranked(source, by)},
c AS ({cells(source, threshold, by)}), d AS ({as_double(by)}),
q AS (SELECT {key}{AUC} AS auc, {AP} AS ap FROM r{group}),
b AS (SELECT {key}{BRIER} AS br FROM {source}{group})
SELECT {key}{ask('accuracy')}, {ask('balanced_accuracy')}, {ask('precision')}, {ask('recall')},
  {ask('f1')}, round(auc, 4) AS roc_auc, round(ap, 4) AS pr_auc, {ask('mcc')},
  round(br, 4) AS brier, {threshold}::DOUBLE AS threshold
FROM d JOIN q {join} JOIN b {join}"""


def sweep(source: str) -> str:
    return f"""
grid AS (SELECT (5 + i) / 100.0::DOUBLE AS threshold FROM range(91) t(i)),
c AS (
  SELECT threshold,
    count(*) FILTER (probability < threshold AND label = 0) AS true_negative,
    count(*) FILTER (probability >= threshold AND label = 0) AS false_positive,
    count(*) FILTER (probability < threshold AND label = 1) AS false_negative,
    count(*) FILTER (probability >= threshold AND label = 1) AS true_positive
  FROM grid, (SELECT probability, label FROM {source}) GROUP BY threshold
),
d AS (SELECT *, true_negative::DOUBLE AS tn, false_positive::DOUBLE AS fp,
        false_negative::DOUBLE AS fn, true_positive::DOUBLE AS tp FROM c),
sweep AS (
  SELECT threshold, round({METRIC['precision']}, 4) AS precision, round({METRIC['recall']}, 4) AS recall,
    round({METRIC['f1']}, 4) AS f1, true_positive + false_positive AS n_flagged,
    true_negative, false_positive, false_negative, true_positive,
    round(7 * tp - 5 * fp, 2) AS expected_value
  FROM d
)"""


CALIBRATION = """
curve AS (
  SELECT bin, round(avg(probability), 4) AS mean_predicted, round(avg(label), 4) AS observed_rate,
    count(*) AS "count"
  FROM (SELECT *, (SELECT count(*) FROM range(1, 10) t(i) WHERE probability > i * 0.1::DOUBLE) AS bin FROM p)
  GROUP BY bin
)"""

OUTCOME = """
o AS (
  SELECT *, CAST(probability >= 0.5 AS INTEGER) AS predicted,
    CASE WHEN label = 1 AND probability >= 0.5 THEN 'true_positive'
         WHEN label = 0 AND probability < 0.5 THEN 'true_negative'
         WHEN label = 0 THEN 'false_positive' ELSE 'false_negative' END AS outcome
  FROM p
)"""

_A = {k: v.replace("'", "''") for k, v in ACTIONS.items()}
BAND = """CASE WHEN probability >= 0.8 THEN 'Very high' WHEN probability >= 0.6 THEN 'High'
  WHEN probability >= 0.4 THEN 'Moderate' WHEN probability >= 0.2 THEN 'Low' ELSE 'Very low' END"""


def action(t: float) -> str:
    return f"""CASE WHEN probability >= {t}::DOUBLE + 0.25::DOUBLE THEN '{_A['sure']}'
  WHEN probability >= {t} THEN '{_A['likely']}'
  WHEN probability >= {t}::DOUBLE - 0.15::DOUBLE THEN '{_A['margin']}'
  WHEN probability >= 0.05 THEN '{_A['low']}' ELSE '{_A['none']}' END"""


def evaluation_sql() -> dict[str, str]:
    out = {}
    W = f"WITH {PAIRS}"
    out["confusion"] = f"{W} {cells('p', 0.5)}"
    out["confusion_normalised"] = f"""{W}, c AS ({cells('p', 0.5)})
      SELECT 'No purchase' AS actual, round(true_negative / (true_negative + false_positive), 4) AS predicted_no,
        round(false_positive / (true_negative + false_positive), 4) AS predicted_yes,
        true_negative + false_positive AS support FROM c
      UNION ALL
      SELECT 'Purchase', round(false_negative / (false_negative + true_positive), 4),
        round(true_positive / (false_negative + true_positive), 4), false_negative + true_positive FROM c"""
    out["point_metrics"] = f"""{W}, c AS ({cells('p', 0.5)}), d AS ({as_double()})
      SELECT {', '.join(f'round({METRIC[m]}, 4) AS {m}' for m in METRIC)} FROM d"""
    for m in ("balanced_accuracy", "mcc"):
        out[m] = f"""{W}, c AS ({cells('p', 0.5)}), d AS ({as_double()})
          SELECT round({METRIC[m]}, 4) AS {m} FROM d"""
    out["roc_auc"] = f"{W}, {ranked('p')} SELECT round({AUC}, 6) AS roc_auc FROM r"
    out["average_precision"] = f"{W}, {ranked('p')} SELECT round({AP}, 6) AS pr_auc FROM r"
    out["pr_area_trapezoid"] = f"{W}, {ranked('p')} SELECT round({TRAPEZOID}, 6) AS pr_area_trapezoid FROM r"
    out["brier"] = f"{W} SELECT round({BRIER}, 6) AS brier FROM p"
    out["metric_suite"] = suite(PAIRS, "p", 0.5)
    out["metric_suite_lineitem"] = suite(BIG_PAIRS, "p", 0.5)
    out["campaign_value"] = f"""{W}, c AS ({cells('p', 0.5)})
      SELECT true_positive, false_positive,
        round(7.0::DOUBLE * true_positive - 5.0::DOUBLE * false_positive, 2) AS expected_value FROM c"""
    out["threshold_sweep"] = f"{W}, {sweep('p')} SELECT * FROM sweep"
    out["threshold_sweep_lineitem"] = f"WITH {BIG_PAIRS}, {sweep('p')} SELECT * FROM sweep"
    for name, objective in (("f1", "f1"), ("value", "expected_value")):
        out[f"optimal_threshold_{name}"] = f"""{W}, {sweep('p')}
          SELECT threshold, {objective}::DOUBLE AS best FROM sweep ORDER BY {objective} DESC, threshold LIMIT 1"""
    out["calibration_curve"] = f"""{W}, {CALIBRATION}
      SELECT round(bin * 0.1::DOUBLE, 4) AS bin_lower, round((bin + 1) * 0.1::DOUBLE, 4) AS bin_upper,
        mean_predicted, observed_rate, "count" FROM curve"""
    out["calibration_summary"] = f"""{W}, {CALIBRATION}
      SELECT count(*) AS n_bins_used, sum("count")::BIGINT AS n_sessions,
        (SELECT round({BRIER}, 4) FROM p) AS brier_score,
        round(sum((mean_predicted - observed_rate) * "count") / sum("count"), 4) AS mean_gap,
        CASE WHEN sum((mean_predicted - observed_rate) * "count") > 0 THEN 'overconfident'
             ELSE 'underconfident' END AS direction
      FROM curve"""
    out["outcome"] = f"{W}, {OUTCOME} SELECT outcome, count(*) AS n FROM o GROUP BY outcome"
    for kind, way in (("false_positive", "DESC"), ("false_negative", "ASC")):
        out[f"top_errors_{kind}"] = f"""{W}, {OUTCOME}
          SELECT row_id, label, probability, predicted, outcome FROM o WHERE outcome = '{kind}'
          ORDER BY probability {way}, row_id LIMIT 10"""
    out["outcome_profile"] = f"""{W}, {OUTCOME}
      SELECT outcome, round(avg(value), 3) AS value, round(avg(k), 3) AS k,
        round(avg(probability), 3) AS probability FROM o GROUP BY outcome"""
    out["classification_report"] = f"""{W}, c AS ({cells('p', 0.5)}), d AS ({as_double()}),
      x AS (SELECT *, coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
        coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0) AS f0, tn + fp AS n0,
        {METRIC['precision']} AS p1, {METRIC['recall']} AS r1, {METRIC['f1']} AS f1, tp + fn AS n1 FROM d)
      SELECT 'No purchase' AS class, round(p0, 4) AS precision, round(r0, 4) AS recall, round(f0, 4) AS f1,
        n0::BIGINT AS support FROM x
      UNION ALL SELECT 'Purchase', round(p1, 4), round(r1, 4), round(f1, 4), n1::BIGINT FROM x
      UNION ALL SELECT 'accuracy', NULL, NULL, round((tp + tn) / (n0 + n1), 4), (n0 + n1)::BIGINT FROM x
      UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 4), round((r0 + r1) / 2, 4),
        round((f0 + f1) / 2, 4), (n0 + n1)::BIGINT FROM x
      UNION ALL SELECT 'weighted avg', round((p0 * n0 + p1 * n1) / (n0 + n1), 4),
        round((r0 * n0 + r1 * n1) / (n0 + n1), 4), round((f0 * n0 + f1 * n1) / (n0 + n1), 4),
        (n0 + n1)::BIGINT FROM x"""
    out["roc_points"] = f"""{W}, {ranked('p')}, t AS (SELECT sum(pos) AS np, sum(n - pos) AS nn FROM g)
      SELECT round((cn - cp) / nn, 6) AS fpr, round(cp / np, 6) AS tpr, probability AS threshold FROM r, t"""
    out["pr_points"] = f"""{W}, {ranked('p')}, t AS (SELECT sum(pos) AS np FROM g)
      SELECT round(cp / np, 6) AS recall, round(cp / cn, 6) AS precision, probability AS threshold FROM r, t"""
    out["prevalence"] = f"{W} SELECT round(avg(label), 6) AS prevalence FROM p"
    out["compare_models"] = suite(MODELS, "m", 0.5, "model")
    out["select_model"] = f"""WITH {MODELS}, {ranked('m', 'model')}
      SELECT model, round({AP}, 4) AS pr_auc FROM r GROUP BY model ORDER BY pr_auc DESC, model LIMIT 1"""
    names = ("pr_auc", "roc_auc", "f1", "recall", "precision")
    line = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, a.{m} AS baseline, b.{m} AS candidate FROM a, b" for m in names
    )
    out["metric_drift"] = f"""WITH base AS ({suite(MODELS, 'm', 0.5, 'model')}),
      a AS (SELECT * FROM base WHERE model = 'by_value'), b AS (SELECT * FROM base WHERE model = 'by_key'),
      x AS ({line})
      SELECT *, round(candidate - baseline, 4) AS delta,
        round(abs(candidate - baseline), 9) <= 0.01 AS within_tolerance FROM x"""
    return out


def decision_sql() -> dict[str, str]:
    out = {}
    W = f"WITH {PAIRS}"
    out["class_label"] = f"""{W} SELECT row_id, CASE WHEN label = 1 THEN 'Purchase' ELSE 'No purchase' END
      AS class_label FROM p"""
    out["confidence_band"] = f"{W} SELECT row_id, {BAND} AS confidence_band FROM p"
    out["recommendation"] = f"{W} SELECT row_id, {action(0.5)} AS recommendation FROM p"
    out["verdict"] = f"""{W} SELECT row_id, CASE WHEN probability >= 0.5 THEN 'Likely to purchase'
      WHEN abs(probability - 0.5) <= 0.15 THEN 'On the margin' ELSE 'Unlikely to purchase' END AS verdict FROM p"""
    out["decisions"] = f"""{W} SELECT row_id, CAST(probability >= 0.7 AS INTEGER) AS predicted_class,
      CASE WHEN probability >= 0.7 THEN 'Purchase' ELSE 'No purchase' END AS prediction,
      0.7::DOUBLE AS threshold, {BAND} AS confidence_band, {action(0.7)} AS recommendation FROM p"""
    policies = f"""{sweep('p')},
      bf AS (SELECT threshold FROM sweep ORDER BY f1 DESC, threshold LIMIT 1),
      bv AS (SELECT threshold FROM sweep ORDER BY expected_value DESC, threshold LIMIT 1),
      pol AS (SELECT 'Balanced (max F1)' AS policy, threshold FROM bf
        UNION ALL SELECT 'Profit-first (max campaign value)', bv.threshold FROM bv, bf
        WHERE bv.threshold <> bf.threshold)"""
    out["threshold_policies"] = f"{W}, {policies} SELECT * FROM pol"
    out["policy_labels"] = f"""{W}, {policies} SELECT row_id, policy, threshold,
      CASE WHEN probability >= threshold THEN 'Purchase' ELSE 'No purchase' END AS prediction FROM p, pol"""
    out["lift"] = f"""{W}, b AS (SELECT round(100.0::DOUBLE * avg(label), 2) AS baseline_pct FROM p)
      SELECT row_id, baseline_pct, round(coalesce(100.0::DOUBLE * probability / nullif(baseline_pct, 0), 0), 4) AS lift,
        round(100.0::DOUBLE * probability - baseline_pct, 4) AS lift_points FROM p, b"""
    out["batch_summary"] = f"""{W} SELECT count(*) AS n_sessions,
      count(*) FILTER (probability IS NULL) AS n_unscored,
      count(*) FILTER (probability >= 0.5) AS n_flagged,
      round(100.0::DOUBLE * count(*) FILTER (probability >= 0.5) / greatest(count(*), 1), 1) AS flag_rate_pct,
      round(avg(probability), 3) AS mean_probability FROM p"""
    out["top_sessions"] = f"""{W} SELECT row_id, probability, label FROM p
      ORDER BY probability DESC, row_id LIMIT 25"""
    out["prediction_history"] = f"""{W} SELECT row_id, scored_at, probability FROM p
      ORDER BY scored_at DESC, row_id DESC LIMIT 200"""
    return out


# --- sessions -----------------------------------------------------------------------

NUM, ALL_NUM, CAT = SESSION.numeric, SESSION.all_numeric, SESSION.categorical
SPELLED = ("Month", "VisitorType")


def each(items, template: str, glue: str = " UNION ALL ") -> str:
    return glue.join(template.replace("{c}", c) for c in items)


def as_doubles(skip: str = "") -> str:
    return ", ".join(f"{c}::DOUBLE AS {c}" for c in NUM)


def damaged() -> str:
    return f"""{SESSIONS},
    t AS (SELECT row_id, row_id // 200000 AS k, {', '.join(f"CAST({c} AS VARCHAR) AS {c}" for c in NUM)} FROM s),
    w AS (SELECT * REPLACE (
      CASE WHEN k % 7 = 1 THEN '-5' ELSE ProductRelated END AS ProductRelated,
      CASE WHEN k % 11 = 2 THEN '4.2' ELSE BounceRates END AS BounceRates,
      CASE WHEN k % 13 = 3 THEN 'n/a' ELSE PageValues END AS PageValues,
      CASE WHEN k % 5 = 4 THEN '0' ELSE Informational END AS Informational,
      CASE WHEN k % 17 = 5 THEN NULL ELSE ExitRates END AS ExitRates) FROM t),
    v AS (SELECT row_id, {', '.join(f"{c} AS {c}_text, TRY_CAST({c} AS DOUBLE) AS {c}" for c in NUM)} FROM w),
    problems AS (
      {each(NUM, "SELECT row_id, 'not_numeric' AS rule, '{c}' AS field FROM v WHERE {c}_text IS NOT NULL AND {c} IS NULL")}
      UNION ALL {each(NUM, "SELECT row_id, 'negative', '{c}' FROM v WHERE {c} < 0")}
      UNION ALL {each(SESSION.rates, "SELECT row_id, 'rate_out_of_range', '{c}' FROM v WHERE {c} < 0 OR {c} > 1")}
      UNION ALL {" UNION ALL ".join(
          f"SELECT row_id, 'time_without_pages', '{d}' FROM v WHERE {c} = 0 AND {d} > 0" for c, d in SESSION.visits)}
    )"""


def session_sql() -> dict[str, str]:
    out = {}
    W, U = f"WITH {SESSIONS}", f"WITH {UNIQUE}"
    out["sessions"] = f"{W} SELECT {COLS}, row_id FROM s"
    out["dedupe"] = f"{U} SELECT {COLS}, row_id FROM u"
    out["duplicate_stats"] = f"""{U}, a AS (SELECT count(*) AS n FROM s), b AS (SELECT count(*) AS d FROM u)
      SELECT n AS n_rows, n - d AS n_duplicates, round(100.0::DOUBLE * (n - d) / n, 3) AS duplicate_pct FROM a, b"""
    out["features_target"] = f"""{W} SELECT {', '.join(SESSION.features)}, CAST(Revenue AS INTEGER) AS Revenue FROM s"""
    out["session_features"] = f"{U} SELECT row_id, {', '.join(f'round({c}, 6) AS {c}' for c in SESSION.engineered)} FROM e"
    rules = {
        "High-intent buyer": "Revenue AND PageValues > pv",
        "Engaged researcher": "NOT Revenue AND ProductRelated > pr AND PageValues = 0",
        "Quick bouncer": "NOT Revenue AND BounceRates > 0.15",
        "Returning window shopper":
            "NOT Revenue AND VisitorType = 'Returning_Visitor' AND ProductRelated BETWEEN 5 AND 30",
    }
    seg = "q AS (SELECT quantile_cont(PageValues, 0.5) AS pv, quantile_cont(ProductRelated::DOUBLE, 0.75) AS pr FROM e), seg AS (" + (
        " UNION ALL ".join(f"SELECT e.*, '{n}' AS segment FROM e, q WHERE {r}" for n, r in rules.items())
    ) + ")"
    out["segment"] = f"{U}, {seg} SELECT row_id, segment FROM seg"
    out["table_contract"] = f"""{W}
      SELECT 'columns_present' AS "check", '' AS expected, '' AS actual, true AS passed
      UNION ALL SELECT 'row_count', NULL, CAST(count(*) AS VARCHAR), true FROM s
      UNION ALL SELECT 'target_rate_pct', NULL, CAST(round(100.0::DOUBLE * avg(Revenue::INTEGER), 3) AS VARCHAR), true FROM s
      UNION ALL SELECT 'checksum', NULL, NULL, true"""
    plain = f"{W} SELECT row_id, {as_doubles()}, {', '.join(CAT)} FROM s"
    for style in ("exact", "renamed", "anonymous", "recased", "yes_no", "decimal_codes", "padded"):
        out[f"align_{style}"] = plain
    bad = "(row_id // 200000) % 50 = 3"
    lost = ", ".join(f"CASE WHEN {bad} THEN NULL ELSE {c}::DOUBLE END AS {c}" for c in NUM)
    unknown = ", ".join(f"CASE WHEN {bad} THEN -1 ELSE {c} END AS {c}" for c in SESSION.coded_categorical)
    out["align_broken_numbers"] = f"{W} SELECT row_id, {lost}, Month, VisitorType, Weekend, {unknown} FROM s"
    n_bad = f"(SELECT count(*) AS n FROM s WHERE {bad})"
    out["coercion_counts_broken"] = f"""{W} SELECT * FROM (
      {each(NUM, "SELECT '{c}' AS \"column\", 'not_numeric' AS repair, n FROM " + n_bad)} UNION ALL
      {each(SESSION.coded_categorical, "SELECT '{c}', 'not_code', n FROM " + n_bad)}) WHERE n > 0"""
    out["coercion_counts_recased"] = f"""{W} {each(SPELLED, "SELECT '{c}' AS \"column\", 'recased' AS repair, count(*) AS n FROM s")}"""
    out["validate_sessions"] = f"WITH {damaged()} SELECT rule, field, count(*) AS n FROM problems GROUP BY ALL"
    out["quarantined_rows"] = f"WITH {damaged()} SELECT row_id, rule, field FROM problems"
    tables = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    out["refusals"] = " UNION ALL ".join(
        f"""SELECT '{t}' AS source, 'no column for 17 required field(s)' AS alignment,
        'missing 17 required column(s)' AS scoring, count(*) AS n_columns
        FROM (SELECT * FROM (SELECT unnest(map_keys(CAST(json(to_json(x)) AS MAP(VARCHAR, JSON)))) FROM (SELECT * FROM {t} LIMIT 1) x))"""
        for t in tables
    )
    out["valid_rows"] = f"WITH {damaged()} SELECT row_id FROM s WHERE row_id NOT IN (SELECT row_id FROM problems)"

    spark_type = {"long": "bigint", "double": "double", "string": "string", "boolean": "boolean", "integer": "int"}
    lines = []
    for c, t in SESSION.types:
        kind = spark_type[t.typeName()]
        zero = "NULL::DOUBLE" if kind == "string" else f"round(100.0::DOUBLE * count(*) FILTER ({c}::DOUBLE = 0) / count(*), 2)"
        lines.append(f"""SELECT '{c}' AS "column", '{kind}' AS dtype, count(*) - count({c}) AS n_null,
          round(100.0::DOUBLE * (count(*) - count({c})) / count(*), 3) AS pct_null,
          count(DISTINCT {c}) AS n_unique, {zero} AS pct_zero FROM s""")
    out["quality"] = f"{W} " + " UNION ALL ".join(lines)
    out["null_total"] = f"{W} SELECT " + " + ".join(f"count(*) - count({c})" for c in SESSION.columns) + " AS n_null FROM s"
    out["code_catalog"] = f"{W} " + each(
        SESSION.coded_categorical,
        """SELECT '{c}' AS "column", 'int' AS dtype, count(DISTINCT {c}) AS n_unique,
        array_to_string(list_sort(list(DISTINCT {c}))[1:30], ',') AS "values" FROM s""",
    )
    out["zero_inflation"] = f"{W} " + each(
        NUM,
        """SELECT '{c}' AS "column", round(100.0::DOUBLE * avg(CASE WHEN {c} = 0 THEN 1.0::DOUBLE ELSE 0 END), 2) AS pct_zero FROM s""",
    )
    out["target_balance"] = f"""{W}, t AS (SELECT count(*) FILTER (NOT Revenue) AS neg, count(*) FILTER (Revenue) AS pos FROM s)
      SELECT neg AS no_purchase, pos AS purchase, round(100.0::DOUBLE * pos / (pos + neg), 3) AS positive_rate_pct,
        round(neg::DOUBLE / greatest(pos, 1), 2) AS imbalance_ratio,
        round(100.0::DOUBLE * neg / (pos + neg), 3) AS majority_accuracy_pct FROM t"""
    out["baseline_rate"] = f"""{U} SELECT round(100.0::DOUBLE * avg(Revenue::INTEGER), 2) AS baseline_pct,
      count(*) AS n_sessions FROM e"""

    quart = f"""tall AS ({each(ALL_NUM, """SELECT '{c}' AS "column", {c}::DOUBLE AS x FROM e""")}),
      q AS (SELECT "column", quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS q2,
        quantile_cont(x, 0.75) AS q3 FROM tall GROUP BY "column"),
      f AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM q)"""
    out["outliers"] = f"""{U}, {quart}
      SELECT "column", round(any_value(q1), 4) AS q1, round(any_value(q3), 4) AS q3,
        round(any_value(lo), 4) AS lower_bound, round(any_value(hi), 4) AS upper_bound,
        count(*) FILTER (x < lo OR x > hi) AS n_outliers,
        round(100.0::DOUBLE * count(*) FILTER (x < lo OR x > hi) / count(*), 2) AS pct_outliers,
        round(max(x), 4) AS "max",
        round(CASE WHEN min(x) = max(x) THEN 0 ELSE skewness(x) END, 3) AS skew
      FROM tall JOIN f USING ("column") GROUP BY "column" """
    out["standardised_box"] = f"""{U}, {quart},
      m AS (SELECT "column", avg(x) AS mu, CASE WHEN stddev_samp(x) > 0 THEN stddev_samp(x) ELSE 1 END AS sd
        FROM tall GROUP BY "column")
      SELECT "column", round((min(x) FILTER (x >= lo) - any_value(mu)) / any_value(sd), 4) AS whisker_low,
        round((any_value(q1) - any_value(mu)) / any_value(sd), 4) AS q1,
        round((any_value(q2) - any_value(mu)) / any_value(sd), 4) AS median,
        round((any_value(q3) - any_value(mu)) / any_value(sd), 4) AS q3,
        round((max(x) FILTER (x <= hi) - any_value(mu)) / any_value(sd), 4) AS whisker_high
      FROM tall JOIN f USING ("column") JOIN m USING ("column") GROUP BY "column" """
    out["correlation_matrix"] = f"{U} " + " UNION ALL ".join(
        f"SELECT '{a}' AS feature, " + ", ".join(f"round(corr({a}, {b}), 4) AS {b}" for b in ALL_NUM) + " FROM e"
        for a in ALL_NUM
    )
    out["high_correlation_pairs"] = f"{U}, x AS (" + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, abs(corr({a}, {b})) AS abs_corr FROM e"
        for i, a in enumerate(ALL_NUM) for b in ALL_NUM[i + 1:]
    ) + ") SELECT feature_a, feature_b, round(abs_corr, 6) AS abs_corr FROM x WHERE abs_corr >= 0.8"
    out["target_correlation"] = f"{U} " + each(
        ALL_NUM, "SELECT '{c}' AS feature, round(corr({c}, Revenue::INTEGER), 4) AS correlation_with_target FROM e"
    )
    for name, c in (("month", "Month"), ("visitor", "VisitorType"), ("weekend", "Weekend")):
        months = ", ".join(f"'{m}'" for m in CALENDAR)
        rank = f", list_position([{months}], {c})::INTEGER AS calendar_rank" if c == "Month" else ""
        out[f"conversion_by_{name}"] = f"""{U} SELECT CAST({c} AS VARCHAR) AS level, count(*) AS sessions,
          round(100.0::DOUBLE * avg(Revenue::INTEGER), 2) AS conversion_pct,
          (SELECT round(100.0::DOUBLE * avg(Revenue::INTEGER), 2) FROM e) AS baseline_pct{rank}
          FROM e GROUP BY {c}"""
    out["calendar_coverage"] = f"""{U}, c(calendar_rank, month) AS (VALUES {', '.join(
        f"({i + 1}, '{m}')" for i, m in enumerate(CALENDAR))})
      SELECT calendar_rank, month, month IN (SELECT Month FROM e) AS present FROM c"""
    small = ", ".join(repr(-0.5772156649015329 + sum(1.0 / i for i in range(1, k))) for k in range(1, 10))
    psi = lambda n: f"""CASE WHEN {n} < 10 THEN [{small}][({n})::INTEGER]
      ELSE ln({n}) - 1 / (2.0::DOUBLE * {n}) - 1 / (12 * ({n})::DOUBLE ** 2) + 1 / (120 * ({n})::DOUBLE ** 4)
        - 1 / (252 * ({n})::DOUBLE ** 6) END"""
    # Nearest neighbours: equal values are parted by noise from the hash of the id.
    spots = each(
        ALL_NUM,
        """SELECT '{c}' AS feature, {c}::DOUBLE + 1e-10::DOUBLE * (SELECT greatest(coalesce(nullif(stddev_pop({c}), 0), 1),
          avg(abs({c}))) FROM e) * (('0x' || substr(md5(row_id::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE) AS x,
          Revenue::INTEGER AS y FROM e""",
    )
    sides = ", ".join(
        f"""coalesce(lag(x, {j}) OVER w, '-infinity'::DOUBLE) AS l{j}, coalesce(lead(x, {3 - j}) OVER w, 'infinity'::DOUBLE) AS r{j}"""
        for j in range(4)
    )
    far = ", ".join(f"greatest(x - l{j}, r{j} - x) AS f{j}" for j in range(4))
    pick = lambda what: "CASE " + " ".join(f"WHEN f{j} = r THEN {what.replace('#', str(j))}" for j in range(4)) + " END"
    nearest = f"""pts AS ({spots}),
      ranks AS (SELECT feature, x, max(k) AS k FROM (
        SELECT feature, x, row_number() OVER (PARTITION BY feature ORDER BY x) AS k FROM pts) GROUP BY feature, x),
      near AS (SELECT feature, x, y, {sides}, count(*) OVER (PARTITION BY feature, y) AS ny FROM pts
        WINDOW w AS (PARTITION BY feature, y ORDER BY x)),
      away AS (SELECT *, least(f0, f1, f2, f3) AS r FROM (SELECT *, {far} FROM near)),
      ends AS (SELECT feature, ny, {pick("CASE WHEN x - l# >= r# - x THEN l# ELSE x - r END")} AS low,
        {pick("CASE WHEN x - l# >= r# - x THEN x + r ELSE r# END")} AS high FROM away),
      upto AS (SELECT q.*, coalesce(p.k, 0) AS k_low FROM ends q ASOF LEFT JOIN ranks p
        ON q.feature = p.feature AND q.low >= p.x),
      closer AS (SELECT q.feature, q.ny, greatest(coalesce(p.k, 0) - q.k_low, 1) AS m FROM upto q ASOF LEFT JOIN ranks p
        ON q.feature = p.feature AND q.high > p.x),
      knn AS (SELECT feature, count(*) AS n, avg({psi("3")} - ({psi("ny")}) - ({psi("m")})) AS s FROM closer GROUP BY feature)"""
    levels = each(CAT, "SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level, Revenue::INTEGER AS y FROM e")
    out["mutual_information"] = f"""{U}, {nearest}, x AS ({levels}),
      c AS (SELECT feature, level, count(*)::DOUBLE AS nv, sum(y)::DOUBLE AS n1 FROM x GROUP BY ALL),
      t AS (SELECT count(*)::DOUBLE AS n, sum(Revenue::INTEGER)::DOUBLE AS p FROM e),
      z AS (SELECT feature, sum(CASE WHEN n1 > 0 THEN n1 / n * ln(n1 * n / (nv * p)) ELSE 0 END
        + CASE WHEN nv > n1 THEN (nv - n1) / n * ln((nv - n1) * n / (nv * (n - p))) ELSE 0 END) AS mi
        FROM c, t GROUP BY feature)
      SELECT feature, round(greatest(mi, 0), 5) AS mutual_information FROM z
      UNION ALL SELECT feature, round(greatest({psi("n")} + s, 0), 5) FROM knn"""
    out["histogram"] = f"""{U}, x AS ({each(NUM, """SELECT '{c}' AS "column", {c}::DOUBLE AS v FROM e""")}),
      r AS (SELECT "column", min(v) AS lo, max(v) AS hi FROM x GROUP BY "column"),
      b AS (SELECT "column", i::INTEGER AS bin, lo + i * ((hi - lo) / 50) AS lower,
        CASE WHEN i = 49 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 50) END AS upper FROM r, range(50) t(i)
        WHERE hi > lo
        UNION ALL SELECT "column", 0, lo, hi FROM r WHERE hi = lo),
      g AS (SELECT "column", bin, lower, upper,
        row_number() OVER (PARTITION BY "column" ORDER BY bin DESC) = 1 AS last FROM b)
      SELECT "column", bin, round(any_value(lower), 6) AS lower, round(any_value(upper), 6) AS upper,
        count(v) AS "count"
      FROM g LEFT JOIN x ON x."column" = g."column" AND v >= lower AND (v < upper OR last)
      GROUP BY g."column", bin""".replace('SELECT "column", bin, round', 'SELECT g."column", bin, round')
    step = {c: "0.001, 3" if c in SESSION.unit_scaled else ("1.0, 0" if c in SESSION.counts else "1.0, 1") for c in NUM}
    out["numeric_ranges"] = f"{U} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", min({c})::DOUBLE AS "min", max({c})::DOUBLE AS "max",
        round(quantile_cont({c}::DOUBLE, 0.5), 6) AS median, round(avg({c}::DOUBLE), 4) AS mean,
        round(quantile_cont({c}::DOUBLE, 0.99), 6) AS p99,
        {step[c].split(',')[0]}::DOUBLE AS step, {step[c].split(',')[1]} AS decimals FROM e"""
        for c in NUM
    )
    order = {c: "level" for c in CAT}
    order["Month"] = f"list_position([{', '.join(repr(m) for m in CALENDAR)}], level)"
    out["category_levels"] = f"{U} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", row_number() OVER (ORDER BY {order[c]})::INTEGER AS position,
        CAST(level AS VARCHAR) AS level FROM (SELECT DISTINCT {c} AS level FROM e)"""
        for c in CAT if c != "Weekend"
    ) + """ UNION ALL SELECT 'Weekend', 1, 'false' UNION ALL SELECT 'Weekend', 2, 'true'"""
    medians = ", ".join(f"round(quantile_cont({c}::DOUBLE, 0.5), 4) AS {c}" for c in NUM)
    modes = ", ".join(
        f"(SELECT {c} FROM seg x WHERE x.segment = seg.segment GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS {c}"
        for c in CAT
    )
    out["segment_presets"] = f"""{U}, {seg} SELECT segment, count(*) AS n_sessions,
      round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM e), 1) AS share_pct, {medians}, {modes}
      FROM seg GROUP BY segment"""

    P = f"WITH {PAIRS}"
    out["stratified_split"] = f"""{P},
      n AS (SELECT label, count(*) AS nc FROM p GROUP BY label),
      t AS (SELECT sum(nc)::BIGINT AS n, CAST(ceil(0.2::DOUBLE * sum(nc)) AS BIGINT) AS take FROM n),
      x AS (SELECT label, nc * take / n::DOUBLE AS exact, take FROM n, t),
      f AS (SELECT *, floor(exact) AS base, row_number() OVER (ORDER BY floor(exact) - exact, label) AS turn FROM x),
      quota AS (SELECT label, base + CASE WHEN turn <= take - (SELECT sum(base) FROM f) THEN 1 ELSE 0 END AS q FROM f),
      r AS (SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(row_id::VARCHAR || '-42')) AS pos FROM p)
      SELECT row_id, pos <= q AS is_test FROM r JOIN quota USING (label)"""
    out["stratified_folds"] = f"""{P} SELECT row_id,
      (ntile(5) OVER (PARTITION BY label ORDER BY md5(row_id::VARCHAR || '-42')) - 1)::INTEGER AS fold FROM p"""
    out["class_weights"] = f"""{P}, n AS (SELECT count(*) AS n, sum(label)::BIGINT AS pos FROM p)
      SELECT 0 AS label, n - pos AS n_rows, round(n / (2.0::DOUBLE * (n - pos)), 6) AS balanced_weight,
        round((n - pos)::DOUBLE / greatest(pos, 1), 4) AS positive_weight FROM n
      UNION ALL SELECT 1, pos, round(n / (2.0::DOUBLE * pos), 6), round((n - pos)::DOUBLE / greatest(pos, 1), 4) FROM n"""
    out["head_rows"] = f"{P} SELECT row_id, probability FROM p ORDER BY row_id LIMIT 500"
    return out


# --- imputation, explanations, run history ------------------------------------------


def gappy() -> str:
    k = "row_id // 200000"
    nums = ", ".join(f"CASE WHEN ({k}) % 50 = 3 THEN NULL ELSE {c}::DOUBLE END AS {c}" for c in NUM)
    hole = {"Month": f"({k}) % 13 = 2", "Browser": f"({k}) % 17 = 4", "Weekend": f"({k}) % 19 = 5"}
    cats = ", ".join(
        f"CASE WHEN {hole[c]} THEN NULL ELSE {c} END AS {c}" if c in hole else c for c in CAT
    )
    return f"{SESSIONS}, gap AS (SELECT row_id, {nums}, {cats} FROM s)"


def _shown() -> dict[str, str]:
    """What a feature means for its row: numbers with four significant digits, the rest as it is."""
    kinds = {c: t.typeName() for c, t in SESSION.types}
    out = {}
    for c in (*SESSION.features, *SESSION.engineered):
        kind = kinds.get(c, "double")
        if kind == "double":
            out[c] = f"format('{{:.4g}}', {c})"
        elif kind == "boolean":
            out[c] = f"CASE WHEN {c} THEN 'True' ELSE 'False' END"
        else:
            out[c] = f"CAST({c} AS VARCHAR)"
    for slot in (
        "Month_Nov", "Month_Feb", "VisitorType_Other", "VisitorType_New_Visitor", "Weekend_True", "Weekend_False",
        "OperatingSystems_1", "Browser_2", "Region_3", "TrafficType_4",
    ):
        c, level = slot.split("_", 1)
        out[slot] = f"""CASE WHEN {out[c]} = '{level}' THEN '{c} = ' || {out[c]}
          ELSE '{c} is ' || {out[c]} || ', not {level}' END"""
    return out


def model_sql() -> dict[str, str]:
    out = {}
    G, U = f"WITH {gappy()}", f"WITH {UNIQUE}"
    out["median_impute"] = f"{G} SELECT row_id, " + ", ".join(
        f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM gap)) AS {c}" for c in NUM
    ) + " FROM gap"
    out["mode_impute"] = f"{G} SELECT row_id, " + ", ".join(
        f"""coalesce({c}, (SELECT {c} FROM gap WHERE {c} IS NOT NULL GROUP BY {c}
        ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}"""
        for c in CAT
    ) + " FROM gap"
    out["standard_scale"] = f"{U}, m AS (SELECT " + ", ".join(
        f"avg({c}::DOUBLE) AS m_{c}, stddev_pop({c}::DOUBLE) AS s_{c}" for c in NUM
    ) + " FROM e) SELECT row_id, " + ", ".join(
        f"round(({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END, 4) AS {c}" for c in NUM
    ) + " FROM e, m"
    out["contribution_source"] = f"{U} " + " UNION ALL ".join(
        f"SELECT row_id, '{f}' AS feature, {sql} AS shown FROM e" for f, sql in _shown().items()
    )
    text = {c: (f"CASE WHEN {c} THEN 'True' ELSE 'False' END" if c == "Weekend" else f"CAST({c} AS VARCHAR)") for c in CAT}
    levels = " UNION ALL ".join(
        f"""SELECT {i} AS turn, '{c}' AS "column", level, row_number() OVER (ORDER BY level) - 1 AS position
        FROM (SELECT DISTINCT {text[c]} AS level FROM e)""" for i, c in enumerate(CAT)
    )
    numbers = ", ".join(f"({i}, '{c}')" for i, c in enumerate(ALL_NUM))
    named = f"""lv AS ({levels}),
      sl AS (SELECT slot, feature, NULL::VARCHAR AS "column", NULL::VARCHAR AS level FROM (VALUES {numbers}) t(slot, feature)
        UNION ALL SELECT {len(ALL_NUM)} + row_number() OVER (ORDER BY turn, position) - 1, "column" || '_' || level, "column", level
        FROM lv)"""
    out["fitted_levels"] = f"""{U}, {named} SELECT "column", position::INTEGER AS position, level FROM lv"""
    out["feature_names"] = f"{U}, {named} SELECT slot::INTEGER AS slot, feature FROM sl"
    scaled = " UNION ALL ".join(
        f"""SELECT row_id, {i} AS slot, ({c}::DOUBLE - (SELECT avg({c}::DOUBLE) FROM e))
        / (SELECT coalesce(nullif(stddev_pop({c}::DOUBLE), 0), 1) FROM e) AS x FROM e""" for i, c in enumerate(ALL_NUM)
    )
    marked = " UNION ALL ".join(
        f"""SELECT row_id, slot, (level = {text[c]})::INTEGER::DOUBLE FROM e JOIN sl ON "column" = '{c}'""" for c in CAT
    )
    out["feature_vector"] = f"""{U}, {named} SELECT row_id, slot::INTEGER AS slot, round(x, 6) + 0.0::DOUBLE AS value
      FROM ({scaled} UNION ALL {marked})"""
    kept = ", ".join(c for c in SESSION.features if c not in ("PageValues", "Month"))
    out["drop_features"] = f"{U} SELECT row_id, {kept} FROM e"
    out["sample_params"] = """SELECT c AS inverse_strength, l AS l1_share FROM
      (VALUES (0.01::DOUBLE), (0.1), (0.5), (1.0), (5.0), (10.0)) a(c), (VALUES (0.0::DOUBLE), (1.0)) b(l)"""
    for name in ("linear", "trees"):
        out[f"check_importance_{name}"] = f"{U}, {named} SELECT feature, true AS fine FROM sl"
    out["sensitivity_grid"] = f"{U}, r AS (" + each(
        NUM,
        """SELECT '{c}' AS "column", coalesce(nullif(quantile_cont({c}::DOUBLE, 0.99), 0),
        nullif(max({c})::DOUBLE, 0), 1.0) AS upper FROM e""",
    ) + """) SELECT "column", i::INTEGER AS point, round(i * (upper / 39.0::DOUBLE), 6) AS value
      FROM r, range(40) t(i)"""
    return out


RUNS = """
models AS (
  SELECT 'o' || o_orderkey AS run_id, 'c' || o_custkey AS parent_run_id, o_orderpriority AS run_name,
    CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status,
    o_orderdate AS start_time,
    o_totalprice / 1e6::DOUBLE AS cv_pr_auc_baseline,
    o_totalprice / 8e5::DOUBLE AS cv_pr_auc_tuned,
    o_totalprice / 5e5::DOUBLE AS test_pr_auc,
    1.0::DOUBLE - o_totalprice / 2e6::DOUBLE AS test_roc_auc,
    o_totalprice / 7e5::DOUBLE AS test_f1,
    o_totalprice / 6e5::DOUBLE AS test_recall,
    NULL::DOUBLE AS test_latency_median_ms,
    o_orderpriority AS priority
  FROM orders
),
training AS (
  SELECT 'c' || c_custkey AS run_id, c_name AS run_name, 'FINISHED' AS status,
    TIMESTAMP '2000-01-01' + to_minutes(c_custkey) AS start_time,
    CASE WHEN c_custkey % 10 NOT IN (0, 1) THEN abs(c_acctbal) / 1e4::DOUBLE END AS operating_threshold,
    CASE WHEN c_custkey % 10 <> 0 THEN c_mktsegment END AS selected_model
  FROM customer
)"""
RUN_LABELS = {
    "cv_pr_auc_baseline": "CV PR-AUC (baseline)",
    "cv_pr_auc_tuned": "CV PR-AUC (tuned)",
    "test_pr_auc": "Test PR-AUC",
    "test_roc_auc": "Test ROC-AUC",
    "test_f1": "Test F1",
    "test_recall": "Test recall",
    "test_latency_median_ms": "Latency (ms)",
}


def run_sql() -> dict[str, str]:
    W = f"WITH {RUNS}"
    labelled = ", ".join(f'{k} AS "{v}"' for k, v in RUN_LABELS.items())
    metrics = [k for k in RUN_LABELS if k != "test_latency_median_ms"]
    return {
        "classify_runs": f"""{W} SELECT run_id, run_name, status, true AS is_model_run, 7::BIGINT AS n_values FROM models
          UNION ALL SELECT run_id, run_name, status, false,
            (operating_threshold IS NOT NULL)::BIGINT + (selected_model IS NOT NULL)::BIGINT FROM training""",
        "runs_wide": f"""{W} SELECT run_id, run_name, status, start_time, true AS is_model_run,
            {', '.join(f'{k} AS "metrics.{k}"' for k in metrics)},
            NULL::DOUBLE AS "metrics.operating_threshold", priority AS "params.priority" FROM models
          UNION ALL SELECT run_id, run_name, status, start_time, false, {', '.join('NULL' for _ in metrics)},
            operating_threshold, NULL FROM training""",
        "runs_comparison": f"""{W} SELECT run_id, run_name AS "Model", {labelled},
          row_number() OVER (ORDER BY test_pr_auc DESC, run_id DESC) = 1 AS is_best FROM models""",
        "latest_session": f"""{W} SELECT run_id, run_name, start_time, selected_model,
          NULL::DOUBLE AS final_pr_auc, NULL::DOUBLE AS final_recall, operating_threshold,
          NULL::DOUBLE AS model_size_mb FROM training ORDER BY start_time DESC, run_id DESC LIMIT 1""",
        "runs_summary": f"""{W}, f AS (SELECT *, row_number() OVER (PARTITION BY run_name
            ORDER BY start_time, run_id) AS turn FROM models)
          SELECT run_name, (SELECT count(*) FROM training) AS n_session_runs,
            (SELECT count(*) FROM models) AS n_model_runs, {labelled} FROM f WHERE turn = 1""",
        "record_run": """WITH e AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)
          SELECT 's-' || event_type AS run_id, 'FINISHED' AS status, false AS is_model_run, 0::BIGINT AS n_values,
            NULL::DOUBLE AS "metrics.test_pr_auc", NULL::VARCHAR AS "params.rows" FROM e
          UNION ALL SELECT 'm-' || event_type, 'FINISHED', true, 6, 2.0::DOUBLE * n, n::VARCHAR FROM e""",
    }


def profile_sql(sessions: dict[str, str]) -> str:
    """The four tables of the input profile as rows (source, row, field, value)."""
    number = lambda c: f'round("{c}", 4)::DECIMAL(30,4)::VARCHAR'
    plain = lambda c: f'CAST("{c}" AS VARCHAR)'
    doubles = {"min", "max", "median", "mean", "p99", "step", "share_pct", "conversion_pct", "baseline_pct", *NUM}
    parts = {
        "numeric_ranges": ("""'/' || "column" """, ("min", "max", "median", "mean", "p99", "step", "decimals")),
        "category_levels": ("""'/' || "column" || '/' || position""", ("level",)),
        "segment_presets": ("'/' || segment", ("n_sessions", "share_pct", *NUM, *CAT)),
        "baseline_rate": ("''", ("baseline_pct", "n_sessions")),
    }
    tables = ", ".join(f"t_{name} AS MATERIALIZED ({sessions[name]})" for name in parts)
    rows = " UNION ALL ".join(
        f"""SELECT '{name}' AS source, {row} AS row, '{c}' AS field, {number(c) if c in doubles else plain(c)} AS value FROM t_{name}"""
        for name, (row, fields) in parts.items() for c in fields
    )
    return f"WITH {tables} {rows}"


def source_sql(sessions: dict[str, str], history: dict[str, str]) -> dict[str, str]:
    """Round trips through files give what the operator itself gives."""
    P = f"WITH {PAIRS}"
    return {
        "read_sessions": f"WITH {SESSIONS} SELECT {COLS} FROM s",
        "read_upload": sessions["align_broken_numbers"],
        "read_runs": history["classify_runs"],
        "read_wide_runs": f"SELECT DISTINCT * EXCLUDE (run_id) FROM ({history['runs_wide']})",
        "read_profile": profile_sql(sessions),
        "write_json": sessions["outliers"],
        "model_card_calibration": evaluation_sql()["calibration_curve"],
        "model_card": f"""{P}, {sweep('p')},
          b AS (SELECT * FROM sweep ORDER BY f1 DESC, threshold LIMIT 1)
          {" UNION ALL ".join(f"SELECT 'by_value' AS model_name, threshold AS operating_threshold, '{c}' AS cell, {c} AS n FROM b"
            for c in ("true_negative", "false_positive", "false_negative", "true_positive"))}""",
    }


def all_sql() -> dict[str, str]:
    sessions, history = session_sql(), run_sql()
    return {
        **evaluation_sql(),
        **decision_sql(),
        **sessions,
        **model_sql(),
        **history,
        **source_sql(sessions, history),
    }

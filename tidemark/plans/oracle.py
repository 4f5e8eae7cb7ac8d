"""SQL twins of the registered queries, over the same warehouse tables.

Written independently of the operators: every statement starts from the raw tables over
their whole history, so the scan limits and staged steps of the Spark side are checked too.
"""

from __future__ import annotations

_STEPS = """
WITH daily AS (
  SELECT n_name AS client_name, CAST(l_shipdate AS DATE) AS event_date,
         sum(l_quantity) AS actual_volume,
         CAST(max(CASE WHEN r_name = 'ASIA' THEN 1 ELSE 0 END) AS INTEGER) AS is_china,
         CAST(max(CASE WHEN r_name = 'EUROPE' THEN 1 ELSE 0 END) AS INTEGER) AS is_domestic
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2),
flagged AS (
  SELECT *,
    CAST(day(event_date) = 1 AS INTEGER) AS event_month_start,
    CAST(month(event_date) = 12 AND day(event_date) = 25 AS INTEGER) AS event_christmas_day,
    CAST(month(event_date) = 11 AND isodow(event_date) = 5
         AND day(event_date) BETWEEN 23 AND 29 AS INTEGER) AS event_black_friday
  FROM daily),
based AS (
  SELECT *, median(actual_volume) OVER (
      PARTITION BY client_name ORDER BY event_date
      RANGE BETWEEN INTERVAL 28 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING
    ) AS rolling_4w_median
  FROM flagged),
refined AS (
  SELECT * FROM based
  WHERE event_date >= DATE '2001-11-04' - 730 AND event_date <= DATE '2001-11-04'
    AND actual_volume > 0 AND rolling_4w_median > 10),
bounds AS (
  SELECT max(event_date) AS max_date,
         CAST(max(event_date) - 41 AS DATE) AS test_start,
         CAST(max(event_date) - 83 AS DATE) AS val_start
  FROM refined),
labelled AS (
  SELECT refined.*,
    CASE WHEN event_date < val_start THEN 'train'
         WHEN event_date < test_start THEN 'val' ELSE 'test' END AS split,
    abs(actual_volume - rolling_4w_median) / rolling_4w_median AS signal,
    ln(greatest(actual_volume / rolling_4w_median, 0.000001)) AS target
  FROM refined, bounds),
cuts AS (
  SELECT quantile_cont(rolling_4w_median, 0.75) AS high_volume_cut,
         quantile_cont(rolling_4w_median, 0.35) AS low_volume_cut,
         quantile_cont(signal, 0.65) AS low_predictability_cut,
         quantile_cont(signal, 0.35) AS high_predictability_cut
  FROM labelled WHERE split = 'train'),
cohorts AS (
  SELECT labelled.*,
    CASE WHEN rolling_4w_median <= low_volume_cut THEN 'The Phantoms'
         WHEN rolling_4w_median >= high_volume_cut
              AND (signal >= low_predictability_cut OR is_china > 0) THEN 'The Spikers'
         WHEN rolling_4w_median >= high_volume_cut
              AND signal <= high_predictability_cut THEN 'The Anchors'
         ELSE 'The Dials' END AS archetype
  FROM labelled, cuts WHERE split = 'test'),
cohort_days AS (
  SELECT archetype, event_date, count(*) AS row_count,
         sum(actual_volume) AS actual_total, sum(rolling_4w_median) AS predicted_total
  FROM cohorts GROUP BY 1, 2),
cohort_error AS (
  SELECT archetype, CAST(sum(row_count) AS BIGINT) AS row_count,
         100 * avg(2 * abs(predicted_total - actual_total)
                   / (abs(actual_total) + abs(predicted_total) + 0.000000001)) AS business_smape
  FROM cohort_days GROUP BY 1),
limits(ordinal, archetype, threshold, hard, reason) AS (VALUES
  (0, 'The Anchors', CAST(7.5 AS DOUBLE), true, 'CRITICAL: AnchorToleranceBreach'),
  (1, 'The Dials', CAST(13 AS DOUBLE), true, 'CRITICAL: DialToleranceBreach'),
  (2, 'The Spikers', CAST(24 AS DOUBLE), false, 'WARNING: SpikerVolatility'),
  (3, 'The Phantoms', CAST(32 AS DOUBLE), true, 'CRITICAL: PhantomToleranceBreach')),
ledger AS (
  SELECT ordinal, limits.archetype, coalesce(row_count, 0) AS row_count, business_smape,
         threshold, hard, reason, coalesce(business_smape > threshold, false) AS breached,
         CASE WHEN business_smape > threshold AND hard THEN 'ZONE_3_CRITICAL_REJECTION'
              WHEN business_smape > threshold THEN 'ZONE_2_DEVIATION_WARNING'
              ELSE 'ZONE_1_NOMINAL' END AS workflow_impact_flag
  FROM limits LEFT JOIN cohort_error ON limits.archetype = cohort_error.archetype),
verdict AS (
  SELECT NOT bool_or(breached AND hard) AS cohorts_pass,
         arg_max(reason, ordinal) FILTER (WHERE breached AND hard) AS block_reason,
         bool_or(breached AND NOT hard) AS deviation_warning,
         coalesce(string_agg(archetype, ', ' ORDER BY ordinal) FILTER (WHERE breached), '')
           AS breached_cohorts
  FROM ledger),
errors AS (
  SELECT split,
         2 * abs(0 - target) / (abs(target) + 0.000000001) AS log_error,
         2 * abs(rolling_4w_median - actual_volume)
           / (abs(actual_volume) + abs(rolling_4w_median) + 0.000000001) AS volume_error
  FROM labelled),
accuracy AS (
  SELECT 100 * avg(log_error) FILTER (WHERE split = 'val') AS val_smape_target,
         100 * avg(log_error) FILTER (WHERE split = 'test') AS test_smape_target,
         100 * avg(volume_error) FILTER (WHERE split = 'val') AS val_smape_volume,
         100 * avg(volume_error) FILTER (WHERE split = 'test') AS test_smape_volume
  FROM errors),
runs AS (
  SELECT user_id || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id,
         min(ts) AS experiment_start,
         coalesce(min(ts) FILTER (WHERE event_type = 'view'), max(ts)) AS baseline_ready,
         max(ts) AS evaluation_complete,
         bool_or(event_type = 'purchase') AS promoted,
         NOT bool_or(event_type = 'error') AS artifacts_complete,
         min(ts) FILTER (WHERE event_type = 'error') AS drift_detected_at
  FROM events GROUP BY user_id, CAST(ts AS DATE)),
timed AS (
  SELECT *,
    CAST(epoch_us(baseline_ready) - epoch_us(experiment_start) AS DOUBLE)
      / CAST(1000000 AS DOUBLE) / CAST(3600 AS DOUBLE) AS hours_to_baseline,
    CAST(epoch_us(evaluation_complete) - epoch_us(experiment_start) AS DOUBLE)
      / CAST(1000000 AS DOUBLE) / CAST(3600 AS DOUBLE) AS hours_to_evaluation,
    CAST(epoch_us(drift_detected_at) - epoch_us(experiment_start) AS DOUBLE)
      / CAST(1000000 AS DOUBLE) / CAST(3600 AS DOUBLE) AS drift_latency_hours,
    CAST(CASE WHEN artifacts_complete THEN 1 ELSE 0 END AS DOUBLE) AS artifact_completeness
  FROM runs),
gated AS (
  SELECT *, hours_to_baseline <= 2 AS baseline_speed_pass,
         hours_to_evaluation <= 12 AS evaluation_speed_pass,
         artifact_completeness = 1 AS artifact_completeness_pass,
         hours_to_baseline <= 2 AND hours_to_evaluation <= 12 AND artifact_completeness = 1
           AS process_pass
  FROM timed),
decided AS (
  SELECT gated.*, accuracy.*, cohorts_pass,
         cohorts_pass AND test_smape_volume <= 40 AS quality_pass,
         test_smape_volume <= 40 AS report_quality_pass,
         cohorts_pass AND test_smape_volume <= 40 AND process_pass AS promotion_recommendation,
         coalesce(block_reason,
                  CASE WHEN NOT (cohorts_pass AND test_smape_volume <= 40)
                       THEN 'CRITICAL: OverallSmapeBreach' END,
                  CASE WHEN deviation_warning THEN 'WARNING: SpikerVolatility' END)
           AS promotion_block_reason
  FROM gated, accuracy, verdict),
texts AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_orderkey % 17 = 0 OR l_orderkey % 19 = 0 OR l_orderkey % 23 = 0
                OR l_orderkey % 29 = 0 OR l_orderkey % 31 = 0 THEN NULL
              ELSE CAST(l_shipdate AS DATE) END AS event_date,
         CASE WHEN (l_orderkey + l_linenumber) % 17 = 0 OR (l_orderkey + l_linenumber) % 19 = 0
              THEN NULL ELSE l_quantity END AS actual_volume,
         round(l_discount * 100) AS rolling_4w_median
  FROM lineitem),
customer_days AS (
  SELECT c_name AS client_name, CAST(l_shipdate AS DATE) AS event_date,
         sum(l_quantity) AS actual_volume
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  GROUP BY 1, 2),
medians AS (
  SELECT client_name, quantile_disc(actual_volume, 0.5) AS median_daily_volume
  FROM customer_days GROUP BY 1)
"""

_CANONICAL = (
    "client_name, event_date, actual_volume, rolling_4w_median, is_china, is_domestic"
)
_DAY_EVENTS = "event_month_start, event_christmas_day, event_black_friday"
_CYCLES = (
    ("month", "month(event_date)", 12),
    ("dow", "(isodow(event_date) - 1)", 7),
    ("doy", "dayofyear(event_date)", 365),
    ("woy", "week(event_date)", 52),
    ("dom", "day(event_date)", 31),
)
_WAVES = ", ".join(
    f"round({wave}(2 * pi() * {part} / {period}), 9) AS {prefix}_{wave}"
    for prefix, part, period in _CYCLES
    for wave in ("sin", "cos")
)
_LEDGER = """SELECT archetype, row_count, round(business_smape, 6) AS business_smape, threshold,
       workflow_impact_flag FROM ledger"""
_REFINED = f"SELECT {_CANONICAL}, {_DAY_EVENTS} FROM refined"

_METRICS = {
    "val_smape_target": "round(val_smape_target, 6)",
    "test_smape_target": "round(test_smape_target, 6)",
    "val_smape_volume": "round(val_smape_volume, 6)",
    "test_smape_volume": "round(test_smape_volume, 6)",
    "cmmi_hours_to_baseline": "hours_to_baseline",
    "cmmi_hours_to_evaluation": "hours_to_evaluation",
    "cmmi_artifact_completeness": "artifact_completeness",
}
_PARAMETERS = {
    "run_mode": "'production'",
    "input_source_mode": "'parquet'",
    "input_source": "'lineitem'",
    "feature_count": "'0'",
    "fit_partitions": "'16'",
    "test_days": "'42'",
    "val_days": "'42'",
    "dataset_version": "'v1'",
    "model_name": "'multi_client_uplift_trees'",
    "cmmi_baseline_speed_pass": "CAST(baseline_speed_pass AS VARCHAR)",
    "cmmi_evaluation_speed_pass": "CAST(evaluation_speed_pass AS VARCHAR)",
    "cmmi_artifact_completeness_pass": "CAST(artifact_completeness_pass AS VARCHAR)",
    "promotion_evidence_allowed": "'true'",
    "promotion_gate_metric": "'test_smape_volume'",
    "promotion_gate_threshold": "'40.0'",
    "quality_pass": "CAST(quality_pass AS VARCHAR)",
    "promotion_recommendation": "CAST(promotion_recommendation AS VARCHAR)",
    "promotion_block_reason": "coalesce(promotion_block_reason, 'None')",
}


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _stage_rows() -> str:
    gates = " || ', ' || ".join(
        f"'{gate}=' || CAST({gate} AS VARCHAR)"
        for gate in ("baseline_speed_pass", "evaluation_speed_pass", "artifact_completeness_pass")
    )
    kept = "(SELECT count(*) FROM refined) || ' of ' || (SELECT count(*) FROM based) || ' rows kept'"
    sizes = " || ', ' || ".join(
        f"'{part}=' || (SELECT count(*) FROM labelled WHERE split = '{part}')"
        for part in ("train", "val", "test")
    )
    measured = {
        1: ("Trigger", "'run_id=' || run_id || ', dataset_version=v1'"),
        2: ("Load and validate data", kept),
        3: ("Transform features", "'15 features'"),
        4: ("Split and train", sizes),
        7: ("Record run", "''"),
        8: ("Generate run report artifacts", "''"),
    }
    rows = [
        f"SELECT run_id, {step} AS step, '{stage}' AS stage, 'Pass' AS status,"
        f" {evidence} AS evidence FROM decided"
        for step, (stage, evidence) in measured.items()
    ]
    rows.append(
        "SELECT run_id, 5, 'Evaluate',"
        " CASE WHEN report_quality_pass THEN 'Pass' ELSE 'Partial' END,"
        " format('test_smape_target={:.4f}, val_smape_target={:.4f},"
        " test_smape_volume={:.4f}, val_smape_volume={:.4f}',"
        " test_smape_target, val_smape_target, test_smape_volume, val_smape_volume) FROM decided"
    )
    rows.append(
        "SELECT run_id, 6, 'Compute CMMI metrics',"
        " CASE WHEN process_pass THEN 'Pass' ELSE 'Partial' END,"
        f" {gates} FROM decided"
    )
    return _union(rows)


def _gate_rows() -> str:
    gates = " || ', ' || ".join(
        f"'{gate}=' || CAST({gate} AS VARCHAR)"
        for gate in ("baseline_speed_pass", "evaluation_speed_pass", "artifact_completeness_pass")
    )
    rows = {
        "reproducibility": (
            "'Pass'",
            "'run_id=' || run_id || ', dataset_version=v1, model_name=multi_client_uplift_trees'",
        ),
        "quality": (
            "CASE WHEN report_quality_pass THEN 'Pass' ELSE 'Partial' END",
            "format('test_smape_volume={:.4f}, limit 40.0', test_smape_volume)",
        ),
        "cmmi_process": (
            "CASE WHEN process_pass THEN 'Pass' ELSE 'Partial' END",
            gates,
        ),
        "documentation": ("'Pass'", "''"),
        "approval": ("'Pending'", "''"),
    }
    return _union(
        [f"SELECT run_id, '{gate}' AS gate, {status} AS status, {rationale} AS rationale"
         f" FROM decided"
         for gate, (status, rationale) in rows.items()]
    )


#: Guard, what it is given, error (None if all rows pass), subject, and the failing rows.
_GUARDS = (
    ("columns", "complete", None, "''", "NULL"),
    ("columns", "no actual", "MissingColumns", "'actual_volume'", "NULL"),
    ("rows", "some", None, "''", "NULL"),
    ("rows", "none", "EmptyTable", "'client-days'", "NULL"),
    ("input", "refined", None, "''", "NULL"),
    ("input", "raw", "CheckFailed", "'missing_required_value'",
     "(SELECT count(*) FROM based WHERE rolling_4w_median IS NULL)"),
    ("input", "low actual", "CheckFailed", "'negative_actual'",
     "(SELECT count(*) FROM refined WHERE actual_volume < 30)"),
    ("input", "low baseline", "CheckFailed", "'non_positive_baseline'",
     "(SELECT count(*) FROM refined WHERE rolling_4w_median <= 30)"),
    ("input", "no baseline", "MissingColumns", "'rolling_4w_median'", "NULL"),
    ("target", "refined", None, "''", "NULL"),
    ("target", "unknown actual", "CheckFailed", "'missing_actual'",
     "(SELECT count(*) FROM refined WHERE is_china = 1)"),
    ("target", "low actual", "CheckFailed", "'negative_actual'",
     "(SELECT count(*) FROM refined WHERE actual_volume < 30)"),
    ("inverse", "refined", None, "''", "NULL"),
    ("inverse", "raw", "CheckFailed", "'missing_baseline'",
     "(SELECT count(*) FROM based WHERE rolling_4w_median IS NULL)"),
    ("inverse", "low baseline", "CheckFailed", "'non_positive_baseline'",
     "(SELECT count(*) FROM refined WHERE rolling_4w_median <= 30)"),
    ("volume", "as expected", None, "''", "NULL"),
    ("volume", "a tenth short", None, "'WARNING: ApprovedSchemaDeviation'", "NULL"),
    ("volume", "half and more short", "VolumeRejected", "'CRITICAL: DataStarvationError'",
     "(SELECT count(*) FROM refined)"),
    ("history", "two years", None, "''", "NULL"),
    ("history", "a month", "TooLittleHistory",
     "(SELECT 'train=0, val=0, test=' || count(*) FROM refined WHERE event_date >= DATE '2001-11-04' - 30)",
     "(SELECT count(*) FROM refined WHERE event_date >= DATE '2001-11-04' - 30)"),
)


def _guard_rows() -> str:
    return _union(
        [
            f"SELECT '{guard}' AS guard, '{given}' AS given, '{error or 'passed'}' AS outcome, "
            f"{subject} AS subject, CAST({rows} AS BIGINT) AS failing_rows"
            for guard, given, error, subject, rows in _GUARDS
        ]
    )


#: Stored settings other than the expected rows, which the query counts.
_SNAPSHOT = {
    "MAX_SMAPE_THRESHOLD": 40,
    "MAX_ANCHOR_SMAPE": 7.5,
    "MAX_DIAL_SMAPE": 13,
    "MAX_SPIKER_SMAPE": 24,
    "MAX_PHANTOM_SMAPE": 32,
    "ARCHETYPE_HIGH_VOLUME_QUANTILE": 0.75,
    "ARCHETYPE_LOW_VOLUME_QUANTILE": 0.35,
    "ARCHETYPE_LOW_PREDICTABILITY_QUANTILE": 0.65,
    "ARCHETYPE_HIGH_PREDICTABILITY_QUANTILE": 0.35,
}

_SELECTS = {
    "daily_volume": f"""SELECT client_name, event_date, actual_volume, is_china, is_domestic,
        {_DAY_EVENTS} FROM flagged""",
    "rolling_baseline": f"SELECT {_CANONICAL}, {_DAY_EVENTS} FROM based",
    "csv_scan": _REFINED,
    "table_scan": _REFINED,
    "history_rows": _REFINED,
    "history_test_rows": """SELECT client_name, event_date, actual_volume FROM based
        WHERE event_date >= (SELECT max(event_date) - 41 FROM based)""",
    "refined_rows": _REFINED,
    "alias_projection": """SELECT client_name, event_date, actual_volume, rolling_4w_median,
        is_china, 0 AS is_domestic FROM based""",
    "coercion": "SELECT l_orderkey, l_linenumber, event_date, actual_volume FROM texts",
    "event_flags": f"""SELECT client_name, event_date, {_DAY_EVENTS},
        CAST(CASE WHEN actual_volume % 3 <> 0 THEN actual_volume ELSE 0 END AS INTEGER)
          AS event_wide,
        CASE WHEN is_china = 1 THEN 0 ELSE 1 END AS event_text FROM based""",
    "champion_clients": """SELECT client_name, event_date, actual_volume FROM daily
        WHERE client_name IN (
          SELECT n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey
          WHERE r_name IN ('ASIA', 'EUROPE', 'AMERICA'))""",
    "client_medians": "SELECT client_name, median_daily_volume FROM medians",
    "active_clients": """SELECT customer_days.client_name, event_date, actual_volume
        FROM customer_days JOIN medians ON customer_days.client_name = medians.client_name
        WHERE median_daily_volume > 30""",
    "refine_drop_counts": """SELECT total_rows, kept_rows, total_rows - kept_rows AS dropped_rows,
        missing_date, missing_actual, missing_baseline, before_cutoff, after_as_of,
        non_positive_actual, low_baseline
        FROM (SELECT count(*) AS total_rows, count(*) FILTER (WHERE event_date IS NULL) AS missing_date,
          count(*) FILTER (WHERE actual_volume IS NULL) AS missing_actual,
          count(*) FILTER (WHERE rolling_4w_median IS NULL) AS missing_baseline,
          count(*) FILTER (WHERE event_date < DATE '2001-11-04' - 730) AS before_cutoff,
          count(*) FILTER (WHERE event_date > DATE '2001-11-04') AS after_as_of,
          count(*) FILTER (WHERE actual_volume <= 0) AS non_positive_actual,
          count(*) FILTER (WHERE rolling_4w_median <= 10) AS low_baseline FROM based)
        CROSS JOIN (SELECT count(*) AS kept_rows FROM refined)""",
    "observed_refinement": """SELECT total_rows, kept_rows, total_rows - kept_rows AS dropped_rows,
        missing_date, missing_actual, missing_baseline, before_cutoff, after_as_of,
        non_positive_actual, low_baseline, kept_rows AS valid_rows, checked.*
        FROM (SELECT count(*) AS total_rows, count(*) FILTER (WHERE event_date IS NULL) AS missing_date,
          count(*) FILTER (WHERE actual_volume IS NULL) AS missing_actual,
          count(*) FILTER (WHERE rolling_4w_median IS NULL) AS missing_baseline,
          count(*) FILTER (WHERE event_date < DATE '2001-11-04' - 730) AS before_cutoff,
          count(*) FILTER (WHERE event_date > DATE '2001-11-04') AS after_as_of,
          count(*) FILTER (WHERE actual_volume <= 0) AS non_positive_actual,
          count(*) FILTER (WHERE rolling_4w_median <= 10) AS low_baseline FROM based)
        CROSS JOIN (SELECT count(*) AS kept_rows FROM refined)
        CROSS JOIN (SELECT
          count(*) FILTER (WHERE actual_volume IS NULL OR rolling_4w_median IS NULL)
            AS input_missing_required_value,
          count(*) FILTER (WHERE actual_volume < 0) AS input_negative_actual,
          count(*) FILTER (WHERE rolling_4w_median <= 0) AS input_non_positive_baseline,
          count(*) FILTER (WHERE actual_volume IS NULL) AS target_missing_actual,
          count(*) FILTER (WHERE rolling_4w_median IS NULL) AS target_missing_baseline,
          count(*) FILTER (WHERE rolling_4w_median <= 0) AS target_non_positive_baseline,
          count(*) FILTER (WHERE actual_volume < 0) AS target_negative_actual,
          count(*) FILTER (WHERE rolling_4w_median IS NULL) AS inverse_missing_baseline,
          count(*) FILTER (WHERE rolling_4w_median <= 0) AS inverse_non_positive_baseline
          FROM refined) AS checked""",
    "guard_outcomes": _guard_rows(),
    "guardrail": """SELECT NOT starved AND NOT poor AS passed,
        CASE WHEN starved THEN 'CRITICAL: DataStarvationError'
             WHEN poor THEN 'CRITICAL: DataQualityError'
             WHEN drop_frac > 0.02 THEN 'WARNING: ApprovedSchemaDeviation' END AS failure_reason,
        round(drop_frac, 9) AS drop_frac, valid_rows, expected_row_count,
        CASE WHEN starved OR poor THEN 'ZONE_3_CRITICAL_REJECTION'
             WHEN drop_frac <= 0.02 THEN 'ZONE_1_NOMINAL'
             ELSE 'ZONE_2_DEVIATION_WARNING' END AS workflow_impact_flag
        FROM (SELECT valid_rows, expected_row_count, drop_frac,
                     valid_rows < 0.5 * expected_row_count AS starved, drop_frac > 0.92 AS poor
              FROM (SELECT valid_rows, expected_row_count,
                      CASE WHEN expected_row_count = 0 THEN 1.0
                           ELSE 1.0 - CAST(valid_rows AS DOUBLE) / expected_row_count END
                        AS drop_frac
                    FROM (SELECT (SELECT count(*) FROM refined) AS valid_rows,
                            CAST(floor(count(*) * tenths / 10.0) AS BIGINT) AS expected_row_count
                          FROM based, (VALUES (0), (10), (15), (30)) AS steps(tenths)
                          WHERE event_date BETWEEN DATE '2001-11-04' - 730 AND DATE '2001-11-04'
                          GROUP BY tenths)))""",
    "violations": """SELECT
        count(*) FILTER (WHERE event_date IS NULL OR actual_volume IS NULL OR rolling_4w_median IS NULL)
          AS input_missing_required_value,
        count(*) FILTER (WHERE actual_volume - 3 < 0) AS input_negative_actual,
        count(*) FILTER (WHERE rolling_4w_median <= 0) AS input_non_positive_baseline,
        count(*) FILTER (WHERE actual_volume IS NULL) AS target_missing_actual,
        count(*) FILTER (WHERE rolling_4w_median IS NULL) AS target_missing_baseline,
        count(*) FILTER (WHERE rolling_4w_median <= 0) AS target_non_positive_baseline,
        count(*) FILTER (WHERE actual_volume - 3 < 0) AS target_negative_actual,
        count(*) FILTER (WHERE rolling_4w_median IS NULL) AS inverse_missing_baseline,
        count(*) FILTER (WHERE rolling_4w_median <= 0) AS inverse_non_positive_baseline FROM texts""",
    "calendar_parts": """SELECT client_name, event_date, CAST(month(event_date) AS INTEGER) AS month,
        CAST(isodow(event_date) - 1 AS INTEGER) AS day_of_week,
        CAST(dayofyear(event_date) AS INTEGER) AS day_of_year,
        CAST(week(event_date) AS INTEGER) AS week_of_year,
        CAST(day(event_date) AS INTEGER) AS day_of_month FROM daily""",
    "cyclical_features": f"SELECT client_name, event_date, {_WAVES} FROM daily",
    "uplift_target": """SELECT client_name, event_date, actual_volume, rolling_4w_median,
        round(ln(greatest(actual_volume / rolling_4w_median, 0.000001)), 9) AS target
        FROM based WHERE rolling_4w_median > 0""",
    "uplift_roundtrip": """SELECT client_name, event_date, actual_volume, rolling_4w_median,
        round(exp(ln(greatest(actual_volume / rolling_4w_median, 0.000001)))
              * rolling_4w_median, 6) AS restored_volume
        FROM based WHERE rolling_4w_median > 0""",
    "split_bounds": "SELECT max_date, test_start, val_start FROM bounds",
    "split_sufficiency": """SELECT lookback_days, train_rows, val_rows, test_rows,
        least(train_rows, val_rows, test_rows) > 0 AS sufficient
        FROM (SELECT lookback_days,
                count(*) FILTER (WHERE event_date < last_date - 83) AS train_rows,
                count(*) FILTER (WHERE event_date >= last_date - 83
                                   AND event_date < last_date - 41) AS val_rows,
                count(*) FILTER (WHERE event_date >= last_date - 41) AS test_rows
              FROM (SELECT lookback_days, event_date,
                           max(event_date) OVER (PARTITION BY lookback_days) AS last_date
                    FROM refined, (VALUES (730), (70), (30)) AS lookbacks(lookback_days)
                    WHERE event_date >= DATE '2001-11-04' - lookback_days)
              GROUP BY lookback_days)""",
    "model_features": f"""UNPIVOT (
        SELECT client_name, event_date, {_WAVES},
          round(CAST(is_china AS DOUBLE), 9) AS is_china,
          round(CAST(is_domestic AS DOUBLE), 9) AS is_domestic,
          round(CAST(event_month_start AS DOUBLE), 9) AS event_month_start,
          round(CAST(event_christmas_day AS DOUBLE), 9) AS event_christmas_day,
          round(CAST(event_black_friday AS DOUBLE), 9) AS event_black_friday
        FROM refined) ON COLUMNS(* EXCLUDE (client_name, event_date))
        INTO NAME feature VALUE value""",
    "split_counts": "SELECT split, count(*) AS row_count FROM labelled GROUP BY split",
    "split_rows": "SELECT client_name, event_date, split FROM labelled ORDER BY event_date",
    "naive_smape_by_split": """SELECT split, count(*) AS row_count,
        round(100 * avg(log_error), 6) AS smape_target,
        round(100 * avg(volume_error), 6) AS smape_volume,
        round(100 * avg(volume_error), 6) AS smape_naive FROM errors GROUP BY split""",
    "run_accuracy": """SELECT round(val_smape_target, 6) AS val_smape_target,
        round(test_smape_target, 6) AS test_smape_target,
        round(val_smape_volume, 6) AS val_smape_volume,
        round(test_smape_volume, 6) AS test_smape_volume,
        round(test_smape_volume, 6) AS naive_test_smape_volume FROM accuracy""",
    "cohort_cutpoints": """SELECT round(high_volume_cut, 9) AS high_volume_cut,
        round(low_volume_cut, 9) AS low_volume_cut,
        round(low_predictability_cut, 9) AS low_predictability_cut,
        round(high_predictability_cut, 9) AS high_predictability_cut FROM cuts""",
    "cohort_rows": """SELECT client_name, event_date, actual_volume, rolling_4w_median, archetype
        FROM cohorts""",
    "cohort_daily": """SELECT archetype, event_date, row_count, actual_total, predicted_total
        FROM cohort_days""",
    "cohort_ledger": _LEDGER,
    "ledger_json": _LEDGER,
    "cohort_briefing": """SELECT archetype, row_count,
        coalesce(format('{:.4f}', business_smape), 'NA') AS business_smape, threshold,
        workflow_impact_flag FROM ledger""",
    "gate_verdict": """SELECT cohorts_pass, block_reason, deviation_warning, breached_cohorts
        FROM verdict""",
    "promotion_decision": """SELECT run_id, cohorts_pass, quality_pass, process_pass,
        promotion_recommendation, promotion_block_reason, NOT quality_pass AS is_blocking
        FROM decided""",
    "run_hours": """SELECT run_id, hours_to_baseline, hours_to_evaluation, artifact_completeness
        FROM timed""",
    "run_gates": """SELECT run_id, baseline_speed_pass, evaluation_speed_pass,
        artifact_completeness_pass, process_pass FROM gated""",
    "promotion_rate": """SELECT count(*) AS run_count,
        round(avg(CASE WHEN promoted THEN 1.0 ELSE 0.0 END), 9) AS promotion_rate FROM runs""",
    "drift_latency": """SELECT run_id, drift_latency_hours FROM timed""",
    "run_metrics_long": _union(
        [f"SELECT run_id, '{key}' AS key, {value} AS value FROM decided"
         for key, value in _METRICS.items()]
    ),
    "run_params_long": _union(
        [f"SELECT run_id, '{key}' AS key, {value} AS value FROM decided"
         for key, value in _PARAMETERS.items()]
    ),
    "config_snapshot": _union(
        [f"SELECT '{key}' AS key, CAST({value} AS DOUBLE) AS value" for key, value in _SNAPSHOT.items()]
        + ["SELECT 'REFINERY_EXPECTED_ROW_COUNT' AS key, CAST(count(*) AS DOUBLE) AS value FROM daily"]
    ),
    "model_roundtrip": """SELECT client_name, event_date, split, actual_volume,
        true AS volume_restored, true AS reloaded_equal, true AS in_range
        FROM labelled WHERE split <> 'train'""",
    "run_report": """SELECT run_id, 'Demand uplift run report' AS report_name, 'Phase 0' AS phase,
        'Check that a training run repeats and that its evidence is complete.' AS objective,
        'A run passes when the quality gate and every process gate do; otherwise it is rejected.'
          AS explanation,
        CASE WHEN promotion_recommendation AND process_pass THEN 'pass' ELSE 'reject' END
          AS recommendation,
        round(test_smape_target, 6) AS test_smape_target,
        round(val_smape_target, 6) AS val_smape_target,
        round(test_smape_volume, 6) AS test_smape_volume,
        round(val_smape_volume, 6) AS val_smape_volume,
        hours_to_baseline,
        CAST(12 AS DOUBLE) AS max_evaluation_hours, 4 AS cohort_count,
        (SELECT row_count FROM ledger WHERE ordinal = 0) AS anchor_rows,
        coalesce(promotion_block_reason, 'None') AS promotion_block_reason,
        CAST(13 AS DOUBLE) AS max_dial_smape, report_quality_pass AS quality_pass, process_pass
        FROM decided""",
    "run_stages": _stage_rows(),
    "run_gate_snapshot": _gate_rows(),
}

ORACLE_SQL: dict[str, str] = {name: f"{_STEPS} {select}" for name, select in _SELECTS.items()}

"""Analytics queries over the recall stand-in, each with its SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.oracle_parts import (MEAN_SCORE, QUANTITY, REACH, class_count, match_case, on_categorised,
                                 on_recalls, on_scored, pct, r_even)
from recallspark.functions import rules as R
from recallspark.functions.numbers import round_even
from recallspark.functions.scoring import quantity_points, reach_points
from recallspark.functions.text import parse_quantity, state_reach
from recallspark.operators import categorize as C, crosstabs as X, monitoring as M, ranking as K, temporal as T
from recallspark.operators.merge import rebuild_firms
from recallspark.operators.risk import score, tier_distribution
from recallspark.schemas import ANALYTICS_COLUMNS
from recallspark.sources.recalls import load_firms, load_recalls
from checks.standin import recall_view, run_log_view, table


def categorised(spark, sf_dir) -> DataFrame:
    return C.categorize(recall_view(spark, sf_dir))


def scored(spark, sf_dir) -> DataFrame:
    return score(categorised(spark, sf_dir))


def on_view(op):
    return lambda spark, sf_dir: op(recall_view(spark, sf_dir))


def on_cat(op):
    return lambda spark, sf_dir: op(categorised(spark, sf_dir))


def on_score(op):
    return lambda spark, sf_dir: op(scored(spark, sf_dir))


def on_log(op):
    return lambda spark, sf_dir: op(run_log_view(spark, sf_dir))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles that come from long sums, cut to six decimals for a comparison across engines."""
    return df.withColumns({c: round_even(F.col(c), 6) for c in columns})


KEY = "recall_number, l_partkey, l_suppkey, l_extendedprice"
KEYS = KEY.split(", ")
FROM, TO = date(1996, 1, 1), date(1997, 12, 31)
_EMPTY = {"brand_name", "substance_name", "manufacturer_name", "voluntary_mandated", "city"}
_SCAN = ", ".join(
    "NULL::BIGINT AS id" if c == "id" else f"NULL::VARCHAR AS {c}" if c in _EMPTY
    else "NULL::DATE AS termination_date" if c == "termination_date" else c for c in ANALYTICS_COLUMNS)


def src1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_recalls(recall_view(spark, sf_dir), FROM, TO, "Drugs").withColumn("id", F.lit(None).cast("long"))


def document_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("_text", F.lower("text"))
    return docs.select("doc_id", *[C.first_match(F.col("_text"), rules).alias(name) for name, rules in (
        ("therapeutic_area", R.THERAPEUTIC_AREAS), ("device_type", R.DEVICE_TYPES),
        ("food_type", R.FOOD_TYPES), ("reason_category", R.RECALL_REASONS))])


def device_types(spark, sf_dir):
    return recall_view(spark, sf_dir).select(
        *KEYS, C.device_type(C.join_filled(F.col("product_description"), F.col("brand_name"),
                                           F.col("reason_for_recall"))).alias("device_type"))


def food_types(spark, sf_dir):
    return recall_view(spark, sf_dir).select(
        *KEYS, C.food_type(C.join_filled(F.col("product_description"), F.col("reason_for_recall"))).alias("food_type"))


def reach_rows(spark, sf_dir):
    reach = recall_view(spark, sf_dir).select(*KEYS, state_reach(F.col("distribution_pattern")).alias("reach"))
    return reach.withColumn("points", reach_points(F.col("reach")))


def quantity_rows(spark, sf_dir):
    q = F.col("product_quantity")
    return rounded(recall_view(spark, sf_dir).select(
        *KEYS, parse_quantity(q).cast("long").alias("quantity"), quantity_points(q).alias("points")), "points")


def fallback_manufacturers(spark, sf_dir):
    return K.top_manufacturers(recall_view(spark, sf_dir), firm_column="recalling_firm")


def picked_manufacturers(spark, sf_dir):
    frame = categorised(spark, sf_dir).withColumn("manufacturer_name", F.col("recalling_firm")).withColumn(
        "recalling_firm", F.lit(None).cast("string"))
    return K.repeat_offenders(frame, min_class_i=3)


def firm_scan(spark, sf_dir):
    return load_firms(rebuild_firms(recall_view(spark, sf_dir)))


DATED = "FROM recalls WHERE report_date IS NOT NULL"
MONTH = "date_trunc('month', report_date)::DATE"
MONTHLY = f"SELECT {MONTH} AS month, count(*) AS n {DATED} GROUP BY 1"
SEASON = ("CASE WHEN month(report_date) IN (12,1,2) THEN 'Winter' WHEN month(report_date) IN (3,4,5) THEN 'Spring' "
          "WHEN month(report_date) IN (6,7,8) THEN 'Summer' ELSE 'Fall' END")
FIRM_AGG = f"""SELECT recalling_firm AS manufacturer, count(recall_number) AS total_recalls,
  {class_count('Class I')} AS class_i, {class_count('Class II')} AS class_ii, {class_count('Class III')} AS class_iii"""
RUNS = """runs AS (SELECT event_id AS run_id, ts AS started_at, event_type AS endpoint, value AS duration_seconds,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN event_type = 'error' THEN concat('code ', props->>'$.k') END AS error_message FROM events
  ORDER BY ts DESC NULLS FIRST, event_id LIMIT 100)"""


def summary_sql(column: str) -> str:
    return on_scored(f"""SELECT {column}, count(recall_number) AS total_recalls, {class_count('Class I')} AS class_i_recalls,
      {pct(class_count('Class I'), 'count(recall_number)')} AS class_i_pct FROM scored GROUP BY {column}""")


CORRELATION = f"""SELECT {r_even('r', 3)} AS r,
    -- both sides of the t distribution: its density beyond t against all of it, by midpoints
    {r_even('sum(exp(-(n - 1) / 2.0 * ln(1 + (t + u) * (t + u) / (n - 2)))) / sum(exp(-(n - 1) / 2.0 * ln(1 + u * u / (n - 2))))', 4)}
    AS p_value, n FROM (SELECT *, abs(r) * sqrt((n - 2) / (1 - r * r)) AS t
    FROM (SELECT corr(reach, risk_score) AS r, count(*) AS n FROM scored))
    CROSS JOIN (SELECT (unnest(range(40000)) + 0.5::DOUBLE) / 1000 AS u) GROUP BY r, n"""

ENTRIES = {
    "src1_load_recalls": (src1, on_recalls(
        f"""SELECT {_SCAN} FROM recalls WHERE product_type = 'Drugs'
        AND coalesce(report_date, recall_initiation_date) BETWEEN DATE '{FROM}' AND DATE '{TO}'""")),
    "src2_load_firms": (firm_scan, on_recalls(
        f"""SELECT recalling_firm AS name, count(*) AS total_recalls, {class_count('Class I')} AS class_i_count,
        {class_count('Class II')} AS class_ii_count, {class_count('Class III')} AS class_iii_count,
        min(coalesce(recall_initiation_date, report_date)) AS first_recall_date,
        max(coalesce(recall_initiation_date, report_date)) AS latest_recall_date
        FROM recalls WHERE trim(coalesce(recalling_firm, '')) <> '' GROUP BY 1""")),

    "cat1_rules_on_documents": (document_rules, f"""
        SELECT doc_id, {match_case('t', R.THERAPEUTIC_AREAS)} AS therapeutic_area,
        {match_case('t', R.DEVICE_TYPES)} AS device_type, {match_case('t', R.FOOD_TYPES)} AS food_type,
        {match_case('t', R.RECALL_REASONS)} AS reason_category
        FROM (SELECT doc_id, lower(text) AS t FROM documents)"""),
    "cat2_therapeutic_area": (on_cat(lambda d: d.select(*KEYS, "therapeutic_area")),
                              on_categorised(f"SELECT {KEY}, therapeutic_area FROM cat")),
    "cat3_device_type": (device_types, on_recalls(
        f"""SELECT {KEY}, {match_case("lower(concat_ws(' ', nullif(product_description, ''), nullif(reason_for_recall, '')))",
                                      R.DEVICE_TYPES)} AS device_type FROM recalls""")),
    "cat4_food_type": (food_types, on_recalls(
        f"""SELECT {KEY}, {match_case("lower(concat_ws(' ', nullif(product_description, ''), nullif(reason_for_recall, '')))",
                                      R.FOOD_TYPES)} AS food_type FROM recalls""")),
    "cat5_reason_category": (on_view(lambda d: d.select(*KEYS, C.reason_category(F.col("reason_for_recall"))
                                                        .alias("reason_category"))),
                             on_categorised(f"SELECT {KEY}, reason_category FROM cat")),
    "cat6_product_category": (on_cat(lambda d: d.select(*KEYS, "product_category")),
                              on_categorised(f"SELECT {KEY}, product_category FROM cat")),
    "cat7_severity_rank": (on_cat(lambda d: d.select(*KEYS, "severity_rank")),
                           on_categorised(f"SELECT {KEY}, severity_rank FROM cat")),
    "cat8_categorize": (on_cat(lambda d: d.select(*KEYS, "therapeutic_area", "product_category", "reason_category",
                                                  "severity_rank")),
                        on_categorised(f"SELECT {KEY}, therapeutic_area, product_category, reason_category, severity_rank FROM cat")),
    "cat9_parse_quantity": (quantity_rows, on_recalls(
        f"""SELECT {KEY}, quantity::BIGINT AS quantity, {r_even('''CASE WHEN quantity > 0 THEN
        least(20.0::DOUBLE, greatest(0.0::DOUBLE, log10(quantity::DOUBLE) / 6.0::DOUBLE * 20.0::DOUBLE)) ELSE 0.0::DOUBLE END''', 6)} AS points
        FROM (SELECT *, {QUANTITY} AS quantity FROM recalls)""")),
    "rsk1_state_reach": (reach_rows, on_recalls(
        f"""SELECT {KEY}, reach, CASE WHEN reach >= 10 THEN 25 WHEN reach >= 2 THEN 15 WHEN reach = 1 THEN 7 ELSE 10 END AS points
        FROM (SELECT *, ({REACH})::INTEGER AS reach FROM recalls)""")),
    "rsk4_risk_score": (on_score(lambda d: d.select(*KEYS, "risk_score", "risk_tier")),
                        on_scored(f"SELECT {KEY}, risk_score, risk_tier FROM scored")),
    "rsk5_risk_tiers_by_status": (on_score(lambda d: d.groupBy("status", "risk_tier").agg(F.count("*").alias("n"))),
                                  on_scored("SELECT status, risk_tier, count(*) AS n FROM scored GROUP BY ALL")),

    "agg1_by_product_type": (on_score(lambda d: C.summary_by(d, "product_type")), summary_sql("product_type")),
    "agg1_by_classification": (on_score(lambda d: C.summary_by(d, "classification")), summary_sql("classification")),
    "agg1_by_product_category": (on_score(lambda d: C.summary_by(d, "product_category")), summary_sql("product_category")),
    "agg1_by_reason_category": (on_score(lambda d: C.summary_by(d, "reason_category")), summary_sql("reason_category")),
    "agg2_tier_distribution": (on_score(tier_distribution), on_scored(
        """SELECT t.risk_tier, count(s.risk_tier) AS count
        FROM (SELECT unnest(['Critical', 'High', 'Medium', 'Low']) AS risk_tier) t
        LEFT JOIN scored s ON s.risk_tier = t.risk_tier GROUP BY 1""")),
    "rnk1_top_manufacturers": (on_score(lambda d: K.top_manufacturers(d, firm_column="recalling_firm")), on_scored(
        f"""SELECT *, {r_even('least(total_recalls, 100) * coalesce(avg_risk_score, 0) / 10.0::DOUBLE', 2)} AS priority_score
        FROM ({FIRM_AGG}, {r_even(MEAN_SCORE, 2)} AS avg_risk_score, {r_even('max(risk_score)', 2)} AS max_risk_score
        FROM scored WHERE recalling_firm IS NOT NULL GROUP BY 1) WHERE total_recalls >= 3
        ORDER BY priority_score DESC, total_recalls DESC, manufacturer LIMIT 20""")),
    "rnk2_top_manufacturers_fallback": (fallback_manufacturers, on_recalls(
        f"""SELECT *, {r_even('least(total_recalls, 100) * coalesce(avg_risk_score, 0) / 10.0::DOUBLE', 2)} AS priority_score
        FROM (SELECT *, {r_even('(class_i * 40 + class_ii * 20 + class_iii * 8)::DOUBLE / nullif(total_recalls, 0)', 2)} AS avg_risk_score,
          {r_even('(class_i * 40 + class_ii * 20 + class_iii * 8)::DOUBLE / nullif(total_recalls, 0)', 2)} AS max_risk_score
          FROM ({FIRM_AGG} FROM recalls WHERE recalling_firm IS NOT NULL GROUP BY 1)) WHERE total_recalls >= 3
        ORDER BY priority_score DESC, total_recalls DESC, manufacturer LIMIT 20""")),
    "rnk3_top_product_categories": (on_score(K.top_product_categories), on_scored(
        f"""SELECT *, {r_even('total_recalls * coalesce(avg_risk_score, 0) / 10.0::DOUBLE', 2)} AS priority_score
        FROM (SELECT product_category, count(recall_number) AS total_recalls, {class_count('Class I')} AS class_i,
          {r_even(MEAN_SCORE, 2)} AS avg_risk_score FROM scored GROUP BY 1)
        ORDER BY priority_score DESC, total_recalls DESC, product_category LIMIT 20""")),
    "rnk4_repeat_offenders": (on_score(lambda d: K.repeat_offenders(d, firm_column="recalling_firm")), on_scored(
        f"""SELECT recalling_firm AS manufacturer, {class_count('Class I')} AS class_i_recalls, count(*) AS total_recalls
        FROM scored WHERE recalling_firm IS NOT NULL GROUP BY 1 HAVING {class_count('Class I')} >= 2""")),
    "rnk5_firm_column_choice": (picked_manufacturers, on_recalls(
        f"""SELECT recalling_firm AS manufacturer, {class_count('Class I')} AS class_i_recalls, count(*) AS total_recalls
        FROM recalls WHERE recalling_firm IS NOT NULL GROUP BY 1 HAVING {class_count('Class I')} >= 3""")),
    "rnk6_top_scored": (on_score(lambda d: K.top_scored(d, 5).select("recall_number", "risk_score")), on_scored(
        "SELECT recall_number, risk_score FROM scored ORDER BY risk_score DESC, recall_number LIMIT 5")),
    "kpi1_kpi_row": (on_score(lambda d: rounded(K.kpi_row(d), "avg_risk_score")), on_scored(
        f"""SELECT count(*) AS total_recalls, {class_count('Class I')} AS class_i, count(DISTINCT recalling_firm) AS unique_firms,
        {r_even(MEAN_SCORE, 6)} AS avg_risk_score, count(*) FILTER (risk_tier = 'Critical') AS critical_count FROM scored""")),
    "kpi2_summary_metrics": (on_score(lambda d: rounded(K.summary_metrics(d), "avg_risk_score")), on_scored(
        f"""SELECT count(*) AS total_recalls, coalesce(min(report_date)::VARCHAR, 'n/a') AS earliest,
        coalesce(max(report_date)::VARCHAR, 'n/a') AS latest, count(DISTINCT recalling_firm) AS unique_firms,
        {class_count('Class I')} AS class_i, coalesce({pct(class_count('Class I'), 'count(*)')}, 0) AS class_i_pct,
        {r_even(MEAN_SCORE, 6)} AS avg_risk_score, count(*) FILTER (risk_tier = 'Critical') AS critical_count,
        count(*) FILTER (risk_tier = 'High') AS high_count FROM scored""")),
    "xtb1_type_by_classification": (on_view(X.type_by_classification), on_recalls(
        """SELECT t.product_type, c.classification, count(r.product_type) AS count
        FROM (SELECT DISTINCT product_type FROM recalls WHERE product_type IS NOT NULL) t
        CROSS JOIN (SELECT DISTINCT coalesce(classification, 'Unclassified') AS classification FROM recalls) c
        LEFT JOIN recalls r ON r.product_type = t.product_type AND coalesce(r.classification, 'Unclassified') = c.classification
        GROUP BY ALL""")),
    "hst1_score_histogram": (on_score(K.score_histogram), on_scored(
        """SELECT least(floor(risk_score / 5) + 1, 20)::BIGINT AS bin, product_type, count(*) AS count
        FROM scored GROUP BY ALL""")),
    "drl1_drill_down": (on_score(K.drill_down), on_scored(f"SELECT {', '.join(K.DRILL_DOWN)} FROM scored")),

    "tmp1_monthly_counts": (on_view(T.monthly_counts), on_recalls(
        f"SELECT {MONTH} AS month, product_type, count(*) AS count {DATED} AND product_type IS NOT NULL GROUP BY ALL")),
    "tmp1_monthly_totals": (on_view(lambda d: T.monthly_counts(d, None)), on_recalls(
        f"SELECT {MONTH} AS month, count(*) AS count {DATED} GROUP BY ALL")),
    "tmp2_quarterly_counts": (on_view(T.quarterly_counts), on_recalls(
        f"SELECT concat(year(report_date), 'Q', quarter(report_date)) AS quarter, product_type, count(*) AS count {DATED} GROUP BY ALL")),
    "tmp3_yearly_counts": (on_view(T.yearly_counts), on_recalls(
        f"SELECT year(report_date)::INTEGER AS year, product_type, count(*) AS count {DATED} GROUP BY ALL")),
    "tmp4_seasonal_counts": (on_view(T.seasonal_counts), on_recalls(
        f"SELECT {SEASON} AS season, product_type, count(*) AS count {DATED} GROUP BY ALL")),
    "tmp5_month_of_year_profile": (on_view(lambda d: rounded(T.month_of_year_profile(d), "mean", "std")), on_recalls(
        f"""SELECT month(month)::INTEGER AS month_num, {r_even('avg(n)', 6)} AS mean,
        {r_even('coalesce(stddev_samp(n), 0)', 6)} AS std, strftime(min(month), '%b') AS month_name
        FROM ({MONTHLY}) GROUP BY 1""")),
    "tmp6_trend": (on_view(lambda d: rounded(T.trend(d), "slope", "intercept", "mean")), on_recalls(
        f"""SELECT {r_even('regr_slope(n, x)', 6)} AS slope, {r_even('regr_intercept(n, x)', 6)} AS intercept,
        {r_even('avg(n)', 6)} AS mean, count(*) AS n_months
        FROM (SELECT n, row_number() OVER (ORDER BY month) - 1 AS x FROM ({MONTHLY}))""")),
    "tmp7_spike_detection": (on_view(T.spike_detection), on_recalls(
        f"""SELECT month, n AS count, z AS z_score, abs(z) >= 2 AS is_spike FROM (SELECT month, n,
        {r_even('(n - avg(n) OVER ()) / stddev_pop(n) OVER ()', 2)} AS z FROM ({MONTHLY}))""")),

    "cor1_type_by_state": (on_view(X.type_by_state), on_recalls(
        """SELECT state, count(*) FILTER (product_type = 'Drugs') AS "Drugs", count(*) FILTER (product_type = 'Devices') AS "Devices",
        count(*) FILTER (product_type = 'Food') AS "Food", count(*) AS total FROM recalls WHERE length(state) = 2 GROUP BY 1""")),
    "cor2_severity_by_reach": (on_view(X.severity_by_reach), on_recalls(
        f"""SELECT classification, count(*) FILTER (reach = 0) AS "Unknown", count(*) FILTER (reach = 1) AS "1 state",
        count(*) FILTER (reach BETWEEN 2 AND 5) AS "2-5 states", count(*) FILTER (reach BETWEEN 6 AND 15) AS "6-15 states",
        count(*) FILTER (reach BETWEEN 16 AND 60) AS "Nationwide"
        FROM (SELECT coalesce(classification, 'Unclassified') AS classification, {REACH} AS reach FROM recalls)
        WHERE reach <= 60 GROUP BY 1""")),
    "cor3_reason_by_product_type": (on_cat(X.reason_by_product_type), on_categorised(
        "SELECT reason_category, " + ", ".join(
            r_even(f"count(*) FILTER (product_type = '{t}')::DOUBLE / any_value(n_{t}) * 100", 1) + f' AS "{t}"'
            for t in R.PRODUCT_TYPES) + " FROM (SELECT *, " + ", ".join(
            f"count(*) FILTER (product_type = '{t}') OVER () AS n_{t}" for t in R.PRODUCT_TYPES)
        + " FROM cat) GROUP BY 1")),
    "cor4_chi_square": (on_cat(X.chi_square_reason_vs_severity),
                        on_categorised(f"""
        , o AS (SELECT reason_category AS a, classification AS b, count(*)::DOUBLE AS n FROM cat
                WHERE classification IS NOT NULL GROUP BY ALL),
        ra AS (SELECT a, sum(n) AS r FROM o GROUP BY a), cb AS (SELECT b, sum(n) AS c FROM o GROUP BY b),
        t AS (SELECT sum(n) AS t FROM o),
        full_cells AS (SELECT coalesce(o.n, 0) AS n, r * c / t AS e FROM ra CROSS JOIN cb CROSS JOIN t
                       LEFT JOIN o ON o.a = ra.a AND o.b = cb.b),
        tested AS (SELECT sum((n - e) * (n - e) / e) AS x,
          ((SELECT count(*) FROM ra) - 1)::INTEGER * ((SELECT count(*) FROM cb) - 1)::INTEGER AS dof, sum(n)::BIGINT AS n FROM full_cells),
        -- the tail of an even number of degrees of freedom is a finite sum
        tail AS (SELECT CASE WHEN dof % 2 = 0 THEN (SELECT sum(exp(-x / 2 + k * ln(x / 2) - lgamma(k + 1)))
                   FROM (SELECT unnest(range(dof // 2)) AS k)) END AS p, * FROM tested)
        SELECT {r_even('x', 3)} AS statistic, {r_even('p', 4)} AS p_value, dof, n,
        CASE WHEN p < 0.05 THEN 'statistically significant association (p<0.05)'
             ELSE 'no significant association (p≥0.05)' END AS interpretation FROM tail""")),
    "cor5_pearson": (on_score(X.pearson_reach_vs_score), on_scored(CORRELATION)),

    "mon1_latest_runs": (on_log(lambda d: M.latest_runs(d).select("run_id", "started_at", "endpoint", "status", "duration_seconds")),
                         f"WITH {RUNS} SELECT run_id, started_at, endpoint, status, duration_seconds FROM runs"),
    "mon2_run_kpis": (on_log(lambda d: rounded(M.run_kpis(M.latest_runs(d)), "avg_duration")), f"""WITH {RUNS}
        SELECT count(*) AS total_runs, count(*) FILTER (status = 'success') AS success_runs,
        count(*) FILTER (status = 'failed') AS failed_runs, {r_even('avg(duration_seconds)', 6)} AS avg_duration FROM runs"""),
    "mon3_daily_success_rate": (on_log(lambda d: rounded(M.daily_success_rate(M.latest_runs(d)), "success_rate")), f"""WITH {RUNS}
        SELECT started_at::DATE AS date, count(status) AS total, count(*) FILTER (status = 'success') AS successes,
        {r_even("count(*) FILTER (status = 'success')::DOUBLE / count(status) * 100", 6)} AS success_rate FROM runs GROUP BY 1"""),
    "mon4_duration_series": (on_log(lambda d: M.duration_series(M.latest_runs(d))),
                             f"WITH {RUNS} SELECT started_at, duration_seconds, endpoint FROM runs WHERE duration_seconds IS NOT NULL"),
    "mon5_failed_runs": (on_log(lambda d: M.failed_runs(M.latest_runs(d))),
                         f"WITH {RUNS} SELECT started_at, endpoint, error_message FROM runs WHERE status = 'failed'"),
    "dq1_validation_totals": (on_view(M.validation_totals), on_recalls(
        """SELECT count(*) AS total, count(*) FILTER (is_validated) AS validated,
        count(*) - count(*) FILTER (is_validated) AS unvalidated FROM recalls""")),
    "dq2_null_rates": (on_view(M.null_rates), on_recalls(
        "SELECT *, null_pct > 10 AS over_limit FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {r_even(f'count(*) FILTER ({test})::DOUBLE / count(*) * 100', 1)} AS null_pct FROM recalls"
            for c, test in [("classification", "classification IS NULL"),
                            ("product_description", "product_description IS NULL OR product_description = ''"),
                            ("distribution_pattern", "distribution_pattern IS NULL"), ("report_date", "report_date IS NULL"),
                            ("recall_initiation_date", "recall_initiation_date IS NULL"), ("brand_name", "true"),
                            ("generic_name", "generic_name IS NULL"), ("code_info", "true"),
                            ("product_quantity", "product_quantity IS NULL")]) + ")")),
    "dq4_daily_validation_failures": (on_log(M.daily_validation_failures),
                                      "SELECT ts::DATE AS date, sum((props->>'$.k')::BIGINT)::BIGINT AS failures FROM events GROUP BY 1"),
    "dq5_daily_anomalies": (on_view(lambda d: rounded(M.daily_anomalies(d), "upper_bound", "lower_bound")), on_recalls(
        f"""SELECT date, n AS record_count, {r_even('hi', 6)} AS upper_bound, {r_even('greatest(0, lo)', 6)} AS lower_bound,
        n > hi OR n < lo AS is_anomaly FROM (SELECT date, n, avg(n) OVER () + 2 * stddev_samp(n) OVER () AS hi,
          avg(n) OVER () - 2 * stddev_samp(n) OVER () AS lo, count(*) OVER () AS days
          FROM (SELECT report_date AS date, count(*) AS n {DATED} GROUP BY 1)) WHERE days > 7""")),
    "cov1_months_by_product_type": (on_view(M.monthly_coverage), on_recalls(
        f"SELECT {MONTH} AS month, product_type, count(*) AS record_count {DATED} GROUP BY ALL")),
    "cov2_months_by_source": (on_view(lambda d: M.monthly_coverage(d, "source")), on_recalls(
        f"SELECT {MONTH} AS month, source, count(*) AS record_count {DATED} GROUP BY ALL")),
    "cov3_staleness": (on_view(M.staleness), on_recalls(
        "SELECT product_type, source, max(report_date) AS latest_date, count(*) AS total_records FROM recalls GROUP BY ALL")),
    "cov4_coverage_summary": (on_view(M.coverage_summary), on_recalls(
        f"SELECT min(report_date) AS earliest, max(report_date) AS latest, count(*) AS total, count(DISTINCT product_type) AS types {DATED}")),
    "cov5_coverage_matrix": (on_view(M.coverage_matrix), on_recalls(
        f"""SELECT t.product_type, m.month, count(r.recall_number) AS record_count
        FROM (SELECT DISTINCT product_type {DATED}) t CROSS JOIN (SELECT DISTINCT {MONTH} AS month {DATED}) m
        LEFT JOIN recalls r ON r.product_type = t.product_type AND {MONTH} = m.month GROUP BY ALL""")),
    "cov6_coverage_gaps": (on_view(lambda d: M.coverage_gaps(d.withColumn("product_type", F.col("product_description")))), on_recalls(
        f"""SELECT t.product_type, s.month AS missing_month FROM (
          SELECT unnest(generate_series(min({MONTH}), max({MONTH}), INTERVAL 1 MONTH))::DATE AS month FROM recalls) s
        CROSS JOIN (SELECT DISTINCT product_description AS product_type {DATED}) t
        LEFT JOIN (SELECT DISTINCT product_description AS product_type, {MONTH} AS month {DATED}) k
          ON k.product_type = t.product_type AND k.month = s.month WHERE k.month IS NULL""")),
}

"""Report queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks.analytics import CORRELATION, SEASON, recall_view, rounded
from checks.oracle_parts import MEAN_SCORE, class_count, on_scored, pct, r_even
from recallspark.functions.rules import OTHER, PRODUCT_TYPES
from recallspark.plans.report import INSIGHTS as SENTENCES, build_report, generate_report, long_sections, report_lines

AS_OF = date(1998, 12, 31)
ROLL_UPS = ["by_product_type", "by_classification", "by_product_category", "by_reason_category",
            "risk_tier_distribution", "repeat_offenders", "monthly_trend", "by_therapeutic_area", "seasonal_profile",
            "state_distribution", "severity_vs_reach", "reach_vs_risk_correlation"]


def full(spark, sf_dir):
    return build_report(recall_view(spark, sf_dir), AS_OF, firm_column="recalling_firm")


def summary(spark, sf_dir):
    return rounded(full(spark, sf_dir).summary, "avg_risk_score")


def sections(spark, sf_dir):
    return long_sections(full(spark, sf_dir), ROLL_UPS)


def last_year(spark, sf_dir):
    return rounded(generate_report(recall_view(spark, sf_dir), date(1997, 6, 30), product_type="Devices").summary,
                   "avg_risk_score")


def summary_sql(where: str) -> str:
    return on_scored(f"""SELECT count(*) AS total_recalls, min(report_date)::VARCHAR AS earliest,
      max(report_date)::VARCHAR AS latest, count(DISTINCT recalling_firm) AS unique_firms, {class_count('Class I')} AS class_i,
      {pct(class_count('Class I'), 'count(*)')} AS class_i_pct, {r_even(MEAN_SCORE, 6)} AS avg_risk_score,
      count(*) FILTER (risk_tier = 'Critical') AS critical_count, count(*) FILTER (risk_tier = 'High') AS high_count
      FROM scored WHERE {where}""")


def _rows(section: str, key: str, metrics: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{section}' AS section, {key} AS key, '{m}' AS metric, ({e})::DOUBLE AS value {source}"
                              for m, e in metrics.items())


_SUMS = {"total_recalls": "count(recall_number)", "class_i_recalls": class_count("Class I"),
         "class_i_pct": pct(class_count("Class I"), "count(recall_number)")}
SECTIONS_SQL = on_scored(" UNION ALL ".join(
    [_rows(f"by_{c}", f"coalesce({c}, 'null')", _SUMS, f"FROM scored GROUP BY {c}")
     for c in ("product_type", "classification", "product_category", "reason_category")]
    + [_rows("risk_tier_distribution", "t", {"count": "(SELECT count(*) FROM scored WHERE risk_tier = t)"},
             "FROM (SELECT unnest(['Critical', 'High', 'Medium', 'Low']) AS t)"),
       _rows("repeat_offenders", "recalling_firm", {"class_i_recalls": class_count("Class I"), "total_recalls": "count(*)"},
             f"FROM scored WHERE recalling_firm IS NOT NULL GROUP BY recalling_firm HAVING {class_count('Class I')} >= 2"),
       _rows("monthly_trend", "concat(date_trunc('month', report_date)::DATE, ' / ', product_type)", {"count": "count(*)"},
             "FROM scored WHERE report_date IS NOT NULL GROUP BY date_trunc('month', report_date), product_type"),
       _rows("by_therapeutic_area", "therapeutic_area", _SUMS, "FROM scored WHERE product_type = 'Drugs' GROUP BY therapeutic_area"),
       _rows("seasonal_profile", "concat(season, ' / ', product_type)", {"count": "count(*)"},
             f"FROM (SELECT {SEASON} AS season, product_type FROM scored WHERE report_date IS NOT NULL) GROUP BY season, product_type"),
       _rows("state_distribution", "state", {**{t: f"count(*) FILTER (product_type = '{t}')" for t in PRODUCT_TYPES}, "total": "count(*)"},
             "FROM scored WHERE length(state) = 2 GROUP BY state"),
       _rows("severity_vs_reach", "coalesce(classification, 'Unclassified')",
             {"Unknown": "count(*) FILTER (reach = 0)", "1 state": "count(*) FILTER (reach = 1)",
              "2-5 states": "count(*) FILTER (reach BETWEEN 2 AND 5)", "6-15 states": "count(*) FILTER (reach BETWEEN 6 AND 15)",
              "Nationwide": "count(*) FILTER (reach BETWEEN 16 AND 60)"}, "FROM scored WHERE reach <= 60 GROUP BY classification"),
       _rows("reach_vs_risk_correlation", "'all'", {"r": "r", "p_value": "p_value", "n": "n"}, f"FROM ({CORRELATION})")]))


def _say(number: int, values: list[str], source: str, text: str | None = None) -> str:
    return f"SELECT {number}::INTEGER AS ord, printf('{text or SENTENCES[number]}', {', '.join(values)}) AS insight FROM ({source})"


def _largest(column: str, where: str = "true") -> str:
    return f"""SELECT {column} AS k, count(recall_number) AS n, {_SUMS['class_i_pct']} AS pct FROM scored WHERE {where}
      GROUP BY {column} ORDER BY n DESC, k NULLS FIRST LIMIT 1"""


_MONTHS = "SELECT date_trunc('month', report_date)::DATE AS month, count(*) AS n FROM scored WHERE report_date IS NOT NULL GROUP BY 1"
_SLOPE = f"""SELECT {r_even('regr_slope(n, x)', 6)} AS slope, count(*) AS months
  FROM (SELECT n, row_number() OVER (ORDER BY month) - 1 AS x FROM ({_MONTHS}))"""
_FIRST_FIRM = f"""SELECT *, {r_even('least(n, 100) * coalesce(mean, 0) / 10.0::DOUBLE', 2)} AS priority FROM (
  SELECT recalling_firm AS k, count(recall_number) AS n, {r_even(MEAN_SCORE, 2)} AS mean FROM scored
  WHERE recalling_firm IS NOT NULL GROUP BY 1) WHERE n >= 3 ORDER BY priority DESC, n DESC, k LIMIT 1"""
INSIGHTS_SQL = on_scored(" UNION ALL ".join([
    _say(1, ["coalesce(k, 'Unclassified')", "format('{:,}', n)", "n * 100.0::DOUBLE / (SELECT count(*) FROM scored)"],
         _largest("classification")),
    _say(2, ["k", "format('{:,}', n)", "pct::VARCHAR"], _largest("product_type")),
    _say(3, ["k", "n", "priority"], _FIRST_FIRM),
    _say(4, ["n"], f"""SELECT count(*) AS n FROM (SELECT 1 FROM scored WHERE recalling_firm IS NOT NULL GROUP BY recalling_firm
         HAVING {class_count('Class I')} >= 2) HAVING n > 0"""),
    _say(5, ["n"], f"""SELECT count(*) AS n FROM (SELECT {r_even('(n - avg(n) OVER ()) / stddev_pop(n) OVER ()', 2)} AS z FROM ({_MONTHS}))
         WHERE abs(z) >= 2 HAVING n > 0"""),
    _say(6, ["slope"], f"SELECT * FROM ({_SLOPE}) WHERE months >= 6 AND slope > 0.5", SENTENCES[6][0]),
    _say(6, ["slope"], f"SELECT * FROM ({_SLOPE}) WHERE months >= 6 AND slope < -0.5", SENTENCES[6][1]),
    _say(7, ["k", "n"], f"SELECT * FROM ({_largest('therapeutic_area', "product_type = 'Drugs'")}) WHERE k <> '{OTHER}'"),
    _say(8, ["n"], "SELECT count(*) AS n FROM scored WHERE risk_tier = 'Critical' HAVING n > 0")]))

ENTRIES = {
    "rpt1_summary": (summary, summary_sql("true")),
    "rpt2_insights": (lambda s, d: full(s, d).insights, INSIGHTS_SQL),
    "rpt3_sections": (sections, SECTIONS_SQL),
    "rpt4_lines": (lambda s, d: report_lines(full(s, d)), None),
    "rpt5_last_year_of_devices": (last_year, summary_sql(
        """product_type = 'Devices' AND coalesce(report_date, recall_initiation_date)
        BETWEEN DATE '1996-06-30' AND DATE '1997-06-30'""")),
}

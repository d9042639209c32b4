"""SQL building blocks of the DuckDB checks: the stand-in view, the category and the score columns."""

from recallspark.functions import rules as R
from checks.standin import RECALL_VIEW_SQL

TABLES = {n: n for n in ("lineitem", "orders", "part", "supplier", "nation")}
VIEW = f"({RECALL_VIEW_SQL.format(**TABLES)})"


def r_even(expr: str, digits: int) -> str:
    return f"(round_even(({expr}) * {10 ** digits}.0::DOUBLE, 0) / {10 ** digits}.0::DOUBLE)"


def any_word(text: str, keywords: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in keywords) + ")"


def match_case(text: str, rules) -> str:
    return "CASE " + " ".join(f"WHEN {any_word(text, k)} THEN '{label}'" for label, k in rules) + " ELSE 'Other' END"


def title_sql(c: str) -> str:
    return (f"list_aggregate(list_transform(regexp_extract_all({c}, '([A-Za-z]+|[^A-Za-z]+)'), "
            f"lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', '')")


REACH = (
    "CASE WHEN distribution_pattern IS NULL THEN 0 "
    f"WHEN {any_word('lower(distribution_pattern)', R.REACH_EVERYWHERE_WORDS)} THEN 50 "
    "ELSE list_unique(regexp_extract_all(distribution_pattern, '\\b[A-Z]{2}\\b')) + "
    + " + ".join(f"contains(lower(distribution_pattern), '{n}')::INT" for n in R.STATE_NAMES) + " END")

QUANTITY = "TRY_CAST(replace(regexp_extract(product_quantity, '[0-9,]+'), ',', '') AS DECIMAL(38,0))"

CATEGORISED = f"""
SELECT *, CASE WHEN product_type = 'Drugs' THEN {match_case('blob', R.THERAPEUTIC_AREAS)} ELSE 'N/A' END AS therapeutic_area,
  CASE product_type WHEN 'Drugs' THEN coalesce({title_sql("nullif(route, '')")}, 'Unspecified Route')
    WHEN 'Devices' THEN {match_case('blob', R.DEVICE_TYPES)}
    WHEN 'Food' THEN {match_case('blob', R.FOOD_TYPES)} ELSE 'Other' END AS product_category,
  CASE WHEN coalesce(reason_for_recall, '') = '' THEN 'Unknown'
    ELSE {match_case('lower(reason_for_recall)', R.RECALL_REASONS)} END AS reason_category,
  CASE classification WHEN 'Class I' THEN 3 WHEN 'Class II' THEN 2 WHEN 'Class III' THEN 1 ELSE 0 END AS severity_rank
FROM (SELECT *, lower(CASE WHEN product_type = 'Drugs' THEN concat_ws(' ', nullif(generic_name, ''), nullif(product_description, ''), nullif(reason_for_recall, ''))
        ELSE concat_ws(' ', nullif(product_description, ''), nullif(reason_for_recall, '')) END) AS blob FROM recalls)
"""

SCORED = f"""
SELECT *, CASE WHEN risk_score >= 70 THEN 'Critical' WHEN risk_score >= 50 THEN 'High'
    WHEN risk_score >= 30 THEN 'Medium' ELSE 'Low' END AS risk_tier
FROM (SELECT *, {r_even('''least(100.0::DOUBLE, greatest(0.0::DOUBLE,
    (CASE classification WHEN 'Class I' THEN 40 WHEN 'Class II' THEN 20 WHEN 'Class III' THEN 8 ELSE 15 END
     + CASE WHEN reach >= 10 THEN 25 WHEN reach >= 2 THEN 15 WHEN reach = 1 THEN 7 ELSE 10 END
     + quantity_points) * status_factor))''', 2)} AS risk_score
  FROM (SELECT *, CASE WHEN quantity > 0 THEN least(20.0::DOUBLE, greatest(0.0::DOUBLE, log10(quantity::DOUBLE) / 6.0::DOUBLE * 20.0::DOUBLE))
            ELSE 0.0::DOUBLE END AS quantity_points,
          CASE status WHEN 'Ongoing' THEN 1.0::DOUBLE WHEN 'On-Going' THEN 1.0::DOUBLE WHEN 'Pending' THEN 0.95::DOUBLE
            WHEN 'Completed' THEN 0.7::DOUBLE WHEN 'Terminated' THEN 0.4::DOUBLE ELSE 0.9::DOUBLE END AS status_factor
    FROM (SELECT *, ({REACH})::INTEGER AS reach, {QUANTITY} AS quantity FROM cat)))
"""


def on_recalls(sql: str) -> str:
    return f"WITH recalls AS {VIEW} {sql}"


def on_categorised(sql: str) -> str:
    return f"WITH recalls AS MATERIALIZED {VIEW}, cat AS ({CATEGORISED}) {sql}"


def on_scored(sql: str) -> str:
    return f"WITH recalls AS MATERIALIZED {VIEW}, cat AS MATERIALIZED ({CATEGORISED}), scored AS MATERIALIZED ({SCORED}) {sql}"


MEAN_SCORE = "(sum(round_even(risk_score * 100, 0)::BIGINT)::DOUBLE / count(risk_score) / 100.0::DOUBLE)"


def class_count(label: str) -> str:
    return f"count(*) FILTER (classification = '{label}')"


def pct(part: str, whole: str) -> str:
    return r_even(f"({part})::DOUBLE / nullif({whole}, 0) * 100.0::DOUBLE", 1)

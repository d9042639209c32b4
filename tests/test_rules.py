"""Categories, quantities, reach, score and date rules on literal values."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from recallspark.functions.dates import parse_page_date, parse_record_date
from recallspark.functions.scoring import risk_score, risk_tier
from recallspark.functions.text import markup_text, parse_quantity, squeeze, state_reach, title_case
from recallspark.operators import categorize as C
from recallspark.operators.normalize import device_class
from recallspark.operators.risk import score, tier_distribution
from recallspark.sources.webpages import infer_product_type, pseudo_id


def apply(spark, rule, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in rows.select("i", rule(F.col("v")).alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize("rule, cases", [
    (C.therapeutic_area, {"GLYBURIDE 5MG": "Diabetes & Endocrine", "Simvastatin": "Cardiovascular", "Naproxen gel": "Pain & Analgesic",
                          "cancer pain relief": "Oncology", "sterile eye drops": "Ophthalmic", "QQQ": "Other", "": "Other", None: "Other"}),
    (C.device_type, {"Implantable defibrillator": "Cardiac Devices", "ECG leads": "Monitoring Equipment",
                     "Rapid assay": "In Vitro Diagnostic", "chair": "Other"}),
    (C.food_type, {"Cheddar cheese": "Dairy", "Raw spinach": "Produce", "Smoked salmon": "Seafood", "rice": "Other"}),
    (C.reason_category, {"Listeria found": "Contamination", "Label mix-up": "Mislabeling", "E. coli O157": "Contamination",
                         "Exe coli": "Other", "Potency too low": "Out of Specification", "": "Unknown", None: "Unknown"}),
    (parse_quantity, {"12,345 units": 12345, "77": 77, "box, 500": None, "": None, "none": None, None: None}),
    (state_reach, {"Nationwide": 50, "nation-wide sales": 50, "INTERNATIONAL": 50, "Sold in CA only": 1, "CA, NY, CA": 2,
                   "in oregon and CA": 2, "CA (california)": 2, "west virginia": 2, "arkansas": 2, "": 0, None: 0}),
    (title_case, {"INTRA-ARTICULAR; oral": "Intra-Articular; Oral", "o'neil 5mg": "O'Neil 5Mg"}),
    (squeeze, {"  a  \t b\n": "a b", None: "", "": ""}),
    (parse_record_date, {"20240229": date(2024, 2, 29), "20230229": None, " 2024-3-7 ": date(2024, 3, 7),
                         "2024-03-07T10:00:00": date(2024, 3, 7), "03/07/2024": None, "": None, None: None}),
    (parse_page_date, {"03/07/2024": date(2024, 3, 7), "March 7, 2024": date(2024, 3, 7), "Mar 7, 2024": date(2024, 3, 7),
                       "2024-03-07": date(2024, 3, 7), "soon": None}),
    (device_class, {"Recall": "Class II", "Class I": "Class I", "Alert": "Alert", "": None}),
    (lambda c: infer_product_type(c, F.lit("")), {"Oral syrup": "Drugs", "Hip stent": "Devices", "Walnut cake": "Food"}),
    (markup_text, {"<p> Fish <b>&amp; chips</b> </p>": "Fish& chips", "<!-- x <b> -->a": "a"}),
])
def test_text_rules(spark, rule, cases):
    assert apply(spark, rule, cases) == list(cases.values())


def test_pseudo_id_is_bounded_and_repeatable(spark):
    rows = spark.createDataFrame([("01/15/2026", "A & B Corp.", "Widget " * 20)] * 2, "d string, c string, p string")
    ids = {r[0] for r in rows.select(pseudo_id(F.col("d"), F.col("c"), F.col("p"))).collect()}
    assert len(ids) == 1 and len(ids.pop()) == 44


def scores(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, c string, d string, q string, s string")
    return [r[0] for r in df.select(risk_score(F.col("c"), state_reach(F.col("d")), F.col("q"), F.col("s")).alias("x"), "i")
            .orderBy("i").collect()]


def test_risk_score(spark):
    top, low, closed, unknown, huge = scores(spark, [
        ("Class I", "Nationwide", "1,000,000 boxes", "Ongoing"), ("Class III", "in CA only", "100", "Terminated"),
        ("Class I", "Nationwide", "1,000,000 boxes", "Terminated"), (None, None, None, None),
        ("Class I", "Nationwide", "9" * 30, "On-Going")])
    assert top == 85.0 and low == round((8 + 7 + 2 / 6 * 20) * 0.4, 2) and closed == 34.0
    assert unknown == 22.5 and huge == 85.0


def test_tiers(spark):
    assert apply(spark, risk_tier, [80.0, 70.0, 69.99, 50.0, 30.0, 29.99, 0.0], "double") == [
        "Critical", "Critical", "High", "High", "Medium", "Low", "Low"]


def test_categorize_frame(spark):
    df = spark.createDataFrame([
        ("1", "Drugs", "Class I", "HEPARIN", "vial", "mold", "INTRA-VENOUS"), ("2", "Drugs", None, None, "plain", "", ""),
        ("3", "Devices", "Class II", "HEPARIN", "infusion pump", "software", None),
        ("4", "Food", "Class III", None, "pasta", None, "ORAL"), ("5", None, "x", None, "milk", "fail", None)],
        "recall_number string, product_type string, classification string, generic_name string, product_description string, "
        "reason_for_recall string, route string")
    got = {r.recall_number: (r.therapeutic_area, r.product_category, r.reason_category, r.severity_rank)
           for r in C.categorize(df).collect()}
    assert got == {"1": ("Cardiovascular", "Intra-Venous", "Contamination", 3), "2": ("Other", "Unspecified Route", "Unknown", 0),
                   "3": ("N/A", "Infusion & Delivery", "Malfunction", 2), "4": ("N/A", "Prepared Meals", "Unknown", 1),
                   "5": ("N/A", "Other", "Malfunction", 0)}
    assert {"severity_rank", "reason_category"} <= set(C.categorize(df.limit(0)).columns)
    totals = {r.product_type: (r.total_recalls, r.class_i_recalls, r.class_i_pct) for r in C.summary_by(df, "product_type").collect()}
    assert totals == {"Drugs": (2, 1, 50.0), "Devices": (1, 0, 0.0), "Food": (1, 0, 0.0), None: (1, 0, 0.0)}


def test_tier_distribution_is_zero_filled(spark):
    df = spark.createDataFrame([("Class I", "Nationwide", "1000000", "Ongoing")],
                               "classification string, distribution_pattern string, product_quantity string, status string")
    rows = [tuple(r) for r in tier_distribution(score(df)).collect()]
    assert rows == [("Critical", 1), ("High", 0), ("Medium", 0), ("Low", 0)]
    assert sum(r["count"] for r in tier_distribution(score(df).limit(0)).collect()) == 0

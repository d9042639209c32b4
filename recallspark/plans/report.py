"""The executive report: one pass over the recalls, then small tables.

Every section is a roll-up of the same scored rows, so the rows are categorised, scored and
aggregated once with grouping sets. Each input row is reduced on the map side for a few fine
groupings together; the groupings of the sections are rolled up from those. What is kept is one row
per firm, category, month and so on. The result is checkpointed in the shared folder and all
sections, insights and lines read that.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from recallspark.functions import rules as R
from recallspark.functions.dates import month_of, season_of, season_order
from recallspark.functions.numbers import percent, round_even
from recallspark.functions.scoring import reach_bucket
from recallspark.operators.categorize import categorize
from recallspark.operators.crosstabs import chi_square_of_cells, pearson_of_cells, unclassified_as_label
from recallspark.operators.ranking import category_priority, manufacturer_priority, pick_firm_column
from recallspark.operators.risk import score
from recallspark.operators.temporal import spikes_of_months, trend_of_months
from recallspark.session import checkpoint
from recallspark.sources.recalls import load_recalls

NO_DATA = "No recall data available."
_DIMENSIONS = ["product_type", "classification", "therapeutic_area", "product_category", "reason_category",
               "firm", "recalling_firm", "month", "risk_tier", "state", "bucket", "reach", "risk_score"]
_SETS = {
    "by_product_type": ["product_type"], "by_classification": ["classification"],
    "by_therapeutic_area": ["product_type", "therapeutic_area"], "by_product_category": ["product_category"],
    "by_reason_category": ["reason_category"], "by_firm": ["firm"], "by_recalling_firm": ["recalling_firm"],
    "by_month": ["product_type", "month"], "by_tier": ["risk_tier"], "by_state": ["product_type", "state"],
    "by_reach": ["classification", "bucket"], "by_reason_and_class": ["reason_category", "classification"],
    "by_reach_and_score": ["reach", "risk_score"],
}
# each row is counted once for each of these; the sets above that lie within one are summed up from it
_FINE = [["product_type", "classification", "therapeutic_area", "product_category", "reason_category"],
         ["product_type", "month", "state"], ["classification", "risk_tier", "bucket", "reach", "risk_score"],
         ["firm"], ["recalling_firm"]]


def _set_id(members: list[str]) -> int:
    """grouping_id() of a set: one bit per dimension, set where the dimension is rolled up."""
    return int("".join("0" if d in members else "1" for d in _DIMENSIONS), 2)


def report_base(recalls: DataFrame, firm: str) -> DataFrame:
    """All groupings of the report, by way of a few fine ones in one aggregate over the scored rows."""
    scored = score(categorize(recalls), keep_reach=True)
    day = F.col("report_date").try_cast("date")
    state = F.col("state") if "state" in recalls.columns else F.lit(None).cast("string")
    rows = scored.select(
        "recall_number", "product_type", "classification", "therapeutic_area", "product_category",
        "reason_category", F.col(firm).alias("firm"), F.col("recalling_firm").alias("recalling_firm"),
        month_of(day).alias("month"), "risk_tier", state.alias("state"),
        reach_bucket(F.col("state_reach")).alias("bucket"), F.col("state_reach").alias("reach"), "risk_score",
        day.alias("_day"), F.rint(F.col("risk_score") * 100).cast("long").alias("_cents"))
    used = _SETS if firm != "recalling_firm" else {k: v for k, v in _SETS.items() if k != "by_recalling_firm"}
    fine = {i: [_set_id(members) for members in used.values() if next(f for f in _FINE if set(members) <= set(f)) is names]
            for i, names in ((_set_id(f), f) for f in _FINE)}
    fine = {i: ids for i, ids in fine.items() if ids}

    def classified(label: str) -> Column:
        return F.count_if(F.col("_class") == label)

    counted = (rows.withColumn("_class", F.col("classification")).withColumn("_score", F.col("risk_score"))
               .groupingSets([[F.col(d) for d in names] for names in _FINE if _set_id(names) in fine], *[F.col(d) for d in _DIMENSIONS])
               .agg(F.grouping_id().alias("_fine"), F.count("recall_number").alias("total_recalls"),
                    F.count("*").alias("rows"), classified("Class I").alias("class_i"),
                    classified("Class II").alias("class_ii"), classified("Class III").alias("class_iii"),
                    F.sum("_cents").alias("cents"), F.max("_score").alias("max_risk_score"),
                    F.min("_day").alias("first_day"), F.max("_day").alias("last_day")))
    into = F
    for i, ids in fine.items():
        into = into.when(F.col("_fine") == i, F.array(*[F.lit(x).cast("long") for x in ids]))
    sets = counted.withColumn("set_id", F.explode(into))
    members = {d: [_set_id(m) for m in used.values() if d in m] for d in _DIMENSIONS}
    keyed = sets.withColumns({d: F.when(F.col("set_id").isin(ids), F.col(d)) for d, ids in members.items()})
    return keyed.groupBy(*_DIMENSIONS, "set_id").agg(
        *[F.sum(c).alias(c) for c in ("total_recalls", "rows", "class_i", "class_ii", "class_iii", "cents")],
        F.max("max_risk_score").alias("max_risk_score"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))


@dataclass
class Report:
    """Summary row, named sections and insight rows; all lazy over the checkpointed base."""

    summary: DataFrame
    sections: dict[str, DataFrame]
    insights: DataFrame
    generated_at: date


def build_report(recalls: DataFrame, as_of: date, top_n_manufacturers: int = 10, top_n_categories: int = 10,
                 firm_column: str | None = None) -> Report:
    """Aggregate the recalls and lay out the report. ``top_n_manufacturers`` limits both rankings,
    as it always has; ``top_n_categories`` is accepted and unused."""
    firm = firm_column or pick_firm_column(recalls) or "recalling_firm"
    base = checkpoint(report_base(recalls, firm))
    top = top_n_manufacturers
    ids = {name: _set_id(members) for name, members in _SETS.items()}

    def part(name: str) -> DataFrame:
        return base.where(F.col("set_id") == ids[name])

    def summed(name: str, column: str) -> DataFrame:
        return part(name).select(column, "total_recalls", F.col("class_i").alias("class_i_recalls"),
                                 percent(F.col("class_i"), F.col("total_recalls")).alias("class_i_pct")
                                 ).orderBy(F.desc("total_recalls"), F.asc(column))

    average = F.try_divide("cents", "rows") / 100.0
    firms = part("by_firm").where(F.col("firm").isNotNull())
    manufacturers = manufacturer_priority(firms.select(
        F.col("firm").alias("manufacturer"), "total_recalls", "class_i", "class_ii", "class_iii",
        average.alias("avg_risk_score"), "max_risk_score"), 3)
    categories = category_priority(part("by_product_category").select(
        "product_category", "total_recalls", "class_i", average.alias("avg_risk_score")))
    offenders = firms.where(F.col("class_i") >= 2).select(
        F.col("firm").alias("manufacturer"), F.col("class_i").alias("class_i_recalls"),
        F.col("rows").alias("total_recalls")).orderBy(F.desc("class_i_recalls"), F.asc("manufacturer"))
    dated = part("by_month").where(F.col("month").isNotNull())
    months = dated.groupBy("month").agg(F.sum("rows").alias("count"))
    typed = dated.where(F.col("product_type").isNotNull())
    tiers = [t for t, _ in R.TIERS]
    tier_row = part("by_tier").agg(*[F.coalesce(F.sum(F.when(F.col("risk_tier") == t, F.col("rows"))),
                                                F.lit(0)).alias(t) for t in tiers])
    stated = part("by_state").where((F.length("state") == 2) & F.col("product_type").isin(*R.PRODUCT_TYPES))

    def spread(df: DataFrame, key: str, column: str, labels: list[str]) -> DataFrame:
        return df.groupBy(key).agg(*[F.coalesce(F.sum(F.when(F.col(column) == v, F.col("rows"))), F.lit(0)).alias(v)
                                     for v in labels], F.sum("rows").alias("total"))

    sections = {
        "by_product_type": summed("by_product_type", "product_type"),
        "by_classification": summed("by_classification", "classification"),
        "by_therapeutic_area": part("by_therapeutic_area").where(F.col("product_type") == "Drugs").select(
            "therapeutic_area", "total_recalls", F.col("class_i").alias("class_i_recalls"),
            percent(F.col("class_i"), F.col("total_recalls")).alias("class_i_pct")
        ).orderBy(F.desc("total_recalls"), F.asc("therapeutic_area")),
        "by_product_category": summed("by_product_category", "product_category"),
        "by_reason_category": summed("by_reason_category", "reason_category"),
        "top_manufacturers": manufacturers.orderBy(
            F.desc("priority_score"), F.desc("total_recalls"), F.asc("manufacturer")).limit(top),
        "repeat_offenders": offenders,
        "top_product_categories": categories.orderBy(
            F.desc("priority_score"), F.desc("total_recalls"), F.asc("product_category")).limit(top),
        "monthly_trend": typed.select("month", "product_type", F.col("rows").alias("count")).orderBy("month", "product_type"),
        "seasonal_profile": typed.groupBy(season_of(F.col("month")).alias("season"), "product_type").agg(
            F.sum("rows").alias("count")).orderBy(season_order(F.col("season")), "product_type"),
        "trend_stats": trend_of_months(months),
        "spikes": spikes_of_months(months),
        "risk_tier_distribution": tier_row.unpivot([], tiers, "risk_tier", "count"),
        "state_distribution": spread(stated, "state", "product_type", R.PRODUCT_TYPES).orderBy(
            F.desc("total"), F.asc("state")),
        "severity_vs_reach": spread(
            part("by_reach").where(F.col("bucket").isNotNull()).withColumn(
                "classification", unclassified_as_label(F.col("classification"))),
            "classification", "bucket", [b for b, _ in R.REACH_BUCKETS]).drop("total").orderBy("classification"),
        "reason_vs_severity_test": chi_square_of_cells(
            part("by_reason_and_class").where(F.col("reason_category").isNotNull() & F.col("classification").isNotNull())
            .select("reason_category", "classification", F.col("rows").alias("n"))),
        "reach_vs_risk_correlation": pearson_of_cells(part("by_reach_and_score").select(
            "reach", F.rint(F.col("risk_score") * 100).cast("long").alias("cents"), "rows")),
    }
    summary = _summary(base, ids["by_firm" if firm == "recalling_firm" else "by_recalling_firm"])
    return Report(summary, sections, _insights(summary, sections), as_of)


def _summary(base: DataFrame, firm_set: int) -> DataFrame:
    """The KPI row: one aggregate over the roll-up rows."""
    of_type = F.col("set_id") == _set_id(_SETS["by_product_type"])
    of_tier = F.col("set_id") == _set_id(_SETS["by_tier"])
    of_firm = F.col("set_id") == firm_set
    named = F.coalesce("firm", "recalling_firm").isNotNull()

    def total(test: Column, measure: str) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col(measure))), F.lit(0))

    row = base.agg(
        total(of_type, "rows").alias("total_recalls"), F.min(F.when(of_type, F.col("first_day"))).alias("_first"),
        F.max(F.when(of_type, F.col("last_day"))).alias("_last"), F.count_if(of_firm & named).alias("unique_firms"),
        total(of_type, "class_i").alias("class_i"), total(of_type, "cents").alias("_cents"),
        total(of_tier & (F.col("risk_tier") == "Critical"), "rows").alias("critical_count"),
        total(of_tier & (F.col("risk_tier") == "High"), "rows").alias("high_count"))
    return row.select(
        "total_recalls", F.coalesce(F.col("_first").cast("string"), F.lit("n/a")).alias("earliest"),
        F.coalesce(F.col("_last").cast("string"), F.lit("n/a")).alias("latest"), "unique_firms", "class_i",
        F.coalesce(percent(F.col("class_i"), F.col("total_recalls")), F.lit(0.0)).alias("class_i_pct"),
        F.coalesce(F.try_divide("_cents", "total_recalls") / 100.0, F.lit(0.0)).alias("avg_risk_score"),
        "critical_count", "high_count")


# ---- insights -----------------------------------------------------------------------

# fixed values: insight sentences (printf patterns), in their order
INSIGHTS = {
    1: "Most common classification is **%s** with %s recalls (%.0f%% of total).",
    2: "**%s** accounts for the largest share with %s recalls (%s%% Class I).",
    3: "Highest-priority manufacturer: **%s** with %d recalls (priority score %.1f).",
    4: "%d firms have **multiple Class I recalls** — these merit closer regulatory attention.",
    5: "Detected **%d month(s)** with anomalously high or low recall counts.",
    6: ("Recall volume is trending **upward** (+%.1f/month).", "Recall volume is trending **downward** (%.1f/month)."),
    7: "Most-recalled drug therapeutic area: **%s** (%d recalls).",
    8: "**%d recalls** scored in the Critical tier (risk score ≥ 70).",
}


def _thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def _insights(summary: DataFrame, sections: dict[str, DataFrame]) -> DataFrame:
    """(ord, insight): each is built from the first row or the count of a small section."""
    def line(df: DataFrame, number: int, *values, text: str | None = None) -> DataFrame:
        return df.select(F.lit(number).alias("ord"), F.format_string(text or INSIGHTS[number], *values).alias("insight"))

    def first(name: str) -> DataFrame:
        return sections[name].limit(1)

    # the share is one of all rows, those without a recall number too
    share = sections["by_classification"].withColumn(
        "_share", F.col("total_recalls") / summary.select("total_recalls").scalar() * 100.0)
    top_class = share.orderBy(F.desc("total_recalls"), F.asc("classification")).limit(1)
    trend, up, down = sections["trend_stats"], F.col("slope") > 0.5, F.col("slope") < -0.5
    lines = [
        line(summary.where(F.col("total_recalls") == 0), 0, text=NO_DATA),
        line(top_class, 1, unclassified_as_label(F.col("classification")), _thousands(F.col("total_recalls")), F.col("_share")),
        line(first("by_product_type"), 2, F.col("product_type"), _thousands(F.col("total_recalls")), F.col("class_i_pct")),
        line(first("top_manufacturers"), 3, F.col("manufacturer"), F.col("total_recalls"), F.col("priority_score")),
        line(sections["repeat_offenders"].agg(F.count("*").alias("n")).where(F.col("n") > 0), 4, F.col("n")),
        line(sections["spikes"].agg(F.count_if("is_spike").alias("n")).where(F.col("n") > 0), 5, F.col("n")),
        line(trend.where((F.col("n_months") >= 6) & up), 6, F.col("slope"), text=INSIGHTS[6][0]),
        line(trend.where((F.col("n_months") >= 6) & down), 6, F.col("slope"), text=INSIGHTS[6][1]),
        line(first("by_therapeutic_area").where(F.col("therapeutic_area") != R.OTHER), 7,
             F.col("therapeutic_area"), F.col("total_recalls")),
        line(sections["risk_tier_distribution"].where((F.col("risk_tier") == "Critical") & (F.col("count") > 0)), 8,
             F.col("count")),
    ]
    return reduce(DataFrame.unionByName, lines).orderBy("ord")


# ---- sections in long form ----------------------------------------------------------


def long_sections(report: Report, names: list[str] | None = None) -> DataFrame:
    """(section, key, metric, value) rows of the sections; text-only columns form the key."""
    def long(name: str, df: DataFrame) -> DataFrame:
        numbers = [c for c, t in df.dtypes if t in ("int", "bigint", "double", "boolean")]
        keys = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns if c not in numbers]
        key = F.concat_ws(" / ", *keys) if keys else F.lit("all")
        values = df.select(key.alias("key"), *[F.col(c).cast("double").alias(c) for c in numbers])
        return values.unpivot("key", numbers, "metric", "value").select(F.lit(name).alias("section"), "key", "metric", "value")

    return reduce(DataFrame.unionByName, [long(n, report.sections[n]) for n in names or report.sections])


# ---- text lines ---------------------------------------------------------------------

# fixed values: headings of the text form and the section under each, with the sort of its rows
_TABLES = [
    ("## Recalls by Classification", "by_classification", ["-total_recalls", "classification"], None),
    ("## Recalls by Product Type", "by_product_type", ["-total_recalls", "product_type"], None),
    ("## Top Therapeutic Areas (Drugs)", "by_therapeutic_area", ["-total_recalls", "therapeutic_area"], 10),
    ("## Top Recall Reasons", "by_reason_category", ["-total_recalls", "reason_category"], 10),
    ("## Top Manufacturers by Priority Score", "top_manufacturers", ["-priority_score", "manufacturer"], None),
    ("## Repeat Class I Offenders", "repeat_offenders", ["-class_i_recalls", "manufacturer"], None),
    ("## Risk Tier Distribution", "risk_tier_distribution", ["tier_order", "risk_tier"], None),
    ("## Seasonal Pattern", "seasonal_profile", ["season_order", "product_type"], None),
]
_HIDDEN_WHEN_EMPTY = {"by_therapeutic_area", "repeat_offenders"}
_LINE = "block int, sort double, tie string, line string"


def report_lines(report: Report, title: str = "Recall Surveillance") -> DataFrame:
    """The report as (block, sort, tie, line); ordered by the first three it reads top to bottom.

    A sort key instead of a running number lets the one table without a row limit (repeat
    offenders) stay spread over many tasks.
    """
    spark = report.summary.sparkSession
    has_data = report.summary.where(F.col("total_recalls") > 0)
    any_data = report.summary.select("total_recalls").scalar() > 0

    def fixed(rows: list[tuple[int, str]]) -> DataFrame:
        return spark.createDataFrame([(b, float(i), "", text) for i, (b, text) in enumerate(rows)], _LINE)

    def said(df: DataFrame, block: int, sort: float, line: Column) -> DataFrame:
        return df.select(F.lit(block).alias("block"), F.lit(sort).alias("sort"), F.lit("").alias("tie"), line.alias("line"))

    def several(df: DataFrame, block: int, rows: list[tuple[float, str | Column]]) -> DataFrame:
        """All the lines of one small frame's row, in one pass over it."""
        told = F.array(*[F.struct(F.lit(sort).alias("sort"), (F.lit(x) if isinstance(x, str) else x).alias("line")) for sort, x in rows])
        return df.select(F.lit(block).alias("block"), F.explode_outer(told).alias("_told")).select(
            "block", "_told.sort", F.lit("").alias("tie"), "_told.line").where(F.col("line").isNotNull())

    def f(pattern: str, *cols: str) -> Column:
        return F.format_string(pattern, *[F.col(c) if isinstance(c, str) else c for c in cols])

    out = [fixed([(0, f"# {title} — Executive Summary"), (0, f"_Generated on {report.generated_at.isoformat()}_"), (0, "")]),
           said(report.summary.where(F.col("total_recalls") == 0), 1, 0.0, F.lit(NO_DATA))]
    metrics = ["## Summary Metrics", "",
               f("- **Total recalls analyzed:** %s", _thousands(F.col("total_recalls"))),
               f("- **Date range:** %s to %s", "earliest", "latest"),
               f("- **Unique manufacturers:** %s", _thousands(F.col("unique_firms"))),
               f("- **Class I recalls:** %d (%s%%)", "class_i", "class_i_pct"),
               f("- **Average risk score:** %.1f / 100", "avg_risk_score"),
               f("- **Critical/High risk recalls:** %d", F.col("critical_count") + F.col("high_count")), "",
               "## Key Insights", ""]
    out.append(several(has_data, 1, [(float(i), m) for i, m in enumerate(metrics)]))
    out.append(report.insights.where(F.col("ord") > 0).select(
        F.lit(2).alias("block"), F.col("ord").cast("double").alias("sort"), F.lit("").alias("tie"),
        F.concat(F.lit("- "), "insight").alias("line")))
    for block, (heading, name, (sort, tie), top) in enumerate(_TABLES, start=3):
        section = report.sections[name]
        shown = section.limit(top) if top else section
        columns = section.columns
        filled = section.limit(1).agg(F.count(F.lit(1))).scalar() > 0
        shape = has_data.where(filled) if name in _HIDDEN_WHEN_EMPTY else has_data
        head = ["", heading, "", F.when(filled, "| " + " | ".join(columns) + " |").otherwise("_No data._"),
                F.when(filled, "| " + " | ".join("---" for _ in columns) + " |")]
        out.append(several(shape, block, [(-1e18 + i * 1e15, h) for i, h in enumerate(head)]))
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in columns]
        orders = {"tier_order": F.array_position(F.array(*[F.lit(t) for t, _ in R.TIERS]), F.col("risk_tier"))
                  if name == "risk_tier_distribution" else None,
                  "season_order": season_order(F.col("season")) if name == "seasonal_profile" else None}
        key = orders[sort] if sort in orders else -F.col(sort[1:])
        out.append(shown.where(any_data).select(
            F.lit(block).alias("block"), key.cast("double").alias("sort"),
            F.coalesce(F.col(tie), F.lit("")).alias("tie"),
            F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line")))
    after = len(_TABLES) + 3
    trend = report.sections["trend_stats"].where(F.col("n_months") >= 3)
    sentence = f("- Over %d months, recalls are **%s** at %.2f recalls/month (mean = %.1f/month).", "n_months",
                 F.when(F.col("slope") > 0, "increasing").otherwise("decreasing"), F.abs("slope"), "mean")
    out.append(several(trend, after, [(float(i), c) for i, c in enumerate(["", "## Temporal Trend", "", sentence])]))
    tested = report.sections["reason_vs_severity_test"].where(F.col("p_value").isNotNull())
    findings = f("- **Reason vs Severity**: χ²=%s, p=%s (%s)", "statistic", "p_value", "interpretation")
    out.append(several(tested, after + 1, [(float(i), c) for i, c in enumerate(["", "## Statistical Findings", "", findings])]))
    related = report.sections["reach_vs_risk_correlation"].where(
        F.col("r").isNotNull() & (tested.agg(F.count(F.lit(1))).scalar() > 0))
    out.append(said(related, after + 1, 9.0, f("- **Distribution reach vs Risk score**: r=%s (n=%d)", "r", "n")))
    return reduce(DataFrame.unionByName, out).orderBy("block", "sort", "tie")


def generate_report(recalls: DataFrame, as_of: date, start: date | None = None, end: date | None = None,
                    product_type: str | None = None) -> Report:
    """The report over a date range, by default the year up to as_of."""
    chosen = load_recalls(recalls, start or as_of - timedelta(days=365), end or as_of, product_type, ordered=False)
    return build_report(chosen, as_of)

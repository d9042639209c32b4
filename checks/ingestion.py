"""Ingest queries: raw records, pages and batches are derived by Spark from the given tables."""

from __future__ import annotations

import tempfile
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.analytics import KEY, KEYS, recall_view
from checks.oracle_parts import any_word, class_count, on_recalls
from recallspark.functions import rules as R
from recallspark.functions.dates import parse_page_date, parse_record_date
from recallspark.functions.text import settled, squeeze
from recallspark.operators.dedupe import dedupe, dedupe_one_source
from recallspark.operators.merge import api_only, change_counts, firm_deltas, merge_firms, merge_recalls, rebuild_firms
from recallspark.operators.normalize import device_class, normalize
from recallspark.operators.validate import batch_counts, quarantine, valid_rows, validate
from recallspark.plans.backfill import Fold, place_records
from recallspark.plans.ingest import COUNTERS, run_errors, sum_runs
from recallspark.schemas import RECORD_COLUMNS
from recallspark.session import checkpoint, scratch_dir
from recallspark.sources.landing import completeness, explode_records, in_date_range, with_results
from checks.standin import RECALL_VIEW_SQL, recall_view as _view, table
from recallspark.sources.store import add_firm_deltas, compact_firms, read_firms, read_table, upsert_recalls, write_table
from recallspark.sources.webpages import infer_product_type, parse_alerts, pseudo_id
from recallspark.sources.windows import backfill_windows, daily_window
from recallspark.streaming.ingest import upsert_stream

AS_OF = date(1998, 1, 1)
NOW = datetime(1998, 1, 1)
LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
LINES = ", ".join(LINE)


# ---- raw records made from the recall stand-in -------------------------------------


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API-shaped JSON: compact or ISO dates, list or scalar nested values, and device records
    with their own field names, some without the first-choice keys."""
    view = _view(spark, sf_dir)
    line = F.col("l_linenumber")
    compact = F.date_format("recall_initiation_date", "yyyyMMdd")
    posted = F.when(line % 2 == 0, F.date_format("report_date", "yyyyMMdd")).otherwise(F.col("report_date").cast("string"))
    shared = [F.col("recalling_firm"), F.concat(F.lit("  "), F.replace("reason_for_recall", F.lit(" "), F.lit(" \t "))).alias("reason_for_recall"),
              F.col("product_quantity"), F.col("distribution_pattern"), F.col("state"), F.col("country"),
              F.when(line == 1, F.lit(7)).alias("voluntary_mandated")]
    nested = F.struct(F.when(F.col("generic_name").isNotNull(), F.array("generic_name", F.lit("B"))).alias("generic_name"),
                      F.col("route").alias("route"))
    plain = F.to_json(F.struct(
        F.col("recall_number"), F.col("l_orderkey").cast("string").alias("event_id"), F.col("classification"), F.col("status"),
        F.col("product_description"), compact.alias("recall_initiation_date"), posted.alias("report_date"),
        nested.alias("openfda"), *shared))
    device = settled(F.to_json(F.struct(
        F.when(line != 2, F.col("recall_number")).alias("res_event_number"),
        F.concat(F.lit("C-"), "recall_number").alias("cfres_id"),
        F.when(F.col("classification") == "Class II", "Recall").otherwise(F.col("classification")).alias("event_type"),
        F.col("status").alias("recall_status"), F.when(line != 3, F.col("product_description")).alias("product_description"),
        F.concat(F.lit("Lot "), F.col("l_partkey").cast("string")).alias("code_info"),
        compact.alias("event_date_initiated"), posted.alias("event_date_posted"),
        F.when(line == 4, compact).alias("event_date_created"), *shared)))
    # one projection for both kinds of record would pass the size that the JIT compiles; settled also keeps the
    # optimiser from carrying the text as a constraint through all that follows
    device_record = F.col("product_type") == "Devices"
    view = view.withColumn("_device", F.when(device_record, device))
    page = settled(F.concat(F.lit('{"meta": {"results": {"total": 1}}, "results": ['),
                            F.when(device_record, F.col("_device")).otherwise(plain), F.lit("]}")))
    return explode_records(with_results(view.select("product_type", F.struct(*LINE).alias("file"), page.alias("text")), F.col("text")))


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(raw_records(spark, sf_dir))


def nrm_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(spark, sf_dir).select("ingest_ord.file.*", *RECORD_COLUMNS, "raw_json", F.array_join("type_errors", ",").alias("type_errors"))


_DEV = "product_type = 'Devices'"
NORMALIZED_SQL = f"""SELECT {LINES},
  CASE WHEN {_DEV} AND l_linenumber = 2 THEN concat('C-', recall_number) ELSE recall_number END AS recall_number,
  CASE WHEN {_DEV} THEN concat('C-', recall_number) ELSE l_orderkey::VARCHAR END AS event_id,
  'openfda_api' AS source, product_type,
  CASE WHEN {_DEV} THEN classification ELSE coalesce(classification, '') END AS classification,
  coalesce(status, '') AS status, recalling_firm, trim(reason_for_recall) AS reason_for_recall,
  CASE WHEN {_DEV} AND l_linenumber = 3 THEN concat('Lot ', l_partkey) ELSE trim(product_description) END AS product_description,
  product_quantity, CASE WHEN {_DEV} THEN concat('Lot ', l_partkey) END AS code_info, distribution_pattern,
  NULL::VARCHAR AS voluntary_mandated, recall_initiation_date,
  CASE WHEN {_DEV} AND l_linenumber = 4 THEN coalesce(report_date, recall_initiation_date) ELSE report_date END AS report_date,
  NULL::DATE AS termination_date, state, country,
  CASE WHEN NOT {_DEV} AND generic_name IS NOT NULL THEN concat(generic_name, ', B') END AS generic_name,
  CASE WHEN NOT {_DEV} THEN route END AS route,
  CASE WHEN l_linenumber = 1 THEN 'voluntary_mandated' ELSE '' END AS type_errors FROM recalls"""


def json_sql(fields: dict[str, str], plain: tuple[str, ...] = ()) -> str:
    """Compact JSON of the fields that are not null; those in ``plain`` are JSON already."""
    parts = [f"""'"{k}":' || {f"({v})" if k in plain else f"to_json(({v})::VARCHAR)::VARCHAR"}""" for k, v in fields.items()]
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


_COMPACT = "strftime(recall_initiation_date, '%Y%m%d')"
_POSTED = "CASE WHEN l_linenumber % 2 = 0 THEN strftime(report_date, '%Y%m%d') ELSE report_date::VARCHAR END"
_SHARED = {"recalling_firm": "recalling_firm", "reason_for_recall": r"'  ' || replace(reason_for_recall, ' ', ' ' || chr(9) || ' ')",
           "product_quantity": "product_quantity", "distribution_pattern": "distribution_pattern", "state": "state", "country": "country",
           "voluntary_mandated": "CASE WHEN l_linenumber = 1 THEN '7' END"}
_PLAIN_JSON = json_sql({
    "recall_number": "recall_number", "event_id": "l_orderkey", "classification": "classification", "status": "status",
    "product_description": "product_description", "recall_initiation_date": _COMPACT, "report_date": _POSTED,
    "openfda": json_sql({"generic_name": """CASE WHEN generic_name IS NOT NULL THEN '[' || to_json(generic_name)::VARCHAR || ',"B"]' END""", "route": "route"},
                        ("generic_name",)), **_SHARED}, ("openfda", "voluntary_mandated"))
_DEVICE_JSON = json_sql({
    "res_event_number": "CASE WHEN l_linenumber <> 2 THEN recall_number END", "cfres_id": "'C-' || recall_number",
    "event_type": "CASE WHEN classification = 'Class II' THEN 'Recall' ELSE classification END", "recall_status": "status",
    "product_description": "CASE WHEN l_linenumber <> 3 THEN product_description END", "code_info": "'Lot ' || l_partkey",
    "event_date_initiated": _COMPACT, "event_date_posted": _POSTED, "event_date_created": f"CASE WHEN l_linenumber = 4 THEN {_COMPACT} END",
    **_SHARED}, ("voluntary_mandated",))
_NULLS = {"initial_firm_notification": "VARCHAR", "center_classification_date": "DATE", **dict.fromkeys(
    ["city", "postal_code", "brand_name", "manufacturer_name", "product_ndc", "substance_name", "application_number"], "VARCHAR")}
#: All record columns and the stored JSON.
WHOLE_SQL = NORMALIZED_SQL.replace(" AS type_errors FROM recalls", f""" AS type_errors,
  CASE WHEN {_DEV} THEN {_DEVICE_JSON} ELSE {_PLAIN_JSON} END AS raw_json, {", ".join(f"NULL::{t} AS {c}" for c, t in _NULLS.items())} FROM recalls""")


def api_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("report_date", "yyyyMMdd")
    records = _view(spark, sf_dir).select("product_type", *LINE, F.try_parse_json(F.to_json(F.struct(
        day.alias("report_date"), day.alias("event_date_posted")))).alias("raw"))
    parts = [in_date_range(records, t, date(1995, 3, 1), date(1996, 2, 29)) for t in R.PRODUCT_TYPES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).drop("raw")


def page_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty pages per endpoint and year were announced, the last four lie past the cap."""
    keyed = _view(spark, sf_dir).select(F.col("product_type").alias("endpoint"),
                                        F.year("recall_initiation_date").alias("window"), (F.col("l_orderkey") % 30).alias("page"))
    totals = keyed.groupBy("endpoint", "window", "page").agg(F.count("*").alias("n_results"))
    whole = totals.groupBy("endpoint", "window").agg(F.sum("n_results").alias("total"))
    sizes = totals.withColumn("n_results", F.when(F.col("page") < 26, F.col("n_results")).otherwise(0).cast("long"))
    return completeness(sizes.join(whole, ["endpoint", "window"]))


# ---- web pages ----------------------------------------------------------------------


def table_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing page in table layout per line item."""
    def td(c):
        return F.concat(F.lit("<td class='x'> "), c, F.lit(" </td>"))

    row = F.concat(F.lit("<tr>"), td(F.coalesce(F.date_format("report_date", "MM/dd/yyyy"), F.lit("-"))),
                   td(F.concat(F.lit('<a href="/alert/'), "recall_number", F.lit('">'), "product_description", F.lit("</a>"))),
                   td(F.concat(F.lit("<b>"), F.coalesce("reason_for_recall", F.lit("")), F.lit("</b>"))),
                   td(F.coalesce("distribution_pattern", F.lit(""))), F.lit("</tr>"))
    html = F.concat(F.lit('<html><main><table class="views cols-4"><thead><tr><th>Date</th></tr></thead><tbody>'), row,
                    F.lit("</tbody></table></main></html>"))
    other = F.replace(F.replace(html, F.lit('"'), F.lit("'")), F.lit("class='x'"), F.lit("class=x"))
    return _view(spark, sf_dir).select(*LINE, F.when(F.col("l_linenumber") % 2 == 0, html).otherwise(other).alias("html"))


def alert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_alerts(table_pages(spark, sf_dir)).drop("raw_html", "position")


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crawled pages with their navigation links turned into alert list rows."""
    html = F.replace(F.replace("html", F.lit("<nav><ul>"), F.lit('<div class="view-content">')), F.lit("<li>"),
                     F.lit('<div class="item views-row"><time>March 5, 2024</time><h3>'))
    return table(spark, sf_dir, "pages").select("page_id", F.replace(html, F.lit("</li>"), F.lit("</h3></div>")).alias("html"))


def alert_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_alerts(list_pages(spark, sf_dir)).drop("raw_html")


def type_case(text: str) -> str:
    return (f"CASE WHEN {any_word(text, R.WEB_DRUG_WORDS)} THEN 'Drugs' "
            f"WHEN {any_word(text, R.WEB_DEVICE_WORDS)} THEN 'Devices' ELSE 'Food' END")


def web_id(text: str) -> str:
    return f"concat('WEB-', substr(regexp_replace({text}, '[^a-zA-Z0-9]', '', 'g'), 1, 40))"


_LINK = r'<li><a href="([^"]*)">(.*?)</a></li>'
ALERT_LIST_SQL = f"""SELECT page_id, position::INTEGER AS position, {web_id("concat('March 5, 2024', 'Unknown', title)")} AS recall_number,
  'fda_website' AS source, {type_case("lower(title)")} AS product_type, 'Unknown' AS recalling_firm, title AS reason_for_recall,
  title AS product_description, DATE '2024-03-05' AS report_date, DATE '2024-03-05' AS recall_initiation_date, detail_url
  FROM (SELECT page_id, unnest(regexp_extract_all(html, '{_LINK}', 1)) AS detail_url,
    trim(unnest(regexp_extract_all(html, '{_LINK}', 2))) AS title,
    unnest(range(len(regexp_extract_all(html, '{_LINK}')))) AS position FROM pages)"""

ALERT_TABLE_SQL = on_recalls(f"""SELECT {LINES},
  {web_id("concat(coalesce(strftime(report_date, '%m/%d/%Y'), '-'), coalesce(distribution_pattern, ''), product_description)")} AS recall_number,
  'fda_website' AS source, {type_case("lower(concat(reason_for_recall, ' ', product_description))")} AS product_type,
  coalesce(distribution_pattern, 'Unknown') AS recalling_firm,
  coalesce(nullif(reason_for_recall, ''), 'See FDA website for details') AS reason_for_recall, product_description,
  report_date, report_date AS recall_initiation_date, concat('/alert/', recall_number) AS detail_url
  FROM recalls""")


def web_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    norm = normalize(parse_alerts(table_pages(spark, sf_dir)), R.SOURCE_WEB)
    json_has = F.get_json_object("raw_json", "$._scrape_html").startswith("<tr>")
    return norm.select(*LINE, "source", "classification", "status", "country", "recalling_firm", "report_date",
                       json_has.alias("markup_kept"))


# ---- scalar rules -------------------------------------------------------------------


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", squeeze(F.col("text")).alias("clean_text"))


_SPACES = (r"[\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+")


def document_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", infer_product_type(text, F.col("source")).alias("product_type"),
        pseudo_id(F.col("lang"), F.col("source"), text).alias("web_id"))


def record_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in many ways, some impossible, and read back."""
    day, n = F.col("o_orderdate"), F.col("o_orderkey") % 8
    text = (F.when(n == 0, F.date_format(day, "yyyyMMdd")).when(n == 1, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
            .when(n == 2, F.date_format(day, "MM/dd/yyyy")).when(n == 3, F.date_format(day, "MMMM d, yyyy"))
            .when(n == 4, F.date_format(day, " MMM d, yyyy ")).when(n == 5, F.concat(F.date_format(day, "yyyy"), F.lit("1399")))
            .when(n == 6, F.lit("n/a")))
    spelled = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("t"))
    return spelled.select("o_orderkey", parse_record_date(F.col("t")).alias("record_date"),
                          parse_page_date(F.col("t")).alias("page_date"))


def device_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.when(F.col("l_linenumber") == 1, "Recall").when(F.col("l_linenumber") == 2, "").otherwise(F.col("classification"))
    return _view(spark, sf_dir).select(*LINE, device_class(word).alias("classification"))


# ---- validation ---------------------------------------------------------------------


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised API records; the first line of an order has a number where text should be."""
    return validate(normalized(spark, sf_dir), AS_OF)


def val_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated(spark, sf_dir).select(
        "ingest_ord.file.*", "recall_number", "classification", "status", "report_date", "recall_initiation_date",
        F.coalesce(F.array_join("validation_errors", "|"), F.lit("")).alias("warnings"),
        F.array_join("errors", "|").alias("errors"), "is_validated")


VALIDATED_SQL = f"""SELECT {LINES}, recall_number, nullif(classification, '') AS classification,
  CASE status WHEN '' THEN NULL WHEN 'On-Going' THEN 'Ongoing' ELSE status END AS status,
  CASE WHEN report_date <= DATE '{AS_OF}' THEN report_date END AS report_date,
  CASE WHEN recall_initiation_date <= DATE '{AS_OF}' THEN recall_initiation_date END AS recall_initiation_date,
  concat_ws('|', CASE WHEN coalesce(product_description, '') = '' THEN 'Missing product_description' END,
    CASE WHEN coalesce(distribution_pattern, '') = '' THEN 'Missing distribution_pattern' END,
    CASE WHEN coalesce(classification, '') = '' THEN 'Missing classification' END,
    CASE WHEN report_date IS NULL AND recall_initiation_date IS NULL THEN 'No date fields present' END) AS warnings,
  concat_ws('|', CASE WHEN reason_for_recall = '' THEN 'required:reason_for_recall' END,
    CASE WHEN l_linenumber = 1 THEN 'type:voluntary_mandated' END) AS errors,
  reason_for_recall <> '' AND l_linenumber <> 1 AS is_validated FROM norm"""


def on_normalized(sql: str) -> str:
    return on_recalls(f", norm AS ({NORMALIZED_SQL}) {sql}")


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long texts as record fields: wrong product types and fields wider than the stored columns."""
    docs = table(spark, sf_dir, "documents")
    fields = {"recall_number": F.col("doc_id").cast("string"), "product_type": F.when(F.col("doc_id") % 5 == 0, F.col("lang")).otherwise("Food"),
              "recalling_firm": F.col("text"), "reason_for_recall": F.when(F.col("lang") == "en", " ").otherwise(F.col("text")),
              "state": F.col("source")}
    rows = docs.select(*[fields.get(c, F.lit(None).cast("date" if c.endswith("_date") else "string")).alias(c) for c in RECORD_COLUMNS])
    failed = validate(rows.withColumn("raw_json", F.lit("{}")), AS_OF)
    return quarantine(failed).select("recall_number", F.array_join("errors", "|").alias("errors"))


# ---- de-duplication and merges ------------------------------------------------------


def rekeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in keyed by order, so that web and API rows share keys."""
    return recall_view(spark, sf_dir).withColumn("recall_number", F.concat(F.lit("O-"), F.col("l_orderkey").cast("string")))


def halves(spark: SparkSession, sf_dir: str):
    """A stored table (first rows by day) and a later batch, both de-duplicated. Both read the stand-in twice, so it is written once."""
    folder = f"{scratch_dir(spark)}/{tempfile.mktemp(prefix='halves-', dir='')}"
    write_table(recall_view(spark, sf_dir).drop(*LINE), folder)  # ``ingest_ord`` has these
    view = spark.read.parquet(folder).withColumns({"raw_json": F.lit("{}"), "validation_errors": F.lit(None).cast("array<string>")})
    late = F.col("recall_initiation_date") >= F.lit(date(1995, 6, 1))
    again = F.col("ingest_ord.l_linenumber").isin(2, 5)
    stored = dedupe_one_source(view.where(~late | again)).withColumns({
        "first_seen_at": F.lit(datetime(1990, 1, 1)), "last_updated_at": F.lit(datetime(1990, 1, 1)),
        "created_at": F.lit(datetime(1990, 1, 1))})
    batch = dedupe_one_source(view.where(late)).withColumns({"status": F.lit("Terminated"), "recalling_firm": F.lit("Changed")})
    return stored, batch


_KEPT = ["source", "product_type", "reason_for_recall", "product_description", "product_quantity", "distribution_pattern",
         "recall_initiation_date", "state", "country", "generic_name", "route"]


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, batch = halves(spark, sf_dir)
    return merge_recalls(stored, batch, NOW).select("recall_number", "status", "classification", "recalling_firm", "report_date", *_KEPT, "is_validated", "raw_json",
                                                    (F.col("first_seen_at") == F.col("last_updated_at")).alias("never_updated"),
                                                    (F.col("first_seen_at") == F.lit(NOW)).alias("is_new"))


_FOLD = """list_reduce(list({o: [l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice], w: source = 'fda_website', d: report_date}
  ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice),
  lambda h, r: CASE WHEN (h.w AND NOT r.w) OR (r.d IS NOT NULL AND h.d IS NOT NULL AND r.d > h.d) THEN r ELSE h END)"""


def one_source_sql(src: str, extra: str = "true") -> str:
    """Rows that win the one-source rule, ranked by a window."""
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY recall_number
      ORDER BY CASE WHEN fd IS NULL THEN 0 ELSE 1 END, CASE WHEN fd IS NOT NULL THEN report_date END DESC NULLS LAST, {LINES}) AS rk
      FROM (SELECT *, first_value(report_date) OVER (PARTITION BY recall_number ORDER BY {LINES}) AS fd
            FROM {src} WHERE recall_number <> '' AND {extra})) WHERE rk = 1)"""


_LATE = "recall_initiation_date >= DATE '1995-06-01'"
_STORED = one_source_sql("recalls", f"(NOT {_LATE} OR l_linenumber IN (2, 5))")
_BATCH = one_source_sql("recalls", _LATE)
_FIRM_SQL = f"""SELECT recalling_firm AS name, NULL::VARCHAR AS city, arg_min(coalesce(state, '-'), [l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice]) AS state,
  'United States' AS country, count(*) AS total_recalls, {class_count('Class I')} AS class_i_count, {class_count('Class II')} AS class_ii_count,
  {class_count('Class III')} AS class_iii_count, min(coalesce(recall_initiation_date, report_date)) AS first_recall_date,
  max(coalesce(recall_initiation_date, report_date)) AS latest_recall_date"""


def firms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Firms of API rows; a missing state reads '-' to compare first-record nulls."""
    return rebuild_firms(api_only(recall_view(spark, sf_dir)), "ingest_ord").withColumn("state", F.coalesce("state", F.lit("-")))


def firms_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = api_only(recall_view(spark, sf_dir))
    early = F.col("recall_initiation_date") < F.lit(date(1995, 6, 1))
    out = merge_firms(rebuild_firms(view.where(early), "ingest_ord"), view.where(~early), "ingest_ord")
    return out.withColumn("state", F.coalesce("state", F.lit("-")))


def firms_by_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two batches as runs of their own, both added again, before and after the deltas are compacted."""
    view, path = checkpoint(api_only(recall_view(spark, sf_dir))), f"{scratch_dir(spark)}/{tempfile.mktemp(prefix='firms-', dir='')}"
    late = F.col("recall_initiation_date") >= F.lit(date(1995, 6, 1))
    early_rows, late_rows = (firm_deltas(view.where(c), "ingest_ord") for c in (~late, late))
    added = [add_firm_deltas(spark, path, rows, run) for rows, run in ((early_rows, "a"), (late_rows, "b"), (late_rows, "b"))]
    compact_firms(spark, path)
    assert [*added, add_firm_deltas(spark, path, early_rows, "a")] == [True, True, False, False]
    return read_firms(spark, path).withColumn("state", F.coalesce("state", F.lit("-")))


# ---- backfill of all windows as one fold -----------------------------------------------

FIRST_DAY, LAST_DAY = date(1992, 1, 1), date(1998, 12, 31)


def backfilled(spark: SparkSession, sf_dir: str) -> tuple[Fold, str]:
    """The raw records of all months folded, and a table that holds the sixth lines already."""
    root = f"{scratch_dir(spark)}/{tempfile.mktemp(prefix='backfill-', dir='')}"
    seed = recall_view(spark, sf_dir).where("l_linenumber = 6").withColumns({"raw_json": F.lit("{}"), "validation_errors": F.lit(None).cast("array<string>")})
    write_table(seed.drop(*LINE), f"{root}/seed")  # the upsert reads it several times
    upsert_recalls(spark, f"{root}/recalls", dedupe_one_source(spark.read.parquet(f"{root}/seed")), datetime(1990, 1, 1))
    records = place_records(raw_records(spark, sf_dir), R.PRODUCT_TYPES, FIRST_DAY, LAST_DAY, AS_OF)
    return Fold(records, f"{root}/work", AS_OF), f"{root}/recalls"


def backfill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold, path = backfilled(spark, sf_dir)
    counts = fold.upsert(path, NOW)
    return spark.createDataFrame([(*key, *[row[c] for c in COUNTERS]) for key, row in counts.items()],
                                 "product_type string, window_month date, " + ", ".join(f"{c} long" for c in COUNTERS))


def backfill_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold, path = backfilled(spark, sf_dir)
    fold.upsert(path, NOW)
    return read_table(spark, path).select(
        "recall_number", "product_type", "classification", "status", "recalling_firm", "reason_for_recall", "report_date",
        (F.col("first_seen_at") == F.lit(NOW)).alias("is_new"), (F.col("last_updated_at") == F.lit(NOW)).alias("is_touched"))


def backfill_undatable(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = backfilled(spark, sf_dir)[0].undatable()
    return rows.groupBy("product_type", "recall_number", F.array_join("errors", ",").alias("errors")).agg(F.count("*").alias("records"))


_UNDATED = "(l_linenumber = 4 AND l_partkey % 5 = 0)"
_TYPE_PLACE = "list_position(['" + "', '".join(R.PRODUCT_TYPES) + "'], product_type)"
BACKFILL_SQL = f""", placed AS (SELECT * REPLACE (CASE WHEN report_date <= DATE '{AS_OF}' THEN report_date END AS report_date),
    date_trunc('month', CASE WHEN NOT {_UNDATED} THEN report_date END)::DATE AS w, reason_for_recall <> '' AND l_linenumber <> 1 AS ok FROM norm
    WHERE {_UNDATED} OR (report_date BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}' AND NOT (year(report_date) = {AS_OF.year} AND month(report_date) > {AS_OF.month}))),
  won AS (SELECT * EXCLUDE (d), row_number() OVER (PARTITION BY recall_number ORDER BY w, {_TYPE_PLACE}) AS nth,
      row_number() OVER (PARTITION BY recall_number ORDER BY w DESC, {_TYPE_PLACE} DESC) AS from_last
    FROM (SELECT *, row_number() OVER (PARTITION BY recall_number, product_type, w ORDER BY CASE WHEN d IS NULL THEN 0 ELSE 1 END,
            CASE WHEN d IS NOT NULL THEN report_date END DESC NULLS LAST, {LINES}) AS rk
          FROM (SELECT *, first_value(report_date) OVER (PARTITION BY recall_number, product_type, w ORDER BY {LINES}) AS d
                FROM placed WHERE ok AND w IS NOT NULL AND recall_number <> '')) WHERE rk = 1),
  seed AS (SELECT * FROM {one_source_sql("recalls", "l_linenumber = 6")})"""
BACKFILL_COUNTS_SQL = BACKFILL_SQL + """ SELECT product_type, w AS window_month, records_fetched, validation_failures, ok_rows - n AS records_skipped,
    new AS records_inserted, n - new AS records_updated FROM (
    SELECT product_type, w, count(*) AS records_fetched, count(*) FILTER (NOT ok) AS validation_failures, count(*) FILTER (ok) AS ok_rows
    FROM placed WHERE w IS NOT NULL GROUP BY 1, 2) LEFT JOIN (
    SELECT product_type, w, count(*) AS n, count(*) FILTER (nth = 1 AND recall_number NOT IN (SELECT recall_number FROM seed)) AS new FROM won GROUP BY 1, 2)
    USING (product_type, w)"""
BACKFILL_TABLE_SQL = BACKFILL_SQL + """ SELECT coalesce(s.recall_number, f.recall_number) AS recall_number, coalesce(s.product_type, f.product_type) AS product_type,
    CASE WHEN l.recall_number IS NULL THEN s.classification ELSE nullif(l.classification, '') END AS classification,
    CASE WHEN l.recall_number IS NULL THEN s.status WHEN l.status = 'On-Going' THEN 'Ongoing' ELSE nullif(l.status, '') END AS status,
    coalesce(s.recalling_firm, f.recalling_firm) AS recalling_firm, coalesce(s.reason_for_recall, f.reason_for_recall) AS reason_for_recall,
    CASE WHEN s.recall_number IS NULL THEN f.report_date ELSE s.report_date END AS report_date,
    s.recall_number IS NULL AS is_new, l.recall_number IS NOT NULL AS is_touched
    FROM seed s FULL JOIN (SELECT * FROM won WHERE nth = 1) f ON s.recall_number = f.recall_number
    LEFT JOIN (SELECT * FROM won WHERE from_last = 1) l ON l.recall_number = f.recall_number"""
BACKFILL_UNDATABLE_SQL = BACKFILL_SQL + """ SELECT product_type, recall_number, 'undatable' AS errors, count(*) AS records
    FROM placed WHERE w IS NULL GROUP BY 1, 2"""


def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows summed to run totals."""
    return sum_runs(run_rows(spark, sf_dir))


def run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.col("user_id").alias("records_fetched"), F.col("user_id").alias("records_inserted"),
                         F.lit(0).cast("long").alias("records_updated"), F.lit(1).cast("long").alias("records_skipped"),
                         F.get_json_object("props", "$.k").cast("long").alias("validation_failures"),
                         F.when(F.col("event_type") == "error", F.col("props")).alias("error"))


def counts_after_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows of the batch that the de-duplication skips, per product type."""
    valid = valid_rows(validated(spark, sf_dir)).select("recall_number", "product_type", "source", "report_date", "ingest_ord")
    valid = checkpoint(valid)
    kept = dedupe_one_source(valid).groupBy("product_type").agg(F.count("*").alias("kept"))
    return (valid.groupBy("product_type").agg(F.count("*").alias("valid")).join(kept, "product_type")
            .withColumn("records_skipped", F.col("valid") - F.col("kept")))


def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items read as a stream of files and upserted into a recall table."""
    root = f"{scratch_dir(spark)}/{tempfile.mktemp(prefix='stream-', dir='')}"
    schema = table(spark, sf_dir, "lineitem").schema
    # as a pattern the name is that of a file or of a folder of files
    lines = spark.readStream.schema(schema).parquet(f"{sf_dir}/lineitem.parque[t]")

    def prepare(batch: DataFrame) -> DataFrame:
        others = {n: table(batch.sparkSession, sf_dir, n) for n in ("orders", "part", "supplier", "nation")}
        shaped = batch.sparkSession.sql(RECALL_VIEW_SQL, lineitem=batch, **others)
        missing = [c for c in RECORD_COLUMNS if c not in shaped.columns]
        return shaped.withColumns({**{c: F.lit(None).cast("date" if c.endswith("_date") else "string") for c in missing},
                                   "raw_json": F.lit("{}"), "ingest_ord": F.struct(*LINE)})

    upsert_stream(lines, f"{root}/recalls", f"{root}/checkpoint", prepare, AS_OF, NOW).awaitTermination()
    return read_table(spark, f"{root}/recalls").select("recall_number", "source", "product_type", "classification", "status",
                                                       "recalling_firm", "report_date")


def order_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill windows from the first to the last order year, and the orders in each."""
    orders = table(spark, sf_dir, "orders")
    windows = backfill_windows(spark, date(1998, 4, 15), 1992, 1998).select("year", "month", "product_type", "date_from", "date_to")
    per_month = orders.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(F.count("*").alias("n_orders"))
    return windows.join(per_month, ["year", "month"], "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = daily_window(date(1996, 3, 8))
    return (table(spark, sf_dir, "orders").where(F.col("o_orderdate").cast("date").between(start, end))
            .groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("n_orders")))


FIRMS_MERGED_SQL = on_recalls(f""",
        o AS ({_FIRM_SQL} FROM recalls WHERE source <> 'fda_website' AND recall_initiation_date < DATE '1995-06-01' GROUP BY 1),
        n AS ({_FIRM_SQL} FROM recalls WHERE source <> 'fda_website' AND NOT recall_initiation_date < DATE '1995-06-01' GROUP BY 1)
        SELECT coalesce(o.name, n.name) AS name, NULL::VARCHAR AS city, coalesce(o.state, n.state) AS state,
        'United States' AS country, coalesce(o.total_recalls, 0) + coalesce(n.total_recalls, 0) AS total_recalls,
        coalesce(o.class_i_count, 0) + coalesce(n.class_i_count, 0) AS class_i_count,
        coalesce(o.class_ii_count, 0) + coalesce(n.class_ii_count, 0) AS class_ii_count,
        coalesce(o.class_iii_count, 0) + coalesce(n.class_iii_count, 0) AS class_iii_count,
        coalesce(o.first_recall_date, n.first_recall_date) AS first_recall_date,
        CASE WHEN n.name IS NOT NULL THEN n.latest_recall_date ELSE o.latest_recall_date END AS latest_recall_date
        FROM o FULL OUTER JOIN n ON o.name = n.name""")

ENTRIES = {
    "src4_api_date_range": (api_window, on_recalls(
        f"SELECT product_type, {LINES} FROM recalls WHERE report_date BETWEEN DATE '1995-03-01' AND DATE '1996-02-29'")),
    "src5_completeness": (page_completeness, on_recalls(
        """SELECT *, total - returned AS missing, total > returned AS is_truncated FROM (
        SELECT product_type AS endpoint, year(recall_initiation_date)::INTEGER AS "window",
        count(*) FILTER (l_orderkey % 30 < 26) AS returned, count(*) AS total FROM recalls GROUP BY ALL)""")),
    "src6_alert_table": (alert_table, ALERT_TABLE_SQL),
    "src7_alert_list": (alert_list, ALERT_LIST_SQL),
    "src8_backfill_windows": (order_windows, """
        SELECT year(m)::INTEGER AS year, month(m)::INTEGER AS month, product_type, strftime(m, '%Y%m%d') AS date_from,
        strftime(m + INTERVAL 1 MONTH - INTERVAL 1 DAY, '%Y%m%d') AS date_to,
        (SELECT count(*) FROM orders WHERE date_trunc('month', o_orderdate)::DATE = m::DATE) AS n_orders
        FROM (SELECT unnest(generate_series(DATE '1992-01-01', DATE '1998-04-01', INTERVAL 1 MONTH)) AS m)
        CROSS JOIN (SELECT unnest(['Drugs', 'Devices', 'Food']) AS product_type)"""),
    "src8_backfill_run": (backfill_counts, on_normalized(BACKFILL_COUNTS_SQL)),
    "src8_backfill_table": (backfill_table, on_normalized(BACKFILL_TABLE_SQL)),
    "src4_undatable": (backfill_undatable, on_normalized(BACKFILL_UNDATABLE_SQL)),
    "src9_daily_window": (daily_orders, """SELECT o_orderdate::DATE AS day, count(*) AS n_orders FROM orders
        WHERE o_orderdate::DATE BETWEEN DATE '1996-03-01' AND DATE '1996-03-08' GROUP BY 1"""),
    "nrm1_normalize_records": (nrm_records, on_recalls(WHOLE_SQL)),
    "nrm5_normalize_alerts": (web_records, on_recalls(
        f"""SELECT {LINES}, 'fda_website' AS source, NULL::VARCHAR AS classification, 'Ongoing' AS status,
        'United States' AS country, coalesce(distribution_pattern, 'Unknown') AS recalling_firm, report_date, true AS markup_kept
        FROM recalls""")),
    "nrm6_dates": (record_dates, """
        SELECT o_orderkey, CASE WHEN o_orderkey % 8 IN (0, 1) THEN o_orderdate::DATE END AS record_date,
        CASE WHEN o_orderkey % 8 IN (2, 3, 4) THEN o_orderdate::DATE END AS page_date FROM orders"""),
    "nrm8_clean_text": (clean_documents, f"SELECT doc_id, trim(regexp_replace(text, '{_SPACES}', ' ', 'g')) AS clean_text FROM documents"),
    "nrm9_device_class": (device_classes, on_recalls(
        f"""SELECT {LINES}, CASE l_linenumber WHEN 1 THEN 'Class II' WHEN 2 THEN NULL ELSE classification END AS classification FROM recalls""")),
    "nrm11_types_of_documents": (document_types, f"""
        SELECT doc_id, {type_case("lower(concat(text, ' ', source))")} AS product_type, {web_id("concat(lang, source, text)")} AS web_id FROM documents"""),
    "val1_validate": (val_rows, on_normalized(VALIDATED_SQL)),
    "val7_quarantine": (document_records, """
        SELECT * FROM (SELECT doc_id::VARCHAR AS recall_number, concat_ws('|', CASE WHEN lang = 'en' THEN 'required:reason_for_recall' END,
          CASE WHEN doc_id % 5 = 0 THEN 'product_type' END,
          CASE WHEN doc_id % 5 = 0 AND length(lang) > 20 THEN 'too_long:product_type' END,
          CASE WHEN length(regexp_replace(text, '^[\\s]+|[\\s]+$', '', 'g')) > 500 THEN 'too_long:recalling_firm' END,
          CASE WHEN length(source) > 10 THEN 'too_long:state' END) AS errors FROM documents) WHERE errors <> ''"""),
    "val9_batch_counts": (lambda s, d: batch_counts(validated(s, d)), on_normalized(
        f"""SELECT count(*) FILTER (is_validated) AS valid, count(*) FILTER (NOT is_validated) AS failed,
        sum(CASE WHEN is_validated AND warnings <> '' THEN len(string_split(warnings, '|')) ELSE 0 END)::BIGINT AS warning_count
        FROM ({VALIDATED_SQL})""")),
    "ded1_ordered_fold": (lambda s, d: dedupe(rekeyed(s, d)).select(*KEYS), on_recalls(
        f"""SELECT concat('O-', l_orderkey) AS recall_number, l_partkey, l_suppkey, l_extendedprice FROM recalls
        JOIN (SELECT ({_FOLD}).o AS o FROM recalls GROUP BY l_orderkey)
          ON o = [l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice]""")),
    "ded2_one_source": (lambda s, d: dedupe_one_source(recall_view(s, d)).select(*KEYS), on_recalls(
        f"SELECT {KEY} FROM {one_source_sql('recalls')}")),
    "ded3_skipped": (counts_after_dedupe, on_normalized(
        f""", ok AS (SELECT * REPLACE (CASE WHEN report_date <= DATE '{AS_OF}' THEN report_date END AS report_date)
            FROM norm WHERE reason_for_recall <> '' AND l_linenumber <> 1)
        SELECT *, valid - kept AS records_skipped FROM (SELECT product_type, count(*) AS valid FROM ok GROUP BY 1)
        JOIN (SELECT product_type, count(*) AS kept FROM {one_source_sql('ok')} GROUP BY 1) USING (product_type)""")),
    "ing1_merge_recalls": (merged, on_recalls(
        f"""SELECT coalesce(o.recall_number, n.recall_number) AS recall_number,
        CASE WHEN n.recall_number IS NOT NULL THEN 'Terminated' ELSE o.status END AS status,
        CASE WHEN n.recall_number IS NOT NULL THEN n.classification ELSE o.classification END AS classification,
        CASE WHEN o.recall_number IS NOT NULL THEN o.recalling_firm ELSE 'Changed' END AS recalling_firm,
        CASE WHEN o.recall_number IS NOT NULL THEN o.report_date ELSE n.report_date END AS report_date,
        o.recall_number IS NULL OR n.recall_number IS NULL AS never_updated, o.recall_number IS NULL AS is_new, '{{}}' AS raw_json,
        CASE WHEN n.recall_number IS NOT NULL THEN n.is_validated ELSE o.is_validated END AS is_validated,
        {", ".join(f"CASE WHEN o.recall_number IS NOT NULL THEN o.{c} ELSE n.{c} END AS {c}" for c in _KEPT)}
        FROM {_STORED} o FULL OUTER JOIN {_BATCH} n ON o.recall_number = n.recall_number""")),
    "ing2_change_counts": (lambda s, d: change_counts(*halves(s, d)), on_recalls(
        f"""SELECT count(*) FILTER (o.recall_number IS NULL) AS records_inserted, count(o.recall_number) AS records_updated
        FROM {_BATCH} n LEFT JOIN {_STORED} o ON o.recall_number = n.recall_number""")),
    "ing3_merge_firms": (firms_merged, FIRMS_MERGED_SQL),
    "ing3_firm_deltas": (firms_by_delta, FIRMS_MERGED_SQL),
    "ing5_rebuild_firms": (firms, on_recalls(f"{_FIRM_SQL} FROM recalls WHERE source <> 'fda_website' GROUP BY 1")),
    "ing6_run_totals": (run_counters, """
        SELECT sum(user_id)::BIGINT AS records_fetched, sum(user_id)::BIGINT AS records_inserted, 0::BIGINT AS records_updated,
        count(*) AS records_skipped, sum((props->>'$.k')::BIGINT)::BIGINT AS validation_failures,
        count(props) FILTER (event_type = 'error') AS n_errors FROM events"""),
    "ing6_run_errors": (lambda s, d: run_errors(run_rows(s, d), "event_id"),
                        "SELECT event_id, props AS error FROM events WHERE event_type = 'error' AND props IS NOT NULL"),
    "ing8_stream_upsert": (streamed, on_recalls(f""", valid AS (SELECT * EXCLUDE (report_date, status, recall_initiation_date),
        CASE WHEN report_date <= DATE '{AS_OF}' THEN report_date END AS report_date,
        CASE status WHEN 'On-Going' THEN 'Ongoing' ELSE status END AS status FROM recalls WHERE reason_for_recall <> '')
        SELECT recall_number, source, product_type, classification, status, recalling_firm, report_date
        FROM {one_source_sql('valid')}""")),
}

"""Column lists and types of the stored tables."""

from pyspark.sql import types as T

_DATES = {"recall_initiation_date", "report_date", "center_classification_date", "termination_date"}

# fixed values: the record columns, in order
RECORD_COLUMNS = [
    "recall_number", "event_id", "source", "product_type", "classification", "status",
    "recalling_firm", "reason_for_recall", "product_description", "product_quantity", "code_info",
    "distribution_pattern", "voluntary_mandated", "initial_firm_notification",
    "recall_initiation_date", "report_date", "center_classification_date", "termination_date",
    "city", "state", "country", "postal_code", "brand_name", "generic_name", "manufacturer_name",
    "product_ndc", "substance_name", "route", "application_number",
]
RECORD_DATES = [c for c in RECORD_COLUMNS if c in _DATES]
RECORD_TEXTS = [c for c in RECORD_COLUMNS if c not in _DATES]
NESTED_COLUMNS = RECORD_COLUMNS[-7:]

# fixed values: the columns of the analytics scan
ANALYTICS_COLUMNS = [
    "id", "recall_number", "source", "product_type", "classification", "status", "recalling_firm",
    "reason_for_recall", "product_description", "product_quantity", "distribution_pattern",
    "voluntary_mandated", "recall_initiation_date", "report_date", "termination_date", "city", "state",
    "country", "brand_name", "generic_name", "manufacturer_name", "substance_name", "route",
]

# fixed values: columns an upsert of a known recall overwrites
UPDATED_COLUMNS = ["status", "classification", "termination_date", "raw_json", "is_validated",
                   "validation_errors"]

# fixed values: firm table columns
FIRM_COLUMNS = ["name", "city", "state", "country", "total_recalls", "class_i_count", "class_ii_count",
                "class_iii_count", "first_recall_date", "latest_recall_date"]
FIRM_SCAN_COLUMNS = ["name", "total_recalls", "class_i_count", "class_ii_count", "class_iii_count",
                     "first_recall_date", "latest_recall_date"]


def record_type(name: str) -> T.DataType:
    return T.DateType() if name in _DATES else T.StringType()


RECALLS = T.StructType(
    [T.StructField(c, record_type(c)) for c in RECORD_COLUMNS]
    + [T.StructField("raw_json", T.StringType()),
       T.StructField("is_validated", T.BooleanType()),
       T.StructField("validation_errors", T.ArrayType(T.StringType())),
       T.StructField("first_seen_at", T.TimestampType()),
       T.StructField("last_updated_at", T.TimestampType()),
       T.StructField("created_at", T.TimestampType())])

FIRMS = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()), T.StructField("country", T.StringType()),
    T.StructField("total_recalls", T.LongType()), T.StructField("class_i_count", T.LongType()),
    T.StructField("class_ii_count", T.LongType()), T.StructField("class_iii_count", T.LongType()),
    T.StructField("first_recall_date", T.DateType()), T.StructField("latest_recall_date", T.DateType())])

RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("run_type", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("endpoint", T.StringType()),
    T.StructField("date_range_start", T.DateType()), T.StructField("date_range_end", T.DateType()),
    T.StructField("started_at", T.TimestampType()), T.StructField("finished_at", T.TimestampType()),
    T.StructField("records_fetched", T.LongType()), T.StructField("records_inserted", T.LongType()),
    T.StructField("records_updated", T.LongType()), T.StructField("records_skipped", T.LongType()),
    T.StructField("validation_failures", T.LongType()), T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("duration_seconds", T.DecimalType(10, 2))])

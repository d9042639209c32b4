"""Recall-shaped stand-ins over the star-schema test tables.

The joins carry no broadcast hint: part, supplier and orders all grow with the data, so Spark
picks a broadcast only where the size it measured is under its threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

RECALL_VIEW_SQL = """
SELECT
  concat('R-', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS recall_number,
  CASE WHEN l_linenumber = 7 THEN 'fda_website' ELSE 'openfda_api' END AS source,
  CASE p_size % 3 WHEN 0 THEN 'Drugs' WHEN 1 THEN 'Devices' ELSE 'Food' END AS product_type,
  CASE WHEN l_linenumber = 6 THEN NULL WHEN l_returnflag = 'R' THEN 'Class I'
       WHEN l_returnflag = 'A' THEN 'Class II' ELSE 'Class III' END AS classification,
  CASE WHEN l_linenumber = 5 THEN 'On-Going' WHEN l_partkey % 10 = 0 THEN 'Completed'
       WHEN l_partkey % 10 = 1 THEN NULL WHEN l_linestatus = 'O' THEN 'Ongoing' ELSE 'Terminated' END AS status,
  s_name AS recalling_firm,
  CASE l_partkey % 11
    WHEN 0 THEN 'Salmonella contamination detected' WHEN 1 THEN 'Undeclared allergen: milk'
    WHEN 2 THEN 'Failed dissolution specifications' WHEN 3 THEN 'Device malfunction may cause injury'
    WHEN 4 THEN 'Packaging issue: leaking seal' WHEN 5 THEN 'Risk of non-sterility'
    WHEN 6 THEN 'E. coli O157:H7' WHEN 7 THEN 'Software error' WHEN 8 THEN 'Incorrect dose printed'
    WHEN 9 THEN '' ELSE 'Reason not stated' END AS reason_for_recall,
  concat(CASE l_suppkey % 9
    WHEN 0 THEN 'Cardiac pacemaker lead' WHEN 1 THEN 'Infusion pump' WHEN 2 THEN 'Knee prosthesis'
    WHEN 3 THEN 'Yogurt 32oz' WHEN 4 THEN 'Ground beef' WHEN 5 THEN 'Romaine lettuce'
    WHEN 6 THEN 'Metformin tablets' WHEN 7 THEN 'Ibuprofen 200mg' ELSE 'Item' END, ' ', p_name) AS product_description,
  CASE l_partkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'bottles, 500' WHEN 2 THEN 'unknown quantity'
    ELSE concat(CAST(CAST(l_quantity AS BIGINT) AS STRING), ',000 units') END AS product_quantity,
  CASE (l_partkey + l_suppkey) % 8
    WHEN 0 THEN 'Nationwide' WHEN 1 THEN 'CA, NY, TX, FL' WHEN 2 THEN 'MA, CT, RI' WHEN 3 THEN 'Only CA'
    WHEN 4 THEN 'Worldwide distribution' WHEN 5 THEN 'Distributed in california and west virginia'
    WHEN 6 THEN NULL ELSE 'AL, AZ, CA, CO, FL, GA, IL, IN, MI, NY, OH, TX' END AS distribution_pattern,
  CAST(o_orderdate AS DATE) AS recall_initiation_date,
  CASE WHEN l_linenumber = 4 AND l_partkey % 5 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS report_date,
  CASE n_nationkey % 6 WHEN 0 THEN 'CA' WHEN 1 THEN 'NY' WHEN 2 THEN 'TX' WHEN 3 THEN 'FL'
    WHEN 4 THEN 'N/A' ELSE NULL END AS state,
  'United States' AS country,
  CASE WHEN p_size % 3 = 0 THEN CASE l_partkey % 7 WHEN 0 THEN 'LISINOPRIL' WHEN 1 THEN 'AMOXICILLIN'
    WHEN 2 THEN 'INSULIN GLARGINE' WHEN 3 THEN 'METHOTREXATE' WHEN 4 THEN '' WHEN 5 THEN NULL ELSE 'COMPOUND XYZ' END END AS generic_name,
  CASE WHEN p_size % 3 = 0 THEN CASE l_partkey % 4 WHEN 0 THEN 'ORAL' WHEN 1 THEN 'INTRA-ARTICULAR, ORAL'
    WHEN 2 THEN NULL ELSE '' END END AS route,
  l_linenumber <> 3 AS is_validated,
  l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
FROM {lineitem}
JOIN {orders} ON l_orderkey = o_orderkey
JOIN {part} ON l_partkey = p_partkey
JOIN {supplier} ON l_suppkey = s_suppkey
JOIN {nation} ON s_nationkey = n_nationkey
"""

# total order of arrival of the stand-in rows
ARRIVAL = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
_ABSENT = ["brand_name", "substance_name", "manufacturer_name", "voluntary_mandated", "city", "code_info"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def recall_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recalls derived from line items, with the columns the tables lack as typed nulls."""
    names = ("lineitem", "orders", "part", "supplier", "nation")
    tables = {n: table(spark, sf_dir, n) for n in names}
    view = spark.sql(RECALL_VIEW_SQL, **tables)
    return view.withColumns({**{c: F.lit(None).cast("string") for c in _ABSENT},
                             "termination_date": F.lit(None).cast("date"),
                             "ingest_ord": F.struct(*ARRIVAL)})


def run_log_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingestion-run log rows derived from events."""
    failed = F.col("event_type") == "error"
    number = F.get_json_object("props", "$.k").try_cast("long")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        F.lit("daily").alias("run_type"),
        F.lit("openfda_api").alias("source"),
        F.col("event_type").alias("endpoint"),
        F.col("ts").alias("started_at"),
        F.col("user_id").alias("records_fetched"),
        number.alias("validation_failures"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, F.concat(F.lit("code "), number.cast("string"))).alias("error_message"),
        F.col("value").alias("duration_seconds"))

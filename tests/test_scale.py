"""What is computed once a row or moved once: seen in the plans, with the results beside them."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from recallspark.functions import rules as R
from recallspark.functions.dates import parse_page_date, parse_record_date
from checks.ingestion import streamed
from recallspark.functions.text import first_match, markup_text, state_reach, strip, strip_column
from recallspark.operators import dedupe as D
from recallspark.operators.marks import ROW, mark_rows, numbered, with_marks
from recallspark.operators.merge import merge_recalls
from recallspark.operators.normalize import normalize
from recallspark.operators.validate import validate
from recallspark.plans.backfill import Fold, place_records
from recallspark.plans.report import report_base
from recallspark.sources.landing import explode_records, in_date_range, undatable, with_results
from recallspark.schemas import RECORD_COLUMNS, record_type
from recallspark.sources import store
from recallspark.sources.store import read_table
from recallspark.sources.webpages import infer_product_type, parse_alerts
from recallspark.streaming import ingest as stream

FIRST, LAST, AS_OF = date(2024, 1, 1), date(2024, 12, 31), date(2025, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def filters(df) -> list[str]:
    return [line for line in plan(df).split("\n") if re.match(r"[\s:+\-*()0-9]*Filter ", line)]


@pytest.fixture
def pages(spark):
    rows = [("Food", "a", '{"results": [{"recall_number": "F-1", "report_date": "20240229"}, {"recall_number": "F-2", "report_date": " 2024-3-7 "}]}'),
            ("Devices", "b", '{"results": [{"res_event_number": "Z-1", "event_date_posted": "2023-12-31", "city": 7}, {"event_date_posted": "soon"}]}'),
            ("Drugs", "c", '{"results": []}'), ("Drugs", "d", '{"results": null}'), ("Drugs", "e", "{broken"), ("Drugs", "f", None)]
    kept = spark.createDataFrame(rows, "product_type string, file string, text string").repartition(1).rdd.toDF(
        "product_type string, file string, text string")
    return with_results(kept, F.col("text"))


def test_a_page_is_parsed_once(pages):
    records = explode_records(pages)
    assert plan(records).count("from_json") == 1
    assert [tuple(r) for r in records.select("ingest_ord.file", "ingest_ord._pos").orderBy("file", "_pos").collect()] == [
        ("a", 0), ("a", 1), ("b", 0), ("b", 1)]


def test_a_filter_day_is_read_once(pages):
    records = explode_records(pages)
    placed = place_records(records, R.PRODUCT_TYPES, FIRST, LAST, AS_OF)
    for df in (placed, in_date_range(records, "Food", FIRST, LAST), undatable(records)):
        assert not any("variant_get" in f or "RLIKE" in f for f in filters(df))
    assert sorted((r.product_type, r.window_month) for r in placed.collect() if r.window_month) == [("Food", date(2024, 2, 1)), ("Food", date(2024, 3, 1))]
    assert [r.product_type for r in placed.where("window IS NULL").collect()] == ["Devices"]
    assert in_date_range(records, "Food", FIRST, date(2024, 2, 29)).count() == 1
    assert [tuple(r) for r in undatable(records).collect()] == [("Devices", 1)]


def test_only_odd_records_become_variants(pages):
    assert all("CASE WHEN" in line for line in plan(normalize(explode_records(pages)).select("recall_number")).split("\n") if "parseJson" in line)
    found = {r.recall_number: r for r in normalize(explode_records(pages)).collect()}
    assert found["Z-1"].type_errors == ["city"] and found["F-2"].report_date == date(2024, 3, 7)


def test_a_searched_text_is_made_once(spark):
    rows = spark.createDataFrame([("Cheddar CHEESE",), ("nothing",), (None,)], "t string").repartition(1)
    t = F.col("t")
    for made, want in ((first_match(F.lower(t), R.FOOD_TYPES), ["Dairy", R.OTHER, R.OTHER]),
                       (infer_product_type(t, F.lit("RX")), ["Drugs"] * 3), (state_reach(t), [0, 0, 0])):
        df = rows.select(made.alias("x"))
        assert df._jdf.queryExecution().optimizedPlan().toString().count("lower(") == 1
        assert [r.x for r in df.collect()] == want


@pytest.mark.parametrize("text, day", [
    ("20240229", date(2024, 2, 29)), ("20240229\n", date(2024, 2, 29)), (" 20240229 ", date(2024, 2, 29)), ("20230229", None),
    ("2024-02-29", date(2024, 2, 29)), ("2024-2-9T00:00", None), ("2024-02-09T00:00", date(2024, 2, 9)), ("00001231", None), ("0000-12-31", None),
    ("٢٠240229", None), ("", None), (None, None)])
def test_record_dates(spark, text, day):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_record_date(F.col("t"))).first()[0] == day


@pytest.mark.parametrize("text, day", [("3/5/2024", date(2024, 3, 5)), (" March 5, 2024\n", date(2024, 3, 5)), ("Mar 5, 2024", date(2024, 3, 5)),
                                       ("2024-3-5", date(2024, 3, 5)), ("-", None), ("a/b", None), (None, None)])
def test_page_dates(spark, text, day):
    assert spark.createDataFrame([(text,)], "t string").select(parse_page_date(F.col("t"))).first()[0] == day


@pytest.mark.parametrize("markup, text", [("a <b>c</b> <i>d", "acd"), (" a  <!-- <b> --> é ", "a   é".replace(" ", " ")),
                                          ("a &amp;lt; b", "a &lt; b"), ("plain\ttext ", "plain\ttext"), ("a > b < c", "a > b < c"), (None, None)])
def test_markup_text(spark, markup, text):
    assert spark.createDataFrame([(markup,)], "t string").select(markup_text(F.col("t"))).first()[0] == text


def test_rows_of_a_page_are_cut_once(spark):
    table = "<table class='cols-4'><tbody><tr><td>3/5/2024</td><td><a href='/x'>Milk</a></td><td>Glass</td><td>Firm</td></tr></tbody></table>"
    listing = '<div class="view-content"><li class="views-row"><h3><a href="/y">Pump</a></h3></li></div>'
    pages = spark.createDataFrame([(1, table), (2, listing), (3, ""), (4, None)], "page_id int, html string").repartition(1)
    alerts = parse_alerts(pages)
    assert not any("regexp_extract" in f for f in filters(alerts))
    assert [(r.page_id, r.product_description, r.recalling_firm, r.detail_url) for r in alerts.orderBy("page_id").collect()] == [
        (1, "Milk", "Firm", "/x"), (2, "Pump", "Unknown", "/y")]


def _records(spark):
    days = [date(2024, 1, 1), None, date(2024, 3, 1)]
    rows = [(f"K{i % 7}" if i % 11 else None, "openfda_api", days[i % 3], i // 2, f"r{i}") for i in range(60)]
    rows += [("alone", "openfda_api", None, 99, "x"), ("alone", "openfda_api", None, 99, "x"), ("", "openfda_api", None, 1, "e"),
             ("nowhere", "openfda_api", None, None, "n")]
    return spark.createDataFrame(rows, "recall_number string, source string, report_date date, ingest_ord int, status string")


@pytest.mark.parametrize("hot", [2, 10_000])
def test_records_move_once_and_by_key(spark, monkeypatch, hot):
    monkeypatch.setattr(D, "HOT_KEY", hot)
    records = _records(spark)
    winners = D._per_key(D._narrow(records, "ingest_ord")).select("recall_number", D._one_sided_winner().alias("ingest_ord"))
    want = records.join(winners, ["recall_number", "ingest_ord"], "left_semi")
    for found in (D.dedupe_one_source(records), D.dedupe(records), D.dedupe_in_windows(records.withColumn("w", F.lit(1)), ["w"]).drop("w")):
        assert sorted(map(str, found.select(want.columns).collect())) == sorted(map(str, want.collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_recalls(D.dedupe_one_source(records), D.dedupe_one_source(records), AS_OF)
        assert not re.search(r"hashpartitioning\(recall_number#\d+, ingest_ord", plan(merged))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _nodes(node, name: str) -> list:
    children = node.children()
    below = [n for i in range(children.size()) for n in _nodes(children.apply(i), name)]
    return ([node] if node.nodeName() == name else []) + below


def test_the_report_counts_a_row_for_a_few_groupings(spark):
    rows = [(f"R{i}", ("Drugs", "Food")[i % 2], ("Class I", None)[i % 3 == 0], f"firm {i % 4}", "undeclared milk", date(2024, 1 + i % 3, 1),
             ("CA", None)[i % 5 == 0], "CA, NY", "12 units", "Ongoing") for i in range(30)]
    recalls = spark.createDataFrame(rows, """recall_number string, product_type string, classification string, recalling_firm string, reason_for_recall string,
        report_date date, state string, distribution_pattern string, product_quantity string, status string""")
    base = report_base(recalls, "recalling_firm")
    assert [e.projections().size() for e in _nodes(base._jdf.queryExecution().optimizedPlan(), "Expand")] == [4]
    sets = {r.set_id: r for r in base.groupBy("set_id").agg(F.sum("rows").alias("rows"), F.sum("class_i").alias("i"), F.count("*").alias("n")).collect()}
    assert len(sets) == 12 and {r["rows"] for r in sets.values()} == {30} and {r.i for r in sets.values()} == {20}
    assert sorted((r.product_type, r.n) for r in base.where("month IS NOT NULL").groupBy("product_type").agg(F.sum("rows").alias("n")).collect()) == [
        ("Drugs", 15), ("Food", 15)]


def test_nothing_is_joined_with_an_empty_table(spark, tmp_path):
    stored = read_table(spark, str(tmp_path / "none")).drop("report_month")
    batch = spark.createDataFrame([("R1", "Ongoing")], "recall_number string, status string").repartition(2)
    merged = merge_recalls(stored, batch, datetime(2024, 1, 1))
    assert not _nodes(merged._jdf.queryExecution().optimizedPlan(), "Join")
    assert [(r.recall_number, r.status, r.created_at, r.city) for r in merged.select("recall_number", "status", "created_at", "city").collect()] == [
        ("R1", "Ongoing", datetime(2024, 1, 1), None)]


def test_a_column_is_stripped_like_any_text(spark):
    texts = ["a", " a", "a ", "", " ", None, "é", "é\u2003", "\u00a0a", "a\x1c", "\x7f", "~a~", "a\x7f ", "\x00a", "a b", "a\u3000"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(1)
    assert all(r.a == r.b for r in df.select(strip_column("t").alias("a"), strip(F.col("t")).alias("b")).collect())


@pytest.mark.parametrize("files", [1, 2])
def test_a_stream_reads_a_folder_of_lines(spark, tmp_path, files):
    def put(name: str, rows: list, schema: str) -> None:
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(f"{tmp_path}/{name}.parquet")

    day = datetime(1996, 5, 1)
    put("lineitem", [(o, p, 1, n, 1.0, 2.0, 0.0, 0.0, "R", "O", day) for o, p, n in ((1, 1, 1), (1, 2, 2), (2, 1, 1))],
        """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double,
        l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp""")
    put("orders", [(1, day), (2, day)], "o_orderkey long, o_orderdate timestamp")
    put("part", [(1, "p one", 1), (2, "p two", 2)], "p_partkey long, p_name string, p_size int")
    put("supplier", [(1, "Firm", 1)], "s_suppkey long, s_name string, s_nationkey int")
    put("nation", [(1, "N")], "n_nationkey int, n_name string")
    assert sorted(r.recall_number for r in streamed(spark, str(tmp_path)).collect()) == ["R-1-1", "R-1-2", "R-2-1"]


def test_marks_find_their_rows(spark, tmp_path):
    numbered(spark.range(100_000).repartition(3)).write.parquet(f"{tmp_path}/t")
    rows = spark.read.parquet(f"{tmp_path}/t")
    marks = mark_rows(rows.where("id % 7 < 3").union(rows.where("id = 0")), third=F.col("id") % 3 == 0, all=F.lit(True))
    for n in (100_000, 1 << 40):
        found = with_marks(rows, marks, n)
        assert found.columns == ["id", ROW, "third", "all"] and found.count() == 100_000
        assert found.where(F.col("all") != (F.col("id") % 7 < 3)).count() == 0
        assert found.where(F.col("third") != ((F.col("id") % 7 < 3) & (F.col("id") % 3 == 0))).count() == 0
    assert not with_marks(rows, mark_rows(rows.where("id < 0"), none=F.lit(True)), 9).where("none").count()


@pytest.mark.parametrize("hot", [2, 10_000])
def test_a_mixed_key_is_folded_in_order(spark, monkeypatch, hot):
    monkeypatch.setattr(D, "HOT_KEY", hot)
    days = [date(2024, 1, 5), date(2024, 1, 9), None, date(2024, 1, 2), date(2024, 1, 20)]
    rows = [(f"K{i % 5}", "fda_website" if (i * 7) % 3 == 0 and i % 5 < 3 else "openfda_api", days[(i * i) % 5], i, f"r{i}") for i in range(80)]
    rows += [("none", None, days[0], 1, "a"), ("none", None, days[1], 2, "b")]
    records = spark.createDataFrame(rows, "recall_number string, source string, report_date date, ingest_ord int, status string").repartition(3)
    held = {}
    for r in rows[:80]:
        h = held.get(r[0])
        if h is None or (h[1] == "fda_website" and r[1] == "openfda_api") or (r[2] and h[2] and r[2] > h[2]):
            held[r[0]] = r
    want = sorted([h[4] for h in held.values()] + ["a", "b"])  # nothing is chosen among records without a source
    assert sorted(r.status for r in D.dedupe(records).collect()) == want


def test_records_of_a_stream_move_once(spark, tmp_path):
    """The records go to their month; by key only narrow rows travel."""
    root, moved = str(tmp_path), []
    recalls = [(f"R{i % 40}", "openfda_api", "Food", "Class I", "Firm", "milk", date(2024, 1 + i % 3, 1), "{}", i, "x" * 50) for i in range(100)]
    spark.createDataFrame(recalls, """recall_number string, source string, product_type string, classification string, recalling_firm string,
        reason_for_recall string, report_date date, raw_json string, ingest_ord int, extra string""").write.parquet(f"{root}/in")
    given = spark.read.parquet(f"{root}/in")

    def prepare(batch):
        return batch.withColumns({c: F.lit(None).cast(record_type(c)) for c in RECORD_COLUMNS if c not in batch.columns})

    def seen(path, batch):
        moved.append(batch)
        return upserted(spark, path, batch, NOW)

    upserted, NOW = store.upsert_recalls, datetime(2024, 6, 1)
    keep = stream.upsert_recalls
    stream.upsert_recalls = lambda s, path, batch, now: seen(path, batch)
    try:
        stream.upsert_stream(spark.readStream.schema(given.schema).parquet(f"{root}/in"), f"{root}/t", f"{root}/c", prepare, AS_OF, NOW).awaitTermination()
    finally:
        stream.upsert_recalls = keep
    assert "extra" not in moved[0].columns and not [e for e in _nodes(moved[0]._jdf.queryExecution().optimizedPlan(), "RepartitionByExpression")]
    assert not re.search(r"Exchange hashpartitioning\(recall_number", plan(moved[0]))
    want = {}
    for r in recalls:
        if r[0] not in want or r[6] > want[r[0]][6]:
            want[r[0]] = r
    assert sorted((r.recall_number, r.report_date) for r in read_table(spark, f"{root}/t").collect()) == sorted((k, r[6]) for k, r in want.items())


def test_a_fold_moves_only_what_is_put_together(spark, tmp_path):
    def record(key, day, status, firm, **more):
        fields = {"recall_number": key, "report_date": day, "status": status, "recalling_firm": firm, "reason_for_recall": "milk", **more}
        return "{" + ", ".join(f'"{k}": {v if isinstance(v, int) else chr(34) + v + chr(34)}' for k, v in fields.items()) + "}"

    texts = [record("A", "20240105", "one", "a"), record("A", "20240301", "two", "b"), record("A", "20240309", "three", "c"),
             record("A", "20240401", "bad", "d", city=7), record("B", "20240202", "x", "e"), record("B", "20240201", "y", "f"),
             record("C", "20240203", "z", "g"), record("D", "soon", "z", "g"), record("E", "20230101", "z", "g")]
    page = spark.createDataFrame([("Food", "p", '{"results": [' + ", ".join(texts) + "]}")], "product_type string, file string, text string").repartition(1)
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    fold = Fold(place_records(explode_records(with_results(page, F.col("text"))), R.PRODUCT_TYPES, FIRST, LAST, AS_OF), str(tmp_path / "work"), AS_OF)
    assert spark.conf.get(name) == before
    assert sorted((r.recall_number, r.status, r.recalling_firm, r.report_date) for r in fold.batch.collect()) == [
        ("A", "three", "a", date(2024, 1, 5)), ("B", "x", "e", date(2024, 2, 2)), ("C", "z", "g", date(2024, 2, 3))]
    assert sorted((r.recall_number, r.status) for r in fold.winners.collect()) == [("A", "one"), ("A", "three"), ("B", "x"), ("C", "z")]
    assert fold.undatable().count() == 1 and [r.errors for r in fold.failed().collect()] == [["type:city"]]
    for df in (fold.batch, fold.winners):
        assert fold.batch.columns == df.columns == [c for c in fold.validated.columns if c != "errors"]
    assert not re.search(r"Exchange (hash|range)partitioning", plan(fold.batch))
    assert spark.read.parquet(f"{tmp_path}/work/followed").count() == 1


def test_rules_are_not_interpreted(pages):
    """Filters of arrays and lambdas run row by row without generated code: only odd values reach one."""
    checked = validate(normalize(explode_records(pages)), AS_OF).select("errors", "validation_errors", "report_date", "recall_initiation_date")
    text = plan(checked)
    dates = [line for line in text.split("\n") if "try_cast" in line]
    assert dates and not any(re.search(r"transform\(array\(CASE WHEN", line) for line in dates)
    found = {tuple(r.errors): r.validation_errors for r in checked.collect()}
    assert found[("required:recalling_firm", "required:reason_for_recall")] == [
        "Missing product_description", "Missing distribution_pattern", "Missing classification"]
    assert ("required:recalling_firm", "required:reason_for_recall", "type:city") in found

"""Landing files, normalising, validation, de-duplication, merges, web pages, the ingest runs."""

import json
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from recallspark.operators.dedupe import _stretches, dedupe, dedupe_one_source
from recallspark.operators.merge import merge_firms, rebuild_firms
from recallspark.operators.normalize import normalize
from recallspark.operators.validate import batch_counts, quarantine, unexpected_classes, valid_rows, validate
from recallspark.plans.ingest import RecallIngest
from recallspark.sources import landing
from recallspark.sources.landing import completeness, explode_records, get_records, page_sizes, read_pages
from recallspark.sources.recalls import load_recalls
from recallspark.schemas import FIRMS, RECALLS
from recallspark.sources import store
from recallspark.sources.store import duplicated_keys, export_lines, export_sections, read_table, remove_old_versions, run_log, upsert_recalls
from recallspark.sources.webpages import parse_alerts
from recallspark.sources.windows import backfill_windows, daily_window
from recallspark.streaming.ingest import ingest_landing

TODAY = date(2026, 6, 1)
DRUG = {"recall_number": "D-1", "event_id": "9", "classification": " Class  II ", "status": "On-Going", "recalling_firm": "Acme  Labs",
        "reason_for_recall": "Failed\tdissolution", "product_description": "Tablets", "distribution_pattern": "CA, NV",
        "report_date": "20260110", "recall_initiation_date": "2026-01-05", "termination_date": "", "state": "NV",
        "openfda": {"brand_name": ["One", "Two"], "route": [], "generic_name": "SCALAR"}}
DEVICE = {"res_event_number": "Z-1", "cfres_id": "77", "event_type": "Recall", "recall_status": "Ongoing", "recalling_firm": "Dev",
          "reason_for_recall": "Software", "code_info": "Lot 5", "event_date_initiated": "20260201", "event_date_created": "20260205"}
FOOD = {**DRUG, "recall_number": "F-1", "openfda": {}, "classification": "Class I"}


def land(folder, kind, name, records, total=None):
    (folder / kind).mkdir(parents=True, exist_ok=True)
    page = {"meta": {"results": {"total": len(records) if total is None else total}}, "results": records}
    (folder / kind / name).write_text(json.dumps(page))


def normal(spark, folder):
    return normalize(explode_records(read_pages(spark, str(folder))))


def test_normalize_the_three_shapes(spark, tmp_path):
    land(tmp_path, "Drugs", "p0.json", [DRUG])
    land(tmp_path, "Devices", "p0.json", [DEVICE, {**DEVICE, "product_description": None, "res_event_number": None}])
    land(tmp_path, "Food", "p0.json", [FOOD])
    land(tmp_path, "Food", "p1.json", [])
    got = normal(spark, tmp_path).collect()
    assert len(got) == 4
    by = {(r.product_type, r.recall_number): r for r in got}
    drug, device, food = by["Drugs", "D-1"], by["Devices", "Z-1"], by["Food", "F-1"]
    assert (drug.classification, drug.recalling_firm, drug.reason_for_recall) == ("Class II", "Acme Labs", "Failed dissolution")
    assert (drug.report_date, drug.recall_initiation_date, drug.termination_date) == (date(2026, 1, 10), date(2026, 1, 5), None)
    assert (drug.brand_name, drug.route, drug.generic_name, drug.type_errors) == ("One, Two", None, "SCALAR", [])
    assert json.loads(drug.raw_json) == DRUG
    assert (device.classification, device.event_id, device.status, device.product_description) == ("Class II", "77", "Ongoing", "Lot 5")
    assert (device.report_date, food.brand_name, food.classification) == (date(2026, 2, 5), None, "Class I")
    # a JSON null is present: no stand-in for it
    null_row = by["Devices", None]
    assert null_row.product_description == ""


def test_type_errors_and_broken_files(spark, tmp_path):
    land(tmp_path, "Drugs", "p0.json", [{**DRUG, "city": 5}, {**DRUG, "openfda": None}, {**DRUG, "openfda": {"route": 3}}, DRUG])
    land(tmp_path, "Devices", "p0.json", [{**DEVICE, "event_date_created": 20260205}, {**DEVICE, "event_date_posted": "20260210",
                                                                                      "event_date_created": 7}])
    (tmp_path / "Food").mkdir()
    (tmp_path / "Food" / "bad.json").write_text('{"results": [')
    land(tmp_path, "Toys", "p0.json", [DRUG])
    pages = read_pages(spark, str(tmp_path))
    assert pages.where("is_corrupt").count() == 1
    errors = sorted(",".join(r.type_errors) for r in normalize(explode_records(pages)).collect())
    assert errors == ["", "", "city", "openfda", "report_date", "route", "unknown_product_type"]


def test_date_range_source_and_completeness(spark, tmp_path):
    land(tmp_path, "Drugs", "p0.json", [DRUG, {**DRUG, "report_date": "20260111"}], total=9)
    land(tmp_path, "Devices", "p0.json", [{**DEVICE, "event_date_posted": "20260110"}, DEVICE])
    day = date(2026, 1, 10)
    assert get_records(spark, str(tmp_path), "Drugs", day, day).count() == 1
    assert get_records(spark, str(tmp_path), "Devices", day, day).count() == 1
    with pytest.raises(ValueError):
        get_records(spark, str(tmp_path), "Toys", day, day)
    checked = {r.endpoint: (r.returned, r.total, r.is_truncated)
               for r in completeness(page_sizes(read_pages(spark, str(tmp_path)), F.lit("w"))).collect()}
    assert checked == {"Drugs": (2, 9, True), "Devices": (2, 2, False)}


def test_validation(spark, tmp_path):
    land(tmp_path, "Drugs", "p0.json", [
        {**DRUG, "status": " On-Going ", "report_date": "20990101"}, {**DRUG, "recall_number": "D-2", "recalling_firm": "   "},
        {**DRUG, "recall_number": "D-3", "classification": "Odd", "product_description": "", "distribution_pattern": None},
        {**DRUG, "recall_number": "D-4", "state": "N" * 11}, {**DRUG, "recall_number": ""},
        {"recall_number": "D-6", "recalling_firm": "F", "reason_for_recall": "R"}])
    checked = validate(normal(spark, tmp_path), TODAY).cache()
    rows = {r.recall_number: r for r in checked.collect()}
    assert rows["D-1"].report_date is None and rows["D-1"].recall_initiation_date == date(2026, 1, 5)
    # squeezed by normalising, so the variant is recognised here; padded text given directly is not
    assert rows["D-1"].status == "Ongoing"
    assert rows["D-2"].errors == ["required:recalling_firm"] and rows["D-4"].errors == ["too_long:state"]
    assert rows[""].errors == ["required:recall_number"]
    assert rows["D-3"].validation_errors == ["Missing product_description", "Missing distribution_pattern"]
    assert rows["D-6"].validation_errors == ["Missing product_description", "Missing distribution_pattern",
                                             "Missing classification", "No date fields present"]
    assert rows["D-1"].validation_errors is None and rows["D-6"].classification is None and rows["D-6"].status is None
    counts = batch_counts(checked).first()
    assert (counts.valid, counts.failed, counts.warning_count) == (3, 3, 6)
    assert quarantine(checked).count() == 3 and valid_rows(checked).count() == 3
    assert [r.classification for r in unexpected_classes(checked).collect()] == ["Odd"]
    padded = checked.drop("errors", "is_validated", "validation_errors").withColumn("status", F.lit(" On-Going "))
    assert validate(padded, TODAY).first().status == "On-Going"


def fold(records):
    """Brute force of the arrival-order rule."""
    held = {}
    for number, order, source, day in records:
        if not number:
            continue
        old = held.get(number)
        if old is None or (source == "openfda_api" and old[2] == "fda_website") or (day and old[3] and day > old[3]):
            held[number] = (number, order, source, day)
    return sorted(r[:2] for r in held.values())


def random_records(seed, n, keys, sources):
    pick = random.Random(seed)
    return [(pick.choice(keys), i, pick.choice(sources), None if pick.random() < 0.25 else date(2024, 1, pick.randint(1, 9)))
            for i in range(n)]


SCHEMA = "recall_number string, ingest_ord long, source string, report_date date"


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_dedupe_equals_the_fold(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # one key holds a third of the rows, so it is cut over several range partitions
        keys = ["hot"] * 200 + [f"k{i}" for i in range(400)] + [""]
        records = random_records(5, 3000, keys, ["openfda_api", "fda_website"])
        df = spark.createDataFrame(records, SCHEMA).repartition(5)
        assert sorted((r[0], r[1]) for r in dedupe(df).select("recall_number", "ingest_ord").collect()) == fold(records)
        single = random_records(6, 800, keys, ["openfda_api"])
        one = spark.createDataFrame(single, SCHEMA).repartition(3)
        assert sorted((r[0], r[1]) for r in dedupe_one_source(one).select("recall_number", "ingest_ord").collect()) == fold(single)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_stretches_chain_to_the_fold():
    """Any cut of a key's records into stretches gives the fold's winner."""
    import pandas as pd
    pick = random.Random(11)
    for _ in range(300):
        n = pick.randint(1, 14)
        recs = [(i, None if pick.random() < 0.3 else pick.randint(1, 5), pick.random() < 0.5) for i in range(n)]
        cuts = sorted(pick.sample(range(1, n), min(n - 1, pick.randint(0, 4)))) if n > 1 else []
        held = None
        for lo, hi in zip([0, *cuts], [*cuts, n]):
            part = pd.DataFrame([("k", *r) for r in recs[lo:hi]], columns=["recall_number", "_ord", "_day", "_web"])
            s = pd.concat(list(_stretches(iter([part])))).iloc[0]
            if held is None:
                held = s["_alone"]
            elif held["_web"]:
                best = s["_web_best"]
                if s["_after_web"] is not None:
                    held = s["_after_web"]
                elif best is not None and held["_day"] is not None and best["_day"] > held["_day"]:
                    held = best
            elif held["_day"] is not None:
                held = next((st["_rec"] for st in s["_steps"] if held["_day"] < st["_below"]), held)
        records = [("k", o, "fda_website" if web else "openfda_api", None if d is None else date(2024, 1, d)) for o, d, web in recs]
        assert fold(records) == [("k", held["_ord"])], recs


def test_dedupe_rules(spark):
    def winner(*rows):
        df = spark.createDataFrame([("K", i, s, d) for i, (s, d) in enumerate(rows)], SCHEMA)
        return dedupe(df).first().ingest_ord
    api, web, early, late = "openfda_api", "fda_website", date(2026, 1, 1), date(2026, 3, 1)
    assert winner((web, None), (api, None)) == 1
    assert winner((api, early), (api, late)) == 1
    assert winner((api, early), (web, late)) == 1
    assert winner((api, None), (api, late)) == 0
    assert winner((web, late), (api, early), (web, early)) == 1


def test_ingest_twice_then_update(spark, tmp_path):
    landing, root = tmp_path / "landing", tmp_path / "store"
    land(landing, "Drugs", "p0.json", [DRUG, DRUG, {**DRUG, "recall_number": "D-9", "reason_for_recall": ""}])
    land(landing, "Devices", "p0.json", [{**DEVICE, "event_date_posted": "20260110"}])
    land(landing, "Food", "p0.json", [FOOD])
    page = ('<main><table class="cols-4"><tbody><tr><td>01/09/2026</td><td><a href="/x">Nut bar</a></td><td></td><td></td></tr>'
            "</tbody></table></main>")
    pages = spark.createDataFrame([(1, page)], "page_id int, html string")
    job, as_of = RecallIngest(spark, str(landing), str(root)), date(2026, 1, 12)
    first = job.run_daily(as_of, pages, datetime(2026, 1, 12)).first()
    assert (first.records_fetched, first.records_inserted, first.records_updated, first.records_skipped,
            first.validation_failures, first.n_errors) == (6, 4, 0, 1, 1, 0)
    again = job.run_daily(as_of, pages, datetime(2026, 1, 13)).first()
    assert (again.records_inserted, again.records_updated) == (0, 4)
    land(landing, "Drugs", "p0.json", [{**DRUG, "status": "Terminated", "recalling_firm": "Renamed", "report_date": "20260111"}])
    assert job.run_daily(as_of, None, datetime(2026, 1, 14)).first().records_updated == 3
    stored = {r.recall_number: r for r in read_table(spark, job.recalls_path).collect()}
    assert len(stored) == 4 and duplicated_keys(read_table(spark, job.recalls_path)).count() == 0
    drug = stored["D-1"]
    assert (drug.status, drug.recalling_firm, drug.report_date) == ("Terminated", "Acme Labs", date(2026, 1, 10))
    assert (drug.first_seen_at, drug.last_updated_at) == (datetime(2026, 1, 12), datetime(2026, 1, 14))
    firms = {r.name: r.total_recalls for r in read_table(spark, f"{root}/firms", FIRMS).collect()}
    assert firms == {"Acme Labs": 2, "Dev": 1}
    assert run_log(spark, f"{root}/ingestion_logs").where("status = 'success'").count() == 11
    assert {tuple(r.errors) for r in spark.read.parquet(f"{root}/quarantine").collect()} == {("required:reason_for_recall",)}
    newest = load_recalls(read_table(spark, job.recalls_path), date(2026, 1, 9), date(2026, 1, 31)).collect()
    assert [r.report_date for r in newest] == sorted((r.report_date for r in newest), reverse=True) and len(newest) == 4


def test_one_endpoint_failing_leaves_the_others(spark, tmp_path):
    land(tmp_path, "Drugs", "p0.json", [DRUG])
    job = RecallIngest(spark, str(tmp_path), str(tmp_path / "store"), firm_mode="incremental")
    totals = job.run_daily(date(2026, 1, 12)).first()
    assert totals.records_inserted == 1 and totals.n_errors == 2
    assert job.run_backfill(date(2026, 1, 20), 2026, 2026, ["Drugs"]) == 1
    assert job.firms().first().total_recalls == 2   # counted again, as documented


def test_stream_replay_inserts_nothing(spark, tmp_path):
    landing, seen = tmp_path / "landing", []
    land(landing, "Drugs", "p0.json", [DRUG])
    land(landing, "Food", "p0.json", [FOOD])

    def run(name):
        ingest_landing(spark, str(landing), str(tmp_path / "recalls"), str(tmp_path / name), TODAY, datetime(2026, 6, 1),
                       lambda _, inserted, updated: seen.append((inserted, updated)))
    run("checkpoint")
    run("checkpoint")
    assert seen == [(2, 0)]
    land(landing, "Drugs", "p1.json", [{**DRUG, "recall_number": "D-2"}, DRUG])
    run("checkpoint")
    run("another")
    assert seen[1] == (1, 1) and seen[2] == (0, 3) and read_table(spark, str(tmp_path / "recalls")).count() == 3


def test_stream_keeps_what_failed(spark, tmp_path):
    landing, counts = tmp_path / "landing", []
    land(landing, "Drugs", "p0.json", [DRUG, {**DRUG, "recall_number": "D-2", "reason_for_recall": ""}])
    (landing / "Drugs" / "p1.json").write_text("{not json")

    def run():
        ingest_landing(spark, str(landing), str(tmp_path / "recalls"), str(tmp_path / "checkpoint"), TODAY, datetime(2026, 6, 1),
                       on_failed=lambda batch, failed: counts.append((batch, failed)))
        rows = spark.read.parquet(f"{tmp_path}/checkpoint-quarantine").collect()
        return sorted((r.batch_id, r.recall_number or "", *r.errors, (r.file or "")[-7:]) for r in rows)
    first = [(0, "", "corrupt_page", "p1.json"), (0, "D-2", "required:reason_for_recall", "")]
    assert run() == first
    for name in ("0", ".0.crc"):  # as if the job had died before the batch was committed
        (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    assert run() == first
    land(landing, "Drugs", "p2.json", [{**DRUG, "recall_number": "D-3", "recalling_firm": ""}, {**DRUG, "recall_number": "D-4"}])
    assert run() == [*first, (1, "D-3", "required:recalling_firm", "")]
    assert counts == [(0, 2), (0, 2), (1, 1)]
    assert {r.recall_number for r in read_table(spark, str(tmp_path / "recalls")).collect()} == {DRUG["recall_number"], "D-4"}


def test_web_layouts(spark):
    row = "<td>{}</td><td><a href='x' href=\"/d\">{}</a></td><td>{}</td>"
    table = f'<table class="views cols-4"><tbody><tr>{row.format("Mar 5, 2026", "Rx <b>pills</b>", "Mold")}<td>Acme</td></tr></tbody></table>'
    listed = ('<div class="view-content"><div class="views-row"><h3><a href="/a">Pump alert</a></h3><time>2026-03-05</time>'
              '<div class="views-field-field-company">Acme &amp; Co</div></div><div class="views-row"><p>no link</p></div></div>')
    fallback = f"<main><table><tbody><tr>{row.format('bad', 'Cake', '')}</tr><tr><td>x</td></tr></tbody></table></main>"
    pages = spark.createDataFrame([(1, table), (2, listed), (3, fallback), (4, "<p>nothing</p>"), (5, f"<table><tr>{row.format(1, 2, 3)}</tr></table>")],
                                  "page_id int, html string")
    got = {r.page_id: r for r in parse_alerts(pages).collect()}
    assert set(got) == {1, 2, 3}
    assert (got[1].product_description, got[1].reason_for_recall, got[1].recalling_firm, got[1].product_type) == (
        "Rxpills", "Mold", "Acme", "Drugs")
    assert (got[1].recall_number, got[1].report_date, got[1].detail_url) == ("WEB-Mar52026AcmeRxpills", date(2026, 3, 5), "/d")
    assert (got[2].reason_for_recall, got[2].recalling_firm, got[2].product_type, got[2].detail_url) == (
        "Pump alert", "Acme & Co", "Devices", "/a")
    assert (got[3].recalling_firm, got[3].reason_for_recall, got[3].report_date, got[3].product_type) == (
        "Unknown", "See FDA website for details", None, "Food")
    norm = normalize(parse_alerts(pages), "fda_website").where("page_id = 2").first()
    assert (norm.status, norm.country, norm.classification, norm.product_type) == ("Ongoing", "United States", None, "Devices")
    assert "_scrape_html" in json.loads(norm.raw_json)


def test_windows(spark):
    w = backfill_windows(spark, date(2024, 3, 15), 2023, None, ["Food"]).orderBy("year", "month").collect()
    assert len(w) == 15 and (w[-1].date_from, w[-1].date_to, w[13].date_to) == ("20240301", "20240331", "20240229")
    assert backfill_windows(spark, date(2024, 3, 15), 2024, 2025).count() == 3 * (3 + 12)
    assert backfill_windows(spark, date(2024, 3, 15), 2025, 2024).count() == 0
    assert daily_window(date(2024, 3, 5)) == (date(2024, 2, 27), date(2024, 3, 5))


def test_firm_merge(spark):
    schema = ("recalling_firm string, classification string, recall_initiation_date date, report_date date, city string, state string, "
              "country string, recall_number string, ingest_ord int")
    old = rebuild_firms(spark.createDataFrame([(" A ", "Class I", date(2025, 5, 1), None, "X", "CA", "US", "1", 1),
                                               ("B", "Class II", None, date(2025, 1, 1), None, None, None, "2", 2)], schema))
    batch = spark.createDataFrame([("A", "Class III", None, None, "Y", "NY", "US", "3", 2), ("A", "Class I", None, None, "Z", "TX", "US", "4", 1),
                                   ("C", None, None, date(2024, 1, 1), "Q", "WA", "US", "5", 3), ("  ", "Class I", None, None, "", "", "", "6", 4)], schema)
    got = {r.name: r for r in merge_firms(old, batch, "ingest_ord").collect()}
    assert set(got) == {"A", "B", "C"}
    a = got["A"]
    assert (a.city, a.total_recalls, a.class_i_count, a.class_iii_count, a.first_recall_date, a.latest_recall_date) == (
        "X", 3, 2, 1, date(2025, 5, 1), None)
    assert (got["B"].latest_recall_date, got["C"].city, got["C"].latest_recall_date) == (date(2025, 1, 1), "Q", date(2024, 1, 1))
    assert {r.name: r.city for r in rebuild_firms(batch, "ingest_ord").collect()} == {"A": "Z", "C": "Q"}


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0, "", "second"), (1, 1.0, "", "first")], "block int, sort double, tie string, line string")
    export_lines(df, str(tmp_path / "text"))
    assert [r.value for r in spark.read.text(str(tmp_path / "text")).collect()] == ["first", "second"]
    export_sections({"a": df, "b": df}, str(tmp_path / "sections"), "json")
    assert spark.read.json(f"{tmp_path}/sections/b").count() == 2


def test_a_lost_writer_leaves_the_table_whole(spark, tmp_path, monkeypatch):
    path, now = str(tmp_path / "recalls"), datetime(2026, 1, 1)

    def batch(*rows):
        names = ["recall_number", "product_type", "status", "report_date"]
        frame = spark.createDataFrame([r for r in rows], "recall_number string, product_type string, status string, report_date date")
        return frame.select(*[F.col(f.name) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in RECALLS.fields if f.name not in
                              ("first_seen_at", "last_updated_at", "created_at")])

    def stored():
        return {r.recall_number: (r.status, r.report_month) for r in read_table(spark, path).collect()}

    first = batch(("A", "Drugs", "Ongoing", date(2026, 1, 5)), ("B", "Food", "Ongoing", None), ("C", "Food", "Ongoing", date(2025, 3, 1)))
    assert upsert_recalls(spark, path, first, now) == (3, 0)
    before = stored()
    second = batch(("A", "Drugs", "Completed", date(2026, 2, 5)), ("B", "Food", "Completed", None), ("D", "Drugs", "Ongoing", date(2026, 2, 1)))
    with monkeypatch.context() as patch:
        patch.setattr(store, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            upsert_recalls(spark, path, second, now)
    assert stored() == before
    assert upsert_recalls(spark, path, second, now) == (1, 2)
    after = stored()
    assert set(after) == set("ABCD") and after["C"] == before["C"] and after["A"][0] == after["B"][0] == "Completed"
    assert upsert_recalls(spark, path, second, now) == (0, 3) and stored() == after
    assert remove_old_versions(spark, path) > 0 and stored() == after
    plan = load_recalls(read_table(spark, path), date(2026, 1, 1), date(2026, 1, 31))._jdf.queryExecution().toString()
    assert "report_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(store.TableChanged):
        store.publish(spark, path, store.current(spark, path)[0], [])


def test_dates_in_other_spellings_and_broken_pages(spark, tmp_path):
    land(tmp_path, "Drugs", "p0.json", [{**DRUG, "report_date": "2026-01-09"}, {**DRUG, "recall_number": "D-3", "report_date": "soon"}])
    (tmp_path / "Drugs" / "p1.json").write_text("{not json")
    job = RecallIngest(spark, str(tmp_path), str(tmp_path / "store"))
    row = job.run_endpoint("Drugs", date(2026, 1, 1), date(2026, 1, 31), "daily", date(2026, 2, 1))
    assert (row["status"], row["records_inserted"], row["validation_failures"]) == ("success", 1, 1)
    held = spark.read.parquet(f"{tmp_path}/store/quarantine").collect()
    assert [tuple(r.errors) for r in held] == [("corrupt_page",)] and held[0].file.endswith("p1.json") and held[0].run_id == row["run_id"]
    lost = landing.undatable(landing.explode_records(read_pages(spark, str(tmp_path), "Drugs"))).collect()
    assert [(r.product_type, r.records) for r in lost] == [("Drugs", 1)]


def test_pages_with_other_quoting_and_a_footer(spark):
    cells = "<td>March 5, 2026</td><td><a href=/d>Nut bar</a></td><td>Don&#8217;t eat &eacute;clairs &#x26;lt; &amp;gt; &nosuch;</td><td>Acme</td>"
    table = f"<table class='views cols-4'><thead><tr><th>Date</th></tr></thead><tbody><tr><th>x</th>{cells}</tr></tbody></table>"
    listed = ("<div class=view-content><div class='item views-row'><div><h3><a href='/a'>Pump</a></h3></div></div>"
              "<div class=views-row><p>no link</p></div></div><footer><h3><a href='/p'>Privacy</a></h3></footer>")
    got = {(r.page_id, r.product_description, r.detail_url, r.reason_for_recall) for r in parse_alerts(
        spark.createDataFrame([(1, table), (2, listed)], "page_id int, html string")).collect()}
    assert got == {(1, "Nut bar", "/d", "Don\u2019t eat \u00e9clairs &lt; &gt; &nosuch;"), (2, "Pump", "/a", "Pump")}


def test_backfill_parses_landing_once(spark, tmp_path, monkeypatch):
    from recallspark.plans import ingest
    land(tmp_path, "Drugs", "p0.json", [{**DRUG, "recall_number": f"D-{m}-{i}", "report_date": f"2025{m:02d}{10 + i}"} for m in (1, 2, 5) for i in range(3)])
    land(tmp_path, "Drugs", "p1.json", [{**DRUG, "recall_number": "D-1-0", "report_date": "20250511", "status": "Terminated"}])
    job, firms = RecallIngest(spark, str(tmp_path), str(tmp_path / "store")), []
    monkeypatch.setattr(ingest, "rebuild_firms", lambda recalls: firms.append(1) or rebuild_firms(recalls))
    assert job.run_backfill(date(2025, 6, 1), 2025, 2025, ["Drugs"]) == 10 and firms == [1]
    stored = {r.recall_number: r.status for r in read_table(spark, job.recalls_path).collect()}
    assert len(stored) == 9 and stored["D-1-0"] == "Terminated"
    assert read_table(spark, f"{tmp_path}/store/firms", FIRMS).first().total_recalls == 9


def test_backfill_fold_equals_window_by_window(spark, tmp_path):
    rng, names = random.Random(5), ["Acme", "Bolt", "  Acme ", "Core"]

    def record(kind, i):
        day = rng.choice([f"2025{rng.randint(1, 3):02d}{rng.randint(10, 28)}", f"2025-0{rng.randint(1, 3)}-1{rng.randint(0, 9)}"])
        day = rng.choice([day] * 8 + ["20990101", None, "soon"])
        base = {"reason_for_recall": rng.choice(["R", "R2", ""]), "recalling_firm": rng.choice(names), "state": rng.choice(["CA", "NY", 7])}
        key = f"K-{rng.randint(1, 6)}"  # shared by the endpoints
        if kind == "Devices":
            return {**base, "res_event_number": key, "event_date_posted": day, "recall_status": f"s{i}"}
        return {**base, "recall_number": key, "report_date": day, "status": f"s{i}"}

    for kind in ("Drugs", "Devices"):
        for page in range(2):
            land(tmp_path / "landing", kind, f"p{page}.json", [record(kind, 20 * page + i) for i in range(20)])
    (tmp_path / "landing" / "Drugs" / "p9.json").write_text("{not json")
    now, as_of = datetime(2025, 4, 1), date(2025, 3, 20)
    one = RecallIngest(spark, str(tmp_path / "landing"), str(tmp_path / "one"), "incremental")
    each = RecallIngest(spark, str(tmp_path / "landing"), str(tmp_path / "each"), "incremental")
    kinds = ["Drugs", "Devices", "Food"]
    total = one.run_backfill(as_of, 2025, 2025, kinds, now)
    rows = []
    for month, end in ((1, 31), (2, 28), (3, 31)):
        rows += [each.run_endpoint(kind, date(2025, month, 1), date(2025, month, end), "backfill", as_of, now) for kind in kinds[:2]]
    assert total == sum(r["records_inserted"] + r["records_updated"] for r in rows) > 0

    def held(job):
        return sorted(map(str, (tuple(r) for r in read_table(spark, job.recalls_path).drop("report_month").collect())))
    assert held(one) == held(each)
    logs = {(r.endpoint, r.date_range_start): r for r in run_log(spark, f"{tmp_path}/one/ingestion_logs").collect()}
    for r in rows:
        mine, broken = logs[r["endpoint"], r["date_range_start"]], r["endpoint"] == "Drugs"
        assert [mine.records_fetched, mine.records_inserted, mine.records_updated, mine.records_skipped, mine.validation_failures] == [
            r["records_fetched"], r["records_inserted"], r["records_updated"], r["records_skipped"], r["validation_failures"] - broken]
    assert {r.status for r in logs.values() if r.endpoint == "Food"} == {"failed"} and len(logs) == 9 + 2
    assert logs["Drugs", None].validation_failures - 1 == logs["Drugs", None].records_fetched > 0 < logs["Devices", None].validation_failures
    lost = [r for r in spark.read.parquet(f"{tmp_path}/one/quarantine").collect() if "undatable" in r.errors or "corrupt_page" in r.errors]
    assert len(lost) == logs["Drugs", None].validation_failures + logs["Devices", None].validation_failures
    assert sorted(map(tuple, one.firms().collect())) == sorted(map(tuple, each.firms().collect()))
    before = one.firms().collect()
    store.compact_firms(spark, f"{tmp_path}/one/firms")
    assert sorted(map(tuple, one.firms().collect())) == sorted(map(tuple, before))


def test_stream_counts_firms_once(spark, tmp_path):
    landing, firms = tmp_path / "landing", str(tmp_path / "firms")
    land(landing, "Drugs", "p0.json", [DRUG, DRUG])
    land(landing, "Food", "p0.json", [{**FOOD, "recalling_firm": "Other"}])

    def run():
        ingest_landing(spark, str(landing), str(tmp_path / "recalls"), str(tmp_path / "checkpoint"), TODAY, datetime(2026, 6, 1), firms_path=firms)
        return {r.name: r.total_recalls for r in store.read_firms(spark, firms).collect()}
    assert run() == {"Acme Labs": 1, "Other": 1}
    for name in ("0", ".0.crc"):  # as if the job had died before the batch was committed
        (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    assert run() == {"Acme Labs": 1, "Other": 1}
    land(landing, "Drugs", "p1.json", [{**DRUG, "recall_number": "D-2"}])
    assert run() == {"Acme Labs": 2, "Other": 1}

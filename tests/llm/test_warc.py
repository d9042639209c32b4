"""WARC archives: segments and revisits against brute force, the files themselves, broken archives, odd rows."""

import glob
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import compare, connect
from recallspark.llm import warc
from recallspark.llm.warc import END, find_revisits, parse, read_chunks, read_records, read_segments, write_archives
from tests.llm.conftest import SMALL

BIG = "é\r\n\r\n€WARC/1.1\r\n𝄞\r\n" * 5_000  # holds ends of records and of headers
ROWS = [(5, "http://a/ x\r\ny", "same " * 30), (3, None, "same " * 30), (9, "http://c", "same " * 30), (3, "http://d", "same " * 30),
        (None, "http://e", "same " * 30), (None, "http://f", "only nameless " * 20), (None, None, "only nameless " * 20),
        (1, "http://g", "x" * 99), (2, "http://h", "x" * 99), (11, "http://i", "y" * 100), (10, "http://j", "y" * 100),
        (4, "http://k", None), (6, "http://l", ""), (7, "http://m", BIG), (8, "http://n", BIG), (12, "http://o", BIG + "\r\n\r"),
        (13, "http://p", "\r\n\r\n"), (14, "http://ü", "\r\n"), (5, "http://q", "another text under a known id " * 9)]


def brute(rows, least=100):
    first = {}
    for page, _, text in rows:
        if page is not None:
            first[text or ""] = min(page, first.get(text or "", page))
    out = []
    for page, _, text in rows:
        data = (text or "").encode()
        one = first.get(text or "")
        again = len(data) >= least and one is not None and (page is None or page > one)
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", one if again else None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows(spark):
    clashing = ["payload", "mark", "chunk", "data", "refers_to", "payload_digest", "value", "file", "copies"]
    return spark.createDataFrame(ROWS, "page_id long, url string, html string").select("*", *[F.lit("x").alias(c) for c in clashing])


@pytest.mark.parametrize("chunk_bytes", [7, 1000, warc.CHUNK])
def test_round_trip_of_every_payload(spark, rows, tmp_path, chunk_bytes):
    write_archives(rows, f"{tmp_path}/a", chunk_bytes=chunk_bytes)
    assert sorted((tuple(r) for r in read_records(spark, f"{tmp_path}/a").collect()), key=repr) == brute(ROWS)
    found = read_chunks(spark, f"{tmp_path}/a").filter("record_type = 'response' AND page_id IN (1, 6, 7, 12, 13, 14)").collect()
    for page, _, text in ROWS:
        if page in (1, 6, 7, 12, 13, 14):
            parts = sorted((r.chunk, bytes(r.data)) for r in found if r.page_id == page)
            assert b"".join(d for _, d in parts) == (text or "").encode()
            assert len(parts) == max(1, -(-len((text or "").encode()) // chunk_bytes)) and all(len(d) <= chunk_bytes for _, d in parts)


def test_files_are_warc(rows, tmp_path):
    write_archives(rows, f"{tmp_path}/a", chunk_bytes=5000)
    kinds = []
    for path in glob.glob(f"{tmp_path}/a/*.gz"):
        raw = gzip.open(path).read()
        while raw:  # a record: header, blank line, as many bytes as it says, blank lines
            head, _, rest = raw.partition(END)
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[size:size + 4] == END
            assert {"WARC-Type", "WARC-Record-ID", "WARC-Date"} <= set(fields)
            kinds.append(fields["WARC-Type"])
            raw = rest[size + 4:]
    assert kinds.count("revisit") == 5 and kinds.count("response") == len(ROWS) - 5 and kinds.count("continuation") > 10


def lines_of(raw):
    """As Spark's reader gives them."""
    *lines, last = raw.split(END)
    return iter([*lines, last] if last else lines)


def test_broken_archives_are_errors(rows, tmp_path):
    write_archives(rows.filter("page_id IN (7, 1)").coalesce(1), f"{tmp_path}/a", chunk_bytes=50_000)
    raw = gzip.open(glob.glob(f"{tmp_path}/a/*.gz")[0]).read()
    whole = list(read_segments(parse(lines_of(raw))))
    assert len(whole) > 2 and b"".join(r[5] for r in whole if r[0] == 7) == BIG.encode()
    middle = raw.index(b"continuation")
    for broken in (raw[:middle + 9000] + b"!" + raw[middle + 9001:],                      # a byte changed
                   raw[:raw.rindex(b"WARC/1.1\r\nWARC-Type")][:-20] + END,               # cut off
                   raw[:raw.index(b"WARC/1.1\r\nWARC-Type: continuation")] + raw[raw.rindex(b"WARC/1.1\r\nWARC-Type: continuation"):]):
        with pytest.raises(ValueError):
            list(read_segments(parse(lines_of(broken))))


def test_many_revisited_payloads_shuffle(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(warc, "OFTEN", 3)  # "same" is looked up by broadcast, the others by a shuffled join
    write_archives(rows, f"{tmp_path}/a")
    assert sorted((tuple(r) for r in read_records(spark, f"{tmp_path}/a").collect()), key=repr) == brute(ROWS)


def test_no_pages(spark, rows, tmp_path):
    write_archives(rows.filter("1 = 0"), f"{tmp_path}/a")
    assert read_records(spark, f"{tmp_path}/a").count() == 0
    assert find_revisits(spark.createDataFrame([], "page_id long, mark long, payload_bytes long, payload_digest string")).count() == 0


def test_query_equals_sql(spark):
    problem, n = compare(spark, connect(SMALL), entry.queries()["op12_warc"], entry.oracle_sql()["op12_warc"], SMALL)
    assert problem is None and n > 0

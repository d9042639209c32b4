"""WARC archives by way of a table of chunks.

A payload becomes rows of (record, chunk number, bytes) of at most CHUNK bytes each, which stream through
a task in order; only the state of a running SHA-256 is carried from one row to the next, so neither
writing nor reading builds a whole record in Python. In the archive a chunk is a record of its own: the
first segment of a response, then WARC "continuation" segments, each with the digest of all payload bytes
up to its end, which the reader compares as it goes.

Archives are written and read by Spark's text files, whose rows are WARC records and whose line
separator is the end of a record. Any store that Spark reaches will do, and its commit makes a rewrite
after a lost executor safe. They are compressed with gzip, so no file is split among readers.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recallspark.llm.storage import stored
from recallspark.session import scratch_dir

#: Bytes of a chunk, and of a segment in an archive.
CHUNK = 32_768
#: Payloads of fewer bytes are written again rather than revisited.
LEAST_REVISITED = 100
#: Rows that may be broadcast (some hundred bytes each); beyond, joins shuffle.
BROADCAST_ROWS = 1_000_000
#: Equal payloads of more records than this are looked up by broadcast, so that no task gets them all.
OFTEN = 100_000
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


# ---- the table of chunks -----------------------------------------------------------


def page_rows(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``page_id, url, payload`` (UTF-8 bytes; null: none), ``payload_bytes`` and ``mark``, a hash that tells rows of one id apart."""
    payload = F.coalesce(pages[payload_col].cast("binary"), F.lit(b""))
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), payload.alias("payload"))
    return rows.withColumns({"payload_bytes": F.length("payload").cast("long"), "mark": F.xxhash64("payload")})


def chunk_rows(rows: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """Every row's payload cut into ``chunk, data``; the chunks of a row follow each other. No payload: one empty chunk."""
    last = F.greatest(F.ceil(F.length("payload") / F.lit(chunk_bytes)).cast("int") - 1, F.lit(0))
    cut = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("chunk"))
    data = F.substring(F.col("payload"), F.col("chunk") * chunk_bytes + 1, chunk_bytes)
    return cut.select(*[c for c in cut.columns if c != "payload"], data.alias("data"))


class Running:
    """Length and digest of the payload of one record, chunk by chunk."""

    def __init__(self):
        self.state, self.bytes = hashlib.sha256(), 0

    def add(self, data: bytes) -> str:
        self.state.update(data)
        self.bytes += len(data)
        return self.state.hexdigest()


def payload_digests(chunks: DataFrame) -> DataFrame:
    """``page_id, mark, payload_bytes, payload_digest``: one row per record of a table of chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record = Running()
        for batch in batches:
            out = []
            for page, mark, size, chunk, data in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if chunk == 0:
                    record = Running()
                digest = record.add(data)
                if record.bytes == size:
                    out.append((page, mark, size, digest))
            columns = zip(*out) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                             names=["page_id", "mark", "payload_bytes", "payload_digest"])

    return chunks.select("page_id", "mark", "payload_bytes", "chunk", "data").mapInArrow(
        run, "page_id long, mark long, payload_bytes long, payload_digest string")


def find_revisits(digests: DataFrame, least_bytes: int = LEAST_REVISITED) -> DataFrame:
    """``page_id, mark, revisited_digest, refers_to`` of the records whose payload a record with a smaller id has.

    A record without id revisits any that has one. Rows that repeat the smallest id with its payload
    stay responses, and so do records of a payload that has no id at all.
    """
    large = digests.filter(F.col("payload_bytes") >= least_bytes)
    groups = stored(large.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("copies"))
                    .filter("copies > 1 AND refers_to IS NOT NULL"))
    if groups.count() <= BROADCAST_ROWS:
        members = large.join(F.broadcast(groups), "payload_digest")
    else:  # a payload that fills a task is one of a few: at most one for every OFTEN records
        often = F.broadcast(groups.filter(F.col("copies") > OFTEN))
        members = large.join(often, "payload_digest").unionByName(
            large.join(often, "payload_digest", "left_anti").join(groups.filter(F.col("copies") <= OFTEN), "payload_digest"))
    again = members.filter("page_id IS NULL OR page_id > refers_to")
    return again.select("page_id", "mark", F.col("payload_digest").alias("revisited_digest"), "refers_to").distinct()


# ---- archives ------------------------------------------------------------------------


def _header(fields: list[tuple[str, str | None]]) -> bytes:
    return "\r\n".join(["WARC/1.1", *[f"{k}: {v}" for k, v in fields if v is not None]]).encode() + END


def _name(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def segment(page: int | None, url: str | None, date: str, size: int, chunk: int, data: bytes, record: Running,
            revisited_digest: str | None, refers_to: int | None) -> bytes:
    """One WARC record (without its end): a segment of a response, or a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    target = None if url is None else _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)
    common = [("WARC-Date", date), ("WARC-Target-URI", target)]
    if revisited_digest is not None:
        return _header([("WARC-Type", "revisit"), ("WARC-Record-ID", _name(page)), *common, ("WARC-Profile", PROFILE),
                        ("WARC-Refers-To", _name(refers_to)), ("WARC-Payload-Digest", f"sha256:{revisited_digest}"),
                        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(http)))]) + http
    digest = record.add(data)
    whole, block = record.bytes == size, data if chunk else http + data
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", _name(page)), *common, ("Content-Type", "application/http; msgtype=response")]
    if chunk:
        fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{_name(page)[10:-1]}:segment:{chunk + 1}>"),
                  ("WARC-Segment-Origin-ID", _name(page)), *common]
    if chunk or not whole:
        fields.append(("WARC-Segment-Number", str(chunk + 1)))
    if chunk and whole:
        fields.append(("WARC-Segment-Total-Length", str(len(http) + size)))
    fields += [("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
               ("WARC-Payload-Digest" if whole else "X-Payload-Digest-So-Far", f"sha256:{digest}"), ("Content-Length", str(len(block)))]
    return _header(fields) + block


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   date: str = "2000-01-01T00:00:00Z", chunk_bytes: int = CHUNK, least_bytes: int = LEAST_REVISITED) -> None:
    """One WARC record per row of ``pages``, in a new folder.

    The first pass over the chunks gives the digests, which say what is a revisit; the second writes. The
    payloads are not shuffled unless there are more than BROADCAST_ROWS revisits. Null payloads are
    empty, null urls are left out of the record. Rows with equal ids get equal record names, rows
    without id a name without number. Ids must be whole numbers; other columns are ignored.
    """
    rows = page_rows(pages, id_col, url_col, payload_col)
    revisits = stored(find_revisits(stored(payload_digests(chunk_rows(rows, chunk_bytes))), least_bytes))
    few = revisits.count() <= BROADCAST_ROWS
    marked = rows.alias("row").join((F.broadcast(revisits) if few else revisits).alias("again"),
                                    F.col("row.page_id").eqNullSafe(F.col("again.page_id")) & (F.col("row.mark") == F.col("again.mark")), "left")
    # a revisit is one chunk without bytes that still knows the size of its payload
    payload = F.when(F.col("revisited_digest").isNull(), F.col("payload")).otherwise(F.lit(b""))
    chunks = chunk_rows(marked.select("row.page_id", "row.url", "row.payload_bytes", "revisited_digest", "refers_to", payload.alias("payload")), chunk_bytes)
    columns = ["page_id", "url", "payload_bytes", "chunk", "data", "revisited_digest", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record = Running()
        for batch in batches:
            out = []
            for page, url, size, chunk, data, revisited, refers in zip(*(batch.column(i).to_pylist() for i in range(len(columns)))):
                if chunk == 0:
                    record = Running()
                out.append(segment(page, url, date, size, chunk, data, record, revisited, refers))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    records = chunks.select(*columns).mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    records.write.option("lineSep", END.decode()).option("compression", "gzip").mode("errorifexists").text(folder)


def parse(lines: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(header fields, block)`` of the records in one archive, from its bytes between ends of records."""
    buffer, header = bytearray(), None
    for line in lines:
        buffer += line
        buffer += END
        while True:
            if header is None:
                at = buffer.find(END)
                if at < 0:
                    break
                if at == 0:  # behind a last block that ends in a line feed: its end was cut in two and got one too many
                    del buffer[:len(END)]
                    continue
                version, *fields = bytes(buffer[:at]).decode().split("\r\n")
                if not version.startswith("WARC/"):
                    raise ValueError(f"no WARC record: {version[:80]!r}")
                header = dict(f.split(": ", 1) for f in fields)
                del buffer[:at + len(END)]
            size = int(header["Content-Length"])
            if len(buffer) < size + len(END):
                break
            if buffer[size:size + len(END)] != END:
                raise ValueError(f"{header.get('WARC-Record-ID')} is longer than it says")
            block = bytes(buffer[:size])
            del buffer[:size + len(END)]
            yield header, block
            header = None
    if header is not None or buffer:
        raise ValueError("the archive is cut off inside a record")


def _number(name: str | None) -> int | None:
    digits = "" if name is None else name.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _digest(header: dict[str, str], field: str) -> str | None:
    return header[field].removeprefix("sha256:") if field in header else None


def read_segments(records: Iterator[tuple[dict[str, str], bytes]]) -> Iterator[tuple]:
    """``(page_id, url, record_type, refers_to, chunk, data, bytes_so_far, digest_so_far, last)`` of each record.

    A digest that does not fit the bytes, and a segment that does not follow the one before it, are errors.
    """
    running, size, page, chunk = Running(), 0, None, 0
    for header, block in records:
        kind, name = header["WARC-Type"], header.get("WARC-Record-ID")
        block_digest = _digest(header, "WARC-Block-Digest")
        if block_digest is not None and hashlib.sha256(block).hexdigest() != block_digest:
            raise ValueError(f"{name}: the block does not have its digest")
        if kind in ("response", "revisit"):
            http, _, data = block.partition(END)
            lengths = [v for k, _, v in (line.partition(b": ") for line in http.split(b"\r\n")) if k.lower() == b"content-length"]
            page, size, chunk = _number(name), int(lengths[0]) if lengths else len(data), 0
            running = Running()
            if kind == "revisit":
                yield page, header.get("WARC-Target-URI"), kind, _number(header.get("WARC-Refers-To")), 0, b"", size, _digest(header, "WARC-Payload-Digest"), True
                continue
        elif kind == "continuation":
            chunk, data = chunk + 1, block
            if _number(header.get("WARC-Segment-Origin-ID")) != page or header.get("WARC-Segment-Number") != str(chunk + 1):
                raise ValueError(f"{name} does not follow its last segment")
        else:
            continue
        digest, given = running.add(data), _digest(header, "WARC-Payload-Digest") or _digest(header, "X-Payload-Digest-So-Far")
        if given is not None and given != digest or running.bytes > size:
            raise ValueError(f"{name}: the payload does not have its digest")
        yield page, header.get("WARC-Target-URI"), "response", None, chunk, data, running.bytes, digest, running.bytes == size


def read_chunks(spark: SparkSession, folder: str, with_data: bool = True) -> DataFrame:
    """The table of chunks of all archives in a folder; without ``with_data`` only what describes the chunks."""
    names = ["page_id", "url", "record_type", "refers_to", "chunk", "data", "bytes_so_far", "digest_so_far", "last"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]
    kept = [i for i in range(len(names)) if with_data or names[i] != "data"]

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
        for batch in batches:
            paths, start = batch.column(0).to_pylist(), 0
            lines = batch.column(1).to_pylist()
            for i in range(1, len(paths) + 1):
                if i == len(paths) or paths[i] != paths[start]:
                    yield paths[start], lines[start:i]
                    start = i

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = files(batches)
        part = next(parts, None)
        while part is not None:
            path = part[0]

            def lines() -> Iterator[bytes]:
                nonlocal part
                while part is not None and part[0] == path:
                    yield from part[1]
                    part = next(parts, None)

            out, held = [], 0
            for row in read_segments(parse(lines())):
                out.append([row[i] for i in kept])
                held += len(row[5])
                if len(out) == 10_000 or held > 16_000_000:
                    yield batch_of(out)
                    out, held = [], 0
            yield batch_of(out)

    def batch_of(out: list[list]) -> pa.RecordBatch:
        columns = zip(*out) if out else [[]] * len(kept)
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[i]) for c, i in zip(columns, kept)], names=[names[i] for i in kept])

    types = "long string string long int binary long string boolean".split()
    text = spark.read.schema("value string").option("lineSep", END.decode()).text(folder)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary")).mapInArrow(
        run, ", ".join(f"{names[i]} {types[i]}" for i in kept))


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``: one row per response and revisit."""
    return read_chunks(spark, folder, with_data=False).filter("last").select(
        "page_id", F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest"), "record_type", "refers_to")


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the archives of ``pages`` into a new folder (in the shared one, if none is given) and read them back."""
    spark = pages.sparkSession
    folder = folder or f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder)
    return read_records(spark, folder)

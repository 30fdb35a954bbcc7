"""WARC archives, index first.

Writing: every row becomes a record, compressed by itself, in the archive of its task; what comes back is the index, one
row per record with archive, offset, length, URL and payload digest. Of rows with equal payloads of at least SMALL bytes
the one with the smallest page id is a response, the others are revisits that name it and hold no payload.

Reading starts from the index: whichever of its rows are wanted are dealt out by (archive, offset), neighbouring byte
ranges are joined into one read of at most READ_BYTES (a larger record is a read of its own), and each record is taken
out of it. Every payload is checked against the digest in its record.

Page texts are written once, with row numbers, so that numbers stay what they are when a task is repeated. Payloads meet
by digest alone: groups of equal ones are aggregated per map task and are broadcast while they are few; beyond that the
row numbers of revisits are found by a join of narrow rows, which Spark splits where one digest is common, and joined to
the pages by row number. A task writes to a draft and moves it in place when whole; it writes the same bytes again if it
is repeated. Files go to the folder the caller names, through pyarrow's file systems.

Defined results: null and empty payloads are responses of 0 bytes; a null page id comes after all others; of rows with
one page id and one payload one is the response (the smallest URL, then any) and the others revisit it, so that refers_to
is their own page id; a null URL has no target header; control characters and spaces in a URL are percent-encoded in the
record and stay as they are in the index; an empty table has no archives and no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import settle_small, slices, table
from stayline.llm.registry import query
from stayline.llm.text_keys import written
from stayline.plans.durable import work_path

SMALL = 100  # payloads below this are kept however often they occur
READ_BYTES = 8 << 20
GAP = 64 << 10  # unwanted bytes that are rather read than skipped
PART_BYTES = 16 << 20
LEVEL = 6
BROADCAST = 100_000  # groups of equal payloads, or records named by revisits, that are broadcast
DATE = "2000-01-01T00:00:00Z"

# Fixed values of the format
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"

INDEX = ("archive int, offset long, length long, page_id long, url string, payload_digest string, record_type string, "
         "record_id string, refers_id string")


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def archive_name(number: int) -> str:
    return f"{number:05d}.warc.gz"


# ---------------------------------------------------------------------------------------------------------- records

def pack(data: bytes, level: int = LEVEL) -> bytes:
    """One gzip member, the same bytes each time."""
    made = zlib.compressobj(level, zlib.DEFLATED, 31)
    return made.compress(data) + made.flush()


def record_id(row: int) -> str:
    h = hashlib.md5(f"record:{row}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def header_url(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def make_record(kind: str, id_: str, block: bytes, **fields: str | None) -> bytes:
    """Header and block; fields without a value are left out."""
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {id_}", f"WARC-Date: {DATE}",
             *[f"{k.replace('_', '-')}: {v}" for k, v in fields.items() if v is not None], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + END + block + END


def page_record(row: int, page_id: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    """A response with its payload, or a revisit of the record of row ``refers``."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    shared = {"WARC_Target_URI": None if url is None else header_url(url), "WARC_Payload_Digest": f"sha256:{digest}",
              "Page_Id": None if page_id is None else str(page_id), "Content_Type": "application/http; msgtype=response"}
    if refers is None:
        return make_record("response", record_id(row), http + payload, **shared)
    return make_record("revisit", record_id(row), http, WARC_Profile=PROFILE, WARC_Refers_To=record_id(refers), **shared)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the block."""
    head, _, rest = data.partition(END)
    first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record at this offset")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[:int(fields["content-length"])]
    if len(block) < int(fields["content-length"]):
        raise ValueError(f"record {fields.get('warc-record-id')} is cut off")
    return fields, block


# ---------------------------------------------------------------------------------------------------------- writing

def with_originals(pages: DataFrame, small: int = SMALL) -> DataFrame:
    """(row, page_id, url, html, digest, first) of pages; ``first`` is the row whose payload this one repeats."""
    text = F.coalesce("html", F.lit(""))
    rows = written(pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long"), "url",
                                text.alias("html"), F.sha2(text, 256).alias("digest"), F.octet_length(text).alias("size")), "pages")
    narrow = rows.where(F.col("size") >= small).select("digest", "row", "page_id", "url")
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url", "row")
    groups = settle_small(narrow.groupBy("digest").agg(F.min(place).alias("head"), F.count("*").alias("n")).where("n > 1")
                          .select(F.col("digest").alias("of"), F.col("head.row").alias("first")), BROADCAST)
    twin = (F.col("digest") == F.col("of")) & (F.col("row") != F.col("first"))
    if groups.count() <= BROADCAST:
        found = rows.join(groups, twin & (F.col("size") >= small), "left")
    else:
        marks = narrow.join(groups, twin).select(F.col("row").alias("marked"), "first")
        found = rows.join(marks, F.col("row") == F.col("marked"), "left").sortWithinPartitions("row")
    return found.select("row", "page_id", "url", "html", "digest", "first")



def write_archives(pages: DataFrame, folder: str, small: int = SMALL, level: int = LEVEL) -> DataFrame:
    """Write one archive per task below ``folder`` for (page_id, url, html); returns the index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        archive, (files, path) = context.partitionId(), open_folder(folder)
        draft, out, at = f"{path}/draft-{archive:05d}-{context.taskAttemptId()}", None, 0
        for batch in (part for b in batches for part in slices(b, 3)):
            if not batch.num_rows:
                continue
            if out is None:
                files.create_dir(path, recursive=True)
                out = files.open_output_stream(draft, compression=None)
                about = pack(make_record("warcinfo", record_id(-1 - archive), f"software: stayline\r\nformat: {VERSION}\r\n".encode(),
                                         WARC_Filename=archive_name(archive), Content_Type="application/warc-fields"), level)
                out.write(about)
                at = len(about)
            offsets, lengths = [], []
            for row, page, url, html, digest, first in zip(*[c.to_pylist() for c in batch.columns[:6]]):
                data = pack(page_record(row, page, url, html.encode("utf-8", "surrogatepass"), digest, first), level)
                out.write(data)
                offsets.append(at)
                lengths.append(len(data))
                at += len(data)
            rows, firsts = batch.column(0).to_pylist(), batch.column(5).to_pylist()
            yield pa.RecordBatch.from_arrays([
                pa.array([archive] * len(rows), pa.int32()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()),
                batch.column(1), batch.column(2), batch.column(4),
                pa.array(["response" if f is None else "revisit" for f in firsts], pa.string()),
                pa.array([record_id(r) for r in rows], pa.string()),
                pa.array([None if f is None else record_id(f) for f in firsts], pa.string())],
                [c.split()[0] for c in INDEX.split(", ")])
        if out is not None:
            out.close()
            files.move(draft, f"{path}/{archive_name(archive)}")

    return written(with_originals(pages, small).mapInArrow(run, INDEX), "index")


# ---------------------------------------------------------------------------------------------------------- reading

def joined_ranges(offsets: np.ndarray, lengths: np.ndarray, gap: int = GAP, most: int = READ_BYTES) -> list[tuple[int, int]]:
    """Ascending byte ranges as runs (from, to) of rows that one read covers."""
    out, start = [], 0
    for i in range(1, len(offsets) + 1):
        if (i == len(offsets) or offsets[i] - offsets[i - 1] - lengths[i - 1] > gap
                or offsets[i] + lengths[i] - offsets[start] > most):
            out.append((start, i))
            start = i
    return out


RECORDS = ("page_id long, url string, record_type string, record_id string, refers_id string, payload_bytes long, "
           "payload_digest string, payload binary")


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the index rows, as they stand in the archives: (page_id, url, record_type, record_id, refers_id,
    payload_bytes, payload_digest, payload). Revisits hold no payload: 0 bytes, and the digest of what they repeat."""
    spark = index.sparkSession
    total = index.agg(F.sum("length")).first()[0] or 0
    parts = max(-(-total // PART_BYTES), spark.sparkContext.defaultParallelism)
    spread = (index.select("archive", "offset", "length").repartitionByRange(parts, "archive", "offset")
              .sortWithinPartitions("archive", "offset"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        opened, number = None, None
        for batch in batches:
            archive, offset, length = (batch.column(i).to_numpy() for i in range(3))
            cuts = [0, *(np.flatnonzero(archive[1:] != archive[:-1]) + 1).tolist(), len(archive)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a and archive[a] != number:
                    number = int(archive[a])
                    opened = files.open_input_file(f"{path}/{archive_name(number)}")
                for i, j in joined_ranges(offset[a:b], length[a:b]):
                    start = int(offset[a + i])
                    data = memoryview(opened.read_at(int(offset[a + j - 1] + length[a + j - 1]) - start, start))
                    yield _records([bytes(data[o:o + n]) for o, n in
                                    zip((offset[a + i:a + j] - start).tolist(), length[a + i:a + j].tolist())], payloads)

    return spread.mapInArrow(run, RECORDS)


def _records(members: list[bytes], payloads: bool) -> pa.RecordBatch:
    rows = []
    for member in members:
        fields, block = parse_record(zlib.decompress(member, 31))
        payload, digest = block.partition(END)[2], fields["warc-payload-digest"].removeprefix("sha256:")
        if fields["warc-type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"record {fields['warc-record-id']} does not match its digest")
        page = fields.get("page-id")
        rows.append((None if page is None else int(page), fields.get("warc-target-uri"), fields["warc-type"],
                     fields["warc-record-id"], fields.get("warc-refers-to"), len(payload), digest, payload if payloads else None))
    kinds = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in RECORDS.split(", ")])


def resolve_revisits(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): revisits with what they repeat, taken from the
    record they name. The records that are named are broadcast while they are few."""
    rows = written(records.select("page_id", "record_type", "record_id", "refers_id", "payload_bytes", "payload_digest"), "records")
    revisits = rows.where("refers_id is not null")
    named = settle_small(rows.join(revisits.select(F.col("refers_id").alias("record_id")).distinct(), "record_id", "left_semi")
                         .select(F.col("record_id").alias("named"), *[F.col(c).alias(f"of_{c}") for c in (
                             "page_id", "payload_bytes", "payload_digest")]), BROADCAST)
    known = rows.where("refers_id is null").select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                   F.lit(None).cast("long").alias("refers_to"))
    return known.unionByName(revisits.join(named, F.col("refers_id") == F.col("named")).select(
        "page_id", F.col("of_payload_bytes").alias("payload_bytes"), F.col("of_payload_digest").alias("payload_digest"),
        "record_type", F.col("of_page_id").alias("refers_to")))


OP12_SQL = f"""
with p as (select row_number() over () r, page_id, url, coalesce(html, '') h from pages),
d as (select *, octet_length(encode(h)) n, sha256(h) s from p),
k as (select *, n >= {SMALL} and row_number() over w > 1 again, first_value(page_id) over w head from d
      window w as (partition by s, n >= {SMALL} order by page_id nulls last, url nulls first, r))
select page_id, n::bigint payload_bytes, s payload_digest, case when again then 'revisit' else 'response' end record_type,
  case when again then head end refers_to from k
"""


@query("op12_warc", OP12_SQL)
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back by the index."""
    folder = work_path(spark, "warc")
    index = write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    return resolve_revisits(read_records(index, folder, payloads=False))

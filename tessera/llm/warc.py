"""WARC archives with revisit records.

``write_archives`` gives each page a record. Headers alone are shuffled by
payload digest to find each payload's first record; that one is written as a
response with its payload, the others as revisits with fresh headers that refer
to it. ``read_archives`` parses archives by their Content-Length fields, and
``resolve`` joins revisit records to the responses that they refer to.
"""

from __future__ import annotations

import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import arrow_limits, buckets_for, stage, text_of

MIN_REVISIT = 100
#: Payload bytes of an archive file before compression, about.
FILE_BYTES = 32 << 20
DATE = "2000-01-01T00:00:00Z"
#: Fixed by WARC 1.1.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NL = "\r\n"


def _key(page_id: Column, url: Column, digest: Column) -> Column:
    """What tells rows apart that aren't repeated rows; never null, so that one
    shuffle serves the window, the join and the files."""
    text = lambda c: F.concat(c.isNull().cast("string"), F.coalesce(c.cast("string"), F.lit("")))
    return F.sha2(F.concat_ws("|", text(page_id), digest, text(url)), 256)


def _record_id(key: Column, copy: Column) -> Column:
    h = F.sha2(F.concat_ws("|", key, copy.cast("string")), 256)
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-8"),
                    part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))


def _uri(url: Column) -> Column:
    """A header value stays on its line."""
    return F.regexp_replace(F.coalesce(url, F.lit("about:blank")), r"[\x00-\x20\x7f]", "%20")


def plan_records(pages: DataFrame, n_files: int = 1, id_col: str = "page_id", url_col: str = "url",
                 payload_col: str = "html") -> DataFrame:
    """page_id, url, payload, digest, payload_bytes, record_id, and refers_to /
    refers_uri of those that are to be revisits, dealt to ``n_files`` partitions.
    Payloads move once; who refers to whom is found from headers alone.

    A null payload is empty. Of equal payloads of ``MIN_REVISIT`` bytes or more
    the record with the smallest page_id is the response (null is the largest;
    of repeated rows, one); shorter payloads are all responses."""
    payload = text_of(payload_col)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("digest"),
                        F.octet_length(payload).cast("long").alias("payload_bytes"))
    rows = rows.withColumn("key", _key(F.col("page_id"), F.col("url"), F.col("digest")))
    order = F.struct(F.col("page_id").isNull(), "page_id", "url")
    heads = stage(rows.filter(F.col("payload_bytes") >= MIN_REVISIT).groupBy("key").agg(
        F.first("page_id").alias("page_id"), F.first("url").alias("url"), F.first("digest").alias("digest"),
        F.count(F.lit(1)).alias("n")), "warc-heads")
    firsts = heads.groupBy("digest").agg(F.min(order).alias("first"), F.sum("n").alias("n")).filter("n > 1").drop("n")
    shared = heads.select("key", "digest").join(firsts, "digest").select(
        "key", F.col("first.url").alias("first_url"),
        _key(F.col("first.page_id"), F.col("first.url"), F.col("digest")).alias("first_key"))
    copy = F.row_number().over(Window.partitionBy("key").orderBy("payload_bytes"))
    out = rows.repartition(n_files, "key").withColumn("copy", copy).join(shared, "key", "left")
    revisit = F.col("first_key").isNotNull() & ((F.col("first_key") != F.col("key")) | (F.col("copy") > 1))
    return out.select(
        "page_id", "url", "payload", "digest", "payload_bytes", _record_id(F.col("key"), F.col("copy")).alias("record_id"),
        F.when(revisit, _record_id(F.col("first_key"), F.lit(1))).alias("refers_to"),
        F.when(revisit, _uri(F.col("first_url"))).alias("refers_uri"))


def files_for(total_bytes: int, file_bytes: int = FILE_BYTES) -> int:
    return buckets_for(total_bytes, file_bytes)


def write_archives(planned: DataFrame, path: str, date: str = DATE) -> None:
    """Write the records as gzipped archives, one of each partition, under
    ``path``, through Spark's own writer (any storage that Spark reaches)."""
    revisit = F.col("refers_to").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(NL))
    block = F.concat(F.lit(f"HTTP/1.1 200 OK{NL}Content-Type: text/html; charset=utf-8{NL}Content-Length: "),
                     F.col("payload_bytes").cast("string"), F.lit(NL + NL))
    whole = F.when(revisit, block).otherwise(F.concat(block, F.col("payload")))
    length = F.octet_length(block) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    record = F.concat(
        F.lit(f"WARC/1.1{NL}"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.col("record_id")), line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", _uri(F.col("url"))),
        line("WARC-Page-ID", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", F.col("refers_to")),
                                 line("WARC-Refers-To-Target-URI", F.col("refers_uri")),
                                 line("WARC-Refers-To-Date", F.lit(date)))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")), F.lit(NL), whole)
    planned.select(record.alias("value")).write.option("lineSep", NL + NL).option("compression", "gzip").text(path)


def parse(raw: bytes):
    """(headers, block) of each record of an archive's bytes."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        heads = {k.strip().lower().decode(): v.strip().decode("utf-8", "replace")
                 for k, _, v in (x.partition(b":") for x in lines[1:])}
        size = int(heads["content-length"])
        yield heads, raw[end + 4:end + 4 + size]
        at = end + 4 + size + 4


ARCHIVED = "page_id long, record_id string, record_type string, refers_to string, uri string, payload_bytes long, payload_digest string"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record. Of responses the payload's size and SHA-256 as found
    (a payload that its header's digest belies raises); of revisits the digest
    that the header names and no size. One task holds one file at a time."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                raw = gzip.decompress(b.column(0)[i].as_py())  # of one member or one a record
                rows = []
                for h, block in parse(raw):
                    told = h["warc-payload-digest"].removeprefix("sha256:")
                    size = None
                    if h["warc-type"] == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4:]
                        size, found = len(payload), hashlib.sha256(payload).hexdigest()
                        if found != told:
                            raise ValueError(f"{h['warc-record-id']}: payload and digest differ")
                    page = h.get("warc-page-id", "")
                    rows.append((int(page) if page else None, h["warc-record-id"], h["warc-type"],
                                 h.get("warc-refers-to"), h.get("warc-target-uri"), size, told))
                cols = list(zip(*rows)) or [()] * 7
                kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=[x.split()[0] for x in ARCHIVED.split(", ")])
    arrow_limits(spark, rows=1)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    out = stage(files.mapInArrow(run, ARCHIVED), "warc-read")
    arrow_limits(spark)
    return out


def resolve(records: DataFrame) -> DataFrame:
    """``records`` with ``refers_page`` and every revisit's ``payload_bytes``
    and digest from the response that it refers to (null if there is none)."""
    full = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("refers_page"),
        F.col("payload_bytes").alias("full_bytes"), F.col("payload_digest").alias("full_digest"))
    hits = records.filter("record_type = 'revisit'").join(full, "refers_to", "left").select(
        "page_id", "record_id", "record_type", "refers_to", "uri", F.col("full_bytes").alias("payload_bytes"),
        F.col("full_digest").alias("payload_digest"), "refers_page")
    rest = records.filter("record_type <> 'revisit'").withColumn("refers_page", F.lit(None).cast("long"))
    return rest.unionByName(hits.select(*rest.columns))

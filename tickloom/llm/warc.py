"""Content-addressed WARC archive.

``write_archive`` keeps two Parquet tables: *payloads*, each distinct payload once under its SHA-256, and *headers*,
the exact header block of every record.  Of the records with equal payloads the one with the largest page id is the
``response``; the others are ``revisit`` records that refer to it.  ``read_records`` joins the two back into the
original record bytes, and ``parse`` reads those.

Digests and ids decide who stores.  A second scan then moves each row's payload once, by digest and id: the row that
stores a digest is found there, and copies of a hot payload, which have other ids, lie in other tasks.  SHA-256 is verified
over every payload read back.

Every record has the mandatory fields: type, a record id of its own (a UUID from the digest of id, payload and row), the
date and the length of its block.  The block of a revisit is empty, and its block digest is that of no bytes; the payload's
digests stand in fields of their own.

Defined cases: page ids may be of any type and are ordered as Spark orders that; a null or empty payload is zero bytes;
rows with the same page id and the same payload are one response and otherwise revisits of it (they refer to their own
id); a null page id sorts below all others, and a revisit of it refers to null; null urls are written as empty; smaller
payloads than ``least`` bytes are all responses.
"""

from __future__ import annotations

import base64
import hashlib
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from . import common

#: When the records were made, where the caller doesn't say.
DATE = "2024-01-01T00:00:00Z"
_NOTHING = f"sha256:{hashlib.sha256(b'').hexdigest()}"
_FACTS = (("url", T.StringType()), ("payload_bytes", T.LongType()), ("sha1", T.StringType()), ("sha256", T.StringType()))


def _digests(keep: bool):
    """(page_id, url, payload) to facts, and the payload's bytes where ``keep``."""

    def run(batches):
        for batch in batches:
            body = [x or b"" for x in batch.column(2).cast(pa.large_binary()).to_pylist()]
            arrays = [
                batch.column(0), batch.column(1).cast(pa.string()), pa.array([len(x) for x in body], pa.int64()),
                pa.array([base64.b32encode(hashlib.sha1(x).digest()).decode() for x in body], pa.string()), pa.array([hashlib.sha256(x).hexdigest() for x in body], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays + ([pa.array(body, pa.binary())] if keep else []), ["page_id", *(n for n, _ in _FACTS)] + ["payload"] * keep)

    return run


def _record_id(page_id: str, row: str) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.col(page_id).isNull().cast("string"), F.col(row).cast("string"), "sha256"))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-3"), part(14, 3), F.lit("-a"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))


def _ident(column: str) -> Column:
    """A page id as one line of ASCII; null where it is null."""
    return F.url_encode(F.col(column).cast("string"))


def header(kind: str = "record_type", date: str = DATE) -> Column:
    """The header block of a record, from its facts."""
    revisit = F.col(kind) == "revisit"
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    lines = [
        F.lit("WARC/1.1"),
        line("WARC-Type", F.col(kind)),
        line("WARC-Record-ID", _record_id("page_id", "row")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        line("WARC-Block-Digest", F.when(revisit, F.lit(_NOTHING)).otherwise(F.concat(F.lit("sha256:"), F.col("sha256")))),
        F.when(revisit, line("WARC-Refers-To", _record_id("first_id", "first_row"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(F.col("page_id").isNotNull(), line("X-Page-ID", _ident("page_id"))),
        F.when(revisit & F.col("first_id").isNotNull(), line("X-Refers-To-Page", _ident("first_id"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"))


def write_archive(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, date: str = DATE) -> tuple[DataFrame, DataFrame]:
    """(headers, payloads), both written to the shared folder."""
    spark = pages.sparkSession
    common.small_batches(spark)
    kind = pages.schema[page_id].dataType
    facts_schema = T.StructType([T.StructField("page_id", kind), *(T.StructField(n, t) for n, t in _FACTS)])
    chosen = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(payload).alias("payload"))
    written = common.materialize(chosen.mapInArrow(_digests(False), facts_schema).withColumn("row", F.monotonically_increasing_id()), "warc-facts")
    large = F.col("payload_bytes") >= least
    best = F.struct(F.col("page_id").isNotNull().alias("known"), F.col("page_id").alias("id"), F.col("row").alias("row"))
    first = written.where(large).groupBy("sha256").agg(F.max(best).alias("first"), F.count(F.lit(1)).alias("n"))
    first = common.materialize(first.select("sha256", F.col("first.id").alias("first_id"), F.col("first.row").alias("first_row"), "n"), "warc-first")
    total = written.count()
    # a digest with a third of all rows meets its first row by broadcast
    known = common.join_hot(written.where(large), first, "sha256", "n", total)
    if least > 0:
        known = known.unionByName(written.where(~large).withColumns({"first_id": F.col("page_id"), "first_row": F.col("row"), "n": F.lit(1).cast("bigint")}))
    known = known.withColumn("record_type", F.when(F.col("row") != F.col("first_row"), "revisit").otherwise("response"))
    headers = common.materialize(known.select("page_id", "sha256", "record_type", F.encode(header(date=date), "utf-8").alias("header")), "warc-headers")
    common.discard(written)
    # the payload of a response, from whichever of its rows; of rows with one id and one payload, once
    again = chosen.mapInArrow(_digests(True), facts_schema.add("payload", T.BinaryType()))
    id_ = lambda c: F.struct(F.col(c).isNull().alias("none"), F.col(c).alias("id"))
    pick = first.select("sha256", id_("first_id").alias("own"))
    # the join has dealt the rows by both keys already, so that the second step moves nothing
    stored = again.where(large).withColumn("own", id_("page_id")).join(pick, ["sha256", "own"], "left_semi")
    stored = stored.dropDuplicates(["sha256", "own"]).select("sha256", "payload")
    if least > 0:
        stored = stored.unionByName(again.where(~large).dropDuplicates(["sha256"]).select("sha256", "payload"))
    payloads = common.materialize(stored, "warc-payloads")
    common.discard(first)
    return headers, payloads


def read_records(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """Each record's bytes as first written: header block, payload (none in a revisit), two line ends."""
    p = payloads.select(F.col("sha256").alias("sha"), "payload")
    responses = headers.where(F.col("record_type") == "response").join(p, F.col("sha256") == F.col("sha"), "left").select("header", "payload")
    revisits = headers.where(F.col("record_type") == "revisit").select("header", F.lit(b"").alias("payload"))
    end = F.lit(b"\r\n\r\n")
    both = responses.unionByName(revisits)
    return both.select(F.concat("header", "payload", end).alias("record"))


def parse_record(record: bytes) -> dict:
    """Reads one record and verifies its digests; raises ValueError where they don't hold."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    field = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(field["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n" or not {"WARC-Record-ID", "WARC-Date", "WARC-Type"} <= set(field):
        raise ValueError("not a whole WARC record")
    kind, sha1 = field["WARC-Type"], field["WARC-Payload-Digest"].removeprefix("sha1:")
    if f"sha256:{hashlib.sha256(block).hexdigest()}" != field["WARC-Block-Digest"] or kind == "response" and base64.b32encode(hashlib.sha1(block).digest()).decode() != sha1:
        raise ValueError("block and digest differ")
    ident = lambda name: unquote_plus(field[name]) if name in field else None
    return {
        "page_id": ident("X-Page-ID"), "url": field["WARC-Target-URI"], "payload": block if kind == "response" else None, "payload_bytes": int(field["X-Payload-Length"]),
        "payload_digest": sha1, "record_type": kind, "refers_to": ident("X-Refers-To-Page") if kind == "revisit" else None, "record_id": field["WARC-Record-ID"], "refers_to_record": field.get("WARC-Refers-To"),
    }


def parse(records: DataFrame, payload: bool = True, id_type: T.DataType | str = "bigint") -> DataFrame:
    """page_id, url, payload (null in a revisit), payload_bytes, payload_digest, record_type, refers_to, and the records'
    own ids: record_id, refers_to_record."""
    fields = [("page_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("record_id", pa.string()), ("refers_to_record", pa.string())] + [("payload", pa.binary())] * payload

    def run(batches):
        for batch in batches:
            found = [parse_record(x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in found], t) for n, t in fields], [n for n, _ in fields])

    common.small_batches(records.sparkSession)
    found = records.select("record").mapInArrow(run, ", ".join(f"{n} {'bigint' if t == pa.int64() else 'binary' if t == pa.binary() else 'string'}" for n, t in fields))
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages")
    headers, payloads = write_archive(pages)
    found = parse(read_records(headers, payloads), payload=False, id_type=pages.schema["page_id"].dataType)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = r"""
WITH p AS (SELECT page_id, row_number() OVER (ORDER BY page_id) AS rn, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, rn, octet_length(b) AS payload_bytes, sha1(b) AS h, sha256(b) AS strong FROM p),
f AS (SELECT *, max(page_id) OVER (PARTITION BY strong) AS top, row_number() OVER (PARTITION BY strong ORDER BY page_id DESC NULLS LAST, rn DESC) AS k FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[CAST((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT) + 1]), '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN top END AS refers_to
FROM f
"""

"""WARC archives with revisit resolution.

``capture`` turns rows (id, target, payload) into record headers and payloads;
``resolve_revisits`` shuffles the headers (never the payloads) by payload digest and
joins each repeat to the record that keeps the payload; ``write_archive`` writes a
gzip-compressed archive with fresh headers through Spark's own text writer (a record is
one value, the blank line that ends a WARC record is the separator), so files are
committed atomically on any file system and a lost executor's files are written again;
``read_archive`` parses archives back by Content-Length, so payloads may hold anything.

Defined cases: a null payload is empty; a null target is written as ``urn:none``, control
characters and blanks in a target are percent-encoded; payloads under ``min_bytes``
are always responses; a record without an id is always a response, nothing refers to it;
rows that repeat the id of the response are responses too; an empty table gives an empty
archive.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT_BYTES = 100
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_URN = "urn:x-record:"
END = "\r\n\r\n"
EPOCH = "2020-01-01T00:00:00Z"


def capture(rows: DataFrame, id_col: str, target_col: str, payload_col: str) -> DataFrame:
    """(record_id, target, payload, payload_bytes, payload_digest) of each row."""
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit(""))
    target = F.regexp_replace(F.coalesce(F.col(f"`{target_col}`").cast("string"), F.lit("urn:none")),
                              r"[\x00-\x20\x7f]", "%20")
    return rows.select(
        F.col(f"`{id_col}`").cast("long").alias("record_id"), target.alias("target"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload.cast("binary"), 256).alias("payload_digest"))


def resolve_revisits(headers: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``headers`` with refers_to: the smallest record_id of the same payload digest, null
    for the response itself and for payloads under ``min_bytes``.

    Digests are grouped with map-side partial minima, so a payload held by a third of the
    records is one row per task; the join back is an equi-join that AQE splits."""
    big = F.col("payload_bytes") >= min_bytes
    first = (headers.where(big & F.col("record_id").isNotNull()).groupBy("payload_digest")
             .agg(F.min("record_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
             .where("copies > 1").select("payload_digest", "first_id"))
    joined = headers.join(first, "payload_digest", "left")
    is_revisit = big & (F.col("record_id") > F.col("first_id"))
    return joined.withColumn("refers_to", F.when(is_revisit, F.col("first_id"))).drop("first_id")


def _record(payload: Column) -> Column:
    """A whole record, without its closing blank line: fresh headers, then the block. A
    revisit has an empty block and names the record that holds the payload."""
    rid = F.coalesce(F.col("record_id").cast("string"), F.lit("none"))
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, F.lit("")).otherwise(payload)
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit(f"WARC-Record-ID: <{RECORD_URN}"), rid, F.lit(">")),
        F.lit(f"WARC-Date: {EPOCH}"),
        F.concat(F.lit("WARC-Target-URI: "), F.col("target")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
        F.when(revisit, F.concat(F.lit(f"WARC-Refers-To: <{RECORD_URN}"), F.col("refers_to").cast("string"),
                                 F.lit(f">\r\nWARC-Profile: {PROFILE}"))),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def write_archive(records: DataFrame, path: str) -> None:
    """Write (record_id, target, payload, payload_digest, refers_to) rows as archive files,
    one per partition; a file's size follows the partition's."""
    records.select(_record(F.col("payload")).alias("value")).write.mode("overwrite").option(
        "lineSep", END).option("compression", "gzip").text(path)


_PARSED = ("record_id long, target string, record_type string, refers_to long, header_digest string, "
           "payload_bytes long, payload_digest string")


def _lines(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a decompressed archive."""
    at, sep = 0, END.encode()
    while at < len(data):
        end = data.index(sep, at)
        first, *fields = data[at:end].decode("utf-8", "replace").split("\r\n")
        if first != VERSION:
            raise ValueError(f"not a record at byte {at}: {first[:40]!r}")
        head = {k.lower(): v for k, _, v in (f.partition(": ") for f in fields)}
        start, size = end + len(sep), int(head["content-length"])
        block = data[start:start + size]
        if len(block) != size:
            raise ValueError(f"a record at byte {at} is cut short")
        yield head, block
        at = start + size + len(sep)


def _number(urn: str | None) -> int | None:
    found = (urn or "").strip("<>").removeprefix(RECORD_URN)
    return None if found in ("", "none") else int(found)


def read_archive(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of the archive files under ``path``: header fields, and size and digest
    taken anew from each block (null for revisits, which hold none)."""
    import hashlib

    schema = _PARSED + (", payload string" if with_payload else "")
    names = [f.split(" ")[0] for f in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                raw = gzip.decompress(content.as_py())
                rows = []
                for head, block in _lines(raw):
                    revisit = head["warc-type"] == "revisit"
                    digest = None if revisit else hashlib.sha256(block).hexdigest()
                    row = [_number(head["warc-record-id"]), head["warc-target-uri"], head["warc-type"],
                           _number(head.get("warc-refers-to")), head["warc-payload-digest"].removeprefix("sha256:"),
                           None if revisit else len(block), digest]
                    rows.append(row + ([block.decode("utf-8", "replace")] if with_payload else []))
                cols = list(zip(*rows)) if rows else [[] for _ in names]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(cols, types)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, schema)


def with_revisits_resolved(records: DataFrame) -> DataFrame:
    """Size and digest of the full payload for every record: a response's own, a revisit's
    from the response it refers to (one row per response of that id)."""
    held = (records.where("record_type = 'response' and record_id is not null")
            .groupBy(F.col("record_id").alias("held_id"), F.col("payload_digest").alias("held_digest"))
            .agg(F.max("payload_bytes").alias("held_bytes")))
    hit = (F.col("refers_to") == F.col("held_id")) & (F.col("header_digest") == F.col("held_digest"))
    joined = records.join(held, hit, "left")
    return joined.select(
        "record_id", "target", "record_type", "refers_to",
        F.coalesce("payload_bytes", "held_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "held_digest").alias("payload_digest"))


def deduplicate(rows: DataFrame, id_col: str, target_col: str, payload_col: str, path: str,
                min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write one record per row to archives under ``path``: first as captured (all
    responses), then, with revisits resolved from the headers read back, the deduplicated
    archives. Returns the latter read back, revisits resolved."""
    spark = rows.sparkSession
    captured = capture(rows, id_col, target_col, payload_col)
    raw = f"{path}/captured"
    write_archive(captured.withColumn("refers_to", F.lit(None).cast("long")), raw)
    headers = read_archive(spark, raw).select("record_id", "header_digest", "payload_bytes").select(
        "record_id", "payload_bytes", F.col("header_digest").alias("payload_digest"))
    resolved = (resolve_revisits(headers, min_bytes).where("refers_to is not null")
                .select(F.col("record_id").alias("_id"), F.col("payload_digest").alias("_digest"),
                        F.col("refers_to").alias("_to")).distinct())
    hit = (F.col("record_id") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest"))
    records = captured.join(resolved, hit, "left").withColumn("refers_to", F.col("_to"))
    out = f"{path}/deduplicated"
    write_archive(records, out)
    return with_revisits_resolved(read_archive(spark, out))

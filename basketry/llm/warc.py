"""WARC archives: writing, reading, and assembling captures.

Writing: a page gives a request, a response (or, for a payload that another page
carries, a revisit) and a metadata record; the request and the metadata name the
capture's record in `WARC-Concurrent-To`.  Spark's text writer lays the archives
down, so any store Spark can write to will do, and lost tasks are repeated by its
commit protocol.

Reading: archives are parsed record by record along `Content-Length`; nothing in a
payload can end a record.  A transaction is put together by joining its records
through the concurrent-to identifiers, whichever side names the other, and comes out
as one nested row; a record without a capture comes out as a row of its own.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import ROW, pinned, stored, with_row_id
from .graph import join_few

# The format's version line and line end.
VERSION = "WARC/1.1"
EOL = "\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 16 << 20

RECORD = (
    "record_id string, record_type string, concurrent_to string, target_uri string, "
    "refers_to string, payload_digest string, headers map<string,string>, "
    "head binary, payload binary, concurrent array<string>"
)

# The types of records that hold what was captured.
CAPTURED = ("response", "revisit", "resource")


def _record_id(kind: str, key: Column) -> Column:
    """A name-based identifier; equal pages give equal identifiers in every run."""
    h = F.md5(F.concat_ws(":", F.lit(kind), key.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(headers: list[tuple[str, Column]], *block: Column) -> Column:
    lines: list[Column] = [F.lit(VERSION)]
    for name, value in headers:
        lines.append(F.concat(F.lit(f"{name}: "), value))  # NULL values are skipped
    length = reduce(Column.__add__, [F.octet_length(part) for part in block])
    lines.append(F.concat(F.lit("Content-Length: "), length.cast("string")))
    return F.concat(F.concat_ws(EOL, *lines), F.lit(EOL * 2), *block)


def _one_line(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\r\n]", "%0A")


def base32_sha1(data: Column) -> Column:
    """The SHA-1 of binary data in base 32: five bytes give eight digits."""
    digest = F.sha1(data)
    groups = [
        F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)
    ]
    return F.translate(
        F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def write_archives(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write all pages as gzip-compressed archives of about `archive_bytes` each.

    Of equal payloads the page with the largest id is the response and the others
    revisit it; NULL payloads are empty payloads.  Ids should be unique; rows that
    repeat an id are kept as captures of their own, and of those that tie for the
    response the one with the larger row id is it.  A NULL id or URL is written
    as an empty value.
    """
    payload = F.coalesce(F.col(html_column).cast("string"), F.lit(""))
    pages, row = pinned(pages), "_row"
    while row in pages.columns:
        row += "_"
    rows = with_row_id(pages, row).select(
        F.col(id_column).cast("bigint").alias("_id"),
        F.col(url_column).cast("string").alias("_url"),
        payload.alias("_payload"),
        F.col(row).alias("_row"),
    )
    # Digests and ids alone decide who responds; payloads stay out of that shuffle and are
    # read and hashed once for all steps on them.
    narrow = stored(
        rows.select(
            "_row",
            "_id",
            F.unhex(F.sha2(F.col("_payload").cast("binary"), 256)).alias("_sha"),
            F.octet_length("_payload").alias("_bytes"),
        )
    )
    best = narrow.groupBy("_sha").agg(
        F.max(F.struct("_id", "_row")).alias("_best"), F.count("*").alias("_n")
    )
    revisits = (
        narrow.join(best.where("_n > 1"), "_sha")
        .where("_row <> _best._row")
        .select("_row", F.col("_best._row").alias("_of"), F.col("_best._id").alias("_of_id"))
    )
    size = narrow.select(F.sum(F.col("_bytes") + 1500).alias("n")).first()["n"] or 0
    # Hashed on the narrow side, so that the payloads are not sorted for it.
    rows = rows.repartition(max(1, size // archive_bytes), "_row").join(
        revisits.hint("shuffle_hash"), "_row", "left"
    )
    # What several records hold is a column of its own, found once.
    rows = rows.select(
        "_row",
        "_payload",
        "_of",
        "_of_id",
        _one_line(F.col("_url")).alias("_uri"),
        _record_id("capture", F.col("_row")).alias("_own"),
        F.coalesce(F.col("_id").cast("string"), F.lit("")).alias("_page"),
    )
    uri, own, page = F.col("_uri"), F.col("_own"), F.col("_page")
    is_revisit = F.col("_of").isNotNull()
    digest = F.concat(F.lit("sha1:"), base32_sha1(F.col("_payload").cast("binary")))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}X-Page: "), page, F.lit(EOL * 2)
    )
    common = [("WARC-Date", F.lit(DATE)), ("WARC-Target-URI", uri)]
    capture = _record(
        [
            ("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
            ("WARC-Record-ID", own),
            *common,
            ("WARC-Payload-Digest", digest),
            ("WARC-Refers-To", F.when(is_revisit, _record_id("capture", F.col("_of")))),
            ("WARC-Profile", F.when(is_revisit, PROFILE)),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        head,
        F.when(is_revisit, "").otherwise(F.col("_payload")),
    )
    request = _record(
        [
            ("WARC-Type", F.lit("request")),
            ("WARC-Record-ID", _record_id("request", F.col("_row"))),
            ("WARC-Concurrent-To", own),
            *common,
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{EOL}{EOL}")),
    )
    metadata = _record(
        [
            ("WARC-Type", F.lit("metadata")),
            ("WARC-Record-ID", _record_id("metadata", F.col("_row"))),
            ("WARC-Concurrent-To", own),
            *common,
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.concat(
            F.lit("page: "), page, F.lit(f"{EOL}payload-bytes: "),
            F.octet_length("_payload").cast("string"),
            F.coalesce(F.concat(F.lit(f"{EOL}refers-to-page: "), F.col("_of_id").cast("string")), F.lit("")),
            F.lit(EOL),
        ),
    )
    rows.select(F.explode(F.array(request, capture, metadata)).alias("value")).write.option(
        "lineSep", EOL * 2
    ).option("compression", "gzip").text(path)


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of one archive, gzip-compressed or plain.

    The values of a header that is repeated are joined by line feeds, which no value
    holds.  An archive that ends within a record is an error, not a shorter record.
    """
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            raise ValueError(f"the archive ends within the headers of the record at byte {at}")
        lines = data[at:end].decode("utf-8", "replace").split(EOL)[1:]
        headers: dict[str, str] = {}
        for name, _, value in (line.partition(":") for line in lines):
            name, value = name.strip().lower(), value.strip()
            headers[name] = f"{headers[name]}\n{value}" if name in headers else value
        begun, at = at, end + 4 + int(headers.get("content-length") or 0)
        if at > len(data):
            raise ValueError(f"the archive ends {at - len(data)} bytes before the record at byte {begun} does")
        yield headers, data[end + 4 : at]


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in RECORD.split(", ")]

    def first(headers: dict[str, str], name: str) -> str | None:
        return headers[name].split("\n")[0] if name in headers else None

    for batch in batches:
        for content in batch["content"]:
            rows, held = [], 0
            for headers, block in parse_archive(content):
                head, found, payload = block, False, b""
                if headers.get("content-type", "").startswith("application/http"):
                    head, found, payload = block.partition(b"\r\n\r\n")
                named = headers.get("warc-concurrent-to")
                rows.append(
                    (
                        *(first(headers, f"warc-{name}") for name in (
                            "record-id", "type", "concurrent-to", "target-uri", "refers-to", "payload-digest"
                        )),
                        headers, head, payload if found else b"", named.split("\n") if named else [],
                    )
                )
                held += len(block)
                if held > 4 << 20:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=columns)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all archives below `path`, in no particular order."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(_parsed, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: (record_id, capture, request, metadata, concurrent).

    `capture` is a response, revisit or resource.  `concurrent` holds all other records that
    name it in one of their `WARC-Concurrent-To` headers, or that it names, ordered by type and
    id, each once; `request` and `metadata` are the first of these types, NULL where there is
    none.  A record beside several captures comes with each of them.  A record beside none (its
    capture is absent, or it names nothing) gives a row whose `capture` is NULL, with its own id
    and itself in `concurrent`.  Captures that repeat an id stay rows of their own, with the
    same records beside them; a NULL id is named by nothing.  No records give no rows.

    Scale: links are found and checked on ids alone; records travel twice, captures once.  All
    records of a capture meet, as they come out in one row.
    """
    records = pinned(records)
    row = ROW
    while row in records.columns:
        row += "_"
    fields = F.struct(*records.columns)
    is_capture = F.coalesce(F.col("record_type").isin(*CAPTURED), F.lit(False))
    found, others = records.where(is_capture), with_row_id(records, row).where(~is_capture)
    ids = found.where("record_id IS NOT NULL").select(F.col("record_id").alias("_to")).distinct()
    forward = others.select(row, F.explode(F.array_distinct("concurrent")).alias("_to"))
    named = found.select(F.col("record_id").alias("_to"), F.explode("concurrent").alias("record_id")).distinct()
    # Where both name each other, the link is there already.
    twice = F.coalesce(F.array_contains("concurrent", F.col("_to")), F.lit(False))
    backward = others.select(row, "record_id", "concurrent").join(named, "record_id").where(~twice)
    links = stored(
        forward.unionByName(backward.select(row, "_to")).join(ids, "_to", "left_semi")
    )
    alone = stored(others.select(row).join(links.select(row).distinct(), row, "left_anti"))
    in_order = F.array_sort(
        F.collect_list("_record"),
        lambda a, b: F.when(_place(a) < _place(b), -1).when(_place(a) > _place(b), 1).otherwise(0),
    )
    beside = (
        others.select(row, fields.alias("_record"))
        .join(links, row)
        .groupBy(F.col("_to").alias("record_id"))
        .agg(in_order.alias("concurrent"))
    )
    together = found.select("record_id", fields.alias("capture")).join(beside, "record_id", "left")
    single = join_few(others.select(row, "record_id", fields.alias("_record")), alone, row, "left_semi").select(
        "record_id", F.array("_record").alias("concurrent")
    )

    def first(kind: str) -> Column:
        return F.get(F.filter("concurrent", lambda r: r["record_type"] == kind), F.lit(0)).alias(kind)

    return together.unionByName(single, allowMissingColumns=True).select(
        "record_id", "capture", first("request"), first("metadata"), F.coalesce("concurrent", F.array()).alias("concurrent")
    )


def _place(record: Column) -> Column:
    """What records beside a capture are ordered by."""
    return F.concat_ws("\n", F.coalesce(record["record_type"], F.lit("")), F.coalesce(record["record_id"], F.lit("")))


def metadata_field(name: str) -> Column:
    """A field of a capture's metadata record, NULL where it has none."""
    return F.nullif(
        F.regexp_extract(F.decode("metadata.head", "UTF-8"), rf"(?m)^{name}: ([^\r\n]*)", 1), F.lit("")
    )

"""Content-addressed web archive.

``store`` keeps two tables.  ``payloads`` has each distinct payload once, compressed, under its SHA-256
and length.  ``headers`` has the exact header block of every record, with the digest that leads to its
payload.  Records are put together again by joins: ``export`` writes WARC files, ``read`` parses
WARC files, ``resolve`` gives every record its whole payload's length and digest and fails if bytes
do not have the digest their header states.

Of records with equal payloads of at least ``min_bytes`` bytes, the one with the largest id is the
response and holds the bytes; the others are revisits that refer to it.

Cases: a null payload is empty; a null or broken address leaves its header line out or loses its
line breaks; rows with the same id and payload as the response are responses too (their bytes are
stored once); rows with one id and different payloads are records of their own, each referred to by
the revisits of its payload; an id of null is never preferred; an empty table gives an archive without records;
other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritill.llm.common import per_row, stored
from veritill.session import scratch_dir

BREAK = "\r\n"
_BREAKS = re.compile(r"[\r\n]+")
#: Bytes of payload per WARC file, about.
FILE_BYTES = 32 << 20


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: four times ten hex digits are eight base32 digits each."""
    digits, letters = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    code = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(code, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), digits, letters)


def _packed(pages: DataFrame, id_column: str, address: str, payload: str) -> DataFrame:
    """Digests of each payload, and its bytes compressed for the way to the store."""

    def work(compressor, ids, addresses, payloads):
        raw = [(text or "").encode() for text in payloads]
        return [
            ids,
            [None if a is None else _BREAKS.sub("", a) for a in addresses],
            [len(x) for x in raw],
            [hashlib.sha256(x).hexdigest() for x in raw],
            [base64.b32encode(hashlib.sha1(x).digest()).decode() for x in raw],
            [compressor.compress(x) for x in raw],
        ]

    def ready():
        import zstandard

        return zstandard.ZstdCompressor(level=3)

    schema = "page_id bigint, address string, bytes bigint, sha256 string, sha1 string, packed binary"
    return per_row(pages.withColumn(id_column, F.col(id_column).cast("bigint")), [id_column, address, payload], schema, work, ready)


def _header(record_type: Column) -> Column:
    def urn(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))

    revisit = record_type == "revisit"
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), record_type),
        F.concat(F.lit("WARC-Record-ID: "), F.coalesce(urn(F.col("page_id")), F.lit("<urn:page:none>"))),
        F.concat(F.lit("WARC-Target-URI: "), F.col("address")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("holder")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
    ]
    return F.concat_ws(BREAK, *lines)


def store(
    pages: DataFrame, min_bytes: int = 0, id_column: str = "page_id", address: str = "url", payload: str = "html"
) -> tuple[DataFrame, DataFrame]:
    """Write both tables to the shared folder and return (headers, payloads) read from there."""
    digested = _packed(pages, id_column, address, payload)
    thin = stored(digested.drop("packed"), "warc-digests")
    holders = thin.groupBy("sha256", "bytes").agg(F.max("page_id").alias("holder"))
    # a digest that a third of the rows share is a skewed join, which is split at run time
    record_type = F.when(
        (F.col("bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("holder")), F.lit("revisit")
    ).otherwise(F.lit("response"))
    headers = (
        thin.join(holders, ["sha256", "bytes"])
        .withColumn("record_type", record_type)
        .select("page_id", "record_type", _header(F.col("record_type")).alias("header"), "sha256", "bytes")
    )
    # equal digests are equal bytes: one copy per map task is shuffled, and one stays
    payloads = digested.groupBy("sha256", "bytes").agg(F.first("packed").alias("packed"))
    return stored(headers, "warc-headers"), stored(payloads, "warc-payloads")


def records(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """Original records: each exact header with the bytes that follow it in a WARC file."""
    responses = headers.where(F.col("record_type") == "response").join(payloads, ["sha256", "bytes"])
    revisits = headers.where(F.col("record_type") == "revisit")

    def work(unpacker, heads, packed):
        return [heads, [unpacker.decompress(x).decode() for x in packed]]

    def ready():
        import zstandard

        return zstandard.ZstdDecompressor()

    whole = per_row(responses, ["header", "packed"], "header string, body string", work, ready)
    return whole.unionAll(revisits.select("header", F.lit("").alias("body")))


def export(headers: DataFrame, payloads: DataFrame, path: str | None = None) -> str:
    """Write compressed WARC files with Spark's own writer and return their folder.

    A record ends with two line breaks, which are the separator the text writer is given.
    """
    spark = headers.sparkSession
    path = path or scratch_dir(spark, "warc")
    n, total = payloads.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    lines = records(headers, payloads).select(F.concat("header", F.lit(BREAK * 2), "body").alias("value"))
    writer = lines.write.option("lineSep", BREAK * 2).option("compression", "gzip")
    writer.option("maxRecordsPerFile", max(1, FILE_BYTES * n // max(1, total))).text(path)
    return path


def _parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        first, *lines = content[at:end].decode().split(BREAK)
        if not first.startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = dict(line.split(": ", 1) for line in lines)
        start = end + 4
        stop = start + int(fields["Content-Length"])
        if content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError("a WARC record does not end where its header says")
        yield fields, content[start:stop]
        at = stop + 4


def read(spark: SparkSession, path: str) -> DataFrame:
    """All records of the WARC files in a folder; one file is read at a time by a task."""
    schema = "page_id bigint, record_type string, refers_to bigint, address string, stated_digest string, payload binary"
    target = pa.schema(
        [("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("address", pa.string()),
         ("stated_digest", pa.string()), ("payload", pa.binary())]
    )

    def number(urn: str | None) -> int | None:
        text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text not in ("", "none") else None

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows, size = [], 0
                for fields, body in _parse(gzip.decompress(batch.column(0)[i].as_py())):
                    rows.append((
                        number(fields["WARC-Record-ID"]), fields["WARC-Type"], number(fields.get("WARC-Refers-To")),
                        fields.get("WARC-Target-URI"), fields["WARC-Payload-Digest"].removeprefix("sha1:"), body,
                    ))
                    size += len(body)
                    if size > 1 << 23:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), target)], schema=target)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), target)], schema=target)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, schema)


def resolve(found: DataFrame) -> DataFrame:
    """Every record read, with length and digest of its whole payload, taken from the stored bytes."""
    thin = stored(
        found.select(
            "page_id", "record_type", "refers_to", "stated_digest",
            F.octet_length("payload").cast("bigint").alias("bytes"), base32_sha1(F.col("payload")).alias("digest"),
        ),
        "warc-read",
    )
    responses = thin.where(F.col("record_type") == "response")
    # pages with one id may differ, so a source is known by its id and digest
    source = responses.where(F.col("page_id").isNotNull()).groupBy(F.col("page_id").alias("source"), F.col("digest").alias("source_digest")).agg(
        F.max("bytes").alias("source_bytes")
    )
    found_at = (F.col("refers_to") == F.col("source")) & (F.col("stated_digest") == F.col("source_digest"))
    revisits = thin.where(F.col("record_type") == "revisit").join(source, found_at, "left")
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "stated_digest")
    everything = responses.select("page_id", "bytes", "digest", "record_type", "refers_to", "stated_digest").toDF(*columns).unionAll(
        revisits.select("page_id", "source_bytes", "source_digest", "record_type", "refers_to", "stated_digest").toDF(*columns)
    )
    right = F.col("payload_digest") == F.col("stated_digest")
    checked = F.when(right, F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("wrong or missing payload of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("?"))))
    )
    return everything.withColumn("payload_digest", checked).drop("stated_digest")

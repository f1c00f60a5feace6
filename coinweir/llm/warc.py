"""WARC archives: written by Spark, read back by Spark, and put together again, one nested row for each capture.

A capture is a response (or a revisit, where the payload was archived before) with the request that asked for it and metadata about it. The records name
each other in `WARC-Concurrent-To`, in either direction, and may lie in any archive and any order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinweir.llm.tables import stored

# Fixed values of the format: version line, line end, what follows a record's block, and the profile of a revisit of an equal payload.
VERSION = "WARC/1.1"
END = "\r\n"
AFTER_RECORD = END * 2
EQUAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Records in one archive at most, so that the one task that reads it back has bounded work.
RECORDS_PER_ARCHIVE = 150_000

#: Bytes of payload handed on by a reading task at once.
BATCH_BYTES = 4 << 20

RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("captured_at", T.StringType()),
        T.StructField("concurrent_to", T.ArrayType(T.StringType())),
        T.StructField("refers_to", T.StringType()),
        T.StructField("declared_digest", T.StringType()),
        T.StructField("http_head", T.StringType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.BinaryType()),
        T.StructField("complete", T.BooleanType()),
    ]
)


def _id_of(*parts: Column) -> Column:
    """A record id made from what tells the record apart."""
    digits = F.md5(F.concat_ws(":", *[part.cast("string") for part in parts]))
    return F.concat(
        F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(digits, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">")
    )


def _line(name: str, value: Column) -> Column:
    """A header line; nothing where the value is null. Line breaks in a value are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(END)), F.lit(""))


def _record(kind: str, record_id: Column, uri: Column, at: str, more: list[Column], media: str, block: Column) -> Column:
    return F.concat(
        F.lit(f"{VERSION}{END}WARC-Type: {kind}{END}"),
        _line("WARC-Record-ID", record_id),
        _line("WARC-Target-URI", uri),
        _line("WARC-Date", F.lit(at)),
        *more,
        _line("Content-Type", F.lit(media)),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
        block,
    )


def decided(pages: DataFrame, id_column: str, url_column: str, payload_column: str, least_bytes: int) -> DataFrame:
    """The pages as `id`, `url`, `payload` with `record_id`, the `digest` of the payload, and `refers_to`, the record id of the response that a page revisits,
    or null if it is a response itself.

    Among equal payloads of at least `least_bytes`, the page with the largest id is the response (a null id is the smallest; of several rows with that id, one).
    Pages are written once to the shared folder with a number of their own, so that repeated rows can be told apart however often
    a task runs. Payloads are compared by SHA-256; the group's largest row is found in tasks before the shuffle, and adaptive execution can split the
    join however many pages share a payload.
    """
    rows = pages.select(
        F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url"), F.coalesce(F.col(payload_column), F.lit("")).alias("payload")
    )
    rows = stored(
        rows.withColumns(
            {
                "row": F.monotonically_increasing_id(),
                "digest": F.sha1("payload"),
                "same": F.when(F.octet_length("payload") >= least_bytes, F.unhex(F.sha2("payload", 256))),
            }
        ),
        compression="zstd",
    )
    top = rows.filter("same IS NOT NULL").groupBy("same").agg(F.max(F.struct("id", "row")).alias("top"), F.count("*").alias("n"))
    # stored, so that the join gets shuffles of its own on both sides, which adaptive execution can split; small payloads need no join
    top = stored(top.filter("n > 1").select("same", F.col("top.row").alias("top")))
    small = rows.filter("same IS NULL").withColumn("top", F.lit(None).cast("long"))
    return rows.filter("same IS NOT NULL").join(top, "same", "left").unionByName(small).select(
        "id",
        "url",
        "payload",
        "digest",
        _id_of(F.lit("response"), F.col("row")).alias("record_id"),
        F.when(F.col("top") != F.col("row"), _id_of(F.lit("response"), F.col("top"))).alias("refers_to"),
        "row",
    )


def write_archives(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    least_bytes: int = 1000,
    captured_at: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write a request, a response or revisit, and a metadata record for every page into gzip archives below the new folder `path`.

    The payload is the text in UTF-8 as it is; null is empty. See `decided` for which pages revisit another. A null url has no target, a null id
    no `page` field. A record and the blank lines after it are one row of Spark's text writer, so nothing of it passes through Python, a task that is
    lost is written anew by another, and an empty table leaves no archive.
    """
    rows = decided(pages, id_column, url_column, payload_column, least_bytes)
    url, ends = F.col("url"), F.lit(END)
    host = F.regexp_extract(url, r"^[^:/?#]*://([^/?#]*)", 1)
    target = F.regexp_extract(url, r"^[^:/?#]*://[^/?#]*([^#]*)", 1)
    target = F.regexp_replace(F.when(F.startswith(target, F.lit("/")), target).otherwise(F.concat(F.lit("/"), target)), r"\s", "%20")
    asks = F.concat(F.lit("GET "), F.coalesce(target, F.lit("/")), F.lit(f" HTTP/1.1{END}"), _line("Host", host), ends)
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"),
        _line("Content-Length", F.octet_length("payload").cast("string")),
        ends,
    )
    digest = _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    beside = _line("WARC-Concurrent-To", F.col("record_id"))
    first = [digest, _line("WARC-Profile", F.lit(EQUAL_PAYLOAD)), _line("WARC-Refers-To", F.col("refers_to"))]
    http = "application/http;msgtype="

    def own(kind: str) -> Column:
        return _id_of(F.lit(kind), F.col("row"))

    records = [
        _record("request", own("request"), url, captured_at, [beside], f"{http}request", asks),
        F.when(
            F.col("refers_to").isNull(),
            _record("response", F.col("record_id"), url, captured_at, [digest], f"{http}response", F.concat(head, "payload")),
        ).otherwise(_record("revisit", F.col("record_id"), url, captured_at, first, f"{http}response", head)),
        _record(
            "metadata", own("metadata"), url, captured_at, [beside], "application/warc-fields", _line("page", F.col("id").cast("string"))
        ),
    ]
    (
        rows.select(F.explode(F.array(*records)).alias("value"))
        .write.option("lineSep", AFTER_RECORD)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_ARCHIVE)
        .text(path)
    )


def _parsed(head: list[bytes], block: bytes | None) -> tuple:
    """A record as a row of `RECORD`; `block` is None where the archive ends within the record."""
    named: dict[str, list[str]] = {}
    for line in head:
        name, _, value = line.partition(b":")
        named.setdefault(name.strip().lower().decode("utf-8", "replace"), []).append(value.strip().decode("utf-8", "replace"))

    def one(name: str) -> str | None:
        return named.get(name, [None])[0]

    kind, media = one("warc-type"), one("content-type") or ""
    http, fields, payload = None, None, None
    if block is not None:
        if media.startswith("application/http"):
            head_bytes, _, payload = block.partition(b"\r\n\r\n")
            http = head_bytes.decode("utf-8", "replace")
        elif media.startswith("application/warc-fields"):
            pairs = (line.split(":", 1) for line in block.decode("utf-8", "replace").splitlines() if ":" in line)
            fields = [(name.strip(), value.strip()) for name, value in pairs]
        else:
            payload = block
    if kind not in ("response", "resource"):
        payload = None
    links = named.get("warc-concurrent-to", [])
    digest = one("warc-payload-digest")
    return (
        one("warc-record-id"), kind, one("warc-target-uri"), one("warc-date"), links, one("warc-refers-to"), digest, http, fields, payload, block is not None,
    )


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of archives, in their order, to records. A record's block is as long as its head says, whatever is in it."""
    schema = pa.schema(
        [
            pa.field(field.name, pa.list_(pa.string()) if field.name == "concurrent_to" else pa.map_(pa.string(), pa.string()) if field.name == "fields"
                     else pa.binary() if field.name == "payload" else pa.bool_() if field.name == "complete" else pa.string())
            for field in RECORD
        ]
    )
    held, size = [], 0

    def out() -> pa.RecordBatch:
        nonlocal held, size
        columns = zip(*held, strict=True) if held else [[] for _ in schema]
        made = pa.RecordBatch.from_arrays([pa.array(list(values), field.type) for values, field in zip(columns, schema, strict=True)], schema=schema)
        held, size = [], 0
        return made

    source = head = block = None
    left = 0

    def emit(whole: bool) -> None:
        nonlocal head, block, size
        data = b"".join(block) if whole else None
        held.append(_parsed(head, data))
        size += 200 + len(data or b"")
        head = block = None

    for batch in batches:
        for name, start, whole, value in zip(*[batch.column(at).to_pylist() for at in range(4)], strict=True):
            if start or not whole:
                raise ValueError(f"{name} is divided over tasks; compress it, for a record can begin in one part and end in another")
            if name != source:
                if head is not None:
                    emit(False)
                source = name
            if block is not None:
                block.append(value[:left] if len(value) >= left else value + b"\n")
                left -= len(block[-1])
                if left <= 0:
                    emit(True)
            elif head is not None:
                line = value.rstrip(b"\r")
                if line:
                    head.append(line)
                else:
                    lengths = [h.partition(b":")[2].strip() for h in head if h[:15].lower() == b"content-length:"]
                    if lengths and lengths[0].isdigit():
                        left, block = int(lengths[0]), []
                        if not left:
                            emit(True)
                    else:
                        emit(False)
            elif value.startswith(b"WARC/"):
                head = []
            if size >= BATCH_BYTES:
                yield out()
    if head is not None:
        emit(False)
    yield out()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below `path`, `RECORD` and two columns more: `payload_bytes` and `payload_digest` (SHA-1 in lower-case hex) of what is there.

    Records are found by their lengths, so payloads may hold anything, also what looks like the end of a record. Spark's text reader hands the lines of an
    archive to one task in their order, from any store; gzip archives (also of one member per record) are never divided, and plain ones that Spark would
    divide stop the job. A record that its archive breaks off in, or whose length is not given, has `complete` false and no payload. Only responses and resources have a
    payload; it is what follows the HTTP head. No archive, no rows. Memory: a batch of lines, and one record.
    """
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    place = "_metadata.file_block_start"
    lines = lines.select(
        F.col("_metadata.file_path").alias("name"),
        F.col(place).alias("start"),
        (F.col("_metadata.file_block_length") == F.col("_metadata.file_size")).alias("whole"),
        F.col("value").cast("binary").alias("value"),
    )
    return lines.mapInArrow(_records, RECORD).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")}
    )


def links(records: DataFrame) -> DataFrame:
    """(record_id, capture_id): each complete request or metadata record with the response or revisit it belongs to.

    Either record may name the other, and a metadata record may name the request instead. One that names several has several rows.
    """
    whole = records.filter(F.col("complete") & F.col("record_id").isNotNull())
    named = whole.select("record_id", "record_type", F.explode("concurrent_to").alias("other"))
    captures = F.col("record_type").isin("response", "revisit", "resource")
    kinds = whole.select(F.col("record_id").alias("other"), captures.alias("captured")).distinct()
    met = named.withColumn("capture", captures).join(kinds, "other")
    direct = met.filter(F.col("capture") != F.col("captured")).select(
        F.when(F.col("capture"), F.col("other")).otherwise(F.col("record_id")).alias("record_id"),
        F.when(F.col("capture"), F.col("record_id")).otherwise(F.col("other")).alias("capture_id"),
    ).distinct()
    through = met.filter(~F.col("capture") & ~F.col("captured")).select("record_id", "other")
    through = through.join(direct.withColumnRenamed("record_id", "other"), "other").select("record_id", "capture_id")
    return direct.unionByName(through).distinct()


def _ends_of(rows: DataFrame, kind: str) -> Column:
    of_kind = F.col("record_type") == kind
    return F.min(F.when(of_kind, F.struct("record_id", *[name for name in ("target_uri", "captured_at", "http_head", "fields") if name in rows.columns])))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: all columns of the complete response or revisit record, `request` and `metadata` (its first of each, by record id; null where
    there is none), and their numbers `n_requests` and `n_metadata`.

    A record id should be unique; repeated copies of a response are rows of their own with the same companions. What is in no row is in `unassembled`.
    The records are read several times: store those of large archives first (without `payload`, if it isn't needed).
    Companions of a capture are reduced in tasks before the shuffle, so one that very many records name is no hot spot.
    """
    # maps can't be compared, so that the fields are carried as sorted pairs
    pairs = F.sort_array(F.map_entries("fields")).alias("fields")
    slim = records.select("record_id", "record_type", "target_uri", "captured_at", "concurrent_to", "http_head", "complete", pairs)
    members = slim.filter("complete").dropDuplicates(["record_id"]).join(links(slim), "record_id")
    beside = members.groupBy(F.col("capture_id").alias("record_id")).agg(
        _ends_of(members, "request").alias("request"),
        _ends_of(members, "metadata").alias("metadata"),
        F.count_if(F.col("record_type") == "request").alias("n_requests"),
        F.count_if(F.col("record_type") == "metadata").alias("n_metadata"),
    )
    captured = records.filter(F.col("complete") & F.col("record_type").isin("response", "revisit", "resource"))
    none = F.lit(0).cast("long")
    return captured.join(beside, "record_id", "left").withColumns(
        {name: F.coalesce(name, none) for name in ("n_requests", "n_metadata")}
    )


def unassembled(records: DataFrame) -> DataFrame:
    """Records that are neither a capture nor the first request or metadata of one: incomplete ones, those without a capture, further ones, other types."""
    made = assemble(records)
    used = [made.select("record_id"), *[made.select(F.col(f"{side}.record_id").alias("record_id")) for side in ("request", "metadata")]]
    held = used[0].unionByName(used[1]).unionByName(used[2]).filter("record_id IS NOT NULL").distinct()
    complete = records.filter("complete").join(held, "record_id", "left_anti").select(*records.columns)
    return complete.unionByName(records.filter("NOT complete"))


def full_payloads(captures: DataFrame) -> DataFrame:
    """Captures with the `payload_bytes` of the full payload, also where a revisit left it out, and `source`, the nested row's metadata of the response that has it
    (its own for a response). A revisit of a record that is in no archive keeps null. Captures are joined with themselves: store them first."""
    held = captures.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("bytes_there"), F.col("metadata").alias("source")
    )
    return captures.join(held, "refers_to", "left").withColumns(
        {"payload_bytes": F.coalesce("payload_bytes", "bytes_there"), "source": F.coalesce("source", "metadata")}
    ).drop("bytes_there")


def field(side: str, name: str) -> Column:
    """A field of the metadata of a nested row, the first of that name in the order of values; null if there is none."""
    return F.get(F.filter(F.col(f"{side}.fields"), lambda pair: pair["key"] == name), F.lit(0))["value"]


def oracle(least_bytes: int = 1000) -> str:
    """What `pages` come to once written, read and put together, as DuckDB SQL over the pages themselves."""
    return f"""WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
grouped AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM payloads)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN payload_bytes >= {least_bytes} AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {least_bytes} AND page_id < last THEN last END AS refers_to FROM grouped"""

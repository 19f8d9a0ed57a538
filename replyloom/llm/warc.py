r"""WARC archives: writing, and normalising monolithic gzip files.

``write_archives`` writes one record a page with Spark's text writer under gzip: every file
is one gzip stream over all its records. ``normalise`` inflates each such file once, in
steps, rewrites every record as a gzip member of its own, and writes the members to new
files together with a sidecar index (file number, offset, length, record fields), so that one record
can be read without the others (``fetch``). ``read_back`` reads whole files member by member.

A payload met before is a ``revisit``: of equal payloads (SHA-1 and size) of at least ``min_bytes``
the record with the least page_id is the ``response``, the others refer to it and carry
no payload, only its digest and size.

Raw files are written through the text writer, so any file system of Spark will do. It
ends each row with a separator; here that is a zero byte, and a member that ends in one (its size
field is below 2^24) is written without it. A larger member is followed by an empty
member, which ends in one.

Edge cases: NULL html is an empty payload; NULL url an empty field; a NULL page_id is written as
``null``, sorts after all others and is never referred to; rows repeating the least page_id are
responses each; line ends in URLs are percent-encoded; other columns are ignored; an empty
table gives empty archives. One output file of the first pass must fit a task's memory; ``file_pages`` bounds its records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from replyloom.session import remove_folder, shared_folder

MIN_BYTES = 0
FILE_PAGES = 20_000
LEVEL = 6
_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_EMPTY = bytes.fromhex("1f8b080000000000" + "00ff" + "0300" + "00000000" + "00000000")


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hex: 32 characters of five bits each."""
    return F.array_join(
        F.flatten(F.transform(
            F.sequence(F.lit(0), F.lit(7)),
            lambda g: F.transform(
                F.sequence(F.lit(0), F.lit(3)),
                lambda i: F.substr(F.lit(_B32), F.call_function("shiftright", F.conv(F.substr(data, g * 5 + 1, F.lit(5)), 16, 10).cast("int"), (3 - i) * 5).bitwiseAND(31) + 1, F.lit(1)),
            ),
        )), "",
    )


def with_types(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, html, size, digest, refers_to (NULL: a response)."""
    p = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    p = p.withColumn("sha", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html").cast("bigint"))
    # only payloads met twice are looked up; sums are partial before the shuffle
    firsts = p.filter(F.col("size") >= min_bytes).groupBy("sha", "size").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").select(F.col("sha").alias("_sha"), F.col("size").alias("_size"), "_first")
    # Payloads that no other page has need no look-up and stay where they are. A bit table of fixed
    # size tells them: at most 2^19 rows of 32 bits, for 2^24 cells; a cell met by chance costs a look-up.
    cell = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 24))
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("bigint"), (cell(c) % 32).cast("int"))
    table = firsts.groupBy(F.shiftright(cell("_sha"), 5).alias("_word")).agg(F.bit_or(bit("_sha")).alias("_bits"))
    p = p.join(F.broadcast(table), F.shiftright(cell("sha"), 5) == F.col("_word"), "left")
    maybe = F.coalesce(F.col("_bits").bitwiseAND(bit("sha")) != 0, F.lit(False))
    alone = p.filter(~maybe).withColumn("_first", F.lit(None).cast("bigint"))
    looked = p.filter(maybe).join(firsts, (F.col("sha") == F.col("_sha")) & (F.col("size") == F.col("_size")), "left")
    kept = ["page_id", "url", "html", "size", "sha", "_first"]
    joined = alone.select(kept).unionByName(looked.select(kept))
    refers = F.when(F.col("_first").isNotNull() & (F.coalesce(F.col("page_id") != F.col("_first"), F.lit(True))), F.col("_first"))
    return joined.select("page_id", "url", "html", "size", base32_sha1(F.col("sha")).alias("digest"), refers.alias("refers_to"))


def record(df: DataFrame) -> Column:
    """A record as text, without the last line end, which the writer's separator adds."""
    crlf = F.lit("\r\n")
    ident = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    response = F.col("refers_to").isNull()
    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(response, "response").otherwise("revisit")), F.concat(F.lit("WARC-Record-ID: <urn:page:"), ident, F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), url), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")), F.concat(F.lit("X-Payload-Length: "), F.col("size").cast("string")),
    ]
    refers = F.when(response, F.lit("")).otherwise(F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">\r\n")))
    length = F.when(response, F.col("size")).otherwise(F.lit(0)).cast("string")
    return F.concat(F.concat_ws("\r\n", *lines), crlf, refers, F.lit("Content-Length: "), length, F.lit("\r\n\r\n"), F.when(response, F.col("html")).otherwise(""), crlf)


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, file_pages: int = FILE_PAGES) -> None:
    """Monolithic gzip files below ``path``."""
    typed = with_types(pages, min_bytes)
    typed.select(record(typed).alias("value")).write.option("compression", "gzip").option("lineSep", "\r\n").option("maxRecordsPerFile", file_pages).text(path)


def parse_stream(content: bytes, step: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(fields, payload, whole record) of each record of a gzip file of any number of members,
    inflated once and in steps."""
    pending, at = bytearray(), 0
    inflate = zlib.decompressobj(31)

    def more() -> bool:
        nonlocal at, inflate
        while True:
            if inflate.eof:
                rest = inflate.unused_data
                at -= len(rest)
                if at >= len(content):
                    return False
                inflate = zlib.decompressobj(31)
            if at >= len(content):
                return False
            data = inflate.decompress(content[at : at + step])
            at = min(at + step, len(content))
            if data:
                pending.extend(data)
                return True

    while True:
        while (head := pending.find(b"\r\n\r\n")) < 0:
            if not more():
                if bytes(pending).strip():
                    raise ValueError("archive ends inside a record")
                return
        fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in pending[:head].decode().split("\r\n")[1:])
        end = head + 4 + int(fields["Content-Length"]) + 4
        while len(pending) < end:
            if not more():
                raise ValueError("archive ends inside a record")
        whole = bytes(pending[:end])
        del pending[:end]
        yield fields, whole[head + 4 : end - 4], whole


def member(data: bytes) -> bytes:
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    out = c.compress(data) + c.flush()
    return out if out[-1] == 0 else out + _EMPTY


def split_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head = data.index(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in data[:head].decode().split("\r\n")[1:])
    return fields, data[head + 4 : head + 4 + int(fields["Content-Length"])]


def members(content: bytes, step: int = 1 << 14) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of each member; an empty member belongs to the one before it."""
    at, last = 0, None
    while at < len(content):
        inflate, pos, parts = zlib.decompressobj(31), at, []
        while not inflate.eof and pos < len(content):
            chunk = content[pos : pos + step]
            parts.append(inflate.decompress(chunk))
            pos += len(chunk)
        end = pos - len(inflate.unused_data)
        data = b"".join(parts)
        if data:
            if last:
                yield last
            last = (at, end - at, data)
        elif last:
            last = (last[0], end - last[0], last[2])
        at = end
    if last:
        yield last


def _page(urn: str | None) -> str | None:
    return None if urn is None else urn[len("<urn:page:") : -1]


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    columns = [x.split(" ") for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), columns, strict=True)], names=[n for n, _ in columns])


def _batches(schema: str, rows: Iterator[tuple], size: int = 500) -> Iterator[pa.RecordBatch]:
    some = []
    for row in rows:
        some.append(row)
        if len(some) == size:
            yield _batch(schema, some)
            some = []
    if some:
        yield _batch(schema, some)


_MEMBERS = "file bigint, nth bigint, member binary"
_INDEX = "file bigint, nth bigint, offset bigint, length bigint, record_id string, record_type string, refers_to string, digest string, payload_bytes bigint"


def normalise(spark: SparkSession, path: str, out: str) -> None:
    """``out``/archive: files of one member a record, a folder for each source file; ``out``/index: where each
    record is. A source file is inflated once, and its members stay in the task that made them, in order;
    the index is read off the finished files, so it describes what is there."""

    def rewrite(batches):
        for batch in batches:
            for name, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                # the last zero byte of a member is the writer's separator
                yield from _batches(_MEMBERS, ((name, nth, member(whole)[:-1]) for nth, (_, _, whole) in enumerate(parse_stream(content.as_buffer().to_pybytes()))))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select(F.xxhash64("path").alias("file"), "content")
    made = files.mapInArrow(rewrite, _MEMBERS).sortWithinPartitions("file", "nth")
    made.select("file", F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").partitionBy("file").text(f"{out}/archive")

    def index(batches):
        for batch in batches:
            for name, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                yield from _batches(_INDEX, (
                    (name, nth, at, n, _page(f["WARC-Record-ID"]), f["WARC-Type"], _page(f.get("WARC-Refers-To")), f["WARC-Payload-Digest"].removeprefix("sha1:"), int(f["X-Payload-Length"]))
                    for nth, (at, n, data) in enumerate(members(content.as_buffer().to_pybytes())) for f, _ in [split_record(data)]
                ))

    _files(spark, out).mapInArrow(index, _INDEX).write.parquet(f"{out}/index")


_READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def read_back(spark: SparkSession, out: str, payloads: bool = True) -> DataFrame:
    """Records of normalised archives: page_id, payload_bytes, payload_digest, record_type, refers_to, payload
    (NULL for revisits or without ``payloads``). A response's size and digest are those of what was read."""
    return _files(spark, out).withColumn("places", F.lit(None).cast(_PLACES)).mapInArrow(_reader(payloads), _READ)


def fetch(spark: SparkSession, out: str, page_ids: DataFrame) -> DataFrame:
    """The records of some pages (a column ``page_id``), by the index: other members are not inflated."""
    index = spark.read.parquet(f"{out}/index").join(page_ids.select(F.col("page_id").cast("string").alias("record_id")).distinct(), "record_id")
    places = index.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("places"))
    return _files(spark, out).join(places, "file").mapInArrow(_reader(True), _READ)


_PLACES = "array<struct<offset:bigint,length:bigint>>"


def _files(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{out}/archive").select(F.regexp_extract("path", r"/file=(-?[0-9]+)/", 1).cast("bigint").alias("file"), "content")


def _reader(payloads: bool):
    def records(content: bytes, spots) -> Iterator[bytes]:
        if spots is None:
            yield from (data for _, _, data in members(content))
            return
        for s in spots:
            yield from (data for _, _, data in members(content[s["offset"] : s["offset"] + s["length"]]))

    def row(data: bytes) -> tuple:
        f, payload = split_record(data)
        ident, refers, response = _page(f["WARC-Record-ID"]), _page(f.get("WARC-Refers-To")), f["WARC-Type"] == "response"
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode() if response else f["WARC-Payload-Digest"].removeprefix("sha1:")
        return (
            None if ident == "null" else int(ident), len(payload) if response else int(f["X-Payload-Length"]), digest, f["WARC-Type"],
            None if refers is None else int(refers), payload if response and payloads else None,
        )

    def run(batches):
        for batch in batches:
            for content, spots in zip(batch.column("content"), batch.column("places").to_pylist(), strict=True):
                yield from _batches(_READ, (row(data) for data in records(content.as_buffer().to_pybytes(), spots)))

    return run


def archive(pages: DataFrame, min_bytes: int = MIN_BYTES, payloads: bool = False) -> DataFrame:
    """All steps below the shared folder; what is read back."""
    spark = pages.sparkSession
    raw, out = shared_folder(spark, "warc-raw"), shared_folder(spark, "warc")
    write_archives(pages, raw, min_bytes)
    normalise(spark, raw, out)
    remove_folder(spark, raw)
    return read_back(spark, out, payloads)

"""WARC archives with a two-level capture index.

Pages become WARC records: a response with its HTTP headers and payload, or, where the same
payload of at least ``REVISIT_BYTES`` is stored for another page, a revisit that names it. Spark's
text writer stores the records as they are, since every record ends in two line breaks and the
writer adds the second of them; any store Spark can write will do.

The index has a line per capture, sorted by key: the URL with its host reversed, then the record
id. Blocks of lines are compressed; a sparse directory holds each block's first key. A lookup
finds its block in the directory by binary search, then its line within the block, and cuts that
range out of the archive file. A batch of lookups does so for all keys at once, opening each block once and only
the archive files that it needs. Spark loads a file whole, so files are kept small; a record of
2 GB, which no Spark text reaches with its headers, could not be read back. The directory is shared in slices of bounded size.

A NULL payload is empty. Of equal payloads the page with the largest id is the response; pages
that share that id and payload are all responses, and so are all if none has an id. Pages without
an id or URL have empty ones in the records. Equal rows give equal records, each read back.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.rows import bounded
from tallyforge.sources.storage import materialize, scratch_dir

REVISIT_BYTES = 1000
#: Archive bytes per file, lines per index block, and directory rows that are shared at once.
FILE_BYTES, BLOCK_LINES, DIRECTORY_ROWS = 16 << 20, 2048, 1 << 18
#: Bytes from which a record goes to a file of large ones; and of a file at most, unless one record has more.
LARGE, MOST_BYTES = 128 << 10, 1 << 30
#: Files up to which a lookup opens them by name.
LISTED_FILES = 1 << 14
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n"


def record_id(page: Column, digest: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.url_encode(F.coalesce(page.cast("string"), F.lit(""))), F.lit(":"), digest)


def header_uri(url: Column) -> Column:
    """A URL that fits on one header and one index line."""
    broken = {"\r": "%0D", "\n": "%0A", "\t": "%09"}
    value = F.coalesce(url, F.lit(""))
    for character, escape in broken.items():
        value = F.replace(value, F.lit(character), F.lit(escape))
    return value


def records(pages: DataFrame, date: str, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """One record per page as text, without its last line break; ``pages`` is read twice."""
    rows = pages.select(
        F.col(key).alias("page"), header_uri(F.col(url)).alias("uri"), F.coalesce(payload, F.lit("")).alias("payload")
    )
    rows = rows.withColumn("bytes", F.octet_length("payload")).withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    stored = materialize(
        rows.filter(F.col("bytes") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("page").alias("first"), F.count(F.lit(1)).alias("times"))
        .filter("times > 1 AND first IS NOT NULL")
        .select("digest", "first")
    )
    joined = rows.join(bounded(stored), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))

    def line(name: str, *value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), *value, F.lit(_END))

    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}"),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.col("bytes").cast("string")),
        F.lit(_END),
    )
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    head = F.concat(
        F.lit(f"WARC/1.1{_END}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.lit("<"), record_id(F.col("page"), F.col("digest")), F.lit(">")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-Payload-Digest", F.lit("sha1:"), F.col("digest")),
        F.when(
            revisit,
            F.concat(
                line("WARC-Refers-To", F.lit("<"), record_id(F.col("first"), F.col("digest")), F.lit(">")),
                line("WARC-Profile", F.lit(PROFILE)),
            ),
        ).otherwise(""),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(_END),
    )
    return joined.select(F.concat(head, block, F.lit(_END)).alias("record"))


def write_archives(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write records under ``path``, each task's in files of about ``file_bytes``.

    Records of ``LARGE`` bytes and more go to files of their own. A file's number of records is such
    that it stays within ``MOST_BYTES`` whatever their sizes, or holds one record.
    """
    size = F.octet_length("record")
    small = size < LARGE
    rows, total, largest = records.agg(
        F.count_if(small), F.sum(F.when(small, size)), F.max(F.when(~small, size))
    ).first()
    per_file = rows * file_bytes // max(1, total or 0)
    _write_text(records.filter(small) if largest else records, path, min(per_file, MOST_BYTES // LARGE))
    if largest:
        _write_text(records.filter(~small), path, min(file_bytes // LARGE, MOST_BYTES // largest))


def _write_text(records: DataFrame, path: str, per_file: int) -> None:
    writer = records.write.mode("append").option("lineSep", _END).option("maxRecordsPerFile", max(1, per_file))
    writer.text(path)


def _headers(text: bytes) -> dict[str, str]:
    pairs = (line.partition(": ") for line in text.decode().split(_END)[1:])
    return {name: value for name, _, value in pairs}


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


def parse_record(data: bytes, begin: int = 0) -> tuple[Record, int]:
    """The record at ``begin`` and the place after it."""
    gap = b"\r\n\r\n"
    block = data.index(gap, begin) + len(gap)
    headers = _headers(data[begin : block - len(gap)])
    end = block + int(headers["Content-Length"])
    payload = data.index(gap, block) + len(gap)
    return Record(headers, _headers(data[block : payload - len(gap)]), data[payload:end]), end + len(gap)


def capture_key(uri: str, record: str) -> str:
    """``net,example,www)/path`` of a URL, and the record's id."""
    scheme, found, rest = uri.partition("://")
    if not found:
        return f"{uri}\t{record}"
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = ",".join(reversed(rest[:cut].lower().split(".")))
    return f"{host}){rest[cut:]}\t{record}"


def _files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(paths).select("path", "content")


def wanted_files(index: CaptureIndex, by_file: DataFrame, files: int) -> DataFrame:
    """The archive files that ``by_file`` lists: up to LISTED_FILES by name, more by a scan of all."""
    spark = by_file.sparkSession
    if 0 < files <= LISTED_FILES:
        return _files(spark, [row["path"] for row in by_file.select("path").collect()])
    return _files(spark, index.archives)


@dataclass(frozen=True)
class CaptureIndex:
    """Written index: ``blocks`` (``first``, ``last``, ``lines``) and the archives they point to."""

    blocks: DataFrame
    archives: str

    @property
    def directory(self) -> DataFrame:
        return self.blocks.select("block", "first", "last")


def build_index(spark: SparkSession, archives: str, block_lines: int = BLOCK_LINES) -> CaptureIndex:
    """Scan the archives once and write their index."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                path, data = batch.column("path")[row].as_py(), batch.column("content")[row].as_py()
                keys, lines, at = [], [], 0
                while at < len(data):
                    record, end = parse_record(data, at)
                    name = record.headers["WARC-Record-ID"].strip("<>")
                    keys.append(capture_key(record.headers["WARC-Target-URI"], name))
                    lines.append(f"{keys[-1]}\t{at}\t{end - at}\t{path}")
                    at = end
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(lines, pa.string())], ["key", "line"])

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, str]] = []
        for batch in batches:
            held += zip(batch.column("key").to_pylist(), batch.column("line").to_pylist())
            while len(held) >= block_lines:
                yield packed(held[:block_lines])
                held = held[block_lines:]
        if held:
            yield packed(held)

    def packed(held: list[tuple[str, str]]) -> pa.RecordBatch:
        lines = zlib.compress("\n".join(line for _, line in held).encode())
        values = ([held[0][0]], [held[-1][0]], [lines])
        return pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["first", "last", "lines"])

    entries = materialize(_files(spark, archives).mapInArrow(scan, "key string, line string"))
    parts = max(1, -(-entries.count() // (16 * block_lines)))
    ordered = entries.repartitionByRange(parts, "key").sortWithinPartitions("key")
    blocks = ordered.mapInArrow(compress, "first string, last string, lines binary")
    return CaptureIndex(materialize(blocks.withColumn("block", F.monotonically_increasing_id())), archives)


def locate(index: CaptureIndex, keys: DataFrame, directory_rows: int = DIRECTORY_ROWS) -> DataFrame:
    """``path``, ``at`` and ``size`` of all captures with one of ``keys`` (``key``, distinct).

    ``keys`` is read once per directory slice; there is one unless the index is very large.
    """
    spark = keys.sparkSession
    blocks = index.directory.count()
    numbered = index.directory.select("block", "first", "last")
    slices = max(1, -(-blocks // directory_rows))
    found = None
    for number in range(slices):
        part = numbered if slices == 1 else numbered.filter(F.pmod(F.xxhash64("block"), F.lit(slices)) == number)
        rows = sorted((row["first"], row["last"], row["block"]) for row in part.collect())
        shared = spark.sparkContext.broadcast(rows)

        def candidates(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            firsts = [row[0] for row in shared.value]
            for batch in batches:
                made: tuple[list, list] = ([], [])
                for key in batch.column("key").to_pylist():
                    # Equal keys may run over several blocks; go back from the last that starts in time.
                    at = bisect_right(firsts, key) - 1
                    while at >= 0 and shared.value[at][1] >= key:
                        made[0].append(key)
                        made[1].append(shared.value[at][2])
                        at -= 1
                yield pa.RecordBatch.from_arrays([pa.array(made[0], pa.string()), pa.array(made[1], pa.int64())], ["key", "block"])

        placed = keys.select("key").mapInArrow(candidates, "key string, block long")
        found = placed if found is None else found.unionByName(placed)

    wanted = found.groupBy("block").agg(F.collect_set("key").alias("keys"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [])
            for packed, keys in zip(batch.column("lines").to_pylist(), batch.column("keys").to_pylist()):
                lines = [line.rsplit("\t", 3) for line in zlib.decompress(packed).decode().split("\n")]
                ordered = [line[0] for line in lines]
                for key in keys:
                    for line in lines[bisect_left(ordered, key) : bisect_right(ordered, key)]:
                        for column, value in zip(out, (line[3], int(line[1]), int(line[2]))):
                            column.append(value)
            kinds = (pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["path", "at", "size"])

    return index.blocks.join(wanted, "block").select("lines", "keys").mapInArrow(search, "path string, at long, size long")


def read_records(index: CaptureIndex, places: DataFrame) -> DataFrame:
    """The records at ``places``: page id as text, type, payload bytes and digest, and the page referred to.

    A response's size and digest are those of the payload read; a revisit's are in its headers.
    """
    by_file = materialize(
        places.groupBy("path").agg(F.collect_list(F.struct("at", "size")).alias("ranges"), F.count(F.lit(1)).alias("n"))
    )
    # The files are what must not be shuffled, as long as the list of places is short.
    files, listed = by_file.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    contents = wanted_files(index, by_file, files)
    by_file = bounded(by_file, listed)
    names = ["page", "record_type", "payload_bytes", "payload_digest", "refers_to"]

    def page_of(record: str) -> str:
        return unquote_plus(record.strip("<>").removeprefix("urn:page:").rpartition(":")[0])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data = batch.column("content")[row].as_py()
                out: tuple[list, ...] = ([], [], [], [], [])
                for place in batch.column("ranges")[row].as_py():
                    record, _ = parse_record(data[place["at"] : place["at"] + place["size"]])
                    kind, digest = record.headers["WARC-Type"], record.headers["WARC-Payload-Digest"]
                    size, refers = int(record.http["Content-Length"]), record.headers.get("WARC-Refers-To")
                    if kind == "response":
                        size, digest = len(record.payload), hashlib.sha1(record.payload).hexdigest()
                    values = (
                        page_of(record.headers["WARC-Record-ID"]),
                        kind,
                        size,
                        digest.removeprefix("sha1:"),
                        page_of(refers) if refers else None,
                    )
                    for column, value in zip(out, values):
                        column.append(value)
                kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    schema = "page string, record_type string, payload_bytes long, payload_digest string, refers_to string"
    return contents.join(by_file, "path").select("content", "ranges").mapInArrow(read, schema)


def capture_keys(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Distinct index keys of pages."""
    digest = F.sha1(F.coalesce(payload, F.lit("")).cast("binary"))
    named = pages.select(header_uri(F.col(url)).alias("uri"), record_id(F.col(key), digest).alias("record"))

    def reverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("uri").to_pylist(), batch.column("record").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([capture_key(*pair) for pair in pairs], pa.string())], ["key"])

    return named.mapInArrow(reverse, "key string").distinct()


def archive_report(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write the pages to archives, index these, and read every page back through the index."""
    spark = pages.sparkSession
    archives = scratch_dir(spark)
    write_archives(records(pages, date), archives)
    index = build_index(spark, archives)
    read = read_records(index, locate(index, materialize(capture_keys(pages))))
    kind = pages.schema["page_id"].dataType
    as_id = lambda name: F.nullif(F.col(name), F.lit("")).cast(kind).alias(name)
    return read.select(
        as_id("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", as_id("refers_to").alias("refers_to")
    )

"""WARC archives of pages and an index of their captures, merged from locally sorted runs.

``write_archives`` decides for every page whether its payload is the first of its kind (a *response*) or repeats
another page's (a *revisit*), and writes records with Spark's text writer: a row is a record up to its payload, the
writer's line separator is the blank line that ends a WARC record. ``read_archives`` reads them back as binary files,
cuts them by ``Content-Length``, checks every payload against its digest and returns one index row per record.
``capture_index`` brings index rows into one global order by (URL key, time): the rows are range-partitioned, every
task's input consists of the sorted runs that the reading tasks wrote, and a loser tree merges those runs.

Defined results. A null html is an empty payload. A null URL is the empty URL. Payloads of fewer than
``min_bytes`` bytes are never linked. The response of equal payloads is the record with the smallest page id;
repeated ids give repeated records, of which the first by id stays the response only once per payload text. A page
without an id cannot be referred to: it is a revisit that refers to nothing (a response below ``min_bytes``), known by
its digest, and keeps its payload unless a page with an id has the same one. Its null id, and a null time, are read
back as null and sort first; the date of a record without a time is that of ``FIRST_SECOND``. An empty table gives an
empty index. Extra columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackspark.llm.common import scratch, table

BLANK_LINE = "\r\n\r\n"
# Page ids carry no time: a capture's time is this second plus its id, unless the caller names a column.
FIRST_SECOND = 1_577_836_800
# Bytes of a file's records, so that a file, which is read as one row, is small; a larger payload has a file of its own.
FILE_BYTES, RECORDS_PER_FILE = 32 << 20, 2_000
# Payload sizes are written together with sizes up to so many times as large.
STEP = 16
# Index rows of a part of the global order.
PART_ROWS = 200_000
INDEX = T.StructType(
    [
        T.StructField("url_key", T.StringType()),
        T.StructField("captured", T.LongType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("file", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
    ]
)
INDEX_ARROW = pa.schema(
    [
        (f.name, pa.int64() if isinstance(f.dataType, T.LongType) else pa.string())
        for f in INDEX
    ]
)
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_of_hex(hexadecimal: Column) -> Column:
    """Base 32 of 40 hexadecimal digits: five digits are twenty bits, hence four characters."""

    def four(i: Column) -> Column:
        bits = F.conv(F.substring(hexadecimal, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        pick = lambda shift: F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1))
        return F.concat(pick(15), pick(10), pick(5), pick(0))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), four), "")


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels reversed, then path and query, lower case, without scheme, port and fragment."""
    plain = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://|#.*$", "")
    host = F.regexp_replace(F.regexp_extract(plain, r"^[^/?]*", 0), r":[0-9]+$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_extract(plain, r"^[^/?]*(.*)$", 1))


def classified(pages: DataFrame, min_bytes: int = 0, captured: Column | None = None) -> DataFrame:
    """Pages with digest, size, record type, the page they refer to and whether their record holds the payload.

    The smallest id of a digest comes from a grouped aggregate, which combines before its shuffle; only digests met
    more than once are joined back.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    shaped = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        (captured if captured is not None else F.col("page_id") + FIRST_SECOND).cast("long").alias("captured"),
        payload.alias("html"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("sha"),
    )
    repeated = (
        shaped.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy("sha")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("times"))
        .filter("times > 1")
        .select(F.col("sha").alias("known"), "first")
    )
    linked = F.col("payload_bytes") >= min_bytes
    refers = F.when((F.col("first") != F.col("page_id")) & linked, F.col("first"))
    revisit = refers.isNotNull() | (F.col("page_id").isNull() & linked)
    return shaped.join(repeated, F.col("sha") == F.col("known"), "left").select(
        "page_id",
        "url",
        "captured",
        "html",
        "payload_bytes",
        base32_of_hex(F.col("sha")).alias("payload_digest"),
        refers.alias("refers_to"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        (~revisit | F.col("first").isNull()).alias("whole"),
    )


def size_classes(file_bytes: int, records_per_file: int) -> list[tuple[int, int, int]]:
    """(payloads from, up to and without, records of a file): a file's payloads are at most ``file_bytes`` together,
    or one."""
    upto = max(1, file_bytes // records_per_file)
    classes = [(0, upto + 1, records_per_file)]
    while classes[-1][2] > 1:
        begin, upto = upto + 1, upto * STEP
        records = file_bytes // upto
        classes.append((begin, upto + 1, records) if records > 1 else (begin, 1 << 62, 1))
    return classes


def write_archives(
    pages: DataFrame, folder: str, min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE, file_bytes: int = FILE_BYTES
) -> int:
    """Write one WARC record per page and return their number; line ends in a URL are escaped so that headers stay intact.

    Pages are written by classes of payload size, each with its own number of records a file; classes without pages, in most
    tables all but the first, cost nothing but the count.
    """
    classes = size_classes(file_bytes, records_per_file)
    size = F.octet_length(F.coalesce(F.col("html"), F.lit("")))
    counts = pages.agg(*[F.count_if(size.between(a, b - 1)).alias(f"c{i}") for i, (a, b, _) in enumerate(classes)]).first()
    page, digest, referred = F.col("page_id").cast("string"), F.col("payload_digest"), F.col("refers_to").cast("string")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    line_if = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.coalesce(F.concat(F.lit("<urn:page:"), page, F.lit(">")), F.concat(F.lit("<urn:sha1:"), digest, F.lit(">")))),
        line("WARC-Date", F.date_format(F.timestamp_seconds(F.coalesce("captured", F.lit(FIRST_SECOND))), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        line_if("X-Page-Id", page),
        line_if("X-Captured", F.col("captured").cast("string")),
        line("X-Url-Key", F.replace(F.replace(url_key(F.col("url")), F.lit("\r"), F.lit("%0d")), F.lit("\n"), F.lit("%0a"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(F.col("record_type") == "revisit", F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line_if("WARC-Refers-To", F.concat(F.lit("<urn:page:"), referred, F.lit(">"))),
            line_if("X-Refers-To", referred),
        )).otherwise(""),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(F.col("whole"), F.col("payload_bytes").cast("string")).otherwise("0")),
        F.lit("\r\n"),
    )
    record = F.concat(header, F.when(F.col("whole"), F.col("html")).otherwise(""))
    rows = classified(pages, min_bytes)
    for i, (begin, end, records) in enumerate(classes):
        # A table without pages gives an archive without records.
        if counts[i] or (i == 0 and not any(counts)):
            part = rows.filter(F.col("payload_bytes").between(begin, end - 1)).select(record.alias("value"))
            writer = part.write.mode("append").option("lineSep", BLANK_LINE).option("compression", "gzip")
            writer.option("maxRecordsPerFile", records).text(folder)
    return sum(counts)


def parsed(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, payload) of every record of an unpacked archive."""
    at, size = 0, len(data)
    while at < size:
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        begin, long = end + 4, int(headers["Content-Length"])
        close = begin + long
        if data[close : close + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut short")
        yield at, close + 4 - at, headers, data[begin:close]
        at = close + 4


def index_order(row: tuple) -> tuple:
    """(URL key, time, page id) with nulls first, as Spark's range partitions have them."""
    return (row[0], *((x is not None, x or 0) for x in row[1:3]))


def index_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows of archives, one sorted run per archive."""
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            rows = []
            for offset, length, head, payload in parsed(zlib.decompress(content.as_buffer(), 31)):
                digest, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
                if (kind == "response" or payload) and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError(f"{path}: payload at byte {offset} does not have its digest")
                captured, page, refers = (int(head[n]) if n in head else None for n in ("X-Captured", "X-Page-Id", "X-Refers-To"))
                rows.append((
                    head["X-Url-Key"], captured, page, kind,
                    int(head["X-Payload-Length"]), digest, refers, path, offset, length,
                ))
            rows.sort(key=index_order)
            if rows:
                yield pa.record_batch(list(map(list, zip(*rows, strict=True))), schema=INDEX_ARROW)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One index row per record of the archives in a folder, read back and checked."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").schema(schema).load(folder).select("path", "content")
    return files.mapInArrow(index_rows, INDEX)


def merged_runs(runs: list[list[tuple]], key) -> Iterator[tuple]:
    """Merge sorted runs with a loser tree: every output row costs one comparison per level.

    ``tree[1:]`` holds the runs that lost at inner nodes, ``tree[0]`` the winner. A spent run loses to all; ties go to
    the lower run number.
    """
    count = len(runs)
    if not count:
        return
    iterators = [iter(r) for r in runs]
    heads = [next(i, None) for i in iterators]

    def wins(a: int, b: int) -> bool:
        if heads[a] is None or heads[b] is None:
            return heads[b] is None and (heads[a] is not None or a < b)
        ka, kb = key(heads[a]), key(heads[b])
        return ka < kb or (ka == kb and a < b)

    tree = [-1] * count
    # Leaves are nodes count .. 2 count - 1; play every match from the leaves up.
    best = [-1] * count + list(range(count))
    for node in range(count - 1, 0, -1):
        a, b = best[2 * node], best[2 * node + 1]
        best[node], tree[node] = (a, b) if wins(a, b) else (b, a)
    winner = best[1] if count > 1 else 0
    while heads[winner] is not None:
        yield heads[winner]
        heads[winner] = next(iterators[winner], None)
        node = (winner + count) // 2
        while node:
            if wins(tree[node], winner):
                tree[node], winner = winner, tree[node]
            node //= 2


def merge_partition(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut a task's rows into ascending runs by archive and merge them."""
    runs: dict[str, list[tuple]] = {}
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            runs.setdefault(row[7], []).append(row)
    for run in runs.values():
        # A shuffle keeps a run's order but for spilled pieces; sorting an ascending list is one pass.
        run.sort(key=index_order)
    block = []
    for row in merged_runs([runs[name] for name in sorted(runs)], index_order):
        block.append(row)
        if len(block) == 10_000:
            yield pa.record_batch(list(map(list, zip(*block, strict=True))), schema=INDEX_ARROW)
            block = []
    if block:
        yield pa.record_batch(list(map(list, zip(*block, strict=True))), schema=INDEX_ARROW)


def capture_index(index: DataFrame, rows: int) -> DataFrame:
    """Global order by (URL key, time, page id): part by part ascending.

    The page id is part of the range key, so the captures of one URL may fill several parts. A part is held by its
    task; there are as many as the ``rows`` of the index demand, or as Spark would make.
    """
    usual = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(usual, -(-rows // PART_ROWS))
    return index.repartitionByRange(parts, "url_key", "captured", "page_id").mapInArrow(merge_partition, INDEX)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    rows = write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    index = capture_index(read_archives(spark, folder), rows)
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured")


OP9_SQL = f"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS sha FROM pages
), f AS (SELECT sha, min(page_id) AS first_id FROM p GROUP BY sha),
u AS (
  SELECT p.*, f.first_id, regexp_replace(lower(coalesce(url, '')), '^[a-z][a-z0-9+.-]*://|#.*$', '', 'g') AS plain
  FROM p JOIN f USING (sha)
)
SELECT page_id, strlen(body) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('{BASE32}',
    (((('0x' || substr(sha, (i // 4) * 5 + 1, 5))::BIGINT) >> (15 - 5 * (i % 4))::INTEGER) & 31)::BIGINT + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
  array_to_string(list_reverse(string_split(regexp_replace(regexp_extract(plain, '^[^/?]*'), ':[0-9]+$', ''), '.')), ',')
    || ')' || regexp_extract(plain, '^[^/?]*(.*)$', 1) AS url_key,
  page_id + {FIRST_SECOND} AS captured
FROM u
"""

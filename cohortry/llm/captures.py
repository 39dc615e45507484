"""Web archives with a globally ordered index of their captures.

Pages are written as WARC/1.1 records, each a gzip member of its own, in blocks of archive parts (a part's blocks in order are
a valid ``.warc.gz`` file). Of equal payloads the page with the largest id is kept as response, the others are revisit records
that refer to it and carry the headers only.

The index is an external merge: every part's captures are a locally sorted run (URL key, time, page), written once. Range
partitions over the same key take their slice of every run, and each merges its slices with a loser tree, so that the partitions
one after the other are the ordered capture history of every URL. A hot URL is split by time, page and place in the archive.

Reading parses every record, checks lengths and digests, and looks the place up in the merged index.

A NULL html is an empty payload; a NULL url has the empty key and comes first; a NULL page_id ranks below all others and is never
referred to (equal payloads without any id are all responses). Rows that repeat the largest page_id with the same payload are
the same page: each is a response. Other columns of the frame are not read. An empty frame gives an empty result. Pages carry
no time of capture, so ``stamp`` derives one from page_id, and with it the order in which ids were given.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta, timezone
from pathlib import Path
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.llm.common import written
from cohortry.session import broadcast_if_small, scratch_path

BLOCK_BYTES = 4 << 20
RANGE_CAPTURES = 100_000
NO_PAGE = -(1 << 63)
EPOCH = datetime(2000, 1, 1, tzinfo=timezone.utc)
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URL = re.compile(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?(?:[^@/?#]*@)?([^/:?#]*)(?::(\d+))?([^#]*)")
ENTRY = "url_key string, captured string, page_id bigint, offset bigint, length bigint"
ARCHIVE = f"part int, block int, entries array<struct<{ENTRY.replace(' string', ':string').replace(' bigint', ':bigint')}>>, records binary"
RUN = f"part int, block int, {ENTRY}"
KEY = ("url_key", "captured", "page_order", "part", "offset")


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels from the last to the first without ``www``, then a default-free port, path and query."""
    if not url:
        return ""
    host, port, rest = URL.match(quote(url, safe="".join(map(chr, range(33, 127))))).groups()
    host = host.lower().removeprefix("www.")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in ("80", "443") else "") + ")" + (rest or "/")


def stamp(page_id: int | None) -> datetime:
    return EPOCH + timedelta(seconds=(page_id or 0) % (1 << 31))


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id}:{digest}'.encode()).digest())}>"


def _iso(when: datetime) -> str:
    return when.strftime("%Y-%m-%dT%H:%M:%SZ")


def _header(fields: Iterable[tuple[str, object]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None).encode("ascii") + b"\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None) -> bytes:
    """One record: a response with its payload, or a revisit with the response's headers."""
    http = b"HTTP/1.1 200 OK\r\n" + _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))])
    revisit = refers_to is not None
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", _iso(stamp(page_id))),
        ("WARC-Target-URI", _ascii(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("WARC-Profile", REVISIT if revisit else None),
        ("WARC-Refers-To", record_id(refers_to, digest) if revisit else None),
        ("WARC-Refers-To-Target-URI", _ascii(refers_url) if revisit else None),
        ("WARC-Refers-To-Date", _iso(stamp(refers_to)) if revisit else None),
        ("X-Page-ID", page_id),
        ("X-Refers-To-Page-ID", refers_to),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", len(block)),
    ]
    return b"WARC/1.1\r\n" + _header(fields) + block + b"\r\n\r\n"


def _ascii(url: str | None) -> str | None:
    return quote(url, safe="".join(map(chr, range(33, 127)))) if url else None


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _warcinfo(part: int) -> bytes:
    block = b"software: cohortry\r\nformat: WARC File Format 1.1\r\n"
    fields = [
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", record_id(part, "warcinfo")),
        ("WARC-Date", _iso(EPOCH)),
        ("WARC-Filename", f"part-{part:05}.warc.gz"),
        ("Content-Type", "application/warc-fields"),
        ("Content-Length", len(block)),
    ]
    return b"WARC/1.1\r\n" + _header(fields) + block + b"\r\n\r\n"


def _zipped(record: bytes) -> bytes:
    return gzip.compress(record, compresslevel=6, mtime=0)


def _archived(block_bytes: int):
    """Rows of pages -> rows of archive blocks with an index entry per record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, entries, held, size, at = TaskContext.get().partitionId(), 0, [], [], 0, 0
        types = {"part": pa.int32(), "block": pa.int32(), "entries": pa.list_(_ENTRY), "records": pa.binary()}
        schema = pa.schema(list(types.items()))

        def taken() -> pa.RecordBatch:
            columns = {"part": [part], "block": [block], "entries": [entries], "records": [b"".join(held)]}
            return pa.RecordBatch.from_pydict(columns, schema=schema)

        for batch in batches:
            for page_id, url, body, refers_to, refers_url in zip(*map(_values, batch.columns)):
                payload = body.as_py()
                if not at:
                    held.append(_zipped(_warcinfo(part)))
                    at = size = len(held[0])
                one = _zipped(record(page_id, url, payload, base32_sha1(payload), refers_to, refers_url))
                when = stamp(page_id).strftime("%Y%m%d%H%M%S")
                entries.append({"url_key": url_key(url), "captured": when, "page_id": page_id, "offset": at, "length": len(one)})
                held.append(one)
                at, size = at + len(one), size + len(one)
                if size >= block_bytes:
                    yield taken()
                    block, entries, held, size = block + 1, [], [], 0
        if held:
            yield taken()

    return run


_ENTRY = pa.struct(
    [("url_key", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())]
)


def _values(column: pa.Array) -> Iterable:
    """Payloads are taken out of Arrow one by one, everything else at once."""
    return column if pa.types.is_binary(column.type) else column.to_pylist()


def with_responses(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with the id and URL of the response that each repeats; NULL for responses themselves.

    Only one row per repeated payload meets the pages: broadcast where a count allows it, else joined by Spark.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", body.alias("body"))
    rows = rows.withColumn("digest", F.sha1("body"))
    enough = rows.filter((F.length("body") >= least_bytes) & F.col("page_id").isNotNull())
    last = F.max(F.struct("page_id", "url")).alias("kept")
    groups = enough.groupBy("digest").agg(last, F.min("page_id").alias("first"))
    null_ids = rows.filter((F.length("body") >= least_bytes) & F.col("page_id").isNull()).select("digest").distinct()
    groups = groups.join(null_ids.withColumn("_null", F.lit(True)), "digest", "left")
    groups = groups.filter((F.col("first") < F.col("kept.page_id")) | F.col("_null")).select("digest", "kept")
    groups = broadcast_if_small(written(groups, "repeated-payloads"))
    both = rows.join(groups, "digest", "left")
    repeats = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept.page_id"))
    refers = [F.when(repeats, F.col(f"kept.{c}")).alias(f"refers_{n}") for c, n in (("page_id", "to"), ("url", "url"))]
    return both.select("page_id", "url", "body", *refers)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, block_bytes: int = BLOCK_BYTES) -> None:
    """Pages (page_id, url, html) as blocks of archives."""
    with_responses(pages, least_bytes).mapInArrow(_archived(block_bytes), ARCHIVE).write.parquet(path)


def export_part(archives: DataFrame, part: int, path: str) -> None:
    """One part as a ``.warc.gz`` file for other tools; block by block, so that the driver holds one block."""
    blocks = archives.filter(F.col("part") == part).orderBy("block").select("records")
    with Path(path).open("wb") as f:
        f.writelines(bytes(r.records) for r in blocks.toLocalIterator())


def sorted_runs(archives: DataFrame) -> DataFrame:
    """The locally sorted runs: a part's captures in key order with their place in the run. Payloads are not read."""
    entries = archives.select("part", "block", F.inline("entries"))
    keyed = entries.withColumn("page_order", F.coalesce("page_id", F.lit(NO_PAGE)))
    ordered = keyed.sortWithinPartitions(*KEY)
    return written(ordered.withColumns({"run": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "capture-runs")


def merged(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """Sorted runs as one, by a tree of losers: an inner node keeps the loser of its match, so the next winner is found by
    replaying the matches above the last winner's leaf only."""
    k = len(runs)
    heads = [next(run, None) for run in runs]

    def beats(a: int, b: int) -> bool:
        return heads[a] is not None and (heads[b] is None or (heads[a], a) < (heads[b], b))

    winners, losers = [0] * k + list(range(k)), [0] * k
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    winner = winners[1] if k > 1 else 0
    while k and heads[winner] is not None:
        yield heads[winner]
        heads[winner] = next(runs[winner], None)
        node = (winner + k) // 2
        while node:
            if beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2


def _merge_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A range's slices, which arrive run by run, in key order with their position in the range."""
    slices: dict[int, list[tuple]] = {}
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in KEY), *(batch.column(c).to_pylist() for c in ("block", "length")))
        for run, row in zip(batch.column("run").to_pylist(), rows):
            slices.setdefault(run, []).append(row)
    ordered = merged([iter(s) for s in slices.values()])
    part, position = TaskContext.get().partitionId(), 0
    while rows := [row for row, _ in zip(ordered, range(10_000))]:
        columns = dict(zip([*KEY, "block", "length"], map(list, zip(*rows))))
        n = len(rows)
        yield pa.RecordBatch.from_pydict(
            {"range": [part] * n, "position": list(range(position, position + n)), **columns}, schema=_MERGED
        )
        position += n


_MERGED = pa.schema(
    [
        ("range", pa.int32()),
        ("position", pa.int64()),
        ("url_key", pa.string()),
        ("captured", pa.string()),
        ("page_order", pa.int64()),
        ("part", pa.int32()),
        ("offset", pa.int64()),
        ("block", pa.int32()),
        ("length", pa.int64()),
    ]
)


def capture_index(archives: DataFrame, range_captures: int = RANGE_CAPTURES) -> DataFrame:
    """Every capture with its rank in the order of URL key, time, page and place: part, block, offset, length, url_key, captured,
    page_id, capture_rank."""
    runs = sorted_runs(archives)
    least = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(least, math.ceil(runs.count() / range_captures))
    ranged = runs.repartitionByRange(n, *KEY).sortWithinPartitions("run", "place").drop("page_id")
    schema = "range int, position bigint, url_key string, captured string, page_order bigint, part int, offset bigint, block int, length bigint"
    index = written(ranged.mapInArrow(_merge_slices, schema), "capture-index")
    ends = index.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    # One row per range partition.
    offsets = F.broadcast(ends.select("range", F.coalesce(before, F.lit(0)).alias("before")))
    rank = (F.col("before") + F.col("position")).alias("capture_rank")
    page = F.when(F.col("page_order") != NO_PAGE, F.col("page_order")).alias("page_id")
    return index.join(offsets, "range").select("part", "block", "offset", "length", "url_key", "captured", page, rank)


def parse(archive: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, header and block of every record of an archive, or of any run of its gzip members."""
    at = 0
    while at < len(archive):
        unzip = zlib.decompressobj(wbits=31)
        body = unzip.decompress(archive[at : at + (1 << 16)])
        end = at + (1 << 16)
        while not unzip.eof:
            if end >= len(archive):
                raise ValueError("an archive ends inside a record")
            body += unzip.decompress(archive[end : end + (1 << 20)])
            end += 1 << 20
        head, _, rest = body.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines)
        size = int(fields["Content-Length"])
        if version != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
            raise ValueError(f"no whole record at byte {at}")
        yield at, fields, rest[:size]
        at = min(end, len(archive)) - len(unzip.unused_data)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "offset", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    for batch in batches:
        for part, first, data in zip(*(batch.column(c).to_pylist() for c in ("part", "first")), batch.column("records")):
            rows = []
            for at, fields, block in parse(data.as_py()):
                if fields["WARC-Type"] == "warcinfo":
                    continue
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(re.search(rb"Content-Length: (\d+)", http).group(1))
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if fields["WARC-Type"] == "response" and (len(payload), base32_sha1(payload)) != (size, digest):
                    raise ValueError(f"the payload at byte {first + at} of part {part} is damaged")
                page, refers = (int(fields[c]) if c in fields else None for c in ("X-Page-ID", "X-Refers-To-Page-ID"))
                rows.append((part, first + at, page, size, digest, fields["WARC-Type"], refers))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record but the parts' own: part, offset, page_id, payload_bytes, payload_digest, record_type, refers_to."""
    # A block ends where its last entry ends.
    last = F.element_at("entries", -1)
    first = (last["offset"] + last["length"] - F.length("records")).alias("first")
    schema = "part int, offset bigint, page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return archives.select("part", first, "records").mapInArrow(_records, schema)


def archived_pages(spark: SparkSession, pages: DataFrame, least_bytes: int = 0, **options: int) -> DataFrame:
    """Writes the archives to the shared folder, builds their merged index, and reads every indexed record back."""
    path = scratch_path(spark, "archives")
    write_archives(pages, path, least_bytes, **options)
    archives = spark.read.schema(ARCHIVE).parquet(path)
    index = capture_index(archives).select("part", "offset", "url_key", "captured", "capture_rank")
    return read_archives(archives).join(index, ["part", "offset"]).drop("part", "offset")

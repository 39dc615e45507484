"""Archives: round trips, revisits by a plain rule, the merged index by a plain sort, and other readers' view of a part."""

import base64
import gzip
import hashlib
import random
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from cohortry.llm import captures
from cohortry.session import scratch_path

PAGES = "page_id bigint, url string, html string, part string, digest int, kept string"
URLS = ["http://www.b.example/x", "https://a.example:8443/?q=1#top", "http://B.example/x", None, "", "no scheme/ä\r\nInjected: 1", "ftp://u:p@h.example"]


def page_rows():
    rng = random.Random(7)
    bodies = [None, "", "<p>one</p>", "<p>é</p>\r\n\r\nx", "y" * 70_000, "WARC/1.1\r\n\r\n"]
    rows = [(i if i % 23 else None, rng.choice(URLS), rng.choice(bodies) if i % 3 else f"page {i}", "p", 1, "k") for i in range(300)]
    return [*rows, rows[4], rows[4], (None, "http://n.example/", "only null ids", "p", 1, "k"), (None, None, "only null ids", "p", 1, "k")]


def brute(rows, least=0):
    """(page_id, bytes, digest, type, refers_to): equal payloads refer to their largest page_id."""
    largest = defaultdict(lambda: None)
    for page, _, html, *_ in rows:
        body = (html or "").encode()
        if page is not None and len(body) >= least:
            largest[body] = page if largest[body] is None else max(page, largest[body])
    out = []
    for page, _, html, *_ in rows:
        body = (html or "").encode()
        kept = largest[body] if len(body) >= least else None
        refers = kept if kept is not None and kept != page else None
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


FIELDS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("least", [0, 5, 10**9])
def test_odd_pages(spark, least):
    rows = page_rows()
    pages = spark.createDataFrame(rows, PAGES).repartition(5)
    got = captures.archived_pages(spark, pages, least, block_bytes=2_000).select(*FIELDS, "url_key", "captured", "capture_rank").collect()
    assert sorted((tuple(r[:5]) for r in got), key=repr) == brute(rows, least)
    ranked = sorted(got, key=lambda r: r.capture_rank)
    assert [r.capture_rank for r in ranked] == list(range(len(rows)))
    keys = [(r.url_key, r.captured, captures.NO_PAGE if r.page_id is None else r.page_id) for r in ranked]
    assert keys == sorted(keys)
    assert sorted(r.url_key for r in got) == sorted(captures.url_key(u) for _, u, *_ in rows)


def test_empty_frame(spark):
    assert captures.archived_pages(spark, spark.createDataFrame([], PAGES)).collect() == []


def test_one_hot_payload_and_one_hot_url(spark):
    rows = [(i, "http://hot.example/", "same" if i % 2 else f"own {i}") for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = captures.archived_pages(spark, pages).select(*FIELDS, "capture_rank").collect()
    assert sorted((tuple(r[:5]) for r in got), key=repr) == brute(rows)
    assert all(r.capture_rank == r.page_id for r in got)


def test_a_part_is_an_archive_for_other_tools(spark, tmp_path):
    path = scratch_path(spark, "archives")
    captures.write_archives(spark.createDataFrame(page_rows(), PAGES).coalesce(1), path, block_bytes=3_000)
    archives = spark.read.schema(captures.ARCHIVE).parquet(path)
    assert archives.count() > 1
    captures.export_part(archives, 0, str(tmp_path / "part.warc.gz"))
    body = gzip.decompress((tmp_path / "part.warc.gz").read_bytes())
    found, at = 0, 0
    while at < len(body):
        end = body.index(b"\r\n\r\n", at)
        head = body[at:end].decode("ascii").split("\r\n")
        fields = dict(line.split(": ", 1) for line in head[1:])
        size = int(fields["Content-Length"])
        block = body[end + 4 : end + 4 + size]
        assert head[0] == "WARC/1.1" and "Injected" not in fields
        if "WARC-Block-Digest" in fields:
            assert fields["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
        at, found = end + 4 + size + 4, found + 1
    assert found == len(page_rows()) + 1


def test_an_entry_finds_its_record(spark):
    path = scratch_path(spark, "archives")
    captures.write_archives(spark.createDataFrame(page_rows(), PAGES).repartition(3), path, block_bytes=3_000)
    archives = spark.read.schema(captures.ARCHIVE).parquet(path)
    whole = defaultdict(bytes)
    for r in archives.orderBy("part", "block").collect():
        whole[r.part] += bytes(r.records)
    for r in captures.capture_index(archives).collect():
        ((at, fields, _),) = captures.parse(whole[r.part][r.offset : r.offset + r.length])
        assert at == 0 and fields.get("X-Page-ID") == (None if r.page_id is None else str(r.page_id))


def test_damage_is_an_error(spark):
    whole = captures._zipped(captures.record(1, "http://a/", b"body", captures.base32_sha1(b"body"), None, None))
    with pytest.raises(ValueError, match="inside a record"):
        list(captures.parse(whole[:-9]))
    wrong = captures._zipped(captures.record(1, "http://a/", b"body", captures.base32_sha1(b"other"), None, None))
    table = captures.pa.table({"part": [0], "first": [0], "records": [wrong]}).to_batches()
    with pytest.raises(ValueError, match="damaged"):
        list(captures._records(iter(table)))


@given(st.lists(st.lists(st.integers(0, 30), max_size=12), max_size=9))
def test_loser_tree_merges_sorted_runs(runs):
    assert list(captures.merged([iter(sorted((x,) for x in run)) for run in runs])) == sorted((x,) for run in runs for x in run)


def test_url_keys():
    key = captures.url_key
    assert key("http://www.Example.com:80/a?b=1#c") == "com,example)/a?b=1" == key("https://example.com:443/a?b=1")
    assert key("http://a.example:8443") == "example,a:8443)/" and key(None) == key("") == ""

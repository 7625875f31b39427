import gzip
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexisift.llm import capture_index, queries
from lexisift.llm.capture_index import (Lookup, archive_pages, build_index, look_up, parse_capture, read_captures, url_key,
                                        write_archives)
from lexisift.session import shared_folder
from tests.llm.conftest import rows_of

SCHEMA = "page_id long, url string, html string, digest string, key int"
FIELDS = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"]


@pytest.mark.parametrize("url, key", [
    ("https://www.Example.com/a/B?q=1#top", "com,example,www)/a/B?q=1"), ("http://example.com", "com,example)/"),
    ("http://user:pw@example.com:80/x", "com,example)/x"), ("https://example.com:8080?x", "com,example:8080)?x"),
    ("a b\tc\n", ")a%20b%09c%0A"), ("", ")/"), (None, ""), ("http://é.de/ü", "de,é)/ü")])
def test_keys_of_urls(url, key):
    assert url_key(url) == key


def some_pages(rng, n):
    bodies = ["", "short", "é" * 49, "é" * 50, "x" * 99, "x" * 100, "same" * 100, "other \r\n\r\n" * 30, "\x00 " * 80]
    rows = [(k, f"https://h{rng.randrange(4)}.example.org/{rng.randrange(30)}", rng.choice([*bodies, "x" * rng.randrange(300)]), "d", 1)
            for k in rng.sample(range(10 * n), n)]
    return rows + [(None, "http://a.de/", "same" * 100, "d", 1), (None, None, None, "d", 1), (None, None, "only null ids" * 20, "d", 1),
                   rows[0], rows[0], (rows[1][0], "http://moved.de/a b\r\nX: y", rows[1][2], "d", 1), (3 * 10**9, None, "same" * 100, "d", 1)]


def expected(rows):
    first = {}
    for page, _, html, *_ in rows:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, url, html, *_ in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and page != first.get(html)
        url = None if url is None else url.replace(" ", "%20").replace("\r", "%0D").replace("\n", "%0A")
        out.append((page, url, "revisit" if again else "response", len(data), hashlib.sha256(data).hexdigest(),
                    first[html] if again else None))
    return sorted(out, key=repr)


@pytest.fixture
def small_blocks(monkeypatch):
    """Many index files; the driver sets their number."""
    monkeypatch.setattr(capture_index, "SHARD_ENTRIES", 20)


def test_round_trip(spark, small_blocks):
    rows = some_pages(random.Random(1), 400)
    pages = spark.createDataFrame(rows, SCHEMA).repartition(5)
    index = archive_pages(pages, shared_folder(spark, "archives"))
    got = read_captures(index, look_up(index, pages))
    assert rows_of(got, *FIELDS) == expected(rows)
    payloads = {(r.page_id, r.payload_digest): r.payload for r in got.where("record_type = 'response'").collect()}
    assert all(hashlib.sha256(p).hexdigest() == d for (_, d), p in payloads.items())
    assert rows_of(read_captures(index, look_up(index, pages), payloads=False), *FIELDS, "payload") == sorted(
        ((*r, None) for r in expected(rows)), key=repr)


def test_lookup_by_url_alone(spark, small_blocks):
    rows = some_pages(random.Random(2), 200)
    pages = spark.createDataFrame(rows, SCHEMA)
    index = archive_pages(pages, shared_folder(spark, "archives"))
    asked = ["HTTPS://H1.example.org/7", "http://h2.example.org/3#x", "http://nowhere.org/", None, None]
    requests = spark.createDataFrame([(u,) for u in asked], "url string")
    keys = {url_key(u) for u in asked}
    want = Counter((url_key(r[1]), r[0]) for r in rows if url_key(r[1]) in keys)
    assert Counter((r.key, r.page_id) for r in look_up(index, requests).collect()) == want
    assert look_up(index, pages.limit(0)).count() == 0


def test_search_in_small_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(capture_index, "BLOCK_ENTRIES", 3)
    rng = random.Random(4)
    entries = sorted((rng.choice("abcde") * rng.randrange(3), rng.randrange(9), "w", k, 1) for k in range(100))
    folder = str(tmp_path)
    listed = []
    for shard in (entries[:33], entries[33:34], entries[34:]):
        for batch in capture_index._packer(folder)(iter([capture_index._entries(shard)])):
            listed.append((capture_index.json.loads(batch.column("range")[0].as_py()), batch.column("shard")[0].as_py()))
    (tmp_path / "shards.json").write_text(capture_index.json.dumps(sorted(listed)))
    lookup = Lookup(capture_index.CaptureIndex(folder))
    for key in {e[0] for e in entries} | {"zz", "bb", "0"}:
        assert sorted(lookup.find((key, 0, 0), (key, 2, 0))) == [e for e in entries if e[0] == key]
        for page in range(10):
            assert sorted(lookup.find((key, 1, page), (key, 1, page))) == [e for e in entries if e[:2] == (key, page)]


def test_archives_are_plain_warc_files(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a.de/", "é" * 60, "d", 1), (2, "http://b.de/", "é" * 60, "d", 1)], SCHEMA).coalesce(1)
    folder = f"file://{tmp_path}/captures"
    entries = write_archives(pages, folder).collect()
    files = list((tmp_path / "captures").glob("*.warc.gz"))
    assert len(files) == 1
    text = gzip.decompress(files[0].read_bytes()).decode()
    assert text.count("WARC/1.1\r\n") == 3 and text.startswith("WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    assert "WARC-Refers-To: <urn:page:1>\r\n" in text and text.count("é" * 60) == 1
    damaged = bytearray(gzip.decompress(files[0].read_bytes()[entries[0].offset:entries[0].offset + entries[0].length]))
    damaged[-8] ^= 1
    with pytest.raises(ValueError):
        parse_capture(gzip.compress(bytes(damaged)))


def test_empty_table(spark):
    pages = spark.createDataFrame([], SCHEMA)
    index = archive_pages(pages, shared_folder(spark, "archives"))
    assert read_captures(index, look_up(index, pages)).count() == 0


def test_hot_payload_and_hot_address(spark, tmp_path):
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"), F.when(F.col("id") % 3 > 0, F.lit("http://hot.de/")).otherwise(F.concat(F.lit("http://x.de/"), "id")).alias("url"),
        F.when(F.col("id") % 3 == 0, F.lit("hot payload " * 20)).otherwise(F.concat(F.lit("y" * 120), "id")).alias("html"))
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.op11_capture_index(spark, str(tmp_path))
    assert got.count() == 3000
    assert got.where("record_type = 'revisit'").agg(F.count("*"), F.min("refers_to"), F.max("refers_to")).first() == (999, 0, 0)


def test_more_entries_of_one_capture_than_a_block_holds(spark):
    entries = spark.range(5000).select(F.lit("de,a)/").alias("key"), F.lit(7).cast("long").alias("page_id"),
                                       F.lit("w").alias("archive"), F.col("id").alias("offset"), F.lit(1).cast("long").alias("length"))
    folder = shared_folder(spark, "archives")
    capture_index.located(folder)[0].create_dir(capture_index.located(folder)[1], recursive=True)
    index = build_index(entries, folder)
    requests = spark.createDataFrame([("http://a.de/", 7), ("http://a.de/", 8)], "url string, page_id long")
    assert look_up(index, requests).select("offset").distinct().count() == 5000

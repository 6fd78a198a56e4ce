import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ticksmith.llm import warc
from ticksmith.llm.queries import QUERIES

from .conftest import SF


def _wanted(pages, least=100):
    first = {}
    for page, _, html in pages:
        raw = (html or "").encode()
        if len(raw) >= least and page is not None:
            first[raw] = min(page, first.get(raw, page))
    out = []
    for page, _, html in pages:
        raw = (html or "").encode()
        again = first.get(raw) is not None and page != first[raw]
        digest = hashlib.sha256(raw).hexdigest()
        out.append((page, len(raw), digest, "revisit" if again else "response", first[raw] if again else None))
    return sorted(out, key=str)


def test_query_against_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()
    rows = QUERIES["op2_warc"](spark, SF).collect()
    assert sorted((tuple(r) for r in rows), key=str) == _wanted(pages)


def _pages(spark):
    draw = random.Random(1)
    big = ["x" * 100, "é" * 60, "short", "", None, "y" * 99]
    urls = [
        None, "", "http://a.example.com/p?q=1", "http://b.example.com:8080/p", "not a url", "http://[bad/",
        "https://a.example.com/ünï code\r\nX: y", "http://A.example.com/p?q=1",
    ]
    rows = [(i, draw.choice(urls), draw.choice(big)) for i in range(300)]
    rows += [(7, "http://a.example.com/", "x" * 100), (7, "http://a.example.com/", "x" * 100)]
    rows += [(None, "http://a.example.com/", "x" * 100), (None, None, "only" * 40), (-5, urls[2], "é" * 60)]
    schema = "page_id long, url string, html string"
    return rows, spark.createDataFrame(rows, schema).withColumn("payload", F.lit(1)).withColumn("key", F.lit("k"))


def test_odd_pages_come_back_whole(spark, tmp_path):
    rows, pages = _pages(spark)
    found = warc.archive_and_read(spark, pages, str(tmp_path)).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    # Rows that repeat a page have one key and are found by each search for it once.
    assert sorted(got, key=str) == _wanted(rows)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in found)
    assert warc.archive_and_read(spark, pages.where("1 = 0"), str(tmp_path / "none")).count() == 0


def test_archives_are_gzip_members_and_blocks_are_searched(spark, tmp_path):
    rows, pages = _pages(spark)
    folder = str(tmp_path)
    captures = warc.write_archives(pages, folder, file_bytes=2000)
    assert captures.select("file").distinct().count() > 5
    parts = warc.write_index(captures, folder, block_lines=7)
    index = warc.CaptureIndex(folder, parts)
    places = {}
    for r in captures.collect():
        places.setdefault(r.key, []).append((r.file, r.at, r.length))
    assert all(sorted(index.find(k)) == sorted(v) for k, v in places.items())
    assert index.find("zzz) 1") == index.find("") == []
    file, at, length = next(iter(places.values()))[0]
    whole = (tmp_path / file).read_bytes()
    assert gzip.decompress(whole).count(b"WARC/1.1\r\n") >= 1
    assert gzip.decompress(whole[at : at + length]).startswith(b"WARC/1.1\r\n")


def test_hosts_sort_by_their_domain():
    assert warc.url_key("http://www.example.com/a?b=c") == "com,example,www)/a?b=c"
    assert warc.url_key("HTTP://Example.COM:81") == "com,example:81)/"
    assert warc.url_key(None) == ")"
    assert warc.capture_key("x", -3) < warc.capture_key("x", 2) < warc.capture_key("x", 10)


def test_folders_by_sparks_names():
    for folder, known in (
        ("/data/w", "/data/w"), ("file:///data/w", "file:///data/w"), ("s3a://b/w", "s3://b/w"),
        ("S3N://b/w", "s3://b/w"), ("gs://b/w", "gs://b/w"), ("hdfs://n:8020/w", "hdfs://n:8020/w"),
    ):
        assert warc._place(folder) == known


def test_unknown_folders_are_refused_before_writing(spark):
    pages = spark.createDataFrame([(1, "http://a.b/", "x")], "page_id long, url string, html string")
    with pytest.raises(ValueError, match="archives cannot be kept under dbx://"):
        warc.write_archives(pages, "dbx://b/w")

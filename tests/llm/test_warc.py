"""WARC archives: exact round trips, offsets, cut streams, and the query against plain Python."""

import base64
import gzip
import hashlib
import io
import json
import os
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from targetlens.llm import common
from targetlens.llm.common import Scratch
from targetlens.llm.warc import (
    RecordStream, archived_pages, fields, inflated, normalise_archives, page_records, read_index, read_records, rewrite, write_monolithic,
)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.001/pages.parquet").cache()


def expected_rows(rows):
    groups = defaultdict(list)
    for page_id, html in rows:
        groups[html or ""].append(page_id)
    out = []
    for page_id, html in rows:
        data = (html or "").encode()
        top = max((i for i in groups[html or ""] if i is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, *(("response", None) if page_id == top else ("revisit", top))))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def record(body, kind="response", uri="http://a/"):
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def pieces(data, size):
    return [data[i:i + size] for i in range(0, len(data), size)]


def test_pages_read_back(pages):
    assert got(archived_pages(pages)) == expected_rows([(r["page_id"], r["html"]) for r in pages.collect()])


ROWS = [
    (1, "http://a/x y", "<p>one</p>", "e"), (5, "http://a/\r\nEvil: 1", "<p>one</p>", "e"), (3, None, "<p>one</p>", None), (None, "u", "<p>one</p>", "e"),
    (7, "u", None, "e"), (8, "u", "", "e"), (9, "u", "ünï 😀\r\n\r\nWARC/1.1\r\n\r\n", "e"), (None, "u", "lonely", "e"), (None, None, "lonely", "e"),
    (11, "u", "x" * 700_000, "e"), (12, "u", "twice", "e"), (12, "v", "twice", "e"), (2, "v", "twice", "e"),
]


@pytest.mark.parametrize("limit", [200_000, 0])
def test_messy_pages(spark, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_ROWS", limit)
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string, sha string").withColumns({n: F.lit(n) for n in ("id", "digest", "top", "n", "key")})
    assert got(archived_pages(df)) == expected_rows([(r[0], r[2]) for r in ROWS])
    assert archived_pages(df.where("false")).count() == 0


def test_string_ids_and_short_payloads(spark):
    df = spark.createDataFrame([("b %\n", "u", "same"), ("a", "u", "same"), ("c", "u", "tiny long one"), ("d", "u", "tiny long one")], "k string, url string, html string")
    rows = {r["k"]: (r["record_type"], r["refers_to"]) for r in archived_pages(df, "k", min_revisit_bytes=5).collect()}
    assert rows == {"b %\n": ("response", None), "a": ("response", None), "c": ("revisit", "d"), "d": ("response", None)}


def test_archives_are_streams_first_and_members_with_an_index_after(spark, pages, tmp_path):
    crawl, target = str(tmp_path / "crawl"), f"file://{tmp_path}/warc"
    write_monolithic(page_records(pages, Scratch(spark)), crawl)
    streams = [p for p in os.listdir(crawl) if p.endswith(".gz")]
    for name in streams:
        engine = zlib.decompressobj(31)
        engine.decompress(open(f"{crawl}/{name}", "rb").read())
        assert engine.eof and not engine.unused_data  # one stream for the whole file
    archives = normalise_archives(spark, crawl, target).cache()
    facts = archives.collect()
    assert sum(r["n_records"] for r in facts) == pages.count() and all(r["complete"] for r in facts)
    for r in facts:
        data = open(f"{tmp_path}/warc/{r['archive']}", "rb").read()
        lines = [json.loads(x) for x in open(f"{tmp_path}/warc/{r['archive']}.cdxj", encoding="utf-8")]
        assert [x["offset"] for x in lines] == [0, *[x["offset"] + x["length"] for x in lines]][:len(lines)]
        assert (lines[-1]["offset"] + lines[-1]["length"] if lines else 0) == len(data) == r["n_bytes"]
        whole = gzip.decompress(open(r["source"].removeprefix("file:"), "rb").read())
        members = [gzip.decompress(data[x["offset"]:x["offset"] + x["length"]]) for x in lines]
        assert b"".join(members) == whole
        assert all(m.startswith(b"WARC/1.1\r\n") and m.endswith(b"\r\n\r\n") for m in members)
    (tmp_path / "warc" / "part-lost-attempt.warc.gz.cdxj").write_text(json.dumps({"archive": "part-lost-attempt.warc.gz", "offset": 0, "length": 9}) + "\n")
    back = read_records(read_index(spark, target, archives), target, payloads=True).collect()
    assert all(r["intact"] for r in back)
    assert {(int(r["page_id"]), bytes(r["payload"]).decode()) for r in back} == {(r["page_id"], r["html"]) for r in pages.collect()}


@pytest.mark.parametrize("size", [1, 3, 7, 64, 1 << 20])
def test_rewriting_does_not_depend_on_pieces(size):
    bodies = [b"", b"a", b"\r\n\r\nWARC/1.1\r\n\r\n", bytes(range(256)) * 40, b"\r\n"]
    plain = b"".join(record(b) for b in bodies)
    for stream in (gzip.compress(plain), gzip.compress(plain[:100]) + gzip.compress(plain[100:]) + b"\0" * 9):
        out, index = io.BytesIO(), io.BytesIO()
        n, written, whole = rewrite(pieces(stream, size), out, index, "a")
        lines = [json.loads(x) for x in index.getvalue().splitlines()]
        assert (n, written, whole) == (len(bodies), len(out.getvalue()), True)
        assert [gzip.decompress(out.getvalue()[x["offset"]:x["offset"] + x["length"]]) for x in lines] == [record(b) for b in bodies]


def test_cut_streams_keep_their_whole_records():
    data = gzip.compress(record(b"one") + record(os.urandom(5000)))
    for cut, kept in ((len(data) - 2000, 1), (len(data), 2), (5, 0), (0, 0)):
        out, index = io.BytesIO(), io.BytesIO()
        n, _, whole = rewrite([data[:cut]] if cut else [], out, index, "a")
        assert n == kept == len(index.getvalue().splitlines())
        assert whole == (cut in (0, 5, len(data)))  # five bytes are less than a gzip header
    with pytest.raises(ValueError):
        rewrite([gzip.compress(b"<html>no archive</html>")], io.BytesIO(), io.BytesIO(), "a")
    with pytest.raises(zlib.error):
        list(inflated([b"plain text"]))


def test_header_fields():
    stream = RecordStream([record(b"abc", uri="http://x:80/a:b")])
    assert fields(stream.header())["warc-target-uri"] == "http://x:80/a:b"
    assert b"".join(stream.block(3)) == b"abc" and stream.header() is None and stream.whole

"""WARC archives: monolithic gzip streams rewritten as one member per record, with sidecar offset indexes.

Pages become WARC/1.1 records that Spark's text writer puts into whole-file gzip streams, as many
crawlers leave them. The normaliser inflates each stream once and in pieces, rewrites every record
as a gzip member of its own and writes its offset, length and main fields to a sidecar of JSON
lines. Readers take the sidecars as a table and fetch single members by offset.
"""

from __future__ import annotations

import base64
import hashlib
import json
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import unquote_plus

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from targetlens.llm.common import Scratch, bounded
from targetlens.session import shared_folder

WARC_DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, RECORD_END = "\r\n", "\r\n\r\n"
#: Payloads of fewer bytes are always stored in full.
MIN_REVISIT_BYTES = 0
#: Records of one archive at most.
RECORDS_PER_ARCHIVE = 50_000
#: Share of all rows from which a group of equal payloads is joined by broadcast; there are at most so many of them.
HOT_GROUPS = 1000
PIECE = 1 << 18
BASE32, BASE32_OF_CONV = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
INDEX = "archive string, offset long, length long, type string, record_id string, digest string, page_id string, target_uri string"


def base32(hex_digest: Column) -> Column:
    """Bare upper-case base32 of a 40-digit SHA-1."""
    part = lambda i: F.lpad(F.conv(F.substring(hex_digest, 1 + 10 * i, 10), 16, 32), 8, "0")
    return F.translate(F.concat(*[part(i) for i in range(4)]), BASE32_OF_CONV, BASE32)


def page_records(
    pages: DataFrame, scratch: Scratch, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """(id, url, html, digest, n_bytes, top, revisit): each page, and the id of the page it repeats.

    Groups of equal payloads are counted before the shuffle. Groups with a thousandth of all rows or
    more are few and broadcast; in the join of the others no key is frequent.
    """
    html = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    pages = pages.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), html.alias("html"),
        F.sha1(html.cast("binary")).alias("sha"), F.octet_length(html).cast("long").alias("n_bytes"),
    )
    rows = pages.select("sha", "n_bytes", "id").where(F.col("n_bytes") >= min_revisit_bytes)
    groups = scratch.keep(rows.groupBy("sha", "n_bytes").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    known = groups.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("rows")).first()
    top = groups.select("sha", "n_bytes", "top", F.lit(True).alias("shared"))
    joined = pages.join(bounded(top, known["groups"]), ["sha", "n_bytes"], "left")
    if bounded(top, known["groups"]) is top:  # too many for a broadcast
        hot = F.col("n") * HOT_GROUPS >= known["rows"]
        often = F.broadcast(groups.where(hot).select("sha", "n_bytes", F.col("top").alias("hot_top"), F.lit(True).alias("hot")))
        rare = groups.where(~hot).select(F.col("sha").alias("key"), F.col("n_bytes").alias("key_bytes"), "top", F.lit(True).alias("shared"))
        marked = pages.join(often, ["sha", "n_bytes"], "left")
        # rows that have found their group are dealt by their id: their payload is frequent
        key = F.when(F.col("hot"), F.sha1(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))).otherwise(F.col("sha"))
        joined = marked.withColumn("dealt", key).join(
            rare, (F.col("dealt") == F.col("key")) & (F.col("n_bytes") == F.col("key_bytes")), "left"
        ).withColumn("top", F.coalesce("hot_top", "top")).withColumn("shared", F.coalesce("hot", "shared"))
    revisit = F.col("shared").isNotNull() & ~F.col("id").eqNullSafe(F.col("top"))
    return joined.select("id", "url", "html", base32(F.col("sha")).alias("digest"), "n_bytes", "top", revisit.alias("revisit"))


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws(" ", page_id.cast("string"), digest).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def warc_text(date: str = WARC_DATE) -> Column:
    """The record of a row of :func:`page_records`, without the line ends that close it."""
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(END))
    plain = lambda value: F.url_encode(value.cast("string"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("n_bytes"), F.lit(RECORD_END))
    body = F.when(F.col("revisit"), F.lit("")).otherwise(F.col("html"))
    optional = lambda value: F.coalesce(value, F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.1{END}WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response"), F.lit(END),
        field("WARC-Record-ID", _record_id(F.col("id"), F.col("digest"))), F.lit(f"WARC-Date: {date}{END}"),
        optional(field("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]+", "%20"))),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), optional(field("WARC-Page-ID", plain(F.col("id")))),
        F.when(F.col("revisit"), F.concat(
            F.lit(f"WARC-Profile: {PROFILE}{END}"), field("WARC-Refers-To", _record_id(F.col("top"), F.col("digest"))),
            field("WARC-Refers-To-Page-ID", plain(F.col("top"))),
        )).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{END}Content-Length: "), F.octet_length(http) + F.octet_length(body),
        F.lit(RECORD_END), http, body,
    )


def write_monolithic(records: DataFrame, path: str) -> None:
    """Archives of one gzip stream each, written and committed by Spark; a record ends with two line ends."""
    records.select(warc_text().alias("value")).write.option("compression", "gzip").option("lineSep", RECORD_END).option(
        "maxRecordsPerFile", RECORDS_PER_ARCHIVE).text(path)


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    path = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def inflated(source: Iterable[bytes]) -> Iterator[bytes]:
    """Plain bytes of a gzip stream of any number of members, in pieces; ends quietly where the stream is cut."""
    engine = zlib.decompressobj(31)
    for data in source:
        while data:
            if engine.eof:
                if not data.strip(b"\0"):
                    return  # padding
                engine = zlib.decompressobj(31)
            piece = engine.decompress(data, PIECE)
            data = engine.unused_data if engine.eof else engine.unconsumed_tail
            if piece:
                yield piece


class RecordStream:
    """WARC records of a stream of bytes, blocks in pieces."""

    def __init__(self, pieces: Iterable[bytes]):
        self.pieces, self.held = iter(pieces), bytearray()
        #: whether the last record was there as a whole
        self.whole = True

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        self.held += piece or b""
        return piece is not None

    def header(self) -> bytes | None:
        """The next header with its empty line; None at the end."""
        while True:
            while self.held[:2] == b"\r\n":
                del self.held[:2]
            if len(self.held) >= 5 and not self.held.startswith(b"WARC/"):
                raise ValueError("no WARC record where one should begin")
            end = self.held.find(b"\r\n\r\n")
            if end >= 0:
                head = bytes(self.held[:end + 4])
                del self.held[:end + 4]
                return head
            if not self._more():
                self.whole = self.whole and not self.held.strip()
                return None

    def block(self, size: int) -> Iterator[bytes]:
        while size > 0:
            if not self.held and not self._more():
                self.whole = False
                return
            piece = bytes(self.held[:size])
            del self.held[:size]
            size -= len(piece)
            if piece:
                yield piece


def fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if ":" in line)}


def rewrite(source: Iterable[bytes], out, index, name: str) -> tuple[int, int, bool]:
    """Every record of the stream as a member of ``out`` and a line of ``index``: (records, bytes, complete)."""
    stream, offset, n = RecordStream(inflated(source)), 0, 0
    while (head := stream.header()) is not None:
        known = fields(head)
        engine = zlib.compressobj(6, zlib.DEFLATED, 31)
        start = offset

        def put(data: bytes) -> int:
            out.write(data)
            return len(data)

        offset += put(engine.compress(head))
        for piece in stream.block(int(known.get("content-length", 0))):
            offset += put(engine.compress(piece))
        offset += put(engine.compress(RECORD_END.encode())) + put(engine.flush())
        if not stream.whole:
            break  # the member of a cut record stands at the end of the file; no line points to it
        line = {
            "archive": name, "offset": start, "length": offset - start, "type": known.get("warc-type"), "record_id": known.get("warc-record-id"),
            "digest": known.get("warc-payload-digest", "").removeprefix("sha1:"), "page_id": known.get("warc-page-id"), "target_uri": known.get("warc-target-uri"),
        }
        index.write((json.dumps(line, ensure_ascii=False) + "\n").encode())
        n += 1
    return n, offset, stream.whole


def normalise_archives(spark: SparkSession, source: str, target: str, pattern: str = "*.gz") -> DataFrame:
    """(source, archive, n_records, n_bytes, complete): every gzip archive under ``source`` rewritten under ``target``.

    One task reads an archive once, in pieces of a few hundred kilobytes, so neither archives nor
    records need to fit in memory. Each attempt writes files of its own name and only those of the
    attempt that ends are in the result, so a lost executor costs a repetition and leaves files that
    nothing refers to. ``complete`` is false where a stream ends inside a record; the whole records
    before it are kept. An empty stream gives an archive without records. Paths may lie in any store
    that ``pyarrow.fs`` opens.
    """
    paths = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(source).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = _opened(target)
        files.create_dir(folder, recursive=True)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                name = f"{posixpath.basename(path).split('.')[0]}-{uuid.uuid4().hex}.warc.gz"
                store, place = _opened(path)
                with store.open_input_stream(place, compression=None) as read, \
                        files.open_output_stream(f"{folder}/{name}", compression=None) as out, files.open_output_stream(f"{folder}/{name}.cdxj", compression=None) as index:
                    n, size, whole = rewrite(iter(lambda: read.read(PIECE), b""), out, index, name)
                yield pa.RecordBatch.from_pydict({"source": [path], "archive": [name], "n_records": [n], "n_bytes": [size], "complete": [whole]})

    return paths.mapInArrow(run, "source string, archive string, n_records long, n_bytes long, complete boolean")


def read_index(spark: SparkSession, target: str, archives: DataFrame) -> DataFrame:
    """The sidecar lines (INDEX) of the given archives."""
    lines = spark.read.schema(INDEX).option("pathGlobFilter", "*.cdxj").json(target)
    names = archives.select("archive")
    return lines.join(bounded(names, names.count()), "archive", "left_semi")


def read_records(index: DataFrame, target: str, payloads: bool = False) -> DataFrame:
    """(page_id, type, payload_bytes, digest, refers_to, intact[, payload]) of the records of an index, fetched by offset.

    Digest and size of a response are those of the payload that was read, ``intact`` compares them
    with the record's fields; a revisit has those of the page it repeats. Ids are strings.
    """
    kinds = {"page_id": pa.string(), "type": pa.string(), "payload_bytes": pa.int64(), "digest": pa.string(), "refers_to": pa.string(), "intact": pa.bool_()}
    kinds |= {"payload": pa.binary()} if payloads else {}

    def record(data: bytes) -> tuple:
        stream = RecordStream(inflated([data]))
        known = fields(stream.header())
        pieces = stream.block(int(known["content-length"]))
        block = b"".join(pieces)
        http, _, body = block.partition(b"\r\n\r\n")
        said = int(fields(http)["content-length"])
        stated = known["warc-payload-digest"].removeprefix("sha1:")
        text = lambda name: unquote_plus(known[name]) if name in known else None
        revisit = known["warc-type"] == "revisit"
        digest = stated if revisit else base64.b32encode(hashlib.sha1(body).digest()).decode()
        size = said if revisit else len(body)
        return text("warc-page-id"), known["warc-type"], size, digest, text("warc-refers-to-page-id"), digest == stated and size == said and stream.whole, body

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = _opened(target)
        name = file = None
        for batch in batches:
            out = []
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True):
                if archive != name:
                    name, file = archive, files.open_input_file(f"{folder}/{archive}")
                file.seek(offset)
                out.append(record(file.read(length))[:len(kinds)])
            columns = zip(*out, strict=True) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    schema = "page_id string, type string, payload_bytes long, digest string, refers_to string, intact boolean" + (", payload binary" if payloads else "")
    return index.select("archive", "offset", "length").mapInArrow(run, schema)


def archived_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """One row per page as it reads back from normalised archives: id, payload_bytes, payload_digest, record_type, refers_to.

    Of pages with equal payloads that with the largest id is the response and the others revisit it;
    rows that repeat that id are responses too. A NULL id is smaller than any other and refers to
    the largest; where all ids of a group are NULL, all are responses. A NULL html is an empty
    payload, a NULL url is left out. Other columns are ignored; no pages give no records.
    """
    spark = pages.sparkSession
    kind = pages.select(F.col(f"`{id_col}`")).schema[0].dataType
    scratch = Scratch(spark)
    crawled, target = shared_folder(spark, "crawl"), shared_folder(spark, "warc")
    write_monolithic(page_records(pages, scratch, id_col, url_col, html_col, min_revisit_bytes), crawled)
    scratch.drop()
    archives = scratch.keep(normalise_archives(spark, crawled, target))
    scratch.paths.insert(0, crawled)
    scratch.drop(keep_last=1)  # the streams are no longer needed
    found = read_records(read_index(spark, target, archives), target)
    return found.select(
        F.col("page_id").cast(kind).alias(id_col), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"))

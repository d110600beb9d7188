"""WARC archives with revisit records, and a two-level capture index to read them by.

Writing: every page becomes one gzip member of an archive file in the shared folder; of pages with
equal payloads the one with the smallest page_id is a response, the others are revisits that hold
no payload. A task writes files of its own under names never used before, and only rows of tasks
that Spark committed tell of them, so a lost or repeated task leaves nothing behind but an unread
file.

Index, level 1: one line per capture, beginning with the reversed-host key of its url and the
page_id, sorted over all captures and cut into shards by Spark's range partitioning; a shard is a
file of gzip blocks of ``block`` lines. Level 2: the shard's sparse directory, one line per block
with the block's first entry and place. A search finds the shards whose range holds the entry,
binary-searches the directory, reads that one block, binary-searches its lines, and only then
reads the byte range of the capture from its archive.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import file_system, only, scratch_path, ship_code, written
from wardflow.llm.url_rules import host_and_path, sweep

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@dataclass(frozen=True)
class WarcParams:
    min_revisit_bytes: int = 0
    block: int = 1000
    file_bytes: int = 1 << 30
    level: int = 3
    date: str = "1970-01-01T00:00:00Z"


def payload_digest(payload: Column) -> Column:
    """SHA-1 in upper-case base32, from the hex digest taken 20 bits at a time."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def capture_key(url: Column) -> Column:
    """Reversed host, a closing parenthesis, and the rest without fragment, in visible ASCII."""
    host, path = host_and_path(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    turned = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.regexp_replace(F.concat(turned, F.lit(")"), path, query), r"[^\x21-\x7E]", "%")


def _line(text: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m.group()):02X}", text)


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record: a response with its payload, or a revisit that refers to a response."""
    revisit = refers_to is not None
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             b"Content-Length: %d\r\n\r\n" % len(payload) + (b"" if revisit else payload))
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Target-URI: {_line(url or 'urn:page:none')}", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers, payload and its length of one record as written above."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    named = re.search(rb"Content-Length: (\d+)", http)
    page = re.match(r"<urn:page:(-?\d*)>", fields["WARC-Record-ID"])[1]
    refers = re.match(r"<urn:page:(-?\d+)>", fields.get("WARC-Refers-To", ""))
    return {"page_id": int(page) if page else None, "type": fields["WARC-Type"],
            "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
            "payload": payload, "payload_bytes": int(named[1]),
            "refers_to": int(refers[1]) if refers else None, "url": fields["WARC-Target-URI"]}


def _packed(raw: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _unpacked(raw: bytes) -> bytes:
    return zlib.decompress(raw, 31)


def _write_batches(path: str, params: WarcParams):
    def run(batches):
        where, inner = file_system(path)
        out, name, at = None, "", 0
        for batch in batches:
            rows = {n: [] for n in ("entry", "file", "offset", "length")}
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for entry, page_id, url, html, digest, refers_to in zip(*columns):
                if out is None or at >= params.file_bytes:
                    if out is not None:
                        out.close()
                    name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out, at = where.open_output_stream(f"{inner}/{name}", compression=None), 0
                member = _packed(record_bytes(page_id, url, (html or "").encode("utf-8"), digest,
                                              refers_to, params.date), params.level)
                out.write(member)
                for key, value in zip(rows, (entry, name, at, len(member))):
                    rows[key].append(value)
                at += len(member)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["entry"], pa.string()), pa.array(rows["file"], pa.string()),
                 pa.array(rows["offset"], pa.int64()), pa.array(rows["length"], pa.int64())],
                list(rows))
        if out is not None:
            out.close()
    return run


def _index_batches(path: str, params: WarcParams):
    """Sorted captures of one shard in, one row about the shard out."""
    def run(batches):
        where, inner = file_system(path)
        out, name, at, waiting, directory, last = None, "", 0, [], [], ""

        def flush():
            nonlocal at, waiting
            member = _packed("".join(waiting).encode("utf-8"), 6)
            directory.append(f"{waiting[0].split(' {', 1)[0]}\t{at}\t{len(member)}\n")
            out.write(member)
            at += len(member)
            waiting = []

        for batch in batches:
            for entry, file, offset, length in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
                    out = where.open_output_stream(f"{inner}/{name}.cdx.gz", compression=None)
                said = json.dumps({"filename": file, "offset": offset, "length": length})
                waiting.append(f"{entry} {said}\n")
                last = entry
                if len(waiting) >= params.block:
                    flush()
        if out is None:
            return
        if waiting:
            flush()
        out.close()
        with where.open_output_stream(f"{inner}/{name}.dir") as side:
            side.write("".join(directory).encode("utf-8"))
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([directory[0].split("\t")[0]]), pa.array([last]),
             pa.array([len(directory)], pa.int64())], ["shard", "first", "last", "blocks"])
    return run


@dataclass(frozen=True)
class Archive:
    """Where the archives are, where their index is, and the shards with their entry ranges."""

    path: str
    index: str
    shards: DataFrame


def entry_column(url: Column, page_id: Column) -> Column:
    """The sort entry of a capture: its key and the page_id in fixed width."""
    # Shifted by 2^63, so that negative numbers sort before positive ones.
    number = F.lpad((page_id.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)"))
                    .cast("string"), 20, "0")
    return F.concat_ws(" ", capture_key(url), F.coalesce(number, F.lit("-")))


def write_archive(pages: DataFrame, params: WarcParams = WarcParams()) -> Archive:
    """Write ``pages(page_id, url, html)`` as archives and index them; see ``read_back``."""
    spark = pages.sparkSession
    ship_code(spark)
    pages = only(pages, page_id="long", url="string", html="string")
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", "html", F.octet_length(payload).alias("n"),
                        payload_digest(payload.cast("binary")).alias("digest"))
    again = written(rows.groupBy("digest", "n").agg(
        F.min("page_id").alias("original"), F.count("digest").alias("m"))
        .where((F.col("m") > 1) & (F.col("n") >= params.min_revisit_bytes))
        .select("digest", "n", "original"), "repeated-payloads")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("original")), F.col("original"))
    records = rows.join(again, ["digest", "n"], "left").select(
        entry_column(F.col("url"), F.col("page_id")).alias("entry"), "page_id", "url", "html",
        "digest", refers_to.alias("refers_to"))
    path, index = scratch_path(spark, "warc"), scratch_path(spark, "cdx")
    for folder in (path, index):
        where, inner = file_system(folder)
        where.create_dir(inner, recursive=True)
    captures = written(records.mapInArrow(
        _write_batches(path, params), "entry string, file string, offset long, length long"),
        "captures")
    shards = written(
        captures.repartitionByRange("entry").sortWithinPartitions("entry", "file", "offset")
        .mapInArrow(_index_batches(index, params),
                    "shard string, first string, last string, blocks long"), "shards")
    return Archive(path, index, shards)


class Reader:
    """Searches of one task: directories, blocks and archive files opened once each."""

    def __init__(self, path: str, index: str):
        self.where, self.path = file_system(path)
        self.index_where, self.index = file_system(index)
        self.directory: tuple[str, list, list] = ("", [], [])
        self.block: tuple[tuple, list] = ((), [])
        self.file: tuple[str, object] = ("", None)

    def _directory(self, shard: str):
        if self.directory[0] != shard:
            with self.index_where.open_input_stream(f"{self.index}/{shard}.dir") as side:
                lines = side.read().decode("utf-8").splitlines()
            places = [line.split("\t") for line in lines]
            self.directory = (shard, [p[0] for p in places],
                              [(int(p[1]), int(p[2])) for p in places])
        return self.directory[1:]

    def _lines(self, shard: str, place: tuple[int, int]) -> list[tuple[str, str]]:
        if self.block[0] != (shard, place):
            with self.index_where.open_input_file(f"{self.index}/{shard}.cdx.gz") as file:
                raw = _unpacked(file.read_at(place[1], place[0]))
            split = [line.split(" {", 1) for line in raw.decode("utf-8").splitlines()]
            self.block = ((shard, place), [(a, "{" + b) for a, b in split])
        return self.block[1]

    def find(self, shard: str, entry: str) -> list[dict]:
        """Index rows of an entry in a shard."""
        firsts, places = self._directory(shard)
        at = max(0, bisect.bisect_left(firsts, entry) - 1)
        out = []
        while at < len(firsts) and firsts[at] <= entry:
            lines = self._lines(shard, places[at])
            i = bisect.bisect_left(lines, (entry, ""))
            while i < len(lines) and lines[i][0] == entry:
                out.append(json.loads(lines[i][1]))
                i += 1
            at += 1
        return out

    def record(self, capture: dict) -> dict:
        if self.file[0] != capture["filename"]:
            if self.file[1] is not None:
                self.file[1].close()
            self.file = (capture["filename"],
                         self.where.open_input_file(f"{self.path}/{capture['filename']}"))
        raw = self.file[1].read_at(capture["length"], capture["offset"])
        return parse_record(_unpacked(raw))


def _read_batches(path: str, index: str):
    def run(batches):
        reader = Reader(path, index)
        for batch in batches:
            # Captures of a batch are read file by file in order of their place.
            found = [c for shard, entry in zip(*[c.to_pylist() for c in batch.columns])
                     for c in reader.find(shard, entry)]
            found.sort(key=lambda c: (c["filename"], c["offset"]))
            rows = []
            for capture in found:
                r = reader.record(capture)
                if r["type"] == "response":
                    made = base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode()
                    if made != r["digest"] or len(r["payload"]) != r["payload_bytes"]:
                        raise ValueError(f"damaged record of page {r['page_id']}")
                rows.append(r)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in (
                    ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                    ("digest", pa.string()), ("type", pa.string()), ("refers_to", pa.int64()))]
                + [pa.array([r["payload"].decode("utf-8") if r["type"] == "response" else None
                             for r in rows], pa.string())],
                ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"])
    return run


def search(archive: Archive, wanted: DataFrame) -> DataFrame:
    """Captures of ``wanted(url, page_id)``, each distinct pair once, read through the index."""
    entries = only(wanted, url="string", page_id="long").select(
        entry_column(F.col("url"), F.col("page_id")).alias("entry")).distinct()
    # A shard is a range of entries, and equal entries are in one range: the shard of an entry is
    # the last one that begins at or before it, found by a sorted sweep over both.
    placed = sweep(entries.withColumnRenamed("entry", "key"), archive.shards.select(
        F.col("first").alias("key"), F.col("shard").alias("stack"))).where("stack IS NOT NULL")
    return placed.select(F.col("stack").alias("shard"), F.col("key").alias("entry")) \
        .repartition("shard").sortWithinPartitions("shard", "entry").mapInArrow(
            _read_batches(archive.path, archive.index),
            "page_id long, payload_bytes long, payload_digest string, record_type string, "
            "refers_to long, html string")


def read_back(pages: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """Archive ``pages(page_id, url, html)`` and read every page's capture back by its index.

    Returns ``page_id, payload_bytes, payload_digest, record_type, refers_to, html``; the payload
    is only in responses, and is checked against its digest. Payloads of fewer than
    ``min_revisit_bytes`` bytes are always responses.

    Null html: an empty payload. Null url: an empty host and path. Null page_id: kept; it is a
    revisit when a page with an id has the same payload. Repeated rows are archived and returned
    each; those that have the smallest page_id of their payload are all responses. An empty table
    gives an empty result; extra columns are ignored.
    """
    return search(write_archive(pages, params), pages)


WARC_ORACLE = """
WITH page AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
        sha1(coalesce(html, '')) AS hexed
    FROM pages
), digest AS (
    SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
            (CAST('0x' || substr(hexed, 1 + 5 * (i // 4), 5) AS BIGINT)
                >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest
    FROM page
), first AS (
    SELECT payload_digest, payload_bytes, min(page_id) AS original FROM digest GROUP BY ALL
)
SELECT page_id, d.payload_bytes, d.payload_digest,
    CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> original THEN original END AS refers_to
FROM digest d JOIN first f USING (payload_digest, payload_bytes)
"""

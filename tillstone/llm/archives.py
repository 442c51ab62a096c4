"""Web archives: ARC files of either version, WARC files, and the conversion from one to the other.

Records are rows with a binary block. Archives are written by Spark's text sink,
as many files of bounded size for each partition as its records need, and read
as binary files: a task holds one archive as it is stored and parses it record
by record by the declared lengths. An archive from elsewhere must fit one row,
which Spark limits to 2 GB.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.llm.common import same, settle
from tillstone.session import new_workspace

# The field names in the header of an ARC file of version 1 and 2, and the WARC names.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC = "WARC/1.0"
ARC_END, WARC_END = b"\n", b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

#: Rows go on in parts of about this many bytes.
PART = 8_000_000


@dataclass(frozen=True)
class Crawl:
    """What a page row does not say: the date and address of the capture. Payloads of fewer bytes than
    ``least_revisit`` are never revisits."""

    date: str = "20250101000000"
    ip: str = "0.0.0.0"
    agent: str = "tillstone"
    least_revisit: int = 0
    #: An archive ends with the record that brings it to this many bytes, before compression.
    archive_bytes: int = 256_000_000


class Volumes:
    """The archives of a partition, one after the other: what is written goes into the last begun."""

    schema = "volume int, seq long, content binary"

    def __init__(self, kind: str, end: bytes, limit: int) -> None:
        self.partition, self.kind, self.end, self.limit = TaskContext.get().partitionId(), kind, len(end), limit
        self.volume, self.seq, self.offset = -1, 0, limit

    def full(self) -> bool:
        return self.offset >= self.limit

    def begin(self) -> str:
        """The name of a new archive."""
        self.volume, self.offset = self.volume + 1, 0
        return f"part-{self.partition:05d}-{self.volume:05d}.{self.kind}"

    def row(self, record: bytes) -> tuple[int, int, bytes]:
        self.seq, self.offset = self.seq + 1, self.offset + len(record) + self.end
        return self.volume, self.seq, record


def sink(rows: DataFrame, path: str, end: bytes) -> None:
    """Writes the bytes of ``content``, each row followed by ``end``, gzipped, a folder for each ``volume``."""
    text = rows.sortWithinPartitions("volume", "seq").select("volume", F.col("content").cast("string").alias("content"))
    lines = text.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("lineSep", end.decode())
    lines.partitionBy("volume").text(path)


def files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def file_of(path: str) -> str:
    """A name for an archive that a rerun of the job that writes it does not change."""
    own = re.search(r"(volume=\d+/part-\d+)[^/]*$", path)
    return own[1] if own else path.rsplit("/", 1)[1]


def parts(rows: Iterator[tuple], names: list[str]) -> Iterator[pd.DataFrame]:
    """Rows in frames of bounded size; the last value of a row is its block."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 500 + len(row[-1] or b"")
        if size > PART:
            yield pd.DataFrame(held, columns=names)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=names)


def opened(content: bytes) -> io.BufferedReader:
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else io.BufferedReader(raw)


# ARC


def http_response(page_id: object, payload: bytes) -> bytes:
    number = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{number}\r\n"
    return head.encode() + payload


def arc_header(version: int, name: str, crawl: Crawl) -> bytes:
    body = f"{version} 0 {crawl.agent}\n{ARC_FIELDS[version]}\n".encode()
    line = f"filedesc://{name} {crawl.ip} {crawl.date} text/plain"
    if version == 2:
        line += f" 200 - - 0 {name}"
    return f"{line} {len(body)}\n".encode() + body


def arc_record(version: int, name: str, offset: int, url: str, block: bytes, crawl: Crawl) -> bytes:
    url = re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], (url or "-").encode()) or b"-"
    line = f" {crawl.ip} {crawl.date} text/html"
    if version == 2:
        line += f" 200 {hashlib.md5(block).hexdigest()} - {offset} {name}"
    return url + f"{line} {len(block)}\n".encode() + block


def write_arc(pages: DataFrame, path: str, crawl: Crawl = Crawl()) -> None:
    """ARC files of each partition of (page_id, url, html), version 1 and 2 in turn.

    A NULL html is an empty payload, a NULL or empty url is ``-``; blanks and
    control characters in a url are percent-encoded, as the header needs.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archive = Volumes("arc", ARC_END, crawl.archive_bytes)
        version = 1 + archive.partition % 2

        def records() -> Iterator[tuple]:
            name = ""
            for batch in batches:
                for page_id, url, html in zip(batch["page_id"], batch["url"], batch["html"]):
                    if archive.full():
                        name = archive.begin()
                        yield archive.row(arc_header(version, name, crawl))
                    yield archive.row(arc_record(version, name, archive.offset, url, http_response(page_id, html or b""), crawl))

        yield from parts(records(), ["volume", "seq", "content"])

    rows = pages.select(F.col("page_id").cast("string").alias("page_id"), "url", F.col("html").cast("binary").alias("html"))
    sink(rows.mapInPandas(run, Volumes.schema), path, ARC_END)


def arc_fields(line: bytes, names: list[str]) -> dict[str, str] | None:
    """The fields of a header line; None if it is none. Those after the url are split off from the right, as old urls may hold blanks."""
    values = line.rstrip(b"\r\n").rsplit(b" ", len(names) - 1)
    if len(values) != len(names):
        return None
    fields = {n: v.decode("utf-8", "replace") for n, v in zip(names, values)}
    readable = re.fullmatch("[0-9]+", fields["Archive-length"]) and re.fullmatch("[0-9]{4,14}", fields["Archive-date"])
    return fields if readable else None


def arc_declared(line: bytes, file: io.BufferedReader) -> tuple[int, list[str], bytes] | None:
    """Version, field names and body of the filedesc record that ``line`` begins; None if it is none of a known version."""
    length = line.rstrip().rsplit(b" ", 1)[-1]
    if not line.startswith(b"filedesc://") or not length.isdigit():
        return None
    body = file.read(int(length))
    first, second, *_ = [*body.decode("latin-1").split("\n"), "", ""]
    number = first.split(" ")[0]
    return (int(number), second.split(), body) if number in map(str, ARC_FIELDS) and {"Archive-length", "Archive-date"} <= set(second.split()) else None


def arc_records(content: bytes) -> Iterator[dict]:
    """The records of an ARC file as dictionaries by the field names that its header declares, with ``block``.

    A record that the file cuts short has what is there and ``cut``. What does
    not begin with a header line is skipped up to the next one, and comes as a
    dictionary of ``unreadable``, the bytes, and ``start``; so does a whole file
    without a filedesc record of a known version.
    """
    file, declared, offset, skipped = opened(content), None, 0, []
    while line := file.readline():
        start, offset = offset, offset + len(line)
        if not line.strip() and not skipped:
            continue
        fields = arc_fields(line, declared[1]) if declared else None
        if declared is None and (declared := arc_declared(line, file)):
            offset += len(declared[2])
        elif fields is None:
            # A filedesc of unknown form has been read on: its body is parsed as lines.
            if file.tell() != offset:
                file.seek(offset)
            skipped.append(line)
            continue
        if skipped:
            yield {"unreadable": b"".join(skipped), "start": start - sum(map(len, skipped))}
            skipped = []
        if fields:
            length = int(fields["Archive-length"])
            block = file.read(length)
            offset += len(block)
            yield fields | {"block": block, "cut": len(block) < length, "version": declared[0], "start": start}
    if skipped:
        yield {"unreadable": b"".join(skipped), "start": offset - sum(map(len, skipped))}


def warc_date(date: str) -> str:
    """The timestamp of an ARC date of up to 14 digits; what it leaves out is the start of the year, month or day."""
    digits = re.sub(r"[^0-9]", "", date)[:14]
    full = digits + "00000101000000"[len(digits) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:]}Z"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP header; the whole block if it has none."""
    if not block.startswith(b"HTTP/"):
        return block
    return block.partition(b"\r\n\r\n")[2]


def page_of(block: bytes) -> str | None:
    found = re.search(rb"\r\nX-Page-Id: ([^\r]*)", block.partition(b"\r\n\r\n")[0]) if block.startswith(b"HTTP/") else None
    return found[1].decode() if found else None


CONVERTED = ["record_id", "record_type", "uri", "ip", "date", "mime", "page_id", "cut", "payload_digest", "payload_bytes", "block"]
CONVERTED_SCHEMA = (
    "record_id string, record_type string, uri string, ip string, date string, mime string, page_id string, cut boolean, "
    "payload_digest string, payload_bytes long, block binary"
)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the ARC files in ``path``, with the identifiers, timestamps, types and digests of WARC.

    An identifier is a name-based UUID of file number, offset, url and date. A
    block that begins with an HTTP status line is a response, any other one a
    resource of the declared type. What cannot be read is a row of type
    ``unreadable``, its uri the file and the place.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def records() -> Iterator[tuple]:
            for batch in batches:
                for name, content in zip(batch["path"], batch["content"]):
                    file = file_of(name)
                    for r in arc_records(content):
                        if lost := r.get("unreadable"):
                            place = f"{file}#{r['start']}"
                            identifier = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, place)}>"
                            yield identifier, "unreadable", place, None, None, None, None, False, sha1(lost), len(lost), lost
                            continue
                        block, http = r["block"], r["block"].startswith(b"HTTP/")
                        payload = payload_of(block)
                        key = f"{file}:{r['start']}:{r['URL']}:{r['Archive-date']}"
                        yield (
                            f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}>", "response" if http else "resource",
                            r["URL"], r["IP-address"], warc_date(r["Archive-date"]),
                            "application/http; msgtype=response" if http else r["Content-type"],
                            page_of(block), r["cut"], sha1(payload), len(payload), block,
                        )

        yield from parts(records(), CONVERTED)

    return files(spark, path).mapInPandas(run, CONVERTED_SCHEMA)


# WARC


def with_revisits(records: DataFrame, crawl: Crawl = Crawl()) -> DataFrame:
    """Of responses with equal payloads the one with the largest page_id stays, the others revisit it.

    Ids that are no whole numbers are compared as text and are below all numbers,
    NULL is below them; of repeated rows with the largest id one stays, by its
    identifier. The blocks of revisits shrink to the HTTP header.
    """
    number = F.expr("try_cast(page_id as decimal(38,0))")
    able = (F.col("record_type") == "response") & (F.col("payload_bytes") >= crawl.least_revisit)
    groups = records.filter(able).groupBy(F.col("payload_digest").alias("g_digest")).agg(
        F.count("*").alias("n"), F.max(F.struct(number.alias("number"), "page_id", F.col("record_id").alias("id"), "uri", "date")).alias("first")
    )
    first = settle(groups.filter("n > 1").select("g_digest", F.col("first.id").alias("to_id"), F.col("first.uri").alias("to_uri"), F.col("first.date").alias("to_date")), "archive-groups")
    joined = records.join(first, able & (F.col("payload_digest") == F.col("g_digest")), "left")
    again = F.col("to_id").isNotNull() & (F.col("to_id") != F.col("record_id"))
    # The block is text or not: the place of the header's end is searched in its bytes.
    head = F.expr("substring(block, 1, instr(cast(block as string), '\r\n\r\n') + 3)")
    return joined.select(
        *[c for c in records.columns if c not in ("record_type", "block")],
        F.when(again, "revisit").otherwise(F.col("record_type")).alias("record_type"),
        *[F.when(again, F.col(c)).alias(c) for c in ("to_id", "to_uri", "to_date")],
        F.when(again, head).otherwise(F.col("block")).alias("block"),
    )


def warc_record(fields: dict[str, object], block: bytes) -> bytes:
    lines = [WARC, *(f"{k}: {v}" for k, v in fields.items() if v is not None), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block


def write_warc(records: DataFrame, path: str, crawl: Crawl = Crawl()) -> None:
    """WARC files of each partition, a warcinfo record first in each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archive = Volumes("warc", WARC_END, crawl.archive_bytes)

        def written() -> Iterator[tuple]:
            for batch in batches:
                for r in batch.to_dict("records"):
                    if archive.full():
                        name = archive.begin()
                        info = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", "WARC-Date": warc_date(crawl.date), "WARC-Filename": name, "Content-Type": "application/warc-fields"}
                        yield archive.row(warc_record(info, f"software: {crawl.agent}\r\nformat: WARC File Format 1.0\r\n".encode()))
                    fields = {
                        "WARC-Type": r["record_type"], "WARC-Record-ID": r["record_id"], "WARC-Date": r["date"],
                        "WARC-Target-URI": r["uri"], "WARC-IP-Address": r["ip"],
                        "WARC-Payload-Digest": f"sha1:{r['payload_digest']}", "WARC-Block-Digest": f"sha1:{sha1(r['block'])}",
                        "WARC-Truncated": "unspecified" if r["cut"] else None, "Content-Type": r["mime"],
                    }
                    if r["record_type"] == "revisit":
                        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": r["to_id"], "WARC-Refers-To-Target-URI": r["to_uri"], "WARC-Refers-To-Date": r["to_date"]}
                    yield archive.row(warc_record(fields, r["block"]))

        yield from parts(written(), ["volume", "seq", "content"])

    sink(records.mapInPandas(run, Volumes.schema), path, WARC_END)


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of the records of a WARC file; field names in lower case."""
    file = opened(content)
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a WARC record: {line[:100]!r}")
        fields = {}
        while (line := file.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        yield fields, file.read(int(fields["content-length"]))


READ = ["record_id", "record_type", "uri", "date", "page_id", "to_id", "payload_digest", "payload_bytes", "block"]


def read_warc(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """The records of the WARC files in ``path`` but warcinfo; digests of responses are those of the payload read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def records() -> Iterator[tuple]:
            for batch in batches:
                for content in batch["content"]:
                    for fields, block in warc_records(content):
                        kind = fields["warc-type"]
                        if kind == "warcinfo":
                            continue
                        payload = payload_of(block)
                        revisit = kind == "revisit"
                        yield (
                            fields["warc-record-id"], kind, fields.get("warc-target-uri"), fields["warc-date"], page_of(block),
                            fields.get("warc-refers-to"),
                            fields["warc-payload-digest"].removeprefix("sha1:") if revisit else sha1(payload),
                            None if revisit else len(payload), block if blocks else None,
                        )

        for frame in parts(records(), READ):
            yield frame.astype({"payload_bytes": "Int64"})

    schema = "record_id string, record_type string, uri string, date string, page_id string, to_id string, payload_digest string, payload_bytes long, block binary"
    return files(spark, path).mapInPandas(run, schema)


def convert(spark: SparkSession, arc_path: str, warc_path: str, crawl: Crawl = Crawl()) -> DataFrame:
    """Writes the ARC files of ``arc_path`` anew as WARC files, equal payloads as revisits; returns what was unreadable."""
    records = settle(read_arc(spark, arc_path), "archive-records")
    write_warc(with_revisits(records.filter("record_type != 'unreadable'"), crawl), warc_path, crawl)
    return records.filter("record_type = 'unreadable'").select("record_id", F.col("uri").alias("place"), "block")


def op6(pages: DataFrame, crawl: Crawl = Crawl()) -> DataFrame:
    """Pages to ARC files, these to WARC files, and these read back: one row for each row of ``pages``.

    NULL html is an empty payload. Without pages there are no files and no rows.
    """
    spark = pages.sparkSession
    arc, warc = new_workspace(spark, "archive-arc"), new_workspace(spark, "archive-warc")
    write_arc(pages, arc, crawl)
    convert(spark, arc, warc, crawl)
    records = settle(read_warc(spark, warc, blocks=False).drop("block", "uri", "date"), "archive-read")
    targets = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("t_id"), F.col("page_id").alias("t_page"), F.col("payload_bytes").alias("t_bytes")
    )
    kind = pages.schema["page_id"].dataType
    return records.join(targets, same(F.col("to_id"), F.col("t_id")), "left").select(
        F.col("page_id").cast(kind).alias("page_id"),
        F.coalesce("payload_bytes", "t_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.col("t_page").cast(kind).alias("refers_to"),
    )

"""WARC archives with revisit records, and a reader that salvages damaged ones.

Archives are gzip members, one per record, written by Spark's text writer: a row is a run of
members, and the line separator is an empty gzip member, which is legal and holds no byte. So the
commit protocol covers lost tasks on any file system Spark writes to, and tools that read
concatenated gzip read the files.

The reader takes a file from the start, members and plain records in any order. Where a member does
not inflate, a record has no version line, its length does not fit or its block digest is wrong, the
reader looks for the next place at which a valid member or a sound plain record begins, goes on
there, and logs the bytes in between as a quarantined gap. Of a damaged member the records in front
of the first that fails are kept if their digests hold. So are those of a member that the file's end
cuts off - the last of them only if the compressed stream says that it ends there - and all of one in
which nothing but the checksum is wrong; no digest covers a header, so where no checksum does either
the records are marked - their headers are not verified - and must have all mandatory fields.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from . import common

CRLF = b"\r\n"
# Fixed value: the gzip member of an empty file, as latin-1 text.
EMPTY_MEMBER = (b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03" b"\x03\x00" + bytes(8)).decode("latin-1")
CHUNK_BYTES = 1 << 20             # members are handed to the writer in runs of about this size
FILE_CHUNKS = 128                 # rows, and so about so many MB, in one file
_GZIP = b"\x1f\x8b\x08"
# The fields every record has.
MANDATORY = {"warc-record-id", "warc-type", "warc-date", "content-length"}
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_INPUT = 1 << 16


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    """One uncompressed record; line breaks in values become spaces, they would end the field."""
    head = [f"WARC-Type: {kind}"]
    head += [f"{k}: {re.sub(r'[\r\n]+', ' ', v)}" for k, v in fields.items()]
    head += [f"WARC-Block-Digest: sha1:{base32_sha1(block)}", f"Content-Length: {len(block)}"]
    text = "WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n"
    return text.encode("utf-8", "replace") + block + CRLF + CRLF


def page_record(page_id: int | None, url: str | None, payload: bytes,
                refers_to: int | None) -> bytes:
    """Response record of a page, or the revisit of the page ``refers_to`` with equal payload."""
    fields = {"WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
              "WARC-Target-URI": url or "", "WARC-Date": "1970-01-01T00:00:00Z",
              "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
              "X-Payload-Length": str(len(payload)),
              "Content-Type": "application/http; msgtype=response"}
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    if refers_to is None:
        return record("response", fields, head + payload)
    fields["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
    fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    return record("revisit", fields, head)


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


@dataclass
class Record:
    start: int                    # byte place of the record (of its member) in the file
    fields: dict[str, str]
    block: bytes
    verified: bool = True         # False: only digests vouch for it, not the member's checksum

    @property
    def kind(self) -> str:
        return self.fields.get("warc-type", "")

    def payload(self) -> bytes:
        """What follows the HTTP head of a response."""
        return self.block.partition(CRLF + CRLF)[2]


@dataclass
class Salvage:
    """Result of reading one file: gaps are (start, end, reason) of quarantined bytes."""

    records: list[Record] = field(default_factory=list)
    gaps: list[tuple[int, int, str]] = field(default_factory=list)


def parse_record(data, at: int) -> tuple[Record | None, int, str]:
    """(record, place behind it, "") - or (None, at, reason)."""
    version = _VERSION.match(data, at)
    if not version:
        return None, at, "no version line"
    end = data.find(CRLF + CRLF, at)
    if end < 0:
        return None, at, "open header"
    fields = {}
    for line in data[version.end():end].split(CRLF):
        name, colon, value = line.partition(b":")
        if not colon:
            return None, at, "bad header line"
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", size):
        return None, at, "bad length"
    start, stop = end + 4, end + 4 + int(size)
    if data[stop:stop + 4] != CRLF + CRLF:
        return None, at, "length does not fit"
    block = data[start:stop]
    want = fields.get("warc-block-digest", "")
    if want.startswith("sha1:") and want[5:] != base32_sha1(block):
        return None, at, "block digest"
    if fields.get("warc-type") == "response":
        want = fields.get("warc-payload-digest", "")
        if want.startswith("sha1:") and want[5:] != base32_sha1(
                block.partition(CRLF + CRLF)[2]):
            return None, at, "payload digest"
    return Record(at, fields, block), stop + 4, ""


def inflate(data, at: int) -> tuple[bytes | None, int]:
    """Content of the member at ``at`` and the place behind it; (None, at) if it is damaged."""
    z = zlib.decompressobj(31)
    out, here = [], at
    try:
        while not z.eof:
            piece = data[here:here + _INPUT]
            if not piece:
                return None, at
            out.append(z.decompress(piece))
            here += len(piece)
    except zlib.error:
        return None, at
    return b"".join(out), here - len(z.unused_data)


CUT, CHECKSUM, BROKEN = "member cut off", "member checksum", "damaged member"


def inflated_part(data, at: int) -> tuple[bytes, int, str]:
    """What the damaged member at ``at`` gives before the error, the place of the error, and its kind:
    the data ends, only the checksum or length behind the content is wrong, or anything else."""
    z = zlib.decompressobj(31)
    out, here, step = [], at, _INPUT
    while here < len(data):
        before = z.copy() if step > 1 else z
        try:
            out.append(z.decompress(data[here:here + step]))
            here += step
        except zlib.error as error:
            if step == 1:
                kind = CHECKSUM if re.search("incorrect (data|length) check", str(error)) else BROKEN
                return b"".join(out), here, kind
            z, step = before, 1       # again, byte by byte: an error takes the output of its call
    return b"".join(out), len(data), CUT


def _cut_trailer(data, at: int) -> bytes | None:
    """Of a member that the end of the data cuts off, what there is of its checksum and length; None if
    its compressed stream is cut as well."""
    flags, here = data[at + 3] if at + 3 < len(data) else 0, at + 10
    if flags & 4:
        here += 2 + int.from_bytes(data[here:here + 2], "little")
    for flag in (8, 16):              # name and comment end in a zero byte
        if flags & flag:
            here = data.find(b"\0", here) + 1 or len(data)
    if flags & 2:
        here += 2
    z = zlib.decompressobj(-15)
    try:
        while not z.eof and here < len(data):
            z.decompress(data[here:here + _INPUT])
            here += _INPUT
    except zlib.error:
        return None
    return z.unused_data if z.eof else None


def salvage(data: bytes) -> Salvage:
    """All records of a file, compressed or not, that pass their checks, and the gaps."""
    out, at, bad, reason = Salvage(), 0, -1, ""
    taken, reach = [], 0              # records of a damaged member, and how far it was read
    member = version = -1             # next signature and next version line
    while at < len(data):
        packed = data[at:at + 3] == _GZIP
        if packed:
            content, behind = inflate(data, at)
            inner = None if content is None else _salvage_plain(content)
        else:
            rec, behind, why = parse_record(data, at)
            inner = Salvage([rec]) if rec else None
        if inner is not None:
            if bad >= 0:
                out.gaps.append((bad, at, reason))
                bad = -1
            for rec in inner.records:
                rec.start = at
                # stored bytes of a damaged member show its records once more
                if not packed and at < reach and (rec.fields, rec.block) in taken:
                    taken.remove((rec.fields, rec.block))
                else:
                    out.records.append(rec)
            if inner.gaps:
                # the member inflates, so what is wrong is inside: go on behind
                out.gaps.append((at, behind, f"in member: {inner.gaps[0][2]}"))
            at = behind
            continue
        if packed:
            part, error, why = inflated_part(data, at)
            inner = _salvage_plain(part)
            # no digest covers a header: the damage must show behind records that count as verified
            sound = inner.gaps[0][0] if inner.gaps else 0
            found = [r for r in inner.records if (r.start < sound or why != BROKEN)
                     and r.fields.get("warc-block-digest", "").startswith("sha1:")]
            sure = why == BROKEN
            if why == CUT:
                trailer = _cut_trailer(data, at)
                sure = trailer is not None and trailer[:4] == zlib.crc32(part).to_bytes(4, "little")
                if trailer is None and not inner.gaps:
                    found = found[:-1]        # what ends with the data may have been meant longer
            if not sure:
                found = [r for r in found if MANDATORY <= r.fields.keys()]
            for rec in found:
                rec.start, rec.verified = at, sure
                out.records.append(rec)
            if why == CHECKSUM and found and not inner.gaps:
                if bad >= 0:
                    out.gaps.append((bad, at, reason))
                bad, reason, at = error, why, error + 1       # nothing else of it is missing
                continue
            if found:
                taken, reach = [(r.fields, r.block) for r in found], error
        if bad < 0:
            bad, reason = at, why
        if member <= at:
            member = data.find(_GZIP, at + 1)
            member = member if member >= 0 else len(data)
        if version <= at:
            later = _VERSION.search(data, at + 1)
            version = later.start() if later else len(data)
        at = min(member, version)
    if bad >= 0:
        out.gaps.append((bad, len(data), reason))
    return out


def _salvage_plain(data: bytes) -> Salvage:
    out, at, bad, reason = Salvage(), 0, -1, ""
    while at < len(data):
        rec, behind, why = parse_record(data, at)
        if rec:
            if bad >= 0:
                out.gaps.append((bad, at, reason))
                bad = -1
            out.records.append(rec)
            at = behind
            continue
        if bad < 0:
            bad, reason = at, why
        later = _VERSION.search(data, at + 1)
        at = later.start() if later else len(data)
    if bad >= 0:
        out.gaps.append((bad, len(data), reason))
    return out


def deduplicated(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages(page_id, url, payload)`` with refers_to: of equal payloads of at least ``min_bytes``
    bytes the row with the largest page_id is the response, the others refer to it. Rows that share
    that id, and rows of a group without any id, are responses; a null id is smaller than any."""
    digest = F.unhex(F.sha1("payload"))
    big = F.length("payload") >= min_bytes
    groups = common.written(
        pages.filter(big).select("page_id", digest.alias("digest"))
        .groupBy("digest").agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
        .filter("n > 1").select("digest", "largest"), "equal-payloads")
    other = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    keyed = pages.withColumn("digest", F.when(big, digest))
    # counted: few enough groups are broadcast and payloads stay where they are, else both sides
    # are shuffled by digest (large groups are split by the adaptive join)
    return (keyed.join(common.bounded(groups), "digest", "left")
            .select("page_id", "url", "payload", F.when(other, F.col("largest")).alias("refers_to")))


def write(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """A record per row of ``pages(page_id, url, html)``; a null html is an empty payload, a null
    url an empty target; other columns are not written; an empty table writes no record."""
    def members(frames):
        run, size = [], 0
        for frame in frames:
            for row in frame.itertuples(index=False):
                member = gzip_member(page_record(
                    None if pd.isna(row.page_id) else int(row.page_id),
                    row.url if isinstance(row.url, str) else None, bytes(row.payload),
                    None if pd.isna(row.refers_to) else int(row.refers_to)))
                run.append(member)
                size += len(member)
                if size >= CHUNK_BYTES:
                    yield pd.DataFrame({"members": [b"".join(run)]})
                    run, size = [], 0
        if run:
            yield pd.DataFrame({"members": [b"".join(run)]})

    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = deduplicated(rows, min_bytes)
    # ids travel as text: a nullable integer column would lose digits in pandas
    rows = rows.select(F.col("page_id").cast("string").alias("page_id"), "url", "payload",
                       F.col("refers_to").cast("string").alias("refers_to"))
    (rows.mapInPandas(members, "members binary")
     .select(F.col("members").cast("string").alias("value"))
     .write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER)
     .option("maxRecordsPerFile", FILE_CHUNKS).text(path))


RECORDS = ("file string, start long, record_type string, record_id string, url string, "
           "refers_to string, payload_digest string, payload_bytes long, header_verified boolean, "
           "payload binary")
GAPS = "file string, start long, end long, reason string"


def read(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Sound records of all archives below ``path`` (files of up to 2 GB, the limit of a value).
    ``header_verified`` is false for those whose digests hold but whose member's checksum could not be
    checked."""
    def records(frames):
        for frame in frames:
            for file, data in zip(frame["path"], frame["content"], strict=True):
                out = []
                for r in salvage(bytes(data)).records:
                    digest = r.fields.get("warc-payload-digest", "").removeprefix("sha1:")
                    payload = r.payload() if r.kind == "response" else None
                    size = (len(payload) if payload is not None
                            else int(r.fields.get("x-payload-length", "0") or 0))
                    out.append((file, r.start, r.kind, r.fields.get("warc-record-id", ""),
                                r.fields.get("warc-target-uri", ""),
                                r.fields.get("warc-refers-to"), digest, size, r.verified,
                                payload if with_payload else None))
                yield pd.DataFrame(out, columns=[c.split()[0] for c in RECORDS.split(", ")])

    return _files(spark, path).mapInPandas(records, RECORDS)


def gaps(spark: SparkSession, path: str) -> DataFrame:
    """The quarantine log: byte ranges of the archives that hold no sound record."""
    def quarantined(frames):
        for frame in frames:
            for file, data in zip(frame["path"], frame["content"], strict=True):
                out = [(file, *g) for g in salvage(bytes(data)).gaps]
                yield pd.DataFrame(out, columns=["file", "start", "end", "reason"])

    return _files(spark, path).mapInPandas(quarantined, GAPS)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the archives into the shared scratch area and return what reading them gives."""
    spark = pages.sparkSession
    path = session.new_scratch(spark, "warc")
    write(pages, path, min_bytes)

    def page(c: str):
        return F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(.*)>$', 1) AS bigint)")

    return read(spark, path).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"))

"""WARC archives written from pages, and a reader that salvages damaged ones (op2).

The reader checks each record: version line, headers, length, end mark, and the block's
digest where one is stated; of a compressed archive also the gzip member. After a failed
check it searches for the next byte where a whole valid record begins, by a member's magic
bytes or a version line, and goes on there. The bytes passed over are returned as a gap with
the reason. Without a valid record further on, the gap reaches the end of the file. A gzip
member of several records, as of an archive compressed as a whole, is walked in the same way
once it is unpacked; a member that does not unpack to its end is a gap as a whole.

Spark's text sink writes the archives: a record is a "line", and the line separator is the
end mark of a plain record or, between gzip members, an empty member, which readers skip.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tunesmith.llm.common import lookup_join, quoted
from tunesmith.plans.sizing import OWN_LIMIT, fits_broadcast

# Payloads of fewer bytes are never revisits; records in a file; bytes in one batch of the reader.
LEAST_BYTES, FILE_RECORDS, BATCH_BYTES = 1000, 20_000, 16 << 20
# The step in which members are unpacked.
STEP = 1 << 16
LINE, END, MEMBER, VERSION = b"\r\n", b"\r\n\r\n", b"\x1f\x8b\x08", b"WARC/1."
_EMPTY_MEMBER = gzip.compress(b"", mtime=0)
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# Writing


def with_types(pages: DataFrame, payload: str, page: str) -> DataFrame:
    """Adds payload_bytes, payload_digest (hex SHA-1), record_type and refers_to.

    Of the rows with one payload of ``LEAST_BYTES`` or more, those with the largest page id
    are responses and the others (null ids too, unless all are null) revisit it. Only
    payloads that occur more than once are joined; their list is broadcast if its measured
    bytes are few, else the rows are shuffled with hot payloads dealt out.
    """
    known = pages.withColumn("payload_bytes", F.octet_length(payload).cast("long")).withColumn("payload_digest", F.sha1(F.col(payload).cast("binary")))
    known = known.withColumn("__same", F.when(F.col("payload_bytes") >= LEAST_BYTES, F.col("payload_digest")))
    copies = known.where("__same is not null").groupBy("__same").agg(F.count("*").alias("__n"), F.max(page).alias("__first")).where("__n > 1")
    if fits_broadcast(copies, OWN_LIMIT):
        joined = known.join(F.broadcast(copies.drop("__n")), "__same", "left")
    else:
        joined = lookup_join(known, copies, "__same", "__n")
    revisit = F.col("__first").isNotNull() & ~F.col(page).eqNullSafe(F.col("__first"))
    joined = joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
    return joined.withColumn("refers_to", F.when(revisit, F.col("__first"))).drop("__same", "__first")


def _line(name: str, value: Column) -> Column:
    """A header line; none for null. Line ends inside a value are escaped."""
    clean = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def _id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def record(payload: str, page: str, url: str, date: str) -> Column:
    """A whole record up to its end mark, as a string."""
    full = F.col("record_type") == "response"
    block = F.concat(F.lit(_HTTP), F.when(full, F.col(payload)).otherwise(""))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _id(F.col(page))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col(url)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1(block.cast("binary")))),
        _line("X-Payload-Length", F.col("payload_bytes")),
        F.when(full, F.lit("")).otherwise(F.concat(_line("WARC-Profile", F.lit(_PROFILE)), _line("WARC-Refers-To", F.when(~full, _id(F.col("refers_to")))))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block)),
    )
    return F.concat(head, F.lit("\r\n"), block)


def _member(text: Column) -> Column:
    @F.arrow_udf("binary")
    def pack(records: pa.Array) -> pa.Array:
        return pa.array([gzip.compress(r.as_py().encode() + END, 6, mtime=0) for r in records], pa.binary())

    return pack(text)


def write_warc(pages: DataFrame, path: str, payload: str = "html", page: str = "page_id", url: str = "url", members: bool = True, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one record per row; ``members`` compresses each into a gzip member of its own.

    A null payload is empty, a null url has no header, a null page id an empty one. Rows
    that repeat are written each; an empty table gives archives without records. Records
    are dealt out by their bytes: a file holds about ``spark.sql.adaptive.advisoryPartitionSizeInBytes``
    (64 MB unless set) of them, as a reader takes a file whole, and ``FILE_RECORDS`` at most.
    """
    narrow = pages.select(quoted(page).cast("long").alias("p"), quoted(url).cast("string").alias("u"), F.coalesce(quoted(payload), F.lit("")).alias("h"))
    rows = with_types(narrow, "h", "p").select(record("h", "p", "u", date).alias("value"))
    if members:
        rows = rows.select(_member(F.col("value")).cast("string").alias("value"))
        write = rows.hint("rebalance").write.option("encoding", "ISO-8859-1").option("lineSep", _EMPTY_MEMBER.decode("latin-1"))
    else:
        write = rows.hint("rebalance").write.option("lineSep", END.decode())
    write.option("maxRecordsPerFile", FILE_RECORDS).text(path)


# Reading


class Damaged(Exception):
    """Why no valid record begins at a place, and, of a plain one, none at places up to ``beyond`` either."""

    def __init__(self, reason: str, beyond: int = 0):
        super().__init__(reason)
        self.beyond = beyond


def _member_at(content: bytes, at: int) -> tuple[bytes, int]:
    unpack, parts, place = zlib.decompressobj(31), [], at
    try:
        while not unpack.eof:
            if place >= len(content):
                raise Damaged("the member is cut off")
            parts.append(unpack.decompress(content[place : place + STEP]))
            place += STEP
    except zlib.error:
        raise Damaged("the member is damaged") from None
    return b"".join(parts), min(place, len(content)) - len(unpack.unused_data)


def _plain_at(content: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers of any length: they go on to an empty line, and a line without a colon ends the search.

    A version line among the lines passed over has the same lines behind it, so it fails too.
    """
    version = re.compile(rb"WARC/1\.\d+\r\n").match(content, at)
    if not version:
        raise Damaged("no version line")
    headers, line = {}, version.end()
    while (stop := content.find(LINE, line)) != line:
        if stop < 0:
            raise Damaged("the headers do not end", line)
        name, colon, value = content[line:stop].partition(b":")
        if not colon:
            raise Damaged("a header line has no colon", line)
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
        line = stop + len(LINE)
    if not re.fullmatch(r"\d{1,18}", headers.get("content-length", ""), re.ASCII):
        raise Damaged("no content length", line)
    first = line + len(LINE)
    end = first + int(headers["content-length"])
    if content[end : end + len(END)] != END:
        raise Damaged("no end mark after the block", line)
    block = content[first:end]
    method, _, digest = headers.get("warc-block-digest", "").partition(":")
    if method == "sha1" and not _is_sha1(digest, block):
        raise Damaged("the block's digest differs")
    return headers, block, end + len(END)


def _is_sha1(stated: str, block: bytes) -> bool:
    """Digests are stated in hex or, by most crawlers, in base 32."""
    found = hashlib.sha1(block)
    if len(stated) == 40:
        return stated.lower() == found.hexdigest()
    alphabet, number = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", int.from_bytes(found.digest(), "big")
    return stated.upper() == "".join(alphabet[number >> 5 * k & 31] for k in range(31, -1, -1))


Found = tuple[int, int, str | None, dict[str, str] | None, bytes]


def records_at(content: bytes, at: int, inside: bool) -> tuple[Iterable[Found], int]:
    """The valid record at a place, or none of an empty member, or with ``inside`` all records and gaps of a member that holds a valid one; and the end."""
    if content[at : at + len(MEMBER)] != MEMBER:
        headers, block, end = _plain_at(content, at)
        return [(at, end, None, headers, block)], end
    inner, end = _member_at(content, at)
    if not inner:
        return [], end
    try:
        headers, block, stop = _plain_at(inner, 0)
        if stop != len(inner):
            raise Damaged("the member holds more than a record")
        return [(at, end, None, headers, block)], end
    except Damaged as why:
        walk = salvage(inner) if inside else iter(())
        # After a gap comes a record or the end.
        head = list(islice(walk, 2))
        if all(problem for _, _, problem, _, _ in head):
            raise Damaged(str(why)) from None
    return ((at, end, problem and f"{problem}, in bytes {a} to {b} of the member unpacked", *rest) for a, b, problem, *rest in chain(head, walk)), end


def salvage(content: bytes, inside: bool = False) -> Iterator[Found]:
    """(start, end, None, headers, block) of each valid record and (start, end, reason, None, b"") of each gap.

    A member of more than a record is a gap, or with ``inside`` the records and gaps in it, all with the member's start and end.
    """
    at, gap, reason = 0, None, None
    marks = {MEMBER: 0, VERSION: 0}
    while at < len(content):
        try:
            found, end = records_at(content, at, inside)
        except Damaged as why:
            if gap is None:
                gap, reason = at, str(why)
            for mark, least in ((MEMBER, at + 1), (VERSION, max(at + 1, why.beyond))):
                if 0 <= marks[mark] < least:
                    marks[mark] = content.find(mark, least)
            at = min((p for p in marks.values() if p >= 0), default=len(content))
            continue
        if gap is not None:
            yield gap, at, reason, None, b""
            gap = None
        yield from found
        at = end
    if gap is not None:
        yield gap, len(content), reason, None, b""


_SCHEMA = "file string, at long, size long, problem string, record_type string, record_id string, url string, refers_to string, stated_bytes long, stated_digest string, payload binary"
_KIND = pa.schema(
    [(n.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[n.split()[1]]) for n in _SCHEMA.split(", ")]
)


def _row(file: str, start: int, end: int, problem: str | None, headers: dict[str, str] | None, block: bytes) -> list:
    if headers is None:
        return [file, start, end - start, problem, *[None] * 7]
    if headers.get("content-type", "").startswith("application/http"):
        _, _, block = block.partition(END)
    length = headers.get("x-payload-length", "")
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    kind = headers.get("warc-type")
    return [file, start, end - start, None, kind, headers.get("warc-record-id"), headers.get("warc-target-uri"), headers.get("warc-refers-to"), int(length) if length.isdigit() else None, digest, None if kind == "revisit" else block]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row per valid record and per gap of the archives in a folder.

    Gaps have ``problem`` and only file, at (byte), and size besides. A record has its type,
    ids, url, the payload length and digest that it states, and its payload (null for a
    revisit). Those in a gzip member of several records have the member's place and size, and
    ``problem`` says which of its unpacked bytes a gap is. A file is read by one task as a
    whole, so files, and members when unpacked, should be under about 1 GB.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                for found in salvage(content.as_py(), inside=True):
                    rows.append(_row(name, *found))
                    size += len(found[4]) + 200
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KIND.types)], schema=_KIND)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KIND.types)], schema=_KIND)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, _SCHEMA)


def page_records(found: DataFrame) -> DataFrame:
    """Per record of ``read_warc`` that ``write_warc`` wrote: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Length and digest of a response are those of the payload read back; a revisit states them.
    """
    number = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(-?[0-9]*)>$", 1), F.lit("")).cast("long")
    whole = F.col("record_type") == "response"
    return found.where("problem is null").select(
        number(F.col("record_id")).alias("page_id"),
        F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(F.col("stated_digest")).alias("payload_digest"),
        "record_type",
        number(F.col("refers_to")).alias("refers_to"),
    )


def gaps(found: DataFrame) -> DataFrame:
    """The log of quarantined bytes of ``read_warc``: file, at, size, problem."""
    return found.where("problem is not null").select("file", "at", "size", "problem")

"""Token ids in files of compressed bit or byte planes (op7).

A file is a row of blobs, each with a line end behind it:

    chunk   the ids of some whole documents, cut into blocks of ``BLOCK`` ids. Each block is
            transposed into planes (all lowest bytes, then the next bytes, ...; or single
            bits), every plane is compressed by itself with zstandard, and a plane of zeros
            is stored as nothing.
    index   JSON, compressed: for each chunk its place, and per document its key and number
            of ids; for each block the compressed sizes of its planes.
    tail    the index's place and size as text, the last bytes of the file.

Spark's text sink writes the blobs, so files go through its committer to any file system it
knows. A file holds a range of keys; files are numbered in key order.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tunesmith.llm.common import quoted
from tunesmith.sources.scratch import stored

# Ids in a block and, about, in a chunk; bytes of text, about, that go to one file.
BLOCK, CHUNK, FILE_BYTES = 1 << 16, 1 << 20, 32 << 20
MAGIC, TAIL = "planes1", 48


def planes_of(ids: np.ndarray, unit: str) -> list[bytes]:
    """Planes of 32-bit ids: 4 byte planes or 32 bit planes, lowest first; all-zero ones empty."""
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if unit == "bit":
        bits = np.unpackbits(rows, axis=1, bitorder="little")
        planes = np.packbits(bits.T, axis=1, bitorder="little")
    else:
        planes = np.ascontiguousarray(rows.T)
    return [p.tobytes() if p.any() else b"" for p in planes]


def ids_of(planes: list[bytes], n: int, unit: str) -> np.ndarray:
    if unit == "bit":
        whole = np.zeros((32, (n + 7) // 8), np.uint8)
        for row, plane in zip(whole, planes):
            if plane:
                row[:] = np.frombuffer(plane, np.uint8)
        bits = np.unpackbits(whole, axis=1, count=n, bitorder="little")
        rows = np.packbits(bits.T, axis=1, bitorder="little")
    else:
        rows = np.zeros((n, 4), np.uint8)
        for k, plane in enumerate(planes):
            if plane:
                rows[:, k] = np.frombuffer(plane, np.uint8)
    return np.ascontiguousarray(rows).view("<u4").reshape(-1)


class Writer:
    """Blobs of one file; ``add`` and ``close`` give those that are ready."""

    def __init__(self, part: int, unit: str, level: int):
        self.unit, self.pack = unit, zstandard.ZstdCompressor(level=level).compress
        self.index = {"part": part, "unit": unit, "block": BLOCK, "chunks": []}
        self.at, self.keys, self.counts, self.ids, self.size = 0, [], [], [], 0

    def add(self, key, ids: bytes) -> Iterator[bytes]:
        self.keys.append(key)
        self.counts.append(len(ids) // 4)
        self.ids.append(ids)
        self.size += len(ids) // 4
        if self.size >= CHUNK:
            yield self._chunk()

    def _chunk(self) -> bytes:
        ids, planes, sizes = np.frombuffer(b"".join(self.ids), "<u4"), [], []
        for start in range(0, len(ids), BLOCK):
            packed = [self.pack(p) if p else b"" for p in planes_of(ids[start : start + BLOCK], self.unit)]
            planes += packed
            sizes.append([len(p) for p in packed])
        blob = b"".join(planes)
        self.index["chunks"].append({"at": self.at, "n": len(ids), "planes": sizes, "keys": self.keys, "counts": self.counts})
        self.at += len(blob) + 1
        self.keys, self.counts, self.ids, self.size = [], [], [], 0
        return blob

    def close(self) -> Iterator[bytes]:
        if self.keys:
            yield self._chunk()
        if self.index["chunks"]:
            blob = self.pack(json.dumps(self.index).encode())
            yield blob
            yield f"{MAGIC} {self.at} {len(blob)}".ljust(TAIL - 1).encode()


def read_file(content: bytes) -> Iterator[tuple[int, list, list, np.ndarray]]:
    """Of each chunk of a file: the file's part, keys, counts, ids."""
    magic, at, size = content[-TAIL:].split()
    if magic != MAGIC.encode():
        raise ValueError("not a file of planes")
    unpack = zstandard.ZstdDecompressor().decompress
    index = json.loads(unpack(content[int(at) : int(at) + int(size)]))
    for chunk in index["chunks"]:
        blocks, place, left = [], chunk["at"], chunk["n"]
        for sizes in chunk["planes"]:
            planes = []
            for size in sizes:
                planes.append(unpack(content[place : place + size]) if size else b"")
                place += size
            blocks.append(ids_of(planes, min(left, index["block"]), index["unit"]))
            left -= index["block"]
        yield index["part"], chunk["keys"], chunk["counts"], np.concatenate(blocks) if blocks else np.zeros(0, "<u4")


def write_planes(df: DataFrame, path: str, encode: Callable[[], Callable[[str], bytes]], end: int, text: str = "text", key: str = "doc_id", unit: str = "byte", level: int = 3) -> None:
    """Write the ids of every whole text, and ``end`` after each, in ascending order of ``key``.

    ``encode`` gives, inside a task, the function from a text to its ids. Null texts are
    empty; null keys come first; rows of one key follow in the order of a hash of their
    texts, and rows that repeat are written each. No row, no file.
    """
    docs = df.select(quoted(key).cast("long").alias("key"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    dealt = docs.repartitionByRange(max(1, -(-total // FILE_BYTES)), *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, last = encode(), np.array([end], "<u4").tobytes()
        writer = Writer(TaskContext.get().partitionId(), unit, level)
        for batch in batches:
            for k, t in zip(batch.column("key").to_pylist(), batch.column("text")):
                for blob in writer.add(k, of(t.as_py()) + last):
                    yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["blob"])
        for blob in writer.close():
            yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["blob"])

    blobs = dealt.mapInArrow(write, "blob binary")
    blobs.select(F.col("blob").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def read_planes(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the files in a folder: part (the file's number), before (ids before it there), doc_id, ids.

    ``ids`` is binary, little-endian unsigned 32-bit integers, the end id included.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                whole = content.as_py()
                before = 0
                for part, keys, counts, ids in read_file(whole) if whole else ():
                    ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                    raw = pa.BinaryArray.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer((ends * 4).astype("<i4")), pa.py_buffer(ids)])
                    parts = pa.array([part] * len(keys), pa.int32())
                    yield pa.RecordBatch.from_arrays([parts, pa.array(before + ends[:-1]), pa.array(keys, pa.int64()), raw], ["part", "before", "doc_id", "ids"])
                    before += int(ends[-1])

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(read, "part int, before long, doc_id long, ids binary")


def document_starts(docs: DataFrame) -> DataFrame:
    """Per document of ``read_planes``: doc_id, start (ids before it in all files), n_tokens, ids_crc32.

    One task sees a row per file, which holds about 32 MB of text; the documents meet those
    in a join.
    """
    found = stored(docs.select("part", "before", "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")), "planes")
    files = found.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select("part", F.coalesce(earlier, F.lit(0)).alias("first"))
    return found.join(files, "part").select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")

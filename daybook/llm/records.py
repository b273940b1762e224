"""Token ids as length-delimited binary records with an offset index.

A shard ``part-NNNNN.rec`` is a run of records in ascending id order:

    length   unsigned 64-bit   bytes of the payload
    check    unsigned 32-bit   masked CRC-32 of the length's eight bytes
    payload
    check    unsigned 32-bit   masked CRC-32 of the payload

all little-endian. The mask is the usual one for checksums stored beside their
data: rotate right by 15 bits, add 0xA282EAD8. The payload is one byte of flags
(1: ids take four bytes, else two; 2: there is no document id), the document id
as a signed 64-bit number, and the ids. ``part-NNNNN.idx`` holds the offset of
each record and the file's length as unsigned 64-bit numbers, so records can be
read in any order. Shards follow each other in id order.

Files are written under another name and renamed, so a task that runs again
after a lost executor leaves one whole file.

Defined cases: null and empty texts are the end id alone; a null id comes first;
rows that share an id follow each other by their texts' checksums; repeated rows
are records of their own; an empty table gives no records; other input columns
are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import slices, utf8
from .tokens import encoder

_MASK = 0xA282EAD8
_WIDE, _NO_ID = 1, 2
SLICE = 4 << 20


def masked(crc: int) -> int:
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(zlib.crc32(size))), payload, struct.pack("<I", masked(zlib.crc32(payload)))))


def unframe(raw: bytes) -> bytes:
    """Payload of one framed record; a wrong checksum or length is an error."""
    size = raw[:8]
    payload = raw[12:-4]
    if struct.unpack("<I", raw[8:12])[0] != masked(zlib.crc32(size)) or struct.unpack("<Q", size)[0] != len(payload):
        raise ValueError("record length is damaged")
    if struct.unpack("<I", raw[-4:])[0] != masked(zlib.crc32(payload)):
        raise ValueError("record payload is damaged")
    return payload


def pack_ids(doc_id: int | None, ids: bytes) -> bytes:
    """Payload of a document; ``ids`` are unsigned 32-bit and take two bytes each if all fit."""
    wide = np.frombuffer(ids, "<u4")
    small = not len(wide) or int(wide.max()) < 1 << 16
    flags = (0 if small else _WIDE) | (_NO_ID if doc_id is None else 0)
    return struct.pack("<Bq", flags, doc_id or 0) + (wide.astype("<u2").tobytes() if small else ids)


def unpack_ids(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc_id = struct.unpack("<Bq", payload[:9])
    ids = np.frombuffer(payload[9:], "<u4" if flags & _WIDE else "<u2").astype("<u4")
    return (None if flags & _NO_ID else doc_id), ids


def _store(path: str):
    """The filesystem of a path, and the path in it."""
    from pyarrow import fs

    path = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write_records(
    docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, drops_space: bool = True
) -> DataFrame:
    """Write every row's ids to shards under ``path``; returns the written manifest (shard, file, records, tokens)."""
    spark = docs.sparkSession

    def run(batches):
        store, root = _store(path)
        shard, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        name = f"part-{shard:05d}"
        known, end = encoder(vocabulary, drops_space), np.array([end_id], "<u4").tobytes()
        offset = records = tokens = 0
        store.create_dir(root, recursive=True)
        temp = f"{root}/_{name}-{attempt}"
        with store.open_output_stream(f"{temp}.rec") as data, store.open_output_stream(f"{temp}.idx") as index:
            for batch in batches:
                doc_ids = batch.column(0).to_pylist()
                buf, offs = utf8(batch.column(1))
                for lo, hi in slices(offs, SLICE):
                    raw = buf[offs[lo] : offs[hi]].tobytes()
                    ends = (offs[lo : hi + 1] - offs[lo]).tolist()
                    starts, framed = [], []
                    for k, ids in enumerate(known.ids([raw[a:b] for a, b in zip(ends[:-1], ends[1:])])):
                        ids += end
                        framed.append(frame(pack_ids(doc_ids[lo + k], ids)))
                        starts.append(offset)
                        offset += len(framed[-1])
                        tokens += len(ids) // 4
                    records += len(framed)
                    data.write(b"".join(framed))
                    index.write(np.array(starts, "<u8").tobytes())
            index.write(np.array([offset], "<u8").tobytes())
        if records:
            for kind in ("rec", "idx"):
                store.move(f"{temp}.{kind}", f"{root}/{name}.{kind}")
            yield pa.RecordBatch.from_pydict({"shard": [shard], "file": [f"{path}/{name}"], "records": [records], "tokens": [tokens]}, schema=schema)
        else:
            for kind in ("rec", "idx"):
                store.delete_file(f"{temp}.{kind}")

    schema = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("records", pa.int64()), ("tokens", pa.int64())])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("tie", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    manifest = ordered.mapInArrow(run, "shard int, file string, records long, tokens long")
    manifest.write.parquet(f"{path}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{path}/manifest")


def read_range(file: str, first: int, last: int, block: int = 256) -> Iterator[bytes]:
    """Payloads of the records first..last-1 of a shard, found through its index, a block at a time."""
    store, name = _store(file)
    with store.open_input_file(f"{name}.idx") as index, store.open_input_file(f"{name}.rec") as data:
        for lo in range(first, last, block):
            hi = min(last, lo + block)
            offsets = np.frombuffer(index.read_at((hi - lo + 1) * 8, lo * 8), "<u8").astype(np.int64).tolist()
            raw = data.read_at(offsets[-1] - offsets[0], offsets[0])
            for a, b in zip(offsets[:-1], offsets[1:]):
                yield unframe(raw[a - offsets[0] : b - offsets[0]])


def read_records(manifest: DataFrame, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """One row per record: id_col, start, n_tokens, ids_crc32 and, if asked, ids (array).

    ``start`` counts the ids of all records before it. A task reads whole shards,
    which are as large as the writer's partitions, a block of records at a time.
    """

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                out = []
                start = r["start"]
                for payload in read_range(r["file"], 0, r["records"]):
                    doc_id, ids = unpack_ids(payload)
                    out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), ids))
                    start += len(ids)
                    if len(out) == 256:
                        yield rows(out)
                        out = []
                if out:
                    yield rows(out)

    def rows(out):
        cols = [pa.array([r[k] for r in out], pa.int64()) for k in range(4)]
        if with_ids:
            cols.append(pa.array([r[4].astype(np.int64) for r in out], pa.list_(pa.int64())))
        return pa.RecordBatch.from_arrays(cols, names=["id", "start", "n_tokens", "ids_crc32", "ids"][: len(cols)])

    # one row per shard: as many as the writer had partitions
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = "id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return based.select("file", "start", "records").repartition(n, "file").mapInArrow(run, kind).withColumnRenamed("id", id_col)


def round_trip(spark: SparkSession, docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Write ``docs`` to a new folder in the shared one and read the records back, without the ids."""
    return read_records(write_records(docs, scratch_path(spark, "records"), vocabulary, **options), with_ids=False)

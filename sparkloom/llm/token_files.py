"""Token-ID / binary output: patched frame-of-reference blocks.

A file holds the ids of a run of whole documents, in this order, all numbers
little-endian:

    magic "TIDS", version u16, block size u16, documents u32, blocks u32, ids u64
    has_id u8 and doc_id i64 for each document, end u64 for each document (ids up to and with it)
    start u32 for each block: where in the body it begins (the index), one more for the end
    body, for each block: minimum u32, width u8, exceptions u8,
        4 * width words of u32 (values less the minimum, in four interleaved lanes),
        position u8 and value u32 for each exception

The width of a block is the number of bits of the 90th percentile of its values
less the minimum. What needs more bits is stored as zero among the packed words
and in full in the exception list. A last block is filled up with its minimum.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, written
from .encoding import balanced, default_vocabulary, encoder

MAGIC, VERSION, BLOCK, RANK = b"TIDS", 1, 128, 115
_HEAD = struct.Struct("<4sHHIIQ")
_LANES, _SLOTS = 4, 32


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 128 values of at most ``width`` bits, as rows of 4 * width words."""
    lanes = values.reshape(-1, _SLOTS, _LANES)
    out = np.zeros((len(lanes), width, _LANES), np.uint32)
    for slot in range(_SLOTS):
        word, at = divmod(slot * width, 32)
        out[:, word] |= lanes[:, slot] << np.uint32(at)
        if at + width > 32:
            out[:, word + 1] |= lanes[:, slot] >> np.uint32(32 - at)
    return out.reshape(len(lanes), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    lanes = words.reshape(-1, width, _LANES)
    out = np.empty((len(lanes), _SLOTS, _LANES), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for slot in range(_SLOTS):
        word, at = divmod(slot * width, 32)
        v = lanes[:, word] >> np.uint32(at)
        if at + width > 32:
            v = v | (lanes[:, word + 1] << np.uint32(32 - at))
        out[:, slot] = v & mask
    return out.reshape(len(lanes), BLOCK)


def packed(ids: np.ndarray, ends: np.ndarray, doc_ids: list) -> bytes:
    """One file: the ids of documents whose last ids are at ``ends``."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    values = np.empty(blocks * BLOCK, np.uint32)
    values[:n] = ids
    if n < len(values):
        values[n:] = ids[(blocks - 1) * BLOCK :].min()
    values = values.reshape(blocks, BLOCK)
    low = values.min(axis=1) if blocks else np.empty(0, np.uint32)
    values = values - low[:, None]
    typical = np.partition(values, RANK, axis=1)[:, RANK] if blocks else np.empty(0, np.uint32)
    widths = np.frexp(typical.astype(np.float64))[1].astype(np.int64)
    beyond = values.astype(np.uint64) >> widths.astype(np.uint64)[:, None] > 0
    counts = beyond.sum(axis=1)
    sizes = 6 + 16 * widths + 5 * counts
    starts = np.concatenate([[0], np.cumsum(sizes)])
    row, position = np.nonzero(beyond)
    outlier = values[beyond]
    values[beyond] = 0
    body = np.zeros(int(starts[-1]), np.uint8)

    def put(at: np.ndarray, what: np.ndarray) -> None:
        """Rows of bytes at the given places of the body."""
        if what.size:
            body[at[:, None] + np.arange(what.shape[1])] = what

    heads = np.zeros((blocks, 6), np.uint8)
    heads[:, :4] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    heads[:, 4], heads[:, 5] = widths, counts
    put(starts[:-1], heads)
    for w in np.unique(widths):
        if w:
            at = np.flatnonzero(widths == w)
            put(starts[at] + 6, np.ascontiguousarray(_pack(values[at], int(w)).astype("<u4")).view(np.uint8).reshape(len(at), -1))
    if len(row):
        nth = np.arange(len(row)) - (np.cumsum(counts) - counts)[row]
        at = starts[row] + 6 + 16 * widths[row]
        put(at + nth, position.astype(np.uint8)[:, None])
        put(at + counts[row] + 4 * nth, outlier.astype("<u4").view(np.uint8).reshape(-1, 4))
    return b"".join(
        [
            _HEAD.pack(MAGIC, VERSION, BLOCK, len(doc_ids), blocks, n),
            bytes(d is not None for d in doc_ids),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.asarray(ends, "<u8").tobytes(),
            starts.astype("<u4").tobytes(),
            body.tobytes(),
        ]
    )


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, list]:
    """(ids, ends, doc ids) of a file that :func:`packed` made."""
    magic, version, block, docs, blocks, n = _HEAD.unpack_from(data)
    if (magic, version, block) != (MAGIC, VERSION, BLOCK):
        raise ValueError("not a token file of this version")
    at = _HEAD.size
    known = data[at : at + docs]
    at += docs
    doc_ids = [int(d) if k else None for k, d in zip(known, np.frombuffer(data, "<i8", docs, at))]
    at += 8 * docs
    ends = np.frombuffer(data, "<u8", docs, at).astype(np.int64)
    at += 8 * docs
    starts = np.frombuffer(data, "<u4", blocks + 1, at).astype(np.int64)
    at += 4 * (blocks + 1)
    body = np.frombuffer(data, np.uint8, int(starts[-1]), at)

    def get(places: np.ndarray, width: int) -> np.ndarray:
        return body[places[:, None] + np.arange(width)]

    heads = get(starts[:-1], 6)
    low = np.ascontiguousarray(heads[:, :4]).view("<u4").reshape(-1)
    widths, counts = heads[:, 4].astype(np.int64), heads[:, 5].astype(np.int64)
    values = np.zeros((blocks, BLOCK), np.uint32)
    for w in np.unique(widths):
        if w:
            rows = np.flatnonzero(widths == w)
            values[rows] = _unpack(np.ascontiguousarray(get(starts[rows] + 6, 16 * int(w))).view("<u4"), int(w))
    if counts.sum():
        row = np.repeat(np.arange(blocks), counts)
        nth = np.arange(len(row)) - (np.cumsum(counts) - counts)[row]
        place = starts[row] + 6 + 16 * widths[row]
        values[row, body[place + nth]] = np.ascontiguousarray(get(place + counts[row] + 4 * nth, 4)).view("<u4").reshape(-1)
    return (values + low[:, None]).reshape(-1)[:n], ends, doc_ids


def write_token_files(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0, ids_per_file: int = 1 << 18, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and write it in ascending id order.

    The texts are dealt by ranges of the id and sorted within each range; each
    task encodes its texts with the ``tokenizers`` library, appends ``end_id``
    to each document and cuts its ids into files of whole documents, of about
    ``ids_per_file`` ids. A task holds one batch of texts and one file at a
    time. Returns the written table ``shard, part, n_ids, file``: the files in
    order of (shard, part). Spark's commit keeps one copy of each file when a
    task runs again.

    Null or empty text: the end id alone. Null ids come first; repeated rows
    stay, ties of id in the order of the text. Empty table: no files.
    """
    path = vocabulary or default_vocabulary()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        encode = encoder(path).encoded
        shard, part = TaskContext.get().partitionId(), 0
        held, lengths, names, total = [], [], [], 0

        def file():
            data = packed(np.concatenate(held), np.cumsum(np.concatenate(lengths)), names)
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([part], pa.int32()), pa.array([total], pa.int64()), pa.array([data], pa.binary())], names=["shard", "part", "n_ids", "file"])

        for batch in batches:
            size = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in balanced(size, 16_000_000):
                ids, n = encode(batch.column(1).slice(a, b - a))
                ends = np.cumsum(n)
                ids = np.insert(ids, ends, np.uint32(end_id))
                n = n + 1
                ends = np.cumsum(n)
                who = batch.column(0).slice(a, b - a).to_pylist()
                at = 0
                while at < len(n):
                    base = int(ends[at] - n[at])
                    to = min(len(n), at + 1 + int(np.searchsorted(ends[at:], base + max(1, ids_per_file - total))))
                    held.append(ids[base : int(ends[to - 1])])
                    lengths.append(n[at:to])
                    names += who[at:to]
                    total += int(ends[to - 1]) - base
                    at = to
                    if total >= ids_per_file:
                        yield file()
                        held, lengths, names, total, part = [], [], [], 0, part + 1
        if names:
            yield file()

    made = ordered.mapInArrow(write, "shard int, part int, n_ids long, file binary")
    return written(made, "token-files", "none")


def read_token_files(files: DataFrame) -> DataFrame:
    """One row for each document of written files, in their order.

    Returns ``doc_id, start, n_tokens, ids_crc32``: ``start`` counts the ids of
    all documents before it. The base of a file is a sum over files of its own
    shard plus a sum over shards; only those two small tables are sorted.
    """

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for shard, part, data in zip(*(c.to_pylist() for c in batch.columns)):
                ids, ends, who = unpacked(data)
                raw = memoryview(ids.astype("<u4").tobytes())
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(who)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(who, pa.int64()), pa.array(starts), pa.array(ends - starts), pa.array(sums, pa.int64())],
                    names=["shard", "part", "doc_id", "offset", "n_tokens", "ids_crc32"],
                )

    found = files.select("shard", "part", "file").mapInArrow(read, "shard int, part int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    sizes = files.select("shard", "part", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = shards.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("shard_base"))
    base = sizes.withColumn("within", F.sum("n_ids").over(Window.partitionBy("shard").orderBy("part")) - F.col("n_ids")).join(before, "shard")
    bases = base.select("shard", "part", (F.col("within") + F.col("shard_base")).alias("base"))
    return found.join(bases, ["shard", "part"]).select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """Write the documents as token files, read the files back and describe each document."""
    return read_token_files(write_token_files(docs, vocabulary, end_id))

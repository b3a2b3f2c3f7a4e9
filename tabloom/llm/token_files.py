"""Token ids of a corpus in patched frame-of-reference files.

Documents are ranged by doc_id; each range becomes files of bounded size. A file is

    magic 8 bytes, then little-endian 64-bit: documents, ids, blocks, ids in a block
    doc_id int64[documents], present uint8[documents] (0: the doc_id is null)
    ids of each document uint32[documents]
    start of each block uint64[blocks], in bytes after this index
    blocks

A block holds up to ``BLOCK`` ids: minimum uint32, ids uint32, exceptions uint32, width
uint8, then ``width`` bit planes of (id - minimum), then the positions (uint16) and high
bits (uint32) of the exceptions. The width is that of a percentile of the block's values
above its minimum; only values beyond it are exceptions. The index of block starts lets a
reader decode any block alone.

The manifest names the files of the tasks that succeeded, so what a lost or repeated task
left behind is never read.
"""

from __future__ import annotations

import os
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tabloom.llm.common import parallelism, stored
from tabloom.llm.tokens import coder
from tabloom.session import work_dir

MAGIC = b"PFORIDS1"
BLOCK = 1 << 14
PERCENTILE = 90
FILE_IDS = 2_000_000
END_ID = 0
_BLOCK_HEAD = np.dtype([("low", "<u4"), ("ids", "<u4"), ("exceptions", "<u4"), ("width", "u1")])


def pack_block(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    low = int(ids.min())
    above = ids - np.uint32(low)
    at = (len(above) - 1) * percentile // 100
    width = int(np.partition(above, at)[at]).bit_length()
    planes = [np.packbits((above & np.uint32(1 << b)) != 0).tobytes() for b in range(width)]
    high = above >> np.uint32(width) if width < 32 else np.zeros_like(above)
    odd = np.flatnonzero(high)
    head = np.array((low, len(ids), len(odd), width), _BLOCK_HEAD).tobytes()
    return b"".join([head, *planes, odd.astype("<u2").tobytes(), high[odd].astype("<u4").tobytes()])


def unpack_block(data: bytes | memoryview, at: int = 0) -> np.ndarray:
    head = np.frombuffer(data, _BLOCK_HEAD, 1, at)[0]
    low, count, odd, width = (int(head[name]) for name in ("low", "ids", "exceptions", "width"))
    at += _BLOCK_HEAD.itemsize
    size = -(-count // 8)
    planes = np.unpackbits(np.frombuffer(data, np.uint8, width * size, at).reshape(width, size), axis=1, count=count)
    kind = np.uint16 if width <= 16 else np.uint32
    out = np.zeros(count, kind)
    for b in range(width):
        out |= planes[b].astype(kind) << kind(b)
    out = out.astype(np.uint32)
    at += width * size
    position = np.frombuffer(data, "<u2", odd, at)
    high = np.frombuffer(data, "<u4", odd, at + 2 * odd)
    out[position] |= (high.astype(np.uint64) << np.uint64(width)).astype(np.uint32)
    return out + np.uint32(low)


def pack_file(doc_ids: list[int | None], coded: list[bytes], block: int = BLOCK, percentile: int = PERCENTILE) -> bytes:
    """``coded``: each document's ids as little-endian 32-bit integers."""
    if not 0 < block <= 1 << 16:
        raise ValueError("positions in a block take 16 bits")
    ids = np.frombuffer(b"".join(coded), "<u4")
    blocks = [pack_block(ids[i : i + block], percentile) for i in range(0, len(ids), block)]
    starts = np.cumsum([0, *map(len, blocks)])[:-1]
    return b"".join([
        MAGIC,
        np.array([len(coded), len(ids), len(blocks), block], "<u8").tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is not None for d in doc_ids], "u1").tobytes(),
        np.array([len(c) // 4 for c in coded], "<u4").tobytes(),
        starts.astype("<u8").tobytes(),
        *blocks,
    ])


def read_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, ids of each document, all ids."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    docs, total, blocks, _ = (int(x) for x in np.frombuffer(data, "<u8", 4, 8))
    at = 40
    doc_ids = np.frombuffer(data, "<i8", docs, at)
    present = np.frombuffer(data, "u1", docs, at + 8 * docs)
    lengths = np.frombuffer(data, "<u4", docs, at + 9 * docs)
    starts = np.frombuffer(data, "<u8", blocks, at + 13 * docs)
    base = at + 13 * docs + 8 * blocks
    ids = np.concatenate([unpack_block(data, base + int(s)) for s in starts] or [np.empty(0, np.uint32)])
    if len(ids) != total:
        raise ValueError(f"{len(ids)} ids, the head says {total}")
    return [int(d) if p else None for d, p in zip(doc_ids, present)], lengths, ids


def _write(folder: str, name: str, data: bytes) -> None:
    store, path = fs.FileSystem.from_uri(folder)
    with store.open_output_stream(posixpath.join(path, name)) as out:
        out.write(data)


def write_token_files(
    documents: DataFrame,
    folder: str,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write the files and return the manifest: file, part, number, documents, ids.

    Documents are in ascending doc_id order over (part, number), nulls first, rows with
    equal doc_id by a hash of the text. Null text is empty. A file ends with the document that takes it
    past ``file_ids`` ids.
    """
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    parts = 2 * parallelism(documents.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, coded, end = task.partitionId(), coder(tokenizer), end_id.to_bytes(4, "little")
        files: list[tuple] = []
        doc_ids: list[int | None] = []
        ids: list[bytes] = []
        held = 0

        def flush() -> None:
            nonlocal held
            name = f"part-{part:06d}-{len(files):06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.ids"
            _write(folder, name, pack_file(doc_ids, ids))
            files.append((name, part, len(files), len(ids), held))
            doc_ids.clear(), ids.clear()
            held = 0

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                one = coded.encode(text.as_py() or "") + end
                doc_ids.append(doc_id)
                ids.append(one)
                held += len(one) // 4
                if held >= file_ids:
                    flush()
        if ids:
            flush()
        columns = list(zip(*files)) or [[]] * 5
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "part", "number", "documents", "ids"])

    # Ranges are drawn from ids and hashes, so no text reaches the driver, and rows of one id still spread.
    key = [F.col("doc_id").asc_nulls_first(), F.col("mark").asc()]
    ranged = documents.select("doc_id", "text", F.xxhash64("text").alias("mark")).repartitionByRange(parts, *key)
    ordered = ranged.sortWithinPartitions(*key)
    return stored(ordered.mapInArrow(write, "file string, part int, number int, documents long, ids long"), "token-manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files' bytes."""
    spark = manifest.sparkSession
    parts = manifest.groupBy("part").agg(F.sum("ids").alias("part_ids"))  # one row for each range
    part_start = parts.select("part", (F.sum("part_ids").over(Window.orderBy("part")) - F.col("part_ids")).alias("part_start"))
    in_part = Window.partitionBy("part").orderBy("number")
    starts = manifest.join(part_start, "part").select(
        "file", (F.col("part_start") + F.sum("ids").over(in_part) - F.col("ids")).alias("file_start")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                doc_ids, lengths, ids = read_file(content.as_py())
                ends = np.cumsum(lengths, dtype=np.int64)
                raw = memoryview(ids.astype("<u4").tobytes())
                begins = ends - lengths
                sums = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begins.tolist(), ends.tolist())]
                columns = [
                    pa.array([os.path.basename(path.as_py())] * len(doc_ids), pa.string()),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(begins, pa.int64()),
                    pa.array(lengths.astype(np.int64)),
                    pa.array(sums, pa.int64()),
                ]
                yield pa.record_batch(columns, names=["file", "doc_id", "inside", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder).select("path", "content")
    decoded = files.mapInArrow(read, "file string, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return decoded.join(starts, "file").select(
        "doc_id", (F.col("file_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def encode_and_read_back(documents: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write ``documents`` as token files in a fresh shared folder, then read them.

    An empty table writes no file and gives no rows.
    """
    folder = work_dir(documents.sparkSession, "token-files")
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path)
    return read_token_files(write_token_files(documents, folder, tokenizer, end_id), folder)

"""Token ids in files of bit- or byte-plane blocks.

`write_tokens` encodes texts and writes their ids, in ascending order of id, as blocks of
BLOCK_IDS ids. A block's ids are transposed into planes (all first bytes, all second bytes, ... or all
first bits, ...), each plane is compressed with zstandard, and the planes stand behind a small header.
A table of blocks and a chunk index lie in the given folder:

    blocks/  part, block, first (ids before it in its part), n_ids, payload, and per piece of a
             document inside the block its row in the part, its id and its length
    index/   part, block, first_id (ids before it in the whole output), n_ids, n_bytes

Both are Parquet folders, since Spark's committer is what makes a write survive a lost executor on any
shared store; payloads are opaque bytes. Parts are ranges of ids, so the index can be searched.

Null texts are empty and give the end id only. Null ids come first. Equal ids are ordered by a hash of the text, and
repeated rows are written as often as they occur. An empty table gives an empty, readable output.
Other input columns are ignored.
"""

from __future__ import annotations

import struct
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rillrank.llm.encoding import crc32, crc32_joined, encoder
from rillrank.llm.tasks import map_batches, slices

BLOCK_IDS = 1 << 16
LEVEL = 3
MAGIC = b"TPL1"
_HEADER = struct.Struct("<4sBBxxI")  # magic, bits per plane, planes, ids

BLOCKS = ("part int, block int, first bigint, n_ids int, payload binary, piece_rows array<bigint>, "
          "piece_ids array<bigint>, piece_lengths array<int>")
PIECES = "part int, row bigint, id bigint, start bigint, length bigint, crc bigint"


def pack_block(ids: np.ndarray, bits: int = 8, level: int = LEVEL) -> bytes:
    """Header, length of each compressed plane, planes. Planes above the largest id are left out."""
    width = int(ids.max()).bit_length() if len(ids) else 0
    planes = -(-width // bits)
    if bits == 8:
        rows = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T[:planes])
    else:
        rows = np.packbits((ids[None, :] >> np.arange(planes, dtype=np.uint32)[:, None]).astype(np.uint8) & 1, axis=1)
    press = zstandard.ZstdCompressor(level=level)
    pressed = [press.compress(row.tobytes()) for row in rows]
    return b"".join([_HEADER.pack(MAGIC, bits, planes, len(ids)),
                     struct.pack(f"<{planes}I", *map(len, pressed)), *pressed])


def unpack_block(payload: bytes) -> np.ndarray:
    magic, bits, planes, n = _HEADER.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a block of token planes")
    lengths = struct.unpack_from(f"<{planes}I", payload, _HEADER.size)
    at, press, out = _HEADER.size + 4 * planes, zstandard.ZstdDecompressor(), np.zeros(n, np.uint32)
    for i, length in enumerate(lengths):
        row = np.frombuffer(press.decompress(payload[at:at + length]), np.uint8)
        plane = row if bits == 8 else np.unpackbits(row, count=n)
        out |= plane.astype(np.uint32) << np.uint32(bits * i)
        at += length
    return out


class _Blocks:
    """Cuts the documents of one part into blocks."""

    def __init__(self, size: int, bits: int) -> None:
        self.size, self.bits, self.part = size, bits, TaskContext.get().partitionId()
        self.row = self.block = self.first = 0
        self.begin()

    def begin(self) -> None:
        self.held, self.n, self.rows, self.ids, self.lengths = [], 0, [], [], []

    def close(self) -> dict:
        row = {"part": self.part, "block": self.block, "first": self.first, "n_ids": self.n,
               "payload": pack_block(np.concatenate(self.held), self.bits), "piece_rows": self.rows,
               "piece_ids": self.ids, "piece_lengths": self.lengths}
        self.block, self.first = self.block + 1, self.first + self.n
        self.begin()
        return row

    def add(self, doc: int | None, ids: np.ndarray) -> Iterator[dict]:
        while len(ids):
            piece, ids = ids[:self.size - self.n], ids[self.size - self.n:]
            self.held.append(piece)
            self.rows.append(self.row)
            self.ids.append(doc)
            self.lengths.append(len(piece))
            self.n += len(piece)
            if self.n == self.size:
                yield self.close()
        self.row += 1


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_column: str = "doc_id",
                 text: str = "text", block_ids: int = BLOCK_IDS, plane_bits: int = 8) -> None:
    """Writes blocks/ and index/ under `path`. `tokenizer` is a file that every executor has."""
    if plane_bits not in (1, 8):
        raise ValueError("planes hold bits (1) or bytes (8)")
    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    # Equal ids are told apart by a hash, so that a run of them can be cut into several ranges.
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    schema = _block_schema()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks(block_ids, plane_bits)
        waiting: deque[int | None] = deque()

        def texts() -> Iterator[str | None]:
            for batch in slices(batches):
                for doc, value in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                    waiting.append(doc)
                    yield value.as_py()

        # The encoder groups texts by their size, over batches.
        for ids in encoder(tokenizer, end_id).encode(texts()):
            for row in blocks.add(waiting.popleft(), ids):
                yield pa.RecordBatch.from_pylist([row], schema=schema)
        if blocks.n:
            yield pa.RecordBatch.from_pylist([blocks.close()], schema=schema)

    map_batches(ordered, encode, BLOCKS).write.parquet(f"{path}/blocks")
    spark = docs.sparkSession
    blocks = spark.read.parquet(f"{path}/blocks")
    (blocks.join(F.broadcast(_offsets(blocks)), "part")
     .select("part", "block", (F.col("offset") + F.col("first")).alias("first_id"), "n_ids",
             F.octet_length("payload").alias("n_bytes")).write.parquet(f"{path}/index"))


def _block_schema() -> pa.Schema:
    lists = pa.list_(pa.int64())
    return pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()),
                      ("payload", pa.binary()), ("piece_rows", lists), ("piece_ids", lists),
                      ("piece_lengths", pa.list_(pa.int32()))])


def _offsets(blocks: DataFrame) -> DataFrame:
    """Ids before each part: one row per task of the write, so small enough for one task and a broadcast."""
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))


def read_range(spark: SparkSession, path: str, first: int, last: int) -> np.ndarray:
    """Ids first..last-1 of the whole output; reads only the blocks that the index names."""
    inside = (F.col("first_id") < last) & (F.col("first_id") + F.col("n_ids") > first)
    named = spark.read.parquet(f"{path}/index").where(inside)
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "block", "payload")
    got = blocks.join(F.broadcast(named), ["part", "block"]).orderBy("first_id").select("first_id", "payload").collect()
    if not got:
        return np.empty(0, np.uint32)
    ids = np.concatenate([unpack_block(bytes(x.payload)) for x in got])
    return ids[max(0, first - got[0].first_id):last - got[0].first_id]


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """id, start, n_tokens and ids_crc32 of each document, from the files alone.

    Blocks are read independently. A document that spans blocks has one short row per block; their
    checksums are joined in order.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    placed = blocks.join(F.broadcast(_offsets(blocks)), "part").withColumn("first", F.col("first") + F.col("offset"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8):
            for x in batch.to_pylist():
                ids, ends = unpack_block(x["payload"]), np.cumsum(x["piece_lengths"])
                begins = ends - x["piece_lengths"]
                yield pa.RecordBatch.from_arrays([
                    pa.array([x["part"]] * len(ends), pa.int32()), pa.array(x["piece_rows"], pa.int64()),
                    pa.array(x["piece_ids"], pa.int64()), pa.array(begins + x["first"], pa.int64()),
                    pa.array(ends - begins, pa.int64()),
                    pa.array([crc32(ids[a:b]) for a, b in zip(begins, ends, strict=True)], pa.int64()),
                ], names=["part", "row", "id", "start", "length", "crc"])

    pieces = map_batches(placed, decode, PIECES)
    whole = pieces.groupBy("part", "row", "id").agg(
        F.min("start").alias("start"), F.sum("length").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("start", "length", "crc"))).alias("pieces"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            pieces = batch.column("pieces")
            crc = pieces.flatten().field("crc").to_numpy()
            length = pieces.flatten().field("length").to_numpy()
            counts = pieces.value_lengths().to_numpy()
            begins = np.cumsum(counts) - counts
            out = crc[begins]
            for row in np.flatnonzero(counts > 1).tolist():  # documents that span blocks
                whole = int(out[row])
                for i in range(begins[row] + 1, begins[row] + counts[row]):
                    whole = crc32_joined(whole, int(crc[i]), 4 * int(length[i]))
                out[row] = whole
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("start"), batch.column("n_tokens"),
                                              pa.array(out)], names=["id", "start", "n_tokens", "ids_crc32"])

    return map_batches(whole.select("id", "start", "n_tokens", "pieces"), join,
                       "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint", rows=4096)

"""Packing of documents into token sequences: first-fit decreasing with a tournament tree.

Documents are dealt at random (by a hash of id and text) into groups of about GROUP_DOCS, which are
packed independently, each inside one task and with bounded memory: whole stretches of the sequence
length go out at once, and only the rest of each document (less than one sequence) is held. Rests are
placed longest first into the first sequence with enough room, which a tree of the sequences' free
room finds in logarithmic time. Then the emptiest sequences are cut up to fill the room left in the
others, so a group ends with at most one sequence that is not nearly full.

A group larger than GROUP_DOCS by more than chance (repeated rows hash alike) is packed in runs of
HELD_DOCS documents, so memory stays bounded and nothing is left out. Null texts are empty and hold
the end id. An empty table gives no pieces. Other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillrank.llm.encoding import encoder
from rillrank.llm.tasks import map_batches, slices

GROUP_DOCS = 2048
HELD_DOCS = 4096
OUT_PIECES = 1000
#: Room below this many tokens is left as padding; no piece is cut shorter to fill it.
SHORTEST_CUT = 16

PIECES = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, sequence_tokens bigint")
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                    ("sequence_tokens", pa.int64())])


class Rooms:
    """Free room of n sequences as a tournament tree: every inner node holds the larger of its two."""

    def __init__(self, n: int, room: int) -> None:
        self.leaves = 1 << max(0, (n - 1).bit_length())
        self.tree = [room] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """Takes `size` from the first sequence that has it; there always is one."""
        tree, at = self.tree, 1
        while at < self.leaves:
            at = 2 * at if tree[2 * at] >= size else 2 * at + 1
        tree[at] -= size
        leaf = at - self.leaves
        while at > 1:
            at >>= 1
            tree[at] = max(tree[2 * at], tree[2 * at + 1])
        return leaf


def first_fit_decreasing(sizes: list[int], room: int) -> list[list[int]]:
    """Indexes of `sizes` in each sequence used."""
    rooms, out = Rooms(max(1, len(sizes)), room), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = rooms.first_fit(sizes[i])
        if at == len(out):
            out.append([])
        out[at].append(i)
    return out


def fill(bins: list[list[int]], sizes: list[int], room: int) -> list[list[tuple[int, int, int]]]:
    """Pieces (index, start, length) of each sequence after the emptiest have filled the others."""
    pieces = [[(i, 0, sizes[i]) for i in b] for b in bins]
    load = [sum(sizes[i] for i in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda b: -load[b])
    to, source = 0, len(order) - 1
    while to < source:
        a, b = order[to], order[source]
        free = room - load[a]
        if free < SHORTEST_CUT:
            to += 1
        elif not pieces[b]:
            source -= 1
        else:
            i, start, length = pieces[b].pop()
            moved = min(free, length)
            pieces[a].append((i, start, moved))
            if moved < length:
                pieces[b].append((i, start + moved, length - moved))
            load[a] += moved
            load[b] -= moved
    return [p for p in pieces if p]


class _Group:
    """Packs one group's documents; `number` tells its sequences from those of other groups."""

    def __init__(self, number: int, room: int) -> None:
        self.number, self.room, self.next = number << 32, room, 0
        self.rests: list[tuple[int | None, int, np.ndarray, int]] = []

    def _piece(self, doc, start, ids, total, offset, tokens) -> dict:
        return {"doc_id": doc, "start": start, "length": len(ids), "ids": ids.astype("<u4").tobytes(),
                "doc_tokens": total, "sequence_id": self.number + self.next, "offset": offset,
                "sequence_tokens": tokens}

    def add(self, doc: int | None, ids: np.ndarray) -> Iterator[dict]:
        full = len(ids) // self.room * self.room
        for start in range(0, full, self.room):
            yield self._piece(doc, start, ids[start:start + self.room], len(ids), 0, self.room)
            self.next += 1
        if full < len(ids):
            self.rests.append((doc, full, ids[full:], len(ids)))
        if len(self.rests) == HELD_DOCS:
            yield from self.flush()

    def flush(self) -> Iterator[dict]:
        sizes = [len(r[2]) for r in self.rests]
        for sequence in fill(first_fit_decreasing(sizes, self.room), sizes, self.room):
            offset, tokens = 0, sum(length for _, _, length in sequence)
            for i, start, length in sequence:
                doc, before, ids, total = self.rests[i]
                yield self._piece(doc, before + start, ids[start:start + length], total, offset, tokens)
                offset += length
            self.next += 1
        self.rests = []


def pack(docs: DataFrame, tokenizer: str, end_id: int, room: int = 4096, id_column: str = "doc_id",
         text: str = "text", group_docs: int = GROUP_DOCS) -> DataFrame:
    """One row per piece: its ids (little-endian unsigned 32-bit), its place in its document, and the
    sequence and offset where it lies. `sequence_tokens` is the sequence's length before padding."""
    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    groups = max(1, -(-rows.count() // group_docs))
    dealt = rows.withColumn("number", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)))
    dealt = dealt.repartition("number").sortWithinPartitions("number", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = None
        for batch in slices(batches):
            encoded = encoder(tokenizer, end_id).encode(x.as_py() for x in batch.column("text"))
            out: list[dict] = []
            for number, doc, ids in zip(batch.column("number").to_pylist(), batch.column("doc_id").to_pylist(),
                                        encoded, strict=True):
                if group is None or group.number != number << 32:
                    out += group.flush() if group else []
                    group = _Group(number, room)
                out += group.add(doc, ids)
                if len(out) >= OUT_PIECES:
                    yield pa.RecordBatch.from_pylist(out, schema=_ARROW)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_ARROW)
        if group:
            yield pa.RecordBatch.from_pylist(list(group.flush()), schema=_ARROW)

    return map_batches(dealt, run, PIECES)


def padded(tokens: int, room: int = 4096) -> int:
    """Length of a sequence after padding: powers of two stay, others fill the room."""
    return tokens if tokens & (tokens - 1) == 0 else room

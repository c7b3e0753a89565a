"""Ranked search by terms: an inverted index in shards, read by Block-Max MaxScore.

A task indexes the documents it reads. Every `SHARD_DOCS` documents or `SHARD_POSTINGS` postings it writes out a
shard: a row per term with its postings in blocks of `BLOCK`, each compressed by itself, and beside them the
largest gain of each block and of the list. Nothing is shuffled to build it, and no term's list is ever whole.

A term's gain in a document is (10**9 * tf) div (1000 * tf + 8 * m) with m = 25 + (75 * n * N) div L, and its weight
floor(1000 * ln((2N + 2) / (2df + 1))); a score sums weight * gain over the query's terms, repeats included. N counts
the documents with a term, L all their terms, n one document's, df the documents that hold the term.

A search joins the index with the terms of a block of queries and brings a shard's matching lists to one task. There
the lists of a query are put in order of their bound. Lists whose bounds together stay below the tenth best score
are non-essential: they alone can bring no document up. The others are added up; a document found so is dropped if
what it has, plus the maxima of the blocks that could hold it in the non-essential lists, is not enough, and only
blocks that survivors need are decompressed. Each shard hands over its best `k`, and those are merged.

Null texts and texts without a term are not found and not counted. Each row is a document of its own, even if ids or
texts repeat. Equal scores go by the smaller id, documents without an id last. Each row of the queries is a query of
its own; one without a known term finds nothing. Empty tables give no rows. Other columns are not read. Ids are
integers. A text is indexed whole; a shard may pass its bounds by one document.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillrank.llm.tables import saved
from rillrank.llm.tasks import map_batches, slices

#: Fixed values of the score.
GAIN = 1_000_000_000
TF_FACTOR, LENGTH_FACTOR = 1000, 8
EVEN, BY_LENGTH = 25, 75

BLOCK = 128
SHARD_DOCS = 1 << 15
SHARD_POSTINGS = 1 << 21
WINDOW_DOCS = 1 << 12
#: Queries are taken in blocks of at most so many terms (one at least); a block's terms are broadcast.
BLOCK_TERMS = 100_000
#: Longer texts are not held as a list of words.
LONG_TEXT = 1 << 20

# Bytes of ASCII letters and digits, and all bytes of other characters.
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_POSTINGS = "shard BIGINT, term BINARY, df BIGINT, top BIGINT, lasts BINARY, tops BINARY, sizes BINARY, payload BINARY"
#: The row of a shard that holds its documents: ids in `lasts`, lengths in `tops`, missing ids in `sizes`, and the
#: postings per block in `top`.
_DOCUMENTS = b""


def term_counts(text: bytes) -> Counter[bytes]:
    """How often each term occurs, A-Z lower-cased."""
    text = text.lower()
    if len(text) > LONG_TEXT:
        return Counter(m.group() for m in _TERM.finditer(text))
    return Counter(_TERM.findall(text))


def _lengths(texts: pa.Array) -> np.ndarray:
    """The number of terms of each text, in one pass over their bytes."""
    texts = texts.fill_null(b"").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    inside = _INSIDE[raw]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    # A text's first byte starts a term, whatever the text before ends with.
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[firsts] = inside[firsts]
    total = np.concatenate([[0], np.cumsum(starts)])
    return total[offsets[1:]] - total[offsets[:-1]]


def slow_down(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """m of documents with n terms."""
    n = np.asarray(n, dtype=np.int64)
    if int(n.max(initial=0)) * BY_LENGTH * docs >= 1 << 63:
        return np.array([EVEN + BY_LENGTH * x * docs // terms for x in n.tolist()], dtype=np.int64)
    return EVEN + BY_LENGTH * n * docs // terms


def gains(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return GAIN * tf // (TF_FACTOR * tf + LENGTH_FACTOR * m)


@dataclass(frozen=True)
class Index:
    """`postings` by shard and term; `docs` documents with a term, `terms` of them in all."""

    postings: DataFrame
    docs: int
    terms: int


class _Shard:
    """The postings of the documents read so far."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.distinct: list[int] = []
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.terms, self.tfs = array("i"), array("i")

    def add(self, doc_id: int | None, text: bytes) -> None:
        counts = term_counts(text)
        if counts:
            self.ids.append(doc_id)
            self.lengths.append(counts.total())
            self.distinct.append(len(counts))
            self.terms.extend(map(self.numbers.__getitem__, counts))
            self.tfs.extend(counts.values())

    def rows(self, shard: int, docs: int, total: int, block: int = BLOCK) -> Iterator[tuple]:
        """The documents by ascending id, then a row per term."""
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        none = np.array([i is None for i in self.ids], bool)
        order = np.lexsort((ids, none))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        lengths = np.array(self.lengths, np.int64)[order]
        yield (shard, _DOCUMENTS, len(ids), block, ids[order].tobytes(), lengths.tobytes(), none[order].tobytes(), b"")

        terms, tf = np.frombuffer(self.terms, np.int32), np.frombuffer(self.tfs, np.int32)
        doc = np.repeat(place, self.distinct)
        by = np.lexsort((doc, terms))
        doc, tf = doc[by].astype(np.int32), tf[by]
        gain = gains(tf, slow_down(lengths, docs, total)[doc])
        sizes = np.bincount(terms, minlength=len(self.numbers))
        ends = np.cumsum(sizes)
        pack = zstandard.ZstdCompressor(level=1, write_content_size=True, write_checksum=False).compress
        for term, begin, end in zip(self.numbers, (ends - sizes).tolist(), ends.tolist()):
            starts = np.arange(begin, end, block)
            tops = np.maximum.reduceat(gain[begin:end], starts - begin).astype(np.int32)
            lasts = doc[np.minimum(starts + block, end) - 1]
            blocks, before = [], 0
            for at, last in zip(starts.tolist(), lasts.tolist()):
                stop = min(at + block, end)
                steps = np.diff(doc[at:stop], prepend=np.int32(before))
                blocks.append(pack(steps.tobytes() + tf[at:stop].tobytes()))
                before = last
            yield (shard, term, end - begin, int(tops.max()), lasts.tobytes(), tops.tobytes(),
                   np.array([len(b) for b in blocks], np.int32).tobytes(), b"".join(blocks))


def build(df: DataFrame, key: str, text: str, shard_docs: int = SHARD_DOCS,
          shard_postings: int = SHARD_POSTINGS, block: int = BLOCK) -> Index:
    """The index of a whole table, as a table in the shared folder."""
    chosen = df.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").cast("binary").alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = terms = 0
        for part in slices(batches):
            n = _lengths(part.column("text"))
            docs, terms = docs + int((n > 0).sum()), terms + int(n.sum())
        yield pa.RecordBatch.from_pydict({"docs": [docs], "terms": [terms]})

    of = map_batches(chosen.select("text"), measure, "docs BIGINT, terms BIGINT").agg(
        F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("terms"), F.lit(0)).alias("terms")).first()
    docs, total = of["docs"], of["terms"]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _POSTINGS.split(", ")]
        types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        number = count(TaskContext.get().partitionId() << 24)

        def written(held: _Shard) -> Iterator[pa.RecordBatch]:
            rows: list[tuple] = []
            for row in held.rows(next(number), docs, total, block):
                rows.append(row)
                if len(rows) >= 4096:
                    yield packed(rows)
                    rows = []
            if rows:
                yield packed(rows)

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        held = _Shard()
        for part in slices(batches):
            for doc_id, value in zip(part.column("key").to_pylist(), part.column("text")):
                if value.is_valid:
                    held.add(doc_id, value.as_py())
                if len(held.ids) >= shard_docs or len(held.terms) >= shard_postings:
                    yield from written(held)
                    held = _Shard()
        if held.ids:
            yield from written(held)

    return Index(saved(map_batches(chosen, index, _POSTINGS), "index"), docs, total)


def _weights(index: Index, queries: DataFrame) -> DataFrame:
    """(q, term, weight) of the terms that some document holds; a repeated term weighs as often."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [(q, t, n) for q, text in zip(part.column("q").to_pylist(), part.column("text").to_pylist())
                     for t, n in term_counts(text or b"").items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in found], pa.int64()),
                                              pa.array([r[1] for r in found], pa.binary()),
                                              pa.array([r[2] for r in found], pa.int64())], ["q", "term", "times"])

    terms = saved(map_batches(queries.select("q", "text"), cut, "q BIGINT, term BINARY, times BIGINT"), "query-terms")
    df = index.postings.where(F.length("term") > 0).join(terms.select("term").distinct(), "term", "left_semi") \
        .groupBy("term").agg(F.sum("df").alias("df"))
    w = F.floor(1000 * F.log((2.0 * index.docs + 2) / (2 * F.col("df") + 1).cast("double"))).cast("bigint")
    return terms.join(df, "term").select("q", "term", (w * F.col("times")).alias("weight")).where("weight > 0")


def _blocks(weights: DataFrame) -> Iterator[dict[int, list[tuple[bytes, int]]]]:
    """Queries in blocks of at most BLOCK_TERMS terms."""
    block: dict[int, list[tuple[bytes, int]]] = {}
    held = 0
    for row in weights.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("terms")).toLocalIterator():
        terms = [(bytes(t["term"]), t["weight"]) for t in row["terms"]]
        if block and held + len(terms) > BLOCK_TERMS:
            yield block
            block, held = {}, 0
        block[row["q"]] = terms
        held += len(terms)
    if block:
        yield block


class _Postings:
    """One term's list in one shard; blocks are decompressed when first asked for."""

    def __init__(self, top: int, lasts: bytes, tops: bytes, sizes: bytes, payload: bytes, df: int, m: np.ndarray,
                 block: int = BLOCK):
        self.top, self.m, self.payload, self.block = top, m, payload, block
        self.lasts, self.tops = np.frombuffer(lasts, np.int32), np.frombuffer(tops, np.int32).astype(np.int64)
        self.ends = np.cumsum(np.frombuffer(sizes, np.int32), dtype=np.int64)
        self.closed = np.ones(len(self.lasts), bool)
        # Where a block is closed its last document stands in for all, which keeps the list in order.
        self.docs = np.repeat(self.lasts, block)[:df]
        self.gains = np.zeros(df, np.int64)

    def open(self, blocks: np.ndarray) -> int:
        """Decompresses those of the blocks that are closed, and says how many."""
        asked = blocks[self.closed[blocks]].tolist()
        for b in asked:
            end = int(self.ends[b])
            data = _unpack(self.payload[int(self.ends[b - 1]) if b else 0:end])
            steps, tf = np.frombuffer(data, np.int32).reshape(2, -1)
            at = b * self.block
            docs = np.cumsum(steps) + (int(self.lasts[b - 1]) if b else 0)
            self.docs[at:at + len(docs)] = docs
            self.gains[at:at + len(docs)] = gains(tf, self.m[docs])
            self.closed[b] = False
        return len(asked)

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and gains of a range of documents."""
        first, last = np.searchsorted(self.lasts, [low, high])
        self.open(np.arange(first, min(last + 1, len(self.lasts))))
        a, b = np.searchsorted(self.docs, [low, high])
        return self.docs[a:b], self.gains[a:b]

    def block_of(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block that could hold each document (the number of blocks if none), and that block's largest gain."""
        block = np.searchsorted(self.lasts, docs)
        return block, np.append(self.tops, 0)[block]

    def gains_of(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        self.open(np.unique(blocks[blocks < len(self.lasts)]))
        at = np.minimum(np.searchsorted(self.docs, docs), len(self.docs) - 1)
        return np.where(self.docs[at] == docs, self.gains[at], 0)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def best_of_shard(lists: list[tuple[int, _Postings]], n_docs: int, k: int,
                  window: int = WINDOW_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """The `k` documents of the highest scores above 0 and the scores, the smaller document first among equals."""
    lists = sorted(lists, key=lambda x: x[0] * x[1].top)
    # below[j] bounds what the first j lists can add together.
    below = np.cumsum([0] + [w * p.top for w, p in lists])
    docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    for low in range(0, n_docs, window):
        # Documents come in order, so that a later one must pass the last of k, not equal it.
        floor = int(scores[-1]) if len(scores) == k else 0
        first = int(np.searchsorted(below[1:], floor, side="right"))
        if first == len(lists):
            break
        added = np.zeros(window, np.int64)
        for weight, postings in lists[first:]:
            found, gain = postings.between(low, low + window)
            added[found - low] += weight * gain
        near = np.flatnonzero((added > 0) & (added + below[first] > floor))
        have, near = added[near], near + low
        # What the blocks of the non-essential lists allow each candidate, list by list.
        blocks, allowed = [], []
        for weight, postings in lists[:first]:
            block, top = postings.block_of(near)
            blocks.append(block)
            allowed.append(weight * top)
        most = have + sum(allowed) if allowed else have
        for j in range(first - 1, -1, -1):
            alive = most > floor
            near, have, most = near[alive], have[alive], most[alive]
            blocks, allowed = [b[alive] for b in blocks[:j + 1]], [a[alive] for a in allowed[:j + 1]]
            if not len(near):
                break
            gain = lists[j][0] * lists[j][1].gains_of(near, blocks[j])
            have, most = have + gain, most - allowed[j] + gain
        docs, scores = np.concatenate([docs, near]), np.concatenate([scores, have])
        order = np.lexsort((docs, -scores))[:k]
        docs, scores = docs[order], scores[order]
        docs, scores = docs[scores > 0], scores[scores > 0]
    return docs, scores


def _search_shard(table: pa.Table, block: dict[int, list[tuple[bytes, int]]], docs: int, terms: int, k: int) -> pa.Table:
    rows = {r["term"]: r for r in table.to_pylist()}
    of = rows.pop(_DOCUMENTS)
    ids, none = np.frombuffer(of["lasts"], np.int64), np.frombuffer(of["sizes"], bool)
    m = slow_down(np.frombuffer(of["tops"], np.int64), docs, terms)
    lists = {t: _Postings(r["top"], r["lasts"], r["tops"], r["sizes"], r["payload"], r["df"], m, of["top"])
             for t, r in rows.items()}
    q, places, scores = [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for query, weights in block.items():
        found = [(w, lists[t]) for t, w in weights if t in lists]
        if found:
            best, score = best_of_shard(found, len(ids), k)
            q += [query] * len(best)
            places.append(best)
            scores.append(score)
    at = np.concatenate(places)
    return pa.table({"q": pa.array(q, pa.int64()), "doc_id": pa.array(ids[at], pa.int64(), mask=none[at]),
                     "score": pa.array(np.concatenate(scores), pa.int64())})


def search(index: Index, queries: DataFrame, key: str, text: str, k: int = 10) -> DataFrame:
    """The `k` best documents of each row of `queries`: `key`, rank (from 1), doc_id, score."""
    asked = saved(queries.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias("text"))
                  .withColumn("q", F.monotonically_increasing_id()), "queries")
    spark, found = index.postings.sparkSession, []
    for block in _blocks(_weights(index, asked)):
        terms = spark.createDataFrame([(t,) for t in sorted({t for of in block.values() for t, _ in of} | {_DOCUMENTS})],
                                      "term BINARY")
        lists = index.postings.join(F.broadcast(terms), "term", "left_semi")

        found.append(lists.groupBy("shard").applyInArrow(_task(index.docs, index.terms, block, k), "q BIGINT, doc_id BIGINT, score BIGINT"))
    if not found:
        found = [spark.createDataFrame([], "q BIGINT, doc_id BIGINT, score BIGINT")]
    merged = found[0]
    for more in found[1:]:
        merged = merged.union(more)
    by = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = merged.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return best.join(asked.select("q", "key"), "q").select(F.col("key").alias(key), "rank", "doc_id", "score")


def _task(docs: int, terms: int, block: dict[int, list[tuple[bytes, int]]], k: int):
    """The task function, which takes along only what it names."""
    return lambda table: _search_shard(table, block, docs, terms, k)

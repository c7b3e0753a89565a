"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are taken in blocks of BLOCK_ITEMS, and of about BLOCK_CHARS, whose words, vectors and
projections are broadcast. Items longer than a passage are cut into parts of PASSAGE words, so that a long item
is found like a short one. A block's parts are dealt into groups of at most RANK, so that the directions of a
group span it whole and no part is lost in a projection. For each block:

1. Passages. Documents are cut to passages of PASSAGE words, one every STEP words. In how many passages
   each word of the block occurs is counted over all documents and gives the weights (idf). Words that no item
   has weigh as much as the median word of the block, so weights do not depend on the size of the corpus.
2. Latent space. A randomised SVD of each group's TF-IDF matrix, computed on the executors: the matrix is
   sketched with random vectors (item by item), the sketch's orthonormal base is multiplied back (word
   by word), and a small eigenproblem on the driver turns the result into at most RANK directions.
3. Candidates. Every passage of every document is projected. Its cosine to each part is measured
   against the passage's whole length, so words that no item has count against it, but against no more than
   LONGEST times the part's length: a passage that holds about half of a short part's weight is a candidate whatever
   stands around it. Passages whose share of item words, or whose projection, is too small for the threshold are
   skipped: neither can reach it.
4. Verification. The longest common subsequence of words between the item and the stretch of text
   around its candidates. SEQUENCE_SHARE of the item's words in order is a leak; PARAPHRASE_SHARE is
   one if the item's answer, its last ANSWER_WORDS words, stands there unbroken.

Case and ASCII punctuation are ignored. Null and empty texts have no passages; items without words
match nothing; an empty benchmark or table gives no rows. Rows without an id are searched too, with a
null id. Equal rows give equal results. Other columns of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillrank.llm.tables import fresh
from rillrank.llm.tasks import map_batches, slices

PASSAGE, STEP = 48, 16
RANK, OVERSAMPLE = 256, 16
BLOCK_ITEMS, BLOCK_CHARS = 4096, 1 << 19
SIMILARITY = 0.35
LONGEST = 1.5
SEQUENCE_SHARE, PARAPHRASE_SHARE = 0.8, 0.6
ANSWER_WORDS = 8
SEGMENT_WORDS = 1 << 15
SEED = 7

_PUNCTUATION = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
RESULT = "id bigint, item_id bigint, similarity double, common_words int, item_words int, matched string"


def plain_words(text: str | None) -> list[bytes]:
    return text.encode().lower().translate(_PUNCTUATION).split() if text else []


@dataclass
class Group:
    """Parts of a block's items that share a latent space of as many directions as their matrix has."""

    items: np.ndarray  # for each part, its item's number in the block
    row: np.ndarray  # row in `directions` of each word of the block; words of other groups have the last
    directions: np.ndarray  # the group's words x rank, times idf; the last row is zero
    latent: np.ndarray  # parts x rank, of unit length in the full space
    lengths: np.ndarray  # of the parts in the full space


@dataclass
class Block:
    """What the tasks need of a block of items."""

    ids: list[int]
    items: list[list[bytes]]
    place: dict[bytes, int]
    weight: np.ndarray | None = None  # idf of each word; the last is for all other words
    groups: list[Group] = field(default_factory=list)


def longest_common(item: list[bytes], text: list[bytes]) -> int:
    """Length of the longest common subsequence; the item's words are the bits of a number."""
    masks: dict[bytes, int] = {}
    for i, word in enumerate(item):
        masks[word] = masks.get(word, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for word in text:
        mask = masks.get(word)
        if mask:
            kept = row & mask
            row = ((row + kept) | (row - kept)) & full
    return len(item) - row.bit_count()


def _holds(text: list[bytes], run: list[bytes]) -> bool:
    return b" " + b" ".join(run) + b" " in b" " + b" ".join(text) + b" "


def _passages(n: int) -> int:
    """How many passages begin in a text of n words."""
    return 0 if not n else 1 + max(0, -(-(n - PASSAGE) // STEP))


def _weights(texts: DataFrame, block: Block) -> np.ndarray:
    """idf of the block's words over the disjoint stretches of PASSAGE words of all documents."""
    shared = texts.sparkSession.sparkContext.broadcast(block.place)
    n = len(block.place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, get = np.zeros(n + 1, np.int64), shared.value.get
        for batch in slices(batches):
            for text in batch.column("text"):
                at = np.array([get(w, -1) for w in plain_words(text.as_py())], np.int64)
                known = np.flatnonzero(at >= 0)
                if len(known):
                    # A stretch and a word in one number, each pair counted once.
                    pairs = np.sort((known // PASSAGE) * n + at[known])
                    first = np.concatenate(([True], pairs[1:] != pairs[:-1]))
                    held[:n] += np.bincount(pairs[first] % n, minlength=n)
                held[n] += -(-len(at) // PASSAGE)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], names=["word", "n"])

    counted = map_batches(texts, run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    found = np.zeros(n + 1, np.int64)
    for row in counted.collect():  # at most one row for each word of the block
        found[row["word"]] = row["n"]
    total = max(1, int(found[n]))
    weight = np.log((total + 1) / (found + 1)) + 0.01
    weight[n] = np.median(weight[:n])
    return weight


def _svd(items: DataFrame, count: int, weight: np.ndarray, rank: int) -> np.ndarray:
    """Directions (words x rank) of a randomised SVD of the TF-IDF matrix of `count` items."""
    n, spark = len(weight), items.sparkSession
    width = min(rank + OVERSAMPLE, count, n)
    shared = spark.sparkContext.broadcast(weight)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        test = np.random.default_rng(SEED).standard_normal((n, width))
        for batch in batches:
            rows = []
            for words in batch.column("words").to_pylist():
                at = np.array(words, np.int64)
                rows.append((weight[at, None] * test[at]).sum(axis=0).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("number"), pa.array(rows, pa.binary())], names=["number", "row"])

    got = map_batches(items, sketch, "number bigint, row binary").collect()
    sketched = np.zeros((count, width))
    for row in got:
        sketched[row["number"]] = np.frombuffer(bytes(row["row"]))
    base, _ = np.linalg.qr(sketched)
    based = spark.sparkContext.broadcast(base)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        for batch in batches:
            sums: dict[int, np.ndarray] = {}
            for word, numbers in zip(batch.column("word").to_pylist(), batch.column("numbers").to_pylist(), strict=True):
                sums[word] = weight[word] * based.value[numbers].sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()),
                                              pa.array([x.tobytes() for x in sums.values()], pa.binary())],
                                             names=["word", "row"])

    by_word = items.select("number", F.explode("words").alias("word")).groupBy("word").agg(
        F.collect_list("number").alias("numbers"))  # at most the items of a group
    product = np.zeros((n, base.shape[1]))
    for row in map_batches(by_word, back, "word bigint, row binary").collect():
        product[row["word"]] = np.frombuffer(bytes(row["row"]))
    values, vectors = np.linalg.eigh(product.T @ product)
    top = [i for i in np.argsort(values)[::-1][:rank] if values[i] > 1e-12 * max(values.max(), 1e-30)]
    return product @ vectors[:, top] / np.sqrt(values[top])


def _candidates(at: np.ndarray, block: Block, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages, items and cosines at or above the threshold, of one stretch of words."""
    other = len(block.place)
    where = np.where(at >= 0, at, other)
    steps, count = np.arange(0, len(at), STEP), _passages(len(at))

    def passages(by_step: np.ndarray) -> np.ndarray:
        total = np.concatenate((np.zeros((1, *by_step.shape[1:]), by_step.dtype), np.cumsum(by_step, axis=0)))
        ends = np.minimum(np.arange(count) + PASSAGE // STEP, len(by_step))
        return total[ends] - total[:count]

    energy = block.weight[where] ** 2
    length = passages(np.add.reduceat(energy, steps))
    found = []
    for group in block.groups:
        row = group.row[where]
        known = passages(np.add.reduceat(np.where(row < len(group.directions) - 1, energy, 0.0), steps))
        least = np.minimum(np.sqrt(length), LONGEST * group.lengths.min())
        some = np.flatnonzero(known >= (similarity * least) ** 2)
        if not len(some):
            continue
        projected = _projected(row, some, steps, group.directions)
        reach = np.flatnonzero(np.sqrt((projected ** 2).sum(axis=1)) >= similarity * least[some])
        norm = np.sqrt(length[some[reach]]).astype(np.float32)
        dot = projected[reach] @ group.latent.T
        at_row, item = np.nonzero(dot >= similarity * np.minimum(norm[:, None], LONGEST * group.lengths))
        cosine = dot[at_row, item] / np.minimum(norm[at_row], LONGEST * group.lengths[item])
        found.append((some[reach[at_row]], group.items[item], np.minimum(cosine, 1.0)))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _projected(row: np.ndarray, some: np.ndarray, steps: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Projections of the passages `some` of words whose rows in `directions` are given."""
    # Only steps of those passages are projected, and of them the words that the group has.
    span = PASSAGE // STEP
    mine = np.zeros(len(steps) + span, dtype=bool)
    for i in range(span):
        mine[some + i] = True
    words = np.flatnonzero(mine[np.arange(len(row)) // STEP] & (row < len(directions) - 1))
    # Steps behind the last one, and those without such words, stay zero.
    sums = np.zeros((len(steps) + span, directions.shape[1]), np.float32)
    if len(words):
        step = words // STEP
        first = np.flatnonzero(np.diff(step, prepend=-1))
        sums[step[first]] = np.add.reduceat(directions[row[words]], first, axis=0)
    out = sums[some]
    for i in range(1, span):
        out += sums[some + i]
    return out


def find_leaks(words: list[bytes], block: Block, similarity: float) -> list[tuple[int, float, int, str]]:
    """(item number, cosine, common words, how it matched) of one text, each item once."""
    get, best = block.place.get, {}
    # Long texts are searched in stretches that overlap by more than a passage.
    for begin in range(0, max(1, len(words) - PASSAGE), SEGMENT_WORDS):
        part = words[begin:begin + SEGMENT_WORDS + PASSAGE + STEP]
        at = np.array([get(w, -1) for w in part], np.int64)
        if not len(at):
            continue
        passage, item, cosine = _candidates(at, block, similarity)
        order = np.lexsort((passage, item))
        low = high = last = None
        runs = []
        for p, i, c in zip(passage[order].tolist(), item[order].tolist(), cosine[order].tolist(), strict=True):
            if i == last and p * STEP <= high:
                high = p * STEP + PASSAGE
                runs[-1][2], runs[-1][3] = high, max(c, runs[-1][3])
            else:
                last, low, high = i, p * STEP, p * STEP + PASSAGE
                runs.append([i, low, high, c])
        for i, low, high, c in runs:
            item_words = block.items[i]
            m = len(item_words)
            around = words[max(0, begin + low - m):begin + high + m]
            # As many of the item's words as stand there at all bound the subsequence.
            if sum(map(set(around).__contains__, item_words)) < PARAPHRASE_SHARE * m:
                continue
            common = longest_common(item_words, around)
            if common >= SEQUENCE_SHARE * m:
                how = "sequence"
            elif common >= PARAPHRASE_SHARE * m and _holds(around, item_words[-ANSWER_WORDS:]):
                how = "answer"
            else:
                continue
            if i not in best or best[i][1:3] < (common, c):
                best[i] = (i, common, c, how)
    return [(i, c, common, how) for i, common, c, how in best.values()]


def _block(items: DataFrame, texts: DataFrame, rank: int) -> Block | None:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array([plain_words(x.as_py()) for x in batch.column("text")],
                                                   pa.list_(pa.binary()))], names=["item_id", "words"])

    rows = [r for r in map_batches(items, cut, "item_id bigint, words array<binary>").collect() if r["words"]]
    if not rows:
        return None
    rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, [bytes(w) for w in r["words"]]))
    words = [[bytes(w) for w in r["words"]] for r in rows]
    place = {w: i for i, w in enumerate(sorted({w for item in words for w in item}))}
    block = Block([r["item_id"] for r in rows], words, place)
    block.weight = _weights(texts, block)
    parts = [(i, [place[w] for w in part]) for i, item in enumerate(words) for part in _parts(item)]
    # Parts of a group have about the same length, since the shortest decides which passages are projected.
    parts.sort(key=lambda x: len(x[1]))
    block.groups = [_group(texts, block, parts[i:i + rank], rank) for i in range(0, len(parts), rank)]
    return block


def _parts(item: list[bytes]) -> list[list[bytes]]:
    """An item in parts of at most PASSAGE words, of nearly equal length."""
    count = -(-len(item) // PASSAGE)
    return [item[i * len(item) // count:(i + 1) * len(item) // count] for i in range(count)]


def _group(texts: DataFrame, block: Block, parts: list[tuple[int, list[int]]], rank: int) -> Group:
    numbers, items = np.array([i for i, _ in parts]), [part for _, part in parts]
    used = np.unique(np.concatenate(items))
    row = np.full(len(block.place) + 1, len(used))
    row[used] = np.arange(len(used))
    weight = block.weight[used]
    rows = [row[item] for item in items]
    numbered = texts.sparkSession.createDataFrame(
        [(i, r.tolist()) for i, r in enumerate(rows)], "number bigint, words array<bigint>")
    directions = _svd(numbered, len(rows), weight, rank)
    directions = np.vstack([directions * weight[:, None], np.zeros(directions.shape[1])]).astype(np.float32)
    latent = np.stack([directions[r].sum(axis=0) for r in rows])
    # Length of the vectors of counts times idf: a word that stands in a part twice has twice the weight.
    norm = np.array([np.sqrt((np.bincount(r, weight[r], len(used)) ** 2).sum()) for r in rows])
    return Group(numbers, row, directions, (latent / norm[:, None]).astype(np.float32), norm.astype(np.float32))


def leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text",
          similarity: float = SIMILARITY, rank: int = RANK, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """One row for each document and benchmark item (item_id, text) that it holds."""
    texts = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    size = benchmark.agg(F.count("*").alias("n"), F.sum(F.char_length("text")).alias("chars")).first()
    blocks = max(1, -(-size["n"] // block_items), -(-(size["chars"] or 0) // BLOCK_CHARS))
    out = None
    for number in range(blocks):
        items = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).select(
            F.col("item_id").cast("bigint").alias("item_id"), "text")
        block = _block(items, texts.select("text"), rank)
        if block is None:
            continue
        found = _search(texts, block, similarity)
        out = found if out is None else out.unionByName(found)
    out = docs.sparkSession.createDataFrame([], RESULT) if out is None else out
    return out.withColumnRenamed("id", id_column)


def _search(texts: DataFrame, block: Block, similarity: float) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in slices(batches):
            rows = []
            for doc, value in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                for i, cosine, common, how in find_leaks(plain_words(value.as_py()), block, similarity):
                    rows.append((doc, block.ids[i], cosine, common, len(block.items[i]), how))
            if rows:
                types = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                    names=["id", "item_id", "similarity", "common_words", "item_words", "matched"])

    return map_batches(texts, run, RESULT)


def without_leaks(docs: DataFrame, found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """`docs` without those named in `found`; columns as given. Rows without an id stay."""
    leaked, = fresh(docs.columns, "leaked")
    named = found.select(F.col(id_column).alias(leaked)).where(F.col(leaked).isNotNull()).distinct()
    return docs.join(named, F.col(f"`{id_column}`") == F.col(leaked), "left_anti")

"""A bigram language model in log-frequency Bloom filters.

Counts. Words (A-Z lower-cased, then one end per text) and pairs of consecutive words are counted over
all training texts, summed inside tasks before the shuffle.

Filters. A count c is quantised to 1 + floor(log_1.6 c) levels. Every level up to a key's own is put
into a Bloom filter, all bits of one entry in one 64-bit place; a count is read back by probing levels
until one is missing. A filter is built slice by slice on the executors, and its size is known
beforehand. Up to MAX_BYTES it is broadcast. The filter of words thins its bits to stay within that;
a filter of pairs that would be larger is not built: pairs then meet their levels in a shuffled join.

Probabilities. Words that precede (contexts) are classed by their level. Within a class the share of
pairs seen only once estimates how much probability is left for unseen pairs:

    P(w | v) = (1 - left[class v]) * least(v, w) / most(v) + left[class v] * P(w)
    P(w) = (count(w) + 1) / Z

where counts are read from the filters: `least` is the smallest count of the pair's level and at most
`most`, the largest of the context's own level. So the followers of a context sum to at most one, each
probability is at most one, and what rounding leaves over goes to none. Z is the total of read-back counts
plus one each, so that words sum to one. A level that the filter reads too high (a false positive) can only
lower what a context gives out, or lift one pair.

Base. The sum of log10((c + 1) / (N + V + 1)) uses exact counts: words with at least N / HEAD
occurrences (fewer than HEAD of them, 16 bytes each) are broadcast, the others joined by a shuffle.

Null and empty texts are one end. Without training texts N is 0, base_score is 0 and score is the
probability under P(w) = 1 for every word: 0. Equal rows are scored alike. Other columns of the input
are ignored. Words are told apart by 64-bit hashes, pairs by 58 bits of one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillrank.llm.tables import saved
from rillrank.llm.tasks import ROWS, map_batches, slices
from rillrank.llm.words import mix, text_hashes

BASE = 1.6
MAX_LEVEL = 63
MAX_BYTES = 128 << 20
BITS_PER_ENTRY = 12
SLICE_PLACES = 1 << 16
HEAD = 1 << 22
CHUNK_TOKENS = 2 << 20
SCORED_TOKENS = 1 << 18
START, END = np.uint64(0x5354415254000001), np.uint64(0x454E440000000001)
_PAIR = np.uint64(0xD6E8FEB86659FD93)
#: Smallest count of levels 1, 2, ...; a level is read back as the middle of its range.
_FIRST = [math.ceil(BASE ** i) for i in range(MAX_LEVEL + 1)]
LEAST = np.array([0.0, *map(float, _FIRST[:-1])])
#: An unknown context gives nothing to its followers; the last level is open.
MOST = np.array([1.0, *(b - 1.0 for b in _FIRST[1:])])
READ = np.array([0.0, *((a + b - 1) / 2 for a, b in zip(_FIRST, _FIRST[1:], strict=False))])


def level_of(count: int) -> int:
    return min(MAX_LEVEL, 1 + math.floor(math.log(count) / math.log(BASE) + 1e-9)) if count > 0 else 0


def level_column(count: Column) -> Column:
    """`level_of` for positive counts."""
    return F.least(F.lit(MAX_LEVEL), 1 + F.floor(F.log(count) / math.log(BASE) + 1e-9)).cast("int")


def _sources(key: np.ndarray, level: int | np.ndarray) -> np.ndarray:
    return mix(key + np.asarray(level, np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _bits(source: np.ndarray) -> np.ndarray:
    """Four bits of a place from 24 bits of the entry's hash."""
    out = np.uint64(1) << (source & np.uint64(63))
    for shift in (6, 12, 18):
        out = out | (np.uint64(1) << ((source >> np.uint64(shift)) & np.uint64(63)))
    return out


@dataclass
class Filter:
    places: np.ndarray  # uint64, `slices` runs of `width`
    slices: int
    width: int

    def where(self, key: np.ndarray, source: np.ndarray) -> np.ndarray:
        part = slice_of(key, self.slices)
        return part * np.uint64(self.width) + (source >> np.uint64(24)) % np.uint64(self.width)

    def read(self, key: np.ndarray) -> np.ndarray:
        """Level of each key: membership probes of rising levels until one fails."""
        out, left = np.zeros(len(key), np.int64), np.arange(len(key))
        for level in range(1, MAX_LEVEL + 1):
            source = _sources(key[left], level)
            bits = _bits(source)
            left = left[(self.places[self.where(key[left], source)] & bits) == bits]
            if not len(left):
                break
            out[left] = level
        return out


def slice_of(key: np.ndarray, slices: int) -> np.ndarray:
    return (key >> np.uint64(20)) % np.uint64(slices)


def filter_shape(entries: int, max_bytes: int) -> tuple[int, int, bool]:
    """Slices, places per slice, and whether that many entries fit at BITS_PER_ENTRY."""
    wanted = max(64, entries * BITS_PER_ENTRY // 64)
    places = min(wanted, max_bytes // 8)
    slices = max(1, places // SLICE_PLACES)
    return slices, -(-places // slices), wanted <= places


def build_filter(counted: DataFrame, slices: int, width: int) -> Filter:
    """counted: key, level. Each task fills the slices that are dealt to it; the filter's size is fixed."""
    part = F.pmod(F.shiftrightunsigned("key", 20), F.lit(slices)).alias("slice")
    dealt = counted.select(part, "key", "level").repartition("slice")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            parts, key = batch.column("slice").to_numpy(), batch.column("key").to_numpy().view(np.uint64)
            level = batch.column("level").to_numpy()
            for p in np.unique(parts).tolist():
                mine = parts == p
                places = held.setdefault(p, np.zeros(width, np.uint64))
                keys, tops = key[mine], level[mine]
                for now in range(1, int(tops.max()) + 1):
                    source = _sources(keys[tops >= now], now)
                    np.bitwise_or.at(places, (source >> np.uint64(24)) % np.uint64(width), _bits(source))
        for p, places in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([places.tobytes()], pa.binary())],
                                             names=["slice", "places"])

    places = np.zeros(slices * width, np.uint64)
    for row in map_batches(dealt, run, "slice bigint, places binary", rows=10_000).toLocalIterator():
        places[row["slice"] * width:(row["slice"] + 1) * width] = np.frombuffer(bytes(row["places"]), np.uint64)
    return Filter(places, slices, width)


@dataclass
class Model:
    tokens: int
    distinct: int
    words: Filter
    pairs: Filter | None
    total: float  # Z
    left: np.ndarray  # by level of the context
    head_key: np.ndarray
    head_count: np.ndarray
    word_counts: DataFrame = field(repr=False)
    pair_levels: DataFrame = field(repr=False)

    def shared(self) -> tuple:
        return (self.tokens, self.distinct, self.words, self.pairs, self.total, self.left,
                self.head_key, self.head_count)


def _tokens(text: str | None) -> np.ndarray:
    return np.append(text_hashes(text, lower=True), END)


def _pairs(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts, and keys of 58 bits."""
    context = np.concatenate(([START], tokens[:-1]))
    return context, mix(context * _PAIR + tokens) >> np.uint64(6)


def _chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[list[np.ndarray]]:
    held, n = [], 0
    for batch in slices(batches):
        for text in batch.column(column):
            held.append(_tokens(text.as_py()))
            n += len(held[-1])
            if n >= CHUNK_TOKENS:
                yield held
                held, n = [], 0
    if held:
        yield held


def _counts(texts: DataFrame, words: Filter | None) -> DataFrame:
    """(key, n) of words; with a filter of words, of pairs, the context's level in the key's last 6 bits."""
    shared = texts.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            if shared.value is None:
                keys = np.concatenate(chunk)
            else:
                context, pair = map(np.concatenate, zip(*map(_pairs, chunk), strict=True))
                known, place = np.unique(context, return_inverse=True)
                keys = (pair << np.uint64(6)) | shared.value.read(known)[place].astype(np.uint64)
            keys, n = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

    return map_batches(texts.select("text"), run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def fit(training: DataFrame, text: str = "text", max_bytes: int = MAX_BYTES) -> Model:
    texts = training.select(F.col(f"`{text}`").alias("text"))
    counted = saved(_counts(texts, None), "word-counts").withColumn("level", level_column(F.col("n")))
    # Texts are counted by their ends.
    got = counted.agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.sum("level").alias("entries"),
                      F.max(F.when(F.col("key") == int(END), F.col("n"))).alias("texts")).first()
    tokens, distinct, docs = got["n"] or 0, got["v"], got["texts"] or 0
    by_level = {r["level"]: r["c"] for r in counted.groupBy("level").agg(F.count("*").alias("c")).collect()}
    total = float(sum((READ[level] + 1) * c for level, c in by_level.items()) + 1)
    start = counted.sparkSession.range(1).select(
        F.lit(int(START)).cast("bigint").alias("key"), F.lit(level_of(docs)).alias("level"))
    slices, width, _ = filter_shape((got["entries"] or 0) + MAX_LEVEL, max_bytes)
    words = build_filter(counted.select("key", "level").union(start), slices, width)
    pairs = _counts(texts, words).select(
        F.shiftrightunsigned("key", 6).alias("key"), F.col("key").bitwiseAND(F.lit(63)).alias("context"), "n",
        level_column(F.col("n")).alias("level"))
    pairs = saved(pairs, "pair-counts")
    classes = pairs.groupBy("context", "level").agg(F.count("*").alias("c"), F.sum("n").alias("n")).collect()
    left = np.ones(MAX_LEVEL + 1)
    entries = 0
    for level in {r["context"] for r in classes}:
        own = [r for r in classes if r["context"] == level]
        entries += sum(r["c"] * r["level"] for r in own)
        once = sum(r["c"] for r in own if r["level"] == 1)
        left[level] = min(0.999, max(0.001, once / sum(r["n"] for r in own)))
    left[0] = 1.0
    slices, width, fits = filter_shape(entries, max_bytes)
    pair_filter = build_filter(pairs.select("key", "level"), slices, width) if fits else None
    head = counted.where(F.col("n") * HEAD > tokens).select("key", "n").toArrow()
    key, n = head.column("key").to_numpy().view(np.uint64), head.column("n").to_numpy()
    order = np.argsort(key)
    return Model(tokens, distinct, words, pair_filter, total, left, key[order], n[order],
                 counted.select("key", "n"), pairs.select("key", "level"))


_SCORED = ("uid bigint, id bigint, n_tokens bigint, head_known bigint, head_base double, part double, "
           "tail array<bigint>, open array<struct<key:bigint,context:int,low:double>>")


def _score_chunk(first: int, ids: list[int | None], docs: list[np.ndarray], shared: tuple) -> pa.RecordBatch:
    tokens, distinct, words, pairs, total, left, head_key, head_count = shared
    lengths = np.array([len(d) for d in docs])
    begins = np.cumsum(lengths) - lengths
    every = np.concatenate(docs)
    known, place = np.unique(every, return_inverse=True)
    at = np.minimum(np.searchsorted(head_key, known), max(0, len(head_key) - 1))
    in_head = head_key[at] == known if len(head_key) else np.zeros(len(known), dtype=bool)
    base = np.where(in_head, np.log10((head_count[at] + 1.0) / (tokens + distinct + 1.0)) if len(head_key) else 0.0, 0.0)
    level = words.read(known)
    alone = (READ[level] + 1) / total if tokens else np.ones(len(known))
    context, pair = map(np.concatenate, zip(*map(_pairs, docs), strict=True))
    start_level = int(words.read(np.array([START]))[0])
    context_level = np.concatenate(([start_level], level[place[:-1]]))
    context_level[begins] = start_level
    low = left[context_level] * alone[place]
    if pairs is not None:
        most = MOST[context_level]
        high = (1 - left[context_level]) * np.minimum(LEAST[pairs.read(pair)], most) / most
        part, opened = np.add.reduceat(np.log10(low + high), begins), [None] * len(docs)
    else:
        part = np.zeros(len(docs))
        opened = [[{"key": k, "context": c, "low": x} for k, c, x in zip(
            pair[a:a + n].view(np.int64).tolist(), context_level[a:a + n].tolist(), low[a:a + n].tolist(), strict=True)]
            for a, n in zip(begins, lengths, strict=True)]
    tails = every.view(np.int64)
    outside = ~in_head[place]
    return pa.RecordBatch.from_arrays([
        pa.array(np.arange(first, first + len(ids))), pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()),
        pa.array(np.add.reduceat((~outside).astype(np.int64), begins)),
        pa.array(np.add.reduceat(base[place], begins)), pa.array(part),
        pa.array([tails[a:a + n][outside[a:a + n]] for a, n in zip(begins, lengths, strict=True)], pa.list_(pa.int64())),
        pa.array(opened, pa.list_(pa.struct([("key", pa.int64()), ("context", pa.int32()), ("low", pa.float64())])))],
        names=["uid", "id", "n_tokens", "head_known", "head_base", "part", "tail", "open"])


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs` its id, n_tokens, n_known, train_tokens, base_score and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model.shared())
    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40  # rows are told apart by task and place
        for whole in slices(batches, 4 * ROWS):
            ids, held, n = [], [], 0
            for id_, value in zip(whole.column("id").to_pylist(), whole.column("text"), strict=True):
                ids.append(id_)
                held.append(_tokens(value.as_py()))
                n += len(held[-1])
                if n >= SCORED_TOKENS:
                    yield _score_chunk(first, ids, held, shared.value)
                    first, ids, held, n = first + len(ids), [], [], 0
            if held:
                yield _score_chunk(first, ids, held, shared.value)
                first += len(ids)

    scored = saved(map_batches(rows, run, _SCORED), "scored")
    result = scored.select("uid", "id", "n_tokens", "head_known", "head_base", "part")
    constant = float(model.tokens + model.distinct + 1)
    tail = scored.select("uid", F.explode("tail").alias("key")).groupBy("uid", "key").agg(F.count("*").alias("k"))
    tail = tail.join(model.word_counts, "key", "left").groupBy("uid").agg(
        F.sum(F.col("k") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(constant))).alias("tail_base"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("tail_known"))
    result = result.join(tail, "uid", "left")
    if model.pairs is None:
        left, most, least = (F.array(*[F.lit(float(x)) for x in xs]) for xs in (model.left, MOST, LEAST))
        room = F.get(most, F.col("p.context"))
        high = (1 - F.get(left, F.col("p.context"))) * F.least(F.get(least, F.coalesce("level", F.lit(0))), room) / room
        opened = scored.select("uid", F.explode("open").alias("p")).join(
            model.pair_levels, F.col("p.key") == F.col("key"), "left").groupBy("uid").agg(
            F.sum(F.log10(F.col("p.low") + high)).alias("joined"))
        result = result.join(opened, "uid", "left").withColumn("part", F.coalesce("joined", F.lit(0.0)))
    zero = F.lit(0)
    return result.select(
        F.col("id").alias(id_column), "n_tokens", (F.col("head_known") + F.coalesce("tail_known", zero)).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("tail_base", zero)).alias("base_score"), F.col("part").alias("score"))

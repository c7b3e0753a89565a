"""Exact removal of word passages that an earlier document holds: seed and extend.

Seeds. Each document is cut to anchors: in every window of `min_words` words the smallest hash of its
word runs of about half that length (winnowing). Two documents that share a window share its anchor,
so nothing is missed. Anchors that only one document holds are dropped at once.

Links. Each other occurrence of an anchor is linked to its first one (smallest id), so a group of n
holders has n - 1 links, not n^2 pairs. Links of one pair of documents along one diagonal are one.

Extension. Both sides are laid along the diagonal and compared outward from the anchors; runs of at
least `min_words` equal words are maximal repeats. Where the first holder has the smaller id, they go.

Rest. A window whose anchor is shared but which its anchor's first holder does not hold may still
stand in another document. Whether it is in this rest depends on the window's words alone, so all its
occurrences are: they are grouped by hash, and those with a smaller id elsewhere go. This makes the
result exact. A document names each such window once, with the words that all its places cover: a text
that repeats a few words has a handful of windows, however long it is. Words and windows are compared
by 64-bit hashes.

Documents without an id, or with fewer than `min_words` words (null and empty texts have none), are
kept as they are. Repeats inside one document, and between rows of equal id, are kept: only a smaller
id counts. Equal rows are treated alike. Columns of the input pass through; result columns replace
input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillrank.llm.tables import BROADCAST_KEYS, flagged, fresh, saved
from rillrank.llm.tasks import map_batches, slices
from rillrank.llm.words import covered, text_hashes, window_hashes, words

MIN_WORDS = 50
PLACES = 1 << 24
RESULT = ["kept_text", "n_words", "n_removed", "removed"]
_SPANS = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))


def winnow(hashes: np.ndarray, min_words: int) -> np.ndarray:
    """For each window of `min_words` words, where its anchor begins.

    Anchors are compared by 40 bits, and the leftmost of equals is taken: hash and place share a number,
    whose minimum over a window comes from the minima over its halves.
    """
    size = min_words // 2
    grams = window_hashes(hashes, size)
    width = min_words - size + 1
    n = len(grams) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    if len(grams) > PLACES:  # places would repeat; a stretch holds the next one's first windows
        half = PLACES // 2
        return np.concatenate([i + winnow(hashes[i:i + half + min_words - 1], min_words) for i in range(0, n, half)])
    low, length = np.uint64(PLACES - 1), 1
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    while 2 * length <= width:
        least, length = np.minimum(least[:-length], least[length:]), 2 * length
    if length < width:
        least = np.minimum(least[:n], least[width - length:width - length + n])
    return (least[:n] & low).astype(np.int64)


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _anchors(rows: DataFrame, min_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            anchors, docs, rids, places = [], [], [], []
            for doc, rid, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "rid", "text")), strict=True):
                hashes = text_hashes(text)
                place = np.unique(winnow(hashes, min_words))
                if len(place):
                    anchors.append(window_hashes(hashes, min_words // 2)[place].view(np.int64))
                    docs.append(np.full(len(place), doc))
                    rids.append(np.full(len(place), rid))
                    places.append(place)
            if anchors:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (anchors, docs, rids, places)],
                    names=["anchor", "doc", "rid", "pos"])

    return map_batches(rows, run, "anchor bigint, doc bigint, rid bigint, pos bigint")


def _segments(links: DataFrame, texts: DataFrame, min_words: int) -> DataFrame:
    """Each link with the first holder's words around the linked anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_rid, cut = None, []
        for batch in slices(batches, 64):
            begin, parts = [], []
            for rid, text, diagonal, low, high in zip(*(batch.column(c).to_pylist() for c in
                                                        ("first_rid", "text", "diagonal", "low", "high")), strict=True):
                if rid != last_rid:
                    last_rid, cut = rid, words(text)
                a = max(0, low - diagonal - min_words)
                begin.append(a)
                parts.append(b" ".join(cut[a:high - diagonal + 2 * min_words]).decode())
            keep = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(begin, pa.int64()),
                                              pa.array(parts, pa.string())], names=[*keep, "begin", "segment"])

    joined = links.join(texts.select(F.col("rid").alias("first_rid"), "text"), "first_rid")
    schema = T.StructType([f for f in joined.schema.fields if f.name != "text"]
                          + [T.StructField("begin", T.LongType()), T.StructField("segment", T.StringType())])
    return map_batches(joined, run, schema)


def _along(hashes: np.ndarray, other: np.ndarray, shift: int, min_words: int) -> np.ndarray:
    """Which windows of `hashes` equal those of `other`, whose first word lies at `shift`."""
    n = len(hashes)
    equal = np.zeros(n, dtype=bool)
    a, b = max(0, shift), min(n, shift + len(other))
    if a < b:
        equal[a:b] = hashes[a:b] == other[a - shift:b - shift]
    total = np.concatenate(([0], np.cumsum(equal)))
    return total[min_words:] - total[:-min_words] == min_words


def _places(keys: np.ndarray, starts: np.ndarray, min_words: int) -> tuple[np.ndarray, ...]:
    """Each distinct window once: its hash, how many stretches of words its places cover, and all stretches'
    begins and ends. `starts` ascend."""
    order = np.argsort(keys, kind="stable")
    keys, starts = keys[order], starts[order]
    other = np.diff(keys, prepend=0) != 0
    other[:1] = True
    apart = other | (np.diff(starts, prepend=0) > min_words)
    first = np.flatnonzero(apart)
    ends = starts[np.append(first[1:], len(starts)) - 1] + min_words if len(first) else starts
    return keys[other], np.diff(np.flatnonzero(np.append(other[first], True))), starts[first], ends


def _extend(doc: int, rid: int, text: str, links: list[dict], min_words: int):
    """Covered runs, and the places of windows their anchors' first holders do not hold."""
    hashes = text_hashes(text)
    anchor, n = winnow(hashes, min_words), len(hashes)
    remove, rest = np.zeros(len(anchor), dtype=bool), np.zeros(len(anchor), dtype=bool)
    for link in links:
        if link["segment"] is None:
            other, shift = hashes, link["diagonal"]
        else:
            other, shift = text_hashes(link["segment"]), link["begin"] + link["diagonal"]
        equal = _along(hashes, other, shift, min_words)
        if link["first_doc"] < doc:
            remove |= equal
        rest |= np.isin(anchor, link["places"]) & ~equal
    left = np.flatnonzero(rest)
    return (runs(covered(np.flatnonzero(remove), min_words, n)),
            _places(window_hashes(hashes, min_words)[left].view(np.int64), left, min_words))


def _extended(linked: DataFrame, min_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            docs, rids, spans, places = [], [], [], []
            for x in batch.to_pylist():
                cover, found = _extend(x["doc"], x["rid"], x["text"], x["links"], min_words)
                docs.append(x["doc"])
                rids.append(x["rid"])
                spans.append([{"begin": a, "end": b} for a, b in cover])
                places.append(found)
            if not places:
                continue
            keys, counts, begins, ends = (np.concatenate(x) for x in zip(*places, strict=True))
            of_rows = np.cumsum([0, *(len(p[0]) for p in places)]).astype(np.int32)
            of_keys = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            stretches = pa.StructArray.from_arrays([pa.array(begins), pa.array(ends)], names=["begin", "end"])
            yield pa.RecordBatch.from_arrays([
                pa.array(docs, pa.int64()), pa.array(rids, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                pa.ListArray.from_arrays(of_rows, pa.array(keys)),
                pa.ListArray.from_arrays(of_rows, pa.ListArray.from_arrays(of_keys, stretches))],
                names=["doc", "rid", "spans", "keys", "places"])

    return map_batches(linked, run, "doc bigint, rid bigint, spans array<struct<begin:bigint,end:bigint>>, "
                                  "keys array<bigint>, places array<array<struct<begin:bigint,end:bigint>>>")


def repeats(docs: DataFrame, id_column: str, text: str, min_words: int = MIN_WORDS,
            broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """rid (a hash of id and text) and `spans` of words to remove, of each document that has any."""
    rows = docs.where(F.col(f"`{id_column}`").isNotNull() & F.col(f"`{text}`").isNotNull()).select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc"), _rid(id_column, text).alias("rid"),
        F.col(f"`{text}`").alias("text"))
    anchors = saved(_anchors(rows, min_words), "anchors")
    first = anchors.groupBy("anchor").agg(F.min(F.struct("doc", "rid", "pos")).alias("first"),
                                          F.max("doc").alias("last"))
    shared = saved(first.where(F.col("first.doc") < F.col("last")).select(
        "anchor", F.col("first.doc").alias("first_doc"), F.col("first.rid").alias("first_rid"),
        F.col("first.pos").alias("first_pos")), "shared-anchors")
    others = anchors.join(shared, "anchor").where(
        (F.col("rid") != F.col("first_rid")) | (F.col("pos") != F.col("first_pos")))
    links = saved(others.groupBy("doc", "rid", "first_doc", "first_rid",
                                 (F.col("pos") - F.col("first_pos")).alias("diagonal"))
                  .agg(F.collect_set("pos").alias("places"), F.min("pos").alias("low"), F.max("pos").alias("high")),
                  "links")
    involved = links.select("rid").union(links.select("first_rid")).distinct()
    texts = saved(flagged(rows, involved, "rid", "wanted", broadcast_keys).where("wanted")
                  .select("rid", "text").dropDuplicates(["rid"]), "linked-texts")
    within = F.col("rid") == F.col("first_rid")
    from_others = _segments(links.where(~within), texts, min_words)
    in_itself = links.where(within).withColumn("begin", F.lit(0).cast("bigint")).withColumn(
        "segment", F.lit(None).cast("string"))
    held = from_others.unionByName(in_itself).groupBy("doc", "rid").agg(
        F.collect_list(F.struct("first_doc", "diagonal", "places", "begin", "segment")).alias("links"))
    extended = saved(_extended(held.join(texts, "rid").select("doc", "rid", "text", "links"), min_words), "extended")
    rest = extended.select("doc", "rid", F.explode(F.arrays_zip("keys", "places")).alias("w")).select(
        "doc", "rid", F.col("w.keys").alias("key"), F.col("w.places").alias("places"))
    earliest = saved(rest.groupBy("key").agg(F.min("doc").alias("least"), F.max("doc").alias("last"))
                     .where(F.col("least") < F.col("last")).select("key", "least"), "rest-windows")
    late = rest.join(earliest, "key").where(F.col("least") < F.col("doc")).select("rid", F.explode("places").alias("s"))
    spans = extended.select("rid", F.explode("spans").alias("s")).union(late).select("rid", "s.begin", "s.end")
    return saved(spans.groupBy("rid").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans")),
                 "spans")


def _rid(id_column: str, text: str):
    return F.xxhash64(F.col(f"`{id_column}`").cast("bigint"), F.col(f"`{text}`"))


def _cut(rows: DataFrame, text: str, names: list[str], listed: str) -> DataFrame:
    fields = [f for f in rows.schema.fields if f.name in names]
    schema = T.StructType([*fields, T.StructField("kept_text", T.StringType()), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("removed", _SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spans_of = batch.column(listed).to_pylist()
            kept, total, gone, removed = [], [], [], []
            for value, spans in zip(batch.column(text).to_pylist(), spans_of, strict=True):
                parts = words(value)
                mask = np.zeros(len(parts), dtype=bool)
                for s in spans or ():
                    mask[s["begin"]:s["end"]] = True
                cut = runs(mask) if spans else []
                kept.append(b" ".join(p for p, m in zip(parts, mask.tolist(), strict=True) if not m)
                            if spans else b" ".join(parts))
                total.append(len(parts))
                gone.append(int(mask.sum()))
                removed.append([{"begin": a, "end": b} for a, b in cut])
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in names], pa.array([k.decode() for k in kept], pa.string()),
                pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                pa.array(removed, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))],
                names=[*names, *RESULT])

    return map_batches(rows, run, schema)


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
                   broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """`docs` with kept_text (kept words joined by one space), n_words, n_removed and removed (spans of words)."""
    results = {c.lower() for c in RESULT}
    names = [c for c in docs.columns if c.lower() not in results or c in (id_column, text)]
    spans = repeats(docs, id_column, text, min_words, broadcast_keys)
    row, cut, listed = fresh(docs.columns, "rid", "cut", "spans")
    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.when(
        F.col(f"`{id_column}`").isNotNull(), _rid(id_column, text)).alias(row))
    split = flagged(rows, spans.select(F.col("rid").alias(row)), row, cut, broadcast_keys)
    whole = split.where(~F.col(cut)).withColumn(listed, F.lit(None).cast(_SPANS))
    parts = split.where(F.col(cut)).join(spans.select(F.col("rid").alias(row), F.col("spans").alias(listed)), row)
    columns = [*[F.col(f"`{c}`") for c in names], F.col(listed)]
    return _cut(whole.select(*columns).unionByName(parts.select(*columns)), text, names, listed)

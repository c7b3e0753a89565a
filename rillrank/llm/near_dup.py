"""Near-duplicate documents by HyperMinHash.

Sketch. Each of BANDS * ROWS buckets has its own hash of a document's word shingles and keeps only the
smallest value's count of leading zeros and MANTISSA bits after the first one: 16 bits in all. A hash
of its own for each bucket, rather than a share of the shingles, keeps sketches of short texts whole.

Candidates. Documents with equal shingle sets are one class. Classes that agree in all registers of a
band meet in a bucket; each is linked to the bucket's smallest, so a bucket of n gives n - 1 links.
Their connected components are clusters that no link between documents can leave (but for a chance of
1e-6 for a pair right at 0.85).

Links. A cluster is dealt into blocks of at most BLOCK_DOCS documents and BLOCK_BYTES, and each pair
of blocks is one small task: registers that agree, corrected for chance collisions, estimate the
similarity; pairs that may reach the threshold are verified on their full shingle sets, likeliest
first, unless links found before already join them. So a task gives fewer links than it has documents,
all pairs of a cluster are looked at, and no pair is ever a row.

Null texts and texts without words have no shingles and are linked with nothing, as are rows without
an id, whose component is null and which are kept. Texts with fewer words than a shingle are one
shingle. Rows of equal id are judged each by its text. An empty table gives no rows. Other columns
of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillrank.llm.graph import components
from rillrank.llm.tables import BROADCAST_KEYS, flagged, fresh, saved
from rillrank.llm.tasks import map_batches, slices
from rillrank.llm.words import text_hashes, window_hashes

SHINGLE = 5
BANDS, ROWS = 36, 7
BUCKETS = BANDS * ROWS
MANTISSA = 10
BLOCK_DOCS, BLOCK_BYTES = 64, 8 << 20
#: How far below the threshold an estimate may lie: more than five deviations.
MARGIN = 0.13
SEED = 20240229

_RNG = np.random.Generator(np.random.PCG64(SEED))
_TIMES = _RNG.integers(0, 1 << 63, BUCKETS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RNG.integers(0, 1 << 63, BUCKETS, dtype=np.uint64) * np.uint64(2)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words."""
    hashes = text_hashes(text, lower=True)
    n = len(hashes)
    if n >= size:
        return np.unique(window_hashes(hashes, size))
    return window_hashes(hashes, n) + np.uint64(n) if n else hashes


def registers(values: np.ndarray) -> np.ndarray:
    """One 16-bit register per bucket: leading zeros, then mantissa, of the bucket's smallest hash."""
    least = np.full(BUCKETS, np.iinfo(np.uint64).max)
    for at in range(0, len(values), 512):
        np.minimum(least, (values[at:at + 512, None] * _TIMES + _PLUS).min(axis=0), out=least)
    bits = least.astype(np.float64).view(np.uint64)
    zeros = np.uint64(1087) - (bits >> np.uint64(52))
    return ((zeros << np.uint64(MANTISSA)) | ((bits >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1))
            ).astype("<u2")


@cache
def chance(size_bits: int) -> float:
    """How likely two disjoint sets of 2^size_bits shingles agree in a register."""
    steps = 1 + np.arange((1 << MANTISSA) + 1) / (1 << MANTISSA)
    n, total = 2.0 ** size_bits, 0.0
    for zeros in range(1, 64):
        edge = np.exp(-n * steps * 2.0 ** -zeros)
        total += float(((edge[:-1] - edge[1:]) ** 2).sum())
    return total


def estimate(agreeing: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of registers that agree, less what agrees by chance."""
    by_chance = np.array([chance(int(s)) for s in np.log2(np.maximum(sizes, 1)).round().ravel()]).reshape(sizes.shape)
    return (agreeing - by_chance) / (1 - by_chance)


def _sketches(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, prints, sketches = [], [], []
            for text in batch.column("text"):
                values = shingles(text.as_py())
                counts.append(len(values))
                prints.append(_print(values.tobytes()))
                sketches.append(registers(values).tobytes() if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("rid"), pa.array(counts, pa.int64()), pa.array(prints, pa.int64()),
                 pa.array(sketches, pa.binary())], names=["doc", "rid", "n", "print", "sketch"])

    return map_batches(rows, run, "doc bigint, rid bigint, n bigint, print bigint, sketch binary")


def _print(values: bytes) -> int:
    return xxhash.xxh3_64_intdigest(values) - (1 << 63)


#: A class of equal sets: the smallest id that has it, and the set's print, which tells rows of one id apart.
NODE = "struct<doc:bigint,print:bigint>"
_NODE = pa.struct([("doc", pa.int64()), ("print", pa.int64())])


def _nodes(docs: list[int], prints: list[int]) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(docs, pa.int64()), pa.array(prints, pa.int64())], fields=list(_NODE))


def _sets(rows: DataFrame) -> DataFrame:
    """(doc, set, bytes), where doc is the node of the row's set: one row per node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles(x.as_py()).tobytes() for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [_nodes(batch.column("doc").to_pylist(), [_print(s) for s in sets]), pa.array(sets, pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64())], names=["doc", "set", "bytes"])

    return map_batches(rows.select("doc", "text"), run, f"doc {NODE}, set binary, bytes bigint").dropDuplicates(["doc"])


def candidates(classes: DataFrame) -> DataFrame:
    """(doc, hub): each class of a shared bucket with the bucket's smallest."""
    width = 2 * ROWS
    keys = [F.xxhash64(F.lit(b), F.substring("sketch", b * width + 1, width)) for b in range(BANDS)]
    banded = classes.select("doc", F.explode(F.array(*keys)).alias("key"))
    hubs = saved(banded.groupBy("key").agg(F.min("doc").alias("hub"), F.max("doc").alias("last"))
                 .where(F.col("hub") < F.col("last")).select("key", "hub"), "buckets")
    return saved(banded.join(hubs, "key").where(F.col("doc") != F.col("hub")).select("doc", "hub").distinct(),
                 "candidates")


class _Joined:
    """Union-find over a task's documents."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i


def block_links(docs: list[tuple], blocks: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple]:
    """Links that join the documents of one block, or of two blocks, as far as links between them do."""
    sizes = np.array([len(s) for s in sets], float)
    sketch = np.stack([registers(s) for s in sets])
    across = len(set(blocks.tolist())) > 1
    likely: list[tuple[float, int, int]] = []
    for i in range(len(docs) - 1):
        others = np.arange(i + 1, len(docs))
        if across:
            others = others[blocks[others] != blocks[i]]
        small, big = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        others = others[100 * small >= percent * big]
        if len(others):
            agreeing = (sketch[others] == sketch[i]).mean(axis=1)
            guess = estimate(agreeing, np.sqrt(sizes[others] * sizes[i]))
            likely += [(g, i, j) for g, j in zip(guess.tolist(), others.tolist(), strict=True)
                       if g >= percent / 100 - MARGIN]
    joined, links = _Joined(len(docs)), []
    for _, i, j in sorted(likely, key=lambda x: (-x[0], x[1], x[2])):
        a, b = joined.root(i), joined.root(j)
        if a != b:
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * common >= percent * (sizes[i] + sizes[j] - common):
                joined.up[a] = b
                links.append((docs[i], docs[j]))
    return links


def verified_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) links that join each cluster's documents. members: doc, root (its cluster)."""
    totals = members.join(sets.select("doc", "bytes"), "doc").groupBy("root").agg(
        F.count("*").alias("docs"), F.sum("bytes").alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    totals = saved(totals.where(F.col("docs") > 1).select("root", blocks.alias("blocks")), "cluster-blocks")
    dealt = members.join(totals, "root").withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = dealt.select("root", "doc", "block", others).select(
        "root", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "doc", "block")

    def link(table: pa.Table) -> pa.Table:
        docs = [(x["doc"], x["print"]) for x in table.column("doc").to_pylist()]
        sets = [np.frombuffer(s, np.uint64) for s in table.column("set").to_pylist()]
        order = sorted(range(len(docs)), key=docs.__getitem__)
        found = block_links([docs[i] for i in order], table.column("block").to_numpy()[order],
                            [sets[i] for i in order], percent) if len(docs) > 1 else []
        return pa.table({"a": _nodes([a[0] for a, _ in found], [a[1] for a, _ in found]),
                         "b": _nodes([b[0] for _, b in found], [b[1] for _, b in found])})

    held = paired.join(sets.select("doc", "set"), "doc")
    return held.groupBy("root", "x", "y").applyInArrow(link, f"a {NODE}, b {NODE}")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = 85,
                    broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """Per row of `docs` its id, n_shingles, component_id (smallest id reachable by links) and kept (its own)."""
    if not 80 <= percent <= 100:
        raise ValueError("the bands are set for similarities of 0.8 and above")
    return _judged(docs, id_column, text, percent, broadcast_keys).select(
        F.col("doc").alias(id_column), "n_shingles", "component_id", "kept")


def _rid(id_column: str, text: str):
    """A row's own key: ids may repeat."""
    return F.xxhash64(F.col(f"`{id_column}`").cast("bigint"), F.col(f"`{text}`"))


def _judged(docs: DataFrame, id_column: str, text: str, percent: int, broadcast_keys: int) -> DataFrame:
    """doc, rid, n_shingles, component_id and kept of each row. Classes of equal sets are the nodes of all graphs, by
    the set's print, so rows that share an id do not share links."""
    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc"), _rid(id_column, text).alias("rid"),
                       F.col(f"`{text}`").alias("text"))
    sketches = saved(_sketches(rows), "sketches")
    linkable = sketches.where(F.col("doc").isNotNull() & (F.col("n") > 0))
    classes = linkable.groupBy("print", "n").agg(F.min(F.struct("doc", "sketch")).alias("first"), F.max("doc").alias("last"))
    classes = saved(classes.select(F.struct("first.doc", "print").alias("doc"), "n", "first.sketch", "last"), "classes")
    clusters = saved(components(candidates(classes), "doc", "hub").withColumnRenamed("node", "doc"), "clusters")
    chosen = flagged(rows, clusters.select("doc.doc").distinct(), "doc", "wanted", broadcast_keys).where("wanted")
    sets = saved(_sets(chosen), "sets")
    links = saved(verified_links(clusters, sets, percent), "links")
    roots = components(links).withColumnRenamed("node", "doc")
    # The least node of a component has its least id.
    labels = classes.select("n", "doc", "last").join(roots, "doc", "left").select(
        F.col("doc.print").alias("_print"), F.col("n").alias("_n"), F.coalesce("root", "doc")["doc"].alias("root"),
        (F.col("root").isNotNull() | (F.col("last") > F.col("doc.doc"))).alias("_grouped"))
    labels = saved(labels.where("_grouped").drop("_grouped"), "labels")
    out = sketches.join(labels, (F.col("print") == F.col("_print")) & (F.col("n") == F.col("_n")), "left")
    component = F.when(F.col("n") > 0, F.coalesce("root", "doc")).otherwise(F.col("doc"))
    component = F.when(F.col("doc").isNotNull(), component)
    return out.select("doc", "rid", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = 85,
               broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """`docs` without rows that have a component's smaller id; of rows of equal id and text one stays. Rows without
    an id stay. Columns as given."""
    if not 80 <= percent <= 100:
        raise ValueError("the bands are set for similarities of 0.8 and above")
    judged = saved(_judged(docs, id_column, text, percent, broadcast_keys).where("doc IS NOT NULL"), "judged")
    row, gone, twice = fresh(docs.columns, "rid", "gone", "twice")
    dropped = judged.where(~F.col("kept")).select(F.col("rid").alias(row)).distinct()
    repeated = judged.where("kept").groupBy(F.col("rid").alias(row)).count().where("count > 1").select(row)
    keyed = docs.withColumn(row, F.when(F.col(f"`{id_column}`").isNotNull(), _rid(id_column, text)))
    left = flagged(keyed, dropped, row, gone, broadcast_keys).where(~F.col(gone))
    marked = flagged(left, repeated, row, twice, broadcast_keys)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one_each = marked.where(F.col(twice)).dropDuplicates([row])
    return marked.where(~F.col(twice)).select(*columns).union(one_each.select(*columns))

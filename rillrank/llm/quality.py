"""Quality rules by repetition coverage.

`repetition` adds measures of every whole text: how many of its characters lie inside word n-grams
that occur at least twice (several lengths, by rolling hashes), and inside lines seen before.
`quality_verdict` applies the limits. Both are per row: no shuffle, one text in memory at a time.

Null and empty texts have no words: all counts and shares are 0, and the verdict is to drop them.
Repeated rows are judged alike. Input columns other than the text pass through; measure columns
replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillrank.llm.tasks import map_batches, slices
from rillrank.llm.words import SPACES, covered, repeated, text_hashes, window_hashes

#: The largest share of characters inside repeated n-grams, by n. The first occurrence counts too, so
#: one heading that stands twice in a short text stays well below.
NGRAM_LIMITS = {5: 0.40, 6: 0.38, 7: 0.36, 8: 0.34, 9: 0.32, 10: 0.30}
#: The largest share of characters inside lines seen before.
LINE_LIMIT = 0.3
#: The base rule.
MIN_WORDS, BASE_WINDOW, BASE_PERCENT = 20, 8, 30
SYMBOLS = "#*$%&|<>"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]
GRAM_COLUMNS = [f"dup_{n}gram_chars" for n in NGRAM_LIMITS]


def measure(text: str | None) -> list[int]:
    """COUNTS, then GRAM_COLUMNS, of one text."""
    hashes = text_hashes(text)
    n = len(hashes)
    if not n:
        return [0, 0, sum(map((text or "").count, SYMBOLS)), 0, 0, 0] + [0] * len(GRAM_COLUMNS)
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    inside = ~SPACES[raw]
    begins = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    chars = np.add.reduceat((inside & ((raw & 0xC0) != 0x80)).astype(np.int64), begins)
    lines = [x for x in text.split("\n") if x.strip("\t\x0b\x0c\r ")]
    seen: set[str] = set()
    line_chars = 0
    for line in lines:
        if line in seen:
            line_chars += sum(map(len, line.translate(_NO_SPACES).split()))
        seen.add(line)
    grams, base = [], 0
    # A repeated n-gram begins with a repeated shorter one, so each length looks only at those.
    starts = np.arange(n)
    for size in NGRAM_LIMITS:
        grown = window_hashes(hashes, size) if len(starts) else np.empty(0, np.uint64)
        starts = starts[starts < len(grown)]
        starts = starts[repeated(grown[starts])]
        in_repeat = covered(starts, size, n) if len(starts) else np.zeros(n, dtype=bool)
        grams.append(int(chars[in_repeat].sum()))
        if size == BASE_WINDOW:
            base = int(in_repeat.sum())
    return [n, int(chars.sum()), sum(map(text.count, SYMBOLS)), len(lines) - len(seen), base, line_chars, *grams]


_NO_SPACES = {ord(c): None for c in "\t\x0b\x0c\r "}


def repetition(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with COUNTS and GRAM_COLUMNS as BIGINT columns."""
    names = [*COUNTS, *GRAM_COLUMNS]
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names or c == text])
    schema = T.StructType([*kept.schema.fields, *[T.StructField(c, T.LongType()) for c in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [measure(x) for x in batch.column(text).to_pylist()]
            cells = np.array(rows, np.int64).reshape(len(rows), len(names)).T
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, cells)],
                                             names=[*batch.schema.names, *names])

    return map_batches(kept, run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > BASE_PERCENT * F.col("n_words"))


def method_keeps() -> Column:
    """No n-gram length and no repeated lines cover more of the text's characters than allowed."""
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    keep = F.col("dup_line_chars") <= LINE_LIMIT * chars
    for column, limit in zip(GRAM_COLUMNS, NGRAM_LIMITS.values(), strict=True):
        keep = keep & (F.col(column) <= limit * chars)
    return keep


def quality_verdict(docs: DataFrame, text: str = "text") -> DataFrame:
    """`repetition` with base_failed and kept."""
    return (repetition(docs, text).withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & method_keeps()))

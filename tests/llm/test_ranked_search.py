"""Ranked search against scores of every document, shard by shard and over odd tables."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from rillrank.llm import oracle, ranked_search
from tests.check import connect, normal
from tests.llm.texts import ODD, documents, frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, k=10):
    held = [(i, collections.Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(c.total() for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc_id, counts in held:
            m = 100 - 75 + (75 * counts.total() * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * counts[t]) // (1000 * counts[t] + 8 * m))
                        for t in terms(text) if counts[t])
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return collections.Counter(out)


def found(index, queries, k=10):
    got = ranked_search.search(index, queries, "item_id", "text", k).collect()
    return collections.Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string").repartition(2)


ITEMS = [(1, "w1 w2 w3 w3 the The THE"), (2, "Ünï çé ÜNÏ w399"), (3, "nothing-of-it zzz"), (4, None), (5, ""), (6, "x x x x"),
         (7, " ".join(f"w{i}" for i in range(150))), (7, "w5 w6"), (None, "w7")]


@pytest.mark.parametrize("shard_docs, shard_postings, block, window", [(1 << 15, 1 << 21, 128, 1 << 12), (7, 1 << 21, 2, 3),
                                                                       (1 << 15, 300, 5, 16), (50, 1 << 21, 3, 8)])
def test_against_all_scores(spark, shard_docs, shard_postings, block, window):
    given = documents(120, seed=4) + ODD
    index = ranked_search.build(frame(spark, given), "doc_id", "text", shard_docs, shard_postings, block)
    rows = index.postings.toArrow()
    assert found_here(rows, index, ITEMS, window) == brute([(r[0], r[1]) for r in given], ITEMS)


def found_here(rows, index, items, window, k=10):
    """The search's steps without Spark, in windows of a given size."""
    best = collections.defaultdict(list)
    df = collections.Counter()
    for r in rows.select(["term", "df"]).to_pylist():
        df[r["term"]] += r["df"]
    for shard in rows["shard"].unique().to_pylist():
        of = {r["term"]: r for r in rows.filter(pc.equal(rows["shard"], shard)).to_pylist()}
        own = of.pop(b"")
        ids, none = np.frombuffer(own["lasts"], np.int64), np.frombuffer(own["sizes"], bool)
        m = ranked_search.slow_down(np.frombuffer(own["tops"], np.int64), index.docs, index.terms)
        for q, (_, text) in enumerate(items):
            lists = [(n * math.floor(1000 * math.log((2 * index.docs + 2) / (2 * df[t] + 1))),
                      ranked_search._Postings(of[t]["top"], of[t]["lasts"], of[t]["tops"], of[t]["sizes"], of[t]["payload"], of[t]["df"], m, own["top"]))
                     for t, n in ranked_search.term_counts((text or "").encode()).items() if t in of]
            docs, scores = ranked_search.best_of_shard([x for x in lists if x[0] > 0], len(ids), k, window)
            best[q] += [(-s, bool(none[d]), int(ids[d])) for d, s in zip(docs.tolist(), scores.tolist())]
    return collections.Counter((items[q][0], r, None if none else i, -s)
                               for q, of in best.items() for r, (s, none, i) in enumerate(sorted(of)[:k], 1))


def test_the_whole_search(spark, monkeypatch):
    given = documents(90, seed=9) + ODD
    index = ranked_search.build(frame(spark, given), "doc_id", "text", shard_docs=20)
    want = brute([(r[0], r[1]) for r in given], ITEMS)
    assert found(index, items_of(spark, ITEMS)) == want
    # One query per block gives the same.
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 1)
    assert found(index, items_of(spark, ITEMS)) == want
    assert found(index, items_of(spark, ITEMS), k=3) == brute([(r[0], r[1]) for r in given], ITEMS, 3)


def test_sql_agrees(spark, tmp_path):
    frame(spark, documents(60, seed=2) + [r for r in ODD if r[0] is not None]).drop("score").write.parquet(str(tmp_path / "documents.parquet"))
    items_of(spark, ITEMS[:-1]).write.parquet(str(tmp_path / "benchmark.parquet"))
    con = connect(str(tmp_path / "none"))
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    index = ranked_search.build(spark.read.parquet(str(tmp_path / "documents.parquet")), "doc_id", "text")
    got = ranked_search.search(index, spark.read.parquet(str(tmp_path / "benchmark.parquet")), "item_id", "text")
    assert normal(got.toPandas()) == normal(con.sql(oracle.SQL["op11_ranked_search"]).df())


def test_ties_go_by_the_smaller_id(spark):
    given = [(i, "same words here", None, None, None, None) for i in range(40, 0, -1)] + [(99, "other", None, None, None, None)] * 60
    index = ranked_search.build(frame(spark, given), "doc_id", "text", shard_docs=9)
    got = ranked_search.search(index, items_of(spark, [(1, "words")]), "item_id", "text").orderBy("rank").collect()
    assert [(r["rank"], r.doc_id) for r in got] == [(i, i) for i in range(1, 11)]


def test_rejected_blocks_stay_closed():
    """A list that cannot lift a document is read only where candidates are."""
    n = 4096
    m = np.full(n, 25)
    docs = np.arange(n, dtype=np.int32)

    def postings(docs, tf):
        shard = ranked_search._Shard()
        rows = [ranked_search.gains(tf, m[docs])[i:i + ranked_search.BLOCK] for i in range(0, len(docs), ranked_search.BLOCK)]
        packed, before = [], 0
        for i in range(0, len(docs), ranked_search.BLOCK):
            part = docs[i:i + ranked_search.BLOCK]
            steps = np.diff(part, prepend=np.int32(before))
            packed.append(ranked_search.zstandard.ZstdCompressor().compress(steps.tobytes() + tf[i:i + ranked_search.BLOCK].tobytes()))
            before = part[-1]
        lasts = docs[[min(i + ranked_search.BLOCK, len(docs)) - 1 for i in range(0, len(docs), ranked_search.BLOCK)]]
        tops = np.array([r.max() for r in rows], np.int32)
        assert not shard.ids
        return ranked_search._Postings(int(tops.max()), lasts.tobytes(), tops.tobytes(),
                                       np.array([len(p) for p in packed], np.int32).tobytes(), b"".join(packed), len(docs), m)

    common = postings(docs, np.ones(n, np.int32))
    rare = postings(docs[:600:10].copy(), np.full(60, 5, np.int32))
    best, scores = ranked_search.best_of_shard([(1, common), (100, rare)], n, 10, window=64)
    assert best.tolist() == list(range(0, 100, 10)) and len(set(scores.tolist())) == 1
    assert rare.closed.sum() == 0 and common.closed.sum() > 20


def test_long_texts_and_empty_tables(spark):
    long = [(1, "alpha beta " * 200_000, None, None, None, None), (2, "beta " + "gamma " * 10, None, None, None, None),
            (3, "y" * 2_000_000, None, None, None, None)]
    index = ranked_search.build(frame(spark, long), "doc_id", "text")
    items = [(1, "alpha"), (2, "beta gamma"), (3, "y" * 2_000_000)]
    assert found(index, items_of(spark, items)) == brute([(r[0], r[1]) for r in long], items)
    empty = ranked_search.build(frame(spark, []), "doc_id", "text")
    assert not found(empty, items_of(spark, items)) and not found(index, items_of(spark, []))


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "one two", "x", "y")], "shard bigint, term string, df string, q string")
    index = ranked_search.build(df, "shard", "term")
    queries = spark.createDataFrame([(5, "two", 1)], "doc_id bigint, score string, q int")
    got = ranked_search.search(index, queries.withColumnRenamed("doc_id", "Rank_of"), "Rank_of", "score").collect()
    assert [(r.Rank_of, r.doc_id) for r in got] == [(5, 1)]


def test_lengths_in_one_pass():
    texts = ["a b", "", None, "é-é", "x", "y z ", " q", "1a_b"]
    part = pa.array([None if t is None else t.encode() for t in texts])
    assert ranked_search._lengths(part).tolist() == [len(terms(t)) for t in texts]
    assert ranked_search._lengths(part.slice(3, 3)).tolist() == [2, 1, 2]


def test_large_counts_do_not_overflow():
    assert ranked_search.slow_down(np.array([10 ** 9]), 10 ** 10, 10 ** 12).tolist() == [25 + 75 * 10 ** 19 // 10 ** 12]

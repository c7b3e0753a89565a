"""Each operator against brute force on small documents, with odd rows and empty tables."""

from __future__ import annotations

import collections
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rillrank.llm import (decontaminate, encoding, language, licenses, lm, near_dup, packing, quality, substrings,
                          token_files, urls, words)
from rillrank.llm.graph import components
from rillrank.session import run_dir
from tests.llm.texts import ODD, documents, frame

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def cut(text, lower=False):
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


# words

def test_word_hashes_depend_on_the_word_alone(monkeypatch):
    rnd = random.Random(3)
    text = "".join(rnd.choice(["aé", "b", "longer", "x" * 40]) + rnd.choice([" ", "\n\t", ""]) for _ in range(500))
    hashes, seen = words.text_hashes(text).tolist(), {}
    for word, value in zip(cut(text), hashes, strict=True):
        assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)
    monkeypatch.setattr(words, "PIECE_BYTES", 64)
    assert words.text_hashes("y" * 300 + " " + text).tolist()[1:] == hashes


# licenses

def test_licenses(spark):
    notice = licenses.TEMPLATES["gpl-3.0-line"]
    docs = [(1, "intro words " * 9 + notice + " and more", None, None, None, None),
            (2, "Released under the MIT License.", None, None, None, None),
            (3, notice.upper().replace(" ", "\n"), None, None, None, None),
            (4, " ".join(notice.split()[:5]), None, None, None, None), *ODD]
    got = {(r.doc_id, r.license): r.containment for r in licenses.scan(frame(spark, docs)).collect()}
    assert got == {(1, "gpl-3.0-line"): 1.0, (2, "mit-line"): 1.0, (3, "gpl-3.0-line"): 1.0}
    assert licenses.scan(frame(spark, [])).count() == 0
    assert licenses.scan(frame(spark), {}).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(frame(spark), {"short": "two words"})
    for n in range(5, 200):
        assert licenses.miss_probability(n - 4, licenses.class_of(n)) < 1e-6


# language model

def brute_base(train, text):
    counts = collections.Counter(w for t in train for w in [*cut(t, True), None])
    n, v = sum(counts.values()), len(counts)
    tokens = [*cut(text, True), None]
    return len(tokens), sum(w in counts for w in tokens), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)


@pytest.mark.parametrize("max_bytes", [lm.MAX_BYTES, 1 << 12], ids=["broadcast", "joined"])
def test_language_model(spark, max_bytes, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 200)  # most words are joined
    rows = documents() + ODD
    train = [r[1] for r in rows if (r[0] or 0) % 2 == 0]
    docs = frame(spark)
    model = lm.fit(docs.where(F.coalesce("doc_id", F.lit(0)) % 2 == 0), max_bytes=max_bytes)
    assert (model.pairs is None) == (max_bytes < lm.MAX_BYTES)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                 for r in lm.score(docs, model).collect())
    assert got == sorted((str(i), *b[:3], round(b[3], 6)) for i, t in ((r[0], r[1]) for r in rows)
                         for b in [brute_base(train, t)])
    scores = lm.score(docs, model).agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.max("score").alias("m")).first()
    assert scores.b < scores.s < 0 and scores.m <= 0


def test_filter_reads_counts_back():
    keys = words.mix(np.arange(20_000, dtype=np.uint64))
    slices, width, fits = lm.filter_shape(60_000, 1 << 20)
    places = lm.Filter(np.zeros(slices * width, np.uint64), slices, width)
    tops = np.arange(10_000) % 5 + 1
    for level in range(1, 6):
        source = lm._sources(keys[:10_000][tops >= level], level)
        np.bitwise_or.at(places.places, places.where(keys[:10_000][tops >= level], source), lm._bits(source))
    read = places.read(keys)
    assert fits and (read[:10_000] >= tops).all() and (read[:10_000] == tops).mean() > 0.95
    assert (read[10_000:] == 0).mean() > 0.95
    assert [lm.level_of(c) for c in (0, 1, 2, 3, 5)] == [0, 1, 2, 3, 4]


def test_language_model_without_training(spark):
    docs = frame(spark, ODD)
    got = lm.score(docs, lm.fit(docs.where("false"))).collect()
    assert len(got) == len(ODD) and all(r.n_known == 0 and r.train_tokens == 0 and r.score == 0 for r in got)
    assert lm.score(frame(spark, []), lm.fit(docs)).count() == 0


# substrings

def brute_repeats(rows, size):
    first = {}
    for i, t in rows:
        w = cut(t)
        for k in range(len(w) - size + 1):
            key = tuple(w[k:k + size])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = cut(t)
        gone = {j for k in range(len(w) - size + 1) if first[tuple(w[k:k + size])] < i for j in range(k, k + size)}
        out.append((i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return sorted(out)


@pytest.mark.parametrize("broadcast_keys", [substrings.BROADCAST_KEYS, 0])
@pytest.mark.parametrize("size", [50, 12])
def test_substrings(spark, size, broadcast_keys):
    rows = [(r[0], r[1]) for r in documents(120, size) + ODD if r[0] is not None]
    rows += [(5000, "a b " * 200), (5001, "b a " * 150), (5001, "a b c " * 100), (4999, "c a b " * 90)]
    docs = frame(spark, [(i, t, None, None, None, None) for i, t in rows] + [(None, rows[0][1], None, None, None, None)])
    got = substrings.remove_repeats(docs.withColumn("removed", F.lit("x")), min_words=size, broadcast_keys=broadcast_keys)
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect() if r.doc_id is not None) == \
        brute_repeats(rows, size)
    alone = [r for r in got.collect() if r.doc_id is None]
    assert [r.n_removed for r in alone] == [0] and got.columns[:6] == docs.columns[:6]
    assert substrings.remove_repeats(frame(spark, [])).count() == 0


# near duplicates

def brute_components(rows, percent):
    sets = {}
    for i, t in rows:
        w = cut(t, True)
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return sorted((i, len(sets[i]), root[i], root[i] == i) for i in sets)


@pytest.mark.parametrize("block", [near_dup.BLOCK_DOCS, 3])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK_DOCS", block)
    rnd = random.Random(4)
    base = [f"v{i}" for i in range(150)]
    near = []
    for i in range(40):
        copy = list(base)
        for _ in range(rnd.randrange(6)):
            copy[rnd.randrange(150)] = f"new{rnd.randrange(9)}"
        near.append((2000 + i, " ".join(copy)))
    rows = [(r[0], r[1]) for r in documents(80) + ODD if r[0] not in (None, 1007)] + near
    got = near_dup.near_duplicates(frame(spark, [(i, t, None, None, None, None) for i, t in rows]))
    assert sorted(map(tuple, got.collect())) == brute_components(rows, 85)


def test_near_duplicates_of_odd_rows(spark):
    docs = frame(spark, ODD)
    got = near_dup.near_duplicates(docs).collect()
    assert len(got) == len(ODD) and [r.component_id for r in got if r.doc_id is None] == [None]
    assert all(r.kept for r in got)
    # Of rows of equal id and text one stays.
    assert sorted(map(str, near_dup.keep_first(docs).collect())) == sorted(map(str, docs.distinct().collect()))
    assert near_dup.near_duplicates(frame(spark, [])).count() == 0


def test_registers_estimate_similarity():
    values = words.mix(np.arange(3000, dtype=np.uint64))
    for share in (0, 300, 900):
        a, b = values[:1000], values[1000 - share:2000 - share]
        agreeing = np.array([(near_dup.registers(a) == near_dup.registers(b)).mean()])
        assert abs(near_dup.estimate(agreeing, np.array([1000.0]))[0] - share / (2000 - share)) < 0.12
    assert 0 < near_dup.chance(10) < 0.01


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 7), (50, 51), (51, 50), (60, 60)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {**dict.fromkeys([*range(31), 100], 0), 50: 50, 51: 50}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# token files and packing

def encoded(path, end, text):
    return [*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, end]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_equals_the_library(path):
    rnd = random.Random(2)
    signs = list(" \t\n\r\x0b\x0c\x1c\x1f\x85\x00  　aZ'stÍéßΣς1２,.-😀字​﻿́")
    texts = ["".join(rnd.choices(signs, k=rnd.randrange(1, 25))) for _ in range(1500)]
    texts += ["<|endoftext|> a b", "don't 'S  's", "\r\n\r\na", " lead", "trail ", "", None, *[r[1] for r in documents(20)]]
    tokenizer = Tokenizer.from_file(path)
    want = [[*x.ids, 7] for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in encoding.Encoder(path, 7).encode(texts)] == want


def test_joined_checksums():
    raw = random.Random(1).randbytes(5000)
    for at in (0, 1, 17, 4999, 5000):
        assert encoding.crc32_joined(zlib.crc32(raw[:at]), zlib.crc32(raw[at:]), 5000 - at) == zlib.crc32(raw)


@pytest.mark.parametrize("bits", [1, 8])
@pytest.mark.parametrize("ids", [[], [0], [50256, 1, 0], list(range(3000))])
def test_blocks_come_back(ids, bits):
    ids = np.array(ids, np.uint32)
    assert token_files.unpack_block(token_files.pack_block(ids, bits)).tolist() == ids.tolist()


@pytest.mark.parametrize("bits", [1, 8])
def test_token_files(spark, bits):
    rows = sorted(((r[0], r[1]) for r in documents() + ODD), key=lambda r: (r[0] is not None, r[0] or 0))
    path = run_dir(spark, "tokens")
    token_files.write_tokens(frame(spark), path, BYTES, 0, block_ids=500, plane_bits=bits)
    got = sorted(map(tuple, token_files.read_documents(spark, path).collect()), key=lambda r: r[1])
    want, start, every = [], 0, []
    for i, t in rows:
        ids = encoded(BYTES, 0, t)
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start, every = start + len(ids), every + ids
    assert got == want
    assert token_files.read_range(spark, path, 450, 1600).tolist() == every[450:1600]


def test_token_files_of_an_empty_table(spark):
    path = run_dir(spark, "tokens")
    token_files.write_tokens(frame(spark, []), path, BYTES, 0)
    assert token_files.read_documents(spark, path).count() == 0


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "HELD_DOCS", 9)
    got = packing.pack(frame(spark), WORDS, 2, room=512, group_docs=16).toPandas()
    want = collections.Counter()
    for r in documents() + ODD:
        want[(r[0], tuple(encoded(WORDS, 2, r[1])))] += 1
    pieces = collections.defaultdict(list)
    for r in got.itertuples():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        pieces[None if r.doc_id != r.doc_id else int(r.doc_id)].append((r.start, ids, r.doc_tokens))
    for (doc, ids), n in want.items():
        assert sorted(i for s, part, _ in pieces[doc] for i in zip(range(int(s), int(s) + len(part)), part, strict=True)) == \
            sorted([*enumerate(ids)] * n)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g.offset + g.length).iloc[-1] == g.length.sum() == g.sequence_tokens.iloc[0] <= 512
        assert list(g.offset) == [0, *np.cumsum(g.length)[:-1]]
    assert packing.pack(frame(spark, []), WORDS, 2).count() == 0


def test_first_fit_decreasing_is_first_fit():
    rnd = random.Random(8)
    sizes = [rnd.randrange(1, 100) for _ in range(200)]
    bins = []
    for i in sorted(range(200), key=lambda i: -sizes[i]):
        for b in bins:
            if sum(sizes[j] for j in b) + sizes[i] <= 100:
                b.append(i)
                break
        else:
            bins.append([i])
    assert packing.first_fit_decreasing(sizes, 100) == bins
    filled = packing.fill(bins, sizes, 100)
    loads = sorted(sum(n for _, _, n in b) for b in filled)
    assert sum(loads) == sum(sizes) and all(x > 100 - packing.SHORTEST_CUT for x in loads[1:])
    assert [packing.padded(n) for n in (1, 3, 1024, 1025)] == [1, 4096, 1024, 4096]


# decontamination

def test_decontamination(spark):
    rnd = random.Random(6)
    vocabulary = [f"q{i}" for i in range(900)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(14, 60)))) for i in range(30)] + [(90, None), (91, "..")]
    rows, want = [], set()
    for i in range(90):
        text = rnd.choices(vocabulary, k=rnd.randrange(40, 300))
        if i % 4 == 0:
            item = items[i % 30]
            leaked = item[1].split(" ")
            if i % 8 == 0 and len(leaked) > 30:
                del leaked[3:len(leaked):9]
            at = rnd.randrange(len(text))
            text[at:at] = leaked
            want.add((i, item[0]))
        rows.append((i, ", ".join(text).upper(), None, None, None, None))
    rows += [r for r in ODD if r[0] is not None]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    for block_items in (4096, 11):
        got = decontaminate.leaks(frame(spark, rows), benchmark, block_items=block_items)
        assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    clean = decontaminate.without_leaks(frame(spark), got)
    assert clean.columns == frame(spark).columns and clean.where("doc_id is null").count() == 1
    assert decontaminate.leaks(frame(spark, []), benchmark).count() == 0
    assert decontaminate.leaks(frame(spark), benchmark.where("false")).count() == 0


def test_more_items_than_directions(spark):
    """Every one of 1,500 items, copied word for word, is found: no projection may lose any."""
    rnd = random.Random(8)
    vocabulary = [f"q{i}" for i in range(4000)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(15, 32)))) for i in range(1500)]
    rows = [(i, " ".join([*rnd.choices(vocabulary, k=40), text, *rnd.choices(vocabulary, k=40)]), None, None, None, None)
            for i, text in items]
    got = decontaminate.leaks(frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(i, i) for i, _ in items}


def test_items_of_any_length_in_a_corpus_of_any_size(spark, monkeypatch):
    """Verbatim copies of items of 12 to 2,000 words are found, also where counts are those of a corpus 100,000 times as large."""
    rnd = random.Random(9)
    common, rare = [f"c{i}" for i in range(60)], [f"r{i}" for i in range(20_000)]

    def text(k):
        return rnd.choices(common, k=k // 2) + rnd.choices(rare, k=k - k // 2)

    items = []
    for i in range(60):
        item = text([12, 16, 25, 60, 400, 2000][i % 6])
        rnd.shuffle(item)
        items.append((i, " ".join(item)))
    rows = [(i, " ".join([*text(150), item, *text(150)]), None, None, None, None) for i, item in items]
    rows += [(1000 + i, " ".join(text(300)), None, None, None, None) for i in range(60)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    plain = decontaminate._weights

    def larger(texts, block):
        weight = plain(texts, block)
        outside = [w for i in range(60) for w in rows[i][1].encode().split()]
        found = np.array([1 + outside.count(w) for w in sorted(block.place, key=block.place.get)])
        total = 100_000 * len(outside)
        weight[:-1] = np.log((total + 1) / (100_000 * found + 1)) + 0.01
        weight[-1] = np.median(weight[:-1])
        return weight

    for weights in (plain, larger):
        monkeypatch.setattr(decontaminate, "_weights", weights)
        got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, rows), benchmark).collect()}
        assert got == {(i, i) for i, _ in items}


def test_longest_common_subsequence():
    rnd = random.Random(1)
    for _ in range(60):
        a, b = ([bytes([rnd.randrange(97, 102)]) for _ in range(rnd.randrange(1, 30))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
        assert decontaminate.longest_common(a, b) == row[-1]


# language

def test_language(spark):
    rnd = random.Random(3)
    sounds = {"en": "th ing er an", "de": "sch ich und ei", "fr": "eau ou é elle", "es": "ción ar ñ os"}
    rows = [(i, " ".join("".join(rnd.choices(sounds[lang].split(), k=3)) for _ in range(40)), lang, None, None, "mine")
            for i in range(200) for lang in [list(sounds)[i % 4]]] + ODD
    docs = frame(spark, rows)
    model = language.fit(docs.where("doc_id % 3 = 0"))
    got = language.predict(docs, model)
    assert dict(got.dtypes)["score"] == "double" and got.count() == len(rows)
    held = [r for r in got.collect() if r.doc_id is not None and r.doc_id < 1000]
    assert all(r.lang == r.lang_pred and 0 <= r.score <= 1 for r in held)
    odd = {r.doc_id: (r.lang_pred, r.score) for r in got.collect() if r.doc_id in (1000, 1001, 1002, 1005)}
    assert set(odd.values()) == {("und", 0.0)}
    nothing = language.predict(docs, language.fit(docs.where("false")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert language.predict(frame(spark, []), model).count() == 0


# quality

def brute_quality(text):
    parts = cut(text)
    covered = set()
    windows = collections.Counter(tuple(parts[i:i + 8]) for i in range(len(parts) - 7))
    for i in range(len(parts) - 7):
        if windows[tuple(parts[i:i + 8])] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if cut(x)]
    return [len(parts), sum(len(p.decode()) for p in parts), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered)]


def test_quality(spark):
    rnd = random.Random(5)
    rows = documents(30) + ODD + [(3000 + i, "\n".join(rnd.choices(["a é #b", " ", "x y z w v u t s r q", "k"], k=40)), None, None,
                                   None, None) for i in range(10)]
    got = quality.quality_verdict(frame(spark, rows)).collect()
    columns = quality.COUNTS[:5]
    assert sorted((str(r.doc_id), *[r[c] for c in columns]) for r in got) == \
        sorted((str(r[0]), *brute_quality(r[1])) for r in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert {r.doc_id: r.kept for r in got}[1006] is False
    assert quality.quality_verdict(frame(spark, [])).count() == 0


# urls

def test_urls(spark):
    rules = [urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/")]
    rows = [(1, "http://www.Example.ORG/es/1?q#f"), (2, "https://a.b.org"), (3, "https://a.b.org/"), (4, None), (5, "no scheme"),
            (6, "http://m.site.com/page.html?x"), (7, "https://site.com/page/"), (8, "https://notexample.org/es/"), (9, "http://site.com/other"),
            (9, "http://site.com/other")]
    pages = spark.createDataFrame([(i, u, "old") for i, u in rows], "page_id bigint, url string, verdict string")
    listed = spark.createDataFrame([("site.com/page",), ("site.com/page",), (None,)], "canonical string")
    for max_blocks in (urls.MAX_BLOCKS, 1):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.url_verdicts(pages, rules, listed, max_blocks=max_blocks).collect()}
        assert got == {
            1: ("www.example.org", "/es/1", "example.org/es/", "block"), 2: ("a.b.org", "", None, "allow"),
            3: ("a.b.org", "/", "org/", "allow"), 4: ("", "", None, "allow"), 5: ("", "", None, "allow"),
            6: ("m.site.com", "/page.html", None, "block"), 7: ("site.com", "/page/", None, "block"),
            8: ("notexample.org", "/es/", "org/", "allow"), 9: ("site.com", "/other", None, "allow")}
    assert urls.url_verdicts(pages, rules, listed).count() == len(rows)
    assert urls.url_verdicts(pages.where("false"), rules, listed).count() == 0
    assert {r.verdict for r in urls.url_verdicts(pages, [], listed.where("false")).collect()} == {"allow"}


def test_native_plans_run_no_python(spark):
    plans = [licenses.scan(frame(spark)), urls.url_verdicts(
        spark.createDataFrame([(1, "http://a.b/c")], "page_id bigint, url string"), [], spark.createDataFrame([("x",)], "canonical string"))]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))



"""Personal data: spans against plain regular expressions and checks, odd texts, long texts, and redaction."""

from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from rillrank.llm import oracle, personal
from tests.check import connect, normal
from tests.llm.texts import ODD, frame


def luhn(digits):
    doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def digits(match):
    return re.sub("[^0-9]", "", match)


#: Fixed patterns of the contract.
PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
]


def brute(text):
    found = sorted((m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, pattern, good) in enumerate(PLAIN)
                   for m in re.finditer(pattern, text or "") if good(m.group()))
    joined = ",".join(s for _, _, s in found)
    return [sum(k == place for _, k, _ in found) for place in range(4)], hashlib.sha256(joined.encode()).hexdigest(), joined


def texts(seed, n=400):
    """Texts of pieces that nearly make matches, run into each other, and stand between other characters."""
    rnd = random.Random(seed)
    pieces = ["a@b.c", "x.y_z@mail-1.example.com", "@", ".", "-", "+", " ", "1.2.3.4", "256.1.1.1", "0000255.1.1.1", "+1 (555) 010-9999",
              "4111 1111 1111 1111", "4111111111111112", "5", "99999999999999999999.1.1.1", "é", "日本", "😀", "a", "Z9", "()", "\n",
              "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "phone 555-123-4567", "ssn 123-45-6789", "tel: (555) 123 4567",
              "123-45-6789", "call", "_", "%"]
    return ["".join(rnd.choices(pieces, k=rnd.randrange(1, 14))) for _ in range(n)]


def rows(values):
    return [(i, v, None, None, None, None) for i, v in enumerate(values)]


def test_contract_kinds_equal_plain_search(spark):
    given = rows(texts(5)) + ODD
    got = personal.digest(personal.spans(frame(spark, given), "doc_id", "text"), "doc_id").collect()
    assert len(got) == len(given)
    of = {r.doc_id: r for r in got if r.doc_id is not None}
    for doc_id, text, *_ in given:
        if doc_id is None:
            continue
        counts, sha, base = brute(text)
        r = of[doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts and r.base_sha256 == sha, text
        # What the method adds comes beside the four kinds.
        assert [s for s in r.spans.split(",") if s.split(":")[0] in personal.BASE] == [s for s in base.split(",") if s]


def test_sql_agrees_on_odd_texts(spark, tmp_path):
    frame(spark, rows(texts(6)) + [r for r in ODD if r[0] is not None]).drop("score").write.parquet(str(tmp_path / "documents.parquet"))
    con = connect(str(tmp_path / "none"))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    got = personal.digest(personal.spans(docs, "doc_id", "text"), "doc_id").toPandas()
    assert normal(got) == normal(con.sql(oracle.SQL["op12_personal_data"]).df())


@pytest.mark.parametrize("text, kinds", [
    ("account GB82 WEST 1234 5698 7654 32 now", ["iban"]),
    ("account GB82 WEST 1234 5698 7654 33 now", []),
    ("DE89370400440532013000", ["iban"]),
    ("her ssn is 123-45-6789.", ["us_ssn"]),
    ("part 123-45-6789.", []),
    ("Tel. 555-123-4567", ["local_phone"]),
    ("tel (555) 123-4567", ["local_phone"]),
    ("item 555-123-4567", []),
    ("call +1 555-123-4567", ["phone"]),
    ("hotel 555-123-4567", []),
])
def test_added_kinds(spark, text, kinds):
    got = personal.spans(frame(spark, rows([text])), "doc_id", "text").where("kept").orderBy("start").collect()
    assert [personal.KINDS[r.kind].name for r in got] == kinds


def test_long_texts_take_linear_time(spark):
    """Runs without an end, and very many matches: each would take hours if it were tried from every place."""
    long = ["a" * 2_000_000, "a@" + "b." * 500_000, "1" * 2_000_000, "1." * 500_000, "+1" + " " * 1_000_000, "ab@c.de " * 50_000,
            "GB82 " + "A" * 1_000_000]
    start = time.monotonic()
    got = personal.digest(personal.spans(frame(spark, rows(long)), "doc_id", "text"), "doc_id").collect()
    of = {r.doc_id: r for r in got}
    assert time.monotonic() - start < 120
    assert of[5].n_email == 50_000 and of[3].n_ip == 125_000 and of[0].spans == of[2].spans == of[4].spans == ""
    assert of[5].spans.endswith("email:399992:399999")


def test_nulls_repeats_and_empty_tables(spark):
    given = [(1, "a@b.c", None, None, None, None)] * 3 + [(None, "1.2.3.4", None, None, None, None), (2, None, None, None, None, None)]
    found = personal.digest(personal.spans(frame(spark, given), "doc_id", "text"), "doc_id").collect()
    assert sorted((r.doc_id or 0, r.spans) for r in found) == [(0, "ip:0:7"), (1, "email:0:5"), (1, "email:0:5"), (1, "email:0:5"), (2, "")]
    assert personal.digest(personal.spans(frame(spark, []), "doc_id", "text"), "doc_id").count() == 0


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a@b.c", "x", 7)], "ROW bigint, match string, kind string, start int")
    got = personal.digest(personal.spans(df, "ROW", "match"), "ROW").collect()
    assert [(r.ROW, r.n_email) for r in got] == [(1, 1)]


def test_redacted(spark):
    given = rows(["to a@b.c and 1.2.3.4!", "+1 4111 1111 1111 1111", "nothing", "日本 x@y.zé"]) + [(9, None, None, None, None, None)]
    got = {r.doc_id: (r.text, r.n_spans) for r in personal.redacted(frame(spark, given), "doc_id", "text").collect()}
    assert got[0] == ("to [email] and [ip]!", 2) and got[2] == ("nothing", 0) and got[9] == (None, 0)
    assert got[3] == ("日本 [email]é", 1)

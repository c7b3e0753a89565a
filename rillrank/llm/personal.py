r"""Spans of personal data, by built-in expressions only.

Regular expressions propose spans, checks confirm them, words nearby adjust a score:

- email, ip, card and phone are found wherever their pattern matches (leftmost, not overlapping within a kind) and
  their check holds: parts up to 255, the Luhn sum, the number of digits. These stay whatever their score.
- iban (confirmed by mod-97), us_ssn and local_phone (a number without a country code) are added if their score
  reaches `LEAST`. A checksum is enough; without one it takes a context word at most `NEAR` characters away, in the
  text up to the neighbouring match of the same kind. A context-only span that overlaps a span of the four kinds
  is left out.

A score is the kind's own (`Kind.score`), plus `BONUS` if a context word of the kind is near.

The places of matches come from cutting the text at them: the lengths of what lies between and of the matches before
add up to a start, in a running sum over the matches of one row, so the work is linear in a text's length and no list
of a text's matches is copied for each of them. Patterns are possessive and start only where a run of their
characters starts, or where the last match ended, so that they never try a run again from its middle.

Null and empty texts have no spans and give a row. Rows are judged one by one, whatever ids or texts repeat; null ids
are kept. Equal starts go by the order of `KINDS`. A text of any length is read whole. Empty tables give no rows.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillrank.llm.tables import saved

LEAST = 0.6
BONUS = 0.4
NEAR = 40


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _characters(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: F.substring(text, i, F.lit(1)))


def luhn(digits: Column) -> Column:
    """Whether digits (at least one) have a Luhn sum divisible by ten."""
    def value(c: Column, i: Column) -> Column:
        twice = c.cast("int") * 2
        return F.when(i % 2 == 0, c.cast("int")).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    values = F.transform(_characters(F.reverse(digits)), value)
    return F.aggregate(values, F.lit(0), lambda total, v: total + v) % 10 == 0


def mod_97(code: Column) -> Column:
    """Whether an account code without spaces, letters counted from A = 10, leaves 1 when its head is put last."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        return F.when(c >= "A", (rest * 100 + F.ascii(c) - 55) % 97).otherwise((rest * 10 + F.ascii(c) - 48) % 97)

    return F.aggregate(_characters(turned), F.lit(0), add) == 1


def _parts_up_to_255(match: Column) -> Column:
    return F.forall(F.split(match, "\\."), lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False)))


def _card(match: Column) -> Column:
    digits = _digits(match)
    return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)


def _phone(match: Column) -> Column:
    return F.length(_digits(match)).between(9, 15)


def _iban(match: Column) -> Column:
    code = F.replace(match, F.lit(" "), F.lit(""))
    return F.when(F.length(code).between(15, 34), mod_97(code)).otherwise(False)


def _any(match: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Kind:
    """`sign`: a character without which there is no match. `context`: words that raise the score."""

    name: str
    pattern: str
    check: Callable[[Column], Column]
    base: bool
    score: float
    context: str
    sign: str | None = None


#: Fixed patterns, in the order of equal starts. The first four are those of the contract, made possessive.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", _any,
         True, 0.9, "mail|contact|write", "@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _parts_up_to_255, True, 0.7, "ip|address|host|server"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", _card, True, 0.6, "card|visa|credit|payment|karte|tarjeta|carte"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _phone, True, 0.7, "phone|tel|call|mobile|fax", "+"),
    Kind("iban", r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9_])", _iban, False, 0.8,
         "iban|account|bank|konto|cuenta|compte"),
    Kind("us_ssn", r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])", _any, False, 0.3, "ssn|social security"),
    Kind("local_phone", r"(?<![A-Za-z0-9_])[0-9]{3}(?:[\x20.-]|\)\x20?)[0-9]{3}[\x20.-][0-9]{4}(?![A-Za-z0-9_])", _any, False,
         0.3, "phone|tel|call|mobile|fax|telefon"),
)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASE = [k.name for k in KINDS if k.base]


def _cut(text: Column, kind: Kind, place: int) -> list[Column]:
    """The matches of a kind, and what lies between them: one piece more."""
    found, gaps = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), F.split(text, kind.pattern, -1)
    if kind.sign is not None:
        there = F.contains(text, F.lit(kind.sign))
        found, gaps = (F.when(there, c).otherwise(F.array().cast("array<string>")) for c in (found, gaps))
    return [found.alias(f"found{place}"), gaps.alias(f"gaps{place}")]


def _matches(place: int) -> Column:
    """One struct per match of a kind, in order: what lies before it, itself, and what comes after."""
    found, gaps = F.col(f"found{place}"), F.col(f"gaps{place}")
    # The pieces are zipped, not looked up: a lookup in a lambda would cut the text again for each match.
    zipped = F.arrays_zip(found.alias("match"), gaps.alias("gap"), F.slice(gaps, 2, 1 << 30).alias("after"))
    return F.transform(F.filter(zipped, lambda z: z["match"].isNotNull()), lambda z, i: F.struct(
        F.lit(place).alias("kind"), i.alias("no"), F.length(z["gap"]).alias("gap"), z["match"].alias("match"),
        F.substring(z["gap"], -NEAR, NEAR).alias("before"), F.substring(z["after"], 1, NEAR).alias("after")))


def _of_kind(values: Callable[[Kind], Column]) -> Column:
    """The value that `values` gives for the row's kind."""
    chosen = F.lit(None)
    for place, kind in reversed(list(enumerate(KINDS))):
        chosen = F.when(F.col("kind") == place, values(kind)).otherwise(chosen)
    return chosen


def spans(df: DataFrame, key: str, text: str) -> DataFrame:
    """A row per span that stays, and one without a span (kind null) for rows that have none: row, key, kind (place in
    `KINDS`), start, end (exclusive, in code points), score."""
    return _spans(_numbered(df, key, text))


def _numbered(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("key"),
                     F.col(f"`{text}`").alias("text"))


def _spans(numbered: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    cut = numbered.select("row", "key", *[c for place, kind in enumerate(KINDS) for c in _cut(text, kind, place)])
    listed = F.concat(*[_matches(place) for place in range(len(KINDS))])
    rows = cut.select("row", "key", F.explode_outer(listed).alias("m")).select("row", "key", "m.*")
    # All that follows needs a row's matches together: one shuffle, of matches and not of texts.
    rows = rows.repartition("row")
    before = Window.partitionBy("row", "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("match")).over(before)
    placed = rows.withColumn("end", end.cast("bigint")).withColumn("start", F.col("end") - F.length("match"))
    near = F.translate(F.concat_ws(" | ", "before", "after"), _UPPER, _UPPER.lower())
    judged = placed.select(
        "row", "key", "kind", "start", "end",
        _of_kind(lambda k: k.check(F.col("match"))).alias("good"),
        F.when(F.col("kind").isNotNull(), _of_kind(lambda k: F.lit(k.score))
               + F.when(_of_kind(lambda k: near.rlike(rf"(?<![a-z])(?:{k.context})")), BONUS).otherwise(0.0)).alias("score"),
        (F.col("kind") < len(BASE)).alias("base"),
        _of_kind(lambda k: F.lit(not k.base and k.score < LEAST)).alias("weak"),
    )
    # A span of the four kinds may reach into a weak one from either side.
    # Both frames look back, one of them in the reverse order: a frame that looks ahead is summed anew for each row.
    earlier, later = (Window.partitionBy("row").orderBy(*[o(c) for c in ("start", "end", "kind")])
                      .rowsBetween(Window.unboundedPreceding, -1) for o in (F.asc, F.desc))
    sure = F.col("base") & F.col("good")
    reached = F.max(F.when(sure, F.col("end"))).over(earlier) > F.col("start")
    entered = F.min(F.when(sure, F.col("start"))).over(later) < F.col("end")
    clear = ~(F.coalesce(reached, F.lit(False)) | F.coalesce(entered, F.lit(False)))
    kept = F.col("good") & (F.col("base") | ((F.col("score") >= LEAST) & (clear | ~F.col("weak"))))
    return judged.select("row", "key", "kind", "start", "end", "score", F.coalesce(kept, F.lit(False)).alias("kept"))


def digest(found: DataFrame, key: str) -> DataFrame:
    """One row per row of the table: counts of the four kinds, the hash of their spans, and all spans as text."""
    name = F.element_at(F.array(*[F.lit(k.name) for k in KINDS]), F.col("kind") + 1)
    span = F.when(F.col("kept"), F.struct("start", "kind", F.concat_ws(":", name, "start", "end").alias("text")))
    listed = F.sort_array(F.collect_list(span))
    base = F.filter("listed", lambda s: s["kind"] < len(BASE))
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: s["text"]))
    return found.groupBy("row").agg(
        F.first("key").alias("key"),
        *[F.count(F.when(F.col("kept") & (F.col("kind") == place), 1)).alias(f"n_{name}") for place, name in enumerate(BASE)],
        listed.alias("listed"),
    ).select(F.col("key").alias(key), *[f"n_{name}" for name in BASE], F.sha2(joined(base), 256).alias("base_sha256"),
             joined(F.col("listed")).alias("spans"))


def redacted(df: DataFrame, key: str, text: str) -> DataFrame:
    """`key`, the text with each kept span replaced by its kind in brackets, and the number of spans. Where spans
    overlap, the first one takes what they share. Texts are written once, numbered, so that spans find their row."""
    read = saved(_numbered(df, key, text), "numbered")
    found = _spans(read).where("kept")
    ends = F.max("end").over(Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1))
    cut = found.withColumn("from", F.greatest("start", F.coalesce(ends, F.lit(0)))).where(F.col("end") > F.col("from"))
    listed = cut.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("from", "end", "kind"))).alias("cuts"))
    cuts = F.coalesce("cuts", F.array().cast("array<struct<from:bigint,end:bigint,kind:int>>"))
    names = F.array(*[F.lit(f"[{k.name}]") for k in KINDS])
    piece = F.transform(F.col("cuts"), lambda c, i: F.concat(
        F.substring(F.col("text"), F.when(i == 0, 1).otherwise(F.get(F.col("cuts"), i - 1)["end"] + 1).cast("int"),
                    (c["from"] - F.when(i == 0, 0).otherwise(F.get(F.col("cuts"), i - 1)["end"])).cast("int")),
        F.element_at(names, c["kind"] + 1)))
    last = F.when(F.size("cuts") == 0, F.lit(0)).otherwise(F.get(F.col("cuts"), F.size("cuts") - 1)["end"])
    rest = F.substring(F.col("text"), (last + 1).cast("int"), F.length("text"))
    return read.join(listed, "row", "left").withColumn("cuts", cuts).select(
        F.col("key").alias(key), F.concat(F.concat_ws("", piece), rest).alias("text"), F.size("cuts").alias("n_spans"))

"""Language identification in two steps: family first, then one-versus-one linear SVMs within it.

A text is a histogram of its byte pairs and triples (letters lower-cased, other ASCII signs as spaces),
hashed to DIMENSIONS places, square-rooted and scaled to length one. Linear support vector machines
(squared hinge) tell families apart one against the rest, and the languages of a family in pairs by
vote; ties go to the larger sum of margins.

Fitting takes at most `max_rows` labelled rows, at most the same share from each language, chosen by a hash
of the id (one row of each if there are more languages than rows; more than MAX_LANGUAGES are refused); this documented bound is what keeps it on one machine. Language counts cover all rows, and
prediction covers every whole text.

Null texts and texts without a letter are `und` with score 0, and so is every text if nothing was
learned. Rows without a language are not learned from. Repeated rows are predicted alike. Prediction
keeps the columns of the input; `lang_pred` and `score` replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillrank.llm.tasks import map_batches, slices

DIMENSIONS = 4096
MAX_ROWS = 2400
MAX_LANGUAGES = 400
UNKNOWN = "und"

#: Languages (ISO 639-1) of each family. A language of no family here is its own family.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "an ast ca es fr gl it la oc pt rm ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "iranian": "fa ku ps tg",
    "indic": "as bn gu hi mr ne or pa si ur",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
    "malay": "id jv ms su tl",
}
_FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}

_LETTERS = np.arange(256, dtype=np.uint32)
_LETTERS[[i for i in range(128) if not chr(i).isalpha()]] = 32


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang, lang)


def features(text: str) -> np.ndarray:
    raw = _LETTERS[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    pairs = raw[:-1] * np.uint32(257) + raw[1:]
    triples = pairs[:-1] * np.uint32(65599) + raw[2:]
    triples = (triples * np.uint32(0x9E3779B1)) >> np.uint32(20)
    pairs = (pairs * np.uint32(0x85EBCA6B)) >> np.uint32(20)
    counts = np.bincount(triples, minlength=DIMENSIONS) + np.bincount(pairs, minlength=DIMENSIONS)
    root = np.sqrt(counts).astype(np.float32)
    return root / np.linalg.norm(root)


def has_letter(text: str | None) -> bool:
    return next(filter(str.isalpha, text or ""), None) is not None


def fit_svm(x: np.ndarray, y: np.ndarray, rounds: int = 300, penalty: float = 1e-4) -> np.ndarray:
    """Weights with the bias last; y is +1 or -1, both sides weigh the same. Accelerated gradient steps."""
    x, y = np.hstack([x, np.ones((len(x), 1), np.float32)]), y.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = before = np.zeros(x.shape[1], np.float32)
    step = 1 / (4 + penalty)
    for t in range(rounds):
        at = w + np.float32(t / (t + 3)) * (w - before)
        slack = np.maximum(0, 1 - y * (x @ at)) * y * weight
        before, w = w, at - np.float32(step) * (np.float32(penalty) * at - 2 * (slack @ x))
    return w


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    families: dict[str, list[int]] = field(default_factory=dict)
    family_weights: np.ndarray | None = None
    pair_weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fit(cls, x: np.ndarray, langs: list[str]) -> Model:
        model = cls(sorted(set(langs)))
        label = np.array([model.languages.index(v) for v in langs])
        for i, lang in enumerate(model.languages):
            model.families.setdefault(family_of(lang), []).append(i)
        group = np.empty(len(model.languages), int)
        for g, members in enumerate(model.families.values()):
            group[members] = g
        if len(model.families) > 1:
            model.family_weights = np.stack([fit_svm(x, np.where(group[label] == g, 1.0, -1.0))
                                             for g in range(len(model.families))])
        for name, members in model.families.items():
            if len(members) > 1:
                pairs = []
                for a, b in combinations(members, 2):
                    mine = (label == a) | (label == b)
                    pairs.append(fit_svm(x[mine], np.where(label[mine] == a, 1.0, -1.0)))
                model.pair_weights[name] = np.stack(pairs)
        return model

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language, and a score from 0 to 1, of each row."""
        x = np.hstack([x, np.ones((len(x), 1), np.float32)])
        family, score = np.zeros(len(x), int), np.ones(len(x))
        if self.family_weights is not None:
            margins = x @ self.family_weights.T
            family = margins.argmax(axis=1)
            score = _sigmoid(margins.max(axis=1))
        out = np.zeros(len(x), int)
        for g, (name, members) in enumerate(self.families.items()):
            mine = np.flatnonzero(family == g)
            if name not in self.pair_weights or not len(mine):
                out[mine] = members[0]
                continue
            margins = x[mine] @ self.pair_weights[name].T
            votes, sums = np.zeros((2, len(mine), len(members)))
            for k, (a, b) in enumerate(combinations(range(len(members)), 2)):
                votes[:, a] += margins[:, k] > 0
                votes[:, b] += margins[:, k] <= 0
                sums[:, a] += margins[:, k]
                sums[:, b] -= margins[:, k]
            best = np.lexsort((sums, votes), axis=1)[:, -1]
            out[mine] = np.array(members)[best]
            score[mine] *= _sigmoid(sums[np.arange(len(mine)), best] / (len(members) - 1))
        return out, score


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-4.0 * np.clip(margin, -8, 8)))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        max_rows: int = MAX_ROWS) -> Model:
    """Learns from at most `max_rows` rows that have a language and a text."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"),
        F.pmod(F.xxhash64(F.col(f"`{key}`").cast("string")), F.lit(1 << 30)).alias("draw"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return Model()
    share = max(1, max_rows // len(counts))
    bound = F.lit(None).cast("bigint")
    for name, n in counts.items():
        # A tenth more than the share, so that chance seldom leaves fewer.
        bound = F.when(F.col("lang") == name, min(1 << 30, int((1 << 30) * (1.1 * share + 9) / n))).otherwise(bound)
    drawn = rows.where(F.col("draw") < bound)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept = [(v, d, features(t).tobytes()) for v, d, t in
                    zip(*(batch.column(c).to_pylist() for c in ("lang", "draw", "text")), strict=True) if has_letter(t)]
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*kept, strict=True)],
                                                 names=["lang", "draw", "features"])

    sample = map_batches(drawn, measure, "lang string, draw bigint, features binary")
    # The share is a language's own: the excess of one never takes the place of another's.
    by = Window.partitionBy("lang").orderBy("draw", "features")
    got = sample.withColumn("place", F.row_number().over(by)).where(F.col("place") <= share).drop("place").collect()
    if not got:
        return Model()
    got.sort(key=lambda r: (r["lang"], r["draw"], bytes(r["features"])))
    x = np.stack([np.frombuffer(bytes(r["features"]), np.float32) for r in got])
    return Model.fit(x, [r["lang"] for r in got])


def with_letters(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text has a letter, which is what a language can be told of."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([has_letter(x) for x in batch.column(text).to_pylist()], pa.bool_()))

    return map_batches(docs, run, docs.schema)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with lang_pred and score."""
    made = ["lang_pred", "score"]
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in made or c == text])
    schema = T.StructType([*kept.schema.fields, T.StructField(made[0], T.StringType()),
                           T.StructField(made[1], T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            texts = batch.column(text).to_pylist()
            known = [i for i, x in enumerate(texts) if model.languages and has_letter(x)]
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if known:
                best, score = model.predict(np.stack([features(texts[i]) for i in known]))
                scores[known] = score
                for i, b in zip(known, best, strict=True):
                    langs[i] = model.languages[b]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores)],
                                             names=[*batch.schema.names, *made])

    return map_batches(kept, run, schema)

"""Small documents for the tests: copies, near copies, shared passages, odd rows."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"


def documents(n: int = 60, seed: int = 1) -> list[tuple]:
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünï", "çé", "The", "the"]
    passage = " ".join(rnd.choices(vocabulary, k=60))
    texts = []
    for i in range(n):
        words = rnd.choices(vocabulary, k=rnd.randrange(30, 260))
        if i % 5 == 1:
            at = rnd.randrange(len(words))
            words[at:at] = passage.split(" ")
        text = "".join(w + rnd.choice([" ", " ", " ", "\n", "  ", "\t"]) for w in words)
        if i % 7 == 3:
            text = texts[rnd.randrange(len(texts))]
        elif i % 7 == 5:
            near = texts[rnd.randrange(len(texts))].split(" ")
            near[rnd.randrange(len(near))] = "changed"
            text = " ".join(near)
        texts.append(text)
    return [(i * 3, t, rnd.choice(["en", "de", None]), "s", len(t), "kept") for i, t in enumerate(texts)]


ODD = [
    (1000, None, None, None, None, None), (1001, "", "en", "s", 0, None), (1002, " \n\t ", "en", "s", 4, None),
    (1003, "one", "en", "s", 3, None), (1004, "four words in all", "en", "s", 17, None),
    (1005, "4711 +++ 12", None, "s", 11, None), (1006, "x " * 3000, "en", "s", 6000, None),
    (1007, "same row here", "en", "s", 13, None), (1007, "same row here", "en", "s", 13, None),
    (None, "no id at all", "en", "s", 12, None),
]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() + ODD if rows is None else rows, DOCS).repartition(3)

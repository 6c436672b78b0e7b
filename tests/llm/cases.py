"""Documents with everything that may go wrong in a table."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, body string, size long, row long, hash string"
WORDS = "the of and to in is that for it with as was on be by at this are or from".split()


def table(spark, texts, schema=SCHEMA):
    """`texts`: (doc_id, text) rows; the other columns are null or have names that operators use themselves."""
    rows = [(d, t, "en", "src", None if t is None else len(t), True, "x", 1, d, "h") for d, t in texts]
    return spark.createDataFrame(rows, schema)


def prose(seed, words, vocabulary=400):
    rnd = random.Random(seed)
    names = WORDS + [f"w{i}é" if i % 7 == 0 else f"word{i}" for i in range(vocabulary)]
    return " ".join(rnd.choice(names) + ("." if rnd.random() < 0.1 else "") for _ in range(words))


def odd_texts():
    """Null, empty, blank, short, repeated and very long texts; equal texts; repeated and null ids."""
    base = prose(1, 120)
    long = "\n".join(prose(i, 60) for i in range(200))
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "one"),
        (5, "Two words."),
        (6, base),
        (7, base),
        (8, base + " and more."),
        (9, base.replace("the", "THE")),
        (10, long),
        (10, long),
        (11, "ab " * 30),
        (None, base),
        (None, None),
        (12, "漢字 ééé ₤ \x85 \xa0 x y 🙂"),
        (13, "a | b | c | d\nsome line of words that stays here, with a comma and ends."),
    ]

"""Small document tables for the tests."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row long, chunk int, score double, "
    "kept boolean, `class` string, `_words` int, `a.b` int, shard string"
)


def prose(seed, n, line=12):
    rng = random.Random(seed)
    syllables = ["the", "er", "an", "ou", "ti", "on", "re", "ea", "in", "st", "ble", "é", "ü"]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + line]) for i in range(0, n, line))


LONG = prose(99, 30_000)
NEAR = prose(7, 200)
DOCS = [
    (0, prose(1, 120), "en", "a"),
    (1, prose(1, 120), "en", "a"),
    (2, NEAR, "de", "b"),
    (3, NEAR + " tail words", "de", "b"),
    (4, NEAR.replace("\n", " ", 3) + " other", None, None),
    (5, None, "en", "a"),
    (6, "", "en", "a"),
    (7, " \n\t ", "fr", "c"),
    (8, "one", "fr", "c"),
    (9, "one two three", "fr", "c"),
    (10, LONG, "en", "a"),
    (10, LONG, "en", "a"),
    (11, "mail me at jo.doe@mail.example.com or +1 (555) 555-0100 now", "en", "a"),
    (12, "Der " * 80, "de", "b"),
    (13, "word### other$$$ third&&& " * 30, "en", "a"),
    (None, prose(3, 90), "en", "a"),
    (None, None, None, None),
    (14, "x" * 50_000, "en", "a"),
    (15, "漢字 \U0001F600 ▁mark <0x0A> \x85\xa0 \x1c", "zh", "d"),
    (15, "another text of the same id " * 20, "zh", "d"),
]


def documents(spark, rows):
    """A table of ``(doc_id, text, lang, source)`` with many more columns."""
    full = [(i, t, lang, source, len(t or ""), 1, 2, 0.5, True, "c", 3, 4, "s") for i, t, lang, source in rows]
    return spark.createDataFrame(full, SCHEMA)


def bag(df, *columns):
    """The rows as a sorted list, nulls first."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: [(v is not None, v) for v in r])

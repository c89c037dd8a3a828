"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

from pyspark.sql import functions as F

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; as extra columns they must do no harm.
CLASHING = ["row_id", "digest", "size", "sid", "n", "kept", "key", "start", "unit", "src", "bucket", "pair", "uid", "__text", "a", "b",
            "selected", "tail_probability", "expected_grade", "epoch", "pieces", "words", "__row", "__words", "fp", "codes", "other", "component"]


def documents(spark, rows, clashing=True):
    """A documents table of ``(doc_id, text[, source])`` rows, with clashing extra columns."""
    full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOC_SCHEMA)
    return df.withColumns({c: F.lit("x") for c in CLASHING}) if clashing else df


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward_texts(seed=3):
    """Texts of all kinds as ``(doc_id, text, source)``."""
    rng = random.Random(seed)
    base = words(rng, 120)
    edited = base.split()
    edited[60] = "changed"
    rows = [(1, base, "a"), (2, base.upper(), "a"), (3, " ".join(edited), "b"), (4, None, "b"), (5, "", None), (6, " \t\n ", "a"),
            (7, "one", "a"), (8, "one two", None), (9, "One  TWO", "c"), (None, base, "c"), (None, None, "c"), (10, base, "a"), (10, base, "a"),
            (11, words(rng, 30_000), "a"), (12, "élan ÉLAN naïve  nbsp <|endoftext|> x", "d"), (13, "İstanbul Σίσυφος ς", "d"),
            (14, "\x00\x1c control   wide", "d"), (15, "x" * 50_000, "d"), (16, "a\rb\x0bc\x0cd", "d")]
    rows += [(20 + i, words(rng, rng.randrange(0, 60)), rng.choice(["a", "a", "b", None])) for i in range(60)]
    return rows


def rows_of(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))

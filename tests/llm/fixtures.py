"""Small documents with the cases every operator has to bear."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = "word after word, " * 20_000
ODD = [
    (1, "one two three four five six"),
    (2, "one two three four five six"),
    (3, None),
    (4, ""),
    (5, " \t\n "),
    (6, LONG),
    (7, LONG),
    (8, "Ünï cödé 漢字 😀 text. And more of it!\nSecond line"),
    (None, "one two three four five six"),
    (9, "x" * 30_000),
    (10, "One Two  three\tfour five six"),
    (10, "another text under a repeated id"),
    (11, "twin row"),
    (11, "twin row"),
    (12, "a"),
]


def documents(spark, rows=None, **extra):
    """Rows (doc_id, text[, source]) as documents; ``extra`` are constant columns that clash with internal names."""
    from pyspark.sql import functions as F

    full = [
        (r[0], r[1], "en", r[2] if len(r) > 2 else f"s{i % 3}", len(r[1] or "")) for i, r in enumerate(ODD if rows is None else rows)
    ]
    df = spark.createDataFrame(full, SCHEMA)
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


CLASHING = {"row": 1, "size": "x", "key": 2.0, "doc": "d", "of": 3, "fp": 4, "sha": "s", "times": 5, "score": "z", "component_id": 6, "copy": 7, "at": 8}

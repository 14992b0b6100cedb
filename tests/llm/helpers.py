"""Documents that the corpus operators must take, and plain readings of their contracts."""

from __future__ import annotations

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    """``(doc_id, text)`` or ``(doc_id, text, source)`` as a documents table."""
    full = [
        (r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1])) for r in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def odd(spark):
    """NULL and empty texts, NULL ids and sources, ties, repeated rows, one long text."""
    return documents(
        spark,
        [
            (1, None, None),
            (2, "", "b"),
            (3, " \n\t ", "b"),
            (4, "one two three four five six.", None),
            (5, "one two three four five six.", "a"),
            (5, "one two three four five six.", "a"),
            (6, "x" * 30_000 + " end", "a"),
            (7, "long words again and again. " * 4_000, "a"),
            (None, "no id here but text", "a"),
            (8, "Ünïcode 💡 text\nwith lines\n", "z"),
        ],
    )


def clashing(df):
    """The same rows with columns that are named like results of the operators."""
    from pyspark.sql import functions as F

    names = ("size", "n", "bits", "row", "length", "start", "score", "block", "label", "copies", "p", "spans", "x", "rank")
    return df.select("*", *[F.lit("?").alias(c) for c in names])


def column(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)

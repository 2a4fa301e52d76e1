from __future__ import annotations

import pytest
from pyspark.sql import functions as F

#: Awkward rows: nulls in any column, empty and blank texts, ties, repeated
#: rows, a repeated id with another text, and one very long text.
LONG = " ".join(f"Wort{i % 977} und das ist lang" for i in range(20_000))
PASSAGE = "this exact passage of some fourteen words is repeated in several documents of the table again"
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog and runs away into the dark green forest.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs away into the dark green forest.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs away into the dark green forest.", "en", "a"),
    (3, None, "en", "a"), (4, "", "de", None), (5, " \t\n ", None, "b"), (6, LONG, "de", "b"),
    (7, "Licensed under the Apache License, Version 2.0.\nCC BY\ncc by", "en", "c"),
    (8, "GNU General Public License, MIT license", None, None), (None, "no id here " + PASSAGE, "en", "a"),
    (9, "kurz", "de", "c"), (9, "another text under the same id", "en", "c"),
    (10, "Ä ö ü ß 漢字 🙂 " + PASSAGE, "de", "a"), (11, PASSAGE, "en", None),
    (12, "12345 !!! ###", "en", "b"), (13, "one two three four", "en", "b"), (14, "one two three four", "en", "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def awkward(spark):
    """The awkward rows with extra columns that bear the operators' own names."""
    df = spark.createDataFrame(AWKWARD, SCHEMA).withColumn("n_chars", F.length("text").cast("long"))
    for name in ("size", "target", "key", "_text", "score", "node", "group", "words", "host", "n_words", "kept", "bucket", "c0", "label"):
        df = df.withColumn(name, F.lit("x"))
    return df.repartition(3)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))

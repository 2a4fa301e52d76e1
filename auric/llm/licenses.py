r"""Licence scans with a positional index of rare words.

Templates are short licence phrases and sentences of licence texts.  The
documents give each word's frequency; a file is looked up by the rarest word
of each phrase, and only where it holds one are the postings (word, place) of
its licence words kept.

* A *phrase* template matches where all its words stand consecutively: the
  postings of its words, the rarest first, are shifted by their offsets and
  intersected.
* A *notice* has a mandatory key phrase, which is found in the same way.  Its
  place gives every other word of the notice a place, and the notice matches
  where at least `COVERAGE` of its words stand within `SLACK` words of theirs.

The order of lookups decides only the work: what a file matches depends on
its own words alone.

Everything happens within a row by array functions, so a scan needs no
shuffle beyond the count of the templates' words (a fixed, small set).

Defined cases: null and empty texts have no words, no places and score 0;
ties between equally rare words go to the smaller offset; a place found twice
counts once; repeated rows and ids each give a row; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The contract's phrases and labels.
BASE = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

#: Label, text and mandatory key phrase of longer notices.
NOTICES = (
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the "
            "gnu general public license as published by the free software foundation",
     "redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files", "permission is hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met",
     "redistribution and use in source and binary forms"),
    ("apache", "licensed under the apache license version 2 0 you may not use this file except in compliance "
               "with the license", "apache license version 2 0"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0",
     "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without "
            "fee is hereby granted", "permission to use copy modify"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "unencumbered software released into the public domain"),
    ("cc-by-sa", "creative commons attribution sharealike", "creative commons attribution sharealike"),
    ("epl", "eclipse public license", "eclipse public license"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the software", "this permission notice shall be included in all copies"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and "
            "the following disclaimer", "redistributions of source code must retain the above copyright notice"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the "
             "original software", "altered source versions must be plainly marked as such"),
    ("boost", "boost software license", "boost software license"),
    ("wtfpl", "do what the fuck you want to public license", "do what the fuck you want to public license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights "
            "to this work", "waived all copyright and related or neighboring rights"),
    ("cc-by-nc", "creative commons attribution noncommercial", "creative commons attribution noncommercial"),
    ("cc-by-nd", "creative commons attribution noderivatives", "creative commons attribution noderivatives"),
    ("artistic", "the artistic license", "the artistic license"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free "
             "documentation license", "gnu free documentation license"),
    ("ofl", "this font software is licensed under the sil open font license", "sil open font license"),
    ("psf", "python software foundation license", "python software foundation license"),
)

#: Share of a notice's words that must stand near the places that its key phrase gives them.
COVERAGE = 0.8
#: Words that may be inserted or missing between the key phrase and another word.
SLACK = 4

# Fixed value: the contract's word rule, on text with A-Z in lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_az(text: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    lower() does the same on text that is all ASCII, several times faster."""
    return F.when(text.rlike(r"[^\x00-\x7F]"),
                  F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.lower(text))


def word_array(text: Column) -> Column:
    return F.regexp_extract_all(lower_az(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[str, ...] = ()
    base: bool = False

    @property
    def phrase(self) -> tuple[str, ...]:
        """The words that must stand consecutively."""
        return self.words if self.base else self.key

    @property
    def offset(self) -> int:
        """The place of the phrase in the template."""
        n = len(self.phrase)
        return next(i for i in range(len(self.words)) if self.words[i:i + n] == self.phrase)

    def by_rarity(self, frequency: dict[str, int]) -> list[tuple[str, int]]:
        """The phrase's words with their offsets, the rarest first."""
        return sorted(((w, i) for i, w in enumerate(self.phrase)), key=lambda x: (frequency.get(x[0], 0), x[1]))


def templates() -> list[Template]:
    return [Template(label, tuple(text.split()), base=True) for label, text in BASE] + [
        Template(label, tuple(text.split()), tuple(key.split())) for label, text, key in NOTICES]


def _literal(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def word_frequency(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Documents that hold each word of the templates (a fixed, small set)."""
    found = words.select(F.explode(F.array_intersect("words", _literal(vocabulary))).alias("word"))
    return {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def _shifted(word: str, offset: int) -> Column:
    """Starts that a word's postings give a template that has it at `offset`."""
    here = F.filter("postings", lambda p: p["word"] == word)
    return F.transform(here, lambda p: p["at"] - offset)


def _phrase_starts(t: Template, frequency: dict[str, int]) -> Column:
    """Places where the template's phrase stands."""
    order = t.by_rarity(frequency)
    out = _shifted(*order[0])
    for word, offset in order[1:]:
        out = F.array_intersect(out, _shifted(word, offset))
    held = F.exists("postings", lambda p: p["word"] == order[0][0])
    return F.when(held, F.array_distinct(out)).otherwise(F.array().cast("array<int>"))


def _notice_matches(t: Template, frequency: dict[str, int]) -> Column:
    """(start, share of the notice's words) at every place of its key phrase that verifies."""
    placed = F.array(*[F.struct(F.lit(w).alias("word"), F.lit(i - t.offset).alias("at")) for i, w in enumerate(t.words)])

    def near(s: Column, word: Column) -> Column:
        low, high = F.greatest(s + word["at"] - SLACK, F.lit(0)), F.greatest(s + word["at"] + SLACK + 1, F.lit(0))
        return F.array_contains(F.slice("words", low + 1, high - low), word["word"])

    def verify(s: Column) -> Column:
        share = F.size(F.filter(placed, lambda word: near(s, word))) / F.lit(float(len(t.words)))
        return F.struct((s - t.offset).alias("start"), share.alias("share"))

    return F.filter(F.transform(_phrase_starts(t, frequency), verify), lambda m: m["share"] >= COVERAGE)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence findings of every row: its words, the places of base phrases,
    labels of base and other templates, and a score."""
    all_templates = templates()
    vocabulary = sorted({w for t in all_templates for w in t.phrase})
    words = docs.select(docs[id_col].alias("id"), word_array(docs[text_col]).alias("words"))
    frequency = word_frequency(words, vocabulary)
    anchors = sorted({t.by_rarity(frequency)[0][0] for t in all_templates})
    indexed = sorted({w for t in all_templates for w in t.phrase})
    # postings only where a file holds some template's rare word
    postings = F.when(
        F.arrays_overlap("words", _literal(anchors)),
        F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
                 lambda p: p["word"].isin(indexed))).otherwise(F.array().cast("array<struct<word:string,at:int>>"))
    found = words.withColumn("postings", postings)
    base = F.array(*[F.struct(F.lit(t.label).alias("label"), _phrase_starts(t, frequency).alias("starts"))
                     for t in all_templates if t.base])
    texts = F.array(*[F.struct(F.lit(t.label).alias("label"), _notice_matches(t, frequency).alias("hits"))
                      for t in all_templates if not t.base])
    none = F.size("postings") == 0
    found = found.select(
        "id", F.size("words").cast("long").alias("n_words"),
        F.when(~none, F.filter(base, lambda b: F.size(b["starts"]) > 0)).alias("base"),
        F.when(~none, F.filter(texts, lambda b: F.size(b["hits"]) > 0)).alias("texts"))
    starts = F.flatten(F.transform("base", lambda b: b["starts"]))
    base_labels = F.coalesce(F.array_distinct(F.transform("base", lambda b: b["label"])), F.array().cast("array<string>"))
    text_labels = F.coalesce(F.array_distinct(F.transform("texts", lambda b: b["label"])), F.array().cast("array<string>"))
    best = F.coalesce(F.array_max(F.flatten(F.transform(
        "texts", lambda b: F.transform(b["hits"], lambda h: h["share"])))), F.lit(0.0))
    return found.select(
        F.col("id").alias(id_col), "n_words",
        F.coalesce(F.size(starts), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, text_labels)), ",").alias("labels"),
        F.when(F.size(base_labels) > 0, 1.0).otherwise(best).cast("double").alias("score"),
        F.coalesce(F.transform("texts", lambda b: F.struct(
            b["label"].alias("label"), F.transform(b["hits"], lambda h: h["start"].cast("long")).alias("starts"))),
            F.array().cast("array<struct<label:string,starts:array<bigint>>>")).alias("notices"))

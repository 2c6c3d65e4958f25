"""Licence notices in texts: a positional index of rare licence words over templates.

Everything on the way is a DataFrame expression. The words of all templates are weighed by their inverse document
frequency in the corpus, and each template is indexed under the rarest of its own words, however frequent these
are. All of a text's indexed words are looked up in the postings; each puts a template at a place of the text, which
stands only if the template's mandatory phrase is there. Postings that put a template at the same place are intersected,
and a template whose share of matched weight is large enough there labels the text. Base phrases are counted beside, by
a plain pattern.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Base phrases with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Label, opening words of the public licence text or usual notice, mandatory phrase in it.
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "licensed under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files", "hereby granted free of charge"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in "
                   "compliance with the license", "not use this file except in compliance"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted", "and or distribute this software for any purpose"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3",
     "gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license", "gnu general public license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu "
             "lesser general public license", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     "mozilla public license v 2 0"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", "cc by nd 4 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license",
     "creative commons attribution 4 0 international"),
    ("cc-by-sa-4.0", "licensed under a creative commons attribution sharealike 4 0 international license",
     "creative commons attribution sharealike 4 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "unencumbered software released into the public domain"),
)

# Characters of words before the letters A to Z are lowered, and the ones between words.
_IN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_OUT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
RAREST = 4
"""So many of a template's words are indexed, those in the fewest texts; of equal ones the first by code points."""
SHARE = 0.6
"""Share of a template's rare weight that must be matched at one place."""


@dataclass
class Template:
    label: str
    words: list[str]
    phrase: list[str]

    @property
    def phrase_at(self) -> int:
        return next(
            i for i in range(len(self.words)) if self.words[i : i + len(self.phrase)] == self.phrase
        )


def templates(given=TEMPLATES) -> list[Template]:
    return [Template(label, text.split(), phrase.split()) for label, text, phrase in given]


# ---- words of a text -----------------------------------------------------------------------------


def _words(body: Column) -> Column:
    """All words in order; case as it stands. Only the ends of a split can be empty."""
    return F.filter(F.split(body, f"{_OUT}+", -1), lambda w: w != "")


def _count(body: Column) -> Column:
    return F.regexp_count(body, F.lit(f"{_IN}+")).cast("long")


def _ascii_lower(word: Column) -> Column:
    """Lower case; null for a word with other characters than ASCII, which is in no template."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word))


def base_pattern() -> str:
    phrases = "|".join(f"{_OUT}++".join(p.split()) for p in BASE)
    return f"(?i)(?<!{_IN})(?:{phrases})(?!{_IN})"


def base_counts(rows: DataFrame, body: Column) -> DataFrame:
    """n_words, n_base, first_word, last_word, _base (labels) added; no two base phrases can overlap."""
    pattern = base_pattern()
    rows = rows.withColumns({"n_words": _count(body), "_match": F.regexp_extract_all(body, F.lit(pattern), F.lit(0))})
    rows = rows.withColumn("_between", F.when(F.size("_match") > 0, F.split(body, pattern, -1)))
    first = F.when(F.size("_match") > 0, _count(F.get("_between", F.lit(0))))
    last = F.when(
        F.size("_match") > 0,
        F.col("n_words") - _count(F.element_at("_between", -1)) - _count(F.element_at("_match", -1)),
    )
    def named(match: Column) -> Column:
        out = F.lit(None).cast("string")
        for phrase, name in BASE.items():
            head = phrase.split()[0]
            out = F.when(F.lower(F.substring(match, 1, len(head))) == head, F.lit(name)).otherwise(out)
        return out

    return rows.withColumns(
        {
            "n_base": F.size("_match").cast("long"),
            "first_word": first,
            "last_word": last,
            "_base": F.array_sort(F.array_distinct(F.transform("_match", named))),
        }
    ).drop("_match", "_between")


# ---- the index -----------------------------------------------------------------------------------


def document_frequencies(df: DataFrame, body: Column, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of texts, and how many hold each word of the templates. The driver gets a row per such word."""
    words = df.select(F.explode(F.array_distinct(_words(body))).alias("word"))
    found = words.select(_ascii_lower(F.col("word")).alias("word")).where(F.col("word").isin(vocabulary))
    counts = found.groupBy("word").count().collect()
    return df.count(), {r[0]: r[1] for r in counts}


def rarest(template: Template, frequency: dict[str, int]) -> list[str]:
    """The template's words in the fewest texts, of those that any text has."""
    own = {w for w in template.words if frequency.get(w)}
    return sorted(own, key=lambda w: (frequency[w], w))[:RAREST]


def weight(word: str, total: int, frequency: dict[str, int]) -> float:
    return math.log((total + 1) / (frequency[word] + 1)) + 1e-3


def _postings(spark: SparkSession, known: list[Template], total: int, frequency: dict[str, int]) -> DataFrame:
    """(word, template, label, at, weight, whole, phrase_at, phrase): bounded by the templates' own words."""
    rows = []
    for number, template in enumerate(known):
        indexed = rarest(template, frequency)
        own = [(w, i) for i, w in enumerate(template.words) if w in indexed]
        whole = sum(weight(w, total, frequency) for w, _ in own)
        rows += [
            (w, number, template.label, i, weight(w, total, frequency), whole, template.phrase_at, template.phrase) for w, i in own
        ]
    schema = "word string, template int, label string, at int, weight double, whole double, phrase_at int, phrase array<string>"
    return spark.createDataFrame(rows, schema)


def template_labels(df: DataFrame, key: list[str], text: str, known: list[Template]) -> DataFrame:
    """(key columns, labels, share) of the texts in which a template is found; key must tell texts apart."""
    body = F.col(f"`{text}`")
    total, frequency = document_frequencies(df, body, sorted({w for t in known for w in t.words}))
    # A template whose mandatory phrase has a word that no text holds can't be verified anywhere.
    able = [t for t in known if all(frequency.get(w) for w in t.phrase)]
    if not able:
        return df.select(*key).where("false").withColumns({"labels": F.array().cast("array<string>"), "share": F.lit(0.0)})
    indexed = sorted({w for t in able for w in rarest(t, frequency)})
    words = df.select(*key, _words(body).alias("words"))
    positioned = words.select(*key, "words", F.posexplode("words").alias("place", "word"))
    hits = positioned.withColumn("word", _ascii_lower(F.col("word"))).where(F.col("word").isin(indexed))
    # The phrase is compared where the hit is found, so a word that is frequent elsewhere goes no further.
    at = F.col("place") - F.col("at") + F.col("phrase_at")
    there = F.transform(F.slice("words", F.greatest(at, F.lit(0)) + 1, F.size("phrase")), _ascii_lower)
    matched = (
        hits.join(F.broadcast(_postings(df.sparkSession, able, total, frequency)), "word")
        .where((F.col("place") >= F.col("at")) & (there == F.col("phrase")))
        .select(*key, "template", "label", (F.col("place") - F.col("at")).alias("offset"), "at", "weight", "whole")
        .distinct()
    )
    # Weights are added in order of their places, so that equal texts get equal shares.
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("at", "weight"))), lambda x: x["weight"])
    places = matched.groupBy(*key, "template", "label", "offset").agg(
        (F.aggregate(ordered, F.lit(0.0), lambda a, x: a + x) / F.max("whole")).alias("share")
    )
    return places.where(F.col("share") >= SHARE).groupBy(*key).agg(
        F.collect_set("label").alias("labels"), F.least(F.lit(1.0), F.max("share")).alias("share")
    )


def scan(df: DataFrame, text: str = "text", known: list[Template] | None = None) -> DataFrame:
    """The rows of df without their text, with n_words, n_base, first_word, last_word, base_labels, labels, score,
    which replace columns of these names.

    base_labels and labels are sorted arrays, the latter with the method's labels too. score is 1 with a base
    phrase, else the largest matched share of a found template, else 0. A null text is empty. Rows with equal
    texts get equal results. The template index sees each distinct text once, by its 128-bit hash.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    added = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    kept = [c for c in df.columns if c != text and c.lower() not in added]
    rows = df.select(F.struct(F.lit(0), *[F.col(f"`{c}`") for c in kept]).alias("_row"), body.alias("_text")).withColumns(
        {"_a": F.xxhash64("_text"), "_b": F.xxhash64(F.lit("licence"), F.col("_text"))}
    )
    found = template_labels(rows.select("_a", "_b", "_text"), ["_a", "_b"], "_text", known or templates())
    based = base_counts(rows, F.col("_text")).drop("_text")
    joined = based.join(found, ["_a", "_b"], "left")
    nothing = F.array().cast("array<string>")
    return joined.select(
        *[F.col("_row").getField(c).alias(c) for c in kept], "n_words", "n_base", "first_word", "last_word",
        F.col("_base").alias("base_labels"),
        F.array_sort(F.array_union("_base", F.coalesce("labels", nothing))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )

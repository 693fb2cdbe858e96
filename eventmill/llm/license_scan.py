"""License scan: an exact containment join of text blocks with license templates.

A block is a line of a document, a template a license sentence; both are sets of words. A block
matches a template when it holds at least ``THRESHOLD`` of the template's words. Texts are split into
words once; what the rest needs of them is a narrow table. The join is the prefix-filter
set-similarity join: the words of all templates are ordered by how many blocks of the whole corpus
(those long enough to match any template) hold them, rarest first; a block that matches must hold one of the template's first
``size - need + 1`` words (prefix filter), must have at least ``need`` words (length filter), and
from the position of its first common word on, both sides must still have enough words (positional
filter). What is left is verified by the exact overlap.

Only words of templates are ordered: a word outside every template never counts towards an overlap,
so a block is its words within the templates' vocabulary, and its position is counted there. The
templates are constants of this module, so the broadcast of their index has a fixed size.

Everything is DataFrame functions. Defined results: a null or empty text has no words and no match;
repeated rows are scanned each; rows agreeing in doc_id and text get the same result; an empty
table gives an empty result (and frequencies of 0); other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm.common import ascii_lower, documents, whole
from eventmill.session import written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.9

#: Phrases whose words must stand consecutively, and their labels.
PHRASES = (
    (("mit", "license"), "mit"),
    (("apache", "license"), "apache"),
    (("general", "public", "license"), "gpl"),
)

#: License sentences, and the label a match adds.
TEMPLATES = (
    ("Released under the MIT License.", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files", "mit"),
    ("Licensed under the Apache License, Version 2.0.", "apache"),
    ("You may not use this file except in compliance with the License. You may obtain a copy of "
     "the License at http://www.apache.org/licenses/LICENSE-2.0", "apache"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of "
     "the GNU General Public License as published by the Free Software Foundation", "gpl"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of "
     "the GNU Lesser General Public License", "lgpl"),
    ("Licensed under CC BY 4.0.", "cc-by"),
    ("Licensed under CC BY-SA 4.0.", "cc-by-sa"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("Licensed under CC BY-ND 4.0.", "cc-by-nd"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.",
     "cc-by"),
    ("This work is dedicated to the public domain under CC0 1.0 Universal.", "cc0"),
    ("Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
     "mpl"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("All rights reserved.", "all-rights-reserved"),
)


def _python_words(text: str) -> list[str]:
    import re

    return re.findall(WORD, text.lower())


def template_sets(templates=TEMPLATES) -> list[tuple[int, str, list[str]]]:
    return [
        (number, label, sorted(set(_python_words(text))))
        for number, (text, label) in enumerate(templates)
    ]


def needed(size: int, threshold: float) -> int:
    """The least overlap that meets the containment threshold."""
    need = int(size * threshold)
    return max(1, need if need >= size * threshold - 1e-9 else need + 1)


def scanned(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of (doc_id, text) in one pass over its words: their number, the places of each
    phrase, and its blocks (``blocks``), each as its set of template words.

    Blocks with fewer of these words than any template needs are left out (length filter). The rows
    are written, since counts, candidates and the report all read them.
    """
    sets = template_sets(templates)
    vocabulary = sorted({w for _, _, own in sets for w in own})
    least = min(needed(len(own), threshold) for _, _, own in sets)
    lines = F.transform(
        F.split(ascii_lower(whole("text")), "\n", -1),
        lambda line: F.regexp_extract_all(line, F.lit(WORD), F.lit(0)),
    )
    known = F.transform(
        "lines", lambda line: F.array_distinct(F.filter(line, lambda w: w.isin(vocabulary)))
    )
    empty = F.array().cast("array<int>")
    starts = [
        F.when(F.array_contains("words", phrase[0]), phrase_starts(F.col("words"), phrase))
        .otherwise(empty)
        .alias(f"p{i}")
        for i, (phrase, _) in enumerate(PHRASES)
    ]
    worded = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), lines.alias("lines"))
    split = worded.select("doc_id", "text_hash", "lines", F.flatten("lines").alias("words"))
    return written(
        split.select(
            "doc_id",
            "text_hash",
            F.size("words").cast("long").alias("n_words"),
            *starts,
            F.filter(known, lambda held: F.size(held) >= least).alias("blocks"),
        ),
        "license-words",
    )


def word_order(held: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary, rarest in the corpus first. One count per template word is collected."""
    counts = dict(
        held.select(F.explode("held").alias("word")).groupBy("word").count().collect()
    )
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def license_matches(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Every (doc_id, text_hash, label, containment) of a block and a template it matches."""
    return matches(scanned(docs, templates, threshold), templates, threshold)


def matches(rows: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """:func:`license_matches` of scanned rows."""
    sets = template_sets(templates)
    vocabulary = sorted({w for _, _, own in sets for w in own})
    held = rows.select("doc_id", "text_hash", F.explode("blocks").alias("held"))
    order = word_order(held, vocabulary)
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for number, label, own in sets:
        own = sorted(own, key=rank.__getitem__)
        need = needed(len(own), threshold)
        for place, word in enumerate(own[: len(own) - need + 1]):
            index.append((word, place, number, label, own, need))
    entries = F.array(
        *[
            F.struct(
                F.lit(word).alias("word"),
                F.lit(place).alias("place"),
                F.lit(number).alias("template"),
                F.lit(label).alias("label"),
                F.array(*[F.lit(w) for w in own]).alias("own"),
                F.lit(need).alias("need"),
            )
            for word, place, number, label, own, need in index
        ]
    )
    postings = rows.sparkSession.range(1).select(F.inline(entries))
    firsts = F.array(*[F.lit(w) for w in sorted({e[0] for e in index}, key=rank.__getitem__)])
    ordered = F.array(*[F.lit(w) for w in order])
    # array_intersect keeps the order of its first side: the block in global order.
    candidates = (
        held.where(F.arrays_overlap("held", firsts))
        .select("doc_id", "text_hash", F.array_intersect(ordered, F.col("held")).alias("block"))
        .select("*", F.posexplode("block").alias("at", "word"))
        .join(F.broadcast(postings), "word")
        .where(F.size("block") >= F.col("need"))
        .where(
            F.least(F.size("block") - F.col("at"), F.size("own") - F.col("place"))
            >= F.col("need")
        )
    )
    overlap = F.size(F.array_intersect("block", "own"))
    return (
        candidates.withColumn("overlap", overlap)
        .where(F.col("overlap") >= F.col("need"))
        .select(
            "doc_id", "text_hash", "label", (F.col("overlap") / F.size("own")).alias("containment")
        )
    )


def phrase_starts(all_words: Column, phrase: tuple[str, ...]) -> Column:
    """The word numbers at which a phrase stands."""
    size = F.size(all_words)
    places = F.filter(
        F.transform(
            all_words,
            lambda w, i: F.when((w == phrase[0]) & (i <= size - len(phrase)), i),
        ),
        lambda i: i.isNotNull(),
    )
    return F.filter(
        places,
        lambda i: _all([F.get(all_words, i + k) == word for k, word in enumerate(phrase) if k]),
    )


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def license_scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Phrases and template matches of every row of (doc_id, text)."""
    counted = scanned(docs.select("doc_id", "text"), templates, threshold)
    found = (
        matches(counted, templates, threshold)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("label").alias("labels"), F.max("containment").alias("containment"))
    )
    every = F.concat(*[F.col(f"p{i}") for i in range(len(PHRASES))])
    base = F.array_compact(
        F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(k)) for i, (_, k) in enumerate(PHRASES)])
    )
    rows = counted.select(
        "doc_id",
        "text_hash",
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_distinct(base).alias("base"),
    )
    joined = rows.alias("r").join(
        found.alias("f"),
        F.col("r.doc_id").eqNullSafe(F.col("f.doc_id"))
        & (F.col("r.text_hash") == F.col("f.text_hash")),
        "left",
    )
    return joined.select(
        "r.doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(
            F.array_sort(
                F.array_union("base", F.coalesce("labels", F.array().cast("array<string>")))
            ),
            ",",
        ).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0))
        .otherwise(F.coalesce("containment", F.lit(0.0)))
        .alias("score"),
    )


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


QUERIES = {"op1_license_scan": op1_license_scan}


def _oracle() -> str:
    phrase_rows = []
    for phrase, label in PHRASES:
        test = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(phrase))
        phrase_rows.append(f"SELECT r, i - 1 AS start, '{label}' AS label FROM placed WHERE {test}")
    values = ", ".join(
        f"({n}, '{label}', [{', '.join(repr(w) for w in own)}], {needed(len(own), THRESHOLD)})"
        for n, label, own in template_sets()
    )
    lower = (
        "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    )
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, {lower.format("coalesce(text, '')")} AS t
  FROM documents),
worded AS (SELECT r, doc_id, t, regexp_extract_all(t, '{word}') AS w FROM rows),
placed AS (SELECT r, w, unnest(generate_series(1, len(w))) AS i FROM worded
           WHERE list_contains(w, 'license')),
phrases AS ({" UNION ALL ".join(phrase_rows)}),
base AS (
  SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
         list_sort(list_distinct(list(label))) AS labels
  FROM phrases GROUP BY r),
templates(n, label, own, need) AS (VALUES {values}),
blocks AS (
  SELECT r, regexp_extract_all(unnest(string_split(t, chr(10))), '{word}') AS held FROM worded),
matched AS (
  SELECT b.r, t.label, len(list_intersect(t.own, b.held)) / len(t.own) AS containment
  FROM blocks b, templates t
  WHERE len(list_intersect(t.own, b.held)) >= t.need),
method AS (
  SELECT r, list_sort(list_distinct(list(label))) AS labels, max(containment) AS containment
  FROM matched GROUP BY r)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(b.n_base, 0) AS n_base,
       CAST(b.first_word AS BIGINT) AS first_word, CAST(b.last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(b.labels, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(
         list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ',') AS labels,
       CASE WHEN b.n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(m.containment, 0.0)::DOUBLE END AS score
FROM worded w LEFT JOIN base b ON b.r = w.r LEFT JOIN method m ON m.r = w.r
"""


ORACLE = {"op1_license_scan": _oracle()}

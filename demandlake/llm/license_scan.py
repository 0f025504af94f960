"""License scan by a positional rare-token index, in DataFrame functions only.

Licence templates, an argument, form an index: word -> (template, position).
Word weights (IDF) come from document frequencies over the whole corpus.
Each template is indexed by its rarest places, so many that an alignment that
misses them all misses too many words (see ``index_places``); which words
these are decides only how much is looked up, never what is found.  Every
word of every file is looked up.  A posting gives a relative position (place
in the file minus place in the template); each such alignment is a candidate
and is verified on all words of the template.  One with MIN_TENTHS of them in
place counts if, last, the template's mandatory key phrase stands there.

Independently of the index, three base phrases are found everywhere.

Defined results: null text counts as empty; without words first_word,
last_word are null, labels empty, score 0; repeated rows get equal results;
an empty table gives an empty result.  ``score`` is the share of the
template's words that the best confirmed alignment holds (a base label alone
scores BASE_SCORE).  A file's result depends on its own text only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.llm.tables import let, lower_ascii, running, text_or_empty

#: Characters between words (after lower-casing): ASCII but digits and a-z.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Fixed values: (label, notice, mandatory key phrase), in lower-case words.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", "apache org licenses license 2 0"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "permission is hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license", "gnu affero general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0 international"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)

#: Tenths of a template's words that an alignment must hold.
MIN_TENTHS = 6
BASE_SCORE = 0.5
#: Alignments are numbers: template * SHIFT_BASE + relative position + SHIFT_ZERO.
SHIFT_BASE, SHIFT_ZERO = 1 << 40, 1 << 20


def words_of(text: Column) -> Column:
    """The words of a text as an array."""
    return F.array_remove(F.split(lower_ascii(text), SEPARATOR), "")


def _spaced(words: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))


def _places(phrase: str) -> Column:
    """Start words of a phrase: split the spaced text at it, count words before."""
    n = len(phrase.split())
    # every piece but the last is followed by the phrase; the spaces around it belong to the pieces
    pieces = F.split(F.regexp_replace("spaced", f"(?<= ){phrase}(?= )", "\x00"), "\x00")
    word_count = lambda s: F.length(F.trim(s)) - F.length(F.replace(F.trim(s), F.lit(" "), F.lit(""))) + F.when(F.trim(s) == "", 0).otherwise(1)
    before = lambda p: F.transform(F.slice(p, 1, F.size(p) - 1), word_count)
    starts = lambda k: F.zip_with(running(F.transform(k, lambda x: (x + n).cast("int"))), k, lambda at, x: (at + x).cast("int"))
    found = let(let(pieces, before), starts)
    return F.when(F.contains("spaced", F.lit(f" {phrase} ")), found).otherwise(F.array().cast("array<int>"))


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def index_places(df: dict[str, int], templates=TEMPLATES) -> dict[str, list[tuple[int, int]]]:
    """word -> (template, place) of the rarest places of each template.  An
    alignment holds at least ``need`` of a template's n words, so it misses at
    most n - need places and meets one of any n - need + 1."""
    post: dict[str, list[tuple[int, int]]] = {}
    for t, (_, text, _) in enumerate(templates):
        w = text.split()
        need = -(-len(w) * MIN_TENTHS // 10)
        for at in sorted(range(len(w)), key=lambda i: (df.get(w[i], 0), w[i], i))[: len(w) - need + 1]:
            post.setdefault(w[at], []).append((t, at))
    return post


def _confirmed(df: dict[str, int], templates) -> Column:
    """Array of (label, share): the confirmed alignments of ``words``."""
    post = index_places(df, templates)
    lookup = F.create_map(*[c for w, at in sorted(post.items()) for c in (F.lit(w), F.array(*[F.lit(t * SHIFT_BASE - i + SHIFT_ZERO) for t, i in at]))])
    at = lambda i: F.get("words", i)
    hits = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: at(i).isin(sorted(post)))
    found = F.array_distinct(F.flatten(F.transform(hits, lambda i: F.transform(F.element_at(lookup, at(i)), lambda c: c + i))))
    keys, labels = _array([f" {key} " for _, _, key in templates]), _array([label for label, _, _ in templates])
    texts = F.array(*[_array(text.split()) for _, text, _ in templates])

    def verify(c):
        t = F.floor(c / SHIFT_BASE).cast("int") + 1
        shift = (F.pmod(c, F.lit(SHIFT_BASE)) - SHIFT_ZERO).cast("int")
        text = F.element_at(texts, t)
        cut = F.greatest(F.lit(0), -shift)  # template words before the file's start
        around = F.slice("words", F.greatest(F.lit(0), shift) + 1, F.size(text) - cut)
        votes = F.size(F.filter(F.zip_with(around, F.slice(text, cut + 1, F.size(text) - cut), lambda a, b: a == b), lambda x: x))
        good = (votes * 10 >= F.size(text) * MIN_TENTHS) & F.contains(_spaced(around), F.element_at(keys, t))
        return F.when(good, F.struct(F.element_at(labels, t).alias("label"), (votes / F.size(text)).alias("share")))

    confirmed = F.filter(F.transform(found, verify), lambda x: x.isNotNull())
    return F.when(F.arrays_overlap("words", _array(sorted(post))), confirmed)  # null: no indexed word at all


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score.  ``templates`` are (label, notice, key phrase) in lower-case words;
    texts are read once for the words' frequencies and once for the scan."""
    vocabulary = sorted({w for _, text, _ in templates for w in text.split()})
    words = docs.select("doc_id", words_of(text_or_empty()).alias("words"))
    known = words.select(F.explode(F.array_intersect(_array(vocabulary), "words")).alias("word"))
    df = known.groupBy("word").agg(F.count(F.lit(1)).alias("df")).collect()  # the templates' vocabulary at most
    rows = words.withColumn("spaced", _spaced(F.col("words")))
    base = F.array(*[_places(p) for p in BASE])
    seen = rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), base.alias("base"), _confirmed({r["word"]: r["df"] for r in df}, templates).alias("confirmed")
    )
    places = F.flatten("base")
    base_labels = F.array_sort(F.filter(F.transform(F.arrays_zip("base", _array(BASE.values()).alias("label")), lambda x: F.when(F.size(x["base"]) > 0, x["label"])), lambda x: x.isNotNull()))
    out = seen.select("doc_id", "n_words", places.alias("places"), base_labels.alias("base_labels"), "confirmed")
    labels = F.array_sort(F.array_union("base_labels", F.coalesce(F.col("confirmed")["label"], F.array().cast("array<string>"))))
    base_score = F.when(F.size("base_labels") > 0, F.lit(BASE_SCORE)).otherwise(0.0)
    return out.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce(F.array_max(F.col("confirmed")["share"]), F.lit(0.0)), base_score).cast("double").alias("score"),
    )

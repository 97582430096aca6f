"""Licence scans: an exact set-similarity join of text blocks with licence templates, in SQL functions only.

A template is the set of words of a usual notice. It matches a text if ``threshold`` of its words stand in a
window of twice as many consecutive words as the notice has, wherever lines end, among them the word that
tells the notice from those of other licences, if it has one. Every window of every text counts.

Texts are cut into blocks of ``BLOCK`` words, each with the next one, so that every window lies in one of them. Words of all
templates are ordered by how many texts of the whole corpus hold them, rarest first. Of the words that a block and a template share,
the first in that order is one of the template's first |T| - need + 1 words if the template matches, so

* prefix: blocks are joined with templates on those words alone, and a text that holds none of them is not even cut;
* length: the block must hold ``need`` different words;
* position: behind that first shared word, enough words of both must be left;

and what passes is verified in all windows of the block. Blocks are bounded, whatever the length of the text, and are never shuffled.

Besides, the base phrases are located as consecutive words anywhere in the text. A missing or empty text
has no words and no labels. Repeated rows and null doc_ids keep a row each; an empty table gives none. Columns besides doc_id
and text are never read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, functions as F

from harborlake.llm.common import IDENTITY, LOWER, UPPER, identity, same_text, stored, texts

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wording of usual notices, and their labels.
TEMPLATES = (
    ("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"),
    ("apache", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

# The word that a window must hold, for notices that differ little from others.
TELLING = {"agpl": "affero", "apache": "apache", "apache-2.0": "apache", "cc-by-nc-4.0": "nc", "cc-by-sa": "sharealike", "gpl-3.0": "3", "mpl": "mozilla"}
SHORT = 8  # words; of shorter notices, the label's first part is the telling word if none is given
WINDOW = 2  # words of a window for each word of the notice
BLOCK = 128  # words, at least as many as the longest window has


def telling_word(label: str, text: str) -> str | None:
    return TELLING.get(label) or (label.split("-")[0] if len(notice(text)) < SHORT else None)


def notice(text: str) -> list[str]:
    return re.sub(SEPARATORS, " ", text.lower()).split()


def template_words(text: str) -> set[str]:
    return set(re.sub(SEPARATORS, " ", text.lower()).split())


def _lowered() -> Column:
    return F.translate("text", UPPER, LOWER)


def _blanks(column: Column) -> Column:
    return F.char_length(column) - F.char_length(F.replace(column, F.lit(" "), F.lit("")))


def _places(phrase: str) -> Column:
    """Of a phrase, number of places and the first and last word where it starts; nulls if it has none."""
    around = F.split("plain", f" {phrase}(?= )", -1)
    size = len(phrase.split())
    found = F.struct(
        (F.size(around) - 1).cast("long").alias("n"),
        _blanks(F.get(around, F.lit(0))).cast("long").alias("first"),
        (F.col("n_words") - size - _blanks(F.element_at(around, -1)) + 1).cast("long").alias("last"),
    )
    return F.when(F.col("plain").contains(f" {phrase} "), found)


def _plain() -> Column:
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(_lowered(), SEPARATORS, " ")), F.lit(" "))


def _literals(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _fenced(value: Column) -> Column:
    """A generator of one row, whose column is made once however often it is used."""
    return F.explode(F.array(value))


def scanned(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """One row per document: doc_id, t, u, n_words, places of each phrase, and which words of the templates it holds."""
    n_words = F.when(F.col("plain") == "  ", 0).otherwise(_blanks(F.col("plain")) - 1).cast("long")
    return (
        texts(docs)
        .select(*identity(), _fenced(_plain()).alias("plain"))
        .withColumn("n_words", n_words)
        .select(
            *IDENTITY,
            "n_words",
            F.array(*[_places(p) for p in PHRASES]).alias("places"),
            F.array_intersect(F.split("plain", " "), _literals(vocabulary)).alias("known"),
        )
    )


def blocks(docs: DataFrame, wanted: list[str]) -> DataFrame:
    """(doc_id, t, u, words): blocks of texts that hold one of the ``wanted`` words, as far as they hold one themselves."""
    whole = texts(docs).select(*identity(), _fenced(_plain()).alias("plain"))
    whole = whole.where(F.arrays_overlap(F.split("plain", " "), _literals(wanted)))
    pieces = F.regexp_extract_all(F.ltrim("plain"), F.lit(r"(?:[^ ]++ ){1,%d}" % BLOCK), F.lit(0))
    cut = whole.select(*IDENTITY, _fenced(pieces).alias("pieces"))
    paired = F.transform("pieces", lambda piece, n: F.concat(piece, F.coalesce(F.get("pieces", n + 1), F.lit(""))))
    words = cut.select(*IDENTITY, F.explode(paired).alias("block")).select(*IDENTITY, _fenced(F.split(F.trim("block"), " ")).alias("words"))
    return words.where(F.arrays_overlap("words", _literals(wanted)))


def _shared(words: Column, target: Column, window: Column, telling: Column) -> Column:
    """Most words of ``target`` that one window of ``words`` holds, where it holds the telling one."""
    hits = F.filter(F.transform(words, lambda w, n: F.struct(n.alias("n"), w.alias("w"))), lambda h: F.array_contains(target, h.w))

    def best(hits: Column) -> Column:
        def held(h: Column, i: Column) -> Column:
            near = F.filter(F.slice(hits, i + 1, window), lambda x: x.n < h.n + window)
            # a step over one element, so that the window's words are made once
            own = F.array(F.array_distinct(F.transform(near, lambda x: x.w)))
            return F.get(F.transform(own, lambda o: F.when(telling.isNull() | F.array_contains(o, telling), F.size(o)).otherwise(0)), F.lit(0))

        return F.coalesce(F.array_max(F.transform(hits, held)), F.lit(0))

    return F.get(F.transform(F.array(hits), best), F.lit(0))


def candidates(found: DataFrame, templates: DataFrame, rank: dict[str, int]) -> DataFrame:
    """Blocks with the templates that they may match: one row for each pair that passes the three filters.

    ``templates`` has a row for each word of each prefix: rank, i (its place in the template), label, need, ordered (ranks of
    the whole template), target (its words), window, telling.
    """
    ranks = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    known = F.array_intersect("words", _literals(rank))
    in_order = found.select("*", F.size(F.array_distinct("words")).alias("size"), _fenced(F.array_sort(F.transform(known, lambda w: ranks[w]))).alias("ranks"))
    pairs = in_order.select("*", F.posexplode("ranks").alias("j", "rank")).join(F.broadcast(templates), "rank")  # a row a word of the templates
    length = F.col("size") >= F.col("need")
    position = F.least(F.size("ordered") - F.col("i"), F.size("ranks") - F.col("j")) >= F.col("need")
    first = F.col("rank") == F.array_min(F.array_intersect("ranks", "ordered"))
    return pairs.where(length & position & first)


def matches(docs: DataFrame, base: DataFrame, templates, threshold: float) -> DataFrame:
    """(doc_id, t, u, label, share): templates that a text matches, and the share of their words in its best window."""
    sets = [(label, sorted(template_words(text)), WINDOW * len(notice(text)), telling_word(label, text)) for label, text in templates]
    if max((window for *_, window, _ in sets), default=0) > BLOCK:
        raise ValueError(f"a template has more than {BLOCK // WINDOW} words")
    # One row for each word of the templates, so it is bounded by them.
    counts = {r.word: r["count"] for r in base.select(F.explode("known").alias("word")).groupBy("word").count().collect()}
    vocabulary = {w for _, words, *_ in sets for w in words}
    rank = {w: n for n, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    prefixes = []
    for label, words, window, telling in sets:
        need = math.ceil(threshold * len(words) - 1e-9)
        ordered = sorted(rank[w] for w in words)
        prefixes += [(r, i, label, need, ordered, words, window, telling) for i, r in enumerate(ordered[: len(ordered) - need + 1])]
    schema = "rank int, i int, label string, need int, ordered array<int>, target array<string>, window int, telling string"
    wanted = {r for r, *_ in prefixes}
    pairs = candidates(
        blocks(docs, [w for w, r in rank.items() if r in wanted]), docs.sparkSession.createDataFrame(prefixes, schema), rank
    )
    shared = _shared(F.col("words"), F.col("target"), F.col("window"), F.col("telling"))
    verified = pairs.select(*IDENTITY, "label", "need", F.size("target").alias("of"), shared.alias("shared")).where("shared >= need")
    return verified.select(*IDENTITY, "label", (F.col("shared") / F.col("of")).alias("share"))


def licence_labels(docs: DataFrame, *, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is the share of the best matching template that a window holds; a base phrase counts as whole.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(scanned(docs, sorted({w for _, text in templates for w in template_words(text)})), "licence_texts")
    found = matches(docs, rows, templates, threshold)
    found = found.groupBy(*IDENTITY).agg(F.collect_set("label").alias("found"), F.max("share").alias("share"))
    standing = F.array_compact(F.transform("places", lambda p: p))
    base = F.array_compact(F.array(*[F.when(F.get("places", F.lit(n)).isNotNull(), F.lit(label)) for n, label in enumerate(PHRASES.values())]))
    n_base = F.aggregate(standing, F.lit(0).cast("long"), lambda a, p: a + p.n)
    none = F.array().cast("array<string>")
    return rows.alias("l").join(found.alias("r"), same_text(), "left").select(
        "l.doc_id",
        "n_words",
        n_base.alias("n_base"),
        F.array_min(F.transform(standing, lambda p: p.first)).alias("first_word"),
        F.array_max(F.transform(standing, lambda p: p.last)).alias("last_word"),
        F.concat_ws(",", F.array_sort(base)).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(base, F.coalesce("found", none)))).alias("labels"),
        F.when(n_base > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )

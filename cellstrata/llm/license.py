"""License scans by a positional index of rare words, in built-in functions only.

A file's words are looked up in the vocabulary of the licence templates. Around
each place of a template's first mandatory phrase, the template's words with
the highest inverse document frequency, counted over the whole corpus, are
looked up in its postings; postings are intersected by relative position
(template position less file position), and a template counts if enough of its
places agree on one offset and all its mandatory phrases stand in the file.
Each template and place has rarest words of its own, so other licences and
other text of the file take nothing away from it.

Null and empty texts have no words and no labels. Repeated rows and ties (equal
frequencies go by the word) get equal results. Columns other than doc_id and
text are not read, so their names can't clash. Texts are read whole. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, bound

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Fixed phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Fixed template passages: label, words, mandatory phrases.
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license",)),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("gpl-2.0", "this program is licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("lgpl", "gnu lesser general public license as published by the free software foundation", ("lesser general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights under cc0", ("cc0",)),
    ("mit-notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", ("above copyright notice and this permission notice",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ("permission to use copy modify",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", ("in no event will the authors be held liable",)),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software", ("free and unencumbered software",)),
    ("agpl-3.0", "gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version", ("affero general public license",)),
    ("apache-2.0-notice", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("except in compliance with the license",)),
    ("bsl-1.0", "distributed under the boost software license version 1 0", ("boost software license",)),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ("neither the name of", "endorse or promote products")),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0", ("eclipse public license",)),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("proprietary", "copyright all rights reserved", ("all rights reserved",)),
)

#: How many of a template's rarest words near a mandatory phrase are looked up, and the share of a template's looked-up words that must agree on one offset.
RAREST, AGREE = 8, 0.6


def postings() -> dict[str, list[tuple[int, int]]]:
    """word: (template, position), from the fixed templates."""
    found = defaultdict(list)
    for t, (_, words, _) in enumerate(TEMPLATES):
        for at, word in enumerate(words.split()):
            found[word].append((t, at))
    return dict(found)


def normal(text: Column) -> Column:
    """Lower-cased words between single blanks, with one at either end; one blank if there are none."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), NOT_WORD, " ")


def words_in(line: Column) -> Column:
    return F.array_remove(F.split(line, " "), "")


def has(line: Column, phrase: str) -> Column:
    return F.contains(line, F.lit(f" {phrase} "))


def places(words: Column, phrase: str) -> Column:
    """Positions at which the phrase starts."""
    parts = phrase.split()
    here = F.transform(words, lambda w, i: F.when((w == parts[0]) & _follows(words, i, parts), i))
    return F.filter(here, lambda i: i.isNotNull())


def _follows(words: Column, i: Column, parts: list[str]) -> Column:
    found = F.lit(True)
    for k, part in enumerate(parts[1:], 1):
        found = found & F.coalesce(F.get(words, i + k) == part, F.lit(False))
    return found


def vocabulary_hits(docs: DataFrame) -> DataFrame:
    """doc_id, line, n_words, hits (word and position of each word of the templates' vocabulary) of each text that has a mandatory phrase, else none."""
    vocabulary = sorted(postings())
    musts = sorted({must for _, _, phrases in TEMPLATES for must in phrases} | set(PHRASES))
    lines = docs.select("doc_id", normal(F.col("text")).alias("line"))
    any_must = F.lit(False)
    for must in musts:
        any_must = any_must | has(F.col("line"), must)
    counted = lines.withColumn("n_words", (F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) - 1).cast("long"))
    words = F.when(any_must, words_in(F.col("line"))).otherwise(F.array().cast("array<string>"))
    hits = F.filter(
        F.transform("words", lambda w, i: F.when(w.isin(vocabulary), F.struct(w.alias("word"), i.alias("at")))), lambda h: h.isNotNull()
    )
    return counted.withColumn("words", words).withColumn("hits", hits)


def frequencies(docs: DataFrame) -> dict[str, int]:
    """Documents of the whole corpus that have each word of the vocabulary; at most as many entries as the templates have words."""
    vocabulary = sorted(postings())
    own = F.array_distinct(F.filter(words_in(normal(F.col("text"))), lambda w: w.isin(vocabulary)))
    counts = docs.select(F.explode(own).alias("word")).groupBy("word").count().collect()
    return {row["word"]: row["count"] for row in counts}


def labels_of(words: Column, line: Column, frequency: dict[str, int]) -> Column:
    """(label, share) of the templates that agree on an offset near one of their mandatory phrases, all of which stand in the file."""
    rank = {w: k for k, w in enumerate(sorted(postings(), key=lambda w: (frequency.get(w, 0), w)))}

    def most_alike(offsets: Column) -> Column:
        votes = F.transform(F.array_distinct(offsets), lambda x: F.size(F.filter(offsets, lambda y: y == x)))
        return F.coalesce(F.array_max(votes), F.lit(0))

    def share_near(template: str, must: str):
        own = template.split()
        at = defaultdict(list)
        for k, word in enumerate(own):
            at[word].append(k)
        known = F.create_map(*[x for w in sorted(at) for x in (F.lit(w), F.struct(F.lit(rank[w]).alias("rank"), F.array(*[F.lit(k) for k in at[w]]).alias("at")))])
        ahead = next(k for k in range(len(own)) if own[k : k + len(must.split())] == must.split())

        def share(place: Column) -> Column:
            first = F.greatest(place - (ahead + len(own)), F.lit(0))  # a template's length of slack on either side
            window = F.sequence(first, place + (2 * len(own) - ahead))
            mine = F.transform(window, lambda i: F.struct(i.alias("i"), F.element_at(known, F.coalesce(F.get(words, i), F.lit(""))).alias("known")))
            return bound(F.filter(mine, lambda h: h["known"].isNotNull()), of_hits)

        def of_hits(hits: Column) -> Column:
            return bound(F.slice(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["known"]["rank"]))), 1, RAREST), lambda rare: agreed(hits, rare))

        def agreed(hits: Column, rare: Column) -> Column:
            chosen = F.filter(hits, lambda h: F.array_contains(rare, h["known"]["rank"]))
            offsets = F.flatten(F.transform(chosen, lambda h: F.transform(h["known"]["at"], lambda k: h["i"] - k)))
            return F.least(F.lit(1.0), bound(offsets, most_alike) / F.greatest(F.size(rare), F.lit(1))).cast("double")

        return share

    found = []
    for label, template, musts in TEMPLATES:
        verified = F.lit(True)
        for must in musts:
            verified = verified & has(line, must)
        # an array of one place at least where the phrase stands, so the maximum is never null there
        best = F.array_max(F.transform(places(words, musts[0]), share_near(template, musts[0])))
        found.append(F.when(verified, F.struct(F.lit(label).alias("label"), best.alias("share"))))
    return F.filter(F.array(*found), lambda x: F.coalesce(x["share"] >= AGREE, F.lit(False)))


def digest(docs: DataFrame) -> DataFrame:
    """Base places, labels and score of every document."""
    slim = docs.select("doc_id", "text")
    frequency = frequencies(slim)
    hit = vocabulary_hits(slim)
    base = hit.withColumn("__places", F.array(*[F.when(has(F.col("line"), p), places(F.col("words"), p)).otherwise(F.array().cast("array<int>")) for p in PHRASES]))
    none = F.array().cast("array<struct<label:string,share:double>>")
    scored = base.withColumn("__found", F.when(F.size("hits") > 0, labels_of(F.col("words"), F.col("line"), frequency)).otherwise(none))
    kept = [F.when(F.size(F.get("__places", k)) > 0, F.lit(label)) for k, label in enumerate(PHRASES.values())]
    base_labels = F.filter(F.array(*kept), lambda x: x.isNotNull())
    every = F.sort_array(F.array_distinct(F.concat("__base", F.transform("__found", lambda x: x["label"]))))
    best = F.coalesce(F.array_max(F.transform("__found", lambda x: x["share"])), F.lit(0.0))
    return scored.withColumn("__base", base_labels).withColumn("__at", F.flatten("__places")).select(
        "doc_id", "n_words", F.size("__at").cast("long").alias("n_base"),
        F.array_min("__at").cast("long").alias("first_word"), F.array_max("__at").cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct("__base")), ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("__base") > 0, F.greatest(best, F.lit(0.5))).otherwise(best).alias("score"),
    )

"""License scans: a positional index of the rare words of licence notices.

Every notice is a sequence of words; the index holds each word's places in
each notice.  How rare a licence word is comes from the number of documents
that hold it, over all documents.  Of each file and notice the ``RARE`` rarest
of the notice's words that the file holds are looked up.  Each place of such a
word in the file, less a place of it in the notice, says where the notice
would begin; where enough different rare words agree on a beginning (within
``SLACK`` words), the notice is there if its mandatory phrases stand where
they belong.  Files that lack a word of a mandatory phrase can't pass that
last test, so for them nothing is looked up.

Places agree by sorting: beginnings are put in boxes twice as wide as the
slack, once shifted by half a box, each rare word counts once a box, and a box
is full enough if the word that many places further in the sorted list is of
the same box.  So the work of a file grows with its words, however often it
repeats them.

DataFrame functions only: one expression a document, no shuffle but that of
the counts of the licence words.
"""

from __future__ import annotations

import json
import math
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import let

#: Rare words looked up for each notice, and the share of them (of the notice's words, if it has fewer) that must agree.
RARE, AGREE = 8, 0.6
#: Words by which beginnings may differ, as by an inserted name or comment mark.
SLACK = 4
#: What is no word, in a text with capitals or without.
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# The phrases of the base labels.
BASE = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]

# Fixed values: (label, words of the notice, mandatory phrases), from the public texts of the licences.
NOTICES = [
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
     ["gnu affero general public license"]),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
     ["apache license version 2 0", "in compliance with the license"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
     ["redistribution and use in source and binary forms", "following conditions are met"]),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ["creative commons attribution"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", ["waived all copyright"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
     ["free software", "gnu general public license"]),
    ("gpl", "this work is licensed under the gnu general public license version 3", ["gnu general public license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
     ["permission to use copy modify", "with or without fee"]),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
     ["gnu lesser general public license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
     ["permission is hereby granted", "without restriction"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at",
     ["mozilla public license v 2 0"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software", "public domain"]),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software",
     ["without any express or implied warranty"]),
]


@cache
def vocabulary() -> list[str]:
    return sorted({w for _, text, _ in NOTICES for w in text.split()} | {w for _, text in BASE for w in text.split()})


def literal(values: list[str]) -> Column:
    """The words as one constant."""
    return F.split(F.lit(" ".join(values)), " ")


def words(text: Column) -> Column:
    """The words in lower case.  Of all capitals beyond A-Z only the Kelvin sign has a small letter within a-z; the Angstrom sign takes its place."""
    return F.array_remove(F.split(F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u212b"))), SEPARATOR, -1), "")


def text_of(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def document_counts(docs: DataFrame, text_col: str = "text") -> tuple[int, dict[str, int]]:
    """The number of documents, and of those that hold each word of the notices."""
    held = docs.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(words(text_of(text_col)), literal(vocabulary())))).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most the vocabulary
    return counts.pop("", 0), counts


def rarity(n_docs: int, counts: dict[str, int]) -> dict[str, float]:
    """Inverse document frequency of every word of the notices."""
    return {w: math.log((n_docs + 1) / (counts.get(w, 0) + 1)) for w in vocabulary()}


INDEX = """array<struct<label: string, length: int, ranked: array<string>, needed: int, places: array<struct<word: string, at: array<int>>>,
           mandatory: array<string>, phrases: array<struct<at: int, words: array<string>>>>>"""


def index(idf: dict[str, float]) -> Column:
    """The notices as one constant: words by rarity, places of each word, mandatory words and phrases."""
    entries = []
    for label, text, phrases in NOTICES:
        own = text.split()
        ranked = sorted(set(own), key=lambda w: (-idf[w], w))
        at = {p: next(k for k in range(len(own)) if own[k:k + len(p.split())] == p.split()) for p in phrases}
        entries.append({
            "label": label, "length": len(own), "ranked": ranked, "needed": math.ceil(AGREE * min(RARE, len(ranked))),
            "places": [{"word": w, "at": [k for k, x in enumerate(own) if x == w]} for w in ranked],
            "mandatory": sorted({w for p in phrases for w in p.split()}), "phrases": [{"at": k, "words": p.split()} for p, k in at.items()]})
    return F.from_json(F.lit(json.dumps(entries)), INDEX)


def stands(w: Column, at: Column, phrase: Column) -> Column:
    return (at >= 0) & (F.slice(w, F.greatest(at, F.lit(0)) + 1, F.size(phrase)) == phrase)


def boxes(w: Column, notice: Column, rare: Column) -> Column:
    """Where the notice may begin: the boxes (numbered by half widths) that enough of the rare words fall into."""
    found = F.filter(F.transform(w, lambda x, i: F.struct(i.alias("i"), x.alias("w"))), lambda x: F.array_contains(rare, x["w"]))

    def votes(hit: Column) -> Column:
        at = F.flatten(F.transform(F.filter(notice["places"], lambda p: p["word"] == hit["w"]), lambda p: p["at"]))
        halves = F.transform(at, lambda k: F.floor((hit["i"] - k) / SLACK).cast("int"))
        # the box of half widths b and b + 1, and that of b - 1 and b
        return F.flatten(F.transform(halves, lambda b: F.array(F.struct(b.alias("box"), hit["w"].alias("w")), F.struct((b - 1).alias("box"), hit["w"].alias("w")))))

    order = F.transform(F.array_sort(F.array_distinct(F.flatten(F.transform(found, votes)))), lambda v: v["box"])
    return let(order, lambda o: F.array_distinct(F.filter(o, lambda b, i: F.get(o, i + notice["needed"] - 1) == b)))


def share(w: Column, notice: Column, box: Column) -> Column:
    """The share of the notice's words found from the box on, if its mandatory phrases stand in their places; else null."""
    low = box * SLACK
    here = lambda p: F.exists(F.sequence(low - SLACK + p["at"], low + 3 * SLACK + p["at"]), lambda k: stands(w, k, p["words"]))
    window = F.slice(w, F.greatest(low, F.lit(0)) + 1, notice["length"] + 2 * SLACK)
    return F.when(F.forall(notice["phrases"], here), F.size(F.array_intersect(notice["ranked"], window)) / F.size(notice["ranked"]))


def notices_in(w: Column, present: Column, indexed: Column) -> Column:
    """``label, share`` of every notice that the words hold."""
    worth = F.filter(indexed, lambda t: F.forall(t["mandatory"], lambda m: F.array_contains(present, m)))

    def best(notice: Column) -> Column:
        rare = F.slice(F.array_intersect(notice["ranked"], present), 1, RARE)
        found = let(rare, lambda r: F.array_max(F.transform(boxes(w, notice, r), lambda b: share(w, notice, b))))
        return F.struct(notice["label"].alias("label"), F.when(F.size(rare) >= notice["needed"], found).alias("share"))

    return F.filter(F.transform(worth, best), lambda x: x["share"].isNotNull())


def phrases_in(w: Column, present: Column) -> Column:
    """``label, at`` of every base phrase: the words at which it starts."""
    def starts(phrase: list[str]) -> Column:
        same = lambda i: F.forall(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(p).alias("p")) for k, p in enumerate(phrase)]), lambda x: F.get(w, i + x["k"]) == x["p"])
        first = F.filter(F.transform(w, lambda x, i: F.when(x == phrase[0], i)), lambda i: i.isNotNull())
        worth = F.forall(literal(phrase), lambda p: F.array_contains(present, p))
        return F.when(worth, F.filter(first, lambda i: F.coalesce(same(i), F.lit(False)))).otherwise(F.array().cast("array<int>"))

    return F.array(*[F.struct(F.lit(label).alias("label"), starts(text.split()).alias("at")) for label, text in BASE])


def scan(docs: DataFrame, text_col: str = "text", out_col: str = "_scan") -> DataFrame:
    """The documents, all columns as they are, with a struct column: ``n_words``, ``phrases`` (label, at) and ``notices`` (label, share).

    Null texts are empty; they and texts without words hold nothing.  A notice
    that a file repeats, or that two texts of one licence give, is listed once
    each.  A text's result does not depend on its id, so repeated rows and ids
    need no care; of an empty table no word is rare, and no row comes out.  A
    column of the same name as ``out_col`` is replaced.
    """
    n_docs, counts = document_counts(docs, text_col)
    indexed = index(rarity(n_docs, counts))
    found = let(words(text_of(text_col)), lambda w: let(F.array_intersect(w, literal(vocabulary())), lambda present: F.struct(
        F.size(w).cast("long").alias("n_words"), phrases_in(w, present).alias("phrases"), notices_in(w, present, indexed).alias("notices"))))
    return docs.withColumn(out_col, found)


def listed(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: ``n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score``: 0.5 and half the best share of a notice's words where a notice
    is found, 0.5 where only a phrase is, else 0.
    """
    rows = scan(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text").select("doc_id", "_scan.*")
    at = F.flatten(F.transform("phrases", lambda p: p["at"]))
    base = F.transform(F.filter("phrases", lambda p: F.size(p["at"]) > 0), lambda p: p["label"])
    method = F.transform("notices", lambda x: x["label"])
    score = F.when(F.size("notices") > 0, 0.5 + F.array_max(F.transform("notices", lambda x: x["share"])) / 2).when(F.size(at) > 0, 0.5).otherwise(0.0)
    return rows.select("doc_id", "n_words", F.size(at).cast("long").alias("n_base"), F.array_min(at).cast("long").alias("first_word"), F.array_max(at).cast("long").alias("last_word"),
                       listed(base).alias("base_labels"), listed(F.concat(base, method)).alias("labels"), score.alias("score"))

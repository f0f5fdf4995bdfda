r"""Operator 3, license scans: a positional rare-token index, in DataFrame functions alone.

Templates are licence notices with mandatory key phrases: those below, or a table of them. One grouped pass over all documents
counts how many hold each template word. A document's words of the templates' vocabulary are looked up, and for each
template its rarest words (highest IDF) that the document holds. Each of them gives postings: word position minus
template position is where the template would start. Postings of different words are intersected by these relative positions,
with a tolerance for words put in or left out. Of the places where two agree, those with all key phrases near their relative
positions are kept, and scored by the share of template words that stand where they should. The base phrases are
templates that are all key phrase, so every place of them is found. All notices are one constant that one expression goes through,
whatever their number; only those whose rarest key word the document holds are looked at.

Defined results: null and empty texts have no words, no places, empty labels and score 0; repeated rows give repeated
rows; other columns are kept out. A row's result needs no other row, so no text is shuffled. A template in which a word stands
several times has postings for each; a table with more than MOST_TEMPLATES rows is an error.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varspan.llm.common import ascii_lower, with_columns_of


@dataclass(frozen=True)
class Template:
    label: str
    words: str
    keys: tuple[str, ...]
    base: bool = False


# The base phrases and their labels.
BASE = (
    Template("cc-by", "cc by", ("cc by",), True),
    Template("gpl", "general public license", ("general public license",), True),
    Template("reserved", "all rights reserved", ("all rights reserved",), True),
)
# Public licence notices and the phrases that must stand in them.
NOTICES = (
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted free of charge",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("apache license version 2 0", "except in compliance with the license")),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2.0", "this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ("gnu general public license as published by", "either version 3 of the license")),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "with or without modification")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and or distribute this software",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software released into the public domain",)),
)
#: Postings of a template in a document: so many of its rarest words that the document holds; words put in or left out between two.
RARE, SLACK = 3, 3
MOST_TEMPLATES = 1000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words of a text, in order; null has none."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, -1), lambda w: w != "")


def bound(value: Column, f) -> Column:
    """f(value), with value computed once: inside the lambda it is a variable."""
    return F.element_at(F.transform(F.array(value), f), 1)


def document_counts(docs: DataFrame, words: list[str]) -> tuple[int, dict[str, int]]:
    """Documents in all, and documents that hold each of the given words. One row a word comes to the driver."""
    vocabulary = F.array(*[F.lit(w) for w in words])
    held = docs.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(words_of(F.col("text")), vocabulary))).alias("w"))
    counts = dict(held.groupBy("w").count().collect())
    return counts.pop("", 0), counts


def templates_of(table: DataFrame) -> tuple[Template, ...]:
    """Notices of a table (label, text, key_phrases array<string>); without key phrases the whole text is one."""
    rows = table.select("label", "text", "key_phrases").limit(MOST_TEMPLATES + 1).collect()
    if len(rows) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    import re

    tidy = lambda t: " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda c: c[0].lower(), t)))
    return tuple(Template(r.label, tidy(r.text), tuple(tidy(k) for k in r.key_phrases or [r.text])) for r in sorted(rows, key=lambda r: (r.label, r.text)))


def _find(phrase: list[str], words: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)


def _at(words: Column, place: Column, phrase: Column) -> Column:
    """Whether a phrase stands at a place."""
    return (place >= 0) & (F.slice(words, F.greatest(place + 1, F.lit(1)), F.size(phrase)) == phrase)


def _base_places(t: Template, idf: dict[str, float], words: Column, hits: Column) -> Column:
    """All places of a base phrase: proposed by its rarest word, verified."""
    phrase = t.words.split()
    rare = max(phrase, key=lambda w: (idf[w], w))
    k = phrase.index(rare)
    whole = F.array(*[F.lit(w) for w in phrase])
    return F.filter(F.transform(F.filter(hits, lambda h: h["w"] == rare), lambda h: h["i"] - k), lambda s: _at(words, s, whole))


INDEX = "array<struct<label:string,own:array<string>,order:array<string>,telling:string,keys:array<struct<at:int,phrase:array<string>>>>>"


def index_of(notices: tuple[Template, ...], idf: dict[str, float]) -> Column:
    """The notices as one constant: words, the same by rarity, the rarest word of a key phrase (without which the phrase can't stand), key phrases with
    their places."""
    rows = []
    for t in notices:
        own = t.words.split()
        telling = max((w for k in t.keys for w in k.split()), key=lambda w: (idf[w], w))
        keys = [{"at": _find(k.split(), own), "phrase": k.split()} for k in t.keys]
        rows.append({"label": t.label, "own": own, "order": sorted(set(own), key=lambda w: (-idf[w], w)), "telling": telling, "keys": keys})
    return F.from_json(F.lit(json.dumps(rows)), INDEX)


def _places(t: Column, words: Column, hits: Column, held: Column) -> Column:
    """Starts of a notice: relative positions on which two of the document's rarest words of it agree, with all key phrases near. held: the document's
    words of the vocabulary."""

    def starts(word: Column) -> Column:
        # postings of a word: its places in the document less those in the template
        at = F.filter(F.transform(t["own"], lambda w, i: F.when(w == word, i)), lambda i: i.isNotNull())
        return F.flatten(F.transform(F.filter(hits, lambda h: h["w"] == word), lambda h: F.transform(at, lambda i: h["i"] - i)))

    rare = F.slice(F.array_intersect(t["order"], held), 1, RARE)  # in the order of the first
    near = lambda s: F.flatten(F.transform(s, lambda x: F.sequence(x - SLACK, x + SLACK)))
    none = F.array().cast("array<int>")

    def agreed(lists: Column) -> Column:
        pair = lambda a, b: F.when(F.size(lists) > b, F.array_intersect(F.get(lists, a), near(F.get(lists, b)))).otherwise(none)
        both = F.array_distinct(F.concat(*[pair(a, b) for b in range(1, RARE) for a in range(b)]))
        return F.when(F.size(t["order"]) == 1, F.get(lists, 0)).otherwise(both)  # a template of one word

    key = lambda s, k: F.exists(F.sequence(F.lit(-SLACK), F.lit(SLACK)), lambda o: _at(words, s + k["at"] + o, k["phrase"]))
    return F.filter(bound(F.transform(rare, starts), agreed), lambda s: F.forall(t["keys"], lambda k: key(s, k)))


def _score(t: Column, words: Column, places: Column) -> Column:
    """The best place's share of template words at their positions; 0 without a place."""
    same = lambda s: F.size(F.filter(F.transform(t["own"], lambda w, k: F.when(s + k >= 0, F.get(words, s + k) == w)), lambda x: x)) / F.size(t["own"])
    return F.coalesce(F.array_max(F.transform(places, same)), F.lit(0.0))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: tuple[Template, ...] | DataFrame = NOTICES) -> DataFrame:
    """Per document: words, places of the base phrases, labels with their places, and the best notice's score."""
    notices = templates_of(notices) if isinstance(notices, DataFrame) else notices
    docs = with_columns_of(docs, doc_id=id_col, text=text_col)
    vocabulary = sorted({w for t in (*BASE, *notices) for w in t.words.split()})
    n, counts = document_counts(docs, vocabulary)
    idf = {w: math.log((1 + n) / (1 + counts.get(w, 0))) for w in vocabulary}
    index = index_of(notices, idf)

    def in_words(words: Column, hits: Column) -> Column:
        def with_held(held: Column) -> Column:
            # one expression for all templates: those with their telling word in the text
            likely = F.filter(index, lambda t: F.array_contains(held, t["telling"]))
            told = F.transform(likely, lambda t: bound(_places(t, words, hits, held), lambda p: F.struct(t["label"].alias("label"), F.size(t["own"]).cast("long").alias("length"), p.alias("places"), _score(t, words, p).alias("score"))))
            return F.struct(F.size(words).cast("long").alias("n_words"), *[_base_places(t, idf, words, hits).alias(f"b{k}") for k, t in enumerate(BASE)], F.filter(told, lambda x: F.size(x["places"]) > 0).alias("told"))

        return bound(F.array_distinct(F.transform(hits, lambda h: h["w"])), with_held)

    def found(words: Column) -> Column:
        hits = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: h["w"].isin(vocabulary))
        return bound(hits, lambda h: in_words(words, h))

    got = docs.select("doc_id", bound(words_of(F.col("text")), found).alias("r")).select("doc_id", "r.*")
    base = F.flatten(F.array(*[F.col(f"b{k}") for k in range(len(BASE))]))
    base_labels = F.array_compact(F.array(*[F.when(F.size(f"b{k}") > 0, F.lit(t.label)) for k, t in enumerate(BASE)]))
    names = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    match = lambda s, label, length: F.struct(s.cast("long").alias("start"), label.alias("label"), length.alias("length"))
    in_base = lambda t: lambda s: match(s, F.lit(t.label), F.lit(len(t.words.split())).cast("long"))
    own = [F.transform(f"b{k}", in_base(t)) for k, t in enumerate(BASE)]
    others = F.flatten(F.transform("told", lambda x: F.transform(x["places"], lambda s: match(s, x["label"], x["length"]))))
    return got.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(base).cast("long").alias("first_word"), F.array_max(base).cast("long").alias("last_word"),
        names(base_labels).alias("base_labels"), names(F.concat(base_labels, F.transform("told", lambda x: x["label"]))).alias("labels"),
        F.when(F.size(base) > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("told", lambda x: x["score"])), F.lit(0.0))).alias("score"), F.array_sort(F.concat(*own, others)).alias("matches"),
    )


def query(docs: DataFrame) -> DataFrame:
    return scan(docs).drop("matches")

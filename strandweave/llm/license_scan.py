"""License scans by a positional rare-token index.

Templates (word sequences with mandatory key phrases) are indexed by word and position. The vocabulary's
document frequencies over the whole corpus give each word's IDF. A template's lookup words are its rarest ones,
as many as weigh more than the share that a match may lack: no match is without all of them, however common
they are. A posting of template t at position p met at word w of the file proposes "t starts at w - p". The
candidate's words are then compared in place, and the match counts if the IDF-weighted share of equal words
reaches ``threshold`` and each key phrase stands there. Where every file holds all of a template's words, they
weigh the same.

All native, and two passes over the texts: one counts the templates' words, the other looks them up and compares
within the row, so no text and no position is shuffled. The index is part of the plan: its size is that of the
templates, which are a parameter of some dozens of short texts, and not of the data.

A null text is empty: no words, no labels, score 0. A null id is kept. Repeated rows give repeated rows.
Empty tables give empty results; columns besides the id and the text are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, functions as F

from strandweave.llm.common import let, lower_ascii, whole_text

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases whose places are always reported, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: label: (template text, mandatory key phrases). Wording of well-known public notices.
TEMPLATES = {
    "apache-2.0": ("licensed under the apache license version 2 0", ("apache license version 2 0",)),
    "mit": ("permission is hereby granted free of charge to any person obtaining a copy of this software", ("hereby granted free of charge",)),
    "mit-name": ("released under the mit license", ("mit license",)),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted", ("source and binary forms",)),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    "gpl-2.0": ("this work is licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    "lgpl": ("this library is licensed under the gnu lesser general public license", ("lesser general public license",)),
    "cc-by-4.0": ("licensed under cc by 4 0", ("cc by 4 0",)),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    "cc0": ("released into the public domain under cc0", ("public domain", "cc0")),
    "mpl-2.0": ("subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    "reserved": ("all rights reserved", ("all rights reserved",)),
}


def scan_words(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(text), GAP), lambda w: w != "")


def _starts(w: Column, phrase: str) -> Column:
    """Where the phrase's words stand one after another."""
    parts = phrase.split()
    first = F.filter(F.transform(w, lambda x, i: F.when(x == parts[0], i)), lambda i: i.isNotNull())
    follow = lambda i: F.coalesce(F.array_join(F.array(*[F.get(w, i + k) for k in range(len(parts))]), " ") == phrase, F.lit(False))
    return F.filter(first, follow)


def document_frequencies(rows: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Files in all, and with each vocabulary word: as many numbers as the templates have words."""
    held = rows.select(F.explode(F.array_intersect("w", F.array(*[F.lit(v) for v in vocabulary]))).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return rows.count(), counts


def lookups(weights: list[float], threshold: float) -> list[int]:
    """Positions of a template, heaviest first, that together weigh more than a match may lack."""
    room, out = (1 - threshold) * sum(weights) * (1 + 1e-9), []
    for p in sorted(range(len(weights)), key=lambda p: (-weights[p], p)):
        if sum(weights[q] for q in out) <= room:
            out.append(p)
    return out


def _matches(w: Column, texts: dict[str, list[str]], weights: dict[str, list[float]], templates: dict, threshold: float) -> Column:
    """The templates found in the words ``w`` as (label, start, score), in order."""
    labels = list(texts)
    entries: dict[str, list[tuple[int, int]]] = {}
    for number, label in enumerate(labels):
        for p in lookups(weights[label], threshold):
            entries.setdefault(texts[label][p], []).append((number, p))
    none = F.expr("array()").cast("array<struct<label:string,start:int,score:double>>")
    if not entries:
        return none
    # a proposal is one number: the template above, the start below, from 2^31 so that it may be negative
    index = F.create_map(*[x for word, spots in entries.items() for x in (F.lit(word), F.array(*[F.lit((n << 33) + (1 << 31) - p) for n, p in spots]))])
    bodies = F.array(*[F.struct(F.lit(label).alias("label"), F.array(*map(F.lit, texts[label])).alias("body"), F.array(*map(F.lit, weights[label])).alias("weights"), F.array(*[F.lit(f" {k} ") for k in templates[label][1]]).alias("phrases")) for label in labels])
    hits = F.filter(F.transform(w, lambda x, i: F.when(x.isin(list(entries)), F.struct(x.alias("word"), i.alias("at")))), lambda x: x.isNotNull())
    proposals = F.array_distinct(F.flatten(F.transform(hits, lambda h: F.transform(F.element_at(index, h["word"]), lambda e: e + h["at"]))))

    def judged(v: Column) -> Column:
        start = (v.bitwiseAND(F.lit((1 << 33) - 1)) - (1 << 31)).cast("int")

        def compared(t: Column) -> Column:
            got = F.aggregate(F.zip_with(F.transform(t["body"], lambda b, i: F.coalesce((start + i >= 0) & (F.get(w, start + i) == b), F.lit(False))), t["weights"], lambda e, x: F.when(e, x).otherwise(0.0)), F.lit(0.0), lambda a, x: a + x)
            full = F.aggregate(t["weights"], F.lit(0.0), lambda a, x: a + x)
            stretch = F.concat(F.lit(" "), F.array_join(F.slice(w, F.greatest(start, F.lit(0)) + 1, F.size(t["body"]) + F.least(start, F.lit(0))), " "), F.lit(" "))
            return F.struct(t["label"].alias("label"), start.alias("start"), F.round(got / full, 9).alias("score"), F.forall(t["phrases"], lambda k: stretch.contains(k)).alias("keyed"))

        return let(F.get(bodies, F.shiftright(v, 33).cast("int")), compared)

    scored = F.filter(F.transform(proposals, judged), lambda m: (m["score"] >= threshold) & m["keyed"])
    return F.when(F.size(hits) == 0, none).otherwise(F.array_sort(F.transform(scored, lambda m: F.struct(m["label"].alias("label"), m["start"].alias("start"), m["score"].alias("score")))))


def scan(docs: DataFrame, templates: dict | None = None, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, places (base: label, start), matches (method: label, start, score)."""
    templates = TEMPLATES if templates is None else templates
    texts = {label: text.split() for label, (text, _) in templates.items()}
    vocabulary = sorted({w for text in texts.values() for w in text})
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    n_files, counts = document_frequencies(rows.select(scan_words(F.col("text")).alias("w")), vocabulary)
    idf = {w: math.log((1 + n_files) / (1 + counts.get(w, 0))) for w in vocabulary}
    weights = {label: [idf[x] for x in t] if any(idf[x] > 0 for x in t) else [1.0] * len(t) for label, t in texts.items()}

    no_place = F.expr("array()").cast("array<struct<label:string,start:int>>")
    # texts without the longest word of a phrase hold no phrase
    hinted = F.lower("text").rlike("|".join(re.escape(max(phrase.split(), key=len)) for phrase in PHRASES))

    def found(w: Column) -> Column:
        place = lambda label, phrase: F.transform(_starts(w, phrase), lambda i: F.struct(F.lit(label).alias("label"), i.alias("start")))
        places = F.when(hinted, F.concat(*[place(label, phrase) for phrase, label in PHRASES.items()])).otherwise(no_place)
        return F.struct(F.size(w).cast("long").alias("n_words"), places.alias("places"), _matches(w, texts, weights, templates, threshold).alias("matches"))

    return rows.select("doc_id", let(scan_words(F.col("text")), found).alias("f")).select("doc_id", "f.n_words", "f.places", "f.matches")


def digest(found: DataFrame) -> DataFrame:
    """Counts and labels: the base's, and those of base and method together."""
    starts = F.transform("places", lambda p: p["start"])
    own = F.transform("places", lambda p: p["label"])
    method = F.transform("matches", lambda m: m["label"])
    spelt = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        spelt(own).alias("base_labels"),
        spelt(F.concat(own, method)).alias("labels"),
        let(F.array_max(F.transform("matches", lambda m: m["score"])), lambda s: F.round(F.least(F.coalesce(s, F.lit(0.0)), F.lit(1.0)), 6)).alias("score"),
    )

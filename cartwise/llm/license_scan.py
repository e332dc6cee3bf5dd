"""License scan by an exact set-similarity join (operator 2).

Templates and text blocks are sets of words. Words are ordered by how many
documents hold them, rarest first. A block that holds at least ``threshold``
of a template's words must share a word with the template's *prefix* (its
rarest words), must hold enough template words at all (*length*), and must
still have enough words left behind the first shared one (*position*). Only
pairs that pass all three are counted out; the result is exact.

Blocks are the lines of a document for license sentences, and windows of as
many words as a sentence has where it is wrapped over lines; for the base
phrases, whose words may stand on two lines, the whole document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import lower_az, words
from cartwise.session import stage

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Sentences that mark a license; a line holding most of their words is marked, and lines over which one is wrapped.
TEMPLATES = {
    "mit-notice": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "apache-2.0": "licensed under the apache license version 2 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "lgpl": "gnu lesser general public license",
    "agpl": "gnu affero general public license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by": "licensed under cc by 4 0",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "mozilla": "subject to the terms of the mozilla public license",
    "reserved": "all rights reserved",
}


def _texts(values) -> Column:
    return F.array(*(F.lit(v) for v in values)).cast("array<string>")


def word_order(held: DataFrame, vocabulary: list[str]) -> list[str]:
    """``vocabulary`` by the number of rows whose ``held`` has a word, rarest first, ties by the word.

    Counts run over all rows; at most one row for each vocabulary word returns.
    """
    counts = held.select(F.explode("held").alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    n = {r["w"]: r["n"] for r in counts.collect()}
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def similar(block: Column, templates: dict[str, str], order: list[str], threshold: float) -> Column:
    """Names and containments of the templates that ``block`` (an array of lower-case words) holds.

    An array of (name, share), one entry per template of which the block holds
    at least ``threshold`` of the distinct words.
    """
    rank = {w: i for i, w in enumerate(order)}
    found = []
    for name, sentence in sorted(templates.items()):
        tokens = sorted(set(sentence.split()), key=rank.__getitem__)
        need = math.ceil(threshold * len(tokens) - 1e-9)
        prefix = tokens[: len(tokens) - need + 1]
        length = F.size(block) >= need
        shares = F.arrays_overlap(block, _texts(prefix))
        # Behind the first shared word of the prefix at most the template's rest can be shared too.
        first = F.array_min(F.transform(F.array_intersect(_texts(prefix), block), lambda w: F.array_position(_texts(tokens), w)))
        position = F.lit(len(tokens)) - first + 1 >= need
        common = F.size(F.array_intersect(_texts(tokens), block))
        hit = F.when(length & shares, F.when(position & (common >= need), common / F.lit(float(len(tokens)))))
        found.append(F.struct(F.lit(name).alias("name"), hit.alias("share")))
    return F.filter(F.array(*found), lambda t: t["share"].isNotNull())


def wrapped(spots: Column, hits: Column, templates: dict[str, str], threshold: float) -> Column:
    """Templates that stand across line breaks: an array of (line, template, share), the line being the first.

    ``spots`` are the places (pos, line, word) of all template words in order.
    A window has as many words as the sentence and begins at one of its
    words. Lines that are themselves in ``hits`` with the template are not named again.
    """
    return F.concat(*(_wrapped(spots, hits, name, sentence, threshold) for name, sentence in sorted(templates.items())))


def _wrapped(spots: Column, hits: Column, name: str, sentence: str, threshold: float) -> Column:
    n, tokens = len(sentence.split()), sorted(set(sentence.split()))
    need = math.ceil(threshold * len(tokens) - 1e-9)
    own = F.filter(spots, lambda s: F.array_contains(_texts(tokens), s["word"]))
    known = F.transform(F.filter(hits, lambda h: h["template"] == name), lambda h: h["line"])

    def fresh(b: Column) -> Column:
        """Windows (line, last line, distinct words) over several lines that hold enough, none of whose lines is known."""

        def window(s: Column, k: Column) -> Column:
            inside = F.filter(F.slice(b["own"], k + 1, n), lambda x: x["pos"] < s["pos"] + n)
            last, held = F.element_at(inside, -1)["line"], F.size(F.array_distinct(F.transform(inside, lambda x: x["word"])))
            return F.struct(s["line"].alias("line"), last.alias("last"), held.alias("held"))

        def counts(w: Column) -> Column:
            return (w["last"] > w["line"]) & (w["held"] >= need) & ~F.exists(b["known"], lambda i: i.between(w["line"], w["last"]))

        return F.filter(F.transform(b["own"], window), counts)

    def best(found: Column) -> Column:
        """One entry for each line, with its largest share."""

        def entry(line: Column) -> Column:
            held = F.array_max(F.transform(F.filter(found, lambda w: w["line"] == line), lambda w: w["held"]))
            return F.struct(line.alias("line"), F.lit(name).alias("template"), (held / F.lit(float(len(tokens)))).alias("share"))

        return F.transform(F.array_distinct(F.transform(found, lambda w: w["line"])), entry)

    # Arrays of one element bind what is used several times, so that it is worked out once.
    bound = F.struct(own.alias("own"), known.alias("known"))
    bound = F.filter(F.array(bound), lambda b: F.size(b["own"]) >= need)
    return F.flatten(F.transform(F.transform(bound, fresh), best))


def license_scan(
    docs: DataFrame, doc_id: str, text: str, templates: dict[str, str] | None = None, threshold: float = 0.8
) -> DataFrame:
    """One row per document with the license marks of its whole text.

    Columns: ``doc_id``, n_words, n_base (places of base phrases), first_word
    and last_word (smallest and largest start of such a place, else null),
    base_labels and labels (sorted, distinct, comma-joined; empty if none),
    score (the largest share of a template's or phrase's words found in one
    block, 0 without a mark), matches (line number from 0, its text, template,
    share; of a sentence that is wrapped the line where it begins). A null or empty text has no words and no marks; repeated rows give
    repeated results; an empty table gives an empty result; further columns
    are ignored. ``labels`` holds the base labels and the names of matched templates.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = {p: p for p in BASE}
    vocabulary = sorted({w for s in [*templates.values(), *phrases] for w in s.split()})
    fewest = min(math.ceil(threshold * len(set(s.split())) - 1e-9) for s in [*templates.values(), *phrases])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("words", words(lower_az(F.col("text"))))
    held = F.array_intersect("words", _texts(vocabulary))
    rows = rows.select("doc_id", "text", F.size("words").cast("long").alias("n_words"), held.alias("held"))
    # The length filter of all templates at once: other texts are not looked at again.
    rows = stage(rows.withColumn("text", F.when(F.size("held") >= fewest, F.col("text"))))
    order = word_order(rows, vocabulary)

    phrase_of = F.filter(similar(F.col("held"), phrases, order, 1.0), lambda t: t["share"] >= 1.0)
    may = (F.size(phrase_of) > 0) | (F.size(similar(F.col("held"), templates, order, threshold)) > 0)
    rows = rows.select("doc_id", "n_words", F.when(may, F.coalesce("text", F.lit(""))).alias("text"))
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    rows = rows.select("doc_id", "n_words", words(lower_az(F.col("text"))).alias("words"), lines.alias("lines"))
    rows = rows.withColumn("blocks", F.transform("lines", lambda x: F.array_distinct(words(lower_az(x)))))
    places = [_places(F.col("words"), phrase, label) for phrase, label in sorted(BASE.items())]
    rows = rows.withColumn("places", F.flatten(F.array(*places)))
    hits = F.transform(
        "blocks",
        lambda block, i: F.transform(
            similar(block, templates, order, threshold),
            lambda t: F.struct(i.alias("line"), t["name"].alias("template"), t["share"].alias("share")),
        ),
    )
    rows = rows.withColumn("hits", F.flatten(hits))
    rows = rows.withColumn("spots", _spots(F.col("lines"), vocabulary))
    rows = rows.withColumn("hits", F.concat("hits", wrapped(F.col("spots"), F.col("hits"), templates, threshold)))
    matches = F.transform(
        "hits",
        lambda h: F.struct(
            h["line"].cast("long").alias("line"), F.get("lines", h["line"]).alias("text"), h["template"].alias("template"), h["share"].alias("share")
        ),
    )
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    every = F.array_distinct(F.concat(base, F.transform("hits", lambda h: h["template"])))
    share = F.coalesce(F.array_max(F.transform("hits", lambda h: h["share"])), F.lit(0.0))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["start"])).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(share).alias("score"),
        matches.alias("matches"),
    )


def _spots(lines: Column, vocabulary: list[str]) -> Column:
    """(pos, line, word) of all words of ``vocabulary`` in a text's lines; pos counts the words of the whole text."""
    of_line = F.transform(lines, lambda x, i: F.transform(words(lower_az(x)), lambda w: F.struct(i.alias("line"), w.alias("word"))))
    placed = F.transform(F.flatten(of_line), lambda w, i: F.struct(i.alias("pos"), w["line"].alias("line"), w["word"].alias("word")))
    return F.filter(placed, lambda w: F.array_contains(_texts(vocabulary), w["word"]))


def _places(words_col: Column, phrase: str, label: str) -> Column:
    """Starts (from 0) at which the phrase's words stand consecutively, with its label."""
    own = _texts(phrase.split())
    n = len(phrase.split())
    first = F.lit(phrase.split()[0])
    at = F.transform(words_col, lambda w, i: F.when(w == first, i))
    at = F.filter(F.filter(at, lambda i: i.isNotNull()), lambda i: F.slice(words_col, i + 1, n) == own)
    return F.transform(at, lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))

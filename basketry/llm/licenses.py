"""License scan: an exact set-similarity join of text blocks with license templates, in DataFrame functions only.

The base labels come from short phrases that must stand word by word. The join adds labels of its own: a block (a line
of a text) gets a template's label when it holds at least ``containment`` of the template's distinct words. The join is
exact and follows the usual filters:

* words are ordered by their frequency in the whole corpus, rarest first; only words of templates matter, so the
  frequency table has at most as many rows as the templates have words;
* prefix filter: with ``n`` template words of which ``need = ceil(containment * n)`` must occur, a matching block holds
  one of the ``n - need + 1`` rarest, so only blocks with such a word are looked at further;
* length filter: a matching block has at least ``need`` distinct words;
* positional filter: if the first shared word stands at place ``p`` of the template's ``n`` words and at place ``q`` of the block's ``m`` words,
  both in global order and counted from 0, at most ``min(n - p, m - q)`` words are shared, which must reach ``need``;
* the remaining pairs are verified by counting shared words.

Templates are a parameter of bounded size; they travel as literals. Every text is read where it is stored, and nothing
but the word frequencies is shuffled.

Defined results: null text is the empty text (no words, empty labels, score 0); a null id stays null; repeated rows give
one row each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CONTAINMENT = 0.8

# The phrases of the base labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Opening sentences of public licenses, by label.
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "apache-2": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "cc-by-nc": "this work is licensed under a creative commons attribution noncommercial license",
    "mit-short": "released under the mit license",
    "apache-2-short": "licensed under apache license version 2 0",
    "cc-by-nc-short": "content licensed cc by nc 4 0",
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SIGNS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = "  "  # between words of a normalised text; every word has a blank of its own on either side


def normalised(text: Column) -> Column:
    """The words of a text as `` w1  w2  w3 ``; without words a blank."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lower, NOT_WORD, GAP)), F.lit(" "))


def phrase(words: str) -> str:
    return f" {GAP.join(words.split())} "


def count_of(text: Column, part: str) -> Column:
    """Places of ``part``, which never overlaps itself."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("long")


def n_words(text: Column) -> Column:
    return F.when(F.length(F.trim(text)) == 0, F.lit(0)).otherwise(count_of(F.trim(text), GAP) + 1).cast("long")


def word_at(text: Column, place: Column) -> Column:
    """Words before a 1-based place in a normalised text."""
    return count_of(F.substring(text, F.lit(1), place), GAP)


def base_places(text: Column, phrases: dict[str, str]) -> dict[str, Column]:
    """Number of places, first and last word, and labels of the phrases."""
    counts, firsts, lasts, labels = [], [], [], []
    backwards = F.reverse(text)
    for words, label in phrases.items():
        part = phrase(words)
        at = F.instr(text, part)
        back = F.instr(backwards, part[::-1])
        last = F.length(text) - (back - 1) - len(part) + 1
        counts.append(count_of(text, part))
        firsts.append(F.when(at > 0, word_at(text, at)))
        lasts.append(F.when(back > 0, word_at(text, last)))
        labels.append(F.when(at > 0, F.lit(label)))
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    least = F.least(*firsts) if len(firsts) > 1 else firsts[0]
    most = F.greatest(*lasts) if len(lasts) > 1 else lasts[0]
    return {"n_base": total, "first_word": least, "last_word": most, "base": F.array_compact(F.array(*labels))}


def word_frequencies(docs: DataFrame, text_col: str, words: list[str]) -> dict[str, int]:
    """Occurrences of each of the given words in the corpus: texts are split once, and a row for each word comes back."""
    plain = F.translate(F.col(text_col).cast("string"), UPPER + SIGNS, LOWER + " " * len(SIGNS))
    found = docs.select(F.explode(F.split(plain, " ")).alias("word")).where(F.col("word").isin(words))
    counts = dict(found.groupBy("word").count().collect())  # as many rows as the templates have words, at most
    return {w: counts.get(w, 0) for w in words}


def held_words(line: Column, order: list[str]) -> Column:
    """The words of a normalised block that any template knows, in the given order."""
    return F.array_intersect(F.array(*map(F.lit, order)), F.split(F.trim(line), GAP))


def template_share(words: Column, template: list[str], need: int) -> Column:
    """Share of the template's words that a block holds, or null if it is below the threshold. ``template`` is in global order, rarest
    word first, and so are ``words``, the block's distinct words of any template."""
    n = len(template)
    # The first shared word of the order, at place p of the template and q of the block: what both have from there on bounds the
    # words that they share. A word that the block lacks is at place 0 there.
    at = lambda w: F.array_position(words, w)
    bound = F.coalesce(*[F.when(at(w) > 0, F.least(F.lit(n - p), F.size(words) - at(w) + 1)) for p, w in enumerate(template[: n - need + 1])])
    shared = F.size(F.array_intersect(words, F.array(*map(F.lit, template))))
    return F.when((F.size(words) >= need) & (bound >= need), F.when(shared >= need, shared / F.lit(float(n))))


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
    containment: float = CONTAINMENT,
    text_col: str = "text",
) -> DataFrame:
    """Add to every row ``n_words``, the base places, ``base_labels``, ``labels`` (base and joined) and ``score``."""
    sets = {label: sorted(set(words.split())) for label, words in templates.items()}
    every = sorted(set().union(*sets.values()))
    frequency = word_frequencies(docs, text_col, every)
    order = sorted(every, key=lambda w: (frequency[w], w))
    place = {w: k for k, w in enumerate(order)}
    ordered = {label: sorted(words, key=place.__getitem__) for label, words in sets.items()}
    need = {label: math.ceil(containment * len(words) - 1e-9) for label, words in ordered.items()}
    prefixes = sorted({w for label, words in ordered.items() for w in words[: len(words) - need[label] + 1]}, key=place.__getitem__)

    # Candidates by the prefix filter: a line is split only if it holds a rare word of a template.
    has_rare = F.lit(False)
    for w in prefixes:
        has_rare = has_rare | F.contains(F.col("norm"), F.lit(f" {w} "))
    norm = normalised(F.col(text_col))
    lines = F.when(F.col("may"), F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "\n"))
    kept = F.filter(
        F.transform(lines, lambda x: held_words(normalised(x), order)),
        lambda words: F.size(words) >= min(need.values()),
    )
    shares = F.transform(kept, lambda words: F.struct(*[template_share(words, t, need[k]).alias(f"t{i}") for i, (k, t) in enumerate(ordered.items())]))
    best = {label: F.array_max(F.col(f"shares.t{i}")) for i, label in enumerate(ordered)}
    found = docs.withColumn("norm", norm).withColumns(base_places(F.col("norm"), phrases) | {"n_words": n_words(F.col("norm")), "may": has_rare})
    found = found.withColumn("shares", shares).withColumns({f"best_{i}": c for i, c in enumerate(best.values())})
    joined = F.array_compact(F.array(*[F.when(F.col(f"best_{i}").isNotNull(), F.lit(label.removesuffix("-short"))) for i, label in enumerate(best)]))
    text_of = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    top = F.coalesce(F.greatest(*[F.col(f"best_{i}") for i in range(len(best))]), F.lit(0.0))
    return found.withColumns(
        {
            "base_labels": text_of(F.col("base")),
            "labels": text_of(F.array_union(F.col("base"), joined)),
            "score": F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(top),
        }
    ).drop("norm", "may", "shares", "base", *[f"best_{i}" for i in range(len(best))])


def op9_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def scan_sql(phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT) -> str:
    """The same result in DuckDB, without filters or frequencies."""
    words = lambda text: f"regexp_extract_all(translate({text}, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    listed = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    places, names, shares, more = [], [], [], []
    for k, (text, label) in enumerate(phrases.items()):
        p = text.split()
        places.append(f"list_filter(range(0, greatest(len(ws) - {len(p) - 1}, 0)), lambda i: ws[i + 1:i + {len(p)}] = {listed(p)}) AS p{k}")
        names.append(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END")
    for k, (label, text) in enumerate(templates.items()):
        t = sorted(set(text.split()))
        need = math.ceil(containment * len(t) - 1e-9)
        shares.append(f"list_max(list_transform(ls, lambda x: CASE WHEN len(list_intersect({listed(t)}, x)) >= {need} THEN len(list_intersect({listed(t)}, x)) / {float(len(t))} ELSE 0.0 END)) AS t{k}")
        more.append(f"CASE WHEN t{k} > 0 THEN '{label.removesuffix('-short')}' END")
    every = " || ".join(f"p{k}" for k in range(len(places)))
    text_of = lambda labels: f"array_to_string(list_sort(list_distinct(list_filter([{', '.join(labels)}], lambda x: x IS NOT NULL))), ',')"
    return f"""
    WITH w AS (
      SELECT doc_id, {words("coalesce(text, '')")} AS ws, list_transform(string_split(coalesce(text, ''), chr(10)), lambda l: {words("l")}) AS ls FROM documents
    ), f AS (SELECT doc_id, len(ws) AS n_words, {", ".join(places)}, {", ".join(shares)} FROM w)
    SELECT doc_id, n_words, len({every}) AS n_base, list_min({every}) AS first_word, list_max({every}) AS last_word, {text_of(names)} AS base_labels,
      {text_of(names + more)} AS labels, CASE WHEN len({every}) > 0 THEN 1.0::DOUBLE ELSE greatest({", ".join(f"t{k}" for k in range(len(shares)))})::DOUBLE END AS score
    FROM f"""

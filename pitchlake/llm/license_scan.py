"""Operator 7: licence scan by Dice coefficient over word bigrams.

A text is cut into segments, comment marks at the start of lines aside: its lines,
its paragraphs of several lines (between blank lines), the whole of it, and all
runs of one to three sentences of a paragraph; and wherever a word stands that tells of a
template, the words around it that lie as the template's do.  So a notice is found inside
a longer line or sentence and across lines.  A segment and a licence template are sets of
word bigrams of their normalised words.  Dice is twice the shared bigrams over
the sum of both counts.  A Dice of t needs sizes within t / (2 - t) of each
other, so a segment's number of words rules out most templates before any set is
compared.  Before that, texts and segments without any of the few words that a
match can't do without are dropped.

All of it is built-in column functions; nothing is shuffled but the final
grouping of matches.  Templates are constants, a few dozen.

Defined results: one row for each document and matching licence, with its best
Dice and the number of matching segments that differ in their words; equal Dice values are all reported.  A
null or empty text matches nothing; a null doc_id is kept as a null key (its rows
count as one document); rows of one doc_id are one document; extra columns are ignored; an empty table gives an empty result.  Texts of any
length are read whole.
"""

from __future__ import annotations

import functools
import math
import re
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Notices as their licences give them.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "All-rights-reserved": "All rights reserved.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
        " to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
        " later version."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met:"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "MIT-full": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
        " to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
        " The above copyright notice and this permission notice shall be included in all copies or substantial portions of"
        " the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT"
        " NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO"
        " EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN"
        " ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR"
        " OTHER DEALINGS IN THE SOFTWARE."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held"
        " liable for any damages arising from the use of this software. Permission is granted to anyone to use this software"
        " for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the"
        " following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote"
        " the original software. If you use this software in a product, an acknowledgment in the product documentation would"
        " be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be"
        " misrepresented as being the original software. This notice may not be removed or altered from any source"
        " distribution."
    ),
}
THRESHOLD = 0.8


def words(text: str) -> list[str]:
    """Python twin of the normalisation, for the templates."""
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def bigrams(text: str) -> list[str]:
    found = words(text)
    return sorted({f"{a} {b}" for a, b in zip(found, found[1:], strict=False)})


#: Comment marks at the start of a line; ends of sentences; blank lines.
MARKS, ENDS, BLANK = r"(?m)^[ \t]*(?:#+|/?\*+/?|//+|;+|--+)[ \t]*", r"([.!?;:])[ \t\r\n]+", r"\n[ \t\r]*\n"
SENTENCES = 3
#: Words of a text that are looked through for windows at a time.
CHUNK = 500


def anchors(templates: dict[str, str], signs: dict[str, list[str]]) -> dict[str, list[tuple[int, int]]]:
    """Of each tell-tale word its places in templates, each with the template's number of words."""
    found: dict[str, set[tuple[int, int]]] = {}
    for name, text in templates.items():
        own = words(text)
        for place, word in enumerate(own):
            if word in signs[name]:
                found.setdefault(word, set()).add((place, len(own)))
    return {word: sorted(places) for word, places in sorted(found.items())}


def _windows(bare: DataFrame, places: dict[str, list[tuple[int, int]]]) -> DataFrame:
    """doc_id, segment: around each tell-tale word the words that would be a template's.
    Texts are taken in pieces that overlap by the longest template, and a window belongs to
    the piece that it starts in, so what a row makes is bounded."""
    longest = max(n for of in places.values() for _, n in of)
    of = F.create_map(*(x for w, ps in places.items() for x in (F.lit(w), F.array(*(F.struct(F.lit(p).alias("place"), F.lit(n).alias("n")) for p, n in ps)))))
    split = bare.select("doc_id", F.split(F.trim(F.regexp_replace("bare", "[^a-z0-9]+", " ")), " ").alias("w"))
    pieces = F.transform(F.sequence(F.lit(1), F.size("w"), F.lit(CHUNK)), lambda s: F.struct(s.alias("s"), F.slice("w", s, F.lit(CHUNK + longest)).alias("c")))
    rows = split.select("doc_id", F.explode(pieces).alias("piece")).select("doc_id", "piece.s", "piece.c")
    start = lambda i, a: F.greatest(F.lit(1), F.col("s") + i - a["place"])
    none = F.array().cast("array<struct<place: int, n: int>>")
    around = F.flatten(F.transform("c", lambda x, i: F.transform(F.coalesce(F.try_element_at(of, x), none), lambda a: F.struct(start(i, a).alias("start"), a["n"].alias("n")))))
    own = F.array_distinct(F.filter(around, lambda z: z["start"].between(F.col("s"), F.col("s") + CHUNK - 1)))
    texts = rows.withColumn("at", own).select("doc_id", F.transform("at", lambda z: F.array_join(F.slice("c", z["start"] - F.col("s") + 1, z["n"]), " ")).alias("t"))
    return texts.select("doc_id", F.explode(F.array_distinct("t")).alias("segment"))


def _segments(bare: DataFrame, told) -> DataFrame:
    """doc_id, segment: lines, paragraphs of more than one line, the whole of more
    than one paragraph, and runs of sentences, each once; only those that hold a
    tell-tale word.  Columns are made one after the other, so that each is worked
    out once and not again for every element."""
    none = F.array().cast("array<string>")
    parts = bare.withColumn("blocks", F.split("bare", BLANK, -1))
    said = parts.withColumn("said", F.transform("blocks", lambda b: F.split(F.regexp_replace(F.translate(b, "\n", " "), ENDS, "$1\n"), "\n", -1)))

    def runs(sentences: Column) -> Column:
        found, longer = [sentences], sentences
        for n in range(2, SENTENCES + 1):
            rest = F.greatest(F.size(sentences) - n + 1, F.lit(0))
            longer = F.zip_with(F.slice(longer, F.lit(1), rest), F.slice(sentences, F.lit(n), rest), lambda a, b: F.concat(a, F.lit(" "), b))
            found.append(longer)
        return F.concat(*found)

    many = F.filter("blocks", lambda b: F.instr(b, "\n") > 0)
    whole = F.when(F.size("blocks") > 1, F.array("bare")).otherwise(none)
    every = F.concat(F.split("bare", "\n", -1), many, whole, F.flatten(F.transform("said", runs)))
    return said.select("doc_id", F.explode(F.array_distinct(F.filter(every, told))).alias("segment"))


def bounds(n: int, threshold: float) -> tuple[int, int]:
    """Least and most bigrams of a segment that can reach the threshold against
    n bigrams.  Exact: floats come out one too tight for many n."""
    t = Fraction(str(threshold))
    return math.ceil(n * t / (2 - t)), math.floor(n * (2 - t) / t)


#: Words that most prose holds; they tell little.
COMMON = ("a", "an", "and", "any", "as", "by", "for", "in", "is", "of", "or", "that", "the", "this", "to", "with", "you")


def tell_tales(templates: dict[str, list[str]], threshold: float) -> dict[str, list[str]]:
    """For each template, words of which a match must hold one.  A Dice of t takes
    at least t / (2 - t) of a template's bigrams, so words that touch more than the
    rest of them can't all be missing.  Words that serve another template and long
    ones are taken first."""
    told: dict[str, list[str]] = {}
    for name, found in templates.items():
        spare, chosen, used = len(found) - bounds(len(found), threshold)[0], [], {w for words in told.values() for w in words}
        for word in sorted({w for b in found for w in b.split()}, key=lambda w: (w in COMMON, w not in used, -len(w), w)):
            if sum(bool(set(chosen) & set(b.split())) for b in found) > spare:
                break
            chosen.append(word)
        told[name] = chosen
    return told


def any_word(found: list[str]) -> str:
    """A pattern for any of some words as a whole word, which looks at each place where a
    word begins once and by its first letter."""
    by: dict[str, list[str]] = {}
    for word in sorted(found):
        by.setdefault(word[0], []).append(word[1:])
    return "(?<![a-z0-9])(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by.items()) + ")(?![a-z0-9])"


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, dice, n_segments."""
    templates = templates or TEMPLATES
    known = {name: bigrams(text) for name, text in templates.items()}
    low, high = ({n: bounds(len(b), threshold)[i] for n, b in known.items()} for i in (0, 1))
    least, most = min(low.values()), max(high.values())
    signs = tell_tales(known, threshold)
    holds = lambda c, words: functools.reduce(lambda p, q: p | q, (F.contains(c, F.lit(w)) for w in words))
    pattern = any_word(sorted({w for words in signs.values() for w in words}))
    told = lambda c: F.rlike(c, F.lit(pattern))
    lower = docs.select("doc_id", F.lower("text").alias("text")).where(told(F.col("text")))
    # d: only a line feed ends a line, as everywhere here.
    bare = lower.select("doc_id", F.regexp_replace("text", f"(?d){MARKS}", "").alias("bare"))
    segments = _segments(bare, told).unionByName(_windows(bare, anchors(templates, signs)))
    # A set of n bigrams needs n + 1 words, which need 2 n + 1 characters.
    short = segments.where(F.length("segment") >= 2 * least + 1)
    near = short.select("doc_id", F.trim(F.regexp_replace("segment", "[^a-z0-9]+", " ")).alias("s"))
    split = near.withColumn("w", F.split("s", " ")).where(F.size("w") > least)
    pairs = F.array_distinct(
        F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    )
    sets = split.select("doc_id", "s", pairs.alias("b")).where(F.size("b").between(int(least), int(most)))
    shared = {n: F.size(F.array_intersect("b", F.array(*map(F.lit, b)))) for n, b in known.items()}
    dice = {
        n: F.when(F.size("b").between(int(low[n]), int(high[n])) & holds(F.col("s"), signs[n]), F.round(2.0 * shared[n] / (F.size("b") + len(b)), 6))
        for n, b in known.items()
    }
    found = sets.select(
        "doc_id", "s", F.explode(F.array(*(F.struct(F.lit(n).alias("license"), d.alias("dice")) for n, d in dice.items()))).alias("x")
    ).select("doc_id", "s", "x.*")
    return (
        found.where(F.col("dice") >= threshold)
        .groupBy("doc_id", "license")
        .agg(F.max("dice").alias("dice"), F.count_distinct("s").alias("n_segments"))
    )


def oracle(threshold: float = THRESHOLD) -> str:
    """The same in DuckDB SQL, without any pruning."""
    signs = tell_tales({n: bigrams(t) for n, t in TEMPLATES.items()}, threshold)
    places = ", ".join(f"{{'word': '{w}', 'place': {p}, 'n': {n}}}" for w, ps in anchors(TEMPLATES, signs).items() for p, n in ps)
    rows = ", ".join("('{}', {})".format(n, "['" + "', '".join(bigrams(t)) + "']") for n, t in TEMPLATES.items())
    return rf"""
WITH t(license, tb) AS (VALUES {rows}),
bare AS (SELECT doc_id, REGEXP_REPLACE(LOWER(text), '{MARKS}', '', 'g') AS t FROM documents WHERE text IS NOT NULL),
parts AS (SELECT doc_id, t, STRING_SPLIT_REGEX(t, '{BLANK}') AS p FROM bare),
said AS (SELECT doc_id, t, p, [STRING_SPLIT(REGEXP_REPLACE(TRANSLATE(b, CHR(10), ' '), '{ENDS}', '\1' || CHR(10), 'g'), CHR(10)) FOR b IN p] AS s FROM parts),
seg AS (SELECT doc_id, UNNEST(LIST_DISTINCT(STRING_SPLIT(t, CHR(10)) || LIST_FILTER(p, LAMBDA b: CONTAINS(b, CHR(10))) || CASE WHEN LEN(p) > 1 THEN [t] ELSE [] END
  || FLATTEN([FLATTEN([[ARRAY_TO_STRING(x[i:i + k], ' ') FOR i IN RANGE(1, LEN(x) + 1 - k)] FOR k IN RANGE(0, {SENTENCES})]) FOR x IN s]))) AS s FROM said),
plain AS (SELECT doc_id, STRING_SPLIT(TRIM(REGEXP_REPLACE(t, '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM bare),
tells AS (SELECT [{places}] AS a),
near AS (SELECT doc_id, w, a, UNNEST(LIST_FILTER(RANGE(1, LEN(w) + 1), LAMBDA p: LIST_CONTAINS([x.word FOR x IN a], w[p]))) AS p FROM plain, tells),
cut AS (SELECT doc_id, w, GREATEST(1, p - x.place) AS b, x.n AS n FROM (SELECT doc_id, w, p, UNNEST(LIST_FILTER(a, LAMBDA x: x.word = w[p])) AS x FROM near)),
every AS (SELECT doc_id, s FROM seg UNION ALL SELECT doc_id, ARRAY_TO_STRING(w[b:b + n - 1], ' ') FROM cut),
w AS (SELECT doc_id, STRING_SPLIT(TRIM(REGEXP_REPLACE(LOWER(s), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM every),
b AS (SELECT doc_id, ARRAY_TO_STRING(w, ' ') AS s, LIST_DISTINCT([w[i] || ' ' || w[i + 1] FOR i IN RANGE(1, LEN(w))]) AS b FROM w WHERE LEN(w) > 1),
d AS (SELECT doc_id, s, license, ROUND(2.0 * LEN(LIST_INTERSECT(b, tb)) / (LEN(b) + LEN(tb)), 6) AS dice FROM b, t)
SELECT doc_id, license, MAX(dice) AS dice, COUNT(DISTINCT s) AS n_segments FROM d WHERE dice >= {threshold} GROUP BY doc_id, license
"""

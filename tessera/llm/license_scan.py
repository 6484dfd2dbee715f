"""Licence scan: Dice coefficient over word bigrams against licence templates, by DataFrame functions only.

A document's units are its lines, its paragraphs of several lines, and its whole text.
A unit is normalised (lower case, words of letters and digits), its set of word bigrams
is compared with each template's by Dice = 2 * common / (size + size), and a unit matches a
template at ``LEAST`` or more. Two prunings lose nothing:

* size bounds: a match needs a unit of between LEAST / (2 - LEAST) and (2 - LEAST) / LEAST times
  the template's bigrams, so other templates are not compared;
* anchors: a match shares at least LEAST / (2 - LEAST) of the template's bigrams, so it holds one
  of some words that together touch more bigrams than may be missing. Texts and units without
  any anchor are not split.

A notice that shares its line or paragraph with other words is found as a run: for each template, the lines
and paragraphs that match it are taken out (a foreign word stands for each) and all runs of words in the rest
of the text, across line ends, are compared. A run starts and ends with a bigram of the template, as others
score less, and has at most (2 - LEAST) / LEAST times its bigrams. Runs that overlap count once: the number
is that of the most disjoint ones. A template is tried only where the text holds LEAST / (2 - LEAST) of its
bigrams, which any match does, and not where the whole text matches it. The oracle knows units only; it is
equal on texts whose notices stand alone.

Defined results for odd input: null, empty and unit-free texts match nothing (null licence,
dice 0, no matches); units of one word have no bigrams and match nothing; of equal scores the
template first by name stands; rows with equal or null ids give a row each; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table, with_room

LEAST = 0.8

# Notices by which texts declare their licence, as their publishers word them.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "bsd-short": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mit": "Released under the MIT License.",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

WORD = "[^a-z0-9]+"  # what parts words


def words_of(text: str) -> list[str]:
    return [w for w in re.split(WORD, text.lower()) if w]


def bigrams_of(text: str) -> list[str]:
    """Distinct bigrams in order of first occurrence."""
    w = words_of(text)
    return list(dict.fromkeys(map(" ".join, zip(w, w[1:]))))


def anchors(templates: dict[str, str], least: float = LEAST) -> list[str]:
    """Words of which any match holds one: per template, words that touch more of its bigrams than a match may miss."""
    found: set[str] = set()
    for text in templates.values():
        grams = [g.split() for g in bigrams_of(text)]
        may_miss = len(grams) - math.ceil(len(grams) * least / (2 - least) - 1e-9)
        touched: set[int] = set()
        while len(touched) <= may_miss:
            new = {w: len({i for i, g in enumerate(grams) if w in g} - touched) for g in grams for w in g}
            # long words first: short ones are frequent in any text
            word = max((w for w in new if new[w]), key=lambda w: (len(w) > 4, new[w] * len(w), w))
            touched |= {i for i, g in enumerate(grams) if word in g}
            found.add(word)
    return sorted(found)


def _bigrams(unit: Column) -> Column:
    words = F.filter(F.split(F.lower(unit), WORD), lambda w: w != "")
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(words, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.when(n > 1, pairs).otherwise(F.slice(words, 1, 0)))


def _scores(unit: Column, templates: dict[str, str], least: float) -> Column:
    """array<struct<dice, license>> of the templates that a unit's bigrams match."""

    def of(grams: Column) -> Column:
        n = F.size(grams)
        found = []
        for name, text in sorted(templates.items()):
            own = bigrams_of(text)
            low, high = math.ceil(len(own) * least / (2 - least) - 1e-9), math.floor(len(own) * (2 - least) / least + 1e-9)
            common = F.size(F.array_intersect(grams, F.array(*map(F.lit, own))))
            dice = F.round(2 * common / (n + len(own)), 6)
            found.append(F.when(n.between(low, high) & (2 * common >= least * (n + len(own)) - 1e-9), F.struct(dice.alias("dice"), F.lit(name).alias("license"))))
        return F.filter(F.array(*found), lambda x: x.isNotNull())

    return F.flatten(F.transform(F.array(_bigrams(unit)), of))


def _anchor_pattern(templates: dict[str, str], least: float) -> str:
    return r"(?i)(?<![a-z0-9])(?:" + "|".join(map(re.escape, anchors(templates, least))) + r")(?![a-z0-9])"


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """``docs`` with ``matches``: array of (unit, dice, license), unit by unit.

    A unit is numbered by its kind and place: lines from 0, paragraphs after them, the whole text last.
    """
    templates = templates or TEMPLATES
    pattern = _anchor_pattern(templates, least)
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.split(text, "\n", -1)
    paragraphs = F.filter(F.split(text, r"\n[\x20\t\r]*\n", -1), lambda p: p.contains("\n"))
    several = F.size(lines) > 1
    none = F.expr("cast(array() as array<string>)")
    whole = F.when(several, F.array(text)).otherwise(none)
    units = F.when(text.rlike(pattern), F.concat(lines, paragraphs, whole)).otherwise(none)
    numbered = F.filter(F.transform(units, lambda u, i: F.struct(i.alias("unit"), u.alias("text"))), lambda x: x["text"].rlike(pattern))

    def of(x: Column) -> Column:
        return F.transform(
            _scores(x["text"], templates, least),
            lambda s: F.struct(x["unit"].alias("unit"), s["dice"].alias("dice"), s["license"].alias("license")),
        )

    return with_room(docs, "matches").withColumn("matches", F.flatten(F.transform(numbered, of)))


def _words(unit: Column) -> Column:
    return F.filter(F.split(F.lower(unit), WORD), lambda w: w != "")


def _runs_of(text: Column, name: str, template: str, least: float) -> Column:
    """struct<license, n, dice> of a template's runs in a text."""
    own, total = bigrams_of(template), len(words_of(template)) - 1
    high, known = math.floor(total * (2 - least) / least + 1e-9), F.array(*map(F.lit, own))
    need = math.ceil(len(own) * least / (2 - least) - 1e-9)

    def matches(unit: Column) -> Column:
        return F.exists(F.array(_bigrams(unit)), lambda g: 2 * F.size(F.array_intersect(g, known)) >= least * (F.size(g) + len(own)) - 1e-9)

    apart = F.array(F.lit("\n"))  # no word
    rest = F.flatten(
        F.transform(
            F.split(text, r"\n[\x20\t\r]*\n", -1),
            lambda p: F.when(p.contains("\n") & matches(p), apart).otherwise(
                F.flatten(F.transform(F.split(p, "\n", -1), lambda line: F.when(matches(line), apart).otherwise(_words(line))))
            ),
        )
    )

    def of(words: Column) -> Column:
        n = F.greatest(F.size(words) - 1, F.lit(0))
        return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))

    def found(grams: Column) -> Column:
        places = F.filter(F.transform(grams, lambda g, i: F.when(F.array_contains(known, g), i)), lambda i: i.isNotNull())
        none = F.expr("cast(array() as array<struct<start:int,end:int,dice:double>>)")

        def of_places(at: Column) -> Column:
            def ending(end: Column) -> Column:
                def run(start: Column) -> Column:
                    d = F.array_distinct(F.slice(grams, start + 1, end - start + 1))
                    return F.transform(
                        F.array(d),
                        lambda x: F.struct(start.alias("start"), end.alias("end"), (2 * F.size(F.array_intersect(x, known)) / (F.size(x) + len(own))).alias("dice")),
                    )[0]

                starts = F.filter(at, lambda start: (start <= end) & (end - start < high))
                return F.filter(F.transform(starts, run), lambda r: r["dice"] >= least - 1e-9)

            return F.flatten(F.transform(at, ending))

        enough = F.size(F.array_intersect(grams, known)) >= need
        return F.when(enough, F.flatten(F.transform(F.array(places), of_places))).otherwise(none)

    def counted(runs: Column) -> Column:
        start = F.struct(F.lit(-1).alias("at"), F.lit(0).alias("n"))

        def step(acc: Column, r: Column) -> Column:
            return F.when(r["start"] > acc["at"], F.struct(r["end"].alias("at"), (acc["n"] + 1).alias("n"))).otherwise(acc)

        # runs come by their ends, so the first that fits leaves most room
        n = F.aggregate(runs, start, step, lambda acc: acc["n"])
        return F.struct(F.lit(name).alias("license"), n.alias("n"), F.round(F.array_max(F.transform(runs, lambda r: r["dice"])), 6).alias("dice"))

    runs = F.transform(F.transform(F.transform(F.array(rest), of), found), counted)[0]
    return F.when(~(text.contains("\n") & matches(text)) & (runs["n"] > 0), runs)


def with_runs(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """``docs`` with ``runs``: array of (license, n, dice), templates that runs of words match beside the units of ``scan``."""
    templates = templates or TEMPLATES
    text = F.coalesce(F.col("text"), F.lit(""))
    known = F.array(*map(F.lit, sorted({g for t in templates.values() for g in bigrams_of(t)})))
    none = F.expr("cast(array() as array<struct<license:string,n:int,dice:double>>)")

    def of(held: Column) -> Column:
        found = []
        for name, template in sorted(templates.items()):
            own = bigrams_of(template)
            need = math.ceil(len(own) * least / (2 - least) - 1e-9)
            enough = F.size(F.array_intersect(held, F.array(*map(F.lit, own)))) >= need
            found.append(F.when(enough, _runs_of(text, name, template, least)))
        return F.filter(F.array(*found), lambda x: x.isNotNull())

    held = F.array_intersect(_bigrams(text), known)
    runs = F.flatten(F.transform(F.array(held), lambda x: F.when(F.size(x) > 0, of(x)).otherwise(none)))
    return with_room(docs, "runs").withColumn("runs", F.when(text.rlike(_anchor_pattern(templates, least)), runs).otherwise(none))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_runs(scan(table(spark, sf_dir, "documents").select("doc_id", "text")))
    scored = F.concat(*(F.transform(c, lambda m: F.struct((-m["dice"]).alias("d"), m["license"].alias("license"))) for c in ("matches", "runs")))
    order = F.array_sort(scored)
    n_runs = F.aggregate("runs", F.lit(0), lambda n, r: n + r["n"])
    best = F.get(order, F.lit(0))
    return found.select(
        "doc_id",
        best["license"].alias("license"),
        F.coalesce(-best["d"], F.lit(0.0)).alias("dice"),
        (F.size(F.array_distinct(F.transform("matches", lambda m: m["unit"]))) + n_runs).cast("long").alias("n_units"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(scored, lambda m: m["license"]))), ",").alias("licenses"),
    )


def _oracle() -> str:
    rows = ", ".join(f"('{name}', {bigrams_of(text)!r})" for name, text in sorted(TEMPLATES.items()))
    return f"""
WITH templates(license, own) AS (VALUES {rows}),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS unit, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM docs
), paragraphs AS (
  SELECT r, unit, 1000000000 + n AS n FROM (
    SELECT r, unnest(string_split_regex(text, '\\n[ \\t\\r]*\\n')) AS unit,
           generate_subscripts(string_split_regex(text, '\\n[ \\t\\r]*\\n'), 1) AS n FROM docs)
  WHERE contains(unit, chr(10))
), whole AS (
  SELECT r, text AS unit, 2000000000 AS n FROM docs
  WHERE contains(text, chr(10))
), units AS (
  SELECT r, n, list_filter(string_split_regex(lower(unit), '[^a-z0-9]+'), lambda w: w <> '') AS words
  FROM (FROM lines UNION ALL (FROM paragraphs) UNION ALL (FROM whole))
), grams AS (
  SELECT r, n, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS grams
  FROM units WHERE len(words) > 1
), scored AS (
  SELECT r, n, license, 2 * len(list_intersect(grams, own)) AS twice, len(grams) + len(own) AS total
  FROM grams, templates
  WHERE len(grams) BETWEEN ceil(len(own) * {LEAST} / (2 - {LEAST}) - 1e-9) AND floor(len(own) * (2 - {LEAST}) / {LEAST} + 1e-9)
), matches AS (
  SELECT r, n, license, round(twice::DOUBLE / total, 6) AS dice FROM scored WHERE twice >= {LEAST} * total - 1e-9
), best AS (
  SELECT r, arg_min(license, (-dice, license)) AS license, max(dice) AS dice, count(DISTINCT n) AS n_units,
         string_agg(DISTINCT license, ',' ORDER BY license) AS licenses
  FROM matches GROUP BY r
)
SELECT doc_id, license, coalesce(dice, 0.0)::DOUBLE AS dice, coalesce(n_units, 0)::BIGINT AS n_units, coalesce(licenses, '') AS licenses
FROM docs LEFT JOIN best USING (r)
"""


QUERIES = {"op3_license_scan": op3_license_scan}
ORACLES = {"op3_license_scan": _oracle()}

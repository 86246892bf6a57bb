"""Licence scan: text against licence templates by the Dice coefficient over word bigrams.

The units of a document are its lines, and its paragraphs (blocks between blank lines) of several lines, so that notices of one
line and wrapped texts are both compared whole. Text is normalised: lower case, other characters than letters and digits to blanks. A unit's set
holds its distinct pairs of neighbouring words, or the word itself for a single one. The Dice coefficient of two
sets, ``2 |A & B| / (|A| + |B|)``, can reach ``t`` only if ``|A|`` lies between ``|B| t / (2 - t)`` and ``|B| (2 - t) / t``; a unit is compared
with the templates whose sizes allow it, and one that has too few or too many words for all of them with none. A match also has at least ``|B| t / (2 - t)`` of
the template's pairs, so it has one of any selection that leaves fewer out: for each template a few telling words are chosen that are in that
many of its pairs, and texts and units with none of these words are put aside.

All of it is built from DataFrame functions within the row: no shuffle, no join, no Python on the data. The templates are a fixed list in the plan.

Defined cases: null, empty and blank texts match nothing; of equal scores the first licence by name counts for a unit; a document lists each licence once with its best
score, best first, then by name; repeated rows are scanned each; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_DICE = 0.7

# The usual notices and the operative paragraphs of public licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This project is licensed under the terms of the Apache License 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "This project is licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "This project is licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

_BETWEEN = r"[^\p{L}\p{N}]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def template_bigrams(text: str) -> list[str]:
    words = re.findall(r"[^\W_]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}) or words


def size_bounds(size: int, least: float) -> tuple[int, int]:
    """The smallest and largest set that can reach the coefficient with one of ``size``."""
    return max(1, -int(-(size * least / (2 - least) - 1e-9) // 1)), int(size * (2 - least) / least + 1e-9)


# Words too common to tell a notice, taken as tell-tales last.
_COMMON = frozenset("a all and any appear be by can copies copy deal file following for form free fee from in is it law may met not notice obtain of on or other person persons possible purpose rights so software source subject that the this to under use version with without work you".split())


def telling_words(text: str, least: float) -> list[str]:
    """Words of which any text that matches the template has one."""
    bigrams = template_bigrams(text)
    allowed = len(bigrams) - size_bounds(len(bigrams), least)[0]  # pairs that a match may lack
    words = sorted({w for b in bigrams for w in b.split()}, key=lambda w: (w in _COMMON or w.isdigit(), -len(w), w))
    chosen, left = [], set(bigrams)
    for word in words:
        if len(left) <= len(bigrams) - allowed - 1:
            break
        hit = {b for b in left if word in b.split()}
        if hit:
            chosen.append(word)
            left -= hit
    return chosen


def _words(unit: Column) -> Column:
    return F.filter(F.split(F.translate(unit, _CAPITALS, _CAPITALS.lower()), _BETWEEN), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.when(F.size(words) > 1, pairs).otherwise(words))


def _template_column(templates: list[tuple[str, str]], least: float) -> Column:
    rows = []
    for name, text in sorted(templates):
        bigrams = template_bigrams(text)
        low, high = size_bounds(len(bigrams), least)
        rows.append(F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, bigrams)).alias("bigrams"), F.lit(low).alias("low"), F.lit(high).alias("high")))
    return F.array(*rows)


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = MIN_DICE) -> DataFrame:
    """``doc_id, license, score, n_units, licenses`` for each row of ``docs``.

    ``license`` and ``score``: the best match; ``n_units``: the lines and paragraphs that match; ``licenses``: ``(name, score)`` of all found.
    """
    bounds = [size_bounds(len(template_bigrams(text)), least) for _, text in templates]
    fewest, most = min(low for low, _ in bounds), max(high for _, high in bounds)
    words = sorted({w for _, text in templates for w in telling_words(text, least)})
    tells = F.array(*map(F.lit, words))
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.split(text, r"\r?\n")
    blocks = F.filter(F.split(text, r"\r?\n[ \t]*\r?\n\s*"), lambda b: F.contains(F.trim(b), F.lit("\n")))
    # Here all letters are lower-cased, which is faster and finds no less.
    tell = F.arrays_overlap(F.split(F.lower(text), _BETWEEN), tells)
    units = F.when(tell, F.filter(F.transform(F.concat(lines, blocks), _words), lambda w: F.arrays_overlap(w, tells))).otherwise(F.array().cast("array<array<string>>"))
    told = F.transform(units, _bigrams)
    sized = F.filter(told, lambda b: (F.size(b) >= fewest) & (F.size(b) <= most))
    scored = F.filter(F.transform(sized, lambda b: _best(b, F.col("_templates"), least)), lambda m: m["score"] >= least)
    found = docs.select("doc_id", "text").withColumn("_templates", _template_column(templates, least)).select("doc_id", scored.alias("found"))
    best = F.transform(
        F.array_distinct(F.col("found.name")),
        lambda n: F.struct((-F.array_max(F.transform(F.filter("found", lambda m: m["name"] == n), lambda m: m["score"]))).alias("order"), n.alias("name")),
    )
    ranked = F.transform(F.array_sort(best), lambda m: F.struct(m["name"].alias("name"), (-m["order"]).alias("score")))
    out = found.select("doc_id", F.size("found").alias("n_units"), ranked.alias("licenses"))
    first = F.get("licenses", F.lit(0))
    return out.select("doc_id", first["name"].alias("license"), first["score"].alias("score"), "n_units", "licenses")


def _best(bigrams: Column, templates: Column, least: float) -> Column:
    """``name, score`` of the best template whose size allows a match."""
    near = F.filter(templates, lambda t: (F.size(bigrams) >= t["low"]) & (F.size(bigrams) <= t["high"]))
    scored = F.transform(
        near,
        lambda t: F.struct((2.0 * F.size(F.array_intersect(bigrams, t["bigrams"])) / (F.size(bigrams) + F.size(t["bigrams"]))).alias("score"), t["name"].alias("name")),
    )
    nothing = F.struct(F.lit(0.0).alias("score"), F.lit("").alias("name"))
    return F.aggregate(scored, nothing, lambda a, b: F.when(b["score"] > a["score"], b).otherwise(a))

"""Licence notices by the Dice coefficient over word bigrams.

A text is one run of normalised words (lower-case letters and digits), so
line breaks, indentation and the sentence around a notice do not matter. For
a template of ``w`` words every window of ``w`` words (fewer at the ends of a
text) is a candidate; it matches if the Dice coefficient of the two sets of
word bigrams, ``2 * |A n B| / (|A| + |B|)``, reaches the threshold ``t``.

Size bounds prune the windows before any is built: a match with a template
of ``b`` bigrams shares at least ``ceil(b * t / (2 - t))`` of them, so it
holds one of any ``b - that + 1``; the widest ones are its anchors. Texts
without a word of an anchor are passed over before they are cut into words;
windows are laid only around anchors whose surroundings hold that many of the
template's bigrams at all. All of it is row-wise DataFrame functions: no
shuffle, and the templates (a parameter) are literals in the plan.

Matching windows of one licence that overlap are one place, with the best of
their coefficients.

Defined results: null and empty texts have no matches; whole texts are
scanned, however long; places are ordered by licence and position; notices of
one licence that follow each other without a word between are one place;
repeated rows give repeated results; templates with fewer than two words are
passed over; an input column named ``matches`` is replaced, columns starting
with ``__`` are reserved.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Customary notices of public licences.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "This work is licensed under the Apache License, Version 2.0"),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License'),
    ("bsd-3-clause", "Released under the BSD 3-Clause License"),
    ("bsd-style", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-style", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; "
        "either version 2 of the License, or (at your option) any later version",
    ),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version",
    ),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    (
        "mit",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("public-domain", "This is free and unencumbered software released into the public domain"),
)

WORD = r"[\p{L}\p{N}]+"


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def least_shared(size: int, threshold: float) -> int:
    """Bigrams that a match shares with a template of ``size`` bigrams."""
    return math.ceil(size * threshold / (2 - threshold) - 1e-9)


def anchors(grams: list[str], threshold: float) -> list[str]:
    """Bigrams of which every match holds at least one: the widest ones."""
    width = lambda g: (max(map(len, g.split())), len(g), g)
    return sorted(grams, key=width, reverse=True)[: len(grams) - least_shared(len(grams), threshold) + 1]


def _cued(anchor_grams: list[str]):
    """Condition on a lower-case text: does it hold a word of an anchor? For
    anchors of short words: the words in a row."""
    words = {max(g.split(), key=len) for g in anchor_grams if max(map(len, g.split())) >= 5}
    words = sorted(w for w in words if not any(v != w and v in w for v in words))
    short = sorted(g for g in anchor_grams if max(map(len, g.split())) < 5)
    pattern = "|".join(r"[^\p{L}\p{N}]+".join(map(re.escape, g.split())) for g in short)
    return lambda x: reduce(or_, [F.contains(x, F.lit(w)) for w in words] + [F.rlike(x, F.lit(pattern))] * bool(short))


def _pairs(text: Column) -> Column:
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    # the last word meets nothing; zip_with pads it with null
    both = F.zip_with(words, F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(both, lambda p: p.isNotNull())


def scan(docs: DataFrame, text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """Adds ``matches``: array of struct(license, dice, start, words), the
    places by licence and position in words."""
    sized = [(name, len(template_words(body)), g) for name, body in templates if (g := template_bigrams(body))]
    if not sized:
        raise ValueError("no template has two words")
    names = sorted({n for n, _, _ in sized})
    row = lambda n, w, g: F.struct(F.lit(names.index(n)).alias("license"), F.lit(w).alias("words"), F.array(*map(F.lit, g)).alias("grams"), F.array(*map(F.lit, anchors(g, threshold))).alias("anchors"), F.lit(least_shared(len(g), threshold)).alias("least"))
    table = F.array(*[row(*x) for x in sized])
    every = sorted({a for _, _, g in sized for a in anchors(g, threshold)})
    cued = _cued(every)

    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    none = F.array().cast("array<string>")
    read = docs.drop("matches").withColumn("__pairs", F.when(cued(lowered), _pairs(lowered)).otherwise(none))
    here = F.transform("__pairs", lambda g, i: F.when(g.isin(every), i))
    read = read.withColumn("__marks", F.filter(here, lambda i: i.isNotNull()))
    total = F.size("__pairs")

    def between(lo: Column, hi: Column) -> Column:
        """Bigrams from ``lo`` on, before ``hi``, within the text."""
        lo, hi = F.greatest(lo, F.lit(0)), F.least(hi, total)
        return F.slice("__pairs", lo + 1, hi - lo)

    def windows(t: Column) -> Column:
        span = t["words"] - 1  # bigrams of a whole window
        own = F.filter("__marks", lambda i: F.array_contains(t["anchors"], F.get("__pairs", i)))
        near = F.filter(own, lambda i: F.size(F.array_intersect(between(i - span + 1, i + span), t["grams"])) >= t["least"])
        starts = F.array_distinct(F.flatten(F.transform(near, lambda i: F.sequence(i - span + 1, i))))

        def scored(s: Column) -> Column:
            grams = F.array_distinct(between(s, s + span))
            dice = F.lit(2.0) * F.size(F.array_intersect(grams, t["grams"])) / (F.size(grams) + F.size(t["grams"]))
            first = F.greatest(s, F.lit(0))
            return F.struct(t["license"].alias("license"), first.alias("start"), F.least(s + t["words"], total + 1).alias("end"), dice.alias("dice"))

        return F.filter(F.transform(starts, scored), lambda w: w["dice"] >= threshold)

    found = F.array_sort(F.flatten(F.transform(table, windows)))  # by licence, start, end
    read = read.withColumn("__found", F.when(F.size("__marks") > 0, found))

    def joined(places: Column, w: Column) -> Column:
        last = F.try_element_at(places, F.lit(-1))
        meets = F.coalesce((last["license"] == w["license"]) & (w["start"] < last["end"]), F.lit(False))
        grown = F.struct(last["license"].alias("license"), last["start"].alias("start"), F.greatest(last["end"], w["end"]).alias("end"), F.greatest(last["dice"], w["dice"]).alias("dice"))
        return F.when(meets, F.concat(F.slice(places, F.lit(1), F.greatest(F.size(places) - 1, F.lit(0))), F.array(grown))).otherwise(F.concat(places, F.array(w)))

    islands = F.aggregate("__found", F.array().cast("array<struct<license:int,start:int,end:int,dice:double>>"), joined)
    names_of = F.array(*map(F.lit, names))
    matches = F.transform(islands, lambda m: F.struct(F.get(names_of, m["license"]).alias("license"), m["dice"].alias("dice"), m["start"].alias("start"), (m["end"] - m["start"]).alias("words")))
    empty = F.array().cast("array<struct<license:string,dice:double,start:int,words:int>>")
    return read.withColumn("matches", F.coalesce(matches, empty)).drop("__pairs", "__marks", "__found")


def best_places(matches: Column) -> Column:
    """The places that no place of another licence overlaps with a greater
    coefficient (equal ones: a name first in order)."""
    def beaten(m: Column) -> Column:
        meets = lambda o: (o["start"] < m["start"] + m["words"]) & (m["start"] < o["start"] + o["words"])
        better = lambda o: (o["dice"] > m["dice"]) | ((o["dice"] == m["dice"]) & (o["license"] < m["license"]))
        return F.exists(matches, lambda o: (o["license"] != m["license"]) & meets(o) & better(o))

    return F.filter(matches, lambda m: ~beaten(m))

"""Licence scans by Dice similarity over word bigrams, DataFrame functions only.

Every line and every paragraph of a text is normalised (lower case, runs of
anything but letters and digits become one space) and turned into its set of
word bigrams. A set of size b can reach Dice ``d`` with a template of size a
only if ``a d / (2 - d) <= b <= a (2 - d) / d``; templates outside these
bounds are never compared. Whole texts are scanned in one projection: no
shuffle, no join, nothing per key.

Defined results: null, empty and blank texts match nothing; a segment of one
word has no bigram; ties between templates are all reported; repeated rows are
scanned one by one; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import math
import re
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.tables import id_text

DICE = 0.8

# Notice and licence texts as their authors publish them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
    "except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met",
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
    "your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Licensed under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "public-domain": "This work has been dedicated to the public domain.",
}


def template_bigrams(text: str) -> list[str]:
    """The same normal form as ``_bigrams``, for the fixed templates."""
    words = re.findall("[a-z0-9]+", text.lower())
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def size_bounds(a: int, dice: float) -> tuple[int, int]:
    """Set sizes that can reach ``dice`` with a template of ``a`` bigrams, in
    exact fractions: a set of a bound's size may reach ``dice`` exactly."""
    d = Fraction(str(dice))
    return math.ceil(a * d / (2 - d)), math.floor(a * (2 - d) / d)


def _words(segment: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(segment), "[^a-z0-9]+", " "), " "), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(words, 1, pairs), F.slice(words, 2, pairs), lambda a, b: F.concat_ws(" ", a, b)))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, dice: float = DICE) -> DataFrame:
    """doc_id and ``matches``: distinct (licence, dice) of its segments."""
    sets = {k: template_bigrams(t) for k, t in (templates or TEMPLATES).items()}
    bounds = {k: size_bounds(len(b), dice) for k, b in sets.items()}
    low, high = min(b[0] for b in bounds.values()), max(b[1] for b in bounds.values())
    known = F.array(*[F.lit(x) for x in sorted({x for b in sets.values() for x in b})])
    text = F.coalesce(F.col("text"), F.lit(""))
    segments = F.array_union(F.split(text, "\n"), F.split(text, "\n[ \t\r]*\n"))
    words = F.filter(F.transform(segments, _words), lambda w: F.size(w) > low)
    grams = F.filter(F.transform(words, _bigrams), lambda g: F.size(g).between(low, high))
    grams = F.array_distinct(F.filter(grams, lambda g: F.arrays_overlap(g, known)))

    def against(gram: Column) -> Column:
        found = []
        for name, own in sets.items():
            shared = F.size(F.array_intersect(gram, F.array(*[F.lit(x) for x in own])))
            value = F.when(F.size(gram).between(*bounds[name]), shared * 2.0 / (F.size(gram) + len(own))).otherwise(0.0)
            found.append(F.struct(F.lit(name).alias("license"), value.alias("dice")))
        return F.filter(F.array(*found), lambda m: m.dice >= dice)

    matches = F.array_sort(F.array_distinct(F.flatten(F.transform(grams, against))))
    return id_text(docs).select("doc_id", matches.alias("matches"))


def digest(scanned: DataFrame) -> DataFrame:
    return scanned.select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_distinct(F.transform("matches", lambda m: m.license)), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m.dice)), F.lit(0.0)).alias("best_dice"))

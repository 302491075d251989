"""Licence notices in texts, by the Dice coefficient over word bigrams.

Every line and every block between blank lines is a unit. It is normalised to lower-case words
and compared with licence templates; a bigram counts as often as it occurs. Dice can reach the
threshold t only if the unit has between t / (2 - t) and (2 - t) / t times as many bigrams as
the template, so the number of words alone leaves few candidate templates, or none. Only
DataFrame operations are used, all of them within the row.
"""

import math
import re

from pyspark.sql import Column, DataFrame, functions as F

THRESHOLD = 0.75
WORD = r"[\p{L}\p{N}]+"

# The wording of the notices themselves, as their licences ask for it.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this "
        "file except in compliance with the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GNU General Public License, version 3 or later."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    ),
    ("ISC", "Released under the ISC License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    ("CC0-1.0", "Released under CC0 1.0 Universal."),
    ("proprietary", "All rights reserved."),
)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def bigrams_of(words: Column) -> Column:
    """The pairs of neighbouring words, repeats included."""
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(
        F.slice(words, F.lit(1), pairs),
        F.slice(words, F.lit(2), pairs),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )


def template_bigrams(text: str) -> list[str]:
    words = re.findall(r"[^\W_]+", text.lower())
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def size_bounds(grams: int, threshold: float) -> tuple[int, int]:
    """The fewest and the most bigrams of a unit that can reach the threshold."""
    return math.ceil(grams * threshold / (2 - threshold) - 1e-9), math.floor(
        grams * (2 - threshold) / threshold + 1e-9
    )


def _literal(templates, threshold: float) -> Column:
    entries = []
    for licence, text in templates:
        grams = template_bigrams(text)
        if not grams:
            raise ValueError(f"a template of {licence} has fewer than two words")
        least, most = size_bounds(len(grams), threshold)
        entries.append(
            F.struct(
                F.lit(licence).alias("licence"),
                F.lit(grams).alias("grams"),
                F.lit(least).alias("least"),
                F.lit(most).alias("most"),
            )
        )
    return F.array(*entries)


def _times(grams: Column, gram: Column) -> Column:
    return F.size(F.filter(grams, lambda g: g == gram))


def _shared(own: Column, others: Column) -> Column:
    """Bigrams in both, each as often as it is in the one that has it less often."""
    return F.aggregate(
        F.array_intersect(own, others),
        F.lit(0),
        lambda n, g: n + F.least(_times(own, g), _times(others, g)),
    )


def scan(
    documents: DataFrame,
    text: str = "text",
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """`documents` without the text, with `notices`: (dice, licence, unit) of every unit that
    reaches the threshold, its best template each, the first licence in order on ties.

    Notices stand in order of falling dice, then of licence and unit. Units that are equal
    within a document count once. Null and empty texts have none; repeated rows have each
    their own. A column named `notices` is replaced.
    """
    known = _literal(templates, threshold)
    bounds = [size_bounds(len(template_bigrams(t)), threshold) for _, t in templates]
    least, most = min(b[0] for b in bounds), max(b[1] for b in bounds)
    rest = [c for c in documents.columns if c != text and c.lower() != "notices"]
    body = F.coalesce(F.col(text), F.lit(""))
    units = F.array_distinct(F.concat(F.split(body, "\n"), F.split(body, r"\n[ \t]*\n")))
    # Step by step, so that nothing is computed twice or for units that are out of bounds.
    read = F.filter(
        F.transform(units, lambda u: F.struct(u.alias("unit"), words_of(u).alias("words"))),
        lambda u: (F.size(u["words"]) - 1).between(least, most),
    )
    paired = F.transform(
        read, lambda u: F.struct(u["unit"].alias("unit"), bigrams_of(u["words"]).alias("grams"))
    )

    def best(u: Column) -> Column:
        size = F.size(u["grams"])
        candidates = F.filter(known, lambda t: size.between(t["least"], t["most"]))
        return F.array_min(
            F.transform(
                candidates,
                lambda t: F.struct(
                    (-2.0 * _shared(u["grams"], t["grams"]) / (size + F.size(t["grams"]))).alias(
                        "minus_dice"
                    ),
                    t["licence"].alias("licence"),
                    u["unit"].alias("unit"),
                ),
            )
        )

    found = F.array_sort(F.filter(F.transform(paired, best), lambda m: m["minus_dice"] <= -threshold))
    notices = F.transform(
        found,
        lambda m: F.struct(
            (-m["minus_dice"]).alias("dice"), m["licence"].alias("licence"), m["unit"].alias("unit")
        ),
    )
    return documents.select(*rest, notices.alias("notices"))

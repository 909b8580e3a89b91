"""License scan by MinHash bands over text windows, in DataFrame functions only.

Windows of words are drawn through each text so that every place lies well inside one. The
MinHash bands of a window retrieve templates, and exact containment of a template's shingles
in the text around the window verifies the match. Only texts with one of the templates' key
words have windows: the words are chosen so that no text without any can hold enough of a
template's shingles.
"""

from pyspark.sql import functions as F

from rateflow.operators.joins import broadcast_if_small

# Openings of public license texts and notices, by name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
SHINGLE = 3
CONTAINED = 0.75
# Bands of one row each: a window with similarity s to a template retrieves it with chance
# 1 - (1 - s)^BANDS. A window has at most four times a template's words, so a match has at
# least a similarity of 0.75 / 4 and is retrieved with a chance above 0.9999.
BANDS = 48
# A template's class is the least of 8, 16, 32, ... that its words do not exceed; its windows have
# twice as many words, one begins at each.
LEAST_CLASS, USUAL_CLASS = 8, 64
WORD = r"[\p{L}\p{N}]+"


def _once(column):
    """A generator of one row, so that what follows reads the value and does not repeat it."""
    return F.explode(F.array(column))


def _words(text):
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _shingles(words):
    """Hashes of the shingles of an array of words, in order; a shorter one is one shingle."""
    last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(words, i + 1, F.lit(SHINGLE))))


def _bands(shingles):
    """The least value of the shingles under each of ``BANDS`` hash functions, as band keys."""
    odd = [(2 * i + 1) * 0x9E3779B97F4A7C15 % 2**63 | 1 for i in range(BANDS)]
    least = [F.array_min(F.transform(shingles, _under(a))) for a in odd]
    return F.array(*[F.struct(F.lit(i).alias("band"), value.alias("least")) for i, value in enumerate(least)])


def _under(seed):
    return lambda h: F.xxhash64(h.bitwiseXOR(F.lit(seed)))


def key_words(templates):
    """Words such that less than ``CONTAINED`` of each template's shingles lack them all."""
    import re
    from collections import Counter

    shingles = {}
    for name, text in templates.items():
        words = re.findall(r"[^\W_]+", text.lower())
        shingles[name] = [words[i : i + SHINGLE] for i in range(max(1, len(words) - SHINGLE + 1))]
    chosen = set()
    lacking = lambda s: [x for x in s if not chosen & set(x)]
    while open_ := [s for s in shingles.values() if len(lacking(s)) >= CONTAINED * len(s)]:
        counts = Counter(w for s in open_ for x in lacking(s) for w in set(x) if len(w) > 2)
        chosen.add(max(counts, key=lambda w: (counts[w] * len(w), w)))
    return sorted(chosen)


def classes_of(templates):
    """Classes up to that of the longest template."""
    import regex

    longest = max((len(regex.findall(WORD, text.lower())) for text in templates.values()), default=0)
    classes = [LEAST_CLASS]
    while classes[-1] < max(longest, USUAL_CLASS):
        classes.append(2 * classes[-1])
    return classes


def _templates(spark, templates):
    rows = []
    for name, text in templates.items():
        rows.append((name, text))
    table = spark.createDataFrame(rows, "license string, text string")
    table = table.select("license", _once(_words(F.col("text"))).alias("words"))
    classes = classes_of(templates)
    size = F.coalesce(*[F.when(F.size("words") <= c, F.lit(c)) for c in classes[:-1]], F.lit(classes[-1]))
    return table.select("license", size.alias("class"), _once(F.array_distinct(_shingles(F.col("words")))).alias("wanted"))


def _windows(words, size, keys):
    """Windows of twice ``size`` words that hold a key word, with their place."""
    places = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)), F.lit(size))
    windows = F.transform(
        places,
        lambda i: F.struct(F.lit(size).alias("class"), i.alias("at"), F.slice(words, i + 1, F.lit(2 * size)).alias("words")),
    )
    return F.filter(windows, lambda w: F.arrays_overlap(w["words"], keys))


def find_licenses(documents, templates=None):
    """Table ``doc_id, license, containment, first_word``: one row per document and template found.

    ``containment`` is the largest share of the template's shingles in one window,
    ``first_word`` the place of the first of them, counted in words from 0. Null and empty
    texts hold nothing; a repeated doc_id is one document here; other columns are not read.
    Templates may have any number of words.
    """
    spark = documents.sparkSession
    templates = TEMPLATES if templates is None else templates
    words = key_words(templates)
    known = _templates(spark, templates)
    bands = known.select("license", "class", F.explode(_bands(F.col("wanted"))).alias("b"))
    bands = broadcast_if_small(bands.select("license", "class", "b.*"))
    keyed = documents.where(F.col("text").rlike(rf"(?i)(?<![\p{{L}}\p{{N}}])(?:{'|'.join(words)})(?![\p{{L}}\p{{N}}])"))
    keyed = keyed.select("doc_id", _once(_words(F.col("text"))).alias("words"))
    literal = F.array(*[F.lit(w) for w in words])
    windows = F.concat(*[_windows(F.col("words"), c, literal) for c in classes_of(templates)])
    windows = keyed.select("doc_id", F.explode(windows).alias("w"))
    windows = windows.select("doc_id", "w.class", "w.at", _once(_shingles(F.col("w.words"))).alias("shingles"))
    banded = windows.select("doc_id", "class", "at", "shingles", F.explode(_bands(F.col("shingles"))).alias("b"))
    banded = banded.select("doc_id", "class", "at", "shingles", "b.*").join(bands, ["class", "band", "least"])
    met = banded.groupBy("doc_id", "class", "at", "license").agg(F.first("shingles").alias("shingles"))
    verified = met.join(broadcast_if_small(known.drop("class")), "license")
    share = F.size(F.array_intersect("wanted", "shingles")) / F.size("wanted")
    first = F.array_min(F.transform("wanted", lambda h: F.nullif(F.array_position("shingles", h), F.lit(0))))
    verified = verified.select("doc_id", "license", share.alias("containment"), (F.col("at") + first - 1).alias("first_word"))
    found = verified.where(F.col("containment") >= CONTAINED).groupBy("doc_id", "license")
    return found.agg(F.max("containment").alias("containment"), F.min("first_word").cast("long").alias("first_word"))

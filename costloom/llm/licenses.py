"""License scan: sparse TF-IDF cosine of statements to templates, and inheritance from directories.

Each sentence and line of a file is a segment, and so is each sentence of a paragraph or comment whose lines are joined,
without the signs of comments at their starts; so statements wrapped over lines are found. Segments and templates are vectors of words weighted by
count times inverse document frequency; the frequencies of the templates' words are counted over all segments of
the corpus, other words weigh as much as a word that no segment has. A segment whose cosine to a
template reaches MIN_COSINE states that licence; a file has the licence of its best statement (ties: the first
licence by name; a licence whose text holds another's goes before that one). Templates are statements, titles of
licence texts, and sentences of standard notices and permissions; full licence texts are known by these, not
by a vector of the whole file. Where the file is a licence file, that is also the licence of its directory. Files without
a statement inherit the licence of the nearest directory above them that has one.

Everything is a DataFrame expression. Scores need no shuffle: only the frequencies of the templates' words (a
fixed number of rows) are summed over the corpus. Inheritance joins directories, not files, with their ancestors,
and files with their own directory once; a directory of any size is one row on the small side.

Null texts state nothing, null paths have no directory and neither give nor inherit. A directory with several
licence files has the licence of the best statement. Repeated paths each get their result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom.llm.storage import let, stored

MIN_COSINE = 0.75
LICENSE_FILE = r"(?i)(^|/)((un)?licen[cs]e|copying|notice)([-.][a-z0-9.+-]+)?$"

# Statements of public licences, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License", "Use of this source code is governed by a BSD-style license"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License", "Licensed under the three-clause BSD License"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "CC0-1.0": ["Released under CC0 1.0 Universal", "Dedicated to the public domain under CC0"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3"],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3"],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3"],
    "ISC": ["Released under the ISC License"],
    "MIT": ["Released under the MIT License", "Licensed under the MIT License"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
}
# Titles of licence texts.
TITLES = {
    "AGPL-3.0": ["GNU Affero General Public License Version 3, 19 November 2007"],
    "Apache-2.0": ["Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International Public License"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International Public License"],
    "CC-BY-SA-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International Public License"],
    "GPL-2.0": ["GNU General Public License Version 2, June 1991"],
    "GPL-3.0": ["GNU General Public License Version 3, 29 June 2007"],
    "LGPL-2.1": ["GNU Lesser General Public License Version 2.1, February 1999"],
    "LGPL-3.0": ["GNU Lesser General Public License Version 3, 29 June 2007"],
    "MPL-2.0": ["Mozilla Public License Version 2.0"],
}
_FSF = (
    "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the "
    "Free Software Foundation, either version {} of the License, or (at your option) any later version"
)
# Sentences of standard notices and permissions.
NOTICES = {
    "AGPL-3.0": [_FSF.format("program", "Affero General Public License", "3")],
    "Apache-2.0": ['Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License'],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ],
    "BSD-3-Clause": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission"
    ],
    "GPL-2.0": [_FSF.format("program", "General Public License", "2")],
    "GPL-3.0": [_FSF.format("program", "General Public License", "3")],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies"
    ],
    "LGPL-2.1": [_FSF.format("library", "Lesser General Public License", "2.1")],
    "LGPL-3.0": [_FSF.format("library", "Lesser General Public License", "3")],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions"
    ],
    "MPL-2.0": [
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"
    ],
    "Unlicense": [
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or "
        "as a compiled binary, for any purpose, commercial or non-commercial, and by any means"
    ],
}
#: Templates that are compared on bounds of their own: short ones and long ones.
GROUPS = ({k: TEMPLATES.get(k, []) + TITLES.get(k, []) for k in {**TEMPLATES, **TITLES}}, NOTICES)
#: A licence whose text holds the statements of another.
HOLDS = (("BSD-3-Clause", "BSD-2-Clause"),)
# Spellings that are one word here.
SAME = (("licence", "license"), ("v2", "2"), ("v3", "3"), ("2.0", "2"), ("3.0", "3"), ("4.0", "4"), ("1.0", "1"))
_BREAK = r"[\n]+|(?<=[.!?;])\x20+"
#: Signs of a comment at the start of a line, and the end of a paragraph.
_COMMENT = r"(?m)^[ \t]*(?://+|/\*+|\*+/?|#+|;+|--+|<!--|%+)?[ \t]*"
_PARAGRAPH = r"\n[ \t\r]*\n"
_WORD = r"[a-z0-9](?:[a-z0-9.-]*[a-z0-9])?"


def _python_words(text: str) -> list[str]:
    import re

    same = dict(SAME)
    return [same.get(w, w) for w in re.findall(_WORD, text.lower())]


def _words(segment: Column) -> Column:
    """Words as they are spelled."""
    return F.regexp_extract_all(F.lower(segment), F.lit(_WORD), F.lit(0))


def _same(words: Column) -> Column:
    """Words in one spelling each."""

    def one(word: Column) -> Column:
        out = word
        for old, new in SAME:
            out = F.when(word == old, F.lit(new)).otherwise(out)
        return out

    return F.transform(words, one)


def _known(words: Column, vocabulary: list[str]) -> Column:
    """The different words of the vocabulary, in one spelling each, among words as they are spelled."""
    spelled = sorted({*vocabulary, *(old for old, new in SAME if new in vocabulary)})
    # One fixed set: array_intersect would fill a new one with the vocabulary for every segment.
    return F.array_distinct(_same(F.filter(words, lambda w: w.isin(spelled))))


def _vocabulary(*groups: dict[str, list[str]]) -> list[str]:
    return sorted({w for g in groups or GROUPS for ts in g.values() for t in ts for w in _python_words(t)})


def _segments(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _BREAK, -1), lambda s: F.trim(s) != "")


def _joined(text: Column) -> Column:
    """Sentences of paragraphs and comments whose lines are joined."""
    blocks = F.split(F.regexp_replace(text, _COMMENT, ""), _PARAGRAPH, -1)
    several = F.filter(blocks, lambda b: F.instr(F.trim(b), "\n") > 0)
    parts = F.flatten(F.transform(several, lambda b: F.split(F.replace(b, F.lit("\n"), F.lit(" ")), _BREAK, -1)))
    none = F.array().cast("array<string>")
    return F.when(F.instr(text, "\n") > 0, F.filter(parts, lambda s: F.trim(s) != "")).otherwise(none)


def frequencies(files: DataFrame) -> DataFrame:
    """One row: `n` segments, and `df`, for each word of the templates the number of segments that have it."""
    parts = files.select(F.explode(_segments(F.col("text"))).alias("segment"))
    common = _known(_words(F.col("segment")), _vocabulary())
    # The empty word counts the segments.
    words = parts.select(F.explode(F.concat(F.array(F.lit("")), common)).alias("word"))
    sums = words.groupBy("word").agg(F.count("*").alias("df"))
    return sums.agg(
        F.coalesce(F.max(F.when(F.col("word") == "", F.col("df"))), F.lit(0)).alias("n"),
        F.map_from_entries(F.collect_list(F.struct("word", "df"))).alias("df"),
    )


def model(found: DataFrame, group: dict[str, list[str]]) -> DataFrame:
    """One stored row for a group of templates, of stored frequencies: idf of the templates' words, `other` (idf of a word that no segment has), the weighted
    templates, and the least squared length that a segment's share of the vocabulary needs for MIN_COSINE."""
    spark = found.sparkSession
    n, df = found.select("n").scalar(), found.select("df").scalar()
    idf = F.log((1.0 + n) / (1.0 + F.coalesce(F.element_at(df, F.col("word")), F.lit(0)))) + 1.0
    counts = [
        F.struct(F.lit(k).alias("k"), F.lit(name).alias("name"), F.lit(word).alias("word"), F.lit(words.count(word)).alias("times"))
        for k, (name, words) in enumerate((name, _python_words(t)) for name, ts in group.items() for t in ts)
        for word in sorted(set(words))
    ]
    terms = spark.range(1).select(F.inline(F.array(*counts))).withColumn("idf", idf)
    weight = F.col("times") * F.col("idf")
    rows = terms.groupBy("k", "name").agg(
        F.map_from_entries(F.collect_list(F.struct("word", weight.alias("weight")))).alias("weights"),
        F.sqrt(F.sum(weight * weight)).alias("norm"),
    )
    listed = rows.agg(
        F.collect_list(F.struct("name", "weights", "norm")).alias("templates"),
        F.min("norm").alias("least"),
    )
    words = terms.groupBy("word").agg(F.max("idf").alias("idf"), F.max(weight).alias("most"))
    maps = words.agg(
        F.map_from_entries(F.collect_list(F.struct("word", "idf"))).alias("idf"),
        F.map_from_entries(F.collect_list(F.struct("word", F.col("most") * F.col("most")))).alias("most"),
    )
    return stored(
        spark.range(1).select(
            F.struct(
                maps.select("idf").scalar().alias("idf"),
                maps.select("most").scalar().alias("most"),
                listed.select("templates").scalar().alias("templates"),
                listed.select("least").scalar().alias("least"),
                (F.log(1.0 + n) + 1.0).alias("other"),
            ).alias("model")
        ),
        "templates",
    )


def _counts(words: Column) -> Column:
    """(word, times) of the different words, by sorting."""

    def runs(ordered: Column) -> Column:
        size = F.size(ordered)
        places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
        return let(
            starts,
            lambda first: F.transform(
                first,
                lambda start, k: F.struct(
                    F.get(ordered, start).alias("word"), (F.coalesce(F.get(first, k + 1), size) - start).alias("times")
                ),
            ),
        )

    return let(F.array_sort(words), runs)


def _best(words: Column, model_: Column, vocabulary: list[str]) -> Column:
    """(distance, name) of the template nearest to a segment; distance is minus the cosine.

    Only the few words that a template has are looked up and multiplied; all others have one weight.
    """
    spelled = _same(words)

    def squares(counts: Column) -> Column:
        return F.aggregate(counts, F.lit(0.0), lambda a, c: a + c["times"] * c["times"])

    def against(counts: Column) -> Column:
        known = let(
            _known(words, vocabulary), lambda some: F.filter(counts, lambda c: F.array_contains(some, c["word"]))
        )
        own = F.transform(
            known,
            lambda c: F.struct(c["word"].alias("word"), (c["times"] * F.element_at(model_["idf"], c["word"])).alias("weight")),
        )
        other = (squares(counts) - squares(known)) * model_["other"] * model_["other"]

        def nearest(mine: Column) -> Column:
            length = F.sqrt(other + F.aggregate(mine, F.lit(0.0), lambda a, x: a + x["weight"] * x["weight"]))

            def distance(template: Column, norm: Column) -> Column:
                dot = F.aggregate(
                    mine,
                    F.lit(0.0),
                    lambda a, x: a + x["weight"] * F.coalesce(F.element_at(template["weights"], x["word"]), F.lit(0.0)),
                )
                return -F.round(dot / (norm * template["norm"]), 9)

            return let(
                length,
                lambda norm: F.array_min(
                    F.transform(
                        model_["templates"],
                        lambda t: F.struct(distance(t, norm).alias("distance"), t["name"].alias("name")),
                    )
                ),
            )

        return let(own, nearest)

    return let(_counts(spelled), against)


def stated(files: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """file_id, path, and the licence and cosine of each file's best statement (null without one).

    A cosine can't exceed the share of the template's squared length that the common words make up; segments
    whose common words are too light for any template are not scored.
    """
    found = stored(frequencies(files), "frequencies")
    ready = files.select("file_id", "path", "text")
    for k, group in enumerate(GROUPS):
        ready = ready.withColumn(f"m{k}", model(found, group).select("model").scalar())

    def near(k: int) -> Column:
        own = F.col(f"m{k}")
        need = min_cosine * min_cosine * own["least"] * own["least"] * 0.999

        def light(words: Column) -> Column:
            known = _known(words, _vocabulary(GROUPS[k]))
            return F.aggregate(known, F.lit(0.0), lambda a, w: a + F.element_at(own["most"], w))

        return F.filter("words", lambda words: light(words) >= need)

    def scores(k: int) -> Column:
        return F.transform(f"near{k}", lambda words: _best(words, F.col(f"m{k}"), _vocabulary(GROUPS[k])))

    def without(name: str) -> Column:
        return F.filter("all", lambda b: b["name"] != name)

    text = F.coalesce(F.col("text"), F.lit(""))
    ready = ready.withColumn("words", F.transform(F.array_union(_segments(text), _joined(text)), _words))
    ready = ready.select("file_id", "path", "m0", "m1", *[near(k).alias(f"near{k}") for k in range(len(GROUPS))])
    bests = F.concat(*[scores(k) for k in range(len(GROUPS))])
    scored = ready.select("file_id", "path", F.filter(bests, lambda b: b["distance"] <= -min_cosine).alias("all"))
    names = F.transform("all", lambda b: b["name"])
    for holder, held in HOLDS:
        scored = scored.withColumn("all", F.when(F.array_contains(names, holder), without(held)).otherwise(F.col("all")))
    scored = scored.select("file_id", "path", F.array_min("all").alias("best"))
    return scored.select("file_id", "path", F.col("best.name").alias("license"), (-F.col("best.distance")).alias("cosine"))


def _directory(path: Column) -> Column:
    """The directory of a path; the empty string is the root."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, r"/[^/]*$", "")).otherwise(F.when(path.isNotNull(), ""))


def inherited(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """(dir, dir_license, from_dir) of the nearest directory, itself or above, that has a licence.

    `directories` holds `dir`; `licensed` holds one row (dir, license) per directory with a licence.
    """
    steps = F.split("dir", "/", -1)
    up = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))
    above = directories.select("dir", F.posexplode(F.array_distinct(F.concat(F.array(F.lit("")), up))).alias("depth", "above"))
    found = above.join(licensed.select(F.col("dir").alias("above"), "license"), "above")
    return (
        found.groupBy("dir")
        .agg(F.max(F.struct("depth", "license", "above")).alias("best"))
        .select("dir", F.col("best.license").alias("dir_license"), F.col("best.above").alias("from_dir"))
    )


def scan_licenses(files: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """file_id, path, license, cosine, origin ('file', 'directory' or null) and from_dir of every file.

    `files` holds file_id, path and text.
    """
    own = stored(stated(files, min_cosine).withColumn("dir", _directory(F.col("path"))), "stated")
    licensed = (
        own.filter(F.col("license").isNotNull() & F.col("path").rlike(LICENSE_FILE))
        .groupBy("dir")
        .agg(F.min(F.struct(-F.col("cosine"), F.col("license").alias("license")))["license"].alias("license"))
    )
    bare = own.filter(F.col("license").isNull() & F.col("dir").isNotNull()).select("dir").distinct()
    given = inherited(bare, licensed)
    joined = own.join(given, "dir", "left")
    return joined.select(
        "file_id",
        "path",
        F.coalesce("license", "dir_license").alias("license"),
        "cosine",
        F.when(F.col("license").isNotNull(), "file").when(F.col("dir_license").isNotNull(), "directory").alias("origin"),
        F.when(F.col("license").isNull(), F.col("from_dir")).alias("from_dir"),
    )

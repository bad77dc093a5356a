"""Licence scan with a trained paragraph classifier, in DataFrame operations only.

Units of text (sentences and windows of words, of lines and of blocks of lines) become sparse binary vectors of hashed
word 1-, 2- and 3-grams.  A multinomial logistic regression, fitted on notices made by rule from phrases and licence
names, names the family.  Its unknown class is fitted on notices of other licences, on ordinary sentences with the words
of licences and on paragraphs of the corpus, and calibrated: a family counts only above the probability that units
without resemblance to any template, and notices of further licences, do not reach.  A named family is then confirmed by
comparing the unit's word pairs with templates, licence names and canonical texts, which are not what was fitted.
"""

from __future__ import annotations

import re

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bounds of the fit: ordinary paragraphs taken from the corpus (those of least hash), and hashed features.
ORDINARY_ROWS = 1000
FEATURES = 1 << 14
#: The share of unlike units whose probability may exceed the threshold, and what is unlike: its highest similarity.
EXCESS, UNLIKE = 0.001, 0.34
#: The share of a name's, or of a text's, word pairs that a unit must hold; or of its own pairs that a text must hold.
OF_NAME, OF_TEXT, OF_UNIT = 0.75, 0.6, 0.6
#: A unit of fewer word pairs is too short to be known as a piece of a text.
LEAST_PAIRS = 5
#: Words of a window, and how far the next one begins.
WINDOW, STEP = 40, 20
#: A text is fitted in pieces of so many words.
PIECE_WORDS = 12
UNKNOWN = "unknown"

# The names of licence families, their identifiers, and the texts by which some are declared.
NAMES = {
    "Apache-2.0": ("Apache License", "Apache License 2.0", "Apache License Version 2.0", "Apache 2.0 license", "Apache-2.0", "Apache licensed"),
    "MIT": ("MIT License", "MIT licensed", "MIT licence", "MIT/X11 license", "MIT/X11", "The MIT License (MIT)"),
    "GPL": ("GNU General Public License", "GNU General Public License version 3", "GNU GPL", "GPLv3", "GPLv2", "GPL-3.0-or-later", "GPL-2.0-only", "GPL v3", "GPL license"),
    "LGPL": ("GNU Lesser General Public License", "GNU Library General Public License", "GNU LGPL", "LGPLv3", "LGPL-2.1-or-later", "LGPL v2.1", "LGPL license"),
    "BSD": ("BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "BSD-3-Clause", "BSD-2-Clause", "BSD-style license", "BSD licensed", "New BSD License"),
    "MPL-2.0": ("Mozilla Public License", "Mozilla Public License 2.0", "MPL 2.0", "MPL-2.0", "Mozilla Public License v. 2.0"),
    "CC-BY-NC": ("CC BY-NC", "CC BY-NC 4.0", "CC BY-NC-SA 4.0", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY": ("CC BY 4.0", "CC BY-SA 4.0", "CC-BY-4.0", "CC-BY-SA-4.0", "Creative Commons Attribution License", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution-ShareAlike License"),
    "CC0": ("CC0 1.0", "CC0 1.0 Universal", "CC0-1.0", "Creative Commons Zero", "Creative Commons CC0"),
    "ISC": ("ISC License", "ISC licensed", "ISC licence"),
    "Proprietary": ("All rights reserved",),
}
TEXTS = {
    "Apache-2.0": ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',),
    "MIT": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        'The software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.',
    ),
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ),
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        'This software is provided by the copyright holders and contributors "as is" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed.',
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",),
    "CC0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Proprietary": (
        "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher.",
        "This document is confidential and proprietary. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ),
}
#: What a name is declared with.
PHRASES = (
    "Licensed under the {}.",
    "Licensed under {}",
    "Released under the {}",
    "This project is licensed under the terms of the {}.",
    "This work is licensed under the {}.",
    "Code released under {}",
    "Distributed under the {}, see the LICENSE file.",
    "This code is {}.",
    "The source code is available under {}",
    "License: {}",
    "SPDX-License-Identifier: {}",
    "This file is part of a program under the {}; see there for details.",
)
#: Licences that are of no family above: the first ones are fitted as unknown, the others calibrate.
OTHER = (
    "Eclipse Public License 2.0", "EPL-2.0", "GNU Affero General Public License", "AGPLv3", "AGPL-3.0-only", "Common Development and Distribution License", "European Union Public Licence 1.2",
    "Artistic License 2.0", "Boost Software License 1.0", "zlib License", "Creative Commons Attribution-NoDerivatives 4.0", "CC BY-ND 4.0", "Microsoft Public License", "SIL Open Font License 1.1",
)
FURTHER = ("Academic Free License 3.0", "Python Software Foundation License", "PHP License 3.01", "Open Software License 3.0", "IBM Public License 1.0", "Unlicense", "PostgreSQL License", "Ruby license", "OpenSSL License", "Sleepycat License")
#: Ordinary sentences with the words of licences.
ORDINARY = (
    "You need a driving licence to rent a car.",
    "My driving license was released in May.",
    "The restaurant lost its license to serve alcohol.",
    "She was granted permission to leave the country, free of charge.",
    "The new version of the game was released in May.",
    "The general public was invited to the open day at the foundation.",
    "Copyright law was reformed in the nineteenth century.",
    "The software is easy to use and comes without warranty problems.",
    "The artist has a creative mind and common sense.",
    "The apache helicopter was released under the sea.",
    "He studied at MIT and worked for a public company under license.",
    "The licence fee is paid by every household with a television.",
    "Redistribution of land and use of water were debated.",
    "Permission to copy the keys was refused by the landlord.",
    "The table by the window was reserved, and all rights of way are closed.",
)
#: Words of notices.
WORDS = r"licen[cs]|copyright|spdx|rights\s+reserved|permission|redistribut|gpl|public\s+domain|creative\s+commons|\bcc[ -]?(by|0)|strictly\s+prohibited|waived|permitted\s+provided|hereby\s+granted|without\s+restriction|merchantability|without\s+warranty"


def _gate() -> str:
    """A pattern that every fitted notice matches: the words of notices, and the names that hold none of them."""
    apart = lambda name: r"[^\p{L}\p{N}]*".join(re.findall(r"[^\W\d_]+|\d+", name))
    bare = sorted({apart(n) for names in NAMES.values() for n in names if not re.search(WORDS, n, re.I)})
    return rf"(?i){WORDS}|(?<![\p{{L}}\p{{N}}])(?:{'|'.join(bare)})(?![\p{{L}}\p{{N}}])"


#: Units without any of these are like none that was fitted, and are not scored.
NOTICE = _gate()


def tokens(text: Column) -> Column:
    """Words in lower case; a version's number is a word of its own."""
    apart = F.regexp_replace(F.regexp_replace(F.lower(text), "licence", "license"), r"(?<=\p{L})(?=\d)|(?<=\d)(?=\p{L})", " ")
    return F.filter(F.split(apart, r"[^\p{L}\p{N}]+"), lambda t: t != "")


def grams(words: Column, n: int) -> Column:
    """The word n-grams, in order."""
    last = F.size(words) - (n - 1)
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def pairs(words: Column) -> Column:
    return F.when(F.size(words) >= 2, F.array_distinct(grams(words, 2))).otherwise(words)


def features(units: DataFrame) -> DataFrame:
    return units.withColumn("grams", F.array_distinct(F.flatten(F.array(*[grams(F.col("words"), n) for n in (1, 2, 3)]))))


def pieces(text: str) -> list[str]:
    """What a hard-wrapped line of a long notice may hold."""
    w = text.split()
    return [" ".join(w[i : i + PIECE_WORDS]) for i in range(0, max(1, len(w) - PIECE_WORDS // 2), PIECE_WORDS // 2)]


def units(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``at`` (the place of its block), ``line`` (null for units of a block of several lines) and ``words`` of every
    unit with the words of notices.  A block is a run of lines with a letter or digit."""
    noticed = df.where(F.col(text_col).rlike(NOTICE))
    blank = F.regexp_replace(F.col(text_col), r"(?dm)^[^\p{L}\p{N}\n]*$", "")
    blocks = noticed.select(F.col(id_col).alias("id"), F.posexplode(F.split(F.btrim(blank, F.lit("\n")), r"\n{2,}")).alias("at", "block")).where(F.col("block").rlike(NOTICE))
    lines = F.transform(F.split("block", "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("part")))
    whole = F.array(F.struct(F.lit(None).cast("int").alias("line"), F.col("block").alias("part")))
    rows = blocks.select("id", "at", F.explode(F.when(F.size(lines) > 1, F.concat(lines, whole)).otherwise(lines)).alias("x")).select("id", "at", "x.line", "x.part")
    sentences = F.when(F.col("line").isNotNull(), F.transform(F.filter(F.split("part", r"(?<=[.!?;])\s+"), lambda x: x.rlike(NOTICE)), tokens)).otherwise(F.array().cast("array<array<string>>"))
    words = tokens(F.col("part"))
    windows = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (WINDOW - STEP)), F.lit(STEP)), lambda i: F.slice("words", i, WINDOW))
    noticed = lambda w: (F.size(w) >= 2) & F.array_join(w, " ").rlike(NOTICE)
    parts = rows.where(F.col("part").rlike(NOTICE)).withColumn("words", words)
    return parts.select("id", "at", "line", F.explode(F.array_distinct(F.filter(F.concat(windows, sentences), noticed))).alias("words"))


class LicenseModel:
    """The fitted stages, the family names by label, the threshold and the template table."""

    def __init__(self, stages, names: list[str], threshold: float, templates: DataFrame):
        self.stages, self.names, self.threshold, self.templates = stages, names, threshold, templates

    def compared(self, rows: DataFrame) -> DataFrame:
        """The rows with their most probable ``family``, its ``probability``, and how like its templates they are:
        ``name`` and ``text`` (the most of a name's or text's pairs in the unit), ``part`` (the most of the unit's pairs in
        a text) and ``alike`` (the highest of these for any family)."""
        scored = self.stages.transform(features(rows))
        scored = scored.withColumn("p", F.slice(vector_to_array("probability"), 2, len(self.names) - 1)).withColumn("probability", F.array_max("p"))
        names = F.array(*[F.lit(x) for x in self.names[1:]])
        named = scored.withColumn("family", F.element_at(names, F.array_position("p", F.col("probability")).cast("int"))).select(*rows.columns, "family", "probability", pairs(F.col("words")).alias("own"))
        table = self.templates.agg(F.collect_list(F.struct("template_family", "kind", "template_pairs")).alias("templates"))  # as long as the constants above
        shared = lambda t: F.size(F.array_intersect(t["template_pairs"], F.col("own")))
        each = F.transform("templates", lambda t: F.struct(
            (t["template_family"] == F.col("family")).alias("same"), t["kind"].alias("kind"), (shared(t) / F.size(t["template_pairs"])).alias("whole"),
            F.when((t["kind"] == "text") & (F.size("own") >= LEAST_PAIRS), shared(t) / F.size("own")).otherwise(0.0).alias("part"),
        ))
        best = lambda keep, get: F.coalesce(F.array_max(F.transform(F.filter("each", keep), get)), F.lit(0.0))
        return named.crossJoin(F.broadcast(table)).withColumn("each", each).select(
            *rows.columns, "family", "probability",
            best(lambda t: t["same"] & (t["kind"] == "name"), lambda t: t["whole"]).alias("name"),
            best(lambda t: t["same"] & (t["kind"] == "text"), lambda t: t["whole"]).alias("text"),
            best(lambda t: t["same"], lambda t: t["part"]).alias("part"),
            best(lambda t: F.lit(True), lambda t: F.greatest(t["whole"], t["part"])).alias("alike"),
        )

    def classify(self, rows: DataFrame) -> DataFrame:
        """The licence units of ``rows``, with ``family``, ``probability`` and ``similarity``; ``piece``: only as a part of a text."""
        good = self.compared(rows).where(F.col("probability") >= self.threshold)
        whole = (F.col("name") >= OF_NAME) | (F.col("text") >= OF_TEXT)
        good = good.where(whole | (F.col("part") >= OF_UNIT))
        return good.select(*[c for c in rows.columns if c != "words"], "family", "probability", F.greatest("name", "text", "part").alias("similarity"), (~whole).alias("piece"))


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = ORDINARY_ROWS) -> LicenseModel:
    """Fit on notices made by rule, on pieces of the texts, and on at most ``rows`` ordinary paragraphs of the corpus.

    The ordinary paragraphs are lines of documents of low hash in which no word of notices stands.  The threshold is
    calibrated on all units of the corpus that resemble no template, of which at most ``EXCESS`` may exceed it, and on
    notices of licences that the fit did not see.
    """
    spark = df.sparkSession
    names = [UNKNOWN, *NAMES]
    made = [(p.format(x), float(k)) for k, f in enumerate(names) for x in NAMES.get(f, ()) for p in (*PHRASES, "{}", "Copyright (c) 2020 The Authors. {}.")]
    made += [(x, float(k)) for k, f in enumerate(names) for t in TEXTS.get(f, ()) for x in (t, *pieces(t))]
    made += [(p.format(x), 0.0) for x in OTHER for p in (*PHRASES, "{}")] + [(t, 0.0) for t in ORDINARY]
    known = spark.createDataFrame(made, "part string, label double")
    line = F.explode(F.split(text_col, "\n")).alias("part")
    place, n = F.pmod(F.xxhash64(id_col), 1 << 30), df.count()
    some = df.where(place < (4 * rows << 30) // n) if n > 4 * rows else df  # so that few texts meet for the last choice
    quiet = some.where(~F.col(text_col).rlike(NOTICE)).select(id_col, text_col).orderBy(place, id_col).limit(rows).select(line).where(F.col("part").rlike(r"\p{L}")).limit(rows)
    data = known.unionByName(quiet.select("part", F.lit(0.0).alias("label"))).withColumn("words", F.slice(tokens(F.col("part")), 1, WINDOW)).coalesce(1)
    ready = features(data).select("label", "grams").cache()
    weight = ready.groupBy("label").agg((1 / F.sqrt(F.count("*"))).alias("weight"))
    stages = Pipeline(
        stages=[
            HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True),
            LogisticRegression(family="multinomial", regParam=0.0005, maxIter=30, weightCol="weight", standardization=False),
        ]
    ).fit(ready.join(F.broadcast(weight), "label"))
    ready.unpersist()
    templates = [(f, kind, t) for kind, table in (("name", NAMES), ("text", TEXTS)) for f, some in table.items() for t in some]
    whole = spark.createDataFrame(templates, "template_family string, kind string, part string").select("template_family", "kind", pairs(tokens(F.col("part"))).alias("template_pairs"))
    model = LicenseModel(stages, names, 0.0, whole)
    unlike = model.compared(units(df.where(F.col(id_col).isNotNull()), id_col, text_col)).where(F.col("alike") < UNLIKE)
    further = spark.createDataFrame([(p.format(x),) for x in FURTHER for p in PHRASES], "part string").select(tokens(F.col("part")).alias("words"))
    highest = unlike.agg(F.percentile_approx("probability", 1 - EXCESS, 100_000)).first()[0] or 0.0
    strange = model.compared(further).where(F.greatest("name", "text", "part") >= OF_NAME).agg(F.max("probability")).first()[0] or 0.0
    model.threshold = max(highest, strange) + 1e-6
    return model


def scan(df: DataFrame, model: LicenseModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_paragraphs`` (lines with a letter or digit), ``n_licensed``, ``licences`` (families in order),
    ``probability`` and ``similarity`` (the highest of its licence units, null without one).

    ``n_licensed`` counts the lines that declare a licence, and one for a family that only a whole block shows.  A piece
    of a text does not count in a block that declares a licence as a whole.

    Every text is searched whole for the words of notices in the map stage, whatever its length; the blocks that hold
    some are scored there, and only licence units are shuffled, by document.  Of equally probable families the first in
    the table counts.  Null and empty texts have no paragraphs; rows repeated with one id, also of different texts, share
    the paragraphs of all of them; rows with a null id have no licences; an empty table gives an empty result; other
    columns are not read.
    """
    found = model.classify(units(df.where(F.col(id_col).isNotNull()), id_col, text_col))
    by_line = found.groupBy("id", "at", "line", "family").agg(F.max("probability").alias("probability"), F.max("similarity").alias("similarity"), F.min("piece").alias("piece"))
    by_block = by_line.groupBy("id", "at").agg(F.collect_list(F.struct("line", "family", "probability", "similarity", "piece")).alias("all"))
    declared = F.exists("all", lambda x: ~x["piece"])
    kept = by_block.select("id", "at", F.explode(F.filter("all", lambda x: ~x["piece"] | ~declared)).alias("x")).select("id", "at", "x.*")
    own = kept.groupBy("id", "at", "family").agg(F.count("line").alias("n"), F.max("probability").alias("probability"), F.max("similarity").alias("similarity"))
    by = own.groupBy(F.col("id").alias("__id")).agg(
        F.sum(F.greatest("n", F.lit(1))).alias("n_licensed"), F.array_sort(F.collect_set("family")).alias("licences"), F.max("probability").alias("probability"), F.max("similarity").alias("similarity")
    )
    n = F.size(F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda x: x.rlike(r"[\p{L}\p{N}]"))).cast("long")
    rows = df.select(F.col(id_col), n.alias("n_paragraphs"))
    out = rows.join(by, rows[id_col] == by["__id"], "left")
    return out.select(id_col, "n_paragraphs", F.coalesce("n_licensed", F.lit(0)).cast("long").alias("n_licensed"), F.coalesce("licences", F.array().cast("array<string>")).alias("licences"), "probability", "similarity")

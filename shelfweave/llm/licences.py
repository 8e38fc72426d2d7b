"""Licence scan: a paragraph classifier over sparse word n-grams, calibrated, its finds confirmed by comparison with templates.

Everything runs as DataFrame operations and the DataFrame-based machine-learning API inside the JVM.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .scratch import Scratch

OVERLAP = 0.6
WORD = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
TEMPERATURES = (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)


class Family(NamedTuple):
    names: tuple[str, ...]  # what the licence is called, without its version
    version: str = ""
    codes: tuple[str, ...] = ()  # short identifiers
    notices: tuple[str, ...] = ()  # wordings that need no name


# Names, versions, short identifiers and usual notices of licences.
_GPL_NOTICE = ("This program is free software: you can redistribute it and/or modify it under the terms of the {} as published by the Free Software Foundation, "
               "either version {} of the License, or any later version.")
FAMILIES = {
    "agpl-3.0": Family(("GNU Affero General Public License", "GNU AGPL"), "3", ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "AGPLv3")),
    "apache-1.1": Family(("Apache License", "Apache Software License"), "1.1", ("Apache-1.1",)),
    "apache-2.0": Family(("Apache License", "Apache Software License"), "2.0", ("Apache-2.0",),
                         ("Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",)),
    "boost-1.0": Family(("Boost Software License",), "1.0", ("BSL-1.0",)),
    "bsd": Family(("BSD License", "BSD-style license", "2-Clause BSD License", "3-Clause BSD License"), "", ("BSD-2-Clause", "BSD-3-Clause"),
                  ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
                   "Use of this source code is governed by a BSD-style license.")),
    "cc-by-4.0": Family(("CC BY", "Creative Commons Attribution"), "4.0", ("CC-BY-4.0",), ("Licensed under a Creative Commons Attribution 4.0 International License.",)),
    "cc-by-nc-4.0": Family(("CC BY-NC", "Creative Commons Attribution-NonCommercial"), "4.0", ("CC-BY-NC-4.0",), ("Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",)),
    "cc-by-nc-nd-4.0": Family(("CC BY-NC-ND", "Creative Commons Attribution-NonCommercial-NoDerivatives"), "4.0", ("CC-BY-NC-ND-4.0",)),
    "cc-by-nc-sa-4.0": Family(("CC BY-NC-SA", "Creative Commons Attribution-NonCommercial-ShareAlike"), "4.0", ("CC-BY-NC-SA-4.0",)),
    "cc-by-nd-4.0": Family(("CC BY-ND", "Creative Commons Attribution-NoDerivatives"), "4.0", ("CC-BY-ND-4.0",)),
    "cc-by-sa-4.0": Family(("CC BY-SA", "Creative Commons Attribution-ShareAlike"), "4.0", ("CC-BY-SA-4.0",), ("Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",)),
    "cc0-1.0": Family(("CC0", "Creative Commons Zero"), "1.0", ("CC0-1.0",)),
    "epl-1.0": Family(("Eclipse Public License",), "1.0", ("EPL-1.0",)),
    "epl-2.0": Family(("Eclipse Public License",), "2.0", ("EPL-2.0",)),
    "gpl-2.0": Family(("GNU General Public License", "GNU GPL"), "2", ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPLv2"), (_GPL_NOTICE.format("GNU General Public License", 2),)),
    "gpl-3.0": Family(("GNU General Public License", "GNU GPL"), "3", ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "GPLv3"), (_GPL_NOTICE.format("GNU General Public License", 3),)),
    "isc": Family(("ISC License",), "", ("ISC",), ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",)),
    "lgpl-2.1": Family(("GNU Lesser General Public License", "GNU LGPL"), "2.1", ("LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPLv2.1")),
    "lgpl-3.0": Family(("GNU Lesser General Public License", "GNU LGPL"), "3", ("LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "LGPLv3")),
    "mit": Family(("MIT License", "Expat License"), "", ("MIT",),
                  ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction.",)),
    "mpl-1.1": Family(("Mozilla Public License",), "1.1", ("MPL-1.1",)),
    "mpl-2.0": Family(("Mozilla Public License",), "2.0", ("MPL-2.0",), ("This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",)),
    "proprietary": Family((), "", (), ("All rights reserved.", "Copyright. All rights reserved.", "All rights reserved. No part of this publication may be reproduced without prior written permission of the publisher.")),
    "unlicense": Family(("Unlicense",), "", ("Unlicense",), ("This is free and unencumbered software released into the public domain.",)),
}
# Licences outside the list: near misses that are unknown, whatever is said of them.
UNLISTED = ("European Union Public License, version 1.2", "Artistic License 2.0", "Common Development and Distribution License 1.0", "SIL Open Font License 1.1", "Microsoft Public License",
            "Affero General Public License, version 1", "Open Software License 3.0", "Creative Commons Attribution 2.0", "Creative Commons Attribution-ShareAlike 3.0", "Mozilla Public License, version 1.0",
            "GNU General Public License, version 1", "GNU Free Documentation License, version 1.3", "Apache License, Version 1.0", "Academic Free License 3.0", "zlib License", "Python Software Foundation License 2")
# What grants a licence named {}, and what only speaks of it.
GRANTS = ("Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "This work is licensed under the {}.", "This library is licensed under the {} or later.", "Distributed under the {}, see the file.",
          "This project is licensed under the terms of the {}.", "The source code is available under the {}.", "This software may be used and copied under the terms of the {}.", "License: {}.",
          "See the {} for the terms.", "You can share all files under the {}.")
DENIALS = ("We never released this under the {}.", "This work is not licensed under the {}.", "The text of the {} was discussed at the meeting.", "They compared the {} with other licenses.",
           "Nobody here has read the {}.", "Unlike others this code is not distributed under the terms of the {}.", "He wrote an essay on the {}.",
           "A book on the {} appeared in May.", "The author explains the {} to students.", "A talk about the {} was given.", "Is the {} compatible with ours?", "The {} was written years ago.", "Lawyers prefer the {}.",
           "Questions on the {} were answered in the evening.", "We did not want the {}.")
# Wordings kept out of the training as a whole: the temperature is fitted on them.
HELD_GRANTS = ("You may use this package under the {}.", "Made available under the terms of the {}.", "Published under the {}.")
HELD_DENIALS = ("It was not published under the {}.", "An article about the history of the {}.", "This has never been available under the terms of the {}.")
# Sentences with words of the notices that state no licence.
OTHERS = [
    "The general read the first version of the work in public.", "Any person may use the library without restriction on Sundays.", "He was released under conditions that were never published.",
    "The software project was late and the source of the trouble was a binary file.", "She holds a driving license and a fishing license.", "The foundation gave permission to copy the creative work of the school.",
    "The committee met in compliance with the law.", "You can modify the form at any later time.", "The international airport reserved all rights to the common ground.", "Version 2.0 of the program was published in May.",
    "The license of the restaurant was renewed.", "Public use of the file is permitted in part.", "A boost of the software budget was granted.", "The eclipse was seen by the public.",
]
# A paragraph without any of these, in lower case, has no features: every grant and notice has one of them.
TELLING = ("licens", "licenc", "reserved", "hereby", "creative", "cc by", "cc-by", "cc0", "gnu ", "gpl", "unencumbered", "redistribution")
# What may stand between a name and its version, and what before a name denies the grant.
_BETWEEN = r"(?: agpl| lgpl| gpl| mpl| epl)?(?: as published by the free software foundation)?(?: either)?(?: version| ver)? v?"
_DENIED = r"(?<!\b(?:not|never|nor|nobody|unlike)" + r"(?: \S{1,20})?" * 6 + ")"  # words are bounded, as a pattern that looks behind must be


def _plain_words(text: str) -> list[str]:
    return re.findall(WORD, text.lower().replace("licenc", "licens"))


def _named(family: Family) -> list[str]:
    """The names with their version in the usual spellings."""
    if not family.version:
        return list(family.names)
    return [f"{n}{v}" for n in family.names for v in (f", version {family.version}", f" {family.version}", f" v{family.version}")]


def wordings(family: Family) -> list[str]:
    """Every learned wording of a grant."""
    return [g.format(n) for g in GRANTS for n in _named(family)] + [f"SPDX-License-Identifier: {c}" for c in family.codes] + [f"License: {c}" for c in family.codes] + list(family.notices)


def mark(family: Family) -> str:
    """Pattern of what a paragraph's words must hold for the family: its name with its very version, an identifier, or the start of a notice."""
    whole = family.version.removesuffix(".0")
    version = _BETWEEN + re.escape(whole) + ("" if "." in whole else r"(?:\.0)?") if whole else ""
    # The words are looked at before what stands before them, which is the dearer test.
    undenied = lambda words, rest="": f"(?= (?:{words}) ){_DENIED} (?:{words}){rest} "
    names = [" ".join(_plain_words(n)) for n in family.names]
    numbered = [c.lower() for c in family.codes if re.search("[0-9]", c)]
    found = [undenied("|".join(map(re.escape, part)), rest) for part, rest in ((names, version), (numbered, "")) if part]
    found += [f" (?:spdx-license-identifier|license) {re.escape(c.lower())} " for c in family.codes]
    starts = [_plain_words(n) for n in family.notices]
    found += [f" {re.escape(' '.join(w[:4]))} " for w in starts if not any(n in " ".join(w) for n in names)]
    return "|".join(found)


TEMPLATES = {family: wordings(of) for family, of in sorted(FAMILIES.items())}


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.replace(F.lower(text), F.lit("licenc"), F.lit("licens")), F.lit(WORD), F.lit(0))


def _examples() -> list[tuple[float, str, bool]]:
    """(class, paragraph, held out): grants and notices of each family; denials, unlisted licences, single words and other sentences are unknown."""
    unknown, rows = float(len(TEMPLATES)), []
    for k, (family, texts) in enumerate(TEMPLATES.items()):
        names = _named(FAMILIES[family])
        rows += [(float(k), t, False) for t in texts] + [(float(k), g.format(n), True) for g in HELD_GRANTS for n in names]
        rows += [(unknown, d.format(n), False) for d in DENIALS for n in names] + [(unknown, d.format(n), True) for d in HELD_DENIALS for n in names]
        for notice in FAMILIES[family].notices:
            words = notice.split()
            rows += [(float(k), " ".join(words[:i] + words[i + 1 :]), False) for i in range(len(words)) if len(words) > 3]
    rows += [(unknown, g.format(n), False) for g in GRANTS for n in UNLISTED] + [(unknown, g.format(n), True) for g in HELD_GRANTS for n in UNLISTED]
    rows += [(unknown, w, False) for w in sorted({w for _, t, held in rows if not held for w in _plain_words(t)})] + [(unknown, "", False)] * 20
    for text in OTHERS:
        words = text.split()
        rows += [(unknown, text, False)] * 4 + [(unknown, " ".join(words[:i] + words[i + 1 :]), False) for i in range(len(words))]
    return rows


def vocabulary() -> list[str]:
    """The features: runs of one to three words of the learned wordings."""
    found = set()
    for text in {t for _, t, held in _examples() if not held}:
        words = _plain_words(text)
        runs = (words[i : i + n] for n in (1, 2, 3) for i in range(len(words) - n + 1))
        found |= {" ".join(r) for r in runs}
    return sorted(found)


def _grams(words: Column) -> Column:
    """One, two and three words in a row."""
    runs = lambda w: F.flatten(F.transform(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.transform(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda n: F.array_join(F.slice(w, i + 1, n), " "))))
    # Bound as a variable, the words are worked out once and not for every place.
    return F.when(F.size(words) > 0, F.element_at(F.transform(F.array(words), runs), 1)).otherwise(F.array().cast("array<string>"))


def telling(text: Column) -> Column:
    lower = F.lower(text)
    return reduce(or_, (F.contains(lower, F.lit(t)) for t in TELLING))


def _features(rows: DataFrame, grams: list[str]) -> DataFrame:
    """Which of the n-grams ``grams`` a paragraph has, as a sparse vector; none where it has no telling part."""
    words = F.when(telling(F.col("paragraph")), _words(F.col("paragraph"))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("grams", _grams(words))
    return CountVectorizerModel.from_vocabulary(grams, "grams", "features", binary=True).transform(rows)


def _loss(t: float) -> Column:
    """Mean negative log-probability of the labels at temperature ``t``."""
    top = F.array_max("raw")
    total = F.aggregate("raw", F.lit(0.0), lambda s, x: s + F.exp((x - top) / t))
    return F.avg(F.log(total) - (F.element_at("raw", (F.col("label") + 1).cast("int")) - top) / t)


def train(spark: SparkSession) -> tuple[LogisticRegressionModel, float]:
    """The sparse multinomial model, and the temperature that makes the labels of wordings held out as a whole most likely."""
    examples = spark.createDataFrame(_examples(), "label double, paragraph string, held boolean").coalesce(1)
    rows = _features(examples, vocabulary())
    model = LogisticRegression(family="multinomial", regParam=2e-4, elasticNetParam=0.5, maxIter=80).fit(rows.filter("not held"))
    raw = model.transform(rows.filter("held")).select("label", vector_to_array("rawPrediction").alias("raw"))
    loss = [_loss(t).alias(str(k)) for k, t in enumerate(TEMPERATURES)]
    got = raw.agg(*loss).first()
    return model, TEMPERATURES[min(range(len(TEMPERATURES)), key=lambda k: got[k])]


def _pairs(words: Column) -> Column:
    """Two words in a row, by which templates are compared."""
    places = lambda w: F.sequence(F.lit(1), F.greatest(F.size(w) - 1, F.lit(1)))
    return F.element_at(F.transform(F.array(words), lambda w: F.transform(places(w), lambda i: F.array_join(F.slice(w, i, 2), " "))), 1)


def _comparison(spark: SparkSession) -> DataFrame:
    """One row per family: its number, the word pairs of its templates, all of them together, its mark. As large as ``FAMILIES`` and no larger."""
    rows = []
    for k, (family, texts) in enumerate(TEMPLATES.items()):
        pairs = [sorted({" ".join(w[i : i + 2]) for i in range(max(1, len(w) - 1))}) for w in map(_plain_words, texts)]
        rows.append((k + 1, family, pairs, sorted({p for own in pairs for p in own}), mark(FAMILIES[family])))
    return spark.createDataFrame(rows, "best int, family string, templates array<array<string>>, known array<string>, mark string").coalesce(1)


def _blocks(texts: DataFrame) -> DataFrame:
    """Runs of several lines between blank lines: doc_id, row, number of the first line, n_lines, paragraph."""
    # Cut at the line break before a blank line: no other break goes, so lines can be counted.
    cut = texts.select("doc_id", "row", F.split("text", r"\n(?=[ \t\r\f]*(?:\n|$))").alias("blocks"))
    sizes = F.transform("blocks", lambda b: F.length(b) - F.length(F.replace(b, F.lit("\n"), F.lit(""))) + 1)
    kept = F.filter(F.transform("blocks", lambda b, i: F.struct(i.alias("i"), b.alias("paragraph"))), lambda x: telling(x["paragraph"]))
    rows = cut.select("doc_id", "row", sizes.alias("sizes"), F.explode(kept).alias("b")).select("doc_id", "row", "sizes", "b.*")
    # All blocks but the first begin with the blank line.
    skip = F.when(F.col("i") > 0, 1).otherwise(0)
    first = F.aggregate(F.slice("sizes", F.lit(1), F.col("i")), F.lit(0), lambda s, n: s + n) + skip
    rows = rows.select("doc_id", "row", first.alias("number"), (F.get("sizes", F.col("i")) - skip).alias("n_lines"), "paragraph")
    return rows.filter("n_lines > 1")


def licences(docs: DataFrame, scratch: Scratch, overlap: float = OVERLAP) -> DataFrame:
    """One row for each licence that a paragraph states: doc_id, paragraph (number of its first line, from 0), n_lines, family, probability, template_overlap, confirmed.

    Paragraphs are the single lines of a text and the runs of several lines between blank lines, over which notices are wrapped. Each gets the
    probability of every family and of ``unknown`` at the calibrated temperature. Of a line the likeliest class is returned if it is a family,
    and any other family that is likelier than ``unknown`` and confirmed; a run of lines gives the confirmed ones that no
    single line of it states, in place of its unconfirmed lines. Paragraphs without a telling part have no features, so they are unknown and passed over first.
    ``template_overlap`` is the largest share of a family template's pairs of adjacent words that the paragraph has. A find is confirmed
    from ``overlap`` on, if the paragraph also has the family's mark: the name with its very version, not denied, an identifier, or the start of a notice.

    Null and empty texts have no paragraphs; null ids and repeated rows are scanned like others. Other columns are ignored.
    """
    spark, grams, n = docs.sparkSession, vocabulary(), len(TEMPLATES)
    model, temperature = train(spark)
    texts = docs.filter(telling(F.col("text"))).select("doc_id", "text", F.sha2(F.concat_ws(":", F.col("doc_id").cast("string"), "text"), 256).alias("row"))
    lines = texts.select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("number", "paragraph")).filter(telling(F.col("paragraph")))
    candidates = lines.select("doc_id", "row", "number", F.lit(1).alias("n_lines"), "paragraph").union(_blocks(texts))
    # Written, so that no later expression works the features out again.
    raw = model.transform(_features(candidates, grams)).select("doc_id", "row", "number", "n_lines", F.array_join(_words(F.col("paragraph")), " ").alias("words"), vector_to_array("rawPrediction").alias("raw"))
    scored = scratch.table(raw.filter(F.array_position("raw", F.array_max("raw")) <= n), "scored")
    odds = F.transform("raw", lambda x: F.exp((x - F.array_max("raw")) / temperature))
    leading = F.filter(F.transform(odds, lambda x, i: F.struct((i + 1).alias("best"), x.alias("odds"))), lambda x: (x["best"] <= n) & (x["odds"] >= F.get(odds, F.lit(n))))
    total = F.aggregate(odds, F.lit(0.0), lambda s, x: s + x)
    each = scored.select("doc_id", "row", "number", "n_lines", "words", F.array_position("raw", F.array_max("raw")).alias("top"),
                         total.alias("total"), F.explode(leading).alias("f")).select("*", "f.best", "f.odds")
    each = each.join(F.broadcast(_comparison(spark)), "best")
    own = F.array_intersect(_pairs(F.split("words", " ")), F.col("known"))
    # Bound as a variable, the pairs are worked out once and not for every template.
    alike = lambda o: F.array_max(F.transform("templates", lambda t: F.size(F.array_intersect(t, o)) / F.size(t)))
    marked = F.regexp_like(F.concat(F.lit(" "), "words", F.lit(" ")), F.col("mark"))
    judged = F.element_at(F.transform(F.array(own), lambda o: F.transform(F.array(alike(o)), lambda x: F.struct(x.alias("overlap"), ((x >= overlap) & marked).alias("confirmed")))[0]), 1)
    each = each.withColumn("judged", judged)
    finds = each.select("doc_id", "row", "number", "n_lines", "family", (F.col("odds") / F.col("total")).alias("probability"), F.col("judged.overlap").alias("template_overlap"),
                        F.col("judged.confirmed").alias("confirmed"), (F.col("best") == F.col("top")).alias("likeliest"))
    # Filtered after writing: a filter before it would judge every row twice.
    finds = scratch.table(finds, "finds").filter("confirmed or (likeliest and n_lines = 1)")
    single, runs = finds.filter("n_lines = 1").alias("s"), finds.filter("n_lines > 1").alias("r")
    inside = F.expr("r.row = s.row and r.family = s.family and s.number >= r.number and s.number < r.number + r.n_lines")
    # A run goes where a line of it states the same; unconfirmed lines go where they are part of a notice that a run states.
    runs = runs.join(single.filter("confirmed"), inside, "left_anti").alias("r")
    single = single.filter("confirmed").union(single.filter("not confirmed").join(runs, inside, "left_anti"))
    return single.union(runs).select("doc_id", F.col("number").alias("paragraph"), "n_lines", "family", "probability", "template_overlap", "confirmed")

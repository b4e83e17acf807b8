"""Licence scans: a trained paragraph classifier (DataFrame functions only).

A paragraph is a line. Its features are its word 1- to 3-grams (present or not).
A multinomial logistic regression with an L1 penalty, fitted here by Spark ML on
the notices below and a bounded sample of the corpus' own lines, gives each
paragraph a probability for every licence family, for ``unknown`` (licence talk
of no family listed) and for ``none``. Its temperature is set on held-out
examples; a family below ``threshold`` becomes ``unknown``. A family is only
reported if the paragraph also matches one of its notices or titles by shared
word pairs and names the family exactly: version and parts (NC, SA, ND) must be
its own. Text that several licences share, or a name without the version that
tells them apart, is ``unknown``.

Scoring is one map-only pass: documents without any anchor word (the rarest word
of a feature) cannot hold a feature and are skipped; the others' lines are scored
inside the row from a literal table of the few hundred non-zero weights. Nothing
is shuffled or broadcast that grows with the corpus.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import Input, bounded_sample, documents

NONE, UNKNOWN = "none", "unknown"

# Short notices in common use, by SPDX identifier.
NOTICES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions"
        " of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "Released under the Apache 2.0 license.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
        "Released under the GPL version 3 license (GPLv3).",
    ],
    "GPL-2.0": [
        "This program is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation; either"
        " version 2 of the License, or (at your option) any later version.",
        "Released under the GPL version 2 license (GPLv2).",
    ],
    "LGPL-3.0": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "AGPL-3.0": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Released under the new BSD license.",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC0-1.0": [
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
        "Released under the CC0 public domain dedication.",
    ],
    "ISC": [
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
}
OTHER_NOTICES = [
    "All rights reserved.",
    "Copyright the authors, all rights reserved.",
    "This software is licensed under a proprietary license.",
    "Licensed under the terms of a commercial agreement.",
    "See the license file for licensing terms.",
    "Licensed under the Example Public License, version 1.",
    "This work is released under a custom license.",
    "Redistribution is not permitted without written permission of the copyright holder.",
    "Use of this content is subject to the license agreement.",
    "Released under a license of its own.",
    "Distributed under the Example Public Licence.",
    "Copying is subject to the licence of the authors.",
    "Distributed under the license of the publisher.",
    "Released under the LGPL license.",
    "Released under the Apache License.",
    "Licensed under CC BY 3.0.",
    "Licensed under CC BY-NC-ND 4.0.",
    "Licensed under the Mozilla Public License, version 1.1.",
    "SPDX-License-Identifier: LGPL-2.1-only",
    "SPDX-License-Identifier: BSD-2-Clause",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
    " the following conditions are met",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
    " granted.",
]
# Ordinary lines with words of licence talk; such lines of the corpus are not learned as ``none``.
ORDINARY = [
    "The driver showed her license to the officer.",
    "The car had no license plate.",
    "A licensed doctor saw the patient in the morning.",
]
# Titles and identifiers that stand alone or after a cue.
TITLES = {
    "MIT": ["MIT License", "The MIT License (MIT)", "License: MIT", "under MIT"],
    "Apache-2.0": ["Apache License 2.0", "Apache License, Version 2.0, January 2004", "Apache-2.0", "Apache License v2"],
    "GPL-3.0": ["GPLv3", "License: GPLv3", "under GPLv3", "GPL-3.0", "GNU GPL v3", "GNU General Public License v3.0", "GPL version 3"],
    "GPL-2.0": ["GPLv2", "License: GPLv2", "under GPLv2", "GPL-2.0", "GNU GPL v2", "GNU General Public License v2.0", "GPL version 2"],
    "LGPL-3.0": ["LGPLv3", "License: LGPLv3", "under LGPLv3", "LGPL-3.0", "GNU LGPL v3", "GNU Lesser General Public License v3.0",
                 "LGPL version 3"],
    "AGPL-3.0": ["AGPLv3", "License: AGPLv3", "under AGPLv3", "AGPL-3.0", "GNU AGPL v3", "GNU Affero General Public License v3.0",
                 "AGPL version 3"],
    "BSD-3-Clause": ["BSD 3-Clause License", "BSD-3-Clause", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License Version 2.0", "MPL-2.0", "MPL version 2.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International", "creativecommons.org/licenses/by/4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International",
                     "creativecommons.org/licenses/by-sa/4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International",
                     "creativecommons.org/licenses/by-nc/4.0"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "License: CC0", "under CC0", "creativecommons.org/publicdomain/zero/1.0"],
    "ISC": ["ISC License", "License: ISC", "under ISC"],
}


def _gnu(long: str, short: str, number: int) -> str:
    v = rf"(?:{number}|{number}\.0|v{number}|v{number}\.0)"
    name = rf"(?:gnu {long} public licen[sc]e(?: {short})?|{short})"
    cc = r"(?: as published by the free software foundation)?(?: either)?"
    return rf" {name}(?: licen[sc]e)?{cc}(?: version| v| ver)? {v} | {short}v?{number}(?:\.0)? | version {v} of the (?:gnu )?{name} "


def _cc(short: str, long: str) -> str:
    name = rf"(?:(?:cc|creative commons|creativecommons\.org licen[sc]es) {short}|(?:cc|creative commons) {long})"
    return rf" {name}(?: licen[sc]e)?(?: international)?(?: version| v)? v?4(?:\.0)? "


# What names a family exactly (version and parts included) in words() joined by blanks. A line that holds
# none of it names a neighbour, or is text that several licences share.
MARKS = {
    "MIT": r" (?<!modified )mit(?! (?:licen[sc]e )?(?:mit )?(?:0|no attribution|cmu|advertising|feh|wu|style|like|modern|open|festival) ) "
    "| to deal in the software without restriction "
    "| this permission notice shall be included in all copies or substantial portions of the software ",
    "Apache-2.0": r" apache (?:software )?(?:licen[sc]e )?(?:version |v |ver )?v?2(?:\.0)? | apachev?2(?:\.0)? "
    r"|apache\.org licenses license 2\.0(?:\.txt|\.html)? ",
    "GPL-3.0": _gnu("general", "gpl", 3),
    "GPL-2.0": _gnu("general", "gpl", 2),
    "LGPL-3.0": _gnu("lesser general", "lgpl", 3),
    "AGPL-3.0": _gnu("affero general", "agpl", 3),
    "BSD-3-Clause": r" bsd (?:licen[sc]e )?(?:3|three) clause(?! (?:licen[sc]e )?(?:clear|lbnl|attribution|no|open|modification) ) "
    r"| (?:3|three) clause (?:new |modified |revised )?bsd(?! clear ) | (?:new|modified|revised) bsd ",
    "MPL-2.0": r" (?:mozilla public licen[sc]e|mpl)(?: mpl)?(?: version| v| ver)? v?2(?:\.0)?(?! no copyleft) | mplv?2(?:\.0)? ",
    "CC-BY-4.0": _cc("by", "attribution"),
    "CC-BY-SA-4.0": _cc("by sa", "attribution share ?alike"),
    "CC-BY-NC-4.0": _cc("by nc", "attribution non ?commercial"),
    "CC0-1.0": r" (?:cc0|creative commons zero)(?! (?:version |v )?v?(?!1(?:\.0)? )[0-9][0-9.]* ) "
    r"|creativecommons\.org publicdomain zero 1\.0 ",
    "ISC": r" isc(?! (?:licen[sc]e )?(?:veillard|style|like) ) "
    "| hereby granted provided that the above copyright notice and this permission notice appear in all copies ",
}
# Lines with such words may be notices of any licence, so the corpus' own are no examples of ordinary text.
CUE = (
    r" (?:(?:un|sub|re)?licen[sc](?:e|es|ed|ing|or|ors|ee|ees)|copyright(?:s|ed)?|copyleft|spdx|proprietary|redistribut[a-z]*"
    r"|rights? reserved|public domain|creative commons|cc0|cc by|[al]?gpl(?:v?[0-9.]+)?) "
)
# Names for the calibration lines, which are in no notice above and are never trained on.
HELD_NAMES = {
    "MIT": ["the MIT License", "an MIT license"],
    "Apache-2.0": ["the Apache License 2.0", "Apache License, Version 2.0"],
    "GPL-3.0": ["the GNU GPL, version 3", "GPL-3.0"],
    "GPL-2.0": ["the GNU GPL, version 2", "GPL-2.0"],
    "LGPL-3.0": ["the GNU LGPL, version 3", "LGPL-3.0"],
    "AGPL-3.0": ["the GNU AGPL, version 3", "AGPL-3.0"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the 3-Clause BSD License"],
    "MPL-2.0": ["the Mozilla Public License 2.0", "MPL-2.0"],
    "CC-BY-4.0": ["the Creative Commons Attribution 4.0 License", "CC BY 4.0"],
    "CC-BY-SA-4.0": ["the Creative Commons Attribution-ShareAlike 4.0 License", "CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["the Creative Commons Attribution-NonCommercial 4.0 License", "CC BY-NC 4.0"],
    "CC0-1.0": ["CC0 1.0", "the CC0 dedication"],
    "ISC": ["the ISC License", "an ISC license"],
    UNKNOWN: ["the Zlib License", "a license of the vendor", "the Eclipse Public License 2.0", "the Apache License 1.1"],
}
HELD_FORMS = ["Code is available under the terms of {}.", "You may share these files under {}.", "All files here are covered by {}."]
LEADS = ["", "this work is", "the project is", "this page is", "source code:", "notice:"]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+(?:[.][a-z0-9]+)*"), F.lit(0))


def grams(tokens: Column, longest: int = 3) -> Column:
    """Distinct word n-grams of up to ``longest`` words."""

    def all_runs(t: Column) -> Column:
        def runs(n: int) -> Column:
            run = F.transform(t, lambda w, i: F.array_join(F.slice(t, i + 1, n), " "))
            return F.slice(run, F.lit(1), F.greatest(F.size(t) - (n - 1), F.lit(0)))

        return F.array_distinct(F.concat(t, *[runs(n) for n in range(2, longest + 1)]))

    return let(tokens, all_runs)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _strings(values) -> Column:
    """A constant array, passed as one literal; values hold no line ends."""
    return F.split(F.lit("\n".join(values)), "\n")


def _constant(value, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


@dataclass
class Classifier:
    classes: list[str]  # none and unknown included
    bias: list[float]
    weights: dict[str, list[float]]  # n-gram -> weight per class
    anchors: list[str]
    temperature: float = 1.0

    def probabilities(self, features: Column, temperature: float | None = None) -> Column:
        """Softmax over the classes; certain ``none`` for a paragraph without features."""
        t = temperature or self.temperature
        table = _constant(self.weights, "map<string,array<double>>")
        found = F.filter(F.transform(features, lambda g: F.try_element_at(table, g)), lambda v: v.isNotNull())
        start = _constant(self.bias, "array<double>")
        certain = _constant([float(c == NONE) for c in self.classes], "array<double>")

        def softmax(logits: Column) -> Column:
            powers = let(F.array_max(logits), lambda top: F.transform(logits, lambda x: F.exp((x - top) / t)))
            return let(powers, lambda p: let(F.aggregate(p, F.lit(0.0), lambda a, x: a + x), lambda s: F.transform(p, lambda x: x / s)))

        def judge(rows: Column) -> Column:
            logits = F.aggregate(rows, start, lambda a, v: F.zip_with(a, v, lambda x, y: x + y))
            return F.when(F.size(rows) == 0, certain).otherwise(let(logits, softmax))

        return let(found, judge)


def examples(spark: SparkSession, background: DataFrame) -> DataFrame:
    """(label, line, held): notices with and without a lead, their halves, and the corpus' lines as ``none``.

    A half that does not name its family is ``unknown``. Held lines are for the calibration alone: notices of other
    wording (``HELD_FORMS``), and a quarter of the corpus' lines.
    """
    rows = []
    for family, notices in [*((f, n + TITLES[f]) for f, n in NOTICES.items()), (UNKNOWN, OTHER_NOTICES)]:
        for notice in notices:
            tokens = notice.split()
            parts = [notice] + ([" ".join(tokens[: len(tokens) // 2]), " ".join(tokens[len(tokens) // 2 :])] if len(tokens) > 14 else [])
            for p in parts:
                exact = family == UNKNOWN or re.search(MARKS[family], f" {' '.join(_words(p))} ")
                rows += [(family if exact else UNKNOWN, f"{lead} {p}".strip()) for lead in LEADS]
    rows += [(NONE, line) for line in ORDINARY]
    marked = [(*r, False) for r in rows]
    marked += [(family, form.format(n), True) for family, names in HELD_NAMES.items() for n in names for form in HELD_FORMS]
    made = spark.createDataFrame(marked, "label string, line string, held boolean")
    return made.union(background.select(F.lit(NONE), "line", F.pmod(F.xxhash64("line"), F.lit(4)) == 0))


def train(spark: SparkSession, lines: DataFrame, frequent: float = 0.002) -> Classifier:
    """Fit on the notices and ``lines`` (column line; bounded by the caller).

    Lines that may be a licence notice, of a listed family or not, are left out:
    as examples of ordinary text they would hide the notices that are frequent.
    N-grams made only of words found in more than ``frequent`` of the corpus
    lines are no features.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer

    def may_be_notice(tokens: Column) -> Column:
        return _spaced(tokens).rlike(CUE) | like_a_notice(tokens)

    background = lines.select("line").distinct().where(~let(words(F.col("line")), may_be_notice))
    background = background.coalesce(2).cache()  # bounded: the sample
    count = background.count()
    common = (
        background.select(F.explode(F.array_distinct(words(F.col("line")))).alias("w"))
        .groupBy("w")
        .agg((F.count("*") / max(1, count)).alias("share"))
    )
    shares = {r["w"]: r["share"] for r in common.collect()}  # words of the sample
    usual = sorted(w for w, s in shares.items() if s > frequent)
    told = lambda g: ~F.forall(F.split(g, " "), lambda w: F.array_contains(_strings(usual), w)) if usual else F.lit(True)
    data = examples(spark, background).withColumn("grams", grams(words(F.col("line"))))
    of_notice = F.when(F.col("label") != NONE, F.filter("grams", told)).otherwise(F.col("grams"))
    data = data.withColumn("grams", of_notice).coalesce(1).cache()  # the features are n-grams of notices only
    classes = [NONE, *sorted(NOTICES), UNKNOWN]
    number = _constant({c: float(i) for i, c in enumerate(classes)}, "map<string,double>")
    data = data.withColumn("y", F.try_element_at(number, F.col("label")))
    known = data.where("label <> 'none' and not held").select("grams")
    vectors = CountVectorizer(inputCol="grams", outputCol="x", binary=True, vocabSize=1 << 14).fit(known)
    learned = data.where("not held")
    per_class = learned.groupBy("label").agg(F.count("*").alias("n"))
    fit = vectors.transform(learned).join(F.broadcast(per_class), "label").withColumn("weight", 1.0 / F.sqrt("n"))
    model = LogisticRegression(
        featuresCol="x", labelCol="y", weightCol="weight", family="multinomial", elasticNetParam=1.0, regParam=2e-4,
        maxIter=25, standardization=False,
    ).fit(fit)
    matrix, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    weights = {
        g: matrix[:, j].round(6).tolist() for j, g in enumerate(vectors.vocabulary) if abs(matrix[:, j]).max() > 1e-4
    }
    anchors = sorted(
        {re.split("[^a-z0-9]+", min(g.split(" "), key=lambda w: (shares.get(w, 0.0), -len(w), w)))[0] for g in weights}
    )
    made = Classifier(classes, bias.round(6).tolist(), weights, anchors)
    grid = [0.5, 0.75, 1.0, 1.5, 2.0, 3.0]
    at = F.col("y").cast("int")
    losses = data.where("held").agg(
        *[F.avg(-F.log(F.greatest(F.get(made.probabilities(F.col("grams"), t), at), F.lit(1e-9)))).alias(f"t{i}") for i, t in enumerate(grid)]
    ).first()
    ranked = sorted((losses[i], t) for i, t in enumerate(grid) if losses[i] is not None)
    made.temperature = ranked[0][1] if ranked else 1.0
    background.unpersist()
    data.unpersist()
    return made


def _words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+(?:[.][a-z0-9]+)*", text.lower())


def _pairs(text: str) -> list[str]:
    t = _words(text)
    return sorted({" ".join(p) for p in zip(t, t[1:])} | ({t[0]} if len(t) == 1 else set()))


def _spaced(tokens: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))


def _held_pairs(t: Column) -> Column:
    run = F.transform(t, lambda w, i: F.array_join(F.slice(t, i + 1, 2), " "))
    return F.array_distinct(F.slice(run, F.lit(1), F.greatest(F.size(t) - 1, F.lit(1))))


def _shares(held: Column, notices: list[str], share: float) -> Column:
    """Whether the pairs share enough with one of the notices, which are one literal: the plan does not grow with them."""
    wanted = _constant(sorted({tuple(_pairs(n)) for n in notices}), "array<array<string>>")

    def enough(pairs: Column) -> Column:
        both = F.size(F.array_intersect(held, pairs))
        return let(both, lambda n: (n >= share * F.size(pairs)) | ((n >= 3) & (n >= share * F.size(held))))

    return F.exists(wanted, enough)


def confirmed(tokens: Column, family: str, share: float = 0.6) -> Column:
    """Whether the paragraph names the family exactly and shares word pairs with one of its notices.

    Of the pairs it must hold ``share`` of a notice's, or consist of that share of them. Name, version and parts
    (``MARKS``) must be the family's own, so a neighbouring licence is not confirmed however many pairs it shares.
    """

    notices = NOTICES[family] + TITLES[family]
    return let(tokens, lambda t: _spaced(t).rlike(MARKS[family]) & let(_held_pairs(t), lambda held: _shares(held, notices, share)))


def like_a_notice(tokens: Column, share: float = 0.6) -> Column:
    """Whether the paragraph shares the word pairs of any notice, exact name or not."""
    notices = OTHER_NOTICES + [n for f in NOTICES for n in NOTICES[f] + TITLES[f]]
    return let(_held_pairs(tokens), lambda held: _shares(held, notices, share))


def license_scan(
    docs: DataFrame, text_col: str = "text", threshold: float = 0.5, sample_docs: int = 500, sample_lines: int = 4000
) -> DataFrame:
    """All rows of ``docs`` plus ``licenses``: array of (paragraph, family, confidence) in paragraph order.

    paragraph is the line's number from 0; family is a licence family confirmed
    by a notice, or ``unknown``. Null, empty and licence-free texts have an empty
    array. Repeated rows are scanned each; an empty table gives an empty result.
    The classifier learns ordinary text from at most ``sample_lines`` lines of
    ``sample_docs`` documents (by hash order).
    """
    spark = docs.sparkSession
    src = Input(docs, text=text_col)
    text = F.coalesce(src["text"], F.lit(""))
    some = bounded_sample(src.df.select(src["text"].alias("text")).where("text is not null"), "text", sample_docs)
    lines = some.select(F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.where("trim(line) <> ''").distinct().orderBy(F.xxhash64("line"), "line").limit(sample_lines)
    model = train(spark, lines)

    names = _strings(model.classes)

    def has_anchor(line: Column) -> Column:
        return F.arrays_overlap(F.split(F.lower(line), "[^a-z0-9]+"), _strings(model.anchors or [""]))

    def judged(x: Column) -> Column:
        def named(tokens: Column, name: Column, p: Column) -> Column:
            sure = F.lit(False)
            for family in NOTICES:
                sure = F.when(name == family, confirmed(tokens, family)).otherwise(sure)
            talk = _spaced(tokens).rlike(CUE) & like_a_notice(tokens)  # a near miss of a notice is not ordinary text
            family = F.when((name == NONE) & ~talk, name).when((name != NONE) & (p >= threshold) & sure, name).otherwise(F.lit(UNKNOWN))
            sure_of = F.when(name == NONE, 1 - p).otherwise(p)
            return F.struct(x["i"].cast("int").alias("paragraph"), family.alias("family"), sure_of.alias("confidence"))

        def best(tokens: Column, p: Column) -> Column:
            told = F.slice(p, 2, len(model.classes) - 1)  # without none, which must outweigh all others together
            top = F.when(F.get(p, F.lit(0)) >= 0.5, F.get(p, F.lit(0))).otherwise(F.array_max(told))
            at = F.when(F.get(p, F.lit(0)) >= 0.5, F.lit(0)).otherwise(F.array_position(told, F.array_max(told)))
            name = F.get(names, at.cast("int"))
            return let(F.struct(name.alias("name"), top.alias("p")), lambda b: named(tokens, b["name"], b["p"]))

        return let(words(x["line"]), lambda t: let(model.probabilities(grams(t)), lambda p: best(t, p)))

    numbered = F.transform(F.split(text, "\n"), lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    candidates = F.filter(numbered, lambda x: has_anchor(x["line"]))
    hits = F.filter(F.transform(candidates, judged), lambda x: x["family"] != NONE)
    nothing = F.expr("cast(array() as array<struct<paragraph:int,family:string,confidence:double>>)")
    return src.restore(src.df, {"licenses": F.when(has_anchor(text), hits).otherwise(nothing)})


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(documents(spark, sf_dir, "doc_id", "text"))
    families = F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["family"])))
    return found.select("doc_id", "licenses").select(
        "doc_id",
        F.size("licenses").alias("n_licenses"),
        F.array_join(families, ",").alias("families"),
        F.array_max(F.transform("licenses", lambda x: x["confidence"])).alias("confidence"),
    )

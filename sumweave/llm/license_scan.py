"""Licence statements by a trained paragraph classifier, in DataFrame functions only.

Paragraphs (lines) become sets of word n-grams of which each holds a cue word: any word of a licence
template that is not a mere function word or number, or a form of "licence". A paragraph without one
shares no telling n-gram with any template and needs no scoring. A multinomial logistic regression over these sparse
features tells licence families from each other and from text that merely mentions licences. It is
trained on paragraphs written from templates and on what holds cues in other senses. A temperature,
fitted on a held-out part, calibrates the probabilities; below a threshold a paragraph is "unknown",
which the part of its n-grams that no template holds makes likelier. A known family is confirmed if the paragraph holds enough of the n-grams of one of its templates.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, StringIndexer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sumweave.llm.exchange import saved

#: How licences are commonly named and referred to, by family.
TEMPLATES = {
    "apache": ["Licensed under the Apache License, Version 2.0", "This file is licensed under the Apache License 2.0",
               "you may not use this file except in compliance with the Apache License", "SPDX-License-Identifier: Apache-2.0"],
    "mit": ["Released under the MIT License", "This project is licensed under the terms of the MIT license",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "SPDX-License-Identifier: MIT",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "bsd": ["This software is distributed under the BSD 3-Clause License", "Use of this source code is governed by a BSD-style license",
            "Redistribution and use in source and binary forms, with or without modification, are permitted", "SPDX-License-Identifier: BSD-3-Clause",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3", "under the terms of the GNU General Public License as published by the Free Software Foundation",
            "Released under the GPL v3", "SPDX-License-Identifier: GPL-3.0-or-later",
            "This program is free software: you can redistribute it and/or modify it", "either version 3 of the License, or (at your option) any later version",
            "You should have received a copy of the GNU General Public License along with this program"],
    "lgpl": ["licensed under the GNU Lesser General Public License", "Released under the LGPL v2.1", "SPDX-License-Identifier: LGPL-2.1-only"],
    "agpl": ["licensed under the GNU Affero General Public License", "Released under the AGPL v3", "SPDX-License-Identifier: AGPL-3.0-only"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Released under the MPL 2.0 license", "SPDX-License-Identifier: MPL-2.0"],
    "cc-by": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 License", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 License", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "cc0": ["Released under CC0 1.0 Universal", "dedicated to the public domain under the CC0 license", "SPDX-License-Identifier: CC0-1.0"],
    "isc": ["Released under the ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose is hereby granted", "SPDX-License-Identifier: ISC"],
    "epl": ["Licensed under the Eclipse Public License, version 2.0", "Released under the EPL 2.0", "SPDX-License-Identifier: EPL-2.0"],
    "eupl": ["Licensed under the European Union Public Licence, version 1.2", "Licensed under the EUPL", "SPDX-License-Identifier: EUPL-1.2"],
    "zlib": ["Released under the zlib license", "Permission is granted to anyone to use this software for any purpose, including commercial applications",
             "Altered source versions must be plainly marked as such", "SPDX-License-Identifier: Zlib"],
    "wtfpl": ["Do What The Fuck You Want To Public License", "Released under the WTFPL", "SPDX-License-Identifier: WTFPL"],
    "public-domain": ["This work is in the public domain", "This is free and unencumbered software released into the public domain",
                      "placed in the public domain by the author", "SPDX-License-Identifier: Unlicense"],
    "disclaimer": ["THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED",
                   "including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement",
                   "This program is distributed in the hope that it will be useful, but without any warranty",
                   "This software is provided by the copyright holders and contributors as is and any express or implied warranties are disclaimed",
                   "This software is provided as is, without any express or implied warranty",
                   "In no event shall the authors or copyright holders be liable for any claim, damages or other liability"],
    "proprietary": ["All rights reserved", "All rights reserved, no licence is granted", "Unauthorized copying of this file is prohibited, proprietary and confidential, no license granted"],
    "none": ["He lost his driving licence last year", "A fishing license costs ten dollars in the state", "The permission of the owner is required to enter the house",
             "poetic license lets the author bend the rules", "the license plate of the car was stolen", "the license fee for television is due", "see the license file",
             "the company renewed its gaming license", "free public transport in general is popular", "the mit campus in general is large", "kam mit dem Wagen", "und mit der Zeit",
             "mit einer", "nicht mit", "mit", "cc the letter to", "copyright law in general is old", "a proprietary recipe",
             "human rights in the world", "the table was reserved for them", "the public library", "the domain of the king", "he goes to work", "a work of art",
             "the use of tools", "we use the car", "a new version of the song", "the software of the machine", "a copy of the letter", "the source of the river",
             "the terms of the treaty", "one person in the room", "the purpose of the visit", "a file on the desk", "the foundation of the house",
             "the union of the states", "european countries", "an international airport", "an eclipse of the sun", "the name of the rose", "the author of the book",
             "in the event of rain", "the claim of the heir", "the condition of the road", "the warranty of the car has expired", "he was hope that", "she granted him a wish",
             "in a particular case", "the following day", "he wants to do it", "the program of the evening", "a list of names"],
}
#: Words that tell nothing alone (n-grams of them with other words count), and forms of "licence" that no template holds.
FUNCTION_WORDS = set("a an the this that these those it its he she we you your they as at by for from in into of on or nor and with without to not no "
                     "neither either but any all such is are be been was were will would can may must shall should have has had do does what which who under v kind".split())
FORMS = set("""license licensed licence licenced licenses licences licensing licencing licensor licensors licensee licensees sublicense sublicensed
               sublicensing sublicence relicense relicensed unlicensed unlicense copyright copyrighted copyrights permission permissions redistribution
               redistribute gpl lgpl agpl gnu mpl mozilla bsd mit apache isc spdx cc cc0 commons copyleft proprietary unauthorized unauthorised
               warranty warranties disclaimer disclaimers trademark trademarks patent patents""".split())
#: Words of the longest n-gram; below this probability the family is unknown; a template is confirmed with so large a part of its n-grams.
GRAM, KNOWN, CONFIRMED = 3, 0.5, 0.5
#: Ridge of the regression.
RIDGE = 1e-3
#: An n-gram is a feature if it holds one of these words: all words of the licences' templates but function words and numbers.
CUES = sorted(FORMS | {w for f, texts in TEMPLATES.items() if f != "none" for t in texts for w in re.findall(r"[^\W_]+", t.lower())
                       if w not in FUNCTION_WORDS and not w.isdigit()})


@dataclass
class Model:
    """Families, their biases, the weights of each n-gram (gram, w), and the temperature."""

    families: list[str]
    bias: list[float]
    weights: DataFrame
    temperature: float


def words(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), r"[^\p{L}\p{N}]+"), "")


def cue_places(w: Column) -> Column:
    """Positions of the cue words in an array of words."""
    return F.filter(F.transform(w, lambda x, i: F.when(x.isin(CUES), i)), lambda i: i.isNotNull())


def with_grams(df: DataFrame, keep: list[str]) -> DataFrame:
    """keep and grams, the distinct n-grams that hold a cue, of the array column w.

    The places of the cues are a column of their own, and an n-gram is put together from single words:
    its cost then depends on the number of cues, not on the length of the line.
    """
    placed = df.select(*keep, "w", cue_places(F.col("w")).alias("at"))

    def of(n: int) -> Column:
        def around(q: Column) -> Column:
            low, high = F.greatest(q - (n - 1), F.lit(0)), F.least(q, F.size("w") - n)
            return F.when(low <= high, F.sequence(low, F.greatest(high, low))).otherwise(F.array().cast("array<int>"))
        starts = F.array_distinct(F.flatten(F.transform("at", around)))
        return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get("w", i + j) for j in range(n)]))

    return placed.select(*keep, F.array_distinct(F.concat(*[of(n) for n in range(1, GRAM + 1)])).alias("grams"))


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, paragraph, grams): the lines of each text that hold a cue word, numbered from 0 among all its lines."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    lines = texts.select("doc_id", F.posexplode(F.split("text", "\r\n?|\n")).alias("paragraph", "line"))
    # The words are a column of their own first, or the line would be split anew for every n-gram. (A filter on the n-grams
    # would be pushed below this column and do just that.)
    lines = lines.select("doc_id", "paragraph", words(F.col("line")).alias("w")).where(
        F.exists("w", lambda x: x.isin(CUES)))
    return with_grams(lines, ["doc_id", "paragraph"])


def template_frame(spark: SparkSession) -> DataFrame:
    """(family, template, line): a literal table of the templates."""
    rows = [F.struct(F.lit(f).alias("family"), F.lit(i).alias("template"), F.lit(t).alias("line"))
            for f, texts in TEMPLATES.items() for i, t in enumerate(texts)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def training_frame(spark: SparkSession) -> DataFrame:
    """(family, cut, grams): each template whole, and without up to two words at either end; cut 4 is held out."""
    shown = template_frame(spark).select("family", words(F.col("line")).alias("w"), F.explode(F.sequence(F.lit(0), F.lit(8))).alias("cut"))
    front, back = F.col("cut") % 3, (F.col("cut") / 3).cast("int")
    kept = F.slice("w", front + 1, F.greatest(F.size("w") - front - back, F.lit(1)))
    return with_grams(shown.select("family", "cut", kept.alias("w")), ["family", "cut"]).where("size(grams) > 0")


def fit(spark: SparkSession) -> Model:
    """Trains on the templates' variants; what reaches the driver is bounded by their number."""
    train = saved(spark, training_frame(spark), "licences")
    part = train.where("cut <> 4")
    counted = CountVectorizer(inputCol="grams", outputCol="features", binary=True).fit(part)
    named = StringIndexer(inputCol="family", outputCol="label", stringOrderType="alphabetAsc").fit(part)
    fitted = LogisticRegression(family="multinomial", regParam=RIDGE, standardization=False, maxIter=100).fit(
        named.transform(counted.transform(part)))
    families, bias, matrix = list(named.labels), [float(x) for x in fitted.interceptVector], fitted.coefficientMatrix.toArray()
    rows = [(g, [float(x) for x in matrix[:, i]]) for i, g in enumerate(counted.vocabulary)]
    weights = saved(spark, spark.createDataFrame(rows, "gram string, w array<double>"), "weights")
    model = Model(families, bias, weights, 1.0)
    held = [(families.index(r["family"]), list(r["logits"])) for r in
            logits(train.where("cut = 4"), model, ["family", "grams"]).select("family", "logits").collect()]

    def loss(t: float) -> float:
        return sum(math.log(sum(math.exp((z - max(zs)) / t) for z in zs)) - (zs[k] - max(zs)) / t for k, zs in held)

    model.temperature = min((0.25 * 1.15 ** i for i in range(30)), key=loss)
    return model


def logits(rows: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """keys, logits (an array in the order of the families) and known, the part of the grams that have weights."""
    own = rows.select(*keys, F.explode("grams").alias("gram"))
    # The weights are at most the n-grams of the templates.
    met = own.join(F.broadcast(model.weights), "gram", "left")
    sums = [F.sum(F.coalesce(F.get("w", k), F.lit(0.0))) + F.lit(b) for k, b in enumerate(model.bias)]
    return met.groupBy(*keys).agg(F.array(*sums).alias("logits"), (F.count("w") / F.count(F.lit(1))).alias("known"))


def scan(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, paragraph, family, probability, similarity, confirmed) of every line of docs that holds a cue word.

    family is a licence's, "none" for text that only holds a cue, or "unknown" below the threshold; similarity is the
    largest part of a template's n-grams of that family that the line holds (0 for unknown and none), and confirmed says
    whether that is enough. Null and empty texts have no lines; a null id is kept; repeated rows with one id give one row
    per line; other columns are not read.
    """
    model = fit(spark)
    keys = ["doc_id", "paragraph"]
    lines = paragraphs(docs, id_col, text_col).dropDuplicates([*keys, "grams"])
    found = logits(lines, model, [*keys, "grams"])
    shifted = F.transform("logits", lambda x: F.exp((x - F.array_max("logits")) / model.temperature))
    best = F.array_max(F.transform("shifted", lambda x, i: F.struct(x.alias("x"), (-i).alias("i"))))
    # N-grams that no template holds take from the certainty.
    found = found.select(*keys, "grams", "known", shifted.alias("shifted")).select(
        *keys, "grams", best["i"].alias("i"), (F.col("known") * best["x"] / F.aggregate("shifted", F.lit(0.0), lambda a, b: a + b)).alias("probability"))
    names = F.array(*[F.lit(f) for f in model.families])
    found = found.select(*keys, "grams", "probability", F.when(F.col("probability") < KNOWN, F.lit("unknown")).otherwise(F.get(names, -F.col("i"))).alias("family"))
    templates = with_grams(template_frame(spark).where("family <> 'none'").select("family", words(F.col("line")).alias("w")), ["family"])
    templates = templates.groupBy("family").agg(F.collect_list("grams").alias("templates"))
    found = found.join(F.broadcast(templates), "family", "left")  # one row per family
    similarity = F.coalesce(F.array_max(F.transform("templates", lambda t: F.size(F.array_intersect(t, F.col("grams"))) / F.size(t))), F.lit(0.0))
    return found.select(*keys, "family", F.round("probability", 6).alias("probability"), F.round(similarity, 6).alias("similarity"),
                        (similarity >= CONFIRMED).alias("confirmed"))

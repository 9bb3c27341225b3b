"""Licence notices in texts: a trained word n-gram classifier, confirmed by comparison with templates.

Everything that reads documents is a DataFrame function or an MLlib stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.operators.ordering import running_totals
from lakeops.session import discard, materialize

# Common wordings of public licences, by family.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0",
        "You may not use this file except in compliance with the License",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer",
        "Use of this source code is governed by a BSD-style license",
        "Released under the BSD 3-Clause License",
    ],
    "cc-by": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 "
              "International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons "
                 "Attribution-NonCommercial 4.0 International License"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons "
                 "Attribution-ShareAlike 4.0 International License"],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License, version 2",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program",
    ],
    "lgpl": ["Licensed under the GNU Lesser General Public License, version 2.1",
             "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "mit": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software",
    ],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0",
            "Licensed under the Mozilla Public License, version 2.0"],
    "public-domain": ["This is free and unencumbered software released into the public domain",
                      "This work is dedicated to the public domain under CC0 1.0, no copyright"],
}
# Names of the same licences as people write them, then their SPDX identifiers.
SHORT_NAMES = {
    "apache": ["Apache License", "Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0 License"],
    "bsd": ["BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "New BSD License", "Simplified BSD License"],
    "cc-by": ["Creative Commons Attribution 4.0 International License", "CC BY 4.0 License"],
    "cc-by-nc": ["Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0 License"],
    "cc-by-sa": ["Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0 License"],
    "gpl": ["GNU General Public License", "GNU GPL", "GPL License", "GNU General Public License v3.0"],
    "lgpl": ["GNU Lesser General Public License", "GNU LGPL", "LGPL License", "GNU Lesser General Public License v2.1"],
    "mit": ["MIT License", "MIT License (MIT)"],
    "mpl": ["Mozilla Public License", "Mozilla Public License 2.0", "MPL 2.0 License"],
    "public-domain": ["CC0 1.0 Universal", "CC0 License"],
}
IDENTIFIERS = {
    "apache": ["Apache-2.0"],
    "bsd": ["BSD-2-Clause", "BSD-3-Clause"],
    "cc-by": ["CC-BY-3.0", "CC-BY-4.0"],
    "cc-by-nc": ["CC-BY-NC-4.0"],
    "cc-by-sa": ["CC-BY-SA-3.0", "CC-BY-SA-4.0"],
    "gpl": ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"],
    "lgpl": ["LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "mit": ["MIT"],
    "mpl": ["MPL-2.0"],
    "public-domain": ["CC0-1.0"],
}
#: What a short notice says around a name, and around an identifier.
NAME_FORMS = ["{}", "The {}", "under the {}"]
IDENTIFIER_FORMS = ["SPDX-License-Identifier: {}", "License: {}", "licensed under {}", "{} licensed", "{} license"]
UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *sorted(TEMPLATES)]
#: Only paragraphs with one of these words can be a licence notice; all templates have one. The first letters are looked at
#: ahead, as most places have none of them.
NAMES = (r"(?i)(?=[acfglprw][acegiopru])(?:licen[cs]e|copyright|permission|permitted|warrant|redistribut|creative commons|"
         r"\bcc[ -]?by|public domain|free software|\b[la]?gpl\b|\bcc0)")
#: The break of a wrapped line, with what opens a line of a comment: a small letter goes on with the sentence, as does
#: a capital after a long line that no sign ends.
WRAPPED = (r"\n(?:(?<=[\p{L}\p{N},(/-][ \t\r]{0,3}\n)[ \t]*+(?:(?://+|#+|\*+|;+|>+|--+)[ \t]+)?(?=\p{Ll})"
           r"|(?<=[^\n]{50}[\p{L}\p{N},(/-][ \t\r]{0,3}\n)[ \t]*+(?:(?://+|#+|\*+|;+|>+|--+)[ \t]+)?(?=\p{Lu}))")
#: What all ordinary sentences that teach the unknown class weigh together at most, however many they are; a wording of
#: the largest family weighs 1.
ORDINARY_WEIGHT = 1000.0
#: Share of held-out ordinary sentences that stay below the threshold of a licence's probability.
QUIET = 0.99
LEAST_PROBABILITY = 0.5
#: Least share of a paragraph's and of a template's word triples that the other has (the larger one counts).
CONFIRMED = 0.6


def _words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _grams(words: Column, n: int) -> Column:
    found = words
    for i in range(1, n):
        found = F.zip_with(found, F.slice(words, i + 1, F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(found, lambda g: g.isNotNull())


def _with_grams(pieces: DataFrame, known: list[str] | None = None) -> DataFrame:
    """Adds the word sequences of up to three words, those of ``known`` words alone if given, and the distinct ones of
    three alone (of all words if fewer)."""
    split = pieces.withColumn("words", _words(F.col("piece"))).filter(F.size("words") > 0)
    whole = F.when(F.size("words") < 3, F.array(F.array_join("words", " "))).otherwise(_grams(F.col("words"), 3))
    kept = F.col("words") if known is None else F.transform("words", lambda w: F.when(w.isin(known), w))
    return split.withColumn("triples", F.array_distinct(whole)).withColumn("kept", kept).withColumn(
        "grams", F.concat(*[_grams(F.col("kept"), n) for n in (1, 2, 3)])).drop("kept")


def _lines() -> Column:
    """The paragraphs of a text: its lines, of which wrapped ones are joined. A capital after a line of fewer than 50
    characters begins a paragraph, as headings and lists of notices do."""
    return F.split(F.regexp_replace("text", WRAPPED, " "), "\n", -1)


def wordings() -> list[tuple[str, str]]:
    """(family, wording) of all templates, the short forms of names and identifiers among them."""
    short = ((SHORT_NAMES, NAME_FORMS), (IDENTIFIERS, IDENTIFIER_FORMS))
    return [(f, t) for f in sorted(TEMPLATES) for t in TEMPLATES[f]] + [
        (f, form.format(name)) for names, forms in short for f in sorted(names) for name in names[f] for form in forms]


def _pieces(texts: DataFrame) -> DataFrame:
    """The sentences of every paragraph that may be or hold a notice: key, paragraph, piece."""
    lines = texts.select("key", F.posexplode(_lines()).alias("paragraph", "line"))
    return lines.filter(F.col("line").rlike(NAMES)).select(
        "key", "paragraph", F.explode(F.split("line", r"(?<=[.!?;])\s+", -1)).alias("piece"))


def templates(spark: SparkSession) -> DataFrame:
    """family, label and piece of every template; a fixed small table."""
    rows = [F.struct(F.lit(f).alias("family"), F.lit(float(FAMILIES.index(f))).alias("label"), F.lit(t).alias("piece"))
            for f, t in wordings()]
    return spark.range(1).select(F.inline(F.array(*rows)))


@dataclass
class LicenceModel:
    counter: CountVectorizerModel
    classifier: LogisticRegressionModel
    threshold: float
    taught: int  # distinct ordinary sentences that the classifier was fitted on
    held: int  # and those that set the threshold


def _counter(notices: DataFrame) -> CountVectorizerModel:
    """Marks which word sequences of the templates a sentence has; there are some hundreds, so they are held."""
    known = _with_grams(notices).select(F.explode("grams").alias("gram")).distinct().orderBy("gram").collect()
    return CountVectorizerModel.from_vocabulary([r.gram for r in known], "grams", "features", binary=True)


def _licence_probability() -> Column:
    return 1 - F.get(vector_to_array("probability"), F.lit(0))


def _ordinary(texts: DataFrame, counter: CountVectorizerModel) -> DataFrame:
    """features, taught, held: how many distinct sentences of all paragraphs that can be no notice have these features,
    by the half they belong to. Sentences of equal features are one row, so what is fitted stays small."""
    lines = texts.select(F.explode(_lines()).alias("line")).filter(~F.col("line").rlike(NAMES))
    pieces = lines.select(F.explode(F.split("line", r"(?<=[.!?;])\s+", -1)).alias("piece")).filter("trim(piece) <> ''")
    halves = pieces.distinct().withColumn("aside", F.pmod(F.xxhash64("piece", F.lit(1)), 2) == 0)
    words = [g for g in counter.vocabulary if " " not in g]  # a sequence with another word is none of the templates'
    return counter.transform(_with_grams(halves, words)).groupBy("features").agg(
        F.count_if(~F.col("aside")).alias("taught"), F.count_if("aside").alias("held"))


def _threshold(scored: DataFrame) -> float:
    """The probability that ``QUIET`` of the held-out sentences do not exceed (probability, held: their number), but
    ``LEAST_PROBABILITY`` at least. It is exact: those beyond the least are counted by value and added up in order."""
    small = F.sum(F.when(F.col("probability") <= LEAST_PROBABILITY, F.col("held")).otherwise(0))
    low, n = scored.agg(small, F.sum("held")).first()
    if n is None or low >= QUIET * n:
        return LEAST_PROBABILITY
    high = materialize(scored.filter(F.col("probability") > LEAST_PROBABILITY).groupBy("probability").agg(
        F.sum("held").alias("held")))
    ranked = running_totals(high, {"upto": F.col("held")}, [F.col("probability")])
    level = ranked.filter(F.col("upto") >= QUIET * n - low).agg(F.min("probability")).first()[0]
    discard(high, ranked)
    return level


def train(texts: DataFrame) -> LicenceModel:
    """Multinomial logistic regression over the n-grams of the templates, fitted on parts of the templates and on the
    ordinary sentences of all ``texts`` (key, text): each distinct one either teaches or, in the half held out, sets
    what a licence's probability must exceed."""
    spark = texts.sparkSession
    notices = templates(spark)
    counter = _counter(notices)
    words = F.split("piece", " ")
    # The whole wording, and it without some of its first or last words, as notices are quoted in part.
    cuts = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in range(3) for b in range(3)])
    parts = notices.select("label", F.explode(cuts).alias("cut"), words.alias("w")).filter(
        F.size("w") - F.col("cut.a") - F.col("cut.b") >= 4).select(
        "label", F.array_join(F.slice("w", F.col("cut.a") + 1, F.size("w") - F.col("cut.a") - F.col("cut.b")),
                              " ").alias("piece"))
    spare = spark.range(1).select(F.lit(0.0).alias("label"), F.lit("words without any meaning").alias("piece"))  # so that the class is never empty
    known = materialize(counter.transform(_with_grams(
        notices.select("label", "piece").unionByName(parts).unionByName(spare))).select("label", "features"))
    # Families have few or many wordings and weigh the same; there are as many counts as families.
    counts = {r.label: r.n for r in known.filter("label > 0").groupBy("label").agg(F.count("*").alias("n")).collect()}
    weights = F.array(F.lit(1.0), *[F.lit(max(counts.values()) / counts[float(i)]) for i in range(1, len(FAMILIES))])
    ordinary = materialize(_ordinary(texts, counter))
    taught, held = (n or 0 for n in ordinary.agg(F.sum("taught"), F.sum("held")).first())
    each = min(1.0, ORDINARY_WEIGHT / max(taught, 1))
    rows = known.select("label", "features", F.get(weights, F.col("label").cast("int")).alias("weight")).unionByName(
        ordinary.filter("taught > 0").select(F.lit(0.0).alias("label"), "features",
                                             (F.col("taught") * each).alias("weight")))
    classifier = LogisticRegression(maxIter=60, regParam=1e-4, family="multinomial", weightCol="weight").fit(rows)
    scored = classifier.transform(ordinary.filter("held > 0")).select(
        _licence_probability().alias("probability"), "held")
    model = LicenceModel(counter, classifier, _threshold(scored), taught, held)
    discard(known, ordinary)
    return model


def paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, paragraph (its number from 0; wrapped lines are one), family: every paragraph that names a licence, and what it was found to be.

    A sentence has the family that the classifier finds most likely if its probability exceeds the threshold and a
    template of that family confirms it; a paragraph has the family of its likeliest confirmed sentence, else
    ``unknown``. Templates are a fixed table, so joining them is a broadcast of bounded size.
    """
    texts = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    model = train(texts)
    pieces = model.counter.transform(_with_grams(_pieces(texts)))
    names = F.array(*[F.lit(f) for f in FAMILIES])
    scored = model.classifier.transform(pieces).select(
        "key", "paragraph", "triples", _licence_probability().alias("probability"),
        F.get(names, F.col("prediction").cast("int")).alias("family"))
    compared = _with_grams(templates(docs.sparkSession)).groupBy("family").agg(F.collect_list("triples").alias("known"))
    joined = scored.join(F.broadcast(compared), "family", "left")

    def agreement(template: Column) -> Column:
        shared = F.size(F.array_intersect("triples", template))
        return F.greatest(shared / F.size(template), shared / F.size("triples"))

    best = F.array_max(F.transform("known", agreement))
    found = (F.col("probability") > model.threshold) & (best >= CONFIRMED)
    sentences = joined.select("key", "paragraph", F.when(found, F.struct("probability", "family")).alias("found"))
    return sentences.groupBy("key", "paragraph").agg(F.max("found").alias("found")).select(
        F.col("key").alias(key), "paragraph", F.coalesce("found.family", F.lit(UNKNOWN)).alias("family"))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, families (sorted, joined by commas; empty if none), n_notices (paragraphs with a confirmed
    family), n_unknown (paragraphs that name a licence but were not confirmed).

    Texts are read whole, whatever their length. Of equally likely families the last by name counts. NULL and empty texts have none. Rows that share a key are one document, whose paragraphs of the same
    number count once; NULL keys are one as well. Only keys and counts are shuffled.
    """
    by = paragraphs(docs, key, text).groupBy(F.col(key).alias("of")).agg(
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("family") != UNKNOWN, F.col("family")))), ",").alias("families"),
        F.count_if(F.col("family") != UNKNOWN).alias("n_notices"), F.count_if(F.col("family") == UNKNOWN).alias("n_unknown"))
    keys = docs.select(docs[key].alias(key))
    return keys.join(by.hint("merge"), keys[key].eqNullSafe(by["of"]), "left").select(
        key, F.coalesce("families", F.lit("")).alias("families"), F.coalesce("n_notices", F.lit(0)).alias("n_notices"),
        F.coalesce("n_unknown", F.lit(0)).alias("n_unknown"))

"""Licence scans: trained paragraph classifier, confirmed by templates.

A passage is a line of a text, with the lines that it is wrapped over: a line
that does not end like a sentence goes on in the next one if that begins with a
Latin letter, a digit, a quote or a parenthesis (after comment signs). A wrapped
passage is judged as a whole and line by line; if the whole holds a notice, its
lines are not reported. The words of a passage are lower-cased runs of a-z,
digits, and dots, plus and minus signs between them. Its features are its words
and word 2-grams, as a sparse count vector over the words and 2-grams that occur
in the templates and the look-alikes. A multinomial logistic regression gives
the probability of each licence family and of ``unknown``.

*Training.* Positive rows are the templates' lines and their word windows, as
licence notices are often cut. Negative rows are the look-alikes (notices of
other licences and versions) and every distinct passage of the whole corpus whose
hash is even and that shares no word 3-gram with a template. *Calibration.* Every
distinct passage with an odd hash, those that share 3-grams with templates but
are confirmed for no family included, and the look-alikes' word windows set the
cutoff: the ``quantile`` of the highest probability of being a notice
(1 - unknown) seen there, at least 0.5. Below the cutoff a passage is
``unknown``. *Weights.* In both, a passage counts equally with every other one;
where they are more than ``corpus_weight``, all together weigh that many rows, so
that they do not drown the notices, whose number is fixed. None is left out.
*Confirmation.* A passage over
the cutoff has every family of probability ``MIN_FAMILY`` or more for which it
holds the words that tell the family and its version (``TELLING``), and shares
with one of its templates word 3-grams that are at least ``min_overlap`` of the
template's or of the passage's own.

Scoring covers every passage of every whole text. Passages are cut and their
features taken once (:func:`measured`), for both fit and scan.

Defined results: null or empty text has no passage and no licence; every
input row gives one row; rows that repeat an id share the findings of all of
them, rows equal in id and text count once; null ids share theirs likewise;
extra columns are ignored; an empty table gives an empty table (and an
untrained model finds nothing).

DataFrame functions and Spark's own JVM estimators only.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linecast.llm.common import materialize

#: What the corpus's passages weigh together, in rows, if there are more.
CORPUS_WEIGHT = 2000
QUANTILE = 0.99
MIN_OVERLAP = 0.6
#: Least probability of a family that is reported.
MIN_FAMILY = 0.02
UNKNOWN = "unknown"

#: Licence families and their notices. Fixed values.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "Copyright. All rights reserved."),
    ("Proprietary", "Confidential and proprietary. Unauthorized copying of this file, via any medium, is strictly prohibited."),
)

#: Words that tell a family and its version (patterns over normal words with one
#: blank between them). ``BSD`` leaves the number of clauses open. Fixed values.
_GPL = r"general public license( as published by the free software foundation)?( either)? (version |v)"
TELLING = {
    "Apache-2.0": r"\b(apache license (version |v)?2\.0|apache-2\.0|on an as is basis without warranties or conditions of any kind)( |$)",
    "BSD": r"\b(redistribution and use in source and binary forms|bsd-style license)( |$)",
    "BSD-3-Clause": r"\bneither the name of\b.* may be used to endorse or promote( |$)",
    "CC-BY-4.0": r"(^| )(cc by 4\.0|cc-by-4\.0|creative commons attribution 4\.0)( |$)",
    "CC-BY-NC-4.0": r"(^| )(cc by-nc 4\.0|cc-by-nc-4\.0|creative commons attribution-noncommercial 4\.0)( |$)",
    "CC-BY-SA-4.0": r"(^| )(cc by-sa 4\.0|cc-by-sa-4\.0|creative commons attribution-sharealike 4\.0)( |$)",
    "CC0-1.0": r"\bwaived all copyright and related or neighboring rights( |$)",
    "GPL-2.0": rf"\bgnu {_GPL}2(\.0)?( |$)",
    "GPL-3.0": rf"\bgnu {_GPL}3(\.0)?( |$)",
    "LGPL-2.1": rf"\bgnu lesser {_GPL}2\.1( |$)",
    "MIT": r"(^| )(mit license|permission is hereby granted free of charge to any person obtaining a copy of this software)( |$)",
    "MPL-2.0": r"\bmozilla public license (version |v )?2\.0( |$)",
    "Proprietary": r"\b(all rights reserved|confidential and proprietary|unauthorized copying of this file)( |$)",
}

#: Notices of licences and versions that are none of the families. Fixed values.
LOOKALIKES = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    "Licensed under CC BY 3.0.",
    "This work is licensed under a Creative Commons Attribution 3.0 Unported License.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "Licensed under the Apache Software License, Version 1.1.",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
)


#: Stands for a line feed inside a passage.
_SOFT = "\u000b"
#: ASCII characters that are in no word, line feeds left out.
_GAPS = "".join(c for c in map(chr, range(1, 128)) if not (c.isalnum() or c in ".+-\n" + _SOFT))


def normal(text: Column) -> Column:
    """Lower-cased words with one blank between them; line feeds stay, those inside
    a passage as ``_SOFT``."""
    wrapped = F.regexp_replace(F.replace(text, F.lit(_SOFT), F.lit(" ")), r"(?<=[^.!?:|\s])[ \t\r]*+\n(?=[ \t]*+[*#/;>-]*+[ \t]*+[A-Za-z0-9(\"'])", _SOFT)
    inner = F.regexp_replace(F.lower(wrapped), r"[.+-]+(?![a-z0-9])|(?<![a-z0-9])[.+-]+", " ")
    # A negated class, of all that is in no word or not ASCII, takes several times as long.
    plain = F.translate(F.regexp_replace(inner, r"[\x00\x80-\x{10ffff}]+", " "), _GAPS, " " * len(_GAPS))
    return F.regexp_replace(plain, "  +", " ")


def words(line: Column) -> Column:
    """Words of a normal line, no empty ones."""
    trimmed = F.btrim(line)
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, " "))


def trigrams(tokens: Column) -> Column:
    """Distinct word 3-grams (of shorter lines: the whole line)."""
    grams = F.transform(F.sequence(F.lit(0), F.greatest(F.size(tokens), F.lit(3)) - 3), lambda i: F.array_join(F.slice(tokens, i + 1, F.lit(3)), " "))
    return F.when(F.size(tokens) > 0, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, passage, part, words) of every passage with a word and of
    the lines of wrapped ones: part 0 is the whole, part n its line n."""
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    some = docs.select(F.col(id_col).alias("id"), F.xxhash64(raw).alias("text_key"), F.posexplode(F.split(normal(raw), "\n")).alias("passage", "text")).where(F.btrim("text") != "")
    parts = F.when(F.instr("text", _SOFT) > 0, F.concat(F.array(F.regexp_replace("text", " *\\x0b *", " ")), F.split("text", "\\x0b"))).otherwise(F.array("text"))
    lines = some.select("id", "text_key", "passage", F.posexplode(parts).alias("part", "text")).where(F.btrim("text") != "")
    return lines.select("id", "text_key", "passage", "part", words(F.col("text")).alias("words"))


def features(rows: DataFrame, counter: CountVectorizerModel) -> DataFrame:
    """``rows`` with the sparse counts of known words and 2-grams in ``features``."""
    paired = NGram(n=2, inputCol="words", outputCol="_pairs").transform(rows)
    return counter.transform(paired.withColumn("_terms", F.concat("words", "_pairs")).drop("_pairs")).drop("_terms")


def _templates(spark: SparkSession, templates) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(f).alias("family"), words(normal(F.lit(t))).alias("words")) for f, t in templates))
    return spark.range(1).select(F.explode(rows).alias("t")).select("t.family", "t.words")


def _windows(known: DataFrame) -> DataFrame:
    """(family, words): tails and heads of 4 words and more, in steps of 3."""
    n = F.size("words")
    starts = F.when(n > 5, F.sequence(F.lit(1), n - 4, F.lit(3))).otherwise(F.array(F.lit(1)))
    cut = known.withColumn("s", F.explode(starts))
    tails, heads = (cut.select("family", F.slice("words", a, b).alias("words")) for a, b in ((F.col("s"), n), (F.lit(1), n - F.col("s") + 1)))
    return tails.unionByName(heads).where(F.size("words") >= 4)


@dataclass
class Notices:
    """What is known of the templates: families, 3-grams, counter of terms."""

    families: list[str]
    templates: list  # (family, 3-grams)
    counter: CountVectorizerModel
    known: DataFrame
    alike: DataFrame


def notices(spark: SparkSession, templates=TEMPLATES) -> Notices:
    known = _templates(spark, templates)
    alike = _templates(spark, [(UNKNOWN, t) for t in LOOKALIKES])
    # The templates are the operator's parameter: their 3-grams become literals.
    own = known.select("family", "words", trigrams(F.col("words")).alias("grams")).collect()
    vocabulary = sorted({" ".join(w[i:i + n]) for w in [r["words"] for r in own + alike.collect()] for n in (1, 2) for i in range(len(w) - n + 1)})
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_terms", outputCol="features")
    return Notices(sorted({f for f, _ in templates}) + [UNKNOWN], [(r["family"], r["grams"]) for r in own], counter, known, alike)


def measured(docs: DataFrame, about: Notices, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The passages of whole texts, stored: id, text_key, passage, part, features,
    ``h`` (hash of the words), and the words of those that share a word 3-gram with
    a template (null for the others, which no family can be confirmed for)."""
    shares = F.exists(trigrams(F.col("words")), lambda g: g.isin(sorted({g for _, own in about.templates for g in own})))
    rows = features(paragraphs(docs, id_col, text_col), about.counter).withColumn("h", F.xxhash64("words"))
    return materialize(rows.withColumn("words", F.when(shares, F.col("words"))), "license-passages")


def _highest(counts: DataFrame, over: Callable[[int, int], bool]) -> float | None:
    """The highest notice down to which ``over(passages, windows)`` holds for the
    numbers of rows so far (``alike``: a window), None if it holds for none.

    Exact: each round counts the rows in 1,025 steps and goes on inside one."""
    lo, hi, seen = 0.0, 1.0, [0, 0]
    while True:
        steps = counts.where(F.col("notice").between(lo, hi)).groupBy(F.floor((F.col("notice") - lo) / (hi - lo) * 1024).alias("step"))
        found = steps.agg(F.count_if(~F.col("alike")).alias("passages"), F.count_if("alike").alias("windows"), F.min("notice").alias("lo"), F.max("notice").alias("hi"))
        for r in found.orderBy(F.desc("step")).collect():
            if over(seen[0] + r["passages"], seen[1] + r["windows"]):
                break
            seen = [seen[0] + r["passages"], seen[1] + r["windows"]]
        else:
            return None
        if r["lo"] == r["hi"]:
            return r["lo"]
        lo, hi = r["lo"], r["hi"]


@dataclass
class Model:
    """A fitted classifier with its families, cutoff, template 3-grams and the
    numbers of distinct passages it was trained and calibrated on."""

    lr: LogisticRegressionModel | None
    about: Notices
    cutoff: float
    trained: int
    spared: int

    @property
    def counter(self) -> CountVectorizerModel:
        return self.about.counter

    @property
    def families(self) -> list[str]:
        return self.about.families

    @property
    def templates(self) -> list:
        return self.about.templates

    def named(self, rows: DataFrame) -> DataFrame:
        """The rows (with ``features``) whose likeliest class is a family, with the
        probability of being a notice (``notice``) and of each class (``_each``).
        Probabilities are computed for these rows only."""
        classed = self.lr.copy({self.lr.rawPredictionCol: "", self.lr.probabilityCol: ""}).transform(rows)
        some = classed.where(F.col("_best") != len(self.families) - 1).drop("_best")
        sure = self.lr.copy({self.lr.rawPredictionCol: "", self.lr.predictionCol: ""}).transform(some)
        each = sure.withColumn("_each", vector_to_array("_p")).drop("_p", "features")
        return each.withColumn("notice", 1 - F.element_at("_each", len(self.families)))

    def overlap(self, family: str, grams: Column) -> Column:
        """Largest share of 3-grams common with a template of the family."""
        shares = [F.size(F.array_intersect(grams, F.array(*map(F.lit, own)))) / F.least(F.size(grams), F.lit(len(own))) for f, own in self.templates if f == family]
        return F.greatest(*shares) if len(shares) > 1 else shares[0]

    def confirmed(self, named: DataFrame, min_overlap: float) -> DataFrame:
        """``named`` with ``found``: (family, probability, overlap) of every
        confirmed family."""
        rows = named.withColumn("_grams", trigrams(F.col("words"))).withColumn("_text", F.array_join("words", " "))
        checks = []
        for i, f in enumerate(self.families[:-1]):
            p = F.element_at("_each", i + 1)
            told = F.col("_text").rlike(TELLING[f]) if f in TELLING else F.lit(True)
            share = F.when((p >= MIN_FAMILY) & F.col("words").isNotNull() & told, self.overlap(f, F.col("_grams"))).otherwise(0.0)
            checks.append(F.struct(F.lit(f).alias("family"), p.alias("probability"), share.alias("overlap")))
        found = F.filter(F.array(*checks), lambda c: c["overlap"] >= min_overlap)
        return rows.withColumn("found", found).drop("_grams", "_text", "_each")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, corpus_weight: int = CORPUS_WEIGHT, quantile: float = QUANTILE) -> Model:
    about = notices(docs.sparkSession, templates)
    return fit_passages(measured(docs, about, id_col, text_col), about, corpus_weight, quantile)


def fit_passages(rows: DataFrame, about: Notices, corpus_weight: int = CORPUS_WEIGHT, quantile: float = QUANTILE) -> Model:
    """The model of the corpus whose :func:`measured` passages are ``rows``."""
    odd = F.pmod("h", F.lit(2)) == 1
    # A line that many texts share counts once; lines of equal features are one row with their number.
    distinct = rows.where(~odd & F.col("words").isNull()).select("h", "features").dropDuplicates(["h"])
    negative = materialize(distinct.groupBy("features").agg(F.count(F.lit(1)).alias("n")), "license-negatives")
    trained = negative.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    spared = rows.where(odd).select("h").distinct().count()
    if trained == 0:
        # Nothing to tell licences from: the model names none.
        return Model(None, about, 1.0, trained, spared)

    # Whole lines weigh as much as all their windows.
    known, alike = about.known, about.alike
    cut = _windows(known)
    positive = cut.unionByName(known).unionByName(known).unionByName(alike).unionByName(alike)
    label = F.array_position(F.array(*map(F.lit, about.families)), F.col("family")).cast("double") - 1
    own = features(positive, about.counter).select(label.alias("label"), "features", F.lit(1.0).alias("weight"))
    corpus = negative.select(F.lit(len(about.families) - 1.0).alias("label"), "features", (F.col("n") * min(1.0, corpus_weight / trained)).alias("weight"))
    training = materialize(corpus.unionByName(own.coalesce(1)), "license-training")
    lr = LogisticRegression(family="multinomial", maxIter=40, regParam=0.001, labelCol="label", featuresCol="features", weightCol="weight", rawPredictionCol="_raw", probabilityCol="_p", predictionCol="_best").fit(training)
    model = Model(lr, about, 0.5, trained, spared)
    # Notices of the families are no evidence against them. Rows whose likeliest
    # class is unknown are no notices at any cutoff.
    windows = _windows(alike).select("words")
    tried = [
        model.named(rows.where(odd).select("h", "features", "words")).dropDuplicates(["h"]).drop("h").withColumn("alike", F.lit(False)),
        model.named(features(windows, about.counter)).withColumn("alike", F.lit(True)),
    ]
    none = [model.confirmed(t, MIN_OVERLAP).where(F.size("found") == 0).select("notice", "alike") for t in tried]
    each, all_windows = min(1.0, corpus_weight / max(spared, 1)), windows.count()
    allowed = (1 - quantile) * (each * spared + all_windows)
    top = _highest(materialize(none[0].unionByName(none[1]), "license-calibration"), lambda passages, others: each * passages + others > allowed)
    if top is not None:
        model.cutoff = max(0.5, math.nextafter(top, 1.0))
    return model


def find_licenses(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """One row per confirmed family of a passage: id, passage (from 0), part (0:
    the whole passage, n: its line n alone), family, probability, overlap."""
    return find_in_passages(measured(docs, model.about, id_col, text_col), model, id_col, min_overlap)


def find_in_passages(lines: DataFrame, model: Model, id_col: str = "doc_id", min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """:func:`find_licenses` of a corpus's :func:`measured` passages."""
    out = [F.col("id").alias(id_col), F.col("passage").cast("long").alias("passage"), F.col("part").cast("long").alias("part")]
    if model.lr is None:
        return lines.where(F.lit(False)).select(*out, F.lit("").alias("family"), F.lit(0.0).alias("probability"), F.lit(0.0).alias("overlap"))
    named = model.named(lines).where(F.col("notice") >= model.cutoff)
    checked = model.confirmed(named, min_overlap).where(F.size("found") > 0)
    # The notices of one passage, each once: few rows, with partial aggregation.
    per = checked.groupBy("id", "text_key", "passage").agg(F.collect_set(F.struct("part", "found")).alias("all"))
    whole = F.filter("all", lambda x: x["part"] == 0)
    kept = per.select("id", "passage", F.explode(F.when(F.size(whole) > 0, whole).otherwise(F.col("all"))).alias("x"))
    return kept.select("id", "passage", "x.part", F.explode("x.found").alias("f")).select(*out, "f.family", "f.probability", "f.overlap")


def summarize(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id, number of notices, families, best probability."""
    per_id = found.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"), F.max("probability").alias("best")).withColumnRenamed(id_col, "_id")
    return (
        docs.select(id_col).join(per_id, F.col(id_col).eqNullSafe(F.col("_id")), "left")
        .select(id_col, F.coalesce("n", F.lit(0)).cast("long").alias("n_notices"), F.coalesce("families", F.lit("")).alias("families"), F.round(F.coalesce("best", F.lit(0.0)), 6).alias("probability"))
    )

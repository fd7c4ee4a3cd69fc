"""License scans by a trained paragraph classifier, in DataFrame operations and Spark's own models only.

- Training data: the reference sentences of each family (`TEMPLATES`), each in the forms that its sentences, pairs of
  neighbouring sentences and usual frames give, and as class "unknown" the sentences of `OTHERS` and at most `UNKNOWNS`
  paragraphs of the documents (the least by a hash) that share no two-word phrase with a template.
- Model: multinomial logistic regression over hashed word 1- and 2-grams (`BUCKETS`, presence only). A fifth of the
  rows is kept from training; on those, the temperature (of `TEMPERATURES`) with the least log loss calibrates the
  probabilities, the one of "unknown" included.
- A paragraph (line) whose most probable class is a family with a calibrated probability of at least `SURE` is
  predicted; the prediction is confirmed if the paragraph holds at least `OVERLAP` of the two-word phrases of one of the
  family's templates. Confirmed paragraphs are returned. A paragraph with none of the words of `_needed` cannot be
  confirmed by any template, so it is set aside before it is scored; this changes no row of the result.

Null and empty texts have no paragraphs. Repeated rows are scanned each. Empty tables give no rows.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 1 << 13
UNKNOWNS = 2000
#: Partitions of the training rows, whose number is bounded: each step of the fit is a pass over them.
PARTS = 2
SURE = 0.5
OVERLAP = 0.6
TEMPERATURES = (0.25, 0.5, 1.0, 2.0, 4.0)
UNKNOWN = "unknown"
# Short reference sentences of license families.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS.",
    ),
    "bsd": (
        "Licensed under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
}
FRAMES = ("{0}", "Note: {0}", "License: {0}", "Copyright 2020 the authors. {0}", "{0} All rights reserved.", "* {0}", "{0} See the LICENSE file.")
OTHERS = (
    "The driver showed his license to the officer.", "A fishing license is required in this state.", "The software is sold under a commercial agreement.",
    "All rights reserved.", "The general public was invited to the opening.", "This work is the result of many years.", "The license plate was missing.",
    "He was released under the condition that he return.", "The version of the story that she told was different.", "Copyright law protects authors.",
    "Free of charge for all visitors on Sunday.", "The foundation published a report on free software.", "Apache helicopters were seen over the city.",
    "Students at MIT released a new study.", "Permission to land was granted by the tower.", "The terms of the contract are not public.",
)


def tokens(text: Column) -> Column:
    """Lower-cased words (letters and digits; version numbers stay whole)."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}.]+|\.(?!\d)"), lambda w: w != "")


def pairs(words: Column) -> Column:
    """The two-word phrases of a list of words."""
    n = F.size(words)
    return F.when(n > 1, F.zip_with(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), F.slice(words, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))).otherwise(
        F.array().cast("array<string>")
    )


def _features(paragraphs: DataFrame) -> DataFrame:
    rows = paragraphs.withColumn("words", tokens(F.col("paragraph")))
    rows = rows.withColumn("phrases", pairs(F.col("words"))).withColumn("grams", F.concat("words", "phrases"))
    return HashingTF(numFeatures=BUCKETS, binary=True, inputCol="grams", outputCol="features").transform(rows)


def _needed() -> str:
    """A pattern of words, one of which a paragraph must hold to have `OVERLAP` of the phrases of any template."""
    chosen: set[str] = set()
    for sentences in TEMPLATES.values():
        for sentence in sentences:
            phrases = [p.split() for p in _phrase_set(sentence)]
            for word in sorted({w for p in phrases for w in p}, key=lambda w: (-len(w), w)):
                free = sum(chosen.isdisjoint(p) for p in phrases)
                if free < OVERLAP * len(phrases):
                    break
                chosen.add(word)
    return "|".join(re.escape(w) for w in sorted(chosen))


def _phrase_set(sentence: str) -> list[str]:
    words = [w for w in re.split(r"[^\w.]+|\.(?!\d)", sentence.lower()) if w]
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def _training(spark: SparkSession, paragraphs: DataFrame) -> DataFrame:
    rows = []
    for label, sentences in TEMPLATES.items():
        forms = [*sentences, *(f"{a} {b}" for a, b in zip(sentences, sentences[1:], strict=False)), " ".join(sentences)]
        rows += [(label, frame.format(form)) for form in forms for frame in FRAMES]
    rows += [(UNKNOWN, frame.format(form)) for form in OTHERS for frame in FRAMES]
    known = F.array(*[F.lit(p) for p in sorted({p for s in TEMPLATES.values() for t in s for p in _phrase_set(t)})])
    plain = paragraphs.select("paragraph").orderBy(F.xxhash64("paragraph"), "paragraph").limit(UNKNOWNS)
    plain = plain.filter(~F.arrays_overlap(pairs(tokens(F.col("paragraph"))), known))
    return spark.createDataFrame(rows, "label string, paragraph string").unionByName(plain.select(F.lit(UNKNOWN).alias("label"), "paragraph"))


def _paragraphs(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    lines = F.split(F.col(text_column).cast("string"), r"\r\n|\r|\n")
    rows = docs.select(F.col(id_column).alias("id"), F.posexplode(lines).alias("place", "paragraph"))
    return rows.filter(F.trim("paragraph") != "")


def license_paragraphs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, place, paragraph, family, probability, similarity) of the confirmed paragraphs."""
    spark = docs.sparkSession
    paragraphs = _paragraphs(docs, id_column, text_column)
    names = [UNKNOWN, *TEMPLATES]
    index = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("label")).cast("double") - 1
    sample = _features(_training(spark, paragraphs)).withColumn("y", index)
    sample = sample.withColumn("kept", F.pmod(F.xxhash64("paragraph"), F.lit(5)) == 0).select("y", "features", "kept").coalesce(PARTS).cache()
    learner = LogisticRegression(featuresCol="features", labelCol="y", family="multinomial", regParam=1e-4, maxIter=60, standardization=False)
    # Every class is in the training part, so that the model has all of them.
    model = learner.fit(sample.filter(~F.col("kept")))
    temperature = _temperature(model.transform(sample.filter("kept")))
    sample.unpersist()
    near = paragraphs.filter(F.lower("paragraph").rlike(_needed()))
    # The generator keeps the model's score from being computed once for each expression that uses it.
    found = model.transform(_features(near)).select("id", "place", "paragraph", "phrases", F.explode(F.array(vector_to_array("rawPrediction"))).alias("raw"))
    best = F.array_max("raw")
    found = found.withColumn("probability", F.element_at(F.array_sort(_calibrated(F.col("raw"), temperature)), -1))
    found = found.withColumn("family", F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position("raw", best).cast("int")))
    found = found.filter((F.col("family") != UNKNOWN) & (F.col("probability") >= SURE))
    found = found.withColumn("similarity", _similarity(F.col("family"), F.col("phrases"))).filter(F.col("similarity") >= OVERLAP)
    return found.select("id", "place", "paragraph", "family", "probability", "similarity")


def _calibrated(raw: Column, temperature: float) -> Column:
    scaled = F.transform(raw, lambda x: x / temperature)
    powers = F.transform(scaled, lambda x: F.exp(x - F.array_max(scaled)))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def _temperature(kept: DataFrame) -> float:
    """The temperature with the least log loss on rows the model was not trained on."""
    losses = [
        F.avg(-F.log(F.greatest(F.element_at(_calibrated(F.col("raw"), t), F.col("y").cast("int") + 1), F.lit(1e-12)))) for t in TEMPERATURES
    ]
    row = kept.select("y", F.explode(F.array(vector_to_array("rawPrediction"))).alias("raw")).agg(*losses).first()
    return min(zip(row, TEMPERATURES, strict=True), key=lambda x: (x[0] is None, x[0]))[1]


def _similarity(family: Column, phrases: Column) -> Column:
    """The greatest share of the phrases of one of the family's templates that a paragraph holds."""

    def share(sentence: str) -> Column:
        own = _phrase_set(sentence)
        return F.size(F.array_intersect(F.array(*[F.lit(p) for p in own]), phrases)) / F.lit(float(len(own)))

    out = F.lit(0.0)
    for name, sentences in TEMPLATES.items():
        out = F.when(family == name, reduce(F.greatest, [share(s) for s in sentences])).otherwise(out)
    return out


def license_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_licenses, families, probability) of the documents with a confirmed paragraph."""
    found = license_paragraphs(docs, id_column, text_column)
    return found.groupBy("id").agg(
        F.count("*").alias("n_licenses"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"), F.max("probability").alias("probability")
    )

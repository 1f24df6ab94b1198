"""License scans: text against licence templates by the Dice coefficient over word bigrams."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ascii_lower

# Wording of public licences and of the notices by which files name them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
    (
        "BSD-3-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.""",
    ),
    (
        "BSD-2-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution.""",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
later version.""",
    ),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
)

NOT_WORD = r"[^\p{L}\p{N}\n]+"


def _bigrams(words):
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b)))


def _words(text):
    return F.split(F.btrim(text, F.lit(" \n")), r"[ \n]+")


def _once(df, name, value, *keep):
    """Add a column that later filters can't pull apart and compute again."""
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def _normal(text):
    return F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, " ")


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(template, license, bigrams) of the given wordings, built from a constant."""
    rows = json.dumps([{"template": i, "license": k, "text": t} for i, (k, t) in enumerate(templates)])
    listed = F.from_json(F.lit(rows), "array<struct<template:int,license:string,text:string>>")
    words = spark.range(1).select(F.inline(listed)).select("template", "license", _words(_normal(F.col("text"))).alias("words"))
    return words.select("template", "license", _bigrams(F.col("words")).alias("bigrams"))


def license_matches(docs: DataFrame, templates=TEMPLATES, threshold: float = 0.8, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document and licence whose wording it holds: (id, license, dice, n_segments).

    Segments of a document are its lines, its paragraphs (between blank lines) and its whole text;
    each is compared with every template that the size bound lets through. With Dice >= t a segment
    of ``a`` distinct bigrams and a template of ``b`` need ``t/(2-t) * b <= a <= (2-t)/t * b``, so
    segments outside all bounds are dropped before their bigrams are exploded. ``dice`` is the best
    of the licence's templates and segments, ``n_segments`` the number of distinct places.

    Null or empty texts and segments of fewer than two words match nothing. Rows of one id are one
    document: repeated rows count once, different texts each add their segments. Rows without an id are a
    document for each distinct text (case, signs and spaces aside). Other columns of ``docs`` are ignored. No templates or no rows give no rows.
    """
    spark = docs.sparkSession
    # A little wider than the bounds, so that rounding drops no segment of exactly the threshold.
    low, high = threshold / (2 - threshold) * (1 - 1e-9), (2 - threshold) / threshold * (1 + 1e-9)
    table = template_table(spark, templates)
    # A few constants: the list is a parameter of the call, far below any broadcast limit.
    sizes = [r.n for r in table.select(F.size("bigrams").alias("n")).distinct().collect()] or [0]
    least, most = min(sizes) * low, max(sizes) * high
    words_in_template = (
        table.withColumn("b", F.size("bigrams")).select("template", "license", "b", F.explode("bigrams").alias("bigram"))
    )
    text = _once(docs, "_text", _normal(F.col(text_col)), F.col(id_col).alias("_id"))
    # Two hashes stand for a text, so that texts of one id are not counted together.
    text = text.withColumn("_key", F.struct(F.xxhash64("_text").alias("a"), F.xxhash64(F.lit(1), F.col("_text")).alias("b")))
    none = F.array().cast("array<struct<at:string,s:string>>")
    numbered = lambda kind: lambda s, i: F.struct(F.concat(F.lit(kind), i.cast("string")).alias("at"), s.alias("s"))
    pieces = F.concat(
        F.transform(F.split("_text", r"\n"), numbered("l")),
        F.when(F.col("_text").rlike(r"\n *\n"), F.transform(F.split("_text", r"\n *\n[ \n]*"), numbered("p"))).otherwise(none),
        F.when(F.contains("_text", F.lit("\n")), F.array(F.struct(F.lit("w").alias("at"), F.col("_text").alias("s")))).otherwise(none),
    )
    longest = max((max(map(len, t.split())) for _, t in templates), default=0)
    # Every word is at least one character long: a shorter segment can't reach the bound, whatever it says.
    segments = text.select("_id", "_key", F.inline(pieces)).where(F.length("s") >= 2 * least + 1)
    segments = _once(segments, "words", _words(F.col("s")), "_id", "_key", "at").where(F.size("words") - 1 >= least)
    segments = _once(segments, "bigrams", _bigrams(F.col("words")), "_id", "_key", "at").where(F.size("bigrams").between(least, most))
    segments = segments.select("_id", "_key", "at", F.size("bigrams").alias("a"), F.explode("bigrams").alias("bigram")).where(F.length("bigram") <= 2 * longest + 1)
    shared = (
        segments.join(F.broadcast(words_in_template), "bigram")
        .where((F.col("a") >= F.col("b") * low) & (F.col("a") <= F.col("b") * high))
        .groupBy("_id", "_key", "at", "a", "template", "license", "b")
        # Distinct, since repeated rows bring every bigram again.
        .agg(F.count_distinct("bigram").alias("both"))
        .withColumn("dice", 2.0 * F.col("both") / (F.col("a") + F.col("b")))
        .where(F.col("dice") >= threshold)
    )
    return (
        shared.groupBy("_id", "_key", "at")
        .agg(F.min(F.struct((-F.col("dice")).alias("less"), "license")).alias("best"))
        .select("_id", F.when(F.col("_id").isNull(), F.col("_key")).alias("_nameless"), "best.license", (-F.col("best.less")).alias("dice"))
        .groupBy(F.col("_id").alias(id_col), "_nameless", "license")
        .agg(F.max("dice").alias("dice"), F.count(F.lit(1)).alias("n_segments"))
        .drop("_nameless")
    )

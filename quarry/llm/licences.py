"""Licence scans: a trained paragraph classifier with a calibrated unknown class, in SQL operations.

Logistic models over sparse word 1-, 2- and 3-grams, one for each family and one for any licence at
all, are trained on the driver from the notices below (a fixed, small set: it doesn't depend on the
data, and the bound on its size is the number of n-grams in them) and calibrated on variants held
out from training. A paragraph ends at a blank line or at a line that ends a sentence, so a notice
that is wrapped over lines is one paragraph. Its n-grams join the broadcast weights; each family
with a calibrated probability of THRESHOLD or more is a row. A paragraph that holds a licence by the
model for any, but of no family, is a row of the `unknown` class. A template comparison confirms a
prediction: the share of the 2-grams of one of the family's notices that the paragraph holds.

The models have weights for n-grams of few words only, so most text needs no scoring: `gate` picks
the words without any of which no model can reach its threshold, whatever else a paragraph holds
(the bound is the sum of all other positive weights). Texts, then paragraphs, without such a word
are left out; nothing that the classifier would name is. Paragraphs are read once, written, and
scored once for each distinct one.

All of the main path is DataFrame and SQL functions.

Defined results: null and empty texts, and an empty table, have no paragraphs; a document without a
licence has no row; repeated rows and null ids have their rows each; a very long paragraph is scored
whole, and n-grams count once; equal probabilities are rows of their own; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import spread_join, written

# Notices of licence families, a paragraph or a sentence each.
TEMPLATES = {
    "apache": [
        "licensed under the apache license version 2.0",
        "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2.0",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
        "licensed to the apache software foundation under one or more contributor license agreements",
        "this file is licensed to you under the apache license version 2.0",
        "distributed under the terms of the apache license 2.0",
        "spdx license identifier apache 2.0",
        "license apache 2.0",
        "apache 2.0",
    ],
    "bsd": [
        "licensed under the bsd license",
        "distributed under the terms of the 3 clause bsd license",
        "use of this source code is governed by a bsd style license that can be found in the license file",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
        "spdx license identifier bsd 3 clause",
        "license bsd 2 clause",
    ],
    "cc": [
        "licensed under cc by nc 4.0",
        "licensed under cc by sa 4.0",
        "licensed under cc by 4.0",
        "cc by sa 4.0",
        "cc by 4.0",
        "cc0 1.0 universal public domain dedication",
        "this work is licensed under a creative commons attribution 4.0 international license",
        "this work is licensed under the creative commons attribution sharealike 3.0 unported license",
        "released under the creative commons attribution noncommercial license",
        "to view a copy of this license visit http creativecommons org licenses by 4.0",
        "text is available under the creative commons attribution sharealike license",
    ],
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 2",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
        "you should have received a copy of the gnu general public license along with this program",
        "under the terms of the gnu lesser general public license",
        "redistribute it and or modify it under the terms of the gnu affero general public license",
        "spdx license identifier gpl 3.0 or later",
        "released under the gplv3",
        "licensed under the gpl v2",
        "gplv3",
        "gpl 3.0",
        "gpl v2 or later",
        "license lgpl 2.1",
        "license agpl 3.0 only",
    ],
    "mit": [
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
        "spdx license identifier mit",
        "distributed under the terms of the mit license",
        "license mit",
    ],
    "mpl": [
        "this source code form is subject to the terms of the mozilla public license v 2.0",
        "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2.0",
        "subject to the terms of the mozilla public license version 2.0",
        "licensed under the mozilla public license version 2.0",
        "licensed under mpl 2.0",
        "spdx license identifier mpl 2.0",
    ],
    "proprietary": [
        "copyright all rights reserved",
        "all rights reserved",
        "proprietary and confidential all rights reserved",
        "all rights reserved no reproduction without permission",
        "no part may be reproduced without prior written permission",
        "no part of this publication may be reproduced distributed or transmitted in any form or by any means without the prior written permission of the publisher",
        "unauthorized copying of this file via any medium is strictly prohibited proprietary and confidential",
    ],
}
#: Notices of licences that aren't of these families.
ELSEWHERE = ["licensed under the eclipse public license 2.0", "this program is licensed under the artistic license 2.0", "released under the sleepycat license", "spdx license identifier zlib", "licensed under the terms of the boost software license version 1.0", "released into the public domain under the unlicense", "licensed under the academic free license version 3.0", "distributed under the terms of the python software foundation license", "licensed under the european union public licence", "spdx license identifier isc", "this file is licensed under the upl version 1.0", "this software is licensed under the ruby license", "licensed under the w3c software notice and license"]
OTHERS = [
    "the licence of the driver was taken away", "you need a license to fish here", "a public meeting under the terms of the treaty", "the general public was granted permission to enter", "the permission is hereby withdrawn", "the school is licensed by the state", "version 2.0 of the work is released", "a marriage license", "the rights of the public", "the terms of the contract are under review", "the software is free of charge", "copyright law is a field of study", "the common people and creative work", "a licensed doctor of the clinic",
    "the mit campus is by the river and the software of the lab is free", "a professor of mit wrote the program", "mit students met the visitors", "all rights were reserved for the king", "a public license was granted to the fisherman", "copyright law is hard", "the program is free and so is the software", "cc the manager when you reply", "the license", "a license", "his driving license expired in may", "the license fee for television went up", "license holders must renew each year", "they lost their fishing license at sea", "the license plate of the car", "the gun license was denied", "she studied at mit and later worked in boston", "the mit license plate frame was found", "the apache people lived in the south west", "an apache helicopter flew over the hill", "the gnu is a large antelope of africa", "mozilla is a company that makes a browser", "all rights of way are reserved for walkers", "a table was reserved for all of us", "human rights are for all people", "they released a new version of the program", "the program will be broadcast at eight", "the source of the river is in the hills",
    "the software was written in the same year", "a copy of the book was found in the house", "any person may obtain a copy of the map", "the warranty of the car ended last year", "the names of the authors are not known", "use of the road is permitted in summer", "the file was lost and the distribution stopped", "the following conditions were met in the end", "without limitation there is no art", "no part of the story was true", "the publisher sent a letter without a word", "he was held liable for the damages", "in no event did the team win that year",
    "subject to the weather the game is at two", "the foundation was laid in the spring", "a general of the army and a public servant", "the state issues a license to any person who passes the test", "she had the permission of the owner to use the garden", "the purpose of the visit was not clear", "an action of the court in the matter of the contract", "the work of the committee was done and the report was published", "see the file for more details of the plan", "and the other materials in the box were of no use", "the free market and the general public", "please read the notice at the door", "by the means of a rope", "section 4.0 and section 2.0 of the report", "it is what it is as is the rest",
]
#: Words too common to be a feature by themselves; an n-gram of these alone is none either.
COMMON = frozenset("a about above all along an and any are as at be but by can do even for from has have he her his http i if in into is it its may more no nor not of on one or other out part see shall she should so such than that the their them there they this to under up was we were what which who will with without would www you your 0 1 2 3 4".split())
UNKNOWN, ANY = "unknown", "any"
THRESHOLD, CONFIRM = 0.5, 0.7
#: A paragraph ends at a blank line, or at a line that ends a sentence.
PARAGRAPH_END = r"(?:(?<=[.!?])|\n)[ \t\r]*\n"


def tokens(text: str) -> list[str]:
    """Lower-case runs of ASCII letters and digits."""
    out, word = [], ""
    for c in text.lower() + " ":
        if c.isascii() and c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def grams(words: list[str]) -> list[str]:
    return sorted({" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)})


def features(words: list[str]) -> list[str]:
    return [g for g in grams(words) if not COMMON.issuperset(g.split(" "))]


def _variants(words: list[str], seed: int) -> list[list[str]]:
    """A notice and runs of ten of its words, with a word left out, cut short at either end, and with words around it."""
    at = zlib.crc32(" ".join(words).encode()) + seed
    drop = words[: at % len(words)] + words[at % len(words) + 1 :]
    part = max(3, len(words) * 3 // 4)
    around = ["this", "text", "is", *words, "see", "the", "file", "for", "details"]
    windows = [words[i : i + 10] for i in range(seed, len(words) - 9, 4)] if len(words) > 12 else []
    return [*windows, words, drop if len(words) > 4 else words, words[:part], words[-part:] if len(words) > 8 else words, around]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(steps: int = 500, l1: float = 0.0007) -> tuple[dict[str, dict[str, float]], dict[str, tuple[float, float, float]]]:
    """(weights of n-grams, (bias, slope, offset) of the calibration) by family and for any licence."""
    rows = [(tokens(t), f) for f, ts in TEMPLATES.items() for t in ts] + [(tokens(t), UNKNOWN) for t in ELSEWHERE] + [(tokens(t), "") for t in OTHERS]
    fit = [(features(v), f) for w, f in rows for v in _variants(w, 0)]
    held = [(features(v), f) for w, f in rows for v in _variants(w, 2)]
    names = sorted({g for gs, _ in fit for g in gs})
    at = {g: i for i, g in enumerate(names)}

    def matrix(sets: list[tuple[list[str], str]]) -> np.ndarray:
        x = np.zeros((len(sets), len(names)))
        for i, (gs, _) in enumerate(sets):
            x[i, [at[g] for g in gs if g in at]] = 1
        return x

    x, x_held = matrix(fit), matrix(held)
    rate = 4 / x.sum(axis=1).mean()
    weights, calibration = {}, {}
    for head in [*TEMPLATES, ANY]:
        y, y_held = (np.array([(f != "") if head == ANY else (f == head) for _, f in s], dtype=float) for s in (fit, held))
        share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
        w, bias = np.zeros(len(names)), -2.0
        for _ in range(steps):  # gradient steps; what an n-gram is worth less than l1 is none
            e = (y - _sigmoid(x @ w + bias)) * share
            w = w + rate * (x.T @ e)
            w = np.sign(w) * np.maximum(np.abs(w) - rate * l1, 0)
            bias += 0.2 * e.sum()
        slope, offset = 1.0, 0.0
        s = x_held @ w + bias
        for _ in range(200):  # the calibration, held near that of training
            p = _sigmoid(slope * s + offset)
            slope += 0.05 * (((y_held - p) * s).mean() - 0.01 * (slope - 1))
            offset += 0.5 * ((y_held - p).mean() - 0.01 * offset)
        weights[head] = {names[i]: round(float(w[i]), 6) for i in np.flatnonzero(w)}
        calibration[head] = (round(float(bias), 6), round(float(slope), 6), round(float(offset), 6))
    return weights, calibration


def gate(weights: dict[str, dict[str, float]], calibration: dict[str, tuple[float, float, float]]) -> list[str]:
    """Words of which a paragraph has one if any model can reach its threshold."""
    logit = float(np.log(THRESHOLD / (1 - THRESHOLD)))
    left = {h: {g: w for g, w in ws.items() if w > 0} for h, ws in weights.items()}
    words: list[str] = []
    while True:
        over = {h: bias + sum(left[h].values()) - (logit - offset) / slope for h, (bias, slope, offset) in calibration.items()}
        head = max(over, key=lambda h: (over[h], h))
        if over[head] < -1e-6:
            return sorted(words)
        worth: dict[str, float] = {}
        for g, w in left[head].items():
            for word in set(g.split(" ")) - COMMON:
                worth[word] = worth.get(word, 0.0) + w
        words.append(max(worth, key=lambda x: (worth[x], x)))
        left = {h: {g: w for g, w in gs.items() if words[-1] not in g.split(" ")} for h, gs in left.items()}


_MODEL = None


def model() -> tuple[dict[str, dict[str, float]], dict[str, tuple[float, float, float]], list[str]]:
    global _MODEL
    if _MODEL is None:
        weights, calibration = train()
        _MODEL = weights, calibration, gate(weights, calibration)
    return _MODEL


def gate_pattern(words: list[str]) -> str:
    """Matches lower-case text that holds one of the words as tokens sees them."""
    return f"(?<![a-z0-9])(?:{'|'.join(words)})(?![a-z0-9])"


def _grams(words: Column, n: int) -> Column:
    count = F.greatest(F.size(words) - n + 1, F.lit(0))
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def _entries(spark: SparkSession) -> DataFrame:
    """What an n-gram adds: weights of models (notice -1), and one of the 2-grams (size) of a notice."""
    rows = [(g, h, -1, 1, w) for h, ws in model()[0].items() for g, w in ws.items()]
    notices = [(f, sorted({" ".join(x) for x in zip(tokens(t), tokens(t)[1:], strict=False)})) for f, ts in TEMPLATES.items() for t in ts]
    rows += [(g, f, i, len(two), 1.0) for i, (f, two) in enumerate(notices) for g in two]
    return spark.createDataFrame(rows, "gram string, family string, notice int, size int, w double")


def licence_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per paragraph and family: the id, paragraph (from 0), family or unknown, probability, similarity, confirmed."""
    spark = docs.sparkSession
    _, calibration, words = model()
    pattern = gate_pattern(words)
    some = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).where(F.lower("__text").rlike(pattern))
    found = some.select("__id", F.posexplode(F.split("__text", PARAGRAPH_END)).alias("paragraph", "text")).where(F.lower("text").rlike(pattern))
    found = written(found.withColumns({"h": F.xxhash64("text"), "g": F.xxhash64(F.lit(1), F.col("text"))}), "paragraphs")
    split = F.filter(F.split(F.lower("text"), "[^a-z0-9]+"), lambda x: x != "")
    # n-grams are made where they are looked up, never written or shuffled
    distinct = written(found.groupBy("h", "g").agg(F.first("text").alias("text")), "distinct").select("h", "g", split.alias("ws"))
    grams_of = F.array_distinct(F.concat(_grams(F.col("ws"), 1), _grams(F.col("ws"), 2), _grams(F.col("ws"), 3)))
    hits = distinct.select("h", "g", F.explode(grams_of).alias("gram")).join(F.broadcast(_entries(spark)), "gram")
    sums = hits.groupBy("h", "g", "family", "notice", "size").agg(F.sum(F.col("w").cast("decimal(18,6)")).cast("double").alias("s"))
    own, shared = F.when(F.col("notice") < 0, F.col("s")), F.when(F.col("notice") >= 0, F.col("s") / F.col("size"))
    heads = sums.groupBy("h", "g", "family").agg(F.max(own).alias("s"), F.coalesce(F.max(shared), F.lit(0.0)).alias("similarity"))
    cal = spark.createDataFrame([(f, *c) for f, c in calibration.items()], "family string, bias double, slope double, off double")
    p = 1 / (1 + F.exp(-(F.col("slope") * (F.col("bias") + F.col("s")) + F.col("off"))))
    heads = heads.join(F.broadcast(cal), "family").withColumn("probability", p).where(F.col("probability") >= THRESHOLD)
    heads = heads.groupBy("h", "g").agg(F.collect_list(F.struct("family", "probability", "similarity")).alias("all"))
    named = F.filter("all", lambda x: x["family"] != ANY)
    other = F.transform("all", lambda x: F.struct(F.lit(UNKNOWN).alias("family"), x["probability"].alias("probability"), F.lit(0.0).alias("similarity")))
    verdict = heads.select("h", "g", F.inline(F.when(F.size(named) > 0, named).otherwise(other)))
    return spread_join(found.select("__id", "paragraph", "h", "g"), verdict, ["h", "g"]).select(
        F.col("__id").alias(id_col),
        F.col("paragraph").cast("long").alias("paragraph"),
        "family",
        "probability",
        "similarity",
        (F.col("similarity") >= CONFIRM).alias("confirmed"),
    )

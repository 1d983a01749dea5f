import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import licences as L
from quarry.llm import queries as Q

BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""
CASES = [  # text, family of its only row; none of these is a notice the models were trained on
    ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
    ("Released under the MIT License.", "mit"),
    ("Licensed under CC BY-NC 4.0.", "cc"),
    ("CC BY-SA 4.0", "cc"),
    ("All rights reserved.", "proprietary"),
    ("(c) 2020 Acme Corp. All Rights Reserved", "proprietary"),
    ("Apache-2.0", "apache"),
    ("SPDX-License-Identifier: MIT", "mit"),
    ("The software is provided \"as is\", without warranty of any kind", "mit"),
    ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY\nOF ANY KIND, EXPRESS OR IMPLIED,\nINCLUDING BUT NOT LIMITED TO", "mit"),
    (BSD, "bsd"),
    ("# Redistributions of source code must retain the above copyright\n# notice, this list of conditions and the following disclaimer.", "bsd"),
    ("* This program is free software; you can redistribute it and/or modify\n * it under the terms of the GNU Lesser\n * General Public License as published", "gpl"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.", "apache"),
    ("This Source Code Form is subject to the terms of the\nMozilla Public License, v. 2.0.", "mpl"),
    ("Distributed under the terms of the GNU General\nPublic License", "gpl"),
    ("Licensed under the Sleepycat License", L.UNKNOWN),
]
NONE = ["You need a licence to drive.", "A public meeting of the general was permitted.", "", None, "no such thing", "The software was free and the source was near the hill.", "Human rights are reserved for nobody."]


def plain(text):
    """{(paragraph, family): probability} without a gate."""
    weights, calibration, _ = L.model()
    out = {}
    for i, part in enumerate(re.split(L.PARAGRAPH_END, text or "")):
        gs = L.grams(L.tokens(part))
        p = {h: 1 / (1 + math.exp(-(k * (b + sum(weights[h].get(g, 0) for g in gs)) + o))) for h, (b, k, o) in calibration.items()}
        some = {(i, h): round(x, 6) for h, x in p.items() if h != L.ANY and x >= L.THRESHOLD}
        out |= some or ({(i, L.UNKNOWN): round(p[L.ANY], 6)} if p[L.ANY] >= L.THRESHOLD else {})
    return out


def scan(df):
    out = collections.defaultdict(dict)
    for r in L.licence_paragraphs(df).collect():
        out[r.doc_id][r.paragraph, r.family] = (round(r.probability, 6), r.confirmed)
    return out


@pytest.fixture(scope="module")
def found(spark):
    rows = list(enumerate([t for t, _ in CASES] + NONE))
    return scan(spark.createDataFrame(rows, "doc_id long, text string"))


def test_families(found):
    assert {i: [f for _, f in x] for i, x in found.items()} == {i: [f] for i, (_, f) in enumerate(CASES)}
    confirmed = [next(iter(x.values()))[1] for _, x in sorted(found.items())]
    assert sum(confirmed) >= 12 and not confirmed[-1]


def test_gate_loses_nothing(spark):
    """What the classifier names among all paragraphs is what comes through the gate; random draws of the features included."""
    weights, _, words = L.model()
    rng = random.Random(4)
    texts = [t for t, _ in CASES] + NONE
    for head, ws in weights.items():
        best = sorted(ws, key=lambda g: (-ws[g], g))[:150]
        free = [g for g in ws if ws[g] > 0 and not set(g.split(" ")) & set(words)]
        texts += [" ".join(rng.sample(best, rng.randint(1, 6))) for _ in range(30)] + [" ; ".join(free)]
    got = scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {i: {k: p for k, (p, _) in x.items()} for i, x in got.items()} == {i: x for i, t in enumerate(texts) if (x := plain(t))}


def test_query_like_a_plain_version(spark, tiny):
    want = {r.doc_id: x for r in spark.read.parquet(f"{tiny}/documents.parquet").collect() if (x := plain(r.text))}
    got = collections.defaultdict(dict)
    for r in Q.op9(spark, tiny).collect():
        got[r.doc_id][r.paragraph, r.family] = round(r.probability, 6)
    assert got == want and want
    marked = spark.read.parquet(f"{tiny}/documents.parquet").where(F.col("text").rlike("All rights reserved|MIT License|GNU General Public|Apache License|CC BY")).count()
    assert len(want) >= marked > 0


def test_odd_rows(spark, odd):
    rows = [(1, None, 1, "x"), (2, "", 1, "x"), (3, "Released under the MIT License.", 2, "y"), (3, "Released under the MIT License.", 2, "y"), (None, "All rights reserved.\n\nReleased under the MIT License.", 3, "z"), (7, "word " * 200_000 + "released under the MIT License", 3, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, paragraph long, family string")
    got = collections.Counter((r.doc_id, r.paragraph, r.family) for r in L.licence_paragraphs(df).collect())
    assert got == {(3, 0, "mit"): 2, (None, 0, "proprietary"): 1, (None, 1, "mit"): 1, (7, 0, "mit"): 1}
    assert L.licence_paragraphs(odd).count() == 0 and L.licence_paragraphs(odd.limit(0)).count() == 0

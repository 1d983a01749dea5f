import collections
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from quarry.llm import queries as Q
from quarry.llm import quality_crf
from tests.llm.test_media_and_packing import check_packing, plain_ids
from tests.llm.test_text_operators import UP, classes_by_force, hits_by_force, pairs

SPACE = "[\x20\x09-\x0d]"


def test_pipeline_like_plain_steps(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    model = Q.quality_model(spark, docs, tiny)
    scores = {r.doc_id: r["__score"] for r in quality_crf.score(docs, model).collect()}
    rows = sorted((d, t) for d, t in pairs(docs) if scores[d] >= 0.3)
    assert 0.5 < len(rows) / docs.count() < 1
    key = lambda x: re.sub(f"^{SPACE}+|{SPACE}+$", "", x).translate(UP)
    first = {}
    for d, t in rows:
        for x in t.split("\n"):
            first.setdefault(key(x), d)
    held = collections.Counter(k for d, t in rows for k in {key(x) for x in t.split("\n")})
    rows = [(d, "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or held[key(x)] < 2 or first[key(x)] == d)) for d, t in rows]
    stay = {c for _, c, _ in classes_by_force(rows)}
    rows = [(d, t) for d, t in rows if d in stay]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]
    hit = hits_by_force(rows, items, 10)
    dirty = {k[0]: k for k in hit if k[2]}
    out = P.run(spark, tiny).collect()
    got = collections.defaultdict(list)
    for r in out:
        got[r.doc_id].append(r)
    gone = {d for d, k in dirty.items() if 2 * k[2] >= k[1]}
    assert dirty and set(got) == {d for d, _ in rows} - gone
    for d, t in rows:
        if d not in dirty:
            raw = np.array(plain_ids(t), dtype="<u4")
            assert sorted(r.ids_crc32 for r in got[d]) == sorted(zlib.crc32(raw[a : a + 4096].tobytes()) for a in range(0, len(raw), 4096))
        elif d not in gone:
            assert got[d][0].doc_tokens < len(plain_ids(t))
    assert sum(r.length for r in out) == sum(rs[0].doc_tokens for rs in got.values())


def test_stages_keep_columns_and_odd_rows(spark, tiny, odd):
    d = odd.withColumn("n_chars", F.length("text").cast("long")).withColumn("lang", F.lit(None).cast("string"))
    for name, stage in P.STAGES:
        out = stage(spark, d, tiny)
        if name != "pack":
            assert out.columns == d.columns, name
            assert stage(spark, d.limit(0), tiny).count() == 0
            assert out.where("text is not null and n_chars <> length(text)").count() == 0
        if name == "near_dedup":
            assert out.where("doc_id = 3").count() == 1 and out.where("doc_id is null").count() == 2
    assert check_packing(pairs(d), P.packed(spark, d, tiny).collect()) > 0

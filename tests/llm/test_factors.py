import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import substring_dedup as S
from tests.llm.test_text_operators import pairs, repeats_by_force


def test_factors_point_to_equal_words(spark, docs):
    """Each factor's words stand in its source too, factors don't overlap, and together they are what is removed."""
    rng = random.Random(11)
    pool = [" ".join(rng.choice("abcdefg") + rng.choice("xyz") for _ in range(rng.randint(5, 90))) for _ in range(20)]
    made = spark.createDataFrame([(5000 + i, " ".join(rng.choice(pool) for _ in range(rng.randint(1, 6)))) for i in range(60)], "doc_id long, text string")
    df = docs.select("doc_id", "text").unionByName(made)
    texts = {r.t: re.findall("[^\x20\x09-\x0d]+", r.text or "") for r in df.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"), "text").collect()}
    whole = dict(pairs(df))
    out = S.remove_repeats(df, window=20, anchor=5).collect()
    assert any(len(r.factors) > 1 for r in out)
    for r in out:
        words = re.findall("[^\x20\x09-\x0d]+", whole[r.doc_id] or "")
        end = 0
        for f in r.factors:
            assert f.start >= end and f.length > 0
            assert words[f.start : f.start + f.length] == texts[f.source][f.source_start : f.source_start + f.length]
            end = f.start + f.length
        assert r.n_removed == sum(f.length for f in r.factors)


def test_places_beyond_a_part(monkeypatch):
    """Places of anchors don't depend on the parts in which they are worked out."""
    grams = np.random.default_rng(3).integers(0, 2**63, 5000).astype(np.uint64)
    want = np.array([i + int((grams[i : i + 28] & ~S._PLACE).argmin()) for i in range(len(grams) - 27)])
    for part in (1 << 21, 700, 31):
        monkeypatch.setattr(S, "_PART", part)
        assert (S._leftmost_least(grams, 28) == want).all()


@pytest.mark.parametrize("n", [4_300_000])
def test_repeats_in_a_very_long_text(spark, n):
    """A passage of 60 words after the first 4.2 million words of a text, and in a short text."""
    passage = " ".join(f"p{i}" for i in range(60))
    words = np.char.mod("%x", np.arange(n)).tolist()
    rows = [(1, " ".join(words) + " " + passage + " end"), (2, f"so {passage} it")]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_words", "n_removed").collect()}
    assert got == {1: (n + 61, 60), 2: (62, 60)}


def test_last_join_spreads_copies(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(80))) for i in range(50)] + [(99, "other words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = S.remove_repeats(df)
    assert sorted((r.doc_id, r.n_removed) for r in out.collect()) == sorted((d, k[2]) for k in repeats_by_force(rows, 35) for d in [k[0]])

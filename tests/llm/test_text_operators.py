import collections
import functools
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import decontaminate as D
from quarry.llm import language_id as G
from quarry.llm import line_dedup, near_dedup
from quarry.llm import queries as Q
from quarry.llm import quality_crf as C
from quarry.llm import shared
from quarry.llm import substring_dedup as S

SPACE = "[\x20\x09-\x0d]"
UP = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def by_row(df, *cols):
    return collections.Counter(tuple(r[c] for c in cols) for r in df.collect())


def test_hashes_depend_on_words_alone():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    data[rng.integers(0, 5000, 900)] = 32
    a, b, first = shared.word_bounds(data, np.array([0, 1000, 1000, 5000]), S.WORD)
    raw = data.tobytes()
    words = [raw[i:j] for i, j in zip(a, b)]
    assert words == [w for part in (raw[:1000], raw[1000:]) for w in part.split()]
    assert list(first) == [0, len(raw[:1000].split())] * 1 + [len(raw[:1000].split()), len(words)]
    seen = {}
    for w, h in zip(words, shared.span_hashes(data, a, b).tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    grams = {}
    for i, h in enumerate(shared.rolling(shared.span_hashes(data, a, b), 3).tolist()):
        assert grams.setdefault(tuple(words[i : i + 3]), h) == h
    assert len(set(grams.values())) == len(grams)


# Op 1


def repeats_by_force(rows, window):
    texts = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t in rows]
    seen = collections.Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, texts):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return collections.Counter(out)


@pytest.mark.parametrize(("window", "anchor"), [(35, 8), (9, 3)])
def test_substring_dedup(spark, docs, odd, window, anchor):
    rng = random.Random(window)
    pool = [" ".join(rng.choice("abcdefg") + rng.choice("xyz") for _ in range(rng.randint(5, 60))) for _ in range(30)]
    made = spark.createDataFrame([(1000 + i, rng.choice([" ", "\n", "\t "]).join(rng.choice(pool) for _ in range(rng.randint(1, 4)))) for i in range(80)], "doc_id long, text string")
    df = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(made)
    got = by_row(S.remove_repeats(df, window=window, anchor=anchor), "doc_id", "n_words", "n_removed", "kept")
    assert got == repeats_by_force(pairs(df), window)


def test_substring_dedup_of_nothing(odd):
    assert S.remove_repeats(odd.limit(0)).count() == 0


# Op 5


def test_line_dedup(docs, odd):
    df = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = pairs(df)
    key = lambda x: re.sub(f"^{SPACE}+|{SPACE}+$", "", x).translate(UP)
    held = collections.defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if d is not None and len(key(x)) >= 10:
                held[key(x)].add(d)
    want = collections.Counter()
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(held[key(x)]) < 2 or min(held[key(x)]) == d]
        want[d, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    assert by_row(line_dedup.drop_repeated_lines(df), "doc_id", "n_lines", "n_dropped", "kept") == want
    assert line_dedup.drop_repeated_lines(odd.limit(0)).count() == 0
    carried = line_dedup.drop_repeated_lines(odd, keep=["kept", "__text", "n_words"])
    assert carried.select("row.*").columns == ["kept", "__text", "n_words"]
    assert by_row(carried.select("doc_id", "row.__text"), "doc_id", "__text") == by_row(odd.select("doc_id", "__text"), "doc_id", "__text")


def test_line_dedup_is_linear(spark):
    """A text that loses hundreds of thousands of lines."""
    import time

    lines = [f"a line with the number {i}" for i in range(300_000)]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(lines[:100]) + "\nhere it differs\n" + "\n".join(lines[100:]))], "doc_id long, text string")
    start = time.time()
    got = {r.doc_id: (r.n_dropped, r.n) for r in line_dedup.drop_repeated_lines(df).select("doc_id", "n_dropped", F.length("kept").alias("n")).collect()}
    assert got == {1: (0, len("\n".join(lines))), 2: (300_000, len("here it differs"))} and time.time() - start < 60


# Op 10


def hits_by_force(rows, items, width):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(UP))
    grams = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            grams[tuple(w[k : k + width])].add(i)
    sizes = {len(g) for g in grams}
    out = collections.Counter()
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (g := grams.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= g
        out[d, len(w), len(hit), ",".join(sorted(str(i) for i in found if i is not None))] += 1
    return out


@pytest.mark.parametrize("most", [D.MAX_WINDOWS, 900])
def test_decontamination(spark, docs, odd, most):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    bench = bench.unionByName(spark.createDataFrame([(901, "solo"), (902, None), (903, "!?"), (None, "a b c"), (905, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14")], bench.schema))
    df = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text").distinct())
    out = D.find_contamination(df, bench, max_windows=most).withColumn("hit", D.count_hits(F.col("hit_starts"), F.col("hit_ends"))).withColumn("list", F.array_join("items", ","))
    want = hits_by_force(pairs(df), [(r.item_id, r.text) for r in bench.collect()], 10)
    assert by_row(out, "doc_id", "n_words", "hit", "list") == want
    clean = D.decontaminate(df, bench, drop_share=2.0, max_windows=most)
    left = hits_by_force(pairs(clean), [(r.item_id, r.text) for r in bench.collect()], 10)
    assert clean.columns == df.columns and sum(k[2] for k in left) == 0 and clean.count() == df.count()
    assert D.find_contamination(df, bench.limit(0)).agg(F.sum(F.size("items"))).first()[0] == 0
    assert D.find_contamination(odd.limit(0), bench).count() == 0


# Op 3


def shingles_by_force(t):
    w = (t or "").translate(UP)
    w = re.findall("[^\x20\x09-\x0d]+", w)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


def classes_by_force(rows):
    sets = [shingles_by_force(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if (rows[i][1] or "") == (rows[j][1] or "") or (a and b and 5 * len(a & b) >= 4 * len(a | b)):
                root[find(i)] = find(j)
    members = collections.defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    return collections.Counter((d, min((m for m in ms if m is not None), default=None), len(ms)) for ms in members.values() for d in ms)


@pytest.mark.parametrize("block", [256, 8])
def test_near_duplicates(spark, docs, odd, block):
    rng = random.Random(3)
    base = [rng.choice(["ab", "cd", "ef", "gh"]) + str(rng.randint(0, 99)) for _ in range(200)]
    near = []
    for i in range(25):
        w = list(base)
        for k in rng.sample(range(200), rng.choice([0, 1, 2, 3])):
            w[k] = f"new{i}"
        near.append((2000 + i, " ".join(w)))
    df = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(spark.createDataFrame(near, "doc_id long, text string"))
    out = near_dedup.near_duplicate_classes(df, block=block)
    want = classes_by_force(pairs(df))
    assert by_row(out, "doc_id", "class_id", "class_size") == want


def test_near_duplicates_of_nothing(odd):
    assert near_dedup.near_duplicate_classes(odd.limit(0)).count() == 0


def test_prob_minhash_estimates_the_weighted_similarity():
    rng = np.random.default_rng(2)
    h = rng.integers(1, 2**63, 60).astype(np.uint64)
    wa, wb = rng.integers(0, 4, 60), rng.integers(0, 4, 60)
    true = sum(1 / sum(max(wa[d] / wa[e], wb[d] / wb[e]) for d in range(60)) for e in range(60) if wa[e] and wb[e])
    at = lambda w: np.flatnonzero(w)
    doc = np.concatenate([np.zeros(len(at(wa)), int), np.ones(len(at(wb)), int)])
    sig = near_dedup.prob_minhash(doc, np.concatenate([h[at(wa)], h[at(wb)]]), np.concatenate([wa[at(wa)], wb[at(wb)]]), 2, 20000)
    assert abs((sig[0] == sig[1]).mean() - true) < 0.02


def test_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(205, 200), (207, 205), (207, 201)]
    got = {r.a: r.b for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)} | {201: 200, 205: 200, 207: 200}


# Op 8


def test_language_id_held_out(spark):
    d = "/root/testdata/sf0.01"
    out = Q.op8(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.98
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in Q.op8(spark, d).collect())


def test_language_id_odd(spark, odd):
    m = G.fit(spark.createDataFrame([("x y z", "b"), ("q q q", "a"), (None, "c"), ("t", None)], "text string, lang string"))
    assert [x.langs for x in m] == [["a", "b"]]
    got = {r.doc_id: (r.lang_pred, r.score) for r in G.predict(odd, m).collect()}
    assert got[1] == got[2] == got[8] == ("und", 0.0) and got[9][0] in ("a", "b") and 0 <= got[3][1] <= 1
    assert G.predict(odd, G.fit(odd.select("text", F.lit(None).cast("string").alias("lang")))).where("lang_pred <> 'und'").count() == 0
    assert G.predict(odd.limit(0), m).count() == 0
    only = G.predict(spark.createDataFrame([(1, "12 ,."), (2, "ñ")], "doc_id int, text string"), m).orderBy("doc_id").collect()
    assert only[0].lang_pred == "und" and only[1].lang_pred != "und"


@pytest.mark.parametrize(("block", "cells"), [(512, 1 << 22), (2, 40)])
def test_language_id_like_a_plain_version(spark, docs, odd, monkeypatch, block, cells):
    """Counts in dictionaries and one text after the other; in blocks of languages too."""
    import math

    monkeypatch.setattr(G, "MAX_LANGUAGES", block)
    monkeypatch.setattr(G, "CELLS", cells)
    rows = [(t, la) for _, t, la in docs.where("length(text) < 1500").select("doc_id", "text", "lang").limit(40).collect()]
    rows += [("Über äÄ ßÿ Ωμέγα ПРИВЕТ мир", "x1"), ("İstanbul 𝔘𝔫", "x2"), ("", "x2"), (None, "x3"), ("abc", None)]
    hashed = lambda g, k: ((functools.reduce(lambda a, c: (a * 16777619 & 0xFFFFFFFF) ^ c, [ord(x) for x in g[1:]], ord(g[0])) + k - 1) * 2654435761 & 0xFFFFFFFF) >> 17
    low = lambda t: "".join(c.lower() if len(c.lower()) == 1 and ord(c) < 65536 else c for c in t)

    def grams(t):
        small = low(t)
        return [hashed(small[i : i + k], k) for k in (2, 3, 4) for i in range(len(t) - k + 1)]

    counts, number = collections.defaultdict(collections.Counter), collections.Counter()
    for t, la in rows:
        if t is not None and la is not None:
            counts[la].update(grams(t))
            number[la] += 1
    langs = sorted(number)
    size = {la: sum(counts[la].values()) + 0.5 * G.BUCKETS for la in langs}
    want = []
    texts = pairs(docs.where("length(text) < 1500").select("doc_id", "text").limit(25)) + [(d, (t or "")[:900] or t) for d, t in pairs(odd)]
    for d, t in texts:
        gs = grams(t or "")
        logs = [math.log(number[la] / sum(number.values())) + sum(math.log((counts[la][g] + 0.5) / size[la]) for g in gs) for la in langs]
        best = max(range(len(langs)), key=lambda i: (logs[i], -i))
        some = any(c.isalpha() for c in t or "")
        want.append((d, langs[best] if some else "und", round(1 / sum(math.exp(x - logs[best]) for x in logs), 2) if some else 0.0))
    models = G.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert len(models) == -(-len(langs) // block)
    out = G.predict(spark.createDataFrame(texts, "doc_id long, text string"), models).collect()
    assert collections.Counter((r.doc_id, r.lang_pred, round(r.score, 2)) for r in out) == collections.Counter(want)


# Op 2


def chain_by_hand(model, x, size):
    """Score of one text from the features of its lines: forward and backward sums, line by line."""
    import math

    x = (x - model.mean) / model.scale
    n = len(x)
    zero = np.zeros(x.shape[1])
    logit = []
    for i in range(n):
        full = [*x[i], *(x[i - 1] if i else zero), *(x[i + 1] if i + 1 < n else zero), float(i == 0), float(i == n - 1), 1.0]
        logit.append(sum(a * b for a, b in zip(full, model.weights.tolist(), strict=True)))
    both = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b)))
    t = model.trans.tolist()
    fore, back = [(0.0, logit[0])], [(0.0, 0.0)]
    for i in range(1, n):
        fore.append(tuple(both(fore[-1][0] + t[0][k], fore[-1][1] + t[1][k]) + k * logit[i] for k in (0, 1)))
        nxt = [back[-1][k] + k * logit[n - i] for k in (0, 1)]
        back.append(tuple(both(t[k][0] + nxt[0], t[k][1] + nxt[1]) for k in (0, 1)))
    back.reverse()
    p = [1 / (1 + math.exp(min(700, f[0] + b[0] - f[1] - b[1]))) for f, b in zip(fore, back)]
    mean = sum(a * b for a, b in zip(p, size.tolist())) / sum(size)
    mean = min(max(mean, 1e-4), 1 - 1e-4)
    a, b = model.calibration
    return 1 / (1 + math.exp(-(a * math.log(mean / (1 - mean)) + b)))


def test_quality_like_a_plain_version(spark, tiny, odd):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    model = Q.quality_model(spark, docs, tiny)
    got = {r.doc_id: r for r in Q.op2(spark, tiny).collect()}
    for d, t in pairs(docs):
        raw = np.frombuffer((t or "").encode(), dtype=np.uint8)
        x, size, first = C.line_features(raw, np.array([0, len(raw)]))
        lines = (t or "").encode().split(b"\n")
        assert list(first) == [0, len(lines)] and (size == [len(y) + 1 for y in lines]).all()
        for row, y in zip(x, lines):
            words = y.split()
            assert np.allclose(row[:7] * max(1, len(y)), [len(re.findall(p, y)) for p in (rb"[A-Z]", rb"[a-z]", rb"[0-9]", rb"[!?]", rb"[#-&*+/<-> @\[-`{-~]".replace(b" ", b""), rb"[\x80-\xff]", rb"[,.]")])
            assert np.isclose(row[9], np.log1p(len(y)) / 5) and np.isclose(row[10], np.log1p(max(1, len(words))) / 3)
        assert abs(got[d].score - chain_by_hand(model, x, size)) < 1e-6
        assert got[d].held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and got[d].predicted == int(got[d].score >= 0.3)


def test_quality_bounds_what_is_learned(spark):
    rows = [(i, ("good line of text here\n" if i % 2 else "!!! $$$\n") * 20) for i in range(40)] + [(99, "!!! $$$\n" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(99, 1)], "doc_id long, quality int")
    m = C.fit(df, labels)
    assert {r.doc_id: r.s > 0.5 for r in C.score(df, m, name="s").collect()} == {i: i % 2 == 1 for i in [*range(40)]} | {99: False}
    clash = df.withColumn("__score", F.lit("x")).withColumn("Score", F.lit(1))
    assert C.score(clash, m, name="made").columns == ["doc_id", "text", "__score", "Score", "made"]


def test_quality_held_out(spark):
    d = "/root/testdata/sf0.01"
    lab = spark.read.parquet(f"{d}/labels.parquet")
    out = Q.op2(spark, d).join(lab, "doc_id").where("held_out")
    assert out.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0] > 0.95
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in out.collect())


def test_chain_marginals_like_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    first = np.array([0, 1, 5, 8])
    good, trans = rng.normal(size=8), rng.normal(size=(2, 2))
    p, pairs_, z = C.marginals(good, trans, first, np.ones(8))
    total = np.zeros((2, 2))
    for k in range(3):
        g = good[first[k] : first[k + 1]]
        paths = list(itertools.product((0, 1), repeat=len(g)))
        w = np.array([np.exp(sum(x * y for x, y in zip(g, s)) + sum(trans[a, b] for a, b in zip(s, s[1:]))) for s in paths])
        assert np.isclose(z[k], np.log(w.sum()))
        assert np.allclose(p[first[k] : first[k + 1]], [(w * [s[i] for s in paths]).sum() / w.sum() for i in range(len(g))])
        for s, x in zip(paths, w / w.sum()):
            for a, b in zip(s, s[1:]):
                total[a, b] += x
    assert np.allclose(pairs_, total)


def test_quality_odd(spark, odd):
    labels = spark.createDataFrame([(3, 1), (4, 1), (5, 0), (6, 0), (7, None), (99, 1)], "doc_id long, quality int")
    m = C.fit(odd, labels)
    assert C.score(odd, m).where("__score between 0 and 1").count() == odd.count()
    one = C.fit(odd, labels.where("quality = 1"))
    assert {r[0] for r in C.score(odd, one).select("__score").collect()} == {1.0}
    assert {r[0] for r in C.score(odd, C.fit(odd, labels.limit(0))).select("__score").collect()} == {0.5}
    assert C.score(odd.limit(0), m).count() == 0


def test_digests(spark, tiny):
    out = {r.doc_id: r for r in Q.op1(spark, tiny).collect()}
    kept = {r.doc_id: r.kept for r in S.remove_repeats(spark.read.parquet(f"{tiny}/documents.parquet")).collect()}
    assert all(hashlib.sha256(kept[d].encode()).hexdigest() == r.kept_sha256 for d, r in out.items())

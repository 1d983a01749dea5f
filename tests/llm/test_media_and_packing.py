import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import html_text, media, packing, webp
from quarry.llm import queries as Q

# Op 6


def images():
    rng = np.random.default_rng(0)
    for t in range(12):
        h, w = (int(x) for x in rng.integers(1, 40, 2))
        yield [
            rng.integers(0, 2**32, (h, w), dtype=np.uint32),
            rng.choice(rng.integers(0, 2**32, int(rng.integers(1, 40)), dtype=np.uint32), (h, w)),
            np.tile(rng.integers(0, 2**32, (1, w), dtype=np.uint32), (h, 1)),
            np.full((h, w), 0xFF102030, np.uint32),
        ][t % 4]


@pytest.mark.parametrize("transforms", [(), (webp.SUBTRACT_GREEN,), (webp.PREDICTOR,), (webp.CROSS_COLOR,), (webp.PREDICTOR, webp.CROSS_COLOR), (webp.CROSS_COLOR, webp.PREDICTOR, webp.SUBTRACT_GREEN), (webp.PALETTE,)])
@pytest.mark.parametrize("cache", [0, 1, 7])
def test_round_trips(transforms, cache):
    rng = np.random.default_rng(1)
    for image in images():
        if webp.PALETTE in transforms and len(np.unique(image)) > 256:
            continue
        n = -(-image.shape[0] // 8) * -(-image.shape[1] // 8)
        modes = (rng.integers(0, 14, n).astype(np.uint32) << np.uint32(8)) | np.uint32(0xFF000000)
        data = webp.encode(image, transforms, 3, modes, rng.integers(0, 2**32, n, dtype=np.uint32), cache)
        assert (webp.decode(data) == image).all()


def test_groups_of_prefix_codes():
    """A hand-made 8 × 1 image of two blocks with a code each, as the format has it: the first is green 5, the second green 9 or 200."""
    w = webp.Writer()
    for v, n in ((0x2F, 8), (7, 14), (0, 14), (0, 1), (0, 3), (0, 1), (0, 1), (1, 1), (0, 3)):
        w.put(v, n)
    one = lambda s: w.put(5 | s << 3, 11)
    w.put(0, 1)  # the entropy image: no cache; green is 0 or 1
    w.put(1 | 1 << 1 | 0 << 2, 3), w.put(0, 1), w.put(1, 8)
    for s in (0, 0, 255, 0):
        one(s)
    w.put(0b10, 2)
    for green in ((5,), (9, 200)):
        if len(green) == 1:
            one(green[0])
        else:
            w.put(1 | 1 << 1 | 1 << 2, 3), w.put(green[0], 8), w.put(green[1], 8)
        for s in (1, 2, 255, 0):
            one(s)
    w.put(0b0110, 4)
    assert ((webp.decode_chunk(w.done()) >> np.uint32(8)) & np.uint32(255)).tolist() == [[5, 5, 5, 5, 9, 200, 200, 9]]


def test_near_distances_and_predictions():
    assert len(webp.NEAR) == 120 == len(set(webp.NEAR)) and webp._distance(2, 10) == 1 and webp._distance(1, 10) == 10 and webp._distance(121, 10) == 1
    left, top, corner = 0xFF0A0A0A, 0xFF141414, 0xFF0F0F0F
    assert webp.predict(7, left, top, 0, corner) == 0xFF0F0F0F and webp.predict(12, left, top, 0, corner) == 0xFF0F0F0F
    assert webp.predict(11, left, top, 0, left) == top and webp.predict(0, 1, 2, 3, 4) == 0xFF000000


def test_broken_files():
    good = webp.encode_gray(np.arange(192 * 3, dtype=np.uint64).astype(np.uint8).reshape(3, 192))
    for bad in (b"", b"RIFF", good[:40], b"RIFF" + good[8:], good[:20] + b"\0" + good[21:]):
        with pytest.raises((webp.WebPError, ValueError, IndexError)):
            webp.decode(bad)


def test_media_query(spark, tiny, odd):
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    seen = {}
    for r in Q.op6(spark, tiny).collect():
        raw = text[r.doc_id].encode()
        full = raw + b" " * ((-len(raw)) % 192 or (0 if raw else 192))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-16:]))
        assert seen.setdefault(text[r.doc_id], (r.media_sha256, r.media_bytes, r.feature)) == (r.media_sha256, r.media_bytes, r.feature)
    back = media.read_back(media.store(odd, ["doc_id", "text"]), ["doc_id", "text"]).collect()
    assert all(r.pixels.decode() == (t := r.text or "") + " " * (len(r.pixels) - len(t.encode())) and len(r.pixels) % 192 == 0 < len(r.pixels) for r in back)
    assert media.store(odd.limit(0), ["doc_id"]).count() == 0
    broken = spark.createDataFrame([(1, None), (2, bytearray(b"no media"))], "k int, media binary")
    assert all(r.pixels is None and r.error for r in media.read_back(broken, ["k"]).collect())


def test_very_tall_payloads(monkeypatch):
    monkeypatch.setattr(media, "MAX_ROWS", 3)
    data = bytes(range(192)) * 10
    assert len(webp.files(media.to_media(data))) == 4 and media.from_media(media.to_media(data)).tobytes() == data


# Op 4


def plain_ids(text):
    from tokenizers import Tokenizer

    t = plain_ids.t = getattr(plain_ids, "t", None) or Tokenizer.from_file(Q.tokenizer_file())
    return t.encode(text or "", add_special_tokens=False).ids + [2]


def check_packing(rows, pieces, groups=1):
    want = collections.Counter((d, tuple(plain_ids(t))) for d, t in rows)
    by = collections.defaultdict(list)
    for p in pieces:
        assert 0 < p.length <= 4096
        by[p.doc_id].append(p)
    total = sum(len(k[1]) * n for k, n in want.items())
    assert sum(p.length for p in pieces) == total
    for (d, ids), n in want.items():
        raw = np.array(ids, dtype="<u4")
        for a in range(0, len(ids), 4096):
            part = raw[a : a + 4096]
            same = [p for p in by[d] if p.start == a and p.ids_crc32 == zlib.crc32(part.tobytes()) and p.length == len(part) and p.doc_tokens == len(ids)]
            assert len(same) >= n
    seqs = collections.defaultdict(list)
    for p in pieces:
        seqs[p.sequence_id].append((p.offset, p.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 4096
    return total / (4096 * len(seqs))


def test_packing(spark, docs, odd):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert check_packing(rows, packing.pack(docs, Q.tokenizer_file()).collect()) > 0.97
    assert check_packing(rows, packing.pack(docs, Q.tokenizer_file(), group_docs=20).collect()) > 0.6
    check_packing([(r.doc_id, r.text) for r in odd.collect()], packing.pack(odd, Q.tokenizer_file()).collect())
    assert packing.pack(odd.limit(0), Q.tokenizer_file()).count() == 0


def test_first_fit_decreasing_like_a_scan():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 7, 200):
        sizes = rng.integers(1, 100, n)
        bins, offsets = packing.first_fit_decreasing(sizes, 100)
        room, want = [], {}
        for i in np.argsort(-sizes, kind="stable").tolist():
            k = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
            room += [100] * (k == len(room))
            want[i] = (k, 100 - room[k])
            room[k] -= int(sizes[i])
        assert {i: (int(bins[i]), int(offsets[i])) for i in range(n)} == want


def test_odd_words_are_tokenized_whole(spark):
    texts = ["It's a test.\tDon't  stop, l'été É́ x y ...,! <|endoftext|> <|ENDOFTEXT|> 'tis 123 4a !!a's 𝔘 ﬁ ǅ İ", "a.'s b's. c,'d", "&&&& a&& &a b%%%. ##", "naïve— “quoted” x ý z"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: (r.ids_crc32, r.length) for r in packing.pack(df, Q.tokenizer_file()).collect()}
    assert got == {i: (zlib.crc32(np.array(plain_ids(t), dtype="<u4").tobytes()), len(plain_ids(t))) for i, t in enumerate(texts)}


# Op 7


def test_pages(spark, tiny):
    import html

    for r in Q.op7(spark, tiny).join(spark.read.parquet(f"{tiny}/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a href=x>Menu</a></nav>
<div class="cookie-notice">We use cookies</div><div class=sidebar><p>Side text that is quite long, as long as a paragraph of the text is.</p></div>
%s<h1>A &amp; B</h1><p>First   paragraph with a <b>bold</b> word and enough text to be read.<p>Second &lt;paragraph&gt;, which is long
 enough too, and has a <a href=y>link</a>.<div id="comments"><p>Reader says hello at length, and goes on.</p></div><form><label>Mail</label></form><script>var a="</p>";</script>%s
<footer>(c) Somebody</footer></body></html>"""


@pytest.mark.parametrize("wrap", [("<article>", "</article>"), ("<main>", "</main>"), ("<div class=content>", "</div>"), ("", "")])
def test_main_text(wrap):
    assert html_text.main_text(PAGE % wrap) == "A & B\nFirst paragraph with a bold word and enough text to be read.\nSecond <paragraph>, which is long enough too, and has a link."


def test_odd_pages(spark):
    df = spark.createDataFrame([(1, "u", None, 1), (2, None, "", 2), (None, "u", "<p>text", 3), (4, "u", "plain", 4), (4, "u", "<![bad <p>x</p>", 5), (5, "u", "<div>" * 3000 + "deep", 6)], "page_id long, url string, html string, text int")
    got = {(r.page_id, r.text) for r in html_text.extract_main_text(df).collect()}
    assert {(1, ""), (2, ""), (None, "text"), (4, "plain"), (5, "deep")} <= got
    assert html_text.extract_main_text(df.limit(0)).count() == 0


def test_smoothing_and_threshold():
    assert html_text.threshold(np.array([1.0, 2.0, 50.0, 52.0])) == pytest.approx(26.25)
    assert np.allclose(html_text.smooth(np.ones(7)), 1)
    assert F is not None

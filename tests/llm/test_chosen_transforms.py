import numpy as np
import pytest

from quarry.llm import media, webp
from quarry.llm import queries as Q


def kinds(data):
    """The transforms of the first image of a file."""
    chunk = next(iter(webp.files(data)))
    bits = webp.Bits(chunk)
    bits.read(8 + 14 + 14 + 1 + 3)
    return bits.read(2) if bits.read(1) else None


PAYLOADS = {  # what it is, the first transform that is chosen
    "text": ("The quick brown fox jumps over the lazy dog, 1234567890 times or more. " * 40, webp.SUBTRACT_GREEN),
    "one": (" " * 500, webp.SUBTRACT_GREEN),
    "few": ("0110 1001\n" * 300, webp.PALETTE),
    "numbers": ("".join(f"{i * 7919 % 9973}\n" for i in range(900)), webp.PALETTE),
    "ramp": ("".join(chr(32 + i % 96) for i in range(6000)), webp.PREDICTOR),
    "rows": ("".join(chr(33 + i * i % 89) for i in range(192)) * 30, webp.PREDICTOR),
    "empty": ("", webp.SUBTRACT_GREEN),
}


@pytest.mark.parametrize("name", PAYLOADS)
def test_transforms_of_payloads(name):
    text, want = PAYLOADS[name]
    data = text.encode() + b" " * (-len(text.encode()) % 192 or (0 if text else 192))
    stored = media.to_media(data)
    assert media.from_media(stored).tobytes() == data
    assert kinds(stored) == want
    plain = webp.encode_gray(np.frombuffer(data, dtype=np.uint8).reshape(-1, 192))
    assert len(stored) <= len(plain) + 64


def test_differences_and_sums():
    rng = np.random.default_rng(5)
    for h, w in ((1, 1), (1, 7), (7, 1), (5, 9)):
        px = rng.integers(0, 2**32, h * w, dtype=np.uint32)
        for mode in (webp.LEFT, webp.TOP):
            d = webp._differences(px, h, w, mode)
            flat = px.tolist()
            guess = np.array([webp._predicted(flat, i, i % w, i // w, w, mode) for i in range(h * w)], dtype=np.uint32)
            assert (d == webp._join(*(x - y for x, y in zip(webp.channels(px), webp.channels(guess))))).all()
            assert (webp._summed(d, h, w, mode) == px).all()


def test_query_stores_them(spark, tmp_path):
    rows = [(i, t) for i, (t, _) in enumerate(PAYLOADS.values())] + [(90, None), (None, "x")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    import hashlib

    for r in Q.op6(spark, str(tmp_path)).collect():
        raw = (dict(rows)[r.doc_id] or "").encode()
        raw += b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        assert r.payload_bytes == len(raw) and r.payload_sha256 == hashlib.sha256(raw).hexdigest()

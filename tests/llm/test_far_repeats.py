import numpy as np
import pytest

from quarry.llm import media, webp
from quarry.llm import queries as Q


def test_repeats_from_over_a_megabyte_before():
    rng = np.random.default_rng(4)
    head = rng.integers(97, 123, 1_200_000, dtype=np.uint8)
    data = np.concatenate([head, head[:300_000]]).tobytes()
    data += b" " * (-len(data) % media.WIDTH)
    assert media.from_media(media.to_media(data)).tobytes() == data
    assert all(d + len(webp.NEAR) <= 1 << 20 for _, _, d in webp.repeats(np.frombuffer(data, dtype=np.uint8).astype(np.uint32)))


def test_failed_read_back_raises(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "a text")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    store = media.store
    monkeypatch.setattr(media, "store", lambda docs, keep: store(docs, keep).selectExpr(*keep, "substring(media, 1, 30) AS media"))
    with pytest.raises(Exception, match="read back"):
        Q.op6(spark, str(tmp_path)).collect()

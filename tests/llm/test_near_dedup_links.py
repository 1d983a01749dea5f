import random

from quarry.llm import near_dedup
from tests.llm.test_text_operators import by_row, classes_by_force, pairs


def test_links_in_large_buckets(spark):
    """Texts around a long passage make buckets of hundreds; a few pairs among them are similar enough, to each other only."""
    rng = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(300))
    words = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    rows = [(i, f"{passage} {' '.join(words(45))}") for i in range(300)]
    for k in range(40):
        w = words(10)
        for side in range(2):
            rows.append((1000 + 2 * k + side, f"{passage} {' '.join(w)} {' '.join(words(33))}"))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = classes_by_force(pairs(df))
    assert sum(n == 2 for _, _, n in want) == 80
    assert by_row(near_dedup.near_duplicate_classes(df, block=16), "doc_id", "class_id", "class_size") == want


def test_repeated_passages_keep_links(spark):
    """Equal sets of shingles but for a passage that one text repeats: the counts differ, the similarity doesn't."""
    rows = []
    for k in range(20):
        text = " ".join(f"k{k}w{i}" for i in range(104))
        rows += [(2 * k, text), (2 * k + 1, text + " " + " ".join([f"k{k}r{i}" for i in range(10)] * 30))]
    out = near_dedup.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert by_row(out, "doc_id", "class_id", "class_size") == classes_by_force(rows)
    assert all(r.class_size == 2 for r in out.collect())

import collections
import unicodedata
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from quarry.llm import near_dedup, packing, shared
from quarry.llm.queries import tokenizer_file
from tests.llm.test_media_and_packing import check_packing, plain_ids
from tests.llm.test_text_operators import pairs


def test_keep_one_keeps_different_texts_of_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a, "x"), (1, b, "x"), (1, a, "y"), (2, a, "z"), (2, c, "z"), (3, c + " more", "z"), (None, a, "n"), (None, a, "n"), (4, None, "e"), (5, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __t string").repartition(3)
    got = collections.Counter((r.doc_id, r.text) for r in near_dedup.keep_one(df).collect())
    assert got == collections.Counter([(1, a), (1, b), (2, c), (None, a), (None, a), (4, None)])
    assert near_dedup.keep_one(df).columns == df.columns and near_dedup.keep_one(df.limit(0)).count() == 0


def test_intermediate_tables_go(spark):
    t = shared.written(spark.range(5), "some")
    assert t.count() == 5
    shared.discard(t)
    with pytest.raises(Exception):
        t.count()


def test_a_cluster_names_the_shared_folder():
    session = lambda master, named=None: SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named), sparkContext=SimpleNamespace(master=master))
    assert shared.shared_dir(session("yarn", "hdfs://store/shared/")) == "hdfs://store/shared"
    assert shared.shared_dir(session("local[2]")) == shared.shared_dir(session("local")) != ""
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared.shared_dir(session(master))


def test_words_that_change_in_lower_case(spark):
    """A capital with a dot above becomes two code points; what follows it isn't a tail of its own."""
    rows = [(i, t) for i, t in enumerate(["ABİ, x", "İ.", "xİ!?", "(İ)", "é, Å. Å;", unicodedata.normalize("NFD", "Éé, ÀÀ.")])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert check_packing(rows, packing.pack(df, tokenizer_file()).collect()) > 0
    words = packing.WordTokenizer(tokenizer_file())
    for _, t in rows:
        parts = t.split(" ")
        words.learn([w for w in parts if "<|" not in w])
        assert len(plain_ids(t)) > 1


def test_copies_fall_into_many_groups(spark):
    """Rows without an id and text, and copies of one text, are dealt to all groups."""
    df = spark.range(6000).select(F.lit(None).cast("long").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.lit("a copied text of some words")).alias("text")).repartition(8)
    out = packing.pack(df, tokenizer_file(), group_docs=500)
    sizes = [r["count"] for r in out.groupBy(F.shiftright("sequence_id", 32).alias("g")).count().collect()]
    assert len(sizes) == 12 and max(sizes) < 700 and sum(sizes) == 6000
    again = packing.pack(df, tokenizer_file(), group_docs=500)
    key = lambda d: sorted((r.sequence_id, r.offset, r.length) for r in d.collect())
    assert key(out) == key(again) and pairs(df)

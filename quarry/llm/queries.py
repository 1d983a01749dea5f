"""The thin query of each operator, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, html_text, language_id, licences, line_dedup, media, near_dedup, packing, quality_crf, substring_dedup
from .shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_UP, _LOW = line_dedup.UPPER, line_dedup.LOWER


def query(name: str, sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


OP5_SQL = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UP}', '{_LOW}') AS key FROM l),
held AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.doc_id, pos, line, coalesce(k.doc_id <> held.first_id, false) AS gone FROM k LEFT JOIN held USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op5_line_dedup", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_WORDS10 = f"regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP10_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS10} AS w FROM documents),
i AS (SELECT item_id, {_WORDS10} AS w FROM benchmark),
iw AS (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS gram FROM iw),
ks AS (SELECT DISTINCT k FROM g),
dp AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d CROSS JOIN ks WHERE len(w) >= k),
dg AS (SELECT doc_id, k, p, array_to_string(list_slice(w, p, p + k - 1), ' ') AS gram FROM dp),
h AS (SELECT doc_id, item_id, k, p FROM dg JOIN g USING (k, gram)),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM h) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN s USING (doc_id)
"""


@query("op10_decontaminate", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = decontaminate.count_hits(F.col("hit_starts"), F.col("hit_ends"))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit_starts") > 0).alias("contaminated"),
    )


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language_id.fold(F.col("doc_id"), 4) == 2)
    model = language_id.fit(docs.where(~F.col("held_out")))
    return language_id.predict(docs, model).select("doc_id", (language_id.fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


@query("op4_pack")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file())


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op7_html_text")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, sf_dir, "pages"))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality_crf.Model:
    """Learned from labels whose document's crc32 of the id is not 0 modulo 5."""
    return quality_crf.fit(docs, table(spark, sf_dir, "labels").where(language_id.fold(F.col("doc_id"), 5) != 0))


@query("op2_quality_crf")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality_crf.score(docs, quality_model(spark, docs, sf_dir), keep=["doc_id"])
    return out.select("doc_id", (language_id.fold(F.col("doc_id"), 5) == 0).alias("held_out"), F.col("__score").alias("score"), F.when(F.col("__score") >= 0.3, 1).otherwise(0).alias("predicted"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, p, md5(array_to_string(list_slice(w, p, p + 34), ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
r AS (SELECT doc_id, p FROM p WHERE h IN (SELECT h FROM p GROUP BY h HAVING count(*) > 1)),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS q FROM r),
k AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS q FROM d),
m AS (SELECT k.doc_id, k.q, word, g.q IS NOT NULL AS gone FROM k LEFT JOIN g ON k.doc_id = g.doc_id AND k.q = g.q),
s AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY q) FILTER (WHERE NOT gone) AS kept FROM m GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)
"""


@query("op1_substring_dedup", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_webp_media")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    back = media.read_back(media.store(docs, ["doc_id", "n_bytes"]), ["doc_id", "n_bytes"])
    failed = F.raise_error(F.concat(F.lit("media can't be read back: "), "error")).cast("binary")
    back = back.withColumn("pixels", F.when(F.col("error").isNull(), F.col("pixels")).otherwise(failed))
    return back.select(
        "doc_id",
        "n_bytes",
        F.octet_length("pixels").cast("long").alias("payload_bytes"),
        F.sha2("pixels", 256).alias("payload_sha256"),
        F.crc32(F.substring("pixels", -16, 16)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )


@query("op3_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.near_duplicate_classes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "class_size", (F.col("doc_id") == F.col("class_id")).alias("representative"))


@query("op9_licence_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_paragraphs(table(spark, sf_dir, "documents"))

"""Pages of positioned text blocks: headers, running sections, rows and metrics.

blocks: doc_id, page, block (reading order), text, x0, y0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import numbers as N
from quarry.functions import text as T

# Labels of metrics in order of precedence, and the metrics of income statements.
METRIC_LABELS = (
    ("revenue", (r"receita\s+de\s+venda", r"receita\s+l[íi]quida", r"receita\s+operacional\s+l[íi]quida", r"receitas?\s+da\s+intermedia[çc][ãa]o\s+financeira", r"receitas?\s+de\s+intermedia[çc][ãa]o\s+financeira")),
    ("cogs", (r"custo\s+dos?\s+bens", r"custo\s+dos?\s+produtos", r"custo\s+dos?\s+servi[çc]os", r"despesas?\s+da\s+intermedia[çc][ãa]o\s+financeira", r"despesas?\s+de\s+intermedia[çc][ãa]o\s+financeira")),
    ("gross_profit", (r"resultado\s+bruto", r"lucro\s+bruto")),
    ("ebitda", (r"\bebitda\b", r"\blajida\b")),
    ("net_income", (r"lucro\s*/\s*preju[íi]zo\s+(?:consolidado\s+)?do\s+per[íi]odo", r"lucro\s+l[íi]quido\s+(?:consolidado\s+)?do\s+per[íi]odo", r"resultado\s+l[íi]quido\s+do\s+per[íi]odo", r"lucro\s+\(?preju[íi]zo\)?\s+l[íi]quido")),
    ("total_assets", (r"^ativo\s+total$",)),
    ("total_equity", (r"patrim[oô]nio\s+l[íi]quido\b",)),
    ("net_debt", (r"d[íi]vida\s+l[íi]quida",)),
    ("operating_cash_flow", (r"caixa\s+l[íi]quido\s+atividades\s+operacionais", r"caixa\s+das?\s+atividades\s+operacionais", r"atividades\s+operacionais\b")),
)
INCOME_METRICS = ("revenue", "cogs", "gross_profit", "net_income")
CONSOLIDATED, CODE_LINE, VALUE = r"DFs\s+Consolidadas", r"^\d+(?:\.\d+)*\n", r"^[+-]?\d+(?:\.\d{3})*(?:,\d+)?$"
UNITS = ("mil", "milh", "bilh", "reais", "r$")
HEADER_Y, TOP_Y, DATA_Y, SCALE_Y, RUNNING_Y, FOOT_Y, DEPTH = 90, 100, 125, (75, 115), 80, 750, 2


def pinned(df: DataFrame, keep: list[str], **made: Column) -> DataFrame:
    """df with computed columns that are worked out once, however often later filters and expressions name them."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))))


def clean_blocks(raw: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Text blocks that aren't blank, nor short page numbers at the foot; the first pages only if so asked."""
    t = N.strip(F.col("text"))
    number = (F.length(t) <= 3) & N.strip(F.replace(t, F.lit("de"), F.lit(""))).rlike(r"^\p{Nd}+$") & (F.col("y0") > FOOT_Y)
    out = raw.where((t != "") & ~number)
    return out if max_pages is None else out.where(F.col("page") <= max_pages)


def page_headers(blocks: DataFrame) -> DataFrame:
    """(doc_id, page, header, own_section): the first block at the top that names a section, else the first that is no tag."""
    t = N.strip(F.col("text"))
    c = blocks.where((F.col("y0") < HEADER_Y) & (F.length(t) >= 4) & ~T.is_banner(F.col("text")))
    c = pinned(c, ["doc_id", "page", "block", "y0"], t=t, s=T.classify_section(t))
    known = F.col("s") != T.UNKNOWN
    w = Window.partitionBy("doc_id", "page").orderBy(F.desc(known.cast("int")), "y0", "block")
    best = c.where(known | ~F.col("t").isin(*T.TAGS)).withColumn("__rn", F.row_number().over(w)).where("__rn = 1")
    return best.select("doc_id", "page", F.col("t").alias("header"), F.col("s").alias("own_section"))


def page_sections(blocks: DataFrame) -> DataFrame:
    """(doc_id, page, section, marks): the section of each page, carried on from the last that names one; marks: it begins there."""
    pages = blocks.select("doc_id", "page").distinct()
    own = pages.join(page_headers(blocks), ["doc_id", "page"], "left")
    w = Window.partitionBy("doc_id").orderBy("page")
    known = F.when(F.col("own_section") != T.UNKNOWN, F.col("own_section"))
    p = own.withColumn("section", F.coalesce(F.last(known, True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(T.UNKNOWN)))
    changed = ~F.col("section").eqNullSafe(F.lag("section").over(w)) & (F.col("section") != T.UNKNOWN)
    return p.select("doc_id", "page", "section", changed.alias("marks"))


def full_texts(blocks: DataFrame) -> DataFrame:
    """(doc_id, full_text): content blocks in order, with a marker wherever a section begins."""
    running = (F.col("y0") <= RUNNING_Y) & (T.classify_section(N.strip(F.col("text"))) != T.UNKNOWN)
    content = blocks.where(~T.is_artifact(F.col("text")) & ~running)
    parts = content.groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda b: b["text"]), "\n\n").alias("body"))
    marker = F.when(F.col("marks"), F.concat(F.lit("\n\n[SECTION:"), F.col("section"), F.lit("]\n\n")))
    pages = page_sections(blocks).join(parts, ["doc_id", "page"], "left").withColumn("body", F.when(N.strip(F.col("body")) != "", F.col("body")))
    pages = pages.select("doc_id", "page", F.array_compact(F.array(marker, F.col("body"))).alias("ps"))
    whole = pages.groupBy("doc_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("page", "ps"))), lambda p: p["ps"])).alias("ps"))
    return whole.select("doc_id", F.array_join("ps", "\n\n").alias("full_text"))


def _consolidated() -> Column:
    return (F.col("y0") < TOP_Y) & F.col("text").rlike("(?iU)" + CONSOLIDATED)


def consolidated_pages(blocks: DataFrame) -> DataFrame:
    return blocks.where(_consolidated()).select("doc_id", "page").distinct()


def page_scales(blocks: DataFrame) -> DataFrame:
    """(doc_id, page, scale) of pages with a unit line."""
    t = N.strip(F.col("text"))
    unit = t.startswith("(")
    for u in UNITS:
        unit = unit | F.lower(t).contains(u)
    c = blocks.where((F.col("y0") > SCALE_Y[0]) & (F.col("y0") < SCALE_Y[1]) & unit)
    return c.groupBy("doc_id", "page").agg(F.min_by(t, "block").alias("t")).select("doc_id", "page", N.detect_scale(F.col("t")).alias("scale"))


def _row_blocks(y0: Column, t: Column) -> Column:
    return (y0 > DATA_Y) & (t != "")


def _height(y0: Column) -> Column:
    return (F.bround(y0 / 3) * 3).cast("int")


def page_rows(blocks: DataFrame) -> DataFrame:
    """(doc_id, page, y, code, description, cells) of table rows: blocks at about one height, left to right."""
    t = N.strip(F.col("text"))
    b = blocks.where(_row_blocks(F.col("y0"), t)).withColumns({"y": _height(F.col("y0")), "t": t})
    return _split_rows(b)


def _split_rows(b: DataFrame) -> DataFrame:
    """Rows of pages from their blocks (doc_id, page, y, x0, block, t)."""
    rows = b.groupBy("doc_id", "page", "y").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "block", "t"))), lambda x: x["t"]), "\n").alias("all"))
    rows = pinned(rows.where(F.col("all").rlike(CODE_LINE)), ["doc_id", "page", "y"], ps=F.transform(F.split("all", "\n"), N.strip))
    is_value = lambda p: p.rlike(VALUE) | (p.startswith("-") & F.substring(p, F.lit(2), F.length(p)).rlike(VALUE)) | (p.startswith("(") & p.endswith(")"))
    rows = pinned(rows, ["doc_id", "page", "y", "ps"], at=F.array_position(F.transform(F.slice("ps", F.lit(2), F.size("ps")), lambda p: is_value(p)), True))
    stop = F.when(F.col("at") > 0, F.col("at").cast("int") + 1).otherwise(F.size("ps") + 1)
    rows = pinned(
        rows,
        ["doc_id", "page", "y"],
        code=F.element_at("ps", 1),
        description=N.strip(F.array_join(F.slice("ps", F.lit(2), stop - 2), " ")),
        cells=F.filter(F.slice("ps", stop, F.size("ps")), lambda p: p != ""),
    )
    return rows.where((F.col("description") != "") & (F.size("cells") > 0))


def statement_rows(blocks: DataFrame, sections: tuple[str, ...] | None = (T.BALANCE, T.INCOME)) -> DataFrame:
    """page_rows of consolidated pages in the sections named, or in any.

    Blocks are shuffled once, by document: pages, the sections they carry on, and rows are then made where the blocks lie.
    """
    b = blocks.repartition("doc_id").select("doc_id", "page", "block", "x0", "y0", "text")
    b = pinned(b, b.columns, t=N.strip(F.col("text")))
    top = (F.col("y0") < HEADER_Y) & (F.length("t") >= 4) & ~T.is_banner(F.col("t"))
    b = pinned(b, b.columns, s=F.when(top, T.classify_section(F.col("t"))))
    known = F.col("s") != T.UNKNOWN
    header = F.when(known | (F.col("s").isNotNull() & ~F.col("t").isin(*T.TAGS)), F.struct((~known).alias("unknown"), "y0", "block", "s"))
    body = F.when(_row_blocks(F.col("y0"), F.col("t")), F.struct(_height(F.col("y0")).alias("y"), "x0", "block", "t"))
    pages = b.groupBy("doc_id", "page").agg(F.min(header)["s"].alias("own"), F.bool_or(_consolidated()).alias("marked"), F.collect_list(body).alias("body"))
    before = Window.partitionBy("doc_id").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    carried = pages.withColumn("section", F.last(F.nullif("own", F.lit(T.UNKNOWN)), True).over(before))
    kept = pages.where("marked") if sections is None else carried.where(F.col("marked") & F.col("section").isin(*sections))
    return _split_rows(kept.select("doc_id", "page", F.inline("body")))


def metric_of(description: Column, code: Column) -> Column:
    """The metric that a row's label names; null for sub-accounts and other labels."""
    out = None
    for name, patterns in METRIC_LABELS:
        hit = description.rlike("(?iU)" + "|".join(f"(?:{p})" for p in patterns))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.when(F.regexp_count(code, F.lit(r"\.")) <= DEPTH, out)


def metric_rows(blocks: DataFrame, quarterly: Column) -> DataFrame:
    """Rows of consolidated statements that name a metric, with the cell that counts and its value.

    quarterly: of doc_id; income statements of quarters have the year to date in their second of four cells.
    """
    table = statement_rows(blocks)
    rows = pinned(table, table.columns, metric_name=metric_of(F.col("description"), F.col("code"))).where(F.col("metric_name").isNotNull())
    second = quarterly & F.col("metric_name").isin(*INCOME_METRICS) & (F.size("cells") >= 4)
    cell = F.when(second, F.try_element_at("cells", F.lit(2))).otherwise(F.element_at("cells", 1))
    rows = pinned(rows, rows.columns, raw=cell)
    return pinned(rows, rows.columns, value=N.normalize_cell(F.col("raw")))


def extract_metrics(blocks: DataFrame, quarterly: Column) -> DataFrame:
    """(doc_id, metric_name, value, raw, page, row_label): of each metric the first row that parses."""
    w = Window.partitionBy("doc_id", "metric_name").orderBy("page", "y", "code")
    first = metric_rows(blocks, quarterly).where(F.col("value").isNotNull()).withColumn("__rn", F.row_number().over(w)).where("__rn = 1")
    return first.select("doc_id", "metric_name", "value", "raw", "page", F.col("description").alias("row_label"))


def extraction_failures(blocks: DataFrame, quarterly: Column) -> DataFrame:
    """(doc_id, metric_name, reason, raw, page): cells that don't parse before a metric is found, and metrics never matched."""
    w = Window.partitionBy("doc_id", "metric_name").orderBy("page", "y", "code").rowsBetween(Window.unboundedPreceding, 0)
    rows = metric_rows(blocks, quarterly).withColumn("__ok", F.count("value").over(w))
    broken = F.col("value").isNull() & (F.col("__ok") == 0)
    per = rows.groupBy("doc_id").agg(
        F.collect_set(F.when(F.col("value").isNotNull(), F.col("metric_name"))).alias("found"),
        F.collect_list(F.when(broken, F.struct("metric_name", F.lit("parse_error").alias("reason"), "raw", F.col("page").cast("int").alias("page")))).alias("broken"),
    )
    every = F.array(*[F.lit(m) for m, _ in METRIC_LABELS])
    lost = F.transform(F.array_except(every, F.coalesce("found", F.array().cast("array<string>"))), lambda m: F.struct(m.alias("metric_name"), F.lit("row_not_matched").alias("reason"), F.lit(None).cast("string").alias("raw"), F.lit(None).cast("int").alias("page")))
    docs = blocks.select("doc_id").distinct().join(per, "doc_id", "left")
    return docs.select("doc_id", F.inline(F.when(F.col("broken").isNull(), lost).otherwise(F.concat("broken", lost))))


def first_in_tables(tables: DataFrame, metric: str, patterns: tuple[str, ...]) -> DataFrame:
    """(doc_id, metric_name, value, raw, row_label) from 2-D tables (doc_id, rows array<array<string>>): the first row with a label that matches and a number."""
    r = tables.select("doc_id", F.posexplode("rows").alias("row", "cells")).withColumn("label", N.strip(F.try_element_at("cells", F.lit(1))))
    r = r.where(F.col("label").rlike("(?iU)" + "|".join(f"(?:{p})" for p in patterns)))
    r = r.withColumn("c", F.filter(F.transform(F.slice("cells", F.lit(2), F.size("cells")), lambda c: F.struct(N.strip(c).alias("raw"), N.normalize_cell(c).alias("value"))), lambda c: c["value"].isNotNull())).where(F.size("c") > 0)
    first = r.groupBy("doc_id").agg(F.min_by(F.struct("label", F.element_at("c", 1).alias("c")), "row").alias("b"))
    return first.select("doc_id", F.lit(metric).alias("metric_name"), F.col("b.c.value").alias("value"), F.col("b.c.raw").alias("raw"), F.col("b.label").alias("row_label"))

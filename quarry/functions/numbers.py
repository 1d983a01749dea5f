"""Numbers of filings in Brazilian notation, errors, rates and rank arithmetic, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What means zero in a table cell, and what is cut from a cell before parsing.
DASHES = ("-", "--", "—", "–", "- -", "–––")
CURRENCY = r"(?i)R\$\s*|US\$\s*|\bR\b\s*|mil\b.*$"
NUMBER = r"^[+-]?\s*(\d{1,3}(\.\d{3})*|\d+)(,\d+)?$"
#: Relative errors up to these are exact and close; truths below ZERO count as zero.
EXACT, CLOSE, ZERO = 1e-6, 0.01, 0.01


def strip(c: Column) -> Column:
    """Without white space at either end, as Unicode has it."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def parse_number(c: Column) -> Column:
    """1.234,56 as a double; null for any other notation."""
    t = strip(c)
    plain = F.regexp_replace(F.translate(t, ".", ""), ",", ".")
    return F.when(t.rlike(NUMBER), F.regexp_replace(plain, r"\s", "").try_cast("double"))


def normalize_cell(c: Column) -> Column:
    """A table cell as a double: dashes are zero, parentheses and a sign negate, currency and scale words go."""
    t = strip(c)
    closed = t.startswith("(") & t.endswith(")")
    signed = ~closed & t.startswith("-")
    inner = F.when(closed, strip(F.substring(t, F.lit(2), F.greatest(F.length(t) - 2, F.lit(0))))).when(t.startswith("-") | t.startswith("+"), strip(F.substring(t, F.lit(2), F.length(t)))).otherwise(t)
    value = parse_number(F.replace(strip(F.regexp_replace(inner, CURRENCY, "")), F.lit(" "), F.lit("")))
    return F.when(t == "", None).when(t.isin(*DASHES), F.lit(0.0)).when(closed | signed, -value).otherwise(value)


def detect_scale(header: Column) -> Column:
    """The unit that a header names, as a factor."""
    h = F.lower(header)
    return F.when(h.contains("bilh"), 1e9).when(h.contains("milh"), 1e6).when(h.contains("mil"), 1e3).otherwise(1.0)


def truth_number(c: Column) -> Column:
    """A number of a truth file: a comma or a dot before decimals; null if it is none."""
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("double")


def relative_error(extracted: Column, truth: Column) -> Column:
    """|extracted - truth| / |truth|; for a truth of about zero 0 if extracted is too, else null."""
    return F.when(F.abs(truth) < ZERO, F.when(F.abs(extracted) < ZERO, F.lit(0.0))).otherwise(F.abs(extracted - truth) / F.abs(truth))


def match_status(extracted: Column, truth: Column) -> Column:
    """missing, exact, close or mismatch."""
    e = relative_error(extracted, truth)
    return F.when(extracted.isNull(), "missing").when(e.isNull(), "mismatch").when(e <= EXACT, "exact").when(e <= CLOSE, "close").otherwise("mismatch")


def filing_status(found: Column, unmatched: Column, allowed: int = 2) -> Column:
    """failed if nothing was found, partial if more than allowed metrics weren't matched, else success."""
    return F.when(found == 0, "failed").when(unmatched > allowed, "partial").otherwise("success")


def percent(part: Column, total: Column) -> Column:
    """100 × part / total, 0 for no total."""
    return F.when(total > 0, part * 100.0 / total).otherwise(0.0)


def rrf(rank: Column, k: int = 60) -> Column:
    """The share of a rank (from 0) in reciprocal rank fusion; 0 for none."""
    return F.coalesce(1.0 / (k + rank + 1), F.lit(0.0))


def dot(a: Column, b: Column) -> Column:
    """The inner product of two arrays, added up in double."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def ideal_gain(relevant: Column, k: int) -> Column:
    """The discounted gain of min(relevant, k) hits at the top."""
    n = F.least(relevant.cast("int"), F.lit(k))
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(1), n), F.lit(0.0), lambda s, r: s + 1.0 / F.log2(r + 1.0))).otherwise(0.0)

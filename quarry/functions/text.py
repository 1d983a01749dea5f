"""Text of filings: accents, sections, artifacts, paragraphs, sentences and tokens, as Column expressions."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import strip

# Names of sections, and the patterns of their headings in order of precedence.
BALANCE, INCOME, REPORT, NOTES, UNKNOWN = "Balanço Patrimonial", "DRE", "Relatório da Administração", "Notas Explicativas", "Unknown"
SECTIONS = (
    (BALANCE, r"balan[çc]o\s+patrimonial"),
    (INCOME, r"demonstra[çc][aã]o\s+do\s+resultado(?!\s+abrangente)|resultado\s+do\s+exerc[ií]cio"),
    (REPORT, r"relat[oó]rio\s+da\s+(?:administra[çc][aã]o|diretoria)|coment[aá]rio[s]?\s+(?:de|do)\s+desempenho|relat[oó]rio\s+de\s+desempenho|desempenho\s+financeiro"),
    (NOTES, r"notas?\s+explicativas?"),
)
PROSE = (REPORT, NOTES)
ARTIFACT = r"(ITR|DFP|DFI|FRE|DFPF|PISP)\s*[-–]|Vers[aã]o\s*:\s*\d+|P[ÁA]GINA\s*:\s*\d+|P[ÚU]BLIC[AO]$|CONFIDENCIAL$|P[ÁA]G\.\s*\d+"
BANNER = r"(ITR|DFP|DFI|FRE|DFPF|PISP)\s*[-–]\s*"
TAGS = ("#interna", "#confidencial", "#publico")
WATERMARKS = ("PÚBLICA", "PÚBLICO", "CONFIDENCIAL")
MARKER = r"\[SECTION:([^\]]+)\]"
# Fixed value: white space as Unicode and Python have it (a class is faster than the flag for Unicode classes).
SPACES = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
# Dots that don't end a sentence.
ABBREVIATIONS = (
    (r"(?iU)\b(S)\.(A)\.", "$1$2"),
    (r"(?iU)\b(Cia)\.", "$1"),
    (r"(?iU)\b(Dr|Dra|Sr|Sra|Prof|No|Art|Pag|Ref|p\.ex)\.", "$1"),
    (r"(?U)\bR\$\s*(\d)", "R\\$ $1"),
    (r"(?U)(\d+)\.(\d{3})", "$1$2"),
)
SENTENCE_END = r"(?<=[.!?])\s+(?=[A-ZÁÉÍÓÚÀÈÌÒÙÂÊÎÔÛÃÕÇ\d])"
_FLAGS = "(?iU)"


@cache
def _decomposed() -> tuple[str, str, dict[str, str]]:
    """Characters whose compatibility decomposition has one ASCII character, these, and those with several."""
    one, several = {}, {}
    for i in range(0x80, 0x10000):
        plain = unicodedata.normalize("NFKD", chr(i)).encode("ascii", "ignore").decode()
        if plain:
            (one if len(plain) == 1 else several)[chr(i)] = plain
    return "".join(one), "".join(one.values()), several


def fold(c: Column) -> Column:
    """Upper case, decomposed by compatibility, without what isn't ASCII then (accents, letters of other scripts)."""
    accented, plain, several = _decomposed()
    up = F.upper(c)
    parts = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])
    spelled = F.array_join(F.transform(F.split(up, ""), lambda x: F.coalesce(F.try_element_at(parts, x), x)), "")
    up = F.when(up.rlike("[" + "".join(f"\\u{ord(x):04x}" for x in several) + "]"), spelled).otherwise(up)
    return F.regexp_replace(F.translate(up, accented, plain), r"[^\x00-\x7F]", "")


def classify_section(c: Column) -> Column:
    """The section that a heading names; the first pattern that matches wins."""
    out = None
    for name, pattern in SECTIONS:
        hit = c.rlike(_FLAGS + pattern)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(UNKNOWN)


def is_artifact(c: Column) -> Column:
    """Banners, version lines, page numbers and watermarks that pages repeat."""
    return strip(c).rlike(f"{_FLAGS}^(?:{ARTIFACT})")


def is_banner(c: Column) -> Column:
    return strip(c).rlike(f"{_FLAGS}^{BANNER}")


def words(c: Column) -> Column:
    """Pieces between white space, as Unicode has it."""
    return F.filter(F.split(c, SPACES), lambda w: w != "")


def tokens(c: Column) -> Column:
    """Lower-case words; punctuation stays on them."""
    return words(F.lower(c))


def token_estimate(c: Column) -> Column:
    """Words × 1.33, cut to a whole number, 1 at least."""
    return F.greatest(F.lit(1), (F.size(words(c)) * F.lit(1.33)).cast("int"))


def paragraphs(c: Column) -> Column:
    """What blank lines separate, without markers, page numbers and watermarks."""
    clean = F.regexp_replace(F.regexp_replace(c, MARKER, ""), r"\r\n?", "\n")
    found = F.transform(F.split(clean, r"\n{2,}"), strip)
    noise = lambda p: (F.length(p) < 20) & ~F.substring(p, 11, 20).rlike(r"\p{L}") & (p.rlike(r"^\p{Nd}+$") | p.isin(*WATERMARKS))
    return F.filter(found, lambda p: (p != "") & ~noise(p))


def sentences(c: Column) -> Column:
    """Sentences of a paragraph; the whole of it if it has none."""
    guarded = c
    for pattern, new in ABBREVIATIONS:
        guarded = F.regexp_replace(guarded, pattern, new)
    found = F.transform(F.split(guarded, "(?U)" + SENTENCE_END), lambda s: strip(F.translate(s, "", ".")))
    found = F.filter(found, lambda s: s != "")
    return F.when(F.size(found) > 0, found).otherwise(F.array(strip(c)))


def shorten(c: Column, n: int) -> Column:
    """At most n characters and an ellipsis."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("…"))).otherwise(c)


def label_of(response: Column, classes: tuple[str, ...] = ("optimistic", "neutral", "pessimistic")) -> Column:
    """The first class whose name a free-text answer holds, else neutral."""
    out = F.when(F.lower(response).contains(classes[0]), classes[0])
    for c in classes[1:]:
        out = out.when(F.lower(response).contains(c), c)
    return out.otherwise("neutral")


def filing_key(ticker: Column, kind: Column, date: Column, version: Column) -> Column:
    return F.concat_ws("_", ticker, kind, date, version)


def chunk_key(filing: Column, index: Column) -> Column:
    return F.format_string("%s_%04d", filing, index.cast("int"))


def key_part(key: Column, i: int) -> Column:
    """The i-th part (from 1) of a composite key; null if it has fewer."""
    return F.try_element_at(F.split(key, "_"), F.lit(i))

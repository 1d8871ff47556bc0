"""String operators S1-S19 as native column expressions.

Accent removal follows Unicode NFKD followed by dropping non-ASCII
characters. Spark has no ``normalize`` function, so the character map is
built here, once, by rule from ``unicodedata`` and applied with
``translate`` (single-character results) and ``replace`` (the few
multi-character ones). Characters without an ASCII decomposition are dropped
afterwards, exactly as the NFKD + ASCII-ignore method drops them.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import ColumnOrName, col

# Code point ranges whose NFKD form may contain ASCII letters or digits:
# Latin-1 supplement, Latin extended A/B, Latin extended additional,
# general punctuation and the Latin ligatures.
_DECOMPOSE_RANGES = ((0x00A0, 0x024F), (0x1E00, 0x1EFF), (0x2000, 0x206F), (0xFB00, 0xFB06))
# Long dashes become '-' before accents are removed (see the module README).
LONG_DASHES = "–—"


def _build_fold_map(ascii_only: bool):
    """Map each code point in the ranges above to its NFKD form, either
    reduced to ASCII (``ascii_only``) or with only the combining marks
    removed. Returns (single-char sources, targets, multi-char pairs)."""
    single_src, single_dst, multi = [], [], []
    for lo, hi in _DECOMPOSE_RANGES:
        for cp in range(lo, hi + 1):
            ch = chr(cp)
            if ch in LONG_DASHES:
                continue
            nfkd = unicodedata.normalize("NFKD", ch)
            if ascii_only:
                form = nfkd.encode("ascii", "ignore").decode("ascii")
            else:
                form = "".join(x for x in nfkd if not unicodedata.combining(x))
            if not form or form == ch:
                continue
            if len(form) == 1:
                single_src.append(ch)
                single_dst.append(form)
            else:
                multi.append((ch, form))
    return "".join(single_src), "".join(single_dst), tuple(multi)


_ASCII_MAP = _build_fold_map(ascii_only=True)
_MARKS_MAP = _build_fold_map(ascii_only=False)


def _fold(c: Column, table) -> Column:
    src, dst, multi = table
    out = F.translate(c, src, dst)
    if not multi:
        return out
    # The multi-character expansions are rare. Deleting those characters
    # with one translate and comparing lengths is a cheap probe; the chain
    # of replacements only runs on rows that contain one.
    msrc = "".join(a for a, _ in multi)
    expanded = out
    for a, b in multi:
        expanded = F.replace(expanded, F.lit(a), F.lit(b))
    has_multi = F.length(F.translate(out, msrc, "")) < F.length(out)
    return F.when(has_multi, expanded).otherwise(out)


# Python's ``str.isspace`` set, built by rule: ``str.strip()`` removes these.
PY_WHITESPACE = "".join(chr(cp) for cp in range(0x3001) if chr(cp).isspace())


def strip_unicode_space(c: ColumnOrName) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace (a
    character-set ``trim``, no regex scan)."""
    return F.trim(col(c), F.lit(PY_WHITESPACE))


def remove_accents(c: ColumnOrName) -> Column:
    """S3: drop diacritics (NFKD without combining marks), keep case and
    every other character."""
    return _fold(col(c), _MARKS_MAP)


def normalize_text(c: ColumnOrName, null_as_empty: bool = True) -> Column:
    """Trim, lower, long dashes to '-', accents removed (NFKD),
    remaining non-ASCII dropped, spaces around dashes removed, whitespace
    runs squeezed to one space. ``null_as_empty`` maps null to '' (S1);
    otherwise null stays null (S2)."""
    x = col(c).cast("string")
    x = F.lower(strip_unicode_space(x))
    x = F.translate(x, LONG_DASHES, "-" * len(LONG_DASHES))
    # Plain ASCII text, the common case, needs no folding.
    x = F.when(x.rlike(r"[^\x00-\x7F]"), F.regexp_replace(_fold(x, _ASCII_MAP), r"[^\x00-\x7F]", "")).otherwise(x)
    x = F.regexp_replace(x, r"\s*-\s*", "-")
    x = F.regexp_replace(x, r"\s+", " ")
    if null_as_empty:
        x = F.coalesce(x, F.lit(""))
    return x


def tidy_place(c: ColumnOrName) -> Column:
    """Trim, squeeze whitespace, strip trailing commas."""
    x = F.regexp_replace(strip_unicode_space(col(c)), r"\s+", " ")
    return F.regexp_replace(x, r",+$", "")


# The keyword rules of the reference's region key, in order.
# A normalised name containing the keyword maps to the key.
REGION_KEY_RULES: tuple[tuple[tuple[str, ...], str], ...] = (
    (("navarra",), "navarra"),
    (("asturias",), "asturias"),
    (("madrid",), "madrid"),
    (("murcia",), "murcia"),
    (("rioja",), "rioja"),
    (("balears", "illes"), "balears"),
)


def canonical_key(c: ColumnOrName, rules: Sequence[tuple[Sequence[str], str]] = REGION_KEY_RULES,
                  already_normalized: bool = False) -> Column:
    """Normalise, apply keyword rules in order (first hit wins), else
    keep the text before the first comma, trimmed."""
    n = col(c) if already_normalized else normalize_text(c)
    fallback = F.when(n.contains(","), F.trim(F.substring_index(n, ",", 1))).otherwise(n)
    expr = None
    for keywords, key in rules:
        cond = None
        for kw in keywords:
            cond = n.contains(kw) if cond is None else (cond | n.contains(kw))
        expr = F.when(cond, F.lit(key)) if expr is None else expr.when(cond, F.lit(key))
    return fallback if expr is None else expr.otherwise(fallback)


def zfill(c: ColumnOrName, width: int) -> Column:
    """Left-pad with zeros to ``width`` without cutting longer values
    (``lpad`` alone truncates)."""
    x = col(c).cast("string")
    return F.when(F.length(x) < width, F.lpad(x, width, "0")).otherwise(x)


# Text the reference treats as a missing value.
NULL_SENTINELS = ("", "nan", "none", "null", "<na>", "-", "—")


def nullify_sentinels(c: ColumnOrName, sentinels: Sequence[str] = NULL_SENTINELS,
                      trim: bool = True) -> Column:
    """Sentinel strings (compared trimmed and lower-cased) become null."""
    x = col(c).cast("string")
    probe = F.lower(F.trim(x)) if trim else F.lower(x)
    kept = F.trim(x) if trim else x
    return F.when(probe.isin([s.lower() for s in sentinels]), F.lit(None).cast("string")).otherwise(kept)


# Lead-time spellings and their canonical form.
LEAD_TIME_MAP = {
    "1 mes": "1 mes",
    "1 semana": "1 semana",
    "2 semanas": "2 semanas",
    "3 meses": "3 meses",
    "2-3 meses": "2-3 meses",
    "2 - 3 meses": "2-3 meses",
}


def normalize_lead_time(c: ColumnOrName, mapping: Mapping[str, str] = LEAD_TIME_MAP) -> Column:
    """Trim, lower, squeeze spaces, long dashes to '-', sentinels to
    null, then map known spellings (unknown ones are kept)."""
    x = F.lower(F.trim(col(c).cast("string")))
    x = F.regexp_replace(x, r"\s+", " ")
    x = F.translate(x, LONG_DASHES, "-" * len(LONG_DASHES))
    x = F.when(x.isin("", "nan", "none", "null", "-"), F.lit(None).cast("string")).otherwise(x)
    if mapping:
        m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
        x = F.coalesce(F.element_at(m, x), x)
    return x


def lower_string_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Lower-case every string column (or the given ones)."""
    targets = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(*[F.lower(F.col(c)).alias(c) if c in targets else F.col(c) for c in df.columns])


def truncate_upper(c: ColumnOrName, length: int, upper: bool = True) -> Column:
    """Trim, optionally upper-case, cut to a declared length."""
    x = F.trim(col(c).cast("string"))
    if upper:
        x = F.upper(x)
    return F.substring(x, 1, length)


def split_pair(c: ColumnOrName, sep: str = "-") -> tuple[Column, Column]:
    """Split on the first separator into (left, right), both trimmed.
    Long dashes count as the separator. No separator -> right is null."""
    x = F.translate(col(c), LONG_DASHES, "-" * len(LONG_DASHES)) if sep == "-" else col(c)
    parts = F.split(x, F.lit(sep), 2)
    left = F.trim(F.element_at(parts, 1))
    right = F.when(F.size(parts) > 1, F.trim(F.element_at(parts, 2)))
    return left, right


def before_first(c: ColumnOrName, sep: str = "/") -> Column:
    """Text before the first separator, trimmed."""
    return F.trim(F.substring_index(col(c), sep, 1))


def join_id(*parts: ColumnOrName, sep: str = "-") -> Column:
    """Route / global id (null parts are skipped)."""
    return F.concat_ws(sep, *[col(p).cast("string") for p in parts])


def code_part(c: ColumnOrName, start: int, length: int) -> Column:
    """Positional piece of a composite code (1-based start)."""
    return F.substring(col(c).cast("string"), start, length)


def keyword_label(c: ColumnOrName, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """First keyword contained in the lower-cased text gives the label;
    null text stays null."""
    x = F.lower(col(c))
    expr = None
    for kw, label in rules:
        expr = F.when(x.contains(kw), F.lit(label)) if expr is None else expr.when(x.contains(kw), F.lit(label))
    out = expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)
    return F.when(x.isNotNull(), out)


def title_case(c: ColumnOrName, overrides: Mapping[str, str] | None = None) -> Column:
    """Python-style title case (a letter after a non-letter is upper,
    others lower), then whole-value display overrides."""
    x = F.lower(col(c))
    # Upper-case each letter that starts a letter run.
    parts = F.split(x, r"(?<=[^\p{L}])|(?=[^\p{L}])")
    titled = F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)),
                                                                   F.substring(p, 2, 1 << 30))), "")
    titled = F.when(x.isNotNull(), titled)
    if overrides:
        m = F.create_map(*[F.lit(v) for kv in overrides.items() for v in kv])
        titled = F.coalesce(F.element_at(m, titled), titled)
    return titled


def format_money(c: ColumnOrName, symbol: str = "€", decimals: int = 2) -> Column:
    """``1.234,56 €`` — thousands '.', decimal ','."""
    s = F.translate(F.format_number(col(c).cast("double"), decimals), ",.", ".,")
    return F.concat(s, F.lit(" " + symbol)) if symbol else s


def clean_query_text(c: ColumnOrName) -> Column:
    """S4 as used for search strings: strip, squeeze, trailing commas off."""
    x = F.regexp_replace(strip_unicode_space(col(c)), r"\s+", " ")
    return F.regexp_replace(x, r",+$", "")


def query_variants(name: ColumnOrName, province: ColumnOrName, region: ColumnOrName,
                   country: str = "España") -> Column:
    """Search strings from most to least precise.

    Templates: name+province+region+country, name+province+country,
    name+region+country, name+country, name; each cleaned, followed by the
    same text without accents; blanks dropped; first occurrence kept."""
    n, p, r = (F.coalesce(clean_query_text(col(x).cast("string")), F.lit("")) for x in (name, province, region))
    k = F.lit(country)
    sep = F.lit(", ")
    templates = [
        F.concat(n, sep, p, sep, r, sep, k),
        F.concat(n, sep, p, sep, k),
        F.concat(n, sep, r, sep, k),
        F.concat(n, sep, k),
        n,
    ]
    variants = []
    for t in templates:
        variants.append(clean_query_text(t))
        variants.append(clean_query_text(remove_accents(t)))
    return F.array_distinct(F.filter(F.array(*variants), lambda v: v != ""))

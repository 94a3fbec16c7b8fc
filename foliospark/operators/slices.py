"""Sections of a text: what stands between a start and an end, cleaned.

Two rules for ends are in use and are kept apart: ``until_first_listed`` and ``until_nearest``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions import patterns as P
from ..functions import text as t
from ..options import DEFAULT, Options


def surplus_use(c: Column, starts: Sequence[str] = P.SURPLUS_STARTS, ends: Sequence[str] = P.SURPLUS_ENDS, noise: Sequence[str] = P.SURPLUS_NOISE) -> Column:
    def clean(x: Column) -> Column:
        x = F.regexp_replace(t.collapse(t.strip(x)), r"(?U)^\s*[.:]?\s*", "")
        return t.strip(t.remove_each(x, noise))

    return t.first_slice(t.text_of(c), starts, lambda x: t.until_first_listed(x, ends), clean, skip_empty=True)


def company_differs(c: Column, starts: Sequence[str] = P.DIFFERS_STARTS, ends: Sequence[str] = P.DIFFERS_ENDS) -> Column:
    return t.first_slice(t.text_of(c), starts, lambda x: t.until_first_listed(x, ends), lambda x: t.strip(t.collapse(x)), skip_empty=True)


def beneficiaries(c: Column, starts: Sequence[str] = P.BENEFICIARY_STARTS, ends: Sequence[str] = P.BENEFICIARY_ENDS, tails: Sequence[str] = P.BENEFICIARY_TAILS, prefixes: Sequence[str] = P.BENEFICIARY_PREFIXES) -> Column:
    def clean(x: Column) -> Column:
        x = F.regexp_replace(t.collapse(t.strip(x)), r"(?U)^\s*[.:]?\s*", "")
        return t.strip(t.remove_each(t.strip(t.remove_each(x, tails)), prefixes))

    return t.first_slice(t.text_of(c), starts, lambda x: t.until_nearest(x, ends), clean, skip_empty=True)


def _lead(c: Column) -> Column:
    return F.regexp_replace(t.collapse(c), r"(?U)^\s*\.{1,3}\s*", "")


def ocr_beneficiaries(c: Column, starts: Sequence[str] = P.OCR_BENEFICIARY_STARTS, fallbacks: Sequence[str] = P.OCR_BENEFICIARY_FALLBACKS, ends: Sequence[str] = P.OCR_BENEFICIARY_ENDS, tails: Sequence[str] = P.OCR_BENEFICIARY_TAILS, prefixes: Sequence[str] = P.BENEFICIARY_PREFIXES) -> Column:
    """The first start that occurs decides, even if nothing stands behind it; only then the fallbacks."""
    cut = lambda x: t.strip(t.until_nearest(x, ends))
    main = lambda y: t.let(cut(t.after_first_listed(y, starts)), lambda z: F.nullif(z, F.lit("")))
    x = _lead(t.let(t.text_of(c), lambda y: F.coalesce(main(y), cut(t.after_first_listed(y, fallbacks)), F.lit(""))))
    x = F.regexp_replace(x, r"(?uUd)^[A-Za-z]\s+(?=The\s+company)", "")
    x = t.strip(F.regexp_replace(x, "^[^a-zA-Z]+", ""))
    x = F.regexp_replace(t.remove_each(x, tails), r"(?U)[\s.,:;]+\z", "")
    return t.strip(t.remove_each(x, prefixes))


def ocr_company_differs(c: Column, starts: Sequence[str] = P.OCR_DIFFERS_STARTS, ends: Sequence[str] = P.OCR_DIFFERS_ENDS) -> Column:
    return t.strip(_lead(t.strip(F.coalesce(t.until_first_listed(t.after_first_listed(t.text_of(c), starts), ends), F.lit("")))))


def ocr_surplus_use(c: Column, starts: Sequence[str] = P.OCR_SURPLUS_STARTS, ends: Sequence[str] = P.OCR_SURPLUS_ENDS, noise: Sequence[str] = P.OCR_SURPLUS_NOISE, tails: Sequence[str] = P.OCR_SURPLUS_TAILS, o: Options = DEFAULT) -> Column:
    x = _lead(t.strip(F.coalesce(t.until_first_listed(t.after_first_listed(t.text_of(c), starts), ends), F.lit(""))))
    x = t.remove_each(t.remove_each(x, noise), tails)
    x = t.strip(F.regexp_replace(x, t.sensitive(P.OCR_SURPLUS_CAPITALS), ""))
    return cap_at_sentence(x, o.surplus_cap, o.surplus_cut_after)


def cap_at_sentence(c: Column, cap: int, least: int) -> Column:
    """A longer text ends with its last whole sentence within ``cap``, if that ends behind ``least``; else it stays long."""

    def cut(x: Column) -> Column:
        whole = F.regexp_extract(F.substring(x, 1, cap), r"(?s)^(.*[.!?])", 1)
        return F.when((F.length(x) > cap) & (F.length(whole) > least + 1), whole).otherwise(x)

    return t.let(c, cut)


def text_body(c: Column, body: str = P.TEXT_BODY, loose_headers: bool = False) -> Column:
    """The section's lines as one activity, without headers and instructions; '' without a section."""
    lines = F.split(t.strip(F.regexp_extract(t.text_of(c), t.rx(body, "s"), 1)), "\n")
    lines = F.filter(F.transform(lines, t.strip), lambda x: (x != "") & ~C.is_header_or_instruction(x, loose_headers))
    return t.strip(F.array_join(lines, " "))


def strip_boilerplate(c: Column, patterns: Sequence[str] = P.BOILERPLATE) -> Column:
    """Pattern after pattern goes, over line ends; then blank lines, blanks and lone brackets."""
    out = t.remove_each(t.text_of(c), patterns, "s")
    out = F.regexp_replace(out, r"(?U)\n\s*\n\s*\n+", "\n\n")
    out = F.regexp_replace(out, "  +", " ")
    out = F.regexp_replace(out, r"(?mUd)^\s+", "")
    # No line begins with white space any more, so only one that begins with a bracket can go.
    lone = lambda x: F.regexp_replace(F.regexp_replace(x, r"(?mUd)^\s*[(\[\])\s]+\s*$", ""), r"(?mUd)^\s*\(\s*$", "")
    return t.strip(t.let(out, lambda x: F.when(t.contains_any(x, "()[]"), lone(x)).otherwise(x)))


def clean_column(c: Column, left: bool, common: Sequence[str] = P.COLUMN_COMMON, own: Sequence[str] | None = None) -> Column:
    """A column of a recognised layout without boilerplate."""
    own = (P.COLUMN_LEFT if left else P.COLUMN_RIGHT) if own is None else own
    return t.strip(t.collapse(t.remove_each(strip_boilerplate(c), [*common, *own])))

"""Cell, activity and benefit cleaning, and tests on single texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from . import text as t

PLAIN = r"[\p{L}\p{N} .,;:!?()\-'\"]"


def clean_cell(c: Column, artifacts: Sequence[str] | None = P.ARTIFACTS) -> Column:
    """Trim, collapse blanks, drop NUL and the artifacts of several characters; one-character ones stay."""
    out = t.collapse(t.strip(t.text_of(c)))
    if artifacts is None:
        return out
    return t.drop_literals(out, ["\x00", *[a for a in artifacts if len(a) > 1]])


def special_ratio(c: Column) -> Column:
    """Share of characters that are neither letters, digits nor plain punctuation."""
    return t.ratio_of(t.text_of(c), PLAIN)


def clean_text(c: Column, artifacts: Sequence[str] = P.ARTIFACTS, fixes: Sequence[tuple[str, str]] = P.FIXES) -> Column:
    """Drop all artifacts, collapse and trim, and mend common misreadings."""
    out = t.strip(t.collapse(t.drop_literals(t.text_of(c), artifacts)))
    for wrong, right in fixes:
        out = F.regexp_replace(out, t.rx(wrong), right)
    return out


def _bars(c: Column, by: str) -> Column:
    return t.collapse(F.replace(F.replace(t.text_of(c), F.lit("|"), F.lit(by)), F.lit("¦"), F.lit(by)))


def _dashes(c: Column) -> Column:
    cut = lambda x: F.regexp_replace(F.regexp_replace(x, r"(?U)^\s*[-–—]\s*", ""), r"(?U)\s*[-–—]\s*$", "")
    return t.let(c, lambda x: F.when(t.contains_any(x, "-–—"), cut(x)).otherwise(x))


def clean_activity(c: Column, drop_short_tail: bool = True) -> Column:
    out = _dashes(_bars(c, " "))
    out = t.remove_each(out, [r"\(Tell\s+us\s+here[^)]*\)", r"\(The\s+community\s+will\s+benefit[^)]*\)"])
    out = t.remove_each(out, [r"Activities?\s+How\s+will.*?community\s*\?"], "s")
    out = t.remove_each(out, [r"having\s+access\s+to\s+flexible.*$"])
    if drop_short_tail:
        out = F.regexp_replace(out, t.sensitive(r"\s+\w{1,3}\s*$"), "")
    return t.strip(out)


def clean_benefit(c: Column) -> Column:
    return t.strip(t.remove_each(_bars(c, " "), [r"\(Please\s+continue[^)]*\)"]))


def clean_entry(c: Column) -> Column:
    return t.strip(t.remove_each(_dashes(_bars(c, "")), [r"\([^)]*tell\s+us[^)]*\)", r"\([^)]*community\s+will\s+benefit\s+by[^)]*\)"]))


def drop_non_content(c: Column, removals: Sequence[str] = P.NON_CONTENT) -> Column:
    """Text without form instructions, page marks, numbers and rules."""
    return t.strip(t.collapse(t.remove_each(t.text_of(c), removals, "m")))


def is_header_or_instruction(c: Column, loose: bool = False, headers: Sequence[str] = P.HEADERS, instructions: Sequence[str] = P.INSTRUCTIONS) -> Column:
    """Headers at the beginning or instructions anywhere; empty texts count.  ``loose`` adds bare header words."""
    return t.let(t.strip(t.text_of(c)), lambda x: (x == "") | t.starts(x, [*headers, *(P.LOOSE_HEADERS if loose else ())]) | t.any_match(x, instructions))


def is_form_instruction(c: Column, instructions: Sequence[str] = P.INSTRUCTIONS, markers: Sequence[str] = P.INSTRUCTION_MARKERS) -> Column:
    """Instructions or marker phrases; an empty text is none."""
    return t.let(t.strip(t.text_of(c)), lambda x: (x != "") & (t.any_match(x, instructions) | t.contains_any(F.lower(x), markers)))


def is_instruction_only(c: Column, beginnings: Sequence[str] = P.ONLY_STARTS, indicators: Sequence[str] = P.ONLY_INDICATORS) -> Column:
    """Short texts, instruction beginnings, and texts that are mostly boilerplate."""

    def mostly(low: Column) -> Column:
        return t.starts(low, beginnings) | t.let(t.count_matching(low, indicators), lambda n: ((n >= 2) & (F.length(low) < 500)) | ((n >= 1) & (F.length(low) < 200)))

    return t.let(t.text_of(c), lambda x: (F.length(x) < 20) | t.let(t.strip(F.lower(x)), mostly))


def is_header_line(c: Column, headers: Sequence[str] = P.HEADER_LINES) -> Column:
    return t.starts(t.strip(t.text_of(c)), headers)


def has_artifacts(c: Column, artifacts: Sequence[str] = P.ARTIFACTS) -> Column:
    return t.contains_any(t.text_of(c), artifacts)


def is_placeholder(c: Column, placeholders: Sequence[str] = P.PLACEHOLDERS) -> Column:
    return t.any_match(t.text_of(c), placeholders)


def dedupe_key(c: Column, prefix: int | None = None) -> Column:
    c = t.text_of(c)
    return F.lower(F.substring(c, 1, prefix) if prefix else c)
